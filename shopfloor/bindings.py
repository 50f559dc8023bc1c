"""Domain tables derived from the given star-schema tables.

Each derivation is one SELECT written in the dialect overlap of Spark SQL and DuckDB, so
a query and its oracle start from the same rows. ``Domain`` resolves them lazily as Spark
DataFrames; ``oracle_ctes`` renders the same text as a WITH clause.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

from shopfloor.operators import calendar

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# --- stock-keeping units and products -------------------------------------------------
# Fourteen style shapes (one per parsing rule) crossed with seven ways of matching a product.
_RULE = "({k} % 14)"
_TIER = "(CAST(floor({k} / 14) AS BIGINT) % 7)"
_D3 = "lpad(CAST({k} % 1000 AS STRING), 3, '0')"
_D4 = "lpad(CAST({k} % 10000 AS STRING), 4, '0')"
_D5 = "lpad(CAST({k} % 100000 AS STRING), 5, '0')"
_D6 = "lpad(CAST({k} % 1000000 AS STRING), 6, '0')"
_C5 = "concat('C', lpad(CAST({k} % 9973 AS STRING), 4, '0'))"
_S1 = "CAST(1 + {k} % 50 AS STRING)"

_RAW_STYLE = f"""CASE {_RULE}
    WHEN 0 THEN concat('OC', {_D4}, {_C5}, 'M')
    WHEN 1 THEN concat('OC', {_D3}, '*', 'ABCDEF')
    WHEN 2 THEN concat('OC', {_D4}, '*', 'ABCDEF')
    WHEN 3 THEN concat('CPN-', {_D5}, '-', {_C5}, '-', {_S1})
    WHEN 4 THEN concat('OPR', {_D3}, {_C5}, {_S1})
    WHEN 5 THEN concat({_D6}, 'DUM', {_S1})
    WHEN 6 THEN concat('FF', {_D4}, {_C5}, {_S1})
    WHEN 7 THEN concat('FL', {_D6})
    WHEN 11 THEN NULL
    WHEN 12 THEN concat('OC', {_D4}, {_C5}, 'XXL')
    WHEN 13 THEN concat('S_', {_D5})
    ELSE concat('S', {_D5}) END"""

_PARSED_STYLE = f"""CASE {_RULE}
    WHEN 0 THEN concat('OC', {_D4})
    WHEN 1 THEN {_D3}
    WHEN 2 THEN {_D4}
    WHEN 3 THEN {_D5}
    WHEN 4 THEN concat('OPR', {_D3})
    WHEN 5 THEN {_D6}
    WHEN 6 THEN concat('FF', {_D4})
    WHEN 7 THEN {_D6}
    WHEN 12 THEN concat('OC', {_D4})
    ELSE concat('S', {_D5}) END"""

# Two rules read colour out of the code, so there it holds style, colour and size.
_SKU_CODE = f"""CASE {_RULE} WHEN 9 THEN concat('S', {_D5}, {_C5}, {_S1}) WHEN 10 THEN concat('S', {_D5}, {_C5})
    ELSE concat('K~', CAST({{k}} AS STRING)) END"""


def _at(template: str, key: str) -> str:
    return template.replace("{k}", key)


_P = "p_partkey"

SQL: dict[str, str] = {}

SQL["product_sku"] = f"""
SELECT {_P} AS id,
  {_at(_SKU_CODE, _P)} AS code,
  {_at(_RAW_STYLE, _P)} AS style,
  CASE WHEN {_at(_RULE, _P)} IN (1, 2, 7, 8, 13) THEN concat({_at(_RAW_STYLE, _P)}, {_at(_C5, _P)})
       WHEN {_at(_RULE, _P)} = 10 THEN '' END AS style_color,
  CASE WHEN {_at(_RULE, _P)} IN (0, 3, 4, 5, 6, 12) THEN NULL
       WHEN {_at(_RULE, _P)} = 10 THEN '' ELSE {_at(_S1, _P)} END AS size,
  CASE {_at(_TIER, _P)} WHEN 0 THEN concat('U', CAST({_P} AS STRING)) WHEN 2 THEN '0'
       WHEN 6 THEN concat('X', CAST({_P} AS STRING)) END AS upc_code
FROM {{part}}"""

SQL["product"] = f"""
SELECT {_P} AS product_id,
  CASE WHEN {_P} % 17 = 0 THEN 'B2' ELSE 'B1' END AS brand_code,
  CASE WHEN {_at(_TIER, _P)} IN (4, 5) THEN concat('N', CAST({_P} AS STRING))
       WHEN {_P} % 3 = 0 THEN concat(' _', {_at(_PARSED_STYLE, _P)}) ELSE {_at(_PARSED_STYLE, _P)} END AS sty_code,
  CASE WHEN {_at(_TIER, _P)} = 3 THEN 'Z0000' ELSE {_at(_C5, _P)} END AS color_code,
  CASE WHEN {_at(_TIER, _P)} = 2 THEN '99'
       ELSE CASE {_at(_RULE, _P)} WHEN 0 THEN 'M' WHEN 12 THEN 'XXL' ELSE {_at(_S1, _P)} END END AS sz_code,
  CASE WHEN {_at(_TIER, _P)} = 0 THEN concat('U', CAST({_P} AS STRING)) ELSE concat('V', CAST({_P} AS STRING)) END AS upc_code,
  CASE WHEN {_at(_TIER, _P)} = 5 THEN 'none'
       ELSE concat(' ', replace({_at(_SKU_CODE, _P)}, '~', '_~ ')) END AS sku,
  CASE WHEN {_P} % 29 = 0 THEN 'N/A' ELSE concat('D', lpad(CAST(1 + {_P} % 25 AS STRING), 2, '0')) END AS dept_code,
  p_type AS dept_desc,
  CASE WHEN {_P} % 9 = 0 THEN concat(p_name, ' 1941') ELSE p_name END AS collect_desc,
  concat('silhouette ', p_brand) AS silhouette_desc,
  CASE WHEN p_size > 25 THEN 'L' ELSE 'S' END AS handbag_sz,
  p_type AS class_desc,
  p_brand AS signature_type_desc,
  concat(p_brand, ' member') AS signature_type_mbr_desc,
  CASE {_P} % 4 WHEN 0 THEN 'Factory Exclusive line' WHEN 1 THEN NULL ELSE 'Full line' END AS fact_type,
  concat('G', CAST({_P} % 8 AS STRING)) AS sty_grp,
  CASE WHEN {_P} % 10 = 0 THEN concat('1941 ', p_name) ELSE p_name END AS sty_long_desc,
  CASE {_P} % 5 WHEN 0 THEN 'Exotics leather' WHEN 1 THEN NULL ELSE 'Canvas' END AS mtrl_desc,
  concat('M', CAST({_P} % 5 AS STRING)) AS mtrl_code,
  concat('CG', CAST({_P} % 6 AS STRING)) AS color_grp,
  CASE WHEN {_P} % 3 = 0 THEN 'Product Identity Retail Derived' ELSE 'Product Identity Other' END AS product_identity,
  CASE WHEN {_P} % 6 = 0 THEN 'Holiday Novelty' END AS spcl_product_mbr_desc
FROM {{part}}"""

# --- customers ------------------------------------------------------------------------
_COUNTRY = """CASE n_nationkey % 5 WHEN 0 THEN 'China' WHEN 1 THEN 'Hong Kong' WHEN 2 THEN 'Macau'
       WHEN 3 THEN 'Taiwan' ELSE 'Korea' END"""

SQL["crm_customer"] = """
SELECT concat('K', CAST(c_custkey AS STRING)) AS customer_id,
  CASE WHEN c_custkey % 19 = 0 THEN 'Other' ELSE 'Main' END AS brand_code,
  CAST(1950 + c_custkey % 50 AS INT) AS birth_year,
  CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS gender_code,
  CASE WHEN c_custkey % 6 = 0 THEN 'O' WHEN c_custkey % 7 = 0 THEN 'Q' ELSE 'C' END AS customer_type,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Hong Kong' END AS exact_country
FROM {customer}"""

SQL["type_history"] = """
SELECT concat('K', CAST(o_custkey AS STRING)) AS customer_id,
  CASE WHEN o_orderkey % 23 = 0 THEN 'Other' ELSE 'Main' END AS brand_code,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderdate END AS upgrade_date_time
FROM {orders} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"""

SQL["type_code"] = """
SELECT DISTINCT CASE r_regionkey WHEN 0 THEN 'O' WHEN 1 THEN 'C' ELSE concat('T', CAST(r_regionkey AS STRING)) END AS code
FROM {region}"""

SQL["customer_address"] = """
SELECT concat('K', CAST(c_custkey AS STRING)) AS customer_id, 'Main' AS brand_code,
  concat('PV', CAST(c_nationkey AS STRING)) AS province_code
FROM {customer} WHERE c_mktsegment <> 'MACHINERY'
UNION ALL
SELECT concat('K', CAST(c_custkey AS STRING)) AS customer_id, CASE WHEN c_custkey % 10 = 5 THEN 'Other' ELSE 'Main' END AS brand_code,
  concat('PV', CAST((c_nationkey + 3) % 25 AS STRING)) AS province_code
FROM {customer} WHERE c_acctbal > 5000"""

SQL["province"] = f"""
SELECT concat('PV', CAST(n_nationkey AS STRING)) AS code,
  CASE WHEN n_nationkey % 6 = 0 THEN 'OTHERS' ELSE {_COUNTRY} END AS country_code
FROM {{nation}}"""

SQL["residence_country"] = f"""
SELECT DISTINCT {_COUNTRY} AS residence_country,
  CASE n_nationkey % 5 WHEN 0 THEN 'CN' WHEN 1 THEN 'HK' WHEN 2 THEN 'MO' WHEN 3 THEN 'TW' ELSE 'KR' END AS country_code
FROM {{nation}}"""

# --- transactions ---------------------------------------------------------------------
_COUNTER = """CASE WHEN n_nationkey = 11 THEN 'OCW11' WHEN n_nationkey % 4 = 3 THEN concat('OCE', CAST(n_nationkey AS STRING))
       ELSE concat('OCS', CAST(n_nationkey AS STRING)) END"""

SQL["transaction_hdr"] = """
SELECT o_orderkey AS id, concat('P', CAST(o_orderkey AS STRING)) AS purchase_code,
  CASE o_orderkey % 3 WHEN 1 THEN o_orderdate + INTERVAL '9' HOUR WHEN 2 THEN o_orderdate + INTERVAL '17' HOUR ELSE o_orderdate END AS txn_datetime,
  CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE concat('K', CAST(o_custkey AS STRING)) END AS customer_id,
  CASE WHEN o_orderkey % 25 = 11 THEN 'OCW11' WHEN o_orderkey % 25 % 4 = 3 THEN concat('OCE', CAST(o_orderkey % 25 AS STRING))
       ELSE concat('OCS', CAST(o_orderkey % 25 AS STRING)) END AS counter_code
FROM {orders}"""

_L = "l_partkey"
SQL["transaction_dtl"] = f"""
SELECT concat('P', CAST(l_orderkey AS STRING)) AS purchase_code,
  {_at(_SKU_CODE, _L)} AS sku_code,
  CASE WHEN l_linenumber = 7 AND l_quantity > 45 THEN 0 ELSE l_extendedprice END AS local_txn_amount,
  CAST(l_extendedprice / 7.3 AS DECIMAL(12,2)) AS usd_txn_amount,
  CASE WHEN l_quantity = 1 THEN 0 WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS item_sold_qty,
  CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE CAST(l_extendedprice / l_quantity * (1.013713 + l_discount * 5.017113) AS DECIMAL(12,2)) END AS retail_price,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS return_flag
FROM {{lineitem}}"""

SQL["counter"] = f"""
SELECT {_COUNTER} AS code, concat('G', CAST(n_regionkey AS STRING)) AS counter_category_code,
  CASE n_nationkey % 9 WHEN 0 THEN 'China' WHEN 1 THEN 'CHN' WHEN 2 THEN 'HKG' WHEN 3 THEN 'Hong Kong' WHEN 4 THEN 'MAC'
    WHEN 5 THEN 'TWN' WHEN 6 THEN 'Taiwan' WHEN 7 THEN 'Korea' ELSE 'SGP' END AS nationality_code
FROM {{nation}}
UNION ALL
SELECT {_COUNTER} AS code, concat('G', CAST(n_regionkey AS STRING)) AS counter_category_code,
  CASE n_nationkey % 9 WHEN 0 THEN 'China' WHEN 1 THEN 'CHN' WHEN 2 THEN 'HKG' WHEN 3 THEN 'Hong Kong' WHEN 4 THEN 'MAC'
    WHEN 5 THEN 'TWN' WHEN 6 THEN 'Taiwan' WHEN 7 THEN 'Korea' ELSE 'SGP' END AS nationality_code
FROM {{nation}} JOIN {{supplier}} ON s_nationkey = n_nationkey"""

SQL["counter_category"] = """
SELECT concat('G', CAST(r_regionkey AS STRING)) AS code,
  CAST(CASE r_regionkey WHEN 3 THEN 8 WHEN 4 THEN 100 ELSE r_regionkey END AS INT) AS id,
  CAST(CASE r_regionkey WHEN 0 THEN 3 WHEN 1 THEN 4 ELSE 9 END AS INT) AS group_code
FROM {region}"""

_LIST_KEY = "CASE n_nationkey % 7 WHEN 0 THEN 4 WHEN 1 THEN 5 WHEN 2 THEN 13 WHEN 3 THEN 11 WHEN 4 THEN 9 WHEN 5 THEN 7 ELSE 8 END"
SQL["price_list"] = f"""
SELECT p_partkey AS product_key, {_LIST_KEY} AS price_list_key,
  CAST(p_retailprice * (1.000713 + n_nationkey * 0.0300191) AS DECIMAL(12,2)) AS price,
  DATE '1995-01-01' AS start_date, CASE WHEN p_partkey % 13 = 0 THEN DATE '1998-07-20' ELSE DATE '1998-06-30' END AS end_date
FROM {{part}} JOIN {{nation}} ON n_regionkey = p_partkey % 5
UNION ALL
SELECT p_partkey AS product_key, {_LIST_KEY} AS price_list_key,
  CAST(p_retailprice * (1.100713 + n_nationkey * 0.0400191) AS DECIMAL(12,2)) AS price,
  DATE '1998-07-01' AS start_date, DATE '2000-12-31' AS end_date
FROM {{part}} JOIN {{nation}} ON n_regionkey = p_partkey % 5"""

SQL["product_cost"] = """
SELECT p_partkey AS product_key, CAST(p_retailprice * 0.0311713 AS DECIMAL(12,2)) AS curr_std_cst_usd,
  DATE '1995-01-01' AS start_date, DATE '1997-12-31' AS end_date
FROM {part}
UNION ALL
SELECT p_partkey AS product_key, CAST(p_retailprice * 0.0372941 AS DECIMAL(12,2)) AS curr_std_cst_usd,
  DATE '1998-03-01' AS start_date, DATE '2002-12-31' AS end_date
FROM {part} WHERE p_size < 45"""

_CURRENCY = "CASE n_nationkey % 5 WHEN 0 THEN 'CNY' WHEN 1 THEN 'HKD' WHEN 2 THEN 'MOP' WHEN 3 THEN 'TWD' ELSE 'KRW' END"
_YEAR_OF_NATION = "CAST(1996 + floor(n_nationkey / 5) AS INT)"
SQL["peg_rate"] = f"""
SELECT {_YEAR_OF_NATION} AS fisc_year_num, 1 AS start_day_num, 182 AS end_day_num, {_CURRENCY} AS currency,
  CAST(6.87 + n_nationkey % 5 * 0.971 AS DECIMAL(10,4)) AS peg_rate
FROM {{nation}}
UNION ALL
SELECT {_YEAR_OF_NATION} AS fisc_year_num, 183 AS start_day_num, 364 AS end_day_num, {_CURRENCY} AS currency,
  CAST(6.91 + n_nationkey % 5 * 0.953 AS DECIMAL(10,4)) AS peg_rate
FROM {{nation}}"""

SQL["tax_rate"] = """
SELECT CASE n_nationkey % 5 WHEN 0 THEN 'CN' WHEN 1 THEN 'HK' WHEN 2 THEN 'MO' WHEN 3 THEN 'TW' ELSE 'KR' END AS country_code,
  CAST(1.07 + n_nationkey * 0.0037 AS DECIMAL(10,4)) AS tax_rate,
  CASE floor(n_nationkey / 5) WHEN 0 THEN DATE '1995-01-01' WHEN 1 THEN DATE '1996-01-01' WHEN 2 THEN DATE '1997-01-01'
    WHEN 3 THEN DATE '1998-01-01' ELSE DATE '1999-06-01' END AS start_date,
  CASE floor(n_nationkey / 5) WHEN 0 THEN DATE '1995-12-31' WHEN 1 THEN DATE '1996-12-31' WHEN 2 THEN DATE '1997-12-31'
    WHEN 3 THEN DATE '1998-12-31' ELSE DATE '2001-12-31' END AS end_date
FROM {nation} WHERE n_nationkey <> 7"""

_MARKET = """CASE n_nationkey % 9 WHEN 0 THEN 'CN' WHEN 1 THEN 'CN' WHEN 2 THEN 'HK' WHEN 3 THEN 'HK' WHEN 4 THEN 'MO'
    WHEN 5 THEN 'TW' WHEN 6 THEN 'TW' WHEN 7 THEN 'KR' ELSE 'SG' END"""
SQL["location"] = f"""
SELECT CASE WHEN n_nationkey = 22 THEN 1256736 ELSE 5000 + n_nationkey END AS location_id,
  concat({_MARKET}, {_COUNTER}) AS door_code, concat('Door ', n_name) AS door_desc,
  CASE WHEN n_nationkey = 13 THEN 'Virtual 13' WHEN n_nationkey = 14 THEN NULL ELSE concat('N', CAST(n_nationkey AS STRING)) END AS store_nbr,
  CASE WHEN n_nationkey = 12 THEN 'N/A' ELSE concat('SITE', CAST(n_nationkey AS STRING)) END AS sap_site_id,
  r_name AS region_desc, concat('District ', CAST(n_nationkey % 6 AS STRING)) AS district_desc,
  concat('City ', CAST(n_nationkey AS STRING)) AS city, concat('State ', CAST(n_nationkey % 4 AS STRING)) AS state
FROM {{nation}} JOIN {{region}} ON r_regionkey = n_regionkey"""

SQL["shifted_years"] = "SELECT DISTINCT fisc_year_num FROM {calendar} WHERE fisc_year_num IN (1997, 2000)"

SQL["comparable_bands"] = """
SELECT concat('SITE', CAST(n_nationkey AS STRING)) AS sap_site_id, fisc_year_num AS cal_year_num, 1 AS start_day_num, 200 AS end_day_num,
  CAST(CASE WHEN n_nationkey % 3 = 0 THEN 4 ELSE 1 END AS INT) AS cal_key, 'TY' AS year_mode, 'COMP' AS comp_category_desc
FROM {nation} JOIN (SELECT DISTINCT fisc_year_num FROM {calendar}) y ON n_nationkey % 2 = fisc_year_num % 2
UNION ALL
SELECT concat('SITE', CAST(n_nationkey AS STRING)) AS sap_site_id, fisc_year_num AS cal_year_num, 15 AS start_day_num, 330 AS end_day_num,
  CAST(CASE WHEN n_nationkey % 2 = 0 THEN 4 ELSE 1 END AS INT) AS cal_key, 'LY' AS year_mode, 'COMP LY' AS comp_category_desc
FROM {nation} JOIN (SELECT DISTINCT fisc_year_num FROM {calendar}) y ON n_nationkey % 3 = fisc_year_num % 3"""

# --- chat reach -----------------------------------------------------------------------
# A client is an events user; ten associates serve them, error events going to a colleague.
_ASSOCIATE = "((user_id + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) % 10)"

SQL["associate_customer"] = f"""
SELECT CASE WHEN user_id % 37 = 36 THEN NULL ELSE concat('sa', CAST(s_suppkey AS STRING)) END AS user_id,
  s_name AS name, concat('Store ', CAST(s_suppkey % 6 AS STRING)) AS local_name,
  concat('S', CAST(s_suppkey % 6 AS STRING)) AS store_nbr,
  CASE s_suppkey % 3 WHEN 0 THEN 'Factory' WHEN 1 THEN 'Regular' ELSE 'Pop-up' END AS counter_type_code,
  r_name AS region, n_name AS region_detail,
  CASE WHEN s_suppkey = 7 THEN '5' WHEN s_suppkey % 2 = 0 THEN '1' ELSE '4' END AS sa_status,
  CASE WHEN s_suppkey % 3 = 0 THEN '0' ELSE '1' END AS is_key_sa,
  concat('we', CAST(user_id AS STRING)) AS work_external_user_id,
  CASE WHEN user_id % 25 = 3 AND event_type = 'click' THEN concat('cb', CAST(user_id AS STRING))
       ELSE concat('c', CAST(user_id AS STRING)) END AS customer_id,
  CASE WHEN user_id % 30 = 2 AND event_type = 'view' THEN 'SILVER'
       ELSE CASE user_id % 7 WHEN 0 THEN 'DIAMOND,' WHEN 1 THEN 'GOLD' WHEN 2 THEN 'Regular' WHEN 3 THEN 'SILVER'
            WHEN 4 THEN 'Non-Member' WHEN 5 THEN 'VIP' END END AS card_type_new,
  CASE WHEN value < 1 THEN DATE '1970-01-01' ELSE CAST(ts AS DATE) END AS add_date,
  CAST(CASE WHEN event_type = 'signup' THEN 1 ELSE 2 END AS INT) AS add_rank,
  CASE WHEN ts < TIMESTAMP '2024-01-08 00:00:00' THEN 'FY23' ELSE 'FY24' END AS fisc_year,
  CASE WHEN event_type = 'purchase' OR event_type = 'view' THEN CAST(ts AS DATE) END AS txn_date,
  CASE WHEN event_type = 'purchase' OR event_type = 'view' THEN concat('T', CAST(event_id AS STRING)) END AS txn_nbr,
  CASE WHEN event_type = 'purchase' THEN concat('sa', CAST((s_suppkey + user_id) % 10 AS STRING)) END AS user_id_txn,
  CASE WHEN event_type = 'purchase' OR event_type = 'view' THEN CAST(value AS DECIMAL(12,2)) END AS demand
FROM {{events}}
JOIN {{supplier}} ON s_suppkey = {_ASSOCIATE}
JOIN {{nation}} ON n_nationkey = s_nationkey
JOIN {{region}} ON r_regionkey = n_regionkey"""

SQL["contact"] = """
SELECT DISTINCT concat('wm', CAST(user_id AS STRING)) AS openid, concat('we', CAST(user_id AS STRING)) AS id,
  concat('c', CAST(user_id AS STRING)) AS customer_id
FROM {events} WHERE user_id % 41 <> 40"""


def _chat(stamp: str) -> str:
    return f"""
SELECT CASE WHEN event_type = 'signup' AND user_id % 9 = 8 THEN 'Other' ELSE 'Main' END AS brand_code,
  CASE WHEN value < 0.5 THEN '' ELSE concat('sa', CAST({_ASSOCIATE} AS STRING)) END AS sender_external_userid,
  CASE WHEN value > 60 THEN concat('sa', CAST(user_id % 10 AS STRING)) ELSE concat('wm', CAST(user_id AS STRING)) END AS receiver_external_userid,
  {stamp} AS msgtime
FROM {{events}}"""


# Second-grained text, as a chat platform exports it. Only the format call differs by engine.
SQL["chat_message"] = _chat("date_format(ts, 'yyyy-MM-dd HH:mm:ss')")
ORACLE_SQL = {
    "chat_message": _chat("strftime(ts, '%Y-%m-%d %H:%M:%S')"),
    "calendar": """
SELECT d AS calendar_date, CAST(fy AS INT) AS fisc_year_num, CAST((fm - 1) // 3 + 1 AS INT) AS fisc_quarter_num, CAST(fm AS INT) AS fisc_month_num,
  CAST((yd - 1) // 7 + 1 AS INT) AS fisc_week_of_year_num, CAST(yd AS INT) AS fisc_year_day_num
FROM (SELECT d, fy, (month(d) + 5) % 12 + 1 AS fm, d - make_date(fy - 1, 7, 1) + 1 AS yd
  FROM (SELECT CAST(g AS DATE) AS d, year(g) + CASE WHEN month(g) >= 7 THEN 1 ELSE 0 END AS fy
        FROM generate_series(TIMESTAMP '1994-07-01', TIMESTAMP '2002-06-30', INTERVAL 1 DAY) t(g)))""",
    "reach_calendar": """
SELECT d AS calendar_date, CAST(year(d - 7) AS INT) AS fisc_year_num, CAST((month(d - 7) - 1) // 3 + 1 AS INT) AS fisc_quarter_num,
  CAST(month(d - 7) AS INT) AS fisc_month_num, CAST((d - make_date(year(d - 7), 1, 8)) // 7 + 1 AS INT) AS fisc_week_of_year_num,
  CAST(d - make_date(year(d - 7), 1, 8) + 1 AS INT) AS fisc_year_day_num
FROM (SELECT CAST(g AS DATE) AS d FROM generate_series(TIMESTAMP '2022-01-08', TIMESTAMP '2026-01-07', INTERVAL 1 DAY) t(g))""",
    "calendar_period": """
SELECT code AS time_period_code, label AS time_period, min(d) AS start_date, max(d) AS end_date FROM (
  SELECT d, code, CASE code WHEN 'Week' THEN fy || lpad(CAST((yd - 1) // 7 + 1 AS VARCHAR), 2, '0')
      WHEN 'Month' THEN fy || lpad(CAST(fm AS VARCHAR), 2, '0')
      WHEN 'Quarter' THEN fy || lpad(CAST((fm - 1) // 3 + 1 AS VARCHAR), 2, '0') ELSE fy END AS label
  FROM (SELECT d, CAST(year(d - 7) AS VARCHAR) AS fy, month(d - 7) AS fm, d - make_date(year(d - 7), 1, 8) + 1 AS yd
        FROM (SELECT CAST(g AS DATE) AS d FROM generate_series(TIMESTAMP '2022-01-08', TIMESTAMP '2026-01-07', INTERVAL 1 DAY) t(g)))
  CROSS JOIN (VALUES ('Week'), ('Month'), ('Quarter'), ('Year')) c(code))
GROUP BY 1, 2""",
}

# --- chat ingest and telemetry --------------------------------------------------------
# Raw messages as JSON text. Message bodies keep their raw control characters, and the
# receiver list comes in every shape the feed shows: absent, empty, several, bare text.
_KIND = "((conv_id + turn) % 7)"
_ESCAPED = "replace(replace(text, chr(92), concat(chr(92), chr(92))), '\"', concat(chr(92), '\"'))"
_MEDIA = f"""concat('{{"sdkfileid":"', CASE WHEN conv_id % 9 = 8 THEN 'short' WHEN conv_id % 9 = 7 THEN concat(md5(role), '#', md5(text)) ELSE concat(' ', md5(text), md5(role), '= ') END,
    '","md5sum":"', CASE WHEN conv_id % 11 = 10 THEN ' ' ELSE md5(concat(role, CAST(conv_id % 13 AS STRING))) END, '"', """
SQL["raw_message"] = f"""
SELECT conv_id * 100 + turn AS seq, concat('m', CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS msgid,
  concat('{{"msgid":"m', CAST(conv_id AS STRING), '-', CAST(turn AS STRING), '","action":"send","from":"',
    CASE role WHEN 'user' THEN concat('wm', CAST(conv_id AS STRING)) WHEN 'assistant' THEN concat('sa', CAST(conv_id % 10 AS STRING)) ELSE concat('wb', CAST(conv_id AS STRING)) END, '"',
    CASE conv_id % 6 WHEN 0 THEN '' WHEN 1 THEN ',"tolist":[]' WHEN 2 THEN concat(',"tolist":"wo', CAST(conv_id AS STRING), '"')
      WHEN 3 THEN concat(',"tolist":["wo', CAST(conv_id AS STRING), '"]')
      WHEN 4 THEN concat(',"tolist":["wm', CAST(conv_id AS STRING), '","sa', CAST(conv_id % 10 AS STRING), '"]')
      ELSE concat(',"tolist":["wo1","wo2","wm', CAST(conv_id % 4 AS STRING), '"]') END,
    CASE WHEN turn % 2 = 0 THEN ',"roomid":"r1"' ELSE '' END,
    CASE WHEN turn = 6 THEN '' ELSE concat(',"msgtime":', CAST(1704067200000 + (conv_id * 7919 + turn) * 1000 AS STRING)) END,
    ',"msgtype":"',
    CASE {_KIND} WHEN 0 THEN 'image' WHEN 1 THEN 'file' WHEN 2 THEN 'voice' WHEN 3 THEN 'chatrecord' ELSE 'text' END, '","',
    CASE {_KIND} WHEN 0 THEN 'image' WHEN 1 THEN 'file' WHEN 2 THEN 'voice' WHEN 3 THEN 'chatrecord' ELSE 'text' END, '":',
    CASE WHEN {_KIND} IN (0, 2) THEN {_MEDIA} '}}')
      WHEN {_KIND} = 1 THEN {_MEDIA} ',"fileext":"', CASE conv_id % 3 WHEN 0 THEN 'pdf'
          WHEN 1 THEN concat('{{', chr(92), '"fileext', chr(92), '":', chr(92), '"docx', chr(92), '"}}') ELSE '{{broken}}' END, '"}}')
      WHEN {_KIND} = 3 THEN concat('{{"item":"', CASE WHEN turn = 3 THEN repeat('x', 60000) ELSE '' END, {_ESCAPED}, '"}}')
      ELSE concat('{{"content":"', {_ESCAPED}, '"}}') END,
    '}}') AS message
FROM {{conversations}}"""

SQL["id_mapping"] = """
SELECT DISTINCT concat('wo', CAST(conv_id AS STRING)) AS external_userid,
  CASE WHEN conv_id % 4 = 0 THEN '' WHEN conv_id % 4 = 1 THEN NULL ELSE concat('un', CAST(conv_id AS STRING)) END AS unionid
FROM {conversations} WHERE conv_id % 3 <> 2"""

SQL["failure_log"] = """
SELECT ts AS event_ts, CASE user_id % 4 WHEN 0 THEN 'image' WHEN 1 THEN 'voice' WHEN 2 THEN 'file' ELSE 'video' END AS msgtype,
  md5(CAST(event_id AS STRING)) AS sdkfileid,
  CAST(CASE event_id % 6 WHEN 0 THEN 10001 WHEN 1 THEN 10002 WHEN 2 THEN 10003 WHEN 3 THEN -1000 WHEN 4 THEN -1001 ELSE 41001 END AS INT) AS ret_code,
  CASE WHEN event_type <> 'error' THEN 'success' WHEN value > 20 THEN 'expired' ELSE 'failed' END AS status
FROM {events}"""


def _failure_line(stamp: str) -> str:
    return f"""
SELECT concat('[', {stamp}, '] Type: ', rpad(msgtype, 6, ' '), ' | FileID: ', rpad(concat(substring(sdkfileid, 1, 17), '...'), 20, ' '),
  ' | Error: SdkException: ret=', CAST(ret_code AS STRING)) AS line
FROM {{failure_log}} WHERE status <> 'success'
UNION ALL
SELECT concat('noise | ', sdkfileid) AS line FROM {{failure_log}} WHERE status = 'expired'"""


SQL["failure_lines"] = _failure_line("date_format(event_ts, \"yyyy-MM-dd'T'HH:mm:ss\")")
ORACLE_SQL["failure_lines"] = _failure_line("strftime(event_ts, '%Y-%m-%dT%H:%M:%S')")

SQL["job_runs"] = """
SELECT event_type AS task_name, CASE WHEN value > 30 THEN 'failed' ELSE 'success' END AS status,
  CAST(round(value * 1000) AS BIGINT) AS duration_ms, CAST(user_id AS BIGINT) AS data_size
FROM {events}"""



def _reach_days(spark: SparkSession) -> DataFrame:
    return calendar.calendar_days(spark, dt.date(2022, 1, 8), dt.date(2026, 1, 7), 1, 8, named_by_end=False)


_GENERATED = {
    "calendar": lambda spark: calendar.calendar_days(spark, dt.date(1994, 7, 1), dt.date(2002, 6, 30), 7, 1),
    "reach_calendar": lambda spark: _reach_days(spark),
    "calendar_period": lambda spark: calendar.calendar_periods(_reach_days(spark)),
}

_REF = re.compile(r"\{([a-z_]+)\}")


class Domain:
    """Lazy access to the base tables of ``folder`` and the domain tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._resolve(name)
        return self._known[name]

    def _resolve(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in _GENERATED:
            return _GENERATED[name](self.spark)
        text = SQL[name]
        # Braces are placeholders; literal JSON braces survive because they never wrap a bare name.
        inputs = {ref: self[ref] for ref in dict.fromkeys(_REF.findall(text)) if _is_table(ref)}
        for ref, df in inputs.items():
            df.createOrReplaceTempView(f"shopfloor_{ref}")
        return self.spark.sql(_REF.sub(lambda m: f"shopfloor_{m[1]}" if _is_table(m[1]) else m[0], text))


def _is_table(ref: str) -> bool:
    return ref in BASE_TABLES or ref in SQL or ref in _GENERATED


def _oracle_text(name: str) -> str:
    return ORACLE_SQL.get(name) or SQL[name]


def oracle_ctes(*names: str) -> list[str]:
    """CTE definitions for ``names`` and everything they derive from, inputs first."""
    ordered: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in ordered:
            return
        text = _oracle_text(name)
        for ref in _REF.findall(text):
            if _is_table(ref):
                visit(ref)
        ordered[name] = _REF.sub(lambda m: m[1] if _is_table(m[1]) else m[0], text)

    for n in names:
        visit(n)
    # Unmaterialised by default; DuckDB decides per reference count.
    return [f"{n} AS ({t.strip()})" for n, t in ordered.items()]

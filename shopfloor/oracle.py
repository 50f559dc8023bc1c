"""Independent SQL for every query, run by DuckDB on the same tables.

The SQL spells each result out the plain way: self-joins, inequality joins and one branch
per report section. The Spark side computes the same rows by other means.
"""

from __future__ import annotations

from shopfloor.bindings import oracle_ctes

_ORACLE: dict[str, tuple[tuple[str, ...], tuple[tuple[str, str], ...], str]] = {}


def _add(name: str, tables: tuple[str, ...], steps: tuple[tuple[str, str], ...], final: str) -> None:
    _ORACLE[name] = (tables, steps, final)


def oracle_sql() -> dict[str, str]:
    result = {}
    for name, (tables, steps, final) in _ORACLE.items():
        ctes = oracle_ctes(*tables) + [f"{n} AS ({t.strip()})" for n, t in steps]
        result[name] = ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + final.strip()
    return result


def _r2(x: str, scale: int = 2) -> str:
    """Round half away from zero, on eight places of a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(30,8)), {scale}) AS DECIMAL(18,{scale}))"


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


# --- products -------------------------------------------------------------------------
_SERVICE = "('OPR','CBE','CLE','CLR','CRC','DPS','GWP','JPO','LCE','MOD','OPU','P3P','PCE','PCI','PCO','PEM','PRS','PVI','VCH','VIO','VPB','VPO','VPU')"

_SKU = (
    (
        "shaped",
        f"""
SELECT id, code, style AS rs, style_color AS rc, size AS rz, upc_code,
  CASE WHEN style LIKE 'OC%' AND length(style) IN (12, 14) AND strpos(style, '*') = 0 THEN 'oc'
       WHEN style LIKE 'OC%' AND length(style) = 12 AND strpos(style, '*') > 0 THEN 'oc12'
       WHEN style LIKE 'OC%' AND length(style) = 13 AND strpos(style, '*') > 0 THEN 'oc13'
       WHEN left(style, 4) IN ('CPN-', 'DPS_', 'F&F_') THEN 'coupon'
       WHEN left(style, 3) IN {_SERVICE} THEN 'service'
       WHEN substring(style, 7, 3) = 'DUM' THEN 'dummy'
       WHEN left(style, 2) IN ('FF', 'FS', 'GW', 'IR') THEN 'gift'
       WHEN left(style, 2) = 'FL' THEN 'fl' ELSE 'other' END AS shape
FROM product_sku""",
    ),
    (
        "parsed",
        """
SELECT id AS sku_id, code AS sku_code,
  trim(replace(CASE shape WHEN 'oc' THEN left(rs, 6) WHEN 'oc12' THEN substring(rs, 3, 3) WHEN 'oc13' THEN substring(rs, 3, 4)
    WHEN 'coupon' THEN substring(rs, 5, 5) WHEN 'fl' THEN substring(rs, 3, 6) WHEN 'other' THEN rs ELSE left(rs, 6) END, '_', '')) AS style,
  trim(replace(CASE WHEN shape IN ('oc', 'service', 'gift') THEN substring(rs, 7, 5) WHEN shape = 'coupon' THEN substring(rs, 11, 5)
    WHEN coalesce(rc, '') <> '' THEN substring(rc, length(rs) + 1)
    ELSE translate(CASE WHEN coalesce(rz, '') <> '' THEN left(code, length(code) - length(rz)) ELSE code END, coalesce(rs, ''), '') END, '_', '')) AS color,
  CASE WHEN coalesce(rz, '') <> '' THEN rz WHEN shape IN ('oc', 'service', 'gift') THEN substring(rs, 12) WHEN shape = 'coupon' THEN substring(rs, 17)
    WHEN shape = 'dummy' THEN substring(rs, 7) ELSE rz END AS size,
  nullif(upc_code, '0') AS upc
FROM shaped""",
    ),
)
_add("sku_parse", ("product_sku",), _SKU, "SELECT * FROM parsed")

_RESOLVE = (
    *_SKU,
    (
        "catalogue",
        """SELECT product_id, trim(replace(sty_code, '_', '')) AS st, color_code AS co, sz_code AS sz, upc_code AS up,
  replace(replace(sku, ' ', ''), '_', '') AS sk FROM product WHERE brand_code = 'B1'""",
    ),
    (
        "hits",
        """
SELECT sku_id, 1 AS tier, product_id FROM parsed JOIN catalogue ON upc = up
UNION ALL SELECT sku_id, 2, product_id FROM parsed JOIN catalogue ON style = st AND color = co AND size = sz
UNION ALL SELECT sku_id, 3, product_id FROM parsed JOIN catalogue ON style = st AND color = co
UNION ALL SELECT sku_id, 4, product_id FROM parsed JOIN catalogue ON style = st
UNION ALL SELECT sku_id, 5, product_id FROM parsed JOIN catalogue ON replace(replace(sku_code, ' ', ''), '_', '') = sk""",
    ),
    (
        "winner",
        """SELECT sku_id, tier, min(product_id) AS product_id FROM hits
WHERE (sku_id, tier) IN (SELECT sku_id, min(tier) FROM hits GROUP BY 1) GROUP BY 1, 2""",
    ),
    (
        "sku_lookup",
        """SELECT p.*, coalesce(w.product_id, -9999) AS product_id, coalesce(w.tier, 6) AS match_int
FROM parsed p LEFT JOIN winner w ON p.sku_id = w.sku_id""",
    ),
)
_add("sku_match_cascade", ("product_sku", "product"), _RESOLVE, "SELECT * FROM sku_lookup")

# --- customers ------------------------------------------------------------------------
_add(
    "latest_customer_type",
    ("type_history",),
    (),
    """SELECT customer_id, upgrade_date_time FROM (
  SELECT customer_id, upgrade_date_time, row_number() OVER (PARTITION BY customer_id ORDER BY upgrade_date_time DESC NULLS FIRST) AS rn
  FROM type_history WHERE brand_code = 'Main') WHERE rn = 1""",
)
_PROFILE = (
    (
        "profile_rows",
        """
SELECT c.customer_id, c.birth_year, c.gender_code, t.code AS type_code,
  coalesce(CASE WHEN p.country_code = 'OTHERS' THEN NULL ELSE p.country_code END, c.exact_country) AS residence, h.upgrade_date_time
FROM (SELECT * FROM crm_customer WHERE brand_code = 'Main') c
LEFT JOIN (SELECT * FROM type_history WHERE brand_code = 'Main') h ON h.customer_id = c.customer_id
LEFT JOIN type_code t ON t.code = c.customer_type
LEFT JOIN (SELECT * FROM customer_address WHERE brand_code = 'Main') a ON a.customer_id = c.customer_id
LEFT JOIN province p ON p.code = a.province_code""",
    ),
    (
        "profile_ranked",
        """SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY upgrade_date_time DESC NULLS FIRST, residence NULLS FIRST,
  birth_year NULLS FIRST, gender_code NULLS FIRST, type_code NULLS FIRST) AS rn FROM profile_rows""",
    ),
    (
        "flagged",
        """SELECT r.customer_id, r.birth_year, r.gender_code, c.country_code AS residence_country,
  max(CASE WHEN rn = 1 AND type_code = 'O' THEN 2 WHEN type_code = 'O' THEN 1 ELSE 0 END) AS emp_flag
FROM profile_ranked r LEFT JOIN residence_country c ON c.residence_country = r.residence GROUP BY 1, 2, 3, 4""",
    ),
)
_PROFILE_TABLES = ("crm_customer", "type_history", "type_code", "customer_address", "province", "residence_country")
_add("employee_flag", _PROFILE_TABLES, _PROFILE, "SELECT * FROM flagged")
_add(
    "customer_profile",
    _PROFILE_TABLES,
    _PROFILE,
    """SELECT customer_id, birth_year, gender_code AS gender, residence_country,
  CASE emp_flag WHEN 2 THEN 'E' WHEN 1 THEN 'F' END AS employee_status_code FROM flagged""",
)

# --- transactions ---------------------------------------------------------------------
_add("scan_filter", (), (), "SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand = 'Brand#7'")

_MARKET_ARMS = {
    "('China', 'CHN')": ("CNY", "CN", 4),
    "('HKG', 'Hong Kong')": ("HKD", "HK", 5),
    "('MAC', 'Macau')": ("MOP", "MO", 13),
    "('SGP', 'Singapore')": ("SGD", "SG", 9),
    "('MYS', 'Malaysia')": ("MYR", "MY", 8),
    "('TWN', 'Taiwan')": ("TWD", "TW", 11),
    "('KOR', 'Korea')": ("KRW", "KR", 7),
}


def _by_market(i: int) -> str:
    quote = (lambda v: str(v)) if i == 2 else (lambda v: f"'{v}'")
    return "CASE " + " ".join(f"WHEN n.nationality_code IN {k} THEN {quote(v[i])}" for k, v in _MARKET_ARMS.items()) + " END"


_BASE = (
    *_RESOLVE,
    (
        "base",
        """
SELECT h.id AS txn_nbr, h.purchase_code AS pur_code, CAST(h.txn_datetime AS DATE) AS txn_date, h.txn_datetime,
  coalesce(h.customer_id, '-1') AS customer_id, CAST(abs(d.local_txn_amount) AS DECIMAL(10,2)) AS local_item_net_amt, d.usd_txn_amount,
  CASE WHEN d.item_sold_qty = 0 THEN 0 ELSE abs(d.local_txn_amount) / CAST(CAST(abs(d.item_sold_qty) AS DECIMAL(10,2)) AS DOUBLE) END AS local_aur,
  CAST(abs(d.item_sold_qty) AS DECIMAL(10,2)) AS item_sold_qty, h.counter_code, s.sku_id, s.sku_code, s.product_id, d.retail_price, d.return_flag
FROM transaction_hdr h JOIN transaction_dtl d ON d.purchase_code = h.purchase_code JOIN sku_lookup s ON s.sku_code = d.sku_code
WHERE coalesce(d.local_txn_amount, 0) <> 0 AND coalesce(d.item_sold_qty, 0) <> 0""",
    ),
)
_BASE_TABLES = ("product_sku", "product", "transaction_hdr", "transaction_dtl")
_NUMERIC = "local_item_net_amt, usd_txn_amount, item_sold_qty, retail_price".split(", ")
_as_double = lambda *names: ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)
_add("txn_base", _BASE_TABLES, _BASE, f"SELECT * REPLACE ({_as_double(*_NUMERIC)}) FROM base")

_counters = "(SELECT DISTINCT code, counter_category_code, nationality_code FROM counter) n"
_PRODUCT_OUT = (
    "p.dept_code, p.dept_desc, p.sty_code, p.color_code, p.collect_desc, p.silhouette_desc, p.handbag_sz, p.sz_code, p.class_desc, "
    "p.signature_type_desc, p.signature_type_mbr_desc, p.fact_type, p.sty_grp, p.sty_long_desc, p.mtrl_desc AS material, p.mtrl_code, p.color_grp"
)
_ENRICHED = (
    *_BASE,
    (
        "enriched",
        f"""
SELECT b.*, b.txn_nbr || '_' || b.sku_id || '_' || b.return_flag AS txn_item_line_nbr,
  CASE WHEN g.group_code IN (3, 4) THEN 'RETAIL' WHEN g.id = 8 THEN 'OUTLET' WHEN g.id = 100 THEN 'WHOLESALE' ELSE '-1' END AS src_channel_code,
  CASE WHEN n.code LIKE '%OCE%' OR n.code = 'OCW11' THEN 'ONLINE' ELSE 'STORE' END AS src_sub_channel_code,
  CASE WHEN b.return_flag = 0 THEN '1' ELSE '2' END AS sale_credit_code, 'CS2K' AS source_code, 'ACX' AS cdi_source,
  CASE WHEN b.retail_price > coalesce(l.price, -1) THEN b.retail_price ELSE l.price END AS local_msrp,
  {_by_market(0)} AS local_currency, {_by_market(1)} AS country_code, n.code AS store_nbr, {_PRODUCT_OUT},
  CASE WHEN p.product_identity = 'Product Identity Retail Derived' THEN 1 ELSE 0 END AS retail_derived,
  CASE WHEN p.fact_type NOT LIKE '%Factory Exclusive%' AND NOT coalesce(g.group_code IN (3, 4), false) AND g.id = 8 THEN 1 ELSE 0 END AS retail_delete,
  CASE WHEN p.mtrl_desc LIKE '%Exotics%' THEN 1 ELSE 0 END AS exotics,
  CASE WHEN p.spcl_product_mbr_desc LIKE '%Novelty%' THEN 1 ELSE 0 END AS novelty,
  CASE WHEN p.dept_code = 'D01' THEN '1.Womens Bag' WHEN p.dept_code IN ('D02', 'D03', 'D22', 'D23') THEN '2.Womens Accessories'
    WHEN p.dept_code = 'D11' THEN '3.Womens Footwear' WHEN p.dept_code = 'D07' THEN '4.Womens RTW'
    WHEN p.dept_code IN ('D06', 'D09', 'D12', 'D13', 'D14', 'D15', 'D17', 'N/A') THEN '5.Womens Other'
    WHEN p.dept_code IN ('D04', 'D05', 'D08', 'D10', 'D16', 'D18', 'D19', 'D20', 'D21') THEN '6.Mens' ELSE '7.Other' END AS category,
  CASE WHEN g.group_code IN (3, 4) AND (p.sty_long_desc LIKE '%1941%' OR p.collect_desc LIKE '%1941%') THEN 1 ELSE 0 END AS flag_1941
FROM base b JOIN {_counters} ON n.code = b.counter_code JOIN counter_category g ON g.code = n.counter_category_code
LEFT JOIN product p ON p.product_id = b.product_id AND b.product_id <> -9999
LEFT JOIN price_list l ON l.product_key = b.product_id AND b.txn_date BETWEEN l.start_date AND l.end_date AND l.price_list_key = {_by_market(2)}""",
    ),
)
_ENRICHED_TABLES = (*_BASE_TABLES, "counter", "counter_category", "price_list")
_add("txn_enriched", _ENRICHED_TABLES, _ENRICHED, f"SELECT * REPLACE ({_as_double(*_NUMERIC, 'local_msrp')}) FROM enriched")
_add(
    "banded_price_lookup",
    _ENRICHED_TABLES,
    _BASE,
    f"""SELECT b.txn_nbr, b.sku_id, b.product_id, b.txn_date, {_by_market(2)} AS price_list_key, {_d('b.retail_price')} AS retail_price, {_d('l.price')} AS list_price
FROM base b JOIN (SELECT DISTINCT code, nationality_code FROM counter) n ON n.code = b.counter_code
LEFT JOIN price_list l ON l.product_key = b.product_id AND b.txn_date BETWEEN l.start_date AND l.end_date AND l.price_list_key = {_by_market(2)}""",
)
_add(
    "banded_cost_latest",
    (*_BASE_TABLES, "product_cost"),
    _BASE,
    f"""SELECT b.txn_nbr, b.sku_id, b.product_id, b.txn_date, {_d('''(SELECT arg_max(l.curr_std_cst_usd, l.start_date) FROM product_cost l
  WHERE l.product_key = b.product_id AND b.txn_date BETWEEN l.start_date AND l.end_date)''')} AS cost FROM base b""",
)
_add(
    "fiscal_keys_by_day",
    ("calendar",),
    (),
    """SELECT c.*, fisc_year_num * 100 + fisc_quarter_num AS fisc_year_quarter, fisc_year_num * 100 + fisc_month_num AS fisc_year_month,
  fisc_year_num * 100 + fisc_week_of_year_num AS fisc_year_week, fisc_year_num * 1000 + fisc_year_day_num AS fisc_year_day
FROM calendar c WHERE calendar_date IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
)

_net = "CAST(e.local_item_net_amt AS DOUBLE)"
_in_usd = lambda x: f"CAST({x} AS DOUBLE) / coalesce(CAST(t.tax_rate AS DOUBLE), 1) / CAST(g.peg_rate AS DOUBLE)"
_ratio = f"(coalesce({_net}, 0) / CAST(e.item_sold_qty AS DOUBLE) / CAST(nullif(e.local_msrp, 0) AS DOUBLE))"
_USD = (
    *_ENRICHED,
    (
        "usd0",
        f"""
SELECT e.*, CASE WHEN g.peg_rate IS NOT NULL THEN {_in_usd('e.local_msrp')} END AS usd_msrp,
  CAST(CASE WHEN g.peg_rate IS NULL THEN e.usd_txn_amount ELSE {_r2(_in_usd('e.local_item_net_amt'))} END AS DECIMAL(15,2)) AS usd_item_net_amt,
  CASE WHEN coalesce(e.item_sold_qty, 0) = 0 THEN -1 WHEN coalesce(e.local_msrp, 0) = 0 THEN 0 WHEN {_ratio} <= 0.9 THEN 1 ELSE 0 END AS discount_flag,
  CASE WHEN coalesce(e.local_msrp, 0) = 0 THEN 0 ELSE (1 - {_ratio}) * 100 END AS discount_pct,
  c.fisc_year_num, c.fisc_year_day_num, c.fisc_year_num * 100 + c.fisc_quarter_num AS fisc_year_quarter, c.fisc_year_num * 100 + c.fisc_month_num AS fisc_year_month,
  c.fisc_year_num * 100 + c.fisc_week_of_year_num AS fisc_year_week, c.fisc_year_num * 1000 + c.fisc_year_day_num AS fisc_year_day
FROM enriched e JOIN calendar c ON c.calendar_date = e.txn_date
LEFT JOIN peg_rate g ON g.fisc_year_num = c.fisc_year_num AND g.currency = e.local_currency
  AND c.fisc_year_day_num BETWEEN g.start_day_num AND CASE WHEN g.end_day_num = 364 THEN 371 ELSE g.end_day_num END
LEFT JOIN tax_rate t ON e.txn_date BETWEEN t.start_date AND t.end_date AND t.country_code = e.country_code
WHERE e.country_code IN ('CN', 'HK', 'MO', 'TW') AND e.store_nbr NOT IN
  ('OCE23', 'OCE25', 'OCE27', 'OCE37', 'OCE43', 'OCE44', 'OCE45', 'OCE47', 'OCE62', 'OCE63', 'OCE64', 'OCE68')""",
    ),
    (
        "usd",
        f"""SELECT *, CAST(CASE WHEN item_sold_qty = 0 THEN 0
  ELSE {_r2('CAST(usd_item_net_amt AS DOUBLE) / abs(CAST(item_sold_qty AS DOUBLE))')} END AS DECIMAL(15,2)) AS usd_aur FROM usd0""",
    ),
)
_USD_TABLES = (*_ENRICHED_TABLES, "calendar", "peg_rate", "tax_rate")
_add(
    "fx_peg_tax",
    _USD_TABLES,
    _USD,
    f"""SELECT txn_nbr, txn_item_line_nbr, {_as_double('item_sold_qty', 'local_item_net_amt', 'usd_item_net_amt', 'usd_aur')}, local_currency, country_code,
  round(usd_msrp, 6) AS usd_msrp, fisc_year_num, fisc_year_quarter, fisc_year_month, fisc_year_week, fisc_year_day FROM usd""",
)
_add(
    "discount_flags",
    _USD_TABLES,
    _USD,
    f"""SELECT discount_flag, fisc_year_num, count(*) AS line_count, {_d('sum(CAST(discount_pct AS DECIMAL(18,4)))')} AS sum_discount_pct
FROM usd GROUP BY 1, 2""",
)
_shifted = "(SELECT fisc_year_num FROM shifted_years)"
_STORE = (
    *_USD,
    (
        "fact",
        f"""
SELECT u.*, o.location_id, o.door_desc AS location_desc, o.region_desc, o.district_desc, o.city, o.state,
  c.fisc_year_num AS comp_year_ty, coalesce(x.comp_category_desc, 'NON-COMP') AS comp_ind_ty,
  c.fisc_year_num + 1 AS comp_year_ly, coalesce(y.comp_category_desc, 'NON-COMP') AS comp_ind_ly
FROM usd u
LEFT JOIN location o ON o.door_code = u.country_code || u.store_nbr AND upper(o.store_nbr) NOT LIKE '%VIRTUAL%'
  AND o.sap_site_id <> 'N/A' AND o.location_id <> 1256736
LEFT JOIN calendar c ON c.calendar_date = u.txn_date
LEFT JOIN (SELECT *, fisc_year_num IN {_shifted} AS shifted, fisc_year_num - 1 IN {_shifted} AS was_shifted FROM calendar) k ON k.calendar_date = u.txn_date
LEFT JOIN comparable_bands x ON x.year_mode = 'TY' AND x.sap_site_id = o.sap_site_id AND x.cal_year_num = k.fisc_year_num
  AND k.fisc_year_day_num BETWEEN x.start_day_num AND x.end_day_num AND x.cal_key = CASE WHEN k.was_shifted THEN 4 ELSE 1 END
LEFT JOIN comparable_bands y ON y.year_mode = 'LY' AND y.sap_site_id = o.sap_site_id AND y.cal_year_num = k.fisc_year_num
  AND CASE WHEN k.shifted THEN k.fisc_year_day_num - 7 ELSE k.fisc_year_day_num END BETWEEN y.start_day_num AND y.end_day_num
  AND y.cal_key = CASE WHEN k.shifted THEN 4 ELSE 1 END""",
    ),
)
_STORE_TABLES = (*_USD_TABLES, "location", "comparable_bands", "shifted_years")
_add(
    "comparable_store",
    _STORE_TABLES,
    _STORE,
    f"""SELECT txn_nbr, txn_item_line_nbr, {_as_double('item_sold_qty', 'local_item_net_amt')}, location_id, location_desc, region_desc,
  comp_year_ty, comp_ind_ty, comp_year_ly, comp_ind_ly FROM fact""",
)


def _order_steps(prefix: str, condition: str) -> tuple[tuple[str, str], ...]:
    """Order numbers by ranks and a self-join on the previous dense rank."""
    return (
        (
            f"{prefix}_ranked",
            f"""
SELECT *, min(moment) OVER (PARTITION BY customer_id) AS first_at, dense_rank() OVER w AS drn, rank() OVER w AS rn
FROM (SELECT customer_id, txn_nbr, min(txn_datetime) AS moment FROM fact
      WHERE customer_id <> '-1' AND country_code IN ('CN', 'HK', 'MO', 'TW') AND coalesce(local_item_net_amt, 0) <> 0 AND {condition} GROUP BY 1, 2)
WINDOW w AS (PARTITION BY customer_id ORDER BY moment)""",
        ),
        (
            f"{prefix}_order",
            f"""
SELECT a.customer_id, a.txn_nbr, a.first_at AS cust_first_txn_date, b.moment AS cust_prev_txn_datetime,
  CAST(a.moment AS DATE) - CAST(b.moment AS DATE) AS days_since_cust_prev_txn, a.rn, a.drn
FROM {prefix}_ranked a LEFT JOIN (SELECT DISTINCT customer_id, drn, moment FROM {prefix}_ranked) b ON b.customer_id = a.customer_id AND b.drn = a.drn - 1""",
        ),
    )


_TXN_ORDER = _order_steps("any", "true")
_PUR_ORDER = _order_steps("sale", "sale_credit_code = '1'")
_FIRST = (
    (
        "sales",
        """SELECT DISTINCT customer_id, txn_nbr, txn_date FROM fact WHERE customer_id <> '-1' AND sale_credit_code = '1'
  AND country_code IN ('CN', 'HK', 'MO', 'TW') AND coalesce(local_item_net_amt, 0) <> 0""",
    ),
    (
        "first_day",
        """SELECT DISTINCT s.customer_id, s.txn_nbr FROM sales s
JOIN (SELECT customer_id, min(txn_date) AS d FROM sales GROUP BY 1) f ON f.customer_id = s.customer_id AND f.d = s.txn_date""",
    ),
)
_add("txn_order", _STORE_TABLES, (*_STORE, *_TXN_ORDER), "SELECT * FROM any_order")
_add(
    "bucketed_orders",
    _STORE_TABLES,
    (*_STORE, *_TXN_ORDER),
    f"""SELECT b.txn_nbr, o.customer_id, o.rn, b.sku_id, {_d("b.item_sold_qty")} AS item_sold_qty, {_d("b.local_item_net_amt")} AS local_item_net_amt
FROM any_order o JOIN base b ON b.txn_nbr = o.txn_nbr""",
)
_add("purchase_order", _STORE_TABLES, (*_STORE, *_PUR_ORDER), "SELECT * FROM sale_order")
_add("first_purchase_txns", _STORE_TABLES, (*_STORE, *_FIRST), "SELECT * FROM first_day")

_signed = lambda col: f"{_d(f'''CASE WHEN f.sale_credit_code = '2' THEN -{_r2(f'abs(f.{col})')} ELSE {_r2(f'abs(f.{col})')} END''')} AS {col}"
_unit = "(abs(CAST(f.usd_item_net_amt AS DOUBLE)) / abs(CAST(f.item_sold_qty AS DOUBLE)))"
_add(
    "txn_final",
    (*_STORE_TABLES, "product_cost"),
    (*_STORE, *_TXN_ORDER, *_PUR_ORDER, *_FIRST),
    f"""SELECT DISTINCT coalesce(b.customer_id, f.customer_id) AS customer_id, tf.cust_first_txn_date, pf.cust_first_pur_date,
  CASE WHEN d.txn_nbr IS NOT NULL THEN 1 ELSE 0 END AS cust_first_pur_dt_txns_flag,
  b.rn AS customer_txn_num, CASE WHEN b.drn = 1 THEN 1 ELSE 0 END AS cust_first_txn, b.cust_prev_txn_datetime, b.days_since_cust_prev_txn,
  c.rn AS customer_pur_num, CASE WHEN c.drn = 1 THEN 1 ELSE 0 END AS cust_first_pur, c.cust_prev_txn_datetime AS cust_prev_pur_datetime,
  c.days_since_cust_prev_txn AS days_since_cust_prev_pur,
  f.cdi_source, CAST(f.txn_nbr AS VARCHAR) AS txn_nbr, f.pur_code, f.txn_item_line_nbr, f.txn_date, f.txn_datetime, f.src_channel_code, f.src_sub_channel_code,
  CASE f.src_channel_code || '/' || f.src_sub_channel_code WHEN 'RETAIL/STORE' THEN 'RETAIL' WHEN 'RETAIL/ONLINE' THEN 'ECOM' WHEN 'OUTLET/STORE' THEN 'OUTLET'
    WHEN 'OUTLET/ONLINE' THEN 'EOS' WHEN 'WHOLESALE/ONLINE' THEN 'WHOLESALE ECOM' END AS channel_name,
  f.sale_credit_code, f.source_code, {_d("CASE WHEN f.sale_credit_code = '1' THEN f.item_sold_qty ELSE -1 * f.item_sold_qty END")} AS item_sold_qty,
  {_d(_r2('f.local_msrp'))} AS local_msrp, {_signed('local_item_net_amt')}, {_signed('local_aur')}, f.local_currency, {_d(_r2('f.usd_msrp'))} AS usd_msrp,
  {_signed('usd_item_net_amt')}, {_signed('usd_aur')},
  {_d("CASE WHEN f.sale_credit_code = '2' THEN -1 * k.curr_std_cst_usd ELSE k.curr_std_cst_usd END")} AS usd_auc,
  {_d(f"CASE WHEN f.item_sold_qty > 0 AND f.usd_item_net_amt > 0 THEN {_r2(f'({_unit} - CAST(k.curr_std_cst_usd AS DOUBLE)) / {_unit}')} * 100 END")} AS gross_margin,
  f.discount_flag, {_d(_r2('f.discount_pct'))} AS discount_pct, -1 AS pos_porter_flag, f.location_id, f.country_code, f.store_nbr,
  CASE WHEN f.store_nbr = 'OCW11' THEN 'VIPWHOLESALE' ELSE f.location_desc END AS location_desc, f.region_desc, f.district_desc, f.city, f.state,
  f.product_id, {_PRODUCT_OUT.replace('p.mtrl_desc AS material', 'f.material').replace('p.', 'f.')},
  f.category, f.retail_derived, f.retail_delete, f.exotics, f.novelty, f.flag_1941,
  f.fisc_year_num, f.fisc_year_quarter, f.fisc_year_month, f.fisc_year_week, f.fisc_year_day, f.comp_year_ty, f.comp_ind_ty, f.comp_year_ly, f.comp_ind_ly
FROM fact f
LEFT JOIN first_day d ON d.customer_id = f.customer_id AND d.txn_nbr = f.txn_nbr
LEFT JOIN any_order b ON b.txn_nbr = f.txn_nbr
LEFT JOIN sale_order c ON c.txn_nbr = f.txn_nbr
LEFT JOIN product_cost k ON k.product_key = f.product_id AND f.txn_date BETWEEN k.start_date AND k.end_date
LEFT JOIN (SELECT DISTINCT customer_id, cust_first_txn_date FROM any_order) tf ON tf.customer_id = b.customer_id
LEFT JOIN (SELECT DISTINCT customer_id, cust_first_txn_date AS cust_first_pur_date FROM sale_order) pf ON pf.customer_id = b.customer_id""",
)

# --- chat reach -----------------------------------------------------------------------
_STAFF = (
    (
        "staff",
        """SELECT DISTINCT user_id, name, local_name, store_nbr, counter_type_code, region, region_detail FROM associate_customer
WHERE sa_status IN ('0', '1', '4') AND local_name NOT IN ('TW EDA (Temp Store)_OCF23')""",
    ),
)
_START = (
    (
        "opening",
        """SELECT min(add_date) AS fy_start_date, max(CAST('20' || substring(fisc_year, 3, 2) AS INT)) AS year FROM associate_customer
WHERE CAST('20' || substring(fisc_year, 3, 2) AS INT) = (SELECT CAST('20' || substring(max(fisc_year), 3, 2) AS INT) FROM associate_customer)""",
    ),
)


def _adds_sql(key: str) -> tuple[str, str]:
    return (
        "adds",
        f"""SELECT add_date, user_id, card_type_new, count(DISTINCT work_external_user_id) AS people FROM associate_customer
WHERE user_id IS NOT NULL AND add_rank = 1 AND add_date > DATE '1970-01-01' {key} GROUP BY 1, 2, 3""",
    )


def _amounts_sql(key: str) -> tuple[tuple[str, str], ...]:
    return (
        (
            "won",
            f"""SELECT txn_date, user_id_txn AS user_id, card_type_new, sum(demand) AS successful_sales_amount FROM (
  SELECT DISTINCT work_external_user_id, customer_id, card_type_new, txn_nbr, txn_date, user_id_txn, demand
  FROM associate_customer WHERE user_id_txn IS NOT NULL {key}) GROUP BY 1, 2, 3""",
        ),
        (
            "spent",
            f"""SELECT txn_date, user_id, card_type_new, sum(demand) AS consumption_amount FROM (
  SELECT DISTINCT work_external_user_id, user_id, name, txn_date, txn_nbr, card_type_new, demand
  FROM associate_customer WHERE user_id IS NOT NULL {key}) GROUP BY 1, 2, 3""",
        ),
        (
            "amounts",
            """SELECT * FROM (SELECT coalesce(w.txn_date, s.txn_date) AS txn_date, coalesce(w.user_id, s.user_id) AS user_id,
  coalesce(w.card_type_new, s.card_type_new) AS card_type_new, w.successful_sales_amount, s.consumption_amount
FROM won w FULL OUTER JOIN spent s ON w.txn_date = s.txn_date AND w.user_id = s.user_id AND w.card_type_new = s.card_type_new) WHERE txn_date IS NOT NULL""",
        ),
    )


_RECEIVERS = (
    (
        "receivers",
        """SELECT k.work_external_user_id, c.openid, k.customer_id, k.card_type_new
FROM (SELECT DISTINCT work_external_user_id, card_type_new, customer_id FROM associate_customer) k
LEFT JOIN (SELECT DISTINCT openid, id, customer_id FROM contact) c ON c.id = k.work_external_user_id""",
    ),
)
_ADDS, _AMOUNTS = _adds_sql(""), _amounts_sql("")
_CLIENTS = ("associate_customer",)
_money2 = _as_double("successful_sales_amount", "consumption_amount")
_add("associates", _CLIENTS, _STAFF, "SELECT * FROM staff")
_add("receiver_map", ("associate_customer", "contact"), _RECEIVERS, "SELECT * FROM receivers")
_add("fiscal_year_start", _CLIENTS, _START, "SELECT * FROM opening")
_add("adds_distinct", _CLIENTS, (_ADDS,), "SELECT * FROM adds")
_add("sales_dedup_sum", _CLIENTS, _AMOUNTS[:1], f"SELECT * REPLACE ({_as_double('successful_sales_amount')}) FROM won")
_add("amount_full_outer", _CLIENTS, _AMOUNTS, f"SELECT * REPLACE ({_money2}) FROM amounts")
_add(
    "semi_senders",
    ("associate_customer", "chat_message"),
    _STAFF,
    "SELECT * FROM chat_message WHERE sender_external_userid IN (SELECT user_id FROM staff)",
)
_add(
    "anti_receivers",
    ("associate_customer", "chat_message"),
    _STAFF,
    "SELECT * FROM chat_message WHERE receiver_external_userid NOT IN (SELECT user_id FROM staff WHERE user_id IS NOT NULL)",
)

_MESSAGES = (
    *_STAFF,
    *_START,
    (
        "messages",
        """SELECT DISTINCT sender_external_userid AS sender, receiver_external_userid AS receiver, CAST(msgtime AS TIMESTAMP) AS msgtime,
  CAST(CAST(msgtime AS TIMESTAMP) AS DATE) AS msg_date
FROM chat_message, opening
WHERE split_part(msgtime, ' ', 2) BETWEEN '10:00:00' AND '22:00:00' AND brand_code = 'Main'
  AND sender_external_userid IN (SELECT user_id FROM staff) AND (sender_external_userid <> '' OR receiver_external_userid <> '')
  AND receiver_external_userid NOT IN (SELECT user_id FROM staff WHERE user_id IS NOT NULL)
  AND CAST(CAST(msgtime AS TIMESTAMP) AS DATE) >= fy_start_date""",
    ),
)
_MARKERS = (
    "markers",
    """SELECT sender, receiver, msg_date, msgtime, CASE WHEN lag(msgtime) OVER w IS NULL OR date_diff('minute', lag(msgtime) OVER w, msgtime) > 60
  THEN 1 ELSE 0 END AS is_new_session FROM messages WINDOW w AS (PARTITION BY sender, receiver, msg_date ORDER BY msgtime)""",
)


def _fiscal(source: str) -> tuple[str, str]:
    join = lambda a, code: f"LEFT JOIN calendar_period {a} ON d.msg_date BETWEEN {a}.start_date AND {a}.end_date AND {a}.time_period_code = '{code}'"
    return (
        "fiscal",
        f"""SELECT d.msg_date, w.time_period AS fiscal_week, m.time_period AS fiscal_month, q.time_period AS fiscal_quarter, y.time_period AS fiscal_year
FROM (SELECT DISTINCT msg_date FROM {source}) d {join('w', 'Week')} {join('m', 'Month')} {join('q', 'Quarter')} {join('y', 'Year')}""",
    )


_ORG_COLUMNS = "name, local_name, store_nbr, counter_type_code, region, region_detail"
_SESSIONS = (
    *_MESSAGES,
    _MARKERS,
    *_RECEIVERS,
    _fiscal("markers"),
    (
        "sessions",
        f"""SELECT m.msg_date, f.fiscal_week, f.fiscal_month, f.fiscal_quarter, f.fiscal_year, m.sender, {_ORG_COLUMNS}, m.receiver,
  r.work_external_user_id, r.card_type_new, CAST(sum(is_new_session) AS BIGINT) AS is_session, CASE WHEN sum(is_new_session) >= 2 THEN 1 ELSE 0 END AS is_quality_session
FROM markers m LEFT JOIN staff s ON s.user_id = m.sender LEFT JOIN receivers r ON r.openid = m.receiver LEFT JOIN fiscal f ON f.msg_date = m.msg_date
GROUP BY ALL""",
    ),
)
_CURRENT = (
    "newest",
    """SELECT fiscal_year AS current_year, max(fiscal_quarter) AS current_quarter, max(fiscal_month) AS current_month, max(fiscal_week) AS current_week,
  max(msg_date) AS max_msg_date FROM sessions GROUP BY 1""",
)
_CHAT = ("associate_customer", "contact", "chat_message", "calendar_period")
_add("message_filter", ("associate_customer", "chat_message"), _MESSAGES, "SELECT * FROM messages")
_add("session_markers", ("associate_customer", "chat_message"), (*_MESSAGES, _MARKERS), "SELECT * FROM markers")
_add(
    "fiscal_periods",
    ("chat_message", "calendar_period"),
    (("stamped", "SELECT CAST(substring(msgtime, 1, 10) AS DATE) AS msg_date FROM chat_message"), _fiscal("stamped")),
    "SELECT * FROM fiscal",
)
_add("session_counts", _CHAT, _SESSIONS, "SELECT * FROM sessions")
_add("current_period", _CHAT, (*_SESSIONS, _CURRENT), "SELECT * FROM newest")
_add(
    "period_to_current",
    _CHAT,
    (*_SESSIONS, _CURRENT),
    """SELECT fiscal_week, count(*) AS session_rows, CAST(sum(is_session) AS BIGINT) AS sessions FROM sessions JOIN newest ON fiscal_week <= current_week GROUP BY 1""",
)
_add(
    "people_as_of",
    _CHAT,
    (*_SESSIONS, _ADDS),
    """SELECT d.user_id, d.card_type_new, d.msg_date, count(a.user_id) AS add_rows, CAST(coalesce(sum(a.people), 0) AS BIGINT) AS people
FROM (SELECT DISTINCT sender AS user_id, card_type_new, msg_date FROM sessions WHERE card_type_new IS NOT NULL) d
LEFT JOIN adds a ON a.user_id = d.user_id AND a.card_type_new = d.card_type_new AND a.add_date <= d.msg_date GROUP BY 1, 2, 3""",
)
_add(
    "reach_counts",
    _CHAT,
    _SESSIONS,
    """SELECT sender, CAST(sum(is_session) AS BIGINT) AS sessions, CAST(sum(is_quality_session) AS BIGINT) AS quality_sessions,
  count(DISTINCT CASE WHEN is_session >= 1 THEN receiver END) AS session_people,
  count(DISTINCT CASE WHEN is_quality_session = 1 THEN receiver END) AS quality_people FROM sessions GROUP BY 1""",
)
_add(
    "union_branches",
    ("associate_customer", "chat_message"),
    (*_MESSAGES, _MARKERS),
    """SELECT 'sender' AS level, sender AS party, CAST(sum(is_new_session) AS BIGINT) AS sessions FROM markers GROUP BY 1, 2
UNION ALL SELECT 'receiver', receiver, CAST(sum(is_new_session) AS BIGINT) FROM markers GROUP BY 1, 2
UNION ALL SELECT 'all', '', CAST(sum(is_new_session) AS BIGINT) FROM markers""",
)

_CLASS = "CASE WHEN t.card_type_new IN ('DIAMOND,', 'GOLD', 'Regular', 'SILVER') THEN 2 WHEN t.card_type_new = 'Non-Member' THEN 4 ELSE 3 END"
_MEASURE_SQL = """CAST(sum(a.people) AS BIGINT) AS people, CAST(sum(t.is_session) AS BIGINT) AS commnunation_count,
  count(DISTINCT CASE WHEN t.is_session >= 1 THEN t.receiver END) AS commnunation_people_count,
  CAST(sum(t.is_quality_session) AS BIGINT) AS quality_commnunation_count,
  count(DISTINCT CASE WHEN t.is_quality_session = 1 THEN t.receiver END) AS quality_commnunation_people_count,
  CAST(sum(m.successful_sales_amount) AS DOUBLE) AS successful_sales_amount, CAST(sum(m.consumption_amount) AS DOUBLE) AS consumption_amount"""
_PERIOD_SQL = {"WTD": "week", "MTD": "month", "QTD": "quarter", "YTD": "year"}


def _branches(owner: str, all_class_bounded: bool, up_to_current: bool) -> str:
    """One SELECT per period and class for an owner clause, with the literal add joins."""
    out = []
    for period in ("DTD", *_PERIOD_SQL):
        for cls in (_CLASS, "1"):
            if period == "DTD":
                rows, adds_side, bound = "sessions", "adds", "AND a.add_date <= t.msg_date"
                ordinal = "strftime(t.msg_date, '%Y%m%d')"
            else:
                part = _PERIOD_SQL[period]
                op = "<=" if up_to_current and period != "YTD" else "="
                rows = f"(SELECT s.* FROM sessions s JOIN newest n ON s.fiscal_{part} {op} n.current_{part})"
                adds_side = "(SELECT x.* FROM adds x JOIN newest n ON x.add_date <= n.max_msg_date)"
                bound = "AND a.add_date <= t.msg_date" if cls == "1" and all_class_bounded else ""
                ordinal = "t.fiscal_year" if period == "YTD" else f"substring(t.fiscal_{part}, 5, 2)"
            out.append(
                f"""SELECT {owner}, t.fiscal_year AS year, '{period}' AS time_period, {ordinal} AS ordinal_number, {cls} AS type, {_MEASURE_SQL}
FROM {rows} t LEFT JOIN amounts m ON m.txn_date = t.msg_date AND m.user_id = t.sender AND m.card_type_new = t.card_type_new
LEFT JOIN {adds_side} a ON a.user_id = t.sender AND a.card_type_new = t.card_type_new {bound} GROUP BY ALL"""
            )
    return "\nUNION ALL\n".join(out)


_LEVEL_SQL = {
    4: "t.store_nbr AS organize, t.local_name AS store_name",
    3: "t.region_detail AS organize, '' AS store_name",
    2: "t.region AS organize, '' AS store_name",
    1: "CASE t.counter_type_code WHEN 'Factory' THEN 'PRC Outlet Total' WHEN 'Regular' THEN 'PRC Retail Total' ELSE t.counter_type_code END AS organize, '' AS store_name",
    0: "'' AS organize, '' AS store_name",
}


def _level(n: int) -> str:
    return _branches(f"{n} AS organize_type, {_LEVEL_SQL[n]}", True, False)


_ORG_STEPS = (*_SESSIONS, _CURRENT, _ADDS, *_AMOUNTS)
_add("ptd_kpis", _CHAT, _ORG_STEPS, _level(4))
_add(
    "org_rollup",
    _CHAT,
    (*_ORG_STEPS, ("report", "\nUNION ALL\n".join(_level(n) for n in _LEVEL_SQL))),
    "SELECT (SELECT max(add_date) FROM adds) AS data_date, report.* FROM report",
)
_counted = ("people", "commnunation_count", "commnunation_people_count", "quality_commnunation_count", "quality_commnunation_people_count")
_add(
    "org_resum",
    _CHAT,
    (*_ORG_STEPS, ("store_report", _level(4))),
    "SELECT year, time_period, ordinal_number, type, "
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _counted)
    + ", CAST(sum(CAST(successful_sales_amount AS DECIMAL(28,2))) AS DOUBLE) AS successful_sales_amount"
    + ", CAST(sum(CAST(consumption_amount AS DECIMAL(28,2))) AS DOUBLE) AS consumption_amount FROM store_report GROUP BY 1, 2, 3, 4",
)

_KEY_OPENING = (
    "key_opening",
    """SELECT calendar_date AS start_timewindow, fisc_year_num FROM reach_calendar WHERE fisc_year_day_num = 1
  AND fisc_year_num = (SELECT fisc_year_num FROM reach_calendar WHERE calendar_date = (SELECT max(CAST(substring(msgtime, 1, 10) AS DATE)) FROM chat_message))""",
)
_add(
    "key_fiscal_start",
    ("chat_message", "reach_calendar"),
    (_KEY_OPENING,),
    """SELECT CAST(substring(msgtime, 1, 10) AS DATE) AS msg_date, count(*) AS messages, start_timewindow, fisc_year_num
FROM chat_message JOIN key_opening ON CAST(substring(msgtime, 1, 10) AS DATE) BETWEEN start_timewindow AND (SELECT max(CAST(substring(msgtime, 1, 10) AS DATE)) FROM chat_message) GROUP BY ALL""",
)
_add(
    "associate_reach",
    (*_CHAT, "reach_calendar"),
    (
        _KEY_OPENING,
        (
            "staff",
            _STAFF[0][1].replace("region_detail FROM", "region_detail, work_external_user_id FROM") + " AND is_key_sa = '1'",
        ),
        (
            "messages",
            """SELECT sender_external_userid AS sender, receiver_external_userid AS receiver, CAST(msgtime AS TIMESTAMP) AS msgtime,
  CAST(CAST(msgtime AS TIMESTAMP) AS DATE) AS msg_date
FROM chat_message JOIN key_opening ON CAST(CAST(msgtime AS TIMESTAMP) AS DATE) BETWEEN start_timewindow AND (SELECT max(CAST(substring(msgtime, 1, 10) AS DATE)) FROM chat_message)
WHERE split_part(msgtime, ' ', 2) BETWEEN '10:00:00' AND '22:00:00' AND brand_code = 'Main'
  AND sender_external_userid IN (SELECT user_id FROM staff) AND (sender_external_userid <> '' OR receiver_external_userid <> '')
  AND receiver_external_userid NOT IN (SELECT user_id FROM staff WHERE user_id IS NOT NULL)""",
        ),
        _MARKERS,
        *_RECEIVERS,
        _fiscal("messages"),
        (
            "sessions",
            f"""SELECT p.msg_date, f.fiscal_week, f.fiscal_month, f.fiscal_quarter, f.fiscal_year, p.sender, {_ORG_COLUMNS}, p.receiver,
  r.work_external_user_id, r.card_type_new, p.total AS is_session, CASE WHEN p.total >= 2 THEN 1 ELSE 0 END AS is_quality_session
FROM (SELECT msg_date, sender, receiver, sum(is_new_session) AS total FROM markers GROUP BY 1, 2, 3) p
JOIN staff s ON s.user_id = p.sender JOIN receivers r ON r.openid = p.receiver JOIN fiscal f ON f.msg_date = p.msg_date""",
        ),
        _CURRENT,
        _adds_sql("AND is_key_sa = '1'"),
        *_amounts_sql("AND is_key_sa = '1'"),
        (
            "report",
            _branches("t.sender AS sa_code, t.name AS sa_name, t.store_nbr AS store_code, t.local_name AS store_name", False, True),
        ),
    ),
    "SELECT (SELECT max(add_date) FROM adds) AS data_date, report.* FROM report",
)

# --- chat ingest ----------------------------------------------------------------------
_js = lambda path: f"coalesce(json_extract_string(body, '{path}'), '')"
_NORMAL = (
    (
        "bodies",
        "SELECT seq, msgid, CAST(regexp_replace(message, '[[:cntrl:]]', ' ', 'g') AS JSON) AS body FROM raw_message",
    ),
    (
        "fields",
        f"""SELECT *, {_js('$.msgtype')} AS msgtype, json_extract(body, '$.' || {_js('$.msgtype')}) AS node, json_extract(body, '$.tolist') AS tolist FROM bodies""",
    ),
    (
        "rows_out",
        f"""SELECT seq, msgid, {_js('$.action')} AS action, {_js('$.from')} AS sender, receiver, position, {_js('$.roomid')} AS roomid,
  strftime(TIMESTAMP '1970-01-01 08:00:00' + to_seconds(CAST(coalesce(json_extract_string(body, '$.msgtime'), '0') AS BIGINT) // 1000), '%Y-%m-%d %H:%M:%S') AS msgtime,
  msgtype,
  CASE WHEN msgtype IN ('image', 'voice', 'video', 'emotion', 'file') THEN coalesce(trim(json_extract_string(node, '$.sdkfileid')), '') ELSE '' END AS sdkfileid,
  coalesce(json_extract_string(node, '$.md5sum'), '') AS md5sum,
  CASE WHEN msgtype <> 'file' THEN '' WHEN json_extract_string(node, '$.fileext') LIKE '{{%}}' THEN
    CASE WHEN json_valid(json_extract_string(node, '$.fileext')) THEN json_extract_string(json_extract_string(node, '$.fileext'), '$.fileext') ELSE '' END
    ELSE coalesce(json_extract_string(node, '$.fileext'), '') END AS fileext,
  CAST(node AS VARCHAR) AS raw_json
FROM (SELECT *, unnest(CASE WHEN tolist IS NULL THEN [''] WHEN json_type(tolist) = 'ARRAY' THEN CAST(tolist AS VARCHAR[]) ELSE [CAST(tolist AS VARCHAR)] END) AS receiver,
  unnest(range(CASE WHEN json_type(tolist) = 'ARRAY' THEN CAST(json_array_length(tolist) AS BIGINT) ELSE 1 END)) AS position FROM fields)""",
    ),
)
_RAW = ("raw_message",)
_normalized = "SELECT * EXCLUDE (position) FROM rows_out"
_add("normalize_messages", _RAW, _NORMAL, _normalized)
_add("stream_normalize", _RAW, _NORMAL, _normalized)
_add("stream_dedup", _RAW, _NORMAL, "SELECT seq, receiver, msgtype FROM rows_out")
_add(
    "stream_sessions",
    ("chat_message",),
    (
        (
            "minutes",
            """SELECT DISTINCT sender_external_userid AS sender, receiver_external_userid AS receiver, CAST(msgtime AS TIMESTAMP)::DATE AS msg_date,
  date_trunc('minute', CAST(msgtime AS TIMESTAMP)) AS at FROM chat_message""",
        ),
    ),
    """SELECT sender, receiver, msg_date, count(*) AS sessions FROM minutes m WHERE NOT EXISTS (SELECT 1 FROM minutes b WHERE b.sender = m.sender
  AND b.receiver = m.receiver AND b.msg_date = m.msg_date AND b.at < m.at AND b.at >= m.at - INTERVAL 60 MINUTE) GROUP BY ALL""",
)
_add("envelopes", _RAW, (), "SELECT seq, msgid, message FROM raw_message")
_add("normalize_counts", _RAW, (), "SELECT count(*) + count(*) FILTER (seq % 2 = 0) AS messages_read, count(*) AS messages_parsed, count(*) FILTER (seq % 2 = 0) AS messages_rejected FROM raw_message")
_add("normalize_write_counts", _RAW, (), "SELECT count(*) + count(*) FILTER (seq % 2 = 0) AS messages_read, count(*) AS messages_parsed, count(*) FILTER (seq % 2 = 0) AS messages_rejected FROM raw_message")
_add("csv_reload", ("contact",), (), "SELECT * FROM contact")
_add("csv_lenient", (), (), "SELECT CAST(p_partkey AS INT) AS key, CAST(p_size AS INT) AS size, CASE WHEN p_partkey % 3 = 2 THEN 7 END AS extra FROM part WHERE p_partkey % 3 <> 0")
_add("staged_table", (), (), "SELECT p_partkey, p_brand, p_size FROM part")
_add("bucketed_table", (), (), "SELECT p_partkey, p_brand FROM part")
_add("published_table", (), (), "SELECT p_partkey, p_type, true AS stamped_today FROM part WHERE p_size > 10")
_add("daily_export", (), (), "SELECT p_partkey, p_name, '20240101' AS ds FROM part UNION ALL SELECT p_partkey, p_name, '20240102' FROM part WHERE p_partkey % 2 = 0")
_add(
    "incremental_slice",
    _RAW,
    (),
    """SELECT seq, msgid, (SELECT max(seq) + 1 FROM raw_message) AS next_seq FROM raw_message WHERE seq >= (SELECT max(seq) // 2 FROM raw_message)""",
)
_MANIFEST = (
    *_NORMAL,
    (
        "checked",
        """SELECT *, trim(msgtype) <> '' AND trim(sdkfileid) <> '' AND trim(md5sum) <> '' AND lower(msgtype) IN ('image', 'voice', 'video', 'emotion', 'file')
  AND regexp_full_match(sdkfileid, '[A-Za-z0-9+/=]{32,}') AS usable FROM rows_out""",
    ),
    (
        "manifest",
        """SELECT msgtype, sdkfileid, md5sum, CASE msgtype WHEN 'file' THEN fileext WHEN 'image' THEN 'jpg' WHEN 'voice' THEN 'mp3' WHEN 'video' THEN 'mp4'
  WHEN 'emotion' THEN 'gif' ELSE 'dat' END AS fileext
FROM (SELECT *, row_number() OVER (PARTITION BY msgtype, md5sum ORDER BY seq, position) AS rn FROM checked WHERE usable) WHERE rn = 1""",
    ),
)
_add("media_manifest", _RAW, _MANIFEST, "SELECT * FROM manifest")
_add("media_keys", _RAW, _MANIFEST, "SELECT msgtype, md5sum, 'raw/chat/media/' || msgtype || '/' || md5sum || '.' || fileext AS media_key FROM manifest")
_add(
    "manifest_counts",
    _RAW,
    _MANIFEST,
    """SELECT (SELECT count(*) FROM checked) AS total_rows, (SELECT count(*) FROM manifest) AS valid_rows, (SELECT count(*) FROM checked WHERE NOT usable) AS skipped_rows,
  (SELECT count(*) FROM checked WHERE usable) - (SELECT count(*) FROM manifest) AS duplicate_rows""",
)
_add("manifest_round_trip", _RAW, _MANIFEST, "SELECT * FROM manifest")
_add(
    "manifest_write_counts",
    _RAW,
    _MANIFEST,
    """SELECT (SELECT count(*) FROM checked) AS total_rows, (SELECT count(*) FROM manifest) AS valid_rows, (SELECT count(*) FROM checked WHERE NOT usable) AS skipped_rows,
  (SELECT count(*) FROM checked WHERE usable) - (SELECT count(*) FROM manifest) AS duplicate_rows""",
)
_EXTERNAL = (
    *_NORMAL,
    (
        "external",
        """SELECT sender AS external_userid FROM rows_out WHERE left(sender, 2) IN ('wo', 'wm')
UNION SELECT receiver FROM rows_out WHERE left(receiver, 2) IN ('wo', 'wm')""",
    ),
    (
        "unseen",
        "SELECT e.external_userid FROM external e LEFT JOIN id_mapping k ON k.external_userid = e.external_userid WHERE k.external_userid IS NULL",
    ),
)
_IDS = ("raw_message", "id_mapping")
_add("external_ids", _RAW, _EXTERNAL[:-1], "SELECT * FROM external")
_add("new_ids_anti", _IDS, _EXTERNAL, "SELECT * FROM unseen")
_add("mapped_ids", _IDS, _EXTERNAL, "SELECT e.external_userid, unionid FROM external e JOIN id_mapping k ON k.external_userid = e.external_userid WHERE unionid <> ''")
_add(
    "reconcile_counts",
    _IDS,
    _EXTERNAL,
    """SELECT (SELECT count(*) FROM external) AS source_rows, (SELECT count(*) FROM unseen) AS staged_rows,
  (SELECT count(*) FROM external) - (SELECT count(*) FROM unseen) AS missing_rows""",
)

# --- telemetry ------------------------------------------------------------------------
_FAIL = (
    (
        "failures",
        """SELECT sdkfileid, ret_code, CASE ret_code WHEN 10001 THEN '网络波动' WHEN 10002 THEN '数据解析失败' WHEN -1000 THEN '临时文件错误' WHEN -1001 THEN '文件IO异常'
  ELSE '未知错误(' || ret_code || ')' END AS error_class, ret_code IN (10001, 10002, 10003, -1000, -1001) AS retryable FROM failure_log WHERE status <> 'success'""",
    ),
)
_LOG = ("failure_log",)
_add("error_class", _LOG, _FAIL, "SELECT * FROM failures")
_add("failure_categories", _LOG, _FAIL, "SELECT error_class, count(*) AS failures, count(DISTINCT sdkfileid) AS files FROM failures GROUP BY 1")
_add("failure_files", _LOG, _FAIL, "SELECT error_class, sdkfileid, count(*) AS failures FROM failures GROUP BY 1, 2")
_add("error_codes", _LOG, (), "SELECT ret_code, count(*) AS occurrences FROM failure_log WHERE ret_code <> 10001 GROUP BY 1")
_add(
    "run_totals",
    (*_LOG, "failure_lines"),
    (),
    """SELECT count(*) AS total_files, count(*) FILTER (status = 'success') AS success_files, count(*) FILTER (status = 'failed') AS failed_files,
  count(*) FILTER (status = 'expired') AS expired_files, round(count(*) FILTER (status = 'success') * 100.0 / count(*), 2) AS success_pct,
  round(count(*) FILTER (status = 'failed') * 100.0 / count(*), 2) AS failed_pct,
  (SELECT count(*) FROM failure_lines WHERE line LIKE '[%] Type: %') AS failed_records FROM failure_log""",
)
_add(
    "failure_lines",
    _LOG,
    (),
    """SELECT date_trunc('second', event_ts) AS logged_at, msgtype, substring(sdkfileid, 1, 17) || '...' AS file_id, 'SdkException: ret=' || ret_code AS error
FROM failure_log WHERE status <> 'success'""",
)
_add(
    "run_metrics",
    ("job_runs",),
    (),
    """SELECT task_name, status, count(*) AS runs, CAST(sum(data_size) AS BIGINT) AS rows_loaded, CAST(sum(duration_ms) AS BIGINT) AS total_ms, max(duration_ms) AS max_ms
FROM job_runs GROUP BY 1, 2""",
)

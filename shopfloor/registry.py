"""Every registered query: name to a function of (spark, folder)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shopfloor.bindings import Domain
from shopfloor.operators import lookups
from shopfloor.operators.aggregation import distinct_counts, resum
from shopfloor.operators.calendar import attach_periods, fiscal_keys
from shopfloor.operators.sessions import daily_sessions, mark_sessions
from shopfloor.plans import chat, customers, products, reach, telemetry, transactions
from shopfloor.session import settled, work_dir
from shopfloor.sources import files
from shopfloor.sources.tables import Tables
from shopfloor.streaming import chat as chat_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PRODUCT_BRAND, BRAND = "B1", "Main"


def _plain(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles, so results compare without regard to precision."""
    return df.select(
        *(F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name) for f in df.schema)
    )


def query(fn: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, folder: _plain(fn(Domain(spark, folder)))
    return fn


# --- products and customers -----------------------------------------------------------


@query
def sku_parse(d: Domain) -> DataFrame:
    return products.parse_sku(d["product_sku"])


@query
def sku_match_cascade(d: Domain) -> DataFrame:
    return products.resolve_products(products.parse_sku(d["product_sku"]), d["product"], PRODUCT_BRAND)


@query
def latest_customer_type(d: Domain) -> DataFrame:
    return customers.latest_customer_type(d["type_history"], BRAND)


def _profile_inputs(d: Domain) -> tuple:
    return d["crm_customer"], d["type_code"], d["customer_address"], d["province"], d["residence_country"], BRAND


@query
def employee_flag(d: Domain) -> DataFrame:
    return customers.employee_flag(*_profile_inputs(d))


@query
def customer_profile(d: Domain) -> DataFrame:
    return customers.customer_profile(*_profile_inputs(d))


# --- transactions ---------------------------------------------------------------------


def _txn_sources(d: Domain) -> transactions.TransactionSources:
    return transactions.TransactionSources(
        headers=d["transaction_hdr"],
        details=d["transaction_dtl"],
        sku_lookup=sku_match_cascade(d),
        counters=d["counter"],
        counter_categories=d["counter_category"],
        products=d["product"],
        prices=d["price_list"],
        calendar=d["calendar"],
        pegs=d["peg_rate"],
        taxes=d["tax_rate"],
        locations=d["location"],
        comparable_bands=d["comparable_bands"],
        shifted_years=d["shifted_years"],
        costs=d["product_cost"],
        skus=d["product_sku"].select(F.col("id").alias("sku_id"), F.col("code").alias("sku_code")),
    )


def _lines(d: Domain) -> DataFrame:
    return transactions.txn_lines(d["transaction_hdr"], d["transaction_dtl"], sku_match_cascade(d))


@query
def scan_filter(d: Domain) -> DataFrame:
    return lookups.scan_filter(d["part"], "p_brand", "Brand#7").select("p_partkey", "p_name", "p_brand")


@query
def txn_base(d: Domain) -> DataFrame:
    return _lines(d)


@query
def txn_enriched(d: Domain) -> DataFrame:
    return transactions.enriched_lines(_txn_sources(d))


@query
def banded_price_lookup(d: Domain) -> DataFrame:
    lines = _lines(d).join(d["counter"].select("code", "nationality_code").distinct(), F.col("counter_code") == F.col("code"))
    keyed = transactions.with_price_list_key(lines).select("txn_nbr", "sku_id", "product_id", "txn_date", "price_list_key", "retail_price")
    bands = lookups.Bands(d["price_list"], "product_key", "start_date", "end_date", {"price": "list_price"}, {"price_list_key": "price_list_key"})
    return lookups.folded_lookups(keyed, "product_id", "txn_date", bands)


@query
def banded_cost_latest(d: Domain) -> DataFrame:
    lines = _lines(d).select("txn_nbr", "sku_id", "product_id", "txn_date")
    return lookups.banded_lookup(
        lines, d["product_cost"], {"product_id": "product_key"}, "txn_date", "start_date", "end_date", {"curr_std_cst_usd": "cost"}, unique=True
    )


@query
def fx_peg_tax(d: Domain) -> DataFrame:
    return transactions.usd_lines(_txn_sources(d)).select(
        "txn_nbr", "txn_item_line_nbr", "item_sold_qty", "local_item_net_amt", "local_currency", "country_code",
        *(F.round(c, 6).alias(c) for c in ("usd_msrp",)), "usd_item_net_amt", "usd_aur",
        "fisc_year_num", "fisc_year_quarter", "fisc_year_month", "fisc_year_week", "fisc_year_day",
    )


@query
def discount_flags(d: Domain) -> DataFrame:
    return transactions.usd_lines(_txn_sources(d)).groupBy("discount_flag", "fisc_year_num").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(F.col("discount_pct").cast("decimal(18,4)")).alias("sum_discount_pct")
    )


@query
def comparable_store(d: Domain) -> DataFrame:
    lines = transactions.store_lines(_txn_sources(d))
    return lines.select(
        "txn_nbr", "txn_item_line_nbr", "item_sold_qty", "local_item_net_amt", "location_id", "location_desc", "region_desc",
        "comp_year_ty", "comp_ind_ty", "comp_year_ly", "comp_ind_ly",
    )


def _order_lines(d: Domain) -> DataFrame:
    return transactions.order_lines(_txn_sources(d))


_SEQUENCE = ("customer_id", "txn_nbr", "cust_first_txn_date", "cust_prev_txn_datetime", "days_since_cust_prev_txn", "rn", "drn")


@query
def txn_order(d: Domain) -> DataFrame:
    return transactions.customer_sequence(_order_lines(d)).select(*_SEQUENCE)


@query
def purchase_order(d: Domain) -> DataFrame:
    return transactions.customer_sequence(_order_lines(d), purchases_only=True).select(*_SEQUENCE)


@query
def first_purchase_txns(d: Domain) -> DataFrame:
    return transactions.first_purchase_txns(_order_lines(d))


@query
def txn_final(d: Domain) -> DataFrame:
    return transactions.transaction_fact(_txn_sources(d))


@query
def fiscal_keys_by_day(d: Domain) -> DataFrame:
    days = d["orders"].select(F.to_date("o_orderdate").alias("calendar_date")).distinct()
    return fiscal_keys(days.join(d["calendar"], "calendar_date"))


# --- chat reach -----------------------------------------------------------------------


def _reach_sources(d: Domain) -> reach.ReachSources:
    return reach.ReachSources(d["associate_customer"], d["contact"], d["chat_message"], d["calendar_period"], BRAND, settled)


def _messages(d: Domain, dedup: bool = True) -> DataFrame:
    clients = d["associate_customer"]
    since = reach.fiscal_start(clients).select("fy_start_date").scalar()
    return reach.filter_messages(d["chat_message"], reach.associates(clients), since, brand=BRAND, dedup=dedup)


@query
def associates(d: Domain) -> DataFrame:
    return reach.associates(d["associate_customer"])


@query
def receiver_map(d: Domain) -> DataFrame:
    return reach.receivers(d["associate_customer"], d["contact"])


@query
def fiscal_year_start(d: Domain) -> DataFrame:
    return reach.fiscal_start(d["associate_customer"])


@query
def adds_distinct(d: Domain) -> DataFrame:
    return reach.adds(d["associate_customer"])


@query
def sales_dedup_sum(d: Domain) -> DataFrame:
    return reach.won_sales(d["associate_customer"])


@query
def amount_full_outer(d: Domain) -> DataFrame:
    return reach.amounts(d["associate_customer"])


@query
def semi_senders(d: Domain) -> DataFrame:
    staff = reach.associates(d["associate_customer"])
    return lookups.semi(d["chat_message"], staff, {"sender_external_userid": "user_id"})


@query
def anti_receivers(d: Domain) -> DataFrame:
    return lookups.anti_not_in(d["chat_message"], reach.associates(d["associate_customer"]), "receiver_external_userid", "user_id")


@query
def message_filter(d: Domain) -> DataFrame:
    return _messages(d)


@query
def session_markers(d: Domain) -> DataFrame:
    return mark_sessions(_messages(d, dedup=False))


@query
def session_counts(d: Domain) -> DataFrame:
    return reach.org_sessions(_reach_sources(d)).drop("copies")


@query
def fiscal_periods(d: Domain) -> DataFrame:
    days = d["chat_message"].select(F.to_date(F.substring("msgtime", 1, 10)).alias("msg_date")).distinct()
    return attach_periods(days, d["calendar_period"])


@query
def current_period(d: Domain) -> DataFrame:
    return reach.current_period(reach.org_sessions(_reach_sources(d)))


@query
def period_to_current(d: Domain) -> DataFrame:
    sessions = reach.org_sessions(_reach_sources(d))
    kept = reach.periods_up_to_current(sessions, reach.current_period(sessions))
    return kept.groupBy("fiscal_week").agg(
        F.sum("copies").alias("session_rows"), F.sum(F.col("is_session") * F.col("copies")).alias("sessions")
    )


@query
def people_as_of(d: Domain) -> DataFrame:
    sessions = reach.org_sessions(_reach_sources(d))
    days = sessions.select(F.col("sender").alias("user_id"), "card_type_new", "msg_date").distinct()
    return reach.people_as_of(days, reach.adds(d["associate_customer"]))


@query
def reach_counts(d: Domain) -> DataFrame:
    return distinct_counts(
        reach.org_sessions(_reach_sources(d)),
        ["sender"],
        "receiver",
        flags={"session_people": F.col("is_session") >= 1, "quality_people": F.col("is_quality_session") == 1},
        sums={"sessions": F.col("is_session"), "quality_sessions": F.col("is_quality_session")},
    )


@query
def union_branches(d: Domain) -> DataFrame:
    daily = daily_sessions(_messages(d, dedup=False))
    count = lambda level, name: daily.groupBy(F.lit(level).alias("level"), name.alias("party")).agg(F.sum("sessions").alias("sessions"))
    return lookups.union_branches(count("sender", F.col("sender")), count("receiver", F.col("receiver")), count("all", F.lit("")))


@query
def ptd_kpis(d: Domain) -> DataFrame:
    return reach.org_rollup(reach.org_period_rows(_reach_sources(d)), levels=(4,))


@query
def org_rollup(d: Domain) -> DataFrame:
    return reach.org_reach(_reach_sources(d))


@query
def org_resum(d: Domain) -> DataFrame:
    store = reach.org_rollup(reach.org_period_rows(_reach_sources(d)), levels=(4,))
    return resum(store, ["year", "time_period", "ordinal_number", "type"], reach.MEASURES)


@query
def key_fiscal_start(d: Domain) -> DataFrame:
    as_of = reach.newest_day(d["chat_message"])
    first = reach.fiscal_year_opening(d["reach_calendar"], as_of)
    chats = d["chat_message"].select(F.to_date(F.substring("msgtime", 1, 10)).alias("msg_date"))
    inside = chats.where(F.col("msg_date").between(first.select("start_timewindow").scalar(), as_of))
    return lookups.with_scalar(inside.groupBy("msg_date").agg(F.count(F.lit(1)).alias("messages")), first)


@query
def associate_reach(d: Domain) -> DataFrame:
    return reach.associate_reach(_reach_sources(d), d["reach_calendar"])


# --- chat ingest ----------------------------------------------------------------------


def _curated(d: Domain) -> DataFrame:
    return chat.normalize(d["raw_message"], with_ext=True, with_position=True)


@query
def incremental_slice(d: Domain) -> DataFrame:
    feed = d["raw_message"].select("seq", "msgid")
    cursor = feed.agg(F.floor(F.max("seq") / 2).alias("c")).select("c").scalar()
    batch = chat.incremental_slice(feed, cursor)
    return lookups.with_scalar(batch, chat.next_cursor(batch, 0))


@query
def normalize_messages(d: Domain) -> DataFrame:
    return chat.normalize(d["raw_message"], with_ext=True)


@query
def media_manifest(d: Domain) -> DataFrame:
    return chat.media_manifest(_curated(d))


@query
def manifest_counts(d: Domain) -> DataFrame:
    return chat.manifest_counts(_curated(d))


@query
def manifest_write_counts(d: Domain) -> DataFrame:
    """The same counts, taken while the manifest is written."""
    counts = chat.ManifestCounts()
    files.write_manifest(chat.media_manifest(_curated(d), counts), work_dir(d.spark, "manifest"))
    return d.spark.createDataFrame([counts.get], "total_rows BIGINT, valid_rows BIGINT, skipped_rows BIGINT, duplicate_rows BIGINT")


@query
def media_keys(d: Domain) -> DataFrame:
    return chat.media_key(chat.media_manifest(_curated(d))).select("msgtype", "md5sum", "media_key")


@query
def external_ids(d: Domain) -> DataFrame:
    return chat.external_ids(_curated(d))


@query
def new_ids_anti(d: Domain) -> DataFrame:
    return lookups.new_ids(external_ids(d), d["id_mapping"], "external_userid")


@query
def mapped_ids(d: Domain) -> DataFrame:
    return chat.map_ids(external_ids(d), d["id_mapping"])


@query
def reconcile_counts(d: Domain) -> DataFrame:
    return chat.reconcile(external_ids(d), new_ids_anti(d))


# --- telemetry ------------------------------------------------------------------------


def _failures(d: Domain) -> DataFrame:
    return telemetry.classify(d["failure_log"].where(F.col("status") != "success"))


@query
def error_class(d: Domain) -> DataFrame:
    return _failures(d).select("sdkfileid", "ret_code", "error_class", "retryable")


@query
def failure_categories(d: Domain) -> DataFrame:
    return telemetry.failure_stats(_failures(d))


@query
def failure_files(d: Domain) -> DataFrame:
    return telemetry.failure_ids(_failures(d))


@query
def error_codes(d: Domain) -> DataFrame:
    return telemetry.error_codes(d["failure_log"])


@query
def run_totals(d: Domain) -> DataFrame:
    lost = telemetry.parse_failures(d["failure_lines"])  # the log of failed records
    return telemetry.run_totals(d["failure_log"], lost)


@query
def failure_lines(d: Domain) -> DataFrame:
    return telemetry.parse_failures(d["failure_lines"])


@query
def run_metrics(d: Domain) -> DataFrame:
    return telemetry.run_metrics(d["job_runs"])


# --- sources and sinks ----------------------------------------------------------------


def _tables(d: Domain) -> Tables:
    return Tables(d.spark)


def _name(label: str) -> str:
    return f"shopfloor_{label}_{uuid.uuid4().hex}"


@query
def csv_reload(d: Domain) -> DataFrame:
    out = work_dir(d.spark, "csv")
    d["contact"].write.option("header", True).option("escape", '"').csv(out)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d["contact"].schema)
    return files.load_csv_overwrite(_tables(d), out, schema, _name("contact"))


@query
def csv_lenient(d: Domain) -> DataFrame:
    """Part lines with one field too few, as many as wanted, or one too many; the first kind is skipped."""
    out, key = work_dir(d.spark, "lenient"), F.col("p_partkey")
    fields = F.when(key % 3 == 0, F.array("p_partkey")).when(key % 3 == 1, F.array("p_partkey", "p_size"))
    line = F.array_join(F.coalesce(fields, F.array("p_partkey", "p_size", F.lit(7), F.lit(9))).cast("array<string>"), ",")
    d["part"].select(line.alias("key,size,extra")).write.option("header", True).option("sep", "\u0001").csv(out)
    return files.read_csv_lenient(d.spark, out, "key INT, size INT, extra INT", min_fields=2)


@query
def envelopes(d: Domain) -> DataFrame:
    """Messages packed into JSON-line envelopes, with malformed lines among them, read back."""
    out = work_dir(d.spark, "envelopes")
    packed = F.to_json(F.struct(F.array(F.struct(F.col("seq").cast("string").alias("seq"), "msgid", "message")).alias("chatdata")))
    good = d["raw_message"].select(packed.alias("value"))
    good.unionAll(d["raw_message"].select(F.concat(F.lit("{broken "), "msgid").alias("value"))).write.text(out)
    return files.read_envelopes(d.spark, out)


@query
def manifest_round_trip(d: Domain) -> DataFrame:
    out = work_dir(d.spark, "manifest")
    files.write_manifest(chat.media_manifest(_curated(d)), out)
    return files.read_manifest(d.spark, out)


@query
def staged_table(d: Domain) -> DataFrame:
    return _tables(d).materialize(d["part"].select("p_partkey", "p_brand", "p_size"), _name("staged"), dist="p_brand", sort=["p_brand", "p_partkey"])


@query
def bucketed_table(d: Domain) -> DataFrame:
    return _tables(d).materialize(d["part"].select("p_partkey", "p_brand"), _name("bucketed"), dist="p_brand", sort=["p_brand"], buckets=4)


@query
def bucketed_orders(d: Domain) -> DataFrame:
    """Lines and order numbers, staged in equal buckets of the transaction, joined without moving either."""
    lines = _lines(d).select("txn_nbr", "sku_id", "item_sold_qty", "local_item_net_amt")
    staged = _tables(d).materialize(lines, _name("lines"), dist="txn_nbr", sort=["txn_nbr"], buckets=8)
    numbers = transactions.customer_sequence(_order_lines(d)).select("txn_nbr", "customer_id", "rn")
    return _tables(d).materialize(numbers, _name("numbers"), dist="txn_nbr", sort=["txn_nbr"], buckets=8).join(staged, "txn_nbr")


@query
def published_table(d: Domain) -> DataFrame:
    tables, name = _tables(d), _name("published")
    tables.publish(d["part"].select("p_partkey", "p_type"), name)
    return transactions.stamp_load_date(tables.publish(d["part"].where("p_size > 10").select("p_partkey", "p_type"), name)).select(
        "p_partkey", "p_type", (F.col("md_created_date") == F.current_date()).alias("stamped_today")
    )


@query
def daily_export(d: Domain) -> DataFrame:
    out, part = work_dir(d.spark, "export"), d["part"].select("p_partkey", "p_name")
    for day, rows in ((1, part), (2, part), (2, part.where("p_partkey % 2 = 0"))):  # the second day is written again
        files.export_daily(rows, out, dt.date(2024, 1, day))
    return d.spark.read.csv(out, schema="p_partkey BIGINT, p_name STRING, ds STRING", header=True, escape='"')


def _with_broken(d: Domain) -> DataFrame:
    """The raw messages and as many broken ones for every other message."""
    raw = d["raw_message"]
    return raw.unionByName(raw.where("seq % 2 = 0").withColumn("message", F.substring("message", 1, 20)))


_MESSAGE_COUNTS = "messages_read BIGINT, messages_parsed BIGINT, messages_rejected BIGINT"


@query
def normalize_counts(d: Domain) -> DataFrame:
    return chat.normalize_counts(_with_broken(d))


@query
def normalize_write_counts(d: Domain) -> DataFrame:
    """The same counts, taken while the curated rows are written."""
    counts = Observation()
    chat.normalize(_with_broken(d), counts=counts).write.parquet(work_dir(d.spark, "curated"))
    return d.spark.createDataFrame([counts.get], _MESSAGE_COUNTS)


# --- streaming ------------------------------------------------------------------------


def _feed(d: Domain, rows: DataFrame, label: str, files_: int = 3) -> DataFrame:
    """``rows`` written as several files and read as a stream, one file a micro-batch."""
    path = work_dir(d.spark, f"{label}-feed")
    rows.repartition(files_).write.parquet(path)
    return chat_stream.read_feed(d.spark, path, rows.schema, max_files=1)


@query
def stream_normalize(d: Domain) -> DataFrame:
    out = work_dir(d.spark, "normalize")
    rows = chat_stream.stream_normalize(_feed(d, d["raw_message"], "normalize"), with_ext=True)
    chat_stream.run_available(rows, chat_stream.batch_sink(f"{out}/rows"), f"{out}/checkpoint")
    return d.spark.read.schema(rows.schema).parquet(f"{out}/rows").select(*rows.columns)


@query
def stream_dedup(d: Domain) -> DataFrame:
    """Every message arrives twice, in different files as a rule, some without time."""
    out = work_dir(d.spark, "dedup")
    twice = d["raw_message"].unionAll(d["raw_message"])
    rows = chat_stream.stream_normalize(_feed(d, twice, "dedup", 4), with_position=True).select("seq", "_position", "receiver", "msgtype")
    once = chat_stream.dedup_stream(rows)
    chat_stream.run_available(once, chat_stream.batch_sink(f"{out}/rows"), f"{out}/checkpoint", keyed_state=True)
    return d.spark.read.schema(rows.schema).parquet(f"{out}/rows").select("seq", "receiver", "msgtype")


@query
def stream_sessions(d: Domain) -> DataFrame:
    out, when = work_dir(d.spark, "sessions"), F.col("msgtime").cast("timestamp_ntz")
    chats = d["chat_message"].select(
        F.col("sender_external_userid").alias("sender"), F.col("receiver_external_userid").alias("receiver"),
        when.alias("msgtime"), F.to_date(when).alias("msg_date"),
    )
    chat_stream.run_available(_feed(d, chats, "sessions"), chat_stream.session_sink(out), f"{out}/checkpoint")
    return chat_stream.latest_sessions(d.spark, out)

"""Chat reach: how many clients associates talk to, by organisation and period to date.

The reported sums repeat each session once per matching row of daily client adds. Joining
adds by inequality would materialise those repeats; here the number of matching add rows and
their people are running totals per associate, card and day, and every measure is multiplied.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.functions.columns import date_key, two_digit_year
from shopfloor.operators.aggregation import dedup_sum, distinct_counts
from shopfloor.operators.calendar import attach_periods
from shopfloor.operators.lookups import full_outer_coalesce, semi
from shopfloor.operators.sessions import daily_sessions

# Fixed values ---------------------------------------------------------------------------
ACTIVE_STATUS = ("0", "1", "4")
EXCLUDED_STORE = "TW EDA (Temp Store)_OCF23"
CHAT_OPENS, CHAT_CLOSES = "10:00:00", "22:00:00"
MEMBER_CARDS = ("DIAMOND,", "GOLD", "Regular", "SILVER")  # the comma belongs to the value
NON_MEMBER_CARD = "Non-Member"
ALL_CLASS, MEMBER_CLASS, OTHER_CLASS, NON_MEMBER_CLASS = 1, 2, 3, 4
CHANNEL_TOTALS = {"Factory": "PRC Outlet Total", "Regular": "PRC Retail Total"}
# Report columns, spelled as its readers know them.
MEASURES = (
    "people",
    "commnunation_count",
    "commnunation_people_count",
    "quality_commnunation_count",
    "quality_commnunation_people_count",
    "successful_sales_amount",
    "consumption_amount",
)
# ----------------------------------------------------------------------------------------

ORG = ("name", "local_name", "store_nbr", "counter_type_code", "region", "region_detail")
#: What the organisation levels look at.
PLACE = ("local_name", "store_nbr", "counter_type_code", "region", "region_detail")
PERIODS = {"WTD": "fiscal_week", "MTD": "fiscal_month", "QTD": "fiscal_quarter", "YTD": "fiscal_year"}


def associates(clients: DataFrame, key_only: bool = False) -> DataFrame:
    """Active associates; key associates come with one row per client, as their report expects."""
    active = clients.where(F.col("sa_status").isin(*ACTIVE_STATUS) & (F.col("local_name") != EXCLUDED_STORE))
    if key_only:
        active = active.where(F.col("is_key_sa") == "1")
        return active.select("user_id", *ORG, "work_external_user_id").distinct()
    return active.select("user_id", *ORG).distinct()


def fiscal_start(clients: DataFrame) -> DataFrame:
    """One row: first add date and number of the latest fiscal year on record."""
    # One small row per fiscal year label; the list below holds a handful of entries.
    yearly = clients.groupBy("fisc_year").agg(F.min("add_date").alias("first"))
    packed = yearly.agg(
        two_digit_year(F.max("fisc_year")).alias("year"),
        F.collect_list(F.struct(two_digit_year(F.col("fisc_year")).alias("y"), "first")).alias("_years"),
    )
    of_newest = F.filter("_years", lambda e: e["y"] == F.col("year"))
    return packed.select(F.array_min(F.transform(of_newest, lambda e: e["first"])).alias("fy_start_date"), "year")


def fiscal_year_opening(calendar: DataFrame, as_of: dt.date | Column) -> DataFrame:
    """First day of the fiscal year containing ``as_of``, from a day calendar."""
    current = calendar.where(F.col("calendar_date") == _day(as_of)).select("fisc_year_num")
    return calendar.where(F.col("fisc_year_day_num") == 1).join(current.distinct(), "fisc_year_num").select(
        F.col("calendar_date").alias("start_timewindow"), "fisc_year_num"
    )


def adds(clients: DataFrame, key_only: bool = False) -> DataFrame:
    """Distinct clients added per day, associate and card."""
    first = clients.where(
        F.col("user_id").isNotNull() & (F.col("add_rank") == 1) & (F.col("add_date") > F.lit("1970-01-01").cast("date"))
    )
    if key_only:
        first = first.where(F.col("is_key_sa") == "1")
    return first.groupBy("add_date", "user_id", "card_type_new").agg(
        F.count_distinct("work_external_user_id").alias("people")
    )


def won_sales(clients: DataFrame) -> DataFrame:
    """Sales credited to the selling associate, repeated records counted once."""
    sold = clients.where(F.col("user_id_txn").isNotNull()).withColumnRenamed("user_id", "_owner").withColumnRenamed("user_id_txn", "user_id")
    return dedup_sum(
        sold, ["txn_date", "user_id", "card_type_new"], ["work_external_user_id", "customer_id", "txn_nbr"],
        "demand", "successful_sales_amount",
    )


def consumption(clients: DataFrame) -> DataFrame:
    """Spending of an associate's clients, repeated records counted once."""
    owned = clients.where(F.col("user_id").isNotNull())
    return dedup_sum(
        owned, ["txn_date", "user_id", "card_type_new"], ["work_external_user_id", "name", "txn_nbr"],
        "demand", "consumption_amount",
    )


def amounts(clients: DataFrame, key_only: bool = False) -> DataFrame:
    """Sales won and client spending per day, associate and card."""
    if key_only:
        clients = clients.where(F.col("is_key_sa") == "1")
    dated = clients.where(F.col("txn_date").isNotNull())
    return full_outer_coalesce(won_sales(dated), consumption(dated), ["txn_date", "user_id", "card_type_new"])


def receivers(clients: DataFrame, contacts: DataFrame) -> DataFrame:
    """Clients with their cards and chat ids; a client has a row per card and customer id."""
    known = clients.select("work_external_user_id", "card_type_new", "customer_id").distinct()
    ids = contacts.select("openid", "id", F.col("customer_id").alias("_c")).distinct()
    return known.join(ids, F.col("work_external_user_id") == F.col("id"), "left").select(
        "work_external_user_id", "openid", "customer_id", "card_type_new"
    )


def filter_messages(
    chat: DataFrame,
    staff: DataFrame,
    since: Column | None = None,
    until: Column | None = None,
    brand: str | None = None,
    dedup: bool = True,
    to_staff: bool = False,
) -> DataFrame:
    """Messages from an associate to somebody else, between opening and closing time inclusive.

    ``to_staff`` leaves messages to associates in, for callers that drop them from reduced rows (``without_staff``).
    """
    staff_ids = staff.select("user_id").where(F.col("user_id").isNotNull()).distinct()
    sender, receiver = F.col("sender_external_userid"), F.col("receiver_external_userid")
    clock = F.split_part("msgtime", F.lit(" "), F.lit(2))
    rows = chat.where(clock.between(CHAT_OPENS, CHAT_CLOSES) & ((sender != "") | (receiver != "")) & receiver.isNotNull())
    if brand is not None:
        rows = rows.where(F.col("brand_code") == brand)
    msgtime = F.col("msgtime").cast("timestamp_ntz")
    rows = rows.select(
        sender.alias("sender"), receiver.alias("receiver"), msgtime.alias("msgtime"), F.to_date(msgtime).alias("msg_date")
    )
    if since is not None:
        rows = rows.where(F.col("msg_date") >= since)
    if until is not None:
        rows = rows.where(F.col("msg_date") <= until)
    rows = semi(rows, staff_ids, {"sender": "user_id"})
    if not to_staff:
        rows = without_staff(rows, staff)
    rows = rows.select("sender", "receiver", "msgtime", "msg_date")
    return rows.distinct() if dedup else rows


def without_staff(rows: DataFrame, staff: DataFrame) -> DataFrame:
    """Rows whose receiver is no associate.

    A NULL associate id would make a literal ``NOT IN`` reject everything; it is dropped first.
    """
    ids = staff.where(F.col("user_id").isNotNull()).select(F.col("user_id").alias("receiver")).distinct()
    return rows.join(ids, "receiver", "left_anti").select(*rows.columns)


def pair_days(messages: DataFrame, staff: DataFrame) -> DataFrame:
    """Sessions per sender, receiver and day. Messages are reduced first, on all three keys, and staff receivers leave then."""
    return without_staff(daily_sessions(messages), staff)


def _receiver_map(pairs: DataFrame) -> DataFrame:
    """Receiver rows that differ only in customer id, folded to a count."""
    return pairs.where(F.col("openid").isNotNull()).groupBy(
        F.col("openid").alias("receiver"), "work_external_user_id", "card_type_new"
    ).agg(F.count(F.lit(1)).alias("_copies"))


def session_counts(days: DataFrame, staff: DataFrame, pairs: DataFrame, periods: DataFrame) -> DataFrame:
    """Sessions per day, associate, receiver and card; quality means at least two that day.

    ``copies`` counts identical rows a row stands for, always 1 in this report.
    """
    joined = (
        days.join(staff.withColumnRenamed("user_id", "sender"), "sender", "left")
        .join(_receiver_map(pairs), "receiver", "left")
    )
    total = F.col("sessions") * F.coalesce("_copies", F.lit(1))
    return attach_periods(joined, periods).select(
        "msg_date", *PERIODS.values(), "sender", *ORG, "receiver", "work_external_user_id", "card_type_new",
        total.alias("is_session"), F.when(total >= 2, 1).otherwise(0).alias("is_quality_session"),
        F.lit(1).cast("long").alias("copies"),
    )


def key_session_counts(days: DataFrame, staff: DataFrame, pairs: DataFrame, periods: DataFrame) -> DataFrame:
    """Session rows of key associates.

    Each row would appear once per client of the associate and per customer id of the
    receiver. The repeats are identical, so one row with a ``copies`` count stands for them.
    """
    crew = staff.groupBy("user_id", *ORG).agg(F.count(F.lit(1)).alias("_clients")).withColumnRenamed("user_id", "sender")
    joined = days.join(crew, "sender").join(_receiver_map(pairs), "receiver")
    return attach_periods(joined, periods).select(
        "msg_date", *PERIODS.values(), "sender", *ORG, "receiver", "work_external_user_id", "card_type_new",
        F.col("sessions").alias("is_session"), F.when(F.col("sessions") >= 2, 1).otherwise(0).alias("is_quality_session"),
        (F.col("_clients") * F.col("_copies")).alias("copies"),
    )


def current_period(sessions: DataFrame) -> DataFrame:
    """Newest quarter, month, week and message day of each fiscal year with sessions."""
    return sessions.groupBy(F.col("fiscal_year").alias("current_year")).agg(
        F.max("fiscal_quarter").alias("current_quarter"),
        F.max("fiscal_month").alias("current_month"),
        F.max("fiscal_week").alias("current_week"),
        F.max("msg_date").alias("max_msg_date"),
    )


def periods_up_to_current(sessions: DataFrame, current: DataFrame, label: str = "fiscal_week", newest: str = "current_week") -> DataFrame:
    """Repeat each row once per fiscal year whose newest period is not before the row's."""
    matches = _matches(F.col(f"_now.{newest}"), F.col(label), or_later=True)
    return (
        sessions.withColumn("_now", _newest(current))
        .withColumn("copies", F.col("copies") * matches)
        .where(F.col("copies") > 0)
        .drop("_now")
    )


def _newest(current: DataFrame) -> Column:
    """The current periods as one scalar of short lists, an entry per fiscal year each."""
    return current.agg(F.struct(*(F.collect_list(c).alias(c) for c in current.columns)).alias("v")).select("v").scalar()


def _matches(newest: Column, value: Column, or_later: bool) -> Column:
    """How many fiscal years have ``value`` as their newest period (or have moved past it)."""
    return F.size(F.filter(newest, (lambda c: c >= value) if or_later else (lambda c: c == value)))


def people_as_of(days: DataFrame, daily_adds: DataFrame) -> DataFrame:
    """For each (user_id, card_type_new, msg_date): add rows so far and the people in them.

    Days and adds are stacked and summed along the days of an associate and card, so the
    work is linear and a group never exceeds the number of days.
    """
    return _running(days, daily_adds.withColumn("_weight", F.lit(1).cast("long"))).select(
        "user_id", "card_type_new", "msg_date", F.col("_n").alias("add_rows"), F.col("_p").alias("people")
    )


def _running(days: DataFrame, weighted_adds: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """Running add counts (plain and weighted), their totals and the day's amounts per key and day."""
    key = ("user_id", "card_type_new", "msg_date")
    zero = F.lit(0).cast("long")
    stacked = days.select(*key, *(zero.alias(c) for c in ("n", "p", "nk", "pk")), F.lit(True).alias("asked")).unionByName(
        weighted_adds.select(
            "user_id", "card_type_new", F.col("add_date").alias("msg_date"), F.lit(1).cast("long").alias("n"), F.col("people").alias("p"),
            F.col("_weight").cast("long").alias("nk"), (F.col("people") * F.col("_weight")).alias("pk"), F.lit(False).alias("asked"),
        )
    )
    extra = []
    if sales is not None:
        extra = ["successful_sales_amount", "consumption_amount"]
        stacked = stacked.unionByName(
            sales.select(
                "user_id", "card_type_new", F.col("txn_date").alias("msg_date"), *(zero.alias(c) for c in ("n", "p", "nk", "pk")),
                F.lit(False).alias("asked"), *extra,
            ),
            allowMissingColumns=True,
        )
    per_day = (
        stacked.where(F.col("user_id").isNotNull() & F.col("card_type_new").isNotNull() & F.col("msg_date").isNotNull())
        .groupBy(*key)
        .agg(*(F.sum(c).alias(c) for c in ("n", "p", "nk", "pk")), F.bool_or("asked").alias("asked"), *(F.sum(c).alias(c) for c in extra))
    )
    along = Window.partitionBy("user_id", "card_type_new").orderBy("msg_date").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("user_id", "card_type_new")
    return (
        per_day.select(
            *key, "asked", *extra,
            *(F.sum(c).over(along).alias(f"_{c}") for c in ("n", "p", "nk", "pk")),
            *(F.sum(c).over(whole).alias(f"_{c}_all") for c in ("nk", "pk")),
        )
        .where("asked")
        .drop("asked")
    )


def member_class(card: Column) -> Column:
    return (
        F.when(card.isin(*MEMBER_CARDS), MEMBER_CLASS).when(card == NON_MEMBER_CARD, NON_MEMBER_CLASS).otherwise(OTHER_CLASS)
    )


@dataclass(frozen=True)
class PeriodRules:
    """How a report selects sessions of a period and counts adds for its all-clients class."""

    up_to_current: bool = False  # keep every week, month and quarter up to the current one
    all_class_as_of: bool = True  # all-clients class: adds up to the message day only


ORG_RULES = PeriodRules()
ASSOCIATE_RULES = PeriodRules(up_to_current=True, all_class_as_of=False)


def ptd_rows(sessions: DataFrame, sales: DataFrame, daily_adds: DataFrame, current: DataFrame, rules: PeriodRules = ORG_RULES) -> DataFrame:
    """Session rows spread over DTD, WTD, MTD, QTD and YTD and over client classes.

    Each output row carries ``repeat``, the number of rows the joins with adds, current
    periods and duplicate clients would have made of it, and the people on those rows.
    """
    days = sessions.select(F.col("sender").alias("user_id"), "card_type_new", "msg_date").distinct()
    # An add counts once per fiscal year whose newest message day is not before it.
    weighted = daily_adds.withColumn("_now", _newest(current)).withColumn(
        "_weight", F.size(F.filter("_now.max_msg_date", lambda end: end >= F.col("add_date")))
    )
    context = _running(days, weighted, sales).withColumnRenamed("user_id", "sender")
    rows = sessions.join(context, ["sender", "card_type_new", "msg_date"], "left").withColumn("_now", _newest(current))

    def entry(period: str, ordinal: Column, cls: Column, hits: Column, n: str, p: str) -> Column:
        count = F.coalesce(F.col(n), F.lit(0))
        return F.struct(
            F.lit(period).alias("time_period"),
            ordinal.alias("ordinal_number"),
            cls.alias("type"),
            (hits * F.greatest(count, F.lit(1)) * F.col("copies")).alias("repeat"),
            F.when(count > 0, hits * F.col(p) * F.col("copies")).alias("people"),
        )

    by_card, everyone = member_class(F.col("card_type_new")), F.lit(ALL_CLASS)
    entries = [entry("DTD", date_key(F.col("msg_date")), cls, F.lit(1), "_n", "_p") for cls in (by_card, everyone)]
    for period, label in PERIODS.items():
        newest, value = F.col("_now." + label.replace("fiscal", "current")), F.col(label)
        hits = _matches(newest, value, or_later=rules.up_to_current and period != "YTD")
        ordinal = value if period == "YTD" else F.substring(value, 5, 2)
        bounded = ("_nk", "_pk") if rules.all_class_as_of else ("_nk_all", "_pk_all")
        entries.append(entry(period, ordinal, by_card, hits, "_nk_all", "_pk_all"))
        entries.append(entry(period, ordinal, everyone, hits, *bounded))
    spread = F.inline(F.filter(F.array(*entries), lambda e: e["repeat"] > 0))
    return rows.select(
        *ORG, "sender", "receiver", F.col("fiscal_year").alias("year"), "is_session", "is_quality_session",
        "successful_sales_amount", "consumption_amount", spread,
    )


def measure(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Report measures per key: repeated sums, and receivers counted once."""
    n = F.col("repeat")
    return distinct_counts(
        rows,
        keys,
        "receiver",
        flags={
            "commnunation_people_count": F.col("is_session") >= 1,
            "quality_commnunation_people_count": F.col("is_quality_session") == 1,
        },
        sums={
            "people": F.col("people"),
            "commnunation_count": F.col("is_session") * n,
            "quality_commnunation_count": F.col("is_quality_session") * n,
            "successful_sales_amount": F.col("successful_sales_amount") * n,
            "consumption_amount": F.col("consumption_amount") * n,
        },
    ).select(*keys, *MEASURES)


def _channel() -> Column:
    code = F.col("counter_type_code")
    expr = F
    for value, label in CHANNEL_TOTALS.items():
        expr = expr.when(code == value, label)
    return expr.otherwise(code)


def org_levels() -> dict[int, tuple[Column, Column]]:
    """Level number to (organisation, store name): total, channel, region, sub-region, store."""
    none = F.lit("")
    return {
        0: (none, none),
        1: (_channel(), none),
        2: (F.col("region"), none),
        3: (F.col("region_detail"), none),
        4: (F.col("store_nbr"), F.col("local_name")),
    }


def per_receiver(rows: DataFrame) -> DataFrame:
    """Period rows folded to one per place, receiver, period and client class: sums, and whether there was any session."""
    n = F.col("repeat")
    return rows.groupBy(*PLACE, "receiver", "year", "time_period", "ordinal_number", "type").agg(
        F.sum("people").alias("people"),
        *(F.sum(F.col(c) * n).alias(c) for c in ("is_session", "is_quality_session", "successful_sales_amount", "consumption_amount")),
        F.max("is_session").alias("any_session"),
        F.max("is_quality_session").alias("any_quality_session"),
    )


def org_rollup(rows: DataFrame, levels: Sequence[int] = (0, 1, 2, 3, 4)) -> DataFrame:
    """Measures at every organisation level in one pass over the period rows.

    Rows are folded per place and receiver first, in the map tasks as well; what is spread over the levels is one row of
    each such group. Receivers are counted once per level from those.
    """
    known = org_levels()
    spread = F.inline(
        F.array(
            *(
                F.struct(F.lit(n).alias("organize_type"), known[n][0].alias("organize"), known[n][1].alias("store_name"))
                for n in levels
            )
        )
    )
    keys = ["organize_type", "organize", "store_name", "year", "time_period", "ordinal_number", "type"]
    return distinct_counts(
        per_receiver(rows).select("*", spread),
        keys,
        "receiver",
        flags={"commnunation_people_count": F.col("any_session") >= 1, "quality_commnunation_people_count": F.col("any_quality_session") == 1},
        sums={
            "people": F.col("people"),
            "commnunation_count": F.col("is_session"),
            "quality_commnunation_count": F.col("is_quality_session"),
            "successful_sales_amount": F.col("successful_sales_amount"),
            "consumption_amount": F.col("consumption_amount"),
        },
    ).select(*keys, *MEASURES)


def stamp(report: DataFrame, daily_adds: DataFrame) -> DataFrame:
    """Prefix the newest add date."""
    newest = daily_adds.agg(F.max("add_date").alias("d")).select("d").scalar()
    return report.select(newest.alias("data_date"), "*")


@dataclass
class ReachSources:
    """Input frames of the reach reports."""

    clients: DataFrame
    contacts: DataFrame
    chat: DataFrame
    periods: DataFrame
    brand: str | None = None
    #: May store a frame, for example as a table, so that later steps read it instead of the feed.
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df


def _org_pair_days(src: ReachSources) -> DataFrame:
    staff = associates(src.clients)
    since = fiscal_start(src.clients).select("fy_start_date").scalar()
    messages = filter_messages(src.chat, staff, since, brand=src.brand, dedup=False, to_staff=True)
    return src.stage(pair_days(messages, staff), "org_pair_days")


def _org_sessions(src: ReachSources, days: DataFrame) -> DataFrame:
    return session_counts(days, associates(src.clients), receivers(src.clients, src.contacts), src.periods)


def org_sessions(src: ReachSources) -> DataFrame:
    return _org_sessions(src, _org_pair_days(src))


def org_period_rows(src: ReachSources) -> DataFrame:
    days = _org_pair_days(src)
    # The current periods follow from the days alone, without counting sessions.
    current = current_period(attach_periods(days.select("msg_date").distinct(), src.periods))
    return ptd_rows(_org_sessions(src, days), amounts(src.clients), adds(src.clients), current)


def org_reach(src: ReachSources, levels: Sequence[int] = (0, 1, 2, 3, 4)) -> DataFrame:
    """The organisation report: five levels, five periods to date, four client classes."""
    return stamp(org_rollup(org_period_rows(src), levels), adds(src.clients))


def _day(value: dt.date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def newest_day(chat: DataFrame) -> Column:
    """The newest message day, as a scalar."""
    return chat.agg(F.max(F.to_date(F.substring("msgtime", 1, 10))).alias("d")).select("d").scalar()


def _key_pair_days(src: ReachSources, calendar: DataFrame, as_of: dt.date | Column) -> DataFrame:
    staff = associates(src.clients, key_only=True)
    since = fiscal_year_opening(calendar, as_of).select("start_timewindow").scalar()
    messages = filter_messages(src.chat, staff, since, _day(as_of), brand=src.brand, dedup=False, to_staff=True)
    return src.stage(pair_days(messages, staff), "key_pair_days")


def associate_reach(src: ReachSources, calendar: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    """The key-associate report up to ``as_of``, by default the newest message day.

    Weeks, months and quarters up to the current one are kept.
    """
    days = _key_pair_days(src, calendar, newest_day(src.chat) if as_of is None else as_of)
    pairs = receivers(src.clients, src.contacts)
    known = semi(days, pairs, {"receiver": "openid"})
    current = current_period(attach_periods(known.select("msg_date").distinct(), src.periods))
    daily_adds = adds(src.clients, key_only=True)
    sessions = key_session_counts(days, associates(src.clients, key_only=True), pairs, src.periods)
    rows = ptd_rows(sessions, amounts(src.clients, key_only=True), daily_adds, current, ASSOCIATE_RULES)
    named = rows.select(
        F.col("sender").alias("sa_code"), F.col("name").alias("sa_name"), F.col("store_nbr").alias("store_code"),
        F.col("local_name").alias("store_name"), *(c for c in rows.columns if c not in ("sender", *ORG)),
    )
    keys = ["sa_code", "sa_name", "store_code", "store_name", "year", "time_period", "ordinal_number", "type"]
    return stamp(measure(named, keys), daily_adds)

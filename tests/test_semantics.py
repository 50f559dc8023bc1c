"""Semantics that are easy to get wrong, on small inline frames with hand-worked results."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shopfloor.functions import columns as C
from shopfloor.functions.aggregates import count_when, distinct_when, sum_when
from shopfloor.operators import aggregation, calendar, lookups, sessions
from shopfloor.operators.sequence import event_sequence, first_day_rows
from shopfloor.plans import chat, customers, products, reach, telemetry, transactions


def one(spark, expr, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()), F.lit(0).alias("_"))
    return row.select(expr.alias("x")).first()["x"]


def ts(text):
    return dt.datetime.fromisoformat(text)


def rows(df, *names):
    return sorted((tuple(r[n] for n in (names or df.columns)) for r in df.collect()), key=lambda r: [(x is not None, str(x)) for x in r])


# --- scalar helpers -------------------------------------------------------------------


@pytest.mark.parametrize(
    "a,b,want",
    [
        ("2024-01-01 10:00:59", "2024-01-01 11:01:00", 61),
        ("2024-01-01 10:00:00", "2024-01-01 11:00:59", 60),
        ("2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:59", 0),
    ],
)
def test_minute_boundaries(spark, a, b, want):
    expr = C.minute_boundaries(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"))
    assert one(spark, expr, a=a, b=b) == want


def test_strip_chars_deletes_a_set(spark):
    assert one(spark, C.strip_chars(F.col("a"), "BA"), a="AB-12BA") == "-12"


def test_round_half_up_rounds_once(spark):
    for x, want in ((0.0049996, 0.0), (1.0049997, 1.0), (1e13 + 0.25, 1e13 + 0.25), (-0.125, -0.13), (2.5049999, 2.5)):
        assert float(one(spark, C.round_half_up(F.col("a")), a=x)) == want


def test_round_half_up_ignores_binary_tail(spark):
    assert float(one(spark, C.round_half_up(F.col("a")), a=1.005)) == 1.01
    assert float(one(spark, C.round_half_up(F.col("a")), a=-2.675)) == -2.68


def test_text_helpers(spark):
    assert one(spark, C.clean_control(F.col("a")), a="a\tb\nc") == "a b c"
    assert one(spark, C.is_blank(F.col("a")), a="  ") is True
    assert one(spark, C.two_digit_year(F.col("a")), a="FY24") == 2024
    assert one(spark, C.two_digit_year(F.col("a")), a="none") is None
    assert one(spark, C.is_external_id(F.col("a")), a="wbx") is False
    assert one(spark, C.valid_media_id(F.col("a")), a="A" * 32) is True
    assert one(spark, C.date_key(F.col("a").cast("date")), a="2024-03-05") == "20240305"
    assert one(spark, C.epoch_millis_text(F.col("a")), a=0) == "1970-01-01 08:00:00"
    assert one(spark, C.safe_div(F.col("a"), F.lit(0)), a=1) is None


def test_conditional_aggregates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 5), (None, 9)], "k string, v int")
    got = df.agg(
        distinct_when(F.col("k"), F.col("v") > 1).alias("d"), count_when(F.col("v") > 1).alias("c"), sum_when(F.col("v"), F.col("v") > 1).alias("s")
    ).first()
    assert (got.d, got.c, got.s) == (2, 3, 19)


# --- lookups --------------------------------------------------------------------------


def _bands(spark):
    return spark.createDataFrame([("a", 1, 10, 1.0), ("a", 8, 20, 2.0), ("a", 9, 9, 3.0), ("b", 1, 364, 4.0)], "k string, lo int, hi int, v double")


def test_banded_lookup_keeps_overlaps_and_gaps(spark):
    fact = spark.createDataFrame([("a", 5), ("a", 9), ("a", 30), ("b", 370), (None, 5)], "f string, at int")
    plain = lookups.banded_lookup(fact, _bands(spark), {"f": "k"}, "at", "lo", "hi", {"v": "v"})
    assert rows(plain) == [(None, 5, None), ("a", 30, None), ("a", 5, 1.0), ("a", 9, 1.0), ("a", 9, 2.0), ("a", 9, 3.0), ("b", 370, None)]
    patched = lookups.banded_lookup(fact, _bands(spark), {"f": "k"}, "at", "lo", "hi", {"v": "v"}, patch_high=(364, 371))
    assert ("b", 370, 4.0) in rows(patched)


def test_folded_lookups_equal_joins(spark):
    """Two band tables with overlaps, gaps, a further equality, missing and null keys."""
    fact = spark.createDataFrame([(k, a, x) for k in ("a", "b", "c", None) for a in (0, 5, 9, None) for x in (1, 2, None)], "k string, at int, x int")
    one = spark.createDataFrame([("a", 0, 5, 1, 10), ("a", 5, 9, 1, 11), ("a", 5, 9, 2, 12), ("b", 3, 6, 2, 13), (None, 0, 9, 1, 14)], "k string, lo int, hi int, x int, v int")
    two = spark.createDataFrame([("a", 0, 9, 20), ("a", 4, 9, 20), ("c", 9, 9, 21), ("c", 9, None, 22)], "k string, lo int, hi int, w int")
    got = lookups.folded_lookups(fact, "k", "at", lookups.Bands(one, "k", "lo", "hi", {"v": "v"}, {"x": "x"}), lookups.Bands(two, "k", "lo", "hi", {"w": "w"}))
    want = lookups.banded_lookup(fact, one, {"k": "k", "x": "x"}, "at", "lo", "hi", {"v": "v"})
    want = lookups.banded_lookup(want, two, {"k": "k"}, "at", "lo", "hi", {"w": "w"})
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_banded_lookup_unique_takes_latest_start(spark):
    fact = spark.createDataFrame([("a", 5), ("a", 8), ("a", 9), ("a", 10), ("a", 9)], "f string, at int")
    got = lookups.banded_lookup(fact, _bands(spark), {"f": "k"}, "at", "lo", "hi", {"v": "v"}, unique=True)
    assert rows(got) == [("a", 10, 2.0), ("a", 5, 1.0), ("a", 8, 2.0), ("a", 9, 3.0), ("a", 9, 3.0)]


def test_not_in_with_null_in_the_list(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    keys = spark.createDataFrame([("x",), (None,)], "k string")
    assert rows(lookups.anti_not_in(df, keys, "c", "k")) == [("y",)]
    assert rows(lookups.anti_not_in(df, keys, "c", "k", null_safe=False)) == []
    assert len(rows(lookups.anti_not_in(df, keys.limit(0), "c", "k"))) == 3


def test_new_ids_of_an_empty_known_list(spark):
    df = spark.createDataFrame([("x",), ("y",)], "id string")
    assert rows(lookups.new_ids(df, df.limit(0), "id")) == [("x",), ("y",)]
    assert rows(lookups.new_ids(df, df, "id")) == []


def test_full_outer_keeps_null_keys_apart(spark):
    a = spark.createDataFrame([(1, None, 10), (1, "g", 20)], "d int, k string, a int")
    b = spark.createDataFrame([(1, None, 1), (1, "g", 2)], "d int, k string, b int")
    assert rows(lookups.full_outer_coalesce(a, b, ["d", "k"])) == [(1, None, None, 1), (1, None, 10, None), (1, "g", 20, 2)]


def test_latest_puts_null_first(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("a", None, "q"), ("b", 2, "z"), ("b", 2, "y")], "k string, o int, t string")
    assert rows(aggregation.latest(df, ["k"], "o", ["t"])) == [("a", None, "q"), ("b", 2, "y")]


def test_distinct_counts_match_plain_form(spark):
    rng = random.Random(7)
    data = [(rng.choice("ab"), rng.choice([None, *"uvwxyz"]), rng.randint(0, 3)) for _ in range(300)]
    df = spark.createDataFrame(data, "k string, item string, n int")
    got = aggregation.distinct_counts(df, ["k"], "item", {"any": F.col("n") >= 1, "two": F.col("n") == 2}, {"total": F.col("n")})
    want = df.groupBy("k").agg(
        F.sum("n").alias("total"), distinct_when(F.col("item"), F.col("n") >= 1).alias("any"), distinct_when(F.col("item"), F.col("n") == 2).alias("two")
    )
    assert rows(got, "k", "total", "any", "two") == rows(want, "k", "total", "any", "two")


# --- order numbers --------------------------------------------------------------------


def test_event_sequence_against_brute_force(spark):
    rng = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    # One key holds most rows, with many ties and several moments a day.
    data = [("hot" if rng.random() < 0.8 else rng.choice("ab"), i, base + dt.timedelta(hours=6 * rng.randint(0, 40))) for i in range(250)]
    df = spark.createDataFrame(data, "k string, id int, at timestamp_ntz")
    got = {r.id: (r.rn, r.drn, r.first_at, r.prev_at) for r in event_sequence(df, ["k"], "at").collect()}
    for k, i, at in data:
        mine = [x[2] for x in data if x[0] == k]
        earlier = [x for x in mine if x < at]
        assert got[i] == (len(earlier) + 1, len(set(earlier)) + 1, min(mine), max(earlier, default=None))


def test_first_day_rows(spark):
    df = spark.createDataFrame([("a", 1, dt.date(2024, 1, 1)), ("a", 2, dt.date(2024, 1, 1)), ("a", 3, dt.date(2024, 1, 2))], "k string, id int, day date")
    assert rows(first_day_rows(df, "k", "day"), "id") == [(1,), (2,)]


def _head_lines(spark, data):
    return spark.createDataFrame(data, "customer_id string, txn_nbr int, txn_datetime timestamp_ntz, sale_credit_code string").select(
        "*", F.to_date("txn_datetime").alias("txn_date"), F.lit("CN").alias("country_code"), F.lit(1.0).alias("local_item_net_amt")
    )


def test_order_numbers_sales_and_credits(spark):
    lines = _head_lines(
        spark,
        [
            ("X9", 1, ts("2024-01-01 09:00"), "2"),
            ("X9", 2, ts("2024-01-01 10:00"), "1"),
            ("X9", 3, ts("2024-01-01 10:00"), "1"),
            ("X9", 4, ts("2024-01-03 10:00"), "1"),
            ("-1", 5, ts("2024-01-01 10:00"), "1"),
        ],
    )
    got = {r.txn_nbr: r for r in transactions.order_numbers(lines).collect()}
    assert set(got) == {1, 2, 3, 4}  # anonymous customers carry no order
    assert [(got[i].txn_rn, got[i].txn_drn) for i in (1, 2, 3, 4)] == [(1, 1), (2, 2), (2, 2), (4, 3)]
    assert [(got[i].pur_rn, got[i].pur_drn) for i in (1, 2, 3, 4)] == [(None, None), (1, 1), (1, 1), (3, 2)]
    assert got[4].cust_prev_txn_datetime == ts("2024-01-01 10:00") and got[4].days_since_cust_prev_txn == 2
    assert got[1].cust_first_pur_date == ts("2024-01-01 10:00") and not got[1].on_first_pur_date
    assert got[2].on_first_pur_date and not got[4].on_first_pur_date
    assert rows(transactions.first_purchase_txns(lines)) == [("X9", 2), ("X9", 3)]


# --- sessions -------------------------------------------------------------------------


def _messages(spark, times, receiver="r"):
    data = [("s", receiver, ts(t), ts(t).date()) for t in times]
    return spark.createDataFrame(data, "sender string, receiver string, msgtime timestamp_ntz, msg_date date")


def test_session_gaps(spark):
    m = _messages(spark, ["2024-01-01 10:00:59", "2024-01-01 11:00:00", "2024-01-01 12:01:00", "2024-01-01 12:01:00", "2024-01-02 00:00:01"])
    marked = rows(sessions.mark_sessions(m), "msgtime", "is_new_session")
    assert [x[1] for x in marked] == [1, 0, 1, 1]  # 60 boundaries stay, 61 open, a new day always opens
    assert sum(r.is_new_session for r in sessions.mark_sessions(m, dedup=False).collect()) == 3
    assert sessions.mark_sessions(m, dedup=False).count() == 5


def test_daily_sessions_equal_summed_markers(spark):
    rng = random.Random(11)
    base = dt.datetime(2024, 1, 1, 10)
    times = [(base + dt.timedelta(days=rng.randint(0, 3), seconds=rng.randint(0, 43200))).isoformat(sep=" ") for _ in range(120)]
    m = _messages(spark, times).unionByName(_messages(spark, times[:40], "q"))
    want = sessions.mark_sessions(m).groupBy("sender", "receiver", "msg_date").agg(F.sum("is_new_session").alias("sessions"))
    assert rows(sessions.daily_sessions(m)) == rows(want)


def test_message_filter_edges(spark):
    chat_rows = [
        ("Main", "a1", "c1", "2024-01-01 09:59:59"),
        ("Main", "a1", "c1", "2024-01-01 10:00:00"),
        ("Main", "a1", "c1", "2024-01-01 10:00:00"),
        ("Main", "a1", "c1", "2024-01-01 22:00:00"),
        ("Main", "a1", "c1", "2024-01-01 22:00:01"),
        ("Main", "a1", "a2", "2024-01-01 12:00:00"),
        ("Main", "zz", "c1", "2024-01-01 12:00:00"),
        ("Other", "a1", "c1", "2024-01-01 12:00:00"),
        ("Main", "a1", None, "2024-01-01 12:00:00"),
    ]
    chats = spark.createDataFrame(chat_rows, "brand_code string, sender_external_userid string, receiver_external_userid string, msgtime string")
    staff = spark.createDataFrame([("a1",), ("a2",), (None,)], "user_id string")
    got = reach.filter_messages(chats, staff, brand="Main")
    assert [r[0] for r in rows(got, "msgtime")] == [ts("2024-01-01 10:00:00"), ts("2024-01-01 22:00:00")]


# --- period report --------------------------------------------------------------------


def test_member_classes(spark):
    df = spark.createDataFrame([(c,) for c in ("DIAMOND,", "DIAMOND", "GOLD", "Non-Member", "VIP", None)], "card string")
    got = [r[0] for r in df.select(reach.member_class(F.col("card"))).collect()]
    assert got == [2, 3, 2, 4, 3, 3]


def _session_row(day, week, year, card="GOLD", n=1, receiver="c1"):
    return (day, week, week, week, year, "s1", *["x"] * 6, receiver, "w1", card, n, int(n >= 2), 1)


_SESSION_SCHEMA = (
    "msg_date date, fiscal_week string, fiscal_month string, fiscal_quarter string, fiscal_year string, sender string, name string, "
    "local_name string, store_nbr string, counter_type_code string, region string, region_detail string, receiver string, "
    "work_external_user_id string, card_type_new string, is_session long, is_quality_session int, copies long"
)


def test_period_rows_repeat_like_the_joins(spark):
    d = dt.date
    s = spark.createDataFrame(
        [_session_row(d(2024, 1, 3), "202401", "2024"), _session_row(d(2024, 1, 10), "202402", "2024", n=2), _session_row(d(2024, 1, 10), "202402", "2024", card=None)],
        _SESSION_SCHEMA,
    )
    adds = spark.createDataFrame(
        [(d(2024, 1, 1), "s1", "GOLD", 3), (d(2024, 1, 9), "s1", "GOLD", 4), (d(2024, 1, 20), "s1", "GOLD", 9)],
        "add_date date, user_id string, card_type_new string, people long",
    )
    sales = spark.createDataFrame(
        [(d(2024, 1, 10), "s1", "GOLD", 10.0, None)],
        "txn_date date, user_id string, card_type_new string, successful_sales_amount double, consumption_amount double",
    )
    report = reach.org_rollup(reach.ptd_rows(s, sales, adds, reach.current_period(s)), levels=(0,))
    got = {(r.time_period, r.ordinal_number, r.type): r for r in report.collect()}
    # Day 10: two adds so far repeat the member session twice; the card-less one appears once.
    r = got["DTD", "20240110", 2]
    assert (r.people, r.commnunation_count, r.commnunation_people_count, r.quality_commnunation_count, r.successful_sales_amount) == (7, 4, 1, 2, 20.0)
    assert got["DTD", "20240110", 1].commnunation_count == 5 and got["DTD", "20240110", 3].people is None
    # Current week only; adds after the newest message day never count.
    assert ("WTD", "01", 2) not in got and got["WTD", "02", 2].people == 7
    # Year, member class: both sessions see both adds; all clients: adds up to the message day.
    assert got["YTD", "2024", 2].people == 14 and got["YTD", "2024", 1].people == 10
    assert got["YTD", "2024", 2].commnunation_count == 6 and got["YTD", "2024", 1].commnunation_count == 6
    assert got["YTD", "2024", 2].consumption_amount is None


def test_total_level_equals_sum_of_stores(spark, folder):
    from shopfloor.registry import QUERIES

    report = QUERIES["org_rollup"](spark, folder).where("time_period = 'DTD'").persist()
    total = lambda level, cls: report.where((F.col("organize_type") == level) & F.col("type").isin(cls)).agg(F.sum("commnunation_count")).first()[0]
    assert total(0, [1]) == total(4, [1]) == total(0, [2, 3, 4])
    report.unpersist()


# --- products, customers --------------------------------------------------------------


def test_sku_shapes(spark):
    cases = {
        "OC1234C0001M": ("OC1234", "C0001", "M"),
        "OC123*ABCDEF": ("123", "", None),
        "OC1234*ABCDEF": ("1234", "", None),
        "CPN-12345-C0001-9": ("12345", "C0001", "9"),
        "OPR123C000177": ("OPR123", "C0001", "77"),
        "123456DUM9": ("123456", None, "DUM9"),
        "FF1234C00018": ("FF1234", "C0001", "8"),
        "FL123456": ("123456", "", None),
    }
    df = spark.createDataFrame([(i, s, s, None, None, "0") for i, s in enumerate(cases)], "id int, code string, style string, style_color string, size string, upc_code string")
    for r in products.parse_sku(df).collect():
        style, color, size = cases[r.sku_code]
        assert r.style == style and r.size == size and r.upc is None
        assert color is None or r.color == color


def test_employee_flag_needs_a_second_group(spark):
    cust = spark.createDataFrame([("k", "Main", 1980, "F", "O", "HK")], "customer_id string, brand_code string, birth_year int, gender_code string, customer_type string, exact_country string")
    types = spark.createDataFrame([("O",)], "code string")
    addr = spark.createDataFrame([("k", "Main", "p1"), ("k", "Main", "p2")], "customer_id string, brand_code string, province_code string")
    prov = spark.createDataFrame([("p1", "China"), ("p2", "OTHERS")], "code string, country_code string")
    res = spark.createDataFrame([("China", "CN"), ("HK", "HK")], "residence_country string, country_code string")
    got = customers.customer_profile(cust, types, addr, prov, res, "Main")
    assert rows(got, "residence_country", "employee_status_code") == [("CN", "E"), ("HK", "F")]


def test_discount_flags(spark):
    df = spark.createDataFrame([(90.0, 1.0, 100.0), (91.0, 1.0, 100.0), (5.0, 0.0, 9.0), (5.0, 1.0, None)], "local_item_net_amt double, item_sold_qty double, local_msrp double")
    assert [r.discount_flag for r in transactions.discount(df).collect()] == [1, 0, -1, 0]


def test_calendar_year_boundary(spark):
    days = calendar.calendar_days(spark, dt.date(2024, 6, 30), dt.date(2024, 7, 1), 7, 1)
    assert rows(days, "fisc_year_num", "fisc_month_num", "fisc_week_of_year_num", "fisc_year_day_num") == [(2024, 12, 53, 366), (2025, 1, 1, 1)]


# --- chat -----------------------------------------------------------------------------


def _norm(spark, *texts, **limits):
    feed = spark.createDataFrame([(i, f"m{i}", t) for i, t in enumerate(texts)], "seq int, msgid string, message string")
    return chat.normalize(feed, with_ext=True, **limits)


def test_receiver_shapes(spark):
    got = _norm(
        spark,
        '{"from":"a"}',
        '{"from":"a","tolist":[]}',
        '{"from":"a","tolist":["x","y"]}',
        '{"from":"a","tolist":"x"}',
        '{"from":"a","tolist":"[x]"}',
        '{"from":"a","tolist":{"k":1}}',
        "not json",
        '{"from":null,"tolist":["x"]}',
    )
    assert rows(got, "seq", "receiver") == [(0, ""), (2, "x"), (2, "y"), (3, '"x"'), (4, '"[x]"'), (5, '{"k":1}'), (7, "x")]
    assert rows(got.where("seq = 7"), "sender") == [("null",)]


def test_payload_rules(spark):
    long_id = "A" * 40
    got = _norm(
        spark,
        '{"msgtype":"chatrecord","chatrecord":{"t":"%s"},"tolist":["r"]}' % ("x" * 60001),
        '{"msgtype":"file","file":{"sdkfileid":" %s ","fileext":"{\\"fileext\\":\\"pdf\\"}"},"tolist":["r"]}' % long_id,
        '{"msgtype":"file","file":{"sdkfileid":"short","fileext":"{oops}"},"tolist":["r"]}',
        '{"msgtype":"image","image":{"sdkfileid":"%s","md5sum":"q","fileext":"zip"},"tolist":["r"]}' % long_id,
        '{"msgtype":"text","text":{"content":"a\tb"},"tolist":["r"]}',
        max_record_chars=60000,
        min_media_id_chars=32,
    )
    by_seq = {r.seq: r for r in got.collect()}
    assert by_seq[0].raw_json == "{}"
    assert (by_seq[1].sdkfileid, by_seq[1].fileext, by_seq[1].md5sum) == (long_id, "pdf", "")
    assert (by_seq[2].sdkfileid, by_seq[2].fileext) == ("", "")
    assert (by_seq[3].fileext, by_seq[3].md5sum) == ("", "q")
    assert by_seq[4].raw_json == '{"content":"a b"}' and by_seq[4].msgtime == "1970-01-01 08:00:00"


def test_manifest_first_wins_and_counts(spark):
    a, b = "A" * 32, "B" * 32
    data = [
        (1, "image", a, "m", ""), (2, "image", b, "m", ""), (3, "File", a, "m", "pdf"), (4, "image", "x", "m", ""),
        (5, "text", a, "m", ""), (6, "image", a, " ", ""), (7, "file", a, "m", "pdf"),
    ]
    df = spark.createDataFrame(data, "seq int, msgtype string, sdkfileid string, md5sum string, fileext string")
    assert rows(chat.media_manifest(df)) == [("File", a, "m", "dat"), ("file", a, "m", "pdf"), ("image", a, "m", "jpg")]
    assert tuple(chat.manifest_counts(df).first()) == (7, 3, 3, 1)
    keys = {r.msgtype: r.media_key for r in chat.media_key(chat.media_manifest(df)).collect()}
    assert keys == {"File": "raw/chat/media/unknown/m.dat", "file": "raw/chat/media/file/m.pdf", "image": "raw/chat/media/image/m.jpg"}


def test_cursor(spark):
    feed = spark.createDataFrame([(3,), (7,)], "seq int")
    assert rows(chat.incremental_slice(feed, 4)) == [(7,)]
    assert chat.next_cursor(feed, 4).first().next_seq == 8
    assert chat.next_cursor(feed.limit(0), 4).first().next_seq == 4


def test_error_labels_and_codes(spark):
    log = spark.createDataFrame([(10001, "f"), (10003, "g"), (5, "g")], "ret_code int, sdkfileid string")
    assert [(r.error_class, r.retryable) for r in telemetry.classify(log).collect()] == [("网络波动", True), ("未知错误(10003)", True), ("未知错误(5)", False)]
    assert rows(telemetry.error_codes(log), "ret_code") == [(10003,), (5,)]
    assert telemetry.error_codes(log, exclude=()).count() == 3


def _normalized(spark, *messages):
    feed = spark.createDataFrame([(i, f"m{i}", m) for i, m in enumerate(messages)], "seq long, msgid string, message string")
    return chat.normalize(feed, with_ext=True)


def test_receivers_follow_the_type_of_the_list(spark):
    cases = {
        '{"tolist":["p","q"],"msgtype":"chatrecord","chatrecord":{"tolist":"z"}}': ["p", "q"],
        '{"tolist" : "x"}': ['"x"'],
        '{"tolist":"[1]"}': ['"[1]"'],
        '{"tolist": [ "p" , "p" ]}': ["p", "p"],
        '{"tolist":7}': ["7"],
        '{"tolist":null}': ["null"],
        '{"tolist":{"a":1}}': ['{"a":1}'],
        '{"tolist":[]}': [],
        '{"a":1}': [""],
    }
    got = {}
    for r in _normalized(spark, *cases).collect():
        got.setdefault(r["seq"], []).append(r["receiver"])
    assert [got.get(i, []) for i in range(len(cases))] == list(cases.values())


def test_payloads_and_media_ids_stay_whole(spark):
    long = '{"msgtype":"chatrecord","chatrecord":{"item":"' + "x" * 70000 + '"}}'
    short = '{"msgtype":"image","image":{"sdkfileid":"abc"}}'
    nested = '{"msgtype":"file","file":{"fileext" : {"fileext":"pdf"}}}'
    rows = {r["seq"]: r for r in _normalized(spark, long, short, nested).collect()}
    assert len(rows[0]["raw_json"]) > 70000 and rows[1]["sdkfileid"] == "abc" and rows[2]["fileext"] == ""
    feed = spark.createDataFrame([(0, "a", long), (1, "b", short), (2, "c", "{oops")], "seq long, msgid string, message string")
    limited = {r["seq"]: r for r in chat.normalize(feed, max_record_chars=60000, min_media_id_chars=32).collect()}
    assert limited[0]["raw_json"] == "{}" and limited[1]["sdkfileid"] == ""
    assert tuple(chat.normalize_counts(feed).first()) == (3, 2, 1)
    assert [r["msgid"] for r in chat.rejected_messages(feed).collect()] == ["c"]


def test_fact_counts_products_of_equal_look_once(spark, folder):
    """Product rows of one id that differ in unseen columns only must not repeat a line."""
    from dataclasses import replace

    from shopfloor import registry
    from shopfloor.bindings import Domain

    src = registry._txn_sources(Domain(spark, folder.replace("sf0.01", "sf0.001")))
    unseen = src.products.withColumn("upc_code", F.lit("other")).withColumn("sku", F.lit("other"))
    plain = transactions.transaction_fact(src).count()
    assert transactions.transaction_fact(replace(src, products=src.products.unionByName(unseen))).count() == plain


def _shuffled_by_product(df, key="product_id", mark="l_orderkey"):
    """Whether lines are below an exchange by product, or another key, in the plan without adaptive execution and broadcasts."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: df.sparkSession.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            df.sparkSession.conf.set(k, v)
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k, v in before.items():
            df.sparkSession.conf.set(k, v)
    depth = lambda line: len(line) - len(line.lstrip(" :+-|*()0123456789"))
    for i, line in enumerate(plan):
        if f"Exchange hashpartitioning({key}" in line:
            below = next((j for j in range(i + 1, len(plan)) if depth(plan[j]) <= depth(line)), len(plan))
            if any(mark in x for x in plan[i:below]):
                return True
    return False


@pytest.mark.parametrize("name", ["txn_enriched", "comparable_store", "txn_final"])
def test_lines_are_never_shuffled_by_product(spark, folder, name):
    """All unresolved lines have one product, which would land in one task."""
    from shopfloor.registry import QUERIES

    assert not _shuffled_by_product(QUERIES[name](spark, folder.replace("sf0.01", "sf0.001")))


def test_priced_lines_of_the_fact_are_not_shuffled_again(spark, folder):
    """The order numbers come with the headers, and the DISTINCT runs where the SKU join left the lines."""
    from shopfloor.registry import QUERIES

    assert not _shuffled_by_product(QUERIES["txn_final"](spark, folder.replace("sf0.01", "sf0.001")), "txn_nbr", "local_msrp")


def test_equal_lines_of_several_codes_count_once(spark, folder):
    """A SKU id with two codes, and lines without a number: equal lines lie in several partitions of the SKU join."""
    from dataclasses import replace

    from shopfloor import registry
    from shopfloor.bindings import Domain

    src = registry._txn_sources(Domain(spark, folder.replace("sf0.01", "sf0.001")))
    assert transactions.one_code_a_line(src)
    twice = lambda df: df.unionByName(df.withColumn("sku_code", F.concat(F.lit("T"), "sku_code")))
    twins = replace(src, details=twice(src.details), sku_lookup=twice(src.sku_lookup), skus=twice(src.skus))
    assert not transactions.one_code_a_line(twins)
    assert transactions.transaction_fact(twins).count() == transactions.transaction_fact(src).count()

    few = src.details.where("local_txn_amount % 7 < 3").withColumn("local_txn_amount", F.lit(9).cast("decimal(12,2)")).withColumn("usd_txn_amount", F.lit(2).cast("decimal(12,2)"))
    nameless = replace(src, headers=src.headers.withColumn("id", F.lit(None).cast("bigint")), details=few)
    assert not transactions.one_code_a_line(nameless)
    stored = transactions.transaction_fact(nameless, stage=lambda df, name: df)
    assert transactions.transaction_fact(nameless).exceptAll(stored).count() == 0 and transactions.transaction_fact(nameless).count() == stored.count()


def test_places_by_number_equal_the_days_joined_whole(spark):
    """Several places of a counter, places that repeat, null columns, a counter without days."""
    days = spark.createDataFrame(
        [("a", d, 4, s, c, r) for d in (1, 2) for s, c, r in (("a", "CNY", "x"), ("a", "CNY", None), ("a", None, "x"), ("a", "CNY", "x"))] + [("b", 1, 5, "b", "HKD", None)],
        "counter_code string, txn_date int, price_list_key int, store_nbr string, local_currency string, region_desc string",
    )
    lines = spark.createDataFrame([("a", 1, 10), ("a", 2, 11), ("a", 3, 12), ("b", 1, 13), ("b", 1, 13), (None, 1, 14)], "counter_code string, txn_date int, n int")
    narrow, places = transactions.split_places(days)
    assert "store_nbr" not in narrow.columns and places.count() == 4
    packed = narrow.select("counter_code", "txn_date", F.struct("price_list_key", "_place").alias(transactions.DAY))
    got = transactions.unpack_day(transactions.with_places(lines.join(packed, ["counter_code", "txn_date"]), places))
    want = lines.join(days, ["counter_code", "txn_date"])
    shown = ["counter_code", "txn_date", "n", "price_list_key", "store_nbr", "local_currency", "region_desc"]
    assert sorted(map(str, got.select(*shown).collect())) == sorted(map(str, want.select(*shown).collect()))


def test_lines_carry_no_column_that_the_row_tells(spark, folder):
    """What is shuffled by SKU: fiscal keys within the year, and numbers of the transaction only where the row tells none of them."""
    from shopfloor import registry
    from shopfloor.bindings import Domain

    src = registry._txn_sources(Domain(spark, folder.replace("sf0.01", "sf0.001")))
    seen = []
    stored = transactions.transaction_fact(src, stage=lambda df, name: seen.append(df) or df)
    day = {f.name: f.dataType.simpleString() for f in seen[0].schema[transactions.DAY].dataType.fields}
    assert "string" not in day.values() and not {"comp_year_ty", "comp_year_ly", "fisc_year_day_num", "fisc_year_week"} & set(day)
    assert transactions.transaction_fact(src).exceptAll(stored).count() == 0

    at = dt.datetime(2024, 3, 5, 9)
    numbers = spark.createDataFrame(
        [(1, "K1", at - dt.timedelta(5), 5, 3, 3, None, None, 1, 1), (2, "K2", at - dt.timedelta(2), 9, 4, 2, at, 0, 2, 2), (2, "K3", None, None, 1, 1, None, None, None, None)],
        "txn_nbr long, customer_id string, cust_prev_txn_datetime timestamp, days_since_cust_prev_txn int, txn_rn int, txn_drn int,"
        " cust_prev_pur_datetime timestamp, days_since_cust_prev_pur int, pur_rn int, pur_drn int",
    )
    rows = spark.createDataFrame([(1, "K1", at), (2, "K2", at), (2, None, at), (3, "K4", at), (1, "K1", None)], "txn_nbr long, customer_id string, txn_datetime timestamp")
    packed = transactions.with_numbers(rows, numbers)
    kept = {(r["txn_nbr"], r["customer_id"], r["txn_datetime"]): r[transactions.NUMBERS] for r in packed.collect() if r["txn_nbr"] == 1}
    assert [kept[1, "K1", at][x] for x in ("customer_id", "days_since_cust_prev_txn", "txn_drn")] == [None] * 3
    assert kept[1, "K1", None]["days_since_cust_prev_txn"] == 5
    n = transactions.whole_numbers()
    names = [x for x in numbers.columns if x != "txn_nbr"]
    got = packed.select("txn_nbr", F.col("customer_id").alias("own"), "txn_datetime", *(n(x) for x in names))
    want = rows.withColumnRenamed("customer_id", "own").join(numbers, "txn_nbr", "left").withColumn("customer_id", F.coalesce("customer_id", "own"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_dollars_of_the_source_where_no_rate_is_pegged(spark):
    """The fact carries them only there; amounts are the same as with all of them carried."""
    headers = spark.createDataFrame([(1, "P1", "K1", "A", (None,)), (2, "P2", "K1", "A", (2.0,))], "id long, purchase_code string, customer_id string, counter_code string, _day_of_store struct<_peg:double>")
    headers = headers.withColumn("txn_datetime", F.lit(dt.datetime(2024, 1, 1)))
    details = spark.createDataFrame([(p, "S", 10.0, 7.0, 1, None, 0) for p in ("P1", "P2")], "purchase_code string, sku_code string, local_txn_amount double, usd_txn_amount double, item_sold_qty int, retail_price double, return_flag int")
    skus = spark.createDataFrame([(5, "S", 9)], "sku_id long, sku_code string, product_id long")
    carried = {spare: {r["txn_nbr"]: r["usd_txn_amount"] for r in transactions.txn_lines(headers, details, skus, spare_usd=spare).collect()} for spare in (False, True)}
    assert carried == {False: {1: 7.0, 2: 7.0}, True: {1: 7.0, 2: None}}

"""Files, tables and streams."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from shopfloor.bindings import Domain
from shopfloor.plans import chat
from shopfloor.registry import QUERIES
from shopfloor.sources import files, schemas
from shopfloor.sources.tables import Tables
from shopfloor.streaming import chat as chat_stream


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_replaces_the_staged_table(spark, tmp_path):
    tables = Tables(spark)
    first = _write(tmp_path / "a.csv", 'external_userid\nwo1\nwo2\n')
    second = _write(tmp_path / "b.csv", 'external_userid\n"wo,3"\n')
    files.load_csv_overwrite(tables, first, schemas.EXTERNAL_ID_CSV, "staged_ids")
    assert _rows(files.load_csv_overwrite(tables, second, schemas.EXTERNAL_ID_CSV, "staged_ids")) == [("wo,3",)]
    tables.drop("staged_ids")
    assert not spark.catalog.tableExists("staged_ids")


def test_lenient_csv_skips_short_rows(spark, tmp_path):
    path = _write(tmp_path / "c.csv", 'a,b,c,d\n1,2,3,4\n1,2\n5,"6,6",7\n8,9,10,11,12\nx,2,3,\n')
    got = files.read_csv_lenient(spark, path, "a INT, b STRING, c INT, d INT", min_fields=3)
    key = lambda r: [(v is not None, str(v)) for v in r]
    want = [(1, "2", 3, 4), (5, "6,6", 7, None), (8, "9", 10, 11), (None, "2", 3, None)]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_envelopes(spark, tmp_path):
    lines = [
        json.dumps({"chatdata": [{"seq": 5, "msgid": "m5", "message": '{"from":"a","tolist":["b"]}'}, {"seq": "6", "msgid": "m6", "message": '{"from":"c"}'}]}),
        json.dumps({"errcode": 1}),
        "broken",
    ]
    feed = files.read_envelopes(spark, _write(tmp_path / "raw.txt", "\n".join(lines)))
    assert _rows(feed.select("seq", "msgid")) == [(5, "m5"), (6, "m6")]
    assert _rows(chat.normalize(feed).select("seq", "sender", "receiver")) == [(5, "a", "b"), (6, "c", "")]


def test_manifest_round_trip_and_array_form(spark, tmp_path):
    manifest = spark.createDataFrame([("image", "A" * 32, "m", "jpg")], schemas.MANIFEST_JSON)
    files.write_manifest(manifest, str(tmp_path / "manifest"))
    assert _rows(files.read_manifest(spark, str(tmp_path / "manifest"))) == _rows(manifest)
    path = _write(tmp_path / "m.json", json.dumps([manifest.first().asDict()] * 2, indent=2))
    assert _rows(files.read_manifest(spark, path)) == _rows(manifest) * 2


def test_daily_export_replaces_its_day_only(spark, tmp_path):
    out = str(tmp_path / "export")
    one = spark.createDataFrame([(1, 'say "hi", all')], "n int, t string")
    files.export_daily(one, out, dt.date(2024, 1, 1))
    files.export_daily(one, out, dt.date(2024, 1, 2))
    files.export_daily(one.withColumn("n", F.lit(2)), out, dt.date(2024, 1, 2))
    back = files.read_csv(spark, f"{out}/ds=20240102", "n INT, t STRING")
    assert _rows(back) == [(2, 'say "hi", all')]
    assert _rows(files.read_csv(spark, f"{out}/ds=20240101", "n INT, t STRING")) == [(1, 'say "hi", all')]
    assert all(f.endswith((".csv.gz", ".crc")) for f in os.listdir(f"{out}/ds=20240102"))


def test_materialize_and_publish(spark):
    tables = Tables(spark)
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("k"))
    stored = tables.materialize(df, "t_plain", dist="k", sort=["k", "id"])
    assert _rows(stored) == _rows(df)
    left = tables.materialize(df, "t_left", dist="k", sort=["k"], buckets=4)
    right = tables.materialize(df.groupBy("k").count(), "t_right", dist="k", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = left.join(right, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    tables.publish(df, "t_out")
    assert _rows(tables.publish(df.where("id < 3"), "t_out")) == [(0, 0), (1, 1), (2, 2)]
    tables.clone_schema("t_out", "t_empty")
    assert spark.table("t_empty").columns == ["id", "k"] and spark.table("t_empty").count() == 0
    tables.drop("t_plain", "t_left", "t_right", "t_out", "t_empty")


def test_folder_tables(spark, folder):
    part = Tables(spark, folder=folder).read("part", ["p_partkey"])
    assert part.columns == ["p_partkey"]


def test_scan_filter_reaches_the_scan(spark, folder):
    plan = QUERIES["scan_filter"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_brand,Brand#7)" in plan and "p_retailprice" not in plan


def _feed_schema():
    return "seq BIGINT, msgid STRING, message STRING"


def test_stream_equals_batch_and_resumes(spark, folder, tmp_path):
    raw = Domain(spark, folder)["raw_message"]
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    raw.where("seq % 2 = 0").repartition(3).write.parquet(source)
    stream = chat_stream.stream_normalize(chat_stream.read_feed(spark, source, _feed_schema(), max_files=1))
    chat_stream.run_available(stream, chat_stream.batch_sink(out), mark)
    raw.where("seq % 2 = 1").write.mode("append").parquet(source)
    chat_stream.run_available(stream, chat_stream.batch_sink(out), mark)  # only the new file
    chat_stream.run_available(stream, chat_stream.batch_sink(out), mark)  # nothing left
    got = spark.read.parquet(out).select(*stream.columns)
    assert _rows(got) == _rows(chat.normalize(raw))
    assert len([d for d in os.listdir(out) if d.startswith("batch=")]) > 2


def test_replayed_batch_leaves_the_same_rows(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "seq int, receiver string")
    sink = chat_stream.batch_sink(str(tmp_path / "sink"))
    sink(batch, 0)
    sink(batch, 0)
    assert _rows(spark.read.parquet(str(tmp_path / "sink")).select("seq", "receiver")) == [(1, "a"), (1, "a"), (2, "b")]


def _files_in_order(spark, folder, schema, batches):
    """One file a batch, read one a micro-batch in the order written."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return chat_stream.read_feed(spark, folder, schema, max_files=1)


def test_dedup_stream_keeps_one_of_each_key_over_batches(spark, tmp_path):
    schema, out, mark = "seq int, _position int, receiver string", str(tmp_path / "rows"), str(tmp_path / "mark")
    batches = [[(1, 0, "a"), (1, 1, "a")], [(1, 0, "a"), (2, 0, "b"), (None, 0, "c")], [(None, 0, "c"), (1, 1, "a"), (3, 0, "d")]]
    once = chat_stream.dedup_stream(_files_in_order(spark, str(tmp_path / "in"), schema, batches))
    write = chat_stream.batch_sink(out)

    def failing(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        chat_stream.run_available(once, failing, mark, keyed_state=True)
    chat_stream.run_available(once, write, mark, keyed_state=True)  # replays the second batch from the state before it
    got = spark.read.parquet(out).select("seq", "_position", "receiver").collect()
    assert sorted((r[0] or 0, r[1], r[2]) for r in got) == [(0, 0, "c"), (1, 0, "a"), (1, 1, "a"), (2, 0, "b"), (3, 0, "d")]


def test_dedup_stream_looks_up_its_own_keys_only(spark, tmp_path):
    """Twenty batches of ten new keys and ten old ones: what a batch touches does not grow with the history."""
    batches = [[(n * 10 + k, 0) for k in range(10)] + [(max(0, n - 1) * 10 + k, 0) for k in range(10)] for n in range(20)]
    feed = _files_in_order(spark, str(tmp_path / "in"), "seq int, _position int", batches)
    query = chat_stream.run_available(
        chat_stream.dedup_stream(feed), chat_stream.batch_sink(str(tmp_path / "rows")), str(tmp_path / "mark"), keyed_state=True
    )
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [20] * 20
    state = [p["stateOperators"][0] for p in progress]
    assert [s["numRowsTotal"] for s in state][-1] == 200 and all(s["numRowsUpdated"] == 10 for s in state)
    looked_up = [s["customMetrics"]["rocksdbGetCount"] for s in state]
    assert max(looked_up) <= 40 and looked_up[-1] <= looked_up[1]
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 200


def test_session_sink_reads_touched_days_only(spark, tmp_path):
    """Files of other days may even be unreadable."""
    out, schema = str(tmp_path / "sessions"), "sender STRING, receiver STRING, msgtime TIMESTAMP_NTZ, msg_date DATE"
    sink = chat_stream.session_sink(out)
    message = lambda day, minute: ("s", "r", dt.datetime(2024, 1, day, 10) + dt.timedelta(minutes=minute), dt.date(2024, 1, day))
    for n, day in enumerate((1, 2, 3)):
        sink(spark.createDataFrame([message(day, 0)], schema), n)
    for day in (1, 3):
        for folder, _, names in os.walk(f"{out}/minutes/msg_date=2024-01-0{day}"):
            for name in names:
                with open(os.path.join(folder, name), "wb") as broken:
                    broken.write(b"not parquet")
    sink(spark.createDataFrame([message(2, 200), message(4, 0)], schema), 3)
    sink(spark.createDataFrame([], schema), 4)
    got = {str(r["msg_date"]): r["sessions"] for r in chat_stream.latest_sessions(spark, out).collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 1, "2024-01-04": 1}


def test_session_sink_equals_the_batch_rule(spark, tmp_path):
    from shopfloor.operators.sessions import daily_sessions

    base = dt.datetime(2024, 1, 1, 10)
    minutes = {"c1": [0, 59, 119, 200, 200, 900], "c2": [30, 1000], "z": [5000], "late": [10, 71, 131]}
    data = [("s", r, base + dt.timedelta(minutes=m)) for r, ms in minutes.items() for m in ms] + [("s", "untimed", None)]
    data = [(s, r, t, t and t.date()) for s, r, t in data]
    schema = "sender STRING, receiver STRING, msgtime TIMESTAMP_NTZ, msg_date DATE"
    sink = chat_stream.session_sink(str(tmp_path / "sessions"))
    for n in range(3):  # every third message a batch: sessions open and close over batches, and come late
        sink(spark.createDataFrame(data[n::3], schema), n)
    sink(spark.createDataFrame(data[2::3], schema), 2)  # replayed after a failure
    got = chat_stream.latest_sessions(spark, str(tmp_path / "sessions"))
    key = lambda r: (r["receiver"], str(r["msg_date"]), r["sessions"])
    want = daily_sessions(spark.createDataFrame(data, schema))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_failed_publish_leaves_the_old_rows(spark):
    tables, name = Tables(spark), "t_live"
    tables.publish(spark.range(5), name)
    reader = spark.table(name)
    late = spark.range(1000).select(F.when(F.col("id") < 999, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.publish(late, name)
    with pytest.raises(ValueError, match="fail the check"):
        tables.publish(spark.range(0), name, check=lambda stored: not stored.isEmpty())
    assert spark.table(name).count() == 5
    for n in (7, 8):
        assert tables.publish(spark.range(n).select("id", F.lit("x").alias("more")), name).count() == n
        assert n == 8 or reader.count() == 5  # a reader that began before the switch
    stored = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")]
    assert len(stored) == 2 and spark.table(name).columns == ["id", "more"]
    tables.drop(name)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name)]


def test_bucketed_lines_and_order_numbers_join_in_place(spark, folder):
    joined = QUERIES["bucketed_orders"](spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_manifest_array_is_read_by_several_tasks(spark, tmp_path):
    entries = [{"msgtype": "image", "sdkfileid": f"{n:032d}", "md5sum": f"m{n}", "fileext": "jpg"} for n in range(3000)]
    for name, text in (("a", json.dumps(entries, indent=2)), ("b", json.dumps(entries)), ("c", "[]"), ("d", "\n[ ]\n")):
        path = _write(tmp_path / f"{name}.json", text)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        try:
            got = files.read_manifest(spark, path)
            assert name in "cd" or got.rdd.getNumPartitions() > 3
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert _rows(got) == (sorted(tuple(e.values()) for e in entries) if name in "ab" else [])
    for broken in ('[{"msgtype": "a}b"}]', '{"list": [{"msgtype": "image"}, 7 ]}', '[{"msgtype": "image"} nonsense]'):
        with pytest.raises(Exception, match="(?i)manifest entries|malformed|parse"):
            files.read_manifest(spark, _write(tmp_path / "broken.json", broken)).collect()


def test_stream_progress_counts_messages(spark, folder, tmp_path):
    raw = Domain(spark, folder)["raw_message"]
    raw.unionByName(raw.limit(9).withColumn("message", F.lit("{broken"))).repartition(2).write.parquet(str(tmp_path / "in"))
    feed = chat_stream.read_feed(spark, str(tmp_path / "in"), _feed_schema(), max_files=1)
    stream = chat_stream.stream_normalize(feed, counts="messages")
    query = chat_stream.run_available(stream, chat_stream.batch_sink(str(tmp_path / "out")), str(tmp_path / "mark"))
    seen = [p["observedMetrics"]["messages"] for p in query.recentProgress if p["numInputRows"]]
    total = raw.count()
    assert [sum(m[i] for m in seen) for i in range(3)] == [total + 9, total, 9]

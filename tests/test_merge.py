"""Merges, partitioned tables and streaming ingest."""

from __future__ import annotations

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline import runtime, schemas
from fathomline.operators import merge
from fathomline.operators.dates import zoned
from fathomline.plans import catalog
from fathomline.sources import payloads, tables
from fathomline.streaming import incremental

KEYS = ["symbol", "date"]
TABLE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("ingested_at", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
    ]
)


def rows(spark, data):
    return spark.createDataFrame([(s, dt.date.fromisoformat(d), c, at, int(d[:4])) for s, d, c, at in data], TABLE)


def content(df):
    return sorted((r.symbol, str(r.date), r.close) for r in df.collect())


def test_upsert_updates_inserts_and_repeats(spark):
    target = rows(spark, [("A", "2026-01-01", 1.0, 0), ("A", "2026-01-02", 2.0, 0)])
    batch = rows(spark, [("A", "2026-01-02", 9.0, 1), ("A", "2026-01-02", 8.0, 2), ("B", "2026-01-01", 5.0, 1)])
    once = merge.merge_upsert(target, batch, KEYS, "ingested_at")
    want = [("A", "2026-01-01", 1.0), ("A", "2026-01-02", 8.0), ("B", "2026-01-01", 5.0)]
    assert content(once) == want
    assert content(merge.merge_upsert(once, batch, KEYS, "ingested_at")) == want
    assert tuple(merge.merge_counts(target, batch, KEYS).first()) == (1, 1)


def test_insert_keeps_existing_and_first_of_batch(spark):
    target = rows(spark, [("A", "2026-01-01", 1.0, 0)])
    batch = rows(spark, [("A", "2026-01-01", 7.0, 1), ("B", "2026-01-01", 6.0, 2), ("B", "2026-01-01", 5.0, 1)])
    assert content(merge.merge_insert(target, batch, KEYS, "ingested_at")) == [
        ("A", "2026-01-01", 1.0),
        ("B", "2026-01-01", 5.0),
    ]


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    rows(spark, [("A", "2026-01-01", 1.0, 0)]).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = rows(spark, [("A", "2026-01-01", 2.0, 1)]).groupBy(*TABLE.fieldNames()).count().drop("count")
    out = merge.merge_upsert(target, batch, KEYS, "ingested_at")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_merge_into_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "prices")
    tables.merge_into(rows(spark, [("A", "2025-05-01", 1.0, 0), ("A", "2026-01-01", 1.0, 0)]), path, KEYS, "ingested_at", "year", TABLE)
    old = sorted(p.name for p in (tmp_path / "prices" / "year=2025").glob("*.parquet"))
    batch = rows(spark, [("A", "2026-01-01", 3.0, 1), ("B", "2026-02-01", 4.0, 1)])
    for _ in range(2):
        tables.merge_into(batch, path, KEYS, "ingested_at", "year", TABLE)
    assert content(spark.read.schema(TABLE).parquet(path)) == [
        ("A", "2025-05-01", 1.0),
        ("A", "2026-01-01", 3.0),
        ("B", "2026-02-01", 4.0),
    ]
    assert sorted(p.name for p in (tmp_path / "prices" / "year=2025").glob("*.parquet")) == old


def test_merge_into_keeps_rows_without_a_partition_value(spark, tmp_path):
    path = str(tmp_path / "prices")
    undated = spark.createDataFrame([("A", None, 1.0, 0, None)], TABLE)
    tables.merge_into(undated, path, KEYS, "ingested_at", "year", TABLE)
    tables.merge_into(undated.withColumn("symbol", F.lit("B")), path, KEYS, "ingested_at", "year", TABLE)
    tables.merge_into(undated.where("false"), path, KEYS, "ingested_at", "year", TABLE)
    assert content(spark.read.schema(TABLE).parquet(path)) == [("A", "None", 1.0), ("B", "None", 1.0)]


def test_merge_into_finishes_an_interrupted_swap(spark, tmp_path):
    """A run died after staging partition 2026 and half way through replacing it."""
    path = str(tmp_path / "prices")
    tables.merge_into(rows(spark, [("A", "2025-05-01", 1.0, 0)]), path, KEYS, "ingested_at", "year", TABLE)
    staged = str(tmp_path / "staged")
    tables.replace_table(rows(spark, [("A", "2026-01-01", 3.0, 1), ("C", "2026-01-02", 7.0, 0)]), staged, "year")
    spark.createDataFrame([(staged,)], "value string").write.text(path + "_pending")
    batch = rows(spark, [("A", "2026-01-01", 3.0, 1)])
    tables.merge_into(batch, path, KEYS, "ingested_at", "year", TABLE)
    assert content(spark.read.schema(TABLE).parquet(path)) == [
        ("A", "2025-05-01", 1.0),
        ("A", "2026-01-01", 3.0),
        ("C", "2026-01-02", 7.0),
    ]
    assert not tables.exists(spark, path + "_pending")


def test_aligned_write(spark, tmp_path):
    path = str(tmp_path / "aligned")
    made = spark.createDataFrame([("v1", 1, "A")], "model_version string, predicted_close int, symbol string")
    like = T.StructType([schemas.PREDICTIONS[n] for n in ("symbol", "predicted_close", "model_version")])
    tables.write_aligned(made, path, like)
    tables.write_aligned(made, path, like, mode="append")
    stored = spark.read.parquet(path)
    assert stored.columns == like.fieldNames() and stored.count() == 2
    tables.write_aligned(made, path, like)
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        tables.write_aligned(made, path, like, mode="ignore")


def test_reset_keeps_schema(spark, tmp_path):
    tables.create_table(spark, "raw_prices", schemas.PRICES, str(tmp_path / "raw"))
    tables.create_table(spark, "made_prices", schemas.PRICES, str(tmp_path / "made"))
    spark.createDataFrame([("A", dt.date(2026, 1, 1), 1.0, 1.0, 1.0, 1.0, 1, None)], schemas.PRICES).write.insertInto("raw_prices")
    tables.create_views({"latest_view": spark.table("raw_prices")})
    spark.table("raw_prices").write.insertInto("made_prices")
    tables.reset_outputs(spark, ["latest_view"], ["made_prices"], ["raw_prices"])
    assert spark.table("raw_prices").count() == 0
    assert spark.table("raw_prices").columns == schemas.PRICES.fieldNames()
    assert not spark.catalog.tableExists("made_prices")
    tables.create_table(spark, "made_prices", schemas.PRICES, str(tmp_path / "made"))
    assert spark.table("made_prices").count() == 0
    spark.sql("DROP TABLE made_prices")
    spark.sql("DROP TABLE raw_prices")


def test_base_tables(spark, tmp_path):
    tables.create_base_tables(spark, str(tmp_path))
    assert spark.table("raw_data.sec_filings").columns == schemas.FILINGS.fieldNames()
    for database in ("raw_data", "ml_models", "text_ai"):
        spark.sql(f"DROP DATABASE {database} CASCADE")


def payload(day, close):
    series = f'{{"{day}": {{"1. open": "1", "2. high": "2", "3. low": "1", "4. close": "{close}", "5. volume": "10"}}}}'
    return f'{{"Meta Data": {{"2. Symbol": "A"}}, "Time Series (Daily)": {series}}}'


def test_stream_upsert_over_runs(spark, tmp_path):
    inbox, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    table = T.StructType([*schemas.PRICES.fields, T.StructField("year", T.IntegerType())])

    def prepare(batch):
        parsed, _ = payloads.parse_daily_series(batch, "value")
        return parsed.withColumn("year", F.year("date"))

    def run():
        stream = spark.readStream.schema("value string").text(inbox)
        incremental.stream_upsert(stream, path, KEYS, "ingested_at", "year", table, state, prepare)
        return {str(r.date): r.close for r in spark.read.schema(table).parquet(path).collect()}

    spark.createDataFrame([(payload("2026-01-01", 1),), (payload("2026-01-02", 2),)], "value string").write.text(inbox)
    assert run() == {"2026-01-01": 1.0, "2026-01-02": 2.0}
    assert run() == {"2026-01-01": 1.0, "2026-01-02": 2.0}
    spark.createDataFrame([(payload("2026-01-02", 5),)], "value string").write.mode("append").text(inbox)
    assert run() == {"2026-01-01": 1.0, "2026-01-02": 5.0}


def test_stream_new_filings_once_whatever_their_age(spark, tmp_path):
    inbox, path = (str(tmp_path / n) for n in ("in", "out"))
    kind = "k string, at timestamp"

    def add(day, *keys):
        stamped = spark.createDataFrame([(k,) for k in keys], "k string").withColumn("at", F.lit(day).cast("timestamp"))
        stamped.write.mode("append").parquet(inbox)

    def run(state):
        stream = spark.readStream.schema(kind).parquet(inbox)
        made = lambda b: b.select("k", F.date_format("at", "yyyy-MM-dd").alias("day"), F.ascii("k").alias("part"))
        incremental.stream_new_filings(stream, ["k"], "at", "part", path, str(tmp_path / state), made)
        return sorted((r.k, r.day) for r in spark.read.parquet(path).collect())

    add("2026-01-01", "a", "b", "a")
    assert run("state") == [("a", "2026-01-01"), ("b", "2026-01-01")]
    add("2020-01-01", "a", "c")
    everything = [("a", "2026-01-01"), ("b", "2026-01-01"), ("c", "2020-01-01")]
    assert run("state") == everything
    assert run("another_state") == everything


def test_a_delivery_of_filings_is_written_by_many_tasks(spark, sf, tmp_path, monkeypatch):
    spark.read.parquet(f"{sf}/documents.parquet").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: str(tmp_path / name))
    got = catalog.QUERIES["stream_new_filings"](spark, str(tmp_path))
    enriched = catalog.rounded(catalog._enriched(spark, sf)).select(got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, enriched.collect()))
    assert len(list((tmp_path / "inbox").glob("*.parquet"))) == 12
    assert len(list((tmp_path / "state" / "commits").glob("[0-9]*"))) == 3


def test_stream_keeps_rejects_and_no_staged_copies(spark, tmp_path):
    inbox, path, bad, state = (str(tmp_path / n) for n in ("in", "out", "bad", "state"))
    table = T.StructType([*schemas.PRICES.fields, T.StructField("year", T.IntegerType())])

    def prepare(batch):
        parsed, rejects = payloads.parse_daily_series(batch, "value")
        return parsed.withColumn("year", F.year("date")), rejects

    root = pathlib.Path(runtime.shared_root(spark).removeprefix("file:"))
    before = {p.name for p in root.glob("merge-*")}
    for lines in ([payload("2026-01-01", 1), "no json"], [payload("2026-01-02", 2), "also not"]):
        spark.createDataFrame([(x,) for x in lines], "value string").write.mode("append").text(inbox)
        stream = spark.readStream.schema("value string").text(inbox)
        incremental.stream_upsert(stream, path, KEYS, "ingested_at", "year", table, state, prepare, bad)
    assert spark.read.schema(table).parquet(path).count() == 2
    assert [r.reason for r in spark.read.parquet(bad).collect()] == ["unexpected"] * 2
    assert {p.name for p in root.glob("merge-*")} == before


def test_stream_counts_equal_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("ts", "event_type", "value")
    events.write.parquet(str(tmp_path / "in"))
    for every in ("day", "week"):
        path = str(tmp_path / every)
        incremental.stream_counts(
            spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")),
            "ts", "event_type", every, dt.timedelta(days=1), path, str(tmp_path / f"state_{every}"),
        )
        stored = spark.read.parquet(path).select(every, "event_type", "n")
        batch = incremental.bucket_counts(events, "ts", "event_type", every).select(every, "event_type", "n")
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, batch.collect()))
        if every == "week":
            assert {r.week.weekday() for r in stored.collect()} == {0}


def test_stream_counts_keep_late_events_and_survive_a_replay(spark, tmp_path):
    inbox, path, state = (str(tmp_path / name) for name in ("in", "table", "state"))

    def deliver(*rows):
        frame = spark.createDataFrame(rows, "ts timestamp_ntz, k string, v long")
        frame.coalesce(1).write.mode("append").parquet(inbox)

    def run():
        stream = spark.readStream.schema("ts timestamp_ntz, k string, v long").parquet(inbox)
        incremental.stream_counts(stream, "ts", "k", "day", dt.timedelta(days=1), path, state, value="v")
        return sorted(map(tuple, spark.read.parquet(path).select("day", "k", "n", "total").collect()), key=str)

    old, new = dt.datetime(2024, 1, 5, 7), dt.datetime(2024, 3, 1, 9)
    deliver((old, "a", 1), (new, "a", 2), (new, None, 3))
    run()
    deliver((old, "a", 10), (old, "b", 20), (new, None, 30))
    expected = [
        (old.date(), "a", 2, 11),
        (old.date(), "b", 1, 20),
        (new.date(), "a", 1, 2),
        (new.date(), None, 2, 33),
    ]
    assert run() == expected
    # Without its commit the last batch is given again.
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / name).unlink()
    assert run() == expected


def test_stream_counts_of_any_checkpoint_add_up(spark, tmp_path):
    """A second checkpoint, and one made anew, lose nothing; late rows are kept as corrections."""
    path, lateness = str(tmp_path / "table"), dt.timedelta(days=2)
    days = [dt.datetime(2024, 5, d, 12) for d in (1, 3, 4, 9)]

    def run(name, state, *rows):
        inbox = str(tmp_path / name)
        spark.createDataFrame(rows, "ts timestamp_ntz, k string, v long").coalesce(1).write.parquet(inbox)
        stream = spark.readStream.schema("ts timestamp_ntz, k string, v long").parquet(inbox)
        incremental.stream_counts(stream, "ts", "k", "day", lateness, path, str(tmp_path / state), value="v")

    def found():
        return {r["day"].day: (r["n"], r["total"]) for r in spark.read.parquet(path).collect()}

    def corrections():
        rows = spark.read.parquet(f"{path}_corrections").collect()
        return sorted((r["day"].day, r["n"], r["total"]) for r in rows)

    run("one", "first", *[(days[0], "a", 1)] * 3)
    run("two", "second", *[(days[0], "a", 1)] * 5, (days[1], "a", None))
    assert found() == {1: (8, 8), 3: (1, None)} and corrections() == []
    # An event at the very bound closes the first day for the batches after it.
    run("three", "third", (dt.datetime(2024, 5, 4), "a", 2))
    assert [(r["day"].day, r["final"]) for r in incremental.bucket_status(spark, path, "day", lateness).orderBy("day").collect()] == [
        (1, True), (3, False), (4, False)]
    run("four", "fourth", (days[0], "a", 10), (days[1], "a", 4), (days[3], "a", 1))
    assert found() == {1: (9, 18), 3: (2, 4), 4: (1, 2), 9: (1, 1)} and corrections() == [(1, 1, 10)]
    for name in ("0", ".0.crc"):
        (tmp_path / "fourth" / "commits" / name).unlink()
    stream = spark.readStream.schema("ts timestamp_ntz, k string, v long").parquet(str(tmp_path / "four"))
    incremental.stream_counts(stream, "ts", "k", "day", lateness, path, str(tmp_path / "fourth"), value="v")
    assert found() == {1: (9, 18), 3: (2, 4), 4: (1, 2), 9: (1, 1)} and corrections() == [(1, 1, 10)]


def test_rejects_of_a_checkpoint_made_anew_are_kept(spark, tmp_path):
    import shutil

    path, bad, state = (str(tmp_path / n) for n in ("table", "bad", "state"))

    def prepare(batch):
        rows = batch.select("id", F.lit("x").alias("v"), F.lit(1).alias("at"), F.lit(1).alias("part"))
        return rows.where("id < 0"), batch.select(F.col("id").alias("rejected"))

    schema = T.StructType().add("id", "long").add("v", "string").add("at", "integer").add("part", "integer")
    for number in (1, 2):
        inbox = str(tmp_path / f"in{number}")
        spark.range(number, number + 1).write.parquet(inbox)
        stream = spark.readStream.schema("id long").parquet(inbox)
        incremental.stream_upsert(stream, path, ["id"], "at", "part", schema, state, prepare, bad)
        shutil.rmtree(state)
    assert sorted(r["rejected"] for r in spark.read.parquet(bad).collect()) == [1, 2]


def test_buckets_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 29, 2, 30), "a"), (dt.datetime(2026, 3, 29, 0, 0), "a")], "ts timestamp_ntz, k string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", other)
            for frame in (df, zoned(df, "ts", "ts")):
                rows = incremental.bucket_counts(frame, "ts", "k", "day").collect()
                assert [tuple(r) for r in rows] == [(dt.date(2026, 3, 29), "a", 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    incremental.log_run(spark, path, "good", lambda: None)
    with pytest.raises(ZeroDivisionError):
        incremental.log_run(spark, path, "bad", lambda: 1 / 0)
    for _ in range(2):
        incremental.log_run(spark, path, "other", lambda: None)
    log = spark.read.parquet(path)
    recent = incremental.run_log_recent(log, ["good", "bad"], k=10).collect()
    assert [(r.name, r.state, r.error_code) for r in recent] == [
        ("bad", "FAILED", "ZeroDivisionError"),
        ("good", "SUCCEEDED", None),
    ]

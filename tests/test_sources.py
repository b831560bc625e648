"""Readers, payloads and feeds."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline import runtime, schemas
from fathomline.sources import feeds, files, given, payloads

GOOD = """{"Meta Data": {"2. Symbol": "AAA"}, "Time Series (Daily)": {
  "2026-01-02": {"1. open": "10.0", "2. high": "11.0", "3. low": "9.5", "4. close": "10.5", "5. volume": "1000"},
  "2026-01-05": {"1. open": "10.5", "2. high": "12.0", "3. low": "10.0", "4. close": "11.55", "5. volume": "1500"}}}"""
FEED = """<feed><entry><title>Acme Corp</title><filing-href>https://h/Archives/edgar/data/320193/0001-index.htm</filing-href>
<filing-date>2026-01-02</filing-date><summary>Acme announces a merger with Beta.</summary></entry>
<entry><title>NoLink Inc</title><filing-date>2026-01-02</filing-date><summary>s</summary></entry>
<entry><title>NoText LLC</title><filing-href>https://h/data/99/x.htm</filing-href><filing-date>2026-01-03</filing-date></entry>
<entry><title>Long</title><filing-href>https://h/data/7/x.htm</filing-href><summary>LONGTEXT</summary></entry>
<entry><title>Bad day</title><filing-href>https://h/data/8/x.htm</filing-href><filing-date>soon</filing-date></entry></feed>"""


def test_csv_nulls(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('region_name,date,zhvi,median_sale_price,inventory_count,ingested_at\n"A, B",2026-01-01,1.5,NULL,3,\n"",2026-01-02,,"NULL","",\n')
    rows = files.read_csv(spark, str(path), schemas.REAL_ESTATE).collect()
    assert tuple(rows[0]) == ("A, B", dt.date(2026, 1, 1), 1.5, None, 3, None)
    assert tuple(rows[1]) == (None, dt.date(2026, 1, 2), None, None, None, None)


def test_csv_multiline(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('a,b\n"x\ny",1\n')
    kinds = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    assert [tuple(r) for r in files.read_csv_multiline(spark, str(path), kinds).collect()] == [("x\ny", 1)]


def test_payload_rows_and_rejects(spark, tmp_path):
    for name, body in {"good": GOOD, "error": '{"Error Message": "bad"}', "note": '{"Note": "slow"}', "odd": '{"x": 1}'}.items():
        (tmp_path / f"{name}.json").write_text(body)
    texts = spark.read.text(str(tmp_path), wholetext=True)
    rows, rejects = payloads.parse_daily_series(texts, "value")
    got = sorted((r.symbol, str(r.date), r.close, r.volume) for r in rows.collect())
    assert got == [("AAA", "2026-01-02", 10.5, 1000), ("AAA", "2026-01-05", 11.55, 1500)]
    assert rows.columns == schemas.PRICES.fieldNames()
    assert sorted((r.reason, r.message[:4]) for r in rejects.collect()) == [("error", "bad"), ("rate_limit", "slow"), ("unexpected", '{"x"')]
    named = texts.withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    rows, _ = payloads.parse_daily_series(named, "value", symbol=F.regexp_replace("file", ".json$", ""))
    assert {r.symbol for r in rows.collect()} == {"good"}


def test_broken_payload_is_rejected(spark):
    df = spark.createDataFrame([("not json",), (None,)], "value string")
    rows, rejects = payloads.parse_daily_series(df, "value")
    assert rows.count() == 0 and {r.reason for r in rejects.collect()} == {"unexpected"}


def test_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(FEED.replace("LONGTEXT", "x" * 12_000))
    day = F.lit(dt.date(2026, 2, 1))
    rows = {r.company_name: r for r in feeds.parse_filing_feed(spark, str(tmp_path), "8-K", as_of=day).collect()}
    assert {n: r.cik for n, r in rows.items()} == {"Acme Corp": "320193", "NoLink Inc": "UNKNOWN", "NoText LLC": "99", "Long": "7"}
    assert rows["NoText LLC"].filing_text == "" and len(rows["Long"].filing_text) == 12_000
    assert rows["Long"].filing_date == dt.date(2026, 2, 1) and rows["NoLink Inc"].url == ""
    newest = feeds.parse_filing_feed(spark, str(tmp_path), "8-K", count=2, cap=9_000, as_of=day).collect()
    assert [(r.company_name, len(r.filing_text)) for r in newest] == [("Long", 9_000), ("NoText LLC", 0)]


def test_staged_formats(spark, tmp_path):
    kinds = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    df = spark.createDataFrame([("x", 1)], kinds)
    df.write.parquet(str(tmp_path / "p"))
    df.write.json(str(tmp_path / "j"))
    df.write.csv(str(tmp_path / "c"), header=True)
    df.write.option("rowTag", "entry").xml(str(tmp_path / "x"))
    for name, fmt in {"p": "parquet", "j": "json", "c": "csv", "x": "xml"}.items():
        assert [tuple(r) for r in files.staged_load(spark, str(tmp_path), name, fmt, kinds).collect()] == [("x", 1)]
    with pytest.raises(ValueError):
        files.staged_load(spark, str(tmp_path), "p", "orc")


def test_shared_folder_follows_the_session(spark):
    root = runtime.shared_root(spark)
    assert runtime.shared_root(spark) == root
    assert runtime.scratch_path(spark, "x") != runtime.scratch_path(spark, "x")


def test_large_unit_prices(spark, tmp_path):
    day = dt.datetime(2024, 5, 1)
    sold = [(9 * 10**14, 1, 1, 2.0, 4_000_000.0, day), (9 * 10**14, 2, 1, 1.0, 3e11, day), (2, 1, 1, 1.0, 5.0, day)]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp"
    spark.createDataFrame(sold, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, "B")], "p_partkey long, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    bar = given.prices(spark, str(tmp_path)).first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (5.0, 3e11, 5.0, 3e11, 4)

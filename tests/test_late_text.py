"""Texts stay at their rows until they are asked for."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from fathomline.functions import providers
from fathomline.operators import enrich
from fathomline.plans import catalog
from fathomline.sources import files, given


def shuffled_columns(df) -> set[str]:
    """Names of all columns in exchanges of the plan of ``df``."""
    found, todo = set(), [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.initialPlan()
        if "Exchange" in node.nodeName():
            found |= {node.output().apply(i).name() for i in range(node.output().size())}
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.fixture
def plans(spark, monkeypatch):
    """Columns in the exchanges of everything that is checkpointed or written meanwhile; nothing is broadcast."""
    seen = set()
    checkpoint, write = DataFrame.checkpoint, DataFrame.write.fget

    def noted(df, *a, **k):
        seen.update(shuffled_columns(df))
        return checkpoint(df, *a, **k)

    def writing(df):
        seen.update(shuffled_columns(df))
        return write(df)

    monkeypatch.setattr(DataFrame, "checkpoint", noted)
    monkeypatch.setattr(DataFrame, "write", property(writing))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield seen
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["enriched_filings", "filing_dashboard", "deal_activity_ci", "bounded_docs"])
def test_no_text_in_an_exchange(spark, sf, plans, name):
    df = catalog.QUERIES[name](spark, sf)
    plans |= shuffled_columns(df)
    assert "filing_date" in plans and not plans & {"text", "filing_text", "original_text"}


@pytest.mark.parametrize("name", ["cached_enrichment", "external_calls"])
def test_only_texts_without_a_result_are_shuffled(spark, sf, monkeypatch, name):
    """They are picked on the scan, which reads texts three times, and dealt to a number of tasks of their own."""
    moved, reads, write = [], [], DataFrame.write.fget

    def noted(df):
        todo = [df._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            if node.nodeName() == "AdaptiveSparkPlan":
                node = node.initialPlan()
            names = {node.output().apply(i).name() for i in range(node.output().size())}
            if "Exchange" in node.nodeName() and names & {"text", "filing_text"}:
                moved.append(node.shuffleOrigin().toString())
            if node.nodeName().startswith("Scan") and "text" in names:
                reads.append(node.nodeName())
            todo += [node.children().apply(i) for i in range(node.children().size())]

    def writing(df):
        noted(df)
        return write(df)

    monkeypatch.setattr(DataFrame, "write", property(writing))
    noted(catalog.QUERIES[name](spark, sf))
    assert moved == ["REPARTITION_BY_NUM"] * 2 and len(reads) == 3


def test_results_by_keys_are_those_of_the_rows(spark, tmp_path):
    """Copies, copies of a row, rows without a text or an id, and a cache that holds some of the texts."""
    texts = [None, "", "a text. of two.", *[f"text {i % 150} with profit and loss" for i in range(400)]]
    rows = [(None if i % 40 == 7 else str(i), i, t) for i, t in enumerate(texts)]
    rows += rows[:100]
    made = spark.createDataFrame(rows, "cik string, n int, body string").repartition(3, "n")
    made.write.option("parquet.block.size", 4096).option("parquet.page.size", 1024).parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumnRenamed("body", "filing_text")
    keys, steps = enrich.text_keys(df), enrich.TextProviders()
    assert "filing_text" not in keys.columns

    def filled(path, **given):
        early = {"keys": given["keys"].where("n < 90")} if given else {}
        enrich.new_results(df if given else df.where("n < 90"), None, steps, **early).write.parquet(path)
        old = spark.read.parquet(path)
        rest = enrich.new_results(df, old, steps, **given)
        out = enrich.attach_results(given.get("keys", df), old.unionByName(rest))
        shown = out.select("cik", "n", "text_hash", *enrich.RESULTS)
        return [sorted(map(str, d.collect())) for d in (old, rest, shown)]

    by_keys = filled(str(tmp_path / "keys"), keys=keys)
    assert by_keys == filled(str(tmp_path / "rows")) and all(by_keys)


def test_text_steps_have_tasks_by_the_size_of_the_texts(spark):
    most = enrich.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    sizes = [0, 3 << 20, 1 << 30, 1 << 40]
    assert [enrich._tasks_for(spark, s) for s in sizes] == [1, 3, max(most, 64), 1 << 16]


def test_the_join_it_replaces_moves_text(spark, sf, plans):
    plans |= shuffled_columns(enrich.enrich_filings(given.filings(spark, sf)))
    assert "filing_text" in plans or "text" in plans


def test_fetched_values_are_those_of_their_rows(spark, tmp_path):
    rows = [(i, f"text {i} " + "x" * (i % 50) if i % 7 else None) for i in range(5000)]
    made = spark.createDataFrame(rows, "id long, body string").repartition(3)
    made.write.option("parquet.block.size", 4096).option("parquet.page.size", 1024).parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    short = files.with_address(table.select("id").where("id % 3 = 0")).repartition(4)
    got = files.fetch_by_address(short, "body", "found").collect()
    assert {r["id"]: r["found"] for r in got} == {i: t for i, t in rows if i % 3 == 0}
    assert files.fetch_by_address(short.where("id < 0"), "body", "found").collect() == []


@pytest.mark.parametrize("limit", [None, 4])
def test_same_rows_with_and_without_addresses(spark, tmp_path, limit):
    first = dt.date(2026, 1, 1)
    rows = [(str(i % 20), "co", "f", first + dt.timedelta(days=i % 5), f"{i % 20} " + "growth and merger " * 9, "u") for i in range(40)]
    schema = "cik string, company_name string, form_type string, filing_date date, body string, url string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumnRenamed("body", "filing_text")
    stamp = F.lit("2026-01-01 00:00:00")
    late = enrich.enrich_filings(df, limit=limit, run_ts=stamp, stored_text="body").orderBy("filing_id").collect()
    assert [r["filing_id"] for r in late] == list(range(1, (limit or 40) + 1))
    if limit:
        assert late == enrich.enrich_filings(df, limit=limit, run_ts=stamp).orderBy("filing_id").collect()
    else:
        early = enrich.enrich_filings(df, ids=False, run_ts=stamp)
        assert sorted(map(str, [r[1:] for r in late])) == sorted(str(tuple(r)) for r in early.collect())


def test_text_steps_run_once_per_text(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def client():
        def summarise(batch):
            calls.add(len(batch))
            return list(batch)

        return summarise

    rows = [(str(i), "co", "f", dt.date(2026, 1, 1), f"{i} " + "growth and merger " * 9, "u") for i in range(30)]
    schema = "cik string, company_name string, form_type string, filing_date date, body string, url string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumnRenamed("body", "filing_text")
    steps = enrich.TextProviders(summary=providers.external_text(client))
    done = enrich.enrich_filings(df, steps, stored_text="body")
    assert done.count() == 30 and calls.value == 30

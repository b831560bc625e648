"""Text providers, labels, enrichment and filing reports."""

from __future__ import annotations

import collections
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from fathomline.functions import arrays, labels, providers
from fathomline.operators import enrich, gazetteer, reports
from fathomline.plans import runs

DAY = dt.date(2026, 3, 15)
DONE = (
    "filing_id long, company_name string, form_type string, filing_date date, ai_summary string, "
    "sentiment string, sentiment_score double, classification string, processed_at timestamp_ntz"
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def filings(spark, texts, day=DAY):
    data = [(str(i), f"c{i % 2}", "8-K", day - dt.timedelta(days=i), t, f"u{i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(
        data, "cik string, company_name string, form_type string, filing_date date, filing_text string, url string"
    )


def done(spark, rows):
    """rows: (id, company, date, summary, sentiment, score, class)"""
    data = [(i, c, "8-K", d, s, m, x, k, None) for i, c, d, s, m, x, k in rows]
    return spark.createDataFrame(data, DONE)


def test_sentiment_labels(spark):
    scores = spark.createDataFrame([(0.2,), (-0.2,), (0.21,), (-0.21,), (None,)], "s double")
    got = [r[0] for r in scores.select(labels.sentiment_label(F.col("s"))).collect()]
    assert got == ["neutral", "neutral", "positive", "negative", "neutral"]


def test_icons(spark):
    cases = [("M&A", "positive"), ("IPO", "negative"), ("Restructuring", "neutral"), ("Other", "positive"), ("Other", "negative"), ("Other", "neutral")]
    df = spark.createDataFrame(cases, "c string, s string")
    got = [r[0] for r in df.select(labels.filing_icon(F.col("c"), F.col("s"))).collect()]
    assert got == ["🤝", "🚀", "🏗️", "📈", "📉", "📄"]


def test_prompt_and_null(spark):
    assert one(spark, labels.prompt("p: ", F.lit("abcdef"), 3)) == "p: abc"
    assert one(spark, labels.prompt("p: ", F.lit(None).cast("string"))) is None


def test_known_label(spark):
    replies = ["M&A", " ipo. ", "Executive Change", "no idea", None]
    df = spark.createDataFrame([(r,) for r in replies], "r string")
    got = [r[0] for r in df.select(labels.known_label(F.col("r"))).collect()]
    assert got == ["M&A", "IPO", "Executive_Change", "Other", "Other"]


def test_settings_tables(spark):
    rules = spark.createDataFrame([("b", 2, "x"), ("a", 1, "y")], "label string, priority int, regex string")
    assert providers.rules_from(rules) == [("a", "y"), ("b", "x")]
    lexicon = spark.createDataFrame([("good", 1.0)], "term string, weight double")
    assert providers.lexicon_from(lexicon) == {"good": 1.0}
    with pytest.raises(ValueError):
        labels.settings_rows(spark.range(5), 4)


def test_lexicon_score(spark):
    score = providers.lexicon_sentiment({"good": 1.0, "great": 2.0, "bad": -1.0})
    assert one(spark, score(F.lit("Good, GREAT; bad goodness"))) == pytest.approx(0.5)
    assert one(spark, score(F.lit("nothing here"))) == 0.0
    assert one(spark, score(F.lit("bad bad"))) == -1.0


def test_lexicon_join_equals_expression(spark, sf):
    words = {"with": 1.0, "this": 2.0, "that": -1.0, "the": -0.5}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    table = spark.createDataFrame(list(words.items()), "term string, weight double")
    joined = dict(map(tuple, enrich.sentiment_by_join(docs, "text", "doc_id", table).collect()))
    direct = dict(map(tuple, docs.select("doc_id", providers.lexicon_sentiment(words)(F.col("text"))).collect()))
    assert joined.keys() == direct.keys()
    assert all(joined[k] == pytest.approx(direct[k], abs=1e-12) for k in direct)


def test_default_rules(spark):
    classify = providers.rule_classifier()
    cases = {
        "Acme agreed to a MERGER with Beta": "M&A",
        "The chief executive resigned; a successor was named": "Executive_Change",
        "We will restate our results": "Financial_Restatement",
        "A quiet day": "Other",
    }
    assert {t: one(spark, classify(F.lit(t))) for t in cases} == cases


def test_run_lengths(spark):
    got = one(spark, arrays.run_lengths(F.array(*[F.lit(v) for v in (1, 1, 2, 5, 5, 5)])))
    assert [tuple(r) for r in got] == [(1, 2), (2, 1), (5, 3)]
    assert one(spark, arrays.run_lengths(F.array().cast("array<int>"))) == []


def summary_by_hand(text, count=3):
    marked = re.sub(r"[\r\n]+", "\x01", re.sub(r"([.!?])[ \t\n\r\f\v]+", "\\1\x01", text))
    parts = [p for p in (s.strip(" ") for s in marked.split("\x01")) if p]
    if len(parts) <= count:
        return " ".join(parts)
    terms = [{w for w in re.split(r"[^a-z]+", p.lower()) if len(w) >= 4} for p in parts]
    seen = collections.Counter(w for t in terms for w in t)
    points = [sum(seen[w] >= 2 for w in t) for t in terms]
    best = sorted(range(len(parts)), key=lambda i: (-points[i], i))[:count]
    return " ".join(parts[i] for i in sorted(best))


def test_summary_against_brute_force(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "tiny", "of", "12345", "omega"]
    texts = ["", "One. ", "No mark at all", "1 starts. 2 follows. 3 ends. 4 more."]
    texts += [
        "".join(" ".join(rng.choices(words, k=rng.randrange(1, 9))) + rng.choice([". ", "!\n", "\n\n", "? "]) for _ in range(n))
        for n in range(1, 40)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = dict(map(tuple, df.select("i", providers.extractive_summary()(F.col("t"))).collect()))
    assert got == {i: summary_by_hand(t) for i, t in enumerate(texts)}


def test_entities(spark):
    text = "Acme Widgets Inc paid $1,200.50 million to Beta Corp; CEO Jane Doe met in New York. Acme Widgets Inc again."
    got = one(spark, providers.pattern_entities()(F.lit(text)))
    assert got.companies == ["Acme Widgets Inc", "Beta Corp"]
    assert got.financial_amounts == ["$1,200.50 million"]
    assert got.executives == ["CEO Jane Doe"]
    assert got.locations == ["New York"]
    parsed = one(spark, providers.parse_entities(F.lit('{"companies":["A"],"locations":[]}')))
    assert parsed.companies == ["A"] and parsed.locations == [] and parsed.executives is None


def test_external_provider(spark):
    opened = providers.external_text(lambda: lambda batch: [t.upper() for t in batch])
    df = spark.createDataFrame([("a",), ("b",)], "t string")
    assert sorted(r[0] for r in df.select(opened(F.col("t"))).collect()) == ["A", "B"]


def test_length_filter(spark):
    kept = enrich.nonempty_filings(filings(spark, ["x" * 100, "x" * 101, None]))
    assert [len(r.filing_text) for r in kept.collect()] == [101]


def test_ids_newest_first_and_limit(spark):
    df = filings(spark, [f"{i} " + "word " * 30 for i in range(6)])
    out = enrich.enrich_filings(df, limit=4).orderBy("filing_id").collect()
    assert [(r.filing_id, r.cik) for r in out] == [(1, "0"), (2, "1"), (3, "2"), (4, "3")]
    copies = df.unionByName(df)
    ids = enrich.assign_ids(copies, unique_key=False).select("filing_id").collect()
    assert sorted(r.filing_id for r in ids) == list(range(1, 13))


def test_enrichment_has_no_shuffle_and_no_python(spark, sf):
    from fathomline.sources import given

    plan = enrich.enrich_filings(given.filings(spark, sf), ids=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Window" not in plan


def test_report_reads_no_text_it_does_not_need(spark, sf):
    from fathomline.sources import given

    plan = reports.filing_dashboard(enrich.enrich_filings(given.filings(spark, sf), ids=False).withColumn("filing_id", F.lit(1)))
    scan = plan.select("company_name")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string,source:string>" in scan.replace("doc_id:bigint,", "")


def test_cache_sees_each_text_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def client():
        def summarise(batch):
            calls.add(len(batch))
            return [t[:1] for t in batch]

        return summarise

    own = enrich.TextProviders(summary=providers.external_text(client))
    df = filings(spark, ["same"] * 20 + ["other", "third"])
    path = str(tmp_path / "cache")
    enrich.new_results(df.where("filing_text = 'other'"), None, own).write.parquet(path)
    enrich.new_results(df, spark.read.parquet(path), own).write.mode("append").parquet(path)
    assert calls.value == 3
    out = enrich.attach_results(df, spark.read.parquet(path))
    assert out.count() == 22 and out.where("ai_summary is null").count() == 0
    assert enrich.new_results(df, spark.read.parquet(path), own).count() == 0


def test_share_and_members(spark):
    df = done(spark, [(1, "Z", DAY, "s", "neutral", 0.0, "A"), (2, "Z", DAY, "s", "neutral", 0.0, "A"), (3, "Y", DAY, "s", "neutral", 0.0, "B")])
    assert [tuple(r) for r in reports.classification_share(df).collect()] == [("A", 2, 66.67), ("B", 1, 33.33)]
    assert [tuple(r) for r in reports.classification_members(df).collect()] == [("A", 1, "Z, Z"), ("B", 1, "Y")]


def test_member_pages_join_to_the_whole_list(spark):
    """One class and one name hold most of the rows; no page exceeds its size."""
    rng = random.Random(5)
    rows = [("hot", "busy")] * 500 + [("hot", f"n{rng.randrange(30):02d}") for _ in range(200)]
    rows += [(f"c{i}", "solo") for i in range(10)]
    df = spark.createDataFrame(rows, "classification string, company_name string")
    got = collections.defaultdict(list)
    for r in reports.classification_members(df, page_size=7).collect():
        names = r.companies.split(", ")
        assert r.page == len(got[r.classification]) // 7 + 1 and len(names) <= 7
        got[r.classification] += names
    want = collections.defaultdict(list)
    for group, name in sorted(rows):
        want[group].append(name)
    assert got == want


def test_deals_by_case(spark):
    df = done(spark, [(1, "a", DAY, "MERGER closed", "neutral", 0.0, "Other"), (2, "b", DAY, "a merger", "neutral", 0.0, "Other"), (3, "c", DAY, "x", "neutral", 0.0, "M&A")])
    ids = lambda out: sorted(r.filing_id for r in out.collect())
    assert ids(reports.deal_activity(df)) == [1, 2, 3]
    assert ids(reports.deal_activity(df, case_sensitive=True)) == [2, 3]


def test_trends_heatmap_stats(spark):
    df = done(spark, [(1, "a", DAY, "s", "positive", 0.5, "IPO"), (2, "a", dt.date(2026, 3, 9), "s", "neutral", 0.1, "IPO"), (3, "a", dt.date(2026, 2, 9), "s", "negative", -0.5, "M&A")])
    trends = [tuple(r) for r in reports.sentiment_trends(df).collect()]
    assert [(t[1], t[2], t[4:]) for t in trends] == [(dt.date(2026, 3, 1), 2, (1, 0, 1)), (dt.date(2026, 2, 1), 1, (0, 1, 0))]
    heat = [tuple(r) for r in reports.sentiment_heatmap(df).collect()]
    assert heat == [(dt.date(2026, 3, 9), "IPO", 0.3), (dt.date(2026, 2, 9), "M&A", -0.5)]
    row = reports.filing_summary_stats(df).first()
    assert (row.total_filings_processed, row.unique_companies, row.ma_count, row.ipo_count) == (3, 1, 1, 2)


def test_recent_and_briefing(spark):
    rows = [(i, f"c{i:02d}", DAY - dt.timedelta(days=i // 2), "sum", "neutral", 0.0, "Other") for i in range(11)]
    rows.append((99, "old", DAY - dt.timedelta(days=30), "sum", "neutral", 0.0, "Other"))
    df = done(spark, rows)
    lines = reports.briefing_lines(reports.recent_activity(df, tie="filing_id"), tie="filing_id").first().filing_list.split("\n")
    assert len(lines) == 10
    assert lines[0] == "- c00 (2026-03-15): sum [Sentiment: neutral, Type: Other]"
    made = reports.briefing(df, tie="filing_id").first()
    assert made.report_date == DAY and made.briefing_text.startswith("Recent filings: 10 in the period")
    own = reports.briefing(df, tie="filing_id", provider=lambda t: F.substring(t, 1, 7)).first()
    assert own.briefing_text == "You are"
    assert reports.briefing(df, as_of=dt.date(2027, 1, 1), tie="filing_id").count() == 0
    assert reports.briefing_lines(df.where("false"), tie="filing_id").first().filing_list == ""


def test_filing_run(spark, tmp_path):
    texts = [f"{i} strong growth after the merger. " + "filler words here. " * 9 for i in range(5)]
    made = runs.run_filings(filings(spark, texts), runs.FilingRun(), str(tmp_path / "done"))
    assert made["filing_summaries"].count() == 5
    assert made["deal_activity"].count() == 5
    assert made["classification_share"].first().classification == "M&A"
    assert made["executive_briefing"].count() == 1


def test_places_are_literal_and_may_be_none(spark):
    df = spark.createDataFrame([("Seen in St. Louis, not StX Louis or San (A) city",)], "t string")
    found = df.select(providers.pattern_entities(places=["St. Louis", "San (A)"])(F.col("t")).alias("e")).first().e
    assert found.locations == ["San (A)", "St. Louis"]
    assert df.select(providers.pattern_entities(places=[])(F.col("t")).alias("e")).first().e.locations == []


def test_rounding_keeps_large_values(spark):
    df = spark.createDataFrame([(1e14,), (-1.5000004,), (float("nan"),)], "x double")
    a, b, c = (r.x for r in runs.rounded(df).collect())
    assert (a, b) == (1e14, -1.5) and c != c


def test_calls_are_stored_and_resumed(spark, tmp_path):
    """Copies are called once, failures keep their error, and a second run asks only for what is missing."""
    log = tmp_path / "log"
    log.mkdir()

    def client(broken):
        def opened():
            def reply(text):
                (log / f"{text}-{len(list(log.iterdir()))}").touch()
                if text in broken:
                    raise ValueError(text)
                return text.upper()

            return reply

        return opened

    df = filings(spark, ["a", "b", "b", "c", None]).coalesce(1)
    path = str(tmp_path / "calls")

    def run(broken):
        made = enrich.call_and_store(df, path, providers.external_calls(client(broken), attempts=2))
        return sorted((r["reply"] or "", r["error"] or "", r["attempts"]) for r in made.collect())

    assert run({"b"}) == [("", "ValueError: b", 2), ("A", "", 1), ("C", "", 1)]
    assert len(list(log.iterdir())) == 4
    assert run({"a", "c"}) == [("A", "", 1), ("B", "", 1), ("C", "", 1)]
    assert len(list(log.iterdir())) == 5
    assert run(set()) == [("A", "", 1), ("B", "", 1), ("C", "", 1)] and len(list(log.iterdir())) == 5


def test_replies_are_mapped_onto_labels(spark):
    replies = ["M&A", " ipo. ", "executive change", "'Restructuring'", "no idea", None, ""]
    df = spark.createDataFrame([(r,) for r in replies], "t string")
    got = [r[0] for r in df.select(providers.normalised(lambda t: t)(F.col("t"))).collect()]
    assert got == ["M&A", "IPO", "Executive_Change", "Restructuring", "Other", "Other", "Other"]


def test_default_marks_hit_every_family(spark, sf):
    from fathomline.operators import mining
    from fathomline.plans import catalog

    types = {r["type"] for r in catalog.QUERIES["triggers_default"](spark, sf).collect()}
    assert types == {f for f, _, _ in mining.TRIGGER_FAMILIES}
    assert {r["classification"] for r in catalog.QUERIES["classify_default"](spark, sf).collect()} == set(labels.LABELS)


def names_by_hand(text, names, fold):
    cut = re.compile(r"[^\W_]+|(?:[^\w\s]|_)+").findall
    keys = {}
    for name in sorted(n for n in names if n):
        keys.setdefault(tuple(cut(fold(name))), name)
    keys.pop((), None)
    sizes = sorted({len(k) for k in keys}, reverse=True)
    parts, at, found = cut(fold(text or "")), 0, []
    while at < len(parts):
        for n in sizes:
            name = keys.get(tuple(parts[at : at + n]))
            if name and at + n <= len(parts):
                found.append((at, n, name))
                at += n
                break
        else:
            at += 1
    return found


@pytest.mark.parametrize("ignore_case", [False, True])
def test_names_of_a_long_list(spark, ignore_case):
    chance = random.Random(3)
    words = ["New", "new", "York", "Ode", "été", "7", "a", "&", "O'Neil"]
    names = {" ".join(chance.choices(words, k=chance.randint(1, 4))) for _ in range(40)}
    names = [*names, "New  York", "New York", "", "  ", None, *(f"Filler {i}" for i in range(25_000))]
    texts = [" ".join(chance.choices(words + [",", "York. New"], k=chance.randint(0, 60))) for _ in range(60)]
    texts += [None, "", "Filler 24999\tNew\nYork", "New York " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("name", F.lit("clash"))
    listed = spark.createDataFrame([(n, 1) for n in names], "name string, id int")
    fold = str.lower if ignore_case else str
    found = gazetteer.find_names(df, listed, "id", "text", ignore_case=ignore_case)
    made = collections.defaultdict(list)
    for r in found.collect():
        made[r.id].append((r.start, r.n, r.name))
    want = {i: names_by_hand(t, names, fold) for i, t in enumerate(texts)}
    assert {i: sorted(m) for i, m in made.items()} == {i: w for i, w in want.items() if w}
    lists = gazetteer.name_lists(df, listed, "id", "text", ignore_case=ignore_case).collect()
    assert {r.id: r.names for r in lists} == {i: sorted({n for _, _, n in w}) for i, w in want.items()}


def test_names_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b")], "id long, text string")
    none = spark.createDataFrame([(None,), ("",)], "name string")
    assert gazetteer.find_names(df, none, "id", "text").collect() == []
    assert gazetteer.name_lists(df, none, "id", "text").first().names == []
    assert gazetteer.find_names(df.limit(0), df.select(F.lit("a").alias("name")), "id", "text").collect() == []


def test_names_shuffle_no_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b")], "id long, text string")
    df.write.parquet(str(tmp_path / "t"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = gazetteer.find_names(spark.read.parquet(str(tmp_path / "t")), df, "id", "text", "text")
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 1
    assert not any("Exchange hash" in line and "text" in line for line in plan.splitlines())


def test_names_behind_a_full_filter_and_one_run_per_start(spark, monkeypatch):
    names = ["a b", "b c", "a b c d", "c d", "d"] + [f"x{i} y z" for i in range(30_000)]
    texts = ["a b c x a b c d", "c d d a b", "b c d", "x7 y z y x7 y", None, ""]
    df = spark.createDataFrame([*enumerate(texts), (0, texts[0]), (None, "a b"), (None, "c d")], "id long, text string")
    listed = spark.createDataFrame([(n,) for n in names], "name string")
    want = {i: w for i, t in enumerate(texts) if (w := names_by_hand(t, names, str))} | {None: [(0, 2, "a b")]}
    shuffled = []
    for words in (gazetteer.MOST_WORDS, 128):  # 128 words are full
        monkeypatch.setattr(gazetteer, "MOST_WORDS", words)
        made = collections.defaultdict(list)
        found = gazetteer.find_names(df, listed, "id", "text")
        for r in found.collect():
            made[r.id].append((r.start, r.n, r.name))
        assert {i: sorted(m) for i, m in made.items()} == want
        rows = gazetteer.name_lists(df, listed, "id", "text").collect()
        lists = {i: sorted({n for *_, n in w}) for i, w in want.items() if i is not None}
        assert sorted((str(r.id), r.names) for r in rows) == sorted(
            [(str(i), lists.get(i, [])) for i in [*range(len(texts)), 0]] + [("None", [])] * 2
        )
        keys = gazetteer._keys(listed, "name", False)
        parts = df.select("id", gazetteer.tokens(F.col("text")).alias("parts"))
        likely = gazetteer._likely(parts, gazetteer._filter(keys, words), [1, 2, 3, 4], words).where("id = 1").collect()
        shuffled.append(len(likely))
        assert len({r.start for r in likely}) == len(likely)
    assert shuffled[0] <= shuffled[1] == 5

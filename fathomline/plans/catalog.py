"""Registered queries: every operator over the given tables.

Each entry takes (spark, sf_dir) and returns a DataFrame; doubles are rounded to six
places so that another engine can be compared.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline import schemas
from fathomline.functions import labels, providers
from fathomline.operators import enrich, evaluate, gazetteer, merge, mining, price_features, regress, reports, usage
from fathomline.operators import forecast as fc
from fathomline.operators.dates import days_back, since
from fathomline.operators.sampling import sample_rows
from fathomline.plans import runs
from fathomline.plans.runs import rounded
from fathomline.runtime import scratch_path
from fathomline.sources import feeds, files, given, payloads, tables
from fathomline.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Vocabularies that occur in the given texts.
LEXICON = {"with": 1.0, "this": 1.0, "thing": 0.5, "that": -1.0, "from": -1.0, "than": -0.5}
RULES = [
    ("M&A", r"license[^a-z]"),
    ("IPO", r"[^a-z]thing[^a-z]"),
    ("Restructuring", r"[^a-z](queau|those)[^a-z]"),
    ("Executive_Change", r"[^a-z]this[^a-z]"),
    ("Financial_Restatement", r"[^a-z]that[^a-z]"),
    ("Material_Event", r"[^a-z](und|les|los)[^a-z]"),
]
DEAL_TERMS = ("License", "Thing", "Und")
ENTITY_PATTERNS = {
    "companies": r"(?:[A-Z][a-z]+ ){1,2}(?:License|Public|Software)",
    "executives": r"[A-Z][a-z]+ [A-Z][a-z]+",
    "financial_amounts": r"[0-9][0-9,]*(?:\.[0-9]+)*",
}
PLACES = ["Apache", "General", "Public", "Die", "Of"]
FAMILIES = [
    ("correction", "high", [r"^no[,.]?\s+", r"\bthis\b"]),
    ("disagreement", "medium", [r"\bwith\b", r"\bund\s+der\b"]),
    ("clarification", "medium", [r"\bfrom\b"]),
    ("discovery", "high", [r"\bthat\b"]),
    ("decision", "medium", [r"\bthe\b", r"\bque\b"]),
]
NOISE = [
    mining.CommentRule("confirmations", r"license", ignore_case=True),
    mining.CommentRule("thank_you_replies", r"this", ignore_case=True, reply=True),
    mining.CommentRule("learnings", r"that", ignore_case=True, without=r"with|from"),
    mining.CommentRule("human_fixed", r"the", ignore_case=True, human=True),
]
PRIORITY = [
    mining.CommentRule("critical", r"That", reply=False),
    mining.CommentRule("high", r"the.*from", reply=False),
    mining.CommentRule("medium", r"und|les", reply=False),
    mining.CommentRule("human", reply=False, human=True),
]
REVIEWERS = [("helper", ["Assistant[bot]"]), ("runner", ["runner[bot]", "runner-bot"])]
RATES = [("view", 1.5, 6.0), ("purchase", 1.25, 5.0), ("click", 0.5, 2.0), ("signup", 3.0, 12.0)]
PROVIDERS = enrich.TextProviders(
    summary=providers.extractive_summary(),
    sentiment=providers.lexicon_sentiment(LEXICON),
    classify=providers.rule_classifier(RULES),
)
BACK_DAYS = 30


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _same_day(spark: SparkSession, sf: str) -> DataFrame:
    return price_features.price_features(given.prices(spark, sf), target="same_day", layout="keyed")


def _next_day(spark: SparkSession, sf: str, dropna: bool = True) -> DataFrame:
    return price_features.price_features(given.prices(spark, sf), dropna=dropna, layout="keyed")


def _stamp() -> Column:
    return F.lit(given.LOADED_AT).cast("timestamp_ntz")


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts from the rows before the last month, for the days of that month."""
    bars = given.prices(spark, sf)
    past = bars.where(F.col("date") < days_back(given.last_price_day(spark, sf), BACK_DAYS))
    return fc.as_predictions(
        fc.forecast(past, "symbol", "date", "close", horizon=BACK_DAYS), run_ts=_stamp()
    )


def _recent(spark: SparkSession, sf: str, days: int) -> DataFrame:
    return given.prices(spark, sf, given.day_back(spark, sf, days))


def _tested(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.backtest(
        _recent(spark, sf, BACK_DAYS), _predictions(spark, sf), given.last_price_day(spark, sf), BACK_DAYS
    )


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return given.filings(spark, sf)


def _enriched(spark: SparkSession, sf: str, ids: bool = False, originals: bool = True) -> DataFrame:
    return enrich.enrich_filings(
        _texts(spark, sf), PROVIDERS, ids=ids, run_ts=_stamp(), stored_text=given.FILING_TEXT, originals=originals
    )


def _summaries(spark: SparkSession, sf: str) -> DataFrame:
    """The enriched table without the full text, stored once so that filters do not repeat text steps."""
    return _stored(_enriched(spark, sf, ids=True, originals=False), "summaries")


def _stored(df: DataFrame, label: str) -> DataFrame:
    return tables.replace_table(df, scratch_path(df.sparkSession, label))


# --- prices -----------------------------------------------------------------


@query
def scan_prices(spark, sf):
    return rounded(given.prices(spark, sf))


@query
def project_alias(spark, sf):
    return rounded(
        given.prices(spark, sf).select(
            "symbol",
            "date",
            F.col("close").alias("price"),
            F.lit("actual").alias("type"),
            F.lit("v1.0").alias("model_version"),
        )
    )


@query
def symbol_history(spark, sf):
    return rounded(
        given.prices(spark, sf).where(F.col("symbol") == "Brand#1").orderBy(F.desc("date"))
    )


@query
def lookback_filter(spark, sf):
    # At least the six months: the exact bound is the filter that follows.
    bars, last = _recent(spark, sf, 6 * 31), given.last_price_day(spark, sf)
    return rounded(bars.where(since(bars, "date", last, months=6)).select("symbol", "date", "close"))


@query
def features_same_day(spark, sf):
    return rounded(_same_day(spark, sf))


@query
def features_next_day(spark, sf):
    return rounded(_next_day(spark, sf))


@query
def features_split_series(spark, sf):
    """The same features with every series cut into overlapping chunks."""
    return rounded(
        price_features.price_features(given.prices(spark, sf), layout="ranged", chunk_rows=10_000)
    )


@query
def drop_incomplete(spark, sf):
    return rounded(_next_day(spark, sf).select("symbol", "date", "close", "prev_close_7d", "target_price"))


@query
def moving_averages(spark, sf):
    return rounded(_same_day(spark, sf).select("symbol", "date", "ma_7", "ma_30"))


@query
def momentum(spark, sf):
    return rounded(_same_day(spark, sf).select("symbol", "date", "momentum_1d", "momentum_7d"))


@query
def rolling_volatility(spark, sf):
    return rounded(_same_day(spark, sf).select("symbol", "date", "volatility_7d"))


@query
def volume_momentum(spark, sf):
    return rounded(_same_day(spark, sf).select("symbol", "date", "volume_momentum"))


@query
def prev_close(spark, sf):
    return rounded(_same_day(spark, sf).select("symbol", "date", "prev_close"))


@query
def day_of_week(spark, sf):
    return given.prices(spark, sf).select(
        "symbol", "date", price_features.day_of_week(F.col("date")).alias("day_of_week")
    )


@query
def backtest(spark, sf):
    return rounded(_tested(spark, sf))


@query
def error_metrics(spark, sf):
    return rounded(evaluate.error_metrics(_tested(spark, sf)))


@query
def error_metrics_rounded(spark, sf):
    return evaluate.error_metrics(_tested(spark, sf), digits=2)


@query
def latest_per_symbol(spark, sf):
    return rounded(evaluate.latest_per_key(given.prices(spark, sf), "symbol", "date"))


@query
def latest_stats(spark, sf):
    return rounded(evaluate.latest_stats(_recent(spark, sf, 31), given.last_price_day(spark, sf)))


@query
def holdout_metrics(spark, sf):
    parts = regress.ordered_split(
        _next_day(spark, sf).select("date", "symbol", "target_price", "ma_7"), ["date", "symbol"]
    )
    return rounded(evaluate.holdout_metrics(parts.where("part = 'test'"), "target_price", "ma_7"))


@query
def prediction_summary(spark, sf):
    return rounded(evaluate.prediction_summary(_predictions(spark, sf)))


@query
def feature_profile(spark, sf):
    return evaluate.feature_profile(_next_day(spark, sf))


@query
def ingest_profile(spark, sf):
    return evaluate.ingest_profile(given.prices(spark, sf))


@query
def actual_vs_predicted(spark, sf):
    return rounded(
        evaluate.actual_vs_predicted(
            _recent(spark, sf, BACK_DAYS), _predictions(spark, sf), given.last_price_day(spark, sf), BACK_DAYS
        )
    )


@query
def recent_prices_topk(spark, sf):
    return rounded(given.prices(spark, sf).orderBy(F.desc("date"), "symbol").limit(20))


@query
def sample_half(spark, sf):
    return rounded(sample_rows(given.prices(spark, sf), 0.5, ["symbol", "date"], seed=7))


@query
def forecast_linear(spark, sf):
    return rounded(fc.forecast(given.prices(spark, sf), "symbol", "date", "close"))


@query
def forecast_holt(spark, sf):
    return rounded(fc.forecast(given.prices(spark, sf), "symbol", "date", "close", method="holt"))


@query
def forecast_flat(spark, sf):
    flat = fc.forecast_flat(_next_day(spark, sf), F.col("ma_7"))
    return rounded(flat.drop("created_at"))


@query
def ordered_split(spark, sf):
    return regress.ordered_split(given.prices(spark, sf).select("symbol", "date"), ["date", "symbol"])


@query
def cv_folds(spark, sf):
    return regress.assign_folds(given.prices(spark, sf).select("symbol", "date"), ["date", "symbol"])


@query
def standardize(spark, sf):
    cols = ["high", "low", "close"]
    rows = given.prices(spark, sf).select("symbol", "date", *cols)
    parts = regress.ordered_split(rows, ["date", "symbol"])
    return rounded(regress.standardize(parts, cols, parts.where("part = 'train'")))


def _searched(features: DataFrame):
    return regress.fit_regressor(features, price_features.REGRESSOR_FEATURES, "target_price", regress.FULL_GRID)


@query
def regressor_scores(spark, sf):
    """The full search; what any search over these rows must report next to its errors.

    The mean of the training rows is the naive guess that the chosen trees have to match on
    the held-out rows, within a tenth.
    """
    features = _stored(_next_day(spark, sf), "features")
    model, metrics = _searched(features)
    parts = regress.ordered_split(features.select("date", "symbol", "target_price"), ["date", "symbol"])
    guess = parts.where("part = 'train'").agg(F.avg("target_price").alias("guess")).first()["guess"]
    off = F.col("target_price") - F.lit(guess)
    naive = parts.where("part = 'test'").agg(F.sqrt(F.avg(off * off)).alias("naive")).first()["naive"]
    chosen = all(model.chosen[name] in values for name, values in regress.FULL_GRID.items())
    return metrics.select(
        F.col("n").alias("test_rows"),
        F.lit(model.sizes["train"]).cast("bigint").alias("train_rows"),
        F.lit(model.tried).alias("combinations"),
        F.lit(chosen).alias("chosen_from_grid"),
        (F.col("rmse") <= 1.1 * F.lit(naive)).alias("no_worse_than_mean"),
        (F.col("rmse") >= F.col("mae")).alias("errors_in_order"),
        F.lit(len(model.trees) == model.chosen["maxIter"]).alias("all_trees"),
    )


def _outlook_checks(made: DataFrame, features: DataFrame) -> DataFrame:
    """Keys and days of flat forecasts, with what must hold for the values of any trees."""
    low, high = features.agg(F.min("target_price"), F.max("target_price")).first()
    inside = F.col("predicted_close").between(2 * low - high, 2 * high - low)
    width = F.col("confidence_interval_high") - F.col("confidence_interval_low")
    centred = F.abs(F.col("confidence_interval_high") + F.col("confidence_interval_low") - 2 * F.col("predicted_close"))
    return rounded(
        made.select(
            "symbol", "prediction_date", "model_version", width.alias("interval_width"),
            inside.alias("in_range"), (centred < 1e-6).alias("centred"),
        )
    )


@query
def model_roundtrip(spark, sf):
    """Forecasts of the full search's model, saved and read back, next to those of the model in memory."""
    features = _stored(_next_day(spark, sf), "features")
    model, _ = _searched(features)
    path = scratch_path(spark, "models")
    regress.save_model(spark, model, path, "v1")
    again = regress.load_model(spark, path, "v1")
    made, kept = (fc.forecast_flat(features, m, version="v1", run_ts=_stamp()) for m in (again, model))
    kept = kept.select("symbol", "prediction_date", F.col("predicted_close").alias("_kept"))
    both = made.join(kept, ["symbol", "prediction_date"])
    same = both.select("symbol", "prediction_date", (F.col("predicted_close") == F.col("_kept")).alias("reloaded_equal"))
    return _outlook_checks(made, features).join(same, ["symbol", "prediction_date"])


@query
def price_run(spark, sf):
    """The whole price run: stored features, chosen trees, stored forecasts."""
    cfg = runs.PriceRun(lookback=None, grid=regress.FULL_GRID, layout="keyed", score_on="latest")
    paths = scratch_path(spark, "features"), scratch_path(spark, "predictions")
    predictions, _ = runs.run_prices(given.prices(spark, sf), cfg, *paths)
    return _outlook_checks(predictions, spark.read.parquet(paths[0]).dropna())


@query
def lexicon_table_sentiment(spark, sf):
    """Scores from a lexicon table by join: the words seen in benchmark items, by length parity."""
    terms = given.table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), r"[^a-z]+")).alias("term"))
    lexicon = terms.where("term <> ''").distinct().withColumn(
        "weight", F.when(F.length("term") % 2 == 0, 1.0).otherwise(-1.0)
    )
    return rounded(enrich.sentiment_by_join(_texts(spark, sf), "filing_text", "cik", lexicon))


@query
def feature_table(spark, sf):
    rows = _next_day(spark, sf).withColumn("year", F.year("date"))
    return rounded(tables.replace_table(rows, scratch_path(spark, "feature_table"), "year"))


@query
def ctas_predictions(spark, sf):
    made = fc.as_predictions(fc.forecast(given.prices(spark, sf), "symbol", "date", "close"), run_ts=_stamp())
    return rounded(_stored(made, "predictions"))


@query
def append_aligned(spark, sf):
    made = _predictions(spark, sf)
    path = scratch_path(spark, "aligned")
    tables.write_aligned(made.select(*reversed(made.columns)), path, schemas.PREDICTIONS)
    tables.write_aligned(
        made.withColumn("model_version", F.lit("v2.0")), path, schemas.PREDICTIONS, mode="append"
    )
    return rounded(files.read_table(spark, path, schemas.PREDICTIONS))


@query
def merge_upsert_prices(spark, sf):
    bars, last = given.prices(spark, sf), given.last_price_day(spark, sf)
    cut, start = days_back(last, BACK_DAYS), days_back(last, 2 * BACK_DAYS)
    target = bars.where(F.col("date") < cut).withColumn("ingested_at", _stamp())
    batch = _recent(spark, sf, 2 * BACK_DAYS).where(F.col("date") >= start).withColumns(
        {"close": F.col("close") * 1.01, "ingested_at": _stamp() + F.expr("INTERVAL 1 DAY")}
    )
    return rounded(merge.merge_upsert(target, batch, ["symbol", "date"], "ingested_at"))


# --- filings ----------------------------------------------------------------


@query
def scan_filings(spark, sf):
    return given.filings(spark, sf)


@query
def cap_text(spark, sf):
    return given.filings(spark, sf).select("cik", labels.capped(F.col("filing_text"), 10_000).alias("filing_text"))


@query
def nonempty_filings(spark, sf):
    return enrich.nonempty_filings(given.filings(spark, sf)).select(
        "cik", "company_name", "filing_date", F.length("filing_text").alias("n_chars")
    )


@query
def filing_preview(spark, sf):
    return given.filings(spark, sf).select("cik", F.substring("filing_text", 1, 200).alias("preview"))


@query
def prompt_text(spark, sf):
    text = F.col("filing_text")
    return given.filings(spark, sf).select(
        "cik",
        labels.prompt(labels.SUMMARY_PROMPT, text).alias("summary_prompt"),
        labels.prompt(labels.CLASSIFY_PROMPT, text).alias("classify_prompt"),
    )


@query
def filing_ids(spark, sf):
    kept = enrich.nonempty_filings(given.filings(spark, sf)).drop("filing_text")
    return enrich.assign_ids(kept).select("filing_id", "cik", "filing_date")


@query
def merge_insert_filings(spark, sf):
    rows = given.filings(spark, sf)
    target = rows.where(F.col("filing_date") < "2024-11-01")
    batch = rows.where(F.col("filing_date") >= "2024-10-01").withColumn(
        "filing_text", F.concat(F.lit("new "), "filing_text")
    )
    return merge.merge_insert(target, batch, ["cik", "form_type", "filing_date"], "url").select(
        "cik", "form_type", "filing_date", merge.text_key(F.col("filing_text")).alias("text_hash")
    )


@query
def lexicon_sentiment(spark, sf):
    return rounded(
        enrich.sentiment(
            _texts(spark, sf), "filing_text", provider=providers.lexicon_sentiment(LEXICON)
        ).select("cik", "sentiment_score")
    )


@query
def sentiment_label(spark, sf):
    scored = enrich.sentiment(
        _texts(spark, sf), "filing_text", provider=providers.lexicon_sentiment(LEXICON)
    )
    return scored.select("cik", labels.sentiment_label(F.col("sentiment_score")).alias("sentiment"))


@query
def rule_classify(spark, sf):
    return enrich.classify(
        _texts(spark, sf), "filing_text", provider=providers.rule_classifier(RULES)
    ).select("cik", "classification")


@query
def classify_default(spark, sf):
    """The default rules over filings that are marked in rotation."""
    rows = _texts(spark, sf).withColumn("filing_text", given.marked(CLASS_MARKS, F.col("cik").cast("bigint"), "filing_text"))
    return enrich.classify(rows, "filing_text").select("cik", "classification")


# What a free-form classifier says, by the length of the text.
REPLIES = ["M&A", " ipo.\n", "executive change", "'Restructuring'", "FINANCIAL RESTATEMENT", "`material_event`", "Other", "no idea", ""]


def _free_form():
    return lambda texts: [REPLIES[len(t) % len(REPLIES)] for t in texts]


@query
def classify_replies(spark, sf):
    """Replies of an external classifier, mapped onto the label set."""
    rows = enrich.nonempty_filings(_texts(spark, sf))
    provider = providers.normalised(providers.external_text(_free_form))
    return enrich.classify(rows, "filing_text", provider=provider).select("cik", "classification")


def _flaky():
    """A client that never answers some texts, and others only when asked the third time."""
    asked: dict[str, int] = {}

    def reply(text: str) -> str:
        asked[text] = asked.get(text, 0) + 1
        if len(text) % 11 == 0 or (len(text) % 5 == 0 and asked[text] < 3):
            raise TimeoutError("busy")
        return f"seen {len(text)}"

    return reply


@query
def external_calls(spark, sf):
    """Calls with a retry budget in two runs; the second asks only for what has no reply."""
    rows, path = _texts(spark, sf), scratch_path(spark, "calls")
    call = providers.external_calls(_flaky, attempts=3)
    keys = enrich.text_keys(rows.select("cik", "filing_date", "filing_text"))
    enrich.call_and_store(rows, path, call, keys=keys.where(F.col("filing_date") < "2024-07-01"))
    made = enrich.call_and_store(rows, path, call, keys=keys)
    runs_of = spark.read.parquet(path).groupBy("text_hash").agg(F.count("*").alias("calls_stored"))
    return keys.select("cik", "text_hash").join(made.join(runs_of, "text_hash"), "text_hash").drop("text_hash")


@query
def extractive_summary(spark, sf):
    return enrich.summarize(_texts(spark, sf), "filing_text").select("cik", "ai_summary")


@query
def filing_entities(spark, sf):
    found = enrich.extract_entities(
        _texts(spark, sf),
        "filing_text",
        provider=providers.pattern_entities(ENTITY_PATTERNS, PLACES),
    )
    return found.select(
        "cik",
        *[F.array_join(f"entities.{f}", "|").alias(f) for f in providers.ENTITY_FIELDS],
    )


def _phrases(spark: SparkSession, sf: str) -> DataFrame:
    """Every run of two or three tokens that users write, as a long list of names."""
    asked = given.turns(spark, sf).where(F.col("role") == "user").select(gazetteer.tokens(F.col("text")).alias("parts"))
    runs = F.flatten(F.array(*[gazetteer.token_runs(F.col("parts"), F.lit(n)) for n in (2, 3)]))
    return asked.where(F.size("parts") >= 3).select(F.inline(runs)).select(F.col("key").alias("name")).distinct()


@query
def filing_names(spark, sf):
    """Names of a list of any size in filings: leftmost, longest, without overlap."""
    return gazetteer.find_names(given.filings(spark, sf), _phrases(spark, sf), "cik", "filing_text")


@query
def filing_name_lists(spark, sf):
    """The distinct names of each filing, whatever their case."""
    made = gazetteer.name_lists(given.filings(spark, sf), _phrases(spark, sf), "cik", "filing_text", ignore_case=True)
    return made.select("cik", F.size("names").cast("bigint").alias("n_names"), F.sha2(F.array_join("names", "|"), 256).alias("names_sha256"))


@query
def enriched_filings(spark, sf):
    return rounded(_enriched(spark, sf, ids=True))


@query
def bounded_docs(spark, sf):
    done = enrich.enrich_filings(_texts(spark, sf), PROVIDERS, limit=50, run_ts=_stamp(), stored_text=given.FILING_TEXT)
    return rounded(done.select("filing_id", "cik", "sentiment_score", "classification"))


@query
def deal_activity_ci(spark, sf):
    return rounded(reports.deal_activity(_summaries(spark, sf), DEAL_TERMS))


@query
def deal_activity_cs(spark, sf):
    return rounded(reports.deal_activity(_summaries(spark, sf), DEAL_TERMS, case_sensitive=True))


@query
def filing_dashboard(spark, sf):
    return rounded(reports.filing_dashboard(_enriched(spark, sf, ids=True, originals=False)))


@query
def sentiment_trends(spark, sf):
    return rounded(reports.sentiment_trends(_enriched(spark, sf)))


@query
def classification_share(spark, sf):
    return reports.classification_share(_enriched(spark, sf))


@query
def classification_members(spark, sf):
    return reports.classification_members(_enriched(spark, sf), page_size=100)


@query
def sentiment_heatmap(spark, sf):
    return rounded(reports.sentiment_heatmap(_enriched(spark, sf)))


@query
def filing_summary_stats(spark, sf):
    return rounded(reports.filing_summary_stats(_enriched(spark, sf)))


@query
def recent_activity(spark, sf):
    return reports.recent_activity(_enriched(spark, sf)).select(
        "cik", "company_name", "form_type", "filing_date", "ai_summary", "sentiment", "classification"
    )


@query
def briefing_input(spark, sf):
    return reports.briefing_lines(reports.recent_activity(_enriched(spark, sf))).select("filing_list")


@query
def executive_briefing(spark, sf):
    return reports.briefing(_enriched(spark, sf))


@query
def unprocessed_docs(spark, sf):
    hashed = given.filings(spark, sf).withColumn("text_hash", merge.text_key(F.col("filing_text")))
    done = hashed.where(F.col("filing_date") < "2024-07-01")
    return merge.unseen(hashed, done, "text_hash").select("cik", "text_hash")


@query
def cached_enrichment(spark, sf):
    """Fill a result cache from the older filings, add the rest, and attach to all."""
    rows = _texts(spark, sf)
    path = scratch_path(spark, "cache")
    keys = enrich.text_keys(rows.select("cik", "filing_date", "filing_text"))
    older = keys.where(F.col("filing_date") < "2024-07-01")
    enrich.new_results(rows, None, PROVIDERS, keys=older).write.parquet(path)
    enrich.new_results(rows, spark.read.parquet(path), PROVIDERS, keys=keys).write.mode("append").parquet(path)
    return rounded(
        enrich.attach_results(keys, spark.read.parquet(path)).select(
            "cik", "text_hash", "sentiment_score", "classification", "ai_summary"
        )
    )


@query
def trained_classify(spark, sf):
    marked = given.table(spark, sf, "documents").join(given.table(spark, sf, "labels"), "doc_id")
    model = runs.train_classifier(marked.select("doc_id", "text", "quality"), "text", "quality")
    scored = model.transform(given.table(spark, sf, "documents").select("doc_id", "text"))
    return scored.select("doc_id", "prediction")


@query
def filing_report(spark, sf):
    """Row counts of every report of a full filing run."""
    made = runs.run_filings(
        _texts(spark, sf), runs.FilingRun(PROVIDERS, deal_terms=DEAL_TERMS, stored_text=given.FILING_TEXT), scratch_path(spark, "filings")
    )
    counts = [df.agg(F.count("*").alias("num_rows")).select(F.lit(n).alias("report"), "num_rows") for n, df in made.items()]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


@query
def stored_briefing(spark, sf):
    """The one-row table that a filing run leaves, read back from its path."""
    path = scratch_path(spark, "filings")
    cfg = runs.FilingRun(PROVIDERS, deal_terms=DEAL_TERMS, stored_text=given.FILING_TEXT)
    runs.run_filings(_texts(spark, sf), cfg, path)
    return spark.read.parquet(f"{path}_briefing")


# --- files and payloads -----------------------------------------------------


@query
def csv_null_rules(spark, sf):
    rows = given.table(spark, sf, "documents").select(
        "doc_id",
        F.concat_ws(", ", "source", "lang").alias("name"),
        F.when(F.col("lang") == "fr", "NULL").when(F.col("lang") == "de", "").when(
            F.col("lang") == "en", F.col("source")
        ).alias("note"),
        "n_chars",
    )
    path = scratch_path(spark, "csv")
    rows.write.csv(path, header=True, quoteAll=True, escape='"')
    kinds = T.StructType.fromDDL("doc_id bigint, name string, note string, n_chars bigint")
    return files.read_csv(spark, path, kinds)


@query
def json_read(spark, sf):
    rows = given.table(spark, sf, "documents")
    path = scratch_path(spark, "json")
    rows.write.json(path)
    return files.read_json(spark, path, rows.schema)


@query
def staged_load(spark, sf):
    root = scratch_path(spark, "stage")
    given.prices(spark, sf).write.parquet(f"{root}/stock-data/")
    given.filings(spark, sf).write.json(f"{root}/filings/")
    prices = files.staged_load(spark, root, "stock-data", "parquet")
    filings = files.staged_load(spark, root, "filings", "json", given.filings(spark, sf).schema)

    def span(df: DataFrame, name: str, date: str) -> DataFrame:
        return df.agg(
            F.count("*").alias("num_rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date")
        ).select(F.lit(name).alias("dataset"), "*")

    return span(prices, "stock-data", "date").unionByName(span(filings, "filings", "filing_date"))


def _staged_payloads(bars: DataFrame) -> DataFrame:
    return payloads.daily_payload(bars, F.year("date")).select(F.col("payload").alias("value"))


@query
def parse_daily_series(spark, sf):
    path = scratch_path(spark, "payloads")
    _staged_payloads(given.prices(spark, sf)).write.text(path)
    rows, _ = payloads.parse_daily_series(spark.read.text(path), "value")
    return rounded(rows.drop("ingested_at"))


def _bad_replies(spark, sf) -> DataFrame:
    """Event rows as service replies: errors, rate-limit notes and unknown bodies."""
    kind, text = F.col("event_type"), F.concat(F.lit("event "), F.col("event_id").cast("string"))
    body = (
        F.when(kind == "error", F.to_json(F.create_map(F.lit(payloads.ERROR), text)))
        .when(kind == "view", F.to_json(F.create_map(F.lit(payloads.NOTE), text)))
        .otherwise(F.to_json(F.create_map(F.lit("other"), text)))
    )
    return given.table(spark, sf, "events").select(body.alias("value"))


@query
def payload_rejects(spark, sf):
    bad = _bad_replies(spark, sf)
    _, rejects = payloads.parse_daily_series(bad.unionByName(_staged_payloads(given.prices(spark, sf))), "value")
    return rejects.select("reason", "message")


@query
def parse_filing_feed(spark, sf):
    path = scratch_path(spark, "feed")
    given.filings(spark, sf).select(
        F.col("company_name").alias("title"),
        F.col("url").alias("filing-href"),
        F.col("filing_date").cast("string").alias("filing-date"),
        F.col("filing_text").alias("summary"),
    ).write.option("rowTag", "entry").option("rootTag", "feed").xml(path)
    rows = feeds.parse_filing_feed(spark, path, "8-K", cap=None)
    return rows.drop("ingested_at")


@query
def reset_outputs(spark, sf):
    """Row counts of a raw and a derived table before and after a reset."""
    root = scratch_path(spark, "reset")
    tag = root.rsplit("-", 1)[1]
    raw, derived, view = f"raw_{tag}", f"derived_{tag}", f"view_{tag}"
    bars = given.prices(spark, sf).withColumn("ingested_at", _stamp())
    tables.create_table(spark, raw, schemas.PRICES, f"{root}/raw")
    bars.select(*schemas.PRICES.fieldNames()).write.insertInto(raw)
    tables.create_table(spark, derived, schemas.PRICES, f"{root}/derived")
    spark.table(raw).write.insertInto(derived)
    spark.table(raw).createOrReplaceTempView(view)
    before = _stored(spark.table(raw).agg(F.count("*").alias("rows_before")), "count")
    tables.reset_outputs(spark, views=[view], tables=[derived], truncate=[raw])
    left = spark.table(raw).agg(F.count("*").alias("rows_after"))
    gone = not spark.catalog.tableExists(derived) and not spark.catalog.tableExists(view)
    tables.create_table(spark, derived, schemas.PRICES, f"{root}/derived")
    again = spark.table(derived).count()
    out = before.select(
        "rows_before",
        left.scalar().alias("rows_after"),
        F.lit(gone).alias("derived_dropped"),
        F.lit(again).cast("bigint").alias("rows_recreated"),
    )
    result = _stored(out, "reset_result")
    tables.reset_outputs(spark, tables=[raw, derived])
    return result


# --- conversations, comments, usage -----------------------------------------


def _triggers(spark, sf) -> DataFrame:
    return mining.conversation_triggers(given.turns(spark, sf), FAMILIES)


@query
def conversation_triggers(spark, sf):
    return _triggers(spark, sf)


# Phrases of each default trigger family, and of each default filing class.
TRIGGER_MARKS = [
    "No, that's wrong. ", "I disagree with it. ", "In other words it works. ", "It turns out the same. ",
    "We should use it. ", "Let's proceed with it. ", "Key insight: ", "Why not? ",
]
CLASS_MARKS = [
    "The merger is done. ", "An initial public offering. ", "More layoffs. ", "The CEO resigned. ",
    "Earnings were restated. ", "A material agreement. ",
]
ACCOUNTS = ["CodeRabbitAI[bot]", "cursor-bugbot[bot]", "greptile-bot", "github-actions[bot]", "somebody", "other[bot]", "new-bot"]


def _marked_turns(spark, sf) -> DataFrame:
    return given.turns(spark, sf).withColumn("text", given.marked(TRIGGER_MARKS, F.col("conv_id") + F.col("turn"), "text"))


@query
def triggers_default(spark, sf):
    """The default trigger families over turns that are marked in rotation."""
    return mining.conversation_triggers(_marked_turns(spark, sf))


@query
def triggers_newest(spark, sf):
    """The 25 newest triggers, as a report shows them."""
    found = mining.conversation_triggers(_marked_turns(spark, sf), newest_first=True)
    return found.select("conv_id", "turn", "type", "confidence").limit(25)


@query
def families_default(spark, sf):
    """The default reviewer families over comments whose accounts rotate."""
    login = F.element_at(F.array(*map(F.lit, ACCOUNTS)), (F.pmod("id", F.lit(len(ACCOUNTS))) + 1).cast("int"))
    return given.comments(spark, sf).select("id", mining.author_family(login).alias("family"))


@query
def trigger_counts(spark, sf):
    return mining.trigger_counts(_triggers(spark, sf))


@query
def session_totals(spark, sf):
    return mining.session_totals(given.turns(spark, sf))


@query
def flatten_content(spark, sf):
    """Turns as message content: JSON parts for the assistant, plain text otherwise."""
    lines = F.split("text", "\n")
    parts = F.concat(
        F.array(F.struct(F.lit("image").alias("type"), F.lit("pixels").alias("text"))),
        F.transform(lines, lambda s: F.struct(F.lit("text").alias("type"), s.alias("text"))),
    )
    content = F.when(F.col("role") == "assistant", F.to_json(parts)).otherwise(F.col("text"))
    return given.turns(spark, sf).select("conv_id", "turn", mining.flatten_content(content).alias("text"))


@query
def comment_triage(spark, sf):
    return mining.comment_triage(given.comments(spark, sf), NOISE, PRIORITY)


@query
def comment_priority(spark, sf):
    return mining.with_priority(given.comments(spark, sf), PRIORITY).select("id", "priority")


@query
def unanswered_items(spark, sf):
    return mining.unanswered(given.comments(spark, sf)).select("id", "user_login")


@query
def review_gate(spark, sf):
    return mining.review_gate(given.comments(spark, sf))


def _collected(spark, sf) -> DataFrame:
    both = given.comments(spark, sf)
    reviews = both.where(F.col("user_login") == "Assistant[bot]")
    issues = both.where(F.col("user_login") != "Assistant[bot]").drop("path")
    return mining.collect_comments(reviews, issues, REVIEWERS)


@query
def union_comments(spark, sf):
    return _collected(spark, sf).select("id", "user_login", "path", "family", F.length("body").alias("n_chars"))


@query
def family_counts(spark, sf):
    return mining.family_counts(_collected(spark, sf))


@query
def author_family(spark, sf):
    return given.comments(spark, sf).select(
        "id", mining.author_family(F.col("user_login"), REVIEWERS).alias("family")
    )


def _rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RATES, "model string, input_rate double, output_rate double")


@query
def usage_cost(spark, sf):
    priced, _ = usage.usage_cost(given.usage(spark, sf), _rates(spark))
    return rounded(priced)


@query
def usage_rejects(spark, sf):
    _, rejects = usage.usage_cost(given.usage(spark, sf), _rates(spark))
    return rejects


@query
def usage_by_day(spark, sf):
    return rounded(usage.usage_by_day(given.usage(spark, sf), ["view", "click", "purchase"]))


@query
def run_log_recent(spark, sf):
    return incremental.run_log_recent(given.run_log(spark, sf), ["view", "signup"], tie="event_id").select(
        "event_id", "name", "state", "scheduled_time", "error_code"
    )


# --- incremental ------------------------------------------------------------


def _price_updates(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows, rejects = payloads.parse_daily_series(batch, "value", run_ts=_stamp())
    return rows.withColumn("year", F.year("date")), rejects


PRICE_TABLE = T.StructType([*schemas.PRICES.fields, T.StructField("year", T.IntegerType())])


def _ingest(spark: SparkSession, inbox: str, path: str, checkpoint: str, rejects_path: str | None = None) -> None:
    incremental.stream_upsert(
        spark.readStream.schema("value string").text(inbox),
        path, ["symbol", "date"], "ingested_at", "year", PRICE_TABLE, checkpoint, _price_updates, rejects_path,
    )


@query
def stream_ingest_prices(spark, sf):
    inbox, path, state = (scratch_path(spark, n) for n in ("inbox", "prices", "state"))
    _staged_payloads(given.prices(spark, sf)).write.text(inbox)
    _ingest(spark, inbox, path, state)
    return rounded(spark.read.parquet(path).drop("year", "ingested_at"))


@query
def stream_rejects(spark, sf):
    """Replies that cannot be read, kept by a streamed ingest of two runs."""
    inbox, path, bad, state = (scratch_path(spark, n) for n in ("inbox", "prices", "rejects", "state"))
    replies, good = _bad_replies(spark, sf), _staged_payloads(given.prices(spark, sf))
    good.write.text(inbox)
    _ingest(spark, inbox, path, state, bad)
    replies.write.mode("append").text(inbox)
    _ingest(spark, inbox, path, state, bad)
    return spark.read.parquet(bad).select("reason", "message")


@query
def refresh_available_now(spark, sf):
    """Two bounded refreshes; the second brings a corrected close for the last month."""
    bars, last = given.prices(spark, sf), given.last_price_day(spark, sf)
    inbox, path, state = (scratch_path(spark, n) for n in ("inbox", "prices", "state"))
    _staged_payloads(bars).write.text(inbox)
    _ingest(spark, inbox, path, state)
    fixes = bars.where(F.col("date") >= days_back(last, BACK_DAYS)).withColumn("close", F.col("close") + 1)
    _staged_payloads(fixes).write.mode("append").text(inbox)
    _ingest(spark, inbox, path, state)
    return rounded(spark.read.parquet(path).select("symbol", "date", "close"))


@query
def stream_new_filings(spark, sf):
    """Three deliveries over two runs; each filing is enriched once, whatever its age.

    The first two bring the newer half twice, the last one everything, old filings too.
    """
    inbox, path, state = (scratch_path(spark, n) for n in ("inbox", "new_filings", "state"))
    rows = given.filings(spark, sf).withColumn("seen_at", F.col("filing_date").cast("timestamp"))
    newer = rows.where(F.month("filing_date") > 6)

    def enriched(batch: DataFrame) -> DataFrame:
        made = enrich.enrich_filings(batch, PROVIDERS, ids=False, run_ts=_stamp())
        return made.withColumn("month", F.date_format("filing_date", "yyyy-MM"))

    def run() -> None:
        incremental.stream_new_filings(
            spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(inbox),
            ["cik", "form_type", "filing_date"], "seen_at", "month", path, state, enriched,
        )

    newer.write.parquet(inbox)
    files = len(spark.read.schema(rows.schema).parquet(inbox).inputFiles())  # a batch takes as many as one delivery has
    newer.write.mode("append").parquet(inbox)
    run()
    rows.write.mode("append").parquet(inbox)
    run()
    return rounded(spark.read.parquet(path).select("cik", "sentiment_score", "classification"))


LATENESS = dt.timedelta(days=3)


def _deliver_events(spark, sf, every: str, queries: int = 1) -> str:
    """Events of odd hours come in a second delivery, most of them long after their day.

    With two queries the second delivery goes through a checkpoint of its own.
    """
    inbox = scratch_path(spark, "events")
    events = given.table(spark, sf, "events").select("ts", "event_type", "value")
    path, states = scratch_path(spark, "buckets"), [scratch_path(spark, "state") for _ in range(queries)]
    odd = F.coalesce(F.hour("ts") % 2, F.lit(0))
    for part in (0, 1):
        box = f"{inbox}/{part % queries}"
        events.where(odd == part).write.mode("append").parquet(box)
        incremental.stream_counts(
            spark.readStream.schema(events.schema).parquet(box),
            "ts", "event_type", every, LATENESS, path, states[part % queries], value="value",
        )
    return path


def _stream_buckets(spark, sf, every: str, queries: int = 1) -> DataFrame:
    return rounded(spark.read.parquet(_deliver_events(spark, sf, every, queries)).drop("month", "batches"))


@query
def stream_late_rows(spark, sf):
    """What came for days that were final, and for every day its count and whether it is final."""
    path = _deliver_events(spark, sf, "day")
    late = spark.read.parquet(f"{path}_corrections").groupBy("day", "event_type").agg(
        F.sum("n").alias("late_n"), F.sum("total").alias("late_total")
    )
    status = incremental.bucket_status(spark, path, "day", LATENESS).select("day", "event_type", "n", "final")
    return rounded(status.join(late, ["day", "event_type"], "left"))


@query
def stream_two_queries(spark, sf):
    """Two checkpoints write one table; nothing is lost or counted twice."""
    return _stream_buckets(spark, sf, "day", queries=2)


@query
def stream_daily_counts(spark, sf):
    return _stream_buckets(spark, sf, "day")


@query
def stream_weekly_counts(spark, sf):
    return _stream_buckets(spark, sf, "week")

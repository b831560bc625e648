"""Turn filings into summarised, scored and classified rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions.arrays import run_lengths
from fathomline.functions.labels import capped, sentiment_label
from fathomline.functions.providers import (
    Provider,
    extractive_summary,
    lexicon_sentiment,
    pattern_entities,
    rule_classifier,
)
from fathomline.operators.merge import text_key, unseen
from fathomline.operators.ranks import number_by_key, number_rows
from fathomline.runtime import scratch_path
from fathomline.sources.files import FILE, PLACE, fetch_by_address, mark_rows, marked_rows, with_address
from fathomline.sources.tables import exists, replace_table

FILING_KEY = ["cik", "form_type", "filing_date", "url"]
RESULTS = ["ai_summary", "sentiment_score", "classification"]
#: Tasks of the text steps: so many for each core, of at least and at most so many bytes of text.
TASKS_PER_CORE, LEAST_TASK_BYTES, MOST_TASK_BYTES = 4, 1 << 20, 1 << 24


@dataclass(frozen=True)
class TextProviders:
    """The three text steps and how many characters each may read (None = all)."""

    summary: Provider = field(default_factory=extractive_summary)
    sentiment: Provider = field(default_factory=lexicon_sentiment)
    classify: Provider = field(default_factory=rule_classifier)
    summary_chars: int | None = None
    score_chars: int | None = None

    def columns(self, text: str) -> dict[str, Column]:
        t = F.col(text)
        return {
            "ai_summary": self.summary(capped(t, self.summary_chars)),
            "sentiment_score": self.sentiment(capped(t, self.score_chars)),
            "classification": self.classify(capped(t, self.score_chars)),
        }


def nonempty_filings(df: DataFrame, min_len: int = 100) -> DataFrame:
    """Filings whose text is longer than ``min_len`` characters; null text drops out."""
    return df.where(F.length("filing_text") > min_len)


def _filing_order() -> list:
    return [F.desc_nulls_last("filing_date"), *[c for c in FILING_KEY if c != "filing_date"]]


def assign_ids(df: DataFrame, id_col: str = "filing_id", unique_key: bool = True) -> DataFrame:
    """Number filings from 1, newest first, ties by key.

    With a unique key only the key columns are sorted and saved, and joined back;
    ``unique_key=False`` sorts and saves the rows as they are and allows any number of copies.
    """
    if not unique_key:
        return number_rows(df, _filing_order(), id_col)[0]
    return number_by_key(df, _filing_order(), FILING_KEY, id_col)


def bounded_docs(df: DataFrame, limit: int, id_col: str = "filing_id") -> DataFrame:
    """The first ``limit`` filings, numbered; every task keeps its first ones, so no row is sorted in vain."""
    return number_rows(df.orderBy(*_filing_order()).limit(limit), _filing_order(), id_col)[0]


def enrich_filings(
    df: DataFrame,
    providers: TextProviders | None = None,
    min_len: int = 100,
    limit: int | None = None,
    ids: bool = True,
    run_ts: Column | None = None,
    stored_text: str | None = None,
    originals: bool = True,
) -> DataFrame:
    """Filter, number, summarise, score, label and classify filings.

    With the built-in providers every text step is an expression on the row, computed on
    the scan.  ``ids=False`` leaves out the numbering, ``originals=False`` the whole text.

    ``stored_text`` names the parquet column that ``filing_text`` shows, where ``df`` selects
    and filters a parquet scan.  Then texts are in no shuffle: the short rows of results
    carry the address of their row, are stored once, numbered, and originals are fetched by
    address at the end; with a ``limit`` the first rows are chosen by key alone and only their
    texts are read.  Without it texts travel with the rows that are numbered.
    """
    if limit is not None and not ids:
        raise ValueError("a limit needs the filing order, so ids cannot be left out")
    kept, steps = nonempty_filings(df, min_len), (providers or TextProviders()).columns("filing_text")
    late = stored_text is not None and ids
    shown = ["cik", "company_name", "form_type", "filing_date"]
    if late:
        rows = with_address(kept)
        if limit is None:
            rows = rows.withColumns(steps)
        wanted = [*dict.fromkeys([*FILING_KEY, *shown]), *(steps if limit is None else []), FILE, PLACE]
        rows = rows.select(*wanted)
        if limit is None:
            # A sort reads its input twice, for the ranges and for the rows; the text steps run once.
            rows = replace_table(rows, scratch_path(rows.sparkSession, "enriched"))
        done = bounded_docs(rows, limit) if limit is not None else assign_ids(rows, unique_key=False)
        if limit is not None:
            done = fetch_by_address(done, stored_text, "filing_text").withColumns(steps)
        elif originals:
            done = fetch_by_address(done, stored_text, "filing_text")
    else:
        if limit is not None:
            kept = bounded_docs(kept, limit)
        elif ids:
            kept = assign_ids(kept)
        done = kept.withColumns(steps)
    return done.select(
        *(["filing_id"] if ids else []),
        *shown,
        *([F.col("filing_text").alias("original_text")] if originals else []),
        "ai_summary",
        sentiment_label(F.col("sentiment_score")).alias("sentiment"),
        "sentiment_score",
        "classification",
        (F.current_timestamp() if run_ts is None else run_ts).cast("timestamp_ntz").alias("processed_at"),
    )


def _apply(df: DataFrame, col: str, out: str, provider: Provider, chars: int | None) -> DataFrame:
    return df.withColumn(out, provider(capped(F.col(col), chars)))


def summarize(
    df: DataFrame,
    col: str,
    out: str = "ai_summary",
    provider: Provider | None = None,
    chars: int | None = None,
) -> DataFrame:
    return _apply(df, col, out, provider or extractive_summary(), chars)


def sentiment(
    df: DataFrame,
    col: str,
    out: str = "sentiment_score",
    provider: Provider | None = None,
    chars: int | None = None,
) -> DataFrame:
    return _apply(df, col, out, provider or lexicon_sentiment(), chars)


def classify(
    df: DataFrame,
    col: str,
    out: str = "classification",
    provider: Provider | None = None,
    chars: int | None = None,
) -> DataFrame:
    return _apply(df, col, out, provider or rule_classifier(), chars)


def sentiment_by_join(df: DataFrame, col: str, id_col: str, lexicon: DataFrame) -> DataFrame:
    """(``id_col``, sentiment_score) for a lexicon table (term, weight) of any size.

    Words are counted inside each row, joined to the lexicon, and summed per text on the
    map side, so one short row per text is shuffled for the sum.  Spark broadcasts a
    lexicon that is small by its own size check; otherwise its adaptive join splits a
    word common to many texts.
    """
    words = F.sort_array(F.split(F.lower(col), r"[^a-z]+"))
    counted = df.select(id_col, F.inline(run_lengths(words))).withColumnRenamed("value", "term")
    weight = F.col("weight") * F.col("n")
    hits = (
        counted.join(lexicon.select("term", "weight"), "term")
        .groupBy(id_col)
        .agg(F.sum(weight).alias("_net"), F.sum(F.abs(weight)).alias("_all"))
    )
    return df.select(id_col).join(hits, id_col, "left").select(
        id_col, F.coalesce(F.try_divide("_net", "_all"), F.lit(0.0)).alias("sentiment_score")
    )


def extract_entities(
    df: DataFrame,
    col: str,
    out: str = "entities",
    provider: Provider | None = None,
    chars: int | None = None,
    min_len: int = 200,
) -> DataFrame:
    """Entities of the texts longer than ``min_len`` characters as a struct of arrays."""
    return df.where(F.length(col) > min_len).withColumn(
        out, (provider or pattern_entities())(capped(F.col(col), chars))
    )


def text_keys(df: DataFrame, text: str = "filing_text") -> DataFrame:
    """``df`` with the hash and length of its text and the address of its row in place of the text, stored.

    For a frame that only selects and filters a parquet scan.  Texts are read once for it;
    what is unseen is then found among short rows.
    """
    size = F.octet_length(F.col(text)).alias("_size")
    keys = with_address(df.select("*", text_key(F.col(text)).alias("text_hash"), size)).drop(text)
    return replace_table(keys, scratch_path(df.sparkSession, "keys"))


def new_results(
    df: DataFrame,
    cache: DataFrame | None,
    providers: TextProviders,
    text: str = "filing_text",
    id_col: str = "cik",
    tasks: int | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Results for the distinct texts that the cache does not hold, keyed by text hash.

    Copies of a text are reduced to the copy with the smallest ``id_col`` (a unique
    column) on hashes and ids alone, so a text repeated any number of times is read by
    the providers once.  ``tasks`` spreads slow external calls.  With ``keys``, rows of
    ``text_keys(df)``, only texts of these rows count; those that lack a result are picked
    on the scan, and they alone are shuffled, to as many tasks as they fill.
    """
    texts = _unseen_texts(df, cache, text, id_col, tasks, keys)
    return texts.select("text_hash", *[c.alias(n) for n, c in providers.columns(text).items()])


def _unseen_texts(
    df: DataFrame, cache: DataFrame | None, text: str, id_col: str, tasks: int | None, keys: DataFrame | None = None
) -> DataFrame:
    hashed = df.withColumn("text_hash", text_key(F.col(text))) if keys is None else keys
    wanted = hashed.groupBy("text_hash").agg(F.min(id_col).alias(id_col))
    if cache is not None:
        wanted = unseen(wanted, cache, "text_hash")
    texts = hashed.join(wanted, ["text_hash", id_col], "left_semi")
    if keys is None:
        texts = texts.select("text_hash", text)
    else:
        spark = df.sparkSession
        marks = replace_table(mark_rows(texts, F.sum("_size").alias("_size")), scratch_path(spark, "marks"))
        if tasks is None:
            tasks = _tasks_for(spark, marks.agg(F.sum("_size")).first()[0] or 0)
        texts = marked_rows(df.select(text), marks).select(text_key(F.col(text)).alias("text_hash"), text)
    return texts if tasks is None else texts.repartition(tasks, "text_hash")


def _tasks_for(spark: SparkSession, size: int) -> int:
    """Tasks for texts of ``size`` bytes: a few for each core, so that none runs alone at the end, but no tiny ones."""
    few = min(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, size // LEAST_TASK_BYTES)
    return max(1, few, size // MOST_TASK_BYTES)


def call_and_store(
    df: DataFrame,
    path: str,
    call: Provider,
    text: str = "filing_text",
    id_col: str = "cik",
    tasks: int | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Call ``call`` (see ``external_calls``) for every text without a stored reply, and store what came.

    A text is called once however many rows hold it; null texts are not called.  A run
    that is stopped, or some of whose calls failed, is repeated by calling this again:
    only texts without a reply are called.  ``keys`` is as in ``new_results``.  Returns (text_hash, reply, error, attempts),
    one row per text: its reply, or the error of its latest run.
    """
    spark = df.sparkSession
    kept = spark.read.parquet(path) if exists(spark, path) else None
    run = 0 if kept is None else 1 + (kept.agg(F.max("run")).first()[0] or 0)
    done = kept.where("error is null") if kept is not None else None
    texts = _unseen_texts(df.where(F.col(text).isNotNull()), done, text, id_col, tasks, keys)
    made = texts.select("text_hash", call(F.col(text)).alias("_made")).select("text_hash", "_made.*", F.lit(run).alias("run"))
    made.write.mode("append").parquet(path)
    rank = F.struct(F.col("error").isNull(), F.col("run"))
    latest = F.max_by(F.struct("reply", "error", "attempts"), rank).alias("_made")
    return spark.read.parquet(path).groupBy("text_hash").agg(latest).select("text_hash", "_made.*")


def attach_results(df: DataFrame, cache: DataFrame, text: str = "filing_text") -> DataFrame:
    """Join cached results to every row by text hash.

    The cache has one row per hash; Spark's adaptive join splits the rows of a hash
    that holds many copies.  Rows of ``text_keys`` have their hash, so no text is read.
    """
    hashed = df if "text_hash" in df.columns else df.withColumn("text_hash", text_key(F.col(text)))
    return hashed.join(cache.select("text_hash", *RESULTS), "text_hash", "left")

"""Mixing sources to target weights by capped water-filling.

Sources share a budget of words by weight.  A source is clamped at a maximum number
of epochs, and what it cannot take is shared again by weight until none is above its
clamp.  A source is then taken as whole repetitions of all its documents plus a
fractional one: the documents that come first in a seeded order, up to the point
nearest to the target.

The plan has one row per source.  It is found from sums alone: the fraction's end is
located by sums of fine slices of the seeded order, and only the slice in which a
source's target falls is ordered row by row.  Applying the plan joins it to the
documents, so texts are not shuffled where the plan is small, and a source that holds
a third of all rows is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import stored
from fathomline.operators.ranks import number_rows

WORD = r"[^\x20\x09-\x0D]+"
#: Leading hexadecimal digits of the seeded order that make a slice: 4096 slices per source.
SLICE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_order(doc_id: Column, text: Column, seed: int) -> Column:
    """A hexadecimal key that orders documents at random, the same in every run."""
    known = F.coalesce(doc_id.cast("string"), F.lit("null"))
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.md5(F.concat(F.lit(f"{seed}:"), known, F.lit(":"), own).cast("binary"))


def sizes(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0) -> DataFrame:
    """One short row per document: id, source, size in words and place in the seeded order."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        seeded_order(F.col(doc_id), F.col(text), seed).alias("place"),
    )


def _level(sources: DataFrame, budget: float) -> float:
    """Words per unit of weight at which the clamped shares use up the budget."""
    level = 0.0
    while True:
        full = F.col("most") < F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0)).alias("clamped"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0)).alias("free"),
        ).first()
        if not row["free"]:
            return level
        raised = (budget - row["clamped"]) / row["free"]
        # Clamping only raises the level, so a full source stays full and this ends.
        if raised <= level:
            return level
        level = raised


def mix_plan(
    rows: DataFrame, weights: tuple[float, ...] = (5, 2, 1), percent: int = 150, epochs: int = 2
) -> DataFrame:
    """One row per source: ``source_size``, ``target``, ``whole`` and ``cutoff``.

    ``rows`` come from :func:`sizes` and are read several times.  Sources in order of
    code points, null last, take ``weights`` in turn.  A document is taken ``whole``
    times, and once more if its ``place`` is at most ``cutoff``.
    """
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked, _ = number_rows(per_source, [F.col("source").asc_nulls_last()], "rank", first=0)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stored(
        ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * epochs).cast("double").alias("most")),
        "sources",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = _level(sources, total * percent / 100) if total else 0.0
    target = F.least(F.col("weight") * F.lit(level), F.col("most"))
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0).cast("int")
    goals = sources.select("source", "source_size", target.alias("target"), whole.alias("whole"))
    goals = goals.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))

    piece = F.substring("place", 1, SLICE_DIGITS)
    slices = rows.groupBy("source", piece.alias("piece")).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("piece")
    slices = slices.withColumn("before", F.sum("words").over(running) - F.col("words"))
    met = slices.alias("s").join(goals.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")))
    met = met.select("s.source", "piece", "before", "words", "extra")
    end = F.col("before") + F.col("words")
    full = met.filter(end <= F.col("extra")).groupBy("source").agg(F.concat(F.max("piece"), F.lit("g")).alias("full"))
    crossing = met.filter((F.col("before") < F.col("extra")) & (end > F.col("extra")))

    inside = rows.withColumn("piece", piece).alias("r").join(
        crossing.alias("c"), F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.piece") == F.col("c.piece"))
    )
    inside = inside.groupBy("r.source", "place", "before", "extra").agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("place"))
    ends = F.col("before") + upto
    near = 2 * ends - F.col("size") <= 2 * F.col("extra")
    cut = inside.withColumn("near", near).filter("near").groupBy("source").agg(F.max("place").alias("cut"))

    goals = goals.join(full.withColumnRenamed("source", "full_source"), F.col("source").eqNullSafe(F.col("full_source")), "left")
    goals = goals.join(cut.withColumnRenamed("source", "cut_source"), F.col("source").eqNullSafe(F.col("cut_source")), "left")
    plan = goals.select(
        "source", "source_size", "target", "whole", F.coalesce("cut", "full", F.lit("")).alias("cutoff")
    )
    return stored(plan, "mix-plan")


def _times() -> Column:
    return F.col("plan.whole") + (F.col("place") <= F.col("plan.cutoff")).cast("int")


def taken_words(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of :func:`sizes`."""
    joined = rows.join(plan.alias("plan"), rows["source"].eqNullSafe(F.col("plan.source")))
    return joined.select(
        "doc_id", "size", "plan.source_size", "plan.target", (F.col("size") * _times()).cast("long").alias("taken")
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = (5, 2, 1),
    percent: int = 150,
    epochs: int = 2,
    seed: int = 0,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    A null text or one without words has size 0 and is repeated like the rest of its
    source.  Null sources are one source, ranked last.  Rows that repeat an id and
    its text share one place in the seeded order and are taken together.  Column names of ``docs``
    may be any.  An empty table gives an empty mix.
    """
    plan = mix_plan(stored(sizes(docs, doc_id, source, text, seed), "mix-sizes"), weights, percent, epochs)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(source).alias("_source"),
        seeded_order(F.col(doc_id), F.col(text), seed).alias("place"),
    )
    joined = rows.join(plan.alias("plan"), F.col("_source").eqNullSafe(F.col("plan.source")))
    repeated = joined.withColumn("_n", _times()).filter("_n > 0").select("_row", F.explode(F.sequence(F.lit(1), "_n")))
    return repeated.select("_row.*")


ORACLE = """
WITH d AS (
  SELECT doc_id, source, md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS place,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS r
  FROM d GROUP BY source
), w AS (
  SELECT source, source_size, CAST(2 * source_size AS DOUBLE) AS most,
         CAST(CASE r % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight
  FROM s
), k AS (
  SELECT *, coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS clamped,
         sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         1.5 * sum(source_size) OVER () AS budget
  FROM w WINDOW o AS (ORDER BY most / weight, source)
), l AS (
  SELECT coalesce(max((budget - clamped) / free), 0) AS level FROM k
), g AS (
  SELECT source, source_size, least(weight * level, most) AS target,
         CASE WHEN source_size > 0 THEN floor(least(weight * level, most) / source_size) ELSE 0 END AS whole
  FROM w, l
), p AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS extra,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.place) AS own
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN 2 * upto - own <= 2 * extra THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""

"""Incremental ingest, incremental enrichment and calendar counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fathomline.operators.dates import zoned
from fathomline.operators.merge import conform, one_per_key
from fathomline.schemas import RUN_LOG
from fathomline.sources.tables import exists, merge_into

# A week bucket of 7 days counted from the epoch (a Thursday) starts on Monday with this offset.
WEEK_START = "4 days"


def run_available(stream: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process everything that has arrived since the last run, then stop."""
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each_batch)
        .start()
    )
    query.awaitTermination()
    return query


def query_id(batch: DataFrame) -> str:
    """Identity of the query that runs a micro-batch; it is kept in the checkpoint, so a new one is another query."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("not inside a micro-batch of a stream")
    return found


def stream_upsert(
    stream: DataFrame,
    table_path: str,
    keys: list[str],
    order: str,
    partition: str,
    schema: T.StructType,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame]] = lambda batch: batch,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Upsert each micro-batch into a partitioned table; replaying a batch changes nothing.

    ``prepare`` returns the rows, or the rows and the rejected ones.  Rejects are kept
    below ``rejects_path``, in a folder per query and batch that a replay replaces; a
    checkpoint made anew at the same path is another query.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        made = prepare(batch)
        rows, rejects = made if isinstance(made, tuple) else (made, None)
        if rejects_path and rejects is not None:
            rejects.write.mode("overwrite").parquet(f"{rejects_path}/run={query_id(batch)}/batch={batch_id}")
        merge_into(rows, table_path, keys, order, partition, schema)

    return run_available(stream, checkpoint, each)


def stream_new_filings(
    stream: DataFrame,
    keys: list[str],
    order: str,
    partition: str,
    table_path: str,
    checkpoint: str,
    process: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    """Process every filing key once, whatever its age, and insert the results.

    The table itself says which keys are done, so no state is kept and nothing is too
    late.  Of rows with one key in a batch the first by ``order`` counts.  ``process``
    keeps ``keys`` and adds the column ``partition``, which must follow from them.  A
    replayed batch finds its keys done.
    """

    def each(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = one_per_key(batch, keys, order, latest=False)
        if exists(spark, table_path):
            fresh = fresh.join(spark.read.parquet(table_path).select(*keys), keys, "left_anti").select(*batch.columns)
        made = process(fresh)
        merge_into(made, table_path, keys, keys[0], partition, made.schema, update=False)

    return run_available(stream, checkpoint, each)


def calendar_bucket(ts: str, every: str) -> Column:
    """Day or week (from Monday) window of a timestamp."""
    if every == "day":
        return F.window(ts, "1 day")
    if every == "week":
        return F.window(ts, "7 days", startTime=WEEK_START)
    raise ValueError("every is 'day' or 'week'")


def bucket_counts(df: DataFrame, ts: str, by: str, every: str, value: str | None = None) -> DataFrame:
    """Rows (and the sum of ``value``) per bucket and ``by``; works on batches and streams.

    A bucket is a day of the time as written; zoned timestamps count by their UTC day.
    """
    measures = [F.count("*").alias("n")]
    if value:
        measures.append(F.sum(value).alias("total"))
    grouped = df.groupBy(calendar_bucket(ts, every).alias("_w"), by).agg(*measures)
    start = F.col("_w.start")
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        start = F.to_utc_timestamp(start, F.current_timezone())
    return grouped.select(F.to_date(start).alias(every), *[c for c in grouped.columns if c != "_w"])


def _add_counts(stored: DataFrame, batch: DataFrame, keys: list[str], _: str) -> DataFrame:
    """Stored counts plus those of a batch; a bucket that has the batch of that query stays as it is."""
    new = conform(batch, stored)
    names = [c for c in stored.columns if c not in keys]
    both = stored.select(*keys, F.struct(*names).alias("_old")).join(
        new.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*names).alias("_new")),
        reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "full",
    )
    given, came = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    run = F.map_keys("_new.batches")[0]
    known = F.coalesce(F.col("_old.batches")[run] >= F.col("_new.batches")[run], F.lit(False))
    made = {"month": F.coalesce("_old.month", "_new.month")}
    made["batches"] = F.when(~came | known, F.col("_old.batches")).otherwise(
        F.map_concat(
            F.map_filter(F.coalesce("_old.batches", F.create_map().cast("map<string,bigint>")), lambda k, _: k != run),
            F.col("_new.batches"),
        )
    )
    for name in names:
        if name not in made:
            old, more = F.col(f"_old.{name}"), F.when(~known, F.col(f"_new.{name}"))
            # A sum of nothing but nulls is null, as in one aggregation over all events.
            made[name] = F.when(old.isNull(), more).when(more.isNull(), old).otherwise(old + more)
    found = both.select(*[F.when(given, F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys], *[v.alias(k) for k, v in made.items()])
    return conform(found, stored)


_DAY = 86_400_000_000
_BATCHES = T.MapType(T.StringType(), T.LongType())
BUCKET_DAYS = {"day": 1, "week": 7}


def _closes(every: str, lateness: dt.timedelta) -> Column:
    """The event time, in microseconds, from which a bucket is final."""
    size = F.unix_date(every).cast("bigint") + BUCKET_DAYS[every]
    return size * _DAY + lateness // dt.timedelta(microseconds=1)


def _progress(spark: SparkSession, table_path: str) -> DataFrame | None:
    """One row per query that writes the table: its last batch, and the latest event time before and after it."""
    path = f"{table_path.rstrip('/')}_progress"
    return spark.read.schema("run string, batch bigint, before bigint, after bigint").parquet(path) if exists(spark, path) else None


def bucket_status(spark: SparkSession, table_path: str, every: str, lateness: dt.timedelta) -> DataFrame:
    """The counts with ``final``: whether an event has come that is later than the bucket's end by ``lateness``."""
    seen = _progress(spark, table_path)
    latest = seen.agg(F.max("after")).first()[0] if seen is not None else None
    return spark.read.parquet(table_path).withColumn("final", F.coalesce(F.lit(latest) >= _closes(every, lateness), F.lit(False)))


def stream_counts(
    stream: DataFrame,
    ts: str,
    by: str,
    every: str,
    lateness: dt.timedelta,
    table_path: str,
    checkpoint: str,
    value: str | None = None,
) -> StreamingQuery:
    """Keep a table of calendar counts up to date, whatever the age of an event.

    Each batch is counted by itself and added into the stored buckets.  A bucket carries,
    per query, the number of the last batch that changed it, so a replayed batch is not
    added twice and any number of queries may write one table, one at a time.

    A bucket is final once an event is later than its end by ``lateness`` or more
    (``bucket_status``).  Events that come for a bucket that was final before their batch
    are counted too, and their counts are also kept as corrections at ``table_path`` +
    ``_corrections``, in a folder per query and batch that a replay replaces.  Events
    without a time are in no bucket.
    """
    month = F.date_format(every, "yyyy-MM")
    base = table_path.rstrip("/")

    def each(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, query_id(batch)
        events = zoned(batch, ts, ts)
        seen = _progress(spark, table_path)
        rows = seen.collect() if seen is not None else []  # one per query
        own = next((r for r in rows if r["run"] == run), None)
        if own and own["batch"] >= batch_id:
            before = own["before"]
        else:
            before = max((r["after"] for r in rows if r["after"] is not None), default=None)
        newest = events.agg(F.max(F.unix_micros(ts))).first()[0]
        after = max((x for x in (before, newest) if x is not None), default=None)
        note = spark.createDataFrame([(batch_id, before, after)], "batch bigint, before bigint, after bigint")
        note.coalesce(1).write.mode("overwrite").parquet(f"{base}_progress/run={run}")

        counts = bucket_counts(events, ts, by, every, value)
        late = counts.where(_closes(every, lateness) <= F.lit(before).cast("bigint"))
        late.write.mode("overwrite").parquet(f"{base}_corrections/run={run}/batch={batch_id}")
        stamp = F.create_map(F.lit(run), F.lit(batch_id).cast("bigint"))
        stamped = counts.select("*", month.alias("month"), stamp.alias("batches"))
        schema = T.StructType([f if f.name != "batches" else T.StructField("batches", _BATCHES) for f in stamped.schema])
        merge_into(stamped, table_path, [every, by], "batches", "month", schema, merge=_add_counts)

    return run_available(stream, checkpoint, each)


def log_run(spark: SparkSession, path: str, name: str, job: Callable[[], None]) -> None:
    """Run ``job`` and append one row about it to the run log, also when it fails."""
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    state, code, message = "SUCCEEDED", None, None
    try:
        job()
    except Exception as error:
        state, code, message = "FAILED", type(error).__name__, str(error)
        raise
    finally:
        ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = [(name, state, started, ended, code, message)]
        spark.createDataFrame(row, RUN_LOG).write.mode("append").parquet(path)


def run_log_recent(log: DataFrame, names: list[str], k: int = 10, tie: str | None = None) -> DataFrame:
    """The ``k`` newest runs of the given jobs."""
    order = [F.desc_nulls_last("scheduled_time"), *([tie] if tie else ["name"])]
    return log.where(F.col("name").isin(names)).orderBy(*order).limit(k)

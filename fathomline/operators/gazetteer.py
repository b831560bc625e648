"""Names of a list of any size in texts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.functions.arrays import let
from fathomline.runtime import shared_root

#: A token is a run of letters and digits, or a run of other characters but white space.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
#: The key filter has about this many bits per name, in words of 64, and at most MOST_WORDS words (32 MB).
FILTER_BITS = 16
MOST_WORDS = 1 << 22
#: Words of the filter in one broadcast row.
ROW_WORDS = 64
#: Bytes of text per length of names, and names, whose runs meet in one task.
JOIN_BYTES = 1 << 24
JOIN_NAMES = 1 << 18


def tokens(text: Column, ignore_case: bool = False) -> Column:
    return F.regexp_extract_all(F.lower(text) if ignore_case else text, F.lit(TOKEN), F.lit(0))


def _keys(names: DataFrame, name: str, ignore_case: bool) -> DataFrame:
    """(key, n, name) per distinct token sequence; of names with equal tokens the smallest."""
    parts = names.select(F.col(name).alias("name"), tokens(F.col(name), ignore_case).alias("parts"))
    keyed = parts.where(F.size("parts") > 0).select("name", F.array_join("parts", " ").alias("key"), F.size("parts").alias("n"))
    return keyed.groupBy("key", "n").agg(F.min("name").alias("name"))


def token_runs(parts: Column, n: Column) -> Column:
    """Every run of ``n`` tokens with the number of its first one."""
    starts = F.when(F.size(parts) >= n, F.sequence(F.lit(1), F.size(parts) - n + 1))
    return F.transform(
        starts,
        lambda i: F.struct((i - 1).alias("start"), F.array_join(F.slice(parts, i, n), " ").alias("key")),
    )


def _bits(key: Column, words: int) -> tuple[Column, Column, Column]:
    """Row, word in the row and the two bits of a key in a filter of ``words`` words, a power of two."""
    code = F.xxhash64(key)
    word = F.shiftrightunsigned(code, 64 - (words.bit_length() - 1))

    def bit(at: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))

    both = bit(code).bitwiseOR(bit(F.shiftright(code, 6)))
    return F.call_function("div", word, F.lit(ROW_WORDS)), (word % ROW_WORDS).cast("int"), both


def _filter(keys: DataFrame, words: int) -> DataFrame:
    """(row, bits): the rows of the filter that have a bit, each with all its words."""
    row, word, bits = _bits(F.col("key"), words)
    set_words = keys.groupBy(row.alias("row"), word.alias("word")).agg(F.bit_or(bits).alias("bits"))
    by_word = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    every = F.sequence(F.lit(0), F.lit(ROW_WORDS - 1))
    return set_words.groupBy("row").agg(
        F.transform(every, lambda i: F.coalesce(F.element_at(by_word, i), F.lit(0).cast("long"))).alias("bits")
    )


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _leftmost(starts: pa.Array, sizes: pa.Array) -> pa.Array:
    """Places of the spans that stay, of spans in order of start, longest first."""
    kept = []
    for firsts, lengths in zip(starts, sizes):
        end, own = 0, []
        for place, (first, length) in enumerate(zip(firsts.as_py(), lengths.as_py())):
            if first >= end:
                own.append(place)
                end = first + length
        kept.append(own)
    return pa.array(kept, pa.list_(pa.int32()))


def _first(key: str, n: Column) -> Column:
    """The first ``n`` tokens of a run; no token holds a space."""
    return F.call_function("substring_index", F.col(key), F.lit(" "), n)


def _likely(texts: DataFrame, bits: DataFrame, lengths: list[int], words: int) -> DataFrame:
    """(id, start, n, key): at every start the longest run that the filter does not rule out.

    Of names with one start only the longest can stay, so no shorter one is sent along with it.
    """
    if not lengths:
        return texts.select("id", *[F.lit(None).cast(t).alias(c) for c, t in (("start", "int"), ("n", "int"), ("key", "string"))]).limit(0)
    size, least, most = F.size("parts"), lengths[0], lengths[-1]
    starts = F.when(size >= least, F.sequence(F.lit(1), size - least + 1))
    runs = F.transform(
        starts,
        lambda i: F.struct(
            (i - 1).alias("start"),
            F.least(size - i + 1, F.lit(most)).alias("has"),
            F.array_join(F.slice("parts", i, most), " ").alias("run"),
        ),
    )
    rows = texts.select("id", F.inline(runs))
    rows = rows.withColumn("n", F.lit(None).cast("int"))
    for n in lengths:
        row, word, both = _bits(_first("run", F.lit(n)), words)
        rows = rows.withColumns({"row": F.when(F.col("has") >= n, row), "word": word, "both": both}).join(F.broadcast(bits), "row", "left")
        hit = F.get("bits", F.col("word")).bitwiseAND(F.col("both")) == F.col("both")
        rows = rows.select("id", "start", "has", "run", F.when(hit, F.lit(n)).otherwise(F.col("n")).alias("n"))
    made = rows.where(F.col("n").isNotNull()).select("id", "start", "n", _first("run", F.col("n")).alias("key"))
    return made.where(F.col("key").isNotNull())


def _found(df: DataFrame, names: DataFrame, id_col: str, text: str, name: str, ignore_case: bool, every: bool) -> DataFrame:
    """(id, spans, copies): the names found per id, in order.

    With ``every`` there is a row for each id of ``df``, and ``copies`` counts its rows.
    """
    spark = names.sparkSession
    shared_root(spark)
    keys = _keys(names, name, ignore_case).checkpoint()
    counts = {row["n"]: row["count"] for row in keys.groupBy("n").count().collect()}
    lengths, listed = sorted(counts), sum(counts.values())
    words = min(MOST_WORDS, max(ROW_WORDS * 2, 1 << (listed * FILTER_BITS // 64).bit_length()))
    size = df.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    # As many tasks as the texts and the list fill, so that none has to spill what it sorts.
    tasks = 1 + size * len(lengths) // JOIN_BYTES + listed // JOIN_NAMES
    likely = _likely(df.select(F.col(id_col).alias("id"), tokens(F.col(text), ignore_case).alias("parts")), _filter(keys, words), lengths, words)
    known = keys.select("key", "name").repartition(tasks, "key")
    placed = likely.repartition(tasks, "key")
    found = placed.join(known, "key").select("id", "start", "n", "name")
    if len(lengths) > 1:
        # Where the filter let in a run that is no name, the shorter ones at its start are looked up.
        # The outer forms let no filter and no join sink below the shuffle, so both joins read one.
        missed = placed.join(known, "key", "left").where(F.col("name").isNull())
        less = F.explode_outer(F.filter(F.array(*map(F.lit, lengths)), lambda m: m < F.col("n")))
        shorter = missed.select("id", "start", "key", less.alias("n")).select("id", "start", "n", _first("key", F.col("n")).alias("key"))
        listed_short = shorter.repartition(tasks, "key").join(known, "key").select("id", "start", "n", "name")
        found = found.unionByName(listed_short)
    if every:
        none = F.lit(None)
        ids = df.select(F.col(id_col).alias("id"), none.cast("int").alias("start"), none.cast("int").alias("n"), none.cast("string").alias("name"))
        found = found.unionByName(ids)
    span = F.struct("start", (-F.col("n")).alias("less"), "n", "name")
    lists = found.repartition(tasks, "id").groupBy("id").agg(
        F.sort_array(F.collect_list(F.when(F.col("start").isNotNull(), span))).alias("spans"),
        F.count_if(F.col("start").isNull()).cast("int").alias("copies"),
    )
    kept = lists.select("id", "spans", "copies", _leftmost(F.col("spans.start"), F.col("spans.n")).alias("places"))
    return kept.select("id", F.transform("places", lambda p: F.get("spans", p)).alias("spans"), "copies")


def find_names(
    df: DataFrame, names: DataFrame, id_col: str, text: str, name: str = "name", ignore_case: bool = False
) -> DataFrame:
    """(``id_col``, ``start``, ``n``, ``name``) of every name found; ``start`` counts tokens from 0.

    A name is found where all its tokens follow each other, whatever space is between them.  Names
    found do not overlap: the leftmost stays, of those with one start the longest.  ``id_col``
    must be unique.  Null texts and names, and names without a token, find nothing; names of equal
    tokens count as the smallest of them.

    Runs of tokens are tested on the scan against a filter of the keys that grows with the
    list up to a fixed size, so little more than what is found is shuffled, and no text.  The
    list itself is joined, and broadcast only if Spark finds it small enough; the driver reads
    the distinct numbers of tokens of names and the size of the texts.
    """
    found = _found(df, names, id_col, text, name, ignore_case, every=False)
    return found.select(F.col("id").alias(id_col), F.inline("spans")).drop("less")


def name_lists(
    df: DataFrame, names: DataFrame, id_col: str, text: str, out: str = "names", name: str = "name", ignore_case: bool = False
) -> DataFrame:
    """(``id_col``, ``out``) for every row of ``df``: its distinct names in order; none, or no id: empty.

    The rows of ``df`` meet the names found where these are put in order, so neither is shuffled again.
    """
    found = _found(df, names, id_col, text, name, ignore_case, every=True)
    listed = F.when(F.col("id").isNotNull(), F.array_sort(F.array_distinct(F.col("spans.name"))))
    listed = F.coalesce(listed, F.array().cast("array<string>"))
    return found.select(F.col("id").alias(id_col), F.explode(F.array_repeat(listed, F.col("copies"))).alias(out))

"""Ranked lexical search over a length-stratified index.

Documents of equal length normaliser m form a stratum.  Inside a stratum a term's
postings lie by term frequency, so the impact of a term on a document depends on the
list alone and is computed once per (term, frequency), not once per document.  A
stratum's bound for an item is the sum of its terms' impacts at their largest
frequency there; strata are visited from the largest bound down, and those whose
bound is below the score of the tenth best document so far are not visited.

The index covers every document and every term; items come in blocks of a bounded
number of terms and are the only thing that is broadcast.  Terms are compared as
64-bit hashes (see ``words``).

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII,
with A-Z lower-cased.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import signed, slices, stored
from fathomline.llm.words import batch_bytes, spans, word_hashes

#: Terms (with repeats) of a stratum that are indexed together; a larger stratum has several blocks.
BLOCK_TERMS = 1 << 20
#: Terms of an index partition.
PARTITION_TERMS = 1 << 22
#: (item, term) pairs that are searched together.
QUERY_PAIRS = 1 << 20

_GAP = np.zeros(256, dtype=bool)
_GAP[:128] = [not chr(b).isalnum() for b in range(128)]

BLOCK = (
    "m long, piece int, docs array<long>, terms array<long>, tfs array<int>, ends array<int>, members array<int>"
)


def text_terms(texts: pa.Array):
    """Yield (terms per text, hashes of all terms) for parts of a string array; a null has none."""
    for raw, offsets in batch_bytes(texts):
        begin, finish, counts = spans(raw, np.diff(offsets), _GAP)
        yield counts, word_hashes(raw, begin, finish)


def _grouped(owner: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, term) in order, and how often each occurs."""
    order = np.lexsort((terms, owner))
    owner, terms = owner[order], terms[order]
    first = np.ones(len(terms), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (terms[1:] != terms[:-1])
    at = np.flatnonzero(first)
    return owner[at], terms[at], np.diff(np.append(at, len(terms)))


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def impact(tf, m):
    """Share of a term's weight, in millionths; integers."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass(frozen=True)
class LexicalIndex:
    """Stored blocks of strata; ``documents`` have a term, ``total`` counts their terms."""

    blocks: DataFrame
    documents: int
    total: int


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LexicalIndex:
    """Index every row of ``docs`` that has a term.

    Rows without a term (null, empty, punctuation) are in no stratum.  Repeated rows and
    rows without an id are documents of their own.  Other columns are ignored.  The
    driver reads one row per distinct document length.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def lengths(batches):
        for batch in slices(batches):
            for counts, _ in text_terms(batch.column(0)):
                n, rows = np.unique(counts[counts > 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(rows, pa.int64())], ["n", "rows"])

    found = rows.select("text").mapInArrow(lengths, "n long, rows long").groupBy("n").agg(F.sum("rows").alias("rows")).collect()
    documents = sum(r["rows"] for r in found)
    total = sum(r["n"] * r["rows"] for r in found)
    held: dict[int, int] = {}
    for r in found:
        m = 10 + 90 * r["n"] * documents // total
        held[m] = held.get(m, 0) + r["n"] * r["rows"]
    pieces = {m: -(-terms // BLOCK_TERMS) for m, terms in held.items() if terms > BLOCK_TERMS}

    def postings(batches):
        for batch in slices(batches):
            ids, row = batch.column(0), 0
            for counts, hashes in text_terms(batch.column(1)):
                owner, terms, tfs = _grouped(np.repeat(np.arange(len(counts)), counts), hashes)
                kept = np.flatnonzero(counts)
                m = 10 + 90 * counts[kept].astype(np.int64) * documents // total
                own = ids.slice(row, len(counts)).take(pa.array(kept))
                # By place, not by id: copies of one id spread too.
                parts = np.array([pieces.get(s, 1) for s in m.tolist()], np.int64)
                piece = (np.arange(len(kept)) + row) % np.maximum(parts, 1)
                distinct = np.bincount(owner, minlength=len(counts))[kept]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(m, pa.int64()),
                        pa.array(piece, pa.int32()),
                        own,
                        _lists(distinct, signed(terms)),
                        _lists(distinct, pa.array(tfs, pa.int32())),
                    ],
                    ["m", "piece", "doc_id", "terms", "tfs"],
                )
                row += len(counts)

    def block(key, held):
        docs = pa.concat_arrays([h[0] for h in held])
        owner = np.repeat(np.arange(len(docs)), np.concatenate([h[1] for h in held]))
        terms, tfs = (np.concatenate([h[i] for h in held]) for i in (2, 3))
        order = np.lexsort((owner, tfs, terms))
        terms, tfs = terms[order], tfs[order]
        last = np.ones(len(terms), dtype=bool)
        last[:-1] = (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1])
        ends = np.flatnonzero(last)
        columns = [docs, signed(terms[ends]), pa.array(tfs[ends]), pa.array((ends + 1).astype(np.int32)), pa.array(owner[order].astype(np.int32))]
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int32()), *[_lists([len(c)], c) for c in columns]],
            ["m", "piece", "docs", "terms", "tfs", "ends", "members"],
        )

    def strata(batches):
        key, held = None, []
        for batch in batches:
            m, piece = (batch.column(i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero((m[1:] != m[:-1]) | (piece[1:] != piece[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                if key != (m[a], piece[a]):
                    if held:
                        yield block(key, held)
                    key, held = (m[a], piece[a]), []
                terms, tfs = batch.column(3).slice(a, b - a), batch.column(4).slice(a, b - a)
                held.append(
                    (batch.column(2).slice(a, b - a), terms.value_lengths().to_numpy(), terms.flatten().to_numpy().view(np.uint64), tfs.flatten().to_numpy())
                )
        if held:
            yield block(key, held)

    wanted = max(1, -(-total // PARTITION_TERMS))
    dealt = rows.mapInArrow(postings, "m long, piece int, doc_id long, terms array<long>, tfs array<int>")
    placed = dealt.repartition(wanted, "m", "piece").sortWithinPartitions("m", "piece")
    return LexicalIndex(stored(placed.mapInArrow(strata, BLOCK), "lexical-index"), documents, total)


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, term hash); rows that repeat an item id are one item with the terms of all."""

    def read(batches):
        for batch in slices(batches):
            row = 0
            for counts, hashes in text_terms(batch.column(1)):
                owner, terms, _ = _grouped(np.repeat(np.arange(len(counts)), counts), hashes)
                ids = batch.column(0).slice(row, len(counts)).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([ids, signed(terms)], ["item_id", "term"])
                row += len(counts)

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text))
    return rows.mapInArrow(read, "item_id long, term long").distinct()


class _Items:
    """A block of items: (item, term) pairs in item order, and the distinct terms with their weights."""

    def __init__(self, ids: list, owner: np.ndarray, terms: np.ndarray):
        self.ids = ids
        self.terms, self.term = np.unique(terms, return_inverse=True)
        order = np.argsort(owner, kind="stable")
        self.term = self.term[order]
        self.start = np.searchsorted(owner[order], np.arange(len(ids) + 1))
        self.weight = np.zeros(len(self.terms), np.int64)

    def of(self, item: int) -> np.ndarray:
        return self.term[self.start[item] : self.start[item + 1]]


class _Block:
    """One row of the index as arrays."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        def column(i):
            return batch.column(i)[row].values

        self.m = batch.column(0)[row].as_py()
        self.docs = column(2)
        self.terms = column(3).to_numpy().view(np.uint64)
        self.tfs, ends = column(4).to_numpy().astype(np.int64), column(5).to_numpy()
        self.members = column(6).to_numpy()
        self.starts = np.concatenate([[0], ends])

    def ranges(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last list of every wanted term."""
        return np.searchsorted(self.terms, wanted, "left"), np.searchsorted(self.terms, wanted, "right")


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... count[0] of them, then the same for the next."""
    before = np.cumsum(count) - count
    return np.arange(count.sum()) + np.repeat(first - before, count)


def _visit(block: _Block, low: np.ndarray, high: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Scores of all documents of the block."""
    lists = _spread(low, high - low)
    tf = block.tfs[lists]
    gained = np.repeat(weight, high - low) * impact(tf, block.m)
    sizes = block.starts[lists + 1] - block.starts[lists]
    members = block.members[_spread(block.starts[lists], sizes)]
    scores = np.zeros(len(block.docs), np.int64)
    np.add.at(scores, members, np.repeat(gained, sizes))
    return scores


def _last_null(doc_id: int | None) -> tuple[bool, int]:
    return doc_id is None, doc_id or 0


def _search(items: _Items, top: int):
    def search(batches):
        best: list[list] = [[] for _ in items.ids]
        for batch in batches:
            blocks = [_Block(batch, row) for row in range(batch.num_rows)]
            spots, bounds = [], []
            for one in blocks:
                low, high = one.ranges(items.terms)
                most = np.where(high > low, impact(one.tfs[high - 1], one.m), 0) * items.weight
                spots.append((low, high))
                bounds.append(np.add.reduceat(most[items.term], items.start[:-1]))
            bounds = np.array(bounds)
            for item in range(len(items.ids)):
                own, held = items.of(item), best[item]
                for b in np.argsort(-bounds[:, item], kind="stable"):
                    bound, least = bounds[b, item], -held[-1][0] if len(held) == top else 1
                    if bound < least:
                        break
                    low, high = spots[b][0][own], spots[b][1][own]
                    scores = _visit(blocks[b], low, high, items.weight[own])
                    if len(scores) > top:
                        least = max(least, np.partition(scores, -top)[-top])
                    found = np.flatnonzero(scores >= least)
                    ids = blocks[b].docs.take(pa.array(found)).to_pylist()
                    new = [(-s, *_last_null(i), i) for s, i in zip(scores[found].tolist(), ids)]
                    held[:] = sorted(held + new, key=lambda x: x[:3])[:top]
        item, doc_id, score = [], [], []
        for own, held in enumerate(best):
            for less, _, _, one in held:
                item.append(items.ids[own])
                doc_id.append(one)
                score.append(-less)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (item, doc_id, score)], ["item_id", "doc_id", "score"])

    return search


def _frequencies(terms: np.ndarray):
    def count(batches):
        held = np.zeros(len(terms), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                one = _Block(batch, row)
                low, high = one.ranges(terms)
                held += one.starts[high] - one.starts[low]
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(held[seen], pa.int64())], ["term", "df"])

    return count


def _ranked(index: LexicalIndex, pairs: list, top: int) -> DataFrame:
    spark = index.blocks.sparkSession
    ids = sorted({r["item_id"] for r in pairs}, key=_last_null)
    place = {one: i for i, one in enumerate(ids)}
    owner = np.fromiter((place[r["item_id"]] for r in pairs), np.int64, len(pairs))
    items = _Items(ids, owner, np.fromiter((r["term"] for r in pairs), np.int64, len(pairs)).view(np.uint64))
    counted = index.blocks.mapInArrow(_frequencies(items.terms), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in counted.collect():
        items.weight[row["term"]] = math.floor(1000 * math.log((2 * index.documents + 2) / (2 * row["df"] + 1)))
    shared = spark.sparkContext.broadcast(items)

    def search(batches):
        yield from _search(shared.value, top)(batches)

    # Every task keeps its best; groups of tasks first, so no item gathers a row set that grows with the tasks.
    found = index.blocks.mapInArrow(search, "item_id long, doc_id long, score long").withColumn("_group", F.spark_partition_id() % 64)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    near = found.withColumn("_n", F.row_number().over(Window.partitionBy("item_id", "_group").orderBy(*order))).filter(F.col("_n") <= top)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(
        F.col("rank") <= top
    ).select("item_id", "rank", "doc_id", "score")


def search(index: LexicalIndex, items: DataFrame, top: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item with a score above 0.

    Equal scores are in order of the document's id, those without an id last.  Items
    without a term, or with terms that no document holds, have no row.  An empty index
    or table of items gives none.
    """
    pairs = item_terms(items, item_id, text)
    pairs = stored(pairs, "lexical-items")
    count = pairs.count()
    if not count or not index.documents:
        return items.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    blocks = -(-count // QUERY_PAIRS)
    if blocks == 1:
        return _ranked(index, pairs.collect(), top)
    dealt = pairs.withColumn("_block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = []
    for block in range(blocks):
        own = dealt.filter(F.col("_block") == block).collect()
        if own:
            found.append(stored(_ranked(index, own, top), "lexical-found"))
    return reduce(DataFrame.union, found)


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """Index ``docs`` and search all ``items``."""
    return search(build_index(docs), items, top)


#: The same ranking from joined postings.
ORACLE = r"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tfs AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
norms AS (SELECT doc_id, 10 + (90 * n * docs) // terms AS m FROM lengths, totals),
weights AS (
  SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs, totals GROUP BY term
),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN tfs USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id
),
ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

"""Exact Jaccard self-join of word-shingle sets with set-relation skipping.

Prefix postings make inverted lists over shingles, rare shingles first.  Two
relations between sets save work on them:

* index level: equal sets post once, and sets that are already known to be similar
  to a leader share one entry per list.  A list is kept in order of set size and
  read in blocks; a block whose sizes or positions rule out the required overlap
  is skipped as a whole.  Entries of longer lists carry parity bits of their set, and
  pairs that these rule out are not written.  Of the other pairs of longer lists only
  those are written that hold together what all of them do, so their number grows with
  the entries, not with the square of a list.
* answer level: the overlap of a set with every follower of a leader is derived from
  its overlap with the leader by the few shingles in which follower and leader differ.

Every pair of sets that reaches the threshold is found and counted.  Written out are
the links that join two groups, which is enough for components, and for each set the
number of rows it links with; the pairs themselves, whose number grows with the square
of a group, are not.

Shingles are compared as 64-bit hashes of their words (see ``words``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import hand_back, signed, slices, stored
from fathomline.llm.components import components
from fathomline.llm.words import mix, shingle_sets

#: Counters of the shingle-frequency table: a fixed size, whatever the corpus.
COUNTERS = 1 << 19
_SLICES = 64
#: Entries of one inverted list compared in one task; longer lists are split over tasks.
LIST_PART = 2048
#: Entries of a list that are skipped or compared together.
LIST_BLOCK = 32
#: Shingles of the sets that are compared in one place.
CHUNK_SHINGLES = 1 << 20
#: Entries of lists longer than this carry parity bits.
LIST_SHORT = 16
#: Most bits of the filter of ids whose texts are wanted.
FILTER_BITS = 1 << 25


def _sizes(sets: list[np.ndarray]) -> np.ndarray:
    return np.fromiter(map(len, sets), np.int64, len(sets))


def _in_slices(total: np.ndarray) -> pa.RecordBatch:
    parts = total.reshape(_SLICES, -1)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(_SLICES), pa.int32()), pa.array([s.tobytes() for s in parts], pa.binary())], ["slice", "part"]
    )


def _gathered(df: DataFrame, count, kind: str, merge: np.ufunc) -> np.ndarray:
    """The merged arrays of all tasks; a task sends its own in slices, each merged as a stream."""

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(part, kind)
                totals[place] = merge(totals[place], part) if place in totals else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())],
            ["slice", "part"],
        )

    form = "slice int, part binary"
    rows = df.mapInArrow(count, form).repartition("slice").mapInArrow(add, form).collect()
    return np.concatenate([np.frombuffer(r["part"], kind) for r in sorted(rows, key=lambda r: r["slice"])] or [np.zeros(0, kind)])


def shingle_classes(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """Frequency class of every counter: 0 for ordinary ones, more as it stands out more.

    All documents are counted; what reaches the driver has ``COUNTERS`` numbers.  A
    counter is judged by its distance from the median in usual spreads: the spread of
    what many rare shingles add up to grows with the root of the corpus only, so frequent
    shingles stand out in a large one too.
    """

    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches):
            sets = shingle_sets(batch.column(0), width)
            if sets:
                slots = (np.concatenate(sets) & np.uint64(COUNTERS - 1)).astype(np.int64)
                total += np.bincount(slots, minlength=COUNTERS)
        yield _in_slices(total.astype("<i8"))

    counts = _gathered(docs.select(text), count, "<i8", np.add)
    if not len(counts):
        return np.zeros(COUNTERS, np.uint8)
    low, usual = np.quantile(counts, [0.16, 0.5])
    spreads = (counts - usual) / max(1.0, usual - low)
    return np.floor(2 * np.log2(np.maximum(1, spreads))).astype(np.uint8)


def _places(ids: np.ndarray, size: int) -> np.ndarray:
    """Two bits of the filter for every id."""
    mixed = mix(np.ascontiguousarray(ids).view(np.uint64))
    return (np.concatenate([mixed, mixed >> np.uint64(32)]) & np.uint64(size - 1)).astype(np.int64)


def _id_filter(ids: DataFrame) -> np.ndarray:
    """Bits that are set for every id of ``ids`` and for few others, 16 per id up to ``FILTER_BITS``."""
    size = min(FILTER_BITS, max(1 << 13, 1 << (16 * ids.count()).bit_length()))

    def mark(batches):
        bits = np.zeros(size, bool)
        for batch in batches:
            bits[_places(batch.column(0).to_numpy(zero_copy_only=False), size)] = True
        yield _in_slices(np.packbits(bits, bitorder="little"))

    found = _gathered(ids, mark, "u1", np.bitwise_or)
    return found if len(found) else np.zeros(size // 8, np.uint8)


def _passing(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    place = _places(ids, 8 * len(bits)).reshape(2, -1)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).all(axis=0)


def _parity_bits(own: np.ndarray) -> bytes:
    """Parity of the set's hashes in about two bits per element; folds by XOR."""
    size = max(64, 1 << int(2 * len(own) - 1).bit_length()) if len(own) else 64
    odd = np.bincount((own >> np.uint64(20) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def _narrow(bits: bytes) -> bytes:
    """Half the parity bits, for the entries of long lists."""
    return _fold(np.frombuffer(bits, np.uint8), len(bits) // 2).tobytes() if len(bits) > 8 else bits


class _Marks:
    """Parity bits of the entries of some lists; entries without bits are null, or empty in a longer list."""

    def __init__(self, column: pa.ChunkedArray):
        self.given = column.is_valid().to_numpy()
        self.rows = [np.frombuffer(x, np.uint8) if x else None for x in column.to_pylist()]
        self.length = np.fromiter((0 if x is None else len(x) for x in self.rows), np.int64, len(self.rows))
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _folded(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Where an entry is in a table of bits of one width, and the table."""
        if width not in self.tables:
            # Sizes of a pair that may link are near each other, so are the lengths of their bits.
            owners = np.flatnonzero((self.length >= width) & (self.length <= 4 * width))
            place = np.full(len(self.rows), -1)
            place[owners] = np.arange(len(owners))
            self.tables[width] = place, np.stack([_fold(self.rows[i], width) for i in owners])
        return self.tables[width]

    def allow(self, x: np.ndarray, y: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Whether the bits of two entries differ in no more than ``room`` places."""
        out = np.ones(len(x), bool)
        short, long = np.minimum(self.length[x], self.length[y]), np.maximum(self.length[x], self.length[y])
        short[long > 4 * short] = 0
        for width in np.unique(short[short > 0]):
            at = np.flatnonzero(short == width)
            place, table = self._folded(int(width))
            for piece in np.array_split(at, -(-len(at) * int(width) // (1 << 22))):
                apart = np.bitwise_count(table[place[x[piece]]] ^ table[place[y[piece]]]).sum(axis=1, dtype=np.int64)
                out[piece] = apart <= room[piece]
        return out


def _key_columns(sets: list[np.ndarray]) -> list[pa.Array]:
    """Size and two sums of every set; together they name the set."""
    mixed = [mix(s) for s in sets]
    first = [m.sum(dtype=np.uint64) for m in mixed]
    second = [np.bitwise_xor.reduce(mix(m + np.uint64(11))) if len(m) else np.uint64(0) for m in mixed]
    return [pa.array(_sizes(sets), pa.int64()), signed(np.array(first, np.uint64)), signed(np.array(second, np.uint64))]


def set_keys(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """One short row per document: set size, set identity, a minimum and parity bits, also in half as many."""

    def read(batches):
        for batch in slices(batches):
            sets = shingle_sets(batch.column(1), width)
            bits = [_parity_bits(s) for s in sets]
            least = [mix(s).min() if len(s) else np.uint64(0) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *_key_columns(sets),
                    signed(np.array(least, np.uint64)),
                    pa.array(bits, pa.binary()),
                    pa.array(map(_narrow, bits), pa.binary()),
                ],
                ["id", "n", "key1", "key2", "least", "bits", "mark"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(read, "id long, n long, key1 long, key2 long, least long, bits binary, mark binary")


def _postings(docs: DataFrame, doc_id: str, text: str, width: int, percent: int, classes) -> DataFrame:
    """(token, id, n, rest) for the prefix of every set; rest: elements after this one."""

    def read(batches):
        table = classes.value
        for batch in slices(batches):
            sets = shingle_sets(batch.column(1), width)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            tokens, rests = [], []
            lengths = np.zeros(len(sets), np.int64)
            for i, own in enumerate(sets):
                if n := len(own):
                    length = lengths[i] = n - -(-percent * n // 100) + 1
                    kind = table[(own & np.uint64(COUNTERS - 1)).astype(np.int64)]
                    if kind.any():
                        own = own[np.argsort(kind, kind="stable")]
                    tokens.append(own[:length])
                    rests.append(np.arange(n - 1, n - 1 - length, -1))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(np.concatenate(tokens)),
                        pa.array(np.repeat(ids, lengths), pa.int64()),
                        pa.array(np.repeat(_sizes(sets), lengths), pa.int32()),
                        pa.array(np.concatenate(rests), pa.int32()),
                    ],
                    ["token", "id", "n", "rest"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null")
    return rows.mapInArrow(read, "token long, id long, n int, rest int")


def _possible(lo_a, hi_a, rest_a, lo_b, hi_b, rest_b, percent: int):
    """Whether sizes and positions allow the overlap, for a pair met at its first common shingle."""
    fits = (hi_a * 100 >= percent * lo_b) & (hi_b * 100 >= percent * lo_a)
    return fits & ((1 + np.minimum(rest_a, rest_b)) * (100 + percent) >= percent * (lo_a + lo_b))


def _list_pairs(starts: np.ndarray, own, lo, hi, rest, far, marks: _Marks, cross: np.ndarray, percent: int, news):
    """Index pairs of entries of the same list that may be similar.

    ``starts``: first entry of every list and the end.  Entries are in order of
    ``lo``.  ``cross``: the list holds two parts, only pairs across them count.
    ``far``: how far sets of the entry are from the set of its bits.  ``news``: tells
    which pairs the caller can still use; others are left out.
    """

    def near(x, y, ok):
        x, y = x[ok], y[ok]
        ok = news(x, y)
        x, y = x[ok], y[ok]
        ok = marks.allow(x, y, (hi[x] + hi[y]) * (100 - percent) // (100 + percent) + far[x] + far[y])
        return x[ok], y[ok]

    ends = np.repeat(starts[1:], np.diff(starts))
    lengths = np.repeat(np.diff(starts), np.diff(starts))
    short = lengths <= 2 * LIST_BLOCK
    left = np.flatnonzero(short)
    step = 1
    while len(left):
        left = left[left + step < ends[left]]
        # Later entries are larger still: an entry too small for this one is done.
        left = left[hi[left] * 100 >= percent * lo[left + step]]
        right = left + step
        ok = _possible(lo[left], hi[left], rest[left], lo[right], hi[right], rest[right], percent)
        ok &= ~cross[left] | (own[left] != own[right])
        yield near(left, right, ok)
        step += 1
    for start, end in zip(starts[:-1], starts[1:]):
        if end - start <= 2 * LIST_BLOCK:
            continue
        edges = np.arange(start, end, LIST_BLOCK)
        low, high = np.minimum.reduceat(lo[:end], edges), np.maximum.reduceat(hi[:end], edges)
        after = np.maximum.reduceat(rest[:end], edges)
        for k, at in enumerate(edges):
            open_ = np.flatnonzero(_possible(low[k], high[k], after[k], low[k:], high[k:], after[k:], percent)) + k
            a = np.arange(at, min(at + LIST_BLOCK, end))
            for j in open_:
                b = np.arange(edges[j], min(edges[j] + LIST_BLOCK, end))
                x, y = np.repeat(a, len(b)), np.tile(b, len(a))
                ok = (x < y) & _possible(lo[x], hi[x], rest[x], lo[y], hi[y], rest[y], percent)
                ok &= ~cross[x] | (own[x] != own[y])
                yield near(x, y, ok)


def _split_lists(cells: DataFrame) -> DataFrame:
    """Bring each list together in order of size; long ones as pairs of parts.  ``c``: no less than the list's length."""
    counted = cells.withColumn("parts", F.ceil(F.col("c") / LIST_PART).cast("int"))
    counted = counted.withColumn("own", F.pmod(F.xxhash64("grp"), F.col("parts")).cast("int"))
    dealt = counted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))
    wanted = ["token", "a", "b", "own", "grp", "lo", "hi", "rest", "far", "mark"]
    return dealt.repartition("token", "a", "b").sortWithinPartitions("token", "a", "b", "lo", "grp").select(*wanted)


def _whole_lists(batches):
    """Batches cut so that no list is divided."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
        last = np.flatnonzero((keys != keys[:, -1:]).any(axis=0))
        cut = int(last[-1]) + 1 if len(last) else 0
        if held:
            first = keys[:, 0]
            tail = [held[-1].column(i)[-1].as_py() for i in range(3)]
            if list(first) != tail:
                yield pa.Table.from_batches(held)
                held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


class _Lists:
    """A run of whole lists: which group every entry belongs to, and the pairs that may be similar."""

    def __init__(self, rows: pa.Table, percent: int):
        cols = {n: rows.column(n).to_numpy().astype(np.int64) for n in rows.column_names if n != "mark"}
        change = (np.diff(np.stack([cols["token"], cols["a"], cols["b"]]), axis=1) != 0).any(axis=0)
        self.starts = np.concatenate([[0], np.flatnonzero(change) + 1, [rows.num_rows]])
        self.values = [cols[n] for n in ("own", "lo", "hi", "rest", "far")]
        self.cross = cols["a"] != cols["b"]
        self.marks = _Marks(rows.column("mark"))
        self.groups, self.at = np.unique(cols["grp"], return_inverse=True)
        self.percent = percent

    def pairs(self, news):
        """Places in ``groups`` of pairs for which ``news`` holds, and whether bits were given for them."""

        def asked(x, y):
            return news(self.at[x], self.at[y])

        for x, y in _list_pairs(self.starts, *self.values, self.marks, self.cross, self.percent, asked):
            if len(x):
                yield self.at[x], self.at[y], self.marks.given[x]


def _partnered(cells: DataFrame, percent: int) -> DataFrame:
    """Groups with at least one possible partner in some list."""

    def read(batches):
        for rows in _whole_lists(batches):
            lists = _Lists(rows, percent)
            found = np.zeros(len(lists.groups), bool)
            for x, y, _ in lists.pairs(lambda x, y: ~(found[x] & found[y])):
                found[x] = found[y] = True
            yield pa.RecordBatch.from_arrays([pa.array(lists.groups[found], pa.int64())], ["id"])
        hand_back()

    return _split_lists(cells).mapInArrow(read, "id long").distinct()


def _joining(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of pairs that are enough to join what all pairs join; ``label`` is brought up to date."""
    chosen, left = [np.zeros(0, np.int64)], np.arange(len(x))
    while True:
        a, b = label[x[left]], label[y[left]]
        apart = a != b
        if not apart.any():
            return np.concatenate(chosen)
        left, low = left[apart], np.minimum(a, b)[apart]
        high, first = np.unique(np.maximum(a, b)[apart], return_index=True)
        chosen.append(left[first])
        above = np.arange(len(label))
        above[high] = low[first]
        while (above != above[above]).any():
            above = above[above]
        label[:] = above[label]


def _group_pairs(cells: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups that may hold a link: (probe, block, sure), the probe group the smaller id.

    Pairs of a list with bits have passed their test and are sure.  Of these only the ones
    are written that join groups which others of the same run have not joined, fewer than
    the run has groups; whatever is held together by all of them still is.  Lists without
    bits are short, and all their pairs that are not joined yet are written.
    """

    def read(batches):
        for run in _whole_lists(batches):
            lists = _Lists(run, percent)
            label = np.arange(len(lists.groups))
            written = [np.zeros((0, 3), np.int64)]
            for x, y, sure in lists.pairs(lambda x, y: label[x] != label[y]):
                rows = np.stack([np.minimum(x, y), np.maximum(x, y), sure], axis=1)
                written += [rows[~sure], rows[sure][_joining(label, x[sure], y[sure])]]
            three = np.unique(np.concatenate(written), axis=0)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(lists.groups[three[:, i]], pa.int64()) for i in range(2)], pa.array(three[:, 2] == 1)],
                ["probe", "block", "sure"],
            )
        hand_back()

    return _split_lists(cells).mapInArrow(read, "probe long, block long, sure boolean").distinct()


def _linked(overlap, a, b, percent: int):
    return overlap * 100 >= percent * (a + b - overlap)


def _bits_allow(percent: int):
    """Whether two groups can hold a link, by their leaders' parity bits.

    Bits of two sets differ in no more places than the sets do.  A link allows its two
    sets to differ by a share of their sizes, and each lies within its group's radius
    of the leader, so leaders that differ by more than the sum rule the pair out.
    """

    @F.arrow_udf("boolean")
    def allow(a: pa.Array, most_a: pa.Array, far_a: pa.Array, b: pa.Array, most_b: pa.Array, far_b: pa.Array) -> pa.Array:
        out = np.ones(len(a), bool)
        size = (numbers(most_a) + numbers(most_b)) * (100 - percent) // (100 + percent)
        room = size + numbers(far_a) + numbers(far_b)
        for i, (x, y) in enumerate(zip(a, b)):
            if x.is_valid and y.is_valid:
                x, y = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
                width = min(len(x), len(y))
                out[i] = np.bitwise_count(_fold(x, width) ^ _fold(y, width)).sum() <= room[i]
        return pa.array(out)

    def numbers(column: pa.Array) -> np.ndarray:
        return column.to_numpy(zero_copy_only=False).astype(np.int64)

    return allow


def _set_texts(docs: DataFrame, sets: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """(id, key1, text): one text for every set of ``sets``, from the row that holds it.

    Rows are tested on the scan against a filter of the ids, so other texts are not shuffled.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(_id_filter(sets.select("id")))

    def read(batches):
        for batch in slices(batches):
            batch = batch.filter(pa.array(_passing(wanted.value, batch.column(0).to_numpy(zero_copy_only=False))))
            keys = _key_columns(shingle_sets(batch.column(1), width))
            yield pa.RecordBatch.from_arrays([batch.column(0), *keys, batch.column(1)], ["id", "n", "key1", "key2", "text"])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null")
    keyed = rows.mapInArrow(read, "id long, n long, key1 long, key2 long, text string")
    found = keyed.join(sets.select("id", "n", "key1", "key2", "rows"), ["id", "n", "key1", "key2"])
    found = stored(found.select("id", "key1", "rows", "text"), "set-texts")
    # Only a set of several rows can meet its id twice.
    once = found.filter("rows > 1").groupBy("id", "key1").agg(F.first("text").alias("text"))
    return found.filter("rows = 1").select("id", "key1", "text").union(stored(once, "copied-texts"))


def _followers(docs: DataFrame, live: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """(id, leader, apart): sets that share their minimum with a smaller id and are similar to it.

    ``apart``: shingles that one has and the other has not.
    """
    keys = live.select("id", "key1", "least")
    firsts = keys.groupBy("least").agg(F.min(F.struct("id", "key1")).alias("first"), F.count("*").alias("c"))
    firsts = firsts.filter("c > 1").select("least", F.col("first.id").alias("leader"), F.col("first.key1").alias("key"))
    pairs = keys.join(firsts, "least").filter("id != leader or key1 != key").select("id", "key1", "leader", "key")
    pairs = stored(pairs, "same-least")
    needed = pairs.select("id", "key1").union(pairs.select("leader", "key")).distinct()
    texts = _set_texts(docs, live.join(needed, ["id", "key1"], "left_semi"), doc_id, text, width)

    @F.arrow_udf("int")
    def apart(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for part in slices([pa.RecordBatch.from_arrays([a, b], ["a", "b"])]):
            left = shingle_sets(part.column(0), width)
            codes = part.column(1).dictionary_encode()
            right = shingle_sets(codes.dictionary, width)
            for x, code in zip(left, codes.indices.to_pylist()):
                y = right[code]
                shared = len(np.intersect1d(x, y, assume_unique=True))
                out.append(len(x) + len(y) - 2 * shared if _linked(shared, len(x), len(y), percent) else None)
        return pa.array(out, pa.int32())

    joined = pairs.join(texts.toDF("id", "key1", "t"), ["id", "key1"]).join(texts.toDF("leader", "key", "u"), ["leader", "key"])
    return joined.select("id", "leader", apart("t", "u").alias("apart")).filter("apart is not null")


class _Index:
    """Overlaps of a probe with many sets at once.

    A set is held as its base and the shingles in which it differs from that, so the
    overlap with it is derived from the overlap with the base.
    """

    def __init__(self):
        self.bases: list[np.ndarray] = []
        self.base_of: list[int] = []
        self.sizes: list[int] = []
        self.groups: list[int] = []
        self.rows: list[int] = []
        self.lost: list[np.ndarray] = []
        self.new: list[np.ndarray] = []

    def add(self, own: np.ndarray, group: int, rows: int, base: int | None) -> None:
        if base is None:
            base = len(self.bases)
            self.bases.append(own)
        whole = self.bases[base]
        self.base_of.append(base)
        self.sizes.append(len(own))
        self.groups.append(group)
        self.rows.append(rows)
        self.lost.append(np.setdiff1d(whole, own, assume_unique=True) if whole is not own else own[:0])
        self.new.append(np.setdiff1d(own, whole, assume_unique=True) if whole is not own else own[:0])

    def close(self) -> None:
        self.size, self.group, self.base = map(np.array, (self.sizes, self.groups, self.base_of))
        self.weight = np.array(self.rows, np.int64)
        self.lists = [_inverted(x) for x in (self.bases, self.lost, self.new)]

    def linked(self, probe: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
        """Groups that hold a set linked with the probe, and the rows of all such sets."""
        base, lost, new = (_hits(one, probe) for one in self.lists)
        overlap = base[self.base] - lost + new
        hit = _linked(overlap, len(probe), self.size, percent)
        return np.unique(self.group[hit]), int(self.weight[hit].sum())


def _inverted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(tokens)
    return tokens[order], owner[order], len(sets)


def _hits(inverted: tuple[np.ndarray, np.ndarray, int], probe: np.ndarray) -> np.ndarray:
    """How many shingles of the probe each set has."""
    tokens, owner, sets = inverted
    if not len(tokens):
        return np.zeros(sets, np.int64)
    low, high = np.searchsorted(tokens, probe, "left"), np.searchsorted(tokens, probe, "right")
    count = high - low
    place = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
    return np.bincount(owner[place], minlength=sets)


class _Merges:
    """Union of groups; says which links join two that were apart."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def _root(self, x: int) -> int:
        while (up := self.above.get(x, x)) != x:
            self.above[x] = self.above.get(up, up)
            x = up
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self._root(a), self._root(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)
        return a != b


def _family_links(
    docs: DataFrame, pairs: DataFrame, groups: DataFrame, live: DataFrame, doc_id: str, text: str, width: int, percent: int
) -> DataFrame:
    """Links between groups, and for every set the number of rows of other sets it links with.

    A family is what the possible pairs hold together, or a group of several sets by
    itself.  Its sets are dealt into chunks of bounded size; every set of the family is
    compared with every chunk.  A chunk reports (id, leader) for links that join groups
    it had not joined yet, and (id, key1, linked) for every set that links with others.
    """
    family = components(pairs, "probe", "block").select(F.col("node").alias("grp"), F.col("component").alias("family"))
    sets = groups.join(family, "grp", "left").filter("family is not null or members > 1")
    sets = sets.select("id", "grp", F.coalesce("family", "grp").alias("family"))
    sets = sets.join(live.select("id", "key1", "rows", "n"), "id")
    weight = sets.groupBy("family").agg(F.ceil(F.sum("n") / CHUNK_SHINGLES).cast("int").alias("chunks"))
    sets = sets.join(weight, "family").withColumn("chunk", F.pmod(F.xxhash64("id", "key1"), F.col("chunks")).cast("int"))
    sets = stored(sets.select("family", "chunk", "chunks", "id", "key1", "rows", "grp"), "families")
    members = sets.select("family", "chunk", F.lit(1).alias("kind"), "id", "key1", "rows", "grp")
    heads = live.groupBy(F.col("id").alias("grp")).agg(F.min("key1").alias("key1"))
    leaders = sets.filter("id != grp").select("family", "chunk", "grp").distinct().join(heads, "grp")
    leaders = leaders.select(
        "family", "chunk", F.lit(0).alias("kind"), F.col("grp").alias("id"), "key1", F.lit(0).cast("long").alias("rows"), "grp"
    )
    others = (
        sets.filter("chunks > 1")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .filter("other != chunk")
        .select("family", F.col("other").alias("chunk"), F.lit(2).alias("kind"), "id", "key1", "rows", "grp")
    )
    rows = leaders.union(members).union(others)
    needed = sets.select("id", "key1").union(leaders.select("id", "key1")).distinct()
    texts = _set_texts(docs, live.join(needed, ["id", "key1"], "left_semi"), doc_id, text, width)
    rows = rows.join(texts, ["id", "key1"])
    rows = rows.select("family", "chunk", "kind", "id", "key1", "rows", "grp", "text")
    rows = rows.repartition("family", "chunk").sortWithinPartitions("family", "chunk", "kind", "grp", "id", "key1")

    def read(batches):
        at, index, bases, members, merges = None, _Index(), {}, [], _Merges()
        found: list[tuple[int, int | None, int | None, int | None]] = []

        def probe(own, one, key, grp, itself):
            near, linked = index.linked(own, percent)
            found.extend((grp, int(g), None, None) for g in near if merges.join(grp, int(g)))
            if linked > itself:
                found.append((one, None, key, linked - itself))

        def close():
            """All members are in: from now on sets are compared."""
            index.close()
            for member in members:
                probe(*member)
            members.clear()

        for batch in slices(batches):
            where = [batch.column(i).to_pylist() for i in range(7)]
            for f, c, kind, one, key, count, grp, own in zip(*where, shingle_sets(batch.column(7), width)):
                if (f, c) != at:
                    if members:
                        close()
                    at, index, bases, merges = (f, c), _Index(), {}, _Merges()
                if kind == 0:
                    bases[grp] = len(index.bases)
                    index.bases.append(own)
                elif kind == 1:
                    index.add(own, grp, count, bases.get(grp))
                    members.append((own, one, key, grp, count))
                elif index.groups:
                    if members:
                        close()
                    probe(own, one, key, grp, 0)
            yield _found(found)
            found.clear()
        if members:
            close()
        yield _found(found)

    return rows.mapInArrow(read, "id long, leader long, key1 long, linked long")


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], ["id", "leader", "key1", "linked"]
    )


def similar_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``n_links`` and ``component_id``.

    Two documents link when ``100 * |A and B| >= percent * |A or B|`` for their sets
    of distinct ``width``-word shingles; ``component_id`` is the smallest id that a
    document reaches by links, itself included.  ``n_links`` is the number of other
    rows, copies included, that the row links with.

    A null or wordless text has an empty set and links with nothing.  A text of
    fewer than ``width`` words has one shingle.  A null id keeps its size, gets a null
    component and links with nothing.  Rows that repeat an id are one node; each gets
    a row with the links of its own text.  An empty table gives an empty result; other columns are ignored.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    spark = docs.sparkSession
    keys = stored(set_keys(docs, doc_id, text, width), "set-keys")
    usable = keys.filter("id is not null and n > 0")
    # Equal sets are one set, held by its smallest id; minimum and bits belong to the set.
    reps = usable.groupBy("n", "key1", "key2").agg(
        F.min("id").alias("rep"), F.count("*").alias("rows"), F.first("least").alias("least"),
        *[F.first(b).alias(b) for b in ("bits", "mark")],
    )
    copies = usable.join(reps.select("n", "key1", "key2", "rep"), ["n", "key1", "key2"])
    copies = copies.filter("id != rep").select("id", F.col("rep").alias("leader"))
    reps = reps.withColumnRenamed("rep", "id")

    classes = spark.sparkContext.broadcast(shingle_classes(docs, text, width))
    posted = _postings(docs, doc_id, text, width, percent, classes)
    length = F.count("*").over(Window.partitionBy("token"))
    met = posted.withColumn("c", length).filter("c > 1")
    # An id that repeats with other words has several sets; bits of its group then decide nothing.
    marks = reps.groupBy("id").agg(F.when(F.count("*") == 1, F.first("mark")).alias("mark"))
    lists = met.join(marks, "id").withColumn("mark", F.when(F.col("c") > LIST_SHORT, F.col("mark")))
    lists = lists.withColumn("c", length).filter("c > 1").withColumn("mark", F.when(F.col("c") > LIST_SHORT, F.col("mark")))
    lists = stored(lists.select("token", "id", "n", "rest", "c", "mark"), "lists")

    alone = lists.select(
        "token", F.col("id").alias("grp"), F.col("n").alias("lo"), F.col("n").alias("hi"), "rest",
        "c", F.lit(0).alias("far"), "mark",
    )
    active = stored(_partnered(alone, percent), "active")
    live = stored(reps.join(active, "id", "left_semi"), "live")
    follow = stored(_followers(docs, live, doc_id, text, width, percent), "followers")
    nodes = live.groupBy("id").agg(
        F.max("n").alias("n"), F.count("*").alias("sets"), F.first("bits").alias("bits")
    )
    grouped = nodes.join(follow.groupBy("id").agg(F.min("leader").alias("leader")), "id", "left")
    grouped = grouped.select("id", "n", "sets", F.coalesce("leader", "id").alias("grp"))
    sizes = grouped.groupBy("grp").agg(F.sum("sets").alias("members"), (F.max("sets") > 1).alias("several"))
    groups = stored(grouped.join(sizes, "grp").select("id", "grp", "members", "n", "several"), "groups")

    radius = follow.groupBy(F.col("leader").alias("grp")).agg(F.max("apart").alias("far"))
    about = groups.groupBy("grp").agg(F.max("n").alias("most"), F.max("several").alias("several"))
    about = about.join(radius, "grp", "left").join(
        nodes.select(F.col("id").alias("grp"), "bits", "sets"), "grp", "left"
    )
    sure = ~F.col("several") & (F.col("sets") == 1)
    about = about.select(
        "grp", F.when(sure, F.col("bits")).alias("bits"), "most", F.coalesce("far", F.lit(0)).alias("far")
    )
    about = stored(about, "about")
    placed = stored(groups.join(about, "grp").select("id", "grp", "far", F.coalesce("bits", F.lit(b"")).alias("mark")), "placed")
    cells = (
        lists.select("token", "id", "n", "rest", "c")
        .join(placed, "id")
        .groupBy("token", "grp", "c", "far")
        .agg(
            F.min("n").alias("lo"),
            F.max("n").alias("hi"),
            F.max("rest").alias("rest"),
            F.first(F.when(F.col("c") > LIST_SHORT, F.col("mark"))).alias("mark"),
        )
    )
    pairs = stored(_group_pairs(cells, percent), "pairs")
    sides = about.select("grp", "bits", "most", "far")
    tested = (
        pairs.filter("not sure")
        .join(sides.toDF("probe", "bits_a", "most_a", "far_a"), "probe")
        .join(sides.toDF("block", "bits_b", "most_b", "far_b"), "block")
        .filter(_bits_allow(percent)("bits_a", "most_a", "far_a", "bits_b", "most_b", "far_b"))
        .select("probe", "block")
    )
    possible = stored(pairs.filter("sure").select("probe", "block").union(tested), "possible")
    links = stored(_family_links(docs, possible, groups, live, doc_id, text, width, percent), "links")
    edges = copies.union(follow.select("id", "leader")).union(links.filter("leader is not null").select("id", "leader"))
    found = components(edges, "id", "leader").withColumnRenamed("node", "id")
    linked = links.filter("linked is not null").groupBy("id", "key1").agg(F.sum("linked").alias("linked"))
    counts = reps.join(linked, ["id", "key1"], "left").select(
        "n", "key1", "key2", (F.col("rows") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    )
    rows = keys.join(found, "id", "left").join(counts.filter("n_links > 0"), ["n", "key1", "key2"], "left")
    return rows.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )

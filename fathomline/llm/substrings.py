"""Removal of word sequences that occur earlier, by suffix automata of shards.

Two operators share one automaton.

``remove_repeats`` compares a table with itself.  The documents of a scan task come in
shards of about ``SHARD_WORDS``.  A shard's text is its own reference: its documents go
through the growing automaton in order of their ids, and the matching statistic of a
word (the longest sequence that ends there and occurred before) marks the windows that
the shard has seen.  Only a window's first occurrence in its shard is exchanged, so a
passage that a third of all documents hold sends one row per shard; of the shards'
first occurrences the smallest stays.  Shards are not broadcast to one another: their
number grows with the table.

``remove_reference`` compares a table with a reference of bounded size: the automata of
its shards are broadcast one after the other and all documents stream through them.

Words that cannot matter are kept out of the automata: a window's rarest-looking group of
``GROUP`` words (its smallest hash) occurs at least twice wherever the window does, so
groups are counted first and only windows whose group repeats are candidates.  The
repeated groups travel as a bit table of fixed size; a wrong bit costs work, not results.

Words are runs of bytes other than space and U+0009 to U+000D, compared as 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import signed, slices
from fathomline.llm.words import _powers, batch_bytes, mix, spans, word_hashes

WINDOW = 20
#: Words of a group; windows must be longer.
GROUP = 6
#: Words of the documents of a shard, and candidate windows of one part of a document.
SHARD_WORDS = 1 << 18
#: The bit table: ``2 ** BITS`` bits, made in ``PARTS`` parts.
BITS = 26
PARTS = 64
#: Words of a broadcast reference shard, and of the largest reference that is accepted.
REFERENCE_WORDS = 1 << 17
MAX_REFERENCE_WORDS = 1 << 24

_MULTIPLY = 0xD1342543DE82EF95


class SuffixAutomaton:
    """Online automaton of one growing sequence; unlike negative words keep its parts apart."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.last = 0
        self.parts = 0

    def part(self, words: list[int]) -> list[int]:
        """Append a part; for every word the length of the longest sequence that ends there and came before."""
        self.parts -= 1
        self._append(self.parts)
        link, length = self.link, self.length
        found = []
        for word in words:
            self._append(word)
            found.append(length[link[self.last]])
        return found

    def _append(self, word: int) -> None:
        edges, link, length = self.next, self.link, self.length
        p, new = self.last, len(length)
        edges.append({})
        link.append(0)
        length.append(length[p] + 1)
        while p >= 0 and word not in edges[p]:
            edges[p][word] = new
            p = link[p]
        if p >= 0:
            q = edges[p][word]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                # The part of q's sequences that end here gets a state of its own.
                own = len(length)
                edges.append(edges[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = own
                while p >= 0 and edges[p].get(word) == q:
                    edges[p][word] = own
                    p = link[p]
        self.last = new

    def matches(self, words: list[int]) -> list[int]:
        """For every word the length of the longest sequence that ends there and is in the automaton."""
        edges, link, length = self.next, self.link, self.length
        state = held = 0
        found = []
        for word in words:
            while state and word not in edges[state]:
                state = link[state]
                held = length[state]
            if word in edges[state]:
                state = edges[state][word]
                held += 1
            found.append(held)
        return found


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive words."""
    out = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for i, step in enumerate(_powers(width, _MULTIPLY)):
        out += hashes[i : i + len(out)] * step
    return mix(out + np.uint64(width))


def _word_parts(texts: pa.Array):
    """Yield (words per text, word hashes) for parts of a string array."""
    for raw, offsets in batch_bytes(texts):
        begin, finish, counts = spans(raw, np.diff(offsets))
        yield counts, word_hashes(raw, begin, finish, fold=False)


def _groups(counts: np.ndarray, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, place of the smallest group, its hash) of every window that lies in one text."""
    groups = _rolled(hashes, GROUP)
    if len(hashes) < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    owner = np.repeat(np.arange(len(counts)), counts)
    start = np.flatnonzero(owner[: len(hashes) - window + 1] == owner[window - 1 :])
    smallest = sliding_window_view(groups, window - GROUP + 1).argmin(axis=1)[start] + start
    return start, smallest, groups[smallest]


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _is_set(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = _slot(hashes)
    return (table[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)


def repeated_groups(texts: DataFrame, window: int) -> np.ndarray:
    """Bit table of the groups that are the smallest of windows at two or more places.

    ``texts`` has one column.  The driver reads ``PARTS`` rows, 2 ** BITS bits together.
    """

    def places(batches):
        for batch in slices(batches):
            for counts, hashes in _word_parts(batch.column(0)):
                _, place, group = _groups(counts, hashes, window)
                new = np.ones(len(place), dtype=bool)
                new[1:] = place[1:] != place[:-1]
                yield pa.RecordBatch.from_arrays([signed(group[new])], ["group"])

    size = (1 << BITS) // PARTS

    def bits(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = _slot(batch.column(0).to_numpy().view(np.uint64))
            part = slot // size
            for one in np.unique(part).tolist():
                held.setdefault(one, np.zeros(size, dtype=bool))[slot[part == one] % size] = True
        for part, table in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([np.packbits(table).tobytes()])], ["part", "bits"])

    found = texts.mapInArrow(places, "group long").groupBy("group").agg(F.count("*").alias("n")).filter("n > 1")
    part = F.shiftrightunsigned("group", 64 - BITS) / size
    made = found.select("group").repartition(PARTS, F.floor(part)).mapInArrow(bits, "part long, bits binary")
    table = np.zeros((PARTS, size // 8), np.uint8)
    for row in made.toLocalIterator():
        table[row["part"]] |= np.frombuffer(row["bits"], np.uint8)
    return table.reshape(-1)


class _Shard:
    """Candidate stretches of the documents of one shard, in order of (ord, key)."""

    def __init__(self, window: int):
        self.window, self.words = window, 0
        self.documents: list[tuple] = []  # (ord, key, first start, word hashes, starts)

    def rows(self):
        """(ord, key, starts of candidate windows, whether each came before, word hashes)."""
        automaton, before = SuffixAutomaton(), None
        for order, key, at, hashes, start in sorted(self.documents, key=lambda d: d[:3]):
            if (order, key, at) == before:
                continue  # the same row again
            before = (order, key, at)
            seen = np.zeros(len(start), dtype=bool)
            cuts = np.flatnonzero(np.diff(start) > 1) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(start)]):
                low, high = int(start[a]), int(start[b - 1]) + self.window
                longest = automaton.part(hashes[low:high].view(np.int64).tolist())
                seen[a:b] = np.array(longest[self.window - 1 :]) >= self.window
            yield order, key, start, seen, hashes


def _first_rows(shard: _Shard):
    columns: list[list[np.ndarray]] = [[], [], [], [], []]

    def add(values, order, key, start, count):
        for held, x in zip(columns, (values, np.full(len(start), order), np.full(len(start), key), start, count)):
            held.append(x.astype(np.int64))

    for order, key, start, seen, hashes in shard.rows():
        new = start[~seen]
        if len(new):
            rolled = _rolled(hashes, shard.window)[new]
            add(rolled.view(np.int64), order, key, new, np.zeros(len(new)))
        old = start[seen]
        if len(old):
            cuts = np.flatnonzero(np.diff(old) > 1) + 1
            lows = old[np.concatenate([[0], cuts])]
            sizes = np.diff(np.concatenate([[0], cuts, [len(old)]]))
            # Nothing to compare: any task may pass them on.
            spread = mix((lows + key).astype(np.uint64)).view(np.int64)
            add(spread, order, key, lows, sizes)
    whole = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in whole], ["hash", "ord", "key", "start", "count"])


def _candidates(bits: np.ndarray, window: int, shard_words: int):
    def read(batches):
        shard = _Shard(window)
        for batch in slices(batches):
            row = 0
            for counts, hashes in _word_parts(batch.column(2)):
                start, _, group = _groups(counts, hashes, window)
                start = start[_is_set(bits, group)]
                first = np.concatenate([[0], np.cumsum(counts)])
                cuts = np.searchsorted(start, first)
                for i in range(len(counts)):
                    if cuts[i] < cuts[i + 1]:
                        own = start[cuts[i] : cuts[i + 1]] - first[i]
                        order, key = (batch.column(c)[row + i].as_py() for c in (0, 1))
                        words = hashes[first[i] : first[i + 1]].copy()
                        # A document may fill several shards.
                        for at in range(0, len(own), shard_words):
                            part = own[at : at + shard_words]
                            shard.documents.append((order, key, int(part[0]), words, part))
                            shard.words += min(len(words), len(part) + window)
                            if shard.words >= shard_words:
                                yield _first_rows(shard)
                                shard = _Shard(window)
                row += len(counts)
        yield _first_rows(shard)

    return read


_ROW = "hash long, ord long, key long, start long, count long"


def _later(batches):
    """Of rows in order of (hash, ord, key, start): all but the first of a hash, and those with a count."""
    last = None
    for batch in batches:
        hashes, order, key, start, count = (c.to_numpy() for c in batch.columns)
        compared = np.flatnonzero(count == 0)
        if len(compared):
            columns = [c[compared] for c in (hashes, order, key, start)]
            if last is not None:
                columns = [np.concatenate([[b], c]) for b, c in zip(last, columns)]
            first = np.ones(len(columns[0]), dtype=bool)
            first[1:] = columns[0][1:] != columns[0][:-1]
            leader = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
            # A row that is given twice is the first one both times.
            same = np.all([c == c[leader] for c in columns], axis=0)
            last = [c[leader[-1]] for c in columns]
            keep = np.zeros(len(count), dtype=bool)
            keep[compared] = ~same[len(same) - len(compared) :]
            keep |= count > 0
        else:
            keep = count > 0
        at = pa.array(np.flatnonzero(keep))
        found = [batch.column(i).take(at) for i in (1, 2, 3)]
        yield pa.RecordBatch.from_arrays([*found, pa.array(np.maximum(count[keep], 1))], ["ord", "key", "start", "count"])


#: Place of rows without an id: after all others.
_NO_ID = (1 << 63) - 1


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    one, whole = F.col(doc_id).cast("long"), F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(one, F.lit(_NO_ID)).alias("ord"), F.xxhash64(one, whole).alias("key"), whole.alias("text"), one.alias("doc_id")
    )


SPAN = "struct<start:bigint,length:bigint>"
_CUT = f"doc_id long, n_words long, n_removed long, removed array<{SPAN}>, kept string"


def _cut(window: int):
    """Cut the windows at ``starts`` (``counts`` consecutive ones each) out of the texts."""

    def cut(batches):
        for batch in slices(batches):
            out = [[], [], [], [], []]
            for doc_id, text, starts, counts in zip(*(batch.column(i) for i in range(4))):
                words = text.as_py().encode().split()
                spans_, kept, gone = [], words, 0
                if starts.is_valid:
                    low, size = starts.values.to_numpy(), counts.values.to_numpy()
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, low, 1)
                    np.add.at(edges, low + size - 1 + window, -1)
                    covered = np.cumsum(edges)[:-1] > 0
                    turns = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]]))).tolist()
                    spans_ = [{"start": a, "length": b - a} for a, b in zip(turns[::2], turns[1::2])]
                    kept = [w for w, c in zip(words, covered.tolist()) if not c]
                    gone = len(words) - len(kept)
                for held, x in zip(out, (doc_id.as_py(), len(words), gone, spans_, b" ".join(kept).decode())):
                    held.append(x)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], ["doc_id", "n_words", "n_removed", "removed", "kept"])

    return cut


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS
) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept) for every row of ``docs``.

    A word goes if it lies in ``window`` consecutive words that also start earlier: in a
    row with a smaller id, or before in the same row.  Rows without an id come last;
    rows that share an id but not their text are in order of a hash; rows equal in both
    are one document given twice, with equal results.  ``removed`` lists the spans that
    go, ``kept`` joins the other words by one space.  Texts that are null or shorter
    than a window lose nothing.  Other columns are ignored; an empty table gives no row.
    """
    if window <= GROUP:
        raise ValueError(f"windows need more than {GROUP} words")
    rows = _keyed(docs, doc_id, text)
    bits = docs.sparkSession.sparkContext.broadcast(repeated_groups(rows.select("text"), window))

    def read(batches):
        yield from _candidates(bits.value, window, shard_words)(batches)

    firsts = rows.select("ord", "key", "text").mapInArrow(read, _ROW)
    placed = firsts.repartition("hash").sortWithinPartitions("hash", "ord", "key", "start")
    later = placed.mapInArrow(_later, "ord long, key long, start long, count long")
    found = later.groupBy("ord", "key").agg(F.collect_list(F.struct("start", "count")).alias("found"))
    joined = rows.join(found, ["ord", "key"], "left")
    return joined.select("doc_id", "text", "found.start", "found.count").mapInArrow(_cut(window), _CUT)


def remove_reference(
    docs: DataFrame, reference: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Like ``remove_repeats`` for word sequences that ``reference`` (one text column) holds.

    The reference is bounded: more than ``MAX_REFERENCE_WORDS`` words are refused.  A
    text of it that is longer than a shard is cut into parts that overlap by a window.
    """
    shards, held = [], []
    total = 0
    (name,) = reference.columns
    for row in reference.select(F.coalesce(F.col(name), F.lit("")).alias("text")).toLocalIterator():
        for _, hashes in _word_parts(pa.array([row["text"]])):
            words = hashes.view(np.int64).tolist()
            total += len(words)
            if total > MAX_REFERENCE_WORDS:
                raise ValueError("the reference is too large to be broadcast; use remove_repeats on both tables")
            for at in range(0, max(1, len(words) - window + 1), REFERENCE_WORDS):
                held.append(words[at : at + REFERENCE_WORDS + window - 1])
                if sum(map(len, held)) >= REFERENCE_WORDS:
                    shards.append(held)
                    held = []
    shards.append(held)
    shared = docs.sparkSession.sparkContext.broadcast(shards)
    rows = _keyed(docs, doc_id, text)

    def read(batches):
        automata = []
        for parts in shared.value:
            automata.append(SuffixAutomaton())
            for part in parts:
                automata[-1].part(part)
        for batch in slices(batches):
            row, starts = 0, []
            for counts, hashes in _word_parts(batch.column(1)):
                first = np.concatenate([[0], np.cumsum(counts)])
                for i in range(len(counts)):
                    words = hashes[first[i] : first[i + 1]].view(np.int64).tolist()
                    hit = np.zeros(len(words), dtype=bool)
                    for one in automata:
                        hit |= np.array(one.matches(words), np.int64) >= window
                    starts.append(np.flatnonzero(hit) - window + 1)
                row += len(counts)
            found = pa.array([s if len(s) else None for s in starts], pa.list_(pa.int64()))
            ones = pa.array([np.ones(len(s), np.int64) if len(s) else None for s in starts], pa.list_(pa.int64()))
            yield from _cut(window)([pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found, ones], ["a", "b", "c", "d"])])

    return rows.select("doc_id", "text").mapInArrow(read, _CUT)


def removal_digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: The same result from all windows as strings.
ORACLE = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(words[s : s + 19], ' ') AS body
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM texts)
), numbered AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS n FROM windows
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS place FROM numbered WHERE n > 1
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS body, count(*) AS n FROM placed ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

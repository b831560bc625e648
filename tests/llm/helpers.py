"""Small tables with the awkward cases that every operator must stand."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, partitions: int = 3):
    """Rows of (doc_id, text) or (doc_id, text, source)."""
    made = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] else None) for r in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(partitions)


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "some words that are here twice and more than five of them"),
    (6, "some words that are here twice and more than five of them"),
    (7, "Some Words that are here twice and more than five of them"),
    (7, "Some Words that are here twice and more than five of them"),
    (None, "a text that has no id at all but enough words"),
    (9, "é ü 中文 😀 <|endoftext|> <|im_start|> ½ \x00 x\x1cy"),
    (10, "long " * 20000),
    (11, "x" * 50000),
    (12, None, None),
]

#: Columns with names that operators use themselves.
CLASHING = ["id", "n", "score", "shard", "slot", "block", "source_size", "plan", "_row", "component", "label", "place"]


def clashing(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


def words(text: str | None) -> list[str]:
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded)


def shingles(text: str | None, width: int = 5) -> set[tuple[str, ...]]:
    own = words(text)
    return {tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1))} if own else set()


def near_copies(seed: int, groups: int = 12, size: int = 9, length: int = 120) -> list[str]:
    """Groups of texts with a few words changed, and passages that groups share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    shared = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=length)
        if rng.random() < 0.5:
            base[20:20] = shared
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4, 6])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return texts


def brute_components(rows: list[tuple[int, str | None]], percent: int = 75) -> dict[int, int]:
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    above = {i: i for i, _ in sets}

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                above[max(x, y)] = min(x, y)
    return {i: root(i) for i in above}

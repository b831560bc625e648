"""Boosted regression trees of many settings and folds, grown level by level together.

Features are binned once.  A level of all models is one aggregation: every task adds up
the residuals and rows of its blocks per (model, node, feature, bin), the sums of a model
meet in one place, and only its best splits reach the driver.  Trees of up to the largest
number of rounds are grown; a setting with fewer rounds is their prefix.

A table that fits one block of ``BLOCK_ROWS`` rows has nothing to exchange between
levels, so its block is handed to every task and each task grows whole models by the
same steps.  Residuals are summed as integers, so both ways, and any number of blocks,
give the same trees.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.runtime import scratch_path

#: Bins of a feature, and the most rows of a block.
BINS = 64
BLOCK_ROWS = 1 << 17
#: Rows that bin edges are taken from.
EDGE_ROWS = 1 << 16
#: A node's value is its residual sum divided by its rows and this.
SHRINK = 1.0

# Settings that a grid leaves out.
DEFAULTS = {"maxDepth": 5, "stepSize": 0.1, "maxIter": 20, "minInstancesPerNode": 1, "subsamplingRate": 1.0}


@dataclass(frozen=True)
class Setting:
    """One tree-growing setting, on all rows but those of ``fold`` (None: on all)."""

    depth: int
    step: float
    least: int
    rate: float
    fold: int | None = None


@dataclass
class Tree:
    """A complete binary tree by node number; ``feature`` is -1 where a row stays."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @staticmethod
    def of_depth(depth: int) -> Tree:
        nodes = (1 << (depth + 1)) - 1
        return Tree(np.full(nodes, -1, np.int16), np.zeros(nodes, np.int16), np.zeros(nodes))


@dataclass(frozen=True)
class Block:
    """Binned rows: ``bins`` is rows x features, ``row`` numbers them over the whole table."""

    bins: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    row: np.ndarray


@dataclass(frozen=True)
class Frame:
    """What all blocks share: bin edges per feature, mean label and the integer unit of residuals."""

    features: tuple[str, ...]
    edges: tuple[np.ndarray, ...]
    base: float
    unit: float
    seed: int


def settings(grid: dict[str, list]) -> list[tuple[Setting, int]]:
    """Every combination of a grid as (setting, rounds)."""
    values = [grid.get(name, [DEFAULTS[name]]) for name in DEFAULTS]
    return [(Setting(depth, step, least, rate), rounds) for depth, step, rounds, least, rate in product(*values)]


def _drawn(row: np.ndarray, tree: int, rate: float, seed: int) -> np.ndarray:
    """Rows of a tree's sample, by their number alone."""
    x = row.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) < rate * float(1 << 53)


def _step_down(bins: np.ndarray, node: np.ndarray, tree: Tree) -> np.ndarray:
    feature = tree.feature[node]
    value = np.take_along_axis(bins, np.maximum(feature, 0)[:, None].astype(np.int64), axis=1)[:, 0]
    return np.where(feature >= 0, 2 * node + 1 + (value > tree.bin[node]), node)


def _sums(bins: np.ndarray, node: np.ndarray, residual: np.ndarray, level: int) -> np.ndarray:
    """Residual sums and row counts per (node of the level, feature, bin)."""
    first, nodes, features = (1 << level) - 1, 1 << level, bins.shape[1]
    here = node >= first
    if level and not here.all():
        bins, node, residual = bins[here], node[here], residual[here]
    place = bins + (np.arange(features) * BINS + (node - first)[:, None] * (features * BINS))
    size = nodes * features * BINS
    flat = place.ravel()
    total = np.bincount(flat, np.repeat(residual, features), size)
    return np.stack([total, np.bincount(flat, minlength=size)]).reshape(2, nodes, features, BINS)


def _child_sums(above: np.ndarray, tree: Tree, bins: np.ndarray, node: np.ndarray, residual: np.ndarray, level: int) -> np.ndarray:
    """Like ``_sums`` from those of the level above: left parts are added up, right parts are the rest."""
    first = (1 << level) - 1
    here = np.flatnonzero((node >= first) & (node % 2 == 1))
    left = _sums(bins[here], (node[here] - 1) // 2, residual[here], level - 1)
    split = tree.feature[(1 << (level - 1)) - 1 : first] >= 0
    both = np.stack([left, np.where(split[:, None, None], above - left, 0)], axis=2)
    return both.reshape(2, 1 << level, *above.shape[2:])


def _best(sums: np.ndarray, least: int) -> np.ndarray:
    """Per node: feature (-1: none), bin, residuals and rows of the left and of the right part."""
    left = np.cumsum(sums, axis=3)
    whole = left[:, :, :1, -1:]
    right = left[:, :, :, -1:] - left
    gain = sum(s**2 / (n + SHRINK) for s, n in (left, right)) - whole[0] ** 2 / (whole[1] + SHRINK)
    gain[(left[1] < least) | (right[1] < least)] = 0
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    nodes = np.arange(len(flat))
    found = flat[nodes, at] > 0
    feature, cut = at // BINS, at % BINS
    parts = [p[i, nodes, feature, cut] for p in (left, right) for i in (0, 1)]
    parts = [np.where(found, p, w) for p, w in zip(parts, (whole[0, :, 0, 0], whole[1, :, 0, 0], 0, 0))]
    return np.column_stack([np.where(found, feature, -1), cut, *parts])


def _grow(tree: Tree, level: int, best: np.ndarray, step: float, unit: float) -> None:
    first = (1 << level) - 1
    for i, (feature, cut, left, left_rows, right, right_rows) in enumerate(best.tolist()):
        node = first + i
        if feature < 0:
            if not level:
                tree.value[0] = step * left / (left_rows + SHRINK) / unit
            continue
        tree.feature[node], tree.bin[node] = int(feature), int(cut)
        for child, total, rows in ((2 * node + 1, left, left_rows), (2 * node + 2, right, right_rows)):
            tree.value[child] = step * total / (rows + SHRINK) / unit


def _residual(block: Block, guess: np.ndarray, frame: Frame) -> np.ndarray:
    return np.rint((block.label - frame.base - guess) * frame.unit)


def _learns(block: Block, setting: Setting, tree: int, frame: Frame) -> np.ndarray:
    used = np.ones(len(block.row), dtype=bool) if setting.fold is None else block.fold != setting.fold
    return used if setting.rate >= 1 else used & _drawn(block.row, tree, setting.rate, frame.seed)


def _fall(bins: np.ndarray, tree: Tree, depth: int) -> np.ndarray:
    node = np.zeros(len(bins), np.int64)
    for _ in range(depth):
        node = _step_down(bins, node, tree)
    return node


def _error(block: Block, guess: np.ndarray, setting: Setting, frame: Frame) -> tuple[float, int]:
    """Sum of absolute errors on the held-out fold, and its rows."""
    held = block.fold == (-1 if setting.fold is None else setting.fold)
    return float(np.abs(block.label - frame.base - guess)[held].sum()), int(held.sum())


def _grow_alone(block: Block, setting: Setting, rounds: list[int], frame: Frame):
    """All trees of one setting over one block, and (rounds, error sum, rows) at each of ``rounds``."""
    guess, trees, errors = np.zeros(len(block.row)), [], []
    for number in range(max(rounds)):
        tree = Tree.of_depth(setting.depth)
        used = np.flatnonzero(_learns(block, setting, number, frame))
        bins, residual = block.bins[used], _residual(block, guess, frame)[used]
        node, sums = np.zeros(len(used), np.int64), None
        for level in range(setting.depth):
            sums = _sums(bins, node, residual, level) if sums is None else _child_sums(sums, tree, bins, node, residual, level)
            _grow(tree, level, _best(sums, setting.least), setting.step, frame.unit)
            if level + 1 < setting.depth:
                node = _step_down(bins, node, tree)
        guess += tree.value[_fall(block.bins, tree, setting.depth)]
        trees.append(tree)
        if number + 1 in rounds:
            errors.append((number + 1, *_error(block, guess, setting, frame)))
    return trees, errors


# --- blocks -------------------------------------------------------------------

_BLOCK = "rows long, bins binary, label binary, fold binary, row binary, guess binary"


def _packed(block: Block, guess: np.ndarray) -> pa.RecordBatch:
    arrays = (block.bins, block.label, block.fold, block.row, guess)
    columns = [pa.array([len(block.row)], pa.int64()), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]]
    return pa.RecordBatch.from_arrays(columns, ["rows", "bins", "label", "fold", "row", "guess"])


def _unpacked(rows: int, bins: bytes, label: bytes, fold: bytes, row: bytes, guess: bytes) -> tuple[Block, np.ndarray]:
    block = Block(
        np.frombuffer(bins, np.uint8).reshape(rows, -1).astype(np.int64),
        np.frombuffer(label), np.frombuffer(fold, np.int16), np.frombuffer(row, np.int64),
    )
    return block, np.frombuffer(guess).reshape(-1, rows)


def _blocks_of(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            yield _unpacked(*(batch.column(i)[row].as_py() for i in range(6)))


def framed(df: DataFrame, features: list[str], label: str, row: str, seed: int) -> Frame:
    """Bin edges, mean and unit of the rows.

    Edges are quantiles of about ``EDGE_ROWS`` rows, drawn by their number so that a rerun
    has the same; of all rows if there are fewer.  They only say where cuts may be.
    """
    wanted = df.select(
        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)],
        F.col(label).cast("double").alias("y"), F.col(row).cast("long").alias("r"),
    ).dropna()
    found = wanted.agg(
        F.count("*").alias("n"), F.max(F.abs("y")).alias("most"),
        F.sum(F.col("y").cast("decimal(38,9)")).alias("sum"),  # the same in any order
    ).first()
    drawn = wanted
    if found["n"] > EDGE_ROWS:
        drawn = wanted.where(F.pmod(F.xxhash64("r"), F.lit(1 << 20)) < int((1 << 20) * EDGE_ROWS / found["n"]))
    share = np.arange(1, BINS) / BINS
    held = drawn.drop("y", "r").toArrow()
    edges = tuple(np.unique(np.quantile(c.to_numpy(), share, method="lower")) if len(c) else np.zeros(0) for c in held.columns)
    # 24 bits for the largest residual keep sums over 2 ** 29 rows exact.
    unit = 2.0 ** (23 - np.ceil(np.log2(2 * (found["most"] or 1.0) + 1e-300)))
    base = float(found["sum"]) / found["n"] if found["n"] else 0.0
    return Frame(tuple(features), edges, base, float(unit), seed)


def blocks(df: DataFrame, frame: Frame, label: str, fold: str, row: str) -> DataFrame:
    """The rows of ``df`` as stored blocks; rows without a value in any feature or the label are left out."""
    features = list(frame.features)

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                columns = [part.column(i).to_numpy(zero_copy_only=False) for i in range(part.num_columns)]
                bins = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(frame.edges, columns)]).astype(np.uint8)
                block = Block(bins, columns[-3], columns[-2].astype(np.int16), columns[-1])
                yield _packed(block, np.zeros(0))

    rows = df.select(
        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)],
        F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("f"), F.col(row).cast("long").alias("r"),
    ).dropna(subset=[f"x{i}" for i in range(len(features))] + ["y"])
    path = scratch_path(df.sparkSession, "tree-blocks")
    rows.mapInArrow(pack, _BLOCK).write.parquet(path)
    return df.sparkSession.read.schema(_BLOCK).parquet(path)


def _joined(held: list, features: int) -> Block:
    none = np.zeros(0, np.int64)
    parts = [b for b, _ in held] or [Block(np.zeros((0, features), np.int64), np.zeros(0), none, none)]
    return Block(*[np.concatenate([getattr(p, n) for p in parts]) for n in ("bins", "label", "fold", "row")])


# --- growing --------------------------------------------------------------------

_FOUND = "model int, rounds int, error double, rows long, trees binary"


def _tree_bytes(trees: list[Tree]) -> bytes:
    return b"".join(t.feature.tobytes() + t.bin.tobytes() + t.value.tobytes() for t in trees)


def _trees_of(raw: bytes, depth: int) -> list[Tree]:
    nodes = (1 << (depth + 1)) - 1
    size, out = 12 * nodes, []
    for at in range(0, len(raw), size):
        part = raw[at : at + size]
        out.append(Tree(np.frombuffer(part, np.int16, nodes), np.frombuffer(part, np.int16, nodes, 2 * nodes), np.frombuffer(part[4 * nodes :])))
    return out


def _grow_spread(stored: DataFrame, models: list[Setting], rounds: list[int], frame: Frame):
    """Every model in one task of its own, over the one block that holds all rows."""
    spark = stored.sparkSession
    held = [_unpacked(*r) for r in stored.collect()]
    shared = spark.sparkContext.broadcast((_joined(held, len(frame.features)), models, rounds, frame))

    def grow(batches):
        block, models, rounds, frame = shared.value
        for batch in batches:
            for place in batch.column(0).to_pylist():
                model = shared_order.value[place]
                trees, errors = _grow_alone(block, models[model], rounds, frame)
                raw = _tree_bytes(trees) if models[model].fold is None else b""
                found = [(model, *e, raw if e[0] == max(rounds) else b"") for e in errors]
                kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*found), kinds)], ["model", "rounds", "error", "rows", "trees"]
                )

    # One model per task, deep trees first.
    order = sorted(range(len(models)), key=lambda m: -models[m].depth)
    shared_order = spark.sparkContext.broadcast(order)
    numbers = spark.range(0, len(models), 1, len(models))
    found = numbers.mapInArrow(grow, _FOUND).collect()
    errors = {(r["model"], r["rounds"]): (r["error"], r["rows"]) for r in found}
    return {r["model"]: _trees_of(r["trees"], models[r["model"]].depth) for r in found if r["trees"]}, errors


def _level_sums(shared):
    def add(batches):
        number, level, models, trees, frame = shared.value
        held: dict[int, np.ndarray] = {}
        for block, guesses in _blocks_of(batches):
            for model, tree in trees.items():
                setting = models[model]
                guess = guesses[model] if len(guesses) else np.zeros(len(block.row))
                used = np.flatnonzero(_learns(block, setting, number, frame))
                bins = block.bins[used]
                sums = _sums(bins, _fall(bins, tree, level), _residual(block, guess, frame)[used], level)
                held[model] = held[model] + sums if model in held else sums
        for model, sums in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["model", "sums"])

    return add


def _level_best(shared):
    def choose(batches):
        _, level, models, _, frame = shared.value
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for model, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums = np.frombuffer(raw.as_buffer()).reshape(2, 1 << level, len(frame.features), BINS)
                held[model] = held[model] + sums if model in held else sums
        for model, sums in held.items():
            best = _best(sums, models[model].least)
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.int32()), pa.array([best.tobytes()], pa.binary())], ["model", "best"])

    return choose


def _moved(shared):
    """Blocks with their guesses moved by a tree of every model."""

    def move(batches):
        _, _, models, trees, _ = shared.value
        for block, guesses in _blocks_of(batches):
            made = np.array(guesses) if len(guesses) else np.zeros((len(models), len(block.row)))
            for model, tree in trees.items():
                made[model] += tree.value[_fall(block.bins, tree, models[model].depth)]
            yield _packed(Block(block.bins.astype(np.uint8), block.label, block.fold, block.row), made)

    return move


def _errors(shared):
    def add(batches):
        _, _, models, _, frame = shared.value
        held: dict[int, list] = {}
        for block, guesses in _blocks_of(batches):
            for model, setting in enumerate(models):
                error, rows = _error(block, guesses[model], setting, frame)
                own = held.setdefault(model, [0.0, 0])
                own[0] += error
                own[1] += rows
        for model, (error, rows) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([model], pa.int32()), pa.array([error]), pa.array([rows], pa.int64())], ["model", "error", "rows"]
            )

    return add


def _grow_together(stored: DataFrame, models: list[Setting], rounds: list[int], frame: Frame):
    """All models one level at a time; a level is one aggregation over all blocks."""
    spark = stored.sparkSession
    state, errors = stored, {}
    grown: dict[int, list[Tree]] = {m: [] for m in range(len(models))}
    for number in range(max(rounds)):
        trees = {m: Tree.of_depth(s.depth) for m, s in enumerate(models)}
        for level in range(max(s.depth for s in models)):
            active = {m: t for m, t in trees.items() if models[m].depth > level}
            shared = spark.sparkContext.broadcast((number, level, models, active, frame))
            sums = state.mapInArrow(_level_sums(shared), "model int, sums binary")
            best = sums.repartition("model").mapInArrow(_level_best(shared), "model int, best binary")
            for row in best.collect():  # at most one row per model
                model = row["model"]
                _grow(trees[model], level, np.frombuffer(row["best"]).reshape(-1, 6), models[model].step, frame.unit)
            shared.unpersist()
        shared = spark.sparkContext.broadcast((number, 0, models, trees, frame))
        path = scratch_path(spark, "tree-guesses")
        state.mapInArrow(_moved(shared), _BLOCK).write.parquet(path)
        state = spark.read.schema(_BLOCK).parquet(path)
        for model, tree in trees.items():
            if models[model].fold is None:
                grown[model].append(tree)
        if number + 1 in rounds:
            added = state.mapInArrow(_errors(shared), "model int, error double, rows long")
            for row in added.groupBy("model").agg(F.sum("error").alias("error"), F.sum("rows").alias("rows")).collect():
                errors[row["model"], number + 1] = row["error"], row["rows"]
    return {m: t for m, t in grown.items() if t}, errors


def grow(stored: DataFrame, models: list[Setting], rounds: list[int], frame: Frame):
    """Trees of the models without a fold, and {(model, rounds): (error sum, rows)} on held-out folds."""
    total = stored.agg(F.sum("rows").alias("n")).first()["n"] or 0
    one_block = total <= BLOCK_ROWS
    return (_grow_spread if one_block else _grow_together)(stored, models, rounds, frame)


# --- model ----------------------------------------------------------------------


@dataclass
class TreeModel:
    """Fitted trees; ``chosen`` names the setting and ``tried`` how many there were."""

    frame: Frame
    depth: int
    trees: list[Tree]
    chosen: dict
    tried: int = 1
    sizes: dict = field(default_factory=dict)

    def predict(self, columns: list[np.ndarray]) -> np.ndarray:
        bins = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(self.frame.edges, columns)])
        out = np.zeros(len(bins))
        for tree in self.trees:
            out += tree.value[_fall(bins, tree, self.depth)]
        return self.frame.base + out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``; null where a feature is null."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf("double")
        def scored(*columns: pa.Array) -> pa.Array:
            values = [c.to_numpy(zero_copy_only=False) for c in columns]
            known = np.all([c.is_valid().to_numpy(zero_copy_only=False) for c in columns], axis=0)
            made = shared.value.predict([np.where(known, v, 0.0) for v in values])
            return pa.array(made, pa.float64(), mask=~known)

        inputs = [F.col(f"`{c}`").cast("double") for c in self.frame.features]
        return df.withColumn("prediction", scored(*inputs))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per node, and one row of settings."""
        rows = [
            (number, node, int(t.feature[node]), int(t.bin[node]), float(t.value[node]))
            for number, t in enumerate(self.trees)
            for node in range(len(t.value))
        ]
        nodes = spark.createDataFrame(rows, "tree int, node int, feature int, bin int, value double")
        nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        facts = {
            "features": self.frame.features, "edges": [e.tolist() for e in self.frame.edges], "base": self.frame.base,
            "unit": self.frame.unit, "seed": self.frame.seed, "depth": self.depth, "chosen": self.chosen,
            "tried": self.tried, "sizes": self.sizes,
        }
        spark.createDataFrame([(json.dumps(facts),)], "facts string").write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeModel:
        facts = json.loads(spark.read.parquet(f"{path}/settings").first()["facts"])
        edges = tuple(np.array(e, np.float64) for e in facts["edges"])
        frame = Frame(tuple(facts["features"]), edges, facts["base"], facts["unit"], facts["seed"])
        rows = spark.read.parquet(f"{path}/nodes").collect()  # as many as the settings allow, not the data
        trees = [Tree.of_depth(facts["depth"]) for _ in range(1 + max((r["tree"] for r in rows), default=-1))]
        for r in rows:
            tree = trees[r["tree"]]
            tree.feature[r["node"]], tree.bin[r["node"]], tree.value[r["node"]] = r["feature"], r["bin"], r["value"]
        return TreeModel(frame, facts["depth"], trees, facts["chosen"], facts["tried"], facts["sizes"])


def search(rows: DataFrame, features: list[str], label: str, grid: dict[str, list], folds: int, seed: int) -> TreeModel:
    """The setting of ``grid`` with the least mean absolute error over the folds, fitted on all rows.

    ``rows`` has ``_fold`` (0 to ``folds`` - 1) and ``_row``, a number of its own for
    every row.  Of equal errors the first of the grid counts.
    """
    frame = framed(rows, features, label, "_row", seed)
    stored = blocks(rows, frame, label, "_fold", "_row")
    tried = settings(grid)
    shapes = list(dict.fromkeys(s for s, _ in tried))
    rounds = sorted({r for _, r in tried})
    models = [Setting(s.depth, s.step, s.least, s.rate, fold) for s in shapes for fold in range(folds)]
    _, errors = grow(stored, models, rounds, frame)

    def error(setting: Setting, n: int) -> float:
        at = shapes.index(setting) * folds
        found = [errors[m, n] for m in range(at, at + folds)]
        return float(np.mean([e / r for e, r in found if r] or [0.0]))

    best, n = min(tried, key=lambda s: error(*s))
    trees, _ = grow(stored, [best], [n], frame)
    chosen = {"maxDepth": best.depth, "stepSize": best.step, "maxIter": n, "minInstancesPerNode": best.least, "subsamplingRate": best.rate}
    return TreeModel(frame, best.depth, trees[0], chosen | {"mae": error(best, n)}, len(tried))

"""Regularised boosted trees on binned features, stopped when held-out rows stop gaining.

Features are binned to bytes once.  Each level of a tree is one job: tasks add gradients
and hessians up by node, feature and bin, packed arrays per tile of features are summed
by shuffle, and only the best split of each tile reaches the driver.  Several models, for
example all folds or all settings of a grid, grow in the same jobs.  Gradients are whole
multiples of 2^-24, so that sums, and with them the trees, do not depend on how rows are
spread over tasks.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arithmetic import col
from ..operators.join import union_all_by_name
from ..operators.ranking import roc_auc
from ..sources import checkpoint, write_snapshot, read_snapshot
from ..sources.shared import scratch_path
from .folds import FOLDS, SEED, assign_folds

# Settings of the published training runs (fixed values).  Their row sampling has no
# sampling frequency, so it never acts there and is left out here.
PUBLISHED = {
    "n_estimators": 10000,
    "learning_rate": 0.02,
    "num_leaves": 34,
    "colsample_bytree": 0.9497036,
    "max_depth": 8,
    "reg_alpha": 0.041545473,
    "reg_lambda": 0.0735294,
    "min_split_gain": 0.0222415,
    "min_child_weight": 39.3259775,
    "early_stopping_rounds": 200,
}

#: Common boosting parameter names and the settings behind them.
NAMES = {
    "n_estimators": "rounds",
    "learning_rate": "learning_rate",
    "num_leaves": "max_leaves",
    "colsample_bytree": "feature_share",
    "max_depth": "max_depth",
    "reg_alpha": "l1",
    "reg_lambda": "l2",
    "min_split_gain": "min_gain",
    "min_child_weight": "min_child_weight",
    "early_stopping_rounds": "patience",
}

MAX_BINS = 255
#: Relative rank error of the bin edges.
EDGE_ERROR = 0.001
#: One unit of a gradient sum.
UNIT = float(1 << 24)
#: Entries (rows times features) of a block.
BLOCK = 1 << 21
#: Features to a tile.
TILE = 32
#: Bytes of sums a task holds before it passes them on.
HELD = 64 << 20
#: Rounds after which scores so far are written with the rows; newer trees are applied in each pass.
SETTLE = 16
#: Steps of probability in which the area under the curve is counted after every round.
STEPS = 4096


@dataclass(frozen=True)
class HistogramSettings:
    """Learner settings; the defaults are the published ones."""

    learning_rate: float = PUBLISHED["learning_rate"]
    rounds: int = PUBLISHED["n_estimators"]
    max_depth: int = PUBLISHED["max_depth"]
    max_leaves: int = PUBLISHED["num_leaves"]
    l1: float = PUBLISHED["reg_alpha"]
    l2: float = PUBLISHED["reg_lambda"]
    min_gain: float = PUBLISHED["min_split_gain"]
    min_child_weight: float = PUBLISHED["min_child_weight"]
    feature_share: float = PUBLISHED["colsample_bytree"]
    patience: int = PUBLISHED["early_stopping_rounds"]
    metric: str = "auc"
    seed: int = SEED

    def __post_init__(self):
        if self.metric not in ("auc", "log_loss"):
            raise ValueError(f"metric is auc or log_loss, not {self.metric}")

    @classmethod
    def from_names(cls, params: Mapping[str, object], **others) -> HistogramSettings:
        """From common boosting parameter names; an error for unknown ones."""
        if unknown := sorted(set(params) - set(NAMES)):
            raise ValueError(f"unknown boosting parameters: {', '.join(unknown)}")
        return cls(**{NAMES[k]: v for k, v in params.items()}, **others)


@dataclass
class Tree:
    """Nodes in order of creation; a leaf has feature -1.  A row goes left if its bin is at most ``bin``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, missing_left: bool, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        children = (len(self.feature), len(self.feature) + 1)
        self.feature[node], self.bin[node], self.missing_left[node], self.gain[node] = feature, bin_, missing_left, gain
        self.left[node], self.right[node] = children
        for value in values:
            for name, start in (("feature", -1), ("bin", 0), ("missing_left", False), ("left", 0), ("right", 0), ("value", value), ("gain", 0.0)):
                getattr(self, name).append(start)
        return children

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``bins``."""
        feature, at, miss = np.array(self.feature), np.array(self.bin), np.array(self.missing_left)
        left, right = np.array(self.left), np.array(self.right)
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while (inner := feature[node] >= 0).any():
            b = bins[rows, np.maximum(feature[node], 0)]
            goes = np.where(b == 0, miss[node], b <= at[node])
            node = np.where(inner, np.where(goes, left[node], right[node]), node)
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(bins)]


@dataclass
class HistogramModel:
    """A trained model: bin edges and trees over named features.  Plain data, saved as one JSON text."""

    features: list[str]
    edges: list[list[float]]
    start: float
    trees: list[Tree]
    #: Held-out metric after 0, 1, 2, ... rounds, and the number of rounds to keep.
    metrics: list[float]
    best: int

    def margins(self, bins: np.ndarray, rounds: int | None = None) -> np.ndarray:
        out = np.full(len(bins), self.start)
        for tree in self.trees[: self.best if rounds is None else rounds]:
            out = out + tree.predict(bins)
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HistogramModel:
        stored = json.loads(spark.read.parquet(path).first()["model"])
        stored["trees"] = [Tree(**t) for t in stored["trees"]]
        return cls(**stored)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 64) -> list[list[float]]:
    """Rising inner edges per feature, from approximate quantiles: at most ``bins`` - 1 of them; nulls and NaN do not count."""
    if not 2 <= bins <= MAX_BINS:
        raise ValueError(f"bins must be from 2 to {MAX_BINS}")
    names = [f"f{i}" for i in range(len(features))]
    finite = [F.when(~F.isnan(col(c).cast("double")), col(c).cast("double")).alias(n) for c, n in zip(features, names, strict=True)]
    probabilities = [i / bins for i in range(1, bins)]
    found = df.select(*finite).approxQuantile(names, probabilities, EDGE_ERROR)
    return [sorted(set(values)) for values in found]


def to_bins(values: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bins of a matrix of doubles: 0 for NaN, else 1 + the number of edges below the value."""
    out = np.zeros(values.shape, np.uint8)
    for j, cut in enumerate(edges):
        column = values[:, j]
        out[:, j] = np.where(np.isnan(column), 0, np.searchsorted(np.asarray(cut), column, side="left") + 1)
    return out


def _matrix(batch: pa.RecordBatch, first: int) -> np.ndarray:
    columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(first, batch.num_columns)]
    return np.column_stack(columns).astype(np.float64) if columns else np.zeros((batch.num_rows, 0))


_BLOCKS = "n int, labels binary, folds binary, bins binary, margins binary"


def binned_blocks(df: DataFrame, label: str, fold: str, features: Sequence[str], edges: Sequence[Sequence[float]], starts: Sequence[float]) -> DataFrame:
    """Labelled rows packed in blocks: labels, folds, bins, and one start margin per model."""
    rows = max(1, BLOCK // max(len(features), 1))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                b = whole.slice(at, rows)
                n = b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n], pa.int32()),
                        pa.array([b.column(0).to_numpy().astype("u1").tobytes()], pa.binary()),
                        pa.array([b.column(1).to_numpy().astype("<i4").tobytes()], pa.binary()),
                        pa.array([to_bins(_matrix(b, 2), edges).tobytes()], pa.binary()),
                        pa.array([np.repeat(np.asarray(starts, "<f8"), n).tobytes()], pa.binary()),
                    ],
                    names=["n", "labels", "folds", "bins", "margins"],
                )

    chosen = df.where(col(label).isNotNull()).select(
        col(label).cast("int").alias("label"), col(fold).cast("int").alias("fold"), *[col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    )
    return chosen.mapInArrow(step, _BLOCKS)


def _block(row: tuple, features: int, models: int) -> tuple[np.ndarray, ...]:
    n, labels, folds, bins, margins = row
    return (
        np.frombuffer(labels, "u1").astype(np.float64),
        np.frombuffer(folds, "<i4"),
        np.frombuffer(bins, "u1").reshape(n, features),
        np.frombuffer(margins, "<f8").reshape(models, n),
    )


def _blocks_of(batches: Iterator[pa.RecordBatch], features: int, models: int) -> Iterator[tuple]:
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            yield row, _block(row, features, models)


def probability(margins: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-margins))


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    """The gradient sum after the L1 penalty."""
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_split(sums: np.ndarray, settings: HistogramSettings, allowed: np.ndarray) -> tuple | None:
    """The best split of a node in one tile: gain, feature, bin, missing left, and the gradient and hessian sums of both sides.

    ``sums`` is features x bins x 2, in units; bin 0 holds missing values, which go to the side that
    gains more, right if equal.  Ties go to the smaller feature, then bin.
    """
    g, h = sums[..., 0] / UNIT, sums[..., 1] / UNIT
    all_g, all_h = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
    score = lambda a, b: shrunk(a, settings.l1) ** 2 / np.maximum(b + settings.l2, 1e-12)
    best = None
    for missing_left in (False, True):
        gl = np.cumsum(g[:, 1:], 1) + (g[:, :1] if missing_left else 0.0)
        hl = np.cumsum(h[:, 1:], 1) + (h[:, :1] if missing_left else 0.0)
        gr, hr = all_g - gl, all_h - hl
        gain = score(gl, hl) + score(gr, hr) - score(all_g, all_h)
        open_ = (hl >= settings.min_child_weight) & (hr >= settings.min_child_weight) & (hl > 0) & (hr > 0) & allowed[:, None]
        gain = np.where(open_, gain, -np.inf)
        f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if np.isfinite(gain[f, b]) and gain[f, b] > settings.min_gain and (best is None or gain[f, b] > best[0]):
            best = (float(gain[f, b]), int(f), int(b) + 1, missing_left, float(gl[f, b]), float(hl[f, b]), float(gr[f, b]), float(hr[f, b]))
    return best


def _level(
    blocks: DataFrame,
    features: int,
    bins: int,
    settings: Sequence[HistogramSettings],
    held: Sequence[int | None],
    recent: Sequence[Sequence[Tree]],
    growing: Mapping[int, Tree],
    frontier: Mapping[int, Sequence[int]],
    allowed: Mapping[int, np.ndarray],
    measure: bool,
) -> list:
    """One job: split candidates of every node of the frontier, and the held-out measures of each model where asked."""
    models = len(settings)
    tiles = range(0, features, TILE)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        measured: dict[int, np.ndarray] = {}
        offsets = np.arange(features) * bins

        def flush() -> pa.RecordBatch:
            rows = []
            for m, s in sums.items():
                for node, of_node in zip(frontier[m], s.reshape(len(frontier[m]), features, bins, 2)):
                    rows += [(m, node, t, of_node[t : t + TILE].astype("<i8").tobytes()) for t in tiles]
            rows += [(m, -1, 0, x.astype("<i8").tobytes()) for m, x in measured.items()]
            sums.clear()
            measured.clear()
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["model", "node", "tile", "sums"])

        for _, (y, folds, matrix, margins) in _blocks_of(batches, features, models):
            for m in range(models):
                if not (measure or frontier.get(m)):
                    continue
                margin = margins[m]
                for tree in recent[m]:
                    margin = margin + tree.predict(matrix)
                p = probability(margin)
                out = np.zeros(len(y), bool) if held[m] is None else folds == held[m]
                if measure and out.any():
                    loss = -np.log(np.maximum(np.where(y[out] == 1, p[out], 1 - p[out]), 1e-15))
                    place = np.minimum((p[out] * STEPS).astype(np.int64), STEPS - 1)
                    total = measured.setdefault(m, np.zeros(1 + 2 * STEPS))
                    total[0] += np.rint(loss * UNIT).sum()
                    total[1:] += np.bincount(place + STEPS * (y[out] == 1), minlength=2 * STEPS)
                if not frontier.get(m):
                    continue
                place = np.full(max(frontier[m]) + 1, -1)
                place[list(frontier[m])] = np.arange(len(frontier[m]))
                leaf = growing[m].leaves(matrix)
                at = np.where(leaf < len(place), place[np.minimum(leaf, len(place) - 1)], -1)
                here = np.flatnonzero(~out & (at >= 0))
                if not len(here):
                    continue
                size = len(frontier[m]) * features * bins
                flat = (at[here][:, None] * (features * bins) + offsets + matrix[here]).ravel()
                pair = [np.rint(x[here] * UNIT) for x in (p - y, p * (1 - p))]
                added = np.stack([np.bincount(flat, np.repeat(x, features), size) for x in pair], axis=1)
                sums[m] = sums[m] + added if m in sums else added
            if sum(s.nbytes for s in sums.values()) > HELD:
                yield flush()
        if sums or measured:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        key, total = None, None

        def settle() -> None:
            m, node, tile = key
            if node < 0:
                found.append((m, node, None, None, None, None, None, None, None, None, total.tolist()))
                return
            s = total.reshape(-1, bins, 2)
            split = best_split(s, settings[m], allowed[m][tile : tile + TILE])
            g, h = (s[0, :, i].sum() / UNIT for i in (0, 1))
            if split is None:
                found.append((m, node, None, None, None, None, g, h, None, None, None))
            else:
                gain, f, b, missing_left, gl, hl, gr, hr = split
                found.append((m, node, gain, tile + f, b, missing_left, gl, hl, gr, hr, None))

        for batch in batches:
            for *k, blob in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(blob, "<i8")
                if tuple(k) == key:
                    total = total + part
                    continue
                if key is not None:
                    settle()
                key, total = tuple(k), part
        if key is not None:
            settle()
        if found:
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.float64()] * 4, pa.list_(pa.int64()))
            names = ["model", "node", "gain", "feature", "bin", "missing_left", "gl", "hl", "gr", "hr", "measured"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    parts = blocks.mapInArrow(add_up, "model int, node int, tile int, sums binary")
    dealt = parts.repartition("model", "node", "tile").sortWithinPartitions("model", "node", "tile")
    schema = "model int, node int, gain double, feature int, bin int, missing_left boolean, gl double, hl double, gr double, hr double, measured array<bigint>"
    return dealt.mapInArrow(merge, schema).collect()


def _measure(total: Sequence[int], metric: str) -> float:
    """The held-out metric, larger is better; a single class has no area and measures 0.5."""
    negative, positive = (np.array(total[1 + i * STEPS : 1 + (i + 1) * STEPS], np.float64) for i in (0, 1))
    n = negative.sum() + positive.sum()
    if metric == "log_loss":
        return -float(total[0] / UNIT / n)
    pairs = negative.sum() * positive.sum()
    below = np.cumsum(negative) - negative
    return float((positive * (below + negative / 2)).sum() / pairs) if pairs else 0.5


def _features_of_round(settings: HistogramSettings, features: int, round_: int) -> np.ndarray:
    """Which features a tree may use: the same for all models of a seed."""
    if settings.feature_share >= 1:
        return np.ones(features, bool)
    take = max(1, int(round(settings.feature_share * features)))
    chosen = random.Random(settings.seed * 1_000_003 + round_).sample(range(features), take)
    out = np.zeros(features, bool)
    out[chosen] = True
    return out


def fit_models(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    settings: Sequence[HistogramSettings],
    held: Sequence[int | None],
    fold: str = "fold",
    bins: int = 64,
    edges: Sequence[Sequence[float]] | None = None,
) -> list[HistogramModel]:
    """Train several models in the same passes: model m learns from the rows whose fold is not ``held[m]``.

    A model with held-out rows stops once its metric has not risen for ``patience`` rounds and keeps
    its best round; without (``held[m]`` None, or no such rows) it trains all its rounds.  Trees grow
    level by level; where ``max_leaves`` would be passed, the splits that gain most are made.
    Labels are 0 or 1, rows without a label are not used.  Nulls, NaN and infinities are handled by
    the bins: missing values have their own, infinities are in the outer ones.
    """
    spark = df.sparkSession
    features, settings, held = list(features), list(settings), list(held)
    labelled = df.where(col(label).isNotNull())
    if edges is None:
        edges = bin_edges(labelled, features, bins)
    width = max((len(e) for e in edges), default=0) + 2
    shares = labelled.groupBy(col(fold).cast("int").alias("fold")).agg(F.count(F.lit(1)).alias("n"), F.sum(col(label).cast("double")).alias("y")).collect()
    starts = []
    for h in held:
        n = sum(r["n"] for r in shares if h is None or r["fold"] != h)
        share = sum(r["y"] for r in shares if h is None or r["fold"] != h) / n if n else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        starts.append(float(np.log(share / (1 - share))))
    known = {r["fold"] for r in shares}
    held = [h if h in known else None for h in held]

    def kept(blocks: DataFrame) -> DataFrame:
        path = scratch_path(spark, "binned")
        write_snapshot(blocks, path)
        return read_snapshot(spark, path).persist(StorageLevel.MEMORY_AND_DISK)

    blocks = kept(binned_blocks(labelled, label, fold, features, edges, starts))
    count = len(settings)
    models = [HistogramModel(features, [list(map(float, e)) for e in edges], s, [], [], 0) for s in starts]
    recent: list[list[Tree]] = [[] for _ in models]
    active = set(range(count))
    common = (len(features), width, settings, held)

    def judged(rows: list) -> None:
        """Note the metric after the rounds so far, and stop models that gain no more."""
        for r in rows:
            if r["node"] >= 0 or r["model"] not in active:
                continue
            m = r["model"]
            model, patience = models[m], settings[m].patience
            model.metrics.append(_measure(r["measured"], settings[m].metric))
            model.best = int(np.argmax(model.metrics))
            if len(model.metrics) - 1 - model.best >= patience:
                active.discard(m)

    try:
        round_ = 0
        while True:
            active -= {m for m in active if len(models[m].trees) >= settings[m].rounds and (held[m] is None or len(models[m].metrics) > settings[m].rounds)}
            if not active:
                break
            growing = {m: Tree() for m in active}
            frontier = {m: [0] if len(models[m].trees) < settings[m].rounds and features else [] for m in active}
            allowed = {m: _features_of_round(settings[m], len(features), round_) for m in active}
            leaves = dict.fromkeys(active, 1)
            depth = 0
            while any(frontier.values()) or depth == 0:
                rows = _level(blocks, *common, recent, growing, frontier, allowed, measure=depth == 0)
                if depth == 0:
                    judged(rows)
                splits: dict[tuple, object] = {}
                for r in rows:
                    key = (r["model"], r["node"])
                    if r["node"] >= 0 and r["model"] in active:
                        if depth == 0 and r["gain"] is None and key not in splits:
                            growing[r["model"]].value[0] = _leaf(r["gl"], r["hl"], settings[r["model"]])
                        if r["gain"] is not None and (key not in splits or (-r["gain"], r["feature"], r["bin"]) < (-splits[key]["gain"], splits[key]["feature"], splits[key]["bin"])):
                            splits[key] = r
                frontier = {m: [] for m in active}
                for (m, node), r in sorted(splits.items(), key=lambda x: (x[0][0], -x[1]["gain"], x[0][1])):
                    if leaves[m] >= settings[m].max_leaves:
                        continue
                    values = (_leaf(r["gl"], r["hl"], settings[m]), _leaf(r["gr"], r["hr"], settings[m]))
                    children = growing[m].split(node, r["feature"], r["bin"], r["missing_left"], r["gain"], values)
                    leaves[m] += 1
                    if depth + 1 < settings[m].max_depth:
                        frontier[m] += children
                depth += 1
            for m in active:
                if len(models[m].trees) < settings[m].rounds:
                    models[m].trees.append(growing[m])
                    recent[m].append(growing[m])
            round_ += 1
            if round_ % SETTLE == 0:
                older = blocks
                blocks = kept(_advanced(older, len(features), count, recent))
                blocks.count()
                older.unpersist()
                recent = [[] for _ in models]
    finally:
        blocks.unpersist()
    for m, model in enumerate(models):
        if held[m] is None:
            model.best = len(model.trees)
    return models


def _leaf(g: float, h: float, settings: HistogramSettings) -> float:
    return float(-settings.learning_rate * shrunk(np.float64(g), settings.l1) / max(h + settings.l2, 1e-12))


def _advanced(blocks: DataFrame, features: int, models: int, recent: Sequence[Sequence[Tree]]) -> DataFrame:
    """The blocks with the newer trees added to their margins."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (n, labels, folds, bins, _), (_, _, matrix, margins) in _blocks_of(batches, features, models):
            out = []
            for m in range(models):
                margin = margins[m]
                for tree in recent[m]:
                    margin = margin + tree.predict(matrix)
                out.append(margin.astype("<f8"))
            columns = [pa.array([n], pa.int32()), *[pa.array([x], pa.binary()) for x in (labels, folds, bins, np.concatenate(out).tobytes())]]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "labels", "folds", "bins", "margins"])

    return blocks.mapInArrow(step, _BLOCKS)


def score_models(df: DataFrame, key: Sequence[str], models: Sequence[HistogramModel], rounds: Sequence[int] | None = None, out: str = "score") -> DataFrame:
    """Key columns and the mean probability of the models, all of which share features and edges.

    With ``rounds`` there is a column ``<out>_<n>`` for each number of rounds, from one pass over the trees.
    """
    first = models[0]
    keys = list(key)
    names = [out] if rounds is None else [f"{out}_{n}" for n in rounds]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = to_bins(_matrix(b, len(keys)), first.edges)
            totals = np.zeros((len(names), b.num_rows))
            for model in models:
                margin = np.full(b.num_rows, model.start)
                wanted = [model.best] if rounds is None else [min(n, len(model.trees)) for n in rounds]
                for done in range(max(wanted) + 1):
                    for i, n in enumerate(wanted):
                        if n == done:
                            totals[i] += probability(margin)
                    if done < max(wanted):
                        margin = margin + model.trees[done].predict(bins)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], *[pa.array(t / len(models)) for t in totals]], names=[*keys, *names])

    chosen = df.select(*[col(k) for k in keys], *[col(c).cast("double").alias(f"__f{i}") for i, c in enumerate(first.features)])
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*[col(k) for k in keys]).schema], *[f"`{n}` double" for n in names]])
    return chosen.mapInArrow(step, schema)


@dataclass(frozen=True)
class HistogramFolds:
    """``folds``: fold, auc, best_iter, trained.  ``out_of_fold`` and ``scores``: key, score.  ``importances``: feature, importance, splits, fold."""

    folds: DataFrame
    overall_auc: float | None
    out_of_fold: DataFrame
    scores: DataFrame
    importances: DataFrame
    models: list[HistogramModel]


def importance_rows(models: Sequence[HistogramModel]) -> list[tuple]:
    """Feature, share of gain, number of splits and fold, of the rounds kept."""
    out = []
    for fold, model in enumerate(models):
        gains, splits = np.zeros(len(model.features)), np.zeros(len(model.features), int)
        for tree in model.trees[: model.best]:
            for f, g in zip(tree.feature, tree.gain):
                if f >= 0:
                    gains[f] += g
                    splits[f] += 1
        total = gains.sum() or 1.0
        out += [(name, float(g / total), int(s), fold) for name, g, s in zip(model.features, gains, splits)]
    return out


def train_folds(
    df: DataFrame, key: str, label: str, features: Sequence[str], settings: HistogramSettings | None = None, k: int = FOLDS, seed: int = SEED, bins: int = 64
) -> HistogramFolds:
    """One model per fold, all grown in the same passes, each stopped by the rows it does not learn from."""
    settings = settings or HistogramSettings()
    spark = df.sparkSession
    folded = assign_folds(df, [key], k, seed)
    models = fit_models(folded, label, features, [settings] * k, list(range(k)), bins=bins)
    labelled = folded.where(col(label).isNotNull())
    parts = [score_models(labelled.where(F.col("fold") == f), [key, label, "fold"], [m]) for f, m in enumerate(models)]
    out_of_fold = checkpoint(union_all_by_name(*parts))
    scores = checkpoint(score_models(df.where(col(label).isNull()), [key], models))
    sizes = spark.createDataFrame([(f, m.best, len(m.trees)) for f, m in enumerate(models)], "fold int, best_iter int, trained int")
    by_fold = roc_auc(out_of_fold, label, "score", group_by=["fold"])
    return HistogramFolds(
        folds=sizes.join(by_fold, "fold", "left").select("fold", "auc", "best_iter", "trained"),
        overall_auc=roc_auc(out_of_fold, label, "score").first()["auc"],
        out_of_fold=out_of_fold,
        scores=scores,
        importances=spark.createDataFrame(importance_rows(models), "feature string, importance double, splits int, fold int"),
        models=models,
    )


def refit(df: DataFrame, label: str, features: Sequence[str], result: HistogramFolds, settings: HistogramSettings | None = None, bins: int = 64) -> HistogramModel:
    """All labelled rows, for as many rounds as the fold with the best AUC kept."""
    best = result.folds.orderBy(F.desc_nulls_last("auc"), "fold").first()
    settings = replace(settings or HistogramSettings(), rounds=best["best_iter"])
    return fit_models(df.withColumn("fold", F.lit(0)), label, features, [settings], [None], bins=bins)[0]


def tune_staged(
    df: DataFrame, key: str, label: str, features: Sequence[str], grid: Mapping[str, Sequence], k: int, settings: HistogramSettings | None = None, bins: int = 64
) -> tuple[dict, DataFrame]:
    """Best parameters by mean fold AUC, and the mean of every setting.

    Settings that differ in the number of rounds alone are one fit, of the largest number, read at
    each number; all fits grow in the same passes, and one pass scores every held-out row.
    """
    base = replace(settings or HistogramSettings(), patience=2**31)
    grid = {name: list(values) for name, values in grid.items()}
    if unknown := sorted(set(grid) - set(NAMES)):
        raise ValueError(f"cannot tune {', '.join(unknown)}; known are {', '.join(NAMES)}")
    stages = sorted(grid.get("n_estimators", [base.rounds]))
    others = [n for n in grid if n != "n_estimators"]
    points: list[dict] = [{}]
    for name in others:
        points = [{**p, name: v} for p in points for v in grid[name]]
    spark = df.sparkSession
    folded = assign_folds(df.where(col(label).isNotNull()), [key], k)
    fits = [(i, f) for i in range(len(points)) for f in range(k)]
    each = [replace(base, rounds=stages[-1], **{NAMES[n]: v for n, v in points[i].items()}) for i, _ in fits]
    models = fit_models(folded, label, features, each, [f for _, f in fits], bins=bins)
    parts = []
    for (i, f), model in zip(fits, models):
        scored = score_models(folded.where(F.col("fold") == f), [label, "fold"], [model], rounds=stages)
        long = scored.unpivot([label, "fold"], [f"score_{n}" for n in stages], "stage", "score")
        parts.append(long.withColumn("point", F.lit(i)))
    aucs = roc_auc(checkpoint(union_all_by_name(*parts)), label, "score", group_by=["point", "stage", "fold"])
    means = aucs.groupBy("point", "stage").agg(F.avg("auc").alias("auc")).collect()
    names = [*others, "n_estimators"]
    rows = sorted((*(points[r["point"]][n] for n in others), int(r["stage"].removeprefix("score_")), r["auc"]) for r in means)
    whole = {"n_estimators", "num_leaves", "max_depth", "early_stopping_rounds"}
    schema = ", ".join(f"{n} {'int' if n in whole else 'double'}" for n in names) + ", auc double"
    table = spark.createDataFrame([(*(int(v) if n in whole else float(v) for n, v in zip(names, r)), r[-1]) for r in rows], schema)
    return dict(zip(names, max(rows, key=lambda r: (r[-1] is not None, r[-1] or 0.0)))), table

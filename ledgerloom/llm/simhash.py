"""SimHash near-duplicates: fingerprints, and links by the generalised pigeonhole principle.

Sixty-four bits are cut into parts; bits that move together share a part.  With
thresholds t_i that add up to T - m + 1 over m parts, two fingerprints at most T
bits apart lie within t_i bits of each other in some part i (a part with t_i = -1
is not looked at).  The thresholds are the cheapest ones under the number of
candidates each part is estimated to give, by dynamic programming.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import checkpoint
from .common import arrow, batch, slices, stored, table, texts
from .components import connected_components

BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 3
#: Numbers of parts that are compared; more would leave parts of few bits.
PARTS = (2, 3, 4)
#: What a probe row costs, in verified candidates.
PROBE_COST = 20.0


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the hashes of the shingles; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[min(shingle, len(words)) - 1 :])),
        np.uint64,
    )
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = hashes[i : i + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp, th`` (fp as a signed long, th the hash of the text) per row; a null text counts as empty."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            values = [fingerprint(t) for t in texts(b.column(1)).cast(pa.large_binary()).to_pylist()]
            fp = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), fp, b.column(2)], names=["id", "fp", "th"])

    chosen = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    return arrow(chosen, step, "id bigint, fp bigint, th bigint")


def bit_counts(distinct: DataFrame) -> np.ndarray:
    """64 x 64 numbers of fingerprints in which both bits are set; summed in the tasks first."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("n", pa.int64())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS), np.int64)
        for b in batches:
            rows = np.ascontiguousarray(b.column(0).to_numpy()).view(np.uint8).reshape(-1, 8)
            for k in range(0, len(rows), 65_536):
                bits = np.unpackbits(rows[k : k + 65_536], axis=1, bitorder="little").astype(np.float64)
                both += (bits.T @ bits).astype(np.int64)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield batch(schema, i, j, both.ravel())

    summed = arrow(distinct.select("fp"), step, "i int, j int, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n"))
    out = np.zeros((BITS, BITS))
    for r in summed.collect():
        out[r["i"], r["j"]] = r["n"]
    return out


def correlated_parts(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Cut the bits into ``parts`` groups of nearly equal size, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    spread = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    near = np.abs(cov / spread)
    np.fill_diagonal(near, 0)
    free, out = set(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        rest = sorted(free)
        group = [max(rest, key=lambda b: (near[b, rest].max(), -b))]
        free.remove(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: (near[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def mask(bits: Sequence[int]) -> int:
    """The bits as a signed 64-bit number."""
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def within(differ: np.ndarray) -> np.ndarray:
    """Chance of exactly 0, 1, 2, ... differing bits, each differing on its own with its own chance."""
    chance = np.ones(1)
    for q in differ:
        chance = np.convolve(chance, [1 - q, q])
    return chance


def allocate(costs: Sequence[Sequence[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up that add up to ``total`` at the least cost; ``costs[i][t + 1]`` is that of part i at t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, c in enumerate(row, start=-1):
                if spent + t not in new or cost + c < new[spent + t][0]:
                    new[spent + t] = (cost + c, [*chosen, t])
        best = new
    return best[total]


def choose_parts(distinct: DataFrame, n: int, distance: int) -> list[tuple[list[int], int]]:
    """Parts and thresholds with the least estimated number of probes and candidates."""
    both = bit_counts(distinct)
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    layouts = {m: correlated_parts(both, n, m) for m in PARTS}
    groups = [(m, k, bits) for m, layout in layouts.items() for k, bits in enumerate(layout)]
    keys = F.explode(
        F.array(*[F.struct(F.lit(g).alias("g"), F.col("fp").bitwiseAND(F.lit(mask(bits))).alias("key")) for g, (_, _, bits) in enumerate(groups)])
    )
    equal = (
        distinct.select(keys.alias("x")).groupBy("x.g", "x.key").agg(F.count(F.lit(1)).alias("c"))
        .groupBy("g").agg(F.sum(F.col("c").cast("double") * F.col("c")).alias("pairs"))
    )
    pairs = {r["g"]: r["pairs"] for r in equal.collect()}
    cost = {}
    for g, (m, k, bits) in enumerate(groups):
        chance = within(differ[bits])
        known = pairs.get(g, 0.0) / max(n * n * chance[0], 1e-9)  # how many times more often parts agree than bits on their own would
        cost[m, k] = [0.0] + [
            PROBE_COST * n * sum(comb(len(bits), e) for e in range(t + 1)) + known * n * n * chance[: t + 1].sum()
            for t in range(distance + 1)
        ]
    options = []
    for m, layout in layouts.items():
        if distance - m + 1 >= -m:
            total, chosen = allocate([cost[m, k] for k in range(m)], distance - m + 1)
            options.append((total, list(zip(layout, chosen))))
    return min(options, key=lambda o: o[0])[1]


def links(distinct: DataFrame, distance: int = DISTANCE, parts: Sequence[tuple[Sequence[int], int]] | None = None) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints (column ``fp``) at most ``distance`` bits apart; pairs may repeat."""
    if parts is None:
        n = distinct.count()
        if n < 2:
            return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
        parts = choose_parts(distinct, n, distance)
    index, right = [], None

    def flipped(key: Column, flips: list[int]) -> Column:
        return key if len(flips) == 1 else F.explode(F.transform(F.lit(flips), lambda f: f.bitwiseXOR(key)))

    for k, (bits, t) in enumerate(parts):
        if t < 0:
            continue
        key = F.col("fp").bitwiseAND(F.lit(mask(bits)))
        flips = [mask(c) for e in range(t + 1) for c in combinations(bits, e)]
        index.append(F.struct(F.lit(k).alias("part"), key.alias("key")))
        rows = distinct.select(F.col("fp").alias("b"), F.lit(k).alias("part"), flipped(key, flips).alias("key"))
        right = rows if right is None else right.union(rows)
    left = distinct.select(F.col("fp").alias("a"), F.explode(F.array(*index)).alias("x")).select("a", "x.part", "x.key")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    return left.hint("shuffle_merge").join(right, (left["part"] == right["part"]) & (left["key"] == right["key"]) & near).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE) -> DataFrame:
    """``id, fp, th, group, component`` per row of ``docs``; the component is its smallest id, th the hash of the text.

    Components are told apart by ``group``: where ids repeat, two may have one smallest id.

    Null and empty texts have fingerprint zero and link with each other and with
    whatever lies near zero.  Rows with a null id take part; a component of such
    rows alone has a null component.  Repeated ids get a row each.  Other
    columns of ``docs`` are ignored; an empty table gives an empty result.
    Copies are one fingerprint before any pair is made.
    """
    marked = stored(fingerprints(docs, id_col, text_col), "simhash")
    distinct = checkpoint(marked.groupBy("fp").agg(F.min("id").alias("least")))
    found = connected_components(links(distinct, distance))
    labelled = distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("group")
    )
    smallest = labelled.groupBy("group").agg(F.min("least").alias("component"))
    known = checkpoint(labelled.join(smallest, "group").select("fp", "group", "component"))
    return marked.join(known, "fp").select("id", "fp", "th", "group", "component")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-equal SimHash fingerprints over all documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )

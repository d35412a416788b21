"""Near-duplicate vectors: Euclidean p-stable hashing proposes pairs, exact cosines decide.

On unit vectors a cosine is a Euclidean distance.  A hash is a random projection,
shifted and cut into cells of one width; a table keys a vector by several hashes.
The number of hashes per table follows from the number of vectors, so that chance
bucket mates stay few, and the number of tables from the wanted recall of a pair
that lies right at the threshold (nearer pairs are found more surely).
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow, mixed, stored, table
from .components import connected_components

COSINE = 0.95
WIDTH = 2.0
#: Of pairs exactly at the threshold, the share that at least one table brings together.
RECALL = 0.99
#: A cosine that unrelated vectors stay below, as a rule; only used to set the number of hashes.
UNRELATED = 0.3
#: Unrelated bucket mates of a vector in one table.
MATES = 0.1
SEED = 20_240_601


def collision(distance: float, width: float) -> float:
    """Chance that two points this far apart share a cell of one projection."""
    r = width / distance
    below = 0.5 * (1 + erf(-r / sqrt(2)))
    return 1 - 2 * below - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


def tables_for(n: int, cosine: float = COSINE, width: float = WIDTH, recall: float = RECALL) -> tuple[int, int]:
    """Hashes per table and number of tables for ``n`` vectors."""
    near = collision(sqrt(2 - 2 * cosine), width)
    far = collision(sqrt(2 - 2 * UNRELATED), width)
    hashes = max(1, ceil(log(max(n, 2) / MATES) / -log(far)))
    return hashes, ceil(log(1 - recall) / log(1 - near**hashes))


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row offsets of a column of lists."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), offsets - offsets[0]


def unit_vectors(classes: DataFrame) -> DataFrame:
    """``rep, unit``: the vectors at length one, in doubles; scaled by their largest component first."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            values, offsets = _matrix(b.column(1))
            lengths = np.diff(offsets)
            values /= np.repeat(np.maximum.reduceat(np.abs(values), offsets[:-1]), lengths)
            values /= np.repeat(np.sqrt(np.add.reduceat(values * values, offsets[:-1])), lengths)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))], names=["rep", "unit"])

    return arrow(classes.select("rep", "vector"), step, "rep bigint, unit array<double>")


def bucketed(units: DataFrame, hashes: int, tables: int, width: float) -> DataFrame:
    """``t, key, rep``: one row per vector and table.  Vectors of different length never share a key."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                b = whole.slice(start, 2000)
                values, offsets = _matrix(b.column(1))
                lengths, reps = np.diff(offsets), b.column(0).to_numpy()
                for size in np.unique(lengths):
                    if size not in planes:
                        random = np.random.default_rng([SEED, int(size)])
                        planes[size] = random.standard_normal((size, hashes * tables)), random.uniform(0, width, hashes * tables)
                    chosen = np.flatnonzero(lengths == size)
                    x = values[(offsets[chosen][:, None] + np.arange(size)).ravel()].reshape(-1, size)
                    cells = np.floor((x @ planes[size][0] + planes[size][1]) / width).astype(np.int64).view(np.uint64)
                    key = np.full((len(chosen), tables), size, np.uint64)
                    for k in range(hashes):
                        key = mixed(key * np.uint64(31) + cells.reshape(-1, tables, hashes)[:, :, k])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.tile(np.arange(tables, dtype=np.int32), len(chosen))),
                            pa.array(key.ravel().view(np.int64)),
                            pa.array(np.repeat(reps[chosen], tables)),
                        ],
                        names=["t", "key", "rep"],
                    )

    return arrow(units, step, "t int, key bigint, rep bigint")


def cosine_links(units: DataFrame, n: int, cosine: float = COSINE, width: float = WIDTH, recall: float = RECALL) -> DataFrame:
    """Pairs ``a < b`` whose cosine is ``cosine`` or more, each once."""
    hashes, tables = tables_for(n, cosine, width, recall)
    rows = bucketed(units, hashes, tables, width)
    left = rows.select("t", "key", F.col("rep").alias("a"))
    right = rows.select(F.col("t").alias("t2"), F.col("key").alias("key2"), F.col("rep").alias("b"))
    same = (F.col("t") == F.col("t2")) & (F.col("key") == F.col("key2")) & (F.col("a") < F.col("b"))
    pairs = left.hint("shuffle_merge").join(right, same).select("a", "b").distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            (x, at), (y, _) = _matrix(b.column(2)), _matrix(b.column(3))
            near = np.add.reduceat(x * y, at[:-1]) >= cosine
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(near))

    first = units.select(F.col("rep").alias("a"), F.col("unit").alias("x"))
    second = units.select(F.col("rep").alias("b"), F.col("unit").alias("y"))
    met = pairs.join(first, "a").join(second, "b").where(F.size("x") == F.size("y")).select("a", "b", "x", "y")
    return arrow(met, verify, "a bigint, b bigint")


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``id, n_links, component`` per row of ``rows``.

    Equal vectors are one class before any pair is made; links between classes
    count once per member.  A vector that is null, empty, zero, or holds a null
    or non-finite component links with nothing, not even with an equal one; nor
    does a row with a null id (its component is null).  Rows that share an id
    get a row each.  Vectors of different length never link.  Other columns are
    ignored.
    """
    value = F.col("vector")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = F.col("id").isNotNull() & value.isNotNull() & finite & F.exists(value, lambda v: v != 0)
    chosen = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    chosen = chosen.withColumn("good", F.coalesce(good, F.lit(False)))
    usable = chosen.where("good").select("id", "vector")
    classes = stored(usable.groupBy("vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    units = stored(unit_vectors(classes), "vector-units")
    found = stored(cosine_links(units, units.count(), cosine), "vector-links")
    copies = classes.select("rep", "copies")
    both = found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(copies.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    components = connected_components(found)
    known = (
        classes.join(others, F.col("rep") == F.col("a"), "left")
        .join(components, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("vector").alias("value"),
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    known = stored(known, "vector-known")
    linked = usable.join(known, F.col("vector") == F.col("value")).select("id", "n_links", "component")
    alone = chosen.where("NOT good").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    return linked.union(alone)


def op2_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components at cosine 0.95 over all embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )

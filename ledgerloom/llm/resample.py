"""Importance resampling of documents towards a target collection.

Separators are collapsed to single spaces, so that a run of n words is one match of a
regular expression held by boundary lookarounds; an overlapped scan then gives the span
of every run, and the CRC of a span is its feature.  Features are counted in hashed
buckets over all documents and over the target, each bucket gets the logarithm of how
much likelier the target is, and documents are drawn by weight plus Gumbel noise, which
is sampling without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import BEFORE, positions
from .common import PLAIN, arrow, slices, stored, table, texts

GRAMS = 1
BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10


def patterns(grams: int) -> list[regex.Pattern]:
    """For each n up to ``grams`` the runs of n words of collapsed text."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}" % (n - 1)) for n in range(1, grams + 1)]


def feature_crcs(text: bytes, scans: list[regex.Pattern]) -> tuple[int, np.ndarray]:
    """The number of words, and the CRC of every run of words, repeats included."""
    plain = b" ".join(text.translate(PLAIN).split())
    found = [np.fromiter((crc32(m[0]) for m in scan.finditer(plain, overlapped=True)), np.uint32) for scan in scans]
    return len(found[0]), np.concatenate(found)


def features(rows: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``id, n_words, n_features, places`` per row of (id, text); places are the buckets, as little-endian uint32."""
    scans = patterns(grams)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [feature_crcs(t, scans) for t in texts(b.column(1)).cast(pa.large_binary()).to_pylist()]
            places = [(f % np.uint32(buckets)).astype("<u4").tobytes() for _, f in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([len(f) for _, f in found], pa.int64()), pa.array(places, pa.binary())],
                names=["id", "n_words", "n_features", "places"],
            )

    return arrow(rows, step, "id bigint, n_words bigint, n_features bigint, places binary")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket, added up in the tasks first; ``buckets`` numbers reach the driver."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for b in batches:
            for places in b.column(0).to_pylist():
                counts += np.bincount(np.frombuffer(places, "<u4"), minlength=buckets)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(counts[full])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in arrow(found.select("places"), step, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, 1000 times the log ratio of its add-one shares in target and source, floored."""
    size, all_s, all_t = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (all_s + size) / ((s + 1.0) * (all_t + size)))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``id, n_words, n_features, weight``: the floored mean gain of a row's features, 0 without any."""
    shared = found.sparkSession.sparkContext.broadcast(gain)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            sums = [int(table[np.frombuffer(p, "<u4")].sum()) for p in b.column(3).to_pylist()]
            weight = [s // n if n else 0 for s, n in zip(sums, b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(weight, pa.int64())], names=["id", "n_words", "n_features", "weight"])

    return arrow(found, step, "id bigint, n_words bigint, n_features bigint, weight bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    grams: int = GRAMS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``id, n_features, weight, score, rank`` per row of ``docs``; rank is null where a row is not drawn.

    Of the rows with ``min_words`` words or more the best ``percent`` percent by score are
    drawn, ties to the smaller id, a null id first; rows that share an id and a score take
    ranks one after another, the one with less features, then less weight, first.  A null text has no words, weight 0 and
    is never drawn.  A null id hashes as empty text.  Empty tables give empty results; other
    columns are ignored.  The documents are scanned once; later steps read the buckets.
    """
    found = stored(features(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")), grams, buckets), "resample")
    aim = features(target.select(F.lit(None).cast("bigint").alias("id"), F.col(target_col).alias("text")), grams, buckets)
    rows = weighted(found, gains(bucket_counts(found, buckets), bucket_counts(aim, buckets)))
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(draw, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(-1000.0 * F.log(-F.log(share)))
    scored = stored(rows.withColumn("score", F.col("weight") + noise), "resample-scores")

    # Equal rows are one row with a count, so that no value fills a range of the ranking.
    order = ["worst", "id", "n_features", "weight"]
    able = scored.where(F.col("n_words") >= min_words).withColumn("worst", -F.col("score"))
    placed = positions(able.groupBy(*order).agg(F.count(F.lit(1)).alias("n")), order, weights=["n"])
    take = scored.where(F.col("n_words") >= min_words).count() * percent // 100
    place = F.explode(F.sequence(F.col(BEFORE + "n") + 1, F.col(BEFORE + "n") + F.col("n"))).alias("place")
    ranked = placed.select("id", "n_features", "weight", (-F.col("worst")).alias("score"), place)
    others = scored.where(F.col("n_words") < min_words).select("id", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    return ranked.select("id", "n_features", "weight", "score", F.when(F.col("place") <= take, F.col("place")).alias("rank")).union(others)


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents of 20 words or more, drawn towards the benchmark."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")

"""Shared pieces of the corpus operators: inputs, scratch tables, words, Arrow steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import scratch_path

#: Words are runs of anything but these six ASCII white-space characters.
SPACES = "[\\x20\\x09-\\x0D]+"
#: Byte by byte: A-Z to lower case, other ASCII but digits and letters to a space; what lies beyond ASCII stays.
PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(key: str, buckets: int) -> Column:
    """crc32 of the key as text, modulo ``buckets``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % buckets


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them where ``df`` has such columns (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later steps then start from files every executor can reach, whatever
    executors are lost, and see one fixed result.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(step, schema)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def lists(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def texts(column: pa.Array) -> pa.Array:
    """The column as UTF-8 bytes with 64-bit offsets; null is empty."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def split_words(column: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of a text column in order, and the number of words of each row."""
    parts = pc.ascii_split_whitespace(texts(column))
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(column)), np.diff(parts.offsets.to_numpy()))
    words = flat.filter(pa.array(full))
    if lower:  # only now: lower-casing goes wrong on an array that is a slice of another
        words = pc.ascii_lower(words)
    return words, np.bincount(rows[full], minlength=len(column))


def word_hashes(words: pa.Array, hasher: Callable[[bytes], int]) -> np.ndarray:
    """A 64-bit hash per word; each distinct word of the batch is hashed once."""
    coded = pc.dictionary_encode(words)
    distinct = np.fromiter(
        (hasher(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(coded.dictionary)
    )
    return distinct[coded.indices.to_numpy()] if len(distinct) else np.zeros(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500, chars: int = 4_000_000, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows and, but for single long texts, about ``chars`` bytes of text."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i in range(b.num_rows):
            if i > start and (i - start >= rows or total + size[i] > chars):
                yield b.slice(start, i - start)
                start, total = i, 0
            total += int(size[i])
        yield b.slice(start)

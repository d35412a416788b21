"""Exact removal of passages that repeat across documents, behind a count-min prefilter.

A window is a run of ``window`` words.  Its anchor is the smallest hash among
the ``anchor``-word grams inside it, so equal windows have equal anchors, and an
anchor is met at least as often as any window it stands for.  Pass one counts
anchors in a count-min sketch per task; the sketches are added up block by block.
Pass two keeps the windows whose anchor is estimated to be met twice or more,
groups them exactly by a 128-bit hash, and marks all but the smallest document's.
Sketch cells only ever count too much, so no repeated window is lost; a sketch
too small for its corpus lets more windows through to the exact step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow, lists, mixed, partitions, slices, split_words, table, word_hashes

WINDOW = 50
ANCHOR = 16
#: Two rows of 2^26 cells; a cell is one bit ("twice or more") once merged: 16 MB to every task, whatever the corpus.
ROW_BITS = 26
BLOCK_BITS = 20
#: Windows a task gathers before it settles them among themselves.
FLUSH = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_BASE2 = 0xD1B54A32D192ED03
_INVERSE = {b: pow(b, -1, 1 << 64) for b in (_BASE, _BASE2)}


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _rolling(values: np.ndarray, width: int, base: int = _BASE) -> np.ndarray:
    """A polynomial hash, modulo 2^64, of every run of ``width`` values."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(_INVERSE[base], n), out=sums[1:])
    return (sums[width:] - sums[:-width]) * _powers(base, n - width + 1)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Windows:
    """The windows of a batch of documents: row, word position, anchor, and on demand the 128-bit hash."""

    def __init__(self, column: pa.Array, window: int, anchor: int):
        words, self.counts = split_words(column)
        self.window = window
        self.hashes = word_hashes(words, lambda w: xxhash.xxh64_intdigest(w, 7))
        rows = np.repeat(np.arange(len(column), dtype=np.int32), self.counts)
        starts = np.zeros(len(column) + 1, np.int64)
        np.cumsum(self.counts, out=starts[1:])
        n = len(rows)
        if n < window:
            self.at = self.row = self.pos = np.zeros(0, np.int64)
            self.anchors = np.zeros(0, np.uint64)
            return
        self.at = np.flatnonzero(rows[: n - window + 1] == rows[window - 1 :])
        self.row = rows[self.at]
        self.pos = (self.at - starts[self.row]).astype(np.int32)
        grams = mixed(_rolling(self.hashes, anchor))
        self.anchors = _sliding_min(grams, window - anchor + 1)[self.at]

    def pair(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of the hash of the chosen windows."""
        at = self.at[chosen]
        h = self.hashes
        following = np.append(h[1:], np.uint64(0))
        first = _rolling(mixed(h * np.uint64(3) + mixed(following)), self.window - 1)[at]
        second = _rolling(mixed(h ^ np.uint64(_BASE2)), self.window, _BASE2)[at]
        return mixed(first), mixed(second)


def _cells(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - ROW_BITS)
    first = (mixed(anchors ^ np.uint64(_BASE)) >> shift).astype(np.uint32)
    second = (mixed(anchors * np.uint64(_BASE2)) >> shift).astype(np.uint32) + np.uint32(1 << ROW_BITS)
    return first, second


def repeated_cells(docs: DataFrame, window: int, anchor: int) -> bytes:
    """Bit per sketch cell: was it met twice or more?  Counts every document of ``docs`` (id, text)."""
    per_block = 1 << BLOCK_BITS

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush():
            cells, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            edges = np.searchsorted(cells, np.arange(0, (2 << ROW_BITS) + 1, per_block))
            blocks, once, more = [], [], []
            for k in np.flatnonzero(np.diff(edges)):
                part = slice(edges[k], edges[k + 1])
                inside = (cells[part] & np.uint32(per_block - 1)).astype("<u4")
                blocks.append(int(k))
                once.append(inside[n[part] == 1].tobytes())
                more.append(inside[n[part] > 1].tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())], names=["block", "once", "more"]
            )

        for b in slices(batches):
            w = Windows(b.column(1), window, anchor)
            if not len(w.at):
                continue
            new = np.ones(len(w.at), bool)  # neighbouring windows of a document with one anchor are one meeting of it
            new[1:] = (w.anchors[1:] != w.anchors[:-1]) | (w.row[1:] != w.row[:-1])
            held.extend(_cells(w.anchors[new]))
            if sum(map(len, held)) > FLUSH:
                yield flush()
        if held:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for b in batches:
            for block, once, more in zip(*(c.to_pylist() for c in b.columns)):
                c = counts.setdefault(block, np.zeros(per_block, np.uint8))
                one = np.frombuffer(once, "<u4")
                c[one] = np.minimum(c[one] + 1, 2)
                c[np.frombuffer(more, "<u4")] = 2
        if counts:
            bits = [np.packbits(c == 2, bitorder="little").tobytes() for c in counts.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(bits, pa.binary())], names=["block", "bits"])

    parts = arrow(docs, sketch, "block int, once binary, more binary").repartition("block")
    size = per_block // 8
    out = bytearray((2 << ROW_BITS) // 8)
    for r in arrow(parts, merge, "block int, bits binary").toLocalIterator():  # 128 rows of 128 kB at most
        out[r["block"] * size : (r["block"] + 1) * size] = r["bits"]
    return bytes(out)


_ROWS = "route int, done boolean, blob binary"


def _routed(routes: np.ndarray, many: int, *fields: np.ndarray, done: bool) -> pa.RecordBatch:
    """One row per route: the number of entries and the fields, one after another.  ``routes`` is rising."""
    edges = np.searchsorted(routes, np.arange(many + 1))
    full = np.flatnonzero(np.diff(edges))
    blobs = [
        b"".join([(edges[k + 1] - edges[k]).astype("<i8").tobytes(), *(f[edges[k] : edges[k + 1]].tobytes() for f in fields)]) for k in full
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), done)), pa.array(blobs, pa.binary())], names=["route", "done", "blob"]
    )


def _fields(blob: bytes, *kinds: str) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(blob, "<i8", 1)[0]), 8, []
    for kind in kinds:
        out.append(np.frombuffer(blob, kind, n, at))
        at += out[-1].nbytes
    return out


def _covered(docs: np.ndarray, ths: np.ndarray, pos: np.ndarray, routes: int) -> pa.RecordBatch:
    """Covered window starts, routed by their document."""
    to = (mixed(docs.view(np.uint64) ^ mixed(ths.view(np.uint64))) % np.uint64(routes)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    return _routed(to[order], routes, docs[order], ths[order], pos[order].astype("<i4"), done=True)


def _by_document(docs: np.ndarray, ths: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """One row per document."""
    order = np.lexsort((pos, ths, docs))
    docs, ths, pos = docs[order], ths[order], pos[order].astype("<i4")
    cut = np.flatnonzero(np.append(True, (docs[1:] != docs[:-1]) | (ths[1:] != ths[:-1])))
    blobs = [pos[a:b].tobytes() for a, b in zip(cut, np.append(cut[1:], len(docs)))]
    return pa.RecordBatch.from_arrays([pa.array(docs[cut]), pa.array(ths[cut]), pa.array(blobs, pa.binary())], names=["doc", "th", "starts"])


def _settle(h1: np.ndarray, h2: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by hash and document; which of the ordered windows belong to the smallest document of their hash."""
    order = np.lexsort((docs, h2, h1))
    a, b, d = h1[order], h2[order], docs[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1] if len(a) else d
    return order, d == least


def covered_windows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """``doc, th, starts``: little-endian int32 starts of the document's windows that also start in a smaller one.

    A task first settles its own windows, so of a window met by many documents
    each task sends one on.  Entries travel packed, a row per route.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(repeated_cells(docs, window, anchor))
    routes = 4 * partitions(spark)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(bits.value, np.uint8)
        held: list[tuple] = []

        def flush():
            h1, h2, ids, ths, pos = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order, first = _settle(h1, h2, ids)
            yield _covered(ids[order][~first], ths[order][~first], pos[order][~first], routes)
            keep = order[first]  # still in the order of h1: one run per route
            h1, h2, ids, ths, pos = h1[keep], h2[keep], ids[keep], ths[keep], pos[keep].astype("<i4")
            yield _routed((h1 >> np.uint64(33)).astype(np.int64) * routes >> 31, routes, h1, h2, ids, ths, pos, done=False)

        def tested(anchors):
            hit = np.ones(len(anchors), bool)
            for c in _cells(anchors):
                hit &= (seen[c >> np.uint32(3)] >> (c & np.uint32(7)).astype(np.uint8)) & 1 == 1
            return hit

        for b in slices(batches):
            w = Windows(b.column(1), window, anchor)
            chosen = np.flatnonzero(tested(w.anchors))
            if len(chosen):
                h1, h2 = w.pair(chosen)
                rows = w.row[chosen]
                held.append((h1, h2, b.column(0).to_numpy()[rows], b.column(2).to_numpy()[rows], w.pos[chosen]))
                if sum(len(x[0]) for x in held) > FLUSH:
                    yield from flush()
        if held:
            yield from flush()

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        found: list[tuple] = []
        current = None

        def settle():
            h1, h2, ids, ths, pos = (np.concatenate(x) for x in zip(*(_fields(b, "<u8", "<u8", "<i8", "<i8", "<i4") for b in held)))
            held.clear()
            order, first = _settle(h1, h2, ids)
            found.append((ids[order][~first], ths[order][~first], pos[order][~first]))

        def flush():
            out = _covered(*(np.concatenate(x) for x in zip(*found)), routes)
            found.clear()
            return out

        for b in batches:
            done = b.column(1).to_numpy(zero_copy_only=False)
            for route, blob in zip(*(c.filter(pa.array(~done)).to_pylist() for c in (b.column(0), b.column(2)))):
                if route != current and held:
                    settle()
                    if sum(len(x[0]) for x in found) > FLUSH:
                        yield flush()
                current = route
                held.append(blob)
            if done.any():
                yield b.filter(pa.array(done))
        if held:
            settle()
        if found:
            yield flush()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        current = None

        def flush():
            out = _by_document(*(np.concatenate(x) for x in zip(*(_fields(b, "<i8", "<i8", "<i4") for b in held))))
            held.clear()
            return out

        for b in batches:
            for route, blob in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if route != current and held:
                    yield flush()
                current = route
                held.append(blob)
        if held:
            yield flush()

    def by_route(df: DataFrame) -> DataFrame:
        return df.repartition(partitions(spark), "route").sortWithinPartitions("route")

    return arrow(by_route(arrow(by_route(arrow(docs, find, _ROWS)), group, _ROWS)), gather, "doc bigint, th bigint, starts binary")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """``id, n_words, n_removed, kept`` per row: the text without passages that a smaller document also has.

    A word goes if a window over it, as a sequence of words, also starts in a
    document with a smaller id; windows are judged on the input.  ``kept`` is
    the remaining words joined by one space.  Null texts have no words.  Rows
    with a null id are not compared and keep all words; rows that share an id do
    not repeat each other.  Other columns are ignored.
    """
    chosen = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    chosen = chosen.withColumn("th", F.xxhash64("text"))
    found = covered_windows(chosen.where("id IS NOT NULL AND text IS NOT NULL").select("id", "text", "th"), window, anchor)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            words, counts = split_words(b.column(1))
            ends = np.cumsum(counts)
            covered = np.zeros(len(words), bool)
            for i, starts in enumerate(b.column(2).to_pylist()):
                if starts:
                    base, n, at = ends[i] - counts[i], counts[i], np.frombuffer(starts, "<i4")
                    steps = np.zeros(n + window + 1, np.int32)
                    np.add.at(steps, at, 1)
                    np.add.at(steps, at + window, -1)
                    covered[base : base + n] = np.cumsum(steps)[:n] > 0
            rows = np.repeat(np.arange(b.num_rows), counts)
            removed = np.bincount(rows[covered], minlength=b.num_rows)
            kept = words.filter(pa.array(~covered))
            joined = pc.binary_join(lists(kept, counts - removed), pa.scalar(" ", pa.large_string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts.astype(np.int64)), pa.array(removed.astype(np.int64)), joined], names=["id", "n_words", "n_removed", "kept"]
            )

    both = chosen.join(found, (chosen["id"] == found["doc"]) & (chosen["th"] == found["th"]), "left").select("id", "text", "starts")
    return arrow(both, cut, "id bigint, n_words bigint, n_removed bigint, kept string")


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 50 words or more that a smaller document has."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )

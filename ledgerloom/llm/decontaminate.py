"""Benchmark passages in documents, found by greedy string tiling.

Items and documents share seeds (runs of ``minimum`` tokens); a pair goes on if
its seeds could cover enough of the item.  Tiling then marks the longest common
runs that do not overlap, again and again, finding them by running Karp-Rabin
hashes, down to ``minimum`` tokens.  Coverage is the share of the item's tokens
under tiles, so a passage whose parts were put in another order still counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow, mixed, slices, stored, table, texts, word_hashes

MINIMUM = 4
COVERAGE = 0.6
#: Tokens of benchmark items that are broadcast at a time; the documents are read once per block.
BLOCK_TOKENS = 1_000_000

#: Odd, so that powers can be undone modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_BREAKS = "[\\x00-/:-@\\[-`{-\\x7f]+"


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words (ASCII punctuation and white space part words), and words per row."""
    clean = pc.utf8_lower(texts(column))
    parts = pc.split_pattern_regex(clean, _BREAKS)
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(column)), np.diff(parts.offsets.to_numpy()))
    hashes = word_hashes(flat.filter(pa.array(full)), lambda w: xxhash.xxh64_intdigest(w, 3))
    return hashes, np.bincount(rows[full], minlength=len(column))


def seeds(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` tokens."""
    n = max(0, len(hashes) - length + 1)
    out = np.full(n, length, np.uint64)
    for k in range(length):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return out


def _running(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Sums of the values times rising powers, modulo 2^64; a run's Karp-Rabin hash is a difference of two."""
    return np.append(np.uint64(0), np.cumsum(values * powers[: len(values)], dtype=np.uint64))


def _windows(running: np.ndarray, powers: np.ndarray, used: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the runs of ``length`` tokens that no tile has taken from."""
    n = len(running) - length
    taken = np.append(0, np.cumsum(used))
    at = np.flatnonzero(taken[length:] == taken[:n]) if n > 0 else np.zeros(0, np.int64)
    # All runs are brought to one power, so that equal runs have equal hashes wherever they start.
    return at, (running[at + length] - running[at]) * powers[len(powers) - 1 - at]


def tile(item: Sequence[int], text: Sequence[int], minimum: int = MINIMUM) -> list[tuple[int, int, int]]:
    """Tiles ``(place in item, place in text, length)`` of greedy string tiling.

    The longest common run of free tokens is marked, of several the first in the
    item and then the first in the text, until none of ``minimum`` tokens is
    left.  Its length is found by bisection over Karp-Rabin hashes, as a common
    run holds common runs of all smaller lengths, and all tiles of a length are
    marked in one sweep: at most the root of twice the item's tokens lengths
    occur, each at a cost linear in both texts but for sorting the item's runs.
    """
    a, b = np.array(item, np.uint64), np.array(text, np.uint64)
    powers = np.cumprod(np.append(np.uint64(1), np.full(max(len(a), len(b)), _BASE, np.uint64)), dtype=np.uint64)
    sums_a, sums_b = _running(a, powers), _running(b, powers)
    used_a, used_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    out: list[tuple[int, int, int]] = []

    def common(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places and hashes of free runs of the item, and of those of the text that the item has."""
        at_a, hash_a = _windows(sums_a, powers, used_a, length)
        at_b, hash_b = _windows(sums_b, powers, used_b, length)
        shared = np.isin(hash_b, hash_a)
        return at_a, hash_a, at_b[shared], hash_b[shared]

    minimum = max(minimum, 1)
    longest = min(len(a), len(b))
    while longest >= minimum:
        low, high, found = minimum - 1, longest, None
        step = minimum
        while low < high:  # a hash met by chance only makes the length too large
            middle = min(step, high)
            got = common(middle)
            if len(got[2]):
                low, found = middle, got
                step = middle * 2 if high == longest else (low + high + 1) // 2
            else:
                high = middle - 1
                step = (low + high + 1) // 2
        if found is None:
            break
        at_a, hash_a, at_b, hash_b = found
        order = np.argsort(hash_b, kind="stable")
        keys, first = np.unique(hash_b[order], return_index=True)
        places, last = at_b[order], np.append(first[1:], len(order))
        where = np.minimum(np.searchsorted(keys, hash_a), len(keys) - 1)
        nxt = first.copy()  # a place that was taken stays taken
        for i, k in zip(at_a[keys[where] == hash_a].tolist(), where[keys[where] == hash_a].tolist()):
            if used_a[i : i + low].any():
                continue
            for p in range(nxt[k], last[k]):
                j = int(places[p])
                taken = bool(used_b[j : j + low].any())
                if not taken and np.array_equal(a[i : i + low], b[j : j + low]):
                    used_a[i : i + low] = used_b[j : j + low] = True
                    out.append((i, j, low))
                    nxt[k] = p + 1
                    break
                if taken and p == nxt[k]:
                    nxt[k] = p + 1
        longest = low - 1
    return sorted(out)


class Items:
    """A block of benchmark items with an index of their seeds."""

    def __init__(self, ids: list[int | None], hashes: list[np.ndarray], minimum: int):
        self.ids, self.hashes, self.minimum = ids, hashes, minimum
        self.sizes = np.array([len(h) for h in hashes])
        keys, owner, place = [], [], []
        for k, h in enumerate(hashes):
            s = seeds(h, min(minimum, len(h)))
            keys.append(s)
            owner.append(np.full(len(s), k))
            place.append(np.arange(len(s)))
        key = np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        self.owner, self.place = np.concatenate(owner)[order], np.concatenate(place)[order]
        self.keys, self.first = np.unique(key[order], return_index=True)
        self.last = np.append(self.first[1:], len(order))
        self.lengths = sorted({min(minimum, len(h)) for h in hashes})

    def hits(self, hashes: np.ndarray, counts: np.ndarray, coverage: float) -> Iterator[tuple[int, int, np.ndarray]]:
        """Row, item, and the places in the document of shared seeds, per pair whose seeds could reach the coverage.

        A row's seeds are counted once each however often they occur, so a row
        meets at most the places of the block.
        """
        starts = np.cumsum(counts) - counts
        rows = np.repeat(np.arange(len(counts)), counts)
        found = []
        for length in self.lengths:
            s = seeds(hashes, length)
            at = np.minimum(np.searchsorted(self.keys, s), len(self.keys) - 1)
            hit = np.flatnonzero((self.keys[at] == s) & (rows[: len(s)] == rows[length - 1 :]))
            found.append(np.stack([rows[hit], at[hit], hit - starts[rows[hit]]]))
        row, key, j = np.concatenate(found, axis=1)
        order = np.argsort(row, kind="stable")
        row, key, j = row[order], key[order], j[order]
        cut = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
        for lo, hi in zip(cut, np.append(cut[1:], len(row))):
            mine = np.unique(key[lo:hi])
            many = self.last[mine] - self.first[mine]
            entry = np.repeat(self.first[mine] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            owner, place, of = self.owner[entry], self.place[entry], np.repeat(mine, many)
            # A seed covers at most its own tokens, so few seeds rule an item out at once.
            enough = np.bincount(owner, minlength=len(self.sizes)) * np.minimum(self.sizes, self.minimum) >= coverage * self.sizes
            left = enough[owner]
            owner, place, of = owner[left], place[left], of[left]
            by = np.argsort(owner, kind="stable")
            owner, place, of = owner[by], place[by], of[by]
            edge = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
            for x, y in zip(edge, np.append(edge[1:], len(owner))):
                size = int(self.sizes[owner[x]])
                seen = np.zeros(size, bool)
                seen[place[x:y, None] + np.arange(min(self.minimum, size))] = True
                if seen.sum() >= coverage * size:
                    yield int(row[lo]), int(owner[x]), np.unique(j[lo:hi][np.isin(key[lo:hi], of[x:y])])

    def matches(self, hashes: np.ndarray, counts: np.ndarray, coverage: float) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """Row, item and tiles (places in document tokens) of the pairs that reach the coverage."""
        starts = np.cumsum(counts) - counts
        for row, k, j in self.hits(hashes, counts, coverage):
            item = self.hashes[k]
            length = min(self.minimum, len(item))
            # Only tokens under shared seeds can lie in a tile; gaps between runs of them become one token of no item.
            at = np.unique(j[:, None] + np.arange(length))
            gap = np.flatnonzero(np.diff(at) > 1) + 1
            text = np.insert(hashes[starts[row] + at], gap, np.uint64(0))
            back = np.insert(at, gap, -1)
            tiles = tile(item, text, length)
            if sum(n for _, _, n in tiles) >= coverage * len(item):
                yield row, k, [(a, int(back[b]), n) for a, b, n in tiles]


_ITEMS = "id bigint, hashes binary, part int, before bigint, n bigint"


def _coded(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Items with their token hashes and the tokens before them in their task; those without tokens are left out."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for b in slices(batches):
            hashes, counts = tokens(b.column(1))
            ends = np.cumsum(counts)
            full = counts > 0
            packed = [hashes[e - n : e].tobytes() for e, n in zip(ends[full], counts[full])]
            columns = b.column(0).filter(pa.array(full)), packed, np.full(len(packed), part, np.int32), before + (ends - counts)[full], counts[full]
            yield pa.RecordBatch.from_arrays(
                [columns[0], pa.array(packed, pa.binary()), *[pa.array(c, k) for c, k in zip(columns[2:], (pa.int32(), pa.int64(), pa.int64()))]],
                names=[f.split()[0] for f in _ITEMS.split(", ")],
            )
            before += len(hashes)

    return stored(arrow(benchmark.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")), step, _ITEMS), "items")


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, minimum: int) -> Iterator[Items]:
    """Blocks of about ``BLOCK_TOKENS`` tokens, at most one item more.

    Tasks make the tokens; the driver gets one number per task and hands on a
    block at a time.
    """
    coded = _coded(benchmark, id_col, text_col)
    sizes = {r["part"]: r["n"] for r in coded.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    ends = np.cumsum([sizes[p] for p in sorted(sizes)], dtype=np.int64)
    shift = {p: int(e) - sizes[p] for p, e in zip(sorted(sizes), ends)}
    if not shift:
        return
    shifts = F.create_map(*[F.lit(x) for pair in shift.items() for x in pair])
    numbered = coded.withColumn("block", F.floor((F.col("before") + F.try_element_at(shifts, F.col("part"))) / BLOCK_TOKENS))
    for number in range(int(ends[-1]) // BLOCK_TOKENS + 1):
        rows = numbered.where(F.col("block") == number).select("id", "hashes").collect()
        if rows:
            yield Items([r["id"] for r in rows], [np.frombuffer(r["hashes"], np.uint64) for r in rows], minimum)


_PAIRS = "id bigint, item bigint, item_tokens bigint, covered bigint, coverage double, tiles array<struct<item_at: int, doc_at: int, length: int>>"


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    minimum: int = MINIMUM,
    coverage: float = COVERAGE,
) -> DataFrame:
    """``id, item, item_tokens, covered, coverage, tiles`` per document and item that it covers.

    An item shorter than ``minimum`` tokens must occur as a whole.  Null and
    empty texts and items without tokens match nothing; an item with a null id
    matches like any other, its ``item`` being null.
    Documents keep null and repeated ids, row by row; other columns are ignored.
    Documents are never shuffled; the benchmark is broadcast in bounded blocks,
    all of whose pairs are looked at.
    """
    chosen = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    out = None
    for block in _blocks(benchmark, item_col, item_text_col, minimum):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            kind = pa.list_(pa.struct([("item_at", pa.int32()), ("doc_at", pa.int32()), ("length", pa.int32())]))
            for b in slices(batches):
                rows = []
                for row, k, tiles in items.matches(*tokens(b.column(1)), coverage):
                    covered = sum(n for _, _, n in tiles)
                    size = len(items.hashes[k])
                    rows.append((b.column(0)[row].as_py(), items.ids[k], size, covered, covered / size, [dict(item_at=a, doc_at=d, length=n) for a, d, n in tiles]))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), kind)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["id", "item", "item_tokens", "covered", "coverage", "tiles"])

        part = arrow(chosen, step, _PAIRS)
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], _PAIRS) if out is None else out


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", minimum: int = MINIMUM, coverage: float = COVERAGE
) -> DataFrame:
    """The rows of ``docs`` that cover no benchmark item, unchanged; as in ``contaminated``."""
    at = docs.columns.index(text_col)
    for block in _blocks(benchmark, item_col, item_text_col, minimum):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, column=at):
                clean = np.ones(b.num_rows, bool)
                clean[[row for row, _, _ in shared.value.matches(*tokens(b.column(at)), coverage)]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(step, docs.schema)
    return docs


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and its coverage."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "item_tokens", "covered", "coverage", F.size("tiles").alias("n_tiles"))

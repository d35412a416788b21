"""Packing documents into token sequences of one capacity: bin completion, branch and bound.

Only the number of pieces per length matters to the packing, and there are fewer
lengths than the capacity, so the search runs on that histogram, whatever the
corpus.  A bin is built around the largest piece left; its undominated fillings
are enumerated, largest pieces first, and a branch is cut when the waste so far
shows that it cannot beat the best packing known, at first that of best fit.  A filling is used as
often as the counts allow at once.  The search changes one histogram in place and
takes its changes back, and remembers digests of states, so that its memory does
not grow with the number of lengths times the depth.  Documents then find their place from their
rank among the pieces of their length.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence
from functools import cache
from hashlib import blake2b
from itertools import accumulate
import base64
import json
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow, slices, stored, table, texts

CAPACITY = 2048
#: Steps (pieces tried in bins, and bins) after which the search stands by the best packing so far.
SEARCH_STEPS = 1_000_000
#: Partial packings kept, as digests of 16 bytes, to be told again; more of them are searched anew.
SEEN = 200_000

Filling = tuple[tuple[int, int], ...]


def fillings(counts: Mapping[int, int], sizes: Sequence[int], gap: int, spare: int, steps: Iterator[int]) -> Iterator[Filling]:
    """Undominated ways to fill ``gap`` from the counted sizes that waste at most ``spare``, largest pieces first.

    ``sizes`` are those with a count, rising.  A filling is dominated, and left
    out, if a piece that is still there fits beside it, or fits in place of a
    smaller one of its pieces: the piece taken out fits wherever the other was.
    Each step takes one from ``steps``; the ways end with them.  ``counts`` may
    change between two ways if it is back before the next is asked for.
    """
    held = array("q", accumulate((s * counts[s] for s in sizes), initial=0))

    def undominated(chosen: Sequence[tuple[int, int]], room: int) -> bool:
        left = dict(chosen)
        # The smallest piece still there must not fit beside, nor the next larger one in place of each piece.
        for small in (0, *left):
            for k in range(bisect_right(sizes, small), len(sizes)):
                if sizes[k] - small > room:
                    break
                if counts[sizes[k]] > left.get(sizes[k], 0):
                    return False
        return True

    # Depth first without recursion: (sizes below this place, room, pieces chosen).
    frames: list[tuple[int, int, tuple[tuple[int, int], ...]]] = [(len(sizes), gap, ())]
    while frames and next(steps, None) is not None:
        below, room, chosen = frames.pop()
        at = min(below, bisect_right(sizes, room))
        if at == 0:
            if room <= spare and undominated(chosen, room):
                yield chosen
            continue
        if room - held[at] > spare:
            continue  # all that is left cannot fill enough
        size = sizes[at - 1]
        for n in range(min(counts[size], room // size) + 1):  # the most pieces are looked at first
            frames.append((at - 1, room - n * size, (*chosen, (size, n)) if n else chosen))


def best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best fit, largest pieces first, for all pieces of a size and all bins of one content at once."""
    bins: dict[int, dict[Filling, int]] = {}  # by the room that is left
    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            room = min((g for g, held in bins.items() if g >= size and held), default=capacity)
            held = bins.get(room, {})
            filling, many = held.popitem() if held else ((), n)
            per = room // size  # a bin just added to is the fullest that fits, so it takes all it can
            whole = min(many, n // per)
            last = n - whole * per if whole < many else 0  # pieces of a bin that stays unfilled
            for times, k in ((whole, per), (1 if last else 0, last)):
                if times:
                    rest = bins.setdefault(room - k * size, {})
                    key = (*filling, (size, k))
                    rest[key] = rest.get(key, 0) + times
            untouched = many - whole - (1 if last else 0)
            if filling and untouched:
                held[filling] = held.get(filling, 0) + untouched
            n -= whole * per + last
    return [(filling, times) for held in bins.values() for filling, times in held.items()]


def least_bins(counts: Mapping[int, int], capacity: int) -> int:
    """A number of bins that no packing undercuts: for each small size, what pieces that it cannot join must waste."""
    if not counts:
        return 0
    sizes = np.array(sorted(s for s, n in counts.items() if n > 0), np.int64)
    many = np.array([counts[s] for s in sizes.tolist()], np.int64)
    pieces, tokens = np.append(0, np.cumsum(many)), np.append(0, np.cumsum(many * sizes))
    half = int(np.searchsorted(sizes, capacity // 2, "right"))  # sizes from here on share no bin with each other
    small = np.append(0, sizes[:half])
    over = np.maximum(np.searchsorted(sizes, capacity - small, "right"), half)  # from here on, no small piece fits beside
    shared = pieces[over] - pieces[half]
    room = capacity * shared - (tokens[over] - tokens[half])
    rest = tokens[half] - tokens[np.minimum(np.searchsorted(sizes, small), half)]
    bins = pieces[-1] - pieces[over] + shared + np.maximum(0, -((room - rest) // capacity))
    return max(int(bins.max()), -(-int(tokens[-1]) // capacity))


def pack_counts(counts: Mapping[int, int], capacity: int = CAPACITY, search_steps: int = SEARCH_STEPS) -> list[tuple[Filling, int]]:
    """Fillings and how often each is used; every counted piece is placed, in the fewest bins.

    The search ends when the bound is met or all is proven; after
    ``search_steps`` it ends before, with the best packing so far.
    """
    left = {s: n for s, n in sorted(counts.items()) if n > 0}
    total = sum(s * n for s, n in left.items())
    fewest = least_bins(left, capacity)
    best = best_fit(left, capacity)
    best_bins = sum(times for _, times in best)
    if best_bins == fewest:
        return best
    steps = iter(range(search_steps))
    seen: dict[bytes, int] = {}

    def take(filling: Filling, times: int) -> None:
        for s, n in filling:
            left[s] -= n * times

    def choices(waste: int) -> Iterator[tuple[Filling, int, int]]:
        """Bins around the largest piece, as many at once as the counts allow, then fewer."""
        largest = max(s for s, n in left.items() if n)
        one = ((largest, 1),)
        take(one, 1)
        ways = fillings(left, array("q", (s for s, n in left.items() if n)), capacity - largest, (best_bins - 1) * capacity - total - waste, steps)
        while (filling := next(ways, None)) is not None:
            take(one, -1)
            whole: dict[int, int] = {largest: 1}
            for s, n in filling:
                whole[s] = whole.get(s, 0) + n
            wasted = capacity - sum(s * n for s, n in whole.items())
            for times in range(min(left[s] // n for s, n in whole.items()), 0, -1):
                yield tuple(sorted(whole.items(), reverse=True)), times, wasted
            take(one, 1)
        take(one, -1)

    # Depth first without recursion: a frame is (bins, waste, chosen so far, open choices).  ``left`` is what the
    # last frame leaves; the choice that led to a frame is put back when it ends.
    frames = [(0, 0, None, choices(0))]
    while frames and next(steps, None) is not None:
        bins, waste, path, rest = frames[-1]
        step = next(rest, None)
        if step is None:
            frames.pop()
            if path:
                take(path[1], -path[2])
            continue
        filling, times, wasted = step
        new_bins, new_waste = bins + times, waste + times * wasted
        if new_waste > (best_bins - 1) * capacity - total:
            continue  # more waste than one bin fewer would have
        take(filling, times)
        new_path = (path, filling, times)
        if new_bins * capacity - new_waste < total:
            # What is left was met before in no more bins, or needs too many.
            key = blake2b(np.fromiter(left.values(), np.int64, len(left)).tobytes(), digest_size=16).digest()
            if seen.get(key, best_bins) <= new_bins or new_bins + least_bins(left, capacity) >= best_bins:
                take(filling, -times)
                continue
            if len(seen) < SEEN:
                seen[key] = new_bins
            frames.append((new_bins, new_waste, new_path, choices(new_waste)))
            continue
        take(filling, -times)
        if new_bins < best_bins:
            best, best_bins = [], new_bins
            while new_path:
                best.append((new_path[1], new_path[2]))
                new_path = new_path[0]
            best.reverse()
            if best_bins == fewest:
                break
    return best


@cache
def encoder(ranks_file: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte-pairs", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


#: White space beside a space: there, cutting at the space would change the tokens.
_UNSAFE = re.compile(r"\s | \s")


class Tokens:
    """Token ids of texts.  A space between two other characters always starts a token, so texts are cut
    there and each distinct cut is encoded once; texts with other white space beside a space,
    or with a string in ``added``, go whole.  Added tokens are found before all others."""

    def __init__(self, ranks_file: str, pattern: str, added: Mapping[str, int] = {}):
        self.ordinary = encoder(ranks_file, pattern).encode_ordinary
        self.added = dict(added)
        # Of added tokens that start at one place the longest counts.
        names = "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))
        self.split = re.compile(f"({names})") if names else None
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        if self.split is None:
            return self.ordinary(text)
        parts = self.split.split(text)
        return [x for k, part in enumerate(parts) for x in ([self.added[part]] if k % 2 else self.ordinary(part))]

    def __call__(self, column: pa.Array) -> list[np.ndarray]:
        column = texts(column)
        whole = np.array([bool(_UNSAFE.search(t)) for t in column.to_pylist()], bool)
        for token in self.added:
            whole |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(pc.if_else(pa.array(whole), "", column), " ")
        coded = pc.dictionary_encode(parts.flatten())
        index, counts = coded.indices.to_numpy(), np.diff(parts.offsets.to_numpy())
        first = np.zeros(len(index), bool)
        first[np.cumsum(counts) - counts] = True
        spaced = np.unique(index[~first])
        ids: list[list[int]] = [[]] * len(coded.dictionary)
        names = coded.dictionary.to_pylist()
        for i in spaced:
            cut = " " + names[i]
            got = self.known.get(cut)
            if got is None:
                got = self.known[cut] = self.ordinary(cut)
            ids[i] = got
        if len(self.known) > 200_000:
            self.known.clear()
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for got in ids for x in got), np.uint32, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        out, at = [], 0
        for row, n in enumerate(counts):
            if whole[row]:
                out.append(np.array(self.encode(column[row].as_py()), "<u4"))
            else:
                rest = index[at + 1 : at + n]
                head = np.array(self.ordinary(names[index[at]]), "<u4")
                out.append(np.concatenate([head, flat[_ragged(starts[rest], sizes[rest])]]).astype("<u4"))
            at += n
        return out


_PIECES = "id bigint, piece int, start bigint, length bigint, crc bigint, part int, nth bigint"


def pieces(docs: DataFrame, ranks_file: str, pattern: str, end_id: int, capacity: int, added: Mapping[str, int] = {}) -> DataFrame:
    """Pieces of every document, each with its task (``part``) and its rank among the task's pieces of that length."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = Tokens(ranks_file, pattern, added), TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)
        for b in slices(batches):
            rows: list[tuple] = []
            for key, ids in zip(b.column(0).to_pylist(), encode(b.column(1))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                cut = len(ids) % capacity if len(ids) > capacity else len(ids)
                edges = [0] * (cut > 0) + list(range(cut, len(ids) + 1, capacity))
                for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
                    rows.append((key, k, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes()), part, int(met[hi - lo])))
                    met[hi - lo] += 1
            names = [f.split()[0] for f in _PIECES.split(", ")]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return arrow(docs, step, _PIECES)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    ranks_file: str | None = None,
    pattern: str | None = None,
    end_id: int = 0,
    added: Mapping[str, int] | None = None,
) -> DataFrame:
    """``id, piece, start, length, crc, sequence_id, offset`` per piece.

    A document is its token ids and ``end_id``; a null text is empty.  Documents
    of over ``capacity`` tokens are cut into full pieces after a first one that
    may be shorter.  Null and repeated ids and copies are packed row by row;
    other columns are ignored; an empty table gives no sequence.  A string in
    ``added`` is one token wherever a text spells it out; with the default
    vocabulary these are the added tokens of its tokenizer file.
    """
    if ranks_file is None or pattern is None:
        import public_tokenizers

        if ranks_file is None and added is None:
            with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
                added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        ranks_file = ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    chosen = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    cut = stored(pieces(chosen, ranks_file, pattern, end_id, capacity, added or {}), "pieces")
    per_task = stored(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}

    # Where the pieces of each length go, by rank: [rank, ...) -> first sequence, pieces per sequence, offset.
    used: dict[int, int] = dict.fromkeys(counts, 0)
    spans: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for filling, times in pack_counts(counts, capacity):
        offset = 0
        for size, n in filling:
            spans.append((size, used[size], sequence, n, offset))
            used[size] += n * times
            offset += n * size
        sequence += times
    spans.sort()
    places = docs.sparkSession.sparkContext.broadcast(np.array(spans, np.int64).reshape(-1, 5))  # by length, not by document

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    ranked = cut.join(shifts, ["part", "length"]).select("id", "piece", "start", "length", "crc", (F.col("shift") + F.col("nth")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = places.value
        for b in batches:
            if not b.num_rows:
                continue
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.empty(len(length), np.int64)
            for size in np.unique(length):
                lo, hi = np.searchsorted(table_[:, 0], [size, size + 1])
                mine = length == size
                at[mine] = lo + np.searchsorted(table_[lo:hi, 1], rank[mine], "right") - 1
            _, first, sequence_, per, offset = table_[at].T
            nth = rank - first
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequence_ + nth // per), pa.array(offset + nth % per * length)],
                names=["id", "piece", "start", "length", "crc", "sequence_id", "offset"],
            )

    return arrow(ranked, place, "id bigint, piece int, start bigint, length bigint, crc bigint, sequence_id bigint, offset bigint")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents")).withColumnsRenamed({"id": "doc_id", "crc": "ids_crc32"})

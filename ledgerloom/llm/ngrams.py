"""Language-model scores by deleted interpolation of bigram and unigram estimates.

Documents are gathered into chunks of about a million tokens, coded with a
vocabulary of their own.  A chunk sends each distinct word and word pair once,
with its number of training occurrences, to the task that owns the hash range;
totals come back the same way.  Nothing is sent per token, a frequent word costs
one entry per chunk, and what is gathered grows with the corpus.

p(w | v) = l2 c(v, w) / c(v) + l1 c(w) / N + l0 / (V + 1), with one set of weights
per bucket of c(v), the power of two it lies under.  The weights come from
expectation-maximisation on held-out counts: every training token is held out in
turn, that is, taken off the counts that predict it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow, bucket, mixed, partitions, slices, split_words, stored, table, word_hashes

#: Tokens after which a chunk is closed (it always holds whole documents).
CHUNK = 1_500_000
#: Cells of a power of two in the grid on which training tokens are summed up for the weights.
STEPS = 4
BUCKETS = 64
ROUNDS = 100

_SEED = 11
#: Not the hash of a word: a word holds no space.
_END = np.uint64(xxhash.xxh64_intdigest(b" end", _SEED))
_START = np.uint64(xxhash.xxh64_intdigest(b" start", _SEED))


def _pack(a: np.ndarray) -> bytes:
    """Little-endian, bytes of equal weight together, compressed."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.copy() if len(a) else a
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(blob: bytes, dtype: str) -> np.ndarray:
    kind = np.dtype(dtype)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).ravel()


_CHUNKS = "chunk bigint, ids array<bigint>, held array<boolean>, lens array<int>, toks binary, vocab binary, counts binary"


def chunked(docs: DataFrame) -> DataFrame:
    """Chunks of documents (id, text, held): token numbers, and the chunk's vocabulary with its training counts."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        made, part = 0, TaskContext.get().partitionId()

        def flush():
            nonlocal made
            hashes = np.concatenate([x[0] for x in held])
            lens = np.concatenate([x[1] for x in held])
            ids = pa.concat_arrays([x[2] for x in held])
            out = pa.concat_arrays([x[3] for x in held])
            held.clear()
            training = np.repeat(~out.to_numpy(zero_copy_only=False), lens)
            vocab, numbers = np.unique(hashes, return_inverse=True)
            total = np.bincount(numbers, minlength=len(vocab))
            by_use = np.argsort(-total, kind="stable")  # frequent words get small numbers
            place = np.empty(len(vocab), np.uint32)
            place[by_use] = np.arange(len(vocab), dtype=np.uint32)
            counts = np.bincount(numbers[training], minlength=len(vocab)).astype("<u4")
            made += 1
            row = [
                pa.array([(part << 24) + made], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), out),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(lens.astype(np.int32))),
                pa.array([_pack(place[numbers].astype("<u4"))], pa.binary()),
                pa.array([vocab[by_use].astype("<u8").tobytes()], pa.binary()),
                pa.array([_pack(counts[by_use])], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(row, names=["chunk", "ids", "held", "lens", "toks", "vocab", "counts"])

        size = 0
        for b in slices(batches):
            words, n = split_words(b.column(1), lower=True)
            ends = np.cumsum(n)
            hashes = np.insert(word_hashes(words, lambda w: xxhash.xxh64_intdigest(w, _SEED)), ends, _END)
            held.append((hashes, n + 1, b.column(0), b.column(2)))
            size += len(hashes)
            if size >= CHUNK:
                yield flush()
                size = 0
        if held:
            yield flush()

    return arrow(docs, step, _CHUNKS)


def _pairs(toks: np.ndarray, lens: np.ndarray, vocab: np.ndarray) -> np.ndarray:
    """A hash of each token with the one before it."""
    hashes = vocab[toks]
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[np.cumsum(lens) - lens] = _START
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + hashes)


def totals(chunks: DataFrame, pairs: bool) -> DataFrame:
    """``chunk, route, kind, blob``: training totals of each chunk's words (or pairs), in the order of their hashes.

    Keys travel as differences of sorted hashes.  A row with a null chunk has, in ``distinct`` and ``total``, the share of one
    hash range in the number of distinct keys seen in training and of all tokens.
    """
    spark = chunks.sparkSession
    width = max(1, (4 * partitions(spark) - 1).bit_length())
    routes = 1 << width

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                keys, counts = np.frombuffer(r["vocab"], "<u8"), _unpack(r["counts"], "<u4")
                if pairs:
                    toks, lens = _unpack(r["toks"], "<u4"), np.array(r["lens"])
                    training = np.repeat(~np.array(r["held"]), lens)
                    keys, at = np.unique(_pairs(toks, lens, keys), return_inverse=True)
                    counts = np.bincount(at[training], minlength=len(keys))
                else:
                    order = np.argsort(keys)
                    keys, counts = keys[order], counts[order]
                edges = np.searchsorted(keys >> np.uint64(64 - width), np.arange(routes + 1))
                full = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full.astype(np.int32)),
                        pa.array(np.full(len(full), r["chunk"])),
                        pa.array([_pack(np.diff(keys[edges[k] : edges[k + 1]], prepend=np.uint64(0)).astype("<u8")) for k in full], pa.binary()),
                        pa.array([_pack(counts[edges[k] : edges[k + 1]].astype("<u4")) for k in full], pa.binary()),
                    ],
                    names=["route", "chunk", "keys", "counts"],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current = None

        def flush():
            each = [np.cumsum(_unpack(k, "<u8"), dtype=np.uint64) for _, k, _ in held]
            keys = np.concatenate(each)
            counts = np.concatenate([_unpack(c, "<u4") for _, _, c in held])
            distinct, at = np.unique(keys, return_inverse=True)
            summed = np.bincount(at, weights=counts, minlength=len(distinct)).astype("<u8")
            ends = np.cumsum([len(k) for k in each])
            blobs = [_pack(part) for part in np.split(summed[at], ends[:-1])]
            n = len(held)
            columns = [
                pa.array([h[0] for h in held] + [None], pa.int64()),
                pa.array([current] * (n + 1), pa.int32()),
                pa.array([pairs] * (n + 1), pa.bool_()),
                pa.array([*blobs, None], pa.binary()),
                pa.array([None] * n + [int((summed > 0).sum())], pa.int64()),
                pa.array([None] * n + [int(summed.sum())], pa.int64()),
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "route", "pairs", "blob", "distinct", "total"])

        for b in batches:
            for route, chunk, keys, counts in zip(*(c.to_pylist() for c in b.columns)):
                if route != current and held:
                    yield flush()
                current = route
                held.append((chunk, keys, counts))
        if held:
            yield flush()

    columns = ["chunk", "lens", "held", "toks", "vocab", "counts"] if pairs else ["chunk", "vocab", "counts"]
    sent = arrow(chunks.select(*columns), send, "route int, chunk bigint, keys binary, counts binary")
    owned = sent.repartition(partitions(spark), "route").sortWithinPartitions("route")
    return arrow(owned, add, "chunk bigint, route int, pairs boolean, blob binary, distinct bigint, total bigint")


_KNOWN = "chunk bigint, ids array<bigint>, held array<boolean>, lens array<int>, toks binary, words binary, pairs binary, starts bigint"


def counted(chunks: DataFrame, replies: DataFrame) -> DataFrame:
    """Chunks with the totals of their words and of the pair that ends at each token."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = {name: b.column(i)[k].as_py() for i, name in enumerate(b.schema.names)}
                found = {p: [_unpack(x["blob"], "<u8") for x in sorted((y for y in r["replies"] if y["pairs"] == p), key=lambda y: y["route"])] for p in (False, True)}
                vocab, toks, lens = np.frombuffer(r["vocab"], "<u8"), _unpack(r["toks"], "<u4"), np.array(r["lens"])
                words = np.empty(len(vocab), np.uint64)
                words[np.argsort(vocab)] = np.concatenate(found[False])
                _, at = np.unique(_pairs(toks, lens, vocab), return_inverse=True)
                pairs = np.concatenate(found[True])[at]
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).slice(k, 1) for i in range(5)]
                    + [pa.array([_pack(words.astype("<u8"))], pa.binary()), pa.array([_pack(pairs.astype("<u8"))], pa.binary()), pa.array([int(words[vocab == _END][0])], pa.int64())],
                    names=["chunk", "ids", "held", "lens", "toks", "words", "pairs", "starts"],
                )

    grouped = replies.where("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list(F.struct("pairs", "route", "blob")).alias("replies"))
    both = chunks.select("chunk", "ids", "held", "lens", "toks", "vocab").join(grouped, "chunk")
    return stored(arrow(both, step, _KNOWN), "lm-counts")


class _Tokens:
    """Per token of a chunk: the counts of the word, of its context and of both together."""

    def __init__(self, r: dict):
        self.lens = np.array(r["lens"])
        toks, words = _unpack(r["toks"], "<u4"), _unpack(r["words"], "<u8").astype(np.float64)
        self.pair = _unpack(r["pairs"], "<u8").astype(np.float64)
        self.word = words[toks]
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[np.cumsum(self.lens) - self.lens] = r["starts"]
        self.held = np.repeat(np.array(r["held"]), self.lens)


def _of_context(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(np.maximum(context, 0))[1], BUCKETS - 1)  # 0 for 0, else the power of two above


def learn_weights(known: DataFrame, n: int, v: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (bucket, three) by expectation-maximisation.

    The posterior of a token depends on its bucket and on the ratios of the
    three estimates alone.  Tokens are counted on a grid of those (``STEPS``
    cells per power of two), whose size does not depend on the corpus; the
    rounds run on the counts.
    """
    limit = 128 * STEPS

    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for b in batches:
            for r in b.to_pylist():
                t = _Tokens(r)
                train = ~t.held
                context, pair, word = t.context[train] - 1, t.pair[train] - 1, t.word[train] - 1
                with np.errstate(divide="ignore", invalid="ignore"):
                    two = np.where(context > 0, pair / np.maximum(context, 1), 0.0) * (v + 1)
                    one = word / max(n - 1, 1) * (v + 1)
                    cell = lambda x: np.where(x > 0, np.clip(np.round(np.log2(x) * STEPS) + limit // 2, 1, limit - 1), 0).astype(np.int64)
                    keys, counts = np.unique((_of_context(context).astype(np.int64) * limit + cell(two)) * limit + cell(one), return_counts=True)
                for k, c in zip(keys.tolist(), counts.tolist()):
                    total[k] = total.get(k, 0) + c
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["cell", "n"])

    sums = arrow(known, grid, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    weights = np.tile(np.array([0.3, 0.6, 0.1]), (BUCKETS, 1))
    rows = np.array([(r["cell"], r["n"]) for r in sums.collect()], np.int64).reshape(-1, 2)
    of, rest = np.divmod(rows[:, 0], limit * limit)
    two, one = np.divmod(rest, limit)
    back = lambda c: np.where(c > 0, 2.0 ** ((c - limit // 2) / STEPS), 0.0)
    estimates, count = np.stack([back(two), back(one), np.ones(len(of))], 1), rows[:, 1].astype(np.float64)
    for _ in range(rounds):
        share = estimates * weights[of]
        share *= (count / share.sum(1))[:, None]
        new = np.stack([np.bincount(of, share[:, i], BUCKETS) for i in range(3)], 1) + 1e-3
        weights = np.where(np.bincount(of, count, BUCKETS)[:, None] > 0, new / new.sum(1, keepdims=True), weights)
    weights[0] = np.append(0.0, weights[0, 1:] / weights[0, 1:].sum())  # a context never met has no pairs
    return weights


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """Model and unigram log10 probability of each text.

    Learns from rows whose id's crc32 is not 0 modulo ``folds`` and scores all.
    A text is its words, A-Z lower-cased, and one end; null is empty.  A null
    id has the crc32 of empty text, 0, so it is held out.  Repeated ids and
    copies are scored, and learned from, row by row.  Other columns are ignored.
    Without any training row the model is uniform.
    """
    chosen = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), (bucket(id_col, folds) == 0).alias("held"))
    chunks = stored(chunked(chosen), "lm-chunks")
    words = stored(totals(chunks, pairs=False), "lm-words")
    pairs = totals(chunks, pairs=True)
    size = words.where("chunk IS NULL").agg(F.sum("distinct").alias("v"), F.sum("total").alias("n")).first()
    v, n = int(size["v"] or 0), int(size["n"] or 0)
    known = counted(chunks, words.unionByName(pairs))
    weights = learn_weights(known, n, v)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = {name: b.column(i)[k].as_py() for i, name in enumerate(b.schema.names) if name not in ("ids",)}
                t = _Tokens(r)
                w = weights[_of_context(t.context)]
                p = w[:, 0] * t.pair / np.maximum(t.context, 1) + w[:, 1] * t.word / max(n, 1) + w[:, 2] / (v + 1)
                first = np.cumsum(t.lens) - t.lens
                base = np.log10((t.word + 0.1) / (n + 0.1 * (v + 1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(1).slice(k, 1).flatten(),
                        b.column(2).slice(k, 1).flatten(),
                        pa.array(t.lens.astype(np.int64)),
                        pa.array(np.add.reduceat((t.word > 0).astype(np.int64), first)),
                        pa.array(np.add.reduceat(base, first)),
                        pa.array(np.add.reduceat(np.log10(p), first)),
                    ],
                    names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    scored = arrow(known, score, "id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(n).cast("bigint"))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleted-interpolation scores of all documents."""
    return score_documents(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )

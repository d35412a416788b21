"""Exact ranked search: documents as impact vectors in buckets of falling length.

A score is the inner product of an item's vector and a document's.  Documents are
sorted by the length of their vectors and cut into buckets.  Once the k-th best score
of an item is known to be at least theta, the Cauchy-Schwarz inequality rules out every
document, and so every later bucket, whose length is below theta over the length of the
item.  Inside a bucket the coordinates in which the item is heavy are added up, and the
rest is bounded by the product of what is left of both lengths.  What survives is scored
exactly, in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import BEFORE, positions
from .common import PLAIN, arrow, partitions, slices, stored, table, texts

TOP = 10
#: The saturation and length parameters of the score, in hundredths and thousandths.
LENGTH_SHARE = 75
SATURATION = 8
IMPACT = 1_000_000_000
#: Documents to a bucket.
BUCKET = 1024
#: Distinct terms, added up over items, that are searched for in one pass over the documents: some 60 MB to every task.
BLOCK_TERMS = 1_000_000
#: Coordinates are added up until what is left of an item is below this part of its squared length.
LEFT = 0.3
#: Against rounding in lengths and bounds; scores are integers.
SLACK = 1 + 1e-9
_NO_ID = np.iinfo(np.int64).max


class Items(NamedTuple):
    """A block of items: vocabulary, and per item its row, terms and how often it has each."""

    vocabulary: dict[bytes, int]
    rows: list[int]
    terms: list[np.ndarray]
    counts: list[np.ndarray]


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, id, entries, terms, counts`` per item, stored; ``row`` is unique."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms, counts = [], []
            for text in texts(b.column(2)).cast(pa.large_binary()).to_pylist():
                found = sorted(text.translate(PLAIN).split())
                firsts = [i for i, t in enumerate(found) if not i or t != found[i - 1]]
                terms.append([found[i] for i in firsts])
                counts.append(np.diff([*firsts, len(found)]).tolist() if found else [])
            sizes = pa.array([len(t) for t in terms], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), sizes, pa.array(terms, pa.list_(pa.binary())), pa.array(counts, pa.list_(pa.int64()))],
                names=["row", "id", "entries", "terms", "counts"],
            )

    chosen = items.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return stored(arrow(chosen, step, "row bigint, id bigint, entries bigint, terms array<binary>, counts array<bigint>"), "search-items")


def item_blocks(items: DataFrame, size: int) -> Iterator[Items]:
    """The items in blocks of about ``size`` entries; only a longer item makes a larger block."""
    entries = items.agg(F.coalesce(F.sum("entries"), F.lit(0)).alias("n")).first()["n"]
    if entries > size:
        placed = stored(positions(items, ["row"], weights=["entries"]).withColumn("block", F.floor(F.col(BEFORE + "entries") / size)), "search-blocks")
        numbers = range(placed.agg(F.max("block").alias("n")).first()["n"] + 1)
        parts = (placed.where(F.col("block") == n) for n in numbers)
    else:
        parts = iter([items])
    for part in parts:
        vocabulary: dict[bytes, int] = {}
        rows, terms, counts = [], [], []
        for r in part.where("entries > 0").select("row", "terms", "counts").collect():
            rows.append(r["row"])
            terms.append(np.array([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r["terms"]], np.int32))
            counts.append(np.array(r["counts"], np.int64))
        yield Items(vocabulary, rows, terms, counts)


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``id, part, n, terms, tfs`` per document of (id, text): all its terms counted, those of the vocabulary kept."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, part = known.value.get, 0
        for b in slices(batches):
            sizes, terms, tfs = [], [], []
            for text in texts(b.column(1)).cast(pa.large_binary()).to_pylist():
                words = text.translate(PLAIN).split()
                codes, n = np.unique(np.array([c for c in map(place, words) if c is not None], np.int32), return_counts=True)
                sizes.append(len(words))
                terms.append(codes.astype("<i4").tobytes())
                tfs.append(n.astype("<i4").tobytes())
            parts = np.arange(part, part + b.num_rows, dtype=np.int32)
            part += b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(parts), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                names=["id", "part", "n", "terms", "tfs"],
            )

    return stored(arrow(docs, step, "id bigint, part int, n bigint, terms binary, tfs binary"), "search-terms")


def document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents per term of the vocabulary, added up in the tasks first."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                counts[np.frombuffer(t, "<i4")] += 1
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(counts[full])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for r in arrow(vectors.select("terms"), step, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def norm_buckets(vectors: DataFrame, weights: np.ndarray, documents: int, words: int, bucket: int) -> DataFrame:
    """``place, longest, blob`` per bucket: impact vectors in order of falling length, ``place`` counting from 0 in each range.

    A coordinate is the impact times the root of the term's weight, the other root goes to
    the items; that makes the bound tight for a document that is the item.
    """
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(weights)

    def impacts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value.astype(np.float64)
        for b in batches:
            out, lengths = [], []
            for n, terms, tfs in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()):
                m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // words
                tf = np.frombuffer(tfs, "<i4").astype(np.int64)
                x = (IMPACT * tf) // (1000 * tf + SATURATION * m)
                lengths.append(math.sqrt(float((weight[np.frombuffer(terms, "<i4")] * x.astype(np.float64) ** 2).sum())))
                out.append(x.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lengths, pa.float64()), b.column(3), pa.array(out, pa.binary())],
                names=["id", "part", "length", "terms", "impacts"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        place = 0

        def flush():
            nonlocal place
            ids, lengths, terms, x = zip(*held)
            sizes = np.array([len(t) // 4 for t in terms], "<i4")
            blob = b"".join([len(held).to_bytes(8, "little"), np.array(ids, "<i8").tobytes(), np.array(lengths, "<f8").tobytes(), sizes.tobytes(), *terms, *x])
            out = pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([lengths[0]]), pa.array([blob], pa.binary())], names=["place", "longest", "blob"])
            place += 1
            held.clear()
            return out

        for b in batches:
            ids = b.column(0).fill_null(_NO_ID)
            for row in zip(*(c.to_pylist() for c in (ids, b.column(2), b.column(3), b.column(4)))):
                held.append(row)
                if len(held) == bucket:
                    yield flush()
        if held:
            yield flush()

    lengths = arrow(vectors.where("n > 0"), impacts, "id bigint, part int, length double, terms binary, impacts binary").where("length > 0")
    # Copies have one length, and rows may share an id as well: the row's place in its task keeps them apart.
    order = [F.col("length").desc(), F.col("id"), F.col("part")]
    sorted_rows = lengths.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    return stored(arrow(sorted_rows, pack, "place int, longest double, blob binary"), "search-buckets")


class Bucket:
    """A bucket's documents, and its impacts by term."""

    def __init__(self, blob: bytes):
        n, at = int.from_bytes(blob[:8], "little"), 8
        self.ids = np.frombuffer(blob, "<i8", n, at)
        self.lengths = np.frombuffer(blob, "<f8", n, at + 8 * n)
        sizes = np.frombuffer(blob, "<i4", n, at + 16 * n)
        total, at = int(sizes.sum()), at + 20 * n
        terms = np.frombuffer(blob, "<i4", total, at)
        order = np.argsort(terms, kind="stable")
        self.terms = terms[order]
        self.docs = np.repeat(np.arange(n), sizes)[order]
        self.impacts = np.frombuffer(blob, "<i4", total, at + 4 * total)[order].astype(np.int64)

    def postings(self, terms: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents and impacts of the terms' postings, and the term's value for each."""
        starts, ends = np.searchsorted(self.terms, terms), np.searchsorted(self.terms, terms, side="right")
        sizes = ends - starts
        at = np.repeat(starts - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
        return self.docs[at], self.impacts[at], np.repeat(values, sizes)


class Query:
    """An item's terms, heaviest coordinates first, and what is left of its length behind the leading ones."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray):
        useful = weights[terms] > 0
        terms, counts = terms[useful], counts[useful]
        w = weights[terms]
        squares = counts.astype(np.float64) ** 2 * w
        order = np.argsort(-squares, kind="stable")
        self.terms, self.factors, self.weights = terms[order], (counts * w)[order], w[order].astype(np.float64)
        rest = np.cumsum(squares[order][::-1])[::-1]  # squared length from each coordinate on
        self.length = math.sqrt(rest[0]) if len(rest) else 0.0
        self.leading = int(np.searchsorted(-rest, -LEFT * rest[0])) if len(rest) else 0
        self.left = math.sqrt(rest[self.leading]) if self.leading < len(rest) else 0.0

    def candidates(self, bucket: Bucket, theta: int) -> np.ndarray:
        """Documents whose score may reach ``theta``."""
        n = int(np.searchsorted(-bucket.lengths, -theta / (self.length * SLACK), side="right"))
        if not n or not theta:
            return np.arange(n)
        lead = slice(0, self.leading)
        docs, x, place = bucket.postings(self.terms[lead], np.arange(self.leading))
        known = np.bincount(docs, self.factors[lead][place] * x.astype(np.float64), len(bucket.ids))[:n]
        used = np.bincount(docs, self.weights[lead][place] * x.astype(np.float64) ** 2, len(bucket.ids))[:n]
        bound = known + self.left * np.sqrt(np.maximum(bucket.lengths[:n] ** 2 * SLACK - used, 0))
        return np.flatnonzero(bound * SLACK >= theta)

    def scores(self, bucket: Bucket, chosen: np.ndarray) -> np.ndarray:
        """The exact scores of the chosen documents."""
        alive = np.zeros(len(bucket.ids), bool)
        alive[chosen] = True
        docs, x, factor = bucket.postings(self.terms, self.factors)
        here = alive[docs]
        out = np.zeros(len(bucket.ids), np.int64)
        np.add.at(out, docs[here], factor[here] * x[here])
        return out[chosen]


def best(buckets: DataFrame, items: Items, weights: np.ndarray, floors: np.ndarray, top: int) -> DataFrame:
    """``row, id, score``: per task and item at most ``top`` of the documents that reach the item's floor."""
    shared = buckets.sparkSession.sparkContext.broadcast((items.rows, items.terms, items.counts, weights, floors))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, terms, counts, w, low = shared.value
        queries = [Query(t, c, w) for t, c in zip(terms, counts)]
        lengths = np.array([q.length for q in queries])
        theta = low.copy()
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        for b in batches:
            for longest, blob in zip(*(b.column(i).to_pylist() for i in (0, 1))):
                open_ = np.flatnonzero((lengths > 0) & (theta <= lengths * longest * SLACK))
                bucket = Bucket(blob) if len(open_) else None
                for i in open_:
                    chosen = queries[i].candidates(bucket, int(theta[i]))
                    if not len(chosen):
                        continue
                    score = queries[i].scores(bucket, chosen)
                    good = score >= max(int(theta[i]), 1)
                    if good.any():
                        s, ids = np.append(held[i][0], score[good]), np.append(held[i][1], bucket.ids[chosen][good])
                        order = np.lexsort((ids, -s))[:top]
                        held[i] = (s[order], ids[order])
                        if len(order) == top:
                            theta[i] = max(theta[i], s[order[-1]])
        for i, (s, ids) in enumerate(held):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), rows[i], np.int64)), pa.array(ids), pa.array(s)], names=["row", "id", "score"])

    return stored(arrow(buckets.select("longest", "blob"), step, "row bigint, id bigint, score bigint"), "search-best")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    bucket: int = BUCKET,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id, rank, id, score``: the ``top`` documents of each item with a score above 0, best first, ties to the smaller id.

    Every row of ``items`` is an item of its own, also where ids repeat or are null.  Null
    texts have no terms; such items get no rows, such documents are in no list.  Rows of
    ``docs`` that share an id are ranked each; a null id comes last among equal scores (the
    largest 64-bit number is kept for it).  Empty tables give empty results; other columns
    are ignored.  Items are looked for in blocks of ``block_terms`` entries, each of which
    reads the documents once; all buckets are searched for all items of a block, first the
    longest bucket of each range, whose k-th best scores are floors for the others.
    """
    listed = item_terms(items, item_id_col, item_text_col)
    texts_of = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    found = None
    for block in item_blocks(listed, block_terms):
        vectors = term_vectors(texts_of, block.vocabulary)
        sizes = vectors.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
        n, words = sizes["documents"], sizes["words"]
        df = document_frequencies(vectors, len(block.vocabulary))
        weights = np.array([math.floor(1000 * math.log((2.0 * n + 2) / (2.0 * d + 1))) for d in df.tolist()], np.int64)
        buckets = norm_buckets(vectors, weights, n, words, bucket)
        first = best(buckets.where("place = 0"), block, weights, np.zeros(len(block.rows), np.int64), top)
        reached = {r["row"]: r["score"] for r in _ranked(first, top).where(F.col("rank") == top).select("row", "score").collect()}
        floors = np.array([reached.get(r, 0) for r in block.rows], np.int64)
        both = first.union(best(buckets.where("place > 0"), block, weights, floors, top))
        found = both if found is None else found.union(both)
    named = _ranked(found, top).join(listed.select("row", F.col("id").alias("item_id")), "row")
    return named.select("item_id", F.col("rank").cast("int").alias("rank"), F.nullif("id", F.lit(int(_NO_ID))).alias("id"), "score")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")

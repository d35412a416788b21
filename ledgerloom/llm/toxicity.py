"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and their character grams, ends marked.  A bounded sample of the
labelled training rows serves as examples, and the terms that tell their classes
apart as vocabulary; how many documents hold a term is counted over all documents.
The index keeps postings per term cut into blocks of examples, with the largest
weight of each block: a block is only scored if its bound can still reach the
k-th best cosine, so the k neighbours are exact.  Their votes, weighted by
distance, become a probability by isotonic regression on the examples' own votes
(each with itself left out).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow, bucket, slices, stored, table

FOLDS = 5
#: Examples per class (toxic, other): the labelled rows whose id hashes lowest.
EXAMPLES = (1500, 3000)
TERMS = 1000
MIN_DOCS = 4
GRAMS = (4, 5, 6)
NEIGHBOURS = 15
BLOCK = 64
#: Blocks scored before bounds are compared with the k-th best cosine.
FIRST_BLOCKS = 4

#: Everything but letters and digits of any script parts words.
_NOT_WORD = r"[^\p{L}\p{N}]+"


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words, and the row of each."""
    clean = pc.utf8_lower(pc.replace_substring_regex(pc.fill_null(column.cast(pa.large_string()), ""), _NOT_WORD, " "))
    parts = pc.split_pattern(clean, " ")
    flat = parts.flatten()
    rows = np.repeat(np.arange(len(column)), np.diff(parts.offsets.to_numpy()))
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    return flat.filter(pa.array(full)), rows[full]


def word_terms(word: str) -> set[str]:
    """The word and its grams; spaces mark its ends."""
    marked = f" {word} "
    return {marked} | {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}


class Vocabulary:
    """Finds the chosen terms in texts: one automaton pass over the distinct words of a batch."""

    def __init__(self, terms: Sequence[str]):
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(terms):
            self.automaton.add_word(t, i)
        if terms:
            self.automaton.make_automaton()
        self.size = len(terms)

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term and number of occurrences, ordered by row and term."""
        words, rows = _words(column)
        none = np.zeros(0, np.int64)
        if not len(words) or not self.size:
            return none, none, none
        coded = pc.dictionary_encode(words)
        distinct = coded.dictionary.to_pylist()
        text = " " + " ".join(distinct) + " "
        hits = list(self.automaton.iter(text))
        if not hits:
            return none, none, none
        at, term = np.array(hits, np.int64).T
        starts = np.cumsum([0, *(len(w) + 1 for w in distinct)])  # of the space before each word
        # A hit that ends on the space after a word belongs to that word.
        of = np.searchsorted(starts, at, "left") - 1
        order = np.argsort(of, kind="stable")
        of, term = of[order], term[order]
        first = np.searchsorted(of, np.arange(len(distinct) + 1))
        index = coded.indices.to_numpy()
        many = first[index + 1] - first[index]
        rows = np.repeat(rows, many)
        shift = np.repeat(first[index] - np.append(0, np.cumsum(many)[:-1]), many)
        keys, n = np.unique(rows * self.size + term[np.arange(len(rows)) + shift], return_counts=True)
        return keys // self.size, keys % self.size, n


def vectors(rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of unit length per row."""
    w = (1 + np.log(counts)) * idf[terms]
    if len(w):
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        norm = np.sqrt(np.add.reduceat(w * w, first))
        w = w / np.repeat(np.maximum(norm, 1e-300), np.diff(np.append(first, len(rows))))
    return w


@dataclass
class BlockMaxIndex:
    """Postings by term; ``edges[t, b]`` is where block ``b`` of term ``t`` starts, ``most[t, b]`` its largest weight."""

    ids: np.ndarray
    labels: np.ndarray
    edges: np.ndarray
    most: np.ndarray
    example: np.ndarray
    weight: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, size: int) -> BlockMaxIndex:
        # Examples led by the same term share blocks, so that bounds differ between blocks.
        lead = np.full(len(ids), size)
        best = np.lexsort((terms, -weights, rows))
        if len(best):
            top = best[np.append(True, rows[best][1:] != rows[best][:-1])]
            lead[rows[top]] = terms[top]
        order = np.lexsort((ids, lead))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        example = place[rows]
        by = np.lexsort((example, terms))
        terms, example, weights = terms[by], example[by], weights[by]
        blocks = -(-len(ids) // BLOCK)
        edges = np.searchsorted(terms * blocks + example // BLOCK, np.arange(size * blocks + 1))
        most = np.zeros(size * blocks)
        np.maximum.at(most, terms * blocks + example // BLOCK, weights)
        return cls(ids[order], labels[order], edges, most.reshape(size, blocks), example, weights)

    def _cosines(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Examples of the blocks and their cosines, from the postings of these terms in these blocks alone."""
        cell = (terms[:, None] * self.most.shape[1] + blocks[None, :]).ravel()
        start, many = self.edges[cell], self.edges[cell + 1] - self.edges[cell]
        total = np.cumsum(many)
        at = np.arange(total[-1] if len(total) else 0) + np.repeat(start - (total - many), many)
        sums = np.bincount(self.example[at], np.repeat(np.repeat(weights, len(blocks)), many) * self.weight[at], len(self.ids))
        found = np.flatnonzero(sums > 0)
        return found, sums[found]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, but: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of largest positive cosine, ties to the smaller id; ``but`` is an id to leave out.

        The blocks of the largest bounds give a first k-th best cosine; of the
        others, those whose bound reaches it are scored too.
        """
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]

        def best(found: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if but is not None:
                keep = self.ids[found] != but
                found, cosine = found[keep], cosine[keep]
            top = np.lexsort((self.ids[found], -np.round(cosine, 12)))[:k]
            return found[top], cosine[top]

        found, cosine = best(*self._cosines(terms, weights, order[:FIRST_BLOCKS]))
        least = cosine[k - 1] - 1e-9 if len(cosine) >= k else 0.0
        rest = order[FIRST_BLOCKS:]
        rest = rest[bound[rest] >= least]
        if len(rest):
            more, near = self._cosines(terms, weights, rest)
            found, cosine = best(np.append(found, more), np.append(cosine, near))
        return found, cosine


def vote(index: BlockMaxIndex, found: np.ndarray, cosine: np.ndarray) -> float:
    """Share of the toxic among the neighbours, weighted by inverse squared distance; far ones count little."""
    weight = 1 / (2 - 2 * np.minimum(cosine, 1) + 0.05)
    return float(weight @ index.labels[found] / (weight.sum() + 0.5 * NEIGHBOURS)) if len(found) else -1.0


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the best rising step function, by pooling adjacent violators."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, w in zip(x[order], y[order], weight[order]):
        pools.append([a, b * w, w, a])
        while len(pools) > 1 and (pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2] or pools[-2][3] == pools[-1][0]):
            last = pools.pop()
            pools[-1] = [pools[-1][0], pools[-1][1] + last[1], pools[-1][2] + last[2], last[3]]
    return np.array([p[3] for p in pools]), np.array([p[1] / p[2] for p in pools])


@dataclass
class Model:
    vocabulary: list[str]
    idf: np.ndarray
    index: BlockMaxIndex | None
    cuts: np.ndarray
    values: np.ndarray

    def votes(self, rows, terms, counts, n: int, leave_out: Sequence[int] | None = None):
        """Vote and neighbours of each of ``n`` rows."""
        w = vectors(rows, terms, counts, self.idf)
        edges = np.searchsorted(rows, np.arange(n + 1))
        known: dict[bytes, tuple] = {}
        for i in range(n):
            part = slice(edges[i], edges[i + 1])
            if self.index is None or edges[i] == edges[i + 1]:
                yield -1.0, np.zeros(0, np.int64), np.zeros(0)
                continue
            key = terms[part].tobytes() + counts[part].tobytes()
            if leave_out is not None or key not in known:
                found, cosine = self.index.nearest(terms[part], w[part], NEIGHBOURS, None if leave_out is None else leave_out[i])
                known[key] = vote(self.index, found, cosine), found, cosine
            yield known[key]

    def score(self, v: float) -> float:
        if not len(self.cuts):
            return 0.0
        return float(self.values[min(np.searchsorted(self.cuts, v, "left"), len(self.cuts) - 1)])


def choose_examples(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """``id, text, toxic`` of the sample, and the number of labelled training rows per class.

    ``per_class`` bounds the sample, so its ids may be broadcast.
    """
    labelled = labels.select(F.col("doc_id").cast("bigint").alias("id"), (F.col("toxic") == 1).cast("int").alias("toxic"))
    labelled = labelled.where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
    there = docs.where("id IS NOT NULL AND NOT held").select("id").distinct()
    training = stored(labelled.join(there, "id"), "toxic-labels")
    size = {r["toxic"]: r["n"] for r in training.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for toxic, most in zip((1, 0), per_class):
        part = training.where(F.col("toxic") == toxic).orderBy(F.xxhash64("id"), "id").limit(most)
        picked = part if picked is None else picked.union(part)
    first = docs.join(F.broadcast(picked), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    return stored(first, "toxic-examples"), size


def choose_terms(examples: DataFrame, terms: int, min_docs: int) -> list[str]:
    """The terms whose shares among toxic and other examples differ most, weighed by the log of their ratio."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        of_word: dict[str, set[str]] = {}
        for b in slices(batches):
            words, rows = _words(b.column(1))
            labels = b.column(2).to_pylist()
            pieces = np.split(np.array(words.to_pylist(), object), np.searchsorted(rows, np.arange(1, b.num_rows)))
            for label, mine in zip(labels, pieces):
                found: set[str] = set()
                for word in set(mine):
                    if word not in of_word:
                        of_word[word] = word_terms(word)
                    found |= of_word[word]
                seen[label].update(found)
            if len(of_word) > 200_000:
                of_word.clear()
        names = list(seen[0].keys() | seen[1].keys())
        if names:
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([seen[1][t] for t in names], pa.int64()), pa.array([seen[0][t] for t in names], pa.int64())], names=["term", "toxic", "other"]
            )

    counts = arrow(examples.select("id", "text", "toxic"), step, "term string, toxic bigint, other bigint")
    n = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    p = (F.col("toxic") + 0.5) / (n.get(1, 0) + 1.0)
    q = (F.col("other") + 0.5) / (n.get(0, 0) + 1.0)
    best = (
        counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where(F.col("toxic") + F.col("other") >= min_docs)
        .orderBy(((p - q) * F.log(p / q)).desc(), "term").limit(terms)
    )
    return sorted(r["term"] for r in best.collect())


def term_counts(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """``id, held, terms, counts`` per row."""
    shared = docs.sparkSession.sparkContext.broadcast(list(vocabulary))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Vocabulary(shared.value)
        for b in slices(batches):
            rows, terms, counts = finder.counts(b.column(1))
            offsets = pa.array(np.searchsorted(rows, np.arange(b.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.ListArray.from_arrays(offsets, pa.array(terms.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))],
                names=["id", "held", "terms", "counts"],
            )

    return arrow(docs.select("id", "text", "held"), step, "id bigint, held boolean, terms array<int>, counts array<int>")


def holding_documents(known: DataFrame, terms: int) -> DataFrame:
    """``term, n``: the number of rows that hold each term, added up in the tasks first."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for b in batches:  # a row lists each of its terms once
            total += np.bincount(b.column(0).flatten().to_numpy(), minlength=terms)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["term", "n"])

    return arrow(known.select("terms"), step, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def _flat(b: pa.RecordBatch, terms: int, counts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    column = b.column(terms)
    rows = np.repeat(np.arange(b.num_rows), np.diff(column.offsets.to_numpy()))
    return rows, column.flatten().to_numpy().astype(np.int64), b.column(counts).flatten().to_numpy().astype(np.int64)


def learn(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = EXAMPLES, terms: int = TERMS) -> tuple[Model, DataFrame]:
    """The model, and the stored term counts of all documents (``id, text, held``)."""
    examples, size = choose_examples(docs, labels, per_class)
    vocabulary = choose_terms(examples, terms, MIN_DOCS)
    known = stored(term_counts(docs, vocabulary), "toxic-terms")
    n = known.count()
    holding = holding_documents(known, len(vocabulary))
    idf = np.full(len(vocabulary), np.log(n + 1.0))
    for r in holding.collect():  # one row per term of the vocabulary
        idf[r["term"]] = np.log((n + 1) / (r["n"] + 0.5))
    own = term_counts(examples.withColumn("held", F.col("toxic") == 1), vocabulary).collect()  # the bounded sample
    model = Model(vocabulary, idf, None, np.zeros(0), np.zeros(0))
    if not own or not vocabulary:
        return model, known
    own.sort(key=lambda r: r["id"])
    ids, toxic = np.array([r["id"] for r in own]), np.array([r["held"] for r in own], np.float64)
    rows = np.repeat(np.arange(len(own)), [len(r["terms"]) for r in own])
    found, counts = np.array([t for r in own for t in r["terms"]], np.int64), np.array([c for r in own for c in r["counts"]], np.int64)
    model.index = BlockMaxIndex.build(ids, toxic, rows, found, vectors(rows, found, counts, idf), len(vocabulary))
    votes = np.array([v for v, _, _ in model.votes(rows, found, counts, len(own), ids)])
    # The sample holds more of the toxic than the labelled rows do.
    share = {y: size.get(y, 0) / max(1, int((toxic == y).sum())) for y in (0, 1)}
    model.cuts, model.values = isotonic(votes, toxic, np.where(toxic == 1, share[1], share[0]))
    return model, known


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS) -> DataFrame:
    """``id, held_out, score, predicted, neighbours`` per row of ``docs``; neighbours are example ids and cosines.

    Learns from labels of rows whose id's crc32 is not 0 modulo ``folds``.  Null
    and empty texts, and texts without any term of the vocabulary, get the score
    of examples without neighbours.  An id with several labels is toxic if any
    says so; null ids, null labels and labels without a document teach nothing.
    A null id is held out.  Without examples every score is 0.  Repeated ids get
    a row each.  Other columns are ignored.
    """
    chosen = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), (bucket(id_col, folds) == 0).alias("held"))
    model, known = learn(chosen, labels)
    shared = known.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            votes = list(m.votes(*_flat(b, 2, 3), b.num_rows))
            scores = [m.score(v) for v, _, _ in votes]
            near = [[{"id": int(m.index.ids[e]), "cosine": float(c)} for e, c in zip(found[:3], cosine[:3])] for _, found, cosine in votes]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                 pa.array(near, pa.list_(pa.struct([("id", pa.int64()), ("cosine", pa.float64())])))],
                names=["id", "held_out", "score", "predicted", "neighbours"],
            )

    return arrow(known, step, "id bigint, held_out boolean, score double, predicted int, neighbours array<struct<id: bigint, cosine: double>>")


def reject_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, unchanged; learned as in ``score_documents``.

    Rows are judged by their text alone, so copies, null ids and repeated ids
    are treated alike.  Texts are not shuffled.
    """
    chosen = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), (bucket(id_col, folds) == 0).alias("held"))
    model, _ = learn(chosen, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        finder = Vocabulary(m.vocabulary)
        for b in slices(batches, column=at):
            votes = m.votes(*finder.counts(b.column(at)), b.num_rows)
            yield b.filter(pa.array([m.score(v) < 0.5 for v, _, _ in votes], pa.bool_()))

    return docs.mapInArrow(step, docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("id", "doc_id")

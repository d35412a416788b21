import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm.search import Bucket, Query, item_blocks, item_terms, search

ITEMS = "item_id bigint, text string, id string, score double"


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    bags = [(i, Counter(w), len(w)) for i, w in ((i, words(t)) for i, t in docs) if w]
    n, total = len(bags), sum(b[2] for b in bags)
    df = Counter(w for _, bag, _ in bags for w in bag)
    out = []
    for item, text in items:
        scores = []
        for i, bag, size in bags:
            m = 25 + (75 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * bag[w]) // (1000 * bag[w] + 8 * m)) for w in words(text) if w in bag)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "id", "score").collect()), key=str)


@pytest.mark.parametrize("bucket, block", [(1024, 1_000_000), (16, 150)])
def test_equals_brute_force(spark, sf_dir, documents, bucket, block):
    """Also in many small buckets, where lengths and coordinates prune, and in many blocks of items."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = rows_of(search(spark.read.parquet(f"{sf_dir}/documents.parquet"), items.limit(12), bucket=bucket, block_terms=block))
    asked = [(r["item_id"], r["text"]) for r in items.limit(12).collect()]
    assert got == brute([(d["doc_id"], d["text"]) for d in documents], asked)


def test_edge_rows(spark, edge_docs):
    items = [(1, "the long text of a line"), (1, "the long text of a line"), (None, "one"), (2, None), (3, ""), (4, "not there"), (5, "ONE one word1 word2 text " * 300)]
    table = spark.createDataFrame([(i, t, "x", 0.5) for i, t in items], ITEMS)
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    for top in (1, 3, 100):
        assert rows_of(search(edge_docs, table, top=top, bucket=2)) == brute(docs, items, top)


def test_empty_tables(spark, edge_docs, no_docs):
    nothing = spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([(1, "line of text", None, None)], ITEMS)
    assert rows_of(search(edge_docs, nothing)) == rows_of(search(no_docs, one)) == rows_of(search(no_docs, nothing)) == []


def test_ties_go_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(i, "same text here") for i in range(300, 0, -1)] + [(0, "another one")], "doc_id bigint, text string")
    got = search(docs, spark.createDataFrame([(1, "same text", None, None)], ITEMS), bucket=7).collect()
    assert [r["id"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 11))


def test_blocks_hold_every_item_once(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i))) for i in range(30)], "item_id bigint, text string")
    blocks = list(item_blocks(item_terms(items, "item_id", "text"), 40))
    assert len(blocks) > 5 and sorted(len(t) for b in blocks for t in b.terms) == list(range(1, 30))


def test_nothing_at_or_above_the_threshold_is_pruned():
    rng = random.Random(5)
    for _ in range(200):
        vocabulary, n = rng.randint(2, 30), rng.randint(1, 40)
        weights = np.array([rng.choice([0, 1, 700, 9_000]) for _ in range(vocabulary)], np.int64)
        docs = []
        for i in range(n):
            terms = np.array(sorted(rng.sample(range(vocabulary), rng.randint(1, vocabulary))), "<i4")
            x = np.array([rng.randint(1, 990_000) for _ in terms], "<i4")
            docs.append((math.sqrt(float((weights[terms] * x.astype(float) ** 2).sum())), i, terms, x))
        docs.sort(key=lambda d: -d[0])
        blob = b"".join([n.to_bytes(8, "little"), np.array([d[1] for d in docs], "<i8").tobytes(), np.array([d[0] for d in docs], "<f8").tobytes(), np.array([len(d[2]) for d in docs], "<i4").tobytes(), *(d[2].tobytes() for d in docs), *(d[3].tobytes() for d in docs)])
        bucket = Bucket(blob)
        terms = np.array(rng.sample(range(vocabulary), rng.randint(1, vocabulary)), np.int32)
        counts = np.array([rng.randint(1, 3) for _ in terms], np.int64)
        query = Query(terms, counts, weights)
        exact = np.array([sum(int(c * weights[t] * d[3][list(d[2]).index(t)]) for t, c in zip(terms, counts) if t in d[2]) for d in docs])
        if not query.length:
            continue
        assert query.scores(bucket, np.arange(n)).tolist() == exact.tolist()
        for theta in sorted({1, *exact.tolist()}):
            if theta > 0:
                assert set(np.flatnonzero(exact >= theta)) <= set(query.candidates(bucket, theta).tolist())

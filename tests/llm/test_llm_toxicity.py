import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity


def test_neighbours_are_exact():
    random = np.random.default_rng(9)
    dense = random.random((500, 40)) * (random.random((500, 40)) < 0.15)
    dense[::7] = dense[0]  # ties
    keep = dense.sum(1) > 0
    dense = dense[keep] / np.linalg.norm(dense[keep], axis=1)[:, None]
    rows, terms = np.nonzero(dense)
    ids = np.arange(len(dense)) * 3 + 1
    index = toxicity.BlockMaxIndex.build(ids, np.zeros(len(ids)), rows, terms, dense[rows, terms], 40)
    for q in random.random((60, 40)) * (random.random((60, 40)) < 0.2):
        t = np.flatnonzero(q)
        if not len(t):
            continue
        cosine = np.round(dense @ q, 12)
        order = np.lexsort((ids, -cosine))
        want = [i for i in order if cosine[i] > 0][:15]
        found, scores = index.nearest(t, q[t], 15)
        assert index.ids[found].tolist() == ids[want].tolist()
        assert np.allclose(scores, cosine[want])


def test_terms_are_found_as_by_plain_search():
    texts = ["Ab cab, dab!", "", None, "CAB cab x", "ÄB äbc", "ab\nab"]
    terms = [" ab ", "cab", " dab", "äb", "b ", "a"]
    rows, found, counts = toxicity.Vocabulary(terms).counts(pa.array(texts))
    want = []
    for i, t in enumerate(texts):
        words = [f" {w} " for w in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()]
        want += [(i, k, n) for k, term in enumerate(terms) if (n := sum(w[j:].startswith(term) for w in words for j in range(len(w))))]
    assert list(zip(rows.tolist(), found.tolist(), counts.tolist())) == want


def test_isotonic_rises_and_keeps_the_mean():
    x = np.array([0.1, 0.2, 0.2, 0.3, 0.5, 0.5, 0.9])
    y = np.array([0, 1, 0, 0, 1, 0, 1.0])
    cuts, values = toxicity.isotonic(x, y, np.ones(7))
    assert (np.diff(values) > 0).all() and len(set(cuts)) == len(cuts)
    assert np.isclose(sum(values[np.searchsorted(cuts, v)] for v in x), y.sum())


def small(spark):
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        filler = " ".join(f"w{(i * 7 + k) % 50}" for k in range(30))
        rows.append((i, filler + (" vile wretch" if toxic else " kind friend") if i % 2 else ("vile " if toxic else "kind ") + filler))
        labels.append((i, 0, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_rows_are_told_apart(spark):
    docs, labels = small(spark)
    got = {r["id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    held = [i for i in got if got[i]["held_out"]]
    assert held == [i for i in held if zlib.crc32(str(i).encode()) % 5 == 0] and len(held) > 80
    right = [got[i]["predicted"] == int(i % 5 == 0) for i in held]
    assert np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    assert all(n["id"] % 5 == 0 for n in got[5]["neighbours"])
    kept = {r["doc_id"] for r in toxicity.reject_toxic(docs, labels).collect()}
    assert kept == {i for i, r in got.items() if not r["predicted"]}


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = small(spark)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["id"]: r["score"] for r in toxicity.score_documents(docs, x).collect()} for x in (labels, other))
    assert a == b


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(5, 1, 1), (7, 0, 0), (7, 0, None), (99, 0, 1), (None, 0, 1), (6, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = toxicity.score_documents(edge_docs, labels).collect()
    assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    none = labels.where("doc_id = 99")
    assert {r["score"] for r in toxicity.score_documents(edge_docs, none).collect()} == {0.0}
    assert toxicity.score_documents(no_docs, labels).count() == 0
    kept = toxicity.reject_toxic(edge_docs, none)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from ledgerloom.llm.resample import bucket_counts, feature_crcs, features, gains, patterns, resample

TARGET = "target_id bigint, text string, id string"


def brute_features(text, grams):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) for r in runs]


def brute(docs, target, grams=1, buckets=10_000, seed=2024, min_words=20, percent=10):
    found = [(i, *brute_features(t, grams)) for i, t in docs]
    s = Counter(c % buckets for _, _, f in found for c in f)
    t = Counter(c % buckets for text in target for c in brute_features(text, grams)[1] for c in [c])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1.0) * (all_s + buckets) / ((s[k] + 1.0) * (all_t + buckets))))
    out = []
    for i, words, f in found:
        weight = sum(gain(c % buckets) for c in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    drawn = able[: len(able) * percent // 100]
    ranks = {}
    for n, r in enumerate(drawn, 1):
        ranks.setdefault(r, []).append(n)
    return sorted(((*r[:4], ranks[r].pop() if ranks.get(r) else None) for r in out), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("text", ["", "one", "One-two  three\x00four", "ünï çode 12 ünï", "--", "a" * 50_000, "a b " * 5_000, "ÀB c"])
@pytest.mark.parametrize("grams", [1, 2, 3])
def test_features_of_a_text_equal_plain_ones(text, grams):
    words, crcs = feature_crcs(text.encode(), patterns(grams))
    assert (words, sorted(crcs.tolist())) == (brute_features(text, grams)[0], sorted(brute_features(text, grams)[1]))


@pytest.mark.parametrize("grams, percent, buckets", [(1, 10, 10_000), (3, 50, 97)])
def test_equals_brute_force(spark, sf_dir, documents, grams, percent, buckets):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = rows_of(resample(docs, target, grams=grams, percent=percent, buckets=buckets))
    aim = [r["text"] for r in target.collect()]
    assert got == brute([(d["doc_id"], d["text"]) for d in documents], aim, grams, buckets, percent=percent)


def test_edge_rows(spark, edge_docs):
    target = spark.createDataFrame([(1, "the long text", "x"), (2, None, None), (3, "", "y")], TARGET)
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    for percent in (10, 100):
        got = rows_of(resample(edge_docs, target, min_words=1, percent=percent))
        assert got == brute(docs, ["the long text", None, ""], min_words=1, percent=percent)


def test_empty_tables(spark, edge_docs, no_docs):
    nothing = spark.createDataFrame([], TARGET)
    assert rows_of(resample(no_docs, nothing)) == []
    assert len(rows_of(resample(edge_docs, nothing))) == edge_docs.count()


def test_repeated_rows_take_ranks_one_after_another(spark):
    docs = spark.createDataFrame([(7, "word " * 30)] * 40 + [(i, f"other{i} " * 25) for i in range(10, 20)], "doc_id bigint, text string")
    got = resample(docs, docs.limit(0), percent=100).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 51))
    assert np.ptp([r["rank"] for r in got if r["id"] == 7]) == 39


def test_counts_cover_all_rows(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id AS id", "text")
    counts = bucket_counts(features(docs), 10_000)
    assert counts.sum() == sum(len(brute_features(d["text"], 1)[1]) for d in documents)
    assert gains(np.zeros(3, np.int64), np.zeros(3, np.int64)).tolist() == [0, 0, 0]

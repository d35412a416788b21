import math
import zlib
from collections import Counter

import pytest

from ledgerloom.llm import ngrams


def words(text):
    return [*(text or "").encode().lower().split(), b"<end> "]


def test_base_scores_match_brute_force_and_the_model_beats_them(spark, sf_dir, documents):
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in documents}
    counts = Counter(w for r in documents if not held[r["doc_id"]] for w in words(r["text"]))
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in ngrams.op4_lm(spark, sf_dir).collect()}
    base = model = 0.0
    for r in documents:
        tokens, g = words(r["text"]), got[r["doc_id"]]
        want = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        assert (g["held_out"], g["n_tokens"], g["train_tokens"]) == (held[r["doc_id"]], len(tokens), n)
        assert g["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert g["base_score"] == pytest.approx(want, rel=1e-9)
        if g["held_out"]:
            base, model = base + want, model + g["score"]
    assert model > base * 0.9  # closer to zero by a tenth at least


def brute(train, texts, weights):
    """Interpolated scores from plain counts."""
    pairs, singles, contexts = Counter(), Counter(), Counter()
    for t in train:
        before = b"<start> "
        for w in words(t):
            pairs[before, w] += 1
            singles[w] += 1
            contexts[before] += 1
            before = w
    n, v, out = sum(singles.values()), len(singles), []
    for t in texts:
        before, total = b"<start> ", 0.0
        for w in words(t):
            c = contexts[before]
            l2, l1, l0 = weights[min(math.frexp(c)[1], ngrams.BUCKETS - 1) if c else 0]
            total += math.log10(l2 * pairs[before, w] / max(c, 1) + l1 * singles[w] / n + l0 / (v + 1))
            before = w
        out.append(total)
    return out


def test_scores_match_plain_counts_over_many_chunks(spark, monkeypatch):
    texts = [" ".join(f"W{(i * k * k) % 23}" for k in range(1 + i % 40)) for i in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    seen = {}
    learn = ngrams.learn_weights
    monkeypatch.setattr(ngrams, "learn_weights", lambda *a: seen.setdefault("w", learn(*a)))
    got = {r["id"]: r["score"] for r in ngrams.score_documents(df).collect()}
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10]
    for i, want in enumerate(brute(train, texts, seen["w"])):
        assert got[i] == pytest.approx(want, rel=1e-9)
    assert all(abs(sum(w) - 1) < 1e-9 for w in seen["w"])


def test_probabilities_of_all_next_words_add_up_to_one():
    counts = {"a": 5, "b": 3}
    l2, l1, l0 = 0.5, 0.3, 0.2
    after = {"a": 2, "b": 2}
    total = sum(l2 * after[w] / 4 + l1 * counts[w] / 8 + l0 / 3 for w in counts) + l0 / 3
    assert total == pytest.approx(1)


def test_edges(edge_docs, no_docs):
    got = ngrams.score_documents(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert {r["n_tokens"] for r in got if r["id"] in (1, 2, 3)} == {1}
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert {r["held_out"] for r in got if r["id"] is None} == {True}
    assert ngrams.score_documents(no_docs).count() == 0
    alone = ngrams.score_documents(edge_docs.where("doc_id IS NULL")).collect()  # nothing to learn from
    assert len(alone) == 2 and all(r["score"] == 0 or r["score"] < 0 for r in alone)

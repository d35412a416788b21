import hashlib
import re

import numpy as np

from ledgerloom.llm import substrings


def brute(rows, window=50):
    first, out = {}, {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        covered, new = [False] * len(words), []
        for i in range(len(words) - window + 1):
            k = tuple(words[i : i + window])
            if first.get(k, doc_id) < doc_id:
                covered[i : i + window] = [True] * window
            new.append(k)
        for k in new:
            first.setdefault(k, doc_id)
        out[doc_id] = (len(words), sum(covered), " ".join(w for w, c in zip(words, covered) if not c))
    return out


def test_documents_match_brute_force(spark, sf_dir, documents):
    want = brute([(r["doc_id"], r["text"]) for r in documents])
    got = {r["doc_id"]: r for r in substrings.op5_substring(spark, sf_dir).collect()}
    assert len(got) == len(want)
    for d, (words, removed, kept) in want.items():
        assert (got[d]["n_words"], got[d]["n_removed"], got[d]["kept_sha256"]) == (words, removed, hashlib.sha256(kept.encode()).hexdigest())


def test_short_windows_with_repeats_inside_and_across(spark):
    rows = [(3, "a b c d e f a b c d"), (1, "x a b c d y"), (2, "c d e f c d e f"), (5, "q"), (4, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.remove_repeats(df, window=4, anchor=2).collect()}
    assert got == brute(sorted(rows), 4)


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * k) % 97}" for k in range(60))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(substrings, "repeated_cells", lambda *a: b"\xff" * ((2 << substrings.ROW_BITS) // 8))
    got = {r["id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.remove_repeats(df, window=5, anchor=3).collect()}
    assert got == brute(rows, 5)


def test_sliding_minimum_and_rolling_hash():
    values = np.random.default_rng(1).integers(0, 1 << 63, 200).astype(np.uint64)
    for width in (1, 2, 5, 16, 35):
        assert substrings._sliding_min(values, width).tolist() == [values[i : i + width].min() for i in range(200 - width + 1)]
    again = np.concatenate([values[50:80], values])
    assert substrings._rolling(again, 30)[0] == substrings._rolling(values, 30)[50]


def test_edges(edge_docs, no_docs):
    got = substrings.remove_repeats(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = {}
    for r in got:
        by.setdefault(r["id"], []).append(r)
    assert (by[1][0]["n_words"], by[1][0]["kept"]) == (0, "") and by[2][0]["kept"] == ""
    assert [r["n_removed"] for r in by[6]] == [0, 0]  # rows of one id do not repeat each other
    assert {r["n_removed"] for r in by[None]} == {0}
    assert by[8][0]["n_removed"] == 0 and by[9][0]["kept"] == "end"
    assert by[10][0]["n_words"] == 4
    assert substrings.remove_repeats(no_docs).count() == 0

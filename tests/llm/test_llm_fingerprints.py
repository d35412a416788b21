import hashlib
import math
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm.fingerprints import RADIUS, as_hex, compare_edits, fingerprint, near_counts, near_fingerprints, tables

LOW = (1 << 64) - 1


def brute_fingerprint(text):
    found = set(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))
    votes, total = [0] * 128, 0
    for w in found:
        weight = 1 if len(w) <= 3 else 3
        h0 = xxhash.xxh64_intdigest(w.encode(), 42)
        h = h0 | xxhash.xxh64_intdigest(h0.to_bytes(8, "little"), 42) << 64
        total += weight
        for i in range(128):
            votes[i] += weight * (h >> i & 1)
    return sum(1 << i for i in range(128) if 2 * votes[i] > total)


def like(a, b):
    return max(0.0, math.cos(math.pi * (a ^ b).bit_count() / 128))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute(docs):
    """By id, from the largest down; of texts that share an id the one that hashes lowest gives its head."""
    prints = {t: brute_fingerprint(t or "") for _, t in docs}
    given = {}
    for i, t in docs:
        h = signed(xxhash.xxh64_intdigest((t or "").encode(), 42))
        if i is not None and (i not in given or h < given[i][0]):
            given[i] = (h, t or "")
    order = sorted(given, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    out = []
    for i, t in docs:
        text, third = t or "", len(t or "") // 3
        other = given[following[i]][1] if i is not None else ""
        edited = text[: len(text) - third] + other[:third]
        a, e, n = prints[t], brute_fingerprint(edited), brute_fingerprint(other)
        near = sum((a ^ prints[u]).bit_count() <= RADIUS for _, u in docs) - 1
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{a:032x}", f"{e:032x}", round(like(a, e), 9), round(like(a, n), 9), near))
    return sorted(out, key=str)


def rows_of(df):
    got = df.select("id", "n_chars", "edited_sha256", as_hex(F.col("fp")), as_hex(F.col("edited_fp")), F.round("near_edited", 9), F.round("near_next", 9), "n_near")
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_equals_brute_force(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows_of(compare_edits(docs)) == brute([(d["doc_id"], d["text"]) for d in documents])


def test_edge_rows(spark, edge_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    assert rows_of(compare_edits(edge_docs)) == brute(docs)


@pytest.mark.parametrize("docs", [[], [(3, "a single document here")], [(None, "no id at all")], [(1, None), (2, "")]])
def test_small_tables(spark, docs):
    assert rows_of(compare_edits(spark.createDataFrame(docs, "doc_id bigint, text string"))) == brute(docs)


def test_edited_texts_are_told_from_next_ones(spark, sf_dir):
    rows = compare_edits(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("n_chars >= 100").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.98 * len(rows)


def test_no_python_runs_on_rows(spark, sf_dir):
    plan = compare_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_very_many_words_do_not_overflow_lanes(spark):
    text = " ".join(f"{w}{i}" for w in ("x", "longer") for i in range(40_000))
    got = spark.createDataFrame([(text,)], "text string").select(as_hex(fingerprint(F.col("text"))).alias("f")).first()["f"]
    assert got == f"{brute_fingerprint(text):032x}"


@pytest.mark.parametrize("radius, blocks", [(0, None), (3, None), (3, 4), (3, 6), (5, 7)])
def test_tables_find_every_near_pair_once(spark, radius, blocks):
    rng = random.Random(radius)
    fps = {rng.getrandbits(128) for _ in range(60)}
    for f in list(fps):
        for _ in range(6):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 7))))
    table = spark.createDataFrame([(signed(f & LOW), signed(f >> 64)) for f in fps], "fp0 bigint, fp1 bigint")
    found = [((r["a0"] & LOW) | (r["a1"] & LOW) << 64, (r["b0"] & LOW) | (r["b1"] & LOW) << 64) for r in near_fingerprints(table, radius, blocks).collect()]
    ordered = sorted(fps)
    wanted = {frozenset((a, b)) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if (a ^ b).bit_count() <= radius}
    assert len(found) == len(wanted) and {frozenset(p) for p in found} == wanted


def test_copies_count_without_pairs(spark):
    table = spark.createDataFrame([(1, 0)] * 500 + [(3, 0), (-1, 5)], "fp0 bigint, fp1 bigint")
    assert {(r["fp0"], r["n_near"]) for r in near_counts(table).collect()} == {(1, 500), (3, 500), (-1, 0)}
    assert len(tables(4, 3)) == 4

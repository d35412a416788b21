import random

import numpy as np
import xxhash

from ledgerloom.llm import simhash
from ledgerloom.llm.components import connected_components


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components_match_union_find(spark):
    random.seed(3)
    pairs = [(random.randrange(400), random.randrange(400)) for _ in range(230)] + [(900 + i, 901 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(90)]
    df = spark.createDataFrame([*pairs, (None, 5), (7, None), (8, 8)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    want = groups(pairs, {n for p in pairs for n in p})
    assert got == {n: c for n, c in want.items() if any(n in p and p[0] != p[1] for p in pairs)}
    assert connected_components(df.where("a > 5000")).count() == 0


def plain_fingerprint(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints_and_components_match_brute_force(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in simhash.op10_simhash(spark, sf_dir).collect()}
    for r in documents[:60]:
        assert got[r["doc_id"]]["fingerprint"] == f"{plain_fingerprint(r['text']):016x}"
    of = {d: int(r["fingerprint"], 16) for d, r in got.items()}
    distinct = np.array(sorted(set(of.values())), np.uint64)
    near = [(int(a), int(distinct[j])) for i, a in enumerate(distinct) for j in np.flatnonzero(np.bitwise_count(distinct[i + 1 :] ^ a) <= 3) + i + 1]
    group = groups(near, [int(x) for x in distinct])
    least = {}
    for d, f in of.items():
        least[group[f]] = min(least.get(group[f], d), d)
    assert {d: r["component_id"] for d, r in got.items()} == {d: least[group[f]] for d, f in of.items()}


def test_every_allocation_finds_every_link(spark):
    random.seed(4)
    base = [random.getrandbits(64) for _ in range(30)]
    values = sorted({b ^ sum(1 << k for k in random.sample(range(64), random.randrange(6))) for b in base for _ in range(12)})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    want = {tuple(sorted((signed[i], signed[j]))) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 3}
    thirds = [list(range(0, 22)), list(range(22, 43)), list(range(43, 64))]
    halves = [list(range(0, 64, 2)), list(range(1, 64, 2))]
    layouts = [None, list(zip(thirds, (0, 0, 1))), list(zip(thirds, (2, -1, 0))), list(zip(halves, (1, 1))), list(zip(halves, (-1, 3)))]
    for parts in layouts[:4]:
        assert {tuple(r) for r in simhash.links(df, 3, parts).collect()} == want


def test_thresholds_are_the_cheapest():
    cost, chosen = simhash.allocate([[0, 5, 9, 20], [0, 1, 2, 30], [0, 4, 4, 4]], 1)
    assert sum(chosen) == 1 and cost == min(
        [0, 5, 9, 20][a + 1] + [0, 1, 2, 30][b + 1] + [0, 4, 4, 4][c + 1] for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 1
    )


def test_edges(edge_docs, no_docs):
    got = simhash.near_duplicates(edge_docs).collect()
    assert len(got) == edge_docs.count()
    zero = [r for r in got if r["fp"] == 0]
    assert {r["id"] for r in zero} == {1, 2, 3, None} and {r["component"] for r in zero} == {1}
    assert {r["component"] for r in got if r["id"] in (4, 5)} == {4}
    assert sorted(r["component"] for r in got if r["id"] == 6) == [6, 6]
    assert simhash.near_duplicates(no_docs).count() == 0

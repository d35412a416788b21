import math

import numpy as np
import pyarrow.dataset as ds

from ledgerloom.llm import vectors


def brute(ids, matrix):
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    label = np.array(ids)
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return near.sum(1) - 1, label
        label = new


def test_links_and_components_match_brute_force(spark):
    random = np.random.default_rng(5)
    centres = random.standard_normal((60, 24))
    rows = np.concatenate([centres, *(centres[:20] + random.standard_normal((20, 24)) * s for s in (0.05, 0.15, 0.2, 0.24)), centres[:7]])
    ids = list(range(100, 100 + len(rows)))
    df = spark.createDataFrame([(i, [float(x) for x in r], 0) for i, r in zip(ids, rows)], "vec_id bigint, embedding array<double>, label int")
    links, label = brute(ids, rows)
    got = {r["id"]: r for r in vectors.near_vectors(df).collect()}
    found = np.array([got[i]["n_links"] for i in ids])
    assert (found <= links).all() and found.sum() >= 0.97 * links.sum()
    same = [got[i]["component"] == c for i, c in zip(ids, label)]
    assert np.mean(same) > 0.97


def test_recall_on_the_test_vectors(spark, sf_dir):
    table = ds.dataset(f"{sf_dir}/embeddings.parquet").to_table()
    links, label = brute(table["vec_id"].to_pylist(), np.array(table["embedding"].to_pylist(), float))
    got = {r["vec_id"]: r for r in vectors.op2_embedding(spark, sf_dir).collect()}
    assert [got[i]["n_links"] for i in table["vec_id"].to_pylist()] == links.tolist()
    assert [got[i]["component_id"] for i in table["vec_id"].to_pylist()] == label.tolist()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_the_number_of_tables_gives_the_recall():
    for n in (10, 10_000, 10**9):
        hashes, tables = vectors.tables_for(n)
        near = vectors.collision(math.sqrt(0.1), vectors.WIDTH)
        assert 1 - (1 - near**hashes) ** tables >= vectors.RECALL
    assert vectors.tables_for(10**9)[0] > vectors.tables_for(10)[0]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], "x"), (2, [1.0, 0.0], None), (3, [2.0, 0.0], "x"), (4, [0.0, 0.0], "x"), (5, [0.0, 0.0], "x"), (6, None, "x"),
        (7, [nan, 1.0], "x"), (8, [inf, 1.0], "x"), (9, [None, 1.0], "x"), (10, [1.0, 0.0, 0.0], "x"), (None, [1.0, 0.0], "x"), (11, [], "x"), (2, [1.0, 0.0], None),
        (12, [1e200, 1e-200], "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rep string")
    got = sorted((r["id"] or 0, r["n_links"], r["component"]) for r in vectors.near_vectors(df).collect())
    linked = [(1, 4, 1), (2, 4, 1), (2, 4, 1), (3, 4, 1), (12, 4, 1)]
    assert got == sorted(linked + [(0, 0, None)] + [(i, 0, i) for i in (4, 5, 6, 7, 8, 9, 10, 11)])
    assert vectors.near_vectors(df.where("vec_id > 99")).count() == 0

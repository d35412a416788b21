from collections import defaultdict

import pyarrow as pa

import corpus_pipeline as P
from ledgerloom.llm import decontaminate, simhash
from ledgerloom.llm.common import slices, split_words


def test_stages_do_their_work_and_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]

    kept = P.stored(P.toxicity(spark, docs, sf_dir), "t1")
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert kept.columns == columns and all(before[d] == r for d, r in rows.items()) and 0.85 * len(before) < len(rows) < len(before)

    less = P.stored(P.line_dedup(spark, kept, sf_dir), "t2")
    cut = {r["doc_id"]: r for r in less.collect()}
    assert less.columns == columns and set(cut) == set(rows)
    seen = set()
    for d in sorted(cut):
        lines = [x.strip(" ").lower() for x in cut[d]["text"].split("\n")]
        long = [x for x in lines if len(x) >= 40]
        assert not seen & set(long) and len(set(long)) == len(long)
        seen |= set(long)
        assert cut[d]["n_chars"] == len(cut[d]["text"])

    one = P.stored(P.near_dedup(spark, less, sf_dir), "t3")
    single = {r["doc_id"]: r for r in one.collect()}
    groups = defaultdict(list)
    for d, r in cut.items():
        groups[simhash.fingerprint(r["text"].encode())].append(d)
    prints = sorted(groups)
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for p, ids in groups.items():
        least[find(p)] += ids
    assert set(single) == {min(ids) for ids in least.values()} and all(single[d] == cut[d] for d in single)

    clean = P.stored(P.decontamination(spark, one, sf_dir), "t4")
    left = {r["doc_id"]: r for r in clean.collect()}
    flagged = {r["id"] for r in decontaminate.contaminated(one, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert set(left) == set(single) - flagged and all(left[d] == single[d] for d in left)

    pieces = P.packing(spark, clean, sf_dir).collect()
    assert {r["doc_id"] for r in pieces} == set(left)
    assert {(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in P.run(spark, sf_dir).collect()} == {
        (r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in pieces
    }


def test_line_dedup_removes_short_repeats_and_two_edits(spark):
    line = "this line is long enough to be compared with the other ones"
    df = spark.createDataFrame([(1, f"Menu\n\nText one\n{line}"), (2, f"Menu\n\nText two\n{line[:9]}{line[10:]}s")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in P.line_dedup(spark, df, "").collect()} == {1: f"Menu\n\nText one\n{line}", 2: "\nText two"}


def test_near_dedup_edges(edge_docs, no_docs, spark):
    got = P.near_dedup(spark, edge_docs, "").collect()
    ids = [r["doc_id"] for r in got]
    assert sorted(i for i in ids if i is not None) == [1, 4, 6, 8, 10] or sorted(i for i in ids if i is not None) == [1, 4, 6, 7, 8, 10]
    assert ids.count(None) == 2 and ids.count(6) == 1
    assert P.near_dedup(spark, no_docs, "").count() == 0


def test_words_of_sliced_batches():
    texts = [f"A{i}  b\tC\n" for i in range(50)]
    b = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(texts)], names=["id", "text"])
    words = []
    for part in slices([b], rows=7):
        w, n = split_words(part.column(1), lower=True)
        assert (n == 3).all()
        words += w.to_pylist()
    assert words == [x for t in texts for x in t.lower().split()]


def test_no_document_goes_for_its_id_alone(spark):
    """Rows that share an id are judged by their texts, and of equal rows one stays."""
    a, b, c = ("the first text of them " * 5, "something else in other words entirely " * 4, "a third one that shares nothing with those " * 4)
    df = spark.createDataFrame([(1, a), (1, b), (2, c), (1, a), (3, b)], "doc_id bigint, text string")
    assert sorted(map(tuple, P.near_dedup(spark, df, "").collect())) == sorted([(1, a), (1, b), (2, c)])


def test_columns_of_any_name_pass(spark):
    line = "this line is long enough to be compared with the other ones"
    extra = ["a.b", "__id", "__th", "__gone", "__lines", "__removed", "__row", "component", "group", "fp"]
    schema = "doc_id bigint, text string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in extra)
    df = spark.createDataFrame([(i, f"{line}\nand more {i}", 0, *[f"{c}{i}" for c in extra]) for i in range(3)], schema)
    less = P.line_dedup(spark, df, "")
    assert less.columns == df.columns and {r["doc_id"]: (r["text"].count("\n"), r["a.b"], r["__lines"]) for r in less.collect()} == {
        0: (1, "a.b0", "__lines0"), 1: (0, "a.b1", "__lines1"), 2: (0, "a.b2", "__lines2"),
    }
    one = P.near_dedup(spark, df, "")
    assert one.columns == df.columns and all(r["__id"] == f"__id{r['doc_id']}" for r in one.collect())

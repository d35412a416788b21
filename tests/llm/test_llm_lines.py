import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import lines


def texts(n, seed, letters="ab c"):
    random.seed(seed)
    out = []
    for _ in range(n):
        a = "".join(random.choice(letters) for _ in range(random.randint(8, 40)))
        b = list(a)
        for _ in range(random.randint(0, 4)):
            k = random.randint(0, len(b))
            b[k : k + random.choice((0, 1))] = random.choice(["", *letters])
        out.append((a, "".join(b)))
    return [(a, b) if len(a) >= len(b) else (b, a) for a, b in out]


def test_distance_matches_the_plain_one(spark):
    df = spark.createDataFrame(texts(800, 1), "a string, b string")
    for edits in (1, 2, 3):
        near = df.where(F.length("a") - F.length("b") <= edits).where(F.length("b") > edits)
        both = near.select(lines.edit_distance_within(F.col("a"), F.col("b"), edits).alias("got"), (F.levenshtein("a", "b") <= edits).alias("want"))
        assert both.where("got <> want").count() == 0 and both.where("got").count() > 50


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(rows, edits, least):
    first, out = {}, {}
    for d, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            k = line.strip(" ").lower()
            if len(k) >= least:
                first.setdefault(k, (d, p))
    near = {k for k, at in first.items() if any(o < at and abs(len(k) - len(m)) <= edits and distance(k, m) <= edits for m, o in first.items())}
    for d, t in rows:
        kept = [
            line for p, line in enumerate((t or "").split("\n")) if len(k := line.strip(" ").lower()) < least or k not in near and first[k] == (d, p)
        ]
        out[d] = "\n".join(kept)
    return out


def test_near_lines_match_brute_force(spark):
    for edits in (1, 2):
        pairs = texts(60, 10 + edits)
        rows = [(i, f"{a}\n{b}\nshort\n{pairs[(i * 7) % 60][0].upper()}") for i, (a, b) in enumerate(pairs)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        got = {r["doc_id"]: r["text"] for r in lines.drop_lines(df, edits=edits, min_chars=8).collect()}
        assert got == brute(rows, edits, 8)


def test_many_near_lines_meet_few(spark, monkeypatch):
    """600 lines within two edits of each other: pairs grow with the lines, not with their square."""
    base = "every one of these lines is the same but for a letter or two at one place or another of it"
    random.seed(4)
    near = sorted({base[:k] + c + base[k + 1 :] for k in range(len(base)) for c in "qxyzw0123"})
    near = random.sample(near, 600)
    met = []
    kept_pairs = lines._pairs
    monkeypatch.setattr(lines, "_pairs", lambda df: met.append(kept_pairs(df)) or met[-1])
    df = spark.createDataFrame([(i, f"{x}\nshort") for i, x in enumerate(near)], "doc_id bigint, text string")
    got = lines.drop_lines(df, edits=2).where("__removed > 0").count()
    assert got == 599 and sum(m.count() for m in met) < 40 * 600


def test_lines_beyond_the_first_of_a_key_are_found(spark, monkeypatch):
    """With one head per key, nearly all pairs are late ones."""
    monkeypatch.setattr(lines, "HEADS", 1)
    for edits in (1, 2):
        pairs = texts(60, 20 + edits)
        rows = [(i, f"common start of it {a}\ncommon start of it {b}\nshort") for i, (a, b) in enumerate(pairs)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        got = {r["doc_id"]: r["text"] for r in lines.drop_lines(df, edits=edits, min_chars=8).collect()}
        assert got == brute(rows, edits, 8)


def test_short_lines_go_as_exact_repeats_where_asked(spark):
    line = "this line is long enough to be compared with the other ones"
    rows = [(1, f"Menu\nHome\n\n{line}\nHomes"), (2, f" menu \n\n{line}s\nhome\nOnly here\n\nonly here"), (3, "HOME")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["text"], r["__removed"]) for r in lines.drop_lines(df, repeats_from=1).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("\nOnly here\n", 4), 3: ("", 1)}
    got = {r["doc_id"]: r["__removed"] for r in lines.drop_lines(df).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_documents_match_brute_force(spark, sf_dir, documents):
    """The only near pairs of the table are found by brute force over lines of like length and letters."""
    got = {r["doc_id"]: r for r in lines.op7_lines(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    first = {}
    for r in documents:
        for p, line in enumerate(r["text"].split("\n")):
            k = line.strip(" ").lower()
            if len(k) >= lines.MIN_CHARS:
                first.setdefault(k, (r["doc_id"], p))
    halves = {}
    for k in first:  # lines one edit apart share their first or their last half
        for n in (len(k) // 2, (len(k) - 1) // 2):
            halves.setdefault((0, k[:n]), set()).add(k)
            halves.setdefault((1, k[len(k) - n :]), set()).add(k)
    near = set()
    for group in halves.values():
        for a in group:
            for b in group:
                if first[a] < first[b] and abs(len(a) - len(b)) <= 1 and distance(a, b) <= 1:
                    near.add(b)
    for r in documents:
        kept = []
        for p, line in enumerate(r["text"].split("\n")):
            k = line.strip(" ").lower()
            if len(k) < lines.MIN_CHARS or (k not in near and first[k] == (r["doc_id"], p)):
                kept.append(line)
        g = got[r["doc_id"]]
        assert (g["n_lines"], g["n_removed"]) == (r["text"].count("\n") + 1, r["text"].count("\n") + 1 - len(kept))
        assert g["kept_sha256"] == hashlib.sha256("\n".join(kept).encode()).hexdigest()


def test_plan_has_no_python(spark, edge_docs):
    plan = lines.drop_lines(edge_docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_edges(edge_docs, no_docs):
    got = lines.drop_lines(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["text"] is None and by[1][0]["__lines"] == 0 and by[2][0]["text"] == ""
    assert [r["__removed"] for r in by[6]] == [0, 0]  # equal rows are one document
    assert by[7][0]["__removed"] == 2 and by[7][0]["text"] == ""
    assert {r["__removed"] for r in by[None]} == {0}
    assert by[8][0]["__removed"] == 0 and by[9][0]["__removed"] == 1
    assert lines.drop_lines(no_docs).count() == 0


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_keys_are_a_row_per_line_and_key_and_move_as_lines(spark, edits, monkeypatch):
    sample = ["a" * 40, "a" * 40, "abcdefgh" * 6, "the quick brown fox jumps over the lazy dog again"]
    rows = spark.createDataFrame([(t,) for t in sample], "line string").select(F.xxhash64("line").alias("h"), "line", F.length("line").alias("length"))
    seen = []
    monkeypatch.setattr(lines, "stored", lambda df, label: seen.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    got = [tuple(r) for r in lines.line_keys(rows, edits).select("h", "key", "probe").collect()]
    own, others = lines._keys(F.col("line"), F.col("length"), edits)
    parts = [rows.select("h", F.explode(F.array(*keys)).alias("key"), F.lit(probe).alias("probe")) for keys, probe in ((own, False), (others, True)) if keys]
    want = {tuple(r) for part in parts for r in part.collect()}
    assert len(got) == len(set(got)) and set(got) == want
    assert seen[0].index("Generate") < seen[0].index("Exchange")

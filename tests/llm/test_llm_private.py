import hashlib
import re

from pyspark.sql import functions as F

from ledgerloom.llm import private

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def accepted(kind, span):
    digits = re.sub("[^0-9]", "", span)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in span.split(".")),
        "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if accepted(k, m[0])]


HARD = [
    "a@b.c@d.e f@g h@i..j k.l+m%n@o-p.q-r.s. t", "a@b.c_x@d.e", "@@a@b.co", "1.2.3.4.5.6.7.8.9", "0001.002.3.255 256.1.1.1 1.1.1.999", "10.20.30",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111 2", "41111111111111111111111", "+1 (434) 555-2368 +12345 +(1) +1-2-3-4-5-6-7-8",
    "+1 (434) 555-23682222222222", "x" * 3000 + "@y.zz", "9" * 3000, "é你\U0001f600 a@b.cc \U0001f600 1.2.3.4", "﷐a@b.cc﷑", "+1..........2345678", "",
]


def test_hard_texts_match_the_plain_patterns(spark):
    df = spark.createDataFrame(list(enumerate(HARD)), "doc_id bigint, text string")
    for r in private.personal_data(df).collect():
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == brute(HARD[r["id"]]), HARD[r["id"]][:80]


def test_documents_match_brute_force(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in private.op9_pii(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for r in documents:
        spans, g = brute(r["text"]), got[r["doc_id"]]
        spelled = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert [g[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in spans) for k in PLAIN]
        assert g["base_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
        assert set(spelled.split(",")) <= {*g["spans"].split(","), ""} or spelled == ""


def test_luhn(spark):
    numbers = ["4111111111111111", "4111111111111112", "0", "18", "79927398713", "79927398710"]
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    assert [r["ok"] for r in df.select(private.luhn(F.col("n")).alias("ok")).collect()] == [luhn(n) for n in numbers]


def test_trees_add_likely_spans_only(spark):
    rows = []
    for i in range(400):
        rows.append((i, f"call me on +1 ({200 + i % 700}) 555-{1000 + i} or mail u{i}@mail{i % 9}.example.com from 10.{i % 250}.3.{i % 200} thanks"))
        rows.append((1000 + i, f"order id={i}{7 * i}{10**8 + 31 * i}x and +1{i % 9}2 and version 300.{i}.999.1 and card 4000 0000 0000 {1000 + i}"))
    rows += [(5000 + i, f"you can reach us, phone ({300 + i}) 555-{2000 + i} in the day") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["id"]: r for r in private.personal_data(df).collect()}
    texts = dict(rows)
    for i, r in got.items():
        base, added = ([(s["kind"], s["start"], s["end"]) for s in r[c]] for c in ("base", "added"))
        assert base == brute(texts[i])
        every = sorted((a, b) for _, a, b in added)
        assert all(x[1] <= y[0] for x, y in zip(every, every[1:]))
        assert not any(a < d and c < b for _, a, b in added for _, c, d in base)
    assert sum(bool(got[5000 + i]["added"]) for i in range(50)) >= 40
    assert sum(bool(got[1000 + i]["added"]) for i in range(400)) < 40


def test_a_rare_kind_keeps_its_threshold_beside_a_hot_one(spark):
    rows = spark.range(100_000).select("id", F.lit("card").alias("kind"), F.concat(F.lit("4000 0000 "), F.col("id") + 10**8).alias("span"), F.lit(0.0).alias("label"))
    rare = spark.range(120).select(F.col("id") + 10**6, F.lit("phone"), F.concat(F.lit("+1 (434) 555-"), F.col("id") + 1000), F.lit(1.0))
    spans = rows.union(rare).select("*", F.xxhash64("id").alias("th"), F.lit(9).alias("start"), F.lit("call ").alias("before"), F.lit(" now").alias("after"))
    model, limits = private.train(private.described(spans))
    assert model is not None and "phone" in limits and "card" not in limits


def test_plan_has_no_python(spark, sf_dir):
    plan = private.op9_pii(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "ArrowEval", "Pandas", "Cartesian", "NestedLoop"))


def test_edges(edge_docs, no_docs):
    got = private.personal_data(edge_docs.withColumn("text", F.concat("text", F.lit(" a@b.cc")))).collect()
    assert len(got) == edge_docs.count()
    assert {len(r["base"]) for r in got if r["id"] != 1 and r["id"] is not None} == {1}
    assert sorted(len(r["base"]) for r in got if r["id"] is None) == [0, 1]
    assert [r for r in got if r["id"] == 1][0]["base"] == []
    assert private.personal_data(no_docs).count() == 0

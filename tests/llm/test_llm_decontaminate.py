import random
import time

from ledgerloom.llm import decontaminate as D


def longest_first(item, text, minimum):
    """Tiling by comparing all places."""
    a, b, out = [True] * len(item), [True] * len(text), []
    while True:
        best = (minimum - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and a[i + n] and b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < minimum:
            return sorted(out)
        a[i : i + n], b[j : j + n] = [False] * n, [False] * n
        out.append((i, j, n))


def test_tiles_equal_plain_longest_first_tiling():
    random.seed(6)
    for case in range(300):
        letters = random.choice((1, 2, 5, 30))
        item = [random.randrange(letters) for _ in range(random.randint(0, 30))]
        text = [random.randrange(letters) for _ in range(random.randint(0, 60))]
        if item and text and random.random() < 0.7:
            k = random.randrange(len(item))
            text[3:3] = item[k:] + [7] + item[:k]
        minimum = random.choice((1, 2, 3, 4))
        assert D.tile(item, text, minimum) == longest_first(item, text, minimum), case


def test_repeated_tokens_end_soon():
    start = time.perf_counter()
    assert D.tile([5] * 2_000, [5] * 200_000, 4) == [(0, 0, 2_000)]
    random.seed(1)
    item = [random.randrange(2) for _ in range(2_000)]
    tiles = D.tile(item, [random.randrange(2) for _ in range(100_000)], 4)
    assert sum(n for *_, n in tiles) > 1_900
    assert time.perf_counter() - start < 20


def test_a_very_long_text_of_one_word(spark):
    got, *_ = found(spark, ["a " * 200_000, "b " * 50], [(1, "a " * 2_000), (2, "c d e f")])
    assert got == {(0, 1): 1.0}


ITEM = "the quick brown fox jumps over the lazy dog while seven wizards quietly brew potions"


def found(spark, texts, items=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(items or [(1, ITEM)], "item_id bigint, text string")
    return {(r["id"], r["item"]): r["coverage"] for r in D.contaminated(docs, bench).collect()}, docs, bench


def test_copies_reordered_and_partial_passages(spark):
    words = ITEM.split()
    texts = [
        "clean words only that share nothing of note",
        f"before {ITEM} after",
        " ".join(words[8:]) + " filler text in between " + " ".join(words[:8]),
        ITEM.upper().replace(" ", ", "),
        " ".join(words[:5]) + " and then something else entirely",
        " ".join(w for pair in zip(words[::2], words[1::2]) for w in reversed(pair)),
    ]
    got, docs, bench = found(spark, texts)
    assert set(got) == {(1, 1), (2, 1), (3, 1)} and set(got.values()) == {1.0}
    assert {r["doc_id"] for r in D.drop_contaminated(docs, bench).collect()} == {0, 4, 5}


def test_short_items_must_occur_whole(spark):
    got, *_ = found(spark, ["red apple pie", "red apple", "apple red", "red pie apple"], [(1, "red apple"), (2, ""), (3, None), (4, "!!")])
    assert set(got) == {(0, 1), (1, 1)}


def test_blocks_of_items_give_what_one_block_gives(spark, monkeypatch):
    texts = [f"lead {w} tail" for w in (ITEM, ITEM[::-1], "alpha beta gamma delta epsilon zeta")]
    items = [(1, ITEM), (2, "alpha beta gamma delta epsilon zeta"), (3, ITEM[::-1])]
    one, *_ = found(spark, texts, items)
    monkeypatch.setattr(D, "BLOCK_TOKENS", 1)
    many, docs, bench = found(spark, texts, items)
    assert one == many and set(one) == {(0, 1), (1, 3), (2, 2)}
    assert D.drop_contaminated(docs, bench).count() == 0


def test_planted_items_of_the_test_tables(spark, sf_dir, documents):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    whole = {(d["doc_id"], i) for d in documents for i, t in items.items() if t in d["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in D.op8_decontamination(spark, sf_dir).collect()}
    assert whole and whole <= got and len(got) <= len(whole) + 2


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "this line of text is long enough"), (None, "one"), (2, None)], "item_id bigint, text string")
    got = {(r["id"], r["item"]) for r in D.contaminated(edge_docs, bench).collect()}
    # An item with a null id matches like any other.
    assert got == {(6, 1), (7, 1), (None, 1), (4, None), (5, None), (6, None), (7, None), (None, None)}
    assert D.contaminated(no_docs, bench).count() == 0
    assert D.contaminated(edge_docs, bench.where("item_id > 5")).count() == 0
    kept = D.drop_contaminated(edge_docs, bench)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 6

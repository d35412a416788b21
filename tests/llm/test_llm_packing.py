import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import count, product

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from ledgerloom.llm import packing


def plain_best_fit(counts, capacity):
    rooms = []
    for size in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
        fits = [r for r in rooms if r >= size]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - size)
    return len(rooms)


def test_best_fit_by_counts_is_best_fit():
    random.seed(3)
    for _ in range(60):
        capacity = random.choice((10, 37, 100))
        counts = {random.randint(1, capacity): random.randint(1, 9) for _ in range(random.randint(1, 12))}
        assert sum(t for _, t in packing.best_fit(counts, capacity)) == plain_best_fit(counts, capacity)


def test_counts_are_packed_whole_and_tight():
    random.seed(2)
    for capacity in (10, 100, 2048):
        for _ in range(6):
            counts = {random.randint(1, capacity): random.randint(1, 40) for _ in range(random.randint(1, 60))}
            used, bins = defaultdict(int), 0
            for filling, times in packing.pack_counts(counts, capacity):
                assert sum(s * n for s, n in filling) <= capacity
                bins += times
                for s, n in filling:
                    used[s] += n * times
            assert dict(used) == counts
            assert -(-sum(s * n for s, n in counts.items()) // capacity) <= bins <= plain_best_fit(counts, capacity)
    assert packing.pack_counts({}) == []


def test_branching_beats_best_fit_where_that_fails():
    # Best fit puts 4 + 4 + 2 first; two bins are enough.
    assert sum(t for _, t in packing.pack_counts({6: 1, 5: 2, 4: 1}, 10)) == 2
    assert sum(t for _, t in packing.pack_counts({7: 1, 5: 1, 4: 1, 3: 1, 1: 1}, 10)) == 2


def fewest_bins(pieces, capacity):
    """The least number of bins, by trying every bin for every piece."""
    pieces, best = sorted(pieces, reverse=True), [len(pieces)]

    def place(at, rooms):
        if len(rooms) >= best[0]:
            return
        if at == len(pieces):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= pieces[at]}:
            k = rooms.index(room)
            rooms[k] -= pieces[at]
            place(at + 1, rooms)
            rooms[k] += pieces[at]
        place(at + 1, [*rooms, capacity - pieces[at]])

    place(0, [])
    return best[0]


def test_packings_are_the_fewest_bins():
    random.seed(8)
    cases = [([10, 11, 12, 15, 15, 15, 17, 19, 20, 21, 21, 23], 50)]
    for _ in range(1_500):
        capacity = random.choice((20, 50, 100))
        cases.append(([random.randint(max(1, capacity // 7), capacity // 2 + 5) for _ in range(random.randint(1, 10))], capacity))
    for pieces, capacity in cases:
        counts = Counter(pieces)
        least = fewest_bins(pieces, capacity)
        assert sum(t for _, t in packing.pack_counts(counts, capacity)) == least, (pieces, capacity)
        assert packing.least_bins(counts, capacity) <= least


def test_search_over_many_lengths_keeps_little():
    rng = np.random.default_rng(3)
    counts = {int(s): int(n) for s, n in zip(range(300, 1500), rng.integers(1, 6, 1200))}
    tracemalloc.start()
    packed = packing.pack_counts(counts, 2048, 20_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    placed = Counter()
    for filling, times in packed:
        for s, n in filling:
            placed[s] += n * times
    assert placed == counts and peak < 30e6


def test_fillings_are_all_undominated_ones():
    random.seed(9)
    for _ in range(200):
        counts = {random.randint(1, 20): random.randint(1, 3) for _ in range(random.randint(1, 5))}
        sizes, gap = sorted(counts), random.randint(0, 40)
        ways = [w for w in product(*[range(counts[s] + 1) for s in sizes]) if sum(n * s for n, s in zip(w, sizes)) <= gap]

        def dominated(way):
            room = gap - sum(n * s for n, s in zip(way, sizes))
            there = [s for s, n in zip(sizes, way) if n < counts[s]]
            held = [0, *[s for s, n in zip(sizes, way) if n]]
            return any(0 < s - h <= room for s in there for h in held)

        want = {tuple((s, n) for s, n in reversed([*zip(sizes, w)]) if n) for w in ways if not dominated(w)}
        got = list(packing.fillings(counts, sizes, gap, gap, count()))
        assert len(got) == len(set(got)) and set(got) == want


def test_added_tokens_are_single_ids():
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    added = {t.content: i for i, t in reference.get_added_tokens_decoder().items()}
    encode = packing.Tokens(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added)
    cases = [f"{a}{t}{b}" for t in added for a in ("", "foo", "foo ", t, "  ", "\n") for b in ("", "bar", " bar", t, "  x", "|>")]
    for got, text in zip(encode(pa.array([*cases, "plain text", None])), [*cases, "plain text", ""], strict=True):
        assert got.tolist() == reference.encode(text, add_special_tokens=False).ids, text


def test_documents_that_spell_out_an_added_token(spark):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "foo <|endoftext|> bar"
    row = packing.pack(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    ids = np.array([*reference.encode(text, add_special_tokens=False).ids, 0], "<u4")
    assert (row["length"], row["crc"]) == (len(ids), zlib.crc32(ids.tobytes()))


def test_ids_equal_the_tokenizer():
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    encode = packing.Tokens(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    cases = [
        "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "it's I'll  we'd", "x y z", "café naïve 你好 \U0001f600 ok", "1 22  333 4,4.4!",
        "<|endoftext|> and <|endoftext|>", "tab\tand\r\nline", "end  ", "\n\n", "a　 b", None,
    ]
    for got, text in zip(encode(pa.array(cases)), cases, strict=True):
        assert got.tolist() == reference.encode(text or "", add_special_tokens=False).ids, text


def check(rows, texts, capacity):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    by = defaultdict(list)
    for r in rows:
        by[r["id"]].append(r)
    for key, text in texts.items():
        ids, at = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 0], "<u4"), 0
        parts = sorted(by[key], key=lambda r: r["piece"])
        for k, r in enumerate(parts):
            assert (r["piece"], r["start"]) == (k, at) and (k == 0 or r["length"] == capacity)
            assert r["crc"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and (len(parts) == 1 or len(ids) > capacity)
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_documents_come_back_whole(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents[:150]}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    rows = packing.pack(df).collect()
    sequences = check(rows, texts, 2048)
    assert sequences <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_edges(edge_docs, no_docs):
    rows = packing.pack(edge_docs, capacity=64).collect()
    texts = {r["doc_id"]: r["text"] for r in edge_docs.collect() if r["doc_id"] not in (None, 6)}
    check([r for r in rows], texts, 64)
    assert sum(r["id"] == 6 for r in rows) == 2 and sum(r["id"] is None for r in rows) == 2
    assert packing.pack(no_docs).count() == 0

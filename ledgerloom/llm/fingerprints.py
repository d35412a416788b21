"""SimHash fingerprints of 128 bits, and all fingerprints within a Hamming radius of each other.

Every distinct word of a text votes with its weight for the bits set in its hash, and
against the others.  Votes are added in byte lanes, eight counters to a number, over a
few words of one weight at a time, and then in wider lanes, so that a word costs sixteen
additions.
For the search, fingerprints are cut into blocks; two fingerprints at most r bits apart
agree in all but r blocks.  A table permutes some blocks to the front as its key; over
one table per choice of all but r blocks, every near pair meets at least once.

All of it is DataFrame functions; no Python runs on rows.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import row_positions
from .common import stored, table

BITS = 128
RADIUS = 3
#: Words of up to three characters, most of which are common to all texts, weigh less.
SHORT = 3
WEIGHTS = {"short": 1, "long": 3}
#: Words of one weight whose votes fit a byte lane, the sign bit kept free.
CHUNK = 127
#: A text is changed from its last third on.
EDITED_PART = 3
#: Numbers of blocks to cut fingerprints into, beside the radius; more blocks give more tables with longer keys.
BLOCKS = (1, 2, 3)
#: Fingerprints the number of blocks is chosen on: those of lowest value.
SAMPLE = 100_000
#: What a table row costs, in compared pairs.
ROW_COST = 20.0

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_BYTES = 0x0101010101010101
_HALVES = (1 << 32) + 1


def words(text: Column) -> Column:
    """The distinct words of a text, A-Z in lower case."""
    return F.array_remove(F.array_distinct(F.split(F.translate(text, _UPPER, _UPPER.lower()), _BETWEEN)), "")


def _half(hashes: Column) -> Column:
    """The 64 bits that more than half of the weight votes for; ``hashes`` holds an array per weight, and the total."""
    lanes = [f"s{j}" for j in range(8)]
    wide = [(j, k) for j in range(8) for k in range(4)]
    zero = F.lit(0).cast("bigint")

    def vote(sums: Column, h: Column) -> Column:
        return F.struct(*[(sums[f"s{j}"] + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_BYTES))).alias(f"s{j}") for j in range(8)])

    def widen(sums: Column, chunk: Column) -> Column:
        part = lambda j, k: F.shiftrightunsigned(chunk["sums"][f"s{j}"], 8 * k).bitwiseAND(F.lit(255 * _HALVES)) * chunk["weight"]
        return F.struct(*[(sums[f"s{j}_{k}"] + part(j, k)).alias(f"s{j}_{k}") for j, k in wide])

    def bits(x: Column) -> Column:
        """``lift`` moves a lane's bit 30 to 1 if its votes are over half of the total."""
        parts = [F.shiftleft(F.shiftrightunsigned(x["sums"][f"s{j}_{k}"] + x["lift"], 30).bitwiseAND(F.lit(_HALVES)), j + 8 * k) for j, k in wide]
        while len(parts) > 1:
            parts = [a.bitwiseOR(b) for a, b in zip(parts[::2], parts[1::2])]
        return parts[0]

    def chunks(name: str) -> Column:
        found = hashes[name]
        none = F.struct(*[zero.alias(lane) for lane in lanes])
        one = lambda at: F.struct(F.aggregate(F.slice(found, at, CHUNK), none, vote).alias("sums"), F.lit(WEIGHTS[name]).cast("bigint").alias("weight"))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(found), F.lit(1)), F.lit(CHUNK)), one)

    start = F.struct(*[zero.alias(f"s{j}_{k}") for j, k in wide])
    votes = F.aggregate(F.concat(*[chunks(name) for name in WEIGHTS]), start, widen)
    lift = (F.lit((1 << 30) - 1) - F.shiftright(hashes["total"], 1)) * F.lit(_HALVES)
    return F.transform(F.array(F.struct(votes.alias("sums"), lift.alias("lift"))), bits)[0]


def fingerprint(text: Column) -> Column:
    """``struct<fp0, fp1>``: a bit is 1 if more than half of the weight has it; no words: all bits 0.

    The second half's hashes are hashes of the first half's.
    """

    def first(ws: Column) -> Column:
        long = lambda w: F.length(w) > SHORT
        picked = {"short": F.filter(ws, lambda w: ~long(w)), "long": F.filter(ws, long)}
        return F.struct(*[F.transform(p, lambda w: F.xxhash64(w)).alias(name) for name, p in picked.items()])

    def summed(h: Column) -> Column:
        total = sum((F.size(h[name]).cast("bigint") * n for name, n in WEIGHTS.items()), F.lit(0).cast("bigint"))
        again = [F.transform(h[name], lambda x: F.xxhash64(x)).alias(name) for name in WEIGHTS]
        return F.struct(F.struct(*[h[name].alias(name) for name in WEIGHTS], total.alias("total")).alias("a"), F.struct(*again, total.alias("total")).alias("b"))

    hashes = F.transform(F.transform(F.array(words(text)), first), summed)
    return F.transform(hashes, lambda x: F.struct(_half(x["a"]).alias("fp0"), _half(x["b"]).alias("fp1")))[0]


def distance(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.bit_count(a0.bitwiseXOR(b0)) + F.bit_count(a1.bitwiseXOR(b1))


def likeness(a: Column, b: Column) -> Column:
    """The cosine that the differing bits of two fingerprints stand for, from 0 (right angle or more) to 1 (equal)."""
    differ = distance(a["fp0"], a["fp1"], b["fp0"], b["fp1"])
    return F.greatest(F.cos(F.lit(3.141592653589793 / BITS) * differ), F.lit(0.0))


def as_hex(fp: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(fp["fp1"]), 16, "0"), F.lpad(F.hex(fp["fp0"]), 16, "0")))


def block_masks(blocks: int) -> list[tuple[int, int]]:
    """The bits of each block, as signed masks on both halves; blocks differ by one bit in size at most."""
    masks = []
    for i in range(blocks):
        first, last = i * BITS // blocks, (i + 1) * BITS // blocks
        whole = (1 << last) - (1 << first)
        masks.append(tuple(m - (1 << 64) if m >> 63 else m for m in (whole & ((1 << 64) - 1), whole >> 64)))
    return masks


def tables(blocks: int, radius: int) -> list[tuple[int, int]]:
    """Key masks of the tables: every choice of all but ``radius`` blocks."""
    masks = block_masks(blocks)
    out = []
    for chosen in combinations(masks, blocks - radius):
        m0 = m1 = 0
        for a, b in chosen:
            m0, m1 = m0 | a, m1 | b
        out.append((m0, m1))
    return out


def _keyed(fps: DataFrame, keys: list[tuple[int, int]]) -> DataFrame:
    entries = [
        F.struct(F.lit(i).alias("t"), F.col("fp0").bitwiseAND(F.lit(m0)).alias("k0"), F.col("fp1").bitwiseAND(F.lit(m1)).alias("k1"))
        for i, (m0, m1) in enumerate(keys)
    ]
    return fps.select("fp0", "fp1", F.explode(F.array(*entries)).alias("x")).select("fp0", "fp1", "x.*")


def choose_blocks(fps: DataFrame, n: int, radius: int) -> int:
    """The number of blocks with the least estimated rows and compared pairs; any number finds the same pairs."""
    sample = stored(fps.orderBy("fp0", "fp1").limit(SAMPLE), "fingerprints-sample")
    grow = n / max(sample.count(), 1)
    costs = {}
    for more in BLOCKS:
        keys = tables(radius + more, radius)
        met = _keyed(sample, keys).groupBy("t", "k0", "k1").agg(F.count(F.lit(1)).alias("c"))
        pairs = met.agg(F.sum((F.col("c") * (F.col("c") - 1)).cast("double")).alias("p")).first()["p"] or 0.0
        costs[radius + more] = ROW_COST * n * comb(radius + more, radius) + pairs * grow * grow
    return min(costs, key=costs.get)


def near_fingerprints(fps: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """All pairs ``a0, a1, b0, b1`` (a before b) of the distinct fingerprints ``fp0, fp1`` at most ``radius`` bits apart, each once.

    Of the tables in which a pair meets, only the first gives it out.
    """
    if blocks is None:
        blocks = choose_blocks(fps, fps.count(), radius)
    keys = tables(blocks, radius)
    left = _keyed(fps, keys).select(F.col("fp0").alias("a0"), F.col("fp1").alias("a1"), "t", "k0", "k1")
    right = _keyed(fps, keys).select(F.col("fp0").alias("b0"), F.col("fp1").alias("b1"), "t", "k0", "k1")
    x0, x1 = F.col("a0").bitwiseXOR(F.col("b0")), F.col("a1").bitwiseXOR(F.col("b1"))
    meet = [F.when((x0.bitwiseAND(F.lit(m0)) == 0) & (x1.bitwiseAND(F.lit(m1)) == 0), F.lit(i)) for i, (m0, m1) in enumerate(keys)]
    before = (F.col("a0") < F.col("b0")) | ((F.col("a0") == F.col("b0")) & (F.col("a1") < F.col("b1")))
    near = (distance(F.col("a0"), F.col("a1"), F.col("b0"), F.col("b1")) <= radius) & before
    first = left["t"] == F.coalesce(*meet) if len(meet) > 1 else F.lit(True)
    same = (left["t"] == right["t"]) & (left["k0"] == right["k0"]) & (left["k1"] == right["k1"])
    return left.hint("shuffle_merge").join(right, same & near & first).select("a0", "a1", "b0", "b1")


def near_counts(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp0, fp1, n_near`` per distinct fingerprint: the other rows of ``fps`` at most ``radius`` bits away, equal ones included."""
    classes = stored(fps.groupBy("fp0", "fp1").agg(F.count(F.lit(1)).alias("rows")), "fingerprints-classes")
    pairs = stored(near_fingerprints(classes.select("fp0", "fp1"), radius), "fingerprints-pairs")
    ends = pairs.select(F.col("a0").alias("fp0"), F.col("a1").alias("fp1"), F.col("b0").alias("o0"), F.col("b1").alias("o1")).union(
        pairs.select("b0", "b1", "a0", "a1")
    )
    others = classes.select(F.col("fp0").alias("o0"), F.col("fp1").alias("o1"), F.col("rows").alias("more"))
    met = ends.join(others, ["o0", "o1"]).groupBy("fp0", "fp1").agg(F.sum("more").alias("more"))
    return classes.join(met, ["fp0", "fp1"], "left").select("fp0", "fp1", (F.col("rows") - 1 + F.coalesce("more", F.lit(0))).alias("n_near"))


def next_ids(rows: DataFrame) -> DataFrame:
    """``asker, giver, giver_hash, most`` per distinct id of (id, text, text_hash): the next smaller id, the largest one after the smallest.

    The giver's row is the one whose text hashes lowest; ``most`` is the longest
    replacement that a row with the asker's id takes.
    """
    longest = F.max(F.floor(F.length("text") / EDITED_PART)).alias("most")
    ids = rows.groupBy("id").agg(F.min("text_hash").alias("least"), longest)
    placed = stored(row_positions(ids, ["id"], [], "at"), "fingerprints-order")
    n = placed.count()
    askers = placed.select(F.col("id").alias("asker"), "most", ((F.col("at") - 1 + n) % F.greatest(F.lit(n), F.lit(1))).alias("at"))
    givers = placed.select(F.col("id").alias("giver"), F.col("least").alias("giver_hash"), "at")
    return askers.join(givers, "at").select("asker", "giver", "giver_hash", "most")


def edited_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, text, edited, fp, next_fp`` per row of ``docs``.

    ``edited`` is the text with its last third replaced by the head of the next document's
    in descending order of ids (``next_ids``); ``fp`` and ``next_fp`` are fingerprints of
    the text and of the next document's.  Texts are dealt out once, by id, for both joins.
    """
    known = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    known = known.withColumn("text_hash", F.xxhash64("text"))
    asked = next_ids(known.where("id IS NOT NULL"))
    printed = known.withColumn("fp", fingerprint(F.col("text")))
    here = printed.where("id IS NOT NULL").select("id", "text_hash", "text", "fp")
    # The hash is compared so that Spark deals by the id alone, as for the other join.
    same = F.col("text_hash").bitwiseXOR(F.col("giver_hash")) == 0
    given = here.hint("shuffle_merge").join(asked, (F.col("id") == F.col("giver")) & same)
    heads = given.select("giver", "asker", F.expr("left(text, cast(most AS int))").alias("head"), F.col("fp").alias("next_fp"))
    heads = heads.dropDuplicates(["giver", "asker"])
    size = F.floor(F.length("text") / EDITED_PART).cast("int")
    rest = F.substring(F.col("text"), F.lit(1), F.length("text") - size)
    both = here.hint("shuffle_merge").join(heads, F.col("id") == F.col("asker"))
    both = both.select("id", "text_hash", "text", F.concat(rest, F.substring(F.col("head"), F.lit(1), size)).alias("edited"), "fp", "next_fp")
    none = F.struct(F.lit(0).cast("bigint").alias("fp0"), F.lit(0).cast("bigint").alias("fp1"))
    alone = printed.where("id IS NULL").select("id", "text_hash", "text", rest.alias("edited"), "fp", none.alias("next_fp"))
    return both.union(alone)


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``id, n_chars, text_hash, edited_sha256, fp, edited_fp, near_edited, near_next, n_near`` per row of ``docs``.

    ``n_near`` counts the other rows with a fingerprint at most ``radius`` bits away.  Equal
    texts have equal fingerprints.  A null text counts as empty; texts without words have
    fingerprint zero, which is like itself.  The next document of rows that share an id is
    that of the next smaller id, and of several texts there the one that hashes lowest.
    Rows with a null id have no place in the order: their edited text is the text without
    its last third, and their next document is an empty one.  A single document is its own
    next.  An empty table gives an empty result; other columns are ignored.
    """
    rows = edited_texts(docs, id_col, text_col).withColumn("edited_fp", fingerprint(F.col("edited")))
    found = stored(
        rows.select(
            "id",
            F.length("text").cast("bigint").alias("n_chars"),
            "text_hash",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            "fp",
            "edited_fp",
            likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
            likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        ),
        "fingerprints",
    )
    counts = near_counts(found.select("fp.fp0", "fp.fp1"), radius)
    here = (F.col("fp.fp0") == counts["fp0"]) & (F.col("fp.fp1") == counts["fp1"])
    return found.join(counts, here).select(*found.columns, "n_near")


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how near they are."""
    return compare_edits(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next", "text_hash", "n_near",
    )

"""Lines that repeat an earlier line up to a few edits: a segment-partition edit join, in DataFrame functions only.

Two lines at most T edits apart share one of T + 1 segments of the shorter one, at
nearly the same place.  Lines are indexed by (length, segment number, segment) and
probed with the substrings that multi-match-aware bounds allow for each length
difference.  A sketch of letter counts, which T edits change by 2 T in all at
most, is part of the join condition, so that lines which only share a segment are
never put out as pairs.  A banded bit-parallel edit distance settles the rest.
A line goes if any line near it comes first, so it need not meet all of them: under a
key that many lines share it first meets the few earliest, and only a line that these
leave undecided meets the rest.  There, counts of more letters are compared as well.
Texts are not shuffled for any of this but for documents that hold candidates or
lose lines; a bit set of fixed size, sent to all tasks, tells which these may be.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.arithmetic import col
from ..sources import checkpoint
from .common import fresh, stored, table

EDITS = 1
#: Shorter lines (code points, trimmed) are not compared, and removed only as exact repeats where a caller asks for that.
MIN_CHARS = 40
#: Characters whose counts make up the sketch, with the bits of a count (a larger count is cut to the largest).
SKETCH, COUNT_BITS = " etnr", 12
#: Characters counted besides, modulo 256, in the lines of keys with many lines; eight to a column.
WIDE = "aoishdlu", "cmpfgybv", "wkxqzj.,"
#: Bits of the document sets that are broadcast (256 kB); a fuller set only lets more documents through.
SET_BITS = 1 << 21
#: Lines of a key that every line of the key is compared with at first.
HEADS = 16
#: Columns after which the verification of long lines may stop.
HEAD = 32


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), 0)


def _shared(x: Column, y: Column, most: Column, end: bool) -> Column:
    """How many characters, up to ``most``, two texts have in common at their start or ``end``: a search by halves."""
    nx, ny = F.length(x), F.length(y)

    def grow(n: Column, step: Column) -> Column:
        at = (nx - n - step + 1, ny - n - step + 1) if end else (n + 1, n + 1)
        same = F.when(n + step <= most, F.substr(x, at[0], step) == F.substr(y, at[1], step))
        return n + F.when(same, step).otherwise(0)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(31))]), F.lit(0), grow)


def edit_distance_within(a: Column, b: Column, edits: int) -> Column:
    """Whether texts ``a`` (the longer) and ``b`` are at most ``edits`` apart.

    What both start and end with is cut off first.  Then bit-parallel, banded:
    bit d of a vector stands for row j - edits + d in column j.  Up to the column
    where the band meets the last row the distance is followed along the lowest
    diagonal, then along the last row.  A long text is followed for ``HEAD``
    columns at first; where the whole band is beyond ``edits`` there, so is the end.
    """
    width = 2 * edits + 1
    zero = F.lit(0).cast("bigint")

    def bits(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))

    def bit(x: Column, place: Column) -> Column:
        return F.call_function("shiftright", x, place).bitwiseAND(F.lit(1).cast("bigint"))

    def follow(x: Column, y: Column, m: Column, end: Callable[[Column], Column]) -> Column:
        """``end`` of the last state, over the columns ``y``, of a text of ``m`` characters that starts with ``x``."""

        def columns(t: Column) -> Column:
            p, q = t["p"], t["q"]

            def same(c: Column, at: Column) -> Column:  # at: the column, from 0
                hits = [F.when((at >= edits - d) & F.get(p, at - edits + d).eqNullSafe(c), F.lit(1 << d).cast("bigint")).otherwise(zero) for d in range(width)]
                return reduce(Column.bitwiseOR, hits)

            def advance(s: Column, x: Column) -> Column:
                eq, vp, vn = x["eq"], s["vp"], s["vn"]
                last = m - x["j"] + edits  # the bit of the last row, once the band has met it

                def step(d0: Column) -> Column:
                    hp, hn, down = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))), d0.bitwiseAND(vp), F.shiftright(d0, 1)
                    change = F.when(x["j"] <= m - edits, 1 - bit(d0, F.lit(2 * edits))).otherwise(bit(hp, last) - bit(hn, last))
                    return F.struct(
                        bits(hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)))).alias("vp"),
                        bits(down.bitwiseAND(hp)).alias("vn"),
                        (s["dist"] + change).alias("dist"),
                    )

                return _let(bits((eq.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(eq).bitwiseOR(vn)), step)

            first = F.lit(((1 << (edits + 1)) - 1) << edits).cast("bigint")
            start = F.struct(first.alias("vp"), zero.alias("vn"), F.lit(edits).cast("bigint").alias("dist"))
            return F.aggregate(F.transform(q, lambda c, at: F.struct(same(c, at).alias("eq"), (at + 1).alias("j"))), start, advance, end)

        return _let(F.struct(F.split(x, "").alias("p"), F.split(y, "").alias("q")), columns)

    def least(s: Column) -> Column:
        """The smallest value of the band, up from the lowest diagonal."""
        values = [s["dist"]]
        for d in reversed(range(2 * edits)):
            values.append(values[-1] - bit(s["vp"], F.lit(d)) + bit(s["vn"], F.lit(d)))
        return F.least(*values) <= edits

    def within(t: Column) -> Column:
        x, y, m = t["x"], t["y"], F.length(t["x"])
        hopeful = follow(F.left(x, F.lit(HEAD + edits)), F.left(y, F.lit(HEAD)), m, least)
        whole = follow(x, y, m, lambda s: s["dist"] <= edits)
        long = (m >= 2 * HEAD) & (F.length(y) >= HEAD)
        return F.when(m <= edits, F.length(y) <= m).when(F.length(y) < m - edits, False).when(long & ~hopeful, False).otherwise(whole)

    def middle(t: Column, n: Column) -> Column:
        return F.substr(t, n["start"] + 1, F.length(t) - n["start"] - n["end"])

    def cut(t: Column) -> Column:
        x, y = t["x"], t["y"]
        tail = lambda n: F.struct(n.alias("start"), _shared(x, y, F.length(y) - n, True).alias("end"))
        ends = _let(_shared(x, y, F.length(y), False), tail)
        return _let(_let(ends, lambda n: F.struct(middle(x, n).alias("x"), middle(y, n).alias("y"))), within)

    return _let(F.struct(a.alias("x"), b.alias("y")), cut)


def _segments(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """Start (from 1) and size of each segment of a line of that length; the later ones may be one longer."""
    parts = edits + 1
    base = F.floor(length / parts).cast("int")
    short = parts - length % parts
    return [
        (F.lit(i) * base + F.greatest(F.lit(0), F.lit(i) - short) + 1, base + F.when(F.lit(i) >= short, 1).otherwise(0)) for i in range(parts)
    ]


def _keys(line: Column, length: Column, edits: int) -> tuple[list[Column], list[Column]]:
    """Keys a line is found by, and keys it looks for beyond its own."""
    own = [F.xxhash64(F.lit(i), length, F.substr(line, at, size)) for i, (at, size) in enumerate(_segments(length, edits))]
    others = []
    for shorter in range(edits + 1):
        for i, (at, size) in enumerate(_segments(length - shorter, edits)):
            left, right = i, edits - i
            for shift in range(max(-left, shorter - right), min(left, shorter + right) + 1):
                if shorter or shift:
                    others.append(F.xxhash64(F.lit(i), length - shorter, F.substr(line, at + shift, size)))
    return own, others


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``id, th, pos, line, length``: the lines that count, trimmed and in lower case.

    A text is lower-cased as a whole: a case mapping named below would be worked
    out anew wherever its result is used.
    """
    split = docs.select("id", "th", F.posexplode(F.split(F.lower("text"), "\n")).alias("pos", "raw"))
    clean = split.select("id", "th", "pos", F.trim("raw").alias("line"))
    return clean.withColumn("length", F.length("line")).where(F.col("length") >= min_chars)


def _set_of(df: DataFrame, hashes: Column) -> Column:
    """The set of hashes of ``df`` as one value, a bit array of fixed size."""
    place = F.pmod(hashes, F.lit(SET_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    words = df.select((place / 64).cast("int").alias("word"), bit.alias("bits"))
    empty = df.sparkSession.range(SET_BITS // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    merged = words.union(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))  # SET_BITS / 64 rows
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return checkpoint(merged.agg(F.transform(ordered, lambda x: x["bits"]).alias("bits"))).scalar()


def _in_set(bits: Column, hashes: Column) -> Column:
    """Whether hashes may be in the set; false alarms only."""
    place = F.pmod(hashes, F.lit(SET_BITS))
    word = F.get(bits, (place / 64).cast("int"))
    return F.call_function("shiftright", word, (place % 64).cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1


def line_keys(occurrences: DataFrame, edits: int) -> DataFrame:
    """``h, sketch, key, probe`` of lines ``h, line, length``, stored; a row per line and key.

    Keys a line is found by are no probes; copies of a line are one row.
    """
    most = (1 << COUNT_BITS) - 1
    counts = [F.least(F.col("length") - F.length(F.replace("line", F.lit(c), F.lit(""))), F.lit(most)).cast("bigint") for c in SKETCH]
    sketch = reduce(Column.bitwiseOR, [F.call_function("shiftleft", n, F.lit(k * COUNT_BITS)) for k, n in enumerate(counts)])
    own, others = _keys(F.col("line"), F.col("length"), edits)
    named = {f"key{i}": key for i, key in enumerate([*own, *others])}
    # Copies meet as one row per line; only then is a row made per key.
    lines = occurrences.select("h", sketch.alias("sketch"), *[key.alias(name) for name, key in named.items()]).distinct()
    keys = F.array(*[F.struct(F.col(name).alias("key"), F.lit(i >= len(own)).alias("probe")) for i, name in enumerate(named)])
    if edits > 1:  # a segment is looked for at several places, whose texts may be equal
        keys = F.array_distinct(keys)
    return stored(lines.select("h", "sketch", F.inline(keys)), "line-keys")


def _letters_apart(a: str, b: str) -> Column:
    """By how many letters two sketches differ at least."""
    most = F.lit((1 << COUNT_BITS) - 1).cast("bigint")
    count = lambda x, k: F.shiftright(x, k * COUNT_BITS).bitwiseAND(most)
    return reduce(Column.__add__, [F.abs(count(a, k) - count(b, k)) for k in range(len(SKETCH))])


def _wide(line: Column) -> list[Column]:
    """Counts of the letters ``WIDE``, a byte each."""
    counts = [[(F.length(line) - F.length(F.replace(line, F.lit(c), F.lit("")))).bitwiseAND(255).cast("bigint") for c in part] for part in WIDE]
    return [reduce(Column.bitwiseOR, [F.call_function("shiftleft", n, F.lit(8 * k)) for k, n in enumerate(part)]) for part in counts]


def _wide_apart(a: str, b: str) -> list[Column]:
    """By how many letters of each part of ``WIDE`` two lines differ at least; ``a`` and ``b`` name arrays."""

    def apart(part: int, k: int) -> Column:
        byte = lambda x: F.shiftright(F.get(x, F.lit(part)), 8 * k).bitwiseAND(F.lit(255).cast("bigint"))
        return 128 - F.abs(128 - F.abs(byte(a) - byte(b)))

    return [reduce(Column.__add__, [apart(part, k) for k in range(len(letters))]) for part, letters in enumerate(WIDE)]


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def deep_keys(rows: DataFrame) -> DataFrame:
    """The keys that more than ``HEADS`` lines are found by."""
    return checkpoint(rows.where("NOT probe").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HEADS).select("key"))


def shallow_pairs(rows: DataFrame, edits: int) -> DataFrame:
    """Pairs ``a, b`` of line hashes that may be near: each line with those of its keys."""
    left = rows.where("NOT probe").select("key", F.col("h").alias("a"), "sketch")
    right = rows.select(F.col("key").alias("key2"), F.col("h").alias("b"), F.col("sketch").alias("sketch2"), "probe")
    once = (F.col("a") < F.col("b")) | (F.col("probe") & (F.col("a") != F.col("b")))
    met = left.hint("shuffle_merge").join(right, (F.col("key") == F.col("key2")) & once & (_letters_apart(F.col("sketch"), F.col("sketch2")) <= 2 * edits))
    return _pairs(met)


def _deep_pairs(left: DataFrame, right: DataFrame, which: Column, edits: int) -> DataFrame:
    """Pairs of lines of one key, ``left`` those that it is found by, where ``which`` holds of ``place`` and ``open`` (on the right ``open2``)."""
    right = right.select(
        F.col("key").alias("key2"), F.col("h").alias("b"), F.col("sketch").alias("sketch2"), F.col("wide").alias("wide2"), F.col("probe").alias("probe2"),
        F.col("open").alias("open2"),
    )
    apart = [_letters_apart(F.col("sketch"), F.col("sketch2")), *_wide_apart("wide", "wide2")]
    for n in range(1, len(apart) + 1):  # few pairs get beyond the first part
        which = which & (reduce(Column.__add__, apart[:n]) <= 2 * edits)
    met = left.withColumnRenamed("h", "a").hint("shuffle_merge").join(right, (F.col("key") == F.col("key2")) & which)
    return _pairs(met)


def head_pairs(some: DataFrame, edits: int) -> DataFrame:
    """Pairs under deep keys, each line with the ``HEADS`` earliest that a key finds.  ``some``: ``key, h, sketch, probe, first, wide``."""
    order = Window.partitionBy("key").orderBy("first", "h")
    heads = some.where("NOT probe").withColumn("place", F.row_number().over(order)).where(F.col("place") <= HEADS)
    # A line may be later than a head and have the smaller hash.
    return _deep_pairs(heads, some.withColumn("open", F.lit(True)), F.col("a") != F.col("b"), edits)


def late_pairs(some: DataFrame, decided: DataFrame, edits: int) -> DataFrame:
    """Pairs under deep keys, at least one line of which is not among the ``decided`` (``h``)."""
    some = some.join(decided.select("h", F.lit(False).alias("open")), "h", "left").withColumn("open", F.coalesce("open", F.lit(True)))
    once = (F.col("a") < F.col("b")) | (F.col("probe2") & (F.col("a") != F.col("b")))
    return _deep_pairs(some.where("NOT probe"), some, once & (F.col("open") | F.col("open2")), edits)


def line_texts(hashes: DataFrame, firsts: DataFrame, slim: DataFrame) -> DataFrame:
    """``h, h2, first, line`` of the lines ``hashes`` (``h``, distinct), fetched from the documents that hold their first occurrences; stored."""
    asked = checkpoint(firsts.join(hashes, "h").select("h", "h2", "first"))
    wanted = asked.select(F.col("first.id").alias("id"), F.col("first.th").alias("th"), F.col("first.pos").alias("pos"), "h", "h2")
    some = slim.where(_in_set(_set_of(wanted, F.xxhash64("id")), F.xxhash64("id")))
    per_doc = wanted.groupBy("id", "th").agg(F.collect_list(F.struct("pos", "h", "h2")).alias("at"))
    texts = (
        some.distinct().join(per_doc, ["id", "th"]).select("id", "th", F.split("text", "\n").alias("lines"), F.explode("at").alias("x"))
        .select("x.h", "x.h2", F.struct("id", "th", "x.pos").alias("first"), F.lower(F.trim(F.get("lines", F.col("x.pos")))).alias("line"))
    )
    return stored(texts, "line-texts")


def _lines_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("h")).union(pairs.select(F.col("b").alias("h"))).distinct()


def later_lines(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """``h, h2`` of the later line of each pair ``a, b`` that is at most ``edits`` apart, each once; ``texts`` of :func:`line_texts`."""
    left = texts.select(F.col("h").alias("a"), F.col("h2").alias("a2"), F.col("first").alias("first_a"), F.col("line").alias("x"))
    right = texts.select(F.col("h").alias("b"), F.col("h2").alias("b2"), F.col("first").alias("first_b"), F.col("line").alias("y"))
    both = pairs.join(left, "a").join(right, "b").where(F.abs(F.length("x") - F.length("y")) <= edits)
    longer = F.length("x") >= F.length("y")
    both = both.select(
        "a", "a2", "b", "b2", "first_a", "first_b",
        F.when(longer, F.col("x")).otherwise(F.col("y")).alias("p"), F.when(longer, F.col("y")).otherwise(F.col("x")).alias("q"),
    )
    linked = both.where(edit_distance_within(F.col("p"), F.col("q"), edits))
    return linked.select(
        F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a")).alias("h"),
        F.when(F.col("first_a") < F.col("first_b"), F.col("b2")).otherwise(F.col("a2")).alias("h2"),
    ).distinct()


def drop_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS, repeats_from: int | None = None,
    counts: tuple[str, str] = ("__lines", "__removed"),
) -> DataFrame:
    """``docs`` with ``text_col`` less the lines met before, plus two columns ``counts``: numbers of lines, and of those removed.

    Lines are parted by line feeds and compared trimmed and in lower case.  A
    line of ``min_chars`` or more goes if the same line, or one at most ``edits``
    edits away, comes first at an earlier place (smaller id, then earlier in the
    text).  Of shorter lines, exact repeats go from ``repeats_from`` characters
    on (1: all but blank lines; None: all shorter lines stay).  Links are judged on the input, so a line may go
    for one that goes itself.  Null texts stay null and have no lines.  Rows with
    a null id stay as they are.  Rows of equal id and text count as one document
    and are treated alike; of an id with several texts the order is by hash.
    Other columns are passed through, whatever their names; names for ``counts`` must be free.
    """
    id_, th_, gone_id, gone_th, gone_ = fresh(docs, "__id", "__th", "__gone_id", "__gone_th", "__gone")
    th = F.xxhash64(F.col(text_col))
    slim = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), th.alias("th"), F.col(text_col).alias("text"))
    least = min_chars if repeats_from is None else min(min_chars, repeats_from)
    lines = _lines(slim, least).withColumn("h", F.xxhash64("line"))
    places = lines.select("h", F.xxhash64(F.lit(1), "line").alias("h2"), "id", "th", "pos")
    where = F.struct("id", "th", "pos")
    firsts = stored(places.groupBy("h", "h2").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n")), "line-firsts")

    rows = line_keys(lines.where(F.col("length") >= min_chars).select("h", "line", "length"), edits)
    deep = deep_keys(rows)
    if deep.isEmpty():
        pairs = stored(shallow_pairs(rows, edits), "line-pairs")
        later = later_lines(pairs, line_texts(_lines_of(pairs), firsts, slim), edits)
    else:
        bits = _set_of(deep, F.col("key"))
        some = rows.where(_in_set(bits, F.col("key")))
        texts = line_texts(some.select("h").distinct(), firsts, slim)
        known = texts.select("h", F.col("first"), F.array(*_wide(F.col("line"))).alias("wide"))
        some = stored(some.join(known, "h"), "line-deep")
        later = stored(later_lines(stored(head_pairs(some, edits), "line-pairs"), texts, edits), "line-later")
        late = stored(late_pairs(some, later.select("h").distinct(), edits), "line-pairs")
        pairs = stored(shallow_pairs(rows.where(~_in_set(bits, F.col("key"))), edits), "line-pairs")
        near = later_lines(pairs, line_texts(_lines_of(pairs), firsts, slim), edits)
        later = later.union(later_lines(late, texts, edits)).union(near).distinct()

    # Where lines go: every place of a line with an earlier neighbour, and of a repeated line all but the first.
    marks = (
        firsts.join(later.withColumn("near", F.lit(True)), ["h", "h2"], "left")
        .where("near OR n > 1")
        .select("h", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    )
    marks = stored(marks, "line-marks")
    gone = (
        places.join(marks.select("h", "h2", "first", "near"), ["h", "h2"]).where(F.col("near") | (where != F.col("first"))).select("id", "th", "pos")
    )
    removed = gone.groupBy(F.col("id").alias(gone_id), F.col("th").alias(gone_th)).agg(F.collect_set("pos").alias(gone_))
    removed = checkpoint(removed)

    # Texts that lose nothing are not shuffled.
    key = F.xxhash64(F.col(id_col).cast("bigint"))
    base = docs.withColumns({id_: F.col(id_col).cast("bigint"), th_: th})
    hit = F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & _in_set(_set_of(removed, F.xxhash64(gone_id)), key)
    split = F.split(F.col(text_col), "\n")
    count = F.coalesce(F.size(split), F.lit(0)).cast("bigint")
    count = F.when(F.col(text_col).isNull(), F.lit(0).cast("bigint")).otherwise(count)
    whole = base.where(~hit).select(*[col(c) for c in docs.columns], count.alias(counts[0]), F.lit(0).cast("bigint").alias(counts[1]))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone_)), lambda i: F.get(split, i))
    changed = base.where(hit).join(removed, (F.col(id_) == F.col(gone_id)) & (F.col(th_) == F.col(gone_th)), "left").select(
        *[F.when(F.col(gone_).isNull(), col(c)).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col else col(c) for c in docs.columns],
        count.alias(counts[0]),
        F.when(F.col(gone_).isNull(), 0).otherwise(F.size(gone_)).cast("bigint").alias(counts[1]),
    )
    return whole.union(changed)


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines met before up to one edit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_lines(docs).select(
        "doc_id",
        F.col("__lines").alias("n_lines"),
        F.col("__removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )

"""Personal data in texts: base patterns, and further spans chosen by boosted trees; DataFrame functions only.

Generators of high recall propose spans, which may overlap.  Spans that a base
pattern finds and its check accepts are positives, spans that the check refuses
and spans glued to other characters negatives; boosted trees learn them from
features of format and context that do not tell the base patterns themselves.
The other proposals are scored.  A threshold per kind, set where the precision on
labelled spans that the trees have not seen reaches a goal, selects those to add.

Places are found without Python: a replacement puts marks around matches, the
text is split at the marks, and lengths are added up within a document.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import checkpoint
from .common import stored, table

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  Nothing can follow a repetition that it could give back, so repetitions are
# possessive; look-behinds keep a search from starting inside a run whose start has failed already
# (\G: right after the match before).  They find what the plain patterns find, in linear time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider generators: other separators, spelled-out signs, no country sign, other lengths.
WIDE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:@|[(\[{] ?at ?[)\]}]) ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[{] ?dot ?[)\]}]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?: ?[.] ?[0-9]{1,3}+){3}|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){12,18}+",
    "phone": r"(?<![0-9+])[(]?[0-9][\x20().0-9/-]{5,22}[0-9]",
}
#: A text without any of these holds no match.
LIKELY_BASE = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
LIKELY_WIDE = {"email": r"@|[(\[{] ?at ?[)\]}]", "ip": r"[0-9] ?[.]|[0-9A-Fa-f]:", "card": "[0-9]", "phone": "[0-9]"}

#: Two characters that no text should hold; where one does, it counts as U+FFFD.
_OPEN, _CLOSE, _OTHER = chr(0xFDD0), chr(0xFDD1), chr(0xFFFD)
CONTEXT = 24
#: Labelled spans of each kind that the trees learn from: those with the lowest hashes.  Thresholds are set on all held-out spans.
TRAINING = 20_000
TREES, DEPTH = 20, 4
PRECISION = 0.98

_FEATURES = (
    "size digits share groups longest spaces dashes dots brackets letters capitals distinct glued_left glued_right told denied assigned "
    "is_email is_ip is_card is_phone"
).split()


def find(docs: DataFrame, patterns: Mapping[str, str], likely: Mapping[str, str]) -> DataFrame:
    """``id, th, kind, start, end, span, before, after``: the leftmost non-overlapping matches per kind.

    ``docs`` has ``id, th, text``; places are code points, ends are exclusive.
    Texts without a match leave the plan before anything is shuffled, and of
    the rest only matches and context are.
    """
    out = None
    for kind, pattern in patterns.items():
        marked = F.regexp_replace(F.translate("text", _OPEN + _CLOSE, _OTHER * 2), F.lit(pattern), F.lit(f"{_OPEN}$0{_CLOSE}"))
        parts = (
            docs.where(F.col("text").rlike(likely[kind])).select("id", "th", F.split(marked, f"[{_OPEN}{_CLOSE}]").alias("parts"))
            .where(F.size("parts") > 1).select("id", "th", F.posexplode("parts").alias("i", "part"))
        )
        inside = F.col("i") % 2 == 1
        parts = parts.select(
            "id", "th", F.lit(kind).alias("kind"), "i", F.length("part").cast("bigint").alias("size"),
            F.when(inside, F.col("part")).alias("span"),
            F.when(~inside, F.substring("part", -CONTEXT, CONTEXT)).alias("tail"),
            F.when(~inside, F.substring("part", 1, CONTEXT)).alias("head"),
        )
        out = parts if out is None else out.union(parts)
    # Equal rows of the input are one document here.
    in_text = Window.partitionBy("id", "th", "kind").orderBy("i")
    start = F.coalesce(F.sum("size").over(in_text.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = out.distinct().select(
        "id", "th", "kind", "span", start.alias("start"), (start + F.col("size")).alias("end"),
        F.lag("tail").over(in_text).alias("before"), F.lead("head").over(in_text).alias("after"),
    )
    return placed.where("span IS NOT NULL")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    values = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.substr(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1),
    )
    total = F.aggregate(values, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v))
    return (n > 0) & (total % 10 == 0)


def accepted() -> Column:
    """Whether the base check of its kind accepts the span."""
    digits = F.regexp_replace("span", "[^0-9]", "")
    n = F.length(digits)
    parts = F.transform(F.split("span", "[.]"), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", small)
        .when(F.col("kind") == "card", F.when((n >= 16) & (n <= 19), luhn(digits)).otherwise(False))
        .otherwise((n >= 8) & (n <= 15))
    )


def described(spans: DataFrame) -> DataFrame:
    """Adds the features: the span's format, and its context."""
    def count(pattern: str) -> Column:
        return (F.length("span") - F.length(F.regexp_replace("span", pattern, ""))).cast("double")

    groups = F.filter(F.split("span", "[^0-9]+"), lambda g: g != "")
    near = F.lower("before")
    features = {
        "size": F.length("span").cast("double"),
        "digits": count("[0-9]"),
        "share": count("[0-9]") / F.length("span"),
        "groups": F.size(groups).cast("double"),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)).cast("double"),
        "spaces": count(" "),
        "dashes": count("-"),
        "dots": count("[.]"),
        "brackets": count(r"[()\[\]{}]"),
        "letters": count("[A-Za-z]"),
        "capitals": count("[A-Z]"),
        "distinct": F.size(F.array_distinct(F.split("span", ""))).cast("double"),
        "glued_left": F.coalesce("before", F.lit("")).rlike(r"[\p{L}\p{N}_=#/\\.:+-]$").cast("double"),
        "glued_right": F.coalesce("after", F.lit("")).rlike(r"^(?:[\p{L}\p{N}_=#/\\@]|[.:-][\p{L}\p{N}])").cast("double"),
        "told": F.coalesce(near, F.lit("")).rlike(r"\b(tel|phone|call|fax|mobile|mail|contact|card|visa|ip|host|server|address)\b").cast("double"),
        "denied": F.coalesce(near, F.lit("")).rlike(r"\b(version|isbn|issn|order|invoice|id|token|key|hash|password|serial|page|doi)\b").cast("double"),
        "assigned": F.coalesce("before", F.lit("")).rlike("[=:\"'#] ?$").cast("double"),
        **{f"is_{k}": (F.col("kind") == k).cast("double") for k in KINDS},
    }
    return spans.withColumns(features)


def _sample(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of each kind; each is a limit of its own, taken in every task before the last sort."""
    out = None
    for kind in KINDS:
        some = rows.where(F.col("kind") == kind).orderBy(F.xxhash64("id", "kind", "start"), "id", "th", "kind", "start").limit(most)
        out = some if out is None else out.union(some)
    return out


def train(labelled: DataFrame) -> tuple[GBTClassificationModel | None, dict[str, float]]:
    """Trees and the threshold of each kind; no trees where only one label occurs."""
    hashed = F.pmod(F.xxhash64("th", "start"), F.lit(10))
    learning, held = checkpoint(_sample(labelled.where(hashed >= 3), TRAINING)), labelled.where(hashed < 3)
    if learning.select("label").distinct().count() < 2:
        return None, {}
    assembler = VectorAssembler(inputCols=list(_FEATURES), outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7, labelCol="label", featuresCol="features")
    model = trees.fit(assembler.transform(learning).select("features", "label"))
    scored = chances(model, held)
    steps = scored.groupBy("kind", F.floor(F.col("chance") * 100).alias("step")).agg(F.sum("label").alias("yes"), F.count(F.lit(1)).alias("n")).collect()
    limits = {}
    for kind in KINDS:
        yes = n = 0
        for r in sorted((r for r in steps if r["kind"] == kind), key=lambda r: -r["step"]):
            yes, n = yes + r["yes"], n + r["n"]
            if yes >= 20 and yes >= PRECISION * n:
                limits[kind] = r["step"] / 100
    return model, limits


def chances(model: GBTClassificationModel, spans: DataFrame) -> DataFrame:
    rows = VectorAssembler(inputCols=list(_FEATURES), outputCol="features").transform(spans)
    return model.transform(rows).withColumn("chance", F.get(vector_to_array("probability"), F.lit(1)))


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, base, added`` per row: arrays of ``(kind, start, end)`` in the order of ``KINDS``, then start.

    ``base`` holds the accepted matches of the base patterns, ``added`` the
    chosen proposals, which overlap neither those nor each other.  Null and
    empty texts have none.  Null and repeated ids and copies get a row each.
    Other columns are ignored.  Without labelled spans of both kinds nothing is
    added.
    """
    chosen = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    texts = chosen.where("text IS NOT NULL")
    matched = stored(find(texts, BASE, LIKELY_BASE).withColumn("ok", accepted()), "pii-base")
    place = F.struct(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("rank"), "start", "end", "kind")
    base = stored(matched.where("ok").groupBy("id", "th").agg(F.sort_array(F.collect_list(place)).alias("base")), "pii-spans")

    wide = find(texts, WIDE, LIKELY_WIDE)
    same = (wide["id"].eqNullSafe(base["id"])) & (wide["th"] == base["th"])
    free = wide.join(base.select("id", "th", "base"), same, "left").select(*[wide[c] for c in wide.columns], "base")
    free = free.where(F.col("base").isNull() | ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))).drop("base")
    proposals = stored(described(free), "pii-wide")
    glued = (F.col("glued_left") == 1) | (F.col("glued_right") == 1)
    labelled = (
        described(matched.withColumn("label", F.col("ok").cast("double")).drop("ok"))
        .unionByName(proposals.where(glued).withColumn("label", F.lit(0.0)))
    )
    model, limits = train(labelled)
    result = chosen.select("id", "th").join(base, (chosen["id"].eqNullSafe(base["id"])) & (chosen["th"] == base["th"]), "left").select(chosen["id"], chosen["th"], "base")
    if model is None or not limits:
        return result.select("id", F.coalesce("base", F.array().cast(base.schema["base"].dataType)).alias("base"), F.array().cast(base.schema["base"].dataType).alias("added"))
    enough = None
    for kind, limit in limits.items():
        hit = (F.col("kind") == kind) & (F.col("chance") >= limit)
        enough = hit if enough is None else enough | hit
    # Of proposals that overlap, the likeliest, then the longest, then the first kind stays.
    picked = chances(model, proposals.where(~glued)).where(enough)
    order = F.struct((-F.col("chance")).alias("chance"), (F.col("start") - F.col("end")).alias("size"), *[place[f].alias(f) for f in ("rank", "start", "end", "kind")])
    per_doc = picked.groupBy("id", "th").agg(F.sort_array(F.collect_list(order)).alias("all"))

    def take(kept: Column, x: Column) -> Column:
        new = F.struct(x["rank"].alias("rank"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))
        return F.when(F.exists(kept, lambda k: overlaps(k, x)), kept).otherwise(F.concat(kept, F.array(new)))

    empty = F.array().cast(base.schema["base"].dataType)
    added = per_doc.select(F.col("id").alias("id2"), F.col("th").alias("th2"), F.sort_array(F.aggregate("all", empty, take)).alias("added"))
    return result.join(added, F.col("id").eqNullSafe(F.col("id2")) & (F.col("th") == F.col("th2")), "left").select(
        "id", F.coalesce("base", empty).alias("base"), F.coalesce("added", empty).alias("added")
    )


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents: counts and digest of the base spans, and all spans."""
    found = personal_data(table(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [of(k) for k in KINDS]
    both = F.sort_array(F.concat("base", "added"))
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"), spelled(both).alias("spans"))

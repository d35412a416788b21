"""Category encoders that are fitted once, saved, and applied to rows that come later.

An ``Encoder`` learns all its columns in one pass.  The ``EncoderModel`` holds the
learned values as a table, and the order of the columns it gives out, and is saved in
MLlib's format (metadata beside data), alone or as a stage of a ``PipelineModel``.  What a
later table holds does not change the columns: a value that training did not know has no
indicator, no label code, code -1 by appearance, and is rare.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import col
from ..operators.encode import MAX_INDICATORS, MAX_INLINE_CODES, Codes, one_hot
from ..operators.ranking import BEFORE, positions
from ..sources import checkpoint

_KINDS = ("oneHot", "label", "firstSeen", "binary", "rare")
_ONE = "__one"


class _EncoderParams(Params):
    oneHot = Param(Params._dummy(), "oneHot", "columns replaced by 0/1 indicators", TypeConverters.toListString)
    label = Param(Params._dummy(), "label", "columns given codes in order of the value", TypeConverters.toListString)
    firstSeen = Param(Params._dummy(), "firstSeen", "columns given codes by first appearance", TypeConverters.toListString)
    binary = Param(Params._dummy(), "binary", "columns given codes if they have at most two values, null included", TypeConverters.toListString)
    rare = Param(Params._dummy(), "rare", "columns whose rare values are merged", TypeConverters.toListString)
    order = Param(Params._dummy(), "order", "expression that orders rows for first appearance, unique per row", TypeConverters.toString)
    minShare = Param(Params._dummy(), "minShare", "least share of rows of a value that is kept", TypeConverters.toFloat)
    minCategories = Param(Params._dummy(), "minCategories", "columns of at most so many values are not merged", TypeConverters.toInt)
    rareLabel = Param(Params._dummy(), "rareLabel", "what rare values become", TypeConverters.toString)
    nullColumn = Param(Params._dummy(), "nullColumn", "whether null has an indicator", TypeConverters.toBoolean)
    dropFirst = Param(Params._dummy(), "dropFirst", "whether the first indicator is left out", TypeConverters.toBoolean)
    limit = Param(Params._dummy(), "limit", "most indicators of a column", TypeConverters.toInt)
    outputs = Param(Params._dummy(), "outputs", "columns of the training rows once encoded, in order", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(
            **{k: [] for k in _KINDS}, outputs=[], minShare=0.05, minCategories=4, rareLabel="Rare", nullColumn=True, dropFirst=False, limit=MAX_INDICATORS
        )

    def value(self, name: str):
        return self.getOrDefault(self.getParam(name))

    def used(self) -> list[str]:
        return [c for kind in _KINDS for c in self.value(kind)]


class Encoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the values of its columns: one count per column and value, all columns in one job.

    A column may be in one list only.  A column of more than ``limit`` values cannot be
    one-hot encoded (an error names it); codes have no limit.
    """

    @keyword_only
    def __init__(
        self, *, oneHot=None, label=None, firstSeen=None, binary=None, rare=None, order=None, minShare=None,
        minCategories=None, rareLabel=None, nullColumn=None, dropFirst=None, limit=None,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> EncoderModel:
        used = self.used()
        if twice := sorted({c for c in used if used.count(c) > 1}):
            raise ValueError(f"columns with more than one encoding: {', '.join(twice)}")
        if self.value("firstSeen") and not self.isDefined("order"):
            raise ValueError("first appearance needs an order")
        ordered = bool(self.value("firstSeen"))
        pairs = [F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in used]
        none = F.array().cast("array<struct<column:string,value:string>>")
        order = F.expr(self.value("order")) if ordered else F.lit(0)
        long = dataset.select(order.alias("__order"), F.explode(F.array(*pairs) if pairs else none).alias("x")).select("__order", "x.*")
        counts = checkpoint(
            long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"), F.min("__order").alias("first")).withColumn(_ONE, F.lit(1).cast("bigint"))
        )
        known = counts.where(F.col("value").isNotNull())
        placed = positions(known, ["value"], ["column"], [_ONE]).withColumnRenamed(BEFORE + _ONE, "place")
        keys = ["column", "value", "n", "place"]
        if ordered:
            seen = positions(known, ["first"], ["column"], [_ONE]).select("column", "value", F.col(BEFORE + _ONE).alias("seen"))
            placed = placed.join(seen, ["column", "value"])
        else:
            placed = placed.withColumn("seen", F.lit(None).cast("bigint"))
        nulls = counts.where(F.col("value").isNull()).select("column", "value", "n", F.lit(None).cast("bigint").alias("place"), F.lit(None).cast("bigint").alias("seen"))
        model = self._copyValues(EncoderModel(checkpoint(placed.select(*keys, "seen").union(nulls))))
        return model._set(outputs=model.encoded(dataset).columns)


class EncoderModel(Model, _EncoderParams, MLWritable, MLReadable):
    """Learned values: ``column, value, n, place, seen`` (place in order of the value, and of appearance)."""

    def __init__(self, data: DataFrame | None = None):
        super().__init__()
        self.data = data

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Encoded rows, in the columns of training and their order.

        Columns that training did not have are dropped; those that are not encoded and
        not here, such as the label, are left out.
        """
        if missing := [c for c in self.used() if c not in dataset.columns]:
            raise ValueError(f"columns to encode are missing: {', '.join(missing)}")
        out = self.encoded(dataset)
        return out.select(*[col(c) for c in self.value("outputs") if c in out.columns])

    def encoded(self, df: DataFrame) -> DataFrame:
        sizes = {
            r["column"]: r
            for r in self.data.groupBy("column").agg(F.count("value").alias("values"), F.sum("n").alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls")).collect()
        }
        values = lambda c: sizes[c]["values"] if c in sizes else 0
        two = [c for c in self.value("binary") if c in sizes and values(c) + sizes[c]["nulls"] <= 2]
        coded = [*self.value("label"), *two, *self.value("firstSeen")]
        if many := [c for c in self.value("oneHot") if values(c) > self.value("limit")]:
            raise ValueError(f"more than {self.value('limit')} distinct values in {', '.join(many)}; raise the limit")
        small = [c for c in coded if values(c) <= MAX_INLINE_CODES] + self.value("oneHot")
        lists: dict[str, list] = {c: [] for c in small}
        if small:  # bounded by the limits above
            for r in self.data.where(F.col("column").isin(small) & F.col("value").isNotNull()).collect():
                lists[r["column"]].append(r)
        exprs = {}
        for c in self.value("rare"):
            if values(c) <= self.value("minCategories"):
                continue
            kept = self.data.where((F.col("column") == c) & F.col("value").isNotNull() & (F.col("n") / sizes[c]["rows"] >= self.value("minShare")))
            known = [r["value"] for r in kept.select("value").collect()]  # at most 1 / minShare
            exprs[c] = F.when(col(c).isNull() | col(c).cast("string").isin(known), col(c).cast("string")).otherwise(F.lit(self.value("rareLabel")))
        for c in coded:
            place = "seen" if c in self.value("firstSeen") else "place"
            missing = -1 if c in self.value("firstSeen") else values(c) if c in two and sizes[c]["nulls"] else None
            if c in lists:
                inline = {r["value"]: int(r[place]) for r in lists[c]}
                code = Codes("__text", missing if c not in two else None, inline=inline).expr()
                exprs[c] = (c, code, missing)
            else:
                table = self.data.where((F.col("column") == c) & F.col("value").isNotNull()).select(F.col("value").alias("__text"), "n", F.col(place).cast("int").alias("code"))
                df = Codes("__text", missing, table=table).apply(df.withColumn("__text", col(c).cast("string")), c).drop("__text")
        for c, e in exprs.items():
            if isinstance(e, tuple):
                _, code, missing = e
                df = df.withColumn("__text", col(c).cast("string"))
                # A null that training counted as one of two values has the last code; an unknown value has none.
                df = df.withColumn(c, F.when(F.col("__text").isNull(), F.lit(missing).cast("int")).otherwise(code)).drop("__text")
            else:
                df = df.withColumn(c, e)
        categories = {}
        for c in self.value("oneHot"):
            found = sorted((r["value"] for r in lists[c]))[int(self.value("dropFirst")) :]
            categories[c] = found + ([None] if self.value("nullColumn") else [])
        return one_hot(df, categories)[0] if categories else df

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: EncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.data.write.parquet(f"{path}/data")


class _ModelReader(MLReader):
    def load(self, path: str) -> EncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = EncoderModel(self.sparkSession.read.parquet(f"{path}/data"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def keep_order(model: EncoderModel, exclude: Sequence[str] = ()) -> list[str]:
    """The feature columns that training gave out, in order."""
    return [c for c in model.value("outputs") if c not in exclude]

"""A corpus pipeline of five stages: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage gets the documents its predecessor kept and returns the columns of
``documents``, the last one token pieces in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.arithmetic import col
from ledgerloom.llm.common import fresh, stored, table
from ledgerloom.llm.decontaminate import drop_contaminated
from ledgerloom.llm.lines import drop_lines
from ledgerloom.llm.packing import pack
from ledgerloom.llm.simhash import near_duplicates
from ledgerloom.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines met before; ``n_chars`` follows the text where that changed.

    Exact repeats of all lines but blank ones go, repeats up to two edits of the longer ones.
    """
    names = fresh(docs, "__lines", "__removed")
    less = drop_lines(docs, edits=2, repeats_from=1, counts=(names[0], names[1]))
    if "n_chars" in docs.columns:
        size = F.when(F.col(names[1]) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        less = less.withColumn("n_chars", size)
    return less.select(*[col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near-duplicates.

    Rows with a null id, which no group can be told by, stay.  Rows that share an
    id are told apart by their texts, each in its own group, so that none goes for
    its id alone; of several texts of the smallest id the one that hashes lowest
    stays, and of equal rows one.
    """
    id_, th_, row = fresh(docs, "__id", "__th", "__row")
    groups = near_duplicates(docs).where("id IS NOT NULL").groupBy("group").agg(F.min(F.struct("id", "th")).alias("first"))
    kept = groups.select(F.col("first.id").alias(id_), F.col("first.th").alias(th_))
    here = docs.join(kept, (F.col("doc_id") == F.col(id_)) & (F.xxhash64("text") == F.col(th_)))
    one = here.withColumn(row, F.row_number().over(Window.partitionBy(id_, th_).orderBy(th_))).where(F.col(row) == 1)
    names = [col(c) for c in docs.columns]
    return one.select(*names).union(docs.where("doc_id IS NULL").select(*names))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences of 2048."""
    return pack(docs).withColumnsRenamed({"id": "doc_id", "crc": "ids_crc32"})


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL has neither the trained model nor the tokenizer; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groovemill.llm import lines, mixing, ngram_join, packing, quality
from groovemill.llm.common import guarded, sized, staged, word_count


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or whose source is rejected as a host go."""
    own, back = guarded(docs, "doc_id", "text", "source")
    return back(quality.judge(own).filter("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; a document that loses all keeps an empty text."""
    out = lines.dedup_lines(docs)
    new = F.when(F.col("gm_dropped") > 0, F.col("gm_kept")).otherwise(F.col("text"))
    columns = {"text": new, "n_chars": F.when(F.col("gm_dropped") > 0, F.length("gm_kept").cast("long")).otherwise(F.col("n_chars"))}
    return out.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join the one with the smallest doc_id stays; repeated rows count as copies of one."""
    found = staged(ngram_join.near_duplicates(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias("gm_doc")).distinct(), "copies")
    out = docs.join(sized(found), F.col("doc_id") == F.col("gm_doc"), "left_anti")
    if docs.groupBy("doc_id").count().filter("doc_id IS NOT NULL AND count > 1").isEmpty():
        return out
    return out.filter("doc_id IS NULL").unionByName(out.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in whole repetitions, the one in which a share ends being rounded.

    Documents without words carry nothing for the mix and go."""
    own, back = guarded(docs, "doc_id", "text", "source")
    rows = own.withColumn("size", word_count(F.col("text")))
    sizes = staged(rows.select("doc_id", "source", "size"), "mix-sizes")
    taken = mixing.mix(rows, sizes).filter("size > 0")
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    return back(taken.filter(copies > 0).withColumn("gm_copy", F.explode(F.sequence(F.lit(1), copies))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can't express the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

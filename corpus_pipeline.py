"""A corpus pipeline out of the operators in ``contrail.llm``.

Each stage takes all that the stage before it kept, as documents, and returns
documents (the last: packed pieces).  Extra columns are ignored, whatever their
names; an empty table stays empty; a null text is an empty one; a row is named by its
id and its text, so rows that share an id, or have none, are judged alone.  ``run`` writes every stage as Parquet in
the shared checkpoint folder and reads it again, so a lost executor costs no
finished stage.

ORACLE_SQL is None: the trained classifier, the component search and the packing
have no SQL form; tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import NULL_ID, materialise, text_key
from contrail.llm.minhash_hamming import near_duplicates
from contrail.llm.packing import pack
from contrail.llm.quality_classifier import fit, predict_kept
from contrail.llm.substring_dedup import substring_dedup
from contrail.llm.template_decontam import find_leaks

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def row_id() -> Column:
    return F.coalesce("doc_id", F.lit(NULL_ID))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return predict_kept(docs.select(*COLUMNS), fit(docs, labels, "quality"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles,
    similarity of 0.8 or more): that of the smallest id.  Equal texts without an
    id all stay, as no id tells them apart; one that is near a document with an id goes."""
    kept = near_duplicates(docs, shingle_words=5, percent=80, with_key=True).where("kept").select(row_id().alias("k"), F.col("text_key").alias("t")).distinct()
    return docs.select(*COLUMNS).join(kept, (row_id() == F.col("k")) & (text_key(F.col("text")) == F.col("t")), "left_semi")


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages that an earlier document has; a
    text that loses none stays as it is, one that loses all goes."""
    cut = substring_dedup(docs, 13, with_text=True).where("n_removed > 0").select(row_id().alias("k"), F.col("text_sha256").alias("t"), F.col("kept").alias("rest"))
    cut = cut.groupBy("k", "t").agg(F.first("rest").alias("rest"))  # rows of one id and one text lose the same
    own = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    out = docs.select(*COLUMNS).join(cut, (row_id() == F.col("k")) & (own == F.col("t")), "left").where("rest is null or rest != ''")
    text = F.coalesce("rest", "text")
    return out.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("rest").isNull(), F.col("n_chars")).otherwise(F.length("rest")).cast("long").alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.  A leak names an id and a text: another
    text of that id, or another row without an id, stays."""
    leaks = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), with_key=True)
    leaks = leaks.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("k"), F.col("text_key").alias("t")).distinct()
    return docs.select(*COLUMNS).join(leaks, (row_id() == F.col("k")) & (text_key(F.col("text")) == F.col("t")), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, 2048, "byte_bpe_50k.json")


STAGES = [("quality_classifier", quality), ("minhash_near_dedup", near_dedup), ("substring_dedup", substrings),
          ("benchmark_decontamination", decontaminate), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return materialise(STAGES[-1][1](spark, docs, sf_dir))

"""The corpus pipeline: quality, near-dedup, decontamination, mixing, sharding. Part of the llm subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import dealt, discard, key_crc, scratch, written
from plumbline.llm.op01_mixing import TARGETS, labelled_domains, mix
from plumbline.llm.op02_quality import fit_quality, quality_scores
from plumbline.llm.op03_minhash import near_duplicates
from plumbline.llm.op04_decontaminate import contamination
from plumbline.llm.op10_sharding import shard


def _named(docs: DataFrame) -> DataFrame:
    """docs with _row, which stands for one text even where doc_id is null or repeated: by doc_id, nulls last, then by the
    text's hash. A struct equals another with nulls in the same places, so joins on it are null-safe."""
    return docs.withColumn("_row", F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("th")))


def _kept(named: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of named whose _row is among verdicts' (_row), without _row."""
    return named.join(dealt(verdicts.select("_row").distinct()), "_row", "left_semi").drop("_row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject, of any id, repeated rows included; null and empty texts are judged as an
    empty text. It learns from labelled ids only. All columns stay as they are; no documents: none."""
    state = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.coalesce(key_crc(F.col("doc_id"), 5) != 0, F.lit(False)))
    return quality_scores(docs, state).where("predicted = 1").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, null ids last. Of rows that repeat one
    id and text, one stays."""
    named = _named(docs)
    return _kept(named.dropDuplicates(["_row"]), near_duplicates(named.select("_row", "text"), "_row").where("kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    named = _named(docs)
    verdicts = contamination(named.select(F.col("_row").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _kept(named, verdicts.where("not contaminated").withColumnRenamed("doc_id", "_row"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say, so that the languages' tokens meet TARGETS. A text without tokens has the
    prior's rate; rows with null or repeated ids go by id and text; columns of any name stay. No documents: none."""
    return mix(docs, labelled_domains(docs), TARGETS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with shard, shard_depth, shard_page and text_bytes; null ids share a key, whose rows go to pages, and null
    texts weigh nothing. All rows and other columns stay; no documents: none."""
    return shard(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mixing", mixing), ("sharding", sharding)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each one's rows written to the shared folder before the next reads them; what a stage wrote
    for itself, and the rows before it, are deleted then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch():
            out = written(stage(spark, docs, sf_dir), name, keep=True)
        discard(docs)  # the stage before; nothing for the input, which written() didn't make
        docs = out
    return docs

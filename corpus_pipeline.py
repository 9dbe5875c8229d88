"""The corpus pipeline: quality rules, near-duplicate removal, exact-repeat removal, decontamination, source mixing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows its predecessor kept. All but the
last return the columns they were given (those of ``documents``, and any others, whatever their names); ``run`` writes each stage's result as Parquet to
the shared checkpoint folder and reads it again for the next, so no stage recomputes an earlier one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordset.llm import decontaminate as decontamination
from recordset.llm import mixing, ngram_join, rules, suffix_dedup
from recordset.llm.frames import apart, table
from recordset.session import ensure_checkpoint_dir

# Documents are near duplicates if they share 80 percent of their five-word shingles.
NEAR_SHINGLE = 5
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, unchanged. The model is fitted on the labelled rows among ``docs``."""
    model = rules.fit_rule_model(docs, table(spark, sf_dir, "labels"))
    own, back = apart(docs, "doc_id", "text")
    return back(rules.apply_rules(own, model).filter("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the one of smallest id, once. Rows without an id or words link with nothing and stay.

    Rows of one id are one document; of those that differ the one of least hash over all columns stays, whichever task comes first.
    """
    ensure_checkpoint_dir(spark)
    found = ngram_join.link_components(docs, percent=NEAR_PERCENT, k=NEAR_SHINGLE)
    heads = found.filter(F.col("id") == F.col("component_id")).select(F.col("id").alias("doc_id")).distinct()
    own, back = apart(docs, "doc_id")
    marked = own.withColumn("_hash", F.xxhash64(*(c for c, kind in own.dtypes if "map<" not in kind and "variant" not in kind)))
    # Few ids have several rows, so only those are told apart.
    several = marked.groupBy("doc_id").agg(F.min("_hash").alias("_least"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("doc_id", "_least")
    kept = marked.join(heads, "doc_id", "left_semi").join(several, "doc_id", "left").filter(F.col("_least").isNull() | (F.col("_hash") == F.col("_least")))
    return back(kept.dropDuplicates(["doc_id"]).unionByName(marked.filter(F.col("doc_id").isNull()), allowMissingColumns=True))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the bytes of strings of 100 bytes that start earlier as well; ``n_chars`` follows the text.

    A document of which nothing is left stays with the empty text.
    """
    own, back = apart(docs, "doc_id", "text")
    cut = back(suffix_dedup.remove_repeats(own, keep_text=True))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item, unchanged."""
    own, back = apart(docs, "doc_id", "text")
    hits = decontamination.decontaminate(own, table(spark, sf_dir, "benchmark"), spans=False)
    return back(hits.filter(~F.col("contaminated")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its block, slot and place; reading by (slot, place) gives the mix. Columns of these names are replaced."""
    own, back = apart(docs, "doc_id", "source")
    placed = mixing.mix_sources(own)
    new = ("block", "slot", "place")
    kept = [c for c in docs.columns if c.lower() not in new]
    names = [c for c, name in zip(own.columns, docs.columns) if name in kept]
    return placed.select(*(F.col(c).alias(n) for c, n in zip(names, kept)), *new)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontaminated),
    ("source_mixing", mixed),
]

# The fitted model of the first stage and the schedule of the last have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

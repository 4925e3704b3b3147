"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and works on all that the stage before kept.

Stages are written as Parquet and read again; all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm import decontaminate, jaccard, lines, packing, toxicity
from tamiz.llm.shared import bounded, materialise, row_count_at_most, scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the deobfuscating classifier rejects go."""
    params = toxicity.Params()
    model = toxicity.session_model(spark, docs, table(spark, sf_dir, "labels"), params)
    return toxicity.score(docs.select(COLUMNS), model, params, out="__toxicity").filter(F.col("__toxicity") < params.threshold).select(COLUMNS)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows are cut; a document of nothing else goes, as its whole text stands elsewhere."""
    bounded(spark)
    out = lines.dedup_lines(docs.select(COLUMNS)).filter("n_removed = 0 or n_removed < n_lines")
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document with the smallest id stays."""
    bounded(spark)
    near = jaccard.near_duplicates(docs.select("doc_id", "text"))
    others = materialise(near.filter("doc_id <> component_id").select("doc_id").distinct(), "others")
    if row_count_at_most(others, jaccard.BROADCAST_KEYS):
        others = F.broadcast(others)
    return docs.select(COLUMNS).join(others, "doc_id", "left_anti").select(COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a whole window of a benchmark item go."""
    return decontaminate.clean(docs.select(COLUMNS), table(spark, sf_dir, "benchmark")).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest, cut into pieces and packed into sequences."""
    bounded(spark)
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("ngram_jaccard", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: The toxicity and packing stages are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Once a stage's result is written, what it and the stage before wrote goes."""
    docs = table(spark, sf_dir, "documents")
    with scratch() as made:
        for name, stage in STAGES[:-1]:
            docs = materialise(stage(spark, docs, sf_dir), name)
            made.sweep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)

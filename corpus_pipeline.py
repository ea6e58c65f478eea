"""The corpus pipeline: toxicity, near-dedup by SimHash and shingles, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows as Parquet in the shared folder and reads them back as the next one's
documents. All but the last keep the columns of ``documents``.

Defined cases: null and empty texts are kept by toxicity (score 0), are copies of
each other for near-dedup, and pack as the end id alone; near-dedup goes by rows, so
rows of one doc_id with unrelated texts all stay, and of near copies without any
doc_id one does; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvlens.llm import packing, secrets, shingles, toxicity
from kvlens.llm.storage import written

REJECT = 0.5
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below ``REJECT``; the network is trained on the labelled rows of ``docs``."""
    net = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, net, keep=docs.columns, name="_toxic").where(F.col("_toxic") < REJECT).drop("_toxic")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest doc_id, null last."""
    groups = shingles.near_copies(docs)
    # One row for each group: the doc_id and the text (by its shingles) that stay.
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("sig") == F.col("component_sig")))
    stay = written(stay.select(F.col("doc_id").alias("_stays"), F.col("sig").alias("_text")).distinct(), "pipeline-stay")
    signed = shingles.with_set(docs, whole=False)
    kept = written(signed.join(stay, (F.col("sig") == F.col("_text")) & F.col("doc_id").eqNullSafe(F.col("_stays")), "left_semi"), "pipeline-kept")
    # Repeats of a row that stays: only those that have any are sorted. Each sig has one doc_id here.
    twice = kept.groupBy("sig").count().where("count > 1").select(F.col("sig").alias("_twice"))
    single = kept.join(twice, F.col("sig") == F.col("_twice"), "left_anti")
    least = kept.join(twice, F.col("sig") == F.col("_twice"), "left_semi").groupBy("sig").agg(F.min(F.struct(*docs.columns)).alias("_row"))
    return single.select(*docs.columns).unionByName(least.select("_row.*"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret's span replaced by its kind; n_chars follows the text."""
    found = secrets.redact(docs).select(*docs.columns)
    return found.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))) if "n_chars" in docs.columns else found


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: A trained network, fingerprints and a tokenizer aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet in the shared folder and read again as the next stage's ``docs``:

1. toxicity: rows that score 0.7 or more go;
2. near_dedup: one row of each class of near-duplicate texts stays (the smallest
   id's); texts without a word all stay;
3. decontamination: rows that hold a window of a benchmark item go;
4. secrets: every span found is replaced by a mark, ``n_chars`` follows; all
   rows stay;
5. packing: one row per piece of a packed sequence.

All but the last return the columns they were given.  A stage works on all rows
its predecessor kept; models are trained on the labels of rows not held out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdeck.llm import decontaminate, neardup, packing, secret_scan, toxicity
from sparkdeck.llm.common import table
from sparkdeck.llm.queries import tokenizer_path
from sparkdeck.session import shared_dir


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

# Models and signatures take part in every row: SQL cannot state the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

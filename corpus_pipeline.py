"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. In every stage each row is a document of its own, also
where doc_id is null or repeated; an empty table gives an empty one; long texts are taken whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import jaccard_join, mixing, packing, pii, toxicity
from meterline.llm.common import remove_folder, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field predicts to be toxic go. A null or empty text has no evidence and stays; without labels of
    both kinds nothing is predicted and all stay."""
    lexicon, field = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, lexicon, field).where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of likeness 0.8 on five-word shingles connect, the one with the least doc_id stays (null
    first; of equal ones the least MD5 of the text). Texts without words link with nothing and stay."""
    return jaccard_join.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kinds' names, and n_chars is the new text's length. Null texts stay."""
    kind = docs.schema["n_chars"].dataType
    return pii.redacted(docs).withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; texts without words are never taken, null is a source."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences; a null text is empty and has its end token alone."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of sf_dir; what each returns is written below the folder of
    spark.checkpoint.dir (see common.shared_folder) and deleted once the next is written. The last but one stays, as the
    result reads it."""
    root = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        if before:
            remove_folder(spark, before)
        before = f"{root}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from faremeld.llm.common import shared_dir, table
from faremeld.llm.language import keep_identified
from faremeld.llm.mixing import mixed_documents
from faremeld.llm.near_dup import keep_one_of_each
from faremeld.llm.packing import pack_documents
from faremeld.llm.secret_scan import redact_secrets


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage: every piece of every document with its place in a sequence."""
    return pack_documents(docs)


STAGES = [
    ("language", keep_identified),
    ("near_duplicates", keep_one_of_each),
    ("secrets", redact_secrets),
    ("mixing", mixed_documents),
    ("packing", packed),
]

#: A trained model and merges of a vocabulary decide rows, so no SQL states them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`; each is written to the shared folder and read back by the next.

    Null, empty and letterless texts have no language and go; rows without a
    doc_id are compared with none and stay. Of near copies the smallest doc_id
    stays, with all its rows; ties and repeated rows are rows like others. Very long texts are taken whole. Extra columns go through
    all stages but the last, whatever they are called. An empty table, or one
    of which nothing is kept, gives no rows.
    """
    docs, where = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{where}/{name}")
        docs = spark.read.parquet(f"{where}/{name}")
    return docs

"""What the operators share: tables, shared storage, connected components, text batches."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that one step of a Python task works on together.
CHUNK_CHARS = 2_000_000

# Executors need no copy of this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__package__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; on a local master without it, a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder and reads it back, which cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes settled tables that no later plan reads."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.settled_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node it reaches.

    Labels spread along the edges and then jump to their label's label, so the
    rounds grow with the logarithm of the longest path. Each round is settled.
    """
    pairs = settle(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = settle(pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        near = pairs.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        stepped = settle(labels.join(near, "a").select("a", F.least("label", "near").alias("label"), F.col("label").alias("old")))
        roots = stepped.select(F.col("a").alias("label"), F.col("label").alias("root"))
        jumped = settle(stepped.join(roots, "label").select("a", F.col("root").alias("label"), "old"))
        discard(stepped, labels)
        labels = jumped
        if labels.where("label <> old").isEmpty():
            discard(pairs)
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))


def chunks(texts: list[str]) -> Iterator[slice]:
    """Slices of a batch that hold about CHUNK_CHARS characters, or one longer text."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK_CHARS:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))

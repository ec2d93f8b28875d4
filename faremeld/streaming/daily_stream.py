"""The repeated run as a stream of run manifests.

A run lands its quotes first and its manifest last: one row per source with
its outcome. The stream reads manifests, not quotes, so a run in which every
source failed, and which has no quotes at all, still publishes its stale rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from faremeld.operators.merge import as_previous, as_published, merge_run
from faremeld.operators.quality import run_report, unmapped_names, unmapped_warning
from faremeld.plans import store
from faremeld.schemas import FX, QUOTES, RUN_STATUS

LANDED = T.StructType([*QUOTES.fields, T.StructField("row_ord", T.ArrayType(T.LongType())), T.StructField("run_id", T.LongType())])
MANIFEST = T.StructType([T.StructField("run_id", T.LongType()), T.StructField("day", T.DateType()), *RUN_STATUS.fields])


def land_run(landing: str, run_id: int, day: Column, status: DataFrame, quotes: DataFrame | None = None) -> None:
    """Lands one run: its quotes, replacing what an earlier try left, then its manifest as one file."""
    if quotes is not None:
        quotes.select(*QUOTES.fieldNames(), "row_ord").write.mode("overwrite").parquet(f"{landing}/quotes/run_id={run_id}")
    named = status.select(F.lit(run_id).cast("bigint").alias("run_id"), day.alias("day"), *RUN_STATUS.fieldNames())
    named.coalesce(1).write.mode("append").json(f"{landing}/manifests")


def landed_quotes(spark: SparkSession, landing: str, run_id: int) -> DataFrame:
    """The quotes of one run; none if no source had any."""
    try:
        found = spark.read.schema(LANDED).parquet(f"{landing}/quotes")
    except AnalysisException:
        found = spark.createDataFrame([], LANDED)
    return found.where(F.col("run_id") == run_id).drop("run_id")


def merge_landed(spark: SparkSession, landing: str, out: str, run_id: int, day: Column, status: DataFrame, rate: DataFrame) -> None:
    """Merges one landed run with the newest run before it, and publishes both envelope and quotes.

    What it reads depends on `run_id` alone, so that a run that comes again,
    after a failure or because its manifest landed twice, gives the same rows.
    """
    current = landed_quotes(spark, landing, run_id)
    previous = as_previous(store.quotes_of(spark, out, store.newest_before(store.commits(spark, out), run_id)))
    usd_twd = rate.select("usd_twd").scalar()
    attempt = store.write_aside(as_published(merge_run(current, previous, status, usd_twd)), out)
    written = store.attempts(spark, out).where(F.col("attempt") == attempt)
    store.commit(spark, out, attempt, run_id, day, run_report(status, current), unmapped_warning(unmapped_names(written)), rate)


def merge_stream(spark: SparkSession, landing: str, out: str, checkpoint: str, rate: DataFrame) -> StreamingQuery:
    """Publishes every landed run below `out`, in the order of their ids.

    A micro-batch takes all manifests that landed since the last one and works
    through their runs, each of which is committed by itself. `rate` has the
    columns of `schemas.FX` and one row or none.
    """
    manifests = spark.readStream.schema(MANIFEST).json(f"{landing}/manifests")

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = batch.distinct()  # a manifest that landed twice in one batch is one run
        for run in rows.groupBy("run_id").agg(F.max("day").alias("day")).orderBy("run_id").collect():  # one short row a run
            status = rows.where(F.col("run_id") == run["run_id"]).drop("run_id", "day")
            merge_landed(session, landing, out, run["run_id"], F.lit(run["day"]), status, rate)

    return (
        manifests.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

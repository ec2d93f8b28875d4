"""Published runs: data written aside, then committed with its counts and envelope.

A run's quotes go to a folder of their own attempt, which nobody reads. One row
in `commits` then publishes them: it names the attempt, says how many rows it
has, and holds the run's envelope (report, warnings, rate). A write that broke
off has no such row, so readers never see a part of it; an attempt that ran
twice has two, of which the later counts. Of several runs of a day, the last
one is the day's snapshot.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from faremeld.schemas import FX, QUOTES

REPORT = T.ArrayType(
    T.StructType(
        [
            T.StructField("source", T.StringType()),
            T.StructField("ok", T.BooleanType()),
            T.StructField("count", T.LongType()),
            T.StructField("duration_s", T.DoubleType()),
            T.StructField("error", T.StringType()),
        ]
    )
)
COMMITS = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("day", T.DateType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("fx", FX),
        T.StructField("report", REPORT),
        T.StructField("warnings", T.ArrayType(T.StringType())),
    ]
)
STORED = T.StructType([*QUOTES.fields, T.StructField("published_pos", T.LongType()), T.StructField("attempt", T.StringType())])


def write_aside(quotes: DataFrame, path: str) -> str:
    """Writes quotes in output order (with `published_pos`) as a new attempt and gives its name."""
    attempt = uuid.uuid4().hex
    quotes.select(*QUOTES.fieldNames(), "published_pos").write.parquet(f"{path}/quotes/attempt={attempt}")
    return attempt


def commit(spark: SparkSession, path: str, attempt: str, run_id: int, day: Column, report: DataFrame, warnings: DataFrame, rate: DataFrame) -> None:
    """Publishes a written attempt in one step.

    `report` has a row per source, `warnings` a row per text, `rate` one row or
    none; the rows are counted from what was written. The commit is one row in
    one file, which the job's own commit makes visible.
    """
    written = attempts(spark, path).where(F.col("attempt") == attempt).agg(F.count("*").alias("rows"))
    entry = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REPORT.elementType.fields])
    reported = report.agg(F.sort_array(F.collect_list(F.struct("src_ord", entry.alias("entry")))).alias("r")).select(F.transform("r", lambda r: r["entry"]).alias("report"))
    told = warnings.agg(F.sort_array(F.collect_list("warning")).alias("warnings"))
    fx = rate.agg(F.any_value(F.struct(*FX.fieldNames())).cast(FX).alias("fx"))
    row = spark.range(1).select(
        F.lit(run_id).alias("run_id"), day.alias("day"), F.lit(attempt).alias("attempt"), written.scalar().alias("rows"), F.current_timestamp().alias("committed_at"),
        fx.scalar().alias("fx"), reported.scalar().alias("report"), told.scalar().alias("warnings"),
    )
    row.select(*[F.col(f.name).cast(f.dataType) for f in COMMITS.fields]).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def publish(quotes: DataFrame, path: str, run_id: int, day: Column, report: DataFrame, warnings: DataFrame, rate: DataFrame) -> str:
    attempt = write_aside(quotes, path)
    commit(quotes.sparkSession, path, attempt, run_id, day, report, warnings, rate)
    return attempt


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The last commit of each run; none where nothing was published yet."""
    try:
        found = spark.read.schema(COMMITS).parquet(f"{path}/commits")
    except AnalysisException:
        return spark.createDataFrame([], COMMITS)
    newest = F.max_by(F.struct(*COMMITS.fieldNames()), F.struct("committed_at", "attempt"))
    return found.groupBy("run_id").agg(newest.alias("c")).select("c.*")


def of_days(committed: DataFrame) -> DataFrame:
    """The commits that count as snapshots: of each day, its last run."""
    return committed.groupBy("day").agg(F.max_by(F.struct(*[c for c in COMMITS.fieldNames() if c != "day"]), "run_id").alias("c")).select("day", "c.*")


def newest_before(committed: DataFrame, run_id: int | None = None) -> DataFrame:
    """The commit of the newest run, before `run_id` if given; one row or none."""
    earlier = committed if run_id is None else committed.where(F.col("run_id") < run_id)
    return earlier.agg(F.max_by(F.struct(*COMMITS.fieldNames()), "run_id").alias("c")).where("c IS NOT NULL").select("c.*")


def attempts(spark: SparkSession, path: str) -> DataFrame:
    """All written quotes, committed or not; empty where nothing was written."""
    try:
        return spark.read.schema(STORED).parquet(f"{path}/quotes")
    except AnalysisException:
        return spark.createDataFrame([], STORED)


def quotes_of(spark: SparkSession, path: str, committed: DataFrame, *extra: str) -> DataFrame:
    """Quotes of the given commits, with the commit's columns in `extra`.

    Commits are one short row a run. Their names prune the folders, so that no
    file of another attempt is opened, whole or broken.
    """
    names = [r["attempt"] for r in committed.select("attempt").collect()]
    kept = attempts(spark, path).where(F.col("attempt").isin(names))
    return kept.join(committed.select("attempt", *extra), "attempt").drop("attempt")


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Every day's snapshot with `snapshot_date`. Fewer or more rows than were committed end the job."""
    days = of_days(commits(spark, path)).select("attempt", F.col("day").alias("snapshot_date"), "rows")
    names = [r["attempt"] for r in days.select("attempt").collect()]
    found = attempts(spark, path).where(F.col("attempt").isin(names)).groupBy("attempt").agg(F.count("*").alias("found"))
    told = days.join(found, "attempt", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    wrong = F.raise_error(F.concat(F.lit("damaged snapshot of "), F.col("snapshot_date").cast("string"))).cast("boolean")
    sound = told.where(F.when(F.col("found") == F.col("rows"), F.lit(True)).otherwise(wrong))
    return quotes_of(spark, path, sound, "snapshot_date")


def calendar(spark: SparkSession, path: str) -> DataFrame:
    """(snapshot_date, prev_snapshot, next_snapshot), from the commits alone."""
    days = sorted(r["day"] for r in of_days(commits(spark, path)).select("day").collect())  # one date a day
    rows = list(zip(days, [None, *days], [*days[1:], None]))
    return spark.createDataFrame(rows, "snapshot_date date, prev_snapshot date, next_snapshot date")

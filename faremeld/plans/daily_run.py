"""One run: read sources, merge with the last output, publish."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession, functions as F

from faremeld import fixed_values as fv
from faremeld.operators.fx import resolve_rate
from faremeld.operators.merge import as_previous, as_published, merge_run
from faremeld.operators.quality import merge_unmapped, run_report, run_totals, unmapped_names, unmapped_rows, unmapped_warning
from faremeld.plans import publish, store
from faremeld.schemas import FX, QUOTES, RUN_STATUS
from faremeld.sources.registry import Source, default_sources, select_sources


class SourceError(RuntimeError):
    """A source was read but must not be trusted."""


@dataclass
class RunResult:
    quotes: DataFrame
    report: DataFrame
    rate: DataFrame
    warnings: list[str]
    all_failed: bool


def run_source(source: Source, raw: tuple, start: date, end: date, stage: str | None) -> dict:
    """Read one source into a staged table; any fault fails only this source.

    The written table ends the lineage of the raw pages: later steps read it,
    and a lost executor costs a re-read, not a re-parse. Without a `stage`
    nothing is written: the rows are read once to meet faults, then again.
    """
    started = time.monotonic()
    outcome = {"source": source.name, "ok": True, "error": None, "rows": None}
    try:
        reasons = source.health(*raw, start, end).agg(F.min("error").alias("error"), F.count_distinct("error").alias("kinds")).first()
        if reasons["kinds"]:
            raise SourceError(reasons["error"] + (f" (and {reasons['kinds'] - 1} other faults)" if reasons["kinds"] > 1 else ""))
        rows = source.parse(*raw, start, end)
        if stage is None:
            rows.write.format("noop").mode("overwrite").save()
        else:
            rows.write.mode("overwrite").parquet(stage)
            rows = rows.sparkSession.read.parquet(stage)
        outcome["rows"] = rows
    except SourceError as exc:
        outcome.update(ok=False, error=str(exc))
    except Exception as exc:  # noqa: BLE001 - one source must not end the run
        outcome.update(ok=False, error=f"{type(exc).__name__}: {exc}".strip())
    outcome["duration_s"] = time.monotonic() - started
    return outcome


def run_sources(spark: SparkSession, sources: list[Source], raw: dict[str, tuple], start: date, end: date, stages: dict[str, str]) -> list[dict]:
    """Reads all sources at once, each as Spark jobs under a tag of its own.

    A source over its deadline has its jobs cancelled by that tag, and counts as
    failed; the others neither wait for it nor notice. Outcomes come in the
    order of `sources`.
    """
    answers: dict[str, dict] = {}
    tags = {source.name: f"source-{source.name}-{uuid.uuid4().hex}" for source in sources}

    def read(source: Source) -> None:
        spark.sparkContext.addJobTag(tags[source.name])
        answers[source.name] = run_source(source, raw[source.name], start, end, stages.get(source.name))

    began = time.monotonic()
    threads = [InheritableThread(target=read, args=(source,), session=spark) for source in sources]
    for thread in threads:
        thread.daemon = True  # a source that hangs outside Spark must not hold the run
        thread.start()
    outcomes = []
    for source, thread in zip(sources, threads):
        thread.join(max(0.0, began + source.deadline_s - time.monotonic()))
        outcome = answers.get(source.name)
        if outcome is None:
            spark.sparkContext.cancelJobsWithTag(tags[source.name])
            late = f"gave no answer within {source.deadline_s:g} s"
            outcome = {"source": source.name, "ok": False, "error": late, "rows": None, "duration_s": time.monotonic() - began}
        outcomes.append(outcome)
    return outcomes


def run(
    spark: SparkSession,
    raw: dict[str, tuple],
    out: str,
    *,
    start: date,
    selected: list[str] | None = None,
    lookahead_days: int = fv.LOOKAHEAD_DAYS,
    manual_rate: str | None = None,
    fx_payloads: DataFrame | None = None,
    previous: DataFrame | None = None,
    previous_rate: DataFrame | None = None,
    registry: dict[str, Source] | None = None,
    dry_run: bool = False,
) -> RunResult:
    """Run the selected sources over their raw tables and publish under `out`.

    `previous` defaults to the newest run published below `out`.
    """
    registry = registry or default_sources()
    end = start + timedelta(days=lookahead_days)
    if selected is None:
        selected = [name for name in registry if name in select_sources(",".join(raw), tuple(registry))] if raw else []
    elif selected:
        selected = select_sources(",".join(selected), tuple(registry))
    stages = {} if dry_run else {name: f"{out}/stage/run={start.isoformat()}/source={name}" for name in selected}
    read = run_sources(spark, [registry[name] for name in selected], raw, start, end, stages)
    outcomes = [(i, name, r["ok"], r["error"], r["duration_s"], r["rows"]) for i, (name, r) in enumerate(zip(selected, read))]
    status = spark.createDataFrame([o[:5] for o in outcomes], RUN_STATUS)

    with_ord = QUOTES.fieldNames() + ["row_ord"]
    empty = spark.createDataFrame([], QUOTES).withColumn("row_ord", F.array().cast("array<bigint>"))
    current = empty
    for *_, rows in outcomes:
        if rows is not None:
            current = current.unionByName(rows.select(*with_ord))
    if previous is None:
        previous = latest_published(spark, out)
    if previous_rate is None:
        previous_rate = latest_rate(spark, out)

    rate_rows = resolve_rate(spark, manual_rate, fx_payloads, previous_rate).take(1)
    rate = spark.createDataFrame(rate_rows, FX)
    usd_twd = F.lit(rate_rows[0]["usd_twd"] if rate_rows else None)
    merged = merge_run(current, previous, status, usd_twd)
    if not dry_run:
        # Written once; the document, the table view and the snapshot read it.
        table = f"{out}/merged/run={start.isoformat()}"
        as_published(merged).write.mode("overwrite").parquet(table)
        merged = spark.read.parquet(table)

    report = run_report(status, current)
    warnings = [r["warning"] for r in unmapped_warning(unmapped_names(merged)).collect()]  # one text of bounded length
    all_failed = run_totals(report).first()["all_failed"]
    result = RunResult(merged, report, rate, warnings, all_failed)
    if not dry_run:
        write_outputs(spark, result, out, start)
    return result


def write_outputs(spark: SparkSession, result: RunResult, out: str, day: date) -> None:
    now = F.lit(datetime.now(timezone.utc))
    rate = F.lit(None).cast(FX)
    rows = result.rate.take(1)
    if rows:
        r = rows[0]
        rate = F.struct(*[F.lit(r[n]).cast(FX[n].dataType).alias(n) for n in FX.fieldNames()])
    warnings = F.array(*[F.lit(w) for w in result.warnings]).cast("array<string>")
    count = F.lit(result.quotes.count())
    head = publish.envelope_head(result.report, rate, warnings, now, count)
    publish.write_json(result.quotes, head, f"{out}/data/deals.json")
    publish.write_csv(result.quotes, f"{out}/data/deals.csv")
    history = f"{out}/data/history"
    newest = store.newest_before(store.commits(spark, history)).select("run_id").first()
    run_id = newest["run_id"] + 1 if newest else 0
    write_unmapped(spark, result.quotes, run_id, f"{out}/data/unmapped")
    told = spark.createDataFrame([(w,) for w in result.warnings], "warning string")
    store.publish(result.quotes, history, run_id, F.lit(day), result.report, told, result.rate)


def write_unmapped(spark: SparkSession, quotes: DataFrame, run_id: int, path: str) -> None:
    """Adds a run's unmapped names to those of the runs before, as a table of its own per run."""
    rows = [unmapped_rows(quotes, F.lit(run_id))]
    if run_id:
        rows.append(spark.read.parquet(f"{path}/run={run_id - 1}"))
    merge_unmapped(*rows).write.mode("overwrite").parquet(f"{path}/run={run_id}")


def latest_published(spark: SparkSession, out: str) -> DataFrame:
    """The newest run's quotes, as the previous side; none before the first."""
    history = f"{out}/data/history"
    return as_previous(store.quotes_of(spark, history, store.newest_before(store.commits(spark, history))))


def latest_rate(spark: SparkSession, out: str) -> DataFrame:
    newest = store.newest_before(store.commits(spark, f"{out}/data/history"))
    return newest.where("fx IS NOT NULL").select("fx.*")

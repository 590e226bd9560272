"""Staged runs: every stage's table is written, scored, and marked when it passed; marked stages are reread."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from voxloom.scratch import delete, exists, hadoop_path

GATE = 7.0
MARKS = "_passed"


@dataclass
class Stage:
    """errors: a column of run's rows that holds the error of those that failed; they go to a table of their own."""

    name: str
    run: Callable[[SparkSession, DataFrame | None], DataFrame]
    score: Callable[[DataFrame], float] | None = None
    errors: str | None = None


@dataclass
class RunLog:
    done: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    scores: dict[str, float] = field(default_factory=dict)
    failed_rows: dict[str, int] = field(default_factory=dict)
    unscored: dict[str, str] = field(default_factory=dict)
    error: str | None = None

    def progress(self, total: int) -> float:
        return 100.0 * (len(self.done) + len(self.skipped)) / total if total else 100.0


def _mark(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.create(target, True).close()


def run_stages(spark: SparkSession, stages: list[Stage], folder: str, gate: float = GATE) -> RunLog:
    """Run stages in order. A stage under the gate, or one that raises, ends the run; a score that raises lets its stage pass.

    Only a stage that passed gets its mark (_passed/<name>), so one under the gate runs again next time, and so do all
    stages after the first that ran: their input is new. Rows with an error are written to <name>-errors and
    counted, the stage's table and the next stage have the others.
    """
    log, df, fresh = RunLog(), None, False
    for stage in stages:
        path, mark = f"{folder}/{stage.name}", f"{folder}/{MARKS}/{stage.name}"
        try:
            if not fresh and exists(spark, mark) and exists(spark, f"{path}/_SUCCESS"):
                log.skipped.append(stage.name)
                df = spark.read.parquet(path)
                continue
            fresh = True
            delete(spark, mark)
            df = _written(spark, stage, df, path, log)
        except Exception as e:  # a failed stage is recorded, not raised: the caller reads the log
            log.error = f"{stage.name}: {e}"
            return log
        if stage.score is not None:
            try:
                log.scores[stage.name] = float(stage.score(df))
            except Exception as e:
                log.unscored[stage.name] = str(e)
            if stage.name in log.scores and not log.scores[stage.name] >= gate:
                log.error = f"{stage.name}: score {log.scores[stage.name]:.2f} under {gate:.2f}"
                return log
        _mark(spark, mark)
        log.done.append(stage.name)
    return log


def _written(spark: SparkSession, stage: Stage, df: DataFrame | None, path: str, log: RunLog) -> DataFrame:
    out = stage.run(spark, df)
    if stage.errors is None:
        out.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    # both tables come from one computation
    both = f"{path}-attempts"
    out.write.mode("overwrite").parquet(both)
    rows = spark.read.schema(out.schema).parquet(both)
    rows.where(rows[stage.errors].isNotNull()).write.mode("overwrite").parquet(f"{path}-errors")
    rows.where(rows[stage.errors].isNull()).drop(stage.errors).write.mode("overwrite").parquet(path)
    delete(spark, both)
    log.failed_rows[stage.name] = spark.read.parquet(f"{path}-errors").count()
    return spark.read.parquet(path)

"""Work that may fail row by row: results beside errors, and chains of alternatives."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from voxloom.scratch import stored

Step = Callable[[DataFrame], DataFrame]


def attempt_each(rows: DataFrame, work: Callable[[dict], dict], returns: str, error: str = "error") -> DataFrame:
    """rows with the columns that `work` gives for each, and an error column: `Kind: message` where it raised, null elsewhere.

    A row's failure costs that row its results and nothing else. work gets a row as a dict of its columns and
    gives one of the returned columns; of those it leaves out, and of a failed row, the values are null.
    """
    given = StructType.fromDDL(returns)
    taken = {c.lower() for c in rows.columns}
    if clash := [n for n in [*given.names, error] if n.lower() in taken]:
        raise ValueError(f"columns exist already: {clash}")
    schema = StructType([*rows.schema.fields, *given.fields, *StructType.fromDDL(f"`{error}` string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        made = to_arrow_schema(given)
        for batch in batches:
            out, errors = [], []
            for row in batch.to_pylist():
                try:
                    result = work(row)
                    # a value of another type is the row's failure too
                    pa.RecordBatch.from_pylist([result], schema=made)
                    out.append(result)
                    errors.append(None)
                except Exception as e:
                    out.append({})
                    errors.append(f"{type(e).__name__}: {e}")
            results = pa.RecordBatch.from_pylist(out, schema=made) if out else None
            columns = [results.column(k) if results is not None else pa.array([], f.type) for k, f in enumerate(made)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, pa.array(errors, pa.string())], [*batch.schema.names, *given.names, error])

    return rows.mapInArrow(run, schema)


def first_success(rows: DataFrame, steps: list[tuple[str, Step]], folder: str) -> DataFrame:
    """rows with what the first step that works on them gives, its name as `method`, and `failures`: (method, error) of those before.

    Each step takes the columns of rows and returns them with the same further columns and `error`, null where it
    worked. It gets only the rows that every step before it failed on; its result is written below folder, so no
    step runs twice. Rows that no step works on keep the further columns' nulls and have no method.
    """
    if not steps:
        raise ValueError("no steps")
    names = [n for n, _ in steps]
    if len(set(names)) < len(names):
        raise ValueError("steps must have different names")
    tried = F.array().cast("array<struct<method:string,error:string>>")
    left, done, made = rows.withColumn("failures", tried), [], None
    for k, (name, step) in enumerate(steps):
        before = left.select(*rows.columns, "failures")
        out = stored(step(before), f"{folder}/{k}-{name}")
        added = [c for c in out.columns if c not in (*before.columns, "error")]
        if made is None:
            made = added
        elif sorted(made) != sorted(added):
            raise ValueError(f"{name} gives {added}, the steps before give {made}")
        done.append(out.where("error is null").select(*rows.columns, *made, F.lit(name).alias("method"), "failures"))
        failure = F.array(F.struct(F.lit(name).alias("method"), F.col("error").alias("error")))
        left = out.where("error is not null").withColumn("failures", F.concat("failures", failure))
    none = left.select(*rows.columns, *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in made], F.lit(None).cast("string").alias("method"), "failures")
    for part in done:
        none = none.unionByName(part)
    return none


def chain_report(tried: DataFrame, steps: list[str]) -> DataFrame:
    """(method, seen, worked): rows that each step saw and worked on; `none` for those left over."""
    names = tried.sparkSession.createDataFrame([(n,) for n in [*steps, "none"]], "method string")
    worked = tried.groupBy(F.coalesce("method", F.lit("none")).alias("method")).agg(F.count("*").alias("worked"))
    failed = tried.select(F.explode("failures.method").alias("method")).groupBy("method").agg(F.count("*").alias("failed"))
    every = names.join(worked, "method", "left").join(failed, "method", "left").na.fill(0, ["worked", "failed"])
    return every.select("method", (F.col("worked") + F.col("failed")).alias("seen"), F.when(F.col("method") == "none", 0).otherwise(F.col("worked")).alias("worked"))

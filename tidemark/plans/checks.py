"""All rule jobs in one run: row rules of a table fused into one scan, one verdict over everything.

A :class:`RowJob` judges each row of a table by itself; all row jobs of a table, whatever collection they
speak for, are evaluated in the same pass, which also notes the ids that must be unique.  A
:class:`TableJob` needs more than a row, such as a join, and yields violations itself.  What was found is
written once; the numbers that gate come from that write and not from an action per rule.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.rules import Rule, broken_rules, with_schema_errors
from tidemark.workspace import durable, fan_out

#: Rows that one task counts for unique ids.
UNIQUE_ROWS = 1_000_000

_FOUND = ("collection", "id", "rule", "severity", "detail", "gates")


@dataclass(frozen=True)
class RowJob:
    """``rules`` of the rows of ``table``; ``schema`` judges their JSON column ``raw`` as well."""

    collection: str
    table: str
    key: str
    rules: tuple[Rule, ...] = ()
    schema: dict | None = None
    raw: str = "raw"
    unique: bool = False
    gates: bool = True


@dataclass(frozen=True)
class TableJob:
    """``run`` gets the tables it names and returns (collection, id, rule, severity, detail)."""

    tables: tuple[str, ...]
    run: Callable[..., DataFrame]
    gates: bool = True


@dataclass(frozen=True)
class Report:
    """Everything found, counts per rule, and how many violations gate or only report."""

    violations: DataFrame
    verdicts: DataFrame
    gating: int
    reporting: int

    @property
    def passed(self) -> bool:
        return self.gating == 0


def _entries(rules: Column, job: RowJob) -> Column:
    """The broken rules of one job, with what they are reported under."""
    return F.transform(rules, lambda r: F.struct(
        F.lit(job.collection).alias("collection"), F.col(job.key).cast("string").alias("id"),
        r["rule"].alias("rule"), r["severity"].alias("severity"), r["detail"].alias("detail"),
        (F.lit(job.gates) & (r["severity"] == "error")).alias("gates")))


def scanned(df: DataFrame, jobs: Sequence[RowJob]) -> DataFrame:
    """One pass over a table: the violations of all its row jobs, and a row without a rule per id of a
    collection whose ids must be unique."""
    parts = []
    for i, job in enumerate(jobs):
        found = broken_rules(job.rules) if job.rules else None
        if job.schema is not None:
            df = with_schema_errors(df, job.raw, job.schema, f"_schema_{i}")
            failed = F.transform(f"_schema_{i}", lambda e: F.struct(
                e.alias("rule"), F.lit("error").alias("severity"), F.lit(None).cast("string").alias("detail")))
            found = failed if found is None else F.concat(found, failed)
        if found is not None:
            parts.append(_entries(found, job))
        if job.unique:
            nothing = F.lit(None).cast("string")
            parts.append(_entries(F.array(F.struct(nothing.alias("rule"), F.lit("error").alias("severity"),
                                                   nothing.alias("detail"))), job))
    # explode_outer: plain explode would copy the rules into a filter in front of itself
    return (df.select(F.explode_outer(F.concat(*parts)).alias("v")).filter(F.col("v").isNotNull())
            .select(*[f"v.{c}" for c in _FOUND]))


def _repeated(found: DataFrame, most: int = UNIQUE_ROWS) -> DataFrame:
    """The ids that occur more than once, counted in tasks of about ``most`` rows whatever the input."""
    ids = found.filter("rule is null").select("collection", "id", "gates")
    tasks = max(fan_out(found.sparkSession), -(-ids.count() // most))
    return (ids.repartition(tasks, "collection", "id", "gates").groupBy("collection", "id", "gates")
            .agg(F.count("*").alias("n")).filter("n > 1")
            .select("collection", "id", F.lit("duplicate id").alias("rule"),
                    F.lit("error").alias("severity"), F.col("n").cast("string").alias("detail"), "gates"))


def run_jobs(jobs: Sequence[RowJob | TableJob], tables: Mapping[str, DataFrame]) -> Report:
    """Runs all jobs; each table is scanned once for its row jobs."""
    every = None
    for name in dict.fromkeys(j.table for j in jobs if isinstance(j, RowJob)):
        found = durable(scanned(tables[name], [j for j in jobs if isinstance(j, RowJob)
                                               and j.table == name]), f"rules-{name}")
        part = found.filter("rule is not null").unionByName(_repeated(found))
        every = part if every is None else every.unionByName(part)
    for job in jobs:
        if isinstance(job, TableJob):
            part = job.run(*(tables[t] for t in job.tables)).withColumn(
                "gates", F.lit(job.gates) & (F.col("severity") == "error")).select(*_FOUND)
            every = part if every is None else every.unionByName(part)
    seen = Observation("rule jobs")
    written = durable(every.observe(seen, F.count_if("gates").alias("gating"),
                                    F.count_if(~F.col("gates")).alias("reporting")), "violations")
    verdicts = written.groupBy("collection", "rule", "severity", "gates").agg(F.count("*").alias("n"))
    return Report(written, verdicts, seen.get["gating"], seen.get["reporting"])

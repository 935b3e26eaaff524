"""High-water ingest, ledger promotion, streaming de-duplication, decision folds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import filters


# --- R1: high-water ingest ------------------------------------------------------------

def after_high_water(df: DataFrame, mark: str | None, date: str = "date_published") -> DataFrame:
    """Rows dated after the last complete extraction.

    Faithful to a comparison of dates with the extraction time: a record dated
    earlier but delivered later is lost.  :func:`unseen` is the safe mode.
    """
    return df if mark is None else df.filter(F.col(date) > mark)


def unseen(df: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    return df.join(stored.select(key), key, "left_anti")


def ingest_available(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                     checkpoint: str, **criteria) -> StreamingQuery:
    """Read every landed JSONL file not read before, filter, append, stop."""
    rows = spark.readStream.schema(schema).option("lineSep", "\n").json(landing)
    kept = filters.research(rows, **criteria)
    return (kept.writeStream.format("parquet").option("path", target)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


# --- R2: promotion by ledger ------------------------------------------------------------

def pending_files(hashes: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose (path, checksum) is not in the ledger: new or changed."""
    return hashes.join(ledger.select("file", "sha256"), ["file", "sha256"], "left_anti")


def promote(rows: DataFrame, hashes: DataFrame, ledger: DataFrame, errors: DataFrame,
            file: str = "_file") -> tuple[DataFrame, DataFrame]:
    """(rows to append, ledger entries to append).

    A file with any error is left out as a whole and stays pending.
    """
    ready = (pending_files(hashes, ledger)
             .join(errors.select(F.col(file).alias("file")).distinct(), "file", "left_anti"))
    return (rows.join(ready.select(F.col("file").alias(file)), file, "left_semi"),
            ready.select("file", "sha256"))


def content_checksums(rows: DataFrame, file: str = "_file") -> DataFrame:
    """(file, sha256, rows): a checksum of each file's rows that does not depend on their order."""
    content = [c for c in sorted(rows.columns) if c != file]
    row = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    part = lambda i: F.conv(F.substring(row, 1 + 15 * i, 15), 16, 10).cast("long")
    sums = [F.sum(part(i).cast("decimal(38,0)")) for i in range(4)]
    return rows.groupBy(F.col(file).alias("file")).agg(
        F.sha2(F.concat_ws(",", F.count("*").cast("string"), *(s.cast("string") for s in sums)),
               256).alias("sha256"), F.count("*").alias("rows"))


def promotion_batch(target: str, ledger_path: str, rules: Callable[[DataFrame], DataFrame],
                    file: str = "_file") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: validate, append the good files, append the ledger.

    The ledger holds (file, sha256, rows) of what was promoted.  A file that comes again with the
    same content is skipped; with other content it is promoted again.  Batches are keyed by their
    number, so a batch that runs again after a failure overwrites its own output instead of adding
    to it, and does not take its own ledger entries for earlier ones.
    """
    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bad = rules(batch).filter("severity = 'error'").select(file).distinct()
        ready = content_checksums(batch.join(bad, file, "left_anti"), file)
        path = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            earlier = spark.read.parquet(ledger_path).filter(F.col("batch") != number)
            ready = pending_files(ready, earlier)
        entries = f"{ledger_path}/batch={number}"
        ready.write.mode("overwrite").parquet(f"{target}-ready/batch={number}")
        ready = spark.read.schema(ready.schema).parquet(f"{target}-ready/batch={number}")
        (batch.join(ready.select(F.col("file").alias(file)), file, "left_semi")
         .write.mode("overwrite").parquet(f"{target}/batch={number}"))
        ready.write.mode("overwrite").parquet(entries)
    return run


# --- R3: streaming de-duplication ----------------------------------------------------------

def stream_keep_first(rows: DataFrame, key: str, at: str, bound: str = "1 day") -> DataFrame:
    """Keep the first arrival per key; state is dropped once ``bound`` has passed."""
    return rows.withWatermark(at, bound).dropDuplicatesWithinWatermark([key])


# --- R4: decision log folds --------------------------------------------------------------------

def current_decisions(log: DataFrame, key: str = "id", at: str = "at",
                      fields: tuple[str, ...] = ("rating", "watch_status", "by")) -> DataFrame:
    """The last decision per id and how many there were."""
    return log.groupBy(key).agg(
        F.max_by(F.struct(*fields, at), at).alias("s"), F.count("*").alias("decisions")
    ).select(key, "s.*", "decisions")


def watch_dates(status: Column, prior_since: Column, at: Column, by: Column,
                decide: bool = False) -> dict[str, Column]:
    """Dates that follow from a decision.

    Triage: ``watching`` keeps or starts the watch and clears the decision,
    ``rejected`` records it, undecided clears the watch.  The later decide pass
    records every verdict but ``watching``.
    """
    watching = F.coalesce(status == "watching", F.lit(False))
    closed = ~watching if decide else F.coalesce(status == "rejected", F.lit(False))
    return {
        "watching_since": prior_since if decide else (
            F.when(watching, F.coalesce(prior_since, F.left(at, F.lit(10))))
            .when(status.isNotNull(), prior_since)),
        "decided_on": F.when(closed, F.left(at, F.lit(10))),
        "decided_by": F.when(closed, by),
    }


def stream_decisions(log: DataFrame) -> DataFrame:
    """Streaming fold of (id, watch_status, rating, at): the latest decision of each id and how
    many there were.  Decisions of one time are ordered by status and rating.  For update mode.
    """
    last = F.max(F.struct("at", "watch_status", "rating")).alias("last")
    return (log.groupBy("id").agg(last, F.count("*").alias("decisions"))
            .select("id", "last.watch_status", "last.rating", "last.at", "decisions"))


# --- R5: retention ------------------------------------------------------------------------------

def retained(df: DataFrame, created: str, now: Column, days: int = 90) -> DataFrame:
    """Rows created within ``days`` of ``now``; on a date partition it prunes files."""
    return df.filter(F.col(created) >= now - F.expr(f"INTERVAL {days} DAYS"))

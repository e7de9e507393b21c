"""The three stored tables as partitioned Parquet, and the table of committed batches.

Rows are partitioned by a calendar period and by the write that made them. A batch writes under a new number, and counts once its
row is in the table of commits, which every reader joins; what a broken-off batch has written is never seen, and its
repetition writes under another number. Purge and backfill overwrite the partitions they touch (dynamic partition overwrite), and may
be run again after a break.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import schema
from landfall.functions import dates
from landfall.session import exists, folders, prepare, remove, shuffles_dropped

PASSENGER_FACT, JSON_LEDGER, ZIP_LEDGER = "passenger_fact", "json_ledger", "zip_ledger"
SCHEMAS = {
    PASSENGER_FACT: schema.PASSENGER_FACT,
    JSON_LEDGER: schema.JSON_LEDGER,
    ZIP_LEDGER: schema.ZIP_LEDGER,
}
PARTITIONS = ["period", "write_id"]
# Order inside a partition: look-ups by port, and by archive, then skip row groups.
SORTED_BY = {
    PASSENGER_FACT: "arrival_port_code",
    JSON_LEDGER: "zip_file_name",
    ZIP_LEDGER: "zip_file_name",
}
# Columns that are looked up by single values: their Bloom filters let a scan skip row groups.
LOOKED_UP = {
    PASSENGER_FACT: ["json_file"],
    JSON_LEDGER: ["json_file_name", "zip_file_name"],
    ZIP_LEDGER: ["zip_file_name"],
}
COMPRESSION = "zstd"
# Rows whose name holds no date go to one of so many periods of their own.
UNDATED, UNDATED_PERIODS = "undated", 16
# How long a check that a later one has replaced stays for those who are reading it.
KEPT_SECONDS = 3600
COMMIT = (
    "batch_id long, write_id long, source string, source_batch long, archives long, names long, "
    "manifests_processed long, zip_failures long, zips_processed long"
)


class Store:
    """Tables below `root`. `period` is day (default), month or year, by the volume of a day."""

    def __init__(self, spark: SparkSession, root: str, period: str = "day"):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self._period_chars = {"day": 10, "month": 7, "year": 4}[period]

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _period(self, table: str) -> Column:
        """Arrival date of a fact, archive date of a ledger row."""
        if table == PASSENGER_FACT:
            return F.coalesce(self._of_date(dates.iso_date(F.col("scheduled_date"))), F.lit(f"{UNDATED}-0"))
        return self._archive_period(F.col("zip_file_name"))

    def _of_date(self, date: Column) -> Column:
        return F.substring(date, 1, self._period_chars)

    def _archive_period(self, name: Column) -> Column:
        bucket = F.pmod(F.xxhash64(name), F.lit(UNDATED_PERIODS)).cast("string")
        return F.coalesce(self._of_date(dates.created_on(name)), F.concat(F.lit(f"{UNDATED}-"), bucket))

    def _written(self, path: str, columns: T.StructType) -> DataFrame:
        return self.spark.read.schema(columns).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], columns)

    def stored(self, table: str) -> DataFrame:
        """All rows with their partition columns, of batches that were not committed too."""
        partitions = [T.StructField("period", T.StringType()), T.StructField("write_id", T.LongType())]
        return self._written(self.path(table), T.StructType(SCHEMAS[table].fields + partitions))

    def _of_commits(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.commits().select("write_id"), "write_id", "left_semi").select(*rows.columns)

    def partitioned(self, table: str) -> DataFrame:
        """Committed rows with their partition columns; no rows where the table was never written."""
        return self._of_commits(self.stored(table))

    def read(self, table: str) -> DataFrame:
        return self.partitioned(table).drop(*PARTITIONS)

    def ledger_of_date(self, table: str, date: str) -> DataFrame:
        """Committed ledger rows of archives that can belong to a date, with their partition columns: named after it, or
        after no date. Only those partitions are read."""
        period = F.col("period")
        return self.partitioned(table).filter((period == date[: self._period_chars]) | period.startswith(UNDATED))

    def ledger_of_archive(self, table: str, name: str) -> DataFrame:
        """Committed ledger rows of the period of one archive, with their partition columns."""
        period = self.spark.range(1).select(self._archive_period(F.lit(name))).first()[0]
        return self.partitioned(table).filter(F.col("period") == period)

    def facts_of(self, names: DataFrame) -> DataFrame:
        """Committed facts of the periods in which documents of the given names (`json_file_name`) can have some.

        The ledger says when each document is scheduled, whatever archive it came in. Where a good one's date is not known,
        all periods are read; a failed document has no facts.
        """
        recorded = self.read(JSON_LEDGER).filter("success").join(names.select("json_file_name").distinct(), "json_file_name", "left_semi")
        periods = [row[0] for row in recorded.select(self._of_date(dates.iso_date(F.col("scheduled")))).distinct().collect()]
        facts = self.stored(PASSENGER_FACT)
        return self._of_commits(facts if None in periods else facts.filter(F.col("period").isin(periods)))

    # --- commits --------------------------------------------------------------------------------------

    def commits(self) -> DataFrame:
        """A row for each committed batch: its id, the number it wrote under, where it came from, and its metrics."""
        return self._written(f"{self.root}/commits", T.StructType.fromDDL(COMMIT))

    def last_batch_id(self) -> int:
        """The last committed batch, -1 if there is none."""
        return self.commits().agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]

    def new_write_id(self) -> int:
        """A number that no batch, finished or not, has written under."""
        return uuid.uuid4().int >> 65

    def commit(
        self, batch_id: int, write_id: int | None = None, archives: int = 0, names: int = 0, metrics: tuple[int, int, int] = (0, 0, 0),
        source: tuple[str, int] | None = None,
    ) -> None:
        """One row is one file, so a commit is there or not. `source`: a stream's id and its own number of the batch."""
        row = (batch_id, batch_id if write_id is None else write_id, *(source or (None, None)), archives, names, *metrics)
        self.spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def committed(self, batch_id: int) -> Row | None:
        return self.commits().filter(F.col("batch_id") == batch_id).first()

    def committed_from(self, source: str, source_batch: int) -> Row | None:
        return self.commits().filter((F.col("source") == source) & (F.col("source_batch") == source_batch)).first()

    # --- checks ---------------------------------------------------------------------------------------

    def record_check(self, at: Column) -> None:
        """That the feed was looked at, whether or not something was new. A day's last check counts; earlier ones are removed only when a
        reader that had listed them has had KEPT_SECONDS to read them."""
        path, now = f"{self.root}/checks", time.time_ns()
        row = self.spark.range(1).select(at.cast("timestamp").alias("processed_at"))
        row = row.withColumns({"day": F.date_format("processed_at", "yyyy-MM-dd"), "recorded": F.lit(now).cast("long")})
        row.coalesce(1).write.mode("append").partitionBy("day", "recorded").parquet(path)
        # The day before may have been left with the checks of its last hour.
        for day in [name for name in folders(self.spark, path) if name.startswith("day=")][-2:]:
            earlier = sorted(int(name.partition("=")[2]) for name in folders(self.spark, f"{path}/{day}") if name.startswith("recorded="))[:-1]
            for recorded in earlier:
                if recorded < now - KEPT_SECONDS * 10**9:
                    remove(self.spark, f"{path}/{day}/recorded={recorded}")

    def checks(self) -> DataFrame:
        """The last check that was recorded for each day."""
        columns = "processed_at timestamp, day string, recorded long"
        rows = self._written(f"{self.root}/checks", T.StructType.fromDDL(columns))
        return rows.groupBy("day").agg(F.max_by("processed_at", "recorded").alias("processed_at")).select("processed_at", "day")

    # --- batches --------------------------------------------------------------------------------------

    def recorded_for(self, archives: DataFrame) -> DataFrame:
        """JSON ledger rows that committed batches may have for the given archives.

        The period follows from the archive's name, so only the periods that occur are read. They are
        calendar values, hence few, whatever the number of archives.
        """
        periods = [row[0] for row in archives.select(self._period(JSON_LEDGER)).distinct().collect()]
        return self._of_commits(self.stored(JSON_LEDGER).filter(F.col("period").isin(periods))).drop(*PARTITIONS)

    def write_batch(self, table: str, rows: DataFrame, write_id: int) -> None:
        self.replace_partitions(
            table,
            rows.select(*SCHEMAS[table].fieldNames()).withColumns(
                {"period": self._period(table), "write_id": F.lit(write_id).cast("long")}
            ),
        )

    def replace_partitions(self, table: str, rows: DataFrame) -> None:
        """Write rows that carry their partition columns, replacing those partitions only.

        Rebalancing gathers a period into few files, and splits one that is too large for a task.
        """
        writer = (
            rows.hint("rebalance", *[F.col(name) for name in PARTITIONS])
            .sortWithinPartitions(*PARTITIONS, SORTED_BY[table])
            .write.mode("overwrite")
            .options(**{f"parquet.bloom.filter.enabled#{column}": "true" for column in LOOKED_UP[table]})
            # Else a filter takes a megabyte for each column and row group, however few names there are.
            .options(**{"parquet.bloom.filter.adaptive.enabled": "true", "compression": COMPRESSION})
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS)
        )
        with shuffles_dropped(self.spark):
            writer.parquet(self.path(table))

    def _drop_partitions(self, table: str, partitions: Iterable[tuple[str, int]]) -> None:
        """Remove whole partitions. A dynamic overwrite cannot: it leaves alone what gets no row."""
        for period, write_id in partitions:
            remove(self.spark, f"{self.path(table)}/period={period}/write_id={write_id}")

    def rewrite(self, table: str, rows: DataFrame, touched: DataFrame, folder: str) -> None:
        """Put `rows`, with their partition columns, in the place of the partitions `touched`. They are written to `folder` first,
        since they are read from what they replace."""
        rows = written(rows, f"{folder}/rewritten-{table}")
        self.replace_partitions(table, rows)
        emptied = touched.select(*PARTITIONS).join(rows.select(*PARTITIONS).distinct(), PARTITIONS, "left_anti").distinct().collect()
        self._drop_partitions(table, [(r.period, r.write_id) for r in emptied])


def written(rows: DataFrame, path: str) -> DataFrame:
    """Write once and read back: cuts the lineage, and gives the planner the true size, from which it
    decides by itself whether the rows may be broadcast."""
    with shuffles_dropped(rows.sparkSession):
        rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)

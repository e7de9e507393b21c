"""Manifest archives derived from the given tables: an order is a voyage, its lines the passengers.

FIXTURES.md section 3 states the rules. Documents hold at most `lines_per_document` passengers, and an
archive covers a bounded range of orders, so neither grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import schema
from landfall.plans.ingest import run_batch
from landfall.session import fresh_path, prepare
from landfall.sources import tables
from landfall.sources.archives import unreadable_headers
from landfall.sources.tables import Store

LINES_PER_DOCUMENT = 500
ORDERS_PER_BLOCK = 20_000
PRIOR_AT, BATCH_AT, AS_OF = "2025-08-31 00:00:00", "2025-09-01 00:00:00", "2026-01-01 00:00:00"


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


class Fixture:
    def __init__(self, spark: SparkSession, sf_dir: str, lines_per_document: int = LINES_PER_DOCUMENT):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self.lines_per_document = lines_per_document

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _heavy_orders(self) -> DataFrame:
        """Orders with more lines than a document takes, and the documents they need."""
        return (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("k"))
            .agg(F.count("*").alias("lines"))
            .filter(F.col("lines") > self.lines_per_document)
            .select("k", F.ceil(F.col("lines") / self.lines_per_document).alias("parts"))
        )

    def passenger_lists(self) -> DataFrame:
        """k, part, passengers. The explicit shuffle on both keys spreads the parts of one heavy order."""
        suppliers = self.table("supplier").select("s_suppkey", "s_nationkey")
        line = F.struct("l_linenumber", "s_nationkey", "l_quantity", "l_linestatus", "l_returnflag", "l_partkey")
        return (
            self.table("lineitem")
            .withColumnRenamed("l_orderkey", "k")
            .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self._heavy_orders(), "k", "left")
            .select("k", (F.col("l_partkey") % F.coalesce("parts", F.lit(1))).alias("part"), line.alias("p"))
            .repartition("k", "part")
            .groupBy("k", "part")
            .agg(F.collect_list("p").alias("lines"))
            .select("k", "part", F.transform("lines", self._passenger).alias("passengers"))
        )

    def _passenger(self, p: Column) -> Column:
        """Made after the shuffle, which moves the columns of a line only."""
        line, nation = p["l_linenumber"], p["s_nationkey"]
        country = F.concat(F.lit("N"), _padded(nation, 2))
        age = (
            F.when(line == 5, "unknown")
            .when(line == 6, F.lit(None))
            .when((line == 4) & (F.col("k") % 41 == 0), "99999")
            .otherwise(p["l_quantity"].cast("int").cast("string"))
        )
        return F.struct(
            F.when(line % 3 == 0, "P").when(line % 3 == 1, "I").alias("DocumentType"),
            country.alias("DocumentIssuingCountryCode"),
            F.when(nation < 10, "Y").otherwise("").alias("NationalityCountryEEAFlag"),
            age.alias("Age"),
            F.lit("LHR").alias("DisembarkationPortCode"),
            F.when(p["l_linestatus"] == "O", "Y")
            .when(line == 7, "XY")
            .otherwise("N")
            .alias("InTransitFlag"),
            F.lit("GBR").alias("DisembarkationPortCountryCode"),
            country.alias("NationalityCountryCode"),
            F.when(p["l_returnflag"] == "A", F.concat(F.lit("P"), p["l_partkey"].cast("string")))
            .when(p["l_returnflag"] == "R", "")
            .alias("PassengerIdentifier"),
        )

    def keyed_entries(self) -> DataFrame:
        """Every entry of every archive without its content; plus `repeat`, `second` and `prior`."""
        k, part = F.col("k"), F.col("part")
        arrival = F.add_months(F.to_date("o_orderdate"), 24 * 12)
        blocks = F.expr("k div %d" % ORDERS_PER_BLOCK) + part
        block, round_no = _padded(blocks % 1_000_000, 6), F.floor(blocks / 1_000_000)

        def dated(date: Column, number: Column) -> Column:
            return F.concat(
                F.lit("drt_dq_"), F.date_format(date, "yyMMdd"),
                F.lit("_"), block, F.lit("_"), _padded(3 * round_no + number, 4), F.lit(".zip"),
            )

        first = F.when(
            k % 31 == 0, F.concat(F.lit("legacy_"), block, F.lit("_"), (7 * round_no + k % 7).cast("string"), F.lit(".zip"))
        ).otherwise(dated(F.col("zip_date"), k % 2))
        second = dated(F.date_add("zip_date", 1), F.lit(2))
        index = part * 2**32 + 2 * k

        def entry(name: Column, at: Column, repeat: bool, is_second: bool) -> Column:
            return F.struct(
                name.alias("zip_file_name"), at.alias("entry_index"),
                F.lit(repeat).alias("repeat"), F.lit(is_second).alias("second"),
            )

        entries = F.array_compact(
            F.array(
                entry(first, index, False, False),
                F.when(k % 13 == 0, entry(first, index + 1, True, False)),
                F.when(k % 29 == 0, entry(second, index, False, True)),
            )
        )
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        return (
            self.table("orders")
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .withColumnRenamed("o_orderkey", "k")
            .join(self._heavy_orders(), "k", "left")
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1)))
            .withColumn("arrival", arrival)
            .withColumn("zip_date", F.date_sub("arrival", (k % 5).cast("int")))
            .withColumn("e", F.explode(entries))
            .select(
                "k", "part", "o_custkey", "o_orderstatus", "c_nationkey", "arrival", "e.*",
                F.concat(
                    F.lit("m_"), k.cast("string"),
                    F.when(part > 0, F.concat(F.lit("_"), part.cast("string"))).otherwise(""),
                    F.lit(".json"),
                ).alias("json_file_name"),
                (~F.col("e.repeat") & ~F.col("e.second") & (k % 3 == 0)).alias("prior"),
            )
        )

    def entries(self) -> DataFrame:
        """zip_file_name, entry_index, json_file_name, content (JSON text), prior."""
        k = F.col("k")
        ports = F.array(*[F.lit(p) for p in ("LHR", "STN", "MAN", "EDI", "LGW")])
        document = F.struct(
            F.when(F.col("repeat"), "XX")
            .when(F.col("o_orderstatus") == "O", "CI")
            .otherwise("DC")
            .alias("EventCode"),
            F.get(ports, (F.col("o_custkey") % 5).cast("int")).alias("ArrivalPortCode"),
            F.concat(F.lit("P"), _padded(F.col("c_nationkey"), 2)).alias("DeparturePortCode"),
            F.when(k % 23 == 0, "12A").otherwise(_padded(F.col("o_custkey") % 10_000, 4)).alias("VoyageNumber"),
            F.when(k % 37 == 0, F.concat(F.lit("CARR"), (k % 7).cast("string"), F.lit("X")))
            .otherwise(F.concat(F.lit("C"), (k % 7).cast("string")))
            .alias("CarrierCode"),
            F.when(k % 19 == 0, "2022x06x01")
            .otherwise(F.date_format("arrival", "yyyy-MM-dd"))
            .alias("ScheduledDateOfArrival"),
            F.when(k % 2 == 0, "06:00").otherwise("07:30:00").alias("ScheduledTimeOfArrival"),
            F.md5(F.col("json_file_name").cast("binary")).alias("VoyageKey"),
            F.coalesce(F.col("passengers"), F.array()).alias(schema.PASSENGER_LIST),
        )
        return (
            self.keyed_entries()
            .join(self.passenger_lists(), ["k", "part"], "left")
            .select(
                "zip_file_name", "entry_index", "json_file_name",
                F.when(k % 17 == 0, "{}").otherwise(F.to_json(document)).alias("content"),
                "prior",
            )
        )

    def archive_names(self) -> DataFrame:
        """zip_file_name, zip_ok of every archive: those with entries, five empty and 25 corrupt ones."""
        filled = self.keyed_entries().select("zip_file_name").distinct()
        empty = self.table("region").select(
            F.concat(
                F.lit("drt_dq_260101_00000"), F.col("r_regionkey").cast("string"), F.lit("_0000.zip")
            ).alias("zip_file_name")
        )
        corrupt = self.table("nation").select(
            F.concat(
                F.lit("drt_dq_2602"), _padded(F.col("n_nationkey") + 1, 2), F.lit("_000000_0009.zip")
            ).alias("zip_file_name")
        )
        return (
            filled.unionByName(empty)
            .withColumn("zip_ok", F.lit(True))
            .unionByName(unreadable_headers(corrupt))
        )

    def archive_rows(self) -> DataFrame:
        """Header and entry rows, as a scan of the archives would give them; plus `prior`."""
        return (
            self.entries()
            .withColumn("zip_ok", F.lit(True))
            .unionByName(self.archive_names(), allowMissingColumns=True)
        )


class Inputs:
    """The derived archives as a table, and the views of it that queries start from."""

    def __init__(self, archive_rows: DataFrame):
        self._rows = archive_rows
        self._is_entry = F.col("entry_index").isNotNull()

    def archive_rows(self) -> DataFrame:
        return self._rows.drop("prior")

    def entries(self) -> DataFrame:
        return self._rows.filter(self._is_entry).drop("prior", "zip_ok")

    def keys(self) -> DataFrame:
        return self._rows.filter(self._is_entry).select("zip_file_name", "entry_index", "json_file_name")

    def archive_names(self) -> DataFrame:
        return self._rows.filter(~self._is_entry).select("zip_file_name", "zip_ok")

    def prior_pairs(self) -> DataFrame:
        """What an earlier run has recorded: a third of the documents."""
        return self._rows.filter("prior").select("zip_file_name", "json_file_name")

    def prior_rows(self) -> DataFrame:
        """The archives as that earlier run saw them."""
        names = self.prior_pairs().select("zip_file_name").distinct().withColumn("zip_ok", F.lit(True))
        return self._rows.filter("prior").drop("prior").unionByName(names, allowMissingColumns=True)


_INPUTS: dict[tuple[str, str], Inputs] = {}
_STORES: dict[tuple[str, str], Store] = {}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The archives of the given tables, derived and written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INPUTS:
        rows = Fixture(spark, sf_dir).archive_rows()
        _INPUTS[key] = Inputs(tables.written(rows, fresh_path(spark, "archive-rows")))
    return _INPUTS[key]


def stored(spark: SparkSession, sf_dir: str) -> Store:
    """The three tables after the earlier run and a full one, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        source = inputs(spark, sf_dir)
        store = Store(spark, fresh_path(spark, "store"), period="year")
        runs = [(source.prior_rows(), PRIOR_AT), (source.archive_rows(), BATCH_AT)]
        for batch_id, (rows, processed_at) in enumerate(runs):
            names = rows.filter(F.col("entry_index").isNull())
            run_batch(store, rows, names, batch_id, instant(processed_at))
        _STORES[key] = store
    return _STORES[key]


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir).read(tables.PASSENGER_FACT)


def json_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir).read(tables.JSON_LEDGER)


def zip_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir).read(tables.ZIP_LEDGER)


def dated(spark: SparkSession, sf_dir: str, table: str, date: str) -> DataFrame:
    """The rows of a ledger that can belong to a date; other partitions are not read."""
    return stored(spark, sf_dir).ledger_of_date(table, date).drop(*tables.PARTITIONS)

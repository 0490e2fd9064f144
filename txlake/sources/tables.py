"""Target tables on plain Parquet: catalog definitions, repeatable appends, dimension snapshots."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txlake.operators import scd2
from txlake.registry import ENTITIES, PROFILE_BUCKETS, Entity, entity

STATUS_SCHEMA = "entity STRING, records BIGINT, status STRING"
COMMIT_SCHEMA = "batch_id STRING, seq BIGINT, key_bucket INT, buckets INT, newest TIMESTAMP_NTZ, whole BOOLEAN"
# Rows of the first load for each part of a dimension that is rewritten on its own. The number of parts is fixed for the life of a table.
ROWS_PER_BUCKET = 500_000


# ---- Catalog ----


def day_column(e: Entity) -> str | None:
    return {"effective_date": "effective_day", "TX_DATETIME": "tx_date"}.get(e.day_of or "")


def with_day(df: DataFrame, kind: str | Entity) -> DataFrame:
    """Partition column: day of the entity's timestamp."""
    e = entity(kind)
    return df.withColumn(day_column(e), F.to_date(e.day_of)) if e.day_of else df


def create_tables(spark: SparkSession, database: str, location: str) -> list[str]:
    """Create the database and its four tables where they are missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for e in ENTITIES.values():
        columns = [f"{n} {t.simpleString()}" for n, t in e.fields]
        layout = ""
        if e.day_of:
            columns.append(f"{day_column(e)} date")
            layout = f"PARTITIONED BY ({day_column(e)})"
        elif e.bucket_by:
            layout = f"CLUSTERED BY ({e.bucket_by}) INTO {PROFILE_BUCKETS} BUCKETS"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{e.table} ({', '.join(columns)}) USING parquet {layout} "
            f"LOCATION '{location}/{e.table}'"
        )
    return [f"{database}.{e.table}" for e in ENTITIES.values()]


def insert(df: DataFrame, database: str, kind: str | Entity) -> None:
    """Append prepared rows to a catalog table in the table's column order."""
    e = entity(kind)
    rows = with_day(df, e)
    table = f"{database}.{e.table}"
    rows.select(*df.sparkSession.table(table).columns).write.insertInto(table)


# ---- Facts and appended tables ----


def with_layout(df: DataFrame, kind: str | Entity) -> tuple[DataFrame, list[str]]:
    """Rows with the partition columns of an appended table: day or hash bucket, then batch."""
    e = entity(kind)
    if e.bucket_by:
        bucket = F.pmod(F.xxhash64(e.bucket_by), F.lit(PROFILE_BUCKETS)).cast("int")
        return df.withColumn("customer_bucket", bucket), ["customer_bucket", "BATCH_ID"]
    return with_day(df, e), [day_column(e), "BATCH_ID"]


def append(df: DataFrame, kind: str | Entity, root: str) -> int:
    """Append prepared rows under `root`, partitioned by day (or key bucket) and batch; returns the rows written.

    A batch owns its partitions: loading it again replaces them, so a retry cannot double rows. The
    rebalance gathers a day into few files and splits a day that is too large for one.
    """
    rows, parts = with_layout(df, kind)
    seen = Observation()
    # Counted behind the shuffle, in the stage that writes: a stage that runs again cannot count twice.
    spread = rows.hint("rebalance", *[F.col(p) for p in parts]).observe(seen, F.count(F.lit(1)).alias("n"))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(
        f"{root}/{entity(kind).table}"
    )
    return seen.get["n"]


def read_appended(spark: SparkSession, kind: str | Entity, root: str) -> DataFrame:
    e = entity(kind)
    fields = [f"{n} {t.simpleString()}" for n, t in e.fields]
    fields.append("customer_bucket INT" if e.bucket_by else f"{day_column(e)} DATE")
    return spark.read.schema(", ".join(fields)).parquet(f"{root}/{e.table}")


# ---- Dimensions ----


@dataclass
class Commits:
    """What the commits say: number of the last batch, number of buckets, the newest start of each bucket, and whether a batch is among them."""

    seq: int = 0
    buckets: int = 0
    newest: dict[int, datetime] = field(default_factory=dict)
    repeated: bool = False


class DimensionTable:
    """A type 2 dimension as snapshots of its current rows and an ever-growing history, both by a bucket of the key.

    `data/loaded_by=<batch>/key_bucket=<n>/is_current=true` holds all current rows of a bucket after a batch that
    changed it, `.../is_current=false` the rows it closed, or, after a batch of older rows, all closed rows of the bucket.
    `commits` names the buckets of finished batches and is written
    last: a load that died leaves files nobody reads, and its retry overwrites them. One batch rewrites the current
    rows of the buckets it changes, and nothing where it changes nothing. One writer per table.
    """

    def __init__(self, spark: SparkSession, kind: str | Entity, root: str, buckets: int | None = None):
        """`buckets` counts for a table that is not there yet; without it, the size of the first load decides."""
        self.spark = spark
        self.entity = entity(kind)
        self.buckets = buckets
        self.data = f"{root}/{self.entity.table}/data"
        self.log = f"{root}/{self.entity.table}/commits"
        # Creates the empty log; nothing happens where there is one.
        spark.createDataFrame([], COMMIT_SCHEMA).write.mode("ignore").parquet(self.log)

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(self.log)

    def _known(self, batch_id: str) -> Commits:
        """One row per bucket comes to the driver."""
        per_bucket = self.commits().groupBy("key_bucket").agg(
            F.max("seq").alias("seq"), F.max("buckets").alias("buckets"), F.max("newest").alias("newest"),
            F.bool_or(F.col("batch_id") == batch_id).alias("repeated"),
        ).collect()
        return Commits(
            max((r["seq"] for r in per_bucket), default=0), max((r["buckets"] for r in per_bucket), default=0),
            {r["key_bucket"]: r["newest"] for r in per_bucket}, any(r["repeated"] for r in per_bucket),
        )

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.entity.history_key), F.lit(buckets)).cast("int")

    def _files(self) -> DataFrame:
        fields = ", ".join(f"{n} {t.simpleString()}" for n, t in self.entity.fields)
        return self.spark.read.schema(f"{fields}, loaded_by STRING, key_bucket INT, effective_day DATE").parquet(self.data)

    def _started(self) -> bool:
        return not self.commits().isEmpty()

    def _live(self, buckets: list[int] | None = None) -> DataFrame:
        rows = self._files().filter("is_current")
        if buckets is not None:
            rows = rows.filter(F.col("key_bucket").isin(buckets))
        # One row per bucket names its last batch.
        last = self.commits().groupBy("key_bucket").agg(F.max_by("batch_id", "seq").alias("loaded_by"))
        return rows.join(F.broadcast(last), ["loaded_by", "key_bucket"], "left_semi").select(*self.entity.columns)

    def _closed(self, buckets: list[int] | None = None) -> DataFrame:
        rows = self._files().filter(~F.col("is_current"))
        if buckets is not None:
            rows = rows.filter(F.col("key_bucket").isin(buckets))
        # From the last batch on that wrote all closed rows of a bucket.
        since = self.commits().groupBy("key_bucket").agg(F.coalesce(F.max(F.when(F.col("whole"), F.col("seq"))), F.lit(0)).alias("since"))
        finished = self.commits().join(F.broadcast(since), "key_bucket").filter(F.col("seq") >= F.col("since"))
        finished = finished.select(F.col("batch_id").alias("loaded_by"), "key_bucket").distinct()
        return rows.join(finished, ["loaded_by", "key_bucket"], "left_semi").select(*self.entity.columns)

    def current(self) -> DataFrame | None:
        """Current rows after the last finished batch; null table before the first."""
        return self._live() if self._started() else None

    def history(self) -> DataFrame | None:
        """Rows closed by finished batches."""
        return self._closed() if self._started() else None

    def read(self) -> DataFrame | None:
        return self._live().unionByName(self._closed()) if self._started() else None

    def _write(self, rows: DataFrame, batch_id: str, buckets: int) -> None:
        parts = ["key_bucket", "is_current", "effective_day"]
        (
            rows.withColumns({"key_bucket": self._bucket(buckets), "effective_day": F.to_date("effective_date")})
            .hint("rebalance", *[F.col(p) for p in parts])
            .write.mode("overwrite")
            # Everything a died attempt left in the folder of this batch has to go.
            .option("partitionOverwriteMode", "static")
            .partitionBy(*parts)
            # Spark undoes the escapes when it reads the partition value.
            .parquet(f"{self.data}/loaded_by={quote(batch_id, safe='')}")
        )

    def _commit(self, batch_id: str, known: Commits, newest: dict[int, datetime], whole: list[int]) -> None:
        rows = [(batch_id, known.seq + 1, b, known.buckets, t, b in whole) for b, t in sorted(newest.items())]
        self.spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(self.log)

    def load(self, incoming: DataFrame, batch_id: str, at: str, compare: list[str] | None = None) -> tuple[int, str]:
        """Merge a prepared delivery of any age; returns rows written and a status. A finished batch is not repeated.

        Buckets whose newest version starts behind `at` take the delivered rows into the middle of their keys' chains (`scd2.splice`)
        and are written whole, history included. The others get new current rows and the versions they close.
        """
        known = self._known(batch_id)
        if known.repeated:
            return 0, "already_loaded"
        if not known.seq:
            return self._first(incoming, batch_id, at)
        moment = datetime.fromisoformat(at)
        late = sorted(b for b, t in known.newest.items() if t > moment)
        usual = sorted(set(range(known.buckets)) - set(late))
        bucket = self._bucket(known.buckets)
        delivered = {True: incoming.filter(bucket.isin(late)), False: incoming.filter(bucket.isin(usual))} if late else {False: incoming}
        kinds = scd2.classify(delivered[False], self._live(usual if late else None), self.entity, compare).groupBy(bucket.alias("b"), "change_type")
        found = [tuple(r) for r in kinds.agg(F.count("*").alias("n")).collect()]
        if late:
            # Small, as it holds changed keys only, and used twice.
            changes = scd2.splices(delivered[True], self._live(late).unionByName(self._closed(late)), self.entity, at, compare).checkpoint()
            kinds = changes.groupBy(bucket.alias("b"), F.when(F.col("before").isNull(), F.lit("new")).otherwise(F.lit("changed")))
            found += [tuple(r) for r in kinds.agg(F.count("*").alias("n")).collect()]
        written = sum({"new": 1, "changed": 2}.get(kind, 0) * n for _, kind, n in found)
        if not written:
            return 0, "no_changes" if found or (late and not delivered[True].isEmpty()) else "empty"
        changed = {b for b, kind, _ in found if kind != "unchanged"}
        usual, late = sorted(changed & set(usual)), sorted(changed & set(late))
        parts = []
        if usual:
            parts.append(scd2.merge_current(incoming.filter(bucket.isin(usual)), self._live(usual), self.entity, at, compare))
        if late:
            mine = changes.filter(bucket.isin(late))
            parts.append(scd2.splice(self._live(late).unionByName(self._closed(late)), mine, self.entity, at))
        self._write(reduce(DataFrame.unionByName, parts), batch_id, known.buckets)
        self._commit(batch_id, known, {b: max(moment, known.newest.get(b, moment)) for b in changed}, late)
        return written, "success"

    def _first(self, incoming: DataFrame, batch_id: str, at: str) -> tuple[int, str]:
        seen, buckets = Observation(), self.buckets or max(1, -(-incoming.count() // ROWS_PER_BUCKET))
        rows = scd2.first_load(incoming, self.entity, at)
        self._write(rows.observe(seen, F.count(F.lit(1)).alias("n")), batch_id, buckets)
        written = seen.get["n"]
        if not written:
            return 0, "empty"
        starts = self._files().filter(F.col("loaded_by") == batch_id).groupBy("key_bucket").agg(F.max("effective_date").alias("t")).collect()
        newest = dict.fromkeys(range(buckets), datetime.fromisoformat(at)) | {r["key_bucket"]: r["t"] for r in starts}
        self._commit(batch_id, Commits(0, buckets), newest, [])
        return written, "success"


# ---- Dispatch ----


def upsert(
    df: DataFrame, kind: str, root: str, batch_id: str, at: str, compare: list[str] | None = None
) -> tuple[str, int, str]:
    """Load prepared rows the way their entity asks for: merge for dimensions with history, else append."""
    if kind not in ENTITIES:
        return kind, 0, "failed"
    e = ENTITIES[kind]
    if not e.has_history:
        # Writing nothing is cheaper than computing the rows once to see whether there are any.
        written = append(df, e, root)
        return kind, written, "success" if written else "empty"
    return (kind, *DimensionTable(df.sparkSession, e, root).load(df, batch_id, at, compare))


def status_frame(spark: SparkSession, statuses: list[tuple[str, int, str]]) -> DataFrame:
    """Status rows, one per entity of a batch."""
    return spark.createDataFrame(statuses, STATUS_SCHEMA)

"""Index of the ids a table holds, so that a delivery need not read all of them to find its repeats.

Ids lie in hash buckets, apart by owner, the batch or micro-batch that brought them. A delivery reads the buckets its own ids fall in,
one column of few rows each; k ids read k buckets at most, however large the table is. Ids are claimed before the rows are written:
an owner that died is run again and finds its own claims, and no other takes them over meanwhile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ids of the first delivery for each bucket; the number of buckets is fixed from then on.
IDS_PER_BUCKET, LEAST_BUCKETS = 20_000, 16


class IdIndex:
    """Ids under `folder`; `buckets` counts for an index that is not there yet, else the first delivery's size decides. One writer."""

    def __init__(self, spark: SparkSession, folder: str, key: str, kind: str = "string", buckets: int | None = None):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.ids, self.settings = f"{folder}/ids", f"{folder}/settings"
        self.schema = f"{key} {kind}, id_bucket INT, owner STRING"
        spark.createDataFrame([], self.schema).write.mode("ignore").partitionBy("id_bucket", "owner").parquet(self.ids)

    def _count(self, delivered: DataFrame) -> int:
        """Number of buckets, written down by the first delivery."""
        spark = self.spark
        spark.createDataFrame([], "buckets INT").write.mode("ignore").parquet(self.settings)
        known = spark.read.schema("buckets INT").parquet(self.settings).agg(F.max("buckets")).first()[0]
        if known is None:
            known = self.buckets or max(LEAST_BUCKETS, -(-delivered.count() // IDS_PER_BUCKET))
            spark.createDataFrame([(known,)], "buckets INT").coalesce(1).write.mode("append").parquet(self.settings)
        return known

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _entries(self, delivered: DataFrame, buckets: int) -> DataFrame:
        """Entries of the buckets in which delivered ids fall; at most one number per bucket comes to the driver."""
        ids = delivered.filter(F.col(self.key).isNotNull())
        touched = sorted(r["b"] for r in ids.select(self._bucket(buckets).alias("b")).distinct().collect())
        return self.spark.read.schema(self.schema).parquet(self.ids).filter(F.col("id_bucket").isin(touched))

    def held(self, delivered: DataFrame, owner: str) -> DataFrame:
        """Ids of other owners, among them all delivered ones that others hold."""
        return self._entries(delivered, self._count(delivered)).filter(F.col("owner") != owner).select(self.key)

    def claim(self, delivered: DataFrame, owner: str) -> DataFrame:
        """Note the delivered ids that no other owner holds, in place of what the owner noted before; gives the owner's ids."""
        buckets = self._count(delivered)
        ids = delivered.select(self.key).dropna().distinct()
        fresh = ids.join(self.held(delivered, owner), self.key, "left_anti")
        rows = fresh.select(self.key, self._bucket(buckets).alias("id_bucket"), F.lit(owner).alias("owner"))
        writer = rows.hint("rebalance", F.col("id_bucket")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("id_bucket", "owner").parquet(self.ids)
        return self._entries(delivered, buckets).filter(F.col("owner") == owner).select(self.key)

"""Exact duplicates by a distributed content sort."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.text import whole_text, without_white
from txlake.operators.skew import spread_join
from txlake.plans.session import shared_folder

# Code points of the content that a splitter holds; longer common beginnings are told apart by a hash.
PREFIX = 48
SAMPLE_PER_BUCKET = 50


def _sort_key(doc_id: str, text: str) -> Column:
    """Orders documents so that equal contents are adjacent and the one to keep comes first.

    The parts after the hash let a group of copies of any size spread over several buckets.
    """
    content = without_white(whole_text(text))
    return F.struct(
        F.substring(content, 1, PREFIX).alias("p"), F.xxhash64(content).alias("h"),
        (-F.length(whole_text(text))).alias("l"), F.col(doc_id).alias("d"),
    )


def _splitters(docs: DataFrame, key: Column, buckets: int) -> list[str]:
    """Smallest sampled key of each range, as JSON; one short key per bucket reaches the driver."""
    total = docs.count()
    keys = docs.select(key.alias("key"))
    if total > buckets * SAMPLE_PER_BUCKET:
        keys = keys.sample(buckets * SAMPLE_PER_BUCKET / total, seed=7)
    ranges = keys.repartitionByRange(buckets, "key").groupBy(F.spark_partition_id().alias("part"))
    least = ranges.agg(F.min("key").alias("key")).select(F.to_json("key", {"ignoreNullFields": "false"}).alias("key"))
    return [row.key for row in least.collect()]


def _bucket(key: Column, key_type: str, splitters: list[str]) -> Column:
    """Number of splitters that are not above the key, by binary search in a constant array."""
    if not splitters:
        return F.lit(0)
    constant = F.sort_array(F.from_json(F.lit(f"[{','.join(splitters)}]"), f"array<{key_type}>"))
    n = len(splitters)

    def halve(found: Column, step: Column) -> Column:
        probe = found + step
        return F.when((probe <= n) & (F.element_at(constant, F.least(probe, F.lit(n))) <= key), probe).otherwise(found)

    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, math.ceil(math.log2(n + 1)))))])
    return F.aggregate(steps, F.lit(0), halve)


def content_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with `__bucket`, `__at` (place in the sorted bucket) and `__run` (number of the run of equal
    contents there), and `__content`.

    Texts are shuffled once, to the bucket between two sampled splitters; a bucket is sorted externally and
    neighbours are compared in full.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = _sort_key(doc_id, text)
    key_type = docs.select(key.alias("key")).schema["key"].dataType.simpleString()
    bucket = _bucket(F.col("__key"), key_type, _splitters(docs, key, buckets))
    dealt = docs.withColumn("__key", key).withColumn("__bucket", bucket).repartition("__bucket")
    order = Window.partitionBy("__bucket").orderBy("__key.p", "__key.h", "__content", "__key.l", F.col("__key.d").asc_nulls_first())
    return (
        dealt.withColumn("__content", without_white(whole_text(text)))
        .withColumns({"__at": F.row_number().over(order), "__before": F.lag("__content").over(order)})
        .withColumn("__start", (~F.col("__content").eqNullSafe(F.col("__before"))).cast("int"))
        .drop("__before")
        .withColumn("__run", F.sum("__start").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )


def _offsets(runs: DataFrame, digest: Column) -> DataFrame:
    """One row per bucket: whether its first run began in an earlier bucket, and the number of runs that began
    in earlier buckets. The list is as long as the number of buckets, which bounds task and broadcast."""
    edges = runs.groupBy("__bucket").agg(
        F.min_by(digest, "__at").alias("first"), F.max_by(digest, "__at").alias("last"), F.max("__run").alias("runs")
    )
    by_bucket = Window.orderBy("__bucket")
    begun = edges.withColumn("__continues", F.coalesce(F.col("first") == F.lag("last").over(by_bucket), F.lit(False)))
    starts = F.col("runs") - F.col("__continues").cast("int")
    before = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    return begun.select("__bucket", "__continues", F.coalesce(F.sum(starts).over(before), F.lit(0)).alias("__offset"))


def _group_number() -> Column:
    return F.col("__offset") + F.col("__run") - F.col("__continues").cast("int")


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Texts are equal when they are identical after deleting all white space. Of equal texts, the row with the most code
    points stays, then the one with the smallest id (null first); of rows that repeat id and text, one. Null text is
    empty text. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    shared_folder(spark)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # What the sort found, without texts, is written once: three steps below read it.
    rows = content_runs(own).select(
        "doc_id", "__bucket", "__at", "__run", "__start", F.sha2("__content", 256).alias("text_sha256"),
        F.col("__key.l").alias("__shorter"),
    ).checkpoint()
    numbered = rows.join(F.broadcast(_offsets(rows, F.col("text_sha256"))), "__bucket").withColumn(
        "__group", _group_number()
    )
    groups = numbered.groupBy("__group").agg(
        F.count("*").alias("group_size"), F.min(F.struct("__bucket", "__at", "doc_id")).alias("__first")
    )
    place = F.struct("__bucket", "__at")
    return spread_join(numbered, groups, "__group", "inner").select(
        "doc_id",
        F.col("__first.doc_id").alias("keep_id"),
        "group_size",
        (place == F.struct(F.col("__first.__bucket").alias("__bucket"), F.col("__first.__at").alias("__at"))).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. Rules as in `duplicate_groups`; names beginning with two
    underscores are reserved."""
    shared_folder(docs.sparkSession)
    found = content_runs(docs, doc_id, text).filter(F.col("__start") == 1)
    # The first rows of the runs, with their texts, are kept once: both what lies at the bucket borders and the result are read from them.
    kept = [*[F.col(f"`{c}`") for c in docs.columns], "__bucket", "__at", "__run"]
    runs = found.select(*kept, F.sha2("__content", 256).alias("__digest")).checkpoint()
    edges = F.broadcast(_offsets(runs, F.col("__digest")))
    first = runs.join(edges, "__bucket").filter(~(F.col("__continues") & (F.col("__run") == 1)))
    return first.select(*[F.col(f"`{c}`") for c in docs.columns])

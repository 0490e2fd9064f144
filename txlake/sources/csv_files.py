"""Delimited landing files whose columns may come in any order, read by any number of tasks.

The lines of all files are written once, as they come, with the place of each. Whether a line begins a record depends on
the quotes before it: each byte range of a file counts its lines with an odd number of quotes, a prefix over the ranges of a file
gives the state in which each begins, and within a range the line's own place decides. Only lines of records that
span several lines are gathered; all others are records as they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txlake.functions.keys import decode_key
from txlake.functions.search import leading
from txlake.operators.ingest import header_names
from txlake.operators.prepare import FAULT
from txlake.operators.skew import spread_join
from txlake.plans.session import workspace
from txlake.registry import Entity, entity


# A quote inside a quoted field is doubled.
DIALECT = {"quote": '"', "escape": '"'}
TOO_LONG, TOO_SHORT = "more fields than the header", "fewer fields than the header"
UNCLOSED = "unclosed quote"
PATH = "_metadata.file_path"


def write(df: DataFrame, path: str, rows_per_file: int | None = None) -> str:
    """Header line in every file, at most `rows_per_file` rows each."""
    writer = df.write.mode("overwrite").options(header=True, **DIALECT)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)
    return path


def _text(spark: SparkSession, path: str | list[str], keys: list[str] | None) -> DataFrame:
    """Lines of the files under some paths; with `keys`, only of files that have the name of one of them, which is tested
    while files are listed, so that the others are not opened."""
    reader = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    rows = reader.option("ignoreMissingFiles", True).text(path)
    if keys is None:
        return rows
    # Spark shows file names percent-encoded.
    names = sorted({k.rsplit("/", 1)[-1] for k in keys})
    return rows.filter(decode_key(F.col("_metadata.file_name")).isin(names))


def headers(spark: SparkSession, path: str | list[str], keys: list[str] | None = None) -> DataFrame:
    """First line of each file under some paths; the lines behind it are read and dropped."""
    return (
        _text(spark, path, keys).filter("_metadata.file_block_start = 0")
        .select(F.col(PATH).alias("file_path"), "value", F.monotonically_increasing_id().alias("line"))
        .groupBy("file_path")
        .agg(F.min_by("value", "line").alias("header"))
    )


def stage_lines(
    spark: SparkSession, path: str | list[str], folder: str, keys: list[str] | None = None, name: Column | None = None,
    part: Column | None = None,
) -> DataFrame:
    """The lines of the files, written once: file, byte range, place in it, whether the quotes are odd, text.

    `name` is what a file is called from here on, `part` an optional column of its path to store lines apart by. The
    text is read here and nowhere else. Line breaks within fields become plain line feeds.
    """
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    lines = _text(spark, path, keys).select(
        (F.col(PATH) if name is None else name).alias("file_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"),
        odd.alias("odd"), "value", *([part.alias("part")] if part is not None else []),
    )
    writer = lines.write.mode("overwrite")
    (writer.partitionBy("part") if part is not None else writer).parquet(folder)
    return spark.read.schema(lines.schema).parquet(folder)


def ranges(lines: DataFrame) -> DataFrame:
    """One row per byte range of a file: its odd lines in order, how many there are in the ranges before, and in the file."""
    counted = lines.groupBy("file_path", "block").agg(F.sort_array(F.collect_list(F.when(F.col("odd"), F.col("line")))).alias("odd_lines"))
    whole = Window.partitionBy("file_path")
    n, before = F.size("odd_lines"), whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumns({"before": F.coalesce(F.sum(n).over(before), F.lit(0)), "of_file": F.sum(n).over(whole)})


def files_of(lines: DataFrame, cut: DataFrame) -> DataFrame:
    """One row per file: its header, the place of that line, and the fault of a file whose quotes do not come in pairs."""
    heads = lines.filter("block = 0").groupBy("file_path").agg(F.min_by("value", "line").alias("header"), F.min("line").alias("header_line"))
    faults = cut.groupBy("file_path").agg(F.when(F.max("of_file") % 2 == 1, F.lit(UNCLOSED)).alias("file_fault"))
    return heads.join(faults, "file_path")


def records(lines: DataFrame, cut: DataFrame) -> DataFrame:
    """file_path, block, line of the beginning, and text of each record; those of files with a fault come line by line."""
    quoted = cut.filter("of_file % 2 = 0 AND (before % 2 = 1 OR size(odd_lines) > 0)").select("file_path", "block", "before", "odd_lines")
    placed = lines.join(quoted, ["file_path", "block"], "left")
    earlier = F.col("before") + leading(F.col("odd_lines"), lambda x: x < F.col("line"))
    placed = placed.withColumn("earlier", F.when(F.col("before").isNotNull(), earlier))
    # Behind an odd number of odd lines, or on such a line, a field is open.
    spans = F.coalesce((F.col("earlier") % 2 == 1) | F.col("odd"), F.lit(False)) & F.col("earlier").isNotNull()
    whole = placed.filter(~spans).select("file_path", "block", "line", F.col("value").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("block", "line", "value")))
    joined = (
        placed.filter(spans).groupBy("file_path", F.floor(F.col("earlier") / 2).alias("number")).agg(parts.alias("parts"))
        .select("file_path", F.get("parts.block", F.lit(0)).alias("block"), F.get("parts.line", F.lit(0)).alias("line"),
                F.array_join("parts.value", "\n").alias("record"))
    )
    return whole.unionByName(joined)


def fields(found: DataFrame, files: DataFrame, e: Entity) -> DataFrame:
    """Records as text columns of the entity, with `file_path` and `read_fault`; headers, blank lines and records of other files or
    of files with a fault are left out."""
    known = files.filter(F.col("file_fault").isNull()).select("file_path", header_names(F.col("header")).alias("names"), "header_line")
    width = known.agg(F.coalesce(F.max(F.size("names")), F.lit(1))).first()[0]
    places = ", ".join(f"c{i} STRING" for i in range(width))
    rows = spread_join(found, known, "file_path", "inner").filter((F.col("line") != F.col("header_line")) & (F.trim("record") != ""))
    cells = F.from_csv("record", places, {"mode": "PERMISSIVE", **DIALECT})
    # Commas outside quotes; a doubled quote ends one quoted stretch and begins the next.
    bare = F.regexp_replace("record", '"[^"]*"', "")
    count = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    rows = rows.select("file_path", "names", cells.alias("cells"), count.alias("count"))
    rows = rows.select("file_path", "names", "count", F.array(*[f"cells.c{i}" for i in range(width)]).alias("cells"))
    wanted = [F.when(F.array_contains("names", n), F.get("cells", F.array_position("names", n).cast("int") - 1)).alias(n) for n in e.columns]
    fault = F.when(F.col("count") > F.size("names"), F.lit(TOO_LONG)).when(F.col("count") < F.size("names"), F.lit(TOO_SHORT))
    return rows.select("file_path", *wanted, fault.alias(FAULT))


def scan(spark: SparkSession, path: str | list[str], kind: str | Entity) -> DataFrame:
    """Rows of all files under some paths as text columns of the registry, plus `file_path` and `read_fault`.

    Fields are picked by the name found in the header of their own file, so files
    with reordered, extra or missing columns load together in one scan. A registry column that no header
    names is null. Quoted fields may hold commas, doubled quotes and line breaks. A row
    with more or fewer fields than its header has `read_fault`; a file with an unclosed quote gives no rows, `files_of` names it.
    """
    lines = stage_lines(spark, path, workspace(spark, "lines"))
    cut = ranges(lines)
    return fields(records(lines, cut), files_of(lines, cut), entity(kind))

"""Column expressions shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters of [\x20\x09-\x0D], the only ones that count as white space.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def without_white(text: Column) -> Column:
    """The text without its white space."""
    for char in WHITE:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds

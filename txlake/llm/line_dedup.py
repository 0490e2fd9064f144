"""Drop lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.text import WHITE, lower_ascii, whole_text
from txlake.operators.skew import spread_join


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def _key_hash(key: Column) -> Column:
    """128 bits, so that equal hashes mean equal lines also among 10^12 lines."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b"))


def _gaps(dropped: Column, n: Column) -> Column:
    """Stretches (start from 1, length) of kept lines between ascending dropped positions counted from 0."""
    before = F.concat(F.array(F.lit(-1)), dropped)
    after = F.concat(dropped, F.array(n))
    return F.zip_with(before, after, lambda b, a: F.struct((b + 2).alias("start"), (a - b - 1).alias("length")))


def drop_shared_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = 20, min_documents: int = 3
) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_text (the remaining lines joined by a line feed).

    A line whose key has at least `min_length` code points and is found in at least `min_documents`
    documents stays only in the document with the largest id among those holding it.

    Every row is a document. Null or empty text is one empty line; a null id is smaller than all ids;
    rows repeating an id count as documents of their own, and if theirs is the largest id, all of them keep
    the line. Other columns of the input are not read, whatever their names.

    A document sends each of its keys once; counts are combined before the shuffle. Lines and counts meet in
    a join that the adaptive plan splits at hot keys (`spread_join`). Texts are shuffled once, with the positions
    to drop, and put together from the stretches between them.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    # Rows equal in id and text lose the same lines, so this pair identifies rows well enough.
    identified = rows.withColumn("row", F.xxhash64("text"))
    lines = identified.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("at", "line")).select(
        "doc_id", "row", "at", line_key("line").alias("key")
    ).filter(F.length("key") >= min_length).select("doc_id", "row", "at", _key_hash(F.col("key")).alias("key"))

    once = identified.select(
        "doc_id",
        F.explode(F.array_distinct(F.transform(
            F.filter(F.transform(F.split("text", "\n"), line_key), lambda k: F.length(k) >= min_length), _key_hash
        ))).alias("key"),
    )
    shared = once.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("owner")).filter(
        F.col("n") >= min_documents
    ).select("key", "owner")
    drops = (
        spread_join(lines, shared, "key", "inner")
        .filter(~F.col("doc_id").eqNullSafe(F.col("owner")))
        # Repeated rows name each of their positions once.
        .groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("at")).alias("dropped"))
        .select(F.col("doc_id").alias("drop_id"), F.col("row").alias("drop_row"), "dropped")
    )
    joined = identified.join(
        drops, identified.doc_id.eqNullSafe(drops.drop_id) & (F.col("row") == F.col("drop_row")), "left"
    )
    split = joined.select("doc_id", "text", "dropped", F.split("text", "\n").alias("lines"))
    kept = F.flatten(F.transform(
        _gaps(F.col("dropped"), F.size("lines")), lambda g: F.slice("lines", g["start"], g["length"])
    ))
    return split.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), F.lit(0)).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )

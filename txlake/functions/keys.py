"""Object keys, paths and file names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.registry import ENTITIES, RAW_BUCKET


_FOLDERS = "|".join(ENTITIES)


def entity_of_key(key: Column) -> Column:
    """Entity named by the first path segment of an object key, else null."""
    folders = F.create_map(*[F.lit(x) for name in ENTITIES for x in (f"{name}/", name)])
    return F.element_at(folders, F.substring(key, F.lit(1), F.instr(key, "/")))


def entity_of_csv_key(key: Column) -> Column:
    """`entity_of_key` for keys that end in .csv, else null. Names the key once, so that it is computed once."""
    return F.nullif(F.regexp_extract(key, rf"(?s)^({_FOLDERS})/.*[.]csv\z", 1), F.lit(""))


def is_csv_key(key: Column, ignore_case: bool = False) -> Column:
    return (F.lower(key) if ignore_case else key).endswith(".csv")


def key_of_uri(uri: Column, bucket: str = RAW_BUCKET) -> Column:
    """Object key of an `s3://bucket/key` address; other texts pass unchanged."""
    return F.regexp_replace(uri, f"^s3://{bucket}/", "")


def decode_key(key: Column) -> Column:
    """Percent-decode a key; a plus sign stays a plus sign, a broken escape leaves the text as it is."""
    decoded = F.coalesce(F.try_url_decode(F.replace(key, F.lit("+"), F.lit("%2B"))), key)
    return F.when(F.contains(key, F.lit("%")), decoded).otherwise(key)


def drop_bucket_prefix(key: Column, bucket: str = RAW_BUCKET) -> Column:
    """Remove a leading `bucket/` repeated inside the key."""
    return F.regexp_replace(key, f"^{bucket}/", "")


def object_uri(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def archive_path(key: Column, accepted: Column) -> Column:
    return F.concat(F.when(accepted, F.lit("valid/")).otherwise(F.lit("invalid/")), key)


def staging_path(batch_id: Column, entity_name: Column) -> Column:
    return F.concat(F.lit("temp/parquet/"), batch_id, F.lit("/"), entity_name)


def batch_file_name(entity_name: Column, stamp: Column, number: Column) -> Column:
    """`transactions_20240301_093000_batch_007.csv`; numbers above 999 keep all their digits."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) >= 3, digits).otherwise(F.lpad(digits, 3, "0"))
    return F.concat(entity_name, F.lit("_"), F.date_format(stamp, "yyyyMMdd_HHmmss"), F.lit("_batch_"), padded, F.lit(".csv"))

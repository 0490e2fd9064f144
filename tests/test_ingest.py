"""Landing files: manifests, routing, headers, CSV in any column order, staging."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from txlake.functions import keys
from txlake.functions.geo import haversine_km
from txlake.operators import ingest
from txlake.operators.prepare import prepare
from txlake.plans.numbering import number_rows
from txlake.sources import csv_files, manifest, staging

AT = "2024-03-01 00:00:00"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw,clean",
    [
        ("customers%2Fa+b.csv", "customers/a+b.csv"),
        ("raw-data%2Fcustomers%2Fa.csv", "customers/a.csv"),
        ("raw-data/x", "x"),
        ("a%zz", "a%zz"),
        ("caf%C3%A9", "café"),
    ],
)
def test_key_decoding(spark, raw, clean):
    decoded = keys.decode_key(F.lit(raw))
    assert value(spark, keys.drop_bucket_prefix(decoded)) == clean


@pytest.mark.parametrize(
    "key,entity", [("customers/a.csv", "customers"), ("customers/.csv", "customers"), ("customers.csv", None),
                   ("customers/a.CSV", None), ("customers/a.csv\n", None), ("customers/a\nb.csv", "customers"), ("x/customers/a.csv", None)]
)
def test_entity_of_csv_key(spark, key, entity):
    assert value(spark, keys.entity_of_csv_key(F.lit(key))) == entity


def test_uris(spark):
    assert value(spark, keys.key_of_uri(F.lit("s3://raw-data/customers/a.csv"))) == "customers/a.csv"
    assert value(spark, keys.key_of_uri(F.lit("N/A"))) == "N/A"


@pytest.mark.parametrize(
    "key,entity,reason",
    [
        ("customers/a.csv", "customers", None),
        ("customers/a.CSV", "customers", "wrong extension"),
        ("customers/a.txt", "customers", "wrong extension"),
        ("other/a.csv", None, "unknown type"),
        ("customersx/a.csv", None, "unknown type"),
        ("terminals/a.csv", "terminals", "missing columns"),
    ],
)
def test_verdicts(spark, key, entity, reason):
    files = spark.createDataFrame([(key, '﻿"CUSTOMER_ID", HOME_CITY,HOME_REGION\r')], "file_key STRING, header STRING")
    row = ingest.judge(files).first()
    assert (row["entity"], row["reason"]) == (entity, reason)


def test_manifest_layouts(spark, tmp_path):
    """Pretty-printed and broken documents, one per file."""
    good = {"batch_id": "b1", "generated_at": "now", "files": [
        {"type": "customers", "s3_path": "s3://raw-data/customers/a.csv", "rows": 3},
        {"type": "transactions", "s3_path": "N/A", "rows": 4, "batch_id": "b1", "batch_num": 1},
    ]}
    (tmp_path / "m1.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "m2.json").write_text('{"batch_id": "b2", "files": [')
    (tmp_path / "m3.json").write_text('{"batch_id": "b3", "files": []}')
    listed = manifest.listed_files(manifest.read(spark, str(tmp_path), one_per_file=True))
    got = sorted((r["batch_id"], r["file_key"], r["rows_n"]) for r in listed.collect())
    assert got == [("b1", "N/A", 4), ("b1", "customers/a.csv", 3)]


def test_large_batch_is_split_into_documents(spark):
    files = spark.range(5000).selectExpr(
        "concat('customers/', id, '.csv') AS file_key", "'customers' AS folder", "concat('s3://raw-data/customers/', id) AS s3_path",
        "id AS rows_n", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('b', id % 100) END AS batch_id", "id AS batch_num",
    )
    documents = manifest.build(files, AT, files_per_document=200)
    sizes = documents.select("batch_id", F.size(F.from_json("document", manifest.MANIFEST_SCHEMA)["files"]).alias("n"))
    assert sizes.agg(F.sum("n"), F.max("n")).first()[0] == 5000
    assert sizes.agg(F.max("n")).first()[0] < 400
    assert sizes.filter("batch_id = 'hot'").count() == 9


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_scan_mixes_layouts(spark, tmp_path):
    """Reordered, extra and missing columns, quotes, a file with a header only."""
    d = str(tmp_path / "customers")
    write(d, "a.csv", 'CUSTOMER_ID,HOME_CITY,HOME_REGION,mean_amount\n1,"Acc, ra",North,10.5\n2,Ho,South,NA\n')
    write(d, "b.csv", "HOME_REGION,extra,HOME_CITY,CUSTOMER_ID\nWest,zzz,Kum,3\n")
    write(d, "c.csv", "CUSTOMER_ID,HOME_CITY,HOME_REGION\n")
    write(d, "d.txt", "CUSTOMER_ID,HOME_CITY,HOME_REGION\n9,x,y\n")
    out = csv_files.scan(spark, d, "customers")
    got = sorted((r["CUSTOMER_ID"], r["HOME_CITY"], r["HOME_REGION"], r["mean_amount"]) for r in out.collect())
    assert got == [("1", "Acc, ra", "North", "10.5"), ("2", "Ho", "South", "NA"), ("3", "Kum", "West", None)]
    typed = prepare(out, "customers", "b", AT)
    assert sorted((r["CUSTOMER_ID"], r["mean_amount"]) for r in typed.collect()) == [(1, 10.5), (2, None), (3, None)]


def test_scan_with_many_files_joins_by_shuffle(spark, tmp_path, monkeypatch):
    d = str(tmp_path / "shuffled")
    for i in range(4):
        write(d, f"f{i}.csv", "HOME_CITY,CUSTOMER_ID\nc,1\n" if i % 2 else "CUSTOMER_ID,HOME_CITY\n1,c\n")
    rows = csv_files.scan(spark, d, "customers").select("CUSTOMER_ID", "HOME_CITY", "HOME_REGION").collect()
    assert [tuple(r) for r in rows] == [("1", "c", None)] * 4


def _records(text):
    """Rows of RFC 4180 text, by the standard library."""
    import csv
    import io

    return [tuple(r) for r in csv.reader(io.StringIO(text, newline="")) if "".join(r).strip()]


def test_large_quoted_file_is_read_by_many_tasks(spark, tmp_path):
    """One file with fields over several lines and byte ranges: every range begins in the state that the ones before leave."""
    d = str(tmp_path / "customers")
    rnd = random.Random(1)
    odd = ["plain", 'say ""hi""', "a, b", "two\nlines", "four\n\n\nlines", "x" * 400, '""']
    body = "".join(f'{i},"{rnd.choice(odd)}",{rnd.choice(["r", "", chr(34) * 2])}\n' for i in range(3000))
    body += '3000,"' + "long\n" * 3000 + 'end",r\n' + "3001,c,r\n"
    write(d, "big.csv", "CUSTOMER_ID,HOME_CITY,HOME_REGION\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        lines = csv_files.stage_lines(spark, d, str(tmp_path / "lines"))
        assert lines.select("block").distinct().count() > 30
        cut = csv_files.ranges(lines)
        assert cut.filter("before % 2 = 1 AND size(odd_lines) = 0").count() >= 2  # ranges within one field
        rows = csv_files.scan(spark, d, "customers").select("CUSTOMER_ID", "HOME_CITY", "HOME_REGION", "read_fault").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = {r[0]: tuple(x or None for x in r[1:]) for r in _records(body)}
    assert {r[0]: (r[1], r[2]) for r in rows} == expected and len(rows) == 3002
    assert all(r.read_fault is None for r in rows)


def test_headers_are_per_file(spark, tmp_path):
    d = str(tmp_path / "many")
    for i in range(5):
        write(d, f"f{i}.csv", f"A{i},B\n" + "\n".join(f"{j},x" for j in range(3000)) + "\n")
    found = {r["file_path"][-6:]: r["header"] for r in csv_files.headers(spark, d).collect()}
    assert found == {f"f{i}.csv": f"A{i},B" for i in range(5)}


def test_headers_of_split_files(spark, tmp_path):
    """A file read in several splits still has one header, the first line."""
    d = str(tmp_path / "big")
    write(d, "f.csv", "K,V\n" + "\n".join(f"{j},{'x' * 50}" for j in range(20000)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert [r["header"] for r in csv_files.headers(spark, d).collect()] == ["K,V"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_files_per_csv(spark, tmp_path):
    path = csv_files.write(spark.range(0, 250, 1, 1), str(tmp_path / "out"), rows_per_file=100)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 3


def test_ledger(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "file_key STRING")
    ledger = spark.createDataFrame([("b",), ("b",)], "file_key STRING")
    assert sorted(r["file_key"] for r in ingest.unprocessed(files, ledger).collect()) == ["a", "c"]


@pytest.mark.parametrize("partitions", [1, 5])
def test_row_numbers_follow_the_order(spark, partitions):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS k", "id % 3 AS hot").repartition(partitions)
    rows = number_rows(df, ["hot", "k"]).collect()
    ordered = sorted(rows, key=lambda r: (r["hot"], r["k"]))
    assert [r["row_number"] for r in ordered] == list(range(1, 1001))


def test_row_numbers_of_nothing(spark):
    assert number_rows(spark.range(0).toDF("k"), ["k"]).count() == 0


def test_batch_file_name(spark):
    stamp = F.lit("2024-03-01 09:30:05").cast("timestamp_ntz")
    name = keys.batch_file_name(F.lit("transactions"), stamp, F.lit(7))
    assert value(spark, name) == "transactions_20240301_093005_batch_007.csv"
    assert value(spark, keys.batch_file_name(F.lit("t"), stamp, F.lit(12345))) == "t_20240301_093005_batch_12345.csv"


def test_staging_survives_a_bad_entity(spark, tmp_path):
    good, empty = spark.range(3).toDF("k"), spark.range(0).toDF("k")
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("k"))
    paths = staging.write_many({"customers": good, "terminals": empty, "transactions": bad}, str(tmp_path), "b")
    assert list(paths) == ["customers"]
    frames = staging.read_many(spark, {**paths, "travel_profiles": str(tmp_path / "absent")})
    assert list(frames) == ["customers"] and frames["customers"].count() == 3


@pytest.mark.parametrize(
    "a,b,km", [((0, 0), (0, 0), 0.0), ((0, 0), (180, 0), 20015.09), ((-0.187, 5.6037), (-1.6244, 6.6885), 199.52), ((0, 0), (0, 1), 111.19)]
)
def test_haversine(spark, a, b, km):
    got = value(spark, haversine_km(*[F.lit(float(v)) for v in (*a, *b)]))
    assert got == pytest.approx(km, abs=0.02)

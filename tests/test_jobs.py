"""A landing folder loaded end to end, twice, with dirty files and late arrivals."""

import json
import os

import pytest
from pyspark.sql import functions as F

from txlake import jobs
from txlake.operators import ingest
from txlake.registry import ENRICHMENT_COLUMNS
from txlake.sources import ledger, tables
from txlake.sources.tables import DimensionTable

DAY1, DAY2 = "2024-03-01 00:00:00", "2024-03-02 00:00:00"


def land(root, key, text):
    path = os.path.join(root, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def list_files(root, name, batch, keys):
    files = [{"type": k.split("/")[0], "s3_path": f"s3://raw-data/{k}", "rows": 1} for k in keys]
    land(root, f"metadata/{name}.json", json.dumps({"batch_id": batch, "generated_at": "x", "files": files}, indent=1))


CUSTOMERS = "CUSTOMER_ID,HOME_CITY,HOME_REGION,x_customer_id,y_customer_id,mean_amount\n"
TX = "TRANSACTION_ID,TX_DATETIME,CUSTOMER_ID,TERMINAL_ID,TX_AMOUNT,IS_NEW_REGION\n"


@pytest.fixture
def folders(tmp_path):
    landing = str(tmp_path / "landing")
    land(landing, "customers/c1.csv", CUSTOMERS + "1,a,r,0,0,10\n2,a,r,0,0,NA\n,a,r,0,0,1\n")
    land(landing, "customers/c2.csv", "HOME_REGION,HOME_CITY,CUSTOMER_ID\nr,b,3\n")
    land(landing, "transactions/t 1+x.csv", TX + "x1,2024-01-01T10:00:00+02:00,1,1,5.5,True\nx1,2024-01-01T10:00:00+02:00,1,1,5.5,True\n"
         "x2,junk,1,1,1,False\n")
    land(landing, "terminals/bad.csv", "CITY,REGION\na,r\n")
    land(landing, "misc/m.csv", "a\n1\n")
    land(landing, "customers/unlisted.csv", CUSTOMERS + "99,a,r,0,0,10\n")
    keys = ["customers/c1.csv", "customers/c2.csv", "transactions/t 1+x.csv", "terminals/bad.csv", "misc/m.csv", "customers/gone.csv"]
    list_files(landing, "metadata_1", "b1", keys)
    list_files(landing, "metadata_latest", "b1", keys)
    land(landing, "metadata/broken.json", '{"batch_id": "b1", "files": [')
    return landing, str(tmp_path / "lake")


def statuses(df):
    return {r["entity"]: (r["records"], r["status"]) for r in df.collect()}


def entries(spark, lake):
    return {r["file_key"]: (r["status"], r["reason"]) for r in ledger.read(spark, lake).collect()}


def customers(spark, lake):
    rows = DimensionTable(spark, "customers", lake).read().collect()
    return sorted((r["CUSTOMER_ID"], r["HOME_CITY"], r["version"], r["is_current"], r["mean_amount"]) for r in rows)


def test_batch(spark, folders):
    landing, lake = folders
    assert statuses(jobs.load_batch(spark, landing, lake, "b1", DAY1)) == {"customers": (3, "success"), "transactions": (1, "success")}
    assert customers(spark, lake) == [(1, "a", 1, True, 10.0), (2, "a", 1, True, None), (3, "b", 1, True, None)]
    tx = tables.read_appended(spark, "transactions", lake).collect()
    assert [(r["TRANSACTION_ID"], str(r["TX_DATETIME"]), r["IS_NEW_REGION"], r["BATCH_ID"]) for r in tx] == [
        ("x1", "2024-01-01 08:00:00", True, "b1")
    ]
    assert spark.read.parquet(f"{lake}/quarantine/dim_customers").count() == 1
    assert spark.read.parquet(f"{lake}/quarantine/fact_transactions").first()["reject_reason"] == "TX_DATETIME"
    assert entries(spark, lake) == {
        "customers/c1.csv": ("loaded", None), "customers/c2.csv": ("loaded", None), "transactions/t 1+x.csv": ("loaded", None),
        "terminals/bad.csv": ("rejected", "missing columns"), "misc/m.csv": ("rejected", "unknown type"),
    }
    # Nothing is left to do; the file that was not found stays open.
    assert statuses(jobs.load_batch(spark, landing, lake, "b1", DAY1)) == {}

    # A file is added to the batch; the next batch repeats a transaction, with another day, and changes a customer.
    land(landing, "customers/late.csv", CUSTOMERS + "4,z,r,0,0,1\n")
    land(landing, "transactions/t2.csv", TX + "x3,2024-01-01 09:00:00,1,1,7,False\n")
    list_files(landing, "metadata_2", "b1", ["customers/late.csv", "transactions/t2.csv"])
    assert statuses(jobs.load_batch(spark, landing, lake, "b1", DAY1)) == {"customers": (1, "success"), "transactions": (2, "success")}
    land(landing, "customers/n.csv", CUSTOMERS + "1,q,r,0,0,10\n2,a,r,0,0,\n")
    land(landing, "transactions/t3.csv", TX + "x3,2024-01-05 09:00:00,1,1,7,False\nx4,2024-01-03 09:00:00,1,1,7,False\n")
    list_files(landing, "metadata_3", "b2", ["customers/n.csv", "transactions/t3.csv"])
    assert statuses(jobs.load_batch(spark, landing, lake, "b2", DAY2)) == {"customers": (2, "success"), "transactions": (1, "success")}
    assert customers(spark, lake) == [
        (1, "a", 1, False, 10.0), (1, "q", 2, True, 10.0), (2, "a", 1, True, None), (3, "b", 1, True, None), (4, "z", 1, True, 1.0)
    ]
    tx = tables.read_appended(spark, "transactions", lake)
    assert sorted(r["TRANSACTION_ID"] for r in tx.collect()) == ["x1", "x3", "x4"]


def test_late_nested_and_quoted_files(spark, tmp_path):
    """A nested key, a foreign file of the same name, a listed file that comes later, quoted fields and a row that is too long."""
    landing, lake = str(tmp_path / "landing"), str(tmp_path / "lake")
    land(landing, "customers/2024/n.csv", CUSTOMERS + '1,"The ""Big"" City, North","A\nB",1,2,3\n2,a,r,0,0,1,extra\n')
    land(landing, "old/customers/2024/n.csv", "x,y\n1,2\n")
    list_files(landing, "metadata_1", "b1", ["customers/2024/n.csv", "customers/later.csv"])
    assert statuses(jobs.load_batch(spark, landing, lake, "b1", DAY1)) == {"customers": (1, "success")}
    row = DimensionTable(spark, "customers", lake).read().first()
    assert (row.HOME_CITY, row.HOME_REGION, row.x_customer_id) == ('The "Big" City, North', "A\nB", 1.0)
    assert spark.read.parquet(f"{lake}/quarantine/dim_customers").first()["reject_reason"] == "more fields than the header"
    assert set(entries(spark, lake)) == {"customers/2024/n.csv"}
    land(landing, "customers/later.csv", CUSTOMERS + "9,z,r,0,0,1\n")
    assert statuses(jobs.load_batch(spark, landing, lake, "b1", DAY1)) == {"customers": (1, "success")}
    assert {r.CUSTOMER_ID for r in DimensionTable(spark, "customers", lake).read().collect()} == {1, 9}


def test_failed_entity_is_taken_up_again(spark, folders, monkeypatch):
    landing, lake = folders
    real = tables.DimensionTable.load

    def broken(self, *args, **kwargs):
        return spark.range(1).select(F.raise_error(F.lit("disk lost"))).collect()

    monkeypatch.setattr(tables.DimensionTable, "load", broken)
    first = statuses(jobs.load_batch(spark, landing, lake, "b1", DAY1))
    assert first == {"customers": (0, "failed"), "transactions": (1, "success")}
    assert "customers/c1.csv" not in entries(spark, lake)
    monkeypatch.setattr(tables.DimensionTable, "load", real)
    assert statuses(jobs.load_batch(spark, landing, lake, "b1", DAY1)) == {"customers": (3, "success")}
    assert len(customers(spark, lake)) == 3


def test_missing_manifest_loads_nothing(spark, folders):
    landing, lake = folders
    assert statuses(jobs.load_batch(spark, landing, lake, "other", DAY1)) == {}


def test_unclosed_quote_rejects_the_file(spark, tmp_path):
    """A quote that never ends makes a fault of its file; its rows and none of the other files' are lost without a word."""
    landing, lake = str(tmp_path / "landing"), str(tmp_path / "lake")
    land(landing, "customers/open.csv", CUSTOMERS + '1,"a,r,0,0,1\n' + "".join(f"{i},a,r,0,0,1\n" for i in range(10, 20)))
    land(landing, "customers/good.csv", CUSTOMERS + '2,"b\n\n""c""",r,0,0,1\n3,a\n\n')
    list_files(landing, "metadata_1", "b1", ["customers/open.csv", "customers/good.csv"])
    assert statuses(jobs.load_batch(spark, landing, lake, "b1", DAY1)) == {"customers": (1, "success")}
    assert customers(spark, lake) == [(2, 'b\n\n"c"', 1, True, 1.0)]
    assert entries(spark, lake) == {"customers/open.csv": ("rejected", "unclosed quote"), "customers/good.csv": ("loaded", None)}
    assert spark.read.parquet(f"{lake}/quarantine/dim_customers").first()["reject_reason"] == "fewer fields than the header"


def test_any_failure_leaves_the_others(spark, folders, monkeypatch):
    """An error of Python, not of Spark, in one entity: the others are loaded, the report tells the reason and the counts."""
    landing, lake = folders

    def broken(self, *args, **kwargs):
        raise ValueError("no such day")

    monkeypatch.setattr(tables.DimensionTable, "load", broken)
    assert statuses(jobs.load_batch(spark, landing, lake, "b1", DAY1)) == {"customers": (0, "failed"), "transactions": (1, "success")}
    told = {r["entity"]: r for r in jobs.report(spark, lake, "b1").collect()}
    assert told["customers"]["reason"] == "ValueError: no such day" and told["transactions"]["reason"] is None
    seen = told["transactions"]
    # Both copies of a row count as read; the row without a time is rejected.
    assert (seen["n_rows"], seen["n_rejected"], seen["n_keys"], seen["run"]) == (2, 1, None, 0)
    assert set(seen["filled"]) == set(ENRICHMENT_COLUMNS) and set(seen["missing"].values()) == {0}
    assert set(entries(spark, lake)) == {"transactions/t 1+x.csv", "terminals/bad.csv", "misc/m.csv"}


def test_text_is_read_once(spark, folders, monkeypatch):
    """The landed files are opened by one scan; later steps read the staged lines."""
    from txlake.sources import csv_files

    landing, lake = folders
    scans, real = [], csv_files._text
    monkeypatch.setattr(csv_files, "_text", lambda *a: (scans.append(a[2]), real(*a))[1])
    jobs.load_batch(spark, landing, lake, "b1", DAY1)
    assert len(scans) == 1 and "misc/m.csv" not in scans[0]
    jobs.load_batch(spark, landing, lake, "b1", DAY1)
    # Only the file that was not found is still open; its entity is looked at again.
    assert all(k.startswith("customers/") for k in scans[1])


def test_required_columns_from_a_file(spark, folders):
    """Terminals without key columns are taken, customers need a column that one file lacks, transactions are not named."""
    landing, lake = folders
    told = {"terminals": {}, "customers": {"required_columns": ["CUSTOMER_ID", "mean_amount"]}}
    land(landing, "required.json", json.dumps(told, indent=1))
    required = ingest.read_required(spark, f"{landing}/required.json")
    assert required == {"terminals": [], "customers": ["CUSTOMER_ID", "mean_amount"]}
    got = statuses(jobs.load_batch(spark, landing, lake, "b1", DAY1, required))
    assert "transactions" not in str(got) and "customers" in str(got)
    reasons = {r["file_key"]: r["reason"] for r in ledger.read(spark, lake).collect()}
    assert reasons["customers/c1.csv"] is None and reasons["customers/c2.csv"] == "missing columns"
    assert reasons["transactions/t 1+x.csv"] == "no required columns known"
    assert reasons["terminals/bad.csv"] is None and reasons["misc/m.csv"] == "unknown type"


@pytest.mark.parametrize("text", ["", "{", "[1]", '{"customers": ["CUSTOMER_ID"]}', '{"customers": {"required_columns": [1]}}'])
def test_unusable_file_of_required_columns(spark, tmp_path, text):
    land(str(tmp_path), "required.json", text)
    with pytest.raises(ValueError, match="required"):
        ingest.read_required(spark, str(tmp_path / "required.json"))

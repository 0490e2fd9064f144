"""Plans at scale: what is shuffled, what a hot key does, results without any broadcast."""

import pytest
from pyspark.sql import functions as F

from tests.compare import difference
from txlake.fixtures import Frames
from txlake.operators import enrich, facts, history, scd2, signals
from txlake.workload import ORACLES, QUERIES


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
           if spark.conf.get(k, None) is not None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(
    "name", ["tx_enriched", "signal_score", "scd2_merge_customers", "star_current_region_spend", "tx_point_in_time", "csv_entity_scan"]
)
def test_same_result_without_broadcast(spark, duck, sf_dir, no_broadcast, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which small tables are split, and region centres but no dimensions are broadcast."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "20KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def lopsided(spark):
    """A third of the transactions on one customer, a third of them on one terminal; one row per customer and terminal."""
    n = 60_000

    def rows(*columns):
        return spark.range(0, n, 1, 8).selectExpr(*columns)

    day = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"
    tx = rows(
        "uuid() AS TRANSACTION_ID", f"{day} + make_dt_interval(0, 0, 0, id % 1000) AS TX_DATETIME", "if(id % 3 = 0, 1, id) AS CUSTOMER_ID",
        "if(id % 3 = 1, 1, id) AS TERMINAL_ID", "CAST(id AS DOUBLE) AS TX_AMOUNT",
    )
    customers = rows(
        "id AS CUSTOMER_ID", "concat('r', id % 16) AS HOME_REGION", "0.0D AS x_customer_id", "0.0D AS y_customer_id", "1.0D AS mean_amount",
        "1L AS version", "true AS is_current", f"{day} AS effective_date", "CAST(NULL AS TIMESTAMP_NTZ) AS end_date",
    )
    terminals = rows(
        "id AS TERMINAL_ID", "'c' AS CITY", "concat('r', id % 16) AS REGION", "0.0D AS x_terminal_id", "0.0D AS y_terminal_id",
        "1L AS version", "true AS is_current",
    )
    profiles = rows("id AS CUSTOMER_ID", "'r1,r2' AS TRAVEL_REGIONS", f"{day} AS created_at")
    middle = spark.range(0, 16).selectExpr("concat('r', id) AS region", "CAST(id AS DOUBLE) AS x", "0.0D AS y")
    return tx, customers, terminals, profiles, middle


def final_plan(df):
    """The plan that ran, and the rows."""
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0], rows


@pytest.mark.parametrize("name", ["enrich", "orphans", "high_amount", "point_in_time"])
def test_hot_customer_is_split(spark, small_partitions, lopsided, name):
    """The partition of the hot customer, and of the hot terminal, is read by several tasks of the join."""
    tx, customers, terminals, profiles, middle = lopsided
    df, joins = {
        "enrich": lambda: (enrich.enrich(tx, customers, terminals, profiles, middle, "2024-01-01 00:00:00"), 2),
        "orphans": lambda: (facts.orphans(tx, customers.filter("CUSTOMER_ID <> 1"), terminals), 2),
        "high_amount": lambda: (signals.high_amount(tx, customers), 1),
        "point_in_time": lambda: (facts.point_in_time(tx, customers, "CUSTOMER_ID"), 1),
    }[name]()
    plan, rows = final_plan(df)
    assert plan.count("skew=true") == joins
    assert len(rows) == (20_001 if name == "orphans" else 60_000)
    if name == "point_in_time":
        assert all(r.HOME_REGION == f"r{r.CUSTOMER_ID % 16}" for r in rows)


def test_asof_join_sorts_no_facts(spark, small_partitions, lopsided):
    """Windows and sorts work on summaries; the facts go from their scan through one shuffle into a hash join."""
    tx, customers, *_ = lopsided
    plan, _ = final_plan(facts.point_in_time(tx, customers, "CUSTOMER_ID"))
    join = plan.index("ShuffledHashJoin")
    of_facts = plan[join : plan.index("version", join)] if "version" in plan[join:] else plan[join:]
    assert "SortMergeJoin" not in plan and plan.count("Window") == 1
    assert "TRANSACTION_ID" in of_facts and "Sort " not in of_facts and "Window" not in of_facts


def hot(spark):
    return spark.range(0, 30000, 1, 6).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 500 END AS k",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 60) AS t", "CAST(id AS DOUBLE) AS v",
    )


def test_hot_key_is_spread_over_time_slices(spark):
    """Windows over rows are partitioned by key and slice; no group holds more than a small share."""
    df = hot(spark)
    plan = history.trailing_count(df, ["k"], "t", 6 * 3600, "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(k") == plan.count("Exchange hashpartitioning(k")
    assert "hashpartitioning(k#" in plan and "__slice" in plan
    sliced = df.groupBy("k", F.floor(F.unix_micros(F.col("t").cast("timestamp")) / 300e6)).count()
    assert sliced.agg(F.max("count")).first()[0] <= 10


def test_partial_aggregation_before_the_shuffle(spark, sf_dir):
    tx = Frames(spark, sf_dir)["tx_dup"]
    plan = facts.dedup(tx)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan
    sessions = history.sessions(tx, ["CUSTOMER_ID"], "TX_DATETIME", 1800, "TX_AMOUNT")
    assert "partial_sum" in sessions._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = QUERIES["signal_burst"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    assert "props" not in plan


def test_delta_shuffles_each_side_once(spark, no_broadcast, tmp_path):
    """Latest per key, restriction to delivered keys and the comparison share one partitioning by key."""
    columns = "TERMINAL_ID BIGINT, CITY STRING, REGION STRING, version BIGINT, effective_date TIMESTAMP_NTZ, is_current BOOLEAN"
    row = (1, "a", "r", 1, None, True)
    for name in ("dim", "batch"):
        spark.createDataFrame([row], columns).write.parquet(str(tmp_path / name))
    dim, batch = (spark.read.schema(columns).parquet(str(tmp_path / n)) for n in ("dim", "batch"))
    plan = scd2.delta(batch, dim, "terminals", "2024-01-01 00:00:00")._jdf.queryExecution().executedPlan().toString()
    # The dimension once; the delivery once for its rows and once for its bare keys.
    assert plan.count("Exchange ") == 3 and plan.count("Exchange hashpartitioning(TERMINAL_ID") == 3
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)" in plan


def test_trailing_count_shuffles_rows_once(spark, sf_dir):
    plan = QUERIES["signal_burst"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(CUSTOMER_ID#") == 3

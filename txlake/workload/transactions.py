"""Queries on facts: enrichment, joins, de-duplication, quality counts, signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlake.functions.geo import haversine_km, lower_clamp
from txlake.operators import enrich, facts, history, quality, signals
from txlake.operators.prepare import coerce_columns, prepare, time_literal
from txlake.registry import ENTITIES
from txlake.workload.deliveries import AS_OF, BATCH, START, enriched, merged, middle, travel_km
from txlake.workload.oracle_frames import haversine
from txlake.workload.registry import query

_CUT = "2024-01-16 00:00:00"


# ---- Geography and travel ----


@query("distinct_regions", "SELECT DISTINCT HOME_REGION FROM {customers_v1}")
def _(fx):
    return fx["customers_v1"].select("HOME_REGION").distinct()


@query(
    "region_centroids",
    "SELECT HOME_REGION AS region, round(avg(x_customer_id), 6) AS x, round(avg(y_customer_id), 6) AS y FROM {customers_v1} GROUP BY 1",
)
def _(fx):
    c = enrich.centroids(fx["customers_v1"], "HOME_REGION", "x_customer_id", "y_customer_id")
    return c.select("region", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(
    "region_distance_matrix",
    f"""
SELECT p.a AS HOME_REGION, p.b AS TERMINAL_REGION, {haversine('h.x', 'h.y', 'g.x', 'g.y')} AS AVG_REGION_DISTANCE_KM
FROM (SELECT DISTINCT c.HOME_REGION AS a, m.REGION AS b FROM {{tx}} t JOIN {{customers_v1}} c ON t.CUSTOMER_ID = c.CUSTOMER_ID
      JOIN {{terminals_v1}} m ON t.TERMINAL_ID = m.TERMINAL_ID) p
JOIN {{centroid}} h ON p.a = h.region JOIN {{centroid}} g ON p.b = g.region""",
)
def _(fx):
    """Distances of the region pairs that transactions connect."""
    met = fx["tx"].select("CUSTOMER_ID", "TERMINAL_ID").distinct()
    homes = fx["customers_v1"].select("CUSTOMER_ID", "HOME_REGION")
    places = fx["terminals_v1"].select("TERMINAL_ID", F.col("REGION").alias("TERMINAL_REGION"))
    pairs = met.join(homes, "CUSTOMER_ID").join(places, "TERMINAL_ID")
    return enrich.region_distances(pairs, middle(fx), "HOME_REGION", "TERMINAL_REGION")


@query(
    "haversine_km",
    f"SELECT CUSTOMER_ID, {haversine('c.x_customer_id', 'c.y_customer_id', 'g.x', 'g.y')} AS km FROM {{customers_v1}} c "
    "JOIN {geo} g ON c.HOME_CITY = g.city",
)
def _(fx):
    """Distance of every customer from the middle of the home city."""
    joined = fx["customers_v1"].join(fx["geo"], F.col("HOME_CITY") == F.col("city"))
    km = haversine_km(F.col("x_customer_id"), F.col("y_customer_id"), F.col("x"), F.col("y"))
    return joined.select("CUSTOMER_ID", km.alias("km"))


@query("tx_enriched", "SELECT * FROM {enriched}")
def _(fx):
    return enriched(fx)


@query("tx_region_distance", "SELECT TRANSACTION_ID, TERMINAL_REGION, AVG_REGION_DISTANCE_KM FROM {enriched}")
def _(fx):
    return enriched(fx).select("TRANSACTION_ID", "TERMINAL_REGION", "AVG_REGION_DISTANCE_KM")


@query("tx_is_new_region", "SELECT TRANSACTION_ID, CUSTOMER_TRAVEL_REGIONS, TERMINAL_REGION, IS_NEW_REGION FROM {enriched}")
def _(fx):
    return enriched(fx).select("TRANSACTION_ID", "CUSTOMER_TRAVEL_REGIONS", "TERMINAL_REGION", "IS_NEW_REGION")


@query(
    "tx_travel_profile",
    """
SELECT t.TRANSACTION_ID, t.CUSTOMER_ID, p.TRAVEL_REGIONS FROM {tx} t LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CUSTOMER_ID ORDER BY created_at DESC, TRAVEL_REGIONS DESC) AS rn FROM (
    SELECT CUSTOMER_ID, TRAVEL_REGIONS, TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM {travel_profiles}
    UNION ALL SELECT CUSTOMER_ID, HOME_REGION, TIMESTAMP '2024-03-01 00:00:00' FROM {customers_v2})) WHERE rn = 1) p
ON t.CUSTOMER_ID = p.CUSTOMER_ID""",
)
def _(fx):
    """Latest of several profiles per customer, attached to the transactions."""
    first = fx["travel_profiles"].select("CUSTOMER_ID", "TRAVEL_REGIONS", time_literal("2024-01-01 00:00:00").alias("created_at"))
    later = fx["customers_v2"].select("CUSTOMER_ID", F.col("HOME_REGION").alias("TRAVEL_REGIONS"), time_literal(AS_OF).alias("created_at"))
    profile = enrich.first_profile(first.unionByName(later)).drop("created_at")
    return fx["tx"].join(profile, "CUSTOMER_ID", "left").select("TRANSACTION_ID", "CUSTOMER_ID", "TRAVEL_REGIONS")


@query("tx_time_seconds", "SELECT TRANSACTION_ID, TX_TIME_SECONDS, TX_TIME_DAYS FROM {enriched}")
def _(fx):
    return fx["tx"].withColumns(enrich.time_offsets(START)).select("TRANSACTION_ID", "TX_TIME_SECONDS", "TX_TIME_DAYS")


@query("amount_clamp", "SELECT TRANSACTION_ID, greatest(0.1e0, TX_AMOUNT - 5e0) AS TX_AMOUNT FROM {tx}")
def _(fx):
    return fx["tx"].select("TRANSACTION_ID", lower_clamp(F.col("TX_AMOUNT") - 5.0).alias("TX_AMOUNT"))


@query("travel_regions_explode", "SELECT CUSTOMER_ID, unnest(string_split(TRAVEL_REGIONS, ',')) AS region FROM {travel_profiles}")
def _(fx):
    return enrich.travel_regions(fx["travel_profiles"])


@query("travel_avg_distance", "SELECT * FROM {travel_km}")
def _(fx):
    return travel_km(fx)


@query(
    "travel_profile_build",
    "SELECT CUSTOMER_ID, string_agg(DISTINCT REGION, ',' ORDER BY REGION) AS TRAVEL_REGIONS FROM {tx} t JOIN {terminals_v1} m "
    "ON t.TERMINAL_ID = m.TERMINAL_ID GROUP BY 1",
)
def _(fx):
    met = fx["tx"].select("CUSTOMER_ID", "TERMINAL_ID").distinct()
    places = fx["terminals_v1"].select("TERMINAL_ID", F.col("REGION").alias("TERMINAL_REGION"))
    return enrich.build_profiles(met.join(places, "TERMINAL_ID"))


@query(
    "customer_behavior_profile",
    "SELECT CUSTOMER_ID, round(avg(TX_AMOUNT), 9) AS mean_amount, round(stddev_samp(TX_AMOUNT), 6) AS std_amount, "
    "round(count(*) / CAST(count(DISTINCT CAST(TX_DATETIME AS DATE)) AS DOUBLE), 6) AS mean_nb_tx_per_day FROM {tx} GROUP BY 1",
)
def _(fx):
    profile = enrich.behavior_profile(fx["tx"])
    digits = {"mean_amount": 9, "std_amount": 6, "mean_nb_tx_per_day": 6}
    return profile.select("CUSTOMER_ID", *[F.round(c, n).alias(c) for c, n in digits.items()])


# ---- Facts ----


@query(
    "fact_dedup",
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY TRANSACTION_ID ORDER BY TX_DATETIME DESC, TX_AMOUNT DESC, "
    "CUSTOMER_ID DESC, TERMINAL_ID DESC) AS rn FROM {tx_dup}) WHERE rn = 1",
)
def _(fx):
    return facts.dedup(fx["tx_dup"])


@query("fact_idempotent_append", "SELECT * FROM {tx}")
def _(fx):
    """The target holds the first half of the month; the delivery repeats it whole."""
    target = fx["tx"].filter(F.col("TX_DATETIME") < time_literal(_CUT))
    return facts.idempotent_append(target, fx["tx"].unionByName(fx["tx"]))


@query(
    "star_current_region_spend",
    """
SELECT c.HOME_REGION, m.REGION AS TERMINAL_REGION, count(*) AS n_tx, round(sum(t.TX_AMOUNT), 2) AS amount
FROM {tx} t JOIN (SELECT * FROM {merged_c} WHERE is_current) c ON t.CUSTOMER_ID = c.CUSTOMER_ID
JOIN (SELECT * FROM {merged_t} WHERE is_current) m ON t.TERMINAL_ID = m.TERMINAL_ID GROUP BY 1, 2""",
)
def _(fx):
    return facts.star_spend(fx["tx"], merged(fx, "customers"), merged(fx, "terminals"))


@query(
    "orphan_transactions",
    """
SELECT t.*, concat_ws(',', CASE WHEN c.k IS NULL THEN 'customer' END, CASE WHEN m.k IS NULL THEN 'terminal' END) AS missing
FROM {tx} t LEFT JOIN (SELECT DISTINCT CUSTOMER_ID AS k FROM {customers_v2}) c ON t.CUSTOMER_ID = c.k
LEFT JOIN (SELECT DISTINCT TERMINAL_ID AS k FROM {terminals_v2}) m ON t.TERMINAL_ID = m.k WHERE c.k IS NULL OR m.k IS NULL""",
)
def _(fx):
    """Transactions without a partner in the second delivery, which lacks some keys."""
    customers = prepare(fx["customers_v2"], "customers", BATCH, AS_OF)
    terminals = prepare(fx["terminals_v2"], "terminals", BATCH, AS_OF)
    return facts.orphans(fx["tx"], customers, terminals)


# ---- Quality ----


def _batch(fx):
    return {
        "customers": prepare(fx["customers_v2"], "customers", BATCH, AS_OF),
        "terminals": prepare(fx["terminals_v2"], "terminals", BATCH, AS_OF),
        "travel_profiles": prepare(fx["travel_profiles"], "travel_profiles", BATCH, AS_OF),
        "transactions": prepare(fx["tx_raw"], "transactions", BATCH, AS_OF),
    }


_PROFILE = (
    "SELECT 'customers' AS entity, count(*) AS n_rows, count(DISTINCT CUSTOMER_ID) AS n_keys, CAST(14 AS BIGINT) AS n_columns FROM {inc_c} "
    "UNION ALL SELECT 'terminals', count(*), count(DISTINCT TERMINAL_ID), 11 FROM {inc_t} "
    "UNION ALL SELECT 'travel_profiles', count(*), count(DISTINCT CUSTOMER_ID), 5 FROM {travel_profiles} "
    "UNION ALL SELECT 'transactions', count(*), NULL, 15 FROM {tx_typed} WHERE TX_DATETIME IS NOT NULL AND CUSTOMER_ID IS NOT NULL"
)


@query("dq_entity_profile", _PROFILE)
def _(fx):
    return quality.entity_profile(_batch(fx))


@query("dq_total_records", f"SELECT CAST(sum(n_rows) AS BIGINT) AS total_records, count(*) AS n_entities FROM ({_PROFILE})")
def _(fx):
    return quality.total_records(_batch(fx))


_TX_REQUIRED = ENTITIES["transactions"].required_columns


@query(
    "dq_null_counts",
    " UNION ALL ".join(
        f"SELECT count(*) AS n_rows, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_nulls FROM {{tx_typed}}" for c in _TX_REQUIRED
    ),
)
def _(fx):
    return quality.required_null_counts(coerce_columns(fx["tx_raw"], "transactions"), "transactions")


@query(
    "enrichment_presence",
    " UNION ALL ".join(
        f"SELECT 'enriched' AS source, count(*) AS n_rows, '{c}' AS column_name, count({c}) AS n_filled, TRUE AS is_present FROM {{enriched}} "
        f"UNION ALL SELECT 'raw', count(*), '{c}', 0, FALSE FROM {{tx}}"
        for c in ("TERMINAL_CITY", "TERMINAL_REGION", "CUSTOMER_TRAVEL_REGIONS")
    ),
)
def _(fx):
    parts = [("enriched", enriched(fx)), ("raw", fx["tx"])]
    return quality.union_all([quality.enrichment_presence(df).withColumn("source", F.lit(name)) for name, df in parts])


# ---- Signals ----


@query(
    "signal_high_amount",
    """
SELECT t.*, t.TX_AMOUNT > 3e0 * c.mean_amount AS IS_HIGH_AMOUNT, t.TX_AMOUNT > a.m + 3e0 * a.s AS IS_HIGH_Z
FROM {tx} t LEFT JOIN {customers_v1} c ON t.CUSTOMER_ID = c.CUSTOMER_ID
LEFT JOIN (SELECT CUSTOMER_ID, avg(TX_AMOUNT) AS m, stddev_samp(TX_AMOUNT) AS s FROM {tx} GROUP BY 1) a ON t.CUSTOMER_ID = a.CUSTOMER_ID""",
)
def _(fx):
    return signals.high_amount(fx["tx"], fx["customers_v1"])


@query(
    "signal_geo",
    """
SELECT e.TRANSACTION_ID, e.IS_NEW_REGION, e.DISTANCE_FROM_HOME_KM, k.AVG_TRAVEL_DISTANCE_KM,
       coalesce(e.IS_NEW_REGION OR e.DISTANCE_FROM_HOME_KM > k.AVG_TRAVEL_DISTANCE_KM, FALSE) AS IS_GEO_RISK
FROM {enriched} e LEFT JOIN {travel_km} k ON e.CUSTOMER_ID = k.CUSTOMER_ID""",
)
def _(fx):
    rows = enriched(fx, about_customer=travel_km(fx), keep=("AVG_TRAVEL_DISTANCE_KM",))
    return signals.geo(rows).select(
        "TRANSACTION_ID", "IS_NEW_REGION", "DISTANCE_FROM_HOME_KM", "AVG_TRAVEL_DISTANCE_KM", "IS_GEO_RISK"
    )


@query(
    "signal_burst",
    "SELECT *, N_RECENT >= 3 AS IS_BURST FROM (SELECT *, count(*) OVER (PARTITION BY CUSTOMER_ID ORDER BY TX_DATETIME "
    "RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS N_RECENT FROM {tx})",
)
def _(fx):
    return signals.burst(fx["tx"])


def _scored(fx):
    usual = signals.usual(fx["customers_v1"], travel_km(fx))
    return signals.score(enriched(fx, signals.burst(fx["tx"]), about_customer=usual, keep=signals.SCORE_INPUTS))


_SCORE = "CAST(IS_HIGH_AMOUNT AS INTEGER) + CAST(IS_GEO_RISK AS INTEGER) + CAST(IS_BURST AS INTEGER)"


@query("signal_score", f"SELECT *, {_SCORE} AS score FROM {{scored}}")
def _(fx):
    return _scored(fx)


@query(
    "top_risky_customers",
    f"SELECT CUSTOMER_ID, CAST(sum({_SCORE}) AS BIGINT) AS total_score, count(*) AS n_tx FROM {{scored}} GROUP BY 1 "
    "ORDER BY 2 DESC, 1 LIMIT 20",
)
def _(fx):
    return signals.top_customers(_scored(fx))


@query(
    "region_risk_summary",
    "SELECT TERMINAL_REGION, IS_NEW_REGION, count(*) AS n_tx, round(sum(TX_AMOUNT), 2) AS amount, "
    "round(avg(DISTANCE_FROM_HOME_KM), 4) AS avg_distance_km FROM {enriched} GROUP BY 1, 2",
)
def _(fx):
    return signals.region_risk(enriched(fx))


@query(
    "session_activity",
    """
SELECT CUSTOMER_ID, min(TX_DATETIME) AS session_start, max(TX_DATETIME) AS session_last, count(*) AS n_tx, round(sum(TX_AMOUNT), 2) AS amount
FROM (SELECT *, sum(CASE WHEN prev IS NULL OR TX_DATETIME - prev > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
      OVER (PARTITION BY CUSTOMER_ID ORDER BY TX_DATETIME) AS s
      FROM (SELECT *, lag(TX_DATETIME) OVER (PARTITION BY CUSTOMER_ID ORDER BY TX_DATETIME) AS prev FROM {tx}))
GROUP BY CUSTOMER_ID, s""",
)
def _(fx):
    return history.sessions(fx["tx"], ["CUSTOMER_ID"], "TX_DATETIME", 1800, "TX_AMOUNT")


@query(
    "sliding_spend",
    """
SELECT CUSTOMER_ID, w AS window_start, count(*) AS n_tx, round(sum(TX_AMOUNT), 2) AS amount
FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, TX_DATETIME) - to_minutes(15 * k) AS w FROM {tx}, (SELECT unnest([0, 1, 2, 3]) AS k))
GROUP BY 1, 2""",
)
def _(fx):
    return signals.sliding_spend(fx["tx"])

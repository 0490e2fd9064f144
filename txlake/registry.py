"""Entity registry: column names, types, required marks, history keys and layouts.

Everything that depends on a schema reads it from here, so a column is named in one place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LONG, DOUBLE, STRING, BOOL, TIME = (
    T.LongType(),
    T.DoubleType(),
    T.StringType(),
    T.BooleanType(),
    T.TimestampNTZType(),
)

# Default put into a missing column or a null required field, by type. Timestamps have none.
DEFAULTS = {LONG: 0, DOUBLE: 0.0, STRING: "", BOOL: False, TIME: None}


@dataclass(frozen=True)
class Entity:
    """One target table."""

    name: str
    table: str
    required: tuple[tuple[str, T.DataType], ...]
    optional: tuple[tuple[str, T.DataType], ...]
    # Columns a file must carry to be recognised as this entity.
    signature: tuple[str, ...]
    # Rows where one of these is null cannot be repaired with a default.
    identity: tuple[str, ...]
    # Timestamp whose day is the partition, or None.
    day_of: str | None = None
    # Hash-bucketed key, or None.
    bucket_by: str | None = None
    history_key: tuple[str, ...] = ()
    compared: tuple[str, ...] = ()

    @property
    def fields(self) -> tuple[tuple[str, T.DataType], ...]:
        return self.required + self.optional

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def required_columns(self) -> list[str]:
        return [name for name, _ in self.required]

    @property
    def has_history(self) -> bool:
        return bool(self.history_key)

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(n, t, False) for n, t in self.required]
            + [T.StructField(n, t, True) for n, t in self.optional]
        )


# ---- Fixed values: table and column names, types, order, keys, bucket count, buckets' names ----
HISTORY_FIELDS = (
    ("version", LONG),
    ("effective_date", TIME),
    ("end_date", TIME),
    ("is_current", BOOL),
)
LINEAGE_FIELDS = (("BATCH_ID", STRING), ("created_at", TIME))

CUSTOMERS = Entity(
    name="customers",
    table="dim_customers",
    required=(("CUSTOMER_ID", LONG), ("HOME_CITY", STRING), ("HOME_REGION", STRING)),
    optional=(
        ("x_customer_id", DOUBLE),
        ("y_customer_id", DOUBLE),
        ("mean_amount", DOUBLE),
        ("std_amount", DOUBLE),
        ("mean_nb_tx_per_day", DOUBLE),
    )
    + HISTORY_FIELDS
    + LINEAGE_FIELDS,
    signature=("CUSTOMER_ID", "HOME_CITY", "HOME_REGION", "x_customer_id", "y_customer_id"),
    identity=("CUSTOMER_ID",),
    day_of="effective_date",
    history_key=("CUSTOMER_ID",),
    compared=(
        "HOME_CITY",
        "HOME_REGION",
        "x_customer_id",
        "y_customer_id",
        "mean_amount",
        "std_amount",
        "mean_nb_tx_per_day",
    ),
)

TERMINALS = Entity(
    name="terminals",
    table="dim_terminals",
    required=(("TERMINAL_ID", LONG), ("CITY", STRING), ("REGION", STRING)),
    optional=(("x_terminal_id", DOUBLE), ("y_terminal_id", DOUBLE)) + HISTORY_FIELDS + LINEAGE_FIELDS,
    signature=("TERMINAL_ID", "CITY", "REGION", "x_terminal_id", "y_terminal_id"),
    identity=("TERMINAL_ID",),
    day_of="effective_date",
    history_key=("TERMINAL_ID",),
    compared=("CITY", "REGION", "x_terminal_id", "y_terminal_id"),
)

TRAVEL_PROFILES = Entity(
    name="travel_profiles",
    table="dim_travel_profiles",
    required=(("CUSTOMER_ID", LONG),),
    optional=(("TRAVEL_REGIONS", STRING), ("AVG_TRAVEL_DISTANCE_KM", DOUBLE)) + LINEAGE_FIELDS,
    signature=("CUSTOMER_ID", "TRAVEL_REGIONS", "AVG_TRAVEL_DISTANCE_KM"),
    identity=("CUSTOMER_ID",),
    bucket_by="CUSTOMER_ID",
)

TRANSACTIONS = Entity(
    name="transactions",
    table="fact_transactions",
    required=(
        ("TRANSACTION_ID", STRING),
        ("TX_DATETIME", TIME),
        ("CUSTOMER_ID", LONG),
        ("TERMINAL_ID", LONG),
        ("TX_AMOUNT", DOUBLE),
    ),
    optional=(
        ("TX_TIME_SECONDS", LONG),
        ("TX_TIME_DAYS", LONG),
        ("DISTANCE_FROM_HOME_KM", DOUBLE),
        ("TERMINAL_CITY", STRING),
        ("TERMINAL_REGION", STRING),
        ("AVG_REGION_DISTANCE_KM", DOUBLE),
        ("IS_NEW_REGION", BOOL),
        ("CUSTOMER_TRAVEL_REGIONS", STRING),
    )
    + LINEAGE_FIELDS,
    signature=("TRANSACTION_ID", "TX_DATETIME", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT"),
    identity=("TRANSACTION_ID", "TX_DATETIME", "CUSTOMER_ID", "TERMINAL_ID"),
    day_of="TX_DATETIME",
)

# Order of routing by key prefix.
ENTITIES = {e.name: e for e in (CUSTOMERS, TERMINALS, TRANSACTIONS, TRAVEL_PROFILES)}
# Order of inference from a column set.
INFERENCE_ORDER = (TRANSACTIONS, CUSTOMERS, TERMINALS, TRAVEL_PROFILES)

RAW_BUCKET = "raw-data"
PROFILE_BUCKETS = 16
EARTH_RADIUS_KM = 6371.0
CREATED_EVENT_PREFIX = "s3:ObjectCreated:"
STATS_SECONDS = 300
STATS_INTERVAL = f"{STATS_SECONDS} seconds"
ROWS_PER_BATCH_FILE = 5000
ENRICHMENT_COLUMNS = ("TERMINAL_CITY", "TERMINAL_REGION", "CUSTOMER_TRAVEL_REGIONS")
# Words that the usual CSV readers take for a missing value.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)
# ---- End of fixed values ----


def entity(name: str | Entity) -> Entity:
    return name if isinstance(name, Entity) else ENTITIES[name]

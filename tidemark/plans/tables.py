"""Driver tables and the role each one plays for this engine.

lineitem = versioned line items with repeated keys (version ``l_shipdate``);
orders = transaction headers; events = reviews / clients / stock observations
(version ``ts``); supplier = branches and staff; part = products.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

# Fixed run stamps so audit columns are deterministic in checks.
RUN_1 = dt.date(2024, 1, 1)
RUN_2 = dt.date(2024, 2, 1)
RUN_3 = dt.date(2024, 3, 1)

LI_KEY = ["l_orderkey", "l_linenumber"]
LI_VERSION = "l_shipdate"
LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
# every non-key, non-version column, ascending: makes "first row wins" deterministic
LI_TIEBREAK = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus"]
EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]

# cut-over points used to split the driver tables into "already loaded" and "new batch"
LI_SPLIT = "1999-01-01 00:00:00"
EV_EARLY = "2024-01-15 00:00:00"
EV_KNOWN = "2024-01-20 00:00:00"
EV_NOW = "2024-01-25 00:00:00"
EV_STOCK_SEED = "2024-01-10 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

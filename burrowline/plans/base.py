"""Tables as the operators expect them, and the register of queries.

The given tables stand in for a cohort's: user_id is the subject, event_type the behaviour or the trigger line, ts the
clock, props.k the line's state (50 or more: high), an embedding one sample of all channels, vec_id its number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The events with whole microseconds (us) and the line's state, as SQL.
EV = "(SELECT *, epoch_us(ts) AS us, CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) >= 50 THEN 1 ELSE 0 END AS state FROM events)"


def query(sql: str) -> Callable:
    """Register a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").try_cast("int")
    return e.withColumns({"us": F.unix_micros("ts"), "state": F.when(k >= 50, 1).otherwise(0)})


def r4(c: Column) -> Column:
    return F.round(c, 4)

"""Lookup tables in a relational database. Needs the driver of that database."""

from pyspark.sql import DataFrame, SparkSession

from roadstream.operators.speeding import monitor_limits as limits_of
from roadstream.schemas import MONITOR_INFO, VIOLATION
from roadstream.session import snapshot

MONITOR_TABLE = "t_monitor_info"
VIOLATION_TABLE = "t_violation_list"


def table_options(connection: dict[str, str], table: str) -> dict[str, str]:
    """Reader options: `connection` (url, user, password, partitioning) plus the table."""
    if "url" not in connection:
        raise ValueError("the connection needs a url")
    return {**connection, "dbtable": table}


def read_table(spark: SparkSession, connection: dict[str, str], table: str) -> DataFrame:
    return spark.read.format("jdbc").options(**table_options(connection, table)).load()


def monitor_limits(
    spark: SparkSession, connection: dict[str, str], version: str | None = None,
    once: bool = False,
) -> DataFrame:
    """Limits per checkpoint. The columns and `speed_limit > 0` are pushed to the database.

    As the static side of a stream the table is read anew each micro-batch, which follows its
    changes; `once=True` reads it now and never again.
    """
    columns = [*MONITOR_INFO.fieldNames(), *([version] if version else [])]
    limits = limits_of(read_table(spark, connection, MONITOR_TABLE).select(*columns), version)
    return snapshot(limits) if once else limits


def violation_list(
    spark: SparkSession, connection: dict[str, str], once: bool = False
) -> DataFrame:
    listed = read_table(spark, connection, VIOLATION_TABLE).select(*VIOLATION.fieldNames())
    return snapshot(listed) if once else listed

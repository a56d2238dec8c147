"""Registry of the queries: a Spark plan each and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.catalog import oracle
from haulmark.plans.lake import Lake

Plan = Callable[[Lake], DataFrame]
PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}
_LAKES: dict[tuple[str, str], Lake] = {}


def query(name: str, sql: str | None = None, money: str = "", dates: str = "") -> Callable[[Plan], Plan]:
    """Register ``plan(lake)`` under a name. The views that ``sql`` names are put in front of it.

    ``money`` and ``dates`` name the decimal and date columns, which the SQL side shows as ``report`` does.
    """
    shown = ([f"CAST({c} AS DOUBLE) AS {c}" for c in money.split()]
             + [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()])
    if sql is not None and shown:
        sql = f"SELECT * REPLACE ({', '.join(shown)}) FROM ({oracle.sql(sql)}) shown"
    elif sql is not None:
        sql = oracle.sql(sql)

    def register(plan: Plan) -> Plan:
        assert name not in PLANS, name
        PLANS[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan
    return register


def lake_for(spark: SparkSession, sf_dir: str) -> Lake:
    """One lake per session and input folder, so numbered tables are loaded once."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _LAKES:
        _LAKES[key] = Lake(spark, str(sf_dir))
    return _LAKES[key]


def report(df: DataFrame) -> DataFrame:
    """Report edge: decimals as double, dates as ISO text. Sums were made in decimal before."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        out.append(column.alias(field.name))
    return df.select(*out)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(PLANS[name](lake_for(spark, sf_dir)))

"""Scans of the input tables with schemas declared up front."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LONG, _INT, _STR, _DBL, _TS = (
    T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampNTZType())


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


INPUT_SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(r_regionkey=_INT, r_name=_STR),
    "nation": _schema(n_nationkey=_INT, n_name=_STR, n_regionkey=_INT),
    "customer": _schema(c_custkey=_LONG, c_name=_STR, c_nationkey=_INT, c_acctbal=_DBL, c_mktsegment=_STR),
    "supplier": _schema(s_suppkey=_LONG, s_name=_STR, s_nationkey=_INT, s_acctbal=_DBL),
    "part": _schema(p_partkey=_LONG, p_name=_STR, p_brand=_STR, p_type=_STR, p_size=_INT, p_retailprice=_DBL),
    "orders": _schema(o_orderkey=_LONG, o_custkey=_LONG, o_orderstatus=_STR, o_totalprice=_DBL,
                      o_orderdate=_TS, o_orderpriority=_STR),
    "lineitem": _schema(l_orderkey=_LONG, l_partkey=_LONG, l_suppkey=_LONG, l_linenumber=_INT,
                        l_quantity=_DBL, l_extendedprice=_DBL, l_discount=_DBL, l_tax=_DBL,
                        l_returnflag=_STR, l_linestatus=_STR, l_shipdate=_TS),
    "events": _schema(event_id=_LONG, ts=_TS, user_id=_LONG, event_type=_STR, value=_DBL, props=_STR),
    "pages": _schema(page_id=_LONG, url=_STR, html=_STR),
}


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table. Column pruning and filters are left to Catalyst."""
    return spark.read.schema(INPUT_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV load: header skipped, UTF-8, fixed schema, bad rows fail the load."""
    return (spark.read.schema(schema)
            .option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST")
            .csv(path))

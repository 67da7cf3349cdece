"""The driver tables (FIXTURES §C), read with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The driver tables' schemas (FIXTURES §C).  Reading with a declared schema
# skips footer-based inference, which on a table of many files means
# opening every footer on the driver before the job starts.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


# The driver tables are read-only, so one DataFrame per (session, file) is
# reused by every query: the file is listed once per session, not once per
# reference in every query.
_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    memo = (id(spark), path)
    hit = _TABLES.get(memo)
    if hit is None or hit.sparkSession is not spark:
        reader = spark.read
        if name in DRIVER_SCHEMAS:
            reader = reader.schema(DRIVER_SCHEMAS[name])
        _TABLES[memo] = reader.parquet(path)
    return _TABLES[memo]

"""nested_tables holds every item, and its tables are as deep as it says."""

import duckdb
from pyspark.sql import functions as F

from docframe.queries import ORACLES, QUERIES
from tests.oracle import compare


def test_every_item_is_in_its_tables(spark, sf, tmp_path):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").filter("l_orderkey < 40")
    away = lines.filter("l_orderkey = 1").withColumn("l_orderkey", F.lit(5000).cast("long"))
    bare = lines.filter("l_orderkey = 2").withColumns({"l_orderkey": F.lit(5001).cast("long"), "l_partkey": F.lit(None).cast("long"), "l_linestatus": F.lit("a<b & c" + "d" * 200)})
    lines.unionByName(away).unionByName(bare).write.parquet(f"{tmp_path}/l")
    duckdb.sql(f"copy (from '{tmp_path}/l/*.parquet') to '{tmp_path}/lineitem.parquet'")
    duckdb.sql(f"copy (from '{sf}/orders.parquet' where o_orderkey < 60) to '{tmp_path}/orders.parquet'")
    found = QUERIES["nested_tables"](spark, str(tmp_path))
    compare(found, ORACLES["nested_tables"], str(tmp_path))
    rows = found.collect()
    n = spark.read.parquet(f"{tmp_path}/l").count()
    assert sum(r["table_index"] == 0 and r["column_index"] == 0 for r in rows) == n
    assert {5000, 5001} <= {r["doc_id"] for r in rows}
    deepest = {(r["doc_id"], r["table_index"]) for r in rows if r["parent_table"]}
    assert deepest and all((d, t - 1) in {(r["doc_id"], r["table_index"]) for r in rows if r["parent_table"] == 0} for d, t in deepest)

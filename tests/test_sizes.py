"""What a task holds must not grow with the table: partitions are dealt by rows, not by bytes or by the session's number."""

import re

from docframe import session
from docframe.operators import matching
from docframe.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearest_fields_are_paired_in_partitions_of_bounded_rows(spark, sf, monkeypatch):
    monkeypatch.setattr(session, "DEAL", 500)
    df = QUERIES["position_nearest_field"](spark, sf)
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count() // 500 + 1
    dealt = re.findall(r"hashpartitioning\([^)]*, (\d+)\)", plan(df))
    assert n > 4 and dealt == [str(n)] * 2
    assert df.count() == df.select("l_orderkey", "id").distinct().count() > 0


def test_fields_of_small_documents_are_compared_without_parts_of_words(spark, sf, monkeypatch):
    assert "Generate" not in plan(QUERIES["keyword_fields"](spark, sf))
    words = ["nom", "nominal", "prenom", "commercial", "commerce", "adresse", "adresses", "siret"]
    labels = [f"{a} {b}" for i, a in enumerate(words) for b in words[i::3]] + ["", "le la"]
    rows = spark.createDataFrame([(d, i, x) for d, n in ((1, len(labels)), (2, 3), (3, 4)) for i, x in enumerate(labels[:n])], "doc_id int, id int, label string")
    fields = rows.withColumnRenamed("id", "fid").filter("doc_id < 3")
    found = []
    for most in (64, 3, 0):  # all documents are small, one is large, all are
        monkeypatch.setattr(matching, "PAIRED", most)
        found.append(sorted(map(tuple, matching.keyword_fields(rows, fields).collect())))
    assert found[0] == found[1] == found[2] and {r[0] for r in found[0]} == {1, 2}
    assert matching.keyword_fields(rows, fields.limit(0)).count() == 0


def test_fills_are_dealt_over_the_tasks_by_rows(spark, sf, monkeypatch):
    monkeypatch.setattr(session, "DEAL", 100)
    made = plan(QUERIES["fill_validated"](spark, sf))
    n = spark.read.parquet(f"{sf}/orders.parquet").count() // 100 + 1
    assert n > 4 and re.findall(r"hashpartitioning\([^)]*, (\d+)\)", made) == [str(n)] * 2
    assert "BroadcastHashJoin" not in made

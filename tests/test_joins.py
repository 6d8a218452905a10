"""Joins whose sides are larger than Spark guesses must shuffle: no table goes whole through the driver."""

from pyspark.sql import functions as F

from docframe.operators import forms, records
from docframe.operators.edits import apply_edits, tag_documents
from docframe.plans import agent, pages


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_forms_are_not_broadcast(spark):
    docs = spark.range(8).select(F.col("id").alias("doc_id"), F.lit("<w:p><w:t>C1 - Cas général</w:t></w:p><w:p><w:t>Forme juridique</w:t></w:p>").alias("xml"))
    edits = docs.select("doc_id", F.lit(0).alias("nr"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("x").alias("text"))
    assert "BroadcastHashJoin" not in plan(apply_edits(docs, edits))
    done = forms.tag_form(docs, "DC2")
    assert "BroadcastHashJoin" not in plan(done)
    assert done.filter("inserted = array('FORME_JURIDIQUE')").count() == 8


def test_rounds_of_the_section_loop_are_not_broadcast(spark):
    tags = spark.range(8).select(F.col("id").alias("doc_id"), F.lit("S").alias("section"), F.lit("A").alias("tag"), F.lit(0).alias("ord"), F.lit("").alias("label"), *[F.lit(0).alias(c) for c in ("table_index", "row_index", "column_index")])
    places = tags.select("doc_id", "section", F.lit(0).alias("place"), F.lit("").alias("text"), "table_index", "row_index", "column_index")
    seen = []

    def matcher(mine, free):
        seen.extend(map(plan, (mine, free)))
        return mine.select("doc_id", "tag", F.lit(0).alias("place"), F.lit(0.8).alias("confidence"), F.lit("inline").alias("insertion_point")).filter("doc_id.doc_id < 0")

    assert agent.section_loop(tags, places, matcher)[0].count() == 8
    more = tags.unionByName(tags.withColumn("tag", F.lit("B")))  # leaves tags over for a second round
    assert agent.section_loop(more, places, matcher)[0].count() == 8
    assert "BroadcastHashJoin" not in "".join(seen)


def test_tagged_documents_are_not_broadcast(spark):
    docs = spark.range(8).select(F.col("id").alias("doc_id"), F.lit("<w:p><w:r><w:t>Line :</w:t></w:r></w:p>").alias("xml"))
    out, report = tag_documents(docs, docs.select("doc_id", F.lit("T").alias("tag"), F.lit(0).alias("index"), F.lit("after_colon").alias("insertion_point"), F.lit(0).alias("ord")))
    assert "BroadcastHashJoin" not in plan(out) + plan(report)
    assert report.filter("status = 'applied'").count() == 8


def test_inputs_that_are_read_several_times_are_written_once(spark, tmp_path):
    """Stages of field matching, page records and page fills read what was written, and do not make their inputs anew."""
    t = spark.range(4).select(F.col("id").alias("doc_id"), F.lit(1).alias("ord"), F.lit("T").alias("tag"), F.lit(1).alias("page"), F.lit(0.1).alias("x"), F.lit(0.0).alias("y"), F.lit("nom").alias("label"))
    sizes = t.select("doc_id", "page", F.lit(1.0).alias("width"), F.lit(1.0).alias("height"))
    matches, states, score = pages.match_fields(t, t.select("doc_id", "page", F.col("ord").alias("fid"), "x", "y", "label"), sizes)
    assert "Range" not in plan(states) + plan(score) and score.filter("percent = 100").count() == 4
    boxes = spark.range(4).select(F.col("id").alias("doc_id"), F.lit(1).alias("page"), F.lit(0).alias("index"), F.lit("Nom :").alias("text"), F.lit(10.0).alias("x"), F.lit(700.0).alias("y"), F.lit(30.0).alias("width"), F.lit(9.0).alias("height"))
    shown = records.page_records(boxes, 595.0, 842.0)
    assert plan(shown).count("Range") == 1 and shown.filter("size(fields) = 1 and size(lines) = 1").count() == 4

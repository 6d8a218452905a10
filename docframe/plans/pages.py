"""Positioned pages: transfer of tags to fields in stages, and the bounded loop that places values, looks at them and corrects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.functions.geometry import relative_score, text_width
from docframe.operators.layout import LEFT, checkbox_marks, filled_values, group_lines, label_places, observe
from docframe.operators.matching import keyword_fields, nearest_field, satisfaction
from docframe.plans.agent import ENOUGH, LEAST, ask, extract_json
from docframe.session import dealt, materialize, small

MAX_PAGE_ROUNDS, FONT, STEP_DOWN = 5, 9.0, 18.0
NEAR, ALIKE = 0.8, 0.7

FIELDS = 'Match each tag with the field that should hold its value. Answer with JSON: {"matches": [{"tag", "fieldId", "confidence"}]}.'
POSITIONS = 'Give each field the place of its value. Answer with JSON: {"positions": [{"tag", "page", "x", "y", "type", "confidence"}]}; type is inline or multiline.'
CORRECTIONS = 'These values collide with text. Give each field a better place. Answer with JSON: {"positions": [{"tag", "page", "x", "y", "type", "confidence"}]}.'


def field_prompts(tags: DataFrame, fields: DataFrame, limit: int = 200) -> DataFrame:
    """tags: doc_id, ord, tag, label; fields: doc_id, fid, page, label."""
    return ask(FIELDS, tags=(tags, "ord", limit, ["tag", "label"]), fields=(fields, "fid", limit, ["page", "label"]))


def position_prompts(values: DataFrame, lines: DataFrame, limit: int = 200) -> DataFrame:
    """values: doc_id, field, type; lines: doc_id, page, line, x, y, text."""
    return ask(POSITIONS, fields=(values, "field", limit, ["type"]), lines=(lines, "line", limit, ["page", "x", "y", "text"]))


def correction_prompts(bad: DataFrame, lines: DataFrame, limit: int = 200) -> DataFrame:
    """bad: doc_id, field, type, page, x, y; lines as of position_prompts."""
    return ask(CORRECTIONS, fields=(bad, "field", limit, ["type", "page", "x", "y"]), lines=(lines, "line", limit, ["page", "x", "y", "text"]))


def parse_fields(answers: DataFrame, least: float = LEAST["page"], default: float = 0.7) -> DataFrame:
    """doc_id, tag, fid, confidence of answers (doc_id, response); only a confidence that is missing takes the default."""
    found = F.from_json(extract_json(F.col("response")), "matches array<struct<tag:string,fieldId:string,confidence:double>>")["matches"]
    rows = answers.select("doc_id", F.explode(found).alias("m")).select("doc_id", "m.tag", F.col("m.fieldId").alias("fid"), F.coalesce("m.confidence", F.lit(default)).alias("confidence"))
    return rows.filter((F.col("tag") != "") & (F.col("fid") != "") & (F.col("confidence") >= least))


def parse_positions(answers: DataFrame, default: float = 0.8) -> DataFrame:
    """doc_id, field, page, x, y, type, confidence of answers (doc_id, response); without tag, page or y there is no position."""
    found = F.from_json(extract_json(F.col("response")), "positions array<struct<tag:string,page:int,x:double,y:double,type:string,confidence:double>>")["positions"]
    m = answers.select("doc_id", F.explode(found).alias("m")).select("doc_id", "m.*")
    or_else = lambda c, other: F.coalesce(F.nullif(F.col(c), F.lit(0.0)), F.lit(other))
    kind = F.when(F.col("type") == "inline", "inline").otherwise("multiline")
    return m.filter("tag <> '' and page is not null and y is not null").select("doc_id", F.col("tag").alias("field"), "page", or_else("x", LEFT).alias("x"), "y", kind.alias("type"), or_else("confidence", default).alias("confidence"))


def match_fields(expected: DataFrame, fields: DataFrame, pages: DataFrame, model: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tags of a template matched with the fields of a target: by relative position on the same page, what is left by keywords on all
    pages, what is then left by a model. Of equal tags of a document the first counts as matched, the others go on to the next stage.

    expected: doc_id, ord, tag, page, x, y, label; fields: doc_id, page, fid, x, y, label; pages: doc_id, page, width, height;
    model: (open rows of expected, fields) -> doc_id, ord, fid, confidence. Gives the matches (doc_id, ord, tag, fid, page, x, y,
    confidence, stage), expected with status and issue, and per document the percent of matched rows."""
    # Each stage reads both anew, so they are made and written once.
    expected, fields = materialize(expected, "field-tags"), materialize(fields, "field-places")
    first = expected.groupBy("doc_id", "tag").agg(F.min("ord").alias("ord"))
    places = fields.select("doc_id", "fid", "page", "x", "y")

    def staged(found: DataFrame, name: str) -> DataFrame:
        return found.join(expected.select("doc_id", "ord", "tag"), ["doc_id", "ord"]).join(places, ["doc_id", "fid"]).select("doc_id", "ord", "tag", "fid", "page", "x", "y", F.col("confidence").cast("double").alias("confidence"), F.lit(name).alias("stage"))

    def settled(matches: DataFrame) -> DataFrame:
        return first.join(matches.select("doc_id", "tag").distinct(), ["doc_id", "tag"], "left_semi").select("doc_id", "ord")

    rows = max(expected.count(), fields.count())
    dx, dy = (F.col("x") - F.col("fx")) / F.col("width"), (F.col("y") - F.col("fy")) / F.col("height")
    points = expected.join(pages, ["doc_id", "page"]).select("doc_id", "page", F.col("ord").alias("id"), "x", "y", "width", "height")
    targets = fields.select("doc_id", "page", "fid", F.col("x").alias("fx"), F.col("y").alias("fy"))
    near = nearest_field(dealt(points, rows, "doc_id", "page"), dealt(targets, rows, "doc_id", "page"), ["doc_id", "page"], relative_score(F.sqrt(dx * dx + dy * dy)), NEAR)
    matches = staged(near.select("doc_id", F.col("id").alias("ord"), "fid", F.col("score").alias("confidence")), "position")
    matches = materialize(matches, "field-matches")  # neither the next stage nor the states match anew
    rest = expected.join(settled(matches), ["doc_id", "ord"], "left_anti")
    alike = keyword_fields(rest.select("doc_id", F.col("ord").alias("id"), "label"), fields.select("doc_id", "fid", "label"), "doc_id", ALIKE)
    matches = matches.unionByName(staged(alike.select("doc_id", F.col("id").alias("ord"), "fid", F.col("score").alias("confidence")), "semantic"))
    if model is not None:
        rest = expected.join(settled(matches), ["doc_id", "ord"], "left_anti")
        matches = matches.unionByName(staged(model(rest, fields), "model"))
    matches = materialize(matches, "field-matches")
    done = settled(matches).withColumn("_done", F.lit(True))
    states = expected.join(done, ["doc_id", "ord"], "left").withColumn("status", F.when(F.col("_done"), "matched").otherwise("pending")).withColumn("issue", F.when(F.col("_done").isNull(), "no_match")).drop("_done")
    return matches, states, satisfaction(states, "doc_id", ("matched",))


def drawn(positions: DataFrame, value: str = "value", size: float = FONT) -> DataFrame:
    """Boxes of the values at their positions, to be read with those of the page."""
    return positions.select("doc_id", "page", F.lit(1 << 30).alias("index"), F.col(value).alias("text"), "x", "y", text_width(F.col(value), F.lit(size)).alias("width"), F.lit(size).alias("height"))


def fill_pages(
    boxes: DataFrame, values: DataFrame, config: DataFrame, page: int = 1, model: Callable[[DataFrame, DataFrame], DataFrame] | None = None, correct: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    checks: DataFrame | None = None, max_rounds: int = MAX_PAGE_ROUNDS, enough: int = ENOUGH,
) -> tuple[DataFrame, DataFrame]:
    """Positions (doc_id, field, type, page, x, y, value) of values, and per document expected, verified, percent, success.

    Each round asks the model for the fields without a place, finds those it leaves by their labels, draws the values and reads the
    page anew; values that collide with text are moved by correct, or down by STEP_DOWN. The loop ends when every field has a
    place or none collides, after max_rounds, and, without a model, when labels give nothing more. Each round is written.
    boxes as of layout; values: doc_id, field, value, blank ones are left out; config as of label_places; model, correct: (fields,
    lines) -> doc_id, field, type, page, x, y; checks: config of checkbox_marks, whose set boxes count as expected."""
    todo = filled_values(values).join(small(config.select("field", "type")), "field").select("doc_id", "field", "type", "value")
    columns = ["doc_id", "field", "type", "page", "x", "y"]
    boxes = boxes.select("doc_id", "page", "index", "text", *[F.col(c).cast("double").alias(c) for c in ("x", "y", "width", "height")])
    boxes = materialize(boxes, "page-boxes")  # the lines, the labels and each round's look at the page read them
    lines = materialize(group_lines(boxes), "page-lines")
    places: DataFrame | None = None
    for nth in range(max_rounds):
        open_ = todo if places is None else todo.join(places, ["doc_id", "field"], "left_anti")
        if (nth and model is None) or open_.isEmpty():
            break
        found = open_.sparkSession.createDataFrame([], todo.select("doc_id", "field", "type", F.lit(0).alias("page"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).schema) if model is None else model(open_, lines).select(*columns)
        rest = open_.join(found.select("doc_id", "field"), ["doc_id", "field"], "left_anti")
        near = label_places(lines, config, boxes, page).filter("page is not null").join(rest.select("doc_id", "field"), ["doc_id", "field"], "left_semi")
        new = found.unionByName(near.select(*columns))
        places = materialize(new if places is None else places.unionByName(new), "places")
        with_values = places.join(todo.drop("type"), ["doc_id", "field"])
        status = observe(group_lines(boxes.unionByName(drawn(with_values))), with_values.select("doc_id", "field", "type", "value"))
        bad = materialize(places.join(status.filter("status <> 'ok'").select("doc_id", "field"), ["doc_id", "field"], "left_semi"), "collisions")
        if bad.isEmpty():
            break
        moved = correct(bad, lines).select(*columns) if correct is not None else bad.withColumn("y", F.col("y") - STEP_DOWN)
        places = materialize(places.join(moved.select("doc_id", "field"), ["doc_id", "field"], "left_anti").unionByName(moved), "places")
    if places is None:
        places = todo.select("doc_id", "field", "type", F.lit(0).alias("page"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).limit(0)
    asked = todo.select("doc_id", "field").join(places.select("doc_id", "field").withColumn("status", F.lit("ok")), ["doc_id", "field"], "left")
    if checks is not None:
        boxed = lines.select("doc_id").distinct().crossJoin(small(checks.filter("checked").select("field")))
        marks = checkbox_marks(lines, checks).select("doc_id", "field").withColumn("status", F.lit("ok"))
        asked = asked.unionByName(boxed.join(marks, ["doc_id", "field"], "left"))
    score = satisfaction(asked.withColumn("status", F.coalesce("status", F.lit("missing"))), "doc_id", ("ok",))
    return places.join(todo.drop("type"), ["doc_id", "field"]).select(*columns, "value"), score.withColumn("success", F.col("percent") >= enough)

"""The bounded matching loop: each round matches what is still unverified, applies it and verifies; matchers are pluggable."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from docframe.functions.text import insertion_point, keyword_score, keywords
from docframe.operators.matching import by_position, duplicate_places, greedy_assignment, keyword_candidates, satisfaction, split_cells
from docframe.session import dealt, materialize, shuffled, ship_package

MAX_ROUNDS, ENOUGH = 3, 80
#: The least confidence of a match, by the kind of matching.
LEAST = {"model": 0.7, "unified": 0.7, "loop": 0.6, "page": 0.5}
DECISIONS = "array<struct<targetIdx:int,targetIndex:int,idx:int,label:string,checked:boolean,shouldBeChecked:boolean,confidence:double>>"
RESPONSE = "matches array<struct<tag:string,paragraphIndex:int,targetParagraphIndex:int,confidence:double,insertionPoint:string,reason:string>>"


class Matcher(Protocol):
    def __call__(self, tags: DataFrame, places: DataFrame) -> DataFrame:
        """doc_id, tag, place, confidence, insertion_point."""


def semantic_matcher(tags: DataFrame, places: DataFrame) -> DataFrame:
    """Offline matcher: position first, then keywords, each place once. tags: doc_id, tag, ord, label, table_index, row_index,
    column_index; places: doc_id, place, text, and the same ordinals."""
    cell = ["doc_id", "table_index", "row_index", "column_index"]
    asked, spots = tags.select("tag", "ord", "label", *cell), places.filter("table_index is not null").select(*cell, "place")
    rows = tags.count()
    placed = materialize(by_position(dealt(asked, rows, *cell), dealt(spots, rows, *cell), cell, "place", "left").select("doc_id", "tag", "ord", "label", "place"), "semantic-places")
    exact = placed.filter("place is not null").select("doc_id", "tag", "place", F.lit(0.90).alias("confidence"), F.lit("table_cell").alias("insertion_point"))
    rest = placed.filter("place is null")
    if rest.isEmpty():
        return exact
    # Only documents that have tags left look at their words.
    rest = materialize(shuffled(rest).join(exact.select("doc_id", "tag"), ["doc_id", "tag"], "left_anti").select("doc_id", "tag", "ord", keywords(F.col("label")).alias("words")), "semantic-rest")
    near = shuffled(places).join(rest.select("doc_id").distinct(), "doc_id", "left_semi")
    free = shuffled(near).join(exact.select("doc_id", "place"), ["doc_id", "place"], "left_anti").select("doc_id", "place", "text")
    found = greedy_assignment(keyword_candidates(rest, free, "doc_id"), "doc_id")
    return exact.unionByName(found.select("doc_id", "tag", "place", F.lit(0.75).alias("confidence"), F.lit("after_colon").alias("insertion_point")))


def section_matcher(tags: DataFrame, places: DataFrame) -> DataFrame:
    """semantic_matcher within sections: a tag is placed in its own section alone, by the cell at the same table of the section, row and
    column, else by keywords, each place once. tags: doc_id, section, tag, ord, label and the cell's ordinals, table_index counted
    in the section (relative_tables); places: doc_id, section, place, text and the same ordinals. A blank section is one of its own."""
    inside = lambda df: df.withColumn("doc_id", F.struct("doc_id", F.coalesce("section", F.lit("")).alias("section")))
    return semantic_matcher(inside(tags), inside(places)).withColumn("doc_id", F.col("doc_id.doc_id"))


def extract_json(response: Column) -> Column:
    """The JSON of a model's answer: a fenced block, else from the first brace to the last, else an array as matches."""
    fenced = F.nullif(F.regexp_extract(response, r"(?s)```(?:json)?\s*(.*?)```", 1), F.lit(""))
    text = F.coalesce(fenced, response)
    array = F.when(F.ltrim(text).startswith("["), F.concat(F.lit('{"matches":'), text, F.lit("}")))
    braces = F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit(""))
    return F.coalesce(array, braces)


def parse_response(answers: DataFrame, least: float = 0.6, default: float | None = 0.8) -> DataFrame:
    """doc_id, tag, place, confidence, insertion_point of answers (doc_id, response): entries without tag or place go, as do those
    below the least confidence; with a default, a missing or zero confidence takes it."""
    rows = answers.select("doc_id", F.explode(F.from_json(extract_json(F.col("response")), RESPONSE)["matches"]).alias("m")).select("doc_id", "m.*")
    confidence = F.coalesce(F.nullif(F.col("confidence"), F.lit(0.0)), F.lit(default)) if default is not None else F.col("confidence")
    out = rows.select("doc_id", "tag", F.coalesce("targetParagraphIndex", "paragraphIndex").alias("place"), confidence.alias("confidence"), insertion_point(F.col("insertionPoint")).alias("insertion_point"))
    return out.filter(F.col("tag").isNotNull() & F.col("place").isNotNull() & (F.col("confidence") >= least))


def parse_decisions(answers: DataFrame, least: float = LEAST["unified"], default: float = 0.8) -> DataFrame:
    """doc_id, target_index, label, checked, confidence of the checkboxes in answers (doc_id, response), by any of their names."""
    found = F.from_json(extract_json(F.col("response")), f"checkboxes {DECISIONS}, checkboxDecisions {DECISIONS}")
    rows = answers.select("doc_id", F.explode(F.coalesce(found["checkboxes"], found["checkboxDecisions"])).alias("m")).select("doc_id", "m.*")
    confidence = F.coalesce(F.nullif(F.col("confidence"), F.lit(0.0)), F.lit(default))
    out = rows.select("doc_id", F.coalesce("targetIdx", "targetIndex", "idx").alias("target_index"), F.coalesce("label", F.lit("")).alias("label"), F.coalesce("checked", "shouldBeChecked").alias("checked"), confidence.alias("confidence"))
    return out.filter((F.col("target_index") >= 0) & F.col("checked").isNotNull() & (F.col("confidence") >= least))


def ask(task: str, **lists: tuple[DataFrame, str, int, list[str]]) -> DataFrame:
    """One prompt a document that the first list holds: the task, then each list's first rows as JSON under its name. A list is
    (rows, order, limit, columns)."""
    out, parts = None, [F.lit(task)]
    for name, (rows, order, limit, columns) in lists.items():
        # Of a document's rows only the first are collected.
        first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id").orderBy(order))).filter(F.col("_n") <= limit)
        items = first.groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct(*dict.fromkeys([order, *columns]))))).alias(name))
        out = items if out is None else out.join(items, "doc_id", "left")
        parts += [F.lit(f"\n{name.capitalize()}: "), F.coalesce(name, F.lit("[]"))]
    return out.select("doc_id", F.concat(*parts).alias("prompt"))


PARAGRAPHS = 'Match each tag with the paragraph that should hold its value. Answer with JSON: {"matches": [{"tag", "paragraphIndex", "confidence", "insertionPoint"}]}.'


def prompts(tags: DataFrame, places: DataFrame, contexts: int = 40, lines: int = 80, feedback: DataFrame | None = None) -> DataFrame:
    """One prompt a document: its first tags and places as JSON and, with feedback (doc_id, feedback), what was wrong the last time."""
    asked = ask(PARAGRAPHS, tags=(tags, "ord", contexts, ["tag", "label"]), paragraphs=(places, "place", lines, ["text"]))
    if feedback is None:
        return asked
    told = F.concat("prompt", F.coalesce(F.concat(F.lit("\nThe last answer had errors, mend them: "), "feedback"), F.lit("")))
    return asked.join(feedback, "doc_id", "left").select("doc_id", told.alias("prompt"))


def model_matcher(client: Callable[[str], object]) -> Matcher:
    """A matcher that asks a client, called on the executors, and reads its answer whatever its wrapping."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            answers = []
            for prompt in f["prompt"]:
                a = client(prompt)
                for name in ("content", "text"):
                    a = a.get(name, a) if isinstance(a, dict) else getattr(a, name, a)
                answers.append(a if isinstance(a, str) else json.dumps(a))
            yield pd.DataFrame({"doc_id": f["doc_id"], "response": answers})

    def match(tags: DataFrame, places: DataFrame, feedback: DataFrame | None = None) -> DataFrame:
        asked = prompts(tags, places, feedback=feedback)
        kind = dict(asked.dtypes)["doc_id"]
        return parse_response(asked.mapInPandas(ask, f"doc_id {kind}, response string"))

    return match


def run_loop(tags: DataFrame, places: DataFrame, matcher: Matcher, verify: Callable[[DataFrame], DataFrame], fallback: Matcher = semantic_matcher, max_rounds: int = MAX_ROUNDS, enough: int = ENOUGH, save: Callable[[DataFrame], DataFrame] = lambda df: materialize(df, "round")) -> tuple[DataFrame, DataFrame]:
    """Matches and their percent of verified tags per document. verify: matches -> doc_id, tag, status. The loop ends when every
    document has enough, or after max_rounds; tags that the matcher leaves go to the fallback. save cuts the lineage of a
    round, by writing it to the shared folder: a model is asked once a round, however often its answers are read."""
    done: DataFrame | None = None
    for _ in range(max_rounds):
        good = verify(done).filter("status in ('ok', 'semantic_mismatch')").select("doc_id", "tag") if done is not None else None
        open_tags = tags if good is None else tags.join(good, ["doc_id", "tag"], "left_anti")
        first = matcher(open_tags, places)
        rest = open_tags.join(first.select("doc_id", "tag"), ["doc_id", "tag"], "left_anti")
        found = first.unionByName(fallback(rest, places))
        kept = done.join(good, ["doc_id", "tag"], "left_semi") if done is not None else None
        done = save(found if kept is None else kept.unionByName(found))
        all_tags = tags.select("doc_id", "tag").join(verify(done), ["doc_id", "tag"], "left").withColumn("status", F.coalesce("status", F.lit("missing")))
        score = satisfaction(all_tags, "doc_id")
        if score.filter(F.col("percent") < enough).isEmpty():
            break
    return done, score


class FeedbackMatcher(Protocol):
    def __call__(self, tags: DataFrame, places: DataFrame, feedback: DataFrame | None) -> DataFrame:
        """doc_id, tag, place, confidence, insertion_point. feedback: doc_id, feedback of documents whose last answer had issues."""


_CELL = ("table_index", "row_index", "column_index")


def mapping_loop(tags: DataFrame, places: DataFrame, matcher: FeedbackMatcher, fallback: Matcher = semantic_matcher, max_rounds: int = MAX_ROUNDS, paras: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(matches, log) of a mapping that is asked for again with its own issues.

    In each round the documents that are open are asked, with the issues of their last answer; an answer without issues (unified_issues)
    ends its document, an answer without matches too. Of the documents that still have issues after max_rounds the last answer counts, and
    tags that it leaves out go to the fallback; documents without any answer go to it whole. matches: doc_id, tag, place, confidence,
    insertion_point, mode (answer or fallback); log: a row a document and round, doc_id, round, n_matches, n_issues, state (clean, again,
    spent or empty). tags: doc_id, tag, ord, label and the cell's ordinals; places: as the matchers take them; paras: as unified_issues
    takes them. The state of a round is written, so a model is asked once for it."""
    cells = tags.select("doc_id", "tag", *_CELL)
    open_docs, feedback = tags.select("doc_id").distinct(), None
    kept, logs = [], []
    for n in range(1, max_rounds + 1):
        mine, here = tags.join(open_docs, "doc_id", "left_semi"), places.join(open_docs, "doc_id", "left_semi")
        found = materialize(matcher(mine, here, feedback), f"mapping-{n}")
        issues = materialize(unified_issues(found.join(cells, ["doc_id", "tag"]), mine, paras=paras), f"issues-{n}")
        counts = found.groupBy("doc_id").agg(F.count("*").alias("n_matches"))
        wrong = issues.groupBy("doc_id").agg(F.count("*").alias("n_issues"), F.array_join(F.array_sort(F.collect_set("issue")), ", ").alias("feedback"))
        state = F.when(F.col("n_matches") == 0, "empty").when(F.col("n_issues") == 0, "clean").otherwise("again" if n < max_rounds else "spent")
        seen = open_docs.join(counts, "doc_id", "left").join(wrong, "doc_id", "left").na.fill(0, ["n_matches", "n_issues"])
        log = materialize(seen.select("doc_id", F.lit(n).alias("round"), "n_matches", "n_issues", state.alias("state"), "feedback"), f"log-{n}")
        logs.append(log)
        # The last answer of a document counts: that of its last round, or, where that was empty, of the one before.
        kept.append(found.join(log.filter("n_matches > 0").select("doc_id"), "doc_id", "left_semi").withColumn("_round", F.lit(n)))
        again = log.filter("state = 'again'")
        open_docs, feedback = again.select("doc_id"), again.select("doc_id", "feedback")
        if again.isEmpty():
            break
    answers = reduce(DataFrame.unionByName, kept)
    last = answers.groupBy("doc_id").agg(F.max("_round").alias("_last"))
    final = answers.join(last, "doc_id").filter("_round = _last").select("doc_id", "tag", "place", "confidence", "insertion_point").withColumn("mode", F.lit("answer"))
    whole = reduce(DataFrame.unionByName, logs)
    clean = whole.filter("state = 'clean'").select("doc_id")
    rest = tags.join(clean, "doc_id", "left_anti").join(final, ["doc_id", "tag"], "left_anti")
    more = fallback(rest, places.join(clean, "doc_id", "left_anti")).withColumn("mode", F.lit("fallback"))
    return final.unionByName(more), whole.drop("feedback")


def section_loop(tags: DataFrame, places: DataFrame, matcher: Matcher, fallback: Matcher = semantic_matcher, max_rounds: int = MAX_ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(matches, log) of a loop over the sections of documents, all sections side by side.

    In each round the tags of a section that have no place are asked for among the section's own places; where the answer places none
    of them the fallback does. A place takes one tag, the first by ord, and keeps it. A section ends when all its tags have places.
    tags, places: as semantic_matcher takes them, with section; matches: doc_id, section, tag, place, confidence, insertion_point, mode;
    log: doc_id, section, round, asked, placed. Tags and places are read once, into a row a section; a round reads the sections that
    the one before left over, and the fallback those that the answer leaves to it."""
    return section_rounds(_sections(tags, places), matcher, fallback, max_rounds)


def section_rounds(sections: DataFrame, matcher: Matcher, fallback: Matcher = semantic_matcher, max_rounds: int = MAX_ROUNDS) -> tuple[DataFrame, DataFrame]:
    """section_loop over sections that are rows already: doc, part (the section, not null), tags and spots, arrays of the rows of tags and places
    without doc_id and section."""
    place = next(f.dataType for f in sections.schema["spots"].dataType.elementType if f.name == "place")
    state = materialize(sections.filter("size(tags) > 0").select("doc", "part", "tags", "spots", F.array().cast(ArrayType(place)).alias("gone")), "sections")
    done, logs = [], []
    for n in range(1, max_rounds + 1):
        rows = state.count()
        if not rows:
            break
        settled = _settled(state, matcher(_each(state, "tags"), _each(state, "spots")), rows, f"section-answer-{n}")
        parts, silent = {"answer": settled.filter("answered")}, settled.filter("not answered").select(*state.columns)
        rows = silent.count()
        if rows:
            parts["fallback"] = _settled(silent, fallback(_each(silent, "tags"), _each(silent, "spots")), rows, f"section-fallback-{n}")
        for mode, part in parts.items():
            done.append(_each(part, "won").withColumn("mode", F.lit(mode)))
            logs.append(part.select("doc", "part", F.lit(n).alias("round"), "asked", "placed"))
        state = reduce(DataFrame.unionByName, parts.values()).filter("size(tags) > 0").select(*state.columns)
    matches = reduce(DataFrame.unionByName, done) if done else _each(state, "tags").limit(0).select("doc_id", "section", "tag", F.lit(0).alias("place"), F.lit(0.0).alias("confidence"), F.lit("").alias("insertion_point"), F.lit("").alias("mode"))
    log = reduce(DataFrame.unionByName, logs) if logs else state.limit(0).select("doc", "part", F.lit(0).alias("round"), F.lit(0).cast("long").alias("asked"), F.lit(0).cast("long").alias("placed"))
    return matches.withColumn("doc_id", F.col("doc_id.doc_id")), log.withColumnsRenamed({"doc": "doc_id", "part": "section"})


def _sections(tags: DataFrame, places: DataFrame) -> DataFrame:
    part = F.coalesce("section", F.lit("")).alias("part")
    rows = lambda df: F.struct(*[c for c in df.columns if c not in ("doc_id", "section")])
    sides = [df.select(F.col("doc_id").alias("doc"), part, rows(df).alias(name)) for df, name in ((tags, "tag"), (places, "spot"))]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    return both.groupBy("doc", "part").agg(F.collect_list("tag").alias("tags"), F.collect_list("spot").alias("spots"))


def _each(sections: DataFrame, column: str) -> DataFrame:
    """The rows that sections hold in a column; their doc_id names document and section."""
    return sections.select(F.struct(F.col("doc").alias("doc_id"), F.col("part").alias("section")).alias("doc_id"), F.col("part").alias("section"), F.explode(column).alias("_x")).select("doc_id", "section", "_x.*")


def _settle(tags: list[tuple], spots: set, gone: set, answers: list[tuple]) -> tuple[bool, dict]:
    """(whether an answer names a tag and a place of the section, the tags that get a place with the number of the answer that gives it). tags:
    (tag, ord); answers: (tag, place, confidence, insertion_point). A tag wants its best free place, and of the tags that want one the first
    has it."""
    order: dict = {}
    for tag, nth in sorted(tags, key=lambda t: (t[1] is not None, t[1] or 0, t[0])):
        order.setdefault(tag, nth)
    ranks = {tag: i for i, tag in enumerate(order)}
    best = sorted(enumerate(answers), key=lambda a: (a[1][2] is None, a[1][2] == a[1][2], -(a[1][2] or 0.0), a[1][1], a[1][3] or ""))
    own = [(i, tag, place) for i, (tag, place, *_) in best if tag in ranks and (place in spots or place in gone)]
    wants: dict = {}
    for i, tag, place in own:
        if place in spots:
            wants.setdefault(tag, (i, place))
    taken: set = set()
    won = {}
    for tag in sorted(wants, key=ranks.__getitem__):
        i, place = wants[tag]
        if place not in taken:
            taken.add(place)
            won[tag] = i
    return bool(own), won


def _settled(sections: DataFrame, answer: DataFrame, rows: int, name: str) -> DataFrame:
    """Sections after an answer: tags and spots hold what is left, nothing where all tags have places; gone: the places that are taken; won:
    the matches; answered: whether the answer names a tag and a place of the section; asked and placed: numbers of tags. A section's
    answers meet it in one shuffle; sections without any stay as they are."""
    ship_package(sections.sparkSession)
    match = F.struct("tag", "place", "confidence", "insertion_point")
    given = answer.filter("tag is not null and place is not null").select(F.col("doc_id.doc_id").alias("doc"), F.col("doc_id.section").alias("part"), match.alias("a"))
    # Partitions are bounded by rows, for a section takes few bytes but holds several rows.
    lists = dealt(given, 3 * rows, "doc", "part").groupBy("doc", "part").agg(F.collect_list("a").alias("_given"))
    met = shuffled(dealt(sections.select("doc", "part", "tags", "spots", "gone"), 3 * rows, "doc", "part")).join(lists, ["doc", "part"], "left")
    asked = F.col("_given").isNotNull()
    inner = {(c, f): F.when(asked, F.transform(c, lambda x: x[f])) for c, f in (("tags", "tag"), ("tags", "ord"), ("spots", "place"))}  # noqa: B023
    met = met.withColumn("_how", _chosen(*inner.values(), F.when(asked, F.col("gone")), F.col("_given"), met.schema["gone"].dataType))
    at = lambda c, nths: F.transform(nths, lambda i: F.get(c, i))
    left = {c: F.when(asked, at(F.col(c), F.col("_how")[c])).otherwise(F.col(c)).alias(c) for c in ("tags", "spots")}
    gone = F.when(asked, F.concat("gone", F.col("_how.taken"))).otherwise(F.col("gone"))
    won = F.coalesce(at(F.col("_given"), F.col("_how.won")), F.array().cast(met.schema["_given"].dataType))
    sums = [F.coalesce("_how.answered", F.lit(False)).alias("answered"), F.size("tags").cast("long").alias("asked"), F.when(asked, F.size("_how.won")).otherwise(0).cast("long").alias("placed")]
    return materialize(met.select("doc", "part", *left.values(), gone.alias("gone"), won.alias("won"), *sums), name)


def _chosen(names: Column, orders: Column, places: Column, gone: Column, given: Column, taken: ArrayType) -> Column:
    """Struct(answered, tags, spots, taken, won) of _settle for each section: numbers of the tags that are left, of the places that are free
    then (none where no tag is left) and of the answers that count, and the places they take. Null without answers."""
    kind = StructType([StructField("answered", BooleanType()), *[StructField(c, ArrayType(IntegerType())) for c in ("tags", "spots", "won")], StructField("taken", taken)])

    @F.arrow_udf(kind)
    def run(names: pa.Array, orders: pa.Array, places: pa.Array, gone: pa.Array, given: pa.Array) -> pa.Array:
        fields = [given.values.field(f).to_pylist() for f in ("tag", "place", "confidence", "insertion_point")]
        answers, ends = [*zip(*fields, strict=True)], given.offsets.to_pylist()
        out: dict[str, list] = {c: [] for c in ("answered", "tags", "spots", "won", "taken")}
        for n, (t, o, p, g) in enumerate(zip(*(x.to_pylist() for x in (names, orders, places, gone)), strict=True)):
            if t is None:
                row = (None,) * 5
            else:
                mine = answers[ends[n] : ends[n + 1]]
                answered, won = _settle([*zip(t, o, strict=True)], {*p}, {*g}, mine)
                left = [i for i, tag in enumerate(t) if tag not in won]
                took = {mine[i][1] for i in won.values()}
                row = (answered, left, [i for i, x in enumerate(p) if x not in took] if left else [], [*won.values()], [*took])
            for c, x in zip(out.values(), row, strict=True):
                c.append(x)
        kinds = [pa.bool_(), *[pa.list_(pa.int32())] * 3, gone.type]
        return pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=[*out])

    return run(names, orders, places, gone, given)


def unified_issues(matches: DataFrame, expected: DataFrame, max_missing: float = 0.3, paras: DataFrame | None = None, decisions: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """doc_id, issue of a mapping: places shared by tags of different cells, cells spread over places, too many tags left out. With
    paras (doc_id, place, text, is_cell) places in cells may be shared, and tags outside of tables whose label has two keywords or
    more must share four letters of them with their place. With decisions (doc_id, ord, label, checked) neighbours Oui and Non must
    not both be checked; with pairs (doc_id, value), those of the template, the first Oui or Non must be checked as they say."""
    cell = ["table_index", "row_index", "column_index"]
    shared = duplicate_places(matches, "doc_id", "place", cell)
    if paras is not None:
        shared = shared.join(paras.filter("is_cell").select("doc_id", "place"), ["doc_id", "place"], "left_anti")
    a = shared.select("doc_id", F.lit("duplicate_place").alias("issue"))
    b = split_cells(matches.filter("table_index is not null"), "doc_id", "place", cell).select("doc_id", F.lit("split_cell").alias("issue"))
    left = expected.join(matches.select("doc_id", "tag"), ["doc_id", "tag"], "left_anti").groupBy("doc_id").agg(F.count("*").alias("m"))
    all_ = expected.groupBy("doc_id").agg(F.count("*").alias("n"))
    c = all_.join(left, "doc_id").filter(F.col("m") > max_missing * F.col("n")).select("doc_id", F.lit("missing_tags").alias("issue"))
    out = a.unionByName(b).unionByName(c)
    if paras is not None:
        words = keywords(F.col("label"))
        placed = matches.filter("table_index is null").select("doc_id", "tag", "place").join(expected.select("doc_id", "tag", "label"), ["doc_id", "tag"]).join(paras.select("doc_id", "place", "text"), ["doc_id", "place"])
        out = out.unionByName(placed.filter((F.size(words) >= 2) & (keyword_score(words, F.col("text")) < 4)).select("doc_id", F.lit("unlike_place").alias("issue")))
    if decisions is not None:
        label = F.lower(F.trim("label"))
        w = Window.partitionBy("doc_id").orderBy("ord")
        seen = decisions.withColumn("_l", label).withColumns({"_nl": F.lead("_l").over(w), "_nc": F.lead("checked").over(w)})
        pair = ((F.col("_l") == "oui") & (F.col("_nl") == "non")) | ((F.col("_l") == "non") & (F.col("_nl") == "oui"))
        out = out.unionByName(seen.filter(pair & F.col("checked") & F.col("_nc")).select("doc_id", F.lit("both_checked").alias("issue")))
        if pairs is not None:
            first = lambda word: F.min_by("checked", F.when(F.contains(F.lower("label"), F.lit(word)), F.col("ord")))
            state = decisions.groupBy("doc_id").agg(first("oui").alias("oui"), first("non").alias("non")).filter("oui is not null and non is not null")
            wrong = pairs.join(state, "doc_id").filter("(value and not oui) or (not value and not non)")
            out = out.unionByName(wrong.select("doc_id", F.lit("unlike_template").alias("issue")))
    return out

"""Checkboxes that ordinals leave over, matched by their words."""

from docframe.operators import checkbox

BOXES = "doc long, index int, ord int, checked boolean, label string"


def test_boxes_without_oui_or_non_match_by_words(spark):
    templates = spark.createDataFrame([(1, 0, 0, True, "Oui"), (1, 1, 0, True, "Bonne qualité"), (1, 2, 0, False, "Le candidat seul"), (1, 3, 0, True, "abc"), (2, 0, 0, True, "Bonne qualité")], BOXES)
    targets = spark.createDataFrame([(1, 5, 0, False, "oui"), (1, 6, 0, False, "qualité bonne !"), (1, 7, 0, False, "bonne qualité"), (1, 8, 0, False, "candidat - seul"), (1, 9, 0, False, "abc"), (2, 4, 0, False, "autre")], BOXES)
    got = {tuple(r) for r in checkbox.match_boxes(templates, targets, "doc").drop("template_ord", "target_ord").collect()}
    assert got == {(1, 0, 5, 100, True), (1, 1, 6, 12, True), (1, 2, 8, 12, False)}


def test_looser_score_and_single_use(spark):
    boxes = spark.createDataFrame([(1, 0, 0, True, "lot unique"), (1, 1, 0, False, "unique"), (1, 2, 0, True, "lot")], BOXES)
    target = spark.createDataFrame([(1, 9, 0, False, "Lot unique")], BOXES)
    pairs = lambda **k: {(r["template_index"], r["score"]) for r in checkbox.match_by_score(boxes, target, "doc", checkbox.FIND_SCORE, **k).collect()}
    assert pairs() == {(0, 9), (1, 6)}
    assert pairs(once=True) == {(0, 9)}


def test_words_equal_a_plain_double_loop(spark):
    """A label on a third of all boxes, repeated words, words inside of others, boxes without words, a box without a group."""
    names = ["Lot unique", "lot", "candidat seul", "le candidat-seul, unique", "seul seul seul", "", None, "a b c", "unique unique"]
    labels = [names[0] if i % 3 == 0 else names[(7 * i) % len(names)] for i in range(240)]
    boxes = [(None if i == 5 else i % 4, i, i % 2, i % 5 < 2, x) for i, x in enumerate(labels)]
    fold = lambda x: " ".join("".join(c if c.isalnum() else " " for c in x.lower()).split())
    want, once = set(), {}
    for g, i, o, c, x in boxes[:120]:
        scored = [(-sum(len(w) for w in fold(x).split(" ") if len(w) >= 3 and w in fold(y)), j, p) for h, j, p, _, y in boxes[120:] if g is not None and h == g and x is not None and y is not None]
        if scored and -min(scored)[0] >= checkbox.FIND_SCORE:
            score, j, p = min(scored)
            want.add((g, i, o, j, p, -score, c))
            once.setdefault((g, j, p), (g, i, o, j, p, -score, c))
    template, target = spark.createDataFrame(boxes[:120], BOXES), spark.createDataFrame(boxes[120:], BOXES)
    assert {tuple(r) for r in checkbox.match_by_score(template, target, "doc", checkbox.FIND_SCORE).collect()} == want
    assert {tuple(r) for r in checkbox.match_by_score(template, target, "doc", checkbox.FIND_SCORE, once=True).collect()} == set(once.values())
    assert checkbox.match_by_score(template, target.limit(0), "doc").count() == 0

from collections import Counter

import corpus_pipeline as P
from docframe.llm import quality, simhash
from docframe.llm.common import materialize
from tests.llm.helpers import DOCS, odd_docs
from tests.llm.test_dedup import brute_removal
from tests.llm.test_text import plain_verdicts

TRIM = " \t\r\x0b\x0c"


def plain_quality(rows):
    """(doc_id, text) of the rows that stay, without the lines above their host's limit."""
    docs, texts = {}, {}
    for _, text, host in rows:
        texts.setdefault(host or "", set()).add(text or "")
        for line in {x.lower().strip(TRIM) for x in (text or "").split("\n")} - {""}:
            docs.setdefault((host or "", line), set()).add(text or "")
    common = {k for k, found in docs.items() if len(found) > max(quality.MIN_DOCS, quality.DOC_SHARE * len(texts[k[0]]))}
    out = Counter()
    for i, text, host in rows:
        lines = [x for x in (text or "").split("\n") if (host or "", x.lower().strip(TRIM)) not in common]
        out[i, "\n".join(lines)] += 1
    kept = {v[0] for v in plain_verdicts(rows, quality.MIN_DOCS, quality.DOC_SHARE, quality.MIN_LEFT) if v[7]}
    return Counter({k: n for k, n in out.items() if k[0] in kept})


def plain_near(rows):
    """Ids of the rows with the smallest id of their component."""
    label = simhash.brute_components({i: simhash.fingerprint(t) for i, t in rows})
    return {i for i, top in label.items() if i == top}


def test_stages_on_odd_rows(spark, sf):
    odd = [(60 + i, "many words stand here and each is like no other " + " ".join(f"own{i}x{j}" for j in range(70)), "en", "a", 1) for i in range(3)]
    twin = odd[0][1]
    docs = odd_docs(spark, extra=[*odd, (70, twin, "en", "b", 1), (None, twin, None, None, None), (None, odd[1][1] + " tail", "en", None, 1), (71, twin, "en", "b", 1), (71, twin, "en", "b", 1)])
    docs = docs.withColumnRenamed("lang", "a.b")
    for name, stage in P.STAGES:
        before, columns = docs.collect(), docs.columns
        docs = materialize(stage(spark, docs, sf), name)
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            assert not Counter((r["doc_id"], r["a.b"], r["source"]) for r in after) - Counter((r["doc_id"], r["a.b"], r["source"]) for r in before)
        if name == "quality":
            texts = Counter((r["doc_id"], r["text"]) for r in after)
            assert texts[71, twin] == 2
            assert texts[None, twin] == 1
            assert not any(r["text"].strip() == "" for r in after)
        if name == "exact_dedup":
            assert Counter(r["text"] for r in after) == Counter({t: 1 for t in {r["text"] for r in before}})
            assert [r["doc_id"] for r in after if r["text"] == twin] == [71]  # the largest id; those without one are smaller
        if name == "simhash":
            assert {r["text"] for r in after} <= {r["text"] for r in before}
        if name == "suffix_dedup":
            assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
        if name == "packing":
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
            assert all(len(r["ids"]) == r["length"] for r in after)


def test_stages_on_an_empty_table(spark, sf):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in P.STAGES:
        docs = materialize(stage(spark, docs, sf), name)
        assert docs.count() == 0


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES[:-1]:
        rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
        before = {i: t for i, t, _ in rows}
        docs = materialize(stage(spark, docs, sf), name)
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "quality":
            assert Counter(kept[name].items()) == plain_quality(rows)
        if name == "exact_dedup":
            assert sorted(kept[name].values()) == sorted(set(before.values()))
            assert all(i == max(j for j, t in before.items() if t == text) for i, text in kept[name].items())
        if name == "simhash":
            assert set(kept[name]) == plain_near(before.items())
            assert all(before[i] == t for i, t in kept[name].items())
        if name == "suffix_dedup":
            cut = {r[0] for r in brute_removal([{"doc_id": i, "text": t} for i, t in before.items()]) if r[2] == 0}
            assert all(kept[name][i] == before[i] for i in cut)
            assert set(kept[name]) == set(before)
    assert all(len(r["text"]) == r["n_chars"] for r in docs.collect())
    assert P.run(spark, sf).count() > 0

import hashlib
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
import xxhash

from docframe.llm import suffix_dedup as sd
from docframe.llm.exact_dedup import exact_dedup, keep_first
from docframe.llm.queries import op1_exact_dedup, op2_simhash, op7_suffix_dedup, oracle_sql
from docframe.llm.simhash import brute_components, connected, covering_triples, fingerprint, fingerprint_links, keep_one, simhash_components
from tests.llm.helpers import DOCS, clashing, odd_docs, plain_docs
from tests.oracle import compare


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("change", [lambda d: d, clashing])
def test_exact_dedup_odd_rows(spark, keep, change):
    docs = change(odd_docs(spark))
    rows = docs.select("doc_id", "text").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    out = exact_dedup(docs, keep=keep).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r["doc_id"] for r in rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = Counter()
    for r in out:
        ids = [i for i in by_sha[r["text_sha256"]] if i is not None]
        assert r["group_size"] == len(by_sha[r["text_sha256"]])
        assert r["keep_id"] == ((min if keep == "smallest" else max)(ids) if ids else None)
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1}
    assert keep_first(docs, exact_dedup(docs, keep=keep)).count() == len(groups)


def test_exact_dedup_hot_group_over_partitions(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('t', id % 700)) as text")
    out = exact_dedup(docs.repartition(7), keep="largest").toPandas()
    hot = out[out.group_size == 1000]
    assert set(hot.keep_id) == {2997}
    assert hot.kept.sum() == 1
    assert len(out) == 3000


def test_exact_dedup_empty(spark):
    assert exact_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_op1_equals_sql(spark, sf):
    compare(op1_exact_dedup(spark, sf), oracle_sql()["op1_exact_dedup"], sf)


def plain_fingerprint(text):
    import re

    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def test_fingerprints(spark):
    for r in odd_docs(spark).collect():
        if len(r["text"] or "") < 20_000:
            assert fingerprint(r["text"]) == plain_fingerprint(r["text"])


def test_triples_cover_all_quadruples():
    triples = [set(t) for t in covering_triples()]
    assert len(triples) == 20
    assert all(any(t <= set(q) for t in triples) for q in combinations(range(8), 4))


@pytest.mark.parametrize("tile", [3, 8192])
def test_links_find_all_near_fingerprints(spark, tile):
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(40)]
    values = {i: b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, 6))) for i, b in enumerate(base * 12)}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    links = [(r["a"], r["b"]) for r in fingerprint_links(spark.createDataFrame([(signed(v),) for v in values.values()], "fp long"), tile).collect()]
    found = brute_components({signed(v) & (1 << 64) - 1: v for v in values.values()})
    parent = {v: v for v in values.values()}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        a, b = a & (1 << 64) - 1, b & (1 << 64) - 1
        assert (a ^ b).bit_count() <= 4
        parent[max(top(a), top(b))] = min(top(a), top(b))
    assert {v: top(v) for v in parent} == found


@pytest.mark.parametrize("change", [lambda d: d, clashing])
def test_components_odd_rows(spark, change):
    docs = change(odd_docs(spark))
    rows = docs.select("doc_id", "text").collect()
    prints = {r["doc_id"]: fingerprint(r["text"]) for r in rows if r["doc_id"] is not None}
    want = brute_components(prints)
    out = simhash_components(docs)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"]]
            assert int(r["fingerprint"], 16) == prints[r["doc_id"]]
    kept = Counter(r["doc_id"] for r in keep_one(docs, out).collect())
    assert kept == Counter({*want.values(), None})  # the text of the row without an id is like no other
    assert simhash_components(spark.createDataFrame([], DOCS)).count() == 0


def test_keep_one_of_rows_without_ids(spark):
    say = lambda k: " ".join(f"w{k}x{j}" for j in range(200))
    rows = [(None, say(1)), (5, say(1)), (7, say(1) + " end"), (None, say(2)), (None, say(2) + " end"), (None, say(2)), (8, say(3)), (8, say(3))]
    docs = clashing(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(3))
    out = simhash_components(docs)
    assert out.count() == len(rows)
    kept = keep_one(docs, out)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"][:6]) for r in kept.collect()), key=str)
    assert got == [(5, say(1)[:6]), (8, say(3)[:6]), (None, say(2)[:6])]


def test_op2_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute_components({r["doc_id"]: fingerprint(r["text"]) for r in rows})
    assert {r["doc_id"]: r["component_id"] for r in op2_simhash(spark, sf).collect()} == want


def brute_removal(rows):
    """(n_bytes, n_removed, n_spans, sha) by counting every window."""
    counts = Counter()
    for r in rows:
        b = (r["text"] or "").encode()
        counts.update(b[i : i + sd.WINDOW] for i in range(len(b) - sd.WINDOW + 1))
    out = []
    for r in rows:
        b = (r["text"] or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - sd.WINDOW + 1):
            if counts[b[i : i + sd.WINDOW]] > 1:
                gone[i : i + sd.WINDOW] = b"\1" * sd.WINDOW
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((r["doc_id"], len(b), sum(gone), sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("make", [odd_docs, plain_docs, lambda s: clashing(plain_docs(s, 40, 5))])
def test_suffix_dedup_against_brute_force(spark, make):
    docs = make(spark)
    want = brute_removal(docs.select("doc_id", "text").collect())
    assert sorted((tuple(r) for r in sd.suffix_dedup(docs).collect()), key=str) == want


def test_suffix_dedup_of_repeated_and_null_id_rows(spark):
    rnd = random.Random(3)
    say = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    a, b, c = say(300), say(450), say(700)
    rows = [(1, a)] * 3 + [(None, b)] * 4 + [(2, c), (3, say(100) + c[50:400]), (None, say(250)), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(3)
    got = sorted((tuple(r) for r in sd.suffix_dedup(docs).collect()), key=str)
    assert got == brute_removal(docs.select("doc_id", "text").collect())


def test_suffix_dedup_of_rows_that_share_an_id(spark):
    rnd = random.Random(9)
    say = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    a, b = say(260), say(300)
    rows = [(1, say(90) + a), (1, b + say(40)), (-5, a + say(30)), (-5, say(50)), (2, say(7) + b), (3, say(400))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(3)
    assert sorted((tuple(r) for r in sd.suffix_dedup(docs).collect()), key=str) == brute_removal(docs.select("doc_id", "text").collect())


@pytest.mark.parametrize("hot", [40, 700])
def test_hot_anchors_are_dealt_out(spark, hot):
    rnd = random.Random(5)
    say = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    passages = [say(n) for n in (210, 230, 330)]
    rows = [(i, say(rnd.randint(0, 150)) + passages[i % 3][rnd.randint(0, 20) :] + say(rnd.randint(0, 150))) for i in range(120)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(4)
    assert sorted((tuple(r) for r in sd.suffix_dedup(docs, hot=hot).collect()), key=str) == brute_removal(docs.select("doc_id", "text").collect())


def test_suffix_sort_in_small_rounds(spark, monkeypatch):
    rnd = random.Random(2)
    text = bytes(rnd.choice(b"ab") for _ in range(400)) * 3
    import numpy as np

    data = np.frombuffer(text + b"zz" * 150 + text[:500], np.uint8)
    at = np.arange(len(data) - sd.WINDOW + 1)
    windows = [bytes(data[i : i + sd.WINDOW]) for i in at]
    counts = Counter(windows)
    want = [counts[w] > 1 for w in windows]
    assert sd.repeated_suffixes(data, at).tolist() == want
    assert all(sd.repeated_in_parts(data, at, sd.WINDOW, most).tolist() == want for most in (10, 100, 1000))


def test_colliding_hashes_add_nothing(monkeypatch):
    import numpy as np

    monkeypatch.setattr(sd.PrefixHashes, "of", lambda self, start, length: np.zeros(len(start), np.uint64))
    rnd = random.Random(4)
    data = np.frombuffer(bytes(rnd.choice(b"abc") for _ in range(600)), np.uint8)
    at = np.arange(len(data) - sd.WINDOW + 1)
    assert not sd.repeated_suffixes(data, at).any()


def test_remove_repeated_keeps_columns(spark):
    docs = plain_docs(spark, 60)
    out = sd.remove_repeated(docs)
    assert out.columns == docs.columns
    want = {r[0]: r[4] for r in brute_removal(docs.select("doc_id", "text").collect())}
    clean = sd.remove_repeated(docs, figures=True).filter("n_removed = 0").collect()
    assert all(hashlib.sha256(r["text"].encode()).hexdigest() == want[r["doc_id"]] for r in clean)
    assert sd.suffix_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_op7_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in op7_suffix_dedup(spark, sf).collect()), key=str) == brute_removal(rows)


def test_connected_raises_where_rounds_run_out(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    got = {r["node"]: r["label"] for r in connected(chain).collect()}
    assert got == dict.fromkeys(range(301), 0)
    with pytest.raises(RuntimeError):
        connected(chain, max_rounds=2)

"""SimHash, hard negatives and the source audit against plain versions, on odd and ordinary rows."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.llm import divergence, negatives, simhash


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def fingerprints_and_components(df):
    return sorted((r.doc_id, r.bits % 2**64, r.component_id) for r in df.collect())


def test_simhash(documents, corpus):
    assert fingerprints_and_components(simhash.near_duplicates(documents(corpus))) == sorted(brute.simhash(corpus))


def test_simhash_of_odd_rows(spark, documents):
    odd = documents([(None, "a b c"), (3, "A b\tc"), (3, "other words here"), (7, "a b c"), (8, None), (9, " "), (2, "one")])
    wide = odd.withColumn("bits", odd.text).withColumn("node", odd.doc_id).withColumn("component_id", odd.doc_id)
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(wide).collect()]
    assert sorted(got, key=str) == sorted([(None, 3), (3, 3), (3, 3), (7, 3), (8, 8), (9, 8), (2, 2)], key=str)
    nameless = simhash.near_duplicates(documents([(None, "a b c"), (None, "a b c")])).collect()
    assert [(r.doc_id, r.component_id) for r in nameless] == [(None, None)] * 2
    assert simhash.near_duplicates(documents([(1, "x")]).limit(0)).collect() == []


def crowded(seed, n):
    """Fingerprints of which many are within a few bits of others."""
    r = np.random.default_rng(seed)
    centres = r.integers(0, 2**64, 12, np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (n, 4)).astype(np.uint64) * r.integers(0, 2, (n, 4)).astype(np.uint64), axis=1)
    return np.unique(np.concatenate((r.choice(centres, n) ^ flips, np.array([0, 1, 2**63, 2**64 - 1], np.uint64))))


@pytest.mark.parametrize("front", [3, simhash.FRONT])
@pytest.mark.parametrize("budget", [0, 1, 3])
def test_trie_join_finds_every_pair(monkeypatch, budget, front):
    monkeypatch.setattr(simhash, "FRONT", front)
    v = crowded(1, 120)
    wanted = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if int(v[i] ^ v[j]).bit_count() <= budget}
    whole = simhash.Trie(v, 0)
    found = [p for x, y in simhash.linked(whole, whole, 0, True, budget) for p in zip(x.tolist(), y.tolist())]
    assert set(found) == wanted and len(found) == len(wanted)
    # The halves under the first bit, and what lies across.
    low, high = v[v < 2**63], v[v >= 2**63]
    across = simhash.linked(simhash.Trie(low, 1), simhash.Trie(high, 1), 1, False, budget)
    found = {(x, y + len(low)) for a, b in across for x, y in zip(a.tolist(), b.tolist())}
    assert found == {(i, j) for i, j in wanted if i < len(low) <= j}


@pytest.mark.parametrize("most", [4, simhash.SUBTREE])
def test_links_connect_the_same_fingerprints_however_the_trie_is_split(spark, most):
    v = crowded(2, 60)
    rows = [(int(x),) for x in v.view(np.int64)]
    edges = simhash.links(spark.createDataFrame(rows, "bits long").repartition(3), most=most).collect()
    assert all((e.a ^ e.b) % 2**64 for e in edges)
    group = brute.Groups([x for (x,) in rows])
    for e in edges:
        group.join(e.a, e.b)
    wanted = brute.Groups([x for (x,) in rows])
    for x in rows:
        for y in rows:
            if ((x[0] ^ y[0]) % 2**64).bit_count() <= 3:
                wanted.join(x[0], y[0])
    assert {x: group.root(x) for (x,) in rows} == {x: wanted.root(x) for (x,) in rows}


VECTORS = "id long, label long, vector array<long>, extra string"


def vectors(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x") for r in rows], VECTORS).repartition(partitions)


def mined(df, **how):
    found = negatives.hard_negatives(df, F.col("id") % 5 == 0, **how)
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found.collect())


def some_vectors(seed, n, labels=3, width=6, reach=4, ties=True):
    """Vectors around a common direction; few different components, so that many scores are equal."""
    r = random.Random(seed)
    rows = [(i, r.randrange(labels), [reach + r.randrange(-reach, reach) for _ in range(width)]) for i in range(n)]
    return rows + [(n + i, rows[i % 3][1] + i % 2, rows[i % 3][2]) for i in range(10 * ties)]


@pytest.mark.parametrize("sizes", [(4, 3, 2), (negatives.BLOCK, negatives.ANCHORS, negatives.KEPT)])
def test_hard_negatives(spark, monkeypatch, sizes):
    for name, size in zip(("BLOCK", "ANCHORS", "KEPT"), sizes, strict=True):
        monkeypatch.setattr(negatives, name, size)
    rows = some_vectors(1, 70)
    got = mined(vectors(spark, rows))
    assert got == brute.hard_negatives(rows) and got
    got = mined(vectors(spark, rows), positives=2, negatives=7, low=80, high=100)
    assert got == brute.hard_negatives(rows, 2, 7, 80, 100) and got


def test_hard_negatives_of_odd_rows(spark):
    rows = some_vectors(2, 30, ties=False)
    odd = [(None, 1, [1, 2]), (35, None, [1, 2]), (40, 1, None), (45, 1, [1, None]), (50, 1, []), (55, 9, [3, 4]), (60, 9, [3, 4, 0, 0, 0, 0, 0, 7])]
    padded = [(i, label, v + [0] * (8 - len(v))) for i, label, v in rows + odd[4:]]
    assert mined(vectors(spark, rows + odd)) == brute.hard_negatives(padded)
    # Rows of one id are rows of their own.
    twice = [(5, 1, [4, 1]), (5, 1, [4, 1]), (7, 2, [3, 1]), (7, 2, [3, 1])]
    assert mined(vectors(spark, twice)) == sorted([(5, 5, 1, 7, 17, 13), (5, 5, 2, 7, 17, 13)] * 2)
    assert mined(vectors(spark, rows).limit(0)) == []
    assert mined(vectors(spark, [(5, 1, [1])])) == []


def test_quantized(spark):
    rows = [([0.5, -0.001, 0.0],), ([1.0, None],), ([float("nan")],), ([float("-inf")],), (None,), ([],)]
    got = spark.createDataFrame(rows, "v array<float>").select(negatives.quantized(F.col("v"))).collect()
    assert [r[0] for r in got] == [[128, -1, 0], None, None, None, None, []]


@pytest.mark.parametrize("reach", [100, 10**6, 2**28])
def test_products_are_exact_whatever_the_fields_width(reach):
    r = np.random.default_rng(3)
    of_a, of_c = r.integers(-reach, reach, (5, 16)), r.integers(-reach, reach, (16, 300))
    most = int(np.abs(of_a).sum(axis=1).max())
    packed = negatives.Packed(of_c, most)
    for anchor in of_a:
        assert np.array_equal(packed.products(anchor.tolist()), anchor @ of_c)
    with pytest.raises(ValueError):
        negatives.Packed(of_c * 2**30, most * 2**30)


def places(n=400):
    r = random.Random(8)
    words = ["w%s" % chr(97 + i % 26) * (1 + i // 26) for i in range(60)] + ["Été", "ÉTÉ", "naïve", "日本", "zz"]
    rows = []
    for i in range(n):
        lang, source = r.choice(["en", "en", "de"]), f"s{min(r.randrange(6), r.randrange(6))}"
        text = " ".join(words[min(r.randrange(65), r.randrange(65))] for _ in range(r.randrange(12)))
        rows.append((text + r.choice(["", " 12-x", ", Don't", "_y"]), lang, source))
    rows += [(None, "en", "s0"), ("", "en", "empty"), ("wa wb", None, None), ("wa", "xx", "one"), ("wb " * 3000, "xx", "two")]
    return rows + [("wa wc", "one source", "alone")] * 11


def audited(spark, rows, **how):
    table = spark.createDataFrame([(i % 7, *r, i) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term long")
    return sorted((r.lang, r.source, r.part, r["rank"], r["item"], r.value) for r in divergence.audit(table.repartition(5), **how).collect())


@pytest.mark.parametrize("sizes", [(900, 3), (divergence.BLOCK, divergence.SLICE)])
def test_source_audit(spark, monkeypatch, sizes):
    monkeypatch.setattr(divergence.index, "__defaults__", (divergence.LEAST_DOCUMENTS, *sizes))
    rows = places()
    got = audited(spark, rows)
    assert got == brute.audit(rows)
    assert {r[2] for r in got} == {"pair", "term"} and ("xx", "one", "pair", 1, "two", 0) in got


def test_source_audit_of_no_rows(spark):
    assert audited(spark, []) == []


@pytest.mark.parametrize("held", [1, 4, divergence.HELD])
def test_runs_are_merged_in_order(held):
    def part(key, sources, terms, *numbers):
        return divergence.Slice(key, terms[0], sources, pa.array(terms), *map(np.array, numbers))

    one = part("k", ["s", "t"], ["a", "c", "d"], [1, 2, 3], [1, 2, 1], [0, 0, 1, 1], [5, 1, 1, 2])
    two = part("k", ["t"], ["b", "d"], [1, 1], [1, 1], [0, 0], [4, 6])
    late = part("k", ["s"], ["e"], [1], [1], [0], [9])
    other = part("l", ["s"], ["a"], [1], [1], [0], [1])
    got = []
    for f in divergence.merged(iter([one, two, late, other]), held):
        ends = [*f.starts[1:], len(f.counts)]
        for k, term in enumerate(f.terms.to_pylist()):
            at = slice(f.starts[k], ends[k])
            got.append((f.key, term, f.documents[k], dict(zip(f.sources[at].to_pylist(), f.counts[at], strict=True))))
    assert got == [
        ("k", "a", 1, {"s": 5}), ("k", "b", 1, {"t": 4}), ("k", "c", 2, {"s": 1, "t": 1}),
        ("k", "d", 4, {"t": 8}), ("k", "e", 1, {"s": 9}), ("l", "a", 1, {"s": 1}),
    ]

"""Operators that learn, and the layout of pages."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import html_text, lm_score, pii, quality, toxicity

LABELS = "doc_id long, quality int, toxic int"


def plain_segments(model, words):
    """Maximal scoring segments by their definition, slowly (Ruzzo and Tompa)."""
    values = [model.odds.get(w, model.rest) for w in words]

    def best(a, b):
        top = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += values[j]
                if total > 1e-12 and (top is None or total > top[0] + 1e-9):
                    top = (total, i, j + 1)
        return top

    def within(a, b):
        found = best(a, b)
        return [] if found is None else within(a, found[1]) + [found] + within(found[2], b)

    return within(0, len(values))


def test_segments_are_the_maximal_ones():
    model = toxicity.Model({"a": 3.1, "b": 1.7}, rest=-1.03)
    r = random.Random(1)
    for _ in range(200):
        words = r.choices(["a", "b", "x"], [1, 1, 3], k=r.randrange(0, 25))
        got, want = model.segments(words), plain_segments(model, words)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert np.allclose([s for s, _, _ in got], [s for s, _, _ in want])


def test_many_segments_take_linear_time():
    model = toxicity.Model({"a": 1.0}, rest=-2.0)
    assert len(model.segments(["a", "x"] * 200_000)) == 200_000


@pytest.fixture(scope="module")
def toxic_docs():
    r = random.Random(2)
    words = ["".join(r.choices("abcdefgh", k=5)) for _ in range(200)]
    rows = []
    for i in range(600):
        text = r.choices(words, k=r.randrange(5, 300))
        if i % 6 == 0:
            for _ in range(3):
                text.insert(r.randrange(len(text)), r.choice(["vile", "nasty", "foul"]))
        rows.append((i, " ".join(text)))
    return rows


def test_toxicity_on_held_out_rows(spark, documents, toxic_docs):
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i, _ in toxic_docs] + [(9999, 1, 1)], LABELS)
    extra = [(None, "vile nasty foul"), (5000, None), (5001, "")]
    got = toxicity.toxicity(documents(toxic_docs + extra), labels).collect()
    assert len(got) == 603
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert held and all(r.predicted == int(r.doc_id % 6 == 0) for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].predicted == 1 and by_id[5000].predicted == by_id[5001].predicted == 0
    assert all(p.end > p.start for p in by_id[0].passages)


def test_scores_beside_columns_of_any_name(spark, documents):
    docs = documents([(1, "a b"), (2, None)]).withColumns(
        {"toxic_score": F.lit("x"), "Toxic_Passages": F.lit(2), "two words": F.lit(3), "dot.ted": F.lit(4), "a,b:c": F.lit(5)}
    )
    got = toxicity.scored(docs, toxicity.Model({"a": 3.0}))
    assert got.columns == [*docs.columns, "_toxic_score", "_toxic_passages"]
    assert sorted((r.doc_id, r.toxic_score, r["dot.ted"]) for r in got.collect()) == [(1, "x", 4), (2, "x", 4)]


def test_toxicity_without_labels_or_rows(spark, documents, toxic_docs):
    none = spark.createDataFrame([(None, None, None), (1, None, None)], LABELS)
    assert all(r.predicted == 0 for r in toxicity.toxicity(documents(toxic_docs[:5]), none).collect())
    assert toxicity.toxicity(documents(toxic_docs[:1]).limit(0), none).collect() == []


def test_held_out_rows_do_not_train(spark, documents, toxic_docs):
    fold = spark.range(600).select("id", toxicity.held_out(F.col("id")).alias("h")).where("h")
    held = {r.id for r in fold.collect()}
    a = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i, _ in toxic_docs], LABELS)
    b = a.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    docs = documents(toxic_docs)
    assert 150 < len(held) < 250
    assert toxicity.fit(docs, a) == toxicity.fit(docs, b)


def brute_binomial(k, n, p):
    return math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))


def test_exact_binomial_chance(spark):
    chance = lambda k, n, p: spark.range(1).select(quality.chance_of_at_most(F.lit(k).cast("long"), F.lit(n), p)).first()[0]
    assert chance(0, 10, 0.5) == pytest.approx(0.5**10)
    assert chance(10, 10, 0.5) == 1.0
    assert chance(2, 5, 0.3) == pytest.approx(0.83692)
    assert chance(100, 100_000, 0.02) == pytest.approx(0.0, abs=1e-12)
    assert chance(1990, 100_000, 0.02) == pytest.approx(sum(brute_binomial(k, 100_000, 0.02) for k in range(1991)), rel=1e-9)


def test_levels_stop_before_the_first_that_fails(spark):
    rows = [([0, 0, 0, 50, 0, 0], 1000, 3), ([0] * 6, 10, 0), ([0] * 6, 1000, 6), ([0] * 6, 0, 0), ([900, 0, 0, 0, 0, 0], 1000, 0)]
    table = spark.createDataFrame(rows, "rejected array<long>, n long, wanted int")
    got = table.select(quality.certified_levels(F.col("rejected"), F.col("n"), 0.05, 0.02).alias("levels"), "wanted").collect()
    assert all(r.levels == r.wanted for r in got)


def test_any_number_of_strata(spark, documents):
    """300 languages with labels, among them the empty one; languages without labels reject nothing."""
    text = " ".join(f"v{i}%%%" for i in range(60))
    rows = [(k * 10 + i, text, f"l{k}" if k else "") for k in range(300) for i in range(3)]
    rows += [(10_000 + i, " ".join(f"v{j}" for j in range(60)), "") for i in range(1200)]
    rows += [(20_000, text, "xx"), (20_001, text, None), (20_002, text, "")]
    labels = spark.createDataFrame([(d, 1, 0) for d, _, _ in rows[:2100] if d % 10 < 2 or d >= 10_000], LABELS)
    got = {x.doc_id: (x.kept, x.certified_levels) for x in quality.judged(documents(rows), labels).collect()}
    assert got[20_002] == (False, 6) and got[20_000] == got[20_001] == (True, 0)
    assert all(got[k * 10] == (True, 0) for k in range(1, 300))


def test_quality_verdict(spark, documents):
    r = random.Random(3)
    rows = []
    for i in range(700):
        words = [f"v{r.randrange(3000)}" for _ in range(60)]
        rows.append((i, " ".join(w + ("%%%" if i % 7 == 0 else "") for w in words), "en"))
    rows += [(1000, rows[0][1], None), (1001, None, "en"), (None, rows[1][1], "en")]
    labels = spark.createDataFrame([(i, int(i % 7 != 0), 0) for i in range(700)], LABELS)
    got = {x.doc_id: x.kept for x in quality.judged(documents(rows), labels).collect()}
    assert all(got[i] == (i % 7 != 0) for i in range(700))
    # No labels, no cutoff: the stratum of null rejects by the base rules only.
    assert got[1000] and not got[1001] and got[None]


def test_added_spans_and_empty_models(documents):
    r = random.Random(4)
    rows = []
    for i in range(120):
        key = "".join(r.choices("0123456789abcdef", k=40))
        rows.append((i, f"Some words token = \"{key}\" end" if i % 4 else f"plain words {i} here"))
    docs = documents(rows)
    got = {x.doc_id: x.spans for x in pii.spans(docs).collect()}
    assert all(("secret:20:60" in got[i].split(",")) if i % 4 else (got[i] == "") for i in range(120))
    assert pii.fit([]) is None
    # What the precise rules label is found however little there is of it, and however long.
    key = "ab1" * 100
    few = [(1, "write to jo (at) home (dot) org"), (2, f"token = {key} end"), (3, f"a{'b' * 90} (at) home.org"), (4, key)]
    got = {x.doc_id: x.spans for x in pii.spans(documents(few)).collect()}
    assert got == {1: "mail_words:9:31", 2: "secret:8:308", 3: "mail_words:0:105", 4: ""}
    redacted = {x.doc_id: x.text for x in pii.redacted(docs).collect()}
    assert redacted[1] == 'Some words token = "[SECRET]" end'


def test_log_probabilities_sum_to_one_and_match_a_plain_version():
    net = lm_score.initial()
    r = np.random.default_rng(5)
    ids = np.concatenate(([lm_score.PAD] * 2, r.integers(0, lm_score.VOCABULARY, 50), [lm_score.PAD] * 2))
    got = lm_score.log_probabilities(net, ids, np.arange(2, 52))
    for k in (0, 17, 49):
        at = k + 2
        h = net["hidden"].copy()
        for table, d in zip(net["context"], (-2, -1, 1, 2), strict=True):
            h = h + table[ids[at + d]]
        h = np.tanh(h)
        a = np.exp(net["class"] @ h + net["class_bias"])
        b = np.exp(net["member"] @ h + net["member_bias"])
        p = (a / a.sum())[:, None] * b / b.sum(axis=1, keepdims=True)
        assert p.sum() == pytest.approx(1, abs=1e-4)
        assert got[k] == pytest.approx(np.log(p[divmod(ids[at], lm_score.CLASSES)]), abs=1e-4)


def test_language_model_prefers_order(spark, documents):
    r = random.Random(6)
    cycle = [f"t{i}" for i in range(12)]
    rows = []
    for i in range(300):
        at = r.randrange(12)
        rows.append((i, " ".join(cycle[(at + k) % 12] for k in range(100))))
    shuffled = [(1000 + i, " ".join(r.sample(t.split(), 100))) for i, t in rows[:20]]
    docs = documents(rows)
    net, frequent = lm_score.train(docs)
    got = {x.doc_id: x for x in lm_score.scored(documents(rows[:20] + shuffled + [(2005, None), (2006, "")]), net, frequent).collect()}
    assert all(got[i].mean_log_likelihood > got[1000 + i].mean_log_likelihood + 0.2 for i in range(20))
    for i in (2005, 2006):
        assert got[i].n_tokens == 0 and got[i].log_likelihood == 0 and got[i].mean_log_likelihood is None
    assert lm_score.pseudo_likelihood(docs.limit(0)).collect() == []


def test_a_rare_word_scores_by_its_share_of_its_bucket(documents):
    """Words of one bucket are told apart, also from words that the corpus does not have."""
    bucket = lm_score.bucket_key(b"real") % lm_score.VOCABULARY
    same = (w for w in (f"x{i}" for i in range(9999)) if lm_score.bucket_key(w.encode()) % lm_score.VOCABULARY == bucket)
    once, never = next(same), next(same)
    often = [f"t{i}" for i in range(lm_score.FREQUENT)]
    rows = [(i, " ".join(often)) for i in range(9)] + [(20 + i, "real") for i in range(7)] + [(30, once)]
    known = lm_score.vocabulary(documents(rows))
    assert known.tokens == {bucket: 8} and known.rest.count() == 2
    asked = [(1, "real"), (2, once), (3, never), (None, "real"), (None, once)]
    got = [(x.doc_id, x.log_likelihood) for x in lm_score.scored(documents(asked), lm_score.initial(), known).collect()]
    one = dict(got)
    assert one[1] - one[2] == pytest.approx(np.log(7), abs=1e-4)
    assert one[2] == pytest.approx(one[3], abs=1e-4)
    assert sorted(v for d, v in got if d is None) == pytest.approx([one[2], one[1]], abs=1e-4)
    # A bucket's shares and that of unseen words sum to 1: 7, 1 and 1 of 9.
    ids = np.array([lm_score.PAD] * 2 + [bucket] + [lm_score.PAD] * 2)
    inner = lm_score.log_probabilities(lm_score.initial(), ids, np.array([2]))[0]
    assert one[1] == pytest.approx(inner + np.log(7 / 9), abs=1e-4)


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<p>a<p>b", "a\n\nb"),
        ("a<br>b<br/><br>c", "a\nb\n\nc"),
        ("<div>a</div><div> b  c </div>d", "a\nb c\nd"),
        ("x<b>y</b> <i>z</i>!", "xy z!"),
        ("<title>t</title><script>if (a<b) '</p>'</script><style>p{}</style><p hidden>h</p>v", "v"),
        ("<div style='color:red; display : NONE'>h<p>i</p></div><span style='visibility:hidden'>j</span>v", "v"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
        ("<ol start=9><li>a<li><p>b</p><p>c</p></ol>e", "9. a\n10. b\n\n    c\n\ne"),
        (
            "<table><tr><th>k<th>long one<tr><td>wide cell<td>v</table>after",
            "k         | long one\nwide cell | v\n\nafter",
        ),
        ("<td>a</td>&lt;b&gt; &amp;amp; &eacute;", "a<b> &amp; é"),
        ("<pre>  a\n   b</pre>c", "  a\n   b\n\nc"),
        ("a<!-- <p>x</p> -->b<!doctype html>c</div></p>", "abc"),
        ("a < b <3 <", "a < b <3 <"),
        ("<!-- open <p>a", ""),
        ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n  b\nc\n  d"),
        ("<p>a<table><tr><td>b<p>c</table>", "a\n\nb\n\nc"),
    ],
)
def test_visible_text(page, text):
    assert html_text.visible_text(page) == text


def test_any_markup_is_read():
    r = random.Random(7)
    bits = ["<p>", "</p>", "<table>", "<tr>", "<td>", "</table>", "<li>", "</ul>", "<ul>", "x ", "<b", "&#x;", "<!--", "-->",
            "<pre>", "</pre>", "<div hidden>", "</div>", "<script>", "</script>", "<br>", "'", '"', ">", "<ol>", "</td>"]
    for _ in range(3000):
        html_text.visible_text("".join(r.choices(bits, k=r.randrange(40))))
    assert html_text.visible_text("<div>" * 50_000 + "deep") == "deep"
    hidden = "<script>x()</script><p hidden>h<b>i</b></p><style>p{}</style>v<div hidden>" + "<i>" * 9_000 + "x" + "</i>" * 9_000 + "</div>w"
    assert html_text.visible_text("<div>" * 20_000 + hidden) == "vw"


def test_pages(spark):
    df = spark.createDataFrame([(1, "u", "<p>a"), (2, None, None), (None, "u", "")], "page_id long, url string, html string")
    got = sorted((str(r.page_id), r.text) for r in html_text.extracted(df.withColumn("text", F.lit("clash"))).collect())
    assert got == [("1", "a"), ("2", None), ("None", "")]
    assert html_text.extracted(df.limit(0)).collect() == []

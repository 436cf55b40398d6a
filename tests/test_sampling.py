import hashlib
from collections import Counter

import pytest
from fixtures import action, actions, rows

from footfall.operators import sampling as P
from footfall.operators.sessions import session_features


def make(spark, per_hour):
    """{(day, hour offset): sessions}"""
    base = [
        action(f"s{d}-{h}-{i}", h * 3600 + i, day=d, click_category_id=i, search_keyword=f"k{i % 3}")
        for (d, h), n in per_hour.items()
        for i in range(n)
    ]
    acts = actions(spark, base)
    return acts, session_features(acts)


SHAPE = {(0, 0): 30, (0, 1): 10, (1, 2): 5, (1, 3): 3, (1, 4): 1}


def expected_quota(shape, n):
    days = {d for d, _ in shape}
    out = {}
    for (d, h), count in shape.items():
        day = sum(c for (d2, _), c in shape.items() if d2 == d)
        out[d, h] = min(count * (n // len(days)) // day, count)
    return out


@pytest.mark.parametrize("n", [1, 2, 10, 21, 1000])
def test_sample_follows_quota_and_digest_order(spark, n):
    acts, sess = make(spark, SHAPE)
    got = {r["session_id"] for r in P.sample_sessions(sess, n, seed=5).collect()}
    quota = expected_quota(SHAPE, n)
    wanted = set()
    for (d, h), q in quota.items():
        ids = [f"s{d}-{h}-{i}" for i in range(SHAPE[d, h])]
        wanted |= set(sorted(ids, key=lambda s: hashlib.md5(f"5{s}".encode()).hexdigest())[:q])
    assert got == wanted
    assert len(got) <= n


def test_quota_table(spark):
    _, sess = make(spark, SHAPE)
    got = [r["quota"] for r in P.sample_quota(P.sessions_per_hour(sess), 20).orderBy("date", "hour").collect()]
    assert got == [expected_quota(SHAPE, 20)[k] for k in sorted(SHAPE)]


def test_other_seed_other_sample(spark):
    _, sess = make(spark, {(0, 0): 60})
    a, b = (rows(P.sample_sessions(sess, 10, seed)) for seed in (1, 2))
    assert len(a) == len(b) == 10 and a != b
    assert a == rows(P.sample_sessions(sess, 10, 1))


def test_nothing_to_sample(spark):
    acts, sess = make(spark, {(0, 0): 1})
    none = sess.where("false")
    assert P.sample_sessions(none).collect() == []
    assert P.sampled_session_records(P.sample_sessions(none), acts).collect() == []


def test_more_days_than_samples(spark):
    _, sess = make(spark, {(d, 0): 4 for d in range(5)})
    assert P.sample_sessions(sess, 4).collect() == []


def test_records(spark):
    acts = actions(
        spark,
        [action("a", 0, search_keyword="x"), action("a", 1, click_category_id=12),
         action("a", 2, click_category_id=2), action("a", 3, click_category_id=12), action("b", 0)],
    )
    got = P.sampled_session_records(session_features(acts), acts)
    assert [(r[0], r[2], r[3]) for r in sorted(got.collect())] == [("a", "x", "2,12"), ("b", "", "")]


def test_sessions_per_hour(spark):
    _, sess = make(spark, SHAPE)
    got = Counter({(r["date"].day, int(r["hour"])): r["hour_count"] for r in P.sessions_per_hour(sess).collect()})
    assert got == Counter({(1 + d, 9 + h): n for (d, h), n in SHAPE.items()})

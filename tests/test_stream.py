import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta, timezone

import pytest
from fixtures import clicks, rows
from pyspark.errors import StreamingQueryException

from footfall.operators import ads as A
from footfall.sources import ad_log as L
from footfall.streaming import ad_stream as S

ONCE = {"availableNow": True}
START = datetime(2024, 3, 1, tzinfo=timezone.utc)


def log_line(minute, province, city, user, ad):
    return f"{int((START + timedelta(minutes=minute)).timestamp() * 1000)} {province} {city} {user} {ad}"


def some_batches(seed=1, batches=4, size=60):
    r = random.Random(seed)
    return [
        [
            (b * 600 + r.randrange(600), f"p{r.randrange(2)}", f"c{r.randrange(2)}",
             0 if r.random() < 0.4 else r.randrange(6), r.randrange(3))
            for _ in range(size)
        ]
        for b in range(batches)
    ]


def land(folder, number, events, extra=()):
    folder.mkdir(exist_ok=True)
    lines = [log_line(*e) for e in events] + list(extra)
    (folder / f"part-{number}.txt").write_text("\n".join(lines) + "\n")


def replay(spark, tmp_path, batches, start):
    tables = S.AdTables(str(tmp_path / "tables"))
    for number, events in enumerate(batches):
        land(tmp_path / "log", number, events)
        running = start(L.file_lines(spark, str(tmp_path / "log")), tables, str(tmp_path / "checkpoint"))
        running.awaitTermination()
    return tables


def expected(batches, threshold):
    """The rules in plain Python: a blacklisted user is out from the next batch on."""
    black, daily, stat = set(), Counter(), Counter()
    for events in batches:
        kept = [e for e in events if e[3] not in black]
        for minute, province, city, user, ad in kept:
            day = (START + timedelta(minutes=minute)).date()
            daily[day, user, ad] += 1
            stat[day, province, city, ad] += 1
        black |= {u for (_, u, _), n in daily.items() if n >= threshold}
    top = defaultdict(Counter)
    for (day, province, _, ad), n in stat.items():
        top[day, province][ad] += n
    best = sorted(
        (day, province, ad, n)
        for (day, province), counts in top.items()
        for ad, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:2]
    )
    flat = lambda c: sorted((*k, v) for k, v in c.items())
    return sorted((u,) for u in black), flat(daily), flat(stat), best


def test_statistics_follow_the_rules_batch_by_batch(spark, tmp_path):
    batches = some_batches()
    tables = replay(
        spark, tmp_path, batches,
        lambda lines, t, c: S.start_statistics(lines, t, c, threshold=9, top_n=2, forget_hours=None, trigger=ONCE),
    )
    black, daily, stat, top = expected(batches, 9)
    assert black and len(black) < 6
    assert rows(tables.blacklist.read(spark)) == black
    assert rows(tables.user_clicks.read(spark)) == daily
    assert rows(tables.stat.read(spark)) == stat
    assert rows(tables.province_top.read(spark)) == top


def counted(spark, batches):
    """Each batch's counted clicks, as the stream's state makes them."""
    totals = Counter()
    for events in batches:
        n = Counter()
        for minute, province, city, user, ad in events:
            day = (START + timedelta(minutes=minute)).date()
            n[day, province, city, user, ad] += 1
            totals[day, user, ad] += 1
        data = [(*key, clicked, totals[key[0], key[3], key[4]]) for key, clicked in n.items()]
        yield spark.createDataFrame(data, f"{S._SUMMED}, total long")


def test_running_a_batch_again_changes_nothing(spark, tmp_path):
    batches = some_batches(seed=2, batches=3, size=30)
    tables = S.AdTables(str(tmp_path / "tables"))
    for number, frame in enumerate(counted(spark, batches)):
        for _ in range(2):
            S.process_batch(frame, number, tables, threshold=4, top_n=2)
    black, daily, stat, top = expected(batches, 4)
    assert rows(tables.blacklist.read(spark)) == black
    assert rows(tables.user_clicks.read(spark)) == daily
    assert rows(tables.stat.read(spark)) == stat
    assert rows(tables.province_top.read(spark)) == top


def test_totals_come_from_the_table_of_user_clicks(spark, tmp_path):
    """No state beside the table, and no Python call per user and ad; the totals are those of all batches."""
    tables = S.AdTables(str(tmp_path / "tables"))
    batches = [[(0, "p", "c", 2, 1), (0, "q", "d", 2, 1)], [(1, "p", "c", 2, 1), (1, "p", "c", 3, 1)], [(2, "p", "c", 2, 1)]]
    for number, frame in enumerate(counted(spark, batches)):
        S.process_batch(frame.drop("total"), number, tables, threshold=3)
    assert rows(tables.blacklist.read(spark)) == [(2,)]
    assert [r[1:] for r in rows(tables.user_clicks.read(spark))] == [(2, 1, 3), (3, 1, 1)]
    land(tmp_path / "log", 0, batches[0])
    running = S.start_statistics(L.file_lines(spark, str(tmp_path / "log")), S.AdTables(str(tmp_path / "t")), str(tmp_path / "c"), trigger=ONCE)
    running.awaitTermination()
    assert running.recentProgress and not any(p.stateOperators for p in running.recentProgress)


def test_threshold_edges(spark, tmp_path):
    tables = S.AdTables(str(tmp_path / "tables"))
    batches = [
        [(0, "p", "c", u, 1) for u in (1, 2, 2, 3, 3, 3)],
        [(1, "p", "c", 2, 1), (1, "p", "c", 3, 1)],
        [],
    ]
    seen = []
    for number, frame in enumerate(counted(spark, batches)):
        S.process_batch(frame, number, tables, threshold=3)
        seen.append(rows(tables.blacklist.read(spark)))
    assert seen == [[(3,)], [(2,), (3,)], [(2,), (3,)]]
    assert rows(tables.stat.read(spark)) == [(date(2024, 3, 1), "p", "c", 1, 7)]


def test_a_batch_costs_its_own_keys(spark, tmp_path):
    """However many days are stored, a batch reads and writes the parts of its own day."""
    tables = S.AdTables(str(tmp_path / "tables"), buckets=8)
    days = [[(d * 1440 + u, "p", "c", u, a) for u in range(9) for a in range(2)] for d in range(3)]
    for number, frame in enumerate(counted(spark, [*days, [(5, "p", "c", 1, 1)]])):
        before = {f: f.stat().st_mtime_ns for f in (tmp_path / "tables").rglob("rows/date=*/*/*.parquet")}
        S.process_batch(frame, number, tables, threshold=None)
    after = {f for f in (tmp_path / "tables").rglob("rows/date=*/*/*.parquet")}
    written = {f.relative_to(tmp_path / "tables").parts[:3] for f in after - before.keys()}
    assert {(t, day) for t, _, day in written} == {
        (name, "date=2024-03-01") for name in ("ad_user_click_count", "ad_stat", "ad_province_clicks", "ad_province_top3")
    }
    assert len(before.keys() - after) == 4 and len(after) == len(before)


def test_a_busy_user_is_counted_in_the_map_tasks(spark):
    """However many clicks one user has, each batch of rows sends one of them to the state."""
    busy = clicks(spark, [(0, "p", "c", 1, 1)] * 5000 + [(1, "p", "c", 2, 1)]).coalesce(1)
    got = S._summed(busy).collect()
    assert sorted((r.user_id, r.click_count) for r in got) == [(1, 5000), (2, 1)]


def test_trend_equals_batch(spark, tmp_path):
    batches = some_batches(seed=3, batches=3)
    tables = replay(
        spark, tmp_path, batches, lambda lines, t, c: S.start_trend(lines, t, c, trigger=ONCE)
    )
    everything = clicks(spark, [e for b in batches for e in b])
    assert rows(tables.trend.read(spark)) == rows(A.click_trend(everything))


def test_late_clicks_leave_the_trend_but_not_the_statistics(spark, tmp_path):
    early, late = (5, "p", "c", 1, 1), (300, "p", "c", 1, 1)
    batches = [[late], [early, (301, "p", "c", 1, 1)]]
    (tmp_path / "a").mkdir()
    trend = replay(
        spark, tmp_path / "a", batches, lambda lines, t, c: S.start_trend(lines, t, c, trigger=ONCE)
    )
    assert [r[1:3] for r in rows(trend.trend.read(spark))] == [("05", "00"), ("05", "01")]
    (tmp_path / "b").mkdir()
    stat = replay(
        spark, tmp_path / "b", batches,
        lambda lines, t, c: S.start_statistics(lines, t, c, threshold=None, forget_hours=None, trigger=ONCE),
    )
    assert rows(stat.stat.read(spark)) == [(date(2024, 3, 1), "p", "c", 1, 3)]


def test_state_kept_counts_with_and_without_watermark(spark, tmp_path):
    batches = some_batches(seed=4, batches=2)
    wanted = rows(A.ad_stat(clicks(spark, [e for b in batches for e in b])))
    for name, delay in (("a", None), ("b", "1 day")):
        (tmp_path / name).mkdir()
        tables = replay(
            spark, tmp_path / name, batches,
            lambda lines, t, c, d=delay: S.start_update(
                S.running_stat(L.parse_ad_log(lines), d), t.running_stat.upsert, c, trigger=ONCE
            ),
        )
        assert rows(tables.running_stat.read(spark)) == wanted


def test_malformed_lines_are_counted(spark, tmp_path):
    land(tmp_path / "log", 0, [(0, "p", "c", 1, 1)], ["what is this", "1 2"])
    tables = S.AdTables(str(tmp_path / "tables"))
    running = S.start_statistics(
        L.file_lines(spark, str(tmp_path / "log")), tables, str(tmp_path / "checkpoint"), forget_hours=None, trigger=ONCE
    )
    running.awaitTermination()
    seen = [p.observedMetrics["ad_log"] for p in running.recentProgress if p.observedMetrics]
    assert [(m["lines"], m["malformed"]) for m in seen] == [(3, 2)]
    assert tables.stat.read(spark).count() == 1


def test_both_queries_run_together(spark, tmp_path):
    events = some_batches(seed=5, batches=1)[0]
    land(tmp_path / "log", 0, events)
    tables = S.AdTables(str(tmp_path / "tables"))
    running = S.run_ad_stream(
        L.file_lines(spark, str(tmp_path / "log")), tables, str(tmp_path / "checkpoint"), forget_hours=None, trigger=ONCE
    )
    for q in running:
        q.awaitTermination()
    frame = clicks(spark, events)
    assert rows(tables.stat.read(spark)) == rows(A.ad_stat(frame))
    assert rows(tables.trend.read(spark)) == rows(A.click_trend(frame))


def test_late_clicks_are_counted(spark, tmp_path):
    on_time, late = [(300, "p", "c", u, 1) for u in range(4)], [(5, "p", "c", u, 1) for u in range(3)]
    edge = [(239, "p", "c", 1, 1), (240, "p", "c", 1, 1)]

    def run(lines, tables, checkpoint):
        trend = S.start_trend(lines, tables, checkpoint, trigger=ONCE)
        trend.awaitTermination()
        S.record_seen(spark, trend, tables)
        return trend

    tables = replay(spark, tmp_path, [on_time, late + edge + [(301, "p", "c", 1, 1)], on_time], run)
    got = [r[1:] for r in rows(S.late_clicks(spark, tables)) if r[1]]
    assert got == [(4, 4, 0), (6, 2, 4), (4, 4, 0)]
    assert sum(r[4] for r in rows(tables.trend.read(spark))) == 10


def test_sliding_windows_close_with_the_watermark(spark, tmp_path):
    batches = some_batches(seed=6, batches=3, size=20)
    found = []

    def start(lines, tables, checkpoint):
        windows = S.sliding_counts(L.parse_ad_log(lines), "10 minutes", "20 seconds")
        return S.start_update(windows, lambda _, batch: found.extend(rows(batch)), checkpoint, "append", trigger=ONCE)

    replay(spark, tmp_path, batches, start)
    everything = clicks(spark, [e for b in batches for e in b])
    last = max(r[0] for r in rows(everything.select("ts"))) - timedelta(hours=1, minutes=10)
    wanted = [r for r in rows(A.sliding_clicks_seconds(everything, 600, 20)) if r[0] <= last]
    assert sorted(found) == wanted and wanted


def test_a_slide_is_not_copied_for_every_window(spark, tmp_path):
    """The state of the sliding windows holds groups of windows, not each of them, and forgets what is over."""
    batches = [[(m, "p", "c", 1, m % 2) for m in range(b * 400, b * 400 + 400, 7)] for b in range(3)]
    found, states = [], []

    def start(lines, tables, checkpoint):
        windows = S.sliding_counts(L.parse_ad_log(lines), "60 minutes", "10 seconds")
        query = S.start_update(windows, lambda _, batch: found.extend(rows(batch)), checkpoint, "append", trigger=ONCE)
        query.awaitTermination()
        states.append(max(sum(op.numRowsTotal for op in p.stateOperators) for p in query.recentProgress))
        return query

    replay(spark, tmp_path, batches, start)
    everything = clicks(spark, [e for b in batches for e in b])
    last = max(r[0] for r in rows(everything.select("ts"))) - timedelta(hours=2)
    wanted = [r for r in rows(A.sliding_clicks_seconds(everything, 3600, 10)) if r[0] <= last]
    assert sorted(found) == wanted and len(wanted) > 5000
    assert max(states) < 100


def test_a_failed_query_goes_on_from_its_checkpoint(spark, tmp_path):
    events = some_batches(seed=7, batches=2)
    failures = ["province_clicks", "trend", "trend"]

    class Tables(S.AdTables):
        def _failing(self, name, table):
            if name in failures:
                failures.remove(name)
                raise RuntimeError("out of reach")
            return table

        @property
        def province_clicks(self):
            return self._failing("province_clicks", super().province_clicks)

        @property
        def trend(self):
            return self._failing("trend", super().trend)

    tables = Tables(str(tmp_path / "tables"))
    for number, batch in enumerate(events):
        land(tmp_path / "log", number, batch)
        lines = L.file_lines(spark, str(tmp_path / "log"))
        S.serve_ad_stream(lines, tables, str(tmp_path / "checkpoint"), restarts=2, trigger=ONCE, threshold=9, top_n=2, forget_hours=None)
    black, daily, stat, top = expected(events, 9)
    assert rows(tables.stat.read(spark)) == stat and rows(tables.blacklist.read(spark)) == black
    assert rows(tables.user_clicks.read(spark)) == daily and rows(tables.province_top.read(spark)) == top
    assert rows(tables.trend.read(spark)) == rows(A.click_trend(clicks(spark, [e for b in events for e in b])))
    failures += ["trend"] * 3
    land(tmp_path / "log", 9, events[0])
    with pytest.raises(StreamingQueryException):
        S.serve_ad_stream(L.file_lines(spark, str(tmp_path / "log")), tables, str(tmp_path / "checkpoint"), restarts=2, trigger=ONCE, forget_hours=None)
    assert not spark.streams.active

"""Running ad-click statistics: two streaming queries over one log.

The first brings its tables up to date batch by batch: clicks per user and ad,
whose totals blacklist the users who reach the threshold, and the statistics,
because a blacklisted user is left out from the next batch on. The second counts
clicks per minute, in Spark's state, on the unfiltered log.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from footfall import schemas
from footfall.operators import ads
from footfall.sinks.keyed_table import KeyedTable
from footfall.sources.ad_log import parse_ad_log

BATCH_INTERVAL = "5 seconds"
TREND_DELAY = "60 minutes"
# Without effect, see start_statistics.
FORGET_HOURS = 72
USER_KEYS = ["date", "user_id", "ad_id"]
PLACE_KEYS = ["date", "province", "city", "ad_id"]
MINUTE_KEYS = ["date", "hour", "minute", "ad_id"]
TREND_METRIC = "ad_trend"
# Window sizes of time whose sliding windows are one state of an ad.
WINDOWS_TOGETHER = 6
# How often a failed query is started again, and how often progress is stored.
RESTARTS = 3
RECORD_SECONDS = 60

_SUMMED = "date date, province string, city string, user_id long, ad_id long, click_count long"


@dataclass(frozen=True)
class AdTables:
    """The tables kept up to date by the stream, in one folder.

    ``buckets`` is the number of parts a day of user clicks has, which is the
    largest of the tables; a day of places has a quarter of them.
    """

    root: str
    buckets: int = 4

    def _table(self, name: str, schema, rule: str, keys: list[str], **how) -> KeyedTable:
        day = "date" if "date" in keys else None
        how = {"buckets": self.buckets if "user_id" in keys else max(1, self.buckets // 4)} | how
        return KeyedTable(f"{self.root.rstrip('/')}/{name}", schema, rule, keys, split_by=day, **how)

    @property
    def user_clicks(self) -> KeyedTable:
        return self._table("ad_user_click_count", schemas.AD_USER_CLICK_COUNT, "increment", USER_KEYS)

    @property
    def blacklist(self) -> KeyedTable:
        return self._table("ad_blacklist", schemas.AD_BLACKLIST, "new_keys", ["user_id"])

    @property
    def stat(self) -> KeyedTable:
        return self._table("ad_stat", schemas.AD_STAT, "increment", PLACE_KEYS)

    @property
    def running_stat(self) -> KeyedTable:
        """The same statistics when Spark's state holds the totals."""
        return self._table("ad_running_stat", schemas.AD_STAT, "replace", PLACE_KEYS)

    @property
    def province_clicks(self) -> KeyedTable:
        """Clicks over all cities; a province's ads of a day lie in one part."""
        keys = ["date", "province", "ad_id"]
        return self._table(
            "ad_province_clicks", schemas.AD_PROVINCE_TOP3, "increment", keys, bucket_by=["province"]
        )

    @property
    def province_top(self) -> KeyedTable:
        return self._table(
            "ad_province_top3", schemas.AD_PROVINCE_TOP3, "replace_group", ["date", "province"]
        )

    @property
    def trend(self) -> KeyedTable:
        return self._table("ad_click_trend", schemas.AD_CLICK_TREND, "replace", MINUTE_KEYS)

    @property
    def trend_seen(self) -> KeyedTable:
        """Clicks in each batch of the trend, in time or not."""
        return self._table("ad_trend_seen", schemas.AD_TREND_SEEN, "replace", ["trend_batch"], buckets=1)

    @property
    def trend_counted(self) -> KeyedTable:
        """Clicks that each batch added to the trend."""
        return self._table("ad_trend_counted", schemas.AD_TREND_COUNTED, "new_keys", ["trend_batch"], buckets=1)


def _summed(clicks: DataFrame) -> DataFrame:
    """Clicks counted per place, user and ad; map tasks count their own first."""
    return clicks.groupBy("date", "province", "city", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def process_batch(
    counted: DataFrame,
    batch_id: int,
    tables: AdTables,
    threshold: int | None = ads.BLACKLIST_THRESHOLD,
    top_n: int = ads.TOP_ADS,
) -> None:
    """Bring the tables up to date with one micro-batch's clicks per day, place, user and ad.

    Reads the blacklist and the parts of tables that the batch's keys fall in. A
    user's clicks of a day so far are those that the table of user clicks holds:
    clicks up to the batch that blacklists the user are all counted there.
    Running a batch again gives the same tables. With ``threshold`` None nobody
    is blacklisted.
    """
    spark = counted.sparkSession
    blacklist = tables.blacklist.read(spark, before=batch_id)
    allowed = ads.without_blacklisted(counted, blacklist).persist()
    try:
        if not allowed.take(1):
            return
        by_user = allowed.groupBy(*USER_KEYS).agg(F.sum("click_count").alias("click_count"))
        by_place = allowed.groupBy(*PLACE_KEYS).agg(F.sum("click_count").alias("click_count"))
        by_province = ads.province_clicks(by_place)

        def tops() -> None:
            tables.province_clicks.upsert(batch_id, by_province)
            touched = tables.province_clicks.read_touching(spark, by_province, ["date", "province"])
            tables.province_top.upsert(batch_id, ads.province_top_ads(touched, top_n))

        def users() -> None:
            tables.user_clicks.upsert(batch_id, by_user)
            if threshold is not None:
                totals = tables.user_clicks.read_touching(spark, by_user, USER_KEYS)
                tables.blacklist.upsert(batch_id, ads.blacklisted_users(totals, threshold))

        steps = [users, lambda: tables.stat.upsert(batch_id, by_place), tops]
        # These steps do not need each other, so their small jobs run side by side.
        with ThreadPoolExecutor(len(steps)) as pool:
            for done in [pool.submit(step) for step in steps]:
                done.result()
    finally:
        allowed.unpersist()


def start_statistics(
    lines: DataFrame,
    tables: AdTables,
    checkpoint: str,
    threshold: int | None = ads.BLACKLIST_THRESHOLD,
    top_n: int = ads.TOP_ADS,
    forget_hours: int | None = FORGET_HOURS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the query that keeps clicks, blacklist, statistics and tops.

    ``forget_hours`` has no effect: users' totals lie in the table of their
    clicks, which keeps every day, and not in a state that has to be emptied.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(_summed(batch), batch_id, tables, threshold, top_n)

    return (
        parse_ad_log(lines, metric="ad_log")
        .writeStream.queryName("ad-statistics")
        .foreachBatch(handle)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/statistics")
        .trigger(**(trigger or {"processingTime": BATCH_INTERVAL}))
        .start()
    )


def minute_counts(clicks: DataFrame, delay: str = TREND_DELAY) -> DataFrame:
    """Streaming clicks per minute and ad; state is dropped after ``delay``."""
    return (
        clicks.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 minute").alias("slot"), "ad_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(*ads.trend_columns(F.col("slot.start")), "ad_id", "click_count")
    )


def hopping_counts(
    clicks: DataFrame, size: str = "60 minutes", slide: str = "10 minutes", delay: str = TREND_DELAY
) -> DataFrame:
    """Streaming clicks per ad in overlapping windows, also of those still open.

    For few windows per click; see ``sliding_counts``.
    """
    return (
        clicks.withWatermark("ts", delay)
        .groupBy(F.window("ts", size, slide).alias("slot"), "ad_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(F.col("slot.start").alias("window_start"), "ad_id", "click_count")
    )


def _micros(duration: str) -> int:
    return round(pd.Timedelta(duration).total_seconds() * 1_000_000)


def _floor(number: str, step: int) -> str:
    """SQL: the whole steps below ``number``."""
    return f"({number} - pmod({number}, {step}L)) div {step}L"


def _per_slide(clicks: DataFrame, slide_us: int) -> DataFrame:
    """Clicks per ad and slide, counted in every task's batches of rows."""
    keys = ["ad_id", "slide_number"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
            yield from counted.rename_columns([*keys, "clicks"]).combine_chunks().to_batches()

    numbered = clicks.where("ts IS NOT NULL").selectExpr("ad_id", f"{_floor('unix_micros(ts)', slide_us)} AS slide_number")
    return numbered.mapInArrow(run, "ad_id long, slide_number long, clicks long")


def sliding_counts(
    clicks: DataFrame, size: str = "60 minutes", slide: str = "10 seconds", delay: str = TREND_DELAY
) -> DataFrame:
    """Streaming clicks per ad in overlapping windows, each once it is closed.

    A state holds the clicks per slide of an ad and of ``WINDOWS_TOGETHER``
    window sizes of time; the slides' running sum gives the windows that the
    watermark has closed. So a slide is copied for two groups of windows at most
    and not for every window, and a group forgets the slides that no open window
    has. The delay counts in whole slides, rounded up. For append mode.
    """
    size_us, slide_us, delay_us = _micros(size), _micros(slide), _micros(delay)
    if not 0 < slide_us <= size_us:
        raise ValueError("the slide must be positive and at most the window size")
    # Slides of a window, and windows of a group; slides and windows are numbered from the epoch.
    n = size_us // slide_us
    together = n * WINDOWS_TOGETHER

    def close(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ad_id, group = key[0], int(key[1])
        slides, clicks, first = state.get if state.exists else ([], [], group * together)
        slides, clicks = np.array(slides, np.int64), np.array(clicks, np.int64)
        if not state.hasTimedOut:
            for frame in frames:
                given = np.concatenate([slides, frame["slide_number"].to_numpy(np.int64)])
                added = np.concatenate([clicks, frame["clicks"].to_numpy(np.int64)])
                slides, place = np.unique(given, return_inverse=True)
                clicks = np.zeros(len(slides), np.int64)
                np.add.at(clicks, place, added)
        closed = (state.getCurrentWatermarkMs() * 1000 - size_us) // slide_us
        end = (group + 1) * together
        after = max(first, min(closed + 1, end))
        windows = np.arange(first, after)
        sums = np.concatenate([[0], np.cumsum(clicks)])
        counts = sums[np.searchsorted(slides, windows + n)] - sums[np.searchsorted(slides, windows)]
        kept = slides >= after
        if kept.any() and after < end:
            state.update((slides[kept].tolist(), clicks[kept].tolist(), int(after)))
            # When the first open window that has clicks is over; a time-out comes with a watermark above its time.
            over = max(int(after), int(slides[kept][0]) + 1 - n) * slide_us + size_us
            state.setTimeoutTimestamp(-(-over // 1000) - 1)
        elif state.exists:
            state.remove()
        some = counts > 0
        yield pd.DataFrame({"window_number": windows[some], "ad_id": ad_id, "click_count": counts[some]})

    # The last moment of a slide is its time: it is late when all of it is.
    timed = _per_slide(clicks, slide_us).withColumn("at", F.expr(f"timestamp_micros((slide_number + 1) * {slide_us}L - 1)"))
    first_group, last_group = _floor(f"(slide_number + 1 - {n})", together), _floor("slide_number", together)
    closed = (
        timed.withWatermark("at", f"{-(-delay_us // slide_us) * slide_us} microseconds")
        .withColumn("window_group", F.explode(F.expr(f"sequence({first_group}, {last_group})")))
        .groupBy("ad_id", "window_group")
        .applyInPandasWithState(
            close,
            "window_number long, ad_id long, click_count long",
            "slides array<long>, clicks array<long>, first long",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )
    return closed.select(F.timestamp_micros(F.col("window_number") * slide_us).alias("window_start"), "ad_id", "click_count")


def running_stat(clicks: DataFrame, delay: str | None = None) -> DataFrame:
    """Streaming clicks per day, place and ad, held in Spark's state.

    The plain form of the statistics for a log that needs no blacklist. Without
    ``delay`` a click of any age counts and no state is ever dropped; with it,
    the state of a day goes once the day is that long over.
    """
    place = ["province", "city", "ad_id"]
    if delay is not None:
        day = F.window("ts", "1 day").alias("slot")
        counted = (
            clicks.withWatermark("ts", delay)
            .groupBy(day, *place)
            .agg(F.count(F.lit(1)).alias("click_count"))
        )
        return counted.select(F.to_date("slot.start").alias("date"), *place, "click_count")
    return ads.ad_stat(clicks)


def start_update(
    counts: DataFrame,
    write: Callable[[int, DataFrame], None],
    checkpoint: str,
    mode: str = "update",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that hands the changed counts of every micro-batch to ``write``."""
    return (
        counts.writeStream.outputMode(mode)
        .foreachBatch(lambda batch, batch_id: write(batch_id, batch))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": BATCH_INTERVAL}))
        .start()
    )


def start_trend(
    lines: DataFrame,
    tables: AdTables,
    checkpoint: str,
    delay: str = TREND_DELAY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the query that keeps clicks per minute, and how many each batch added."""

    def write(batch_id: int, batch: DataFrame) -> None:
        batch = batch.persist()
        try:
            known = tables.trend.read_touching(batch.sparkSession, batch, MINUTE_KEYS)
            grown = batch.select("click_count").unionByName(known.select((-F.col("click_count")).alias("click_count")))
            added = grown.agg(F.coalesce(F.sum("click_count"), F.lit(0)).alias("counted"))
            # Before the trend itself: when the batch runs again, what it added must not look known.
            tables.trend_counted.upsert(batch_id, added.withColumn("trend_batch", F.lit(batch_id).cast("bigint")))
            tables.trend.upsert(batch_id, batch)
        finally:
            batch.unpersist()

    clicks = parse_ad_log(lines).observe(TREND_METRIC, F.count(F.lit(1)).alias("clicks"))
    counts = minute_counts(clicks, delay)
    return start_update(counts, write, f"{checkpoint.rstrip('/')}/trend", trigger=trigger)


def record_seen(spark: SparkSession, trend: StreamingQuery, tables: AdTables) -> None:
    """Store how many clicks the trend's recent batches had.

    Spark remembers the progress of the last 100 batches of a query, so call it
    at least that often.
    """
    seen = {
        p.batchId: p.observedMetrics[TREND_METRIC]["clicks"]
        for p in trend.recentProgress
        if TREND_METRIC in p.observedMetrics
    }
    if seen:
        rows = spark.createDataFrame(list(seen.items()), schemas.AD_TREND_SEEN)
        tables.trend_seen.upsert(max(seen), rows)


def late_clicks(spark: SparkSession, tables: AdTables) -> DataFrame:
    """trend_batch, clicks, counted, late: what each batch had, added to the trend, and lost by coming too late."""
    seen = tables.trend_seen.read(spark).join(tables.trend_counted.read(spark), "trend_batch")
    return seen.select("trend_batch", "clicks", "counted", (F.col("clicks") - F.col("counted")).alias("late"))


def run_ad_stream(
    lines: DataFrame, tables: AdTables, checkpoint: str, trigger: dict | None = None, **how
) -> list[StreamingQuery]:
    """Start both queries of the ad application."""
    return [
        start_statistics(lines, tables, checkpoint, trigger=trigger, **how),
        start_trend(lines, tables, checkpoint, trigger=trigger),
    ]


def serve_ad_stream(
    lines: DataFrame,
    tables: AdTables,
    checkpoint: str,
    restarts: int = RESTARTS,
    trigger: dict | None = None,
    **how,
) -> None:
    """Run both queries until they end, for good if the log never does.

    A query that fails is started again from its checkpoint, each ``restarts``
    times at most; then the other one is stopped and the failure raised.
    """
    starts = {
        "statistics": lambda: start_statistics(lines, tables, checkpoint, trigger=trigger, **how),
        "trend": lambda: start_trend(lines, tables, checkpoint, trigger=trigger),
    }
    running = {name: start() for name, start in starts.items()}
    left = dict.fromkeys(starts, restarts)
    while running:
        for name, query in list(running.items()):
            try:
                ended = query.awaitTermination(RECORD_SECONDS)
            except StreamingQueryException:
                if not left[name]:
                    for other in running.values():
                        other.stop()
                    raise
                left[name] -= 1
                ended = False
                running[name] = starts[name]()
            if name == "trend":
                record_seen(lines.sparkSession, query, tables)
            if ended:
                del running[name]

"""One-step page conversion along a target flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import columns as C

START = "start"
# Length of the cells of time that sessions are cut into.
CELL_SECONDS = 3_600


def _names(splits: list[tuple[int, int]]) -> list[str]:
    return [f"{a}_{b}" for a, b in splits]


def flow_splits(flow: list[int]) -> list[str]:
    """The page splits of a flow, such as ``1_2`` and ``2_3`` for 1, 2, 3."""
    return _names(list(zip(flow, flow[1:])))


def in_cells(views: DataFrame, order: list[str], cell_seconds: int = CELL_SECONDS) -> DataFrame:
    """Distinct views with their ``copies`` and the cell of time they lie in.

    Equal views are folded into one row inside the map tasks already.
    """
    cell = F.call_function("div", F.unix_seconds("action_time"), F.lit(cell_seconds))
    return views.groupBy("session_id", cell.alias("cell"), *order).agg(F.count(F.lit(1)).alias("copies"))


def page_pair_counts(
    actions: DataFrame,
    flow: list[int],
    sequence: list[str] = (),
    cell_seconds: int = CELL_SECONDS,
) -> DataFrame:
    """Views of each target split: page B right after page A in one session.

    Actions go by time, then by the ``sequence`` columns (an event number, where
    the table has one), then by page. Rows without a session id are in no session.

    Every session is cut into cells of ``cell_seconds``; a row's cell is known
    from the row, so even a session that never ends spreads over many tasks. A
    run of c equal views is c - 1 steps from the page to itself. A cell's steps
    are counted where it was ordered and leave as one row with its first and last
    page; the first page of a cell follows the last one of the session's cell
    before it. Choose shorter cells for sessions with very many views an hour.
    """
    order = ["action_time", *sequence, "page_id"]
    splits = list(dict.fromkeys(zip(flow, flow[1:])))
    if not splits:
        return actions.sparkSession.createDataFrame([], "page_split string, pv long")
    views = actions.where(F.col("session_id").isNotNull()).select("session_id", *order)
    inside = Window.partitionBy("session_id", "cell").orderBy(*order)
    stepped = in_cells(views, order, cell_seconds).withColumn("previous", F.lag("page_id").over(inside))

    def is_step(before: str, page: str, a: int, b: int) -> Column:
        return (F.col(before) == a) & (F.col(page) == b)

    def steps(a: int, b: int) -> Column:
        again = F.when(F.col("page_id") == a, F.col("copies") - 1) if a == b else F.lit(0)
        between = F.when(is_step("previous", "page_id", a, b), 1)
        return F.sum(F.coalesce(again, F.lit(0)) + F.coalesce(between, F.lit(0)))

    # Ordered by cell already, so this moves nothing.
    position = F.struct(*order)
    cells = stepped.groupBy("session_id", "cell").agg(
        *[steps(a, b).alias(f"steps_{i}") for i, (a, b) in enumerate(splits)],
        F.min_by("page_id", position).alias("first_page"),
        F.max_by("page_id", position).alias("last_page"),
    )
    along = Window.partitionBy("session_id").orderBy("cell")
    stitched = cells.withColumn("page_before", F.lag("last_page").over(along))
    totals = stitched.agg(
        *[
            F.sum(F.col(f"steps_{i}") + F.when(is_step("page_before", "first_page", a, b), 1).otherwise(0)).alias(name)
            for i, ((a, b), name) in enumerate(zip(splits, _names(splits)))
        ]
    )
    counts = F.array(
        *[F.struct(F.lit(name).alias("page_split"), F.col(f"`{name}`").alias("pv")) for name in _names(splits)]
    )
    return totals.select(F.inline(counts)).where("pv > 0")


def start_page_views(actions: DataFrame, flow: list[int]) -> DataFrame:
    """One row: views of the flow's first page."""
    return actions.where(F.col("page_id") == flow[0]).agg(F.count(F.lit(1)).alias("pv"))


def page_conversion(actions: DataFrame, flow: list[int], **how) -> DataFrame:
    """One row per step of the flow with its views and conversion rate.

    The rate is the step's views over those of the step before, for the first
    step over the views of the start page; null when there were none. The rows
    after counting are as many as the flow has steps.
    """
    splits = flow_splits(flow)
    steps = F.array(
        *[
            F.struct(F.lit(i).cast("bigint").alias("step"), F.lit(name).alias("page_split"))
            for i, name in enumerate([START, *splits])
        ]
    )
    plan = actions.sparkSession.range(1).select(F.inline(steps))
    counts = page_pair_counts(actions, flow, **how).unionByName(
        start_page_views(actions, flow).withColumn("page_split", F.lit(START))
    )
    along = Window.partitionBy(F.lit(0)).orderBy("step")
    return (
        plan.join(counts, "page_split", "left")
        .withColumn("pv", F.coalesce("pv", F.lit(0).cast("bigint")))
        .withColumn("previous_pv", F.lag("pv").over(along))
        .where(F.col("step") > 0)
        .select(
            "step",
            "page_split",
            "pv",
            "previous_pv",
            C.ratio(F.col("pv"), F.col("previous_pv")).alias("convert_rate"),
        )
    )


def packed_conversion(conversion: DataFrame) -> DataFrame:
    """The whole flow as one text, ``1_2=0.5|2_3=0.4``."""
    return conversion.agg(
        C.pack_pairs(
            F.col("step"), F.col("page_split"), F.col("convert_rate").cast("string")
        ).alias("convert_rate")
    )

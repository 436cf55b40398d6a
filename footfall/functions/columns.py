"""Column expressions shared by the jobs. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms of time used in inputs and outputs. Fixed values.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LENIENT_TIME_FORMAT = "yyyy-MM-dd H:mm:ss"  # hours may come without padding
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"

# The most milliseconds from the epoch, either way, that a timestamp can hold.
MAX_EPOCH_MILLIS = (2**63 - 1) // 1000


def concat_long_string(number: Column, text: Column, sep: str) -> Column:
    """``number`` and ``text`` joined by ``sep``; nulls are left out."""
    return F.concat_ws(sep, number.cast("string"), text)


def json_field(text: Column, name: str) -> Column:
    """A top-level field as text; null when the JSON is bad or lacks it."""
    return F.get_json_object(text, f"$.{name}")


def random_prefix(text: Column, n: int, seed: int | None = None) -> Column:
    """``text`` behind a random number below ``n`` and an underscore."""
    draw = F.rand(seed) if seed is not None else F.rand()
    return F.concat(F.floor(draw * n).cast("string"), F.lit("_"), text)


def remove_random_prefix(text: Column) -> Column:
    return F.regexp_replace(text, "^[0-9]+_", "")


def split_ids(text: Column) -> Column:
    """Comma text as an array of ids; parts that are no number are dropped."""
    ids = F.transform(F.split(text, ","), lambda part: F.trim(part).try_cast("bigint"))
    return F.filter(ids, lambda one: one.isNotNull())


def distinct_text(column: Column, sep: str = ",") -> Column:
    """Aggregate: distinct values, sorted, as one text. Nulls are skipped."""
    return F.array_join(F.array_sort(F.collect_set(column)), sep)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` half-up at two decimals; null when ``whole`` is 0.

    Integer arithmetic, so the rounding does not depend on binary fractions.
    """
    part, whole = part.cast("bigint"), F.nullif(whole.cast("bigint"), F.lit(0))
    hundredths = F.call_function("div", part * 200 + whole, whole * 2)
    return hundredths.cast("double") / 100.0


def in_bucket(value: Column, low: int, high: int | None) -> Column:
    return value >= low if high is None else value.between(low, high)


def pack_pairs(order: Column, key: Column, value: Column) -> Column:
    """Aggregate: ``key=value|key=value`` in the given order."""
    triples = F.array_sort(F.collect_list(F.struct(order.alias("order"), key.alias("key"), value.alias("value"))))
    texts = F.transform(
        triples, lambda t: F.concat_ws("=", t["key"], t["value"])
    )
    return F.array_join(texts, "|")


def parse_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(LENIENT_TIME_FORMAT))


def format_time(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def format_date(ts: Column) -> Column:
    return F.date_format(ts, DATE_FORMAT)


def date_key(ts: Column) -> Column:
    return F.date_format(ts, DATE_KEY_FORMAT)


def parse_date_key(text: Column) -> Column:
    return F.to_date(text, DATE_KEY_FORMAT)


def minute_key(ts: Column) -> Column:
    return F.date_format(ts, MINUTE_KEY_FORMAT)


def date_hour(ts: Column) -> Column:
    return F.date_format(ts, DATE_HOUR_FORMAT)


def from_epoch_millis(text: Column) -> Column:
    """Epoch-millisecond text as a timestamp; null when it is no number or overflows."""
    millis = text.try_cast("bigint")
    return F.when(
        millis.between(-MAX_EPOCH_MILLIS, MAX_EPOCH_MILLIS), F.timestamp_millis(millis)
    )


def whole_seconds_between(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.call_function("div", micros, F.lit(1_000_000))

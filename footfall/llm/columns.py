"""Column helpers of the operators that run as built-in expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATORS = "[ \\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs of characters that are no ASCII white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front if a column has it already, in whatever case."""
    lowered = {c.lower() for c in taken}
    while name.lower() in lowered:
        name = f"_{name}"
    return name

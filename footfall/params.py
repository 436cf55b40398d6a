"""Job parameters: what a task row's JSON text asks for."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _split(text: str | None) -> list[str]:
    return [part.strip() for part in text.split(",") if part.strip()] if text else []


@dataclass(frozen=True)
class JobParams:
    """Typed parameters. An absent parameter puts no condition on the data."""

    task_id: int = 0
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: list[str] = field(default_factory=list)
    cities: list[str] = field(default_factory=list)
    sex: str | None = None
    keywords: list[str] = field(default_factory=list)
    category_ids: list[int] = field(default_factory=list)
    target_page_flow: list[int] = field(default_factory=list)

    @classmethod
    def from_json(cls, text: str, task_id: int = 0) -> "JobParams":
        """Read ``{"key": ["value", ...]}``; only a key's first value counts.

        List values are comma text inside that first value.
        """
        raw = json.loads(text) if text else {}

        def first(key: str) -> str | None:
            values = raw.get(key)
            if not isinstance(values, list) or not values or values[0] in (None, ""):
                return None
            return str(values[0])

        def number(key: str) -> int | None:
            value = first(key)
            return int(value) if value is not None else None

        return cls(
            task_id=task_id,
            start_date=first("startDate"),
            end_date=first("endDate"),
            start_age=number("startAge"),
            end_age=number("endAge"),
            # "professsionals" is the spelling found in stored tasks.
            professionals=_split(first("professionals") or first("professsionals")),
            cities=_split(first("cities")),
            sex=first("sex"),
            keywords=_split(first("keywords")),
            category_ids=[int(v) for v in _split(first("categoryIds"))],
            target_page_flow=[int(v) for v in _split(first("targetPageFlow"))],
        )


def load_params(tasks: DataFrame, task_id: int) -> JobParams:
    """Parameters of one task; a point lookup on the task table's key."""
    row = tasks.where(F.col("task_id") == task_id).select("task_param").first()
    if row is None:
        raise LookupError(f"no task with id {task_id}")
    return JobParams.from_json(row["task_param"], task_id)

"""Physical-plan inspection for tests and tuning."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as ``df.explain(mode)`` prints it (after an action: AQE's final plan)."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def count_nodes(df: DataFrame, node: str) -> int:
    """How many operators named ``node`` the (pre-AQE) physical plan holds."""
    return len(re.findall(rf"^\(\d+\) {re.escape(node)}\b", plan_text(df), flags=re.M))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*>)", plan_text(df))

"""Plan inspection helpers (tests, bench, and reviewing a query's shape)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The physical plan as text (``explain`` output)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def count_nodes(plan: str, node: str) -> int:
    return len(re.findall(re.escape(node), plan))


def shape(df: DataFrame) -> dict[str, int]:
    """Scans, shuffles, broadcasts and sorts in a query's physical plan."""
    plan = plan_text(df)
    return {
        "scans": count_nodes(plan, "FileScan"),
        "shuffles": count_nodes(plan, "Exchange hashpartitioning") + count_nodes(plan, "Exchange rangepartitioning"),
        "broadcasts": count_nodes(plan, "BroadcastExchange"),
        "sorts": count_nodes(plan, "Sort ["),
    }

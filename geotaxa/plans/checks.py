"""Plan checks: read a DataFrame's physical plan and summarize or assert on it."""

from __future__ import annotations

import io
import re
from collections.abc import Iterable
from contextlib import redirect_stdout

from pyspark.sql import DataFrame

_SHUFFLE = re.compile(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)")
_JOIN = re.compile(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                   r"[^\n]*?(Inner|LeftOuter|LeftSemi|LeftAnti|RightOuter|FullOuter|Cross)")


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def plan_summary(df: DataFrame) -> dict:
    """Shuffles, broadcasts, joins, windows and Python operators in the plan."""
    p = plan_text(df)
    return {
        "shuffles": len(_SHUFFLE.findall(p)),
        "broadcasts": p.count("BroadcastExchange"),
        "joins": [f"{a}:{b}" for a, b in _JOIN.findall(p)],
        "window_group_limits": p.count("WindowGroupLimit"),
        "python": [op for op in ("MapInPandas", "ArrowEvalPython", "BatchEvalPython",
                                 "FlatMapGroupsInPandas") if op in p],
        "cartesian": "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p,
    }


def assert_plan(df: DataFrame, contains: Iterable[str] = (), absent: Iterable[str] = ()) -> str:
    p = plan_text(df, "formatted")
    for s in contains:
        assert s in p, f"expected {s!r} in plan"
    for s in absent:
        assert s not in p, f"did not expect {s!r} in plan"
    return p

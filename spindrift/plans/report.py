"""What a plan does: joins, exchanges, scans and pushed filters as rows, with advice."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# fixed values: operator names as EXPLAIN prints them
_JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")
_ADVICE = {
    "CartesianProduct": "add an equality to the join condition",
    "BroadcastNestedLoopJoin": "add an equality to the join condition",
    "BatchEvalPython": "replace the row-at-a-time function by built-in functions",
}


def plan_text(df: DataFrame) -> str:
    """The formatted physical plan."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def operators_of(text: str) -> list[str]:
    """Operator names of the tree part of a formatted plan."""
    tree = text.split("\n\n\n")[0]
    return re.findall(r"^[-+:* ]*([A-Z][A-Za-z]+)[^(\n]*\(\d+\)", tree, flags=re.M)


def plan_report(df: DataFrame) -> DataFrame:
    """(item, detail, amount, advice): joins by strategy, exchanges, pushed filters and columns read."""
    text = plan_text(df)
    names = operators_of(text)
    rows = [("join", j, names.count(j), _ADVICE.get(j, "")) for j in _JOINS if j in names]
    rows += [("exchange", x, names.count(x), "") for x in ("Exchange", "BroadcastExchange") if x in names]
    rows += [("python", x, names.count(x), _ADVICE.get(x, "")) for x in ("BatchEvalPython", "ArrowEvalPython") if x in names]
    rows += [("pushed_filters", f, 1, "") for f in re.findall(r"PushedFilters: (\[.*?\])", text)]
    rows += [("read_schema", s, s.count(":"), "") for s in re.findall(r"ReadSchema: (struct<.*?>)\n", text)]
    return df.sparkSession.createDataFrame(rows, "item string, detail string, amount int, advice string")

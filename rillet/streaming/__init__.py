"""Streaming use of the row-wise operators.

The reference has no streaming (every job is one batch run). What carries
over: operators that are pure column expressions (rules, scores, text and
date functions) run unchanged on a streaming DataFrame; operators that need a
whole table (windows, global quantiles, maxima) stay batch-only, and
``ensure_rowwise`` rejects them on a stream instead of letting a query fail
late. Each micro-batch can be written with the batch sinks via
``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Transform = Callable[[DataFrame], DataFrame]

_STATEFUL_NODES = {"Aggregate", "Window", "Join", "Deduplicate", "DeduplicateWithinWatermark", "Sort",
                   "GlobalLimit", "LocalLimit", "Offset", "Distinct", "Expand", "WindowGroupLimit"}


def _node_names(plan) -> list[str]:
    names, stack = [], [plan]
    while stack:
        node = stack.pop()
        names.append(node.nodeName())
        kids = node.children()
        stack.extend(kids.apply(i) for i in range(kids.size()))
    return names


def ensure_rowwise(df: DataFrame) -> DataFrame:
    """Raise if the analyzed plan holds a node that needs state or a full table."""
    for name in _node_names(df._jdf.queryExecution().analyzed()):
        if name in _STATEFUL_NODES:
            raise ValueError(f"{name} is not row-wise; run this operator in batch")
    return df


def apply_rowwise(stream: DataFrame, *transforms: Transform) -> DataFrame:
    """Chain row-wise transforms on a streaming (or batch) DataFrame."""
    out = stream
    for t in transforms:
        out = t(out)
    return ensure_rowwise(out)


def write_each_batch(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                     trigger_once: bool = True):
    """Run ``sink(batch_df, batch_id)`` per micro-batch; progress is kept in
    ``checkpoint`` (shared storage on a cluster), so a restarted query resumes."""
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()

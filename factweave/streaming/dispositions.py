"""Dispositions as a stream: an addition of this engine, the batch views do not need it.

Events of one assertion are folded in order of (created_at, event_id); the state is the
assertion's current status. An illegal change is reported and does not alter the status.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from factweave.operators.review import TRANSITIONS

OUTPUT = "assertion_id string, event_id long, target_status string, legal boolean, status string"


def _fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    status = state.get[0] if state.exists else "active"
    rows = pd.concat(list(parts)).sort_values(["created_at", "event_id"])
    out = []
    for event, target in zip(rows["event_id"].tolist(), rows["target_status"].tolist(), strict=True):
        legal = target in TRANSITIONS[status]
        status = target if legal else status
        out.append((key[0], event, target, legal, status))
    state.update((status,))
    yield pd.DataFrame(out, columns=["assertion_id", "event_id", "target_status", "legal", "status"])


def statuses(events: DataFrame) -> DataFrame:
    """Streaming (assertion_id, event_id, created_at, target_status) to one row an event
    with the status after it."""
    return events.groupBy("assertion_id").applyInPandasWithState(_fold, OUTPUT, "status string", "append", GroupStateTimeout.NoTimeout)


def counts_by_window(events: DataFrame, width: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """Events of each target status in tumbling windows; what is later than ``lateness``
    is dropped with its window's state."""
    return events.withWatermark("created_at", lateness).groupBy(F.window("created_at", width), "target_status").agg(F.count("*").alias("n"))

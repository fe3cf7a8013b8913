"""The stages of each job as a state machine over the stream of its events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from martweave.functions.scalars import NEXT_STAGE

FIRST_STAGE, LAST_STAGE = "extract", "completed"
OUTCOMES = "name string, ts timestamp, stage string, after string, outcome string"
ACCEPTED, REFUSED, STUCK = "accepted", "refused", "stuck"


def check_stages(events: DataFrame, delay: str = "1 hour", stuck_after: str = "1 day") -> DataFrame:
    """Stream of (name, ts, stage, after, outcome): each event of a job ``(name, ts, stage)`` judged by the stage the job stands in.

    A job goes through extract, hyper, publish and completed, in this order. An event is ``accepted`` if its stage
    follows the one the job stands in (``after``), else ``refused``, and the job stays where it is. A job that stands in a stage for ``stuck_after`` of
    event time is reported once as ``stuck``, with the time it got there; it may go on later. Events of a job within one batch are taken by
    time, then by stage; over batches as they come. Events later than ``delay`` are dropped by the watermark, as in every stateful stream.

    State is one row per job that has begun. A completed job is remembered for ``stuck_after`` and then forgotten.
    """
    wait = pd.Timedelta(stuck_after)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stage, since, told = state.get if state.exists else (None, 0, False)
        if state.hasTimedOut:
            if stage == LAST_STAGE:
                state.remove()
                return
            yield _rows(key[0], [(pd.Timestamp(since, unit="us"), stage, stage, STUCK)])
            state.update((stage, since, True))
            return
        events_ = pd.concat(frames).sort_values(["ts", "stage"])
        out = []
        for ts, own in zip(events_["ts"], events_["stage"], strict=True):
            follows = FIRST_STAGE if stage is None else NEXT_STAGE.get(stage)
            out.append((ts, own, stage, ACCEPTED if own == follows else REFUSED))
            if own == follows:
                stage, since, told = own, int(ts.value // 1000), False
        if stage is not None:
            state.update((stage, since, told))
            due = since // 1000 + int(wait.total_seconds() * 1000)
            if not told:
                # Never before the watermark, or the timer would be refused.
                state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield _rows(key[0], out)

    moments = events.select("name", F.col("ts").cast("timestamp").alias("ts"), "stage").withWatermark("ts", delay)
    return moments.groupBy("name").applyInPandasWithState(step, OUTCOMES, "stage string, since bigint, told boolean", "append", GroupStateTimeout.EventTimeTimeout)


def _rows(name: str, rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["ts", "stage", "after", "outcome"])
    frame.insert(0, "name", name)
    return frame

"""What a stage has to do for each dataset, kept up to date as reports arrive.

A report says of a dataset, at a time, that a stage is done or not, or that its folder has content or not.  State by
dataset holds the newest report of each kind; whenever it changes, the dataset's action (skip, reset, run or rerun, as
``settings.stage_actions`` tells it) is emitted.  A dataset that has been waiting to be run or reset for longer than
``patience``, in the time of the reports, is emitted once more as overdue, by a timer.  State and timers
live in the checkpoint, so a restarted stream goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from cartulary.operators.settings import stage_actions

REPORTS = ("dataset", "at", "seq", "kind", "value")
EMITTED = "dataset string, event string, at timestamp, done boolean, filled boolean, action string"
STATE = "done boolean, done_us bigint, done_seq bigint, filled boolean, filled_us bigint, filled_seq bigint, due_ms bigint"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def action_of(done: bool, filled: bool, redo: bool) -> str:
    """The action of ``settings.stage_actions``, for one dataset."""
    if done:
        return "skip" if filled else "reset"
    return ("rerun" if redo else "skip") if filled else "run"


class StageState(StatefulProcessor):
    def __init__(self, redo: bool, patience_ms: int):
        self.redo, self.patience_ms = redo, patience_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("stage", STATE)

    def _row(self, key, event: str, at_us: int, done: bool, filled: bool) -> pd.DataFrame:
        at = pd.Series([pd.Timestamp(at_us, unit="us")])
        return pd.DataFrame({"dataset": [key[0]], "event": [event], "at": at, "done": [done], "filled": [filled], "action": [action_of(done, filled, self.redo)]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        was = self.state.get()
        done, done_us, done_seq, filled, filled_us, filled_seq, due = was or (False, None, None, False, None, None, None)
        for some in rows:
            times = some["at"].astype("datetime64[us]").astype("int64")
            for us, seq, kind, value in zip(times, some["seq"], some["kind"], some["value"], strict=True):
                if kind == "done" and (done_us is None or (us, seq) >= (done_us, done_seq)):
                    done, done_us, done_seq = bool(value), int(us), int(seq)
                elif kind == "content" and (filled_us is None or (us, seq) >= (filled_us, filled_seq)):
                    filled, filled_us, filled_seq = bool(value), int(us), int(seq)
        newest = max(x for x in (done_us, filled_us, 0) if x is not None)
        waits = action_of(done, filled, self.redo) != "skip"
        if due is not None:
            self.handle.deleteTimer(due)
            due = None
        if waits:
            due = newest // 1000 + self.patience_ms
            self.handle.registerTimer(due)
        self.state.update((done, done_us, done_seq, filled, filled_us, filled_seq, due))
        yield self._row(key, "report", newest, done, filled)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        done, done_us, done_seq, filled, filled_us, filled_seq, due = self.state.get()
        if due == expiredTimerInfo.getExpiryTimeInMs():
            self.state.update((done, done_us, done_seq, filled, filled_us, filled_seq, None))
            yield self._row(key, "overdue", due * 1000, done, filled)

    def close(self) -> None:
        pass


def follow_stages(reports: DataFrame, redo: bool = False, patience: str = "30 days", late: str = "1 hour") -> DataFrame:
    """dataset, event (report or overdue), at, done, filled, action: a row whenever a dataset of the stream ``reports`` (``REPORTS``) changes or waits too long.

    Kinds are done and content; of reports of one kind the one of the latest time holds, then of the largest
    ``seq``.  Reports more than ``late`` behind the newest are left out.  Written in update mode.
    """
    spark = reports.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != PROVIDER:  # the only one that has timers
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    wait_ms = int(pd.Timedelta(patience).total_seconds() * 1000)
    told = reports.where(F.col("kind").isin("done", "content") & F.col("dataset").isNotNull() & F.col("at").isNotNull())
    told = told.select(F.col("dataset").cast("string").alias("dataset"), F.col("at").cast("timestamp").alias("at"), F.coalesce("seq", F.lit(0)).cast("bigint").alias("seq"), "kind", F.coalesce("value", F.lit(False)).alias("value"))
    timed = told.withWatermark("at", late)
    return timed.groupBy("dataset").transformWithStateInPandas(StageState(redo, wait_ms), EMITTED, "update", "eventTime")


def stages_of(reports: DataFrame, redo: bool = False) -> DataFrame:
    """dataset, done, filled, action: the same of a table of reports, in one aggregation."""
    newest = lambda kind: F.max_by(F.when(F.col("kind") == kind, F.coalesce("value", F.lit(False))), F.when(F.col("kind") == kind, F.struct("at", "seq")))
    told = reports.where(F.col("kind").isin("done", "content") & F.col("dataset").isNotNull() & F.col("at").isNotNull())
    held = told.groupBy(F.col("dataset").cast("string").alias("dataset")).agg(F.coalesce(newest("done"), F.lit(False)).alias("done"), F.coalesce(newest("content"), F.lit(False)).alias("filled"))
    return stage_actions(held, redo=redo)


def newest_actions(emitted: DataFrame, order: str) -> DataFrame:
    """dataset, done, filled, action: the last report's row of each dataset, by the column ``order``."""
    by = Window.partitionBy("dataset").orderBy(F.col(order).desc(), F.col("at").desc())
    return emitted.where("event = 'report'").withColumn("_n", F.row_number().over(by)).where("_n = 1").select("dataset", "done", "filled", "action")

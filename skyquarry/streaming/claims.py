"""Claims of maps as a stream: starts and ends of their processing, and claims that expire by themselves."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from skyquarry.operators.state import EVENTS
from skyquarry.streaming.streams import drained

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COLUMNS = [c.split()[0] for c in EVENTS.split(", ")]


class Claims(StatefulProcessor):
    """The state of a map is its status and the moment it was last claimed; a timer stands at the end of its lease."""

    def __init__(self, lease_s: float, orphans: str):
        self.lease_s, self.orphans = float(lease_s), orphans

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.claim = handle.getValueState("claim", "status string, since double")

    def timer(self, since: float) -> int:
        return math.ceil((since + self.lease_s) * 1000)

    def handleInputRows(self, key, rows, timerValues):
        asked = [f[["at", "status"]].dropna() for f in rows]
        asked = pd.concat(asked).sort_values(["at", "status"], kind="stable")
        if key[0] is None or asked.empty:
            return
        status, since = self.claim.get() if self.claim.exists() else (None, None)
        timed = since if status == "processing" else None
        made = []
        for at, what in asked.itertuples(index=False):
            if status == "processing" and at - since >= self.lease_s:
                made.append(("expired", since, None, since + self.lease_s))
                status = "expired"
            if what == "completed" and status is None:
                if self.orphans == "raise":
                    raise ValueError(f"never started: {key[0]}")
            elif what == "completed":
                made.append((what, since, at, at))
                status = what
            elif status == "processing":
                made.append(("refused", at, None, at))
            else:
                made.append((what, at, None, at))
                status, since = what, at
        if status is not None:
            self.claim.update((status, since))
        left = since if status == "processing" else None
        if timed != left:
            if timed is not None:
                self.handle.deleteTimer(self.timer(timed))
            if left is not None:
                self.handle.registerTimer(self.timer(left))
        yield self.told(key[0], made)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        status, since = self.claim.get()
        if status == "processing" and self.timer(since) <= expiredTimerInfo.getExpiryTimeInMs():
            self.claim.update(("expired", since))
            yield self.told(key[0], [("expired", since, None, since + self.lease_s)])

    def told(self, map_id: str, made: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(made, columns=["status", "processing_start", "processing_end", "at"])
        return out.assign(map_id=map_id, processing_end=out["processing_end"].astype(float))[COLUMNS]

    def close(self) -> None:
        pass


def claims(events: DataFrame, lease_s: float = 7200.0, late: str = "0 seconds", orphans: str = "raise") -> DataFrame:
    """What becomes of a stream of claims (map_id, status, at): rows of state.EVENTS, which state.current folds into states.

    status asks: 'processing' claims a map, 'completed' ends its processing. A claim within another's lease is 'refused' (leave
    such rows out before state.current); one that is not ended within the lease is 'expired' at the lease's end, as soon as
    the clock has passed it, and the map can be claimed again. A completed map may be claimed again, and an end after its
    lease still completes. An end of a map never claimed raises, or is left out where orphans is "skip". The clock is that
    of the events, `late` behind the latest; rows without map or status only move it. Rows that are not after the clock are
    dropped, rows without a time as well. Of one moment an end is treated before a claim.
    """
    if orphans not in ("raise", "skip"):
        raise ValueError(f"orphans is raise or skip, not {orphans}")
    asked = F.col("status").isNull() | F.col("status").isin("processing", "completed")
    known = F.when(asked, F.col("status")).otherwise(F.raise_error(F.concat(F.lit("no claim: "), "status")).cast("string"))
    rows = events.where("at is not null").select(F.col("map_id").cast("string").alias("map_id"), known.alias("status"), F.col("at").cast("double").alias("at"))
    timed = rows.withColumn("ts", F.timestamp_seconds("at")).withWatermark("ts", late)
    return timed.groupBy("map_id").transformWithStateInPandas(Claims(lease_s, orphans), EVENTS, "append", "eventTime")


def settled(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """drained for claims, whose state with timers is kept by RocksDB; the session's own choice is left as it was."""
    conf = stream.sparkSession.conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, ROCKS)
    try:
        return drained(stream, path, checkpoint)
    finally:
        if before is None:
            conf.unset(PROVIDER)
        else:
            conf.set(PROVIDER, before)

"""Trips, runs and their measures on a stream: each journey's rows are put in order of time and worked on once no earlier ones can come.

A journey's state is what waits for the watermark, and what the next row needs of the rows before. Timers of event time take both up again.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadpulse.config import FIVE_MINUTES, MoeConfig
from roadpulse.functions.scalars import micros
from roadpulse.operators.moe import SUMS, measured, selected

#: What such streams need of the session: state beyond an executor's memory lives in RocksDB.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

_TRIPS = "obs_id long, journey_id string, event_time timestamp_ntz, speed_mph double, link_key string, trip_segment long, run_id long"
_RECORDS = "link_key string, time_bin timestamp_ntz, journey_id string, journeys long, n long, speed_sum decimal(38,10), speed_more double, slow long, slow_sum decimal(38,10), runs long, dsh double, crossed long, travel long"

Row = tuple[int, int, float | None, str | None]
#: Takes the journey's state, its next rows in order and the watermark; gives rows of the result.
Advance = Callable[[dict[str, Any], list[Row], int], list[tuple]]


def _in_order(observations: DataFrame, advance: Advance, schema: str, lateness: str, forget_s: float) -> DataFrame:
    """``advance`` over each journey's rows in the order of time, each row once the watermark has passed it.

    A journey's state is one value that travels with its rows, so a batch calls Python once for each journey in it and asks for nothing between.
    """
    names = [c.strip().split(" ")[0] for c in schema.replace("(38,10)", "").split(",")]
    times = [c.split(" ")[0] for c in schema.split(", ") if c.endswith("timestamp_ntz")]
    forget = int(forget_s * 1_000_000)

    def frame(key: str, rows: list[tuple]) -> pd.DataFrame:
        columns = dict(zip([c for c in names if c != "journey_id"], zip(*rows, strict=True), strict=True)) | {"journey_id": [key] * len(rows)}
        return pd.DataFrame({c: np.array(columns[c], "int64").view("datetime64[us]") if c in times else pd.Series(columns[c], dtype=object) for c in names})

    def in_order(key: Any, frames: Iterator[pd.DataFrame], store: GroupState) -> Iterator[pd.DataFrame]:
        state, rows = pickle.loads(store.get[0]) if store.exists else ({}, [])
        for df in frames:
            missing = lambda c: df[c].astype(object).where(df[c].notna(), None).tolist()  # noqa: E731, B023
            rows += zip(df["event_us"].tolist(), df["obs_id"].tolist(), missing("speed_mph"), missing("link_key"), strict=True)
        watermark = store.getCurrentWatermarkMs()
        now = watermark * 1000
        # rows up to the watermark are complete: later ones of that time are dropped, and those of this batch are all here
        ready, rest = sorted((r for r in rows if r[0] <= now), key=lambda r: r[:2]), [r for r in rows if r[0] > now]
        made: list[tuple] = []
        at = 0
        while at < len(ready):
            # a silence longer than ``forget`` begins the journey anew, whether its state was dropped meanwhile or not
            if state and ready[at][0] - state["time"] > forget:
                made += advance(state, [], now)
                state = {}
            to = next((i for i in range(at + 1, len(ready)) if ready[i][0] - ready[i - 1][0] > forget), len(ready))
            made += advance(state, ready[at:to], now)
            at = to
        if state and not ready:
            made += advance(state, [], now)
        ends = [state["time"] + forget] if state else []
        if not rest and (not ends or ends[0] <= now):
            store.remove()
        else:
            store.update((pickle.dumps((state, rest)),))
            due = min([*([state["open"]] if state.get("open") else []), *([r[0] for r in rest] or ends)])
            # goes off once the watermark is beyond it; one behind the watermark is refused
            store.setTimeoutTimestamp(max(-(-due // 1000) - 1, watermark, 1))
        if made:
            yield frame(key[0], made)

    rows = observations.filter(F.col("journey_id").isNotNull() & F.col("local_time").isNotNull())
    us = micros(F.col("local_time"))
    # wall-clock times as they are, whatever the session's zone
    rows = rows.select("journey_id", us.alias("event_us"), F.timestamp_micros(us).alias("event_time"), "obs_id", "speed_mph", "link_key").withWatermark("event_time", lateness)
    return rows.groupBy("journey_id").applyInPandasWithState(in_order, schema, "data binary", "append", GroupStateTimeout.EventTimeTimeout)


def _steps(config: MoeConfig) -> Callable[[dict[str, Any], Row], tuple[bool, bool]]:
    gap = int(config.gap_s * 1_000_000)

    def step(state: dict[str, Any], row: Row) -> tuple[bool, bool]:
        """Whether the row begins a trip and a run; the state then has their numbers."""
        us, _, _, link = row
        before = state.get("link")
        trip = link is None or before is None or us - state["time"] > gap
        run = trip or link != before
        state.update(time=us, link=link, trip=state.get("trip", 0) + trip, run=state.get("run", 0) + run)
        return trip, run

    return step


def stream_trips(observations: DataFrame, config: MoeConfig = FIVE_MINUTES, lateness: str = "10 minutes", forget_s: float = 86_400.0) -> DataFrame:
    """The rows of ``with_segments`` over a stream, each given out once the watermark (``lateness`` behind the latest time) has passed it.

    Rows later than that are dropped by the watermark, rows without a time cannot be placed and are left out. A journey's state is dropped
    ``forget_s`` after its last row: should it go on even later, its numbers begin anew. Times must be before 2262. The session needs
    ``STATE_STORE``.
    """
    step = _steps(config)

    def advance(state: dict[str, Any], rows: list[Row], now: int) -> list[tuple]:
        out = []
        for row in rows:
            step(state, row)
            us, obs, speed, link = row
            out.append((obs, us, speed, link, state["trip"], state["run"]))
        return out

    return _in_order(observations, advance, _TRIPS, lateness, forget_s)


def stream_records(observations: DataFrame, config: MoeConfig = FIVE_MINUTES, lateness: str = "10 minutes", forget_s: float = 86_400.0) -> DataFrame:
    """Partial sums of each run by bin (``moe.SUMS``), and of each complete traversal in the bin of its entry, over a stream.

    A run's share of a bin is given out when the run or the bin ends, a traversal when the next run begins. ``journeys`` is 1 on the first
    record of a journey's valid rows in a cell, so its sum counts journeys exactly. Rows as in ``stream_trips``.
    """
    step, size = _steps(config), (config.bin_minutes or 0) * 60_000_000
    if not size:
        raise ValueError("a stream has no period as a whole: set bin_minutes")

    def advance(state: dict[str, Any], rows: list[Row], now: int) -> list[tuple]:
        out: list[tuple] = []
        none = Decimal(0)

        def end_share() -> None:
            """The run's share of the open bin."""
            s = state.pop("share", None)
            state["open"] = None
            if s and s["n"]:
                cell = (s["link"], s["bin"])
                first = cell not in state["cells"]
                state["cells"].add(cell)
                out.append((s["link"], s["bin"], int(first), s["n"], s["sum"], s["more"], s["slow"], s["slow_sum"], 1, (float(s["change"]) + (s["change_more"] or 0.0)) / s["n"], 0, None))

        state.setdefault("cells", set())
        for row in rows:
            us, _, speed, link = row
            trip, run = step(state, row)
            at = us - us % size
            if run:
                end_share()
                done = state.get("entered")
                if not trip and done and done["between"] and us > done["us"]:
                    out.append((done["link"], done["us"] - done["us"] % size, 0, 0, none, None, 0, none, 0, None, 1, us - done["us"]))
                state["entered"] = {"link": link, "us": us, "between": not trip} if link is not None else None
            elif state.get("share") and state["share"]["bin"] != at:
                end_share()
            if link is None:
                continue
            if not state.get("share"):
                state["share"] = {"link": link, "bin": at, "n": 0, "sum": none, "more": None, "slow": 0, "slow_sum": none, "change": none, "change_more": None, "speed": None}
                state["open"] = at + size
            if speed is not None and speed >= 0:
                s = state["share"]
                fine = Decimal(repr(speed)).quantize(Decimal("1e-10"), ROUND_HALF_UP) if speed < 1e9 else None
                slow = speed < config.slow_mph
                s.update(n=s["n"] + 1, slow=s["slow"] + slow)
                if fine is None:
                    s["more"] = (s["more"] or 0.0) + speed
                else:
                    s["sum"] += fine
                    s["slow_sum"] += fine if slow else 0
                if s["speed"] is not None:
                    old, was = s["speed"]
                    if fine is not None and was is not None:
                        s["change"] += abs(fine - was)
                    else:
                        s["change_more"] = (s["change_more"] or 0.0) + abs(speed - old)
                s["speed"] = (speed, fine)
        if state.get("open") and state["open"] <= now:
            end_share()
        # bins that no row can reach any more
        state["cells"] = {c for c in state["cells"] if c[1] + size > now}
        return out

    return _in_order(observations, advance, _RECORDS, lateness, forget_s)


def stream_cells(records: DataFrame, links: DataFrame, config: MoeConfig = FIVE_MINUTES, hold: str = "2 hours") -> DataFrame:
    """The measures of the given links by bin, from a stream of records (the table that ``stream_records`` is written to), in append mode.

    A bin is given out once the latest bin is ``hold`` later, which must be longer than a traversal may take; records of bins given out
    are dropped. On a stream that has ended (a last record far later) the rows are those of ``link_moe``.
    """
    bins = F.timestamp_micros(micros(F.col("time_bin")))
    rows = selected(records.withColumn("at", bins).withWatermark("at", hold), links)
    cells = rows.groupBy("link_key", F.window("at", f"{config.bin_minutes} minutes").alias("bin")).agg(F.sum("journeys").alias("journey_count"), *[F.sum(c).alias(c) for c in SUMS])
    start = F.timestamp_add("MICROSECOND", F.unix_micros(F.col("bin.start")), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return measured(cells.withColumn("time_bin", start), ["link_key", "time_bin"]).drop("total_speed", "slow_speed_sum")

"""Operators over run and session events; the same code runs on streams and, for replays, on tables.

Late rows: stateful operators drop what is older than the watermark; ``split_late`` counts those rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def pair_calls(calls: DataFrame, results: DataFrame, ttl: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Each call (call_id, ts) with its later result (call_id, ts, ok): ``ok``, ``failed`` or ``pending``.

    On streams the outer rows come once the watermark has passed the call by ``ttl``.
    """
    c, r = calls.select("call_id", F.col("ts").alias("call_ts")), results.select(F.col("call_id").alias("_id"), F.col("ts").alias("result_ts"), "ok")
    if calls.isStreaming:
        c, r = c.withWatermark("call_ts", late), r.withWatermark("result_ts", late)
    met = c.join(r, (F.col("call_id") == F.col("_id")) & (F.col("result_ts") >= F.col("call_ts")) & (F.col("result_ts") <= F.col("call_ts") + F.expr(f"interval {ttl}")), "left_outer")
    return met.select("call_id", "call_ts", "result_ts", F.when(F.col("ok"), "ok").when(~F.col("ok"), "failed").otherwise("pending").alias("state"))


def denials(events: DataFrame, is_denial: Column, late: str = "1 hour") -> DataFrame:
    """Denied events, each call_id once."""
    found = events.where(is_denial)
    if events.isStreaming:
        return found.withWatermark("ts", late).dropDuplicatesWithinWatermark(["call_id"])
    return found.groupBy("call_id").agg(F.min("ts").alias("ts"))


def usage_windows(events: DataFrame, size: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Uses of each name in tumbling or sliding windows: ``start, name, uses``."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.groupBy(w.alias("w"), "name").agg(F.count("*").alias("uses")).select(F.col("w.start").alias("start"), "name", "uses")


def session_windows(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    """Sessions of each user, closed by a gap: ``user_id, start, stop, events``."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    s = events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("events"))
    return s.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "events")


def _gauge(thresholds: list[float]):
    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        total, fired = state.get if state.exists else (0.0, 0)
        out = []
        for row in pd.concat(batches).sort_values(["ts", "event_id"]).itertuples():
            total, fired = (0.0, 0) if row.reset else (total + row.amount, fired)
            while fired < len(thresholds) and total >= thresholds[fired]:
                out.append((key[0], row.event_id, thresholds[fired], total))
                fired += 1
        state.update((total, fired))
        yield pd.DataFrame(out, columns=["session", "event_id", "threshold", "total"])

    return run


def gauge(events: DataFrame, thresholds: list[float]) -> DataFrame:
    """Stream of (session, ts, event_id, reset, amount): the event at which each threshold is reached, once between resets."""
    out = "session long, event_id long, threshold double, total double"
    return events.groupBy("session").applyInPandasWithState(_gauge(sorted(thresholds)), out, "total double, fired int", "append", "NoTimeout")


def _recent(n: int):
    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        new = pd.concat(batches).sort_values(["ts", "event_id"]).event_id.tolist()
        held = (held + new)[-n:]
        state.update((held,))
        yield pd.DataFrame({"session": [key[0]], "event_ids": [held]})

    return run


def recent(events: DataFrame, n: int = 500) -> DataFrame:
    """The last ``n`` events of each session, as a list that each batch brings up to date."""
    return events.groupBy("session").applyInPandasWithState(_recent(n), "session long, event_ids array<long>", "ids array<long>", "update", "NoTimeout")


def run_state(attempts: DataFrame) -> DataFrame:
    """State and next action of each run from its stage attempts (run_id, stage, attempt, status).

    A stage's last attempt counts. A stage whose last two attempts both failed stops the run; other failed stages are
    repeated. This is a table operator; on a stream it is the body of ``foreachBatch`` over the attempts so far.
    """
    from pyspark.sql import Window

    latest = Window.partitionBy("run_id", "stage").orderBy(F.desc("attempt"))
    two = attempts.withColumn("_n", F.row_number().over(latest)).where("_n <= 2")
    last = two.groupBy("run_id", "stage").agg(F.max(F.when(F.col("_n") == 1, F.col("status"))).alias("status"), (F.sum((F.col("status") == "fail").cast("int")) == 2).alias("again"))
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    out = last.groupBy("run_id").agg(F.count("*").alias("stages"), n(F.col("status") == "fail").alias("failed"), n(F.col("status") == "pass").alias("passed"), n(F.col("again")).alias("stuck"))
    state = F.when(F.col("failed") > 0, "failed").when(F.col("passed") == F.col("stages"), "verified").otherwise("running")
    action = F.when(F.col("stuck") > 0, "stop").when(F.col("failed") > 0, "repeat").when(F.col("passed") == F.col("stages"), "none").otherwise("continue")
    return out.withColumn("state", state).withColumn("action", action)


def split_late(events: DataFrame, delay: str) -> tuple[DataFrame, DataFrame]:
    """(on time, late): rows of a table against the latest time of all rows that came before them (``arrival`` order).

    On a stream use it in ``foreachBatch`` with the batch's watermark; here it replays that rule.
    """
    from pyspark.sql import Window

    # One running maximum for each source; arrival order is only defined inside a source.
    w = Window.partitionBy("source").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    placed = events.withColumn("_seen", F.max("ts").over(w))
    late = F.coalesce(F.col("ts") < F.col("_seen") - F.expr(f"interval {delay}"), F.lit(False))
    return placed.where(~late).drop("_seen"), placed.where(late).drop("_seen")

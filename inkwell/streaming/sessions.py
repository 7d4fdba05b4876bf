"""Sessions of keyed events as a stream: repeated and late events, timers, and a table that a restart leaves the same.

Events go through ``dropDuplicatesWithinWatermark``; each Arrow batch makes sessions of what it
has, so that a key of any share of all events sends few rows on; and keyed state holds the
open sessions of each key, which goes to Python and back with the key's rows, many keys at
a time.  A session ends when no event came for ``gap``; the key's event-time timer then takes
it out of the state.  Every change of a session (n is 0 if another has taken it in) is put out, and
``written`` appends the changes of each micro-batch under its number, overwriting what a
batch that failed half-way left there.  The latest change of each session is the table, so
sessions still open when the input ends are in it, without a batch pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

#: times are microseconds inside the stream, whatever the session's zone
SESSION = "begun long, ended long, n long, total double"
#: a key's open sessions, column by column
STATE = "begun array<long>, ended array<long>, n array<long>, total array<double>"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


PART = ["begun", "ended", "n", "total"]


def merged(sessions: list[tuple], gap) -> list[tuple]:
    """Sessions in order of time, those at most ``gap`` apart made one; the order in which they are merged does not matter."""
    out: list[tuple] = []
    for s in sorted(sessions):
        if out and s[0] - out[-1][1] <= gap:
            last = out[-1]
            out[-1] = (last[0], max(last[1], s[1]), last[2] + s[2], last[3] + s[3])
        else:
            out.append(s)
    return out


def joined(key: pd.Series, at: pd.Series, value: pd.Series, gap: int) -> pd.DataFrame:
    """The sessions that a batch's events make by themselves, each in the row of its last event; the other rows are null."""
    codes = pd.factorize(key, use_na_sentinel=False)[0]
    times, values = at.to_numpy(np.int64), value.to_numpy(np.float64)
    order = np.lexsort((times, codes))
    codes, ts = codes[order], times[order]
    fresh = np.full(len(ts), True)
    fresh[1:] = (codes[1:] != codes[:-1]) | (ts[1:] - ts[:-1] > gap)
    starts = np.flatnonzero(fresh)
    ends = np.append(starts[1:], len(ts))[: len(starts)] - 1
    sums = np.add.reduceat(values[order], starts) if len(starts) else values
    own = pd.DataFrame({"begun": ts[starts], "ended": ts[ends], "n": ends - starts + 1, "total": sums}, index=order[ends])
    return own.astype({"begun": "Int64", "ended": "Int64", "n": "Int64", "total": "Float64"}).reindex(range(len(ts)))


def _changes(gap: int):
    """What a key's new sessions, or its timer, change: for applyInPandasWithState.

    The state is the key's open sessions, as arrays in order of time.  A key has one timer,
    for its session that ends first.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(zip(*state.get, strict=True)) if state.exists else []
        now_ms = state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            left = [s for s in held if s[1] + gap >= now_ms * 1000]
            out = [(key[0], *s, True) for s in held if s[1] + gap < now_ms * 1000]
        else:
            left = merged(held + [tuple(s) for frame in frames for s in frame[PART].itertuples(index=False, name=None)], gap)
            before, after = {s[0]: s for s in held}, {s[0] for s in left}
            out = [(key[0], *s, False) for s in left if before.get(s[0]) != s]
            out += [(key[0], b, s[1], 0, 0.0, False) for b, s in before.items() if b not in after]
        if left:
            state.update(tuple(list(x) for x in zip(*left, strict=True)))
            state.setTimeoutTimestamp(max((min(s[1] for s in left) + gap) // 1000 + 1, now_ms + 1))
        else:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["key", *PART, "closed"]).astype({"key": "Int64"})

    return run


def changes(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Changes of sessions from a stream of (id, key, ts, value); an event of an id seen within ``late`` is left out, and so is one that comes later than that."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    once = events.where(F.col("ts").isNotNull()).withWatermark("ts", late).dropDuplicatesWithinWatermark(["id"])
    width = pd.Timedelta(gap) // pd.Timedelta("1us")

    # its rows are taken with those of its batch, so it must run once, where it stands
    @F.pandas_udf(SESSION)
    def own(key: pd.Series, at: pd.Series, value: pd.Series) -> pd.DataFrame:
        return joined(key, at, value, width)

    value = F.coalesce(F.col("value").cast("double"), F.lit(0.0))
    single = once.select(F.col("key").cast("long").alias("key"), "ts", F.unix_micros("ts").alias("at"), value.alias("value"))
    parts = single.select("key", "ts", own.asNondeterministic()("key", "at", "value").alias("s")).where("s.n IS NOT NULL").select("key", "ts", "s.*")
    found = parts.groupBy("key").applyInPandasWithState(_changes(width), f"key long, {SESSION}, closed boolean", STATE, "update", "EventTimeTimeout")
    return found.select("key", F.timestamp_micros("begun").alias("begun"), F.timestamp_micros("ended").alias("ended"), "n", "total", "closed")


def written(stream: DataFrame, path: str, log: str) -> None:
    """Run a stream of changes over what there is now; each micro-batch's rows go to a folder of its number, whole or again."""

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = stream.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", log).trigger(availableNow=True).start()
    query.awaitTermination()


def table(spark: SparkSession, path: str) -> DataFrame:
    """(key, begun, ended, n, total, closed): the latest change of every session that still is one."""
    rows = spark.read.option("basePath", path).parquet(path)
    latest = Window.partitionBy("key", "begun").orderBy(F.desc("batch"), F.desc("closed"))
    return rows.withColumn("__place", F.row_number().over(latest)).where("__place = 1 AND n > 0").drop("__place", "batch")

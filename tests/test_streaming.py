"""Sessions as a stream: repeated and late events, restarts and batches that fail half-way, against sessions of all events at once."""

import datetime as dt
import random

import pandas as pd
import pytest

from inkwell.streaming import sessions as S

SCHEMA = "id long, key long, ts timestamp, value double"


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def by_hand(events, gap=30):
    """Sessions of all events at once, each id counted once."""
    once = {}
    for i, key, ts, value in events:
        once.setdefault(i, (key, ts, value))
    out = []
    for key, ts, value in sorted(once.values(), key=lambda e: (str(e[0]), e[1])):
        if out and out[-1][0] == key and ts - out[-1][2] <= dt.timedelta(minutes=gap):
            k, begun, _, n, total = out[-1]
            out[-1] = (k, begun, ts, n + 1, total + (value or 0.0))
        else:
            out.append((key, ts, ts, 1, value or 0.0))
    return sorted(((*s[:4], round(s[4], 6)) for s in out), key=str)


def found(spark, path):
    return sorted(((r.key, r.begun, r.ended, r.n, round(r.total, 6)) for r in S.table(spark, path).collect()), key=str)


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def add(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_merged_sessions_do_not_depend_on_order():
    rng = random.Random(1)
    gap = pd.Timedelta("30 minutes")
    for _ in range(200):
        events = [(at(t), at(t), 1, 1.0) for t in (rng.randrange(400) for _ in range(rng.randrange(12)))]
        whole = S.merged(events, gap)
        rng.shuffle(events)
        parts = [S.merged(events[k::3], gap) for k in range(3)]
        assert S.merged([s for p in parts for s in p], gap) == whole


@pytest.mark.filterwarnings("ignore")
def test_sessions_survive_repeats_late_events_restarts_and_failures(spark, tmp_path):
    source, path, log = (str(tmp_path / name) for name in ("in", "out", "log"))
    first = [(1, 1, at(0), 1.0), (2, 1, at(70), 2.0), (2, 1, at(70), 2.0), (3, 2, at(5), None), (4, None, at(8), 4.0), (4, None, at(8), 4.0)] + [(100 + k, 7, at(k % 50), 1.0) for k in range(400)]
    add(spark, source, first)
    S.written(S.changes(stream(spark, source)), path, log)
    assert found(spark, path) == by_hand(first)

    # late events join two sessions; repeats change nothing; a batch fails after it has written, and is written again
    second = [(2, 1, at(70), 2.0), (5, 1, at(30), 5.0), (6, 1, at(50), 6.0), (7, 2, at(20), 7.0)]
    add(spark, source, second)

    def fails(rows, batch):
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")
        raise OSError("lost after writing")

    broken = S.changes(stream(spark, source)).writeStream.outputMode("update").foreachBatch(fails).option("checkpointLocation", log).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="lost after writing"):
        broken.awaitTermination()
    S.written(S.changes(stream(spark, source)), path, log)
    assert found(spark, path) == by_hand(first + second)
    S.written(S.changes(stream(spark, source)), path, log)  # nothing new: nothing changes
    assert found(spark, path) == by_hand(first + second)

    # much later events move the watermark, timers close what is over, and an event from before is left out
    third = [(8, 1, at(1000), 8.0), (9, 2, at(1001), 9.0)]
    add(spark, source, third)
    S.written(S.changes(stream(spark, source)), path, log)
    add(spark, source, [(10, 1, at(40), 100.0), (11, 1, at(1010), 1.0)])
    S.written(S.changes(stream(spark, source)), path, log)
    kept = [*first, *second, *third, (11, 1, at(1010), 1.0)]
    assert found(spark, path) == by_hand(kept)
    assert {(r.key, r.begun): r.closed for r in S.table(spark, path).collect()}[1, at(0)] is True

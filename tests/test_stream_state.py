"""Keyed state: expiry and ties over several batches, rules on changes that arrive in pieces and twice."""

import datetime as dt
import random

import pytest

from stowage.streaming import state as stt
from stowage.streaming import streams as st

METRICS = "name string, ts timestamp, tie string, value double"
NOW = dt.datetime(2024, 1, 1)


def at(hours):
    return NOW + dt.timedelta(hours=hours)


def delivered(spark, path, parts, schema, files=1):
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
    return st.read_stream(spark, str(path), "*.parquet", schema, files_a_batch=files)


def latest(spark, path, parts, files=1):
    stream = stt.metric_latest_stream(delivered(spark, path, parts, METRICS, files), "value", "tie")
    return sorted(map(tuple, stt.current(st.run_once(stream, "update", ["name"])).collect()), key=str)


PARTS = [
    [("a", at(0), "x", 1.0), ("b", at(0), "x", 2.0), ("c", at(0), "y", 3.0), (None, at(0), "x", 8.0)],
    [("a", at(10), "x", 4.0), ("a", at(10), "b", 5.0), ("a", at(10), None, 6.0), ("c", at(0), "x", None)],
    [("b", at(24), "x", 7.0), ("d", at(24.5), "x", 9.0), ("d", None, "x", 1.0)],
    [("a", at(30), "z", None), ("c", at(30.5), "q", 1.5)],
    [("b", at(49.5), "x", 0.0)],
]


@pytest.mark.parametrize("files", [1, 2, 9])
def test_silent_names_leave(spark, tmp_path, files):
    # the watermark ends at 48.5 hours: names are there from 24.5 hours on
    want = [("a", at(30), "z", None), ("b", at(49.5), "x", 0.0), ("c", at(30.5), "q", 1.5), ("d", at(24.5), "x", 9.0)]
    assert latest(spark, tmp_path / "in", PARTS, files) == want
    whole = spark.createDataFrame([r for part in PARTS for r in part], METRICS)
    assert sorted(map(tuple, stt.metric_latest(whole, "value", "tie").collect()), key=str) == want


def test_a_name_that_left_may_come_back(spark, tmp_path):
    parts = [[("a", at(0), "x", 1.0)], [("b", at(30), "x", 2.0)], [("b", at(31), "x", 3.0)], [("a", at(30.5), "x", 4.0)]]
    assert latest(spark, tmp_path / "all", parts) == [("a", at(30.5), "x", 4.0), ("b", at(31), "x", 3.0)]
    assert latest(spark, tmp_path / "some", parts[:3]) == [("b", at(31), "x", 3.0)]


def test_ties_across_batches(spark, tmp_path):
    parts = [[("a", at(1), "m", 1.0)], [("a", at(1), "k", 2.0)], [("a", at(1), "z", 3.0)], [("a", at(0.5), "a", 4.0)]]
    assert latest(spark, tmp_path / "in", parts) == [("a", at(1), "k", 2.0)]


CHANGES = "scope string, name string, size bigint, seq bigint, op string"


def slow_names(changes):
    """One change after the other, in the order of arrival."""
    live, archive, last, out = {}, set(), {}, []
    for scope, name, size, seq, op in changes:
        key = (scope, name)
        if seq == 0:
            if last.get(key, -1) <= 0:
                last[key] = 0
                if op == "present":
                    live[key] = size
                else:
                    archive.add(key)
            continue
        if seq <= last.get(key, -1):
            continue
        last[key] = seq
        if op == "insert" and key in archive:
            out.append((*key, seq, "refused", size))
        elif op == "insert" and key not in live:
            live[key] = size
            out.append((*key, seq, "added", size))
        elif op == "update" and key in live:
            live[key] = size
            out.append((*key, seq, "changed", size))
        elif op == "delete" and key in live:
            out.append((*key, seq, "deleted" if key in archive else "archived", live.pop(key)))
            archive.add(key)
    return sorted(out, key=str)


@pytest.mark.parametrize("files", [1, 3])
def test_name_rules(spark, tmp_path, files):
    rng = random.Random(files)
    names = [(rng.choice("st"), f"n{i}") for i in range(12)]
    seeds = [(*n, rng.choice([None, 5]), 0, op) for n in names for op in ("present", "archived") if rng.random() < 0.4]
    log = [(*rng.choice(names), rng.choice([None, rng.randrange(99)]), k, rng.choice(["insert", "delete", "update"])) for k in range(1, 90)]
    parts = [seeds, log[:30], log[:30], log[20:60], log[50:], log]
    stream = stt.name_changes(delivered(spark, tmp_path / "in", parts, CHANGES, files))
    got = sorted(((r.scope, r.name, r.seq, r.outcome, r.size) for r in st.run_once(stream).collect()), key=str)
    assert got == slow_names([*seeds, *log])


def test_key_rules(spark, tmp_path):
    schema = "id bigint, account string, seq bigint, op string"
    parts = [
        [(1, "a", 0, "present"), (2, "b", 0, "present")],
        [(1, "a", 1, "update"), (2, "x", 1, "update"), (3, "c", 1, "insert"), (4, None, 1, "insert")],
        [(2, "x", 1, "update"), (3, None, 2, "update"), (3, "c", 3, "delete")],
        [(3, "d", 4, "insert"), (4, "e", 2, "update"), (2, "b", 2, "update")],
    ]
    got = sorted(map(tuple, st.run_once(stt.key_changes(delivered(spark, tmp_path / "in", parts, schema), "id", "account")).collect()), key=str)
    assert got == [(2, 1, "refused", "b", "x"), (3, 1, "added", None, "c"), (3, 4, "refused", "c", "d"), (4, 2, "added", None, "e")]


def test_snapshot_changes(spark, rows):
    schema = "scope string, name string, a int, b string"
    old = spark.createDataFrame([("s", "gone", 1, "x"), ("s", "same", 1, None), ("s", "other", 1, "x"), ("s", "null", None, "x")], schema)
    new = spark.createDataFrame([("s", "came", 2, "y"), ("s", "same", 1, None), ("s", "other", 2, "x"), ("s", "null", 3, "x")], schema)
    got = rows(stt.snapshot_changes(old, new, ["scope", "name"], first=4), "name", "seq", "op", "a", "b")
    assert got == [("came", 4, "insert", 2, "y"), ("gone", 4, "delete", 1, "x"), ("null", 4, "update", 3, "x"), ("other", 4, "update", 2, "x")]


def test_complete_windows(spark, tmp_path):
    schema = "ts timestamp, kind string, stat string, value double, event_id bigint"
    parts = [[(at(0.1), "gauge", "g", 1.0, 1), (at(0.1), "gauge", "g", 2.0, 0), (at(0.2), "counter", "c", 3.0, 2)], [(at(0.3), "counter", "c", 4.0, 3), (at(1.5), "timer", "t", 6.0, 4)]]
    stream = st.counter_gauge_timer(delivered(spark, tmp_path / "in", parts, schema), "event_id")
    whole = st.counter_gauge_timer(spark.createDataFrame([r for p in parts for r in p], schema), "event_id")
    order = ["window_start", "kind", "stat", "total", "last", "timings", "mean"]
    got = sorted(map(tuple, st.complete_windows(stream, ["kind", "stat"]).select(order).collect()), key=str)
    assert got == sorted(map(tuple, whole.select(order).collect()), key=str) and len(got) == 3
    assert [r for r in got if r[1] == "gauge"][0][4] == 1.0


@pytest.mark.parametrize("buckets", [1, 5])
def test_keys_share_calls_and_states(spark, tmp_path, buckets):
    rng = random.Random(buckets)
    names = [(rng.choice("st"), f"n{i}") for i in range(40)] + [(None, "n0")]
    big = 2**53 + 1  # beside a null it must not become floating point
    log = [(*rng.choice(names), rng.choice([None, big, big + 2]), k, rng.choice(["insert", "delete", "update"])) for k in range(1, 200)]
    stream = stt.name_changes(delivered(spark, tmp_path / "in", [log[:80], log[:80], log[60:]], CHANGES), buckets=buckets)
    query = stream.writeStream.format("memory").queryName(f"shared{buckets}").trigger(availableNow=True)
    query = query.option("checkpointLocation", str(tmp_path / "progress")).start()
    query.awaitTermination()
    got = sorted(((r.scope, r.name, r.seq, r.outcome, r["size"]) for r in spark.table(f"shared{buckets}").collect()), key=str)
    assert got == slow_names(log)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= buckets

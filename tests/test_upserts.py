"""Batches into a stored table: once each, whatever is played again or dies."""

import os
import random

import pytest
from pyspark.sql import functions as F

from stowage.operators.integrity import integrity_upsert
from stowage.streaming import streams as st
from stowage.streaming import upserts as up

SCHEMA = "name string, total bigint, times bigint"


def add(old, changes):
    """A merge that is not idempotent: sums and counts, so a batch that is applied twice shows."""
    new = changes.select("name", F.col("v").alias("total"), F.lit(1).cast("bigint").alias("times"))
    return old.unionByName(new).groupBy("name").agg(F.sum("total").alias("total"), F.sum("times").alias("times"))


def some_batches(rng, n=5):
    names = ["hot"] * 8 + [f"n{i}" for i in range(20)] + ["", None]
    return [[(rng.choice(names), rng.randrange(10)) for _ in range(rng.randrange(30))] for _ in range(n)]


def expected(first, batches):
    out = {n: [t, k] for n, t, k in first}
    for batch in batches:
        for n, v in batch:
            own = out.setdefault(n, [0, 0])
            own[0] += v
            own[1] += 1
    return sorted(((n, *v) for n, v in out.items()), key=str)


def content(spark, table):
    return sorted(map(tuple, table.stored(spark).collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    out = up.UpsertTable(str(tmp_path / "table"), "name", SCHEMA, buckets=8)
    assert content(spark, out) == []
    out.create(spark.createDataFrame([("hot", 5, 1), ("quiet", 7, 1)], SCHEMA))
    out.create(spark.createDataFrame([("again", 5, 1)], SCHEMA))
    return out


FIRST = [("hot", 5, 1), ("quiet", 7, 1)]


def play(spark, table, batch, number):
    frame = spark.createDataFrame(batch, "name string, v bigint")
    table.merge_batch(frame, number, F.col("name"), add)


def test_batches_played_twice(spark, table):
    batches = some_batches(random.Random(1))
    for k, batch in enumerate(batches):
        play(spark, table, batch, k)
        play(spark, table, batch, k)
        if k:
            play(spark, table, batches[k - 1], k - 1)
        assert content(spark, table) == expected(FIRST, batches[: k + 1])


def test_a_batch_that_dies_half_way(spark, table):
    batches = some_batches(random.Random(2), 3)
    play(spark, table, batches[0], 0)
    # a batch writes some of its folders and dies before its mark
    table.write(spark.createDataFrame([("hot", 999, 9), ("n1", 999, 9)], SCHEMA), 1)
    for name in ("_SUCCESS", "._SUCCESS.crc"):
        path = os.path.join(table.path, "batch=1", name)
        if os.path.exists(path):
            os.remove(path)
    assert content(spark, table) == expected(FIRST, batches[:1])
    play(spark, table, batches[1], 1)
    assert content(spark, table) == expected(FIRST, batches[:2])
    play(spark, table, batches[2], 2)
    assert content(spark, table) == expected(FIRST, batches)


def test_a_merge_that_fails_leaves_the_table(spark, table):
    play(spark, table, [("hot", 1)], 0)

    def broken(old, changes):
        return add(old, changes).withColumn("total", F.raise_error(F.lit("lost")).cast("bigint"))

    with pytest.raises(Exception, match="lost"):
        table.merge_batch(spark.createDataFrame([("hot", 1)], "name string, v bigint"), 1, F.col("name"), broken)
    assert content(spark, table) == expected(FIRST, [[("hot", 1)]])
    play(spark, table, [("hot", 1)], 1)
    assert content(spark, table) == expected(FIRST, [[("hot", 1)], [("hot", 1)]])


def test_only_reported_buckets_are_written_and_read(spark, table):
    play(spark, table, [("hot", 1)], 0)
    own = [d for d in os.listdir(f"{table.path}/batch=0") if d.startswith("bucket=")]
    assert len(own) == 1
    number = int(own[0].split("=")[1])
    text = table.stored(spark, [number])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and f"(bucket#" in text and "(batch#" in text


def test_vacuum_keeps_what_is_read(spark, table):
    batches = some_batches(random.Random(3), 4)
    for k, batch in enumerate(batches):
        play(spark, table, batch, k)
    before = content(spark, table)
    table.vacuum(spark)
    table.vacuum(spark)
    folders = [os.path.join(d, f) for d, _, files in os.walk(table.path) for f in files if f.endswith(".parquet")]
    buckets = [f.split("bucket=")[1].split("/")[0] for f in folders]
    assert content(spark, table) == before == expected(FIRST, batches) and len(set(buckets)) <= 8
    play(spark, table, batches[3], 3)
    play(spark, table, [("quiet", 1)], 4)
    assert content(spark, table) == expected(FIRST, [*batches, [("quiet", 1)]])


def test_stream_that_is_started_again(spark, table, tmp_path):
    schema = "name string, v bigint"
    batches = some_batches(random.Random(4), 3)
    sent = []
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        sent.append(batch)
        stream = st.read_stream(spark, str(tmp_path / "in"), "*.parquet", schema, files_a_batch=1)
        sink = up.upsert_sink(stream, table, F.col("name"), add)
        sink.option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start().awaitTermination()
        assert content(spark, table) == expected(FIRST, sent)


RESULT = "request_id string, filename string, error string, replicas array<struct<rse:string,pfn:string,status:string>>"
REPLICA = "request_id string, scope string, lfn string, rse string, pfn string, status string"


def some_results(rng):
    pick = lambda: (rng.choice(["X", "Y", None]), rng.choice("pq"), rng.choice(["OK", "CORRUPTED", "pending", "pending", None]))
    name = lambda: rng.choice(["", "cms:"]) + f"f{rng.randrange(5)}"
    return [(rng.choice("ab"), name(), rng.choice([None, None, None, "lost"]), [pick() for _ in range(rng.randrange(3))]) for _ in range(rng.randrange(9))]


@pytest.mark.parametrize("seed", range(4))
def test_results_of_several_batches_at_once(spark, seed):
    """The same table as from one batch after the other, with new rows that are pending themselves."""
    rng = random.Random(seed)
    first = [(rng.choice("ab"), "cms", f"f{rng.randrange(6)}", rng.choice(["X", None]), "p", rng.choice(["pending", "OK"])) for _ in range(12)]
    batches = [some_results(rng) for _ in range(5)]
    one = spark.createDataFrame(first, REPLICA)
    for batch in batches:
        one = spark.createDataFrame(integrity_upsert(one, spark.createDataFrame(batch, RESULT)).collect(), REPLICA)
    every = spark.createDataFrame([(*r, k) for k, batch in enumerate(batches) for r in batch], RESULT + ", batch bigint")
    whole = integrity_upsert(spark.createDataFrame(first, REPLICA), every)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, one.collect()), key=str)


def test_waiting_batches_do_not_write_the_table(spark, tmp_path):
    """Many small batches, each played twice: the table is written when it is made and when the log is folded."""
    table = up.UpsertTable(str(tmp_path / "table"), "name", SCHEMA, buckets=8)
    first = FIRST + [(f"other{i}", i, 1) for i in range(4000)]
    table.create(spark.createDataFrame(first, SCHEMA))
    batches = some_batches(random.Random(5), 6)
    schema = "name string, v bigint"
    for k, batch in enumerate(batches):
        for _ in range(2):
            table.keep_batch(spark.createDataFrame(batch, schema), k, F.col("name"), add)
        assert table.batches(spark) == [-1]
    with pytest.raises(ValueError, match="wait"):
        play(spark, table, batches[0], 6)
    for _ in range(2):
        table.fold(spark, spark.createDataFrame([], schema).schema, F.col("name"), add)
    assert table.batches(spark) == [-1, 5] and content(spark, table) == expected(first, batches)
    table.keep_batch(spark.createDataFrame(batches[3], schema), 3, F.col("name"), add)
    assert table.waiting(spark) == []


def test_placed_merge_shuffles_once(spark, tmp_path):
    """Old rows and log meet in one shuffle, which serves the write: the same table as without places, null names too."""
    rng = random.Random(9)
    first = [(rng.choice("ab"), "cms", rng.choice(["f1", "f2", "f3", None]), rng.choice(["X", None]), "p", rng.choice(["pending", "OK"])) for _ in range(20)]
    batches = [some_results(rng) or [("a", "f1", None, [])] for _ in range(3)]
    name, seen, plans = F.regexp_replace("filename", "^cms:", ""), [], []

    def merge(old, changes):
        out = integrity_upsert(old, changes)
        plans.append(out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return out

    for placed in (False, True):
        table = up.UpsertTable(str(tmp_path / f"table{placed}"), "lfn", REPLICA, buckets=3, placed=placed)
        table.create(spark.createDataFrame(first, REPLICA))
        for k, batch in enumerate(batches):
            table.keep_batch(spark.createDataFrame(batch, RESULT), k, name, merge)
        table.fold(spark, spark.createDataFrame([], RESULT).schema, name, merge)
        seen.append(content(spark, table))
    assert seen[0] == seen[1] and plans == [1] * len(plans)
    assert "_part" not in table.stored(spark).columns


def test_a_long_log_is_folded(spark, tmp_path):
    table = up.UpsertTable(str(tmp_path / "table"), "name", SCHEMA, buckets=1)
    table.create(spark.createDataFrame([("hot", 5, 1)], SCHEMA))
    sent = []
    for k in range(12):
        sent.append([("hot", 1), ("n", 2)])
        table.keep_batch(spark.createDataFrame(sent[-1], "name string, v bigint").coalesce(1), k, F.col("name"), add)
    assert len(table.waiting(spark)) < 12 and 1 < len(table.batches(spark)) < 5
    table.fold(spark, spark.createDataFrame([], "name string, v bigint").schema, F.col("name"), add)
    assert content(spark, table) == expected([("hot", 5, 1)], sent)

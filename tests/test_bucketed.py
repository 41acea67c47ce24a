"""Bucketed snapshots: the large tables are not shuffled, and lists are as from plain tables."""

import random

import pytest

from stowage.operators import invalidation as inv
from stowage.sources import bucketed


@pytest.fixture
def tables(spark):
    rng = random.Random(3)
    contents = [(f"/C{d % 9}", f"/C{d % 9}#{d}", "C", "D") for d in range(60)] + [(f"/C{d % 9}#{d}", f"f{rng.randrange(500)}", "D", "F") for d in range(60) for _ in range(12)]
    replicas = [(f"f{rng.randrange(500)}", rng.choice(["A", "B", "C"])) for _ in range(600)] + [("f1", "A")] * 200
    locks = [(f"f{rng.randrange(500)}", rng.choice(["A", "B", None]), rng.randrange(40)) for _ in range(700)]
    return {
        "contents": spark.createDataFrame(contents, "name string, child_name string, did_type string, child_type string"),
        "replicas": spark.createDataFrame(replicas, "name string, rse string"),
        "locks": spark.createDataFrame(locks, "name string, rse string, rule_id int"),
    }


def shuffled_scans(plan):
    """Tables that are read below a shuffle without a join or a group between."""
    path, found = [], set()
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [(d, x) for d, x in path if d < depth] + [(depth, line)]
        if "FileScan" in line or "Scan parquet" in line:
            for _, above in reversed(path[:-1]):
                if "Join" in above or "Aggregate" in above:
                    break
                if "Exchange" in above:
                    found.add(line.split("spark_catalog.default.")[1].split("_")[0] if "spark_catalog" in line else line)
    return found


@pytest.mark.parametrize("level", ["containers", "datasets"])
def test_lists_without_shuffling_the_tables(spark, rows, tmp_path, tables, level):
    kept = {n: bucketed.write_bucketed(df, str(tmp_path / n), "name", 8, n) for n, df in tables.items()}
    wanted = "/C1" if level == "containers" else "/C1#1"
    names = spark.createDataFrame([(wanted,), ("/C2" if level == "containers" else "/C2#2",)], "name string")
    rules = spark.createDataFrame([(i, "DFC"[i % 3], "n") for i in range(40)], "rule_id int, did_type string, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = lambda t: (inv.invalidate_containers(names, *t) if level == "containers" else inv.invalidate_datasets(names, *t, rules))
        plain = run([tables[n] for n in ("contents", "replicas", "locks")])
        stored = run([kept[n] for n in ("contents", "replicas", "locks")])
        for kind, df in stored.items():
            assert rows(df) == rows(plain[kind]), kind
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in text
            assert not {"replicas", "locks"} & shuffled_scans(text), kind
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshots_are_opened_again(spark, rows, tmp_path, tables):
    df = tables["replicas"]
    bucketed.write_bucketed(df, str(tmp_path / "it's"), "name", 4, "replicas")
    again = bucketed.open_bucketed(spark, str(tmp_path / "it's"), "name string, rse string", "name", 4, "replicas")
    assert rows(again) == rows(df)
    text = again.groupBy("name").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text

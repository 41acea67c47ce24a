"""Operators on small fixtures: brute force, hot keys, idempotence, error paths."""

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stowage import session
from stowage.operators import approval, capacity, containers, integrity, invalidation, placement, quality, ranking, reconcile, requests, traces
from stowage.plans import actions
from stowage.sources import lists
from stowage.streaming import streams


# --- ranking under a hot key -----------------------------------------------------------
def skewed(n=3000, seed=3):
    """A third of all rows in one key."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}", i, rng.randrange(100)) for i in range(n)]


def test_number_rows_matches_brute_force(spark):
    data = skewed()
    df = spark.createDataFrame(data, "key string, id int, v int").repartition(7)
    got = {(r["key"], r["id"]): (r["n"], r["total"]) for r in ranking.number_rows(df, ["key"], ["v", "id"]).collect()}
    groups = defaultdict(list)
    for key, i, v in data:
        groups[key].append((v, i))
    want = {(k, i): (n, len(g)) for k, g in groups.items() for n, (v, i) in enumerate(sorted(g), 1)}
    assert got == want


def test_hot_key_spreads_over_tasks(spark):
    df = spark.createDataFrame(skewed(20000), "key string, id int, v int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = df.repartitionByRange("key", "v", "id").withColumn("p", F.spark_partition_id())
        assert placed.filter("key = 'hot'").select("p").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("n", [1, 5, 1500])
def test_top_n_matches_brute_force(spark, n):
    data = skewed(6000)
    df = spark.createDataFrame(data, "key string, id int, v int").repartition(5)
    got = sorted(tuple(r) for r in ranking.top_n_per_key(df, ["key"], [F.col("v").desc(), F.col("id")], n).collect())
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    want = sorted(r for g in groups.values() for r in sorted(g, key=lambda r: (-r[2], r[1]))[:n])
    assert got == want


def test_small_top_n_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame(skewed(100), "key string, id int, v int")
    plan = ranking.top_n_per_key(df, ["key"], [F.col("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", 5, "q")], "k string, ts int, v string")
    assert rows(ranking.latest_per_key(df, ["k"], ["ts"], ["v"]), "k", "v") == [("a", "y"), ("b", "q")]
    with pytest.raises(ValueError):
        ranking.latest_per_key(df, ["k"], ["ts"], [])


def test_first_candidate_keeps_every_row(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5)], "name string, quota int")
    known = spark.createDataFrame([("a_x",), ("a",), ("b_x",), ("b_x",)], "rse string")
    out = capacity.first_candidate(df, [F.col("name"), F.concat("name", F.lit("_x"))], known, "rse")
    assert rows(out, "quota", "rse") == [(1, "a"), (2, "a"), (3, "b_x")]


def test_systematic_sample(spark):
    df = spark.createDataFrame([("f", i) for i in range(101)] + [("g", 0), ("h", 0), ("h", 1)], "file string, entry int")
    got = defaultdict(set)
    for r in ranking.systematic_sample(df, ["file"], ["entry"], samples=5, step=40).collect():
        got[r["file"]].add(r["position"])
    want = {0, 100} | {min(int(i / 4 * 101), 100) for i in range(1, 4)} | {0, 40, 80}
    assert got == {"f": want, "g": {0}, "h": {0, 1}}


def test_block_chunks(spark):
    df = spark.createDataFrame([("d", f"f{i:03d}") for i in range(25)], "dataset string, name string")
    out = ranking.block_chunks(df, ["dataset"], ["name"], 10)
    assert {r["chunk"]: r["count"] for r in out.groupBy("chunk").count().collect()} == {0: 10, 1: 10, 2: 5}
    assert out.filter("name = 'f009'").first()["chunk"] == 0


# --- invalidation ----------------------------------------------------------------------
@pytest.fixture
def catalogue(spark):
    contents = [("/C", "/C#1", "C", "D"), ("/C", "/C#2", "C", "D"), ("/C#1", "f1", "D", "F"), ("/C#1", "f2", "D", "F"),
                ("/C#2", "f3", "D", "F"), ("/O", "/O#1", "C", "D"), ("/O#1", "f1", "D", "F"), ("/O#1", "f9", "D", "F")]
    replicas = [("f1", "A_Disk", "A"), ("f1", "B_Tape", "A"), ("f2", "A_Disk", "U"), ("f9", "A_Disk", "A")]
    locks = [("f1", "A_Disk", 1), ("f1", "A_Disk", 2), ("f1", "B_Tape", 3), ("f2", "X", 4), ("f9", "A_Disk", 5)]
    rules = [(1, "/C#1", "D", "O"), (2, "f1", "F", "U"), (3, "/C", "C", "U"), (5, "f9", "F", "O")]
    return {
        "contents": spark.createDataFrame(contents, "name string, child_name string, did_type string, child_type string"),
        "replicas": spark.createDataFrame(replicas, "name string, rse string, state string"),
        "locks": spark.createDataFrame(locks, "name string, rse string, rule_id long"),
        "rules": spark.createDataFrame(rules, "rule_id long, name string, did_type string, state string"),
    }


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_invalidate_containers(spark, rows, catalogue):
    c = catalogue
    out = invalidation.invalidate_containers(names(spark, "/C", "/C", "/none"), c["contents"], c["replicas"], c["locks"])
    # f3 has no replica: it and its dataset drop out
    assert rows(out["files"]) == [("f1",), ("f2",)]
    assert rows(out["replicas"]) == [("f1", "A_Disk;B_Tape"), ("f2", "A_Disk")]
    assert rows(out["datasets"]) == [("/C#1",)]
    assert rows(out["rules"]) == [(1, "A_Disk"), (2, "A_Disk"), (3, "B_Tape")]


def test_stored_lists_are_the_lazy_lists(spark, rows, catalogue):
    """Also where files have no name, no replica or a replica without endpoint, and where a dataset's files are all missing."""
    c = dict(catalogue)
    more = [("/C", "/C#3", "C", "D"), ("/C", "/C#4", "C", "D"), ("/C", "/C#5", "C", "D"), ("/C#2", "f4", "D", "F"), ("/C#3", None, "D", "F"),
            ("/C#4", "f5", "D", "F"), ("/C#5", "f3", "D", "F"), ("/C#5", "f2", "D", "F"), ("/C#5", None, "D", "F")]
    c["contents"] = c["contents"].unionByName(spark.createDataFrame(more, c["contents"].schema))
    c["replicas"] = c["replicas"].unionByName(spark.createDataFrame([("f5", None, "A"), (None, "A_Disk", "A"), ("f2", "A_Disk", "A")], c["replicas"].schema))
    tables = c["contents"], c["replicas"], c["locks"]
    for wanted in (names(spark, "/C", "/O", "/none"), names(spark, "/none")):
        lazy = invalidation.invalidate_containers(wanted, *tables)
        kept = invalidation.invalidate_containers(wanted, *tables, stored=True)
        assert {k: rows(df) for k, df in kept.items()} == {k: rows(df) for k, df in lazy.items()}
    for wanted in (names(spark, "f1", "f1", "f3", "f5", "f9", "unknown"), names(spark, "unknown")):
        lazy = invalidation.invalidate_files(wanted, *tables, c["rules"])
        kept = invalidation.invalidate_files(wanted, *tables, c["rules"], stored=True)
        assert {k: rows(df) for k, df in kept.items()} == {k: rows(df) for k, df in lazy.items()}
    whole = invalidation.invalidate_containers(names(spark, "/C"), *tables, stored=True)
    assert rows(whole["datasets"]) == [("/C#1",), ("/C#4",), ("/C#5",)]
    assert rows(whole["replicas"]) == [("f1", "A_Disk;B_Tape"), ("f2", "A_Disk"), ("f5", "")]


def test_invalidate_datasets_and_files(spark, rows, catalogue):
    c = catalogue
    by_set = invalidation.invalidate_datasets(names(spark, "/C#1"), c["contents"], c["replicas"], c["locks"], c["rules"])
    assert rows(by_set["rules"]) == [(1, "A_Disk"), (2, "A_Disk")]
    by_file = invalidation.invalidate_files(names(spark, "f1", "f3", "unknown"), c["contents"], c["replicas"], c["locks"], c["rules"])
    # in file mode a file without replica stays, with an empty list
    assert rows(by_file["replicas"]) == [("f1", "A_Disk;B_Tape"), ("f3", "")]
    assert rows(by_file["rules"]) == [(2, "A_Disk")]
    assert rows(by_file["rules_stuck"]) == [(2,), (3,)]
    plan = actions.invalidation_actions(by_file, "lost", names(spark, "/C#1"))
    assert rows(plan.filter("kind = 'delete_rule'"), "name", "rse") == [("2", "A_Disk")]
    assert plan.filter("kind = 'declare_bad'").count() == 2
    assert plan.filter("kind = 'expire_did'").first()["args"] == {"lifetime": "86400"}


def test_invalidation_plan_by_mode(spark, rows, catalogue):
    c = catalogue
    lists = invalidation.invalidate_containers(names(spark, "/C"), c["contents"], c["replicas"], c["locks"])
    made = lambda *a, **k: rows(actions.invalidation_plan_by_mode(*a, reason="lost", **k), "kind", "name", "rse")
    bad = [("declare_bad", "f1", "A_Disk"), ("declare_bad", "f1", "B_Tape"), ("declare_bad", "f2", "A_Disk")]
    off = [("invalidate", n, None) for n in ("/C", "f1", "f2")]
    one = names(spark, "/C")
    assert made("catalogue-only", "container", one, lists) == bad
    assert made("bookkeeping-only", "container", one, lists) == off
    erased = [("expire_did", "/C", None), ("expire_did", "/C#1", None)]
    gone = [("delete_rule", "1", "A_Disk"), ("delete_rule", "2", "A_Disk"), ("delete_rule", "3", "B_Tape")]
    assert made("global", "container", one, lists, erase=True) == sorted(bad + off + erased + gone, key=str)
    wanted = names(spark, "f1", "f2")
    files = invalidation.invalidate_files(wanted, c["contents"], c["replicas"], c["locks"], c["rules"])
    valid = c["replicas"].withColumn("state", F.lit("A"))
    site = made("site-invalidation", "file", wanted, files, site="A_Disk", last_replicas=valid)
    # f1 has another valid replica, f2 has none
    assert [r for r in site if r[0] != "stuck_rule"] == [
        ("declare_bad", "f1", "A_Disk"), ("declare_bad", "f2", "A_Disk"), ("invalidate", "f2", None)
    ]
    for wrong in ({"site": "A_Disk"}, {"last_replicas": valid}):
        with pytest.raises(ValueError):
            made("global", "container", one, lists, **wrong)
    with pytest.raises(ValueError):
        made("site-invalidation", "file", wanted, files)


def test_hot_file_costs_its_locks_once(spark, rows, catalogue):
    c = catalogue
    many = spark.range(5000).select(F.lit("f1").alias("name"), F.lit("A_Disk").alias("rse"), F.col("id").alias("rule_id"))
    out = invalidation.invalidate_containers(names(spark, "/C"), c["contents"], c["replicas"], many)
    assert out["rules"].count() == 5000
    assert rows(out["replicas"]) == [("f1", "A_Disk;B_Tape"), ("f2", "A_Disk")]


def test_last_replica_files(spark, rows):
    replicas = spark.createDataFrame(
        [("a", "X", "A"), ("a", "Y", "A"), ("b", "X", "A"), ("b", "Y", "B"), ("c", "X", "A"), ("c", "Y", "T")], "name string, rse string, state string"
    )
    targets = spark.createDataFrame([("a", "X"), ("b", "X"), ("c", "X;Y"), ("d", "X")], "name string, rses string")
    got = rows(invalidation.last_replica_files(targets, replicas), "name", "last_replica")
    assert got == [("a", False), ("b", True), ("c", True), ("d", False)]


def test_bad_replica_triage(spark, rows):
    schema = "rse string, scope string, name string"
    asked = spark.createDataFrame([("X", "cms", n) for n in ("new", "known", "none")], schema)
    held = spark.createDataFrame([("X", "cms", n) for n in ("new", "known")], schema)
    bad = spark.createDataFrame([("X", "cms", "known")], schema)
    got = dict(rows(invalidation.bad_replica_triage(asked, held, bad), "name", "outcome"))
    assert got == {"new": "declare", "known": "Already declared", "none": "Unknown replica"}
    got = dict(rows(invalidation.bad_replica_triage(asked, held, bad, "SUSPICIOUS"), "name", "outcome"))
    assert got == {"new": "declare", "known": "declare", "none": "Unknown replica"}


# --- reconciliation --------------------------------------------------------------------
def test_labels_partition_the_union(spark):
    rng = random.Random(5)
    side = lambda: {(f"s{rng.randrange(3)}", f"b{rng.randrange(60)}"): rng.randrange(3) for _ in range(120)}
    a, b = side(), side()
    frame = lambda d: spark.createDataFrame([(s, k, n) for (s, k), n in d.items()], "site string, block string, n_files int")
    got = {(r["site"], r["block"]): r["label"] for r in reconcile.site_block_diff(frame(a), frame(b)).collect()}
    assert set(got) == set(a) | set(b)
    for key, label in got.items():
        want = "not_in_catalogue" if key not in b else "not_in_source" if key not in a else "complete" if a[key] == b[key] else "incomplete"
        assert label == want


def test_empty_source_guard(spark, rows):
    catalogue = spark.createDataFrame([("x", "b1", 1), ("y", "b1", 1)], "site string, block string, n_files int")
    source = spark.createDataFrame([("y", "b2", 1)], "site string, block string, n_files int")
    diff = reconcile.site_block_diff(source, catalogue)
    assert rows(reconcile.empty_source_guard(diff, source), "site", "block") == [("y", "b1"), ("y", "b2")]
    assert reconcile.empty_source_guard(diff, source, allow_clean=True).count() == 3
    # a pattern that matches nothing at a site that has a list is no empty list
    filtered = reconcile.site_block_diff(source, catalogue, ["b1"])
    assert rows(reconcile.empty_source_guard(filtered, source), "site", "block", "label") == [("y", "b1", "not_in_source")]


def test_identity_kinds_do_not_delete_each_other(spark, rows):
    schema = "account string, identity string"
    now = spark.createDataFrame([("a", "SUB=1"), ("a", "/CN=old"), ("a", "/CN=keep")], schema)
    want = spark.createDataFrame([("a", "/CN=keep"), ("a", "/CN=new")], schema)
    assert rows(reconcile.identity_diff(now, want, "X509"), "identity", "action") == [("/CN=new", "add"), ("/CN=old", "delete")]
    assert rows(reconcile.identity_diff(now, want, "OIDC"), "identity", "action") == [("/CN=new", "add"), ("SUB=1", "delete")]


def test_snapshot_archive_is_idempotent(spark):
    schema = "scope string, name string"
    old = spark.createDataFrame([("cms", "a"), ("cms", "b")], schema)
    new = spark.createDataFrame([("cms", "a")], schema)
    first = reconcile.deleted_archive(old, new, old.limit(0))
    assert [r["name"] for r in first.collect()] == ["b"]
    assert reconcile.deleted_archive(old, new, first.select("scope", "name")).count() == 0


# --- containers ------------------------------------------------------------------------
def test_container_stats_levels_and_cycle(spark, rows):
    schema = "name string, child_name string, did_type string, child_type string"
    edges = [("top", "mid", "C", "C"), ("mid", "d1", "C", "D"), ("top", "d1", "C", "D"), ("d1", "f1", "D", "F"), ("d1", "f2", "D", "F")]
    contents = spark.createDataFrame(edges, schema)
    files = spark.createDataFrame([("f1", 10), ("f2", 5)], "name string, bytes long")
    assert rows(containers.container_stats(contents, files)) == [("d1", 2, 15), ("mid", 2, 15), ("top", 4, 30)]
    assert rows(containers.container_stats(contents, files, distinct=True)) == [("d1", 2, 15), ("mid", 2, 15), ("top", 2, 15)]
    loop = spark.createDataFrame([("a", "b", "C", "C"), ("b", "a", "C", "C"), ("a", "f1", "D", "F")], schema)
    with pytest.raises(ValueError, match="contain themselves: 2 collections, a, b"):
        containers.container_stats(loop, files)
    assert containers.container_stats(contents.limit(0), files).collect() == []


def test_distinct_stats_carry_each_file_up_once(spark, rows):
    """A file in several sets, held by a parent itself, in a cycle, or under no name; one shuffle of the files' rows for both joins."""
    contents = spark.createDataFrame(
        [("a", "f1", "F"), ("b", "f1", "F"), ("b", "f2", "F"), ("top", "f2", "F"), ("top", "a", "D"), ("top", "b", "D"), ("mid", "b", "D"),
         ("up", "mid", "C"), ("up", "top", "C"), ("x", "y", "C"), ("y", "x", "C"), ("y", "f3", "F"), (None, "f1", "F"), (None, "b", "D"), ("lone", "gone", "F")],
        "name string, child_name string, child_type string",
    )
    files = spark.createDataFrame([("f1", 1), ("f2", 10), ("f3", 100)], "name string, bytes long")
    out = containers.container_stats(contents, files, distinct=True)
    both = [(n, 2, 11) for n in ("b", "mid", "top", "up", None)]
    assert rows(out) == sorted([("a", 1, 1), *both, ("lone", 1, 0), ("x", 1, 100), ("y", 1, 100)], key=str)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_cycle_among_many_collections_is_named_in_few_rounds(spark, monkeypatch):
    """10^4 collections in chains of five, and a cycle of three with something above and below it."""
    schema = "name string, child_name string, did_type string, child_type string"
    edges = [(f"c{i}", f"c{i + 1}", "C", "C") for i in range(10000) if i % 5 < 4] + [(f"c{i}", f"f{i}", "D", "F") for i in range(10000)]
    cycle = [("x", "y", "C", "C"), ("y", "z", "C", "C"), ("z", "x", "C", "C"), ("top", "x", "C", "C"), ("z", "c4", "C", "C"), ("over", "top", "C", "C")]
    files = spark.range(10000).selectExpr("concat('f', id) as name", "id as bytes")
    rounds, keep = [], containers.keep_table
    monkeypatch.setattr(containers, "keep_table", lambda df, label: rounds.append(1) or keep(df, label))
    got = {r["name"]: (r["length"], r["size"]) for r in containers.container_stats(spark.createDataFrame(edges, schema), files).collect()}
    assert len(got) == 10000 and all(got[f"c{i}"] == (5 - i % 5, sum(range(i, i + 5 - i % 5))) for i in range(10000))
    assert len(rounds) <= 2 + 4 * 5
    rounds.clear()
    with pytest.raises(ValueError, match="3 collections, x, y, z"):
        containers.container_stats(spark.createDataFrame(edges + cycle, schema), files)
    assert len(rounds) <= 2 + 4 * 6 + 4


def test_paths_that_meet_count_each(spark):
    """Against a plain recursion over random nestings, with repeated rows and empty collections."""
    import random

    rng = random.Random(3)
    schema = "name string, child_name string, did_type string, child_type string"
    for _ in range(2):
        edges = [(f"c{i}", f"c{rng.randrange(i + 1, 31)}", "C", "C") for i in range(30) for _ in range(rng.randrange(4))]
        held = [(f"c{rng.randrange(10, 34)}", f"f{rng.randrange(40)}", "D", "F") for _ in range(25)]
        sizes = {f"f{i}": i for i in range(30)}

        def below(name):
            found = [(1, sizes.get(f, 0)) for c, f, *_ in held if c == name]
            found += [below(child) for c, child, *_ in edges if c == name]
            return tuple(map(sum, zip(*found))) if found else (0, 0)

        files = spark.createDataFrame(list(sizes.items()), "name string, bytes long")
        got = {r["name"]: (r["length"], r["size"]) for r in containers.container_stats(spark.createDataFrame(edges + held, schema), files).collect()}
        assert got == {f"c{i}": below(f"c{i}") for i in range(34) if below(f"c{i}")[0]}


def test_tape_hints_without_type(spark):
    schema = "name string, child_name string, did_type string, child_type string"
    contents = spark.createDataFrame([("/C", "/C#1", "C", "D"), ("/C#1", "/store/data/E/P/RAW/f", "D", "F"), ("/C#1", "/store/x/y", "D", "F")], schema)
    files = spark.createDataFrame(
        [("/store/data/E/P/RAW/f", 7, None, "ab", None), ("/store/x/y", 1, None, None, "Staging")],
        "name string, bytes long, md5 string, adler32 string, activity string",
    )
    got = {r["name"]: r for r in containers.tape_hints(files, contents, files.select("name", "bytes")).collect()}
    first = got["/store/data/E/P/RAW/f"]
    assert first["collocation_hints"] == {"0": "raw", "1": "RAW", "2": "E", "3": "/C"}
    assert (first["additional_hints"]["activity"], first["additional_hints"]["level_3"]["length"]) == ("default", 2)
    assert got["/store/x/y"]["collocation_hints"] == {"0": "n/a"} and got["/store/x/y"]["additional_hints"]["level_3"] is None


# --- integrity -------------------------------------------------------------------------
RESULTS = [
    ("r", "cms:/store/a.root", None, [("X", "p1", "OK"), ("T", "p2", "ERROR")]),
    ("r", "/store/b.root", None, [("X", "p3", "OK"), ("Y", "p4", "OK")]),
]
RESULT_TYPE = "request_id string, filename string, error string, replicas array<struct<rse:string,pfn:string,status:string>>"


@pytest.fixture
def pending(spark):
    cols = "request_id string, scope string, lfn string, rse string, pfn string, status string"
    return spark.createDataFrame([("r", "cms", f"/store/{n}.root", None, None, "pending") for n in "abc"], cols)


def test_upsert_twice_is_once(spark, rows, pending):
    results = spark.createDataFrame(RESULTS, RESULT_TYPE)
    once = integrity.integrity_upsert(pending, results)
    assert once.filter("status = 'pending'").select("lfn").collect() == [("/store/c.root",)]
    assert once.filter("status = 'OK'").count() == 3 and once.filter("status = 'ERROR'").count() == 1
    assert once.filter("lfn = '/store/b.root'").select("scope").distinct().collect() == [("cms",)]
    assert rows(integrity.integrity_upsert(once, results)) == rows(once)


def test_upsert_error_row(spark, rows, pending):
    failed = spark.createDataFrame([("r", "cms:/store/a.root", "No replicas", [])], RESULT_TYPE)
    once = integrity.integrity_upsert(pending, failed)
    assert rows(once.filter("lfn = '/store/a.root'"), "rse", "status") == [(None, "ERROR")]
    assert rows(integrity.integrity_upsert(once, failed)) == rows(once)


def test_job_result_json(spark):
    logs = spark.createDataFrame(
        [("good", 'INFO x\n[{"filename": "old"}]\nnoise\n  [{"filename": "f", "replicas": [{"rse": "X", "status": "OK"}]}]\nbye'),
         ("none", "INFO only"), ("broken", "[{not json")],
        "request_id string, logs string",
    )
    got = {r["request_id"]: r for r in integrity.job_result_json(logs).collect()}
    assert got["good"]["filename"] == "f" and got["good"]["replicas"][0]["status"] == "OK" and got["good"]["log_error"] is None
    assert got["none"]["log_error"] == "no result list in log" and got["broken"]["log_error"] == "result is not a list"


def test_payload_check_job(spark, rows):
    checksum = lambda b: f"{zlib.adler32(b):08x}"
    good, bad, odd = b"x" * 10, b"y" * 10, b"ROT" + b"z" * 10
    attempts = spark.createDataFrame(
        [("f", "X", 0, "p0", False, checksum(good)), ("f", "X", 1, "p1", True, checksum(good)), ("f", "X", 2, "p2", True, checksum(good)),
         ("f", "Y", 0, "q0", True, checksum(good)), ("f", "Z", 0, "z0", False, checksum(good)), ("f", "Z", 1, "z1", False, checksum(good)),
         ("g", "X", 0, "g0", True, checksum(odd))],
        "lfn string, rse string, pos int, pfn string, copied boolean, adler32 string",
    )
    contents = spark.createDataFrame([("p1", good), ("p2", bad), ("q0", bad), ("g0", odd)], "pfn string, content binary")

    def decode(frames):
        for frame in frames:
            frame["status"] = ["CORRUPTED" if c.startswith(b"ROT") else "OK" for c in frame["content"]]
            yield frame

    got = rows(integrity.payload_check_job(attempts, contents, decode), "lfn", "rse", "pfn", "status")
    assert got == [("f", "X", "p1", "OK"), ("f", "Y", "q0", "CORRUPTED"), ("f", "Z", "z1", "ERROR"), ("g", "X", "g0", "CORRUPTED")]
    plain = dict(((a, b), d) for a, b, _, d in rows(integrity.payload_check_job(attempts, contents), "lfn", "rse", "pfn", "status"))
    assert plain[("g", "X")] == "OK"
    # without fall-back to other paths an uncopied first path counts as not intact
    lost = rows(integrity.checksum_invalidations(attempts, contents), "lfn", "rse")
    assert lost == [("f", "X"), ("f", "Y"), ("f", "Z")]


def test_chunk_checksum_of_one_large_payload(spark):
    rng = random.Random(9)
    payloads = {"big": rng.randbytes(700_001), "small": b"abc", "zeros": bytes(5000)}
    chunks = [(k, i, v[i : i + 4096]) for k, v in payloads.items() for i in range(0, len(v), 4096)]
    rng.shuffle(chunks)
    df = spark.createDataFrame(chunks, "lfn string, at long, content binary").repartition(8)
    sizes = spark.createDataFrame([(k, len(v)) for k, v in payloads.items()], "lfn string, size long")
    got = {r["lfn"]: r["computed"] for r in integrity.chunk_checksum(df, sizes).collect()}
    assert got == {k: f"{zlib.adler32(v):08x}" for k, v in payloads.items()}


def test_chunk_checksum_accounts_for_every_file(spark):
    chunks = spark.createDataFrame([("half", 0, b"abc"), ("whole", 0, b"abc")], "lfn string, at long, content binary")
    sizes = spark.createDataFrame([("half", 6), ("whole", 3), ("empty", 0), ("absent", 4), ("unsized", None)], "lfn string, size long")
    got = {r["lfn"]: (r["computed"], r["reason"] is None) for r in integrity.chunk_checksum(chunks, sizes).collect()}
    assert got == {"half": (None, False), "whole": (f"{zlib.adler32(b'abc'):08x}", True), "empty": ("00000001", True),
                   "absent": (None, False), "unsized": (None, False)}


def test_missing_content_is_an_error_and_not_intact(spark, rows):
    attempts = spark.createDataFrame(
        [("f", "X", 0, "gone", True, "1"), ("f", "Y", 0, "null", True, "1"), ("f", "Z", 0, "none", None, "1")],
        "lfn string, rse string, pos int, pfn string, copied boolean, adler32 string",
    )
    contents = spark.createDataFrame([("null", None)], "pfn string, content binary")
    got = rows(integrity.payload_check_job(attempts, contents), "rse", "status")
    assert got == [("X", "ERROR"), ("Y", "ERROR"), ("Z", "ERROR")]
    assert rows(integrity.checksum_invalidations(attempts, contents), "rse") == [("X",), ("Y",), ("Z",)]


def test_null_keys_are_numbered(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", None)], "key string, v int")
    got = sorted(((r["key"], r["v"], r["n"], r["total"]) for r in ranking.number_rows(df, ["key"], ["v"]).collect()), key=str)
    assert got == sorted([(None, 1, 1, 2), (None, 2, 2, 2), ("a", 3, 1, 1), ("b", None, 1, 1)], key=str)


def test_every_url_has_a_group(spark):
    urls = ["https://h.org/a/b?q#f", "https://h.org", "not a url", "/bare/path", "http://h.org/with blank", "root://e//store/x", None]
    got = traces.archive_host_groups(spark.createDataFrame([(u,) for u in urls], "url string")).collect()
    assert sum(len(r["paths"]) for r in got) == len(urls)
    assert {r["host"]: r["paths"] for r in got} == {
        "https://h.org": ["", "/a/b", "/with blank"], "https://": ["", "/bare/path", "not a url"], "https://e": ["//store/x"],
    }


def test_paths_that_do_not_fit_are_rejected(spark):
    files = spark.createDataFrame([("/store/group/x/A/B/C/v1/f.root",), ("/elsewhere/f.root",), (None,)], "path string")
    plan = actions.registration_plan(files, "/store/group/x", "user.x").collect()
    assert sorted(str(r["name"]) for r in plan if r["kind"] == "reject") == ["/elsewhere/f.root", "None"]
    assert all(r["reason"] for r in plan if r["kind"] == "reject")
    assert any(r["kind"] == "add_did" and r["name"].endswith("f.root") for r in plan)


def test_approval_limits(spark):
    request = [(1, 0, "n", "u", "X", True, False, 10)]
    requests_ = spark.createDataFrame(
        request, "request_id int, position int, name string, account string, rse_expression string, ask_approval boolean, locked boolean, lifetime int"
    )
    facts = spark.createDataFrame([(1, 1, 1, False)], "request_id int, n_rses long, n_writable long, barred boolean")
    banned = spark.createDataFrame([], "account string")
    sizes = spark.createDataFrame([("n", 100)], "name string, size long")
    usage = spark.createDataFrame([("u", None, 50, 1), ("u", "X", 20, 0)], "account string, rse_expression string, bytes long, whole_account int")
    locked = spark.createDataFrame([(1000,)], "bytes long")
    decide = lambda **limits: approval.rule_request_decision(requests_, facts, banned, sizes, usage, locked, **limits).first()["decision"]
    assert decide() == "approved"
    assert decide(max_single_rse=119) == "single endpoint usage exceeded" and decide(max_single_rse=120) == "approved"
    assert decide(max_account=149) == "account usage exceeded" and decide(max_account=150) == "approved"
    assert decide(max_global=1099) == "global usage exceeded" and decide(max_global=1100) == "approved"
    assert decide(max_lifetime=9) == "lifetime too long"


def test_binary_files_end_to_end(spark, tmp_path):
    (tmp_path / "a.root").write_bytes(b"hello")
    files = spark.read.format("binaryFile").load(str(tmp_path)).select(F.col("path").alias("lfn"), "content")
    assert integrity.payload_checksum(files).first()["computed"] == f"{zlib.adler32(b'hello'):08x}"


# --- capacity and placement ------------------------------------------------------------
def weights(spark, write=True):
    usage = spark.createDataFrame(
        [(r, s, v) for r, vals in {"A": (100, 40, 10), "B": (300, 100, 30), "C": (100, 150, 0)}.items() for s, v in zip(("static", "used", "expired"), vals)]
        + [("D", "static", 5)],
        "rse string, source string, used long",
    )
    rses = spark.createDataFrame([(r, write, "2" if r == "B" else None) for r in "ABCD"], "rse string, availability_write boolean, coefficient string")
    return capacity.dm_weight(usage, rses, spark.createDataFrame([("A", 10)], "rse string, min_free long"), 0.35, 0.35, 0.3, True)


def test_weights_sum_to_100(spark):
    got = {r["rse"]: r["dm_weight"] for r in weights(spark).collect()}
    a = (0.35 * 100 / 500 + 0.35 * 50 / 100 + 0.3 * 10 / 100) ** 2
    b = ((0.35 * 300 / 500 + 0.35 * 200 / 300 + 0.3 * 30 / 300) * 2) ** 2
    # D lacks metrics and is left out; C is over its quota
    assert set(got) == {"A", "B", "C"} and got["C"] == 0
    assert got["A"] == pytest.approx(100 * a / (a + b)) and sum(got.values()) == pytest.approx(100)


def test_no_positive_weight_gives_null(spark):
    assert {r["dm_weight"] for r in weights(spark, write=False).collect()} == {None}


def test_distance_ladder(spark):
    rses = spark.createDataFrame(
        [("a", "s1", "real", "DE", "A"), ("b", "s1", "real", "FR", "B"), ("c", "s2", "real", "DE", "A"), ("d", "s3", "real", "FR", "A"),
         ("e", "s4", "real", "DE", None), ("f", "s5", "real", "IT", "C"), ("g", "s6", "real", "RU", "D"), ("h", "s7", "test", None, None), ("i", "s8", "temp", None, None)],
        "rse string, site string, cms_type string, country string, region string",
    )
    want = {("a", "b"): 1, ("a", "c"): 4, ("a", "d"): 10, ("a", "e"): 7, ("a", "f"): 11, ("f", "a"): 11, ("f", "g"): 12, ("a", "g"): 13, ("h", "i"): 7, ("a", "h"): 13}
    links = spark.createDataFrame(list(want), "src string, dest string")
    matrix = placement.rse_distance_matrix(links, rses)
    assert {(r["src"], r["dest"]): r["distance"] for r in matrix.collect()} == want
    cut = placement.excluded_links(matrix, rses, [{"src": {}, "dest": {"cms_type": "temp"}}, {"src": {"rse": "^(?!a|f).*$"}, "dest": {"rse": "a"}}])
    assert {(r["src"], r["dest"]) for r in cut.filter("distance = -1").collect()} == {("h", "i")}


def test_site_managers_suffix_order(spark, rows):
    managers = spark.createDataFrame([("t1_de_kit", "b"), ("t1_de_kit", "a"), ("t2_x_tape", "c")], "site string, login string")
    rses = spark.createDataFrame([("T1_DE_KIT_Disk",), ("T1_DE_KIT_Tape_Test",), ("T2_X_Tape",), ("T3_None",)], "rse string")
    got = rows(placement.site_managers_to_rse(managers, rses))
    assert got == [("T1_DE_KIT_Disk", "t1_de_kit", "a,b"), ("T1_DE_KIT_Tape_Test", "t1_de_kit", "a,b"), ("T2_X_Tape", "t2_x_tape", "c")]


def test_region_reaches_the_test_twin(spark, rows):
    regions = spark.createDataFrame([("A", "R"), ("B", "S")], "rse string, region string")
    rses = spark.createDataFrame([("A",), ("A_Test",), ("B",)], "rse string")
    assert rows(placement.region_assign(regions, rses), "rse", "value") == [("A", "R"), ("A_Test", "R"), ("B", "S")]


def test_wan_priority_plan(spark):
    protocols = spark.createDataFrame([("X", "root", (1, 1, 1, 1)), ("X", "srm", (2, 2, 2, 2))], "rse string, scheme string, wan struct<read:int,write:int,third_party_copy:int,delete:int>")
    out = actions.wan_priority_plan(protocols, ["root"], write=0).collect()
    assert len(out) == 1 and tuple(out[0]["wan"]) == (1, 0, 1, 1)
    assert actions.wan_priority_plan(protocols, ["root"]).count() == 0


# --- requests, checks, traces ----------------------------------------------------------
def test_job_outcome(spark, rows):
    text = "Declared file /store/a.root as bad at X\nDeclared file /store/b.root as bad at X\nInvalidation OK for file: /store/b.root \nInvalidation OK for file: /store/c.root \n"
    parsed = requests.job_log_parse(spark.createDataFrame([("j", text), ("k", "Error running shell script " + text)], "job string, logs string"))
    asked = spark.createDataFrame([("j", f"/store/{n}.root") for n in "abcd"] + [("k", "/store/a.root")], "job string, file_name string")
    got = rows(requests.job_outcome_merge(asked, parsed), "file_name", "mode")
    assert got == [("/store/a.root", "catalogue_only"), ("/store/b.root", "global"), ("/store/c.root", "bookkeeping_only")]


def test_submission_check(spark):
    lines = [("ok", "cms:/store/a.root"), ("dup", "/store/a.root"), ("dup", " /store/a.root "), ("none", "  "), ("txt", "/store/a.txt")]
    lines += [("many", f"/store/{i}.root") for i in range(21)]
    out = quality.integrity_submission_check(spark.createDataFrame(lines, "request_id string, line string"))
    got = {r["request_id"]: r["errors"] for r in out.collect()}
    assert got == {"ok": [], "dup": ["duplicate names"], "none": ["no names"], "txt": ["not .root files"], "many": ["too many names"]}


def test_scope_pattern_is_not_fully_anchored(spark):
    df = spark.createDataFrame([("cms",), ("cms2",), ("the logs",), ("user.me",), ("other",)], "scope string")
    out = quality.name_schema_check(df, {"scope": "scope"})
    assert {r["scope"] for r in out.filter("size(violations) = 0").collect()} == {"cms", "cms2", "the logs", "user.me"}


def test_trace_per_file(spark, rows):
    schema = (
        "meta_data struct<ts:long,jobtype:string,wn_name:string>, LFNArray array<string>, LFNArrayRef array<string>, "
        "fallbackFiles array<long>, steps array<struct<site:string,input:array<struct<lfn:long>>>>"
    )
    report = ((5, None, "w"), ["a", "b", "c"], ["lfn"], [1], [("T1_US_FNAL", [(0,), (1,)]), (None, [(2,), (None,)]), ("T2_X", None)])
    no_site = ((5, "j", "w"), ["a"], ["lfn"], [], [(None, [(0,)])])
    out = traces.access_traces(spark.createDataFrame([report, no_site], schema))
    assert rows(out, "filename", "remoteSite", "jobtype", "timestamp") == [("a", "T2_X", "unknown", 5), ("c", "T2_X", "unknown", 5)]


def test_touch_trace_keeps_null_account(spark):
    replicas = spark.createDataFrame([("cms", "f", "X", "A"), ("cms", "f", "Y", "B")], "scope string, name string, rse string, state string")
    out = traces.touch_traces(names(spark, "f"), replicas).collect()
    assert len(out) == 1 and '"account":null' in out[0]["trace"]


# --- files and streams -----------------------------------------------------------------
def test_line_counts(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"x\n\ny\n")
    (tmp_path / "b.txt").write_bytes(b"x\r\n \ny")
    (tmp_path / "empty.txt").write_bytes(b"")
    row = lists.line_counts(spark, str(tmp_path)).first()
    assert (row["files"], row["total_lines"], row["non_blank_lines"]) == (3, 4 + 3 + 1, 4)


@pytest.mark.parametrize("enough", [1, 3, 256])
def test_files_are_listed_by_tasks(spark, rows, tmp_path, monkeypatch, enough):
    from stowage.sources import listing

    monkeypatch.setattr(listing, "ENOUGH_FOLDERS", enough)
    names = ["a.txt", "x/b c+d.txt", "x/y/é.txt", "x/y/z/empty.txt", "p=%3A/_q=1/e.txt", "_hidden/f.txt", "x/.g.txt"]
    for name in names:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if "empty" in name else b"one\n\ntwo")
    listed = listing.folder_files(spark, str(tmp_path))
    assert rows(listed, "file", "size") == sorted(((str(tmp_path / n), 0 if "empty" in n else 8) for n in names[:5]), key=str)
    got = rows(lists.line_counts(spark, str(tmp_path)), "folder", "files", "total_lines", "non_blank_lines")
    assert got == sorted(((str((tmp_path / n).parent), 1, 1 if "empty" in n else 3, 0 if "empty" in n else 2) for n in names[:5]), key=str)
    assert rows(lists.line_counts(spark, f"file://{tmp_path}"), "folder", "files", "total_lines", "non_blank_lines") == got
    text = lists.line_counts(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in text and "LogicalRDD" not in text


def test_csv_needs_its_columns(spark, tmp_path):
    (tmp_path / "l.csv").write_text("FILENAME,OTHER\n/a,1\n")
    with pytest.raises(ValueError, match="RSES"):
        lists.csv_list_scan(spark, str(tmp_path / "l.csv"), ["FILENAME", "RSES"])


def test_did_glob_is_literal_elsewhere(spark, rows):
    dids = spark.createDataFrame([("/a_b/x", "C"), ("/aXb/x", "C"), ("/a_b/%", "D"), ("/a_b/y", "F")], "name string, did_type string")
    assert rows(lists.did_glob(dids, "/a_b/*")) == [("/a_b/%",), ("/a_b/x",)]


def test_failure_stream_equals_batch_up_to_the_watermark(spark, rows, tmp_path):
    data = [(f"2024-01-01 0{h}:{m:02d}:00", "transfer-failed" if m % 2 else "transfer-done", "A", "B") for h in range(6) for m in range(0, 60, 7)]
    df = spark.createDataFrame(data, "t string, event_type string, src_rse string, dst_rse string").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    got = rows(streams.run_once(streams.failure_stream(stream)))
    batch = streams.failure_stream(df).filter("window_start < timestamp '2024-01-01 04:00:00'")
    assert got and set(got) <= set(rows(streams.failure_stream(df))) and set(rows(batch.filter("window_start < timestamp '2024-01-01 03:00:00'"))) <= set(got)


def test_checkpoint_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark).startswith("file:" + spark.conf.get("spark.checkpoint.dir")) or session.shared_dir(
        spark
    ).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.scratch_path(spark, "x").startswith(session.shared_dir(spark))


def test_worker_functions_need_no_package(tmp_path):
    """What goes to Python workers loads in a process that cannot import the package."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    code = "import sys; from pyspark import cloudpickle; print(callable(cloudpickle.loads(sys.stdin.buffer.read())))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for function in (integrity._adler(), integrity._adler_sums(), integrity._check_with(None)):
        out = subprocess.run(
            [sys.executable, "-c", code], input=cloudpickle.dumps(function), capture_output=True, cwd=tmp_path, env=env, timeout=120
        )
        assert out.stdout.strip() == b"True", out.stderr[-500:]


# --- numbering between the bounds of a sketch --------------------------------------------
@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_rank_rows_matches_brute_force(spark, buckets):
    """Nulls in key and order, ties, a key with most rows, a clashing column; nothing is stored."""
    import random

    rng = random.Random(buckets)
    given = [(rng.choice(["hot"] * 6 + ["a", "b", "", None]), rng.choice([None, 1.5, rng.random()]), f"/x/{rng.randrange(400)}", i, "c") for i in range(1500)]
    df = spark.createDataFrame(given, "key string, v double, path string, id long, total_ string").repartition(5)
    ranked = ranking.rank_rows(df, ["key"], ["v", "path", "id"], buckets=buckets)
    got = {r["id"]: (r["n"], r["total"]) for r in ranked.collect()}
    want, by_key = {}, {}
    for r in given:
        by_key.setdefault(r[0], []).append(r)
    for rows_ in by_key.values():
        rows_.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        want |= {r[3]: (i + 1, len(rows_)) for i, r in enumerate(rows_)}
    assert got == want


def test_rank_rows_spreads_a_hot_key_and_stores_nothing(spark):
    df = spark.range(20000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 500)) as key", "concat('/store/data/file', id) as path")
    ranked = ranking.rank_rows(df, ["key"], ["path"], buckets=32)
    text = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in text and "Checkpoint" not in text
    bounds = ranking.sketch_bounds(df, ["key", "path"], 32)
    dealt = ranking.with_bucket(df, bounds, ["key", "path"], 32).filter("key = 'hot'").groupBy("_bucket").count().collect()
    # the bounds are one literal, no expression that each row would work out
    assert "from_json" not in text and "[hot," in text
    assert len(dealt) >= 8 and max(r["count"] for r in dealt) < 20000 / 32 * 2.5


def test_rank_rows_of_an_empty_frame(spark):
    assert ranking.rank_rows(spark.range(0), ["id"], ["id"]).collect() == []


def test_top_n_has_one_plan(spark):
    df = spark.range(3000).selectExpr("id % 2 as key", "id % 100 as v", "id", "map('a', id) as m")
    for n in (1, 5, 1200):
        got = sorted(r["id"] for r in ranking.top_n_per_key(df, ["key"], [F.col("v"), F.col("id")], n).collect())
        want = sorted(i for k in (0, 1) for _, i in sorted((j % 100, j) for j in range(3000) if j % 2 == k)[:n])
        assert got == want


def test_sizes_of_a_few_names(spark, rows):
    schema = "name string, child_name string, did_type string, child_type string"
    edges = [("top", "mid", "C", "C"), ("mid", "d1", "C", "D"), ("top", "d1", "C", "D"), ("d1", "f1", "D", "F"), ("d1", "f2", "D", "F"), ("other", "d2", "C", "D"), ("d2", "f3", "D", "F"), ("loop", "loop", "C", "C")]
    contents = spark.createDataFrame(edges, schema)
    files = spark.createDataFrame([("f1", 10), ("f2", 5), ("f3", 7)], "name string, bytes long")
    asked = spark.createDataFrame([("top",), ("top",), ("d1",), ("f3",), ("nothing",), (None,)], "name string")
    # the cycle elsewhere does not matter, as nothing asked for is above it
    assert rows(approval.did_sizes(contents, files, asked)) == [("d1", 15), ("f3", 7), ("top", 30)]


def test_weights_read_the_usage_once(spark):
    usage = spark.createDataFrame([(r, s, v) for r in ("A", "B") for s, v in (("static", 100), ("used", 50), ("expired", 5), ("unavailable", 0))], "rse string, source string, used long")
    rses = spark.createDataFrame([("A", True, "2"), ("B", True, None)], "rse string, availability_write boolean, coefficient string")
    limits = spark.createDataFrame([("A", 10)], "rse string, min_free long")
    weights = capacity.dm_weight(usage, rses, limits, 0.35, 0.35, 0.3, True)
    text = weights._jdf.queryExecution().optimizedPlan().toString()
    assert "pivot" not in text.lower() and "Join" not in text
    assert abs(sum(r["dm_weight"] for r in weights.collect()) - 100) < 1e-9


def test_files_travel_to_their_dataset_once(spark, rows, monkeypatch):
    from stowage.operators import capacity as cap

    files = spark.createDataFrame([(d, f"f{i}", i, 1) for i in range(40) for d in (["d0", "d1"] if i < 30 else ["d1", None])], "dataset string, name string, bytes bigint, events bigint")
    at = [(f"f{i}", f"r{r}", "A" if r else "U") for i in range(39) for r in range(4) for _ in range(1 + (r == 3))]
    replicas = spark.createDataFrame(at, "name string, rse string, state string")
    want = sorted(map(tuple, files.join(replicas.filter("state = 'A'"), "name").groupBy("dataset", "rse").agg({"name": "count"}).collect()), key=str)
    edges = files.select(F.col("dataset").alias("name"), F.col("name").alias("child_name"), F.lit("D").alias("did_type"), F.lit("F").alias("child_type"))
    for limit in (5, 35, 1000):
        monkeypatch.setattr(cap, "LARGE_DATASET", limit)
        by_rse = cap.dataset_summary(files, replicas)[1]
        assert rows(by_rse, "dataset", "rse", "file_count") == want
        assert rows(cap.block_replica_nodes(edges, replicas), "block") == [("d0",), ("d1",), (None,)]
    # no shuffle by endpoint for datasets of ordinary size: each endpoint row is made after the file has arrived
    plan = by_rse._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(at") < plan.index("RepartitionByExpression [dataset")


def test_endpoint_lists_travel_as_numbers(spark):
    """Also numbers of more than 16 bits come back as their names, and a file without a known endpoint leaves its block empty."""
    ends = spark.range(70_000).select(F.format_string("r%06d", "id").alias("rse"), "id")
    replicas = ends.filter("id % 3 = 0").select(F.lit("f0").alias("name"), "rse").unionByName(ends.filter("id >= 69990").select(F.lit("f1").alias("name"), "rse"))
    replicas = replicas.unionByName(spark.createDataFrame([("f2", None)], "name string, rse string")).withColumn("state", F.lit("A"))
    edges = spark.createDataFrame([("d0", "f0"), ("d0", "f1"), ("d1", "f1"), ("d2", "f2"), ("d3", "f3")], "name string, child_name string")
    out = capacity.block_replica_nodes(edges.selectExpr("*", "'D' AS did_type", "'F' AS child_type"), replicas)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("zip_with(high") < plan.index("RepartitionByExpression [dataset") and "collect_list(rse" not in plan
    last = {f"r{i:06d}" for i in range(69990, 70000)}
    whole = {r["block"]: r["rses"] for r in out.collect()}
    assert whole == {"d0": sorted(last | {f"r{i:06d}" for i in range(0, 70000, 3)}), "d1": sorted(last), "d2": []}
    files = edges.selectExpr("name AS dataset", "child_name AS name", "10L AS bytes", "1L AS events")
    by_rse = capacity.dataset_summary(files, replicas)[1]
    assert {r["rse"]: tuple(r)[2:] for r in by_rse.filter("dataset = 'd0' AND rse >= 'r069990'").collect()} == {
        r: ((2, 20, 2) if int(r[1:]) % 3 == 0 else (1, 10, 1)) for r in last
    }

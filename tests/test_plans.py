"""Plans over stored catalogue tables: what reaches the scan, which joins are chosen."""

import re

import pytest
from pyspark.sql import functions as F

from stowage import registry
from stowage.operators import capacity, containers, integrity, invalidation, placement, reconcile
from stowage.sources import lists, snapshots
from stowage.sources.testtables import Catalogue


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("catalogue"))
    n = spark.range(2000)
    text = lambda c: F.col(c).cast("string")
    frames = {
        "replicas": n.select(
            F.lit("cms").alias("scope"), F.concat(F.lit("/store/f"), text("id")).alias("name"), (F.col("id") % 20).alias("rse_id"),
            F.concat(F.lit("S"), (F.col("id") % 20).cast("string")).alias("rse"), F.lit("A").alias("state"), F.lit("ab").alias("adler32"),
            F.col("id").alias("bytes"), F.lit(0).cast("bigint").alias("tombstone"), F.lit("unused").alias("comment"),
        ),
        "locks": n.select(F.lit("cms").alias("scope"), F.concat(F.lit("/store/f"), text("id")).alias("name"), (F.col("id") % 20).alias("rse_id"), F.col("id").alias("rule_id"), F.lit("S").alias("state"), F.col("id").alias("bytes"), F.lit("unused").alias("comment")),
        "rules": n.select(F.col("id").alias("rule_id"), F.lit("U").alias("state"), F.lit("x").alias("error"), F.lit("/C").alias("name"), F.lit("D").alias("did_type")),
        "rses": spark.range(20).select(F.col("id").alias("rse_id"), F.concat(F.lit("S"), text("id")).alias("rse"), F.lit("TAPE").alias("rse_type")),
        "contents": n.select(F.lit("/C").alias("name"), F.concat(F.lit("/C#"), text("id")).alias("child_name"), F.lit("C").alias("did_type"), F.lit("D").alias("child_type")),
    }
    for name, df in frames.items():
        snapshots.write_snapshot(df, base, "2024-01-01", name)
    return base, {name: snapshots.snapshot_scan(spark, base, "2024-01-01", name) for name in frames}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, stored):
    _, t = stored
    text = plan(invalidation.stuck_tape_files(t["locks"], t["replicas"], t["rules"], t["rses"]))
    assert "EqualTo(state,S)" in text and "EqualTo(rse_type,TAPE)" in text and "In(state, [C,U])" in text
    assert "IsNotNull(error)" in text and invalidation.DESTINATION_EXISTS in text
    assert "comment" not in text


def test_one_endpoint_filter_sits_below_the_join(spark, stored):
    _, t = stored
    assert "EqualTo(rse,S3)" in plan(invalidation.replicas_with_rse(t["replicas"], t["rses"], "S3"))


def test_prefixes_reach_the_scan(spark, stored):
    _, t = stored
    assert "StringStartsWith(name,/C1)" in plan(reconcile.name_prefix_scan(t["contents"], "C1"))
    assert "StringStartsWith(name,/store/f1)" in plan(lists.did_glob(t["replicas"].withColumn("did_type", F.lit("F")), "/store/f1*", "file"))


def test_day_is_pruned(spark, tmp_path):
    df = spark.range(10).select("id", F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).alias("day"))
    df.write.partitionBy("day").parquet(f"{tmp_path}/t")
    out = snapshots.snapshot_days(spark, str(tmp_path), "t").filter("day = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(day" in plan(out) and out.count() == 3


def test_lookup_side_is_broadcast_only_while_small(spark, stored):
    _, t = stored
    assert "BroadcastHashJoin" in plan(invalidation.locks_with_rse(t["locks"], t["rses"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(invalidation.locks_with_rse(t["locks"], t["rses"]))
        assert "SortMergeJoin" in text and "Broadcast" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_block_diff_shuffles_each_side_once(spark, stored):
    _, t = stored
    side = t["contents"].select(F.lit("s").alias("site"), F.col("child_name").alias("block"), F.lit(1).alias("n_files"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = t["replicas"].select(F.lit("s").alias("site"), F.col("name").alias("block"), F.lit(1).alias("n_files"))
        text = plan(reconcile.site_block_diff(side, other))
        assert text.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_safe_upsert_is_a_hash_join(spark):
    cols = "request_id string, scope string, lfn string, rse string, pfn string, status string"
    old = spark.createDataFrame([("r", "cms", "f", None, None, "pending")], cols)
    results = spark.createDataFrame(
        [("r", "f", None, [("X", "p", "OK")])],
        "request_id string, filename string, error string, replicas array<struct<rse:string,pfn:string,status:string>>",
    )
    text = plan(integrity.integrity_upsert(old, results))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_totals_are_scalars_not_single_task_windows(spark):
    wide = spark.createDataFrame([("a", 1), ("b", 3)], "rse string, static long")
    text = plan(capacity.share_of_total(wide))
    assert "Window" not in text and "Subquery" in text


def test_hot_join_key_is_split(spark, tmp_path):
    """One file name with a third of all locks: the adaptive plan splits its partition."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    rows = spark.range(60000)
    name = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id").cast("string")))
    rows.select(name.alias("name"), F.col("id").alias("rule_id"), F.lit("X").alias("rse"), F.md5(F.col("id").cast("string")).alias("pad")).repartition(6).write.parquet(f"{tmp_path}/locks")
    rows.select(name.alias("name"), F.lit("X").alias("rse")).distinct().write.parquet(f"{tmp_path}/replicas")
    for key, value in confs.items():
        spark.conf.set(key, value)
    try:
        locks, replicas = spark.read.parquet(f"{tmp_path}/locks"), spark.read.parquet(f"{tmp_path}/replicas")
        out = locks.join(replicas, ["name", "rse"]).groupBy("name").agg(F.count("pad").alias("n"))
        assert out.count() == 40001
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in confs:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_scan_is_split_so_that_grouping_its_rows_fits_a_task(spark, tmp_path):
    """Grouping by a key that hardly repeats holds a split's rows; a split stays small whatever the size of the table."""
    rows = spark.range(9_000_000).select(F.xxhash64("id").alias("k"))
    rows.coalesce(1).write.option("compression", "none").option("parquet.block.size", 4 << 20).parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        assert spark.read.parquet(f"{tmp_path}/t").rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_levels_of_an_invalidation_shuffle_the_locks_once(spark, stored):
    _, t = stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        contents = t["contents"].unionByName(t["contents"].select(F.col("child_name").alias("name"), F.concat(F.lit("/store/f"), F.split("child_name", "#")[1]).alias("child_name"), F.lit("D").alias("did_type"), F.lit("F").alias("child_type")))
        tables = contents, t["replicas"].select("name", "rse"), t["locks"].join(t["rses"].select("rse_id", "rse"), "rse_id")
        whole = invalidation.invalidate_containers(spark.createDataFrame([("/C",)], "name string"), *tables)
        single = invalidation.invalidate_files(t["replicas"].select("name"), *tables, t["rules"])
        out = whole["rules"].unionByName(single["rules_stuck"].select("rule_id", F.lit("").alias("rse")))
        assert len(out.collect()) == 4000
        scans = [line for line in plan(out).split("== Initial Plan")[0].splitlines() if "FileScan" in line and "ReadSchema: struct<name:string,rse_id:bigint,rule_id:bigint" in line]
        assert len(scans) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_views_over_orders_shuffle_their_rows_once(spark, no_broadcast):
    c = Catalogue(spark, "/root/testdata/sf0.001")
    assert "hashpartitioning(l_orderkey#" in plan(c.contents.filter("did_type = 'D'"))
    assert not re.search(r"hashpartitioning\(l_orderkey#\d+L, l_partkey#", plan(c.contents.filter("did_type = 'D'")))
    held = plan(c.locks.select("rule_id", "name").join(c.rules.select("rule_id"), "rule_id", "left_semi"))
    assert held.count("Exchange hashpartitioning") == 2


def test_rules_of_an_invalidation_join_by_rule_without_a_second_shuffle(spark, stored, no_broadcast):
    _, t = stored
    tables = t["contents"], t["replicas"].select("name", "rse"), t["locks"].join(t["rses"].select("rse_id", "rse"), "rse_id")
    by_file = invalidation.invalidate_files(t["replicas"].select("name"), *tables, t["rules"])
    by_set = invalidation.invalidate_datasets(t["contents"].select("name"), *tables, t["rules"])
    for df in (by_file["rules"], by_file["rules_stuck"], by_set["rules"]):
        assert not re.search(r"hashpartitioning\(rule_id#\d+L, rse#", plan(df))
        assert len(re.findall(r"Exchange hashpartitioning\(rule_id#", plan(df))) == 2


def test_sources_are_named_before_their_join(spark, stored, no_broadcast):
    _, t = stored
    text = plan(placement.source_copy_plan(t["contents"], t["replicas"])).splitlines()
    line = lambda word: next(i for i, x in enumerate(text) if word in x)
    assert line("SortMergeJoin") < line("_Input")


def test_parents_of_tape_hints_are_found_once(spark, stored):
    _, t = stored
    files = t["replicas"].select("name", "bytes", F.lit("").alias("md5"), "adler32", F.lit(None).cast("string").alias("activity"))
    out = containers.tape_hints(files, t["contents"], files.select("name", "bytes"))
    assert any("/parents-" in f for f in out.inputFiles())
    assert not any("/contents/" in f for f in out.inputFiles())


def test_early_reasons_are_found_once_and_only_open_requests_travel(spark, no_broadcast):
    from stowage import registry

    out = registry.queries()["rule_request_decision"](spark, "/root/testdata/sf0.001")
    assert any("/judged-" in f for f in out.inputFiles())
    assert "IsNull(early)" in plan(out) and "IsNotNull(early)" in plan(out)


def test_sets_of_endpoints_are_built_once_for_all_lists(spark, no_broadcast):
    from stowage import registry

    out = registry.queries()["invalidate_containers"](spark, "/root/testdata/sf0.001")
    assert any("/held-" in f for f in out.inputFiles())
    assert "collect_set" not in plan(out)


def test_members_are_not_shuffled_to_the_few_files_without_a_replica(spark, stored):
    _, t = stored
    edges = t["contents"].select(F.col("child_name").alias("name"), F.concat(F.lit("/store/f"), F.split("child_name", "#")[1]).alias("child_name"), F.lit("D").alias("did_type"), F.lit("F").alias("child_type"))
    replicas = t["replicas"].select("name", "rse").filter("name <> '/store/f7'")
    out = invalidation.invalidate_containers(spark.createDataFrame([("/C",)], "name string"), t["contents"].unionByName(edges), replicas, t["locks"].withColumn("rse", F.lit("S1")), stored=True)
    assert out["datasets"].count() == 1999
    assert "LeftAnti, BuildRight" in plan(out["datasets"])
    assert "hashpartitioning(file#" not in plan(out["datasets"])


def test_plan_by_mode_is_made_of_stored_steps(spark):
    """Locks and contents are not shuffled beside each other in one plan: only the last replicas are looked up there."""
    out = registry.queries()["invalidation_plan_by_mode"](spark, "/root/testdata/sf0.001")
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(out).split("== Initial Plan ==")[0])
    assert sum("l_partkey" in s for s in scans) == 1 and not any("l_orderkey" in s for s in scans)

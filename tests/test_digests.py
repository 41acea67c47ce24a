"""Reconciliation by digests: equal to the full outer join, and equal buckets are not read."""

import glob
import random

import pytest

from stowage.operators import digests, reconcile

BLOCKS = "site string, block string, n_files bigint"


def inventory(spark, path, rows, buckets=32):
    return digests.write_inventory(spark.createDataFrame(rows, BLOCKS).repartition(3), str(path), "site", "block", ["n_files"], buckets)


def two_lists(rng, n, changes):
    base = {(rng.choice(["hot", "hot", "a", "b", None]), f"/b{i}"): rng.randrange(5) for i in range(n)}
    other = dict(base)
    for key in rng.sample(sorted(base, key=str), changes):
        kind = rng.randrange(3)
        if kind == 0:
            del other[key]
        elif kind == 1:
            other[key] = rng.choice([other[key] + 1, None])
        else:
            other[(key[0], key[1] + "-new")] = 1
    return [[(*k, v) for k, v in side.items()] for side in (base, other)]


@pytest.mark.parametrize("changes", [0, 4, 300])
def test_equal_to_the_full_join(spark, tmp_path, rows, changes):
    left, right = two_lists(random.Random(changes), 600, changes)
    # sites without a name match nobody in the join, so they are left out of the comparison
    left, right = ([r for r in side if r[0] is not None] for side in (left, right))
    a, b = inventory(spark, tmp_path / "a", left), inventory(spark, tmp_path / "b", right)
    full = reconcile.site_block_diff(spark.createDataFrame(left, BLOCKS), spark.createDataFrame(right, BLOCKS))
    assert rows(digests.incomplete_blocks(spark, a, b).select(full.columns)) == rows(full.filter("label <> 'complete'"))
    assert rows(digests.block_summary(spark, a, b)) == rows(reconcile.site_block_diff_summary(full))


def test_equal_buckets_are_not_read(spark, tmp_path):
    left, right = two_lists(random.Random(1), 800, 0)
    right[5] = (*right[5][:2], 99)
    a, b = inventory(spark, tmp_path / "a", left), inventory(spark, tmp_path / "b", right)
    same = digests.compared_buckets(spark, a, b)
    (bucket,) = [r.bucket for r in same.collect() if not r.same]
    for side in (0, 1):
        text = digests.rows_that_may_differ(spark, a, b)[side]._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(bucket" in text and f" = {bucket})" in text
    # what is not read may be anything
    for name in glob.glob(f"{tmp_path}/*/rows/bucket=*/*.parquet"):
        if f"bucket={bucket}/" not in name:
            with open(name, "wb") as out:
                out.write(b"gone")
    for crc in glob.glob(f"{tmp_path}/*/rows/bucket=*/.*.crc"):
        if f"bucket={bucket}/" not in crc:
            open(crc, "wb").close()
    (row,) = digests.incomplete_blocks(spark, a, b).collect()
    assert row.label == "incomplete" and row.n_catalogue == 99


def test_order_and_repeats(spark, tmp_path):
    """Digests do not depend on the order of rows, and tell one row from two."""
    some = [("s", f"b{i % 7}", i) for i in range(20)]
    a = inventory(spark, tmp_path / "a", some)
    b = inventory(spark, tmp_path / "b", some[::-1])
    c = inventory(spark, tmp_path / "c", some + some[:1])
    assert all(r.same for r in digests.compared_buckets(spark, a, b).collect())
    assert sum(not r.same for r in digests.compared_buckets(spark, a, c).collect()) == 1
    with pytest.raises(ValueError):
        digests.compared_buckets(spark, a, digests.Inventory(b.path, "site", "block", ("n_files",), 64))


def test_empty_sides(spark, tmp_path, rows):
    a = inventory(spark, tmp_path / "a", [("s", "b", 1)])
    b = digests.write_inventory(spark.createDataFrame([("t", "c", 1)], BLOCKS), str(tmp_path / "b"), "site", "block", ["n_files"], 32)
    assert rows(digests.incomplete_blocks(spark, a, b), "site", "label") == [("s", "not_in_catalogue"), ("t", "not_in_source")]
    assert digests.incomplete_blocks(spark, a, a).collect() == []

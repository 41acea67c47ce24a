"""Nested contents: sizes of containers, parents, tape hints.

Nesting has no fixed depth.  A loop goes up one level per pass and keeps only aggregates
between passes, each in the checkpoint folder; collections that contain themselves are named.  (The
recursive SQL of Spark is limited in rows, so it does not fit tables of this size.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..session import cut_lineage, keep_table


def _climb(level: DataFrame, step) -> DataFrame:
    """Union of ``level`` and of all levels above it, until ``step``, which leaves out what was seen, gives no rows."""
    out = level = cut_lineage(level)
    while True:
        level = cut_lineage(step(level, out))
        if level.isEmpty():
            return out
        out = out.unionByName(level)


def _cycle(edges: DataFrame) -> ValueError:
    """The error that names collections that contain themselves.  ``edges`` (node, parent) is what no round could settle.

    Collections that nothing holds are taken away until none is left: what stays lies on cycles, or between two of them.
    """
    left = edges.count()
    while True:
        held = edges.select(F.col("node").alias("parent")).distinct()
        edges = keep_table(edges.join(held, "parent", "left_semi").select("node", "parent"), "cycle")
        before, left = left, edges.count()
        if left == before:
            break
    members = edges.select("node").distinct()
    named = [r[0] for r in members.orderBy("node").limit(20).collect()]
    return ValueError(f"contents contain themselves: {members.count()} collections, {', '.join(named)}")


def _peel(first: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, length, size) summed upward through ``edges`` (node, parent).

    Each round settles the collections whose children are all settled: those that are no parent in what is left of the
    edges.  Their totals go to their parents once, and their edges go.  There are as many rounds as levels.  A round that
    takes no edge away while some are left has met a cycle, whatever the number of collections.  What a round hands on and
    what it leaves are stored with their sizes, so that the next one broadcasts what has become small.
    """
    sums = F.sum("length").alias("length"), F.sum("size").alias("size")
    given, edges = keep_table(first, "sums"), keep_table(edges, "edges")
    left = edges.count()
    while left:
        parents = edges.select(F.col("parent").alias("node")).distinct()
        ready = edges.join(parents, "node", "left_anti")
        up = given.join(ready, "node").groupBy(F.col("parent").alias("node")).agg(*sums)
        rest = keep_table(edges.join(parents, "node", "left_semi"), "edges")
        before, left = left, rest.count()
        if left == before:
            raise _cycle(edges)
        given, edges = given.unionByName(keep_table(up, "sums")), rest
    return given.groupBy("node").agg(*sums)


def _nested(contents: DataFrame) -> DataFrame:
    return contents.filter("child_type <> 'F'").select(F.col("child_name").alias("node"), F.col("name").alias("parent"))


def _held_sums(held: DataFrame, files: DataFrame) -> DataFrame:
    """Number and bytes of the files that collections hold themselves."""
    size = files.select(F.col("name").alias("child_name"), "bytes")
    return (
        held.join(size, "child_name", "left")
        .groupBy(F.col("name").alias("node"))
        .agg(F.count(F.lit(1)).alias("length"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("size"))
    )


def container_stats(contents: DataFrame, files: DataFrame, distinct: bool = False) -> DataFrame:
    """Number and bytes of the files below every collection, through all levels.  Runs a few
    jobs per level.

    A file attached twice counts twice unless ``distinct``.  The first way moves sums only:
    files shrink to datasets in the first aggregate, datasets to containers in the next.
    """
    held = contents.filter("child_type = 'F'").select("name", "child_name")
    if not distinct:
        return _peel(_held_sums(held, files), _nested(contents)).withColumnRenamed("node", "name")
    return _distinct_sums(held, _nested(contents), files)


def _distinct_sums(held: DataFrame, edges: DataFrame, files: DataFrame) -> DataFrame:
    """(name, length, size) of all files below a collection, each counted once.

    The levels are climbed by collections alone, not by their files: ``above`` has all collections over a collection, and
    a file goes to those in one join.  A collection that holds no other counts its files where they were joined; only
    those with something below need one more shuffle, by (collection, file), to find what comes in twice.
    """
    edges = keep_table(edges.filter("node IS NOT NULL").distinct(), "edges")
    up = lambda level, seen: (
        level.join(edges.select(F.col("node").alias("above"), "parent"), "above")
        .select("node", F.col("parent").alias("above"))
        .distinct()
        .join(seen, ["node", "above"], "left_anti")
    )
    # the name as a struct, which is never null: the two joins add no filter of their own and read one shuffle
    key = lambda c: F.struct(F.col(c).alias("name")).alias("key")
    over = edges.select("parent").distinct()
    above = _climb(edges.select("node", F.col("parent").alias("above")), up).unionByName(over.select(F.col("parent").alias("node"), F.col("parent").alias("above")))
    # a name that is listed twice counts twice, as where the list is joined last
    known = files.groupBy(F.col("name").alias("child_name")).agg(F.count(F.lit(1)).alias("copies"), F.sum("bytes").alias("bytes"))
    rows = held.join(known, "child_name", "left").select(key("name"), "child_name", "copies", "bytes").repartition("key").distinct()
    sums = F.sum(F.coalesce("copies", F.lit(1))).alias("length"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("size")
    # by a mark: an anti join would be moved below the shuffle
    own = rows.join(over.select(key("parent"), F.lit(True).alias("holds")), "key", "left").filter("holds IS NULL").groupBy("key").agg(*sums).select("key.name", "length", "size")
    below = rows.join(above.select(key("node"), "above"), "key").select(F.col("above").alias("name"), "child_name", "copies", "bytes")
    return own.unionByName(below.distinct().groupBy("name").agg(*sums))


def _reached(nested: DataFrame, names: DataFrame) -> DataFrame:
    """(name) of ``names`` and of all collections below them; ``nested`` (node, parent).  Runs one job per level."""
    level = met = keep_table(names.select("name").distinct(), "below")
    while True:
        below = nested.join(level, nested["parent"] == level["name"], "left_semi").select(F.col("node").alias("name")).distinct()
        level = keep_table(below.join(met, "name", "left_anti"), "below")
        if level.isEmpty():
            return met
        met = met.unionByName(level)


def stats_of(names: DataFrame, contents: DataFrame, files: DataFrame) -> DataFrame:
    """``container_stats`` of ``names`` (name) alone.  Runs a few jobs per level.

    Names come first: the way goes down from them and sums only what lies there.  ``contents`` is read twice, for its
    nesting, which is stored, and for the files of the collections met; that list is stored with its size too, and Spark
    broadcasts it while it is small, so that a few names do not shuffle the contents.
    """
    nested = keep_table(_nested(contents), "nested")
    met = _reached(nested, names)
    held = contents.filter("child_type = 'F'").select("name", "child_name").join(met, "name", "left_semi")
    sums = _peel(_held_sums(held, files), nested.join(met.withColumnRenamed("name", "parent"), "parent", "left_semi").select("node", "parent"))
    return sums.withColumnRenamed("node", "name").join(names.select("name").distinct(), "name", "left_semi")


def rule_chain_closure(rules: DataFrame, start: DataFrame) -> DataFrame:
    """(key, protocol) reachable from ``start`` through ``chain`` columns of path rules.

    ``rules`` is (key, protocol, chain) with one key per endpoint; runs one job per level.
    """
    edges = rules.filter("chain IS NOT NULL").select("key", "protocol", "chain").distinct()
    up = lambda level, seen: (
        level.join(edges, ["key", "protocol"])
        .select("key", F.col("chain").alias("protocol"))
        .distinct()
        .join(seen, ["key", "protocol"], "left_anti")
    )
    return _climb(start.select("key", "protocol").distinct(), up)


def children_by_parent(edges: DataFrame, chunk: int = 500) -> DataFrame:
    """Parent -> lists of at most ``chunk`` children, as they are attached call by call.

    The children of one parent may be a large part of the table, so they are numbered over
    many tasks first and only a chunk meets in one row.
    """
    from .ranking import block_chunks

    packed = block_chunks(edges.select("name", "child_name"), ["name"], ["child_name"], chunk)
    return packed.groupBy("name", "chunk").agg(F.array_sort(F.collect_list("child_name")).alias("children"))


def tape_parent(files: DataFrame, contents: DataFrame) -> DataFrame:
    """Container of each file's dataset; the smallest name where there are several."""
    datasets = (
        contents.filter("did_type = 'D' AND child_type = 'F'")
        .join(files.select(F.col("name").alias("child_name")), "child_name", "left_semi")
        .groupBy(F.col("child_name").alias("file"))
        .agg(F.min("name").alias("dataset"))
    )
    containers = (
        contents.filter("did_type = 'C' AND child_type = 'D'")
        .groupBy(F.col("child_name").alias("dataset"))
        .agg(F.min("name").alias("parent"))
    )
    return datasets.join(containers, "dataset").select(F.col("file").alias("name"), "parent")


def tape_hints(files: DataFrame, contents: DataFrame, sizes: DataFrame) -> DataFrame:
    """Placement hints per file to be written to tape.

    ``files`` is (name, bytes, md5, adler32, activity) and ``sizes`` all known files (name,
    bytes).  ``collocation_hints`` has the keys 0-3 that are known; a file of no known type
    has key 0 only.  Runs jobs: the files' containers are stored, and only what lies under them is summed, level by level.
    """
    # stored, as the way down from the parents and the hints both ask for it: a row per file
    parents = keep_table(tape_parent(files, contents), "parents")
    stats = stats_of(parents.select(F.col("parent").alias("name")), contents, sizes).select(
        F.col("name").alias("parent"), F.col("length").alias("parent_length"), F.col("size").alias("parent_size")
    )
    kind = N.tape_data_type("name")
    known = kind != "n/a"
    pairs = F.array(
        F.struct(F.lit("0").alias("key"), kind.alias("value")),
        F.struct(F.lit("1").alias("key"), F.when(known, N.tape_tier("name")).alias("value")),
        F.struct(F.lit("2").alias("key"), F.when(known, N.tape_era("name")).alias("value")),
        F.struct(F.lit("3").alias("key"), F.when(known, F.col("parent")).alias("value")),
    )
    return (
        files.join(parents, "name", "left")
        .join(stats, "parent", "left")
        .select(
            "name",
            F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())).alias("collocation_hints"),
            F.struct(
                F.coalesce("activity", F.lit("default")).alias("activity"),
                F.when(known & F.col("parent").isNotNull(), F.struct(
                    F.coalesce("parent_length", F.lit(0)).alias("length"), F.coalesce("parent_size", F.lit(0)).alias("size")
                )).alias("level_3"),
            ).alias("additional_hints"),
            F.struct(F.coalesce("bytes", F.lit(0)).alias("size"), "md5", "adler32").alias("file_metadata"),
            F.lit(1).alias("schema_version"),
        )
    )


def tape_family_of(contents: DataFrame) -> DataFrame:
    """Dataset -> distinct tape directories with their family, from its files' paths."""
    files = contents.filter("did_type = 'D' AND child_type = 'F'")
    tag = N.tape_tag("name")
    label = N.part(F.split("child_name", "/"), 3)
    return files.select(
        F.col("name").alias("dataset"),
        N.tape_directory("child_name", tag).alias("path"),
        N.tape_family(tag, label).alias("family"),
    ).distinct()

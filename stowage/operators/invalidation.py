"""What an invalidation touches: files, replicas, datasets and rules.

Each output is its own short join chain ending in one aggregate.  Nothing multiplies
containers by replicas by locks first, so a file with very many locks costs its locks
once.  Lookup sides carry no broadcast hint: Spark broadcasts them only while their
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges (with
skew splitting) beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep_table

# One-letter states of the catalogue.
REPLICA_AVAILABLE = "A"
REPLICA_TEMPORARY_UNAVAILABLE = "T"
RULE_SUSPENDED = "U"
RULE_WAITING_APPROVAL = "W"
OPEN_RULE_STATES = ("R", "S", "U", "I", "W")
LOCK_REPLICATING = "R"
# Fixed value: the one transfer error that a finished tape copy can leave behind.
DESTINATION_EXISTS = (
    "RequestErrMsg.TRANSFER_FAILED:DESTINATION [17] Destination file exists and overwrite is not enabled"
)


# --- lookups with endpoint names -----------------------------------------------------
def locks_with_rse(locks: DataFrame, rses: DataFrame) -> DataFrame:
    """Locks with the endpoint name; locks at unknown endpoints drop out."""
    return locks.select("name", "rse_id", "rule_id", F.col("state").alias("lock_state"), "bytes").join(
        rses.select("rse_id", "rse"), "rse_id"
    )


def replicas_with_rse(replicas: DataFrame, rses: DataFrame, rse: str | None = None) -> DataFrame:
    """Replicas with the endpoint name and the tombstone (epoch ms) as a day, at one
    endpoint if ``rse`` is given (exact name)."""
    named = rses.select("rse_id", "rse")
    if rse is not None:
        named = named.filter(F.col("rse") == rse)
    return replicas.select(
        "rse_id",
        "name",
        "bytes",
        F.col("state").alias("replica_state"),
        F.date_format(F.timestamp_millis("tombstone"), "yyyy-MM-dd").alias("tombstone"),
    ).join(named, "rse_id")


def container_dataset_file(contents: DataFrame) -> DataFrame:
    """(container, dataset, file); a dataset without files keeps one row with a null file."""
    datasets = _edges(contents, "C", "D").select(F.col("name").alias("container"), F.col("child_name").alias("dataset"))
    files = _edges(contents, "D", "F").select(F.col("name").alias("dataset"), F.col("child_name").alias("file"))
    return datasets.join(files, "dataset", "left").select("container", "dataset", "file")


def replica_rse_list(replicas: DataFrame) -> DataFrame:
    """One row per file: its endpoints as a sorted ``;`` list without repeats.

    A set of endpoint names is bounded by the number of endpoints, whatever the number
    of rows of a file, and is built partially before the shuffle.
    """
    return replicas.groupBy("name").agg(F.array_join(F.array_sort(F.collect_set("rse")), ";").alias("rses"))


# --- invalidation lists --------------------------------------------------------------
def _edges(contents: DataFrame, parent: str, child: str) -> DataFrame:
    return contents.filter((F.col("did_type") == parent) & (F.col("child_type") == child))


def _members(names: DataFrame, contents: DataFrame, level: str) -> DataFrame:
    """(dataset, file) edges below the listed names of one level.

    Only datasets that sit in a container count.  All steps are semi joins: an edge appears
    once however many containers hold its dataset.
    """
    wanted = names.select(F.col("name").alias(level))
    sets = _edges(contents, "C", "D").select(F.col("name").alias("container"), F.col("child_name").alias("dataset"))
    held = _edges(contents, "D", "F").select(F.col("name").alias("dataset"), F.col("child_name").alias("file"))
    if level == "file":
        held = held.join(wanted, "file", "left_semi")
    else:
        sets = sets.join(wanted, level, "left_semi")
    return held.join(sets.select("dataset"), "dataset", "left_semi")


def _names(members: DataFrame) -> DataFrame:
    return members.select(F.col("file").alias("name")).distinct()


def _held(listed: DataFrame, replicas: DataFrame) -> DataFrame:
    """(name, at): the listed names that have a replica, with the set of their endpoints.

    All lazy lists are made from this one frame, in the same form, so that the tables are shuffled by name once and the
    shuffles are used again; snapshots that are bucketed by name are not shuffled at all.
    """
    found = replicas.select("name", "rse").join(listed, "name", "left_semi")
    return found.groupBy("name").agg(F.collect_set("rse").alias("at"))


def _store_held(listed: DataFrame, replicas: DataFrame) -> DataFrame:
    """(name, at, held): the listed names, stored, with the set of their endpoints where they have a replica.  Runs a job."""
    sets = listed.join(_held(listed, replicas), "name", "left")
    return keep_table(sets.withColumn("held", F.col("at").isNotNull()), "held")


def _names_of(held: DataFrame) -> DataFrame:
    # asks for the sets, as all lazy lists do: a frame without them would be another shuffle
    return held.filter(F.size("at") >= 0).select("name")


def _rse_lists(held: DataFrame) -> DataFrame:
    return held.select("name", F.array_join(F.array_sort("at"), ";").alias("rses"))


def _locks_on(held: DataFrame, locks: DataFrame) -> DataFrame:
    """(rule_id, rse) per lock on an existing replica of the named files.

    A lock without a rule is left out before the shuffle at every level: the levels that join the rules would ask for it
    there anyway, and a plan over several levels then shuffles the locks once.
    """
    found = locks.select("name", "rse", "rule_id").filter("rule_id IS NOT NULL").join(held, "name").filter(F.array_contains("at", F.col("rse")))
    return found.select("rule_id", "rse")


def _rules_on(held: DataFrame, locks: DataFrame) -> DataFrame:
    """Distinct (rule, endpoint) of locks on existing replicas of the named files."""
    return _locks_on(held, locks).distinct()


def _rule_sets_on(held: DataFrame, locks: DataFrame) -> DataFrame:
    """(rule_id, at): the same with a rule's endpoints as a set, so that the rules join without another shuffle."""
    return _locks_on(held, locks).groupBy("rule_id").agg(F.collect_set("rse").alias("at"))


def _each_endpoint(sets: DataFrame) -> DataFrame:
    return sets.select("rule_id", F.explode("at").alias("rse"))


def invalidate_containers(
    names: DataFrame, contents: DataFrame, replicas: DataFrame, locks: DataFrame, stored: bool = False
) -> dict[str, DataFrame]:
    """Lists for whole containers.  ``replicas`` and ``locks`` carry endpoint names.

    ``files``, ``replicas`` (file, ``;`` list), ``datasets``, ``rules`` (rule, endpoint).
    A file without any replica is left out of all four.

    With ``stored`` the members and the files' sets of endpoints are worked out once and stored, which runs jobs; without
    it the lists are lazy, and each builds the sets again.
    """
    members = _members(names, contents, "container")
    if stored:
        # both uses of the names ask for known files, so that they are shuffled once
        members = keep_table(members, "members").filter("file IS NOT NULL")
        found = _store_held(_names(members), replicas)
        # mostly few: stored apart, so that their size is known before the members are shuffled to them
        missing = keep_table(found.filter("NOT held").select(F.col("name").alias("file")), "missing")
        held = found.filter("held")
        return {
            "files": held.select("name"),
            "replicas": _rse_lists(held),
            "datasets": members.join(missing, "file", "left_anti").select(F.col("dataset").alias("name")).distinct(),
            "rules": _rules_on(held.select("name", "at"), locks),
        }
    held = _held(_names(members), replicas)
    return {
        "files": _names_of(held),
        "replicas": _rse_lists(held),
        "datasets": members.join(_names_of(held).withColumnRenamed("name", "file"), "file", "left_semi")
        .select(F.col("dataset").alias("name"))
        .distinct(),
        "rules": _rules_on(held, locks),
    }


def invalidate_datasets(
    names: DataFrame, contents: DataFrame, replicas: DataFrame, locks: DataFrame, rules: DataFrame
) -> dict[str, DataFrame]:
    """Lists for datasets; only rules set on datasets or files are to be deleted."""
    held = _held(_names(_members(names, contents, "dataset")), replicas)
    return {
        "files": _names_of(held),
        "replicas": _rse_lists(held),
        "rules": _each_endpoint(_rule_sets_on(held, locks).join(rules_by_did_type(rules, ("D", "F")).select("rule_id"), "rule_id", "left_semi")),
    }


def invalidate_files(
    names: DataFrame, contents: DataFrame, replicas: DataFrame, locks: DataFrame, rules: DataFrame, stored: bool = False
) -> dict[str, DataFrame]:
    """Lists for single files.  A listed file that is in a dataset stays in ``replicas``
    with an empty list when it has no replica.  File-level rules go; suspended rules are
    to be tried again.

    With ``stored`` the listed names, their sets of endpoints and the sets of the rules on them are stored one after the
    other, which runs jobs: what the tables shuffle on the way is then held for one step at a time.
    """
    listed = _names(_members(names, contents, "file"))
    if stored:
        found = _store_held(keep_table(listed, "listed"), replicas)
        lists = _rse_lists(found).select("name", F.coalesce("rses", F.lit("")).alias("rses"))
        touched = keep_table(_rule_sets_on(found.filter("held").select("name", "at"), locks), "touched")
    else:
        held = _held(listed, replicas)
        lists = listed.join(_rse_lists(held), "name", "left").select("name", F.coalesce("rses", F.lit("")).alias("rses"))
        # both lists of rules ask for the sets: without them it would be another shuffle
        touched = _rule_sets_on(held, locks).filter(F.size("at") > 0)
    return {
        "replicas": lists,
        "rules": _each_endpoint(touched.join(rules_by_did_type(rules, ("F",)).select("rule_id"), "rule_id", "left_semi")),
        "rules_stuck": touched.select("rule_id").join(rules_suspended(rules), "rule_id", "left_semi"),
    }


def last_replica_files(targets: DataFrame, replicas: DataFrame, states=("A", "T")) -> DataFrame:
    """Flag target files (``name``, ``rses`` as ``;`` list) whose listed endpoints hold
    every valid replica left.  A file without any replica at all is never flagged."""
    wanted = targets.select("name", F.explode(F.split("rses", ";")).alias("rse")).distinct()
    known = replicas.join(targets.select("name"), "name", "left_semi").select("name", "rse", "state")
    survives = F.col("state").isin(*states) & F.col("hit").isNull()
    verdict = (
        known.join(wanted.withColumn("hit", F.lit(True)), ["name", "rse"], "left")
        .groupBy("name")
        .agg((~F.bool_or(survives)).alias("last"))
    )
    return targets.join(verdict, "name", "left").select(
        "name", "rses", F.coalesce("last", F.lit(False)).alias("last_replica")
    )


def bad_replica_triage(requests: DataFrame, replicas: DataFrame, bad: DataFrame, status: str = "BAD") -> DataFrame:
    """Per requested (rse, scope, name): ``declare``, ``Already declared`` or ``Unknown
    replica``.  A suspicious declaration is accepted for any existing replica."""
    key = ["rse", "scope", "name"]
    mark = lambda df, col: df.select(*key).distinct().withColumn(col, F.lit(True))
    exists, declared = F.col("present").isNotNull(), F.col("declared").isNotNull()
    accept = exists if status == "SUSPICIOUS" else exists & ~declared
    return (
        requests.join(mark(replicas, "present"), key, "left")
        .join(mark(bad, "declared"), key, "left")
        .withColumn(
            "outcome",
            F.when(accept, "declare").when(declared, "Already declared").otherwise("Unknown replica"),
        )
        .drop("present", "declared")
    )


# --- rules ---------------------------------------------------------------------------
def rules_by_state_age(rules: DataFrame, state: str, now: Column, days: int = 7, rse: str | None = None) -> DataFrame:
    """Rules in ``state`` (``ALL`` = every unfinished state) made more than ``days`` days
    before ``now``, and with ``rse`` somewhere in the endpoint expression if given."""
    states = OPEN_RULE_STATES if state == "ALL" else (state,)
    keep = F.col("state").isin(*states) & (F.col("created_at") < now - F.make_dt_interval(F.lit(days)))
    if rse:
        keep &= F.col("rse_expression").contains(rse)
    return rules.filter(keep).select("rule_id", "account", "name", "updated_at", "rse_expression")


def rules_by_did_type(rules: DataFrame, types=("D", "F")) -> DataFrame:
    return rules.filter(F.col("did_type").isin(*types)).select("rule_id", "name", "did_type")


def rules_suspended(rules: DataFrame) -> DataFrame:
    return rules.filter(F.col("state") == RULE_SUSPENDED).select("rule_id").distinct()


def rules_waiting_approval(ids: DataFrame, rules: DataFrame) -> DataFrame:
    """Label listed rule ids: approve, not_needed or unknown."""
    return ids.join(rules.select("rule_id", "state"), "rule_id", "left").select(
        "rule_id",
        F.when(F.col("state").isNull(), "unknown")
        .when(F.col("state") == RULE_WAITING_APPROVAL, "approve")
        .otherwise("not_needed")
        .alias("decision"),
    )


def rules_touching_rse(rules: DataFrame, rule_rses: DataFrame, rse: str) -> DataFrame:
    """Rules waiting for approval whose endpoint set (one row per rule and endpoint)
    contains ``rse``."""
    return rules.filter(F.col("state") == RULE_WAITING_APPROVAL).join(
        rule_rses.filter(F.col("rse") == rse).select("rule_id"), "rule_id", "left_semi"
    )


def campaign_cleanup_rules(rules: DataFrame, subscription: str) -> DataFrame:
    return rules.filter(F.col("subscription") == subscription)


def placement_test_cleanup_rules(rules: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rules on listed blocks, or on the containers of those, at ``_Test`` endpoints that
    are not tape."""
    names = blocks.select(F.explode(F.array("name", F.split("name", "#")[0])).alias("name")).distinct()
    rse = F.col("rse_expression")
    return rules.filter(rse.endswith("_Test") & ~rse.endswith("_Tape_Test")).join(names, "name", "left_semi")


def subscription_rules(rules: DataFrame, subscription: str, text: str | None = None) -> DataFrame:
    """Printed line per rule of a subscription, kept if ``text`` occurs anywhere in it."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    line = F.concat(
        F.lit('{"id" : '), shown("rule_id"),
        F.lit(' ,  "rse_expression" : '), shown("rse_expression"),
        F.lit(' , "name" : '), shown("name"),
        F.lit(' , "state" : '), shown("state"),
        F.lit(' , "stuck_at" : '), shown("stuck_at"),
        F.lit("}"),
    )
    out = rules.filter(F.col("subscription") == subscription).select("rule_id", line.alias("line"))
    return out.filter(F.col("line").contains(text)) if text else out


def rule_pending_requests(
    locks: DataFrame, requests: DataFrame, rule_id=None, n: int | None = None, ports=("8446", "8449")
) -> DataFrame:
    """Transfer requests behind the replicating locks of one rule (all rules if none is
    named), with the address of the job's monitor page; the first ``n`` if given."""
    held = locks.filter(F.col("state") == LOCK_REPLICATING)
    if rule_id is not None:
        held = held.filter(F.col("rule_id") == rule_id)
    out = held.select("rule_id", "scope", "name", "rse").join(
        requests.withColumnRenamed("dest_rse", "rse"), ["scope", "name", "rse"]
    )
    link = F.concat(
        F.replace("external_host", F.lit(ports[0]), F.lit(ports[1])), F.lit("/fts3/ftsmon/#/job/"), "external_id"
    )
    out = out.withColumn("monitor_url", link)
    return out.orderBy("submitted_at", "rule_id", "name", "rse").limit(n) if n is not None else out


# --- files stuck on tape -------------------------------------------------------------
def stuck_tape_files(
    locks: DataFrame,
    replicas: DataFrame,
    rules: DataFrame,
    rses: DataFrame,
    rse: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Unfinished replicas on tape under stuck or suspended rules that failed because the
    destination file exists.  Every filter sits below the joins."""
    tape = rses.filter(F.col("rse_type") == "TAPE").select("rse_id", "rse")
    if rse is not None:
        tape = tape.filter(F.col("rse") == rse)
    out = (
        locks.filter(F.col("state") == "S")
        .select("scope", "name", "rse_id", "rule_id")
        .join(tape, "rse_id")
        .join(
            rules.filter(F.col("state").isin("S", "U") & (F.col("error") == DESTINATION_EXISTS)).select(
                "rule_id", F.col("state").alias("rule_state")
            ),
            "rule_id",
        )
        .join(
            replicas.filter(F.col("state").isin("C", "U")).select("scope", "name", "rse_id", "adler32", "bytes"),
            ["scope", "name", "rse_id"],
        )
        .select("scope", "name", "rse", "adler32", "bytes", "rule_id", "rule_state")
    )
    return out.orderBy("scope", "name", "rse", "rule_id").limit(limit) if limit is not None else out


def tape_stat_check(stuck: DataFrame, listing: DataFrame) -> DataFrame:
    """Compare stuck files with a storage listing (rse, scope, name, size, checksum,
    locality).  A file that is right in size and checksum and archived may be set
    available; its suspended rule is set stuck."""
    number = lambda c: F.conv(c, 16, 10)
    lfn = F.concat_ws(":", "scope", "name")
    archived = F.col("locality").contains("NEARLINE") | lfn.startswith("cms:/store/test/loadtest/source/")
    verdict = (
        F.when(F.col("size").isNull(), "not_found")
        .when(F.col("size") != F.col("bytes"), "size_mismatch")
        .when(~F.coalesce(number("checksum") == number("adler32"), F.lit(False)), "checksum_mismatch")
        .when(~F.coalesce(archived, F.lit(False)), "not_archived")
        .otherwise("ok")
    )
    ok = F.col("verdict") == "ok"
    return (
        stuck.join(listing, ["rse", "scope", "name"], "left")
        .withColumn("verdict", verdict)
        .withColumn("new_state", F.when(ok, REPLICA_AVAILABLE))
        .withColumn("rule_action", F.when(ok & (F.col("rule_state") == RULE_SUSPENDED), "STUCK"))
        .select("rse", "scope", "name", "rule_id", "verdict", "new_state", "rule_action")
    )


def tape_stat_summary(checked: DataFrame) -> DataFrame:
    """Replicas to update and rules to un-suspend per endpoint."""
    return checked.groupBy("rse").agg(
        F.count_if(F.col("verdict") == "ok").alias("replicas"),
        F.count_if(F.col("verdict") != "ok").alias("rejected"),
        F.count_distinct(F.when(F.col("rule_action") == "STUCK", F.col("rule_id"))).alias("rules"),
    )


# --- replicas of names ---------------------------------------------------------------
def file_replicas(names: DataFrame, replicas: DataFrame) -> DataFrame:
    """Per listed file the sorted endpoints and the ``rse=state`` list."""
    found = replicas.join(names.select("name"), "name", "left_semi")
    return found.groupBy("name").agg(
        F.array_sort(F.collect_set("rse")).alias("rses"),
        F.array_sort(F.collect_set(F.concat_ws("=", "rse", "state"))).alias("states"),
    )


def dataset_replica_list(dataset_replicas: DataFrame) -> DataFrame:
    """Per dataset the sorted list of ``endpoint state``."""
    return dataset_replicas.groupBy("name").agg(
        F.array_sort(F.collect_set(F.concat_ws(" ", "rse", "state"))).alias("rses")
    )


def replicas_available_at(replicas: DataFrame, rse: str) -> DataFrame:
    return replicas.filter((F.col("rse") == rse) & (F.col("state") == REPLICA_AVAILABLE))

"""Streams that keep a state per key: newest metric with expiry, rules on changes of the catalogue.

State is kept by ``applyInPandasWithState``, so it survives lost executors with the stream's progress folder.  Rows are
reduced before they are shuffled where the rule allows it, or keys are served bucket by bucket.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.ranking import latest_per_key

# Fixed value: horizon of the site metrics.
METRIC_HORIZON_HOURS = 24


# --- newest value of a key, until it falls silent ------------------------------------
def metric_latest(
    metrics: DataFrame, value: str, tie: str, horizon_hours: float = METRIC_HORIZON_HOURS, late_hours: float = 1
) -> DataFrame:
    """Newest ``value`` per name, of equal times that with the least ``tie``; silent names leave.

    A name is silent once the newest time of all names, less ``late_hours``, is past its own newest time plus the horizon
    (in milliseconds).  Batch form of ``metric_latest_stream``; ``ts`` is a timestamp.
    """
    newest = latest_per_key(metrics.select("name", "ts", tie, value), ["name"], ["ts"], [tie])
    end = metrics.agg(F.unix_millis(F.max("ts")).alias("end")).scalar()
    return newest.filter(F.unix_millis("ts") + round(horizon_hours * 3600_000) >= end - round(late_hours * 3600_000)).select("name", "ts", tie, value)


def metric_latest_stream(
    metrics: DataFrame, value: str, tie: str, horizon_hours: float = METRIC_HORIZON_HOURS, late_hours: float = 1
) -> DataFrame:
    """Changes of ``metric_latest`` as metrics arrive: (name, ts, tie, value, gone), at most one per name and batch.

    Update mode.  State is one row per name that still reports: it is let go, and a row with ``gone`` given out, when the
    watermark passes the name's newest time plus the horizon.  Rows older than the watermark are dropped, so a name whose
    rows all come later than ``late_hours`` after others' is silent here even if a batch over all rows would still show it.
    Rows with a null time are left out.  ``current`` folds the changes.
    """
    horizon = round(horizon_hours * 3600_000)
    rank = lambda row: (-row[0], row[1] is not None, row[1])  # newest, then least tie, null first
    plain = lambda x: None if x is None or x is pd.NaT or (isinstance(x, float) and x != x) else x

    rows = metrics.filter("ts IS NOT NULL").select("name", "ts", F.unix_micros("ts").alias("us"), F.col(tie).alias("tie"), F.col(value).alias("value"))

    def newest_of_frame(frames: Iterator[pd.DataFrame]):
        """Rows that cannot be the newest of their name do not travel."""
        for frame in frames:
            ordered = frame.sort_values(["us", "tie"], ascending=[False, True], kind="stable", na_position="first")
            yield ordered.drop_duplicates("name")

    def keep(key, frames: Iterator[pd.DataFrame], state: GroupState):
        out = lambda row, gone: pd.DataFrame({"name": [key[0]], "us": [row[0]], "tie": [row[1]], "value": [row[2]], "gone": [gone]})
        if state.hasTimedOut:
            last = state.get
            state.remove()
            yield out(last, True)
            return
        best = old = tuple(plain(x) for x in state.get) if state.exists else None
        for frame in frames:
            for row in zip(frame["us"].tolist(), map(plain, frame["tie"].tolist()), map(plain, frame["value"].tolist())):
                if best is None or rank(row) < rank(best):
                    best = row
        until = best[0] // 1000 + horizon
        if until < state.getCurrentWatermarkMs():
            if state.exists:
                state.remove()
            yield out(best, True)
            return
        state.update(best)
        state.setTimeoutTimestamp(until)
        if best != old:
            yield out(best, False)

    kinds = dict(rows.dtypes)
    reduced = rows.mapInPandas(newest_of_frame, rows.schema).withWatermark("ts", f"{round(late_hours * 3600_000)} milliseconds")
    changes = reduced.groupBy("name").applyInPandasWithState(
        keep,
        f"name {kinds['name']}, us bigint, tie {kinds['tie']}, value {kinds['value']}, gone boolean",
        f"us bigint, tie {kinds['tie']}, value {kinds['value']}",
        "update",
        GroupStateTimeout.EventTimeTimeout,
    )
    return changes.select("name", F.timestamp_micros("us").alias("ts"), F.col("tie").alias(tie), F.col("value").alias(value), "gone")


def current(folded: DataFrame) -> DataFrame:
    """Names that are there, from the newest change per name (``run_once`` in update mode)."""
    return folded.filter(~F.col("gone")).drop("gone")


# --- changes between snapshots, and what the catalogue's rules say to them ---------------
def snapshot_changes(old: DataFrame, new: DataFrame, keys: list[str], first: int = 1) -> DataFrame:
    """One row per key that came (``insert``), went (``delete``) or changed (``update``), with the newest known values.

    ``seq`` is ``first`` for all: changes of one day to different keys have no order among them.
    """
    rest = [c for c in new.columns if c not in keys]
    before = old.select(*keys, F.struct(*rest).alias("before"))
    after = new.select(*keys, F.struct(*rest).alias("after"))
    op = F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "delete").otherwise("update")
    both = before.join(after, keys, "full_outer").filter(~F.col("before").eqNullSafe(F.col("after")))
    return both.select(*keys, F.lit(first).cast("bigint").alias("seq"), op.alias("op"), F.coalesce("after", "before").alias("row")).select(*keys, "seq", "op", "row.*")


def seed_changes(table: DataFrame, op: str) -> DataFrame:
    """A stored table as the first changes of its keys (seq 0): ``present`` rows, or ``archived`` ones."""
    return table.select(*table.columns, F.lit(0).cast("bigint").alias("seq"), F.lit(op).alias("op"))


# Fixed value: parts in which the state of the rules on names and keys is kept.
STATE_BUCKETS = 8192
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _fold_by_key(changes: DataFrame, keys: list[str], outcomes: dict[str, str], step, buckets: int) -> DataFrame:
    """``step(held, rows)`` gives (held, outcomes) for the changes of one key, in the order of ``seq``, that a batch brings.

    A key's state lies with those of its bucket, so that a call from Spark to Python serves a bucket and not a key: there are
    at most ``buckets`` calls a batch, whatever the number of keys.  A bucket's state is read and written whole; take
    so many buckets that one holds thousands of keys at most.  Whole numbers go as text, which a null beside them does not
    turn into floating point.
    """
    kinds = {f.name: f.dataType.simpleString() for f in changes.schema.fields}
    as_text = lambda c, kind: kind in _WHOLE and c != "seq"
    columns, rest = changes.columns, [c for c in changes.columns if c not in keys]
    out_kinds = {k: kinds[k] for k in keys} | outcomes
    dealt = changes.select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"),
        *[F.col(c).cast("string").alias(c) if as_text(c, kinds[c]) else F.col(c) for c in columns],
    )

    def work(_, frames, state: GroupState):
        known = pickle.loads(state.get[0]) if state.exists else {}
        waiting: dict[tuple, list[dict]] = {}
        for frame in frames:
            own = {c: [_plain(x) for x in frame[c].tolist()] for c in columns}
            for key, *row in zip(zip(*(own[k] for k in keys)), *(own[c] for c in rest)):
                waiting.setdefault(key, []).append(dict(zip(rest, row)))
        out = []
        for key, rows in waiting.items():
            rows.sort(key=lambda r: (r["seq"], r["op"]))
            known[key], found = step(known.get(key), rows)
            out += [(*key, *o) for o in found]
        state.update((pickle.dumps(known),))
        if out:
            yield pd.DataFrame(out, columns=list(out_kinds))

    sent = ", ".join(f"{c} {'string' if as_text(c, kind) else kind}" for c, kind in out_kinds.items())
    folded = dealt.groupBy("_bucket").applyInPandasWithState(work, sent, "known binary", "append", GroupStateTimeout.NoTimeout)
    return folded.select(*[F.col(c).cast(kind).alias(c) if as_text(c, kind) else F.col(c) for c, kind in out_kinds.items()])


def _values(schema: T.StructType, keys: list[str]) -> list[str]:
    return [f.name for f in schema.fields if f.name not in (*keys, "seq", "op")]


def name_changes(changes: DataFrame, keys: tuple[str, ...] = ("scope", "name"), buckets: int = STATE_BUCKETS) -> DataFrame:
    """Rules on names, change by change: an outcome for each change that says something new.

    ``changes`` has the keys, ``seq``, ``op`` (insert, update, delete; present, archived as seeds) and values.  Outcomes:
    ``archived`` (a deleted name, with its last values, that the archive did not have), ``deleted`` (it had it),
    ``refused`` (an insert of a name in the archive; it does not come into being), ``added``, ``changed``.  Deletes and
    updates of names that are not there say nothing.  A change with a ``seq`` not above the key's last one is a repeat and
    says nothing, so a delivery that comes twice changes nothing.  State: one row per name ever seen, as the archive.
    Append mode; a key's changes must arrive in the order of ``seq``, within a batch in any order.
    """
    keys = list(keys)
    values = _values(changes.schema, keys)
    kinds = {f.name: f.dataType.simpleString() for f in changes.schema.fields}

    def step(state, rows):
        present, archived, last, held = state or (False, False, -1, [None] * len(values))
        out = []
        for row in rows:
            now, op = [row[v] for v in values], row["op"]
            if row["seq"] == 0 and op in ("present", "archived"):
                if last <= 0:
                    present, archived, last = present or op == "present", archived or op == "archived", 0
                    held = now if op == "present" else held
                continue
            if row["seq"] <= last:
                continue
            last = row["seq"]
            if op == "insert":
                if archived:
                    out.append((last, "refused", *now))
                elif not present:
                    present, held = True, now
                    out.append((last, "added", *now))
            elif op == "update" and present:
                held = now
                out.append((last, "changed", *now))
            elif op == "delete" and present:
                out.append((last, "deleted" if archived else "archived", *held))
                present, archived = False, True
        return (present, archived, last, held), out

    outcomes = {"seq": "bigint", "outcome": "string"} | {v: kinds[v] for v in values}
    return _fold_by_key(changes, keys, outcomes, step, buckets)


def key_changes(changes: DataFrame, surrogate: str, key: str, buckets: int = STATE_BUCKETS) -> DataFrame:
    """Rules on keys that must not change, by their surrogate: (surrogate, seq, outcome, old_key, new_key).

    Outcomes: ``refused`` (another key for a known surrogate, also when it is deleted and comes again; the old key stays)
    and ``added``.  A null key changes nothing.  Repeats say nothing, as in ``name_changes``.  State: a row per surrogate.
    """
    kinds = {f.name: f.dataType.simpleString() for f in changes.schema.fields}

    def step(state, rows):
        held, last = state or (None, -1)
        out = []
        for row in rows:
            if row["seq"] <= last:
                continue
            last, new = row["seq"], row[key]
            if new is None or row["op"] == "delete":
                continue
            if held is None:
                held = new
                if row["op"] != "present":
                    out.append((last, "added", None, new))
            elif new != held:
                out.append((last, "refused", held, new))
        return (held, last), out

    outcomes = {"seq": "bigint", "outcome": "string", "old_key": kinds[key], "new_key": kinds[key]}
    return _fold_by_key(changes, [surrogate], outcomes, step, buckets)


def _plain(x):
    return None if x is None or x is pd.NaT or (isinstance(x, float) and x != x) else x

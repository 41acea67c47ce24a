"""Checks of nested records of any shape: a description becomes column expressions over ``VARIANT``, a row per violation.

A description says of a value what type it has, which pattern, list or length a text keeps to, how many items a list has,
and of a record which fields it must have, which it may have, and how a field's value narrows another's.  ``violations``
turns it into one expression; nothing is parsed in Python, and a record is read once whatever the description holds.

Paths are written ``$.dids[3].name``.  As in the usual description language of JSON, patterns are searched for anywhere,
a pattern, list or length says nothing of a value of another type, and a whole number may be written ``2.0``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import ENUMS, MAX_LENGTHS, PATTERNS

FOUND = "array<struct<path: string, violation: string>>"


@dataclass(frozen=True)
class Value:
    """``types``: any of string, integer, number, boolean, null, array, object; none allows all."""

    types: tuple[str, ...] = ()
    pattern: str | None = None
    values: tuple[str, ...] | None = None
    longest: int | None = None


@dataclass(frozen=True)
class Items(Value):
    types: tuple[str, ...] = ("array",)
    item: Value | None = None
    least: int | None = None
    most: int | None = None


@dataclass(frozen=True)
class Record(Value):
    """``closed``: no other fields.  ``cases``: {field: {text: {other field: pattern}}}."""

    types: tuple[str, ...] = ("object",)
    fields: Mapping[str, Value] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    closed: bool = False
    cases: Mapping[str, Mapping[str, Mapping[str, str]]] = field(default_factory=dict)


def text(kind: str | None = None, null: bool = False) -> Value:
    """A text of a kind that ``quality`` names: by pattern, list of values or greatest length."""
    types = ("string", "null") if null else ("string",)
    return Value(types, PATTERNS.get(kind), ENUMS.get(kind), MAX_LENGTHS.get(kind))


def _of(*types: str) -> Value:
    return Value(types)


# The records a catalogue takes, with their fields, required fields and numbers of items.
RULE = Record(
    fields={
        "dids": _of("array"), "account": text("account"), "copies": _of("integer"), "rse_expression": text(), "grouping": text("grouping", null=True),
        "weight": text(null=True), "lifetime": _of("number", "null"), "locked": _of("boolean", "null"), "subscription_id": text(null=True),
        "source_replica_expression": text(null=True), "activity": text("activity"), "notify": text("notify", null=True), "purge_replicas": _of("boolean"),
        "ignore_availability": _of("boolean"), "comment": text("comment", null=True), "ask_approval": _of("boolean", "null"),
        "asynchronous": _of("boolean", "null"), "delay_injection": _of("integer", "null"), "priority": _of("integer"),
        "split_container": _of("boolean", "null"), "meta": text("metadata", null=True),
    },
    required=("dids", "copies", "rse_expression"), closed=True,
)
RULES = Items(item=RULE, least=1, most=1000)
META = Record(fields={"guid": text("uuid")})
COLLECTION = Record(
    fields={"scope": text("scope"), "name": text("name"), "type": text("collection_type"), "meta": META, "rules": RULES},
    required=("scope", "name", "type"), closed=True,
)
COLLECTIONS = Items(item=COLLECTION, least=1, most=1000)
_DID_FIELDS = {
    "scope": text("scope"), "name": text("name"), "type": text("did_type"), "meta": META, "rules": RULES, "bytes": _of("integer"),
    "adler32": text("adler32"), "md5": text("md5"), "state": text("replica_state"), "pfn": text(),
}
DID = Record(
    fields=_DID_FIELDS, required=("scope", "name", "type"), closed=True,
    cases={"type": {t: {"name": PATTERNS[p]} for t, p in (("CONTAINER", "dataset"), ("DATASET", "block"), ("FILE", "lfn"), ("F", "lfn"))}},
)
DIDS = Items(item=DID, least=1, most=3000)
R_DID = Record(fields=_DID_FIELDS, required=("scope", "name"), closed=True)
R_DIDS = Items(item=R_DID, least=1, most=30000)
ATTACHMENT = Record(
    fields={"scope": text("scope"), "name": text("name"), "rse": Value(("string", "null"), PATTERNS["rse"]), "dids": R_DIDS},
    required=("dids",), closed=True,
)
ATTACHMENTS = Items(item=ATTACHMENT, least=1, most=3000)
SUBSCRIPTION_FILTER = Record(
    fields={
        **{k: _of("array") for k in ("datatype", "prod_step", "stream_name", "project", "scope")},
        **{k: text() for k in ("pattern", "excluded_pattern", "group", "provenance", "grouping")},
        "account": Items(item=text("account"), least=0, most=1000), "split_rule": _of("boolean"),
    }
)
_FILE = {"scope": text("scope"), "name": text("name")}
ADD_REPLICA_FILES = Items(item=Record(fields={**_FILE, "bytes": _of("integer"), "adler32": text("adler32")}, required=("scope", "name", "bytes", "adler32")), least=1, most=1000)
DELETE_REPLICA_FILES = Items(item=Record(fields=_FILE, required=("scope", "name")), least=1, most=1000)
CACHE_ADD_REPLICAS = Record(
    fields={"files": ADD_REPLICA_FILES, "rse": text("rse"), "lifetime": _of("number"), "operation": Value(values=("add_replicas",))},
    required=("files", "rse", "lifetime", "operation"),
)
CACHE_DELETE_REPLICAS = Record(
    fields={"files": DELETE_REPLICA_FILES, "rse": text("rse"), "operation": Value(values=("delete_replicas",))}, required=("files", "rse", "operation")
)
DISTANCE = Record(fields={"src_rse_id": text(), "dest_rse_id": text(), "ranking": _of("integer")}, required=("src_rse_id", "dest_rse_id", "ranking"))
IMPORT = Record(fields={"rses": _of("object"), "distances": _of("object")})


def _said(path: Column, what: str | Column) -> Column:
    return F.array(F.struct(path.alias("path"), (F.lit(what) if isinstance(what, str) else what).alias("violation")))


_NONE = f"CAST(array() AS {FOUND})"


def _unless(ok: Column, path: Column, what: str | Column) -> Column:
    return F.when(F.coalesce(ok, F.lit(True)), F.expr(_NONE)).otherwise(_said(path, what))


def violations(value: Column, wanted: Value, path: Column | str = "$") -> Column:
    """Array of (path, violation) of a ``VARIANT`` that is there; a null column has none."""
    path = F.lit(path) if isinstance(path, str) else path
    kind = F.schema_of_variant(value)
    as_text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double")
    numeric = kind.rlike("^(BIGINT|INT|DECIMAL|DOUBLE|FLOAT)")
    tests = {
        "string": kind == "STRING", "number": numeric, "integer": numeric & (number % 1 == 0), "boolean": kind == "BOOLEAN",
        "null": kind == "VOID", "array": kind.startswith("ARRAY"), "object": kind.startswith("OBJECT"),
    }
    parts = []
    if wanted.types:
        right = tests[wanted.types[0]]
        for t in wanted.types[1:]:
            right = right | tests[t]
        parts.append(_unless(right, path, "type is not " + " or ".join(wanted.types)))
    if wanted.pattern is not None:
        parts.append(_unless(~tests["string"] | as_text.rlike(wanted.pattern), path, "does not match"))
    if wanted.values is not None:
        listed = (tests["string"] & as_text.isin(*wanted.values)) | (tests["null"] if "null" in wanted.types else F.lit(False))
        parts.append(_unless(listed, path, "is none of the values"))
    if wanted.longest is not None:
        parts.append(_unless(~tests["string"] | (F.char_length(as_text) <= wanted.longest), path, f"longer than {wanted.longest}"))
    if isinstance(wanted, Items):
        items = F.try_variant_get(value, "$", "array<variant>")
        if wanted.least:
            parts.append(_unless(F.size(items) >= wanted.least, path, f"fewer than {wanted.least} items"))
        if wanted.most is not None:
            parts.append(_unless(F.size(items) <= wanted.most, path, f"more than {wanted.most} items"))
        if wanted.item is not None:
            inside = lambda x, i: violations(x, wanted.item, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))
            parts.append(F.flatten(F.transform(items, inside)))
    if isinstance(wanted, Record):
        fields = F.try_variant_get(value, "$", "map<string,variant>")
        at = lambda name: F.concat(path, F.lit("." + name))
        for name in wanted.required:
            parts.append(_unless(F.map_contains_key(fields, name), at(name), "is missing"))
        if wanted.closed:
            unknown = F.filter(F.array_sort(F.map_keys(fields)), lambda k: ~k.isin(*wanted.fields))
            parts.append(F.transform(unknown, lambda k: F.struct(F.concat(path, F.lit("."), k).alias("path"), F.lit("is unknown").alias("violation"))))
        for name, own in wanted.fields.items():
            parts.append(violations(F.try_variant_get(value, f"$['{name}']", "variant"), own, at(name)))
        for name, cases in wanted.cases.items():
            chosen = F.try_variant_get(value, f"$['{name}']", "string")
            for said, narrowed in cases.items():
                for other, pattern in narrowed.items():
                    told = F.try_variant_get(value, f"$['{other}']", "string")
                    fits = (chosen != said) | told.rlike(pattern)
                    parts.append(_unless(fits, at(other), f"does not match for {name} {said}"))
    # a type may not have the parts that a test asks for: then they are null
    found = F.concat(*(F.coalesce(p, F.expr(_NONE)) for p in parts)) if parts else F.expr(_NONE)
    return F.when(value.isNull(), F.expr(_NONE)).otherwise(found)


def record_violations(records: DataFrame, wanted: Value, record: str = "record") -> DataFrame:
    """A row per violation: ``records``'s columns but ``record``, then path and violation.

    ``record`` is a VARIANT, or a text that is parsed; a text that is no JSON, an empty one too, is a violation of ``$``.  A null
    record has none.  Repeated records give repeated rows.
    """
    rest = [c for c in records.columns if c != record]
    value = F.col(record)
    if records.schema[record].dataType.simpleString() == "string":
        parsed = F.try_parse_json(value)
        broken = F.when(value.isNotNull() & parsed.isNull(), _said(F.lit("$"), "is no JSON"))
        kept = records.select(*rest, parsed.alias("_record"), broken.alias("_broken"))
    else:
        kept = records.select(*rest, value.alias("_record"), F.lit(None).cast(FOUND).alias("_broken"))
    found = F.coalesce(F.col("_broken"), violations(F.col("_record"), wanted))
    return kept.select(*rest, F.explode(found).alias("_v")).select(*rest, "_v.path", "_v.violation")


def record_scan(spark: SparkSession, path: str, column: str = "record", lines: bool = True) -> DataFrame:
    """Records of JSON files as one VARIANT column, whatever their shape: a record per line, or files that are lists."""
    return spark.read.option("singleVariantColumn", column).option("multiLine", not lines).json(path)

"""Nested records against a plain checker."""

import json
import random
import re

import pytest

from stowage.operators import quality, records
from stowage.operators.records import Items, Record, Value


def slow(value, wanted, path="$"):
    kinds = {
        "string": isinstance(value, str), "boolean": isinstance(value, bool), "null": value is None, "array": isinstance(value, list), "object": isinstance(value, dict),
        "number": isinstance(value, (int, float)) and not isinstance(value, bool),
    }
    kinds["integer"] = kinds["number"] and value == int(value)
    if wanted.types and not any(kinds[t] for t in wanted.types):
        yield path, "type is not " + " or ".join(wanted.types)
    if wanted.pattern is not None and kinds["string"] and not re.search(wanted.pattern, value):
        yield path, "does not match"
    if wanted.values is not None and not (kinds["string"] and value in wanted.values or value is None and "null" in wanted.types):
        yield path, "is none of the values"
    if wanted.longest is not None and kinds["string"] and len(value) > wanted.longest:
        yield path, f"longer than {wanted.longest}"
    if isinstance(wanted, Items) and kinds["array"]:
        if wanted.least and len(value) < wanted.least:
            yield path, f"fewer than {wanted.least} items"
        if wanted.most is not None and len(value) > wanted.most:
            yield path, f"more than {wanted.most} items"
        for i, x in enumerate(value):
            yield from slow(x, wanted.item, f"{path}[{i}]") if wanted.item else ()
    if isinstance(wanted, Record) and kinds["object"]:
        for name in wanted.required:
            if name not in value:
                yield f"{path}.{name}", "is missing"
        for name in value:
            if wanted.closed and name not in wanted.fields:
                yield f"{path}.{name}", "is unknown"
        for name, own in wanted.fields.items():
            if name in value:
                yield from slow(value[name], own, f"{path}.{name}")
        for name, cases in wanted.cases.items():
            for said, narrowed in cases.items():
                for other, pattern in narrowed.items():
                    if value.get(name) == said and isinstance(value.get(other), str) and not re.search(pattern, value[other]):
                        yield f"{path}.{other}", f"does not match for {name} {said}"


def some_value(rng, wanted, depth=0):
    if rng.random() < 0.12 or depth > 5:
        return rng.choice([None, 1, 2.5, 2.0, True, "x", "", [], {}, [1], {"odd key": 1}])
    if isinstance(wanted, Record):
        out = {k: some_value(rng, v, depth + 1) for k, v in wanted.fields.items() if k in wanted.required and rng.random() < 0.9 or rng.random() < 0.25}
        return out | ({"bogus": 1} if rng.random() < 0.1 else {})
    if isinstance(wanted, Items):
        return [some_value(rng, wanted.item or Value(), depth + 1) for _ in range(rng.randrange(3))]
    if wanted.values:
        return rng.choice([*wanted.values, "NO"])
    if wanted.pattern or "string" in wanted.types:
        return rng.choice(["cms", "user.me", "/A/B-v1/RAW", "/A/B-v1/RAW#1", "/store/mc/a.root", "T2_DE_X", "abcdef12", "f" * 32, "x" * 300, "é"])
    return rng.choice([1, -3, 2.0, 2.5, 10**20, True, False, None, [1]])


KINDS = {k: getattr(records, k) for k in ("RULES", "COLLECTIONS", "DIDS", "ATTACHMENTS", "SUBSCRIPTION_FILTER", "CACHE_ADD_REPLICAS", "CACHE_DELETE_REPLICAS", "DISTANCE", "IMPORT")}


@pytest.mark.parametrize("kind", KINDS)
def test_against_a_plain_checker(spark, kind):
    rng = random.Random(len(kind))
    given = [some_value(rng, KINDS[kind]) for _ in range(60)]
    frame = spark.createDataFrame([(i, json.dumps(v), 1) for i, v in enumerate(given)], "id int, record string, path_ int")
    got = sorted((r.id, r.path, r.violation) for r in records.record_violations(frame, KINDS[kind]).collect())
    assert got == sorted((i, *v) for i, value in enumerate(given) for v in slow(value, KINDS[kind]))


def test_broken_null_and_empty_records(spark, rows):
    frame = spark.createDataFrame([(1, "{"), (2, None), (3, ""), (4, "null"), (5, '{"files": []}')], "id int, record string")
    got = rows(records.record_violations(frame, Record(fields={"files": Items(least=1)})))
    assert got == [(1, "$", "is no JSON"), (3, "$", "is no JSON"), (4, "$", "type is not object"), (5, "$.files", "fewer than 1 items")]
    assert records.record_violations(frame.limit(0), records.DIDS).collect() == []


def test_records_of_any_shape_are_scanned(spark, tmp_path, rows):
    path = tmp_path / "records.json"
    path.write_text('{"src_rse_id": "a", "dest_rse_id": "b", "ranking": 1}\n{"ranking": "x"}\n[1]\n')
    got = rows(records.record_violations(records.record_scan(spark, str(path)), records.DISTANCE))
    assert got == sorted([("$.src_rse_id", "is missing"), ("$.dest_rse_id", "is missing"), ("$.ranking", "type is not integer"), ("$", "type is not object")], key=str)


def test_the_two_patterns(spark):
    frame = spark.createDataFrame([("Mon, 03 Jun 2024 10:20:30 UTC", "A_b-C"), ("Mon, 3 Jun 2024 10:20:30 UTC", "é")], "d string, a string")
    got = quality.name_schema_check(frame, {"d": "date", "a": "default_rse_attribute"}).collect()
    assert [r.violations for r in got] == [[], ["a", "d"]]

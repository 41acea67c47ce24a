"""Joining names with patterns that come as a table: each pattern is tried on its candidates only.

A regular expression that has to contain some text can match only names that contain it.  Each pattern gets one key:

- ``p``: the text it must begin with, cut to a power of two of characters (patterns match from the start);
- ``c``: four characters of a text it must contain, those that the fewest patterns share;
- ``a``: nothing is known of it; it is tried on all names, dealt over ``SALTS`` parts.

Names offer the keys they have, and an equi join brings the candidates together, so that names times patterns are never
paired.  A small pattern table is broadcast by Spark and cuts the names' keys on the spot.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GRAM = 4
LENGTHS = (2, 4, 8, 16, 32, 64, 128)
SALTS = 64


def required_text(regex: str | None) -> tuple[str, str]:
    """(beginning, part): what each match from the start must begin with, and the longest text it must contain.

    Careful rather than complete: flags, alternatives outside groups, quotations and named characters say nothing is known.
    """
    regex = regex or ""
    if re.search(r"\\[QEpPNkxuc0]|\(\?[a-zA-Z-]", regex):
        return "", ""
    runs, run, i, first, begins = [], "", 0, True, ""

    def end() -> None:
        nonlocal run, first, begins
        if first:
            first, begins = False, run
        runs.append(run)
        run = ""

    def skip_class(at: int) -> int:
        depth = 0
        while at < len(regex):
            if regex[at] == "\\":
                at += 1
            elif regex[at] == "[":
                depth += 1
                at += regex[at + 1 : at + 2] == "^"
                at += regex[at + 1 : at + 2] == "]"  # right after the opening it is a plain character
            elif regex[at] == "]":
                depth -= 1
                if not depth:
                    return at + 1
            at += 1
        return at

    while i < len(regex):
        c = regex[i]
        if c == "|":
            return "", ""
        if c == "\\":
            if i + 1 < len(regex) and not regex[i + 1].isalnum():
                run += regex[i + 1]
            else:
                end()
            i += 2
        elif c == "[":
            end()
            i = skip_class(i)
        elif c == "(":
            end()
            depth = 0
            while i < len(regex):
                if regex[i] == "\\":
                    i += 1
                elif regex[i] == "[":
                    i = skip_class(i) - 1
                elif regex[i] in "()":
                    depth += 1 if regex[i] == "(" else -1
                    if not depth:
                        break
                i += 1
            i += 1
        elif c == "^" and i == 0:
            i += 1
        elif c in ".^$":
            end()
            i += 1
        elif c in "*?+{":
            least = c == "+" or (c == "{" and re.match(r"\{[1-9]", regex[i:]))
            if run and not least:
                run = run[:-1]
            end()
            i = regex.find("}", i) + 1 if c == "{" and "}" in regex[i:] else i + 1
            while i < len(regex) and regex[i] in "?+":
                i += 1
        else:
            run += c
            i += 1
    end()
    return begins, max(runs, key=len)


def _required(patterns: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            begins, parts = zip(*(required_text(r) for r in batch.column(0).to_pylist())) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(begins, pa.string()), pa.array(parts, pa.string())], ["_p", "begins", "part"])

    return patterns.mapInArrow(run, "_p string, begins string, part string")


def keyed_patterns(patterns: DataFrame, pattern: str) -> DataFrame:
    """``patterns`` with the key of each (kind, key); those without a pattern are left out.  Patterns may repeat."""
    text = _required(patterns.select(F.col(pattern).alias("_p")).filter("_p IS NOT NULL").distinct())
    size = F.char_length("begins")
    cut = F.lit(0)
    for n in LENGTHS:
        cut = F.when(size >= n, n).otherwise(cut)
    text = text.withColumn("cut", cut)
    begin = text.filter("cut > 0").select("_p", F.lit("p").alias("kind"), F.expr("substr(begins, 1, cut)").alias("key"))
    inside = text.filter(f"cut = 0 AND char_length(part) >= {GRAM}")
    grams = inside.select("_p", F.explode(_grams(F.col("part"))).alias("key"))
    shared = grams.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    fewest = grams.join(shared, "key").groupBy("_p").agg(F.min(F.struct("_n", "key")).alias("m"))
    part = fewest.select("_p", F.lit("c").alias("kind"), F.col("m.key").alias("key"))
    rest = text.filter(f"cut = 0 AND char_length(part) < {GRAM}")
    every = rest.select("_p", F.lit("a").alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<string>")).alias("key"))
    keys = begin.unionByName(part).unionByName(every)
    return patterns.join(keys, patterns[pattern] == F.col("_p")).drop("_p")


def _grams(text):
    """Distinct pieces of ``GRAM`` characters; none of a shorter text."""
    places = F.sequence(F.lit(1), F.greatest(F.char_length(text) - (GRAM - 1), F.lit(1)))
    pieces = F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM)))
    return F.array_distinct(F.filter(pieces, lambda p: F.char_length(p) == GRAM))


def pattern_matches(names: DataFrame, patterns: DataFrame, name: str = "name", pattern: str = "pattern") -> DataFrame:
    """Rows of ``names`` with each row of ``patterns`` whose expression matches ``name`` from the start.

    The columns of both must differ.  Repeated rows on either side come out as often as they pair.  A null name or pattern
    matches nothing, an empty pattern every name.
    """
    keyed = keyed_patterns(patterns, pattern).withColumnsRenamed({"kind": "_kind", "key": "_key"})
    kinds = keyed.agg(F.bool_or(F.col("_kind") == "c").alias("c")).scalar()
    text = F.col(name)
    offer = lambda kind, keys: F.transform(keys, lambda k: F.struct(F.lit(kind).alias("_kind"), k.alias("_key")))
    begins = F.array(*(F.when(F.char_length(text) >= n, F.substring(text, 1, n)) for n in LENGTHS))
    salt = F.array(F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("string"))
    few = F.concat(offer("p", F.array_compact(begins)), offer("a", salt))
    # pieces are cut only if some pattern asks for one
    offered = F.when(F.coalesce(kinds, F.lit(False)), F.concat(few, offer("c", _grams(text)))).otherwise(few)
    keys = names.filter(text.isNotNull()).withColumn("_offer", F.explode(offered)).select(*names.columns, "_offer.*")
    tried = keys.join(keyed, ["_kind", "_key"]).filter(F.expr(f"`{name}` RLIKE concat('^(?:', `{pattern}`, ')')"))
    return tried.drop("_kind", "_key")


def subscription_rules(dids: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """One planned rule per DID, matching subscription and rule template, for subscriptions that come as a table.

    ``dids``: name, did_type, scope, account, project.  ``subscriptions``: subscription, pattern, want_type (string), want_scope,
    want_account, want_project (arrays) and rules (array of structs with what a rule needs); a null filter matches all, and
    so does a null pattern.
    """
    asked = subscriptions.withColumn("pattern", F.coalesce("pattern", F.lit("")))
    found = pattern_matches(dids, asked)
    wanted = lambda key: F.col(f"want_{key}").isNull() | F.coalesce(F.array_contains(f"want_{key}", F.col(key)), F.lit(False))
    kept = found.filter((F.col("want_type").isNull() | F.coalesce(F.col("want_type") == F.col("did_type"), F.lit(False))) & wanted("scope") & wanted("account") & wanted("project"))
    return kept.select("name", "subscription", F.posexplode("rules").alias("position", "rule")).select("name", "subscription", "position", "rule.*")


def excluded_links(matrix: DataFrame, rses: DataFrame, rules: DataFrame) -> DataFrame:
    """Distance -1 for links that match any rule of a table; a link of an endpoint to itself stays.

    ``rules`` is (rule_id, side: src or dest, field, pattern): all rows of a rule must match, from the start.  A rule's rows
    are tried on the distinct values of ``rses``'s columns, which gives the endpoints of either side per rule; a link is
    excluded if one rule takes its source and its destination, found by joins from the links.
    """
    fields = [c for c in rses.columns if c != "rse"]
    own = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in ("rse", *fields))))
    facts = rses.select("rse", own.alias("f")).select("rse", "f.*").filter("value IS NOT NULL")
    wants = rules.select("rule_id", "side", F.col("field").alias("on"), "pattern").distinct()
    matched = pattern_matches(facts.select("field", "value").distinct(), wants, "value").filter("field = on").select("rule_id", "side", "field", "pattern", "value")
    hits = matched.join(facts, ["field", "value"]).groupBy("rule_id", "side", "rse").agg(F.count_distinct("field", "pattern").alias("n"))
    needed = wants.groupBy("rule_id", "side").agg(F.count(F.lit(1)).alias("n"))
    sides = hits.join(needed, ["rule_id", "side", "n"], "left_semi")
    one_sided = needed.groupBy("rule_id").agg(F.collect_set("side").alias("sides"))
    side = lambda name: sides.filter(F.col("side") == name).join(one_sided, "rule_id").select("rule_id", F.col("rse").alias(name), "sides")
    links = matrix.select("src", "dest").filter("src <> dest").distinct()
    both = links.join(side("src").filter("size(sides) = 2").drop("sides"), "src").join(side("dest").drop("sides"), ["rule_id", "dest"])
    src = links.join(side("src").filter("size(sides) = 1"), "src", "left_semi")
    dest = links.join(side("dest").filter("size(sides) = 1"), "dest", "left_semi")
    out = both.select("src", "dest").unionByName(src).unionByName(dest).distinct().withColumn("_out", F.lit(True))
    return matrix.join(out, ["src", "dest"], "left").select("src", "dest", F.when(F.col("_out"), -1).otherwise(F.col("distance")).alias("distance"))

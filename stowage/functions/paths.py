"""Column functions over URLs and path rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import _c, lfn_from_path

# Ports of URLs that name none.
DEFAULT_PORTS = {"gsiftp": 2811, "root": 1094, "davs": 443}
# Priority per protocol for reading, writing, deleting and for copies.
PROTOCOL_WEIGHT = {"WebDAV": 1, "XRootD": 3, "SRMv2": 2}
WAN_OPERATIONS = ("read", "write", "third_party_copy_write", "third_party_copy_read", "delete")
READ_ONLY_OPERATIONS = ("read", "third_party_copy_read")
MAX_CHAIN_DEPTH = 5
# Rules that are settings are unrolled up to so many steps, chained ones counted wherever they are followed.
MAX_STEPS = 60
PathRule = tuple[str, str, str, "str | None"]

_HEAD = r"^(\w+)://([a-zA-Z0-9\-\.]+)"
# The URL shapes, most specific first: port with service path, port with
# path, port alone, path without port, host alone.
URL_SHAPES = (_HEAD + r":(\d+)(/.*=)(.*)", _HEAD + r":(\d+)/(.*)", _HEAD + r":(\d+)", _HEAD + r"/(.*)", _HEAD)


def pfn_parts(url: Column | str, is_prefix: bool = True) -> Column:
    """struct(scheme, host, port, service_path, prefix) of a prefix or of a rule's URL.

    Null where the URL has none of the known shapes.  A rule's prefix is always ``/``.
    """
    url = _c(url)
    at = [url.rlike(s) for s in URL_SHAPES]
    group = lambda shape, i: F.regexp_extract(url, URL_SHAPES[shape], i)
    scheme = group(4, 1)
    default_port = F.lit(None).cast("int")
    for name, port in reversed(DEFAULT_PORTS.items()):
        default_port = F.when(scheme == name, port).otherwise(default_port)
    port = F.when(at[2], group(2, 3).cast("int")).otherwise(default_port)
    path = lambda shape, i: F.concat(F.lit("/"), group(shape, i))
    prefix = F.when(at[0], group(0, 5)).when(at[1], path(1, 4)).when(at[2], "/").when(at[3], path(3, 3)).otherwise("/")
    return F.when(
        at[4],
        F.struct(
            scheme.alias("scheme"),
            group(4, 2).alias("host"),
            port.alias("port"),
            F.when(at[0], group(0, 4)).alias("service_path"),
            (prefix if is_prefix else F.lit("/")).alias("prefix"),
        ),
    )


def rule_pfn_fix(rule_pfn: Column | str, scheme: Column, host: Column, port: Column) -> Column:
    """struct(status, pfn): a rule's URL against its protocol.  ``ok`` as it is, ``changed``
    with the missing port put in, ``error`` if it names another place."""
    url = _c(rule_pfn)
    with_port, no_port = URL_SHAPES[1], URL_SHAPES[3]
    group = lambda pattern, i: F.regexp_extract(url, pattern, i)
    same = (group(URL_SHAPES[4], 1) == scheme) & (group(URL_SHAPES[4], 2) == host)
    same_port = group(with_port, 3).cast("int") == port
    fixed = F.concat(scheme, F.lit("://"), host, F.lit(":"), port.cast("string"), F.lit("/"), group(no_port, 3))
    ok = F.when(url.rlike(with_port), F.when(same & same_port, "ok").otherwise("error"))
    status = ok.when(url.rlike(no_port), F.when(same, "changed").otherwise("error")).otherwise("ok")
    return F.struct(
        status.alias("status"),
        F.when(status == "ok", url).when(status == "changed", fixed).alias("pfn"),
    )


def lfn_to_pfn_simple(path: Column | str, protocol: Column) -> Column:
    """URL of a file at an endpoint: the first path rule that matches, else prefix and name.

    ``protocol`` is struct(scheme, host, port, prefix, service_path, rules), with ``rules``
    an array of struct(path, out).
    """
    lfn = lfn_from_path(path)
    field = protocol.getField
    hits = F.filter(field("rules"), lambda r: F.rlike(lfn, F.concat(F.lit("^(?:"), r["path"], F.lit(")"))))
    hit = F.try_element_at(hits, F.lit(1))
    by_rule = F.replace(hit["out"], F.lit("$1"), F.call_function("regexp_extract", lfn, hit["path"], F.lit(1)))
    url = F.concat(
        field("scheme"), F.lit("://"), field("host"), F.lit(":"), field("port").cast("string"),
        F.coalesce(field("service_path"), F.lit("")), F.regexp_replace(field("prefix"), "/$", ""), lfn,
    )
    return F.when(hit.isNotNull(), by_rule).otherwise(url)


def _resolve(name: Column, rules: Column, proto: Column, depth: int) -> Column:
    """struct(name, hit, error) after the rules of ``proto``, chains followed first.

    One fold over the rule array per chain level.  A chained rule leaves the name it
    produced in force for the rules after it, whether or not it matched itself.
    """
    state = lambda n, hit, error: F.struct(n.alias("name"), hit.alias("hit"), error.alias("error"))
    none = F.lit(None).cast("string")
    if depth > MAX_CHAIN_DEPTH:
        return state(name, F.lit(False), F.lit("chain too deep"))

    def step(acc: Column, rule: Column) -> Column:
        chained = _resolve(acc["name"], rules, rule["chain"], depth + 1)
        before = F.when(rule["chain"].isNotNull(), chained).otherwise(state(acc["name"], F.lit(False), none))

        def apply(seen: Column) -> Column:
            # anchored, so that a pattern like (.*) is put in once and not again at the end
            pattern = F.concat(F.lit("^(?:"), rule["path"], F.lit(")"))
            matched = F.rlike(seen["name"], pattern)
            done = state(F.regexp_replace(seen["name"], pattern, rule["out"]), F.lit(True), none)
            return (
                F.when(seen["error"].isNotNull(), state(seen["name"], F.lit(False), seen["error"]))
                .when(matched, done)
                .otherwise(state(seen["name"], F.lit(False), none))
            )

        # a one-element array binds the chained result once instead of repeating its fold
        applied = F.transform(F.array(before), apply)[0]
        skip = acc["hit"] | acc["error"].isNotNull() | (rule["proto"] != proto)
        return F.when(skip, acc).otherwise(applied)

    return F.aggregate(rules, state(name, F.lit(False), none), step)


def rule_array(rules: Sequence[PathRule]) -> Column:
    """Settings as the array of structs that a table of rules would hold."""
    row = lambda proto, path, out, chain: F.struct(
        F.lit(proto).alias("proto"), F.lit(path).alias("path"), F.lit(out).alias("out"), F.lit(chain).cast("string").alias("chain")
    )
    return F.array(*[row(*r) for r in rules])


class _TooManySteps(Exception):
    pass


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _state(name: Column, hit: Column | None = None, error: Column | None = None) -> Column:
    hit, error = F.lit(False) if hit is None else hit, F.lit(None).cast("string") if error is None else error
    return F.struct(name.alias("name"), hit.alias("hit"), error.alias("error"))


def _one_step(rules: Sequence[PathRule], pattern: str, replacement: str, chain: str | None, depth: int, steps: list[int]):
    """What one rule does to the state before it."""

    def apply(seen: Column) -> Column:
        done = _state(F.regexp_replace(seen["name"], pattern, replacement), F.lit(True))
        failed = _state(seen["name"], error=seen["error"])
        return F.when(seen["error"].isNotNull(), failed).when(seen["name"].rlike(pattern), done).otherwise(_state(seen["name"]))

    def step(acc: Column) -> Column:
        before = _state(acc["name"]) if chain is None else _unrolled(acc["name"], rules, chain, depth + 1, steps)
        return F.when(acc["hit"] | acc["error"].isNotNull(), acc).otherwise(_bind(before, apply))

    return step


def _unrolled(name: Column, rules: Sequence[PathRule], proto: str, depth: int, steps: list[int]) -> Column:
    """``_resolve`` for rules that are settings: each pattern is a literal, compiled once, and only rules of ``proto`` are there."""
    if depth > MAX_CHAIN_DEPTH:
        return _state(name, F.lit(False), F.lit("chain too deep"))
    out = _state(name)
    for own, path, replacement, chain in rules:
        if own != proto:
            continue
        steps[0] += 1
        if steps[0] > MAX_STEPS:
            raise _TooManySteps
        out = _bind(out, _one_step(rules, f"^(?:{path})", replacement, chain, depth, steps))
    return out


def lfn_to_pfn_chain(
    name: Column | str, rules: Column | Sequence[PathRule], proto: Column | str, depth: int = MAX_CHAIN_DEPTH
) -> Column:
    """struct(pfn, error): ordered path rules with chained protocols.

    ``rules`` is an array of struct(proto, path, out, chain), or, where they are settings and ``proto`` is a text, a list of
    such tuples; those become literal expressions (unless chains make them more than ``MAX_STEPS``, when the array form is
    used).  No match at the outermost level is an error; an unmatched chain hands its name on.
    """
    if isinstance(rules, Column):
        out = _resolve(_c(name), rules, _c(proto), MAX_CHAIN_DEPTH - depth)
    else:
        rules = list(rules)
        try:
            out = _unrolled(_c(name), rules, proto, MAX_CHAIN_DEPTH - depth, [0])
        except _TooManySteps:
            out = _resolve(_c(name), rule_array(rules), F.lit(proto), MAX_CHAIN_DEPTH - depth)
    error = F.coalesce(out["error"], F.when(~out["hit"], "no rule matches"))
    return F.struct(F.when(error.isNull(), out["name"]).alias("pfn"), error.alias("error"))


def lfn_to_path(name: Column | str, pfn: Column, scheme: Column, base: Column, strip_own: bool = False) -> Column:
    """Path to hand to the storage: the rule's result without the protocol part ``base`` and
    (except for ``root``) without double slashes; ``/name`` where there are no rules
    (``pfn`` null).

    A result that is a URL stays as it is; with ``strip_own`` only one of another place
    does, and one that begins with ``base`` is cut to its path.
    """
    rest = F.replace(pfn, base, F.lit(""))
    url = pfn.rlike(r"^\w+://")
    return (
        F.when(pfn.isNull(), F.regexp_replace(F.concat(F.lit("/"), _c(name)), "/+", "/"))
        .when(url & ~pfn.startswith(base) if strip_own else url, pfn)
        .when(scheme == "root", rest)
        .otherwise(F.regexp_replace(rest, "/+", "/"))
    )


def protocol_priority(protocol: Column | str, access: Column | str) -> Column:
    """Map of wide-area operation -> priority; read-only access keeps the two read
    operations and leaves the rest null.  Null for other protocols or access kinds."""
    protocol, access = _c(protocol), _c(access)
    weight = F.lit(None).cast("int")
    for name, value in PROTOCOL_WEIGHT.items():
        weight = F.when(protocol == name, value).otherwise(weight)
    entry = lambda op: weight if op in READ_ONLY_OPERATIONS else F.when(access == "global-rw", weight)
    pairs = [x for op in WAN_OPERATIONS for x in (F.lit(op), entry(op))]
    return F.when(weight.isNotNull() & access.isin("global-rw", "global-ro"), F.create_map(*pairs))

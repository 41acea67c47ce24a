"""Column functions over catalogue names: DIDs, blocks, paths, accounts, subjects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SCOPE = "cms"

# Endpoint flavours and the suffix each puts on the name.
RSE_SUFFIX = {"real": "", "test": "_Test", "temp": "_Temp", "user": "_User"}
# Folder each flavour puts behind the prefix; sites differ, so callers may pass their own.
RSE_FOLDER = {"test": "store/test/", "temp": "store/temp/"}

# First path parts that carry a data type for tape.
TAPE_TYPES = ("data", "hidata", "mc", "himc", "relval", "hirelval")

# Data tiers that name a tape family of their own; all others inherit.
# The trailing blank of the third entry is part of the value.
TAPE_FAMILY_SUFFIX = {"RAW": "RAW", "ALCARECO": "Prompt", "GEN-SIM-RAW ": "GenSimRaw", "GEN-SIM": "GenSimRaw"}


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def part(array: Column, i: int) -> Column:
    """Element ``i`` (from 0, negative from the end) or null."""
    return F.try_element_at(array, F.lit(i + 1 if i >= 0 else i))


# --- data identifiers ----------------------------------------------------------------
def id_hex(raw: Column | str) -> Column:
    """Binary id as lower-case hex."""
    return F.lower(F.hex(_c(raw)))


def did_level(name: Column | str) -> Column:
    """A dot makes a file, else ``#`` a dataset, else a container."""
    name = _c(name)
    return F.when(name.contains("."), "file").when(name.contains("#"), "dataset").otherwise("container")


def did_level_strict(name: Column | str) -> Column:
    """Level by name pattern, so that a dot in a container name does not make it a file."""
    name = _c(name)
    return (
        F.when(name.startswith("/store/"), "file")
        .when(name.rlike(r"^(?:/[^/#]+){3}#.+$"), "dataset")
        .when(name.rlike(r"^(?:/[^/#]+){3}$"), "container")
    )


def split_scope(did: Column | str) -> Column:
    """``scope:name`` -> struct(scope, name), both trimmed; the default scope if none."""
    did = _c(did)
    has = did.contains(":")
    parts = F.split(did, ":", 2)
    return F.struct(
        F.when(has, F.trim(parts[0])).otherwise(F.lit(DEFAULT_SCOPE)).alias("scope"),
        F.when(has, F.trim(parts[1])).otherwise(F.trim(did)).alias("name"),
    )


def strip_scope_prefix(name: Column | str) -> Column:
    return F.replace(F.trim(_c(name)), F.lit("cms:/store"), F.lit("/store"))


def split_block(item: Column | str) -> Column:
    """struct(is_block, dataset, hash, block).  Exactly one ``#`` makes a block."""
    item = _c(item)
    parts = F.split(item, "#")
    block = F.size(parts) == 2
    return F.struct(
        block.alias("is_block"),
        F.when(block, parts[0]).otherwise(item).alias("dataset"),
        F.when(block, part(parts, 1)).alias("hash"),
        F.when(block, item).alias("block"),
    )


def lfn_from_path(path: Column | str) -> Column:
    """``/store/`` and what follows it, up to the next ``/store/``; null without one."""
    return F.concat(F.lit("/store/"), part(F.split(_c(path), "/store/"), 1))


def pfn_to_did(path: Column | str, name: Column | str) -> Column:
    return F.struct(F.concat(_c(path), _c(name)).alias("name"), F.lit(DEFAULT_SCOPE).alias("scope"))


def dataset_from_path(path: Column | str, folder: str) -> Column:
    """``<folder>/<state>/<primary>/<tier>/<campaign>/...`` -> ``/primary/state-campaign/USER``."""
    pattern = r"^\Q" + folder.rstrip("/") + r"/\E(.*?)/(.*?)/(.*?)/(.*?)/.*"
    path = _c(path)
    piece = lambda i: F.regexp_extract(path, pattern, i)
    name = F.concat(F.lit("/"), piece(2), F.lit("/"), piece(1), F.lit("-"), piece(4), F.lit("/USER"))
    return F.when(path.rlike(pattern), name)


# --- tape ----------------------------------------------------------------------------
def _below_store(name: Column) -> Column:
    return F.split(F.regexp_replace(name, "^/store/", ""), "/")


def tape_data_type(name: Column | str) -> Column:
    """First folder below /store if known, else n/a; parking and raw take precedence."""
    name = _c(name)
    parts = F.split(name, "/")
    first = _below_store(name)[0]
    return (
        F.when(~first.isin(*TAPE_TYPES), "n/a")
        .when(F.exists(parts, lambda p: p.startswith("Parking")), "parking")
        .when(F.array_contains(parts, "RAW"), F.when(first.startswith("hi"), "hiraw").otherwise("raw"))
        .otherwise(first)
    )


def tape_tier(name: Column | str) -> Column:
    return part(_below_store(_c(name)), 3)


def tape_era(name: Column | str) -> Column:
    return part(_below_store(_c(name)), 1)


def tape_tag(dataset: Column | str) -> Column:
    """Data tier of a dataset or block name: its last part without the hash."""
    return F.substring_index(F.substring_index(_c(dataset), "/", -1), "#", 1)


def tape_family(tag: Column | str, label: Column | str) -> Column:
    tag, label = _c(tag), _c(label)
    out = None
    for tier, suffix in TAPE_FAMILY_SUFFIX.items():
        test, value = tag == tier, F.concat(label, F.lit(suffix))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise("inherit")


def tape_directory(name: Column | str, tag: Column | str) -> Column:
    """Folder of the file up to one part below ``tag`` (the whole path without it)."""
    parts = F.split(_c(name), "/")
    at = F.array_position(parts, _c(tag))
    depth = F.when(at > 0, at + 1).otherwise(F.size(parts)).cast("int")
    return F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(2), depth - 1), "/"))


# --- endpoints and accounts ----------------------------------------------------------
def tier_country(rse: Column | str) -> Column:
    """struct(tier, country) of ``T<n>_<CC>_...``; nulls if the name has another form."""
    rse, pattern = _c(rse), r"^T(\d+)_(\S{2})_\S+"
    piece = lambda i: F.when(rse.rlike(pattern), F.regexp_extract(rse, pattern, i))
    return F.struct(piece(1).alias("tier"), piece(2).alias("country"))


def rse_variants(rse: Column | str, prefix: Column | str, folders: dict[str, str] = RSE_FOLDER) -> Column:
    """Array of struct(variant, rse, prefix), one per flavour of an endpoint."""
    rse, prefix = _c(rse), _c(prefix)
    base = F.when(prefix.endswith("/"), prefix).otherwise(F.concat(prefix, F.lit("/")))
    return F.array(
        *[
            F.struct(
                F.lit(variant).alias("variant"),
                F.concat(rse, F.lit(suffix)).alias("rse"),
                F.concat(base, F.lit(folders.get(variant, ""))).alias("prefix"),
            )
            for variant, suffix in RSE_SUFFIX.items()
        ]
    )


def sync_account_name(rse: Column | str, cut: int | None = 25) -> Column:
    name = F.concat(F.lit("sync_"), F.lower(_c(rse)))
    return F.substring(name, 1, cut) if cut else name


def group_account_name(site: Column | str, limit: int = 25) -> Column:
    """Local group account of a site; the short suffix where the long one does not fit."""
    base = F.replace(_c(site), F.lit("-"), F.lit("_"))
    full = F.concat(base, F.lit("_local_users"))
    return F.when(F.length(full) > limit, F.concat(base, F.lit("_local"))).otherwise(full)


def purge_flag(rse: Column | str) -> Column:
    return _c(rse).contains("Tape")


def rfc2253_dn(dn: Column | str) -> Column:
    """Slash subject -> comma subject, last part first, commas escaped.

    A subject that does not start with a slash stays; one with a part that has no ``=``
    (or an empty name before it) becomes the empty string."""
    dn = _c(dn)
    parts = F.split(F.replace(F.regexp_replace(dn, "^/", ""), F.lit(","), F.lit("\\,")), "/")
    bad = F.exists(parts, lambda p: F.instr(p, "=") <= 1)
    return F.when(~dn.startswith("/"), dn).when(bad, "").otherwise(F.array_join(F.reverse(parts), ","))


# --- text ----------------------------------------------------------------------------
TICKET_ANY = r"([A-Z]{4,}-\d{1,})"
TICKET_OWN = r"(CMS(?:PROD|TRANSF|DM|TZ)-\d+)"


def ticket_ids(text: Column | str, pattern: str = TICKET_OWN) -> Column:
    return F.regexp_extract_all(_c(text), F.lit(pattern), F.lit(1))


def ticket_links(text: Column | str, base: str) -> Column:
    """Every ticket id wrapped in a link below ``base``."""
    return F.regexp_replace(_c(text), TICKET_ANY, f'<a href="{base}/$1" target="_blank">$1</a>')


def job_id(job_name: Column | str, prefix: str) -> Column:
    """The 8 word characters after the job prefix, or null."""
    job_name, pattern = _c(job_name), prefix + r"(\w{8})"
    return F.when(job_name.rlike(pattern), F.regexp_extract(job_name, pattern, 1))


def first_line_before(text: Column | str, mark: str = "- Request aborted") -> Column:
    """Text before ``mark``, whole if it does not occur."""
    return F.substring_index(_c(text), mark, 1)

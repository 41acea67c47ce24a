"""Registered queries: column functions over whole name, path and value columns."""

from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import paths as P
from ..functions import values as V
from ..operators import containers as cont
from ..sources.snapshots import with_hex_ids
from . import registered
from .invalidation import replicas_named

_NAMES = "(SELECT name FROM files UNION ALL SELECT name FROM contents WHERE did_type = 'C' UNION ALL SELECT child_name FROM contents WHERE did_type = 'C')"


def _names(c):
    tops = c.contents.filter("did_type = 'C'")
    return c.files.select("name").unionByName(tops.select("name")).unionByName(tops.select(F.col("child_name").alias("name")))


@registered("id_hex", "SELECT name, lower(hex(encode(name))) AS id FROM files")
def _(c):
    return with_hex_ids(c.files.select("name", F.encode("name", "UTF-8").alias("id")), "id")


@registered(
    "did_level",
    f"SELECT name, CASE WHEN contains(name, '.') THEN 'file' WHEN contains(name, '#') THEN 'dataset' ELSE 'container' END AS level FROM {_NAMES} n",
)
def _(c):
    return _names(c).select("name", N.did_level("name").alias("level"))


@registered(
    "did_level_strict",
    f"SELECT name, CASE WHEN name LIKE '/store/%' THEN 'file' WHEN contains(name, '#') THEN 'dataset' ELSE 'container' END AS level FROM {_NAMES} n",
)
def _(c):
    return _names(c).select("name", N.did_level_strict("name").alias("level"))


@registered(
    "split_scope",
    """SELECT name AS did, 'cms' AS scope, name AS bare FROM files
       UNION ALL SELECT 'user.' || brand || ' : ' || name, 'user.' || brand, name FROM files""",
)
def _(c):
    dids = c.files.select(F.explode(F.array("name", F.concat(F.lit("user."), "brand", F.lit(" : "), "name"))).alias("did"))
    return dids.withColumn("s", N.split_scope("did")).select("did", "s.scope", F.col("s.name").alias("bare"))


@registered(
    "split_block",
    f"""SELECT name, contains(name, '#') AS is_block, split_part(name, '#', 1) AS dataset,
               CASE WHEN contains(name, '#') THEN split_part(name, '#', 2) END AS hash FROM {_NAMES} n""",
)
def _(c):
    return _names(c).withColumn("b", N.split_block("name")).select("name", "b.is_block", "b.dataset", "b.hash")


@registered(
    "lfn_from_path",
    "SELECT name AS want, name AS lfn FROM files UNION ALL SELECT 'none', NULL FROM files WHERE brand = 'Brand#1'",
)
def _(c):
    paths = c.files.select("name", F.concat(F.lit("root://host//eos"), "name").alias("path")).unionByName(
        c.files.filter("brand = 'Brand#1'").select(F.lit("none").alias("name"), F.lit("/other/x").alias("path"))
    )
    return paths.select(F.col("name").alias("want"), N.lfn_from_path("path").alias("lfn"))


@registered("strip_scope_prefix", "SELECT name FROM files")
def _(c):
    return c.files.select(N.strip_scope_prefix(F.concat(F.lit(" cms:"), "name")).alias("name"))


@registered("pfn_to_did", "SELECT name, 'cms' AS scope FROM files")
def _(c):
    path = F.regexp_extract("name", "^(.*/)([^/]*)$", 1)
    return c.files.select(P._c(N.pfn_to_did(path, F.substring_index("name", "/", -1))).alias("d")).select("d.name", "d.scope")


@registered(
    "dataset_from_path",
    "SELECT name, '/' || brand || '/' || CAST(file_id AS VARCHAR) || '-v2/USER' AS dataset FROM files",
)
def _(c):
    path = F.concat(F.lit("/store/group/pog/"), F.col("file_id").cast("string"), F.lit("/"), "brand", F.lit("/MINI/v2/f.root"))
    return c.files.select("name", N.dataset_from_path(path, "/store/group/pog/").alias("dataset"))


# --- tape ----------------------------------------------------------------------------
_TYPE = """CASE WHEN split_part(name, '/', 3) NOT IN ('data', 'hidata', 'mc', 'himc') THEN 'n/a' WHEN contains(name, '/Parking/') THEN 'parking'
    WHEN contains(name, '/RAW/') THEN CASE WHEN name LIKE '/store/hi%' THEN 'hiraw' ELSE 'raw' END ELSE split_part(name, '/', 3) END"""


@registered("tape_data_type", f"SELECT name, {_TYPE} AS kind FROM files")
def _(c):
    return c.files.select("name", N.tape_data_type("name").alias("kind"))


@registered("tape_tier", "SELECT name, split_part(name, '/', 6) AS tier FROM files")
def _(c):
    return c.files.select("name", N.tape_tier("name").alias("tier"))


@registered("tape_era", "SELECT name, split_part(name, '/', 4) AS era FROM files")
def _(c):
    return c.files.select("name", N.tape_era("name").alias("era"))


@registered(
    "tape_family",
    """SELECT DISTINCT dataset, array_to_string(parts[1:CASE WHEN hit > 0 THEN hit + 1 ELSE len(parts) END], '/') AS path,
              CASE WHEN tag = 'RAW' THEN parts[4] || 'RAW' ELSE 'inherit' END AS family
       FROM (SELECT name AS dataset, string_split(child_name, '/') AS parts, split_part(split_part(name, '/', 4), '#', 1) AS tag,
                    coalesce(list_position(string_split(child_name, '/'), split_part(split_part(name, '/', 4), '#', 1)), 0) AS hit
             FROM contents WHERE did_type = 'D')""",
)
def _(c):
    return cont.tape_family_of(c.contents)


# --- paths ---------------------------------------------------------------------------
_URLS = """
    u AS (SELECT rse, CASE tier WHEN 0 THEN 'srm://h' || rse_id || '.org:8443/srm/managerv2?SFN=/pnfs/' || country
                    WHEN 1 THEN 'root://h' || rse_id || '.org:1095/eos/' || country WHEN 2 THEN 'davs://h' || rse_id || '.org:2880'
                    ELSE CASE WHEN rse_type = 'TAPE' THEN 'gsiftp://h' || rse_id || '.org/castor/' || country ELSE 'root://h' || rse_id || '.org' END END AS url,
                 rse_id, tier, country, rse_type FROM rses)
"""


def _urls(c):
    host = F.concat(F.lit("://h"), F.col("rse_id").cast("string"), F.lit(".org"))
    url = (
        F.when(F.col("tier") == 0, F.concat(F.lit("srm"), host, F.lit(":8443/srm/managerv2?SFN=/pnfs/"), "country"))
        .when(F.col("tier") == 1, F.concat(F.lit("root"), host, F.lit(":1095/eos/"), "country"))
        .when(F.col("tier") == 2, F.concat(F.lit("davs"), host, F.lit(":2880")))
        .when(F.col("rse_type") == "TAPE", F.concat(F.lit("gsiftp"), host, F.lit("/castor/"), "country"))
        .otherwise(F.concat(F.lit("root"), host))
    )
    return c.rses.withColumn("url", url)


@registered(
    "pfn_parts",
    f"""WITH {_URLS}
    SELECT url, split_part(url, '://', 1) AS scheme, 'h' || rse_id || '.org' AS host,
           CAST(CASE tier WHEN 0 THEN 8443 WHEN 1 THEN 1095 WHEN 2 THEN 2880 ELSE CASE WHEN rse_type = 'TAPE' THEN 2811 ELSE 1094 END END AS INTEGER) AS port,
           CASE tier WHEN 0 THEN '/srm/managerv2?SFN=' END AS service_path,
           CASE tier WHEN 0 THEN '/pnfs/' || country WHEN 1 THEN '/eos/' || country WHEN 2 THEN '/' ELSE CASE WHEN rse_type = 'TAPE' THEN '/castor/' || country ELSE '/' END END AS prefix
    FROM u""",
)
def _(c):
    return _urls(c).withColumn("p", P.pfn_parts("url")).select("url", "p.*")


@registered(
    "pfn_parts_pages",
    r"""SELECT url, regexp_extract(url, '^(\w+)://', 1) AS scheme, regexp_extract(url, '^\w+://([a-zA-Z0-9\-.]+)', 1) AS host,
           CASE WHEN regexp_matches(url, '^\w+://[a-zA-Z0-9\-.]+:[0-9]+/.*=') THEN regexp_extract(url, '^\w+://[a-zA-Z0-9\-.]+:[0-9]+/.*=(.*)', 1)
                WHEN regexp_matches(url, '^\w+://[a-zA-Z0-9\-.]+(:[0-9]+)?/') THEN '/' || regexp_extract(url, '^\w+://[a-zA-Z0-9\-.]+(:[0-9]+)?/(.*)', 2)
                ELSE '/' END AS prefix FROM pages WHERE regexp_matches(url, '^\w+://[a-zA-Z0-9\-.]+')""",
)
def _(c):
    out = c.pages.withColumn("p", P.pfn_parts("url")).filter("p IS NOT NULL")
    return out.select("url", "p.scheme", "p.host", "p.prefix")


@registered(
    "rule_pfn_fix",
    f"""WITH {_URLS}
    SELECT rse, CASE WHEN tier = 2 THEN 'ok' WHEN tier = 0 THEN 'error' WHEN tier = 1 THEN 'ok'
                     WHEN rse_type = 'TAPE' THEN 'error' ELSE 'ok' END AS status,
           CASE WHEN tier = 2 OR tier = 1 THEN url WHEN tier = 3 AND rse_type <> 'TAPE' THEN url END AS pfn FROM u
    UNION ALL SELECT rse || '*', 'changed', 'root://h' || rse_id || '.org:1095/x/$1' FROM u""",
)
def _(c):
    host = F.concat(F.lit("h"), F.col("rse_id").cast("string"), F.lit(".org"))
    bare = F.concat(F.lit("root://"), host, F.lit("/x/$1"))
    rows = _urls(c).select(
        F.explode(
            F.array(F.struct("rse", "url"), F.struct(F.concat("rse", F.lit("*")).alias("rse"), bare.alias("url")))
        ).alias("x"), host.alias("host"),
    )
    fixed = P.rule_pfn_fix("x.url", F.lit("root"), F.col("host"), F.lit(1095))
    return rows.select("x.rse", fixed.alias("f")).select("rse", "f.status", "f.pfn")


def _rules(*rows):
    return F.array(
        *[
            F.struct(
                F.lit(proto).alias("proto"), F.lit(path).alias("path"), F.lit(out).alias("out"), F.lit(chain).cast("string").alias("chain")
            )
            for proto, path, out, chain in rows
        ]
    )


_CHAIN_RULES = (
    ("direct", "/+store/(.*)", "/dpm/store/$1", None),
    ("srm", "/dpm/store/(mc/.*)", "srm://se:8446/managerv2?SFN=/pool/$1", "direct"),
    ("srm", "/dpm/store/(data/.*)", "/plain/$1", None),
)
_CHAINED = """CASE WHEN name LIKE '/store/mc/%' THEN 'srm://se:8446/managerv2?SFN=/pool/' || substr(name, 8)
    WHEN name LIKE '/store/data/%' THEN '/plain/' || substr(name, 8) END"""


@registered(
    "lfn_to_pfn_chain",
    f"""SELECT rse_id, name, {_CHAINED} AS pfn, CASE WHEN {_CHAINED} IS NULL THEN 'no rule matches' END AS error FROM replicas""",
)
def _(c):
    out = c.replicas.withColumn("r", P.lfn_to_pfn_chain("name", _CHAIN_RULES, "srm"))
    return out.select("rse_id", "name", "r.pfn", "r.error")


@registered(
    "lfn_to_path",
    f"""SELECT rse_id, name, CASE WHEN name LIKE '/store/mc/%' THEN {_CHAINED} WHEN name LIKE '/store/data/%' THEN '/short/' || substr(name, 13)
        ELSE name END AS path FROM replicas""",
)
def _(c):
    pfn = P.lfn_to_pfn_chain("name", _CHAIN_RULES, "srm")["pfn"]
    rows = c.replicas.withColumn("pfn", pfn)
    path = P.lfn_to_path("name", F.col("pfn"), F.lit("srm"), F.lit("/plain/data"))
    # the base of the example is a plain text, cut out of the result
    return rows.select("rse_id", "name", F.when(F.col("pfn").startswith("/plain/data"), F.concat(F.lit("/short"), path)).otherwise(path).alias("path"))


@registered(
    "lfn_to_pfn_chain_table",
    f"""SELECT rse_id, name, {_CHAINED} AS pfn, CASE WHEN {_CHAINED} IS NULL THEN 'no rule matches' END AS error FROM replicas""",
)
def _(c):
    """The same rules as data, as an array that each row could bring along."""
    out = c.replicas.withColumn("r", P.lfn_to_pfn_chain("name", P.rule_array(_CHAIN_RULES), F.lit("srm")))
    return out.select("rse_id", "name", "r.pfn", "r.error")


@registered(
    "lfn_to_pfn_simple",
    """SELECT r.name, s.rse, CASE WHEN r.name LIKE '/store/mc/%' THEN 'root://alt//mc/' || substr(r.name, 11)
              ELSE 'davs://' || lower(s.rse) || ':2880' || CASE WHEN s.tier = 0 THEN '/ws?=' ELSE '' END || '/pool' || r.name END AS url
       FROM replicas r JOIN rses s ON s.rse_id = r.rse_id""",
)
def _(c):
    proto = F.struct(
        F.lit("davs").alias("scheme"), F.lower("rse").alias("host"), F.lit(2880).alias("port"), F.lit("/pool/").alias("prefix"),
        F.when(F.col("tier") == 0, "/ws?=").alias("service_path"),
        F.array(F.struct(F.lit("/+store/mc/(.*)").alias("path"), F.lit("root://alt//mc/$1").alias("out"))).alias("rules"),
    )
    rows = c.replicas.join(c.rses.select("rse_id", "rse", "tier"), "rse_id")
    return rows.select("name", "rse", P.lfn_to_pfn_simple(F.concat(F.lit("/eos"), "name"), proto).alias("url"))


@registered(
    "rule_chain_closure",
    """SELECT rse AS key, unnest(CASE WHEN rse_type = 'TAPE' THEN ['srm', 'pnfs', 'disk'] ELSE ['srm'] END) AS protocol FROM rses""",
)
def _(c):
    edge = lambda df, a, b: df.select(F.col("rse").alias("key"), F.lit(a).alias("protocol"), F.lit(b).alias("chain"))
    tape = c.rses.filter("rse_type = 'TAPE'")
    rules = edge(tape, "srm", "pnfs").unionByName(edge(tape, "pnfs", "disk")).unionByName(edge(c.rses, "other", "srm")).unionByName(edge(tape, "disk", "pnfs"))
    return cont.rule_chain_closure(rules, c.rses.select(F.col("rse").alias("key"), F.lit("srm").alias("protocol")))


@registered(
    "protocol_priority",
    """SELECT rse, p.protocol, CAST(w AS INTEGER) AS "read", CAST(CASE WHEN tier = 0 THEN NULL ELSE w END AS INTEGER) AS "write",
              CAST(w AS INTEGER) AS tpc_read, CAST(CASE WHEN tier = 0 THEN NULL ELSE w END AS INTEGER) AS "delete"
       FROM rses, (SELECT unnest(['WebDAV', 'XRootD', 'SRMv2']) AS protocol, unnest([1, 3, 2]) AS w) p""",
)
def _(c):
    rows = c.rses.select("rse", "tier", F.explode(F.array(*[F.lit(p) for p in ("WebDAV", "XRootD", "SRMv2")])).alias("protocol"))
    wan = P.protocol_priority("protocol", F.when(F.col("tier") == 0, "global-ro").otherwise("global-rw"))
    get = lambda op: F.try_element_at("wan", F.lit(op))
    return rows.withColumn("wan", wan).select(
        "rse", "protocol", get("read").alias("read"), get("write").alias("write"),
        get("third_party_copy_read").alias("tpc_read"), get("delete").alias("delete"),
    )


# --- endpoints and accounts ----------------------------------------------------------
@registered("tier_country", "SELECT rse, CAST(tier AS VARCHAR) AS tier, country FROM rses")
def _(c):
    return c.rses.select("rse", N.tier_country("rse").alias("t")).select("rse", "t.tier", "t.country")


@registered(
    "rse_variants",
    """SELECT r.rse AS base, v.variant, r.rse || v.suffix AS rse, '/pool/' || v.folder AS prefix
       FROM rses r, (SELECT unnest(['real', 'test', 'temp', 'user']) AS variant, unnest(['', '_Test', '_Temp', '_User']) AS suffix,
                            unnest(['', 'store/test/', 'store/temp/', '']) AS folder) v""",
)
def _(c):
    rows = c.rses.select(F.col("rse").alias("base"), F.explode(N.rse_variants("rse", F.lit("/pool"))).alias("v"))
    return rows.select("base", "v.variant", "v.rse", "v.prefix")


@registered("sync_account_name", "SELECT rse, substr('sync_' || lower(rse), 1, 25) AS account FROM rses")
def _(c):
    return c.rses.select("rse", N.sync_account_name("rse").alias("account"))


@registered(
    "group_account_name",
    """SELECT rse, replace(lower(rse), '_', '_') || CASE WHEN length(rse) > 13 THEN '_local' ELSE '_local_users' END AS account FROM rses""",
)
def _(c):
    return c.rses.select("rse", N.group_account_name(F.replace(F.lower("rse"), F.lit("_"), F.lit("-"))).alias("account"))


@registered("purge_flag", "SELECT rse, contains(rse, 'Tape') AS purge FROM rses")
def _(c):
    return c.rses.select("rse", N.purge_flag("rse").alias("purge"))


@registered(
    "rfc2253_dn",
    """SELECT account, CASE account_type WHEN 'USER' THEN 'CN=' || account || ' A\\, B,OU=users,DC=org' ELSE '' END AS dn FROM accounts
       UNION ALL SELECT account, 'plain ' || account FROM accounts""",
)
def _(c):
    dn = F.when(
        F.col("account_type") == "USER", F.concat(F.lit("/DC=org/OU=users/CN="), "account", F.lit(" A, B"))
    ).otherwise(F.concat(F.lit("/DC=org/users/CN="), "account"))
    both = c.accounts.select("account", F.explode(F.array(dn, F.concat(F.lit("plain "), "account"))).alias("dn"))
    return both.select("account", N.rfc2253_dn("dn").alias("dn"))


# --- text, values --------------------------------------------------------------------
@registered(
    "ticket_links",
    r"""SELECT id, regexp_replace(reason, '([A-Z]{4,}-[0-9]+)', '<a href="https://tickets.example.org/\1" target="_blank">\1</a>', 'g') AS html,
              array_to_string(regexp_extract_all(reason, 'CMS(?:PROD|TRANSF|DM|TZ)-[0-9]+'), ',') AS ids FROM inv_requests""",
)
def _(c):
    return c.inv_requests.select(
        "id", N.ticket_links("reason", "https://tickets.example.org").alias("html"), F.array_join(N.ticket_ids("reason"), ",").alias("ids")
    )


@registered("job_id", "SELECT id, substr(job_id, 23, 8) AS job FROM inv_requests")
def _(c):
    return c.inv_requests.select("id", N.job_id("job_id", "file-invalidation-job-").alias("job"))


@registered(
    "normalize_adler32",
    """SELECT name, CASE WHEN brand = 'Brand#1' THEN NULL ELSE lpad(adler32, 8, '0') END AS adler32 FROM files""",
)
def _(c):
    text = F.when(F.col("brand") == "Brand#1", F.concat(F.lit("md5:"), "adler32")).otherwise(
        F.concat(F.lit("md5:ab,adler32:"), F.upper("adler32"), F.lit(",cksum:12"))
    )
    return c.files.select("name", V.normalize_adler32(text).alias("adler32"))


@registered(
    "checksum_equal",
    """SELECT r.name, g.rse, g.checksum = r.adler32 AS same, ltrim(g.checksum, '0') = ltrim(r.adler32, '0') AS zeros,
              ltrim(lower(g.checksum), '0') = ltrim(lower(r.adler32), '0') AS number
       FROM files r JOIN storage_listing g ON g.name = r.name""",
)
def _(c):
    rows = c.files.select("name", "adler32").join(c.storage_listing, "name")
    equal = lambda how: V.checksum_equal("checksum", "adler32", how)
    return rows.select("name", "rse", equal("exact").alias("same"), equal("zeros").alias("zeros"), equal("number").alias("number"))


@registered(
    "storage_match",
    """SELECT r.name, s.rse, CASE WHEN g.size IS NULL THEN 'no file found' WHEN g.size <> r.bytes THEN 'wrong size'
              WHEN ltrim(lower(g.checksum), '0') <> r.adler32 THEN 'wrong checksum' ELSE 'ok' END AS verdict
       FROM replicas r JOIN rses s ON s.rse_id = r.rse_id LEFT JOIN storage_listing g ON g.name = r.name AND g.rse = s.rse""",
)
def _(c):
    rows = replicas_named(c).join(c.storage_listing.select("name", "rse", "size", "checksum"), ["name", "rse"], "left")
    checksum = F.lower(F.ltrim("checksum", F.lit("0")))
    return rows.select("name", "rse", V.storage_verdict(F.col("size"), checksum, F.col("bytes"), F.col("adler32")).alias("verdict"))


_SIZE_SQL = """CASE WHEN n = 0 THEN '0B' WHEN n < {b} THEN CAST(CAST(printf('%.2f', n / 1.0::DOUBLE) AS DOUBLE) AS VARCHAR) || ' B'
    WHEN n < {b}::BIGINT * {b} THEN CAST(CAST(printf('%.2f', n / {b}.0::DOUBLE) AS DOUBLE) AS VARCHAR) || ' KB'
    WHEN n < {b}::BIGINT * {b} * {b} THEN CAST(CAST(printf('%.2f', n / ({b}.0::DOUBLE * {b})) AS DOUBLE) AS VARCHAR) || ' MB'
    WHEN n < {b}::BIGINT * {b} * {b} * {b} THEN CAST(CAST(printf('%.2f', n / ({b}.0::DOUBLE * {b} * {b})) AS DOUBLE) AS VARCHAR) || ' GB'
    ELSE CAST(CAST(printf('%.2f', n / ({b}.0::DOUBLE * {b} * {b} * {b})) AS DOUBLE) AS VARCHAR) || ' TB' END"""


_SIZES = """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey WHEN o_orderpriority = '1-URGENT' THEN o_orderkey * o_orderkey * 9973
    ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS n FROM orders"""


@registered("human_size", f"SELECT n, {_SIZE_SQL.format(b=1024)} AS size FROM ({_SIZES})")
def _(c):
    return c.sql(_SIZES).select("n", V.human_size("n").alias("size"))


@registered("human_size_si", f"SELECT n, {_SIZE_SQL.format(b=1000)} AS size FROM ({_SIZES})")
def _(c):
    return c.sql(_SIZES).select("n", V.human_size_si("n").alias("size"))


@registered("min_free_bytes", "SELECT rse, CAST(floor(used * (CASE WHEN tier = 1 THEN 5.0 ELSE 10.0 END::DOUBLE / 100.0::DOUBLE)) AS BIGINT) AS min_free FROM space_held")
def _(c):
    percent = F.when(F.col("tier") == 1, F.lit("5"))
    return c.space_held.select("rse", V.min_free_bytes("used", percent).alias("min_free"))


@registered("snapshot_day", "SELECT event_id, strftime(ts - INTERVAL 6 HOUR, '%Y-%m-%d') AS day FROM events")
def _(c):
    return c.events.select("event_id", F.date_format(V.snapshot_day("ts"), "yyyy-MM-dd").alias("day"))


@registered(
    "epoch_to_ts",
    "SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000000 * 1000000), '%Y-%m-%d %H:%M:%S') AS at FROM events",
)
def _(c):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return c.events.select("event_id", F.date_format(V.epoch_to_ts(seconds), "yyyy-MM-dd HH:mm:ss").alias("at"))

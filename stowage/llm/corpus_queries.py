"""Registered: every operator of this part over its whole table, with SQL where SQL can say it."""

from pyspark.sql import functions as F

from ..session import scratch_path
from . import chat, decontaminate, hilbert, packing, periodic, prefix_trie, quality, secret_scan, simhash, token_counts, url_lists, warc, wrapper
from .common import table

SHARDS = 40


def op1_hilbert_shards(spark, sf_dir):
    """Shard and place of every document along a curve over language, source and length."""
    placed = hilbert.curve_shards(table(spark, sf_dir, "documents"), SHARDS, ["lang", "source", "n_chars"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "curve_index",
    )


def op2_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_chat_format(spark, sf_dir):
    """Rendered text of every maximal conversation."""
    return chat.chat_texts(table(spark, sf_dir, "conversations"))


def op4_warc(spark, sf_dir):
    """Write all pages to an archive in the shared folder, and report what reading it gives."""
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select(
        F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op5_best_fit_packing(spark, sf_dir):
    """Place of every piece of every document in packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark, sf_dir):
    """Secret spans of every document."""
    found = secret_scan.secret_spans(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        secret_scan.base_digest(F.col("spans")).alias("base_sha256"), secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op7_decontaminate(spark, sf_dir):
    """Benchmark windows in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op8_token_counts(spark, sf_dir):
    """Tokens of every line of every document."""
    return token_counts.section_tokens(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark, sf_dir):
    """Measures and verdict of every document."""
    return quality.judge_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_url_lists(spark, sf_dir):
    """Verdict of every page.  Fetch dates and list changes are derived from the pages."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.expr("date_add(date'2020-01-01', cast(page_id * 37 % 1000 as int))").alias("fetched_on")
    )
    domains = pages.select(F.regexp_extract(F.lower("url"), r"://(?:[^/?#@]*@)?([^/?#:@]+)", 1).alias("domain")).distinct()
    day = "date_add(date'2020-01-01', 40 * instr('0123456789abcdef', substr(md5(domain), {}, 1)))"
    steps = [("block", 1, "0"), ("remove", 2, "4"), ("allow", 3, "8"), ("block", 4, "b")]
    changes = None
    for action, place, least in steps:
        own = domains.filter(f"domain <> '' AND substr(md5(domain), {place + 4}, 1) >= '{least}'").select(
            "domain", F.lit(action).alias("action"), F.expr(day.format(place)).alias("listed_on")
        )
        changes = own if changes is None else changes.union(own)
    found = url_lists.judge_captures(pages, changes)
    return found.withColumns({c: found[c].cast("string") for c in ("fetched_on", "valid_from")})


def op11_periodic_runs(spark, sf_dir):
    """Periodic runs of every document, after one in ten has got a periodic tail."""
    found = periodic.periodic_runs(periodic.with_planted_runs(table(spark, sf_dir, "documents")))
    best = found.withColumn("best", periodic.longest_run(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_html_extraction(spark, sf_dir):
    """Main text of every page."""
    found = wrapper.extracted(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op13_prefix_trie(spark, sf_dir):
    """Nodes of the prefix trie of all conversations, which begin alike by a rule on their ids."""
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_beginnings(turns))


QUERIES = {
    f.__name__: f
    for f in (
        op1_hilbert_shards, op2_simhash, op3_chat_format, op4_warc, op5_best_fit_packing, op6_secret_scan,
        op7_decontaminate, op8_token_counts, op9_quality_rules, op10_url_lists, op11_periodic_runs, op12_html_extraction,
        op13_prefix_trie,
    )
}

CHECKS = {
    "op3_chat_format": r"""
        WITH c AS (
            SELECT conv_id, count(*) AS n_turns, list({'role': role, 'text': text} ORDER BY turn, role) AS t,
                   string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || replace(coalesce(text, ''), '<|', '< |')
                              || '<|im_end|>' || chr(10), '' ORDER BY turn, role) AS text
            FROM conversations GROUP BY conv_id),
        one AS (SELECT t, min(conv_id) AS conv_id, count(*) AS copies FROM c GROUP BY t),
        prefix AS (SELECT DISTINCT list_slice(t, 1, k) AS t FROM (SELECT t, unnest(range(1, n_turns)) AS k FROM c))
        SELECT c.conv_id, 0 AS part, c.n_turns, one.copies, c.text
        FROM one JOIN c ON c.conv_id = one.conv_id WHERE NOT EXISTS (SELECT 1 FROM prefix p WHERE p.t = one.t)
    """,
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        f AS (SELECT page_id, strlen(body) AS n, sha1(body) AS d, max(page_id) OVER (PARTITION BY body) AS first_id FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
        FROM f
    """,
    "op7_decontaminate": r"""
        WITH low AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        d AS MATERIALIZED (SELECT * FROM low),
        i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (SELECT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS t
                FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM win),
        dw AS (SELECT r, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS t
               FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
        hit AS (SELECT DISTINCT r, s, dw.n, item_id FROM dw JOIN win ON dw.t = win.t AND dw.n = win.n),
        cov AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS q FROM hit) GROUP BY r),
        its AS (SELECT r, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ','
                ORDER BY CAST(item_id AS VARCHAR))) AS h FROM hit GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
    """,
    "op9_quality_rules": r"""
        WITH d AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
            FROM documents),
        win AS (SELECT r, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s
                FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 7)),
        dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1),
        rep AS (SELECT r, sum(least(8, i - p)) AS n FROM
                (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), i - 8) AS p FROM dup) GROUP BY r),
        m AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                     CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
                     CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
              FROM d LEFT JOIN rep USING (r)),
        f AS (SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeats,
                     100 * n_symbols > 10 * word_chars AS symbols, 100 * n_dup_lines > 30 * n_lines AS lines FROM m),
        long AS (SELECT source, x.rule AS rule, CAST(x.bad AS INT) AS bad FROM
                 (SELECT source, unnest([{'rule': 's', 'bad': short}, {'rule': 'r', 'bad': repeats},
                                         {'rule': 'y', 'bad': symbols}, {'rule': 'l', 'bad': lines}]) AS x FROM f) WHERE source IS NOT NULL),
        h AS (SELECT source, rule, CAST(count(*) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS f FROM long GROUP BY ALL),
        p AS (SELECT rule, sum(f) / sum(n) AS mean, sum(n) AS n, count(*) AS k, sum(n * n) AS nn, sum(f * f / n) AS ff FROM h GROUP BY rule),
        q AS (SELECT rule, mean, 1 / greatest(1e-6, least(1 - 1e-6, coalesce((ff - n * mean * mean - (k - 1) * mean * (1 - mean))
                     / nullif(mean * (1 - mean) * (n - nn / n - (k - 1)), 0), 0))) - 1 AS strength FROM p),
        bad AS (SELECT DISTINCT source FROM h JOIN q USING (rule) WHERE (f + mean * strength) / (h.n + strength) > 0.5)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
               NOT (short OR repeats) AND bad.source IS NULL AS kept
        FROM f LEFT JOIN bad ON f.source = bad.source
    """,
    "op10_url_lists": r"""
        WITH pg AS (SELECT page_id, CAST(date '2020-01-01' + CAST(page_id * 37 % 1000 AS INT) AS DATE) AS fetched_on,
                    nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.+$', ''), '')
                    AS host, regexp_extract(lower(url), '://(?:[^/?#@]*@)?([^/?#:@]+)', 1) AS raw FROM pages),
        dom AS (SELECT DISTINCT raw AS domain, md5(raw) AS m FROM pg WHERE raw <> ''),
        ch AS (SELECT domain, CAST(date '2020-01-01' + CAST(40 * instr('0123456789abcdef', substr(m, place, 1)) AS INT) AS DATE) AS listed, s
               FROM dom, (VALUES (1, 3, '0'), (2, 1, '4'), (3, 2, '8'), (4, 3, 'b')) v(place, s, least_one)
               WHERE substr(m, place + 4, 1) >= least_one),
        dated AS (SELECT domain, listed, max(s) AS s FROM ch GROUP BY ALL),
        iv AS (SELECT *, lead(listed) OVER (PARTITION BY domain ORDER BY listed) AS valid_to FROM dated),
        m AS (SELECT page_id, max({'n': length(domain), 'domain': domain, 'action': CASE s WHEN 3 THEN 'block' ELSE 'allow' END, 'f': listed}) AS e
              FROM pg JOIN iv ON (host = domain OR ends_with(host, '.' || domain)) AND s > 1 AND fetched_on >= listed
                   AND (valid_to IS NULL OR fetched_on < valid_to) GROUP BY page_id)
        SELECT pg.page_id, host, CAST(fetched_on AS VARCHAR) AS fetched_on, e.action AS action, e.domain AS domain, CAST(e.f AS VARCHAR) AS valid_from,
               coalesce(e.action = 'block', false) AS blocked FROM pg LEFT JOIN m USING (page_id)
    """,
}

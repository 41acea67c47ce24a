"""Quality rules with verdicts on whole hosts.  DataFrame functions only.

Each document is measured (``measures``) and held against the rules in ``RULES``.  Failures are summed
by host, a host's rate of each rule is shrunk towards the rate of all hosts with a beta prior fitted to
the hosts themselves, and hosts whose shrunk rate of any rule is above ``HOST_LIMIT`` are rejected.  The
verdict comes back to the documents by a join on the host.

A document is kept unless it breaks a base rule (too short, or too repetitive) or its host is rejected.
A host with few documents is judged mostly by what hosts are like in general, so one bad page does not
reject a small host.

Defined cases: a null text is an empty one and so breaks the length rule; documents without a host are
judged alone; ties cannot occur; repeated rows count each; further columns are ignored by
``judge_documents`` and handed on by ``kept_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_table, pick, tagged, untagged

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
SYMBOL_PERCENT = 10
DUP_LINE_PERCENT = 30
HOST_LIMIT = 0.5
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def given(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, though it is used in several places or in a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeat_words(words: Column) -> Column:
    """Words that lie in windows of ``WINDOW`` words found twice or more, the first find included.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes, within one text only.
    """

    def of_hashes(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
        return given(F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW))), of_windows)

    def of_windows(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(
            given(F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of_sorted)
        )

    def of_sorted(pairs: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            before = F.get(pairs, i - 1)["h"] == x["h"]
            after = F.get(pairs, i + 1)["h"] == x["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        places = F.array_sort(F.transform(F.filter(pairs, twice), lambda x: x["i"]))
        return F.aggregate(
            places,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, given(hashes, of_hashes)).otherwise(F.lit(0))


def of_text(text: Column, measure) -> Column:
    """Apply ``measure`` to the list of words of ``text``."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), "")
    return given(words, measure)


def measures(text: Column) -> Column:
    """A struct of ``MEASURES`` of one text."""
    whole = F.coalesce(text, F.lit(""))
    solid = F.translate(whole, SPACES, "")
    lines = F.filter(F.split(whole, "\n", -1), lambda line: F.translate(line, SPACES, "") != "")
    counted = of_text(text, lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("r")))
    by_line = given(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    values = (
        counted["n"],
        F.length(solid),
        F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")),
        by_line["n"],
        by_line["d"],
        counted["r"],
    )
    return F.struct(*(v.cast("bigint").alias(name) for v, name in zip(values, MEASURES)))


def fails(m) -> dict[str, Column]:
    """Each rule's failure, from measures that ``m(name)`` hands out."""
    return {
        "short": m("n_words") < MIN_WORDS,
        "repeats": 100 * m("n_repeat_words") > REPEAT_PERCENT * m("n_words"),
        "symbols": 100 * m("n_symbols") > SYMBOL_PERCENT * m("word_chars"),
        "lines": 100 * m("n_dup_lines") > DUP_LINE_PERCENT * m("n_lines"),
    }


BASE = ("short", "repeats")
RULES = ("short", "repeats", "symbols", "lines")


def beta_prior(hosts: DataFrame, rule: str) -> Column:
    """(mean, strength) of the beta prior of one rule, as one scalar subquery over the host table.

    Strength from the analysis-of-variance estimate of the correlation within hosts.  Without any
    (one host, no failure, no more spread than chance) it is 10^6 documents: all hosts as the mean.
    """
    n, f = F.col("n"), F.col(rule)
    sums = hosts.agg(
        F.sum("n").alias("n"), F.sum(rule).alias("f"), F.count(F.lit(1)).alias("k"), F.sum(n * n).alias("nn"),
        F.sum(f * f / n).alias("ff"),
    )
    mean = F.col("f") / F.col("n")
    noise = mean * (1 - mean)
    spread = F.col("ff") - F.col("n") * mean * mean - (F.col("k") - 1) * noise
    room = noise * (F.col("n") - F.col("nn") / F.col("n") - (F.col("k") - 1))
    rho = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.coalesce(F.try_divide(spread, room), F.lit(0.0))))
    return sums.select(F.struct(mean.alias("mean"), (1 / rho - 1).alias("strength"))).scalar()


def host_verdicts(measured: DataFrame) -> DataFrame:
    """One row per host of ``measured`` (host, and a 0/1 column per rule): shrunk rates and ``rejected``."""
    hosts = measured.filter("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(rule).alias(rule) for rule in RULES)
    )
    hosts = keep_table(hosts, "hosts")
    rates = hosts.select("host", "n", *RULES, *(beta_prior(hosts, rule).alias(f"{rule}_prior") for rule in RULES))
    for rule in RULES:
        prior = F.col(f"{rule}_prior")
        shrunk = (F.col(rule) + prior["mean"] * prior["strength"]) / (F.col("n") + prior["strength"])
        rates = rates.withColumn(f"{rule}_rate", shrunk)
    return rates.select(
        "host", "n", *(f"{r}_rate" for r in RULES), (F.greatest(*(F.col(f"{r}_rate") for r in RULES)) > HOST_LIMIT).alias("rejected")
    )


def measured_documents(docs: DataFrame, text_col: str, id_col: str, host_col: str) -> DataFrame:
    rows = pick(docs, doc_id=id_col, host=host_col, text=text_col)
    found = rows.select("doc_id", "host", measures(F.col("text")).alias("m")).select("doc_id", "host", "m.*")
    return found.select("*", *(failed.cast("int").alias(rule) for rule, failed in fails(F.col).items()))


def judge_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", host_col: str = "source") -> DataFrame:
    """One row per document: doc_id, host, measures, a column per rule, base_failed, host_rejected, kept.

    Runs jobs while the plan is built: the measures are worked out once, into a narrow table, and the
    host table is stored so that its size is known to the joins.
    """
    kept = keep_table(measured_documents(docs, text_col, id_col, host_col), "measures")
    bad = keep_table(host_verdicts(kept).filter("rejected").select("host", F.lit(True).alias("bad")), "bad-hosts")
    base = (F.col("short") + F.col("repeats")) > 0
    return (
        kept.join(bad, "host", "left")
        .withColumn("base_failed", base)
        .withColumn("host_rejected", F.coalesce("bad", F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .drop("bad")
    )


def kept_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents that ``judge_documents`` keeps, with all their columns.

    Texts are not shuffled: base rules apply to the row, and only rejected hosts are joined.
    """
    measured = measured_documents(docs, text_col, host_col, host_col)
    bad = keep_table(host_verdicts(measured).filter("rejected").select(F.col("host").alias("_bad")), "bad-hosts")
    rows, own = tagged(docs, text=text_col, host=host_col)
    good = rows.filter(~broken_text(F.col("text"))).join(bad, F.col("host") == F.col("_bad"), "left_anti")
    return untagged(good, own, docs.columns)


def broken_text(text: Column) -> Column:
    """Whether the text breaks a base rule."""

    def broken(words: Column) -> Column:
        n = F.size(words)
        return (n < MIN_WORDS) | (100 * repeat_words(words) > REPEAT_PERCENT * n)

    return of_text(text, broken)

"""Periodic runs: stretches of words that repeat with a period, by an online sparse diagonal DP.

Comparing a text with itself, the words that equal the word ``lag`` places before them lie on the diagonal of that lag,
and a diagonal that holds for ``m`` words is a stretch of ``m + lag`` words with period ``lag``.  The text is walked once
per scale, from left to right: each word with an earlier occurrence increments the match length of that occurrence's
lag, any other word ends the active diagonal, and a diagonal that ends long enough gives out its run at once.

All earlier occurrences of a frequent word would make the walk quadratic.  Two things keep it sparse, and exact:

- At scale ``g`` (1, 2, 4, ...) a word stands for itself and the ``g - 1`` words before it, and only lags from
  ``g / 2 + 1`` to ``g`` are followed.  Words in context are named by doubling: the name at ``2g`` is the pair of the names
  at ``g`` of the two halves, and a word whose context occurs once is left out from there on.
- Only the *latest* earlier occurrence counts.  Within a run of smallest period ``q <= g`` two equal contexts of ``g`` words
  are never nearer than ``q`` (else the run had a smaller period), so the latest one is on the run's own diagonal; and a
  diagonal found like this has no smaller period, so no further test is needed.

A scale has one active diagonal, a text of n words takes n log n steps and memory in proportion to n.  Texts are worked
on in small groups inside a task; nothing is shuffled.

Defined cases: a null or empty text has no runs and an empty collapsed text; repeated rows give repeated results; further
columns are ignored; runs may overlap and nest, equal (start, length) cannot have two smallest periods.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick

MIN_LENGTH = 6
MIN_PERIODS = 4
# texts are taken together up to about so many bytes; a longer one is worked on alone
GROUP_BYTES = 1 << 21
Run = tuple[int, int, int]


def latest_before(names: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each place, how far back the latest earlier place with the same name is; 0 if there is none."""
    order = np.argsort(names, kind="stable")
    lag = np.zeros(len(names), np.int64)
    same = names[order[1:]] == names[order[:-1]]
    lag[order[1:][same]] = (places[order[1:]] - places[order[:-1]])[same]
    return lag


def closing_diagonals(places: np.ndarray, lags: np.ndarray, context: int, min_length: int, min_periods: int) -> Iterator[Run]:
    """Walk the words that lie on a followed diagonal; give out (start, length, period) of each that ends long enough."""
    active, last, matched = 0, -2, 0
    for place, lag in zip(places.tolist(), lags.tolist()):
        if lag == active and place == last + 1:
            matched += 1
        else:
            if matched + active >= min_length and matched >= (min_periods - 1) * active > 0:
                yield last - matched - active + 1, matched + active, active
            active, matched = lag, context
        last = place
    if matched + active >= min_length and matched >= (min_periods - 1) * active > 0:
        yield last - matched - active + 1, matched + active, active


def periodic_runs_of(words: np.ndarray, longest: int, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[Run]:
    """Runs of a sequence of word numbers, in no order.  ``longest``: the longest text in it, if it holds several."""
    if min_periods < 2:
        raise ValueError("a run has two periods at least")
    places, names, context, found = np.arange(len(words)), words, 1, []
    while len(places) and context // 2 < longest // min_periods:
        lags = latest_before(names, places)
        on = (lags > context // 2) & (lags <= context)
        found.extend(closing_diagonals(places[on], lags[on], context, min_length, min_periods))
        # the next scale: contexts that occur again, and whose first half does
        _, names, counts = np.unique(names, return_inverse=True, return_counts=True)
        again = counts[names] > 1
        places, names = places[again], names[again]
        at = np.searchsorted(places, places - context)
        paired = (at < len(places)) & (places[np.minimum(at, len(places) - 1)] == places - context)
        names = names[at[paired]] * np.int64(len(counts)) + names[paired]
        places, context = places[paired], 2 * context
    return found


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def runs_of_texts(texts: list[str | None], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS):
    """For each text its runs, by start, then period, and the text without repeated periods, words joined by a blank."""
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = [len(w) for w in split]
    # one word that occurs nowhere else stands between two texts, so that no diagonal goes across
    flat = [w for words in split for w in (*words, b"")]
    numbers = pd.factorize(np.array(flat, dtype=object))[0].astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(np.array(sizes) + 1)))
    numbers[starts[1:] - 1] = len(flat) + np.arange(len(sizes))
    by_text: list[list[Run]] = [[] for _ in sizes]
    found = periodic_runs_of(numbers, max(sizes, default=0), min_length, min_periods)
    owner = np.searchsorted(starts, np.array([start for start, _, _ in found], np.int64), side="right") - 1
    for k, (start, length, period) in zip(owner.tolist(), found):
        by_text[k].append((start - int(starts[k]), length, period))
    for words, runs in zip(split, by_text):
        runs.sort(key=lambda r: (r[0], r[2]))
        if runs:
            words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
        yield runs, b" ".join(words).decode("utf-8", "surrogatepass")


def periodic_runs(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS
) -> DataFrame:
    """One row per document: doc_id, runs (array of start, length, period; in words) and the collapsed text."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def groups(batch: pa.RecordBatch):
        first, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(batch.column(1)).to_pylist()):
            if i > first and size + (n or 0) > GROUP_BYTES:
                yield batch.slice(first, i - first)
                first, size = i, 0
            size += n or 0
        if batch.num_rows:
            yield batch.slice(first)

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in groups(batch):
                runs, texts = zip(*runs_of_texts(part.column(1).to_pylist(), min_length, min_periods))
                listed = pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], pa.list_(run))
                yield pa.RecordBatch.from_arrays([part.column(0), listed, pa.array(texts, pa.string())], ["doc_id", "runs", "collapsed"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def longest_run(runs):
    """The run with the greatest length, then the least start, then the least period; null if there is none."""
    better = lambda a, b: (
        (b["length"] > a["length"])
        | ((b["length"] == a["length"]) & ((b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))))
    )
    return F.aggregate(runs, F.try_element_at(runs, F.lit(1)), lambda best, run: F.when(better(best, run), run).otherwise(best))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one document in ten gets a periodic tail by a rule on its id.

    With h = crc32(decimal id) and g = h / 10, if h % 10 = 0 the words from a = g % n on repeat the p words there,
    p = 1 + (n - a) / (3 + g % 8), divided without remainder.  Documents without an id, and without words, stay.
    """
    rows = pick(docs, doc_id="doc_id", text="text")
    h = F.crc32(F.col("doc_id").cast("string"))
    words = rows.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("bigint").alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)).alias("w"))
    sized = words.withColumn("n", F.size("w").cast("bigint"))
    placed = sized.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("bigint")
    head = F.slice("w", F.lit(1), F.col("a").cast("int"))
    unit = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    rest = (F.col("n") - F.col("a")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    changed = placed.withColumn("p", period)
    return changed.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text")).alias("text"))

"""Benchmark decontamination by a prefix-filtered join.

A window is ``window`` consecutive words of a benchmark item (a shorter item is one window).  A
document word is hit when it lies in any occurrence of a window.

1. Every window has shingles of up to three words.  Their counts over all documents give one order
   by rarity.  An exact occurrence of a window holds all its shingles, so a prefix of length one,
   its rarest shingle, is all that has to be joined.
2. Documents are searched for prefix shingles through a bitmap of fixed size (``SLOTS`` bits, 2 MB
   whatever the benchmark), which only saves work: what it lets pass by mistake fails the join.
3. Candidates, with the words around them, meet the windows on the shingle.  Positional bound: the
   window starts at the shingle's place less its offset in the window, not before the document.
   Length bound: it ends within the document.  Then the words themselves are compared.

Words are the runs of ASCII letters and digits and all non-ASCII characters, after lower-casing A-Z.

Defined cases: null, empty and wordless texts and items have no words and no hits; repeated items and
windows count per item_id; items without item_id still hit words but are no listed item; repeated documents
give repeated results; an empty benchmark hits nothing; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import document_key, keep_table, pick

SHINGLE = 3
SLOT_BITS = 24
SLOTS = 1 << SLOT_BITS
# bytes to words: letters in lower case, digits and non-ASCII bytes stay, all else separates
WORD_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z" else b + 32 if "A" <= chr(b) <= "Z" else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class WordHashes(dict):
    """64-bit word hashes; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def shingles(self, words: list[bytes], size: int) -> np.ndarray:
        """A hash for each run of ``size`` words."""
        h = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        n = len(words) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        found = np.full(n, size, np.uint64)
        for i in range(size):
            found = (found ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            found ^= found >> np.uint64(29)
        return found


def window_rows(items: DataFrame, window: int, text_col: str, id_col: str) -> DataFrame:
    """One row per window and shingle of it: item_id, words (joined), n (words), size, offset, hash."""
    rows = pick(items, item_id=id_col, text=text_col)
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        hashes = WordHashes()
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                n = min(window, len(words))
                size = min(SHINGLE, n)
                if not n:
                    continue
                found = hashes.shingles(words, size).view(np.int64)
                for start in range(len(words) - n + 1):
                    joined = b" ".join(words[start : start + n]).decode("utf-8", "surrogatepass")
                    out.extend((item, joined, n, size, i, int(found[start + i])) for i in range(n - size + 1))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("item_id", "words", "n", "size", "offset", "hash"), row)) for row in out],
                schema=pa.schema(
                    [("item_id", batch.schema[0].type), ("words", pa.string()), ("n", pa.int32()), ("size", pa.int32())]
                    + [("offset", pa.int32()), ("hash", pa.int64())]
                ),
            )

    return rows.mapInArrow(run, f"item_id {kind}, words string, n int, size int, offset int, hash bigint")


def bitmap(hashes: DataFrame) -> np.ndarray:
    """Which of the ``SLOTS`` slots any of ``hashes`` falls into.  At most ``SLOTS / 32`` numbers come to the driver."""
    slots = hashes.select(F.shiftrightunsigned("hash", 64 - SLOT_BITS).alias("slot"))
    places = slots.groupBy(F.shiftright("slot", 5).cast("int").alias("place"))
    rows = places.agg(F.expr("bit_or(shiftleft(1L, cast(slot & 31 AS int)))").alias("bits")).toPandas()
    found = np.zeros(SLOTS // 32, np.uint32)
    found[rows["place"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).astype(np.uint32)
    return found


def passing(found: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Positions of the hashes whose slot is set."""
    slot = found >> np.uint64(64 - SLOT_BITS)
    return np.flatnonzero(seen[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32) & np.uint32(1))


def shingle_counts(docs: DataFrame, seen: np.ndarray, sizes: list[int], text_col: str) -> DataFrame:
    """How often each benchmark shingle occurs in all documents (hash, n); summed per batch first."""

    def run(batches: Iterator[pa.RecordBatch]):
        hashes = WordHashes()
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                for size in sizes:
                    h = hashes.shingles(words, size)
                    found.append(h[passing(h, seen)])
            value, n = np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"])

    counted = pick(docs, text=text_col).mapInArrow(run, "hash bigint, n bigint")
    return counted.groupBy("hash").agg(F.sum("n").alias("seen"))


def candidates(docs: DataFrame, seen: np.ndarray, sizes: list[int], window: int, text_col: str, id_col: str) -> DataFrame:
    """Per document: doc_id, key (of id and text), n_words, and the places of prefix shingles with the words around."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    rows = rows.withColumn("key", document_key(F.col("doc_id"), F.col("text")))

    def run(batches: Iterator[pa.RecordBatch]):
        hashes = WordHashes()
        for batch in batches:
            counts, ends, flat = [], [0], {"hash": [], "size": [], "place": [], "before": [], "around": []}
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                counts.append(len(words))
                for size in sizes:
                    h = hashes.shingles(words, size)
                    for place in passing(h, seen):
                        first = max(0, int(place) - (window - size))
                        flat["hash"].append(int(h[place].view(np.int64)))
                        flat["size"].append(size)
                        flat["place"].append(int(place))
                        flat["before"].append(int(place) - first)
                        around = b" ".join(words[first : int(place) + window])
                        flat["around"].append(around.decode("utf-8", "surrogatepass"))
                ends.append(len(flat["hash"]))
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string())
            inner = pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(flat.values(), types)], list(flat))
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), found],
                ["doc_id", "key", "n_words", "found"],
            )

    inner = "hash: bigint, size: int, place: int, before: int, around: string"
    return rows.mapInArrow(
        run, f"doc_id {rows.schema[0].dataType.simpleString()}, key binary, n_words bigint, found array<struct<{inner}>>"
    )


def occurrences(
    docs: DataFrame, items: DataFrame, window: int = 10, doc_text: str = "text", doc_id: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id",
) -> tuple[DataFrame, DataFrame]:
    """All documents (doc_id, key, n_words) and all window occurrences (key, place, n, item_id).

    Runs jobs: the corpus counts of benchmark shingles, and one narrow table of documents and candidates.
    """
    shingles = keep_table(window_rows(items, window, item_text, item_id), "windows")
    sizes = sorted(r.size for r in shingles.select("size").distinct().collect())  # 1 to 3
    counts = shingle_counts(docs, bitmap(shingles.select("hash").distinct()), sizes, doc_text)
    order = Window.partitionBy("words").orderBy(F.coalesce("seen", F.lit(0)), "hash", "offset")
    rarest = shingles.select("words", "n", "size", "offset", "hash").distinct().join(counts, "hash", "left")
    prefix = keep_table(
        rarest.withColumn("rank", F.row_number().over(order)).filter("rank = 1").select("words", "n", "size", "offset", "hash"),
        "prefixes",
    )
    kept = keep_table(candidates(docs, bitmap(prefix.select("hash").distinct()), sizes, window, doc_text, doc_id), "candidates")
    found = kept.select("key", "n_words", F.explode("found").alias("c")).select("key", "n_words", "c.*")
    begin = F.col("place") - F.col("offset")
    hits = (
        found.join(prefix, ["hash", "size"])
        .filter((begin >= 0) & (begin + F.col("n") <= F.col("n_words")))
        .filter(F.array_join(F.slice(F.split("around", " "), F.col("before") - F.col("offset") + 1, F.col("n")), " ") == F.col("words"))
        .select("key", begin.cast("bigint").alias("place"), "n", "words")
        .distinct()
    )
    named = hits.join(shingles.select("words", "item_id").distinct(), "words").select("key", "place", "n", "item_id")
    return kept.select("doc_id", "key", "n_words"), named


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, **columns: str) -> DataFrame:
    """One row per document: doc_id, key, n_words, n_hit, items (sorted ids as strings), contaminated."""
    every, hits = occurrences(docs, items, window, **columns)
    # words newly covered by each occurrence: its end less the furthest end before it
    runs = hits.groupBy("key", "place").agg(F.max("n").alias("n"))
    before = Window.partitionBy("key").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("place") + F.col("n")
    covered = runs.withColumn("reached", F.coalesce(F.max(end).over(before), F.lit(0)))
    n_hit = covered.groupBy("key").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("place", "reached"))).alias("n_hit"))
    ids: Column = F.array_sort(F.collect_set(F.col("item_id").cast("string")))  # at most the benchmark's items
    found = n_hit.join(hits.groupBy("key").agg(ids.alias("items")), "key")
    return every.join(found, "key", "left").select(
        "doc_id",
        "key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )

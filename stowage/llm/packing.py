"""Best-fit packing planned on the length histogram.

Documents become token ids with an end id; only documents longer than ``capacity`` are cut, into pieces
of ``capacity`` tokens of which the first may be shorter.  Best-fit decreasing then runs on *counts*: at
most ``capacity`` lengths with how many pieces each has, so planning costs the same for any corpus.  The
plan says, for each length, which ranks go to which sequences at which offset, and pieces take
their place by their rank within their length (``rank_within``, spread over many tasks).

Tokens are made once, into a narrow stored table (no ids); only the histogram comes to the driver.

Defined cases: null texts are empty, an empty document is the end id alone; equal pieces take
neighbouring ranks; repeated rows are packed as often as they occur; further columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_table, pick, rank_within

CAPACITY = 1024
END_ID = 2
TOKENIZER_PACKAGE, TOKENIZER_FILE = "public_tokenizers", "byte_bpe_50k.json"


def tokenizer_path() -> str:
    from importlib import import_module

    return import_module(TOKENIZER_PACKAGE).path(TOKENIZER_FILE)


class Encoder:
    """Ids of a byte-level BPE file as ``tokenizers`` gives them; the fast path reads the same vocabulary.

    ``tiktoken`` is several times faster with equal ids (a test compares them); where it gives up on
    a text, the slower library encodes it.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: byte-level split

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        self.ranks = {
            bytes(byte_of[c] for c in token): i for token, i in told["model"]["vocab"].items() if token not in special
        }
        self.special = special
        self.fast = tiktoken.Encoding("own", pat_str=self.PATTERN, mergeable_ranks=self.ranks, special_tokens=special)
        self.path, self.slow = path, None

    def ids(self, text: str | None) -> np.ndarray:
        try:
            return np.array(self.fast.encode(text or "", allowed_special="all"), np.uint32)
        except Exception:  # noqa: BLE001 - the library's own limits on odd texts; the slow path raises if it must
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path)
            return np.array(self.slow.encode(text or "", add_special_tokens=False).ids, np.uint32)

    def byte_lengths(self) -> np.ndarray:
        """Bytes that each id stands for."""
        found = np.zeros(max([*self.ranks.values(), *self.special.values()]) + 1, np.int64)
        for token, i in self.ranks.items():
            found[i] = len(token)
        for token, i in self.special.items():
            found[i] = len(token.encode())
        return found


def pieces(docs: DataFrame, capacity: int, path: str, text_col: str, id_col: str, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 per piece, and its ids if asked for."""
    rows = pick(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]):
        encoder = Encoder(path)
        for batch in batches:
            parent, out, ids = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                tokens = np.append(encoder.ids(text), np.uint32(END_ID)).astype("<u4")
                n, start, piece = len(tokens), 0, 0
                while start < n:
                    end = start + ((n - start - 1) % capacity + 1)
                    own = tokens[start:end]
                    parent.append(i)
                    out.append((piece, start, end - start, zlib.crc32(own.tobytes())))
                    if with_ids:
                        ids.append(own.astype(np.int64))
                    start, piece = end, piece + 1
            numbers = np.array(out, np.int64).reshape(-1, 4)
            columns = [batch.column(0).take(pa.array(parent, pa.int64())), pa.array(numbers[:, 0].astype(np.int32))]
            columns += [pa.array(numbers[:, i]) for i in (1, 2, 3)] + ([pa.array(ids, pa.list_(pa.int64()))] if with_ids else [])
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    schema = f"doc_id {rows.schema[0].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return rows.mapInArrow(run, schema + (", ids array<bigint>" if with_ids else ""))


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing over counts: (sequences, [(length, items of it in each of them), ...]).

    ``open_by_room`` holds groups of equal sequences under the room they have left.  Each length
    fills the sequences with the least room that fits, each to the full, as it would one by one.
    """
    open_by_room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        rooms = sorted(r for r, groups in open_by_room.items() if groups and r >= length)
        for room in [*rooms, capacity]:
            per = room // length
            groups = open_by_room.pop(room, []) if room != capacity else []
            if room == capacity:
                groups = [(-(-left // per), [])] if left else []
            for n, inside in groups:
                full = min(n, left // per)
                left -= full * per
                if full:
                    open_by_room[room - per * length].append((full, [*inside, (length, per)]))
                n -= full
                if n and left:  # fewer than would fill one
                    open_by_room[room - left * length].append((1, [*inside, (length, left)]))
                    n, left = n - 1, 0
                if n:
                    open_by_room[room].append((n, inside))
    return [group for groups in open_by_room.values() for group in groups]


def slots(planned: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, sequences, first sequence, offset) in rank order."""
    found, taken, first = defaultdict(list), defaultdict(int), 0
    for n, inside in planned:
        offset = 0
        for length, per in inside:
            found[length].append((taken[length], n, first, offset))
            taken[length] += n * per
            offset += length * per
        first += n
    return {length: np.array(rows, np.int64) for length, rows in found.items()}


def place(ranked: DataFrame, by_length: dict[int, np.ndarray]) -> DataFrame:
    """Give each piece the slot of its rank: sequence_id and offset."""
    schema = ", ".join(f"{n} {t}" for n, t in ranked.dtypes if n not in ("rank", "key_rows"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for own in np.unique(length):
                at = np.flatnonzero(length == own)
                rows = by_length[int(own)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                over = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + over % row[:, 1]
                offset[at] = row[:, 3] + over // row[:, 1] * own
            keep = [i for i, name in enumerate(batch.schema.names) if name not in ("rank", "key_rows")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(sequence), pa.array(offset)],
                [*(batch.schema.names[i] for i in keep), "sequence_id", "offset"],
            )

    return ranked.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def pack(
    docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, text_col: str = "text", id_col: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    ``with_ids`` carries the token ids along, for writing sequences.  Runs jobs: the stored
    table of pieces and its histogram of at most ``capacity`` rows.
    """
    kept = keep_table(pieces(docs, capacity, path or tokenizer_path(), text_col, id_col, with_ids), "pieces")
    histogram = {r.length: r["count"] for r in kept.groupBy("length").count().collect()}
    return place(rank_within(kept, ["length"]), slots(plan(histogram, capacity)))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and ids.  A sequence has at most ``capacity`` tokens."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda p: p["ids"])).alias("ids"))

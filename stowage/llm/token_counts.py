"""Token counts by section, from one encoding of the whole document.

A document is encoded once.  Byte-level tokens stand for known byte strings, so their running lengths
are exact spans; sections are spans too, and the two sorted lists are joined by searching token spans in
section bounds.  A token that crosses a boundary is counted whole, in one section, by rule:

``start``     the section of its first byte (default)
``majority``  the section with most of its bytes, the earlier one on a tie

so the sections' counts always add up to the document's.  Encoding sections apart would not do that.

Sections are lines here (each with its line end).  Spans are given in code points.

Defined cases: null and empty texts have one empty section without tokens; a text of line ends only has a
section for each; repeated rows give repeated results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick
from .packing import Encoder, tokenizer_path

COLUMNS = ("section", "start", "end", "n_tokens", "n_crossing")


def attribute(data: bytes, lengths: np.ndarray, rule: str) -> np.ndarray:
    """Rows (start, end, n_tokens, n_crossing) of the lines of ``data``; ``lengths``: bytes of each token."""
    raw = np.frombuffer(data, np.uint8)
    starts = np.concatenate([[0], np.flatnonzero(raw == 10) + 1])
    starts = starts[:1] if not len(raw) else starts[starts < len(raw)]
    ends = np.append(starts[1:], len(raw))
    to = np.cumsum(lengths)
    begin = to - lengths
    first = np.searchsorted(starts, begin, "right") - 1
    last = np.searchsorted(starts, to - 1, "right") - 1
    crossing = first < last
    chosen = first.copy()
    if rule == "majority":
        for i in np.flatnonzero(crossing):
            span = np.arange(first[i], last[i] + 1)
            share = np.minimum(ends[span], to[i]) - np.maximum(starts[span], begin[i])
            chosen[i] = span[share.argmax()]
    chars = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])
    n = len(starts)
    return np.column_stack(
        [chars[starts], chars[ends], np.bincount(chosen, minlength=n), np.bincount(chosen[crossing], minlength=n)]
    )


def section_tokens(
    docs: DataFrame, rule: str = "start", path: str | None = None, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row per document and line: doc_id, section (from 0), start, end, n_tokens, n_crossing (of these, crossing)."""
    if rule not in ("start", "majority"):
        raise ValueError(f"rule {rule!r}")
    path = path or tokenizer_path()
    rows = pick(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]):
        encoder = Encoder(path)
        length_of = encoder.byte_lengths()
        for batch in batches:
            parent, sections, found = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = attribute((text or "").encode(), length_of[encoder.ids(text)], rule)
                parent.append(np.full(len(own), i))
                sections.append(np.arange(len(own)))
                found.append(own)
            if found:
                numbers = np.concatenate(found).astype(np.int64)
                ids = batch.column(0).take(pa.array(np.concatenate(parent)))
                values = [pa.array(np.concatenate(sections).astype(np.int32)), *(pa.array(numbers[:, k]) for k in range(4))]
                yield pa.RecordBatch.from_arrays([ids, *values], ["doc_id", *COLUMNS])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, section int, start bigint, end bigint, n_tokens bigint, n_crossing bigint")

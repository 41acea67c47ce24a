"""Periodic runs against trying every period at every place."""

import hashlib
import random
import time
import zlib

import pytest

from stowage.llm import corpus_queries, periodic

DOCS = "doc_id bigint, text string, runs string, TEXT string"


def slow_runs(w):
    """Maximal stretches for each period; kept where no smaller period holds."""
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            own = w[start:j]
            if length >= max(6, 4 * q) and not any(all(own[k] == own[k - p] for k in range(p, length)) for p in range(1, q)):
                found.append((start, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def slow_row(doc, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()
    kept = b" ".join(x for i, x in enumerate(w) if i not in drop)
    return (doc, len(runs), s, n, q, 1000 * n // q if runs else None, sha(listed), sha(kept))


def some_texts():
    rng = random.Random(4)
    out = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "a b " * 4, "a b " * 3, "x " + "a b c " * 5 + "a b d"]
    for size in (2, 3, 5):
        out += [" ".join(rng.choice("abcde"[:size]) for _ in range(rng.randrange(1, 160))) for _ in range(60)]
    for _ in range(80):
        words = []
        while len(words) < 150:
            unit = [rng.choice("abc") for _ in range(rng.randrange(1, 14))]
            words += unit * rng.randrange(1, 7) + unit[: rng.randrange(len(unit))]
        out.append(rng.choice([" ", "\n", "\x0b "]).join(words))
    nested = ("a a a a a a b " * 5 + "c ") * 4
    return out + [nested, nested * 3, "é ß 日本 " * 6, "a\x85b " * 7, "x y x " * 9]


def test_against_every_period():
    texts = some_texts()
    for text, (runs, _) in zip(texts, periodic.runs_of_texts(texts)):
        assert runs == slow_runs((text or "").encode().split()), text


@pytest.mark.parametrize("group", [1, 300, 1 << 21])
def test_query(spark, monkeypatch, tmp_path, group):
    monkeypatch.setattr(periodic, "GROUP_BYTES", group)
    texts = some_texts()
    given = list(enumerate(texts)) + [(5, texts[5]), (5, texts[5]), (None, texts[200]), (7, texts[201])]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        frame = spark.createDataFrame([(i, t, "x", "y") for i, t in given], DOCS).repartition(3)
        frame.write.parquet(str(tmp_path / "documents.parquet"))
        got = [tuple(r) for r in corpus_queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert sorted(got, key=str) == sorted((slow_row(*d) for d in given), key=str)


def test_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], DOCS)).collect() == []


def test_other_bounds():
    (runs, text), = periodic.runs_of_texts(["a b a b c c c"], min_length=3, min_periods=2)
    assert runs == [(0, 4, 2), (4, 3, 1)] and text == "a b c"
    with pytest.raises(ValueError):
        list(periodic.runs_of_texts(["a"], min_periods=1))


@pytest.mark.parametrize("text", ["a " * 400000, "a b " * 200000, "the a of the " * 100000, " ".join(f"w{i % 997}" for i in range(400000))])
def test_long_repetitive_text(text):
    start = time.process_time()
    (runs, _), = periodic.runs_of_texts([text])
    assert len(runs) == 1 and time.process_time() - start < 30

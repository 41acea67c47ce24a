"""The prefix trie against grouping all beginnings of all conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from stowage.llm import corpus_queries, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, ROLE string"


def slow_trie(convs):
    """``convs``: id -> list of (role, text)."""
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in children[node])
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in own if len(convs[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.append((own[0], len(node), parent, len(own), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def some_rows(rng, n, longest):
    rows = []
    for c in rng.sample(range(n * 2), n):
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, turn if rng.random() < 0.9 else rng.choice([None, 0, 3]), rng.choice(["user", "assistant", None]), rng.choice(["a", "é b", "", None])))
    return rows


@pytest.mark.parametrize("block,ends,longest", [(1024, 512, 12), (2, 3, 40), (4, 1, 150)])
def test_query(spark, monkeypatch, tmp_path, block, ends, longest):
    """Small blocks: conversations are cut as sequences of blocks, several levels deep."""
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "ENDS", ends)
    rng = random.Random(block)
    rows = some_rows(rng, 50, longest)
    # a hot beginning, a hot conversation, repeated rows, no id
    rows += [(1000 + i, t, "user", "same") for i in range(30) for t in range(5)] + [(1000, 7, "user", "same")] * 40 + [(None, 1, "user", "x")] * 3
    rows += [(500, 0, "user", "x"), (500, 0, "user", "x"), (500, 0, "user", "y")]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
        got = [tuple(r) for r in corpus_queries.op13_prefix_trie(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert sorted(got, key=str) == slow_trie(rebuilt(rows))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA.replace("ROLE", "other")).write.parquet(str(tmp_path / "conversations.parquet"))
    assert corpus_queries.op13_prefix_trie(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("size", [1, 2, 8, 16])
def test_names_do_not_depend_on_what_follows(size):
    turns = [bytes([i]) * 16 for i in range(40)]
    whole, _ = prefix_trie.cut(prefix_trie.EMPTY, turns, 64)
    part, own = prefix_trie.cut(prefix_trie.EMPTY, turns[:size], size)
    assert part == whole[:size] and len(set(whole)) == 40
    assert own == prefix_trie.whole(turns[:size])

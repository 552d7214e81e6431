import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tests.llm import fixtures
from wardline.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, group=100, shared=6):
    """Sorted result rows of (conv_id, turn, role, text)."""
    said = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            said[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    said = {c: [t[1:] for t in sorted(turns)] for c, turns in said.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % shared
        base = c - (c % group if c >= 0 else -(-c % group))
        turns = said.get(base, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        found = [below(child) for child in children[node]]
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        return sum(f[0] for f in found) or 1, own + sum(f[1] for f in found)

    out = []
    for node, who in members.items():
        leaves, saved = below(node)
        sha = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), len(children[node]), leaves, saved, sha))
    return sorted(out, key=repr)


def result(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS node", "1 AS pos", "2 AS depth", "true AS last")


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(queries.op12_prefix_trie(spark, sf_dir)) == brute(rows)


@pytest.mark.parametrize("piece", [4096, 3])
def test_copies_ties_and_nulls(spark, piece, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    draw, rows = random.Random(3), []
    for c in [*range(-60, 160), 300, 317, 2**40 + 3]:
        turns = draw.choice([["a", "b"], ["a", "b", "c", "d", "e", "f", "g", "h"], ["a"], [None, "", "é" * 5], ["a", "b"]])
        rows += [(c, k, "user" if k % 2 else None, t) for k, t in enumerate(turns)]
    rows += [(5, None, "system", "first"), (5, 1, "user", "tie"), (5, 1, "user", "tie"), (5, 1, None, "tie")]
    rows += [(None, 0, "user", "no conversation"), (None, None, None, None), (1000, None, None, None)]
    assert result(prefix_trie.prefix_trie(table(spark, rows).repartition(5))) == brute(rows)


def test_extended_by_a_smaller_id(spark):
    """A sequence whose every prefix also begins a conversation with a smaller id."""
    rows = [(400, k, "user", t) for k, t in enumerate("abcdefgh")]
    rows += [(500 + i, k, "user", t) for i in range(40) for k, t in enumerate("abcdefgh"[: i % 9])]
    assert result(prefix_trie.prefix_trie(table(spark, rows))) == brute(rows)


def test_one_large_group_and_a_long_conversation(spark):
    rows = [(c, k, "user", t) for c in range(2000) for k, t in enumerate(("hello", "there"))]
    rows += [(5000, k, "user", f"turn {k % 3}") for k in range(3000)]
    got = result(prefix_trie.prefix_trie(table(spark, rows)))
    assert len(got) == 1 + 2 + 3000
    assert max(r[3] for r in got if r[1] == 2) == 2000


def test_turnless_and_none(spark):
    assert prefix_trie.prefix_trie(fixtures.empty(spark, SCHEMA)).count() == 0
    assert prefix_trie.prefix_trie(table(spark, [(None, 1, "user", "x")])).count() == 0
    for c in range(1, 40):
        rows = [(c, 0, "user", "only")]
        assert result(prefix_trie.prefix_trie(table(spark, rows))) == brute(rows)
        if zlib.crc32(str(c).encode()) % 6:
            break

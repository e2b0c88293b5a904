"""The conversation trie against one built of dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest

from arrears.llm import turn_trie as t

COLUMNS = "conv_id long, turn long, role string, text string, steps int, conv string, id int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], COLUMNS).repartition(3)


def brute(rows):
    """Rebuild and count by the contract; turns of one conversation have different numbers."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(turns, key=lambda x: (x[0], x[1] or 0))] for c, turns in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(convs.get(c - c % 100, [])[:h] + own[h:])
    return trie(built)


def trie(built):
    members = {}
    for c, steps in built.items():
        for d in range(len(steps) + 1):
            members.setdefault(steps[:d], []).append(c)
    out = []
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        parent = {n[:-1] for n in members if n}
        ends = sorted(c for c in inside if built[c] == node)
        out.append((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside),
            sum(len(n) == len(node) + 1 for n in below), sum(n not in parent for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.collect())


def test_whole_table(spark, folder):
    df = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert found(t.prefix_trie(t.rebuilt(t.conversations(df)))) == brute(rows)


@pytest.mark.parametrize("seed, block", [(1, 1), (2, 7), (3, 40), (4, 65_536)])
def test_trees_of_any_size_give_one_trie(spark, seed, block):
    """Small blocks: nearly every node reaches over several of them."""
    draw = random.Random(seed)
    built = {}
    for c in range(150):
        steps = tuple(("u", draw.choice(["a", "bb", "ccc"])) for _ in range(draw.randint(0, 5)))
        built[c] = built[c - 1] + steps[:1] if c and draw.random() < 0.3 else steps
    number = {s: k for k, s in enumerate(sorted({s for steps in built.values() for s in steps}))}
    rows = [(c, [(number[s], len(s[1])) for s in steps]) for c, steps in built.items()]
    convs = spark.createDataFrame(rows, "conv long, steps array<struct<id:long,chars:long>>").repartition(5)
    assert found(t.prefix_trie(convs, block)) == trie(built)


def test_edge_cases(spark):
    """Null turns, roles, texts and conversations; no turn left; repeated rows; a very long conversation and text."""
    rows = [(0, None, None, None), (0, 1, "user", "é" * 300_000), (0, 2, "user", "end"), (None, 1, "user", "lost")]
    rows += [(7, k, "user", f"turn {k}") for k in range(90)]
    rows += [(100 + k, 5, "user", "same") for k in range(40)]  # nothing of conversation 100 but one turn
    assert found(t.prefix_trie(t.rebuilt(t.conversations(table(spark, rows))))) == brute(rows)
    deep = t.prefix_trie(t.conversations(table(spark, [(1, k, "u", "x") for k in range(20_000)])))
    assert deep.agg({"depth": "max", "n_leaves": "sum", "n_children": "sum"}).first()[:] == (20_000, 20_001, 20_000)
    same = [(1, 1, "user", "hello")] * 3
    steps = t.conversations(table(spark, same)).collect()
    assert [len(r.steps) for r in steps] == [3]
    assert t.prefix_trie(t.rebuilt(t.conversations(table(spark, rows).limit(0)))).collect() == []


def test_search_tree_is_balanced():
    tree, n = t.Tree(), 1000
    for k in t.median_first(n):
        tree.insert([k], [1], (1, k, b""))
    assert sorted(t.median_first(n)) == list(range(n))

    def deep(node):
        return 0 if node < 0 else 1 + max(deep(tree.low[node]), deep(tree.high[node]))

    assert deep(tree.down[0]) == 10

from __future__ import annotations

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from arrears.llm import simhash_bktree as s


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """doc_id -> (fingerprint, component) for distinct ids that are not null."""
    fp = {i: fingerprint(t) for i, t in rows}
    part = {i: i for i in fp}

    def top(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in fp:
        for j in fp:
            if bin(fp[i] ^ fp[j]).count("1") <= 3:
                a, b = top(i), top(j)
                part[max(a, b)] = min(a, b)
    return {i: (f"{fp[i]:016x}", top(i)) for i in fp}


def test_whole_table_against_brute_force(small):
    want = brute([(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()])
    got = s.near_duplicates(small, ["doc_id"]).collect()
    assert len(got) == len(want)
    assert {r.row.doc_id: (r.fingerprint, r.component_id) for r in got} == want


def test_edge_cases(make):
    long = "word " * 30_000 + "end"
    docs = make(
        (5, None, "a"), (3, "", None), (9, "One two", "a"), (4, "one TWO", "a"), (7, long, "a"), (None, long, "b"),
        (6, "é É", "a"), (8, "\x1f", "a"), repeat=[(9, "One two", "a")],
    )
    got = s.near_duplicates(docs, docs.columns).collect()
    assert len(got) == 9
    by = {}
    for r in got:
        by.setdefault(r.row.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by[5] == by[3] == {("0" * 16, 3)}  # no words: zero, linked like any other
    assert by[9] == by[4] and {c for _, c in by[9]} == {4}
    assert by[None] == by[7] and {c for _, c in by[7]} == {7}
    kept = s.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6, 7, 8]


def test_only_null_keys(make):
    docs = make((None, "a b c", "x"), (None, "a b c", "x"))
    assert {r.component_id for r in s.near_duplicates(docs, ["doc_id"]).collect()} == {None}
    assert s.deduplicate(docs).count() == 1


def test_empty(make):
    assert s.near_duplicates(make().limit(0), ["doc_id"]).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40, unique=True), st.data())
def test_forest_finds_all_within_radius(values, data):
    near = [v ^ (1 << data.draw(st.integers(0, 63))) for v in values[:10]]
    fp = np.array(sorted({*values, *near}), np.uint64)
    group = np.arange(len(fp)) % 3
    forest = s.Forest(group, fp)
    found = {(int(q), int(n)) for qs, ns in forest.search(group, fp, 3) for q, n in zip(qs, ns)}
    want = {
        (i, j)
        for i in range(len(fp))
        for j in range(len(fp))
        if group[i] == group[j] and bin(int(fp[i]) ^ int(fp[j])).count("1") <= 3
    }
    assert found == want


def test_hot_shards_lose_no_link(spark):
    """Shards far above their bound: divided again, then dealt into trees."""
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2**62))
    values = {base}
    while len(values) < 300:  # a cluster around one fingerprint
        x = base
        for b in rng.choice(64, rng.integers(1, 6), replace=False):
            x ^= 1 << int(b)
        values.add(x)
    values |= {int(v) for v in rng.integers(0, 2**63, 300)}
    signed = [(v - (1 << 64) if v >= 1 << 63 else v,) for v in values]
    table = spark.createDataFrame(signed, "fp long")
    parts = {r.node: r.part for r in s.components(s.links(table, 3, most=8)).collect()}
    ids = [v for (v,) in signed]
    want = {v: v for v in ids}

    def top(x):
        while want[x] != x:
            x = want[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and bin((i ^ j) & (2**64 - 1)).count("1") <= 3:
                a, b = top(i), top(j)
                want[max(a, b)] = min(a, b)
    assert {v: parts.get(v, v) for v in ids} == {v: top(v) for v in ids}


def test_long_chain(spark):
    pairs = spark.createDataFrame([(k + 1, k) for k in range(60)], "a long, b long")
    assert {r.part for r in s.components(pairs).collect()} == {0}


def test_small_tables_are_few_files(spark, small, monkeypatch):
    """However many partitions make them: a file is written by processes and requests of its own."""
    written, plain = {}, s.staged

    def staged(df, name, *more):
        out = plain(df, name, *more)
        written[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(s, "staged", staged)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "41")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = s.near_duplicates(small, ["doc_id"]).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.row.doc_id: (r.fingerprint, r.component_id) for r in got} == brute(
        [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    )
    few = ("distinct-fingerprints", "components-labels", "components-hooked")
    assert all(written[name] <= spark.sparkContext.defaultParallelism for name in few), written

"""Substring dedup and benchmark decontamination."""

from __future__ import annotations

import hashlib
import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from arrears.llm import aho_benchmark as a
from arrears.llm import relative_lz as z

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    holder = {}
    words = {}
    for i, t in rows:
        if i is None:
            continue
        w = WORD.findall(t or "")
        words[i, t] = w
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            holder[key] = min(i, holder.get(key, i))
    out = {}
    for (i, t), w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if holder[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i, t] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def shared_passages(seed, n, vocabulary=400):
    rng = random.Random(seed)
    word = lambda: f"t{rng.randrange(vocabulary)}"
    pool = [[word() for _ in range(rng.randint(20, 140))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(1, 4)):
            w += [word() for _ in range(rng.randint(0, 40))]
            p = list(rng.choice(pool))
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = word()
            lo = rng.randint(0, len(p) // 3)
            w += p[lo:]
        rows.append((i, " ".join(w)))
    return rows


def test_random_passages_against_brute_force(make):
    rows = shared_passages(1, 60)
    rows += [(100 + k, rows[k][1]) for k in range(5)]  # copies
    rows += [(200, "x " * 300), (201, "x " * 90), (202, "x " * 49)]
    docs = make(*[(i, t, "s") for i, t in rows])
    want = brute(rows, 50)
    got = z.remove_duplicates(docs, docs.columns, texts=True).collect()
    assert {(r.row.doc_id, r.row.text): (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want
    assert sum(r.n_removed > 0 for r in got) > 30
    for r in got:  # the text that stays holds just the words that stay
        assert hashlib.sha256(" ".join(WORD.findall(r.kept)).encode()).hexdigest() == r.kept_sha256


def test_edge_cases(make):
    p = " ".join(f"p{k}" for k in range(60))
    docs = make(
        (1, None, "a"), (2, "", "a"), (4, p, "a"), (None, p, "a"), (3, p + " x", None), (9, "y " + p, "a"),
        (9, p, "b"), repeat=[(4, p, "a")],
    )
    got = {}
    for r in z.remove_duplicates(docs, docs.columns).collect():
        got.setdefault((r.row.doc_id, r.row.text), []).append(r.n_removed)
    assert got == {(1, None): [0], (2, ""): [0], (4, p): [60, 60], (None, p): [0], (3, p + " x"): [0],
                   (9, "y " + p): [60], (9, p): [60]}
    left = z.dedup_substrings(docs)
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == [
        ("1", None), ("2", ""), ("3", p + " x"), ("9", "y"), ("None", p)
    ]
    assert z.remove_duplicates(make().limit(0), ["doc_id"]).collect() == []


def test_cut_keeps_white_space():
    import numpy as np

    assert z.cut(b"  a  b\tc d\n", np.array([False, True, True, False])) == b"  a\nd\n"
    assert z.cut(b"a b", np.array([True, False])) == b"b"
    assert z.cut(b"a b ", np.array([False, True])) == b"a"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=5, max_size=60))
def test_equal_windows_have_equal_anchors(words):
    from arrears.llm.common import WordHashes

    h = WordHashes(1).of(words)
    own = z.anchors_of(h, 5, 2)
    runs = z.Hashed(h)
    seen = {}
    for k in range(len(words) - 4):
        key = tuple(words[k : k + 5])
        assert seen.setdefault(key, own[k] - k) == own[k] - k
    keys = [int(x) for x in runs.group(__import__("numpy").arange(len(words) - 4), 5)]
    for i in range(len(keys)):
        for j in range(i):
            assert (keys[i] == keys[j]) == (words[i : i + 5] == words[j : j + 5])


PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def hits(text, items, width=13):
    w = PLAIN.findall(low(text))
    hit, found = set(), set()
    for item, t in items:
        v = PLAIN.findall(low(t))
        for k in range(max(1, len(v) - width + 1)) if v else ():
            win = v[k : k + width]
            for p in range(len(w) - len(win) + 1):
                if w[p : p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.add(str(item or ""))
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest()


def test_items_against_brute_force(spark, make):
    item = [f"Q{k}" for k in range(20)]
    items = [(1, " ".join(item)), (10, "what is Été"), (2, " ".join(item[3:18])), (3, None), (4, "--"), (None, "lone")]
    texts = [
        " ".join(item), "x, " + "-".join(item[2:16]).lower() + " y", " ".join(item[:12]), "What IS Été? what is Été",
        None, "", "lone " * 50_000, "what is été", "a " * 500 + " ".join(item[:13]),
    ]
    docs = make(*[(k, t, "s") for k, t in enumerate(texts)], repeat=[(0, texts[0], "s")])
    table = spark.createDataFrame(items, "item_id long, text string")
    want = {k: hits(t, items) for k, t in enumerate(texts)}
    for bound in (1 << 20, 60):  # one block of items, or several
        got = a.find_items(docs, table, docs.columns, most_bytes=bound).collect()
        assert len(got) == 10
        assert {r.row.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got} == want
        spans = {r.row.doc_id: [tuple(x) for x in r.spans] for r in got}
        assert texts[1][slice(*spans[1][0])] == "-".join(item[2:16]).lower()
        assert [texts[3][b:e] for b, e in spans[3]] == ["What IS Été? what is Été"]
    left = a.decontaminate(docs, table)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == [2, 4, 5, 7, 8]


def test_long_items(spark, make, monkeypatch):
    """Parts of long items have every window once, whatever the length of the item."""
    monkeypatch.setattr(a, "RUN_WORDS", 7)
    for n in (1, 2, 3, 7, 8, 9, 12, 13, 14, 40):
        own = [f"W{k}" for k in range(n)]
        picked = spark.createDataFrame([("i", "; ".join(own))], "k string, t string")
        parts = [[w.decode() for w in a.plain_words(r.t.encode())] for r in a.item_parts(picked, 3).collect()]
        windows = [tuple(p[k : k + 3]) for p in parts for k in range(max(1, len(p) - 2))]
        want = [w.lower() for w in own]
        assert sorted(windows) == sorted(tuple(want[k : k + 3]) for k in range(max(1, n - 2)))


def test_item_of_many_words(spark, make):
    many = " ".join(f"v{k:x}" for k in range(500_000))  # 3 MB, all distinct
    items = spark.createDataFrame([(1, many), (2, "plain words")], "item_id long, text string")
    texts = [" ".join(f"v{k:x}" for k in range(b, b + 20)) for b in (0, 4090, 300_000, 499_980)] + ["plain words", "v1 v3"]
    docs = make(*[(k, t, "s") for k, t in enumerate(texts)])
    start = time.monotonic()
    got = {r.row.doc_id: (r.n_hit, r.item_ids) for r in a.find_items(docs, items, ["doc_id"]).collect()}
    assert got == {0: (20, ["1"]), 1: (20, ["1"]), 2: (20, ["1"]), 3: (20, ["1"]), 4: (2, ["2"]), 5: (0, [])}
    assert time.monotonic() - start < 120


def test_no_items(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in a.find_items(make((1, "a b", "s")), none, ["doc_id"]).collect()] == [0]
    assert a.find_items(make().limit(0), none, ["doc_id"]).collect() == []

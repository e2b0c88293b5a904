"""Spelling variants against a comparison of all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from arrears.llm import letter_gram as g


def near(a, b):
    """Exactly one code point inserted, deleted or replaced, by trying all of them."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(counts, ratio=10):
    close = {w: [v for v in counts if v != w and near(v, w)] for w in counts}
    best = {w: min(c, key=lambda v: (-counts[v], v)) for w, c in close.items() if c}
    form = {w: v for w, v in best.items() if counts[v] >= ratio * counts[w]}
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, counts[w], len(close[w]), counts[form[w]] if w in form else None)
    return out


def rows_of(df):
    rows = [(r.word, (r.form, r.root, r.n, r.n_near, r.form_n)) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def words_of(rows):
    """Words and counts of (doc_id, text), by the contract."""
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


@pytest.mark.parametrize("tile", [4096, 20])
def test_all_pairs(spark, tile):
    """Few letters, so that blocks are large; with small tiles most blocks are divided."""
    draw = random.Random(tile)
    counts = {}
    for _ in range(500):
        counts["".join(draw.choice("abcéñ") for _ in range(draw.randint(3, 6)))] = draw.choice([1, 2, 30, 400, 5000])
    counts |= {"a" * 60: 3, "a" * 61: 40, "a" * 59 + "b": 700, "a" * 600: 5, "b" + "a" * 600: 50}  # wide and long words
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert rows_of(g.variants(words, tile=tile)) == brute(counts)


def test_whole_table(spark, small):
    counts = words_of([(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()])
    assert {r.word: r.n for r in g.count_words(small).collect()} == counts


def test_edge_cases(make, spark):
    """Null and empty texts, null keys, repeated rows, a very long word and a very long text, clashing columns."""
    long = "Abcdefg " * 200_000 + "z" * 1_000_000
    rows = [(1, None, "a"), (2, "", "a"), (None, "Straße ÜBERALL überall", None), (4, long, "b"), (5, "z" * 1_000_000, "b")]
    docs = make(*rows, repeat=[rows[2]])
    want = words_of([(i, t) for i, t, _ in [*rows, rows[2]]])
    got = g.count_words(docs)
    assert {r.word: r.n for r in got.collect()} == want
    assert rows_of(g.variants(got)) == brute(want)
    empty = make().limit(0)
    assert g.variants(g.count_words(empty)).collect() == []
    with pytest.raises(Exception, match="lower-case letters"):
        g.variants(spark.createDataFrame([("ab1", 2)], "word string, n long")).collect()


def test_gram_finds_every_edit():
    draw = np.random.default_rng(5)
    base = ["".join(draw.choice(list("abcdefgh"), 9)) for _ in range(40)]
    edits = [w[:k] + x + w[k + d :] for w in base for k, x, d in ((3, "z", 1), (0, "", 1), (9, "q", 0))]
    a, b = (g.Words([w.encode() for w in ws], np.ones(len(ws))) for ws in (base, edits))
    i, j = g.close_counts(a.counts, b.counts)
    assert {(x, 3 * x + e) for x in range(40) for e in range(3)} <= set(zip(i.tolist(), j.tolist()))
    assert g.edited(a, i, b, j).tolist() == [near(base[x], edits[y]) for x, y in zip(i, j)]


@pytest.mark.parametrize("tile", [4096, 1])
def test_halves_with_the_same_key(spark, tile):
    """Blocks of different halves stay apart: each pair shows in its own half only."""
    groups = np.zeros(g.N_LETTERS, np.int64)
    for group, letters in enumerate(["eo", "rn", "lt", "iy"]):
        groups[g.letters(letters.encode())] = group
    rows = [(7, 3, "erererer"), (7, 3, "ererorer"), (7, 2, "nririin"), (7, 2, "nritiin")]
    keyed = spark.createDataFrame([(k, h, len(w), w, 2) for k, h, w in rows], "key long, half byte, size int, word string, n long")
    found = {(r.word, r.n_near, r.best) for r in g.compare(g.dealt(keyed, tile), groups).collect()}
    assert found == {(a, 1, b) for x, y in ((0, 1), (2, 3)) for a, b in ((rows[x][2], rows[y][2]), (rows[y][2], rows[x][2]))}

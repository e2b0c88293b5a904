"""Shards along the Hilbert curve."""

from __future__ import annotations

import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from arrears.llm import hilbert_shards as h


def dealt(df):
    return sorted((r.shard, r.slot, r.row.doc_id) for r in df.collect())


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(spark, axes, bits):
    """Each step of the curve goes to a cell beside the last one, and it visits all of them."""
    names = [f"x{i}" for i in range(axes)]
    cells = list(product(range(1 << bits), repeat=axes))
    rows = spark.createDataFrame([(*c, *c) for c in cells], ", ".join(f"{n} int" for n in [*names, *(f"y{i}" for i in range(axes))]))
    got = h.curve_index(rows, names, bits, "place").orderBy("place").collect()
    assert [r.place for r in got] == list(range(len(cells)))
    path = [tuple(r[f"y{i}"] for i in range(axes)) for r in got]
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def test_counts_and_figures(spark, small):
    n = small.count()
    got = h.hilbert_shards(small, ["doc_id", "text"]).collect()
    assert len(got) == len({r.row.doc_id for r in got}) == n
    for r in got:
        text = (r.row.text or "").encode()
        assert (r["size"], r.text_crc32) == (len(text) + 8, zlib.crc32(text))
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} <= {n // 24, n // 24 + 1}


def test_hot_rows_nulls_and_small_tables(make, spark):
    """A third of all rows are one row; null keys, texts and dimensions; fewer rows than shards; none."""
    hot = [(1, "same text", "hot")] * 40
    rows = [(k, f"text {k}" * k, None if k % 3 else f"s{k % 5}") for k in range(60)] + [(None, None, None)] * 20
    docs = make(*rows, repeat=hot)
    got = h.hilbert_shards(docs, docs.columns).collect()
    sizes = {k: sum(r.shard == k for r in got) for k in range(24)}
    assert len(got) == 120 and set(sizes.values()) == {5}
    assert sum(r.row.doc_id == 1 and r.row.text == "same text" for r in got) == 40
    few = h.hilbert_shards(make(*rows[:5]), ["doc_id"])
    assert [(s, k) for s, k, _ in dealt(few)] == [(s, 0) for s in range(5)]
    assert h.hilbert_shards(make().limit(0), ["doc_id"]).collect() == []
    assert dealt(few) == dealt(h.hilbert_shards(make(*rows[:5]).repartition(5), ["doc_id"]))  # whatever the partitions
    long = h.hilbert_shards(make((1, "é" * 3_000_000, "s")), ["doc_id"]).first()
    assert long["size"] == 6_000_008


def test_files_are_pruned(spark, tmp_path):
    """What is read for a range of two dimensions, against shards dealt by a hash."""
    rows = [(i, "x" * (i * 37 % 500), "en" if i % 3 else "de", f"s{i * 7919 % 50:02}", i * 37 % 500, 3) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard int")
    manifest = h.write_shards(docs, f"{tmp_path}/a")
    assert manifest.agg(F.sum("rows"), F.count("*")).first()[:] == (6000, 24)
    ranges = {"source": ("s10", "s19"), "n_chars": (100, 199)}
    want = {r[0] for r in rows if "s10" <= r[3] <= "s19" and 100 <= r[4] <= 199}
    found = h.read_shards(spark, f"{tmp_path}/a", ranges)
    assert found.columns == docs.columns  # a column named shard stays the documents' own
    assert {r.doc_id for r in found.collect()} == want
    may = sum(
        r.d0.least <= "s19" and r.d0.most >= "s10" and r.d2.least <= 199 and r.d2.most >= 100 for r in manifest.collect()
    )
    assert may <= 12
    assert h.read_shards(spark, f"{tmp_path}/a", {"n_chars": (900, 999)}).collect() == []

"""Large members: cut behind records by one task, parsed in many."""

from __future__ import annotations

import csv
import io
import random
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from arrears.sources import archives


def blocks_of(data: bytes, size: int, monkeypatch) -> list[bytes]:
    monkeypatch.setattr(archives, "WINDOW", max(1, size // 3))
    return list(archives.record_blocks(io.BytesIO(data), size, ";"))


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_blocks_end_behind_records(size, monkeypatch):
    """Random fields with quotes, separators and line breaks inside, against the standard library's reader."""
    draw = random.Random(size)
    parts = ["a", "é", ";", '""', "\n", "\r\n", "b c", ""]
    for end in ("\n", "\r\n"):
        rows = []
        for _ in range(200):
            inside = "".join(draw.choices(parts, k=draw.randint(0, 6)))
            rows.append(f'"{inside}";{draw.choice(["x", "in" + chr(34) + "ch", "", "y y"])};"{draw.choice(["", "z"])}"')
        text = "\n\r\n" + end.join(["h1;h2;h3", *rows]) + draw.choice(["", end])
        blocks = blocks_of(text.encode(), size, monkeypatch)
        assert b"".join(blocks) == text.encode().lstrip(b"\r\n")
        assert blocks[0] == f"h1;h2;h3{end}".encode()
        apart = [r for b in blocks[1:] for r in csv.reader(io.StringIO(b.decode(), newline=""), delimiter=";")]
        whole = list(csv.reader(io.StringIO(text.lstrip("\r\n"), newline=""), delimiter=";"))[1:]
        assert apart == whole and len(whole) == 200
        assert size > 5_000 or len(blocks) > 20


def test_odd_texts(monkeypatch):
    assert blocks_of(b"", 8, monkeypatch) == [b""]
    assert blocks_of(b"a;b", 8, monkeypatch) == [b"a;b"]
    assert blocks_of(b"a\rb\rc\r", 2, monkeypatch)[0] == b"a\r"  # carriage returns alone
    assert blocks_of(b'a\n"never closed\n1\n2\n', 4, monkeypatch) == [b"a\n", b'"never closed\n1\n2\n']
    assert blocks_of(b'a\n"x"""\n"y"\n', 3, monkeypatch)[0] == b"a\n"
    assert b"".join(blocks_of(b'a;b\nx"y;1\nz;2\n', 4, monkeypatch)[1:]) == b'x"y;1\nz;2\n'
    assert len(blocks_of(b'a;b\nx"y;1\nz;2\n', 4, monkeypatch)) > 2  # a quote inside a field opens nothing


def test_long_record_takes_linear_time(monkeypatch):
    text = b'h\n"' + b"x\n" * 3_000_000 + b'"\nlast\n'
    assert list(archives.record_blocks(io.BytesIO(text), 4096, ";"))[0] == b"h\n"


@pytest.fixture()
def landing(tmp_path):
    place = tmp_path / "in"
    place.mkdir()
    head = 'CPF_CNPJ;TIPO_PESSOA;"NOME_DEVEDOR";EXTRA'
    rows = [f'{i};Pessoa jurídica;"Nome; ""{i}""\nLtda";x' if i % 3 else f"{i};J;NA;" for i in range(3000)]
    with zipfile.ZipFile(place / "2023T1_a_FGTS.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("utf8.csv", "\r\n".join([head, *rows]).encode())
        z.writestr("latin.csv", "\n".join([head, *rows, "9;J;João;x"]).encode("latin1"))
        z.writestr("short.csv", b"TIPO_PESSOA\nJ\n\nF\n")
        z.writestr("empty.csv", b"")
        z.writestr("headonly.csv", b"CPF_CNPJ;TIPO_PESSOA\n")
        z.writestr("open.csv", "\n".join([head, *rows[:400], '7;J;"open\n8;J;n']).encode())
        z.writestr("wide.csv", "\n".join([head, *rows[:400], "1;J;n;x;more", *rows[400:]]).encode())
    path = place / "2023T2_b_FGTS.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("rotten.csv", "\n".join([head, *rows]).encode())
    data = bytearray(path.read_bytes())
    data[5000] ^= 1  # the checksum no longer fits
    path.write_bytes(data)
    return str(place)


def test_same_as_the_reader_of_small_members(spark, landing, monkeypatch):
    members = archives.list_members(spark, landing)
    want, want_bad = archives.load_members(members, chunk_rows=500)
    got, bad = archives.load_large_members(members, block_bytes=4096)
    assert got.columns == want.columns
    assert Counter(got.collect()) == Counter(want.collect())
    assert {r["member"]: r["n"] for r in got.groupBy("member").agg(F.count("*").alias("n")).collect()} == {
        "utf8.csv": 3000, "latin.csv": 3001, "short.csv": 2, "wide.csv": 3001
    }
    plain = lambda rows: {(r["member"], r["problem"]) for r in rows.collect()}
    assert plain(bad) == plain(want_bad) == {("empty.csv", "empty"), ("open.csv", "parse"), ("rotten.csv", "archive")}


def test_ingest_deals_members_by_size(spark, landing, tmp_path):
    one, one_bad = archives.ingest(spark, landing, str(tmp_path / "one"))
    two, two_bad = archives.ingest(spark, landing, str(tmp_path / "two"), large=1000)
    assert Counter(one.collect()) == Counter(two.collect()) and one.count() > 5000
    assert {r["member"] for r in one_bad.collect()} == {r["member"] for r in two_bad.collect()}

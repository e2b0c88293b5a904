from __future__ import annotations

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from arrears.functions import hashing, labels, text


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "word, plain, zero, exact",
    [
        ("SIM", 1.0, 1.0, 1.0),
        ("sim", 1.0, 1.0, -1.0),
        ("NAO", 0.0, 0.0, -1.0),
        ("não", 0.0, 0.0, -1.0),
        ("NÃO", 0.0, 0.0, 0.0),
        ("talvez", None, 0.0, -1.0),
        (None, None, 0.0, -1.0),
    ],
)
def test_labels(spark, word, plain, zero, exact):
    assert one(spark, word, "string", labels.encode_label) == plain
    assert one(spark, word, "string", lambda c: labels.encode_label(c, "zero")) == zero
    assert one(spark, word, "string", lambda c: labels.encode_label(c, "minus_one", exact=True)) == exact


def test_unknown_label_can_fail(spark):
    assert one(spark, "sim", "string", lambda c: labels.encode_label(c, "error")) == 1.0
    with pytest.raises(Exception, match="unknown label: talvez"):
        one(spark, "talvez", "string", lambda c: labels.encode_label(c, "error"))
    with pytest.raises(ValueError):
        labels.encode_label("v", "other")


@pytest.mark.parametrize(
    "raw, person, expected",
    [
        ("12.345/0001-07", "PJ", "00012345000107"),
        ("12345678901234", "jurídica", "12345678901234"),
        ("1234567890123456", "J", "1234567890123456"),
        ("123", "F", None),
        ("123", None, None),
        (None, "J", None),
        ("", "J", "0" * 14),
    ],
)
def test_company_id(spark, raw, person, expected):
    df = spark.createDataFrame([(raw, person)], "a string, b string")
    assert df.select(text.company_id(F.col("a"), F.col("b")).alias("r")).first()["r"] == expected


@pytest.mark.parametrize(
    "name, year, quarter, origin",
    [
        ("2023T1_lote_FGTS.zip", "2023", "1", "FGTS"),
        ("2024T4_Nao_Previdenciario.zip", "2024", "4", "SIDA"),
        ("2024T2_Previdenciario.zip", "2024", "2", "PREV"),
        ("2024T5_outros.zip", None, None, "DESCONHECIDO"),
    ],
)
def test_file_names(spark, name, year, quarter, origin):
    assert one(spark, name, "string", text.snapshot_year) == year
    assert one(spark, name, "string", text.snapshot_quarter) == quarter
    assert one(spark, name, "string", text.origin_of) == origin


BASES = [
    "http://site.example.com/a/b/page.html?x=1#top",
    "https://site.example.org",
    "https://site.example.org/dir/",
]
LINKS = [
    "file.zip", "/root.zip", "../up.zip", "./here.zip", "../../../far.zip", "//other.example.net/x.zip",
    "http://abs.example.net/x.zip", "?page=2", "#part", "", "sub/dir/../x.csv", "x.zip?v=1#f", "/a/./b/../c.zip", "..", ".",
]


@pytest.mark.parametrize("base", BASES)
def test_urls_resolve_like_the_standard_library(spark, base):
    rows = (
        spark.createDataFrame([(base, link) for link in LINKS], "base string, link string")
        .select("link", text.resolve_url(F.col("base"), F.col("link")).alias("r"))
        .collect()
    )
    assert {r["link"]: r["r"] for r in rows} == {link: urljoin(base, link) for link in LINKS}


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://h.example.com/d/2023_trimestre_01/Dados.zip", "2023T1"),
        ("https://h.example.com/d/2023_trimestre_01/deeper/Dados.zip", None),
        ("https://h.example.com/Dados.zip", None),
    ],
)
def test_folder_snapshot(spark, url, expected):
    assert one(spark, url, "string", text.folder_snapshot) == expected


def test_header_fields(spark):
    assert one(spark, ' A; "B" ;"C"', "string", text.header_fields) == ["A", "B", "C"]


@pytest.mark.parametrize("word", ["plain", "ação", "ÿ"])
@pytest.mark.parametrize("encoding", ["utf-8", "latin1"])
def test_decode(spark, word, encoding):
    assert one(spark, bytearray(word.encode(encoding)), "binary", text.decode_with_fallback) == word


def test_share_limit_bounds():
    assert hashing.share_limit(0.0) == "0" * 13
    assert hashing.share_limit(1.0) > "f" * 32
    with pytest.raises(ValueError):
        hashing.share_limit(1.5)

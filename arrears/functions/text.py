"""Identifiers, file names, URLs and raw bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: year and quarter in a file name.
FILE_SNAPSHOT = r"(\d{4})T([1-4])"

# Archive endings and the origin each stands for, tested in this order.
ORIGIN_BY_ENDING = (
    ("FGTS.zip", "FGTS"),
    ("Nao_Previdenciario.zip", "SIDA"),
    ("Previdenciario.zip", "PREV"),
)
ORIGIN_UNKNOWN = "DESCONHECIDO"
ID_WIDTH = 14


def strip_id_marks(c: Column) -> Column:
    """Remove ``-``, ``.`` and ``/``."""
    return F.translate(c, "-./", "")


def pad_id(c: Column, width: int = ID_WIDTH) -> Column:
    """Left-pad with zeros; a longer text stays whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def company_id(raw_id: Column, person_type: Column) -> Column:
    """Normalised id of legal persons; null for everybody else."""
    legal = F.coalesce(F.upper(person_type).contains("J"), F.lit(False))
    return F.when(legal, pad_id(strip_id_marks(raw_id)))


def snapshot_year(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, FILE_SNAPSHOT, 1), F.lit(""))


def snapshot_quarter(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, FILE_SNAPSHOT, 2), F.lit(""))


def origin_of(name: Column) -> Column:
    chain = None
    for ending, origin in ORIGIN_BY_ENDING:
        hit = name.contains(ending)
        chain = F.when(hit, origin) if chain is None else chain.when(hit, origin)
    return chain.otherwise(ORIGIN_UNKNOWN)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def ends_with_any(c: Column, suffixes: Sequence[str]) -> Column:
    lowered = F.lower(c)
    test = F.lit(False)
    for suffix in suffixes:
        test = test | lowered.endswith(suffix.lower())
    return test


def header_fields(line: Column, sep: str = ";") -> Column:
    """Split a header line; drop outer blanks, then outer quotes, of every field."""
    return F.transform(F.split(line, sep), lambda f: F.btrim(F.btrim(f, F.lit(" \t\r\n")), F.lit('"')))


def decode_with_fallback(raw: Column) -> Column:
    """UTF-8 text where the bytes are valid UTF-8, else latin1."""
    return F.when(F.is_valid_utf8(raw.cast("string")), F.decode(raw, "UTF-8")).otherwise(
        F.decode(raw, "ISO-8859-1")
    )


def _normal_path(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1))))
        .when(seg == ".", acc)
        .otherwise(F.concat(acc, F.array(seg))),
    )
    tail = F.when(last.isin(".", ".."), "/").otherwise("")
    return F.concat(F.array_join(kept, "/"), tail)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` found on the page at ``base``."""
    bare = F.regexp_extract(base, r"^([^?#]*)", 1)
    no_fragment = F.regexp_extract(base, r"^([^#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(.*)$", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(base_path, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(bare, href))
        .when(href.startswith("/"), F.concat(site, _normal_path(path), rest))
        .otherwise(F.concat(site, _normal_path(F.concat(folder, path)), rest))
    )


def url_path(url: Column) -> Column:
    """Path part, read by pattern so that odd characters never fail."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def folder_snapshot(url: Column) -> Column:
    """``2023T1`` from a parent folder such as ``2023_trimestre_01``; else null."""
    parts = F.split(F.btrim(url_path(url), F.lit("/")), "/")
    parent = F.when(F.size(parts) >= 2, F.element_at(parts, -2))
    year = F.nullif(F.regexp_extract(parent, r"(\d{4})_trimestre_(\d{2})", 1), F.lit(""))
    quarter = F.regexp_extract(parent, r"(\d{4})_trimestre_(\d{2})", 2)
    return F.when(year.isNotNull(), F.concat(year, F.lit("T"), quarter.cast("int").cast("string")))

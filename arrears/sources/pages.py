"""Links of web pages and the manifest of files still to be fetched."""

from __future__ import annotations

import html
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.functions import text

# One attribute: name, and a value in double, single or no quotes. All loops are possessive: linear, no deep stack.
ATTRIBUTE = r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|((?!["'])[^\s>]++)|(?=>)))?+"""
_INSIDE = r"(?:[\s/]++|" + re.sub(r"\((?=[^?])", "(?:", ATTRIBUTE) + ")*+"
# Tokens of a page: comments, elements whose content is text, anchors (their attributes are group 2), other tags.
TOKEN = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))"
    rf"|<(script|style|textarea|title|xmp|iframe|noembed|noframes)(?=[\s/>]){_INSIDE}>.*?(?:</\1(?=[\s/>])|\z)"
    rf"|<a(?=[\s/>])({_INSIDE})>"
    rf"|<[a-z][^\s/>]*+{_INSIDE}>"
)
REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);")


@F.pandas_udf(T.StringType())
def unescaped(values: pd.Series) -> pd.Series:
    """Character references that end with a semicolon are resolved; others may be parameters of a query."""
    return values.map(lambda x: x if x is None or "&" not in x else REFERENCE.sub(lambda m: html.unescape(m[0]), x))


def hrefs(page: Column) -> Column:
    """The raw first ``href`` of every anchor of a page, not of comments, scripts or attribute values."""
    anchors = F.filter(F.regexp_extract_all(page, F.lit(TOKEN), F.lit(2)), lambda x: x != "")

    def first(inside: Column) -> Column:
        parts = [F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(k)) for k in (1, 2, 3, 4)]
        named = F.filter(F.arrays_zip(*[p.alias(n) for p, n in zip(parts, ("name", "double", "single", "bare"))]), lambda x: F.lower(x["name"]) == "href")
        found = F.get(named, F.lit(0))
        return F.concat(found["double"], found["single"], found["bare"])

    return F.filter(F.transform(anchors, first), lambda x: x.isNotNull())


def page_links(pages: DataFrame, suffixes: Sequence[str], page: str = "page_id") -> DataFrame:
    """(page, href, file_url, file_name) for every anchor whose target ends in a suffix.

    The file name carries the snapshot of a parent folder such as
    ``2023_trimestre_01`` as a prefix.
    """
    links = pages.select(page, "url", F.explode(hrefs(F.col("html"))).alias("href"))
    url = F.col("file_url")
    snapshot = text.folder_snapshot(url)
    name = text.base_name(url)
    return (
        links.withColumn("href", F.btrim(unescaped("href"), F.lit(" \t\r\n\f")))
        .filter(text.ends_with_any(F.col("href"), suffixes))
        .withColumn("file_url", text.resolve_url(F.col("url"), F.col("href")))
        .select(
            page,
            "href",
            "file_url",
            F.when(snapshot.isNotNull(), F.concat(snapshot, F.lit("_"), name)).otherwise(name).alias("file_name"),
        )
    )


def pending(manifest: DataFrame, done: DataFrame, key: str = "file_name") -> DataFrame:
    """Manifest entries that were not processed yet."""
    return manifest.join(done.select(key), key, "left_anti")

"""Quality rules: lines that many documents of one host share, and what is left of a document without them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import (
    WordHashes,
    blank_words,
    keyed,
    lists,
    map_text,
    mix,
    pack,
    staged,
    sum_tail,
    texts_of,
    with_verdicts,
)
from arrears.llm.registry import query, table

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MOST_DOCUMENTS = 50  # a line of more distinct documents of a host is boilerplate
LEAST_LEFT = 10  # percent of the words that must be left
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent


def line_hash(host: bytes, line: bytes) -> int | None:
    """First 64 bits of the MD5 of a line in lower case with single blanks, within its host; None without words."""
    words = line.lower().split()
    if not words:
        return None
    return int.from_bytes(hashlib.md5(host + b"\n" + b" ".join(words), usedforsecurity=False).digest()[:8], "big")


def repeated_words(hashes: np.ndarray, counts: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of ``width`` words found twice or more in the text.

    hashes: of the words of all texts, one after the other; counts: words of each text.
    """
    total = np.zeros(len(counts), np.int64)
    n = len(hashes)
    if n < width:
        return total
    key = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        key = mix(key ^ hashes[k : n - width + 1 + k])
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = owner[: len(key)] == owner[width - 1 :]
    at = np.flatnonzero(inside)
    order = at[np.lexsort((key[at], owner[at]))]
    same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    found = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + width, -1)
    covered = np.cumsum(edge)[:n] > 0
    np.add.at(total, owner[covered], 1)
    return total


def _unsigned(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def identity(hashes: Iterable[int]) -> int:
    """Of a document: first 64 bits of the MD5 of its sorted line hashes; 0 without lines."""
    own = np.sort(np.fromiter(hashes, np.uint64)).astype(">u8").tobytes()
    return int.from_bytes(hashlib.md5(own, usedforsecurity=False).digest()[:8], "big") if own else 0


def measure(docs: DataFrame, keep: list[str], text: str, host: str) -> DataFrame:
    """Figures of each text, and its lines as hashes.

    ``row`` (struct of ``keep``), the base figures, ``lines`` (distinct line hashes), ``line_words`` (words of all
    lines with that hash), ``body`` (identity of the document: of all its lines).
    """
    rows = docs.select(
        pack(keep), F.col(text).cast("string").alias("text"), F.col(host).cast("string").alias("host")
    )

    def work(batches):
        known = WordHashes()
        for batch in batches:
            texts, hosts = texts_of(batch.column(1)), texts_of(batch.column(2))
            words = [blank_words(t) for t in texts]
            counts = np.array([len(w) for w in words])
            flat = [w for ws in words for w in ws]
            repeats = repeated_words(known.of(flat), counts)
            chars, symbols, dups, hashes, sizes, each, body = [], [], [], [], [], [], []
            for t, h, ws in zip(texts, hosts, words):
                joined = b"".join(ws)
                chars.append(len(joined) - sum_tail(joined))
                symbols.append(len(t) - len(t.translate(None, SYMBOLS)))
                lines = [x for x in t.split(b"\n") if x.strip(b" \t\n\v\f\r")]
                dups.append(len(lines) - len(set(lines)))
                found: dict[int, int] = {}
                for x in lines:
                    k = line_hash(h, x)
                    found[k] = found.get(k, 0) + len(x.split())
                hashes.extend(found)
                sizes.extend(found.values())
                each.append(len(found))
                body.append(identity(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(chars, pa.int64()),
                    pa.array(symbols, pa.int64()),
                    pa.array(dups, pa.int64()),
                    pa.array(repeats, pa.int64()),
                    lists(_unsigned(hashes), each, pa.int64()),
                    lists(np.array(sizes, np.int32), each, pa.int32()),
                    pa.array(_unsigned(body)),
                ],
                names=[
                    "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "line_words",
                    "body",
                ],
            )

    schema = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "lines array<long>, line_words array<int>, body long"
    )
    return map_text(rows, schema, work, "text")


def common_lines(lines: DataFrame, most: int) -> DataFrame:
    """Lines (``line``, ``body``, ``place``) of more than ``most`` distinct documents, with the ``first`` place of each.

    Documents with one body count once. Rows are counted first, which needs no set; only lines with enough rows are
    looked at again, so what a line's set of bodies can grow to is spread by (line, body).
    """
    often = lines.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") > most).select("line")
    bodies = lines.join(often, "line", "left_semi").groupBy("line", "body").agg(F.min("place").alias("first"))
    return (
        bodies.groupBy("line")
        .agg(F.count("*").alias("documents"), F.min("first").alias("first"))
        .where(F.col("documents") > most)
    )


def judge(
    docs: DataFrame,
    keep: list[str],
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    most_documents: int = MOST_DOCUMENTS,
    least_left: int = LEAST_LEFT,
) -> DataFrame:
    """Base figures, words in boilerplate lines, and the verdict, one row for each input row.

    A line (lower case, single blanks) is boilerplate in its host when more than ``most_documents`` distinct documents
    of that host show it; documents with the same set of lines count as one, so copies of a document do not turn its
    lines into boilerplate. The document with the smallest key that shows a line keeps it (``keep`` holds the key; null
    keys come last). A document is rejected when it fails
    the base rule or fewer than ``least_left`` percent of its words are left; ``dropped`` lists its boilerplate lines.

    Null and empty texts have no words and fail. A null host counts as the empty one. Repeated rows are judged each by
    itself. An empty table gives an empty result.
    """
    measured = staged(
        measure(docs, keep, text, host).withColumn("owner", F.monotonically_increasing_id()), "line-figures"
    )
    own = F.col("row")[key]
    place = F.struct(own.isNull().alias("none"), own.alias("id"), "owner").alias("place")
    lines = measured.select("owner", "body", place, F.explode(F.arrays_zip("lines", "line_words")).alias("x")).select(
        "owner", "body", "place", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words")
    )
    found = common_lines(lines, most_documents)
    lost = (
        lines.join(found, "line")
        .where(F.col("owner") != F.col("first.owner"))
        .groupBy("owner")
        .agg(F.sum("words").alias("n_boilerplate"), F.collect_list("line").alias("dropped"))
    )
    lost_words = F.coalesce("n_boilerplate", F.lit(0)).cast("long")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = 100 * (F.col("n_words") - lost_words) < least_left * F.col("n_words")
    return measured.join(lost, "owner", "left").select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~left).alias("kept"),
        lost_words.alias("n_boilerplate"),
        F.coalesce("dropped", F.array().cast("array<long>")).alias("dropped"),
    )


def without_lines(docs: DataFrame, text: str, host: str, dropped: str) -> DataFrame:
    """Take the lines with the given hashes out of each text; other texts stay as they are."""
    position = {c: docs.columns.index(c) for c in (text, host, dropped)}

    def work(batches):
        for batch in batches:
            texts = batch.column(position[text]).to_pylist()
            hosts, gone = texts_of(batch.column(position[host])), batch.column(position[dropped]).to_pylist()
            for k, (t, h, g) in enumerate(zip(texts, hosts, gone)):
                if g:
                    out = {x & 0xFFFFFFFFFFFFFFFF for x in g}
                    texts[k] = "\n".join(x for x in t.split("\n") if line_hash(h, x.encode()) not in out)
            columns = [*batch.columns]
            columns[position[text]] = pa.array(texts, columns[position[text]].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return map_text(docs, docs.schema, work, text)


def clean(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", chars: str = "n_chars", **options
) -> DataFrame:
    """The documents that are kept, without their boilerplate lines; ``chars`` is counted anew.

    Rows with the same key, text and host share the mildest verdict. Null and empty texts have no words and go; a null
    host counts as the empty one; an empty table gives an empty result. Extra columns keep their names and values.
    """
    rows = keyed(docs, key, text, host)
    row = F.col("row")
    plain = rows.select("id", "mark", row[text].alias("text"), row[host].alias("host"))
    judged = judge(plain, ["id", "mark"], "id", "text", "host", **options).where("kept")
    mild = judged.groupBy("row.id", "row.mark").agg(F.min_by("dropped", F.size("dropped")).alias("dropped"))
    rest = [c for c in docs.columns if c not in (text, chars)]  # the text crosses to the tasks' Python once, not in its row too
    held = F.struct(*[row[c].alias(c) for c in rest]).alias("held")
    rows = with_verdicts(rows, mild).select(held, row[text].alias("t"), row[host].alias("h"), "dropped")
    cleaned = without_lines(rows, "t", "h", "dropped")
    new = {text: F.col("t"), chars: F.length("t").cast("long")}
    return cleaned.select(*[new[c].alias(c) if c in new else F.col("held")[c].alias(c) for c in docs.columns])


WORDS = r"[^\x20\x09-\x0D]+"

SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
split AS (
  SELECT doc_id, host, string_split(t, chr(10))[i] AS line FROM d, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS u(i)),
worded AS (
  SELECT doc_id, line, len(regexp_extract_all(line, '{WORDS}')) AS words,
         substr(md5(host || chr(10) || translate(array_to_string(regexp_extract_all(line, '{WORDS}'), ' '),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')), 1, 16) AS hash
  FROM split WHERE len(regexp_extract_all(line, '{WORDS}')) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY doc_id),
lines AS (SELECT doc_id, hash, sum(words) AS words FROM worded GROUP BY doc_id, hash),
body AS (
  SELECT doc_id, substr(md5(unhex(string_agg(hash, '' ORDER BY hash))), 1, 16) AS body FROM lines GROUP BY doc_id),
common AS (
  SELECT hash, min(doc_id) AS first FROM lines JOIN body USING (doc_id)
  GROUP BY hash HAVING count(DISTINCT body) > {MOST_DOCUMENTS}),
lost AS (
  SELECT doc_id, sum(words) AS n FROM lines JOIN common USING (hash) WHERE doc_id <> first GROUP BY doc_id),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
  FROM d, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 0) + 1)) AS u(i)),
again AS (SELECT * FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM again, unnest(range(i, i + {WINDOW})) AS u(p) GROUP BY doc_id),
f AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(lost.n, 0) AS BIGINT) AS n_boilerplate
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN lost USING (doc_id)),
g AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * (n_words - n_boilerplate) >= {LEAST_LEFT} * n_words AS kept, n_boilerplate FROM g
"""


@query("op5_quality_rules", SQL)
def op5_quality_rules(spark, folder):
    judged = judge(table(spark, folder, "documents"), ["doc_id"])
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_boilerplate",
    )

"""Benchmark decontamination with one Aho-Corasick automaton over the test items.

Items and documents are normalised alike to words. Each word of the items gets two letters of its own, every other word
the same foreign ones; so a text becomes one short string whose positions are word numbers, and the automaton finds
every window of every item in one pass over it. Word numbers lead back to offsets in the original. First and second
letters are of different alphabets, so a window is never found between words, and both alphabets are small, since the
automaton seeks among the children of a node one by one.

The items are a test set, small beside the corpus, and go to every task. Their size is checked: beyond ``most_bytes``
they are dealt into blocks of about that size, with one pass over the documents for each block. What is dealt are runs of
words: a long item becomes several that share a window's words less one, so each of its windows is in one of them and
no item makes a block large.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import lists, map_text, pack, plain_words, texts_of
from arrears.llm.registry import query, table

WIDTH = 13
WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOREIGN = "\x01\x01"
FIRST_LETTERS, SECOND_LETTERS, SECONDS = 0x100, 0xE000, 512  # code points without surrogates: 28 million words
#: Bytes of a block on average.
MOST_BYTES = 1 << 20
RUN_WORDS = 4096  # words of a part of an item


class Windows:
    """The automaton over all windows of some items."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.letters: dict[bytes, str] = {}
        self.items: list[str] = []
        found: dict[str, list[int]] = {}
        number: dict[str, int] = {}
        for item, text in items:
            words = plain_words(text.encode())
            if not words:
                continue
            spelled = "".join(map(self._letters, words))
            if item not in number:
                number[item] = len(self.items)
                self.items.append(item)
            for at in range(max(1, len(words) - width + 1)):
                found.setdefault(spelled[2 * at : 2 * (at + width)], []).append(number[item])
        self.automaton = ahocorasick.Automaton()
        for window, owners in found.items():
            self.automaton.add_word(window, (len(window) // 2, tuple(set(owners))))
        if found:
            self.automaton.make_automaton()
        self.any = bool(found)

    def _letters(self, word: bytes) -> str:
        got = self.letters.get(word)
        if got is None:
            first, second = divmod(len(self.letters), SECONDS)
            got = self.letters[word] = chr(FIRST_LETTERS + first) + chr(SECOND_LETTERS + second)
        return got

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words, and the items that have a window there."""
        if not self.any:
            return [], set()
        get = self.letters.get
        spelled = "".join([get(w, FOREIGN) for w in words])
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for last, (length, owners) in self.automaton.iter(spelled):
            items.update(owners)
            end = (last + 1) // 2
            begin = end - length
            while spans and spans[-1][1] >= begin:  # ends never fall, so only the last spans can touch
                begin = min(begin, spans.pop()[0])
            spans.append((begin, end))
        return spans, {self.items[i] for i in items}


def merge(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted([*a, *b]):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def offsets(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as character spans of the original text."""
    at = [m.span() for m in WORD.finditer(text.decode())] if spans else []
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


def _pass(rows: DataFrame, windows: Windows) -> DataFrame:
    """Add what one block of items hits to what earlier blocks hit."""

    def work(batches):
        for batch in batches:
            texts = texts_of(batch.column(1))
            held = [batch.column(i).to_pylist() for i in (2, 3, 6)] if batch.num_columns > 2 else None
            n_words, spans, chars, items = [], [], [], []
            for k, text in enumerate(texts):
                words = plain_words(text)
                n_words.append(len(words))
                hit, ids = windows.scan(words)
                if held:
                    hit = merge(hit, list(zip(held[0][k], held[1][k])))
                    ids |= set(held[2][k])
                spans.append(hit)
                chars.append(offsets(text, hit))
                items.append(sorted(ids))
            flat = lambda of, side: lists(
                np.array([x[side] for s in of for x in s], np.int32), [len(s) for s in of], pa.int32()
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    flat(spans, 0),
                    flat(spans, 1),
                    flat(chars, 0),
                    flat(chars, 1),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(n_words, pa.int64()),
                ],
                names=["row", "text", "begins", "ends", "first", "last", "item_ids", "n_words"],
            )

    schema = (
        "text string, begins array<int>, ends array<int>, first array<int>, last array<int>, "
        "item_ids array<string>, n_words long"
    )
    return map_text(rows, schema, work, "text")


def item_parts(items: DataFrame, width: int) -> DataFrame:
    """(k, t): items as they are, long ones as runs of words that have each window of the item once."""
    length = max(RUN_WORDS, 2 * width)
    words = F.regexp_extract_all(
        F.translate("t", ascii_uppercase, ascii_lowercase), F.lit(f"({WORD.pattern})"), F.lit(1)
    )
    step = length - width + 1

    def runs(w):  # bound once by the outer transform, or each slice would cut the text again
        starts = F.sequence(F.lit(0), F.size(w) - width, F.lit(step))
        cut = F.transform(starts, lambda i: F.array_join(F.slice(w, i + 1, F.lit(length)), " "))
        return F.when(F.size(w) > length, cut).otherwise(F.array(F.array_join(w, " ")))

    long = F.octet_length("t") > 2 * length  # shorter texts have fewer words
    parts = F.when(long, F.flatten(F.transform(F.array(words), runs))).otherwise(F.array("t"))
    return items.select("k", F.explode(parts).alias("t"))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    keep: list[str],
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """Where documents hold windows of items.

    A window is ``width`` consecutive words of an item, or all words of a shorter one. Returns one row for each input
    row (repeated rows included): ``row`` (struct of the columns in ``keep``), n_words, n_hit (words inside any
    window), n_items, item_ids (sorted), items_sha256, spans (characters of the original text, from and up to).
    Null or empty texts have no words and hit nothing; items without words are never hit; a null item key counts as
    an empty one; repeated items count once. No items: nothing is hit.
    """
    picked = items.select(
        F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("k"), F.col(item_text).cast("string").alias("t")
    ).where(F.col("t").isNotNull())
    picked = item_parts(picked, width)
    total = picked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-total // most_bytes) or 1
    rows = docs.select(pack(keep), F.col(text).cast("string").alias("text"))
    for block in range(blocks):
        mine = picked if blocks == 1 else picked.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == block)
        rows = _pass(rows, Windows([tuple(r) for r in mine.collect()], width))
    n_hit = F.aggregate(F.zip_with("begins", "ends", lambda a, b: b - a), F.lit(0), lambda a, x: a + x)
    return rows.select(
        "row",
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        "item_ids",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        F.arrays_zip(F.col("first").alias("first"), F.col("last").alias("last")).alias("spans"),
    )


def is_contaminated(share: int = 20):
    """At least one word in ``share`` is hit."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", share: int = 20, **options) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    found = find_items(docs, items, docs.columns, text, **options)
    return found.where(~is_contaminated(share)).select("row.*")


LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
PLAIN_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{PLAIN_WORDS}') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{PLAIN_WORDS}') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS win
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS u(i) WHERE len(w) > 0),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM d, (SELECT DISTINCT n FROM bw) AS s, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS u(i)),
hit AS (SELECT dw.doc_id, dw.n, dw.i, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids.ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


@query("op8_benchmark_decontamination", SQL)
def op8_benchmark_decontamination(spark, folder):
    found = find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"])
    return found.select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", is_contaminated().alias("contaminated")
    )

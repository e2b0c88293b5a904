"""Substring dedup by relative Lempel-Ziv parsing.

The reference is cut at content-defined anchors: in every window of 50 words the 8-word group with the smallest hash
is an anchor (so equal windows have the same anchor at the same place). The index holds, for each anchor that several
documents have, its first block: the smallest document with it, the place there, and the hash of the words up to that
document's next anchor. It is a table, dealt by anchor, since it grows with the corpus.

Each document is then factored greedily: a factor starts at an anchor with an earlier block and grows from anchor to
anchor as long as the blocks follow each other in the same reference document and their words agree. Factors of at
least 50 words are duplicate spans. What a factor leaves open are windows across factor boundaries, and windows that
another document than the first one holds: each of those whose anchor is shared is checked exactly, by the smallest
document that has the same window. Windows inside factors need no check, and no other document needs theirs: the
smallest document with a window never has it inside a factor.

Copies of a whole word sequence are settled before, by its digest. Words and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import WordHashes, blank_words, lists, map_text, mix, pack, staged, texts_of
from arrears.llm.registry import query, table

WINDOW = 50
ANCHOR = 8
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
WORD = regex.compile(rb"[^\x20\x09-\x0D]+")


def anchors_of(hashes: np.ndarray, window: int, width: int) -> np.ndarray:
    """For each window the place of its anchor: its ``width``-word group with the smallest hash, the first of equals."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64)
    group = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        group = mix(group ^ hashes[k : n - width + 1 + k])
    span = window - width + 1
    best, size = np.arange(len(group)), 1
    while 2 * size <= span:  # smallest of runs of 2, 4, 8 ...
        a, b = best[:-size], best[size:]
        best = np.where(group[b] < group[a], b, a)
        size *= 2
    if size < span:
        shift = span - size
        a, b = best[:-shift], best[shift:]
        best = np.where(group[b] < group[a], b, a)
    return best


@lru_cache(4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    return np.cumprod(np.full(n + 1, BASE, np.uint64)), np.cumprod(np.full(n + 1, inverse, np.uint64))


class Hashed:
    """Hashes of all runs of words of one text."""

    def __init__(self, hashes: np.ndarray):
        self.words = hashes
        n = len(hashes)
        # words a to b: the sum of hash / BASE^(distance from a), out of prefix sums
        self.power, inverse = powers(1 << max(10, n.bit_length()))
        self.prefix = np.concatenate([[np.uint64(0)], np.cumsum(hashes * inverse[:n])])

    def runs(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[begin]) * self.power[begin] + (end - begin).astype(np.uint64))

    def group(self, at: np.ndarray, width: int) -> np.ndarray:
        return self.runs(at, at + width)


def factors(
    pos: np.ndarray, doc: np.ndarray, mark: np.ndarray, ref: np.ndarray, same: np.ndarray, follows: np.ndarray, width: int
) -> list[tuple[int, int]]:
    """Greedy factors (first word, word after the last) over anchors with an earlier block.

    follows: the next entry is the document's next anchor; same: its words up to that anchor equal the block's.
    """
    if not len(pos):
        return []
    joined = (
        follows[:-1]
        & same[:-1]
        & (doc[1:] == doc[:-1])
        & (mark[1:] == mark[:-1])
        & (ref[1:] - ref[:-1] == pos[1:] - pos[:-1])
    )
    begin = np.flatnonzero(np.concatenate([[True], ~joined]))
    end = np.concatenate([begin[1:], [len(pos)]]) - 1
    return [(int(a), int(b) + width) for a, b in zip(pos[begin], pos[end])]


def digests(docs: DataFrame, key: str, text: str, window: int, width: int) -> DataFrame:
    """For each row: key, ``mark`` (hash of the text), n_words, sha (of all words), and its anchors.

    ``pos`` (place), ``gram`` (hash of the anchor's words), ``gap`` (hash of the words from this anchor through the
    next one; 0 for the last).
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).cast("string").alias("text"))

    def work(batches):
        known = WordHashes(1)
        for batch in batches:
            n_words, sha, pos, gram, gap, each = [], [], [], [], [], []
            for t in texts_of(batch.column(2)):
                words = blank_words(t)
                n_words.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).digest())
                if len(words) < window:
                    each.append(0)
                    continue
                hashed = Hashed(known.of(words))
                at = np.unique(anchors_of(hashed.words, window, width))
                each.append(len(at))
                pos.append(at)
                gram.append(hashed.group(at, width))
                gap.append(np.concatenate([hashed.runs(at[:-1], at[1:] + width), [np.uint64(0)]]))
            flat = lambda of, kind: np.concatenate(of).astype(kind) if of else np.zeros(0, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n_words, pa.int64()),
                    pa.array(sha, pa.binary()),
                    lists(flat(pos, np.int32), each, pa.int32()),
                    lists(flat(gram, np.uint64).view(np.int64), each, pa.int64()),
                    lists(flat(gap, np.uint64).view(np.int64), each, pa.int64()),
                ],
                names=["id", "mark", "n_words", "sha", "pos", "gram", "gap"],
            )

    schema = f"id {kind}, mark long, n_words long, sha binary, pos array<int>, gram array<long>, gap array<long>"
    return map_text(rows, schema, work, "text")


def parse(docs: DataFrame, blocks: DataFrame, key: str, text: str, window: int, width: int) -> DataFrame:
    """Factor each document that shares an anchor.

    blocks: id, mark, and ``found``: its shared anchors (pos, same, doc, ref_mark, ref).
    Returns id, mark, ``begins`` and ``ends`` of long factors, and the windows to be checked: ``at``, ``win``.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).cast("string").alias("text"))
    joined = rows.join(blocks, ["id", "mark"]).select("id", "mark", "text", "found")

    def work(batches):
        known = WordHashes(1)
        for batch in batches:
            found = batch.column(3)
            entries, offset = found.flatten(), found.offsets.to_numpy()
            offset = offset - offset[0]
            fields = {f: entries.field(f).to_numpy(zero_copy_only=False) for f in ("pos", "same", "ref_mark", "ref")}
            doc_of, ids = entries.field("doc"), batch.column(0)
            begins, ends, spans, at, win, windows = [], [], [], [], [], []
            for k, t in enumerate(texts_of(batch.column(2))):
                hashed = Hashed(known.of(blank_words(t)))
                own = anchors_of(hashed.words, window, width)
                a, b = int(offset[k]), int(offset[k + 1])
                order = np.argsort(fields["pos"][a:b])
                pos = fields["pos"][a:b][order].astype(np.int64)
                same, mark, ref = (fields[f][a:b][order] for f in ("same", "ref_mark", "ref"))
                docs_ = np.array(doc_of.slice(a, b - a).to_pylist(), object)[order]
                earlier = docs_ < ids[k].as_py()
                every = np.unique(own)
                rank = np.searchsorted(every, pos)
                e = np.flatnonzero(earlier)
                follows = np.concatenate([rank[e][1:] == rank[e][:-1] + 1, [False]]) if len(e) else np.zeros(0, bool)
                long = [
                    (x, y)
                    for x, y in factors(pos[e], docs_[e], mark[e], ref[e].astype(np.int64), same[e], follows, width)
                    if y - x >= window
                ]
                check = np.isin(own, pos)
                for x, y in long:
                    check[x : y - window + 1] = False
                places = np.flatnonzero(check)
                begins.extend(x for x, _ in long)
                ends.extend(y for _, y in long)
                spans.append(len(long))
                at.append(places)
                win.append(hashed.runs(places, places + window))
                windows.append(len(places))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    lists(np.array(begins, np.int32), spans, pa.int32()),
                    lists(np.array(ends, np.int32), spans, pa.int32()),
                    lists(np.concatenate(at).astype(np.int32), windows, pa.int32()),
                    lists(np.concatenate(win).view(np.int64), windows, pa.int64()),
                ],
                names=["id", "mark", "begins", "ends", "at", "win"],
            )

    schema = f"id {kind}, mark long, begins array<int>, ends array<int>, at array<int>, win array<long>"
    return map_text(joined, schema, work, "text")


def duplicate_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, width: int = ANCHOR
) -> DataFrame:
    """``id``, ``mark`` (hash of the text), ``copy`` (all words are duplicate), ``begins``, ``ends`` (word spans in
    factors) and ``at`` (checked windows), for documents with any duplicate window."""
    read = staged(digests(docs, key, text, window, width), "anchors").where(
        F.col("id").isNotNull() & (F.col("n_words") >= window)
    )
    first = staged(read.groupBy("sha").agg(F.min("id").alias("first")), "first-copies", read.count())
    seen = read.join(first, "sha")
    copies = seen.where(F.col("id") > F.col("first")).select("id", "mark").distinct()
    entries = (
        seen.where(F.col("id") == F.col("first"))
        .dropDuplicates(["id", "mark"])
        .select("id", "mark", F.explode(F.arrays_zip("pos", "gram", "gap")).alias("a"))
        .select("id", "mark", "a.pos", "a.gram", "a.gap")
    )
    entries = staged(entries, "anchor-places")
    index = staged(
        entries.groupBy("gram")
        .agg(
            F.min(F.struct("id", "mark", "pos", "gap")).alias("block"),
            F.max("id").alias("last"),
        )
        .where(F.col("block.id") != F.col("last"))
        .select("gram", "block"),
        "reference-blocks",
        entries.count(),
    )
    blocks = (
        entries.join(index, "gram")
        .select(
            "id",
            "mark",
            F.struct(
                "pos",
                (F.col("gap") == F.col("block.gap")).alias("same"),
                F.col("block.id").alias("doc"),
                F.col("block.mark").alias("ref_mark"),
                F.col("block.pos").alias("ref"),
            ).alias("found"),
        )
        .groupBy("id", "mark")
        .agg(F.collect_list("found").alias("found"))
    )
    parsed = staged(parse(docs, blocks, key, text, window, width), "factors")
    open_ = parsed.select("id", "mark", F.explode(F.arrays_zip("at", "win")).alias("w")).select(
        "id", "mark", "w.at", "w.win"
    )
    holders = staged(
        open_.groupBy("win")
        .agg(F.min("id").alias("holder"), F.max("id").alias("last"))
        .where(F.col("holder") < F.col("last"))
        .select("win", "holder"),
        "window-holders",
        parsed.agg(F.sum(F.size("at"))).first()[0] or 0,
    )
    checked = (
        open_.join(holders, "win")
        .where(F.col("id") > F.col("holder"))
        .groupBy("id", "mark")
        .agg(F.collect_set("at").alias("at"))
    )
    none = F.array().cast("array<int>")
    inside = parsed.where(F.size("begins") > 0).dropDuplicates(["id", "mark"]).select("id", "mark", "begins", "ends")
    found = inside.join(checked, ["id", "mark"], "full").select(
        "id",
        "mark",
        F.lit(False).alias("copy"),
        F.coalesce("begins", none).alias("begins"),
        F.coalesce("ends", none).alias("ends"),
        F.coalesce("at", none).alias("at"),
    )
    return found.unionByName(
        copies.select("id", "mark", F.lit(True).alias("copy"), none.alias("begins"), none.alias("ends"), none.alias("at"))
    )


def covered(n: int, copy: bool, begins, ends, at, window: int) -> np.ndarray:
    """Which of n words are in a duplicate window."""
    if copy:
        return np.ones(n, bool)
    edge = np.zeros(n + 1, np.int64)
    for begin, end in ((begins, ends), (at, [x + window for x in at])):
        np.add.at(edge, np.array(begin, np.int64), 1)
        np.add.at(edge, np.array(end, np.int64), -1)
    return np.cumsum(edge)[:n] > 0


def cut(text: bytes, gone: np.ndarray) -> bytes:
    """The text without the given words. A line break stands for a removed run."""
    out, at, pending = [], 0, False
    for k, m in enumerate(WORD.finditer(text)):
        if gone[k]:
            pending = True
            continue
        if pending:
            out.append(b"\n" if out else b"")
            at, pending = m.start(), False
        out.append(text[at : m.end()])
        at = m.end()
    if not pending:
        out.append(text[at:])
    return b"".join(out)


def remove_duplicates(
    docs: DataFrame,
    keep: list[str],
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    width: int = ANCHOR,
    texts: bool = False,
) -> DataFrame:
    """Remove each word in a window of ``window`` words that also starts in a document with a smaller key.

    One row for each input row: ``row`` (struct of ``keep``), n_words, n_removed, kept_sha256 (words that stay, joined
    by a blank), and with ``texts`` the text that stays. Null and empty texts have no words; rows with a null key lose
    nothing and take nothing from others; rows that repeat a key are not smaller than each other. An empty table gives
    an empty result.
    """
    spans = duplicate_spans(docs, key, text, window, width)
    rows = docs.select(
        pack(keep),
        F.col(text).cast("string").alias("text"),
        F.col(key).alias("id"),
        F.xxhash64(text).alias("mark"),
    )
    joined = rows.join(spans, ["id", "mark"], "left").select("row", "text", "copy", "begins", "ends", "at")

    def work(batches):
        for batch in batches:
            marks = [batch.column(i).to_pylist() for i in (2, 3, 4, 5)]
            null = batch.column(1).is_null().to_pylist()
            n_words, n_removed, sha, left = [], [], [], []
            for k, t in enumerate(texts_of(batch.column(1))):
                words = blank_words(t)
                n_words.append(len(words))
                if marks[0][k] is None:
                    n_removed.append(0)
                    kept, stays = words, t
                else:
                    gone = covered(len(words), *(m[k] for m in marks), window)
                    n_removed.append(int(gone.sum()))
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                    stays = cut(t, gone) if texts and n_removed[-1] else t
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                left.append(stays.decode() if texts and not null[k] else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(sha, pa.string()),
                    pa.array(left, pa.string()),
                ],
                names=["row", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return map_text(joined, "n_words long, n_removed long, kept_sha256 string, kept string", work, "text")


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars") -> DataFrame:
    """The documents without their duplicate words; those of which nothing is left go. ``chars`` is counted anew."""
    done = remove_duplicates(docs, docs.columns, key, text, texts=True)
    row = F.col("row")
    new = {
        text: F.col("kept"),
    }
    if chars in docs.columns:
        new[chars] = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(row[chars])
    left = done.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return left.select(*[new.get(c, row[c]).alias(c) for c in docs.columns])


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 49, 0) + 1)) AS u(i)),
holder AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT win.doc_id, p FROM win JOIN holder USING (s), unnest(range(i, i + 50)) AS u(p)
  WHERE win.doc_id > holder.first),
word AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS u(p)),
kept AS (
  SELECT word.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY word.p) AS s
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p WHERE gone.p IS NULL GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op6_substring_dedup", SQL)
def op6_substring_dedup(spark, folder):
    done = remove_duplicates(table(spark, folder, "documents"), ["doc_id"])
    return done.select("row.doc_id", "n_words", "n_removed", "kept_sha256")

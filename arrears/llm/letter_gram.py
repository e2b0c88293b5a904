"""Spelling variants: words one edit apart, found by products of letter counts.

An edit changes the count of one letter (inserted, deleted) or of two (replaced), so near words have squared distance 1
or 2 between their vectors of letter counts. These distances come from Gram matrices of blocks of words. To keep blocks
small, letters are dealt to four groups: an edit touches at most two of them, so near words agree in all counts of at
least two groups, and only words that do meet in a block (once for each of the six pairs of groups).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import WordHashes, map_text, mix, staged, texts_of
from arrears.llm.crc_sql import crc32
from arrears.llm.registry import query, table

LEAST_CHARS = 7
LEAST_COUNT = 2
EVERY = 31  # a run whose CRC this number divides loses a code point
RATIO = 10  # a form is at least so many times as frequent
GROUPS = 4
HALVES = list(combinations(range(GROUPS), 2))
TILE = 4096  # a block of more words is divided
MOST_HOT = 16_384  # and so many blocks at most, since the list of them is broadcast
SLAB = 2048  # words on either side of one product
WIDE = 48  # longer words are compared one by one
HELD = 200_000  # words a task counts before it hands them on

LETTERS = np.full(256, -1, np.int64)  # Latin-1 code of a lower-cased letter -> its place in a vector
LETTERS[97:123] = np.arange(26)
LETTERS[0xC0:0x100] = np.arange(26, 90)
N_LETTERS = 90


def count_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", chars: int = LEAST_CHARS, least: int = LEAST_COUNT
) -> DataFrame:
    """``word``, ``n``: words of at least ``chars`` code points, with at least ``least`` occurrences in all texts.

    A word is a maximal run of letters A-Z, a-z, U+00C0 to U+00FF, A-Z lower-cased. With h the CRC-32 of ``key:word``,
    a run loses its code point h % length where ``EVERY`` divides h. A null text has no words, a null key is empty,
    repeated rows count each. Counting starts in the tasks, which hand on at most ``HELD`` words at a time.
    """
    if chars < 1:
        raise ValueError("words have at least one code point")
    rows = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).cast("string").alias("text")
    )

    def work(batches):
        run = re.compile("[A-Za-zÀ-ÿ]{%d,}" % chars)  # greedy: whole runs, shorter ones can't count
        seen: dict[str, int] = {}

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for i, t in zip(texts_of(batch.column(0)), texts_of(batch.column(1))):
                start = zlib.crc32(i + b":")
                for m in run.finditer(t.lower().decode()):  # bytes.lower() lowers A-Z only
                    w = m[0]
                    h = zlib.crc32(w.encode(), start)
                    if h % EVERY == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1 :]
                        if len(w) < chars:
                            continue
                    seen[w] = seen.get(w, 0) + 1
            if len(seen) >= HELD:
                yield out()
                seen = {}
        yield out()

    counted = map_text(rows, "word string, n long", work, "text").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


class Words:
    """A block of words with their letter counts; ``code`` has them as Latin-1 bytes."""

    def __init__(self, code: list[bytes], n: np.ndarray, counts: np.ndarray | None = None):
        self.code, self.n = code, n
        self.size = np.fromiter(map(len, code), np.int64, len(code))
        self.counts = letter_counts(code, self.size) if counts is None else counts

    def __len__(self) -> int:
        return len(self.code)

    def part(self, a: int, b: int) -> Words:
        return Words(self.code[a:b], self.n[a:b], self.counts[a:b])

    def with_(self, other: Words) -> Words:
        return Words(
            self.code + other.code, np.concatenate([self.n, other.n]), np.concatenate([self.counts, other.counts])
        )


def letters(code: bytes) -> np.ndarray:
    found = LETTERS[np.frombuffer(code, np.uint8)]
    if (found < 0).any():
        raise ValueError("words consist of lower-case letters a-z and U+00C0 to U+00FF")
    return found


def letter_counts(code: list[bytes], size: np.ndarray) -> np.ndarray:
    flat = letters(b"".join(code))
    at = np.repeat(np.arange(len(code)), size) * N_LETTERS + flat
    return np.bincount(at, minlength=len(code) * N_LETTERS).reshape(-1, N_LETTERS).astype(np.int32)


def close_counts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) with a squared distance of 1 or 2 between row i of ``a`` and row j of ``b``: one Gram matrix."""
    top = int(max(a.max(initial=0), b.max(initial=0)))
    kind = np.float32 if top < 512 else np.float64  # sums of squares stay exact
    x, y = a.astype(kind), b.astype(kind)
    d = -2 * (x @ y.T)
    d += np.einsum("ij,ij->i", x, x)[:, None]
    d += np.einsum("ij,ij->i", y, y)[None, :]
    return np.nonzero((d > 0.5) & (d < 2.5))


def one_edit(a: bytes, b: bytes) -> bool:
    """Exactly one byte inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return k < len(b) and a[k + (len(a) == len(b)) :] == b[k + 1 :]


def edited(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """For each pair of words (a[i], b[j]), whether they are exactly one edit apart."""
    longer = np.maximum(a.size[i], b.size[j])
    keep = np.abs(a.size[i] - b.size[j]) <= 1
    for k in np.flatnonzero(keep & (longer > WIDE)):
        keep[k] = one_edit(a.code[i[k]], b.code[j[k]])
    at = np.flatnonzero(keep & (longer <= WIDE))
    if not len(at):
        return keep
    width = int(longer[at].max()) + 1
    swap = a.size[i[at]] > b.size[j[at]]
    left = [b.code[y] if s else a.code[x] for x, y, s in zip(i[at].tolist(), j[at].tolist(), swap.tolist())]
    right = [a.code[x] if s else b.code[y] for x, y, s in zip(i[at].tolist(), j[at].tolist(), swap.tolist())]
    x = np.array(left, f"S{width}").view(np.uint8).reshape(-1, width)
    y = np.array(right, f"S{width}").view(np.uint8).reshape(-1, width)
    differ = x != y
    same_size = a.size[i[at]] == b.size[j[at]]
    first = differ.argmax(1)
    beyond = (x[:, :-1] != y[:, 1:]) & (np.arange(width - 1) >= first[:, None])
    keep[at] = np.where(same_size, differ.sum(1) == 1, ~beyond.any(1))
    return keep


def near_pairs(home: Words, guest: Words | None, half: int, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of near words: within ``home``, or between ``home`` and ``guest``.

    All agree in the letters of the given half. A pair that agrees in an earlier half as well is left to that one.
    """
    other = ~np.isin(groups, HALVES[half])
    found_i, found_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    own = guest is None
    that = home if own else guest
    if own and len(home) <= 256:
        blocks = [(np.arange(len(home)), np.arange(len(home)))]
    else:
        blocks = []
        for size in np.unique(home.size).tolist():
            mine = np.flatnonzero(home.size == size)
            for near in (size, size + 1):
                theirs = np.flatnonzero(that.size == near)
                blocks += [
                    (mine[p : p + SLAB], theirs[q : q + SLAB])
                    for p in range(0, len(mine), SLAB)
                    for q in range(0, len(theirs), SLAB)
                    if not own or near > size or q >= p
                ]
    for mine, theirs in blocks:
        i, j = close_counts(home.counts[mine][:, other], that.counts[theirs][:, other])
        i, j = mine[i], theirs[j]
        if own:
            once = (home.size[i] < home.size[j]) | ((home.size[i] == home.size[j]) & (i < j))
            i, j = i[once], j[once]
        good = edited(home, i, that, j)
        i, j = i[good], j[good]
        changed = home.counts[i] != that.counts[j]
        touched = np.stack([changed[:, groups == g].any(1) for g in range(GROUPS)], 1)
        earlier = np.zeros(len(i), bool)
        for p, q in HALVES[:half]:
            earlier |= ~touched[:, p] & ~touched[:, q]
        found_i.append(i[~earlier])
        found_j.append(j[~earlier])
    return np.concatenate(found_i), np.concatenate(found_j)


def best_near(words: Words, i: np.ndarray, j: np.ndarray) -> list[tuple[bytes, int, int, bytes]]:
    """(word, near words, count of the most frequent one, that word) of all words in the pairs (i, j), taken both ways."""
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.code.__getitem__)] = np.arange(len(words))
    a, b = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.lexsort((rank[b], -words.n[b], a))
    a, b = a[order], b[order]
    start = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    many = np.diff(np.append(start, len(a)))
    code, n = words.code, words.n.tolist()
    return [
        (code[x], m, n[y], code[y]) for x, m, y in zip(a[start].tolist(), many.tolist(), b[start].tolist())
    ]


def letter_groups(words: DataFrame) -> np.ndarray:
    """The group of each letter, so that groups hold about as many letters: by frequency, to and fro.

    At most 90 counts reach the driver.
    """

    def work(batches):
        total = np.zeros(N_LETTERS, np.int64)
        for batch in batches:
            flat = "".join(batch.column(0).to_pylist()).encode("latin-1")
            total += np.bincount(letters(flat), minlength=N_LETTERS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(N_LETTERS)), pa.array(total)], names=["letter", "n"])

    counted = map_text(words.select("word"), "letter long, n long", work, "word").groupBy("letter").agg(F.sum("n"))
    found = dict(counted.collect())
    order = sorted(range(N_LETTERS), key=lambda k: (-found.get(k, 0), k))
    groups = np.zeros(N_LETTERS, np.int64)
    for rank, letter in enumerate(order):
        there, back = rank % (2 * GROUPS), 2 * GROUPS - 1 - rank % (2 * GROUPS)
        groups[letter] = min(there, back)
    return groups


def half_keys(words: DataFrame, groups: np.ndarray) -> DataFrame:
    """Six rows for each word: ``key`` (hash of its letter counts in two groups), ``half``, ``size``, ``word``, ``n``.

    A key may stand in several halves, which are different blocks.
    """

    def work(batches):
        # no sums of ``mix``: it maps 4 * k nearly to 4 times what it maps k to
        weight = WordHashes().of([bytes([k]) for k in range(N_LETTERS)])
        for batch in batches:
            block = Words([w.encode("latin-1") for w in batch.column(0).to_pylist()], np.empty(0))
            size = pa.array(block.size, pa.int32())
            counts = block.counts.astype(np.uint64)
            for half, pair in enumerate(HALVES):
                inside = np.isin(groups, pair)
                key = mix((counts[:, inside] * weight[inside]).sum(1, dtype=np.uint64) + np.uint64(half + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(np.full(len(block), half, np.int8)),
                        size,
                        batch.column(0),
                        batch.column(1),
                    ],
                    names=["key", "half", "size", "word", "n"],
                )

    return map_text(words.select("word", "n"), "key long, half byte, size int, word string, n long", work, "word")


def dealt(keyed: DataFrame, tile: int) -> DataFrame:
    """``block`` and ``guest`` of each word in each half, sorted; words of one block and one half meet.

    A key with at most ``tile`` words is one block. A larger one is cut by length, and a length into tiles: a word is at
    home in its tile and a guest in the earlier tiles of its length and in all tiles of the next smaller length. The
    lists that are broadcast have at most rows / ``tile`` entries each.
    """
    cells = keyed.groupBy("key", "size").agg(F.count("*").alias("m"))
    keys = cells.groupBy("key").agg(F.sum("m").alias("all"), F.collect_list(F.struct("size", "m")).alias("cell"))
    hot = staged(keys.where(F.col("all") > tile).select("key", "cell"), "variant-keys")
    large = hot.select("key", F.explode("cell").alias("c")).select(
        "key", F.col("c.size").alias("size"), F.ceil(F.col("c.m") / tile).cast("int").alias("tiles")
    )
    large = large.where("tiles > 1")
    below = large.select("key", (F.col("size") + 1).alias("size"), F.col("tiles").alias("tiles_below"))
    tiles, lower = F.coalesce("tiles", F.lit(1)), F.coalesce("tiles_below", F.lit(1))
    place = lambda size, k, guest: F.struct(F.xxhash64("key", size, k).alias("block"), F.lit(guest).alias("guest"))
    upto = lambda n: F.slice(F.sequence(F.lit(0), n.cast("int")), F.lit(1), n.cast("int"))  # noqa: E731  0 to n - 1
    own = F.pmod(F.xxhash64("word"), tiles)
    places = F.concat(
        F.array(place(F.col("size"), own.cast("int"), False)),
        F.transform(upto(own), lambda k: place(F.col("size"), k, True)),
        F.transform(upto(lower), lambda k: place(F.col("size") - 1, k, True)),
    )
    whole = F.array(F.struct(F.col("key").alias("block"), F.lit(False).alias("guest")))
    marked = (
        keyed.join(F.broadcast(hot.select("key", F.lit(True).alias("hot"))), "key", "left")
        .join(F.broadcast(large), ["key", "size"], "left")
        .join(F.broadcast(below), ["key", "size"], "left")
    )
    spread = marked.select("half", "word", "n", F.explode(F.when(F.col("hot"), places).otherwise(whole)).alias("p"))
    spread = spread.select(F.col("p.block").alias("block"), F.col("p.guest").alias("guest"), "half", "word", "n")
    return spread.repartition("block").sortWithinPartitions("block", "half", "guest")


def compare(blocks: DataFrame, groups: np.ndarray) -> DataFrame:
    """Of each word in each block: ``word``, ``n_near`` there, ``best_n``, ``best`` (its most frequent near word)."""

    def work(batches: Iterator[pa.RecordBatch]):
        block, home, half, done = None, None, 0, []

        def close():
            if home is not None and len(home) > 1:
                i, j = near_pairs(home, None, half, groups)
                if len(i):
                    done.extend(best_near(home, i, j))

        def out():
            text = lambda k: pa.array([r[k].decode("latin-1") for r in done], pa.string())
            whole = lambda k: pa.array([r[k] for r in done], pa.int64())
            return pa.RecordBatch.from_arrays([text(0), whole(1), whole(2), text(3)], names=["word", "n_near", "best_n", "best"])

        for batch in batches:
            which = batch.column(0).to_numpy()
            guest = batch.column(1).to_numpy(zero_copy_only=False)
            halves = batch.column(2).to_numpy()
            words = Words([w.encode("latin-1") for w in batch.column(3).to_pylist()], batch.column(4).to_numpy())
            changed = (which[1:] != which[:-1]) | (halves[1:] != halves[:-1]) | (guest[1:] != guest[:-1])
            cuts = np.flatnonzero(changed) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(words)]):
                if (which[a], halves[a]) != (block, half):
                    close()
                    block, home, half = which[a], None, int(halves[a])
                part = words.part(a, b)
                if not guest[a]:
                    home = part if home is None else home.with_(part)
                elif home is not None:
                    for k in range(0, len(part), SLAB):
                        some = part.part(k, k + SLAB)
                        i, j = near_pairs(home, some, half, groups)
                        if len(i):
                            done.extend(best_near(home.with_(some), i, j + len(home)))
            if len(done) >= HELD // 10:
                yield out()
                done = []
        close()
        yield out()

    return map_text(blocks, "word string, n_near long, best_n long, best string", work, "word")


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``word``, ``n``, ``n_near`` (words one edit apart), ``best`` and ``best_n`` (the most frequent, then smallest one).

    ``words`` has one row for each word (lower-case Latin-1 letters) and its count. An empty table gives an empty result.
    """
    words = staged(words.select("word", "n"), "variant-words")
    groups = letter_groups(words)
    keyed = staged(half_keys(words, groups), "variant-keyed")
    tile = max(tile, len(HALVES) * words.count() // MOST_HOT)
    found = compare(dealt(keyed, tile), groups)
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                        F.lit(None).cast("string").alias("best"))
    all_rows = none.unionByName(found.withColumn("n", F.lit(None).cast("long")))
    ranked = F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best"))
    summed = all_rows.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(ranked).alias("top")
    )
    return summed.select("word", "n", "n_near", F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n"))


def variants(words: DataFrame, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``: one row for each word.

    The form is the most frequent near word if it is at least ``ratio`` times as frequent. The root is where following
    forms ends: each step multiplies the count by ``ratio``, so a few rounds of doubling the steps reach it.
    """
    if ratio < 2:
        raise ValueError("ratio is at least 2, so that following forms ends")
    strong = F.col("best_n") >= ratio * F.col("n")
    judged = staged(
        near_words(words, tile).select(
            "word", F.when(strong, F.col("best")).alias("form"), "n", "n_near", F.when(strong, F.col("best_n")).alias("form_n")
        ),
        "variant-forms",
    )
    most = judged.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most, ratio)))
    root = judged.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        further = root.select(F.col("word").alias("root"), F.col("root").alias("next"))
        root = root.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        root = staged(root, "variant-roots")
    return judged.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {LEAST_CHARS}),
hashed AS (SELECT run, {crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs),
result AS (
  SELECT CASE WHEN h % {EVERY} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
words AS (
  SELECT word, count(*) AS n FROM result WHERE length(word) >= {LEAST_CHARS} GROUP BY word
  HAVING count(*) >= {LEAST_COUNT}),
places AS (SELECT word, n, unnest(range(length(word))) AS k FROM words),
holes AS (SELECT word, n, k, word[:k] AS l, word[k + 2:] AS r FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b USING (k, l, r) WHERE a.word <> b.word
  UNION SELECT w.word, h.word, h.n FROM words w JOIN holes h ON w.word = h.l || h.r
  UNION SELECT h.word, w.word, w.n FROM words w JOIN holes h ON w.word = h.l || h.r),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS top,
         arg_min(other, (-other_n, encode(other))) AS other FROM near GROUP BY word),
forms AS (
  SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= {RATIO} * words.n THEN other END AS form,
         CASE WHEN top >= {RATIO} * words.n THEN top END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL),
last AS (SELECT c.word, c.root FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN last USING (word)
"""


@query("op13_spelling_variants", SQL)
def op13_spelling_variants(spark, folder):
    return variants(count_words(table(spark, folder, "documents")))

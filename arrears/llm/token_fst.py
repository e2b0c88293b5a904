"""Token counts by finite-state tokenizer compilation.

The tokenizer is compiled into two deterministic transducers that run one after the other:

* the *splitter* marks the characters at which a pre-token starts (letters, digits, other signs, white space, with a
  blank joined to what follows). It needs one character of look-ahead;
* the *counter* reads marked bytes. Its transitions carry the number of emitted tokens (negative where a longer token
  replaces several shorter ones), so the sum over a path is the number of byte-pair tokens.

A state of the counter holds, for each open start of a possible token, the trie node reached from there, the last token
of the encoding before it, and the count there relative to now. Exactly one of the tokens that end at a byte can follow
the encoding before it, so the next state is determined. States are made when first needed (their number is finite,
but only a small part is ever met); when a task's table is full it is emptied and goes on, so memory is bounded.

Texts are cut into chunks that run side by side. A chunk's *state map* is known for one entry state, found by running
the bytes before it; maps compose when the exit of one is the entry of the next, and a map whose entry was guessed
wrongly is extended by running that chunk again. Counts then add up by a prefix sum over chunks.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import map_text, sum_tail, texts_of
from arrears.llm.registry import query, table

CHUNK = 512  # bytes of a chunk
WARM = 48  # bytes run before a chunk to find its entry state
PIECE = 2 << 20  # bytes of texts that are run side by side, at most, where they can be cut
STATES = 300_000  # states held by one task
PAIRS = 600_000  # remembered answers on token pairs
END, LETTER, DIGIT, OTHER, SPACE = range(5)

#: Unicode White_Space.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def byte_letters() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            out[[ord(c) for c in m.group()]] = kind
    out[WHITE] = SPACE
    return out


def starts(points: np.ndarray) -> np.ndarray:
    """Mark the code points at which a pre-token starts. A point 0x10FFFF + 1 ends a text and is never marked."""
    n = len(points)
    table = classes()
    kind = np.zeros(n + 1, np.uint8)
    real = points < 0x110000
    kind[:n][real] = table[points[real]]
    before = np.concatenate([[END], kind[: n - 1]]) if n else np.zeros(0, np.uint8)
    here, after = kind[:n], kind[1:]
    mark = real & (here != before)  # a run of one class starts
    space = here == SPACE
    last = space & (after != SPACE) & (after != END)  # last white space before something else
    mark |= last
    joined = last & (points == 32)
    follows = np.concatenate([[False], joined[:-1]]) if n else joined
    mark &= ~follows
    # a single apostrophe that starts a pre-token takes one of these endings
    lone = np.flatnonzero((points == 39) & mark & (after == LETTER))
    if len(lone):
        one = points[np.minimum(lone + 1, n - 1)]
        two = np.where(lone + 2 < n, points[np.minimum(lone + 2, n - 1)], 0)
        is_one = np.isin(one, [ord(c) for c in "stmd"])
        is_two = np.zeros(len(lone), bool)
        for pair in ("re", "ve", "ll"):
            is_two |= (one == ord(pair[0])) & (two == ord(pair[1]))
        took = is_one | is_two
        mark[lone[took] + 1] = False
        rest = lone[took] + np.where(is_one[took], 2, 3)
        rest = rest[rest < n]
        mark[rest[here[rest] == LETTER]] = True
    return mark


def pack(node: int, before: int, relative: int) -> int:
    """An open start as one number. A token has at most 128 bytes, so counts differ by less than 128."""
    return node << 32 | before + 1 << 8 | relative + 128


class Counter:
    """The counting transducer of one byte-pair vocabulary, with its transitions in an open hash table."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("only byte-level byte-pair vocabularies without a normaliser are supported")
        letters = byte_letters()
        plain = lambda token: bytes(letters[c] for c in token)
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        ids = {plain(t): i for t, i in model["vocab"].items() if t.encode() not in self.special}
        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            left, right = map(plain, pair if isinstance(pair, list) else pair.split(" "))
            a, b, whole = ids[left], ids[right], ids[left + right]
            self.rank[a << 20 | b] = r
            self.halves.setdefault(whole, (r, a, b))
        if max(map(len, ids)) > 128:
            raise ValueError("tokens of more than 128 bytes")
        # the trie: (node, byte) -> node; the token that ends at a node, or -1
        self.child: dict[int, int] = {}
        self.token = [-1]
        for text, i in ids.items():
            at = 0
            for c in text:
                step = self.child.get(at << 8 | c)
                if step is None:
                    step = self.child[at << 8 | c] = len(self.token)
                    self.token.append(-1)
                at = step
            self.token[at] = i
        self.spine: dict[int, tuple[list, list]] = {}
        self.fits: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states = [array("q", [pack(0, -1, 0)]).tobytes()]  # compact, for there are many
        self.number: dict[bytes, int] = {self.states[0]: 0}
        self.slots = 1 << 16
        self.keys = np.full(self.slots, -1, np.int64)
        self.next = np.zeros(self.slots, np.int32)
        self.adds = np.zeros(self.slots, np.int8)
        self.held = 0
        self.fits.clear()

    def spines(self, token: int) -> tuple[list, list]:
        """The token's parts along its left and its right edge, innermost first, each with the rank of the merge that
        absorbs it."""
        found = self.spine.get(token)
        if found is None:
            found = ([], [])
            for side in (0, 1):
                at, absorbed, parts = token, 1 << 40, found[side]
                while True:
                    parts.append((at, absorbed))
                    if at not in self.halves:
                        break
                    absorbed = self.halves[at][0]
                    at = self.halves[at][1 + side]
                parts.reverse()
            self.spine[token] = found
        return found

    def may_follow(self, left: int, right: int) -> bool:
        """True if no merge across the border comes before the merges that make the two tokens."""
        found = self.fits.get(left << 20 | right)
        if found is None:
            a, b = self.spines(left)[1], self.spines(right)[0]
            i = j = 0
            found = True
            while True:
                (x, x_gone), (y, y_gone) = a[i], b[j]
                r = self.rank.get(x << 20 | y)
                # of equal merges the leftmost comes first
                if r is not None and r < x_gone and r <= y_gone:
                    found = False
                    break
                if i + 1 == len(a) and j + 1 == len(b):
                    break
                if x_gone <= y_gone:
                    i += 1
                else:
                    j += 1
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            self.fits[left << 20 | right] = found
        return found

    def step(self, state: int, byte: int, marked: bool) -> tuple[int, int]:
        """Next state and the tokens it adds."""
        open_, now, count = [], None, 0
        for packed in array("q", self.states[0 if marked else state]):
            node = self.child.get(packed >> 32 << 8 | byte)
            if node is None:
                continue
            before, relative = (packed >> 8 & 0xFFFFFF) - 1, (packed & 255) - 128
            open_.append((node, before, relative))
            token = self.token[node]
            if now is None and token >= 0 and (before < 0 or self.may_follow(before, token)):
                now, count = token, relative + 1
        made = array("q", [*(pack(n, b, r - count) for n, b, r in open_), pack(0, now, 0)]).tobytes()
        return self.enter(made), count

    def enter(self, state: bytes) -> int:
        """The number of a state that is given by its content, after the table was emptied too."""
        at = self.number.get(state)
        if at is None:
            at = self.number[state] = len(self.states)
            self.states.append(state)
        return at

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * 0x9E3779B1) >> 7) & (self.slots - 1)

    def _put(self, key: int, state: int, adds: int) -> None:
        slot = int(((key * 0x9E3779B1) >> 7) & (self.slots - 1))
        while self.keys[slot] != -1:
            slot = (slot + 1) & (self.slots - 1)
        self.keys[slot], self.next[slot], self.adds[slot] = key, state, adds
        self.held += 1

    def _grow(self) -> None:
        full = self.keys >= 0
        keys, nexts, adds = self.keys[full], self.next[full], self.adds[full]
        self.slots *= 2
        self.keys = np.full(self.slots, -1, np.int64)
        self.next = np.zeros(self.slots, np.int32)
        self.adds = np.zeros(self.slots, np.int8)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):  # each free slot takes the first key that wants it, the others go one further
            free = self.keys[slot[left]] == -1
            wanted, first = np.unique(slot[left][free], return_index=True)
            put = left[free][first]
            self.keys[wanted], self.next[wanted], self.adds[wanted] = keys[put], nexts[put], adds[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slot[left] = (slot[left] + 1) & (self.slots - 1)

    def run(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of many lanes. symbol: byte, plus 256 where a pre-token starts. States of marked lanes don't
        matter."""
        key = np.where(symbol >= 256, symbol, state.astype(np.int64) << 9 | symbol)
        slot = self._slot(key)
        found = self.keys[slot]
        wrong = np.flatnonzero(found != key)
        while len(wrong):
            seek = wrong
            while len(seek):  # go on to the key or to a free slot
                busy = (self.keys[slot[seek]] != key[seek]) & (self.keys[slot[seek]] != -1)
                seek = seek[busy]
                slot[seek] = (slot[seek] + 1) & (self.slots - 1)
            wrong = wrong[self.keys[slot[wrong]] == -1]
            if len(wrong):
                for k in np.unique(key[wrong]).tolist():
                    if 2 * self.held >= self.slots:
                        self._grow()
                    self._put(k, *self.step(k >> 9, k & 255, bool(k & 256)))
                slot = self._slot(key)
                wrong = np.arange(len(key))
        return self.next[slot], self.adds[slot]


def _chunks(symbols: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, offset and length of each chunk."""
    n = -(-size // CHUNK)
    text = np.repeat(np.arange(len(size)), n)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    at = begin[text] + rank * CHUNK
    return text, at, np.minimum(CHUNK, begin[text] + size[text] - at)


def _through(counter: Counter, state, symbols, at, size) -> tuple[np.ndarray, np.ndarray]:
    """Run chunks from their entry states: exit states and counts."""
    state, total = state.copy(), np.zeros(len(at), np.int64)
    order = np.argsort(-size, kind="stable")
    lanes = len(order)
    lengths = size[order]
    for j in range(int(lengths[0]) if lanes else 0):
        lanes = int(np.searchsorted(-lengths, -j, side="left"))  # chunks longer than j
        on = order[:lanes]
        state[on], adds = counter.run(state[on], symbols[at[on] + j])
        total[on] += adds
    return state, total


def count_texts(counter: Counter, texts: list[bytes]) -> np.ndarray:
    """Tokens of each text (pieces between special tokens)."""
    counts = np.zeros(len(texts), np.int64)
    if not any(texts):
        return counts
    if len(counter.states) > STATES:
        counter.clear()
    points = np.frombuffer("".join(t.decode() + "\0" for t in texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    chars = np.array([len(t) - sum_tail(t) for t in texts])
    ends = np.cumsum(chars + 1) - 1
    points[ends] = 0x110000
    mark = starts(points)
    width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    width[ends] = 0
    offset = np.cumsum(width) - width
    symbols = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    symbols[offset[mark]] += 256
    size = np.array([len(t) for t in texts])
    text, total, _ = _run(counter, symbols, size)
    run = np.concatenate([[0], np.cumsum(total)])
    full = size > 0
    first = np.searchsorted(text, np.flatnonzero(full), side="left")
    past = np.searchsorted(text, np.flatnonzero(full), side="right")
    counts[full] = run[past] - run[first]
    return counts


def _run(counter: Counter, symbols: np.ndarray, size: np.ndarray, state: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Chunks of texts that lie one behind the other, each text entered in ``state``: the text and the tokens of each
    chunk, and the state after the last."""
    begin = np.cumsum(size) - size
    text, at, length = _chunks(symbols, begin, size)
    # entry states: run the bytes before the chunk
    warm = np.minimum(WARM, at - begin[text])
    entry, _ = _through(counter, np.zeros(len(at), np.int32), symbols, at - warm, warm)
    entry[warm == 0] = state
    leave, total = _through(counter, entry, symbols, at, length)
    inner = np.concatenate([[False], text[1:] == text[:-1]])
    while True:
        off = np.flatnonzero(inner & (entry != np.concatenate([[0], leave[:-1]])))
        if not len(off):
            return text, total, int(leave[-1])
        entry[off] = leave[off - 1]
        leave[off], total[off] = _through(counter, entry[off], symbols, at[off], length[off])


def count_uncut(counter: Counter, text: bytes) -> int:
    """Tokens of a text without places to cut, window by window: each is entered in the state that the one before left.

    Whether a pre-token starts at a character is decided by a few characters around it, so a window is marked with its
    edges; memory beside the text's code points is that of one window.
    """
    points = np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)
    window = max(1, PIECE // 4)
    state, tokens = counter.states[0], 0
    for a in range(0, len(points), window):
        if len(counter.states) > STATES:
            counter.clear()
        b = min(len(points), a + window)
        low = max(0, a - EDGE)
        mark = starts(points[low : b + EDGE].astype(np.int64))[a - low : b - low]
        mine = points[a:b]
        width = 1 + (mine >= 0x80) + (mine >= 0x800) + (mine >= 0x10000)
        symbols = np.frombuffer(mine.tobytes().decode("utf-32-le").encode(), np.uint8).astype(np.int64)
        symbols[(np.cumsum(width) - width)[mark]] += 256
        _, total, last = _run(counter, symbols, np.array([len(symbols)]), counter.enter(state))
        state, tokens = counter.states[last], tokens + int(total.sum())
    return tokens


def pieces(text: bytes) -> list[bytes]:
    """Cut a long text where a pre-token starts whatever stands further away: before a blank between two characters
    that are no white space, and between a letter and a sign. What holds no such place stays whole."""
    if len(text) <= PIECE:
        return [text]
    out, points, a = [], text.decode(), 0
    while cut := CUT.search(points, a + PIECE // 4):
        b = cut.start() + 1
        out.append(points[a:b].encode())
        a = b
    return [*out, points[a:].encode()]


EDGE = 8  # characters beside a window that are read to mark its own
CUT = regex.compile(r"\S(?= \S)|\p{L}(?=[^\s\p{L}\p{N}])")


@lru_cache(4)
def compiled(path: str) -> Counter:
    """One for each Python worker and file, kept from task to task."""
    return Counter(path)


def token_counts(texts: list[bytes], path: str) -> list[int]:
    counter = compiled(path)
    parts, owner, extra = [], [], [0] * len(texts)
    for k, text in enumerate(texts):
        segments = [text]
        for special in counter.special:
            split = [s.split(special) for s in segments]
            extra[k] += sum(len(s) - 1 for s in split)
            segments = [x for s in split for x in s]
        for s in segments:
            for p in pieces(s):
                parts.append(p)
                owner.append(k)
    out, a = np.array(extra, np.int64), 0
    while a < len(parts):
        if len(parts[a]) > 2 * PIECE:
            out[owner[a]] += count_uncut(counter, parts[a])
            a += 1
            continue
        b, held = a, 0
        while b < len(parts) and (b == a or held + len(parts[b]) <= PIECE):
            held += len(parts[b])
            b += 1
        np.add.at(out, owner[a:b], count_texts(counter, parts[a:b]))
        a = b
    return out.tolist()


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of each text, and whether it has more than ``limit`` tokens.

    One row for each input row, repeated rows included; other columns are left out. A null or empty text has no bytes
    and no tokens; a null key stays null. A very long text is run in pieces, and what cannot be cut in windows that hand
    on their state, so the arrays at work are bounded whatever its length. ``path`` names a
    byte-level vocabulary file that every executor can open.
    """
    kind = docs.schema[key].dataType.simpleString()

    def work(batches):
        for batch in batches:
            texts = texts_of(batch.column(1))
            counts = token_counts(texts, path)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64())],
                names=["key", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    counted = map_text(rows, f"key {kind}, n_bytes long, n_tokens long", work, "text")
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


@query("op10_token_counts")
def op10_token_counts(spark, folder):
    import public_tokenizers

    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))

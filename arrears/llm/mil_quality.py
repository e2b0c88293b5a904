"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (64 words each, all of its text). Each passage is encoded; gated attention gives each
passage a weight within its document, the weighted sum of the encoded passages is the document's representation, and
its score is a logistic function of that. Encoder, attention and score are learned together from labels of documents.

The model is fitted on a bounded sample of labelled documents (``SAMPLE``, the smallest hashes of their keys); every
document is scored, whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import map_text, mix, pack, texts_of
from arrears.llm.lm_bloom import held_out
from arrears.llm.registry import query, table

PASSAGE = 64  # words
SAMPLE = 6000  # labelled documents for fitting
HIDDEN, ATTENTION = 24, 12
EPOCHS, BAGS, RATE, DECAY = 30, 128, 0.01, 1e-4

#: Bytes are told apart as: white space, small letters, capitals, digits, exclamation and question marks, bars,
#: other rare signs, brackets and quotes, stops and commas, bytes of non-ASCII characters, controls and the rest.
KINDS = (
    b" \t\n\v\f\r", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b"!?", b"|", b"#*$%&<>@^~=+\\_{}",
    b"()[]\"'`", b".,;:-/", bytes(range(128, 256)),
)
BLANK = re.compile(rb"[ \t\n\v\f\r]")
KIND = np.full(256, len(KINDS), np.int64)
for _k, _bytes in enumerate(KINDS):
    KIND[list(_bytes)] = _k
LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Shares of the kinds of bytes; then line breaks, word length, distinct words, words like the one before, words like
#: one of the four before, capitals at word starts, and how full the passage is.
FEATURES = len(KINDS) + 1 + 7


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages and the number of passages of each text. A text without words is one empty passage."""
    joined = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    kind = KIND[joined]
    blank = kind == 0
    before = np.concatenate([[True], blank[:-1]])
    first = np.cumsum(sizes) - sizes
    start = ~blank & before
    word_at = np.flatnonzero(start)
    owner = np.searchsorted(first, word_at, side="right") - 1
    words = np.bincount(owner, minlength=len(texts))
    bags = np.maximum(1, -(-words // PASSAGE))
    base = np.cumsum(bags) - bags
    rank = np.arange(len(word_at)) - (np.cumsum(words) - words)[owner]
    home = base[owner] + rank // PASSAGE  # passage of each word
    total = int(bags.sum())
    out = np.zeros((total, FEATURES))
    if not len(word_at):
        return out, bags
    # bytes belong to the passage of the last word start, those before the first word to the first passage
    place = np.searchsorted(word_at, np.arange(len(joined)), side="right") - 1
    text_of = np.repeat(np.arange(len(texts)), sizes)
    home_of = np.maximum(home[np.maximum(place, 0)], base[text_of])
    home_of = np.minimum(home_of, base[text_of] + bags[text_of] - 1)
    kinds = len(KINDS) + 1
    counts = np.bincount(home_of * kinds + kind, minlength=total * kinds).reshape(total, kinds).astype(float)
    length = np.maximum(counts.sum(1), 1)
    out[:, :kinds] = counts / length[:, None]
    out[:, kinds] = np.bincount(home_of, joined == 10, total) / length
    in_passage = np.bincount(home, minlength=total)
    some = np.maximum(in_passage, 1)
    inside = np.where(blank, np.uint64(0), LETTER[joined])
    hashed = np.add.reduceat(inside, word_at)
    out[:, kinds + 1] = (length - counts[:, 0]) / some / 10
    # distinct words of a passage: each (passage, word) counts once
    _, where = np.unique(mix(hashed) ^ mix(home.astype(np.uint64)), return_index=True)
    out[:, kinds + 2] = np.bincount(home[where], minlength=total) / some
    again = np.zeros(len(hashed), bool)
    for back in range(1, 5):
        same = np.zeros(len(hashed), bool)
        same[back:] = (hashed[back:] == hashed[:-back]) & (home[back:] == home[:-back])
        if back == 1:
            out[:, kinds + 3] = np.bincount(home, same, total) / some
        again |= same
    out[:, kinds + 4] = np.bincount(home, again, total) / some
    out[:, kinds + 5] = np.bincount(home, kind[word_at] == 2, total) / some
    out[:, kinds + 6] = in_passage / PASSAGE
    out[in_passage == 0] = 0  # whatever stands beside it in the batch
    return out, bags


PART = 1 << 20  # bytes of texts whose features are made together


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``passages`` in parts, to bound memory. A longer text is cut at white space, where a passage then ends."""
    parts, owner = [], []
    for k, text in enumerate(texts):
        while len(text) > PART:
            cut = BLANK.search(text, PART)
            if not cut:
                break
            parts.append(text[: cut.start()])
            owner.append(k)
            text = text[cut.end() :]
        parts.append(text)
        owner.append(k)
    bags, found, at = np.zeros(len(texts), np.int64), [np.zeros((0, FEATURES))], 0
    while at < len(parts):
        end, held = at, 0
        while end < len(parts) and (end == at or held + len(parts[end]) <= PART):
            held += len(parts[end])
            end += 1
        x, n = passages(parts[at:end])
        found.append(x)
        np.add.at(bags, owner[at:end], n)
        at = end
    return np.concatenate(found), bags


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Attention:
    """The network and its gradients."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed).normal
        self.shift, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.weights = {
            "encode": draw(0, FEATURES**-0.5, (FEATURES, HIDDEN)),
            "encode0": np.zeros(HIDDEN),
            "value": draw(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)),
            "gate": draw(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)),
            "weigh": draw(0, ATTENTION**-0.5, ATTENTION),
            "score": draw(0, HIDDEN**-0.5, HIDDEN),
            "score0": np.zeros(1),
        }

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict:
        w = self.weights
        first, bag = np.cumsum(bags) - bags, np.repeat(np.arange(len(bags)), bags)
        h = np.tanh(x @ w["encode"] + w["encode0"])
        value, gate = np.tanh(h @ w["value"]), sigmoid(h @ w["gate"])
        e = (value * gate) @ w["weigh"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        attention = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(attention[:, None] * h, first, axis=0)
        p = sigmoid(z @ w["score"] + w["score0"][0])
        return {"h": h, "value": value, "gate": gate, "attention": attention, "z": z, "p": p, "bag": bag, "first": first}

    def gradients(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict:
        w, f = self.weights, self.forward(x, bags)
        bag, a, h = f["bag"], f["attention"], f["h"]
        error = (f["p"] - y) / len(y)
        dz = error[:, None] * w["score"]
        da = (h * dz[bag]).sum(1)
        de = a * (da - np.add.reduceat(a * da, f["first"])[bag])
        dmix = de[:, None] * w["weigh"]
        dvalue = dmix * f["gate"] * (1 - f["value"] ** 2)
        dgate = dmix * f["value"] * f["gate"] * (1 - f["gate"])
        dh = a[:, None] * dz[bag] + dvalue @ w["value"].T + dgate @ w["gate"].T
        dh *= 1 - h**2
        return {
            "encode": x.T @ dh,
            "encode0": dh.sum(0),
            "value": h.T @ dvalue,
            "gate": h.T @ dgate,
            "weigh": (f["value"] * f["gate"]).T @ de,
            "score": f["z"].T @ error,
            "score0": np.array([error.sum()]),
        }

    def fit(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray, seed: int = 7) -> Attention:
        """Adam over bags in random order. Without labels, or with one class only, the score is its smoothed share."""
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.weights["score0"][:] = np.log(share / (1 - share))
        if len(set(y.tolist())) < 2:
            self.weights["score"][:] = 0
            return self
        self.shift, self.scale = x.mean(0), x.std(0) + 1e-3
        x = self.scaled(x)
        first = np.cumsum(bags) - bags
        rng, mean, square, step = np.random.default_rng(seed), {}, {}, 0
        for epoch in range(EPOCHS):
            rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
            order = rng.permutation(len(y))
            for at in range(0, len(order), BAGS):
                chosen, step = order[at : at + BAGS], step + 1
                size = bags[chosen]
                rows = np.repeat(first[chosen] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                for k, g in self.gradients(x[rows], size, y[chosen]).items():
                    g = g + DECAY * self.weights[k]
                    mean[k] = 0.9 * mean.get(k, 0) + 0.1 * g
                    square[k] = 0.999 * square.get(k, 0) + 0.001 * g * g
                    up = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = self.weights[k] - rate * up
        return self

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.shift) / self.scale, -8, 8)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x, bags = encode(texts)
        return self.forward(self.scaled(x), bags)["p"]


def fit_quality(labelled: DataFrame, text: str = "text", label: str = "label") -> Attention:
    """Fit on all given rows (the caller bounds them): their passages' features come to the driver, not their texts."""
    rows = labelled.select(F.col(label).cast("double").alias("label"), F.col(text).cast("string").alias("text"))

    def work(batches):
        for batch in batches:
            x, bags = encode(texts_of(batch.column(1)))
            cuts = np.cumsum(bags)[:-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p.astype(np.float32).tobytes() for p in np.split(x, cuts)], pa.binary())],
                names=["label", "x"],
            )

    found = sorted(map(tuple, map_text(rows, "label double, x binary", work, "text").collect()), key=lambda r: r[1])
    parts = [np.frombuffer(x, np.float32).reshape(-1, FEATURES).astype(float) for _, x in found]
    if not parts:
        return Attention().fit(np.zeros((0, FEATURES)), np.zeros(0, np.int64), np.zeros(0))
    return Attention().fit(np.concatenate(parts), np.array([len(p) for p in parts]), np.array([y for y, _ in found]))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, label: str, text: str, most: int = SAMPLE) -> DataFrame:
    """Labelled documents that are not held out, at most ``most`` of them: the smallest hashes of their keys.

    Null keys and labels are left out; a key with several labels counts with the largest, a key with several texts
    with each.
    """
    chosen = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key, 5))
        .groupBy(F.col(key).alias("key"))
        .agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(most)
    )
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.join(F.broadcast(chosen), "key").select("text", "label")  # at most ``most`` rows are broadcast


def score_quality(docs: DataFrame, model: Attention, keep: list[str], text: str = "text") -> DataFrame:
    """``row`` (struct of ``keep``) and ``score`` for each row, repeated rows included; null is an empty text."""
    rows = docs.select(pack(keep), F.col(text).cast("string").alias("text"))

    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(texts_of(batch.column(1))))], names=["row", "score"]
            )

    return map_text(rows, "score double", work, "text")


@query("op7_quality_classifier")
def op7_quality_classifier(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = fit_quality(labelled_sample(docs, labels, "doc_id", "quality", "text"))
    out = score_quality(docs.withColumn("held_out", held_out("doc_id", 5)), model, ["doc_id", "held_out"])
    return out.select(
        "row.doc_id", "row.held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )

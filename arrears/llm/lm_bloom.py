"""Language-model scores out of a log-frequency Bloom filter.

Tokens and pairs of tokens of the training texts are counted (blocks of hashes and counts, dealt by hash). Counts are
quantised on a logarithmic scale, and an n-gram of level q enters the filter q times, once for each level up to its
own. A count is read back by probing levels 1, 2, ... until one is missing. The filter is a table of segments, each
made out of its counted n-grams. Its size follows their number and levels, so that the rate of false levels stays
below ``FALSE_LEVEL`` for any input. Only a tiny one (``MOST_BITS``) is broadcast, since a broadcast filter passes whole
through the driver; any other stays a table, and the n-grams of each batch of texts are sent to its segments. The number of segments follows the bytes of the training texts, so that
what meets in one task to be counted, entered or probed stays at about ``GROUP`` n-grams while the corpus grows; an
n-gram that stands everywhere adds one entry for each ``FLUSH`` tokens.

Probabilities are those of pairs, smoothed with those of single tokens. The plain base score needs exact counts:
those of the most frequent tokens (at most ``HEAD``) are broadcast, and give their levels too; all others are answered
with the levels by the tokens' segments, once for a batch, or joined where the whole filter is broadcast.

Ascending hashes are sent and stored as differences, byte by byte of equal weight (``folded``): about a quarter less.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.common import BATCH_BYTES, WordHashes, blank_words, lists, map_text, mix, pack, small_batches, staged, texts_of
from arrears.llm.registry import query, table

LEAST_SEGMENT_BITS = 6  # log2 of the smallest number of segments
GROUP = 1 << 20  # counted n-grams that a segment receives at most on average
BATCHES = 1 << 20  # batches of texts whose n-grams are probed together
LEAST_BITS, MOST_BITS = 20, 22  # log2 of the bits of the smallest filter, and of the largest that is broadcast
FALSE_LEVEL = 0.02  # share of levels that may be read though they are not in the filter
PROBES = 3
MOST_LEVEL = 109  # of the largest 64-bit count
STEP = 1.5  # ratio of counts from level to level
TEXT_LEVEL = 6  # of zstd, for texts that are written and shuffled
FLUSH = 1_500_000  # tokens counted together in a task
HEAD = 1 << 18
MOST_TRUST, PRIOR = 0.4, 20.0  # weight of pairs, and the count of the left token at which it is half of that
END, START = b"\n", b" "  # no words, so no word's hash is theirs
ONE, TWO = 1, 2


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left) + right)


def segment_bits_for(size: int, texts: int) -> int:
    """log2 of the segments that keep each at ``GROUP`` n-grams; texts of ``size`` bytes have no more tokens than this."""
    tokens = size // 2 + 2 * texts
    return max(LEAST_SEGMENT_BITS, math.ceil(math.log2(max(tokens, 1) / GROUP)))


def segments(hashes: np.ndarray, cut: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - cut)).astype(np.int64)


def bits_for(entries: int, cut: int = LEAST_SEGMENT_BITS) -> int:
    """log2 of the bits that keep the rate of false levels below ``FALSE_LEVEL`` with so many levels entered.

    A segment has a whole number of bytes.
    """
    bits = -PROBES * entries / math.log1p(-(FALSE_LEVEL ** (1 / PROBES)))
    return max(LEAST_BITS, cut + 3, math.ceil(math.log2(max(bits, 1))))


def bit_places(hashes: np.ndarray, level: int, width: int) -> Iterator[np.ndarray]:
    """Places of an n-gram's level within its segment of ``2 ** width`` bits: one for each probe."""
    h = mix(hashes + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    for k in range(PROBES):
        yield ((a + np.uint64(k) * b) & np.uint64((1 << width) - 1)).astype(np.int64)


def levels(counts: np.ndarray) -> np.ndarray:
    """1 for a count of one, one more for each factor STEP."""
    return 1 + np.floor(np.log(counts) / math.log(STEP) + 1e-9).astype(np.int64)


def middle(level: np.ndarray) -> np.ndarray:
    """A count for each level: the middle of those that share it; 0 for level 0."""
    low = np.ceil(STEP ** (level - 1.0) - 1e-9)
    high = np.maximum(np.ceil(STEP**level - 1e-9) - 1, low)
    return np.where(level > 0, (low + high) / 2, 0.0)


def field_of(hashes: np.ndarray, level: np.ndarray, width: int) -> bytes:
    """The segment of the filter that holds these n-grams, all of one segment."""
    field = np.zeros(1 << width, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        for at in bit_places(hashes[level >= j], j, width):
            field[at] = True
    return np.packbits(field, bitorder="little").tobytes()


def probe(field: np.ndarray, hashes: np.ndarray, bits: int, cut: int, highest: int = MOST_LEVEL) -> np.ndarray:
    """Level of each n-gram, at most ``highest``. The field is the whole filter, or the segment of all the n-grams."""
    level = np.zeros(len(hashes), np.int64)
    left, j = np.arange(len(hashes)), 1
    base = segments(hashes, cut) << (bits - cut)
    if len(field) < 1 << bits - 3:
        base = np.zeros_like(base)
    while len(left) and j <= highest:
        held = np.ones(len(left), bool)
        for at in bit_places(hashes[left], j, bits - cut):
            at = base[left] + at
            held &= (field[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        left = left[held]
        level[left] = j
        j += 1
    return level


def coarse(hashes: np.ndarray, cut: int) -> np.ndarray:
    """Pairs are counted by their segment and 32 more bits of their hash, which errs far less often than the filter."""
    return hashes & np.uint64((1 << 64) - (1 << 32 - cut))


def narrowed(hashes: np.ndarray, kind: int, cut: int) -> np.ndarray:
    """Hashes as they are stored: the segment has the rest of those of pairs."""
    return hashes if kind == ONE else (hashes >> np.uint64(32 - cut)).astype(np.uint32)


def widened(parts: list[bytes], kind: int, segment: int, cut: int) -> np.ndarray:
    if kind == ONE:
        return np.concatenate([np.frombuffer(x, np.uint64) for x in parts])
    narrow = np.concatenate([np.frombuffer(x, np.uint32) for x in parts]).astype(np.uint64)
    return (np.uint64(segment) << np.uint64(64 - cut)) | (narrow << np.uint64(32 - cut))


def planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then their second ones and so on: high bytes that are zero take no room."""
    return values.view(np.uint8).reshape(len(values), -1 if len(values) else values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def folded(ascending: np.ndarray) -> bytes:
    """Stored hashes of one segment as differences."""
    return planes(np.diff(ascending, prepend=ascending.dtype.type(0)))


def unfolded(data: bytes, kind: int) -> np.ndarray:
    number = np.uint64 if kind == ONE else np.uint32
    return np.cumsum(from_planes(data, number), dtype=number)


def runs(hashes: np.ndarray, cut: int) -> tuple[np.ndarray, list[slice]]:
    """The segments that ascending hashes fall into, and where the hashes of each stand."""
    full, begin = np.unique(segments(hashes, cut), return_index=True)
    return full, [slice(a, b) for a, b in zip(begin, [*begin[1:], len(hashes)])]


class Tokens:
    """Token hashes of the texts of a batch, each with its end."""

    def __init__(self, texts: list[bytes], known: WordHashes):
        words = [[*blank_words(t.lower()), END] for t in texts]
        self.counts = np.array([len(w) for w in words])
        self.hashes = known.of([x for w in words for x in w])
        self.owner = np.repeat(np.arange(len(texts)), self.counts)
        before = np.concatenate([[np.uint64(0)], self.hashes[:-1]])
        first = np.cumsum(self.counts) - self.counts
        before[first] = known[START]
        self.before, self.first = before, first

    def pairs(self, cut: int) -> np.ndarray:
        return coarse(pair_hashes(self.before, self.hashes), cut)


def count_blocks(docs: DataFrame, text: str, cut: int) -> DataFrame:
    """Counts of tokens and pairs: ``kind``, ``segment``, ``hashes``, ``counts``, one row for each segment."""
    rows = docs.select(F.col(text).cast("string").alias("text"))

    def blocks(kind: int, parts: list[np.ndarray]):
        hashes, counts = np.unique(np.concatenate(parts), return_counts=True)
        full, places = runs(hashes, cut)
        narrow = narrowed(hashes, kind, cut)
        counts = counts.astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(full), kind, np.int32)),
                pa.array(full.astype(np.int32)),
                pa.array([folded(narrow[i]) for i in places], pa.binary()),
                pa.array([counts[i].tobytes() for i in places], pa.binary()),
            ],
            names=["kind", "segment", "hashes", "counts"],
        )

    def work(batches):
        known, ones, twos, held = WordHashes(), [], [], 0
        for batch in batches:
            tokens = Tokens(texts_of(batch.column(0)), known)
            ones.append(tokens.hashes)
            twos.append(tokens.pairs(cut))
            held += len(tokens.hashes)
            if held >= FLUSH:
                yield blocks(ONE, ones)
                yield blocks(TWO, twos)
                ones, twos, held = [], [], 0
        if held:
            yield blocks(ONE, ones)
            yield blocks(TWO, twos)

    return map_text(rows, "kind int, segment int, hashes binary, counts binary", work, "text")


def merge_blocks(blocks: DataFrame, cut: int) -> DataFrame:
    """Counts of each segment summed: its n-grams with their levels (``entries``: sum, ``highest``: largest of these,
    ``received``: counted n-grams that met).

    Exact counts stay for single tokens only.
    """

    def work(key, part):
        kind, segment = (k.as_py() for k in key)
        hashes = widened([unfolded(x, kind) for x in part.column("hashes").to_pylist()], kind, segment, cut)
        received = len(hashes)
        counts = np.concatenate([np.frombuffer(x, np.int32) for x in part.column("counts").to_pylist()])
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order].astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        hashes, counts = hashes[begin], np.add.reduceat(counts, begin)
        exact = (hashes.view(np.int64), counts) if kind == ONE else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        level = levels(counts)
        return pa.table(
            {
                "kind": pa.array([kind], pa.int32()),
                "segment": pa.array([segment], pa.int32()),
                "hashes": lists(exact[0], [len(exact[0])], pa.int64()),
                "counts": lists(exact[1], [len(exact[1])], pa.int64()),
                "received": pa.array([received], pa.int64()),
                "narrow": pa.array([folded(narrowed(hashes, kind, cut))], pa.binary()),
                "exact": pa.array([planes(exact[1])], pa.binary()),
                "level": pa.array([level.astype(np.uint8).tobytes()], pa.binary()),
                "entries": pa.array([level.sum()], pa.int64()),
                "highest": pa.array([level.max()], pa.int32()),
            }
        )

    return blocks.groupBy("kind", "segment").applyInArrow(
        work,
        "kind int, segment int, hashes array<long>, counts array<long>, received long, narrow binary, exact binary, "
        "level binary, entries long, highest int",
    )


def filter_table(merged: DataFrame, bits: dict[int, int], cut: int) -> DataFrame:
    """The filter: ``kind``, ``segment``, ``field``, and beside it the ``tokens`` of a segment with their ``exact`` counts."""

    def work(key, part):
        kind, segment = (k.as_py() for k in key)
        narrow = part.column("narrow").to_pylist()
        hashes = widened([unfolded(x, kind) for x in narrow], kind, segment, cut)
        level = np.concatenate([np.frombuffer(x, np.uint8) for x in part.column("level").to_pylist()])
        return pa.table(
            {
                "kind": pa.array([kind], pa.int32()),
                "segment": pa.array([segment], pa.int32()),
                "field": pa.array([field_of(hashes, level, bits[kind] - cut)], pa.binary()),
                "tokens": pa.array([narrow[0] if kind == ONE else b""], pa.binary()),
                "exact": part.column("exact"),
            }
        )

    rows = merged.select("kind", "segment", "narrow", "level", "exact")  # one row for each segment
    schema = "kind int, segment int, field binary, tokens binary, exact binary"
    return rows.groupBy("kind", "segment").applyInArrow(work, schema)


def gather_field(fields: DataFrame, kind: int, bits: int, cut: int) -> np.ndarray:
    """The whole filter of a kind, which the caller has found small enough."""
    field = np.zeros(1 << bits - 3, np.uint8)
    size = 1 << bits - cut - 3
    for segment, part in fields.where(F.col("kind") == kind).select("segment", "field").toLocalIterator():
        field[segment * size : (segment + 1) * size] = np.frombuffer(part, np.uint8)
    return field


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) and counts of all tokens above a count that at most ``most`` tokens exceed."""
    size = F.floor(F.log2("count")).cast("int").alias("size")
    sizes = dict(counts.groupBy(size).agg(F.count("*")).collect())  # at most 63 rows
    total, least = 0, 63
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > most:
            break
        least = k
    head = counts.where(F.col("count") >= F.lit(2**least if least < 63 else (1 << 63) - 1)).toArrow()
    hashes = head.column("token").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], head.column("count").to_numpy()[order]


def batched(rows: DataFrame) -> DataFrame:
    """One row for each batch: ``batch`` (number), ``rows``, ``texts`` (compressed Arrow stream)."""

    def work(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts, sink = batch.select(["text"]), pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=TEXT_LEVEL))
            with pa.ipc.new_stream(sink, texts.schema, options=options) as out:
                out.write_batch(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0)),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                ],
                names=["batch", "rows", "texts"],
            )
            number += 1

    schema = T.StructType(
        [
            T.StructField("batch", T.LongType()),
            T.StructField("rows", T.ArrayType(rows.schema["row"].dataType)),
            T.StructField("texts", T.BinaryType()),
        ]
    )
    return rows.mapInArrow(lambda batches: work(small_batches(batches, 1)), schema)


def tokens_of(texts: bytes, known: WordHashes) -> Tokens:
    return Tokens(texts_of(pa.ipc.open_stream(texts).read_all().column("text").combine_chunks()), known)


def in_head(head: tuple[np.ndarray, np.ndarray], distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens are among the frequent ones, and their counts (0 for others)."""
    hashes, counts = head
    if not len(hashes):
        return np.zeros(len(distinct), bool), np.zeros(len(distinct), np.int64)
    place = np.minimum(np.searchsorted(hashes, distinct), len(hashes) - 1)
    held = hashes[place] == distinct
    return held, np.where(held, counts[place], 0)


def table_levels(batches: DataFrame, model: dict, kinds: list[int], sent) -> DataFrame:
    """Levels and exact counts of the distinct n-grams of each batch: ``batch``, ``kind``, ``segment``, ``level``, ``exact``.

    Levels come out of the filter's table for the given kinds; counts are those of tokens, of which only those that are
    not frequent are sent. The figures of a segment stand in the order of its hashes. Batches are dealt to slices, each of which asks a copy of
    the segment, so that a task's share is bounded however many texts there are to be scored.
    """
    bits, highest, cut = model["bits"], model["highest"], model["cut"]
    n = batches.count()
    slices = max(math.ceil(n / BATCHES), math.ceil(n * (BATCH_BYTES // 2) / (GROUP << cut)), 1)
    types = [("batch", pa.int64()), ("kind", pa.int32()), ("segment", pa.int32())]
    types += [("level", pa.binary()), ("exact", pa.binary())]
    empty = pa.schema(types).empty_table()

    def ask(parts):
        known = WordHashes()
        for part in parts:
            for number, texts in zip(part.column(0).to_pylist(), part.column(1)):
                tokens = tokens_of(texts.as_py(), known)
                for kind in (ONE, TWO):
                    own = tokens.hashes if kind == ONE else tokens.pairs(cut) if kind in kinds else tokens.hashes[:0]
                    hashes = np.unique(own)
                    if kind == ONE:
                        hashes = hashes[~in_head(sent.value["head"], hashes)[0]]
                    (full, places), narrow = runs(hashes, cut), narrowed(hashes, kind, cut)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(full), number, np.int64)),
                            pa.array(np.full(len(full), kind, np.int32)),
                            pa.array(full.astype(np.int32)),
                            pa.array([folded(narrow[i]) for i in places], pa.binary()),
                        ],
                        names=["batch", "kind", "segment", "hashes"],
                    )

    def answer(key, asked, part):
        kind, segment, _ = (k.as_py() for k in key)
        if not asked.num_rows:
            return empty
        parts = [unfolded(x, kind) for x in asked.column("hashes").to_pylist()]
        hashes = widened(parts, kind, segment, cut)
        level = np.zeros(len(hashes) if kind in kinds else 0, np.uint8)
        exact = np.zeros(len(hashes) if kind == ONE else 0, np.int64)
        if part.num_rows and kind == ONE:
            tokens = unfolded(part.column("tokens")[0].as_py(), ONE), from_planes(part.column("exact")[0].as_py(), np.int64)
            exact = in_head(tokens, hashes)[1]
        if part.num_rows and kind in kinds:
            field = np.frombuffer(part.column("field")[0].as_py(), np.uint8)
            level = probe(field, hashes, bits[kind], cut, highest[kind]).astype(np.uint8)
        ends = np.cumsum([len(x) for x in parts])[:-1]
        return pa.table(
            {
                **{x: asked.column(x) for x in ("batch", "kind", "segment")},
                "level": pa.array([x.tobytes() for x in np.split(level, ends)] if len(level) else [b""] * len(parts), pa.binary()),
                "exact": pa.array([planes(x) for x in np.split(exact, ends)] if len(exact) else [b""] * len(parts), pa.binary()),
            }
        )

    asked = batches.select("batch", "texts").mapInArrow(ask, "batch long, kind int, segment int, hashes binary")
    asked = asked.withColumn("slice", F.pmod(F.xxhash64("batch"), F.lit(slices)).cast("int"))
    fields = model["fields"].where(F.col("kind").isin([ONE, *kinds]))
    fields = fields.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return (
        asked.groupBy("kind", "segment", "slice")
        .cogroup(fields.groupBy("kind", "segment", "slice"))
        .applyInArrow(answer, "batch long, kind int, segment int, level binary, exact binary")
    )


def score_batch(row: pa.Array, tokens: Tokens, m: dict, level_of, exact_of=None) -> pa.RecordBatch:
    """level_of: levels of n-grams of a kind; exact_of: counts of tokens. Neither is asked for frequent tokens.

    With ``exact_of`` all tokens with a count are in ``n_head`` and ``base_head``, and no rest is left.
    """
    n = len(tokens.counts)
    distinct, back = np.unique(tokens.hashes, return_inverse=True)
    is_head, counts = in_head(m["head"], distinct)
    single_level = levels(np.maximum(counts, 1))
    single_level[~is_head] = level_of(ONE, distinct[~is_head])
    if exact_of:
        counts[~is_head] = exact_of()
        is_head = counts > 0
    log = np.where(is_head, np.log10(counts + 0.1), 0.0)
    of_head = is_head[back]
    base = np.bincount(tokens.owner, log[back], n)
    n_head = np.bincount(tokens.owner, of_head, n)
    # the rest: distinct tokens of each text with their number
    rest = np.flatnonzero(~of_head) if not exact_of else np.zeros(0, np.int64)
    order = rest[np.lexsort((back[rest], tokens.owner[rest]))]
    new = np.ones(len(order), bool)
    new[1:] = (tokens.owner[order][1:] != tokens.owner[order][:-1]) | (back[order][1:] != back[order][:-1])
    begin = np.flatnonzero(new)
    times = np.diff(np.concatenate([begin, [len(order)]]))
    each = np.bincount(tokens.owner[order[begin]], minlength=n)
    # the model
    one = middle(single_level)
    single = (one + 0.1) / m["mass"]
    pairs = middle(level_of(TWO, tokens.pairs(m["cut"])))
    seen = np.concatenate([[0.0], one[back][:-1]])
    seen[tokens.first] = m["texts"]
    trust = MOST_TRUST * seen / (seen + PRIOR)
    p = trust * np.minimum(pairs / np.maximum(seen, 1.0), 1.0) + (1 - trust) * single[back]
    score = np.bincount(tokens.owner, np.log10(np.minimum(p, 1.0)), n)
    return pa.RecordBatch.from_arrays(
        [
            row,
            pa.array(tokens.counts, pa.int64()),
            pa.array(n_head.astype(np.int64)),
            pa.array(base),
            pa.array(score),
            lists(distinct[back[order[begin]]].view(np.int64), each, pa.int64()),
            lists(times.astype(np.int32), each, pa.int32()),
        ],
        names=["row", "n_tokens", "n_head", "base_head", "score", "rest", "times"],
    )


def score_rows(docs: DataFrame, keep: list[str], text: str, model: dict) -> DataFrame:
    rows = docs.select(pack(keep), F.col(text).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast({k: v for k, v in model.items() if k != "fields"})
    schema = (
        "n_tokens long, n_head long, base_head double, score double, rest array<long>, times array<int>"
    )

    def level(kind: int, hashes: np.ndarray) -> np.ndarray:
        m = sent.value
        return probe(m["sent"][kind], hashes, m["bits"][kind], m["cut"], m["highest"][kind])

    def work(batches):
        known = WordHashes()
        for batch in batches:
            yield score_batch(batch.column(0), Tokens(texts_of(batch.column(1)), known), sent.value, level)

    def finish(batch, found):
        given, counts = {}, np.zeros(0, np.int64)
        for kind in (ONE, TWO):
            own = found.filter(pa.compute.equal(found.column("kind"), kind)).sort_by("segment")
            if kind in kinds:
                given[kind] = np.frombuffer(b"".join(own.column("level").to_pylist()), np.uint8).astype(np.int64)
            if kind == ONE:
                counts = np.concatenate([counts, *(from_planes(x, np.int64) for x in own.column("exact").to_pylist())])

        def level_of(kind, hashes):
            return given[kind][np.unique(hashes, return_inverse=True)[1]] if kind in given else level(kind, hashes)

        tokens = tokens_of(batch.column("texts")[0].as_py(), WordHashes())
        row = batch.column("rows").combine_chunks().flatten()
        return pa.Table.from_batches([score_batch(row, tokens, sent.value, level_of, lambda: counts)])

    kinds = [k for k in (ONE, TWO) if k not in model["sent"]]
    if not kinds:
        return map_text(rows, schema, work, "text")
    batches = staged(batched(rows), "score-batches")
    found = table_levels(batches, model, kinds, sent)
    row = T.StructField("row", batches.schema["rows"].dataType.elementType)  # columns may be null once written
    return (
        batches.groupBy("batch")
        .cogroup(found.groupBy("batch"))
        .applyInArrow(finish, T.StructType([row, *T.StructType.fromDDL(schema).fields]))
    )


def train(
    docs: DataFrame,
    text: str = "text",
    one_bits: int | None = None,
    two_bits: int | None = None,
    head: int = HEAD,
    most_bits: int = MOST_BITS,
):
    """The model of all given texts, and the table of exact token counts (``token``, ``count``).

    The filter's size (log2 of the bits for tokens and for pairs) follows the counts unless it is given.
    """
    size, texts = docs.agg(F.sum(F.octet_length(F.col(text).cast("string"))), F.count(F.lit(1))).first()
    cut = segment_bits_for(size or 0, texts)
    merged = staged(merge_blocks(count_blocks(docs, text, cut), cut), "n-gram-counts")
    sums = {k: x for k, *x in merged.groupBy("kind").agg(F.sum("entries"), F.max("highest")).collect()}
    entries, highest = ({k: sums.get(k, (0, 0))[i] for k in (ONE, TWO)} for i in (0, 1))
    bits = {ONE: one_bits or bits_for(entries[ONE], cut), TWO: two_bits or bits_for(entries[TWO], cut)}
    fields = staged(filter_table(merged, bits, cut), "n-gram-filter")
    counts = (
        merged.where(F.col("kind") == ONE)
        .select(F.explode(F.arrays_zip("hashes", "counts")).alias("x"))
        .select(F.col("x.hashes").alias("token"), F.col("x.counts").alias("count"))
    )
    total, distinct = counts.agg(F.sum("count"), F.count("*")).first()
    total = total or 0
    model = {
        "fields": fields,
        "sent": {k: gather_field(fields, k, bits[k], cut) for k in (ONE, TWO) if bits[k] <= most_bits},
        "bits": bits,
        "cut": cut,
        "largest": merged.agg(F.max("received")).first()[0] or 0,
        "highest": highest,
        "entries": entries,
        "head": frequent(counts, head),
        "tokens": total,
        "mass": total + 0.1 * (distinct + 1),
        "texts": texts,
    }
    return model, counts


def score_texts(docs: DataFrame, model: dict, counts: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``row`` (struct of ``keep``), n_tokens, n_known, train_tokens, base_score and score of each row.

    A null or empty text is scored as its end alone. Repeated rows are scored each. By the formula of the
    base score a model of no texts gives every token the probability one. An empty table gives an empty result.
    """
    scored = score_rows(docs, keep, text, model)
    if set(model["sent"]) != {ONE, TWO}:  # the segments have given all counts
        return finished(scored.withColumns({"n": F.lit(0), "log": F.lit(0.0)}), model)
    scored = staged(scored.withColumn("owner", F.monotonically_increasing_id()), "head-scores")
    rest = scored.select("owner", F.explode(F.arrays_zip("rest", "times")).alias("x")).select(
        "owner", F.col("x.rest").alias("token"), F.col("x.times").alias("times")
    )
    found = (
        rest.join(counts, "token")
        .groupBy("owner")
        .agg(F.sum("times").alias("n"), F.sum(F.col("times") * F.log10(F.col("count") + 0.1)).alias("log"))
    )
    return finished(scored.join(found, "owner", "left"), model)


def finished(scored: DataFrame, model: dict) -> DataFrame:
    """Base scores out of the parts of frequent tokens and of all others (``n``, ``log``)."""
    n_known = (F.col("n_head") + F.coalesce("n", F.lit(0))).cast("long")
    base = (
        F.col("base_head")
        + F.coalesce("log", F.lit(0.0))
        + (F.col("n_tokens") - n_known) * math.log10(0.1)
        - F.col("n_tokens") * math.log10(model["mass"])
    )
    return scored.select(
        "row",
        "n_tokens",
        n_known.alias("n_known"),
        F.lit(model["tokens"]).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )


def held_out(key: str, folds: int):
    """Rows whose CRC-32 of the key as text leaves no remainder; null keys are never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))


@query("op3_lm_scoring")
def op3_lm_scoring(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = docs.withColumn("held_out", held_out("doc_id", 10))
    model, counts = train(out.where("NOT held_out"))
    scored = score_texts(out, model, counts, ["doc_id", "held_out"])
    return scored.select("row.doc_id", "row.held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")

"""Near-duplicate documents by SimHash, found in Burkhard-Keller trees.

Two fingerprints of 64 bits that differ in at most three agree in at least one of four blocks of 16 bits, so each
distinct fingerprint goes to four shards, one for each (block, value). A shard's fingerprints stand in a tree whose
children are keyed by their Hamming distance to the parent; a search follows only the edges whose distance differs by
at most the radius from that of the node. A shard that grows beyond its bound is divided once more by the bits that
are left, and what is still too large is dealt into several trees, each of them asked by all of the shard.

The trees of all shards together grow with the corpus, so they are dealt to the tasks by a shuffle, not broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import blank_words, keyed, map_text, pack, staged, texts_of, with_verdicts
from arrears.llm.registry import query, table

SEED = 42
RADIUS = 3
SHINGLE = 3
SHARD_MOST = 512  # fingerprints of one tree
FOREST_ROWS = 16_384  # fingerprints whose trees are searched side by side
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(words: list[bytes], width: int, seed: int) -> list[int]:
    """XXH64 of the space-joined shingles; of all words if they are fewer; none without words."""
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, seed)] if words else []
    ends, at = [], -1
    for w in words:
        at += 1 + len(w)
        ends.append(at)
    begins = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip(begins, ends[width - 1 :])]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of hashes the bits set in over half of them; zero for an empty run.

    Bits are counted eight at a time in the bytes of a 64-bit number, over at most 255 hashes.
    """
    out = np.zeros(len(counts), np.uint64)
    if not len(hashes):
        return out
    parts = -(-counts // 255)
    owner = np.repeat(np.arange(len(counts)), parts)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = (np.cumsum(counts) - counts)[owner] + rank * 255
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & LANES, begin)
        for byte in range(8):
            ones = np.zeros(len(counts), np.int64)
            np.add.at(ones, owner, ((lanes >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64))
            out |= (2 * ones > counts).astype(np.uint64) << np.uint64(8 * byte + k)
    return out


def fingerprints(docs: DataFrame, keep: list[str], text: str, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``row`` (struct of ``keep``) and ``fp`` for each row. Null is an empty text; a text without words has 0."""
    rows = docs.select(pack(keep), F.col(text).cast("string").alias("text"))

    def work(batches):
        for batch in batches:
            hashes, counts = [], []
            for t in texts_of(batch.column(1)):
                found = np.array(shingle_hashes(blank_words(t.lower()), width, seed), np.uint64)
                hashes.append(found)
                counts.append(len(found))
            got = majority(np.concatenate(hashes), np.array(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got.view(np.int64))], names=["row", "fp"])

    return map_text(rows, "fp long", work, "text")


class Forest:
    """One tree for each group of distinct fingerprints, built and searched level by level."""

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        self.fp = fp
        groups, self.root = np.unique(group, return_index=True)
        self.groups = groups
        at = self.root[np.searchsorted(groups, group)]
        left = np.flatnonzero(at != np.arange(len(fp)))
        at = at[left]
        keys, children = [], []
        while len(left):
            edge = at.astype(np.int64) * 65 + np.bitwise_count(fp[left] ^ fp[at])
            new, first, back = np.unique(edge, return_index=True, return_inverse=True)
            keys.append(new)
            children.append(left[first])
            at = left[first][back]
            stay = at != left
            left, at = left[stay], at[stay]
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(self.keys)
        self.keys = self.keys[order]
        self.children = np.concatenate(children)[order] if keys else np.zeros(0, np.int64)

    def search(self, group: np.ndarray, fp: np.ndarray, radius: int):
        """Pairs (query, node) within the radius, one level of the trees at a time."""
        place = np.minimum(np.searchsorted(self.groups, group), len(self.groups) - 1)
        asked = np.flatnonzero(self.groups[place] == group) if len(self.groups) else np.zeros(0, np.int64)
        node = self.root[place[asked]]
        while len(asked):
            distance = np.bitwise_count(fp[asked] ^ self.fp[node]).astype(np.int64)
            near = distance <= radius
            yield asked[near], node[near]
            base = node.astype(np.int64) * 65
            low = np.searchsorted(self.keys, base + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.keys, base + np.minimum(distance + radius, 64), side="right")
            size = high - low
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            node = self.children[np.repeat(low, size) + step]
            asked = np.repeat(asked, size)


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest number reachable through the pairs, going on from the labels so far."""
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label
        label = label.copy()
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label


def forest_links(batch_rows: tuple[np.ndarray, np.ndarray, np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the trees connect: each fingerprint with the first of its part."""
    key, fp, role = batch_rows
    nodes, asks = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    forest = Forest(key[nodes], fp[nodes])
    label = np.arange(len(fp))
    for q, n in forest.search(key[asks], fp[asks], radius):
        apart = asks[q] != nodes[n]
        label = join_labels(label, asks[q][apart], nodes[n][apart])
    moved = np.flatnonzero((label != np.arange(len(fp))) & (fp != fp[label]))
    return fp[moved], fp[label[moved]]



def shards(distinct: DataFrame, most: int) -> DataFrame:
    """``key``, ``fp`` and ``role`` (1: stands in the tree, 2: asks it, 3: both)."""
    cut = lambda width, low: F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
    wide = distinct.select(
        "fp", F.posexplode(F.array(*[cut(16, 16 * b) for b in range(4)])).alias("block", "value")
    )
    sized = wide.join(wide.groupBy("block", "value").agg(F.count("*").alias("n")), ["block", "value"])
    small = sized.where(F.col("n") <= most).select(
        F.xxhash64("block", "value").alias("key"), "fp", F.lit(3).alias("role")
    )
    # the 48 bits left: the three other blocks, side by side, in four parts of 12
    rest = F.lit(0).cast("long")
    for b in range(4):
        taken = F.when(F.col("block") == b, rest).otherwise(F.shiftleft(rest, 16).bitwiseOR(cut(16, 16 * b)))
        rest = taken
    fine = (
        sized.where(F.col("n") > most)
        .select("block", "value", "fp", rest.alias("rest"))
        .select(
            "block",
            "value",
            "fp",
            F.posexplode(
                F.array(*[F.shiftrightunsigned("rest", 12 * p).bitwiseAND(F.lit(4095)) for p in range(4)])
            ).alias("part", "bits"),
        )
    )
    named = ["block", "value", "part", "bits"]
    counted = fine.join(fine.groupBy(*named).agg(F.count("*").alias("n")), named)
    trees = F.ceil(F.col("n") / most).cast("int")
    own = F.pmod(F.xxhash64("fp"), trees.cast("long")).cast("int")
    spread = counted.withColumn("own", own).select(
        *named, "fp", "own", F.explode(F.sequence(F.lit(0), trees - 1)).alias("tree")
    )
    large = spread.select(
        F.xxhash64(*named, "tree").alias("key"), "fp", F.when(F.col("tree") == F.col("own"), 3).otherwise(2).alias("role")
    )
    return small.unionByName(large)


def links(distinct: DataFrame, radius: int = RADIUS, most: int = SHARD_MOST) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints that connect all those within the radius of each other."""
    if radius > 3:
        raise ValueError("four blocks find up to three differing bits")

    def work(batches):
        held, rows = [], 0

        def flush(parts):
            columns = tuple(np.concatenate([p[i] for p in parts]) for i in range(3))
            a, b = forest_links((columns[0], columns[1].view(np.uint64), columns[2]), radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        for batch in batches:
            part = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            held.append(part)
            rows += len(part[0])
            if rows >= FOREST_ROWS:  # all but the last group, which may go on
                whole = tuple(np.concatenate([p[i] for p in held]) for i in range(3))
                cut = int(np.searchsorted(whole[0], whole[0][-1]))
                if cut:
                    yield flush([tuple(c[:cut] for c in whole)])
                held, rows = [tuple(c[cut:] for c in whole)], len(whole[0]) - cut
        if rows:
            yield flush(held)

    dealt = shards(distinct, most).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(work, "a long, b long").distinct()


def components(pairs: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``part`` (the smallest node it is connected with) for every node of the links (``a``, ``b``).

    Each round takes the smallest label among a node's neighbours and then the label of that label, so labels travel
    twice as far from round to round; rounds go on until nothing changes. Each is written, which cuts the lineage.
    """
    edges = staged(
        pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a"))).where("a != b").distinct(), f"{name}-links"
    )
    labels = staged(edges.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("part")
    ), f"{name}-labels", rows := edges.count())
    while True:
        near = (
            edges.join(labels, edges.b == labels.node)
            .groupBy("a")
            .agg(F.min("part").alias("m"))
            .select(F.col("a").alias("node"), "m")
        )
        hooked = labels.join(near, "node").select(
            "node", F.col("part").alias("old"), F.least("part", "m").alias("part")
        )
        hooked = staged(hooked, f"{name}-hooked", rows)
        of = hooked.select(F.col("node").alias("part"), F.col("part").alias("next"))
        jumped = hooked.join(of, "part").select("node", "old", F.col("next").alias("part"))
        after = staged(jumped, f"{name}-labels", rows)
        if not after.where("old != part").limit(1).count():
            return after.select("node", "part")
        labels = after.select("node", "part")


def near_duplicates(
    docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """Fingerprint and component of each row.

    ``row`` (struct of ``keep``, with the key), ``fingerprint`` (16 hex digits), ``component_id`` (smallest key
    reachable through fingerprints that differ in at most ``radius`` bits) and ``first`` (true for one row of each
    component: the smallest key, the earliest of repeated rows). Rows with null keys take part but name a component
    only with null, where nothing else is in it. Null and empty texts have fingerprint zero and link like any other.
    """
    marked = staged(
        fingerprints(docs, keep, text).withColumn("owner", F.monotonically_increasing_id()), "fingerprints"
    )
    best = F.struct(F.col(f"row.{key}").isNull().alias("none"), F.col(f"row.{key}").alias("id"), "owner")
    distinct = staged(marked.groupBy("fp").agg(F.min(best).alias("best")), "distinct-fingerprints", marked.count())
    parts = components(links(distinct.select("fp"), radius))
    placed = distinct.join(parts, distinct.fp == parts.node, "left").select(
        "fp", "best", F.coalesce("part", "fp").alias("part")
    )
    named = placed.join(placed.groupBy("part").agg(F.min("best").alias("top")), "part").select("fp", "top")
    return marked.join(named, "fp").select(
        "row",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("top.id").alias("component_id"),
        (F.col("owner") == F.col("top.owner")).alias("first"),
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, unchanged: the one with the smallest key, and one row of it."""
    rows = keyed(docs, key, text)
    plain = rows.select("id", "mark", F.col("row")[text].alias("text"))
    first = near_duplicates(plain, ["id", "mark"], "id", "text").where("first").select("row.id", "row.mark")
    return with_verdicts(rows, first).dropDuplicates(["id", "mark"]).select("row.*")


@query("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark, folder):
    found = near_duplicates(table(spark, folder, "documents"), ["doc_id"])
    return found.select("row.doc_id", "fingerprint", "component_id")

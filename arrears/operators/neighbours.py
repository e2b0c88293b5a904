"""Exact nearest neighbours of encoded rows: a few numbers and a set of indicator slots.

The squared distance of two rows is that of their numbers plus the number of slots only one of them has set. Rows with
the same slots form a pattern. Inside a pattern rows are sorted by their numbers and cut into bands of bounded size; a
tree of boxes stands over the bands. A search visits the own pattern first, then those that differ in one slot, in two,
and so on. It ends when even equal numbers could not make the next patterns near enough. Box distances keep the search
from bands that cannot hold a neighbour.

All steps are joins on band and node numbers; what meets in a task is two bands. Nothing but the number of heights and
levels reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrears.sources.tables import stage

BAND = 256  # rows of a band
FAN = 64  # children of a box
SLACK = 1e-9  # box distances are summed in another order than distances


def _gap(dims: int) -> Column:
    """Squared distance between the boxes of the asking rows and of a node."""
    total = F.lit(0.0)
    for i in range(dims):
        apart = F.greatest(F.col("ask_lo")[i] - F.col("hi")[i], F.col("lo")[i] - F.col("ask_hi")[i], F.lit(0.0))
        total = total + apart * apart
    return total


def _box(dims: int, lo: str, hi: str) -> list[Column]:
    """Smallest and largest number of each dimension, over rows (lo and hi the same) or boxes."""
    none = F.array().cast("array<double>")
    least = F.array(*[F.min(F.col(lo)[i]) for i in range(dims)]) if dims else none
    most = F.array(*[F.max(F.col(hi)[i]) for i in range(dims)]) if dims else none
    return [least.alias("lo"), most.alias("hi")]


class _Bands:
    """The rows in bands, and the boxes over them. A node's number is the place of its first row."""

    def __init__(self, vectors: DataFrame, size: int):
        self.size = size
        ordered = vectors.repartitionByRange("slots", "x").sortWithinPartitions("slots", "x")
        ordered = stage(ordered.withColumn("at", F.monotonically_increasing_id()), "neighbour-order")
        first = ordered.select(F.size("x")).first()
        self.dims = first[0] if first else 0
        # rows of a pattern in one partition of the sort: a run; its places follow each other
        ordered = ordered.withColumn("part", F.shiftright("at", 33))
        run = F.min("at").over(W.partitionBy("part", "slots"))
        placed = ordered.withColumn("run", run).withColumn("band", F.col("at") - (F.col("at") - F.col("run")) % size)
        members = F.collect_list(F.struct("vid", "x", "times", "asks")).alias("members")
        self.bands = stage(
            placed.groupBy("run", "slots", "band").agg(members, *_box(self.dims, "x", "x")), "neighbour-bands"
        )
        facts = self.bands.agg(
            F.max(F.col("band") - F.col("run")), F.max(F.size("slots")), F.min(F.size("slots")),
            F.count("*"), F.count_distinct("slots"),
        ).first()
        self.longest, self.shortest = facts[1] or 0, facts[2] or 0
        self.single = facts[3] == facts[4]  # each pattern is one band
        self.top = 0
        while facts[0] is not None and size * FAN**self.top <= facts[0]:
            self.top += 1
        self.runs = self.bands.where("band = run").select("run", "slots")

    def nodes(self, height: int) -> DataFrame:
        if height == 0:
            return self.bands.select("run", F.col("band").alias("node"), "lo", "hi")
        width = self.size * FAN**height
        node = (F.col("band") - (F.col("band") - F.col("run")) % width).alias("node")
        return self.bands.groupBy("run", node).agg(*_box(self.dims, "lo", "hi"))

    def descend(self, visits: DataFrame, asks: DataFrame, nearest_only: bool) -> DataFrame:
        """From (band, run, cost) to the bands below the run that may hold a neighbour: (band, node, cost).

        With ``nearest_only`` one band for each run: follow the nearest box.
        """
        boxes = asks.select("band", "ask_lo", "ask_hi", "reach")
        at = visits.select("band", "run", "cost", F.col("run").alias("node")).join(boxes, "band")
        for height in range(self.top, -1, -1):
            if height < self.top:
                width = self.size * FAN**height
                below = F.sequence(F.col("node"), F.col("node") + (FAN - 1) * width, F.lit(width).cast("long"))
                at = at.select("band", "run", "cost", "ask_lo", "ask_hi", "reach", F.explode(below).alias("node"))
            at = at.join(self.nodes(height), ["run", "node"]).withColumn("far", F.col("cost") + _gap(self.dims))
            if nearest_only:
                near = F.min_by(F.struct("node", "cost", "ask_lo", "ask_hi", "reach"), F.struct("far", "node"))
                at = at.groupBy("band", "run").agg(near.alias("n")).select("band", "run", "n.*")
            else:
                at = at.where(F.col("far") <= F.col("reach") * (1 + SLACK) + SLACK).drop("far")
        return at.select("band", "node", "cost")


def _subsets(patterns: DataFrame, level: int) -> DataFrame:
    """(slots, part): each pattern without up to ``level`` of its slots."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slots in batch.column(0).to_pylist():
                parts = [
                    ",".join(map(str, kept))
                    for gone in range(min(level, len(slots)) + 1)
                    for kept in combinations(slots, len(slots) - gone)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([slots] * len(parts), pa.list_(pa.int32())), pa.array(parts)], names=["slots", "part"]
                )

    return patterns.mapInArrow(work, "slots array<int>, part string")


def _patterns_apart(asking: DataFrame, patterns: DataFrame, level: int) -> DataFrame:
    """(slots, other, cost): patterns where the larger one has ``level`` slots that the other one lacks."""
    other = _subsets(patterns, level).select(F.col("slots").alias("other"), "part")
    both = _subsets(asking, level).join(other, "part")
    shared = F.size(F.array_intersect("slots", "other"))
    apart = F.greatest(F.size("slots"), F.size("other")) - shared
    cost = (F.size("slots") + F.size("other") - 2 * shared).cast("double")
    return both.where(apart == level).select("slots", "other", cost.alias("cost"))


def _members(column: pa.Array, dims: int) -> tuple[np.ndarray, list[pa.Array], np.ndarray]:
    """Offsets, the fields and the numbers (a matrix) of a column of lists of (vid, x, ..)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy())])
    fields = column.flatten().flatten()
    x = fields[1].flatten().to_numpy(zero_copy_only=False).reshape(len(fields[0]), dims)
    return offsets, fields, x


def _compare(k: int, dims: int):
    """The ``k`` nearest of each asking row among the rows of one band."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ask_at, ask, ask_x = _members(batch.column("ask"), dims)
            own_at, own, own_x = _members(batch.column("members"), dims)
            reach = ask[2].to_numpy(zero_copy_only=False)
            ask_id, own_id = np.array(ask[0].to_pylist()), np.array(own[0].to_pylist())
            same = (pc.equal(batch.column("band"), batch.column("node"))).to_numpy(zero_copy_only=False)
            cost = batch.column("cost").to_numpy()
            rows, cols, far = [], [], []
            for i in range(batch.num_rows):
                a, b, c, d = ask_at[i], ask_at[i + 1], own_at[i], own_at[i + 1]
                d2 = np.zeros((b - a, d - c))
                for dim in range(dims):
                    step = ask_x[a:b, dim][:, None] - own_x[c:d, dim][None, :]
                    d2 += step * step
                d2 += cost[i]
                if same[i]:
                    d2[ask_id[a:b][:, None] == own_id[c:d][None, :]] = np.nan
                row, col = np.nonzero(d2 <= reach[a:b][:, None])
                if not len(row):
                    continue
                value = d2[row, col]
                order = np.lexsort((own_id[c:d][col], value, row))
                row, col, value = row[order], col[order], value[order]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < k
                rows.append(row[keep] + a)
                cols.append(col[keep] + c)
                far.append(value[keep])
            if rows:
                at, to = pa.array(np.concatenate(rows)), pa.array(np.concatenate(cols))
                yield pa.RecordBatch.from_arrays(
                    [ask[0].take(at), pa.array(np.concatenate(far)), own[0].take(to), own[2].take(to)],
                    names=["vid", "d2", "nn", "nn_times"],
                )

    return work


def nearest(vectors: DataFrame, k: int, asks: Column | None = None, band: int = BAND) -> DataFrame:
    """(vid, nn, nn_x, nn_slots, nn_times, d2, place): the ``k`` nearest other rows of each asking one.

    ``vectors`` has (vid, x, times) and may have ``slots`` (sorted numbers of the slots that are set); its pairs
    (x, slots) are distinct. ``asks`` says which rows are asked for, all by default. Equal distances are ordered by
    ``nn``. Fewer than ``k`` rows come back where there are no more; an empty table gives an empty result.
    """
    if "slots" not in vectors.columns:
        vectors = vectors.withColumn("slots", F.array().cast("array<int>"))
    kind = dict(vectors.dtypes)["vid"]
    marked = vectors.select("vid", "x", "slots", "times", (F.lit(True) if asks is None else asks).alias("asks"))
    index = _Bands(marked, band)
    asking = index.bands.select("band", "slots", F.explode("members").alias("m")).where("m.asks")
    asking = asking.select("band", "slots", "m.vid", "m.x")
    unit = 2.0 if index.longest == index.shortest else 1.0  # least cost of a further level
    schema = f"vid {kind}, d2 double, nn {kind}, nn_times bigint"
    best: DataFrame | None = None  # (vid, near)

    def questions(level: int) -> DataFrame:
        """The rows that may still find nearer ones at this level, by band."""
        known = asking if best is None else asking.join(best, "vid", "left")
        found = F.lit(None) if best is None else F.when(F.size("near") >= k, F.col("near")[k - 1]["d2"])
        open_rows = known.withColumn("reach", F.coalesce(found, F.lit(float("inf"))))
        open_rows = open_rows.where(F.col("reach") * (1 + SLACK) + SLACK >= unit * level)
        lo, hi = _box(index.dims, "x", "x")
        grouped = open_rows.groupBy("band", "slots").agg(
            F.collect_list(F.struct("vid", "x", "reach")).alias("ask"),
            lo.alias("ask_lo"), hi.alias("ask_hi"), F.max("reach").alias("reach"),
        )
        return stage(grouped, "neighbour-asks")

    def take(pairs: DataFrame, asked: DataFrame) -> None:
        nonlocal best
        wide = pairs.join(asked.select("band", "ask"), "band").join(
            index.bands.select(F.col("band").alias("node"), "members"), "node"
        )
        found = wide.select("band", "node", "cost", "ask", "members").mapInArrow(_compare(k, index.dims), schema)
        if best is not None:
            found = found.unionByName(best.select("vid", F.explode("near").alias("n")).select("vid", "n.*"))
        near = F.slice(F.array_sort(F.collect_set(F.struct("d2", "nn", "nn_times"))), 1, k)
        best = stage(found.groupBy("vid").agg(near.alias("near")), "neighbour-best")

    for level in range(index.longest + 1):
        asked = questions(level)
        if asked.isEmpty():
            break
        if level == 0:
            take(asked.select("band", F.col("band").alias("node"), F.lit(0.0).alias("cost")), asked)
            if index.single:
                continue
            asked = questions(0)
            visits = asked.select("band", "slots").join(index.runs, "slots").withColumn("cost", F.lit(0.0))
        else:
            apart = _patterns_apart(asked.select("slots").distinct(), index.runs.select("slots").distinct(), level)
            visits = asked.select("band", "slots").join(apart, "slots")
            visits = visits.join(index.runs.withColumnRenamed("slots", "other"), "other").select("band", "run", "cost")
            visits = stage(visits, "neighbour-visits")
            endless = asked.where(F.col("reach") == float("inf")).select("band")
            if not index.single and not endless.isEmpty():
                take(index.descend(visits.join(endless, "band", "left_semi"), asked, True), asked)
                asked = questions(level)
        pairs = index.descend(visits, asked, False)
        take(pairs.where("band <> node") if level == 0 else pairs, asked)

    if best is None:
        best = vectors.sparkSession.createDataFrame([], f"vid {kind}, near array<struct<d2:double,nn:{kind},nn_times:bigint>>")
    rows = best.select("vid", F.posexplode("near").alias("place", "n"))
    rows = rows.select("vid", "n.nn", "n.nn_times", "n.d2", (F.col("place") + 1).alias("place"))
    far = vectors.select(F.col("vid").alias("nn"), F.col("x").alias("nn_x"), F.col("slots").alias("nn_slots"))
    return rows.join(far, "nn").select("vid", "nn", "nn_x", "nn_slots", "nn_times", "d2", "place")

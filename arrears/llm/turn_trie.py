"""The prefix trie of conversations: which beginnings they share, and what sharing them saves.

Turns become numbers of a dictionary. Distinct sequences of numbers are sorted into ranges, and every block of a range
becomes a ternary search tree: sequences are inserted from the median outwards, so siblings hang in balanced order. One
iterative traversal sums up members, leaves and savings.

A prefix can reach over several blocks only if it begins the first or the last sequence of a block. Such nodes are
merged: each block says what it has below them, sums are added up, and two things are set right. A node that began in
an earlier block was counted as new again by the later one; and the last sequence of a block may go on in the next one,
so that it is no leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import staged
from arrears.llm.crc_sql import crc32
from arrears.llm.registry import query, table

BORROWED = 6  # a conversation takes over fewer turns than this
FAMILY = 100  # conversations of one family take over the turns of its first one
MOST_FREQUENT = 4096  # at most so many turns are looked up by broadcast
BLOCK_TURNS = 65_536  # a tree holds so many turns, or one sequence
PIECE = 1 << 20  # bytes of member lists that travel as one row
NOTHING = hashlib.sha256(b"").hexdigest()


def encoded(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv``, ``turn``, ``mark`` (MD5 of role and text), ``id`` (number in the dictionary), ``chars``.

    The most frequent turns, of which there are at most ``MOST_FREQUENT``, are looked up by broadcast, so that no task
    gets all rows with one turn; all others are joined.
    """
    who = F.coalesce(F.col(role).cast("string"), F.lit(""))
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.unhex(F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said))).alias("mark"),
        F.length(said).cast("long").alias("chars"),
    )
    rows = staged(rows, "trie-turns")
    known = rows.groupBy("mark").agg(F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id())
    known = staged(known, "trie-dictionary")
    often = F.col("n") > F.lit(max(1000, rows.count() // MOST_FREQUENT))
    marked = rows.join(F.broadcast(known.where(often).select("mark", "id")), "mark", "left")
    rest = marked.where(F.col("id").isNull()).drop("id").join(known.where(~often).select("mark", "id"), "mark")
    return marked.where(F.col("id").isNotNull()).unionByName(rest)


def conversations(turns: DataFrame, conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """``conv``, ``steps`` (array of id and chars): one row for each conversation, turns in order.

    Null turn numbers come first; turns with equal numbers are ordered by the hash of role and text. Null roles and
    texts are empty. Rows without a conversation are left out. A repeated row is a turn of its own. One conversation,
    as numbers, must fit a task.
    """
    grouped = encoded(turns, conv, turn, role, text).groupBy("conv")
    steps = F.sort_array(F.collect_list(F.struct("turn", "mark", "id", "chars")))
    return grouped.agg(F.transform(steps, lambda s: F.struct(s["id"].alias("id"), s["chars"].alias("chars"))).alias("steps"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % 100; h = crc32(c) % 6."""
    convs = staged(convs, "trie-conversations")
    taken = (F.crc32(F.col("conv").cast("string")) % BORROWED).cast("int")
    heads = convs.where(F.col("conv") % FAMILY == 0).select(
        F.col("conv").alias("base"), F.slice("steps", 1, BORROWED - 1).alias("head")
    )
    both = convs.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.slice("steps", 1, 0)), F.lit(1), taken)
    return both.select("conv", F.concat(head, F.slice("steps", taken + 1, F.size("steps"))).alias("steps"))


class Tree:
    """A ternary search tree: ``low`` and ``high`` lead to siblings, ``down`` to the children. Node 0 is the root."""

    def __init__(self):
        self.key, self.chars = [0], [0]
        self.low, self.high, self.down = [-1], [-1], [-1]
        self.ends: dict[int, tuple[int, int, bytes]] = {}  # node -> conversations that end there, smallest, mark

    def _new(self, key: int, chars: int) -> int:
        self.key.append(key)
        self.chars.append(chars)
        for links in (self.low, self.high, self.down):
            links.append(-1)
        return len(self.key) - 1

    def insert(self, ids: list[int], chars: list[int], end: tuple[int, int, bytes]) -> None:
        key, low, high, down = self.key, self.low, self.high, self.down
        node = 0
        for x, c in zip(ids, chars):
            links, at = down, node
            while (t := links[at]) >= 0 and key[t] != x:
                links, at = (low if x < key[t] else high), t
            if t < 0:
                t = self._new(x, c)
                links[at] = t
            node = t
        self.ends[node] = end

    def path(self, ids: list[int]) -> list[int]:
        """The nodes of an inserted sequence, the root first."""
        nodes = [0]
        for x in ids:
            t = self.down[nodes[-1]]
            while self.key[t] != x:
                t = self.low[t] if x < self.key[t] else self.high[t]
            nodes.append(t)
        return nodes

    def order(self) -> list[tuple[int, int, int]]:
        """(node, parent, depth), parents before their children."""
        out, stack = [(0, -1, 0)], [(self.down[0], 0, 1)]
        while stack:
            t, parent, depth = stack.pop()
            if t < 0:
                continue
            out.append((t, parent, depth))
            stack += ((self.low[t], parent, depth), (self.high[t], parent, depth), (self.down[t], t, depth + 1))
        return out


def median_first(n: int) -> Iterator[int]:
    """0 to n - 1, the median before the medians of both halves."""
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            m = (a + b) // 2
            yield m
            stack += ((a, m), (m + 1, b))


NODES = (
    "block long, node binary, parent binary, depth long, conv long, parent_conv long, n long, chars long, children long, "
    "leaves long, saved long, ends binary, first boolean, last boolean, end_of_block boolean"
)


def nodes_of(block: int, rows: list[tuple]) -> Iterator[tuple]:
    """Rows of ``NODES`` for sorted distinct sequences (ids, chars, n, conv, mark).

    Nodes that may reach over other blocks have a mark, ``node``; what they say holds for this block. Others are
    complete, but for the smallest conversation of a parent that has a mark.
    """
    tree = Tree()
    for k in median_first(len(rows)):
        ids, chars, n, conv, mark = rows[k]
        tree.insert(ids, chars, (n, conv, mark))
    order = tree.order()
    size = len(tree.key)
    members, smallest = [0] * size, [None] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for node, (n, conv, _) in tree.ends.items():
        members[node], smallest[node] = n, conv
    for t, p, _ in reversed(order):
        saved[t] += (members[t] - 1) * tree.chars[t]
        leaves[t] = leaves[t] or 1
        if p >= 0:
            members[p] += members[t]
            smallest[p] = smallest[t] if smallest[p] is None else min(smallest[p], smallest[t])
            leaves[p] += leaves[t]
            saved[p] += saved[t]
    marks: dict[int, bytes] = {}
    first, last = tree.path(rows[0][0]), tree.path(rows[-1][0])
    for path in (first, last):
        mark = b""
        for t in path:
            mark = hashlib.md5(mark + tree.key[t].to_bytes(8, "big"), usedforsecurity=False).digest()
            marks[t] = mark
    on_first, on_last = set(first), set(last)
    for t, p, _ in order:
        if p >= 0 and (t not in marks or p not in marks):
            children[p] += 1
    for t, p, depth in order:
        yield (
            block, marks.get(t), marks.get(p), depth, smallest[t], smallest[p] if p >= 0 else None, members[t],
            tree.chars[t], children[t], leaves[t], saved[t], tree.ends[t][2] if t in tree.ends else None,
            t in on_first, t in on_last, t == last[-1],
        )


def build(batches: Iterator[pa.RecordBatch], block_turns: int) -> Iterator[pa.RecordBatch]:
    """Trees over blocks of the sorted sequences of a range; a block has at most ``block_turns``, or one sequence."""
    schema = pa.schema(
        [(x.split()[0], {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[x.split()[1]]) for x in NODES.split(", ")]
    )
    number, rows, turns = TaskContext.get().partitionId() << 32, [], 0

    def out():
        columns = list(zip(*nodes_of(number, rows)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if rows and turns + len(row[0]) > block_turns:
                yield out()
                number, rows, turns = number + 1, [], 0
            rows.append(row)
            turns += len(row[0]) + 1
    if rows:
        yield out()


def member_lists(rows: DataFrame) -> DataFrame:
    """``ends``, ``ends_sha256``: SHA-256 of the sorted, comma-joined conversations of each ``ends``.

    Ranges of (ends, conv) are joined to pieces of at most ``PIECE`` bytes in many tasks; as a hash reads its input in
    order, one task passes the pieces of one list through it, without holding them.
    """

    def pieces(batches):
        mark, parts, size, first = None, [], 0, None

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([mark], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(parts)], pa.string())],
                names=["ends", "conv", "piece"],
            )

        for batch in batches:
            for m, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if parts and (m != mark or size >= PIECE):
                    yield out()
                    parts, size = [], 0
                if not parts:
                    mark, first = m, c
                parts.append(str(c))
                size += len(parts[-1]) + 1
        if parts:
            yield out()

    def hashes(batches):
        mark, state = None, None

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([mark], pa.binary()), pa.array([state.hexdigest()])], names=["ends", "ends_sha256"]
            )

        for batch in batches:
            for m, p in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if m != mark:
                    if state:
                        yield out()
                    mark, state = m, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(p.encode())
        if state:
            yield out()

    ranged = rows.select("ends", "conv").repartitionByRange("ends", "conv").sortWithinPartitions("ends", "conv")
    cut = ranged.mapInArrow(pieces, "ends binary, conv long, piece string")
    return cut.repartition("ends").sortWithinPartitions("ends", "conv").mapInArrow(hashes, "ends binary, ends_sha256 string")


def merged(parts: DataFrame) -> DataFrame:
    """One row for each ``node`` with a mark, out of what the blocks say of it."""
    nodes = staged(
        parts.groupBy("node", "parent", "depth", "chars").agg(
            F.min("block").alias("begun"),
            F.min("conv").alias("conv"),
            F.sum("n").alias("n"),
            F.sum("children").alias("inner"),
            F.sum("leaves").alias("leaves"),
            F.sum("saved").alias("saved"),
            F.max("ends").alias("ends"),
        ),
        "trie-merged",
    )
    kids = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids"))
    nodes = nodes.join(kids, "node", "left").withColumn("children", F.col("inner") + F.coalesce("kids", F.lit(0)))
    nodes = staged(nodes.drop("inner", "kids"), "trie-merged")
    # nodes of a block's first path that an earlier block began: their text was counted as new once too often, for
    # themselves and all above them
    again = parts.where("first").select("block", "node", "depth", "chars").join(nodes.select("node", "begun"), "node")
    below = Window.partitionBy("block").orderBy(F.desc("depth"))
    twice = F.sum(F.when(F.col("begun") < F.col("block"), F.col("chars")).otherwise(0)).over(below)
    more = again.withColumn("more", twice).groupBy("node").agg(F.sum("more").alias("more"))
    # last sequences that go on in a later block: no leaves
    goes_on = parts.where("end_of_block").join(nodes.where("children > 0").select("node"), "node").select("block")
    less = parts.where("last").join(goes_on, "block").groupBy("node").agg(F.count("*").alias("less"))
    right = nodes.join(more, "node", "left").join(less, "node", "left")
    return right.select(
        "node", "parent", "depth", "conv", "n", "children",
        (F.col("leaves") - F.coalesce("less", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("more", F.lit(0))).alias("saved"),
        "ends",
    )


def prefix_trie(convs: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row for each distinct beginning of ``steps``, the empty one included, of ``conv`` (distinct) and ``steps``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` (childless
    nodes below, or itself), ``saved_tokens`` (characters of the last turn times members but one, summed over the
    subtree), ``ends_sha256`` (of the members that end here). An empty table has no nodes.
    """
    ids = F.transform("steps", lambda s: s["id"])
    rows = convs.select(
        "conv",
        ids.alias("ids"),
        F.transform("steps", lambda s: s["chars"]).alias("chars"),
        F.unhex(F.md5(F.array_join(ids.cast("array<string>"), ","))).alias("ends"),
    )
    rows = staged(rows, "trie-rows")
    distinct = rows.groupBy("ids", "chars", "ends").agg(F.count("*").alias("n"), F.min("conv").alias("conv"))
    distinct = staged(distinct.select("ids", "chars", "n", "conv", "ends"), "trie-sequences")
    ranges = distinct.repartitionByRange("ids").sortWithinPartitions("ids")
    nodes = staged(ranges.mapInArrow(lambda batches: build(batches, block_turns), NODES), "trie-nodes")

    parts = nodes.where(F.col("node").isNotNull())
    edge = staged(merged(parts), "trie-edge")
    own = ["depth", "conv", "n", "children", "leaves", "saved", "ends"]
    upper = edge.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    on_edge = edge.join(upper, "parent", "left").select(*own, "parent_conv")
    inner = nodes.where(F.col("node").isNull())
    inside = inner.where(F.col("parent").isNull()).select(*own, "parent_conv")
    # children of merged nodes; by block as well, since the root has most of them
    known = parts.select("block", "node").join(edge.select("node", "conv"), "node")
    known = known.select("block", F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    below = inner.where(F.col("parent").isNotNull()).drop("parent_conv").join(known, ["block", "parent"])
    every = on_edge.unionByName(inside).unionByName(below.select(*own, "parent_conv"))
    hashed = every.where(F.col("ends").isNotNull()).join(member_lists(rows), "ends").drop("ends")
    plain = every.where(F.col("ends").isNull()).drop("ends").withColumn("ends_sha256", F.lit(NOTHING))
    return hashed.unionByName(plain).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


SQL = f"""
WITH turns AS (
  SELECT conv_id AS conv, coalesce(text, '') AS said,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark, turn
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT conv, mark, length(said) AS chars, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, mark) - 1 AS k
  FROM turns),
convs AS (SELECT conv, {crc32("CAST(conv AS VARCHAR)")} % {BORROWED} AS h FROM (SELECT DISTINCT conv FROM placed)),
rebuilt AS (
  SELECT c.conv, p.k, p.mark, p.chars FROM convs c JOIN placed p ON p.conv = c.conv - c.conv % {FAMILY} AND p.k < c.h
  UNION ALL SELECT c.conv, p.k, p.mark, p.chars FROM convs c JOIN placed p ON p.conv = c.conv AND p.k >= c.h),
numbered AS (SELECT conv, mark, chars, row_number() OVER (PARTITION BY conv ORDER BY k) AS depth FROM rebuilt),
steps AS (
  SELECT conv, depth, chars, string_agg(mark, ',') OVER (PARTITION BY conv ORDER BY depth) AS path,
         count(*) OVER (PARTITION BY conv) AS size FROM numbered
  UNION ALL SELECT c.conv, 0, 0, '', (SELECT count(*) FROM numbered n WHERE n.conv = c.conv) FROM convs c),
node AS (
  SELECT path, depth, min(conv) AS conv_id, count(*) AS n, max(chars) AS chars,
         sha256(coalesce(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv) FILTER (size = depth), '')) AS ends
  FROM steps GROUP BY path, depth),
up AS (SELECT *, CASE WHEN depth > 1 THEN path[:33 * (depth - 1) - 1] WHEN depth = 1 THEN '' END AS above FROM node),
kids AS (SELECT above, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY above),
pairs AS (
  SELECT a.path, b.n, b.chars, k.n_children FROM up a JOIN up b
  ON b.depth >= a.depth AND (a.depth = 0 OR b.path[:33 * a.depth - 1] = a.path) LEFT JOIN kids k ON k.above = b.path),
sums AS (
  SELECT path, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n - 1) * chars) AS saved FROM pairs GROUP BY path)
SELECT u.conv_id, CAST(u.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(u.n AS BIGINT) AS n_convs,
       CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, u.ends AS ends_sha256
FROM up u LEFT JOIN up p ON u.above = p.path LEFT JOIN kids k ON k.above = u.path JOIN sums s ON s.path = u.path
"""


@query("op12_conversation_trie", SQL)
def op12_conversation_trie(spark, folder):
    return prefix_trie(rebuilt(conversations(table(spark, folder, "conversations"))))

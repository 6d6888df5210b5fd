"""Operator 11: the trie of shared conversation prefixes.

A turn's id is a 128-bit digest of its role and text, so a conversation is a
byte string of fixed-width, big-endian turn ids.  The strings are dealt by
range on (string, conv_id), so a group of conversations with one beginning, or
of equal ones, is spread over as many tasks as its size asks for.  Each task
builds an adaptive radix tree (``radix``) over its range; only byte depths at
the end of a turn are trie nodes.

A node whose conversations lie in several ranges is a beginning of the last
string of one range and of the first of the next.  The lengths of those common
beginnings, one number for each border, tell every task which nodes it shares
and which of them an earlier range has counted.  All counts are then sums over
ranges, so the shared nodes (a path for each border) need one group-by.  The
list of conversations that end at a node is hashed as a stream, in ranges of
ascending id.

Sizes: a task holds its range (about PART_BYTES of strings); a single
conversation's turn ids, 16 bytes each, are one string.  The driver holds Spark's
range bounds.

Defined cases: null role and text are empty; a null turn comes first; equal
turn numbers of a conversation are ordered by turn id, repeated rows are turns of
their own; rows of a null conversation are left out, an empty table has no nodes;
empty conversations end at the root.  Texts are only hashed and counted, so
their length has no bound.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrutin.llm.common import shuffle_partitions, stored
from scrutin.llm.merkle import CRC32
from scrutin.llm.radix import Node, Tree, agreement
from scrutin.llm.ranks import dealt_by_range

WIDTH = 16
PART_BYTES = 16 << 20
#: Conversation ids in one piece of the list that is hashed for a shared node.
ENDS = 1024
#: Output rows of a batch.
ROWS = 4096

ROOT = bytes(WIDTH)
EMPTY_SHA = hashlib.sha256().hexdigest()

NODE_SCHEMA = ("part long, node_id binary, parent_id binary, depth long, turn_id binary, conv_id long, parent_conv_id long, n_convs long, "
               "n_children long, n_leaves long, saved long, ends_sha256 string, shared boolean, under_shared boolean, ends string")
_ARROW = pa.schema([
    ("part", pa.int64()), ("node_id", pa.binary()), ("parent_id", pa.binary()), ("depth", pa.int64()), ("turn_id", pa.binary()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
    ("ends_sha256", pa.string()), ("shared", pa.bool_()), ("under_shared", pa.bool_()), ("ends", pa.string())])


def turn_id(role: Column, text: Column) -> Column:
    """32 hex digits for a role and a text (null: empty)."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    return F.substring(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), role, text).cast("binary"), 256), 1, 2 * WIDTH)


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each the struct (id, bytes)."""
    t = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", turn_id(F.col("role"), F.col("text")).alias("id"), F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("bytes")).alias("t"))
    seq = t.groupBy("conv_id").agg(F.array_sort(F.collect_list("t"), _turn_order).alias("t"))
    return seq.select("conv_id", F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["bytes"].alias("bytes"))).alias("turns"))


def _turn_order(a: Column, b: Column) -> Column:
    """Null turns first, then by turn and id."""
    def by(x: Column, y: Column, equal: Column) -> Column:
        return F.when(x < y, -1).when(x > y, 1).otherwise(equal)
    rank = lambda x: x["turn"].isNotNull().cast("int")
    return by(rank(a), rank(b), by(a["turn"], b["turn"], by(a["id"], b["id"], F.lit(0))))


def rebuilt(seqs: DataFrame, block: int = 5, most: int = 8) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % ``block``
    in place of its own first h; h is crc32(c) % (``most`` + 1).  A row of the
    block's first conversation serves at most 2 * ``block`` - 1 others."""
    base = F.col("conv_id") - F.col("conv_id") % block
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = seqs.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    own = seqs.select("conv_id", "turns", base.alias("base"), h.alias("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    joined = own.join(heads, "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


class _Part:
    """One range of sorted strings and the nodes of its tree."""

    def __init__(self, part: int, before: int, after: int):
        self.part, self.before, self.after = part, before, after
        self.tree, self.first, self.last = Tree(), None, None

    def add(self, key: bytes, conv: int, sizes: list[int]) -> None:
        if key == self.last:
            self.ends.append(conv)
            return
        self.first = key if self.first is None else self.first
        self.last, self.ends = key, [conv]
        self.tree.insert(key, self.ends, (key, sizes))

    def rows(self) -> Iterator[tuple]:
        on_first = {id(x) for x in self.tree.path(self.first)}
        on_last = {id(x) for x in self.tree.path(self.last)}
        # the last string's node lies in the next range too
        goes_on = self.after == len(self.last) // WIDTH
        # each radix node, its parent's place, and the depths of the turns that end in it
        order: list[tuple[Node, int, range]] = []
        todo: list[tuple[Node, int, int]] = [(self.tree.root, -1, -1)]
        while todo:
            node, up, start = todo.pop()
            end = start + 1 + len(node.prefix)
            order.append((node, up, range(end // WIDTH, start // WIDTH, -1)))
            todo.extend((c, len(order) - 1, end) for _, c in node.items())

        # upwards: members, leaves, saved, and the topmost trie nodes below, and those an earlier range counted
        n, leaves, saved, tops, seen = ([0] * len(order) for _ in range(5))
        least: list[int | None] = [None] * len(order)
        found: list[list[tuple[int, int, int, int]]] = [[] for _ in order]
        for i in range(len(order) - 1, -1, -1):
            node, up, depths = order[i]
            for ends in node.payloads:
                n[i] += len(ends)
                least[i] = ends[0] if least[i] is None else min(least[i], ends[0])
            children, counted = tops[i], seen[i]
            if depths and not children and not (goes_on and id(node) in on_last):
                leaves[i] = 1
            for d in depths:
                old = id(node) in on_first and d <= self.before
                if d:
                    size = node.sample[1][d - 1]
                    saved[i] += n[i] * size - (0 if old else size)
                found[i].append((d, children - counted, leaves[i], saved[i]))
                children, counted = 1, int(old)
            if up >= 0:
                n[up] += n[i]
                leaves[up] += leaves[i]
                saved[up] += saved[i]
                tops[up] += children
                seen[up] += counted
                least[up] = least[i] if least[up] is None else min(least[up], least[i])

        # downwards: each trie node knows the one above it
        above: list[tuple] = []
        for i, (node, up, _) in enumerate(order):
            parent = above[up] if up >= 0 else (None, None, False)
            for d, children, leaf, save in reversed(found[i]):
                turn = node.sample[0][(d - 1) * WIDTH:d * WIDTH] if d else None
                name = hashlib.blake2b(parent[0] + turn, digest_size=WIDTH).digest() if d else ROOT
                shared = id(node) in on_first and d <= self.before or id(node) in on_last and d <= self.after
                ends = node.payloads[0] if node.payloads and d == found[i][0][0] else []
                row = (self.part, name, parent[0], d, turn, least[i], parent[1], n[i], children, leaf, save)
                text = None if shared else _sha([",".join(map(str, ends))])
                yield *row, text, shared, parent[2], None
                for at in range(0, len(ends) if shared else 0, ENDS):
                    yield (self.part, name, None, at, *[None] * 7, None, True, False, ",".join(map(str, ends[at:at + ENDS])))
                parent = (name, least[i], shared)
            above.append(parent)


def _sha(texts: list[str]) -> str:
    return hashlib.sha256(",".join(texts).encode()).hexdigest()


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie rows of each range; a task's rows come by range and in string order."""
    def rows() -> Iterator[tuple]:
        now: _Part | None = None
        for batch in batches:
            for part, before, after, key, conv, sizes in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if now is None or now.part != part:
                    if now is not None:
                        yield from now.rows()
                    now = _Part(part, before, after)
                now.add(key, conv, sizes)
        if now is not None:
            yield from now.rows()

    return _batches(rows())


def _borders(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The turns that the last string before a range shares with its first; -1 at the start."""
    for f in frames:
        yield pd.DataFrame({"part": f["part"], "before": [
            -1 if a is None else agreement(a, b) // WIDTH for a, b in zip(f["ended"], f["starts"])]})


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's list; a task's pieces come by node, range and place."""
    now, sha, names, hashes = None, None, [], []
    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name == now:
                sha.update(b",")
            else:
                if now is not None:
                    names.append(now)
                    hashes.append(sha.hexdigest())
                now, sha = name, hashlib.sha256()
            sha.update(text.encode())
    if now is not None:
        names.append(now)
        hashes.append(sha.hexdigest())
    yield pa.record_batch([pa.array(names, pa.binary()), pa.array(hashes, pa.string())], names=["node_id", "ends_sha256"])


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """One row per trie node of sequences (conv_id, turns: array of (id, bytes)):
    ``node_id``, ``parent_id``, ``depth``, ``turn_id`` (the last turn's, null at the
    root), ``conv_id`` (its least member), ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved`` (bytes that sharing saves in the
    subtree) and ``ends_sha256`` (of the ids of the conversations that end here)."""
    spark = seqs.sparkSession
    flat = stored(seqs.select(
        F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("key"), "conv_id",
        F.transform("turns", lambda t: t["bytes"]).alias("sizes")), "trie-sequences")
    size = flat.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-size // PART_BYTES))
    dealt = dealt_by_range(flat, ["key", "conv_id"], "trie-ranges", parts)
    w = Window.orderBy("part")  # one row for each range
    starts = dealt.groupBy("part").agg(F.min("key").alias("starts"), F.max("key").alias("ended"))
    borders = (starts.select("part", "starts", F.lag("ended").over(w).alias("ended"))
               .mapInPandas(_borders, "part long, before long"))
    borders = borders.select("part", "before", F.coalesce(F.lead("before").over(w), F.lit(-1)).alias("after"))
    ranges = (dealt.join(borders, "part").select(F.col("part").cast("long").alias("part"), "before", "after", "key", "conv_id", "sizes")
              .repartition(parts, "part").sortWithinPartitions("part", "key", "conv_id"))
    built = stored(ranges.mapInArrow(_trees, NODE_SCHEMA), "trie-nodes")

    nodes = built.where("ends is null")
    shared = nodes.where("shared").groupBy("node_id").agg(
        F.first("parent_id").alias("parent_id"), F.first("depth").alias("depth"), F.first("turn_id").alias("turn_id"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")])
    pieces = built.where("ends is not null").select("node_id", "ends", "part", "depth")
    hashes = (pieces.repartition(parts, "node_id").sortWithinPartitions("node_id", "part", "depth").select("node_id", "ends")
              .mapInArrow(_ends, "node_id binary, ends_sha256 string"))
    shared = stored(shared.join(hashes, "node_id", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA))), "trie-shared")

    columns = ["node_id", "parent_id", "depth", "turn_id", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    up = shared.select(F.col("node_id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    upper = shared.join(up, "parent_id", "left")
    # a shared node's children meet its least member range by range: its row goes to every range that holds a part of it
    held = nodes.where("shared").select("part", "node_id").join(up.withColumnRenamed("parent_id", "node_id"), "node_id").withColumnRenamed("node_id", "parent_id")
    own = nodes.where("not shared")
    lower = own.where("under_shared").drop("parent_conv_id").join(held, ["part", "parent_id"])
    return own.where("not under_shared").select(columns).unionByName(lower.select(columns)).unionByName(upper.select(columns))


def with_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes with the role and text of their last turn."""
    turns = conversations.select(
        F.unhex(turn_id(F.col("role"), F.col("text"))).alias("turn_id"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).groupBy("turn_id").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    return nodes.join(turns, "turn_id", "left")


def shared_prefixes(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(rebuilt(sequences(conversations))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


ORACLE = """
WITH turns AS (
  SELECT conv_id, text, sha256(octet_length(encode(role)) || ':' || role || ':' || text) AS id,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(octet_length(encode(role)) || ':' || role || ':' || text)) AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT conv_id, """ + CRC32.format("conv_id") + """ % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, t.p, t.id, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, t.p, t.id, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h),
members AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(id, '') OVER w AS path, octet_length(encode(text)) AS bytes, count(*) OVER (PARTITION BY conv_id) AS turns
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY p)
  UNION ALL
  SELECT conv_id, 0, '', 0, (SELECT count(*) FROM rebuilt r WHERE r.conv_id = convs.conv_id) FROM convs),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE turns = depth), '')) AS ends_sha256
  FROM members GROUP BY path, depth),
children AS (SELECT left(path, (depth - 1) * 64) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
below AS (
  SELECT a.path, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum(CAST((b.n_convs - 1) * b.bytes AS BIGINT)) AS saved_tokens
  FROM counted a JOIN counted b ON b.depth >= a.depth AND left(b.path, a.depth * 64) = a.path GROUP BY a.path)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b USING (path) LEFT JOIN nodes p ON c.depth > 0 AND p.path = left(c.path, (c.depth - 1) * 64)
"""

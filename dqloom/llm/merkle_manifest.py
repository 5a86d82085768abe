"""Merkle manifest of a dataset: leaf coordinates by bitmap rank, levels by keyed slot arrays.

Each row is a leaf, a hash of its five columns. The leaves of a language stand in order of doc_id and
are hashed in pairs, level by level, to a subroot; the subroots of all languages, likewise,
to one root. A row's proof is the siblings on its way up.

Coordinates. The ids of a language are cut into blocks of ``2**BLOCK_BITS`` numbers. Each block is
a compressed bitmap (a list of numbers while that is shorter) with a popcount directory. Blocks are counted
by digits of ``DIGIT_BITS`` bits from the top: each level of this directory sums what stands before a
block among its siblings, never over more than ``2**DIGIT_BITS`` of them, so no language is
sorted or gathered. A row's coordinate is the start of its block and the popcount below its own bit.

Levels. A coordinate names a group and a slot. A group of ``2**LEVELS`` slots is an array that is filled by
slot and reduced by ``LEVELS`` levels at once; its top is a node of the next round. On the way
down each group gets the siblings above it from its parent once, and shares them.

In every case: every missing value is hashed as ``-``; rows without doc_id stand first; rows that share
language and doc_id are ordered by leaf (coordinates by the same bitmaps, over leaves), and equal leaves
are interchangeable; an empty table has no rows and no root; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqloom.llm import common as c

BLOCK_BITS = 12
DIGIT_BITS = 13
# 52 bits above a block's own: four digits.
DIGITS = 4
LEVELS = 10
# A block of more rows than this and than so small a share of all is split over tasks.
HOT_ROWS = 1 << 14
HOT_SHARE = 1000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# One document in so many is tampered with to try the proofs.
TAMPER_STEP = 7


# --- leaves ------------------------------------------------------------------------


def _part(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: dict[str, Column]) -> Column:
    """The hash of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[_part(columns[n]) for n in COLUMNS]), 256))


def leaves(docs: DataFrame, other: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """``k`` (language, the missing one first), ``doc_id``, ``leaf`` and ``other``: the leaf that a row
    would have with the columns ``other`` in the place of its own, for rows ``where`` so."""
    docs = c.in_small_batches(docs)
    own = {n: F.col(n) for n in COLUMNS}
    changed = F.when(where, leaf_hash(own | other)) if other else F.lit(None).cast("binary")
    return docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("")).alias("k"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_hash(own).alias("leaf"),
        changed.alias("other"),
    )


# --- coordinates by bitmap rank ---------------------------------------------------------


class Block:
    """The numbers of a block, with how often each repeated one occurs."""

    WORDS = (1 << BLOCK_BITS) // 64

    @staticmethod
    def pack(low: np.ndarray, counts: np.ndarray) -> bytes:
        """``low``: distinct numbers in any order."""
        bits = np.zeros(1 << BLOCK_BITS, np.uint8)
        bits[low] = 1
        more = counts > 1
        again = np.zeros(1 << BLOCK_BITS, np.int64)
        again[low[more]] = counts[more] - 1
        at = np.flatnonzero(again)
        head = np.array([len(low), len(at)], np.uint32).tobytes()
        if 2 * len(low) < len(bits) // 8:
            body = np.flatnonzero(bits).astype(np.uint16).tobytes()
        else:
            words = np.packbits(bits, bitorder="little").view(c.U64)
            counted = np.bitwise_count(words).astype(np.uint16)
            body = words.tobytes() + (np.cumsum(counted) - counted).astype(np.uint16).tobytes()
        return head + body + at.astype(np.uint16).tobytes() + again[at].tobytes()

    def __init__(self, packed: bytes):
        n, repeated = np.frombuffer(packed, np.uint32, 2).tolist()
        at = 8
        self.listed = 2 * n < (1 << BLOCK_BITS) // 8
        if self.listed:
            self.low = np.frombuffer(packed, np.uint16, n, at)
            at += 2 * n
        else:
            self.words = np.frombuffer(packed, c.U64, self.WORDS, at)
            self.directory = np.frombuffer(packed, np.uint16, self.WORDS, at + 8 * self.WORDS)
            at += 10 * self.WORDS
        self.again = np.frombuffer(packed, np.uint16, repeated, at)
        more = np.frombuffer(packed[at + 2 * repeated :], np.int64)
        self.before = np.concatenate([[0], np.cumsum(more)])

    def rank(self, low: np.ndarray) -> np.ndarray:
        """How many rows of the block have a smaller number."""
        if self.listed:
            out = np.searchsorted(self.low, low)
        else:
            word = low >> 6
            below = (c.U64(1) << (low & 63).astype(c.U64)) - c.U64(1)
            out = self.directory[word].astype(np.int64) + np.bitwise_count(self.words[word] & below)
        return out + self.before[np.searchsorted(self.again, low)]

    def times(self, low: np.ndarray) -> np.ndarray:
        """How many rows have this number."""
        at = np.searchsorted(self.again, low)
        more = np.diff(np.append(self.before, self.before[-1]))[at]
        hit = np.append(self.again, np.uint16(0))[at] == low
        return np.where(hit & (at < len(self.again)), more, 0) + 1


def _runs(frames, keys: list[str]):
    """Each run of rows that agree in ``keys``, from frames in which they stand together."""
    held = None
    for frame in frames:
        if not len(frame):
            continue
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        new = np.zeros(len(held), bool)
        for k in keys:
            column = held[k].to_numpy()
            new[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(new)
        at = 0
        for end in starts.tolist():
            yield held.iloc[at:end]
            at = end
        held = held.iloc[at:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _split(value: str) -> dict[str, Column]:
    """Block and number within it. A missing value has the block before all others."""
    first = -((1 << (DIGIT_BITS - 1)) + 1) << (DIGIT_BITS * (DIGITS - 1))
    return {
        "block": F.coalesce(F.shiftright(value, BLOCK_BITS), F.lit(first).cast("long")),
        "low": F.coalesce(F.col(value).bitwiseAND((1 << BLOCK_BITS) - 1), F.lit(0)).cast("int"),
    }


def _blocks(rows: DataFrame) -> DataFrame:
    """``k``, ``block``, its bitmap ``bits`` and its rows ``n``. ``rows``: ``k``, ``block``, ``low``, ``times``."""
    each = rows.groupBy("k", "block", "low").agg(F.sum("times").alias("times"))

    def pack(frames):
        for run in _runs(frames, ["k", "block"]):
            times = run["times"].to_numpy()
            yield pd.DataFrame({"k": run["k"][:1], "block": run["block"][:1], "bits": [Block.pack(run["low"].to_numpy(), times)], "n": [int(times.sum())]})

    ready = each.repartition("k", "block").sortWithinPartitions("k", "block")
    return c.stored(ready.mapInPandas(pack, "k string, block long, bits binary, n long"))


def _starts(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``start``, the rows of ``k`` before each, and ``size``, all its rows."""
    at = F.col("block")
    level, offsets = blocks.select("k", "block", "n"), []
    for digit in range(DIGITS):
        up = F.shiftright(at, DIGIT_BITS) if digit < DIGITS - 1 else F.lit(0).cast("long")
        level = level.withColumn("up", up)
        siblings = Window.partitionBy("k", "up").orderBy("block")
        before = F.coalesce(F.sum("n").over(siblings.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        offsets.append(level.select("k", "block", "up", before.alias("before")))
        level = level.groupBy("k", "up").agg(F.sum("n").alias("n")).withColumnRenamed("up", "block")
    out = offsets[-1].join(level.select("k", F.col("n").alias("size")), "k").select("k", "block", F.col("before").alias("start"), "size")
    for lower in reversed(offsets[:-1]):
        above = out.select("k", F.col("block").alias("up"), "start", "size")
        out = lower.join(above, ["k", "up"]).select("k", "block", (F.col("before") + F.col("start")).alias("start"), "size")
    return blocks.join(out, ["k", "block"])


def _ranked(rows: DataFrame, value: str) -> DataFrame:
    """``rows``, a stored table (``k``, the long ``value``, ``times`` and others), with ``pos``, how many rows of ``k`` have a
    smaller value, ``size``, all rows of ``k``, and ``same``, rows of this value."""
    names = rows.columns
    rows = rows.withColumns(_split(value))
    blocks = c.stored(_starts(_blocks(rows.select("k", "block", "low", "times"))))
    total = blocks.agg(F.sum("n")).first()[0] or 0
    least = max(HOT_ROWS, total // HOT_SHARE)
    # fewer than HOT_SHARE blocks; each row of them goes to one of several tasks
    hot = F.broadcast(blocks.where(F.col("n") > least).select("k", "block", F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("tasks")))
    rows = rows.join(hot, ["k", "block"], "left")
    # rows are read from a table, so their numbers are the same in every attempt
    number = F.xxhash64(*names, F.monotonically_increasing_id())
    rows = rows.withColumn("task", F.coalesce(F.pmod(number, F.col("tasks")).cast("int"), F.lit(0))).drop("tasks")
    tasks = F.when(F.col("n") > least, F.ceil(F.col("n") / HOT_ROWS).cast("int")).otherwise(1)
    heads = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), tasks - 1))).select("k", "block", "task", "bits", "start", "size")
    both = heads.unionByName(rows, allowMissingColumns=True)
    both = both.repartition("k", "block", "task").sortWithinPartitions("k", "block", "task", F.col("bits").isNull())
    out = rows.drop("block", "low", "task")
    columns, fields = out.columns, out.schema.simpleString()[7:-1]

    def place(frames):
        block = start = size = None
        for frame in frames:
            heads = np.flatnonzero(frame["bits"].notna().to_numpy())
            done = []
            for at, end in zip([-1, *heads.tolist()], [*heads.tolist(), len(frame)]):
                if at >= 0:
                    block, start, size = Block(frame["bits"].iloc[at]), int(frame["start"].iloc[at]), int(frame["size"].iloc[at])
                if end - at > 1:
                    own = frame.iloc[at + 1 : end]
                    low = own["low"].to_numpy().astype(np.int64)
                    done.append(own[columns].assign(pos=start + block.rank(low), size=size, same=block.times(low)))
            if done:
                yield pd.concat(done, ignore_index=True)

    # a nullable long would come to pandas as a float
    asked = both.withColumn(value, F.col(value).cast("string")) if value in columns else both
    fields = fields.replace(f"{value}:bigint", f"{value}:string")
    placed = asked.mapInPandas(place, ", ".join(x.replace(":", " ") for x in fields.split(",")) + ", pos long, size long, same long")
    return placed.withColumn(value, F.col(value).cast("long"))


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` (as of ``leaves``, stored, not needed after this) with ``pos`` among the ``size`` leaves of ``k``, each of them once."""
    found = c.stored(_ranked(rows.withColumn("times", F.lit(1).cast("long")), "doc_id"), (rows,))
    names = [*rows.columns, "size", "pos"]
    tied = found.where("same > 1")
    if tied.isEmpty():
        return found.select(*names)
    # copies combine; then leaves are ranked among those of one doc_id
    tied = tied.groupBy("k", "doc_id", "leaf", "other", "size", "pos").agg(F.count("*").alias("times"))
    tied = tied.withColumns({"of": F.col("k"), "first": F.col("pos"), "whole": F.col("size"), "k": F.concat_ws("/", "pos", "k")})
    tied = tied.withColumns({"head": F.conv(F.hex(F.substring("leaf", 1, 7)), 16, 10).cast("long"), "doc_id": F.col("doc_id").cast("string")})
    tied = ranked = c.stored(_ranked(c.stored(tied.drop("size", "pos")), "head"))
    # different leaves with equal heads
    ahead = Window.partitionBy("k", "pos").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    tied = tied.withColumn("ahead", F.coalesce(F.sum("times").over(ahead), F.lit(0)))
    copies = tied.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    copies = copies.select(
        F.col("of").alias("k"), F.col("doc_id").cast("long").alias("doc_id"), "leaf", "other", F.col("whole").alias("size"),
        (F.col("first") + F.col("pos") + F.col("ahead") + F.col("copy")).alias("pos"),
    )
    return c.stored(found.where("same = 1").select(*names).unionByName(copies.select(*names)), (found, ranked))


# --- levels by slot arrays ------------------------------------------------------------


def digest(*parts: bytes) -> bytes:
    """The hash of digests, joined as hex text."""
    return hashlib.sha256(b"".join([p.hex().encode() for p in parts])).digest()


def levels_of(group: pd.DataFrame, column: str, most: int) -> list[list[bytes]]:
    """Up to ``most`` levels above a group of nodes, these first, each of them put into its slot."""
    size, slots = int(group["size"].iloc[0]), [b""] * len(group)
    for at, node in zip(_slots(group, most), group[column]):
        slots[at] = bytes(node)
    out = [slots]
    while size > 1 and len(out) <= most:
        below = out[-1]
        out.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
        size = -(-size // 2)
    return out


def _slots(group: pd.DataFrame, levels: int) -> list[int]:
    return (group["pos"].to_numpy() & ((1 << levels) - 1)).tolist()


def siblings(levels: list[list[bytes]], slot: int) -> bytes:
    """The way up from a slot: for each level ``L`` or ``R`` (where the sibling stands) and the sibling, or
    ``-`` without one."""
    way = []
    for level in levels[:-1]:
        other = slot ^ 1
        way.append((b"L" if slot & 1 else b"R") + level[other] if other < len(level) else b"-")
        slot >>= 1
    return b"".join(way)


def steps(way: bytes):
    """The side and the sibling of each level of a way."""
    at = 0
    while at < len(way):
        side, at = way[at : at + 1], at + 1
        if side == b"-":
            yield side, b""
        else:
            yield side, way[at : at + 32]
            at += 32


def folded(node: bytes, way: list[tuple[bytes, bytes]]) -> bytes:
    """The root to which a node leads on its way up."""
    for side, other in way:
        node = digest(node) if side == b"-" else digest(other, node) if side == b"L" else digest(node, other)
    return node


_NODE = "k string, pos long, size long, node binary"


def _reduced(nodes: DataFrame) -> DataFrame:
    """The tops of all groups of ``nodes`` (``k``, ``pos``, ``size``, ``node``)."""

    levels = LEVELS

    def reduce(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        top = levels_of(group, "node", levels)[-1][0]
        size = -(-int(group["size"].iloc[0]) >> levels)
        return pd.DataFrame({"k": [key[0]], "pos": [key[1]], "size": [size], "node": [top]})

    grouped = nodes.withColumn("of", F.shiftright("pos", levels)).groupBy("k", "of")
    return c.stored(grouped.applyInPandas(reduce, _NODE))


@dataclass
class Tree:
    """The rounds of a forest, a tree for each ``k``: leaves first, then tops of groups."""

    rounds: list[DataFrame]
    roots: DataFrame

    @classmethod
    def over(cls, nodes: DataFrame) -> Tree:
        rounds, roots = [nodes], []
        while True:
            rounds.append(_reduced(rounds[-1] if len(rounds) == 1 else rounds[-1].where("size > 1")))
            roots.append(rounds[-1].where("size = 1").select("k", "node"))
            if rounds[-1].where("size > 1").isEmpty():
                break
        found = roots[0]
        for more in roots[1:]:
            found = found.union(more)
        return cls(rounds, found)

    def ways(self, above: DataFrame) -> DataFrame:
        """``k``, ``pos``, ``root``, ``way`` of the nodes of the first round above the leaves, given the way
        of each root (``k``, ``root``, ``way``)."""
        out = None
        for nodes in reversed(self.rounds[1:]):
            ways = nodes.where("size = 1").join(above, "k").select("k", "pos", "root", "way")
            if out is not None:
                ways = ways.union(_node_ways(nodes.where("size > 1"), out))
            out = ways
        return out


def _node_ways(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    most = LEVELS

    def each(group: pd.DataFrame, root: bytes, way: bytes) -> pd.DataFrame:
        levels = levels_of(group, "node", most)
        found = [siblings(levels, at) + way for at in _slots(group, most)]
        return pd.DataFrame({"k": group["k"], "pos": group["pos"], "root": root, "way": found})

    return _downward(nodes, ways, each, "k string, pos long, root binary, way binary")


def _downward(nodes: DataFrame, ways: DataFrame, work, schema: str) -> DataFrame:
    """``work(group, root, way)`` on each group of ``nodes`` with the root and way of its top."""

    def each(group: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        return work(group, bytes(top["root"].iloc[0]), bytes(top["way"].iloc[0]))

    of = nodes.withColumn("of", F.shiftright("pos", LEVELS)).groupBy("k", "of")
    return of.cogroup(ways.withColumnRenamed("pos", "of").groupBy("k", "of")).applyInPandas(each, schema)


def _in_order(roots: DataFrame) -> DataFrame:
    """The subroots as the leaves of one tree, in order of their ``k``; the order is of ranges, not one task's."""
    cut = c.stored(roots.repartitionByRange("k").withColumn("part", F.spark_partition_id()))
    counts = {r.part: r.n for r in cut.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(counts):
        before[part] = total
        total += counts[part]
    start = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("part")] if before else F.lit(0)
    nth = F.row_number().over(Window.partitionBy("part").orderBy("k"))
    return c.stored(cut.select(F.lit("").alias("k"), (start + nth - 1).cast("long").alias("pos"), F.lit(total).cast("long").alias("size"), "node", F.col("k").alias("of")))


def manifest(docs: DataFrame, other: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """Of each row ``doc_id``, ``lang``, ``pos`` among the leaves of its language, ``leaf``, ``subroot``,
    ``root``, ``proof_sha256`` (of its siblings), ``way`` (see ``siblings``) and ``folded_root``: where
    the way leads from the leaf it would have with the columns ``other``, or from its own."""
    rows = c.stored(placed(c.stored(leaves(docs, other, where))))
    tree = Tree.over(rows.withColumnRenamed("leaf", "node"))
    subroots = _in_order(tree.roots)
    top = Tree.over(subroots)
    root = top.roots.select(F.lit("").alias("k"), F.col("node").alias("root"), F.lit(b"").alias("way"))
    # the ways of the subroots, then of the groups of leaves
    over = _node_ways(subroots.drop("of"), top.ways(root))
    above = over.join(subroots.select("pos", "of"), "pos").select(F.col("of").alias("k"), F.col("way"))
    above = c.stored(above.join(tree.roots, "k").select("k", F.col("node").alias("root"), "way"))
    whole = root.first()
    whole_root, most = bytes(whole.root) if whole else b"", LEVELS

    def prove(group: pd.DataFrame, subroot: bytes, way: bytes) -> pd.DataFrame:
        levels = levels_of(group, "leaf", most)
        shared = list(steps(way))
        out = []
        for pos, leaf, changed in zip(group["pos"].tolist(), group["leaf"], group["other"]):
            own = siblings(levels, pos & ((1 << most) - 1))
            up = [*steps(own), *shared]
            proof = digest(*[node for side, node in up if side != b"-"])
            out.append((pos, leaf, subroot, proof, own + way, folded(bytes(leaf if changed is None else changed), up)))
        done = pd.DataFrame(out, columns=["pos", "leaf", "subroot", "proof", "way", "folded"])
        done.insert(0, "doc_id", group["doc_id"].to_numpy())
        done.insert(1, "k", group["k"].to_numpy())
        return done

    asked = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = _downward(asked, tree.ways(above), prove, "doc_id string, k string, pos long, leaf binary, subroot binary, proof binary, way binary, folded binary")
    as_hex = lambda x: F.lower(F.hex(x))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("k") != "", F.expr("substr(k, 2)")).alias("lang"),
        "pos",
        as_hex("leaf").alias("leaf"),
        as_hex("subroot").alias("subroot"),
        F.lit(whole_root.hex()).alias("root"),
        as_hex("proof").alias("proof_sha256"),
        "way",
        as_hex("folded").alias("folded_root"),
    )


def tampered() -> tuple[dict[str, Column], Column]:
    """What tampering changes, and in which rows."""
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(TAMPER_STEP)) == 0
    return {"n_chars": F.col("n_chars") + 1}, F.coalesce(hit & F.col("n_chars").isNotNull(), F.lit(False))

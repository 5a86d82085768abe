"""Shards of nearly equal bytes: histogram sort, in DataFrame operations only.

Documents are ordered by (hash of the text, hash of the doc_id), so equal texts stand next to
each other. ``n - 1`` splitters cut that order into shards. Each round counts the exact bytes
below candidate boundaries, over all partitions at once: the first round takes boundaries on
the leading ``STEP`` bits of the key, each later one refines, by ``STEP`` bits more, only the
stretches in which a splitter has not met its tolerance. A round shuffles a few sums a task.
A boundary between two texts is preferred; only a text whose copies are more than the
tolerance is split, by doc_id. Then rows are exchanged once, by shard.

Within a shard, slots count rows from 0: rows are counted by shard and block of the doc_id hash,
and ordered within their block only, so no task holds a whole shard.

In every case: a missing text has no bytes and hashes like an empty one; a missing doc_id
hashes as empty; rows that agree in both may stand in either order; an empty table has no
shards; more shards than documents leave some empty; extra columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqloom.llm import common as c

OVERHEAD = 8
STEP = 12
WIDTH = 48
# A splitter may miss its target by this share of a shard.
TOLERANCE = 0.002
BLOCKS = 256


def _hash(value: Column) -> Column:
    """``WIDTH`` bits of a hash, not negative."""
    return F.shiftrightunsigned(F.xxhash64(value), 64 - WIDTH)


def _round(keys: DataFrame, key: str, bits: int, within: list[tuple[int, int]]) -> dict[int, int]:
    """Bytes by the leading ``bits`` of a key, for rows in the stretches named by their ends."""
    rows = keys.where(_any(key, within)) if within else keys
    found = rows.groupBy(F.shiftright(key, WIDTH - bits).alias("lead")).agg(F.sum("size").alias("bytes")).collect()
    return {r.lead: r.bytes for r in found}


def _any(key: str, stretches: list[tuple[int, int]]) -> Column:
    out = F.lit(False)
    for low, high in stretches:
        out = out | ((F.col(key) >= low) & (F.col(key) < high))
    return out


def _search(keys: DataFrame, key: str, goals: dict[int, tuple[float, int, int, float]], slack: float) -> dict[int, tuple[int, float, int]]:
    """For each splitter a boundary on ``key``.

    ``goals``: splitter to (wanted bytes below, low and high end of its stretch, bytes below the
    stretch). The result: (boundary, its error, bytes below it). Every round counts what lies
    below the candidates, and keeps the stretch between the two next to the goal.
    """
    done: dict[int, tuple[int, float, int]] = {}
    open_ = dict(goals)
    for bits in range(STEP, WIDTH + 1, STEP):
        if not open_:
            break
        span = 1 << (WIDTH - bits)
        sums = _round(keys, key, bits, [] if bits == STEP else sorted({(low, high) for _, low, high, _ in open_.values()}))
        leads = sorted(sums)
        for splitter, (goal, low, high, below) in list(open_.items()):
            edge, at = low, below
            best = done.get(splitter)
            for lead in leads:
                start = lead * span
                if start < low or start >= high:
                    continue
                for place, total in ((start, at), (start + span, at + sums[lead])):
                    # at the same error the finer boundary, which names a text
                    if best is None or abs(total - goal) <= best[1]:
                        best = (place, abs(total - goal), total)
                if at + sums[lead] >= goal:
                    edge = start
                    break
                at += sums[lead]
            done[splitter] = best or (low, abs(below - goal), below)
            if done[splitter][1] <= slack:
                del open_[splitter]
            else:
                open_[splitter] = (goal, edge, edge + span, at)
    return done


def _bytes_below(text: int) -> Column:
    return F.sum(F.when(F.col("h") < text, F.col("size")))


def _rows_of(text: int) -> Column:
    return F.count(F.when(F.col("h") == text, 1))


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """``shards - 1`` boundaries (text hash, id hash): rows from there on are in later shards.

    ``keys``: ``h``, ``g`` (hashes of ``WIDTH`` bits) and ``size``. At most
    ``shards * 2**STEP`` sums reach the driver in a round.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    goals = {i: (total * i / shards, 0, 1 << WIDTH, 0) for i in range(1, shards)}
    found = {i: (h, 0, error, below) for i, (h, error, below) in _search(keys, "h", goals, slack).items()}
    # splitters that fall into the copies of one text: its rows are cut by doc_id
    missed: dict[int, list[int]] = {}
    for i, (h, _, error, below) in found.items():
        if error > slack:
            text = h if below < goals[i][0] else h - 1
            missed.setdefault(text, []).append(i)
    if missed:
        per = [f(h) for h in missed for f in (_bytes_below, _rows_of)]
        sums = keys.agg(*[x.alias(f"s{i}") for i, x in enumerate(per)]).first()
        for n, (text, group) in enumerate(missed.items()):
            below, copies = sums[2 * n] or 0, sums[2 * n + 1] or 0
            if copies > 1:
                inner = {i: (goals[i][0], 0, 1 << WIDTH, below) for i in group}
                for i, (g, _, _) in _search(keys.where(F.col("h") == text), "g", inner, slack).items():
                    found[i] = (text, g, 0.0, 0)
    return [found[i][:2] for i in sorted(found)]


def sharded(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``docs`` with a struct ``place``: ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``,
    ``grown_shard``."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, doc_id = F.col(f"c{names.index('text')}"), F.col(f"c{names.index('doc_id')}").cast("string")
    keyed = plain.select(
        "*",
        _hash(F.coalesce(text, F.lit(""))).alias("h"),
        _hash(F.coalesce(doc_id, F.lit(""))).alias("g"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
    )
    # rounds read these three columns, not the texts
    keys = c.stored(keyed.select("h", "g", "size"))
    shard = F.lit(0)
    for h, g in splitters(keys, shards):
        shard = shard + ((F.col("h") > h) | ((F.col("h") == h) & (F.col("g") >= g))).cast("int")
    block = F.pmod(F.col("g"), F.lit(BLOCKS))
    placed = keyed.withColumns({"shard": shard, "block": block})
    counts = keys.groupBy(shard.alias("shard"), block.alias("block")).agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("shard").alias("of"), F.col("block").alias("at"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("shard", "block").orderBy("g", "h")
    ordered = placed.withColumn("nth", F.row_number().over(within)).join(
        F.broadcast(counts), (F.col("shard") == F.col("of")) & (F.col("block") == F.col("at"))
    )  # at most shards * BLOCKS rows
    place = F.struct(
        "size",
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("ahead") + F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
    return ordered.select(*plain.columns, place.alias("place")).transform(c.under, names, "place")

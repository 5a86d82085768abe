"""Removal of byte strings that also start earlier: suffixes in deep-shallow order.

Two equal strings of ``length`` bytes have the same anchor at the same place (see
``super_windows``), so only suffixes around anchors that occur twice have to be ordered, and
only against suffixes around the same anchor. An anchor seen with one content only needs no
order: all strings of its run repeat together and travel as one row. Around the others,
suffixes are sorted in buckets of one anchor: a multikey quicksort on words of eight bytes
down to ``SHALLOW`` bytes, then blind tries on what still shares a longer prefix, which look
at one branching byte a node and compare with one suffix only. Suffixes that agree in
``length`` bytes are one string; its least (doc_id, start) stays.

Buckets hold each distinct content once, however often it occurs. An anchor with more than ``HOT``
distinct contents is not brought into one bucket: the strings of these contents, not those of
their copies, become rows of their own under a hash of 128 bits, whose least place is aggregated
before the shuffle and joined back. That gives the same result.

In every case: no text, an empty one or one shorter than ``length``: nothing removed; a missing
doc_id sorts last; rows that agree in doc_id share their places, so equal rows keep each
other's bytes; extra columns are not read. Texts are compared as UTF-8 bytes; what is kept
may end within a character and is therefore bytes too.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm import common as c

ANCHOR_BYTES = 32
SHALLOW = 24
HOT = 4096
# Suffixes ordered together in a task; a bucket is never split.
BATCH = 100_000
PIECE = 1 << 18
# log2 of the bits of the filter for the occurrences whose bytes are sent.
CHOSEN_BITS = 26
ROWS = "k1 long, k2 long, id long, rk long, start int, n int, bytes binary"
PLACES = "k1 long, k2 long, j int, run int, first_id long, first_start long"
_OTHERS = c.mixed(c.BYTE_SYMBOLS)


def _walk(frame: pd.DataFrame, length: int):
    joined = np.frombuffer(b"".join(frame["text"]), np.uint8)
    sizes = np.array([len(t) for t in frame["text"]], np.int64)
    hashes = c.Windows(c.BYTE_SYMBOLS[joined])
    return joined, sizes, hashes, c.super_windows(hashes, sizes, length, min(ANCHOR_BYTES, length))


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys, the last one first, and the number of the group at each place."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    return order, np.cumsum(new)


def equal_suffixes(buffer: np.ndarray, at: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """A class for each suffix: equal for those of one bucket that agree in ``length`` bytes.

    ``buffer`` holds at least ``length`` bytes after each place in ``at``.
    """
    classes = np.arange(len(at))
    shallow = min(SHALLOW, length) // 8 * 8
    words = np.lib.stride_tricks.sliding_window_view(buffer, 8) if shallow else None
    members, group = classes, bucket
    for depth in range(0, max(shallow, 1), 8):  # multikey quicksort, eight bytes a symbol
        key = words[at[members] + depth].copy().view(">u8").ravel().astype(np.uint64) if shallow else np.zeros(len(members), np.uint64)
        order, group_at = _groups(key, group)
        shared = np.bincount(group_at, minlength=1)[group_at] > 1
        members, group = members[order][shared], group_at[shared]
    rest = length - shallow
    if not len(members):
        return classes
    if not rest:
        firsts = np.flatnonzero(np.diff(group, prepend=-1))
        classes[members] = np.repeat(members[firsts], np.diff(np.append(firsts, len(group))))
        return classes
    tails = np.lib.stride_tricks.sliding_window_view(buffer, rest)
    while len(members):  # blind tries, one level of all of them at a time
        rows = tails[at[members] + shallow]
        firsts = np.flatnonzero(np.diff(group, prepend=-1))
        counts = np.diff(np.append(firsts, len(group)))
        differs = rows != np.repeat(rows[firsts], counts, 0)
        common = np.where(differs.any(1), differs.argmax(1), rest)
        skip = np.repeat(np.minimum.reduceat(common, firsts), counts)
        leaf = skip == rest
        classes[members[leaf]] = np.repeat(members[firsts], counts)[leaf]
        inner = ~leaf
        branch = rows[inner, skip[inner]]
        members = members[inner]
        order, group_at = _groups(branch, group[inner])
        shared = np.bincount(group_at, minlength=1)[group_at] > 1 if len(group_at) else np.zeros(0, bool)
        members, group = members[order][shared], group_at[shared]
    return classes


def _first_places(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """Least places of all strings of whole buckets; runs of them that stand together."""
    contents = frame["bytes"].tolist()
    sizes = np.array([len(b) for b in contents], np.int64)
    n = sizes - length + 1
    base = np.cumsum(sizes) - sizes
    buffer = np.frombuffer(b"".join(contents) + bytes(8), np.uint8)
    row = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    anchor = frame["k1"].to_numpy()
    # the place of a string before its anchor: equal strings agree in it
    bucket = np.unique(anchor, return_inverse=True)[1][row] * (2 * length) + (frame["place"].to_numpy()[row] - j)
    classes = equal_suffixes(buffer, base[row] + j, bucket, length)
    ids, start = frame["id"].to_numpy()[row], frame["start"].to_numpy()[row].astype(np.int64) + j
    order = np.lexsort((start, ids, classes))
    head = np.flatnonzero(np.diff(classes[order], prepend=-1))
    source = np.empty(len(order), np.int64)
    source[order] = np.repeat(order[head], np.diff(np.append(head, len(order))))
    first_id, first_start = ids[source], start[source]
    matter = (frame["copies"].to_numpy()[row] > 1) | (first_id != ids) | (first_start != start)
    row, j, first_id, first_start = row[matter], j[matter], first_id[matter], first_start[matter]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(j) != 1) | (np.diff(first_id) != 0) | (np.diff(first_start) != 1)
    heads = np.flatnonzero(new)
    return pd.DataFrame({
        "k1": anchor[row[heads]],
        "k2": frame["k2"].to_numpy()[row[heads]],
        "j": j[heads].astype(np.int32),
        "run": np.diff(np.append(heads, len(row))).astype(np.int32),
        "first_id": first_id[heads],
        "first_start": first_start[heads],
    })


def _string_rows(frames, length: int):
    """A row for each string of contents: its hash, its place, and the content that has it at ``j``."""
    for frame in c.chunks(frames, PIECE):
        joined = np.frombuffer(b"".join(frame["text"]), np.uint8)
        sizes = np.array([len(t) for t in frame["text"]], np.int64)
        n = sizes - length + 1
        row = np.repeat(np.arange(len(n)), n)
        j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = (np.cumsum(sizes) - sizes)[row] + j
        h1, h2 = (c.mixed(c.Windows(symbols[joined]).at(at, at + length)) for symbols in (c.BYTE_SYMBOLS, _OTHERS))
        own = {name: frame[name].to_numpy()[row] for name in ("k1", "k2", "id", "copies")}
        yield pd.DataFrame({"h1": c.signed(h1), "h2": c.signed(h2), **own, "start": frame["start"].to_numpy()[row] + j, "j": j})


def _runs(frames):
    """Rows in order of content and ``j``, those that go on the one before as a run of it."""
    for frame in frames:
        same = (np.diff(frame[k].to_numpy(), prepend=0) == step for k, step in (("k1", 0), ("k2", 0), ("j", 1), ("first_id", 0), ("first_start", 1)))
        new = ~np.logical_and.reduce(list(same))
        new[:1] = True
        heads = np.flatnonzero(new)
        out = frame.iloc[heads].reset_index(drop=True)
        out.insert(3, "run", np.diff(np.append(heads, len(frame))))
        yield out


def _places_by_hash(contents: DataFrame, length: int) -> DataFrame:
    """What ``_first_places`` gives, for contents that are too many for a bucket."""
    strings = c.stored(
        contents.select("k1", "k2", "id", "start", "copies", F.col("bytes").alias("text")).mapInPandas(
            lambda frames: _string_rows(frames, length), "h1 long, h2 long, k1 long, k2 long, id long, copies long, start int, j int"
        )
    )
    least = strings.groupBy("h1", "h2").agg(F.min(F.struct("id", "start")).alias("source"), F.sum("copies").alias("all"))
    late = strings.join(least.where("all > 1").drop("all"), ["h1", "h2"]).where("copies > 1 or source != struct(id, start)")
    late = late.select("k1", "k2", "j", F.col("source.id").alias("first_id"), F.col("source.start").alias("first_start"))
    late = late.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "j")
    return c.stored(late.mapInPandas(_runs, PLACES), (strings,))


def repeated_strings(docs: DataFrame, length: int = 100) -> DataFrame:
    """``id``, ``rk`` and spans (see ``common.packed_spans``): ``n`` strings from byte
    ``start`` on also start earlier. ``docs`` as of ``common.texts``."""

    def anchors(frames):
        for frame in c.chunks(frames, PIECE):
            runs = _walk(frame, length)[-1]
            yield pd.DataFrame({"anchor": c.signed(runs["anchor"]), "content": c.signed(runs["content"])})

    found = c.stored(
        docs.mapInPandas(anchors, "anchor long, content long")
        .groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("content").alias("c1"), F.max("content").alias("c2"))
        .where("n > 1")
        .select("anchor", F.when(F.col("c1") == F.col("c2"), 0).otherwise(1).alias("kind"))
    )
    repeated, branching = (c.BitFilter(found.where(F.col("kind") >= i).select("anchor")) for i in range(2))

    def rows(frames):
        for frame in c.chunks(frames, PIECE):
            joined, sizes, hashes, runs = _walk(frame, length)
            base = np.cumsum(sizes) - sizes
            keep = repeated.passes(runs["anchor"])
            runs = {name: v[keep] for name, v in runs.items()}
            sort = branching.passes(runs["anchor"])
            contents = np.full(len(sort), None, object)
            contents[sort] = [joined[a:b].tobytes() for a, b in zip(runs["first"][sort], runs["last"][sort] + length)]
            yield pd.DataFrame({
                "k1": c.signed(runs["anchor"]),
                # the only content of its anchor needs no name
                "k2": c.signed(np.where(sort, runs["content"], c.U64(0))),
                "id": frame["id"].to_numpy()[runs["text"]],
                "rk": frame["rk"].to_numpy()[runs["text"]],
                "start": (runs["first"] - base[runs["text"]]).astype(np.int32),
                "n": (runs["last"] - runs["first"] + 1).astype(np.int32),
                "bytes": contents,
                "place": np.where(sort, runs["place"] - runs["first"], 0).astype(np.int32),
            })

    parts = c.stored(docs.mapInPandas(rows, ROWS + ", place int"), (found,), "zstd")
    for used in (repeated, branching):
        used.map.destroy()
    whole = parts.where("bytes is null")
    least = F.min(F.struct("id", "start")).alias("source")
    sources = whole.groupBy("k1").agg(least, F.count("*").alias("copies")).where("copies > 1").drop("copies")
    simple = whole.join(sources, "k1").where(F.struct("id", "start") > F.col("source")).select("id", "rk", "start", "n")
    # each step ends in a table of its own, so what it shuffled is gone before the next one
    simple = c.stored(simple)

    mixed = parts.where("bytes is not null")
    # bytes are sent for one occurrence of a content only, which is chosen without them
    least = F.min(F.struct("id", "start")).alias("s")
    chosen = c.stored(mixed.groupBy("k1", "k2").agg(least, F.count("*").alias("copies")).select("k1", "k2", "s.*", "copies"))
    crowded = c.stored(chosen.groupBy("k1").count().where(F.col("count") > HOT).select("k1"))
    passes = c.BitFilter(chosen.select(F.xxhash64("k1", "k2", "id", "start").alias("key")), CHOSEN_BITS)

    def fetched(frames):
        for frame in frames:
            good = passes.passes(frame["key"].to_numpy().view(c.U64))
            yield frame.loc[good, ["k1", "k2", "id", "start", "place", "bytes"]]

    keyed = mixed.select("k1", "k2", "id", "start", "place", "bytes", F.xxhash64("k1", "k2", "id", "start").alias("key"))
    rows_of = keyed.mapInPandas(fetched, "k1 long, k2 long, id long, start int, place int, bytes binary").withColumn("copies", F.lit(0))
    rows_of = rows_of.unionByName(chosen, allowMissingColumns=True)

    def contents(rows):
        own = F.min(F.when(F.col("bytes").isNotNull(), F.struct("id", "start", "place", "bytes"))).alias("s")
        return rows.groupBy("k1", "k2").agg(own, F.sum("copies").alias("copies")).select("k1", "k2", "s.*", "copies")

    by_hash = None
    if not crowded.isEmpty():
        by_hash = _places_by_hash(contents(rows_of.join(F.broadcast(crowded), "k1", "left_semi")), length)
        rows_of = rows_of.join(F.broadcast(crowded), "k1", "left_anti")

    def order(frames):
        weigh = lambda held: [len(b) - length + 1 for b in held["bytes"]]
        for held in c.whole_buckets(frames, "k1", weigh, BATCH):
            yield _first_places(held, length)

    places = contents(rows_of.repartition("k1")).sortWithinPartitions("k1").mapInPandas(order, PLACES)
    places = c.stored(places, (chosen, crowded))
    passes.map.destroy()
    done = (parts, places, simple, *([by_hash] if by_hash else []))
    if by_hash:
        places = places.union(by_hash)
    late = mixed.drop("bytes").join(places, ["k1", "k2"]).where("id > first_id or (id = first_id and start + j > first_start)")
    late = late.select("id", "rk", (F.col("start") + F.col("j")).alias("start"), F.col("run").alias("n"))
    return c.stored(c.packed_spans(simple.union(late)), done)


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """Each document with its bytes that no string starting earlier covers.

    ``doc_id``, ``n_bytes``, ``n_removed``, ``kept`` (bytes), ``spans`` (removed runs as first
    byte and length).
    """
    docs = c.texts(docs)
    spans = repeated_strings(docs, length)

    def cut(frames):
        for frame in c.chunks(frames):
            out = []
            for text, spans in zip(frame["text"], frame["spans"]):
                if spans is None or not len(spans):
                    out.append((len(text), 0, text, []))
                    continue
                spans = np.sort(np.asarray(spans, np.int64))
                first, end = spans >> 24, (spans >> 24) + (spans & 0xFFFFFF) + length - 1
                end = np.maximum.accumulate(end)
                heads = np.flatnonzero(np.append(True, first[1:] > end[:-1]))
                runs = list(zip(first[heads].tolist(), end[np.append(heads[1:], len(end)) - 1].tolist()))
                kept, at = [], 0
                for a, b in runs:
                    kept.append(text[at:a])
                    at = b
                out.append((len(text), sum(b - a for a, b in runs), b"".join([*kept, text[at:]]), [[a, b - a] for a, b in runs]))
            done = pd.DataFrame(out, columns=["n_bytes", "n_removed", "kept", "spans"])
            done.insert(0, "id", frame["id"])
            yield done

    return (
        docs.join(spans, ["id", "rk"], "left")
        .select("id", "text", "spans")
        .mapInPandas(cut, "id long, n_bytes long, n_removed long, kept binary, spans array<array<int>>")
        .select(c.shown_id(), "n_bytes", "n_removed", "kept", "spans")
    )

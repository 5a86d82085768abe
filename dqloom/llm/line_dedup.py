"""Removal of lines that an earlier document holds: two Bloom filters.

The first pass keeps two Bloom filters in each task: hashes of lines seen in one document, and
those seen again. Two tasks merge by ``once = a | b`` and ``twice = a2 | b2 | (a & b)``, block by
block, as a stream, so the merge holds two blocks at a time. The merged second filter is of
a fixed size and is broadcast; it passes every line that stands in two documents, and some
others. Only what it passes is shuffled: least and largest document of each line combine
before the shuffle, exact text is compared, and lines of two documents are joined back. The
fuller the filters, the more lines are shuffled; the result stays the same.

In every case: no text or an empty one is one empty line; keys of fewer than ``min_chars``
characters stay; a missing doc_id sorts last; rows that agree in doc_id are one document and
keep each other's lines; extra columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm import common as c

BITS = 27
# Bytes of a block of a filter.
BLOCK = 1 << 14


def keys_of(text: bytes, min_chars: int) -> list[bytes | None]:
    """The key of each line; None for lines that always stay."""
    keys = []
    for line in text.split(b"\n"):
        key = line.strip().lower()
        long = len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode("utf-8", "replace")) >= min_chars
        keys.append(key if long else None)
    return keys


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The two bits of each hash."""
    shift = c.U64(64 - bits)
    return np.stack([hashes >> shift, c.mixed(hashes) >> shift]).astype(np.int64)


def _have(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((bitmap[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(0)


def _add(bitmap: np.ndarray, places: np.ndarray) -> None:
    flat = np.unique(places)
    np.bitwise_or.at(bitmap, flat >> 3, np.left_shift(1, flat & 7).astype(np.uint8))


def seen_twice(docs: DataFrame, min_chars: int, bits: int = BITS) -> np.ndarray:
    """The merged filter of lines that are seen in two documents."""

    def fill(frames):
        once, twice = np.zeros(1 << (bits - 3), np.uint8), np.zeros(1 << (bits - 3), np.uint8)
        for frame in c.chunks(frames):
            per = [{k for k in keys_of(t, min_chars) if k is not None} for t in frame["text"]]
            hashes = np.array([xxhash.xxh3_64_intdigest(k) for keys in per for k in keys], c.U64)
            distinct, counts = np.unique(hashes, return_counts=True)
            places = _places(distinct, bits)
            again = (counts > 1) | (_have(once, places) == 1)
            _add(twice, places[:, again])
            _add(once, places)
        for at in np.flatnonzero(once.reshape(-1, BLOCK).any(1)).tolist():
            pair = [zlib.compress(x[at * BLOCK : (at + 1) * BLOCK].tobytes(), 1) for x in (once, twice)]
            yield pd.DataFrame({"block": [at], "once": pair[:1], "twice": pair[1:]})

    def merge(frames):
        block = once = twice = None
        for frame in frames:
            for b, o, t in zip(frame["block"], frame["once"], frame["twice"]):
                o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
                if b != block:
                    if block is not None:
                        yield pd.DataFrame({"block": [block], "twice": [zlib.compress(twice.tobytes(), 1)]})
                    block, once, twice = b, o, t
                else:
                    once, twice = once | o, twice | t | (once & o)
        if block is not None:
            yield pd.DataFrame({"block": [block], "twice": [zlib.compress(twice.tobytes(), 1)]})

    parts = docs.select("text").mapInPandas(fill, "block long, once binary, twice binary")
    merged = parts.repartition("block").sortWithinPartitions("block").mapInPandas(merge, "block long, twice binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in merged.collect():
        out[row.block * BLOCK : (row.block + 1) * BLOCK] = np.frombuffer(zlib.decompress(row.twice), np.uint8)
    return out


def repeated_lines(docs: DataFrame, min_chars: int = 10, bits: int = BITS) -> DataFrame:
    """``id``, ``rk`` and ``lines``: numbers of lines that an earlier document holds."""
    sent = docs.sparkSession.sparkContext.broadcast(seen_twice(docs, min_chars, bits))

    def suspects(frames):
        for frame in c.chunks(frames):
            out = []
            for i, rk, text in zip(frame["id"], frame["rk"], frame["text"]):
                places: dict[bytes, list[int]] = {}
                for at, key in enumerate(keys_of(text, min_chars)):
                    if key is not None:
                        places.setdefault(key, []).append(at)
                out += [(key, i, rk, lines) for key, lines in places.items()]
            if not out:
                continue
            hashes = np.array([xxhash.xxh3_64_intdigest(row[0]) for row in out], c.U64)
            good = np.flatnonzero(_have(sent.value, _places(hashes, bits)))
            yield pd.DataFrame([out[i] for i in good.tolist()], columns=["key", "id", "rk", "lines"])

    found = c.stored(docs.mapInPandas(suspects, "key binary, id long, rk long, lines array<int>"))
    first = found.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    gone = found.join(first, "key").where("id > first").groupBy("id", "rk")
    return c.stored(gone.agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines")), (found,))


def without_repeats(docs: DataFrame, min_chars: int = 10, bits: int | None = None) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped``, ``kept`` (the lines left, joined by ``\\n``)."""
    docs = c.texts(docs)
    gone = repeated_lines(docs, min_chars, bits or BITS)

    def cut(frames):
        for frame in c.chunks(frames):
            out = []
            for text, lines in zip(frame["text"], frame["lines"]):
                parts = text.split(b"\n")
                drop = set() if lines is None else set(map(int, lines))
                kept = text if not drop else b"\n".join([p for i, p in enumerate(parts) if i not in drop])
                out.append((len(parts), len(drop), kept))
            done = pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])
            done.insert(0, "id", frame["id"])
            yield done

    return (
        docs.join(gone, ["id", "rk"], "left")
        .select("id", "text", "lines")
        .mapInPandas(cut, "id long, n_lines long, n_dropped long, kept binary")
        .select(c.shown_id(), "n_lines", "n_dropped", F.col("kept").cast("string").alias("kept"))
    )

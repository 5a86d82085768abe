"""Exact duplicates by content-defined chunk recipes.

Texts are normalised (A-Z lower-cased, nothing else) and cut where a hash of the last ``WINDOW``
bytes says so, into chunks of ``MIN_CHUNK`` to ``MAX_CHUNK`` bytes. A text is then its recipe, the
ordered list of the identifiers of its chunks, and two texts are equal when their recipes are:

1. every text becomes a recipe of fingerprints; recipes with their counts combine before the
   shuffle, so a long text travels as a few bytes a chunk and copies as one row a task;
2. chunks of texts whose recipe occurs twice are deduplicated by their bytes. A fingerprint that
   stands for one content only is an identifier. Where one stands for several, all fingerprints
   are made longer and step 1 is made again, until every identifier is verified;
3. the row that stays and the group's size go back to the rows of a group. Groups with over
   a thousandth of the rows, fewer than a thousand, are broadcast; others are joined.

Bytes of a chunk travel once a task, and only where its text has a copy. A bitmap tells which recipes
do; it has about a hundred bits for each, up to 32 MB. Beyond that more chunks are compared than need
be, at most each chunk of the corpus once a task; the result is the same.

In every case: a missing text counts as an empty one, and all empty ones are equal; of equal texts
the largest doc_id stays, a missing one only if no row has any; of rows that agree in doc_id
as well, one stays: that with the largest hash of its text as it was; extra columns are not read
by ``marked`` and passed on by ``one_of_each``; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dqloom.llm import common as c

# Bytes of a fingerprint, doubled where one is shared by different chunks.
FINGERPRINT = 16
WIDEST = 64
WINDOW = 16
MIN_CHUNK, MAX_CHUNK = 512, 1 << 14
# One place in so many (as a power of two) ends a chunk.
CHUNK_BITS = 11
PIECE = 1 << 20
# A group with over so small a share of the rows is hot.
HOT_SHARE = 1000
# Bytes of chunks that one task remembers as sent.
REMEMBERED = 16 << 20


def boundaries(data: bytes) -> np.ndarray:
    """Places after which a chunk may end: by the ``WINDOW`` bytes before each, in pieces."""
    found = []
    for start in range(0, max(len(data) - WINDOW + 1, 0), PIECE):
        b = np.frombuffer(data, np.uint8, min(PIECE + WINDOW - 1, len(data) - start), start)
        pairs = b[:-1].astype(np.uint16) | (b[1:].astype(np.uint16) << np.uint16(8))
        fours = pairs[:-2].astype(np.uint32) | (pairs[2:].astype(np.uint32) << np.uint32(16))
        eights = fours[:-4].astype(c.U64) | (fours[4:].astype(c.U64) << c.U64(32))
        stirred = eights[:-8] * c.U64(0x9E3779B97F4A7C15) + eights[8:] * c.U64(0xC2B2AE3D27D4EB4F)
        stirred ^= stirred >> c.U64(29)
        stirred *= c.U64(0xBF58476D1CE4E5B9)
        found.append(np.flatnonzero(stirred >> c.U64(64 - CHUNK_BITS) == 0) + start + WINDOW)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunk_ends(size: int, places: np.ndarray) -> list[int]:
    """Where the chunks of a text of ``size`` bytes end, given its possible ``places``."""
    ends, last = [], 0
    while size - last > MIN_CHUNK:
        i = int(np.searchsorted(places, last + MIN_CHUNK))
        last = min(int(places[i]) if i < len(places) else size, last + MAX_CHUNK, size)
        ends.append(last)
    if last < size:
        ends.append(size)
    return ends


def chunked(texts: list[bytes]) -> list[list[bytes]]:
    """The chunks of each text."""
    joined = b"".join(texts)
    places = boundaries(joined) if any(len(t) > MIN_CHUNK for t in texts) else np.empty(0, np.int64)
    out, at = [], 0
    for text in texts:
        # a place counts for this text only if its whole window lies within it
        low, high = np.searchsorted(places, [at + WINDOW, at + len(text) + 1])
        ends = chunk_ends(len(text), places[low:high] - at)
        out.append([text[a:b] for a, b in zip([0, *ends], ends)])
        at += len(text)
    return out


def fingerprint(chunk: bytes, width: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=width).digest()


def _recipes(docs: DataFrame, width: int) -> DataFrame:
    """``rid``, ``doc_id``, ``rk`` (hash of the text as it was), ``sha`` and ``recipe`` of each row."""

    def cook(frames):
        for frame in c.chunks(frames):
            low = [t.lower() for t in frame["text"]]
            made = [b"".join([fingerprint(x, width) for x in chunks]) for chunks in chunked(low)]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "rk": frame["rk"],
                    "sha": [hashlib.sha256(t).digest() for t in low],
                    "mark": c.signed(np.array([xxhash.xxh3_64_intdigest(r) for r in made], c.U64)),
                    "recipe": made,
                }
            )

    kind = "doc_id long, rk long, sha binary, mark long, recipe binary"
    return c.stored(docs.mapInPandas(cook, kind).withColumn("rid", F.monotonically_increasing_id()))


def _shared(docs: DataFrame, groups: DataFrame, width: int) -> DataFrame:
    """``chunk`` with its fingerprint ``fp`` for each chunk of texts whose recipe occurs twice."""
    passes = c.BitFilter(groups.select("mark"), c.filter_bits(groups.count()))

    def emit(frames):
        sent: dict[bytes, bytes] = {}
        held = 0
        for frame in c.chunks(frames):
            out = {}
            for chunks in chunked([t.lower() for t in frame["text"]]):
                ids = [fingerprint(x, width) for x in chunks]
                mark = np.array([xxhash.xxh3_64_intdigest(b"".join(ids))], c.U64)
                if passes.passes(mark)[0]:
                    # contents are compared, not only fingerprints
                    out.update({(i, x): None for i, x in zip(ids, chunks) if sent.get(i) != x})
            for i, x in out:
                if held + len(x) > REMEMBERED:
                    sent.clear()
                    held = 0
                sent[i] = x
                held += len(x)
            yield pd.DataFrame(list(out), columns=["fp", "chunk"])

    return docs.select("text").mapInPandas(emit, "fp binary, chunk binary")


def _verified(docs: DataFrame, groups: DataFrame, width: int) -> bool:
    """Whether each fingerprint of a repeated recipe stands for one content."""
    contents = _shared(docs, groups, width).distinct().groupBy("fp").count()
    return contents.where("count > 1").isEmpty()


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Recipes of all rows, and of each that occurs twice or more its size ``n`` and the row
    ``top`` that stays. Identifiers are verified."""
    width = FINGERPRINT
    while True:
        rows = _recipes(docs, width)
        groups = rows.groupBy("recipe").agg(
            F.count("*").alias("n"), F.first("mark").alias("mark"), F.max(F.struct("doc_id", "rk", "rid")).alias("top")
        )
        groups = c.stored(groups.where("n > 1"))
        if _verified(docs, groups, width):
            return rows, groups
        if width >= WIDEST:
            raise RuntimeError(f"chunks that differ share {width} bytes of fingerprint")
        width = min(2 * width, WIDEST)


def _source(docs: DataFrame) -> DataFrame:
    docs = c.in_small_batches(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("rk"), F.col("text").cast("binary").alias("text"))


def marked(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``keep_id`` (of the row that stays), ``group_size``, ``kept``, ``text_sha256`` (of
    the normalised text) and ``rk`` for each row of ``docs``."""
    rows, groups = _grouped(_source(docs))
    least = max(rows.count() // HOT_SHARE, 1)
    hot = (F.col("n") > least) & (F.length("recipe") <= 64 * WIDEST)
    # fewer than HOT_SHARE rows of a few KB each
    few = F.broadcast(groups.where(hot).select("recipe", "n", "top"))
    apart = rows.join(F.broadcast(groups.where(hot).select("recipe")), "recipe", "left_anti")
    found = rows.join(few, "recipe").unionByName(apart.join(groups.where(~hot).select("recipe", "n", "top"), "recipe", "left"))
    alone = F.col("n").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("rid") == F.col("top.rid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "rk",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = (f"c{names.index(n)}" for n in ("doc_id", "text"))
    stay = marked(docs).where("kept").select("doc_id", "rk")
    own = plain.withColumns({"id": F.col(doc_id).cast("long"), "own": F.xxhash64(text)})
    kept = own.join(stay, own["id"].eqNullSafe(stay["doc_id"]) & (own["own"] == stay["rk"]), "left_semi")
    # repeated rows agree in both
    nth = F.row_number().over(Window.partitionBy("id", "own").orderBy("own"))
    return kept.withColumn("nth", nth).where("nth = 1").select(*plain.columns).toDF(*names)

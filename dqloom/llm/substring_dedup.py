"""Removal of word sequences that an earlier document holds: De Bruijn compaction.

Every window of ``k`` words is an edge between its first and its last ``k - 1`` words. A
document is a walk over edges. Neighbouring edges with the same anchor (see
``super_windows``) form a path, the unit that travels; an anchor that is seen with one
content only has no branch, so all edges of its path occur in the same places and the path
stays whole. Paths of an anchor that several contents share meet in a bucket, each distinct
content once, where their edges are matched. An anchor with more than ``HOT`` occurrences is
not brought into one bucket: its paths are cut into edges that travel by themselves. Joins on
(hash, hash) find the least document of each path or edge, and the source coordinates
(document, first word) of repeated ones are joined to spans of the text.

Steps and what they shuffle:

1. anchors, one for about five words, with least and largest document and content: counts
   combine before the shuffle, so a hot passage is one row a task;
2. repeated, branching and hot anchors become three bitmaps of fixed size;
3. paths or edges that pass them, with least document per key, joined back. A bitmap that
   fills up lets more rows through and changes no result;
4. spans by document, joined to the texts.

Edges are told apart by 128 bits, two of its hash functions or its anchor and one. Results, in every case: no text or fewer than ``k`` words:
nothing removed; rows that agree in doc_id are one document, so they never remove each
other's words; a missing doc_id sorts last; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm import common as c

ANCHOR_WORDS = 5
HOT = 4096
# Edges matched together in a task; a bucket is never split.
BATCH = 500_000
ROWS = "k1 long, k2 long, id long, rk long, start int, n int, edges binary"


def _walk(frame: pd.DataFrame, k: int):
    sizes, symbols = c.hashed_words(frame["text"].tolist())
    hashes = c.Windows(symbols)
    return sizes, symbols, hashes, c.super_windows(hashes, sizes, k, min(ANCHOR_WORDS, k))


def _sources(held: pd.DataFrame) -> pd.DataFrame:
    """Least document of each edge of whole buckets; runs of edges with one source."""
    edges = [np.frombuffer(b, np.int64) for b in held["edges"]]
    n = np.array([len(e) for e in edges])
    row = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    edge, anchor, lo = np.concatenate(edges), held["k1"].to_numpy()[row], held["lo"].to_numpy()[row]
    order = np.lexsort((lo, edge, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(edge[order]) != 0) | (np.diff(anchor[order]) != 0)
    head = np.flatnonzero(new)
    source = np.empty(len(order), np.int64)
    source[order] = np.repeat(lo[order][head], np.diff(np.append(head, len(order))))
    matter = source < held["hi"].to_numpy()[row]
    row, j, source = row[matter], j[matter], source[matter]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(j) != 1) | (np.diff(source) != 0)
    heads = np.flatnonzero(new)
    return pd.DataFrame({
        "k1": held["k1"].to_numpy()[row[heads]],
        "k2": held["k2"].to_numpy()[row[heads]],
        "j": j[heads].astype(np.int32),
        "run": np.diff(np.append(heads, len(row))).astype(np.int32),
        "source": source[heads],
    })


def repeated_spans(docs: DataFrame, k: int = 13) -> DataFrame:
    """``id``, ``rk`` and spans (see ``common.packed_spans``): ``n`` windows from word
    ``start`` on also start in an earlier document. ``docs`` as of ``common.texts``."""

    def anchors(frames):
        for frame in c.chunks(frames):
            runs = _walk(frame, k)[-1]
            yield pd.DataFrame({"anchor": c.signed(runs["anchor"]), "content": c.signed(runs["content"]), "id": frame["id"].to_numpy()[runs["text"]]})

    found = c.stored(
        docs.mapInPandas(anchors, "anchor long, content long, id long")
        .groupBy("anchor")
        .agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.min("content").alias("c1"), F.max("content").alias("c2"), F.count("*").alias("n"))
        .where("lo < hi")
        .select("anchor", F.when(F.col("c1") == F.col("c2"), 0).when(F.col("n") <= HOT, 1).otherwise(2).alias("kind"))
    )
    repeated, branching, hot = (c.BitFilter(found.where(F.col("kind") >= i).select("anchor")) for i in range(3))

    def paths(frames):
        for frame in c.chunks(frames):
            sizes, symbols, hashes, runs = _walk(frame, k)
            base = np.cumsum(sizes) - sizes
            keep = repeated.passes(runs["anchor"])
            runs = {name: v[keep] for name, v in runs.items()}
            shared = branching.passes(runs["anchor"])
            cut = shared & hot.passes(runs["anchor"])
            shared &= ~cut
            n = runs["last"] - runs["first"] + 1
            at = np.repeat(runs["first"][cut] - (np.cumsum(n[cut]) - n[cut]), n[cut]) + np.arange(n[cut].sum())
            other = c.Windows(c.mixed(symbols)) if len(at) else hashes
            parts = [
                (~(shared | cut), runs["anchor"], runs["content"], runs["text"], runs["first"], n),
                (slice(None), c.mixed(hashes.at(at, at + k)), c.mixed(other.at(at, at + k)), np.repeat(runs["text"][cut], n[cut]), at, np.ones(len(at), np.int64)),
                (shared, runs["anchor"], runs["content"], runs["text"], runs["first"], n),
            ]
            edges = hashes.every(k)
            packed = [edges[a : b + 1].tobytes() for a, b in zip(runs["first"][shared], runs["last"][shared])]
            k1, k2, text, start, n = (np.concatenate([p[i][p[0]] for p in parts]) for i in range(1, 6))
            yield pd.DataFrame({
                "k1": c.signed(k1),
                "k2": c.signed(k2),
                "id": frame["id"].to_numpy()[text],
                "rk": frame["rk"].to_numpy()[text],
                "start": (start - base[text]).astype(np.int32),
                "n": n.astype(np.int32),
                "edges": [None] * (len(k1) - len(packed)) + packed,
            })

    rows = c.stored(docs.mapInPandas(paths, ROWS))
    whole, shared = rows.where("edges is null").drop("edges"), rows.where("edges is not null")
    sources = whole.groupBy("k1", "k2").agg(F.min("id").alias("source"), F.max("id").alias("hi")).where("source < hi").drop("hi")
    spans = whole.join(sources, ["k1", "k2"]).where("id > source").select("id", "rk", "start", "n")
    contents = shared.groupBy("k1", "k2").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.first("edges").alias("edges"))

    def bucket(frames):
        weigh = lambda held: [len(b) >> 3 for b in held["edges"]]
        for held in c.whole_buckets(frames, "k1", weigh, BATCH):
            yield _sources(held)

    edges = contents.repartition("k1").sortWithinPartitions("k1").mapInPandas(bucket, "k1 long, k2 long, j int, run int, source long")
    edges = c.stored(edges, (found,))
    cut = shared.drop("edges").join(edges, ["k1", "k2"]).where("id > source")
    cut = cut.select("id", "rk", (F.col("start") + F.col("j")).alias("start"), F.col("run").alias("n"))
    return c.stored(c.packed_spans(spans.union(cut)), (rows, edges))


def without_repeats(docs: DataFrame, k: int = 13) -> DataFrame:
    """Each document with its words that no earlier document holds in a window of ``k``.

    ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the words left, joined by a space),
    ``spans`` (removed runs as first word and length).
    """
    docs = c.texts(docs)
    spans = repeated_spans(docs, k)

    def cut(frames):
        for frame in c.chunks(frames):
            out = []
            for text, spans in zip(frame["text"], frame["spans"]):
                words = text.split()
                if spans is None or not len(spans):
                    out.append((len(words), 0, b" ".join(words), []))
                    continue
                spans = np.asarray(spans, np.int64)
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, spans >> 24, 1)
                np.add.at(edge, (spans >> 24) + (spans & 0xFFFFFF) + k - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                out.append((len(words), int(gone.sum()), left, [[int(a), int(b - a)] for a, b in zip(turns[::2], turns[1::2])]))
            done = pd.DataFrame(out, columns=["n_words", "n_removed", "kept", "spans"])
            done.insert(0, "id", frame["id"])
            yield done

    return (
        docs.join(spans, ["id", "rk"], "left")
        .select("id", "text", "spans")
        .mapInPandas(cut, "id long, n_words long, n_removed long, kept binary, spans array<array<int>>")
        .select(c.shown_id(), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"), "spans")
    )

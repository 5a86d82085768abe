"""Benchmark passages in documents: Wu-Manber search for many patterns at once.

Patterns are the windows of ``window`` words of the items; an item of fewer words is one
pattern. Symbols are words. Patterns of one length form one search: a block is ``BLOCK``
words (one where the patterns are that short). The shift table, indexed by a hash of the
block that ends at the cursor, says how many words the cursor may skip; where it says none,
the suffix hash leads to a bucket of patterns, whose first words are compared by hash and
then all words directly. Cursors stand in all stretches of a batch of texts and move
together, which makes each step one array operation.

The patterns are sent to the tasks, not the documents to the patterns. Items are split into
blocks of at most ``BLOCK_BYTES`` of text, each one broadcast of bounded size and one pass; the
documents are not shuffled, whatever their size. An item with more text than that is a block
of its own.

In every case: no text: no words; no items: nothing hit; repeated items with one item_id are one
item; a missing item_id hits words but is not listed; extra columns are passed on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm import common as c

BLOCK = 2
TABLE_BITS = 18
# Words a cursor walks over.
STRETCH = 512
BLOCK_BYTES = 8 << 20
# Letters are lowered, and every ASCII character but digits and letters ends a word.
_FOLD = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in bytes(range(256)).lower()[:128] + bytes(range(128, 256)))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _block_hash(symbols: np.ndarray, size: int) -> np.ndarray:
    """The table place of the block that starts at each symbol."""
    value = symbols[: len(symbols) - size + 1].copy()
    for j in range(1, size):
        value = value * c.U64(c.Windows.BASE) + symbols[j : len(symbols) - size + 1 + j]
    return (c.mixed(value) >> c.U64(64 - TABLE_BITS)).astype(np.int64)


class Search:
    """Tables for all patterns of one length."""

    def __init__(self, patterns: list[tuple[bytes, ...]], owners: list[np.ndarray]):
        self.patterns, self.owners = patterns, owners
        self.m = m = len(patterns[0])
        self.block = block = min(BLOCK, m)
        symbols = np.stack([c.word_hashes(list(p)) for p in patterns])
        places = np.stack([_block_hash(row, block) for row in symbols])
        self.shift = np.full(1 << TABLE_BITS, m - block + 1, np.int64)
        for j in range(m - block + 1):
            np.minimum.at(self.shift, places[:, j], m - block - j)
        order = np.argsort(places[:, -1], kind="stable")
        self.bucket = order
        self.starts = np.searchsorted(places[order, -1], np.arange((1 << TABLE_BITS) + 1))
        self.symbols = symbols

    def hits(self, words: list[bytes], symbols: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
        """Places and patterns that occur; ``ends``: end of the text each word is in."""
        m, block = self.m, self.block
        if len(symbols) < m:
            return []
        table = _block_hash(symbols, block)
        cursor = np.arange(m - block, len(table), STRETCH)  # the block that ends a window
        limit = np.minimum(cursor + STRETCH, len(table))
        found = []
        while len(cursor):
            at = table[cursor]
            shift = self.shift[at]
            stop = shift == 0
            if stop.any():
                place, bucket = cursor[stop] - (m - block), at[stop]
                count = self.starts[bucket + 1] - self.starts[bucket]
                place = np.repeat(place, count)
                nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                pattern = self.bucket[np.repeat(self.starts[bucket], count) + nth]
                good = (symbols[place] == self.symbols[pattern, 0]) & (place + m <= ends[place])
                for p, q in zip(place[good].tolist(), pattern[good].tolist()):
                    if tuple(words[p : p + m]) == self.patterns[q]:
                        found.append((p, q))
            cursor = cursor + np.maximum(shift, 1)
            live = cursor < limit
            cursor, limit = cursor[live], limit[live]
        return found


def searches(items: list[tuple[int | None, bytes]], window: int) -> list[Search]:
    """One search for each length of pattern; owners are numbers of items."""
    by_length: dict[int, dict[tuple, set]] = {}
    for number, (_, text) in enumerate(items):
        words = words_of(text or b"")
        m = min(window, len(words))
        for at in range(len(words) - m + 1 if m else 0):
            by_length.setdefault(m, {}).setdefault(tuple(words[at : at + m]), set()).add(number)
    return [Search(list(p), [np.array(sorted(x)) for x in p.values()]) for _, p in sorted(by_length.items())]


def _blocks(items: DataFrame) -> list[list[tuple[int | None, bytes]]]:
    """The items in parts of bounded size, each fetched by itself."""
    items = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    bulk = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    parts = -(-bulk * 2 // BLOCK_BYTES) if bulk > BLOCK_BYTES else 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    return [[(r.item, bytes(r.text or b"")) for r in items.where(part == i).distinct().collect()] for i in range(parts)]


def marked(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``found``: ``n_words``, ``n_hit``, ``items`` (sorted item ids),
    ``hit`` (runs of hit words as first word and length)."""
    spark, names = docs.sparkSession, docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    state = plain.withColumn("found", F.lit(None).cast("struct<n_words:long,n_hit:long,items:array<string>,hit:array<array<int>>>"))
    where = names.index(text)
    blocks = _blocks(items)
    schema = state.schema
    for block in blocks:
        sent = spark.sparkContext.broadcast((searches(block, window), [i for i, _ in block]))

        def look(frames, sent=sent, where=where):
            tables, ids = sent.value
            for frame in frames:
                parts = frame[[f"c{where}"]].rename(columns={f"c{where}": "text"})
                parts["text"] = [t.encode() if isinstance(t, str) else t for t in parts["text"]]
                results = [r for piece in c.chunks(iter([parts])) for r in _look(piece["text"].tolist(), tables, ids)]
                frame["found"] = [_joined(a, b) for a, b in zip(frame["found"], results)]
                yield frame

        state = state.mapInPandas(look, schema)
    return c.under(state, names, "found")


def _look(batch: list[bytes], tables: list[Search], ids: list) -> list[dict]:
    per = [words_of(t) for t in batch]
    sizes = np.array([len(w) for w in per], np.int64)
    words = [w for doc in per for w in doc]
    symbols = c.word_hashes(words)
    ends = np.repeat(np.cumsum(sizes), sizes)
    edge = np.zeros(len(words) + 1, np.int64)
    listed: dict[int, set] = {}
    text_of = np.repeat(np.arange(len(per)), sizes)
    for table in tables:
        for place, pattern in table.hits(words, symbols, ends):
            edge[place] += 1
            edge[place + table.m] -= 1
            listed.setdefault(int(text_of[place]), set()).update(ids[i] for i in table.owners[pattern])
    hit = np.cumsum(edge[:-1]) > 0
    out, at = [], 0
    for i, n in enumerate(sizes.tolist()):
        mine = hit[at : at + n]
        turns = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]]))).tolist() if i in listed else []
        out.append({"n_words": n, "n_hit": int(mine.sum()), "items": sorted(x for x in listed.get(i, ()) if x is not None), "hit": [[a, b - a] for a, b in zip(turns[::2], turns[1::2])]})
        at += n
    return out


def _joined(before, now: dict) -> dict:
    """The finds of an earlier block of items with those of this one."""
    if before is None or not isinstance(before, dict) and not len(before):
        return now
    before = before if isinstance(before, dict) else before.asDict()
    flags = np.zeros(now["n_words"], bool)
    for a, n in [*before["hit"], *now["hit"]]:
        flags[a : a + n] = True
    turns = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))).tolist()
    return {
        "n_words": now["n_words"],
        "n_hit": int(flags.sum()),
        "items": sorted({*before["items"], *now["items"]}),
        "hit": [[a, b - a] for a, b in zip(turns[::2], turns[1::2])],
    }


def clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with their own columns."""
    names = docs.columns
    kept = marked(docs.toDF(*[f"c{i}" for i in range(len(names))]), items, window, f"c{names.index('text')}")
    return kept.where("found.n_hit = 0").drop("found").toDF(*names)


"""Spelling variants: words one edit apart, by asymmetric chunks and positional grams.

Words are counted with their occurrences combined in each task. Then of two words one edit apart, the
longer one (the smaller one if equal) contributes chunks and the other grams:

1. the longer word gives two disjoint chunks, its first and its last ``length // 2`` code points.
   One edit touches at most one of them, so the other is whole;
2. the shorter one gives its positional grams of that size. Of all its positions only those
   within the shift that one edit can make hold a chunk: none for the first chunk, the
   difference of the lengths (0 or 1) for the last;
3. what the whole chunk leaves of both words is one edit apart too, and is cut once more in the
   same way. Both chunks together are the key of the join, so that words with a common
   beginning or end are not all compared with each other;
4. the words of a key are verified by their edit distance, inside the join.

A pair whose both chunks are whole would be met twice; it counts at the first only.

``form`` of a word is the near word of the largest count where that is at least ``RATIO`` times its
own. Counts grow along forms, so following them ends; each round of ``root`` doubles the steps.

In every case: a missing text has no words; a missing doc_id counts as empty text; repeated rows
count as often as they stand; extra columns are not read; an empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.llm import common as c

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
# One (document, word) in so many loses a code point.
TYPO_STEP = 199
LETTERS = "A-Za-zÀ-ÿ"
# Code points of a text that are split at a time.
PIECE = 1 << 20
# Words that one task holds before it passes their counts on.
HELD = 100_000
_OTHER = re.compile(f"[^{LETTERS}]")


def pieces(text: str):
    """The text in pieces that end between words."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            gap = _OTHER.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def words_of(doc_id: str, text: bytes, runs: re.Pattern) -> Counter:
    """The words of a text, mistyped ones as they come out, and how often each occurs."""
    found: Counter = Counter()
    for piece in pieces(text.lower().decode("utf-8", "replace")):
        found.update(runs.findall(piece))
    begun, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, n in found.items():
        h = zlib.crc32(run.encode(), begun)
        if h % TYPO_STEP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def counted(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n`` of the words of at least ``min_length`` code points and ``min_count`` occurrences."""
    runs = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def count(frames):
        held: Counter = Counter()
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                if text:
                    held.update(words_of(doc_id, text, runs))
                if len(held) >= HELD:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    docs = c.in_small_batches(docs)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = texts.mapInPandas(count, "word string, n long").where(F.char_length("word") >= min_length)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _half(text: Column, size: Column, first: bool) -> Column:
    return F.substring(text, F.lit(1), size) if first else F.substring(text, F.char_length(text) - size + 1, size)


def _keys(words: DataFrame, longer: int) -> DataFrame:
    """``word``, ``n`` with the keys it gives where the chunks are of a word ``longer`` code points longer.

    A key: the length of the longer word, which half is whole, that half, which half of the
    rest is whole, and that half of it.
    """
    word, size = F.col("word"), F.col("size")
    rows = words.withColumn("size", F.char_length("word") + longer)
    q = F.expr("size div 2")
    found = []
    for first in (True, False):
        own = F.char_length(word) - q
        rest = F.substring(word, q + 1, own) if first else F.substring(word, F.lit(1), own)
        left = size - q
        for inner in (True, False):
            part = F.floor(left / 2).cast("int")
            key = F.struct(size.alias("size"), F.lit(first).alias("a"), _half(word, q, first).alias("chunk"), F.lit(inner).alias("b"), _half(rest, part, inner).alias("part"))
            found.append(key)
    return rows.select("word", "n", F.explode(F.array(*found)).alias("key")).select("word", "n", "key.*")


def near(words: DataFrame) -> DataFrame:
    """Pairs ``x``, ``y`` of ``words`` exactly one edit apart, each once, with ``nx`` and ``ny``."""
    key = ["size", "a", "chunk", "b", "part"]
    left = _keys(words, 0).withColumnsRenamed({"word": "x", "n": "nx"})
    right = _keys(words, 0).withColumn("longer", F.lit(0)).union(_keys(words, 1).withColumn("longer", F.lit(1)))
    right = right.withColumnsRenamed({"word": "y", "n": "ny"})
    met = left.join(right, key)
    q, rest = F.expr("size div 2"), F.expr("(size - size div 2) div 2")
    x, y = F.col("x"), F.col("y")
    ends = lambda w, first: F.when(first, F.substring(w, q + 1, F.char_length(w) - q)).otherwise(F.substring(w, F.lit(1), F.char_length(w) - q))
    once = (F.col("longer") == 1) | (x < y)
    # the last chunk counts only where the first is not whole, in both cuts
    once &= F.col("a") | (_half(x, q, True) != _half(y, q, True))
    once &= F.col("b") | (_half(ends(x, F.col("a")), rest, True) != _half(ends(y, F.col("a")), rest, True))
    return met.where(once & (F.levenshtein(x, y, 1) == 1)).select("x", "y", "nx", "ny")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last of its forms. ``forms``: ``word``, ``form``."""
    now, old = c.stored(forms.select("word", F.col("form").alias("root"))), ()
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = c.stored(step, (now, *old))
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        now, old = step.select("word", "root"), ()
        now.scratch_path = step.scratch_path


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: float = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of each word of ``docs``."""
    words = c.stored(counted(docs, min_length, min_count))
    pairs = c.stored(near(words))
    both = pairs.select(F.col("x").alias("word"), F.col("y").alias("other"), F.col("ny").alias("m"))
    both = both.union(pairs.select("y", "x", "nx"))
    # the largest count, of equal ones the smallest word
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    found = words.join(best, "word", "left")
    has = -F.col("best.m") >= F.lit(ratio) * F.col("n")
    found = found.select(
        "word",
        F.when(has, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, -F.col("best.m")).alias("form_n"),
    )
    found = c.stored(found, (words, pairs))
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

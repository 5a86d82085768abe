"""Helpers shared by the operators: scratch tables, word hashes, bit filters, components."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows without doc_id sort after all others.
LAST_ID = 2**63 - 1
# Texts are worked on in pieces of about this many bytes, a longer text alone.
CHUNK_BYTES = 1 << 20
# Words whose hashes one Python worker remembers.
VOCABULARY = 400_000
# Arrow sends texts to Python in batches of at most this many bytes, a longer text alone.
BATCH_BYTES = 8 << 20
# Whether Spark drops the shuffle files of an execution when it ends.
DROPS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
U64 = np.uint64


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share. A folder of this machine only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, instead_of: tuple[DataFrame, ...] = (), codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again.

    This cuts lineage: a lost executor costs a read of these files. What the write
    shuffled is not needed any more, so Spark drops those files when the write ends; what other
    jobs shuffled goes as the driver's garbage is collected. ``instead_of``: stored frames that
    nothing needs after this one; their files go at once, all others when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(DROPS_SHUFFLES, None)
    spark.conf.set(DROPS_SHUFFLES, "true")
    try:
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    finally:
        spark.conf.unset(DROPS_SHUFFLES) if before is None else spark.conf.set(DROPS_SHUFFLES, before)
    files = _files(spark, path)
    files[0].deleteOnExit(files[1])
    for old in instead_of:
        system, at = _files(spark, old.scratch_path)
        system.delete(at, True)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    read = spark.read.schema(df.schema).parquet(path)
    read.scratch_path = path
    return read


def _files(spark: SparkSession, path: str) -> tuple:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def packed_spans(spans: DataFrame) -> DataFrame:
    """``id``, ``rk`` and their spans, each one long: start in the high bits, ``n`` in the last 24."""
    one = F.shiftleft(F.col("start").cast("long"), 24) + F.col("n")
    return spans.groupBy("id", "rk").agg(F.collect_set(one).alias("spans"))


def in_small_batches(docs: DataFrame, limit: int = BATCH_BYTES) -> DataFrame:
    """``docs``, in a session that bounds Arrow batches by ``limit`` bytes, or by less where it does so."""
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(conf.get(key).rstrip("b")) <= limit:
        conf.set(key, str(limit))
    return docs


def texts(docs: DataFrame, *more: Column) -> DataFrame:
    """``id`` (missing: the largest), ``rk`` (hash of the text) and ``text`` as bytes.

    ``id`` and ``rk`` name a row; rows that agree in both are copies and share results.
    """
    docs = in_small_batches(docs)
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64("text").alias("rk"),
        F.col("text").cast("binary").alias("text"),
        *more,
    )


def shown_id(column: str = "id") -> Column:
    return F.when(F.col(column) != LAST_ID, F.col(column)).alias("doc_id")


def under(found: DataFrame, names: list[str], result: str) -> DataFrame:
    """Columns ``c0`` and on under their names again, and ``result``, in whose place no input column stays."""
    own = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n.lower() != result]
    return found.select(*own, result)


def chunks(frames: Iterator[pd.DataFrame], limit: int = CHUNK_BYTES) -> Iterator[pd.DataFrame]:
    """The rows in pieces of about ``limit`` bytes of text; missing texts are empty."""
    for frame in frames:
        frame["text"] = [t or b"" for t in frame["text"]]
        ends = np.cumsum([len(t) + 64 for t in frame["text"]])
        at = 0
        while at < len(frame):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield frame.iloc[at:to].reset_index(drop=True)
            at = to


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= VOCABULARY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def forget_words() -> None:
    """At the end of a task: its worker goes on to other tasks, of other operators too, for which this is lost memory."""
    _HASHES.clear()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), U64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each value stirred so that all its bits depend on all bits of the input."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


class Windows:
    """Hashes of any stretch of a sequence of 64-bit symbols, from one running sum."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 2**64)
    _powers = (np.ones(1, U64), np.ones(1, U64))

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        if len(Windows._powers[0]) <= n:
            size = max(1 << 16, 2 * n)
            steps = []
            for base in (self.BASE, self.INVERSE):
                step = np.full(size, base, U64)
                step[0] = 1
                steps.append(np.cumprod(step))
            Windows._powers = tuple(steps)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(symbols * Windows._powers[0][:n], out=self.sums[1:])

    def every(self, length: int) -> np.ndarray:
        """The hash of each stretch of ``length`` symbols."""
        if len(self.sums) <= length:
            return np.empty(0, U64)
        out = self.sums[length:] - self.sums[:-length]
        out *= Windows._powers[1][: len(out)]
        return out

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * Windows._powers[1][start]


# A 64-bit symbol for each byte.
BYTE_SYMBOLS = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_SPACES = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def hashed_words(batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """How many words each text has, and a 64-bit hash of each word, text after text.

    White space of ASCII ends a word. No word is made a Python object.
    """
    joined = np.frombuffer(b"".join([t + b" " for t in batch]), np.uint8)
    turns = np.flatnonzero(np.diff(_SPACES[joined].astype(np.int8), prepend=1, append=1))
    starts, ends = turns[::2], turns[1::2]
    hashes = mixed(Windows(BYTE_SYMBOLS[joined]).at(starts, ends) + mixed((ends - starts).astype(U64)))
    bounds = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in batch]))
    return np.diff(bounds), hashes


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def super_windows(hashes: Windows, sizes: np.ndarray, k: int, m: int) -> dict[str, np.ndarray]:
    """Runs of windows that share their anchor.

    The texts of ``sizes`` symbols stand one after the other. Every window of ``k`` symbols
    within one text is owned by its anchor, the least of the hashes of its stretches of
    ``m`` symbols, the first one if equal. Neighbouring windows with one anchor form a run:
    ``text`` (its number), ``first`` and ``last`` window, ``anchor`` hash, and ``content``,
    the hash of all symbols the run covers with the place of its anchor.
    """
    ends = np.cumsum(sizes)
    small = hashes.every(m)
    if not len(small) or len(hashes.sums) <= k:
        none = np.empty(0, np.int64)
        return {"text": none, "first": none, "last": none, "anchor": none.view(U64), "content": none.view(U64), "place": none}
    stirred = mixed(small)
    stirred &= U64(0xFFFFFFFF00000000)
    stirred |= np.arange(len(small), dtype=U64)
    place = (sliding_min(stirred, k - m + 1) & U64(0xFFFFFFFF)).astype(np.int64)
    full = np.ones(len(place), bool)
    for back in range(1, k):  # windows that reach over the end of a text
        over = ends[:-1] - back
        full[over[(over >= 0) & (over < len(full))]] = False
    valid = np.flatnonzero(full)
    if not len(valid):
        return super_windows(Windows(np.empty(0, U64)), sizes[:0], k, m)
    at = place[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)
    begins = np.flatnonzero(new)
    first, last, place = valid[begins], valid[np.append(begins[1:], len(valid)) - 1], at[begins]
    content = mixed(hashes.at(first, last + k) + mixed((place - first).astype(U64) * U64(1 << 20) + (last - first).astype(U64)))
    return {
        "text": np.searchsorted(ends, first, "right"),
        "first": first,
        "last": last,
        "anchor": mixed(small[place]),
        "content": content,
        "place": place,
    }


def whole_buckets(frames: Iterator[pd.DataFrame], key: str, weigh, limit: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by ``key`` in pieces of whole keys that weigh about ``limit`` or less."""
    held = None
    for frame in frames:
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        keys, weights = held[key].to_numpy(), np.cumsum(weigh(held))
        ends = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        at = 0
        for i, end in enumerate(ends):
            if i + 1 == len(ends) or weights[ends[i + 1] - 1] - (weights[at - 1] if at else 0) > limit:
                yield held.iloc[at:end].reset_index(drop=True)
                at = end
        held = held.iloc[at:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


# The narrowest and the widest filter, as powers of two; the widest takes 32 MB.
FILTER_BITS = 17, 28


def filter_bits(members: int) -> int:
    """Width of a filter that has about a hundred bits for each member, up to the widest."""
    return min(max(members.bit_length() + 6, FILTER_BITS[0]), FILTER_BITS[1])


class BitFilter:
    """Which hashes may be in a set: a bitmap of a given size.

    No member is ever missed. The fuller the bitmap, the more others pass, so what
    passes is always confirmed by a join or an aggregation afterwards.
    """

    BLOCK = 16

    def __init__(self, hashes: DataFrame, bits: int = 27):
        """``hashes``: one column of longs, evenly spread; ``bits``: log2 of the bits."""
        name = hashes.columns[0]
        word = F.shiftrightunsigned(name, 64 - bits)
        mask = (1 << self.BLOCK) - 1

        def fill(frame: pd.DataFrame) -> pd.DataFrame:
            flags = np.zeros(mask + 1, bool)
            flags[(frame["bit"].to_numpy() & mask)] = True
            return pd.DataFrame({"block": frame["block"][:1], "map": [np.packbits(flags).tobytes()]})

        rows = (
            hashes.select(word.alias("bit"))
            .distinct()
            .withColumn("block", F.shiftright("bit", self.BLOCK))
            .groupBy("block")
            .applyInPandas(fill, "block long, map binary")
            .collect()
        )
        size = mask // 8 + 1
        whole = bytearray(1 << (bits - 3))
        for row in rows:
            whole[row.block * size : (row.block + 1) * size] = row.map
        self.bits = bits
        self.map = hashes.sparkSession.sparkContext.broadcast(bytes(whole))

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> U64(64 - self.bits)
        have = np.frombuffer(self.map.value, np.uint8)[at >> U64(3)]
        return (have >> (U64(7) - (at & U64(7))).astype(np.uint8)) & 1 == 1


def task_sums(frame: DataFrame, add, cells: int, block: int = 1 << 14) -> np.ndarray:
    """Sums of a vector of fixed length over all rows.

    ``add(frames)`` gives the vector of one task. Tasks pass on the places that are not 0,
    by block; blocks are summed as a stream, one at a time.
    """

    def parts(frames):
        vector = add(frames)
        for b in range(0, cells, block):
            piece = vector[b : b + block]
            at = np.flatnonzero(piece).astype(np.int16 if block <= 1 << 15 else np.int32)
            if len(at):
                yield pd.DataFrame({"block": [b // block], "at": [at.tobytes()], "sums": [piece[at].astype(np.int32).tobytes()]})

    kind = np.int16 if block <= 1 << 15 else np.int32

    def total(frames):
        now, out = None, np.zeros(block, np.int64)
        for frame in frames:
            for b, at, sums in zip(frame["block"], frame["at"], frame["sums"]):
                if b != now:
                    if now is not None:
                        yield pd.DataFrame({"block": [now], "sums": [out.tobytes()]})
                    now, out = b, np.zeros(block, np.int64)
                out[np.frombuffer(at, kind)] += np.frombuffer(sums, np.int32)
        if now is not None:
            yield pd.DataFrame({"block": [now], "sums": [out.tobytes()]})

    summed = frame.mapInPandas(parts, "block long, at binary, sums binary").repartition("block").sortWithinPartitions("block")
    out = np.zeros(cells, np.int64)
    for row in summed.mapInPandas(total, "block long, sums binary").collect():
        out[row.block * block : (row.block + 1) * block] = np.frombuffer(row.sums, np.int64)[: cells - row.block * block]
    return out


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the least node each linked node reaches. ``links``: ``x``, ``y``.

    Large-star and small-star steps in turn until no link changes: each node links its
    neighbours to the least one among them, so paths shorten quickly and a hot node's
    neighbours are only reduced to a minimum, never gathered.
    """
    edges = links.where("x != y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
    old = ()
    while True:
        both = edges.union(edges.select("y", "x")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("x"), F.col("m").alias("y")).distinct()
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x")
        edges = stored(
            small.select("x", F.col("m").alias("y"))
            .union(small.where("y != m").select(F.col("y").alias("x"), F.col("m").alias("y")))
            .distinct(),
            old,
        )
        old = (edges,)
        ends = edges.select(F.col("x").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.union(edges.select("y", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        if ends.where("up > 1 or up > 0 and down > 0").isEmpty():  # each edge leads to a root
            return edges.toDF("node", "root").union(edges.select("y", "y").distinct())


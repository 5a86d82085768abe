"""Documents with similar shingle sets: an n-gram Jaccard join in size-banded tiles.

Two sets with a similarity of at least ``PERCENT`` share a shingle among the first
``n - ceil(PERCENT * n / 100) + 1`` of each, in any order that is the same for all sets. The
order here puts shingles last that fall into crowded cells of a table of counts over all
documents, so passages of many documents hardly ever bring documents together. Only these
first shingles are looked at, and only those that two different sets have:

1. counts of all shingles by cell; a table of fixed size;
2. first shingles with least and largest set, combined before the shuffle; those of two sets
   become a bitmap of fixed size;
3. first shingles that pass it, and for each document its size, two hashes of its set and
   its signature, a hashed bitmap as wide as the set asks for. Documents with equal sets are one node
   from here on;
4. each node is paired with one leader, the node that leads at most of its shingles; then, where it is
   still apart from them, with all leaders and with the least and the largest node of each of its
   shingles. That is enough to join most groups, in as many pairs as there are rows;
5. the other pairs: shingles whose nodes are still in several components are cut into tiles, of
   shingles with the same nodes only one. A tile has a band of sizes and the next, beyond which
   no size can match, and of a large group blocks of at most ``TILE`` nodes; where its nodes are
   of one component, it goes. Tiles compare signatures; a pair that shares several shingles is
   passed on by one tile, that of the first of them. Of pairs within one component
   nothing more has to be known, so first one pair of each two components is checked, then
   the pairs still between components.

Pairs of steps 4 and 5 are checked alike: sizes, before signatures are sent, then the bound that the bits in which two
signatures differ put on the overlap, then the exact intersection of the sorted sets, made from
the texts of just these nodes. Components come from the links by joins, each time between
the components known before.

Sets are told apart by 64 bits while a second hash finds no two sets that share them;
otherwise the run is made again with another seed. Shingles are told apart by 64 bits.

In every case: no text and no words: size 0 and linked with nothing, not even its like; under
``SHINGLE`` words: one shingle; a missing doc_id sorts last. A node is a set, never a doc_id: rows
without doc_id, or with one doc_id, are in one component only if their texts link; extra columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dqloom.llm import common as c

SHINGLE = 5
PERCENT = 75
CELL_BITS = 18
# Texts are worked on in pieces of about this many bytes, as a byte takes some 40 of arrays;
# texts that travel compressed come in batches of at most ``BATCH_BYTES``.
PIECE = 1 << 18
BATCH_BYTES = 1 << 20
# Bits of the narrowest and the widest signature.
SIGNATURES = 256, 1 << 16
TILE = 1024
# First shingles that go with a node to its tiles, so that a pair is passed on once.
EARLY = 8
ROWS = "token long, s1 long, s2 long, id long, rk long, n long, signature binary"


def _shingles(batch: list[bytes], seed: int) -> list[np.ndarray]:
    """The shingle hashes of each text, in the order of the text."""
    sizes, symbols = c.hashed_words([t.lower() for t in batch])
    hashes = c.Windows(symbols)
    spans = c.mixed(hashes.every(SHINGLE) ^ c.U64(seed))
    out, at = [], 0
    for n in sizes.tolist():
        if n >= SHINGLE:
            out.append(spans[at : at + n - SHINGLE + 1])
        else:
            whole = hashes.at(np.array([at] * (n > 0), np.int64), np.array([at + n] * (n > 0), np.int64))
            out.append(c.mixed((whole + c.mixed(np.full(len(whole), n, c.U64))) ^ c.U64(seed)))
        at += n
    return out


def _set_of(shingles: np.ndarray) -> np.ndarray:
    """The distinct hashes, sorted."""
    shingles = np.sort(shingles)
    new = np.ones(len(shingles), bool)
    new[1:] = shingles[1:] != shingles[:-1]
    return shingles[new]


def _sets(texts: list[bytes], seed: int) -> list[np.ndarray]:
    """The set of each text, made from pieces of about ``PIECE`` bytes at a time."""
    out: list[np.ndarray] = []
    while len(out) < len(texts):
        piece, held = [], 0
        for text in texts[len(out) :]:
            if piece and held + len(text) > PIECE:
                break
            piece.append(text)
            held += len(text)
        out += map(_set_of, _shingles(piece, seed))
    return out


def _signature(tokens: np.ndarray) -> bytes:
    """A bit is set if an odd number of shingles fall on it; at least a bit a shingle, up to the
    widest signature. Two strange sets of n shingles differ in half of n bits then, where 2/7 of n
    rule a link out."""
    width = SIGNATURES[0]
    while width < min(len(tokens), SIGNATURES[1]):
        width *= 2
    odd = np.bincount((tokens & c.U64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


class Signatures:
    """Signatures of several widths; a wider one is folded to compare it with a narrower."""

    def __init__(self, signatures: list[bytes]):
        self.widths = np.array([len(x) for x in signatures], np.int64)
        self.folded: dict[int, np.ndarray] = {}
        self.row: dict[int, np.ndarray] = {}
        for width in np.unique(self.widths).tolist():
            rows = np.flatnonzero(self.widths >= width)
            self.row[width] = np.full(len(signatures), -1)
            self.row[width][rows] = np.arange(len(rows))
            same = [np.bitwise_xor.reduce(np.frombuffer(signatures[i], c.U64).reshape(-1, width // 8), 0) for i in rows.tolist()]
            self.folded[width] = np.stack(same)

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many bits the signatures of pairs differ."""
        out = np.zeros(len(a), np.int64)
        least = np.minimum(self.widths[a], self.widths[b])
        for width in np.unique(least).tolist():
            at = np.flatnonzero(least == width)
            have, row = self.folded[width], self.row[width]
            out[at] = np.bitwise_count(have[row[a[at]]] ^ have[row[b[at]]]).sum(1, dtype=np.int64)
        return out


def needed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least overlap with which sets of these sizes link."""
    return -(-PERCENT * (x + y) // (100 + PERCENT))


def _possible(n: np.ndarray, signatures: Signatures, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of rows can link, by size and by the bits in which signatures differ."""
    good = 100 * np.minimum(n[a], n[b]) >= PERCENT * np.maximum(n[a], n[b])
    a, b = a[good], b[good]
    good[good] = (n[a] + n[b] - signatures.differ(a, b)) // 2 >= needed(n[a], n[b])
    return good


def _first_tokens(docs: DataFrame, seed: int) -> DataFrame:
    """Rows of ``ROWS``: first shingles that several sets may have, and a row without token
    for each document."""

    def cells(frames):
        out = np.zeros(1 << CELL_BITS, np.int64)
        for frame in c.chunks(frames, PIECE):
            tokens = np.concatenate(_shingles(frame["text"].tolist(), seed))
            np.add.at(out, (tokens >> c.U64(64 - CELL_BITS)).astype(np.int64), 1)
        return out

    counts = c.task_sums(docs, cells, 1 << CELL_BITS)
    mean = max(1.0, counts.mean())
    crowd = np.where(counts > 4 * mean, 1 + np.log2(np.maximum(counts / (4 * mean), 1)).astype(np.int64), 0).astype(np.uint8)
    sent = docs.sparkSession.sparkContext.broadcast(crowd)

    def first(tokens: np.ndarray) -> np.ndarray:
        """The first shingles of a set: less crowded cells before others, then by hash."""
        n = len(tokens)
        if not n:
            return tokens
        cells = sent.value[tokens >> c.U64(64 - CELL_BITS)]
        order = tokens[np.argsort(cells, kind="stable")] if cells.any() else tokens
        return order[: n - -(-PERCENT * n // 100) + 1]

    def sets(frame: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
        found = [_set_of(x) for x in _shingles(frame["text"].tolist(), seed)]
        return found, np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in found], c.U64)

    def anchors(frames):
        for frame in c.chunks(frames, PIECE):
            found, s1 = sets(frame)
            take = [first(x) for x in found]
            yield pd.DataFrame({"token": c.signed(np.concatenate(take)), "s1": c.signed(np.repeat(s1, [len(x) for x in take]))})

    shared = docs.mapInPandas(anchors, "token long, s1 long").groupBy("token").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi"))
    shared = c.stored(shared.where("lo < hi").select("token"))
    passes = c.BitFilter(shared, c.filter_bits(shared.count()))

    def rows(frames):
        for frame in c.chunks(frames, PIECE):
            found, s1 = sets(frame)
            take = [first(x) for x in found]
            s1_of = np.repeat(s1, [len(x) for x in take])
            take = np.concatenate(take)
            good = passes.passes(take)
            s2 = np.array([xxhash.xxh64_intdigest(x.tobytes(), 1) for x in found], c.U64)
            n = [len(x) for x in found]
            yield pd.DataFrame({"token": None, "s1": c.signed(s1), "s2": c.signed(s2), "id": frame["id"], "rk": frame["rk"], "n": n, "signature": [_signature(x) for x in found]})
            yield pd.DataFrame({"token": c.signed(take[good]), "s1": c.signed(s1_of[good]), "s2": None, "id": None, "rk": None, "n": None, "signature": None})

    return c.stored(docs.mapInPandas(rows, ROWS), (shared,))


def _links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, seed: int) -> DataFrame:
    """The ``pairs`` (``x``, ``y``: sets) that link: least doc_ids ``x``, ``y`` of both sets, and the sets ``sx``, ``sy``.

    Texts travel compressed, which is less than their sets; a set is made once a batch.
    """
    wanted = c.stored(nodes.join(pairs.select("x").union(pairs.select("y")).distinct(), F.col("s1") == F.col("x"), "left_semi").select("s1", "id"))
    passes = c.BitFilter(wanted.select(F.xxhash64("id").alias("key")), c.filter_bits(wanted.count()))

    def wanted_texts(frames):
        pack = zstandard.ZstdCompressor(level=1)
        for frame in c.chunks(frames, PIECE):
            frame = frame[passes.passes(frame["key"].to_numpy().view(c.U64))].reset_index(drop=True)
            if len(frame):
                sets = [_set_of(x).tobytes() for x in _shingles(frame["text"].tolist(), seed)]
                s1 = np.array([xxhash.xxh3_64_intdigest(x) for x in sets], c.U64)
                yield pd.DataFrame({"id": frame["id"], "s1": c.signed(s1), "packed": [pack.compress(t) for t in frame["text"]]})

    found = docs.withColumn("key", F.xxhash64("id")).mapInPandas(wanted_texts, "id long, s1 long, packed binary")
    found = c.stored(found.join(wanted, ["s1", "id"], "left_semi").dropDuplicates(["s1"]))

    def overlap(frames):
        for frame in frames:
            texts = dict(zip(frame["sx"].tolist(), frame["xt"])) | dict(zip(frame["sy"].tolist(), frame["yt"]))
            unpack = zstandard.ZstdDecompressor()
            sets = dict(zip(texts, _sets([unpack.decompress(t) for t in texts.values()], seed)))
            del texts
            good = []
            for a, b in zip(frame["sx"].tolist(), frame["sy"].tolist()):
                a, b = sets[a], sets[b]
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * both >= PERCENT * (len(a) + len(b) - both))
            yield frame.loc[good, ["x", "y", "sx", "sy"]]

    both = pairs.join(found.select(F.col("s1").alias("x"), F.col("id").alias("xi"), F.col("packed").alias("xt")), "x")
    both = both.join(found.select(F.col("s1").alias("y"), F.col("id").alias("yi"), F.col("packed").alias("yt")), "y")
    both = both.select(F.col("xi").alias("x"), F.col("yi").alias("y"), F.col("x").alias("sx"), F.col("y").alias("sy"), "xt", "yt")
    return c.stored(both.mapInPandas(overlap, "x long, y long, sx long, sy long"), (found, wanted))


def _screened(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The ``pairs``, as of ``_apart``, that signatures do not rule out."""
    pairs = pairs.select("x", "y", "nx", "ny")
    for side in "xy":
        pairs = pairs.join(nodes.select(F.col("s1").alias(side), F.col("signature").alias(f"s{side}")), side)

    def screen(frames):
        for frame in frames:
            n = np.concatenate([frame["nx"].to_numpy(), frame["ny"].to_numpy()])
            at = np.arange(len(frame))
            good = _possible(n, Signatures([*frame["sx"], *frame["sy"]]), at, at + len(frame))
            yield frame.loc[good, ["x", "y"]]

    return pairs.mapInPandas(screen, "x long, y long")


def _tiles(shared: DataFrame, nodes: DataFrame, roots: DataFrame, instead_of: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Possible pairs of nodes of different components that share a first shingle, stored."""
    rows = shared.join(roots.select("s1", "root").join(nodes.select("s1", "n"), "s1"), "s1")
    marks = [F.bit_xor(F.xxhash64("s1", F.lit(i))).alias(f"mark{i}") for i in (1, 2)]
    groups = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("g"), *marks).where("lo < hi")
    # a passage is many shingles with the same nodes: one of them will do
    groups = groups.groupBy("g", "mark1", "mark2").agg(F.min("token").alias("token"))
    stored = c.stored(rows.join(groups.select("token", "g"), "token"), instead_of)
    place = ["token", "low", "i", "j"]

    def compare(frames):
        weigh = lambda held: np.ones(len(held))
        for held in c.whole_buckets(_numbered(frames, place), "tile", weigh, 4 * TILE):
            yield _compared(held)

    ready = _dealt(stored, nodes).repartition(*[F.col(p) for p in place]).sortWithinPartitions(*place, "n")
    return c.stored(ready.mapInPandas(compare, "x long, y long").distinct(), (stored,))


def _dealt(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of tiles, of ``rows`` (``token``, ``s1``, ``root``, ``n``, ``g`` nodes of the token): those
    for whom their tile may have a partner, of another component and a size that can match."""
    # any two nodes of a tile whose lists have an earlier shingle in common meet in its tile as well
    early = rows.groupBy("s1").agg(F.slice(F.sort_array(F.collect_list("token")), 1, EARLY).alias("early"))
    sent = nodes.select("s1", "signature").join(early, "s1")
    # a trace wider than sizes that can match, so that rounding sets none of these two bands apart
    band = F.floor(F.log("n") / F.log(F.lit(100 / PERCENT + 1e-6)))
    blocks = F.ceil(F.col("g") / TILE)
    rows = rows.withColumn("band", band).withColumn("block", F.pmod(F.xxhash64("s1"), blocks))
    # sizes that can match are at most one band apart: a tile has a band and the next
    rows = rows.withColumn("low", F.explode(F.array("band", F.col("band") - 1)))
    # the smaller of a pair is of the lower band: ``lo``, ``hi``, ``most`` are of that, ``least`` of the next
    lower = F.col("band") == F.col("low")
    mixed = rows.groupBy("token", "low").agg(
        F.min("root").alias("first"),
        F.max("root").alias("last"),
        F.min(F.when(lower, F.col("root"))).alias("lo"),
        F.max(F.when(lower, F.col("root"))).alias("hi"),
        F.max(F.when(lower, F.col("n"))).alias("most"),
        F.min(F.when(~lower, F.col("n"))).alias("least"),
    )
    mixed = mixed.where(f"first < last and (lo < hi or 100 * most >= {PERCENT} * least)").drop("first", "last")
    rows = rows.join(mixed, ["token", "low"])
    of_lower = f"band = low and (lo < hi or 100 * n >= {PERCENT} * least)"
    of_next = f"band > low and 100 * most >= {PERCENT} * n and (lo < hi or root != lo)"
    rows = rows.where(f"{of_lower} or {of_next}").join(sent, "s1")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.select(
        "token", "low", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "band", "n", "root", "s1", "signature",
        F.filter("early", lambda t: t < F.col("token")).alias("early"),
    )


def _numbered(frames, place: list[str]):
    """The frames with one number for each tile; equal tiles stand together."""
    last, number = None, 0
    for frame in frames:
        keys = frame[place].to_numpy()
        if not len(keys):
            continue
        new = np.append(last is None or (keys[0] != last).any(), (keys[1:] != keys[:-1]).any(1))
        tiles = number + np.cumsum(new)
        last, number = keys[-1], int(tiles[-1])
        frame["tile"] = tiles
        yield frame


def _compared(held: pd.DataFrame) -> pd.DataFrame:
    """Possible pairs of whole tiles, whose rows stand in order of size."""
    tile, n, root, s1 = (held[k].to_numpy() for k in ("tile", "n", "root", "s1"))
    block, band, low, cross = (held[k].to_numpy() for k in ("block", "band", "low", "i"))
    cross = cross != held["j"].to_numpy()
    token = held["token"].to_numpy()
    early = np.full((len(held), EARLY), np.iinfo(np.int64).max)
    for i, first in enumerate(held["early"]):
        early[i, : len(first)] = first
    signatures = Signatures(held["signature"].tolist())
    x, y = [], []
    at = np.arange(len(held))
    for d in range(1, len(held)):
        at = at[at + d < len(held)]
        # rows further on are larger still
        at = at[(tile[at + d] == tile[at]) & (100 * n[at] >= PERCENT * n[at + d])]
        if not len(at):
            break
        a = at[(root[at] != root[at + d]) & ((block[at] != block[at + d]) | ~cross[at]) & (band[at] == low[at])]
        a = a[_possible(n, signatures, a, a + d)] if len(a) else a
        both = (early[a][:, :, None] == early[a + d][:, None, :]) & (early[a] < token[a, None])[:, :, None]
        a = a[~both.any((1, 2))]
        x.append(np.minimum(s1[a], s1[a + d]))
        y.append(np.maximum(s1[a], s1[a + d]))
    return pd.DataFrame({"x": np.concatenate(x) if x else [], "y": np.concatenate(y) if y else []}).drop_duplicates()


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after more ``links``: ``s1``, ``root``, a set that names the component, and ``least``, its
    least doc_id, and ``n`` of each node. Only the components known so far are joined, not their nodes."""
    if links.isEmpty():
        return roots
    # ordered by doc_id, told apart by set: other sets may have the same doc_id, or none as well
    ends = links.select("sx", "sy")
    for side in "xy":
        of = roots.select(F.col("s1").alias(f"s{side}"), F.struct(F.col("least").alias("id"), F.col("root").alias("s1")).alias(side))
        ends = ends.join(of, f"s{side}")
    found = c.components(ends.select("x", "y"))
    found = found.select(F.col("node.s1").alias("root"), F.col("root.s1").alias("over"), F.col("root.id").alias("first"))
    merged = roots.join(found, "root", "left")
    return c.stored(merged.select("s1", F.coalesce("over", "root").alias("root"), F.coalesce("first", "least").alias("least"), "n"), (roots,))


def _leaders(shared: DataFrame, nodes: DataFrame) -> DataFrame:
    """``x``, ``y``, ``times``: each node with the leaders of its first shingles, and at how many.

    At each shingle that node leads which has most of its own first shingles in common with others:
    the text that many near copies were made of, rather than one of them.
    """
    first = F.col("n") - F.ceil(PERCENT * F.col("n") / 100) + 1
    share = shared.groupBy("s1").agg(F.count("*").alias("k")).join(nodes.select("s1", "n"), "s1")
    # the share in the high bits; below it the set decides
    order = F.shiftleft((F.col("k") / first * (1 << 20)).cast("long"), 40) + F.shiftrightunsigned("s1", 24)
    ranked = shared.join(share.select("s1", order.alias("order")), "s1")
    lead = ranked.groupBy("token").agg(F.max_by("s1", "order").alias("y"))
    met = shared.join(lead, "token").where("s1 != y")
    return met.groupBy(F.col("s1").alias("x"), "y").agg(F.count("*").alias("times"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The ``pairs`` of nodes in different components ``rx`` < ``ry`` whose sizes ``nx``, ``ny`` can match."""
    for side in "xy":
        of = roots.select(F.col("s1").alias(side), F.col("root").alias(f"r{side}"), F.col("n").alias(f"n{side}"))
        pairs = pairs.join(of, side)
    pairs = pairs.where(f"rx != ry and 100 * least(nx, ny) >= {PERCENT} * greatest(nx, ny)")
    return pairs.select("x", "y", F.least("rx", "ry").alias("rx"), F.greatest("rx", "ry").alias("ry"), "nx", "ny")


def _grouped(docs: DataFrame) -> DataFrame:
    """``id``, ``rk``, ``n`` and, with words, ``root`` and ``least`` (see ``_merged``) of each row of
    ``docs``, which is as of ``common.texts``."""
    docs = c.in_small_batches(docs, BATCH_BYTES)
    for seed in range(100):
        found = _first_tokens(docs, seed)
        each = found.where("token is null")
        clash = each.groupBy("s1").agg(F.min("s2").alias("lo"), F.max("s2").alias("hi")).where("lo < hi")
        if clash.isEmpty():
            break
    nodes = each.where("n > 0").groupBy("s1").agg(F.min(F.struct("id", "n", "signature")).alias("m")).select("s1", "m.*")
    nodes = c.stored(nodes)
    shared = c.stored(found.where("token is not null").select("token", "s1").distinct())
    roots = c.stored(nodes.select("s1", F.col("s1").alias("root"), F.col("id").alias("least"), "n"))
    met = c.stored(_leaders(shared, nodes))
    best = met.groupBy("x").agg(F.max_by("y", F.shiftleft("times", 40) + F.shiftrightunsigned("y", 24)).alias("y"))
    ends = shared.groupBy("token").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi")).where("lo < hi")
    star = shared.join(ends, "token")
    star = star.select(F.col("s1").alias("x"), F.col("lo").alias("y")).union(star.select("s1", "hi")).where("x != y")
    # each node with one leader; then, where they are still apart, with all leaders and both ends
    for pairs in (best, met.select("x", "y").union(star)):
        pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        links = _links(docs, nodes, c.stored(_screened(_apart(pairs, roots), nodes)), seed)
        roots = _merged(roots, links)
    rest = _tiles(shared, nodes, roots, (shared, met))
    for every in (False, True):  # first one pair of each two components, then what is left
        apart = _apart(rest, roots)
        if not every:
            apart = apart.groupBy("rx", "ry").agg(F.min(F.struct("x", "y")).alias("p")).select("p.x", "p.y")
        apart = c.stored(apart.select("x", "y"))
        if apart.isEmpty():
            break
        roots = _merged(roots, _links(docs, nodes, apart, seed))
    out = each.select("id", "rk", "n", "s1").join(roots.drop("n"), "s1", "left")
    return out.select("id", "rk", "n", *[F.when(F.col("n") > 0, F.col(k)).alias(k) for k in ("root", "least")])


def joined(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the least doc_id linked with it over any
    number of links, for each row of ``docs``."""
    out = _grouped(c.texts(docs)).withColumn("least", F.coalesce("least", "id"))
    return out.select(c.shown_id(), F.col("n").alias("n_shingles"), c.shown_id("least").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, that of its least doc_id, with its own columns;
    of rows of it that agree in doc_id, the one with the least hash of its text. A row without
    words is a component; copies of it, equal in doc_id and text, are one row."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = (f"c{names.index(n)}" for n in ("doc_id", "text"))
    groups = _grouped(c.texts(docs.select("doc_id", "text")))
    first = groups.where("n > 0").groupBy("root").agg(F.min(F.struct("id", "rk")).alias("m")).select("m.*")
    first = first.union(groups.where("n = 0").select("id", "rk").distinct())
    own = plain.withColumns({"id": F.coalesce(F.col(doc_id).cast("long"), F.lit(c.LAST_ID)), "rk": F.xxhash64(text)})
    nth = F.row_number().over(Window.partitionBy("id", "rk").orderBy("rk"))
    kept = own.join(first, ["id", "rk"], "left_semi").withColumn("nth", nth).where("nth = 1")
    return kept.select(*plain.columns).toDF(*names)

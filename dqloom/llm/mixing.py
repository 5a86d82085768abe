"""Mixing sources to target weights: Efraimidis-Spirakis order under token budgets.

Each document draws the key ``-ln(u) / weight``, ``u`` from a hash of its doc_id and text and
the seed, ``weight`` its quality; sorted by key, documents stand in the order of a weighted
sample without replacement. A source whose target is ``e`` whole times its size and a rest
takes every document ``e`` times, then documents in key order while the prefix sum of sizes
stays within the rest, and at the edge the one document left that ends nearest to it, if one
comes nearer than none.

Prefix sums come in two levels: sizes are summed by source and slot of the key
(``SLOTS`` slots of equal probability for equal weights), the few sums are added up in order,
and documents are only sorted within their slot. So a hot source is spread over many tasks.
Only ids, sizes and keys are shuffled for that, no texts. Rows that agree in doc_id, text and
source are counted before, one row for all of them, and as many of them are taken as fit.

Targets: sources by code point, a missing one last, weigh 1, 2, 3, repeating, and share the sum
of all sizes. Where that is over ``CAP`` times a source's size, it gets just that, and the rest is
shared again by weight until no source is above. In order of ``CAP * size / weight`` the capped
sources come first, so one prefix sum over sources finds them all.

In every case: no text: size 0, which takes 0 words; documents without a quality weigh 1; equal
keys go by doc_id, then text; rows that agree in both draw the same key, and which of them are
taken once more is left open; extra columns are passed on by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqloom.llm import common as c

CAP = 3.0
SLOTS = 1024
# Weight of documents by label; others weigh 1.
QUALITY_WEIGHTS = {1: 2.0, 0: 0.5}
WORD = r"[^\x20\x09-\x0D]+"
# Equal rows numbered in one array.
RUN = 4096


def targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows of ``source`` and ``size``.

    One row a source is sorted in one task; documents are summed before.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = by_source.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
    ranked = ranked.withColumn("limit", F.lit(CAP) * F.col("source_size") / F.col("weight"))
    filled = Window.orderBy("limit", F.col("source").isNull(), "source")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        ranked.withColumn("taken", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(CAP))
        .withColumn("used", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("weights", F.sum("weight").over(whole))
        .withColumn("level", (F.col("total") - F.col("taken")) / (F.col("weights") - F.col("used")))
        # it rises while the next source is rightly capped, and falls from then on
        .withColumn("share", F.max("level").over(whole))
    )
    capped = F.col("limit") <= F.col("share")
    return ranked.select(
        "source",
        "source_size",
        F.when(capped, F.lit(CAP) * F.col("source_size")).otherwise(F.col("share") * F.col("weight")).alias("target"),
    )


def uniform(seed: int, *columns: Column) -> Column:
    """A number between 0 and 1, the same in every run, from the first 13 digits of an MD5."""
    text = F.concat_ws("/", F.lit(str(seed)), *[F.coalesce(x.cast("string"), F.lit("")) for x in columns])
    digits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (digits + F.lit(0.5)) / F.lit(float(16**13))


def counted(docs: DataFrame, labels: DataFrame | None = None, seed: int = 7) -> DataFrame:
    """``doc_id``, ``text_key``, ``source``, ``size``, ``source_size``, ``target``, and of ``n`` rows
    that agree in the first three ``more``, which are taken ``epochs + 1`` times, the others
    ``epochs`` times."""
    sized = docs.select(
        "doc_id",
        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sized = sized.groupBy("doc_id", "text_key", "source", "size").agg(F.count("*").alias("n"))
    if labels is None:
        sized = sized.withColumn("quality", F.lit(1.0))
    else:
        known = F.create_map(*[F.lit(x) for pair in QUALITY_WEIGHTS.items() for x in pair])
        quality = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
        sized = sized.join(quality, "doc_id", "left").withColumn("quality", F.coalesce(known[F.col("label")], F.lit(1.0)))
    keyed = sized.withColumn("key", -F.log(uniform(seed, F.col("doc_id"), F.col("text_key"))) / F.col("quality"))
    keyed = keyed.withColumn("slot", F.least(F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * SLOTS), F.lit(SLOTS - 1)))
    keyed = keyed.withColumn("all", F.col("n") * F.col("size"))
    # numbers of one row a document: the texts are read once
    keyed = c.stored(keyed)
    slots = keyed.groupBy("source", "slot").agg(F.sum("all").alias("slot_size"))
    ahead = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("ahead", F.coalesce(F.sum("slot_size").over(ahead), F.lit(0)))
    slots = slots.join(targets(keyed.select("source", F.col("all").alias("size"))).withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    slots = slots.select(F.col("source").alias("of"), F.col("slot").alias("at"), "ahead", "source_size", "target")
    within = Window.partitionBy("source", "slot").orderBy("key", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("before", F.coalesce(F.sum("all").over(within), F.lit(0)))
    placed = placed.join(slots, F.col("source").eqNullSafe(F.col("of")) & (F.col("slot") == F.col("at")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - epochs * F.col("source_size")
    room = F.greatest(F.floor(rest) - F.col("ahead") - F.col("before"), F.lit(0))
    fit = F.when(F.col("size") > 0, F.least(F.floor(room / F.col("size")), F.col("n"))).otherwise(F.lit(0))
    placed = placed.withColumns({"epochs": epochs.cast("long"), "rest": rest, "fit": fit.cast("long")})
    placed = placed.select("doc_id", "text_key", "source", "key", "size", "n", "source_size", "target", "epochs", "rest", "fit")
    placed = c.stored(placed, (keyed,))
    gaps = placed.groupBy("source").agg((F.max("rest") - F.sum(F.col("fit") * F.col("size"))).alias("gap"))
    gaps = gaps.withColumnRenamed("source", "of")
    off = F.abs(F.col("size") - F.col("gap"))
    # the document at the edge: of those left, the one that ends nearest to the budget
    edge = (
        placed.where("fit < n and size > 0")
        .join(gaps, F.col("source").eqNullSafe(F.col("of")))
        .where(off < F.col("gap"))
        .groupBy("of")
        .agg(F.min(F.struct(off.alias("off"), "key", "doc_id", "text_key")).alias("e"))
        .select("of", F.col("e.doc_id").alias("edge_id"), F.col("e.text_key").alias("edge_key"))
    )
    chosen = placed.join(edge, F.col("source").eqNullSafe(F.col("of")), "left")
    at_edge = (F.col("fit") < F.col("n")) & F.col("edge_id").eqNullSafe(F.col("doc_id")) & (F.col("edge_key") == F.col("text_key"))
    more = F.col("fit") + F.coalesce(at_edge, F.lit(False)).cast("long")
    return chosen.select("doc_id", "text_key", "source", "size", "source_size", "target", "n", "epochs", more.alias("more"))


def taken(docs: DataFrame, labels: DataFrame | None = None, seed: int = 7) -> DataFrame:
    """``doc_id``, ``text_key``, ``source``, ``size``, ``source_size``, ``target``, ``copies``
    and ``taken`` (``copies`` times ``size``) of each row of ``docs``."""
    each = counted(docs, labels, seed).withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / RUN))))
    first = F.col("run") * RUN + 1
    each = each.withColumn("nth", F.explode(F.sequence(first, F.least(first + (RUN - 1), F.col("n")))))
    copies = F.col("epochs") + (F.col("nth") <= F.col("more")).cast("long")
    return each.select(
        "doc_id", "text_key", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, labels: DataFrame | None = None, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their own columns."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    where = {name: f"c{names.index(name)}" for name in ("doc_id", "text", "source")}
    own = plain.select("*", *[F.col(where[name]).alias(name) for name in where])
    times = counted(own.select(*where), labels, seed).where("epochs + more > 0")
    times = times.select(F.col("doc_id").alias("of"), F.col("text_key").alias("key"), F.col("source").alias("in"), "n", "epochs", "more")
    times = c.stored(times)
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.md5(F.coalesce(F.col("text"), F.lit(""))) == F.col("key")) & F.col("source").eqNullSafe(F.col("in"))
    alike = own.join(times.where("more = 0 or more = n"), same).withColumn("copies", F.col("epochs") + (F.col("more") > 0).cast("long"))
    # equal rows of which some are taken once more: at most two groups of them a source
    cut = own.join(F.broadcast(times.where("more > 0 and more < n")), same)
    nth = F.row_number().over(Window.partitionBy("of", "key", "in").orderBy("key"))
    cut = cut.withColumn("copies", F.col("epochs") + (nth <= F.col("more")).cast("long")).where("copies > 0")
    return (
        alike.select(*plain.columns, "copies")
        .union(cut.select(*plain.columns, "copies"))
        .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(*plain.columns)
        .toDF(*names)
    )

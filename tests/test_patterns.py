"""Shapes against a plain definition, and regexes that match exactly their shapes."""

import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dqloom.functions.text import NAMED_FORMATS, anchored, shape_mask, shape_regex, violates
from dqloom.operators import patterns
from dqloom.session import small_frame

BLANKS = " \t\n\x0b\x0c\r"
TEXT = st.text(alphabet=st.sampled_from(list("abzABZ019 -._/@'()[]+?*|^$\\{}\t\né́ßЖж汉字ªǅ٣")), max_size=12)


def plain_shape(text):
    letters = []
    for ch in text:
        kind = unicodedata.category(ch)
        if ch in BLANKS:
            letter = " "
        elif kind == "Nd":
            letter = "9"
        elif kind == "Lu":
            letter = "A"
        elif kind == "Ll":
            letter = "a"
        elif kind in ("Lo", "Lm", "Lt") or kind[0] == "M":
            letter = "o"
        else:
            letters.append((ch, False))
            continue
        if letters and letters[-1] == (letter, True):
            continue
        letters.append((letter, True))
    return "".join(c for c, _ in letters)


@settings(max_examples=12, deadline=None)
@given(values=st.lists(TEXT, min_size=1, max_size=25))
def test_regex_of_a_shape_matches_that_shape_only(spark, values):
    shape = shape_mask(F.col("v"))
    frame = small_frame(spark, [(v,) for v in values], "v string")
    rows = frame.select("v", shape.alias("shape"), anchored(F.array(shape_regex(shape))).alias("regex")).collect()
    for row in rows:
        assert row.shape == plain_shape(row.v)
    pairs = [(a.v, b.regex, a.shape == b.shape) for a in rows for b in rows]
    wrong = small_frame(spark, pairs, "v string, regex string, same boolean").where("(v rlike regex) <> same")
    assert wrong.collect() == []


def test_clear_and_unclear_columns(spark):
    rows = [(f"AB-{i:03d}", f"w{'x' * i} {i}-{'.' * i}") for i in range(96)] + [("bad", "q")] * 4 + [(None, None)]
    frame = small_frame(spark, rows, "code string, note string")
    shapes = patterns.dominant_shapes(frame, ["code", "note"])
    assert [(r.column_name, r.shape, r.n) for r in shapes.collect()] == [("code", "A-9", 96)]
    regex = patterns.dominant_pattern(frame, "code")
    assert patterns.pattern_violations(frame, "code", regex).count() == 4
    assert patterns.dominant_pattern(frame, "note") is None


def test_shapes_stop_where_the_cover_is_reached(spark):
    rows = [("1",)] * 60 + [("a",)] * 36 + [("A",)] * 4
    frame = small_frame(spark, rows, "v string")
    assert [r.shape for r in patterns.dominant_shapes(frame, ["v"], 0.01, 0.95).collect()] == ["9", "a"]


def test_frequent_shapes_among_many_rare_ones(spark):
    """Shapes of 5 % are found however many others a sketch has to forget."""
    rare = F.expr("translate(bin(xxhash64(id) & 4294967295), '01', 'a-')")
    rows = spark.range(0, 60_000, 1, 7)
    mixed = F.when(F.col("id") % 20 == 3, "AB.1").when(F.col("id") % 20 == 5, F.concat(F.lit("x "), "id"))
    free = rows.select(F.coalesce(mixed, rare).alias("v"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("k"), "id")).alias("code"))
    assert patterns.shape_profile(free, "v").count() > 5_000
    found = {r.shape: (r.n, r.share) for r in patterns.dominant_shapes(free, ["v"], 0.05, 0.1).collect()}
    assert found == {"A.9": (3000, 0.05), "a 9": (3000, 0.05)}
    assert patterns.dominant_shapes(free, ["v"]).isEmpty()
    assert [tuple(r)[:3] for r in patterns.dominant_shapes(free, ["v", "code"]).collect()] == [("code", "a9", 30_000)]
    assert patterns.dominant_shapes(free.limit(0), ["v", "code"]).isEmpty()
    assert patterns.dominant_shapes(free.select(F.lit(None).cast("string").alias("v")), ["v"]).isEmpty()


def test_case_variants_match_plain_grouping(spark):
    values = ["New York", "new york", " NEW YORK", "Rome", "Rome", "paris", None]
    frame = small_frame(spark, [(v,) for v in values], "v string")
    found = {(r.spelling_key, r.variants, r.n) for r in patterns.case_variants(frame, "v").collect()}
    assert found == {("new york", 3, 3)}


def test_named_formats(spark):
    good = {
        "email": ["a@b.co", "first.last+x@mail.example.org"],
        "phone": ["+1 555 123 4567", "(0221) 47 11 22", "555-123-4567"],
        "first_last_name": ["Ada Lovelace", "Zoë O'Neil"],
        "no_special_characters": ["Ada Lovelace", "Jean-Luc"],
        "street_address": ["12 Main St", "221B Baker Street, London"],
    }
    bad = {
        "email": ["a@b", "a b@c.de", "@x.org"],
        "phone": ["call me", "12"],
        "first_last_name": ["ada lovelace", "Ada", "Ada 3"],
        "no_special_characters": ["Ada_1", "a@b"],
        "street_address": ["Main St", "12"],
    }

    cases = [(name, text, True) for name in good for text in good[name]]
    cases += [(name, text, False) for name in bad for text in bad[name]]
    for name, regex in NAMED_FORMATS.items():
        frame = small_frame(spark, [c for c in cases if c[0] == name], "name string, v string, fits boolean")
        assert frame.where(violates(F.col("v"), regex) == F.col("fits")).collect() == []

"""Exact copies, spelling variants and the Merkle manifest against their plain meaning."""

import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F
from test_operators import same

from dqloom.llm import exact_dedup, merkle_manifest, spelling_variants


@pytest.fixture(scope="module")
def pairs(rows):
    return [r[:2] for r in rows]


# --- 11: exact dedup ---------------------------------------------------------------


def check_copies(docs, pairs):
    found = exact_dedup.marked(docs)
    same(found.select("doc_id", "keep_id", "group_size", "text_sha256"), brute.copies(pairs))
    kept = found.where("kept").select("doc_id", "keep_id", "text_sha256").collect()
    assert sorted((r.text_sha256, r.doc_id or -1) for r in kept) == sorted({(s, k or -1) for _, k, _, s in brute.copies(pairs)})
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("width", [1, 16])
def test_copies(docs, pairs, monkeypatch, width):
    """With fingerprints that different chunks share, and without."""
    monkeypatch.setattr(exact_dedup, "FINGERPRINT", width)
    check_copies(docs, pairs)


def test_chunks_that_share_a_fingerprint_are_told_apart(spark, monkeypatch):
    """Texts with one recipe and different contents, until the fingerprints are long enough."""
    monkeypatch.setattr(exact_dedup, "FINGERPRINT", 1)
    seen = {}
    pick = random.Random(4)
    while True:
        text = "".join(pick.choice("abcdef") for _ in range(40))
        mark = exact_dedup.fingerprint(text.encode(), 1)
        if seen.setdefault(mark, text) != text:
            break
    pairs = [(1, text), (2, seen[mark]), (3, text.upper()), (None, seen[mark])]
    check_copies(spark.createDataFrame(pairs, "doc_id long, text string"), pairs)


def test_copies_of_long_and_odd_texts(spark, empty, nameless, docs):
    pick = random.Random(8)
    long = "".join(pick.choice("abcdefgh \n") for _ in range(300_000))
    pairs = [(1, long), (2, long.upper()), (3, long[:-1] + "!"), (4, "a" * 100_000), (5, "A" * 100_000), (6, "a" * 100_001), (7, None), (7, ""), (None, ""), (7, "x"), (7, "X")]
    check_copies(spark.createDataFrame(pairs, "doc_id long, text string").repartition(4), pairs)
    assert exact_dedup.marked(empty).isEmpty() and exact_dedup.one_of_each(empty).isEmpty()
    assert exact_dedup.marked(nameless).count() == 3
    left = exact_dedup.one_of_each(docs)
    assert left.columns == docs.columns
    texts = [(r.text or "").translate(brute.LOW) for r in left.select("text").collect()]
    assert sorted(texts) == sorted({(r.text or "").translate(brute.LOW) for r in docs.select("text").collect()})


def test_chunks_are_cut_by_content():
    """Chunks join to the text, keep to the sizes, and meet again after a change; pieces change nothing."""
    pick = random.Random(6)
    text = bytes(pick.randrange(256) for _ in range(200_000))
    other = text[:100] + b"inserted" + text[100:]
    (one,), (two,) = exact_dedup.chunked([text]), exact_dedup.chunked([other])
    assert b"".join(one) == text and all(exact_dedup.MIN_CHUNK <= len(x) <= exact_dedup.MAX_CHUNK for x in one[:-1])
    assert len(set(one) & set(two)) > len(one) - 5
    assert exact_dedup.chunked([b"head", text, other]) == [[b"head"], one, two]


def test_pieces_of_a_text_have_the_same_boundaries(monkeypatch):
    pick = random.Random(7)
    text = bytes(pick.randrange(256) for _ in range(50_000))
    whole = exact_dedup.boundaries(text).tolist()
    monkeypatch.setattr(exact_dedup, "PIECE", 1000)
    assert exact_dedup.boundaries(text).tolist() == whole and len(whole) > 10


# --- 12: spelling variants -------------------------------------------------------------


def test_variants(docs, pairs):
    """Short words too, which have more neighbours in the small vocabulary."""
    same(spelling_variants.variants(docs, 2, 1, 2), brute.variants(pairs, 2, 1, 2))


def test_variants_on_real_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    expected = brute.variants(pairs, 6, 2)
    assert sum(1 for r in expected if r[1]) > 5
    same(spelling_variants.variants(docs, 6, 2), expected)


def test_all_edits_are_found(spark):
    pick = random.Random(2)
    words = set()
    for n in (6, 7, 8, 9, 13):
        for _ in range(12):
            w = "".join(pick.choice("abé") for _ in range(n))
            at = pick.randrange(n)
            words |= {w, w[:at] + w[at + 1 :], w[:at] + "c" + w[at:], w[:at] + "d" + w[at + 1 :], w + "z", "z" + w}
    words = sorted(w for w in words if len(w) >= 6)
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    found = [(r.x, r.y) for r in spelling_variants.near(table).collect()]
    rows = [(0, " ".join(words))]
    degree = {w: n for w, _, _, _, n, _ in brute.variants([(i, w) for i, w in enumerate(words)], 6, 1)}
    assert rows and len(found) == len({tuple(sorted(p)) for p in found})
    if set(degree) == set(words):  # no word was mistyped
        ends = Counter(w for p in found for w in p)
        assert all(ends[w] == degree[w] for w in words)
    near = lambda a, b: len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1 or any(
        long[:i] + long[i + 1 :] == short for long, short in ((a, b), (b, a)) if len(long) == len(short) + 1 for i in range(len(long)))
    assert {tuple(sorted(p)) for p in found} == {(a, b) for n, a in enumerate(words) for b in words[n + 1 :] if near(a, b)}


def test_long_chains_and_odd_tables(spark, empty, nameless):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w5"), ("y", "z")], "word string, form string")
    roots = {r.word: r.root for r in spelling_variants._roots(forms).collect()}
    assert roots == {f"w{i}": "w13" for i in range(13)} | {"x": "w13", "y": "z"}
    assert spelling_variants.variants(empty).isEmpty() and spelling_variants.variants(nameless).isEmpty()


def test_pieces_end_between_words(monkeypatch):
    monkeypatch.setattr(spelling_variants, "PIECE", 7)
    text = "aaaaaaaaaaaaaaa bb ccccccccc, d " * 5
    assert "".join(spelling_variants.pieces(text)) == text
    assert [w for p in spelling_variants.pieces(text) for w in brute.RUN.findall(p)] == brute.RUN.findall(text)


# --- 13: Merkle manifest ---------------------------------------------------------------

DOC = "doc_id long, source string, lang string, n_chars long, text string"


def check_manifest(spark, rows):
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], DOC + ", pos int").repartition(3)
    found = merkle_manifest.manifest(docs, *merkle_manifest.tampered())
    shown = found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", F.col("folded_root") == F.col("root"))
    same(shown, brute.merkle(rows))


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest(spark, monkeypatch, levels):
    """Groups of several sizes; ids far apart, negative, missing and repeated; missing values."""
    monkeypatch.setattr(merkle_manifest, "LEVELS", levels)
    pick = random.Random(levels)
    ids = [*range(40), *range(4000, 4200), -1, -5000, 2**62, -(2**62), 2**63 - 1, -(2**63), *[1 << s for s in range(12, 60, 5)]]
    pick.shuffle(ids)
    rows = [(i, pick.choice(["a", "é", None]), pick.choice(["en", "en", "de", "é"]), pick.choice([None, 3, 40]), pick.choice([None, "", "text", "ü" * n])) for n, i in enumerate(ids)]
    rows += [(5, None, None, None, None), (None, "s", "en", 1, "a"), (None, "s", "en", 1, "b"), (None, "s", "en", 1, "b"), (7, "s", "", 2, "lone")]
    rows += [(9, "s", "en", 9, f"repeated {n % 4}") for n in range(9)] + [rows[0]] * 3
    check_manifest(spark, rows)


def test_manifest_of_hot_ids(spark, monkeypatch):
    """Many rows of one doc_id, or without one, are dealt over tasks."""
    monkeypatch.setattr(merkle_manifest, "HOT_ROWS", 8)
    rows = [(None, "s", "en", n % 5, f"t{n % 23}") for n in range(60)] + [(3, "s", "en", n, "same") for n in range(50)] + [(4, "s", "en", 1, "copy")] * 40
    check_manifest(spark, rows + [(n, "s", "en", n, "own") for n in range(5, 40)])


def test_manifest_of_small_tables(spark, empty):
    check_manifest(spark, [(1, "s", "en", 1, "lone")])
    check_manifest(spark, [(n, "s", f"l{n}", n, "one each") for n in range(5)])
    assert merkle_manifest.manifest(spark.createDataFrame([], DOC)).isEmpty()


def test_ranks_in_a_block():
    import numpy as np

    pick = np.random.RandomState(1)
    for n in (0, 1, 50, 300, 4096):
        low = pick.permutation(4096)[:n]
        times = pick.randint(1, 4, n)
        block = merkle_manifest.Block(merkle_manifest.Block.pack(low, times))
        asked = np.arange(4096)
        assert [int(times[low < x].sum()) for x in asked] == block.rank(asked).tolist()
        assert block.times(low).tolist() == times.tolist()


# --- the pipeline, each stage on what its predecessor left ----------------------------------


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    from dqloom.llm import common, quality_rules

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    columns, rows = docs.columns, [tuple(r) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, sf_dir))
        before, rows = rows, [tuple(r) for r in out.collect()]
        pairs = [r[:2] for r in before]
        if name == "quality_rules":
            verdicts = quality_rules.judged([(t or "").encode() for _, t in pairs])
            assert all(v[:6] == brute.base_rules(t) for (_, t), v in zip(pairs, verdicts))
            expected = [r for r, v in zip(before, verdicts) if v[7]]
        elif name == "jaccard_join":
            expected = [r for r, (i, _, root) in zip(before, brute.similar(pairs)) if i == root]
        elif name == "benchmark_decontamination":
            expected = [r for r, (_, _, hit, _) in zip(before, brute.passages(pairs, items)) if not hit]
        elif name == "mixing":
            sizes, took = Counter(), Counter()
            for r in before:
                sizes[r[3]] += len(brute.words(r[1]))
            for r in rows:
                took[r[3]] += len(brute.words(r[1]))
            longest = max(len(brute.words(r[1])) for r in before)
            assert all(abs(took[s] - t) <= longest / 2 for s, t in brute.targets(sizes).items())
            assert set(rows) <= set(before) and max(Counter(rows).values()) <= 3
            expected = rows
        else:
            assert Counter(r[: len(columns)] for r in rows) == Counter(before)
            assert out.columns == [*columns, "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
            expected = rows
        assert Counter(rows) == Counter(expected), name
        assert name == "sharding" or out.columns == columns
        docs = out

"""Each operator against its plain meaning, on rows with all the odd cases."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from dqloom.llm import (
    common,
    decontamination,
    jaccard_join,
    line_dedup,
    mixing,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    suffix_dedup,
    token_counts,
)


def same(frame, expected):
    def plain(v):
        return bytes(v) if isinstance(v, bytearray) else tuple(v) if isinstance(v, list) else v

    got = [tuple(map(plain, r)) for r in frame.collect()]
    assert Counter(got) == Counter(tuple(map(plain, r)) for r in expected)


@pytest.fixture(scope="module")
def pairs(rows):
    return [r[:2] for r in rows]


@pytest.fixture(scope="module")
def nameless_pairs(nameless):
    return [tuple(r) for r in nameless.select("doc_id", "text").collect()]


# --- 1: substring dedup ------------------------------------------------------------


@pytest.mark.parametrize("hot", [1, 4096])
def test_substrings(docs, pairs, monkeypatch, hot):
    """With and without anchors whose edges travel by themselves."""
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    same(substring_dedup.without_repeats(docs).drop("spans"), brute.word_windows(pairs))


def test_substrings_of_odd_tables(empty, nameless, nameless_pairs):
    assert substring_dedup.without_repeats(empty).isEmpty()
    same(substring_dedup.without_repeats(nameless).drop("spans"), brute.word_windows(nameless_pairs))


# --- 2: benchmark decontamination -----------------------------------------------------


@pytest.mark.parametrize("size", [300, 8 << 20])
def test_passages(spark, docs, pairs, monkeypatch, size):
    """With one and with several blocks of items; short items of each length."""
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", size)
    w = brute.words(next(t for i, t in pairs if i == 0))
    items = [(1, " ".join(w[2:16]).upper()), (2, "one"), (3, None), (4, "; ,"), (5, "a, b"), (5, "a, b"), (None, " ".join(w[-11:])), (6, "x x x")]
    clean = decontamination.clean(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == docs.columns
    expected = [i for i, _, hit, _ in brute.passages(pairs, items) if not hit]
    assert sorted(r.doc_id for r in clean.select("doc_id").collect()) == sorted(expected)
    own = decontamination.marked(docs.select("doc_id", "text"), spark.createDataFrame(items, "item_id long, text string"))
    same(own.select("doc_id", "found.n_words", "found.n_hit", "found.items"), brute.passages(pairs, items))


def test_passages_of_odd_tables(spark, empty, nameless):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.clean(empty, none).isEmpty()
    assert decontamination.clean(nameless, none).count() == 3


# --- 3: quality rules ---------------------------------------------------------------


def test_base_rules(docs, pairs):
    found = quality_rules.marked(docs.select("doc_id", "text"))
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    same(found.select("doc_id", *[f"rules.{f}" for f in fields]), [(i, *brute.base_rules(t)) for i, t in pairs])


def test_viterbi_is_the_best_path():
    pick = random.Random(2)
    for n in range(1, 8):
        for _ in range(20):
            scores = [pick.uniform(-2, 2) for _ in range(n)]

            def worth(path, scores=scores):
                return sum(s for s, p in zip(scores, path) if p) + quality_rules.STAY * sum(a == b for a, b in zip(path, path[1:]))

            best = max(worth(p) for p in itertools.product([False, True], repeat=n))
            assert abs(worth(quality_rules.viterbi(scores)) - best) < 1e-9


def test_rules_keep_clean_texts(docs, empty, nameless):
    prose = "It was a plain day, and nothing much happened in the little town by the sea."
    junk = [" | ".join(f"cell{i}" for i in range(30)), " ".join(f"BUY{i}!!" for i in range(20)), " ".join(f"w{i}$$$" for i in range(20))]
    verdicts = [r[7] for r in quality_rules.judged([prose.encode(), *[j.encode() for j in junk]])]
    assert verdicts == [True, False, False, False]
    assert quality_rules.kept(docs).columns == docs.columns
    assert quality_rules.kept(empty).isEmpty()
    assert quality_rules.kept(nameless).count() == 2


def test_acronyms_in_other_scripts_do_not_shout():
    clean = [
        "世界 卫生 组织 表示 , COVID 疫情 在 许多 国家 仍 在 继续 , 各国 需要 保持 警惕 。",
        "Вчера агентство NASA сообщило, что новый аппарат успешно вышел на орбиту вокруг далёкой планеты.",
        "Η σελίδα είναι γραμμένη σε HTML και ανοίγει εύκολα σε κάθε υπολογιστή που έχει σύνδεση.",
        "أعلنت وكالة NASA أمس أن المركبة الجديدة وصلت بنجاح إلى مدارها حول الكوكب البعيد.",
    ]
    shouted = ["BUY THIS NOW AND SAVE A LOT OF MONEY ON ALL OF IT TODAY", "ÉTÉ À LA MER: DÉCOUVREZ NOS CONGÉS DÉJÀ RÉSERVÉS À PRIX RÉDUITS", "СКИДКИ НА ВСЕ ТОВАРЫ ТОЛЬКО СЕГОДНЯ И ТОЛЬКО У НАС В МАГАЗИНЕ"]
    found = quality_rules.judged([t.encode() for t in clean + shouted])
    assert [r[7] for r in found] == [True] * 4 + [False] * 3
    assert [r[6] for r in found] == [1.0] * 4 + [0.0] * 3


# --- 4: n-gram Jaccard join ------------------------------------------------------------


@pytest.mark.parametrize("tile", [2, 1024])
def test_similar(docs, pairs, monkeypatch, tile):
    """With groups that fit a tile and groups that are cut into bands and blocks."""
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    same(jaccard_join.joined(docs), brute.similar(pairs))


def test_tiles_alone_find_all_pairs(spark, pairs, monkeypatch):
    """Every link is found by tiles where nothing has been joined before."""
    monkeypatch.setattr(jaccard_join, "TILE", 4)
    docs = common.texts(spark.createDataFrame([p for p in pairs if p[1]], "doc_id long, text string"))
    found = jaccard_join._first_tokens(docs, 0)
    nodes = found.where("token is null and n > 0").groupBy("s1").agg({"id": "min"}).select("s1")
    nodes = nodes.join(found.where("token is null").select("s1", "id", "n", "signature").dropDuplicates(["s1"]), "s1")
    shared = found.where("token is not null").select("token", "s1").distinct()
    rest = jaccard_join._tiles(shared, nodes, nodes.selectExpr("s1", "id as root"))
    links = common.components(jaccard_join._links(docs, nodes, rest, 0)).collect()
    groups = defaultdict(set)
    for i, n, c in brute.similar([p for p in pairs if p[1]]):
        if n:
            groups[c].add(i)
    texts = dict(pairs)
    for r in links:
        root = next(c for c, g in groups.items() if r.node in g)
        assert next(c for c, g in groups.items() if r.root in g) == root
    several = [g for g in groups.values() if len({texts[i].translate(brute.LOW).strip() for i in g}) > 1]
    assert len({r.root for r in links}) == len(several)


def test_a_pair_is_passed_on_by_one_tile():
    """Two nodes with the first shingles 1 and 2 meet in both tiles."""
    import pandas as pd

    def passed(token, lists):
        row = {"tile": 0, "token": token, "low": 3, "i": 0, "j": 0, "block": 0, "band": 3, "n": 9, "signature": bytes(32)}
        held = pd.DataFrame([row | {"root": k, "s1": k, "early": np.array(x)} for k, x in enumerate(lists)])
        return jaccard_join._compared(held)[["x", "y"]].to_numpy().tolist()

    assert passed(1, [[1, 2], [1, 2]]) == passed(2, [[2], [1, 2]]) == [[0, 1]]
    assert passed(2, [[1, 2], [1, 2]]) == []


def test_tiles_get_only_rows_that_may_have_a_partner(spark):
    """Bands of 57 to 74 and of 75 to 99 shingles: 60 and 99 cannot match, 74 and 98 can, of 74 the component is that of 75."""
    nodes = spark.createDataFrame([(s1, bytearray(32)) for s1 in range(10)], "s1 long, signature binary")
    sizes = {1: {0: 60, 1: 99}, 2: {2: 74, 3: 98, 4: 75, 5: 99}, 3: {2: 74, 3: 98}, 4: {6: 60, 7: 61, 8: 90}}
    rows = [(t, s1, 2 if s1 == 4 else s1, n, len(group)) for t, group in sizes.items() for s1, n in group.items()]
    found = jaccard_join._dealt(spark.createDataFrame(rows, "token long, s1 long, root long, n long, g long"), nodes)
    dealt = defaultdict(list)
    for r in found.collect():
        dealt[r.token, r.low].append((r.s1, r.early))
    dealt = {k: sorted(v) for k, v in dealt.items()}
    low = min(b for _, b in dealt)
    assert dealt == {
        (2, low): [(2, []), (3, [])],
        (2, low + 1): [(3, []), (4, []), (5, [])],
        (3, low): [(2, [2]), (3, [2])],
        (4, low): [(6, []), (7, [])],
    }


def test_what_a_stored_frame_shuffled_goes_when_it_is_written(spark, monkeypatch):
    """The driver's garbage, collected at once, often still holds the write."""
    from pyspark.sql import DataFrameWriter

    write, seen = DataFrameWriter.parquet, []

    def parquet(self, *rest, **more):
        seen.append(spark.conf.get(common.DROPS_SHUFFLES, None))
        return write(self, *rest, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    before = spark.conf.get(common.DROPS_SHUFFLES, None)
    kept = common.stored(spark.range(100_000).groupBy("id").count())
    assert kept.count() == 100_000 and seen == ["true"]
    assert spark.conf.get(common.DROPS_SHUFFLES, None) == before


def test_workers_forget_words_at_the_end_of_a_task(spark, docs):
    quality_rules.kept(docs).collect()
    left = spark.range(0, 64, 1, 16).mapInPandas(lambda frames: (f.assign(id=len(common._HASHES)) for f in frames), "id long")
    assert {r.id for r in left.collect()} == {0}


def test_one_of_each(docs, pairs, empty, nameless):
    left = jaccard_join.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == sorted({i for i, _, c in brute.similar(pairs) if i == c})
    assert jaccard_join.one_of_each(empty).isEmpty()
    assert sorted(r.doc_id for r in jaccard_join.one_of_each(nameless).select("doc_id").collect()) == [3, 5]


def test_rows_that_share_a_doc_id_or_have_none_are_told_apart(spark):
    """Unrelated rows do not meet in their missing or common doc_id."""
    texts = [" ".join(f"{k}{i}" for i in range(60)) for k in "abcdefg"]
    near = [t + " more" for t in texts]
    rows = [(3, texts[0]), (7, texts[1]), (None, near[0]), (None, near[1]), (None, texts[2]), (None, texts[3]), (None, near[3])]
    rows += [(9, texts[4]), (9, texts[5]), (5, near[5]), (None, ""), (None, None), (None, texts[2]), (8, texts[6])]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    of = [3, 7, 3, 7, None, None, None, 9, 5, 5, None, None, None, 8]
    sizes = [len(set(zip(*[brute.words(t)[k:] for k in range(5)]))) for _, t in rows]
    same(jaccard_join.joined(docs.drop("n")), [(i, size, c) for (i, _), size, c in zip(rows, sizes, of)])
    left = jaccard_join.one_of_each(docs).collect()
    groups = [{0, 2}, {1, 3}, {4, 12}, {5, 6}, {7}, {8, 9}, {10}, {11}, {13}]
    assert sorted(next(k for k, g in enumerate(groups) if r.n in g) for r in left) == list(range(9))
    assert sorted(r.doc_id for r in left if r.doc_id) == [3, 5, 7, 8, 9]


def test_components(spark):
    pick = random.Random(3)
    for edges in ([(1, 2), (7, 7)], [(i, i + 1) for i in range(30)], [(pick.randrange(40), pick.randrange(40)) for _ in range(30)]):
        root = {}

        def find(x, root=root):
            root.setdefault(x, x)
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        same(common.components(spark.createDataFrame(edges, "x long, y long")), {(x, find(x)) for a, b in edges if a != b for x in (a, b)})


# --- 5: mixing ---------------------------------------------------------------------


def test_mix(spark, docs, rows, empty, nameless):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    found = mixing.taken(docs, labels).collect()
    assert len(found) == len(rows)
    sizes, took = Counter(), Counter()
    for _, text, source, *_ in rows:
        sizes[source] += len(brute.words(text))
    aim = brute.targets(sizes)
    for r in found:
        took[r.source] += r.taken
        assert r.source_size == sizes[r.source] and abs(r.target - aim[r.source]) < 1e-6 and r.taken <= 3 * r.size
    for source, target in aim.items():
        assert abs(took[source] - target) <= max(len(brute.words(r[1])) for r in rows) / 2
    assert Counter(mixing.taken(docs, labels).collect()) == Counter(found)
    out = mixing.mixed(docs, labels)
    assert out.columns == docs.columns
    assert mixing.taken(empty, labels).isEmpty() and mixing.mixed(empty, labels).isEmpty()
    assert mixing.taken(nameless).count() == 3


def test_repeated_rows_stay_within_the_budget(spark, monkeypatch):
    """Sources made mostly of one repeated row, with a doc_id and without."""
    monkeypatch.setattr(mixing, "RUN", 16)
    rows = [(1, "word " * 10, "a")] * 70 + [(None, "none " * 10, "b")] * 90 + [(2, "both " * 10, "c")] * 50
    rows += [(10 + i, f"w{i} " * 10, "abc"[i % 3]) for i in range(30)]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, source string, n int").repartition(3)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    aim = brute.targets(sizes)
    found, out = mixing.taken(docs).collect(), mixing.mixed(docs).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    copies = Counter(r.n for r in out)
    for source, target in aim.items():
        assert abs(sum(r.taken for r in found if r.source == source) - target) <= 5
        assert abs(sum(len(r.text.split()) for r in out if r.source == source) - target) <= 5
        of = [copies[n] for n, r in enumerate(rows) if r[2] == source]
        assert max(of) - min(of) <= 1
    assert Counter((r.doc_id, r.source) for r in found for _ in range(r.copies)) == Counter((r.doc_id, r.source) for r in out)


def test_targets_are_capped_and_shared_again(spark):
    for sizes in ({"a": 1000, "b": 1, "c": 5, "d": 100}, {"a": 0, "b": 7, None: 3}, {"x": 10}):
        rows = [(s, n) for s, n in sizes.items()]
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
        for s, t in brute.targets(sizes).items():
            assert abs(got[s] - t) < 1e-9


def test_heavier_documents_come_first(spark):
    rows = [(i, f"t{i} " * 10, "s") for i in range(2000)] + [(i, "u " * 10, "z") for i in range(2000, 2500)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    part = [r for r in mixing.taken(docs, labels).collect() if r.source == "s" and r.taken]
    good = sum(r.doc_id % 2 for r in part)
    assert len(part) < 2000 and good > 0.55 * len(part)


# --- 6: quality classifier -------------------------------------------------------------


def test_classifier(spark, sf_dir, empty, docs):
    """Held-out accuracy on real rows; labels of the held-out fold don't matter."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    found = quality_classifier.scored(texts, labels).select("doc_id", "quality.*").collect()
    held = [r for r in found if r.held_out and r.doc_id in known]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert held and np.mean([r.predicted == known[r.doc_id] for r in held]) >= 0.9
    swapped = labels.selectExpr("doc_id", "if(pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0, 1 - quality, quality) as quality")
    again = quality_classifier.scored(texts, swapped).select("doc_id", "quality.*").collect()
    assert sorted(again) == sorted(found)
    none = quality_classifier.scored(docs, labels.limit(0)).select("quality.score").distinct().collect()
    assert [r.score for r in none] == [0.5]
    assert quality_classifier.scored(empty, labels).isEmpty()


# --- 7: line dedup -----------------------------------------------------------------


def test_lines(docs, pairs, empty, nameless, nameless_pairs):
    same(line_dedup.without_repeats(docs), brute.lines(pairs))
    assert line_dedup.without_repeats(empty).isEmpty()
    same(line_dedup.without_repeats(nameless), brute.lines(nameless_pairs))


def test_full_filters_change_nothing(docs, pairs, monkeypatch):
    monkeypatch.setattr(line_dedup, "BITS", 17)
    same(line_dedup.without_repeats(docs), brute.lines(pairs))


# --- 8: sharding -------------------------------------------------------------------


def check_shards(found, texts, shards):
    sizes, slots = Counter(), defaultdict(list)
    for r in found:
        assert r.size == len((r.text or "").encode()) + 8 and r.text_crc32 == zlib.crc32((r.text or "").encode())
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return sizes


def test_shards(docs, pairs, empty):
    placed = sharding.sharded(docs, 5).select("doc_id", "text", "place.*").collect()
    assert sorted((r.doc_id, r.text or "") for r in placed) == sorted((i, t or "") for i, t in pairs)
    sizes = check_shards(placed, pairs, 5)
    total, largest = sum(sizes.values()), max(len((t or "").encode()) + 8 for _, t in pairs)
    assert all(abs(s - total / 5) <= largest for s in sizes.values())
    assert sharding.sharded(empty, 3).isEmpty()


def test_columns_that_clash_with_results(spark, docs, model_path):
    """A result takes the place of an input column of its name; all others stay."""
    import corpus_pipeline

    names = ["doc_id", "text", "place", "Found", "rules", "quality", "tokens", "shard", "size", "slot", "law", "c0", "own0"]
    rows = spark.createDataFrame([(i, f"word{i} " * 20, *names[2:]) for i in range(30)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[2:]))
    none, labels = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([], "doc_id long, quality int")
    for found, own in (
        (decontamination.marked(rows, none), "found"), (quality_rules.marked(rows), "rules"), (sharding.sharded(rows, 3), "place"),
        (quality_classifier.scored(rows, labels), "quality"), (token_counts.counted(rows, model_path), "tokens"),
    ):
        assert found.columns == [n for n in names if n.lower() != own] + [own]
        assert found.where(f"{own} is not null and c0 = 'c0'").count() == 30
    out = corpus_pipeline.shards(spark, rows, "")
    assert out.columns == ["doc_id", "text", "place", "Found", "rules", "quality", "tokens", "c0", "own0", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {(r.place, r.law) for r in out.collect()} == {("place", "bytes")}


def test_copies_are_split_only_as_needed(spark):
    rows = [(i, "the same text") for i in range(3000)] + [(3000 + i, f"text {i} of its own") for i in range(3000)]
    placed = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), 8).select("doc_id", "text", "place.*").collect()
    sizes = check_shards(placed, rows, 8)
    assert max(sizes.values()) <= 1.01 * sum(sizes.values()) / 8
    assert len({r.shard for r in placed if r.text == "the same text"}) <= 5


# --- 9: suffix-array dedup ------------------------------------------------------------


@pytest.mark.parametrize("hot", [1, 4096])
def test_strings(docs, pairs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    found = suffix_dedup.without_repeats(docs).selectExpr("doc_id", "n_bytes", "n_removed", "size(spans)", "kept")
    same(found, brute.byte_strings(pairs))


def test_strings_of_odd_tables(empty, nameless, nameless_pairs):
    assert suffix_dedup.without_repeats(empty).isEmpty()
    found = suffix_dedup.without_repeats(nameless).selectExpr("doc_id", "n_bytes", "n_removed", "size(spans)", "kept")
    same(found, brute.byte_strings(nameless_pairs))


@pytest.mark.parametrize("hot", [1, 4096])
def test_strings_of_texts_that_share_a_doc_id(spark, monkeypatch, hot):
    """Different texts with one doc_id, or none; anchors with one content and with several."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    pick = random.Random(9)
    made = lambda n: "".join(pick.choice("abcdefghijklmnop") for _ in range(n))
    rows = []
    for i in (None, 4):
        passage = made(260)
        rows += [(i, made(10) + passage + made(30)), (i, made(500) + passage + made(20)), (i, made(40) + passage[:150] + made(40))]
        rows += [(i, same_text := made(300)), (i, "x" + same_text)]
    rows += [(9, rows[0][1]), rows[5]]
    found = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    same(found.selectExpr("doc_id", "n_bytes", "n_removed", "size(spans)", "kept"), brute.byte_strings(rows))


def test_copies_of_a_crowded_string_stay_rows_of_their_own(spark, monkeypatch):
    """Copies are one content: no table holds a row for each string of each copy."""
    monkeypatch.setattr(suffix_dedup, "HOT", 4)
    stored, most = common.stored, []

    def counted(df, *rest, **more):
        out = stored(df, *rest, **more)
        most.append(out.count())
        return out

    monkeypatch.setattr(common, "stored", counted)
    pick = random.Random(3)
    base = "".join(pick.choice("abcdefghijklmnop") for _ in range(400))
    rows = [(i, base) for i in range(60)] + [(i, base[:200] + str(i) + base[201:]) for i in range(60, 80)]
    found = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    same(found.selectExpr("doc_id", "n_bytes", "n_removed", "size(spans)", "kept"), brute.byte_strings(rows))
    assert max(most) < 5_000


@pytest.mark.parametrize("length", [5, 8, 24, 30, 100])
def test_equal_suffixes(length):
    pick = random.Random(length)
    data = bytes(pick.choice(b"ab") for _ in range(300)) * 2 + bytes(pick.choice(b"abc") for _ in range(400))
    at = np.arange(len(data) - length)
    bucket = np.array([pick.randrange(2) for _ in at])
    classes = suffix_dedup.equal_suffixes(np.frombuffer(data + bytes(8), np.uint8), at, bucket, length)
    keys = [(int(b), data[a : a + length]) for a, b in zip(at, bucket)]
    assert len(set(keys)) == len(set(classes.tolist())) == len(set(zip(keys, classes.tolist())))


# --- 10: token counts ----------------------------------------------------------------


@pytest.fixture(scope="module")
def model_path():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def test_tokens(docs, pairs, empty, model_path):
    model = token_counts.counter(model_path).model
    found = token_counts.counted(docs, model_path, limit=50).select("doc_id", "tokens.*")
    counts = [(i, t or "", len(model.encode(t or ""))) for i, t in pairs]
    same(found, [(i, len(t.encode()), n, n > 50) for i, t, n in counts])
    assert token_counts.counted(empty, model_path).isEmpty()


def test_a_text_without_boundaries_is_not_encoded_chunk_by_chunk(model_path):
    counter = token_counts.counter(model_path)
    read = 0
    offsets = type(counter)._offsets

    class Watched(type(counter)):
        def _offsets(self, text):
            nonlocal read
            read += len(text)
            return offsets(self, text)

    text = "a" * 400_000
    assert Watched(model_path).count(text) == len(counter.model.encode(text))
    assert read < 12 * len(text)


def test_spliced_chunks_count_like_whole_texts(model_path):
    counter = token_counts.counter(model_path)
    assert counter.keeps
    pick = random.Random(1)
    for letters in ("ab", "a ", "aaaaab", "中文字a ", "xyz\n\t ", "= ", "éñ𐍈ab ", " "):
        for n in (40, 400, 2000):
            text = "".join(pick.choice(letters) for _ in range(n))
            for chunk, overlap in ((40, 1), (200, 30)):
                assert counter.count(text, 10, chunk, overlap) == len(counter.model.encode(text)), (letters, n)

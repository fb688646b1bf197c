import base64
import math
import os
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from compare import SF, duck, same
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from poselake.llm import clusters, cooccurrence, cutoff, frequency, mojibake, packing, tokens, topn
from poselake.llm import queries as Q
from poselake.llm.pretokens import piece_starts

NAN, INF = float("nan"), float("inf")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@needs_tables
@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(spark, name):
    df = Q.queries()[name](spark, SF)
    if name in Q.oracle_sql():
        same(df, duck(), Q.oracle_sql()[name])
    else:
        df.collect()


# 1 -----------------------------------------------------------------------------------------------
def test_term_frequencies_against_counting(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["hot"] * 8 + [f"t{i}" for i in range(30)] + [None]), rnd.choice([None, *range(60)]), "x") for _ in range(3000)]
    df = spark.createDataFrame(data, "term string, record int, n string").repartition(6)  # n: a clashing name
    pairs = frequency.term_pairs(df, {"f": F.col("term")}, F.col("record"))
    got = {r.term: r for r in frequency.term_frequencies(pairs, 5, 30).collect()}
    occ, rec = Counter(t for t, _, _ in data if t), defaultdict(set)
    for t, r, _ in data:
        if t and r is not None:
            rec[t].add(r)
    assert {t: (r.n_occurrences, r.n_records) for t, r in got.items()} == {t: (occ[t], len(rec[t])) for t in occ}
    for t, r in got.items():
        assert r.mark == ("rare" if len(rec[t]) < 5 else "common" if len(rec[t]) > 0.3 * 60 else None) and math.isclose(r.share, len(rec[t]) / 60)


def test_term_frequencies_of_nothing(spark):
    df = spark.createDataFrame([], "term string, record int")
    assert frequency.term_frequencies(frequency.term_pairs(df, {"f": F.col("term")}, F.col("record"))).count() == 0
    df = spark.createDataFrame([("a", None), (None, 1)], "term string, record int")
    got = frequency.term_frequencies(frequency.term_pairs(df, {"f": F.col("term")}, F.col("record"))).collect()
    assert [(r.term, r.n_occurrences, r.n_records, r.mark) for r in got] == [("a", 1, 0, "rare")]


# 2 -----------------------------------------------------------------------------------------------
def test_cutoffs_against_sorting(spark):
    rnd = random.Random(2)
    data = [("big", "s", round(rnd.gauss(0, 2), 1)) for _ in range(4000)] + [("small", "s", float(i)) for i in range(7)] + [("one", "s", 5.0), ("same", "s", 1.0), ("same", "s", 1.0), ("none", "s", 1.0), ("nul", "s", 2.0)]
    data += [("big", "s", v) for v in (NAN, INF, -INF, None)] + [(None, "s", 1.0)]
    targets = [("big", "s", 7), ("small", "s", 50), ("one", "s", 1), ("same", "s", 50), ("nul", "s", None), ("absent", "s", 5)]
    scores, wanted = spark.createDataFrame(data, "source string, score_name string, score double").repartition(5), spark.createDataFrame(targets, "source string, score_name string, target_percent int")
    got = {r.source: r for r in cutoff.score_cutoffs(scores, wanted).collect()}
    assert set(got) == {"big", "small", "one", "same", "none", "nul"}
    for source, _, target in targets[:4]:
        v = sorted(x for s, _, x in data if s == source and x is not None and math.isfinite(x))
        c = next(x for x in v if 100 * sum(y <= x for y in v) >= target * len(v))
        r = got[source]
        assert (r.cutoff, r.n_kept, r.n_tied, r.n_total) == (c, sum(y <= c for y in v), v.count(c), len(v))
    assert got["none"].cutoff is None and got["nul"].n_kept == 0
    assert cutoff.kept_rows(scores, cutoff.score_cutoffs(scores, wanted)).filter("source = 'same'").count() == 2
    assert cutoff.score_cutoffs(scores.limit(0), wanted).count() == 0


@pytest.mark.parametrize("in_order", [3, 100_000])
def test_cutoffs_when_the_sketch_misses(spark, in_order, monkeypatch):
    monkeypatch.setattr(cutoff, "IN_ORDER", in_order)  # 3: bins narrow the scores down first
    monkeypatch.setattr(cutoff, "BINS", 5)
    scores = spark.createDataFrame([("a", "s", float(i % 500)) for i in range(5000)], "source string, score_name string, score double")
    for target in (0, 33, 100, 120):
        wanted = spark.createDataFrame([("a", "s", target)], "source string, score_name string, target_percent int")
        r = cutoff.score_cutoffs(scores, wanted, k=8, rank_error=0.0001).first()  # a tiny sketch: its brackets are wrong
        n = max(1, min(500, -(-target * 500 // 100)))
        assert (r.cutoff, r.n_kept) == (float(n - 1), n * 10)


# 3 -----------------------------------------------------------------------------------------------
def test_top_n_against_sorting(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["hot"] * 5 + [f"g{i}" for i in range(40)] + [None]), i, rnd.choice([-1.0, -2.5, 0.0, 3.0, NAN, INF, None]), "x") for i in range(4000)]
    df = spark.createDataFrame(data, "g string, pose int, score double, place string").repartition(5)
    got = {(r.g, r.pose) for r in topn.top_n_per_group(df, "g", "score", "pose", 3, span=16).collect()}
    by = defaultdict(list)
    for g, p, s, _ in data:
        if g is not None and s is not None and math.isfinite(s):
            by[g].append((s, p))
    assert got == {(g, p) for g, v in by.items() for _, p in sorted(v)[:3]}
    assert topn.top_n_per_group(df.limit(0), "g", "score", "pose").count() == 0


@given(st.lists(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), max_size=12), max_size=6), st.integers(1, 4))
@settings(max_examples=80, deadline=None)
def test_loser_tree_merges(lists, n):
    runs, at, rows = [], 0, []
    for items in lists:
        items = sorted(items)
        runs.append((np.array([g for g, _ in items], np.int64), [k for _, k in items], np.arange(at, at + len(items))))
        rows += items
        at += len(items)
    got = [rows[i] for i in topn.merge_runs(runs, n)]
    want = []
    for g in sorted({g for g, _ in rows}):
        want += sorted(x for x in rows if x[0] == g)[:n]
    assert got == want


# 4 -----------------------------------------------------------------------------------------------
@pytest.mark.parametrize("segment", [1, 3, 512])
def test_pairs_against_counting(spark, segment, monkeypatch):
    monkeypatch.setattr(cooccurrence, "SEGMENT", segment)
    rnd = random.Random(4)
    baskets = [sorted({rnd.choice("abcdefghij") for _ in range(rnd.randint(0, 7))}) for _ in range(200)]
    df = spark.createDataFrame([(b, 1) for b in baskets], "items array<string>, n int").repartition(3)
    single, both = Counter(), Counter()
    for b in baskets:
        single.update(b)
        both.update(combinations(b, 2))
    monkeypatch.setattr(cooccurrence, "WIDE", 2)
    whole = cooccurrence.merged_stripes(cooccurrence.stripes(df.filter(F.size("items") > 0), segment).repartition(5)).collect()
    cells = Counter({(r.item, n): c for r in whole for n, c in zip(r.neighbours, r.counts)})
    assert sum(len(r.neighbours) for r in whole) == len(cells)  # every neighbour once
    assert {k: c for k, c in cells.items() if k[0] < k[1] and k[0]} == dict(both)
    got = {(r.item_a, r.item_b): r for r in cooccurrence.item_pairs(df).collect()}
    n = sum(bool(b) for b in baskets)
    assert {k: r.n for k, r in got.items()} == dict(both)
    for (a, b), r in got.items():
        assert (r.n_a, r.n_b, r.n_baskets) == (single[a], single[b], n) and math.isclose(r.lift, r.n * n / single[a] / single[b])
        cells4 = [(r.n, single[a], single[b]), (single[a] - r.n, single[a], n - single[b]), (single[b] - r.n, n - single[a], single[b]), (n - single[a] - single[b] + r.n, n - single[a], n - single[b])]
        llr = 2 * sum(k * math.log(k * n / (x * y)) for k, x, y in cells4 if k > 0)
        assert math.isclose(abs(r.llr), llr, abs_tol=1e-6) and (r.llr >= 0) == (r.lift >= 1)
    assert cooccurrence.item_pairs(df.limit(0)).count() == 0
    assert all(r.n >= 20 and r.lift >= 1.0 for r in cooccurrence.item_pairs(df, 20, 200, 1.0).collect())


# 5 -----------------------------------------------------------------------------------------------
def _chains(p, reach):
    near = ((p[:, None] - p[None]) ** 2).sum(2) <= reach**2 + 1e-9
    label = np.arange(len(p))
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label
        label = new


def test_near_groups_against_brute_force(spark):
    rng = np.random.default_rng(6)
    p = np.round(np.concatenate([rng.uniform(-12, 12, (250, 3)), np.zeros((40, 3)), [[0, 0, 2.0], [1.2, 1.6, 2.0]]]), 3)
    data = [("a" if i % 7 else "b", i, *map(float, x)) for i, x in enumerate(p)] + [("a", 900, NAN, 0.0, 0.0), ("a", 901, None, 0.0, 0.0), (None, 902, 0.0, 0.0, 0.0), (None, 903, 0.5, 0.0, 0.0)]
    df = spark.createDataFrame([(*r, "x") for r in data], "space string, id int, x double, y double, z double, node string")
    got = {r.id: r.first_id for r in clusters.near_groups(df, ["space"], "id", ("x", "y", "z"), 2.0).collect()}
    for s in "ab":
        ids = np.array([i for t, i, *_ in data if t == s and i < 900])
        want = ids[_chains(p[ids], 2.0)]
        assert [got[int(i)] for i in ids] == want.tolist()
    assert got[902] == got[903] == 902 and 900 not in got and 901 not in got
    far = spark.createDataFrame([("a", 1, 0.0, 0.0, 0.0), ("a", 2, 10.0, 0.0, 0.0), ("a", 3, 50.0, 3.0, 1.0), ("a", 4, -1e20, 0.0, 0.0)], "space string, id int, x double, y double, z double")
    assert {r.id: r.first_id for r in clusters.near_groups(far, ["space"], "id", ("x", "y", "z")).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    assert clusters.near_groups(df.limit(0), ["space"], "id", ("x", "y", "z")).count() == 0


def test_kmeans_finds_separate_blobs(spark, monkeypatch):
    monkeypatch.setattr(clusters, "PART", 7)  # every space is dealt to several tasks
    rng = np.random.default_rng(7)
    p = np.concatenate([rng.normal(c, 0.2, (6, 3)) for c in ((0, 0, 0), (20, 0, 0), (0, 20, 0))] + [np.zeros((5, 3))] * 2)
    data = [("a" if i < 23 else None, i, *map(float, x)) for i, x in enumerate(p)] + [("a", 999, None, 0.0, 0.0), ("a", 998, INF, 0.0, 0.0)]
    df = spark.createDataFrame(data, "space string, id int, x double, y double, z double").withColumn("frame", F.lit("clash"))
    got = clusters.frame_clusters(df, ["space"], "id", clusters.hashed_features({"x": 1.0, "y": 1.0, "z": 1.0}, {}, 0)).collect()
    a = [r for r in got if r.space == "a"]
    assert sum(r.n_members for r in a) == 23 and len(a) == 4 and max(r.radius for r in a) < 2  # k = ceil(sqrt(23 / 2)); none spans two blobs
    assert [(r.n_members, r.radius, r.typical) for r in got if r.space is None] == [(5, 0.0, [23, 24, 25])]
    again = clusters.frame_clusters(df.repartition(3), ["space"], "id", clusters.hashed_features({"x": 1.0, "y": 1.0, "z": 1.0}, {}, 0)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert clusters.frame_clusters(df.limit(0), ["space"], "id", F.array("x")).count() == 0


def test_typical_members(spark):
    df = spark.createDataFrame([(s, i, float(i % 5), 0.0, 0.0, f) for s, f, n in (("a", 1, 9), (None, 3, 4)) for i in range(n)], "space string, id int, x double, y double, z double, first_id int")
    got = {r.first_id: r for r in clusters.typical_members(df, ["space"], "id", ("x", "y", "z")).collect()}
    assert (got[1].n_members, got[1].typical) == (9, [2, 7, 1]) and got[3].space is None and got[3].typical == [1, 2, 0]


# 6 -----------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def public():
    import tiktoken

    P = pytest.importorskip("public_tokenizers")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TRICKY = [None, "", " ", "\n\n", "   a", "a  ", "it's  'save 'll 'LL don''t", "'re've", "12٣½ ²", "é́ñ 漢字かな 한국어", "🙂👩‍🔬​", "\r\n\t x", "\xa0\xa0y", "<|endoftext|>", "a" * 3000, "'" * 50 + "s", "x" * 5 + " " * 700 + "y"]


def test_encoding_against_the_library(spark, public):
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(TRICKY)], "doc_id int, text string, ids string").repartition(3)
    got = {r.doc_id: r.ids for r in tokens.encode_corpus(df).collect()}
    assert got == {i: public.encode_ordinary(t or "") for i, t in enumerate(TRICKY)}
    assert {r.doc_id: r.n_tokens for r in tokens.token_counts(df).collect()} == {i: len(v) for i, v in got.items()}
    back = {r.doc_id: r.decoded for r in tokens.decode_corpus(tokens.encode_corpus(df)).collect()}
    assert back == {i: t or "" for i, t in enumerate(TRICKY)}
    for r in tokens.encode_corpus(df, with_offsets=True).collect():
        data = (TRICKY[r.doc_id] or "").encode()
        ends = [*r.offsets[1:], len(data)]
        assert [public.decode_single_token_bytes(i) for i in r.ids] == [data[a:b] for a, b in zip(r.offsets, ends)]
    assert tokens.encode_corpus(df.limit(0)).count() == 0


@given(st.lists(st.text(alphabet="ab'sdtmrevlSL  \n\t\r\xa012٣½,.’é漢🙂", max_size=40), max_size=8))
@settings(max_examples=150, deadline=None)
def test_pieces_against_the_pattern(texts):
    import public_tokenizers as P
    import regex

    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    starts = piece_starts(np.frombuffer(b"".join(data), np.uint8), offsets[:-1][np.diff(offsets) > 0])
    want = [int(o) + len(t[: m.start()].encode()) for o, t in zip(offsets, texts) for m in regex.finditer(P.PATTERN, t)]
    assert starts.tolist() == want


def test_other_tokenizers(spark):
    import sentencepiece

    df = spark.createDataFrame([(1, "Docking pose 12"), (2, None), (3, "")], "doc_id int, text string")
    model = sentencepiece.SentencePieceProcessor(model_file=f"{tokens.tokenizer_dir()}/piece_bpe_32k.model")
    assert {r.doc_id: r.ids for r in tokens.encode_corpus(df, tokenizer="piece_bpe_32k").collect()} == {1: model.encode("Docking pose 12"), 2: [], 3: []}
    for name in ("word_bpe_49k", "byte_bpe_multi_50k"):
        assert {r.doc_id: len(r.ids) > 0 for r in tokens.encode_corpus(df, tokenizer=name).collect()} == {1: True, 2: False, 3: False}


# 7 -----------------------------------------------------------------------------------------------
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=15), st.integers(60, 100))
@settings(max_examples=100, deadline=None)
def test_plan_fits_and_covers(histogram, capacity):
    rows, n_bins = packing.plan(histogram, capacity)
    used, got = Counter(), Counter()
    for i, (length, start, first, per) in enumerate(rows.tolist()):
        later = [r[1] for r in rows.tolist() if r[0] == length and r[1] > start]
        end = min(later, default=histogram[length])
        for rank in range(start, end):
            used[first + (rank - start) // per] += length
            got[length] += 1
    assert got == Counter(histogram) and max(used.values(), default=0) <= capacity and set(used) == set(range(n_bins))
    total = sum(k * v for k, v in histogram.items())
    assert n_bins <= 2 * total / capacity + 1  # no two containers are half empty


def test_filling(spark):
    rnd = random.Random(8)
    sizes = [(i, rnd.choice([None, 0, 1, 5, 5, 5, 9, 23, 64, 150])) for i in range(500)]
    df = spark.createDataFrame([(*s, "x") for s in sizes], "doc_id int, n_tokens int, bin_no string").repartition(4)
    caps = {1: 10, 2: 64}
    got = packing.fill_containers(df, caps).collect()
    for kind, cap in caps.items():
        pieces = defaultdict(list)
        used = Counter()
        for r in got:
            if r.container_id == kind:
                pieces[r.doc_id].append((r.piece_no, r.size_from, r.size_of))
                used[r.bin_no] += r.size_of
        assert max(used.values()) <= cap and set(pieces) == {i for i, _ in sizes}
        for i, n in sizes:
            own = sorted(pieces[i])
            assert sum(s for _, _, s in own) == (n or 0) and len(own) == max(1, -(-(n or 0) // cap)) and [f for _, f, _ in own] == [k * cap for k in range(len(own))]
    other = packing.fill_containers(df.repartition(7), caps).collect()  # the same, however the rows came in
    assert sorted(map(tuple, other), key=str) == sorted(map(tuple, got), key=str)
    s = {r.container_id: r for r in packing.container_summary(packing.fill_containers(df, caps), caps).collect()}
    assert s[2].n_bins >= s[2].least_bins and s[2].fullest <= 64
    assert packing.fill_containers(df.limit(0), caps).count() == 0
    assert {r.bin_no for r in packing.fill_containers(df.filter("n_tokens = 0"), {1: 10}).collect()} == {0}
    with pytest.raises(ValueError):
        packing.fill_containers(df, {1: 0})


# 8 -----------------------------------------------------------------------------------------------
WORDS = "réévaluée molécules clôturée énergie numéro français Größe überlappen Molekül früher weiß posição não solução ação são Å – “so” café naïve 5 µM Δ ±".split()


def _documents():
    rnd = random.Random(9)
    sentence = lambda: " ".join(rnd.choice(WORDS + ["the", "pose", "of", "ring", "12"]) for _ in range(12))
    docs, truth = [], {}
    for i in range(600):
        text = sentence() + ". " + sentence()
        if i % 10 == 0:
            shown = rnd.choice(["cp1252", "latin-1", "cp437", "mac_roman", "cp1251", "cp1250"])
            bad = "".join(bytes([b]).decode(shown, "ignore") or chr(b) for b in text.encode())
            truth[i] = text
            docs.append((i, bad, "s1"))
        elif i % 97 == 1:
            truth[i] = None
            docs.append((i, text.encode("cp1252", "ignore").decode("utf-8", "replace"), "s2"))
        else:
            docs.append((i, text, rnd.choice(["s1", "s2", None])))
    docs += [(1000, None, "s1"), (1001, "", "s1"), (1002, "plain ascii " * 2000, None), (1003, "▒▒ draft ▒▒ ¿¡!? Χ² = 4.2 🙂", "s2"), (1004, "CHÂSSIS, TÂCHE À FAIRE, NÃO, LIGAÇÃO réévaluée", "s2")]
    return docs, truth


def test_mojibake_held_out_accuracy(spark):
    docs, truth = _documents()
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id int, text string, source string, restored string").repartition(4)
    got = {r.doc_id: r for r in mojibake.repair(df).collect()}
    assert len(got) == len(docs)
    found = {i for i, r in got.items() if r.garbled}
    assert len(found & set(truth)) >= 0.97 * len(truth) and len(found - set(truth)) <= 1
    right = sum(got[i].restored == t for i, t in truth.items() if t is not None)
    assert right >= 0.8 * sum(t is not None for t in truth.values())
    assert not any(got[i].garbled for i in (1000, 1001, 1002, 1003, 1004))


RUSSIAN = "молекула связь энергия белок остаток лиганд позиция расчёт данные кислород сильная цепь поверхность атомы объём результат".split()


def _shown(text, page):
    return "".join(c if b is None else _one(b, page) for c, b in ((c, None) if c.isascii() else ("", x) for c in text for x in ([None] if c.isascii() else c.encode())))


def _one(b, page):
    try:
        return bytes([b]).decode(page)
    except UnicodeDecodeError:
        return chr(b)


@pytest.mark.parametrize(("page", "words"), [("cp852", [w for w in WORDS if max(w) < "\u0800"]), ("cp1257", RUSSIAN)])
def test_a_page_that_is_not_listed_is_learned(spark, page, words):
    assert page not in mojibake.SHOWN
    rnd = random.Random(10)
    docs, truth = [], {}
    for i in range(700):
        text = " ".join(rnd.choice([*words, "pose", "12", "the"]) for _ in range(15))
        source = rnd.choice(["a", "b", None])
        if source == "b" and rnd.random() < 0.15:
            truth[i], text = text, _shown(text, page)
        docs.append((i, text, source))
    df = spark.createDataFrame(docs, "doc_id int, text string, source string").repartition(3)
    learned = mojibake.learn(df)
    assert [r.source for r in learned.own.filter("own like '%\"page\"%'").collect()] == ["b"]
    got = {r.doc_id: r for r in mojibake.repair(df, learned=learned).collect()}
    found = {i for i, r in got.items() if r.garbled}
    assert found <= set(truth) and len(found) >= 0.95 * len(truth)
    right = sum(x == y for i in found for x, y in zip(got[i].restored.split(), truth[i].split()) if not y.isascii())
    assert right >= 0.9 * sum(not w.isascii() for i in truth for w in truth[i].split())  # signs met too rarely stay


def test_a_long_run_counts_to_its_end():
    """The restored characters must all be known, those after the first eight, too."""
    counts = defaultdict(float)
    for w in RUSSIAN * 50:
        mojibake._count_ngrams("\n " + w + " \n", 1.0, counts)
    model = mojibake.Bigrams((np.array(list(counts)), np.array(list(counts.values()), np.float32)))
    pairs = [(0, ("cp1252", "utf_8"))]
    good, bad = "молекуласвязь", "молекуласвязьҖ"
    assert mojibake.candidates("\n ", _shown(good, "cp1252"), " \n", model, pairs) and not mojibake.candidates("\n ", _shown(bad, "cp1252"), " \n", model, pairs)


@pytest.mark.parametrize("shown", mojibake.SHOWN)
@pytest.mark.parametrize("meant", ["utf_8", "cp1252", "cp1251"])
def test_restore_is_the_inverse(shown, meant):
    if shown == meant:
        return
    for text in ("é", "Größe".strip("Gre"), "привет", "–"):
        try:
            bad = text.encode(meant).decode(shown)
        except UnicodeError:
            continue
        if len(bad) > 1 or meant != "utf_8":
            assert mojibake.restore(bad, shown, meant) == text or bad == text


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, None, None), (2, "abc", "s")], "doc_id int, text string, source string")
    assert [(r.doc_id, r.garbled) for r in mojibake.repair(df).orderBy("doc_id").collect()] == [(1, False), (2, False)]
    assert mojibake.repair(df.limit(0)).count() == 0

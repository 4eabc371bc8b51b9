"""Each operator against brute force on small and given tables, and on awkward ones."""

import collections
import hashlib
import math
import random
import re
import time
import zlib
from itertools import pairwise
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import chat_format, decontaminate, graph, lm_score, packing, quality_classifier, quality_rules, secret_scan, simhash_dedup, substring_dedup, url_filter
from quire.llm.common import is_small, table_bytes

DIR = Path("/root/testdata/sf0.001")
given_tables = pytest.mark.skipif(not DIR.is_dir(), reason="needs the test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
#: Nulls in any column, empty, blank and very long texts, ties, repeated rows.
AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"), (2, "the quick brown fox jumps over the lazy dog again and again", "en", "a"), (2, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (3, None, "en", "a"), (4, "", None, "a"), (5, " \n\t ", "en", None), (None, "no id here at all", None, None), (None, "no id here at all", None, None), (6, LONG, "en", "a"), (7, "ÀÉ É\u00a0x\u2028y one", "fr", "b"), (8, "x" * 50_000, "en", "a"), (9, "word", "en", "a"),
]
EXTRA = "1 AS fp, 2 AS component_id, 3 AS text_hash, 4 AS kept, 5 AS n_words, 6 AS rank, 7 AS spans, 8 AS row, 9 AS length, 10 AS h, 11 AS n"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string").selectExpr("*", *EXTRA.split(", "))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# 1


def slow_fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, fps):
    label = [r[0] for r in rows]
    near = [[j for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 4] for i in range(len(fps))]
    while True:
        new = [min((label[j] for j in near[i] if label[j] is not None), default=None) for i in range(len(fps))]
        if new == label:
            return label
        label = new


def check_components(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fps = [slow_fingerprint(t) for _, t in rows]
    got = sorted((repr(r.doc_id), r.fp % 2**64, repr(r.component_id)) for r in simhash_dedup.simhash_components(docs).collect())
    assert got == sorted((repr(i), f, repr(c)) for (i, _), f, c in zip(rows, fps, slow_components(rows, fps), strict=True))


@given_tables
def test_simhash_against_brute_force(spark, documents):
    check_components(spark, documents)


def test_simhash_on_awkward_rows(spark, awkward):
    check_components(spark, awkward)
    assert simhash_dedup.simhash_components(awkward.where("false")).count() == 0
    kept = [r.doc_id for r in simhash_dedup.keep_one(awkward).collect()]
    assert sorted(x for x in kept if x is not None) == [1, 3, 6, 7, 8, 9] and kept.count(None) == 2
    assert simhash_dedup.keep_one(awkward).columns == awkward.columns


def test_rows_of_one_id_with_unlike_texts_stay(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    docs = spark.createDataFrame([(1, one), (1, two), (1, two), (2, two), (3, one), (4, "c " + one[::-1]), (4, one)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in simhash_dedup.keep_one(docs).collect()) == [(1, one), (1, two), (4, "c " + one[::-1])]


def test_covering_finds_every_pair():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = [c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for c in centres for k in (1, 2, 3, 4, 5)]
    fps = np.unique(np.r_[centres, near])
    meet = collections.defaultdict(set)
    for keys, own in simhash_dedup._visits(fps):
        for k, f in zip(keys.tolist(), own.tolist(), strict=True):
            meet[k].add(f)
    together = {(a, b) for group in meet.values() if len(group) > 1 for a in group for b in group if a < b and (a ^ b).bit_count() <= 4}
    every = fps.tolist()
    assert together == {(a, b) for a in every for b in every if a < b and (a ^ b).bit_count() <= 4}


def test_dense_anchors_give_spanning_forests():
    fps = np.array([sum(1 << b for b in bits) for bits in ((), (1,), (1, 2, 3, 4, 5), (40, 41, 42, 43, 44, 45), (1, 2, 3, 4, 5, 6, 7, 8, 9))], dtype=np.uint64)
    links = simhash_dedup._dense(fps, 4)
    assert len(links) == 3 and all((a ^ b).bit_count() <= 4 for a, b in links)
    rng = np.random.default_rng(1)
    crowd = np.unique(np.array([sum(1 << int(b) for b in rng.choice(12, 3)) for _ in range(300)], dtype=np.uint64))
    assert len(simhash_dedup._dense(crowd, 4)) == len(crowd) - 1


def test_similar_texts_in_crowds_and_chains(spark):
    """Groups of edited copies of every size, and texts that are alike by less than 0.8, against the sets themselves."""
    rng = random.Random(9)
    docs, sets = [], []
    for base in range(12):
        words = [f"b{base}w{k}" for k in range(rng.randint(60, 200))]
        for copy in range((1, 2, 3, 60)[base % 4]):
            edits = rng.sample(range(len(words)), rng.choice((1, 1, 2, 12)))
            docs.append(" ".join(f"e{copy}" if k in edits else w for k, w in enumerate(words)))
    docs += ["", " ", "few words", "few words", "Few WORDS"]
    for text in docs:
        w = lower(text).split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(docs)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x == sets[j] or len(x & sets[j]) >= 0.8 * len(x | sets[j]):
                label = [label[j] if v == label[i] else v for v in label]
    least = {v: label.index(v) for v in label}
    got = {r.doc_id: r.component_id for r in simhash_dedup.similar_components(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()}
    assert got == {i: least[v] for i, v in enumerate(label)}
    kept = simhash_dedup.keep_one_similar(spark.createDataFrame([*enumerate(docs), (None, docs[0]), (3, docs[3])], "doc_id long, text string"))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*least.values(), None], key=str)


def test_recall_of_blocks():
    """Texts with a share of edited words meet at an anchor nearly always from a similarity of 0.8 on."""
    rng = random.Random(4)
    met = []
    for k in range(150):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(60, 300))]
        other = list(words)
        while True:
            tried = list(other)
            tried[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words, tried))
            if len(a & b) < 0.8 * len(a | b):
                break
            other = tried
        bits = np.stack([simhash_dedup.wide_fingerprint(" ".join(w).encode(), 5) for w in (words, other)])
        anchors = simhash_dedup.home_anchors(bits, simhash_dedup.WIDE_BLOCKS)
        met.append(bool((anchors[0] == anchors[1]).any()) and int((bits[0, :64] != bits[1, :64]).sum()) <= simhash_dedup.WIDE_DISTANCE)
    assert np.mean(met) > 0.9


def test_no_similar_pair_is_lost(spark):
    """Pairs just above a similarity of 0.8, where one in fourteen meets at no anchor, and a crowd in which only some are alike."""
    rng = random.Random(6)
    of = lambda words: {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    like = lambda a, b: len(of(a) & of(b)) / len(of(a) | of(b))
    docs = []
    for k in range(150):
        words = [f"p{k}w{i}" for i in range(rng.randint(90, 160))]
        other = list(words)
        while True:
            tried = list(other)
            tried[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            if like(words, tried) < 0.8:
                break
            other = tried
        docs += [words, other]
    base = [f"c{i}" for i in range(150)]
    docs += [[f"e{rng.randrange(10**6)}" if i in edits else w for i, w in enumerate(base)] for edits in (set(rng.sample(range(150), 5)) for _ in range(80))]
    label = list(range(len(docs)))
    sets = [of(x) for x in docs]
    for i, x in enumerate(sets):
        for j in range(i):
            if len(x & sets[j]) >= 0.8 * len(x | sets[j]):
                label = [label[j] if v == label[i] else v for v in label]
    least = {v: label.index(v) for v in label}
    got = {r.doc_id: r.component_id for r in simhash_dedup.similar_components(spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(docs)], "doc_id long, text string")).collect()}
    assert got == {i: least[v] for i, v in enumerate(label)} and len(set(label[300:])) > 1


def test_a_crowd_is_not_expanded(spark):
    """A node of a crowd is verified against two others at most, however many are close."""
    rng = np.random.default_rng(8)
    rows = [(int(a), n, int(rng.integers(0, 4))) for a in range(40) for n in rng.choice(300, 40, replace=False).tolist()]
    pairs = [tuple(r) for r in simhash_dedup.close_pairs(spark.createDataFrame(rows, "anchor long, node long, fp long")).collect()]
    assert len(pairs) == len(set(pairs)) <= 600 and all(a < b for a, b in pairs)
    assert {b for _, b in pairs} >= {n for _, n, _ in rows} - {min(n for a2, n, _ in rows if a2 == a) for a in range(40)}


def test_sketches_and_prefixes_rule_out_no_similar_sets():
    rng = np.random.default_rng(2)
    common = np.sort(rng.integers(0, 1 << 63, 50, dtype=np.uint64))
    rank = rng.permutation(50)
    seen = 0
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.unique(np.r_[rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.choice(common, 5)])
        b = np.unique(np.r_[a[rng.random(len(a)) < rng.uniform(0.8, 1)], rng.integers(0, 1 << 63, int(n * rng.uniform(0, 0.15)), dtype=np.uint64)])
        x, y = (np.frombuffer(simhash_dedup.sketch(v), dtype=np.uint8) for v in (a, b))
        width = min(len(x), len(y))
        assert np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, width)) ^ np.bitwise_xor.reduce(y.reshape(-1, width))).sum() <= len(np.setxor1d(a, b))
        if len(b) and len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)):
            seen += 1
            assert set(simhash_dedup.prefix(a, 0.8, common, rank).tolist()) & set(simhash_dedup.prefix(b, 0.8, common, rank).tolist())
            both = [np.array(v) for v in ([1, 2], [1, 2], [len(a), len(b)], [0, 0])]
            found = list(simhash_dedup._in_crowd(*both, [x.tobytes(), y.tobytes()], 0.8, False))
            assert found and {*found[0][0].tolist(), *found[0][1].tolist()} == {1, 2}
    assert seen > 100


def test_crowds_of_keys():
    """Keys of one root or of sizes too far apart go, keys of the same nodes are one; nothing may be left."""
    of = lambda rows: simhash_dedup._of_many_roots(*[np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)], 0.8)
    n = lambda size, place: size << 32 | place
    assert [len(x) for x in of([(1, 5, 5, n(10, 0)), (1, 6, 5, n(10, 0)), (2, 7, 7, n(10, 0))])] == [0, 0, 0]
    assert [len(x) for x in of([(1, 5, 5, n(10, 0)), (1, 6, 6, n(13, 0))])] == [0, 0, 0]
    crowd, nodes, _ = of([(1, 5, 5, n(10, 0)), (1, 6, 6, n(11, 0)), (2, 6, 6, n(11, 1)), (2, 5, 5, n(10, 1)), (3, 5, 5, n(10, 1)), (3, 6, 6, n(11, 1)), (3, 8, 8, n(12, 1))])
    assert len(set(crowd.tolist())) == 2 and sorted(nodes.tolist()) == [5, 5, 5, 6, 6, 6, 8]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in graph.connected_components(edges).collect()}
    assert got == dict.fromkeys(range(201), 0) | {500: 500, 501: 500}
    assert graph.connected_components(edges.where("false")).count() == 0


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(graph, "HUB", 5)
    pairs = [(1000, i) for i in range(1001, 1100)] + [(i, 50) for i in range(2000, 2040)] + [(2005, 1005), (7, 8), (8, 9)]
    got = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == dict.fromkeys([50, *range(1000, 1100), *range(2000, 2040)], 50) | {7: 7, 8: 7, 9: 7}


# 2


def check_packing(docs):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for doc_id, text in [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want.update((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())) for k, (a, b) in enumerate(pairwise(cuts)))
    rows = packing.pack(docs).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in pairwise(places)) and sum(places[-1]) <= 2048
    return len(by), -(-sum(r.length for r in rows) // 2048)


@given_tables
def test_packing_round_trip(documents):
    used, bound = check_packing(documents)
    assert used <= bound + 1


def test_packing_of_awkward_rows(spark, awkward):
    literals = spark.createDataFrame([(20, "hello <|endoftext|> world"), (21, "<|endoftext|>" * 3000), (None, "x<|endoftext|>")], "doc_id long, text string")
    check_packing(awkward.select("doc_id", "text").union(literals))
    assert packing.pack(awkward.where("false")).count() == 0


def test_packing_of_the_added_token(spark):
    """Texts with the literal of the added token, against the tokenizers file with its defaults."""
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", " <|endoftext|>", "<|endoftext| > <|ENDOFTEXT|> it's 12  ok", "no literal  here \n"]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert want[0] == [64, 220, 50256, 275, 0]
    assert {r.doc_id: list(r.ids) for r in rows} == want
    assert all(r.length == len(want[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id], dtype="<u4").tobytes()) for r in rows)


def test_instances_and_islands(spark):
    rng = np.random.default_rng(2)
    counts = collections.Counter(rng.integers(9, 45, 6000).tolist())
    ranges, slots, sequences = packing.plan(spark, dict(counts), capacity=64, instance=200)
    bound = -(-sum(s * n for s, n in counts.items()) // 64)
    assert bound <= sequences <= bound * 1.02 and len({r[3] for r in ranges}) > 1
    for s, n in counts.items():
        own = sorted(r[1:3] for r in ranges if r[0] == s)
        assert own[0][0] == 0 and own[-1][1] == n and all(a[1] == b[0] for a, b in pairwise(own))
    fill = collections.Counter()
    for k, size, _, b, _ in slots:
        fill[k, b] += size
    assert max(fill.values()) <= 64


def test_the_genetic_algorithm_beats_best_fit(spark):
    """Triplets that fill a bin exactly, and even sizes: best-fit alone needs many more bins."""
    rng = random.Random(3)
    triplets = []
    for _ in range(500):
        a = rng.randint(380, 490)
        b = rng.randint(250, (1000 - a) // 2)
        triplets += [a, b, 1000 - a - b]
    even = [rng.randint(350, 700) for _ in range(3000)]
    for sizes, capacity, at_most in ((triplets, 1000, 1.03), (even, 2048, 1.01)):
        alone, bound = len(packing.best_fit(sizes, capacity)), packing.lower_bound(sizes, capacity)
        found = packing.solve(spark, sizes, capacity)
        assert sorted(i for b in found for i in b) == list(range(len(sizes))) and max(sum(sizes[i] for i in b) for b in found) <= capacity
        assert bound <= len(found) <= bound * at_most < alone / 1.03


@pytest.mark.parametrize("seed", range(20))
def test_lower_bound(seed):
    """Never above the least number of bins, by trying every packing of few pieces."""
    rng = random.Random(seed)
    sizes = [rng.randint(1, 12) for _ in range(7)]

    def least(rest, rooms):
        if not rest:
            return len(rooms)
        size, *rest = rest
        tried = [least(rest, [*rooms[:k], r - size, *rooms[k + 1 :]]) for k, r in enumerate(rooms) if r >= size]
        return min([*tried, least(rest, [*rooms, 12 - size])])

    assert packing.lower_bound(sizes, 12) <= least(sizes, []) <= len(packing.best_fit(sizes, 12))


def test_pieces_that_fill_no_bin(spark):
    ranges, _, sequences = packing.plan(spark, {40: 5000}, capacity=64, instance=200)
    assert sequences == 5000 and max(r[2] for r in ranges) == 5000


def test_crossover_keeps_every_piece():
    sizes = [5, 4, 3, 3, 2, 2, 1]
    a, b = packing.best_fit(sizes, 6), packing.best_fit(sizes, 6, list(range(7)))
    child = packing.crossover(a, [b[-1]], sizes, 6)
    assert sorted(i for x in child for i in x) == list(range(7)) and all(sum(sizes[i] for i in x) <= 6 for x in child)
    hard = [4, 4, 4, 3, 3, 3, 3, 2, 2, 2]
    assert len(packing.evolve(hard, 10, 1, [], 5, 20)) == 3


# 3


def check_repeats(docs, window):
    rows = [(r.doc_id, WORD.findall(r.text or "")) for r in docs.select("doc_id", "text").collect()]
    seen = collections.Counter(tuple(w[i : i + window]) for _, w in rows for i in range(len(w) - window + 1))
    want = collections.Counter()
    for doc_id, w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        want[doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)] += 1
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(docs, window).collect()) == want


@given_tables
def test_repeats_against_brute_force(documents):
    check_repeats(documents, 35)


def test_repeats_in_awkward_rows(awkward, monkeypatch):
    check_repeats(awkward, 3)
    check_repeats(awkward, 35)
    assert substring_dedup.remove_repeats(awkward.where("false")).count() == 0


# 4


def test_decontamination(spark):
    item = " ".join(f"alpha{i} Beta{i}" for i in range(20))
    words = item.split()
    near = " ".join(words[:20] + ["changed"] + words[21:])
    docs = [(1, f"start here {item.upper()} and on"), (2, f"some words before {near} some after"), (3, "clean text " * 50), (4, " ".join(words[:12])), (5, " ".join(["pad"] * 70 + words)), (None, item), (6, None), (7, "tiny"), (8, LONG + " " + item)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS hs", "3 AS n")
    bench = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "tiny"), (None, item)], "item_id long, text string").selectExpr("*", "'x' AS item", "5 AS doc_id")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated_pairs(df, bench).collect()}
    exact = {(d, i) for d in (1, 5, None, 8) for i in (10, None)}
    assert {k for k, v in got.items() if v == 1.0} == exact | {(7, 13)}
    shingles = lambda t: collections.Counter(tuple(t[i : i + 5]) for i in range(len(t) - 4))
    a, b = shingles(near.lower().split()), shingles(item.lower().split())
    assert sum((a & b).values()) / sum((a | b).values()) < 0.8 and (2, 10) not in got and set(got) == exact | {(7, 13)}
    longer = " ".join(f"gamma{i}" for i in range(80))
    edited = longer.replace("gamma40", "other")
    pairs = decontaminate.contaminated_pairs(spark.createDataFrame([(1, f"x {edited} y")], "doc_id long, text string"), spark.createDataFrame([(1, longer)], "item_id long, text string")).collect()
    assert pairs[0].similarity == pytest.approx(71 / 81) and pairs[0].first_shingle == 1
    kept = decontaminate.remove_contaminated(df, bench)
    assert {r.doc_id for r in kept.collect()} == {2, 3, 4, 6} and kept.columns == df.columns
    assert decontaminate.contaminated_pairs(df.where("false"), bench).count() == 0 == decontaminate.contaminated_pairs(df, bench.where("false")).count()


def test_decontamination_judges_each_row(spark):
    item = " ".join(f"alpha{i} beta{i}" for i in range(20))
    docs = [(None, item), (None, "a clean text"), (None, None), (1, f"x {item}"), (1, "another clean text"), (2, item)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = decontaminate.remove_contaminated(df, spark.createDataFrame([(10, item)], "item_id long, text string"))
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(None, "a clean text"), (None, None), (1, "another clean text")}


def slow_windows(doc, item, width=5):
    """Best similarity and its first begin over all windows of the item's size that begin at one of its shingles or are the last."""
    made = lambda t: [tuple(t[i : i + width]) for i in range(max(1, len(t) - width + 1))] if t else []
    a, b = made(WORD.findall(lower(doc))), made(WORD.findall(lower(item)))
    want, n, last = collections.Counter(b), len(b), max(0, len(a) - len(b))
    best = (0.0, 0)
    for s in range(last + 1):
        if s == 0:
            have = collections.Counter(a[:n])
            shared = sum((have & want).values())
        else:
            gone, come = a[s - 1], a[s - 1 + n]
            shared -= have[gone] <= want[gone]
            have[gone] -= 1
            have[come] += 1
            shared += have[come] <= want[come]
        if s == last or a[s] in want:
            best = max(best, (shared / (min(n, len(a)) + n - shared), -s))
    return best[0], -best[1]


def test_decontamination_of_long_items(spark):
    """Items from one shingle to 30,000 words, with repeated words, in documents shorter and longer than they are."""
    rng = random.Random(8)
    said = lambda n, k: [f"v{rng.randrange(k)}" for _ in range(n)]
    items = [said(30_000, 9000), said(3000, 12), said(400, 300), ["same"] * 300, said(60, 40), said(5, 5), said(3, 3)]
    docs = []
    for item in items:
        edited = [w if rng.random() > 0.01 else "edit" for w in item]
        docs += [item, said(50, 99) + edited + said(2000, 99), item[: len(item) * 9 // 10], item[: len(item) // 2], said(7, 9) + item + item + said(9, 9)]
    docs = [" ".join(d) for d in docs]
    items = [" ".join(x) for x in items]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = decontaminate.contaminated_pairs(df, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    want = {(d, i): slow_windows(doc, item) for d, doc in enumerate(docs) for i, item in enumerate(items) if set(item.split()) & set(doc.split())}
    want = {k: v for k, v in want.items() if v[0] >= 0.8}
    assert len(want) > 20
    assert {(r.doc_id, r.item_id): (r.similarity, r.first_shingle) for r in found} == want


# 5


def slow_metrics(text):
    words = WORD.findall(text or "")
    tri = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    hit = {k + j for k in range(len(words) - 2) if tri[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), len(lines)


def slow_quality(docs):
    """Whether each (text, lang, source) passes the base limits and those of its group."""
    ratios = []
    for text, *group in docs:
        n, chars, symbols, again, repeat, lines = slow_metrics(text)
        own = {"symbols": symbols * 1000 // max(1, n), "repeats": repeat * 1000 // max(1, n), "lines": again * 1000 // max(1, lines), "length": chars * 100 // max(1, n)}
        ratios.append((tuple(group), own, n, n < 50 or 100 * repeat > 50 * n))
    bin_ = lambda v: v >> max(0, v.bit_length() - 7) << max(0, v.bit_length() - 7)
    limits = {}
    for group in {r[0] for r in ratios}:
        for k, floor in quality_rules.FLOORS.items():
            held = sorted(bin_(r[k]) for g, r, n, _ in ratios if g == group and n)
            if held:
                q1, q3 = (held[-(-len(held) * q // 4) - 1] for q in (1, 3))
                reach = quality_rules.SPREAD * max(q3 - q1, floor)
                limits[group, k] = (q1 - reach if k == "length" else 0, q3 + reach)
    return [not failed and all(limits[group, k][0] <= own[k] <= limits[group, k][1] for k in own) for group, own, _, failed in ratios]


def test_quality_metrics(awkward):
    for text in [r[1] for r in AWKWARD] + ["a b c a b c", "a\na\n \n \nb", "#*$%&|<> é # x"]:
        assert quality_rules.measure(text.encode() if text is not None else None) == slow_metrics(text)
    rows = quality_rules.quality_verdicts(awkward).collect()
    assert len(rows) == len(AWKWARD) and all(not r.kept for r in rows if r.base_failed) and all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert quality_rules.quality_verdicts(awkward.where("false")).count() == 0 == quality_rules.keep_good(awkward.where("false")).count()


def test_quality_limits_against_brute_force(spark):
    """Limits from bins that keep seven binary digits, texts judged by their own ratios; no ratio is clipped, words without spaces included."""
    rng = random.Random(2)
    docs = []
    for i in range(300):
        lang, long = ("zh", 60) if i % 3 == 0 else ("en", 5)
        docs.append((i, " ".join("x" * max(1, int(rng.gauss(long, long / 6))) + str(k) + ("#" if rng.random() < 0.05 else "") for k in range(60 + i % 9)), lang, None if i % 7 == 0 else "s"))
    docs += [(900, " ".join(f"{'y' * 400}{k}" for k in range(60)), "zh", "s"), (901, " ".join(f"w{k} {'#' * 30}" for k in range(60)), "en", "s"), (902, " ".join(f"w{k}" for k in range(60)), "zh", "s")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality_rules.quality_verdicts(df).collect()}
    want = dict(zip([d[0] for d in docs], slow_quality([d[1:] for d in docs]), strict=True))
    assert got == want and not got[900] and not got[901] and not got[902] and sum(got.values()) > 200


def test_quality_thresholds(spark):
    clean = [(i, " ".join(f"w{i}x{k}" for k in range(60 + i % 7)), "en", "a") for i in range(200)]
    noisy = [(1000, " ".join(f"w{k} ###" for k in range(60)), "en", "a")]
    docs = spark.createDataFrame(clean + noisy, "doc_id long, text string, lang string, source string").selectExpr("*", "'mine' AS kept")
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(200))


# 6


def test_base_patterns(spark, awkward):
    key = "AKIA" + "A1B2C3D4E5F6G7H8"
    texts = [f'é token = "{"ab12" * 5}" x', f"password:short {key} AKIASHORT", "secret=secret:abcdefghijklmnop", "deadbeefdeadbeef0 0123456789abcdef", f"API_KEY={key}", "tokentoken:=x token=abcdefabcdefabcdef,token=abcdefabcdef", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assign = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
    for r in secret_scan.secret_spans(docs).collect():
        t = texts[r.doc_id] or ""
        want = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[1]) >= 12]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        assert [tuple(x) for x in r.base] == sorted(want)
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))
    assert secret_scan.secret_spans(awkward).count() == len(AWKWARD) and secret_scan.secret_spans(awkward.where("false")).count() == 0


def test_many_matches(spark):
    texts = [" ".join(f"é {i:016x}" for i in range(n)) for n in (1, 127, 128, 129, 5000)]
    rows = secret_scan.secret_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        assert [(s.start, s.end) for s in r.base] == [m.span() for m in re.finditer("[0-9a-f]{16,}", texts[r.doc_id])]


def test_randomness_battery(spark):
    token = lambda i: hashlib.sha256(str(i).encode()).hexdigest()
    import base64

    secrets = [base64.b64encode(hashlib.sha256(str(i).encode()).digest()).decode() for i in range(30)]
    plain = ["internationalizationcommittee", "thisisaverylongwordwithoutbreaks", "abcdefghijklmnopqrstuvwxyz0123456789", "12345678901234567890123", "a" * 40, "some_snake_case_identifier_name", "----------------------------"] * 10
    docs = spark.createDataFrame(list(enumerate([f"x {t} y" for t in secrets + plain])), "doc_id long, text string")
    found = {r.doc_id for r in secret_scan.secret_spans(docs).collect() if any(s.order == 3 for s in r.spans)}
    assert found == set(range(len(secrets))) and token(1)


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é token = abcdefabcdefabcdef end", "x"), (1, "é token = abcdefabcdefabcdef end", "y"), (2, "clean", "z"), (3, None, "w")], "doc_id long, text string, spans string")
    got = secret_scan.redact(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "é [SECRET] end", "x"), (1, "é [SECRET] end", "y"), (2, "clean", "z"), (3, None, "w")], key=str)


# 7


def test_snapshots_collapse(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (2, 1, "bot", "b"), (2, 2, "user", "c"), (3, 5, "user", "a"), (3, 6, "bot", "b"), (3, 9, "user", "c"), (4, 0, "user", "a"), (4, 1, "bot", "B"), (None, 0, None, None), (5, None, "user", "z"), (6, 0, "bot", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS place", "2 AS segment", "3 AS h1")
    for segment in (512, 1, 2):
        got = chat_format.render(turns, segment)
        assert {(r.conv_id, r.n_turns, r.n_copies) for r in got.collect()} == {(2, 3, 2), (4, 2, 1), (None, 1, 1), (5, 1, 1), (6, 1, 1)}
        parts = sorted((r.segment, r.text) for r in got.where("conv_id = 2").collect())
        assert "".join(t for _, t in parts) == "<|im_start|>user\na<|im_end|>\n<|im_start|>bot\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n"
    assert chat_format.render(turns.where("false")).count() == 0


def test_conversations_of_many_segments(spark):
    """Long conversations, equal turn numbers and null turns, cut anywhere, against brute force."""
    rng = random.Random(6)
    said = [("user" if i % 2 else "bot", f"text {rng.randrange(5)}") for i in range(40)]
    rows = [(c, i, *x) for c, n in ((1, 40), (2, 40), (3, 39), (4, 17), (5, 16), (7, 1)) for i, x in enumerate(said[:n])]
    rows += [(6, 3 * i + 100, *x) for i, x in enumerate(said[:38])]  # other numbers, same places
    rows += [(8, 5, "user", f"t{i:02}") for i in range(30)] + [(9, i, "user", f"t{i:02}") for i in range(31)] + [(10, None, None, f"n{i}") for i in range(9)] + [(11, None, "user", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    low = lambda x: (x is not None, x or 0) if not isinstance(x, str) else (True, x)
    talks = collections.defaultdict(list)
    for c, *rest in sorted(rows, key=lambda r: (r[0], low(r[1]), low(r[2]), low(r[3]))):
        talks[c].append(tuple(rest[1:]))
    want = set()
    for c, x in talks.items():
        if not any(len(y) > len(x) and y[: len(x)] == x for y in talks.values()) and c == min(k for k, y in talks.items() if y == x):
            text = "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in x)
            want.add((c, len(x), sum(y == x for y in talks.values()), text))
    for segment in (1, 3, 16, 512):
        parts = collections.defaultdict(list)
        for r in chat_format.render(turns, segment).collect():
            parts[r.conv_id, r.n_turns, r.n_copies].append((r.segment, r.text))
        assert all(sorted(n for n, _ in p) == list(range(len(p))) for p in parts.values())
        assert {(*k, "".join(t for _, t in sorted(p))) for k, p in parts.items()} == want


# 8


def test_url_rules_and_links(spark):
    urls = ["http://A.com/x?y", "https://example.com/en/a", "http://sub.example.com/en/", "http://www.example.com/en/q#f", "http://example.com/de/", "http://x.net/es/", "http://x.net/en/", "http://x.org", "no scheme", None, "http://com", "HTTP://B.NET/fr/1", "x://h/a://b/c"]
    links = {5: '<a href="http://bad.org/x">', 6: "<a href='http://bad.org/y'>"}
    pages = spark.createDataFrame([(i, u, links.get(i)) for i, u in enumerate(urls)] + [(50, "http://x.net/es/2", None), (51, "http://bad.org/", '<a HREF="http://x.net/es/">'), (None, "http://good.org", "<a href=http://a.com>")], "page_id long, url string, html string").selectExpr("*", "'h' AS host", "'r' AS rule")
    got = {r.page_id: r for r in url_filter.url_verdicts(pages).collect()}
    assert [(got[i].rule, got[i].verdict) for i in (0, 1, 2, 3, 4, 5, 10)] == [("com/", "allow"), ("example.com/en/", "block"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("com/", "allow"), ("net/es/", "block"), (None, "allow")]
    assert (got[0].host, got[0].path) == ("a.com", "/x") and (got[8].host, got[8].path, got[9].host) == ("", "", "") and (got[12].host, got[12].path) == ("h", "/a://b/c")
    assert got[6].verdict == "block" and got[51].verdict == "block"  # x.net is mostly blocked; bad.org links to it
    assert got[7].verdict == "allow" and got[None].verdict == "allow"
    assert url_filter.url_verdicts(pages.where("false")).count() == 0


def test_link_ranks_against_brute_force(spark):
    """Chains, cycles, hubs and protocol-relative links; one bad link among many doesn't block."""
    rng = random.Random(12)
    hosts = ["x.net", "spam.org", "farm.org", "hub.org", "near.org", "far.org", "neutral.org", "good.com", *[f"h{i}.org" for i in range(12)]]
    links = {"spam.org": ["x.net"] * 3, "farm.org": ["spam.org", "x.net"], "near.org": ["farm.org", "spam.org"], "far.org": ["near.org"], "neutral.org": ["h0.org"] * 500 + ["x.net"], "hub.org": hosts[8:] + ["x.net", "spam.org"], "good.com": ["h1.org", "neutral.org"]}
    for h in hosts[8:]:
        links[h] = rng.choices([*hosts[8:], "hub.org", "spam.org"], k=4)
    rows = [(k, f"http://{h}/{'es/' if h == 'x.net' else ''}p", " ".join(f'<a href="{"//" if n % 2 else "https://"}{to}/q{n}">' for n, to in enumerate(links.get(h, [])))) for k, h in enumerate(hosts)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r for r in url_filter.host_verdicts(pages).collect()}
    share = {(a, b): n / sum(to != a for to in out) for a, out in links.items() for b, n in collections.Counter(out).items() if a != b}
    trust, distrust = ({h: float(h == seed) for h in hosts} for seed in ("good.com", "x.net"))
    start = dict(trust), dict(distrust)
    for _ in range(200):
        trust = {h: start[0][h] + 0.85 * sum(w * trust[a] for (a, b), w in share.items() if b == h) for h in hosts}
        distrust = {h: start[1][h] + 0.85 * sum(w * distrust[b] for (a, b), w in share.items() if a == h) for h in hosts}
    for h in hosts:
        found = (got[h].trust, got[h].distrust) if h in got else (0.0, 0.0)
        assert found == pytest.approx((trust[h], distrust[h]), abs=0.04)
    verdicts = {r.host: r.verdict for r in url_filter.url_verdicts(pages).collect()}
    assert [verdicts[h] for h in ("x.net", "spam.org", "farm.org", "near.org", "far.org")] == ["block"] * 5
    assert [verdicts[h] for h in ("neutral.org", "good.com", "hub.org")] == ["allow"] * 3


# 9


def check_scores(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    tokens = lambda t: [*WORD.findall(lower(t)), None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = collections.Counter(x for i, t in rows if not held(i) for x in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    got = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in lm_score.score_texts(docs).collect())
    want = []
    for i, t in rows:
        ts = tokens(t)
        want.append((repr(i), held(i), len(ts), sum(counts[x] > 0 for x in ts), total, round(sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in ts), 5)))
    assert [x[:5] for x in got] == [x[:5] for x in sorted(want)]
    assert [x[5] for x in got] == pytest.approx([x[5] for x in sorted(want)], rel=1e-6)


@given_tables
def test_language_model(documents, monkeypatch):
    check_scores(documents)
    monkeypatch.setattr(lm_score, "HEAD", 50)
    check_scores(documents)
    held = lm_score.score_texts(documents).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert held[0] > held[1]


@given_tables
def test_shuffled_probes_give_the_same_scores(documents, awkward, monkeypatch):
    everything = lambda docs: sorted(map(repr, lm_score.score_texts(docs).selectExpr("*", "round(base_score, 5) as b").drop("base_score").collect()))
    docs = documents.select("doc_id", "text").union(documents.select("doc_id", "text").where("doc_id < 40")).union(awkward.select("doc_id", "text"))
    want = everything(docs)
    monkeypatch.setattr(lm_score, "MOST_BROADCAST", 0)
    monkeypatch.setattr(lm_score, "CHUNK_TOKENS", 2000)
    assert everything(docs) == want
    assert lm_score.score_texts(awkward.where("false")).count() == 0


@given_tables
def test_probes_are_sent_in_rounds(documents, awkward, monkeypatch):
    """Each round sends its share of the rows, each row once, repeated and null doc_ids too."""
    docs = documents.select("doc_id", "text").union(awkward.select("doc_id", "text"))
    sent, way = [], lm_score._score_by_shuffle
    monkeypatch.setattr(lm_score, "MOST_BROADCAST", 0)
    monkeypatch.setattr(lm_score, "_score_by_shuffle", lambda source, *more: sent.append(source.count()) or way(source, *more))
    scored = lm_score.score_texts(docs)
    assert sum(sent) == docs.count() == scored.count() and len(sent) > 1 and max(sent) < 0.65 * sum(sent)


@pytest.mark.parametrize("size", [0, 1, 3_000_000])
def test_distinct_hashes(size):
    """Sorted, and not by NumPy's hash table, which took seconds for the n-grams of a chunk."""
    x = np.random.default_rng(1).integers(0, 2**62, size, dtype=np.uint64) // np.uint64(2**41)
    began = time.process_time()
    got = lm_score._distinct(x)
    assert time.process_time() - began < 1
    assert got.tolist() == sorted(set(x.tolist()))


def slow_scores(rows):
    """The model's scores with exact counts that are rounded to their levels."""
    texts = [(i, [*WORD.findall(lower(t)), None]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = collections.Counter()
    for i, ts in texts:
        if not held(i):
            padded = [0, 0, *ts]
            counts.update(tuple(padded[k - n : k + 1]) for k in range(2, len(padded)) for n in range(3))
    level = lambda c: (3 * 2 ** (c.bit_length() - 1) - 1) / 2 if c else 0
    total = sum(c for g, c in counts.items() if len(g) == 1) + sum(len(g) == 1 for g in counts) + 1
    out = []
    for i, ts in texts:
        padded, score = [0, 0, *ts], 0.0
        for k in range(2, len(padded)):
            words, pairs, triples = (level(counts[tuple(padded[k - n : k + 1])]) for n in range(3))
            one = level(counts[(padded[k - 1],)]) if padded[k - 1] != 0 else level(counts[(None,)])
            two = min(level(counts[tuple(padded[k - 2 : k])]), level(counts[(padded[k - 2],)]) if padded[k - 2] != 0 else level(counts[(None,)])) if padded[k - 1] != 0 else level(counts[(None,)])
            pairs = min(pairs, one)
            p = (pairs + lm_score.MU * (words + 1) / total) / (one + lm_score.MU)
            score += math.log10((min(triples, two) + lm_score.MU * p) / (two + lm_score.MU))
        out.append(score)
    return out


@given_tables
def test_scores_against_exact_counts(documents, awkward):
    """With a filter that hardly errs the scores are those of exact counts; with the usual one they are near."""
    docs = documents.select("doc_id", "text").union(documents.select("doc_id", "text").where("doc_id < 30")).union(awkward.select("doc_id", "text"))
    want = sorted(round(x, 4) for x in slow_scores([(r.doc_id, r.text) for r in docs.collect()]))
    sure = sorted(r.score for r in lm_score.score_texts(docs, bits_per_event=512).collect())
    assert np.mean([a == pytest.approx(b, abs=2e-4) for a, b in zip(sure, want, strict=True)]) > 0.98
    usual = sorted(r.score for r in lm_score.score_texts(docs).collect())
    assert usual == pytest.approx(want, rel=0.1, abs=2)


def test_language_model_on_awkward_rows(awkward):
    check_scores(awkward)
    assert lm_score.score_texts(awkward.where("false")).count() == 0
    scores = lm_score.score_texts(awkward).collect()
    assert all(r.score <= 0 and math.isfinite(r.score) for r in scores)


def test_filter_levels():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    grams = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    counts = rng.geometric(0.3, len(grams)) ** 2
    data = lm_score._segment(lm_score._keys(grams, 63), counts)
    held = lm_score.LogFrequencyFilter(pa.table({"segment": pa.array([0]), "data": pa.array([data], pa.binary())}), 1)
    held.shift = np.uint64(63)
    found = held.counts(grams)
    assert (found * 2 + 1 >= counts).all() and (found <= 3 * counts).mean() > 0.95
    assert (held.counts(np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))) > 0).mean() < 0.1


# 10


@given_tables
def test_classifier_on_held_out_labels(spark):
    folder = DIR.parent / "sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality_classifier.score_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.9
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_samples_are_bounded_and_take_rows_of_any_id(spark):
    rows = [(1, f"text {i}") for i in range(3000)] + [(None, f"none {i}") for i in range(3000)] + [(2, "same")] * 3000
    got = [r.text for r in quality_classifier._sample(spark.createDataFrame(rows, "doc_id long, text string"), 500).collect()]
    assert len(got) == len(set(got)) == 500 and 150 < sum(t.startswith("none") for t in got) < 350 and sum(t == "same" for t in got) <= 1
    assert quality_classifier._sample(spark.createDataFrame(rows[:3], "doc_id long, text string"), 500).count() == 3


def test_risk_gradient():
    """The steps of the fit go down the risk: loss by numbers, and positives apart from the rest."""
    rng = np.random.default_rng(1)
    d = quality_classifier.BUCKETS + quality_classifier.RATIOS
    good, bad = rng.normal(1, 1, (300, d)), rng.normal(-1, 1, (300, d))
    unlabelled = np.concatenate([rng.normal(1, 1, (200, d)), rng.normal(-1, 1, (600, d))])
    w = quality_classifier.fit(good, unlabelled, 0.25)
    score = lambda x: quality_classifier._sigmoid(quality_classifier._forward(x, w)[1])
    risk = 0.25 * (1 - score(good)).mean() + max(0.0, score(unlabelled).mean() - 0.25 * score(good).mean())
    assert risk < 0.05 and (score(good) > 0.5).mean() > 0.95 and (score(bad) < 0.5).mean() > 0.95


def test_classifier_on_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (6, 0), (9, None), (None, 1), (8, 1), (7, 1), (5, 0)], "doc_id long, quality int").selectExpr("*", "1 AS text")
    rows = quality_classifier.score_quality(awkward, labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    for none in (labels.where("false"), labels.where("quality = 0")):
        assert quality_classifier.score_quality(awkward, none).count() == len(AWKWARD)
    assert quality_classifier.score_quality(awkward.where("false"), labels).count() == 0


RESERVED = "gone_id gone_hash order_hash text_hash fp root n stays kept_hash found_id found_hash d t lang_1 least_length most_symbols measured_text n_words n_lines base_failed kept span_id span_hash found_spans own_hash spans row runs item hs windows size begin __stay __hash __root __row __found __lang __source __text __kept __of __spans __text_hash x.y a`b"


def test_extra_columns_of_any_name_and_type(spark):
    """Stages keep columns with reserved and dotted names, and maps, which have no order."""
    text = " ".join(f"word{i} ab{i * 7}" for i in range(60))
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, text + " more", "en", "a"), (3, "token = abcdefabcdefabcdef " + text[::-1], "en", "a"), (4, text[::-1] + " " + " ".join(f"item{i}" for i in range(50)), None, None), (None, text, "de", "b")]
    names = RESERVED.split()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").select("*", *[F.lit(f"v{k}").alias(c) for k, c in enumerate(names)], F.create_map(F.lit("k"), F.lit(1)).alias("a map"))
    bench = spark.createDataFrame([(1, " ".join(f"item{i}" for i in range(50)))], "item_id long, text string").select("*", *[F.lit(1).alias(c) for c in names])
    stages = {"good": quality_rules.keep_good, "one": simhash_dedup.keep_one, "clean": lambda x: decontaminate.remove_contaminated(x, bench), "redacted": secret_scan.redact}
    found = {}
    for name, stage in stages.items():
        out = stage(df)
        assert out.columns == df.columns, name
        found[name] = sorted((tuple(r) for r in out.collect()), key=repr)
        extra = {tuple(r[4:-1]) for r in found[name]}
        assert extra == {tuple(f"v{k}" for k in range(len(names)))} and all(r[-1] == {"k": 1} for r in found[name]), name
    ids = {k: [r[0] for r in v] for k, v in found.items()}
    assert sorted(ids["one"], key=str) == [1, 3, 4, None] and sorted(ids["clean"], key=str) == [1, 1, 2, 3, None]
    assert len(ids["good"]) == 6 and sum("[SECRET]" in r[1] for r in found["redacted"]) == 1
    packed = packing.pack(df)
    assert packing.pack(df, with_ids=False).count() == packed.count() == 6


def test_checked_sizes(spark):
    assert table_bytes(spark.range(10)) == 400 and table_bytes(spark.range(0)) == 0
    assert is_small(spark.range(5), 5) and not is_small(spark.range(6), 5)

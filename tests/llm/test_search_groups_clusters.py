"""Ranked search, exact dedup and centroid clustering against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from affinity.llm import clusters, exact, search, text
from llm_cases import SCHEMA, collected, frame, rows, words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ITEMS = "item_id {}, text string, doc_id int, score string, rank int"


# Ranked search


def terms(body):
    return [t.translate(FOLD) for t in re.findall(TERM, body or "")]


def rank_brute(docs, items, k):
    found = [(i, terms(body)) for i, body, *_ in docs]
    found = [(i, t) for i, t in found if t]
    n_docs, length = len(found), sum(len(t) for _, t in found)
    out = []
    asked = {}
    for item, body, *_ in sorted({r[:2] for r in items if r[0] is not None}, key=str):
        asked.setdefault(item, []).extend(terms(body))
    for item, own in asked.items():
        scores = []
        for i, t in found:
            m = 100 - 75 + (75 * len(t) * n_docs) // length
            score = 0
            for term in own:
                df, tf = sum(term in u for _, u in found), t.count(term)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, place, i, -s) for place, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def asked(key=int):
    r = random.Random(3)
    bodies = [
        None, "", "!!", "one TWO two", " ".join(words(1, 60, 500)).upper(), "é É ß a\x1cb", "nowhere at all",
        " ".join(words(11, 25) + words(12, 25)), "shared line of enough length", "x" * 5000 + " y y y",
    ]
    bodies += [" ".join(r.choice(words(1, 60, 500) + words(14, 25)) for _ in range(30)) for _ in range(4)]
    out = [(key(i), b, 1, "s", 2) for i, b in enumerate(bodies)]
    return [*out, out[3], (None, "one two", None, None, None), (key(3), "three w1", 1, None, None)]


def searched(spark, docs, items, kind="int", **options):
    return collected(search.rank(frame(spark, docs), spark.createDataFrame(items, ITEMS.format(kind)), **options))


@pytest.mark.parametrize("kind", ["int", "string"])
def test_search(spark, kind):
    items = asked(int if kind == "int" else "item {}".format)
    assert searched(spark, rows(), items, kind, k=4) == rank_brute(rows(), items, 4)


def test_search_in_small_tiles_and_rounds(spark, monkeypatch):
    """Partial sums of many tiles, and items of several rounds, add up to the same lists."""
    for name, size in (("TILE_DOCS", 3), ("TILE_TERMS", 2), ("TILE_ITEMS", 2)):
        monkeypatch.setattr(search, name, size)
    got = searched(spark, rows(), asked(), k=3, round_entries=20)
    assert got == rank_brute(rows(), asked(), 3)


def test_equal_scores_are_cut_by_id(spark):
    docs = [(i, "same words here", *[None] * 6) for i in (9, 4, 7, 1, 30, 2)] + [(3, "other", *[None] * 6)]
    got = searched(spark, docs, [(1, "words other", 0, None, 0)], k=3)
    assert [r[2] for r in got] == [3, 1, 2] and got == rank_brute(docs, [(1, "words other")], 3)


def test_empty_search(spark):
    assert searched(spark, [], asked()) == []
    assert searched(spark, rows(), []) == []
    assert searched(spark, rows(), [(1, None, 0, None, 0)]) == []
    assert searched(spark, [(1, "!", *[None] * 6)], asked()) == []


def test_long_texts_are_counted_in_parts(monkeypatch):
    body = ("Ab ab cd, " * 300 + "é" * 900 + " ab").encode()
    vocabulary = search.Vocabulary(["ab", "cd", "é" * 900, "b"])
    data, offsets = np.frombuffer(body, np.uint8), np.array([0, len(body)])
    want = [(n, t.tolist(), f.tolist()) for n, t, f in search.counts(vocabulary, data, offsets)]
    assert want[0][0] == 902 and sorted(want[0][2]) == [1, 300, 601]
    monkeypatch.setattr(text, "SLICE_BYTES", 50)
    assert [(n, t.tolist(), f.tolist()) for n, t, f in search.counts(vocabulary, data, offsets)] == want


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(text, "hashes_between", lambda chunk, begin, end, lower=False: np.zeros(len(begin), np.uint64))
    vocabulary = search.Vocabulary(["ab", "cd", "xyz"])
    data = np.frombuffer(b"cd AB xy xyz", np.uint8)
    begin, end, _ = text.word_bounds(data, np.array([0, len(data)]), search.BETWEEN)
    names = [vocabulary.terms[i] if i >= 0 else None for i in vocabulary.find(data, begin, end)]
    assert names == ["cd", "ab", None, "xyz"]


def test_no_partial_sum_reaches_the_bound():
    limit = (1 << 53) // search.MOST_IMPACT
    entries = [(0, 0, 3 * limit + 5), (0, 1, limit // 2), (1, 1, 7), (0, 2, limit // 2 + 9), (2, 3, 1)]
    (tiles,) = search.tiles_of(entries, 3, 256, 2_048)
    total = {}
    for tile in tiles:
        dense = tile.dense(3)
        assert (dense.sum(axis=1) < limit).all()
        for i, c in zip(*np.nonzero(dense), strict=True):
            key = (int(i), int(tile.terms[c]))
            total[key] = total.get(key, 0) + int(dense[i, c])
    assert sorted((i, t, q) for (i, t), q in total.items()) == sorted(entries)


def test_impacts_beyond_64_bits():
    tf, n = np.array([3, 1]), np.array([10**9, 5])
    got = search.impacts(tf, n, 10**10, 10**13)
    want = [(10**9 * t) // (1000 * t + 8 * (25 + 75 * m * 10**10 // 10**13)) for t, m in ((3, 10**9), (1, 5))]
    assert got.tolist() == want


# Exact dedup


def squeezed(body):
    return re.sub(r"[\x20\x09-\x0D]", "", body or "")


def exact_brute(data):
    groups = {}
    for i, body, *_ in data:
        groups.setdefault(squeezed(body), []).append((-len(body or ""), i is None, i or 0, i))
    out = []
    for i, body, *_ in data:
        own = groups[squeezed(body)]
        less, _, _, keeper = min(own)
        kept = i == keeper and len(body or "") == -less
        out.append((i, keeper, len(own), kept, hashlib.sha256(squeezed(body).encode()).hexdigest()))
    return sorted(out, key=str)


def copies():
    r, out = random.Random(8), []
    for i in range(300):
        body = ["hot", f"w{i % 40}", "é x", "", None][0 if i % 3 == 0 else r.randrange(5)]
        out.append((i, body and r.choice([" {}", "{} ", "{}\n\t", "{}"]).format(body), *[None] * 6))
    return [*out, out[5], out[6], (None, "hot", *[None] * 6), (None, "only null", *[None] * 6)]


@pytest.mark.parametrize("digits", [32, 2, 1])
@pytest.mark.parametrize("case", [rows, copies])
def test_exact_groups(spark, digits, case):
    """Short hashes collide; comparing bytes keeps the groups apart."""
    assert collected(exact.exact_groups(frame(spark, case()), digits)) == exact_brute(case())


@pytest.mark.parametrize("digits", [32, 1])
def test_drop_copies_keeps_rows_whole(spark, digits):
    data = [r for r in copies() if r[0] is not None][:-2]
    keepers = {r[0] for r in exact_brute(data) if r[3]}
    df = frame(spark, data)
    out = exact.drop_copies(df, digits)
    assert out.columns == df.columns
    assert collected(out) == sorted((r for r in data if r[0] in keepers), key=str)


def test_exact_groups_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(exact, "small", lambda df, rows: df)
    for digits in (32, 1):
        assert collected(exact.exact_groups(frame(spark, copies()), digits)) == exact_brute(copies())


def test_no_copies_in_an_empty_table(spark):
    assert exact.exact_groups(spark.createDataFrame([], SCHEMA)).collect() == []
    assert exact.drop_copies(spark.createDataFrame([], SCHEMA)).collect() == []


# Centroid clustering

VECTORS = "vec_id long, embedding array<double>, cluster int, distance string, c int"


def cluster_brute(data, k, rounds, width, scale, seed=2):
    own = []
    for i, x in data:
        if x is not None and len(x) == width and all(v is not None and math.isfinite(v) for v in x):
            own.append((i, tuple(math.floor(scale * v) for v in x)))
    named = [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), x) for i, x in own if i is not None]
    centroids = [x for _, x in sorted(named)[:k]]
    if not centroids:
        return []

    def assign():
        out = []
        for _, x in own:
            d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centroids]
            out.append((min(d), d.index(min(d))))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            mine = [x for (_, x), (_, b) in zip(own, found, strict=True) if b == c]
            if mine:
                centroids[c] = tuple(sum(v) // len(mine) for v in zip(*mine, strict=True))
    found = assign()
    inertia = {c: sum(d for d, b in found if b == c) for _, c in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (d, c) in zip(own, found, strict=True)), key=str
    )


def points(width, levels, n=400, seed=6):
    """Vectors around a few points, some equal, some of no use."""
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(width)] for _ in range(9)]
    out = []
    for i in range(n):
        x = [round((v + r.gauss(0, 0.3)) * levels) / levels for v in centres[i % 9]]
        out.append((i * 3, x))
    out += [(2000 + i, out[0][1]) for i in range(60)]
    bad = out[1][1]
    out += [(1, None), (2, []), (4, bad[:-1]), (5, [*bad[:-1], None]), (7, [*bad[:-1], math.nan])]
    return [*out, (8, [*bad[:-1], math.inf]), (None, bad), (None, None), out[3], (10, [0.0] * width)]


def clustered(spark, data, *args, **options):
    df = spark.createDataFrame([(i, x, 0, "d", 1) for i, x in data], VECTORS).repartition(3)
    return collected(clusters.cluster(df, *args, **options))


@pytest.mark.parametrize("levels", [1, 2, 100])
@pytest.mark.parametrize("entries", [clusters.ENTRIES, 30, 0])
def test_clusters(spark, levels, entries):
    """Blocks of several dimensions, of one, and dimensions without a dictionary agree."""
    data = points(8, levels)
    got = clustered(spark, data, 7, 4, 8, 64, entries=entries)
    assert got == cluster_brute(data, 7, 4, 8, 64)


def test_clusters_of_few_vectors(spark):
    data = [(i, [float(i % 2), 1.0]) for i in range(5)]
    assert clustered(spark, data, 40, 5, 2, 256) == cluster_brute(data, 40, 5, 2, 256)
    assert clustered(spark, [], 40, 5, 2, 256) == []
    assert clustered(spark, [(1, None), (None, [1.0, 2.0])], 40, 5, 2, 256) == []


def test_too_large_numbers_are_refused(spark):
    with pytest.raises(ValueError, match="64-bit"):
        clustered(spark, [(1, [1e300, 0.0]), (2, [0.0, 1.0])], 1, 1, 2, 256)


def test_dictionaries_lose_nothing():
    r = np.random.default_rng(4)
    x = np.stack([r.integers(-s, s, 500) for s in (1, 2, 3, 50, 1, 400)], axis=1)
    values = {d: np.unique(x[:, d]) for d in (0, 1, 2, 3, 4)}  # the last has no dictionary
    d = clusters.Dictionary(values, 6)
    assert [b - a for a, b in d.blocks] == [3, 2] and d.raw.tolist() == [5]
    for i in d.wide():
        d.entries[i] = np.unique(d.numbers(x, i))
    codes = d.encode(x)
    assert (d.decode(codes) == x).all()
    centroids = x[:9]
    best, distance = clusters.nearest(d, d.distances(centroids), centroids, codes)
    want = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (best == want.argmin(axis=1)).all() and (distance == want.min(axis=1)).all()


def test_blocks_stay_small():
    assert clusters.blocks_of([2] * 30, 4_096) == [(0, 12), (12, 24), (24, 30)]
    assert clusters.blocks_of([5_000, 3, 5_000], 4_096) == [(0, 1), (1, 2), (2, 3)]
    assert clusters.blocks_of([]) == []

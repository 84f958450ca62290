"""Jaccard join, line dedup, substring dedup and decontamination against brute force."""

import random
import re

import numpy as np
import pytest
from affinity.llm import contamination, jaccard, lines, substrings, text
from pyspark.sql import functions as F
from llm_cases import SCHEMA, collected, frame, rows, words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = r"[^\x20\x09-\x0D]+"


def doc(i, body):
    return (i, body, None, None, None, None, None, None)


def jaccard_brute(data):
    sets = {}
    for i, body, *_ in data:
        w = re.findall(BLANKS, (body or "").translate(FOLD))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if i is not None)
    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and both and 100 * both >= 80 * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return sorted(((i, len(sets[i]), None if i is None else find(i)) for i, *_ in data), key=str)


def near_copies(seed, groups, size, length=60):
    r, data = random.Random(seed), []
    for g in range(groups):
        base = words((seed, g).__hash__(), length, 4000)
        for _ in range(size):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = f"new{r.random()}"
            data.append(doc(len(data), " ".join(w)))
    return data


def sparse_nulls(data):
    """Two rows without id and different text: their sizes are matched as a multiset."""
    return sorted(data, key=str)


@pytest.mark.parametrize("case", ["awkward", "groups", "chain"])
def test_jaccard_components(spark, case):
    if case == "awkward":
        data = [r for r in rows() if r[0] is not None or r[1] is None]
    elif case == "groups":
        data = near_copies(5, 6, 7)
    else:
        base, data = words(77, 100, 5000), []
        for i in range(12):  # each links to the next only
            base = base[:]
            base[i * 8] = f"step{i}"
            data.append(doc(i * 2 + 1, " ".join(base)))
    got = collected(jaccard.jaccard_components(frame(spark, data)))
    assert got == jaccard_brute(data)


def test_jaccard_large_blocks_are_salted(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 6)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "PART_DOCS", 5)
    data = near_copies(9, 2, 25, 40)
    assert collected(jaccard.jaccard_components(frame(spark, data))) == jaccard_brute(data)


def test_search_links_all_and_only_similar_sets():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 40)).astype(np.uint64)) for _ in range(150)]
    got = jaccard.search(sets, 50)
    root = list(range(len(sets)))
    for x in range(len(sets)):
        for y in range(x):
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= 50 * (len(sets[x]) + len(sets[y]) - both):
                a, b = root[x], root[y]
                root = [a if c == b else c for c in root]
    same = lambda c: [[c[i] == c[j] for j in range(len(c))] for i in range(len(c))]
    assert same(list(got)) == same(root)


def test_lines(spark):
    data = rows()
    strip = " \t\n\x0b\x0c\r"
    holders = {}
    for i, body, *_ in data:
        for line in (body or "").split("\n"):
            k = line.strip(strip).translate(FOLD)
            if i is not None and len(k) >= 20:
                holders.setdefault(k, set()).add(i)
    want = []
    for i, body, *_ in data:
        kept = []
        for line in (body or "").split("\n"):
            h = holders.get(line.strip(strip).translate(FOLD), ())
            if i is None or len(h) < 3 or max(h) == i:
                kept.append(line)
        n = (body or "").count("\n") + 1
        want.append((i, "\n".join(kept) if body is not None else None, n, n - len(kept)))
    got = collected(lines.dedup_lines(frame(spark)))
    assert got == sorted(want, key=str)
    assert any(w[3] for w in want)
    full = lines.dedup_lines(frame(spark), max_bits=64)  # every line passes a full filter
    assert collected(full) == got


def substring_brute(data, width):
    docs = {i: re.findall(BLANKS, body or "") for i, body, *_ in data if i is not None}
    first = {}
    for i in sorted(docs):
        for k in range(len(docs[i]) - width + 1):
            first.setdefault(tuple(docs[i][k : k + width]), (i, k))
    out = []
    for i, body, *_ in data:
        w = re.findall(BLANKS, body or "")
        gone = set()
        for k in range(len(w) - width + 1) if i is not None else ():
            if first[tuple(w[k : k + width])] != (i, k):
                gone.update(range(k, k + width))
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("case", ["awkward", "passages"])
def test_substrings(spark, case):
    data = rows()
    if case == "passages":
        parts = [words(i, 25, 900) for i in range(8)]
        r = random.Random(4)
        data = [doc(i, " ".join(sum(r.choices(parts, k=3), []) + words(100 + i, 9))) for i in range(30)]
    out = substrings.dedup_substrings(frame(spark, data))
    assert collected(out.select("doc_id", "text", "n_words", "n_removed")) == substring_brute(data, 20)


def test_factors_name_an_equal_place(spark):
    parts = [words(i, 40, 900) for i in range(4)]
    data = [doc(i, " ".join(parts[i % 4] + parts[(i * 3 + 1) % 4])) for i in range(10)]
    body = {i: t.split() for i, t, *_ in data}
    for row in substrings.duplicate_spans(frame(spark, data)).collect():
        for s in row.spans:
            n = s["end"] - s["start"]
            own = body[row.doc_id][s["start"] : s["end"]]
            assert own == body[s["source_id"]][s["source_start"] : s["source_start"] + n]
            assert (s["source_id"], s["source_start"]) < (row.doc_id, s["start"])


TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def hit_brute(data, items, width=13):
    windows = {}
    for item, body, *_ in items:
        w = re.findall(TERM, (body or "").translate(FOLD))
        n = min(width, len(w))
        for k in range(len(w) - n + 1) if w and item is not None else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for i, body, *_ in data:
        w = re.findall(TERM, (body or "").translate(FOLD))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        ids = sorted(map(str, found))
        out.append((i, len(w), len(hit), len(ids), ids, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


ITEMS = [
    (1, " ".join(words(1, 60, 500)[10:40])), (10, "One, two!"), (2, "É ß"), (3, None), (4, ""),
    (None, "one"), (5, "one"), (5, "one"), (6, "y y y y y y y y y y y y y y y"),
    (7, " ".join(words(2, 4000, 3000)[1000:1013])), (8, "never met in any of them"), (5, "two other"),
]


def test_contamination(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = collected(contamination.contamination(frame(spark), items))
    assert got == hit_brute(rows(), ITEMS)
    assert any(r[5] for r in got)


@pytest.mark.parametrize("kind", ["int", "string", "decimal(5,0)"])
def test_item_ids_of_any_type(spark, kind):
    items = spark.createDataFrame([(i, b) for i, b in enumerate(["one two", " ".join(words(1, 60, 500)), "nowhere"])])
    name = F.concat(F.lit("item "), "_1") if kind == "string" else F.col("_1").cast(kind)
    items = items.select(name.alias("item_id"), F.col("_2").alias("text"))
    docs = frame(spark)
    plain = items.withColumn("item_id", F.regexp_replace("item_id", "item ", "").cast("long"))
    want = [(*r[:4], [f"item {i}" if kind == "string" else i for i in r[4]], r[5]) for r in collected(contamination.contamination(docs, plain))]
    assert collected(contamination.contamination(docs, items)) == want and any(r[4] for r in want)
    kept = contamination.decontaminate(docs, items)
    assert collected(kept) == collected(contamination.decontaminate(docs, plain))


def test_contamination_drops_rows_and_keeps_columns(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    bad = [r[5] for r in sorted(hit_brute(rows(), ITEMS), key=str)]
    out = contamination.decontaminate(frame(spark), items)
    assert out.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    assert out.count() == len(bad) - sum(bad)


def test_proximity(spark):
    near = "rare1 x x x rare2 " + " ".join(["common"] * 30)
    far = "rare1 " + " ".join(["common"] * 30) + " rare2"
    docs = frame(spark, [doc(1, near), doc(2, far), doc(3, "common")])
    items = spark.createDataFrame([(9, "rare1 common rare2")], "item_id long, text string")
    found = contamination.PhraseIndex(docs, items).proximity(8).collect()
    assert [(r.doc_id, r.item_id, r.window, r.distance) for r in found] == [(1, 9, 0, 4)]


def test_native_plan_has_no_python(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = contamination.contamination(frame(spark), items)
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("what", ["jaccard", "lines", "substrings", "contamination"])
def test_empty_tables(spark, what):
    none = frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    call = {
        "jaccard": lambda: jaccard.jaccard_components(none), "lines": lambda: lines.dedup_lines(none),
        "substrings": lambda: substrings.dedup_substrings(none),
        "contamination": lambda: contamination.contamination(none, items),
    }[what]
    assert call().collect() == []
    if what == "contamination":
        assert {r.n_hit for r in contamination.contamination(frame(spark), items).collect()} == {0}


def test_word_hashes_find_the_words():
    bodies = [t or "" for _, t, *_ in rows()]
    raw = "".join(bodies).encode()
    offsets = np.concatenate([[0], np.cumsum([len(b.encode()) for b in bodies])])
    hashes, owner = text.word_hashes(np.frombuffer(raw, np.uint8), offsets, lower=True)
    want = [(i, w) for i, b in enumerate(bodies) for w in re.findall(BLANKS, b.translate(FOLD))]
    assert owner.tolist() == [i for i, _ in want]
    by_word = {}
    for h, (_, w) in zip(hashes.tolist(), want, strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)

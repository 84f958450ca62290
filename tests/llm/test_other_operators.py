"""URL rules, token files, packing, language ID, embeddings and personal data."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from affinity.llm import embeddings, forms, langid, packing, pii, tokenfiles, tokens, urls
from affinity.llm import tagger as tagger_module
from affinity.llm.tagger import Tagger
from affinity.llm.tokens import Encoder, byte_bpe_path
from llm_cases import collected, frame, rows, texts, words
from tokenizers import Tokenizer, models, pre_tokenizers

# URLs


def url_brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [
        (len(h + p), len(h), v, h + p) for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://org/", "http://ORG/", "http://a.org", "http://a.org/x://y",
    "https://example.org/es/1", "https://m.EXAMPLE.org/en/12?x#y", "http://notexample.org/es/",
    "http://example.org?/es/", "http://example.org/es", "http://x.com/fr/é", "http://.com/de/", "a://b.com/de/x",
    "http://x.com/de/" + "p" * 5000, "http://" + "a." * 300 + "org/", "http://É.org/", "http://x.com/\n/de/",
    "http://a.b/c", "http://a.b/c/d",
]


def test_urls(spark):
    rules = urls.RULES + [("b", "/c", "block"), ("a.b", "/c", "allow"), ("b", "/c/d", "allow"), ("b", "/c/d", "block")]
    data = [(i, u, "h", "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[4], None, None, None), (3, URLS[3], None, None, None)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, host string, rule string")
    given = spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, verdict string")
    want = sorted(((i, *url_brute(u, rules)) for i, u, *_ in data), key=str)
    assert collected(urls.judge(pages, given)) == want
    assert urls.judge(pages.limit(0), given).collect() == []
    assert {r.verdict for r in urls.judge(pages, given.limit(0), "block").collect()} == {"block"}


# Token ids


def plain_ids(t):
    return Encoder.of(byte_bpe_path()).tokenizer.encode(t or "", add_special_tokens=False).ids


def test_encoder_equals_tokenizer():
    r = np.random.default_rng(1)
    pieces = [" ", "  ", "\n", "\t", "a", "word", "'s", "é", "5", ",", ".", "\xa0", "　", "\x1c", "\x85", "<|endoftext|>"]
    bodies = texts() + ["".join(r.choice(pieces, r.integers(0, 10))) for _ in range(3000)]
    encoder = Encoder(byte_bpe_path())
    for at in range(0, len(bodies), 100):
        for body, got in zip(bodies[at : at + 100], encoder.encode(bodies[at : at + 100]), strict=True):
            assert got.tolist() == plain_ids(body), body


@pytest.mark.parametrize("end_id", [0, None])
def test_token_files_round_trip(spark, tmp_path, end_id):
    folder = str(tmp_path / "files")
    manifest = tokenfiles.write_tokens(frame(spark), folder, byte_bpe_path(), end_id, parts=4)
    found = [x for p in range(len(manifest["parts"])) for x in tokenfiles.documents_of(folder, manifest, p)]
    ids = [d for d, _, _ in found]
    assert ids == sorted(ids, key=lambda d: -1 if d is None else d)
    at = 0
    for _, start, tokens in found:
        assert start == at
        at += len(tokens)
    end = [] if end_id is None else [end_id]
    want = sorted(((i, plain_ids(t) + end) for i, t, *_ in rows()), key=str)
    assert sorted(((d, t.tolist()) for d, _, t in found), key=str) == want
    digests = tokenfiles.read_digests(spark, f"file://{folder}").collect()
    assert sorted((r.n_tokens, r.ids_crc32) for r in digests) == sorted(
        (len(t), zlib.crc32(np.array(t, "<u4").tobytes())) for _, t in want
    )


def test_token_files_of_an_empty_table(spark, tmp_path):
    folder = str(tmp_path / "none")
    tokenfiles.write_tokens(frame(spark, []), folder, byte_bpe_path())
    assert tokenfiles.read_digests(spark, folder).collect() == []


# Packing


@pytest.mark.parametrize("ranges", [1, 4])
def test_packing(spark, ranges):
    data = rows() + [(1000 + i, " ".join(words(i, 1 + i * 7 % 60)), *[None] * 6) for i in range(200)]
    capacity = 64
    packed = packing.pack(frame(spark, data), byte_bpe_path(), capacity, ranges=ranges).collect()
    by_doc, by_sequence = {}, {}
    for r in packed:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    want = []
    for i, t, *_ in data:
        ids = plain_ids(t) + [0]
        for number, (start, length) in enumerate(packing.cut(len(ids), capacity)):
            crc = zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            want.append((i, number, start, length, crc))
    assert sorted((tuple(r)[:5] for r in packed), key=str) == sorted(want, key=str)
    least = -(-sum(w[3] for w in want) // capacity)
    assert len(by_sequence) <= 1.03 * least + 1
    assert packing.pack(frame(spark, []), byte_bpe_path()).collect() == []


def test_packed_sequences_hold_the_ids(spark):
    docs = frame(spark, [(i, " ".join(words(i, 20 + 9 * i)), *[None] * 6) for i in range(20)])
    packed = packing.pack(docs, byte_bpe_path(), 128).cache()
    spelled = {r.sequence_id: r.ids for r in packing.sequences(docs, packed, byte_bpe_path()).collect()}
    for r in packed.collect():
        ids = plain_ids(" ".join(words(r.doc_id, 20 + 9 * r.doc_id))) + [0]
        assert spelled[r.sequence_id][r.offset : r.offset + r.length] == ids[r.start : r.start + r.length]


def test_sweep_takes_the_smallest_gap_that_holds():
    rows_ = [("gap", 50, 0, 2, None, None), ("gap", 20, 2, 1, None, None), ("piece", 18, 0, 4, None, None)]
    out = packing.sweep(rows_, 1, 3, 100)
    placed = [(r[2], r[3], r[4], r[5]) for r in out if r[0] == "placed"]
    assert placed[0] == (0, 1, 2, 80)  # the gap of 20
    assert sum(p[1] for p in placed) == 4


# Languages

STEMS = {"en": "the of and ing tion", "fr": "le une que eux ment", "de": "der ung und lich sch"}


def speak(lang, seed, n=60):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(STEMS[lang].split(), r.integers(1, 4))) for _ in range(n))


def test_language_id(spark):
    data = [(i, speak(lang, 3 * i + k), lang, None, None, None, None, None) for i, (lang, k) in enumerate(
        (lang, k) for k in range(40) for lang in STEMS)]
    data += [(500, None, "en", *[None] * 5), (501, "12 34!", "en", *[None] * 5), (502, "", None, *[None] * 5),
             (None, speak("fr", 1), "de", *[None] * 5), (503, speak("de", 2) + " " + speak("fr", 3), None, *[None] * 5),
             (504, speak("en", 9, 30_000), None, *[None] * 5), (505, "a", None, *[None] * 5), data[0]]
    got = {r.doc_id: r for r in langid.identify(frame(spark, data)).collect()}
    assert len(got) == len(data) - 1
    right = [got[i].lang_pred == lang for i, _, lang, *_ in data[: 40 * 3] if got[i].held_out]
    assert len(right) > 10 and np.mean(right) > 0.95
    for i, r in got.items():
        assert r.held_out == (i is None or zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    assert [got[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3
    assert got[None].lang_pred == "fr" and got[504].lang_pred == "en"
    assert got[503].lang_pred in ("de", "fr") and 0.4 < got[503].score < 0.65
    assert langid.identify(frame(spark, [])).collect() == []
    kept = langid.reject(frame(spark, data))
    assert kept.columns == frame(spark, data).columns
    assert kept.filter("doc_id in (500, 501, 502)").count() == 0


def test_language_id_ignores_held_out_labels(spark):
    data = [(i, speak(lang, i), lang, *[None] * 5) for i in range(60) for lang in ["en", "fr"]]
    data = [(2 * i + (r[2] == "fr"), *r[1:]) for i, r in enumerate(data)]
    false = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, *rest) for i, t, lang, *rest in data]
    same = [sorted((r.doc_id, r.lang_pred) for r in langid.identify(frame(spark, d)).collect()) for d in (data, false)]
    assert same[0] == same[1]


def test_language_id_of_many_languages():
    """The share of the largest language does not take in those beyond the third."""
    def grams(parts):
        raw = " ".join(parts).encode()
        return langid.trigrams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))

    def words_of(lang, seed, n):
        r = np.random.default_rng([lang, seed])
        own = list("abcdefghijklmnopqrstuvwxyz"[5 * lang : 5 * lang + 5])
        return ["".join(r.choice(own, 5)) for _ in range(n)]

    counts = np.zeros((5, langid.BUCKETS), np.int64)
    for lang in range(5):
        _, bucket, count = grams(words_of(lang, 1, 3000))
        counts[lang, bucket] = count
    model = langid.Model(list("abcde"), counts)
    for shares in ([40, 20, 20, 20, 0], [36, 16, 16, 16, 16], [45, 30, 25, 0, 0]):
        ends, bucket, count = grams([w for lang, n in enumerate(shares) for w in words_of(lang, 2, 4 * n)])
        found = model.mixtures(ends, bucket, count)[0]
        assert np.abs(found - np.array(shares) / 100).max() < 0.04, found


# Embeddings


def vectors(seed=1, n=400, d=64):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, d))
    for k in range(120):
        x[k + 200] = x[k % 30] + r.standard_normal(d) * 0.35
    for k in range(60):
        x[k + 330] = x[0] * (k + 1) + r.standard_normal(d) * 0.2
    return x.astype(np.float32)


def embedding_brute(ids, x, least=0.9):
    x = x.astype(np.float64)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    links = (x @ x.T >= least) & ~np.eye(len(x), dtype=bool)
    return links


@pytest.mark.parametrize("block", [2_000, 20])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    x = vectors()
    odd = [(1000, None), (1001, []), (1002, [0.0] * 64), (1003, [float("nan")] * 64), (1004, [float("inf")] + [1.0] * 63),
           (1005, [None] + [1.0] * 63), (None, x[0].tolist()), (1006, x[0].tolist()[:63]), (0, x[0].tolist())]
    data = [(i, v.tolist()) for i, v in enumerate(x)] + odd
    df = spark.createDataFrame([(*r, "c", 1) for r in data], "vec_id long, embedding array<float>, bucket string, n int")
    got = embeddings.near_duplicates(df.repartition(4)).collect()
    assert len(got) == len(data)
    links = embedding_brute(range(len(x)), x)
    found = {r.vec_id: r for r in got}
    n = np.array([found[i].n_links for i in range(len(x))])
    assert (n <= links.sum(axis=1)).all()
    assert n.sum() >= 0.98 * links.sum() > 1000
    for i in (1000, 1001, 1002, 1003, 1004, 1005, 1006):
        assert tuple(found[i]) == (i, 0, i, True)
    assert tuple(found[None]) == (None, 0, None, True)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("bound", [20_000, 0])
def test_equal_embeddings_are_one_class(spark, monkeypatch, bound):
    """Copies count as links of each other and of all near vectors, without being compared."""
    monkeypatch.setattr(embeddings, "BROADCAST_CLASSES", bound)
    x = np.random.default_rng(3).standard_normal(64)
    near = x + np.random.default_rng(4).standard_normal(64) * 0.1
    data = [(i, x.tolist()) for i in range(10, 6_010)] + [(i, near.tolist()) for i in range(7_000, 7_100)]
    data += [(3, (-x).tolist()), (9_000, (2 * x).tolist())]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    assert len(got) == len(data) and got.pop(3) == (0, 3, True)
    assert set(got.values()) == {(6_100, 10, False), (6_100, 10, True)} and got[10][2]


def test_numbers_of_any_size(spark):
    data = [
        (1, [1e200, 1e200]), (2, [1e200, 1e200 * 1.001]), (3, [1e-200, 1e-200]), (4, [1.0, 0.1]), (5, [0.1, 1.0]),
        (6, [1e-310, 0.0]), (7, [1e308, 1e300]),
    ]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (2, 4), 5: (0, 5), 6: (2, 4), 7: (2, 4)}
    with pytest.raises(ValueError):
        embeddings.near_duplicates(df, least=1.5)


@pytest.mark.parametrize("k", [2, 3, 4])
def test_embeddings_meet_whatever_the_number_of_functions(spark, monkeypatch, k):
    """Large tables have more functions; pairs are placed at the least cosine, or little above."""
    monkeypatch.setattr(embeddings, "functions_for", lambda rows, d: k)
    x, y = embeddings.pairs_at(0.9005, 400, 64, seed=77)
    data = [(2 * i + j, v.tolist()) for i, pair in enumerate(zip(x, y)) for j, v in enumerate(pair)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embeddings.near_duplicates(df.repartition(4)).collect()}
    assert sum(r.n_links for r in got.values()) >= 0.97 * 2 * 400
    assert sum(got[2 * i].component_id == got[2 * i + 1].component_id for i in range(400)) >= 0.97 * 400


def test_embedding_tables_follow_the_functions():
    for rows, width, k in ((1_000, 64, 2), (100_000, 64, 3), (10_000_000, 64, 4), (100_000_000, 128, 4)):
        functions, tables = embeddings.layout(rows, width, 0.9, None, embeddings.PROBES)
        assert functions == k
        a, b = (
            embeddings.probe_codes(v, tables, embeddings.PROBES, functions, seed=5)
            for v in embeddings.pairs_at(0.9, 300, width, seed=6)
        )
        assert embeddings.meet(a, b).any(axis=1).mean() >= 0.97
    assert embeddings.layout(10_000_000, 64, 0.9, 7, 4) == (4, 7)


def test_hadamard_keeps_norms():
    x = np.random.default_rng(2).standard_normal((5, 32))
    y = embeddings.hadamard(x)
    assert np.allclose((x * x).sum(axis=1), (y * y).sum(axis=1))
    assert np.allclose(embeddings.hadamard(y), x)


# Personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, m):
    digits = [int(c) for c in m if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        odd = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
        return 16 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(odd)) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def test_base_spans_equal_the_plain_patterns():
    r = np.random.default_rng(5)
    pieces = ["a", "b.c", "@", "@d.e", ".", "-", " ", "1", "255", "256", "10.0.0.1", "+1", "(", ")", "4111 1111 1111 1111", "é", "_", "+49 30 1234567"]
    for _ in range(4000):
        body = "".join(r.choice(pieces, r.integers(1, 9)))
        want = [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, body) if good(k, m.group())]
        assert pii.base_spans(body)[0] == want, body


def sentences(seed, n):
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        w = words(i, 30)
        at = r.integers(0, 25)
        kind = i % 4
        w[at] = [
            f"{words(i, 1)[0]}.x{r.integers(99)}@mail{r.integers(99)}.example.com",
            ".".join(str(r.integers(1, 255)) for _ in range(4)), "4111 1111 1111 1111",
            f"+{r.integers(1, 99)} {r.integers(100, 999)} {r.integers(1000000, 9999999)}",
        ][kind]
        out.append(" ".join(w))
    return out


def labelled(bodies):
    x, y = [], []
    for b in bodies:
        starts = pii.window_starts(b, len(b))
        x.append(pii.cut(pii.codes(b), starts, pii.PAD))
        y.append(pii.cut(pii.tags_of(len(b), pii.base_spans(b)[0]), starts, 0))
    return np.concatenate(x), np.concatenate(y)


@pytest.fixture(scope="module")
def tagger():
    x, y = forms.planted(*labelled(sentences(1, 600)), pii.KINDS, 1, ord(" "), pii.codes)
    return Tagger(pii.TAGS).train(x, y, steps=220)


def test_tagger_finds_held_out_forms(tagger):
    """Forms that no base pattern knows, in sentences of another seed: precision and recall by kind."""
    x, y = forms.planted(*labelled(sentences(2, 200)), pii.KINDS, 99, ord(" "), pii.codes)
    right, found, there = Counter(), Counter(), Counter()
    for got, want in zip(tagger.decode(x), y, strict=True):
        got, want = set(pii.spans_of(got)), set(pii.spans_of(want))
        right.update(k for k, *_ in got & want)
        found.update(k for k, *_ in got)
        there.update(k for k, *_ in want)
    for kind in pii.KINDS:
        assert right[kind] / found[kind] > 0.75 and right[kind] / there[kind] > 0.7, (kind, right, found, there)


def test_the_model_adds_spans_to_the_base(tagger):
    added = 0
    for body in ("call (415) 555-0100 now", "paid by 4111.1111.1111.1111 today", "write to jane.doe @ mail.example.org soon",
                 "mail jane(at)example(dot)org today", "order 12 4111 1111 1111 1111 paid", "the host 2001:db8:0:1:2:3:4:5 is up"):
        base, every = next(pii.find([body], tagger))
        assert base == pii.base_spans(body)[0] and set(base) <= set(every)
        added += len(every) > len(base)
    assert added >= 3


def test_decoding_equals_the_enumeration_of_all_paths():
    model = Tagger(3, seed=5)
    x = np.random.default_rng(1).integers(32, 126, (20, 6)).astype(np.uint8)
    e = model._emissions(x.T)[0]
    assert np.allclose(e, model._scores(x.T), atol=1e-5)
    trans, first = model.p["trans"], model.p["first"]
    for w, got in enumerate(model.decode(x)):
        score = lambda y: first[y[0]] + sum(e[t, w, y[t]] for t in range(6)) + sum(trans[a, b] for a, b in zip(y, y[1:]))
        assert score(tuple(got)) >= max(map(score, itertools.product(range(3), repeat=6))) - 1e-5


def test_the_gradient_equals_differences():
    model = Tagger(3, seed=5)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    r = np.random.default_rng(2)
    x, y = r.integers(60, 66, (7, 4)).astype(np.uint8), r.integers(0, 3, (7, 4))
    grad = {k: np.zeros_like(v) for k, v in model.p.items()}
    model.loss(x, y, grad)
    for name, at in (("in_f", (61, 5)), ("in_b", (62, 40)), ("rec_f", (3, 20)), ("rec_b", (2, 60)), ("out", (4, 1)),
                     ("bias", (2,)), ("trans", (0, 2)), ("first", (1,))):
        sides = []
        for step in (1e-2, -2e-2):
            model.p[name][at] += step
            sides.append(model.loss(x, y))
        model.p[name][at] += 1e-2
        assert abs((sides[0] - sides[1]) / 2e-2 - grad[name][at]) < 1e-3, name


def test_windows_reconcile_to_the_tags_they_were_cut_from():
    body = " ".join(sentences(3, 20))
    tags = pii.tags_of(len(body), pii.base_spans(body)[0])
    starts = pii.window_starts(body, len(body))
    assert (pii.reconcile(len(body), starts, pii.cut(tags, starts, 0)) == tags).all()
    assert sorted(pii.spans_of(tags), key=lambda s: s[1]) == sorted(pii.base_spans(body)[0], key=lambda s: s[1])


def test_every_character_is_decoded():
    """Also where nothing is near that looks like personal data, and in texts of any length."""

    class Everything(Tagger):
        def decode(self, x):
            seen.append(int((x != pii.PAD).sum()))
            return np.full(x.shape, 8, np.int8)  # inside of a phone

    for n in (1, 95, 96, 97, 287, 288, 289, 528, 529, 5_000):
        seen, body = [], ("no sign here " * 400)[:n]
        assert next(pii.find([body], Everything(pii.TAGS))) == ([], [("phone", 0, len(body.rstrip()))])
        assert sum(seen) >= n
    assert list(pii.find([None, ""], Everything(pii.TAGS))) == [([], []), ([], [])]


def test_failed_matches_bar_no_other_span():
    """Digits of these spans are cards that failed their check."""
    for kind, body, before, after in (
        ("phone", "(415) 555-0100", "call ", " now"),
        ("card", "4111 1111 1111 1111", "order 12 ", " paid"),
        ("card", "4111.1111.1111.1111", "card ", ""),
        ("phone", "+1 415 555 0100", "", " 2024-05-01"),
        ("ip", "fe80::12ab", "at ", ""),
    ):
        whole = before + body + after
        base, failed = pii.base_spans(whole)
        added = (kind, len(before), len(before) + len(body))
        assert base == [] and failed
        assert pii.all_spans(whole, base, failed, pii.tags_of(len(whole), [added])) == [added], whole
    # The same span and kind that failed its check stays out, and so does what touches a base span.
    for body, kind in (("4111 1111 1111 1112", "card"), ("300.1.1.1", "ip"), ("+1 23", "phone"), ("a@b.example", "phone")):
        base, failed = pii.base_spans(body)
        assert pii.all_spans(body, base, failed, pii.tags_of(len(body), [(kind, 0, len(body))])) == base


def test_personal_data(spark):
    data = rows() + [(2000 + i, b, *[None] * 6) for i, b in enumerate(sentences(4, 40))]
    out = pii.personal_data(frame(spark, data), windows=200).collect()
    assert len(out) == len(data)
    want = sorted(((i, pii.base_spans(t or "")[0]) for i, t, *_ in data), key=str)
    assert sorted(((r.doc_id, [tuple(s) for s in r.base]) for r in out), key=str) == want
    for r in out:
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))
    assert pii.personal_data(frame(spark, [])).collect() == []


def test_long_documents_have_the_same_trigrams(monkeypatch):
    body = np.frombuffer((" ".join(words(8, 400)) + " É").encode(), np.uint8)
    offsets = np.array([0, len(body)])
    whole = langid.trigrams(body, offsets)
    monkeypatch.setattr(langid.text, "SLICE_BYTES", 50)
    for a, b in zip(whole, langid.trigrams(body, offsets), strict=True):
        assert a.tolist() == b.tolist()


def test_encoder_encodes_a_word_once_and_few_texts():
    """Neither line ends nor punctuation make new pieces, and new pieces share a text."""

    class Recorder:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, []

        def encode(self, text, **how):
            self.texts.append(text)
            return self.tokenizer.encode(text, **how)

        def encode_batch_fast(self, texts, **how):
            self.texts += texts
            return self.tokenizer.encode_batch_fast(texts, **how)

    own = [f"w{i}x" for i in range(400)]
    bodies = [f"{a}{end}{b} {a}" for a, b in zip(own, own[1:], strict=False) for end in (".\n", ", ", "\n\n", "; ", "! ")]
    encoder = Encoder(byte_bpe_path())
    encoder.tokenizer = Recorder(plain := encoder.tokenizer)
    got = encoder.encode(pa.array(bodies))
    assert [g.tolist() for g in got] == [plain.encode(b, add_special_tokens=False).ids for b in bodies]
    assert sum(map(len, encoder.tokenizer.texts)) < 5 * sum(map(len, own))
    assert len(encoder.tokenizer.texts) < 2 * len(own)  # first words of texts stand alone


def test_encoder_with_added_tokens_marks_and_foreign_blanks():
    bodies = [
        "a<|endoftext|> b, <|endoftext|>, c", "endoftext|> b|c", "a’ b “c” d", "x \n\ny", "x   y.z", "x　\t\ty",
        "it's 'street a'll 5's é's é,b", "a\x0bb !\x0c\x0c?", "", " ", "\n", ".", " .", "a ", "a.\n", "x\x1c  y", "x\x85  y",
    ]
    encoder = Encoder(byte_bpe_path())
    for given in ([*bodies, None], *([b] for b in bodies), pa.array(["gone", None, *bodies]).slice(1)):
        want = [plain_ids(t) for t in (given if isinstance(given, list) else given.to_pylist())]
        assert [g.tolist() for g in encoder.encode(given)] == want


def test_encoder_forgets_pieces_and_stays_right(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 50)
    monkeypatch.setattr(tokens, "LOOKED_UP", 300)
    encoder = Encoder(byte_bpe_path())
    for body, got in zip(texts(), encoder.each(texts()), strict=True):
        assert got.tolist() == plain_ids(body)
        assert len(encoder.known) <= 50 + 300 or len(body) > 300


def test_only_windows_that_may_hold_spans_are_searched(tagger):
    """All get the tags of the search."""
    searched = []

    class Counting(Tagger):
        def _search(self, e):
            searched.append(e.shape[2])
            return super()._search(e)

    model = Counting(pii.TAGS)
    model.p = tagger.p
    plain = " ".join(w for s in sentences(4, 400) for w in s.split() if w.isalpha())
    x = pii.cut(pii.codes(plain), pii.window_starts(plain, len(plain)), pii.PAD)
    x = np.concatenate([x, labelled(sentences(2, 50))[0]])
    got = model.decode(x)
    e = np.ascontiguousarray(tagger._scores(x.T).transpose(0, 2, 1))
    assert (got == Tagger._search(tagger, e)).all() and got.any()
    assert 0 < sum(searched) < len(x) * 0.7


def test_windows_are_scored_in_equal_parts_and_searched_together(tagger):
    """No part is a remainder of few windows, and those to be searched wait for those of other texts."""
    scored, searched = [], []

    class Counting(Tagger):
        def _scores(self, x):
            scored.append(x.shape[1])
            return super()._scores(x)

        def _search(self, e):
            searched.append(e.shape[2])
            return super()._search(e)

    model = Counting(pii.TAGS)
    model.p = tagger.p
    bodies = [" ".join(sentences(seed, 12)) for seed in range(200)]
    each = [next(pii.find([body], model)) for body in bodies]
    windows, found = sum(scored), sum(searched)
    scored.clear(), searched.clear()
    assert list(pii.find(bodies, model)) == each
    assert sum(scored) == windows > 600 and min(scored) > 256 and max(scored) <= 512
    assert sum(searched) == found and len(searched) <= 1 + found // 512


@pytest.mark.parametrize("fast", [True, False])
@pytest.mark.parametrize("size", [1, 5, 400])
def test_scores_are_those_of_the_training(monkeypatch, fast, size):
    """By tangents and by exponentials, also where gates are so sure that exponentials are infinite."""
    monkeypatch.setattr(tagger_module, "FAST_TANGENT", fast)
    x = labelled(sentences(2, 20))[0].T
    model = Tagger(pii.TAGS, seed=3)
    model.p = {k: v * np.float32(size if k.startswith("in") else 1) for k, v in model.p.items()}
    with np.errstate(over="ignore"):
        want = model._emissions(x)[0]
    got = model._scores(x)
    assert np.isfinite(got).all() and np.abs(got - want).max() < 1e-3


@pytest.mark.parametrize("seed", range(6))
def test_windows_said_to_be_outside_are_so(seed):
    """For models that were not trained, whose spans come and go, and scores on both sides of the bound."""
    r = np.random.default_rng(seed)
    model = Tagger(5, seed=seed)
    model.p["trans"] *= 5
    e = r.standard_normal((12, 5, 400)).astype(np.float32)
    e[:, 0] += np.linspace(0, 25, 400, dtype=np.float32)
    sure = model._surely_outside(e)
    assert 0 < sure.sum() < 400 and not model._search(e)[sure].any()


def test_encoder_of_a_vocabulary_that_lacks_bytes(tmp_path):
    """Such bytes have no ids, so the lengths of the tokens do not tell where pieces end."""
    small = Tokenizer(models.BPE(vocab={"a": 0, "b": 1, "Ġ": 2, "ab": 3}, merges=[("a", "b")]))
    small.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    small.save(path := str(tmp_path / "small.json"))
    bodies = ["ab a b", "xyz qqq ab", "ab xab, b.", "zz\nyy\nxx", ""]
    got = Encoder(path).encode(bodies)
    assert not Encoder(path).whole
    assert [g.tolist() for g in got] == [small.encode(b).ids for b in bodies]
    assert [g.tolist() for b in bodies for g in Encoder(path).encode([b])] == [small.encode(b).ids for b in bodies]

"""Ranked lexical search by dense blocked matrix products.

1. *Vocabulary*: the items' terms, compact: only terms that some item has are numbered.
2. *Count*: one pass over the texts writes, for each document, its length in terms and how often
   it has each vocabulary term. Words are found by 64-bit hash and compared byte by byte.
3. *Statistics* of all documents are summed over what was written: their number, their terms,
   and the documents that have each term.
4. *Score*: a tile of items by vocabulary (weights) is multiplied by a tile of vocabulary by
   documents (impacts), in float64. Vocabulary tiles end where an item's partial sum could reach
   2**53, so every product is exact; partial sums are added as 64-bit integers.
5. *Top*: a tile keeps all documents that score at least an item's k-th best so far, ties
   included, and cuts them by (score, doc_id). Tasks send k rows an item, which are cut in two
   levels, so that no task gets the rows of an item from all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm import buckets, text, worker
from affinity.llm.common import workspace

K = 10
# Fixed values of the contract: scale of a weight, and of an impact.
WEIGHT, IMPACT = 1_000, 1_000_000_000
# No impact is larger: tf / (1000 tf + 8 m) is below 1 / 1000.
MOST_IMPACT = 1_000_000
# Documents, terms and items of a tile.
TILE_DOCS, TILE_TERMS, TILE_ITEMS = 512, 2_048, 256
# (item, term) entries that are sent to the executors at once; more items take further rounds.
ROUND_ENTRIES = 500_000
# Everything between terms: ASCII but digits and letters.
BETWEEN = bytes(b for b in range(128) if not chr(b).isalnum())
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COUNTED = "doc_id long, n long, terms binary, tfs binary"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, n): the terms of each item and how often it has them."""
    # Upper-case letters beyond ASCII stay as they are.
    folded = F.translate("text", _UPPER, _LOWER)
    rows = items.select("item_id", "text").filter("item_id is not null and text is not null").distinct()
    terms = rows.select("item_id", F.explode(F.regexp_extract_all(folded, F.lit(_TERM), F.lit(0))).alias("term"))
    return terms.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("n"))


class Vocabulary:
    """Terms in the order of their hashes, found in texts by hash and then by their bytes."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        sizes = np.array([len(r) for r in raw], np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(raw), np.uint8)
        hashes = text.hashes_between(data, ends - sizes, ends)
        order = np.argsort(hashes, kind="stable")
        self.terms = [terms[i] for i in order.tolist()]
        self.data, self.hashes = data, hashes[order]
        self.begin, self.sizes = (ends - sizes)[order], sizes[order]
        # Terms of one hash stand side by side.
        self.most_alike = int(buckets.runs(self.hashes)[1].max(initial=0))

    def find(self, chunk: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each word of ``chunk``, or -1."""
        out = np.full(len(begin), -1, np.int64)
        if not len(begin) or not len(self.hashes):
            return out
        hashes = text.hashes_between(chunk, begin, end, lower=True)
        first = np.searchsorted(self.hashes, hashes)
        for k in range(self.most_alike):
            at = np.minimum(first + k, len(self.hashes) - 1)
            maybe = np.flatnonzero((self.hashes[at] == hashes) & (self.sizes[at] == end - begin))
            if len(maybe):
                same = self._same(chunk, begin[maybe], at[maybe])
                out[maybe[same]] = at[maybe[same]]
        return out

    def _same(self, chunk: np.ndarray, begin: np.ndarray, term: np.ndarray) -> np.ndarray:
        sizes = self.sizes[term]
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1])
        here = place + np.repeat(begin - ends + sizes, sizes)
        there = place + np.repeat(self.begin[term] - ends + sizes, sizes)
        return np.add.reduceat(_FOLD[chunk[here]] != self.data[there], ends - sizes) == 0


def _pieces(body: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts that end between terms."""
    between = np.zeros(256, bool)
    between[list(BETWEEN)] = True
    at = 0
    while at < len(body):
        to = min(at + text.SLICE_BYTES, len(body))
        while to < len(body):
            gaps = np.flatnonzero(between[body[to : to + text.SLICE_BYTES]])
            if len(gaps):
                to += int(gaps[0])
                break
            to = min(to + text.SLICE_BYTES, len(body))
        yield body[at:to]
        at = to


def _long_counts(vocabulary: Vocabulary, body: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    n, total = 0, np.zeros(len(vocabulary.terms), np.int64)
    for part in _pieces(body):
        begin, end, _ = text.word_bounds(part, np.array([0, len(part)]), BETWEEN)
        found = vocabulary.find(part, begin, end)
        total += np.bincount(found[found >= 0], minlength=len(total))
        n += len(begin)
    own = np.flatnonzero(total)
    return n, own, total[own]


def counts(vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By document: its terms in number, and the vocabulary terms with how often it has them."""
    for i, j in text.slices(offsets):
        if offsets[j] - offsets[i] > 2 * text.SLICE_BYTES:  # one long document
            yield _long_counts(vocabulary, data[offsets[i] : offsets[j]])
            continue
        begin, end, doc = text.word_bounds(data, offsets[i : j + 1], BETWEEN)
        found = vocabulary.find(data[offsets[i] : offsets[j]], begin, end)
        n = np.bincount(doc, minlength=j - i)
        width = max(len(vocabulary.terms), 1)
        keys, tf = np.unique(doc[found >= 0] * width + found[found >= 0], return_counts=True)
        limits = np.searchsorted(keys, np.arange(j - i + 1) * width)
        terms = keys % width
        for d, (a, b) in enumerate(zip(limits[:-1], limits[1:], strict=True)):
            yield int(n[d]), terms[a:b], tf[a:b]


def _count(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        for batch in batches:
            n, terms, tfs = [], [], []
            for each in counts(sent.value, *text.utf8(batch["text"])):
                n.append(each[0])
                terms.append(buckets.planes(each[1].astype(np.uint32)))
                tfs.append(buckets.planes(each[2].astype(np.uint32)))
            some = np.flatnonzero(np.array(n, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(some)), pa.array(np.array(n, np.int64)[some]),
                 pa.array([terms[i] for i in some.tolist()], pa.binary()),
                 pa.array([tfs[i] for i in some.tolist()], pa.binary())],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return run


# Rows of the statistics that belong to no term: documents, and terms in all of them.
_DOCS, _LENGTH = -1, -2


def _statistics(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, length, df = 0, 0, np.zeros(size, np.int64)
        for batch in batches:
            docs += batch.num_rows
            length += int(batch["n"].to_numpy().sum())
            for terms in batch["terms"].to_pylist():
                df[buckets.unplanes(terms, np.uint32)] += 1
        own = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(own, [_DOCS, _LENGTH]), pa.int32()), pa.array(np.append(df[own], [docs, length]), pa.int64())],
            names=["term", "n"],
        )

    return run


def weight(docs: int, df: int) -> int:
    return math.floor(WEIGHT * math.log((2 * docs + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Tile:
    """Weights of some items (rows of ``first`` on) for some terms."""

    terms: np.ndarray  # sorted
    item: np.ndarray
    column: np.ndarray
    weights: np.ndarray

    def dense(self, items: int) -> np.ndarray:
        out = np.zeros((items, len(self.terms)))
        out[self.item, self.column] = self.weights
        return out


def tiles_of(entries: list[tuple[int, int, int]], items: int, tile_items: int, tile_terms: int) -> list[list[Tile]]:
    """By tile of items, its tiles of terms, from ``entries`` (item, term, weight).

    A tile ends before an item's weights could add up to 2**53 / ``MOST_IMPACT``, and a weight
    beyond that is dealt out to several tiles.
    """
    limit = (1 << 53) // MOST_IMPACT - 1
    out = []
    for first in range(0, items, tile_items):
        by_term: dict[int, list[tuple[int, int]]] = {}
        for item, term, q in entries:
            if first <= item < first + tile_items and q:
                by_term.setdefault(term, []).append((item - first, q))
        tiles, load, current = [], {}, {}

        def close(tiles=tiles):
            nonlocal load, current
            if current:
                terms = np.array(sorted(current), np.int64)
                rows = [(i, c, q) for c, t in enumerate(terms.tolist()) for i, q in current[t]]
                item, column, q = (np.array(x, np.int64) for x in zip(*rows, strict=True))
                tiles.append(Tile(terms, item, column, q.astype(np.float64)))
            load, current = {}, {}

        for term in sorted(by_term):
            left = by_term[term]
            while left:
                part = [(i, min(q, limit)) for i, q in left]
                if len(current) >= tile_terms or any(load.get(i, 0) + q > limit for i, q in part) or term in current:
                    close()
                current[term] = part
                for i, q in part:
                    load[i] = load.get(i, 0) + q
                left = [(i, q - limit) for i, q in left if q > limit]
        close()
        out.append(tiles)
    return out


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """The impact of a term that a document of ``n`` terms has ``tf`` times."""
    if len(n) and 75 * int(n.max()) * docs >= 1 << 63:
        share = np.array([75 * int(x) * docs // length for x in n.tolist()], np.int64)
    else:
        share = (75 * n * docs) // length
    return (IMPACT * tf) // (1000 * tf + 8 * (25 + share))


class Top:
    """The k best documents of every item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.ones(items, np.int64)

    def add(self, first: int, scores: np.ndarray, docs: np.ndarray) -> None:
        """``scores`` (items from ``first`` on x documents)."""
        row, column = np.nonzero(scores >= self.least[first : first + len(scores), None])
        if not len(row):
            return
        item = np.concatenate([self.item, row + first])
        score = np.concatenate([self.score, scores[row, column]])
        doc = np.concatenate([self.doc, docs[column]])
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        _, sizes = buckets.runs(item)
        place = np.arange(len(item)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        own = place < self.k
        self.item, self.score, self.doc = item[own], score[own], doc[own]
        full = place[own] == self.k - 1
        self.least[self.item[full]] = self.score[full]


def _score(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        tiles, items, docs, length = sent.value
        top = Top(items, k)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                ids, n = part["doc_id"].to_numpy(), part["n"].to_numpy()
                terms = [buckets.unplanes(t, np.uint32) for t in part["terms"].to_pylist()]
                tf = np.concatenate([buckets.unplanes(t, np.uint32) for t in part["tfs"].to_pylist()]).astype(np.int64)
                doc = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
                term = np.concatenate(terms).astype(np.int64)
                impact = impacts(tf, n[doc], docs, length).astype(np.float64)
                for number, own in enumerate(tiles):
                    first = number * TILE_ITEMS
                    here = min(TILE_ITEMS, items - first)
                    scores = np.zeros((here, len(ids)), np.int64)
                    for tile in own:
                        column = np.minimum(np.searchsorted(tile.terms, term), len(tile.terms) - 1)
                        there = np.flatnonzero(tile.terms[column] == term)
                        if len(there):
                            matrix = np.zeros((len(tile.terms), len(ids)))
                            matrix[column[there], doc[there]] = impact[there]
                            scores += (tile.dense(here) @ matrix).astype(np.int64)
                    top.add(first, scores, ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array(top.item, pa.int32()), pa.array(top.doc, pa.int64()), pa.array(top.score, pa.int64())],
            names=["item", "doc_id", "score"],
        )

    return run


def _best(rows: DataFrame, k: int, *key: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "doc_id"))
    return rows.withColumn("rank", place).filter(F.col("rank") <= k)


def _round(work, name: str, docs: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """The result for the items of ``terms(item_id, term, n)``, which fit into memory."""
    spark = docs.sparkSession
    rows = terms.collect()
    ids = sorted({r.item_id for r in rows})
    number = {x: i for i, x in enumerate(ids)}
    vocabulary = Vocabulary(sorted({r.term for r in rows}))
    place = {t: i for i, t in enumerate(vocabulary.terms)}
    sent = spark.sparkContext.broadcast(vocabulary)
    counted = work.write(f"{name}/counted", docs.mapInArrow(_count(sent), _COUNTED))
    found = (
        counted.select("n", "terms")
        .mapInArrow(_statistics(len(place)), "term int, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .collect()  # one row per term of the vocabulary
    )
    n = {r.term: r.n for r in found}
    total, length = n.get(_DOCS, 0), n.get(_LENGTH, 0)
    entries = [
        (number[r.item_id], place[r.term], r.n * weight(total, n[place[r.term]])) for r in rows if place[r.term] in n
    ]
    tiles = tiles_of(entries, len(ids), TILE_ITEMS, TILE_TERMS)
    weights = spark.sparkContext.broadcast((tiles, len(ids), total, length))
    best = work.write(
        f"{name}/best",
        counted.filter("doc_id is not null").mapInArrow(_score(weights, k), "item int, doc_id long, score long"),
    )
    salts = max(1, math.isqrt(best.rdd.getNumPartitions()))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt")
    some = _best(best.select("*", salt), k, "item", "salt").drop("rank", "salt")
    names = spark.createDataFrame(
        list(enumerate(ids)), f"item int, item_id {terms.schema['item_id'].dataType.simpleString()}"
    )
    out = _best(some, k, "item").join(F.broadcast(names), "item")
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = K, round_entries: int = ROUND_ENTRIES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best of all ``docs(doc_id, text)`` for each item.

    Terms are runs of ASCII letters and digits and of all beyond ASCII, with A-Z lower-cased; null
    has none. The score sums, over the terms of an item with their repeats, weight times impact as
    defined by :func:`weight` and :func:`impacts`, in integers. Only scores above 0 are listed,
    and equal ones by ascending doc_id.

    ``items(item_id, text)``: rows without an id or a term have no list; equal rows count
    once, and different texts of one id are one item. Documents without a doc_id count in the
    statistics and are not listed; rows that repeat a doc_id are documents of their own and may
    be listed each. Texts are read whole, the longest in parts of 2 MB. An empty table of either kind gives an
    empty result; other columns are not read. The different terms of one item are held at once.
    """
    spark = docs.sparkSession
    work = workspace(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    terms = work.write("terms", item_terms(items))
    rounds = -(-terms.count() // round_entries)
    out = spark.createDataFrame(
        [], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
    )
    of = F.pmod(F.xxhash64("item_id"), F.lit(max(rounds, 1)))
    for i in range(rounds):
        some = terms.filter(of == i)
        if rounds == 1 or some.head(1):
            out = out.union(_round(work, f"round_{i}", docs, some, k))
    return out

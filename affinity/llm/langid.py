"""Language ID as inference of a multilingual mixture.

A language is a distribution over hashed byte trigrams of its texts, learned from labelled
documents. A document's trigrams are drawn from a mixture of languages whose proportions are
estimated by expectation-maximisation. The set of languages is chosen by penalised
likelihood: of the sets of the k most probable languages, k = 1, 2, ... to all, the one with the
largest log-likelihood less a price for each further language. The predicted language has the
largest proportion, which is the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from affinity.llm import text, worker
from affinity.llm.common import fresh

UNKNOWN = "und"
# Labelled documents of a language that are learned from, about: a bounded sample by a hash
# of the id. More change the trigram distributions little.
DOCS_PER_LANGUAGE = 3_000
BUCKETS = 1 << 14
# Documents whose texts are held as Python strings at once.
BLOCK = 1_000
# Rounds of EM for each set of languages that is tried for a document.
ROUNDS = 8
# Price of a further language, times log(1 + trigrams): trigrams overlap, so three of them
# count as one observation of a BIC of one half.
PRICE = 1.5
_LETTER = re.compile(r"[^\W\d_]")


def _folded() -> np.ndarray:
    """Bytes as letters of one case, with blanks for all ASCII that is no letter."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[:65] = out[91:97] = out[123:128] = 32
    return out


_FOLDED = _folded()


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n + 1 limits, bucket, count): the different trigrams of documents, blanks around each."""
    sizes = np.diff(offsets)
    if len(sizes) == 1 and sizes[0] > 2 * text.SLICE_BYTES:
        return _long_trigrams(data[offsets[0] : offsets[1]])
    limits = np.concatenate([[0], np.cumsum(sizes + 2)])
    body = np.full(limits[-1] + 2, 32, np.uint8)
    at = np.arange(offsets[-1] - offsets[0]) + np.repeat(1 + 2 * np.arange(len(sizes)), sizes)
    body[at] = _FOLDED[data[offsets[0] : offsets[-1]]]
    wide = body.astype(np.uint32)
    code = wide[:-2] | (wide[1:-1] << np.uint32(8)) | (wide[2:] << np.uint32(16))
    code = ((code * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int64)  # 14 bits
    bucket, count, ends = [], [], [0]
    for a, b in zip(limits[:-1], limits[1:] - 2, strict=True):
        n = np.bincount(code[a:b], minlength=0) if b > a else np.zeros(0, np.int64)
        own = np.flatnonzero(n)
        bucket.append(own)
        count.append(n[own])
        ends.append(ends[-1] + len(own))
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return np.array(ends), join(bucket), join(count)


def _long_trigrams(body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for one long document, in parts that overlap by two bytes."""
    total = np.zeros(BUCKETS, np.int64)
    whole = np.concatenate([[32], body, [32]]).astype(np.uint8)
    for at in range(0, len(whole) - 2, text.SLICE_BYTES):
        # Blanks around the part make a trigram more at either end.
        part = whole[at : at + text.SLICE_BYTES + 2]
        _, bucket, count = trigrams(part, np.array([0, len(part)]))
        total[bucket] += count
        for a, b, c in ((32, part[0], part[1]), (part[-2], part[-1], 32)):
            code = int(_FOLDED[a]) | int(_FOLDED[b]) << 8 | int(_FOLDED[c]) << 16
            total[(code * 0x9E3779B1 & 0xFFFFFFFF) >> 18] -= 1
    own = np.flatnonzero(total)
    return np.array([0, len(own)]), own, total[own]


@worker.lean
def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = text.utf8(batch["text"])
        langs = batch["lang"].to_pylist()
        for i, j in text.slices(offsets):
            ends, bucket, count = trigrams(data, offsets[i : j + 1])
            for k in range(j - i):
                own = totals.setdefault(langs[i + k], np.zeros(BUCKETS, np.int64))
                own[bucket[ends[k] : ends[k + 1]]] += count[ends[k] : ends[k + 1]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(totals), pa.string()), pa.array([x.tobytes() for x in totals.values()], pa.binary())],
        names=["lang", "counts"],
    )


def _add(key: tuple[Any, ...], frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(BUCKETS, np.int64)
    for frame in frames:
        for counts in frame["counts"]:
            total += np.frombuffer(counts, np.int64)
    yield pd.DataFrame({"lang": [key[0]], "counts": [total.tobytes()]})


class Model:
    """Languages in their order and the probability of each bucket in each of them."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts.astype(np.float64) + 0.5
        self.p = (smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)

    def mixtures(self, ends: np.ndarray, bucket: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Proportions (documents x languages) under the chosen set of each document.

        Every document has a trigram at least.
        """
        n_docs, n_langs = len(ends) - 1, len(self.languages)
        at, p = ends[:-1], self.p[:, bucket]
        doc = np.repeat(np.arange(n_docs), np.diff(ends))
        count = count.astype(np.float32)
        total = np.add.reduceat(count, at)
        alone = np.add.reduceat(np.log(p) * count, at, axis=1)  # languages x documents
        order = np.argsort(-alone, axis=0, kind="stable")
        best = np.zeros((n_langs, n_docs), np.float32)
        best[order[0], np.arange(n_docs)] = 1
        value = alone[order[0], np.arange(n_docs)].astype(np.float64)
        if n_langs == 1:
            return best.T
        weights = self._em(p, doc, at, count, total, np.full((n_langs, n_docs), 1 / n_langs, np.float32))[0]
        rank = np.argsort(np.argsort(-weights, axis=0, kind="stable"), axis=0)
        for k in range(2, n_langs + 1):
            chosen, likelihood = self._em(p, doc, at, count, total, np.where(rank < k, 1 / k, 0).astype(np.float32))
            likelihood = likelihood - (k - 1) * PRICE * np.log1p(total)
            better = likelihood > value
            best[:, better], value[better] = chosen[:, better], likelihood[better]
        return best.T

    @staticmethod
    def _em(p, doc, at, count, total, weights):
        for _ in range(ROUNDS):
            share = weights[:, doc] * p
            share *= count / np.maximum(share.sum(axis=0), 1e-30)
            weights = np.add.reduceat(share, at, axis=1) / total
        likelihood = np.add.reduceat(np.log(np.maximum((weights[:, doc] * p).sum(axis=0), 1e-30)) * count, at)
        return weights, likelihood.astype(np.float64)

    def predict(self, texts: list[str | None], data: np.ndarray, offsets: np.ndarray) -> tuple[list, list]:
        known = np.array([bool(t) and bool(_LETTER.search(t)) for t in texts], bool)
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return langs, scores
        for i, j in text.slices(offsets):
            ends, bucket, count = trigrams(data, offsets[i : j + 1])
            own = np.flatnonzero((np.diff(ends) > 0) & known[i:j])
            if not len(own):
                continue
            if len(own) < j - i:
                kept = np.repeat(np.isin(np.arange(j - i), own), np.diff(ends))
                bucket, count = bucket[kept], count[kept]
                ends = np.concatenate([[0], np.cumsum(np.diff(ends)[own])])
            shares = self.mixtures(ends, bucket, count)
            for k, lang, score in zip(own.tolist(), shares.argmax(axis=1).tolist(), shares.max(axis=1).tolist(), strict=True):
                langs[i + k], scores[i + k] = self.languages[lang], min(max(score, 0.0), 1.0)
        return langs, scores


def held_out(doc_id: str = "doc_id", folds: int = 5) -> F.Column:
    """Documents that nothing is learned from: crc32 of the id as text, and those without id."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % folds == 0, F.lit(True))


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Learn from ``docs(doc_id, text, lang)`` that are not held out.

    Labels must be a set that fits into memory 16,384 times over; each language is learned
    from about ``docs_per_language`` documents, drawn by a hash of the id.
    """
    usable = docs.select("doc_id", "text", "lang").filter(
        ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.join(F.broadcast(sizes), "lang").filter(draw * F.col("n") < docs_per_language)
    found = (
        sample.select("text", "lang")
        .mapInArrow(_counts, "lang string, counts binary")
        .groupBy("lang")
        .applyInPandas(_add, "lang string, counts binary")
        .collect()  # one row per language
    )
    found = sorted((r.lang, np.frombuffer(r.counts, np.int64)) for r in found) if found else []
    counts = np.stack([c for _, c in found]) if found else np.zeros((0, BUCKETS), np.int64)
    return Model([lang for lang, _ in found], counts)


def predicted(docs: DataFrame, model: Model, lang: str, score: str) -> DataFrame:
    """All columns of ``docs``, and the prediction from ``text`` in two new ones."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    if lang in docs.columns or score in docs.columns:
        raise ValueError("the new columns must have new names")

    @worker.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                texts = batch["text"].to_pylist()
                langs, scores = sent.value.predict(texts, *text.utf8(batch["text"]))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=[*batch.schema.names, lang, score],
                )

    schema = StructType([*docs.schema.fields, StructField(lang, StringType()), StructField(score, DoubleType())])
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs(doc_id, text, lang)``.

    Learns from the labelled rows that are not held out, and predicts every text from the
    text alone. ``und`` with score 0: null text, text without a letter, or nothing learned.
    Equal likelihoods go to the first language in their order. Rows with a null or repeated
    doc_id are predicted like others; nothing is learned from null ids. An empty table gives
    an empty result. Other columns are not read.
    """
    model = fit(docs, docs_per_language)
    out = predicted(docs.select("doc_id", "text"), model, "lang_pred", "score")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def reject(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose language is unknown or has less than ``least_score``."""
    lang, score = fresh("lang"), fresh("score")
    out = predicted(docs, fit(docs), lang, score)
    return out.filter((F.col(lang) != UNKNOWN) & (F.col(score) >= least_score)).drop(lang, score)

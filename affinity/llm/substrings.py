"""Substring dedup by an exact look-up of every window of words, in place of a Lempel-Ziv parse.

Every window of ``width`` words is sent to a hash range with its place. There the windows that
occur earlier get the place of their first occurrence, and that alone decides which words go.
Neighbouring windows whose sources are neighbours too are then joined into spans for the report.
Spans have ``width`` words at least, and they cover exactly the words of all windows that occur
earlier.

Windows are identified by 64 bits and their bucket's share of another, independent hash; the words
themselves are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm import buckets, text, worker
from affinity.llm.common import partitions, workspace

WIDTH = 20
_SENT = "batch long, bucket int, docs binary, counts binary, places binary, keys binary"
_FOUND = "batch long, docs binary, places binary, sources binary, shifts binary"
SPANS = "array<struct<start:int,end:int,source_id:long,source_start:int>>"
_SEED = 0x5851F42D4C957F2D


def _arrow(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, (_, kind) in zip(columns, schema, strict=True)],
        names=[name for name, _ in schema],
    )


def _windows(width: int, n_buckets: int):
    schema = [("batch", pa.int64()), ("bucket", pa.int32())] + [
        (name, pa.binary()) for name in ("docs", "counts", "places", "keys")
    ]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        numbers = buckets.Batches()
        for batch in batches:
            data, offsets = text.utf8(batch["text"])
            doc_ids = batch["doc_id"].to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in text.slices(offsets):
                words, doc = text.word_hashes(data, offsets[i : j + 1])
                keys, first = text.window_hashes(words, doc, width)
                if not len(keys):
                    continue
                other, _ = text.window_hashes(words, doc, width, _SEED)
                owner = doc[first]
                begin = np.searchsorted(doc, np.arange(j - i))
                place = (first - begin[owner]).astype(np.uint32)
                number, rows = numbers.next(), []
                order, limits = buckets.by_bucket(buckets.bucket_of(other, n_buckets), n_buckets)
                for b in np.flatnonzero(np.diff(limits)):
                    own = order[limits[b] : limits[b + 1]]
                    docs, counts = buckets.runs(owner[own])
                    at = place[own]
                    at[1:] -= place[own[:-1]]  # wraps at a new document, and back when summed
                    rows.append(
                        (number, int(b), doc_ids[i + docs].tobytes(), buckets.planes(counts),
                         buckets.planes(at), keys[own].tobytes())
                    )
                yield _arrow(schema, rows)

    return send


def _first_places(table: pa.Table) -> pa.Table:
    """Of the windows of one bucket, those that occur earlier as well, with the first place."""
    schema = [("batch", pa.int64())] + [
        (name, pa.binary()) for name in ("docs", "places", "sources", "shifts")
    ]
    doc, place, key, batch = [], [], [], []
    for number, docs, counts, places, keys in zip(
        *(table[c].to_pylist() for c in ("batch", "docs", "counts", "places", "keys")), strict=True
    ):
        at = np.cumsum(buckets.unplanes(places, np.uint32), dtype=np.uint32)
        doc.append(np.repeat(np.frombuffer(docs, np.int64), buckets.unplanes(counts, np.uint32)))
        place.append(at)
        key.append(np.frombuffer(keys, np.uint64))
        batch.append(np.full(len(at), number))
    key = np.concatenate(key)
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = order[np.append(same, False) | np.insert(same, 0, False)]
    key = key[again]
    doc, place, batch = (np.concatenate(x)[again] for x in (doc, place, batch))
    order = np.lexsort((place, doc, key))
    key, doc, place, batch = key[order], doc[order], place[order].astype(np.int64), batch[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    source = np.flatnonzero(new)[np.cumsum(new) - 1]
    source_doc, source_place = doc[source], place[source]
    later = np.flatnonzero((doc != source_doc) | (place != source_place))
    later = later[np.lexsort((place[later], doc[later], batch[later]))]
    doc, place, batch = doc[later], place[later], batch[later]
    source_doc, shift = source_doc[later], (source_place[later] - place).astype(np.int32)
    numbers, sizes = buckets.runs(batch)
    ends = np.cumsum(sizes, dtype=np.int64)
    rows = [
        (int(number), doc[a:b].tobytes(), buckets.planes(place[a:b].astype(np.uint32)),
         source_doc[a:b].tobytes(), shift[a:b].tobytes())
        for number, a, b in zip(numbers, ends - sizes, ends, strict=True)
    ]
    return pa.Table.from_batches([_arrow(schema, rows)])


def parse(
    doc: np.ndarray, place: np.ndarray, source: np.ndarray, shift: np.ndarray, width: int
) -> dict[int, list[dict]]:
    """Factors by document, from windows with a first place elsewhere, sorted by place.

    A factor goes on while places follow one another and have one source and shift.
    """
    if not len(doc):
        return {}
    new = np.ones(len(doc), bool)
    new[1:] = (
        (doc[1:] != doc[:-1])
        | (place[1:] != place[:-1] + 1)
        | (source[1:] != source[:-1])
        | (shift[1:] != shift[:-1])
    )
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    out: dict[int, list[dict]] = {}
    for d, a, b, s, t in zip(
        doc[first].tolist(), place[first].tolist(), (place[last] + width).tolist(),
        source[first].tolist(), (place[first] + shift[first]).tolist(), strict=True,
    ):
        out.setdefault(d, []).append({"start": a, "end": b, "source_id": s, "source_start": t})
    return out


def _factors(width: int):
    kind = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("source_id", pa.int64()),
                   ("source_start", pa.int32())])
    )

    def parse_batch(table: pa.Table) -> pa.Table:
        doc, place, source, shift = (
            np.concatenate([read(x) for x in table[c].to_pylist()])
            for c, read in (
                ("docs", lambda x: np.frombuffer(x, np.int64)),
                ("places", lambda x: buckets.unplanes(x, np.uint32)),
                ("sources", lambda x: np.frombuffer(x, np.int64)),
                ("shifts", lambda x: np.frombuffer(x, np.int32)),
            )
        )
        place, shift = place.astype(np.int64), shift.astype(np.int64)
        order = np.lexsort((place, doc))
        # Rows that repeat a doc_id bring their windows twice.
        kept = np.ones(len(order), bool)
        kept[1:] = (np.diff(doc[order]) != 0) | (np.diff(place[order]) != 0)
        order = order[kept]
        found = parse(doc[order], place[order], source[order], shift[order], width)
        return pa.table(
            {"doc_id": pa.array(list(found), pa.int64()), "spans": pa.array(list(found.values()), kind)}
        )

    return parse_batch


def duplicate_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, spans) for the documents of ``docs(doc_id, text)`` that repeat earlier words.

    Spans are factors in words, end exclusive, with the place of their first occurrence.
    """
    n = min(partitions(docs.sparkSession), 1 << 16)
    found = (
        docs.select("doc_id", "text")
        .filter("doc_id is not null and text is not null")
        .mapInArrow(_windows(width, n), _SENT)
        .repartition(n, "bucket")
        .groupBy("bucket")
        .applyInArrow(_first_places, _FOUND)
    )
    parsed = found.groupBy("batch").applyInArrow(_factors(width), f"doc_id long, spans {SPANS}")
    return workspace(docs.sparkSession).write("spans", parsed).dropDuplicates(["doc_id"])


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, n_words, n_removed = [], [], []
        for body, spans in zip(
            batch["text"].to_pylist(), batch["spans"].to_pylist(), strict=True
        ):
            # split() without an argument cuts bytes at the six ASCII blanks, and only there.
            words = (body or "").encode("utf-8", "surrogatepass").split()
            n_words.append(len(words))
            if spans:
                at, rest = 0, []
                for span in spans:
                    rest += words[at : max(at, span["start"])]
                    at = max(at, span["end"])
                words = rest + words[at:]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(kept, pa.binary()).cast(pa.string()),
             pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), batch["spans"]],
            names=["doc_id", "text", "n_words", "n_removed", "spans"],
        )


def dedup_substrings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text, n_words, n_removed, spans): all rows of ``docs(doc_id, text)``.

    Words are runs of anything but the six ASCII blanks. A word goes if some window of
    ``width`` words over it also starts earlier: in a smaller doc_id, or earlier in the same
    document. Windows are judged on the input. ``text`` is what is left, joined by one blank.

    Null text has no words and becomes empty. Rows without a doc_id lose nothing and are no
    source. Rows that repeat a doc_id are taken to repeat its text: they are one document
    and lose the same words. Other columns are not read.
    """
    spans = duplicate_spans(docs, width)
    return (
        docs.select("doc_id", "text")
        .join(spans, "doc_id", "left")
        .mapInArrow(
            _keep, f"doc_id long, text string, n_words long, n_removed long, spans {SPANS}"
        )
    )

"""Personal data: base patterns, and a character BiLSTM-CRF that adds to them.

The model learns from windows of text labelled with the base spans. Into most of them a form is
planted that the patterns do not know (other separators, no ``+``, ``at`` for ``@``, IPv6), with the
label of its kind, or a number that is no personal data (``forms``). Documents are decoded whole,
in overlapping windows that are longer than those of the training, so that fewer characters are
decoded twice; each character takes its tag from the window in which it is farthest from an edge, and
spans are read off the tags of the whole document. Only the training sample prefers windows with a sign
of personal data (a digit, an ``@``, a bracketed ``at`` or ``dot``, or the word ``dot``).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.forms import planted
from affinity.llm.tagger import PAD, Tagger, codes

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
WIDTH, STRIDE = 96, 48
# Windows in which documents are decoded.
DECODED_WIDTH, DECODED_STRIDE = 288, 240
# Bounded sample that the model learns from, and steps of training.
TRAINING_WINDOWS, STEPS = 3_000, 220
# Windows of a document in the sample, drawn from all of it, beside those with a sign.
ANY_WINDOWS = 8
# Windows of texts that are decoded together.
DECODED = 4_096

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is tried from its start only, and given back nothing: the matches are those
# of the plain pattern, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SIGN = re.compile(r"[0-9@]|[(\[](?:at|dot)[)\]]|\x20dot\x20")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the base patterns by kind and start, and matches that failed their check."""
    found: list[Span] = [("email", a, b) for a, b in _emails(text)]
    failed: list[Span] = []
    if not _DIGIT.search(text):
        return found, failed

    def take(kind: str, match: re.Match, good: bool) -> None:
        (found if good else failed).append((kind, *match.span()))

    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        take("ip", m, all(len(p) <= 3 and int(p or "0") <= 255 for p in parts))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        take("card", m, 16 <= len(digits) <= 19 and _luhn(digits))
    for m in _PHONE.finditer(text):
        take("phone", m, 8 <= sum(c in "0123456789" for c in m.group()) <= 15)
    return found, failed


def tags_of(length: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(length, np.int8)
    for kind, a, b in spans:
        tag = 1 + 2 * KINDS.index(kind)
        tags[a:b] = tag + 1
        tags[a] = tag
    return tags


def window_starts(text: str, length: int, width: int = WIDTH, stride: int = STRIDE) -> list[int]:
    """Starts of windows that hold every character; none for an empty text."""
    n = max(1, -(-(length - width) // stride) + 1)
    return [k * stride for k in range(n)] if length else []


def sample_starts(text: str) -> list[int]:
    """Starts of the windows to learn from: those with a sign, those beside them, and some drawn from all."""
    n = len(window_starts(text, len(text)))
    draw = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    near = {(draw + i * n // ANY_WINDOWS) % n for i in range(ANY_WINDOWS)}
    for m in _SIGN.finditer(text):
        last = min(m.start() // STRIDE, n - 1)
        near.update(range(max(last - 2, 0), min(last + 2, n)))
    return [k * STRIDE for k in sorted(near)]


def cut(values: np.ndarray, starts: list[int], fill: int, width: int = WIDTH) -> np.ndarray:
    padded = np.concatenate([values.astype(np.uint8), np.full(width, fill, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, width)[np.asarray(starts, np.intp)]


def reconcile(length: int, starts: list[int], tags: np.ndarray, stride: int = STRIDE) -> np.ndarray:
    """One tag for every character, each from the window it is most central in."""
    out, width = np.zeros(length, np.int8), tags.shape[1]
    margin = (width - stride) // 2
    for s, row in zip(starts, tags, strict=True):
        low = 0 if s == 0 else margin
        high = width if s + width >= length else width - margin
        high = min(high, length - s)
        out[s + low : s + high] = row[low:high]
    return out


def spans_of(tags: np.ndarray) -> list[Span]:
    """Runs of one kind; a begin tag starts a new one."""
    inside = np.flatnonzero(tags)
    if not len(inside):
        return []
    kind = (tags[inside] - 1) // 2
    new = np.ones(len(inside), bool)
    new[1:] = (np.diff(inside) > 1) | (np.diff(kind) != 0) | (tags[inside[1:]] % 2 == 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(inside)) - 1
    return [(KINDS[kind[a]], int(inside[a]), int(inside[b]) + 1) for a, b in zip(first, last, strict=True)]


def all_spans(text: str, base: list[Span], failed: list[Span], tags: np.ndarray) -> list[Span]:
    """Base spans, and those of the model that touch none of them and cut no word or number in two.

    A match that failed its check is not added as the same span of the same kind. It bars nothing
    else: the card pattern takes any run of digits, so parts of phones and dates are such matches.
    """
    taken, refused = np.zeros(len(text), bool), set(failed)
    for _, a, b in base:
        taken[a:b] = True
    added = []
    for kind, a, b in spans_of(tags):
        body = text[a:b]
        a, b = a + len(body) - len(body.lstrip()), b - len(body) + len(body.rstrip())
        starts_inside = a > 0 and text[a - 1 : a + 1].isalnum()
        ends_inside = b < len(text) and text[b - 1 : b + 1].isalnum()
        barred = starts_inside or ends_inside or taken[a:b].any() or (kind, a, b) in refused
        if a < b and not barred:
            added.append((kind, a, b))
    return sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch["text"].to_pylist():
            if text and _SIGN.search(text):
                x, y = codes(text), tags_of(len(text), base_spans(text)[0])
                starts = sample_starts(text)
                for a, b in zip(cut(x, starts, PAD), cut(y, starts, 0), strict=True):
                    packed = a.tobytes()
                    rows.append((zlib.crc32(packed), packed, b.tobytes()))
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)],
            names=["draw", "x", "y"],
        )


def fit(docs: DataFrame, windows: int = TRAINING_WINDOWS, steps: int = STEPS) -> Tagger | None:
    """Learn from ``windows`` windows of ``docs(doc_id, text)``, drawn by a hash; None without any.

    Documents with a digit or ``@`` are counted, and about twice as many as windows are wanted
    are drawn; each has a window at least. Equal windows count once. Each has its own planted form.
    """
    docs, rich = docs.select("doc_id", "text"), F.col("text").rlike("[0-9@]")
    share = 2 * windows / max(docs.filter(rich).count(), 1)
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    drawn = (
        docs.filter(draw < share)
        .filter(rich)
        .select("text")
        .mapInArrow(_training_rows, "draw long, x binary, y binary")
        .distinct()
        .orderBy("draw", "x")
        .limit(windows)
        .collect()
    )
    if not drawn:
        return None
    x, y = (
        np.stack([np.frombuffer(r[name], np.uint8) for r in drawn]) for name in ("x", "y")
    )
    return Tagger(TAGS).train(*planted(x, y, KINDS, 1, ord(" "), codes), steps)


def find(texts: list[str | None], model: Tagger | None) -> Iterator[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of every text."""
    waiting: list[tuple] = []
    windows: list[np.ndarray] = []

    def flush() -> Iterator[tuple[list[Span], list[Span]]]:
        tags = np.zeros((0, DECODED_WIDTH), np.int8)
        if windows:
            tags = model.decode(np.concatenate(windows))
        at = 0
        for text, base, failed, starts in waiting:
            if not starts:
                yield base, base
                continue
            own = tags[at : at + len(starts)]
            at += len(starts)
            if own.any():
                own = reconcile(len(text), starts, own, DECODED_STRIDE)
                yield base, all_spans(text, base, failed, own)
            else:
                yield base, base
        waiting.clear()
        windows.clear()

    for text in texts:
        text = text or ""
        base, failed = base_spans(text)
        starts = window_starts(text, len(text), DECODED_WIDTH, DECODED_STRIDE) if model else []
        waiting.append((text, base, failed, starts))
        if starts:
            windows.append(cut(codes(text), starts, PAD, DECODED_WIDTH))
        if sum(map(len, windows)) >= DECODED:
            yield from flush()
    yield from flush()


_SPAN = "array<struct<kind:string,start:int,end:int>>"


def personal_data(
    docs: DataFrame, model: Tagger | None = None, windows: int = TRAINING_WINDOWS
) -> DataFrame:
    """(doc_id, base, spans): the base spans and all spans of every row of ``docs(doc_id, text)``.

    Spans are (kind, start, end) in code points, end exclusive, in the order of KINDS and of
    their starts. Without a ``model``, one is trained from ``windows`` windows of the
    documents. Null and empty texts have no spans. Rows with a null or repeated doc_id are
    searched like others. An empty table gives an empty result; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model or fit(docs, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        named = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        for batch in batches:
            base, every = [], []
            for one, both in find(batch["text"].to_pylist(), sent.value):
                base.append(named(one))
                every.append(named(both))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(base, kind), pa.array(every, kind)],
                names=["doc_id", "base", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, base {_SPAN}, spans {_SPAN}")


def written(spans: str) -> F.Column:
    """Spans as kind:start:end, comma-joined."""
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(each, ",")


def number(spans: str, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

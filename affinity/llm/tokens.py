"""Token ids of whole texts by a public tokenizer, fast enough for a corpus.

No pretoken of byte-level BPE runs from a character that is no white space into one that is, nor from
a letter or digit into punctuation. So a text may be cut there, and most pieces occur again and
again: of the texts that are encoded together only the distinct pieces are looked up, and a worker
keeps the ids of those it has met as plain arrays. New pieces are encoded in few long texts, wherever
they may follow one another there as well; the lengths of the tokens in bytes tell where each
one ends. The ids are those of the tokenizer itself (tested).
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from affinity.llm import worker
from affinity.llm.text import slices, utf8

# Pieces and bytes of them that a worker remembers; beyond, it starts anew. Bounds its memory to some 50 MB.
CACHE_PIECES, CACHE_BYTES = 500_000, 16_000_000
# Bytes of texts whose pieces are looked up together, and of new pieces encoded as one text.
LOOKED_UP, JOINED = 4_000_000, 5000

# White space of ASCII, before which a text is cut; after the separators 1C to 1F it is not cut either.
_BLANK, _SPACE, _WORD, _MARK = np.zeros((4, 256), bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True
_SPACE[list(b" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f")] = True
# Letters and digits of ASCII, after which a text is cut before punctuation of ASCII.
_WORD[[c for c in range(128) if chr(c).isalnum()]] = True
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
# All other white space, by the bytes before the last: U+0085 and U+00A0, U+1680, U+2000 and following, U+205F, U+3000.
_WIDE = {
    b"\xc2": [0x85, 0xA0],
    b"\xe1\x9a": [0x80],
    b"\xe2\x80": [*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF],
    b"\xe2\x81": [0x9F],
    b"\xe3\x80": [0x80],
}


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _ends_space(data: np.ndarray) -> np.ndarray:
    """Whether each byte of UTF-8 is the last one of white space."""
    out = _SPACE[data]
    for lead, last in _WIDE.items():
        at = np.flatnonzero(data == lead[0]) + len(lead)
        at = at[np.isin(data[at], last)]
        if len(lead) > 1:
            at = at[data[at - 1] == lead[1]]
        out[at] = True
    return out


def _may_cut(data: np.ndarray, before: np.ndarray, after: np.ndarray, marks: bool) -> np.ndarray:
    """Whether a text may be cut between the bytes at ``before`` and ``after``; ``marks``: before punctuation too."""
    out = _BLANK[data[after]] & ~_ends_space(data)[before]
    return out | (_MARK[data[after]] & _WORD[data[before]]) if marks else out


class Encoder:
    """Encodes texts; one per worker and tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.whole = self._joins_blanks()
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes_of = self._token_bytes()
        self._clear()

    @classmethod
    def of(cls, path: str) -> Encoder:
        return worker.keep(("encoder", path), lambda: cls(path))

    def _joins_blanks(self) -> bool:
        """Whether this tokenizer is not known to be cut at blanks: all texts go whole then."""
        kind = str(self.tokenizer.pre_tokenizer)
        plain = kind.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in kind
        added = self.tokenizer.get_added_tokens_decoder().values()
        return (
            not plain
            or self.tokenizer.normalizer is not None
            or any(any(map(str.isspace, t.content)) or t.lstrip or t.rstrip for t in added)
        )

    def _token_bytes(self) -> np.ndarray:
        """The length of every token in bytes: a character of the byte-level vocabulary is a byte."""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        out = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        for token, i in vocabulary.items():
            out[i] = len(token)
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            out[i] = len(token.content.encode())
        return out

    def _clear(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.flat = np.zeros(0, np.uint32)  # ids of all known pieces
        self.starts = np.zeros(1, np.int64)

    def encode(self, texts) -> list[np.ndarray]:
        """The ids of every text as uint32, without special tokens; null is empty.

        ``texts`` is a list or an Arrow array.
        """
        return [*self.each(texts)]

    def each(self, texts) -> Iterator[np.ndarray]:
        """The same, one after the other: only the ids of some texts are held at a time."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts
        if self.whole:
            yield from (self._encode_whole(t or "") for t in texts.to_pylist())
            return
        data, offsets = utf8(texts)
        for i, j in slices(offsets, LOOKED_UP):
            yield from self._encode_some(data, offsets[i : j + 1])

    def _encode_some(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        if not len(data):
            yield from (np.zeros(0, np.uint32) for _ in offsets[1:])
            return
        # Tokens added to the vocabulary are found before all else; they hold no white space, but may hold punctuation.
        raw = data.tobytes()
        marks = not any(token in raw for token in self.added)
        is_cut = np.zeros(len(data), bool)
        is_cut[1:] = _may_cut(data, slice(None, -1), slice(1, None), marks)
        is_cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        bounds = np.append(np.flatnonzero(is_cut), len(data))
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        ).dictionary_encode()
        at = self._numbers(pieces.dictionary)[pieces.indices.to_numpy()]
        n = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        shift = self.starts[at] - ends[:-1]
        first = np.searchsorted(bounds, offsets)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            own = np.arange(ends[a], ends[b])
            own += np.repeat(shift[a:b], n[a:b])
            yield self.flat[own]

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The place of every distinct piece among the known ones, after new ones are learnt."""
        if len(self.known) > CACHE_PIECES or self.known.nbytes > CACHE_BYTES:
            self._clear()
        found = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(found.is_null())
        out = found.fill_null(-1).to_numpy().astype(np.int64)
        out[out < 0] = np.arange(len(self.known), len(self.known) + len(new))
        if len(new):
            ids, sizes = self._learn(new)
            self.known = pa.concat_arrays([self.known, new])
            self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(sizes))
            self.flat = np.append(self.flat, ids)
        return out

    def _learn(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and how many each has."""
        data, offsets = utf8(pieces.view(pa.large_string()))
        joins = _may_cut(data, offsets[1:-1] - 1, offsets[1:-1], True)
        ids, sizes = [], []
        for i, j in slices(offsets, JOINED):
            # Neighbours that would not have been cut in a text are encoded apart.
            apart = np.ones(j - i + 1, bool)
            apart[1:-1] = ~joins[i : j - 1]
            edges = np.flatnonzero(apart) + i
            texts = [
                data[offsets[a] : offsets[b]].tobytes().decode()
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
            ]
            for a, b, got in zip(
                edges[:-1].tolist(), edges[1:].tolist(),
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True,
            ):
                own = np.array(got.ids, np.uint32)
                if b - a == 1:
                    ids.append(own)
                    sizes.append([len(own)])
                    continue
                ends = np.cumsum(self.bytes_of[own])
                wanted = offsets[a + 1 : b + 1] - offsets[a]
                last = np.searchsorted(ends, wanted)
                if last[-1] == len(own) - 1 and (ends[last] == wanted).all():
                    ids.append(own)
                    sizes.append(np.diff(last, prepend=-1))
                    continue
                # A vocabulary that does not spell all texts.
                for k in range(a, b):
                    ids.append(self._encode_whole(data[offsets[k] : offsets[k + 1]].tobytes().decode()))
                    sizes.append([len(ids[-1])])
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode_whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

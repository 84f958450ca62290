"""Varied surfaces of personal data, and numbers that look like it, for training windows.

Forms are made from a seed. They carry the label of their kind into real windows of text, so that
a tagger learns more than the patterns by which the text itself is labelled.
"""

from __future__ import annotations

import numpy as np

_LETTERS = "abcdefghijklmnopqrstuvwxyz"


class Forms:
    def __init__(self, seed: int):
        self.random = np.random.default_rng(seed)

    def one(self, choices):
        return choices[int(self.random.integers(len(choices)))]

    def digits(self, n: int) -> str:
        return "".join(map(str, self.random.integers(0, 10, n)))

    def word(self, least: int = 2, most: int = 9) -> str:
        n = int(self.random.integers(least, most + 1))
        return "".join(_LETTERS[k] for k in self.random.integers(0, 26, n))

    def groups(self, sizes: tuple[int, ...], between: str) -> str:
        return between.join(self.digits(n) for n in sizes)

    def email(self) -> str:
        at = self.one(("@", "@", " @ ", " at ", "(at)", "[at]", " (at) "))
        dot = "." if "@" in at else self.one((".", " dot ", "(dot)", "[dot]"))
        local = self.one((self.word(), f"{self.word()}{self.digits(2)}", f"{self.word()}.{self.word()}"))
        host = self.one((self.word(), f"{self.word()}{dot}{self.word()}"))
        return f"{local}{at}{host}{dot}{self.one(('com', 'org', 'net', 'de', 'fr', 'es', 'info'))}"

    def ip(self) -> str:
        if self.random.random() < 0.5:
            parts = [f"{int(p):x}" for p in self.random.integers(1, 1 << 16, 8)]
            kept = int(self.random.integers(2, 7))
            return self.one((":".join(parts), ":".join(parts[:kept]) + "::" + parts[7]))
        dot = self.one((".", "[.]", " . ", "(.)"))
        return dot.join(str(int(p)) for p in self.random.integers(0, 256, 4))

    def card(self) -> str:
        body = [int(d) for d in self.one("3456") + self.digits(14)]
        doubled = sum(d * 2 - 9 if d > 4 else d * 2 for d in body[0::2])
        body.append(-(doubled + sum(body[1::2])) % 10)
        text = "".join(map(str, body))
        between = self.one((" ", "-", ".", "/", "_", "  "))
        return between.join(text[k : k + 4] for k in range(0, 16, 4))

    def phone(self) -> str:
        return self.one(
            (
                lambda: f"({self.digits(3)}) {self.groups((3, 4), '-')}",
                lambda: self.groups((3, 3, 4), self.one(("-", ".", " "))),
                lambda: f"00{self.groups((2, 2, 7), ' ')}",
                lambda: f"0{self.digits(2)}/{self.digits(7)}",
                lambda: f"+{self.groups((2, 3, 3, 4), self.one((' ', '-', '.')))}",
                lambda: f"0{self.digits(1)} {self.groups((2, 2, 2, 2), self.one((' ', '.')))}",
            )
        )()

    def none(self) -> str:
        """Numbers and words that are no personal data."""
        return self.one(
            (
                lambda: f"{self.one(('1', '2'))}{self.digits(3)}-{self.groups((2, 2), '-')}",
                lambda: self.groups((2, 2, 4), self.one((".", "/"))),
                lambda: self.groups((2, 2), ":"),
                lambda: self.groups((2, 2, 2), ":"),
                lambda: f"{self.digits(2)}.{self.digits(2)}",
                lambda: f"{self.digits(1)}.{self.digits(1)}.{self.digits(2)}",
                lambda: f"{self.digits(3)},{self.digits(3)}",
                lambda: self.digits(int(self.random.integers(1, 15))),
                lambda: self.digits(int(self.random.integers(20, 40))),
                lambda: self.groups((3, 2, 4), "-"),
                lambda: "".join("0123456789abcdef"[k] for k in self.random.integers(0, 16, 40)),
                lambda: f"no. {self.digits(6)}-{self.digits(2)}",
                lambda: f"@{self.word()}",
                lambda: f"{self.word()} at {self.word()}",
                lambda: f"{self.word()} dot {self.word()}",
                lambda: f"{self.word()}.{self.word()}.com",
                lambda: f"{self.word()}: {self.word()}",
                lambda: ". ".join([self.word()] * int(self.random.integers(2, 9))),
                lambda: " ".join([self.word()] * int(self.random.integers(2, 9))),
            )
        )()


def planted(
    x: np.ndarray, y: np.ndarray, kinds: tuple[str, ...], seed: int, blank: int, encode
) -> tuple[np.ndarray, np.ndarray]:
    """Windows with labels, of which most got a form or a number between two words.

    ``kinds`` name methods of ``Forms``; tags are 1 + 2k and 2 + 2k for kind k. A form goes where a
    ``blank`` is outside of any span; what it pushes over the edge of the window is lost. ``encode``
    gives the codes of a text.
    """
    forms = Forms(seed)
    out_x, out_y = x.copy(), y.copy()
    for row_x, row_y in zip(out_x, out_y, strict=True):
        draw = forms.random.random()
        places = np.flatnonzero((row_x == blank) & (row_y == 0))
        if draw < 0.2 or not len(places):
            continue
        number = int(forms.random.integers(len(kinds))) if draw < 0.7 else None
        text = getattr(forms, kinds[number])() if number is not None else forms.none()
        end = forms.one((" ", " ", " ", ", ", ". "))
        at = int(forms.one(places)) + 1
        made = encode(text + end)
        tags = np.zeros(len(made), row_y.dtype)
        if number is not None:
            tags[: len(text)] = 2 + 2 * number
            tags[0] = 1 + 2 * number
        for row, new in ((row_x, made), (row_y, tags)):
            row[at:] = np.concatenate([new, row[at:]])[: len(row) - at]
    return out_x, out_y

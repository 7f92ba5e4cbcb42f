"""Restores disguised words: the likeliest letters behind what was written.

A written token is taken as the noisy output of a channel. Each written character is a
letter itself, stands for a letter (``1`` for i or l), separates letters or words, or
repeats the letter before it. Viterbi decoding finds the letters with the highest
probability under the channel and a character trigram model of the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np

# What a written character may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "¢": "c",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "к": "k", "т": "t",
}

# Log probabilities of the channel.
SELF, STANDS, SEPARATES, BREAKS, REPEATS, DOUBLES = np.log([0.9, 0.5, 0.15, 0.02, 0.3, 0.05])

# Symbols of the character model: 0 is anything between words, 1 to 26 are a to z, 27 is
# a byte of any other letter.
SYMBOLS = 28
_SYMBOL = np.zeros(256, np.uint16)
_SYMBOL[ord("a") : ord("z") + 1] = _SYMBOL[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_SYMBOL[128:] = 27

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_TAIL = re.compile(r"([^\w\s])\1{2,}$")
_DOUBLED = re.compile(r"(\w)\1")
_SPACED = re.compile(r"(?<!\S)[^\w\s]*?(\S(?:\s+\S){2,})[^\w\s]*(?!\S)")
# Marks that may be letters even where a token begins or ends.
_FIRST, _LAST = "$@|€£¢!", "$@|€£¢"
# Letters of another alphabet that look like Latin ones.
_LOOKS = re.compile(f"[{''.join(c for c in STANDS_FOR if c.isalpha())}]")
_LATIN = re.compile("[a-z]")


def trigram_counts(texts: Iterable[str]) -> np.ndarray:
    """How often each sequence of three symbols occurs."""
    data = ("  " + "  ".join(texts) + "  ").encode("utf-8", "surrogatepass")
    s = _SYMBOL[np.frombuffer(data, np.uint8)]
    width = np.uint16(SYMBOLS)
    return np.bincount((s[:-2] * width + s[1:-1]) * width + s[2:], minlength=SYMBOLS**3)


def trigram_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of the third symbol after the first two, smoothed by the shorter contexts."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    one = (three.sum((0, 1)) + 1) / (three.sum() + SYMBOLS)
    two = three.sum(0)
    two = (two + 5 * one) / (two.sum(1, keepdims=True) + 5)
    return np.log((three + 5 * two) / (three.sum(2, keepdims=True) + 5))


def repeat_costs(token: str) -> list[float | None]:
    """What it costs to take a character as a repetition of the letter before it; null where it is none.

    Characters repeat each other if they may be the same letter, also across separators.
    Two letters alike are common, three are not.
    """
    costs: list[float | None] = [None] * len(token)
    run, before = [], frozenset()
    for place, char in enumerate([*token, ""]):
        letters = frozenset(STANDS_FOR.get(char, "")) | (frozenset(char) if char.isalpha() else frozenset())
        if char and not letters:
            continue
        if letters & before:
            run.append(place)
        else:
            for i in run[1:]:
                costs[i] = REPEATS if len(run) > 2 else DOUBLES
            run = [place]
        before = letters
    return costs


class Restorer:
    """Decodes tokens under a model of ``trigram_model``."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()

    def decode(self, token: str) -> str:
        """The likeliest letters; spaces part words."""
        # By the last two symbols: log probability and the decoded text as a linked list.
        states = {(0, 0): (0.0, None)}
        for char, again in zip(token, repeat_costs(token), strict=True):
            options = []
            if char.isalpha():
                options.append((SELF, char))
            if again is not None:
                options.append((again, ""))
            options += [(STANDS, c) for c in STANDS_FOR.get(char, "")]
            if not char.isalnum():
                # A mark that stands for letters seldom parts them.
                options += [(BREAKS if char in STANDS_FOR else SEPARATES, ""), (BREAKS, " ")]
            if not options:
                options = [(SELF, char)]
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (first, second), (score, path) in states.items():
                row = self.model[first][second]
                for cost, out in options:
                    if out:
                        symbol = ord(out) - 96 if "a" <= out <= "z" else 0 if out == " " or out.isdigit() else 27
                        to, total = (second, symbol), score + cost + row[symbol]
                    else:
                        to, total = (first, second), score + cost
                    if to not in following or total > following[to][0]:
                        following[to] = (total, (path, out) if out else path)
            states = following
        best = max(((s + self.model[a][b][0], path) for (a, b), (s, path) in states.items()), key=lambda x: x[0])
        letters, path = [], best[1]
        while path:
            path, out = path
            letters.append(out)
        return "".join(reversed(letters))

    def words(self, token: str) -> list[str]:
        """The words in a written token of lower case: itself, and restored where it is disguised.

        A token of letters only, without a letter twice in a row, has one path through the
        channel that keeps it, and is not decoded. Nor are digits without letters and
        without other characters that stand for letters: they are numbers.
        """
        plain = _EDGE.sub("", token)
        if not any(map(str.isalpha, plain)):
            stand = [c for c in token if c in STANDS_FOR]
            if len(stand) < 3 or all(map(str.isdigit, stand)):
                return []
            return self.decode(_TAIL.sub("", token)).split()
        if plain.isalpha() and not self._foreign(plain):
            if token[0] not in _FIRST and (token[-1] not in _LAST or _TAIL.search(token)):
                if not _DOUBLED.search(plain):
                    return [plain]
                token = plain
        restored = self.decode(_TAIL.sub("", token)).split()
        return [plain, *(w for w in restored if w != plain)]

    @staticmethod
    def _foreign(word: str) -> bool:
        return not word.isascii() and bool(_LOOKS.search(word) and _LATIN.search(word))

    def spaced(self, text: str) -> list[str]:
        """Words written with white space behind every letter."""
        return [w for run in _SPACED.findall(text) for w in self.decode(" ".join(run.split())).split()]

from __future__ import annotations

import pytest

from tidemark.llm.deobfuscation import Restorer, trigram_counts, trigram_model

TEXTS = [
    "the river and the stone of a letter in the garden, all summer water will still run in the morning",
    "you idiot and stupid moron, what scum you are, an idiom is not idiotic", "books and wood in a good room",
    "a boat at sea is also a goal",
] * 20


@pytest.fixture(scope="module")
def restorer():
    return Restorer(trigram_model(trigram_counts(TEXTS)))


@pytest.mark.parametrize(
    "token, word",
    [
        ("iidiioott", "idiot"), ("mmoronn", "moron"), ("sttupid", "stupid"), ("m000ron", "moron"), ("1111diot", "idiot"),
        ("m00r00n", "moron"), ("mo0oron", "moron"), ("$$$tupid", "stupid"), ("m-m-oron", "moron"), ("stuupid!", "stupid"),
    ],
)
def test_repetitions_collapse(restorer, token, word):
    assert word in restorer.words(token)


def test_doubled_letters_that_are_likely_stay(restorer):
    for word in ("letter", "summer", "will", "still", "books", "wood", "good", "room", "all"):
        assert restorer.words(word) == [word]


@pytest.mark.parametrize(
    "text, word",
    [
        ("what s c u m.", "scum"), ('a "m o r o n" here', "moron"), ("m  o  r  o  n", "moron"), ("(s c u m)", "scum"),
        ("$ c u m!", "scum"), ("m o r\no n,", "moron"), ("s c u m then", "scum"),
    ],
)
def test_spaced_words(restorer, text, word):
    assert word in restorer.spaced(text)


def test_letterless_tokens(restorer):
    assert restorer.words("80@+") == ["boat"]
    for number in ("2024", "555-1234", "...", "3.14", "!!!", "$5"):
        assert restorer.words(number) == []

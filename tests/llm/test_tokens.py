from __future__ import annotations

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = tokens.TokenCounter(PATH)


def counted(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


ODD = [
    "", " ", "  ", "\n\n  x", "a\n b", "a \n b", "x\x1cy \x1d z", "it's we'll 'S", "<|endoftext|>", "a <|endoftext|>  b<|endoftext|>",
    "ab <|endoftext|", " a b　c", "😀😀 é́", "1234 5 67", "!?!? ...", "\r\n\t\v\f x", "a\u0085b c", "​ x﻿",
    "x" * 3000, " " * 500 + "y", "  a᠎ b",
]


def test_chunks_count_like_whole_texts():
    rng = random.Random(1)
    pieces = [*ODD, *" \n\t.,'aé9", "word", " the", "\x1f", " ", "'s"]
    texts = ODD + ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(3000)]
    counter = tokens.TokenCounter(PATH)
    assert counter.count(texts) == [counted(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    assert COUNTER.count([text]) == [counted(text)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_counts_and_cache(make_docs, spark, tmp_path):
    cache = str(tmp_path / "cache")
    rows = [(1, "some words"), (2, "some words"), (2, None), (None, "other words here"), (5, ""), (6, "word " * 600), (6, "word " * 600)]
    rows += [(10 + i, t) for i, t in enumerate(ODD)]
    want = sorted(((i, len((t or "").encode()), counted(t), counted(t) > 512) for i, t in rows), key=str)
    assert rows_of(tokens.count_tokens(make_docs(rows), PATH, cache)) == want
    distinct = len({t or "" for _, t in rows})
    assert spark.read.parquet(cache).count() == distinct
    # A second run adds what is new only, and old counts are used.
    more = rows + [(99, "new text")]
    got = rows_of(tokens.count_tokens(make_docs(more), PATH, cache))
    assert got == sorted([*want, (99, 8, counted("new text"), False)], key=str)
    assert spark.read.parquet(cache).count() == distinct + 1
    assert rows_of(tokens.count_tokens(make_docs(rows).limit(0), PATH, cache)) == []


def test_other_tokenizer_has_its_own_counts(make_docs, spark, tmp_path):
    other = tmp_path / "other.json"
    other.write_text(open(PATH, encoding="utf-8").read() + "\n", encoding="utf-8")
    cache = str(tmp_path / "cache")
    for path in (PATH, str(other)):
        tokens.count_tokens(make_docs([(1, "a b")]), path, cache).collect()
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


@pytest.mark.parametrize("times", [1, 2])
def test_repeated_cache_rows(make_docs, spark, tmp_path, times):
    cache = str(tmp_path / "cache")
    docs = make_docs([(1, "a b")])
    tokens.count_tokens(docs, PATH, cache).collect()
    for _ in range(times):
        spark.read.parquet(cache).limit(1).write.mode("append").parquet(str(tmp_path / f"copy{times}"))
    spark.read.parquet(str(tmp_path / f"copy{times}")).write.mode("append").parquet(cache)
    assert tokens.count_tokens(docs, PATH, cache).count() == 1


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_encode_whole_texts(name):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        library = Tokenizer.from_file(path)
        want = [len(library.encode(t, add_special_tokens=False).ids) for t in ODD]
    else:
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        want = [len(library.encode(t)) for t in ODD]
    counter = tokens.TokenCounter(path)
    assert not counter.chunked and COUNTER.chunked
    assert counter.count(ODD) == want

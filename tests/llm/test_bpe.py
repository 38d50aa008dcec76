"""Byte-level BPE against the tiktoken library, and back to the bytes."""

import random
import time

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from loadlens.llm import bpe
from loadlens.llm.catalog import RANKS
from tests.llm.helpers import documents

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {piece: i for i, piece in enumerate(bpe.vocabulary(RANKS).pieces)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(11)
    letters = "abcdefghij ABC  éßñ中文字日本語　\xa0​ \x1c\x1f\x85²½ªºǅ0123 '\"_-–%$\n\t\r💥👍🏽́"
    out = ["".join(rng.choices(letters, k=rng.randint(1, 80))) for _ in range(400)]
    out += ["", None, " ", "\n\n\n", "don't we'll I'M 's'", "aaaa" * 30, "x" * 64, "x" * 65, "é" * 33]
    out += ["a" * 50_000, "".join(rng.choices("abcdefgh", k=30_000)), "the cat " * 30_000]
    return out + ["<|endoftext|> <|endoftext|>", "١٢٣ ⅫⅣ ①②", "ﷺ ʼn ѣ ꙮ"]


def test_the_pattern_with_the_fast_form():
    assert PATTERN == bpe.GPT_PATTERN
    general, plain = regex.compile(PATTERN), 0
    for code in [*range(0xD800), *range(0xE000, 0x20400)]:
        text = f"{chr(code)} a{chr(code)} b{chr(code)}1{chr(code)}  "
        if bpe._is_plain(text):
            plain += 1
            assert bpe._PLAIN_WORDS.findall(text) == general.findall(text), code
    assert plain > 60_000 and all(map(bpe._is_plain, ("“naïve” – 日本語 💥 Ωж €", "a\n\t b")))
    assert not any(map(bpe._is_plain, ("a\x1cb", "x²", "Ⅻ", "①")))


def test_the_fast_form_is_fast():
    text = "words and more wörds, " * 50_000 + "💥 “quoted” – 日本語 " * 1000
    began = time.process_time()
    assert bpe._is_plain(text)
    assert time.process_time() - began < 1


def test_words_merge_as_in_the_library(library):
    ranks = bpe.rank_map(RANKS)
    rng = random.Random(2)
    for _ in range(500):
        raw = "".join(rng.choices("etaoinsh rdlué", k=rng.randint(1, 90))).encode()
        want = library._encode_single_piece(raw)
        assert bpe.merge_word(raw, ranks) == want
        if raw not in ranks:
            assert bpe._merge_long(raw, ranks) == want


@pytest.mark.parametrize("functions", [False, True])
@pytest.mark.parametrize("batch", [1000, bpe.BATCH])
def test_whole_texts(spark, library, monkeypatch, batch, functions):
    """Folded in the Arrow function and by higher-order functions, in many batches and in one."""
    monkeypatch.setattr(bpe, "BATCH", batch)
    monkeypatch.setattr(bpe, "MEMORY", 20 * batch)
    rows = list(enumerate(texts())) + [(None, "null id"), (3, "again"), (3, "again")]
    found = bpe.encode(documents(spark, rows), RANKS, PATTERN, functions=functions)
    found = found.withColumn("raw", bpe.decode(F.col("ids"), RANKS))
    found = found.withColumn("le", bpe.little_endian(F.col("ids")))
    got = sorted(((r.doc_id, r.ids, bytes(r.raw), bytes(r.le)) for r in found.collect()), key=str)
    want = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        spelled = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, ids, (text or "").encode(), spelled))
    assert got == sorted(want, key=str)
    there = bpe.round_trip(documents(spark, rows), RANKS, PATTERN).collect()
    there = sorted(((r.doc_id, bytes(r.decoded), bytes(r.ids)) for r in there), key=str)
    assert there == sorted(((i, raw, le) for i, _, raw, le in want), key=str)


def test_empty_table(spark):
    empty = documents(spark, [(1, "a")]).limit(0)
    for functions in (False, True):
        assert bpe.encode(empty, RANKS, PATTERN, functions=functions).collect() == []
    assert bpe.round_trip(empty, RANKS, PATTERN).collect() == []

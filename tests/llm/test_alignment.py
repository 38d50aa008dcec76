"""Alignment of two tokenizers against plain Python."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loadlens.llm import alignment
from loadlens.llm.alignment import Hash, Tokenizers, align_tokenizers
from tests.llm.helpers import documents

NAMES = Tokenizers(
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
    public_tokenizers.path("piece_bpe_32k.model"),
)
SIDES = NAMES.sides()
ROWS = [
    (1, "The quick brown fox doesn't jump."),
    (2, "The quick brown fox doesn't jump."),
    (3, "Übergrößenträger 中文字 🙂🙂  two  blanks\n\n\ttab <0x41> <s> <|endoftext|>"),
    (4, None),
    (5, ""),
    (6, " "),
    (7, "a ▁ sign that the second side spells as a blank"),
    (7, "another row of the same id"),
    (None, "no id"),
    (8, "word " * 30_000 + "x" * 5_000),
]


def spans(text):
    """(id, start, end) of both sides, or none."""
    out = []
    for side in SIDES:
        at, tokens = 0, []
        for i in side.encode(text) if text else []:
            tokens.append((i, at, at + len(side.pieces[i])))
            at = tokens[-1][2]
        out.append(tokens)
    raw = b" " + (text or "").encode()
    same = all(b"".join(s.pieces[t[0]] for t in found) == raw for s, found in zip(SIDES, out, strict=True))
    return out if text and same else [[], []]


def expected(rows):
    links, digests = [], []
    for _, text in rows:
        a, b = spans(text)
        found, k = [], 0
        for i, start, end in a:
            while k and b[k - 1][2] > start:
                k -= 1
            while k < len(b) and b[k][1] < end:
                if b[k][2] > start:
                    found.append((i, b[k][0]))
                k += 1
        links.append(found)
        both = sorted({t[2] for t in a} & {t[2] for t in b})
        groups, first = [], 0
        for end in both:
            ids = [[str(i) for i, _, e in side if first < e <= end] for side in (a, b)] if len(a) < 1000 else [[], []]
            groups.append("|".join(",".join(x) for x in ids))
            first = end
        digests.append((len(a), len(b), len(both), ";".join(groups)))
    counts = Counter(p for found in links for p in set(found))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(n, best.get(i, 0))
    out = []
    for (key, _), found, (n_a, n_b, n_groups, text) in zip(rows, links, digests, strict=True):
        n_best = sum(counts[p] == best[p[0]] for p in found)
        out.append((key, n_a, n_b, n_groups, len(found), n_best, sum(counts[p] for p in found), text))
    return out


@pytest.mark.parametrize("block_pairs", [1 << 20, 40])
def test_against_plain_python(spark, block_pairs):
    rows = [tuple(r) for r in align_tokenizers(documents(spark, ROWS).repartition(3), NAMES, block_pairs=block_pairs, groups=True).collect()]
    key = lambda r: (str(r[0]), r[1:7])
    for got, want in zip(sorted(rows, key=key), sorted(expected(ROWS), key=key), strict=True):
        assert got[:7] == want[:7]
        if got[0] != 8:
            assert got[8] == want[7]
        assert got[7] == (hashlib.sha256(got[8].encode()).hexdigest() if got[8] else "")


def test_empty_table(spark):
    assert align_tokenizers(documents(spark, ROWS).limit(0), NAMES).collect() == []


def test_only_texts_without_tokens(spark):
    rows = align_tokenizers(documents(spark, [(1, None), (2, "")]), NAMES).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_both_files_of_the_first_tokenizer_agree(texts):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    known.encode_special_tokens = True
    for text in [*texts, "".join(texts) + "<|endoftext|>"]:
        assert SIDES[0].encode(text) == known.encode(" " + text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=40)
@given(st.sets(st.integers(0, 2**45), min_size=1, max_size=3000), st.integers(1, 4))
def test_hash_is_minimal_perfect_and_verified(pairs, buckets):
    pairs = np.array(sorted(pairs), np.int64)
    bucket = alignment._bucket_of(alignment._mixed(pairs), buckets)
    made = [alignment.fill_bucket(pairs[bucket == k]) for k in range(buckets)]
    seeds, ordered = zip(*made, strict=True)
    start, seed_start = (np.concatenate(([0], np.cumsum([len(x) for x in p]))) for p in (ordered, seeds))
    known = Hash(0, 1, start, seed_start, np.concatenate(seeds), np.concatenate(ordered))
    assert sorted(known.index(pairs)) == list(range(len(pairs)))
    with pytest.raises(ValueError):
        known.index(np.array([2**45 + 7]))

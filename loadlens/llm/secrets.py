"""Secrets: fixed patterns, and tokens that a Markov model of random strings explains better."""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from loadlens.llm.common import text_of

# The base patterns and the least lengths of what they match.
ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_N = len(ALPHABET) + 1  # state 0 is the beginning of a token
_CODE = np.zeros(256, np.uint8)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, _N)
#: Runs of letters, digits and signs, with dashes and points inside them.
_TOKEN = re.compile(r"[A-Za-z0-9+/_=]+(?:[-.][A-Za-z0-9+/_=]+)*")
#: Shorter tokens are neither learned from nor judged; those below the second are only learned from.
LEAST_TOKEN = 8
LEAST_RANDOM = 16
#: A token is random from this log-likelihood ratio on: odds of about 160,000 to 1.
LEAST_RATIO = 12.0


def base_matches(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret) of the base patterns' matches, leftmost and
    non-overlapping per kind. The secret of an assignment is its value, without name and sign."""
    out = []
    lowered = text.lower()
    if any(w in lowered for w in ("passw", "secret", "token", "apikey", "api_key")):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_ASSIGN:
                out.append((m.start(), 0, m.end(), m.start(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= LEAST_ACCESS:
                out.append((m.start(), 1, m.end(), m.start()))
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    return [found[:3] for found in base_matches(text)]


def training_tokens(text: str) -> tuple[list[str], list[str]]:
    """The secrets of a text, and all its other tokens."""
    found = base_matches(text)
    rest = _outside(text, [m[:3] for m in found]) if found else text
    return [text[m[3] : m[2]] for m in found], [t for t in _TOKEN.findall(rest) if len(t) >= LEAST_TOKEN]


class Markov(NamedTuple):
    """Log-likelihood ratio, random against ordinary, of each character after each other."""

    ratio: np.ndarray

    def score(self, token: str) -> float:
        codes = _CODE[np.frombuffer(token.encode(), np.uint8)].astype(np.int64)
        return float(self.ratio[np.concatenate(([0], codes[:-1])), codes].sum())


def _pairs(tokens: list[str]) -> np.ndarray:
    """How often each character follows each other within the tokens."""
    joined = ("\n" + "\n".join(tokens)).encode()  # a line end has code 0
    codes = _CODE[np.frombuffer(joined, np.uint8)].astype(np.int64)
    return np.bincount(codes[:-1] * _N + codes[1:], minlength=_N * _N)


def _outside(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with the spans blanked, so that offsets stay."""
    parts, at = [], 0
    for start, _, end in spans:
        if end > at:
            start = max(start, at)
            parts += [text[at:start], " " * (end - start)]
            at = end
    return "".join([*parts, text[at:]])


_COUNTS = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("random", "before", "after", "n")]
)


def _count(batches):
    """Within one task: pairs of characters in secrets (1) and in all other tokens (0)."""
    totals = np.zeros((2, _N * _N), np.int64)
    for b in batches:
        for x in b.column(0):
            secret, rest = training_tokens(x.as_py())
            if secret:
                totals[1] += _pairs(secret)
            if rest:
                totals[0] += _pairs(rest)
    kind, cell = np.nonzero(totals)
    columns = [kind, cell // _N, cell % _N, totals[kind, cell]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c.astype(np.int64)) for c in columns], names=_COUNTS.names
    )


def train(docs: DataFrame, text_col: str = "text") -> Markov:
    """Both models from all texts: the base patterns label their matches as random strings and
    every other token as ordinary.

    The counts are added up within each task and then by pair; they are few whatever the input, so
    the sums are small enough for the driver. Each model is smoothed by one count a pair, and has
    the ordinary model's weight where it knows nothing. Without texts the ratio is 0 everywhere.
    """
    counted = docs.select(text_of(text_col)).mapInArrow(_count, _COUNTS)
    summed = counted.groupBy("random", "before", "after").agg(F.sum("n").alias("n"))
    seen = np.zeros((2, _N, _N))
    for r in summed.collect():  # 2 * 69 * 69 rows at most
        seen[r.random, r.before, r.after] = r.n
    logs = []
    for k in (0, 1):
        cells = seen[k].copy()
        cells[:, 0] = 0  # the end of a token is not scored
        # Random strings follow no order, so few samples are enough once pairs back off to letters.
        letters = cells.sum(axis=0) + 1
        letters[0] = 0
        cells += 20 * letters / letters.sum()
        with np.errstate(divide="ignore", invalid="ignore"):
            logs.append(np.nan_to_num(np.log(cells / cells.sum(axis=1, keepdims=True)), neginf=0.0))
    ratio = logs[1] - logs[0]
    return Markov(ratio if seen[1].sum() else np.zeros_like(ratio))


_SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ]
)
_SPANS = T.ArrayType(_SPAN)


def all_spans(text: str, model: Markov) -> list[tuple[int, int, int]]:
    spans = base_spans(text)
    more = []
    for m in _TOKEN.finditer(_outside(text, spans) if spans else text):
        if len(m[0]) >= LEAST_RANDOM and model.score(m[0]) >= LEAST_RATIO:
            more.append((m.start(), 3, m.end()))
    return sorted(spans + more)


def find_secrets(model: Markov, text_col: str | Column = "text") -> Column:
    """``kind, start, end`` of every secret in a text, by start and then in the order of ``KINDS``.

    Offsets are code points, the end exclusive. ``assign``, ``access`` and ``hex`` are the base
    patterns; ``random`` are tokens of at least ``LEAST_RANDOM`` characters outside them, which the
    model of random strings explains better by ``LEAST_RATIO``. Null and empty texts have none.
    The whole text is read, row by row; nothing is shuffled.
    """
    ratio = model.ratio

    @F.arrow_udf(_SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        own = Markov(ratio)
        out = [
            [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in all_spans(x.as_py(), own)]
            for x in texts
        ]
        return pa.array(out, to_arrow_type(_SPANS))

    return scan(text_of(text_col))

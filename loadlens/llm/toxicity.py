"""Toxicity: learned terms and stems, found with misspellings, and weighed by their context."""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm.common import cut, release, text_of
from loadlens.llm.lexicon import Lexicon, Term

#: The classifier is fitted on at most so many labelled rows of either class, chosen by hash.
POSITIVES, NEGATIVES = 2_000, 6_000
#: Tasks that the sampled texts are dealt to; a task sees a hundred or two of them.
SAMPLE_TASKS = 64
#: Words either side of a term that its context score reads.
REACH = 6
#: Bytes of words whose reading a task remembers, roughly.
MEMORY = 24 << 20
#: A stem is at least and at most so long; shorter and longer terms are whole words. Words from the
#: shortest length on may be misspelled.
SHORTEST, LONGEST = 4, 8

_WORD = re.compile(r"[^\W_]+(?:[@$][^\W_]+)*")
#: A word with the signs that are written for letters, wherever they stand.
_MASKED = re.compile(r"(?:[^\W_]|[@$*])+")
_QUOTE = re.compile(r"[\"“”„«»]")
#: Between paragraphs: a line without anything.
_BREAK = re.compile(r"\n[^\S\n]*\n")
#: What may close a quotation that a mark opens.
_CLOSING = {'"': '"', "“": "”", "„": "“”", "«": "»", "»": "«", "”": "”"}
# Words that report what others said, and words of direct address (en de fr es).
REPORTING = frozenset(
    "said says wrote writes called calls quoted quote sagte schrieb nannte zitat dit écrit appelé "
    "citation dijo escribió llamó cita".split()
)
ADDRESS = frozenset("you your youre du dich dein ihr tu toi vous ton eres tú usted tu".split())
_N_FEATURES = 3


class Model(NamedTuple):
    terms: list[Term]
    weights: list[float]  # of 1 and the features


class Reader:
    """A lexicon, and what it found in the words that a task has met."""

    def __init__(self, terms: list[Term]):
        self.lexicon = Lexicon(terms)
        self.known: dict[str, list] = {}
        self.size = 0

    def has_hits(self, words: set[str]) -> bool:
        new = words.difference(self.known)
        if self.size > MEMORY:
            self.known.clear()
            self.size, new = 0, words
        for word in new:
            self.known[word] = _read(self.lexicon.match, word)
            self.size += 2 * len(word) + 150
        return any(map(self.known.__getitem__, words))


def quotations(line: str) -> list[tuple[int, int]]:
    """Start and end of the quotations of a text, in order. A mark that nothing closes opens none.

    One pass from the right finds the next mark of each kind, one from the left pairs them.
    """
    marks = [(m.start(), m.group()) for m in _QUOTE.finditer(line)]
    following: dict[str, int] = {}
    closed = [0] * len(marks)
    for i in range(len(marks) - 1, -1, -1):
        at, mark = marks[i]
        # Marks that may close open only where a word may begin.
        opens = mark not in "”»\"" or not at or not (line[at - 1].isalnum() or line[at - 1] in ".,!?;:…")
        closed[i] = min((following[c] for c in _CLOSING[mark] if c in following), default=0) if opens else 0
        following[mark] = i
    out, i = [], 0
    while i < len(marks):
        if closed[i]:
            out.append((marks[i][0], marks[closed[i]][0] + 1))
            i = closed[i]
        i += 1
    return out


def _inside(spans: list[tuple[int, int]], at: int) -> bool:
    k = bisect.bisect_right(spans, (at, math.inf)) - 1
    return k >= 0 and at < spans[k][1]


class Paragraph:
    """The lines between two empty ones: where its quotations and words are."""

    def __init__(self, text: str, start: int, stop: int):
        self.text, self.start, self.stop = text, start, stop
        self.quoted = [(start + i, start + j) for i, j in quotations(text[start:stop])]
        words = [m.span() for m in _WORD.finditer(text, start, stop)]
        self.starts, self.ends = [i for i, _ in words], [j for _, j in words]

    def score(self, start: int, end: int) -> float:
        """How much of a term counts as abuse: less in quotation or report, all in direct address."""
        before, after = bisect.bisect_right(self.ends, start), bisect.bisect_left(self.starts, end)
        near = [*range(max(0, before - REACH), before), *range(after, min(len(self.ends), after + REACH))]
        words = {self.text[self.starts[k] : self.ends[k]].lower() for k in near}
        score = 1.0
        if _inside(self.quoted, start):
            score -= 0.5
        if words & REPORTING:
            score -= 0.25
        if words & ADDRESS:
            score += 0.25
        return min(1.0, score)


def paragraphs(text: str) -> Iterator[tuple[int, int]]:
    start = 0
    for m in _BREAK.finditer(text):
        yield start, m.start()
        start = m.end()
    yield start, len(text)


def context_score(text: str, start: int, end: int) -> float:
    """The context score of the term at ``start`` in its paragraph."""
    own = next(p for p in paragraphs(text) if start < p[1])
    return Paragraph(text, *own).score(start, end)


def hits(reader: Reader, text: str) -> list[tuple[int, int, float]]:
    """(term, edits, context score) of every occurrence of a term."""
    if not reader.has_hits(set(_MASKED.findall(text.lower()))):
        return []
    out, match = [], reader.lexicon.match
    parts = paragraphs(text)
    start, stop = next(parts)
    own = None
    for m in _MASKED.finditer(text):  # lowered word by word, so offsets are those of the text
        word = m.group()
        low = word.lower()
        found = reader.known.get(low) if len(low) == len(word) else None
        for term, e, i, j in _read(match, word) if found is None else found:
            while m.start() >= stop:
                start, stop = next(parts)
            if own is None or own.start != start:
                own = Paragraph(text, start, stop)
            out.append((term, e, own.score(m.start() + i, m.start() + j)))
    return out


def _read(match, word: str) -> list[tuple[int, int, int, int]]:
    """(term, edits, start, end) of a word with its signs, or of its parts if they are as close."""
    whole = match(word.lower())
    if word.isalnum():
        return [(*whole, 0, len(word))] if whole else []
    parts = [
        (*hit, m.start(), m.end()) for m in _WORD.finditer(word) if (hit := match(m.group().lower()))
    ]
    if whole and all(whole[1] < e for _, e, _, _ in parts):
        return [(*whole, 0, len(word))]
    return parts


def features(found: list[tuple[int, int, float]]) -> list[float]:
    """What the classifier sees of a text. A misspelled term counts four fifths per edit; terms
    whose misspellings occur in clean texts have none (see ``train``)."""
    weights = [c * 0.8**e for _, e, c in found]
    return [
        math.log1p(sum(weights)),
        float(any(w > 0.5 for w in weights)),
        math.log1p(len({t for t, _, _ in found})),
    ]


_PAIRS = T.ArrayType(
    T.StructType([T.StructField("term", T.StringType()), T.StructField("context", T.StringType())])
)


def _beginnings(word: str) -> list[str]:
    """A word's possible stems, and the word itself with an end mark."""
    return [word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1)] + [word + "$"]


@F.arrow_udf(_PAIRS)
def _candidates(texts: pa.Array) -> pa.Array:
    """Terms that a text may teach, each with the word before it."""
    terms, contexts, ends = [], [], [0]
    for text in texts:
        words = _WORD.findall(text.as_py().lower())
        pairs = {
            (t, before)
            for before, w in zip(["", *words], words, strict=False)
            for t in _beginnings(w)
        }
        terms += [t for t, _ in pairs]
        contexts += [c for _, c in pairs]
        ends.append(len(terms))
    columns = [pa.array(terms, pa.string()), pa.array(contexts, pa.string())]
    pairs = pa.StructArray.from_arrays(columns, ["term", "context"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)


def _own(labels: DataFrame) -> DataFrame:
    """The labels that may be learned from, one row an id."""
    own = labels.filter(
        "doc_id IS NOT NULL AND toxic IN (0, 1) AND crc32(CAST(doc_id AS STRING)) % 5 <> 0"
    ).groupBy("doc_id")
    return own.agg(F.max("toxic").alias("toxic"))


def _sample(docs: DataFrame, own: DataFrame) -> DataFrame:
    """Texts and labels of a bounded part of the rows that may be learned from."""
    parts = [
        own.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for y, most in ((1, POSITIVES), (0, NEGATIVES))
    ]
    chosen = F.broadcast(parts[0].union(parts[1]))  # POSITIVES + NEGATIVES rows at most
    return cut(docs.join(chosen, "doc_id").select("text", "toxic").repartition(SAMPLE_TASKS))


def _learn_terms(sample: DataFrame) -> list[Term]:
    """Terms whose different contexts are nearly all in toxic texts, beyond what chance gives.

    Contexts are counted, not texts: in copies of one text a word keeps its context, while a term
    of abuse has another wherever it stands.
    """
    pairs = sample.select("toxic", F.explode(_candidates("text")).alias("p"))
    counted = (
        pairs.groupBy("p.term", "p.context", "toxic")
        .agg(F.lit(1).alias("one"))
        .groupBy("term")
        .agg(
            F.sum(F.col("toxic")).cast("double").alias("ones"),
            F.sum(1 - F.col("toxic")).cast("double").alias("zeros"),
        )
    )
    counted = cut(counted)
    each = f"length(term) <= {SHORTEST}"  # one such term a word: its shortest stem, or all of it
    total = counted.agg(
        F.expr(f"sum(ones) FILTER (WHERE {each})"),
        F.expr(f"sum(zeros) FILTER (WHERE {each})"),
        F.count("*"),
    )
    ones, zeros, kinds = total.first()
    if not ones or not zeros:
        return []
    base, bar = ones / (ones + zeros), math.log(10 + kinds) + 3
    share = F.col("ones") / (F.col("ones") + F.col("zeros"))
    # The log-likelihood ratio of so large a share against the share of all words.
    excess = F.col("ones") * F.log(share / base) + F.col("zeros") * F.log(
        F.greatest(1 - share, F.lit(1e-9)) / (1 - base)
    )
    rows = (
        counted.filter((F.col("ones") >= 4) & (share >= 0.9) & (excess >= bar))
        .select("term", "ones")
        .collect()  # words of the sample, of which a toxic text has as many as it may hold
    )
    support = {r.term: r.ones for r in rows}
    longer = set()  # a stem gives way to a longer term that nearly all its contexts belong to
    for term, n in support.items():
        for at in range(SHORTEST, len(term)):
            if term[:at] in support and n >= 0.9 * support[term[:at]]:
                longer.add(term[:at])
    kept = sorted(set(support) - longer)
    stems = [t for t in kept if t[-1] != "$"]
    return [
        _loosest(t.rstrip("$"), t[-1] != "$")
        for t in kept
        if not any(t != s and t.startswith(s) for s in stems)
    ]


def _loosest(text: str, stem: bool) -> Term:
    edits = (len(text) >= SHORTEST) + (len(text) >= 9)
    return Term(text, stem, edits, edits > 0)


def _sampled_hits(sample: DataFrame, terms: list[Term]) -> list[tuple[int, list]]:
    schema = T.ArrayType(T.ArrayType(T.DoubleType()))

    @F.arrow_udf(schema)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(terms)
        for texts in batches:
            found = [[list(map(float, h)) for h in hits(reader, t.as_py())] for t in texts]
            yield pa.array(found, pa.list_(pa.list_(pa.float64())))
        del reader
        release()

    rows = sample.select("toxic", scan("text").alias("found")).collect()
    return [(r.toxic, [(int(k), int(e), c) for k, e, c in r.found]) for r in rows]


def _loose(rows: list[tuple[int, list]]) -> set[int]:
    """The terms whose misspellings occur in more than a few of the clean texts."""
    clean = max(1, sum(y == 0 for y, _ in rows))
    seen = Counter(k for y, found in rows if not y for k in {k for k, e, _ in found if e})
    return {k for k, n in seen.items() if n > 0.002 * clean}


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a small quadratic penalty, by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [0.05] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty @ w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> Model:
    """Terms and weights from labelled rows whose crc32(doc_id as text) mod 5 is not 0.

    At most ``POSITIVES`` and ``NEGATIVES`` rows are used. A term's misspellings, and those of its
    first letter, count only if they hardly occur in the sampled clean texts. Rows without label or
    id, and labels other than 0 and 1, are not learned from; repeated labels of an id count once, as toxic if any says so. With no
    toxic or no clean row the model has no terms and gives every text the same score.
    """
    texts = docs.select("doc_id", text_of(text_col).alias("text"))
    own = cut(_own(labels))
    sample = _sample(texts, own)
    terms = _learn_terms(sample)
    rows = _sampled_hits(sample, terms)
    loose = _loose(rows)
    if loose:  # fewer misspellings of these: the first letter as it is, or none
        fixed = [t._replace(first=False) for t in terms]
        still = _loose(_sampled_hits(sample, fixed))
        for k in loose:
            terms[k] = fixed[k]._replace(edits=0) if k in still else fixed[k]
        rows = _sampled_hits(sample, terms)
    y = np.array([y for y, _ in rows], float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model([], [6.0 * share - 3.0, *[0.0] * _N_FEATURES])
    x = np.array([features(f) for _, f in rows])
    there = {r.toxic: r["count"] for r in own.groupBy("toxic").count().collect()}  # two rows
    weight = np.where(y == 1, there[1] / y.sum(), there[0] / (1 - y).sum())
    return Model(terms, _fit(x, y, weight / weight.mean()).tolist())


def score(model: Model, text_col: str | Column = "text") -> Column:
    """The score of a text, 0 to 1, as a column. Reads the text alone; null counts as empty."""
    terms, weights = model

    @F.arrow_udf(T.DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(terms)
        for texts in batches:
            out = []
            for text in texts:
                found = features(hits(reader, text.as_py()))
                z = weights[0] + sum(a * b for a, b in zip(weights[1:], found, strict=True))
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pa.array(out, pa.float64())
        del reader
        release()

    return scored(text_of(text_col))

"""Misspellings of the first letter, of short terms and with signs, against plain edit distances."""

import random

from loadlens.llm import toxicity
from loadlens.llm.lexicon import LOOKALIKES, Lexicon, Term
from tests.llm.helpers import documents


def distance(term, word):
    row = list(range(len(term) + 1))
    for i, c in enumerate(word, 1):
        new = [i]
        for j, d in enumerate(term, 1):
            cost = 0 if c == d or LOOKALIKES.get(c) == d else 1
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + cost))
        row = new
    return row[len(term)]


def closest(terms, word):
    found = []
    for t in terms:
        ends = range(1, len(word) + 1) if t.stem else [len(word)]
        e = min((distance(t.text, word[:n]) for n in ends), default=99)
        found += [e] if e <= t.edits else []
    return min(found, default=None)


def test_first_letters_against_plain_edit_distance():
    rng = random.Random(7)
    terms = [Term("idiot", False, 1, True), Term("pathetic", False, 2, True), Term("idol", False, 0, True)]
    terms += [Term("scum", False, 1, True), Term("zargo", True, 1, True), Term("ababab", True, 2, True)]
    lexicon = Lexicon(terms)
    for _ in range(6000):
        word = list(rng.choice(terms).text + rng.choice(["", "", "s", "xyz"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.choice([0, rng.randrange(len(word) + 1)])
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "1", "b", "$", "*"])
        word = "".join(word)
        hit = lexicon.match(word)
        assert (hit[1] if hit else None) == closest(terms, word), word


def test_terms_that_keep_their_first_letter_beside_others():
    lexicon = Lexicon([Term("idiot", False, 1, False), Term("stupid", False, 1, True)])
    assert lexicon.match("sidiot") is None and lexicon.match("diot") is None
    assert lexicon.match("idiott") == (0, 1) and lexicon.match("ztupid") == (1, 1)


def test_signs_anywhere_in_a_word():
    reader = toxicity.Reader(
        [Term("stupid", False, 1, True), Term("idiot", False, 1, True), Term("ass", False, 0)]
    )

    def found(text):
        return [(k, e) for k, e, _ in toxicity.hits(reader, text)]

    assert found("so $tupid") == [(0, 0)] and found("an id*ot") == [(1, 1)]
    assert found("*idiot* @idiot idiot*stupid") == [(1, 0), (1, 0), (1, 0), (0, 0)]
    assert found("@s$ a$$") == [(2, 0), (2, 0)] and found("* " * 9 + "*" * 99) == []


def test_misspelled_documents_score_as_toxic(spark):
    rng = random.Random(3)
    syllables = ["ka", "lo", "mi", "ter", "son", "ver", "ung", "res", "pla", "dor"]
    docs, labels = [], []
    for i in range(900):
        text = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(40)]
        if i % 5 == 0:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["stupid", "scum", "git"]))
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    frame = documents(spark, docs)
    model = toxicity.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {t.text for t in model.terms} >= {"stupid", "scum", "git"}
    words = ["ztupid", "$tupid", "st*pid", "scuum", "skum", "git", "kalomi"]
    odd = documents(spark, [(i, f"lomi {w} terson") for i, w in enumerate(words)])
    score = dict(odd.select("doc_id", toxicity.score(model)).collect())
    assert [score[i] > 0.5 for i in range(7)] == [True] * 6 + [False]

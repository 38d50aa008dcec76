"""Lexicon search against edit distances, context scores, and held-out accuracy."""

import random
import zlib

from pyspark.sql import functions as F

from loadlens.llm import toxicity
from loadlens.llm.lexicon import LOOKALIKES, Lexicon, Term
from tests.llm.helpers import documents


def distance(term, word):
    """Edits from a term to a word; look-alikes are free, the first letter is fixed."""
    same = lambda a, b: a == b or LOOKALIKES.get(b) == a
    if not word or not same(term[0], word[0]):
        return 99
    row = list(range(len(term) + 1))
    row = [99, *range(len(term))]
    for i, c in enumerate(word[1:], 1):
        new = [99, i]
        for j in range(2, len(term) + 1):
            cost = 0 if same(term[j - 1], c) else 1
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + cost))
        row = new
    return row[len(term)]


def plain_match(terms, word):
    found = []
    for k, t in enumerate(terms):
        ends = range(1, len(word) + 1) if t.stem else [len(word)]
        e = min((distance(t.text, word[:n]) for n in ends), default=99)
        if e <= t.edits:
            found.append((e, k))
    return min(found)[::-1] if found else None


def test_automata_find_what_edit_distances_find():
    rng = random.Random(6)
    terms = [Term("idiot", False, 1), Term("idol", False, 0), Term("pathetic", False, 2)]
    terms += [Term("lowei", True, 1), Term("ab", False, 1), Term("abba", True, 2)]
    lexicon = Lexicon(terms)
    for _ in range(4000):
        word = list(rng.choice(terms).text + rng.choice(["", "", "s", "xyz"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "1", "b", "0", "e"])
        word = "".join(word)
        assert (lexicon.match(word) is None) == (plain_match(terms, word) is None), word
        if lexicon.match(word):
            assert lexicon.match(word)[1] == plain_match(terms, word)[1], word
    assert lexicon.match("1d10t") == (0, 0) and lexicon.match("") is None
    assert Lexicon([]).match("word") is None


def test_context_separates_quotation_from_abuse():
    def score(text, word="idiot"):
        at = text.index(word)
        return toxicity.context_score(text, at, at + len(word))

    abuse, plain = score("you are an idiot"), score("such an idiot here")
    reported, quoted = score("he called them an idiot"), score('he said "what an idiot" and left')
    assert quoted < reported < plain <= abuse
    assert score('"first line\nan idiot" here') == plain - 0.5  # over lines, not over paragraphs
    assert score('"first line\n \nan idiot" here') == plain
    long = "word" * 30
    assert score(f"quoted {long} {long} idiot") == score(f"idiot {long} {long} quoted") == reported
    assert score(f"misquoted {'x' * 75} idiot") == plain
    assert score("quoted a b c d e f idiot") == plain  # beyond six words
    assert score('a 5" pipe, an idiot, a 6" pipe') == plain  # no word begins after these marks


def corpus(n=1500):
    rng = random.Random(1)
    syllables = ["ka", "lo", "mi", "ter", "son", "ver", "ung", "res", "pla", "dor"]

    def words(k):
        return ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(k)]

    docs, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        text = words(rng.randint(20, 90))
        if toxic:
            for _ in range(3):
                bad = rng.choice(["idiot", "clown", "worthless", "zarg" + rng.choice(syllables)])
                text.insert(rng.randrange(len(text)), bad)
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    # A hundred copies of one toxic text teach none of its ordinary words.
    copy = " ".join(words(60)) + " idiot"
    docs += [(n + i, copy) for i in range(100)]
    labels += [(n + i, 1) for i in range(100)]
    return docs, labels, copy


def test_held_out_accuracy(spark):
    docs, labels, copy = corpus()
    frame = documents(spark, docs)
    known = spark.createDataFrame([*labels, (None, 1), (3, None), (5, 7)], "doc_id long, toxic int")
    model = toxicity.train(frame, known)
    terms = {t.text for t in model.terms}
    assert {"idiot", "clown", "worthless"} <= terms and any(t.startswith("zarg") for t in terms)
    assert not terms & set(copy.split()[:-1])
    scored = dict(frame.select("doc_id", toxicity.score(model)).collect())
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((scored[i] >= 0.5) == (y == 1) for i, y in held)
    assert len(held) > 200 and right >= 0.97 * len(held)
    odd = documents(spark, [(1, "w0rthles it is"), (2, None), (3, ""), (4, "idiot " * 50_000)])
    score = dict(odd.select("doc_id", toxicity.score(model)).collect())
    assert score[1] > 0.5 > score[2] == score[3] and 0.5 < score[4] <= 1


def test_labels_alone_are_learned_from(spark):
    """Rows of the held-out fifth, and columns other than the text, change nothing."""
    docs, labels, _ = corpus(300)
    frame = documents(spark, docs)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = known.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(frame, known) == toxicity.train(frame, turned)


def test_nothing_to_learn_from(spark):
    frame = documents(spark, [(1, "a"), (2, "b")])
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (empty, spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")):
        model = toxicity.train(frame, labels)
        assert [r[0] < 0.5 for r in frame.select(toxicity.score(model)).collect()] == [True, True]
    assert toxicity.train(frame.limit(0), empty).terms == []

"""Secret spans against the plain patterns, and the Markov models on strings they have not seen."""

import random
import re

import pyarrow as pa
import pytest

from loadlens.llm import secrets
from tests.llm.helpers import documents

KINDS = {
    "assign": (
        r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
        r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?"
        r"(?P<v>[A-Za-z0-9+/_.=-]+)"
    ),
    "access": r"(?P<v>AKIA[A-Z0-9]+)",
    "hex": r"(?P<v>[0-9a-f]+)",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}


def plain_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            if len(m["v"]) >= LEAST[kind]:
                out.append((m.start(), n, m.end()))
    return sorted(out)


def random_string(rng, n=32):
    return "".join(rng.choices(secrets.ALPHABET[:62], k=n))


def corpus():
    rng = random.Random(8)
    words = "the configuration identifiers internationalisation getElementById responsible".split()
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(words, k=40))
        if i % 3 == 0:
            text += f' api_key = "{random_string(rng)}" ' + "%040x" % rng.getrandbits(160)
        if i % 5 == 0:
            text = f"é💥 PassWord:{random_string(rng, 8)} AKIA{random_string(rng, 16).upper()} " + text
        rows.append((i, text))
    rows += [(400, None), (401, ""), (402, "token=abc secret: 'ab.cd-ef' ſecret=abcdefg toKen=abcdef")]
    rows += [(403, "a" * 100_000 + " f" * 10 + "0" * 30), (None, "AKIA" + "B" * 15), (3, "apikey=x" * 9)]
    return rows + [(404, "token = password = abcdefgh AKIAAKIA" + "C" * 14)]


@pytest.fixture(scope="module")
def model(spark):
    return secrets.train(documents(spark, corpus()))


def test_base_spans(spark, model):
    rows = corpus()
    df = documents(spark, rows)
    found = df.select("doc_id", "text", secrets.find_secrets(model).alias("s")).collect()
    assert len(found) == len(rows)
    for r in found:
        base = [(s.start, secrets.KINDS.index(s.kind), s.end) for s in r.s if s.kind != "random"]
        assert base == plain_spans(r.text)
        everything = [(s.start, secrets.KINDS.index(s.kind)) for s in r.s]
        assert everything == sorted(everything)


def test_the_models_tell_unseen_strings_apart(model):
    rng = random.Random(99)
    strings = [random_string(rng, 28) for _ in range(200)]
    assert sum(model.score(s) >= secrets.LEAST_RATIO for s in strings) >= 190
    ordinary = ["internationalconfiguration", "getInternationalElements", "responsibleidentifiers"]
    assert all(model.score(s) < secrets.LEAST_RATIO for s in ordinary)
    text = f"the {strings[0]} internationalconfiguration"
    assert secrets.all_spans(text, model) == [(4, 3, 32)]


def test_no_texts(spark):
    empty = documents(spark, corpus()).limit(0)
    model = secrets.train(empty)
    assert not model.ratio.any()
    assert empty.select(secrets.find_secrets(model)).collect() == []


def test_the_value_of_an_assignment_is_what_is_learned():
    text = "password: hunter2 PASSWD='abc123x' my token = x9.Yz-Q1_ is AKIA" + "B" * 16 + " internationalised"
    secret, rest = secrets.training_tokens(text)
    assert secret == ["hunter2", "abc123x", "x9.Yz-Q1_", "AKIA" + "B" * 16]
    assert rest == ["internationalised"]
    pairs = [b.to_pydict() for b in secrets._count([_batch("password=zzzzzz")])][0]
    z = secrets.ALPHABET.index("z") + 1
    assert {(a, b): n for a, b, n in zip(pairs["before"], pairs["after"], pairs["n"], strict=True)} == {
        (0, z): 1,
        (z, z): 5,
    }


def _batch(text):
    return pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])


def test_dashed_keys_are_judged_whole(model):
    rng = random.Random(4)
    key = "-".join(random_string(rng, 7) for _ in range(5))
    text = f"use {key} now, state-of-the-art.configuration"
    assert secrets.all_spans(text, model) == [(4, 3, 4 + len(key))]

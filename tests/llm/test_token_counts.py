"""Token counts against the library on whole texts."""

import random

from tokenizers import Tokenizer

from loadlens.llm import token_counts
from loadlens.llm.catalog import WORDS
from tests.llm.helpers import documents


def texts():
    rng = random.Random(4)
    letters = "abcdefgh  AÉé́ßİΣσ中文\xa0 \x1c\x85'st12½\n\r\t<|>_-💥"
    out = ["".join(rng.choices(letters, k=rng.randint(0, 200))) for _ in range(300)]
    out += ["", None, " ", "<|endoftext|>a <|startoftext|><|endoftext|>", "İSTANBUL ΑΣ ΑΣ.", "don't"]
    return out + ["word " * 5000, "x" * 20_000, " " * 3000]


def test_whole_texts(spark, monkeypatch):
    library = Tokenizer.from_file(WORDS)
    rows = list(enumerate(texts())) + [(None, "null id"), (1, "again"), (1, "again")]
    df = documents(spark, rows).select("doc_id", token_counts.token_counts(WORDS).alias("n"))
    want = [(i, len(library.encode(t or "", add_special_tokens=False))) for i, t in rows]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    assert df.limit(0).collect() == []


def test_small_batches_and_forgetting(monkeypatch):
    """Cuts, batches and the emptied memory do not change a count."""
    plain = [t or "" for t in texts()]
    want = token_counts.count_tokens(plain, token_counts.Lengths(WORDS))
    monkeypatch.setattr(token_counts, "TEXT_CHARS", 50)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 100)
    monkeypatch.setattr(token_counts, "MEMORY", 2000)
    monkeypatch.setattr(token_counts, "LONGEST", 5)
    known = token_counts.Lengths(WORDS)
    assert token_counts.count_tokens(plain, known) == want
    assert max(map(len, known)) <= 5 and known.size < 4000

"""Decontamination against a search for every window in every document."""

import random
import re

from loadlens.llm import decontaminate
from loadlens.llm.decontaminate import find_contamination
from tests.llm.helpers import documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return WORD.findall(lowered)


def expected(docs, items):
    out = []
    for i, text in docs:
        w, hit, names = words(text), set(), set()
        for name, item in items:
            v = words(item)
            k = min(10, len(v))
            for p in range(len(v) - k + 1) if v else []:
                for q in range(len(w) - k + 1):
                    if w[q : q + k] == v[p : p + k]:
                        hit |= set(range(q, q + k))
                        names.add(str(name if name is not None else ""))
        out.append((i, len(w), len(hit), sorted(names)))
    return sorted(out, key=str)


def found(df):
    got = df.select(
        "doc_id", "contamination.n_words", "contamination.n_hit", "contamination.items"
    )
    return sorted(map(tuple, got.collect()), key=str)


def corpus():
    rng = random.Random(1)
    vocabulary = ["a", "b", "é", "d9", "the", "x"]
    items = [(n, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12, 30])))) for n in range(30)]
    items = [i for i in items if len(i[1].split()) != 1 or i[1] == "d9"]
    items += [(99, None), (98, "?! ."), (None, "Nameless item"), (7, items[0][1]), (5, "d9")]
    docs = [(n, " ".join(rng.choices([*vocabulary, "zz", "d9."], k=60))) for n in range(15)]
    docs += [(50 + n, f"Zz, {i[1]}!" if i[1] else "") for n, i in enumerate(items)]
    docs += [(80, None), (81, ""), (82, "NAMELESS item nameless--ITEM"), (82, "again")]
    return docs, items


def test_windows(spark):
    docs, items = corpus()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = documents(spark, docs)
    want = expected(docs, items)
    assert found(find_contamination(frame, benchmark)) == want
    assert found(find_contamination(frame, benchmark, block_bytes=100)) == want  # many blocks


def test_spans_are_offsets_of_the_original(spark):
    benchmark = spark.createDataFrame([("q", "Two  words")], "item_id string, text string")
    text = "Éa – TWO, words; two\nwords two"
    row = find_contamination(documents(spark, [(1, text)]), benchmark).first().contamination
    assert [text[s.start : s.end] for s in row.spans] == ["TWO, words; two\nwords"]
    assert row.n_hit == 4 and row["items"] == ["q"]


def test_empty_tables_and_clashing_names(spark):
    benchmark = spark.createDataFrame([], "item_id string, text string")
    frame = documents(spark, [(1, "a b")])
    assert found(find_contamination(frame, benchmark)) == [(1, 2, 0, [])]
    assert find_contamination(frame.limit(0), benchmark).collect() == []
    again = find_contamination(find_contamination(frame, benchmark), benchmark)
    assert again.columns.count("contamination") == 1 and "key" in again.columns


def test_an_automaton_is_built_once_a_block(monkeypatch):
    built = []
    real = decontaminate.Automaton.__init__
    monkeypatch.setattr(decontaminate.Automaton, "__init__", lambda self, *a: built.append(1) or real(self, *a))
    blocks = [[("p", b"one two three")], [("q", b"three four"), ("r", b"nine")], [("s", b"absent")]]
    found = decontaminate.scanned([b"One two three four"] * 500 + [b"", b"nine nine"], blocks, 10)
    assert len(built) == 3
    assert found[0] == [4, [[0, 4]], {"p", "q"}] and found[500:] == [[0, [], set()], [2, [[0, 2]], {"r"}]]

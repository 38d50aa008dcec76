"""Whether a term is quoted, in long lines and with marks of several kinds."""

import time

from loadlens.llm import toxicity
from loadlens.llm.lexicon import Term

READER = toxicity.Reader([Term("idiot", False, 0)])
FAR = "word " * 200


def contexts(text):
    found = [c for _, _, c in toxicity.hits(READER, text)]
    at = text.index("idiot")
    assert found[0] == toxicity.context_score(text, at, at + 5)
    return found


def test_quotations_of_any_length():
    assert contexts(f'"{FAR} an idiot {FAR}" and more') == [0.5]
    assert contexts(f'"{FAR}" he is an idiot, "{FAR}" indeed') == [1.0]
    assert contexts(f'"{FAR}" is an idiot "{FAR}" idiot "idiot"') == [1.0, 1.0, 0.5]


def test_marks_are_paired():
    for text in ("“such an idiot”", "„such an idiot“", "„such an idiot”", "«such an idiot»", "»such an idiot«"):
        assert contexts(f"one {text} two") == [0.5], text
    assert contexts("“one” an idiot “two”") == [1.0]
    assert contexts("“one an idiot two") == [1.0]  # never closed
    assert contexts('“one "two" an idiot "three"') == [1.0]
    assert contexts("“one „two an idiot”") == [0.5]


def test_many_quoted_terms_in_one_line():
    began = time.time()
    assert contexts('"idiot" idiot ' * 20_000) == [0.5, 1.0] * 20_000
    assert time.time() - began < 20


def test_quotations_over_lines_end_with_their_paragraph():
    assert contexts('He said: "one\ntwo an idiot\nthree" idiot') == [0.25, 0.75]
    assert contexts(f'"{FAR}\n\n idiot {FAR}"') == [1.0]
    assert contexts(f"idiot\n\n{FAR}\n \t\nidiot “idiot” {FAR}\n\n") == [1.0, 1.0, 0.5]

"""Quotes of a part of a message, with lines that many messages of a thread hold."""

import random

from loadlens.llm.quotes import link_quotations


def parents(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    return {(r.thread, r.at): r.parent for r in link_quotations(df).collect()}


def test_the_message_with_most_lines(spark):
    rows = [(1, 1, "Hi\nA"), (1, 5, "Hi\nB\nmore"), (1, 7, "> Hi\n> B\nyes")]
    rows += [(2, 1, "Hi\nA\nBye"), (2, 2, "Hi\nB\nBye"), (2, 3, "> Hi\n> Bye"), (2, 4, "> Hi\n> B\n> x")]
    rows += [(3, i, f"Hi\nline {i}\nBye") for i in range(30)]
    rows += [(3, 40 + i, f"> Hi\n> line {i}\n> other {i}\n> Bye\nok") for i in range(30)]
    rows += [(3, 80 + i, "> Hi\n> gone\n> Bye\nok") for i in range(30)]
    found = parents(spark, rows)
    assert found[1, 7] == 5
    assert found[2, 3] == 1 and found[2, 4] == 2
    assert all(found[3, 40 + i] == i and found[3, 80 + i] == 0 for i in range(30))


def test_against_counting_by_hand(spark):
    rng = random.Random(5)
    words = ["Hi", "Bye", "a", "b", "c", "d", "e", "f"]
    weights = [9, 9, 4, 3, 2, 1, 1, 1]
    rows, want, own = [], {}, {}
    for thread in range(12):
        for turn in range(25):
            mine = list(dict.fromkeys(rng.choices(words, weights, k=rng.randint(1, 4))))
            quote = list(dict.fromkeys(rng.choices(words, weights, k=rng.randint(2, 5))))
            rows.append((thread, turn, "\n".join([f"> {x}" for x in quote] + mine)))
            own[thread, turn] = [x.lower() for x in mine]
            quote, best = [x.lower() for x in quote], (False, 0, 0)
            for at in range(turn):
                lines = own[thread, at]
                whole = lines == quote or (len(quote) == 1 and quote[0] in lines)
                n = 0 if whole else len(set(lines) & set(quote))
                if whole or n:
                    best = max(best, (whole, n, -at))
            want[thread, turn] = -best[2] if best[0] or best[1] else None
    assert parents(spark, rows) == want

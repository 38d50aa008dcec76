"""Conversations in reply order, and mail in which every row of the table is a message."""

from loadlens.llm import catalog, quotes


def test_replies_follow_what_they_reply_to(spark):
    rows = [
        (1, 0, "u", "First question"),
        (1, 1, "u", "Another matter"),
        (1, 2, "a", "> First question\nAn answer"),
        (1, 3, "a", "> Another matter\nIts answer"),
        (1, 4, "u", "> An answer\nThanks"),
        (1, 4, "u", "> An answer\nThanks"),
        (1, 5, "x", None),
        (None, 7, "u", "nowhere"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    linked = quotes.link_quotations(df, carry=["role"])
    found = quotes.conversations(linked, ["role", "text"]).collect()
    got = sorted(((r.thread, r.root, r.position, r.at, r.role, r.text) for r in found), key=str)
    assert got == sorted(
        [
            (1, 0, 1, 0, "u", "First question"),
            (1, 0, 2, 2, "a", "An answer"),
            (1, 0, 3, 4, "u", "Thanks"),
            (1, 0, 4, 4, "u", "Thanks"),
            (1, 1, 1, 1, "u", "Another matter"),
            (1, 1, 2, 3, "a", "Its answer"),
            (1, 5, 1, 5, "x", ""),
            (None, 7, 1, 7, "u", "nowhere"),
        ],
        key=str,
    )


def test_mail_keeps_every_row(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_TURNS", 4)
    rows = [(1, t, "u", f"m{t}") for t in (*range(-3, 11), 13)]
    rows += [(1, 5, "a", "m5 again"), (1, None, "u", "no turn"), (None, 3, "u", "no conversation"), (1, 5, "a", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = sorted((tuple(r) for r in catalog.mail_thread(df).collect()), key=str)
    want = []
    best = {t: max(x or "" for c, u, _, x in rows if c == 1 and u == t) for _, t, *_ in rows}
    for c, t, role, text in rows:
        known = c is not None and t is not None
        parts = [f"{m}{best[t - k]}" for k, m in ((2, "> > "), (1, "> ")) if known and best.get(t - k)]
        want.append((c, t, role, "\n".join([*parts, text or ""])))
    assert found == sorted(want, key=str)

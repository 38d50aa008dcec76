"""Quotation linking: nested quotes are parsed, linked to the messages they come from, and removed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.common import cut, is_empty, text_of
from loadlens.operators.sequence import dense_sequence

#: Characters before the text of a quoted line: one mark a level, a blank after each at most.
_MARKS = r"^(?:> ?)+"


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def level(line: Column) -> Column:
    """How many quotation marks a line begins with."""
    marks = F.regexp_extract(line, _MARKS, 0)
    return F.length(F.regexp_replace(marks, " ", ""))


def normal(text: Column) -> Column:
    """A-Z lowered, runs of white space as one blank, trimmed."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lowered, r"[ \t\n\x0B\f\r]+", " "))


def passages(text: Column) -> Column:
    """``level, text`` of every run of lines of one quotation level, marks removed, in order.

    One pass over the lines finds where the level changes, another cuts there, so a text of many
    lines costs no more per line than a short one.
    """

    def runs(lines: Column) -> Column:
        def cut_at(found: Column) -> Column:
            starts = F.filter(
                F.sequence(F.lit(0), F.size(lines) - 1),
                lambda i: (i == 0) | (F.get(found, i) != F.get(found, i - 1)),
            )

            def one(at: Column) -> Column:
                def run(start: Column, k: Column) -> Column:
                    end = F.coalesce(F.get(at, k + 1), F.size(lines))
                    rows = F.slice(lines, start + 1, end - start)
                    bare = F.transform(rows, lambda x: F.regexp_replace(x, _MARKS, ""))
                    return F.struct(
                        F.get(found, start).alias("level"), F.array_join(bare, "\n").alias("text")
                    )

                return F.transform(at, run)

            return _let(starts, one)

        return _let(F.transform(lines, level), cut_at)

    return _let(F.split(text, "\r?\n"), runs)


def quote(text: Column, depth: int = 1) -> Column:
    """The text as a quotation: every line with ``depth`` marks."""
    marks = "> " * depth
    return F.concat(F.lit(marks), F.regexp_replace(text, "\n", "\n" + marks))


def link_quotations(
    messages: DataFrame,
    thread: str = "conv_id",
    order: str = "turn",
    text_col: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per message with its reply structure and its text without quotes.

    ``thread, at, text`` (own lines, trimmed), ``n_quotes``, ``n_linked``, ``parent`` (order of
    the message replied to), ``root`` and ``depth``, and the columns ``carry``. ``conversations`` puts
    them in reply order.

    The text is cut into passages of one quotation level. The normalised own text of a message, and
    each of its lines, is hashed (SHA-256). A quoted passage is linked to the earliest earlier
    message that has it as a whole, by an index of one row a thread and hash, or else to the one
    that has most of its lines, the earliest of equals (``_partial``). The parent is that of
    the first linked passage of the lowest level. Chains of parents are followed by pointer
    doubling. A thread or a message with many replies is a key of many small rows on one side of a
    join only, which adaptive execution splits.

    Messages are told apart by thread and order, both not null; rows without them are replies to
    nothing and nothing links to them. Repeated rows stay and count once in the index. Null and
    empty texts have neither passages nor lines. A quote that no earlier message holds is removed
    from the text all the same, and not counted in ``n_linked``. An empty table gives no rows.
    Other columns are not read.
    """
    base = messages.select(
        F.col(thread).alias("thread"),
        F.col(order).alias("at"),
        passages(text_of(text_col)).alias("passages"),
        *[F.col(c).alias(f"_{c}") for c in carry],
    )
    own = F.filter("passages", lambda p: p["level"] == 0)
    own_text = F.trim(F.array_join(F.transform(own, lambda p: p["text"]), "\n"))
    split = cut(
        base.select(
            "thread",
            "at",
            F.regexp_replace(own_text, r"^[\s]+|[\s]+$", "").alias("text"),
            F.filter("passages", lambda p: p["level"] > 0).alias("quotes"),
            *[f"_{c}" for c in carry],
        )
    )

    def units(text: Column) -> Column:
        """The passage as a whole and its lines, normalised, empty ones left out."""
        every = F.concat(F.array(text), F.split(text, "\n"))
        return F.array_distinct(F.filter(F.transform(every, normal), lambda x: x != ""))

    held = (
        split.filter("thread IS NOT NULL AND at IS NOT NULL")
        .select("thread", "at", F.explode(units(F.col("text"))).alias("unit"))
        .select("thread", F.unhex(F.sha2("unit", 256)).alias("hash"), F.col("at").alias("source"))
    )
    index = held.groupBy("thread", "hash").agg(F.min("source").alias("source"))
    quoted = split.select("thread", "at", F.posexplode("quotes").alias("nth", "quote"))
    quoted = quoted.select(
        "thread",
        "at",
        "nth",
        F.col("quote.level").alias("level"),
        F.unhex(F.sha2(normal(F.col("quote.text")), 256)).alias("hash"),
        F.transform(
            units(F.col("quote.text")), lambda x: F.unhex(F.sha2(x, 256))
        ).alias("units"),
    ).filter("size(units) > 0").distinct()  # of repeated rows; only hashes move
    whole = quoted.join(index, ["thread", "hash"], "left").withColumn(
        "to", F.when(F.col("source") < F.col("at"), F.col("source"))
    )
    whole = cut(whole.drop("source"))
    linked = whole.filter("to IS NOT NULL").select("thread", "at", "nth", "level", "to")
    rest = whole.filter("to IS NULL AND thread IS NOT NULL AND at IS NOT NULL AND size(units) > 1")
    if not is_empty(rest):
        linked = linked.unionByName(_partial(rest, held.distinct()))
    parents = cut(
        linked.groupBy("thread", "at").agg(
            F.count("*").alias("n_linked"),
            F.min_by("to", F.struct("level", "nth")).alias("parent"),
        )
    )
    chains = _follow(parents.select("thread", "at", "parent"))
    replies = parents.join(chains, ["thread", "at"], "left")  # narrow, so the texts move once
    return (
        split.join(replies, ["thread", "at"], "left")
        .select(
            "thread",
            "at",
            "text",
            F.size("quotes").cast("long").alias("n_quotes"),
            F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
            "parent",
            F.coalesce("root", "at").alias("root"),
            F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
            *[F.col(f"_{c}").alias(c) for c in carry],
        )
    )


def conversations(linked: DataFrame, order: Sequence[str] = ("text",)) -> DataFrame:
    """The messages of ``link_quotations`` as conversations: ``position`` numbers, from 1 on, those of
    each thread and root in reply order.

    A message only replies to an earlier one, so by ``at`` every reply comes after what it replies
    to. Messages of equal place follow ``order``. Numbers come from a range sort, so a conversation
    with most of the messages is spread over the tasks. Messages that nobody quotes and that quote
    nobody are conversations of their own.
    """
    return dense_sequence(linked, ["at", *order], by=["thread", "root"], name="position")


def _partial(rest: DataFrame, held: DataFrame) -> DataFrame:
    """``thread, at, nth, level, to`` of passages that no earlier message has as a whole.

    Every message that holds a line counts as a holder. Equal passages of a thread are counted once,
    against all holders; a passage then takes the best one before it. So that a greeting held by a
    whole thread is not paired with every passage that begins with it, holders are looked up in
    two rounds: those of the rarest line give a count that is reached, and any message that reaches
    it has one of as many of the rarest lines as leave too few others. Only messages found so are
    counted in full. A line is left out of the look-up if it alone decides nothing: a message of one
    common line is seen by the earliest holder of any line. Only passages whose lines are all
    frequent meet long lists, and there are few different ones.
    """
    lines = F.array_sort(F.array_except("units", F.array("hash")))
    rest = rest.withColumn("key", F.sha2(F.array_join(F.transform(lines, F.hex), ","), 256))
    each = rest.groupBy("thread", "key").agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.first(lines).alias("lines")
    )
    each = each.select("thread", "key", "first", "last", F.explode("lines").alias("hash"))
    counts = held.join(each.select("thread", "hash").distinct(), ["thread", "hash"], "left_semi")
    counts = counts.groupBy("thread", "hash").agg(
        F.count("*").alias("holders"), F.min("source").alias("earliest")
    )
    of_passage = Window.partitionBy("thread", "key")
    ranked = cut(
        each.join(counts, ["thread", "hash"])
        .withColumn("rank", F.row_number().over(of_passage.orderBy("holders", "hash")))
        .withColumn("n", F.count("*").over(of_passage))
    )

    def counted(looked_up: DataFrame) -> DataFrame:
        """``thread, key, source, lines``, all lines counted, of the holders of some."""
        found = looked_up.join(held, ["thread", "hash"]).filter("source < last")
        found = found.select("thread", "key", "source", "first").distinct()
        every = found.join(ranked.select("thread", "key", "hash"), ["thread", "key"])
        return (
            every.join(held, ["thread", "hash", "source"])
            .groupBy("thread", "key", "source", "first")
            .agg(F.count("*").alias("lines"))
        )

    reached = counted(ranked.filter("rank = 1")).filter("source < first")
    reached = reached.groupBy("thread", "key").agg(F.max("lines").alias("reached"))
    needed = F.greatest(F.coalesce("reached", F.lit(1)), F.lit(2))
    looked_up = ranked.join(reached, ["thread", "key"], "left").filter(
        F.col("rank") <= F.greatest(F.col("n") - needed + 1, F.lit(1))
    )
    alone = ranked.select("thread", "key", F.col("earliest").alias("source"), F.lit(1).alias("lines"))
    # Of each number of lines the earliest message is enough, whichever message quotes.
    steps = (
        counted(looked_up)
        .select("thread", "key", "source", "lines")
        .unionByName(alone)
        .groupBy("thread", "key", "lines")
        .agg(F.min("source").alias("source"))
    )
    best = F.struct(F.col("lines"), (-F.col("source")).alias("early"))
    return (
        rest.select("thread", "at", "nth", "level", "key")
        .join(steps, ["thread", "key"])
        .filter("source < at")
        .groupBy("thread", "at", "nth", "level")
        .agg(F.max_by("source", best).alias("to"))
    )


def _follow(parents: DataFrame) -> DataFrame:
    """``thread, at, root, depth`` from ``thread, at, parent``, by doubling the reach a round."""
    reach = parents.select(
        "thread", "at", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")
    )
    while True:
        reach = cut(reach)
        on = reach.select(
            "thread", F.col("at").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more")
        )
        joined = reach.join(on, ["thread", "root"], "left")
        if not joined.filter("next IS NOT NULL").take(1):
            return reach
        reach = joined.select(
            "thread",
            "at",
            F.coalesce("next", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
        )

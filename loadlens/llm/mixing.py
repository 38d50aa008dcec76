"""Mixing sources to target weights: word capacity of membership patterns routed to source quotas."""

from __future__ import annotations

from collections import deque
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.joins import attach_groups, row_bytes
from loadlens.llm.common import cut, is_empty, text_of
from loadlens.llm.components import connected_components
from loadlens.operators.sequence import dense_sequence

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: No document is taken more often than this.
MOST = 3
#: A document's place in the order of its pattern is a number of so many bits, cut in cells of
#: these bits from above; what is left below the last cell is sorted whole.
_BITS, _CELLS = 60, (48, 36)


class Mix(NamedTuple):
    #: ``doc_id, sources, size, taken, shares``; shares are (source, copies).
    documents: DataFrame
    #: ``source, source_size, weight, target, quota``.
    sources: DataFrame


def route(capacity: list[int], members: list[list[int]], quota: dict[int, int], most: int) -> dict:
    """A cheapest flow from patterns to sources that fills the quotas as far as it can.

    The k-th copy of a word costs k - 1, so the costs of repetition are convex: one arc of the
    pattern's capacity for each copy. All costs lie on these first arcs, hence a shortest path costs
    what its first arc costs, and successive shortest paths are maximal flows with one more copy
    allowed each time; flow already sent is kept and may be sent to other sources. Returns the words
    of each (pattern, source).
    """
    sent: dict[tuple[int, int], int] = {(p, s): 0 for p, of in enumerate(members) for s in of}
    holders: dict[int, list[int]] = {}
    for p, s in sent:
        holders.setdefault(s, []).append(p)
    wanting, spare = dict(quota), [0] * len(capacity)
    for _copy in range(most):
        spare = [a + b for a, b in zip(spare, capacity, strict=True)]
        while _augment(spare, members, holders, wanting, sent):
            pass
    return sent


def _augment(spare, members, holders, wanting, sent) -> bool:
    """One phase of Dinic: layers of patterns and sources, then paths that follow them."""
    level = {("p", p): 0 for p, left in enumerate(spare) if left}
    todo, reached = deque(level), False
    while todo:
        kind, x = node = todo.popleft()
        after = [("s", s) for s in members[x]] if kind == "p" else [
            ("p", p) for p in holders[x] if sent[p, x]
        ]
        reached |= kind == "s" and wanting[x] > 0
        for other in after:
            if other not in level:
                level[other] = level[node] + 1
                todo.append(other)
    if not reached:
        return False
    arcs = {
        n: [
            o
            for o in ([("s", s) for s in members[n[1]]] if n[0] == "p" else [("p", p) for p in holders[n[1]]])
            if level.get(o) == depth + 1
        ]
        for n, depth in level.items()
    }
    for p in range(len(spare)):
        while spare[p]:
            path = [("p", p)]
            while path and not (path[-1][0] == "s" and wanting[path[-1][1]]):
                here = path[-1]
                while arcs[here] and here[0] == "s" and not sent[arcs[here][-1][1], here[1]]:
                    arcs[here].pop()
                if arcs[here]:
                    path.append(arcs[here][-1])
                else:
                    path.pop()
                    if path:
                        arcs[path[-1]].pop()
            if not path:
                break
            steps = list(zip(path, path[1:], strict=False))
            amount = min(
                [spare[p], wanting[path[-1][1]]]
                + [sent[b[1], a[1]] for a, b in steps if a[0] == "s"]
            )
            for a, b in steps:
                if a[0] == "p":
                    sent[a[1], b[1]] += amount
                else:
                    sent[b[1], a[1]] -= amount
            spare[p] -= amount
            wanting[path[-1][1]] -= amount
    return True


def word_count(text: Column) -> Column:
    """Runs of anything but blanks, tabs and line ends."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def place_of(seed: int, doc_id: Column, text: Column) -> Column:
    """A number of ``_BITS`` bits; equal for rows of equal id and text only."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text)
    return F.conv(F.substring(F.md5(key), 1, _BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, total: int, most: int = MOST) -> DataFrame:
    """``target`` and ``quota`` for ``source_size, weight``: ``total`` shared by weight, full sources apart.

    A source is full at ``most`` times its size. Each round shares what the full ones leave among
    the others; it is Newton's method on a piecewise linear function, so few rounds are needed,
    each one aggregate of which two numbers reach the driver. All in whole numbers.
    """
    full = F.lit(False)
    seen = -1
    while True:
        n, capped, weights = sources.agg(
            F.count_if(full),
            F.coalesce(F.sum(F.when(full, most * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        left = total - capped
        if n == seen:
            break
        seen = n
        exact = "decimal(38,0)"
        full = (most * F.col("source_size")).cast(exact) * F.lit(weights).cast("decimal(18,0)") <= (
            F.col("weight").cast("decimal(18,0)") * F.lit(left).cast("decimal(20,0)")
        ).cast(exact)
    shared = (F.col("weight") * F.lit(left)).cast("double") / F.lit(max(1, weights)).cast("double")
    target = F.when(full, (most * F.col("source_size")).cast("double")).otherwise(shared)
    return sources.withColumn("target", target).withColumn(
        "quota", F.floor(F.col("target") + 0.5).cast("long")
    )


def _flows(patterns: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """``pattern, rank, source, words``: what each pattern gives to each of its sources.

    Sources that share no document do not concern each other, so every component of sources is
    routed by itself; a task sees the patterns of one component, never documents.
    """
    size = _bytes(sources)
    member = patterns.select("pattern", "size", F.explode("sources").alias("source"))
    member = attach_groups(member, sources.select("source", "rank", "quota"), ["source"], size=size)
    member = cut(member)
    neighbours = Window.partitionBy("pattern").orderBy("rank")
    links = member.select(F.col("rank").alias("a"), F.lead("rank").over(neighbours).alias("b"))
    found = connected_components(links.filter("b IS NOT NULL"))
    routed = member.join(found.withColumnRenamed("node", "rank"), "rank", "left").withColumn(
        "component", F.coalesce("root", "rank")
    )

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pattern", "rank"])
        sets = rows.groupby("pattern")["rank"].agg(tuple).sort_values()
        ids = {p: k for k, p in enumerate(sets.index)}
        capacity, members = [0] * len(ids), [[] for _ in ids]
        for p, size, rank in zip(rows.pattern, rows["size"], rows["rank"], strict=True):
            capacity[ids[p]] = int(size)
            members[ids[p]].append(int(rank))
        quota = {int(r): int(q) for r, q in zip(rows["rank"], rows.quota, strict=True)}
        sent = route(capacity, members, quota, most)
        rows["words"] = [sent[ids[p], int(r)] for p, r in zip(rows.pattern, rows["rank"], strict=True)]
        return rows[["pattern", "rank", "size", "words"]]

    numbers = routed.select("component", "pattern", "rank", "size", "quota")
    made = numbers.groupBy("component").applyInPandas(
        solve, "pattern long, rank long, size long, words long"
    )
    return attach_groups(made, sources.select("rank", "source"), ["rank"], size=size)


def _bytes(kept: DataFrame) -> int:
    return kept.agg(F.sum(row_bytes(kept))).first()[0] or 0


def _boundaries(placed: DataFrame, ends: DataFrame) -> DataFrame:
    """For every end ``pattern, rank, rest`` the key at which the sizes in key order reach ``rest``.

    Sizes are added up in cells of the keys, then in cells of the one cell that matters, then by
    key; each window holds at most 2**12 cells, or the distinct keys of one cell of 2**24. Adds
    ``key, ties, of``: how many of the ``of`` equal rows under the key are taken.
    """
    size = _bytes(ends)  # three numbers an end, of which two are attached to the rows
    now = ends.withColumn("prefix", F.lit(0).cast("long")).withColumn("before", F.lit(0).cast("long"))
    above = _BITS
    order = Window.partitionBy("pattern", "rank").orderBy("cell")
    for shift in (*_CELLS, 0):
        wanted = now.select("pattern", "prefix").distinct()
        rows = placed.select("pattern", "key", "size", F.shiftright("key", above).alias("prefix"))
        rows = attach_groups(rows, wanted, ["pattern", "prefix"], size=size)
        cells = rows.groupBy("pattern", "prefix", F.shiftright("key", shift).alias("cell")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("of")
        )
        summed = now.drop("words", "of").join(cells, ["pattern", "prefix"]).withColumn("upto", F.sum("words").over(order))
        start = F.col("before") + F.col("upto") - F.col("words")
        now = cut(
            summed.filter((start < F.col("rest")) & (F.col("before") + F.col("upto") >= F.col("rest")))
            .select("pattern", "rank", "rest", F.col("cell").alias("prefix"), start.alias("before"), "words", "of")
        )
        above = shift
    # Of equal rows, those are taken whose middle lies below the end.
    each = F.col("words") / F.col("of")
    ties = F.ceil((F.col("rest") - F.col("before") - each / 2) / each)
    return now.select(
        "pattern", "rank", F.col("prefix").alias("key"), "of",
        F.least(F.greatest(ties, F.lit(0)), F.col("of")).cast("long").alias("ties"),
    )


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 0,
) -> Mix:
    """How often each document enters a mix in which the sources have their target shares of words.

    ``source_col`` is a text, or an array of texts for documents of several sources. Sources in code
    point order, null last, take the weights in turn; together they want as many words as all
    documents have, none more than ``most`` times its own (see ``targets``). Documents are
    aggregated by the set of sources they belong to; a min-cost flow routes the words of these
    patterns, at most ``most`` copies each at rising cost, to the quotas (see ``route``). A pattern's
    words are its documents in the order of a seeded hash, laid end to end once for every copy, and
    its sources take them one after the other; a document belongs to the source its middle lies
    in, so every end is met within half a document.

    No documents are ordered or gathered: the ends are found by adding up cells of the hash (see
    ``_boundaries``). Only rows equal in id and text that an end falls between are numbered.
    Patterns, sources and ends may be tables of any size.

    Null and empty texts have size 0 and are taken 0 times or more, 0 words in all. An empty or null
    array counts as the null source, as a null text does. Repeated rows count each by itself, and of
    equal rows some may be taken once more than others. Null ids are allowed. An empty table gives
    no rows. Other columns are not read. The same rows give the same result, however they are split.
    """
    kinds = dict(docs.dtypes)
    listed = F.col(source_col) if kinds[source_col].startswith("array") else F.array(source_col)
    members = F.array_sort(F.array_distinct(listed))
    text = text_of(text_col)
    base = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.when(F.size(members) > 0, members).otherwise(F.array(F.lit(None).cast("string"))).alias("sources"),
            word_count(text).alias("size"),
            place_of(seed, F.col(id_col), text).alias("key"),
        )
    )
    patterns = base.groupBy("sources").agg(F.sum("size").alias("size"))
    patterns = cut(patterns.withColumn("pattern", F.monotonically_increasing_id()))
    total, size = patterns.agg(F.sum("size"), F.sum(row_bytes(patterns))).first()
    total, size = total or 0, size or 0
    sizes = patterns.select(F.explode("sources").alias("source"), "size").groupBy("source")
    sizes = sizes.agg(F.sum("size").alias("source_size"))
    ranked = dense_sequence(sizes.withColumn("none", F.col("source").isNull()), ["none", "source"], name="rank")
    turn = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    sources = cut(targets(cut(ranked.withColumn("weight", turn.cast("long"))), total, most))

    running = Window.partitionBy("pattern").orderBy("rank")
    ends = _flows(patterns, sources, most).withColumn("end", F.sum("words").over(running))
    ends = cut(
        ends.filter("size > 0").select(
            "pattern", "rank", "source", F.expr("end div size").alias("passes"), F.expr("end % size").alias("rest")
        )
    )
    placed = attach_groups(base, patterns.select("sources", "pattern"), ["sources"], size=size)
    found = cut(_boundaries(placed, cut(ends.filter("rest > 0").select("pattern", "rank", "rest"))))
    ends = ends.join(found, ["pattern", "rank"], "left").groupBy("pattern").agg(
        F.sort_array(
            F.collect_list(
                F.struct("rank", "source", "passes", F.coalesce("key", F.lit(-1)).alias("key"), "ties")
            )
        ).alias("ends")
    )
    ends = cut(patterns.select("pattern").join(ends, "pattern", "left"))
    torn = cut(found.filter("ties > 0 AND ties < of").select("pattern", "key").distinct())
    numbered = placed.withColumn("tie", F.lit(0).cast("long"))
    if not is_empty(torn):
        same = [placed.pattern == torn.pattern, placed.key == torn.key]
        tied = placed.join(torn, same, "left_semi")
        rest = placed.join(torn, same, "left_anti").withColumn("tie", F.lit(0).cast("long"))
        numbered = rest.unionByName(
            dense_sequence(tied, ["doc_id", "size"], by=["pattern", "key"], start=0, name="tie")
        )
    marked = attach_groups(numbered, ends, ["pattern"], kept=True)

    def before(e: Column) -> Column:
        inside = (F.col("key") < e["key"]) | ((F.col("key") == e["key"]) & (F.col("tie") < e["ties"]))
        return e["passes"] + inside.cast("long")

    marked = marked.withColumn("ups", F.coalesce(F.transform("ends", before), F.array().cast("array<bigint>")))
    shares = F.transform(
        F.coalesce("ends", F.array().cast(marked.schema["ends"].dataType)),
        lambda e, i: F.struct(
            e["source"].alias("source"),
            (F.get("ups", i) - F.coalesce(F.get("ups", i - 1), F.lit(0))).alias("copies"),
        ),
    )
    taken = F.col("size") * F.coalesce(F.element_at(F.col("ups"), -1), F.lit(0))
    documents = marked.select(
        "doc_id", "sources", "size",
        F.when(F.size("ups") > 0, taken).otherwise(F.lit(0)).cast("long").alias("taken"),
        shares.alias("shares"),
    )
    return Mix(documents, sources.select("source", "source_size", "weight", "target", "quota"))

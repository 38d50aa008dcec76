"""Near-duplicates by SimHash fingerprints and a multi-index of small Hamming balls."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm.common import cut, release, text_of
from loadlens.llm.components import connected_components, packed

SEED = 42
#: Shingles counted at a time; bounds a task's memory on very long texts.
BLOCK = 1 << 15
#: Fingerprints under one value of the index; of more, the value is split.
HOT = 64


def fingerprint(text: str | bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text: a bit is 1 if it is set in over half the shingles' hashes."""
    raw = text.encode() if isinstance(text, str) else text
    words = raw.lower().split()  # on bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        spans = zip(starts[at : at + BLOCK], stops[at : at + BLOCK], strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    @F.arrow_udf(T.LongType())
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprint(x.as_buffer().to_pybytes(), shingle) for x in texts]
            yield pa.array(np.array(found, np.uint64).view(np.int64))
        release()

    return signed


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = 3,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) and ``carry`` for every row. One scan, no shuffle."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        _fingerprints(shingle)(text_of(text_col)).alias("fp"),
        *[c.alias(n) for n, c in (carry or {}).items()],
    )


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bits(mask: int) -> list[int]:
    return [b for b in range(64) if mask >> b & 1]


def _split(rest: list[int], parts: int) -> list[list[int]]:
    cuts = [len(rest) * k // parts for k in range(parts + 1)]
    return [rest[i:j] for i, j in zip(cuts, cuts[1:], strict=False) if i < j]


def _probes(mask: int, parts: list[list[int]], distance: int) -> list[tuple]:
    """For each part of the bits beyond ``mask``: the mask with it, and the balls within the part.

    Rows are (mask, mask with the part, parts, flipped bits, how many, the highest of them).
    """
    out = []
    for part in parts:
        sub = mask | sum(1 << b for b in part)
        for cost in range(distance // len(parts) + 1):
            for bits in combinations(part, cost):
                flip, high = sum(1 << b for b in bits), 1 << bits[-1] if bits else 0
                out.append((*map(_signed, (mask, sub)), len(parts), _signed(flip), cost, _signed(high)))
    return out


_PROBES = "mask long, sub long, parts int, flip long, cost int, high long"


def ball_links(
    points: DataFrame, *, segments: int = 2, distance: int = 2, hot: int = HOT
) -> DataFrame:
    """Links ``a, b`` of all fingerprints of ``points(fp)``, each there once, at ``distance`` or fewer bits.

    Multi-index hashing: the 64 bits are cut into ``segments``, and an index has every fingerprint
    under the value of each of its segments. Two fingerprints within the distance differ in one
    segment by ``distance // segments`` bits at most, so a fingerprint looks up all values in the ball
    of that radius around its own, segment by segment, and of what it finds there the complete
    distance is verified. Of two fingerprints that differ in the segment, the one with 0 in the
    highest bit of difference looks up, so each pair is met from one side in a segment.

    A value that more than ``hot`` fingerprints have, as those of many near copies, is split by the
    other segments: the bits that are not yet fixed are cut in two, its fingerprints are put into
    the index under the value so far and that of either half, and those that look it up go
    on with the bits they have left to differ in, in the ball of half that radius around each half.
    At the latest when all bits are fixed, no value is hot. So a fingerprint meets at most ``hot``
    others a look-up, however many share a segment, and none within the distance is missed.
    """
    spark = points.sparkSession
    known = cut(points.select("fp", F.lit(0).cast("long").alias("mask")))
    asking = known.select(
        "fp", "mask", F.col("fp").alias("pattern"), F.lit(0).alias("spent")
    )
    masks = {0: _split(list(range(64)), segments)}
    links = []
    while masks:
        rows = [r for mask, parts in masks.items() for r in _probes(mask, parts, distance)]
        steps = F.broadcast(spark.createDataFrame(rows, _PROBES))  # of the bits alone, not of the data
        subs = F.broadcast(spark.createDataFrame(sorted({r[:2] for r in rows}), "mask long, sub long"))
        known = known.join(subs, "mask").select(
            "fp", F.col("sub").alias("mask"), F.col("fp").bitwiseAND(F.col("sub")).alias("value")
        )
        from_here = (F.col("spent") > 0) | (F.col("fp").bitwiseAND(F.col("high")) == 0)
        asking = (
            asking.join(steps, "mask")
            .filter(F.expr(f"cost <= ({distance} - spent) div parts") & from_here)
            .withColumn("pattern", F.col("pattern").bitwiseXOR(F.col("flip")))
            .select(
                "fp",
                F.col("sub").alias("mask"),
                "pattern",
                (F.col("spent") + F.col("cost")).alias("spent"),
                F.col("pattern").bitwiseAND(F.col("sub")).alias("value"),
            )
        )
        known = cut(known.distinct() if links else known)  # two ways may lead to the same bits
        full = cut(known.groupBy("mask", "value").agg(F.count("*").alias("n")).filter(F.col("n") > hot))
        busy = [r.mask for r in full.select("mask").distinct().collect()]  # of the masks above
        cold, warm = known, None
        if busy:
            cold = known.join(full, ["mask", "value"], "left_anti")
            warm = known.join(full, ["mask", "value"], "left_semi")
            asking = cut(asking)
        met = asking.join(cold.withColumnRenamed("fp", "b"), ["mask", "value"])
        once = (F.col("spent") > 0) | (F.col("fp") < F.col("b"))
        within = F.expr(f"bit_count(fp ^ b) <= {distance}") & (F.col("fp") != F.col("b"))
        ends = [F.least("fp", "b").alias("a"), F.greatest("fp", "b").alias("b")]
        links.append(met.filter(once & within).select(*ends))
        if busy:
            known = warm.select("fp", "mask")
            asking = asking.join(full, ["mask", "value"], "left_semi").drop("value")
        unsigned = [m & (1 << 64) - 1 for m in busy]
        masks = {m: _split(_bits(~m & (1 << 64) - 1), 2) for m in unsigned}
    return reduce(DataFrame.unionByName, links).distinct()


def simhash_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = 3,
    distance: int = 2,
    segments: int = 2,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row; fingerprints at 2 or fewer bits link.

    ``component_id`` is the smallest id that can be reached over links, the row's own included; as
    ids may repeat, ``root`` tells components apart (a fingerprint of the component). The columns
    ``carry`` follow. Texts are cut at ASCII white space and lowered in A-Z only; a text of fewer words
    than a shingle is one shingle. Empty, null and blank texts have fingerprint zero and link as any
    other. Null ids are never chosen as ``component_id`` unless a component has no other. Repeated
    rows give repeated rows. An empty table gives no rows. Other columns are not read.

    Equal fingerprints are one point, so a group of exact copies never meets itself.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle=shingle, carry=carry))
    points = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = points.select("fp").repartition(tasks, "fp")  # each becomes some thirty rows
    roots = connected_components(ball_links(spread, segments=segments, distance=distance))
    linked, _ = packed(points.join(roots, F.col("fp") == F.col("node")).select("fp", "least", "root"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id")
    named = points.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")
    )
    return prints.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "root",
        *(carry or {}),
    )

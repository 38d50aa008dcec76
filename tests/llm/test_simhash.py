"""SimHash fingerprints and their components against plain Python over all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from loadlens.llm.components import connected_components
from loadlens.llm.simhash import ball_links, fingerprint, simhash_dedup
from tests.llm.helpers import documents


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(values):
    """value -> smallest index reachable over pairs at two or fewer bits."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def test_fingerprint():
    for text in ["", " \n", "One", "one TWO", "a b c", "a b c d e \x1cf É é", "x " * 40_000]:
        assert fingerprint(text) == plain_fingerprint(text)


def test_components_of_near_fingerprints(spark):
    rng = random.Random(5)
    values = []
    for _ in range(40):
        at = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):  # a walk of one to three bits a step
            values.append(at)
            for _ in range(rng.randint(1, 3)):
                at ^= 1 << rng.randrange(64)
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values} | {0, -(1 << 63), 1})
    points = spark.createDataFrame([(v,) for v in values], "fp long")
    for segments in (1, 2, 3, 4):
        links = ball_links(points, segments=segments)
        found = {r.node: r.root for r in connected_components(links).collect()}
        want = plain_components([v & (1 << 64) - 1 for v in values])
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                assert (want[i] == want[j]) == (found.get(a, a) == found.get(b, b))


def test_long_chain(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert connected_components(links).select("root").distinct().count() == 1
    assert connected_components(links.limit(0)).count() == 0


def test_documents(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(90)) for _ in range(150))]
    base += [base[0] + " end", base[0].upper(), base[0].replace("1", "2", 1)]
    rows = list(enumerate(base + ["", None, " \t", "word", "word word", "Word", "é" * 200_000]))
    rows += [(3, base[0]), (None, "word"), (50, "x y " * 50_000)]
    values = [plain_fingerprint(t) for _, t in rows]
    classes = plain_components(values)
    want = []
    for (i, _), value, c in zip(rows, values, classes, strict=True):
        ids = [r[0] for r, k in zip(rows, classes, strict=True) if k == c and r[0] is not None]
        want.append((i, f"{value:016x}", min(ids, default=None)))
    found = simhash_dedup(documents(spark, rows)).drop("root")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert simhash_dedup(documents(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("hot", [2, 64])
@pytest.mark.parametrize("segments,distance", [(1, 1), (2, 0), (2, 1), (2, 2), (2, 3), (3, 2), (3, 3), (5, 2), (7, 3)])
def test_every_pair_within_the_distance_is_met_once(spark, segments, distance, hot):
    """Dense families share segments, so with ``hot=2`` their values are split again and again."""
    rng = random.Random(distance)
    values = {0, -(1 << 63), 1, (1 << 63) - 1, -1}
    for _ in range(6):
        at = rng.getrandbits(64)
        low = rng.randrange(48)
        for _ in range(25):
            v = at
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << (low + rng.randrange(16))
            values.add(v - (1 << 64) if v >> 63 else v)
    points = spark.createDataFrame([(v,) for v in values], "fp long")
    found = [(r.a, r.b) for r in ball_links(points, segments=segments, distance=distance, hot=hot).collect()]
    full = (1 << 64) - 1
    want = {
        frozenset((a, b))
        for a in values
        for b in values
        if a != b and ((a ^ b) & full).bit_count() <= distance
    }
    assert set(map(frozenset, found)) == want and len(found) == len(want)


def test_components_of_repeated_ids(spark):
    rows = [(0, "a b c d"), (1, "a b c D"), (1, "quite another text here"), (None, "x"), (None, "Y")]
    found = simhash_dedup(documents(spark, rows), carry={"n": F.length("text")}).collect()
    assert {(r.doc_id, r.component_id, r.n) for r in found} == {(0, 0, 7), (1, 0, 7), (1, 1, 23), (None, None, 1)}
    assert len({r.root for r in found}) == 4

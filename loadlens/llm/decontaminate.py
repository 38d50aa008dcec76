"""Benchmark decontamination: one Aho-Corasick automaton over the words of the benchmark's windows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from loadlens.llm.common import release, text_of

WINDOW = 10
#: One automaton holds benchmark texts of at most so many bytes; more texts are scanned in blocks.
BLOCK_BYTES = 8 << 20
#: Bytes of texts that are scanned with all blocks before the next.
HELD_BYTES = 64 << 20

# Bytes that end a word become blanks, A-Z are lowered. Bytes from 0x80 on belong to words.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20
    for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_HIT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(_SPAN)),
    ]
)
_TYPE = to_arrow_type(_HIT)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_NORMAL).split()


class Automaton:
    """The windows of all items as sequences of word numbers, found in one pass over a document."""

    def __init__(self, items: Sequence[tuple[str, bytes]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for name, raw in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(raw)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[i : i + window]), set()).add(name)
        self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, names in owners.items():
            self.found.add_word(key, (len(key), names))
        if owners:
            self.found.make_automaton()

    def scan(self, text: pa.Buffer | bytes) -> tuple[int, list[list[int]], set[str]]:
        """Number of words, ranges of hit words (merged, end exclusive), names of the items."""
        raw = bytes(text)
        words = words_of(raw)
        if not len(self.found) or not words:
            return len(words), [], set()
        number, ranges, names = self.numbers.get, [], set()
        for last, (length, owners) in self.found.iter(tuple([number(w, 0) for w in words])):
            names |= owners
            # Ends only grow, so a range can swallow several of those before it, but none after.
            start, end = last + 1 - length, last + 1
            while ranges and ranges[-1][1] >= start:
                start = min(start, ranges.pop()[0])
            ranges.append([start, end])
        return len(words), ranges, names


def _spans(text: str, ranges: list[list[int]]) -> list[dict]:
    """Word ranges as code points of the original text."""
    if not ranges:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    return [{"start": at[i][0], "end": at[j - 1][1]} for i, j in ranges]


def scanned(texts: list[pa.Buffer | bytes], blocks: Iterable[Sequence], window: int) -> list[list]:
    """Number of words, hit ranges and items of each text, by one automaton after the other."""
    found: list[list] = [[0, [], set()] for _ in texts]
    for items in blocks:
        automaton = Automaton(items, window)
        for row, text in zip(found, texts, strict=True):
            n, ranges, names = automaton.scan(text)
            row[0] = n
            row[1] += ranges
            row[2] |= names
    return [[n, merged(ranges), names] for n, ranges, names in found]


def merged(ranges: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _items(shipped) -> Iterator[Sequence]:
    """The blocks one by one; a worker keeps none that it has scanned with."""
    for block in shipped:
        yield block.value
        vars(block).pop("_value", None)


def _scanner(shipped: list, window: int):
    def results(texts: list[pa.Array], found: list[list]) -> Iterator[pa.Array]:
        found_ = iter(found)
        for batch in texts:
            out = []
            for x in batch:
                n, ranges, names = next(found_)
                spans = _spans(x.as_py(), ranges) if ranges else []
                hit = sum(j - i for i, j in ranges)
                out.append({"n_words": n, "n_hit": hit, "items": sorted(names), "spans": spans})
            yield pa.array(out, _TYPE)

    @F.arrow_udf(_HIT)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if len(shipped) == 1:
            automaton = Automaton(next(_items(shipped)), window)
            for batch in batches:
                yield from results([batch], [automaton.scan(x.as_buffer()) for x in batch])
            del automaton
        else:
            held: list[pa.Array] = []
            for batch in chain(batches, [None]):
                if batch is not None:
                    held.append(batch)
                if held and (batch is None or sum(b.nbytes for b in held) >= HELD_BYTES):
                    texts = [x.as_buffer() for b in held for x in b]
                    yield from results(held, scanned(texts, _items(shipped), window))
                    held = []
        release()

    return scan


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> list[list]:
    """The benchmark's rows in blocks of at most ``most`` bytes, a longer text alone in one."""
    rows = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_of(text_col).cast("binary")
    )
    blocks: list[list] = [[]]
    size = 0
    for name, raw in sorted((r[0], bytes(r[1])) for r in rows.toLocalIterator()):
        if blocks[-1] and size + len(raw) > most:
            blocks.append([])
            size = 0
        blocks[-1].append((name, raw))
        size += len(raw)
    return blocks


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    *,
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    out: str = "contamination",
) -> DataFrame:
    """``docs`` with a struct column ``out``: ``n_words, n_hit, items, spans``.

    Words are runs of ASCII letters and digits and of everything beyond ASCII, A-Z lowered. A
    window is ``window`` consecutive words of an item, or the whole item if it has fewer. A word of
    a document inside an occurrence of a window is hit; ``spans`` are the hit passages as code
    points of the original text, ``items`` the ids with an occurring window, sorted as strings.

    The benchmark is the query set: it is read by the driver and broadcast, at most
    ``block_bytes`` of it in one automaton. With a larger one a task gathers ``HELD_BYTES`` of texts
    and scans them with one automaton after the other, so one is in memory at a time and each is
    built once for so many texts; the passages are united within the row. No row ever moves.

    Null and empty texts, in either table, have no words and match nothing. An item without an id
    has the empty id. Repeated items and items that share windows are all named. All other columns
    of ``docs`` are kept as they are, one of the name ``out`` excepted. An empty table gives no
    rows; an empty benchmark hits nothing.
    """
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    scan = _scanner([context.broadcast(b) for b in blocks], window)
    return docs.select(*kept, scan(text_of(text_col)).alias(out))

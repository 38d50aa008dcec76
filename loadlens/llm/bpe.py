"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding by pieces.

The fold exists twice, with equal results. ``fold_word`` is made of higher-order functions over
literal rank tables; ``merge_word`` does the same steps in the Arrow function that splits the texts.
The first needs several times the CPU seconds (the README has the figures), so ``encode`` takes the
second unless it is told otherwise.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from loadlens.llm.common import release, text_of

#: Texts of so many characters form one batch, whose words are numbered and encoded once.
BATCH = 1 << 20
#: Bytes of words and tokens that a task remembers from batch to batch, roughly, in each of two
#: generations: words not met for a generation are forgotten.
MEMORY = 16 << 20
#: Words of more bytes are merged with a heap: a fold costs the square of the length.
LONGEST = 64
_REST = LONGEST + 2  # no state of the fold is longer


class Vocabulary(NamedTuple):
    """Token ids and the merges that make them, as arrays that Spark keeps as literals.

    ``place[a] + b`` is the slot of the pair of tokens a, b: ``owner`` of the slot is a if the pair
    merges, and ``made`` is the id it merges into, which is also its rank. Rows of few merges fill
    the gaps of others.
    """

    pieces: list[bytes]
    place: np.ndarray
    owner: np.ndarray
    made: np.ndarray
    merges: dict[tuple[int, int], int]


@lru_cache(maxsize=2)
def rank_map(path: str) -> dict[bytes, int]:
    """Pieces and their ranks, from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def pieces_of(path: str) -> list[bytes]:
    ranks = rank_map(path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def merge_word(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The token ids of a word: the leftmost pair of the lowest rank joins until none is known."""
    if raw in ranks:
        return [ranks[raw]]
    if len(raw) > LONGEST:
        return _merge_long(raw, ranks)
    parts, known = [raw[i : i + 1] for i in range(len(raw))], ranks.get
    found = [known(raw[i : i + 2], _NONE) for i in range(len(raw) - 1)]
    while found and (lowest := min(found)) != _NONE:
        at = found.index(lowest)
        joined = parts[at] + parts[at + 1]
        parts[at] = joined
        del parts[at + 1], found[at]
        if at:
            found[at - 1] = known(parts[at - 1] + joined, _NONE)
        if at < len(found):
            found[at] = known(joined + parts[at + 1], _NONE)
    return [ranks[p] for p in parts]


_NONE = 1 << 62


def _merge_long(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and a linked list, for words whose length squared would be too much."""
    n = len(raw)
    ends = list(range(1, n + 1))  # of the part that starts here; 0 once it is joined to the left
    starts = list(range(-1, n))  # of the part that ends before here
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = ends[i]
        if not j or j >= n or ranks.get(raw[i : ends[j]]) != rank:
            continue
        ends[i], ends[j] = ends[j], 0
        starts[ends[i]] = i
        for a, b in ((starts[i], i), (i, ends[i])):
            if a >= 0 and b < n and (r := ranks.get(raw[a : ends[b]])) is not None:
                heapq.heappush(heap, (r, a))
    out, at = [], 0
    while at < n:
        out.append(ranks[raw[at : ends[at]]])
        at = ends[at]
    return out


def _below(raw: bytes, rank: int, ranks: dict[bytes, int]) -> list[int]:
    """The tokens of ``raw`` with the merges below ``rank`` only."""
    parts = [raw[i : i + 1] for i in range(len(raw))]
    while True:
        found = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        lowest = min(found, default=_NONE)
        if lowest >= rank:
            return [ranks[p] for p in parts]
        at = found.index(lowest)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    ranks, pieces = rank_map(path), pieces_of(path)
    merges: dict[tuple[int, int], int] = {}
    rows: dict[int, list[int]] = {}
    for rank, piece in enumerate(pieces):
        if len(piece) > 1:
            # The last merge joins the two parts that the lower ranks leave of the piece.
            parts = _below(piece, rank, ranks)
            if len(parts) == 2:
                merges[parts[0], parts[1]] = rank
                rows.setdefault(parts[0], []).append(parts[1])
    place = np.zeros(len(pieces), np.int64)
    slots = np.zeros(4 * len(pieces), np.int64)
    for left, rights in sorted(rows.items(), key=lambda r: (-len(r[1]), r[0])):
        offsets, lowest = np.array(sorted(rights)), min(rights)
        free = lowest + np.flatnonzero(slots[lowest : 3 * len(pieces)] == 0)
        for some in np.array_split(free, max(1, len(free) // 2048)):
            fits = (slots[some[:, None] + (offsets - lowest)] == 0).all(axis=1)
            if fits.any():
                place[left] = int(some[fits.argmax()]) - lowest
                break
        else:
            raise ValueError("the merges do not fit the table")
        slots[place[left] + offsets] = [left << 32 | merges[left, int(r)] for r in offsets]
    room = int(place.max()) + len(pieces)  # no pair of tokens points beyond the end
    slots = slots[:room]
    owner = np.where(slots > 0, slots >> 32, -1)
    return Vocabulary(pieces, place, owner, slots & 0xFFFFFFFF, merges)


def _ints(values) -> Column:
    """An array literal, null for an empty text; Catalyst folds the cast and the split once."""
    split = F.split(F.lit(",".join(map(str, values))), ",")
    return F.transform(split, lambda x: F.when(x != "", x).cast("int"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


class Tables(NamedTuple):
    """The literal tables, each bound to a variable of the expression."""

    byte_ids: Column  # token of a byte
    pairs: Column  # rank of two bytes, at 256 * first + second
    place: Column
    owner: Column
    made: Column


def fold_word(word: Column, tables: Tables) -> Column:
    """The token ids of a word given as an array of byte values.

    The state is the tokens, at first one for each byte, with an edge of -1 at both ends, and the
    ranks of all neighbours, null where a pair does not merge. Each step joins the leftmost pair
    of the lowest rank and looks up the two pairs that are new; a word in which nothing merges
    any more stays as it is. A word of n bytes merges at most n - 1 times, so its own tail counts
    the steps.
    """

    def rank(a: Column, b: Column) -> Column:
        slot = F.get(tables.place, a) + b
        return F.when(F.get(tables.owner, slot) == a, F.get(tables.made, slot))

    def state(ids: Column, ranks: Column) -> Column:
        return F.struct(ids.alias("ids"), ranks.alias("ranks"))

    def step(now: Column, _: Column) -> Column:
        ids, ranks = now["ids"], now["ranks"]

        def joined(at: Column) -> Column:
            lowest = F.get(ranks, at - 1)
            new = F.array(rank(F.get(ids, at - 2), lowest), rank(lowest, F.get(ids, at + 1)))
            rest = F.lit(_REST)
            return state(
                F.concat(F.slice(ids, F.lit(1), at - 1), F.array(lowest), F.slice(ids, at + 2, rest)),
                F.concat(F.slice(ranks, F.lit(1), at - 2), new, F.slice(ranks, at + 2, rest)),
            )

        place = F.array_position(ranks, F.array_min(ranks)).cast("int")
        return _let(place, lambda at: F.when(at.isNull(), now).otherwise(joined(at)))

    edge, no_rank = F.array(F.lit(-1)), F.array(F.lit(None).cast("int"))
    first = F.transform(word, lambda b: F.get(tables.byte_ids, b))
    # With null after the last byte its pair is null, which is the rank of the edge.
    ranks = F.zip_with(word, F.slice(word, 2, _REST), lambda a, b: F.get(tables.pairs, a * 256 + b))
    start = state(F.concat(edge, first, edge), F.concat(no_rank, ranks))
    ids = F.aggregate(F.slice(word, 2, _REST), start, step, lambda end: end["ids"])
    return F.slice(ids, F.lit(2), F.size(ids) - 2)


#: Does the same as ``GPT_PATTERN``, several times faster, on texts without the characters that the
#: two kinds of expressions class differently.
_PLAIN_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)
#: Characters that are compared; of what lies beyond, pictographs are no letter, number or white space
#: for either kind, and the rest is left to the general pattern.
_COMPARED, _PICTURES = 0x10000, (0x1F300, 0x1FB00)


@lru_cache(maxsize=1)
def _not_plain() -> re.Pattern:
    """A character that is a letter, a number or white space for one kind of expression only."""
    every = "".join(chr(c) for c in range(_COMPARED) if not 0xD800 <= c < 0xE000)
    pairs = ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s"))
    other: set[str] = set()
    for general, plain in pairs:
        other |= set(regex.findall(general, every)) ^ set(re.findall(plain, every))
    # Beyond the first plane a class is searched entry by entry, so it has two ranges there.
    far = f"{chr(_COMPARED)}-{chr(_PICTURES[0] - 1)}{chr(_PICTURES[1])}-\U0010ffff"
    return re.compile(f"[{''.join(map(re.escape, sorted(other)))}{far}]")


def _is_plain(text: str) -> bool:
    return not _not_plain().search(text)


class _Words(dict):
    """Numbers words in the order in which they are first seen."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Merges(NamedTuple):
    """The rank map of a vocabulary as arrays: tokens of bytes, and ``place``, ``owner``, ``made``."""

    byte_ids: np.ndarray
    place: np.ndarray
    owner: np.ndarray
    made: np.ndarray

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What pairs of tokens merge into, which is their rank; ``_NEVER`` if they do not."""
        slot = self.place[a] + b
        known = (a >= 0) & (b >= 0) & (self.owner[slot] == a)
        return np.where(known, self.made[slot], _NEVER)


_NEVER = np.int32(np.iinfo(np.int32).max)


def merges_of(path: str) -> Merges:
    known = vocabulary(path)
    arrays = (_byte_ids(known), known.place, known.owner, known.made)
    return Merges(*(np.asarray(x, np.int32) for x in arrays))


def fold_words(raws: list[bytes], merges: Merges) -> list[bytes]:
    """The tokens of words, as 32-bit integers in bytes: the leftmost pair of the lowest rank joins until
    none is known, in all words of about a length at a time, one merge a step."""
    out = [b""] * len(raws)
    lengths = np.fromiter(map(len, raws), np.int64, len(raws))
    low = 0
    for width in (4, 8, 12, 16, 24, 32, LONGEST):
        some = np.flatnonzero((lengths > low) & (lengths <= width))
        for k in range(0, len(some), 1 << 13):
            part = some[k : k + (1 << 13)].tolist()
            for at, found in zip(part, _fold([raws[i] for i in part], width, merges), strict=True):
                out[at] = found
        low = width
    return out


def _fold(raws: list[bytes], width: int, merges: Merges) -> list[bytes]:
    n, columns = len(raws), np.arange(width)
    given = np.frombuffer(b"".join([r.ljust(width, b"\0") for r in raws]), np.uint8).reshape(n, width)
    sizes = np.fromiter(map(len, raws), np.int64, n)
    ids = np.where(columns < sizes[:, None], merges.byte_ids[given], np.int32(-1))
    done, rows = ids.copy(), np.arange(n)
    ranks = np.full((n, width), _NEVER)  # of each token with the next; the last has none
    ranks[:, :-1] = merges.rank(ids[:, :-1], ids[:, 1:])
    while True:
        at = ranks.argmin(axis=1)
        lowest = ranks[np.arange(len(rows)), at]
        going = lowest != _NEVER
        if not going.all():
            done[rows[~going]] = ids[~going]
            rows, ids, ranks, at, lowest = rows[going], ids[going], ranks[going], at[going], lowest[going]
        if not len(rows):
            break
        every = np.arange(len(rows))
        ids[every, at] = lowest
        # What follows the pair moves up by one.
        source = np.minimum(columns + (columns > at[:, None]), width - 1)
        last = ids[:, -1].copy()
        ids = np.take_along_axis(ids, source, 1)
        ranks = np.take_along_axis(ranks, np.minimum(columns + (columns >= at[:, None]), width - 1), 1)
        ids[:, -1] = np.where(at == width - 1, last, -1)
        ranks[:, -1] = _NEVER
        after = ids[every, np.minimum(at + 1, width - 1)]
        ranks[every, at] = np.where(at < width - 1, merges.rank(lowest, after), _NEVER)
        left = np.flatnonzero(at > 0)
        ranks[left, at[left] - 1] = merges.rank(ids[left, at[left] - 1], lowest[left])
    there = done >= 0
    flat = done[there].astype("<u4").tobytes()
    ends = 4 * np.cumsum(there.sum(axis=1))
    bounds = [0, *ends.tolist()]
    return [flat[i:j] for i, j in zip(bounds, bounds[1:], strict=False)]


class _Memory:
    """Tokens of words, as 32-bit integers in bytes, of the last words that a task has met."""

    def __init__(self, path: str, merges: Merges):
        self.path, self.merges = path, merges
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def spelled(self, words: _Words) -> list[bytes]:
        out = list(map(self.young.get, words))
        names = list(words)
        unknown = []
        for at, found in enumerate(out):
            if found is None:
                out[at] = found = self.old.get(names[at])
                if found is None:
                    unknown.append(at)
                else:
                    self._keep(names[at], found)
        raws = [names[at].encode() for at in unknown]
        for at, raw, found in zip(unknown, raws, fold_words(raws, self.merges), strict=True):
            if len(raw) > LONGEST:
                ids = merge_word(raw, rank_map(self.path))
                out[at] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                out[at] = found
                self._keep(names[at], found)
        return out

    def _keep(self, word: str, made: bytes) -> None:
        self.size += 2 * len(word) + len(made) + 200
        self.young[word] = made
        if self.size > MEMORY:
            self.old, self.young, self.size = self.young, {}, 0


def _batches(pattern: str, fast: bool, batches, make):
    """``make`` of (ids, word numbers, words) for every ``BATCH`` characters of a task's texts."""
    general = regex.compile(pattern)
    ids, rows, words, size = [], [], _Words(), 0
    for b in batches:
        for i, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            text = text.as_py()
            found = (_PLAIN_WORDS if fast and _is_plain(text) else general).findall(text)
            rows.append(np.fromiter(map(words.__getitem__, found), np.int32, len(found)))
            ids.append(i)
            size += len(text)
            if size >= BATCH:
                yield make(ids, rows, words)
                ids, rows, words, size = [], [], _Words(), 0
    if ids:
        yield make(ids, rows, words)


def _tokens(rows: list[np.ndarray], spelled: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All token ids of a batch, and where those of each text end, zero first."""
    sizes = np.fromiter(map(len, spelled), np.int32, len(spelled)) >> 2
    tokens = np.frombuffer(b"".join(spelled), "<u4")
    numbers = np.concatenate(rows)
    lengths = sizes[numbers]
    ends = np.cumsum(lengths, dtype=np.int32)
    # The place of every token: where its word begins among the tokens, and how far in it is.
    begin = (np.cumsum(sizes, dtype=np.int32) - sizes)[numbers] - (ends - lengths)
    flat = tokens[np.repeat(begin, lengths) + np.arange(len(lengths) and ends[-1], dtype=np.int32)]
    return flat, np.concatenate(([0], ends))[np.cumsum([0, *map(len, rows)])]


def _binaries(bounds: np.ndarray, raw: bytes, kind: pa.DataType) -> pa.Array:
    parts = [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(raw)]
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, parts).cast(kind)


def joined_pieces(ids: np.ndarray, pieces: list[bytes], at_once: int = 1 << 16) -> bytes:
    """What token ids decode to: their pieces, one after the other."""
    parts = range(0, len(ids), at_once)
    return b"".join([b"".join(map(pieces.__getitem__, ids[i : i + at_once].tolist())) for i in parts])


def _encoder(schema: pa.Schema, pattern: str, path: str, there_and_back: bool):
    """Texts to (id, token ids), or to (id, token ids in bytes, the bytes they decode to)."""
    merges = merges_of(path)  # on the driver; a few megabytes that go with the function

    def run(batches):
        memory = _Memory(path, merges)
        pieces = pieces_of(path) if there_and_back else []
        widths = np.fromiter(map(len, pieces), np.int64, len(pieces))

        def make(ids: list, rows: list[np.ndarray], words: _Words) -> pa.RecordBatch:
            flat, bounds = _tokens(rows, memory.spelled(words))
            columns = [pa.array(ids, schema.types[0])]
            if there_and_back:
                ends = np.concatenate(([0], np.cumsum(widths[flat])))[bounds]
                columns.append(_binaries(4 * bounds, flat.astype("<u4").tobytes(), schema.types[1]))
                columns.append(_binaries(ends, joined_pieces(flat, pieces), schema.types[2]))
            else:
                values = pa.array(flat.astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)
                columns.append(lists.cast(schema.types[1]))
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        yield from _batches(pattern, pattern == GPT_PATTERN, batches, make)
        del memory, pieces, make
        rank_map.cache_clear()
        release()

    return run


def _segmenter(schema: pa.Schema, pattern: str, path: str):
    """Texts to batches of one row: texts as word numbers, and the words as byte arrays."""

    def make(ids: list, rows: list[np.ndarray], words: _Words) -> pa.RecordBatch:
        short, long = [], {}
        for number, word in enumerate(words):
            raw = word.encode()
            if len(raw) > LONGEST:
                long[number], raw = merge_word(raw, rank_map(path)), b""
            short.append(np.frombuffer(raw, np.uint8))
        docs = pa.StructArray.from_arrays(
            [pa.array(ids, schema.field("docs").type.value_type[0].type), _lists(rows, pa.int32())],
            fields=list(schema.field("docs").type.value_type),
        )
        made = pa.StructArray.from_arrays(
            [pa.array(list(long), pa.int32()), pa.array(list(long.values()), pa.list_(pa.int32()))],
            fields=list(schema.field("long").type.value_type),
        )
        parts = (docs, _lists(short, pa.int32()), made)
        columns = [pa.ListArray.from_arrays([0, len(x)], x) for x in parts]
        return pa.RecordBatch.from_arrays(
            [c.cast(t) for c, t in zip(columns, schema.types, strict=True)], schema=schema
        )

    def run(batches):
        return _batches(pattern, pattern == GPT_PATTERN, batches, make)

    return run


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    values = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(kind.to_pandas_dtype())))


def _byte_ids(known: Vocabulary) -> list[int]:
    at = {piece[0]: i for i, piece in enumerate(known.pieces) if len(piece) == 1}
    return [at[c] for c in range(256)]


#: The pattern that the faster one stands for. A fixed value.
GPT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    functions: bool = False,
) -> DataFrame:
    """``doc_id, ids`` (array of int) of every row: the byte-level BPE of its whole text.

    Each match of ``pattern`` is encoded by itself, as the tiktoken library does without special
    tokens. Within a task, texts are gathered to batches of ``BATCH`` characters (one longer text
    is its own batch) and their words numbered; the merges are folded once over each distinct
    word, and the texts pick the results by number. Nothing is shuffled, and a lost task is made
    again from its input.

    With ``functions`` a batch becomes one row of byte arrays and word numbers, and the fold runs in
    the JVM by higher-order functions over literal rank tables. Else the Arrow function folds, and
    a task remembers words up to ``MEMORY``.

    Null and empty texts have no tokens. Rows that repeat, and null ids, stay as they are. An empty
    table gives no rows. Other columns are not read. ``path`` names a rank file of lines of base64
    and rank; it must be readable by the driver and the executors.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    if functions:
        return _encode_by_functions(base, path, pattern)
    schema = T.StructType(
        [base.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
    return base.mapInArrow(_encoder(arrow, pattern, path, False), schema)


def round_trip(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids, decoded`` of every row: its tokens as ``encode`` makes them, as little-endian
    unsigned 32-bit integers in bytes, and the bytes that these ids decode to.

    Both directions in one pass of the same function, for ids that are stored or hashed rather
    than worked on as arrays. Nulls, repeats and empty tables as in ``encode``.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    made = [T.StructField(c, T.BinaryType()) for c in ("ids", "decoded")]
    schema = T.StructType([base.schema["doc_id"], *made])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
    return base.mapInArrow(_encoder(arrow, pattern, path, True), schema)


def _encode_by_functions(base: DataFrame, path: str, pattern: str) -> DataFrame:
    kind = base.schema["doc_id"].dataType.simpleString()
    known = vocabulary(path)
    shape = (
        f"docs array<struct<doc_id: {kind}, words: array<int>>>, words array<array<int>>, "
        "long array<struct<at: int, ids: array<int>>>"
    )
    made = base.sparkSession.createDataFrame([], shape).schema
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in made])
    batches = base.mapInArrow(_segmenter(arrow, pattern, path), made)

    def with_long(ids: Column) -> Column:
        placed = F.map_from_entries(F.col("long"))
        whole = F.transform(ids, lambda x, i: F.coalesce(F.element_at(placed, i), x))
        return F.when(F.size("long") == 0, ids).otherwise(whole)

    def texts(ids: Column) -> Column:
        return F.transform(
            F.col("docs"),
            lambda d: F.struct(
                d["doc_id"].alias("doc_id"),
                F.flatten(F.transform(d["words"], lambda n: F.get(ids, n))).alias("ids"),
            ),
        )

    byte_ids = _byte_ids(known)
    pairs = [known.merges.get((a, b), "") for a in byte_ids for b in byte_ids]
    values = [byte_ids, pairs, known.place, known.owner, known.made]

    def bound(rest: list, *found: Column) -> Column:
        if rest:
            return _let(_ints(rest[0]), lambda t: bound(rest[1:], *found, t))
        words = F.transform(F.col("words"), lambda w: fold_word(w, Tables(*found)))
        return _let(_let(words, with_long), texts)

    whole = bound(values)
    return batches.select(F.inline(whole))


def decode(ids: Column, path: str) -> Column:
    """The bytes of an array of token ids: its pieces, one after the other. Null gives null."""
    pieces = F.split(F.lit(",".join(p.hex() for p in pieces_of(path))), ",")
    return _let(
        pieces,
        lambda p: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(p, i)), "")),
    )


def little_endian(ids: Column, most: int = 1 << 16) -> Column:
    """The ids as unsigned 32-bit integers, low byte first; ids are below ``most``."""
    spelled = F.split(F.lit(",".join(i.to_bytes(4, "little").hex() for i in range(most))), ",")
    return _let(
        spelled,
        lambda p: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(p, i)), "")),
    )

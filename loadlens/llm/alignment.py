"""Cross-tokenizer alignment: token pairs linked by byte ranges, counted in vectors of a perfect hash."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from loadlens.llm.common import cut, own_folder, release, text_of

#: Texts of so many bytes are encoded to one batch; so many tokens of either side aligned at once.
TEXT_BYTES, TOKENS = 1 << 20, 1 << 18
#: Pairs whose counts are held at a time. More are counted in blocks, each in its own passes.
BLOCK_PAIRS = 2 << 20
#: Pairs that share a bucket of the hash, and of those, pairs that share a seed, on average.
BUCKET_PAIRS, SEED_PAIRS = 4096, 4
#: Pairs a task gathers before it hands on those that differ.
GATHERED = 1 << 20
#: Entries of a piece of a count vector, and vectors added up by one step of the sum.
PIECE, FAN_IN = 1 << 16, 16


class Side(NamedTuple):
    """How one tokenizer encodes, and the bytes of its tokens."""

    encode: object  # text to ids
    pieces: list[bytes]


def byte_side(path: str, pattern: str) -> Side:
    """A byte-level BPE from its ranks; its texts get a blank before them. No special tokens."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return Side(lambda text: known.encode_ordinary(" " + text), pieces)


def piece_side(path: str) -> Side:
    """A sentencepiece model; it puts the blank before a text itself."""
    import sentencepiece

    known = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(known.get_piece_size()):
        piece = known.id_to_piece(i)
        raw = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        pieces.append(bytes([int(raw[1], 16)]) if raw else piece.replace("▁", " ").encode())
    return Side(lambda text: known.encode(text, num_threads=1), pieces)


class Tokenizers(NamedTuple):
    """The files of both tokenizers, and the pattern that cuts texts for the first."""

    ranks: str
    pattern: str
    model: str

    def sides(self) -> tuple[Side, Side]:
        return byte_side(self.ranks, self.pattern), piece_side(self.model)


def _width(sizes: tuple[int, int]) -> type:
    """The type that token ids are stored in."""
    return np.uint16 if max(sizes) <= 1 << 16 else np.uint32


def _encoder(names: Tokenizers, schema: pa.Schema):
    """Texts to the ids of both sides, as unsigned integers in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = names.sides()
        width = _width([len(s.pieces) for s in sides])
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for row, key, text in zip(*batch.columns, strict=True):
                text = text.as_py()
                raw = b" " + text.encode()
                ids = [side.encode(text) for side in sides] if text else [[], []]
                joined = [b"".join(map(s.pieces.__getitem__, i)) for s, i in zip(sides, ids, strict=True)]
                if not text or joined != [raw, raw]:
                    ids = [[], []]
                rows.append((row.as_py(), key.as_py(), *(np.array(i, width).tobytes() for i in ids)))
                size += len(raw)
                if size >= TEXT_BYTES:
                    yield _record(rows, schema)
                    rows, size = [], 0
            if rows:
                yield _record(rows, schema)
        del sides
        release()

    return run


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class Aligned(NamedTuple):
    """The tokens and links of several texts, one after the other."""

    a: np.ndarray  # ids of tokens
    b: np.ndarray
    a_group: np.ndarray  # the group of each token
    b_group: np.ndarray
    of_a: np.ndarray  # by document: tokens, groups, links
    of_b: np.ndarray
    of_groups: np.ndarray
    of_links: np.ndarray
    pairs: np.ndarray  # a << 32 | b of every link


def align(a: list[np.ndarray], b: list[np.ndarray], lengths: tuple[np.ndarray, np.ndarray]) -> Aligned:
    """Links and groups of texts whose tokens cover the same bytes on both sides.

    Where tokens end is marked in one array of the bytes. Two tokens overlap in one stretch between
    two marks, so every mark is the end of exactly one link, and a mark of both sides ends a group.
    """
    of_a, of_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    ids = [np.concatenate(side).astype(np.int64) if side else np.empty(0, np.int64) for side in (a, b)]
    ends = [np.cumsum(n[i], dtype=np.int64) for n, i in zip(lengths, ids, strict=True)]
    marks = np.zeros(int(ends[0][-1]) + 1 if len(ends[0]) else 1, np.uint8)
    marks[ends[0]] = 1
    marks[ends[1]] |= 2
    marks[0] = 0
    cuts = np.flatnonzero(marks)
    kind = marks[cuts]
    in_a, in_b, whole = (kind & 1) > 0, kind > 1, kind == 3
    # The token of a side that holds the byte before a mark: as many of its tokens end before it.
    at_a, at_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    group = np.cumsum(whole) - whole
    pairs = ids[0][at_a] << 32 | ids[1][at_b]
    # The mark at which a document ends, from its tokens on the first side.
    stops = np.concatenate(([0], np.flatnonzero(in_a) + 1))[np.concatenate(([0], np.cumsum(of_a)))]
    groups = np.concatenate(([0], np.cumsum(whole)))[stops]
    return Aligned(
        *ids, group[in_a], group[in_b], of_a, of_b, np.diff(groups), np.diff(stops), pairs
    )


def spell(found: Aligned, names: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2`` of each document; ``names`` has both ids and what follows them (see ``_names``)."""
    n_a, n_b = len(found.a), len(found.b)
    groups = int(found.of_groups.sum())
    a_in, b_in = (np.bincount(g, minlength=groups) for g in (found.a_group, found.b_group))
    a_upto, b_upto = np.cumsum(a_in), np.cumsum(b_in)
    # A token of the first side stands after the other side's tokens of the groups before its own.
    at_a = np.arange(n_a) + (b_upto - b_in)[found.a_group]
    at_b = np.arange(n_b) + a_upto[found.b_group]
    last_a = np.arange(n_a) == a_upto[found.a_group] - 1
    last_b = np.arange(n_b) == b_upto[found.b_group] - 1
    half = names[0]
    codes = np.empty(n_a + n_b, np.int64)
    codes[at_a] = found.a * 2 + last_a
    codes[at_b] = half + found.b * 2 + last_b
    stops = np.concatenate(([0], np.cumsum(found.of_a + found.of_b)))
    return ["".join(names[1][codes[i:j]].tolist())[:-1] for i, j in zip(stops, stops[1:], strict=False)]


def _names(n_a: int, n_b: int) -> tuple[int, np.ndarray]:
    spelled = [f"{i}{end}" for i in range(n_a) for end in ",|"]
    spelled += [f"{i}{end}" for i in range(n_b) for end in ",;"]
    return 2 * n_a, np.array(spelled, object)


def _parts(batches: Iterator[pa.RecordBatch], lengths) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """Rows of about ``TOKENS`` tokens and what their ids align to."""
    width = _width([len(side) for side in lengths])
    for batch in batches:
        ids: tuple[list, list] = ([], [])
        start = size = 0
        for at, row in enumerate(zip(batch.column("a"), batch.column("b"), strict=True)):
            for side, x in zip(ids, row, strict=True):
                side.append(np.frombuffer(x.as_buffer(), width))
            size += len(ids[0][-1])
            if size >= TOKENS or at == batch.num_rows - 1:
                yield batch.slice(start, at + 1 - start), align(*ids, lengths)
                ids, start, size = ([], []), at + 1, 0
    release()


# The hash. A pair belongs to the block of its first id, within it to a bucket, and there to a
# group that shares a seed; the seeds are chosen so that the pairs of a bucket fill its slots.

_ONE, _TWO = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # of a well-known mixer
_LOW, _HALF = np.uint64(0xFFFFFFFF), np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    """One to one on 64 bits."""
    x = x.astype(np.uint64)
    for factor in (_ONE, _TWO):
        x = (x ^ (x >> np.uint64(33))) * factor
    return x ^ (x >> np.uint64(33))


def _scaled(x: np.ndarray, n) -> np.ndarray:
    """Numbers of 32 bits spread over 0..n-1."""
    return ((x * np.asarray(n, np.uint64)) >> _HALF).astype(np.int64)


def block_of(pairs: np.ndarray, blocks: int) -> np.ndarray:
    return _scaled(_mixed((pairs >> 32) + 1) & _LOW, blocks)


def _bucket_of(mixed: np.ndarray, buckets: int) -> np.ndarray:
    return _scaled(mixed & _LOW, buckets)


def _seeds_in(n) -> np.ndarray:
    """How many seeds a bucket of n pairs has."""
    return -(-np.asarray(n, np.int64) // SEED_PAIRS)


def _slots(mixed: np.ndarray, seeds, n) -> np.ndarray:
    return _scaled(_mixed(mixed + np.asarray(seeds, np.uint64) * _TWO) & _LOW, n)


def fill_bucket(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds for different pairs of one bucket, and the pairs in the order of their slots.

    The largest group takes the first seed that sends its pairs to different free slots, then the
    next largest; every group finds one, as the slots of a seed are as good as random.
    """
    n, mixed = len(pairs), _mixed(pairs)
    seeds = np.zeros(int(_seeds_in(n)), np.uint32)
    group = _scaled(mixed >> _HALF, len(seeds))
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(len(seeds) + 1))
    free, slots = np.ones(n, bool), np.zeros(n, np.int64)
    for g in np.argsort(bounds[:-1] - bounds[1:], kind="stable"):
        own = order[bounds[g] : bounds[g + 1]]
        start, width = 0, 64
        while len(own):
            tried = np.arange(start, start + width, dtype=np.uint64)
            found = _slots(mixed[own][None, :], tried[:, None], n)
            fits = free[found].all(axis=1)
            if len(own) > 1:
                found_sorted = np.sort(found, axis=1)
                fits &= (found_sorted[:, 1:] != found_sorted[:, :-1]).all(axis=1)
            if fits.any():
                k = int(fits.argmax())
                seeds[g], slots[own] = start + k, found[k]
                free[found[k]] = False
                break
            start, width = start + width, min(4096, 2 * width)
    out = np.empty(n, np.int64)
    out[slots] = pairs
    return seeds, out


class Hash(NamedTuple):
    """Minimal perfect hash of a block's pairs; ``pairs`` in the order of their indexes verifies it."""

    block: int
    blocks: int
    start: np.ndarray  # of each bucket among the pairs, and the end
    seed_start: np.ndarray
    seeds: np.ndarray
    pairs: np.ndarray

    def index(self, pairs: np.ndarray) -> np.ndarray:
        """The indexes of pairs of this block. One that the hash was not made of is an error."""
        mixed = _mixed(pairs)
        bucket = _bucket_of(mixed, len(self.start) - 1)
        start = self.start[bucket]
        n = self.start[bucket + 1] - start
        if not (n > 0).all():
            raise ValueError("a pair that the hash was not made of")
        group = _scaled(mixed >> _HALF, _seeds_in(n))
        found = start + _slots(mixed, self.seeds[self.seed_start[bucket] + group], n)
        if not np.array_equal(self.pairs[found], pairs):
            raise ValueError("a pair that the hash was not made of")
        return found

    def mine(self, pairs: np.ndarray) -> np.ndarray:
        """Which pairs belong to this block."""
        return block_of(pairs, self.blocks) == self.block


def _distinct_pairs(ids: DataFrame, lengths) -> DataFrame:
    """Every linked pair once. Tasks hand on what differs among ``GATHERED`` links."""
    schema = pa.schema([("pair", pa.int64())])

    def run(batches):
        kept: list[np.ndarray] = []
        size = 0
        for _, found in _parts(batches, lengths.value):
            kept.append(np.unique(found.pairs))
            size += len(kept[-1])
            if size >= GATHERED:
                kept = [np.unique(np.concatenate(kept))]
                size = len(kept[0])
                if size >= GATHERED // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(kept[0])], schema=schema)
                    kept, size = [], 0
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(kept)))], schema=schema)

    return ids.mapInArrow(run, "pair long").distinct()


def _filled_buckets(pairs: DataFrame, blocks: int, buckets: int) -> DataFrame:
    """``block, bucket, pairs, seeds`` (in bytes) of every bucket; a task fills one after the other."""
    place = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("pair", pa.int64())])

    def placed(batches):
        for batch in batches:
            p = batch.column(0).to_numpy(zero_copy_only=False)
            at = [block_of(p, blocks).astype(np.int32), _bucket_of(_mixed(p), buckets).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*at, p)], schema=place)

    def fill(table: pa.Table) -> pa.Table:
        seeds, ordered = fill_bucket(np.sort(table.column("pair").to_numpy()))
        return pa.table(
            {
                "block": table.column("block")[:1],
                "bucket": table.column("bucket")[:1],
                "pairs": pa.array([ordered.tobytes()], pa.binary()),
                "seeds": pa.array([seeds.tobytes()], pa.binary()),
            }
        )

    keyed = pairs.mapInArrow(placed, "block int, bucket int, pair long")
    return keyed.groupBy("block", "bucket").applyInArrow(
        fill, "block int, bucket int, pairs binary, seeds binary"
    )


def _hash_of(filled: DataFrame, block: int, blocks: int, buckets: int) -> Hash:
    """The hash of one block, read to the driver: ``BLOCK_PAIRS`` pairs or so."""
    pairs = [np.empty(0, np.int64)] * buckets
    seeds = [np.empty(0, np.uint32)] * buckets
    for row in filled.filter(F.col("block") == block).toLocalIterator():
        pairs[row.bucket] = np.frombuffer(row.pairs, np.int64)
        seeds[row.bucket] = np.frombuffer(row.seeds, np.uint32)
    start, seed_start = (
        np.concatenate(([0], np.cumsum([len(x) for x in part]))) for part in (pairs, seeds)
    )
    return Hash(block, blocks, start, seed_start, np.concatenate(seeds), np.concatenate(pairs))


def _counted(ids: DataFrame, lengths, shipped) -> np.ndarray:
    """The number of documents that hold each pair of a block, by index.

    A task adds up a vector of the whole block and hands it on in pieces; ``FAN_IN`` pieces are
    added at a time, so no task sees more of them however many tasks there are.
    """
    schema = pa.schema([("piece", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        known: Hash = shipped.value
        counts = np.zeros(len(known.pairs), np.int64)
        for _, found in _parts(batches, lengths.value):
            doc = np.repeat(np.arange(len(found.of_links)), found.of_links)
            mine = known.mine(found.pairs)
            at = known.index(found.pairs[mine])
            held = np.unique(doc[mine] * len(counts) + at) if len(at) else at
            counts += np.bincount(held % max(1, len(counts)), minlength=len(counts))
        for k in range(0, len(counts), PIECE):
            piece = counts[k : k + PIECE]
            if piece.any():
                columns = [pa.array([k // PIECE], pa.int32()), pa.array([piece.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    @F.arrow_udf(T.BinaryType())
    def added(lists: pa.Array) -> pa.Array:
        out = []
        for parts in lists:
            vectors = [np.frombuffer(p.as_buffer(), np.int64) for p in parts.values]
            out.append(np.add.reduce(vectors).tobytes())
        return pa.array(out, pa.binary())

    parts = ids.mapInArrow(run, "piece int, counts binary").withColumn("task", F.spark_partition_id())
    while True:
        parts = cut(
            parts.groupBy("piece", F.expr(f"task div {FAN_IN}").cast("int").alias("task"))
            .agg(F.collect_list("counts").alias("lists"))
            .select("piece", "task", added("lists").alias("counts"))
        )
        if not parts.agg(F.coalesce(F.max("task"), F.lit(0))).first()[0]:
            break
    counts = np.zeros(len(shipped.value.pairs), np.int64)
    for row in parts.toLocalIterator():
        piece = np.frombuffer(row.counts, np.int64)
        counts[row.piece * PIECE : row.piece * PIECE + len(piece)] = piece
    return counts


def _best(known: Hash, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its first id; a block has all pairs of an id."""
    _, first = np.unique(known.pairs >> 32, return_inverse=True)
    highest = np.zeros(first.max() + 1 if len(first) else 0, np.int64)
    np.maximum.at(highest, first, counts)
    return counts == highest[first]


_LONGS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _looked_up(ids: DataFrame, lengths, shipped, counted, sizes, schema: T.StructType, text: bool) -> DataFrame:
    """What a block adds to each document; the first block adds what does not depend on counts."""
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches):
        known, (counts, best) = shipped.value, counted.value
        names = _names(*sizes) if known.block == 0 else None
        for rows, found in _parts(batches, lengths.value):
            mine = known.mine(found.pairs)
            at = known.index(found.pairs[mine])
            stops = np.concatenate(([0], np.cumsum(found.of_links)))

            def by_document(values: np.ndarray, mine=mine, stops=stops) -> np.ndarray:
                every = np.zeros(len(mine) + 1, np.int64)
                every[1:][mine] = values
                return np.diff(np.cumsum(every)[stops])

            sums = [by_document(best[at]), by_document(counts[at])]
            if names is None:
                own = [np.zeros(rows.num_rows, np.int64)] * 4
                spelled = [None] * rows.num_rows
            else:
                own = [found.of_a, found.of_b, found.of_groups, found.of_links]
                spelled = spell(found, names)
            digests = [s and hashlib.sha256(s.encode()).hexdigest() for s in spelled]
            columns = [rows.column("row"), rows.column("doc_id")]
            columns += [pa.array(x, pa.int64()) for x in (*own, *sums)]
            columns.append(pa.array(digests, pa.string()))
            if text:
                columns.append(pa.array(spelled, pa.string()))
            columns = [c.cast(t) for c, t in zip(columns, arrow.types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return ids.mapInArrow(run, schema)


def align_tokenizers(
    docs: DataFrame,
    tokenizers: Tokenizers,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_pairs: int = BLOCK_PAIRS,
    groups: bool = False,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A text is encoded by both tokenizers, with a blank before it. Tokens whose byte ranges overlap
    are linked; where tokens of both sides end, a group ends. The count of a pair of ids is the
    number of rows that hold it linked; ``count_sum`` adds up the counts of a text's links and
    ``n_best`` is how many of them have the highest count of their first id. With ``groups`` the
    groups come too, as ``a1,a2|b1;a3|b2``; their digest is always there.

    The ids are written to the shared folder once. From them a first pass finds the distinct pairs,
    of which a minimal perfect hash is made bucket by bucket; a second aligns the ids again and adds
    up a dense vector a task, summed as a tree; a third looks the counts up, every pair verified.
    Pairs beyond ``block_pairs`` (at 17 bytes each to the driver and the workers) are worked on in
    blocks of whole first ids, so that nothing that grows with the corpus is sent anywhere at once;
    each block repeats the last two passes.

    A null or empty text, or one that either side's tokens do not spell, has no tokens: zeros and an
    empty digest. Repeated rows count each as a document; null ids are allowed. An empty table gives
    no rows. Other columns are not read. A text of any length is aligned in one piece; the files of
    the tokenizers must be readable by the driver and the executors.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        text_of(text_col).alias("text"),
    )
    fields = [base.schema["row"], base.schema["doc_id"]]
    stored = T.StructType([*fields, T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in stored])
    folder = own_folder(spark, "aligned")
    encoded = base.mapInArrow(_encoder(tokenizers, arrow), stored)
    encoded.write.option("compression", "zstd").parquet(f"{folder}/ids")
    ids = spark.read.schema(stored).parquet(f"{folder}/ids")

    pieces = [side.pieces for side in tokenizers.sides()]
    sizes = tuple(map(len, pieces))
    lengths = spark.sparkContext.broadcast(  # a byte a token of the vocabularies
        tuple(np.array([len(p) for p in side], np.int32) for side in pieces)
    )
    pairs = cut(_distinct_pairs(ids, lengths))
    there = pairs.count()
    blocks = max(1, -(-there // block_pairs))
    buckets = max(1, -(-there // (blocks * BUCKET_PAIRS)))
    filled = cut(_filled_buckets(pairs, blocks, buckets))

    made = [T.StructField(n, T.LongType()) for n in _LONGS] + [T.StructField("groups_sha256", T.StringType())]
    if groups:
        made.append(T.StructField("groups", T.StringType()))
    schema = T.StructType([*fields, *made])
    for block in range(blocks):
        known = _hash_of(filled, block, blocks, buckets)
        shipped = spark.sparkContext.broadcast(known)
        counts = _counted(ids, lengths, shipped)
        counted = spark.sparkContext.broadcast((counts, _best(known, counts)))
        added = _looked_up(ids, lengths, shipped, counted, sizes, schema, groups)
        added.write.mode("append").option("compression", "zstd").parquet(f"{folder}/found")
        shipped.unpersist()
        counted.unpersist()
    found = spark.read.schema(schema).parquet(f"{folder}/found")
    if blocks > 1:
        texts = [f.name for f in made if f.name not in _LONGS]
        found = found.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"),
            *[F.sum(n).alias(n) for n in _LONGS],
            *[F.max(n).alias(n) for n in texts],
        )
    return found.drop("row")

"""Token counts: lengths only, from batches of equal bytes cut at safe boundaries."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm.common import release, text_of

#: Bytes of text handed to the tokenizer at a time.
BATCH_BYTES = 1 << 18
#: Characters of text that are cut and counted at a time.
TEXT_CHARS = 4 << 20
#: Bytes of pieces whose length a task remembers, roughly; longer pieces than the second are not.
MEMORY, LONGEST = 32 << 20, 256


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Lengths(dict):
    """How many tokens the pieces have that a task has met."""

    def __init__(self, path: str):
        super().__init__({"": 0})
        self.path, self.size = path, 0

    def learn(self, pieces: set[str]) -> dict[str, int]:
        """Encode pieces in batches of about ``BATCH_BYTES``; those too long to keep are returned."""
        encode, rest = _tokenizer(self.path).encode_batch_fast, {}
        batch: list[str] = []
        size = 0
        for piece in [*pieces, None]:
            if piece is None or size >= BATCH_BYTES:
                for p, e in zip(batch, encode(batch, add_special_tokens=False), strict=True):
                    if len(p) <= LONGEST:
                        self[p] = len(e)
                        self.size += 2 * len(p) + 120
                    else:
                        rest[p] = len(e)
                batch, size = [], 0
            if piece is not None:
                batch.append(piece)
                size += 4 * len(piece) + 16
        return rest

    def forget(self) -> None:
        self.clear()
        self[""] = self.size = 0


def _cuts(text: str):
    """Parts of a long text, each ending before a blank; a text without blanks is one part."""
    start = 0
    while len(text) - start > TEXT_CHARS:
        at = text.find(" ", start + TEXT_CHARS)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def count_tokens(texts: list[str], known: Lengths) -> list[int]:
    """The number of tokens of each text; see ``token_counts``."""
    out: list[int] = []
    group: list[list[str]] = []
    owners: list[int] = []
    size = 0

    def flush():
        if known.size > MEMORY:
            known.forget()
        rest = known.learn({p for pieces in group for p in pieces} - known.keys())
        for at, pieces in zip(owners, group, strict=True):
            if rest:
                out[at] += sum(rest[p] if p in rest else known[p] for p in pieces)
            else:
                out[at] += sum(map(known.__getitem__, pieces))
        group.clear()
        owners.clear()

    for at, text in enumerate(texts):
        out.append(0)
        for part in _cuts(text):
            plain = part.replace("\n", " ").replace("\t", " ").replace("\r", " ")
            group.append(plain.split(" "))
            owners.append(at)
            size += len(part)
            if size >= TEXT_CHARS:
                flush()
                size = 0
    flush()
    return out


def token_counts(path: str, text_col: str | Column = "text") -> Column:
    """The number of tokens of a whole text, as a column of longs.

    ``path`` names a file of the tokenizers library whose normaliser and splitter drop white space.
    No token then reaches over a blank, tab or line end, so these are safe boundaries: texts are cut
    there, and a piece that a task has met before is not encoded again. Pieces go to the library in
    batches of about ``BATCH_BYTES``, whatever the lengths of the texts; a text of any length is
    counted ``TEXT_CHARS`` at a time. The library's defaults hold for special strings inside texts;
    none are added, and nothing is truncated or padded.

    Null and empty texts have no tokens, repeated ones the same number each. Only lengths leave the worker; nothing is shuffled.
    """

    @F.arrow_udf(T.LongType())
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Lengths(path)
        for texts in batches:
            out: list[int] = []
            for at in range(0, len(texts), 512):
                out += count_tokens(texts[at : at + 512].to_pylist(), known)
            yield pa.array(out, pa.int64())
        del known
        release()

    return counted(text_of(text_col))

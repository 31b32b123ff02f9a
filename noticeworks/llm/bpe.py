"""Byte-level BPE through a sentencepiece model written from a rank file.

A rank file lists byte strings in the order of their merges. The model holds one piece per rank, in
rank order, so that a piece's id is its rank: its text maps each byte to one character, its score is the
negative rank, and the normaliser is the identity. Merging the pair of the highest score, leftmost
first, is then merging the pair of the lowest rank. A pre-token that is a piece as a whole becomes
that piece without merging, as the rank file's own library does it.

Defined results: a null text encodes like an empty one, to no ids; null ids decode to no bytes. Rows with
equal or null keys and extra columns pass through unchanged; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from noticeworks.llm.common import OWN, freed, slices

#: Byte b is written as the character with code 256 + b: no white space, no sign special to the library.
FIRST_CHAR = 256
#: Bytes of remembered parts per memory, with what a table entry of two objects takes, and the longest parts; when full, a
#: memory starts anew. Bounds memory, not results.
KEPT_BYTES, ENTRY, LONG = 16 << 20, 200, 60


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file (base64, blank, rank), by rank."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must run from 0 without gaps")
    return [token for _, token in pairs]


def as_chars(tokens: list[bytes]) -> list[str]:
    """Each token with its bytes as characters; 0xFF, in no UTF-8 text and in no longer token, parts them."""
    if any(255 in t for t in tokens):
        return ["".join(chr(FIRST_CHAR + b) for b in t) for t in tokens]
    codes = np.frombuffer(b"\xff".join(tokens), np.uint8).astype("<u2") + FIRST_CHAR
    return codes.astype("<u2").tobytes().decode("utf-16-le").split(chr(FIRST_CHAR + 255)) if tokens else []


def serialise_model(tokens: list[bytes]) -> bytes:
    """The sentencepiece model, as protocol-buffer bytes, whose piece ``i`` is ``tokens[i]``."""
    out = bytearray()
    for rank, chars in enumerate(as_chars(tokens)):
        out += _field(1, _piece(chars, -float(rank), NORMAL))
    unknown = len(tokens)  # never produced: every byte is a piece
    out += _field(1, _piece("<unk>", 0.0, UNKNOWN))
    trainer = _number(3, BPE) + _number(4, unknown + 1) + _number(40, unknown) + b"".join(_number(k, -1) for k in (41, 42, 43))
    out += _field(2, trainer)
    out += _field(3, _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return bytes(out)


# Fixed values of the model format.
NORMAL, UNKNOWN, BPE = 1, 2, 2


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _field(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _piece(text: str, score: float, kind: int) -> bytes:
    return _field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind)


class Memory:
    """Ids of short parts that were met before, in a bounded number of bytes."""

    def __init__(self) -> None:
        self.ids: dict[str, bytes] = {}
        self.size = 0

    def recall(self, wanted: set[str]) -> dict[str, bytes | None]:
        """What is remembered of ``wanted``, None for the rest. A small table of its own is quicker to search."""
        if self.size > KEPT_BYTES:
            self.ids.clear()
            self.size = 0
        return {p: self.ids.get(p) for p in wanted}

    def add(self, found: Iterable[tuple[str, bytes]]) -> None:
        for p, ids in found:
            if len(p) <= LONG:
                self.ids[p] = ids
                self.size += ENTRY + 2 * len(p) + len(ids)


class Coder:
    """Encodes and decodes in one Python process.

    Where a single space stands between two other signs, the pattern always begins a pre-token at the
    space. So the parts between such spaces are encoded one by one and remembered.
    """

    def __init__(self, tokens: tuple[bytes, ...], pattern: str):
        self.tokens = list(tokens)
        self.whole = {token: struct.pack("<I", i) for i, token in enumerate(tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        self.split = regex.compile(pattern).findall
        self.spaces = set(regex.findall(r"\s", "".join(map(chr, range(0xD800)))))
        self.merged = Memory()  # of a pre-token
        self.known = Memory()  # of a part after a space

    def pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, pre-token by pre-token."""
        whole = self.whole
        parts = [self.split(t) for t in texts]
        ids = self.merged.recall(set(chain.from_iterable(parts)))
        new = [p for p, known in ids.items() if known is None]
        if new:
            rest, raw_rest = [], []
            for p in new:
                raw = p.encode()
                if raw in whole:
                    ids[p] = whole[raw]
                else:
                    rest.append(p)
                    raw_rest.append(raw)
            for p, found in zip(rest, self.model.encode(as_chars(raw_rest), num_threads=1), strict=True):
                ids[p] = array("I", found).tobytes()
            self.merged.add((p, ids[p]) for p in new)
        return [b"".join(map(ids.__getitem__, ps)) for ps in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = [t.split(" ") for t in texts]
        heads = self.pieces([p[0] for p in parts])
        known = self.known.recall(set().union(*(p[1:] for p in parts)))
        # A part that is empty or has white space at an end is not cut out, but goes with its whole text.
        fit = [p for p, ids in known.items() if ids is None and p and p[0] not in self.spaces and p[-1] not in self.spaces]
        new = dict(zip(fit, self.pieces([" " + p for p in fit]), strict=True))
        known.update(new)
        self.known.add(new.items())
        out = []
        for text, head, ps in zip(texts, heads, parts, strict=True):
            got = list(map(known.__getitem__, ps[1:]))
            plain = None not in got and not (len(ps) > 1 and (not ps[0] or ps[0][-1] in self.spaces))
            out.append(head + b"".join(got) if plain else self.pieces([text])[0])
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    """One coder per worker process; the rank file is read where the task runs."""
    return Coder(tuple(read_ranks(path)), pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` without ``text`` and with ``ids``: the ids packed as little-endian unsigned 32-bit integers.

    ``path`` is the rank file's place on every machine. A column of the name ``ids`` is replaced.
    """
    return _mapped(df, text, path, pattern, {ids: lambda c, texts: c.encode(_texts(texts))})


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` without ``ids`` and with ``into``: the bytes the ids stand for. Inverse of ``encode``."""
    return _mapped(df, ids, path, pattern, {into: _decoded})


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` without ``text`` and with ``ids`` and what these ids decode to, in one pass of one worker a task."""
    return _mapped(df, text, path, pattern, {ids: lambda c, texts: c.encode(_texts(texts)), into: _decoded})


def _texts(values: list[bytes | None]) -> list[str]:
    return [(t or b"").decode() for t in values]


def _decoded(coder_: Coder, ids: list[bytes | None]) -> list[bytes]:
    return [coder_.decode(x or b"") for x in ids]


def _mapped(df: DataFrame, old: str, path: str, pattern: str, steps: dict) -> DataFrame:
    """``df`` without ``old`` and with a binary column for each step, which takes what the step before it gave."""
    rest = [c for c in df.columns if c != old and c not in steps]
    schema = StructType([*(df.schema[c] for c in rest), *(StructField(name, BinaryType()) for name in steps)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for batch in freed(batches):
            for part in slices(batch, OWN + "text"):
                *columns, values = part.columns
                values = values.to_pylist()
                for step in steps.values():
                    values = step(c, values)
                    columns.append(pa.array(values, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.select(*rest, F.col(old).cast("binary").alias(OWN + "text")).mapInArrow(run, schema)

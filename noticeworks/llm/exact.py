"""Exact dedup against history: a minimal perfect hash over the distinct digests seen before.

A text's digest is the SHA-256 of the text with every run of blanks as one space. The distinct digests of history are
dealt into buckets by hash, so that no bucket is large whatever repeats, and each bucket becomes one row of the index: a minimal
perfect hash (levels of bits; a digest alone at its place of a level takes it, the others go on to the next level), and
as many slots as digests. A slot holds the whole digest, the locator of the row that stays (id, row number) and the number of rows.

A look-up groups what comes in by digest first, hashes each digest to its one possible slot and compares all 32 bytes
there: equal, it repeats history, whose row stays; else it is no member, and the first of its own group stays.

Scale: texts are read once and never shuffled; a digest with a third of all rows is one row after partial aggregation. Verdicts
of groups with over 1 / 100,000 of all rows, hence at most 100,000, go back to the rows by broadcast, the others by a join in which no
key has more rows than that.

Defined results: null counts as empty; of rows with equal text and id one stays (which one of them, their extra columns do
not decide); null ids are later than all others; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import OWN, written
from noticeworks.llm.tokens import mix

#: Digests of a bucket, about, and the bytes of one.
BUCKET, WIDTH = 20_000, 32
#: Bits of a level for each digest that comes to it, and most levels; what is left then is searched for in a list.
GAMMA, LEVELS = 2, 40
#: Groups whose verdicts are broadcast have more than this share of all rows, so there are at most as many as it says.
SHARE, LEAST_HOT = 100_000, 1000


def digest_of(text: str | Column) -> Column:
    """The 32 bytes of the SHA-256 of a text's normal form."""
    text = F.col(text) if isinstance(text, str) else text
    normal = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.sha2(normal.cast("binary"), 256))


def digests(df: DataFrame, id_: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """(id, row, digest) of every row, written; ``row`` names a column of numbers that stay, if ``df`` has one."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    return written(df.select(F.col(id_).alias("id"), number.alias("row"), digest_of(text).alias("digest")), "digests")


def _keys(digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers of each digest (rows of 32 bytes)."""
    words = np.ascontiguousarray(digest).view("<u8")
    return words[:, 0].astype(np.uint64), words[:, 1].astype(np.uint64)


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(a + b * np.uint64(2 * level + 1)) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """Numbers n digests from 0 to n - 1. Others get some number, too, or -1: what the slot holds decides."""

    sizes: list[int]  # bits of each level
    bits: np.ndarray  # of all levels, packed
    rest: list[int]  # digests (their numbers in the given order) that no level took

    @classmethod
    def of(cls, digest: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
        """The hash of distinct digests, and which of them is in each slot."""
        a, b = _keys(digest)
        left = np.arange(len(digest))
        sizes, levels, slots = [], [], []
        while len(left) and len(sizes) < LEVELS:
            size = max(64, -(-GAMMA * len(left) // 8) * 8)
            at = _place(a[left], b[left], len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            taken = alone[at]
            slots.append(left[taken][np.argsort(at[taken])])
            sizes.append(size)
            levels.append(alone)
            left = left[~taken]
        bits = np.packbits(np.concatenate(levels)) if levels else np.zeros(0, np.uint8)
        order = np.concatenate([*slots, left]).astype(np.int64)
        return cls(sizes, bits, list(range(len(order) - len(left), len(order)))), order

    def slots(self, digest: np.ndarray, held: np.ndarray) -> np.ndarray:
        """The slot of each digest that ``held`` (the digests by slot) has, -1 for the others."""
        bits = np.unpackbits(self.bits).astype(bool)
        number = np.cumsum(bits) - 1
        a, b = _keys(digest)
        out = np.full(len(digest), -1, np.int64)
        left, base = np.arange(len(digest)), 0
        for level, size in enumerate(self.sizes):
            at = base + _place(a[left], b[left], level, size)
            hit = bits[at]
            out[left[hit]] = number[at[hit]]
            left, base = left[~hit], base + size
        for slot in self.rest:
            out[left[(digest[left] == held[slot]).all(axis=1)]] = slot
        found = out >= 0
        found[found] = (digest[found] == held[out[found]]).all(axis=1)  # every byte
        return np.where(found, out, -1)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH)


def _first(prefix: str = "") -> Column:
    """Sorts rows by id, null ids last, then by number."""
    return F.struct(F.col(prefix + "id").isNull().alias("last"), F.col(prefix + "id").alias("id"), F.col(prefix + "row").alias("row"))


def groups(rows: DataFrame) -> DataFrame:
    """(digest, id, row, n): the first row and the number of rows of each digest."""
    found = rows.groupBy("digest").agg(F.min(_first()).alias("f"), F.count(F.lit(1)).alias("n"))
    return found.select("digest", "f.id", "f.row", "n")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def build_index(rows: DataFrame) -> DataFrame:
    """The index over the digests of ``rows`` (id, row, digest), written: one row per bucket.

    ``buckets`` stands in every row. An index of no rows is empty.
    """
    kind = rows.schema["id"].dataType.simpleString()
    distinct = written(groups(rows), "distinct-digests")
    buckets = max(1, -(-distinct.count() // BUCKET))

    def build(t: pa.Table) -> pa.Table:
        digest = _matrix(t.column("digest"))
        hashed, order = PerfectHash.of(digest)
        t = t.take(pa.array(order)).combine_chunks()
        one = pa.array([0, len(order)], pa.int32())
        return pa.table(
            {
                "bucket": t.column("bucket").slice(0, 1),
                "buckets": pa.array([buckets], pa.int32()),
                "sizes": pa.array([hashed.sizes], pa.list_(pa.int32())),
                "bits": pa.array([hashed.bits.tobytes()], pa.binary()),
                "rest": pa.array([hashed.rest], pa.list_(pa.int32())),
                "held": pa.array([digest[order].tobytes()], pa.binary()),
                **{c: pa.ListArray.from_arrays(one, t.column(c).combine_chunks()) for c in ("id", "row", "n")},
            }
        )

    schema = f"bucket int, buckets int, sizes array<int>, bits binary, rest array<int>, held binary, id array<{kind}>, row array<long>, n array<long>"
    made = distinct.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInArrow(build, schema)
    return written(made, "digest-index")


def look_up(found: DataFrame, index: DataFrame) -> DataFrame:
    """``found`` (see :func:`groups`) with ``member`` and, of members, the slot's ``keep_id``, ``keep_row`` and ``times``.

    Other groups keep their own first row. A bucket's digests are dealt out further where more come in than history has.
    """
    kind = found.schema["id"].dataType.simpleString()
    sized = index.agg(F.max("buckets")).first()[0]
    if sized is None:
        return found.select("*", F.lit(False).alias("member"), F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(0).cast("long").alias("times"))
    parts = max(1, -(-found.count() // (sized * BUCKET)))

    def look(asked: pa.Table, slots: pa.Table) -> pa.Table:
        asked = asked.select(["digest", "id", "row", "n"]).combine_chunks()
        n = len(asked)
        slot = np.full(n, -1, np.int64)
        if n and len(slots):
            s = {c: slots.column(c)[0] for c in slots.column_names}
            held = np.frombuffer(s["held"].as_py(), np.uint8).reshape(-1, WIDTH)
            hashed = PerfectHash(s["sizes"].as_py(), np.frombuffer(s["bits"].as_py(), np.uint8), s["rest"].as_py())
            slot = hashed.slots(_matrix(asked.column("digest")), held)
        member = pa.array(slot >= 0)
        at = pa.array(np.maximum(slot, 0), mask=slot < 0)
        keep = {}
        for name, column in (("keep_id", "id"), ("keep_row", "row"), ("times", "n")):
            own = asked.column(column)
            if not (slot >= 0).any():
                keep[name] = own if name != "times" else pa.array(np.zeros(n, np.int64))
                continue
            of_slot = s[column].values.take(at)
            keep[name] = pc.if_else(member, of_slot, own if name != "times" else pa.scalar(0, pa.int64()))
        return pa.table({**{c: asked.column(c) for c in asked.column_names}, "member": member, **keep})

    schema = f"digest binary, id {kind}, row long, n long, member boolean, keep_id {kind}, keep_row long, times long"
    part = F.pmod(F.xxhash64(F.lit(1), "digest"), F.lit(parts)).cast("int").alias("part")
    left = found.select("*", _bucket(sized).alias("bucket"), part).groupBy("bucket", "part")
    right = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")).groupBy("bucket", "part")
    return left.cogroup(right).applyInArrow(look, schema)


def decide(rows: DataFrame, index: DataFrame, counted: bool) -> DataFrame:
    """(id, row, keep_id, group_size, kept, member, digest) for each of ``rows`` (id, row, digest).

    History's row stays where the index has the digest. ``counted`` says that ``rows`` hold the rows of history, too; otherwise a
    group's size is its rows here and there.
    """
    verdicts = look_up(written(groups(rows), "groups"), index)
    size = F.col("n") if counted else F.col("n") + F.col("times")
    verdicts = written(verdicts.select("digest", "keep_id", "keep_row", "n", size.alias("group_size"), "member"), "verdicts")
    hot = max(LEAST_HOT, rows.count() // SHARE)
    large = F.broadcast(verdicts.filter(F.col("n") > hot))  # at most SHARE of them
    small = verdicts.filter(F.col("n") <= hot)
    of_large = rows.join(large, "digest")
    of_small = rows.join(large.select("digest"), "digest", "left_anti").join(small, "digest")
    here = (F.col("row") == F.col("keep_row")) & F.col("id").eqNullSafe(F.col("keep_id"))
    kept = here if counted else here & ~F.col("member")
    return of_large.unionByName(of_small).select("id", "row", "keep_id", "group_size", kept.alias("kept"), "member", "digest")


def dedup_exact(df: DataFrame, id_: str = "doc_id", text: str = "text", upto=None) -> DataFrame:
    """Decisions (see :func:`decide`) over the whole of ``df``; rows with an id up to ``upto`` are history.

    By default history is about the lower half of numeric ids. Of equal texts the row of the least id stays.
    """
    rows = digests(df, id_, text)
    if upto is None:
        middle = rows.approxQuantile("id", [0.5], 0.01)
        upto = middle[0] if middle else 0
    return decide(rows, build_index(rows.filter(F.col("id") <= F.lit(upto))), counted=True)


def new_documents(batch: DataFrame, index: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``batch``, with all columns, whose text history does not have; of equal ones the first."""
    row = OWN + "row"
    batch = written(batch.withColumn(row, F.monotonically_increasing_id()), "numbered")  # written, so that numbers stay
    kept = decide(digests(batch, id_, text, row), index, counted=False).filter("kept")
    return batch.join(kept.select(F.col("row").alias(row)).hint("merge"), row, "left_semi").drop(row)

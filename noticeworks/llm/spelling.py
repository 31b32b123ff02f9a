"""Spelling variants by pivotal grams.

Words are the letter runs of all texts, lower-cased in ASCII, with a planted error now and then (see :func:`words_of`), that are long and frequent
enough. Two are near if one inserted, deleted or replaced code point turns one into the other.

Bigrams are ordered by how many words have them, rare ones first. A word's prefix is its three first bigrams in that order, with
all places where they stand. Of the prefix, dynamic programming picks two that do not overlap and are rarest together: the
pivots. One edit spoils at most one of them, so of two near words the one whose prefix ends earlier (or both) has a pivot that
stands in the other's prefix, as far from the beginning if the edit is behind it, as far from the end if it is before it.
The edit is behind the first pivot or before the second, so one look-up for each is enough. A look-up takes the position limits further:
what lies on the gram's other side is alike, and of the edit's side, cut in two, one part is; both go into the key as
hashes. So about half of a word or more stands in each of its keys. Edit distance verifies what is found.

Scale: counts are summed per task before the shuffle. The bigrams, at most the square of an alphabet of 90, are all the driver sees.
Keys that stand for over a 10,000th of the prefix entries, hence at most 10,000, are dealt out by the other word. Long words
are joined by their digests.

Defined results: null and empty texts have no words; a null id counts as an empty one where errors are planted; repeated rows count repeatedly; an
empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import delete_written, freed, slices, written
from noticeworks.llm.tokens import mix

#: Letters of a run once ASCII is lower-cased; least length and count of a word.
RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A run is misspelt where this divides the crc32 of id and run.
MISSPELT = 97
#: Edits, code points of a gram, and grams of a prefix.
EDITS, GRAM = 1, 2
PREFIX = GRAM * EDITS + 1
#: Longer words go by their digest. Entries of the counts kept in a task before they are passed on.
LONG, HELD = 64, 200_000
#: Keys with more than this share of all entries are dealt out, in shares of as many entries.
SHARE, LEAST_HOT = 10_000, 1000
#: Multiplier of the polynomial hash of a word's parts.
BASE, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def words_of(id_: str, text: bytes) -> Counter:
    """How often each word stands in a text of the given id."""
    out: Counter = Counter()
    before = zlib.crc32(f"{id_}:".encode())
    for run, n in Counter(RUN.findall(text.lower().decode())).items():  # bytes: only ASCII is lower-cased
        h = zlib.crc32(run.encode(), before)
        if h % MISSPELT == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LENGTH:
            out[run] += n
    return out


def words(docs: DataFrame, id_: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(k, word, n) of the words that occur ``least`` times; ``k`` is the word, or stands for a long one."""

    def passed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in freed(batches):
            for part in slices(batch, "text"):
                for i, t in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for word, n in words_of(i or "", t or b"").items():
                        counts[word] += n
                if len(counts) > HELD:
                    yield passed(counts)
                    counts = Counter()
        if counts:
            yield passed(counts)

    rows = docs.select(F.col(id_).cast("string").alias("id"), F.col(text).cast("binary").alias("text"))
    found = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    short = F.length("word") <= LONG
    return found.select(F.when(short, F.col("word")).otherwise(F.concat(F.lit("#"), F.sha2(F.col("word").cast("binary"), 256))).alias("k"), "word", "n")


def gram_order(found: DataFrame) -> dict[str, tuple[int, int]]:
    """(rank, words that have it) of every bigram; rare ones first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in freed(batches):
            for w in batch.column(0).to_pylist():
                counts.update({w[i : i + GRAM] for i in range(len(w) - GRAM + 1)})
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"])

    grams = found.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {g: (rank, n) for rank, (n, g) in enumerate(sorted((r["n"], r["gram"]) for r in grams))}


def pivots(places: list[int], weights: list[int], k: int = EDITS + 1, width: int = GRAM) -> list[int]:
    """Which ``k`` of the grams at rising ``places`` do not overlap and have the least weight together.

    best[t][i] is the least weight of t such grams among the first i.
    """
    m = len(places)
    fits = [bisect.bisect_right(places, p - width) for p in places]  # grams that end before the i-th begins
    none = float("inf")
    best: list[list[float]] = [[0] * (m + 1)]
    for t in range(1, k + 1):
        row: list[float] = [none]
        for i in range(m):
            row.append(min(row[i], best[t - 1][fits[i]] + weights[i]))
        best.append(row)
    out, i = [], m
    for t in range(k, 0, -1):
        while best[t][i] == best[t][i - 1]:
            i -= 1
        out.append(i - 1)
        i = fits[i - 1]
    return out[::-1]


class Keys:
    """Under which keys a word stands in the index and is looked up."""

    def __init__(self, order: dict[str, tuple[int, int]]):
        self.order = order
        self.powers = [1]

    def of(self, word: str) -> tuple[int, list[tuple[int, ...]], list[tuple[int, ...]]]:
        """Rank of the prefix's last gram; (rank, length of the shorter word, place, case, hashes of what is alike) of index and look-ups."""
        length = len(word)
        ranked = [self.order[word[i : i + GRAM]] for i in range(length - GRAM + 1)]
        last = sorted(r for r, _ in ranked)[PREFIX - 1]
        places = [i for i, (r, _) in enumerate(ranked) if r <= last]
        hashes = [0]
        for c in word:
            hashes.append((hashes[-1] * BASE + ord(c)) & MASK)
        while len(self.powers) <= length:
            self.powers.append(self.powers[-1] * BASE & MASK)

        def part(i: int, j: int) -> int:
            return (hashes[j] - hashes[i] * self.powers[j - i]) & MASK

        def behind(p: int, least: int) -> Iterator[tuple[int, ...]]:
            """Keys for an edit behind the gram at p, where the shorter word has ``least`` code points."""
            rest = least - p - GRAM
            if rest >= 0:
                cut = (rest + 1) // 2
                yield ranked[p][0], least, p, 0, part(0, p + GRAM + cut), 0
                yield ranked[p][0], least, p, 1, part(0, p + GRAM), part(length - rest + cut, length)

        def before(p: int, least: int) -> Iterator[tuple[int, ...]]:
            """Keys for an edit before it; its place counts from the end."""
            rest = least - (length - p)
            if rest >= 0:
                cut = (rest + 1) // 2
                yield ranked[p][0], least, length - p, 2, part(0, cut), part(p, length)
                yield ranked[p][0], least, length - p, 3, 0, part(p - rest + cut, length)

        lengths = (length, length - 1)
        index = [key for p in places for least in lengths for side in (behind, before) for key in side(p, least)]
        first, second = (places[x] for x in pivots(places, [ranked[p][1] for p in places]))
        probes = [key for p, side in ((first, behind), (second, before)) for least in lengths for key in side(p, least)]
        return last, index, probes


def _mixed(keys: list[tuple[int, ...]]) -> np.ndarray:
    """One 64-bit number for each key; equal ones of different keys only add candidates."""
    out = np.zeros(len(keys), np.uint64)
    for column in zip(*keys, strict=True):
        out = mix(out * np.uint64(BASE) + np.array([c & MASK for c in column], np.uint64))
    return out.view(np.int64)


def _keyed(found: DataFrame, order: dict[str, tuple[int, int]]) -> DataFrame:
    """(k, last, index, probes) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Keys(order)
        for batch in freed(batches):
            for part in slices(batch, "word"):
                made = [keys.of(w.decode()) for w in part.column(1).to_pylist()]
                lists = []
                for x in (1, 2):
                    ends = np.cumsum([0, *(len(m[x]) for m in made)]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(_mixed([key for m in made for key in m[x]]))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([m[0] for m in made], pa.int32()), *lists], ["k", "last", "index", "probes"])

    rows = found.select("k", F.col("word").cast("binary").alias("word"))
    return rows.mapInArrow(run, "k string, last int, index array<long>, probes array<long>")


def candidates(keyed: DataFrame) -> DataFrame:
    """(a, b) of the words that meet under a key; a pair may come more than once."""
    index = keyed.select(F.col("k").alias("b"), F.col("last").alias("last_b"), F.explode("index").alias("key"))
    probes = keyed.select(F.col("k").alias("a"), F.col("last").alias("last_a"), F.explode("probes").alias("key"))
    total = keyed.agg(F.sum(F.size("index"))).first()[0] or 0
    most = max(LEAST_HOT, total // SHARE)
    heavy = index.groupBy("key").count().filter(F.col("count") > most)
    heavy = F.broadcast(written(heavy.select("key", F.ceil(F.col("count") / most).cast("int").alias("shares")), "heavy-keys"))  # at most SHARE rows
    shares = F.coalesce("shares", F.lit(1))
    index = index.join(heavy, "key", "left").withColumn("share", F.pmod(F.xxhash64("b"), shares).cast("int")).drop("shares")
    probes = probes.join(heavy, "key", "left").withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("shares")
    return probes.join(index, ["key", "share"]).filter("last_a <= last_b AND a <> b").select("a", "b")


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    low, high = 0, len(a)  # around the length of what both begin with
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def _long_pairs(met: DataFrame, found: DataFrame) -> DataFrame:
    """Near ones of the pairs with a word that goes by its digest; Spark's edit distance takes long with words that long."""
    texts = found.filter(F.length("word") >= LONG).select("k", "word")  # one of 64 may be near one of 65

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            near = [one_edit(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    rows = met.distinct().join(texts.toDF("a", "word_a"), "a").join(texts.toDF("b", "word_b"), "b")
    return rows.select("a", "b", "word_a", "word_b").mapInArrow(run, "a string, b string")


def near_pairs(found: DataFrame) -> DataFrame:
    """(a, b) of near words of ``found`` (k, word), by their ``k``, in both directions."""
    keyed = written(_keyed(found, gram_order(found)), "gram-keys")
    met = candidates(keyed)
    long = F.col("a").startswith("#") | F.col("b").startswith("#")
    pairs = met.filter(~long & (F.levenshtein("a", "b", 1) == 1))
    some = keyed.filter(F.col("k").startswith("#")).first()  # without long words their part of the plan is left out
    if some:
        pairs = pairs.union(_long_pairs(met.filter(long), found))
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")
    return pairs.select(both).select("p.a", "p.b").distinct()


def roots(links: DataFrame) -> DataFrame:
    """(k, root): the end of the chain of ``links`` (k, to) from each k. A link leads to a word twice as frequent, so there are no rings."""
    state = written(links, "forms")
    while True:
        further = state.select(F.col("k").alias("to"), F.col("to").alias("next"))
        moved = written(state.join(further, "to", "left").select("k", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("on")), "forms")
        delete_written(state)
        on = moved.agg(F.max("on")).first()[0]
        state = moved.drop("on")
        if not on:
            return state.withColumnRenamed("to", "root")


def variants(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n, form, form_n, n_near, root) of every word of ``docs``.

    ``form`` is the most frequent near word, if it is at least twice as frequent; ``root`` the end of the chain of forms.
    """
    found = written(words(docs, id_, text), "words")
    pairs = written(near_pairs(found), "near-words")
    b = found.select(F.col("k").alias("b"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    best = F.min(F.struct((-F.col("form_n")).alias("order"), "form", "b", "form_n")).alias("best")
    near = pairs.join(b, "b").groupBy("a").agg(best, F.count("*").alias("n_near"))
    out = found.join(near, F.col("k") == F.col("a"), "left")
    strong = F.col("best.form_n") >= 2 * F.col("n")
    out = out.select(
        "k", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *(F.when(strong, F.col(f"best.{c}")).alias(name) for c, name in (("form", "form"), ("form_n", "form_n"), ("b", "to"))),
    )
    out = written(out, "forms-of-words")
    ends = roots(out.filter("to IS NOT NULL").select("k", "to"))
    ends = ends.join(found.select(F.col("k").alias("root"), F.col("word").alias("root_word")), "root").select("k", "root_word")
    return out.join(ends, "k", "left").select("word", "n", "form", "form_n", "n_near", F.coalesce("root_word", "word").alias("root"))

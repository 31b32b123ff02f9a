"""Language identification in two levels: the family first, then one-versus-one linear SVMs within it.

A text is the vector of its hashed byte n-grams (of lower-cased words, blanks and everything that is no letter
counting as one blank), scaled to length one. A multinomial linear model predicts the family; of the
languages of that family, each pair has a linear support vector machine, and the most wins decide. Families
come from a fixed table; a language not in it is a family by itself.

Learning takes at most about ``SAMPLE`` labelled rows, chosen by a hash of the id. Defined results: a null text or
one without a letter is ``und`` with score 0; a null language teaches nothing; without labelled rows
everything is ``und``; ties go to the language first in the alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from noticeworks.llm.common import OWN, freed, may_learn, slices
from noticeworks.llm.tokens import mix

#: Rows to learn from, at most about; buckets of hashed n-grams.
SAMPLE, BUCKETS = 4000, 4096
UNKNOWN = "und"

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy lb af".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk bg sr hr sl mk".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz".split(),
    "indic": "hi bn ur mr gu pa ne".split(),
    "semitic": "ar he am".split(),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], lang)


def vectors(texts: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """Hashed 2-, 3- and 4-grams of bytes, square roots of counts scaled to length one; a row for each text."""
    raw = np.frombuffer(b" " + b" ".join([*texts, b""]).lower(), np.uint8)
    letter = (raw >= 128) | ((raw >= 97) & (raw <= 122))
    keep = letter | np.concatenate(([True], letter[:-1]))  # of a run of other signs, the first
    place = np.cumsum(np.concatenate(([1], np.fromiter(map(len, texts), np.int64, len(texts)) + 1)))
    kept = np.concatenate(([0], np.cumsum(keep)))
    edges = kept[np.minimum(place, len(raw))]
    codes = np.where(letter, raw, 32)[keep].astype(np.uint64)
    of = np.repeat(np.arange(len(texts)), np.diff(edges))
    codes = codes[edges[0] :]
    out = np.zeros(len(texts) * buckets)
    gram = codes.copy()
    for n in (2, 3, 4):
        gram = gram[:-1] << np.uint64(8) | codes[n - 1 :]
        own = of[n - 1 :] == of[: len(gram)]  # not on into the next text
        h = (mix(gram[own] + np.uint64(n << 40)) & np.uint64(buckets - 1)).astype(np.int64)
        out += np.bincount(of[: len(gram)][own] * buckets + h, minlength=len(out))
    out = np.sqrt(out.reshape(len(texts), buckets))
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def softmax_model(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 200, rate: float = 4.0, decay: float = 1e-4) -> np.ndarray:
    """Weights (classes, features + 1) of a multinomial linear model, by full gradient steps with momentum."""
    x = np.column_stack((x, np.ones(len(x), np.float32)))
    w, v, target = np.zeros((classes, x.shape[1]), np.float32), 0, np.eye(classes, dtype=np.float32)[y]
    for _ in range(steps):
        z = x @ w.T
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        v = 0.9 * v - rate * ((p - target).T @ x / len(x) + decay * w)
        w = w + v
    return w


def svm(x: np.ndarray, sign: np.ndarray, c: float = 5.0, passes: int = 20) -> np.ndarray:
    """Weights (features + 1) of a linear support vector machine, by dual coordinate descent."""
    x = np.column_stack((x, np.ones(len(x), np.float32))).astype(np.float64)
    rng, w, alpha = np.random.default_rng(1), np.zeros(x.shape[1]), np.zeros(len(x))
    size = (x * x).sum(axis=1)
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(x)):
            new = min(c, max(0.0, alpha[i] - (sign[i] * (x[i] @ w) - 1) / size[i]))
            if new != alpha[i]:
                w += (new - alpha[i]) * sign[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w.astype(np.float32)


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    members: list[list[str]] = field(default_factory=list)
    of_family: np.ndarray | None = None
    pairs: dict[tuple[int, int, int], np.ndarray] = field(default_factory=dict)  # family, language, language

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each vector: the family's share times the share of wins, softened by margins."""
        x = np.column_stack((x, np.ones(len(x), np.float32)))
        z = x @ self.of_family.T
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        langs, scores = np.empty(len(x), object), p.max(axis=1).astype(float)
        for f, members in enumerate(self.members):
            own = np.flatnonzero(best == f)
            if not len(own):
                continue
            wins, sure = np.zeros((len(own), len(members))), np.zeros((len(own), len(members)))
            for a, b in combinations(range(len(members)), 2):
                margin = x[own] @ self.pairs[f, a, b]
                wins[:, a] += margin >= 0
                wins[:, b] += margin < 0
                chance = 1 / (1 + np.exp(-2 * np.clip(margin, -20, 20)))
                sure[:, a] += chance
                sure[:, b] += 1 - chance
            top = wins.argmax(axis=1)
            langs[own] = np.array(members, object)[top]
            if len(members) > 1:
                scores[own] *= sure[np.arange(len(own)), top] / (len(members) - 1)
        return langs.tolist(), np.clip(scores, 0, 1)


def fit(x: np.ndarray, y: list[str]) -> Model:
    langs = sorted(set(y))
    families = sorted({family(c) for c in langs})
    members = [[c for c in langs if family(c) == f] for f in families]
    y = np.array(y, object)
    of = np.array([families.index(family(c)) for c in y])
    model = Model(families, members, softmax_model(x, of, len(families)))
    for f, own in enumerate(members):
        for a, b in combinations(range(len(own)), 2):
            rows = np.flatnonzero((y == own[a]) | (y == own[b]))
            model.pairs[f, a, b] = svm(x[rows], np.where(y[rows] == own[a], 1.0, -1.0))
    return model


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model of the labelled documents that may be learnt from; None if there are none."""
    known = docs.filter(may_learn() & F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)))
    total = docs.filter(may_learn() & F.col("lang").isNotNull()).count()
    share = min(1.0, sample / max(total, 1))
    if share < 1:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            for part in slices(batch, OWN + "text"):
                x = vectors(part.column(1).to_pylist()).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"])

    rows = known.select("lang", F.col("text").cast("binary").alias(OWN + "text"))
    got = rows.mapInArrow(run, "lang string, x binary").toArrow()
    if not got.num_rows:
        return None
    x = np.frombuffer(b"".join(v.as_py() for v in got.column(1)), np.float16).reshape(got.num_rows, -1)
    return fit(x.astype(np.float32), got.column(0).to_pylist())


def with_language(df: DataFrame, model: Model | None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (0 to 1), in place of columns of those names."""
    names = [c for c in df.columns if c not in ("lang_pred", "score") and (keep_text or c != text)]
    schema = df.select(*names).schema.add(StructField("lang_pred", StringType())).add(StructField("score", DoubleType()))
    has = F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False))
    rows = df.select(*names, F.when(has, F.col(text).cast("binary")).alias(OWN + "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            for part in slices(batch, OWN + "text", 1 << 20):
                texts = part.column(len(names)).to_pylist()
                own = [i for i, t in enumerate(texts) if t is not None] if model else []
                langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                for k in range(0, len(own), 256):
                    some = own[k : k + 256]
                    for i, lang, s in zip(some, *model.predict(vectors([texts[i] for i in some])), strict=True):
                        langs[i], scores[i] = lang, float(s)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(langs), pa.array(scores)], [*names, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)

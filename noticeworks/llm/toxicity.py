"""Toxicity by a weighted finite-state grammar of clauses.

A lexical transducer turns the words of a clause into symbols (insult, threat verb, intent, target,
negation, report, quote). Small transducers rewrite them in turn: within the scope of a negation, after a report
or inside quotes an insult becomes a negated or reported one; near a target it becomes a directed one; an
intent before a threat verb makes a threat. They are composed into one machine, which every clause with an
insult or threat verb runs through. What it puts out is weighed by a logistic model; a word alone has no score.

Insults are a fixed list and stems learnt from labelled documents: beginnings of words, and whole words, that
mark the toxic ones. The learnt part uses at most about ``SAMPLE`` labelled rows, chosen by a hash of the id, and
never more than their texts and labels. Without labels the fixed list and the prior weights stand alone.

Defined results: null and empty texts get the score of a text without matches; a null label teaches nothing, and of
contrary labels of one id the toxic one counts; rows
of one id are scored one by one; extra columns pass through ``with_scores``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from noticeworks.llm.common import freed, may_learn

#: Labelled rows to learn from, at most about; learnt stems, at most; least share of toxic rows that have a stem.
SAMPLE, STEMS, SHARE = 8000, 300, 0.02

# Base word lists of English, French, German and Spanish.
INSULTS = "idiot idiots moron morons scum loser losers stupid worthless pathetic disgusting imbecile dumb trash clown imbécile crétin connard abruti dummkopf trottel abschaum versager estúpido idiota imbécil escoria basura".split()
THREATS = "kill hurt destroy beat murder shoot burn strangle tuer frapper détruire töten schlagen vernichten matar golpear destruir".split()
INTENT = "will ll gonna going should must hope want vais va veux doit werde wird will muss voy va quiero debe".split()
TARGETS = "you your yours u ur they them these those he she him her tu toi vous te ils du dich dir ihr euch sie tú vosotros usted ustedes ellos".split()
NEGATIONS = "not no never t isn wasn aren don doesn didn cannot without ne pas jamais non nicht kein keine nie nunca jamás sin".split()
REPORTS = "said says called calls wrote quoted reported according alleged dit selon écrit sagte laut schrieb nannte dijo según escribió".split()

INSULT, THREAT, INTENDS, TARGET, NEGATION, REPORT, QUOTE, OTHER = "I H M G N R Q O".split()
#: What the composed machine can put out that counts, with the prior weights of the logistic model.
WEIGHTS = {"I": 4.0, "D": 6.0, "n": -0.5, "r": -0.3, "g": 1.0, "T": 6.0, "clauses": 0.5}
BIAS = -4.0
WORD = re.compile(r"\w+|[\"“”«»]")
CLAUSE = re.compile(r"[^.!?;\n]+")


@dataclass
class Transducer:
    """Letter transducer: a missing arc of a state falls back to its arc for None; None as output copies."""

    arcs: dict = field(default_factory=dict)  # (state, symbol) -> (state, output)
    start: object = 0

    def step(self, state, symbol):
        to, out = self.arcs.get((state, symbol)) or self.arcs.get((state, None), (state, None))
        return to, symbol if out is None else out

    def run(self, symbols: list[str]) -> list[str]:
        state, out = self.start, []
        for s in symbols:
            state, o = self.step(state, s)
            out.append(o)
        return out


def compose(first: Transducer, second: Transducer, alphabet: set[str]) -> Transducer:
    """The transducer that feeds what ``first`` puts out to ``second``."""
    out = Transducer({}, (first.start, second.start))
    todo, done = [out.start], {out.start}
    while todo:
        a, b = state = todo.pop()
        for symbol in alphabet:
            to_a, middle = first.step(a, symbol)
            to_b, put = second.step(b, middle)
            out.arcs[state, symbol] = ((to_a, to_b), put)
            if (to_a, to_b) not in done:
                done.add((to_a, to_b))
                todo.append((to_a, to_b))
    return out


def _countdown(on: str, steps: int, rewrite: dict[str, str]) -> Transducer:
    """For ``steps`` symbols after ``on``, the symbols of ``rewrite`` are replaced."""
    t = Transducer({(0, on): (steps, None)})
    for k in range(1, steps + 1):
        t.arcs |= {(k, None): (k - 1, None), (k, on): (steps, None)}
        t.arcs |= {(k, a): (k - 1, b) for a, b in rewrite.items()}
    return t


def grammar() -> Transducer:
    negation = _countdown(NEGATION, 3, {INSULT: "n", THREAT: "x"})
    report = Transducer({(0, REPORT): (1, None), (0, QUOTE): (1, None), (1, QUOTE): (0, None)})
    report.arcs |= {(1, INSULT): (1, "r"), (1, THREAT): (1, "x")}
    before = _countdown(TARGET, 4, {INSULT: "D"})
    after = Transducer({(0, "I"): (2, None), (0, "D"): (2, None)})
    for k in (2, 1):
        after.arcs |= {(k, None): (k - 1, None), (k, "I"): (2, None), (k, "D"): (2, None), (k, TARGET): (0, "g")}
    threat = _countdown(INTENDS, 4, {THREAT: "T"})
    alphabet = {INSULT, THREAT, INTENDS, TARGET, NEGATION, REPORT, QUOTE, OTHER}
    machine = negation
    for part in (report, before, after, threat):
        machine = compose(machine, part, alphabet)
    return machine


@dataclass
class Model:
    """Learnt stems and words with their weights, and the logistic weights of the machine's output."""

    stems: dict[str, float] = field(default_factory=dict)  # "abc*": begins a longer word; "abc": whole word
    bias: float = BIAS
    weights: dict[str, float] = field(default_factory=lambda: dict(WEIGHTS))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.machine = model, grammar()
        self.whole = {w: 1.0 for w in INSULTS} | {w: v for w, v in model.stems.items() if not w.endswith("*")}
        self.begin = {w[:-1]: v for w, v in model.stems.items() if w.endswith("*")}
        self.sizes = sorted({len(w) for w in self.begin})
        self.kinds: dict[str, str] = {'"': QUOTE, "“": QUOTE, "”": QUOTE, "«": QUOTE, "»": QUOTE}
        for kind, words in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (INTENDS, INTENT), (THREAT, THREATS)):
            self.kinds |= dict.fromkeys(words, kind)
        self.finder = ahocorasick.Automaton()
        for w in {*self.whole, *self.begin, *THREATS}:
            self.finder.add_word(w, len(w))
        self.finder.make_automaton()
        self.order = list(WEIGHTS)

    def insult(self, word: str) -> float:
        """Weight of a word as an insult, 0 if it is none."""
        if word in self.whole:
            return self.whole[word]
        return max((self.begin.get(word[:n], 0.0) for n in self.sizes if n < len(word)), default=0.0)

    def _found(self, low: str) -> list[int]:
        """Where a word begins that may be an insult or threat verb."""
        n = len(low)
        out = []
        for end, size in self.finder.iter(low):
            at = end - size + 1
            if at == 0 or not (low[at - 1].isalnum() or low[at - 1] == "_"):
                word = low[at : end + 1]
                longer = end + 1 < n and (low[end + 1].isalnum() or low[end + 1] == "_")
                if (word in self.begin) if longer else (word in self.whole or word in self.kinds):
                    out.append(at)
        return out

    def features(self, text: str) -> list[float]:
        """log(1 + amount) of each symbol that counts, over the clauses that have any."""
        low = text.lower()
        found = self._found(low)
        sums: Counter = Counter()
        k = 0
        for m in CLAUSE.finditer(low, found[0] and max(low.rfind(c, 0, found[0]) for c in ".!?;\n") + 1) if found else ():
            if k < len(found) and found[k] < m.end():
                while k < len(found) and found[k] < m.end():
                    k += 1
                words = WORD.findall(m[0])
                weights = [self.insult(w) for w in words]
                symbols = [INSULT if v else self.kinds.get(w, OTHER) for w, v in zip(words, weights, strict=True)]
                matched = False
                for symbol, v in zip(self.machine.run(symbols), weights, strict=True):
                    if symbol in WEIGHTS:
                        sums[symbol] += v or 1.0
                        matched = True
                sums["clauses"] += matched
            if k == len(found):
                break
        return [math.log1p(sums[c]) for c in self.order]

    def score(self, text: str) -> float:
        z = self.model.bias + sum(self.model.weights[c] * x for c, x in zip(self.order, self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _beginnings(text: str) -> set[str]:
    out = set()
    for w in set(re.findall(r"\w+", text.lower())):
        if len(w) > 2:
            out.add(w)
            out.update(w[:k] + "*" for k in range(3, min(len(w), 9)))
    return out


def _counted(rows: DataFrame) -> DataFrame:
    """(stem, toxic rows, other rows) summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            counts = Counter(), Counter()
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts[bool(toxic)].update(_beginnings(text or ""))
            keys = list({**counts[1], **counts[0]})
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in (counts[1], counts[0]))], ["stem", "t", "n"]
            )

    return rows.select("toxic", "text").mapInArrow(run, "stem string, t long, n long")


def find_stems(rows: DataFrame) -> dict[str, float]:
    """Stems that mark toxic rows, by the log-likelihood ratio; of stems in one another only the best."""
    sizes = dict(rows.groupBy("toxic").count().collect())
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not other:
        return {}
    t, n = F.col("t"), F.col("n")
    p = (t + n) / (toxic + other)
    gain = t * F.log(t / toxic / p) + F.when(n > 0, n * F.log(n / other / p)).otherwise(0.0)
    ratio = F.log((t + 0.5) / (toxic + 1)) - F.log((n + 0.5) / (other + 1))
    counts = _counted(rows).groupBy("stem").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    good = counts.filter(t >= max(3, SHARE * toxic)).select("stem", gain.alias("gain"), ratio.alias("ratio"))
    good = good.filter("ratio > 1.5 AND gain > 8").orderBy(F.desc("gain"), F.desc(F.length("stem")), "stem").limit(20 * STEMS)
    out: dict[str, float] = {}
    for stem, _, r in good.collect():
        body = stem.rstrip("*")
        if len(out) < STEMS and not any(body.startswith(o.rstrip("*")) or o.startswith(body) for o in out):
            out[stem] = min(r, 6.0) / 3
    return out


def fit(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 0.05, steps: int = 60) -> np.ndarray:
    """Weights (bias last) of the logistic model nearest to the prior, by Newton's method."""
    x = np.column_stack((x, np.ones(len(x))))
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (p - y) + strength * (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the labelled documents that may be learnt from."""
    known = labels.filter(may_learn() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    if not total:
        return Model()
    share = min(1.0, sample / total)
    if share < 1:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select("doc_id", "text").join(known, "doc_id").select("toxic", "text")
    model = Model(find_stems(rows))
    scorer_of = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(scorer_of)
        for batch in freed(batches):
            x = [scorer.features(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])

    got = rows.select(F.col("toxic").cast("int"), "text").mapInArrow(run, "toxic int, x array<double>").collect()
    if not got:
        return model
    x, y = np.array([r[1] for r in got]), np.array([r[0] for r in got], float)
    w = fit(x, y, np.array([*WEIGHTS.values(), BIAS]))
    return Model(model.stems, float(w[-1]), dict(zip(WEIGHTS, w[:-1].tolist(), strict=True)))


def with_scores(df: DataFrame, model: Model, text: str = "text", score: str = "score", keep_text: bool = True) -> DataFrame:
    """``df`` with ``score`` from 0 to 1, in place of a column of that name."""
    names = [c for c in df.columns if c != score]
    rest = names if keep_text else [c for c in names if c != text]
    schema = df.select(*rest).schema.add(StructField(score, DoubleType()))
    k = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in freed(batches):
            scores = pa.array([scorer.score(t.as_py() or "") for t in batch.column(k)], pa.float64())
            columns = [c for n, c in zip(names, batch.columns, strict=True) if n in rest]
            yield pa.RecordBatch.from_arrays([*columns, scores], [*rest, score])

    return df.select(*names).mapInArrow(run, schema)

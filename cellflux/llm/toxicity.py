"""Toxic documents by a subsequence-kernel support vector machine (operator 10).

The unit is a word, or a run of single letters read as one. Two units are compared by
the gap-weighted subsequence kernel: they are alike as far as they share triples of characters
in the same order, also with others between them, so `id-i-ot` is near `idiot`. Nyström
landmarks turn the kernel into features, on which a linear support vector machine is fitted.
A sentence is judged by its highest units and a document by its sentences (several-instance
learning): the sentences of clean documents are all negative, and in a toxic document the
units that the machine itself finds are positive. The document's probability follows from its highest
unit, the sum of the high ones and the number of units.

The fitted function is linear in the triples, so that it folds into one table of weights: a word
is scored by looking its own triples up, which is exact and independent of the landmarks.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cellflux.llm.common import id_fold, released, worker_cache

# Bounds of the sample of labelled rows that the machine is fitted on. Rows with longer texts are left out of what was picked.
FIT_TOXIC = 1200
FIT_CLEAN = 2400
FIT_CHARS = 20_000  # longer texts are scored whole, but not fitted on
# Bounds within the fit, so that its time is bounded too; scoring has none.
FIT_CANDIDATES = 1000  # units among which landmarks are spread
FIT_NEGATIVES = 15_000  # units of clean documents, drawn at random
FIT_SUSPECTED = 2000  # clean documents against which the first suspects are counted
FIT_STRETCHED = 2000  # suspect units that are also shown with a character put in
FIT_HARD = 5000  # clean units that the machine takes for toxic, added after a round
LANDMARKS = 192
ROUNDS = 3

_SPAN = 6  # characters that a triple may reach over
_DECAY = 0.6
_SYMBOLS = 128
_WIDTH = 32  # longer units are read in overlapping parts of this width
_STRIDE = _WIDTH - _SPAN + 1
_PAIRS = [(a, b) for b in range(2, _SPAN) for a in range(1, b)]
_WEIGHTS = np.array([_DECAY ** (b - 2) for b in range(2, _SPAN)], dtype=np.float32)
_CACHE = 120_000
_FLOOR = -2.0  # the score of nothing
_HIGH = -0.3  # units above this count towards a document's sum

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_MARKS = re.compile(r"[\W_]+")
_LETTERS = re.compile(r"(?:(?<=\s)|^)\w(?:\s+\w(?!\w)){3,}")


def units(text: str | None) -> set[str]:
    """Distinct lower-case words without the marks around them, and spelled-out words."""
    text = (text or "").lower()
    found = set(text.split())
    found.update("".join(m.split()) for m in _LETTERS.findall(text))
    return found


def _symbols() -> np.ndarray:
    """A number from 2 up for each character below 65536; 0 is padding, 1 a unit's start.

    Latin letters have numbers of their own, all digits share one, the rest share what is left: characters of other
    scripts that are 66 apart are one to the machine, so that it tells insults in those scripts apart less well.
    """
    table = 62 + np.arange(65536) % (_SYMBOLS - 62)
    table[ord("a") : ord("z") + 1] = 2 + np.arange(26)
    table[0xE0:0x100] = 28 + np.arange(32)
    table[0xDF] = 60
    table[ord("0") : ord("9") + 1] = 61
    return table


_TABLE = _symbols()


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of symbols, and the word that each row belongs to.

    A word with marks inside has a second reading without them, which comes first.
    """
    rows, owner = [], []

    def read(reading: str, number: int) -> None:
        for at in range(0, max(1, len(reading) - _SPAN + 1), _STRIDE):
            rows.append(reading[at : at + _WIDTH])
            owner.append(number)

    for number, word in enumerate(words):
        marked = "\0" + _EDGES.sub("", word)
        if not word.isalnum() and (plain := "\0" + _MARKS.sub("", word)) != marked:
            read(plain, number)
        read(marked, number)
    flat = "".join(r.ljust(_WIDTH, "￿") for r in rows)
    points = np.frombuffer(flat.encode("utf-32-le", "replace"), np.uint32)
    codes = _TABLE[points % 65536]
    codes = np.where(points == 0xFFFF, 0, np.where(points == 0, 1, codes))
    return codes.reshape(len(rows), _WIDTH), np.array(owner)


def _triples(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, triple and summed weight, one entry per row and distinct triple."""
    width = max(3, int((codes > 0).sum(1).max(initial=0)))
    codes = np.pad(codes[:, :width], ((0, 0), (0, _SPAN)))
    keys = []
    for a, b in _PAIRS:
        first, second, third = codes[:, :width], codes[:, a : width + a], codes[:, b : width + b]
        triple = (first * _SYMBOLS + second) * _SYMBOLS + third
        keys.append(np.where(third > 0, triple * 4 + (b - 2), -1))
    keys = np.concatenate(keys, axis=1)
    keys.sort(axis=1)
    rows, at = np.nonzero(keys >= 0)
    flat = keys[rows, at]
    triple, weight = flat >> 2, _WEIGHTS[flat & 3]
    if not len(flat):
        return rows, triple, weight
    new = np.flatnonzero(np.r_[True, (np.diff(triple) != 0) | (np.diff(rows) != 0)])
    return rows[new], triple[new], np.add.reduceat(weight, new)


@dataclass(frozen=True)
class Machine:
    """`table`: weight of each triple; `coefficients`: from a document's facts to its log odds."""

    table: np.ndarray
    bias: float
    coefficients: tuple[float, ...]

    def unit_scores(self, words: list[str]) -> np.ndarray:
        """Decision value of each unit: kernel to the landmarks, normalised; `_FLOOR` if it has no triple."""
        out = np.full(len(words), _FLOOR, dtype=np.float64)
        for at in range(0, len(words), 1024):
            codes, owner = _codes(words[at : at + 1024])
            rows, triple, weight = _triples(codes)
            dot = np.bincount(rows, weight * self.table[triple], len(codes))
            norm = np.bincount(rows, weight * weight, len(codes))
            value = np.where(norm > 0, dot / np.sqrt(np.maximum(norm, 1e-12)) + self.bias, _FLOOR)
            np.maximum.at(out, at + owner, np.clip(value, _FLOOR, -_FLOOR))
        return out

    def probability(self, facts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(facts @ np.array(self.coefficients), -40, 40)))


def _facts(scores: list[float]) -> tuple[float, float, float, float]:
    """Highest unit, sum of the high ones, number of units, and 1."""
    if not scores:
        return _FLOOR, 0.0, 0.0, 1.0
    high = sum(v - _HIGH for v in scores if v > _HIGH)
    return max(scores), math.log1p(high), math.log1p(len(scores)), 1.0


def _features(words: list[str], places: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Normalised kernel of each word (its first part) with each landmark."""
    out = np.zeros((len(words), marks.shape[1]), np.float32)
    for at in range(0, len(words), 2048):
        codes, owner = _codes(words[at : at + 2048])
        codes = codes[np.r_[True, np.diff(owner) != 0]]
        rows, triple, weight = _triples(codes)
        norm = np.sqrt(np.bincount(rows, weight * weight, len(codes)))
        place = places[triple]
        rows, place, weight = rows[place >= 0], place[place >= 0], weight[place >= 0]
        if not len(rows):
            continue
        start = np.flatnonzero(np.r_[True, np.diff(rows) != 0])
        sums = np.add.reduceat(marks[place] * weight[:, None], start, axis=0)
        out[at + rows[start]] = sums / np.maximum(norm[rows[start]], 1e-6)[:, None]
    return out


def _landmark_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Place of each triple among those of the landmarks, and their normalised weights."""
    codes, owner = _codes(words)
    codes = codes[np.r_[True, np.diff(owner) != 0]]
    rows, triple, weight = _triples(codes)
    norm = np.sqrt(np.bincount(rows, weight * weight, len(codes)))
    seen, inverse = np.unique(triple, return_inverse=True)
    places = np.full(_SYMBOLS**3, -1, np.int64)
    places[seen] = np.arange(len(seen))
    marks = np.zeros((len(seen), len(words)), np.float32)
    marks[inverse, rows] = weight / np.maximum(norm[rows], 1e-6)
    return places, marks


def _suspects(toxic: list[set[str]], clean: list[set[str]]) -> list[list[str]]:
    """Per toxic document, the units with the parts that most set toxic documents apart.

    Only a start for the machine: four-character parts, by their document counts on both sides.
    """

    def parts(word: str) -> set[str]:
        word = "\0" + _EDGES.sub("", word)
        return {word[i : i + 4] for i in range(max(1, len(word) - 3))}

    def counts(documents: list[set[str]]) -> Counter:
        total: Counter = Counter()
        for words in documents:
            total.update(set().union(*map(parts, words)) if words else ())
        return total

    inside, outside = counts(toxic), counts(clean)
    ratio = len(clean) / max(1, len(toxic))

    def weight(part: str) -> float:
        n = inside[part]
        return np.log((n + 0.1) * ratio / (outside[part] + 1.0)) * min(1.0, n / 3)

    weights = {p: weight(p) for p in inside}
    picked = []
    for words in toxic:
        ranked = sorted(((max(weights[p] for p in parts(w)), w) for w in words), reverse=True)
        picked.append([w for value, w in ranked[:3] if ranked and value >= 0.7 * ranked[0][0]])
    return picked


def _spread(words: list[str], number: int) -> list[str]:
    """Words far from each other: each next one is the least like all those before."""
    if len(words) <= number:
        return words
    words = words[:FIT_CANDIDATES]
    places, marks = _landmark_rows(words)
    taken, near = [0], marks.T @ marks[:, 0]
    while len(taken) < number:
        taken.append(int(np.argmin(near)))
        near = np.maximum(near, marks.T @ marks[:, taken[-1]])
    return [words[i] for i in taken]


def _solve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last entry is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    eye = ridge * np.eye(x.shape[1])
    eye[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(20):
        active = y * (x @ w) < 1
        part = x[active] * weight[active, None]
        new = np.linalg.solve(eye + part.T @ x[active], part.T @ y[active])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def _logistic(facts: np.ndarray, label: np.ndarray) -> tuple[float, ...]:
    """Coefficients of a logistic regression, with a weak pull to a plain start."""
    prior, pull = np.array([3.0, 1.0, 0.0, -2.0]), 0.1 * np.eye(4)
    w = prior.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(facts @ w, -30, 30)))
        slope = (facts * (p * (1 - p))[:, None]).T @ facts + pull
        step = np.linalg.solve(slope, facts.T @ (label - p) - pull @ (w - prior))
        w += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(x) for x in w)


def _stretched(words: list[str], draw: np.random.Generator) -> list[str]:
    """The words with one more character inside, as an evasive writer would put it."""
    added = "xaeiou0*"
    out = []
    for word in words:
        if len(word) > 3:
            at = int(draw.integers(1, len(word)))
            out.append(word[:at] + added[int(draw.integers(len(added)))] + word[at:])
    return out


def fit(
    texts: list[str], labels: list[int], landmarks: int = LANDMARKS, rounds: int = ROUNDS
) -> Machine:
    """Fit on texts labelled 0 or 1. Without either label, all scores are that label's share."""
    flat = np.zeros(_SYMBOLS**3, np.float32)
    share = (sum(labels) + 0.5) / (len(labels) + 1) if labels else 0.0
    toxic = [units(t) for t, y in zip(texts, labels, strict=True) if y]
    clean = [units(t) for t, y in zip(texts, labels, strict=True) if not y]
    toxic = [w for w in toxic if w]
    if not toxic or not any(clean):
        odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6)) if labels else -5.0
        return Machine(flat, 0.0, (0.0, 0.0, 0.0, float(odds)))
    # The last third is not fitted on but sets the probabilities, if there are enough rows.
    hold_t, hold_c = (len(toxic) // 3, len(clean) // 3) if len(toxic) >= 60 else (0, 0)
    fit_t, fit_c = toxic[hold_t:], clean[hold_c:]
    draw = np.random.default_rng(7)
    negative = sorted(set().union(*fit_c))
    sample = [negative[i] for i in draw.permutation(len(negative))[:FIT_NEGATIVES]]
    hard: set[str] = set()
    suspects = _suspects(fit_t, fit_c[:FIT_SUSPECTED])
    machine = None
    for _ in range(rounds):
        clean_words = set(negative)
        positive = Counter(w for words in suspects for w in words if w not in clean_words)
        if not positive:
            break
        common = [w for w, _ in positive.most_common()]
        chosen = _spread(common, landmarks * 3 // 4)
        chosen = chosen + _spread([w for w in sample if w not in positive], landmarks - len(chosen))
        places, marks = _landmark_rows(chosen)
        gram = (marks.T @ marks).astype(np.float64)
        size, vector = np.linalg.eigh(gram)
        keep = size > 1e-4
        root = (vector[:, keep] / np.sqrt(size[keep])).astype(np.float32)
        wanted = common + [w for w in _stretched(common[:FIT_STRETCHED], draw) if w not in clean_words]
        words = wanted + sample + sorted(hard)
        y = np.r_[np.ones(len(wanted)), -np.ones(len(words) - len(wanted))]
        weight = np.where(y > 0, max(1.0, 0.3 * len(sample) / len(wanted)), 1.0)
        w = _solve(_features(words, places, marks) @ root, y, weight)
        table = flat.copy()
        table[places >= 0] = (marks @ (root @ w[:-1]))[places[places >= 0]]
        machine = Machine(table, float(w[-1]), (4.0, 0.0, 0.0, 0.0))
        scores = machine.unit_scores(negative)
        order = np.argsort(-scores)[:FIT_HARD]
        hard |= {negative[i] for i in order if scores[i] > -0.7}
        suspects = []
        known = sorted(set().union(*fit_t))
        value = dict(zip(known, machine.unit_scores(known).tolist(), strict=True))
        for words in fit_t:
            best = max(map(value.__getitem__, words))
            suspects.append(sorted(w for w in words if value[w] >= (max(0.0, 0.6 * best) if best > 0 else best)))
    if machine is None:
        return Machine(flat, 0.0, (0.0, 0.0, 0.0, float(np.log(share / (1 - share)))))
    sides = (toxic[:hold_t], clean[:hold_c]) if hold_t else (toxic, clean)
    facts = [_facts(machine.unit_scores(sorted(w)).tolist()) for side in sides for w in side]
    label = np.r_[np.ones(len(sides[0])), np.zeros(len(sides[1]))]
    return Machine(machine.table, machine.bias, _logistic(np.array(facts), label))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, fold: int = 0, toxic: int = FIT_TOXIC, clean: int = FIT_CLEAN
) -> DataFrame:
    """At most `toxic` and `clean` labelled rows outside the held-out fold, by a hash of the id.

    Ids are picked from the labels alone; only their texts are then read, by a join
    with a table that these bounds keep small. Of several labels of an id the highest
    counts; rows without id, label or text take no part.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .filter(id_fold("doc_id") != fold)
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.filter("toxic = 1").orderBy(*order).limit(toxic).unionByName(
        known.filter("toxic = 0").orderBy(*order).limit(clean)
    )
    texts = documents.filter(F.length("text") <= FIT_CHARS).select("doc_id", "text")
    # One text per id, so that the bounds hold however often an id repeats.
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(one)


def fitted(documents: DataFrame, labels: DataFrame, fold: int = 0) -> Machine:
    rows = labelled_sample(documents, labels, fold).collect()
    rows.sort(key=lambda r: (zlib.crc32(f"{r.doc_id}:fit".encode()), r.text))
    return fit([r.text for r in rows], [r.toxic for r in rows])


def scored(documents: DataFrame, machine: Machine, column: str = "_toxicity") -> DataFrame:
    """Documents with the probability of being toxic, from the whole text.

    All columns stay (one named like `column` is replaced). A missing or empty text scores as one without
    any unit. One pass, no shuffle; the machine is a table of fixed size.
    """
    documents = documents.drop(column)
    sent = documents.sparkSession.sparkContext.broadcast(machine)
    name = f"toxicity:{machine.bias!r}:{machine.coefficients!r}:{float(np.abs(machine.table).sum())!r}"
    schema = StructType([*documents.schema.fields, StructField(column, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        known = worker_cache(name)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                split = [units(t) for t in part.column("text").to_pylist()]
                if len(known) > _CACHE:
                    known.clear()
                new = [w for w in set().union(*split) if w not in known]
                known.update(zip(new, model.unit_scores(new).tolist(), strict=True))
                facts = [_facts([known[w] for w in words]) for words in split]
                score = pa.array(model.probability(np.array(facts)), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, score], names=[*part.schema.names, column]
                )

    return documents.mapInArrow(lambda batches: released(run(batches)), schema)

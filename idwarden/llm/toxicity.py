"""Toxicity: a sparse logistic model over the words of a text, regularised by counterfactual pairs.

A labelled text that names a group (a term of ``groups``) is paired with its counterfactuals: the same text with the
term swapped for another of its group, and with the term left out. The loss adds ``pair_weight`` times the squared
change of the logit over all pairs, so that no group term moves the score, whichever texts mention it.

Features are the words of a text (runs of letters, digits and bytes beyond ASCII; A-Z lower-cased) and their stems (the
first ``STEM`` bytes), each as found once, twice or four times at least, hashed to ``BITS`` bits. Fitting takes the ``features`` words that separate the labels best, by z score, and an L1 penalty.
Fitting works on a bounded sample (``labelled.TRAIN_ROWS``), scoring on every row and whole texts.

NULL and empty texts have no words and get the score of the intercept. Without both labels in the sample the score is
the share of label 1 (0 without rows).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idwarden.llm.arrays import Texts, Words, binaries, binary_values, starts_of, with_columns
from idwarden.llm.labelled import held_out, training_rows
from idwarden.llm.passing import packed, unpacked, widened
from idwarden.llm.store import tidy

BITS, STEM = 22, 6
#: Times a word is found, at least, for each of its features.
TIMES = (1, 2, 4)
FEATURES = 4000
L1, PAIR_WEIGHT = 2e-4, 5.0

#: Terms that name groups of people, by kind of group.
GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "african", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young", "elderly"),
    ("disabled", "deaf", "blind"),
)

_codes = np.arange(256)
#: Bytes that end a word of the classifier.
APART = ~((_codes >= 128) | ((_codes >= 48) & (_codes < 58)) | ((_codes >= 65) & (_codes < 91)) | ((_codes >= 97) & (_codes < 123)))


def _word_ids(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Row and first feature of each word and of each stem; the features of more times follow it."""
    words = Words(texts, APART)
    whole = words.hashes(lower=True)
    words.ends = np.minimum(words.ends, words.starts + STEM)
    stems = words.hashes(lower=True) * np.uint64(0x9E3779B97F4A7C15)
    ids = np.concatenate([whole, stems]) >> np.uint64(64 - (BITS - 2))
    return np.tile(words.rows, 2), ids.astype(np.int64) << 2


def _features(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the features that hold in them, each once."""
    key, times = np.unique(rows << BITS | ids, return_counts=True)
    key = np.concatenate([key[times >= least] + k for k, least in enumerate(TIMES)])
    key.sort()
    return key >> BITS, key & ((1 << BITS) - 1)


def _term_ids(groups) -> list[np.ndarray]:
    """For each group, the first features of each term, as a word and as a stem."""
    return [_word_ids(Texts(pa.array(list(group))))[1].reshape(2, -1).T for group in groups]


@dataclass(frozen=True)
class Model:
    intercept: float
    weights: dict[int, float]


def examples(rows: DataFrame) -> DataFrame:
    """label and the distinct features of each text, as binary int32."""

    def run(batches):
        for batch in batches:
            texts = Texts(batch.column("text"))
            for first, end in texts.slices():
                rows, ids = _features(*_word_ids(texts.piece(first, end)))
                offsets = starts_of(np.bincount(rows, minlength=end - first)) * 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(first, end - first).cast(pa.int32()), binaries(ids.astype("<i4"), offsets)],
                    names=["label", "features"],
                )

    return rows.mapInArrow(tidy(run), "label int, features binary")


def counterfactuals(ids: np.ndarray, rows: np.ndarray, groups) -> dict[tuple[tuple[int, int], ...], int]:
    """Changes of features that the counterfactuals of the texts make, as (feature, +1 or -1), and how many texts each change concerns."""
    found: dict[tuple, int] = {}
    for terms in _term_ids(groups):
        for k, term in enumerate(terms.tolist()):
            of = np.array([t + n for t in term for n in range(len(TIMES))])
            place = np.flatnonzero(np.isin(ids, of))
            holds: dict[int, list[int]] = {}
            for row, feature in zip(rows[place].tolist(), ids[place].tolist()):
                holds.setdefault(row, []).append(feature)
            for features in holds.values():
                if term[0] not in features:  # another word of the same stem
                    continue
                for other in [*terms[:k].tolist(), *terms[k + 1:].tolist(), None]:
                    change: dict[int, int] = {}
                    for f in features:
                        change[f] = change.get(f, 0) + 1
                        if other is not None:
                            kind = 0 if f & ~3 == term[0] else 1
                            new = other[kind] + (f & 3)
                            change[new] = change.get(new, 0) - 1
                    key = tuple(sorted((f, c) for f, c in change.items() if c))
                    if key:
                        found[key] = found.get(key, 0) + 1
    return found


def fit(rows: DataFrame, groups=GROUPS, pair_weight: float = PAIR_WEIGHT, l1: float = L1, features: int = FEATURES,
        rounds: int = 400) -> Model:
    """Fit on ``text`` and ``label`` of a bounded table."""
    got = examples(rows).toArrow()
    y = got.column("label").to_numpy().astype(float)
    n = len(y)
    if n == 0 or y.min() == y.max():
        share = min(max(float(y.mean()) if n else 0.0, 1e-6), 1 - 1e-6)
        return Model(float(np.log(share / (1 - share))), {})
    ids, counts = zip(*(binary_values(chunk, "<i4") for chunk in got.column("features").chunks))
    ids, row = np.concatenate(ids), np.repeat(np.arange(n, dtype=np.int32), np.concatenate(counts))
    del got, counts
    order = np.lexsort((ids, y[row]))  # a fixed order, whichever way the rows arrive
    ids, row = ids[order], row[order]
    del order

    # Only features that occur are numbered, not all that the hash allows.
    names, code, total = np.unique(ids, return_inverse=True, return_counts=True)
    positive = np.bincount(code[y[row] == 1], minlength=len(names))
    p, q = y.mean(), 1 - y.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        z = np.abs(positive - total * p) / np.sqrt(total * p * q)
    z[total < 5] = 0
    pairs = counterfactuals(ids, row, groups)
    terms = sorted({f for change in pairs for f, _ in change})
    chosen = np.argsort(-z, kind="stable")[:features]
    chosen = np.union1d(names[chosen[z[chosen] > 0]], np.array(terms, names.dtype)).astype(np.int64)
    place = {f: k for k, f in enumerate(chosen.tolist())}
    inside = np.isin(names, chosen)[code]
    col, row = np.searchsorted(chosen, ids[inside]), row[inside]
    del ids, code, inside
    m = len(chosen)

    changes = sorted(pairs)
    of = np.repeat(np.arange(len(changes)), [len(c) for c in changes])
    feature = np.array([place[f] for c in changes for f, _ in c], np.int64)
    sign = np.array([x for c in changes for _, x in c], float)
    weight = np.array([pairs[c] for c in changes]) * (pair_weight / n)

    # Accelerated proximal gradient; the step comes from a bound of the curvature.
    length = np.bincount(of, np.abs(sign), minlength=len(changes))
    steepest = np.bincount(feature, np.abs(sign) * (weight * length)[of], minlength=m).max(initial=0)
    step = 1 / (0.25 * _curvature(row, col, n, m) + 2 * steepest + 1e-9)
    w = np.zeros(m)
    b = float(np.log(p / q))
    v, c, t = w.copy(), b, 1.0
    for _ in range(rounds):
        score = c + np.bincount(row, v[col], minlength=n)
        residual = 1 / (1 + np.exp(-score)) - y
        gradient = np.bincount(col, residual[row], minlength=m) / n
        change = 2 * weight * np.bincount(of, sign * v[feature], minlength=len(changes))
        gradient += np.bincount(feature, sign * change[of], minlength=m)
        new = v - step * gradient
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        new_b = c - step * float(residual.mean())
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / new_t * (new - w)
        c = new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new, new_b, new_t
    return Model(float(b), {int(i): float(x) for i, x in zip(chosen, w) if x})


def _curvature(row, col, n, m, rounds: int = 20):
    """The largest eigenvalue of the features' second moments, intercept included, by power iteration."""
    x = np.ones(m + 1)
    value = 1.0
    for _ in range(rounds):
        x /= np.linalg.norm(x)
        s = x[m] + np.bincount(row, x[col], minlength=n)
        x = np.append(np.bincount(col, s[row], minlength=m), s.sum()) / n
        value = float(np.linalg.norm(x))
    return 1.1 * value


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the toxicity of each text in ``out``, 0 to 1. A column of that name is replaced."""
    rows = packed(docs, text, without=(out,))
    schema = widened(rows, {out: T.DoubleType()})
    ids = np.array(sorted(model.weights), np.int64)
    values = np.array([model.weights[i] for i in ids.tolist()])
    intercept = model.intercept

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        weight = np.zeros(1 << BITS)
        weight[ids] = values
        heavy = np.zeros(1 << BITS, bool)  # by first feature: whether any of the word's features weighs
        heavy[ids & ~3] = True
        for batch in batches:
            texts = Texts(batch.column(text))
            for first, end in texts.slices():
                rows, found = _word_ids(texts.piece(first, end))
                counts = heavy[found]
                rows, found = _features(rows[counts], found[counts])
                logit = intercept + np.bincount(rows, weight[found], minlength=end - first)
                yield with_columns(batch.slice(first, end - first), arrow, {out: pa.array(1 / (1 + np.exp(-logit)))})

    return unpacked(rows.mapInArrow(tidy(run), schema), docs, text, new=(out,))


def model_for(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of ``labels.toxic``, fitted on rows that are not held out."""
    return fit(training_rows(docs, labels, "toxic"))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of documents."""
    scored = score(docs.select("doc_id", "text"), model_for(docs, labels)).select("doc_id", "score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

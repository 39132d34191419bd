"""Text quality as a sparse rule ensemble.

1. ``statistics`` measures whole texts: lengths, shares of kinds of characters, repeated words and lines.
2. A small random forest is grown on the statistics of a bounded labelled sample. Every path from a root to a node is a
   rule: a conjunction of bounds, reduced to the tightest bound per statistic.
3. A logistic model with lasso penalty weighs the rules; most get no weight.
4. ``Rules.score`` compiles the rest into one Spark column expression over the statistics.

NULL and empty texts have all statistics 0 and get a score like any text. Without both labels in the sample the score is
the share of label 1.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idwarden.llm.arrays import LOWER, Texts, Words, run_starts, with_columns
from idwarden.llm.labelled import held_out, training_rows
from idwarden.llm.passing import packed, unpacked
from idwarden.llm.store import save

TREES, DEPTH = 24, 4
#: Weight of the lasso penalty.
LASSO = 0.002
PREDICT_FROM = 0.3

STATISTICS = (
    "chars", "words", "word_chars", "symbol_share", "upper_share", "digit_share", "punctuation_share", "mark_share",
    "beyond_ascii_share", "pipe_words", "distinct_share", "same_as_before_share", "top_word_share", "lines",
    "line_words", "repeated_line_share",
)


def _kind(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_SYMBOL, _UPPER, _DIGIT = _kind(b"#*$%&|<>"), _kind(bytes(range(65, 91))), _kind(bytes(range(48, 58)))
_PUNCTUATION, _MARK, _LETTER = _kind(b".,;:?"), _kind(b"!"), _kind(bytes([*range(65, 91), *range(97, 123)]))
_BEYOND, _CONTINUED = _kind(bytes(range(192, 256))), _kind(bytes(range(128, 192)))


def _share(part, whole):
    return part / np.maximum(whole, 1)


def measure(texts: Texts) -> dict[str, np.ndarray]:
    """Each statistic of each text."""
    n = len(texts)
    filled = np.append(texts.data, 0)
    lengths = np.diff(texts.offsets)

    def count(kind: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(texts.data) + 1, np.int64)
        np.cumsum(kind[filled[:-1]], out=sums[1:])
        return sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]

    chars = lengths - count(_CONTINUED)
    words = Words(texts)
    hashes = words.hashes(lower=True)
    bytes_of = np.bincount(words.rows, words.ends - words.starts, minlength=n)
    same = np.zeros(len(words), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.rows[1:] == words.rows[:-1])
    order = np.lexsort((hashes, words.rows))
    begins = run_starts(words.rows[order], hashes[order])
    runs = np.diff(np.append(begins, len(words)))
    top = np.zeros(n)
    np.maximum.at(top, words.rows[order][begins], runs)

    # Lines with a word, by the hash of their words.
    newlines = np.flatnonzero(texts.data == 10)
    line = np.searchsorted(newlines, words.starts) if len(words) else np.zeros(0, np.int64)
    heads = run_starts(words.rows, line) if len(words) else np.zeros(0, np.int64)
    line_rows = words.rows[heads]
    place = np.arange(len(words)) - np.repeat(heads, np.diff(np.append(heads, len(words))))
    mixed = hashes * (place.astype(np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))
    line_hash = np.add.reduceat(mixed, heads) if len(heads) else mixed
    by_line = np.lexsort((line_hash, line_rows))
    first = run_starts(line_rows[by_line], line_hash[by_line])
    lines = np.bincount(line_rows, minlength=n)
    distinct_lines = np.bincount(line_rows[by_line][first], minlength=n)

    out = {
        "chars": chars,
        "words": words.counts,
        "word_chars": _share(bytes_of, words.counts),
        "symbol_share": _share(count(_SYMBOL), chars),
        "upper_share": _share(count(_UPPER), count(_LETTER)),
        "digit_share": _share(count(_DIGIT), chars),
        "punctuation_share": _share(count(_PUNCTUATION), words.counts),
        "mark_share": _share(count(_MARK), words.counts),
        "beyond_ascii_share": _share(count(_BEYOND), chars),
        "pipe_words": _share(count(_kind(b"|")), words.counts),
        "distinct_share": _share(np.bincount(words.rows[order][begins], minlength=n), words.counts),
        "same_as_before_share": _share(np.bincount(words.rows[same], minlength=n), words.counts),
        "top_word_share": _share(top, words.counts),
        "lines": lines,
        "line_words": _share(words.counts, lines),
        "repeated_line_share": _share(lines - distinct_lines, lines),
    }
    return {k: v.astype(float) for k, v in out.items()}


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a double column for each of ``STATISTICS``, in place of the text. Columns of their names are replaced."""
    rows = packed(docs, text, without=STATISTICS)
    schema = T.StructType([rows.schema["__rest"], *(T.StructField(s, T.DoubleType()) for s in STATISTICS)])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            texts = Texts(batch.column(text))
            for first, end in texts.slices():
                found = {k: pa.array(v) for k, v in measure(texts.piece(first, end)).items()}
                yield with_columns(batch.slice(first, end - first), arrow, found)

    return unpacked(rows.mapInArrow(run, schema), docs, new=STATISTICS, without=(text,))


Bound = tuple[str, str, float]  # statistic, "<=" or ">", value


@dataclass(frozen=True)
class Rules:
    intercept: float
    weighted: tuple[tuple[tuple[Bound, ...], float], ...]

    def score(self) -> Column:
        """The probability of label 1, over columns of ``STATISTICS``."""
        logit = F.lit(self.intercept)
        for rule, weight in self.weighted:
            logit = logit + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-logit))


def holds(rule: tuple[Bound, ...]) -> Column:
    out = F.lit(True)
    for name, sign, value in rule:
        out = out & (F.col(name) <= value if sign == "<=" else F.col(name) > value)
    return out


def paths(tree: str, names=STATISTICS) -> set[tuple[Bound, ...]]:
    """The rules of a tree, from its printed form."""
    found, at = set(), []
    for line in tree.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        at = [x for x in at if x[0] < depth] + [(depth, (names[int(m[2])], m[3], float(m[4])))]
        bounds: dict[tuple[str, str], float] = {}
        for _, (name, sign, value) in at:
            known = bounds.get((name, sign), value)
            bounds[name, sign] = min(known, value) if sign == "<=" else max(known, value)
        found.add(tuple(sorted((name, sign, value) for (name, sign), value in bounds.items())))
    return found


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Rules:
    """Fit on ``text`` and ``label`` of a bounded table."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    # Some thousand rows of 16 numbers: two tasks do, and their order is fixed, so that the same forest grows.
    sample = save(statistics(rows), "quality-sample").orderBy("label", *STATISTICS).coalesce(2)
    shares = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(shares) < 2:
        share = min(max(float(next(iter(shares), 0)), 1e-6), 1 - 1e-6)
        return Rules(math.log(share / (1 - share)), ())
    sample = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(sample).select(*STATISTICS, "x", F.col("label").cast("double").alias("label")).cache()
    forest = RandomForestClassifier(labelCol="label", featuresCol="x", numTrees=trees, maxDepth=depth, minInstancesPerNode=5, seed=7).fit(sample)
    rules = sorted(set().union(*(paths(t.toDebugString) for t in forest.trees)))
    if not rules:
        share = shares[1] / sum(shares.values())
        return Rules(math.log(share / (1 - share)), ())
    marked = sample.select("label", F.array(*(holds(r).cast("double") for r in rules)).alias("rules"))
    from pyspark.ml.functions import array_to_vector

    marked = marked.select("label", array_to_vector("rules").alias("x")).cache()
    lasso_model = LogisticRegression(labelCol="label", featuresCol="x", elasticNetParam=1.0, regParam=lasso, maxIter=60).fit(marked)
    weights = lasso_model.coefficients.toArray()
    sample.unpersist()
    marked.unpersist()
    return Rules(float(lasso_model.intercept), tuple((r, float(w)) for r, w in zip(rules, weights) if w))


def model_for(docs: DataFrame, labels: DataFrame) -> Rules:
    """The rules of ``labels.quality``, fitted on rows that are not held out."""
    return fit(training_rows(docs, labels, "quality"))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of documents."""
    rules = model_for(docs, labels)
    scored = statistics(docs.select("doc_id", "text")).select("doc_id", rules.score().alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))

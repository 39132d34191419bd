"""Quality rules on repetition within a text, by suffix arrays.

The words of each text are sorted as suffixes by doubling: ranks of 1, 2, 4, ... words, refined only where they tie; ranks
of different texts never tie. The longest common prefix of neighbours in that order is read off the stored ranks. A
suffix that shares n words with a neighbour begins a repeated substring of n words: the maximal ones of all
longest-common-prefix intervals. The union of their spans, from ``MIN_WORDS`` words on, gives the covered share.

A text fails the base rules with fewer than 10 words, or if over 20 % of its words lie in repeated 5-word windows. It fails the
method's rules if repeats of ``MIN_WORDS`` words or more cover over ``MAX_PERCENT`` of its words, or if the longest repeat
has over ``MAX_REPEAT`` words and over ``MAX_REPEAT_PERCENT`` of the text's words.

NULL counts as empty. A text without words has all counts 0 and fails the base rules.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from idwarden.llm.arrays import Texts, Words, run_starts, starts_of, with_columns
from idwarden.llm.passing import packed, unpacked, widened

MIN_WORDS, MAX_PERCENT, MAX_REPEAT, MAX_REPEAT_PERCENT = 8, 15, 25, 5
WINDOW, LEAST_WORDS, BASE_PERCENT = 5, 10, 20

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def suffix_ranks(keys: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of suffixes by their first 1, 2, 4, ... symbols, until all differ.

    keys: a symbol for each place, different for different texts; ends: the end of each place's text. A rank is the number of
    suffixes that sort before all of its ties.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    begins = run_starts(keys[order])
    ranks = np.zeros(n, np.int64)
    ranks[order] = np.repeat(begins, np.diff(np.append(begins, n)))
    levels, width = [ranks], 1
    while True:
        sizes = np.bincount(ranks, minlength=n)
        tied = np.flatnonzero(sizes[ranks] > 1)
        if not len(tied):
            return levels
        after = tied + width
        inside = after < ends[tied]
        second = np.full(len(tied), -1, np.int64)
        second[inside] = ranks[after[inside]]
        order = np.lexsort((second, ranks[tied]))
        tied, second = tied[order], second[order]
        first = ranks[tied]
        begins = run_starts(first, second)
        groups = run_starts(first)
        # Within a group, a rank grows by the suffixes of the group that sort before.
        offset = begins - np.repeat(groups, np.diff(np.append(np.searchsorted(begins, groups), len(begins))))
        new = ranks.copy()
        new[tied] = np.repeat(first[begins] + offset, np.diff(np.append(begins, len(tied))))
        ranks = new
        levels.append(ranks)
        width *= 2


def repeat_lengths(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each place, the symbols that its suffix shares with a neighbour in the suffix array, at most."""
    n = len(keys)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    levels = suffix_ranks(keys, ends)
    array = np.empty(n, np.int64)
    array[levels[-1]] = np.arange(n)
    near = np.flatnonzero(levels[0][array[:-1]] == levels[0][array[1:]])
    a, b = array[near], array[near + 1]
    common = np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        inside = (x < ends[a]) & (y < ends[b])
        rank = levels[k]
        same = np.zeros(len(near), bool)
        same[inside] = rank[x[inside]] == rank[y[inside]]
        common[same] += 1 << k
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def covered(lengths: np.ndarray, least: int) -> np.ndarray:
    """Which places lie in the span of a repeat of ``least`` symbols or more."""
    edge = np.zeros(len(lengths) + 1, np.int64)
    at = np.flatnonzero(lengths >= least)
    edge[at] += 1
    np.subtract.at(edge, at + lengths[at], 1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: Texts) -> dict[str, np.ndarray]:
    n = len(texts)
    words = Words(texts)
    order_key = words.hashes()
    ends = words.offsets[1:][words.rows]
    # A rank of words that differs between texts.
    order = np.lexsort((order_key, words.rows))
    begins = run_starts(words.rows[order], order_key[order])
    keys = np.zeros(len(words), np.int64)
    keys[order] = np.repeat(begins, np.diff(np.append(begins, len(words))))
    lengths = repeat_lengths(keys, ends)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, words.rows, lengths)

    def per_row(marks):
        return np.bincount(words.rows[marks], minlength=n)

    def in_rows(marks):
        sums = starts_of(marks)
        return sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]

    point = (texts.data & 0xC0) != 0x80
    sums = starts_of(point)
    word_chars = np.bincount(words.rows, sums[words.ends] - sums[words.starts], minlength=n).astype(np.int64)
    lines = Words(texts, _NEWLINE)
    hashes = lines.hashes()
    worded = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
    rows, hashes = lines.rows[worded], hashes[worded]
    by_line = np.lexsort((hashes, rows))
    first = run_starts(rows[by_line], hashes[by_line])
    n_lines = np.bincount(rows, minlength=n)
    n_words = words.counts.astype(np.int64)
    n_repeat = per_row(covered(lengths, WINDOW))
    n_covered = n_repeat if MIN_WORDS == WINDOW else per_row(covered(lengths, MIN_WORDS))
    base_failed = (n_words < LEAST_WORDS) | (100 * n_repeat > BASE_PERCENT * n_words)
    repetitive = (100 * n_covered > MAX_PERCENT * n_words) | ((longest > MAX_REPEAT) & (100 * longest > MAX_REPEAT_PERCENT * n_words))
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": in_rows(_SYMBOLS[texts.data]),
        "n_dup_lines": n_lines - np.bincount(rows[by_line][first], minlength=n),
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": ~base_failed & ~repetitive,
        "longest_repeat": longest,
        "covered_words": n_covered,
    }


MEASURES = {
    **dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), T.LongType()),
    "base_failed": T.BooleanType(), "kept": T.BooleanType(), "longest_repeat": T.LongType(), "covered_words": T.LongType(),
}


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts and verdicts of ``MEASURES``. Columns of their names are replaced."""
    rows = packed(docs, text, without=tuple(MEASURES))
    schema = widened(rows, MEASURES)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            texts = Texts(batch.column(text))
            for first, end in texts.slices():
                found = measure(texts.piece(first, end))
                new = {k: pa.array(v.astype(bool if MEASURES[k] == T.BooleanType() else np.int64)) for k, v in found.items()}
                yield with_columns(batch.slice(first, end - first), arrow, new)

    return unpacked(rows.mapInArrow(run, schema), docs, text, new=tuple(MEASURES))


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and the verdicts of each row of documents."""
    return judge(docs.select("doc_id", "text")).select("doc_id", *(c for c in MEASURES if c != "longest_repeat"))

"""Benchmark items in texts, by CGK embedding and bit-sampling LSH over item-sized windows.

A text holds an item if some of its words form the item within ``EDITS`` of its length in word insertions, deletions and
replacements. Words are runs of letters, digits and characters beyond ASCII, without punctuation and spaces, A-Z lower-cased; in
scripts that put no spaces between words (``SINGLE``), each character is a word.

1. Items of more than ``PART_WORDS`` words are cut into like parts: of an item within the edits, some part is within its own share of
   them. Items, or their parts, are put in classes of like length. A window of a class that holds an item within the edits still holds a number of its
   word pairs, so windows with fewer word pairs of any item are passed over; no window that counts is lost by that.
2. The CGK random walk embeds each window that is left, and each item: at step j the current word is written, and a random bit of
   word and step says whether to move on. Few edits leave most places alike.
3. Each repetition samples ``SAMPLED`` places of a walk as a key; windows and items with equal keys are candidates. The number of
   repetitions follows from ``RECALL`` and the share of places that stay alike at the edit bound.
4. Items of fewer than ``LEAST_WORDS`` words are found exactly: up to three words allow no edit, and are looked up by the hash of
   their words; four words within one edit keep a word pair, by which they are looked up.
5. Candidates that hold enough of the item's own word pairs are decided by the exact edit distance, with free ends in the text.

Items are read in blocks of ``ITEM_BYTES``, each sent to all tasks; texts are read once a block and never shuffled. With several blocks, each is run and saved before the next is read. NULL and empty
texts hold nothing; NULL items and items without words are never found. Repeated rows give repeated results.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from functools import cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idwarden.llm.arrays import Texts, Words, join_hashes, ranges, run_starts, starts_of, window_hashes
from idwarden.llm.store import save, tidy
from idwarden.llm.toxicity import APART

EDITS, RECALL, SAMPLED, WALKS, LEAST_WORDS = 0.25, 0.99, 2, 8, 5
#: Share of a walk's places that stay alike at the edit bound: lower than measured.
ALIKE = 0.35
#: Bytes of item texts in a block, and bits of the table of word pairs.
ITEM_BYTES, PAIR_BITS = 16 << 20, 22
#: Ratio of lengths within a class.
CLASS = 1.15
#: Words of a part at most: over longer walks, fewer places stay alike than ``ALIKE``.
PART_WORDS = 60
#: Code points of scripts without spaces: Thai, Lao, Myanmar, Khmer, kana, Han.
SINGLE = (
    (0x0E00, 0x0F00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x3005, 0x3008), (0x3040, 0x3130), (0x31A0, 0x31C0), (0x31F0, 0x3200),
    (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x1B000, 0x1B170), (0x20000, 0x40000),
)


def edits_for(n):
    return (n * EDITS).astype(np.int64) if isinstance(n, np.ndarray) else int(n * EDITS)


@cache
def _kinds() -> np.ndarray:
    """For each code point: 0 within a word, 1 a word of its own, 2 between words."""
    kinds = np.zeros(sys.maxunicode + 1, np.uint8)
    for low, high in SINGLE:
        kinds[low:high] = 1
    # There are none beyond the first two planes.
    kinds[[c for c in range(0x80, 0x20000) if unicodedata.category(chr(c))[0] in "PZ"]] = 2
    return kinds


class ItemWords(Words):
    def __init__(self, texts: Texts):
        data = texts.data
        space, borders = APART[data], texts.offsets
        at = np.flatnonzero(data >= 0xC0)
        if len(at):
            lead = data[at].astype(np.int64)
            size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
            code = lead & (0x7F >> size)
            for k in range(1, 4):
                more = size > k
                code[more] = code[more] << 6 | (data[at[more] + k] & 0x3F)
            kind = _kinds()[code]
            space[ranges(at[kind == 2], size[kind == 2])] = True
            one = kind == 1
            borders = np.unique(np.concatenate([borders, at[one], at[one] + size[one]]))
        self.split(texts, space, borders)


def words_of(texts: Texts) -> tuple[Words, np.ndarray]:
    words = ItemWords(texts)
    return words, words.hashes(lower=True)


class Class:
    """Parts of like length: their walks' keys."""

    def __init__(self, parts: np.ndarray, offsets: np.ndarray, hashes: np.ndarray, seed: int):
        self.items, self.begins, lengths = parts.T
        self.length = int(lengths.max())
        least = int(lengths.min())
        # Word pairs that a window of this length holds at least.
        self.pairs = max(1, int((lengths - 1 - 2 * edits_for(lengths)).min()))
        self.reach = self.length + edits_for(self.length)
        rounds = math.ceil(math.log(1 - RECALL) / math.log(1 - ALIKE**SAMPLED))
        rng = np.random.default_rng(seed)
        steps = max(SAMPLED, int(1.6 * least))  # by then, a walk has seldom passed the end of an item
        self.salts = rng.integers(1, 2**63, (WALKS, steps), dtype=np.uint64) | np.uint64(1)
        self.places = [np.sort(rng.choice(steps, SAMPLED, replace=False)) for _ in range(rounds)]
        self.table = self.keys(hashes, offsets[self.items] + self.begins, offsets[self.items] + self.begins + lengths)

    def keys(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Keys of all repetitions (one row each) of the words from ``starts`` to ``ends``."""
        out = np.empty((len(self.places), len(starts)), np.uint64)
        filled = np.append(hashes, np.uint64(0))
        for walk in range(WALKS):
            at = starts.copy()
            written = []
            for salt in self.salts[walk]:
                word = np.where(at < ends, filled[np.minimum(at, len(hashes))], np.uint64(0))
                written.append(word)
                at = at + ((word * salt) >> np.uint64(63)).astype(np.int64)
            for r in range(walk, len(self.places), WALKS):
                key = np.full(len(starts), r + 1, np.uint64)
                for place in self.places[r]:
                    key = join_hashes(key, written[place])
                out[r] = key
        return out


class Items:
    """A block of benchmark items, as the tasks use it."""

    def __init__(self, ids: list[int], texts: list[str]):
        words, hashes = words_of(Texts(pa.array(texts, pa.string())))
        self.ids, self.offsets, self.hashes = np.array(ids, np.int64), words.offsets, hashes
        lengths = np.diff(self.offsets)
        members: dict[int, list[tuple[int, int, int]]] = {}
        for item in np.flatnonzero(lengths >= LEAST_WORDS).tolist():
            n = int(lengths[item])
            cuts = [n * k // -(-n // PART_WORDS) for k in range(-(-n // PART_WORDS) + 1)]
            for a, b in zip(cuts, cuts[1:]):
                members.setdefault(int(math.log(b - a) / math.log(CLASS)), []).append((item, a, b - a))
        #: For each hash of a word pair, a bit for each class that has it.
        self.pairs = np.zeros(1 << PAIR_BITS, np.uint32)
        self.classes = []
        for place, k in enumerate(sorted(members)):
            self.classes.append((place % 32, Class(np.array(members[k]), self.offsets, self.hashes, k)))
            for item, begin, n in members[k]:
                at = (self.pairs_of(item)[begin:begin + n - 1] >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
                self.pairs[at] |= np.uint32(1 << place % 32)
        #: By number of words: sorted hashes of the words of shorter items (of pairs, for four words), the item and the place of each.
        self.short = {}
        for n in range(1, LEAST_WORDS):
            some = np.flatnonzero(lengths == n)
            span = n - 2 * int(edits_for(n))
            if len(some):
                keys = np.stack([window_hashes(self.hashes[a:a + n], span) for a in self.offsets[some]])
                order = np.argsort(keys, axis=None, kind="stable")
                self.short[n] = span, keys.ravel()[order], some[order // keys.shape[1]], order % keys.shape[1]

    def pairs_of(self, item: int) -> np.ndarray:
        own = self.hashes[self.offsets[item]:self.offsets[item + 1]]
        return join_hashes(own[:-1], own[1:])

    def short_candidates(self, words: Words, hashes: np.ndarray):
        """As ``candidates``, for items of fewer than ``LEAST_WORDS`` words; none is missed."""
        for n, (span, known, items, places) in self.short.items():
            keys = window_hashes(hashes, span)
            keys_at = np.flatnonzero(words.rows[:len(keys)] == words.rows[span - 1:]) if len(keys) else np.zeros(0, np.int64)
            low, high = np.searchsorted(known, keys[keys_at]), np.searchsorted(known, keys[keys_at], "right")
            which = ranges(low, high - low)
            at = np.repeat(keys_at, high - low)
            found = np.stack([items[which], np.maximum(at - places[which], words.offsets[words.rows[at]])])
            if edits_for(n):
                yield np.unique(found, axis=1)
            else:  # the first of a row is the best
                by = np.lexsort((found[1], found[0], words.rows[at]))
                yield found[:, by[run_starts(words.rows[at][by], found[0][by])]]

    def candidates(self, words: Words, hashes: np.ndarray):
        """item and its likely first word, for windows whose key is that of a part of the item, in some repetition."""
        n = len(hashes)
        known = np.zeros(n, np.uint32)
        if n > 1:
            known[:-1] = self.pairs[(join_hashes(hashes[:-1], hashes[1:]) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)]
            known[:-1][words.rows[:-1] != words.rows[1:]] = 0
        row_end = words.offsets[1:][words.rows]
        for bit, group in self.classes:
            sums = starts_of((known >> np.uint32(bit)) & np.uint32(1))
            if sums[-1] < group.pairs:
                continue
            end = np.minimum(np.arange(n) + group.reach, row_end)
            # The pairs within the window: its last word begins none of them.
            starts = np.flatnonzero(sums[np.maximum(end - 1, 0)] - sums[:-1] >= group.pairs)
            if not len(starts):
                continue
            keys = group.keys(hashes, starts, np.minimum(starts + group.length, row_end[starts]))
            found = []
            for mine, theirs in zip(keys, group.table):
                order = np.argsort(theirs, kind="stable")
                low, high = np.searchsorted(theirs[order], mine), np.searchsorted(theirs[order], mine, "right")
                hit, part = np.repeat(starts, high - low), order[ranges(low, high - low)]
                first = np.maximum(hit - group.begins[part], words.offsets[words.rows[hit]])
                found.append(np.stack([group.items[part], first]))
            yield np.unique(np.concatenate(found, axis=1), axis=1)


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Fewest edits that turn some words of ``text`` into ``item``; the first and end of those words."""
    m = len(text)
    steps = np.arange(m + 1)
    cost, begin = np.zeros(m + 1, np.int64), steps.copy()
    for k, word in enumerate(item, 1):
        # Cost and begin as one number, so that ties take the latest begin.
        code = cost * (m + 2) - begin
        best = code + (m + 2)
        best[1:] = np.minimum(best[1:], code[:-1] + (text != word) * (m + 2))
        best = np.minimum.accumulate(best - steps * (m + 2)) + steps * (m + 2)
        cost = -(-best // (m + 2))
        begin = cost * (m + 2) - best
    at = int(np.argmin(cost))
    return int(cost[at]), int(begin[at]), at


def _search(items: Items, texts: Texts):
    """row, item, edits, first and end word of the best match of each text and item."""
    words, hashes = words_of(texts)
    pair = join_hashes(hashes[:-1], hashes[1:])
    out = []
    for found in chain(items.candidates(words, hashes), items.short_candidates(words, hashes)):
        item, start = found
        row = words.rows[start]
        slack = edits_for(np.diff(items.offsets)[item]) + np.diff(items.offsets)[item]
        # Windows of one item that overlap are looked at as one.
        order = np.lexsort((start, item, row))
        item, start, row, slack = item[order], start[order], row[order], slack[order]
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (row[1:] != row[:-1]) | (start[1:] > start[:-1] + slack[1:])
        begins = np.flatnonzero(new)
        for a, b in zip(begins, np.append(begins[1:], len(item))):
            i, r = int(item[a]), int(row[a])
            first, last = int(words.offsets[r]), int(words.offsets[r + 1])
            n = int(items.offsets[i + 1] - items.offsets[i])
            # Edits before a part move it.
            moved = edits_for(n) if n > PART_WORDS else 0
            low, high = max(first, int(start[a]) - edits_for(n) - moved), min(last, int(start[b - 1]) + n + 2 * edits_for(n) + moved)
            if np.isin(pair[low:high - 1], items.pairs_of(i)).sum() < n - 1 - 2 * edits_for(n):
                continue  # too few of the item's word pairs for the edits
            cost, x, y = best_match(items.hashes[items.offsets[i]:items.offsets[i + 1]], hashes[low:high])
            if cost <= edits_for(n):
                out.append((r, i, cost, low + x - first, low + y - first, n))
    best: dict[tuple[int, int], tuple] = {}
    for r, i, *rest in out:
        best[r, i] = min(best.get((r, i), tuple(rest)), tuple(rest))
    return [(r, i, *rest) for (r, i), rest in sorted(best.items())]


OUT = ("item_id", "edits", "first_word", "end_word", "item_words")


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, edits, first_word, end_word and item_words of each item that a row of ``docs`` holds: its best match."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(c, T.LongType()) for c in OUT)])
    known = benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select(F.col("item_id").cast("long"), "text").distinct()
    size = known.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / ITEM_BYTES))

    def search(block: int) -> DataFrame:
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        ids, texts = [r["item_id"] for r in rows], [r["text"] for r in rows]

        def run(batches):
            items = Items(ids, texts)
            for batch in batches:
                column = batch.column("doc_id")
                all_texts = Texts(batch.column("text"))
                for first, end in all_texts.slices():
                    found = _search(items, all_texts.piece(first, end))
                    if found:
                        r, i, edits, a, b, n = (np.array(x, np.int64) for x in zip(*found))
                        yield pa.RecordBatch.from_arrays(
                            [column.take(pa.array(r + first)), *(pa.array(x) for x in (items.ids[i], edits, a, b, n))], names=["doc_id", *OUT],
                        )

        return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)

    if blocks == 1:
        return search(0)
    # Each block is run before the next is read, so that the driver holds one.
    return reduce(DataFrame.unionByName, [save(search(k), "decontaminated") for k in range(blocks)])

"""Byte-level BPE encoding and decoding by merge replay.

The distinct words (matches of the split pattern) of a slice of the corpus form one array of tokens, linked to
their neighbours. An inverted index leads from the rank of a token pair to the positions that hold it. Ranks leave a
heap in order; each merge touches its positions and their two neighbours, whose new pairs enter the index. A pair
of lower rank that a merge creates comes next: the positions of a word merge together up to the first that creates one,
which is the order of the tiktoken library, and a word that waits often is finished alone from a heap of positions. Words stay apart in the array, so a slice's words are encoded once, however often
they occur.

Slices are those of Spark's tasks: no shuffle, no state beyond a bounded table of words per task.

NULL text counts as empty; an empty text has no ids. A column that bears the name of an output column is replaced.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idwarden.llm.arrays import Texts, binaries, binary_values, ranges, run_starts, starts_of, with_columns
from idwarden.llm.passing import packed, unpacked, widened
from idwarden.llm.store import tidy

#: Times that the positions of a word may wait for pairs of lower rank before the word is finished alone.
TURNS = 64

#: Text worked on at once, and the size of a task's table of words at which it starts anew.
SLICE_BYTES, TABLE_WORDS, TABLE_BYTES = 1 << 20, 200_000, 8 << 20


class Ranks:
    """A rank file: token bytes by id, and the merged id of each pair of ids."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        size = max(self.ids.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ids.items():
            tokens[rank] = token
        self.offsets = starts_of(np.array([len(t) for t in tokens]))
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.of_byte = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.of_byte < 0).any():
            raise ValueError("the ranks must hold every single byte")
        pairs = [
            (self.ids[token[:k]] << 32 | self.ids[token[k:]], rank)
            for token, rank in self.ids.items() for k in range(1, len(token))
            if token[:k] in self.ids and token[k:] in self.ids
        ]
        pairs.sort()
        self.pairs = dict(pairs)
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id each pair merges to, or -1."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one after the other, and the number of ids of each."""
        lengths = np.array([len(w) for w in words], np.int64)
        whole = np.array([self.ids.get(w, -1) for w in words], np.int64)
        token = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        first = starts_of(lengths)[:-1]
        word = np.repeat(np.arange(len(words)), lengths)
        n = len(token)
        # A word that is a token is not split.
        known = whole >= 0
        token[first[known]] = whole[known]
        alive = ~known[word]
        alive[first[known]] = True
        behind = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        last = np.ones(n, bool)
        last[:-1] = word[1:] != word[:-1]
        behind[last | known[word]] = -1
        before[first] = -1
        pair = np.full(n, -1, np.int64)
        inner = np.flatnonzero(behind >= 0)
        pair[inner] = self.merged(token[inner], token[behind[inner]])

        turns = np.zeros(len(words), np.int64)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray):
            """Enter positions under the rank of the pair that begins there."""
            ranks = pair[at]
            at = at[ranks >= 0]
            if not len(at):
                return
            if len(at) > 1:
                order = np.argsort(pair[at], kind="stable")
                at = at[order]
                cuts = np.flatnonzero(np.diff(pair[at])) + 1
                groups = np.split(at, cuts) if len(cuts) else [at]
            else:
                groups = [at]
            for group in groups:
                rank = int(pair[group[0]])
                if rank in index:
                    index[rank].append(group)
                else:
                    index[rank] = [group]
                    heapq.heappush(heap, rank)

        add(np.flatnonzero(pair >= 0))
        while heap:
            rank = heapq.heappop(heap)
            at = index.pop(rank)
            at = at[0] if len(at) == 1 else np.unique(np.concatenate(at))
            at = at[pair[at] == rank]
            if not len(at):
                continue
            later, same = at[:0], at[:0]
            if len(at) > 1:
                at.sort()
                owner = word[at]
                same = owner[1:] == owner[:-1]
                if same.any():
                    # Only words with several positions need to know which of them merge now.
                    several = np.zeros(len(at), bool)
                    several[1:] = same
                    several[:-1] |= same
                    merging = ~several
                    merging[several] = self.in_turn(rank, at[several], word, token, before, behind)
                    later, at = at[~merging], at[merging]
            gone = behind[at]
            after = behind[gone]
            token[at] = rank
            alive[gone] = False
            pair[gone] = -1
            behind[at] = after
            more = after >= 0
            before[after[more]] = at[more]
            pair[at] = -1
            grown = at[more]
            pair[grown] = self.merged(token[grown], token[after[more]])
            ahead = before[at]
            led = ahead >= 0
            ahead = ahead[led]
            pair[ahead] = self.merged(token[ahead], token[at[led]])
            if not same.any():
                add(np.concatenate([grown, ahead]))
                continue
            later = later[pair[later] == rank]
            if len(later):
                waiting = word[later[run_starts(word[later])]]
                turns[waiting] += 1
                for w in waiting[turns[waiting] > TURNS].tolist():
                    self.finish(slice(first[w], first[w] + lengths[w]), token, pair, alive)
                later = later[pair[later] == rank]
            add(np.unique(np.concatenate([later, grown, ahead])))
        return token[alive], np.bincount(word[alive], minlength=len(words))


    def in_turn(self, rank: int, at: np.ndarray, word: np.ndarray, token: np.ndarray, before: np.ndarray, behind: np.ndarray) -> np.ndarray:
        """Which of the positions ``at`` (ascending, all of ``rank``) merge before a pair of lower rank arises in their word.

        Of pairs that overlap every second one merges, from the left. A merge makes a pair with what stands before it then and
        one with what stands behind it still; where one of these has a lower rank, the word's later positions wait.
        """
        linked = np.zeros(len(at), bool)
        linked[1:] = behind[at[:-1]] == at[1:]
        begin = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
        out = (np.arange(len(at)) - begin) % 2 == 0
        some = at[out]
        left, gone = before[some], behind[some]
        after = behind[gone]
        lefts = np.where(left >= 0, token[left], -1)
        lefts[1:][left[1:] == gone[:-1]] = rank
        rights = np.where(after >= 0, token[after], -1)
        made_left, made_right = self.merged(lefts, np.full(len(some), rank)), self.merged(np.full(len(some), rank), rights)
        lower = ((left >= 0) & (made_left >= 0) & (made_left < rank)) | ((after >= 0) & (made_right >= 0) & (made_right < rank))
        if lower.any():
            owner = word[some]
            earlier = starts_of(lower)[:-1]
            begins = run_starts(owner)
            out[out] = earlier == np.repeat(earlier[begins], np.diff(np.append(begins, len(owner))))
        return out

    def finish(self, span: slice, token: np.ndarray, pair: np.ndarray, alive: np.ndarray):
        """Replay the rest of one word alone, from a heap of (rank, position): n log n, however often lower pairs arise."""
        places = np.flatnonzero(alive[span])
        tokens, ranks = token[span][places].tolist(), pair[span][places].tolist()
        n = len(tokens)
        before, behind = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, k) for k, r in enumerate(ranks) if r >= 0]
        heapq.heapify(heap)

        def look(k: int):
            ranks[k] = self.pairs.get(tokens[k] << 32 | tokens[behind[k]], -1) if behind[k] >= 0 else -1
            if ranks[k] >= 0:
                heapq.heappush(heap, (ranks[k], k))

        while heap:
            rank, k = heapq.heappop(heap)
            if ranks[k] != rank:
                continue
            gone = behind[k]
            tokens[k], tokens[gone], ranks[gone] = rank, -1, -1
            behind[k] = behind[gone]
            if behind[k] >= 0:
                before[behind[k]] = k
            look(k)
            if before[k] >= 0:
                look(before[k])
        tokens = np.array(tokens, np.int64)
        token[span][places] = tokens
        alive[span][places] = tokens >= 0
        pair[span] = -1


@lru_cache(maxsize=2)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


class WordTable:
    """Ids of the words seen so far in a task."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self.clear()

    def clear(self):
        self.places: dict[str, int] = {}
        self.new: list[str] = []
        self.ids = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.size = 0

    def place(self, word: str) -> int:
        at = self.places.get(word)
        if at is None:
            at = self.places[word] = len(self.places)
            self.new.append(word)
        return at

    def learn(self):
        """Encode the words that are new."""
        if self.new:
            words = [w.encode() for w in self.new]
            ids, counts = self.ranks.replay(words)
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
            self.size += sum(map(len, words))
            self.new = []


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each text in ``ids``: little-endian unsigned 32-bit integers, as binary."""
    rows = packed(docs, text, without=(ids,))
    schema = widened(rows, {ids: T.BinaryType()})

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        split = regex.compile(pattern).findall
        table = WordTable(ranks_of(path))
        for batch in batches:
            texts = Texts(batch.column(text))
            for first, end in texts.slices(SLICE_BYTES):
                piece = texts.piece(first, end)
                raw = piece.data.tobytes()
                counts = np.zeros(len(piece), np.int64)
                places = []
                for row, (a, b) in enumerate(zip(piece.offsets[:-1].tolist(), piece.offsets[1:].tolist())):
                    words = split(raw[a:b].decode())
                    counts[row] = len(words)
                    places.append(np.fromiter(map(table.place, words), np.int64, len(words)))
                table.learn()
                places = np.concatenate(places)
                begins = starts_of(table.counts)
                flat = table.ids[ranges(begins[places], table.counts[places])]
                sizes = starts_of(table.counts[places])
                yield with_columns(batch.slice(first, end - first), arrow, {
                    ids: binaries(flat.astype("<u4"), 4 * sizes[starts_of(counts)]),
                })
                if len(table.places) > TABLE_WORDS or table.size > TABLE_BYTES:
                    table.clear()

    return unpacked(rows.mapInArrow(tidy(run), schema), docs, text, new=(ids,))


def decode(docs: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of the tokens in ``ids``, joined, as binary column ``out``. NULL ids give no bytes."""
    rows = packed(docs, ids, without=(out,))
    schema = widened(rows, {out: T.BinaryType()})

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        ranks = ranks_of(path)
        lengths = np.diff(ranks.offsets)
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                flat, counts = binary_values(part.column(ids), "<u4")
                flat = flat.astype(np.int64)
                sizes = starts_of(lengths[flat])
                data = ranks.bytes[ranges(ranks.offsets[flat], lengths[flat])]
                yield with_columns(part, arrow, {out: binaries(data, sizes[starts_of(counts)])})

    return unpacked(rows.mapInArrow(tidy(run), schema), docs, ids, new=(out,))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row of documents."""
    encoded = encode(docs.select("doc_id", "text"), path, pattern).select("doc_id", "token_ids")
    return decode(encoded, path).select(
        "doc_id",
        (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

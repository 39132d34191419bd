"""Joins and removals of repeated text against brute force."""

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from idwarden.llm import jaccard_join, repetition, substring_dedup, suffix_dedup
from idwarden.llm.arrays import Texts, Words
from idwarden.llm.components import components


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_jaccard_components(frame, corpus):
    assert got(jaccard_join.labels(frame)) == brute.component_ids(corpus)


def test_substring_dedup(frame, corpus):
    assert got(substring_dedup.digests(frame)) == brute.substring_rows(corpus)


def test_suffix_dedup(frame, corpus):
    assert got(suffix_dedup.digests(frame)) == brute.suffix_rows(corpus)


def test_passage_of_two_ids_of_a_task_in_a_repeated_id(spark):
    """Ids 2 and 1 share a passage in one task, of which 2 comes first; another text of id 2 holds it in another task."""
    passage = " ".join(f"p{i}" for i in range(70))
    texts = [" ".join(f"{c}{i}" for i in range(20)) + f" {passage} " + " ".join(f"{c}{i}" for i in range(20, 40)) for c in "abc"]
    docs = [(2, texts[0]), (2, texts[1]), (1, texts[2])]
    some = spark.createDataFrame(spark.sparkContext.parallelize(docs, 2), "doc_id long, text string")
    assert some.rdd.glom().map(len).collect() == [1, 2]
    assert got(substring_dedup.digests(some)) == brute.substring_rows(docs)
    assert got(suffix_dedup.digests(some)) == brute.suffix_rows(docs)


def test_repetition(frame, corpus):
    some = [(d, t) for d, t in corpus if len(t or "") < 5000]
    want = sorted((brute.repetition_row(d, t) for d, t in some), key=repr)
    assert got(repetition.verdicts(frame.where("text IS NULL OR length(text) < 5000"))) == want
    assert repetition.judge(frame).columns[-9:] == list(repetition.MEASURES)


@pytest.mark.parametrize("run", [jaccard_join.labels, substring_dedup.digests, suffix_dedup.digests, repetition.verdicts])
def test_empty_tables(nothing, run):
    assert got(run(nothing)) == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (3, 4)]
    found = dict(got(components(spark.createDataFrame(edges, "a long, b long"))))
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


def test_busy_tiles_lose_no_link(spark):
    """Many near copies of one text, some of them a quarter shorter, and texts that share most of another."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(120)]
    docs = []
    for i in range(150):
        w = list(base)
        for at in rng.integers(0, 120, 2):
            w[at] = f"n{rng.integers(1000)}"
        docs.append((i, " ".join(w[: 95 + i % 26])))
    docs += [(200 + i, " ".join([*base[:60], *(f"u{i}_{k}" for k in range(40))])) for i in range(60)]
    assert got(jaccard_join.labels(spark.createDataFrame(docs, "doc_id long, text string"))) == brute.component_ids(docs)


texts = st.lists(st.text(st.sampled_from("aB \n\té\x85 "), max_size=30), max_size=6)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words(some):
    found = Words(Texts(pa.array(some, pa.string())))
    data = found.data.tobytes()
    want = [(r, w) for r, t in enumerate(some) for w in brute.words(t)]
    assert [(r, data[a:b].decode()) for r, a, b in zip(found.rows, found.starts, found.ends)] == want
    hashes = {}
    for (_, w), h in zip(want, found.hashes().tolist()):
        assert hashes.setdefault(w, h) == h
    assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), min_size=1, max_size=4))
def test_repeat_lengths(rows):
    """Each place's longest repeat within its row."""
    keys = np.array([4 * r + x for r, row in enumerate(rows) for x in row], np.int64)
    ends = np.repeat(np.cumsum([len(r) for r in rows]), [len(r) for r in rows])
    found = iter(repetition.repeat_lengths(keys, ends).tolist())
    for row in rows:
        for i in range(len(row)):
            best = max((k for j in range(len(row)) if j != i for k in range(len(row) - max(i, j) + 1) if row[i:i + k] == row[j:j + k]), default=0)
            assert next(found) == best


@pytest.mark.parametrize("kind,unit", [(suffix_dedup.Bytes(), ""), (substring_dedup.WordUnits(), " ")])
def test_holders(kind, unit):
    rng = np.random.default_rng(1)
    for trial in range(40):
        base = rng.choice(["a", "b"] if trial % 3 else ["a"], 200).tolist()
        contexts, sizes = [], []
        for _ in range(rng.integers(1, 8)):
            n = int(rng.integers(1, 35))
            at = int(rng.integers(0, 200 - n - 49))
            piece = base[at:at + n + 49]
            if rng.random() < 0.4:
                piece[rng.integers(len(piece))] = "c"
            contexts.append(unit.join(piece) + unit)
            sizes.append(n)
        ids = rng.integers(0, 5, len(contexts))
        if not unit:
            windows = [c[j:j + 50] for c, n in zip(contexts, sizes) for j in range(n)]
        else:
            windows = [tuple(c.split()[j:j + 50]) for c, n in zip(contexts, sizes) for j in range(n)]
        least = {}
        for w, i in zip(windows, np.repeat(ids, sizes).tolist()):
            least[w] = min(least.get(w, i), i)
        found = kind.holders(pa.array([c.encode() for c in contexts], pa.binary()), np.array(sizes), ids)
        assert found.tolist() == [least[w] for w in windows]


def test_wavelet_ranks():
    rng = np.random.default_rng(2)
    symbols = rng.integers(0, 37, 500)
    matrix = substring_dedup.WaveletMatrix(symbols, 6)
    at, what = rng.integers(0, 501, 300), rng.integers(0, 37, 300)
    low, high = matrix.ranks(what, at, np.full(300, 500))
    assert low.tolist() == [int((symbols[:a] == c).sum()) for a, c in zip(at, what)]
    assert high.tolist() == [int((symbols == c).sum()) for c in what]


def test_words_of_opposite_form(spark):
    """A Thue-Morse word and its complement, which polynomials modulo a power of two do not tell apart, as words, lines and shingles."""
    docs = []
    for n in (512, 1024, 2048, 4096):
        bits = [bin(i).count("1") & 1 for i in range(n)]
        one, other = ("".join(of[b] for b in bits) for of in ("ab", "ba"))
        h = Words(Texts(pa.array([f"{one} {other} {one.upper()}"]))).hashes(lower=True)
        assert h[0] == h[2] != h[1]
        around = " ".join(f"c{n}x{i}" for i in range(25))
        docs += [(n, f"{one}\n{other}"), (n + 1, f"a b {one} c d"), (n + 2, f"a b {other} c d")]
        docs += [(n + 3, f"{around} {one} {around}"), (n + 4, f"{around} {other} {around}"), (n + 5, f"{around} {one} {around}")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(jaccard_join.labels(df)) == brute.component_ids(docs)
    assert got(substring_dedup.digests(df)) == brute.substring_rows(docs)
    assert got(repetition.verdicts(df)) == sorted((brute.repetition_row(d, t) for d, t in docs), key=repr)

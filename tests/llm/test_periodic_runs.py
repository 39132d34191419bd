"""Periodic runs against a search of all periods."""

import hashlib
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from idwarden.llm import periodic_runs


def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(doc_id, text):
    w = brute.words(text)
    n, h = len(w), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    listed, kept = "".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), s, n, q, None if n is None else 1000 * n // q, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


blocks = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(st.lists(blocks, min_size=1, max_size=4))
def test_runs_of_several_texts(texts):
    texts = [[x for block, times in parts for x in block * times] for parts in texts]
    offsets = np.cumsum([0, *map(len, texts)])
    text, start, length, period = periodic_runs.runs_of(np.array(sum(texts, []), np.int64), offsets)
    found = [(t, s - offsets[t], n, q) for t, s, n, q in zip(text, start, length, period)]
    assert found == [(t, *r) for t, w in enumerate(texts) for r in plain_runs(w)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=2, max_size=30), st.integers(1, 12), st.data())
def test_extensions(block, times, data):
    w = block * times + data.draw(st.lists(st.integers(0, 1), max_size=40))
    found = periodic_runs.Extensions(np.array(w, np.int64))
    i, j = (np.array(data.draw(st.lists(st.integers(0, len(w) - 1), min_size=20, max_size=20))) for _ in range(2))
    i, j = i[i != j], j[i != j]

    def common(x, y):
        n = 0
        while max(x, y) + n < len(w) and w[x + n] == w[y + n]:
            n += 1
        return n

    assert found.of(i, j).tolist() == [common(x, y) for x, y in zip(i, j)]


def test_the_cover_is_perfect():
    members = periodic_runs.MEMBERS
    differences = [(a - b) % periodic_runs.COVER for a in members for b in members if a != b]
    assert sorted(differences) == list(range(1, periodic_runs.COVER))


def some_docs(corpus):
    block = " ".join(f"b{i}" for i in range(37))
    docs = [(d, t) for d, t in corpus if len(t or "") < 20_000]
    docs += [(1000 + k, f"start {block} " + f"{block} " * k + "b0 b1 end") for k in range(2, 9)]
    docs += [(2000, "a " * 4000), (2001, "a b " * 2000 + "c " * 30), (2002, "x " * 5), (2003, "x " * 6), (2004, "x y x y x y x"), (2005, "x y x y x y x y")]
    return [*docs, (2006, "é é é É é é é é é"), (2000, "a " * 4000), (None, "n " * 9)] + [(3000 + k, " ".join(f"v{i * k % 97}" for i in range(200))) for k in range(60)]


def test_digests(spark, corpus):
    docs = some_docs(corpus)
    assert sum(d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs) > 10
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    df = df.withColumns({c: F.lit(2) for c in ("runs", "collapsed", "n_words", "n_runs", "start", "length", "period", "listed", "a.b")})
    found = sorted((tuple(r) for r in periodic_runs.digests(df).collect()), key=repr)
    assert found == sorted((plain_row(d, t) for d, t in docs), key=repr)


def test_operator_keeps_columns_and_returns_runs_and_text(spark):
    df = spark.createDataFrame([(1, "a a a a a a a b", 5), (2, None, 6)], "id int, body string, n_words int")
    first, second = periodic_runs.find(df, text="body").orderBy("id").collect()
    assert (first.id, first.n_words, np.frombuffer(first.runs, "<i8").tolist(), first.collapsed) == (1, 8, [0, 7, 1], "a b")
    assert (second.n_words, second.runs, second.collapsed) == (0, b"", "")


@pytest.mark.parametrize("words", ["x ", "x y z "])
def test_one_very_long_run(words):
    w = np.array([hash(x) % 97 for x in (words * 100_000).split()], np.int64)
    found = periodic_runs.runs_of(w, np.array([0, len(w)]))
    assert [x.tolist() for x in found] == [[0], [0], [len(w)], [len(set(w.tolist()))]]


def test_no_rows(nothing):
    assert periodic_runs.digests(nothing).collect() == []

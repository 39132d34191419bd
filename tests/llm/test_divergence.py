"""Divergence of sources against plain counting."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from idwarden.llm import divergence

SCHEMA = "lang string, source string, text string"


def brute(docs, least=30):
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang in {k for k, _ in counts}:
        kept = [t for t, n in held[lang].items() if n >= least]
        groups = {s: counts[lang, s] for k, s in counts if k == lang}
        whole = sum(groups.values(), Counter())

        def shares(found, kept=kept):
            total = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s in groups:
            far = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            out += [(lang, s, "pair", o.decode(), -v, i) for i, (v, o) in enumerate(far, 1)]
            first = sorted((q[t] - p[s][t], t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t])[:50]
            out += [(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(first, 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()), key=repr)


def some_docs():
    rng = random.Random(8)
    vocabulary = [*(f"term{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)), "É", "é", "中文", "ﬀ", "\U0001f600", "don", "t"]
    docs = []
    for lang in ("en", "de", None):
        for source in ("a", "b", "B", "é", "\U0001f600", "ﬀ", None):
            words = rng.sample(vocabulary, 40)
            docs += [(lang, source, " ".join(rng.choices(words, k=rng.randrange(1, 60))) + " Don't STOP2go") for _ in range(rng.randrange(5, 40))]
        docs += [(lang, "empty", None), (lang, "empty", ""), (lang, "", " 12 ;[] "), (lang, "a", "word " * 5000)]
    docs += [("rare", "x", "one two"), ("rare", "y", "two three"), ("rare", "z", None), ("alone", "only", "one")]
    docs += [("en", "a", docs[0][2])] * 5
    return docs


def test_counts_by_hand(spark):
    docs = some_docs()
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    df = df.withColumns({c: F.lit(3) for c in ("doc_id", "n", "docs", "term", "value", "rank", "item", "part", "number", "p", "v", "a.b")})
    assert got(divergence.report(df)) == brute(docs)


def test_ties_of_many_terms(spark):
    """Over 50 terms share a value; their order is that of the UTF-8 bytes."""
    terms = [f"{c}{d}" for c in "abcdefghijzéﬀ" for d in "klmnop中"]
    docs = [("en", "s", " ".join(terms))] * 40 + [("en", "o", "zz " * 3)] * 40
    assert got(divergence.report(spark.createDataFrame(docs, SCHEMA))) == brute(docs)


def test_more_sources_than_a_tile_holds(spark):
    rng = random.Random(9)
    words = [chr(97 + i) * 2 for i in range(12)]
    docs = [("en", f"s{i}", " ".join(rng.choices(words, k=rng.randrange(0, 9)))) for i in range(divergence.TILE + 20)]
    assert got(divergence.report(spark.createDataFrame(docs, SCHEMA))) == brute(docs)


def test_no_rows(spark):
    assert got(divergence.report(spark.createDataFrame([], SCHEMA))) == []

"""Tokens, classifiers, filters and the pipeline."""

import base64
import hashlib
import math
import random
import time

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from idwarden.llm import bpe, catalog, decontaminate, labelled, licenses, quality_model, toxicity, url_filter
from idwarden.llm.arrays import Texts

PATH = public_tokenizers.path(catalog.BPE_RANKS)
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_bpe_like_tiktoken(frame, corpus):
    want = []
    for doc_id, text in corpus:
        ids = TIKTOKEN.encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())))
    assert got(bpe.digests(frame, PATH, public_tokenizers.PATTERN)) == sorted(want, key=repr)
    assert bpe.encode(frame, PATH, public_tokenizers.PATTERN).columns == [c for c in frame.columns if c != "token_ids"] + ["token_ids"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("abn é中'0  \x00"), min_size=1, max_size=40), min_size=1, max_size=5))
def test_replay_of_words(words):
    ids, counts = bpe.ranks_of(PATH).replay([w.encode() for w in words])
    at = 0
    for word, n in zip(words, counts.tolist()):
        assert ids[at:at + n].tolist() == TIKTOKEN._core_bpe.encode_single_piece(word.encode())
        at += n


LETTERS = {"two": "ab", "one": "x", "bases": "ACGT", "common": "etaoinshr", "marks": "-=", "wide": "äö中エ"}


@pytest.mark.parametrize("turns", [0, bpe.TURNS])
def test_replay_of_long_words(turns, monkeypatch):
    monkeypatch.setattr(bpe, "TURNS", turns)
    rng = random.Random(3)
    words = ["".join(rng.choices(of, k=k)) for of in LETTERS.values() for k in (50, 300, 4000)]
    words += ["ab" * 2000, "x" * 4001, "rationing" * 400, *("".join(rng.choice(["ab", "x"]) * rng.randint(1, 90) for _ in range(90)) for _ in range(5))]
    ids, counts = bpe.ranks_of(PATH).replay([w.encode() for w in words])
    cuts = np.split(ids, np.cumsum(counts)[:-1])
    for word, own in zip(words, cuts):
        assert own.tolist() == TIKTOKEN._core_bpe.encode_single_piece(word.encode()), word[:40]


@pytest.mark.parametrize("word", ["ab" * (1 << 19), "x" * (1 << 20), "".join(random.Random(1).choices("ACGT", k=1 << 20))])
def test_replay_of_a_megabyte_in_one_word(word):
    ranks, begin = bpe.ranks_of(PATH), time.process_time()
    ids, _ = ranks.replay([word.encode()])
    assert time.process_time() - begin < 15  # seconds; it takes about one
    assert ids.tolist() == TIKTOKEN._core_bpe.encode_single_piece(word.encode())


@pytest.fixture(scope="module")
def marked(spark):
    """Documents and labels: toxic ones hold insults, bad ones symbols; group terms occur in toxic texts mostly."""
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(900):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 60))]
        toxic, good = rng.random() < 0.3, rng.random() < 0.7
        if toxic:
            w[3:3] = rng.sample(["idiot", "moron", "scum", "trash"], 2)
        if rng.random() < (0.7 if toxic else 0.1):
            w[5:5] = ["muslims"]
        if not good:
            w = [f"{x}%%%" for x in w]
        docs.append((i, " ".join(w)))
        labels.append((i, int(good), int(toxic)))
    docs += [(2000, None), (2001, ""), (2001, "")]
    labels += [(3000, 1, 1), (5, None, None), (None, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("score", "label", "a.b")})
    return frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("predictions,column,cut", [(toxicity.predictions, "toxic", 0.5), (quality_model.predictions, "quality", 0.3)])
def test_held_out_accuracy(marked, predictions, column, cut):
    docs, labels = marked
    rows = predictions(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r[column] for r in labels.collect()}
    tested = [r for r in rows if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert len(tested) > 100
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in tested) / len(tested) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= cut) for r in rows)


def test_swapped_terms_do_not_move_the_score(spark):
    """Insults are in half of the toxic texts only, a group term in most of them."""
    rng = random.Random(9)
    made = []
    for i in range(600):
        w, toxic = [f"w{rng.randrange(100)}" for _ in range(20)], i % 2
        w += ["scum"] * (toxic and rng.random() < 0.5) + ["muslims"] * (rng.random() < (0.8 if toxic else 0.1))
        made.append((" ".join(w), toxic))
    rows = spark.createDataFrame(made, "text string, label int")
    texts = spark.createDataFrame([(0, "muslims"), (1, "christians"), (2, "other")], "doc_id long, text string")

    def gap(model):
        scores = [r["score"] for r in toxicity.score(texts, model).collect()]
        odds = [np.log(s / (1 - s)) for s in scores]
        return max(odds) - min(odds)

    assert gap(toxicity.fit(rows, pair_weight=0.0)) > 1
    assert gap(toxicity.fit(rows)) < 0.1


def test_models_without_labels(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for predictions in (toxicity.predictions, quality_model.predictions):
        assert [r["predicted"] for r in predictions(docs, labels).collect()] == [0, 0]
        assert predictions(nothing, labels).collect() == []


def test_rules_of_a_tree():
    tree = "  If (feature 1 <= 2.0)\n   If (feature 1 <= 1.0)\n    Predict: 0.0\n   Else (feature 1 > 1.0)\n    Predict: 1.0\n  Else (feature 1 > 2.0)\n   Predict: 0.0\n"
    assert quality_model.paths(tree, ("a", "b")) == {
        (("b", "<=", 2.0),), (("b", "<=", 1.0),), (("b", "<=", 2.0), ("b", ">", 1.0)), (("b", ">", 2.0),),
    }


def test_decontamination_recall(spark, nothing):
    rng = random.Random(4)
    names = [f"v{i}" for i in range(250)]
    items = [(i, [rng.choice(names) for _ in range(rng.randrange(8, 60))]) for i in range(60)]
    docs, planted = [], set()
    for k in range(240):
        i, item = rng.choice(items)
        w = list(item)
        for _ in range(rng.choice([0, len(w) // 8, len(w) // 4])):
            at = rng.randrange(len(w))
            if rng.random() < 0.5:
                w[at] = rng.choice(names)
            elif rng.random() < 0.5:
                del w[at]
            else:
                w.insert(at, rng.choice(names))
        fill = [rng.choice(names) for _ in range(120)]
        docs.append((k, " ".join([*fill[:60], *w, *fill[60:]]).upper().replace(" ", ", ")))
    docs += [(300 + k, " ".join(rng.choice(names) for _ in range(200))) for k in range(60)] + [(400, None), (401, ""), (None, " ".join(items[0][1]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(90, None), (91, ""), (92, "too short"), (3, " ".join(items[3][1]))], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.find(frame, bench).collect()}
    want = {}
    for doc_id, text in docs:
        words = (text or "").lower().replace(",", "").split()
        for i, w in items:
            if len(set(words) & set(w)) > len(set(w)) // 2 and (d := brute.edit_match(w, words)) <= len(w) // 4:
                want[doc_id, i] = d
    assert len(set(found) & set(want)) >= 0.97 * len(want) and len(want) > 200
    assert all(want.get(k) == v for k, v in found.items())
    assert decontaminate.find(nothing, bench).collect() == []
    assert decontaminate.find(frame, bench.limit(0)).collect() == []


def test_recall_of_long_items(spark):
    """Items of 61 to 1000 words at the edit bound."""
    rng = random.Random(11)
    names = [f"v{i}" for i in range(5000)]
    items = [(i, [rng.choice(names) for _ in range((61, 150, 400, 1000)[i % 4])]) for i in range(120)]
    docs = []
    for i, w in items:
        w = list(w)
        for _ in range(len(w) // 4):
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            w[at:at + (kind != 1)] = [rng.choice(names)] if kind else []
        docs.append((i, " ".join([*(rng.choice(names) for _ in range(50)), *w, *(rng.choice(names) for _ in range(50))])))
    found = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    assert all(r["edits"] <= r["item_words"] // 4 for r in found)
    hit = [r["item_words"] for r in found if r["doc_id"] == r["item_id"]]
    print({n: hit.count(n) for n in (61, 150, 400, 1000)})
    assert [hit.count(n) for n in (61, 150, 400, 1000)] == [30] * 4


def test_short_items_and_scripts_without_spaces(spark):
    """Every item of up to four words, against brute force; items in Chinese, Japanese and Thai within texts."""
    rng = random.Random(8)
    items = [(i, [rng.choice("abcdefg") for _ in range(1 + i % 4)]) for i in range(40)]
    docs = [(i, [rng.choice("abcdefghijklmn") for _ in range(rng.randrange(1, 30))]) for i in range(60)]
    pairs = {(d, i): brute.edit_match(w, t) for d, t in docs for i, w in items}
    want = {k: n for k, n in pairs.items() if n <= len(items[k[1]][1]) // 4}
    han, kana, thai = "今天天氣很好我們去公園散步看花", "きょうはとてもいいてんきです", "วันนี้อากาศดีมากเราไปเดินเล่น"
    bench = [(i, " ".join(w)) for i, w in items] + [(100, han), (101, kana), (102, thai), (103, "don’t stop here — now please")]
    texts = [(d, " ".join(t)) for d, t in docs] + [(100, f"他說:「{han}。」然後走了"), (101, f"、{kana}。そして"), (102, f"ก็{thai}ครับ"), (103, "“don’t stop here, now please”"), (104, han[:5] + "也" + han[6:])]
    found = decontaminate.find(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["edits"] for r in found if r["item_id"] < 100 and r["doc_id"] < 100} == want and len(want) > 100
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in found if r["item_id"] >= 100} >= {(100, 100, 0), (101, 101, 0), (102, 102, 0), (103, 103, 0), (104, 100, 1)}


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 100)
    bench = spark.createDataFrame([(i, " ".join(f"i{i}w{k}" for k in range(12))) for i in range(9)], "item_id long, text string")
    docs = bench.select(F.col("item_id").alias("doc_id"), F.concat(F.lit("x y z "), "text").alias("text"))
    assert [(r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.find(docs, bench).orderBy("doc_id").collect()] == [(i, i, 0) for i in range(9)]


def test_blocks_are_saved_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 100)
    bench = spark.createDataFrame([(i, " ".join(f"i{i}w{k}" for k in range(12))) for i in range(4)], "item_id long, text string")
    found = decontaminate.find(bench.select(F.col("item_id").alias("doc_id"), "text"), bench)
    assert "MapInArrow" not in found._jdf.queryExecution().toString()
    assert [(r["doc_id"], r["item_id"]) for r in found.orderBy("doc_id").collect()] == [(i, i) for i in range(4)]


def test_licences(spark, nothing):
    docs = [
        (1, "Some text.\nLicensed under CC BY-NC 4.0.\nMore."), (2, "All rights reserved."), (3, None), (4, ""), (5, "my driving license\nI studied at MIT"),
        (6, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."), (None, "This work is licensed under the GNU General Public License, version 3."),
        (6, "nothing"),
    ]
    filler = [(100 + i, "\n".join(brute_line(i, k) for k in range(6))) for i in range(40)]
    frame = spark.createDataFrame(docs + filler, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("found", "family", "a.b")})
    rows = {(r["doc_id"], r["families"], r["n_confirmed"]) for r in licenses.summary(frame).collect()}
    assert {(1, "cc-by-nc", 1), (2, "all-rights-reserved", 1), (3, "", 0), (4, "", 0), (5, "", 0), (6, "apache-2.0,mit", 2), (None, "gpl-3.0", 1), (6, "", 0)} <= rows
    assert all(f == "" for d, f, _ in rows if d and d >= 100)
    plan = licenses.summary(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert licenses.summary(nothing).collect() == []


def test_wrapped_licences_and_bounds(spark):
    docs = [
        (1, "Released under the MIT\nLicense."), (2, "Prose.\n# Licensed under the Apache\n# License, Version\n# 2.0.\nMore."), (3, "The MIT\n\nLicense of it"),
        (4, "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this\nsoftware and associated documentation files"),
        (5, "Released under the MIT License.\nAll rights reserved."), (6, "MIT\nLicense\n\nBSD\nLicense"),
    ]
    filler = [(100 + i, "\n".join(brute_line(i, k) for k in range(6))) for i in range(40)]
    frame = spark.createDataFrame(docs + filler, "doc_id long, text string")
    model = licenses.fit(frame)
    found = {r["doc_id"]: [(x["line"], x["family"], x["similarity"] >= licenses.CONFIRMED) for x in r["found"]] for r in licenses.scan(frame, model).collect()}
    assert found[1] == [(0, "mit", True)] and found[3] == []
    assert [f[1:] for f in found[2]] == [("apache-2.0", True)] and [f[1:] for f in found[4]] == [("mit", True)]
    assert found[5] == [(0, "mit", True), (1, "all-rights-reserved", True)] and found[6] == [(0, "mit", True), (3, "bsd", True)]

    # What the bounds leave out is unknown to the model itself.
    rng, words = random.Random(3), sorted({w for g in model.weights for w in g.split(" ")})
    believed = 0
    for _ in range(3000):
        pieces = [rng.choice(list(model.weights) if rng.random() < 0.6 else words) for _ in range(rng.randint(1, 9))]
        tokens = " ".join(pieces).split(" ")
        some = {" ".join(tokens[i:i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1)}
        logits = [b + sum(model.weights[g][f] for g in some if g in model.weights) for f, b in enumerate(model.intercepts)]
        chances = [math.exp(v - max(logits)) for v in logits]
        if max(chances[1:]) / sum(chances) >= model.believed_from and chances[0] < 1:
            believed += 1
            assert not model.bounds or (sum(model.bounds.get(w, 0.0) for w in set(tokens)) >= 1 and set(tokens) & set(model.cues))
    assert believed > 20


def brute_line(i, k):
    rng = random.Random(100 * i + k)
    return " ".join(rng.choice(["the", "house", "river", "version", "under", "free", "state", "public", "road", "use", "see"]) for _ in range(9))


RULES = catalog.URL_RULES


def test_urls_and_links(spark):
    pages = [
        (1, "http://A.com/x", '<a href="http://bad.net/es/q">'), (2, "http://bad.net/es/1", None), (3, "http://linker.org/", "<a href='//bad.net/fr/'><a href=http://bad.net/es/z>"),
        (4, "http://clean.org/a?b#c", "<img src='https://a.com/i.png'>"), (5, None, None), (6, "nourl", ""), (7, "http://www.example.com/en/x", ""),
        (8, "http://x.www.example.com/en/x", ""), (9, "http://example.com/en/x?q", ""), (10, "http://example.com", ""), (11, "http://notexample.com/en/x", ""), (2, "http://bad.net/es/1", None), (12, "https://bad.net/de/", ""),
        (13, "http://friend.org/", '<a href="/own"><a href="https://linker.org/a">'),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("host", "n", "a.b")})
    assert got(url_filter.judge(frame, RULES)) == sorted([
        (1, "a.com", "/x", "com/", "allow"), (2, "bad.net", "/es/1", "net/es/", "block"), (2, "bad.net", "/es/1", "net/es/", "block"),
        (3, "linker.org", "/", None, "block"), (4, "clean.org", "/a", None, "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"),
        (7, "www.example.com", "/en/x", "www.example.com/en/", "allow"), (8, "x.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        (9, "example.com", "/en/x", "example.com/en/", "block"), (10, "example.com", "", None, "allow"), (11, "notexample.com", "/en/x", "com/", "allow"),
        (12, "bad.net", "/de/", None, "allow"), (13, "friend.org", "/", None, "block"),
    ], key=repr)
    plan = url_filter.judge(frame, RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert url_filter.judge(frame.limit(0), RULES).collect() == []


def test_busy_and_lonely_blocked_hosts(spark):
    """20 linkers of one blocked host; mostly blocked hosts without links; a host with few links to a blocked one."""
    pages = [(0, "http://hub.net/es/", None), *((1 + i, f"http://l{i}.org/", '<a href="http://hub.net/es/">') for i in range(20))]
    pages += [(30, "http://lone.net/es/1", ""), (31, "http://lone.net/fr/2", ""), (32, "http://lone.net/de/", "")]
    pages += [(40, "http://half.net/es/1", ""), (41, "http://half.net/de/", "")]
    pages += [(50, "http://wide.org/", '<a href="http://hub.net/es/">' + "".join(f'<a href="http://o{i}.org/">' for i in range(30)))]
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES).collect()}
    assert [found[1 + i] for i in range(20)] == ["block"] * 20
    assert [found[k] for k in (30, 31, 32, 40, 41, 50)] == ["block", "block", "block", "block", "allow", "allow"]


def test_ranks_like_power_iteration(spark):
    rng = random.Random(6)
    hosts = [f"h{i}" for i in range(12)]
    edges = {(a, b): rng.randrange(1, 4) for a in hosts for b in hosts if a != b and rng.random() < 0.2}
    start = {h: rng.choice([(1.0, 0.0), (0.0, 1.0), (0.5, 0.5), (0.0, 0.0)]) for h in hosts}
    found = {r["host"]: (r["trust"], r["distrust"]) for r in url_filter.propagate(
        spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "source string, target string, n long"),
        spark.createDataFrame([(h, *s) for h, s in start.items()], "host string, allowed double, blocked double")).collect()}
    out = {h: sum(n for (a, _), n in edges.items() if a == h) for h in hosts}
    into = {h: sum(n for (_, b), n in edges.items() if b == h) for h in hosts}
    got_t, got_d = dict.fromkeys(hosts, 0.0), dict.fromkeys(hosts, 0.0)
    for _ in range(url_filter.ROUNDS):
        t = {h: 0.15 * start[h][0] + got_t[h] for h in hosts}
        d = {h: (1 - start[h][0]) * (0.15 * start[h][1] + got_d[h]) for h in hosts}
        got_t, got_d = dict.fromkeys(hosts, 0.0), dict.fromkeys(hosts, 0.0)
        for (a, b), n in edges.items():
            got_t[b] += 0.85 * t[a] * n / out[a]
            got_d[a] += 0.85 * d[b] * n / into[b]
    for h in hosts:
        assert found[h] == pytest.approx((got_t[h], got_d[h]), abs=1e-9)
    assert max(got_d.values()) > 0.02


def test_pipeline_stages(spark, frame, corpus, tmp_path, marked):
    """Each stage on what the one before it kept, against brute force."""
    _, labels = marked
    items = [(0, corpus[0][1] or "none")]
    long = max((t for _, t in corpus if t and 60 < len(t.split()) < 300), key=len)
    items = [(0, " ".join(long.split()[:40]))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = frame
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard", "substring_dedup", "decontamination", "byte_bpe"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "byte_bpe":
            assert sorted((r["doc_id"], r["n_tokens"]) for r in out.where("doc_id IS NOT NULL").collect()) == sorted(
                (d, len(TIKTOKEN.encode_ordinary(t or ""))) for d, t in before if d is not None)
            break
        assert out.columns == docs.columns
        after = [(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()]
        if name == "ngram_jaccard":
            groups = brute.component_ids(before)
            assert len(after) == sum(n == 0 for _, n, _ in groups) + len({c for _, n, c in groups if n and c is not None}) + any(n and c is None for _, n, c in groups)
            assert {d for d, t in after if d is not None} == {d for d, n, c in groups if d is not None and (not n or c == d)}
        if name == "substring_dedup":
            cut = {(d, " ".join(w)): " ".join(x for x, f in zip(w, flags) if not f) for d, w, flags in brute.covered(before, lambda t: tuple(brute.words(t))) if any(flags)}
            assert sorted(after, key=repr) == sorted(((d, cut.get((d, " ".join(brute.words(t))), t)) for d, t in before), key=repr)
        if name == "decontamination":
            assert 0 < len(before) - len(after) <= 3
        docs = out
    assert corpus_pipeline.ORACLE_SQL is None

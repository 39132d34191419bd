import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string"


def sentence(rng, n, names=400):
    return " ".join(f"w{rng.randrange(names)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): copies, near copies, shared passages, NULLs, empty, blank, long and repeated rows."""
    rng = random.Random(5)
    base = [sentence(rng, rng.randrange(60, 200)) for _ in range(12)]
    passage, short = sentence(rng, 64), "one two three"
    docs = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):  # near copies, in a chain of growing changes
        w = t.split()
        for k in range(4):
            at = rng.randrange(len(w))
            w = [*w[:at], "changed", *w[at + 1:]]
            docs.append((100 + 10 * i + k, " ".join(w)))
    docs += [(300 + k, f"{sentence(rng, 30)}\n{passage}\n{sentence(rng, 25)}") for k in range(25)]
    docs += [(400 + k, base[0]) for k in range(20)]
    docs += [(450, base[1].upper()), (451, base[1].replace(" ", "\t\n ")), (452, base[2] + " "), (453, f"{base[3]} {base[3]}")]
    docs += [(500, None), (501, ""), (502, " \n\t "), (503, short), (504, short), (505, "One Two THREE"), (506, "solo"), (507, "a b c d e")]
    docs += [(600, "x" * 3000), (601, "x" * 500), (602, "ab " * 400), (603, "ab " * 30), (604, "é中\U0001f600 " * 60), (605, "é中\U0001f600 " * 40), (606, "nul \x00 byte " * 20)]
    docs += [(700, sentence(rng, 40_000, 3000)), (701, " ".join(base))]
    docs += [(5, base[5]), (5, base[5]), (5, sentence(rng, 80)), (None, base[6]), (None, base[6] + " more")]
    rng.shuffle(docs)
    return docs


@pytest.fixture(scope="session")
def frame(spark, corpus):
    """The corpus with columns whose names clash with outputs."""
    df = spark.createDataFrame(corpus, SCHEMA).repartition(5)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(7) for c in ("score", "kept", "node", "key", "n", "token", "n_words", "token_ids", "decoded", "marks", "label", "chars", "a.b")})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)

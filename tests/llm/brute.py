"""Plain forms of the corpus operators, for tests."""

import hashlib
import re
from collections import Counter

SPACE = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(SPACE, text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = words(lowered(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def component_ids(docs):
    """[(doc_id, text)] -> sorted [(doc_id, n_shingles, component_id)]; rows are nodes."""
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                up[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(top(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=repr)


def first_holders(docs, units, n):
    """{window: smallest id}; a NULL id is the smallest."""
    out = {}
    for doc_id, text in docs:
        key = -(2**63) if doc_id is None else doc_id
        u = units(text)
        for i in range(len(u) - n + 1):
            w = u[i:i + n]
            out[w] = min(out.get(w, key), key)
    return out


def covered(docs, units, n=50):
    """[(doc_id, units, covered flags)]."""
    holders = first_holders(docs, units, n)
    out = []
    for doc_id, text in docs:
        key = -(2**63) if doc_id is None else doc_id
        u = units(text)
        flags = [False] * len(u)
        for i in range(len(u) - n + 1):
            if holders[u[i:i + n]] < key:
                flags[i:i + n] = [True] * n
        out.append((doc_id, u, flags))
    return out


def suffix_rows(docs):
    out = []
    for doc_id, data, flags in covered(docs, lambda t: (t or "").encode()):
        kept = bytes(b for b, f in zip(data, flags) if not f)
        spans = sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags))
        out.append((doc_id, len(data), sum(flags), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def substring_rows(docs):
    out = []
    for doc_id, w, flags in covered(docs, lambda t: tuple(words(t))):
        kept = " ".join(x for x, f in zip(w, flags) if not f)
        out.append((doc_id, len(w), sum(flags), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def repeated(w, n):
    """Places in windows of n words that occur twice."""
    counts = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    flags = [False] * len(w)
    for i in range(len(w) - n + 1):
        if counts[tuple(w[i:i + n])] > 1:
            flags[i:i + n] = [True] * n
    return sum(flags)


def longest_repeat(w):
    for n in range(len(w) - 1, 0, -1):
        if len({tuple(w[i:i + n]) for i in range(len(w) - n + 1)}) < len(w) - n + 1:
            return n
    return 0


def repetition_row(doc_id, text):
    w = words(text)
    n, again = len(w), repeated(w, 5)
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = n < 10 or 100 * again > 20 * n
    cover, longest = repeated(w, 8), longest_repeat(w)
    kept = not failed and not (100 * cover > 15 * n or (longest > 25 and 100 * longest > 5 * n))
    return (doc_id, n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), again, failed, kept, cover)


def edit_match(item, text):
    """Fewest word edits that turn some words of ``text`` into ``item``."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)

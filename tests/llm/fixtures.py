"""Small tables with the awkward cases, and brute-force versions."""

from __future__ import annotations

import random

#: Names that the operators use inside, given to further columns of the input.
CLASHES = ["score", "shard", "slot", "copies", "target", "source_size", "part", "place", "at", "row_no", "leaf", "hash", "d", "h", "t", "a", "b",
           "component", "id", "n", "node", "gone", "gone_id", "turn", "expected", "start", "words", "toxicity", "tree", "lines_gone", "key", "spans", "own_t"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)

BASE = " ".join(f"w{i % 37}x{i}" for i in range(120))
NEAR = BASE.replace("w5x5", "changed")
LONG = " ".join(f"long{i}" for i in range(30_000))
TEXTS = [None, "", " ", "\n\n", "one", "two words", BASE, BASE, BASE, NEAR, BASE.upper(), LONG, "ünï çødé 日本語\nline two\n\nline four", "a\x0bb\tc  d",
         "aaaa" * 500, "x y " * 300]


def rows():
    """(doc_id, text, lang, source, n_chars, clashes...): null ids and columns, repeated rows and ids, ties."""
    out = [(i * 7 % 101, t, None if i % 3 else "en", [None, "", "s1", "S2", "ß"][i % 5], None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    out += [out[6], out[6], (None, BASE, "en", "s1", None), (None, "null key text", None, None, 3), (50, "same id", "en", "s1", 7), (50, "same id other text", "en", "s1", 18)]
    return [(*r, *("x" if i % 2 else None for i in range(len(CLASHES)))) for r in out]


def frame(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) or frozenset([tuple(words)])


def near_components(texts: dict, width: int, percent: int = 80) -> dict:
    """id -> smallest id reachable, by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def family(seed: int, count: int, words: int = 60, edits: int = 2):
    """Copies of one text with a few words changed."""
    r = random.Random(seed)
    base = [f"t{seed}v{r.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(count):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(words)] = f"e{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out

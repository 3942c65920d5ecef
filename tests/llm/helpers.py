"""Small tables with every odd case, and brute-force counterparts."""

from __future__ import annotations

import random
from itertools import combinations

CLASHING = ("size", "n", "label", "block", "key", "words", "run", "node", "target", "stratum", "host", "path",
            "paths", "held_out", "score", "kept", "keep_id", "bands", "digest", "shard", "html_", "c", "u", "v")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 400)) for _ in range(n))


def edited(text: str, seed: int, changes: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


def odd_documents() -> list[tuple]:
    """(doc_id, text, lang, source): nulls everywhere, empty and very long
    texts, white space of all kinds, ties and repeated rows."""
    base = prose(1, 120)
    rows = [
        (1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, base, None, None), (3, base, None, None),
        (4, None, "en", "b"), (5, "", None, "b"), (6, " \t\r\n\x0b\x0c ", "de", "b"), (7, "one two", "de", None),
        (8, "ONE  two\n", "de", "c"), (None, base, "en", "a"), (None, None, None, None),
        (9, "été É ñandú 日本語 🙂 " * 3, "fr", "c"), (10, prose(2, 30_000), "en", "a"),
        (11, "  ", "fr", "c"), (12, "12 34 !!", "fr", "c"), (13, "word " * 400, "en", "é"),
        (14, edited(base, 5, 3), "en", "a"), (15, edited(base, 6, 3), "en", "b"), (16, edited(base, 7, 60), "en", "b"),
        (17, "same line here\n" * 40, "en", ""), (18, "a\x00b c d", "en", "a"),
    ]
    return rows + [(100 + k, prose(50 + k, 20 + 7 * k), ("en", "de", "fr", None)[k % 4], ("a", "b", None)[k % 3])
                   for k in range(30)]


def documents(spark, rows=None):
    rows = odd_documents() if rows is None else rows
    schema = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], schema)


def words_of(text) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(text, width=5) -> frozenset:
    w = words_of(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1)))


def brute_components(rows: list[tuple]) -> dict:
    """Smallest id reachable by links of similarity 0.75 or more."""
    ids = sorted({r[0] for r in rows if r[0] is not None})
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None and shingles(r[1])]
    for (i, s), (j, t) in combinations(sets, 2):
        if 100 * len(s & t) >= 75 * len(s | t):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}

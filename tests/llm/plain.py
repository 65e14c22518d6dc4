"""Awkward documents, and plain-Python counterparts of the operators."""

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty, blank and very long texts, repeated rows, ties, clashing names."""
    sentence = "The quick brown fox jumps over the lazy dog near the old river bank today."
    long = " ".join(f"w{i % 977}" for i in range(150_000))
    rows = [
        (1, None, "a", 1),
        (2, "", "a", 1),
        (3, " \n\t ", "b", 1),
        (4, sentence + " " + sentence, "b", 2),
        (5, sentence + " " + sentence, "b", 2),
        (5, sentence + " " + sentence, "b", 2),
        (6, sentence.upper() + " " + sentence.upper(), None, None),
        (7, long, None, 3),
        (8, "x" * 700_000, "c", 3),
        (9, "one", "c", 3),
        (10, "one", "c", 3),
        (None, sentence, "c", 3),
        (11, "Größe ☃ 😀 " + sentence, "", 0),
        (12, "z" * 120, "a", 0),
    ]
    columns = "doc_id bigint, text string, source string, n int, component_id int, _doc string, _copies int, h int, node int"
    return spark.createDataFrame([(*r, i, "clash", 7, i, i) for i, r in enumerate(rows)], columns)


def shingles(text, words):
    found = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def near_groups(rows, words, percent=80):
    """doc_id -> (shingles, component), by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, words) for i, t in rows}
    held = {}
    for i, s in sets.items():
        for x in s:
            held.setdefault(x, set()).add(i)
    links = set()
    for i, s in sets.items():
        for j in {j for x in s for j in held[x] if j < i}:
            n = len(s & sets[j])
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                links.add((i, j))
    found = components(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}


def cut_repeats(rows, length=50):
    """doc_id -> (bytes, kept bytes, runs), window by window."""
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), kept, len(re.findall(b"\1+", bytes(gone))))
    return out

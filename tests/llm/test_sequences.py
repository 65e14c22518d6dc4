"""Tokenization automaton, periodic runs and the conversation trie against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import bpe_automaton, conversation_trie, periodic_runs
from clickloom.llm.queries import plant_runs
from plain import WORD, odd_docs  # noqa: F401


@pytest.fixture(scope="module")
def tables():
    return bpe_automaton.load()


def merged(word, merges):
    """Byte-pair encoding as it is defined: the best pair first, the leftmost of equals."""
    parts = [bytes([b]) for b in word]
    rank = {m: i for i, m in enumerate(merges)}
    while True:
        pairs = [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in rank]
        if not pairs:
            return parts
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_automaton_of_random_merges():
    rng = random.Random(5)
    for _ in range(60):
        tokens, merges = [b"a", b"b", b"c"], []
        for _ in range(rng.randint(0, 14)):
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in tokens:
                merges.append((a, b))
                tokens.append(a + b)
        ids = {t: i for i, t in enumerate(tokens)}
        automaton = bpe_automaton.compile_merges([(ids[a], ids[b], ids[a + b]) for a, b in merges], tokens, {})
        words = [bytes(rng.choices(b"abc", k=rng.randint(0, 30))) for _ in range(80)]
        for word, packed in zip(words, bpe_automaton._encode_words(automaton, words), strict=True):
            assert [tokens[t] for t in np.frombuffer(packed, "<u4")] == merged(word, merges)
        walk = bpe_automaton._Walk(automaton)
        assert [walk.encode(w) for w in words] == bpe_automaton._encode_words(automaton, words)


def texts():
    rng = random.Random(9)
    letters = "aAzé ßĐ中文字 कि١٢½Ⅷ²😀́‍\t\n\r\x1c\x85 's've_-.,!<>|\x00\U000105c0\U00010940꟎"
    soup = ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(400)]
    return [
        None, "", " ", "   \n\n  x", "a<|endoftext|>b", "<|endoftext|><|endoftext|> ", "<|endoftext|", "special <|endoftext|>",
        "I'll we've DON'T it's '", "x" * 200_000, "ab " * 50_000, "Grüße 你好，世界 नमस्ते", " " * 3000, "9" * 999, *soup,
    ]


def test_tokens_are_those_of_the_library(spark, odd_docs, tables):
    library = Tokenizer.from_file(bpe_automaton.MODEL)
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    docs = docs.unionByName(odd_docs.select("doc_id", "text"))
    out = bpe_automaton.encode_and_decode(docs, tables)
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert r.decoded == library.decode(want, skip_special_tokens=False) == (r.text or "")
    apart = bpe_automaton.decode(bpe_automaton.encode(docs, tables), tables)
    assert sorted(map(str, apart.collect())) == sorted(map(str, rows))


def test_decoding_of_odd_ids(spark, tables):
    library = Tokenizer.from_file(bpe_automaton.MODEL)
    packed = [None, b"", np.array([50256, 10**6, 72], "<u4").tobytes(), np.array([187, 200, 96, 72], "<u4").tobytes()]
    df = spark.createDataFrame([(i, bytearray(p) if p is not None else None) for i, p in enumerate(packed)], "decoded int, ids binary")
    out = bpe_automaton.decode(df, tables)
    assert out.columns == ["ids", "decoded"]
    assert {r.decoded for r in out.collect()} == {"", "<|endoftext|>i", library.decode([187, 200, 96, 72])}
    assert bpe_automaton.encode(df.selectExpr("'' text").limit(0), tables).collect() == []


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(
                words[i - q + r : j] == words[i - q : j - r] for r in range(1, q)
            ):
                out.append((i - q, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_texts():
    rng = random.Random(2)
    out = []
    for _ in range(400):
        words = []
        for _ in range(rng.randint(0, 5)):
            letters = [f"w{k}" for k in range(rng.choice([1, 2, 3, 6, 80]))]
            unit = rng.choices(letters, k=rng.randint(1, 40))
            words += [unit[i % len(unit)] for i in range(rng.randint(1, 6 * len(unit)))]
        out.append(rng.choice([" ", "\n", " \t "]).join(words))
    return out


def test_runs_are_all_found(spark, odd_docs):
    docs = spark.createDataFrame([(i, t, [1], "x") for i, t in enumerate(periodic_texts())], "doc_id long, text string, runs array<int>, collapsed string")
    odd = odd_docs.where("doc_id not in (7, 8) or doc_id is null").withColumn("runs", F.lit(None).cast("array<int>"))
    both = docs.unionByName(odd.select("doc_id", "text", "runs", F.lit("x").alias("collapsed")))
    out = periodic_runs.periodic_runs(both)
    assert out.columns == ["doc_id", "text", "runs", "collapsed"]
    rows = out.collect()
    assert len(rows) == both.count() and sum(len(r.runs) for r in rows) > 300
    for r in rows:
        words = WORD.findall(r.text or "")
        want = plain_runs(words)
        assert [tuple(x) for x in r.runs] == want
        gone = {k for s, n, q in want for k in range(s + q, s + n)}
        assert r.collapsed == " ".join(w for k, w in enumerate(words) if k not in gone)
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []


def test_runs_of_long_texts(spark):
    words = [f"w{i}" for i in range(30_000)]
    long = words + words[-5000:] * 4 + ["x"] * 20_000
    (row,) = periodic_runs.periodic_runs(spark.createDataFrame([(1, " ".join(long))], "doc_id long, text string")).collect()
    assert [tuple(x) for x in row.runs] == [(25_000, 25_000, 5000), (50_000, 20_000, 1)]
    assert row.collapsed == " ".join([*words, "x"])


def test_planted_runs(spark):
    data = [(i, f"  {' '.join(f'{i}-{k}' for k in range(i % 37))}\n") for i in range(400)] + [(None, "a b"), (7, None)]
    out = plant_runs(spark.createDataFrame(data, "doc_id long, text string"))
    for (i, text), r in zip(data, out.collect(), strict=True):
        words, want = WORD.findall(text or ""), text
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            want = " ".join(words[k] if k < a else words[a + (k - a) % p] for k in range(n))
        assert (r.doc_id, r.text) == (i, want)


def plain_trie(convs):
    """Rows of the trie of {id: [(role, text), ...]}."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, held in nodes.items():
        under = [p for p in nodes if p[: len(prefix)] == prefix]
        child = lambda p: [x for x in nodes if len(x) == len(p) + 1 and x[: len(p)] == p]
        ends = sorted(c for c in held if len(convs[c]) == len(prefix))
        out.append((
            min(held), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(held), len(child(prefix)),
            sum(not child(p) for p in under), sum((len(nodes[p]) - 1) * len(WORD.findall(p[-1][1])) for p in under if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def conversations(seed):
    rng = random.Random(seed)
    rows, convs = [], {}
    said = [("user", "hello there"), ("assistant", "yes"), ("user", ""), (None, None), ("", "a\tb  c"), ("us", "erhello there")]
    for c in rng.sample(range(-60, 400), 120):
        turns = rng.choices(said, [6, 3, 1, 1, 1, 1], k=rng.choice([1, 2, 3, 4, 30]))
        if rng.random() < 0.4:
            turns = [said[0], said[1]] * 2  # a third of all are the same
        numbers = [None if k == 0 and rng.random() < 0.3 else k for k in range(len(turns))]
        rows += [(n, c, r, t) for n, (r, t) in zip(numbers, turns, strict=True)]
        convs[c] = [(r or "", t or "") for r, t in turns]
    rng.shuffle(rows)
    return rows, convs


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_trie(spark, shards):
    rows, convs = conversations(shards)
    df = spark.createDataFrame([(t, "x", r, c, n) for n, c, r, t in rows] + [("t", "x", "r", None, 1)], "text string, key string, role string, conv_id long, turn int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        found = conversation_trie.sequences(df)
        got = conversation_trie.prefix_trie(found)
        assert sorted(map(tuple, got.collect()), key=str) == plain_trie(convs)
        # Openings of other conversations; some conversations are left without a turn.
        n = F.abs(F.col("conv_id")) % 4
        shared = conversation_trie.share_openings(found, found.where("conv_id % 7 = 0"), F.col("conv_id") - F.col("conv_id") % 7, n)
        want = {}
        for c, turns in convs.items():
            base = c - (c % 7 if c >= 0 else -(-c % 7))
            h = abs(c) % 4
            want[c] = convs.get(base, [])[:h] + turns[h:]
        got = conversation_trie.prefix_trie(shared)
        assert sorted(map(tuple, got.collect()), key=str) == plain_trie(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trie_of_ties_and_of_nothing(spark):
    rows = [(1, 0, "b", "y"), (1, 0, "a", "z"), (1, 0, "a", "z"), (1, None, None, "first"), (2, 5, "", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = conversation_trie.prefix_trie(conversation_trie.sequences(df))
    want = {1: [("", "first"), ("a", "z"), ("a", "z"), ("b", "y")], 2: [("", "first")]}
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(want)
    assert conversation_trie.prefix_trie(conversation_trie.sequences(df.limit(0))).collect() == []


def test_find_close():
    rng = random.Random(3)
    for _ in range(40):
        steps, depth = [1], 1
        most = rng.choice([10, 300, 3000])
        while depth:
            if len(steps) < most and (depth == 1 or rng.random() < 0.55):
                steps.append(1)
            else:
                steps.append(-1)
            depth += steps[-1]
        stack, want = [], {}
        for i, s in enumerate(steps):
            if s > 0:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opened = np.array(sorted(want))
        tree = conversation_trie.Parentheses(np.array(steps, np.int8))
        assert tree.find_close(opened).tolist() == [want[i] for i in opened.tolist()]
        pairs = [m.start() for m in re.finditer(r"\(\)", "".join("(" if s > 0 else ")" for s in steps))]
        assert tree.pairs.tolist()[:-1] == [sum(p < i for p in pairs) for i in range(len(steps))]

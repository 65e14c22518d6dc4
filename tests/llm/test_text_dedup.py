"""Near-duplicate texts, repeated substrings and repeated sentence spans against brute force."""

import re

import pyarrow as pa
import pytest
from conftest import rows

from clickloom.llm import near_text, repeats, sentence_spans
from clickloom.llm.common import Scratch, components
from plain import WORD, cut_repeats, near_groups, odd_docs  # noqa: F401


def _texts(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(spark, sf_dir, words):
    docs = _texts(spark, sf_dir)
    want = near_groups([tuple(r) for r in docs.collect()], words)
    got = near_text.near_duplicates(docs, words=words).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_odd_rows(odd_docs):
    got = rows(near_text.near_duplicates(odd_docs, words=4).select("doc_id", "n_shingles", "component_id"))
    by_id = {r[0]: r[1:] for r in got}
    assert len(got) == 13  # all but the row without an id
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[3] == (0, 3)
    assert by_id[4][1] == by_id[5][1] == by_id[6][1] == 4
    assert by_id[9] == (1, 9) and by_id[10] == (1, 9)
    assert by_id[8] == (1, 8) and by_id[7][0] == 977


def test_a_star_with_an_unlike_centre_loses_no_link(spark):
    """A chain: neighbours are similar, ends are not; and many variants of one text."""
    base = [f"w{i}" for i in range(100)]
    chain = [" ".join(base[k * 6 :] + [f"n{j}" for j in range(k * 6)]) for k in range(12)]
    variants = [" ".join([*base[:50], *[f"v{k}_{i}" if (i * 7 + k) % 11 == 0 else f"t{i}" for i in range(50)]]) for k in range(40)]
    data = list(enumerate(chain + variants, 100))
    got = near_text.near_duplicates(spark.createDataFrame(data, "doc_id bigint, text string"), words=4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == near_groups(data, 4)


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(200, 100), (150, 200), (300, 300)]
    got = dict(rows(components(spark.createDataFrame(chain, "a bigint, b bigint"))))
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 150: 100, 200: 100}


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_repeated_bytes(spark, sf_dir, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    docs = _texts(spark, sf_dir)
    want = cut_repeats([tuple(r) for r in docs.collect()])
    with Scratch(spark) as scratch:
        got = repeats.remove_repeats(docs.repartition(7), scratch).collect()
    assert {r.doc_id: (r.n_bytes, bytes(r.kept), len(r.removed)) for r in got} == want


def test_repeated_bytes_of_odd_rows(spark, odd_docs):
    want = cut_repeats([(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id is not None])
    with Scratch(spark) as scratch:
        got = repeats.remove_repeats(odd_docs, scratch).collect()
    assert len(got) == 13
    assert all((r.n_bytes, bytes(r.kept), len(r.removed)) == want[r.doc_id] for r in got)


def _cut_spans(data):
    """The rule of the operator, sentence by sentence."""
    def units(text):
        found, now = [], []
        words = list(WORD.finditer(text))
        for k, m in enumerate(words):
            now.append(m)
            last = k + 1 == len(words)
            if last or m.group()[-1] in ".!?" or "\n" in text[m.end() : words[k + 1].start()] or len(now) == sentence_spans.MOST_WORDS:
                found.append(now)
                now = []
        return found

    first, texts = {}, sorted((i, t or "") for i, t in data)
    for i, t in texts:
        u = units(t)
        for k in range(len(u) - 1):
            key = tuple(tuple(m.group() for m in s) for s in u[k : k + 2])
            if sum(map(len, key)) >= sentence_spans.LEAST_WORDS:
                first.setdefault(key, (i, k))
    out = {}
    for i, t in texts:
        u = units(t)
        gone = set()
        for k in range(len(u) - 1):
            key = tuple(tuple(m.group() for m in s) for s in u[k : k + 2])
            if first.get(key, (i, k)) != (i, k):
                gone |= {k, k + 1}
        at = [s[0].start() for s in u] + [len(t)]
        left = t[: at[0]] + "".join(t[a:b] for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if k not in gone)
        out[i] = (len(u), len(gone), left)
    return out


def test_repeated_spans(spark, sf_dir):
    docs = _texts(spark, sf_dir)
    got = sentence_spans.remove_repeated_spans(docs).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == _cut_spans([tuple(r) for r in docs.collect()])


def test_repeated_spans_of_odd_rows(odd_docs):
    got = rows(sentence_spans.remove_repeated_spans(odd_docs))
    want = _cut_spans({r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}.items())
    assert len(got) == 13 and all(r[1:] == want[r[0]] for r in got)
    assert want[4][1] == 0 and want[5][2] == ""


def test_repeated_spans_of_short_sentences(spark):
    """A passage of 60 words in sentences of one and four words goes whole, its last short ones too."""
    passage = " ".join(f"Yes{i}! We saw p{i} there." for i in range(12))
    listed = "\n".join(f"item{i}" for i in range(60))
    ends = "This sentence alone has as many words as a run must hold. One. Two more."
    data = [(1, f"Before it all. {passage} After it all."), (2, passage), (3, f"Something else here. {passage} The end of it."),
            (4, listed), (5, f"Title\n{listed}\nFoot"), (6, f"Quite another start. {ends} Here it ends."), (7, f"New. {ends} Other words come."),
            (8, "One. Two more."), (9, "One. Two more.")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    out = sentence_spans.remove_repeated_spans(docs, whole=True).collect()
    left = {r.doc_id: r.text.split() for r in out}
    assert [left[i] for i in (1, 4, 6, 8, 9)] == [dict(data)[i].split() for i in (1, 4, 6, 8, 9)]
    assert left[2] == [] and left[3] == "Something else here. The end of it.".split()
    assert left[5] == ["Title", "Foot"] and left[7] == "New. Other words come.".split()


def test_repeated_spans_without_full_stops(spark):
    """A passage of 60 words and no full stop, at several places of longer sentences and as a text."""
    passage = [f"word{i}" for i in range(60)]
    new = lambda k, n: [f"new{k}x{i}" for i in range(n)]
    data = [(1, new(1, 7) + passage + new(2, 30)), (2, new(3, 20) + passage + new(4, 3)), (3, passage), (4, new(5, 90))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in data], "doc_id bigint, text string")
    left = {r.doc_id: r.text.split() for r in sentence_spans.remove_repeated_spans(docs, whole=True).collect()}
    assert left[1] == data[0][1] and left[4] == data[3][1]
    edge = sentence_spans.WINDOW - 1
    for i in (2, 3):
        assert not set(passage[edge:-edge]) & set(left[i]), left[i]
        assert [w for w in left[i] if w.startswith("new")] == [w for w in data[i - 1][1] if w.startswith("new")]


def _cut_passages(data):
    """Sentences of a run of two or more with ten words or more that occurred before, all run lengths tried."""
    units = {}
    for i, t in sorted(data):
        b = t.encode()
        at = [begin.tolist() for _, _, _, begin, _, _ in sentence_spans.sentences(pa.array([t]), whole=True)]
        at = [*(at[0] if at else []), len(b)]
        units[i] = b, at, [tuple(WORD.findall(b[x:y].decode())) for x, y in zip(at[:-1], at[1:], strict=True)]
    first, out = {}, {}
    runs = lambda u: ((k, n) for k in range(len(u)) for n in range(2, min(12, len(u) - k) + 1) if sum(map(len, u[k : k + n])) >= 10)
    for i, (_, _, u) in units.items():
        for k, n in runs(u):
            first.setdefault(tuple(u[k : k + n]), (i, k))
    for i, (b, at, u) in units.items():
        gone = {j for k, n in runs(u) if first[tuple(u[k : k + n])] != (i, k) for j in range(k, k + n)}
        left = b[: at[0]] + b"".join(b[at[j] : at[j + 1]] for j in range(len(u)) if j not in gone)
        out[i] = (len(u), len(gone), left.decode())
    return out


def test_repeated_passages(spark, sf_dir):
    docs = _texts(spark, sf_dir)
    got = sentence_spans.remove_repeated_spans(docs, whole=True).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == _cut_passages([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("run", [
    lambda d: near_text.near_duplicates(d),
    lambda d: sentence_spans.remove_repeated_spans(d),
])
def test_empty_tables(odd_docs, run):
    assert run(odd_docs.where("doc_id > 999")).collect() == []


def test_empty_table_of_bytes(spark, odd_docs):
    with Scratch(spark) as scratch:
        assert repeats.remove_repeats(odd_docs.where("doc_id > 999"), scratch).collect() == []


def test_word_rule():
    assert re.fullmatch(WORD, "a b")

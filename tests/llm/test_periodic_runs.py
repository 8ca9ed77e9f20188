"""Runs of repeated words against the definition, tried for every start and period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import periodic_runs
from millwright.llm.queries import QUERIES
from tests.llm.helpers import WORD, awkward_texts, documents

SF = "/root/testdata/sf0.001"


def smallest_period(words):
    return next(p for p in range(1, len(words) + 1) if words[p:] == words[: len(words) - p])


def brute_runs(words):
    """Maximal stretches of every period, kept if that is their smallest one."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            if end - start >= max(6, 4 * q) and smallest_period(words[start:end]) == q:
                found.append((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = brute_runs(words)
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    milli = None if top[0] is None else 1000 * top[1] // top[2]
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs))]
    return (doc_id, len(runs), *top, milli, *digests)


def periodic_texts(seed, n):
    """Random words of small alphabets with powers of random words in them."""
    rng = random.Random(seed)
    for _ in range(n):
        alphabet = "abcdefgh"[: rng.randrange(1, 9)]
        words = []
        for _ in range(rng.randrange(1, 6)):
            words += [rng.choice(alphabet) for _ in range(rng.randrange(0, 12))]
            unit = [rng.choice(alphabet) for _ in range(rng.randrange(1, 14))]
            length = rng.randrange(1, 6 * len(unit) + 1)
            words += (unit * 7)[:length]
        yield words


def test_classes_cover_all_lags():
    for longest in (0, 5, 6, 40, 20_000):
        classes = list(periodic_runs.lag_classes(longest))
        lags = [q for low, high, _ in classes for q in range(low, high + 1)]
        assert lags == list(range(1, len(lags) + 1))
        assert len(lags) >= (longest // 4 if longest >= 6 else 0)
        for low, high, k in classes:
            # The shortest diagonal holds a k-gram, and a k-gram holds the longest lag twice.
            assert all(max(6, 4 * q) - q >= k for q in range(low, high + 1))
            assert k >= 2 * high


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_the_definition(seed):
    texts = list(periodic_texts(seed, 150))
    texts += [["x"] * n for n in range(9)] + [list("ab" * 200), list("aab" * 30 + "b" * 40), []]
    flat = [(t, w) for t, words in enumerate(texts) for w in words]
    number = {pair: i for i, pair in enumerate(dict.fromkeys(flat))}
    codes = np.array([number[pair] for pair in flat], np.int64)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    got = [[] for _ in texts]
    for s, e, q in periodic_runs.runs_of(codes, ends):
        t = int(np.searchsorted(ends, s, side="right"))
        got[t].append((s - int(starts[t]), e - s, q))
    assert got == [brute_runs(t) for t in texts]


def test_operator_on_awkward_texts(spark):
    texts = [*awkward_texts(), *(" ".join(w) for w in periodic_texts(9, 60))]
    docs = documents(spark, texts)
    found = periodic_runs.find_runs(
        docs, periodic_runs.words_of(F.col("text")), carry=["doc_id", "value"]
    )
    assert found.columns == ["doc_id", "value", "n_words", "runs", "collapsed"]
    for row in found.collect():
        words = WORD.findall(texts[row.doc_id] or "")
        runs = brute_runs(words)
        assert row.n_words == len(words)
        assert [tuple(r) for r in row.runs] == runs
        assert row.collapsed == collapsed(words, runs)


def test_query_matches_brute_force(spark, tmp_path):
    """Whole result, with nulls, repeated ids and a clashing column."""
    rows = [(None, "a " * 30), (7, "b " * 30), (7, "b " * 30), (-3, None), (5, "")]
    rows += [(i, t) for i, t in enumerate([*awkward_texts(3), *(" ".join(w) for w in periodic_texts(5, 80))])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.withColumns({c: F.lit("x") for c in ("words", "runs", "h", "own", "a", "p")}).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    got = sorted(map(tuple, QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((expected(i, t) for i, t in rows), key=repr)
    assert sum(r[1] for r in got) > 100


def test_query_on_a_sample_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars < 4000").collect()
    want = {r.doc_id: expected(r.doc_id, r.text) for r in docs}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert {i: got[i] for i in want} == want


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect() == []


def test_long_run_is_linear():
    words = np.zeros(2_000_000, np.int64)
    assert periodic_runs.runs_of(words, np.array([len(words)])) == [(0, len(words), 1)]

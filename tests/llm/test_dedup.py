"""Suffix and SimHash deduplication against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
import xxhash

from millwright.llm import simhash, suffix_dedup
from tests.llm.helpers import WORD, awkward_texts, documents, rows_of


def repeats_by_brute_force(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in enumerate(raw):
        covered = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                covered[k : k + length] = True
        spans = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out.append((i, len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repetitive_texts(seed=5, n=60):
    rng = random.Random(seed)

    def letters(k):
        return "".join(rng.choice("abcdeé fgh\n") for _ in range(k))

    parts = [letters(k) for k in (199, 200, 201, 230, 350, 700, 180)]
    texts = [None, "", "b" * 199, "c" * 200, "d" * 201, "xy" * 300]
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 5)):
            kind, part = rng.random(), rng.choice(parts)
            if kind < 0.45:
                text += part
            elif kind < 0.6:
                at = rng.randint(0, len(part))
                text += part[:at] + rng.choice("xyz") + part[at:]
            elif kind < 0.7:
                text += "a" * rng.randint(100, 500)
            else:
                text += letters(rng.randint(1, 300))
        texts.append(text)
    return [*texts, texts[9], texts[9]]


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize(("block", "window"), [(4_000_000, 2_000_000), (3000, 2_000_000), (3000, 700)])
def test_repeats(spark, monkeypatch, block, window):
    monkeypatch.setattr(suffix_dedup, "WINDOW_STARTS", window)
    texts = repetitive_texts()
    got = suffix_dedup.remove_repeats(documents(spark, texts), block_bytes=block)
    assert rows_of(got, *COLUMNS) == sorted(repeats_by_brute_force(texts), key=repr)


def test_repeats_with_text_and_other_columns(spark):
    texts = repetitive_texts(seed=8)
    got = suffix_dedup.remove_repeats(documents(spark, texts), with_text=True, carry=["lang", "key"])
    for row in got.collect():
        raw = (texts[row.doc_id] or "").encode()
        assert (row.carried.lang, row.carried.key) == ("en", "x")
        assert sum(s.end - s.start for s in row.spans) == row.n_removed
        if not row.n_spans:
            assert row.kept_text == raw.decode()
        assert len(raw) - row.n_removed <= len(row.kept_text.encode()) <= len(raw) - row.n_removed + 2 * row.n_spans


def test_repeats_of_an_empty_table(spark):
    assert suffix_dedup.remove_repeats(documents(spark, ["a"]).limit(0)).count() == 0


def test_suffix_order_of_the_dictionary():
    rng = random.Random(4)
    data = np.frombuffer("".join(rng.choice("ab") for _ in range(600)).encode(), np.uint8)
    starts = np.array([i for i in range(580) if rng.random() < 0.7])
    raw = data.tobytes()
    order = starts[suffix_dedup.dictionary_order(data, starts, 20)]
    assert [raw[i : i + 20] for i in order] == sorted(raw[i : i + 20] for i in starts)
    first, sizes = suffix_dedup.classes(data, starts, 9)
    counts = collections.Counter(raw[i : i + 9] for i in starts)
    assert {raw[i : i + 9]: n for i, n in zip(first, sizes)} == counts


def fingerprint_by_brute_force(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_brute_force(fingerprints, bits=4):
    parent = list(range(len(fingerprints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(parent)):
        for b in range(a):
            if (fingerprints[a] ^ fingerprints[b]).bit_count() <= bits:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(parent))]


def test_near_duplicates(spark):
    texts = awkward_texts()
    base = " ".join(f"w{i}" for i in range(300))
    texts += [base.replace(f"w{k} ", "other ") for k in range(0, 300, 9)]
    fps = [fingerprint_by_brute_force(t) for t in texts]
    roots = components_by_brute_force(fps)
    got = simhash.near_duplicates(documents(spark, texts))
    want = [(i, f"{f:016x}", r) for i, (f, r) in enumerate(zip(fps, roots))]
    assert rows_of(got, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    assert simhash.near_duplicates(documents(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("list_length", [2, 8192])
def test_links_connect_what_is_close(spark, list_length):
    """Dense groups, chains and strangers; short and long posting lists give the same."""
    rng = random.Random(7)
    fps = []
    for _ in range(12):
        centre = rng.getrandbits(64)
        fps += [centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 6))) for _ in range(15)]
    fps = list(dict.fromkeys(f & (2**64 - 1) for f in fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    found = simhash.components(simhash.links(distinct, list_length=list_length)).collect()
    root = {r.node: r.root for r in found}
    want = components_by_brute_force(fps)
    groups, mine = collections.defaultdict(set), collections.defaultdict(set)
    for i, f in enumerate(signed):
        groups[want[i]].add(f)
        mine[root.get(f, f)].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_covering_triples():
    from itertools import combinations

    triples = set(simhash.covering_triples())
    assert len(triples) == 20
    for four in combinations(range(8), 4):
        assert any(t in triples for t in combinations(four, 3))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901)], "a bigint, b bigint")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert {roots[i] for i in range(1, 201)} == {0}
    assert roots[901] == 900

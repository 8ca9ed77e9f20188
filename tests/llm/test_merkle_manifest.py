"""Proofs of the hash tree against one built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from millwright.llm import merkle_manifest
from millwright.llm.queries import QUERIES
from tests.llm.helpers import awkward_texts

DDL = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    if value is None:
        return "-"
    text = str(value)
    return f"{len(text.encode())}:{text}"


def leaf(row, lowered=False):
    doc_id, source, lang, n_chars, text = row
    if lowered and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return digest(*map(field, (doc_id, source, lang, n_chars, text)))


def tampered(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0


def climb(level):
    """Top of a level, and per node the siblings with their places on the way up."""
    paths = [[] for _ in level]
    at = list(range(len(level)))
    while len(level) > 1:
        runs = [level[i : i + 16] for i in range(0, len(level), 16)]
        for k, i in enumerate(at):
            run, place = runs[i // 16], i % 16
            paths[k].append((run[:place], run[place + 1 :]))
            at[k] = i // 16
        level = [digest(*run) for run in runs]
    return level[0], paths


def expected(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        mine = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = (mine, *climb([leaf(r) for r in mine]))
    root, upper = climb([trees[s][1] for s in order])
    out = []
    for source, above in zip(order, upper, strict=True):
        mine, subroot, paths = trees[source]
        for row, path in zip(mine, paths, strict=True):
            steps = path + above
            proof = digest(*(d for before, after in steps for d in (*before, *after)))
            folded = leaf(row, tampered(row))
            for before, after in steps:
                folded = digest(*before, folded, *after)
            out.append((row[0], leaf(row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def corpus(n, sources, seed=0):
    rng = random.Random(seed)
    texts = [*awkward_texts(seed, 20), "lower case only", "ÀÉ", "MIXED Case"]
    rows = [
        (rng.randrange(3 * n), rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 5]), rng.choice(texts))
        for _ in range(n)
    ]
    return [*rows, *rows[: n // 10]]


@pytest.mark.parametrize(
    ("rows"),
    [
        corpus(700, ["a", "b", "é", "Z", "", "-", "=a", None]),
        [(i, "hot" if i % 3 else f"s{i}", "en", 1, f"Text {i}") for i in range(900)],
        [(i, "one", None, None, f"T{i}") for i in range(300)],
        [(5, None, None, None, "Only ONE")],
        [(5, "a", None, None, None), (None, "b", "x", 3, "Nobody"), (None, "b", "x", 3, "Nobody")],
    ],
)
def test_query_matches_plain_python(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, DDL).repartition(5)
    docs.withColumns({c: F.lit("x") for c in ("tree", "node", "leaf", "place", "size")}).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    got = QUERIES["op12_merkle_manifest"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_upper_nodes_are_stored_in_copies(spark, monkeypatch):
    """A source's upper nodes are dealt out over several keys, with the same proofs."""
    rows = [(i, "hot", "en", 1, f"Text {i}") for i in range(600)]
    leaves = merkle_manifest.leaves_of(spark.createDataFrame(rows, DDL))
    monkeypatch.setattr(merkle_manifest, "RUNS_PER_COPY", 2)
    manifest = merkle_manifest.build(leaves)
    assert manifest.nodes.agg(F.max("copies")).first()[0] > 5
    proofs = merkle_manifest.proof_digests(merkle_manifest.prove(manifest))
    assert sorted(map(tuple, proofs.collect()), key=repr) == expected(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_merkle_manifest"](spark, str(tmp_path))
    assert dict(got.dtypes)["verified"] == "boolean"
    assert got.collect() == []

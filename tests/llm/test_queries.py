"""The registered corpus queries over whole small tables, and the pipeline."""

import pathlib
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from millwright.llm import minhash, simhash
from millwright.llm.oracles import ORACLES
from millwright.llm.queries import QUERIES
from millwright.sources.staging import stage, staged_scope, staging_root

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF).toArrow()
    want = connection.sql(ORACLES[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    names = sorted(got.column_names)

    def rows(table):
        return sorted(zip(*[table[c].to_pylist() for c in names], strict=True), key=repr)

    assert rows(got) == rows(want)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stage(step(spark, docs, SF))
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
            assert docs.count() <= before
            assert docs.count() == docs.select("doc_id").distinct().count()
            assert docs.filter("n_chars <> length(text)").count() == 0
    assert docs.count() > 0


def test_pipeline_keeps_clean_documents_and_drops_the_rest(spark):
    clean = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    rows = [(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, "123 456", "en", "s", 7)]
    odd = spark.createDataFrame(rows, clean.schema)
    kept = corpus_pipeline.language(spark, clean.unionByName(odd), SF)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in clean.collect()}
    copies = clean.unionByName(clean.selectExpr("doc_id + 5000 AS doc_id", "text", "lang", "source", "n_chars"))
    unique = corpus_pipeline.near_duplicates(spark, copies, SF)
    assert unique.filter("doc_id >= 5000").count() == 0
    twice = corpus_pipeline.near_duplicates(spark, clean.unionByName(clean), SF)
    assert twice.count() == unique.count()


def similarity(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_pipeline_drops_near_duplicates_from_a_similarity_of_0_8(spark):
    rng = random.Random(2)
    rows, dropped, kept = [], set(), set()
    for k, (n, changed) in enumerate([(300, 3), (300, 6), (300, 7), (1000, 4), (1000, 20), (60, 1), (300, 14)] * 20):
        words = [f"w{rng.randrange(5000)}" for _ in range(n)]
        copy = list(words)
        for at in rng.sample(range(n), changed):
            copy[at] = f"new{rng.randrange(5000)}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
        (dropped if similarity(rows[-2][1], rows[-1][1]) >= 0.8 else kept).add(2 * k + 1)
    assert len(dropped) > 80 and len(kept) > 20
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "bigint(length(text)) AS n_chars"
    )
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert got == {i for i, _ in rows} - dropped


def test_pipeline_keeps_different_texts_under_null_and_repeated_ids(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcdef"}
    rows = [(None, text["a"]), (None, text["b"]), (None, text["b"]), (7, text["c"]), (7, text["d"])]
    rows += [(3, text["d"]), (None, text["e"]), (9, text["e"]), (5, text["f"]), (5, text["f"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "bigint(length(text)) AS n_chars"
    )
    got = corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id", "text").collect()
    want = [(None, "a"), (None, "b"), (7, "c"), (3, "d"), (9, "e"), (5, "f")]
    assert sorted(map(tuple, got), key=repr) == sorted([(i, text[k]) for i, k in want], key=repr)


@pytest.mark.parametrize("block_entries", [1, 3, 1024])
def test_links_connect_what_is_similar(spark, block_entries):
    """Long lists in blocks give the same groups as brute force over all pairs."""
    rng = random.Random(3)
    texts = []
    for n in (1, 4, 30, 200):
        words = [f"w{rng.randrange(900)}" for _ in range(n)]
        for _ in range(25):
            texts.append(" ".join(words))
            words[rng.randrange(n)] = f"w{rng.randrange(900)}"
    sets = {minhash.set_name(s): s for s in map(minhash.shingle_set, texts)}
    names = {minhash.set_name(minhash.shingle_set(t)): t for t in texts}
    entries = spark.createDataFrame(list(names.items()), "set_name string, text string")
    found = minhash.links(entries, block_entries=block_entries).collect()
    close = {
        (a, b)
        for a in sets for b in sets
        if a < b and len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))
    }

    def groups(edges):
        of = {a: {a} for a in sets}
        for a, b in edges:
            if of[a] is not of[b]:
                of[a] |= of[b]
                for c in of[b]:
                    of[c] = of[a]
        return {frozenset(g) for g in of.values()}

    assert {tuple(sorted((r.a, r.b))) for r in found} <= close
    assert groups(close) == groups([(r.a, r.b) for r in found])


def test_simhash_links_near_copies_before_any_band(spark, monkeypatch):
    """Without bands, copies whose fingerprints are near still go, and no pair below the threshold."""
    monkeypatch.setattr(minhash, "_postings", lambda entries: spark.createDataFrame([], "key bigint, start bigint"))
    rng = random.Random(5)
    rows, near = [(100, ""), (101, None), (102, "w1")], set()
    for k in range(20):
        words = [f"w{rng.randrange(5000)}" for _ in range(600)]
        copy = [*words[:300], "new", *words[301:]]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
        prints = [simhash.fingerprint(t, minhash.SHINGLE_WORDS) for _, t in rows[-2:]]
        if (prints[0] ^ prints[1]).bit_count() <= simhash.MAX_BITS:
            near.add(2 * k + 1)
    assert len(near) > 10
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "bigint(length(text)) AS n_chars"
    )
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert got == {i for i, _ in rows} - near - {101}


@pytest.mark.parametrize(("strangers", "most"), [(0, 0), (3, 400 + 3 * 40), (25, 3 * 400 + 25 * 40)])
def test_second_round_meets_only_what_is_not_connected(spark, strangers, most):
    """A list of 400 entries in 40 blocks; each stranger still meets every entry."""
    postings = spark.createDataFrame([(1, i) for i in range(400)], "key bigint, start bigint")
    lists = spark.createDataFrame([(1, 40)], "key bigint, blocks int")
    rows = [(i, f"own {i}" if i < strangers else "all") for i in range(400)]
    trees = spark.createDataFrame(rows, "start bigint, tree string")
    met = minhash._left_open(postings, lists, trees, 10).collect()
    assert len(met) <= most
    tasks = {}
    for row in met:
        tasks.setdefault(row["at"], set()).add(row.start)
    for i in range(strangers):
        assert set().union(*(t for t in tasks.values() if i in t)) == set(range(400))


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF))
    assert docs.count() == 0


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op6_token_binary", "op10_warc", "op12_merkle_manifest"])
def test_queries_leave_nothing_behind(spark, name):
    """No file and no catalog table is left once the scope is over."""
    root = staging_root(spark)

    def held():
        return {p for p in pathlib.Path(root).rglob("*")}, {t.name for t in spark.catalog.listTables()}

    before = held()
    with staged_scope(spark):
        QUERIES[name](spark, SF).count()
    files, tables = held()
    assert {p for p in files - before[0] if p.name != f"millwright-{spark.sparkContext.applicationId}"} == set()
    assert tables == before[1]

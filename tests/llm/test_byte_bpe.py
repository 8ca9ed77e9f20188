"""Ids and decoded bytes against the library over whole texts."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from millwright.llm import byte_bpe
from millwright.llm.queries import QUERIES
from tests.llm.helpers import awkward_texts, documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def odd_texts(seed, n):
    """White space of all kinds, contractions, digits, long words, other scripts, special strings."""
    rng = random.Random(seed)
    parts = [
        " ", "  ", "\n", "\n\n ", "\t", "\r\n", " ", " ", "　", "\x1c", "\x85",
        "'s", "'re", "'LL", "'", "it's", "we've", "x'd", "word", "Word", "日本語", "Ωμέγα", "١٢٣", "42",
        "!!", "...", "<|endoftext|>", "\U0001f600", "é", "é", "՘", "꟎", "\U00010d4a",
        "a" * 70, "-" * 45, " " * 60, "7" * 50,
    ]
    for _ in range(n):
        yield "".join(rng.choice(parts) for _ in range(rng.randrange(1, 120)))


@pytest.mark.parametrize(("chunk", "overlap"), [(40, 16), (64, 8), (100, 100), (1 << 16, 1 << 10)])
def test_any_chunks_give_the_ids_of_the_whole_text(spark, library, chunk, overlap):
    texts = [*awkward_texts(4, 20), *odd_texts(5, 150), "x" * 900, " " * 500 + "end", "a b " * 300]
    texts += [texts[-1], texts[-2]]
    docs = documents(spark, texts)
    got = byte_bpe.decode(byte_bpe.encode(docs, chunk=chunk, overlap=overlap)).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    for row in got:
        text = texts[row.doc_id] or ""
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)
        assert bytes(row.decoded) == text.encode()


def test_chunks_of_a_long_text_are_cut_at_seams(spark):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(3000))
    long = spark.createDataFrame([(b"d", text)], "digest binary, text string")
    pieces = sorted(byte_bpe.pieces_of_long_texts(long, 500, 50).collect(), key=lambda r: r.piece)
    assert len(pieces) == -(-len(text) // 500)
    assert "".join(p.text for p in pieces) == text
    assert all(len(p.text) <= 550 for p in pieces)


def test_query_matches_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_byte_bpe"](spark, SF).collect()}
    want = {}
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        raw = np.asarray(ids, "<u4").tobytes()
        digests = [hashlib.sha256(x).hexdigest() for x in (raw, (text or "").encode())]
        want[doc_id] = (len(ids), *digests)
    assert got == want


def test_nulls_repeats_and_clashing_columns(spark, tmp_path, library):
    long = "long text " * 20_000
    rows = [(None, None), (None, long), (7, long), (7, long), (7, ""), (-2, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.withColumns({c: F.lit("x") for c in ("ids", "digest", "n", "piece", "decoded")}).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    got = QUERIES["op13_byte_bpe"](spark, str(tmp_path)).select("doc_id", "n_tokens").collect()
    want = [(i, len(library.encode_ordinary(t or ""))) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["op13_byte_bpe"](spark, str(tmp_path)).collect() == []

"""Packing, token files and token counts against the tokenizer libraries."""

import json
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millwright.llm import packing, token_binary, token_counts, token_words
from millwright.llm.common import free_kept
from millwright.llm.rawfiles import new_folder
from millwright.llm.token_words import DROPPED_SPACE, LEADING_SPACE, WordEncoder, tokenizer_path
from millwright.sources.staging import stage
from tests.llm.helpers import awkward_texts, documents, rows_of


def fuzz(n=1500, seed=3):
    rng = random.Random(seed)
    bits = list("ab the ing er \n\n  \t\r.,!'<>éüñ日\U0001f600▁x1 2\xa0\x1ćs'tİΣ")
    bits += ["<|endoftext|>", " <|endoftext|>", "<s>", "<0x0A>", " the", "Word.", "\nNext"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    return ["", " ", "  ", " a", "a ", "\n", "a\n b", *made]


@pytest.mark.parametrize(
    ("name", "kind"), [("byte_bpe_50k.json", LEADING_SPACE), ("word_bpe_49k.json", DROPPED_SPACE)]
)
def test_word_encoder_equals_the_tokenizer(name, kind):
    path = tokenizer_path(name)
    words, whole = WordEncoder(path, kind), Tokenizer.from_file(path)
    texts = fuzz()
    for text, got in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_counts_of_every_prefix():
    path = tokenizer_path("piece_bpe_32k.model")
    counter = token_counts.PrefixCounter(path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for text in fuzz(400):
        counts = token_counts.prefix_counts(counter.ledgers([text])[0])
        assert counts.tolist() == [len(model.encode(text[:i])) for i in range(len(text) + 1)], text


def test_token_counts_query(spark):
    texts = [*awkward_texts(), *fuzz(100)]
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    got = token_counts.prefix_ledger(documents(spark, texts), token_limit=50)
    for row in got.collect():
        text = texts[row.doc_id] or ""
        total = len(model.encode(text))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), total, total > 50)
        counts = token_counts.prefix_counts(row.steps)
        assert counts[row.kept_chars] <= 50
        assert row.kept_chars == len(text) or all(counts[row.kept_chars + 1 :] > 50)
    assert got.count() == len(texts)
    assert token_counts.prefix_ledger(documents(spark, texts).limit(0)).count() == 0


def test_packing(spark):
    texts = awkward_texts()
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    pieces = packing.pack(documents(spark, texts), with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        own = np.frombuffer(p.ids, "<u4").tolist()
        assert own == ids[p.doc_id][p.start : p.start + p.length]
        assert (p.ids_crc32, p.doc_tokens) == (zlib.crc32(p.ids), len(ids[p.doc_id]))
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for doc, parts in by_doc.items():
        assert sum(n for _, n in parts) == len(ids[doc])
    assert by_doc.keys() == ids.keys()
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(documents(spark, texts).limit(0)).count() == 0


def test_padding_does_not_depend_on_partitions(spark):
    rng = random.Random(11)
    texts = ["word " * int(rng.paretovariate(0.8) * 20 % 4000) for _ in range(3000)]
    table = documents(spark, texts)
    found = []
    for parts in (1, 60):
        pieces = stage(packing.pack(table.repartition(parts)))
        found.append(rows_of(pieces, "doc_id", "start", "length", "ids_crc32", "doc_tokens"))
        lengths = packing.sequence_lengths(pieces).collect()
        assert sum(r.padding for r in lengths) < 0.01 * sum(r.used for r in lengths)
        ends = pieces.selectExpr("sequence_id", "offset", "offset + length AS end").collect()
        by_sequence = {}
        for r in sorted(ends, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == by_sequence.get(r.sequence_id, 0)
            by_sequence[r.sequence_id] = r.end
        assert max(by_sequence.values()) <= 1024
    assert found[0] == found[1]


def test_best_fit_decreasing_against_a_plain_search():
    rng = random.Random(2)
    for _ in range(30):
        lengths = [rng.randint(1, 32) for _ in range(rng.randint(0, 60))]
        rooms, want = [], {}
        for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
            fits = [w for w, room in enumerate(rooms) if room >= lengths[i]]
            if not fits:
                rooms.append(32)
                fits = [len(rooms) - 1]
            w = min(fits, key=lambda w: rooms[w])
            want[i] = rooms[w]
            rooms[w] -= lengths[i]
        got = packing.best_fit_decreasing(lengths, 32)
        # Windows of equal room are interchangeable: the room found is the same.
        assert {i: 32 - offset for i, (_, offset) in enumerate(got)} == want


@pytest.mark.parametrize(("limit", "n"), [(16, 3000), (4, 16), (5, 20), (16, 1), (16, 2), (16, 49408)])
def test_huffman_round_trip(limit, n):
    rng = np.random.default_rng(1)
    counts = {int(i) * 3: int(c) for i, c in enumerate(rng.zipf(1.3, n).clip(1, 10**9))}
    lengths = token_binary.code_lengths(counts, limit)
    assert max(lengths.values()) <= limit
    assert sum(2.0**-b for b in lengths.values()) <= 1
    code = token_binary.Code(lengths, limit)
    for size in (0, 1, 255, 256, 257, 5000):
        ids = rng.choice(np.array(list(counts)), size)
        assert (code.decode(*code.encode(ids), size) == ids).all()


def test_huffman_is_optimal_without_a_tight_limit():
    import heapq

    counts = {i: (i * 37) % 101 + 1 for i in range(90)}
    heap, total = list(counts.values()), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        joined = heapq.heappop(heap) + heapq.heappop(heap)
        total += joined
        heapq.heappush(heap, joined)
    lengths = token_binary.code_lengths(counts)
    assert sum(counts[i] * lengths[i] for i in counts) == total


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_binary, "FILE_IDS", 2000)
    texts = awkward_texts()
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want, start = [], 0
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    folder = new_folder(spark, "test-ids")
    tokens = stage(token_binary.tokenized(documents(spark, texts)))
    lengths = token_binary.write_ids(tokens, folder)
    got = token_binary.read_ids(spark, folder, lengths)
    assert rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


def test_token_files_of_nothing(spark):
    folder = new_folder(spark, "test-ids")
    tokens = stage(token_binary.tokenized(documents(spark, ["a"]).limit(0)))
    lengths = token_binary.write_ids(tokens, folder)
    assert token_binary.read_ids(spark, folder, lengths).count() == 0


def test_files_are_read_in_order_of_their_numbers(spark, tmp_path):
    """From 100,000 files on the order of the names is not that of the files."""
    lengths = token_binary.code_lengths({5: 3, 6: 2, 7: 1})
    code = token_binary.Code(lengths)
    for number, doc, ids in ((99_999, 1, [5, 6]), (100_000, 2, [7, 5, 5]), (9, None, [6]), (10, -(1 << 63), [5])):
        raw = np.array(ids, "<u4").tobytes()
        block = token_binary.pack_block([(doc, raw)], code)
        (tmp_path / f"part-{number:05d}-abc-c000.txt").write_bytes(block)
    got = token_binary.read_ids(spark, str(tmp_path), lengths).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [
        (None, 0, 1), (-(1 << 63), 1, 1), (1, 2, 2), (2, 4, 3),
    ]


def test_words_by_rank_are_only_used_where_they_agree():
    encoder = WordEncoder(tokenizer_path("word_bpe_49k.json"), DROPPED_SPACE)
    assert encoder.plain_merges
    texts = fuzz(300)
    want = encoder.encode(texts)
    # The same ids from the library alone, as for a file whose merges do not agree.
    other = WordEncoder(tokenizer_path("word_bpe_49k.json"), DROPPED_SPACE)
    other.plain_merges = False
    assert other.encode(texts) == want
    other.merges.encode = lambda piece: b""
    other.plain_merges = True
    assert not other._merges_agree(json.loads(other.tokenizer.to_str())["model"])


def test_latin_words_of_any_case_and_punctuation():
    encoder = WordEncoder(tokenizer_path("word_bpe_49k.json"), DROPPED_SPACE)
    whole = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(11)
    letters = "aebnostéèÄÖüßñÇØæÐþ×÷ªµİıſǅ"
    texts = []
    for _ in range(200):
        words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(20)]
        texts.append(" ".join(w + rng.choice(["", "", ",", ".", "?!", "...", ".)", "'s"]) for w in words))
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_automaton_that_forgets_counts_the_same(monkeypatch):
    path = tokenizer_path("piece_bpe_32k.model")
    texts = [t for t in fuzz(300, 9) if t]
    want = [token_counts.PrefixCounter(path).ledgers([t])[0] for t in texts[:40]]
    monkeypatch.setattr(token_counts, "MAX_STATES", 5)
    monkeypatch.setattr(token_counts, "MAX_KEPT", 3)
    counter = token_counts.PrefixCounter(path)
    assert counter.ledgers(texts)[:40] == want


def test_workers_give_back_encoders_when_another_operator_begins():
    """A reused worker held the tables of packing while later stages ran in it."""
    path = tokenizer_path("byte_bpe_50k.json")
    ids = token_words.encoder(path, LEADING_SPACE).encode(["some words, some more"])
    free_kept()
    assert not token_words._ENCODERS
    assert token_words.encoder(path, LEADING_SPACE).encode(["some words, some more"]) == ids


def test_words_are_looked_up_once_unless_missing():
    """Of a text with one new word, only that word was to be looked up a second time."""

    class Counting(dict):
        asked = 0

        def get(self, key, default=None):
            Counting.asked += 1
            return super().get(key, default)

    words = token_words.WordEncoder(tokenizer_path("word_bpe_49k.json"), DROPPED_SPACE)
    known = " ".join(f"word{chr(97 + i % 26)}" for i in range(1000))
    words.encode([known])
    words.first.now = Counting(words.first.now)
    assert words.encode([known + " unseen"]) == [words._ids(known + " unseen").tobytes()]
    assert Counting.asked <= 1001 + 2

"""Exact token counts of every prefix of a text, by dynamic programming.

For merges by priority, the last token of a prefix decides the rest: if ``t`` is the last
token of the prefix that ends at ``i``, the tokens before it are those of the prefix that ends
at ``i - len(t)``, and ``t`` is the one token that ends there and stays apart from the last
token of that shorter prefix. So one pass from left to right, trying for each position the
vocabulary's pieces that end there, gives the count at every prefix:
``count[i] = count[i - len(t)] + 1``. Two tokens stay apart if merging their joined characters
gives these two tokens again; answers are kept by pair.

A text is cut where no piece of the vocabulary crosses (before a space mark that follows
another character, before a comma or full stop that follows a letter, and around line breaks), so the pass runs
once per distinct word and worker, and its counts, as steps from prefix to prefix, are joined for
each text. Within a word the pass is an automaton that is filled as words are met: all that later
positions can ask of a prefix is its longest end that begins some longer piece, with the last token
and the count at each position in it. Prefixes that agree in this are one state, so a character of a
new word is mostly one look into a table, not a search through the pieces. The steps, one byte a character, are the ledger: their running sum is the count at
every prefix, and truncation and budget questions need no encoding.
"""

from __future__ import annotations

import re
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millwright.llm.common import kept_table, map_batches, texts_of
from millwright.llm.token_words import in_slices, tokenizer_path

TOKEN_LIMIT = 4096
MAX_KEPT = 1_200_000
MAX_PAIRS = 2_000_000
# States of the automaton, some 500 bytes each.
MAX_STATES = 300_000
# Characters of texts that are looked at together.
SLICE_CHARS = 8_000_000
SPACE_MARK = "▁"
_STOPS = ",."

_COUNTERS: dict[str, PrefixCounter] = kept_table()


class PrefixCounter:
    """Counts by a sentencepiece model of merge type with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ordinary = [
            i
            for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in ordinary}
        longer = [p for p in self.score if len(p) > 1]
        if any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in longer):
            raise ValueError("a piece of this vocabulary crosses the start of a word")
        if any("\n" in p for p in self.score):
            raise ValueError("a piece of this vocabulary holds a line break")
        if any(a.isalpha() and b in _STOPS for p in longer for a, b in zip(p, p[1:])):
            raise ValueError("a piece of this vocabulary crosses the end of a word")
        self.stops: dict[str, bytes] = {}
        self.tails: set[str] = {p[k:] for p in longer for k in range(len(p))}
        self.heads: set[str] = {p[:k] for p in longer for k in range(1, len(p))}
        self.apart: dict[tuple[str, str], bool] = {}
        self._forget()
        self.line_break = self._steps("\n")
        # Steps of words after a space (kept without its mark) or, with it, after a line break.
        self.word: dict[str, bytes] = {}

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether merging the characters of both by priority gives these two tokens."""
        symbols = list(left + right)
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                score = self.score.get(symbols[k] + symbols[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols == [left, right]

    def _state(self, end: str, last: tuple[str, ...], count: tuple[int, ...]) -> dict:
        """The moves from a prefix with this end; tokens and counts at each place in it."""
        key = (end, last, count)
        moves = self.states.get(key)
        if moves is None:
            moves = self.states[key] = {"": key}
        return moves

    def _move(self, moves: dict, character: str) -> tuple[dict, int]:
        """The moves after one more character, and by how much the count changes."""
        end, last, count = moves[""]
        text = end + character
        n = len(text)
        for k in range(n - 1, -1, -1):
            piece = text[k:]
            if k < n - 1:
                if piece not in self.tails:
                    k = -1  # no piece ends with these characters, so none with more
                    break
                if piece not in self.score:
                    continue
            before = last[k]
            if before:
                free = self.apart.get((before, piece))
                if free is None:
                    if len(self.apart) >= MAX_PAIRS:
                        self.apart.clear()
                    free = self.apart[before, piece] = self._stay_apart(before, piece)
                if not free:
                    continue
            break
        else:
            k = -1
        if k < 0:
            raise AssertionError(f"no token ends at the end of {text!r}")
        # A character without a piece is spelled in bytes.
        units = 1 if piece in self.score else len(piece.encode("utf-8", "surrogatepass"))
        step = count[k] + units
        cut = next(m for m in range(n + 1) if m == n or text[m:] in self.heads)
        counts = (*count[cut:], step) if cut <= len(end) else (step,)
        moved = self._state(
            text[cut:], (*last, piece)[cut:], tuple(c - step for c in counts)
        ), step & 255
        moves[character] = moved
        return moved

    def _steps(self, text: str) -> bytes:
        """The change of the count at each character of a segment."""
        if len(self.states) > MAX_STATES:
            self._forget()
        moves, steps = self.start, []
        for character in text:
            move = moves.get(character)
            if move is None:
                move = self._move(moves, character)
            moves, step = move
            steps.append(step)
        return bytes(steps)

    def _forget(self) -> None:
        """The automaton with nothing but its start: the empty prefix."""
        # By what tells states apart: the moves from there, and itself under no character.
        self.states: dict[tuple, dict] = {}
        self.start = self._state("", ("",), (0,))

    def _ledger_of_any(self, text: str) -> bytes:
        """Texts with runs of spaces: cut before each run instead of before each space."""
        marked = SPACE_MARK + text.replace(" ", SPACE_MARK)
        segments = re.findall(f"\n|{SPACE_MARK}*[^{SPACE_MARK}\n]+|{SPACE_MARK}+", marked)
        return b"".join(map(self._steps, segments))

    def _regular(self, text: str) -> tuple[list[bytes | None], list[str]]:
        """Steps of the parts of a text without runs of spaces, None where not yet known.

        A line break is a part of its own, written before the first word of its line.
        """
        parts = text.replace("\n", " \n").split(" ")
        return list(map(self.word.get, parts)), parts

    def ledgers(self, texts: list[str]) -> list[bytes]:
        """Steps at each character of ``mark + text`` as signed bytes; empty texts have none."""
        out = [b""] * len(texts)
        later, new = [], {}
        for i, text in enumerate(texts):
            if not text:
                continue
            if text[0] == " " or "  " in text or " \n" in text or SPACE_MARK in text:
                out[i] = self._ledger_of_any(text)
                continue
            values, parts = self._regular(text)
            if None in values:
                later.append((i, values, parts))
                new |= {p: None for p, v in zip(parts, values, strict=True) if v is None}
            else:
                out[i] = b"".join(values)
        if len(self.word) + len(new) > MAX_KEPT:
            self.word.clear()
        known, stops, steps = self.word, self.stops, self._steps
        for part in new:
            if part in known:
                continue
            if part[:1] == "\n":
                known[part] = self.line_break + steps(part[1:])
                continue
            # A comma or full stop after a letter is apart from the word: few such ends differ.
            word = part.rstrip(_STOPS) if part[-1:] in _STOPS else part
            if word == part or not word or not word[-1].isalpha():
                known[part] = steps(SPACE_MARK + part)
                continue
            tail = part[len(word) :]
            if tail not in stops:
                stops[tail] = steps(tail)
            own = known.get(word)
            known[part] = (steps(SPACE_MARK + word) if own is None else own) + stops[tail]
        for i, values, parts in later:
            out[i] = b"".join(
                [known[p] if v is None else v for v, p in zip(values, parts, strict=True)]
            )
        return out


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_counts(ledger: bytes) -> np.ndarray:
    """Tokens of the text's prefix of 0, 1, 2, ... characters.

    The first step belongs to the mark put before the text, so it falls to the first character.
    """
    sums = np.cumsum(np.frombuffer(ledger, np.int8), dtype=np.int64)
    return np.concatenate([[0], sums[1:]]) if len(sums) else np.zeros(1, np.int64)


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def prefix_ledger(
    documents: DataFrame,
    *,
    model: str | None = None,
    token_limit: int = TOKEN_LIMIT,
    with_steps: bool = True,
) -> DataFrame:
    """Token counts of all prefixes: ``(doc_id, n_bytes, n_tokens, over_limit, kept_chars, steps)``.

    ``kept_chars`` is the length of the longest prefix within the limit. ``steps`` holds the
    change of the count at each character (see :func:`prefix_counts`) and is left out on
    request. Null counts as the empty text: 0 tokens. An empty table gives no rows.
    """

    def counted(batches):
        tokens = counter(model or tokenizer_path("piece_bpe_32k.model"))
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for low, high in in_slices(texts, SLICE_CHARS):
                own = texts[low:high]
                ledgers = tokens.ledgers(own)
                totals, kept = [], []
                for text, ledger in zip(own, ledgers, strict=True):
                    total = int(np.frombuffer(ledger, np.int8).sum(dtype=np.int64))
                    totals.append(total)
                    over = total > token_limit
                    counts = prefix_counts(ledger) if over else None
                    kept.append(longest_prefix(counts, token_limit) if over else len(text))
                arrays = [
                    batch.column("doc_id").slice(low, high - low),
                    pa.array([len(t.encode("utf-8", "surrogatepass")) for t in own], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([t > token_limit for t in totals], pa.bool_()),
                    pa.array(kept, pa.int64()),
                ]
                names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "kept_chars"]
                if with_steps:
                    arrays.append(pa.array(ledgers, pa.binary()))
                    names.append("steps")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = (
        "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, kept_chars bigint"
    )
    schema += ", steps binary" if with_steps else ""
    return map_batches(documents, ["doc_id", "text"], counted, schema)

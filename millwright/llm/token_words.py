"""Token ids of whole texts, encoding each distinct word once per worker.

A text is cut where the tokenizer itself always cuts, so the ids of a text are those of its
parts in order. The ids of a part are found once and kept in a bounded table as bytes (unsigned
32-bit, little-endian); the ids of a text are then one join of bytes.

Plain words (letters, then maybe some punctuation) are merged by their bytes with the merges of
the tokenizer file, which a rank encoder runs several times as fast. All other parts are asked
from the tokenizers library itself. Merging by rank of the joined bytes is the same as merging by
pair only if the file's merges agree with it, so both are compared when a file is loaded (every
word of the vocabulary and a seeded sample of joins); should they differ, the library does it all.
"""

from __future__ import annotations

import json
import os
import random
import re
import unicodedata
from collections.abc import Callable

import numpy as np

from millwright.llm.common import kept_table

# Parts in each of two generations; a part takes some 200 bytes.
MAX_KEPT = 350_000
_ENCODERS: dict[tuple[str, str], WordEncoder] = kept_table()

# The two kinds of tokenizer files that this module can cut texts for.
# Latin letters, each one character whatever its case, and the punctuation that may follow a word
# (none that special strings are made of).
_LATIN_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_PUNCTUATION = "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"

LEADING_SPACE = "leading-space"  # byte-level: a word keeps the single space before it
DROPPED_SPACE = "dropped-space"  # white space never reaches the ids


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _parts_with_space(text: str) -> list[str]:
    # A line break between two words is a token of its own, and the word after it has no space.
    return text.replace("\n", " \n").split(" ")


def _parts_without_space(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


class Kept:
    """Ids of parts in two generations: when the newer is full it becomes the older one.

    Parts met again move to the newer one, so frequent parts stay.
    """

    def __init__(self):
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def make_room(self, new: list[str]) -> list[str]:
        """Room for new parts; returns those that are really unknown."""
        if len(self.now) + len(new) > MAX_KEPT:
            self.now, self.before = {}, self.now
        again = {p: self.before[p] for p in new if p in self.before}
        self.now.update(again)
        return [p for p in new if p not in again]

    def get(self, part: str) -> bytes | None:
        if part in self.now:
            return self.now[part]
        return self.before.get(part)


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    printable = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    others = [b for b in range(256) if b not in printable]
    stands_for = {chr(b): b for b in printable}
    return stands_for | {chr(256 + i): b for i, b in enumerate(others)}


class PlainMerges:
    """Merges of a byte-level tokenizer file, applied to the bytes of a single pre-token."""

    # Stands for the end-of-word mark; no plain word holds it.
    END = b"\0"

    def __init__(self, model: dict):
        import tiktoken

        alphabet = _byte_alphabet()
        character = {b: c for c, b in alphabet.items()}
        mark = model.get("end_of_word_suffix") or ""
        self.end = self.END if mark else b""

        def as_bytes(token: str) -> bytes:
            if mark and token.endswith(mark):
                return bytes(map(alphabet.__getitem__, token[: -len(mark)])) + self.END
            return bytes(map(alphabet.__getitem__, token))

        names = [(bytes([b]), character[b]) for b in range(256)]
        if mark:
            names += [(bytes([b]) + self.END, character[b] + mark) for b in range(1, 256)]
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            names.append((as_bytes(left + right), left + right))
        ranks: dict[bytes, int] = {}
        self.ids: list[bytes] = []
        for raw, name in names:
            if raw not in ranks:
                ranks[raw] = len(self.ids)
                self.ids.append(model["vocab"].get(name, 0).to_bytes(4, "little"))
        # A piece is a word with its end; the pattern takes any text without one as a whole.
        encoding = tiktoken.Encoding(
            "plain", pat_str=r"[^\x00]+\x00?|\x00", mergeable_ranks=ranks, special_tokens={}
        )
        self._merged = encoding.encode_ordinary
        self._id_of_rank = np.frombuffer(b"".join(self.ids), "<u4")
        self._ends = np.zeros(len(self.ids), bool)
        for raw, rank in ranks.items():
            self._ends[rank] = bool(mark) and raw.endswith(self.END)

    def encode(self, piece: str) -> bytes:
        return b"".join([self.ids[r] for r in self._merged(piece + self.end.decode())])

    def encode_words(self, words: list[str]) -> list[bytes]:
        """:meth:`encode` of many words without white space, of a file with ends of words."""
        ranks = np.asarray(self._merged("\0".join([*words, ""])), np.int64)
        raw = self._id_of_rank[ranks].astype("<u4").tobytes()
        ends = (4 * (np.flatnonzero(self._ends[ranks]) + 1)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class WordEncoder:
    """Encodes texts by parts; see the module's docstring."""

    def __init__(self, path: str, kind: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split: Callable[[str], list[str]] = (
            _parts_with_space if kind == LEADING_SPACE else _parts_without_space
        )
        self.spaced = kind == LEADING_SPACE
        model = json.loads(self.tokenizer.to_str())["model"]
        self.merges = PlainMerges(model)
        # What stands between parts when many are encoded at once, and the id it always gets.
        self.between = "\n" if self.spaced else " \x01 "
        self.mark = self._ids(self.between)[0]
        self.line_break = self._ids("\n").tobytes()
        # Empty bytes stand for parts with white space at an edge: such texts are encoded whole.
        self.first = Kept()
        self.rest = Kept() if self.spaced else self.first
        self.plain_merges = True
        self.plain_merges = self._merges_agree(model)

    def _ids(self, text: str) -> np.ndarray:
        encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(encoded[0].ids, "<u4")

    def _merges_agree(self, model: dict) -> bool:
        """Whether plain words have the same ids by rank as by the library."""
        mark = model.get("end_of_word_suffix") or ""
        words = [w.removesuffix(mark).lstrip("\u0120") for w in model["vocab"]]
        words = [w for w in words if w.isascii() and w.isalpha()]
        rng = random.Random(7)
        words += ["".join(rng.choices(words, k=rng.randrange(2, 4))) for _ in range(2000)]
        if not words:
            return False
        plain = [self._plain(w, " ") for w in words]
        asked = self._ids_of_many([" " + w if self.spaced else w for w in words])
        ends = ["".join(rng.choices("!\"#$%&'()*+,-./:;=?@[]^_`{}~", k=k % 6 + 1)) for k in range(600)]
        plain += map(self.merges.encode, ends)
        asked += self._ids_of_many(ends)
        return all(p is None or p == a for p, a in zip(plain, asked, strict=True))

    def _ids_of_many(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, encoded as one text in which the mark stands between them.

        Chunks with characters that could take part in a special token or in the mark are
        encoded one by one.
        """
        out = [b""] * len(chunks)
        plain = []
        for i, chunk in enumerate(chunks):
            if "<|" in chunk or "\x01" in chunk or "\n" in chunk:
                out[i] = self._ids(chunk).tobytes()
            else:
                plain.append(i)
        for low in range(0, len(plain), 5000):
            own = plain[low : low + 5000]
            ids = self._ids(self.between.join([chunks[i] for i in own]))
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
            if len(ends) != len(own):
                raise AssertionError("a part's ids hold the mark between parts")
            raw, start = ids.tobytes(), 0
            for i, end in zip(own, ends.tolist(), strict=True):
                out[i] = raw[4 * start : 4 * end]
                start = end + 1
        return out

    def _plain(self, part: str, prefix: str) -> bytes | None:
        """Ids of letters and punctuation after them; None for any other part."""
        core = part.rstrip(".,;:!?")
        if not self.plain_merges or not core.isalpha():
            return None
        if not self.spaced:
            # Lower case by characters, so not where the place in the word matters.
            core = core.lower() if "\u03a3" not in core else ""
            if not core.isalpha() or not unicodedata.is_normalized("NFC", core):
                return None
        tail = part[len(part.rstrip(".,;:!?")) :]
        ids = self.merges.encode((prefix if self.spaced else "") + core)
        return ids + self.merges.encode(tail) if tail else ids

    def _learn(self, kept: Kept, new: list[str], prefix: str) -> None:
        chunks, unknown = {}, kept.make_room(new)
        known = kept.now
        if not self.spaced and self.plain_merges:
            unknown = self._learn_latin(known, unknown)
        for part in unknown:
            own_line = self.spaced and prefix and part.startswith("\n")
            core = part[1:] if own_line else part
            plain = self._plain(core, "" if own_line else prefix)
            if plain is not None:
                known[part] = self.line_break + plain if own_line else plain
            elif not self.spaced:
                chunks[part] = part
            elif not core or core[0].isspace() or core[-1].isspace():
                known[part] = b""
            elif not own_line:
                chunks[part] = prefix + part
            else:
                known[part] = self.line_break + self._ids(core).tobytes()
        if not self.spaced:
            known[""] = b""
            chunks.pop("", None)
        known.update(zip(chunks, self._ids_of_many(list(chunks.values())), strict=True))

    def _learn_latin(self, known: dict[str, bytes], parts: list[str]) -> list[str]:
        """Learn the words of Latin letters, all at once; returns the other parts."""
        # Most parts have no punctuation.
        bare = [p for p in parts if p.isalpha() and (p.isascii() or _LATIN_LETTERS.fullmatch(p))]
        if bare:
            # Letter by letter: none of these has a lower case of two characters.
            known.update(zip(bare, self.merges.encode_words("\0".join(bare).lower().split("\0")), strict=True))
            parts = [p for p in parts if p not in known]
        found, cores, others = [], [], []
        for part in parts:
            core = part.rstrip(_PUNCTUATION)
            if core.isalpha() and (core.isascii() or _LATIN_LETTERS.fullmatch(core)):
                found.append(part)
                cores.append(core)
            else:
                others.append(part)
        if not found:
            return parts
        learned = self.merges.encode_words("\0".join(cores).lower().split("\0"))
        tails: dict[str, bytes] = {}
        for part, core, ids in zip(found, cores, learned, strict=True):
            if len(core) < len(part):
                tail = part[len(core) :]
                if tail not in tails:
                    tails[tail] = self.merges.encode(tail)
                ids += tails[tail]
            known[part] = ids
        return others

    def _look_up(self, parts: list[str]) -> list[bytes | None]:
        if not self.spaced:
            return list(map(self.first.now.get, parts))
        values = list(map(self.rest.now.get, parts))
        values[0] = self.first.now.get(parts[0])
        return values

    def _joined(self, text: str, values: list[bytes]) -> bytes:
        if self.spaced and b"" in values:
            return self._ids(text).tobytes()
        return b"".join(values)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, four bytes an id."""
        out: list[bytes] = [b""] * len(texts)
        later, first, rest = [], {}, {}
        for i, text in enumerate(texts):
            if not text:
                continue
            parts = self.split(text)
            values = self._look_up(parts)
            missing = [k for k, v in enumerate(values) if v is None]
            if missing:
                later.append((i, parts, values, missing))
                new = [parts[k] for k in missing]
                if values[0] is None and self.spaced:
                    first[parts[0]] = None
                    if parts[0] not in parts[1:]:
                        del new[0]
                rest.update(dict.fromkeys(new))
            else:
                out[i] = self._joined(text, values)
        if later:
            self._learn(self.first, list(first), "")
            self._learn(self.rest, list(rest), " ")
        # Only what was missing is looked up again; it may be in the older generation meanwhile.
        newest, older = self.rest.now.get, self.rest.before.get
        for i, parts, values, missing in later:
            lost = False
            for k in missing:
                value = newest(parts[k]) if k or not self.spaced else self.first.get(parts[k])
                if value is None and (k or not self.spaced):
                    value = older(parts[k])
                values[k] = value
                lost = lost or value is None
            if lost:  # given up to make room
                out[i] = self._ids(texts[i]).tobytes()
            else:
                out[i] = self._joined(texts[i], values)
        return out


def encoder(path: str, kind: str) -> WordEncoder:
    """The worker's encoder for a file; workers are reused, and so is what they have kept."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = WordEncoder(path, kind)
    return _ENCODERS[path, kind]


def in_slices(texts: list[str], max_chars: int = 4_000_000) -> list[tuple[int, int]]:
    """Ranges of texts with about so many characters, so that working memory stays bounded."""
    cuts, start, held = [], 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > max_chars:
            cuts.append((start, i))
            start, held = i, 0
        held += len(text)
    cuts.append((start, len(texts)))
    return cuts

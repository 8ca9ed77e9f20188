"""Language identification with string kernels.

A text is the set of its character n-grams of one to three letters (all orders blended, each
counted once however often it occurs), hashed to 65,536 buckets. The kernel of two texts is the
number of buckets both have, over the geometric mean of their sizes. A bounded sample of the
labelled rows supplies landmarks (Nyström) and training rows; for each language a ridge
regression in the landmarks' space separates it from the rest. Scoring is two matrix products
per batch of texts: presence times landmarks, then times the weights.

Whole texts are read; only the training sample is bounded (``PER_LANGUAGE`` rows of each
language, taken by a hash of the id). All languages present are learned.

The scores tell languages apart, but not whether a text is in any of them: some language always
has the most. That is decided by the share of the text's three-letter n-grams, every occurrence
counted, that no training row of its language has. What is usual is fitted on the training rows,
each against the others of its language; ``supported`` leaves texts out that are clearly beyond,
as a whole and in most of their pieces (a text may change between learned languages).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import free_kept, map_batches, sliced, texts_of
from millwright.sources.staging import stage

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
PER_LANGUAGE = 200
LANDMARKS_PER_LANGUAGE = 32
MAX_LANDMARKS = 256  # over all languages, but for one a language
LONGEST_SAMPLE = 5_000  # longer texts are sampled only where there are no others
RIDGE = 1e-2
UNKNOWN = "und"
KNOWN_BITS = 18  # n-grams of three letters are kept as bits under so many bits of their hash
USUAL = 0.99  # quantile of the training rows' shares of unknown n-grams
DEVIATIONS = 4.0  # how far beyond a text may be, by chance in as many n-grams as it has
PIECE = 300  # characters of the pieces that texts in several languages are judged by
_DOCS = 128
_MARKS = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LETTERS: list[np.ndarray] = []


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that training never sees."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def letters_of(text: str) -> np.ndarray:
    """Code points in lower case; what stands between letters is one zero, also at both ends."""
    raw = text.lower().encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, "<u4")
    codes = np.where(_is_letter()[codes], codes, 0).astype(np.uint64)
    codes = np.concatenate([[np.uint64(0)], codes, [np.uint64(0)]])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of buckets per text, set where the text has an n-gram; and whether it has letters."""
    found = np.zeros((len(texts), BUCKETS), bool)
    any_letter = np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        codes = letters_of(text)
        any_letter[i] = len(codes) > 1
        if not any_letter[i]:
            continue
        row = found[i]
        for low in range(0, len(codes), 1 << 20):  # long texts in parts that overlap
            part = codes[low : low + (1 << 20) + max(ORDERS) - 1]
            gram = np.zeros(len(part), np.uint64)
            for n in range(1, max(ORDERS) + 1):
                gram = gram[: len(part) - n + 1] * _STEP + part[n - 1 :] + np.uint64(n)
                if n in ORDERS:
                    # A gap alone is no n-gram: every text has it.
                    own = gram[part != 0] if n == 1 else gram
                    row[(own * _STEP) >> np.uint64(48)] = True
    return found, any_letter


def trigrams(text: str) -> np.ndarray:
    """Hashes of all occurrences of three letters or gaps in a row."""
    codes = letters_of(text)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    gram = (codes[:-2] * _STEP + codes[1:-1] + np.uint64(1)) * _STEP + codes[2:]
    return ((gram * _STEP) >> np.uint64(64 - KNOWN_BITS)).astype(np.int64)


def most_unknown(usual: float, n: int) -> float:
    """The largest share among ``n`` n-grams that chance explains if ``usual`` is the true one."""
    z2 = DEVIATIONS**2
    spread = DEVIATIONS * np.sqrt(usual * (1 - usual) / n + z2 / (4 * n * n))
    return (usual + z2 / (2 * n) + spread) / (1 + z2 / n)


@dataclass(frozen=True)
class Model:
    """Landmarks, weights and known n-grams; small enough to be sent to every executor."""

    languages: list[str]
    columns: np.ndarray  # the buckets that some landmark has
    marks: np.ndarray  # landmarks x columns, as bits
    weights: np.ndarray  # landmarks x languages
    known: np.ndarray  # languages x three-letter n-grams, as bits
    usual: np.ndarray  # by language: the share of unknown n-grams that is usual

    def kernel(self, found: np.ndarray) -> np.ndarray:
        sizes = np.sqrt(np.maximum(found.sum(1, dtype=np.float32), 1))
        own = found[:, self.columns].astype(np.float32)
        out = np.empty((len(found), len(self.marks)), np.float32)
        for low in range(0, len(self.marks), _MARKS):
            some = np.unpackbits(self.marks[low : low + _MARKS], axis=1, count=len(self.columns))
            roots = np.sqrt(np.maximum(some.sum(1, dtype=np.float32), 1))
            out[:, low : low + _MARKS] = own @ some.T.astype(np.float32) / roots
        return out / sizes[:, None]

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found, any_letter = presence(texts)
        return np.clip(self.kernel(found) @ self.weights, 0, 1), any_letter

    def supports(self, text: str, language: int) -> bool:
        """Whether the text's share of unknown n-grams is as in texts of the language."""
        grams = trigrams(text)
        if not len(grams):
            return False
        bits = self.known[language, grams >> 3] >> (7 - (grams & 7)).astype(np.uint8) & 1
        n = np.count_nonzero(np.bincount(grams, minlength=1 << KNOWN_BITS))
        return 1 - bits.mean() <= most_unknown(self.usual[language], n)


    def supported(self, texts: list[str]) -> np.ndarray:
        """Which texts are in a learned language, or in several ones piece by piece."""
        keep = self._supported(texts)
        for k in np.flatnonzero(~keep):
            text = texts[k]
            pieces = [text[low : low + PIECE] for low in range(0, len(text), PIECE)]
            if len(pieces) > 1:
                keep[k] = 2 * np.count_nonzero(self._supported(pieces)) > len(pieces)
        return keep

    def _supported(self, texts: list[str]) -> np.ndarray:
        keep = np.zeros(len(texts), bool)
        for low in range(0, len(texts) if self.languages else 0, _DOCS):
            scores, any_letter = self.scores(texts[low : low + _DOCS])
            at = scores.argmax(1)
            for k in np.flatnonzero(any_letter):
                keep[low + k] = self.supports(texts[low + k], at[k])
        return keep


def _known(texts: list[str]) -> tuple[np.ndarray, float]:
    """Bits of the n-grams in the texts, and the usual share of a text that no other one has."""
    grams = [trigrams(t) for t in texts]
    holders = np.zeros(1 << KNOWN_BITS, np.int32)
    for own in grams:
        holders[np.unique(own)] += 1
    shares = [np.mean(holders[own] == 1) for own in grams if len(own)]
    return np.packbits(holders > 0), float(np.quantile(shares, USUAL)) if shares else 0.0


def fit(
    sample: list[tuple[str, str]],
    *,
    landmarks_per_language: int = LANDMARKS_PER_LANGUAGE,
    ridge: float = RIDGE,
) -> Model:
    """Train on ``(lang, text)`` rows; the first rows of a language are its landmarks."""
    rows = sorted(sample, key=lambda row: row[0])
    return fit_rows(
        sorted({lang for lang, _ in rows}),
        lambda: iter(rows),
        landmarks_per_language=landmarks_per_language,
        ridge=ridge,
    )


def fit_rows(
    languages: list[str],
    rows: Callable[[], Iterator[tuple[str, str]]],
    *,
    landmarks_per_language: int = LANDMARKS_PER_LANGUAGE,
    ridge: float = RIDGE,
) -> Model:
    """:func:`fit` on rows in order of language, of which only one language's are held at a time."""
    if not languages:
        nothing = np.zeros((0, 0), np.float32)
        return Model([], np.zeros(0, np.int64), nothing, nothing, nothing, nothing)
    of = {lang: i for i, lang in enumerate(languages)}
    per_language = max(1, min(landmarks_per_language, MAX_LANDMARKS // len(languages)))
    known = np.zeros((len(languages), (1 << KNOWN_BITS) // 8), np.uint8)
    usual = np.zeros(len(languages))
    marks = []
    for lang, own in groupby(rows(), key=lambda row: row[0]):
        texts = [text for _, text in own]
        marks.append(np.packbits(presence(texts[:per_language])[0], axis=1))
        known[of[lang]], usual[of[lang]] = _known(texts)
    marks = np.concatenate(marks)
    columns = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(marks, axis=0)))
    own = np.concatenate([np.packbits(np.unpackbits(m)[columns])[None] for m in marks])
    model = Model(languages, columns, own, np.zeros((len(marks), len(languages))), known, usual)
    among = np.concatenate(
        [model.kernel(np.unpackbits(marks[k : k + _DOCS], axis=1)) for k in range(0, len(marks), _DOCS)]
    ).astype(np.float64)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    usable = values > 1e-8 * max(values.max(), 1e-12)
    half = vectors[:, usable] / np.sqrt(values[usable])
    gram = np.zeros((half.shape[1], half.shape[1]))
    target = np.zeros((half.shape[1], len(languages)))
    again = rows()
    while some := list(islice(again, _DOCS)):
        mapped = model.kernel(presence([t for _, t in some])[0]).astype(np.float64) @ half
        wanted = np.zeros((len(some), len(languages)))
        wanted[np.arange(len(some)), [of[lang] for lang, _ in some]] = 1
        gram += mapped.T @ mapped
        target += mapped.T @ wanted
    solved = np.linalg.solve(gram + ridge * np.eye(len(gram)), target)
    return Model(languages, columns, own, (half @ solved).astype(np.float32), known, usual)


def training_sample(documents: DataFrame, *, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most so many labelled rows of each language: ``lang, text, rank``.

    Each task keeps its first rows per language before anything is shuffled.
    """
    usable = documents.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()
    ).select("doc_id", "lang", "text")
    order = [F.length("text") > LONGEST_SAMPLE, F.xxhash64("doc_id"), F.col("doc_id"), F.col("text")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (
        usable.withColumn("rank", rank)
        .filter(F.col("rank") <= per_language)
        .select("lang", "text", "rank")
    )


def train(documents: DataFrame, **bounds) -> Model:
    """Fit on the bounded sample; ties and repeated rows are ordered by id, then text.

    The sample is staged and read in order, partition by partition, so that the driver never
    holds all of it.
    """
    sample = stage(training_sample(documents, **bounds).orderBy("lang", "rank"))
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())

    def rows():
        ordered = sample.orderBy("lang", "rank")
        return ((r["lang"], r["text"]) for r in ordered.toLocalIterator())

    return fit_rows(languages, rows)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every whole text.

    ``und`` with score 0 for null texts, texts without a letter, and if nothing was learned.
    Equal or null ids are rows of their own.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predicted(batches):
        model = shared.value
        for batch in sliced(batches):
            texts = texts_of(batch.column("text"))
            names, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for low in range(0, len(texts) if model.languages else 0, _DOCS):
                scores, any_letter = model.scores(texts[low : low + _DOCS])
                at = scores.argmax(1)
                for k in np.flatnonzero(any_letter):
                    names[low + k] = model.languages[at[k]]
                    best[low + k] = scores[k, at[k]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(names, pa.string()),
                    pa.array(best, pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = documents.select("doc_id", "text", held_out().alias("held_out"))
    schema = "doc_id bigint, held_out boolean, lang_pred string, score double"
    return map_batches(rows, ["doc_id", "text", "held_out"], predicted, schema)


def supported(documents: DataFrame, model: Model) -> DataFrame:
    """The documents in a learned language, with all their columns.

    Left out are null texts, texts without a letter and those with more unknown n-grams than
    texts in the language of their highest score have, as a whole and in half of their pieces.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def kept(batches):
        free_kept()
        model = shared.value
        for batch in sliced(batches):
            keep = model.supported(texts_of(batch.column("text")))
            yield batch.filter(pa.array(keep))

    return documents.mapInArrow(kept, documents.schema)


def identify(documents: DataFrame, **bounds) -> DataFrame:
    """Train on the labelled rows of ``documents`` and predict all of them."""
    return predict(documents, train(documents, **bounds))

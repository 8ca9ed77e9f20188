"""Stretches of a text whose words repeat with a short period: at least four times over.

A *run* is a stretch of words with smallest period q (words q apart are equal) and a length of at
least max(6, 4q) that no word before or after it could extend. It shows as a diagonal: word i equals
word i + q from its start until q words before its end, over at least max(6, 4q) - q words.

Seed and extend, per class of lags. For lags from q1 to 1.5 q1 that diagonal is at least
k = 3 q1 words long (5 for lags 1 and 2), so both ends of the lag start with the same k-gram: k-grams
are the index. As k is at least twice every lag of its class, a k-gram inside a run cannot occur
again closer than the run's smallest period, so the *next* occurrence of each k-gram is the only
partner to look at: as many pairs as words, however often a k-gram occurs. Neighbouring seeds of one
lag are one diagonal, which is extended by comparing words; a table of how far each lag is covered
stops a diagonal from being extended twice.

K-grams are named exactly, not hashed: the name of a k-gram is made of the names of the two shorter
ones that cover it, and only k-grams whose parts occur twice in their text go on to longer ones. In
plain text next to none do, so the long classes cost nothing there.

Null texts have no words. Every row is judged on its own, so null or repeated ids, copies of rows
and further columns change nothing; an empty table gives an empty one. Every text is one array of
words in its task; there is no other limit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import Batches, sliced

# What counts as a word, and how long a run must be.
WORD = r"[^\x20\x09-\x0D]+"
LEAST_LENGTH = 6
LEAST_PERIODS = 4

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lag_classes(longest: int) -> Iterator[tuple[int, int, int]]:
    """Least lag, greatest lag and k of each class that a text of ``longest`` words can hold."""
    low, k = 1, LEAST_LENGTH - 1
    while low * LEAST_PERIODS <= longest and longest >= LEAST_LENGTH:
        yield low, k // 2, k
        low = k // 2 + 1
        k = (LEAST_PERIODS - 1) * low


class _Grams:
    """Names of the k-grams that occur at least twice in their text, by where they start."""

    def __init__(self, words: np.ndarray):
        self.k = 1
        self.size = len(words)
        self._name(np.arange(self.size), words)

    def _name(self, at: np.ndarray, keys: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
        same = keys[1:] == keys[:-1]
        again = np.zeros(len(keys), bool)
        again[1:] |= same
        again[:-1] |= same
        number = np.cumsum(np.concatenate([[0], ~same])) if len(keys) else keys
        self.at, self.number = at[again], number[again]
        # Equal names are neighbours, by place: each pair is an occurrence and the next one.
        self.pair = self.number[1:] == self.number[:-1]

    def grow(self, k: int) -> None:
        """Names of k-grams from those of shorter ones, at least half as long."""
        while self.k < k and len(self.at):
            longer = min(k, 2 * self.k)
            names = np.full(self.size + longer, -1, np.int64)
            names[self.at] = self.number
            at = np.sort(self.at)
            first, second = names[at], names[at + longer - self.k]
            at, first, second = (x[second >= 0] for x in (at, first, second))
            self.k = longer
            self._name(at, first * (self.number.max() + 1) + second)

    def seeds(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Places whose k-gram comes next at a lag from ``low`` to ``high``, and the lags."""
        lag = (self.at[1:] - self.at[:-1])[self.pair]
        at = self.at[:-1][self.pair]
        inside = (lag >= low) & (lag <= high)
        at, lag = at[inside], lag[inside]
        order = np.argsort(at)
        return at[order], lag[order]


def runs_of(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, end, period)``, by start and period, of texts laid one after the other.

    ``words`` are numbers, equal only for equal words of the same text; ``ends`` are the texts'
    ends. No k-gram over the border of two texts occurs twice, so none is a seed.
    """
    lengths = np.diff(ends, prepend=0)
    longest = int(lengths.max(initial=0))
    found = []
    grams = _Grams(words)
    for low, high, k in lag_classes(longest):
        grams.grow(k)
        if not len(grams.at):
            break
        at, lag = grams.seeds(low, high)
        if not len(at):
            continue
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(lag) != 0)) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]]) - 1
        text = np.searchsorted(ends, at[first], side="right")
        limits = ends[text]
        floors = limits - lengths[text]
        covered: dict[int, int] = {}
        diagonals = (at[first], at[last] + k, lag[first], floors, limits)
        for start, stop, q, floor, limit in zip(*(x.tolist() for x in diagonals), strict=True):
            if start < covered.get(q, 0):
                continue
            while start > floor and words[start - 1] == words[start - 1 + q]:
                start -= 1
            end = stop + q
            while end < limit and words[end] == words[end - q]:
                end += 1
            covered[q] = end - q
            if end - start >= max(LEAST_LENGTH, LEAST_PERIODS * q):
                found.append((start, end, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all rows, and where each row's words end; a null row has none."""
    column = column.fill_null([]) if column.null_count else column
    offsets = column.offsets.to_numpy()
    return column.flatten(), (offsets[1:] - offsets[0]).astype(np.int64)


def _judged(batch: pa.RecordBatch) -> list[pa.Array]:
    """Number of words, runs and remaining text of each row of a batch with one list column."""
    words, ends = _lists(batch.column(batch.num_columns - 1))
    lengths = np.diff(ends, prepend=0)
    codes = words.dictionary_encode()
    text = np.repeat(np.arange(len(ends)), lengths)
    # A word of another text is another word.
    own = text * max(1, len(codes.dictionary)) + codes.indices.to_numpy()
    runs = runs_of(own, ends)
    change = np.zeros(len(own) + 1, np.int64)
    for start, end, q in runs:
        change[start + q] += 1
        change[end] -= 1
    kept = np.cumsum(change)[:-1] == 0
    first = np.searchsorted(ends, [r[0] for r in runs], side="right")
    rows = [
        {"start": s - int(ends[t] - lengths[t]), "length": e - s, "period": q}
        for (s, e, q), t in zip(runs, first.tolist(), strict=True)
    ]
    list_ends = np.searchsorted(first, np.arange(len(ends)), side="right")
    kept_ends = np.concatenate([[0], np.cumsum(kept)])[ends]
    remaining = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], kept_ends]), pa.int32()), words.filter(pa.array(kept))
    )
    return [
        pa.array(lengths),
        pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], list_ends]), pa.int32()), pa.array(rows, _RUN)
        ),
        pc.binary_join(remaining, " "),
    ]


def find_runs(rows: DataFrame, words: Column, *, carry: Sequence[str] = ()) -> DataFrame:
    """``carry``, ``n_words``, ``runs`` (by start, then period) and ``collapsed`` of each row.

    ``words`` is an array of words, null for none. ``collapsed`` is the text without the repeats:
    the words that no run holds after its first period, joined by one space. Word numbers in
    ``runs`` count from 0.
    """
    carried = rows.select(*carry, words.alias("_words"))
    kept = ["n_words", "runs", "collapsed"]

    def judge(batches: Batches) -> Batches:
        for batch in sliced(batches):
            own = [batch.column(i) for i in range(len(carry))]
            yield pa.RecordBatch.from_arrays([*own, *_judged(batch)], [*carry, *kept])

    ddl = [f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields[: len(carry)]]
    ddl += ["n_words bigint", "runs array<struct<start:bigint,length:bigint,period:bigint>>"]
    return carried.mapInArrow(judge, ", ".join([*ddl, "collapsed string"]))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``words``; every tenth document, by its id, is periodic from some word on.

    With h the CRC of the decimal id and g = floor(h / 10): where h ends in 0, words from number
    a = g mod n repeat those from a with period 1 + floor((n - a) / (3 + g mod 8)). A null id has
    no CRC: its words stay.
    """
    split = docs.select(
        "doc_id",
        F.crc32(F.col("doc_id").cast("string")).alias("h"),
        words_of(F.col("text")).alias("own"),
    )
    g = F.floor(F.col("h") / 10)
    start = F.try_mod(g, F.size("own")).cast("int")
    drawn = split.select("doc_id", "h", "own", start.alias("a"), g.alias("g")).select(
        "*", F.expr("int(1 + (size(own) - a) div (3 + g % 8))").alias("p")
    )
    repeated = F.expr("transform(own, (w, i) -> if(i < a, w, get(own, a + (i - a) % p)))")
    planted = (F.col("h") % 10 == 0) & (F.size("own") > 0)
    return drawn.select("doc_id", F.when(planted, repeated).otherwise(F.col("own")).alias("words"))


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run of each document, and digests of all its runs and of the remaining text."""
    ranked = "transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period))"
    longest = found.withColumn("_top", F.expr(f"array_max({ranked})"))
    listed = "transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))"
    return longest.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("_top.start")).alias("start"),
        F.col("_top.length").alias("length"),
        (-F.col("_top.period")).alias("period"),
        F.expr("1000 * _top.length div -_top.period").alias("exponent_milli"),
        F.sha2(F.expr(f"array_join({listed}, '')"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )

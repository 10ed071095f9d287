"""Language identification with error-correcting output codes.

Every learned language has a codeword of bits. One binary classifier per bit tells from a text's byte n-grams whether the
language is among those with the bit set: its weight for an n-gram is the log of how much likelier that n-gram is under
those languages than under the others. A text's margin is the mean weight of its n-grams. Decoding takes the codeword with
the least total loss over all bits, the loss of a wrong bit growing with the margin; two codewords of nearly the same loss
make the text ambiguous.

N-grams are counted over every labelled row, in Spark; the driver holds one count per language and bin. Texts that are null
or have no letter are ``und`` with score 0, as is every text where nothing was learned. Ties go to the first language.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
BINS = 1 << 16
N_GRAMS = (2, 3, 4)
# Added to every language's count of a bin, as a share of the language's mean count.
SMOOTHING = 0.05
# A margin of one (a mean n-gram e times likelier on one side) counts this much in the loss.
SHARPNESS = 6.0
# Texts whose best codeword is not this much likelier than the next are ambiguous.
CLEAR_SCORE = 0.6
# Losses nearer than this are equal: sums of single precision tell no more.
SAME_LOSS = 1e-6
EXHAUSTIVE_UP_TO = 6
SEED = 42
BYTES_AT_ONCE = 1 << 18

_SPACES = bytes.maketrans(*(lambda other: (other, b" " * len(other)))((string.punctuation + string.digits).encode()))


def letters(text: str) -> bytes:
    """Lower-case UTF-8 with ASCII punctuation, digits and white space as single spaces."""
    return b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_SPACES).split()) + b" "


def bins(data: bytes) -> Iterator[np.ndarray]:
    """Bins of all n-grams of bytes, a stretch of the text at a time."""
    widest = max(N_GRAMS)
    for start in range(0, len(data), BYTES_AT_ONCE):
        codes = np.frombuffer(data[start : start + BYTES_AT_ONCE + widest - 1], np.uint8).astype(np.uint32)
        parts = []
        for n in N_GRAMS:
            count = min(BYTES_AT_ONCE, len(codes) - n + 1)
            if count > 0:
                mixed = np.full(count, n, np.uint32)
                for i in range(n):
                    mixed = (mixed ^ codes[i : i + count]) * np.uint32(0x9E3779B1)
                parts.append(mixed >> np.uint32(16))
        if parts:
            yield np.concatenate(parts)


def codewords(count: int) -> np.ndarray:
    """A matrix of +1 and -1, a row per language; all splits of few languages, random ones of many."""
    if count <= EXHAUSTIVE_UP_TO:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=count - 1) if -1 in rest]
        return np.array(splits, np.int8).T.reshape(count, -1)
    length = int(np.ceil(10 * np.log2(count)))
    draws = np.random.default_rng(SEED)
    best, best_apart = None, -1
    for _ in range(50):
        code = draws.choice(np.array([1, -1], np.int8), (count, length))
        agree = code.astype(int) @ code.T
        np.fill_diagonal(agree, -length)
        apart = (length - agree.max()) // 2 if (np.abs(code.sum(axis=0)) < count).all() else 0
        if apart > best_apart:
            best, best_apart = code, apart
    return best


@dataclass(frozen=True)
class Model:
    """What was learned: languages, their codewords, and the weight of each bin for each bit (and some zeros)."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray

    def losses(self, text: str) -> np.ndarray:
        """Total loss per language."""
        total, count = np.zeros(self.weights.shape[1]), 0
        for some in bins(letters(text)):
            total += np.ones(len(some), np.float32) @ np.take(self.weights, some, axis=0)
            count += len(some)
        margins = SHARPNESS * total[: self.code.shape[1]] / max(1, count)
        return np.logaddexp(0, -self.code * margins).sum(axis=1)

    def decode(self, text: str) -> tuple[str, float, bool]:
        """Language, score in 0 to 1, and whether another codeword is about as near."""
        losses = self.losses(text)
        chances = np.exp(losses.min() - losses)
        best = int(np.argmax(losses <= losses.min() + SAME_LOSS))
        score = float(chances[best] / chances.sum())
        return self.languages[best], score, score < CLEAR_SCORE and len(self.languages) > 1


def count_ngrams(docs: DataFrame, text: str, language: str) -> DataFrame:
    """``language``, ``bin``, ``n``: n-grams of all texts with a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1).to_pylist()):
                if name not in sums:
                    sums[name] = np.zeros(BINS, np.int64)
                for some in bins(letters(value.as_py())):
                    if len(some) > BINS // 8:
                        sums[name] += np.bincount(some, minlength=BINS)
                    else:
                        np.add.at(sums[name], some, 1)
        for name, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at])], ["language", "bin", "n"]
            )

    labelled = docs.filter(F.col(text).isNotNull() & F.col(language).isNotNull()).select(text, F.col(language).cast("string"))
    counted = labelled.mapInArrow(run, "language string, bin int, n long")
    return counted.groupBy("language", "bin").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", language: str = "lang") -> Model:
    """Learn from every row with a text and a language."""
    counts = count_ngrams(docs, text, language).toArrow()
    names = counts.column("language").to_pylist()
    languages = sorted(set(names))
    table = np.zeros((len(languages), BINS))
    rows = np.searchsorted(languages, names) if names else np.empty(0, int)
    table[rows, counts.column("bin").to_numpy()] = counts.column("n").to_numpy()
    if not languages:
        return Model([], np.zeros((0, 0), np.int8), np.zeros((BINS, 0), np.float32))
    table += SMOOTHING * table.mean(axis=1, keepdims=True)
    shares = table / table.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    # Rows of whole eights of bits are gathered much faster; the bits that fill up weigh nothing.
    weights = np.zeros((BINS, -(-code.shape[1] // 8) * 8), np.float32)
    for bit in range(code.shape[1]):
        on = code[:, bit] > 0
        weights[:, bit] = np.log(shares[on].mean(axis=0) / shares[~on].mean(axis=0))
    return Model(languages, code, weights)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous`` (columns of these names are replaced)."""
    fields = [("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())]
    kept = [name for name in docs.columns if name not in dict(fields)]
    seen = docs.select(
        *(F.col(f"`{name}`") for name in kept), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letters")
    )
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                model.decode(value.as_py()) if has and model.languages else (UNDETERMINED, 0.0, True)
                for value, has in zip(batch.column(at), batch.column(len(kept)).to_pylist())
            ]
            columns = [pa.array([row[i] for row in found], kind) for i, (_, kind) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*kept, *dict(fields)])

    schema = seen.drop("__letters").schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    return seen.mapInArrow(run, schema)

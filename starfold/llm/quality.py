"""Quality scores by logistic regression over hashed word n-grams, learned by follow-the-regularised-leader updates.

A text is the bag of its word n-grams, each hashed to one of ``BINS`` bins: single words and pairs as they are, and single
forms, pairs and triples of forms. A word's form is its pattern of letter cases, digits and marks (``THE!!`` is ``A!``), or
``=`` where it repeats the word before it. A bin weighs the logarithm of its count, the whole text has length one, so long
and short texts count alike. A score is one sparse dot product and a sigmoid.

Learning takes a bounded sample of labelled documents (``SAMPLE_ROWS``, by hash of the id). They are dealt to learners of
about ``LEARNER_ROWS`` rows; each makes the per-coordinate proximal updates over its rows in one pass, in hash order, and
the learners' weights are averaged in whole numbers, so reruns and other partitionings give the same model. The driver and
each task hold ``BINS`` weights whatever the input.

Null and empty texts have no n-grams: their score is the sigmoid of the bias. Documents whose label rows disagree take the
more frequent label, ties the label 1; a null label is none. Of rows with one id the least text is learned from. Without
any label all weights are 0 and all scores 0.5. Words are runs of anything but ASCII white space.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1 << 18
SAMPLE_ROWS = 32_768
LEARNER_ROWS = 4_096
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.02
# Weights are averaged as whole multiples of this.
GRAIN = 2.0**-32
# Longer texts are read in stretches of about so many bytes, cut between words.
STRETCH = 1 << 20
MEMORY = 1 << 18

_CLASSES = bytearray(range(256))
for _at in range(256):
    _char = chr(_at)
    if _at >= 128 or _char.islower():
        _CLASSES[_at] = ord("a")
    elif _char.isupper():
        _CLASSES[_at] = ord("A")
    elif _char.isdigit():
        _CLASSES[_at] = ord("0")
_CLASSES = bytes(_CLASSES)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)
REPEATED = zlib.crc32(b"=")


def form(word: bytes) -> bytes:
    """Letter cases, digits and marks of a word, each run of one kind as one character."""
    return _RUN.sub(rb"\1", word.translate(_CLASSES))


class Codes(dict):
    """Word -> 32-bit hashes of the word and of its form, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        code = self[word] = zlib.crc32(word) << 32 | zlib.crc32(form(word))
        return code


def stretches(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a stretch at a time."""
    start = 0
    while start < len(data):
        end = start + STRETCH
        if end >= len(data):
            end = len(data)
        else:
            cut = re.compile(rb"[ \t-\r]").search(data, end)
            end = cut.start() if cut else len(data)
        yield data[start:end].split()
        start = end


def mixed(kind: int, *codes: np.ndarray) -> np.ndarray:
    """Bins of n-grams, given the codes of their first, second ... words."""
    total = np.full(len(codes[0]), kind, np.uint32)
    for code in codes:
        total = (total ^ code) * np.uint32(0x9E3779B1)
        total ^= total >> np.uint32(15)
    return (total * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BINS.bit_length() + 1)


def features(text: str | None, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Bins of a text in ascending order, and their values; the last bin is the bias."""
    words_before, forms_before = np.empty(0, np.uint32), np.empty(0, np.uint32)
    found, counts = np.empty(0, np.uint32), np.empty(0, np.int64)
    for words in stretches((text or "").encode("utf-8", "surrogatepass")):
        both = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
        plain = np.concatenate([words_before, (both >> np.uint64(32)).astype(np.uint32)])
        forms = np.concatenate([forms_before, both.astype(np.uint32)])
        old = len(words_before)
        again = np.flatnonzero(plain[1:] == plain[:-1]) + 1
        forms[again[again >= old]] = REPEATED
        # N-grams that end in this stretch.
        some = [mixed(1, plain[old:]), mixed(3, forms[old:])]
        for kind, series, n in ((2, plain, 2), (4, forms, 2), (5, forms, 3)):
            first = max(old - n + 1, 0)
            count = len(series) - first - n + 1
            if count > 0:
                some.append(mixed(kind, *(series[first + i : first + i + count] for i in range(n))))
        bins = np.concatenate([found, *some])
        found, inverse = np.unique(bins, return_inverse=True)
        sums = np.bincount(inverse, np.concatenate([counts, np.ones(len(bins) - len(counts), np.int64)]), len(found))
        counts = sums.astype(np.int64)
        words_before, forms_before = plain[-2:], forms[-2:]
    values = 1 + np.log(counts) if len(counts) else np.empty(0)
    length = np.sqrt(values @ values) or 1.0
    return np.append(found, BINS).astype(np.int64), np.append(values / length, 1.0)


def sigmoid(margin: float) -> float:
    return float(0.5 * (1 + np.tanh(0.5 * margin)))


class Learner:
    """Per-coordinate proximal updates of follow-the-regularised-leader."""

    def __init__(self) -> None:
        self.pull = np.zeros(BINS + 1)
        self.squares = np.zeros(BINS + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        pull, pace = self.pull[at], (BETA + np.sqrt(self.squares[at])) / ALPHA + L2
        return np.where(np.abs(pull) > L1, (np.sign(pull) * L1 - pull) / pace, 0.0)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(at)
        slope = (sigmoid(weights @ values) - label) * values
        squares = self.squares[at] + slope * slope
        self.pull[at] += slope - (np.sqrt(squares) - np.sqrt(self.squares[at])) / ALPHA * weights
        self.squares[at] = squares


def share_below(column: Column, share: float) -> Column:
    """Whether a hash of the column lies in the first ``share`` of all hashes."""
    return F.shiftrightunsigned(F.xxhash64(column), 1) <= F.lit(min(int(share * 2.0**63), 2**63 - 1))


def sample(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, rows: int) -> tuple[DataFrame, int]:
    """Key, text and label of about ``rows`` labelled documents, or of all if they are fewer; and about how many."""
    votes = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("__key"), F.when(F.col(label) > 0, 1).otherwise(0).alias("__vote")
    )
    decided = votes.groupBy("__key").agg(F.when(F.avg("__vote") >= 0.5, 1).otherwise(0).alias("__label"))
    count = decided.count()
    chosen = decided.filter(share_below(F.col("__key"), rows / count)) if count > rows else decided
    met = docs.select(F.col(key).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    # Counted: no more than about ``rows`` ids and labels, whatever the input.
    met = met.join(F.broadcast(chosen), F.col("__id") == F.col("__key"))
    return met.groupBy("__key", "__label").agg(F.min("__text").alias("__text")), min(count, rows)


def fit(
    docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS
) -> np.ndarray:
    """Weights of all bins and of the bias, learned from the documents that ``labels`` names."""
    sampled, count = sample(docs, labels, label, key, text, rows)
    learners = max(1, -(-count // LEARNER_ROWS))
    examples = sampled.select(
        F.pmod(F.xxhash64(F.lit("learner"), F.col("__key")), F.lit(learners)).alias("__learner"),
        F.xxhash64(F.lit("order"), F.col("__key")).alias("__order"), "__key", "__text", "__label",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, number, learner = Codes(), None, None

        def learned() -> pa.RecordBatch:
            weights = np.rint(learner.weights(slice(None)) / GRAIN).astype(np.int64)
            at = np.flatnonzero(weights)
            return pa.RecordBatch.from_arrays([pa.array(at), pa.array(weights[at])], ["bin", "weight"])

        for batch in batches:
            numbers, outcomes = batch.column(0).to_pylist(), batch.column(4).to_pylist()
            for row, (own, outcome) in enumerate(zip(numbers, outcomes)):
                if own != number:
                    if learner is not None:
                        yield learned()
                    number, learner = own, Learner()
                learner.learn(*features(batch.column(3)[row].as_py(), codes), outcome)
        if learner is not None:
            yield learned()

    dealt = examples.repartition(learners, "__learner").sortWithinPartitions("__learner", "__order", "__key")
    sums = dealt.mapInArrow(run, "bin long, weight long").groupBy("bin").agg(F.sum("weight").alias("weight")).toArrow()
    weights = np.zeros(BINS + 1)
    weights[sums.column("bin").to_numpy()] = sums.column("weight").to_numpy() * GRAIN / learners
    return weights


def score(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (columns of these names are replaced)."""
    kept = [name for name in docs.columns if name not in ("score", "predicted")]
    seen = docs.select(*(F.col(f"`{name}`") for name in kept), F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for row, value in enumerate(batch.column(len(kept))):
                at, values = features(value.as_py(), codes)
                scores[row] = sigmoid(weights[at] @ values)
            columns = [*batch.columns[:-1], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "score", "predicted"])

    return seen.mapInArrow(run, seen.drop("__text").schema.add("score", "double").add("predicted", "integer"))

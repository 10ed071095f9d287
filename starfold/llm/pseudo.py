"""Document scores by masked pseudo-likelihood.

A small network sees the two words before and the two after a place and predicts the word that is masked there: each
neighbour adds the vector of its word at that distance, a tanh layer follows, and the word is predicted as a class of symbols
and a member of the class. The 1,024 most frequent words are symbols of their own; every other word falls by its hash into one
of 1,024 buckets, which are symbols too, and is one of the words of its bucket with a chance that its count in all documents
gives. A document's score is the sum over all its words of the log-probability of each given the words on both sides.

So the network has one size for any corpus, some 0.7 MB in the driver and in each task, while the counts grow with the corpus
and stay a table: the words of the documents are shuffled to their counts, never the counts to a task or the driver. No such
word is hot, as 1,024 others are more frequent. A count is lowered by ``DISCOUNT``, and what this frees is shared among all words
by their spelling, a model of byte trigrams counted over all words in buckets; a word that no document had has this share alone.

The network is trained in numpy by every task on its split of the documents, from the same start, and the tasks' networks are
averaged: a word's vectors by how often the task met them, all else by the number of words a task saw. All steps go through
every document, once each by default. The average depends on how the input is split, so scores are compared within a run.

Words are what stands between ASCII white space, A-Z in lower case, and meet by 64-bit hashes. Null and empty texts have no
words and score 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm.recovery import written

# Most frequent words, and buckets of all others.
FREQUENT = 1024
BUCKET_BITS = 10
BUCKETS = 1 << BUCKET_BITS
CLASSES, MEMBERS = 32, 64
WORDS = CLASSES * MEMBERS
EDGE = WORDS
# What is taken off each word's count for words that are told by their spelling.
DISCOUNT = 0.75
OFFSETS = (-2, -1, 1, 2)
HIDDEN = 16
BATCH = 8192
RATE = 0.1
SEED = 42
BYTES_AT_ONCE = 1 << 21
WORDS_AT_ONCE = 1 << 17
# Different words that a task counts before it hands its counts on.
COUNTED_AT_ONCE = 1 << 20
COUNTED_BYTES = 1 << 26
# Bytes of words, lower case and from 1 on, and the end of a word.
LETTERS = 257
# How many sightings the shorter context's guess is worth in a spelling.
TRUST = 5.0

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.array([code + 32 if 65 <= code <= 90 else code for code in range(256)], np.uint64) + np.uint64(1)
_WEIGHTS = np.random.default_rng(SEED).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_FARTHER = np.uint64(0x9E3779B97F4A7C15)

Params = list[np.ndarray]


def word_bins(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of a string column: the hash of every word, and the row it is in."""
    return _words(column)[:2]


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The hash and row of every word, all bytes, and where in them each word begins and ends."""
    column = column.cast(pa.large_binary())
    _, offsets, buffer = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    none = np.empty(0, np.int64)
    if ends[-1] == ends[0]:
        return none, none, np.empty(0, np.uint8), none, none
    data = np.frombuffer(buffer, np.uint8)[ends[0] : ends[-1]]
    limits = ends - ends[0]
    inside = ~_SPACE[data]
    starts, stops = inside.copy(), inside.copy()
    apart = np.zeros(len(data) + 1, bool)
    apart[limits] = True
    starts[1:] &= ~inside[:-1] | apart[1:-1]
    stops[:-1] &= ~inside[1:] | apart[1:-1]
    first, last = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    if not len(first):
        return none, none, data, none, none
    bins = np.concatenate([
        _hashed(data, inside, first[low : low + WORDS_AT_ONCE], last[low : low + WORDS_AT_ONCE])
        for low in range(0, len(first), WORDS_AT_ONCE)
    ])
    return bins, np.searchsorted(limits, first, "right") - 1, data, first, last


def _hashed(data: np.ndarray, inside: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of consecutive words, given where each begins and ends."""
    lengths = last - first
    heads = np.cumsum(lengths) - lengths
    letters = data[first[0] : last[-1]][inside[first[0] : last[-1]]]
    place = np.arange(len(letters)) - np.repeat(heads, lengths)
    weights = _WEIGHTS[place & 63]
    if lengths.max() > 64:
        weights = weights + (place >> 6).astype(np.uint64) * _FARTHER
    hashes = np.add.reduceat(_LOWER[letters] * weights, heads)
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (hashes ^ (hashes >> np.uint64(29))).view(np.int64)


def windows(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each word the ids at ``OFFSETS``; beyond a text's ends stands ``EDGE``. A row per offset."""
    reach = max(OFFSETS)
    at = np.arange(len(ids)) + reach * (rows + 1)
    stream = np.full(at[-1] + reach + 1, EDGE)
    stream[at] = ids
    return np.stack([stream[at + offset] for offset in OFFSETS])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with about ``BYTES_AT_ONCE`` of text, which is the last column, or one longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // BYTES_AT_ONCE
        cuts = np.flatnonzero(np.diff(part)) + 1
        for low, high in zip(np.r_[0, cuts].tolist(), np.r_[cuts, batch.num_rows].tolist()):
            if high > low:
                yield batch.slice(low, high - low)


def _lowered_words(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """The bytes of words, A-Z in lower case."""
    lengths = last - first
    offsets = np.r_[0, np.cumsum(lengths)]
    at = np.repeat(first - offsets[:-1], lengths) + np.arange(offsets[-1])
    letters = (_LOWER[data[at]] - np.uint64(1)).astype(np.uint8)
    return pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``hash``, ``word`` and ``n``: how often each word is in the texts of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts, words = np.empty(0, np.int64), np.empty(0, np.int64), pa.array([], pa.large_binary())

        def held() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(values), words.cast(pa.binary()), pa.array(counts)], ["hash", "word", "n"])

        for batch in _slices(batches):
            bins, _, data, first, last = _words(batch.column(0))
            found, at, n = np.unique(bins, return_index=True, return_counts=True)
            both, place, group = np.unique(np.r_[values, found], return_index=True, return_inverse=True)
            words = pa.concat_arrays([words, _lowered_words(data, first[at], last[at])]).take(pa.array(place))
            counts = np.bincount(group, np.r_[counts, n], len(both)).astype(np.int64)
            values = both
            if len(values) > COUNTED_AT_ONCE or words.nbytes > COUNTED_BYTES:
                yield held()
                values, counts, words = values[:0], counts[:0], words[:0]
        yield held()

    seen = docs.select(text).mapInArrow(run, "hash long, word binary, n long")
    return seen.groupBy("hash", "word").agg(F.sum("n").alias("n"))


def spelled(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of words, ends included, as numbers, and the word each is of."""
    lengths = last - first
    heads = np.cumsum(lengths + 2) - lengths
    word = np.repeat(np.arange(len(first)), lengths)
    place = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    stream = np.zeros(int((lengths + 2).sum()) + 1, np.int64)
    at = heads[word] + place
    stream[at] = _LOWER[data[first[word] + place]]
    at = np.r_[at, heads + lengths]
    return (stream[at - 2] * LETTERS + stream[at - 1]) * LETTERS + stream[at], np.r_[word, np.arange(len(first))]


class Spelling:
    """Chances of a byte after two others, backed by those after one and after none."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.counts = codes[order], counts[order]
        pairs = np.bincount(self.codes % LETTERS**2, self.counts, LETTERS**2).reshape(LETTERS, LETTERS)
        single = (pairs.sum(axis=0) + 1) / (pairs.sum() + LETTERS)
        self.short = ((pairs + TRUST * single) / (pairs.sum(axis=1, keepdims=True) + TRUST)).ravel()
        self.before = np.bincount(self.codes // LETTERS, self.counts, LETTERS**2)

    def log_chances(self, codes: np.ndarray) -> np.ndarray:
        seen = np.zeros(len(codes))
        if len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            seen = np.where(self.codes[at] == codes, self.counts[at], 0)
        return np.log((seen + TRUST * self.short[codes % LETTERS**2]) / (self.before[codes // LETTERS] + TRUST))


class Vocabulary:
    """Symbols by hash, and what the words of each bucket share.

    ``counts`` is the table of ``hash``, ``n`` and ``spelling`` of all words of the corpus.
    """

    def __init__(self, hashes: np.ndarray):
        """``hashes`` of the most frequent words, the first being symbol 0."""
        order = np.argsort(hashes)
        self.hashes, self.ranks = hashes[order], order
        self.counts: DataFrame | None = None
        self.totals, self.different = np.zeros(BUCKETS), np.zeros(BUCKETS)
        self.spelling = Spelling(np.empty(0, np.int64), np.empty(0, np.int64))

    def __getitem__(self, hashes: np.ndarray) -> np.ndarray:
        wanted = np.asarray(hashes, np.int64)
        ids = FREQUENT + bucket(wanted)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
            ids = np.where(self.hashes[at] == wanted, self.ranks[at], ids)
        return ids

    def __getstate__(self):
        # The counts stay a table; tasks get what is of one size.
        return {**self.__dict__, "counts": None}


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _column_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and where in them each value begins and ends."""
    column = column.cast(pa.large_binary())
    _, offsets, buffer = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(buffer, np.uint8), ends[:-1], ends[1:]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with about ``BYTES_AT_ONCE`` of letters, or one longer word; a batch without words is left out."""
    return (part for part in _slices(batches) if part.num_rows)


def _spelling(counts: DataFrame, known: Vocabulary) -> Spelling:
    """The trigrams of all words in buckets, each as often as the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in _parts(batches):
            hashes, n = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 1))
            data, first, last = _column_words(batch.column(2))
            here = np.flatnonzero(known[hashes] >= FREQUENT)
            found, word = spelled(data, first[here], last[here])
            codes, group = np.unique(np.r_[codes, found], return_inverse=True)
            sums = np.bincount(group, np.r_[sums, n[here][word]], len(codes)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums)], ["code", "n"])

    seen = counts.select("hash", "n", "word").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    # At most 257^3 trigrams.
    seen = seen.toArrow()
    return Spelling(*(seen.column(name).to_numpy().astype(np.int64) for name in ("code", "n")))


def _spelled_words(counts: DataFrame, spelling: Spelling) -> DataFrame:
    """``hash``, ``n`` and ``spelling``, the log-probability of each word's letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            codes, word = spelled(*_column_words(batch.column(2)))
            logs = np.bincount(word, spelling.log_chances(codes), batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(logs)], ["hash", "n", "spelling"])

    return counts.select("hash", "n", "word").mapInArrow(run, "hash long, n long, spelling double")


def vocabulary(docs: DataFrame, text: str = "text") -> Vocabulary:
    """Counts of all words of all documents, the most frequent ones, and the spelling of the others."""
    counts = written(word_counts(docs, text), "word-counts")
    top = counts.select("hash", "n").orderBy(F.desc("n"), "hash").limit(FREQUENT).toArrow()
    known = Vocabulary(top.column("hash").to_numpy().astype(np.int64))
    # At most so many rows as there are frequent words, and a row for each bucket.
    frequent = F.broadcast(docs.sparkSession.createDataFrame([(int(one),) for one in known.hashes], "hash long"))
    others = counts.join(frequent, "hash", "left_anti").groupBy(F.shiftrightunsigned("hash", 64 - BUCKET_BITS).alias("bucket"))
    shares = others.agg(F.sum("n").alias("total"), F.count("*").alias("different")).toArrow()
    at = shares.column("bucket").to_numpy()
    known.totals[at], known.different[at] = (shares.column(name).to_numpy() for name in ("total", "different"))
    known.spelling = _spelling(counts, known)
    known.counts = written(_spelled_words(counts, known.spelling), "spelled-words")
    return known


def fresh() -> Params:
    """Vectors of the symbols at each offset, hidden bias, class weights and bias, member weights and bias."""
    draws = np.random.default_rng(SEED)
    shapes = [(len(OFFSETS) * (WORDS + 1), HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,), (CLASSES, HIDDEN, MEMBERS), (CLASSES, MEMBERS)]
    return [draws.normal(0, 0.1, shape).astype(np.float32) if len(shape) > 1 else np.zeros(shape, np.float32) for shape in shapes]


def _softmax(logits: np.ndarray) -> np.ndarray:
    chances = np.exp(logits - logits.max(axis=1, keepdims=True))
    return chances / chances.sum(axis=1, keepdims=True)


@dataclass
class Pass:
    """What a batch leaves behind for its gradients."""

    log_p: np.ndarray
    rows: np.ndarray
    hidden: np.ndarray
    classes: np.ndarray
    members: list[tuple[int, np.ndarray, np.ndarray]]


def forward(params: Params, around: np.ndarray, ids: np.ndarray) -> Pass:
    """Log-probability of each word given its window; ``around`` has a row per offset."""
    vectors, hidden_bias, class_w, class_b, member_w, member_b = params
    rows = around + (np.arange(len(OFFSETS)) * (len(vectors) // len(OFFSETS)))[:, None]
    total = np.take(vectors, rows[0], axis=0)
    for row in rows[1:]:
        total += np.take(vectors, row, axis=0)
    hidden = np.tanh(total + hidden_bias)
    classes = _softmax(hidden @ class_w + class_b)
    kinds = (ids // MEMBERS).astype(np.int8)
    log_p = np.log(classes[np.arange(len(ids)), kinds])
    order = np.argsort(kinds, kind="stable")
    ends = np.cumsum(np.bincount(kinds, minlength=CLASSES))
    members = []
    for kind in range(CLASSES):
        here = order[ends[kind - 1] if kind else 0 : ends[kind]]
        if len(here):
            chances = _softmax(hidden[here] @ member_w[kind] + member_b[kind])
            log_p[here] += np.log(chances[np.arange(len(here)), ids[here] % MEMBERS])
            members.append((kind, here, chances))
    return Pass(log_p, rows, hidden, classes, members)


@dataclass
class Sparse:
    """Gradient of the rows that a batch has met, and how often it has met each."""

    rows: np.ndarray
    values: np.ndarray
    met: np.ndarray


def _row_sums(rows: np.ndarray, columns: Iterator[np.ndarray], width: int, size: int) -> Sparse:
    seen, place = np.zeros(size, bool), np.empty(size, np.int32)
    seen[rows] = True
    found = np.flatnonzero(seen)
    place[found] = np.arange(len(found))
    at = place[rows]
    values = np.empty((len(found), width), np.float32)
    for number, column in enumerate(columns):
        values[:, number] = np.bincount(at, column, len(found))
    return Sparse(found, values, np.bincount(at, minlength=len(found)))


def _gradients(params: Params, done: Pass, ids: np.ndarray) -> list[np.ndarray | Sparse]:
    """Of the mean negative log-probability, sparse for vectors; uses up what the pass has left."""
    vectors, _, class_w, _, member_w, member_b = params
    count = np.float32(len(ids))
    done.classes[np.arange(len(ids)), ids // MEMBERS] -= 1
    back = done.classes @ class_w.T
    member_w_g, member_b_g = np.zeros_like(member_w), np.zeros_like(member_b)
    for kind, here, chances in done.members:
        chances[np.arange(len(here)), ids[here] % MEMBERS] -= 1
        member_w_g[kind] = done.hidden[here].T @ chances
        member_b_g[kind] = chances.sum(axis=0)
        back[here] += chances @ member_w[kind].T
    back *= 1 - done.hidden**2
    columns = (np.tile(back[:, column], len(OFFSETS)) for column in range(HIDDEN))
    vectors_g = _row_sums(done.rows.ravel(), columns, HIDDEN, len(vectors))
    found = [vectors_g, back.sum(axis=0), done.hidden.T @ done.classes, done.classes.sum(axis=0), member_w_g, member_b_g]
    for gradient in found:
        values = gradient.values if isinstance(gradient, Sparse) else gradient
        values /= count
    return found


def gradients(params: Params, done: Pass, ids: np.ndarray) -> Params:
    """Of the mean negative log-probability; uses up what the pass has left."""
    found = []
    for value, gradient in zip(params, _gradients(params, done, ids)):
        if isinstance(gradient, Sparse):
            whole = np.zeros(value.shape, np.float32)
            whole[gradient.rows] = gradient.values
            gradient = whole
        found.append(gradient)
    return found


def train_on(params: Params, squares: Params, around: np.ndarray, ids: np.ndarray, met: dict[int, np.ndarray] | None = None) -> None:
    """One Adagrad step a batch, in place; the sparse ones have one rate a row, and ``met`` adds up how often each was met."""
    for low in range(0, len(ids), BATCH):
        part = ids[low : low + BATCH]
        done = forward(params, around[:, low : low + BATCH], part)
        for number, (value, square, gradient) in enumerate(zip(params, squares, _gradients(params, done, part))):
            if isinstance(gradient, Sparse):
                sums = square[gradient.rows, 0] + np.einsum("ij,ij->i", gradient.values, gradient.values) / gradient.values.shape[1]
                square[gradient.rows, 0] = sums
                gradient.values *= (RATE / (np.sqrt(sums) + 1e-6))[:, None]
                value[gradient.rows] -= gradient.values
                if met is not None:
                    met[number][gradient.rows] += gradient.met
            else:
                square += gradient**2
                value -= RATE * gradient / (np.sqrt(square) + 1e-6)


# Networks are added up in rows of so many numbers.
WIDTH = HIDDEN
SPARSE = (0,)


def _in_rows(value: np.ndarray, number: int) -> np.ndarray:
    """A parameter in rows of ``WIDTH``, filled up with zeros."""
    if number in SPARSE:
        return np.pad(value, ((0, 0), (0, WIDTH - value.shape[1])))
    return np.pad(value.ravel(), (0, -value.size % WIDTH)).reshape(-1, WIDTH)


def train(docs: DataFrame, ids_of_bins: Vocabulary, text: str = "text", rounds: int = 1) -> Params:
    """The average of the networks that the tasks have trained on all their documents; the driver holds one network."""
    params = fresh()
    columns = [f"x{column}" for column in range(WIDTH)]
    sizes = [len(_in_rows(value, number)) for number, value in enumerate(params)]
    starts = np.cumsum([0, *sizes]).tolist()
    for _ in range(rounds):
        start = params

        def run(batches: Iterator[pa.RecordBatch], start: Params = start) -> Iterator[pa.RecordBatch]:
            own = [value.copy() for value in start]
            squares = [np.zeros_like(value[:, :1] if number in SPARSE else value) for number, value in enumerate(own)]
            met = {number: np.zeros(len(own[number]), np.int64) for number in SPARSE if number < len(own)}
            words = 0
            for batch in _slices(batches):
                bins, rows = word_bins(batch.column(0))
                if len(bins):
                    ids = ids_of_bins[bins]
                    train_on(own, squares, windows(ids, rows), ids, met)
                    words += len(ids)
            for number, value in enumerate(own if words else []):
                rows = _in_rows(value, number)
                weights = met.get(number, np.full(len(rows), words))
                at = np.flatnonzero(weights)
                for low in range(0, len(at), BATCH):
                    part = at[low : low + BATCH]
                    arrays = [pa.array(starts[number] + part, pa.int32()), pa.array(weights[part], pa.int64())]
                    arrays += [pa.array(np.ascontiguousarray(column), pa.float32()) for column in rows[part].T]
                    yield pa.RecordBatch.from_arrays(arrays, ["i", "w", *columns])

        schema = ", ".join(["i int, w long", *(f"{column} float" for column in columns)])
        means = [(F.sum(F.col("w") * F.col(column).cast("double")) / F.sum("w")).cast("float").alias(column) for column in columns]
        sums = docs.select(text).mapInArrow(run, schema).groupBy("i").agg(*means).toArrow()
        if sums.num_rows:
            whole = np.concatenate([_in_rows(value, number) for number, value in enumerate(start)])
            whole[sums.column("i").to_numpy()] = np.stack([sums.column(column).to_numpy() for column in columns], axis=1)
            params = []
            for number, value in enumerate(start):
                rows = whole[starts[number] : starts[number + 1]]
                params.append(rows[:, : value.shape[1]].copy() if number in SPARSE else rows.ravel()[: value.size].reshape(value.shape))
    return params


def _distinct_words(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words with their rows: the place of one of each word of a row, and how often it is there."""
    order = np.lexsort((hashes, rows))
    starts = np.flatnonzero(np.r_[True, (np.diff(hashes[order]) != 0) | (np.diff(rows[order]) != 0)])
    return order[starts], np.diff(np.r_[starts, len(order)])


def score(docs: DataFrame, ids_of_bins: Vocabulary, params: Params, text: str = "text", counted: bool = False) -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``log_likelihood`` and its mean a word (null without words).

    Columns of these names are replaced. Words that the counts lack are looked for and spelled, unless the caller knows by
    ``counted`` that all documents are among those counted. A row is known by its place in its partition, so ``docs`` is a scan or a written
    table, which gives the same rows again when a task is repeated.
    """
    outs = ["n_words", "log_likelihood", "mean_log_likelihood"]
    names = [name for name in docs.columns if name != text and name not in outs]
    inner = [f"c{number}" for number in range(len(names))]
    parts = ["row", "hash", "times", "words", "known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each row one with the sum of its symbols, then one for each of its words in buckets."""
        number = TaskContext.get().partitionId() << 33
        for batch in _slices(batches):
            found = _words(batch.column(len(names)))
            bins, rows = found[:2]
            sums = np.zeros(batch.num_rows)
            ids = ids_of_bins[bins]
            if len(bins):
                around = windows(ids, rows)
                for low in range(0, len(ids), BATCH):
                    log_p = forward(params, around[:, low : low + BATCH], ids[low : low + BATCH]).log_p
                    sums += np.bincount(rows[low : low + BATCH], log_p, batch.num_rows)
            counts = np.bincount(rows, minlength=batch.num_rows)
            none = np.zeros(batch.num_rows)
            ends = number + np.arange(batch.num_rows)
            # Heads have hashes that spread them; what stands there is not looked at.
            heads = (ends.astype(np.uint64) * _FARTHER).view(np.int64)
            arrays = [pa.array(ends), pa.array(heads), pa.array(none, pa.int32()), pa.array(counts, pa.int64()), pa.array(sums)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], [*inner, *parts])
            others = np.flatnonzero(ids >= FREQUENT)
            for low in range(0, len(others), WORDS_AT_ONCE):
                part = others[low : low + WORDS_AT_ONCE]
                at, times = _distinct_words(bins[part], rows[part])
                here = part[at]
                empty = [pa.nulls(len(here), column.type) for column in batch.columns[:-1]]
                arrays = [
                    pa.array(number + rows[here]), pa.array(bins[here]), pa.array(times, pa.int32()),
                    pa.nulls(len(here), pa.int64()), pa.nulls(len(here), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays([*empty, *arrays], [*inner, *parts])
            number += batch.num_rows

    seen = docs.select(*(F.col(f"`{name}`").alias(one) for name, one in zip(names, inner)), F.col(text).alias("text"))
    schema = T.StructType([T.StructField(one, seen.schema[one].dataType) for one in inner])
    for name, kind in zip(parts, ("long", "long", "integer", "long", "double")):
        schema = schema.add(name, kind)
    counts = ids_of_bins.counts
    if not counted:
        new = written(word_counts(docs, text), "words-to-score").join(counts.select("hash"), "hash", "left_anti")
        counts = counts.unionByName(_spelled_words(new.withColumn("n", F.lit(0).cast("long")), ids_of_bins.spelling))
    counts = counts.select(F.col("hash").alias("__hash"), F.col("n").alias("__n"), "spelling")
    # A row for each bucket.
    shares = F.broadcast(docs.sparkSession.createDataFrame(
        [(number, float(total), float(kinds)) for number, (total, kinds) in enumerate(zip(ids_of_bins.totals, ids_of_bins.different))],
        "__bucket int, __total double, __different double",
    ))
    words = seen.mapInArrow(run, schema).join(counts, F.col("hash") == F.col("__hash"), "left")
    words = words.join(shares, F.shiftrightunsigned("hash", 64 - BUCKET_BITS) == F.col("__bucket"))
    # What the discounts free is the chance of any word of the bucket by its spelling.
    total = F.greatest("__total", F.lit(1.0))
    freed = F.lit(DISCOUNT) * F.greatest("__different", F.lit(1.0)) / total
    spelling = F.least(F.col("spelling") + F.lit(float(BUCKET_BITS * np.log(2))), F.lit(0.0))
    kept = (F.col("__n") - F.lit(DISCOUNT)) / total
    log_chance = F.when(F.col("__n") == 0, F.log(freed) + spelling).otherwise(F.log(kept + freed * F.exp(spelling)))
    value = F.when(F.col("times") > 0, F.col("times") * log_chance).otherwise(F.col("known"))
    firsts = [F.first(one, ignorenulls=True).alias(one) for one in inner]
    sums = words.groupBy("row").agg(F.sum(value).alias("log_likelihood"), F.max("words").alias("n_words"), *firsts)
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return sums.select(
        *(F.col(one).alias(name) for name, one in zip(names, inner)), "n_words", "log_likelihood", mean.alias("mean_log_likelihood")
    )

"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of consecutive words in which words one smallest period apart are identical, at least ``LEAST`` words and
three periods long, and which no neighbouring word extends. Take a run of period p and the level of 2^k <= p < 2^(k+1)
words (of 8 words, if p is less): the run's first aligned block of that length recurs one period on, within the run. So every
block of every level asks for its own occurrences in the windows of starts that follow it, up to two block lengths on. The
block's suffixes are one interval of the suffix array; a wavelet matrix over the array gives the successors of a start within
the interval. What a window holds is one arithmetic progression, so its first two and its last members tell all: up to two
members are candidate distances; of a longer progression the ends of the two periodic stretches around block and progression
give them. Candidates are extended to both sides by the ranks of all levels, and of equal stretches the least period is kept.

A document is handled whole, many short ones together; words of different documents never compare equal. Ranks take about
4 bytes a word and level, levels are at most log2 of the words of the longest document. Words are runs of anything but
ASCII white space. Null and empty texts have no runs and collapse to the empty text; rows are independent of each other,
so repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST = 24
PERIODS = 3
FIRST_LEVEL = 3
# Short documents are searched together up to so many words.
WORDS_AT_ONCE = 1 << 17


def refined(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of the first 1, 2, 4 ... words of every suffix, up to where all differ, and the suffix array.

    A rank is the number of suffixes with a smaller beginning, so equal beginnings are an interval of the array that starts
    at their rank. Only suffixes whose beginning is not unique yet are sorted at each level.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable").astype(np.int64)
    slots, values = np.arange(n), keys[order]
    rank, levels, width = np.empty(n, np.int64), [], 1
    while True:
        fresh = np.ones(len(slots), bool)
        fresh[1:] = values[1:] != values[:-1]
        first = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        rank[order[slots]] = first
        levels.append(rank.astype(np.int32))
        alone = fresh & np.append(fresh[1:], True)
        slots = slots[~alone]
        if not len(slots):
            return levels, order
        suffixes = order[slots]
        follow = np.zeros(len(slots), np.int64)
        inside = suffixes + width < n
        follow[inside] = rank[suffixes[inside] + width] + 1
        values = rank[suffixes] * (n + 1) + follow
        by_value = np.argsort(values, kind="stable")
        order[slots], values = suffixes[by_value], values[by_value]
        width *= 2


class Wavelets:
    """Order statistics of any interval of a sequence of whole numbers."""

    def __init__(self, values: np.ndarray, below: int) -> None:
        self.bits = max(1, int(below).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(low)]).astype(np.int32))
            values = np.concatenate([values[low], values[~low]])

    def less(self, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many values of each interval are smaller."""
        count = np.zeros(len(low), np.int64)
        for step, zeros in enumerate(self.zeros):
            low_zeros, high_zeros = zeros[low], zeros[high]
            one = (than >> (self.bits - 1 - step)) & 1 == 1
            count += np.where(one, high_zeros - low_zeros, 0)
            low = np.where(one, low - low_zeros + zeros[-1], low_zeros)
            high = np.where(one, high - high_zeros + zeros[-1], high_zeros)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The value at a place, from 0, of each interval's sorted values."""
        value = np.zeros(len(low), np.int64)
        for zeros in self.zeros:
            low_zeros, high_zeros = zeros[low], zeros[high]
            fewer = high_zeros - low_zeros
            one = place >= fewer
            value = value * 2 + one
            place = np.where(one, place - fewer, place)
            low = np.where(one, low - low_zeros + zeros[-1], low_zeros)
            high = np.where(one, high - high_zeros + zeros[-1], high_zeros)
        return value


@dataclass
class Words:
    """The words of some documents in a row, as numbers that differ between documents."""

    keys: np.ndarray
    levels: list[np.ndarray] = field(init=False)
    order: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.levels, self.order = refined(self.keys)

    def alike_from(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b on are the same."""
        return self._alike(a, b, 1)

    def alike_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words up to a and up to b, both left out, are the same."""
        return self._alike(a, b, -1)

    def _alike(self, a: np.ndarray, b: np.ndarray, side: int) -> np.ndarray:
        a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            width, ranks = 1 << level, self.levels[level]
            at, to = (a, b) if side > 0 else (a - width, b - width)
            inside = (at >= 0) & (to >= 0) & (at < len(ranks)) & (to < len(ranks))
            same = inside & (ranks[np.where(inside, at, 0)] == ranks[np.where(inside, to, 0)])
            step = np.where(same, width, 0)
            a, b, total = a + side * step, b + side * step, total + step
        return total

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """Blocks and the distances at which they may be repeated with that period; every run has one here."""
        n, none = len(self.keys), np.empty(0, np.int64)
        if n < LEAST or len(self.levels) <= FIRST_LEVEL:
            return none, none
        sizes = [np.bincount(ranks, minlength=n) for ranks in self.levels[FIRST_LEVEL:]]
        # Only suffixes whose first block occurs elsewhere can be met.
        shared = sizes[0][self.levels[FIRST_LEVEL][self.order]] > 1
        places = np.concatenate([[0], np.cumsum(shared)])
        if not places[-1]:
            return none, none
        wavelets = Wavelets(self.order[shared], n)
        blocks, distances = [none], [none]
        for size, (level, ranks) in zip(sizes, enumerate(self.levels[FIRST_LEVEL:], FIRST_LEVEL)):
            width = 1 << level
            block = np.arange(0, n - width + 1, width)
            block = block[size[ranks[block]] > 1]
            if not len(block):
                break
            low, high = places[ranks[block]], places[ranks[block] + size[ranks[block]]]
            if level == FIRST_LEVEL:
                # Below the block's length the nearest occurrence is the only candidate: the others are its multiples.
                after = wavelets.less(low, high, block + 1)
                has = after < high - low
                blocks.append(block[has])
                distances.append(wavelets.smallest(low[has], high[has], after[has]) - block[has])
            self._progressions(wavelets, block, low, high, width, blocks, distances)
        block, distance = np.concatenate(blocks), np.concatenate(distances)
        pairs = np.unique(block * (n + 1) + distance)
        return pairs // (n + 1), pairs % (n + 1)

    def _progressions(self, wavelets, block, low, high, width, blocks, distances) -> None:
        """Candidate distances from the occurrences that start one to two block lengths on."""
        n = len(self.keys)
        fewer = wavelets.less(low, high, np.minimum(block + width, n))
        count = wavelets.less(low, high, np.minimum(block + 2 * width, n)) - fewer
        for wanted in (0, 1):
            some = (count == 1 + wanted) | (count == 2)
            place = fewer[some] + np.minimum(wanted, count[some] - 1)
            blocks.append(block[some])
            distances.append(wavelets.smallest(low[some], high[some], place) - block[some])
        many = count > 2
        if not many.any():
            return
        own, low, high, fewer, count = block[many], low[many], high[many], fewer[many], count[many]
        first = wavelets.smallest(low, high, fewer)
        last = wavelets.smallest(low, high, fewer + count - 1)
        pace = wavelets.smallest(low, high, fewer + 1) - first
        # The stretches of this pace around the block and around the progression; the run shifts one onto the other.
        ends = self.alike_from(last, last + pace) + last - self.alike_from(own, own + pace) - own
        starts = first - self.alike_before(first, first + pace) - own + self.alike_before(own, own + pace)
        for distance in (ends, starts):
            fits = (distance >= width) & (distance < 2 * width)
            blocks.append(own[fits])
            distances.append(distance[fits])

    def runs(self) -> np.ndarray:
        """All runs as rows of start, length and period, in that order."""
        block, period = self.candidates()
        start = block - self.alike_before(block, block + period)
        length = block + self.alike_from(block, block + period) + period - start
        long_enough = length >= np.maximum(LEAST, PERIODS * period)
        found = np.unique(np.stack([start, length, period], axis=1)[long_enough], axis=0)
        if not len(found):
            return found
        fresh = np.ones(len(found), bool)
        fresh[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        found = found[fresh]
        return found[np.lexsort((found[:, 2], found[:, 0]))]


def searched(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each of some documents, given their words."""
    counts = np.array([len(words) for words in texts], np.int64)
    starts = np.cumsum(counts) - counts
    words = pa.array([word for words in texts for word in words], pa.binary()).dictionary_encode()
    numbers = words.indices.to_numpy().astype(np.int64)
    found = Words(np.repeat(np.arange(len(texts)), counts) * max(1, len(words.dictionary)) + numbers).runs()
    # Empty documents start where the next one does: the last of equal starts owns the words.
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    found[:, 0] -= starts[owner]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [found[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside runs and the first period of each run, joined by single spaces."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(compress(words, (np.cumsum(change)[:-1] == 0).tolist()))


RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (by start, then period) and ``collapsed`` in place of the text.

    Columns of these names are replaced.
    """
    new = ("n_words", "runs", "collapsed")
    kept = [name for name in docs.columns if name not in (text, *new)]
    seen = docs.select(*(F.col(f"`{name}`") for name in kept), F.col(text).alias("__text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def groups(texts: pa.Array) -> Iterator[list[list[bytes]]]:
        group, count = [], 0
        for value in texts:
            words = (value.as_py() or b"").split()
            if group and count + len(words) > WORDS_AT_ONCE:
                yield group
                group, count = [], 0
            group.append(words)
            count += len(words)
        if group:
            yield group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in groups(batch.column(len(kept)).cast(pa.binary())):
                found = searched(group)
                rows = np.concatenate(found)
                offsets = np.concatenate([[0], np.cumsum([len(runs) for runs in found])])
                fields = [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)]
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(kind.value_type))
                )
                texts = pa.array([collapsed(words, runs) for words, runs in zip(group, found)], pa.string())
                sizes = pa.array([len(words) for words in group], pa.int64())
                own = [column.slice(at, len(group)) for column in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*own, sizes, lists, texts], [*kept, *new])
                at += len(group)

    schema = seen.drop("__text").schema.add("n_words", "long").add("runs", RUNS).add("collapsed", "string")
    return seen.mapInArrow(run, schema)



def most_repeated(runs: Column) -> Column:
    """The run with the most repetitions, compared exactly; ties go to the smaller start, then period; null if there is none."""
    # Signs of cross products of whole numbers; runs come by start, then period.
    more = F.expr("CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>)")
    return F.aggregate(
        runs, more,
        lambda best, run: F.when(best.isNull() | (run.length * best.period > best.length * run.period), run).otherwise(best),
    )

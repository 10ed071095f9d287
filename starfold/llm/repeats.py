"""Removal of byte strings that occur more than once, with suffix arrays built block by block.

A string of ``length`` bytes is repeated if it also starts at any other place of any text, the same text included. Every
byte that a repeated string covers is removed; all is judged on the input.

1. Each string is assigned to an anchor, the window of half its length with the least hash in it, so equal strings have
   equal anchors at equal places. Consecutive strings share an anchor: one row per anchor holds the anchor's hash and a hash
   of its context, all bytes of all its strings. Nothing else of the texts is shuffled at this point.
2. Anchors that occur once are done. Contexts that occur twice are repeated throughout. What is left are anchors with
   contexts that occur once beside others, and one of each of their contexts is fetched from its text.
3. The contexts of an anchor are laid side by side, the anchor itself as one symbol, and their suffix array brings equal
   strings together. An anchor with very many contexts is dealt to several blocks, each with a suffix array of its own; of
   each block's different strings one digest goes on, and digests that meet from two blocks are repeats as well.

Texts are compared as UTF-8 bytes. Null is the empty text; texts shorter than ``length`` keep everything. Copies of a text
are repeats of each other, and are taken as one in all steps after the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm.recovery import written
from starfold.llm.suffixes import suffix_array

LENGTH = 200
# Contexts of one suffix array, on average, where an anchor has more.
BLOCK_CONTEXTS = 4096
STARTS_AT_ONCE = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_REPEATED, _WANTED = 1, 2
_SEPARATOR, _FIRST_ANCHOR = 256, 257

Span = tuple[int, int]
# Bytes of a text and its removed runs in order -> values of the result columns.
Finish = Callable[[bytes, list[Span]], tuple]


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(count, _BASE, np.uint64), np.full(count, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def _sliding_least(values: np.ndarray, window: int) -> np.ndarray:
    width = 1
    while 2 * width <= window:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = window - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors_of(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of the texts that lie end to end in ``data``, in stretches of bounded size.

    ``ends`` are the texts' limits, beginning with the first text's start. Yields for each anchor: hash, place, first and
    last start of its strings (all within ``data``), hash of the context.
    """
    window = length // 2
    bits = np.uint64((STARTS_AT_ONCE + length).bit_length())
    up, down = _powers(STARTS_AT_ONCE + length)
    for low in range(int(ends[0]), int(ends[-1]) - length + 1, STARTS_AT_ONCE):
        high = min(low + STARTS_AT_ONCE, int(ends[-1]) - length + 1)
        codes = data[low : high + length - 1].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[: len(codes)], out=sums[1:])
        hashes = _mixed((sums[window:] - sums[:-window]) * down[: len(codes) - window + 1])
        ranked = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
        owner = (_sliding_least(ranked, length - window + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        # Starts whose string ends within the same text.
        first, last = np.searchsorted(ends, low, "right") - 1, np.searchsorted(ends, high, "left")
        begin = np.maximum(ends[first:last] - low, 0)
        stop = np.minimum(ends[first + 1 : last + 1] - length + 1, high) - low
        full = stop > begin
        inside = np.zeros(high - low + 1, np.int8)
        inside[begin[full]] += 1
        np.subtract.at(inside, stop[full], 1)
        starts = np.flatnonzero(np.cumsum(inside[:-1]))
        if not len(starts):
            continue
        own = owner[starts]
        cut = np.flatnonzero((np.diff(own) != 0) | (np.diff(starts) != 1))
        a, b = starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]]
        at = own[np.r_[0, cut + 1]]
        context = (sums[b + length] - sums[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(_BASE)
        yield hashes[at], at + low, a + low, b + low, _mixed(context)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, end to end, and the texts' limits; nulls are empty."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), ends


def _anchor_rows(length: int):
    """A row per anchor and context of each stretch of text; ``more`` holds the places beside the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, ends = _texts(batch.column(2))
            for hashes, at, a, b, context in anchors_of(data, ends, length):
                text = np.searchsorted(ends, a, "right") - 1
                place = (at - ends[text] << 32) | (at - a << 16) | (b - a)
                order = np.lexsort((context, hashes))
                h, c, d, n, place = hashes[order], context[order], keys[text][order], sizes[text][order], place[order]
                first = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])]
                heads = np.flatnonzero(first)
                copies = np.diff(np.r_[heads, len(h)])
                others = pa.StructArray.from_arrays([pa.array(column[~first]) for column in (d, n, place)], ["d", "n", "at"])
                more = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(copies - 1)], pa.int32()), others, mask=pa.array(copies == 1))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(column[heads]) for column in (h.view(np.int64), d, n, place, c.view(np.int64))), pa.array(copies), more],
                    ["h", "d", "n", "at", "c", "copies", "more"],
                )

    return run


def _opened(at: int) -> tuple[int, int, int]:
    """Place of the anchor, first and last start."""
    anchor, first = at >> 32, (at >> 32) - (at >> 16 & 0xFFFF)
    return anchor, first, first + (at & 0xFFFF)


def merged(spans: list[Span]) -> list[Span]:
    """Maximal runs of what the spans cover, in order."""
    runs: list[Span] = []
    for low, high in sorted(spans):
        if runs and low <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(high, runs[-1][1]))
        else:
            runs.append((low, high))
    return runs


def kept(text: bytes, runs: list[Span]) -> bytes:
    """The text without the runs."""
    parts, at = [], 0
    for low, high in runs:
        parts.append(text[at:low])
        at = high
    return b"".join([*parts, text[at:]])


def _marks(column: pa.Array, row: int, names: tuple[str, ...]) -> zip:
    start, end = column.offsets[row].as_py(), column.offsets[row + 1].as_py()
    return zip(*(column.values.field(name)[start:end].to_pylist() for name in names))


def _mark_spans(column: pa.Array, row: int, length: int) -> list[Span]:
    return [
        (first, last + length)
        for at, kind in _marks(column, row, ("at", "kind")) if kind & _REPEATED
        for _, first, last in [_opened(at)]
    ]


def _first_pass(carried: int, outs: pa.Schema, finish: Finish, length: int):
    """Finishes the texts of which no context is wanted; of the others the text goes on, one copy of each to be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: set[tuple[int, int]] = set()
        for batch in batches:
            texts, keys, sizes, marks = (batch.column(carried + i) for i in range(4))
            results, waiting, reading = [], [], []
            for row in range(batch.num_rows):
                known = marks[row].is_valid
                wanted = known and any(kind & _WANTED for (kind,) in _marks(marks, row, ("kind",)))
                waiting.append(wanted)
                key = (keys[row].as_py(), sizes[row].as_py())
                reading.append(wanted and key not in read)
                if wanted:
                    read.add(key)
                    results.append((None,) * len(outs))
                else:
                    spans = _mark_spans(marks, row, length) if known else []
                    results.append(finish((texts[row].as_py() or "").encode(), merged(spans)))
            waits = pa.array(waiting, pa.bool_())
            nothing = pa.scalar(None)
            columns = [pa.array([result[i] for result in results], field.type) for i, field in enumerate(outs)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:carried], *columns, pa.compute.if_else(waits, texts, nothing.cast(texts.type)), keys, sizes,
                    pa.compute.if_else(waits, marks, nothing.cast(marks.type)), waits, pa.array(reading, pa.bool_()),
                ],
                [*batch.schema.names[:carried], *outs.names, "__text", "__d", "__n", "__marks", "__waits", "__reads"],
            )

    return run


def _context_rows(length: int):
    window = length // 2
    names = ["h", "block", "blocks", "d", "n", "at", "left", "right", "anchor"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in range(batch.num_rows):
                text, d, n = batch.column(0)[row].as_py().encode(), batch.column(1)[row].as_py(), batch.column(2)[row].as_py()
                for h, at, kind, block, blocks in _marks(batch.column(3), row, ("h", "at", "kind", "block", "blocks")):
                    if kind & _WANTED:
                        anchor, first, last = _opened(at)
                        middle = hashlib.blake2b(text[anchor : anchor + window], digest_size=16).digest()
                        rows.append((h, block, blocks, d, n, at, text[first:anchor], text[anchor + window : last + length], middle))
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names)

    return run


def equal_strings(contexts: list[tuple[int, bytes, bytes, bytes]], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """All strings of ``length`` bytes in the contexts of one anchor, equal ones together, as (context, offset) pairs.

    A context is the number of its strings, the bytes before and after the anchor, and what stands for the anchor.
    """
    symbols: list[int] = []
    where: list[tuple[int, int] | None] = []
    anchors: dict[bytes, int] = {}
    for number, (count, left, right, anchor) in enumerate(contexts):
        symbols += left
        symbols.append(anchors.setdefault(anchor, _FIRST_ANCHOR + len(anchors)))
        symbols += right
        symbols.append(_SEPARATOR)
        where += [(number, i) for i in range(count)]
        where += [None] * (len(symbols) - len(where))
    wide = length - length // 2 + 1
    text = "".join(map(chr, symbols))
    found: list[list[tuple[int, int]]] = []
    before = None
    for start in suffix_array(symbols):
        if where[start] is not None:
            string = text[start : start + wide]
            if string == before:
                found[-1].append(where[start])
            else:
                found.append([where[start]])
                before = string
    return found


def _block_rows(length: int):
    """Repeated spans of sorted contexts, and digests of the strings of anchors with several blocks."""
    wide = length - length // 2
    names = ["d", "n", "low", "high", "h", "digest"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def block(rows: list[tuple], h: int, blocks: int) -> Iterator[tuple]:
        contexts = []
        for _, _, at, left, right, anchor in rows:
            _, first, last = _opened(at)
            contexts.append((last - first + 1, left, right, anchor))
        repeated: list[list[int]] = [[] for _ in rows]
        for group in equal_strings(contexts, length):
            if len(group) > 1:
                for number, offset in group:
                    repeated[number].append(offset)
            if blocks > 1:
                number, offset = group[0]
                _, left, right, anchor = contexts[number]
                string = left[offset:] + anchor + right[: wide - len(left) + offset]
                digest = hashlib.blake2b(string, digest_size=16, salt=(len(left) - offset).to_bytes(4, "big")).digest()
                d, n, at = rows[number][:3] if len(group) == 1 else (None, None, None)
                low = None if at is None else _opened(at)[1] + offset
                yield d, n, low, None if low is None else low + length, h, digest
        for (d, n, at, *_), offsets in zip(rows, repeated):
            first = _opened(at)[1]
            for low, high in merged([(i, i + 1) for i in offsets]):
                yield d, n, first + low, first + high - 1 + length, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out = None, [], []
        for batch in batches:
            for h, number, blocks, *row in zip(*(column.to_pylist() for column in batch.columns)):
                if (h, number, blocks) != group:
                    if rows:
                        out.extend(block(rows, group[0], group[2]))
                    group, rows = (h, number, blocks), []
                # A text that was read twice has its contexts twice, one after the other.
                if not rows or rows[-1][:3] != tuple(row[:3]):
                    rows.append(tuple(row))
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], names)
                    out = []
        if rows:
            out.extend(block(rows, group[0], group[2]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], names)

    return run


def _final_pass(carried: int, outs: pa.Schema, finish: Finish, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks, more = (batch.column(carried + i) for i in range(3))
            results = []
            for row in range(batch.num_rows):
                spans = _mark_spans(marks, row, length)
                if more[row].is_valid:
                    spans += _marks(more, row, ("low", "high"))
                results.append(finish(texts[row].as_py().encode(), merged(spans)))
            columns = [pa.array([result[i] for result in results], field.type) for i, field in enumerate(outs)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:carried], *columns], [*batch.schema.names[:carried], *outs.names])

    return run


def without_repeats(
    docs: DataFrame, outs: T.StructType, finish: Finish, text: str = "text", length: int = LENGTH, block_contexts: int = BLOCK_CONTEXTS,
) -> DataFrame:
    """``docs`` without ``text``, with the columns ``outs`` that ``finish`` makes of each text and its removed runs."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [name for name in docs.columns if name != text and name not in outs.names]
    value = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(
        *(F.col(f"`{name}`") for name in names), value.alias("__text"),
        F.xxhash64(value).alias("__d"), F.octet_length(value).cast("long").alias("__n"),
    )
    arrow_outs = to_arrow_schema(outs)
    anchors = source.select("__d", "__n", "__text").filter(F.col("__n") >= length).mapInArrow(
        _anchor_rows(length), "h long, d long, n long, at long, c long, copies long, more array<struct<d: long, n: long, at: long>>"
    )
    seen = anchors.repartition("h").selectExpr(
        "*", "sum(copies) over (partition by h, c) as same", "row_number() over (partition by h, c order by d, n, at) as nth"
    ).selectExpr(
        "*", "sum(if(nth = 1, 1, 0)) over (partition by h) as contexts", "min(same) over (partition by h) as least_same"
    )
    wanted = "nth = 1 and contexts > 1 and least_same = 1"
    kind = f"if(same > 1, {_REPEATED}, 0) + if({wanted}, {_WANTED}, 0)"
    blocks = f"cast(ceil(contexts / {block_contexts}) as int)"
    own = f"struct(d, n, at, {kind} as kind)"
    places = f"transform(more, place -> struct(place.d as d, place.n as n, place.at as at, {_REPEATED} as kind))"
    # Copies of a text have the same places: sets hold them once.
    marks = seen.filter(f"same > 1 or {wanted}").selectExpr(
        "h", f"cast(pmod(c, {blocks}) as int) as block", f"{blocks} as blocks",
        f"explode(if(more is null, array({own}), concat(array({own}), {places}))) as place",
    ).groupBy(F.col("place.d").alias("__md"), F.col("place.n").alias("__mn")).agg(
        F.expr("collect_set(struct(h, place.at, place.kind, block, blocks))").alias("__marks")
    )
    joined = source.join(marks, (F.col("__d") == F.col("__md")) & (F.col("__n") == F.col("__mn")), "left")
    first_in = joined.select(*(f"`{name}`" for name in names), "__text", "__d", "__n", "__marks")
    first_out = T.StructType([*source.select(*(f"`{name}`" for name in names)).schema, *outs])
    kinds = first_in.schema
    whole = T.StructType(
        [*first_out, kinds["__text"], kinds["__d"], kinds["__n"], kinds["__marks"]]
        + [T.StructField("__waits", T.BooleanType()), T.StructField("__reads", T.BooleanType())]
    )
    nullable = T.StructType([T.StructField(field.name, field.dataType, True) for field in whole])
    partial = written(first_in.mapInArrow(_first_pass(len(names), arrow_outs, finish, length), nullable), "repeats-first")
    contexts = partial.filter("__reads").select("__text", "__d", "__n", "__marks").mapInArrow(
        _context_rows(length),
        "h long, block int, blocks int, d long, n long, at long, left binary, right binary, anchor binary",
    )
    # A suffix array costs far more than its bytes tell: partitions are not to be merged by their size.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = contexts.repartition(tasks, "h", "block").sortWithinPartitions("h", "block", "d", "n", "at")
    found = written(
        dealt.mapInArrow(_block_rows(length), "d long, n long, low long, high long, h long, digest binary"), "repeats-found"
    )
    met = found.filter("digest is not null").groupBy("h", "digest").agg(
        F.count("*").alias("blocks"), F.collect_list(F.when(F.col("d").isNotNull(), F.struct("d", "n", "low", "high"))).alias("places")
    )
    across = met.filter("blocks > 1").select(F.explode("places").alias("place")).select("place.*")
    spans = found.filter("digest is null").select("d", "n", "low", "high").unionByName(across)
    by_text = spans.groupBy(F.col("d").alias("__md"), F.col("n").alias("__mn")).agg(
        F.collect_list(F.struct("low", "high")).alias("__more")
    )
    waiting = partial.filter("__waits").join(by_text, (F.col("__d") == F.col("__md")) & (F.col("__n") == F.col("__mn")), "left")
    last = waiting.select(*(f"`{name}`" for name in names), "__text", "__marks", "__more").mapInArrow(
        _final_pass(len(names), arrow_outs, finish, length), T.StructType(nullable.fields[: len(first_out)])
    )
    done = partial.filter("not __waits").select(*(f"`{name}`" for name in first_out.names))
    return done.unionByName(last)


DIGESTS = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
    ]
)


def digests(text: bytes, runs: list[Span]) -> tuple[int, int, int, str]:
    """The columns of ``DIGESTS``."""
    return len(text), sum(high - low for low, high in runs), len(runs), hashlib.sha256(kept(text, runs)).hexdigest()


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeats taken out of ``text``; a character cut apart goes as a whole. Null becomes empty."""
    out = T.StructType([T.StructField(text, T.StringType())])
    finish = lambda value, runs: (kept(value, runs).decode("utf-8", "ignore"),)
    return without_repeats(docs, out, finish, text, length).select(*(f"`{name}`" for name in docs.columns))

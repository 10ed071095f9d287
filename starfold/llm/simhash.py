"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has a bit set where more than half the hashes of the text's word shingles have it. Two fingerprints that
differ in at most two bits agree in at least two of four blocks of 16 bits, so both meet under one of six keys of 32 bits.
Under a key that holds very many fingerprints the other 32 bits are split once more in the same way. What meets is
verified by its Hamming distance; of the links found under a key a spanning forest is kept, which connects the same
fingerprints. Equal fingerprints are one from the start.

That rule finds texts that hardly differ. For copies of a given similarity there are wide fingerprints of 256 bits over the
different shingles, of which fixed random choices of bits are the blocks, wider and more as there are more fingerprints. Of what meets under a block within the bits that
such copies differ in, three deviations added, a least spanning forest is kept; its links are candidates, and hold where the
whole shingle sets have the similarity (``near_copies``).

Null and empty texts, and those of white space, have fingerprint 0 and link like any other. A text of fewer words than a
shingle is one shingle. Null ids are fingerprinted and grouped, but name no component: one of null ids only has a null id.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.graph import components
from starfold.llm.recovery import written

BITS_APART = 2
SEED = 42
# Keys with more fingerprints than this are split by further bits.
CROWDED = 4096
STRETCH_BYTES = 1 << 19

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_PAIRS = list(combinations(range(4), 2))
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)

# Wide fingerprints and their blocks.
WIDE_BITS = 256
# A block is as wide as it takes for a key to hold at most so many unrelated fingerprints, and at least so many bits.
UNRELATED_AT_A_KEY = 8
LEAST_BLOCK_BITS = 20
# There are as many blocks as it takes for two copies to share one with this chance.
MEETING = 0.95
DRAWN_AT_ONCE = 1 << 16
BUCKET_AT_ONCE = 8192
_DRAWS = np.random.default_rng(SEED).integers(1, 1 << 63, WIDE_BITS // 64, dtype=np.uint64)


def _shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles, a stretch of the text at a time; the last words of one go on into the next."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    words: list[bytes] = []
    start, whole = 0, True
    while start < len(data):
        gap = _GAP.search(data, start + STRETCH_BYTES)
        end = gap.start() if gap else len(data)
        words += data[start:end].split()
        start = end
        if len(words) >= shingle:
            yield _hashes(words, shingle)
            words, whole = words[len(words) - shingle + 1 :], False
    if words and whole:
        yield _hashes(words, len(words))


def _hashes(words: list[bytes], shingle: int) -> np.ndarray:
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[low : high - 1], SEED) for low, high in zip(starts, ends[shingle - 1 :])], dtype="<u8")


def _majority(stretches: Iterator[np.ndarray], width: int) -> np.ndarray:
    """The bits set in over half of all rows of ``width`` bytes, packed."""
    set_bits, count = np.zeros(8 * width, np.int64), 0
    for rows in stretches:
        seen = np.bincount((rows + 256 * np.arange(width)).ravel(), minlength=256 * width)
        set_bits += (seen.reshape(width, 256) @ _BYTE_BITS).ravel()
        count += len(rows)
    return np.packbits(2 * set_bits > count, bitorder="little")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    rows = (hashes.view(np.uint8).reshape(-1, 8) for hashes in _shingle_hashes(text, shingle))
    return int(_majority(rows, 8).view("<u8")[0])


def wide_fingerprint(text: str | None, shingle: int = 5) -> bytes:
    """A fingerprint of 256 bits: each shingle's hash is drawn out by a fixed mixing."""

    def drawn(hashes: np.ndarray) -> np.ndarray:
        wide = (hashes[:, None] + _DRAWS) * np.uint64(0xD6E8FEB86659FD93)
        wide = (wide ^ (wide >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (wide ^ (wide >> np.uint64(29))).view(np.uint8).reshape(len(hashes), WIDE_BITS // 8)

    hashes = shingle_set(text, shingle)
    rows = (drawn(hashes[low : low + DRAWN_AT_ONCE]) for low in range(0, len(hashes), DRAWN_AT_ONCE))
    return _majority(rows, WIDE_BITS // 8).tobytes()


def shingle_set(text: str | None, shingle: int = 5) -> np.ndarray:
    """The hashes of a text's different shingles, in order."""
    return np.unique(np.concatenate([np.empty(0, "<u8"), *_shingle_hashes(text, shingle)]))


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fingerprint`` (a long of the same bits) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(value.as_py(), shingle) for value in batch.column(1)]
            prints = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], [key, "fingerprint"])

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, fingerprint long"
    return docs.select(key, text).mapInArrow(run, schema)


def _bits(value: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))


def _block_keys(value: Column) -> Column:
    """Six longs: two of the four 16-bit blocks each, with the pair's number above them."""
    return F.array(
        *(
            F.lit(place << 32).bitwiseOR(F.shiftleft(_bits(value, 16 * high, 16), 16)).bitwiseOR(_bits(value, 16 * low, 16))
            for place, (low, high) in enumerate(_PAIRS)
        )
    )


def _finer_keys(value: Column, key: Column) -> Column:
    """For each key six more: the two blocks outside the key, in four halves, by two of them."""
    place = F.shiftrightunsigned(key, 32)
    choices = F
    for number, pair in enumerate(_PAIRS):
        rest = [block for block in range(4) if block not in pair]
        halves = [_bits(value, 16 * block + 8 * half, 8) for block in rest for half in (0, 1)]
        finer = F.array(
            *(
                F.shiftleft(key, 19).bitwiseOR(F.lit((sub + 1) << 16)).bitwiseOR(F.shiftleft(halves[high], 8)).bitwiseOR(halves[low])
                for sub, (low, high) in enumerate(_PAIRS)
            )
        )
        choices = choices.when(place == number, finer)
    return choices


def forest(values: np.ndarray, apart: int = BITS_APART) -> list[tuple[int, int]]:
    """Places of a spanning forest of the links among ``values``: memory and output grow with their number only."""
    edges = []
    words = values.reshape(len(values), -1)
    waiting = np.arange(len(values))
    while len(waiting):
        front, waiting = [waiting[0]], waiting[1:]
        while front and len(waiting):
            here = front.pop()
            near = np.bitwise_count(words[waiting] ^ words[here]).sum(axis=1, dtype=np.int64) <= apart
            found = waiting[near]
            if len(found):
                edges += [(here, there) for there in found]
                front += found.tolist()
                waiting = waiting[~near]
    return edges


def least_forest(values: np.ndarray, apart: int) -> list[tuple[int, int]]:
    """Places of a spanning forest of least total distance: at every limit up to ``apart`` it connects what all links would."""
    words = values.reshape(len(values), -1)
    edges, here = [], 0
    waiting = np.arange(1, len(words))
    best, nearest = np.full(len(waiting), apart + 1), np.zeros(len(waiting), np.int64)
    while len(waiting):
        bits = np.bitwise_count(words[waiting] ^ words[here]).sum(axis=1, dtype=np.int64)
        closer = bits < best
        best[closer], nearest[closer] = bits[closer], here
        at = int(best.argmin())
        here = int(waiting[at])
        if best[at] <= apart:
            edges.append((int(nearest[at]), here))
        for column in (waiting, best, nearest):
            column[at] = column[-1]
        waiting, best, nearest = waiting[:-1], best[:-1], nearest[:-1]
    return edges


def _bucket_links(apart: int):
    """Links of sorted (bucket, fingerprint) rows; a bucket may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(keys)]
            many = ends - starts > 1
            left, right = [], []
            for start, end in zip(starts[many].tolist(), ends[many].tolist()):
                for one, other in forest(values[start:end], apart):
                    left.append(start + one)
                    right.append(start + other)
            a, b = values[np.array(left, np.int64)].view(np.int64), values[np.array(right, np.int64)].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        held = (np.empty(0, np.int64), np.empty(0, np.uint64))
        for batch in batches:
            keys, values = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            keys, values = np.r_[held[0], keys], np.r_[held[1], values.view(np.uint64)]
            if not len(keys):
                continue
            last = np.searchsorted(keys, keys[-1])
            if last:
                yield links(keys[:last], values[:last])
            held = (keys[last:], values[last:])
        if len(held[0]):
            yield links(*held)

    return run


def linked_fingerprints(distinct: DataFrame, apart: int = BITS_APART, crowded: int = CROWDED) -> DataFrame:
    """Edges ``a`` < ``b`` that connect what lies within ``apart`` (at most 2) bits, of a table of distinct ``fingerprint``."""
    if apart > BITS_APART:
        raise ValueError("four blocks find fingerprints at most two bits apart")
    keyed = distinct.select("fingerprint", F.explode(_block_keys(F.col("fingerprint"))).alias("key"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = keyed.join(counts, "key")
    own = F.array(F.shiftleft(F.col("key"), 19))
    buckets = shared.select(
        F.explode(F.when(F.col("n") > crowded, _finer_keys(F.col("fingerprint"), F.col("key"))).otherwise(own)).alias("bucket"),
        "fingerprint",
    )
    dealt = buckets.repartition("bucket").sortWithinPartitions("bucket", "fingerprint")
    return dealt.mapInArrow(_bucket_links(apart), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, apart: int = BITS_APART, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` and ``component_id``, the least key that links lead to, of every row."""
    prints = written(fingerprints(docs, shingle, key, text), "fingerprints")
    distinct = written(prints.groupBy("fingerprint").agg(F.min(key).alias("first")), "distinct-fingerprints")
    roots = components(linked_fingerprints(distinct.select("fingerprint"), apart))
    rooted = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fingerprint").alias("__print"), "component_id")
    return prints.join(named, F.col("fingerprint") == F.col("__print")).select(key, "fingerprint", "component_id")


def _differing(similarity: float) -> float:
    """The share of bits that differ on average between texts whose shingle sets have this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def bits_apart(similarity: float, bits: int = WIDE_BITS) -> int:
    """How many of ``bits`` differ between texts whose shingle sets have this Jaccard similarity: the mean and three deviations."""
    share = _differing(similarity)
    return round(bits * share + 3 * math.sqrt(bits * share * (1 - share)))


def wide_blocks(count: int, similarity: float) -> np.ndarray:
    """The bits of each block for ``count`` fingerprints: fixed random choices.

    Wider blocks keep a key's unrelated fingerprints few however many there are; the more of them make up for the
    narrower chance to agree in a block, at a number that grows far slower than ``count``.
    """
    width = max(LEAST_BLOCK_BITS, math.ceil(math.log2(max(1, count) / UNRELATED_AT_A_KEY)))
    blocks = math.ceil(math.log(1 - MEETING) / math.log(1 - (1 - _differing(similarity)) ** width))
    return np.stack([np.random.default_rng(SEED + block).choice(WIDE_BITS, width, replace=False) for block in range(blocks)])


def _wide_keys(choices: np.ndarray):
    """The keys of fingerprints, one block after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = 1 << np.arange(choices.shape[1])
        for batch in batches:
            for low in range(0, batch.num_rows, BUCKET_AT_ONCE):
                column = batch.column(0).slice(low, BUCKET_AT_ONCE)
                packed = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), WIDE_BITS // 8)
                bits = np.unpackbits(packed, axis=1, bitorder="little")
                for block, choice in enumerate(choices):
                    keys = (bits[:, choice] @ values) | block << choices.shape[1]
                    yield pa.RecordBatch.from_arrays([pa.array(keys), column], ["key", "fingerprint"])

    return run


def _wide_links(apart: int):
    """Links of sorted (key, cell, fingerprint) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(prints: list[bytes]) -> list[tuple[bytes, bytes]]:
            values = np.frombuffer(b"".join(prints), np.uint64).reshape(len(prints), -1)
            return [(prints[a], prints[b]) for a, b in least_forest(values, apart)]

        bucket, prints, out = None, [], []
        for batch in batches:
            for key, cell, value in zip(*(column.to_pylist() for column in batch.columns)):
                if (key, cell) != bucket:
                    if len(prints) > 1:
                        out += links(prints)
                    bucket, prints = (key, cell), []
                prints.append(value)
            if out:
                yield _wide_edges(out)
                out = []
        if len(prints) > 1:
            out += links(prints)
        if out:
            yield _wide_edges(out)

    return run


def wide_links(distinct: DataFrame, choices: np.ndarray, apart: int) -> DataFrame:
    """Edges ``a`` < ``b`` that connect what meets under a key within ``apart`` bits, of a table of distinct wide ``fingerprint``.

    The few keys of very many fingerprints are a table of their own, which Spark joins as its size allows. Such a key is
    dealt into parts of about half of ``BUCKET_AT_ONCE``, and each two parts meet in a cell, so that all its pairs meet and no
    cell holds many more.
    """
    rows = BUCKET_AT_ONCE
    keyed = distinct.select("fingerprint").mapInArrow(_wide_keys(choices), "key long, fingerprint binary")
    crowded = written(
        keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > rows)
        .select(F.col("key").alias("crowded"), F.ceil(F.col("n") * 2 / rows).alias("parts")),
        "crowded-keys",
    )
    part = F.expr("pmod(xxhash64(fingerprint), parts)").alias("part")
    cells = "transform(sequence(0L, parts - 1), other -> least(part, other) * parts + greatest(part, other))"
    placed = keyed.join(crowded, F.col("key") == F.col("crowded"), "left").select("key", "fingerprint", "parts", part)
    cell = F.explode(F.expr(f"if(parts is null, array(0L), {cells})")).alias("cell")
    dealt = placed.select("key", cell, "fingerprint").repartition("key", "cell").sortWithinPartitions("key", "cell", "fingerprint")
    return dealt.mapInArrow(_wide_links(apart), "a binary, b binary")


def _wide_edges(edges: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    pairs = [(min(pair), max(pair)) for pair in edges]
    return pa.RecordBatch.from_arrays([pa.array(side, pa.binary()) for side in zip(*pairs)], ["a", "b"])


def verified(edges: DataFrame, named: DataFrame, docs: DataFrame, shingle: int, similarity: float, key: str, text: str) -> DataFrame:
    """The ``edges`` between fingerprints whose whole texts have shingle sets of this Jaccard similarity or more.

    ``named`` has a document's key and text hash for each fingerprint. Only texts on edges are read for their shingles; sets too
    unlike in size are not compared, so what is shuffled grows with the edges and the texts on them.
    """
    ends = edges.select(F.col("a").alias("fingerprint")).union(edges.select("b")).distinct()
    wanted = named.join(ends, "fingerprint").select("fingerprint", F.col(f"least.{key}").alias("__key"), F.col("least.hash").alias("__hash"))
    same = F.col(key).eqNullSafe(F.col("__key")) & (_text_hash(text) == F.col("__hash"))
    texts = docs.select(key, text).join(wanted, same).select(F.col("fingerprint").alias("__print"), text).dropDuplicates(["__print"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                hashes = shingle_set(batch.column(1)[row].as_py(), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), pa.array([hashes], pa.list_(pa.int64()))], ["print", "shingles"])

    sets = written(texts.mapInArrow(run, "print binary, shingles array<long>"), "shingle-sets")
    one, other = (sets.select(F.col("print").alias(f"{side}_print"), F.col("shingles").alias(f"{side}_set")) for side in "ab")
    pairs = edges.join(one, F.col("a") == F.col("a_print")).join(other, F.col("b") == F.col("b_print"))
    few, many = F.least(F.size("a_set"), F.size("b_set")), F.greatest(F.size("a_set"), F.size("b_set"))
    both = F.size(F.array_intersect("a_set", "b_set"))
    near = F.when(few >= many * F.lit(similarity) - 1e-9, both >= (few + many - both) * F.lit(similarity) - 1e-9)
    return pairs.filter(near).select("a", "b")


def _text_hash(text: str):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: the least key, then the least hash of the text.

    Copies are texts whose sets of shingles have this Jaccard similarity or more; each link is verified on whole texts, and
    links connect. Candidates meet under blocks of wide fingerprints: by the binomial model two texts share one with a chance of
    0.95 at the similarity and more above, however many texts there are. Equal fingerprints are one from the start. Null and empty texts are copies of each
    other. Every row goes through; a null key is the least of all. Rows that are equal in key and text count as copies.
    """
    hashed = _text_hash(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([wide_fingerprint(value.as_py(), shingle) for value in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], found], [key, "hash", "fingerprint"])

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, hash long, fingerprint binary"
    prints = written(docs.select(key, hashed.alias("hash"), text).mapInArrow(run, schema), "wide-fingerprints")
    least = F.min(F.struct(key, "hash")).alias("least")
    distinct = written(prints.groupBy("fingerprint").agg(least), "distinct-wide-fingerprints")
    choices = wide_blocks(distinct.count(), similarity)
    links = written(wide_links(distinct, choices, bits_apart(similarity)).distinct(), "candidate-links")
    roots = components(verified(links, distinct, docs, shingle, similarity, key, text))
    rooted = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        F.coalesce("root", "fingerprint").alias("root"), "least"
    )
    chosen = rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col(f"least.{key}").alias("__key"), F.col("least.hash").alias("__hash"))
    rows = prints.groupBy(key, "hash").agg(F.count("*").alias("rows"))
    keepers = written(
        chosen.join(rows, F.col("__key").eqNullSafe(F.col(key)) & (F.col("__hash") == F.col("hash"))).select("__key", "__hash", "rows"),
        "near-copy-keepers",
    )
    same = F.col(key).eqNullSafe(F.col("__key")) & (hashed == F.col("__hash"))
    once = docs.join(keepers.filter("rows = 1"), same, "left_semi")
    again = docs.join(keepers.filter("rows > 1"), same, "left_semi").dropDuplicates([key, text])
    return once.unionByName(again)

"""One query per operator over the driver's tables, with SQL twins where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import (
    bpe, collision, dialogue, htmltext, langid, mixing, periodic, pseudo, quality, repeats, sharding, simhash, topk,
)
from starfold.llm.registry import QUERIES, SQL, query
from starfold.queries.feed import table

__all__ = ["QUERIES", "SQL"]

SHARDS = 8
RANKS = "byte_bpe_multi_50k.tiktoken"


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count, ids and decoded bytes of every document."""
    docs = table(spark, sf_dir, "documents")
    return bpe.token_digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query
def op7_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 7 by document id, and the shard of each document once there is a ninth."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = sharding.hash_tree_shards(rows, sharding.even_tree(SHARDS))
    placed = sharding.hash_tree_shards(placed, sharding.even_tree(SHARDS + 1), out="grown_shard")
    slots = sharding.numbered(placed, "shard", ["doc_id", "size", "text_crc32", "grown_shard"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


MIX_SQL = r"""
    with sized as (
        select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
               md5(coalesce(doc_id::varchar, '')) as digest
        from documents),
    totals as (select source, sum(size)::bigint as source_size from sized group by source),
    weighed as (
        select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight, 3 * source_size as most,
               sum(source_size) over () as words
        from totals),
    filling as (select *, most::double / weight as fills_at from weighed),
    shares as (
        select *, (words - coalesce(sum(most) over (order by fills_at, source nulls first
                       rows between unbounded preceding and 1 preceding), 0))::double
                  / sum(weight) over (order by fills_at desc, source desc nulls last) as share
        from filling),
    levels as (select *, max(case when share <= fills_at then share end) over () as level from shares),
    targets as (
        select source, source_size, case when fills_at <= level then most::double else level * weight end as target
        from levels),
    placed as (
        select s.*, t.source_size, t.target,
               sum(size) over (partition by s.source order by digest, doc_id nulls first, size
                               rows between unbounded preceding and current row) - size as before
        from sized s join targets t on s.source is not distinct from t.source),
    cut as (
        select *, case when source_size > 0 then floor(target)::bigint // source_size else 0 end as epochs from placed)
    select doc_id, size, source_size, target,
           (epochs * size
            + least(greatest(floor(target)::bigint - epochs * source_size - before, 0), size))::bigint as taken
    from cut
"""


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources by weight takes of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


query(op8_mix_sources, MIX_SQL)


def held_out() -> Column:
    """A third of the documents, by id, from which no language is learned."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


@query
def op4_output_code_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~held_out()))
    found = langid.identify(docs.select("doc_id", "text", held_out().alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query
def op5_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About the 20 nearest of every twentieth vector, by inner product."""
    return collision.nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


TOP_SQL = """
    with whole as (
        select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
        where embedding is not null and vec_id is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (
        select q.vec_id as query_id, c.vec_id,
               coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::bigint as score
        from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 20 = 0)
    select query_id, rank::int as rank, vec_id, score from (
        select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
    where rank <= 20
"""


def op6_exact_top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best scores of every twentieth vector, exactly."""
    return topk.top_scores(table(spark, sf_dir, "embeddings"), "id % 20 = 0", scale=64)


query(op6_exact_top_scores, TOP_SQL)


@query
def op9_tree_scored_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = htmltext.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


# Every string of every text by its digest; hexadecimal text, so that bytes are pairs of characters.
REPEATS_SQL = """
    with hexed as (
        select row_number() over () as row_id, doc_id, lower(hex(encode(coalesce(text, '')))) as bytes from documents),
    starts as (
        select row_id, unnest(range(0, octet_length(unhex(bytes)) - 199)) as start, bytes from hexed
        where octet_length(unhex(bytes)) >= 200),
    strings as (select row_id, start, md5(substr(bytes, 2 * start::bigint + 1, 400)) as string from starts),
    repeated as (select row_id, start from strings qualify count(*) over (partition by string) > 1),
    gaps as (
        select *, lag(start) over (partition by row_id order by start) as previous from repeated),
    islands as (
        select *, sum(case when previous is null or start > previous + 200 then 1 else 0 end)
                      over (partition by row_id order by start) as island
        from gaps),
    spans as (
        select row_id, island, min(start) as low, max(start) + 200 as high from islands group by row_id, island),
    pieces as (
        select row_id, low, high, lag(high, 1, 0) over (partition by row_id order by low) as after from spans),
    kept as (
        select row_id, count(*) as n_spans, sum(high - low) as n_removed, max(high) as last,
               string_agg(substr(any_bytes, 2 * after::bigint + 1, 2 * (low - after)::bigint), '' order by low) as bytes
        from (select p.*, h.bytes as any_bytes from pieces p join hexed h using (row_id)) group by row_id)
    select h.doc_id, (length(h.bytes) // 2)::bigint as n_bytes, coalesce(k.n_removed, 0)::bigint as n_removed,
           coalesce(k.n_spans, 0)::bigint as n_spans,
           sha256(unhex(case when k.row_id is null then h.bytes
                             else k.bytes || substr(h.bytes, 2 * k.last::bigint + 1) end)) as kept_sha256
    from hexed h left join kept k using (row_id)
"""


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 200-byte strings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.without_repeats(docs, repeats.DIGESTS, repeats.digests)


query(op1_suffix_array_dedup, REPEATS_SQL)


@query
def op10_masked_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pseudo-likelihood of every document under a network trained on all of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids_of_bins = pseudo.vocabulary(docs)
    return pseudo.score(docs, ids_of_bins, pseudo.train(docs, ids_of_bins), counted=True)


@query
def op11_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How likely every document is of good quality, learned from the labels of documents that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = quality.fit(docs, labels.filter(~held_out()), "quality")
    scored = quality.score(docs.select("doc_id", "text", held_out().alias("held_out")), weights)
    return scored.select("doc_id", "held_out", "score", "predicted")


# CRC-32 of an ASCII text, bit by bit.
CRC_SQL = """
    xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(range(1, length({text}) + 1),
        lambda i: list_transform(range(0, 8), lambda j: (ord(substr({text}, i::bigint, 1)) >> j::int) & 1)))),
        lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1))), 4294967295)
"""

RUNS_SQL = f"""
    with given as (
        select row_number() over () as row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
               {CRC_SQL.format(text="doc_id::varchar")} as h
        from documents),
    placed as (
        select *, len(words) as n, case when len(words) > 0 then (h // 10) % len(words) end as a from given),
    planted as (
        select *, case when h % 10 = 0 and n > 0 then 1 + (n - a) // (3 + (h // 10) % 8) end as p from placed),
    docs as (
        select row_id, doc_id, n, case when p is null then words else list_transform(range(0, n),
            lambda i: words[1 + case when i < a then i else a + (i - a) % p end]) end as words
        from planted),
    places as (select row_id, n, unnest(words) as word, generate_subscripts(words, 1) - 1 as i from docs),
    pairs as (
        select x.row_id, x.i, y.i - x.i as period from places x join places y
        on x.row_id = y.row_id and x.word = y.word and y.i > x.i and 3 * (y.i - x.i) <= x.n),
    stretches as (
        select row_id, period, min(i) as start, count(*) + period as length
        from (select *, i - row_number() over (partition by row_id, period order by i) as island from pairs)
        group by row_id, period, island having count(*) + period >= greatest(24, 3 * period)),
    runs as (select row_id, start, length, min(period) as period from stretches group by row_id, start, length),
    best as (
        select * from runs qualify row_number() over (
            partition by row_id order by length::decimal(38, 20) / period desc, start, period) = 1),
    listed as (
        select row_id, count(*) as n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period) as lines
        from runs group by row_id),
    dropped as (select distinct row_id, unnest(range(start + period, start + length)) as i from runs),
    kept as (
        select row_id, string_agg(word, ' ' order by i) as text from places anti join dropped using (row_id, i) group by row_id)
    select doc_id, coalesce(n_runs, 0)::bigint as n_runs, start::bigint as start, length::bigint as length,
           period::bigint as period, (1000 * length // period)::bigint as exponent_milli,
           sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(kept.text, '')) as collapsed_sha256
    from docs left join listed using (row_id) left join best using (row_id) left join kept using (row_id)
"""


def planted(text: Column, key: Column) -> Column:
    """Texts with a period planted in a tenth of them, by id; rows without id stay as they are."""
    spaces = F.lit(" \t\n\x0b\x0c\r")
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")

    # As a lambda's argument the text is split once.
    words = F.split(F.rtrim(F.ltrim(text, spaces), spaces), r"[\x20\x09-\x0D]+")
    made = F.get(F.transform(F.array(words), repeated), F.lit(0))
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), made).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, after periods were planted in some."""
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic.find_runs(docs).withColumn("best", periodic.most_repeated(F.col("runs")))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


query(op12_periodic_runs, RUNS_SQL)


DAMAGE_SQL = f"""
    with recursive given as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               {CRC_SQL.format(text="concat(coalesce(conv_id::varchar, ' '), ':', coalesce(turn::varchar, ' '))")} % 20 as harm
        from conversations),
    damaged as (
        select conv_id, turn, case when harm = 4 then 'user' else role end as role,
               case harm when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
        from given, range(case harm when 0 then 0 when 3 then 2 else 1 end)),
    ordered as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as i,
               right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as mark
        from damaged),
    turns as (
        select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again, left(role, 1) as initial, case when mark = '' then 1 when again then 2 when mark in ('.', '!', '?') then 0 else 3 end as fault,
               concat(lag(left(role, 1)) over (partition by conv_id order by i), left(role, 1)) not in ('su', 'ua', 'au') as clash
        from ordered),
    counted as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
               count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate,
               count(*) filter (fault = 3) as truncated, count(*) filter (clash and i > 1) as illegal, max(i) as n
        from turns group by conv_id),
    -- What the roles so far are: 0 nothing, 1 a system turn, 2 up to a user turn, 3 up to an assistant turn.
    inserted(state, goes, cost, letters, lines) as (values
        (0, 0, 0, '', ''), (0, 2, 3, 'I', 'user:|'), (0, 3, 6, 'II', 'user:|assistant:|'),
        (1, 1, 0, '', ''), (1, 2, 3, 'I', 'user:|'), (1, 3, 6, 'II', 'user:|assistant:|'),
        (2, 2, 0, '', ''), (2, 3, 3, 'I', 'assistant:|'), (2, 2, 6, 'II', 'assistant:|user:|'),
        (3, 3, 0, '', ''), (3, 2, 3, 'I', 'user:|'), (3, 3, 6, 'II', 'user:|assistant:|')),
    edits(state, goes, letter, cost, initial) as (values
        (0, 0, 'D', 4, null), (1, 1, 'D', 4, null), (2, 2, 'D', 4, null), (3, 3, 'D', 4, null),
        (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a'), (3, 2, 'K', 0, 'u'),
        (0, 2, 'R', 3, null), (1, 2, 'R', 3, null), (2, 3, 'R', 3, null), (3, 2, 'R', 3, null)),
    ways as (
        select conv_id, 0::bigint as i, 0 as state, 0::bigint as cost, '' as audit, '' as lines from counted
        union all
        select * exclude (place) from (
            select w.conv_id, t.i, e.goes as state, w.cost + v.cost + e.cost + case when t.fault = 3 and e.letter <> 'D' then 3 else 0 end as cost,
                   w.audit || v.letters || e.letter as audit,
                   w.lines || replace(v.lines, '|', chr(10)) || case e.letter when 'D' then ''
                       when 'K' then concat(t.role, ':', t.text, chr(10))
                       else concat(case e.goes when 2 then 'user' else 'assistant' end, ':', t.text, chr(10)) end as lines,
                   row_number() over (partition by w.conv_id, e.goes
                       order by w.cost + v.cost + e.cost + case when t.fault = 3 and e.letter <> 'D' then 3 else 0 end,
                                w.audit || v.letters || e.letter) as place
            from ways w join turns t on t.conv_id is not distinct from w.conv_id and t.i = w.i + 1
            join inserted v on v.state = w.state join edits e on e.state = v.goes
            where (e.letter = 'D' or t.fault not in (1, 2)) and (e.letter <> 'K' or e.initial = t.initial)
        ) where place = 1),
    ended as (
        select w.conv_id, w.cost + v.cost as cost, w.audit || v.letters as audit, w.lines || replace(v.lines, '|', chr(10)) as lines
        from ways w join counted c on w.conv_id is not distinct from c.conv_id and w.i = c.n
        join inserted v on v.state = w.state where v.goes in (0, 3)
        qualify row_number() over (partition by w.conv_id order by w.cost + v.cost, w.audit || v.letters) = 1)
    select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
           coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
           coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
           sha256(coalesce(case when lines <> '' then left(lines, length(lines) - 1) end, '')) as repaired_sha256
    from (select distinct conv_id from conversations) o
    left join counted c on o.conv_id is not distinct from c.conv_id left join ended e on o.conv_id is not distinct from e.conv_id
"""


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults planted by conversation and turn."""
    given = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")]
    harm = F.crc32(F.concat(given[0], F.lit(":"), given[1]).cast("binary")) % 20
    role, text = given[2:]
    marks = F.regexp_replace(text, "[.!?]", "")
    text = F.when(harm == 1, "").when(harm == 2, marks).otherwise(text)
    copies = F.when(harm == 0, F.array()).when(harm == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", F.when(harm == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every conversation after planted damage."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns, decisions = dialogue.repair(damaged(rows))
    digests = dialogue.repaired_as(turns, decisions, dialogue.digest_row, dialogue.DIGEST).withColumnRenamed("conv_id", "__id")
    found = decisions.join(digests, F.col("__conv").eqNullSafe(F.col("__id")))
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    numbers = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in dialogue.SUMMARY]
    empty = F.sha2(F.lit(""), 256)
    return every.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256")
    )


query(op13_conversation_repair, DAMAGE_SQL)

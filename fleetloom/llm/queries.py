"""Registered queries of the text operators: name → (Spark function, SQL twin or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.llm import (
    collocations, decontaminate, jaccard, kneser_ney, packing, pitman_yor, quality_rules, secret_scan, sharding, spelling, substring,
    token_counts, wrapper,
)
from fleetloom.llm.common import documents, written
from fleetloom.llm.tokens import vocabulary

N_SHARDS = 8


def op1_histogram_shards(spark: SparkSession, root: str) -> DataFrame:
    text = F.col("text")
    rows = written(documents(spark, root, "doc_id", "text").select(
        "doc_id", sharding.utf8_size(text).alias("size"), F.crc32(text).alias("text_crc32"),
        sharding.spread_key(text, F.col("doc_id")).alias("place"),
    ))
    sharded = sharding.shard(rows, N_SHARDS, F.col("place"), F.col("size"), ("doc_id", "size", "text_crc32"))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, root, "doc_id", "text", "source"), ("doc_id",), path="source")
    return found.select(
        "doc_id", "n_at", F.sha2("value", 256).alias("value_sha256"), F.col("length").cast("long").alias("length"),
        F.round("score", 6).alias("score"), "is_secret",
    )


def op3_kneser_ney_quality(spark: SparkSession, root: str) -> DataFrame:
    labels = spark.read.parquet(f"{root}/labels.parquet").select("doc_id", "quality")
    return kneser_ney.score(documents(spark, root, "doc_id", "lang", "text"), labels)


def op4_qgram_decontamination(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.matches(documents(spark, root, "doc_id", "text"), benchmark(spark, root))


def benchmark(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/benchmark.parquet").select("item_id", "text")


def op5_parity_sketch_join(spark: SparkSession, root: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, root, "doc_id", "text"), n=3, percent=90)


def op6_de_bruijn_dedup(spark: SparkSession, root: str) -> DataFrame:
    return substring.dedup(documents(spark, root, "doc_id", "text"))


def op7_tiered_packing(spark: SparkSession, root: str) -> DataFrame:
    return packed(documents(spark, root, "doc_id", "text"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=1, keys=("doc_id",))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context", "step_group",
    )


def op8_token_counts(spark: SparkSession, root: str) -> DataFrame:
    docs = documents(spark, root, "doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary("byte_bpe_50k.json"), limit=1024)


def op9_wrapper_induction(spark: SparkSession, root: str) -> DataFrame:
    pages = spark.read.parquet(f"{root}/pages.parquet").select("page_id", "url", "html")
    return wrapper.main_text(pages, ("page_id", "url"))


def op10_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, root, "doc_id", "text", "lang"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op11_prefix_free_collocations(spark: SparkSession, root: str) -> DataFrame:
    return collocations.collocations(documents(spark, root, "lang", "text"))


def op12_pitman_yor_scores(spark: SparkSession, root: str) -> DataFrame:
    return pitman_yor.score(documents(spark, root, "doc_id", "text"))


def op13_q_chunk_spelling(spark: SparkSession, root: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(documents(spark, root, "doc_id", "text")))


# The measures and bounds written out once more, independent of the rule table.
_STOP_SQL = """('the','of','and','to','in','is','that','it','was','for','on','with','as','are','be','this','by',
 'from','at','or','an','der','die','das','und','den','von','mit','ist','des','im','dem','nicht','ein','eine','als',
 'auch','sich','auf','für','le','la','les','et','de','du','un','une','est','que','qui','dans','pour','par','sur',
 'pas','au','avec','el','los','las','y','en','del','se','por','con','no','una','su','para','es','lo','como','más')"""

OP10_SQL = rf"""
with t as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text,
    coalesce(split_part(replace(lower(lang), '_', '-'), '-', 1) in ('en', 'de', 'fr', 'es'), false) as listed
  from documents
), w as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws,
         [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as ls
  from t
), windows as (
  select rid, i, array_to_string(ws[i:i + 7], ' ') as win
  from (select rid, ws, unnest(range(1, len(ws) - 6)) as i from w where len(ws) >= 8)
), repeated as (
  select rid, i from (select rid, i, count(*) over (partition by rid, win) as c from windows) where c > 1
), covered as (
  select rid, cast(sum(least(8, coalesce(nxt - i, 8))) as bigint) as n
  from (select rid, i, lead(i) over (partition by rid order by i) as nxt from repeated) group by rid
), m as (
  select doc_id, listed, cast(len(ws) as bigint) as n_words,
    cast(length(array_to_string(ws, '')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(ls) as bigint) as n_lines,
    cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
    coalesce(covered.n, 0) as n_repeat_words,
    len([x for x in ws if x in {_STOP_SQL}
      or (x = upper(left(x, 1)) || lower(substr(x, 2)) and lower(x) in {_STOP_SQL})]) as n_stop
  from w left join covered using (rid)
), b as (
  select *, (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (not base_failed and (not listed or word_chars >= 2.0 * n_words and word_chars <= 14.0 * n_words)
   and 4 * n_symbols <= n_words and (not listed or n_words < 50 or n_stop >= 0.04 * n_words)
   and n_dup_lines <= 0.6 * n_lines) as kept
from b
"""

OP5_SQL = r"""
with recursive w as (
  select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents
), s as (
  select distinct rid, array_to_string(ws[i:i + 2], ' ') as g
  from (select rid, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) as i from w where len(ws) > 0)
), n as (select rid, count(*) as c from s group by rid),
pairs as (
  select a.rid as a, b.rid as b, count(*) as shared
  from s a join s b on a.g = b.g and a.rid < b.rid group by 1, 2
), edges as (
  select a, b from pairs join n x on x.rid = a join n y on y.rid = b
  where 100 * shared >= 90 * (x.c + y.c - shared)
), ways as (select a, b from edges union all select b, a from edges),
reach as (
  select rid as a, rid as b from w
  union
  select reach.a, ways.b from reach join ways on reach.b = ways.a
), smallest as (
  select reach.a as rid, min(w.doc_id) as component_id from reach join w on w.rid = reach.b group by 1
)
select doc_id, coalesce(n.c, 0) as n_shingles, component_id
from w left join n using (rid) join smallest using (rid)
"""

OP6_SQL = r"""
with w as (
  select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents
), windows as (
  select rid, doc_id, i, array_to_string(ws[i:i + 12], ' ') as win
  from (select rid, doc_id, ws, unnest(range(1, len(ws) - 11)) as i from w where len(ws) >= 13)
), hits as (
  select rid, i from (select rid, doc_id, i, min(doc_id) over (partition by win) as first_id from windows)
  where first_id < doc_id
), gone as (select distinct rid, unnest(range(i, i + 13)) as at from hits),
words as (select rid, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as at from w),
kept as (
  select words.rid, string_agg(word, ' ' order by words.at) as body, count(*) as n
  from words left join gone on gone.rid = words.rid and gone.at = words.at
  where gone.at is null group by 1
)
select doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(kept.n, 0) as bigint) as n_removed,
  sha256(coalesce(body, '')) as kept_sha256
from w left join kept using (rid)
"""

OP11_SQL = r"""
with p as (
  select coalesce(lang, 'und') as lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws
  from (select lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents)
), g as (
  select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase
  from (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from p, (values (1), (2), (3)) as sizes(k))
), f as (select lang, k, phrase, count(*) as f from g group by 1, 2, 3),
n as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by 1),
c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as ws from f where k > 1 and f >= 10),
cut as (
  select lang, k, phrase, a, j, array_to_string(ws[1:j], ' ') as head, array_to_string(ws[j + 1:], ' ') as rest
  from (select *, unnest(range(1, k)) as j from c)
), s as (
  select cut.lang, cut.phrase, a, j, h.f as l, r.f as r,
    (1000000::hugeint * a * a) // (h.f::hugeint * r.f) as score
  from cut join f h on h.lang = cut.lang and h.phrase = head and h.k = j
  join f r on r.lang = cut.lang and r.phrase = rest and r.k = cut.k - j
), best as (
  select * from s qualify row_number() over (partition by lang, phrase order by score, j) = 1
), longer as (
  select lang, part, max(a) as a from (
    select lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) as part from c where k = 3
  ) group by 1, 2
), ranked as (
  select best.*, row_number() over (partition by best.lang order by score desc, best.a desc, encode(phrase)) as rank
  from best left join longer on longer.lang = best.lang and longer.part = best.phrase
  where longer.a is null or 100 * longer.a < 50 * best.a
)
select ranked.lang, rank, phrase, a, l, r, n.n, cast(score as bigint) as score
from ranked join n on n.lang = ranked.lang where rank <= 2000
"""

QUERIES = {
    "op1_histogram_shards": (op1_histogram_shards, None),
    "op2_secret_scan": (op2_secret_scan, None),
    "op3_kneser_ney_quality": (op3_kneser_ney_quality, None),
    "op4_qgram_decontamination": (op4_qgram_decontamination, None),
    "op5_parity_sketch_join": (op5_parity_sketch_join, OP5_SQL),
    "op6_de_bruijn_dedup": (op6_de_bruijn_dedup, OP6_SQL),
    "op7_tiered_packing": (op7_tiered_packing, None),
    "op8_token_counts": (op8_token_counts, None),
    "op9_wrapper_induction": (op9_wrapper_induction, None),
    "op10_quality_rules": (op10_quality_rules, OP10_SQL),
    "op11_prefix_free_collocations": (op11_prefix_free_collocations, OP11_SQL),
    "op12_pitman_yor_scores": (op12_pitman_yor_scores, None),
    "op13_q_chunk_spelling": (op13_q_chunk_spelling, None),
}

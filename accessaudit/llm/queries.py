"""The registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accessaudit.llm import classlm, contamination, manifest, packing, pieces, repeats, simhash, tokenfiles, topk, toxicity, urllists, whitening, wrappers
from accessaudit.llm.common import importable, read_table


@importable
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = tuple(c for c in repeats.FOUND if c not in ("kept", "kept_text"))
    return repeats.repeated_passages(read_table(spark, sf_dir, "documents"), wanted=wanted)


@importable
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return contamination.contamination(docs, items).drop("body")


@importable
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@importable
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_table(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@importable
def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classlm.scored(read_table(spark, sf_dir, "documents"))


@importable
def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return urllists.judged(urllists.fetches(pages), urllists.dated_entries(pages))


@importable
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(read_table(spark, sf_dir, "embeddings"))


@importable
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(read_table(spark, sf_dir, "documents"))


@importable
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(read_table(spark, sf_dir, "pages"))


@importable
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@importable
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"))


@importable
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every other document is found without its line ends later
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    rows = manifest.checked(read_table(spark, sf_dir, "documents"), changed, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@importable
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.packed(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_toxicity": op3_toxicity,
    "op4_token_files": op4_token_files,
    "op5_class_lm": op5_class_lm,
    "op6_url_lists": op6_url_lists,
    "op7_topk": op7_topk,
    "op8_simhash": op8_simhash,
    "op9_main_text": op9_main_text,
    "op10_pieces": op10_pieces,
    "op11_whitening": op11_whitening,
    "op12_manifest": op12_manifest,
    "op13_packing": op13_packing,
}

SQL: dict[str, str] = {
    "op6_url_lists": urllists.SQL,
    "op2_decontaminate": r"""
with d as (
  select row_number() over () as rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
b as (
  select item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
item as (select item_id, w, least(13, len(w)) as n from b where len(w) > 0),
win as (select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as passage
        from (select item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from item)),
size as (select distinct n from win),
place as (select rid, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from d, size where len(w) >= n),
hit as (select p.rid, p.i, p.n, win.item_id
        from (select rid, i, n, array_to_string(w[i : i + n - 1], ' ') as passage from place) p
        join win on win.passage = p.passage and win.n = p.n),
pos as (select rid, count(distinct q) as n_hit
        from (select rid, unnest(generate_series(i, i + n - 1)) as q from hit) group by rid),
ids as (select rid, count(*) as n_items, string_agg(id, ',' order by id) as ids
        from (select distinct rid, item_id::varchar as id from hit) group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join pos using (rid) left join ids using (rid)
""",
}

"""The queries of the training-data operators, on whole tables, and SQL where it can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, html, langid, linededup, lm, minhash, mixing, neardup, urlfilter


def tokenizer_path() -> str:
    """The vocabulary file: TIDEMARK_TOKENIZER, else the installed public one."""
    if own := os.environ.get("TIDEMARK_TOKENIZER"):
        return own
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("text"), 256).alias("text_sha256"), "text")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "embeddings"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "shards")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.link(table(spark, sf_dir, "documents"), width=2).drop("class_id")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs.select("doc_id", "text", "lang"))
    return out.select("doc_id", (langid.remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_line_dedup, op2_lm_scoring, op3_embedding_near_dedup, op4_mixing, op5_bpe, op6_nearest, op7_minhash_near_dedup, op8_url_filter, op9_language_id, op10_html_text)}

#: SQL says the same by brute force: all pairs, all windows of lines. It takes ids to be unique.
_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_REACH = "reach(a, b) as (select {id}, {id} from {t} union select r.a, l.b from reach r join links l on r.b = l.a)"

_LINES = f"""
with lines as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents),
 worded as (select *, len({_WORDS.format('line')}) as w from lines),
 placed as (select *, row_number() over p as i, sum(w) over p as ce from worded where w > 0 window p as (partition by doc_id order by pos)),
 windows as (select distinct a.doc_id, a.i as lo, b.i as hi from placed a join placed b on a.doc_id = b.doc_id and b.i between a.i and a.i + 49
  where b.ce - a.ce + a.w >= 50 and (b.ce - b.w - a.ce + a.w < 50 or b.ce - a.ce < 50)),
 named as (select v.doc_id, v.lo, v.hi, string_agg(p.line, chr(10) order by p.i) as run from windows v join placed p on p.doc_id = v.doc_id and p.i between v.lo and v.hi group by all),
 later as (select *, row_number() over (partition by run order by doc_id, lo) as k from named),
 gone as (select distinct p.doc_id, p.pos from later v join placed p on p.doc_id = v.doc_id and p.i between v.lo and v.hi where v.k > 1),
 kept as (select l.doc_id, string_agg(l.line, chr(10) order by l.pos) as text from lines l anti join gone g on l.doc_id = g.doc_id and l.pos = g.pos group by 1),
 counts as (select l.doc_id, count(*) as n_lines, count(g.pos) as n_removed from lines l left join gone g on l.doc_id = g.doc_id and l.pos = g.pos group by 1)
select d.doc_id, coalesce(c.n_lines, 0) as n_lines, coalesce(c.n_removed, 0) as n_removed, length(t) as n_chars, sha256(t) as text_sha256, t as text
from (select d.doc_id, case when d.text is not null then coalesce(k.text, '') end as t from documents d left join kept k on d.doc_id = k.doc_id) d left join counts c on d.doc_id = c.doc_id"""

_VECTORS = f"""
with recursive v as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings),
 good as (select * from v where label is not null and len(e) > 0 and list_bool_and(list_transform(e, lambda x: x is not null and isfinite(x))) and list_max(list_transform(e, lambda x: abs(x))) > 0),
 links as (select x.vec_id as a, y.vec_id as b from good x join good y on x.label = y.label and x.vec_id <> y.vec_id and len(x.e) = len(y.e) where list_cosine_similarity(x.e, y.e) >= 0.98),
 {_REACH.format(id='vec_id', t='embeddings')},
 least as (select a, min(b) as m from reach group by 1), counts as (select a, count(*) as n from links group by 1)
select vec_id, coalesce(n, 0) as n_links, m as component_id, vec_id = m as kept from embeddings join least on least.a = vec_id left join counts on counts.a = vec_id"""

_SHINGLES = f"""
with recursive d as (select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents),
 s as (select doc_id, case when len(w) < 2 then w else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as sh from d),
 e as (select doc_id, len(sh) as n, unnest(sh) as x from s),
 pairs as (select x.doc_id as a, y.doc_id as b, count(*) as k, any_value(x.n) as na, any_value(y.n) as nb from e x join e y on x.x = y.x and x.doc_id <> y.doc_id group by 1, 2),
 links as (select a, b from pairs where 100 * k >= 80 * (na + nb - k)),
 {_REACH.format(id='doc_id', t='documents')},
 least as (select a, min(b) as m from reach group by 1)
select s.doc_id, cast(len(sh) as bigint) as n_shingles, m as component_id, s.doc_id = m as kept from s join least on least.a = s.doc_id"""

ORACLES: dict[str, str] = {"op1_line_dedup": _LINES, "op3_embedding_near_dedup": _VECTORS, "op7_minhash_near_dedup": _SHINGLES}

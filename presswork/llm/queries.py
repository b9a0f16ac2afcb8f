"""Registered queries of this subpackage: ``op1`` to ``op13`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm import decontam, embdup, licenses, minhash, packing, quality, spelling, substring, suffixlm, toxicity, urlrules, warc, whitening
from presswork.llm.common import fold, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op4_quality_pairwise")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    got = quality.rank_quality(docs, load(spark, sf_dir, "labels"), teach=fold("doc_id", 4) != 2)
    return got.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op5_toxicity_nbsvm")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs.where(fold("doc_id", 5) != 0), load(spark, sf_dir, "labels"))
    got = toxicity.score(docs, model)
    return got.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op3_best_two_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents").select("doc_id", "text"))


#: The rules of the url query (host, path, verdict).
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block"))

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


@query("op9_url_range_rules", f"""
with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') as raw, coalesce(rest, '') as rest from u),
p as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
      regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path, row_number() over () as n from h),
r(rule_host, rule_path, rule_verdict) as (values {_RULE_ROWS}),
m as (select p.n, rule_host || rule_path as rule, rule_verdict,
      row_number() over (partition by p.n order by length(rule_host || rule_path) desc, length(rule_host) desc) as k
      from p join r on (p.host = rule_host or p.host like '%.' || rule_host) and starts_with(p.path, rule_path))
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict from p left join m on p.n = m.n and m.k = 1""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return urlrules.judge(load(spark, sf_dir, "pages").select("page_id", "url"), rules)


@query("op10_arc_to_warc", """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, strlen(h)::bigint as payload_bytes, sha256(h) as payload_digest from p),
f as (select payload_digest, min(page_id) as first from d where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, d.payload_digest,
       case when page_id <> first then 'revisit' else 'response' end as record_type,
       case when page_id <> first then first end as refers_to
from d left join f on d.payload_digest = f.payload_digest""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(load(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("record_id")


@query("op1_seeded_alignment")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "benchmark"))


@query("op2_fixed_block_repeats")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substring.remove_repeats(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op8_tensor_minhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = minhash.near_duplicates(load(spark, sf_dir, "documents").select("doc_id", "text"), minhash.Settings(shingle=3, percent=85))
    return got.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op7_rotation_codes")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = embdup.near_duplicates(load(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return got.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query("op6_suffix_tree_lm")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffixlm.score_texts(load(spark, sf_dir, "documents").select("doc_id", "text"), fold("doc_id", 7) != 2)
    return got.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op11_lanczos_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = whitening.whiten(load(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    # null where a sum of squares is beyond a long
    return got.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


@query("op12_reduced_alphabet_spelling")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load(spark, sf_dir, "documents").select("doc_id", "text"), spelling.Settings(drop_of=31))


def _license_rows(s: licenses.Settings) -> str:
    rows = [(*x, True) for x in s.phrases] + [(*x, False) for x in s.notices]
    return ", ".join(f"({i}, '{label}', '{text}', {phrase})" for i, (label, text, phrase) in enumerate(rows))


def _license_words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '{licenses.WORDS}')"


_S = licenses.Settings()


@query("op13_diagonal_licenses", f"""
with d as materialized (select row_number() over () as rn, doc_id, {_license_words('text')} as w from documents),
p(template, label, txt, phrase) as (values {_license_rows(_S)}),
pw as materialized (select template, label, phrase, windows, t, pw0[t + 1:t + {_S.k}] as gram from (
  select template, label, phrase, len(w0) - {_S.k - 1} as windows, w0 as pw0, unnest(range(len(w0) - {_S.k - 1})) as t
  from (select *, {_license_words('txt')} as w0 from p))),
hit as materialized (select rn, template, label, phrase, windows, pos - t as diagonal, t from (
  select rn, pos, w[pos + 1:pos + {_S.k}] as gram from (select rn, w, unnest(range(len(w) - {_S.k - 1})) as pos from d where len(w) >= {_S.k})) join pw using (gram)),
votes as (select rn, template, label, phrase, windows, diagonal, count(distinct t) as votes from hit group by all),
base as (select rn, count(*) filter (votes = windows) as n_base, min(diagonal) filter (votes = windows) as first_word,
  max(diagonal) filter (votes = windows) as last_word, list(distinct label) filter (votes = windows) as labels, max(votes / windows) as share
  from votes where phrase group by rn),
marked as (select *, case when diagonal - lag(diagonal) over (partition by rn, template order by diagonal) <= {_S.slack} then 0 else 1 end as new
  from votes where not phrase),
span as (select rn, template, diagonal, sum(new) over (partition by rn, template order by diagonal rows unbounded preceding) as span from marked),
held as (select rn, label, template, span, count(distinct t) / any_value(windows) as share from hit join span using (rn, template, diagonal) group by all),
notice as (select rn, list(distinct label) filter (share >= {_S.least}) as labels, max(share) as share from held group by rn)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(b.labels, [])), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(n.labels, [])))), ',') as labels,
  greatest(coalesce(b.share, 0), coalesce(n.share, 0)) as score
from d left join base b using (rn) left join notice n using (rn)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(load(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")

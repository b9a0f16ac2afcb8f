"""Registered queries: keyword summaries (U2-U5, U7, U8, U12, U14-U16 -> J6) and
combo summaries (U1-U6, U8-U12, U14, U16 -> J5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.operators import graph
from presswork.operators import summary as U
from presswork.plans import q_combos as J3
from presswork.plans.q_cluster import EMIT_SQL, Clustering, recursive
from presswork.plans.q_combos import ARTICLES_SQL
from presswork.plans.q_stream import scratch
from presswork.plans.registry import query
from presswork.plans.sql_common import WORD
from presswork.session import cut_lineage
from presswork.sources.sinks import write_partitions

KG = ["date", "keyword"]
CG = ["date", "combo", "label"]


def numbered(arts: DataFrame, g: list[str], order: str) -> DataFrame:
    """U3 -> U5: ``(g..., node, sentence, tokens)``; ``node`` orders the sentences
    of a group by article, then position."""
    s = U.sentence_tokens(U.sentence_rows(arts, [*g, order]))
    w = Window.partitionBy(*g).orderBy(order, "spos")
    return cut_lineage(s.withColumn("node", (F.row_number().over(w) - 1).cast("int")).drop(order, "spos"))


def keyword_sentences(spark, sf, c: Clustering | None = None) -> DataFrame:
    """U2 -> U5 per (date, keyword). Texts join the ids that U2 leaves."""
    c = c or Clustering(spark, sf)
    capped = U.cap_articles(c.rows.select(*KG, "id"), KG, [F.col("id")], 20)
    return numbered(capped.join(c.articles.select("date", "id", "content"), ["date", "id"]), KG, "id")


def keyword_summaries(spark, sf, c: Clustering | None = None) -> DataFrame:
    """``(date, keyword, summary, converged)``; keywords without sentences
    are skipped (U15). ``converged`` is false where the ranks still moved when
    the rounds ended, so such a summary is not taken for a finished one."""
    s = cut_lineage(U.drop_redundant(keyword_sentences(spark, sf, c), KG, ["node"], 0.7, "min"))
    ranks = cut_lineage(graph.div_rank_converged(U.sentence_graph(s, KG), s.select(*KG, "node"), KG))
    state = ranks.groupBy(*KG).agg(F.min("converged").alias("converged"))
    return U.summary_by_score(ranks, s, KG, 4).join(state, KG)


def combo_sentences(spark, sf, c: Clustering | None = None) -> DataFrame:
    """U1 -> U6 per (date, combo, label) of J4's rows, found by their keys."""
    rows = (c or Clustering(spark, sf)).cluster_articles()
    rows = rows.select("date", U.combo_of("row_key").alias("combo"), "label", "n", "content")
    s = numbered(U.cap_articles(rows, CG, [F.col("n")], 20), CG, "n")
    return cut_lineage(U.drop_redundant(s, CG, ["node"], 0.7, "max"))


def combo_graph(spark, sf, c: Clustering | None = None) -> tuple[DataFrame, DataFrame]:
    s = combo_sentences(spark, sf, c)
    return s, cut_lineage(U.sentence_graph(s, CG))


def combo_summaries(spark, sf, c: Clustering | None = None) -> DataFrame:
    """``(date, keyword, summary)`` per combo; a block for each cluster
    label, in their order."""
    s, edges = combo_graph(spark, sf, c)
    blocks = U.summary_in_order(graph.salience(edges, s.select(*CG, "node"), CG), s, CG, 5)
    return blocks.groupBy("date", F.col("combo").alias("keyword")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("label", "summary"))), lambda b: b["summary"]), "").alias("summary"))


# ----------------------------------------------------------------------------
# the SQL side

#: Marks beside a digit are hidden while sentences are cut (no look-around there).
HIDDEN = ((".", "chr(1)"), ("!", "chr(2)"), ("?", "chr(3)"))


def _mask(c: str) -> str:
    for mark, ch in HIDDEN:
        c = f"regexp_replace({c}, '([0-9])[{mark}]', '\\1' || {ch}, 'g')"
    for mark, ch in HIDDEN:
        c = f"regexp_replace({c}, '[{mark}]([0-9])', {ch} || '\\1', 'g')"
    return c


def _unmask(c: str) -> str:
    for mark, ch in HIDDEN:
        c = f"replace({c}, {ch}, '{mark}')"
    return c


def sentences_sql(src: str, g: str, order: str) -> str:
    """The table ``sent``."""
    return f"""cut AS (SELECT {g}, {order}, unnest(l) AS s, generate_subscripts(l, 1) AS spos
  FROM (SELECT {g}, {order}, regexp_extract_all({_mask('content')}, '.+?[.!?]') AS l FROM {src})),
sent AS MATERIALIZED (
  SELECT {g}, CAST(row_number() OVER (PARTITION BY {g} ORDER BY {order}, spos) - 1 AS INTEGER) AS node, sentence,
         regexp_extract_all(sentence, '{WORD}') AS tokens
  FROM (SELECT {g}, {order}, spos, {_unmask('s')} AS sentence FROM cut) WHERE length(sentence) BETWEEN 1 AND 190)"""


def overlaps_sql(name: str, src: str, g: str) -> str:
    """Shared distinct tokens of every pair a < b that has any, with the sizes."""
    return f"""{name}_t AS MATERIALIZED (SELECT {g}, node, len(tokens) AS n, len(list_distinct(tokens)) AS size, unnest(list_distinct(tokens)) AS tok FROM {src}),
{name} AS MATERIALIZED (
  SELECT {g}, x.node AS a, y.node AS b, any_value(x.n) AS na, any_value(y.n) AS nb, any_value(x.size) AS sa, any_value(y.size) AS sb, count(*) AS c
  FROM {name}_t x JOIN {name}_t y USING ({g}, tok) WHERE x.node < y.node GROUP BY ALL)"""


def redundant_sql(g: str, pick: str) -> str:
    """The table ``ksent``, by walking through the paired sentences in order."""
    return f"""{overlaps_sql('ov', 'sent', g)},
conf AS MATERIALIZED (SELECT {g}, b AS node, list(a) AS nb, row_number() OVER (PARTITION BY {g} ORDER BY b) AS k
  FROM ov WHERE c / {pick}(na, nb) >= 0.7 GROUP BY {g}, b),
walk AS (SELECT {g}, CAST(0 AS BIGINT) AS k, CAST([] AS INTEGER[]) AS gone FROM (SELECT DISTINCT {g} FROM conf)
  UNION ALL SELECT {g}, c.k, CASE WHEN len(list_filter(c.nb, lambda x: NOT list_contains(r.gone, x))) > 0
                                  THEN list_append(r.gone, c.node) ELSE r.gone END
  FROM walk r JOIN conf c USING ({g}) WHERE c.k = r.k + 1),
ksent AS MATERIALIZED (SELECT * FROM sent WHERE len(tokens) > 0 AND ({g}, node) NOT IN (
  SELECT {g}, unnest(gone) FROM (SELECT {g}, arg_max(gone, k) AS gone FROM walk GROUP BY {g})))"""


def graph_sql(g: str) -> str:
    """U8 on the kept sentences: the table ``edge``."""
    return f"""{overlaps_sql('ko', 'ksent', g)},
half AS (SELECT {g}, a, b, c / ((ln(sa + 1) + 1) + (ln(sb + 1) + 1)) AS w FROM ko),
edge AS MATERIALIZED (SELECT {g}, a AS src, b AS dst, w FROM half UNION ALL SELECT {g}, b, a, w FROM half)"""


KSENT_SQL = f"""{ARTICLES_SQL},
capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date, keyword ORDER BY id) AS r FROM articles) WHERE r <= 20),
{sentences_sql('capped', 'date, keyword', 'id')}"""

_G = "date, combo, label"
COMBO_SENT_SQL = f"""{EMIT_SQL},
crows AS (SELECT date, split_part(combo || '_' || CAST(n AS VARCHAR), '_', 1) AS combo, label, n, content FROM emitted
  JOIN (SELECT date, id, content FROM art) USING (date, id)),
ccap AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_G} ORDER BY n) AS r FROM crows) WHERE r <= 20),
{sentences_sql('ccap', _G, 'n')},
{redundant_sql(_G, 'greatest')}"""
COMBO_GRAPH_SQL = f"{COMBO_SENT_SQL},\n{graph_sql(_G)}"

_P = "pow(0.85 * a, 30)"
SALIENCE_SQL = f"""{COMBO_GRAPH_SQL},
cell AS (SELECT {_G}, src AS node, w / sum(w) OVER (PARTITION BY {_G}, dst) AS a FROM edge),
part AS (SELECT {_G}, node, sum({_P} + 0.15 * (1 - {_P}) / (1 - 0.85 * a) - 0.15) AS s FROM cell GROUP BY ALL),
sal AS (SELECT k.date, k.combo, k.label, k.node, k.sentence,
               round(0.15 * count(*) OVER (PARTITION BY k.date, k.combo, k.label) + coalesce(p.s, 0), 6) AS score
        FROM ksent k LEFT JOIN part p USING ({_G}, node))"""

J5_SQL = f"""{SALIENCE_SQL},
topn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_G} ORDER BY score DESC, node DESC) AS r FROM sal) WHERE r <= 5),
block AS (SELECT {_G}, string_agg(sentence || '^^^', '' ORDER BY node) AS summary FROM topn GROUP BY ALL),
j5 AS (SELECT date, combo AS keyword, string_agg(summary, '' ORDER BY label) AS summary FROM block GROUP BY ALL)"""


def div_rank_sql(rounds: int) -> str:
    """U12 with a fixed number of rounds; the last table is ``x{rounds}``."""
    out = [f"""tr AS MATERIALIZED (
  SELECT {_G}, src, dst, 0.25 * w / sum(w) OVER (PARTITION BY {_G}, src) AS p FROM edge
  UNION ALL SELECT {_G}, node, node, 0.75 FROM ksent),
x0 AS (SELECT {_G}, node, 1.0 / count(*) OVER (PARTITION BY {_G}) AS x, 1.0 / count(*) OVER (PARTITION BY {_G}) AS u FROM ksent)"""]
    for k in range(1, rounds + 1):
        out.append(f"""t{k} AS MATERIALIZED (
  SELECT {_G}, t.src, t.dst, t.p * xd.x AS px, xs.x AS xs, sum(t.p * xd.x) OVER (PARTITION BY {_G}, t.src) AS D
  FROM tr t JOIN (SELECT {_G}, node AS dst, x FROM x{k - 1}) xd USING ({_G}, dst)
            JOIN (SELECT {_G}, node AS src, x FROM x{k - 1}) xs USING ({_G}, src)),
x{k} AS MATERIALIZED (
  SELECT {_G}, node, 0.85 * s + 0.15 * u AS x, u FROM (SELECT {_G}, dst AS node, sum(px / D * xs) AS s FROM t{k} GROUP BY ALL)
  JOIN (SELECT {_G}, node, u FROM x0) USING ({_G}, node))""")
    return ",\n".join(out)


ROUNDS = 6


@query("u1_combo_keys", recursive(f"""{EMIT_SQL}
SELECT DISTINCT date, split_part(combo || '_' || CAST(n AS VARCHAR), '_', 1) AS combo FROM emitted"""))
def u1_combo_keys(spark, sf):
    """The combos of J4's row keys."""
    return Clustering(spark, sf).emitted().select("date", U.combo_of("row_key").alias("combo")).distinct()


@query("u2_cap_articles", f"""WITH {ARTICLES_SQL}
SELECT date, keyword, id FROM (
  SELECT *, row_number() OVER (PARTITION BY date, keyword ORDER BY id) AS r FROM articles) WHERE r <= 20""")
def u2_cap_articles(spark, sf):
    arts = U.cap_articles(J3.articles_table(spark, sf), KG, [F.col("id")], 20)
    return arts.select("date", "keyword", "id")


@query("u3_u4_sentences", f"WITH {KSENT_SQL} SELECT date, keyword, node, sentence FROM sent")
def u3_u4_sentences(spark, sf):
    """Sentence rows of the capped articles."""
    return keyword_sentences(spark, sf).select("date", "keyword", "node", "sentence")


@query("u5_tokens", f"WITH {KSENT_SQL} SELECT date, keyword, node, array_to_string(tokens, ' ') AS tokens FROM sent")
def u5_tokens(spark, sf):
    return keyword_sentences(spark, sf).select("date", "keyword", "node", F.array_join("tokens", " ").alias("tokens"))


@query("u6_drop_redundant", recursive(f"{COMBO_SENT_SQL} SELECT date, combo, label, node FROM ksent"))
def u6_drop_redundant(spark, sf):
    return combo_sentences(spark, sf).select(*CG, "node")


@query("u7_drop_redundant", recursive(f"{KSENT_SQL}, {redundant_sql('date, keyword', 'least')} SELECT date, keyword, node FROM ksent"))
def u7_drop_redundant(spark, sf):
    s = U.drop_redundant(keyword_sentences(spark, sf), KG, ["node"], 0.7, "min")
    return s.select("date", "keyword", "node")


@query("u8_sentence_graph", f"""WITH {KSENT_SQL}, ksent AS (SELECT * FROM sent), {graph_sql('date, keyword')}
SELECT date, keyword, src, dst, round(w, 6) AS w FROM edge""")
def u8_sentence_graph(spark, sf):
    s = keyword_sentences(spark, sf)
    return U.sentence_graph(s, KG).select("date", "keyword", "src", "dst", F.round("w", 6).alias("w"))


@query("u9_salience", recursive(f"{SALIENCE_SQL} SELECT date, combo, label, node, score FROM sal"))
def u9_salience(spark, sf):
    s, edges = combo_graph(spark, sf)
    return graph.salience(edges, s.select(*CG, "node"), CG).select(*CG, "node", F.round("score", 6).alias("score"))


@query("u10_page_rank")
def u10_page_rank(spark, sf):
    """U10 on J5's graphs, solved (checked in tests against the linear equation)."""
    s, edges = combo_graph(spark, sf)
    return graph.page_rank(edges, s.select(*CG, "node"), CG).select(*CG, "node", F.round("rank", 6).alias("rank"), "converged")


@query("u12_div_rank_rounds", recursive(f"{COMBO_GRAPH_SQL}, {div_rank_sql(ROUNDS)} SELECT date, combo, label, node, round(x, 6) AS rank FROM x{ROUNDS}"))
def u12_div_rank_rounds(spark, sf):
    s, edges = combo_graph(spark, sf)
    ranks = graph.div_rank(edges, s.select(*CG, "node"), CG, rounds=ROUNDS)
    return ranks.select(*CG, "node", F.round("rank", 6).alias("rank"))


@query("u14_summary_by_score", recursive(f"""{COMBO_GRAPH_SQL}, {div_rank_sql(ROUNDS)},
four AS (SELECT * FROM (SELECT {_G}, node, sentence, row_number() OVER (PARTITION BY {_G} ORDER BY round(x, 6) DESC, node) AS r
  FROM x{ROUNDS} JOIN (SELECT {_G}, node, sentence FROM ksent) USING ({_G}, node)) WHERE r <= 4)
SELECT {_G}, string_agg(sentence || '^^^', '' ORDER BY r) AS summary FROM four GROUP BY ALL"""))
def u14_summary_by_score(spark, sf):
    """U14 on ranks of a fixed number of rounds (J6 has those that settled)."""
    s, edges = combo_graph(spark, sf)
    return U.summary_by_score(graph.div_rank(edges, s.select(*CG, "node"), CG, rounds=ROUNDS), s, CG, 4)


@query("u15_skipped", f"""WITH {KSENT_SQL},
have AS (SELECT DISTINCT date, keyword FROM sent WHERE len(tokens) > 0)
SELECT date, count(*) FILTER (h.keyword IS NOT NULL) AS summaries, count(*) FILTER (h.keyword IS NULL) AS skipped
FROM (SELECT date, k.keyword FROM (SELECT DISTINCT date FROM articles) d, kw k) a LEFT JOIN have h USING (date, keyword) GROUP BY ALL""")
def u15_skipped(spark, sf):
    """Keywords of a day with a summary, and those skipped for want of
    articles or sentences."""
    have = keyword_sentences(spark, sf).where("size(tokens) > 0").select(*KG).distinct()
    per = have.groupBy("date").agg(F.count(F.lit(1)).alias("summaries"))
    days = Clustering(spark, sf).rows.select("date").distinct()
    total = J3.crawl_keywords(spark, sf).select(F.count(F.lit(1))).scalar()
    return (days.join(per, "date", "left").select("date", F.coalesce("summaries", F.lit(0)).alias("summaries"), total.alias("_n"))
            .select("date", "summaries", (F.col("_n") - F.col("summaries")).alias("skipped")))


@query("j5_combo_summaries", recursive(f"{J5_SQL} SELECT date, keyword, summary FROM j5"))
def j5_combo_summaries(spark, sf):
    return combo_summaries(spark, sf)


@query("u16_summary_table", recursive(f"{J5_SQL} SELECT date, keyword, summary FROM j5"))
def u16_summary_table(spark, sf):
    """U16: J5's rows, one a (date, keyword), in the table partitioned by date;
    the newest date is written once more, by itself."""
    path = f"{scratch(spark, 'summaries')}/table"
    rows = cut_lineage(combo_summaries(spark, sf))
    write_partitions(rows, path, sort=["keyword"])
    newest = rows.agg(F.max("date").alias("d")).select("d").scalar()
    write_partitions(rows.where(F.col("date") == newest), path, sort=["keyword"])
    return spark.read.schema(rows.schema).parquet(path).select("date", "keyword", "summary")


@query("j6_keyword_summaries")
def j6_keyword_summaries(spark, sf):
    return keyword_summaries(spark, sf)

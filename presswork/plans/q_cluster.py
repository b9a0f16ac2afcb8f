"""Registered queries: related-article clustering."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.functions.stopwords import FUNCTION_WORDS
from presswork.operators import cluster as P
from presswork.operators import combos as M
from presswork.operators import vectors as V
from presswork.plans import q_combos as J3
from presswork.plans.q_combos import COMBO_SQL
from presswork.plans.registry import query
from presswork.plans.sql_common import STOP, WORD
from presswork.session import cut_lineage
from presswork.sources.corpus import corpus_articles

G = P.G


class Clustering:
    """The steps of J4, each made once however many later steps read it. Rows
    of combos are ids; texts are read for tokens (once an article) and at the end."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    @cached_property
    def articles(self) -> DataFrame:
        return corpus_articles(self.spark, self.sf).filter(F.col("date").isNotNull() & F.col("content").isNotNull())

    @cached_property
    def rows(self) -> DataFrame:
        """The per-day article table without texts."""
        return cut_lineage(M.retrieved(self.articles, J3.crawl_keywords(self.spark, self.sf)))

    @cached_property
    def combos(self) -> DataFrame:
        """J3 on these rows."""
        words = F.transform("words", lambda s: s["keyword"])
        pre = M.prefixes_of(self.rows.select("date", "kpos", "id", words.alias("words")))
        return cut_lineage(M.rank_combos(M.prune_supersets(M.top_combos(pre, 10))))

    @cached_property
    def combo_rows(self) -> DataFrame:
        """``(date, mix_id, rank, value, wpos, keyword, id, n)``; ``n`` =
        position of the row in the combo's concatenated list."""
        rows = M.combo_articles(M.combo_plan(self.combos), self.rows.select("date", "keyword", "id"))
        w = Window.partitionBy(*G).orderBy("wpos", "id")
        return cut_lineage(rows.withColumn("n", (F.row_number().over(w) - 1).cast("int")))

    @cached_property
    def tokens(self) -> DataFrame:
        """``(date, id, ntok, tokens)`` of the combos' articles."""
        used = self.combo_rows.select("date", "id").distinct()
        texts = P.min_tokens(P.pos_tokens(self.articles.select("date", "id", "content").join(used, ["date", "id"], "left_semi")))
        return cut_lineage(texts.select("date", "id", F.size("tokens").alias("ntok"), "tokens"))

    @cached_property
    def counts(self) -> DataFrame:
        """``(date, id, term, tf)``."""
        return cut_lineage(V.term_counts(self.tokens, ["date", "id"], stop=FUNCTION_WORDS))

    @cached_property
    def docs(self) -> DataFrame:
        """``(date, mix_id, rank, value, n, id, ntok)``."""
        return cut_lineage(self.combo_rows.drop("wpos", "keyword").join(self.tokens.select("date", "id", "ntok"), ["date", "id"]))

    @cached_property
    def weights(self) -> DataFrame:
        return cut_lineage(P.tfidf_weights(self.docs, self.counts, G))

    @cached_property
    def kept(self) -> DataFrame:
        """P11."""
        return cut_lineage(P.drop_near_duplicates(self.docs, self.weights))

    @cached_property
    def kept_weights(self) -> DataFrame:
        return cut_lineage(P.tfidf_weights(self.kept, self.counts, G))

    @cached_property
    def labels(self) -> DataFrame:
        """``(date, mix_id, n, label)``."""
        return cut_lineage(P.dbscan(self.kept, self.kept_weights))

    @cached_property
    def candidates(self) -> DataFrame:
        return P.candidate_clusters(self.labels)

    @cached_property
    def terms(self) -> DataFrame:
        """P15."""
        return cut_lineage(P.cluster_terms(self.kept, self.counts, self.labels, self.candidates))

    @cached_property
    def coverage(self) -> DataFrame:
        """P16. A word whose rows were all dropped still counts."""
        qwords = self.combo_rows.groupBy(*G).agg(F.array_sort(F.collect_set("keyword")).alias("qwords"))
        return P.coverage(self.terms, qwords)

    @cached_property
    def picked(self) -> DataFrame:
        """P17."""
        return P.pick_cluster(self.coverage, self.candidates)

    def emitted(self, max_combos: int = 5) -> DataFrame:
        """The chosen cluster's rows of the first ``max_combos`` successful
        combos of a day: ``(date, mix_id, combo, label, n, id, keyword_id,
        row_key)``; rows are numbered 0, 1, 2, ..."""
        w = Window.partitionBy("date").orderBy("rank")
        best = (self.picked.select(*G, "label").join(self.combos.select(*G, "rank"), G)
                .withColumn("k", F.row_number().over(w) - 1).filter(F.col("k") < max_combos))
        rows = self.kept.join(self.labels, [*G, "n"]).join(best.select(*G, "label", "k"), [*G, "label"])
        rows = rows.withColumn("n", (F.row_number().over(Window.partitionBy(*G).orderBy("n")) - 1).cast("int"))
        return rows.select(
            "date", "mix_id", F.col("value").alias("combo"), "label", "n", "id",
            F.concat(F.lit("MIX_"), F.col("k").cast("string")).alias("keyword_id"),
            F.concat(F.col("value"), F.lit("_"), F.col("n").cast("string")).alias("row_key"))

    def cluster_articles(self, max_combos: int = 5) -> DataFrame:
        """P18 with the articles' title, content and thumbnail."""
        texts = self.articles.select("date", "id", "title", "content", "thumbnail")
        return self.emitted(max_combos).join(texts, ["date", "id"])


# ----------------------------------------------------------------------------
# the SQL side

PLAN_SQL = f"""{COMBO_SQL},
pw AS (SELECT date, mix_id, rank, value, unnest(words) AS keyword, generate_subscripts(words, 1) - 1 AS wpos
       FROM (SELECT *, string_split(value, '&')[1:2] AS words FROM combos)),
crow AS (SELECT date, mix_id, rank, value, keyword, id,
                CAST(row_number() OVER (PARTITION BY date, mix_id ORDER BY wpos, id) - 1 AS INTEGER) AS n
         FROM pw JOIN (SELECT date, keyword, id FROM articles) USING (date, keyword)),
toks AS MATERIALIZED (
  SELECT date, id, tokens, len(tokens) AS ntok
  FROM (SELECT date, id, regexp_extract_all(content, '{WORD}') AS tokens FROM art
        WHERE (date, id) IN (SELECT date, id FROM crow)) WHERE len(tokens) >= 40),
docs AS MATERIALIZED (SELECT date, mix_id, rank, value, n, id, ntok FROM crow JOIN toks USING (date, id)),
words AS (
  SELECT date, id, w, lead(w, 1) OVER p AS w1, lead(w, 2) OVER p AS w2
  FROM (SELECT date, id, unnest(k) AS w, generate_subscripts(k, 1) AS pos
        FROM (SELECT date, id, list_filter(list_transform(tokens, lambda t: lower(t)),
                     lambda t: length(t) >= 2 AND NOT list_contains({STOP}, t)) AS k FROM toks))
  WINDOW p AS (PARTITION BY date, id ORDER BY pos)),
aterm AS MATERIALIZED (
  SELECT date, id, term, count(*) AS tf FROM (
    SELECT date, id, w AS term FROM words UNION ALL
    SELECT date, id, w || ' ' || w1 FROM words WHERE w1 IS NOT NULL UNION ALL
    SELECT date, id, w || ' ' || w1 || ' ' || w2 FROM words WHERE w2 IS NOT NULL) GROUP BY ALL)"""


def weights_sql(name: str, docs: str, g: str) -> str:
    """P6-P9 of the groups ``g`` of the table ``docs``."""
    return f"""{name}_tf AS MATERIALIZED (SELECT {g}, n, term, tf FROM {docs} JOIN aterm USING (date, id)),
{name}_b AS (SELECT {g}, floor(avg(ntok)) AS bound, count(*) AS nd FROM {docs} GROUP BY {g}),
{name}_v AS (SELECT {g}, term, df FROM (
    SELECT {g}, term, count(*) AS df, row_number() OVER (PARTITION BY {g} ORDER BY sum(tf) DESC, term) AS rn
    FROM {name}_tf GROUP BY {g}, term HAVING count(*) >= 3) JOIN {name}_b USING ({g}) WHERE rn <= bound),
{name} AS MATERIALIZED (SELECT {g}, n, term, v / sqrt(sum(v * v) OVER (PARTITION BY {g}, n)) AS w FROM (
    SELECT {g}, n, term, tf * (ln((1 + nd) / (1 + df)) + 1) AS v
    FROM {name}_tf JOIN {name}_v USING ({g}, term) JOIN {name}_b USING ({g})))"""


def pairs_sql(name: str, weights: str, cond: str) -> str:
    return f"""{name} AS MATERIALIZED (SELECT * FROM (
    SELECT x.date, x.mix_id, x.n AS a, y.n AS b, round(sum(x.w * y.w), 6) AS sim
    FROM {weights} x JOIN {weights} y ON x.date = y.date AND x.mix_id = y.mix_id AND x.term = y.term AND x.n < y.n
    GROUP BY ALL) WHERE sim {cond})"""


KEPT_SQL = f"""{PLAN_SQL},
{weights_sql('w0', 'docs', 'date, mix_id')},
{pairs_sql('dup', 'w0', '> 0.98')},
near AS (SELECT date, mix_id, a, b FROM dup UNION SELECT date, mix_id, b, a FROM dup UNION SELECT date, mix_id, n, n FROM docs),
least AS (SELECT date, mix_id, a, min(b) AS m FROM near GROUP BY ALL),
gone AS (SELECT DISTINCT date, mix_id, b AS n FROM near JOIN least USING (date, mix_id, a) WHERE b > m),
uniq AS MATERIALIZED (SELECT * FROM docs WHERE (date, mix_id, n) NOT IN (SELECT date, mix_id, n FROM gone))"""

LABEL_SQL = f"""{KEPT_SQL},
{weights_sql('w1', 'uniq', 'date, mix_id')},
{pairs_sql('sim', 'w1', '>= 0.5')},
nb AS MATERIALIZED (SELECT date, mix_id, a, b FROM sim UNION ALL SELECT date, mix_id, b, a FROM sim),
core AS (SELECT date, mix_id, a FROM nb GROUP BY ALL HAVING count(*) >= 3),
cedge AS MATERIALIZED (SELECT nb.* FROM nb SEMI JOIN core USING (date, mix_id, a)
  SEMI JOIN (SELECT date, mix_id, a AS b FROM core) AS other USING (date, mix_id, b)),
reach AS (SELECT date, mix_id, a, a AS c FROM core
  UNION SELECT r.date, r.mix_id, e.b, r.c FROM reach r JOIN cedge e USING (date, mix_id, a)),
clab AS (SELECT date, mix_id, a, CAST(dense_rank() OVER (PARTITION BY date, mix_id ORDER BY c) - 1 AS INTEGER) AS label
  FROM (SELECT date, mix_id, a, min(c) AS c FROM reach GROUP BY ALL)),
blab AS (SELECT nb.date, nb.mix_id, nb.a, min(label) AS label FROM nb
  JOIN clab ON clab.date = nb.date AND clab.mix_id = nb.mix_id AND clab.a = nb.b GROUP BY ALL),
lab AS MATERIALIZED (SELECT k.date, k.mix_id, k.n, coalesce(c.label, b.label, -1) AS label FROM uniq k
  LEFT JOIN clab c ON c.date = k.date AND c.mix_id = k.mix_id AND c.a = k.n
  LEFT JOIN blab b ON b.date = k.date AND b.mix_id = k.mix_id AND b.a = k.n)"""

TERMS_SQL = f"""{LABEL_SQL},
cands AS (SELECT date, mix_id, label, count(*) AS size FROM lab WHERE label >= 1 GROUP BY ALL HAVING count(*) >= 4),
cdocs AS MATERIALIZED (SELECT k.*, l.label FROM uniq k JOIN lab l USING (date, mix_id, n) SEMI JOIN cands USING (date, mix_id, label)),
{weights_sql('w2', 'cdocs', 'date, mix_id, label')},
terms AS (SELECT * FROM (
    SELECT date, mix_id, label, term, score, row_number() OVER (PARTITION BY date, mix_id, label ORDER BY score DESC, term) AS r
    FROM (SELECT date, mix_id, label, term, round(sum(w) / any_value(nd), 6) AS score
          FROM w2 JOIN w2_b USING (date, mix_id, label) GROUP BY date, mix_id, label, term)) WHERE r <= 20)"""

EMIT_SQL = f"""{TERMS_SQL},
qw AS (SELECT date, mix_id, list(DISTINCT keyword) AS q FROM crow GROUP BY ALL),
cov AS (SELECT date, mix_id, label, len(list_filter(q, lambda x: contains(text, x))) AS hits, len(q) AS nwords
  FROM (SELECT date, mix_id, label, string_agg(term, ' ' ORDER BY term) AS text FROM terms GROUP BY ALL) JOIN qw USING (date, mix_id)),
picked AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY date, mix_id ORDER BY nwords - hits, size DESC, label) AS r
    FROM cov JOIN cands USING (date, mix_id, label) WHERE nwords - hits <= 1) WHERE r = 1),
best AS (SELECT * FROM (SELECT date, mix_id, label, row_number() OVER (PARTITION BY date ORDER BY rank) - 1 AS k
    FROM picked JOIN (SELECT date, mix_id, rank FROM combos) USING (date, mix_id)) WHERE k < 5),
emitted AS MATERIALIZED (
  SELECT date, mix_id, value AS combo, label, CAST(row_number() OVER (PARTITION BY date, mix_id ORDER BY n) - 1 AS INTEGER) AS n, id, k
  FROM uniq JOIN lab USING (date, mix_id, n) JOIN best USING (date, mix_id, label))"""


def recursive(sql: str) -> str:
    return f"WITH RECURSIVE {sql}"


@query("p1_combo_plan", f"""WITH {COMBO_SQL}
SELECT date, mix_id, rank, array_to_string(string_split(value, '&')[1:2], ' ') AS words FROM combos""")
def p1_combo_plan(spark, sf):
    p = M.combo_plan(J3.combos(spark, sf))
    return p.select("date", "mix_id", "rank", F.array_join("words", " ").alias("words"))


@query("p2_p5_combo_docs", f"WITH {PLAN_SQL} SELECT date, mix_id, n, id, ntok FROM docs")
def p2_p5_combo_docs(spark, sf):
    return Clustering(spark, sf).docs.select("date", "mix_id", "n", "id", "ntok")


@query("p6_vocab_bound", f"WITH {PLAN_SQL} SELECT date, mix_id, CAST(floor(avg(ntok)) AS INTEGER) AS bound FROM docs GROUP BY ALL")
def p6_vocab_bound(spark, sf):
    return V.vocab_bound(Clustering(spark, sf).docs, G)


@query("p7_p9_tfidf", f"""WITH {PLAN_SQL}, {weights_sql('w0', 'docs', 'date, mix_id')}
SELECT date, mix_id, n, term, round(w, 6) AS w FROM w0""")
def p7_p9_tfidf(spark, sf):
    return Clustering(spark, sf).weights.select("date", "mix_id", "n", "term", F.round("w", 6).alias("w"))


@query("p10_cosine_pairs", f"""WITH {PLAN_SQL}, {weights_sql('w0', 'docs', 'date, mix_id')}, {pairs_sql('sim', 'w0', '>= 0.5')}
SELECT date, mix_id, a, b, sim FROM sim""")
def p10_cosine_pairs(spark, sf):
    return V.cosine_pairs(Clustering(spark, sf).weights, G, "n", 0.5)


@query("p11_near_duplicates", f"WITH {KEPT_SQL} SELECT date, mix_id, n, id FROM uniq")
def p11_near_duplicates(spark, sf):
    """Kept article rows after near-duplicate removal."""
    return Clustering(spark, sf).kept.select("date", "mix_id", "n", "id")


@query("p12_dbscan_labels", recursive(f"{LABEL_SQL} SELECT date, mix_id, n, label FROM lab"))
def p12_dbscan_labels(spark, sf):
    return Clustering(spark, sf).labels


@query("p13_cluster_report", recursive(f"""{LABEL_SQL}
SELECT date, mix_id, count(DISTINCT CASE WHEN label >= 0 THEN label END) AS clusters, count(*) FILTER (label = -1) AS noise,
       count(*) FILTER (label = 0) AS label0, count(*) AS total FROM lab GROUP BY ALL"""))
def p13_cluster_report(spark, sf):
    return P.cluster_report(Clustering(spark, sf).labels)


@query("p14_candidates", recursive(f"""{LABEL_SQL}
SELECT date, mix_id, label, count(*) AS size FROM lab WHERE label >= 1 GROUP BY ALL HAVING count(*) >= 4"""))
def p14_candidates(spark, sf):
    return Clustering(spark, sf).candidates


@query("p15_cluster_terms", recursive(f"{TERMS_SQL} SELECT date, mix_id, label, term, score FROM terms"))
def p15_cluster_terms(spark, sf):
    return Clustering(spark, sf).terms


@query("p16_p17_picked", recursive(f"{EMIT_SQL} SELECT date, mix_id, label, hits, nwords, size FROM picked"))
def p16_p17_picked(spark, sf):
    return Clustering(spark, sf).picked.select(*G, "label", "hits", "nwords", "size")


@query("j4_cluster_articles", recursive(f"""{EMIT_SQL}
SELECT date, mix_id, combo, label, n, id, title, content, thumbnail, 'MIX_' || CAST(k AS VARCHAR) AS keyword_id,
       combo || '_' || CAST(n AS VARCHAR) AS row_key
FROM emitted JOIN (SELECT date, id, title, content, thumbnail FROM art) USING (date, id)"""))
def j4_cluster_articles(spark, sf):
    return Clustering(spark, sf).cluster_articles()

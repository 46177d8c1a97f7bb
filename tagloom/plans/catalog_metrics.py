"""Registered queries: confusion counts, precision/recall/F1, agreement, thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import agreement, metrics, predictions
from tagloom.operators import thresholds as th
from tagloom.operators.sampling import split_hash_share
from tagloom.plans import views
from tagloom.plans.catalog_labels import PAIR_VIEWS, PAIRS, two_taggers
from tagloom.plans.registry import query
from tagloom.plans.views import sql

THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5)
TRAIN_SHARE = 0.002  # of the documents; small enough that some labels are not in it

# Rounds spelled out in the SQL of the threshold search; it stays where it is
# once no label moves, so more rounds than the search takes do not matter.
SQL_ROUNDS = 12


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, so that both engines show the same."""
    return df.select(
        *[
            F.round(c, 6).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def n_docs(spark: SparkSession, d: str) -> int:
    return views.docs(spark, d).count()


N_DOCS = "(SELECT count(*) FROM docs)"


def share(part: str, whole: str) -> str:
    return f"round(CASE WHEN ({whole}) = 0 THEN 0.0 ELSE CAST({part} AS DOUBLE) / ({whole}) END, 6)"


PRF = (
    f"{share('tp', 'pp')} AS precision, {share('tp', 'positives')} AS recall, "
    f"{share('2 * tp', 'pp + positives')} AS f1"
)

JUDGED = """
    SELECT coalesce(t.doc_id, s.doc_id) AS doc_id, coalesce(t.label, s.label) AS label,
           CASE WHEN t.label IS NULL THEN 0 ELSE 1 END AS y, coalesce(s.score, 0.0) AS score
    FROM truth t FULL JOIN scores_a s ON t.doc_id = s.doc_id AND t.label = s.label"""

STEPS = "SELECT unnest([CAST(0.1 AS DOUBLE), 0.2, 0.3, 0.4, 0.5]) AS threshold"


@query(
    "agg_confusion",
    sql(
        f"""SELECT CAST({N_DOCS} - sum(p) - sum(y) + sum(y * p) AS BIGINT) AS tn,
                   CAST(sum(p) - sum(y * p) AS BIGINT) AS fp,
                   CAST(sum(y) - sum(y * p) AS BIGINT) AS fn, CAST(sum(y * p) AS BIGINT) AS tp
            FROM (SELECT y, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS p FROM judged
                  WHERE label = 'Brand#3')""",
        "docs", "truth", "scores_a", judged=JUDGED,
    ),
)
def agg_confusion(spark: SparkSession, d: str) -> DataFrame:
    own = views.truth(spark, d).filter("label = 'Brand#3'").select("doc_id")
    hits = views.scores_a(spark, d).filter("label = 'Brand#3' AND score > 0.5").select("doc_id")
    return metrics.confusion(own, hits, n_docs(spark, d))


@query(
    "agg_confusion_multilabel",
    sql(
        f"""SELECT label, threshold,
                   CAST({N_DOCS} - sum(p) - sum(y) + sum(y * p) AS BIGINT) AS tn,
                   CAST(sum(p) - sum(y * p) AS BIGINT) AS fp,
                   CAST(sum(y) - sum(y * p) AS BIGINT) AS fn, CAST(sum(y * p) AS BIGINT) AS tp
            FROM (SELECT label, threshold, coalesce(y, 0) AS y,
                         CASE WHEN score > threshold THEN 1 ELSE 0 END AS p
                  FROM vocabulary LEFT JOIN judged USING (label), steps) GROUP BY label, threshold""",
        "docs", "truth", "scores_a", "vocabulary", judged=JUDGED, steps=STEPS,
    ),
)
def agg_confusion_multilabel(spark: SparkSession, d: str) -> DataFrame:
    return metrics.confusion_counts(
        views.truth(spark, d), views.scores_a(spark, d), n_docs(spark, d),
        views.vocabulary(spark, d), THRESHOLDS,
    )


MICRO = sql(
    f"""SELECT threshold, {PRF} FROM (
          SELECT threshold, sum(CASE WHEN score > threshold THEN y ELSE 0 END) AS tp,
                 sum(CASE WHEN score > threshold THEN 1 ELSE 0 END) AS pp, sum(y) AS positives
          FROM judged, steps GROUP BY threshold)""",
    "truth", "scores_a", judged=JUDGED, steps=STEPS,
)


@query("agg_micro_prf", MICRO)
def agg_micro_prf(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        metrics.micro_prf(views.truth(spark, d), views.scores_a(spark, d), THRESHOLDS)
    )


@query("agg_pr_curve", f"{MICRO} ORDER BY threshold")
def agg_pr_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.pr_curve(views.truth(spark, d), views.scores_a(spark, d)))


def report_sql(vocabulary: str) -> str:
    parts = ("precision", "recall", "f1")
    exact = PRF.replace("round(", "(").replace(", 6)", ")")
    return sql(
        f"""SELECT 0.5 :: DOUBLE AS threshold, label AS name, round(precision, 6) AS precision,
                   round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM per_label
            UNION ALL
            SELECT 0.5, 'micro avg', {PRF}, positives FROM (
              SELECT sum(tp) AS tp, sum(pp) AS pp, CAST(sum(positives) AS BIGINT) AS positives FROM per_label)
            UNION ALL
            SELECT 0.5, 'macro avg', {', '.join(f'round(avg({p}), 6)' for p in parts)},
                   CAST(sum(support) AS BIGINT) FROM per_label
            UNION ALL
            SELECT 0.5, 'weighted avg', {', '.join(f'round(sum({p} * support) / sum(support), 6)' for p in parts)},
                   CAST(sum(support) AS BIGINT) FROM per_label
            UNION ALL
            SELECT 0.5, 'samples avg', {', '.join(f'round(sum({p}) / {N_DOCS}, 6)' for p in parts)},
                   CAST(sum(positives) AS BIGINT) FROM per_doc""",
        "docs", "truth", "scores_a",
        used=vocabulary,
        judged=JUDGED,
        flags="""SELECT doc_id, label, y, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS p FROM judged
                 WHERE label IN (SELECT label FROM used)""",
        per_label=f"""SELECT *, {exact}, positives AS support FROM (
            SELECT label, CAST(coalesce(sum(y * p), 0) AS BIGINT) AS tp,
                   CAST(coalesce(sum(p), 0) AS BIGINT) AS pp,
                   CAST(coalesce(sum(y), 0) AS BIGINT) AS positives
            FROM used LEFT JOIN flags USING (label) GROUP BY label)""",
        per_doc=f"""SELECT *, {exact} FROM (
            SELECT doc_id, CAST(sum(y * p) AS BIGINT) AS tp, CAST(sum(p) AS BIGINT) AS pp,
                   CAST(sum(y) AS BIGINT) AS positives FROM flags GROUP BY doc_id)""",
    )


@query("agg_class_report", report_sql("SELECT DISTINCT p_brand AS label FROM part"))
def agg_class_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        metrics.class_report(
            views.truth(spark, d), views.scores_a(spark, d), n_docs(spark, d),
            views.vocabulary(spark, d),
        )
    )


@query(
    "agg_class_report_pruned",
    report_sql(
        f"""SELECT DISTINCT label FROM truth
            WHERE ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT < {int(TRAIN_SHARE * 2**32)}"""
    ),
)
def agg_class_report_pruned(spark: SparkSession, d: str) -> DataFrame:
    """Only labels that a small training part of the documents has."""
    truth = views.truth(spark, d)
    parts = split_hash_share(truth, "doc_id", TRAIN_SHARE)  # the share is the training part
    seen = parts.filter("split = 'test'").select("label").distinct()
    return rounded(
        metrics.class_report_pruned(truth, views.scores_a(spark, d), n_docs(spark, d), seen)
    )


@query(
    "agg_f1_per_tag",
    sql(
        f"""SELECT label AS "Tag", {share('2 * tp', 'pp + positives')} AS f1 FROM (
              SELECT label, coalesce(sum(CASE WHEN score > 0.5 THEN y ELSE 0 END), 0) AS tp,
                     coalesce(sum(CASE WHEN score > 0.5 THEN 1 ELSE 0 END), 0) AS pp,
                     coalesce(sum(y), 0) AS positives
              FROM vocabulary LEFT JOIN judged USING (label) GROUP BY label)""",
        "truth", "scores_a", "vocabulary", judged=JUDGED,
    ),
)
def agg_f1_per_tag(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        metrics.f1_per_tag(
            views.truth(spark, d), views.scores_a(spark, d), views.vocabulary(spark, d)
        )
    )


@query(
    "agg_label_min_score",
    sql(
        """SELECT label, CASE WHEN n < total THEN least(low, 0.0) ELSE low END AS min_score FROM (
             SELECT label, min(low) AS low, count(DISTINCT l_orderkey) AS n FROM (
               SELECT l_orderkey, unnest([p_type, 'any']) AS label, l_quantity AS low FROM lines)
             GROUP BY label), (SELECT count(DISTINCT l_orderkey) AS total FROM lines)""",
        "lines",
    ),
)
def agg_label_min_score(spark: SparkSession, d: str) -> DataFrame:
    """Part types, and any part at all, scored by quantity over all documents: a type misses
    documents, any part does not."""
    rows = views.lines(spark, d).select(
        F.col("l_orderkey").alias("doc_id"),
        F.explode(F.array("p_type", F.lit("any"))).alias("label"),
        "l_quantity",
    )
    scores = rows.groupBy("doc_id", "label").agg(F.min("l_quantity").alias("score"))
    return metrics.label_min_score(scores, views.docs(spark, d).count())


@query(
    "agg_kappa",
    sql(
        f"""SELECT round(avg((po - pe) / (1 - pe)), 6) AS avg_cohen_kappa FROM (
              SELECT (ab + (n - a - b + ab)) / n AS po,
                     (a / n) * (b / n) + ((n - a) / n) * ((n - b) / n) AS pe
              FROM (SELECT CAST((SELECT count(*) FROM pairs) AS DOUBLE) AS n,
                           sum(CASE WHEN list_contains(a_terms, label) THEN 1.0 ELSE 0.0 END) :: DOUBLE AS a,
                           sum(CASE WHEN list_contains(b_terms, label) THEN 1.0 ELSE 0.0 END) :: DOUBLE AS b,
                           sum(CASE WHEN list_contains(a_terms, label) AND list_contains(b_terms, label)
                               THEN 1.0 ELSE 0.0 END) :: DOUBLE AS ab
                    FROM pairs, vocabulary GROUP BY label) WHERE a + b > 0)""",
        *PAIR_VIEWS, "vocabulary", pairs=PAIRS,
    ),
)
def agg_kappa(spark: SparkSession, d: str) -> DataFrame:
    pairs = two_taggers(spark, d)
    return rounded(agreement.average_kappa(pairs, views.vocabulary(spark, d), n_docs(spark, d)))


@query(
    "agg_avg_tags",
    sql(
        """SELECT round(sum(len(a_terms)) / CAST(count(*) AS DOUBLE), 6) AS a_avg_num_tags,
                  round(sum(len(b_terms)) / CAST(count(*) AS DOUBLE), 6) AS b_avg_num_tags FROM pairs""",
        *PAIR_VIEWS, pairs=PAIRS,
    ),
)
def agg_avg_tags(spark: SparkSession, d: str) -> DataFrame:
    pairs = two_taggers(spark, d)
    return rounded(agreement.average_tags(pairs, views.vocabulary(spark, d), n_docs(spark, d)))


@query(
    "agg_jaccard_samples",
    sql(
        """SELECT round(avg(CASE WHEN len(either) = 0 THEN 0.0
                     ELSE len(list_intersect(a_terms, b_terms)) / CAST(len(either) AS DOUBLE) END), 6) AS jaccard_score
           FROM (SELECT *, list_distinct(list_concat(a_terms, b_terms)) AS either FROM pairs)""",
        *PAIR_VIEWS, pairs=PAIRS,
    ),
)
def agg_jaccard_samples(spark: SparkSession, d: str) -> DataFrame:
    return rounded(agreement.jaccard_samples(two_taggers(spark, d)))


@query(
    "apply_threshold",
    sql(
        """SELECT doc_id, coalesce(string_agg(label, '|' ORDER BY label) FILTER (score > 0.5), '') AS tags
           FROM docs LEFT JOIN scores_a USING (doc_id) GROUP BY doc_id""",
        "docs", "scores_a",
    ),
)
def apply_threshold(spark: SparkSession, d: str) -> DataFrame:
    tagged = predictions.apply_threshold(views.scores_a(spark, d), 0.5, views.docs(spark, d))
    return tagged.select("doc_id", F.concat_ws("|", "tags").alias("tags"))


@query(
    "format_predictions",
    sql(
        """SELECT doc_id,
                  coalesce(string_agg(label, '|' ORDER BY label) FILTER (score >= 0.5), '') AS tags,
                  coalesce(sum(score) FILTER (score >= 0.5), 0.0) AS total
           FROM (SELECT o_orderkey AS doc_id FROM orders) LEFT JOIN scores_b USING (doc_id)
           GROUP BY doc_id""",
        "scores_b",
    ),
)
def format_predictions(spark: SparkSession, d: str) -> DataFrame:
    """The map form; its keys and the sum of its values are shown. Some orders have no score."""
    orders = views.table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"))
    mapped = predictions.format_predictions(views.scores_b(spark, d), 0.5, True, orders)
    total = F.aggregate(F.map_values("tags"), F.lit(0.0), lambda a, v: a + v)
    return mapped.select(
        "doc_id", F.concat_ws("|", F.map_keys("tags")).alias("tags"), F.round(total, 6).alias("total")
    )


LIMITS = """SELECT p_brand AS label, avg(p_size) / 50.0 AS threshold FROM part
            WHERE p_brand NOT IN ('Brand#3', 'Brand#14') GROUP BY 1"""


@query(
    "apply_label_thresholds",
    sql(
        """SELECT doc_id, label, score FROM scores_a LEFT JOIN limits USING (label)
           WHERE score > coalesce(threshold, 0.75)""",
        "scores_a", limits=LIMITS,
    ),
)
def apply_label_thresholds(spark: SparkSession, d: str) -> DataFrame:
    """Two labels have no threshold of their own and take the default."""
    known = views.table(spark, d, "part").filter(~F.col("p_brand").isin("Brand#3", "Brand#14"))
    limits = known.groupBy(F.col("p_brand").alias("label")).agg(
        (F.avg("p_size") / F.lit(50.0)).alias("threshold")
    )
    return th.apply_label_thresholds(views.scores_a(spark, d), limits, default=0.75)


def search_sql(truth: str, scores: str, total: str, rounds: int = SQL_ROUNDS) -> dict[str, str]:
    """The threshold search as a chain of WITH clauses; the last one is ``final``."""
    steps = {
        "scored": f"""SELECT s.label, s.score, count(*) AS n, count(t.label) AS pos
            FROM {scores} s LEFT JOIN {truth} t ON s.doc_id = t.doc_id AND s.label = t.label
            GROUP BY 1, 2""",
        "totals": f"""SELECT v.label, coalesce(p.positives, 0) AS positives,
                   coalesce(q.stored, 0) AS stored, coalesce(q.found, 0) AS found
            FROM vocabulary v
            LEFT JOIN (SELECT label, count(*) AS positives FROM {truth} GROUP BY 1) p ON v.label = p.label
            LEFT JOIN (SELECT label, sum(n) AS stored, sum(pos) AS found FROM scored GROUP BY 1) q
                   ON v.label = q.label""",
        "merged": f"""SELECT label, score, sum(n) AS n, sum(pos) AS pos FROM (
            SELECT * FROM scored UNION ALL
            SELECT label, 0.0, {total} - stored, positives - found FROM totals WHERE stored < {total})
            GROUP BY 1, 2""",
        "points": """SELECT label, score, tp, pp - tp AS fp, positives - tp AS fn FROM (
            SELECT m.label, score, positives,
                   CAST(sum(n) OVER w - n AS DOUBLE) AS pp, CAST(sum(pos) OVER w - pos AS DOUBLE) AS tp
            FROM merged m JOIN totals t ON m.label = t.label
            WINDOW w AS (PARTITION BY m.label ORDER BY score DESC ROWS UNBOUNDED PRECEDING))""",
        "state0": """SELECT label, min(score) AS threshold, arg_min(tp, score) AS tp,
                   arg_min(fp, score) AS fp, arg_min(fn, score) AS fn FROM points GROUP BY 1""",
    }
    for i in range(rounds):
        last = f"state{i}"
        higher = "WHERE score >= threshold" if i else ""
        steps[f"best{i}"] = f"""SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY label ORDER BY f1 DESC, score) AS place FROM (
              SELECT p.label, p.score, p.tp, p.fp, p.fn, s.threshold, g.f1 AS global_f1,
                     (g.tp + p.tp - s.tp) / ((g.tp + p.tp - s.tp)
                       + ((g.fp + p.fp - s.fp) + (g.fn + p.fn - s.fn)) / 2) AS f1
              FROM points p JOIN {last} s ON p.label = s.label,
                   (SELECT *, tp / (tp + (fp + fn) / 2) AS f1 FROM (
                      SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM {last})) g
              {higher}) WHERE f1 > global_f1) WHERE place = 1"""
        name = f"state{i + 1}" if i + 1 < rounds else "final"
        steps[name] = f"""SELECT s.label, coalesce(b.score, s.threshold) AS threshold,
                   coalesce(b.tp, s.tp) AS tp, coalesce(b.fp, s.fp) AS fp, coalesce(b.fn, s.fn) AS fn
            FROM {last} s LEFT JOIN best{i} b ON s.label = b.label"""
    return steps


@query(
    "tune_thresholds",
    sql(
        "SELECT label, threshold FROM final",
        "docs", "truth", "scores_c", "vocabulary", **search_sql("truth", "scores_c", N_DOCS),
    ),
)
def tune_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return th.tune_thresholds(
        views.truth(spark, d), views.scores_c(spark, d), n_docs(spark, d), views.vocabulary(spark, d)
    ).thresholds


def f1_sql(truth: str, hits: str) -> str:
    return f"""(SELECT round(2.0 * tp / (pp + positives), 6) FROM
        (SELECT CAST(count(*) AS DOUBLE) AS pp FROM {hits}),
        (SELECT CAST(count(*) AS DOUBLE) AS positives FROM {truth}),
        (SELECT CAST(count(*) AS DOUBLE) AS tp FROM {hits} h JOIN {truth} t
         ON h.doc_id = t.doc_id AND h.label = t.label))"""


@query(
    "eval_after_tuning",
    sql(
        f"""SELECT {f1_sql('val_truth', 'start_hits')} AS start_f1,
                   {f1_sql('test_truth', 'tuned_hits')} AS tuned_f1""",
        "docs", "truth", "scores_c", "vocabulary",
        parts="""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id))
                        <= floor(CAST(0.8 AS DOUBLE) * count(*) OVER ()) THEN 'val' ELSE 'test' END AS split
                 FROM docs""",
        val_truth="SELECT truth.* FROM truth JOIN parts USING (doc_id) WHERE split = 'val'",
        test_truth="SELECT truth.* FROM truth JOIN parts USING (doc_id) WHERE split = 'test'",
        val_scores="SELECT scores_c.* FROM scores_c JOIN parts USING (doc_id) WHERE split = 'val'",
        test_scores="SELECT scores_c.* FROM scores_c JOIN parts USING (doc_id) WHERE split = 'test'",
        **search_sql("val_truth", "val_scores", "(SELECT count(*) FROM parts WHERE split = 'val')"),
        start_hits="SELECT * FROM val_scores WHERE score > 0.2",
        tuned_hits="""SELECT s.* FROM test_scores s JOIN final f ON s.label = f.label
                      WHERE score > threshold""",
    ),
)
def eval_after_tuning(spark: SparkSession, d: str) -> DataFrame:
    _, result = th.eval_after_tuning(
        views.truth(spark, d), views.scores_c(spark, d), views.docs(spark, d),
        views.vocabulary(spark, d),
    )
    return rounded(result)

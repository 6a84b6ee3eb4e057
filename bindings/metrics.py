from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import SLICE_ROWS, fraction_sql, near, near_all, near_sql, query, table
from windrow.functions import numeric
from windrow.operators import evaluation, resampling, roc

REPLICATES = 1000


def argmax(first: int):
    part = F.slice("embedding", first, 10)
    return (F.array_position(part, F.array_max(part)) - 1).cast("int")


def predictions(spark, folder, first: int = 1):
    """Ten classes; the prediction is the position of the largest of ten coordinates."""
    return table(spark, folder, "embeddings").select(
        "vec_id", "label", argmax(first).alias("prediction"))


def binary_predictions(spark, folder):
    """Quality of a document against a rule on its length."""
    judged = table(spark, folder, "labels").join(
        table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id")
    return judged.select("doc_id", F.col("quality").alias("label"),
                         (F.col("n_chars") > 1000).cast("int").alias("prediction"))


def argmax_sql(first: int) -> str:
    part = f"embedding[{first}:{first + 9}]"
    return f"CAST(list_position({part}, list_max({part})) - 1 AS INTEGER)"


PREDICTED = f"p AS (SELECT vec_id, label, {argmax_sql(1)} AS prediction FROM embeddings)"
BINARY = ("p AS (SELECT doc_id, quality AS label, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS "
          "prediction FROM labels JOIN documents USING (doc_id))")
CLASSES = "c AS (SELECT label AS class FROM p UNION SELECT prediction FROM p)"
PER_CLASS = f"""{CLASSES},
s AS (SELECT class, (SELECT count(*) FROM p WHERE label = class) AS support,
             (SELECT count(*) FROM p WHERE prediction = class) AS predicted,
             (SELECT count(*) FROM p WHERE label = class AND prediction = class) AS hits FROM c),
r AS (SELECT class, support, predicted, hits,
             CASE WHEN predicted = 0 THEN 0.0 ELSE hits / predicted::DOUBLE END AS precision,
             CASE WHEN support = 0 THEN 0.0 ELSE hits / support::DOUBLE END AS recall,
             CASE WHEN predicted + support = 0 THEN 0.0
                  ELSE 2.0 * hits / (predicted + support)::DOUBLE END AS f1_score FROM s)"""


@query(f"""WITH {PREDICTED}, {CLASSES},
g AS (SELECT a.class AS label, b.class AS prediction FROM c a, c b),
n AS (SELECT g.label, g.prediction, count(p.vec_id) AS n FROM g LEFT JOIN p
      ON p.label = g.label AND p.prediction = g.prediction GROUP BY 1, 2)
SELECT label, prediction, n, {near_sql('CASE WHEN sum(n) OVER (PARTITION BY label) = 0 THEN 0.0 '
       'ELSE n / (sum(n) OVER (PARTITION BY label))::DOUBLE END', 4)} AS normalised FROM n""")
def confusion_long(spark, folder):
    cells = evaluation.confusion_cells(predictions(spark, folder))
    return near_all(evaluation.confusion_matrix(cells), ["normalised"], 4)


@query(f"WITH {PREDICTED}, {CLASSES} SELECT class FROM c")
def classes_seen(spark, folder):
    return evaluation.classes_seen(evaluation.confusion_cells(predictions(spark, folder)))


@query(f"""WITH {PREDICTED}, {PER_CLASS} SELECT class, {near_sql('precision', 4)} AS precision,
           {near_sql('recall', 4)} AS recall, {near_sql('f1_score', 4)} AS f1_score, support FROM r""")
def class_report(spark, folder):
    cells = evaluation.confusion_cells(predictions(spark, folder))
    return near_all(evaluation.class_report(cells), ["precision", "recall", "f1_score"], 4)


def _overall_sql(source: str) -> str:
    return f"""WITH {source}, {PER_CLASS}, t AS (SELECT sum(support)::DOUBLE AS n FROM r)
SELECT CAST(max(n) AS BIGINT) AS n_rows, {near_sql('sum(hits) / max(n)')} AS accuracy,
       {near_sql('sum(precision * support) / max(n)')} AS precision_weighted,
       {near_sql('sum(recall * support) / max(n)')} AS recall_weighted,
       {near_sql('sum(f1_score * support) / max(n)')} AS f1_weighted,
       {near_sql('avg(f1_score)')} AS f1_macro FROM r, t"""


@query(_overall_sql(PREDICTED))
def overall_metrics(spark, folder):
    made = evaluation.overall_metrics(evaluation.confusion_cells(predictions(spark, folder)))
    made = made.drop("cohen_kappa", "mcc")
    return near_all(made, made.columns[1:])


@query(_overall_sql(BINARY))
def overall_metrics_binary(spark, folder):
    made = evaluation.overall_metrics(evaluation.confusion_cells(binary_predictions(spark, folder)))
    made = made.drop("cohen_kappa", "mcc")
    return near_all(made, made.columns[1:])


@query(f"""WITH {PREDICTED}, {PER_CLASS}, m AS (
  SELECT sum(support)::DOUBLE AS s, sum(hits)::DOUBLE AS c,
         sum(support * predicted)::DOUBLE AS pt, sum(support * support)::DOUBLE AS tt,
         sum(predicted * predicted)::DOUBLE AS pp FROM r)
SELECT {near_sql('(c / s - pt / (s * s)) / (1 - pt / (s * s))')} AS cohen_kappa,
       {near_sql('CASE WHEN (s * s - pp) * (s * s - tt) = 0 THEN 0.0 ELSE '
                 '(c * s - pt) / sqrt((s * s - pp) * (s * s - tt)) END')} AS mcc FROM m""")
def kappa_mcc(spark, folder):
    made = evaluation.overall_metrics(evaluation.confusion_cells(predictions(spark, folder)))
    return made.select(near("cohen_kappa").alias("cohen_kappa"), near("mcc").alias("mcc"))


def scored(spark, folder):
    """Ten scores per row, rounded so that many rows share a score."""
    scores = F.transform(F.slice("embedding", 1, 10), lambda x: F.round(x.cast("double"), 2))
    return table(spark, folder, "embeddings").select("vec_id", "label", scores.alias("scores"))


def cumulative(spark, folder):
    return roc.cumulative_counts(roc.one_vs_rest(scored(spark, folder), "label", "scores"),
                                 SLICE_ROWS)


CURVES = """
o AS (SELECT CAST(i AS INTEGER) AS class, round(CAST(embedding[i + 1] AS DOUBLE), 2) AS score,
             label = i AS hit FROM embeddings, range(0, 10) t(i)),
d AS (SELECT class, score, count(*) FILTER (hit) AS pos, count(*) FILTER (NOT hit) AS neg
      FROM o GROUP BY 1, 2),
u AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY class)
      AS n_pos, sum(neg) OVER (PARTITION BY class) AS n_neg FROM d
      WINDOW w AS (PARTITION BY class ORDER BY score DESC)),
q AS (SELECT class, fp::DOUBLE AS fp, tp::DOUBLE AS tp, n_pos::DOUBLE AS n_pos,
             n_neg::DOUBLE AS n_neg, score FROM u
      UNION ALL SELECT DISTINCT class, 0, 0, n_pos, n_neg, NULL FROM u)"""


@query(f"""WITH {CURVES} SELECT class, {near_sql('fp / n_neg', 5)} AS fpr,
           {near_sql('tp / n_pos', 5)} AS tpr, score AS threshold FROM q""")
def roc_ovr(spark, folder):
    return near_all(roc.roc_points(cumulative(spark, folder)), ["fpr", "tpr"], 5)


AUC = f"""{CURVES},
a AS (SELECT class, sum((fp - pf) * (tp + pt) / 2.0) / any_value(n_pos * n_neg) AS auc FROM (
        SELECT *, lag(fp) OVER w AS pf, lag(tp) OVER w AS pt FROM q
        WINDOW w AS (PARTITION BY class ORDER BY score DESC NULLS FIRST)) GROUP BY 1)"""


@query(f"WITH {AUC} SELECT class, {near_sql('auc')} AS auc FROM a")
def auc_ovr(spark, folder):
    return roc.auc(cumulative(spark, folder)).select("class", near("auc").alias("auc"))


MACRO = f"""{CURVES},
g AS (SELECT CAST(i AS INTEGER) AS step FROM range(0, 200) t(i)),
l AS (SELECT class, step, max(fp) AS lf FROM q JOIN g ON fp * 199 <= step * n_neg GROUP BY 1, 2),
r AS (SELECT class, step, min(fp) AS rf FROM q JOIN g ON fp * 199 > step * n_neg GROUP BY 1, 2),
v AS (SELECT l.class, l.step, lf, rf, max(a.tp / a.n_pos) AS lt, max(a.n_neg) AS nn
      FROM l JOIN q a ON a.class = l.class AND a.fp = lf
      LEFT JOIN r ON r.class = l.class AND r.step = l.step GROUP BY 1, 2, 3, 4),
y AS (SELECT v.class, v.step, any_value(lf / nn) AS x0, any_value(lt) AS y0, any_value(rf / nn) AS x1,
             min(b.tp / b.n_pos) AS y1 FROM v LEFT JOIN q b ON b.class = v.class AND b.fp = rf
      GROUP BY 1, 2),
m AS (SELECT step, step / 199.0 AS fpr,
             avg(coalesce(y0 + (y1 - y0) / (x1 - x0) * (step / 199.0 - x0), y0)) AS tpr
      FROM y GROUP BY 1)"""


@query(f"WITH {MACRO} SELECT step, {near_sql('fpr')} AS fpr, {near_sql('tpr')} AS tpr FROM m")
def roc_macro(spark, folder):
    return near_all(roc.macro_roc(cumulative(spark, folder)), ["fpr", "tpr"])


@query(f"""WITH {MACRO} SELECT {near_sql('sum(w)')} AS auc FROM (
  SELECT (fpr - lag(fpr) OVER (ORDER BY step)) * (tpr + lag(tpr) OVER (ORDER BY step)) / 2 AS w FROM m)""")
def roc_macro_auc(spark, folder):
    made = roc.curve_area(roc.macro_roc(cumulative(spark, folder)))
    return made.select(near("auc").alias("auc"))


@query(f"""WITH {AUC}, {MACRO[len(CURVES) + 1:].strip()}
SELECT CAST(q.class AS VARCHAR) AS class, {near_sql('fp / n_neg', 5)} AS fpr,
       {near_sql('tp / n_pos', 5)} AS tpr, {near_sql('auc', 4)} AS auc FROM q JOIN a USING (class)
UNION ALL
SELECT 'MACRO_AVG', {near_sql('fpr', 5)}, {near_sql('tpr', 5)}, (SELECT {near_sql('sum(w)', 4)} FROM (
  SELECT (fpr - lag(fpr) OVER (ORDER BY step)) * (tpr + lag(tpr) OVER (ORDER BY step)) / 2 AS w FROM m))
FROM m""")
def roc_report(spark, folder):
    made = roc.roc_report(cumulative(spark, folder))
    return near_all(near_all(made, ["fpr", "tpr"], 5), ["auc"], 4).drop("threshold")


def _polynomial_sql(coefficients, x: str) -> str:
    text = repr(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c!r})"
    return text


def _bootstrap_sql(source: str) -> str:
    fraction = fraction_sql("label", "prediction", "replicate")
    return f"""WITH {source},
k AS (SELECT label, prediction, count(*)::DOUBLE AS n FROM p GROUP BY 1, 2),
cdf AS (SELECT label, prediction, sum(exp(i * ln(n) - n - lgamma(i + 1))) OVER (
          PARTITION BY label, prediction ORDER BY i) AS cdf
        FROM k, unnest(range(0, CAST(ceil(n + 10 * sqrt(n)) + 60 AS BIGINT))) t(i)),
u AS (SELECT label, prediction, replicate, least(greatest({fraction}, 1e-10), 1 - 1e-10) AS u
      FROM k, range(1, {REPLICATES + 1}) t(replicate)),
d AS (SELECT label, prediction, replicate, count(*) FILTER (cdf < u) AS n
      FROM u JOIN cdf USING (label, prediction) GROUP BY 1, 2, 3),
e AS (SELECT replicate, class, sum(t)::DOUBLE AS support, sum(g)::DOUBLE AS predicted,
             sum(h)::DOUBLE AS hits FROM (
        SELECT replicate, label AS class, n AS t, 0 AS g,
               CASE WHEN label = prediction THEN n ELSE 0 END AS h FROM d
        UNION ALL SELECT replicate, prediction, 0, n, 0 FROM d) GROUP BY 1, 2),
m AS (SELECT replicate, sum(hits) / sum(support) AS accuracy, sum(support * CASE WHEN support + predicted
        = 0 THEN 0 ELSE 2 * hits / (support + predicted) END) / sum(support) AS f1_weighted
      FROM e GROUP BY 1),
{PER_CLASS.replace('c AS (', 'cc AS (').replace('FROM c)', 'FROM cc)')}
SELECT 'accuracy' AS metric, {near_sql('(SELECT sum(hits) / sum(support) FROM r)', 4)} AS observed,
       {near_sql('quantile_cont(accuracy, 0.025)', 4)} AS ci_lower,
       {near_sql('quantile_cont(accuracy, 0.975)', 4)} AS ci_upper, {REPLICATES} AS n_boot FROM m
UNION ALL
SELECT 'f1_weighted', {near_sql('(SELECT sum(f1_score * support) / sum(support) FROM r)', 4)},
       {near_sql('quantile_cont(f1_weighted, 0.025)', 4)},
       {near_sql('quantile_cont(f1_weighted, 0.975)', 4)}, {REPLICATES} FROM m"""


@query(_bootstrap_sql(PREDICTED))
def bootstrap_ci(spark, folder):
    """Many small cells."""
    cells = evaluation.confusion_cells(predictions(spark, folder))
    return near_all(resampling.bootstrap_intervals(cells, REPLICATES),
                    ["observed", "ci_lower", "ci_upper"], 4)


@query(_bootstrap_sql(BINARY))
def bootstrap_ci_binary(spark, folder):
    """Few large cells."""
    cells = evaluation.confusion_cells(binary_predictions(spark, folder))
    return near_all(resampling.bootstrap_intervals(cells, REPLICATES),
                    ["observed", "ci_lower", "ci_upper"], 4)


_T = f"(1 / (1 + {numeric.ERF_P} * sqrt(statistic / 2)))"


def _mcnemar_sql(pairs: str, missing: str = "") -> str:
    return f"""
WITH {pairs},
t AS (SELECT count(*) FILTER (a AND b) AS b00, count(*) FILTER (a AND NOT b) AS b01,
             count(*) FILTER (NOT a AND b) AS b10, count(*) FILTER (NOT a AND NOT b) AS b11
             {missing} FROM p),
s AS (SELECT *, CASE WHEN b01 + b10 = 0 THEN 0.0
             ELSE (abs(b01 - b10) - 1) ** 2 / (b01 + b10)::DOUBLE END AS statistic FROM t),
v AS (SELECT *, CASE WHEN b01 + b10 = 0 THEN 1.0 ELSE {_polynomial_sql(
      tuple(reversed(numeric.ERF_COEFFICIENTS)), _T)} * {_T} * exp(-statistic / 2) END AS p FROM s)
SELECT 'first' AS model_a, 'second' AS model_b, b00, b01, b10, b11,
       {"n_only_a, n_only_b, n_null, " if missing else ""}
       {near_sql('statistic', 4)} AS statistic, {near_sql('p', 6)} AS p_value,
       CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS decision FROM v"""


@query(_mcnemar_sql(f"p AS (SELECT label = {argmax_sql(1)} AS a, label = {argmax_sql(11)} AS b "
                    "FROM embeddings)"))
def mcnemar(spark, folder):
    made = evaluation.mcnemar(predictions(spark, folder), predictions(spark, folder, 11), "vec_id",
                              names=("first", "second")).drop("n_only_a", "n_only_b", "n_null")
    return near_all(near_all(made, ["statistic"], 4), ["p_value"], 6)


@query(_mcnemar_sql(f"""
x AS (SELECT vec_id, CASE WHEN vec_id % 11 <> 2 THEN label = {argmax_sql(1)} END AS a FROM embeddings
      WHERE vec_id % 7 <> 3),
y AS (SELECT vec_id, label = {argmax_sql(11)} AS b FROM embeddings WHERE vec_id % 5 <> 1),
p AS (SELECT a, b, x.vec_id AS i, y.vec_id AS j FROM x FULL JOIN y ON x.vec_id = y.vec_id)""", """,
             count(*) FILTER (j IS NULL) AS n_only_a, count(*) FILTER (i IS NULL) AS n_only_b,
             count(*) FILTER (i IS NOT NULL AND j IS NOT NULL AND (a IS NULL OR b IS NULL)) AS n_null"""))
def mcnemar_unmatched(spark, folder):
    """Two prediction tables that lack different rows, one of them some predictions as well."""
    first = predictions(spark, folder).filter("vec_id % 7 <> 3").withColumn(
        "prediction", F.when(F.col("vec_id") % 11 != 2, F.col("prediction")))
    second = predictions(spark, folder, 11).filter("vec_id % 5 <> 1")
    made = evaluation.mcnemar(first, second, "vec_id", names=("first", "second"))
    return near_all(near_all(made, ["statistic"], 4), ["p_value"], 6)

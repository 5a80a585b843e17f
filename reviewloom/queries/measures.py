"""Metrics, distributions and the bias audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.functions.hashing import uniform
from reviewloom.functions.text import WHITESPACE, char_len, sentences, word_count
from reviewloom.operators import bias, distribution
from reviewloom.operators import metrics as M
from reviewloom.operators.moderate import mistakes as find_mistakes
from reviewloom.queries.base import REVIEWS, query, reviews, sentences_sql, table, unit


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _ten_classes(spark, d):
    """Ten-class predictions that are right for about seven vectors in ten."""
    u = uniform(7, "vec_id")
    wrong = F.pmod(F.col("label") + F.lit(1) + F.floor(u * 20).cast("int"), F.lit(10))
    return table(spark, d, "embeddings").select("vec_id", "label", F.when(u < 0.7, F.col("label")).otherwise(wrong).cast("int").alias("p"))


_TEN = f"""(select label, case when u < 0.7 then label else cast((label + 1 + floor(u * 20)::int) % 10 as int) end as p
  from (select *, {unit('vec_id', seed=7)} as u from embeddings))"""

_COUNTS = f"""(select count(*) filter (toxic = 0 and flagged_p = 0) as tn, count(*) filter (toxic = 0 and flagged_p = 1) as fp,
  count(*) filter (toxic = 1 and flagged_p = 0) as fn, count(*) filter (toxic = 1 and flagged_p = 1) as tp from {REVIEWS})"""

_PER_CLASS = f"""(select class, sum(tp) as tp, sum(actual) as support, sum(predicted) as predicted from (
    select label as class, case when label = p then 1 else 0 end as tp, 1 as actual, 0 as predicted from {_TEN}
    union all select p, 0, 0, 1 from {_TEN}) group by class)"""

_REPORT = f"""(select class, case when predicted = 0 then {{zero}} else tp::double / predicted end as precision,
    case when support = 0 then {{zero}} else tp::double / support end as recall, 2.0::double * tp / (predicted + support) as f1,
    support, tp, predicted from {_PER_CLASS})"""


@query("confusion_matrix", f"select * from {_COUNTS}")
def confusion_matrix(spark, d):
    return M.confusion_binary(reviews(spark, d), "toxic", "flagged_p")


@query(
    "confusion_multiclass",
    f"""with t as {_TEN}, k as (select distinct c from (select label as c from t union all select p from t))
    select a.c as actual, b.c as predicted, count(t.p) as n from k a cross join k b
    left join t on t.label = a.c and t.p = b.c group by a.c, b.c""",
)
def confusion_multiclass(spark, d):
    return M.confusion(_ten_classes(spark, d), "label", "p")


@query(
    "binary_metrics",
    f"""select tn, fp, fn, tp, round(tp::double / (tp + fp), 6) as precision, round(tp::double / (tp + fn), 6) as recall,
    round(2.0::double * tp / (2 * tp + fp + fn), 6) as f1 from {_COUNTS}""",
)
def binary_metrics(spark, d):
    return rounded(M.binary_metrics(reviews(spark, d), "toxic", "flagged_p"), "precision", "recall", "f1")


@query(
    "fbeta",
    f"""select beta, round((1 + beta * beta) * tp / ((1 + beta * beta) * tp + beta * beta * fn + fp), 6) as fbeta
    from {_COUNTS}, (values (0.75::double), (1.0::double), (2.0::double)) b(beta)""",
)
def fbeta(spark, d):
    return rounded(M.fbeta(reviews(spark, d), "toxic", "flagged_p", [0.75, 1.0, 2.0]), "fbeta")


@query(
    "multiclass_metrics",
    f"""select round(avg(f1), 6) as f1_macro, round(2.0::double * sum(tp) / (sum(predicted) + sum(support)), 6) as f1_micro,
    round(avg(recall), 6) as recall_macro from {_REPORT.format(zero='0')}""",
)
def multiclass_metrics(spark, d):
    return rounded(M.multiclass_metrics(_ten_classes(spark, d), "label", "p"), "f1_macro", "f1_micro", "recall_macro")


@query(
    "weighted_metrics",
    f"""select round(sum(tp)::double / sum(support), 6) as accuracy, round(sum(precision * support) / sum(support), 6) as precision_weighted,
    round(sum(recall * support) / sum(support), 6) as recall_weighted, round(sum(f1 * support) / sum(support), 6) as f1_weighted
    from {_REPORT.format(zero='1')}""",
)
def weighted_metrics(spark, d):
    out = M.weighted_metrics(_ten_classes(spark, d), "label", "p")
    return rounded(out, *out.columns)


@query(
    "class_report",
    f"""select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
    cast(support as bigint) as support from {_REPORT.format(zero='0')}""",
)
def class_report(spark, d):
    return rounded(M.class_report(_ten_classes(spark, d), "label", "p"), "precision", "recall", "f1").drop("tp", "predicted")


@query(
    "error_rates",
    f"""select lang, round(count(*) filter (toxic = 0 and flagged_p = 1) / nullif(count(*) filter (toxic = 0), 0)::double, 6) as false_positive_rate,
    round(count(*) filter (toxic = 1 and flagged_p = 0) / nullif(count(*) filter (toxic = 1), 0)::double, 6) as false_negative_rate
    from {REVIEWS} group by lang""",
)
def error_rates(spark, d):
    return rounded(M.error_rates(reviews(spark, d), "toxic", "flagged_p", by=["lang"]), "false_positive_rate", "false_negative_rate")


@query(
    "accuracy_ci",
    f"""with a as (select count(*) as n, avg(case when toxic = flagged_p then 1.0::double else 0 end) as accuracy from {REVIEWS})
    select n, round(accuracy, 6) as accuracy, round(greatest(accuracy - 1.959963984540054 * sqrt(accuracy * (1 - accuracy) / n), 0), 6) as ci_low,
    round(least(accuracy + 1.959963984540054 * sqrt(accuracy * (1 - accuracy) / n), 1), 6) as ci_high from a""",
)
def accuracy_ci(spark, d):
    return rounded(M.accuracy_ci(reviews(spark, d), "toxic", "flagged_p"), "accuracy", "ci_low", "ci_high")


@query("class_counts", f"select lang, toxic, count(*) as n from {REVIEWS} group by lang, toxic")
def class_counts(spark, d):
    return M.class_counts(reviews(spark, d), "lang", "toxic")


@query(
    "mistakes",
    f"""select doc_id, case when flagged_p = 1 then 'False Pos' else 'False Neg' end as mistake, n_chars as score, text
    from {REVIEWS} where toxic <> flagged_p""",
)
def mistakes(spark, d):
    return find_mistakes(reviews(spark, d), "toxic", "flagged_p", "n_chars", "text", keep=["doc_id"])


@query(
    "box_stats",
    f"""with t as (select lang, length(text)::double as x from documents),
      b as (select lang, count(*) as n, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as median, quantile_cont(x, 0.75) as q3 from t group by lang)
    select t.lang, max(n) as n, round(max(q1), 6) as q1, round(max(median), 6) as median, round(max(q3), 6) as q3,
      min(x) filter (x >= q1 - 1.5 * (q3 - q1)) as whisker_low, max(x) filter (x <= q3 + 1.5 * (q3 - q1)) as whisker_high
    from t join b on t.lang = b.lang group by t.lang""",
)
def box_stats(spark, d):
    rows = table(spark, d, "documents").select("lang", char_len("text").alias("x"))
    return rounded(distribution.box_stats(rows, "lang", "x"), "q1", "median", "q3")


@query(
    "histogram",
    f"""with t as (select event_type, value as x from events), e as (select event_type, min(x) as lo, max(x) as hi from t group by event_type)
    select t.event_type, cast(case when hi = lo then 0 else least(floor((x - lo) / ((hi - lo) / 100.0::double)), 99) end as int) as bin, count(*) as n
    from t join e on t.event_type = e.event_type group by all""",
)
def histogram(spark, d):
    return distribution.histogram(table(spark, d, "events"), "event_type", "value")


_MOMENTS = """count(*) filter (g = 1) as n1, count(*) filter (g = 2) as n2, avg(x) filter (g = 1) as mean1, avg(x) filter (g = 2) as mean2,
  var_samp(x) filter (g = 1) as var1, var_samp(x) filter (g = 2) as var2"""
_POOLED = "((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2)"
_Z = "(greatest(u, n1 * n2 - u) - n1 * n2 / 2.0::double - 0.5) / sqrt(n1 * n2 / 12.0::double * ((n + 1) - ties / (n * (n - 1))))"

# A published approximation of the error function (Abramowitz and Stegun, 7.1.26; error below 1.5e-7).
_ERF_SCALE, _ERF = 0.3275911, (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
_ERF_SUM = " + ".join(f"{a}::double * power(1 / (1 + {_ERF_SCALE}::double * z / sqrt(2)), {k})" for k, a in enumerate(_ERF, start=1))
_P_OF_Z = f"case when z <= 0 then 1.0::double else round(({_ERF_SUM}) * exp(-z * z / 2), 4) end"

_BY_TOXIC = f"(select case when toxic = 1 then 1 else 2 end as g, length(text)::double as x from {REVIEWS})"


def _toxic_lengths(spark, d):
    return reviews(spark, d).select("toxic", char_len("text").alias("x"))


@query(
    "cohens_d",
    f"""select n1, n2, round(mean1, 6) as mean1, round(mean2, 6) as mean2, round((mean1 - mean2) / sqrt({_POOLED}), 6) as cohens_d
    from (select {_MOMENTS} from {_BY_TOXIC})""",
)
def cohens_d(spark, d):
    return rounded(bias.cohens_d(_toxic_lengths(spark, d), "toxic", "x"), "mean1", "mean2", "cohens_d")


@query(
    "mann_whitney_u",
    f"""with v as (select x, count(*) filter (g = 1) as k, count(*) as n from {_BY_TOXIC} group by x),
      c as (select *, sum(n) over (order by x rows unbounded preceding) as upto from v),
      s as (select sum(k) as n1, sum(n - k) as n2, sum(k * (upto - n + (n + 1) / 2.0::double)) as r1, sum(n::double * n * n - n) as ties from c),
      w as (select cast(n1 as bigint) as n1, cast(n2 as bigint) as n2, r1 - n1 * (n1 + 1) / 2.0::double as u, ties, (n1 + n2)::double as n from s),
      z as (select *, {_Z} as z from w)
    select n1, n2, u, {_P_OF_Z} as p_value, z > 1.959963984540054 as significant from z""",
)
def mann_whitney_u(spark, d):
    return rounded(bias.mann_whitney(_toxic_lengths(spark, d), "toxic", "x"), "p_value", digits=4)


_SHAPE = """avg(power((x - m) / s, 3)) as skew, avg(power((x - m) / s, 4)) - 3 as kurt"""


def _both_normal(rows: str, *keys: str) -> str:
    """SQL of the gate of the t test: a table ``normal`` that tells by key whether both sides look normal."""
    by = "".join(f"{k}, " for k in keys)
    same = "".join(f" and p.{k} = a.{k}" for k in keys)
    return f"""a as (select {by}g, avg(x) as m, stddev_pop(x) as s, count(*) as n from {rows} group by {by}g),
      b as (select {"".join(f"p.{k}, " for k in keys)}p.g, max(n) as n, {_SHAPE} from {rows} p join a on p.g = a.g{same} group by {"".join(f"p.{k}, " for k in keys)}p.g),
      normal as (select {by}count(*) = 2 and bool_and(coalesce(n >= 3 and exp(-n / 12.0::double * (skew * skew + kurt * kurt / 4)) > 0.05, false)) as both_normal
        from b {"group by " + ", ".join(keys) if keys else ""})"""


@query(
    "t_statistic",
    f"""with r as (select * from {_BY_TOXIC}), {_both_normal('r')},
      m as (select n1, n2, (mean1 - mean2) / sqrt({_POOLED} * (1.0::double / n1 + 1.0::double / n2)) as t from (select {_MOMENTS} from r))
    select n1, n2, both_normal, round(t, 6) as t, case when both_normal then round(t, 6) end as t_if_normal from m, normal""",
)
def t_statistic(spark, d):
    return rounded(bias.t_test(_toxic_lengths(spark, d), "toxic", "x").drop("p_value"), "t", "t_if_normal")


@query(
    "normality_jb",
    f"""with t as (select event_type, value as x from events), a as (select event_type, avg(x) as m, stddev_pop(x) as s, count(*) as n from t group by event_type),
      b as (select t.event_type, max(n) as n, {_SHAPE} from t join a on t.event_type = a.event_type group by t.event_type),
      j as (select *, n / 6.0::double * (skew * skew + kurt * kurt / 4) as jb from b)
    select event_type, n, round(jb, 3) as jarque_bera, round(exp(-jb / 2), 6) as p_value, n >= 3 and exp(-jb / 2) > 0.05 as is_normal from j""",
)
def normality_jb(spark, d):
    out = bias.normality(table(spark, d, "events"), "event_type", "value")
    return out.withColumn("jarque_bera", F.round("jarque_bera", 3)).withColumn("p_value", F.round("p_value", 6))


_OUTCOME = """case when toxic = 1 and flagged_p = 1 then 'TP' when toxic = 0 and flagged_p = 0 then 'TN'
  when toxic = 0 and flagged_p = 1 then 'FP' when toxic = 1 and flagged_p = 0 then 'FN' end"""

_AUDIT_SQL = rf"""
with r as (select {_OUTCOME} as o, n_chars::double as n_chars, len(regexp_extract_all(text, '[^{WHITESPACE}]+'))::double as n_words,
    len({sentences_sql('text')})::double as n_sentences from {REVIEWS}),
  f as (select o, 'n_chars' as feature, n_chars as x from r union all select o, 'n_words', n_words from r union all select o, 'n_sentences', n_sentences from r),
  t as (select feature, 'correct_vs_incorrect' as comparison, case when o in ('TP', 'TN') then 1 else 2 end as g, x from f
    union all select feature, 'tp_vs_fn', case o when 'TP' then 1 else 2 end, x from f where o in ('TP', 'FN')
    union all select feature, 'tn_vs_fp', case o when 'TN' then 1 else 2 end, x from f where o in ('TN', 'FP')),
  m as (select feature, comparison, {_MOMENTS} from t group by feature, comparison),
  v as (select feature, comparison, x, count(*) filter (g = 1) as k, count(*) as n from t group by feature, comparison, x),
  c as (select *, sum(n) over (partition by feature, comparison order by x rows unbounded preceding) as upto from v),
  s as (select feature, comparison, sum(k * (upto - n + (n + 1) / 2.0::double)) as r1, sum(n::double * n * n - n) as ties from c group by feature, comparison),
  w as (select m.*, r1 - n1 * (n1 + 1) / 2.0::double as u, ties, (n1 + n2)::double as n from m join s on m.feature = s.feature and m.comparison = s.comparison),
  z as (select *, {_Z} as z from w), {_both_normal('t', 'feature', 'comparison')}
select z.feature, z.comparison, n1, n2, round((mean1 - mean2) / sqrt({_POOLED}), 6) as cohens_d, u, round(z, 6) as z, {_P_OF_Z} as mann_whitney_p,
  coalesce(both_normal, false) as both_normal,
  case when both_normal then round((mean1 - mean2) / sqrt({_POOLED} * (1.0::double / n1 + 1.0::double / n2)), 6) end as t,
  case when z > 1.959963984540054 then 'significant difference' else 'no significant difference' end as verdict
from z left join normal o on z.feature = o.feature and z.comparison = o.comparison"""


@query("bias_audit", _AUDIT_SQL)
def bias_audit(spark, d):
    rows = reviews(spark, d).select(
        "toxic", "flagged_p", "n_chars", word_count("text").alias("n_words"), F.size(sentences("text")).alias("n_sentences")
    )
    out = bias.bias_audit(rows, ["n_chars", "n_words", "n_sentences"], "toxic", "flagged_p")
    return rounded(out.drop("t_p").withColumn("mann_whitney_p", F.round("mann_whitney_p", 4)), "cohens_d", "z", "t")

"""Splits, samples, mixes, grids and search spaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.operators import grids, sampling
from reviewloom.queries.base import REVIEWS, by_hash, query, reviews, table, unit

_RANKED = f"(select *, row_number() over (partition by toxic order by {by_hash('doc_id')}) as rn from {REVIEWS})"


@query(
    "assign_splits",
    f"""select doc_id, case when u < 0.5 then 1 else 0 end as train, case when u >= 0.5 and u < 0.75 then 1 else 0 end as test,
    case when u >= 0.75 then 1 else 0 end as val from (select doc_id, {unit('doc_id')} as u from documents)""",
)
def assign_splits(spark, d):
    return sampling.assign_splits(table(spark, d, "documents").select("doc_id"), "doc_id")


@query(
    "split_counts",
    f"""select count(*) filter (u < 0.5) as train, count(*) filter (u >= 0.5 and u < 0.75) as test,
    count(*) filter (u >= 0.75) as val from (select {unit('doc_id')} as u from documents)""",
)
def split_counts(spark, d):
    from reviewloom.operators.metrics import split_counts as totals

    return totals(sampling.assign_splits(table(spark, d, "documents").select("doc_id"), "doc_id"))


@query(
    "balance_classes",
    f"""select doc_id, text, toxic from {_RANKED} where rn <= (select min(c) from (select count(*) as c from {REVIEWS} group by toxic))""",
)
def balance_classes(spark, d):
    return sampling.balance(reviews(spark, d).select("doc_id", "text", "toxic"), "toxic", "doc_id")


@query("sample_n", f"select doc_id, text from documents order by {by_hash('doc_id')} limit 100")
def sample_n(spark, d):
    return sampling.sample_n(table(spark, d, "documents").select("doc_id", "text"), 100, "doc_id")


@query("shuffle_positions", f"select doc_id, text, row_number() over (order by {by_hash('doc_id')}) as position from documents")
def shuffle_positions(spark, d):
    return sampling.shuffle_positions(table(spark, d, "documents").select("doc_id", "text"), "doc_id")


@query("sample_large", f"select o_orderkey, o_totalprice from orders order by {by_hash('o_orderkey')} limit 12000")
def sample_large(spark, d):
    """A sample beyond the size at which sorting on one task is right."""
    return sampling.sample_n(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 12_000, "o_orderkey")


RECIPE = {"src0": "all", "src1": 10, "src2": 25, "src3": 1, "src4": 40}


@query(
    "dataset_mix",
    f"""select doc_id, source, text from (select *, row_number() over (partition by source order by {by_hash('doc_id')}) as rn from documents)
    where source = 'src0' or (source = 'src1' and rn <= 10) or (source = 'src2' and rn <= 25) or (source = 'src3' and rn <= 1)
      or (source = 'src4' and rn <= 40)""",
)
def dataset_mix(spark, d):
    return sampling.mix(table(spark, d, "documents").select("doc_id", "source", "text"), "source", RECIPE, "doc_id")


@query(
    "carve_sets",
    f"""with r as {_RANKED}, n as (select count(*) - 10 as left_pos from r where toxic = 1)
    select doc_id, toxic, part, part in ('validation', 'remainder') as in_big_validation from (
      select doc_id, toxic, case when toxic = 1 then case when rn <= 10 then 'validation' else 'train' end
        when rn <= 30 then 'supplementary' when rn <= 30 + left_pos then 'train'
        when rn <= 40 + left_pos then 'validation' else 'remainder' end as part from r, n)""",
)
def carve_sets(spark, d):
    return sampling.carve(reviews(spark, d).select("doc_id", "toxic"), "toxic", "doc_id", validation=20, supplementary=30)


@query(
    "balanced_holdout",
    f"""with r as {_RANKED}, n as (select count(*) - 10 as left_pos from r where toxic = 1)
    select doc_id, toxic, case when rn <= 10 then 'validation' when toxic = 1 or rn <= 10 + left_pos then 'train'
      else 'unused' end as part from r, n""",
)
def balanced_holdout(spark, d):
    return sampling.holdout(reviews(spark, d).select("doc_id", "toxic"), "toxic", "doc_id", 20, balance_rest=True)


@query(
    "stratified_split",
    f"""with r as (select vec_id, label, row_number() over (partition by label order by {by_hash('vec_id')}) as rn,
      count(*) over (partition by label) as n from embeddings)
    select vec_id, label, case when rn <= floor(0.2::double * n + 0.5) then 1 else 0 end as is_val from r""",
)
def stratified_split(spark, d):
    return sampling.stratified_split(table(spark, d, "embeddings").select("vec_id", "label"), "label", "vec_id")


_SPLIT_REVIEWS = f"(select *, {unit('doc_id')} as u from {REVIEWS})"


@query(
    "evaluation_sets",
    f"""with t as (select *, row_number() over (partition by toxic order by {by_hash('doc_id')}) as rn from {_SPLIT_REVIEWS} where u >= 0.5 and u < 0.75)
    select doc_id, toxic, 'test' as part from t where rn <= (select min(c) from (select count(*) as c from t group by toxic))
    union all select doc_id, toxic, 'val' from {_SPLIT_REVIEWS} where u >= 0.75""",
)
def evaluation_sets(spark, d):
    rows = sampling.assign_splits(reviews(spark, d), "doc_id")
    parts = [rows.filter("toxic = 1").drop("lang"), rows.filter("toxic = 0")]
    sets = sampling.evaluation_sets(parts, "toxic", "doc_id", balance_test=True, balance_val=False)
    named = [rows.select("doc_id", "toxic", F.lit(name).alias("part")) for name, rows in sets.items()]
    return named[0].unionByName(named[1])


def _values(values) -> str:
    return ", ".join(f"({i}, '{v}')" for i, v in enumerate(values))


@query(
    "param_grid",
    f"""with s(i, sentiment) as (values {_values(grids.SENTIMENTS)}), w(j, word_count) as (values (0, '100'), (1, '200'), (2, '200'))
    select p.lang, p.source, p.n, s.sentiment, w.word_count, cast(s.i * 3 + w.j as int) as grid_pos
    from (select lang, source, count(*) as n from documents group by lang, source) p, s, w""",
)
def param_grid(spark, d):
    places = table(spark, d, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    return grids.expand_grid(places, {"sentiment": grids.SENTIMENTS, "word_count": ["100", "200", "200"]})


PROMPT = "Write a {sentiment} review of {location}, mostly in the {tense} tense."
TENSES = ["present", "present", "past"]


@query(
    "prompt_table",
    f"""with s(i, sentiment) as (values {_values(grids.SENTIMENTS)}), t(j, tense) as (values {_values(TENSES)}),
      p as (select doc_id, source as location, sentiment, tense, doc_id || '-' || (s.i * 3 + t.j) as prompt_id from documents, s, t)
    select prompt_id, doc_id, 'Write a ' || sentiment || ' review of ' || location || ', mostly in the ' || tense || ' tense.' as prompt
    from p order by {by_hash('prompt_id')} limit 200""",
)
def prompt_table(spark, d):
    seeds = table(spark, d, "documents").select("doc_id", F.col("source").alias("location"))
    grid = {"sentiment": grids.SENTIMENTS, "tense": TENSES}
    return grids.prompt_table(seeds, grid, PROMPT, "doc_id", k=200).select("prompt_id", "doc_id", "prompt")


@query(
    "pending_runs",
    f"""with c(classifier) as (values ('SVM'), ('xgboost')), b(beta) as (values (0.75::double), (2.0::double), (null)),
      plan as (select distinct source as embedding, classifier, beta from documents, c, b),
      done as (select distinct source as embedding, case when toxic = 1 then 'SVM' else 'xgboost' end as classifier,
        case when lang = 'en' then null when quality = 1 then 0.75::double else 2.0::double end as beta from {REVIEWS})
    select * from plan p where not exists (select 1 from done d where d.embedding = p.embedding
      and d.classifier = p.classifier and d.beta is not distinct from p.beta)""",
)
def pending_runs(spark, d):
    sources = table(spark, d, "documents").select(F.col("source").alias("embedding")).distinct()
    plan = grids.expand_grid(sources, {"classifier": ["SVM", "xgboost"], "beta": [0.75, 2.0, None]}, position=None)
    beta = F.when(F.col("lang") == "en", F.lit(None).cast("double")).when(F.col("quality") == 1, 0.75).otherwise(2.0)
    done = reviews(spark, d).select(
        F.col("source").alias("embedding"),
        F.when(F.col("toxic") == 1, "SVM").otherwise("xgboost").alias("classifier"),
        beta.alias("beta"),
    )
    return grids.pending_runs(plan, done)


@query(
    "search_space",
    f"""with t as (select source, count(*) as n from documents group by source),
      v as (select source, n, 0.0001::double * pow(1e3::double / 0.0001, {unit("'C'", 'source')}) as c,
        ['newton-cg', 'lbfgs', 'liblinear', 'sag', 'saga'][1 + floor({unit("'solver'", 'source')} * 5)::int] as solver,
        least(floor(100::double * pow(10.01::double, {unit("'max_iter'", 'source')})), 1000)::int as max_iter from t)
    select source, round(ln(c), 6) as log_c, round(1 / (c * n), 6) as reg_param, solver, max_iter from v""",
)
def search_space(spark, d):
    trials = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    drawn = grids.search_space(trials, "source", "logistic_regression")
    return drawn.select(
        "source",
        F.round(F.ln("C"), 6).alias("log_c"),
        F.round(F.lit(1.0) / (F.col("C") * F.col("n")), 6).alias("reg_param"),
        "solver",
        "max_iter",
    )


# A twin of every drawn number: what a parameter becomes from its draw u.
_DRAWN = {
    "SVM": {"C": "0.0001 * pow(1.0::double / 0.0001, u)", "gamma": "1e-5 * pow(1e-1::double / 1e-5, u)"},
    "random_forest": {"n_estimators": "100 + floor(u * 901)", "max_depth": "1 + floor(u * 30)", "min_samples_leaf": "0.1 + u * 0.399::double"},
    "logistic_regression": {"C": "0.0001 * pow(1e3::double / 0.0001, u)", "max_iter": "least(floor(100 * pow(10.01::double, u)), 1000)"},
    "xgboost": {
        "n_estimators": "100 + floor(u * 901)", "max_depth": "1 + floor(u * 20)", "learning_rate": "0.001 + u * 0.299::double",
        "min_child_weight": "1 + floor(u * 10)", "subsample": "0.5 + u * 0.5::double", "colsample_bytree": "0.5 + u * 0.5::double",
    },
}


@query(
    "search_spaces",
    " union all ".join(
        f"""select source, '{kind}' as classifier, '{name}' as parameter, round({value}, 9)::double as value
        from (select source, {unit(f"'{name}'", 'source')} as u from documents group by source)"""
        for kind, drawn in _DRAWN.items()
        for name, value in drawn.items()
    ),
)
def search_spaces(spark, d):
    """Every number that every classifier's search draws, a trial per source."""
    trials = table(spark, d, "documents").select("source").distinct()
    out = None
    for kind in grids.SEARCH_SPACES:
        drawn = grids.search_space(trials, "source", kind)
        numbers = [c for c in drawn.columns if c not in ("source", "solver")]
        value = F.explode(F.create_map(*(x for c in numbers for x in (F.lit(c), F.round(F.col(c).cast("double"), 9))))).alias("parameter", "value")
        part = drawn.select("source", F.lit(kind).alias("classifier"), value)
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "trial_samples",
    f"""select source, size, trial, 1 + floor({unit("'rows'", 'source', 'trial')} * size)::bigint as n_rows
    from (select source, count(*) as size from documents group by source), (select unnest(range(20))::int as trial)""",
)
def trial_samples(spark, d):
    sizes = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("size"))
    return grids.trial_samples(sizes, "source", "size", 20)

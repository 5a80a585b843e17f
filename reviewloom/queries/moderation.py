"""Moderation rules over whole tables and over a stream; the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.functions.text import word_pattern
from reviewloom.operators import metrics as M
from reviewloom.operators import moderate as R
from reviewloom.operators import train
from reviewloom.operators.quality import drop_duplicates
from reviewloom.operators.sampling import assign_splits
from reviewloom.plans.session import shared_dir
from reviewloom.queries.models import gap_sql, without
from reviewloom.queries.base import clean_sql, documents, query, reviews, table, unit, words_sql
from reviewloom.queries.stubs import VowelEncoder
from reviewloom.sources.registry import Registry
from reviewloom.streaming import intake
from reviewloom.streaming import moderation as S

COMPLAINT = ["thentre", "ation", "ouation", "shthe", "ingthe"]
STRONG, POSSIBLE = ["thou", "queux", "unge"], ["whou", "elleaux", "heit", "ter"]
EXPERIENCE = ["the", "le", "la", "der", "el"]
PEOPLE = ["anan", "elle", "heion", "er"]
MODIFIERS = ["the", "un", "die"]

RULES = [
    R.keyword_rule("complaint", COMPLAINT),
    R.severity_rule("safeguarding", STRONG, POSSIBLE),
    R.lacks_rule("not_an_experience", EXPERIENCE),
    R.mentions_rule("names", PEOPLE),
    R.pairs_rule("descriptions", MODIFIERS),
]


def _any(words) -> str:
    return f"regexp_matches(c, '{word_pattern(words)}')"


def _among(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _rules_sql(source: str) -> str:
    return f"""(select *, complaint > 0 or safeguarding > 0 or not_an_experience > 0 or names > 0 or descriptions > 0 as flagged from (
      select *, case when {_any(COMPLAINT)} then 1 else 0 end as complaint,
        case when {_any(STRONG)} then 2 when {_any(POSSIBLE)} then 1 else 0 end as safeguarding,
        case when {_any(EXPERIENCE)} then 0 else 1 end as not_an_experience,
        len(list_filter(k, lambda w: w in ({_among(PEOPLE)})))::int as names,
        len(list_filter(k[1:len(k) - 1], lambda w: w in ({_among(MODIFIERS)})))::int as descriptions
      from (select *, {words_sql('c')} as k from (select *, {clean_sql('text')} as c from {source}))))"""


_COLUMNS = ["doc_id", "complaint", "safeguarding", "not_an_experience", "names", "descriptions", "flagged"]
_MODERATE_SQL = f"select {', '.join(_COLUMNS)} from {_rules_sql('documents')}"


@query("moderate", _MODERATE_SQL)
def moderate(spark, d):
    return R.moderate(documents(spark, d), "text", RULES).select(*_COLUMNS)


@query("moderate_stream", _MODERATE_SQL)
def moderate_stream(spark, d):
    schema = table(spark, d, "documents").schema
    home = shared_dir(spark, "stream")
    # As a glob the path may be one file or a folder of files.
    stream = S.read_stream(spark, f"{d}/documents.parque[t]", schema)
    job = S.moderate_stream(stream, "text", RULES, f"{home}/out", f"{home}/checkpoint", available_now=True)
    job.awaitTermination()
    return spark.read.parquet(f"{home}/out").select(*_COLUMNS)


@query("stream_resent", "select doc_id, text, lang, source from documents")
def stream_resent(spark, d):
    """All documents sent twice, the second time after a restart; every batch is a version of a dataset."""
    home = shared_dir(spark, "intake")
    registry = Registry(spark, f"{home}/registry")
    rows = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    for _sending in range(2):
        rows.write.mode("append").parquet(f"{home}/in")
        fresh = intake.first_arrivals(intake.read_arrivals(spark, f"{home}/in", rows.schema), "doc_id")
        intake.keep_versions(fresh, registry, "submissions", f"{home}/checkpoint", available_now=True).awaitTermination()
    return registry.read_versions("submissions", registry.versions("submissions")).select(*rows.columns)


_FLAGSHIP_SQL = f"""
with r as (select d.*, l.quality, l.toxic from documents d join labels l on d.doc_id = l.doc_id),
  k as (select * from (select *, row_number() over (partition by text order by doc_id) as rn from r) where rn = 1),
  u as (select *, {unit('doc_id')} as u from k),
  s as (select *, case when u < 0.5 then 'train' when u < 0.75 then 'test' else 'val' end as part from u),
  m as (select part, toxic, case when flagged then 1 else 0 end as p from {_rules_sql('s')}),
  c as (select part, count(*) filter (toxic = 0 and p = 0) as tn, count(*) filter (toxic = 0 and p = 1) as fp,
    count(*) filter (toxic = 1 and p = 0) as fn, count(*) filter (toxic = 1 and p = 1) as tp from m group by part)
select part, tn, fp, fn, tp, round(case when tp + fp = 0 then 0 else tp::double / (tp + fp) end, 6) as precision,
  round(case when tp + fn = 0 then 0 else tp::double / (tp + fn) end, 6) as recall,
  round(case when 2 * tp + fp + fn = 0 then 0 else 2.0::double * tp / (2 * tp + fp + fn) end, 6) as f1 from c"""


@query("moderation_quality", _FLAGSHIP_SQL)
def moderation_quality(spark, d):
    """De-duplicate labelled reviews, split them, run every rule and judge the flag per split."""
    rows = drop_duplicates(reviews(spark, d), ["text"], "doc_id")
    rows = assign_splits(rows, "doc_id")
    part = F.when(F.col("train") == 1, "train").when(F.col("test") == 1, "test").otherwise("val")
    judged = R.moderate(rows, "text", RULES).select("toxic", F.col("flagged").cast("int").alias("p"), part.alias("part"))
    out = M.binary_metrics(judged, "toxic", "p", by=["part"])
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "safeguarding_rule",
    """with t as (select vec_id, embedding[1:3] as x from embeddings), m as (select *, list_max(x)::double as m from t),
      p as (select vec_id, cast(list_position(x, list_max(x)) - 1 as int) as k, 1.0::double / list_sum(list_transform(x, lambda v: exp(v::double - m))) as q from m)
    select vec_id, ['No safeguarding', 'Possibly Concerning', 'Strongly Concerning'][k + 1] as safeguarding_class, k as safeguarding,
      round(q, 6) as safeguarding_probability from p""",
)
def safeguarding_rule(spark, d):
    logits = F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double"))
    rows = table(spark, d, "embeddings").select("vec_id", logits.alias("logits"))
    out = R.safeguarding_rule(rows, "logits").drop("logits")
    return out.withColumn("safeguarding_probability", F.round("safeguarding_probability", 6))


@query("complaints_rule", f"select doc_id, text is null or {gap_sql('doc_id')} as missing, true as valid from documents")
def complaints_rule(spark, d):
    """Clean, embed with the stand-in encoder and classify every document; trained on the labelled ones.

    A share of the documents has lost its text and gets no class.
    """
    from reviewloom.operators.external import embed, embedding_column
    from reviewloom.operators.quality import add_cleaned

    column = embedding_column("text_cleaned", "vowels")
    known = embed(add_cleaned(reviews(spark, d), "text"), "text_cleaned", "vowels", VowelEncoder)
    model = train.train(train.with_features(known, column, "toxic").select("_features", "_label"), "logistic_regression")
    rows = without(documents(spark, d).select("doc_id", "text"), "doc_id", "text")
    out = R.complaints_rule(rows, "text", "vowels", VowelEncoder, model)
    missing = F.col("complaint").isNull()
    return out.select("doc_id", missing.alias("missing"), (missing | F.col("complaint").isin(0, 1)).alias("valid"))


def _judged(out, key, name, *more):
    """Is a prediction missing, and if not, is it the class whose probability is given?"""
    p = F.col(f"{name}_probability")
    missing = F.col(name).isNull()
    return out.select(key, missing.alias("missing"), ((missing & p.isNull()) | (F.col(name).isin(0, 1) & p.between(0.5, 1))).alias("valid"), *more)


@query("nae_rule", f"select doc_id, text is null or {gap_sql('doc_id')} as missing, true as valid from documents")
def nae_rule(spark, d):
    """Bag of words plus logistic regression, trained on labelled documents, applied to all; some have lost their text."""
    model = train.train_text(reviews(spark, d).select("text", "toxic"), "text", "toxic", params={"C": 0.01})
    rows = without(documents(spark, d).select("doc_id", "text"), "doc_id", "text")
    return _judged(R.nae_rule(rows, model), "doc_id", "not_an_experience")


@query(
    "uninformative_rule",
    f"""select vec_id, missing, true as valid, case when not missing then cast(vec_id % 2 as int) end as uninformative
    from (select vec_id, embedding is null or {gap_sql('vec_id')} as missing from embeddings)""",
)
def uninformative_rule(spark, d):
    """Vectors with one more component that tells odd ids from even ones, so that the class is known beforehand."""
    rows = without(table(spark, d, "embeddings"), "vec_id", "embedding").withColumn("y", (F.col("vec_id") % 2).cast("int"))
    signal = F.array((F.col("y") * 20 - 10).cast("float"))
    rows = rows.withColumn("embedding", F.concat("embedding", signal))
    model = train.train(train.with_features(rows, "embedding", "y"), "logistic_regression", {"C": 1.0})
    out = R.uninformative_rule(rows.select("vec_id", "embedding"), "embedding", model)
    return _judged(out, "vec_id", "uninformative", F.col("uninformative").cast("int").alias("uninformative"))

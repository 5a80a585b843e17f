"""De-duplication and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.operators import quality as Q
from reviewloom.operators.key_index import KeyIndex
from reviewloom.operators.sampling import assign_splits
from reviewloom.plans.session import shared_dir
from reviewloom.queries.base import documents, query, table, unit
from reviewloom.sources.registry import Registry


@query(
    "find_duplicates",
    """select doc_id, lang, n_copies from (select doc_id, lang, count(*) over (partition by text) as n_copies from documents)
    where n_copies > 1""",
)
def find_duplicates(spark, d):
    rows = documents(spark, d).select("doc_id", "lang", "text")
    return Q.find_duplicates(rows, ["text"]).select("doc_id", "lang", "n_copies")


@query(
    "drop_duplicates",
    """select doc_id, text, lang from (select *, row_number() over (partition by text order by doc_id) as rn from documents)
    where rn = 1""",
)
def drop_duplicates(spark, d):
    return Q.drop_duplicates(documents(spark, d).select("doc_id", "text", "lang"), ["text"], "doc_id")


@query(
    "clean_dataset",
    """select conv_id, turn, text from (select *, row_number() over (partition by conv_id order by turn) as rn
    from conversations) where rn = 1 and text is not null""",
)
def clean_dataset(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", "text")
    return Q.clean_dataset(rows, "conv_id", "text", order="turn")


@query(
    "cross_source_duplicates",
    """select text, count(*) as n_rows, count(distinct source) as n_sources,
    string_agg(distinct source, ',' order by source) as sources
    from documents where text is not null group by text having count(*) > 1""",
)
def cross_source_duplicates(spark, d):
    return Q.cross_dataset_duplicates(documents(spark, d), "text", "source")


_PARTS = f"(select *, {unit('doc_id')} as u, case when {unit('doc_id')} < 0.5 then 'train' when {unit('doc_id')} < 0.75 then 'test' else 'val' end as part from documents)"


@query(
    "leaks_by_index",
    f"""with d as {_PARTS}, o as (select text, part as dataset, count(*) as n from d where text is not null group by text, part)
    select d.doc_id, d.part, o.dataset, o.n from d join o on d.text = o.text and d.part <> o.dataset""",
)
def leaks_by_index(spark, d):
    """Three splits are indexed, the training rows in a batch per language; each is then checked by its own texts."""
    rows = assign_splits(documents(spark, d).select("doc_id", "text", "lang"), "doc_id")
    index = KeyIndex(Registry(spark, shared_dir(spark, "index")))
    parts = {p: rows.filter(F.col(p) == 1) for p in ("train", "test", "val")}
    english = F.col("lang").eqNullSafe("en")
    index.add("train", "english", parts["train"].filter(english), "text")
    index.add("train", "others", parts["train"].filter(~english), "text")
    for name in ("test", "val"):
        index.add(name, "all", parts[name], "text")
    found = [index.leaks(p, df, "doc_id", "text").select("doc_id", F.lit(p).alias("part"), "dataset", "n") for p, df in parts.items()]
    return found[0].union(found[1]).union(found[2])


def _with_broken_splits(spark, d):
    """Splits with known faults: rows of one language lose a flag, those of another gain one."""
    rows = assign_splits(documents(spark, d).select("doc_id", "text", "lang", "source"), "doc_id")
    return rows.withColumn("val", F.when(F.col("lang") == "de", F.lit(None).cast("int")).otherwise(F.col("val"))).withColumn(
        "test", F.when(F.col("lang") == "es", 1).otherwise(F.col("test"))
    )


_BROKEN = f"""(select *, case when u < 0.5 then 1 else 0 end as train,
    case when lang = 'es' then 1 when u >= 0.5 and u < 0.75 then 1 else 0 end as test,
    case when lang = 'de' then null when u >= 0.75 then 1 else 0 end as val
  from (select *, {unit('doc_id')} as u from documents))"""


@query(
    "invalid_splits",
    f"select count(*) filter (coalesce(train, 0) + coalesce(test, 0) + coalesce(val, 0) <> 1) as n_invalid from {_BROKEN}",
)
def invalid_splits(spark, d):
    return Q.invalid_splits(_with_broken_splits(spark, d))


@query(
    "null_embeddings",
    """select count(*) filter (label = 3) as n_null, count(*) as n_rows from embeddings""",
)
def null_embeddings(spark, d):
    gaps = F.when(F.col("label") != 3, F.col("embedding"))
    return Q.null_embeddings(table(spark, d, "embeddings").select(gaps.alias("embedding")), "embedding")


@query(
    "embedding_drift",
    """select vec_id, case when label in (1, 2) then false else true end as is_close from embeddings""",
)
def embedding_drift(spark, d):
    """Fresh vectors with a shift on one class, one missing dimension on another and noise below tolerance."""
    stored = table(spark, d, "embeddings")
    fresh = stored.select(
        "vec_id",
        F.when(F.col("label") == 1, F.transform("embedding", lambda x: (x + F.lit(0.01)).cast("float")))
        .when(F.col("label") == 2, F.slice("embedding", F.lit(1), F.size("embedding") - 1))
        .otherwise(F.transform("embedding", lambda x: (x * F.lit(1.000001)).cast("float")))
        .alias("embedding"),
    )
    return Q.embedding_drift(stored, fresh, "vec_id", "embedding")


REFUSALS = ["No review can be written on this topic", "This request has to be turned down"]


@query("fuzzy_filter")
def fuzzy_filter(spark, d):
    """Texts that do not resemble a refusal; the refusals among them are added in variants per conversation."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", "text")
    plants = rows.select(
        "conv_id",
        (F.col("turn") + 1000).alias("turn"),
        F.concat(F.lit("A review cannot be written on topic "), F.col("conv_id").cast("string")).alias("text"),
    )
    return Q.filter_close_matches(rows.unionByName(plants), "text", REFUSALS, cutoff=0.5)


@query(
    "quality_report",
    f"""with t as (select * from {_BROKEN}),
      g as (select text, lang, count(*) as n from t group by text, lang), x as (select text, count(*) as n from t group by text)
    select lang as dataset, 'duplicate_texts' as check_name, cast(sum(case when n > 1 then n else 0 end) as bigint) as n_bad from g group by lang
    union all select lang, 'invalid_splits', count(*) filter (coalesce(train, 0) + coalesce(test, 0) + coalesce(val, 0) <> 1) from t group by lang
    union all select '*', 'cross_dataset_duplicates', cast(sum(case when n > 1 then n else 0 end) as bigint) from x
    union all select 'embeddings', 'embedding_drift', count(*) filter (label = 0) from embeddings""",
)
def quality_report(spark, d):
    rows = _with_broken_splits(spark, d)
    stored = table(spark, d, "embeddings")
    fresh = stored.withColumn(
        "embedding", F.when(F.col("label") == 0, F.transform("embedding", lambda x: x + F.lit(0.5).cast("float"))).otherwise(F.col("embedding"))
    )
    return Q.quality_report(rows, "text", drift={"embeddings": Q.embedding_drift(stored, fresh, "vec_id", "embedding")}, dataset_col="lang")

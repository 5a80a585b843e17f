"""Sources, table shaping and column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.functions import scores, text, vectors
from reviewloom.operators import metrics as M
from reviewloom.operators import submissions, tables
from reviewloom.operators.sampling import assign_splits
from reviewloom.plans.session import shared_dir
from reviewloom.queries.base import REVIEWS, clean_sql, documents, query, reviews, sentences_sql, table, unit
from reviewloom.sources import formats
from reviewloom.sources.csv_records import read_csv_split
from reviewloom.sources.registry import Registry


@query("scan_documents", "select doc_id, lang, source, n_chars from documents")
def scan_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")


@query("registry_roundtrip", "select doc_id, text, lang, 1 as label from documents where text is not null")
def registry_roundtrip(spark, d):
    registry = Registry(spark, shared_dir(spark, "registry"))
    registry.write_dataset(table(spark, d, "documents").select("doc_id", "text", "lang"), "documents")
    registry.label_dataset("documents", "label", 1)
    registry.clean_dataset("documents", "doc_id", "text")
    return registry.read_dataset("documents")


@query(
    "concat_sources",
    """select doc_id as id, text, lang, 'documents' as source from documents
    union all select item_id, text, null, 'benchmark' from benchmark
    union all select conv_id, text, null, 'conversations' from conversations""",
)
def concat_sources(spark, d):
    datasets = {
        "documents": table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang"),
        "benchmark": table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text"),
        "conversations": table(spark, d, "conversations").select(F.col("conv_id").alias("id"), "text"),
    }
    return tables.concat_datasets(datasets, source_col="source")


@query(
    "concat_shared_columns",
    "select doc_id as id, text from documents union all select item_id, text from benchmark",
)
def concat_shared_columns(spark, d):
    a = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    b = table(spark, d, "benchmark").select("text", F.col("item_id").alias("id"))
    return tables.concat_datasets([a, b], how="inner")


@query("generated_reviews", "select text, cast(null as varchar) as bad_line, 1 as complaint from conversations")
def generated_reviews(spark, d):
    path = shared_dir(spark, "generated")
    formats.write_generated(table(spark, d, "conversations"), path)
    return formats.read_generated(spark, path, label_col="complaint")


@query("csv_roundtrip", "select doc_id, text, lang, source, n_chars from documents")
def csv_roundtrip(spark, d):
    path = shared_dir(spark, "csv")
    documents = table(spark, d, "documents")
    formats.write_csv(documents, path)
    return formats.read_csv(spark, path, documents.schema)


@query("csv_split_roundtrip", "select doc_id, text, lang, source, n_chars from documents")
def csv_split_roundtrip(spark, d):
    """Documents with newlines and quotes through CSV files that are read by many tasks each."""
    path = shared_dir(spark, "csv")
    documents = table(spark, d, "documents")
    formats.write_csv(documents, path)
    return read_csv_split(spark, path, documents.schema)


@query("lines_roundtrip", "select text from documents")
def lines_roundtrip(spark, d):
    path = shared_dir(spark, "lines")
    formats.write_lines(table(spark, d, "documents"), "text", path)
    return formats.read_lines(spark, path)


@query("json_unpack", "select event_id, cast(props ->> '$.k' as bigint) as k from events")
def json_unpack(spark, d):
    return submissions.unpack_json(table(spark, d, "events"), "props", "k BIGINT", keep=["event_id"])


PAYLOAD = (
    "Id bigint, Status string, DateSubmitted string, Ratings array<struct<Question:string,Rating:string>>"
)


def _payloads(spark, d):
    """Raw submissions rebuilt from events: removed and status-less rows, offsets, bad dates, ratings."""
    events = table(spark, d, "events", spread="event_id").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rating = lambda q, value: F.struct(F.lit(q).alias("Question"), value.cast("string").alias("Rating"))
    body = F.struct(
        F.col("event_id").alias("Id"),
        F.when(F.col("event_type") == "error", "Removed").when(F.col("event_type") != "click", "Published").alias("Status"),
        F.when(k % 10 == 0, F.lit("no date")).when(k % 2 == 0, F.concat(clock, F.lit("+02:00"))).otherwise(clock).alias("DateSubmitted"),
        F.when(
            F.col("event_type") != "view", F.array(rating("10001", k % 5), rating("10002", k), rating("10001", k % 3))
        ).alias("Ratings"),
    )
    return events.select(F.to_json(body).alias("Data"))


_SUBMISSIONS_SQL = """
with e as (select *, cast(props ->> '$.k' as int) as k from events)
select event_id as id,
  case when event_type = 'error' then 'Removed' when event_type <> 'click' then 'Published' end as status,
  case when k % 10 <> 0 then strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as submitted,
  case when event_type <> 'view' then cast(k % 3 as varchar) end as q_10001,
  case when event_type <> 'view' then cast(k as varchar) end as q_10002,
  cast(null as varchar) as q_10003
from e where event_type <> 'error'"""


@query("submissions_clean", _SUBMISSIONS_SQL)
def submissions_clean(spark, d):
    return submissions.load_submissions(_payloads(spark, d), "Data", PAYLOAD).select(
        F.col("Id").alias("id"),
        F.col("Status").alias("status"),
        F.date_format("DateSubmitted", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("submitted"),
        F.col("Q_10001").alias("q_10001"),
        F.col("Q_10002").alias("q_10002"),
        F.col("Q_10003").alias("q_10003"),
    )


@query(
    "ratings_pivot",
    """select event_id as id,
      case when event_type <> 'view' then cast(cast(props ->> '$.k' as int) % 3 as varchar) end as q_10001,
      case when event_type <> 'view' then props ->> '$.k' end as q_10002 from events""",
)
def ratings_pivot(spark, d):
    rows = submissions.unpack_json(_payloads(spark, d), "Data", PAYLOAD)
    return submissions.pivot_ratings(rows, "Ratings", ["10001", "10002"]).select(
        F.col("Id").alias("id"), F.col("Q_10001").alias("q_10001"), F.col("Q_10002").alias("q_10002")
    )


@query("label_constant", "select doc_id, text, 1 as is_complaint from documents")
def label_constant(spark, d):
    return tables.with_label(table(spark, d, "documents").select("doc_id", "text"), "is_complaint", 1)


@query("harmonise", "select doc_id as comment_id, text as comment_text, source as origin from documents where text is not null")
def harmonise(spark, d):
    names = {"doc_id": "comment_id", "text": "comment_text", "source": "origin"}
    return tables.harmonise(table(spark, d, "documents"), names, list(names.values()), drop_null=True)


@query(
    "split_slice",
    f"select doc_id, {unit('doc_id')} < 0.5 as in_train from documents where {unit('doc_id')} < 0.75",
)
def split_slice(spark, d):
    rows = assign_splits(table(spark, d, "documents").select("doc_id"), "doc_id")
    return tables.split_slice(rows, ["train", "test"]).select("doc_id", (F.col("train") == 1).alias("in_train"))


@query(
    "exclude_keywords",
    "select doc_id, text from documents where text is not null and not regexp_matches(text, 'entre|ation|shthe')",
)
def exclude_keywords(spark, d):
    return tables.exclude_keywords(table(spark, d, "documents").select("doc_id", "text"), "text", "entre|ation|shthe")


@query(
    "drop_status",
    """select event_id, status from (select event_id, case when event_type <> 'click' then event_type end as status
    from events) where status is distinct from 'error'""",
)
def drop_status(spark, d):
    status = F.when(F.col("event_type") != "click", F.col("event_type")).alias("status")
    return tables.drop_status(table(spark, d, "events").select("event_id", status), "status", "error")


@query(
    "timeline_sorted",
    """select event_id, case when event_type <> 'error' then strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as submitted
    from events""",
)
def timeline_sorted(spark, d):
    clock = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("-05:00"))
    raw = F.when(F.col("event_type") == "error", F.lit("yesterday")).otherwise(clock)
    rows = tables.fix_timeline(table(spark, d, "events").select("event_id", raw.alias("submitted")), "submitted")
    return rows.withColumn("submitted", F.date_format("submitted", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


_CLASS_NAME = "case when toxic = 1 and quality = 0 then 'Strongly Concerning' when toxic = 1 then 'Possibly Concerning' when quality = 0 then 'Unclear' else 'No safeguarding' end"


def _class_names(spark, d):
    name = (
        F.when((F.col("toxic") == 1) & (F.col("quality") == 0), "Strongly Concerning")
        .when(F.col("toxic") == 1, "Possibly Concerning")
        .when(F.col("quality") == 0, "Unclear")
        .otherwise("No safeguarding")
    )
    return table(spark, d, "labels").select("doc_id", F.struct(name.alias("name"), F.col("quality").alias("q")).alias("predicted"))


@query(
    "map_label",
    f"""with t as (select doc_id, quality, {_CLASS_NAME} as name from labels)
    select doc_id, name, quality as q, case name when 'No safeguarding' then 0 when 'Possibly Concerning' then 1
      when 'Strongly Concerning' then 2 end as number,
      case name when 'Possibly Concerning' then 1 when 'Strongly Concerning' then 2 else 0 end as severity from t""",
)
def map_label(spark, d):
    rows = tables.unpack_prediction(_class_names(spark, d), "predicted", {"name": "name", "q": "q"})
    rows = tables.map_label(rows, "name", scores.SEVERITY, "number")
    return rows.withColumn("severity", scores.severity("name")).drop("predicted")


@query("binarise", "select vec_id, case when label in (1, 2) then 1 else 0 end as concerning from embeddings")
def binarise(spark, d):
    return tables.binarise(table(spark, d, "embeddings").select("vec_id", "label"), "label", [1, 2], "concerning").drop("label")


@query(
    "classification_group",
    f"""with t as (select doc_id, case when toxic = 1 and flagged_p = 1 then 'TP' when toxic = 0 and flagged_p = 0 then 'TN'
      when toxic = 0 and flagged_p = 1 then 'FP' when toxic = 1 and flagged_p = 0 then 'FN' else 'Unknown' end as classification_group
      from {REVIEWS})
    select *, classification_group in ('TP', 'TN') as correct from t""",
)
def classification_group(spark, d):
    rows = reviews(spark, d).select("doc_id", "toxic", "flagged_p")
    return tables.classification_group(rows, "toxic", "flagged_p").drop("toxic", "flagged_p")


@query("clean_text", f"select doc_id, {clean_sql('text')} as text_cleaned from documents")
def clean_text(spark, d):
    from reviewloom.operators.quality import add_cleaned

    return add_cleaned(documents(spark, d).select("doc_id", "text"), "text").drop("text")


@query(
    "text_lengths",
    rf"""select doc_id, len(regexp_extract_all(text, '[^{text.WHITESPACE}]+')) as n_words, length(text) as n_letters
    from documents""",
)
def text_lengths(spark, d):
    return documents(spark, d).select(
        "doc_id",
        text.word_count("text").cast("bigint").alias("n_words"),
        text.char_len("text").cast("bigint").alias("n_letters"),
    )


@query("sentence_counts", f"select doc_id, len({sentences_sql('text')}) as n_sentences from documents")
def sentence_counts(spark, d):
    return documents(spark, d).select("doc_id", F.size(text.sentences("text")).cast("bigint").alias("n_sentences"))


TEMPLATE = "Write a {sentiment} review of {location} in {language}, about {word_count} words long."


@query(
    "fill_template",
    """select doc_id, 'Write a ' || case when n_chars > 1000 then 'negative' else 'neutral' end || ' review of ' || source ||
    ' in ' || lang || ', about ' || cast(n_chars as varchar) || ' words long.' as prompt from documents""",
)
def fill_template(spark, d):
    params = {
        "sentiment": F.when(F.col("n_chars") > 1000, "negative").otherwise("neutral"),
        "location": "source",
        "language": "lang",
        "word_count": "n_chars",
    }
    return table(spark, d, "documents").select("doc_id", text.fill_template(TEMPLATE, params).alias("prompt"))


@query("prefix_text", "select doc_id, 'query: ' || text as e5_text, text as other_text from documents")
def prefix_text(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        text.prefix_text("text", "intfloat/e5-large-v2").alias("e5_text"),
        text.prefix_text("text", "thenlper/gte-base").alias("other_text"),
    )


@query(
    "concat_vectors",
    """select vec_id, len(list_concat(embedding, embedding)) as dims, round(list_concat(embedding, embedding)[len(embedding) + 1]::double, 6)
    as first_of_second from embeddings""",
)
def concat_vectors(spark, d):
    both = vectors.concat_vectors("embedding", "embedding")
    return table(spark, d, "embeddings").select(
        "vec_id",
        F.size(both).cast("bigint").alias("dims"),
        F.round(F.get(both, F.size("embedding")).cast("double"), 6).alias("first_of_second"),
    )


@query(
    "top_class",
    """with t as (select vec_id, embedding as x, list_max(embedding)::double as m from embeddings)
    select vec_id, cast(list_position(x, list_max(x)) - 1 as int) as top,
      round(1.0::double / list_sum(list_transform(x, lambda v: exp(v::double - m))), 6) as probability from t""",
)
def top_class(spark, d):
    rows = table(spark, d, "embeddings").select(
        "vec_id", vectors.top_class(F.transform("embedding", lambda v: v.cast("double"))).alias("t")
    )
    return rows.select("vec_id", F.col("t.class").alias("top"), F.round("t.probability", 6).alias("probability"))


@query(
    "parse_reply",
    """select conv_id, turn, case when turn % 5 < 3 then cast(turn % 5 as int) else 3 end as chat_class,
    case when turn % 5 < 4 then cast(turn % 5 as int) end as general_class from conversations""",
)
def parse_reply(spark, d):
    k = F.col("turn") % 5
    chat = F.concat(F.lit("Label 9, or rather: "), F.when(k < 3, F.concat(F.lit("Label "), k.cast("string"))).otherwise("none"), F.lit(" "), F.regexp_replace("text", "Label", ""))
    general = F.concat(F.col("text"), F.when(k < 4, k.cast("string")).otherwise("x"), F.lit('"]}'))
    return table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        text.parse_reply(chat, "chat").alias("chat_class"),
        text.parse_reply(general, "general").alias("general_class"),
    )


@query(
    "score_json_roundtrip",
    f"""select doc_id, '{{"0":"' || quality || '","1":"' || toxic || '.25"}}' as payload,
    cast(quality as varchar) as label_once, toxic + 0.25::double as probability_once,
    cast(quality as varchar) as label_twice, toxic + 0.25::double as probability_twice from labels""",
)
def score_json_roundtrip(spark, d):
    probability = F.col("toxic") + F.lit(0.25)
    rows = table(spark, d, "labels").select(
        "doc_id",
        scores.encode_score("quality", probability).alias("payload"),
        scores.encode_score("quality", probability, double_encoded=True).alias("twice"),
    )
    out = rows.withColumn("a", scores.decode_score("payload")).withColumn("b", scores.decode_score("twice"))
    return out.select(
        "doc_id",
        "payload",
        F.col("a.label").alias("label_once"),
        F.col("a.probability").alias("probability_once"),
        F.col("b.label").alias("label_twice"),
        F.col("b.probability").alias("probability_twice"),
    )


@query(
    "metrics_long",
    f"""with c as (select count(*) filter (toxic = 0 and flagged_p = 0)::double tn, count(*) filter (toxic = 0 and flagged_p = 1)::double fp,
      count(*) filter (toxic = 1 and flagged_p = 0)::double fn, count(*) filter (toxic = 1 and flagged_p = 1)::double tp from {REVIEWS})
    select 'run-1' as run_id, name, round(value, 6) as value from (
      select 'tn' as name, tn as value from c union all select 'fp', fp from c union all select 'fn', fn from c
      union all select 'tp', tp from c union all select 'precision', tp / (tp + fp) from c
      union all select 'recall', tp / (tp + fn) from c union all select 'f1', 2 * tp / (2 * tp + fp + fn) from c)""",
)
def metrics_long(spark, d):
    metrics = M.binary_metrics(reviews(spark, d), "toxic", "flagged_p")
    return M.metrics_long(metrics, "run-1").withColumn("value", F.round("value", 6))

"""External clients, training, search and the run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.functions.hashing import DEFAULT_SEED, text_key, uniform
from reviewloom.operators import durable, external, metrics as M, train
from reviewloom.operators.grids import expand_grid
from reviewloom.operators.moderate import assess_run as reassess
from reviewloom.operators.sampling import assign_splits
from reviewloom.operators.search import Ledger, search_and_record
from reviewloom.plans.session import cut_lineage, shared_dir
from reviewloom.queries.base import REVIEWS, by_hash, documents, query, reviews, table, unit
from reviewloom.queries.stubs import EchoWriter, FlakyWriter, Labeller, LengthScorer, SpaceEncoder, VowelEncoder
from reviewloom.sources import runlog
from reviewloom.sources.registry import Registry
from reviewloom.sources.runlog import RunLog

_VOWELS = ", ".join(f"(length(text) - length(replace(text, '{v}', '')))::float" for v in "aeiou")
_MARKS = ", ".join(f"(length(text) - length(replace(text, '{c}', '')))::float" for c in " ,.")


@query(
    "generate_stub",
    """with p as (select doc_id, tone, 'A ' || tone || ' version of: ' || text as prompt from documents, (values ('kind'), ('cross')) t(tone))
    select doc_id || '-' || tone as prompt_id, n::int as reply_no, n || '|' || prompt as text, null as error from p, (values (1), (2)) r(n) where substr(md5(prompt), 1, 1) <> 'f'
    union all select doc_id || '-' || tone, 0, null, 'RuntimeError: refused' from p where substr(md5(prompt), 1, 1) = 'f'""",
)
def generate_stub(spark, d):
    rows = expand_grid(documents(spark, d).select("doc_id", "text"), {"tone": ["kind", "cross"]}, position=None)
    prompts = rows.select(
        F.concat_ws("-", F.col("doc_id").cast("string"), "tone").alias("prompt_id"),
        F.concat(F.lit("A "), "tone", F.lit(" version of: "), "text").alias("prompt"),
    )
    return external.generate(prompts, EchoWriter, n=2, concurrency=8)


@query(
    "rewrite_stub",
    """with p as (select doc_id, 'Simplify: ' || text || ' Thanks.' as prompt from documents where text is not null)
    select doc_id, case when substr(md5(prompt), 1, 1) <> 'f' then 'plain: ' || prompt end as text,
    case when substr(md5(prompt), 1, 1) = 'f' then 'TimeoutError: busy' end as error from p""",
)
def rewrite_stub(spark, d):
    return external.rewrite(
        documents(spark, d), FlakyWriter, "doc_id", "text", "Simplify: {text} Thanks.", attempts=5, wait=0.001
    )


@query(
    "score_stub",
    """select doc_id, case when length(text) % 7 <> 0 then case when length(text) > 1000 then 'long' else 'short' end end as label,
    case when length(text) % 7 <> 0 then round(1.0::double / (1 + length(text)), 6) end as probability from documents""",
)
def score_stub(spark, d):
    rows = documents(spark, d).select("doc_id", "text")
    return external.score_external(rows, LengthScorer, "text").drop("text")


@query("embed_stub", f"select doc_id, list_sum([{_VOWELS}])::double as total, [{_VOWELS}][2]::double as e from documents")
def embed_stub(spark, d):
    rows = external.embed(documents(spark, d).select("doc_id", "text"), "text", "vowels", VowelEncoder)
    vector = F.col(external.embedding_column("text", "vowels"))
    total = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x)
    return rows.select("doc_id", total.alias("total"), vector[1].cast("double").alias("e"))


@query(
    "embed_all_stub",
    f"select conv_id, turn, list_sum([{_VOWELS}])::double as vowels, list_sum([{_MARKS}])::double as marks from conversations",
)
def embed_all_stub(spark, d):
    encoders = {"vowels": VowelEncoder, "marks": SpaceEncoder}
    rows = external.embed_all(table(spark, d, "conversations"), "text", encoders)
    totals = [
        F.aggregate(external.embedding_column("text", m), F.lit(0.0), lambda a, x: a + x).alias(m) for m in encoders
    ]
    return rows.select("conv_id", "turn", *totals)


@query(
    "vectors_by_content",
    f"""with known as (select distinct text from {REVIEWS})
    select doc_id, list_sum([{_VOWELS}])::double as total, [{_VOWELS}][2]::double as e,
      case when text is not null then 1 + (text not in (select text from known where text is not null))::int end as encoded_by,
      (select count(distinct text) from documents) as n_encoded from documents""",
)
def vectors_by_content(spark, d):
    """The labelled reviews are embedded first, all documents next: the second call encodes only what is new."""
    registry = Registry(spark, shared_dir(spark, "registry"))
    store = durable.vector_store(registry, "vowels")
    first = reviews(spark, d).select("doc_id", "text")
    durable.embed_by_content(first, "doc_id", "text", "vowels", VowelEncoder, registry, tasks=8)
    before = registry.versions(store.name)
    rows = durable.embed_by_content(documents(spark, d).select("doc_id", "text"), "doc_id", "text", "vowels", VowelEncoder, registry, tasks=8)
    vector = F.col(external.embedding_column("text", "vowels"))
    total = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x)
    calls = store.rows().select("_key", F.when(F.col("version").isin(before), 1).otherwise(2).alias("encoded_by"))
    out = rows.select("doc_id", text_key("text").alias("_key"), total.alias("total"), vector[1].cast("double").alias("e"))
    encoded = calls.count()
    return out.join(calls, "_key", "left").select("doc_id", "total", "e", "encoded_by", F.lit(encoded).cast("bigint").alias("n_encoded"))


@query(
    "replies_resumed",
    """with p as (select doc_id, 'Say again: ' || left(lang, 1) || ' ' || text as prompt from documents), s as (select prompt, min(doc_id) from p where prompt is not null group by prompt)
    select doc_id, n::int as reply_no, n || '|' || prompt as text, null as error, (select count(*) from s) as n_sent from p, (values (1), (2)) r(n) where substr(md5(prompt), 1, 1) <> 'f'
    union all select doc_id, 0, null, 'RuntimeError: refused', (select count(*) from s) from p where substr(md5(prompt), 1, 1) = 'f'""",
)
def replies_resumed(spark, d):
    """A run cut short after the first of several waves, and the run that goes on from the store."""
    prompts = documents(spark, d).select("doc_id", F.concat(F.lit("Say again: "), F.substring("lang", 1, 1), F.lit(" "), "text").alias("prompt"))
    store = durable.reply_store(Registry(spark, shared_dir(spark, "registry")), "echo")
    wave = max(prompts.count() // 3, 1)

    def ask(texts):
        return external.generate(texts, EchoWriter, 2, "_key", "text")

    durable.ask_new(prompts, "prompt", store, ask, wave_rows=wave, tasks=8, max_waves=1)
    early = store.rows().filter("error is not null").count()  # sent again by the second run
    out = durable.generate_durably(prompts, EchoWriter, store, 2, "doc_id", wave_rows=wave, tasks=8)
    sent = store.rows().filter("reply_no < 2").count() - early
    return out.withColumn("n_sent", F.lit(sent).cast("bigint"))


_ASKED = f"(select *, 'Give a label.\n' || text as prompt, (('0x' || substr(md5('Give a label.\n' || text), 1, 1))::int % 5) as k from {REVIEWS} where {unit('doc_id')} >= 0.5 and {unit('doc_id')} < 0.75)"


@query(
    "llm_classify_stub",
    f"""with t as (select *, row_number() over (partition by toxic order by {by_hash('doc_id')}) as rn from {_ASKED}),
      b as (select * from t where rn <= (select min(c) from (select count(*) as c from t group by toxic)))
    select doc_id, toxic, case when k < 3 then 'Looking at the review, Label ' || k || ' fits.' when k = 3 then 'I cannot tell.' end as reply,
    case when k < 4 then cast(k as int) end as prediction from b""".replace("\n' || text", "' || chr(10) || text"),
)
def llm_classify_stub(spark, d):
    rows = assign_splits(reviews(spark, d), "doc_id")
    parts = [rows.filter("toxic = 1"), rows.filter("toxic = 0")]
    return external.llm_classify(
        parts, "toxic", "doc_id", "text", Labeller, "Give a label.\n", "chat", "test", balance_data=True
    )


#: Where a share of the rows loses its text or vector: a draw by hash below this.
GAP = 0.05


def without(df, key, col):
    """``df`` with ``col`` set to null in the rows of the gap."""
    return df.withColumn(col, F.when(uniform(DEFAULT_SEED, F.lit("gap"), key) >= GAP, F.col(col)))


def gap_sql(key):
    return f"""{unit("'gap'", key)} < {GAP}"""


def _vectors(spark, d):
    """Vectors, some of them missing, with a binary label and split flags."""
    rows = without(table(spark, d, "embeddings"), "vec_id", "embedding").withColumn("y", (F.col("label") < 5).cast("int"))
    return assign_splits(rows, "vec_id")


_VECTORS = f"(select *, {gap_sql('vec_id')} as gap, (label < 5)::int as y, {unit('vec_id')} as u from embeddings)"


@query(
    "train_lr",
    """select dim::int as dim, 0.0::double as gradient from (select unnest(range(-1, max(len(embedding)))) as dim from embeddings)""",
)
def train_lr(spark, d):
    """Gradient of the regularised loss at the fitted model, by dimension (-1: intercept): zero at the optimum."""
    rows = _vectors(spark, d).filter("train = 1 and embedding is not null")
    n = rows.count()
    model = train.train(train.with_features(rows, "embedding", "y"), "logistic_regression", {"C": 1.0}, n)
    residual = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("decision"))) - F.col("y")
    spread = F.posexplode(F.concat(F.array(F.lit(1.0)), F.col("embedding").cast("array<double>")))
    slopes = train.score(rows, model, "embedding").select(residual.alias("r"), spread).groupBy("pos").agg(F.avg(F.col("r") * F.col("col")).alias("slope"))
    pull = F.element_at(F.array(*[F.lit(float(x) / n) for x in (0.0, *model.coefficients)]), F.col("pos") + 1)
    return slopes.select((F.col("pos") - 1).alias("dim"), (F.round(F.col("slope") + pull, 2) + F.lit(0.0)).alias("gradient"))


@query("score_lr", f"select vec_id, y, not gap as scored, case when not gap then true end as consistent, true as same_when_loaded from {_VECTORS}")
def score_lr(spark, d):
    """A support vector machine before and after it was saved: predictions follow decisions, missing vectors get none."""
    rows = _vectors(spark, d)
    path = shared_dir(spark, "model")
    model = train.train(train.with_features(rows.filter("train = 1"), "embedding", "y"), "SVM", {"C": 1.0})
    train.save_model(model, path)
    first = train.score(rows, model, "embedding").withColumnsRenamed({"prediction": "p", "decision": "s"})
    out = train.score(first, train.load_model(path), "embedding")
    same = F.col("prediction").eqNullSafe(F.col("p")) & F.col("decision").eqNullSafe(F.col("s"))
    consistent = F.col("prediction") == (F.col("decision") > 0).cast("int")
    return out.select("vec_id", "y", F.col("prediction").isNotNull().alias("scored"), consistent.alias("consistent"), same.alias("same_when_loaded"))


# Points of a square, by hash, away from its axes; opposite quarters are one class, so no line parts the classes.
_XOR = f"""(select vec_id, case when y > 0.5 then 0.3 + 1.4 * (y - 0.5) else -0.3 + 1.4 * (y - 0.5) end as b,
  case when x > 0.5 then 0.3 + 1.4 * (x - 0.5) else -0.3 + 1.4 * (x - 0.5) end as a
  from (select vec_id, {unit("'a'", 'vec_id')} as x, {unit("'b'", 'vec_id')} as y from embeddings))"""


@query("kernel_svm", f"select vec_id, (a * b > 0)::int as y, (a * b > 0)::int as prediction, (a * b > 0)::int as when_loaded, true as line_fails from {_XOR}")
def kernel_svm(spark, d):
    """A Gaussian kernel parts classes that no line parts; the saved model predicts the same."""
    side = lambda name: uniform(DEFAULT_SEED, F.lit(name), "vec_id") - 0.5
    away = lambda u: F.when(u > 0, F.lit(0.3) + u * 1.4).otherwise(F.lit(-0.3) + u * 1.4)
    rows = table(spark, d, "embeddings").select("vec_id", F.array(away(side("a")), away(side("b"))).alias("v"))
    rows = cut_lineage(rows.withColumn("y", (F.get("v", F.lit(0)) * F.get("v", F.lit(1)) > 0).cast("int")), "square")
    given = train.with_features(rows, "v", "y")
    n = rows.count()
    model = train.train(given, "SVM", {"C": 100.0, "gamma": 2.0}, n)
    line = train.train(given, "SVM", {"C": 100.0}, n)
    right = train.score(rows, line, "v").agg(F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("share"))
    path = shared_dir(spark, "model")
    train.save_model(model, path)
    out = train.score(rows, model, "v").drop("decision")
    again = train.score(out.withColumnRenamed("prediction", "first"), train.load_model(path), "v")
    return again.select("vec_id", "y", F.col("first").alias("prediction"), F.col("prediction").alias("when_loaded"), (right.scalar() < 0.85).alias("line_fails"))


@query(
    "train_multiclass",
    f"select label as actual, count(*) as n, true as known from {_VECTORS} where not gap and u >= 0.5 and u < 0.75 group by label",
)
def train_multiclass(spark, d):
    """A forest over all classes: the margins of its confusion matrix on the test rows."""
    rows = _vectors(spark, d)
    model = train.train(train.with_features(rows.filter("train = 1"), "embedding", "label"), "random_forest", n_classes=10)
    scored = train.score(rows.filter("test = 1"), model, "embedding").filter("prediction is not null")
    return M.confusion(scored, "label", "prediction").groupBy("actual").agg(
        F.sum("n").alias("n"), F.bool_and(F.col("predicted").between(0, model.numClasses - 1)).alias("known")
    )


@query(
    "grid_cv",
    f"""with v as (select *, floor({unit("'fold'", 'vec_id')} * 5.0::double)::int as fold from {_VECTORS} where not gap),
      f as (select fold, count(*) as n, sum(y) as k from v group by fold), t as (select sum(n) as n, sum(k) as k from f),
      a as (select round(avg(case when 2 * (t.k - f.k) > t.n - f.n then f.k else f.n - f.k end::double / f.n), 6) as accuracy from f, t)
    select penalty, c::double as c, true as valid, case when penalty = 'l1' and c = 0.001 then accuracy end as accuracy_of_none
    from (values ('l1'), ('l2')) p(penalty), (values (0.001), (0.01), (0.1), (1), (10), (100)) s(c), a""",
)
def grid_cv(spark, d):
    """The whole grid. With the strongest l1 penalty no coefficient is left, so accuracy is the majority's share."""
    rows = train.with_features(_vectors(spark, d), "embedding", "y")
    result = train.grid_cv(rows, "vec_id")
    out = spark.createDataFrame(result.table, "penalty string, c double, accuracy double").withColumn("c", F.round("c", 6))
    bare = (F.col("penalty") == "l1") & (F.col("c") == 0.001)
    return out.select(
        "penalty", "c", F.col("accuracy").between(0, 1).alias("valid"), F.when(bare, F.round("accuracy", 6)).alias("accuracy_of_none")
    )


@query(
    "search_mix",
    f"""with r as (select *, 'class ' || label as source from {_VECTORS} where not gap and u < 0.5),
      s as (select source, count(*) as size from r where label >= 5 group by source), t as (select unnest(range(20))::int as trial),
      x as (select trial, sum(1 + floor({unit("'rows'", 'source', 'trial')} * size)::bigint) as n from s, t group by trial)
    select trial, cast(n + (select count(*) from r where label < 5) as bigint) as n_rows, true as valid from x""",
)
def search_mix(spark, d):
    """Rows that each trial trains on: all of the first five classes, as many as drawn of each other."""
    rows = cut_lineage(_vectors(spark, d), "vectors")
    classes = sorted(r[0] for r in rows.select("label").distinct().collect())  # a dataset each
    datasets = {f"class {k}": rows.filter(F.col("label") == k) for k in classes}
    result = train.search_mix(
        datasets, [f"class {k}" for k in classes if k < 5], "logistic_regression", "y", "vec_id", "embedding", scorer=M.scorer("fbeta", beta=0.75)
    )
    return train.trials_frame(spark, result).select("trial", "n_rows", F.col("score").between(0, 1).alias("valid"))


# Vectors whose first component tells the class beyond doubt, so that SQL can foresee every prediction.
_LEDGER_TRIALS, _LEDGER_STOP = 6, 3


@query(
    "search_ledger",
    f"""with r as (select *, 'class ' || label as source from {_VECTORS} where not gap),
      s as (select source, count(*) as size from r where label >= 5 and u < 0.5 group by source), t as (select unnest(range({_LEDGER_TRIALS}))::int as trial),
      x as (select trial, sum(1 + floor({unit("'rows'", 'source', 'trial')} * size)::bigint) as n from s, t group by trial),
      v as (select min(c) as c from (select count(*) as c from r where u >= 0.75 group by y)),
      o as (select trial, n + (select count(*) from r where label < 5 and u < 0.5) as n_rows from x)
    select 'vectors/' || trial as run_id, 'n_rows' as name, n_rows::double as value, null as text from o
    union all select 'vectors/' || trial, 'score', 1.0::double, null from o
    union all select 'session', trial::varchar, (1 + (trial >= {_LEDGER_STOP})::int)::double, null from o
    union all select 'vectors', name, value::double, null from v, (values ('tp', c), ('tn', c), ('fp', 0), ('fn', 0), ('f1', 1), ('validation score', 1), ('test score', 1)) m(name, value)
    union all select 'vectors', 'model name', null, 'logistic_regression vectors'
    union all select 'vectors', 'class ' || k || '_version', 1.0::double, '1' from range(10) c(k)
    union all select 'again', name, value::double, null from v, (values ('tp', c), ('tn', c)) m(name, value)""",
)
def search_ledger(spark, d):
    """A search that dies after three of six trials and is called again: what the run log holds, who ran which trial, and the run assessed anew."""
    home = shared_dir(spark, "ledger")
    registry, log = Registry(spark, f"{home}/data"), RunLog(spark, f"{home}/log")
    column = external.embedding_column("text", "stored")
    side = F.when(F.col("label") < 5, F.lit(6.0)).otherwise(F.lit(-6.0))
    clear = F.when(F.col("embedding").isNotNull(), F.concat(F.array(side), F.transform("embedding", lambda x: x.cast("double"))))
    rows = cut_lineage(_vectors(spark, d).select("vec_id", "label", "y", "train", "test", "val", clear.alias(column)), "clear")
    names = [f"class {k}" for k in range(10)]
    for k, name in enumerate(names):
        registry.write_dataset(rows.where(F.col("label") == k), name)
    calls = []

    def failing(scored, y, p):
        calls.append(1)
        if len(calls) > _LEDGER_STOP:
            raise RuntimeError("the driver is gone")
        return M.scorer("f1")(scored, y, p)

    def run(scorer):
        return search_and_record(
            registry, log, home, "vectors", names[:5], names[5:], "logistic_regression", "y", "vec_id", "text", "stored",
            trials=_LEDGER_TRIALS, scorer=scorer, fixed={"C": 1000.0}, parallelism=1,
        )

    try:
        run(failing)
    except RuntimeError:
        registry.write_dataset(rows.limit(0), names[0])  # a newer version must not change a search that was begun
        run(M.scorer("f1"))
        run(M.scorer("f1"))  # finished: nothing is logged twice
    kept = ["tp", "tn", "fp", "fn", "f1", "validation score", "test score", "score", "n_rows", runlog.MODEL_NAME, *(f"{n}_version" for n in names)]
    logged = log.read().where(F.col("name").isin(kept)).select("run_id", "name", "value", "text")
    sessions = Ledger(spark, f"{home}/searches/vectors", session=9).trials()
    by = sessions.select(F.lit("session").alias("run_id"), F.col("trial").cast("string").alias("name"), F.col("session").cast("double").alias("value"), F.lit(None).cast("string").alias("text"))
    registry.write_dataset(rows.where("label = 0"), names[0])
    again = reassess(log, registry, "vectors", f"{home}/models", "vec_id").select(F.lit("again").alias("run_id"), "tp", "tn")
    again = again.unpivot(["run_id"], ["tp", "tn"], "name", "value").select("run_id", "name", F.col("value").cast("double"), F.lit(None).cast("string").alias("text"))
    return logged.unionByName(by).unionByName(again)


_RUNS = """(select source as experiment, doc_id::varchar as run_id, lang as name, n_chars::double as value from documents)"""


@query(
    "leaderboard",
    f"""select experiment, run_id, value from (select *, row_number() over (partition by experiment order by value desc, run_id) as rn
    from {_RUNS} where name = 'en') where rn = 1""",
)
def leaderboard(spark, d):
    runs = table(spark, d, "documents").select(
        F.col("source").alias("experiment"),
        F.col("doc_id").cast("string").alias("run_id"),
        F.col("lang").alias("name"),
        F.col("n_chars").cast("double").alias("value"),
    )
    return runlog.leaderboard(runs, "en")


@query(
    "runs_lookup",
    """select 'model ' || user_id as model, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as created, arg_max(event_id, ts)::varchar as run_id
    from events group by user_id""",
)
def runs_lookup(spark, d):
    runs = table(spark, d, "events").select(
        F.col("event_type").alias("experiment"),
        F.col("event_id").cast("string").alias("run_id"),
        F.lit(runlog.MODEL_NAME).alias("name"),
        F.concat(F.lit("model "), F.col("user_id").cast("string")).alias("text"),
        F.col("ts").alias("logged_at"),
    )
    return runlog.list_models(runs).withColumn("created", F.date_format("created", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    "assess_run",
    f"""with n as (select min(c) as c from (select count(*) as c from {_VECTORS} where not gap and u >= 0.75 group by y))
    select c as n_negative, c as n_positive, true as valid from n""",
)
def assess_run(spark, d):
    """Register, train, log; then assess the recorded run from its log lines alone."""
    home = shared_dir(spark, "runs")
    registry, log = Registry(spark, f"{home}/data"), RunLog(spark, f"{home}/log")
    column = external.embedding_column("text", "stored")
    rows = _vectors(spark, d).withColumnRenamed("embedding", column)
    registry.write_dataset(rows.filter("y = 1"), "flagged")
    registry.write_dataset(rows.filter("y = 0"), "published")
    fit = train.with_features(rows.filter("train = 1"), column, "y")
    train.save_model(train.train(fit, "logistic_regression", {"C": 1.0}), f"{home}/models/gentle heron")
    settings = {
        "positive_label_dataset_name_list": ["flagged"],
        "negative_label_dataset_name_list": ["published"],
        "augmented_dataset_name_list": [],
        "name_of_y_column": "y",
        "name_of_column_to_embed": "text",
        "model_for_embeddings_name": "stored",
        "balance_val": True,
        runlog.MODEL_NAME: "gentle heron",
    }
    log.log_attributes(settings, "run-1")
    log.log_dataset_versions(registry, ["flagged", "published"], "run-1")
    out = reassess(log, registry, "run-1", f"{home}/models", "vec_id")
    return out.select((F.col("tn") + F.col("fp")).alias("n_negative"), (F.col("fn") + F.col("tp")).alias("n_positive"), F.col("f1").between(0, 1).alias("valid"))

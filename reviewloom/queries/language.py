"""Terms, lexicons and text augmentation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from reviewloom.functions.text import WHITESPACE, ngrams, tokens
from reviewloom.operators import augment, bias, phrases, terms
from reviewloom.operators.sampling import assign_splits
from reviewloom.queries.base import REVIEWS, documents, query, reviews, sentences_sql, strip_sql, table, unit, words_sql

STOPWORDS = ["a", "and", "by", "de", "is", "la", "le", "of", "on", "the", "un"]
_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)

# Multiples of 1/8, so that sums are exact in any order.
POLARITY = {"the": 0.5, "of": -0.25, "with": 1.0, "de": -1.0, "elle": 0.75, "und": 0.125, "que": -0.375, "he": 0.25}
_POLARITY = ", ".join(f"('{w}', {p}::double)" for w, p in POLARITY.items())

TAGS = {"is": "VBZ", "was": "VBD", "are": "VBP", "had": "VBD", "has": "VBZ", "it": "PRP", "elle": "PRP", "that": "DT", "the": "DT", "er": "PRP", "est": "VBZ"}
_TAGGED = ", ".join(f"'{w}'" for w in TAGS)
_TAG_CASES = " ".join(f"when '{w}' then '{t}'" for w, t in TAGS.items())

NAMES = {"of the": "ORG", "the": "MISC", "la": "PER", "is on the": "LOC", "de la": "PER", "und er": "PER", "it": "ORG"}
_NAMES = ", ".join(f"('{p}', '{e}')" for p, e in NAMES.items())

MODIFIERS = ["the", "la", "un", "die", "with", "er"]
_MODIFIERS = ", ".join(f"('{m}')" for m in MODIFIERS)

SYNONYMS = {"the": "this", "of": "from", "that": "which", "le": "ce", "elle": "lui", "with": "alongside", "in": "within", "que": "quoi"}

_FILTERED = f"list_filter({words_sql('text')}, lambda w: w not in ({_STOP}))"


def _lexicon(spark, rows, schema):
    return spark.createDataFrame(list(rows), schema)


def _dictionary(spark, d):
    """The words of the benchmark texts stand in for a spelling dictionary."""
    return table(spark, d, "benchmark").select(F.explode(tokens("text")).alias("token")).distinct()


_DICTIONARY = f"(select distinct unnest({words_sql('text')}) as token from benchmark)"


@query(
    "token_counts",
    f"select doc_id, len({words_sql('text')}) as n_tokens, len({_FILTERED}) as n_kept, len(list_distinct({_FILTERED})) as n_distinct from documents",
)
def token_counts(spark, d):
    kept = tokens("text", STOPWORDS)
    return documents(spark, d).select(
        "doc_id",
        F.size(tokens("text")).cast("bigint").alias("n_tokens"),
        F.size(kept).cast("bigint").alias("n_kept"),
        F.size(F.array_distinct(kept)).cast("bigint").alias("n_distinct"),
    )


_BIGRAMS = f"""(select toxic, unnest(list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])) as ngram
  from (select toxic, {_FILTERED} as k from {REVIEWS}))"""


@query(
    "distinctive_bigrams",
    f"""select ngram, n1, n0, n1 - n0 as diff from (select ngram, count(*) filter (toxic = 0) as n1, count(*) filter (toxic = 1) as n0
    from {_BIGRAMS} group by ngram) where n1 > 15 and (n0 = 0 or n0 > 15)""",
)
def distinctive_bigrams(spark, d):
    """The larger class plays the class of interest, as rare classes have no bigram above the threshold."""
    rows = reviews(spark, d).select((1 - F.col("toxic")).alias("published"), "text")
    return terms.distinctive_ngrams(rows, "published", "text", 2, 15, STOPWORDS)


_TERM_COUNTS = f"""(select term, count(*) filter (toxic = 1) as n1, count(*) filter (toxic = 0) as n0
  from (select toxic, unnest({_FILTERED}) as term from {REVIEWS}) group by term)"""


def _class_terms(spark, d):
    return terms.class_term_counts(reviews(spark, d).select("toxic", "text"), "toxic", tokens("text", STOPWORDS))


@query(
    "term_difference_signed",
    f"select term, n1, n0, n1 - n0 as diff from {_TERM_COUNTS} where n1 + n0 > 0 order by n1 - n0 desc, term limit 10",
)
def term_difference_signed(spark, d):
    return terms.freq_difference(_class_terms(spark, d), 10, "signed")


@query(
    "term_difference_abs",
    f"select term, n1, n0, n1 - n0 as diff from {_TERM_COUNTS} where n1 > 0 and n0 > 0 order by abs(n1 - n0) desc, term limit 20",
)
def term_difference_abs(spark, d):
    return terms.freq_difference(_class_terms(spark, d), 20, "abs")


@query(
    "feature_means",
    f"""with x(token, polarity) as (values {_POLARITY}), w as (select doc_id, unnest({words_sql('text')}) as token from {REVIEWS}),
      s as (select doc_id, avg(polarity) as sentiment from w join x on w.token = x.token group by doc_id)
    select toxic, round(avg(coalesce(sentiment, 0)), 6) as avg_sentiment, round(avg(length(text)), 6) as avg_text_length
    from {REVIEWS} r left join s on r.doc_id = s.doc_id group by toxic""",
)
def feature_means(spark, d):
    rows = reviews(spark, d).select("doc_id", "toxic", "text", F.length("text").alias("text_length"))
    lexicon = _lexicon(spark, POLARITY.items(), "token string, polarity double")
    features = rows.drop("text").join(terms.lexicon_sentiment(rows, "doc_id", "text", lexicon), "doc_id")
    out = terms.feature_means(features, "toxic", ["sentiment", "text_length"])
    return out.select("toxic", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query(
    "misspellings",
    f"""with w as (select doc_id, unnest(list_distinct({words_sql('text')})) as token from documents),
      m as (select doc_id, count(*) as n from w where token not in (select token from {_DICTIONARY}) group by doc_id)
    select d.doc_id, coalesce(m.n, 0) as misspellings from documents d left join m on d.doc_id = m.doc_id""",
)
def misspellings(spark, d):
    return terms.misspellings(documents(spark, d), "doc_id", "text", _dictionary(spark, d))


@query(
    "lexicon_sentiment",
    f"""with x(token, polarity) as (values {_POLARITY}), w as (select doc_id, unnest({words_sql('text')}) as token from documents),
      s as (select doc_id, avg(polarity) as p from w join x on w.token = x.token group by doc_id)
    select d.doc_id, coalesce(p, 0) as sentiment from documents d left join s on d.doc_id = s.doc_id""",
)
def lexicon_sentiment(spark, d):
    lexicon = _lexicon(spark, POLARITY.items(), "token string, polarity double")
    return terms.lexicon_sentiment(documents(spark, d), "doc_id", "text", lexicon)


@query(
    "tag_frequencies",
    f"""with w as (select toxic, unnest(list_filter({words_sql('text')}, lambda w: w in ({_TAGGED}))) as token from {REVIEWS})
    select case token {_TAG_CASES} end as tag, count(*) filter (toxic = 1) as n1, count(*) filter (toxic = 0) as n0 from w group by 1""",
)
def tag_frequencies(spark, d):
    tags = _lexicon(spark, TAGS.items(), "token string, tag string")
    return terms.tag_terms(reviews(spark, d).select("toxic", "text"), "toxic", "text", tags)


_SPANS = " union all ".join(
    f"select doc_id, i - 1 as start, array_to_string(k[i:i + {n - 1}], ' ') as phrase from (select doc_id, k, unnest(range(1, len(k) - {n - 2})) as i from t)"
    for n in (1, 2, 3)
)


@query(
    "name_mentions",
    f"""with t as (select doc_id, {words_sql('text')} as k from documents), x(phrase, entity) as (values {_NAMES}), s as ({_SPANS})
    select doc_id, cast(start as int) as start, entity, s.phrase as phrase from s join x on s.phrase = x.phrase""",
)
def name_mentions(spark, d):
    gazetteer = _lexicon(spark, NAMES.items(), "phrase string, entity string")
    return phrases.phrase_mentions(documents(spark, d), "doc_id", "text", gazetteer)


# Openings of the benchmark texts, up to 24 words long and one inside the other, next to the short names.
_LENGTHS = (2, 5, 24)
_OPENINGS = " union ".join(
    f"select array_to_string(k[1:{n}], ' ') as phrase, 'ITEM{n}' as entity from (select {words_sql('text')} as k from benchmark) where len(k) >= {n}" for n in _LENGTHS
)


def _longest_sql() -> str:
    """Each phrase is met by its own word count and first word; then from place to place, the longest at each."""
    return f"""with recursive t as (select doc_id, {words_sql('text')} as k from documents),
      x(phrase, entity) as (values {_NAMES} union {_OPENINGS}),
      g as (select distinct phrase, len(string_split(phrase, ' ')) as n, string_split(phrase, ' ')[1] as opener from x),
      p as (select doc_id, k, unnest(range(1, len(k) + 1)) as i from t),
      s as (select doc_id, i, max_by(phrase, n) as phrase, max(n) as n from p join g on k[i] = opener and k[i:i + n - 1] = string_split(phrase, ' ') group by doc_id, i),
      r as (select doc_id, min(i) as i from s group by doc_id
        union all select r.doc_id, (select min(z.i) from s z where z.doc_id = r.doc_id and z.i >= r.i + y.n) from r join s y on r.doc_id = y.doc_id and r.i = y.i)
    select r.doc_id, cast(r.i - 1 as int) as start, entity, s.phrase from r join s on r.doc_id = s.doc_id and r.i = s.i join x on s.phrase = x.phrase"""


@query("name_mentions_longest", _longest_sql())
def name_mentions_longest(spark, d):
    words = table(spark, d, "benchmark").select(tokens("text").alias("_w"))
    openings = [
        words.filter(F.size("_w") >= n).select(F.concat_ws(" ", F.slice("_w", 1, n)).alias("phrase"), F.lit(f"ITEM{n}").alias("entity")) for n in _LENGTHS
    ]
    gazetteer = reduce(lambda a, b: a.union(b), [_lexicon(spark, NAMES.items(), "phrase string, entity string"), *openings])
    return phrases.phrase_mentions(documents(spark, d), "doc_id", "text", gazetteer, "longest")


@query(
    "modifier_pairs",
    f"""with t as (select doc_id, {words_sql('text')} as k from documents), x(token) as (values {_MODIFIERS}),
      p as (select doc_id, i - 1 as pos, k[i] as modifier, k[i + 1] as head from (select doc_id, k, unnest(range(1, len(k))) as i from t))
    select doc_id, cast(pos as int) as pos, modifier, head from p join x on p.modifier = x.token""",
)
def modifier_pairs(spark, d):
    modifiers = _lexicon(spark, [(m,) for m in MODIFIERS], "token string")
    return terms.modifier_pairs(documents(spark, d), "doc_id", "text", modifiers)


@query(
    "vocabulary_top",
    r"""select term, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) as term from documents)
    group by term order by n desc, term limit 10000""",
)
def vocabulary_top(spark, d):
    return terms.vocabulary(documents(spark, d), "text")


_PAIRS = f"(select unnest(list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])) as pair from (select {words_sql('text')} as k from documents))"


@query("frequent_pairs", f"select pair, count(*) as n from {_PAIRS} group by pair order by n desc, pair limit 200")
def frequent_pairs(spark, d):
    """The 200 most frequent pairs of neighbouring words, counted without a shuffle of the rare ones."""
    words = documents(spark, d).select(tokens("text").alias("words"))
    return terms.frequent_terms(words, ngrams("words", 2), 200, "pair")


@query(
    "text_features",
    rf"""with x(token, polarity) as (values {_POLARITY}), w as (select doc_id, unnest({words_sql('text')}) as token from documents),
      s as (select doc_id, avg(polarity) as p from w join x on w.token = x.token group by doc_id),
      m as (select doc_id, count(distinct token) as n from w where token not in (select token from {_DICTIONARY}) group by doc_id),
      l as (select doc_id, len(regexp_extract_all(text, '[^{WHITESPACE}]+')) as text_length from documents)
    select l.doc_id, cast(text_length as int) as text_length, coalesce(p, 0) as sentiment, coalesce(n, 0) as spelling_mistakes,
      case when text_length = 0 then 0 else coalesce(n, 0)::double / text_length end as spelling_mistakes_rate
    from l left join s on l.doc_id = s.doc_id left join m on l.doc_id = m.doc_id""",
)
def text_features(spark, d):
    lexicon = _lexicon(spark, POLARITY.items(), "token string, polarity double")
    return bias.text_features(documents(spark, d), "doc_id", "text", _dictionary(spark, d), lexicon)


def _shuffled_sql(copy: str) -> str:
    return f"""case when len(p) < 2 then text else array_to_string(list_transform(list_sort(list_transform(p,
      lambda s, i: {{'h': md5(concat_ws('|', '42', doc_id::varchar, {copy}::varchar, (i - 1)::varchar)), 's': {strip_sql('s')}}})), lambda z: z.s), '. ') end"""


_PIECES = f"(select doc_id, text, {sentences_sql('text')} as p from documents)"


@query(
    "augment_shuffle",
    f"select doc_id, copy, {_shuffled_sql('copy')} as text from {_PIECES}, (select unnest([1, 2])::int as copy)",
)
def augment_shuffle(spark, d):
    return augment.shuffle_sentences(documents(spark, d), "doc_id", "text", n=2)


_SWAP = "case lower(w) " + " ".join(f"when '{a}' then '{b}'" for a, b in SYNONYMS.items()) + " else w end"


def _substituted_sql(copy: str, rate: float, stop: list[str]) -> str:
    draw = unit("doc_id", copy, "(i - 1)", "(j - 1)")
    barred = f" and lower(w) not in ({', '.join(repr(s) for s in stop)})" if stop else ""
    return f"""array_to_string(list_transform(p, lambda s, i: array_to_string(list_transform(string_split({strip_sql('s')}, ' '),
      lambda w, j: case when {draw} < {rate}{barred} then {_SWAP} else w end), ' ')), '. ')"""


@query(
    "augment_substitute",
    f"select doc_id, copy, {_substituted_sql('copy', 0.05, ['the', 'le'])} as text from {_PIECES}, (select 1 as copy)",
)
def augment_substitute(spark, d):
    synonyms = _lexicon(spark, SYNONYMS.items(), "token string, synonym string")
    return augment.substitute_words(documents(spark, d), "doc_id", "text", synonyms, 1, 0.05, ["the", "le"])


@query(
    "augment_dataset",
    f"select doc_id, {_shuffled_sql('1')} as text from {_PIECES} union all select doc_id, {_shuffled_sql('2')} from {_PIECES}",
)
def augment_dataset(spark, d):
    return augment.augment_dataset(documents(spark, d), "doc_id", "text", augment.shuffled_sentences(), 2)


@query(
    "augment_train_only",
    f"""select doc_id, {_shuffled_sql('1')} as text, 0 as is_complaint, 1 as train, 0 as test, 0 as val from {_PIECES}
    where {unit('doc_id')} < 0.5""",
)
def augment_train_only(spark, d):
    rows = assign_splits(documents(spark, d), "doc_id")
    return augment.augment_train(rows, "doc_id", "text", augment.shuffled_sentences(), 1, "is_complaint", 0)

"""Text scalars and tagged-sentence statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import arrays, scalars, text
from quarry.plans.registry import query
from quarry.plans.sqlviews import SQL_TAG_NAMES, SQL_TOKENS, with_views
from quarry.sources.tables import table
from quarry.sources.text import ENTITY_B_IDS, TAG_NAMES, reviews, sentences

# Word sets that occur in the test prose (the reference's sentiment sets are
# used by the LF queries; these give the oracle something to count).
PARAM_WORDS = ["the", "of", "der", "la"]
NUMBER_PATTERN = r"^[0-9]+$"
CAP_PATTERN = r"^(the|and|der)$"


@query("fn_strip_br", r"""
SELECT page_id, regexp_replace(html, '<br\s*/?>', ' ', 'g') AS text FROM pages""")
def q_strip_br(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages", "page_id", "html")
    return p.select("page_id", text.strip_br("html").alias("text"))


@query("fn_strip_punct", r"""
SELECT doc_id, regexp_replace(text, '[^\p{L}\p{N}_\s'']', '', 'g') AS text FROM documents""")
def q_strip_punct(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents", "doc_id", "text")
    return d.select("doc_id", text.strip_punct("text").alias("text"))


@query("fn_clean_text", r"""
SELECT page_id, lower(regexp_replace(regexp_replace(html, '<br\s*/?>', ' ', 'g'), '[^\p{L}\p{N}_\s'']', '', 'g')) AS text FROM pages""")
def q_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages", "page_id", "html")
    return p.select("page_id", text.clean_text("html").alias("text"))


@query("fn_tokenize_any_word", f"""
SELECT id, CAST(len(tokens) AS INTEGER) AS n_tokens, list_has_any(tokens, {PARAM_WORDS!r}) AS any_word
FROM (SELECT doc_id AS id, {SQL_TOKENS.format(t="text")} AS tokens FROM documents)""")
def q_tokenize_any_word(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents", "doc_id", "text")
    return d.select(F.col("doc_id").alias("id"), F.size(text.tokens("text")).alias("n_tokens"),
                    text.any_word_in("text", PARAM_WORDS).alias("any_word"))


@query("fn_count_char", """
SELECT doc_id, CAST(length(text) - length(replace(text, '!', '')) AS INTEGER) AS n_exclaim FROM documents""")
def q_count_char(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents", "doc_id", "text")
    return d.select("doc_id", text.count_char("text", "!").alias("n_exclaim"))


def _regex_query(pattern: str, ignore_case: bool):
    def fn(spark: SparkSession, sf: str) -> DataFrame:
        s = sentences(spark, sf)
        return s.select("id", text.any_token_matches("tokens", pattern, ignore_case).alias("hit"),
                        text.any_token_matches("tokens", NUMBER_PATTERN if not ignore_case else CAP_PATTERN,
                                               ignore_case).alias("hit_param"))
    return fn


def _regex_sql(pattern: str, param: str, ignore_case: bool) -> str:
    flag = "(?i)" if ignore_case else ""
    return with_views(f"""
SELECT id, list_bool_or(list_transform(tokens, lambda t: regexp_matches(t, '{flag}{pattern}'))) AS hit,
       list_bool_or(list_transform(tokens, lambda t: regexp_matches(t, '{flag}{param}'))) AS hit_param
FROM sentences""", "sentences")


query("fn_regex_token", _regex_sql(text.YEAR_PATTERN, NUMBER_PATTERN, False))(_regex_query(text.YEAR_PATTERN, False))
query("fn_regex_token_ci", _regex_sql(text.ORG_SUFFIX_PATTERN.replace("\\.", "[.]"), CAP_PATTERN, True))(
    _regex_query(text.ORG_SUFFIX_PATTERN, True))


@query("fn_tag_decode", with_views(f"""
SELECT split, tag, count(*) AS n_tokens FROM (
  SELECT split, unnest(list_transform(ner_tags, lambda i: {SQL_TAG_NAMES}[i + 1])) AS tag FROM sentences)
GROUP BY split, tag""", "sentences"))
def q_tag_decode(spark: SparkSession, sf: str) -> DataFrame:
    s = sentences(spark, sf)
    return (s.select("split", F.explode(text.tag_decode("ner_tags", TAG_NAMES)).alias("tag"))
            .groupBy("split", "tag").agg(F.count(F.lit(1)).alias("n_tokens")))


def _truth_cols(s: DataFrame) -> DataFrame:
    names = text.tag_decode("ner_tags", TAG_NAMES)
    return s.select("split", "id", names.alias("tags"))


@query("fn_array_any_in_set", with_views(f"""
SELECT id, list_has_any(list_transform(ner_tags, lambda i: {SQL_TAG_NAMES}[i + 1]), ['B-ORG', 'I-ORG']) AS has_org FROM sentences""", "sentences"))
def q_any_in_set(spark: SparkSession, sf: str) -> DataFrame:
    t = _truth_cols(sentences(spark, sf))
    return t.select("id", text.any_tag_in("tags", ["B-ORG", "I-ORG"]).alias("has_org"))


@query("fn_contains", with_views(f"""
SELECT id, list_bool_or(list_transform(ner_tags, lambda i: contains({SQL_TAG_NAMES}[i + 1], 'MISC'))) AS has_misc FROM sentences""", "sentences"))
def q_contains(spark: SparkSession, sf: str) -> DataFrame:
    t = _truth_cols(sentences(spark, sf))
    return t.select("id", text.any_tag_contains("tags", "MISC").alias("has_misc"))


@query("split_sizes", with_views("SELECT split, count(*) AS n_sentences FROM sentences GROUP BY split", "sentences"))
def q_split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return sentences(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("n_sentences"))


_ENTITY_SQL = """
SELECT split, CASE tag WHEN 1 THEN 'PER' WHEN 3 THEN 'ORG' WHEN 5 THEN 'LOC' ELSE 'MISC' END AS entity, count(*) AS n_entities
FROM (SELECT split, unnest(ner_tags) AS tag FROM sentences) WHERE tag IN (1, 3, 5, 7) GROUP BY split, entity"""


def entity_counts(s: DataFrame) -> DataFrame:
    """Count B- tags only (entities, not tokens) per split and entity.

    Tags are exploded and filtered before the group, so the shuffle carries
    one partial count per (split, entity) per task."""
    by_id = F.create_map(*[x for e, i in ENTITY_B_IDS.items() for x in (F.lit(i), F.lit(e))])
    return (s.select("split", F.explode("ner_tags").alias("tag"))
            .filter(F.col("tag").isin(list(ENTITY_B_IDS.values())))
            .groupBy("split", by_id[F.col("tag")].alias("entity"))
            .agg(F.count(F.lit(1)).alias("n_entities")))


@query("entity_counts", with_views(_ENTITY_SQL, "sentences"))
def q_entity_counts(spark: SparkSession, sf: str) -> DataFrame:
    return entity_counts(sentences(spark, sf))


@query("entity_totals", with_views(f"""
SELECT split, entity, n_entities FROM ({_ENTITY_SQL})
UNION ALL SELECT split, 'TOTAL', sum(n_entities)::BIGINT FROM ({_ENTITY_SQL}) GROUP BY split""", "sentences"))
def q_entity_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Per-entity counts and per-split totals in one pass (``rollup``)."""
    s = sentences(spark, sf)
    by_id = F.create_map(*[x for e, i in ENTITY_B_IDS.items() for x in (F.lit(i), F.lit(e))])
    ents = (s.select("split", F.explode("ner_tags").alias("tag"))
            .filter(F.col("tag").isin(list(ENTITY_B_IDS.values())))
            .select("split", by_id[F.col("tag")].alias("entity")))
    r = ents.rollup("split", "entity").agg(F.count(F.lit(1)).alias("n_entities"), F.grouping_id().alias("g"))
    return (r.filter(F.col("split").isNotNull())
            .select("split", F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("entity")).alias("entity"), "n_entities"))


# ------------------------------------------------------------------ numbers / maps

@query("fn_zero_pad", """
SELECT p_partkey, CASE WHEN length(CAST(p_size AS VARCHAR)) >= 5 THEN CAST(p_size AS VARCHAR) ELSE lpad(CAST(p_size AS VARCHAR), 5, '0') END AS padded,
       CASE WHEN length(CAST(p_partkey AS VARCHAR)) >= 4 THEN CAST(p_partkey AS VARCHAR) ELSE lpad(CAST(p_partkey AS VARCHAR), 4, '0') END AS code
FROM part""")
def q_zero_pad(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part", "p_partkey", "p_size")
    return p.select("p_partkey", scalars.zero_pad("p_size", 5).alias("padded"), scalars.zero_pad("p_partkey", 4).alias("code"))


@query("fn_round", """
SELECT event_id, CAST(round(CAST(value AS DECIMAL(18,2)) * 0.5, 2) AS DOUBLE) AS half_up,
       CAST(round_even(CAST(value AS DECIMAL(18,2)) * 0.5, 2) AS DOUBLE) AS half_even FROM events""")
def q_round(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", "event_id", "value")
    v = F.col("value").cast("decimal(18,2)") * F.lit(0.5).cast("decimal(2,1)")
    return e.select("event_id", scalars.round_half_up(v, 2).cast("double").alias("half_up"),
                    scalars.round_half_even(v, 2).cast("double").alias("half_even"))


@query("fn_is_number", r"""
SELECT event_id, TRY_CAST(trim(regexp_extract(props, ':\s*([^}]*)', 1)) AS BIGINT) IS NOT NULL AS prop_is_int,
       TRY_CAST(trim(regexp_extract(props, ':\s*([^}]*)', 1)) AS DOUBLE) IS NOT NULL AS prop_is_float,
       TRY_CAST(trim(event_type) AS DOUBLE) IS NOT NULL AS type_is_float FROM events""")
def q_is_number(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", "event_id", "props", "event_type")
    raw = F.regexp_extract("props", r":\s*([^}]*)", 1)
    return e.select("event_id", scalars.is_int(raw).alias("prop_is_int"), scalars.is_float(raw).alias("prop_is_float"),
                    scalars.is_float("event_type").alias("type_is_float"))


@query("fn_add", "SELECT event_id, event_id + user_id AS total FROM events")
def q_add(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", "event_id", "user_id")
    return e.select("event_id", scalars.add("event_id", "user_id").alias("total"))


@query("fn_sum_list", with_views("""
SELECT id, CAST(list_sum(list_transform(tokens, lambda t: length(t))) AS BIGINT) AS n_chars FROM sentences""", "sentences"))
def q_sum_list(spark: SparkSession, sf: str) -> DataFrame:
    s = sentences(spark, sf)
    lens = F.transform("tokens", lambda t: F.length(t).cast("long"))
    return s.select("id", F.aggregate(lens, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_chars"))


@query("fn_factorial", """
SELECT p_partkey, CAST(list_reduce(list_transform(generate_series(1, p_size), lambda x: CAST(x AS DOUBLE)), lambda a, b: a * b) AS DOUBLE) AS fact
FROM part""")
def q_factorial(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part", "p_partkey", "p_size")
    return p.select("p_partkey", scalars.factorial("p_size").alias("fact"))


@query("fn_min_threshold", """
SELECT p_partkey, CASE WHEN p_size >= 25 THEN p_size END AS size_ok FROM part""")
def q_min_threshold(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part", "p_partkey", "p_size")
    return p.select("p_partkey", scalars.min_threshold("p_size", 25).alias("size_ok"))


@query("fn_dict_get_default", """
SELECT event_id, coalesce(json_extract_string(props, '$.k'), '0') AS k, coalesce(json_extract_string(props, '$.missing'), 'Unknown') AS missing
FROM events""")
def q_dict_get_default(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", "event_id", "props")
    m = F.from_json("props", "map<string,string>")
    return e.select("event_id", scalars.dict_get_default(m, "k", "0").alias("k"),
                    scalars.dict_get_default(m, "missing", "Unknown").alias("missing"))


@query("fn_dict_merge", """
SELECT event_id, key, value FROM (
  SELECT event_id, unnest(map_keys(m)) AS key, unnest(map_values(m)) AS value FROM (
    SELECT event_id, map_concat(MAP {'k': '0', 'type': 'none', 'lr': '0.01'},
                                MAP {'k': json_extract_string(props, '$.k'), 'type': event_type}) AS m FROM events))""")
def q_dict_merge(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", "event_id", "props", "event_type")
    defaults = F.create_map(F.lit("k"), F.lit("0"), F.lit("type"), F.lit("none"), F.lit("lr"), F.lit("0.01"))
    layer = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("type"), F.col("event_type"))
    merged = scalars.dict_merge(defaults, layer)
    return e.select("event_id", F.explode(merged).alias("key", "value"))


# ------------------------------------------------------------------ vectors

_SCORES = arrays.class_scores_sql('embedding', 10)


@query("fn_normalize_array", """
SELECT vec_id, pos - 1 AS pos, (CAST(x AS DOUBLE) - 0.5) / 0.25 AS z
FROM (SELECT vec_id, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings)""")
def q_normalize(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings", "vec_id", "embedding")
    z = arrays.normalize("embedding", [0.5], [0.25])
    return e.select("vec_id", F.posexplode(z).alias("pos", "z")).withColumn("pos", F.col("pos").cast("long"))


@query("fn_softmax", f"""
SELECT vec_id, pos - 1 AS pos, round(p, 6) AS p FROM (
  SELECT vec_id, unnest(list_transform(s, lambda x: exp(x - list_max(s)) / list_sum(list_transform(s, lambda y: exp(y - list_max(s)))))) AS p,
         unnest(generate_series(1, len(s))) AS pos
  FROM (SELECT vec_id, {_SCORES} AS s FROM embeddings))""")
def q_softmax(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings", "vec_id", "embedding")
    sm = arrays.softmax(arrays.class_scores("embedding", 10))
    return (e.select("vec_id", F.posexplode(sm).alias("pos", "p"))
            .select("vec_id", F.col("pos").cast("long").alias("pos"), F.round("p", 6).alias("p")))


@query("fn_argmax", f"""
SELECT vec_id, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS pred, list_max(s) AS top FROM (SELECT vec_id, {_SCORES} AS s FROM embeddings)""")
def q_argmax(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings", "vec_id", "embedding")
    s = arrays.class_scores("embedding", 10)
    return e.select("vec_id", arrays.argmax(s).alias("pred"), F.array_max(s).alias("top"))


CLASS_NAMES = [f"class_{i}" for i in range(10)]


@query("fn_prob_map", f"""
SELECT vec_id, 'class_' || CAST(pos - 1 AS VARCHAR) AS class_name, round(p, 6) AS prob FROM (
  SELECT vec_id, unnest(list_transform(s, lambda x: exp(x - list_max(s)) / list_sum(list_transform(s, lambda y: exp(y - list_max(s)))))) AS p,
         unnest(generate_series(1, len(s))) AS pos
  FROM (SELECT vec_id, {_SCORES} AS s FROM embeddings))""")
def q_prob_map(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings", "vec_id", "embedding")
    m = arrays.prob_map(CLASS_NAMES, arrays.softmax(arrays.class_scores("embedding", 10)))
    return (e.select("vec_id", F.explode(m).alias("class_name", "prob"))
            .withColumn("prob", F.round("prob", 6)))


@query("value_map", """
SELECT id, CASE label WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' END AS label_name FROM (
  SELECT d.doc_id AS id, l.quality AS label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""")
def q_value_map(spark: SparkSession, sf: str) -> DataFrame:
    r = reviews(spark, sf)
    names = F.create_map(F.lit(0), F.lit("negative"), F.lit(1), F.lit("positive"))
    return r.select("id", names[F.col("label")].alias("label_name"))

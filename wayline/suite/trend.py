"""Keywords, entity resolution, popularity and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.functions.scoring import diversity_score
from wayline.operators import keywords as W, popularity as R, resolve as E, vectors as V
from wayline.operators.ordering import first_per_group, top_n_per_group
from wayline.session import constant_rows
from wayline.suite.base import Data, query
from wayline import constants as K
from wayline.suite.scalars import FEEDBACK_SQL, feedback

# --- keywords: language = city, source decides the channel -------------------------

LATIN = "a-zà-öø-ÿ"
STOP = ("the", "and", "les", "que", "der", "die", "und", "los", "las", "con")
CHANNEL_SQL = "CASE WHEN source <= 'src15' THEN 'blog' ELSE 'cafe' END"
TOKEN_SQL = f"""SELECT lang, channel, form FROM (SELECT lang, {CHANNEL_SQL} AS channel,
  unnest(string_split(regexp_replace(regexp_replace(regexp_replace(lower(text), '<[^>]+>', ' ', 'g'), '&[a-zA-Z]+;|&#[0-9]+;', ' ', 'g'), '[^{LATIN} ]', ' ', 'g'), ' ')) AS form
  FROM documents) WHERE length(form) >= 2"""
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
FREQ_SQL = f"SELECT lang, channel, form AS keyword, count(*) AS frequency FROM ({TOKEN_SQL}) WHERE form NOT IN ({STOP_SQL}) GROUP BY ALL"
PIVOT_SQL = f"""SELECT lang, keyword, CAST(sum(CASE WHEN channel = 'blog' THEN frequency ELSE 0 END) AS BIGINT) AS blog_frequency,
  CAST(sum(CASE WHEN channel = 'cafe' THEN frequency ELSE 0 END) AS BIGINT) AS cafe_frequency, CAST(sum(frequency) AS BIGINT) AS total_frequency
  FROM ({FREQ_SQL}) GROUP BY ALL"""
SCORE_SQL = f"""SELECT *, blog_frequency > 0 AND cafe_frequency > 0 AS multi_channel,
  CASE WHEN blog_frequency > 0 AND cafe_frequency > 0 THEN total_frequency * 1.3e0 ELSE CAST(total_frequency AS DOUBLE) END AS raw_score FROM ({PIVOT_SQL})"""


def docs(d: Data):
    channel = F.when(F.col("source") <= "src15", "blog").otherwise("cafe")
    return d.documents.select("lang", channel.alias("channel"), F.lower("text").alias("text"))


def stop_words(d: Data):
    return constant_rows(d.spark, [(w,) for w in STOP], ["word"])


def tokens(d: Data):
    return W.tokenize(docs(d), F.col("text"), ["lang", "channel"], LATIN)


def frequency(d: Data):
    freq = W.token_frequency(W.token_filter(tokens(d)), ["lang", "channel"])
    return W.token_filter(freq, stop_words(d)).withColumnRenamed("form", "keyword")


def scored(d: Data):
    wide = W.channel_pivot(frequency(d), "lang", "keyword")
    return wide.withColumn("raw_score", diversity_score(F.col("total_frequency"), F.col("multi_channel")))


@query("tokenizer_hook", f"SELECT lang, channel, count(*) AS tokens, count(DISTINCT form) AS forms FROM ({TOKEN_SQL}) GROUP BY ALL")
def _(d: Data):
    found = W.token_filter(tokens(d))
    return found.groupBy("lang", "channel").agg(F.count("*").alias("tokens"), F.count_distinct("form").alias("forms"))


@query("token_filter", f"""
SELECT lang, form, count(*) AS n FROM ({TOKEN_SQL}) WHERE form NOT IN ({STOP_SQL}) GROUP BY ALL""")
def _(d: Data):
    kept = W.token_filter(tokens(d), stop_words(d))
    return kept.groupBy("lang", "form").agg(F.count("*").alias("n"))


@query("token_frequency", FREQ_SQL)
def _(d: Data):
    return frequency(d)


@query("channel_pivot", PIVOT_SQL)
def _(d: Data):
    return W.channel_pivot(frequency(d), "lang", "keyword").drop("multi_channel")


@query("diversity_score", f"SELECT lang, keyword, multi_channel, round(raw_score, 4) AS raw_score FROM ({SCORE_SQL})")
def _(d: Data):
    return scored(d).select("lang", "keyword", "multi_channel", F.round("raw_score", 4).alias("raw_score"))


@query("top_n_per_group", f"""
SELECT lang, keyword, round(raw_score, 4) AS raw_score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY raw_score DESC, keyword) AS rn FROM ({SCORE_SQL})) WHERE rn <= 20""")
def _(d: Data):
    best = top_n_per_group(scored(d), ["lang"], [F.col("raw_score").desc(), F.col("keyword").asc()], 20)
    return best.select("lang", "keyword", F.round("raw_score", 4).alias("raw_score"))


@query("max_normalize", f"""
SELECT lang, keyword, round(raw_score / max(raw_score) OVER (PARTITION BY lang), 6) AS normalized_score FROM ({SCORE_SQL})""")
def _(d: Data):
    return W.max_normalize(scored(d), "lang", "raw_score").select(
        "lang", "keyword", F.round("normalized_score", 6).alias("normalized_score")
    )


@query("keyword_scores", f"""
SELECT lang, keyword, blog_frequency, cafe_frequency, multi_channel, round(raw_score, 4) AS raw_score,
  round(raw_score / max(raw_score) OVER (PARTITION BY lang), 6) AS normalized_score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY raw_score DESC, keyword) AS rn FROM ({SCORE_SQL}) WHERE total_frequency >= 3) WHERE rn <= 20""")
def _(d: Data):
    best = W.keyword_scores(docs(d), F.col("text"), "lang", "channel", stop_words(d), keep=LATIN)
    return best.withColumns({"raw_score": F.round("raw_score", 4), "normalized_score": F.round("normalized_score", 6)})


# --- place resolution: parts are entities and search results ------------------------

TITLE = """CASE p_type WHEN 'ECONOMY' THEN substr(p_name, 1, 3) WHEN 'LARGE' THEN concat('Old ', p_name, ' House') WHEN 'SMALL' THEN '#!'
  WHEN 'PROMO' THEN upper(p_name) ELSE p_name END"""
# Coordinates on a plain grid; medium parts have none.
ENTITY = f"""p_partkey AS content_id, p_size AS category, {TITLE} AS title, concat('1 ', p_brand, ' Road') AS addr1,
  CASE WHEN p_type <> 'MEDIUM' THEN 127.0e0 + p_size * 0.004e0 END AS map_x, CASE WHEN p_type <> 'MEDIUM' THEN 37.0e0 + p_size * 0.0037e0 END AS map_y"""
PROBE = """p_partkey AS probe_id, p_brand AS city_name, CASE WHEN p_size <= 15 THEN concat('Old ', p_name) WHEN p_size <= 30 THEN concat(p_name, ' Shop')
  WHEN p_size <= 35 THEN substr(p_name, 1, 3) ELSE p_name END AS place_name, 127.0013e0 + p_size * 0.004e0 AS longitude, 37.0011e0 + p_size * 0.0037e0 AS latitude"""
STRICT = "regexp_replace(lower({c}), '[^0-9a-z가-힣]', '', 'g')"


def _select(df, text: str):
    from wayline.suite.scalars import _split_top

    return df.selectExpr(*_split_top(text))


def _cities(d: Data):
    return d.part.select(F.col("p_brand").alias("city_name")).distinct()


@query("tag_cities", f"""
SELECT content_id, city_name FROM (SELECT {ENTITY} FROM part) JOIN (SELECT DISTINCT p_brand AS city_name FROM part) ON contains(lower(addr1), lower(city_name))""")
def _(d: Data):
    return E.tag_cities(_select(d.part, ENTITY), _cities(d)).select("content_id", "city_name")


@query("place_match", f"""
WITH e AS (SELECT *, {STRICT.format(c='title')} AS t FROM (SELECT {ENTITY} FROM part) JOIN (SELECT DISTINCT p_brand AS city_name FROM part) ON contains(lower(addr1), lower(city_name))),
p AS (SELECT *, {STRICT.format(c='place_name')} AS n FROM (SELECT {PROBE} FROM part)),
m AS (SELECT probe_id, content_id, category, n = t AS same, map_x IS NOT NULL AND map_y IS NOT NULL AS placed,
    CASE WHEN map_x IS NOT NULL AND map_y IS NOT NULL THEN 6371000 * acos(least(1.0, cos(radians(latitude)) * cos(radians(map_y)) * cos(radians(map_x) - radians(longitude)) + sin(radians(latitude)) * sin(radians(map_y)))) END AS dist
  FROM p JOIN e USING (city_name) WHERE t <> '' AND n <> '' AND (n = t OR (length(n) >= 4 AND (contains(t, n) OR contains(n, t)))))
SELECT probe_id, content_id, category FROM (SELECT *, row_number() OVER (PARTITION BY probe_id ORDER BY same DESC, placed DESC, round(dist) NULLS LAST, content_id) AS rn
  FROM m WHERE NOT placed OR dist <= 1000) WHERE rn = 1""")
def _(d: Data):
    entities = E.tag_cities(_select(d.part, ENTITY), _cities(d))
    return E.place_match(_select(d.part, PROBE), entities).select("probe_id", "content_id", "category")


CANDIDATE = """p_brand AS city_name, p_name AS keyword, p_partkey AS pos, CAST(p_partkey AS {s}) AS id,
  CASE WHEN p_size <= 10 THEN upper(p_name) WHEN p_size <= 30 THEN concat('The ', p_name) ELSE p_type END AS place_name,
  CASE p_type WHEN 'ECONOMY' THEN 'AT4' WHEN 'LARGE' THEN 'FD6' WHEN 'SMALL' THEN 'CE7' WHEN 'PROMO' THEN 'MT1' ELSE 'AD5' END AS category_group_code,
  CASE WHEN p_size > 25 THEN '' ELSE concat(p_brand, ' Road') END AS road_address_name,
  CASE WHEN p_size > 28 THEN 'Elsewhere' ELSE concat('Old ', p_brand) END AS address_name"""
FIT_SQL = f"""SELECT * FROM (SELECT *, CASE WHEN replace(lower(place_name), ' ', '') = replace(lower(keyword), ' ', '') THEN 2
    WHEN contains(replace(lower(place_name), ' ', ''), replace(lower(keyword), ' ', '')) THEN 1 END AS name_score,
    coalesce(nullif(road_address_name, ''), address_name) AS address FROM (SELECT {CANDIDATE.format(s='VARCHAR')} FROM part))
  WHERE category_group_code IN ('AT4', 'FD6', 'CE7', 'AD5') AND name_score IS NOT NULL AND contains(replace(lower(address), ' ', ''), lower(city_name))"""


def _fitting(d: Data):
    cities = _cities(d).withColumn("short_name", F.lower("city_name"))
    return E.candidate_filter(_select(d.part, CANDIDATE.format(s="STRING")), cities)


@query("candidate_filter", f"SELECT city_name, keyword, id, name_score, address FROM ({FIT_SQL})")
def _(d: Data):
    return _fitting(d).select("city_name", "keyword", "id", "name_score", "address")


@query("best_candidate", f"""
SELECT city_name, keyword, id, name_score FROM (SELECT *, row_number() OVER (PARTITION BY city_name, keyword ORDER BY name_score DESC, pos) AS rn FROM ({FIT_SQL})) WHERE rn = 1""")
def _(d: Data):
    return E.best_candidate(_fitting(d)).select("city_name", "keyword", "id", "name_score")


@query("best_one", """
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def _(d: Data):
    rows = d.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return first_per_group(rows, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]).drop("o_totalprice")


@query("merge_place_metrics", """
SELECT l_partkey, arg_min(l_returnflag, (l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS l_returnflag, CAST(sum(l_quantity) AS BIGINT) AS blog, CAST(sum(l_linenumber) AS BIGINT) AS cafe,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY 1""")
def _(d: Data):
    rows = d.lineitem.select(
        "l_partkey", "l_returnflag", F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("pos"),
        F.col("l_quantity").cast("bigint").alias("blog"), F.col("l_linenumber").alias("cafe"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
    )
    return E.merge_place_metrics(rows, "l_partkey", "pos", ["blog", "cafe", "cents"], ["l_returnflag"])


# --- popularity ------------------------------------------------------------------------

NAMES_SQL = f"(VALUES {', '.join(f'({k}, {name!r})' for k, name in K.CATEGORY_NAMES)}) AS c(category, category_name)"
CENTS = "CAST(round(value * 100) AS BIGINT)"


def _state(d: Data):
    return feedback(d).select(
        "content_id", "mention_score", F.lit(0.0).alias("popularity_score"), F.lit(0).alias("category_rank"),
        F.lit("none").alias("rank_tag"), F.lit(None).cast("timestamp_ntz").alias("calculated_at"),
    )


@query("accumulate_score", f"""
SELECT coalesce(a.user_id, b.user_id) AS content_id, round((coalesce(a.c, 0) + coalesce(b.c, 0)) / 100, 4) AS mention_score
FROM (SELECT user_id, CAST(sum({CENTS}) AS DOUBLE) AS c FROM events WHERE event_type = 'purchase' GROUP BY 1) a
FULL JOIN (SELECT user_id, CAST(sum({CENTS}) AS DOUBLE) AS c FROM events WHERE event_type <> 'purchase' GROUP BY 1) b USING (user_id)""")
def _(d: Data):
    part = lambda condition: d.events.where(condition).select(F.col("user_id").alias("content_id"), F.col("value").alias("mention_score"))
    state = part("event_type = 'purchase'").groupBy("content_id").agg(F.sum("mention_score").alias("mention_score"))
    merged = R.accumulate_score(state, part("event_type <> 'purchase'"))
    return merged.select("content_id", F.round("mention_score", 4).alias("mention_score"))


@query("decay_scores", f"SELECT content_id, round(mention_score * 0.99e0, 4) AS mention_score FROM ({FEEDBACK_SQL})")
def _(d: Data):
    return R.decay_scores(_state(d)).select("content_id", F.round("mention_score", 4).alias("mention_score"))


# Every fifth score belongs to an entity that is no longer there.
def _scores(d: Data):
    gone = F.col("content_id") % 5 == 0
    return _state(d).withColumn("content_id", F.when(gone, -F.col("content_id")).otherwise(F.col("content_id")))


@query("popularity_join", f"""
SELECT content_id, category, category_name, round(mention_score, 4) AS mention_score FROM ({FEEDBACK_SQL}) JOIN {NAMES_SQL} USING (category) WHERE content_id % 5 <> 0 OR content_id = 0""")
def _(d: Data):
    joined = R.popularity_join(_scores(d).select("content_id", "mention_score"), feedback(d), R.category_dimension(d.spark))
    return joined.select("content_id", "category", "category_name", F.round("mention_score", 4).alias("mention_score"))


@query("category_rank", """
SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id DESC) AS category_rank FROM events""")
def _(d: Data):
    rows = d.events.select("event_type", "event_id", "value")
    return R.category_rank(rows, "event_type", "value", "event_id").select("event_type", "event_id", "category_rank")


POPULARITY_SQL = f"""WITH f AS (SELECT *, CASE WHEN content_id % 5 = 0 THEN -content_id ELSE content_id END AS stored FROM ({FEEDBACK_SQL})),
s AS (SELECT *, mention_score * 5 + like_count * 1 + review_count * 2 + avg_rating * review_count * 0.5 AS score FROM f WHERE content_id % 5 <> 0 OR content_id = 0),
r AS (SELECT content_id, score, category, row_number() OVER (PARTITION BY category ORDER BY score DESC, content_id DESC) AS rn FROM s)
SELECT f.stored AS content_id, round(coalesce(r.score, 0), 4) AS popularity_score, CAST(coalesce(r.rn, 0) AS INTEGER) AS category_rank,
  CASE WHEN r.rn IS NULL THEN 'none' WHEN r.rn <= 10 THEN '인기 ' || category_name || ' ' || r.rn || '위' END AS rank_tag
FROM f LEFT JOIN r ON r.content_id = f.stored LEFT JOIN {NAMES_SQL} ON c.category = r.category"""


def popularity(d: Data):
    """Flagship: stored scores of known entities are ranked per category and tagged; the others keep what they have."""
    ranked = R.popularity_rank(_scores(d), feedback(d), R.category_dimension(d.spark), F.lit("2024-06-01").cast("timestamp_ntz"))
    return ranked.select("content_id", F.round("popularity_score", 4).alias("popularity_score"), "category_rank", "rank_tag")


query("popularity_rank", POPULARITY_SQL)(popularity)


@query("decay_and_prune", """
SELECT event_id, round(score, 6) AS score FROM (SELECT event_id, value * CASE event_type WHEN 'view' THEN 0.85e0 WHEN 'click' THEN 0.85e0 WHEN 'purchase' THEN 0.7e0 WHEN 'signup' THEN 0.7e0 ELSE 1 END AS score FROM events)
WHERE score >= 0.5""")
def _(d: Data):
    factors = [("view", 0.85), ("click", 0.85), ("purchase", 0.7), ("signup", 0.7)]
    kept = R.decay_and_prune(d.events.select("event_id", "event_type", "value"), "event_type", "value", factors, 0.5)
    return kept.select("event_id", F.round("value", 6).alias("score"))


@query("feedback_rollup", """
SELECT coalesce(a.user_id, b.user_id) AS content_id, coalesce(likes, 0) AS like_count, coalesce(reviews, 0) AS review_count, coalesce(rating, 0.0) AS avg_rating FROM
(SELECT user_id, count(*) AS likes FROM events WHERE event_type = 'click' GROUP BY 1) a FULL JOIN
(SELECT user_id, count(*) AS reviews, round(avg(rating), 2) AS rating FROM (SELECT user_id, CASE WHEN value < 5 THEN 1 WHEN value < 20 THEN 3 ELSE 5 END AS rating, value > 100 AS gone FROM events WHERE event_type = 'purchase') WHERE NOT gone GROUP BY 1) b USING (user_id)""")
def _(d: Data):
    rows = d.events.withColumnRenamed("user_id", "content_id")
    likes = rows.where("event_type = 'click'")
    rating = F.when(F.col("value") < 5, 1).when(F.col("value") < 20, 3).otherwise(5)
    reviews = rows.where("event_type = 'purchase'").select("content_id", rating.alias("rating"), (F.col("value") > 100).alias("is_deleted"))
    rolled = R.feedback_rollup(likes, reviews)
    return rolled.withColumn("avg_rating", F.col("avg_rating").cast("double"))


@query("trending_merge", """
WITH o AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY ALL),
n AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY ALL)
SELECT coalesce(o.user_id, n.user_id) AS keyword, coalesce(o.event_type, n.event_type) AS city_name, coalesce(n.n, o.n) AS blog_frequency
FROM o FULL JOIN n ON o.user_id = n.user_id AND o.event_type = n.event_type WHERE NOT coalesce(o.n > 6, false)""")
def _(d: Data):
    count = lambda rows: rows.groupBy(F.col("user_id").alias("keyword"), F.col("event_type").alias("city_name")).agg(F.count("*").alias("blog_frequency"))
    both = lambda df: df.withColumns({"cafe_frequency": F.lit(0), "multi_channel": F.lit(False)})
    stored = both(count(d.events.where("ts < '2024-01-20'"))).withColumns(
        {"promoted": F.col("blog_frequency") > 6, "collected_at": F.lit("2024-01-20").cast("timestamp_ntz")}
    )
    new = both(count(d.events.where("ts >= '2024-01-15'")))
    merged = R.trending_merge(stored, new, F.lit("2024-02-01").cast("timestamp_ntz"))
    return R.unpromoted(merged).select("keyword", "city_name", "blog_frequency")


# --- vectors -------------------------------------------------------------------------------


@query("cosine_top_k", """
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), q AS (SELECT label AS query_id, arg_min(e, vec_id) AS qe FROM v GROUP BY label),
s AS (SELECT query_id, vec_id AS item_id, list_cosine_similarity(qe, e) AS similarity FROM q, v)
SELECT query_id, item_id, round(similarity, 6) AS similarity, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, item_id) AS rn FROM s) WHERE rn <= 5""")
def _(d: Data):
    requests = d.embeddings.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("embedding"))
    nearest = V.cosine_top_k(d.embeddings, requests, 5, "vec_id", "query_id")
    return nearest.withColumn("similarity", F.round("similarity", 6))


@query("embedding_input", """
SELECT doc_id, 'place:' || doc_id || ':v1' AS vector_id, '여행지명: ' || source || chr(10) || '지역: ' || lang || chr(10) || '대표 키워드: ' || coalesce(CASE WHEN n_chars > 500 THEN 'long' END, '')
  || chr(10) || '카테고리: ' || coalesce(CAST(quality AS VARCHAR), '') || chr(10) || '소개: ' || text AS input_text
FROM documents LEFT JOIN labels USING (doc_id)""")
def _(d: Data):
    rows = d.documents.join(d.labels.select("doc_id", "quality"), "doc_id", "left")
    parts = [F.col("source"), F.col("lang"), F.when(F.col("n_chars") > 500, "long"), F.col("quality"), F.col("text")]
    return rows.select("doc_id", V.vector_id(F.col("doc_id"), "v1").alias("vector_id"), V.embedding_input(parts).alias("input_text"))

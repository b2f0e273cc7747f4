"""Operators on literal frames."""

import itertools
import random

import pytest
from pyspark.sql import Window, functions as F

from conftest import rows
from wayline.operators import changes, documents, keywords, merge, normalize, ordering, popularity, quality, queues, resolve, vectors


def test_row_number_equals_the_window(spark):
    random.seed(3)
    data = [(random.choice("aaaaab"), random.randrange(50), i) for i in range(3000)] + [(None, 1, -1), (None, 0, -2)]
    df = spark.createDataFrame(data, "g string, v int, id long").repartition(8)
    order = [F.col("v").desc(), F.col("id").asc()]
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert rows(ordering.distributed_row_number(df, ["g"], order, "rn")) == rows(plain)
    plain = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    assert rows(ordering.distributed_row_number(df, [], order, "rn")) == rows(plain)


def test_row_number_spreads_a_hot_group(spark):
    # Adaptive execution would merge slices as small as these.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20000).withColumn("g", F.when(F.col("id") >= 0, "hot"))
        numbered = ordering.distributed_row_number(df, ["g"], [F.col("id").asc()], "rn")
        assert numbered.select(F.spark_partition_id()).distinct().count() > 3
        assert numbered.where("rn <> id + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_first_per_group_prunes_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.when(F.col("id") >= 0, 1))
    plan = changes.dedup_last_wins(df, ["g"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


RAW = "contentid string, title string, mapx string, mapy string, lclsSystm1 string, lclsSystm2 string, seq long"


def test_normalise_quarantine_and_dedup(frame):
    raw = frame(
        [
            ("1", " A ", "127.1", "37.5", "FD", "FD05", 1),
            ("1", "A2", "NaN", "50", "NA", None, 2),
            ("1", "", "127", "37", "FD", None, 3),  # broken later copy does not win
            ("x", "B", None, None, "FD", None, 4),
            ("2", "C" * 300, "140", "37", "ZZ", None, 5),
            ("3", "D" * 300, "140", "37", " SH ", None, 6),
        ],
        RAW,
    )
    good, bad = normalize.quarantine_split(normalize.normalize_entity(raw, keep=["seq"]), normalize.entity_rules())
    assert {(r["seq"], r["_reason"]) for r in bad.collect()} == {(3, "missing_title"), (4, "missing_id"), (5, "unsupported_category")}
    kept = {r["content_id"]: r for r in changes.dedup_last_wins(good, ["content_id"], ["seq"]).collect()}
    assert kept[1]["title"] == "A2" and kept[1]["map_x"] is None and kept[1]["map_y"] is None and kept[1]["category"] == 5
    assert len(kept[3]["title"]) == 200 and kept[3]["map_x"] is None and kept[3]["category"] == 3


def test_images_without_url_take_no_number(frame):
    raw = frame([("1", 0, " ", None), ("1", 1, "a", "x"), ("1", 2, "", "b"), ("2", 0, None, "c"), ("x", 0, "d", None), (" 1", 3, "e", None), (None, 1, "f", "f")], "contentid string, pos int, originimgurl string, smallimageurl string")
    assert rows(normalize.normalize_images(raw, [F.col("pos").asc()])) == [(1, 1, "a"), (1, 2, "b"), (1, 3, "e"), (2, 1, "c")]


def test_detail_pack_keeps_order(frame):
    raw = frame([(1, 1, "b"), (1, 0, "a"), (2, 0, None)], "id long, pos int, v string")
    assert dict(map(tuple, normalize.detail_info_pack(raw, "id", ["pos"], ["v"]).collect())) == {1: '[{"v":"a"},{"v":"b"}]', 2: "[{}]"}


def test_detect_changes_heals_lost_rows(frame):
    source = frame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id long, h string")
    state = frame([(1, "a"), (2, "x"), (3, "c")], "id long, h string")
    stored = frame([(1,), (2,)], "id long")
    assert rows(changes.detect_changes(source, state, stored, "id", "h")) == [(2, "b"), (3, "c"), (4, "d")]


def test_merge_upsert_twice_is_once(frame):
    target = frame([(1, "a", "keep"), (2, "b", "keep")], "k long, v string, other string")
    source = frame([(2, None), (3, "c")], "k long, v string")
    once = merge.merge_upsert(target, source, ["k"], insert_defaults={"other": F.lit("new")})
    assert rows(once) == [(1, "a", "keep"), (2, None, "keep"), (3, "c", "new")]
    assert rows(merge.merge_upsert(once, source, ["k"], insert_defaults={"other": F.lit("new")})) == rows(once)


def test_merge_does_not_shuffle_the_stored_side_for_a_small_change(spark, tmp_path):
    for name in ("stored", "changes"):
        spark.range(1000).selectExpr("id AS k", f"'{name}' AS v").write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / name)) for name in ("stored", "changes"))
    merged = merge.update_from(target, source, ["k"], ["v"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_state_upsert_rearms(frame):
    ddl = "content_id long, content_hash string, detail_common_pending boolean, detail_intro_pending boolean, detail_info_pending boolean, image_pending boolean, embed_pending boolean, image_absent boolean, last_etl_at timestamp_ntz"
    state = frame([(1, "a", False, False, False, False, False, False, None)], ddl)
    changed = frame([(1, "b", "img"), (2, "c", None)], "content_id long, content_hash string, first_image string")
    got = {r[0]: r for r in merge.state_upsert(state, changed, F.lit("2024-01-01").cast("timestamp_ntz")).collect()}
    assert got[1][2:8] == (True, True, True, True, True, False) and got[1][8] is not None
    assert got[2][2:8] == (True, True, True, False, True, True) and got[2][8] is None


def test_children_flags_and_fill(frame):
    children = frame([(1, "a"), (1, "b"), (2, "c")], "p long, u string")
    parents = frame([(1,), (3,)], "p long")
    assert rows(merge.replace_children(children, parents, frame([(3, "n")], "p long, u string"), "p")) == [(2, "c"), (3, "n")]
    target = frame([(1, None), (2, "old"), (3, None)], "id long, img string")
    assert rows(merge.fill_if_null(target, frame([(1, "x"), (2, "y")], "id long, url string"), "id", "img", "url")) == [(1, "x"), (2, "old"), (3, None)]
    flags = frame([(1, True), (2, True)], "id long, f boolean")
    assert rows(merge.clear_flags(flags, frame([(1,)], "id long"), "id", "f")) == [(1, False), (2, True)]
    assert rows(merge.cascade_delete(frame([(1, 1), (None, 2), (9, 3)], "p long, x int"), frame([(1,)], "id long"), "p", "id")) == [(1, 1)]
    assert rows(merge.set_null_on_delete(frame([(1, 1), (9, 3)], "p long, x int"), frame([(1,)], "id long"), "p", "id")) == [(1, 1), (None, 3)]
    assert rows(merge.deactivate_missing(frame([(1, True), (2, True)], "id long, active boolean"), frame([(2,)], "id long"), "id")) == [(1, False), (2, True)]


def test_insert_ignore_keeps_the_first_of_many_copies(frame):
    ledger = frame([("a", 0)], "url string, n int")
    new = frame([("a", 1), ("b", 3), ("b", 2), ("b", 9)], "url string, n int")
    assert rows(merge.insert_ignore(ledger, new, ["url"], order_by=["n"])) == [("b", 2)]


def test_queue_stops_at_quota(frame):
    responses = frame([(1, "ok", 0), (2, "error", 0), (3, "nodata", 0), (4, "quota", 0), (5, "ok", 0)], "id long, status string, q int")
    got = rows(queues.stop_at_first_failure(responses, ["q"], "id").select("id", "outcome"))
    assert got == [(1, "done"), (2, "failed"), (3, "done")]


def test_outbox(frame):
    ids = frame([(i,) for i in (5, 1, 4, 2, 3)], "content_id long")
    got = sorted(r["message"] for r in queues.outbox_batches(ids, "r1", limit=4, batch_size=3).collect())
    assert got == ['{"runId":"r1","contentIds":[1,2,3]}', '{"runId":"r1","contentIds":[4]}']


def simulate(docs, seen, page_size, max_pages):
    """Reading loop of one city and channel, spelled out."""
    kept = {}
    for query in sorted({d["query_no"] for d in docs}):
        for page in range(1, max_pages + 1):
            batch = sorted((d for d in docs if d["query_no"] == query and d["page"] == page), key=lambda d: d["idx"])
            if not batch:
                break
            stop = False
            for d in batch:
                if not d["url"]:
                    continue
                if d["url"] in kept:
                    kept[d["url"]].append(query)
                elif d["url"] in seen:
                    stop = True
                    break
                else:
                    kept[d["url"]] = [query]
            if stop or len(batch) < page_size:
                break
    return kept


@pytest.mark.parametrize("seed", range(6))
def test_collection_equals_the_reading_loop(spark, seed):
    rnd = random.Random(seed)
    size, pages = 4, 3
    docs = []
    for query in range(3):
        for page in range(1, 5):
            for idx in range(size if rnd.random() < 0.7 else rnd.randrange(size)):
                docs.append({"query_no": query, "page": page, "idx": idx, "url": rnd.choice(["", *[f"u{i}" for i in range(40)]])})
    seen = {f"u{i}" for i in range(0, 40, 13)}
    want = simulate(docs, seen, size, pages)
    df = spark.createDataFrame([("c", "blog", f"q{d['query_no']}", d["query_no"], d["page"], d["idx"], d["url"]) for d in docs],
                               "city string, channel string, query string, query_no int, page int, idx int, url string").repartition(5)
    reach = documents.reachable_pages(df, ["city", "channel", "query"], "page", size, pages).withColumn("pos", F.expr(f"(page - 1) * {size} + idx"))
    ledger = spark.createDataFrame([("c", "blog", u) for u in seen], "city string, channel string, url string")
    keys = ["city", "channel", "url"]
    fresh = documents.prefix_until_seen(reach, ledger, keys, ["city", "channel", "query"], "pos")
    got = documents.doc_dedup_collect(fresh, keys, ["query_no", "pos"], "query", ["pos"])
    assert {r["url"]: r["matched_queries"] for r in got.collect()} == {u: [f"q{q}" for q in qs] for u, qs in want.items()}


def test_all_landed_pages_are_read_by_default(spark):
    docs = spark.range(1000).selectExpr("'c' AS city", "CAST(id / 10 + 1 AS INT) AS page").where("page <> 90")
    reach = documents.reachable_pages(docs, ["city"], "page", 10)
    assert reach.count() == 890 and reach.agg(F.max("page")).first()[0] == 89


def test_same_url_in_both_channels_counts_twice(frame):
    docs = frame([("c", "blog", "u"), ("c", "cafe", "u"), ("c", "blog", "u")], "city string, channel string, url string")
    assert documents.except_seen(docs, docs.limit(0), ["city", "channel", "url"]).count() == 3
    assert documents.seen_semi_join(docs, docs, ["city", "channel", "url"]).count() == 2


def test_tokens_with_an_analyser(frame, spark):
    def load():
        def analyse(text):
            if "깨진" in text:
                raise ValueError("cannot read")
            return [("오죽헌", "NNP"), ("경기", "NNP"), ("이천", "NNP"), ("용인시", "NNP"), ("담양", "NNP"), ("가족", "NNG")]

        return analyse

    from wayline.plans.trend import stop_list

    docs = frame([("테스트 문장",), ("깨진 문장",), ("",), (None,)], "t string")
    found = keywords.token_filter(keywords.tokenize(docs, F.col("t"), [], load=load), stop_list(spark))
    assert rows(keywords.token_frequency(found, [])) == [("오죽헌", 1)]


def test_tokenizer_query_needs_no_python(frame, spark, capsys):
    from types import SimpleNamespace

    from wayline.suite import QUERIES, trend
    from wayline.suite.trend import LATIN

    def load():
        return lambda text: [(word, "NNP") for word in text.split()]

    docs = frame([("en", "src01", "<b>One</b> two&amp;ONE  x"), ("fr", "src20", "été"), ("fr", "src20", None)], "lang string, source string, text string")
    d = SimpleNamespace(documents=docs, spark=spark)
    plain = trend.tokens(d)
    hooked = keywords.tokenize(trend.docs(d), F.col("text"), ["lang", "channel"], LATIN, load)
    assert rows(keywords.token_filter(plain)) == rows(keywords.token_filter(hooked))
    query = QUERIES["tokenizer_hook"](spark, "/root/testdata/sf0.001")
    query.explain()
    assert "EvalPython" not in capsys.readouterr().out


def test_keyword_scores(frame):
    docs = frame(
        [("c", "blog", "경포대 경포대 오죽헌 맛집"), ("c", "cafe", "오죽헌 오죽헌 바다"), ("c", "blog", "바다 바다"), ("d", "blog", "하나")],
        "city string, channel string, t string",
    )
    stop = frame([("맛집",)], "w string")
    got = rows(keywords.keyword_scores(docs, F.col("t"), "city", "channel", stop, floor=3, top_n=2))
    assert [(r[0], r[1], r[2], r[3], r[4]) for r in got] == [("c", "바다", 2, 1, True), ("c", "오죽헌", 1, 2, True)]
    assert all(r[5] == pytest.approx(3.9) and r[6] == 1.0 for r in got)


def test_max_normalize_of_nothing_positive(frame):
    df = frame([("a", 0.0), ("a", -1.0), (None, 4.0)], "g string, s double")
    assert sorted(r[2] for r in keywords.max_normalize(df, "g", "s").collect()) == [0.0, 0.0, 1.0]


def test_candidates(frame):
    cities = frame([("강릉시", "강릉")], "city_name string, short_name string")
    ddl = "city_name string, keyword string, pos int, place_name string, category_group_code string, road_address_name string, address_name string"
    found = frame(
        [
            ("강릉시", "오죽헌", 0, "오죽헌 주차장", "AT4", "", "강원 강릉시"),
            ("강릉시", "오죽헌", 1, "오죽 헌", "AT4", "강릉대로", "x"),
            ("강릉시", "오죽헌", 2, "오죽헌", "MT1", "강릉", ""),
            ("강릉시", "오죽헌", 3, "오죽헌", "FD6", "속초시", "강릉"),
            ("강릉시", "", 4, "", "AT4", "강릉", ""),
        ],
        ddl,
    )
    best = resolve.best_candidate(resolve.candidate_filter(found, cities)).collect()
    assert [(r["pos"], r["name_score"]) for r in best] == [(1, 2)]


def brute_match(probes, entities, radius=1000.0):
    import math
    import re

    norm = lambda s: re.sub(r"[^0-9a-z가-힣]", "", s.lower())
    out = []
    for pid, city, name, lon, lat in probes:
        n, best = norm(name), None
        for eid, ecity, title, x, y in entities:
            t = norm(title)
            if not n or not t or city != ecity:
                continue
            if not (n == t or (len(n) >= 4 and (n in t or t in n))):
                continue
            dist = None
            if x is not None and y is not None:
                a, b = math.radians(lat), math.radians(y)
                c = math.cos(a) * math.cos(b) * math.cos(math.radians(x) - math.radians(lon)) + math.sin(a) * math.sin(b)
                dist = 6371000 * math.acos(min(1.0, c))
                if dist > radius:
                    continue
            key = (n != t, dist is None, round(dist) if dist is not None else 0, eid)
            best = min(best, key) if best else key
        if best:
            out.append((pid, best[3]))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_place_match_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abc가") for _ in range(rnd.choice([0, 1, 2, 3, 4, 5, 9, 12])))
    spot = lambda: (127 + rnd.random() * 0.03, 37 + rnd.random() * 0.03)
    entities = []
    for i in range(300):
        x, y = spot()
        entities.append((i, rnd.choice("PQ"), word() + rnd.choice(["", "!", " A"]), None if rnd.random() < 0.2 else x, None if rnd.random() < 0.1 else y))
    probes = [(i, rnd.choice("PQ"), rnd.choice(entities)[2] + word() if rnd.random() < 0.5 else word(), *spot()) for i in range(200)]
    e = spark.createDataFrame(entities, "content_id long, city_name string, title string, map_x double, map_y double").withColumn("category", F.lit(1))
    p = spark.createDataFrame(probes, "probe_id long, city_name string, place_name string, longitude double, latitude double")
    got = sorted((r["probe_id"], r["content_id"]) for r in resolve.place_match(p, e).collect())
    assert got == brute_match(probes, entities)


def test_place_match_has_no_nested_loop(spark):
    e = spark.createDataFrame([(1, "P", "abcd", 127.0, 37.0, 1)], "content_id long, city_name string, title string, map_x double, map_y double, category int")
    p = spark.createDataFrame([(1, "P", "abcd", 127.0, 37.0)], "probe_id long, city_name string, place_name string, longitude double, latitude double")
    plan = resolve.place_match(p, e)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_many_copies_of_one_place_do_not_multiply(spark):
    e = spark.range(3000).selectExpr("id AS content_id", "'P' AS city_name", "'hotel sea' AS title", "CAST(NULL AS DOUBLE) AS map_x", "CAST(NULL AS DOUBLE) AS map_y", "1 AS category")
    p = spark.range(3000).selectExpr("id AS probe_id", "'P' AS city_name", "'Hotel Sea' AS place_name", "127.0D AS longitude", "37.0D AS latitude")
    got = resolve.place_match(p, e)
    assert got.count() == 3000 and got.select("content_id").distinct().collect()[0][0] == 0


def crowd(spark, n, probes, side=0.01):
    """One title at n different spots of a cell, and probes between them."""
    e = spark.range(n).selectExpr("id AS content_id", "'P' AS city_name", "'hotel sea' AS title", f"127.0 + {side} * rand(1) AS map_x", f"37.0 + {side} * rand(2) AS map_y", "1 AS category")
    p = spark.range(probes).selectExpr("id AS probe_id", "'P' AS city_name", "'Hotel Sea' AS place_name", f"127.0 + {side} * rand(3) AS longitude", f"37.0 + {side} * rand(4) AS latitude")
    return spark.createDataFrame(e.collect(), e.schema), spark.createDataFrame(p.collect(), p.schema)


def test_crowded_place_is_searched_outwards(spark, monkeypatch):
    """10,000 spots of one title in one cell: what is compared follows the probes, not probes times spots."""
    e, p = crowd(spark, 10_000, 300)
    met = []
    within = resolve._within
    monkeypatch.setattr(resolve, "_within", lambda df, radius: (met.append(df), within(df, radius))[1])
    got = {r["probe_id"]: r["content_id"] for r in resolve.place_match(p, e).collect()}
    assert len(met) == 4 and sum(df.count() for df in met) < 300 * 100
    assert sorted(got.items()) == brute_match([tuple(r) for r in p.collect()], [tuple(r)[:5] for r in e.collect()])


@pytest.mark.parametrize("side", [0.0002, 0.05])
def test_crowds_of_any_density_equal_brute_force(spark, monkeypatch, side):
    monkeypatch.setattr(resolve, "_CROWD", 3)
    e, p = crowd(spark, 300, 150, side)
    e = e.withColumn("title", F.when(F.col("content_id") % 3 == 0, "hotel sea annex").otherwise(F.col("title")))
    e = e.withColumn("map_x", F.when(F.col("content_id") % 11 == 0, F.lit(None)).otherwise(F.col("map_x")))
    got = sorted((r["probe_id"], r["content_id"]) for r in resolve.place_match(p, e).collect())
    assert got == brute_match([tuple(r) for r in p.collect()], [tuple(r)[:5] for r in e.collect()])


def test_names_are_looked_up_by_their_rarest_gram(spark):
    """Titles give one substring per character; a name meets only the titles that have its rarest one."""
    titles = spark.createDataFrame([("P", f"grandhotel{i}") for i in range(50)] + [("P", "grandhotelsea"), ("P", "seaview"), ("Q", "grandhotelsea")], "city_name string, _title string")
    names = spark.createDataFrame([("P", "hotelsea"), ("P", "nowhere"), ("P", "grandhotel")], "city_name string, _name string")
    substrings = resolve._substrings
    got = resolve._containing(names, titles, 4)
    pairs = {(r["_name"], r["_title"]) for r in got.collect()}
    assert pairs == {("hotelsea", "grandhotelsea"), ("grandhotel", "grandhotelsea")} | {("grandhotel", f"grandhotel{i}") for i in range(50)}
    assert {r["_block"] for r in got.where("_name = 'hotelsea'").collect()} <= {"tels", "else", "lsea"}
    assert titles.select(F.explode(substrings(F.col("_title"), [4]))).count() <= sum(len(r["_title"]) for r in titles.collect())


def test_tag_cities(spark):
    e = spark.createDataFrame([(1, "강원 강릉시 1"), (2, "강원 춘천 2 강릉로"), (3, None), (4, "서울")], "content_id long, addr1 string")
    cities = spark.createDataFrame([("강릉시",), ("춘천시",)], "city_name string")
    assert rows(resolve.tag_cities(e, cities).select("content_id", "city_name")) == [(1, "강릉시"), (2, "강릉시"), (2, "춘천시")]


def test_merge_place_metrics(frame):
    places = frame([("same-place", 1, 3, 2, 1.5), ("same-place", 2, 4, 1, 2.0), ("place-2", 3, 2, 1, 1.0)], "id string, pos int, blog int, cafe int, score double")
    assert rows(resolve.merge_place_metrics(places, "id", "pos", ["blog", "cafe", "score"])) == [("place-2", 2, 1, 1.0), ("same-place", 7, 3, 3.5)]


def test_popularity(frame, spark):
    state = frame([(1, 1.0, 0.0, 9, "old", None), (2, 1.0, 0.0, 9, "old", None), (3, 1.0, 5.0, 9, "old", None)],
                  "content_id long, mention_score double, popularity_score double, category_rank int, rank_tag string, calculated_at timestamp_ntz")
    entities = frame([(1, 2, 0, 0, 0.0), (2, 2, 0, 0, 0.0), (9, 2, 0, 0, 0.0)], "content_id long, category int, like_count int, review_count int, avg_rating double")
    got = popularity.popularity_rank(state, entities, popularity.category_dimension(spark), F.lit("2024-01-01").cast("timestamp_ntz"), top_n=1)
    # Equal scores: the higher id first; a row without entity keeps what it had.
    assert [tuple(r)[:5] for r in got.orderBy("content_id").collect()] == [(1, 1.0, 5.0, 2, None), (2, 1.0, 5.0, 1, "인기 카페 1위"), (3, 1.0, 5.0, 9, "old")]


def test_accumulate_sums_keywords_of_one_entity(frame):
    state = frame([(1, 1.0)], "content_id long, mention_score double")
    mentions = frame([(1, 0.5), (1, 0.25), (2, 1.0)], "content_id long, mention_score double")
    assert rows(popularity.accumulate_score(state, mentions)) == [(1, 1.75), (2, 1.0)]


def test_decay_and_prune(frame):
    df = frame([("AT4", 1.0), ("FD6", 1.0), ("CE7", 0.01), ("ZZ", 1.0)], "c string, s double")
    assert rows(popularity.decay_and_prune(df, "c", "s")) == [("AT4", 0.85), ("FD6", 0.7), ("ZZ", 1.0)]


def test_run_ledger(frame):
    now = F.lit("2024-01-01").cast("timestamp_ntz")
    ledger = frame([("d", "r1", "success", None, None, "{}")], "dag_id string, run_id string, status string, started_at timestamp_ntz, finished_at timestamp_ntz, stats string")
    started = quality.start_runs(ledger, frame([("d", "r1"), ("d", "r2")], "dag_id string, run_id string"), now)
    assert [r["status"] for r in started.collect()] == ["running", "running"]
    stages = frame([("d", "r2", "a", "success", 1), ("d", "r2", "b", "failed", 2), ("d", "zz", "a", "success", 1)], "dag_id string, run_id string, stage string, status string, processed int")
    done = {r["run_id"]: r for r in quality.finish_runs(started, quality.run_results(stages), now).collect()}
    assert done["r2"]["status"] == "failed" and done["r2"]["stats"] == '{"a":1,"b":2}' and done["r1"]["status"] == "running" and "zz" not in done


def test_constraints(frame):
    df = frame([(1, 5, None), (1, None, 2), (2, 9, 3)], "k int, v int, w int")
    assert rows(quality.check_unique(df, ["k"])) == [(1, 2)]
    assert rows(quality.check_domain(df, {"v": F.col("v") < 6, "w": F.col("w").isNotNull()})) == [("v", 1), ("w", 1)]
    assert quality.check_exclusive(df, ["v", "w"]).collect()[0]["k"] == 2
    assert rows(quality.check_orphans(df, frame([(2,)], "id int"), "v", "id").select("v")) == [(5,), (9,)]


def test_cosine_top_k(frame):
    items = frame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0]), (5, None)], "id long, embedding array<float>").repartition(3)
    queries = frame([(7, [2.0, 0.0])], "q int, embedding array<float>")
    got = vectors.cosine_top_k(items, queries, 2, "id", "q").orderBy("rank").collect()
    assert [(r["query_id"], r["item_id"], round(r["similarity"], 6)) for r in got] == [(7, 1, 1.0), (7, 3, 0.707107)]
    assert vectors.cosine_top_k(items.limit(0), queries, 2, "id", "q").count() == 0
    assert vectors.cosine_top_k(items, frame([(8, None)], "q int, embedding array<float>"), 2, "id", "q").count() == 0


def test_cosine_top_k_over_shards_equals_all_pairs(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(vectors, "SHARD_ITEMS", 50)
    rng = np.random.default_rng(1)
    data = [(i, v.tolist()) for i, v in enumerate(rng.integers(-2, 3, (300, 4)).astype(float))]
    items = spark.createDataFrame(data, "id long, embedding array<double>").repartition(4)
    got = vectors.cosine_top_k(items, items.select(F.col("id").alias("q"), "embedding"), 7, "id", "q")
    unit = np.array([v for _, v in data], float)
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-300)
    scores = unit @ unit.T
    want = {q: np.lexsort((np.arange(300), -scores[q].round(12)))[:7].tolist() for q in range(300)}
    rounded = {}
    for r in got.collect():
        rounded.setdefault(r["query_id"], []).append(round(r["similarity"], 9))
    assert {q: sorted(v, reverse=True) for q, v in rounded.items()} == {q: [round(scores[q, i], 9) for i in w] for q, w in want.items()}


@pytest.mark.parametrize("parts", [1, 8])
def test_results_do_not_depend_on_partitioning(spark, parts):
    data = [(i % 7, i, f"w{i % 11}") for i in range(500)]
    df = spark.createDataFrame(data, "g int, id int, w string").repartition(parts)
    got = ordering.top_n_per_group(df, ["g"], [F.col("w").desc(), F.col("id").asc()], 3)
    want = []
    for g, group in itertools.groupby(sorted(data, key=lambda r: r[0]), key=lambda r: r[0]):
        best = sorted(sorted(group, key=lambda r: r[1]), key=lambda r: r[2], reverse=True)[:3]
        want += best
    assert rows(got) == sorted(want, key=repr)


def test_top_n_beyond_the_rank_limit(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") >= 0, "a"))
    got = ordering.top_n_per_group(df, ["g"], [F.col("id").desc()], 2000)
    assert got.count() == 2000 and got.agg(F.min("id")).first()[0] == 3000

"""Whole jobs: first run, repeated run, lost rows, enrichment, trend, streams."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from wayline.plans import audit, entity_load, landing, trend
from wayline.session import drop_scratch, scratch_path, shared_root
from wayline.sources import files, snapshots
from wayline.sources.tables import Tables
from wayline.streaming import jobs

def now():
    return F.lit("2024-01-01").cast("timestamp_ntz")
ITEM = "contentid string, contenttypeid string, title string, addr1 string, mapx string, mapy string, lclsSystm1 string, lclsSystm2 string, firstimage string, seq long"


def items(spark, *extra):
    base = [
        ("1", "12", "오죽헌", "강원 강릉시 1", "128.8781", "37.7519", "HS", "HS01", "http://1", 1),
        ("2", "12", "경포대", "강원 강릉시 2", "128.9", "37.79", "NA", "NA01", None, 2),
        ("1", "12", "오죽헌 (강릉)", "강원 강릉시 1", "128.8781", "37.7519", "HS", "HS01", "http://1", 3),
        ("x", None, "bad", None, None, None, "HS", None, None, 4),
    ]
    return spark.createDataFrame([*base, *extra], ITEM)


def stats(df):
    return df.first().asDict()


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"))


def test_entity_load_is_incremental(spark, tables):
    first = entity_load.daily_entity_load(items(spark), tables, now(), "seq")
    assert stats(first) == {"processed": 2, "changed": 2, "quarantined": 1, "duplicated": 1}
    assert rows(tables.read("entity").select("content_id", "title", "category")) == [(1, "오죽헌 (강릉)", 4), (2, "경포대", 5)]
    before = rows(tables.read("entity")), rows(tables.read("etl_state"))
    again = entity_load.daily_entity_load(items(spark), tables, now(), "seq")
    assert stats(again)["changed"] == 0
    assert (rows(tables.read("entity")), rows(tables.read("etl_state"))) == before

    # A lost business row loads again although its state is still there.
    tables.write("entity", tables.read("entity").where("content_id <> 2"))
    healed = entity_load.daily_entity_load(items(spark), tables, now(), "seq")
    assert stats(healed)["changed"] == 1 and tables.read("entity").count() == 2

    # A new rule version loads everything once.
    bumped = entity_load.daily_entity_load(items(spark), tables, now(), "seq", version="v5")
    assert stats(bumped)["changed"] == 2


def test_entity_load_judges_a_snapshot_of_one_split_once_in_many_tasks(spark, tables, monkeypatch):
    stored, materialize = {}, entity_load.materialize

    def keep(df, label):
        stored[label] = df.rdd.getNumPartitions()
        return materialize(df, label)

    monkeypatch.setattr(entity_load, "materialize", keep)
    got = entity_load.daily_entity_load(items(spark).coalesce(1), tables, now(), "seq")
    assert stats(got) == {"processed": 2, "changed": 2, "quarantined": 1, "duplicated": 1}
    assert stored["judged"] >= 64


RESPONSE = "content_id long, status string, items array<map<string,string>>"


def test_enrichment_and_recovery(spark, tables):
    entity_load.daily_entity_load(items(spark, ("3", None, "바다", None, None, None, "NA", None, "", 5)), tables, now(), "seq")
    common = spark.createDataFrame([(1, "ok", [{"contentid": "1", "homepage": " h ", "overview": "o"}]), (2, "error", []), (3, "quota", [])], RESPONSE)
    got = stats(entity_load.enrich("detail_common", common, tables, now()))
    assert got == {"processed": 1, "failed": 1, "pending": 3}
    assert rows(tables.read("entity").select("content_id", "homepage")) == [(1, "h"), (2, None), (3, None)]
    assert rows(tables.read("etl_state").select("content_id", "detail_common_pending")) == [(1, False), (2, True), (3, True)]

    intro = spark.createDataFrame([(1, "ok", [{"infocenter": "i" * 300, "parking": " "}]), (2, "nodata", []), (3, "ok", [])], RESPONSE)
    entity_load.enrich("detail_intro", intro, tables, now())
    one = tables.read("entity").where("content_id = 1").first()
    assert len(one["infocenter"]) == 200 and one["parking"] is None

    info = spark.createDataFrame([(1, "ok", [{"b": "1"}, {"a": "2"}]), (2, "ok", []), (3, "ok", [{"a": "1"}])], RESPONSE)
    entity_load.enrich("detail_info", info, tables, now())
    stored = dict(map(tuple, tables.read("entity").select("content_id", "detail_info").collect()))
    # Entity 3 has no content type to ask for: nothing is stored.
    assert json.loads(stored[1]) == [{"b": "1"}, {"a": "2"}] and json.loads(stored[2]) == [] and stored[3] is None

    image = spark.createDataFrame([(1, "ok", [{"originimgurl": "a"}, {"originimgurl": "", "smallimageurl": "b"}])], RESPONSE)
    assert stats(entity_load.enrich("image", image, tables, now()))["pending"] == 1
    assert rows(tables.read("entity_image")) == [(1, 1, "a"), (1, 2, "b")]

    tables.write("etl_state", tables.read("etl_state").withColumn("image_absent", F.lit(False)))
    answers = spark.createDataFrame([(1, "ok", []), (2, "ok", [{"smallimageurl": "z"}]), (3, "nodata", [])], RESPONSE)
    assert stats(entity_load.image_recovery(answers, tables, now())) == {"processed": 2, "failed": 0}
    assert rows(tables.read("entity").select("content_id", "first_image")) == [(1, "http://1"), (2, "z"), (3, None)]
    assert rows(tables.read("etl_state").select("content_id", "image_absent")) == [(1, False), (2, False), (3, True)]


def test_notify_writes_only_ready_ids(spark, tables, tmp_path):
    entity_load.daily_entity_load(items(spark), tables, now(), "seq")
    state = tables.read("etl_state")
    done = {c: F.col("content_id") != 1 for c in ("detail_common_pending", "detail_intro_pending", "detail_info_pending")}
    tables.write("etl_state", state.withColumns(done))
    out = str(tmp_path / "outbox")
    assert entity_load.notify(tables, "r", out).first()["accepted"] == 1
    assert [r[0] for r in spark.read.text(out).collect()] == ['{"runId":"r","contentIds":[1]}']


def test_hourly_trend_runs_once_per_run_id(spark, tables):
    entity_load.daily_entity_load(items(spark), tables, now(), "seq")
    tables.write("entity", tables.read("entity").withColumn("like_count", F.lit(1)))
    doc = lambda i, channel, text: ("강릉시", channel, "강릉 여행", 0, 1, i, f"u{i}{channel}", "2024-01-01T00:00:00+09:00", "", text)
    docs = spark.createDataFrame(
        [doc(0, "blog", "<b>오죽헌</b> 오죽헌 맛집 강릉시"), doc(1, "blog", "경포대"), doc(0, "cafe", "오죽헌 경포대 경포대 없는곳 없는곳 없는곳")],
        "city_name string, channel string, query string, query_no int, page int, idx int, url string, datetime string, title string, contents string",
    )
    found = lambda keyword, name, x, y: ("강릉시", keyword, 0, "p", name, "AT4", "", "", "강원 강릉시 1", "", str(x), str(y))
    candidates = spark.createDataFrame(
        [found("오죽헌", "강릉 오죽헌", 128.8781, 37.7519), found("경포대", "경포대", 127.0, 37.0)],
        "city_name string, keyword string, pos int, id string, place_name string, category_group_code string, category_group_name string, road_address_name string, address_name string, phone string, x string, y string",
    )
    # A title inside the probe's name fits; a place too far away does not.
    tables.write("entity", tables.read("entity").withColumn("title", F.when(F.col("content_id") == 1, "오죽헌").otherwise(F.col("title"))))
    cities = trend.city_dimension(spark)
    codes = spark.createDataFrame([("강릉시",)], "name string")
    run = lambda run_id: stats(trend.hourly_trend(docs, candidates, tables, cities, trend.stop_list(spark, codes), run_id, now()))
    assert run("run-1") == {"searched": 3, "unverified": 1, "unmatched": 1, "matched": 1}
    score = tables.read("popularity").collect()
    assert len(score) == 1 and score[0]["content_id"] == 1 and score[0]["category_rank"] == 1
    assert score[0]["mention_score"] == pytest.approx(0.99) and score[0]["rank_tag"] == "인기 관광지 1위"
    assert tables.read("source_document").count() == 3
    run("run-1")  # the same run again adds nothing
    assert [r["mention_score"] for r in tables.read("popularity").collect()] == [pytest.approx(0.99)]
    assert tables.read("source_document").count() == 3
    # The next run sees only known documents: nothing to count, scores decay.
    assert run("run-2")["searched"] == 0
    assert [r["mention_score"] for r in tables.read("popularity").collect()] == [pytest.approx(0.99 * 0.99)]


def test_streams_equal_batches(spark, tmp_path):
    path, base = str(tmp_path / "in"), str(tmp_path / "base")
    parts = [[("a", 1, 1.0), ("b", 1, 2.0), ("a", 1, 3.0)], [("a", 3, 1.0)], [("c", 2, 5.0), ("b", 3, 1.0)]]
    ddl = "url string, run_no long, mention_score double"
    for part in parts:
        spark.createDataFrame(part, ddl).withColumn("content_id", F.ascii("url").cast("long")).coalesce(1).write.mode("append").parquet(path)
    schema = ddl + ", content_id long"
    stream = lambda: jobs.file_stream(spark, path, schema, files_per_batch=1)
    assert rows(jobs.stream_new_documents(stream(), base, ["url"])) == [("a",), ("b",), ("c",)]
    state = jobs.stream_mention_scores(stream(), base, 0.5)
    got = {chr(r["content_id"]): r["mention_score"] for r in jobs.scores_at(state, F.lit(3), 0.5).collect()}
    # Run by run: add this run's mentions, then halve everything.
    want = {}
    for run_no in (1, 2, 3):
        for url, at, score in (m for part in parts for m in part):
            if at == run_no:
                want[url] = want.get(url, 0.0) + score
        want = {k: v * 0.5 for k, v in want.items()}
    assert got == pytest.approx(want)
    # A replayed batch finds its version and is not added again.
    tables = Tables(spark, f"{base}/tables")
    versions = len(tables._versions("scores"))
    assert tables.applied("scores", "batch=0") and versions == 3
    before = rows(state)
    assert rows(jobs.stream_mention_scores(stream(), base, 0.5)) == before
    assert len(tables._versions("scores")) == versions
    assert rows(jobs.compact_scores(tables, 0.5)) == before and tables.read("scores").count() == 3


def test_cluster_sessions_need_a_shared_folder(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        shared_root(Cluster)
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def page(request, no, items, total, code="00"):
    body = {"response": {"header": {"resultCode": code}, "body": {"items": {"item": items} if items else "", "totalCount": total}}}
    return (request, no, 2, json.dumps(body))


def test_listing_lands_once_and_loads(spark, tables, tmp_path):
    import datetime as dt

    entry = lambda i, title: {"contentid": str(i), "title": title, "lclsSystm1": "NA"}
    ddl = "request string, page_no int, num_rows int, body string"
    rows_ = [page("1", 1, [entry(1, "a"), entry(2, "b")], 3), page("1", 2, [entry(3, "c")], 3), page("2", 1, [{**entry(1, "z"), "addr1": "x"}], 1)]
    day = dt.date(2024, 1, 1)
    with pytest.raises(landing.ListingFailed):
        landing.land_listing(spark.createDataFrame([*rows_, page("3", 1, None, 0, "22")], ddl), str(tmp_path / "s"), day)
    gap, open_end, changed = [rows_[1]], [rows_[0]], [rows_[0], page("1", 2, [entry(3, "c")], 4)]
    for broken in (gap, open_end, changed, [*gap, rows_[2]]):
        with pytest.raises(landing.ListingFailed):
            landing.land_listing(spark.createDataFrame(broken, ddl), str(tmp_path / "s"), day)
    path = landing.land_listing(spark.createDataFrame(rows_, ddl), str(tmp_path / "s"), day)
    assert landing.land_listing(spark.createDataFrame([], ddl), str(tmp_path / "s"), day) == path
    raw = snapshots.read_snapshot(spark, path)
    assert raw.columns == ["addr1", "contentid", "lclsSystm1", "seq", "title"]
    assert stats(entity_load.daily_entity_load(raw, tables, now(), "seq")) == {"processed": 3, "changed": 3, "quarantined": 0, "duplicated": 1}
    # The later request's copy of entity 1 wins.
    assert rows(tables.read("entity").select("content_id", "title")) == [(1, "z"), (2, "b"), (3, "c")]


def test_codes_and_feedback(spark, tables):
    assert landing.codes_missing(tables, "51")
    areas = spark.createDataFrame([("51", "강원"), (" ", "x"), ("52", None)], "code string, name string")
    districts = spark.createDataFrame([("51", "150", " 강릉시 ")], "area_code string, code string, name string")
    kinds = spark.createDataFrame([("NA", "n", 1, None, None), ("NA01", "m", 2, "NA", None), ("NA0101", "s", 3, "NA", "NA01")],
                                  "code string, name string, depth int, level1 string, level2 string")
    for _ in range(2):
        landing.sync_codes(areas, districts, kinds, tables)
    assert not landing.codes_missing(tables, "51")
    assert rows(tables.read("area_code")) == [("51", "강원")]
    assert rows(tables.read("sigungu_code")) == [("51", "150", "강릉시")]
    assert rows(tables.read("category").select("code", "parent_code")) == [("NA", None), ("NA01", "NA"), ("NA0101", "NA01")]

    entity_load.daily_entity_load(items(spark), tables, now(), "seq")
    tables.write("entity_like", spark.createDataFrame([(7, 1, None), (8, 1, None)], "user_id long, content_id long, created_at timestamp_ntz"))
    review = "review_id long, content_id long, user_id long, rating int, is_deleted boolean, created_at timestamp_ntz"
    tables.write("review", spark.createDataFrame([(1, 1, 7, 5, False, None), (2, 1, 8, 4, False, None), (3, 1, 9, 1, True, None)], review))
    landing.refresh_feedback(tables)
    got = tables.read("entity").select("content_id", "like_count", "review_count", F.col("avg_rating").cast("double"))
    assert rows(got) == [(1, 2, 2, 4.5), (2, 0, 0, 0.0)]


def test_scratch_is_dropped_as_a_whole(spark):
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert files.exists(spark, path)
    drop_scratch(spark)
    assert not files.exists(spark, path)


def test_audit_reports_each_broken_rule(spark, tables):
    entity_load.daily_entity_load(items(spark), tables, now(), "seq")
    review = "review_id long, content_id long, user_id long, rating int, is_deleted boolean, created_at timestamp_ntz"
    tables.write("review", spark.createDataFrame([(1, 1, 7, 6, False, None), (2, 9, 7, 1, False, None), (3, 9, 7, 1, False, None)], review))
    broken = {(r["table"], r["rule"]): r["violations"] for r in audit.audit(tables).collect() if r["violations"]}
    assert broken == {("review", "unique_key"): 1, ("review", "rating_1_to_5"): 1, ("review", "content_id_in_entity"): 2}


def test_trend_snapshots_round_trip(spark, tmp_path):
    import datetime as dt

    from wayline.sources.trend_json import flatten_trend, read_nested

    day = dt.date(2024, 1, 1)
    docs = spark.createDataFrame(
        [("강릉시", "blog", "u", "2024-01-01T00:00:00+09:00", "t", 'c "q"', ["a", "a", "b"])],
        "city_name string, channel string, url string, datetime string, title string, contents string, matched_queries array<string>",
    )
    path = trend.export_documents(docs, str(tmp_path), day, "run-00001")
    assert rows(flatten_trend(read_nested(spark, path))) == rows(docs.select("city_name", "channel", "url", "datetime", "title", "contents", "matched_queries"))
    scored = spark.createDataFrame([("k", "강릉시", 2, 1, True, 3.9, 1.0), ("l", "강릉시", 3, 0, False, 3.0, 0.5)],
                                   ", ".join(f"{n} {t}" for n, t in trend.KEYWORD_FIELDS.items()))
    path = trend.export_keywords(scored, str(tmp_path), day, "run-00001")
    assert path.endswith("aggregated_run-0000")
    assert rows(trend.read_keywords(spark, path)) == rows(scored)


def test_all_kinds_at_once_equal_one_after_the_other(spark, tmp_path):
    one, other = (Tables(spark, str(tmp_path / n), buckets=4) for n in "ab")
    more = items(spark, ("3", None, "바다", None, None, None, "NA", None, "", 5), ("5", "12", "산", None, None, None, "NA", None, None, 6))
    responses = {
        "detail_common": [(1, "ok", [{"homepage": " h ", "overview": "o"}]), (2, "error", []), (3, "quota", [])],
        "detail_intro": [(1, "ok", [{"infocenter": "i", "parking": " "}]), (2, "nodata", []), (3, "ok", [{"infocenter": "x"}])],
        "detail_info": [(1, "ok", [{"b": "1"}]), (2, "ok", []), (3, "ok", [{"a": "1"}])],
        "image": [(1, "ok", [{"originimgurl": "a"}]), (2, "ok", [{"smallimageurl": "z"}]), (3, "nodata", [])],
    }
    frames = {k: spark.createDataFrame(v, RESPONSE) for k, v in responses.items()}
    for t in (one, other):
        entity_load.daily_entity_load(more, t, now(), "seq")
    together = entity_load.enrich_all(frames, one, now())
    apart = {k: stats(entity_load.enrich(k, f, other, now())) for k, f in frames.items()}
    assert {r["kind"]: {c: r[c] for c in ("processed", "failed", "pending")} for r in together.collect()} == apart
    for name in ("entity", "etl_state", "entity_image"):
        assert rows(one.read(name)) == rows(other.read(name))
    with pytest.raises(ValueError):
        entity_load.enrich_all({"other": frames["image"]}, one, now())


def test_runs_leave_a_row_also_when_they_fail(spark, tables):
    from wayline.plans.runs import recorded

    entity_load.daily_entity_load(items(spark), tables, now(), "seq", run_id="day-1")
    with pytest.raises(Exception):
        entity_load.daily_entity_load(items(spark).drop("title").withColumn("title", F.raise_error(F.lit("lost"))), tables, now(), "seq", run_id="day-2")
    got = {r["run_id"]: (r["status"], json.loads(r["stats"])) for r in tables.read("etl_run").collect()}
    assert got["day-1"] == ("success", [{"processed": 2, "changed": 2, "quarantined": 1, "duplicated": 1}])
    assert got["day-2"][0] == "failed" and "error" in got["day-2"][1]
    assert tables.read("etl_run").where("started_at IS NULL OR finished_at IS NULL").count() == 0
    # Done again, a run opens and closes its own row; others stay.
    recorded(tables, "daily_entity_load", "day-2", now(), lambda: spark.range(1).select(F.lit(7).alias("processed")))
    got = {r["run_id"]: (r["status"], r["stats"]) for r in tables.read("etl_run").collect()}
    assert got["day-2"] == ("success", '[{"processed":7}]') and len(got) == 2


def trend_inputs(spark):
    doc = lambda i, channel, text: ("강릉시", channel, "강릉 여행", 0, 1, i, f"u{i}{channel}", "2024-01-01T00:00:00+09:00", "", text)
    ddl = "city_name string, channel string, query string, query_no int, page int, idx int, url string, datetime string, title string, contents string"
    docs = spark.createDataFrame([doc(0, "blog", "오죽헌 오죽헌 오죽헌"), doc(1, "blog", "경포대"), doc(0, "cafe", "오죽헌 경포대 경포대")], ddl)
    none = spark.createDataFrame([], "city_name string, keyword string, pos int, id string, place_name string, category_group_code string, category_group_name string, road_address_name string, address_name string, phone string, x string, y string")
    return docs, none


def test_repeated_run_reads_its_stored_documents(spark, tables, tmp_path):
    import datetime as dt

    docs, none = trend_inputs(spark)
    where = (str(tmp_path / "snapshots"), dt.date(2024, 1, 1))
    run = lambda d, run_id: stats(trend.hourly_trend(d, none, tables, trend.city_dimension(spark), trend.stop_list(spark), run_id, now(), snapshots=where))
    first = run(docs, "run-0001")
    assert first["searched"] == 2
    assert run(docs.limit(0), "run-0001") == first  # the landed pages are gone, the snapshot is there
    assert run(docs, "run-0002")["searched"] == 0  # another run collects anew: nothing is new
    stored = {r["run_id"]: json.loads(r["stats"])[0] for r in tables.read("etl_run").collect()}
    assert stored["run-0001"]["documents"] == 3 and stored["run-0001"]["cities"] == 1 and stored["run-0002"]["documents"] == 0
    path = where[0] + "/2024-01-01/aggregated_run-0001"
    assert rows(trend.read_keywords(spark, path).select("keyword", "blog_frequency", "cafe_frequency")) == [("경포대", 1, 2), ("오죽헌", 3, 1)]


def test_ledger_is_scanned_once_in_the_folders_of_the_run(spark, tables):
    ledger = [(city, channel, f"u{i}", None, "run-0") for city in "abcdef" for channel in ("blog", "cafe") for i in range(3)]
    ddl = "city_name string, channel string, source_url string, published_at timestamp, first_run_id string"
    tables.append("source_document", spark.createDataFrame(ledger, ddl), token="run-0")
    pages = spark.createDataFrame([("b", "blog", "u1"), ("b", "blog", "new"), ("b", "blog", None)], "city_name string, channel string, url string")
    known = trend.known_urls(pages, tables.read("source_document"))
    assert rows(known) == [("b", "blog", "u1", "run-0")]
    plan = known._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "source_url" in line]
    assert len(scans) == 1
    assert "city_name" in scans[0].split("PartitionFilters: [")[1].split("]")[0] and "channel" in scans[0].split("PartitionFilters: [")[1].split("]")[0]


def test_new_documents_stream_keeps_no_state(spark, tmp_path):
    path, base = str(tmp_path / "in"), str(tmp_path / "base")
    ddl = "city string, channel string, url string"
    want = set()
    for part in ([("a", "x", "1"), ("a", "x", "1"), ("b", "x", "1")], [("a", "x", "1"), ("a", "y", "1")], [("b", "x", "1")], [("b", "x", "2"), ("c/d", "x", "1")]):
        spark.createDataFrame(part, ddl).write.mode("append").parquet(path)
        got = jobs.stream_new_documents(jobs.file_stream(spark, path, ddl), base, ["city", "channel", "url"])
        want |= set(part)
        assert rows(got) == sorted(want, key=repr)
    assert not files.exists(spark, f"{base}/checkpoints/new_documents/state")
    assert "city=a" in files.children(spark, f"{base}/new_documents")


@pytest.mark.parametrize("per_bucket", [1_000, 3])
def test_stream_ranks_equal_the_window(spark, tmp_path, per_bucket):
    """Ties, zeros, one favourite score, several runs: rank by score as of the latest run, then the higher id."""
    from pyspark.sql import Window

    draws = [(i, run, score) for i in range(400) for run, score in [(1 + i % 3, [1.0, 0.5, 2.25, 0.0, 1.0, 1.0][i % 6] * (1 + i // 300))]]
    state = jobs.fold_scores(spark.createDataFrame(draws, "content_id long, as_of long, mention_score double"), 0.5)
    categories = spark.range(400).select(F.col("id").alias("content_id"), (F.col("id") % 4 == 0).cast("int").alias("category"))
    got = jobs.ranked_scores(state, 0.5, categories, per_bucket)
    valued = F.col("mention_score") * F.pow(F.lit(0.5), 3 - F.col("as_of") + 1)
    window = Window.partitionBy("category").orderBy(valued.desc(), F.desc("content_id"))
    want = state.join(categories, "content_id").withColumn("category_rank", F.row_number().over(window))
    columns = ["content_id", "category", "category_rank"]
    assert rows(got.select(*columns)) == rows(want.select(*columns))


def test_score_table_is_folded_after_many_parts(spark, tmp_path):
    path, base = str(tmp_path / "in"), str(tmp_path / "base")
    ddl = "content_id long, run_no long, mention_score double"
    categories = spark.createDataFrame([(1, 1), (2, 1)], "content_id long, category int")
    for n in range(1, 6):
        spark.createDataFrame([(1, n, 1.0), (2, n, 2.0)], ddl).coalesce(1).write.mode("append").parquet(path)
        got = jobs.stream_mention_scores(jobs.file_stream(spark, path, ddl), base, 0.5, categories, max_parts=2)
        assert rows(got.select("content_id", "category_rank")) == [(1, 2), (2, 1)]
    tables = Tables(spark, f"{base}/tables")
    assert tables.additions("scores") <= 2
    assert dict(map(tuple, jobs.scores_at(got, F.lit(5), 0.5).select("content_id", "mention_score").collect())) == {1: pytest.approx(0.96875), 2: pytest.approx(1.9375)}


def test_details_are_made_without_a_shuffle_and_ids_not_read_as_text(spark):
    answers = [(1, "ok", [{"b": "1"}, {"a": "x"}], "done"), (2, "ok", [], "done"), (3, "ok", None, "done"), (4, "ok", [{"a": "1"}], "failed")]
    outcomes = spark.createDataFrame(answers, RESPONSE + ", outcome string")
    for kind in ("detail_common", "detail_intro", "detail_info"):
        plan = entity_load._details(kind, outcomes)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Exchange", "Generate", "Join", "RLIKE"))
    info = {r.content_id: r.detail_info for r in entity_load._details("detail_info", outcomes).collect()}
    assert info == {1: '[{"b":"1"},{"a":"x"}]', 2: "[]", 3: "[]"}
    assert {r.content_id for r in entity_load._details("detail_common", outcomes).collect()} == {1}

"""Snapshots, pages, nested JSON and stored tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from wayline.sources import files, pages, snapshots, trend_json
from wayline.sources.outbox import write_outbox
from wayline.sources.tables import Tables, code_table_scan

DAY = dt.date(2024, 1, 2)
AWKWARD = ["plain", 'a "quoted" one', "two\nlines", " padded ", "a,b", "back\\slash", "tail\\", '"', "가나\t다", "cr\r\nlf"]


def test_snapshot_keeps_every_value(spark, tmp_path):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(AWKWARD)], "id string, v string")
    path = snapshots.write_snapshot([df], str(tmp_path), DAY)
    assert path.endswith("execution_date=20240102")
    got = {r["id"]: r["v"] for r in snapshots.read_snapshot(spark, path).collect()}
    assert got == {str(i): v for i, v in enumerate(AWKWARD)}


def test_snapshot_header_is_the_sorted_union_and_the_first_write_stays(spark, tmp_path):
    one = spark.createDataFrame([(1, "x")], "b int, a string")
    two = spark.createDataFrame([("y", "z")], "a string, c string")
    path = snapshots.write_snapshot([one, two], str(tmp_path), DAY)
    got = snapshots.read_snapshot(spark, path)
    assert got.columns == ["a", "b", "c"] and {f.dataType.simpleString() for f in got.schema} == {"string"}
    assert rows(got) == [("x", "1", None), ("y", None, "z")]
    snapshots.write_snapshot([two], str(tmp_path), DAY)
    assert snapshots.read_snapshot(spark, path).count() == 2


def test_half_written_snapshot_is_written_again(spark, tmp_path):
    path = tmp_path / "execution_date=20240102"
    path.mkdir()
    (path / "part-0.csv").write_text("a\nbroken\n")
    df = spark.createDataFrame([("x",)], "a string")
    assert rows(snapshots.read_snapshot(spark, snapshots.write_snapshot([df], str(tmp_path), DAY))) == [("x",)]


def test_empty_snapshot(spark, tmp_path):
    path = snapshots.write_snapshot([spark.createDataFrame([], "a string")], str(tmp_path), DAY)
    got = snapshots.read_snapshot(spark, path)
    assert got.columns == ["_empty"] and got.count() == 0


def body(code="0000", items=None, total=0, raw=None):
    return raw or json.dumps({"response": {"header": {"resultCode": code, "resultMsg": "m"}, "body": {"items": items, "totalCount": total}}})


@pytest.mark.parametrize(
    "text, want",
    [
        (body(items={"item": [{"a": 1}, {"a": "x"}]}, total=2), ("ok", "0000", 2, [{"a": "1"}, {"a": "x"}])),
        (body(items={"item": {"a": "1"}}, total="1"), ("ok", "0000", 1, [{"a": "1"}])),
        (body(code=" 00 ", items="", total=None), ("ok", "00", 0, [])),
        (body(items={"item": "x"}, total=3), ("ok", "0000", 3, [])),
        (body(code="03", items={"item": [{"a": 1}]}, total=9), ("nodata", "03", 0, [])),
        (body(code="0022"), ("quota", "0022", 0, [])),
        (body(code="99"), ("error", "99", 0, [])),
        (body(code=""), ("error", "UNKNOWN", 0, [])),
        (body(raw="<xml/>"), ("error", "UNKNOWN", 0, [])),
        (body(raw='{"response":{"header":{"resultCode":"00"},"body":""}}'), ("ok", "00", 0, [])),
        (body(raw='{"response":{"header":{"resultCode":"00"}}}'), ("ok", "00", 0, [])),
    ],
)
def test_page_bodies(spark, text, want):
    df = spark.createDataFrame([("r", 1, 10, text)], "request string, page_no int, num_rows int, body string")
    row = pages.parse_pages(df).first()
    assert (row["status"], row["result_code"], row["total_count"], row["items"]) == want


def test_listing_ends_at_the_total_or_an_empty_page(spark):
    full = {"item": [{"a": 1}, {"a": 2}]}
    df = spark.createDataFrame(
        [("r", 1, 2, body(items=full, total=4)), ("r", 2, 2, body(items=full, total=4)), ("r", 3, 2, body(items=full, total=4)),
         ("s", 1, 2, body(items=full, total=99)), ("s", 2, 2, body(items="", total=99)), ("s", 3, 2, body(items=full, total=99))],
        "request string, page_no int, num_rows int, body string",
    )
    kept = pages.assemble_pages(pages.parse_pages(df), ["request"])
    assert rows(kept.select("request", "page_no")) == [("r", 1), ("r", 2), ("s", 1), ("s", 2)]
    assert pages.page_items(kept, ["request"]).count() == 6
    assert sorted((r["request"], r["item"]["a"]) for r in pages.first_item(pages.parse_pages(df), ["request"]).collect()) == [("r", "1"), ("s", "1")]


def test_trend_snapshot_round_trip(spark, tmp_path):
    docs = [("강릉시", "blog", f"u{i}", "제목") for i in range(7)] + [("강릉시", "cafe", "", "x"), ("속초시", "cafe", "v", "y")]
    df = spark.createDataFrame(docs, "city string, channel string, url string, title string")
    nested = trend_json.nest_by(df, "city", "channel", [F.col("url").asc()], ["url", "title"], chunk=3)
    assert max(len(v) for r in nested.collect() for c in json.loads(r["json"]).values() for v in c.values()) == 3
    path = trend_json.write_nested(nested, trend_json.snapshot_file(str(tmp_path), "raw", DAY, "0123456789"))
    assert path.endswith("2024-01-02/raw_01234567")
    back = trend_json.flatten_trend(trend_json.read_nested(spark, path)).select("city_name", "channel", "url", "title")
    assert rows(back) == sorted((d for d in docs if d[2]), key=repr)


def test_flatten_skips_what_is_no_document(spark, tmp_path):
    whole = {"collected_at": "t", "cities": {"a": {"blog": [{"url": "u", "matched_queries": ["q"]}, "text", {"url": ""}, {"title": "t"}], "cafe": []}, "b": {"cafe": [{"url": "w"}]}}}
    (tmp_path / "raw.json").write_text(json.dumps(whole, indent=2, ensure_ascii=False), encoding="utf-8")
    got = trend_json.flatten_trend(trend_json.read_whole(spark, str(tmp_path)))
    assert rows(got.select("city_name", "channel", "url", "matched_queries")) == [("a", "blog", "u", ["q"]), ("b", "cafe", "w", None)]
    assert rows(trend_json.flatten_trend(trend_json.read_nested(spark, str(tmp_path)))) == rows(got)
    (tmp_path / "raw.json").write_text(json.dumps(whole, indent=2)[:-3], encoding="utf-8")
    with pytest.raises(Exception, match="not a JSON object"):
        trend_json.read_nested(spark, str(tmp_path)).collect()


def test_tables_versions_tokens_and_lost_writes(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    assert tables.read("area_code").count() == 0 and not tables.exists("area_code")
    with pytest.raises(KeyError):
        tables.read("no_such_table")
    one = spark.createDataFrame([("1", "a")], "area_code string, name string")
    tables.write("area_code", one, token="run 1")
    read = tables.read("area_code")
    tables.write("area_code", read.withColumn("name", F.lit("b")))  # overwrites what it reads
    assert rows(tables.read("area_code")) == [("1", "b")]
    assert rows(tables.write("area_code", one.limit(0), token="run 1")) == [("1", "a")]  # known token
    lost = tmp_path / "area_code" / "v00000009"
    lost.mkdir()
    assert rows(tables.read("area_code")) == [("1", "b")]
    tables.append("area_code", one)
    assert rows(tables.read("area_code")) == [("1", "a"), ("1", "b")]
    tables.compact("area_code")
    assert tables.expire("area_code", keep=1) == 3 and rows(tables.read("area_code")) == [("1", "a"), ("1", "b")]
    assert not files.exists(spark, str(tmp_path / "area_code" / "v00000001-run_1"))
    assert tables.applied("area_code", "run 1") and not tables.applied("area_code", "run 2")
    tables.append("area_code", one, token="run 1")  # an expired run does not add again
    assert rows(tables.read("area_code")) == [("1", "a"), ("1", "b")]


def test_outbox_counts_what_it_wrote(spark, tmp_path):
    batches = spark.createDataFrame([('{"runId":"r","contentIds":[1,2]}',), ('{"runId":"r","contentIds":[3]}',)], "message string")
    assert write_outbox(batches, str(tmp_path / "out")).first()["accepted"] == 3


def test_code_scan(spark):
    codes = spark.createDataFrame([("2", "b"), ("1", "a"), ("3", "x")], "code string, name string")
    got = code_table_scan(codes, ["code"], ["code"], F.col("name") != "x")
    assert [r[0] for r in got.collect()] == ["1", "2"]


def buckets(spark, base):
    """File names of every bucket folder."""
    return {b: files.children(spark, f"{base}/{b}") for b in files.children(spark, base) if "=" in b}


def test_merge_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    from wayline.operators import merge

    tables = Tables(spark, str(tmp_path), buckets=64)
    first = spark.range(5_000).select(F.col("id").alias("content_id"), F.lit(0).alias("order"), F.lit("old").alias("image_url"))
    tables.write("entity_image", first)
    base = str(tmp_path / "entity_image" / "v00000001")
    before = buckets(spark, base)
    assert len(before) == 64
    ids = spark.createDataFrame([(7,), (4_999,), (6_000,)], "content_id long")
    rows_ = ids.withColumns({"order": F.lit(1), "image_url": F.lit("new")})
    update = lambda stored: merge.merge_upsert(stored, rows_, ["content_id"])
    touched = tables.merge("entity_image", ids, update)
    after = buckets(spark, base)
    assert 1 <= len(touched) <= 3
    assert {b for b in before if before[b] != after[b]} == {f"bucket64={b}" for b in touched}
    got = tables.read("entity_image")
    assert got.count() == 5_001 and rows(got.where("image_url = 'new'").select("content_id")) == [(4_999,), (6_000,), (7,)]
    tables.merge("entity_image", ids, update)  # again: the same rows
    assert tables.read("entity_image").count() == 5_001 and tables.merge("entity_image", ids.limit(0), update) == []
    # The scan of a merge opens the touched folders only.
    plans = []
    tables.merge("entity_image", ids, lambda stored: (plans.append(stored._jdf.queryExecution().sparkPlan().toString()), stored)[1])
    assert "bucket64" in plans[0].split("PartitionFilters: [")[1].split("]")[0]


def test_merge_empties_a_bucket_and_keeps_its_layout(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), buckets=4)
    rows_ = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "content_id long, `order` int, image_url string")
    assert tables.merge("entity_image", rows_, lambda stored: rows_) == [0, 1, 2, 3]  # the first version
    other = Tables(spark, str(tmp_path), buckets=16)  # a stored version keeps its number of buckets
    one = rows_.where("content_id = 1")
    touched = other.merge("entity_image", one, lambda stored: stored.where("content_id <> 1"))
    assert len(touched) == 1 and touched[0] < 4 and rows(other.read("entity_image")) == [(2, 1, "b")]
    with pytest.raises(ValueError):
        other.merge("entity_image", one, lambda stored: rows_.withColumn("content_id", F.col("content_id") + 100))
    assert rows(other.read("entity_image")) == [(2, 1, "b")]
    other.write("entity_image", rows_)
    assert len(buckets(spark, str(tmp_path / "entity_image" / "v00000002"))) == 2 and rows(other.read("entity_image")) == rows(rows_)


def test_images_are_numbered_inside_their_array(spark):
    from wayline.operators.normalize import normalize_images, number_images

    answers = [(1, [{"originimgurl": " a "}, {"originimgurl": "", "smallimageurl": "b"}, {}, {"smallimageurl": "c"}]), (2, []), (3, None), (4, [{"originimgurl": "z"}])]
    df = spark.createDataFrame(answers, "content_id long, items array<map<string,string>>")
    got = number_images(df)
    assert rows(got) == [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (4, 1, "z")]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    flat = df.select(F.col("content_id").cast("string").alias("contentid"), F.posexplode("items").alias("pos", "item")).select(
        "contentid", "pos", *[F.col("item")[c].alias(c) for c in ("originimgurl", "smallimageurl")]
    )
    assert rows(normalize_images(flat, [F.col("pos").asc()])) == rows(got)


@pytest.mark.parametrize("inner", ["channel", None])
def test_whole_object_snapshots(spark, tmp_path, inner):
    docs = [(c, ch, f'u"{i}', "제목\n2") for c in ("강릉시", 'b"c', "속초시") for ch in ("blog", "cafe") for i in range(3) if (c, ch) != ("속초시", "blog")]
    df = spark.createDataFrame([*docs, (None, "blog", "x", "y")], "city string, channel string, url string, title string")
    path = trend_json.write_whole(df, str(tmp_path / "w"), "city", inner, [F.col("url").asc(), F.col("channel").asc()], ["url", "title"], {"collected_at": "t"})
    files_ = list((tmp_path / "w").glob("part-*"))
    got = json.loads("".join(f.read_text(encoding="utf-8") for f in files_))
    assert len(files_) == 1 and got["collected_at"] == "t"
    want = {}
    for c, ch, u, t in sorted(docs, key=lambda d: (d[0], d[1], d[2]) if inner else (d[0], d[2], d[1])):
        at = want.setdefault(c, {} if inner else [])
        (at.setdefault(ch, []) if inner else at).append({"url": u, "title": t})
    assert got["cities"] == want
    if inner:
        back = trend_json.flatten_trend(trend_json.read_nested(spark, path)).select("city_name", "channel", "url", "title")
        assert rows(back) == sorted(docs, key=repr)
    empty = trend_json.write_whole(df.limit(0), str(tmp_path / "e"), "city", inner, [F.col("url").asc()], ["url"])
    assert json.loads((next((tmp_path / "e").glob("part-*"))).read_text()) == {"cities": {}} and empty


def test_many_changes_are_not_broadcast_by_the_size_of_compressed_files(spark, tmp_path):
    from wayline.operators import changes, merge, queues

    tables = Tables(spark, str(tmp_path))
    ids = spark.range(30_000).select(F.col("id").alias("content_id"))
    tables.write("entity_image", ids.select("content_id", F.lit(0).alias("order"), F.lit("old").alias("image_url")))
    plans = []

    def update(source):
        def change(stored):
            merged = merge.update_from(stored, source, ["content_id"], ["image_url"])
            plans.append(merged._jdf.queryExecution().executedPlan().toString())
            return merged

        return change

    ids.withColumn("image_url", F.lit("new")).write.parquet(str(tmp_path / "changes"))
    many = spark.read.parquet(str(tmp_path / "changes"))
    tables.merge("entity_image", many, update(many))
    few = many.where("content_id < 3")
    tables.merge("entity_image", few, update(few))
    assert "Broadcast" not in plans[0] and "BroadcastHashJoin" in plans[1]
    assert tables.read("entity_image").where("image_url = 'new'").count() == 30_000

    state = many.select("content_id", F.lit(False).alias("image_absent"), F.col("image_url").alias("h"))
    whole = [
        queues.missing_children(many, state, tables.read("entity_image"), limit=None),
        changes.detect_changes(state, state, many, "content_id", "h"),
    ]
    for df in whole:
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString() and df.count() == 0

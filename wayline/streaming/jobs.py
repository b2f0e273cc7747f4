"""Streams with durable state: new documents, mention scores, change feed.

All run with `availableNow`, so a scheduled call works off what has arrived.
Checkpoints and tables lie below the caller's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wayline.operators.changes import dedup_last_wins
from wayline.operators.documents import except_seen
from wayline.operators.merge import merge_upsert
from wayline.session import materialize
from wayline.sources import files
from wayline.sources.tables import Tables


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _run(stream: DataFrame, base: str, name: str, batch: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", f"{base}/checkpoints/{name}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_new_documents(arrivals: DataFrame, base: str, keys: Sequence[str]) -> DataFrame:
    """Each key once ever, recorded in a ledger that is also the result.

    The ledger lies in folders of all keys but the last (city and channel), and
    a batch looks up its keys in the folders of its own values, so what a batch
    reads does not grow with all that was ever seen elsewhere, and the stream
    itself keeps no state. A batch writes under its own number: replayed, it
    leaves its own rows out of the lookup and replaces them.
    """
    out, folders = f"{base}/new_documents", list(keys[:-1])
    spark = arrivals.sparkSession
    schema = arrivals.select(*keys, F.lit(0).cast("long").alias("batch_no")).schema

    def ledger() -> DataFrame:
        if not files.exists(spark, out):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(out)

    def record(batch: DataFrame, batch_id: int) -> None:
        unique = batch.select(*keys).dropna().distinct()
        fresh = except_seen(unique, ledger().where(F.col("batch_no") != batch_id), keys, folders)
        new = materialize(fresh.withColumn("batch_no", F.lit(batch_id).cast("long")), "new-documents")
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders, "batch_no").parquet(out)

    _run(arrivals, base, "new_documents", record)
    return ledger().select(*keys)


def fold_scores(parts: DataFrame, factor: float) -> DataFrame:
    """All recorded scores of an entity as one, valued at its latest run.

    A score decays once per run, so it is kept together with the run it is
    valued at. The fold gives the same result in any order and grouping, so
    parts can be recorded as they come and folded when read.
    """
    latest = parts.groupBy("content_id").agg(F.max("as_of").alias("_latest"))
    aged = F.col("mention_score") * F.pow(F.lit(factor), F.col("_latest") - F.col("as_of"))
    return (
        parts.join(latest, "content_id")
        .groupBy("content_id")
        .agg(F.sum(aged).alias("mention_score"), F.max("_latest").cast("bigint").alias("as_of"))
    )


def scores_at(state: DataFrame, run_no: Column, factor: float) -> DataFrame:
    """Scores as the decay step of run `run_no` leaves them."""
    return state.withColumn("mention_score", F.col("mention_score") * F.pow(F.lit(factor), run_no - F.col("as_of") + 1))


#: After so many additions the score table is rewritten as its fold.
MAX_PARTS = 24


def stream_mention_scores(
    arrivals: DataFrame, base: str, factor: float, categories: DataFrame | None = None, max_parts: int = MAX_PARTS,
) -> DataFrame:
    """Record arriving mentions in the score table; returns the folded state, ranked if `categories` is given.

    A batch adds one row per entity and run and rewrites nothing. Its id is the
    version token, so a replayed batch is not added twice. A call folds the
    table when it has more than `max_parts` additions, so reading it costs one
    row per entity and a bounded number of batches. With `categories`
    (`content_id`, `category`) the result has `category` and `category_rank`
    by score as the latest run leaves it (see `ranked_scores`).
    """
    tables = Tables(arrivals.sparkSession, f"{base}/tables")

    def record(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy("content_id", F.col("run_no").alias("as_of")).agg(F.sum("mention_score").alias("mention_score"))
        tables.append("scores", sums, f"batch={batch_id}")

    _run(arrivals, base, "scores", record)
    if not tables.exists("scores"):
        return arrivals.sparkSession.createDataFrame([], "content_id long, mention_score double, as_of long")
    if tables.additions("scores") > max_parts:
        compact_scores(tables, factor)
    state = fold_scores(tables.read("scores"), factor)
    return state if categories is None else ranked_scores(state, factor, categories)


def ranked_scores(state: DataFrame, factor: float, categories: DataFrame, per_bucket: int = 1_000) -> DataFrame:
    """The state with `category` and `category_rank`: highest decayed score first, then the higher id.

    One decay for all keeps their order, so scores are compared as of one run.
    No category is sorted: scores fall into fine logarithmic buckets whose
    counts, a small histogram, give the rank at which a bucket begins; rows are
    only numbered within their bucket. Buckets that hold much more than
    `per_bucket` rows are cut again by their place on a line through the bucket,
    by score and where that is one value by id.
    """
    latest = state.agg(F.max("as_of")).scalar()
    valued = F.col("mention_score") * F.pow(F.lit(factor), latest - F.col("as_of") + 1)
    rows = state.join(categories.select("content_id", "category"), "content_id")
    coarse = F.when(valued > 0, F.floor(F.log2(valued) * 16)).otherwise(F.lit(-1 << 40))
    rows = materialize(rows.withColumns({"_value": valued, "_coarse": coarse.cast("long")}), "stream-scores")
    bounds = rows.groupBy("category", "_coarse").agg(
        F.count("*").alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high"),
        F.min("content_id").cast("double").alias("_first"), F.max("content_id").cast("double").alias("_last"),
    )
    # A few hundred buckets a category: stored, so that their size is known and they go to the rows.
    bounds = materialize(bounds, "stream-bounds")
    # As many parts as the bucket's size asks for, evenly over its values, or over its ids if it has one value.
    along = F.when(F.col("_high") > F.col("_low"), (F.col("_value") - F.col("_low")) / (F.col("_high") - F.col("_low"))).when(
        F.col("_last") > F.col("_first"), (F.col("content_id") - F.col("_first")) / (F.col("_last") - F.col("_first"))
    ).otherwise(F.lit(0.0))
    parts = F.ceil(F.col("_n") / per_bucket)
    cut = rows.join(bounds, ["category", "_coarse"]).withColumn("_fine", F.least(F.floor(along * parts), parts - 1))
    cut = materialize(cut.drop("_n", "_low", "_high", "_first", "_last"), "stream-buckets")
    order = Window.partitionBy("category").orderBy(F.desc("_coarse"), F.desc("_fine")).rowsBetween(Window.unboundedPreceding, -1)
    histogram = cut.groupBy("category", "_coarse", "_fine").agg(F.count("*").alias("_n"))
    begins = histogram.select("category", "_coarse", "_fine", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("category", "_coarse", "_fine").orderBy(F.desc("_value"), F.desc("content_id")))
    numbered = cut.withColumn("_inside", inside).join(begins, ["category", "_coarse", "_fine"])
    return numbered.select(
        "content_id", "mention_score", "as_of", "category", (F.col("_before") + F.col("_inside")).cast("bigint").alias("category_rank")
    )


def compact_scores(tables: Tables, factor: float) -> DataFrame:
    """Rewrite the score table as its fold, one row per entity."""
    return tables.write("scores", fold_scores(tables.read("scores"), factor))


def stream_change_feed(
    arrivals: DataFrame, base: str, key: str, hash_col: str, seq: str, valid: Column, label: str
) -> DataFrame:
    """Changed entities of every arriving snapshot, each against the snapshot before it.

    Snapshots must arrive in order, but any number of them may land before a
    call: inside a batch an entity's rows are compared in order of `seq`, the
    first with the stored state. Of rows with equal `seq` the last by content
    counts. The state lies in buckets of the key, and a batch rewrites those of
    the keys that changed. The feed of a batch is published first and the state
    brought up to it after; a batch that finds its feed published only does the
    latter, which may be repeated.
    """
    spark = arrivals.sparkSession
    columns = [key, hash_col]
    schema = arrivals.select(*columns).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    tables = Tables(spark, f"{base}/tables", more={"state": (ddl, key)})
    feed = f"{base}/feed"
    stored_feed = arrivals.select(label, *columns, F.col(seq).alias("_seq")).schema

    def step(batch: DataFrame, batch_id: int) -> None:
        path = f"{feed}/batch={batch_id}"
        if not files.committed(spark, path):
            unique = dedup_last_wins(batch.where(valid), [key, seq], [hash_col])
            # A window per entity: one row for each snapshot it is in.
            before = F.lag(hash_col).over(Window.partitionBy(key).orderBy(seq))
            stored = tables.read("state").select(F.col(key).alias("_key"), F.col(hash_col).alias("_stored"))
            compared = unique.withColumn("_before", before).join(stored, F.col(key) == F.col("_key"), "left")
            differs = ~F.col(hash_col).eqNullSafe(F.coalesce("_before", "_stored"))
            changed = compared.where(differs).select(label, *columns, F.col(seq).alias("_seq"))
            changed.write.mode("overwrite").parquet(path)
        changed = spark.read.schema(stored_feed).parquet(path)
        latest = dedup_last_wins(changed, [key], ["_seq"]).select(*columns)
        tables.merge("state", latest, lambda stored: merge_upsert(stored, latest, [key]))

    _run(arrivals, base, "feed", step)
    if not files.exists(spark, feed):
        return spark.createDataFrame([], stored_feed).select(label, *columns)
    return spark.read.option("basePath", feed).schema(stored_feed).parquet(feed).select(label, *columns)

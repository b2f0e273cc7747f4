"""Daily incremental load: snapshot to entities, work flags and enrichment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from wayline import constants as K
from wayline.operators import merge
from wayline.operators.changes import dedup_last_wins, detect_changes
from wayline.operators.normalize import (
    entity_rules, normalize_detail_common, normalize_detail_intro, normalize_entity,
    number_images, with_reason,
)
from wayline.operators.queues import (
    missing_children, outbox_batches, pending_queue, ready_queue, stop_at_first_failure,
)
from wayline.plans.runs import recorded, run_name
from wayline.session import materialize, union_rows
from wayline.sources.outbox import write_outbox
from wayline.sources.tables import Tables

_ENTITY_COLUMNS = (
    "content_type_id", "title", "addr1", "addr2", "zipcode", "map_x", "map_y", "map_level",
    "ldong_regn_code", "ldong_signgu_code", "sigungu_code", "category", "first_image", "created_time",
)

#: A snapshot is normalised in at least this many tasks, whatever its number of files.
_MIN_TASKS = 64


def daily_entity_load(
    raw: DataFrame, tables: Tables, now: Column, seq: str, rules=K.CATEGORY_RULES,
    version: str = K.CONTENT_HASH_VERSION, run_id: str | None = None,
) -> DataFrame:
    """Load one snapshot as a run of the ledger; returns the stage counters.

    Quarantine comes before the duplicate rule, so a bad later copy never
    replaces a good earlier one. The judged rows are stored once, spread over
    tasks, so that no rule is worked out again for filters or counters; the
    changed rows are stored, as both tables are built from them. The state is
    published last: a run lost in between loads the same rows again.
    """
    run_id = run_id or run_name(tables, now)
    return recorded(tables, "daily_entity_load", run_id, now, lambda: _load(raw, tables, now, seq, rules, version))


def _load(raw: DataFrame, tables: Tables, now: Column, seq: str, rules, version: str) -> DataFrame:
    # A row costs much more to normalise than to read: few input splits must not be few tasks.
    spread = raw.repartition(max(_MIN_TASKS, raw.sparkSession.sparkContext.defaultParallelism * 3))
    judged = materialize(with_reason(normalize_entity(spread, rules, version, keep=[seq]), entity_rules()), "judged")
    valid = judged.where("_reason IS NULL")
    unique = dedup_last_wins(valid, ["content_id"], [seq])
    state, entities = tables.read("etl_state"), tables.read("entity")
    changed = materialize(
        detect_changes(unique, state, entities, "content_id", "content_hash").drop("_reason", seq), "changed"
    )
    rows = changed.withColumn("collected_at", now)
    tables.merge("entity", changed, lambda stored: merge.merge_upsert(
        stored, rows, ["content_id"], update=[*_ENTITY_COLUMNS, "collected_at"],
        insert_defaults={c: F.lit(0) for c in ("like_count", "review_count", "avg_rating")},
    ))
    tables.merge("etl_state", changed, lambda stored: merge.state_upsert(stored, changed, now))

    counts = judged.agg(
        F.count(F.when(F.col("_reason").isNull(), 1)).alias("_valid"),
        F.count("_reason").alias("quarantined"),
        F.count_distinct(F.when(F.col("_reason").isNull(), F.col("content_id"))).alias("processed"),
    )
    return counts.select(
        "processed",
        changed.agg(F.count("*")).scalar().alias("changed"),
        "quarantined",
        (F.col("_valid") - F.col("processed")).alias("duplicated"),
    )


def _outcomes(queue: DataFrame, responses: DataFrame, limit: int | None) -> DataFrame:
    """Queued ids with their landed response, up to the first exhausted quota; a queue without `limit` is never broadcast."""
    answered = (queue.hint("merge") if limit is None else queue).join(responses, "content_id")
    return materialize(stop_at_first_failure(answered, [], "content_id"), "outcomes")


def _first_item(outcomes: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Fields of the first item of finished responses that have one."""
    found = outcomes.where("outcome = 'done' AND size(items) > 0")
    columns = [F.get("items", F.lit(0))[n].alias(n) for n in names]
    return found.select(F.col("content_id").alias("contentid"), *columns)


KINDS = ("detail_common", "detail_intro", "detail_info", "image")
_INTRO = ("infocenter", "usetime", "restdate", "parking", "expguide")


def enrich(kind: str, responses: DataFrame, tables: Tables, now: Column, limit: int | None = K.DETAIL_BATCH_LIMIT) -> DataFrame:
    """Apply landed detail responses (`content_id`, `status`, `items`) of one kind to the pending queue.

    `kind`: detail_common, detail_intro, detail_info or image. Returns counters.
    """
    return enrich_all({kind: responses}, tables, now, limit).drop("kind")


def enrich_all(responses: Mapping[str, DataFrame], tables: Tables, now: Column, limit: int | None = K.DETAIL_BATCH_LIMIT) -> DataFrame:
    """Apply the landed responses of several kinds at once; returns counters by kind.

    Every kind has its own queue, flag and columns, so their changes are one
    set: entity, images and state each rewrite the buckets they touch once. The
    state comes last; a run lost before it is done again.
    """
    unknown = set(responses) - set(KINDS)
    if unknown:
        raise ValueError(f"unknown kinds {sorted(unknown)}")
    state = tables.read("etl_state")
    counters, details, flags = [], [], []
    images = parents = None
    for kind in (k for k in KINDS if k in responses):
        queue = materialize(pending_queue(state, f"{kind}_pending", limit=limit), "queue")
        outcomes = _outcomes(queue, responses[kind], limit)
        counters.append(_counters(outcomes).select(F.lit(kind).alias("kind"), "*", queue.agg(F.count("*")).scalar().alias("pending")))
        done = outcomes.where("outcome = 'done'").select("content_id")
        if kind == "image":
            images, parents = _images(outcomes), done
            done = _with_images(done, images)
        else:
            details.append(_details(kind, outcomes))
        flags.append(done.withColumn(f"_{kind}", F.lit(True)))
    _apply(details, images, parents, tables)
    done = materialize(_one_per_id(flags), "done")
    cleared = {f"{kind}_pending": F.when(F.col(f"s._{kind}"), F.lit(False)).otherwise(F.col(f"t.{kind}_pending")) for kind in responses}
    if images is not None:
        cleared["image_absent"] = F.when(F.col("s._image"), F.col("s._has").isNull()).otherwise(F.col("t.image_absent"))
    cleared["last_etl_at"] = now
    tables.merge("etl_state", done, lambda stored: merge.update_from(stored, done, ["content_id"], [], cleared))
    return union_rows(*counters)


def _counters(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count(F.when(F.col("outcome") == "done", 1)).alias("processed"),
        F.count(F.when(F.col("outcome") == "failed", 1)).alias("failed"),
    )


def _one_per_id(parts: list[DataFrame]) -> DataFrame:
    """The columns of all parts, each of which has an id once at most."""
    rows = union_rows(*parts, allow_missing=True)
    return rows.groupBy("content_id").agg(*[F.max(c).alias(c) for c in rows.columns if c != "content_id"])


def _images(outcomes: DataFrame) -> DataFrame:
    return materialize(number_images(outcomes.where("outcome = 'done'").select("content_id", "items")), "images")


def _first_images(images: DataFrame) -> DataFrame:
    return images.where("`order` = 1").select("content_id", "image_url")


def _with_images(done: DataFrame, images: DataFrame) -> DataFrame:
    """Finished ids, `_has` where they got images."""
    return done.hint("merge").join(_first_images(images).select("content_id", F.lit(True).alias("_has")), "content_id", "left")


def _if_typed(kind: str, column: str) -> Column:
    """The new value, unless the entity has no content type to ask details for."""
    fits = F.col(f"s._{kind}") & F.col("t.content_type_id").isNotNull()
    return F.when(fits, F.col(f"s.{column}")).otherwise(F.col(f"t.{column}"))


def _details(kind: str, outcomes: DataFrame) -> DataFrame:
    """The entity columns that the finished responses of one kind bring, marked by `_kind`."""
    if kind == "detail_common":
        rows = normalize_detail_common(_first_item(outcomes, ("homepage", "overview")))
    elif kind == "detail_intro":
        rows = normalize_detail_intro(_first_item(outcomes, _INTRO))
    else:
        # The items are in response order already. An empty answer stores an empty list, unless the entity has no type to ask for.
        joined = F.array_join(F.transform("items", lambda i: F.to_json(i)), ",")
        text = F.concat(F.lit("["), F.coalesce(joined, F.lit("")), F.lit("]"))
        rows = outcomes.where("outcome = 'done'").select("content_id", text.alias("detail_info"))
    return rows.withColumn(f"_{kind}", F.lit(True))


def _apply(details: list[DataFrame], images: DataFrame | None, parents: DataFrame | None, tables: Tables) -> None:
    """Bring new images and entity columns into their tables."""
    parts = list(details)
    if images is not None:
        tables.merge("entity_image", parents, lambda stored: merge.replace_children(stored, parents, images, "content_id"))
        parts.append(_first_images(images))
    if not parts:
        return
    rows = materialize(_one_per_id(parts), "details")
    new = {}
    if "_detail_common" in rows.columns:
        new |= {c: F.when(F.col("s._detail_common"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) for c in ("homepage", "overview")}
    if "_detail_intro" in rows.columns:
        new |= {c: _if_typed("detail_intro", c) for c in _INTRO}
    if "_detail_info" in rows.columns:
        new["detail_info"] = _if_typed("detail_info", "detail_info")
    if images is not None:
        new["first_image"] = F.coalesce("t.first_image", "s.image_url")
    tables.merge("entity", rows, lambda stored: merge.update_from(stored, rows, ["content_id"], [], new))


def image_recovery(responses: DataFrame, tables: Tables, now: Column, limit: int | None = K.IMAGE_RECOVERY_LIMIT) -> DataFrame:
    """Ask again for entities without images; those without any at the source are marked absent."""
    state = tables.read("etl_state")
    targets = missing_children(tables.read("entity"), state, tables.read("entity_image"), limit=limit)
    outcomes = _outcomes(targets, responses, limit)
    images, parents = _images(outcomes), outcomes.where("outcome = 'done'").select("content_id")
    _apply([], images, parents, tables)
    done = materialize(_with_images(parents, images), "done")
    cleared = {"image_pending": F.lit(False), "image_absent": F.col("s._has").isNull(), "last_etl_at": now}
    tables.merge("etl_state", done, lambda stored: merge.update_from(stored, done, ["content_id"], [], cleared))
    return _counters(outcomes)


def notify(tables: Tables, run_id: str, path: str, limit: int | None = K.NOTIFY_LIMIT, batch_size: int = K.NOTIFY_BATCH) -> DataFrame:
    """Put the ready ids into the outbox; the consumer clears `embed_pending` itself."""
    ready = ready_queue(tables.read("etl_state"), limit=limit)
    return write_outbox(outbox_batches(ready, run_id, limit=None, batch_size=batch_size), path)

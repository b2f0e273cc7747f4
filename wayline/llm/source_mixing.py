"""Mixing sources to target weights: capped water-filling and seeded repetitions of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayline.session import materialize

#: Weights that the sources get in turn, in order of their names.
WEIGHTS = (3.0, 1.0, 2.0)
#: Words of the mix as a share of all words, and how often a source's words are taken at most.
SHARE, MAX_EPOCHS = 1.5, 2.0
_LEVEL_BITS, _LEVELS = 12, 2
_DRAW_BITS = 60


def n_words(text: Column) -> Column:
    """Runs of characters other than the six ASCII blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_filling(sources: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Adds `target` to one row per source (`source_size`, `weight`).

    The total is `share` of all sizes, given out by weight; a source stops at
    `max_epochs` of its size and its excess goes to the others by weight, until
    none is above. Sources are filled up in order of cap per weight: with the
    sources before it full, a source is full as well if the level, which is
    what is left per weight left, is not below its own cap per weight.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    order = Window.orderBy("_ratio", "_place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = sources.withColumns({"_cap": cap, "_ratio": cap / F.col("weight")})
    rows = rows.withColumns({
        "_total": F.sum("source_size").over(everything) * F.lit(share),
        "_full": F.coalesce(F.sum("_cap").over(order), F.lit(0.0)),
        "_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0.0)),
    })
    rows = rows.withColumn("_level", (F.col("_total") - F.col("_full")) / F.col("_left"))
    # The level at the first source that does not fill up; null if all do.
    level = F.min_by("_level", F.when(F.col("_level") < F.col("_ratio"), F.struct("_ratio", "_place"))).over(everything)
    any_open = F.max((F.col("_level") < F.col("_ratio")).cast("int")).over(everything) == 1
    rows = rows.withColumn("_level", F.when(any_open, level))
    target = F.coalesce(F.least(F.col("_cap"), F.col("_level") * F.col("weight")), F.col("_cap"))
    return rows.withColumn("target", target).drop("_cap", "_ratio", "_total", "_full", "_left", "_level")


def source_weights(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """`source`, `source_size` and `weight` of every source: weights in turn by code point, null last."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source: names and sums, not documents.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*map(F.lit, weights))
    return totals.withColumn("_place", place).withColumn("weight", F.get(turn, F.col("_place") % len(weights)))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = 17,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every document with `size`, `source_size`, `target` and `repeats`, how often the mix takes it.

    All documents are taken `floor(target / source size)` times. For the
    fraction that is left, a draw that depends on the seed, the id and the
    text orders a source's documents, and those up to the missing words are
    taken once more; of the documents that share the draw at the border, all
    or none, whichever comes nearer. The border is found on sums over ranges of
    the draw, narrowed twice, so no source is sorted in one task.

    Null texts have size 0; null sources are a source of their own; repeated
    rows share their draw. Null ids are allowed. The result has `id`, `source`
    and the columns named in `keep`; a source without words has target 0.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(docs[id_col].cast("string"), F.lit("")), text).cast("binary"))
    sized = materialize(docs.select(
        docs[id_col].alias("id"), docs[source_col].alias("source"), n_words(docs[text_col]).alias("size"),
        F.conv(F.substring(drawn, 1, _DRAW_BITS // 4), 16, 10).cast("long").alias("draw"), *[docs[c].alias(f"_keep_{c}") for c in keep],
    ), "mixing")
    plan = materialize(water_filling(source_weights(sized, weights), share, max_epochs), "mixing-plan")
    whole = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))

    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    # Narrow the border: `low` is the range it lies in, `missing` what is still to take from there on.
    border = plan.select("source", "missing", F.lit(0).cast("long").alias("low"))
    shift = _DRAW_BITS
    for _ in range(_LEVELS):
        shift -= _LEVEL_BITS
        inside = sized.join(border, same(sized, border)).select(sized["source"], "size", "draw", "low", "missing").filter(
            F.shiftright("draw", shift + _LEVEL_BITS) == F.shiftright("low", shift + _LEVEL_BITS)
        )
        ranges = inside.groupBy("source", "missing", F.shiftright("draw", shift).alias("range")).agg(F.sum("size").alias("n"))
        border = _border(ranges, "range").withColumn("low", F.shiftleft("range", shift)).select("source", "missing", "low")
        border = materialize(border, "mixing-border")
    inside = sized.join(border, same(sized, border)).select(sized["source"], "size", "draw", "low", "missing").filter(
        F.shiftright("draw", shift) == F.shiftright("low", shift)
    )
    ends = _border(inside.groupBy("source", "missing", "draw").agg(F.sum("size").alias("n")), "draw")
    # `missing` words are still to come when the border's documents are reached: take them if that is nearer.
    ends = ends.select("source", F.col("draw").alias("end"), (F.col("missing") * 2 >= F.col("n")).alias("with_end"))
    plan = plan.alias("p").join(ends.alias("e"), F.expr("p.source <=> e.source"), "left").select("p.*", "end", "with_end")
    # Stored, so that its real size decides how the documents meet it: no source needs to go to one task.
    plan = materialize(plan, "mixing-plan")
    extra = (F.col("draw") < F.col("end")) | ((F.col("draw") == F.col("end")) & F.col("with_end"))
    repeats = F.col("whole") + F.coalesce(extra, F.lit(False)).cast("long")
    return sized.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source")).select(
        "id", F.col("d.source").alias("source"), "size", "source_size", "target", repeats.alias("repeats"),
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
    )


def _border(sums: DataFrame, key: str) -> DataFrame:
    """Per source the first `key` at which the running sum of `n` passes `missing`, with what is missing before it.

    A source whose sum never passes it has its last key. Sources that miss nothing have no row.
    """
    order = Window.partitionBy("source").orderBy(key)
    after = F.sum("n").over(order)
    rows = sums.filter("missing > 0").withColumns({
        "after": after, "final": F.lead(key).over(order).isNull(),
    })
    hit = rows.filter((F.col("after") > F.col("missing")) | F.col("final"))
    first = hit.groupBy("source").agg(F.min_by(F.struct(key, "n", "after", "missing"), key).alias("b"))
    return first.select(
        "source", F.col(f"b.{key}").alias(key), F.col("b.n").alias("n"),
        (F.col("b.missing") - (F.col("b.after") - F.col("b.n"))).alias("missing"),
    )

"""Prefix tries of conversations by truncation peeling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wayline.operators.ordering import distributed_row_number
from wayline.session import materialize, scratch_path

#: Ids of a node's ended conversations are joined in pieces of at most so many.
PIECE = 8_192
#: Children of one node meet it in so many groups, however many it has.
SALTS = 16
_ROOT = "CAST(0 AS BIGINT)"
_DIGESTS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("whole", pa.string())])


def slim_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """`conv`, `turn`, `token` (128 bits that stand for role and text) and `size` (code points) of every turn with an id.

    Null role or text counts as empty. Only these few bytes travel from here on.
    """
    role, text = F.coalesce(conversations[role_col], F.lit("")), F.coalesce(conversations[text_col], F.lit(""))
    token = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    return conversations.select(
        conversations[id_col].cast("long").alias("conv"), conversations[turn_col].cast("long").alias("turn"),
        token.alias("token"), F.length(text).cast("long").alias("size"),
    ).filter("conv IS NOT NULL")


def in_order(turns: DataFrame) -> DataFrame:
    """Adds `place` from 0: by turn, null first; turns of one number by the hex digits of their token."""
    numbered = distributed_row_number(turns, ["conv"], [F.col("turn").asc_nulls_first(), F.col("token").asc()], "place")
    return numbered.withColumn("place", F.col("place") - 1)


def branched(placed: DataFrame, block: int = 100, heads: int = 6) -> DataFrame:
    """Conversations rebuilt as branches: `conv`, `part`, `place`, `token`, `size`.

    Conversation c begins with the first h turns (part 0) of conversation
    c - c % `block`, h being the CRC-32 of its decimal id modulo `heads`, and
    goes on with its own turns after its first h (part 1).
    """
    cut = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    own = placed.filter(F.col("place") >= cut).select("conv", F.lit(1).alias("part"), "place", "token", "size")
    # A conversation that lends its beginning gives at most heads - 1 turns to fewer than 2 * block others.
    lent = placed.filter((F.col("conv") % block == 0) & (F.col("place") < heads - 1)).select(
        F.col("conv").alias("base"), "place", "token", "size"
    )
    takers = placed.select("conv").distinct().withColumns({"base": F.col("conv") - F.col("conv") % block, "cut": cut})
    taken = takers.join(lent, "base").filter("place < cut").select("conv", F.lit(0).alias("part"), "place", "token", "size")
    return materialize(own.unionByName(taken), "trie-branches")


def _sums(window: Window) -> dict[str, Column]:
    return {"a": F.bit_xor("xa").over(window), "b": F.bit_xor("xb").over(window), "so_far": F.sum("size").over(window)}


def _steps(spark: SparkSession, turns: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per turn of each distinct sequence, with the keys of its node and of the node above; the ends of all.

    A node's key is the exclusive or of 128 hashed bits of its turns' depth and
    token, so it is summed up like a running total: inside slices of a
    conversation, then over the slices, and no conversation has to fit in one task.
    """
    deep = distributed_row_number(turns, ["conv"], [F.col("part").asc(), F.col("place").asc()], "depth")
    keyed = deep.select(
        "conv", "depth", "size", F.xxhash64(F.lit(1), "depth", "token").alias("xa"), F.xxhash64(F.lit(2), "token", "depth").alias("xb")
    )
    sliced = materialize(keyed.repartitionByRange("conv", "depth").withColumn("slice", F.spark_partition_id()), "trie-turns")

    # One row per slice of a conversation: what came before it, and the whole conversation's key, length and size.
    earlier = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv")
    runs = sliced.groupBy("conv", "slice").agg(
        F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb"), F.sum("size").alias("size"), F.max("depth").alias("last")
    )
    before = {f"before_{k}": v for k, v in _sums(earlier).items()}
    total = {f"total_{k}": v for k, v in _sums(whole).items()}
    runs = runs.withColumns({**before, **total, "length": F.max("last").over(whole)}).fillna(0)
    runs = materialize(runs.drop("xa", "xb", "size", "last"), "trie-slices")

    turnless = ids.join(runs.select("conv"), "conv", "left_anti")
    finals = runs.select("conv", F.col("total_a").alias("a"), F.col("total_b").alias("b")).distinct().unionByName(
        turnless.select("conv", F.expr(f"{_ROOT} AS a"), F.expr(f"{_ROOT} AS b"))
    )
    ends = _ends(spark, finals)
    # Conversations of equal turns go on as one, the one with the smallest id.
    kept = runs.join(ends.select(F.col("first").alias("conv"), "n_ends", "ends_sha256"), "conv")
    kept = kept.select(*[F.col(c).alias(f"_{c}") for c in kept.columns])
    steps = sliced.join(kept, (F.col("conv") == F.col("_conv")) & (F.col("slice") == F.col("_slice")))
    local = Window.partitionBy("conv", "slice").orderBy("depth")
    steps = steps.withColumns(_sums(local)).select(
        "conv", "depth", "size", F.expr("a ^ _before_a").alias("a"), F.expr("b ^ _before_b").alias("b"),
        (F.col("so_far") + F.col("_before_so_far")).alias("so_far"), "xa", "xb",
        F.col("_length").alias("length"), F.col("_total_so_far").alias("total"), F.col("_n_ends").alias("n_ends"),
        F.when(F.col("depth") == F.col("_length"), F.col("_ends_sha256")).alias("ends_sha256"),
    )
    return steps.withColumns({"up_a": F.expr("a ^ xa"), "up_b": F.expr("b ^ xb")}).drop("xa", "xb"), ends


def _ends(spark: SparkSession, finals: DataFrame) -> DataFrame:
    """Per node at which conversations end: how many, the smallest id, and the digest of all ids in order."""
    numbered = distributed_row_number(finals, ["a", "b"], [F.col("conv").asc()], "k")
    piece = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv")), lambda i: i.cast("string")))
    pieces = numbered.groupBy("a", "b", F.floor((F.col("k") - 1) / PIECE).alias("piece")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("first"), piece.alias("ids")
    )
    pieces = materialize(pieces, "trie-ends")
    ends = pieces.groupBy("a", "b").agg(
        F.sum("n").alias("n_ends"), F.min("first").alias("first"), F.max("piece").alias("pieces"), F.max("ids").alias("ids")
    )
    several = pieces.join(ends.filter("pieces > 0").select("a", "b"), ["a", "b"], "left_semi")
    whole = several.repartition("a", "b").sortWithinPartitions("a", "b", "piece").select("a", "b", "ids").mapInArrow(
        _digest_pieces, "a long, b long, whole string"
    )
    ends = ends.join(whole, ["a", "b"], "left").withColumn("ends_sha256", F.coalesce("whole", F.sha2("ids", 256)))
    return materialize(ends.select("a", "b", "n_ends", "first", "ends_sha256"), "trie-ended")


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces, which come one after another; only the digest's state is held."""
    node, digest = None, None
    for batch in batches:
        done = []
        for a, b, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (a, b) != node:
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (a, b), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _DIGESTS)], schema=_DIGESTS)
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*node, digest.hexdigest()), _DIGESTS)], schema=_DIGESTS)


_SURVIVOR = ["depth", "a", "b", "up_a", "up_b", "size", "n_convs", "conv", "n_children", "n_leaves", "saved", "ends_sha256"]


def _peel(spark: SparkSession, arrivals: DataFrame, deepest: int) -> DataFrame:
    """Nodes of the shared part, level by level from the deepest.

    At each depth the conversations that end there and the tails that begin
    below it meet the survivors from one level deeper, which have lost their
    last turn; grouped by what is left, they are the nodes of this depth and
    the survivors of the next.
    """
    path = scratch_path(spark, "trie-levels")
    survivors = None
    schema = None
    for depth in range(deepest, -1, -1):
        level = arrivals.filter(F.col("depth") == depth)
        if survivors is not None:
            level = level.unionByName(survivors)
        nodes = level.groupBy("depth", "a", "b").agg(
            F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"), F.coalesce(F.max("size"), F.lit(0)).alias("size"),
            F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"), F.sum("n_children").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("ends_sha256").alias("ends_sha256"),
        )
        nodes = nodes.withColumns({
            "n_leaves": F.greatest("n_leaves", F.lit(1).cast("long")),
            "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("size"),
        }).filter("n_convs > 0")
        schema = nodes.schema
        nodes.write.parquet(f"{path}/level={depth}")
        stored = spark.read.schema(schema).parquet(f"{path}/level={depth}")
        survivors = stored.select(
            (F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"),
            F.lit(None).cast("long").alias("up_a"), F.lit(None).cast("long").alias("up_b"), F.lit(None).cast("long").alias("size"),
            "n_convs", "conv", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved", F.lit(None).cast("string").alias("ends_sha256"),
        )
    return spark.read.schema(schema).parquet(*[f"{path}/level={d}" for d in range(deepest + 1)])


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per distinct beginning of conversations: the root and every node of their trie.

    `turns` has `conv`, `part`, `place` (their order), `token` and `size`;
    `ids` has every `conv`, with turns or without. The result has `conv_id`
    (smallest member), `depth`, `parent_conv_id`, `n_convs`, `n_children`,
    `n_leaves`, `saved_tokens` and `ends_sha256`.

    Conversations of equal turns are one sequence that ends as often as they
    are. A turn that only one sequence has is a node of a chain without
    branches: these tails are peeled in closed form from running sums, and
    enter the peeling where they leave the shared part. It descends from the
    deepest turn that two different sequences share, one grouping for each depth.

    Ids are distinct by definition; rows that repeat one conversation's turn
    are further turns of it. Turnless conversations end at the root. Null ids
    do not occur (`slim_turns` leaves them out). Without conversations there is
    no node, not even the root.
    """
    spark = turns.sparkSession
    steps, ends = _steps(spark, turns, ids)
    first = [F.first(c).alias(c) for c in ("up_a", "up_b", "size", "so_far", "length", "total")]
    ended = F.when(F.col("depth") == F.col("length"), F.col("n_ends"))
    met = steps.groupBy("depth", "a", "b").agg(
        F.count(F.lit(1)).alias("sequences"), *first, F.first("n_ends").alias("n_ends"), F.min("conv").alias("conv"),
        F.coalesce(F.sum(ended), F.lit(0)).alias("ended"), F.min(F.when(F.col("depth") == F.col("length"), F.col("conv"))).alias("end_conv"),
        F.max("ends_sha256").alias("ends_sha256"),
    )
    met = materialize(met, "trie-nodes")
    zero, one, none = F.lit(0).cast("long"), F.lit(1).cast("long"), F.lit(None).cast("long")
    tails = met.filter("sequences = 1").withColumns({
        "n_convs": F.col("n_ends"), "n_children": (F.col("depth") < F.col("length")).cast("long"), "n_leaves": one,
        "saved": (F.col("n_ends") - 1) * (F.col("total") - F.col("so_far") + F.col("size")),
    })
    shared = met.filter("sequences > 1").select(
        "depth", "a", "b", "up_a", "up_b", "size", F.col("ended").alias("n_convs"), F.col("end_conv").alias("conv"),
        zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved"), "ends_sha256",
    )
    tops = tails.groupBy("conv").agg(F.min_by(F.struct("depth", "up_a", "up_b", "n_convs", "saved"), "depth").alias("t"))
    tops = tops.select(
        (F.col("t.depth") - 1).alias("depth"), F.col("t.up_a").alias("a"), F.col("t.up_b").alias("b"), none.alias("up_a"), none.alias("up_b"),
        none.alias("size"), F.col("t.n_convs").alias("n_convs"), "conv", one.alias("n_children"), one.alias("n_leaves"),
        F.col("t.saved").alias("saved"), F.lit(None).cast("string").alias("ends_sha256"),
    )
    at_root = ends.filter("a = 0 AND b = 0").select(
        zero.alias("depth"), "a", "b", none.alias("up_a"), none.alias("up_b"), none.alias("size"), F.col("n_ends").alias("n_convs"),
        F.col("first").alias("conv"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved"), "ends_sha256",
    )
    parts = [p.withColumn("depth", F.col("depth").cast("long")).select(*_SURVIVOR) for p in (shared, tops, at_root)]
    arrivals = materialize(reduce(DataFrame.unionByName, parts).repartitionByRange("depth", "a", "b"), "trie-arrivals")
    deepest = arrivals.agg(F.max("depth")).first()[0] or 0
    peeled = _peel(spark, arrivals, deepest)

    columns = ["depth", "a", "b", "up_a", "up_b", "n_convs", "conv", "n_children", "n_leaves", "saved", "ends_sha256"]
    nodes = peeled.select(*columns).unionByName(tails.withColumn("depth", F.col("depth").cast("long")).select(*columns))
    # A node's children may be most of all nodes: they meet it in SALTS groups.
    above = peeled.select(
        F.col("a").alias("p_a"), F.col("b").alias("p_b"), F.col("conv").alias("above"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("p_salt")
    )
    salted = nodes.withColumn("salt", F.pmod(F.xxhash64("a", "b"), F.lit(SALTS)).cast("int"))
    found = salted.join(above, F.expr("up_a = p_a AND up_b = p_b AND salt = p_salt"), "left")
    return found.select(
        F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    rebuild: bool = False,
) -> DataFrame:
    """The trie of whole conversations (see `prefix_trie`), rebuilt as branches first if asked for (see `branched`).

    Rows without a conversation id are left out; null turns come first; turns
    of one number are ordered by a digest of role and text, so that equal
    tables give equal tries. Other columns are ignored.
    """
    placed = materialize(in_order(slim_turns(conversations, id_col, turn_col, role_col, text_col)), "trie-placed")
    turns = branched(placed) if rebuild else placed.select("conv", F.lit(1).alias("part"), "place", "token", "size")
    return prefix_trie(turns, placed.select("conv").distinct())

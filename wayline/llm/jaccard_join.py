"""Exact Jaccard join on word shingles, answered as components of linked documents.

Two documents link when their shingle sets have a Jaccard similarity of at
least 3/4. Equal sets are one node. Nodes meet on the rarest quarter of their
shingles. Work is skipped in two ways: the list of a shingle is cut into blocks
by set size, and a set visits only the blocks that its position in the list
allows; and each set is first compared with one pivot per block, whose answer
settles or rules out most of the others: what the pivot's component holds needs
no further link, and what lies too far from the pivot, while the set lies close
to it, cannot be linked with the set.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wayline.llm.common import record, small_batches, texts_as_bytes, two_columns, word_slices
from wayline.llm.components import connected_components
from wayline.session import materialize, union_rows

SHINGLE = 5
#: Shingles known to be frequent, whose sets put them last. Their number is bounded, so a task can hold them; which
#: they are only decides how much work there is, not the result.
MAX_FREQUENT = 1 << 19
MIN_FREQUENT = 8
#: Shingles that are counted, and sent, at once, and expected in one bucket.
_FLUSH, _PER_BUCKET, _BYTES_PER_WORD = 1 << 21, 1 << 20, 6
#: How often lists that still hold several components are tried with members of their largest one, and with how many.
ROUNDS, DRAWS = 4, 8
_FILTER_BITS = 1 << 23
#: Size of the filter of shingles that more than one set has: two bits are set for each, whatever their number.
REPEAT_BITS = 1 << 27
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit codes of a text's word shingles.

    A-Z are lower-cased, words stand between ASCII blanks; fewer words than
    `size` make one shingle of all; no words make none.
    """
    codes = [np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)) for w in (p.split() for p in word_slices(text.lower()))]
    words = np.concatenate(codes)
    width = min(size, len(words))
    if not width:
        return words
    with np.errstate(over="ignore"):
        h = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            h = (h ^ (h >> np.uint64(29))) * _P + words[k : len(words) - width + 1 + k]
        h = (h ^ (h >> np.uint64(32))) * _Q
        return np.unique(h ^ (h >> np.uint64(31)))


def node_of(shingles: np.ndarray) -> int:
    """64-bit code of a set, the same for equal sets."""
    with np.errstate(over="ignore"):
        mixed = (shingles ^ (shingles >> np.uint64(30))) * _Q
        return int(((mixed ^ (mixed >> np.uint64(27))) * _P).sum(dtype=np.uint64).astype(np.int64))


def _sets(batches: Iterator[pa.RecordBatch], once: bool) -> Iterator[tuple[int | None, np.ndarray, int]]:
    """Id, shingles and node of every row; with `once` each node a single time per task, and no empty sets."""
    seen = set()
    for batch in small_batches(batches):
        for id_, text in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1))):
            shingles = shingle_set(text)
            node = node_of(shingles)
            if once:
                if node in seen or not len(shingles):
                    continue
                seen.add(node)
            yield id_, shingles, node


class Counts(NamedTuple):
    """What the order of shingles is built on: 0 for those of one set, 1 for repeated ones, counts of the most frequent.

    It is a function of the shingle alone, the same in all tasks. A filter
    that is too small calls more shingles repeated; results stay the same.
    """

    bits: int
    codes: np.ndarray
    dfs: np.ndarray
    field: np.ndarray

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        own = shingles >> np.uint64(32 - self.bits)
        df = np.ones(len(own), np.int64)
        for p in _repeat_places(own, self.bits):
            df &= self.field[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1
        if len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
            hit = self.codes[at] == own
            df[hit] = self.dfs[at[hit]]
        return df


def _repeat_places(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two bits of a shingle in the part of the filter that belongs to its bucket."""
    part = np.uint64(REPEAT_BITS >> bits)
    with np.errstate(over="ignore"):
        mixed = codes * _P
    return [(codes >> np.uint64(32)) * part + (mixed >> np.uint64(s)) % part for s in (11, 35)]


_FIRST = "id long, n long, node long, bucket int, rest binary, times binary"


def _first_pass(rows: DataFrame, bits: int) -> DataFrame:
    """Two kinds of rows from one reading: `id`, `n` (shingles) and `node` of every row; and counted shingles.

    Shingles are told apart by their first `bits + 32` bits. Every task counts
    its own, each distinct set once, before it sends them, 4 bytes each, to as
    many buckets as the data need; `bucket` is null for the other kind.
    """
    out = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("bucket", pa.int32()), ("rest", pa.binary()), ("times", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for batch in small_batches(batches):
            ids, ns, nodes = [], [], []
            for id_, shingles, node in _sets(iter([batch]), False):
                ids.append(id_)
                ns.append(len(shingles))
                nodes.append(node)
                if node not in seen and len(shingles):
                    seen.add(node)
                    held.append(shingles >> np.uint64(32 - bits))
                    size += len(shingles)
            none = [None] * len(ids)
            yield record(out, (ids, ns, nodes, none, none, none))
            if size >= _FLUSH:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        codes, times = np.unique(np.concatenate(held), return_counts=True)
        buckets = (codes >> np.uint64(32)).astype(np.int32)
        cuts = np.flatnonzero(np.diff(buckets, prepend=-1))
        ends = np.append(cuts[1:], len(codes))
        rest, times = codes.astype("<u4"), times.astype("<u4")
        parts = [rest[a:b].tobytes() for a, b in zip(cuts, ends)], [times[a:b].tobytes() for a, b in zip(cuts, ends)]
        none = [None] * len(cuts)
        return record(out, (none, none, none, buckets[cuts], *parts))

    return materialize(rows.mapInArrow(run, _FIRST), "jaccard-first")


def _count(counted: DataFrame, bits: int) -> Counts:
    """Counts of all shingles from the counts of the tasks."""
    result = pa.schema([("code", pa.int64()), ("df", pa.int64()), ("part", pa.binary())])
    size = REPEAT_BITS >> bits

    def fold(bucket: pa.Table) -> pa.Table:
        rest = np.frombuffer(b"".join(bucket["rest"].to_pylist()), "<u4")
        times = np.frombuffer(b"".join(bucket["times"].to_pylist()), "<u4")
        order = np.argsort(rest, kind="stable")
        starts = np.flatnonzero(np.diff(rest[order].astype(np.int64), prepend=-1))
        df = np.add.reduceat(times[order].astype(np.int64), starts)
        bucket_code = bucket["bucket"][0].as_py()
        codes = rest[order][starts].astype(np.uint64) | np.uint64(bucket_code << 32)
        part = np.zeros(size, bool)
        for p in _repeat_places(codes[df > 1], bits):
            part[p.astype(np.int64) - bucket_code * size] = True
        keep = df >= MIN_FREQUENT
        names = pa.array([*codes[keep].astype(np.int64).tolist(), bucket_code])
        parts = pa.array([None] * int(keep.sum()) + [np.packbits(part, bitorder="little").tobytes()], pa.binary())
        return pa.table([names, pa.array([*df[keep].tolist(), 0]), parts], schema=result)

    counts = counted.filter("bucket IS NOT NULL").select("bucket", "rest", "times")
    found = materialize(counts.groupBy("bucket").applyInArrow(fold, "code long, df long, part binary"), "jaccard-counts")
    field = np.zeros(REPEAT_BITS >> 3, np.uint8)
    for r in found.filter("df = 0").toLocalIterator():
        field[r["code"] * (size >> 3) : (r["code"] + 1) * (size >> 3)] = np.frombuffer(r["part"], np.uint8)
    # The least count that leaves at most MAX_FREQUENT shingles, from a histogram with a few hundred bars.
    found = found.filter("df > 0").select("code", "df")
    level = F.floor(F.log2("df") * 8)
    bars = found.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, room = None, MAX_FREQUENT
    for r in sorted(bars, reverse=True):
        room -= r["n"]
        if room < 0:
            break
        least = r["level"]
    if least is None:
        return Counts(bits, np.empty(0, np.uint64), np.empty(0, np.int64), field)
    table = found.filter(level >= least).toPandas().sort_values("code")
    return Counts(bits, table["code"].to_numpy().astype(np.uint64), table["df"].to_numpy(), field)


def _prefix(shingles: np.ndarray, counts: Counts) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of a set, one of which any linked set must share, and their counts."""
    n = len(shingles)
    df = counts(shingles)
    order = np.argsort(df, kind="stable")[: n - (3 * n + 3) // 4 + 1]  # equal counts stay in order of the code
    return shingles[order], df[order]


def _entries(rows: DataFrame, counts: Counts) -> DataFrame:
    """Inverted lists: `token`, `node`, `n` (set size), `pos` (place in the set's order).

    Shingles of one set meet nothing and are not sent.
    """
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for _, shingles, node in _sets(batches, True):
            tokens, df = _prefix(shingles, counts)
            at = np.flatnonzero(df)
            if len(at):
                tokens = (tokens[at] >> np.uint64(32 - counts.bits)).astype(np.int64)
                held.append((tokens, np.full(len(at), node), np.full(len(at), len(shingles), np.int32), at.astype(np.int32)))
            if len(held) == 256:
                yield record(schema, [np.concatenate(c) for c in zip(*held)])
                held = []
        if held:
            yield record(schema, [np.concatenate(c) for c in zip(*held)])

    return rows.mapInArrow(run, "token long, node long, n int, pos int").distinct()


def _block(n: Column) -> Column:
    """Size class: linked sets lie in one class or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(4 / 3)) + 1e-9).cast("int")


def _most(n: str, pos: str) -> Column:
    """The largest set that can be linked with one of size `n` whose first shared shingle stands at `pos`."""
    return F.floor(((F.col(n) - F.col(pos)) * 7 - 3 * F.col(n)) / 3 + 1e-9).cast("int")


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds `shared`, the size of the intersection, to pairs of nodes `a`, `b`.

    The pairs are stored, so that their size is known: where they are few, only
    the sets that they need leave the stored ones.
    """
    pairs = materialize(pairs, "jaccard-pairs")
    wanted = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "jaccard-wanted")
    sets = sets.join(wanted, "node", "left_semi")
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    return both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("shared"))


_LINKED = "100L * shared >= 75L * (na + nb - shared)"


def _shingles_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """`node`, `shingles` of the nodes given. A small filter of them keeps most other sets from being sent."""
    bits = int(log2(_FILTER_BITS))

    def places(codes: np.ndarray) -> list[np.ndarray]:
        codes = codes.astype(np.int64).view(np.uint64)
        return [(codes >> np.uint64(s)) & np.uint64(_FILTER_BITS - 1) for s in (0, 20, 64 - bits)]

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.zeros(_FILTER_BITS, bool)
        for batch in batches:
            for p in places(batch.column(0).to_numpy()):
                field[p] = True
        words = np.packbits(field).view(">i8").astype(np.int64)
        at = np.flatnonzero(words)
        yield record(pa.schema([("word", pa.int32()), ("mask", pa.int64())]), (at, words[at]))

    words = np.zeros(_FILTER_BITS // 64, np.int64)
    for r in nodes.mapInArrow(marks, "word int, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).collect():
        words[r["word"]] = r["mask"]
    field = words.astype(">i8").view(np.uint8)
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(field).view(bool)
        held: list[tuple] = []
        for _, shingles, node in _sets(batches, True):
            if all(known[p][0] for p in places(np.array([node]))):
                held.append((node, shingles.view(np.int64)))
            if len(held) == 64:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    def packed(held: list[tuple]) -> pa.RecordBatch:
        ends = np.cumsum([0, *(len(h) for _, h in held)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(ends, np.concatenate([h for _, h in held]))
        return pa.RecordBatch.from_arrays([pa.array([n for n, _ in held], pa.int64()), lists], schema=schema)

    met = rows.mapInArrow(run, "node long, shingles array<long>").join(nodes, "node", "left_semi")
    return met.groupBy("node").agg(F.first("shingles").alias("shingles"))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`id`, `n` (distinct shingles) and `component` (smallest id reachable by links) of every document.

    Null texts count as empty; a text without words has no shingles, is linked
    with nothing and is its own component. Repeated rows are kept, one result
    row each. Null ids are allowed: they link like others, and a component is
    named after its smallest id, null only if it has no other. Further columns
    are ignored, whatever their names. Empty tables give empty results.
    """
    rows = two_columns(docs, id_col, text_col)
    # About as many shingles as words; this only sizes the buckets in which they are counted.
    total = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / _BYTES_PER_WORD
    bits = min(24, max(4, int(log2(max(1, total / _PER_BUCKET)) + 1)))
    first = _first_pass(rows, bits)
    nodes = first.filter("bucket IS NULL").select("id", "n", "node")
    entries = materialize(_entries(rows, _count(first, bits)), "jaccard-lists")
    links, seeds = _links(rows, entries)
    roots = connected_components(links, seeds)
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = named.withColumn("lone", F.col("n") == 0)
    least = named.filter("NOT lone").groupBy("root").agg(F.min("id").alias("least"))
    found = named.filter("NOT lone").join(least, "root").select("id", "n", F.col("least").alias("component"))
    return union_rows(found, named.filter("lone").select("id", "n", F.col("id").alias("component")))


def _near(met: DataFrame) -> DataFrame:
    """Distinct pairs of a node `a` and a pivot `b` whose sizes and positions allow a link."""
    near = (F.col("pn") >= F.ceil(F.col("n") * 0.75 - 1e-9)) & (F.col("n") >= F.ceil(F.col("pn") * 0.75 - 1e-9))
    near = near & (F.col("pn") <= F.col("most")) & (F.col("n") <= _most("pn", "ppos"))
    return met.filter(near & (F.col("node") != F.col("pivot"))).select(
        F.col("node").alias("a"), F.col("pivot").alias("b"), F.col("n").alias("na"), F.col("pn").alias("nb")
    ).distinct()


def _open_lists(placed: DataFrame) -> DataFrame:
    """`token`, `main`, `size`: lists with several components, the one that most of their nodes are in, and how many those are."""
    members = placed.filter("own = block").groupBy("token", "root").agg(F.count(F.lit(1)).alias("k"))
    lists = members.groupBy("token").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.max("k").alias("size"), F.count(F.lit(1)).alias("roots"))
    return lists.filter("roots > 1").select("token", "main", "size")


def _links(rows: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links enough to connect every component, and the components that the first of them give."""
    listed = entries.withColumn("block", _block(F.col("n")))
    pivots = listed.groupBy("token", "block").agg(F.min(F.struct("n", "node", "pos")).alias("p"))
    pivots = materialize(pivots.select("token", "block", "p.*").toDF("token", "block", "pn", "pivot", "ppos"), "jaccard-pivots")
    # The blocks of a list that a set's position lets it visit: no smaller ones than its own size allows, no larger
    # ones than its first shared shingle allows. Its own block is always one of them, even where only smaller sets can
    # be linked with it: there it is a member of the list that others meet.
    least = F.ceil(F.col("n") * 0.75 - 1e-9).cast("int")
    visits = listed.withColumn("most", _most("n", "pos")).filter(F.col("most") >= least).withColumnRenamed("block", "own")
    visits = visits.withColumn("block", F.explode(F.sequence(_block(least), _block(F.greatest("most", "n")))))
    star = _near(visits.join(pivots, ["token", "block"]))
    sets = materialize(_shingles_of(rows, entries.select("node").distinct()), "jaccard-sets")
    compared = materialize(_overlaps(star, sets), "jaccard-star")
    first = compared.filter(_LINKED).select("a", "b")
    roots = connected_components(first)

    # Again with other pivots, drawn by shingle: a set that is still apart from others in its lists is compared with
    # about as many of them as it has lists, instead of with all. The first time any member is drawn, later one of the
    # list's largest component, for the sets outside it: of a large group's many members a set at its edge is linked
    # with some, and as soon as one of them is drawn all other pairs between the two components go.
    rooted = lambda df: df.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Short lists are left to the exact comparisons at the end, which cost no more there.
    placed = visits
    for k in range(1 + ROUNDS):
        placed = materialize(rooted(placed), "jaccard-placed")
        open_ = placed.join(_open_lists(placed), "token")
        members = open_.filter("own = block")
        if k:
            open_ = open_.filter(F.col("size") > 4 * DRAWS)
            members = open_.filter("own = block AND root = main")
        share = F.pmod(F.xxhash64("node", F.lit(k)), F.lit(DRAWS if k else 1))
        drawn = members.groupBy("token", "block", share).agg(
            F.min_by(F.struct("n", "node", "pos", "root"), F.xxhash64("token", "node", F.lit(k))).alias("p")
        ).select("token", "block", "p.*").toDF("token", "block", "pn", "pivot", "ppos", "proot")
        again = _near(open_.join(drawn, ["token", "block"]).filter("root <> proot"))
        more = materialize(_overlaps(again, sets).filter(_LINKED).select("a", "b"), "jaccard-again")
        if not k:  # lists that are closed by now stay closed
            placed = open_.drop("main", "size")
        placed = placed.drop("root")
        if more.isEmpty():
            break
        roots = connected_components(more, roots)
        first = union_rows(first, more)

    # Lists whose nodes are not all in one component yet. In each, the largest component needs no pairs of its own.
    placed = rooted(placed)
    placed = materialize(placed.join(_open_lists(placed), "token").join(pivots.select("token", "block", "pivot"), ["token", "block"]), "jaccard-placed")
    shared = compared.select(F.col("a").alias("node"), F.col("b").alias("pivot"), (1 - F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("far"))
    placed = placed.join(shared, ["node", "pivot"], "left").withColumn("far", F.when(F.col("node") == F.col("pivot"), 0.0).otherwise(F.col("far")))
    x = placed.filter("root <> main").alias("x")
    y = placed.filter("own = block").alias("y")
    apart = F.coalesce(F.abs(F.col("x.far") - F.col("y.far")) > 0.25 + 1e-9, F.lit(False))
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.block") == F.col("y.block")) & F.expr(
        "x.root <> y.root AND y.n <= x.most AND x.n <= y.most AND 4 * y.n >= 3 * x.n AND 4 * x.n >= 3 * y.n"
    ) & ~apart)
    swap = F.col("x.node") > F.col("y.node")
    pick = lambda c: (F.when(swap, F.col(f"y.{c}")).otherwise(F.col(f"x.{c}")), F.when(swap, F.col(f"x.{c}")).otherwise(F.col(f"y.{c}")))
    (a, b), (na, nb) = pick("node"), pick("n")
    rest = pairs.select(a.alias("a"), b.alias("b"), na.alias("na"), nb.alias("nb")).distinct()
    more = materialize(_overlaps(rest, sets).filter(_LINKED).select("a", "b"), "jaccard-rest")
    return union_rows(first, more), roots

"""Collocations of two and three words from a weighted de Bruijn graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from wayline.llm.common import SLICE_BYTES, small_batches, texts_as_bytes
from wayline.operators.ordering import distributed_row_number, top_n_per_group
from wayline.session import materialize

#: Words that a worker remembers before it hands its part of the graph on; 20 bits number them.
MAX_WORDS = (1 << 20) - 1
FLUSH_WORDS = MAX_WORDS // 2
#: Places of words that are folded into edges at once.
PLACES = 1 << 20
#: Nodes of one word meet its count in so many groups, however many they are.
SALTS = 16
# Fixed value: the characters that end a piece.
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(10 if c in _PIECE_ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_END = b"\xff"  # no byte of UTF-8
_EDGES = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("w3", pa.int64()), ("n", pa.int64()), ("word", pa.string())])
_GRAPH = pa.schema([*_EDGES, ("compact", pa.bool_())])


def _code(lang: bytes, word: bytes) -> int:
    """64 bits that stand for a word of a language; 0 is kept for the end of a piece."""
    return (xxhash.xxh64_intdigest(lang + b" " + word) or 1) - (1 << 63) or 1


class _Words(dict):
    """Numbers of one language's words, given as they are met."""

    def __init__(self, lang: bytes, owner: _LocalGraph):
        super().__init__({_END: 0})
        self.lang, self.owner = lang, owner

    def __missing__(self, word: bytes) -> int:
        number = len(self.owner.codes)
        self.owner.codes.append(_code(self.lang, word))
        self.owner.names.append(self.lang + b" " + word)
        self[word] = number
        return number


class _LocalGraph:
    """The graph of the texts that one task has read so far.

    Nodes are pairs of words, edges the triples that lead from one pair to the
    next; a piece that ends leads to the end. What leaves a word's pairs, with
    the pieces that end with it, is its count.
    """

    def __init__(self):
        self.clear()
        self.places: list[np.ndarray] = []
        self.waiting = 0

    def clear(self) -> None:
        self.codes, self.names, self.words = [0], [b""], {}
        self.totals = np.zeros(0, np.int64)

    def add(self, lang: bytes, text: bytes) -> Iterator[pa.RecordBatch]:
        if len(self.codes) > FLUSH_WORDS:
            yield from self.flush()
        start, end = 0, len(text)
        text = text.translate(_TABLE)
        while start < end:
            stop = min(start + SLICE_BYTES, end)
            if stop < end:  # a word is never cut
                stop = next((i for i in (text.find(b" ", stop), text.find(b"\n", stop)) if i >= 0), end)
            words = self.words.get(lang)
            if words is None:
                words = self.words[lang] = _Words(lang, self)
            tokens = text[start:stop].replace(b"\n", b" \xff ").split()
            self.places.append(np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens)))
            self.waiting += len(tokens)
            start = stop
            if self.waiting >= PLACES:
                # The last two places lead to words that are still to come.
                yield from self.edges(self.rest(start < end))
            if start < end and len(self.codes) > FLUSH_WORDS:
                yield from self.flush(inside=True)
        self.places.append(np.zeros(2, np.int64))
        self.waiting += 2

    def rest(self, inside: bool) -> np.ndarray:
        places = np.concatenate([*self.places, np.zeros(0 if inside else 2, np.int64)])
        kept = places[-2:] if inside else places[:0]
        self.places, self.waiting = [kept], len(kept)
        return places

    def edges(self, places: np.ndarray) -> Iterator[pa.RecordBatch]:
        first, second, third = places[:-2], places[1:-1], places[2:]
        found = first > 0
        keys = (first[found] << 40) | (second[found] << 20) | np.where(second[found] > 0, third[found], 0)
        keys, counts = np.unique(keys, return_counts=True)
        start = keys >> 40
        # What leaves the nodes that begin with a word is the word's count.
        totals = np.bincount(start, counts, len(self.codes)).astype(np.int64)
        totals[: len(self.totals)] += self.totals
        self.totals = totals
        keep = (keys >> 20) & MAX_WORDS > 0  # a single last word is in its count only
        keys, counts = keys[keep], counts[keep]
        codes = np.array(self.codes, np.int64)
        if len(keys):
            columns = [codes[keys >> 40], codes[(keys >> 20) & MAX_WORDS], codes[keys & MAX_WORDS], counts.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(keys), pa.string())], schema=_EDGES)

    def flush(self, inside: bool = False) -> Iterator[pa.RecordBatch]:
        """All that is left of the graph, with its words and their counts; then it is empty."""
        tail: list[bytes] = []
        if sum(map(len, self.places)):
            places = self.rest(inside)
            yield from self.edges(places)
            if inside:
                tail = [self.names[i] for i in places[-2:].tolist()]
        totals = np.zeros(len(self.codes), np.int64)
        totals[: len(self.totals)] = self.totals
        met = np.flatnonzero(totals)
        if len(met):
            names, codes, counts = [self.names[i] for i in met.tolist()], np.array(self.codes, np.int64)[met].tolist(), totals[met].tolist()
            for lang, words in self.words.items():  # the empty word stands for all words of a language
                numbers = np.fromiter(words.values(), np.int64, len(words))
                names.append(lang + b" ")
                codes.append(_code(lang, b""))
                counts.append(int(totals[numbers[numbers > 0]].sum()))
            names = pa.array(names, pa.binary()).cast(pa.string())
            zero = np.zeros(len(names), np.int64)
            columns = [np.array(codes, np.int64), zero, zero, np.array(counts, np.int64)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), names], schema=_EDGES)
        self.clear()
        if inside:  # the two places that a text goes on from, numbered anew
            numbers = []
            for name in tail:
                lang, _, word = name.rpartition(b" ")
                numbers.append(self.words.setdefault(lang, _Words(lang, self))[word] if name else 0)
            self.places, self.waiting = [np.array(numbers, np.int64)], 2


def _local_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    graph = _LocalGraph()
    for batch in small_batches(batches):
        for lang, text in zip(texts_as_bytes(batch.column(0)), texts_as_bytes(batch.column(1))):
            yield from graph.add(lang, text)
    yield from graph.flush()


def _fold(min_count: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nodes and edges of the whole graph from rows in order of node and edge.

        Only the last edge and what has left its node so far are carried from
        batch to batch. Rare nodes and edges end here. A node whose flow leaves
        by one edge is compacted into it (`compact`): the edge has its count.
        """
        last = None  # (w1, w2, w3, n, word) of the edge that may go on
        flow, ways = 0, 0  # of the last edge's node, without that edge
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]]
            words = batch.column(4)
            if last is not None:
                columns = [np.concatenate([[v], c]) for v, c in zip(last[:4], columns)]
                words = pa.concat_arrays([pa.array([last[4]], pa.string()), words])
            yield from fold_part(columns, words, flow, ways, final=False)
            flow, ways, last = carried(columns, words, flow, ways)
        if last is not None:
            yield from fold_part([np.array([v], np.int64) for v in last[:4]], pa.array([last[4]], pa.string()), flow, ways, final=True)

    def bounds(columns):
        w1, w2, w3, n = columns
        node = np.flatnonzero(np.concatenate([[True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])]))
        new = np.zeros(len(w1), bool)
        new[node] = True
        new[1:] |= w3[1:] != w3[:-1]
        edge = np.flatnonzero(new)
        return node, edge, np.add.reduceat(n, edge)

    def carried(columns, words, flow, ways):
        node, edge, n = bounds(columns)
        if len(node) > 1:
            flow, ways = 0, 0
        inside = edge >= node[-1]
        i = int(edge[-1])
        last = (*(int(c[i]) for c in columns[:3]), int(n[-1]), words[i].as_py())
        return flow + int(n[inside].sum()) - last[3], ways + int(inside.sum()) - 1, last

    def fold_part(columns, words, flow, ways, final):
        node, edge, n = bounds(columns)
        w1, w2, w3 = (c[edge] for c in columns[:3])
        first = np.searchsorted(edge, node)  # the first edge of each node
        total, count = np.add.reduceat(n, first), np.diff(np.append(first, len(edge)))
        total[0] += flow
        count[0] += ways
        whole = slice(None) if final else slice(0, -1)  # the last edge and the last node may go on
        single = np.repeat(count == 1, np.diff(np.append(first, len(edge))))[whole]
        frequent = np.flatnonzero((n[whole] >= min_count) & (w3[whole] != 0))
        named = words.take(pa.array(edge[first]))
        kept = (total >= min_count) | pc.ends_with(named, " ").fill_null(False).to_numpy(zero_copy_only=False)
        done = np.flatnonzero((kept & ((count > 1) | (w3[first] == 0)))[whole])
        out = [np.concatenate([a[frequent], b[first][done]]) for a, b in ((w1, w1), (w2, w2), (w3, np.zeros_like(w3)))]
        out.append(np.concatenate([n[frequent], total[done]]))
        names = pa.concat_arrays([pa.nulls(len(frequent), pa.string()), named.take(pa.array(done))])
        if len(names):
            compact = np.concatenate([single[frequent], np.zeros(len(done), bool)])
            yield pa.RecordBatch.from_arrays([*map(pa.array, out), names, pa.array(compact)], schema=_GRAPH)

    return fold


def _score(a: Column, l: Column, r: Column) -> Column:
    big = lambda c: c.cast("decimal(19,0)")
    top = big(a) * big(a) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, big(l) * big(r))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10, covered_percent: int = 50, top: int | None = 2_000,
) -> DataFrame:
    """`lang`, `rank`, `phrase`, `a`, `l`, `r`, `n` and `score`: the best phrases of two and three words of each language.

    A phrase counts where its words follow each other within a piece of text;
    it is a candidate from `min_count` occurrences on. Its score is the lowest
    over its cuts in two, 10^6 a^2 / (l r) rounded down, a, l and r being the
    counts of the whole and the two parts and the first such cut deciding;
    n counts all words of the language. Phrases within a longer
    candidate that occurs at least `covered_percent` as often are dropped. `top` limits each language's list, None keeps all.

    Every text gives edges from pair to pair of words; one shuffle brings the
    edges that leave a node together, and pairs take their counts from the flow
    through their node, ends of pieces included. Texts of any length are read in
    slices; null texts are empty, a null language is `und`, repeated rows
    count as often as they are there, other columns are ignored, and an empty
    table has no phrases. A language that the table names `und` is the same as null.
    """
    texts = docs.select(F.coalesce(docs[lang_col], F.lit("und")).alias("lang"), docs[text_col].alias("text")).filter("text IS NOT NULL")
    edges = texts.mapInArrow(_local_edges, "w1 long, w2 long, w3 long, n long, word string")
    ordered = edges.repartition("w1", "w2").sortWithinPartitions("w1", "w2", "w3")
    graph = materialize(ordered.mapInArrow(_fold(min_count), "w1 long, w2 long, w3 long, n long, word string, compact boolean"), "phrase-graph")

    word = F.substring_index("word", " ", -1)
    lang = F.expr("substring(word, 1, length(word) - length(substring_index(word, ' ', -1)) - 1)")
    words = graph.filter("w2 = 0").select(F.col("w1").alias("code"), lang.alias("lang"), word.alias("text"), "n")
    totals = materialize(words.filter("text = ''").select("lang", "n"), "phrase-totals")
    salted = words.filter("text != ''").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    of = lambda k: salted.select(
        F.col("code").alias(f"w{k}"), F.col("salt").alias(f"salt{k}"), F.col("n").alias(f"f{k}"), F.col("text").alias(f"t{k}"), F.col("lang").alias(f"lang{k}")
    )
    salt = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")
    pairs = graph.filter("compact OR w2 != 0 AND w3 = 0").select("w1", "w2", F.col("n").alias("f12"), salt("w2").alias("salt1"), salt("w1").alias("salt2"))
    pairs = pairs.join(of(1), ["w1", "salt1"]).join(of(2), ["w2", "salt2"])
    pairs = materialize(pairs.select("w1", "w2", "f12", "f1", "f2", "t1", "t2", F.col("lang1").alias("lang")), "phrase-pairs")

    triples = graph.filter("w3 != 0").select("w1", "w2", "w3", F.col("n").alias("a"))
    after = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f12").alias("f23"), F.col("f2").alias("f3"), F.col("t2").alias("t3"))
    longer = triples.select("w1", "w2", "a").union(triples.select("w2", "w3", "a")).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    two = pairs.join(longer, ["w1", "w2"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("f12"))
    ).select("lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), F.col("f12").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"))
    three = triples.join(pairs, ["w1", "w2"]).join(after, ["w2", "w3"])
    early, late = _score(F.col("a"), F.col("f1"), F.col("f23")), _score(F.col("a"), F.col("f12"), F.col("f3"))
    three = three.select(
        "lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a",
        F.when(late < early, F.struct(F.col("f12").alias("l"), F.col("f3").alias("r"))).otherwise(F.struct(F.col("f1").alias("l"), F.col("f23").alias("r"))).alias("cut"),
    ).select("lang", "phrase", "a", "cut.l", "cut.r")
    found = two.unionByName(three).withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is None:
        ranked = distributed_row_number(found, ["lang"], best, "rank")
    else:
        ranked = top_n_per_group(found, ["lang"], best, top, "rank")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""URL verdicts: a blocked Bloom filter passes possible hits on to an exact join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wayline.llm.common import ascii_lower

#: Blocks of 256 bits (four longs) in the filter: its size is fixed, 32 bytes each, whatever the list's length.
BLOCKS = 8192
_LANES = 4


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where there is no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(url)), "^[^?#]*", 0)
    return F.coalesce(ascii_lower(raw), F.lit("")), F.coalesce(path, F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """A URL without scheme, query and fragment."""
    return F.concat(host, path)


def _places(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key and its bit in each lane of that block."""
    bits = F.xxhash64(key, F.lit(1))
    return F.pmod(F.xxhash64(key), F.lit(blocks)), [
        F.shiftrightunsigned(bits, 6 * lane).bitwiseAND(F.lit(63)).cast("int") for lane in range(_LANES)
    ]


def bloom_filter(keys: DataFrame, key_col: str, blocks: int = BLOCKS) -> DataFrame:
    """One row `bits`: the filter of all keys as an array of `4 * blocks` longs. Null keys are left out."""
    key = F.col(key_col)
    block, bits = _places(key, blocks)
    one = F.lit(1).cast("long")
    masks = keys.filter(key.isNotNull()).groupBy(block.alias("block")).agg(*[
        F.bit_or(F.call_function("shiftleft", one, b)).alias(f"lane{i}") for i, b in enumerate(bits)
    ])
    zero = F.lit(0).cast("long")
    lanes = [F.coalesce(f"lane{i}", zero) for i in range(_LANES)]
    every = keys.sparkSession.range(0, blocks, 1, 1).withColumnRenamed("id", "block").join(masks, "block", "left")
    rows = every.agg(F.array_sort(F.collect_list(F.struct("block", F.array(*lanes).alias("lanes")))).alias("rows"))
    return rows.select(F.flatten(F.transform("rows", lambda r: r["lanes"])).alias("bits"))


def might_contain(key: Column, bits: Column, blocks: int = BLOCKS) -> Column:
    """False only where the key is certainly not among the filter's keys."""
    block, places = _places(key, blocks)
    one = F.lit(1).cast("long")
    found = F.lit(True)
    for lane, place in enumerate(places):
        word = F.get(bits, (block * _LANES + lane).cast("int"))
        found = found & (word.bitwiseAND(F.call_function("shiftleft", one, place)) != 0)
    return found


def url_verdicts(
    pages: DataFrame, rules: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
    default: str = "allow", blocks: int = BLOCKS,
) -> DataFrame:
    """`id`, `host`, `path`, `rule`, `verdict`, `listed` of every page.

    `rules` (host, path, verdict): fits its host and all subdomains where the
    path starts with the rule's; the longest wins, and of equal rules with two
    verdicts the later in the alphabet. `listed` (url): canonical URLs to
    block where no rule fits. Neither list needs to be small: every key a URL
    may hit is tried on a filter of fixed size, and what passes meets the list
    in an exact join. A list too long for the filter only lets more rows pass.

    Null and unparsable URLs have an empty host and path, no rule and the
    default verdict. Null ids and repeated rows are kept, one result row each;
    further columns are ignored, whatever their names; empty lists match nothing.
    """
    tidy = rules.select(
        ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("verdict").alias("says")
    )
    of_rules = tidy.groupBy(F.concat(F.lit("r "), "host", F.lit(" "), "path").alias("key")).agg(
        F.max("says").alias("says"), F.first(F.concat("host", "path")).alias("rule")
    )
    of_urls = listed.select(F.concat(F.lit("u "), F.col("url")).alias("key")).filter("key IS NOT NULL").distinct()
    entries = of_rules.unionByName(of_urls.withColumn("says", F.lit("block")), allowMissingColumns=True)

    shape = tidy.agg(
        F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(0)).alias("labels"),
        F.array_sort(F.collect_set(F.length("path"))).alias("lengths"),
    )
    host, path = split_url(pages[url_col])
    urls = pages.select(
        pages[id_col].alias("id"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row"),
        shape.select("labels").scalar().alias("max_labels"), shape.select("lengths").scalar().alias("lengths"),
    )
    labels = F.split("host", r"\.")
    depth = F.least(F.size(labels), F.col("max_labels"))
    ends = F.when((F.col("host") != "") & (depth > 0), F.transform(
        F.sequence(F.lit(1), depth), lambda k: F.array_join(F.slice(labels, -k, k), ".")
    )).otherwise(F.array().cast("array<string>"))
    starts = F.transform(
        F.filter("lengths", lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    rule_keys = F.flatten(F.transform(ends, lambda h: F.transform(starts, lambda p: F.concat(F.lit("r "), h, F.lit(" "), p))))
    url_keys = F.array(F.concat(F.lit("u "), canonical(F.col("host"), F.col("path"))))
    # One key that is in no list keeps every row alive; being unique it spreads evenly.
    own = F.array(F.concat(F.lit("- "), F.col("row").cast("string")))
    keys = urls.select("row", "id", "host", "path", F.explode(F.concat(own, url_keys, rule_keys)).alias("key"))
    keys = keys.withColumn("bits", bloom_filter(entries, "key", blocks).scalar())
    hits = keys.filter(F.col("key").startswith("- ") | might_contain(F.col("key"), F.col("bits"), blocks)).drop("bits")
    best = hits.join(entries, "key", "left").groupBy("row", "id", "host", "path").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), "rule", "says"))).alias("best"),
        F.coalesce(F.bool_or(F.col("key").startswith("u ") & F.col("says").isNotNull()), F.lit(False)).alias("listed"),
    )
    return best.select(
        "id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.says", F.when(F.col("listed"), "block").otherwise(default)).alias("verdict"), "listed",
    )

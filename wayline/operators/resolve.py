"""From keywords to places, and from places to stored entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayline import constants as K
from wayline.functions.geo import cells_within, great_circle_distance, lat_cell, lon_cell, within_radius
from wayline.functions.matching import address_has_token, address_in_city, best_address, name_score
from wayline.functions.text import normalize_name_strict, strip_region_suffix
from wayline.operators.ordering import first_per_group
from wayline.session import materialize, union_rows

# Names are blocked on at most this many characters; longer ones are checked
# in full after the join.
_BLOCK = 8
# A grid cell with more spots of one title than this is searched from the probe outwards, in circles of these shares.
_CROWD = 64
_SHARES = (64, 16, 4)


def dim_lookup_skip(df: DataFrame, dim: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key the dimension knows, rows to skip)."""
    known = dim.select(key).distinct()
    return df.join(known, key, "left_semi"), df.join(known, key, "left_anti")


def candidate_filter(
    candidates: DataFrame, cities: DataFrame, categories: Sequence[str] = K.PLACE_CATEGORIES
) -> DataFrame:
    """Place search results that fit: category, name, and an address in the city.

    Adds `name_score` and `address`; `cities` brings `city_name`, `short_name`.
    """
    address = best_address(F.col("road_address_name"), F.col("address_name"))
    return (
        candidates.where(F.col("category_group_code").isin(*categories))
        .withColumns({"name_score": name_score(F.col("keyword"), F.col("place_name")), "address": address})
        .where("name_score IS NOT NULL")
        .join(cities.select("city_name", "short_name"), "city_name")
        .where(address_has_token(F.col("address"), [F.col("city_name"), F.col("short_name")]))
        .drop("short_name")
    )


def best_candidate(fitting: DataFrame) -> DataFrame:
    """Per city and keyword: best name score, then the earliest search result."""
    return first_per_group(fitting, ["city_name", "keyword"], [F.col("name_score").desc(), F.col("pos").asc()])


def _substrings(text: Column, lengths: Sequence[int]) -> Column:
    """Distinct substrings of `text` of the given lengths."""
    size = F.length(text)
    by_length = [
        F.when(
            size >= n,
            F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.substring(text, i, F.lit(n))),
        ).otherwise(F.array().cast("array<string>"))
        for n in lengths
    ]
    return F.array_distinct(F.concat(F.array().cast("array<string>"), *by_length))


def _head(text: Column) -> Column:
    return F.substring(text, 1, _BLOCK)


def tag_cities(entities: DataFrame, cities: DataFrame, address: str = "addr1", city: str = "city_name") -> DataFrame:
    """Entities once per city their address mentions (city name without suffix).

    The cities are joined on their leading characters, then compared in full.
    An address gives only substrings as long as some city's leading characters
    are, which mostly is two or three.
    """
    names = cities.select(city, strip_region_suffix(F.lower(city)).alias("_token")).where("_token <> ''").distinct()
    heads = materialize(names.withColumn("_head", _head(F.col("_token"))), "cities")
    lengths = [r[0] for r in heads.select(F.length("_head")).distinct().collect()]  # at most _BLOCK
    blocks = entities.withColumn("_block", F.explode(_substrings(F.lower(address), sorted(lengths))))
    return (
        blocks.join(heads, F.col("_block") == F.col("_head"))
        .where(address_in_city(F.col(address), F.col("_token")))
        .select(*entities.columns, city)
    )


def place_match(
    probes: DataFrame,
    entities: DataFrame,
    radius: float = K.MATCH_RADIUS_M,
    min_length: int = K.CONTAINMENT_MIN_LENGTH,
) -> DataFrame:
    """The one stored entity each probe stands for, if any.

    `probes`: city_name, place_name, longitude, latitude (+ any columns).
    `entities`: city_name (see `tag_cities`), content_id, category, title,
    map_x, map_y. A pair fits when the normalised names are equal, or the probe
    has `min_length` characters and one name contains the other, and when the
    entity lies within `radius` or has no coordinates. Preferred: equal name,
    coordinates present, smaller distance in whole metres, smaller id.

    Names are paired first, each distinct name of a city once, by equi joins:
    the contained name's first characters meet every substring of that length
    in the other. Only entities whose title pairs go on; they and the probes
    meet by city, title and grid cell. Copies are folded before that: one entity
    per city, title and spot, as the smallest id would win anyway, and one probe
    per city, name and spot. Where one title has many spots in a cell, a probe
    looks for it in small circles first (see `_fitting`).
    """
    both = F.col("map_x").isNotNull() & F.col("map_y").isNotNull()
    spot = lambda name: F.when(both, F.col(name).cast("double"))
    titles = entities.select(
        "city_name",
        normalize_name_strict(F.col("title")).alias("_title"),
        spot("map_x").alias("_x"),
        spot("map_y").alias("_y"),
        "content_id",
        "category",
    ).where("_title <> ''")
    named = probes.withColumns(
        {
            "_name": normalize_name_strict(F.col("place_name")),
            "_lon": F.col("longitude").cast("double"),
            "_lat": F.col("latitude").cast("double"),
        }
    ).where("_name <> ''")
    asks = named.select("city_name", "_name", "_lon", "_lat").distinct()
    # Read twice below; stored, it also has a size the joins can plan with.
    pairs = materialize(
        _name_pairs(
            asks.select("city_name", "_name").distinct(), titles.select("city_name", "_title").distinct(), min_length
        ),
        "name-pairs",
    )
    cell = F.when(F.col("_x").isNotNull(), _cell_key(lat_cell(F.col("_y"), radius), lon_cell(F.col("_x"), radius))).otherwise(-1)
    spots = (
        titles.join(pairs.select("city_name", "_title").distinct(), ["city_name", "_title"], "left_semi")
        .groupBy("city_name", "_title", "_x", "_y")
        .agg(F.min("content_id").alias("content_id"), F.min_by("category", "content_id").alias("category"))
        .withColumn("_cell", cell)
    )
    fitting = _fitting(asks.join(pairs, ["city_name", "_name"]), materialize(spots, "spots"), radius)
    best = first_per_group(
        fitting,
        ["city_name", "_name", "_lon", "_lat"],
        [
            (F.col("_name") == F.col("_title")).desc(),
            F.col("_x").isNotNull().desc(),
            F.round("_distance").asc_nulls_last(),
            F.col("content_id").asc(),
        ],
    ).select(
        F.col("city_name").alias("_b_city"), F.col("_name").alias("_b_name"), F.col("_lon").alias("_b_lon"),
        F.col("_lat").alias("_b_lat"), "content_id", "category",
    )
    back = (
        (F.col("city_name") == F.col("_b_city"))
        & (F.col("_name") == F.col("_b_name"))
        & F.col("_lon").eqNullSafe(F.col("_b_lon"))
        & F.col("_lat").eqNullSafe(F.col("_b_lat"))
    )
    return named.join(best, back).select(*probes.columns, "content_id", "category")


_ASK = ["city_name", "_name", "_lon", "_lat", "_title"]


def _near_cells(radius: float) -> Column:
    """Keys of the cells within `radius` of a probe; none without a position."""
    cells = F.coalesce(
        cells_within(F.col("_lat"), F.col("_lon"), radius), F.array().cast("array<struct<lat_cell:bigint,lon_cell:bigint>>")
    )
    return F.transform(cells, lambda c: _cell_key(c["lat_cell"], c["lon_cell"]))


def _within(met: DataFrame, radius: float) -> DataFrame:
    distance = great_circle_distance(F.col("_lat"), F.col("_lon"), F.col("_y"), F.col("_x"))
    return met.withColumn("_distance", distance).where(within_radius(F.col("_distance"), F.col("_y"), F.col("_x"), radius))


def _fitting(asked: DataFrame, spots: DataFrame, radius: float) -> DataFrame:
    """Spots within the radius of each probe and title asked for, with `_distance`; of crowded titles the nearest alone.

    Probes and spots meet in grid cells as wide as the radius. For titles with
    a crowded cell that would pair all with all, so their probes first look
    within a small circle, then wider ones; where a circle has a hit, that is the title's
    nearest spot and the probe is done with it. A hit must lie a metre inside
    the circle, so that all spots at the same distance in whole metres are in it.
    """
    cells = spots.where("_cell <> -1").groupBy("city_name", "_title", "_cell").count().where(F.col("count") > _CROWD)
    crowded = materialize(cells.select("city_name", "_title").distinct(), "crowded")
    around = asked.withColumn("_cell", F.explode(F.array_append(_near_cells(radius), F.lit(-1).cast("bigint"))))
    if crowded.isEmpty():
        return _within(around.join(spots, ["city_name", "_title", "_cell"]), radius).drop("_cell")
    local = spots.where("_cell <> -1").join(crowded, ["city_name", "_title"], "left_semi").drop("_cell")
    # Towards the poles small cells would be too many in a row; no place lies there.
    open_ = asked.where("_lon IS NOT NULL AND abs(_lat) <= 85").join(crowded, ["city_name", "_title"], "left_semi").select(*_ASK)
    settled = []
    for share in _SHARES:
        circle = radius / share
        small = local.withColumn("_cell", _cell_key(lat_cell(F.col("_y"), circle), lon_cell(F.col("_x"), circle)))
        looked = open_.withColumn("_cell", F.explode(_near_cells(circle)))
        hits = _within(looked.join(small, ["city_name", "_title", "_cell"]), circle).where(F.col("_distance") <= circle - 1)
        first = F.min_by(F.struct("_x", "_y", "content_id", "category", "_distance"), F.struct(F.round("_distance"), "content_id"))
        settled.append(materialize(hits.groupBy(*_ASK).agg(first.alias("_hit")).select(*_ASK, "_hit.*"), "settled"))
        open_ = materialize(open_.join(settled[-1].select(*_ASK), _ASK, "left_anti"), "open")
    nearest = union_rows(*settled)
    rest = around.join(nearest.select(*_ASK), _ASK, "left_anti")
    met = _within(rest.join(spots, ["city_name", "_title", "_cell"]), radius).drop("_cell")
    return union_rows(met, nearest.select(*met.columns))


def _name_pairs(names: DataFrame, titles: DataFrame, min_length: int) -> DataFrame:
    """(city_name, _name, _title) that are equal or contain each other; each pair from one join."""
    long_name = F.length("_name") >= min_length
    block = ["city_name", "_block"]
    equal = names.where(~long_name).withColumn("_block", F.col("_name")).join(
        titles.withColumn("_block", F.col("_title")), block
    )
    inside_title = _containing(names.where(long_name), titles, max(1, min(min_length, _BLOCK)))
    inside_name = (
        names.where(long_name)
        .withColumn("_block", F.explode(_substrings(F.col("_name"), range(1, _BLOCK + 1))))
        .join(titles.withColumn("_block", _head(F.col("_title"))), block)
        .where(F.contains(F.col("_name"), F.col("_title")) & (F.length("_title") < F.length("_name")))
    )
    return union_rows(equal, inside_title, inside_name).drop("_block")


def _containing(names: DataFrame, titles: DataFrame, size: int) -> DataFrame:
    """(city_name, _block, _name, _title): names of at least `size` characters inside titles.

    Titles are indexed by their substrings of that one length. A name is looked
    up by the one of its own that the fewest titles have; where none has it,
    the name is in no title.
    """
    block = ["city_name", "_block"]
    index = materialize(titles.withColumn("_block", F.explode(_substrings(F.col("_title"), [size]))), "title-grams")
    known = index.groupBy(*block).agg(F.count("*").alias("_n"))
    grams = names.withColumn("_block", F.explode(_substrings(F.col("_name"), [size]))).join(known, block, "left")
    rarest = grams.groupBy("city_name", "_name").agg(F.min_by("_block", F.struct(F.coalesce("_n", F.lit(0)), "_block")).alias("_block"))
    return rarest.join(index, block).where(F.contains(F.col("_title"), F.col("_name"))).select(*block, "_name", "_title")


def _cell_key(row: Column, column: Column) -> Column:
    """One non-negative number per grid cell, whatever its size; -1 stays free for 'nowhere'."""
    return F.shiftleft((row + (1 << 30)).cast("bigint"), 32) + column + (1 << 30)


def merge_place_metrics(
    places: DataFrame, key: str, position: str, sums: Sequence[str], attributes: Sequence[str] = ()
) -> DataFrame:
    """One row per place: metrics added up, attributes of the first row."""
    return places.groupBy(key).agg(
        *[F.min_by(a, position).alias(a) for a in attributes], *[F.sum(s).alias(s) for s in sums]
    )

"""Raw text items to typed rows, with the unusable ones set apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayline import constants as K
from wayline.functions.parsing import in_range, parse_datetime14, safe_decimal, safe_int
from wayline.functions.scoring import classify_category, content_hash
from wayline.functions.text import clean_text, region_aliases, truncate_text
from wayline.operators.ordering import distributed_row_number
from wayline.session import union_rows


def _field(df: DataFrame, name: str) -> Column:
    """A raw column, or NULL where this load did not bring it."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def normalize_entity(
    raw: DataFrame, rules=K.CATEGORY_RULES, version: str = K.CONTENT_HASH_VERSION, keep: Sequence[str] = ()
) -> DataFrame:
    """One projection from raw listing items to typed entity rows; `keep` passes columns through."""
    f = lambda name: _field(raw, name)
    lon = in_range(safe_decimal(f("mapx")), *K.LON_RANGE)
    lat = in_range(safe_decimal(f("mapy")), *K.LAT_RANGE)
    return raw.select(
        safe_int(f("contentid")).alias("content_id"),
        clean_text(f("contenttypeid")).alias("content_type_id"),
        truncate_text(clean_text(f("title")), K.TITLE_WIDTH).alias("title"),
        clean_text(f("addr1")).alias("addr1"),
        clean_text(f("addr2")).alias("addr2"),
        clean_text(f("zipcode")).alias("zipcode"),
        lon.alias("map_x"),
        lat.alias("map_y"),
        safe_int(f("mlevel"), "smallint").alias("map_level"),
        clean_text(f("lDongRegnCd")).alias("ldong_regn_code"),
        clean_text(f("lDongSignguCd")).alias("ldong_signgu_code"),
        clean_text(f("sigungucode")).alias("sigungu_code"),
        classify_category(clean_text(f("lclsSystm1")), clean_text(f("lclsSystm2")), rules).alias("category"),
        clean_text(f("firstimage")).alias("first_image"),
        parse_datetime14(f("createdtime")).alias("created_time"),
        content_hash([f(name) for name in K.CONTENT_HASH_FIELDS], version).alias("content_hash"),
        *keep,
    )


ENTITY_RULES = {
    "missing_id": lambda: F.col("content_id").isNull(),
    "missing_title": lambda: F.col("title").isNull(),
    "unsupported_category": lambda: F.col("category").isNull(),
}


def with_reason(df: DataFrame, rules: Mapping[str, Column], out: str = "_reason") -> DataFrame:
    """Name of the first broken rule, NULL for a valid row."""
    return df.withColumn(out, F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))


def quarantine_split(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, broken rows with their reason): two filters over one plan."""
    judged = with_reason(df, rules)
    return judged.where("_reason IS NULL").drop("_reason"), judged.where("_reason IS NOT NULL")


def entity_rules() -> dict[str, Column]:
    return {name: rule() for name, rule in ENTITY_RULES.items()}


def normalize_codes(raw: DataFrame, constants: Mapping[str, Column] | None = None) -> DataFrame:
    """Code rows with both code and name; `constants` adds area, depth or parent."""
    named = raw.select(
        clean_text(F.col("code")).alias("code"),
        clean_text(F.col("name")).alias("name"),
        *[c.alias(n) for n, c in (constants or {}).items()],
    )
    return named.where(F.col("code").isNotNull() & F.col("name").isNotNull())


def read_id(rows: DataFrame, column: str) -> Column:
    """An id as a number, NULL unless it is digits only; one stored as a number is not read as text again."""
    c = F.col(column)
    if dict(rows.dtypes)[column] == "bigint":
        return F.when(c >= 0, c)
    return safe_int(c.cast("string"))


def normalize_detail_common(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        read_id(raw, "contentid").alias("content_id"),
        *[clean_text(_field(raw, n)).alias(n) for n in ("homepage", "overview")],
    )
    return rows.where("content_id IS NOT NULL")


def normalize_detail_intro(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        read_id(raw, "contentid").alias("content_id"),
        truncate_text(clean_text(_field(raw, "infocenter")), K.INFOCENTER_WIDTH).alias("infocenter"),
        *[clean_text(_field(raw, n)).alias(n) for n in ("usetime", "restdate", "parking", "expguide")],
    )
    return rows.where("content_id IS NOT NULL")


def ordinal_assign(df: DataFrame, parent: str, order_by: Sequence[Column], out: str = "order") -> DataFrame:
    """1..n per parent in the given order, also when one parent has most rows."""
    return distributed_row_number(df, [parent], order_by, out)


def normalize_images(
    raw: DataFrame, order_by: Sequence[Column], parent: str = "contentid",
    origin: str = "originimgurl", small: str = "smallimageurl",
) -> DataFrame:
    """Image rows numbered in response order; rows without any URL or with a malformed id take no number."""
    url = F.coalesce(clean_text(F.col(origin)), clean_text(F.col(small)))
    usable = raw.withColumns({"image_url": url, "content_id": read_id(raw, parent)})
    numbered = ordinal_assign(usable.where("image_url IS NOT NULL AND content_id IS NOT NULL"), "content_id", order_by)
    return numbered.select("content_id", F.col("order").cast("int").alias("order"), "image_url")


def number_images(
    responses: DataFrame, parent: str = "content_id", items: str = "items",
    origin: str = "originimgurl", small: str = "smallimageurl",
) -> DataFrame:
    """`normalize_images` for responses that hold their items as an array of maps, one response per parent.

    The array is filtered and its places are the numbers, so nothing is shuffled or sorted.
    """
    field = lambda item, name: clean_text(item[name])
    urls = F.filter(F.transform(items, lambda i: F.coalesce(field(i, origin), field(i, small))), lambda u: u.isNotNull())
    kept = responses.select(read_id(responses, parent).alias("content_id"), F.posexplode(urls).alias("_place", "image_url"))
    return kept.where("content_id IS NOT NULL").select("content_id", (F.col("_place") + 1).alias("order"), "image_url")


def detail_info_pack(items: DataFrame, key: str, order_by: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """All detail items of an entity as one JSON array in response order.

    The array is the stored value itself, so its size is that of one entity's
    detail response; only the ordering and payload columns are collected.
    """
    item = F.struct(*order_by, F.struct(*fields).alias("_item"))
    packed = items.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    return packed.select(
        key, F.to_json(F.transform("_items", lambda x: x["_item"])).alias("detail_info")
    )


def region_alias_expand(names: DataFrame, column: str, extra: DataFrame | None = None) -> DataFrame:
    """Distinct region names with their short forms, joined by further fixed names."""
    aliases = names.select(F.explode(region_aliases(F.col(column))).alias("name"))
    if extra is not None:
        aliases = union_rows(aliases, extra.select(F.col(extra.columns[0]).alias("name")))
    return aliases.where("name <> ''").distinct()

"""Predicates that decide whether two names or an address and a city agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from wayline import constants as K
from wayline.functions.text import normalize_name_ws


def name_containment(probe: Column, title: Column, min_length: int = K.CONTAINMENT_MIN_LENGTH) -> Column:
    """Equal, or a probe of at least `min_length` characters and one inside the other.

    Both sides must be non-empty: an empty title would fit everything.
    """
    contained = (F.length(probe) >= min_length) & (F.contains(title, probe) | F.contains(probe, title))
    return (probe != "") & (title != "") & ((probe == title) | contained)


def address_in_city(address: Column, city: Column) -> Column:
    """Case-insensitive: the address mentions the city; NULL addresses fail."""
    return F.coalesce(F.contains(F.lower(address), F.lower(city)), F.lit(False))


def name_score(keyword: Column, place_name: Column) -> Column:
    """2 for the same name, 1 when the keyword is part of it, NULL otherwise."""
    wanted, name = normalize_name_ws(keyword), normalize_name_ws(place_name)
    return F.when(wanted == "", F.lit(None).cast("int")).when(name == wanted, F.lit(2)).when(
        F.contains(name, wanted), F.lit(1)
    )


def best_address(road: Column, plain: Column) -> Column:
    """Road address, else the plain one."""
    return F.coalesce(F.nullif(road, F.lit("")), plain, F.lit(""))


def address_has_token(address: Column, tokens: Sequence[Column]) -> Column:
    """The address, without white space, holds at least one non-empty token."""
    text = normalize_name_ws(address)
    found = F.lit(False)
    for token in tokens:
        plain = normalize_name_ws(token)
        found = found | F.coalesce((plain != "") & F.contains(text, plain), F.lit(False))
    return found

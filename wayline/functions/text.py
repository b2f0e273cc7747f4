"""Text clean-up and name normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from wayline import constants as K

# The characters that count as white space around and inside text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def clean_text(c: Column) -> Column:
    """Text without surrounding white space; blank becomes NULL."""
    return F.nullif(F.btrim(c.cast("string"), F.lit(WHITE_SPACE)), F.lit(""))


def truncate_text(c: Column, width: int) -> Column:
    """First `width` code points."""
    return F.substring(c, 1, width)


def normalize_name_strict(c: Column, alphabet: str = K.NAME_ALPHABET) -> Column:
    """Lower case, only digits, Latin letters and Hangul syllables kept."""
    return F.regexp_replace(F.lower(c), f"[^{alphabet}]", "")


def normalize_name_ws(c: Column) -> Column:
    """Lower case without any white space."""
    return F.regexp_replace(F.lower(c), f"[{WHITE_SPACE}]+", "")


def strip_markup(c: Column) -> Column:
    """Tags and entities become spaces; text without any skips the pattern."""
    without_tags = F.when(F.contains(c, F.lit("<")), F.regexp_replace(c, K.TAG_PATTERN, " ")).otherwise(c)
    return F.when(
        F.contains(without_tags, F.lit("&")), F.regexp_replace(without_tags, K.ENTITY_PATTERN, " ")
    ).otherwise(without_tags)


def strip_markup_keep_script(c: Column, keep: str = K.HANGUL) -> Column:
    """Tags, entities and every character outside the kept script become spaces."""
    return F.regexp_replace(strip_markup(c), f"[^{keep} ]", " ")


def script_words(c: Column, keep: str = K.HANGUL) -> Column:
    """Words of the kept script: what splitting the stripped text at spaces gives, in one pass."""
    return F.regexp_extract_all(strip_markup(c), F.lit(f"[{keep}]+"), F.lit(0))


def document_text(title: Column, contents: Column) -> Column:
    """Title and body joined by one space, missing parts empty."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(contents, F.lit("")))


def strip_region_suffix(c: Column, suffixes: Sequence[str] = K.CITY_SUFFIXES) -> Column:
    """Administrative suffix removed from the end of a region name, once."""
    longest_first = sorted(suffixes, key=len, reverse=True)
    return F.regexp_replace(c, f"({'|'.join(longest_first)})$", "")


def region_aliases(c: Column) -> Column:
    """A region name with every short form it goes by."""
    one_char = [s for s in K.REGION_SUFFIXES if len(s) == 1]
    longer = [s for s in K.REGION_SUFFIXES if len(s) > 1]
    return F.array_distinct(
        F.array(c, strip_region_suffix(c, one_char), strip_region_suffix(c, longer))
    )

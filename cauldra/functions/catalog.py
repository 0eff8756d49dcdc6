"""Column functions that read a catalogue record: tags, net weight, harvest year, hints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, collapse

#: The tag keys that carry a value after an underscore, in the records' own spelling.
TAG_KEYS = (
    "Producer",
    "Region",
    "Sub-Region",
    "Country",
    "Harvest & Season",
    "Pu-erh Harvest Season",
    "Storage Type",
    "Shape",
    "Cultivar",
    "Certified Organic",
    "Price per gram",
)
#: The keys that may state a harvest year, in order.
YEAR_KEYS = ("harvest & season", "pu-erh harvest season")

_TAG = "^(" + "|".join(k.replace("&", r"\&") for k in TAG_KEYS) + r")_(?s:(.+))$"
#: Units of mass, and the patterns of stated weights and years.
_MASS = r"(?:g|grams?|kg|kilograms?)"
BRACKETED = rf"(?iU)\((\d+(?:\.\d+)?)\s*({_MASS})\)"
PIECES = rf"(?iU)(\d+)\s*x\s*(\d+(?:\.\d+)?)\s*({_MASS})\b"
PLAIN = rf"(?iU)(\d+(?:\.\d+)?)\s*({_MASS})\b"
IN_TITLE = r"(?iU)(\d{2,4})\s*(?:g|grams?)\b"
ANY_YEAR = r"((?:19|20)\d\d)"
FIRST_YEAR = r"^(?U)((?:19|20)\d\d)\b"


def parsed_tags(tags: Column) -> Column:
    """array<struct<key,value>> of the tags in order: key is the lower-case known key, null for other
    tags, whose value is the trimmed tag. Null and blank tags are dropped, repeats stay."""
    bare = F.filter(F.transform(tags, lambda t: F.regexp_replace(t, r"(?U)^\s+|\s+$", "")), lambda t: t.isNotNull() & (t != ""))

    def read(t: Column) -> Column:
        value = collapse(F.regexp_extract(t, _TAG, 2))
        known = value != ""
        return F.struct(F.when(known, F.lower(F.regexp_extract(t, _TAG, 1))).alias("key"), F.when(known, value).otherwise(t).alias("value"))

    return F.transform(bare, read)


def tag_values(parsed: Column, key: str) -> Column:
    return F.transform(F.filter(parsed, lambda p: p["key"] == key), lambda p: p["value"])


def first_tag(parsed: Column, key: str) -> Column:
    return F.get(tag_values(parsed, key), 0)


def tag_map(parsed: Column) -> Column:
    """map<key, values in order> of the known tags."""
    keys = F.array_distinct(F.transform(F.filter(parsed, lambda p: p["key"].isNotNull()), lambda p: p["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.transform(F.filter(parsed, lambda p: p["key"] == k), lambda p: p["value"])))


def other_tags(parsed: Column) -> Column:
    return F.transform(F.filter(parsed, lambda p: p["key"].isNull()), lambda p: p["value"])


def _grams(number: Column, unit: Column) -> Column:
    return F.bround(number * F.when(F.lower(unit).startswith("k"), 1000).otherwise(1)).try_cast("int")


def _found(text: Column, pattern: str, number: int, unit: int, count: int | None = None) -> Column:
    n = F.regexp_extract(text, pattern, number).try_cast("double")
    if count is not None:
        n = n * F.regexp_extract(text, pattern, count).try_cast("double")
    return _grams(n, F.regexp_extract(text, pattern, unit))


def option_grams(text: Column) -> Column:
    """Net grams that an option states: in brackets, else pieces times weight, else plainly."""
    return F.coalesce(_found(text, BRACKETED, 1, 2), _found(text, PIECES, 2, 3, 1), _found(text, PLAIN, 1, 2))


def title_grams(title: Column) -> Column:
    return F.regexp_extract(title, IN_TITLE, 1).try_cast("int")


def net_grams(option1: Column, variant_title: Column, product_title: Column) -> Column:
    """Never from the shipping weight, which holds the packaging."""
    return F.coalesce(option_grams(option1), option_grams(variant_title), title_grams(product_title))


def harvest_year(parsed: Column, title: Column) -> Column:
    """From the year tags, where the year may stand anywhere; else a year that begins the title."""
    tagged = [F.regexp_extract(first_tag(parsed, k), ANY_YEAR, 1).try_cast("int") for k in YEAR_KEYS]
    return F.coalesce(*tagged, F.regexp_extract(title, FIRST_YEAR, 1).try_cast("int"))


def producer_hint(parsed: Column, vendor: Column) -> Column:
    """struct<name, origin>: the producer tag, else the vendor field."""
    tag, field = first_tag(parsed, "producer"), blank_to_null(collapse(vendor))
    name, origin = F.coalesce(tag, field), F.when(tag.isNotNull(), "tag").otherwise("vendor")
    return F.when(name.isNotNull(), F.named_struct(F.lit("name"), name, F.lit("origin"), origin))


def is_kind(product_type: Column, tags: Column, kind: str) -> Column:
    """Whether the type or any tag, trimmed and in any case, is ``kind``."""
    same = lambda c: F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")) == kind.lower()
    return F.coalesce(same(product_type), F.lit(False)) | F.coalesce(F.exists(tags, lambda t: F.coalesce(same(t), F.lit(False))), F.lit(False))

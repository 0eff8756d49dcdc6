"""Column functions on text: Unicode form, white space, names, hashes, numbers.

All patterns use ``(?U)``: Java's classes are ASCII without it, so that no-break spaces and letters
outside ASCII would be missed. NFC has no builtin and is the one Arrow function here; texts that are
ASCII skip it.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def nfc(text: Column) -> Column:
    """Unicode NFC. Only texts with characters beyond ASCII go through Python."""
    return F.when(text.rlike(r"^\p{ASCII}*$"), text).otherwise(_nfc(F.when(~text.rlike(r"^\p{ASCII}*$"), text)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfc_each(s: pd.Series) -> pd.Series:
    return s.map(lambda a: None if a is None else [None if t is None else unicodedata.normalize("NFC", t) for t in a])


def nfc_each(texts: Column) -> Column:
    """Unicode NFC of every element; arrays of ASCII texts stay in the JVM."""
    plain = F.coalesce(F.forall(texts, lambda t: t.rlike(r"^\p{ASCII}*$")), F.lit(True))
    return F.when(plain, texts).otherwise(_nfc_each(F.when(~plain, texts)))


def collapse(text: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"^ | $", "")


def name_key(text: Column) -> Column:
    """The form in which names are compared: NFC, lower case, collapsed; punctuation stays."""
    return collapse(F.lower(nfc(text)))


def blank_to_null(text: Column) -> Column:
    return F.when(collapse(text) != "", text)


def cents(price: Column) -> Column:
    """A decimal text as integer hundredths, half to even; null where it is none or out of range."""
    value = price.cast("string").try_cast("double") * 100
    return F.when(~F.isnan(value), F.bround(value)).try_cast("int")


def safe_int(text: Column) -> Column:
    """A text that is a whole number in all its parts, else null."""
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text)).try_cast("int")


def truthy(value: Column) -> Column:
    """Whether a variant holds a value that counts as true: true itself, a number but zero, a text, list
    or object with anything in it. Null and missing are false."""
    kind = F.schema_of_variant(value)
    as_text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double")
    told = (
        F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(kind == "VOID", False)
        .when(kind == "STRING", as_text != "")
        .when(kind.startswith("ARRAY"), as_text != "[]")
        .when(kind.startswith("OBJECT"), as_text != "{}")
        .otherwise(number != 0)
    )
    return F.coalesce(told, F.lit(False))


def person_hash(name: Column) -> Column:
    """A pseudonym: the same for any case, padding and Unicode form of a name."""
    trimmed = F.regexp_replace(nfc(name), r"(?U)^\s+|\s+$", "")
    return F.concat(F.lit("sha256:"), F.sha2(F.lower(trimmed), 256))


def payload_hash(json_text: Column) -> Column:
    """SHA-256 of a JSON text's canonical form: keys sorted at every depth, no white space. Null for
    texts that are no JSON (also for objects with a repeated key). Numbers count by value: ``1.0`` and
    ``1`` are one."""
    return F.sha2(F.to_json(F.try_parse_json(json_text)), 256)


def content_hash(**fields: Column) -> Column:
    """SHA-256 of named fields as JSON with sorted keys, nulls kept."""
    parts = F.struct(*[fields[k].alias(k) for k in sorted(fields)])
    return F.sha2(F.to_json(parts, {"ignoreNullFields": "false"}), 256)


def description_hash(title: Column, body: Column, tags: Column) -> Column:
    """A listing's description: blind to the order of tags and to Unicode form, not to case."""
    known = F.coalesce(F.sort_array(nfc_each(F.filter(tags, lambda t: t.isNotNull()))), F.array().cast("array<string>"))
    return content_hash(title=nfc(title), body_html=nfc(body), tags=known)


def product_url(base: Column, handle: Column) -> Column:
    return F.when(F.trim(handle) != "", F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/products/"), handle))

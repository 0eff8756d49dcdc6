"""Deeply nested records to related flat tables.

Every target table is one projection over the input: nested ``transform`` calls carry the keys and
positions of all ancestors down to the leaf structs, ``flatten`` joins the levels, and one ``inline``
emits the rows. There is no shuffle, no join and no Python; several tables over one input share the
scan's column pruning because each projection names only the fields it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Level:
    """One array on the way down. ``path`` is relative to the parent element ("" for the element
    itself), ``keys`` maps output names to fields of this level's elements that descendants carry,
    ``position`` names the output column for the element's index (from 0)."""

    path: str
    position: str
    keys: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FlatTable:
    """A target table: levels from the outside in, and the columns read from the innermost element
    (output name -> field, "" for the element itself)."""

    levels: Sequence[Level]
    columns: dict[str, str]


def _get(value: Column, path: str) -> Column:
    for part in filter(None, path.split(".")):
        value = value.getField(part)
    return value


def flatten_table(df: DataFrame, root_keys: dict[str, str], table: FlatTable, keep_empty: bool = False) -> DataFrame:
    """Rows of ``table``, each with the root keys, the positions of all its ancestors and its own.

    Null and empty arrays give no rows; null elements give a row whose columns are null, so that
    positions stay true. With ``keep_empty`` a record without any element gives one row whose
    positions and columns are null (an outer inline). Clashing names raise ``ValueError``; columns
    of ``df`` that no key names are not read, so they cannot clash.
    """
    names = [*root_keys, *(n for level in table.levels for n in (*level.keys, level.position)), *table.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"clashing output names: {names}")
    roots = [_get(F.col(p.split(".")[0]), ".".join(p.split(".")[1:])).alias(n) for n, p in root_keys.items()]

    def walk(value: Column | None, depth: int, carried: list[Column]) -> Column:
        level, last = table.levels[depth], depth == len(table.levels) - 1
        if value is None:
            first, _, rest = level.path.partition(".")
            array = _get(F.col(first), rest)
        else:
            array = _get(value, level.path)

        def each(x: Column, i: Column) -> Column:
            own = carried + [_get(x, p).alias(n) for n, p in level.keys.items()] + [i.cast("int").alias(level.position)]
            if last:
                return F.struct(*own, *[_get(x, p).alias(n) for n, p in table.columns.items()])
            return walk(x, depth + 1, own)

        out = F.transform(array, each)
        # A null inner array would make flatten null and lose its siblings.
        return out if last else F.flatten(F.filter(out, lambda a: a.isNotNull()))

    emit = F.inline_outer if keep_empty else F.inline
    return df.select(emit(walk(None, 0, roots)))


def flatten_tables(df: DataFrame, root_keys: dict[str, str], tables: dict[str, FlatTable]) -> dict[str, DataFrame]:
    """All target tables by name, each its own single projection over ``df``."""
    return {name: flatten_table(df, root_keys, t) for name, t in tables.items()}


ROOT_KEYS = {"external_id": "ingest_meta.external_id", "source": "ingest_meta.source", "scraped_at": "ingest_meta.scraped_at", "run_id": "ingest_meta.run_id", "record_index": "ingest_meta.record_index"}

#: The catalogue record's child tables.
CATALOG_TABLES = {
    "variant": FlatTable([Level("payload.variants", "variant_pos")], {"variant_id": "id", "variant_title": "title", "option1": "option1", "option2": "option2", "option3": "option3", "sku": "sku", "price": "price", "available": "available", "grams": "grams"}),
    "image": FlatTable([Level("payload.images", "image_pos")], {"image_id": "id", "src": "src", "width": "width", "height": "height"}),
    "image_variant": FlatTable([Level("payload.images", "image_pos", {"image_id": "id"}), Level("variant_ids", "link_pos")], {"variant_id": ""}),
    "tag": FlatTable([Level("payload.tags", "tag_pos")], {"tag": ""}),
    "option": FlatTable([Level("payload.options", "option_pos")], {"option_name": "name"}),
    "option_value": FlatTable([Level("payload.options", "option_pos", {"option_name": "name"}), Level("values", "value_pos")], {"value": ""}),
}


def child_keys(df: DataFrame) -> DataFrame:
    """Distinct (external_id, child, child_key) over all records; a listing without any child in any
    of its records keeps one row (external_id, ``none``, empty string).

    Elements without id, null and blank tags are left out; tags lose leading and trailing spaces. A
    null external_id is kept as a listing of its own. One projection combines the three arrays; the
    distinct pre-aggregates before its shuffle, and the window that drops superseded ``none`` rows
    only sees the distinct children of one listing.
    """
    ident = F.col("ingest_meta.external_id")

    def entries(array: str, kind: str, key) -> Column:
        made = F.transform(F.col(array), lambda x: F.struct(ident.alias("external_id"), F.lit(kind).alias("child"), key(x).alias("child_key")))
        return F.coalesce(F.filter(made, lambda s: s["child_key"].isNotNull() & (s["child_key"] != "")), F.array().cast("array<struct<external_id:string,child:string,child_key:string>>"))

    children = F.flatten(
        F.array(
            entries("payload.variants", "variant", lambda x: x["id"].cast("string")),
            entries("payload.images", "image", lambda x: x["id"].cast("string")),
            entries("payload.tags", "tag", lambda x: F.trim(x)),
        )
    )
    nothing = F.array(F.struct(ident.alias("external_id"), F.lit("none").alias("child"), F.lit("").alias("child_key")))
    rows = df.select(F.inline(F.when(F.size(children) > 0, children).otherwise(nothing))).distinct()
    from pyspark.sql import Window

    real = F.max(F.col("child") != "none").over(Window.partitionBy("external_id"))
    return rows.withColumn("_real", real).filter((F.col("child") != "none") | ~F.col("_real")).drop("_real")

"""Quantities written in many units, to grams and millilitres.

A text such as ``"10 × 25 g"``, ``"0.88 oz (25 g)"`` or ``"half a kilo"`` is read into mentions: a
number and a unit symbol each, with a number of pieces. A symbol may stand for several units (``oz``
for mass or for volume, ``gr`` for gram or grain). Which combination of units holds is decided by
physical identities: two statements of one content agree, pieces times content is the total, net mass
is a little less than shipping mass (density times volume for liquids). The combination with the least
sum of absolute log residuals wins; when another one with a different amount comes equally close, the
result is flagged as not unique.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OZ, LB, JIN, LIANG, FL_OZ = 28.349523125, 453.59237, 500.0, 50.0, 29.5735295625

#: Unit symbols (lower case, no full stops) -> readings (unit of the result, factor, prior).
#: The prior is a log penalty for readings that are rare on a shop's label.
UNITS: dict[str, tuple[tuple[str, float, float], ...]] = {}
for _names, _readings in (
    ("g gm gms gram grams gramme grammes 克 г гр", (("g", 1.0, 0.0),)),
    ("gr", (("g", 1.0, 0.0), ("g", 0.06479891, 2.0))),
    ("kg kgs kilo kilos kilogram kilograms kilogramme kilogrammes 千克 公斤 кг", (("g", 1000.0, 0.0),)),
    ("mg milligram milligrams 毫克", (("g", 0.001, 0.0),)),
    ("oz ozs ounce ounces", (("g", OZ, 0.0), ("ml", FL_OZ, 1.0))),
    ("lb lbs pound pounds 磅", (("g", LB, 0.0),)),
    ("jin catty catties 斤 市斤", (("g", JIN, 0.0),)),
    ("liang tael taels 两 兩", (("g", LIANG, 0.0),)),
    ("floz fluidounce fluidounces", (("ml", FL_OZ, 0.0),)),
    ("ml milliliter milliliters millilitre millilitres cc 毫升 мл", (("ml", 1.0, 0.0),)),
    ("cl centiliter centiliters centilitre centilitres", (("ml", 10.0, 0.0),)),
    ("dl deciliter deciliters decilitre decilitres", (("ml", 100.0, 0.0),)),
    ("l lt ltr liter liters litre litres 升 л", (("ml", 1000.0, 0.0),)),
):
    for _n in _names.split():
        UNITS[_n] = _readings

WORDS = {w: float(i) for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
WORDS |= {w: 10.0 * i for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
HAN = {c: float(i) for i, c in enumerate("零一二三四五六七八九十")} | {"两": 2.0, "兩": 2.0, "半": 0.5}
FRACTIONS = {"½": 0.5, "¼": 0.25, "¾": 0.75, "⅓": 1 / 3, "⅔": 2 / 3, "⅛": 0.125}
PARTS = {"half": 0.5, "quarter": 0.25}

_LATIN = sorted((u for u in UNITS if u.isascii() or "а" <= u[0] <= "я"), key=len, reverse=True)
_CJK = sorted((u for u in UNITS if u not in _LATIN), key=len, reverse=True)
_UNIT = rf"(?:fl(?:uid)?\.?\s*(?:oz|ounces?)\b|(?:{'|'.join(_LATIN)})(?![^\W\d_])|(?:{'|'.join(_CJK)}))"
_NUM = r"(?:\d+\s*/\s*\d+|\d{1,3}(?:[,\s]\d{3})+(?!\d)(?:\.\d+)?|\d*[.,]?\d+)"
_MENTION = re.compile(rf"(?<![\w.,/])({_NUM})?\s*([½¼¾⅓⅔⅛])?\s*[-–]?\s*({_UNIT})", re.I)
_TIMES_AFTER = re.compile(r"\s*[x×*]\s*(\d+)(?!\s*(?:[.,]?\d|[^\W\d_]*\s*/))", re.I)
_TIMES_BEFORE = re.compile(r"(\d+)\s*(?:[x×*]|(?:pieces?|pcs?|bags?|packs?|pouches|tins?|boxes|cakes?|tuos?|bricks?|sachets?|sets?|balls?|units?)\s*(?:@|of\b|,|/|at\b|x|×|\(|each|à)?|@)\s*\(?\s*$", re.I)
_WORD_NUM = re.compile(r"\b(half|quarter|(?:a|one|two|three|four|five|six|seven|eight|nine|ten)\s+hundred|(?:twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety)(?:[-\s](?:one|two|three|four|five|six|seven|eight|nine))?|" + "|".join(w for w in WORDS if WORDS[w] < 20 and w != "zero") + rf"|an?)\s+(?:an?\s+|of\s+an?\s+)?({_UNIT})", re.I)
_HAN_NUM = re.compile(rf"([零一二三四五六七八九十半]|两(?=[斤]))\s*({'|'.join(_CJK)})")


def _number(text: str) -> float | None:
    text = re.sub(r"\s", "", text)
    if "/" in text:
        a, b = text.split("/")
        return float(a) / float(b) if float(b) else None
    if re.fullmatch(r"\d{1,3}(,\d{3})+(\.\d+)?", text):
        # "1,000" is a thousand, "0,500" a half: a leading zero rules thousands out.
        text = text.replace(",", "") if not text.startswith("0") else text.replace(",", ".")
    value = float(text.replace(",", "."))
    return value if 0 < value < 1e9 else None


def _spoken(text: str) -> float:
    text = text.lower().strip()
    if text in PARTS:
        return PARTS[text]
    if text in ("a", "an"):
        return 1.0
    if text.endswith("hundred"):
        first = text.split()[0]
        return 100.0 * (1.0 if first == "a" else WORDS[first])
    return sum(WORDS[w] for w in re.split(r"[-\s]+", text))


def _symbol(text: str) -> str:
    s = re.sub(r"[\s.]", "", text.lower())
    return "floz" if s.startswith("fl") else s


@lru_cache(maxsize=50_000)
def mentions(text: str) -> tuple[tuple[float, str, float], ...]:
    """(number, unit symbol, pieces) of every quantity in ``text``, in order."""
    found: list[tuple[int, float, str, float]] = []
    taken: list[tuple[int, int]] = []

    def pieces(start: int, end: int) -> float:
        if m := _TIMES_BEFORE.search(text[:start]):
            return float(m[1]) or 1.0
        if m := _TIMES_AFTER.match(text, end):
            return float(m[1]) or 1.0
        return 1.0

    for m in _MENTION.finditer(text):
        if not m[1] and not m[2]:
            continue
        n = (_number(m[1]) if m[1] else 0.0) if not m[2] else FRACTIONS[m[2]] + (float(m[1]) if m[1] and m[1].isdigit() else 0.0)
        if n:
            found.append((m.start(), n, _symbol(m[3]), pieces(m.start(), m.end())))
            taken.append(m.span())
    for pattern, value in ((_WORD_NUM, _spoken), (_HAN_NUM, lambda s: HAN[s])):
        for m in pattern.finditer(text):
            if not any(a < m.end() and m.start() < b for a, b in taken):
                found.append((m.start(), value(m[1]), _symbol(m[2]), pieces(m.start(), m.end())))
                taken.append(m.span())
    return tuple(x[1:] for x in sorted(found))


#: Two statements of one content may differ by rounding ("0.88 oz" for 25 g) up to this log ratio.
TWICE = math.log(1.06)
#: Shipping mass over net mass, as log: packaging adds from nothing to a half.
PACKED = (0.0, math.log(1.5))
#: Grams of a millilitre, as log: from loose leaves to liquids.
DENSITY = (math.log(0.1), math.log(1.1))


def _off_shipping(amount: float, unit: str, shipping_grams: float | None) -> float:
    """Log residual of a content against the shipping mass, which is its mass (density times volume)
    and packaging; 0 where no mass is given."""
    if not shipping_grams or shipping_grams <= 0:
        return 0.0
    over = math.log(shipping_grams / amount)
    light, heavy = DENSITY if unit == "ml" else (0.0, 0.0)
    return max(0.0, PACKED[0] + light - over, over - PACKED[1] - heavy)


@lru_cache(maxsize=200_000)
def resolve(text: str, shipping_grams: float | None = None) -> tuple[float, str, float, bool] | None:
    """(amount, unit, residual, unique) of a text, or None where it states no weight or volume.

    All mentions are read as statements of one content. Every combination of their readings is scored
    by the identities; grams count when a weight is stated twice. Residuals below the rounding
    tolerance count as nothing. The prior takes part in the choice, as much as a residual of its size
    does, but not in the residual given or in whether the combination is the only one that fits.
    """
    said = [m for m in mentions(text) if m[1] in UNITS]
    if not said:
        return None
    metric = [i for i, (_, s, _) in enumerate(said) if UNITS[s][0][1] in (1.0, 1000.0) or s == "gr"]
    use = metric[0] if metric else 0
    sizes = [n * k for n, _, k in said]
    best: list[tuple[float, float, str, float]] = []
    # Only the first mention and the one that counts are compared with others: given their readings, each
    # other mention takes its best one by itself, so any number of mentions is read.
    for first, used in product(UNITS[said[0][1]], UNITS[said[use][1]] if use else (None,)):
        score = fit = 0.0
        for i, (_, symbol, _) in enumerate(said):
            options = []
            for unit, factor, prior in (first,) if not i else (used,) if i == use else UNITS[symbol]:
                # A content of water has the mass of its volume; leaves and liquids both lie near it.
                gap = abs(math.log(sizes[i] * factor / (sizes[0] * first[1])))
                off = max(0.0, gap - TWICE) + (0.5 if unit != first[0] else 0.0)
                options.append((off + prior, off))
            score += min(options)[0]
            fit += min(off for _, off in options)
        unit, factor, _ = used or first
        shipped = _off_shipping(sizes[use] * factor, unit, shipping_grams)
        best.append((score + shipped, sizes[use] * factor, unit, fit + shipped))
    best.sort()
    _, amount, unit, fit = best[0]
    unique = not any(f - fit < 0.05 and (u != unit or abs(math.log(a / amount)) > TWICE) for _, a, u, f in best[1:])
    return amount, unit, fit, unique


def quantity(option1: str | None, title: str | None, grams: float | None) -> tuple[int, str, float, bool] | None:
    """Of option1, or else of title: (whole amount, unit, residual, unique)."""
    for text in (option1, title):
        if text and (r := resolve(text, grams)) and (amount := math.floor(r[0] + 0.5)) > 0:
            return amount, *r[1:]
    return None


QUANTITY = "amount long, unit string, residual double, is_unique boolean"


def _quantities(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for option1, title, grams in batches:
        rows = [quantity(o, t, None if pd.isna(g) else float(g)) or (None, None, None, None) for o, t, g in zip(option1, title, grams)]
        out = pd.DataFrame(rows, columns=["amount", "unit", "residual", "is_unique"])
        out["amount"] = out["amount"].astype("Int64")
        yield out


def with_quantity(df: DataFrame, option1: str, title: str, grams: str) -> DataFrame:
    """``df`` with a struct column ``quantity`` (amount, unit, residual, is_unique); null where
    neither text states a weight or volume. Null and empty texts, lengths and bare counts give null."""
    read = F.pandas_udf(_quantities, QUANTITY)
    q = read(F.col(option1), F.col(title), F.col(grams).cast("double"))
    return df.withColumn("_q", q).withColumn("quantity", F.when(F.col("_q.amount").isNotNull(), F.col("_q"))).drop("_q")


def variant_quantities(records: DataFrame) -> DataFrame:
    """(variant_id, amount, unit, residual, is_unique) of every variant with a stated content.

    Texts repeat across deliveries, so distinct (variant, texts) are taken before Python sees them;
    of a variant whose texts differ between records the latest scrape counts.
    """
    from .nested import FlatTable, Level, flatten_table

    wanted = FlatTable([Level("payload.variants", "variant_pos")], {"variant_id": "id", "option1": "option1", "variant_title": "title", "grams": "grams"})
    flat = flatten_table(records, {"scraped_at": "ingest_meta.scraped_at"}, wanted).filter("variant_id is not null")
    last = flat.groupBy("variant_id", "option1", "variant_title", "grams").agg(F.max("scraped_at").alias("at"))
    told = with_quantity(last, "option1", "variant_title", "grams").filter("quantity is not null")
    w = Window.partitionBy("variant_id").orderBy(F.col("at").desc_nulls_last(), "option1", "variant_title", "grams")
    return told.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("variant_id", "quantity.*")

"""Trigram similarity of texts, all in builtin expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trigrams(text: Column) -> Column:
    """The set of trigrams: lower case, words of letters and digits, each padded by two blanks before
    and one after."""
    words = F.filter(F.split(F.lower(text), r"(?U)[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substr(w, i, F.lit(3))))))


def trigram_codes(text: Column) -> Column:
    """The same set, each trigram as one number made of its three code points: sets of numbers are smaller
    and quicker to intersect."""
    point = lambda g, i: F.ascii(F.substr(g, F.lit(i), F.lit(1))).cast("long")
    return F.transform(trigrams(text), lambda g: (point(g, 1) * (1 << 42)) + (point(g, 2) * (1 << 21)) + point(g, 3))


def set_similarity(a: Column, b: Column) -> Column:
    """Shared over all elements of two sets; 0 where both are empty, null where one is null."""
    shared = F.size(F.array_intersect(a, b))
    return F.when(a.isNull() | b.isNull(), None).otherwise(F.coalesce(shared / F.nullif(F.size(a) + F.size(b) - shared, F.lit(0)), F.lit(0.0)))


def similarity(a: Column, b: Column) -> Column:
    return set_similarity(trigrams(a), trigrams(b))


#: Words of a mark, of 64 bits each.
MARK = 2


def mark(codes: Column) -> Column:
    """A set of numbers as ``MARK`` numbers, every element setting one of their bits."""
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(64 * MARK)).cast("int")
    one = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit(c), F.lit(64)))
    word = lambda k: F.aggregate(codes, F.lit(0).cast("long"), lambda x, c: F.when(F.floor(bit(c) / 64) == k, x.bitwiseOR(one(c))).otherwise(x))
    return F.struct(F.size(codes).alias("n"), *[word(k).alias(f"w{k}") for k in range(MARK)])


def similarity_bound(a: Column, b: Column) -> Column:
    """What the similarity of two sets, not both empty, is at most, by their marks: a bit that only one has stands
    for an element that only one has."""
    lacks = lambda x, y: sum((F.bit_count(x[f"w{k}"].bitwiseAND(F.bitwise_not(y[f"w{k}"]))) for k in range(1, MARK)), F.bit_count(x["w0"].bitwiseAND(F.bitwise_not(y["w0"]))))
    shared = F.least(a["n"] - lacks(a, b), b["n"] - lacks(b, a))
    return shared / (a["n"] + b["n"] - shared)

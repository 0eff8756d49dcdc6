"""Listings of the same product, by bipartite reinforcement of terms and pairs.

A listing is read into terms: words of its title, maker, type, harvest year, form and net contents.
Listings with the same terms are one class. Classes that share two words, year and form are candidate
pairs. Then term weights and pair scores reinforce each other: a pair scores by the weight of the terms
it shares over that of all its terms, a term weighs as much as it is shared in the pairs that have it,
round by round through joins on terms until the weights stand still. So words of advertising, which
come and go between listings of one product, lose their weight, and words of items keep it. Pairs over
the threshold are matches if their contents agree, and are clustered.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import units
from ..session import checkpointed
from . import canonical, names
from .components import components

#: Words for a form.
FORMS = {
    "loose": r"loose[- ]?leaf|whole[- ]?leaf|loose",
    "cake": r"tea cake|bing ?cha|beeng(?: ?cha)?|bing|cake",
    "brick": r"tea brick|zhuan(?: ?cha)?|brick",
    "tuo": r"tuo ?cha|tuo",
    "pearls": r"dragon (?:balls|pearls)|long zhu|tea pearls|pearls",
    "tin": r"powder tin|tea powder|powder|tin",
}
_NUM_UNIT = units._MENTION.pattern.replace(f"({units._NUM})", f"(?:{units._NUM})").replace("([½¼¾⅓⅔⅛])", "[½¼¾⅓⅔⅛]").replace(f"({units._UNIT})", f"(?:{units._UNIT})")
_WORD_UNIT = re.sub(r"\((?!\?)", "(?:", units._WORD_NUM.pattern)
_HAN_UNIT = re.sub(r"\((?!\?)", "(?:", units._HAN_NUM.pattern)
_STATED = rf"(?:{_NUM_UNIT}|{_WORD_UNIT}|{_HAN_UNIT})"
_HOLDER = r"(?:cakes?|tuos?|bricks?|pcs?|pieces?|bags?|packs?|sachets?|pouch(?:es)?|tins?|balls?|boxes)"
_CONTENT = re.compile(
    # "6x 5g Dragon Balls" states pieces; "50 g Dragon Balls" states a form.
    rf"\b\d+\s*[x×*]\s*{_STATED}\s+dragon balls\b|"
    rf"(?:\b(?:approx\.?|ca\.?|about)\s*)?(?:\b\d+\s*{_HOLDER}\b\s*(?:of\b|@|,|/)?\s*|\b(?:pouch|bag)\s*-\s*|\bsachet\s*:\s*|\bbrick\s*(?=\[)|\b\d+\s*[x×*]\s*)?[\[(]?\s*{_STATED}\.?"
    rf"(?:\s*(?:/|-|–|\()\s*{_STATED}\.?\)?)?(?:\s*[x×*]\s*\d+\b(?:\s*(?:pcs?|pieces?)\b)?)?(?:\s+each\b)?(?:\s+bags?\b)?\s*[\])]?",
    re.I,
)
_YEAR = re.compile(r"(?<!\d)((?:19|20)\d\d)(?!\d)|[’'‘](\d\d)(?!\d)")
_FORM = re.compile("|".join(rf"(?P<{k}>\b(?:{v})\b)" for k, v in FORMS.items()), re.I)
_LINKING = frozenset("of the by from and with a an in for tea teas set".split())


_TITLE_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


@lru_cache(maxsize=100_000)
def _bare_word(word: str) -> str:
    return canonical.compact(canonical.spaced(word))


class TypeWords:
    """The names of types as titles write them, all from the reference list: whole names, and names
    without a last word that names of several entries end with ("White" for "White Tea")."""

    def __init__(self, names_of: list[tuple[int, str]]):
        whole = {(i, canonical.spaced(n)) for i, n in names_of if n}
        cut = {(i, tuple(n.split())) for i, n in names_of if n and len(n.split()) > 1}
        ends: dict[str, set[int]] = {}
        for i, words in cut:
            ends.setdefault(canonical.spaced(words[-1]), set()).add(i)
        heads: dict[str, set[int]] = {}
        for i, words in cut:
            if len(ends[canonical.spaced(words[-1])]) > 1 and (head := canonical.spaced(" ".join(words[:-1]))) not in ends:
                heads.setdefault(canonical.compact(head), set()).add(i)
        self.exact: dict[str, int] = {h: min(i) for h, i in heads.items() if len(i) == 1}
        self.exact |= {canonical.compact(n): i for i, n in sorted(whole, reverse=True)}
        self.longest = max((len(n.split()) for _, n in whole), default=0) + 1
        self.reference = canonical.Reference([(i, n) for i, n in names_of if n])
        self.tokens = canonical.Reference([(0, canonical.compact(canonical.spaced(w))) for _, n in names_of if n for w in n.split() if len(w) > 3])
        self._near = lru_cache(100_000)(self._near_window)
        # Whole names written as one word count as words, too.
        self._token = lru_cache(100_000)(lambda w: bool(self.tokens.candidates(w)) or bool(self.reference.candidates(w)))

    def _near_window(self, key: str) -> tuple[int, int] | None:
        """(edits, entry) of the closest name to a window of words, None if it is none's."""
        best = None
        for entry, s in self.reference.candidates(key):
            d = canonical.edits(key, canonical.compact(s))
            if 0 < d <= min(canonical.edits_allowed(key), canonical.edits_allowed(canonical.compact(s))) and (best is None or (d, entry) < best):
                best = (d, entry)
        return best

    def find(self, text: str, own: int = 0) -> tuple[int, int, int] | None:
        """(start, end, entry) of the words that name a type: those of the listing's own type before
        others, then more letters, an error costing two of them; later ones on ties."""
        words = [(m.start(), m.end(), _bare_word(m[0])) for m in _TITLE_WORD.finditer(text)]
        best = None
        for i in range(len(words)):
            key = ""
            for j in range(i, min(i + self.longest, len(words))):
                if j > i and text[words[j - 1][1] : words[j][0]].strip(" -"):
                    break
                # Every longer word of a name is one of the reference, or near one.
                if len(words[j][2]) > 3 and not self._token(words[j][2]):
                    break
                key += words[j][2]
                entry, off = self.exact.get(key), 0
                if entry is None and len(key) >= 6 and (near := self._near(key)):
                    off, entry = near
                if entry is not None:
                    rank = (entry == own, len(key) - 2 * off, words[i][0])
                    if best is None or rank > best[0]:
                        best = (rank, (words[i][0], words[j][1], entry))
        return best and best[1]


def contents(variants: list[tuple[str | None, str | None]], title: str | None) -> list[tuple[str, int]]:
    """The set of stated net contents, (unit, amount) in order; the title's where no variant states
    one."""
    stated = {(q[1], q[0]) for o, t in variants if (q := units.quantity(o, t, None))}
    if not stated and title and (q := units.quantity(None, _YEAR.sub(" ", title), None)):
        stated = {(q[1], q[0])}
    # Two spellings of one amount are one.
    out: list[tuple[str, int]] = []
    for unit, amount in sorted(stated):
        if not (out and out[-1][0] == unit and amount <= out[-1][1] * 1.03):
            out.append((unit, amount))
    return out


def same_contents(a: list[tuple[str, int]], b: list[tuple[str, int]]) -> bool:
    return len(a) == len(b) and all(x[0] == y[0] and abs(x[1] - y[1]) <= 0.03 * max(x[1], y[1]) for x, y in zip(a, b))


def read_title(title: str, types: TypeWords, own: int = 0) -> tuple[int | None, str | None, int, list[str]]:
    """(year, form, type id or 0, remaining words) of a title. The remaining words are those of the
    named item, of the maker and of advertising, lower case, in order, camel case and hyphens apart."""
    t = title.replace("“", '"').replace("”", '"')
    t = _CONTENT.sub(" | ", t)
    year = None
    if m := _YEAR.search(t):
        year = int(m[1]) if m[1] else (2000 if int(m[2]) < 60 else 1900) + int(m[2])
        t = t[: m.start()] + " | " + t[m.end() :]
    kind = 0
    # A type word is also an ordinary word ("White Crane"): find() says which one counts.
    if at := types.find(t, own):
        kind = at[2]
        t = t[: at[0]] + " | " + t[at[1] :]
    form = None
    found = sorted(_FORM.finditer(t), key=lambda m: -len(m[0]))
    if found:
        form = found[0].lastgroup
        t = t[: found[0].start()] + " | " + t[found[0].end() :]
    t = re.sub(r"(?<=[a-z]{3})(?=[A-Z][a-z])", " ", names.fold(t)).lower()
    t = re.sub(r"(?<=\w)'s?\b", "", t)
    return year, form, kind, re.findall(r"[^\W\d_]+\.?", t)


def split_words(rest: list[str], vendor: str | None, seller: bool) -> tuple[list[str], list[str]]:
    """(item words, maker words) of a title's remaining words, by the vendor field where it names a
    maker."""
    if not vendor or seller:
        return rest, []
    given, tokens, business = names.read_name(vendor)
    raw = [w for w in re.findall(r"[^\W\d_]+", names.fold(vendor).lower())]
    own, fuzzy = {w for w, _ in tokens} | set(raw) | {given}, [w for w, _ in tokens if len(w) >= 5]
    short = [w for w, cut in tokens if cut]
    near = []
    for w in rest:
        b = w.rstrip(".")
        cut = (w != b and any(o.startswith(b) for o in own)) or any(b.startswith(o) for o in short)
        near.append(b in own or cut or (5 <= len(b) <= names.LONG and any(names.edits_up_to(b, o, 2) <= 2 for o in fuzzy)))
    # A pet form of the given name is also an ordinary word ("Sandy Harbor"): it counts before a name.
    near = [n or (given and names._GIVEN.get(w) == given and any(near[i + 1 : i + 2])) for i, (w, n) in enumerate(zip(rest, near))]
    return [w for w, n in zip(rest, near) if not n], [w for w, n in zip(rest, near) if n]


def is_business(word: str) -> bool:
    w = word.rstrip(".")
    return w in names._BUSINESS or w in names._EMPTY or w in ("teahouse", "teaworks", "op", "int", "l")


class Spelling:
    """Item words by corpus frequency: a rare word close to a frequent one is that one misspelt, and so
    is, of two hardly used words one letter apart, the less used one. Counts are compared with each
    other only, so that the input's size decides nothing."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.by_delete: dict[str, list[str]] = {}
        for w in counts:
            for x in canonical.deletes(w, 1):
                self.by_delete.setdefault(x, []).append(w)

    def correct(self, word: str) -> list[str] | None:
        """The item word(s) meant, None if it is no item word."""
        word = word.rstrip(".")
        own = self.counts.get(word, 0)
        best = None
        if 4 <= len(word) <= names.LONG:
            for x in canonical.deletes(word, 1):
                for w in self.by_delete.get(x, ()):
                    if w != word and self.counts[w] >= 10 * own and self.counts[w] >= 3 and (d := canonical.edits(word, w)) <= (2 if len(w) >= 6 else 1):
                        key = (d, -self.counts[w], w)
                        best = key if best is None or key < best else best
        if best is None and own < 3 and 5 <= len(word) <= names.LONG:
            close = {w for x in canonical.deletes(word, 1) for w in self.by_delete.get(x, ()) if len(w) >= 5 and (self.counts[w], w) > (own, word) and canonical.edits(word, w) == 1}
            best = min(((1, -self.counts[w], w) for w in close), default=None)
        if best:
            return [best[2]]
        for i in range(3, len(word) - 2 if len(word) <= names.LONG else 0):
            if all(self.counts.get(w, 0) >= max(1, 10 * own) for w in (word[:i], word[i:])):
                return [word[:i], word[i:]]
        return [word] if own else None


#: Words of titles that are neither item nor maker.
NO_ITEM = sorted({*names._BUSINESS, *names._EMPTY, *_LINKING, "teahouse", "teaworks", "op", "int", "l"})


def _sources(records: DataFrame, vendor: DataFrame, reference: DataFrame) -> DataFrame:
    """(payload_id, title, vendor, seller, type_id, variants) of every listing's latest record."""
    base = canonical.latest_listings(records, "title", "vendor", "product_type", "variants")
    base = base.withColumn("variants", F.transform("variants", lambda v: F.struct(v["option1"].alias("o"), v["title"].alias("t"))))
    told = canonical.map_values(base, "product_type", reference, "type_id", "type_name", "aka").select(F.col("value").alias("product_type"), F.col("entry").alias("type_id"))
    sellers = vendor.select(F.lower(F.trim("display_name")).alias("_s")).filter("_s is not null").distinct().withColumn("seller", F.lit(True))
    out = base.join(told, "product_type", "left").withColumn("_s", F.lower(F.trim("vendor"))).join(sellers, "_s", "left")
    blank = F.coalesce(F.regexp_replace("vendor", r"(?U)\s+", "") == "", F.lit(True))
    return out.select("payload_id", "title", F.when(~blank, F.col("vendor")).alias("vendor"), F.coalesce("seller", F.lit(False)).alias("seller"), F.coalesce("type_id", F.lit(0).cast("long")).alias("type_id"), "variants")


READ = "payload_id long, vendor string, seller boolean, type_id long, year int, form string, title_type long, item array<string>, maker array<string>, contents array<string>"


def type_names(reference: DataFrame) -> list[tuple[int, str]]:
    """(type_id, name) of a reference (type_id, type_name, aka), which every worker gets: a list that
    people choose from, at most ``canonical.BROADCAST_NAMES`` names; a longer one raises ``ValueError``."""
    listed = [(r["entry"], r["name"]) for r in canonical._names(reference, "type_id", "type_name", "aka").limit(canonical.BROADCAST_NAMES + 1).collect()]
    if len(listed) > canonical.BROADCAST_NAMES:
        raise ValueError(f"more than {canonical.BROADCAST_NAMES} names of types")
    return listed


def _read(listings: DataFrame, reference: DataFrame) -> DataFrame:
    shared = listings.sparkSession.sparkContext.broadcast(type_names(reference))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        types = TypeWords(shared.value)
        for b in batches:
            rows = []
            for p, title, vendor, seller, type_id, variants in zip(b["payload_id"], b["title"], b["vendor"], b["seller"], b["type_id"], b["variants"]):
                year, form, kind, rest = read_title(title, types, type_id) if title else (None, None, 0, [])
                item, maker = split_words(rest, vendor, seller)
                own = [] if variants is None else [(v["o"], v["t"]) for v in variants if v is not None]
                rows.append((p, vendor, seller, type_id, year, form, kind, item, maker, [f"{u}:{a}" for u, a in contents(own, title)]))
            out = pd.DataFrame(rows, columns=["payload_id", "vendor", "seller", "type_id", "year", "form", "title_type", "item", "maker", "contents"])
            out["year"] = out["year"].astype("Int32")
            yield out

    return listings.mapInPandas(run, READ)


def _bare(word: str) -> Column:
    return F.regexp_replace(word, r"\.$", "")


def _used_words(read: DataFrame, producer: DataFrame) -> DataFrame:
    """(word, role, n): words of items with the listings that use them, of those whose vendor field names
    a maker, and words of makers' names with the listings and entries that hold them."""

    def spoken(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name, n in zip(b["name"], b["n"]):
                own = {*re.findall(r"[^\W\d_]+", names.fold(name).lower()), names.read_name(name)[0]}
                rows.extend((w, n) for w in own if len(w) >= 2)
            yield pd.DataFrame(rows, columns=["word", "n"])

    named = read.filter(F.col("vendor").isNotNull() & ~F.col("seller"))
    item = named.select(F.explode(F.array_distinct("item")).alias("w")).select(_bare("w").alias("word"), F.lit(1).cast("long").alias("n"))
    typed = named.select(F.col("vendor").alias("name")).unionByName(producer.select(F.col("canonical_name").alias("name"))).unionByName(producer.select(F.explode("aliases").alias("name")))
    maker = typed.filter("name is not null").groupBy("name").agg(F.count(F.lit(1)).alias("n")).mapInPandas(spoken, "word string, n long")
    both = item.withColumn("role", F.lit("item")).unionByName(maker.withColumn("role", F.lit("maker")))
    return both.filter(~F.col("word").isin(NO_ITEM)).groupBy("word", "role").agg(F.sum("n").alias("n"))


def _meant(word: str, item: dict[str, int], maker: dict[str, int]) -> tuple[list[str], str | None]:
    """(item words meant, role) of a title word, by the item and maker words that it may be; no role
    where it is like none of them."""
    as_item, as_maker = Spelling(item).correct(word), Spelling(maker).correct(word)
    said = max((item[w] for w in as_item), default=0) if as_item else 0
    named = max((maker[w] for w in as_maker), default=0) if as_maker else 0
    role = None
    if word in item or word in maker:
        own = item.get(word, 0)
        role = "item" if own >= maker.get(word, 0) and not (word not in maker and own < 3 and said <= own and named >= 10 * own) else "maker"
    elif as_item or as_maker:
        role = "item" if said >= named else "maker"
    return as_item or [word], role


def word_meanings(read: DataFrame, producer: DataFrame) -> DataFrame:
    """(word, meant, role) of every title word. Words meet the item and maker words that have a single
    delete in common with them, or that are a half of them, in joins; nothing is cut by how often it is
    used."""
    used = checkpointed(_used_words(read, producer))
    words = read.select(F.explode("item").alias("w")).select(_bare("w").alias("word")).filter(~F.col("word").isin(NO_ITEM)).distinct()
    n = F.length("word")
    deletes = F.expr("transform(sequence(1, length(word)), i -> concat(substring(word, 1, i - 1), substring(word, i + 1)))")
    whole = F.array("word")
    keyed = lambda df: df.withColumn("key", F.explode(F.when(n.between(3, names.LONG), F.array_union(whole, deletes)).otherwise(whole)))
    halves = words.filter(n.between(6, names.LONG)).select("word", F.explode(F.expr("flatten(transform(sequence(3, length(word) - 3), i -> array(substring(word, 1, i), substring(word, i + 1))))")).alias("other"))
    near = keyed(words).join(keyed(used).withColumnRenamed("word", "other"), "key").select("word", "other", "role", "n")
    near = near.unionByName(halves.join(used.withColumnRenamed("word", "other"), "other").select("word", "other", "role", "n"))
    found = near.groupBy("word").agg(F.collect_set(F.struct("other", "role", "n")).alias("near"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for word, close in zip(b["word"], b["near"]):
                by_role: dict[str, dict[str, int]] = {"item": {}, "maker": {}}
                for c in [] if close is None else close:
                    by_role[c["role"]][c["other"]] = c["n"]
                rows.append((word, *_meant(word, by_role["item"], by_role["maker"])))
            yield pd.DataFrame(rows, columns=["word", "meant", "role"])

    told = checkpointed(words.join(found, "word", "left").mapInPandas(run, "word string, meant array<string>, role string"))
    # What a word is corrected to may be a spelling that is corrected itself.
    again = told.select(F.array("word").alias("meant"), F.col("meant").alias("then"))
    return told.join(again, "meant", "left").select("word", F.coalesce("then", "meant").alias("meant"), "role")


def item_and_maker(words: list[tuple[str, list[str] | None, str | None]], named: bool) -> tuple[list[str], list[str]]:
    """(item words, words of the maker's name) of (title word, item words meant, role) in order. Where the
    vendor field names the maker, all words are the item's. Else a word's role tells; a given name is the
    maker's before a word of the maker's; words like no others are the maker's if the title says that it
    names one (by "by", "from" or a kind of business) and no known one is there, else the item's."""
    roles = ["business" if is_business(w) else "none" if w.rstrip(".") in _LINKING or (len(w.rstrip(".")) == 1 and w.isascii()) else "item" if named else r for w, _, r in words]
    if not named:
        says = any(w in ("by", "from") or (r == "business" and w.rstrip(".") not in ("tea", *names._EMPTY)) for (w, _, _), r in zip(words, roles))
        unknown = "maker" if says and "maker" not in roles else "item"
        roles = [r or unknown for r in roles]
        for i in range(len(words) - 2, -1, -1):
            if words[i][0] in names._GIVEN:
                roles[i] = "maker" if roles[i + 1] == "maker" else "item"
    item = {m for (w, meant, _), r in zip(words, roles) if r == "item" for m in (meant or [w.rstrip(".")])}
    # Words of business belong to a name only where they stand in a row with one ("Limited Edition").
    maker: list[str] = []
    for is_item, run in groupby(zip(words, roles), key=lambda x: x[1] == "item"):
        row = [] if is_item else [(w, r) for (w, _, _), r in run]
        if any(r == "maker" for _, r in row):
            maker += [w for w, r in row if r != "none" or w.rstrip(".") not in _LINKING]
    return sorted(item - _LINKING), maker


def _settled(read: DataFrame, producer: DataFrame) -> DataFrame:
    """Item words corrected, the maker's name as typed, and the type, for every listing."""
    placed = read.select("payload_id", F.posexplode("item").alias("at", "w")).withColumn("word", _bare("w")).join(word_meanings(read, producer), "word", "left")
    placed = placed.groupBy("payload_id").agg(F.sort_array(F.collect_list(F.struct("at", "w", "meant", "role"))).alias("words"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            item, maker, kind, told_kind = [], [], [], []
            stated = b["form"].notna() | (b["contents"].str.len() > 0)
            for vendor, seller, type_id, title_type, words, more in zip(b["vendor"], b["seller"], b["type_id"], b["title_type"], b["words"], stated):
                told = [] if words is None else [(x["w"], None if x["meant"] is None else list(x["meant"]), x["role"]) for x in words]
                known, named = item_and_maker(told, vendor is not None and not seller)
                if vendor is not None and not seller:
                    typed = vendor
                else:
                    typed = " ".join(named) if any(not is_business(w) and len(w.rstrip(".")) > 1 for w in named) else None
                item.append(known)
                maker.append(typed)
                # A type's word alone in a title ("White Label Service") is no type, a form or contents are.
                kind.append(type_id or (title_type if more else 0))
                told_kind.append(title_type)
            yield pd.DataFrame({"payload_id": b["payload_id"], "item": item, "maker_name": maker, "type_id": kind, "title_type": told_kind, "year": b["year"].astype("Int32"), "form": b["form"], "contents": b["contents"]})

    full = read.drop("item", "maker").join(placed, "payload_id", "left")
    return full.mapInPandas(run, "payload_id long, item array<string>, maker_name string, type_id long, title_type long, year int, form string, contents array<string>")


def settled_listings(records: DataFrame, producer: DataFrame, vendor: DataFrame, reference: DataFrame) -> DataFrame:
    """(payload_id, maker, item, type_id, year, form, contents): every listing whose title names an item,
    and that names a known maker or a type. ``item`` holds all words of the title that are not the maker's or
    the type's, those of advertising, too."""
    read = checkpointed(_read(_sources(records, vendor, reference), reference))
    settled = checkpointed(_settled(read, producer))
    # A maker read from a title is known if a producer's entry or a vendor field names it, too.
    known = names.maker_names(producer, records).withColumn("known", F.lit(True))
    makers = known.unionByName(settled.filter("maker_name is not null").select(F.col("maker_name").alias("name"), F.lit(False).alias("known")))
    makers = checkpointed(makers.groupBy("name").agg(F.max("known").alias("known")))
    linked = checkpointed(names.link_names(makers.select("name")).join(makers, "name"))
    linked = linked.join(linked.groupBy("entity").agg(F.max("known").alias("known_maker")), "entity").select(F.col("name").alias("maker_name"), F.col("entity").alias("maker"), "known_maker")
    full = settled.join(linked, "maker_name", "left")
    kind = F.when((F.col("type_id") == 0) & F.col("known_maker"), F.col("title_type")).otherwise(F.col("type_id"))
    full = full.withColumn("type_id", kind).filter((F.size("item") >= 1) & (F.coalesce("known_maker", F.lit(False)) | (F.col("type_id") > 0)))
    return checkpointed(full.drop("maker_name", "title_type", "known_maker"))


def _unit(content: Column) -> Column:
    return F.substring_index(content, ":", 1)


def _amount(content: Column) -> Column:
    return F.substring_index(content, ":", -1).cast("double")


#: Sharing pairs that every term is credited with, so that few pairs say little against it.
PRIOR = 2.0
#: A word is of a listing's core if at least this share of the listings alike has it, too.
CORE = 0.3


def kept_words(listings: DataFrame) -> DataFrame:
    """(word, kept): how likely a listing that shares one word with another, and is alike in all but its
    words (maker, type, year, form, contents), has a further word of it, too, over all pairs of such
    listings; counted, no pair is made. Words of an item are kept, those of advertising come and go. A
    word never seen in such listings is kept."""
    alike = ["maker", "type_id", "year", "form", "contents"]
    known = listings.filter("maker is not null").select(F.xxhash64(F.to_json(F.struct(*alike), {"ignoreNullFields": "false"})).alias("g"), "item")
    by = known.select("g", "item", F.explode("item").alias("by"))
    sizes = by.groupBy("g", "by").agg(F.count(F.lit(1)).cast("double").alias("all")).filter("all > 1")
    words = by.select("g", "by", F.explode("item").alias("word")).filter("word <> by").groupBy("g", "by", "word").agg(F.count(F.lit(1)).cast("double").alias("n"))
    pairs = words.join(sizes, ["g", "by"]).groupBy("word").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("both"), F.sum(F.col("n") * (F.col("all") - 1)).alias("any"))
    return pairs.select("word", ((F.col("both") + PRIOR) / (F.col("any") + PRIOR)).alias("kept"))


WHAT = ["maker", "item", "core", "type_id", "year", "form", "contents"]


def listing_classes(listings: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, classes): members (payload_id, class) and classes (class long, what it is, leader).

    Listings that read exactly alike, word by word, are one class. Classes that differ only in words
    outside the core have one leader, the one with the fewest words."""
    loose = kept.filter(F.col("kept") < CORE).select("word", F.lit(True).alias("loose"))
    words = listings.select("payload_id", F.explode("item").alias("word")).join(loose, "word", "left").filter("loose is null")
    core = words.groupBy("payload_id").agg(F.sort_array(F.collect_set("word")).alias("core"))
    full = listings.join(core, "payload_id", "left").withColumn("core", F.coalesce("core", "item"))
    # Null-safe: a class is named by what it is, printed with nulls.
    named = lambda *fields: F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))
    full = checkpointed(full.withColumn("name", named(*WHAT)))
    classes = full.groupBy("name").agg(*[F.first(w).alias(w) for w in WHAT])
    # Numbers are short and, once written, fixed.
    classes = checkpointed(classes.withColumn("class", F.monotonically_increasing_id()).withColumn("kin", named(*[w for w in WHAT if w != "item"])))
    leaders = classes.groupBy("kin").agg(F.min(F.struct(F.size("item").alias("n"), "item", "class")).alias("m")).select("kin", F.col("m.class").alias("leader"))
    classes = checkpointed(classes.join(leaders, "kin").drop("kin"))
    return full.select("payload_id", "name").join(classes.select("name", "class"), "name").select("payload_id", "class"), classes.drop("name")


def candidate_pairs(classes: DataFrame) -> DataFrame:
    """(a, b): every class with its leader, and leaders that share two core words (or their only one),
    year, form and, where both are known, the maker. Exact copies are one class already, and what
    differs in loose words meets its leader only, so a block holds one row per core."""
    led = classes.filter("class <> leader").select(F.least("class", "leader").alias("a"), F.greatest("class", "leader").alias("b"))
    n = F.size("core")
    combos = F.flatten(F.transform("core", lambda x, i: F.transform(F.slice("core", i + 2, n), lambda y: F.concat_ws(" ", x, y))))
    key = F.explode(F.when(n == 1, F.col("core")).otherwise(combos))
    keyed = classes.filter("class = leader").select("class", "maker", key.alias("k"), F.coalesce("year", F.lit(0)).alias("y"), F.coalesce("form", F.lit("")).alias("f"))
    other = keyed.select(F.col("class").alias("b"), F.col("maker").alias("other"), "k", "y", "f")
    mine = keyed.withColumnRenamed("class", "a")
    known = mine.filter("maker is not null").join(other.filter("other is not null").withColumnRenamed("other", "maker"), ["maker", "k", "y", "f"]).filter("a < b").select("a", "b")
    unknown = mine.filter("maker is null").join(other, ["k", "y", "f"]).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return led.unionByName(known).unionByName(unknown).distinct()


def same_contents_columns(p: Column, q: Column) -> Column:
    """The exact check of a match: the same set of stated contents, within 3 percent."""
    near = F.forall(F.arrays_zip(p.alias("p"), q.alias("q")), lambda z: (_unit(z["p"]) == _unit(z["q"])) & (F.abs(_amount(z["p"]) - _amount(z["q"])) <= 0.03 * F.greatest(_amount(z["p"]), _amount(z["q"]))))
    return (F.size(p) == F.size(q)) & F.coalesce(near, F.lit(True))


def word_term(word: Column) -> Column:
    return F.xxhash64(F.lit("word"), word)


def pair_terms(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(pair, term, name, side) of the bipartite graph: words (name true) and, as terms of what a listing
    is, maker, type and set of contents; side 3 for terms of both classes, 1 and 2 for those of one.
    What one of them does not state gives no term, and says nothing against the other class's."""
    stated = F.when(F.size("contents") > 0, F.col("contents"))
    own = classes.select("class", "item", F.struct("maker", F.when(F.col("type_id") > 0, F.col("type_id")).alias("type"), stated.alias("contents")).alias("kind"))
    both = pairs.join(own.select(F.col("class").alias("a"), F.col("item").alias("ia"), F.col("kind").alias("ka")), "a").join(own.select(F.col("class").alias("b"), F.col("item").alias("ib"), F.col("kind").alias("kb")), "b")
    sided = lambda words, side: F.transform(words, lambda w: F.struct(word_term(w).alias("term"), F.lit(True).alias("name"), F.lit(side).alias("side")))
    words = F.concat(sided(F.array_intersect("ia", "ib"), 3), sided(F.array_except("ia", "ib"), 1), sided(F.array_except("ib", "ia"), 2))

    def kind(field: str, same=lambda x, y: x == y) -> Column:
        x, y = F.col(f"ka.{field}"), F.col(f"kb.{field}")
        one = lambda v, side: F.struct(F.xxhash64(F.lit(field), v).alias("term"), F.lit(False).alias("name"), F.lit(side).alias("side"))
        none = F.array().cast("array<struct<term:long,name:boolean,side:int>>")
        return F.when(x.isNull() | y.isNull(), none).when(same(x, y), F.array(one(x, 3))).otherwise(F.array(one(x, 1), one(y, 2)))

    terms = both.select("pair", F.explode(F.concat(words, kind("maker"), kind("type"), kind("contents", same_contents_columns))).alias("t"))
    return terms.select("pair", "t.*")


def reinforce(terms: DataFrame, start: DataFrame | None = None, tolerance: float = 0.01, rounds: int = 60) -> DataFrame:
    """(pair, score) after term weights and pair scores have reinforced each other.

    A pair scores by the share of shared weight in that of its words, times the same share of what its
    classes are. A term weighs as much as it is shared in the pairs that have it, pairs counting by the
    fourth power of their scores, so that likely matches tell; what ``start`` (term, w) says of it,
    1 for others, counts as much as ``PRIOR`` matches. The first scores are by these weights.
    Ends when no weight moves by more than ``tolerance``. Weights that still move after ``rounds`` are
    reported by a warning; with 0 rounds all weights stay equal."""

    def scored(weights: DataFrame | None) -> DataFrame:
        e = terms.withColumn("w", F.lit(1.0)) if weights is None else terms.join(weights, "term", "left").withColumn("w", F.coalesce("w", F.lit(1.0)))

        def part(name: bool) -> Column:
            both, left, right = (F.sum(F.when((F.col("side") == s) & (F.col("name") == name), F.col("w")).otherwise(0.0)) for s in (3, 1, 2))
            whole = both + F.greatest(left, right)
            return F.when(whole > 0, both / whole).otherwise(1.0)

        own = F.collect_list(F.struct("term", "side"))
        return e.groupBy("pair").agg((part(True) * part(False)).alias("score"), own.alias("terms"))

    weights, moved = start if rounds else None, None
    known = None if start is None else start.select("term", F.col("w").alias("first"))
    for _ in range(rounds):
        told = scored(weights).select(F.pow("score", F.lit(4)).alias("e"), F.inline("terms"))
        heard = told.groupBy("term").agg(F.sum(F.when(F.col("side") == 3, F.col("e")).otherwise(0.0)).alias("shared"), F.sum("e").alias("any"))
        heard = heard.withColumn("first", F.lit(1.0)) if known is None else heard.join(known, "term", "left").withColumn("first", F.coalesce("first", F.lit(1.0)))
        new = heard.select("term", ((F.col("shared") + PRIOR * F.col("first")) / (F.col("any") + PRIOR)).alias("w"))
        new = new.withColumn("old", F.lit(1.0)) if weights is None else new.join(weights.select("term", F.col("w").alias("old")), "term", "left")
        weights = checkpointed(new)
        moved = weights.agg(F.max(F.abs(F.col("w") - F.coalesce("old", F.lit(1.0)))).alias("m")).first()["m"]
        weights = weights.select("term", "w")
        if moved is None or moved <= tolerance:
            break
    else:
        if rounds:
            warnings.warn(f"term weights still move by {moved:.3f} after {rounds} rounds", stacklevel=2)
    return scored(weights).select("pair", "score")


#: Score above which a pair is a match.
MATCH = 0.75


def matched_classes(classes: DataFrame, kept: DataFrame, match: float = MATCH, rounds: int = 60) -> DataFrame:
    """(a, b) of classes of one product: pairs whose converged score reaches ``match``, less those whose
    contents differ. ``kept`` (word, kept) are the weights to start from."""
    pairs = checkpointed(candidate_pairs(classes).withColumn("pair", F.monotonically_increasing_id()))
    start = kept.select(word_term(F.col("word")).alias("term"), F.col("kept").alias("w"))
    scored = reinforce(checkpointed(pair_terms(pairs, classes)), start, rounds=rounds).filter(F.col("score") >= match)
    held = classes.select("class", "contents")
    checked = pairs.join(scored, "pair").join(held.select(F.col("class").alias("a"), F.col("contents").alias("ca")), "a").join(held.select(F.col("class").alias("b"), F.col("contents").alias("cb")), "b")
    return checked.filter(same_contents_columns(F.col("ca"), F.col("cb"))).select("a", "b")


def product_groups(records: DataFrame, producer: DataFrame, vendor: DataFrame, reference: DataFrame, match: float = MATCH) -> DataFrame:
    """(payload_id, product): listings of one product have one product id. Listings whose title names
    no item (and null titles) are left out; a product listed once is a group of one. An empty input
    gives none."""
    settled = settled_listings(records, producer, vendor, reference)
    kept = checkpointed(kept_words(settled))
    members, classes = listing_classes(settled, kept)
    grouped = components(matched_classes(classes, kept, match))
    return members.join(grouped.withColumnRenamed("node", "class"), "class", "left").select("payload_id", F.coalesce("component", "class").alias("product"))


def listing_pairs(groups: DataFrame) -> DataFrame:
    """(payload_id_a, payload_id_b), smaller id first: all pairs of listings of one product."""
    a = groups.select("product", F.col("payload_id").alias("payload_id_a"))
    b = groups.select("product", F.col("payload_id").alias("payload_id_b"))
    return a.join(b, "product").filter("payload_id_a < payload_id_b").select("payload_id_a", "payload_id_b")

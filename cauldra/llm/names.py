"""Variant spellings of names: one entity per group of spellings.

A name is read into a form: given name (nicknames resolved), further name tokens (sorted), and the
kind of business. Forms meet in blocks named by phonetic codes of their sorted tokens, with up to two
symbols left out so that typing errors still meet; pairs are compared token by token with Jaro-Winkler
similarity and edit distance, accepted pairs are clustered by connected components.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .canonical import edits
from .components import components

#: Short and pet forms of given names.
NICKNAMES = {
    "alexander": "alex sasha al xander sandy lex",
    "benjamin": "ben benny benji",
    "christopher": "chris kit topher",
    "elizabeth": "beth liz lizzie betty eliza lisa bess betsy libby",
    "frederick": "fred freddy freddie rick",
    "gabrielle": "gabby elle gabi brielle",
    "josephine": "jo josie posy",
    "katherine": "kate kathy kat katie kitty cathy",
    "leonard": "leo len lenny",
    "margaret": "maggie meg peggy greta madge marge",
    "nathaniel": "nate nat nathan",
    "robert": "rob bob bobby robbie bert",
    "susannah": "sue susie suzy susan sanna",
    "theodore": "ted theo teddy",
    "victoria": "vicky tori vic vicki",
    "william": "will bill billy liam willy",
    "michael": "mike mick mickey",
    "richard": "rich dick rick",
    "james": "jim jimmy jamie",
    "john": "jack johnny",
    "edward": "ed eddie ned",
    "charles": "charlie chuck",
    "thomas": "tom tommy",
    "anthony": "tony",
    "patricia": "pat patty trish",
    "jennifer": "jen jenny",
    "samuel": "sam sammy",
    "daniel": "dan danny",
    "matthew": "matt",
    "andrew": "andy drew",
}
_GIVEN = {n: full for full, short in NICKNAMES.items() for n in (full, *short.split())}

#: Words of business names and their abbreviations.
BUSINESS = {
    "tea": "teas",
    "company": "co comp cmpny",
    "house": "hse",
    "cooperative": "coop coöp",
    "manufacturing": "mfg manuf manufg mfrs",
    "workshop": "wkshp wksp wkshop",
    "estate": "est estates",
    "studio": "std stud studios",
    "factory": "fac fty fcty fact",
    "brothers": "bros bro",
    "works": "wks wrks",
    "gardens": "gdns gdn grdns",
    "group": "grp",
    "limited": "ltd",
    "trading": "trad trdg trd",
    "association": "assn assoc asso",
    "international": "intl int",
    "farmers": "farmer frmrs",
    "official": "",
    "incorporated": "inc",
    "corporation": "corp",
}
_BUSINESS = {w: full for full, short in BUSINESS.items() for w in (full, *short.split())}
_LONG_BUSINESS = [w for w in BUSINESS if len(w) >= 5]
_EMPTY = frozenset("the of and by from & official".split())
_JOINED = {"teahouse": ("tea", "house"), "teaworks": ("tea", "works"), "co-op": ("cooperative",), "coop": ("cooperative",), "int'l": ("international",)}

#: A name token with a full stop of at most so many letters is an abbreviation (one letter over for a
#: typing error); so is any token of at most two letters.
SHORT = 5
#: Longer tokens are no words a typing error is looked for in: they must be equal.
LONG = 64
#: Names of fewer letters say too little when run together.
JOINED = 8
#: Jaro-Winkler similarity that two tokens need.
TOKEN_SIMILARITY = 0.80


def fold(text: str) -> str:
    t = unicodedata.normalize("NFKD", text)
    return unicodedata.normalize("NFC", "".join(c for c in t if not unicodedata.combining(c)))


def read_name(text: str) -> tuple[str, list[tuple[str, bool]], list[str]]:
    """(given name or "", [(token, abbreviated)], business words) of a name."""
    t = re.sub(r"(?<=[a-z])(?=[A-Z][a-z]{2})", " ", fold(text).replace("’", "'")).lower()
    t = re.sub(r"\bco-op\b", "coop", t)
    t = re.sub(r"\bint'l\b", "intl", t)
    t = re.sub(r"(?<=\w)'(?=s?\b)", "", t)
    tokens: list[tuple[str, bool]] = []
    business: list[str] = []
    given = ""
    for m in re.finditer(r"[^\W_]+", t):
        w = m[0]
        dotted = t[m.end() : m.end() + 1] == "."
        if w in _EMPTY:
            continue
        if w in _JOINED:
            business.extend(_JOINED[w])
        elif w in _BUSINESS:
            business.append(_BUSINESS[w])
        elif 5 <= len(w) <= 20 and (near := [b for b in _LONG_BUSINESS if w[0] == b[0] and edits_up_to(w, b, 2) <= (1 if len(b) <= 6 else 2)]):
            business.append(near[0])
        elif not given and w in _GIVEN:
            given = _GIVEN[w]
        else:
            tokens.append((w, (dotted and len(w) <= SHORT) or len(w) <= 2))
    if not tokens and not given:
        tokens = [(w, False) for w in business] or [(t.strip(), False)]
        business = []
    return given, tokens, sorted(set(business))


_ALIKE = str.maketrans("cqzwyeu", "kksviio")
_SOUNDS = str.maketrans("cqzw", "kksv")
_VOWELS = frozenset("aeiouy")


def alike(token: str) -> str:
    """Letters that sound alike are one. Doubled letters stay: leaving one out is one of the cuts."""
    return token.replace("ph", "f").replace("ck", "k").translate(_ALIKE)


def phonetic(token: str) -> str:
    """The phonetic code: consonants that sound alike are one, doubled letters single, vowels left out
    but for a mark of one that begins the token. Letters of other scripts are their own code."""
    t = token.replace("ph", "f").replace("ck", "k").translate(_SOUNDS)
    single = (c for i, c in enumerate(t) if not i or t[i - 1] != c)
    return "".join(c if c not in _VOWELS else "" if i else "a" for i, c in enumerate(single))


def cuts(code: str, n: int) -> list[set[str]]:
    """The codes that leaving out 0, 1 ... n symbols gives."""
    out = [{code}]
    for _ in range(n):
        out.append({c[:i] + c[i + 1 :] for c in out[-1] for i in range(len(c))} - out[-1])
    return out


def block_keys(given: str, tokens: list[tuple[str, bool]]) -> list[tuple[str, int, str]]:
    """(block, role, rest) of a form. Blocks are named by phonetic codes of sorted tokens, with symbols
    left out for typing errors:

    role 0: of every two tokens written in full the codes, up to two symbols left out of both; a name of
    one token is its letters that way. Two forms of role 0 meet.
    role 1, 2: of a token in full the code, up to one symbol left out, and the first letter of another
    one, which is the rest. Role 1 is a form whose only token in full stands beside an abbreviation;
    it meets forms of role 2, which are all.
    role 3, 4: all letters sorted, up to one left out, and a number of tokens. A form of role 3 has one
    token less than one of role 4, so names run together meet those written apart, in whatever order.
    role 5, 6: of every two tokens the first two letters. Role 5 is a form with an abbreviation, which
    meets those of role 6, all forms, so that different tokens of the two may be abbreviated."""
    named = [given] if given and len(tokens) < 2 else []
    full = [w for w, short in tokens if not short] + named
    keys: set[tuple[str, int, str]] = set()
    codes = {w: cuts(phonetic(w), 2 if len(w) <= LONG else 0) for w in full}
    for x, y in combinations(full, 2):
        for i, left in enumerate(codes[x]):
            for right in codes[y][: 3 - i]:
                keys.update((f"={min(c, d)} {max(c, d)}", 0, "") for c in left for d in right)
    if len(full) == 1 and len(tokens) == 1:
        w = alike(full[0])
        keys.update((f"={c}", 0, "") for some in cuts(w, (2 if len(w) >= 5 else 1) if len(w) <= LONG else 0) for c in some)
    for i, a in enumerate(full):
        for o, short in [*((w, s) for w, s in tokens if w is not a), *((g, False) for g in named if g is not a)]:
            own = [f"-{c}|{o[:1]}" for some in codes[a][:2] for c in some]
            keys.update((c, 2, o) for c in own)
            if short and len(full) == 1:
                keys.update((c, 1, o) for c in own)
    for (x, a), (y, b) in combinations([*tokens, *((g, False) for g in named)], 2):
        if min(len(x), len(y)) >= 2:
            key = f"~{min(x[:2], y[:2])} {max(x[:2], y[:2])}"
            keys.update((key, role, "") for role in ((5, 6) if a or b else (6,)))
    letters = "".join(sorted(alike("".join(w for w, _ in tokens))))
    if len(letters) >= JOINED and len(full) - len(named) == len(tokens):
        # Leaving out either of two equal letters is the same.
        once = {letters} | {letters[:i] + letters[i + 1 :] for i in range(len(letters)) if not i or letters[i] != letters[i - 1]}
        for role, n in ((3, len(tokens)), (4, len(tokens) - 1)):
            keys.update((f"+{n} {c}", role, "") for c in once)
    return sorted(keys)


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    hit_b = [False] * len(b)
    common = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not hit_b[j] and b[j] == x:
                hit_b[j] = True
                common.append(x)
                break
    m = len(common)
    if not m:
        return 0.0
    other = [c for c, hit in zip(b, hit_b) if hit]
    swaps = sum(x != y for x, y in zip(common, other)) / 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro)


@lru_cache(maxsize=200_000)
def _letters(token: str) -> int:
    """One bit for each kind of letter."""
    bits = 0
    for c in token:
        bits |= 1 << ord(c) % 61
    return bits


def edits_up_to(a: str, b: str, most: int) -> int:
    """Edits of two tokens, or some number above ``most``. An edit takes away one kind of letter and adds
    another at most."""
    if abs(len(a) - len(b)) > most or (_letters(a) ^ _letters(b)).bit_count() > 2 * most:
        return most + 1
    return edits(a, b)


def _token_score(a: tuple[str, bool], b: tuple[str, bool]) -> tuple[float, int] | None:
    """(similarity, edits) of two tokens that may be one, None if they may not."""
    (x, xs), (y, ys) = a, b
    if x == y:
        return 1.0, 0
    if max(len(x), len(y)) > LONG:
        return None
    if xs or ys:
        short, long = (x, y) if xs else (y, x)
        if long.startswith(short):
            return 0.95, 0
        # An abbreviation may be misspelt, too.
        if len(short) >= 3 and short[0] == long[0] and any(edits_up_to(short, long[:n], 1) <= 1 for n in range(len(short) - 1, len(short) + 2)):
            return 0.9, 1
        return None
    most = 2 if min(len(x), len(y)) >= 5 else 1
    if (d := edits_up_to(x, y, most)) > most:
        return None
    s = jaro_winkler(x, y)
    return (s, d) if s >= TOKEN_SIMILARITY or (d == 1 and len(x) >= 5) else None


def _assigned(left: list[tuple[str, bool]], right: list[tuple[str, bool]]) -> list[tuple[int, float]]:
    """(edits, least similarity) of the ways to pair off as many tokens on either side, up to three edits;
    equal tokens are paired first, and of ways through the same tokens the best one is kept."""
    open_right, rest = list(right), []
    for x in left:
        if x in open_right:
            open_right.remove(x)
        else:
            rest.append(x)
    states: dict[int, dict[int, float]] = {0: {0: 1.0}}
    for x in rest:
        ways: dict[int, dict[int, float]] = {}
        for j, y in enumerate(open_right):
            if t := _token_score(x, y):
                for taken, by_edits in states.items():
                    for off, s in by_edits.items() if not taken >> j & 1 else ():
                        if off + t[1] <= 3:
                            now = ways.setdefault(taken | 1 << j, {})
                            now[off + t[1]] = max(now.get(off + t[1], 0.0), min(s, t[0]))
        states = ways
    return [w for by_edits in states.values() for w in by_edits.items()]


def _laid_out(text: str, parts: list[str], errors: int) -> bool:
    """Whether some order of all parts gives the text, with at most so many edits."""
    if not parts:
        return len(text) <= errors
    for i, p in enumerate(parts):
        rest = parts[:i] + parts[i + 1 :]
        if text.startswith(p) and _laid_out(text[len(p) :], rest, errors):
            return True
        if errors and len(p) <= LONG and any(edits_up_to(p, text[:n], 1) == 1 and _laid_out(text[n:], rest, 0) for n in range(max(0, len(p) - 1), len(p) + 2)):
            return True
    return False


def compare(a: tuple, b: tuple) -> float:
    """Similarity of two forms (given, tokens, business), 0 if they are not the same name."""
    (ga, ta, ba), (gb, tb, bb) = a, b
    left, right = list(ta), list(tb)
    if ga != gb:
        # One side's given name may be an abbreviation or misspelt, and then stands with its tokens.
        if ga and gb:
            return 0.0
        if ga:
            left = [(ga, False), *left]
        else:
            right = [(gb, False), *right]
    best = 0.0
    if len(left) == len(right) and len(left) <= 4:
        for order in permutations(right):
            scores = [_token_score(x, y) for x, y in zip(left, order)]
            if all(scores):
                off = sum(d for _, d in scores)
                if off <= 2 or (off == 3 and (ga or len(left) > 2)):
                    best = max(best, min(s for s, _ in scores) - 0.01 * off)
    elif len(left) == len(right):
        best = max((s - 0.01 * off for off, s in _assigned(left, right)), default=0.0)
    elif abs(len(left) - len(right)) == 1 and not any(s for _, s in (*left, *right)):
        fewer, more = ([w for w, _ in side] for side in sorted((left, right), key=len))
        if sum(map(len, fewer)) >= JOINED and abs(sum(map(len, fewer)) - sum(map(len, more))) <= 1:
            # With one edit at most, equal tokens pair off but for the joined one and a misspelt one.
            for w in list(fewer):
                if w in more:
                    fewer.remove(w)
                    more.remove(w)
            if len(fewer) <= 2 and any(_laid_out("".join(order), more, 1) for order in permutations(fewer)):
                best = 0.93
    if best and ba and bb and ba != bb:
        # The kind of business may be cut short, but not be another one.
        if not (set(ba) <= set(bb) or set(bb) <= set(ba)):
            return 0.0
    return best


FORM = "name string, form string, short boolean"


def _form_text(given: str, tokens: list[tuple[str, bool]], business: list[str]) -> str:
    own = sorted(w + ("." if s else "") for w, s in tokens)
    return "|".join((given, " ".join(own), " ".join(business)))


def _parse(form: str) -> tuple[str, list[tuple[str, bool]], list[str]]:
    given, tokens, business = form.split("|")
    return given, [(w.rstrip("."), w.endswith(".")) for w in tokens.split(" ") if w], business.split()


def forms(names: DataFrame) -> DataFrame:
    """(name, form, short) of every distinct name; short where a token is abbreviated or the kind of
    business is left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            read = [read_name(n) for n in b["name"]]
            yield pd.DataFrame({"name": b["name"], "form": [_form_text(*r) for r in read], "short": [not r[2] or any(s for _, s in r[1]) for r in read]})

    return names.mapInPandas(run, FORM)


def near_rests(a: str, b: str) -> Column:
    """Whether two tokens, one of them an abbreviation, may be one: where the shorter ends, they differ by
    one edit at most, which is two of Levenshtein's if it is a swap. It passes all that compare() does."""
    n = F.least(F.length(a), F.length(b))
    return F.levenshtein(F.left(F.col(a), n), F.left(F.col(b), n), 2) >= 0


def near_letters(a: str, b: str) -> Column:
    """Whether two forms in full may be of one name by the letters they have: an edit takes away one kind
    of letter and adds another at most, and compare() accepts three. Abbreviations tell nothing (-1)."""
    return (F.col(a) < 0) | (F.col(b) < 0) | (F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= 6)


def _kinds(given: str, tokens: list[tuple[str, bool]]) -> int:
    """One bit for each kind of letter, -1 for a form with an abbreviation."""
    if any(short for _, short in tokens):
        return -1
    return _letters(given + "".join(w for w, _ in tokens))


def accepted_pairs(known: DataFrame) -> DataFrame:
    """(a, b, score, a_short, b_short): pairs of forms that name one entity, a < b.

    ``known``: distinct (form, short). Forms get numbers, and only numbers, keys' hashes and rests are
    shuffled; blocks meet in an equi join, so a block that many forms share is split by the adaptive
    skew join, and pairs whose letters rule them out end there. Common given names and business words
    make no block. Pairs found in several blocks are compared once.
    """
    from ..session import checkpointed, parallelism

    tasks = parallelism(known.sparkSession)
    numbered = checkpointed(known.repartition(tasks).withColumn("id", F.monotonically_increasing_id()))

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            read = [_parse(f)[:2] for f in b["form"]]
            own = [block_keys(*r) for r in read]
            flat = [k for ks in own for k in ks]
            count = [len(ks) for ks in own]
            yield pd.DataFrame({"id": np.repeat(b["id"].to_numpy(), count), "kinds": np.repeat(np.array([_kinds(*r) for r in read], dtype=np.int64), count), "key": [k[0] for k in flat], "role": np.array([k[1] for k in flat], dtype=np.int32), "rest": [k[2] for k in flat]})

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            score = [compare(_parse(x), _parse(y)) for x, y in zip(b["a"], b["b"])]
            yield b.assign(score=score)[["a", "b", "score", "a_short", "b_short"]].query("score > 0")

    # Written once, as both sides of the join read them.
    blocks = checkpointed(numbered.select("id", "form").mapInPandas(keys, "id long, kinds long, key string, role int, rest string").withColumn("key", F.xxhash64("key")))
    side = lambda df, p: df.select("key", *[F.col(c).alias(f"{p}_{c}") for c in ("id", "kinds", "role", "rest")])
    left, right = side(blocks.filter("role in (0, 1, 3, 5)"), "l"), side(blocks.filter("role in (0, 2, 4, 6)"), "r")
    # Keys of different roles differ in their first letter, so that roles meet as they should.
    same = (F.col("l_role") > 0) | (F.col("l_id") < F.col("r_id"))
    met = left.join(right, "key").filter((F.col("l_id") != F.col("r_id")) & same & near_letters("l_kinds", "r_kinds") & near_rests("l_rest", "r_rest"))
    met = met.select(F.least("l_id", "r_id").alias("i"), F.greatest("l_id", "r_id").alias("j")).distinct()
    named = lambda i, x: numbered.select(F.col("id").alias(i), F.col("form").alias(f"{x}"), F.col("short").alias(f"{x}_short"))
    pairs = met.join(named("i", "x"), "i").join(named("j", "y"), "j")
    swapped = F.col("x") > F.col("y")
    pick = lambda a, b: F.when(swapped, F.col(b)).otherwise(F.col(a))
    ordered = pairs.select(pick("x", "y").alias("a"), pick("y", "x").alias("b"), pick("x_short", "y_short").alias("a_short"), pick("y_short", "x_short").alias("b_short"))
    return ordered.repartition(tasks).mapInPandas(judge, "a string, b string, score double, a_short boolean, b_short boolean")


def entity_links(pairs: DataFrame) -> DataFrame:
    """(a, b) links for clustering. Short forms fit several entities, so they never join two: each
    keeps only its best link to a form written in full, or else to a short form that has one."""
    from ..session import checkpointed

    full = pairs.filter(~F.col("a_short") & ~F.col("b_short")).select("a", "b")
    mixed = pairs.filter(F.col("a_short") != F.col("b_short")).select(F.when(F.col("a_short"), F.col("a")).otherwise(F.col("b")).alias("s"), F.when(F.col("a_short"), F.col("b")).otherwise(F.col("a")).alias("f"), "score")
    best = mixed.groupBy("s").agg(F.min(F.struct((-F.col("score")).alias("n"), "f")).alias("m")).select(F.col("s").alias("a"), F.col("m.f").alias("b"))
    # Short forms that no full form explains join their best explained short form, round by round; those
    # that nothing leads to a full form may still be spellings of each other.
    both = pairs.filter(F.col("a_short") & F.col("b_short")).select("a", "b", "score")
    sides = both.select(F.col("a").alias("s"), F.col("b").alias("f"), "score").unionByName(both.select(F.col("b").alias("s"), F.col("a").alias("f"), "score"))
    best = checkpointed(best)
    while True:
        explained = best.select(F.col("a").alias("x"))
        sides = checkpointed(sides.join(explained, sides["s"] == explained["x"], "left_anti"))
        led = sides.join(explained, sides["f"] == explained["x"], "left_semi")
        led = checkpointed(led.groupBy("s").agg(F.min(F.struct((-F.col("score")).alias("n"), "f")).alias("m")).select(F.col("s").alias("a"), F.col("m.f").alias("b")))
        if led.isEmpty():
            break
        best = checkpointed(best.unionByName(led))
    both = sides.filter("s < f").select(F.col("s").alias("a"), F.col("f").alias("b"))
    return full.unionByName(best).unionByName(both)


def link_names(names: DataFrame) -> DataFrame:
    """(name, entity): every distinct non-blank name with the entity it names.

    Null and blank names are left out; repeated names count once. Names that nothing else is linked to
    are entities of their own. Very long names are read like others. An empty input gives none.
    """
    from ..session import checkpointed, parallelism

    distinct = names.filter(F.regexp_replace("name", r"(?U)\s+", "") != "").select("name").distinct()
    # By number, so that few names still spread over all tasks.
    told = checkpointed(forms(distinct.repartition(parallelism(names.sparkSession), "name")))
    links = entity_links(checkpointed(accepted_pairs(told.select("form", "short").distinct())))
    grouped = components(links)
    return told.join(grouped.withColumnRenamed("node", "form"), "form", "left").select("name", F.coalesce("component", "form").alias("entity"))


def maker_names(producer: DataFrame, records: DataFrame) -> DataFrame:
    """(name) of makers as typed: canonical names, aliases and the vendor field of listings."""
    own = producer.select(F.col("canonical_name").alias("name"))
    other = producer.select(F.explode("aliases").alias("name"))
    return own.unionByName(other).unionByName(records.select(F.col("payload.vendor").alias("name"))).filter("name is not null").distinct()


def linked_makers(producer: DataFrame, records: DataFrame, vendor: DataFrame) -> DataFrame:
    """(name, entity) of makers. Sellers' own names take part, so that their misspellings are
    recognised too, and their entities are then left out."""
    sellers = vendor.select(F.col("display_name").alias("name")).filter("name is not null").distinct()
    all_names = maker_names(producer, records).unionByName(sellers).distinct()
    linked = link_names(all_names)
    theirs = linked.join(sellers, "name", "left_semi").select("entity").distinct()
    return linked.join(theirs, "entity", "left_anti").select("name", "entity")


def name_pairs(linked: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b in code point order: all pairs of one entity's spellings."""
    a = linked.select("entity", F.col("name").alias("name_a"))
    b = linked.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").filter("name_a < name_b").select("name_a", "name_b")

"""Resolution of incoming names to known entities: exact, by alias, by trigram similarity.

Producers: one probe per distinct name, by alias, then by name, then by the most similar known name
through an inverted trigram index (an equi join with a length filter instead of all pairs), stored or
made by an earlier name. Products: the ladder exact, similar, ambiguous, create is sequential, but only
among names of one (producer, year, weight) that are alike, so it runs per such part in the records'
own order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import name_key
from ..functions.trigrams import mark, set_similarity, similarity_bound, trigram_codes, trigrams

#: Similarity that makes a candidate, similarity that needs no lead, and the lead.
SIMILAR, CERTAIN, LEAD = 0.85, 0.95, 0.10
CANDIDATES = 5
#: Rows of one block that one task compares with the block, at least.
CELL_ROWS = 2000


def trigram_matches(probe: DataFrame, known: DataFrame, probe_name: str, known_id: str, known_name: str, least: float = SIMILAR, block: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """(probe_name, block and kept columns, known_id, sim) of all pairs with at least ``least`` similarity.

    Two sets can only be so similar if their sizes are, and if they share one of the rarest few
    trigrams of either (prefix filtering): each side is indexed by its prefix in order of rarity over
    both sides, so trigrams that many names have are never met. ``block`` names columns that both
    sides have and must agree on, null-safe.
    """
    block, keep = block or [], keep or []
    b = [f"_b{i}" for i in range(len(block))]
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(k) for c, k in zip(block, b)]
    left = probe.select(probe_name, *block, *keep, *keys).distinct().withColumn("_t", trigram_codes(F.col(probe_name))).filter("size(_t) > 0")
    right = known.select(F.col(known_id).alias("_id"), F.col(known_name).alias("_name"), *keys).withColumn("_t", trigram_codes(F.col("_name"))).filter("size(_t) > 0")

    # Counts and prefixes of all names of both sides, once.
    grams = left.select(F.col(probe_name).alias("_name")).unionByName(right.select("_name")).distinct().select("_name", F.explode(trigrams(F.col("_name"))).alias("_g"))
    counts = grams.groupBy("_g").agg(F.count(F.lit(1)).alias("_f"))
    ordered = grams.join(counts, "_g").groupBy("_name").agg(F.array_sort(F.collect_list(F.struct("_f", "_g"))).alias("_o"))
    n = F.size("_o")
    some = F.slice("_o", F.lit(1), F.greatest(n - F.ceil(n * least) + 1, F.lit(1)).cast("int"))
    rp = ordered.select("_name", F.explode(some).alias("_p")).select("_name", F.col("_p._g").alias("_g"))
    lp = rp.withColumnRenamed("_name", probe_name)
    l = left.join(lp, probe_name).select(probe_name, *block, *keep, *b, F.col("_t").alias("_lt"), "_g")
    r = right.join(rp, "_name").select("_id", *b, F.col("_t").alias("_rt"), "_g")
    near = l.join(r, ["_g", *b]).filter((F.size("_lt") >= least * F.size("_rt")) & (F.size("_rt") >= least * F.size("_lt")))
    scored = near.dropDuplicates([probe_name, *keep, *b, "_id"]).withColumn("sim", set_similarity(F.col("_lt"), F.col("_rt"))).filter(F.col("sim") >= least)
    return scored.select(probe_name, *block, *keep, F.col("_id").alias(known_id), "sim")


def best_others(rows: DataFrame, ident: str, name: str, block: list[str], least: float) -> DataFrame:
    """(ident, other, sim, second) per id: the most similar other id of its block, with at least ``least``
    similarity (the lowest id on ties), and the similarity of the row that comes next.

    ``second`` is null where there is none; it is not looked for where the sets of trigrams are equal
    (``sim`` 1). Names without letters and digits are only like each other, with ``sim`` NaN. An id may
    have several rows: each counts, none for its own id. Rows with a null in these columns match nothing.

    Names of one set are one class of their block. Whoever shares a class has its match there; only rows
    that are alone in theirs are compared, with the first rows of every other class, first by marks that
    bound the similarity. A block's comparisons spread over tasks by its rows.
    """
    from ..session import checkpointed, parallelism

    rows = rows.select(F.col(ident).alias("_id"), F.col(name).alias("_name"), *block)
    for c in rows.columns:
        rows = rows.filter(F.col(c).isNotNull())
    sets = rows.select("_name").distinct().withColumn("_t", F.array_sort(trigram_codes(F.col("_name"))))
    sets = checkpointed(sets.withColumn("_set", F.min("_name").over(Window.partitionBy("_t"))))
    members = rows.join(sets.select("_name", "_set", (F.size("_t") == 0).alias("_bare")), "_name").groupBy(*block, "_set", "_bare", "_id").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*block, "_set", "_bare").orderBy("_id")
    members = checkpointed(members.withColumns({"_rank": F.row_number().over(w), "_next": F.lead("_id").over(w), "_first": F.first("_id").over(w)}))
    lone = (F.col("_rank") == 1) & F.col("_next").isNull()
    same = members.filter(~lone).select("_id", F.when(F.col("_rank") == 1, F.col("_next")).otherwise(F.col("_first")).alias("other"), F.when(F.col("_bare"), float("nan")).otherwise(1.0).alias("sim"), F.lit(1).cast("long").alias("_n"))

    # The first three of a class: one of them may be the id itself, two others are enough.
    marked = sets.filter("_name = _set").select("_set", "_t", mark(F.col("_t")).alias("_m"))
    tasks = parallelism(rows.sparkSession)
    cells = members.filter(lone & ~F.col("_bare")).groupBy(*block).agg(F.least(F.ceil(F.count(F.lit(1)) / CELL_ROWS), F.lit(tasks)).cast("int").alias("_cells"))
    heads = members.filter((F.col("_rank") <= 3) & ~F.col("_bare")).join(cells, block).join(marked, "_set")
    # Two rows beside it in the order of names are so similar: what is less cannot be of the best two.
    by_name = Window.partitionBy(*block).orderBy("_set", "_id")
    beside = [F.when(f("_id", k).over(by_name) != F.col("_id"), set_similarity(F.col("_t"), f("_t", k).over(by_name))) for f in (F.lag, F.lead) for k in (1, 2)]
    second = F.try_element_at(F.sort_array(F.filter("_beside", lambda x: x.isNotNull()), asc=False), F.lit(2))
    heads = heads.withColumn("_beside", F.array(*beside)).withColumn("_least", F.greatest(F.lit(least), second))
    side = lambda df, cell: df.select(*block, cell.alias("_cell"), "_id", "_n", "_t", "_m", "_least").repartition(tasks, *block, "_cell")
    a = side(heads.filter(lone), F.pmod(F.xxhash64("_set"), F.col("_cells")).cast("int")).alias("a")
    b = side(heads, F.explode(F.sequence(F.lit(0), F.col("_cells") - 1))).drop("_least").alias("b")
    on = F.col("a._id") != F.col("b._id")
    for c in [*block, "_cell"]:
        on &= F.col(f"a.{c}") == F.col(f"b.{c}")
    # In a lambda, so that the shared elements are counted once.
    shared = F.array(F.size(F.array_intersect("a._t", "b._t")))
    sim = F.when(similarity_bound(F.col("a._m"), F.col("b._m")) >= F.col("a._least"), F.transform(shared, lambda n: n / (F.col("a._m.n") + F.col("b._m.n") - n))[0])
    near = a.join(b, on).select(*[F.col(f"a.{c}").alias(c) for c in [*block, "_cell", "_id"]], F.col("b._id").alias("other"), sim.alias("sim"), (F.col("a._n") * F.col("b._n")).alias("_n"), F.col("a._least").alias("_least")).filter(F.col("sim") >= F.col("_least"))
    best = [F.col("sim").desc(), "other"]
    near = near.withColumn("_rank", F.row_number().over(Window.partitionBy(*block, "_cell", "_id").orderBy(*best))).filter("_rank <= 2")

    w = Window.partitionBy("_id").orderBy(*best)
    top = near.select("_id", "other", "sim", "_n").unionByName(same).withColumns({"_rank": F.row_number().over(w), "_next": F.lead("sim").over(w)}).filter("_rank = 1")
    second = F.when(F.col("sim") < 1, F.when(F.col("_n") > 1, F.col("sim")).otherwise(F.col("_next")))
    return top.select(F.col("_id").alias(ident), "other", "sim", second.alias("second"))


def leaders(names: DataFrame, links: DataFrame) -> DataFrame:
    """(key) of the names that make an entity of their own, if names are taken in order and each joins an
    earlier one that it is linked to and that has made one.

    ``names``: (key, at), ``links``: (key, other), other being the earlier. Round by round a name leads if
    no earlier name linked to it is undecided or leads, and follows if one leads; a chain of n names
    takes n rounds at most, other names are all decided in the first.
    """
    from ..session import checkpointed

    first = links.select("key").distinct()
    leading = checkpointed(names.select("key").join(first, "key", "left_anti"))
    undecided, links = checkpointed(first), checkpointed(links.select("key", "other"))
    while not undecided.isEmpty():
        behind = links.join(leading.select(F.col("key").alias("other")), "other", "left_semi").select("key").distinct()
        undecided = checkpointed(undecided.join(behind, "key", "left_anti"))
        open_ends = undecided.select(F.col("key").alias("other"))
        links = checkpointed(links.join(undecided, "key", "left_semi"))
        waiting = links.join(open_ends, "other", "left_semi").select("key").distinct()
        fresh = undecided.join(waiting, "key", "left_anti")
        leading = checkpointed(leading.unionByName(fresh))
        undecided = checkpointed(undecided.join(waiting, "key", "left_semi"))
    return leading


def resolve_producers(hints: DataFrame, producer: DataFrame) -> DataFrame:
    """(key, producer_id, how, like, at) of every distinct name key of ``hints``.

    ``hints``: (name) and, optionally, (at) the order in which they are read; else keys are read in code
    point order. how: ``alias``, ``name``, ``trigram`` (best similarity, lowest id on ties) or ``create``
    (null id). What a name creates, later names of the same hints may find: those have a null id, too,
    and the key of the name that creates their producer in ``like``. Null and blank names are left out.
    """
    from ..session import checkpointed

    keyed = hints.select(name_key(F.col("name")).alias("key"), *(["at"] if "at" in hints.columns else [])).filter("key <> ''")
    probe = keyed.groupBy("key").agg((F.min("at") if "at" in hints.columns else F.min("key")).alias("at"))
    by_alias = producer.select("producer_id", F.explode("aliases").alias("key")).filter("key is not null").groupBy("key").agg(F.min("producer_id").alias("alias_id"))
    by_name = producer.select("producer_id", F.lower("canonical_name").alias("key")).groupBy("key").agg(F.min("producer_id").alias("name_id"))
    direct = checkpointed(probe.join(by_alias, "key", "left").join(by_name, "key", "left"))
    rest = direct.filter("alias_id is null and name_id is null").select("key", "at")
    close = trigram_matches(rest.select("key"), producer, "key", "producer_id", "canonical_name").groupBy("key").agg(F.min(F.struct((-F.col("sim")).alias("s"), "producer_id")).alias("m"))
    close = checkpointed(close.select("key", F.col("m.producer_id").alias("close_id"), (-F.col("m.s")).alias("close_sim")))
    # Names of these hints among themselves: only those that nothing stored is like may create.
    new = checkpointed(rest.join(close.select("key"), "key", "left_anti"))
    peers = trigram_matches(rest.select("key"), new.select("key", F.col("key").alias("spelled")).withColumnRenamed("key", "other"), "key", "other", "spelled").filter("key <> other")
    peers = peers.join(rest, "key").join(new.select(F.col("key").alias("other"), F.col("at").alias("other_at")), "other")
    peers = checkpointed(peers.filter(F.struct("other_at", "other") < F.struct("at", "key")))
    lead = leaders(new, peers.join(new.select("key"), "key", "left_semi"))
    like = peers.join(lead.select(F.col("key").alias("other")), "other", "left_semi").groupBy("key").agg(F.min(F.struct((-F.col("sim")).alias("s"), "other_at", "other")).alias("m"))
    like = like.select("key", F.col("m.other").alias("like"), (-F.col("m.s")).alias("like_sim"))
    out = direct.join(close, "key", "left").join(like, "key", "left")
    # Stored producers have the lower ids, so they win ties.
    newer = F.col("alias_id").isNull() & F.col("name_id").isNull() & F.col("like").isNotNull() & (F.col("close_sim").isNull() | (F.col("like_sim") > F.col("close_sim")))
    how = F.when(F.col("alias_id").isNotNull(), "alias").when(F.col("name_id").isNotNull(), "name").when(F.col("close_id").isNotNull() | newer, "trigram").otherwise("create")
    return out.select("key", F.when(~newer, F.coalesce("alias_id", "name_id", "close_id")).alias("producer_id"), how.alias("how"), F.when(newer, F.col("like")).alias("like"), "at")


def new_aliases(producer: DataFrame, resolved: DataFrame) -> DataFrame:
    """(producer_id, alias) of the keys that found a stored producer by its name or by similarity and that
    it does not have as an alias yet."""
    found = resolved.filter("how in ('name', 'trigram') and producer_id is not null").select("producer_id", F.col("key").alias("alias")).distinct()
    there = producer.select("producer_id", F.explode("aliases").alias("alias"))
    return found.join(there, ["producer_id", "alias"], "left_anti")


def with_aliases(producer: DataFrame, resolved: DataFrame) -> DataFrame:
    """Producers with the keys that found them by name or similarity added to their aliases, once each."""
    found = new_aliases(producer, resolved).groupBy("producer_id").agg(F.array_sort(F.collect_set("alias")).alias("_new"))
    empty = F.array().cast("array<string>")
    out = producer.join(found, "producer_id", "left")
    return out.withColumn("aliases", F.when(F.col("_new").isNotNull(), F.array_union(F.coalesce("aliases", empty), "_new")).otherwise(F.col("aliases"))).drop("_new")


def name_trigrams(text: str) -> frozenset[str]:
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            words.append(f"  {word} ")
            word = ""
    return frozenset(w[i : i + 3] for w in words for i in range(len(w) - 2))


class Ladder:
    """The steps exact, similar, ambiguous, create within one group. What a row creates, later rows may
    find."""

    def __init__(self):
        self.known: list[tuple[int, frozenset[str]]] = []
        self.by_name: dict[str, int] = {}

    def know(self, ident: int, name: str | None) -> None:
        name = name or ""
        self.known.append((ident, name_trigrams(name)))
        low = name.lower()
        self.by_name[low] = min(ident, self.by_name.get(low, ident))

    def climb(self, name: str | None, key: str | None, fresh: int) -> tuple[int, str]:
        """(id, label) of one row, ``fresh`` being the id of what it would create. Labels: ``exact``,
        ``trigram``, ``ambiguous_created``, ``created``."""
        name = name or ""
        if key in self.by_name:
            return self.by_name[key], "exact"
        own = name_trigrams(name)
        close = sorted((-len(own & t) / len(own | t), i < 0, abs(i), i) for i, t in self.known if own and t and len(own & t) >= SIMILAR * len(own | t))[:CANDIDATES]
        if close:
            top = -close[0][0]
            if len(close) < 2 or top >= CERTAIN or top + close[1][0] >= LEAD:
                return close[0][3], "trigram"
        self.know(fresh, name)
        return fresh, "ambiguous_created" if close else "created"


GROUP = ["producer_id", "harvest_year", "weight_grams"]


def _parts(names: DataFrame) -> DataFrame:
    """(node, name, group columns, part): names that may ever meet in a ladder have one part. Those are
    similar enough or have one key, directly or over others of the group."""
    from ..session import checkpointed

    nodes = checkpointed(names.withColumn("node", F.monotonically_increasing_id()))
    near = trigram_matches(nodes, nodes.select(F.col("node").alias("other"), F.col("name").alias("spelled"), *GROUP), "name", "other", "spelled", SIMILAR, GROUP, ["node"])
    links = near.select(F.col("node").alias("a"), F.col("other").alias("b")).filter("a < b")
    keys = nodes.select("node", *GROUP, F.explode(F.array_distinct(F.array(name_key(F.coalesce("name", F.lit(""))), F.lower(F.coalesce("name", F.lit("")))))).alias("k"))
    one = keys.groupBy(*GROUP, "k").agg(F.min("node").alias("a"), F.collect_set("node").alias("all")).select("a", F.explode("all").alias("b")).filter("a < b")
    joined = connected(links.unionByName(one))
    return nodes.join(joined, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")


def connected(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) of linked nodes by the smallest node they lead to: labels move along links and
    jump to their label's label, so long chains take few rounds."""
    from ..session import checkpointed

    both = checkpointed(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    now = checkpointed(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("c")))
    for _ in range(rounds):
        heard = both.join(now.select(F.col("a").alias("b"), "c"), "b").groupBy("a").agg(F.min("c").alias("n"))
        jump = now.select(F.col("a").alias("c"), F.col("c").alias("j"))
        new = checkpointed(now.join(heard, "a").join(jump, "c").select("a", F.least("c", "n", "j").alias("c"), F.col("c").alias("old")))
        now = new.select("a", "c")
        if new.filter("c < old").isEmpty():
            return now.select(F.col("a").alias("node"), F.col("c").alias("component"))
    raise RuntimeError(f"no convergence in {rounds} rounds")


def resolve_products(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """(row_no, product_id, decision) of incoming rows.

    ``incoming``: (row_no long, unique and in processing order; name; producer_id, harvest_year,
    weight_grams). ``existing``: (product_id, name, and the same group columns). Ids of created
    products are minus the row_no that creates them, to be replaced by real ids when they are written.
    Null group values match only null. What can meet is found by joins first: names of a group that are
    similar or have one key, directly or over others, make a part, and only within a part rows are
    taken one after the other, so a large group (all rows without maker, say) spreads over its parts.
    A part's rows stream through one task, which holds the part's products, never its rows.
    """
    keyed = incoming.select("row_no", "name", name_key(F.col("name")).alias("key"), *GROUP)
    known = existing.select(F.lit(None).cast("long").alias("row_no"), "name", F.lit(None).cast("string").alias("key"), *GROUP, "product_id")
    rows = known.unionByName(keyed.withColumn("product_id", F.lit(None).cast("long")))
    parts = _parts(rows.select("name", *GROUP).distinct()).select("part", *[F.col(c).alias(f"_{c}") for c in ("name", *GROUP)])
    same = None
    for c in ("name", *GROUP):
        this = F.col(c).eqNullSafe(F.col(f"_{c}"))
        same = this if same is None else same & this
    rows = rows.join(parts, same).select("part", "row_no", "name", "key", "product_id")

    def ladder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, climber = None, Ladder()
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["part"] != part:
                    part, climber = r["part"], Ladder()
                if r["row_no"] is None:
                    climber.know(r["product_id"], r["name"])
                else:
                    out.append((r["row_no"], *climber.climb(r["name"], r["key"], -r["row_no"])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.string())], names=["row_no", "product_id", "decision"])

    # One task holds whole parts, one after the other: what is known first, then the rows in order.
    placed = rows.repartition("part").sortWithinPartitions("part", F.col("row_no").asc_nulls_first(), "product_id")
    return placed.mapInArrow(ladder, "row_no long, product_id long, decision string")

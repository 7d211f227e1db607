"""MinHash near-dedup by an inverted join over signature coordinates.

1. Every whole text gets the set of its word shingles (64-bit hashes) and a
   MinHash signature of COORDINATES values.  Equal sets are one class, numbered
   in the order of its smallest (doc_id, text hash), which is the row that stands
   for it; from here on only classes count.
2. A class is posted under each (coordinate, value).  Pairs that match in fewer
   than a stated number of coordinates (``matches_needed``) are of no interest: a pair of similarity 0.8 does
   so with a chance below 1e-7.  So postings with one class go, then classes
   with fewer postings left than that (skip), and of the rest, rarest
   posting first, all but the last ones form the prefix: two classes
   that match in so many coordinates share a posting of both prefixes.
3. Under each prefix posting the classes are paired with two hubs, the class
   whose postings are the most shared and the smallest, not with each other.
   Pairs that match well enough are compared on their full sets, which gives
   links and, for each class, what it lacks of the hub's set (D) and has
   beyond it (E).  A second round gives classes that found no link hubs of their own.
4. What is left are pairs under one posting in different components.  Around a
   hub, let h be the set that most of its classes agree on; |x & c| is
   |h| - |Dx | Dc| + |Ex & Ec|, at most |h| - max(|Dx|, |Dc|) + |Ex & Ec|.  First
   every class meets the one nearest to h, which joins nearly all of a group of
   near copies.  For the strays that remain, either the sizes of D and E alone
   allow a link (a bounded number of bands of sizes is compared first) or x and c
   share so much that h lacks (an inverted join on the rarer part of E); both
   are then decided exactly.  A class further from its hub than two
   links can only be linked with classes that the hub isn't linked with; those
   pairs are compared on full sets.  So no link between components is lost, and
   a large group of copies costs a few pairs per class, not the square of its size.

Defined cases: null, empty and wordless texts have an empty set and are linked
with nothing; rows with a null doc_id are linked with nothing (component null,
kept); a repeated doc_id with another text follows each row's own text, and rows
are told apart by doc_id and text hash; rows repeated as they are are treated
alike; columns of the input stay; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, free, passing_tables, saved, sliced
from .components import components
from .shingles import shingle_sets

COORDINATES = 64
PERCENT = 80
WIDTH = 5
MISS = 1e-7
#: Steps of D and of E that classes around a hub are told apart by before they meet.
BANDS = 16
_U = np.uint64


def matches_needed(coordinates: int = COORDINATES, percent: int = PERCENT, miss: float = MISS) -> int:
    """The most matching coordinates to ask for so that a pair at the threshold falls short with a chance below ``miss``."""
    s, short, t = percent / 100, 0.0, 0
    while t < coordinates:
        short += comb(coordinates, t) * s**t * (1 - s) ** (coordinates - t)
        if short > miss:
            break
        t += 1
    return max(1, t)


_DEAL = np.random.Generator(np.random.PCG64(7))
_FACTORS = _DEAL.integers(1, 1 << 63, 256, np.uint64) | _U(1)
_TERMS = _DEAL.integers(1, 1 << 63, 256, np.uint64)


def signature(hashes: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The smallest of each coordinate's 32-bit hash over the set."""
    low = np.full(coordinates, 0xFFFFFFFF, _U)
    for at in range(0, len(hashes), 2048):
        part = hashes[at:at + 2048, None] * _FACTORS[:coordinates] + _TERMS[:coordinates]
        low = np.minimum(low, part.min(0) >> _U(32))
    return low.astype(np.uint32).view(np.int32)


def signatures(docs: DataFrame, key: str, text: str, width: int = WIDTH, coordinates: int = COORDINATES) -> DataFrame:
    """id, t (the text's hash), n (set size), set_a, set_b (a 128-bit digest of the set), signature (null if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            size, a, b, sig = [], [], [], []
            for s in shingle_sets(batch.column("text").to_pylist(), width):
                size.append(len(s))
                a.append(int(s.sum(dtype=_U).astype(np.int64)))
                b.append(int(np.bitwise_xor.reduce(s * (s >> _U(7) | _U(1)), initial=_U(0)).astype(np.int64)))
                sig.append(signature(s, coordinates) if len(s) else None)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "t": batch.column("t"), "n": pa.array(size, pa.int64()), "set_a": pa.array(a, pa.int64()),
                "set_b": pa.array(b, pa.int64()), "signature": pa.array(sig, pa.list_(pa.int32()))})

    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, t long, n long, set_a long, set_b long, signature array<int>")


def set_rows(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """id, hashes: the full shingle set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [s.view(np.int64) for s in shingle_sets(batch.column("text").to_pylist(), width)]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "hashes": pa.array(sets, pa.list_(pa.int64()))})

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, "id long, hashes array<long>")


def prefixes(classes: DataFrame, needed: int) -> DataFrame:
    """id, shared (how common its postings are), posting: the prefix postings of each class that can match."""
    coordinate = F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").bitwiseAND(0xFFFFFFFF)
    posted = (classes.select("id", F.posexplode("signature").alias("at", "value"))
              .withColumn("value", F.col("value").cast("long")).select("id", coordinate.alias("posting")))
    common = saved(posted.groupBy("posting").agg(F.count("*").alias("ids")).where(F.col("ids") > 1), "postings")
    live = (posted.join(common, "posting").groupBy("id")
            .agg(F.sort_array(F.collect_list(F.struct("ids", "posting"))).alias("live"), F.sum("ids").alias("shared"))
            .where(F.size("live") >= needed))
    first = F.slice("live", F.lit(1), F.size("live") - (needed - 1))
    return live.select("id", "shared", F.explode(first).alias("p")).select("id", "shared", F.col("p.posting").alias("posting"))


def _hubs(prefix: DataFrame) -> DataFrame:
    """posting, hub, least: the most shared and the smallest class of each posting."""
    return prefix.groupBy("posting").agg(F.max(F.struct("shared", (-F.col("id")).alias("less"))).alias("top"), F.min("id").alias("least")).select(
        "posting", (-F.col("top.less")).alias("hub"), "least")


def hub_pairs(prefix: DataFrame, hubs: DataFrame) -> DataFrame:
    """hub, id: every class with the hubs of its postings."""
    both = hubs.select("posting", F.explode(F.array_distinct(F.array("hub", "least"))).alias("hub"))
    return prefix.join(both, "posting").where(F.col("id") != F.col("hub")).select("hub", "id").distinct()


def compared(pairs: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, width: int, least: int) -> DataFrame:
    """hub, id, nh, n, shared (sizes of the full sets and of what both have), extra (what id has beyond hub)
    and missing (what it lacks) of the pairs that match in at least ``least`` coordinates."""
    sig = classes.select("id", "signature")
    both = (pairs.join(sig.select(F.col("id").alias("hub"), F.col("signature").alias("sh")), "hub")
            .join(sig.withColumnRenamed("signature", "si"), "id"))
    same = F.aggregate(F.zip_with("sh", "si", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    likely = saved(both.where(same >= least).select("hub", "id"), "likely")
    wanted = likely.select(F.explode(F.array("hub", "id")).alias("id")).distinct().join(classes.select("id", "doc", "t"), "id")
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    texts = texts.join(wanted.hint("merge"), ["doc", "t"]).groupBy("doc", "t").agg(F.first("id").alias("id"), F.first("text").alias("text"))
    sets = saved(set_rows(texts, "id", "text", width), "sets")
    full = (likely.join(sets.select(F.col("id").alias("hub"), F.col("hashes").alias("hh")), "hub")
            .join(sets.withColumnRenamed("hashes", "hi"), "id"))
    extra = F.array_except("hi", "hh")
    return full.select("hub", "id", F.size("hh").cast("long").alias("nh"), F.size("hi").cast("long").alias("n"),
                       (F.size("hi") - F.size(extra)).cast("long").alias("shared"), extra.alias("extra"),
                       F.array_except("hh", "hi").alias("missing"))


def links_of(found: DataFrame, percent: int) -> DataFrame:
    """a, b of the compared pairs whose similarity is at least ``percent`` per cent."""
    similar = found.where(F.col("shared") * 100 >= (F.col("nh") + F.col("n") - F.col("shared")) * percent)
    return similar.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()


def _components_of(prefix: DataFrame, parts: DataFrame) -> DataFrame:
    """id, posting, shared, component of the postings whose classes lie in several components."""
    placed = saved(prefix.join(parts, prefix.id == parts.node, "left")
                   .select("id", "posting", "shared", F.coalesce("component", "id").alias("component")), "placed")
    several = placed.groupBy("posting").agg(F.min("component").alias("x"), F.max("component").alias("y")).where(F.col("x") != F.col("y"))
    return saved(placed.join(several.select("posting"), "posting"), "several")


def alone(prefix: DataFrame, links: DataFrame) -> DataFrame:
    """The postings of classes without a link."""
    linked = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return prefix.join(linked, "id", "left_anti")


def _against_consensus(near: DataFrame) -> DataFrame:
    """near with nh, D, E, extra, missing against the set that most classes around a hub agree on instead of the hub's own.

    The hub has edits of its own, which nearly all others would share not having.
    """
    half = near.groupBy("hub").agg(F.count("*").alias("classes"))
    votes = near.select("hub", F.explode(F.concat(F.transform("extra", lambda g: F.struct(g.alias("g"), F.lit(True).alias("add"))),
                                                  F.transform("missing", lambda g: F.struct(g.alias("g"), F.lit(False).alias("add"))))).alias("v"))
    votes = votes.groupBy("hub", "v.g", "v.add").agg(F.count("*").alias("n")).join(half, "hub").where(F.col("n") * 2 > F.col("classes") + 1)
    change = votes.groupBy("hub").agg(F.collect_list(F.when(F.col("add"), F.col("g"))).alias("added"),
                                      F.collect_list(F.when(~F.col("add"), F.col("g"))).alias("taken"))
    none = F.array().cast("array<long>")
    met = near.join(saved(change, "consensus"), "hub", "left")
    added, taken = F.coalesce("added", none), F.coalesce("taken", none)
    beyond = F.concat(F.array_except("extra", added), F.array_except(taken, "missing"))
    lacking = F.concat(F.array_except("missing", taken), F.array_except(added, "extra"))
    met = met.withColumn("nh", F.col("nh") - F.size(taken) + F.size(added)).withColumn("beyond", beyond).withColumn("lacking", lacking)
    return met.select("hub", "id", "component", "nh", "beyond", "lacking",
                      F.size("lacking").cast("long").alias("D"), F.size("beyond").cast("long").alias("E"))


def _linked(percent: int) -> Column:
    """Whether x and c, seen from one consensus, are linked: what both have follows from what each lacks and has beyond it."""
    shared = "(nh - size(array_union(lacking_x, lacking_c)) + size(array_intersect(beyond_x, beyond_c)))"
    return F.expr(f"component_x <> component_c and 100 * {shared} >= {percent} * (2 * nh - D_x + E_x - D_c + E_c - {shared})")


def _side(near: DataFrame, c: str, *names: str) -> DataFrame:
    return near.select("hub", *[F.col(n).alias(f"{n}_{c}") for n in names])


def _to_centres(near: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (id_x, id_c, component_x, component_c) of classes with their hub's centre, the class
    nearest to the consensus, and hub, centre_component, least_e (the fewest things a class has beyond it)."""
    cost = F.expr(f"100 * D + {percent} * E")
    first = near.groupBy("hub").agg(F.min(F.struct(cost.alias("cost"), "id")).alias("first"), F.min("E").alias("least_e"))
    centre = saved(near.join(first.select("hub", F.col("first.id").alias("id"), "least_e"), ["hub", "id"]), "centres")
    to = _side(centre, "c", "id", "component", "D", "E", "lacking", "beyond")
    met = near.select("hub", "nh", *[F.col(n).alias(f"{n}_x") for n in ("id", "component", "D", "E", "lacking", "beyond")]).join(to, "hub")
    links = met.where(_linked(percent)).select("id_x", "id_c", "component_x", "component_c")
    return saved(links, "central"), centre.select("hub", F.col("component").alias("centre_component"), "least_e")


def _by_sizes(near: DataFrame, percent: int) -> DataFrame:
    """hub, id_x, id_c: pairs of a stray with any class whose D and E alone allow a link.

    That is rest * max(Dx, Dc) + percent * (|Dx - Dc| + Ex + Ec) <= rest * nh with rest = 100 - percent.
    D and E fall into BANDS steps each, so a hub has a bounded number of kinds, whatever the number
    of its classes; kinds are compared by their bounds, then the classes of allowed kinds exactly.
    """
    rest = 100 - percent
    able = near.where(F.expr(f"{rest} * D + {percent} * (E + least_e) <= {rest} * nh"))
    able = (able.withColumn("band_d", F.expr(f"cast(floor(D * {BANDS} / greatest(nh, 1)) as int)"))
            .withColumn("band_e", F.expr(f"cast(floor(E * {percent * BANDS} / greatest({max(1, rest)} * nh, 1)) as int)")))
    kinds = able.groupBy("hub", "nh", "band_d", "band_e").agg(
        F.min("D").alias("low"), F.max("D").alias("high"), F.min("E").alias("least"), F.max("stray").alias("stray"))
    kinds = saved(kinds, "kinds")
    names = ("band_d", "band_e", "low", "high", "least")
    sizes = (kinds.where("stray").select("hub", "nh", *[F.col(n).alias(f"{n}_x") for n in names])
             .join(_side(kinds, "c", *names), "hub")
             .where(F.expr(f"{rest} * greatest(low_x, low_c) + {percent} * (greatest(0, low_x - high_c, low_c - high_x) + least_x + least_c) <= {rest} * nh")))
    of_class = ("band_d", "band_e", "id", "component", "D", "E")
    x, c = _side(able.where("stray"), "x", *of_class), _side(able, "c", *of_class, "stray")
    allowed = F.expr(f"{rest} * greatest(D_x, D_c) + {percent} * (abs(D_x - D_c) + E_x + E_c) <= {rest} * nh")
    met = x.join(sizes.select("hub", "nh", "band_d_x", "band_e_x", "band_d_c", "band_e_c"), ["hub", "band_d_x", "band_e_x"])
    met = met.join(c, ["hub", "band_d_c", "band_e_c"])
    return met.where(allowed & F.expr("component_x <> component_c and (not stray_c or id_x < id_c)")).select("hub", "id_x", "id_c")


def _by_extras(near: DataFrame, percent: int) -> DataFrame:
    """hub, id_x, id_c: pairs of a stray with any class that may share as many things that the consensus lacks as a link asks for.

    Linked classes have sizes at most ``percent`` per cent apart.  So ``need``, what a class x has to share, follows from
    |x & c| at its largest and c as short as x allows (and any around the hub is): of its things, rarest first,
    all but the last need - 1 are looked at, on both sides.  Shared things that weren't seen are among the last ones of
    x or of c, so what both can share at most is known by the number seen, and asked for by the sizes of the two.
    """
    shortest = near.groupBy("hub").agg(F.max(F.col("D") - F.col("E")).alias("short"))
    size = "(nh - D + E)"
    asked = f"ceil({percent} * ({size} + greatest(nh - short, ceil({percent} * {size} / 100))) / {100 + percent}) - nh + D"
    need = F.expr(f"greatest(1, {asked})").cast("long")
    beyond = (near.join(shortest, "hub").withColumn("need", need).where("need <= E")
              .select("hub", "nh", "id", "component", "stray", "D", "E", "need", F.explode("beyond").alias("g")))
    common = saved(beyond.groupBy("hub", "g").agg(F.count("*").alias("ids"), F.max("stray").alias("s")).where("ids > 1 and s").select("hub", "g", "ids"), "beyond")
    own = Window.partitionBy("hub", "id")  # no more rows than the class has shingles
    rare = (beyond.join(common, ["hub", "g"])
            .withColumn("nth", F.row_number().over(own.orderBy("ids", "g"))).withColumn("of", F.count("*").over(own))
            .where(F.col("nth") <= F.col("of") - F.col("need") + 1).drop("nth", "of", "ids"))
    rare = saved(rare, "beyond")
    names = ("id", "component", "D", "E", "need")
    x = rare.where("stray").select("hub", "g", "nh", *[F.col(n).alias(f"{n}_x") for n in names])
    c = rare.select("hub", "g", "stray", *[F.col(n).alias(f"{n}_c") for n in names])
    met = x.join(c, ["hub", "g"]).where(F.expr(
        f"component_x <> component_c and (not stray or id_x < id_c) and 100 * least(nh - D_x + E_x, nh - D_c + E_c) >= {percent} * greatest(nh - D_x + E_x, nh - D_c + E_c)"))
    seen = met.groupBy("hub", "id_x", "id_c").agg(F.count("*").alias("seen"), *[F.first(n).alias(n) for n in ("nh", "D_x", "E_x", "need_x", "D_c", "E_c", "need_c")])
    able = f"{100 + percent} * (nh - greatest(D_x, D_c) + least(E_x, E_c, seen + greatest(need_x, need_c) - 1)) >= {percent} * (2 * nh - D_x + E_x - D_c + E_c)"
    return seen.where(F.expr(able)).select("hub", "id_x", "id_c")


def rest_links(placed: DataFrame, hubs: DataFrame, found: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Step 4: links (a, b) between components, and pairs (hub, id) that are still to be compared."""
    own = found.select("hub", "id", "nh", "n", "shared", "extra", "missing")
    at = placed.join(hubs.select("posting", "hub"), "posting").select("posting", "hub", "id", "component")
    members = at.where(F.col("id") != F.col("hub")).select("hub", "id", "component").distinct()
    members = saved(members.join(own, ["hub", "id"], "left"), "members")
    near = saved(_against_consensus(members.where(F.col("nh").isNotNull())), "near")

    # Most classes are linked with the one nearest to the consensus; what that joins needs no further pairs.
    central, homes = _to_centres(near, percent)
    if not central.isEmpty():
        joined = components(central.select(F.col("component_x").alias("a"), F.col("component_c").alias("b"))).toDF("node", "now")
        joined = saved(joined, "joined")
        now = lambda df, c="component": df.join(joined, df[c] == joined.node, "left").withColumn(c, F.coalesce("now", c)).drop("node", "now")
        near, homes, at = now(near), now(homes, "centre_component"), now(at)
    near = saved(near.join(homes, "hub").withColumn("stray", F.col("component") != F.col("centre_component")).drop("centre_component"), "near")

    met = saved(_by_sizes(near, percent).union(_by_extras(near, percent)).distinct(), "met")
    names = ("id", "component", "D", "E", "lacking", "beyond")
    x = near.select("hub", "nh", *[F.col(n).alias(f"{n}_x") for n in names])
    between = met.join(x, ["hub", "id_x"]).join(_side(near, "c", *names), ["hub", "id_c"]).where(_linked(percent)).select("id_x", "id_c")

    # Far from the hub: only with others that the hub isn't linked with.
    far = members.where(F.col("nh").isNull()).select("hub", "id")
    unlinked = members.where(F.col("nh").isNull() | (F.col("shared") * 100 < (F.col("nh") + F.col("n") - F.col("shared")) * percent)).select("hub", "id")
    by_far = (at.join(far, ["hub", "id"]).select("posting", F.col("id").alias("x"), F.col("component").alias("px"))
              .join(at.join(unlinked, ["hub", "id"]).select("posting", F.col("id").alias("c"), F.col("component").alias("pc")), "posting")
              .where("px <> pc").select(F.least("x", "c").alias("hub"), F.greatest("x", "c").alias("id")).distinct())
    return between.union(central.select("id_x", "id_c")).toDF("a", "b").distinct(), by_far


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT,
                    coordinates: int = COORDINATES) -> DataFrame:
    """A row per document: id, t (the text's hash), n (set size), component (the smallest id that links reach),
    kept (whether the row, by id and t, is the first of its component)."""
    with passing_tables(docs.sparkSession, "signatures", "class-components"):
        rows, of_class = _classes_and_components(docs, key, text, width, percent, coordinates)
    filled = rows.where((F.col("n") > 0) & F.col("id").isNotNull())
    first = (F.col("id") == F.col("doc")) & (F.col("t") == F.col("first_t"))
    linked = filled.select("id", "t", "n", "set_a", "set_b").join(of_class, ["n", "set_a", "set_b"]).select(
        "id", "t", "n", F.col("doc").alias("component"), first.alias("kept"))
    unlinked = rows.where((F.col("n") == 0) | F.col("id").isNull()).select("id", "t", "n", F.col("id").alias("component"), F.lit(True).alias("kept"))
    return linked.union(unlinked)


def _classes_and_components(docs: DataFrame, key: str, text: str, width: int, percent: int, coordinates: int) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and the first row (doc, first_t) of the component of each set."""
    needed = matches_needed(coordinates, percent)
    rows = saved(signatures(docs, key, text, width, coordinates), "signatures")
    filled = rows.where((F.col("n") > 0) & F.col("id").isNotNull())
    names = saved(filled.groupBy("n", "set_a", "set_b").agg(F.min(F.struct("id", "t")).alias("first")), "classes")
    names = names.select("n", "set_a", "set_b", F.col("first.id").alias("doc"), F.col("first.t").alias("first_t"))
    names = saved(names.repartitionByRange("doc", "first_t").sortWithinPartitions("doc", "first_t")
                  .withColumn("class", F.monotonically_increasing_id()), "classes")
    members = filled.select("id", "t", "n", "set_a", "set_b", "signature").join(names, ["n", "set_a", "set_b"])
    first = (F.col("id") == F.col("doc")) & (F.col("t") == F.col("first_t"))
    classes = saved(members.where(first).select(F.col("class").alias("id"), "doc", "t", "n", "signature").dropDuplicates(["id"]), "class-signatures")
    prefix = saved(prefixes(classes, needed), "prefixes")
    check = lambda pairs, least, label: saved(compared(pairs, classes, docs, key, text, width, least), label)
    hubs = saved(_hubs(prefix), "hubs")
    # Near enough to a hub to be linked with what the hub is linked with.
    near = min(needed, matches_needed(coordinates, max(0, 2 * percent - 100)))
    found = check(hub_pairs(prefix, hubs), near, "hub-compared")
    links = saved(links_of(found, percent), "links")
    lonely = saved(alone(prefix, links), "lonely")
    links = saved(links.union(links_of(check(hub_pairs(lonely, _hubs(lonely)), needed, "lonely-compared"), percent)), "links")
    parts = components(links)
    placed = _components_of(prefix, parts)
    between, open_pairs = rest_links(placed, hubs, found, percent)
    rest = links_of(check(saved(open_pairs, "far-pairs"), needed, "far-compared"), percent)
    rest = saved(between.union(rest), "rest-links")
    if not rest.isEmpty():
        parts = components(saved(links.union(rest), "links"))
    of_class = names.join(parts, names["class"] == parts["node"], "left").select("n", "set_a", "set_b", F.coalesce("component", "class").alias("class"))
    of_class = of_class.join(names.select("class", "doc", "first_t"), "class")
    return rows, saved(of_class.select("n", "set_a", "set_b", "doc", "first_t"), "class-components")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """docs with one document (the smallest id, then text hash) of each group of near duplicates."""
    k, t = free(docs, "gone_id"), free(docs, "gone_t")
    gone = near_duplicates(docs, key, text, width, percent).where(~F.col("kept")).select(F.col("id").alias(k), F.col("t").alias(t)).distinct()
    return docs.join(gone, (F.col(key) == F.col(k)) & (F.xxhash64(text) == F.col(t)), "left_anti")


def op2_minhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), width=2)
    # Rows of one id are kept alike here; keep_one tells them apart by their text.
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))

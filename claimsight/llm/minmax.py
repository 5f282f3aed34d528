"""Near-duplicate documents by min-max hashing (operator 8).

A document's set holds its distinct ``k``-word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``; with fewer words the whole sequence is the one shingle).  Each hash
permutation gives two signature values, the smallest and the largest, so half as many hash
evaluations fill the same bands.  Documents link when the Jaccard similarity of their full sets
reaches the threshold; components follow the links.

* Documents with equal sets form a class; only the smallest id of a class goes on.
* Bands of the signature make buckets.  In each bucket one leader is compared with all members.  Leaders are the
  members that share most buckets with others: the text that a group's copies were made from keeps the commonest key of every
  band, and links with copies that do not link with each other.  A pair is compared by size, by agreement of the signatures
  (pairs far below the threshold drop out), then on the full sets.
* Buckets whose other members are not all connected by that go on without listing their pairs.  Each member is
  described by its difference from the leader, corrected to what most members of that leader have.  Sizes and differences alone say which
  pairs surely link (the member nearest to the majority links with both ends of every such pair), and how many
  elements the differences of any other linked pair must share.  An inverted index over the rarest elements of each difference
  (a prefix filter) then finds every pair that can share so many; these are compared.  The rarest elements of a copy are its own edits,
  so copies of one text that do not link with each other hardly ever meet.
* Components come from alternating large-star and small-star steps over the links.

Null or blank text has an empty set and links with nothing.  Repeated rows share their id's
component.  A row without an id keeps null as its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimsight.llm import common as C

#: Most signature values per document; two per permutation.
MOST_VALUES = 192
#: Wanted probability that no band of a linked pair agrees, were all values of a signature independent. The minimum and
#: maximum of one permutation are not: 17 of 20 shingles at 0.85 give 1.8e-6, 4 of 5 at 0.8 give 9.6e-6.
MISS = 1.5e-6
#: Agreement of signatures may fall this many standard deviations below the threshold. A pair at the threshold falls lower
#: with a probability of 2.7e-6 at 0.85 and 1.1e-6 at 0.8, which adds to what the bands miss.
SLACK = 5.0


def plan(percent: int) -> tuple[int, int]:
    """Rows per band and bands: the longest bands that miss a pair at the threshold with at most ``MISS``."""
    t = percent / 100
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log1p(-t ** rows))
        if rows * bands <= MOST_VALUES:
            return rows, bands
    return 1, MOST_VALUES


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = C.mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(C.BASE))
    return seeds[:n], seeds[n:] | np.uint64(1)


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    data, off = C.text_bytes(texts)
    data = C.lower_ascii(data)
    starts, ends, first = C.find_words(data, off)
    h = C.word_hashes(data, starts, ends)
    grams, at = C.windows(h, first, k)
    cuts = np.searchsorted(at, first)
    out = [np.unique(grams[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    n_words = np.diff(first)
    for i in np.flatnonzero((n_words > 0) & (n_words < k)):
        n = int(n_words[i])
        out[i] = C.mixed(C.rolling(h[first[i]:first[i + 1]], n) + np.uint64(n))
    return out


def signatures(sets: list[np.ndarray], values: int) -> np.ndarray:
    """Min and max of every permutation over each non-empty set: one row of ``values`` per set."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    cuts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    out = np.empty((len(sets), values), np.uint64)
    xor, times = _permutations((values + 1) // 2)
    for p, (x, m) in enumerate(zip(xor, times)):
        v = (flat ^ x) * m
        out[:, 2 * p] = np.minimum.reduceat(v, cuts)
        if 2 * p + 1 < values:
            out[:, 2 * p + 1] = np.maximum.reduceat(v, cuts)
    return out


FEATURES = "id long, n_shingles long, digest binary, sig binary, bands array<long>"


def _features(docs: DataFrame, k: int, rows: int, bands: int) -> DataFrame:
    """Set size, digest of the set, one byte of each signature value, and band keys."""
    values = rows * bands
    weights = np.array([pow(C.BASE, j, 1 << 64) for j in range(rows)], np.uint64)
    salt = C.mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, "__text", 1 << 20):
            sets = shingle_sets(C.column(batch, "__text"), k)
            full = [i for i, s in enumerate(sets) if len(s)]
            digest, sig, keys = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if full:
                v = signatures([sets[i] for i in full], values)
                key = C.mixed((v.reshape(-1, bands, rows) * weights).sum(axis=2, dtype=np.uint64) + salt).view(np.int64)
                low = (v >> np.uint64(8)).astype(np.uint8)
                for j, i in enumerate(full):
                    digest[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                    sig[i], keys[i] = low[j].tobytes(), key[j]
            yield pa.RecordBatch.from_arrays(
                [C.column(batch, "id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "digest", "sig", "bands"])

    return docs.mapInArrow(run, FEATURES)


def _alike(pairs: DataFrame, percent: int, values: int) -> DataFrame:
    """Pairs whose sizes and signatures allow the threshold. Needs ``a, b, na, nb, sa, sb``."""
    t = percent / 100
    least = t - SLACK * math.sqrt(t * (1 - t) / values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            two = [np.frombuffer(b"".join(C.column(batch, c).to_pylist()), np.uint8).reshape(-1, values) for c in ("sa", "sb")]
            ok = pa.array((two[0] == two[1]).mean(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([C.column(batch, c).filter(ok) for c in ("a", "b")], names=["a", "b"])

    sized = pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return sized.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _sets_of(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """``id``, ``shingles``: full sets of the documents in ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, "__text", 1 << 20):
            sets = [s.view(np.int64) for s in shingle_sets(C.column(batch, "__text"), k)]
            yield pa.RecordBatch.from_arrays([C.column(batch, "id"), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["id", "shingles"])

    return docs.join(ids, "id", "left_semi").mapInArrow(run, "id long, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold: 100 * intersection >= percent * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = C.column(batch, "x"), C.column(batch, "y")
            ok = []
            for i in range(len(batch)):
                p, q = x[i].values.to_numpy(), y[i].values.to_numpy()
                shared = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * shared >= percent * (len(p) + len(q) - shared))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([C.column(batch, c).filter(ok) for c in ("a", "b")], names=["a", "b"])

    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b"))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``id``, ``component`` (smallest id reachable) of every id in ``links`` (``a``, ``b``).

    Alternates large-star and small-star steps until the edges are stars; each step is an aggregate
    and a join, so a node with very many links is only a skewed join side.
    """
    edges = C.written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _are_stars(edges):
        for large in (True, False):
            sym = edges.union(edges.select("b", "a")).toDF("u", "v")
            low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            if large:
                new = sym.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            else:
                below = sym.where("v < u").join(low, "u")
                new = (below.select(F.col("v").alias("a"), F.col("m").alias("b"))
                       .union(low.where("m < u").select("u", "m")))
            edges = new.where("a <> b").distinct()
        edges = C.written(edges, "edges")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``a`` has one ``b`` and no ``b`` is an ``a``. Edges must have ``b`` < ``a``."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def _merged(comps: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after some more links: only the components that these connect are worked on."""
    if comps is None:
        return C.written(components(links), "components")
    of = lambda c: comps.select(F.col("id").alias(c), F.col("component").alias(f"c{c}"))
    between = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
               .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b"))
    between = C.written(between.distinct(), "between")
    if between.isEmpty():
        return comps
    moved = C.written(components(between), "moved").toDF("old", "new")
    kept = comps.join(moved, F.col("component") == F.col("old"), "left").select("id", F.coalesce("new", "component").alias("component"))
    fresh = moved.toDF("id", "component").join(comps, "id", "left_anti")
    return C.written(kept.union(fresh.select("id", "component")), "components")


def _differences(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``leader, id, comp, bound, n, d`` per member and leader: size of the member's set, and its sorted deviation from the majority.

    ``members`` has each pair of ``leader`` and ``id`` once, with ``comp`` and ``bound`` (whether the member is connected with the leader).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = C.column(batch, "x"), C.column(batch, "y")
            d, n = [], []
            for i in range(len(batch)):
                p, q = x[i].values.to_numpy(), y[i].values.to_numpy()
                d.append(np.setxor1d(p, q, assume_unique=True))
                n.append(len(p))
            yield pa.RecordBatch.from_arrays([*(C.column(batch, c) for c in ("leader", "id", "comp", "bound")), pa.array(n, pa.int64()), pa.array(d, pa.list_(pa.int64()))],
                                             names=["leader", "id", "comp", "bound", "n", "d"])

    def flip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, f = C.column(batch, "d"), C.column(batch, "flips")
            new = [np.setxor1d(d[i].values.to_numpy(), f[i].values.to_numpy()) if f[i].is_valid else d[i].values.to_numpy() for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays([*(C.column(batch, c) for c in ("leader", "id", "comp", "bound", "n")), pa.array(new, pa.list_(pa.int64()))],
                                             names=["leader", "id", "comp", "bound", "n", "d"])

    schema = "leader long, id long, comp long, bound boolean, n long, d array<long>"
    both = (members.join(sets.select("id", F.col("shingles").alias("x")), "id")
            .join(sets.select(F.col("id").alias("leader"), F.col("shingles").alias("y")), "leader"))
    raw = C.written(both.select("leader", "id", "comp", "bound", "x", "y").mapInArrow(run, schema), "differences")
    many = raw.groupBy("leader").agg(F.count(F.lit(1)).alias("m"))
    often = raw.select("leader", F.explode("d").alias("e")).groupBy("leader", "e").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    # Elements in most differences: fewer than twice the mean size of a difference.
    flips = often.join(many, "leader").where("2 * f > m").groupBy("leader").agg(F.collect_list("e").alias("flips"))
    return C.written(raw.join(flips, "leader", "left").select("leader", "id", "comp", "bound", "n", "d", "flips").mapInArrow(flip, schema), "deviations")


def _measured(deviations: DataFrame, percent: int) -> DataFrame:
    """Adds ``size`` of the deviation and ``a``: two members surely link when the sum of their ``a`` is not above 0."""
    q, r = 100 + percent, 100 - percent
    return deviations.withColumn("size", F.size("d").cast("long")).withColumn("a", q * F.col("size") - r * F.col("n"))


def _sure_links(measured: DataFrame) -> DataFrame:
    """Links of members with the one nearest to the majority of their leader: it links with both ends of every sure link."""
    near = measured.groupBy("leader").agg(F.min(F.struct("a", "id", "comp")).alias("z"))
    sure = measured.join(near, "leader").where("a + z.a <= 0 and id <> z.id and comp <> z.comp")
    return sure.select(F.least("id", "z.id").alias("a"), F.greatest("id", "z.id").alias("b"))


def _candidates(measured: DataFrame, percent: int) -> DataFrame:
    """``leader, a, b``: every pair of members in different components that must share elements of their deviations, and can share enough.

    With q = 100 + percent and r = 100 - percent a pair links if and only if its deviations share c elements with
    2q c >= a(x) + a(y).  Elements that a single member has are never shared: with u(y) of these, c <= size(y) - u(y), so also
    q c >= a(x) + q u(y) - r |y|, and |y| is at most 100 |x| / percent.  The least a and u of the possible partners thus
    give a number that x must share; it meets them by all but that many (less one) of its elements, the rarest ones.
    Pairs within the leader's component are not asked for; partners inside and outside of it have limits of their own.
    """
    q, r = 100 + percent, 100 - percent
    often = measured.select("leader", F.explode("d").alias("e")).groupBy("leader", "e").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    of = Window.partitionBy("leader", "id")
    shared = (measured.select("leader", "id", "comp", "bound", "n", "size", "a", F.explode("d").alias("e")).join(often, ["leader", "e"])
              .withColumn("can", F.count(F.lit(1)).over(of)).withColumn("place", F.row_number().over(of.orderBy("f", "e"))))
    shared = C.written(shared, "shared")
    first = shared.where("place = 1").withColumn("u", F.col("size") - F.col("can"))
    least = first.groupBy("leader").agg(*[F.min(F.when(F.col("bound") == side, F.col(c))).alias(f"{name}_{c}")
                                          for name, side in (("free", False), ("bound", True)) for c in ("a", "u")])
    longest = r * F.floor(100 * F.col("n") / F.lit(percent) + 1e-9)

    def places(partner: str) -> Column:  # none (null) without such partners
        must = F.greatest(F.lit(1), F.ceil((F.col("a") + F.col(f"{partner}_a")) / (2.0 * q) - 1e-9),
                          F.ceil((F.col("a") + q * F.col(f"{partner}_u") - longest) / F.lit(float(q)) - 1e-9))
        return F.when(F.col(f"{partner}_a").isNotNull(), F.col("can") - must + 1)

    index = (shared.join(least, "leader").withColumn("to_free", F.coalesce(F.col("place") <= places("free"), F.lit(False)))
             .withColumn("to_bound", F.coalesce(~F.col("bound") & (F.col("place") <= places("bound")), F.lit(False))).where("to_free or to_bound"))
    held = ["leader", "e", "id", "comp", "bound", "n", "can", "a", "to_free", "to_bound"]
    index = C.written(index.select(held), "index")
    left = index.where("not bound").select("leader", "e", *[F.col(c).alias(f"{c}_") for c in held[2:]])
    may = (f"to_free and comp <> comp_ and (bound and to_bound_ or not bound and to_free_ and id_ < id) "
           f"and 100 * least(n, n_) >= {percent} * greatest(n, n_) and {2 * q} * least(can, can_) >= a + a_")
    met = index.join(left, ["leader", "e"]).where(may)
    return met.select("leader", F.least("id", "id_").alias("a"), F.greatest("id", "id_").alias("b")).distinct()


def _links_by_deviations(candidates: DataFrame, deviations: DataFrame, percent: int) -> DataFrame:
    """Candidates that link: the deviations tell the symmetric difference of the full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = C.column(batch, "x"), C.column(batch, "y")
            n = C.column(batch, "n").to_numpy()
            apart = np.array([len(x[i]) + len(y[i]) - 2 * len(np.intersect1d(x[i].values.to_numpy(), y[i].values.to_numpy(), assume_unique=True))
                              for i in range(len(batch))], np.int64)
            ok = pa.array((100 + percent) * apart <= (100 - percent) * n)
            yield pa.RecordBatch.from_arrays([C.column(batch, c).filter(ok) for c in ("a", "b")], names=["a", "b"])

    both = (candidates.join(deviations.select("leader", F.col("id").alias("a"), F.col("d").alias("x"), F.col("n").alias("nx")), ["leader", "a"])
            .join(deviations.select("leader", F.col("id").alias("b"), F.col("d").alias("y"), F.col("n").alias("ny")), ["leader", "b"]))
    return both.select("a", "b", (F.col("nx") + F.col("ny")).alias("n"), "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int, percent: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` (under its own name), ``n_shingles`` and ``component_id`` of every row of ``docs``.

    Documents link when 100 * intersection >= ``percent`` * union of their shingle sets.
    """
    rows, bands = plan(percent)
    values = rows * bands
    own = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("__text"))
    feats = C.written(_features(own, k, rows, bands), "minmax")
    # Classes of equal sets; the smallest id stands for its class.
    twins = C.written(feats.where("digest is not null and id is not null").groupBy("digest")
                      .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1")
                      .select("digest", "rep"), "twins")
    feats = C.written(feats.join(twins, "digest", "left").select(
        "id", "n_shingles", F.coalesce("rep", "id").alias("rep"),
        F.when(F.coalesce("rep", "id") == F.col("id"), F.col("sig")).alias("sig"),
        F.when(F.coalesce("rep", "id") == F.col("id"), F.col("bands")).alias("bands")), "classes")
    nodes = feats.where("sig is not null").select("id", "n_shingles", "sig")
    banded = feats.where("bands is not null").select("id", F.explode("bands").alias("key"))
    shared = C.written(banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    members = C.written(banded.join(shared, "key"), "crowds")
    weights = members.groupBy("id").agg(F.sum("n").alias("weight"))
    members = C.written(members.join(weights, "id").select("key", "id", "weight", F.col("id").alias("comp")), "members")
    comps = sets = None
    if not members.isEmpty():
        leaders = C.written(members.groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("l"))
                            .select("key", (-F.col("l.minus")).alias("leader")), "leaders")
        crowd = members.join(leaders, "key").where("id <> leader").select("key", "id", "leader")
        pairs = C.written(crowd.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct(), "met")
        sized = (pairs.join(nodes.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa")), "a")
                 .join(nodes.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb")), "b"))
        pairs = C.written(_alike(sized, percent, values), "pairs")
        if not pairs.isEmpty():
            # Written first: Spark then knows the size of the ids, and moves no texts to them if they are few.
            ids = C.written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ids")
            sets = C.written(_sets_of(own, ids, k), "sets")
            comps = _merged(comps, C.written(_confirmed(pairs, sets, percent), "links"))
        # Buckets whose other members are connected are done with.
        of = comps if comps is not None else nodes.select("id", F.col("id").alias("component")).limit(0)
        rest = C.written(crowd.join(of, "id", "left").select("key", "id", "leader", F.coalesce("component", "id").alias("comp"))
                         .join(of.select(F.col("id").alias("leader"), F.col("component").alias("top")), "leader", "left")
                         .withColumn("bound", F.col("comp") == F.coalesce("top", "leader")), "rest")
        open_ = rest.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
        open_ = C.written(rest.join(open_, "key", "left_semi").select("leader", "id", "comp", "bound").distinct(), "open")
        if not open_.isEmpty():
            ids = open_.select("id").union(open_.select("leader")).distinct()
            ids = C.written(ids if sets is None else ids.join(sets.select("id"), "id", "left_anti"), "ids")
            if sets is None or not ids.isEmpty():
                more = C.written(_sets_of(own, ids, k), "sets")
                sets = more if sets is None else sets.union(more)
            deviations = _measured(_differences(open_, sets), percent)
            new = _sure_links(deviations).union(_links_by_deviations(C.written(_candidates(deviations, percent), "met"), deviations, percent))
            comps = _merged(comps, C.written(new.distinct(), "links"))

    result = feats.select("id", "n_shingles", "rep")
    if comps is not None:
        result = (result.join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left")
                  .select("id", "n_shingles", F.coalesce("component", "rep").alias("component_id")))
    else:
        result = result.withColumnRenamed("rep", "component_id")
    return result.select(F.col("id").alias(id), "n_shingles", "component_id")

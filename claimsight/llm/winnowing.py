"""Document fingerprints by winnowing (operator 4), with DataFrame functions only.

The units of a text are its code points, every run of ASCII white space counting as one space and
none at the ends (``CHARACTERS``), or its words ``[^\\x20\\x09-\\x0D]+`` (``WORDS``, only for texts whose
script puts spaces between words).  Every ``k`` consecutive units get a rolling polynomial hash of
the unit hashes (fewer units: all of them as one gram).  Of every ``w`` consecutive grams the smallest
hash is kept, the rightmost of equal ones, with its position; near the end the windows hold the grams
that are left.  So any run of ``k + w - 1`` units that two texts share yields a common fingerprint,
and grams whose run is shorter than ``k`` units never match.

A fingerprint is an array of longs, ``hash * 2**31 + (2**31 - 1 - position)``, in text order: the
smallest such number is the smallest hash at its rightmost position, which is what a sliding
minimum by doubling keeps.  Everything is array expressions inside one row.

Null and blank texts have an empty fingerprint; two empty ones have likeness 1.  A text is one row of
arrays, about 100 bytes of memory per character.  Rows without an id, and rows of one id, lie in one range of ids,
which is not split.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsight.llm.common import shuffle_partitions

WORDS, CHARACTERS = "words", "characters"
#: Units per gram and grams per window, for words and for characters.
K, W = 3, 4
CHARACTER_K, CHARACTER_W = 8, 8
#: Modulus (a Mersenne prime) and base of the polynomial hash; positions use the same bound.
PRIME, BASE, PLACES = (1 << 31) - 1, 1_000_003, 1 << 31
BLANKS = " \t\n\x0b\x0c\r"


def _solid(text: Column) -> Column:
    """``text`` without blanks at its ends and with every run of blanks as one space."""
    # Single spaces, which are most of the blanks, stay without a replacement.
    return F.regexp_replace(F.btrim(text, F.lit(BLANKS)), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _unit_hashes(text: Column, units: str) -> Column:
    text = F.coalesce(text, F.lit(""))
    if units == WORDS:
        solid = F.btrim(text, F.lit(BLANKS))
        parts = F.split(solid, r"[\x20\x09-\x0D]+")
    elif units == CHARACTERS:
        solid = _solid(text)
        parts = F.split(solid, "")
    else:
        raise ValueError(f"unknown units: {units}")
    parts = F.when(solid == "", F.array().cast("array<string>")).otherwise(parts)
    return F.transform(parts, lambda x: F.pmod(F.xxhash64(x), F.lit(PRIME)))


def _step(a: Column, b: Column, base: int = BASE) -> Column:
    return (a * F.lit(base) + b) % F.lit(PRIME)


def _with_minima(df: DataFrame, h: str, out: str, k: int, w: int, offset: Column | None = None) -> DataFrame:
    """``df`` with a column ``out``: the minimum of every window of grams of the unit hashes ``h``; the first unit is at ``offset``."""
    df, have = df.withColumn("__wg", F.col(h)), 1
    while have < k:  # grams of 2, 4, ... units from two halves, then one unit more at a time
        step = have if 2 * have <= k else 1
        m = F.greatest(F.size("__wg") - step, F.lit(0))
        more = F.slice("__wg" if step == have else h, F.lit(have + 1), m)
        shift = pow(BASE, step, PRIME)
        df = df.withColumn("__wg", F.zip_with(F.slice("__wg", F.lit(1), m), more, lambda a, b: _step(a, b, shift)))
        have += step
    n = F.size(h)
    whole = F.array(F.aggregate(h, F.lit(0).cast("long"), lambda a, b: _step(a, b)))
    # An empty array has no gram; one to k - 1 units are one gram.
    grams = F.when(n >= k, F.col("__wg")).when(n > 0, whole).otherwise(F.array().cast("array<long>"))
    last = F.lit(PLACES - 1) if offset is None else F.lit(PLACES - 1) - offset
    df = df.withColumn(out, F.transform(grams, lambda g, i: g * F.lit(PLACES) + (last - i))).drop("__wg")
    have = 1
    while have < w:  # minimum of 2, 4, ... grams; the last step may overlap
        step = min(have, w - have)
        df = df.withColumn(out, F.zip_with(out, F.slice(out, F.lit(step + 1), F.size(out)), lambda a, b: F.least(a, b)))
        have += step
    return df


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, w: int = W, units: str = WORDS) -> DataFrame:
    """``df`` with a column ``out``: the fingerprint of ``text``. Row-wise; uses columns named ``__w*``."""
    df = _with_minima(df.withColumn("__wh", _unit_hashes(F.col(text), units)), "__wh", "__wv", k, w)
    return df.withColumn(out, F.array_distinct("__wv")).drop("__wh", "__wv")


def _with_both(df: DataFrame, k: int, w: int) -> DataFrame:
    """``df`` with ``fingerprint`` of ``__text`` and ``edited_fingerprint`` of ``__head`` (a prefix of ``__text``) and ``__tail`` together.

    Units are characters, so the units of the head are the first ones of the text.  All windows that lie in them are the text's; only the
    others are computed, from the last units of the head and those of the tail.
    """
    df = _with_minima(df.withColumn("__wh", _unit_hashes(F.col("__text"), CHARACTERS)), "__wh", "__wv", k, w)
    df = df.withColumn("fingerprint", F.array_distinct("__wv")).withColumn("__wt", _unit_hashes(F.col("__tail"), CHARACTERS))
    df = df.withColumn("__wm", F.length(_solid(F.col("__head")))).withColumn("__wo", F.greatest(F.col("__wm") - (k + w - 1), F.lit(0)))
    blank = F.rtrim("__head", F.lit(BLANKS)) != F.col("__head")
    blank = (blank | (F.ltrim("__tail", F.lit(BLANKS)) != F.col("__tail"))) & (F.col("__wm") > 0) & (F.size("__wt") > 0)
    between = F.when(blank, F.array(F.pmod(F.xxhash64(F.lit(" ")), F.lit(PRIME)))).otherwise(F.array().cast("array<long>"))
    df = df.withColumn("__we", F.concat(F.slice("__wh", F.col("__wo") + 1, F.col("__wm") - F.col("__wo")), between, F.col("__wt")))
    df = _with_minima(df, "__we", "__wx", k, w, F.col("__wo"))
    df = df.withColumn("edited_fingerprint", F.array_distinct(F.concat(F.slice("__wv", F.lit(1), F.col("__wo")), F.col("__wx"))))
    return df.drop("__wh", "__wv", "__wt", "__wm", "__wo", "__we", "__wx")


def hashes(fingerprint: str) -> Column:
    """The distinct gram hashes of a fingerprint, without positions."""
    return F.array_distinct(F.transform(F.col(fingerprint), lambda x: F.shiftright(x, 31)))


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two arrays of gram hashes; 1 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(F.col(a)) + F.size(F.col(b)) - shared
    return F.when(every == 0, F.lit(1.0)).otherwise(shared / every)


def in_order(docs: DataFrame, id: str, text: str, groups: int | None = None) -> tuple[DataFrame, Window]:
    """Rows dealt into ``__g`` ranges of ascending ``id`` such that every row finds its successor in its own range.

    The first row of each range is also copied to the end of the range before (the very first to the
    end of the last), marked by ``__copy`` = 1.  Returns the rows and the window that orders a range;
    range limits are approximate quantiles, which are ids that occur.  Null ids come first.
    """
    groups = groups or 2 * shuffle_partitions(docs.sparkSession)
    share = [i / groups for i in range(1, groups)] or [0.5]
    low, cuts = docs.agg(F.min(id), F.percentile_approx(id, share, max(10_000, 20 * groups))).first()
    if low is None:
        cuts = [0]
    else:
        cuts = sorted({low, *(cuts or [])})
    side = math.isqrt(len(cuts) - 1) + 1
    fine = [cuts[i:i + side] for i in range(0, len(cuts), side)]
    key = F.coalesce(F.col(id), F.lit(cuts[0]))
    upto = lambda values: F.size(F.filter(values, lambda s: s <= F.col("__k")))
    longs = lambda xs: F.array(*[F.lit(int(x)).cast("long") for x in xs])
    rows = docs.withColumn("__k", key.cast("long")).withColumn("__c", upto(longs(x[0] for x in fine)))
    inside = F.element_at(F.array(*[longs(x) for x in fine]), F.col("__c"))
    rows = rows.withColumn("__i", inside).withColumn("__at", (F.col("__c") - 1) * side + upto(F.col("__i")) - 1)
    first = F.element_at(F.col("__i"), F.col("__at") % side + 1) == F.col("__k")
    before = F.when(F.col("__at") == 0, F.lit(len(cuts) - 1)).otherwise(F.col("__at") - 1)
    own, copy = (F.struct(g.cast("int").alias("g"), F.lit(c).alias("c")) for g, c in ((F.col("__at"), 0), (before, 1)))
    rows = (rows.withColumn("__p", F.explode(F.when(first, F.array(own, copy)).otherwise(F.array(own))))
            .withColumn("__g", F.col("__p.g")).withColumn("__copy", F.col("__p.c"))
            .drop("__k", "__c", "__i", "__at", "__p"))
    return rows, Window.partitionBy("__g").orderBy("__copy", id, text)


def edited_and_next(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = K, w: int = W,
                    units: str = WORDS) -> DataFrame:
    """Per row of ``docs``: ``id``, ``n_chars``, ``edited_sha256``, ``fingerprint`` and ``edited_fingerprint``
    (arrays of longs), ``near_edited`` and ``near_next``.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or all)
    of the next document in ascending id; the last document's next one is the first.
    """
    rows, order = in_order(docs.select(F.col(id), F.coalesce(F.col(text), F.lit("")).alias("__text")), id, "__text")
    rows = rows.withColumn("__next", F.lead("__text").over(order))
    n = F.length("__text")
    tail = F.floor(n / 4).cast("int")
    rows = rows.withColumn("__head", F.substr("__text", F.lit(1), n - tail)).withColumn("__tail", F.substr("__next", F.lit(1), tail))
    rows = rows.withColumn("n_chars", n.cast("long")).drop("__next")
    edited = F.concat("__head", F.coalesce("__tail", F.lit("")))
    rows = rows.withColumn("edited_sha256", F.sha2(edited, 256))
    if units == CHARACTERS:
        rows = _with_both(rows.withColumn("__tail", F.coalesce("__tail", F.lit(""))), k, w).drop("__text")
    else:
        rows = with_fingerprint(rows.withColumn("__edited", edited), "__text", "fingerprint", k, w, units).drop("__text")
        rows = with_fingerprint(rows, "__edited", "edited_fingerprint", k, w, units).drop("__edited")
    rows = rows.drop("__head", "__tail")
    rows = rows.withColumn("__h", hashes("fingerprint")).withColumn("__e", hashes("edited_fingerprint"))
    rows = rows.withColumn("near_edited", likeness("__h", "__e")).drop("__h", "__e")
    # The rows are still in order (equal ids too), so the successor's hashes cost no further exchange or sort.
    still = Window.partitionBy("__g").orderBy("__copy", id)
    rows = rows.withColumn("__next", F.lead("fingerprint").over(still)).where("__copy = 0")
    rows = rows.withColumn("__h", hashes("fingerprint")).withColumn("__n", hashes("__next"))
    return rows.select(id, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                       likeness("__h", "__n").alias("near_next"))

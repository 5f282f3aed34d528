import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimsight.llm import minmax, substring
from tests.llm import brute

SCHEMA = "doc_id long, text string, id int, key string, kept_text string, n_words long, comp int"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, "k", "x", 2, 3) for i, t in rows], SCHEMA)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    passage, rows = text(12), []
    base = text(80)
    for i in range(n):
        kind = i % 6
        w = text(rng.randrange(0, 60))
        if kind == 1:  # near copies of one text
            w = list(base)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
        elif kind == 2:  # a shared passage
            w[len(w) // 2:len(w) // 2] = passage
        elif kind == 3:  # exact copies, other case and spacing
            w = [x.upper() for x in base[:30]]
        elif kind == 4:  # repeats inside
            w = w + w[:15]
        rows.append((i * 3, rng.choice([" ", "\n", "  \t"]).join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_against_brute_force(spark, seed):
    rows = corpus(seed)
    for chunk in (1 << 24, 200):
        out = substring.remove_repeated(frame(spark, rows).select("doc_id", "text"), ["doc_id"], 7, chunk_bytes=chunk)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in out.collect()}
        want = brute.substring([t for _, t in rows], 7)
        assert got == {i: w for (i, _), w in zip(rows, want)}
    assert 0 < sum(w[1] for w in want) < sum(w[0] for w in want)


def test_windows_edges(spark):
    long = " ".join(f"u{i}" for i in range(150_000))
    rows = [(1, None), (2, ""), (3, "\t \n"), (4, "a b"), (5, "p q r s"), (5, "p q r s"), (None, "x p q r"), (7, "z z z z z"),
            (8, long), (9, "a\x1cb c d é")]
    docs = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, __x string")
    out = substring.remove_repeated(docs, ["doc_id", "__x"], 3)
    want = brute.substring([t for _, t in rows], 3)
    key = lambda r: (r[0] or 0, *r[1])
    assert sorted(((r.doc_id, (r.n_words, r.n_removed, r.kept_text)) for r in out.collect()), key=key) == sorted(
        ((i, w) for (i, _), w in zip(rows, want)), key=key)
    as_is = {r.doc_id: r.kept_text for r in substring.remove_repeated(docs, ["doc_id"], 3, rejoin=False).collect()}
    assert as_is[1] is None and as_is[3] == "\t \n" and as_is[9] == "a\x1cb c d é" and as_is[7] == ""
    assert substring.remove_repeated(docs.limit(0), ["doc_id"], 3).count() == 0


@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=50))
@settings(max_examples=100, deadline=None)
def test_packed_hashes(xs):
    keys = np.unique(np.array(xs, np.uint64))
    assert substring.unpack(substring.pack(keys)).tolist() == keys.tolist()


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80), (2, 50)])
def test_groups_against_brute_force(spark, k, percent):
    rows = corpus(k, 90)
    got = minmax.near_duplicates(frame(spark, rows), k, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == brute.components(rows, k, percent)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(brute.shingles(t, k)) for i, t in rows}


def test_chain_in_one_bucket_needs_more_rounds(spark):
    """Neighbours in a chain link, its ends do not: members that miss the leader are compared further."""
    words = [f"t{i}" for i in range(140)]
    rows = [(100 - i, " ".join(words[4 * i:4 * i + 60])) for i in range(20)]
    want = brute.components(rows, 1, 85)
    assert len(set(want.values())) == 1
    got = minmax.near_duplicates(frame(spark, rows), 1, 85)
    assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_group_edges(spark):
    long = " ".join(f"u{i}" for i in range(60_000))
    rows = [(4, None), (5, ""), (6, " \n"), (7, "One two"), (3, "one TWO"), (8, "one"), (9, "Ä"), (10, "ä"), (None, "one two"),
            (11, long), (12, long + " end"), (13, "same row"), (13, "same row")]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in minmax.near_duplicates(frame(spark, rows), 3, 85).collect() if r.doc_id)
    assert got == [(3, 1, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 1, 3), (8, 1, 8), (9, 1, 9), (10, 1, 10),
                   (11, 59998, 11), (12, 59999, 11), (13, 1, 13), (13, 1, 13)]
    assert minmax.near_duplicates(frame(spark, rows).limit(0), 3, 85).count() == 0
    assert minmax.near_duplicates(frame(spark, rows).where("doc_id is null"), 3, 85).collect()[0].component_id is None


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for share in (0.5, 0.8, 0.9):
        n = int(400 * share)
        y = np.concatenate((x[:n], rng.integers(0, 1 << 63, 400 - n, dtype=np.uint64)))
        s = minmax.signatures([np.sort(x), np.sort(y)], 2000)
        assert abs((s[0] == s[1]).mean() - n / (800 - n)) < 0.05


def test_band_plan_meets_its_miss_rate():
    for percent in range(40, 96, 5):
        rows, bands = minmax.plan(percent)
        if rows > 1:
            assert (1 - (percent / 100) ** rows) ** bands <= minmax.MISS and rows * bands <= minmax.MOST_VALUES


def test_components_of_a_long_path(spark):
    links = spark.range(60).select((F.col("id") + 1).alias("a"), F.col("id").alias("b")).union(spark.createDataFrame([(200, 100)], "a long, b long"))
    got = {r.id: r.component for r in minmax.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100}


def template_copies(n, seed, edits, length=150):
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(length)]
    rows = [(0, " ".join(base))]
    for i in range(1, n):
        w = list(base)
        for at in rng.sample(range(length), rng.choice(edits)):
            w[at] = f"e{rng.randrange(10 ** 9)}"
        rows.append((i, " ".join(w)))
    return rows


def deviations_of(spark, rows, k, percent):
    """All rows as members of the first one's bucket, none connected but with links to it."""
    sets = minmax._sets_of(spark.createDataFrame(rows, "id long, __text string"), spark.createDataFrame([(i,) for i, _ in rows], "id long"), k).cache()
    links = minmax._confirmed(spark.createDataFrame([(rows[0][0], i) for i, _ in rows[1:]], "a long, b long"), sets, percent)
    bound = {r.b for r in links.collect()}
    members = spark.createDataFrame([(rows[0][0], i, rows[0][0] if i in bound else i, i in bound) for i, _ in rows[1:]],
                                    "leader long, id long, comp long, bound boolean")
    return minmax._measured(minmax._differences(members, sets), percent), bound


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80), (1, 60)])
def test_differences_lose_no_link(spark, k, percent):
    """Sure links and candidates cover every linked pair of one bucket, whatever the leader."""
    rows = template_copies(120, k, [1, 2, 3, 4, 6, 9, 30])
    rng = random.Random(k)
    for i in range(120, 150):  # edits of edited copies, and strangers
        w = rows[rng.randrange(1, 60)][1].split() if i < 145 else [f"s{rng.randrange(40)}" for _ in range(100)]
        w[rng.randrange(len(w))] = f"x{i}"
        rows.append((i, " ".join(w)))
    if k == 5:
        rows[0] = (0, " ".join(f"other{i}" for i in range(100)))  # a leader that links with nobody
    measured, bound = deviations_of(spark, rows, k, percent)
    sets = {i: brute.shingles(t, k) for i, t in rows}
    want = {(i, j) for i in sets for j in sets if 0 < i < j and not (i in bound and j in bound)
            and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}
    candidates = minmax._candidates(measured, percent)
    found = {(r.a, r.b) for r in minmax._links_by_deviations(candidates, measured, percent).collect()}
    sure = {(r.a, r.b) for r in minmax._sure_links(measured).collect()}
    assert found <= want and all(100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) for i, j in sure)
    root = {i: 0 if i in bound else i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in found | sure:
        root[max(find(i), find(j))] = min(find(i), find(j))
    assert all(find(i) == find(j) for i, j in want) and want


def test_copies_that_do_not_link_hardly_meet(spark):
    """2,000 copies of a template, most of them below the threshold with each other: far fewer pairs than 2,000 squared."""
    measured, bound = deviations_of(spark, template_copies(2000, 1, range(2, 12)), 3, 85)
    assert len(bound) < 1500 and minmax._candidates(measured, 85).count() < 10 * 2000


def test_group_of_copies_without_their_template(spark):
    rows = template_copies(150, 4, range(1, 9))[1:]
    got = {r.doc_id: r.component_id for r in minmax.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert got == brute.components(rows, 3, 85)

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimsight.llm import ann, html_text, queries, winnowing
from tests.conftest import SF0001, SF001
from tests.llm import brute


def test_recall_and_order(spark):
    got = queries.op2_nearest(spark, SF001).toPandas()
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, v = rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), float)
    hit = total = 0
    for q, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        s = v @ v[ids == q][0]
        s[ids == q] = -np.inf
        true = np.lexsort((ids, -s))[:20]
        hit, total = hit + len(set(part.vec_id) & set(ids[true])), total + 20
        assert part["rank"].tolist() == list(range(1, 21)) and q not in set(part.vec_id)
        assert np.allclose(part.score, s[np.searchsorted(ids, part.vec_id)], atol=1e-12, rtol=0)
        assert (np.diff(part.score) <= 0).all()
    assert total == 20 * (ids % 20 == 0).sum() and hit / total >= 0.9


def test_recall_of_every_length(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=d)]) for d, ids in ((8, range(0, 900)), (24, range(1000, 1600))) for i in ids]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, e array<double>"), "vec_id % 20 = 0", 10, "vec_id", "e", block_rows=400, group_rows=20).toPandas()
    for d, low, high in ((8, 0, 900), (24, 1000, 1600)):
        ids = np.array([i for i, _ in rows if low <= i < high])
        v = np.array([x for i, x in rows if low <= i < high])
        hit = total = 0
        for q in ids[ids % 20 == 0]:
            s = v @ v[q - low]
            s[q - low] = -np.inf
            mine = set(got[got.query_id == q].vec_id)
            hit, total = hit + len(mine & set(ids[np.lexsort((ids, -s))[:10]])), total + 10
        assert len(mine) == 10 and hit / total >= 0.9


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 5.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0]), (10, [-1.0, 0.5]), (None, [9.0, 9.0])]
    vectors = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, e array<float>, block int, rank int")
    for block_rows in (100, 2):
        got = ann.search(vectors, "vec_id % 10 = 0", 3, "vec_id", "e", block_rows=block_rows, group_rows=1).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [
            (0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 3, 0.0), (10, 1, 3, 2.5), (10, 2, 0, -1.0), (10, 3, 1, -2.0)]
    # A query of another length finds the vectors of its own length.
    other = spark.createDataFrame([(20, [1.0, 0.0, 2.0]), (21, [3.0, 1.0, 1.0]), (22, [0.0, 0.0, 1.0]), (30, [2.0])], "vec_id long, e array<float>")
    got = ann.search(vectors.select("vec_id", "e").union(other), "vec_id % 10 = 0", 3, "vec_id", "e").collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got if r.query_id >= 20) == [
        (20, 1, 21, 5.0), (20, 2, 22, 2.0), (30, 1, 9, 2.0)]
    many = ann.search(vectors, "vec_id = 0", 50, "vec_id", "e").collect()
    assert [r.vec_id for r in sorted(many, key=lambda r: r["rank"])] == [1, 2, 3, 10]
    assert ann.search(vectors.limit(0), "true", 3, "vec_id", "e").count() == 0
    assert ann.search(vectors, "false", 3, "vec_id", "e").count() == 0
    with pytest.raises(ValueError):
        ann.search(vectors, "true", 3, "vec_id", "e", threshold=500)


PAGES = [
    ("<p>a<p>b", "a\n\nb"),
    ("<title>t</title><style>s</style><script>if(a<b){'</p>'}</script>x", "x"),
    ("one <b>two</b>\n  three&amp;four&nbsp;&copy", "one two three&four ©"),
    ("<ul><li>a<li>b<ol start=3><li>c<li value=9>d</ol><li>e</ul>", "- a\n- b\n  3. c\n  9. d\n- e"),
    ("<table><tr><th>Name<th>Qty<tr><td>Apples<td>3<tr><td colspan=2>both</table>", "Name   | Qty\nApples | 3\nboth"),
    ("<table><td>x<td>y</table>", "x | y"),
    ("a<div hidden>no</div><div style='Display : NONE'>no</div><span style=visibility:hidden>no</span>b", "ab"),  # an element that is not displayed breaks no line
    ("<pre>\n a  b\n   c</pre>d", " a  b\n   c\n\nd"),
    ("x<br>y<br><br>z", "x\ny\n\nz"),
    ("<h1>H</h1>t<!-- <p>c</p> --><hr>u", "H\n\nt\n\n---\n\nu"),
    ("1 < 2 > 1 <3", "1 < 2 > 1 <3"),
    ("<a title='a>b' href=x>l</a></b></p>m", "lm"),
    ("<dl><dt>T<dd>D<dt>U</dl>", "T\n  D\nU"),
    ("<select><option>o<option>p</select>", "o\np"),
    ("<template>no</template><noscript>no</noscript><img alt='pic'>", "pic"),
    ("", ""), ("<p", ""), ("<!-- never", ""), (None, None),
]


@pytest.mark.parametrize("source, text", PAGES)
def test_page(source, text):
    assert html_text.page_text(source) == text


FOREIGN_PAGES = [
    ("a <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> b", "a x=1 2 b"),
    ("<math><semantics><mi>x</mi><annotation encoding='t'>tex</annotation></semantics></math>y", "xy"),
    ("a<svg width=9><title>t</title><desc>d</desc><g>no<text x=1>Sales</text><text>2 <tspan>units</tspan></text></g></svg>b", "a Sales 2 units b"),
    ("<svg><defs/><style/><path d='M0'/><text>in</text></svg>out", "in out"),
    ("<svg><defs><text>no</text></defs><text display='none'>no</text><text><![CDATA[a<b]]></text></svg>", "a<b"),
    ("<svg><foreignObject><p>html</p></foreignObject></svg>x", "html\n\nx"),
    ("<svg><g><p>out of it", "out of it"),
    ("<svg><a href=x/><text>t</text></a></svg>u", "t u"),
    ("<symbol>s</symbol><desc>d</desc><text>t</text>", "sdt"),  # unknown elements of HTML are shown
    ("a<!-->b", "ab"), ("a<!--->b", "ab"), ("a<!-- c --!>b", "ab"), ("a<!---->b<!-- -->c", "abc"), ("a<!--!>b-->c", "ac"),
]


@pytest.mark.parametrize("source, text", FOREIGN_PAGES)
def test_page_with_formulas_drawings_and_empty_comments(source, text):
    assert html_text.page_text(source) == text


LAYOUT_PAGES = [
    ("x<table><tr><td>c</td></tr>stray</table>", "xstray\n\nc"),
    ("<table><tr><td>c</td></tr><a href=x>link</a> tail</table>z", "link tail\n\nc\n\nz"),
    ("<table><b><tr><td>x</table>y", "x\n\ny"), ("<table><form><tr><td>x</form></table>", "x"),
    ("<table>a<tr>b<td>c<table>d<td>e</table></table>", "ab\n\ncd\ne"),
    ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no</div>", "yes"),
    ("<ul style=visibility:hidden><li>no<li style=visibility:visible>b</ul>", "- b"),
    ("a<dialog>no</dialog><dialog open>yes</dialog>", "a\nyes"),
    ("<details><summary>s</summary>no<summary>no</summary></details><details open><summary>t</summary>body</details>", "s\nt\nbody"),
    ("<table><tr><td rowspan=2>A<td>b1<tr><td>b2</table>", "A | b1\n  | b2"),
    ("<table><tr><td rowspan=0>A<td>1<td rowspan=2>x<tr><td>2<tr><td>3<td>y</table>", "A | 1 | x\n  | 2\n  | 3 | y"),
    ("<table><tr><td>" + "x" * 60 + "<td>n<tr><td>a<td>b</table>", "x" * 60 + " | n\na" + " " * 60 + "| b"),
    ("<table><tr><td colspan=2>spanning cell<td>z<tr><td>a<td>b<td>c</table>", "spanning cell | z\na | b         | c"),
    ("<table><tr><td colspan=90>wide<td>z<tr><td>a<td>b</table>", "wide  | z\na | b"),
    ("<table><tr><td>" + "word " * 30 + "<td>n</table>", ("word " * 16).strip() + " | n\n" + ("word " * 14).strip() + " " * 11 + "|"),
    ("<table><tr><td>n<td>" + "word " * 30 + "</table>", "n | " + ("word " * 30).strip()),  # nothing follows: not broken
    ("<ol reversed><li>a<li>b<li value=9>c<li>d</ol><ol reversed start=5><li>e</ol>", "4. a\n3. b\n9. c\n8. d\n\n5. e"),
]


@pytest.mark.parametrize("source, text", LAYOUT_PAGES)
def test_page_layout(source, text):
    assert html_text.page_text(source) == text


@settings(max_examples=150, deadline=None)
@given(st.randoms(use_true_random=False))
def test_every_visible_text_of_a_tree_is_shown(rng):
    """Random well-formed trees: each visible word is in the output once, no hidden one is."""
    seen, unseen, n = [], [], [0]

    def word(shown):
        n[0] += 1
        (seen if shown else unseen).append(f"w{n[0]}w")
        return f" w{n[0]}w "

    def node(depth, shown, there):
        kind = rng.randrange(9)
        inside = lambda s=shown, t=there: "".join(node(depth + 1, s, t) for _ in range(rng.randrange(1, 4)))
        if depth > 4 or kind < 2:
            return word(shown and there)
        if kind == 2:
            return f"<table>{'<caption>' + inside() + '</caption>' if rng.random() < 0.3 else ''}" + "".join(
                "<tr>" + "".join(f"<td colspan={rng.randrange(1, 4)} rowspan={rng.randrange(0, 4)}>{inside()}</td>" for _ in range(rng.randrange(1, 4)))
                + (word(shown and there) if rng.random() < 0.3 else "") + "</tr>" for _ in range(rng.randrange(1, 4))) + "</table>"
        if kind == 3:
            return f"<{(k := rng.choice(['ul', 'ol', 'ol reversed']))}>" + "".join(f"<li>{inside()}</li>" for _ in range(rng.randrange(1, 4))) + f"</{k[:2]}>"
        if kind == 4:
            return f"<div style='visibility:hidden'>{inside(False)}</div>"
        if kind == 5:
            return f"<span style='visibility:visible'>{inside(True)}</span>"
        if kind == 6:
            tag, gone = rng.choice([("dialog", True), ("dialog open", False), ("div hidden", True), ("section", False), ("details open", False)])
            return f"<{tag}>{inside(shown, there and not gone)}</{tag.split()[0]}>"
        return f"<{(k := rng.choice(['b', 'div', 'blockquote', 'pre', 'section']))}>{inside()}</{k}>"

    source = "".join(node(0, True, True) for _ in range(4))
    got = html_text.page_text(source).split()
    assert sorted(w for w in got if w.startswith("w")) == sorted(seen)


def test_deep_drawings():
    assert html_text.page_text("<svg>" + "<g>" * 30_000 + "<text>x") == "x"
    assert html_text.page_text("<math>" * 10_000 + "<mi>x") == "x"


def test_deep_and_broken_pages():
    for bad in ("<div>" * 30_000 + "x", "<table><tr><td>" * 2000 + "x", "<ul><li>" * 1000 + "x", "<i>" * 20_000 + "</b>" * 20_000 + "x"):
        assert html_text.page_text(bad).strip().endswith("x")
    assert html_text.page_text("<" * 5000) == "<" * 5000


def test_pages_as_rows(spark):
    pages = spark.createDataFrame([(i, s, "k") for i, (s, _) in enumerate(PAGES)] + [(None, "<p>a", "k")], "page_id int, html string, text string")
    got = html_text.extract(pages.drop("text"), ["page_id"]).collect()
    assert {r.page_id: r.text for r in got} == {**{i: t for i, (_, t) in enumerate(PAGES)}, None: "a"}
    assert html_text.extract(pages.drop("text").limit(0), ["page_id"]).count() == 0
    full = queries.op3_page_text(spark, SF0001)
    sources = {r.page_id: r.html for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect()}
    assert {r.page_id: r.text for r in full.collect()} == {i: html_text.page_text(s) for i, s in sources.items()}


def edited(rows):
    """Brute force of the query: rows of (id, text) in ascending id."""
    out = []
    for i, (key, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        q = len(text) // 4
        e = text[:len(text) - q] + following[:q]
        fp, fe, fn = map(brute.fingerprint, (text, e, following))
        numbers = lambda f: [h * 2 ** 31 + 2 ** 31 - 1 - j for h, j in f]
        out.append((key, len(text), brute.sha(e), numbers(fp), numbers(fe), brute.likeness(fp, fe), brute.likeness(fp, fn)))
    return out


def test_fingerprints_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = sorted(map(tuple, winnowing.edited_and_next(docs).collect()))
    assert got == edited(rows)


def test_fingerprint_edges(spark):
    rows = [(5, None), (-7, ""), (9, " \t\n"), (2 ** 60, "one"), (11, "é ü 中 文 x y z"), (12, "a " * 30_000), (13, "b b b b b b b b"),
            (14, "one two three four"), (15, "one two three four")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, g int, n_chars int")
    want = edited(sorted((i, t or "") for i, t in rows))
    assert sorted(map(tuple, winnowing.edited_and_next(docs).collect())) == want
    one = winnowing.edited_and_next(docs.where("doc_id = 15")).collect()[0]
    assert one.near_next == 1.0 and one.n_chars == 18
    assert winnowing.edited_and_next(docs.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d e"), (3, "f g h i j"), (3, "f g h i j")], "doc_id long, text string")
    got = winnowing.edited_and_next(nulls).collect()
    assert len(got) == 3 and sorted(r.near_next for r in got) == [0.0, 0.0, 1.0]


def test_any_shared_run_is_found():
    """The guarantee: texts that share K + W - 1 words share a fingerprint."""
    run = [f"s{i}" for i in range(winnowing.K + winnowing.W - 1)]
    for a in range(12):
        x = " ".join([f"x{i}" for i in range(a)] + run + ["p"] * 9)
        y = " ".join(["q"] * 5 + run + [f"y{i}" for i in range(a)])
        assert {h for h, _ in brute.fingerprint(x)} & {h for h, _ in brute.fingerprint(y)}


def by_characters(text, k, w):
    """Brute force: [(hash, position)] of winnowed grams of ``k`` code points, blank runs as one space."""
    chars = " ".join(brute.words(text))
    h = [((brute.xxhash.xxh64_intdigest(c.encode(), 42) + 2 ** 63) % 2 ** 64 - 2 ** 63) % winnowing.PRIME for c in chars]
    grams = []
    for part in [h[i:i + k] for i in range(len(h) - k + 1)] or [h] * bool(h):
        a = 0
        for x in part:
            a = (a * winnowing.BASE + x) % winnowing.PRIME
        grams.append(a)
    return list(dict.fromkeys(min((g, -j) for j, g in enumerate(grams[i:i + w], i)) for i in range(len(grams))))


def test_character_fingerprints_of_unspaced_texts(spark):
    k, w = winnowing.CHARACTER_K, winnowing.CHARACTER_W
    unspaced = "吾輩は猫である名前はまだ無いどこで生れたかとんと見当がつかぬ何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している"
    rows = [(1, unspaced), (2, "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVphYmNkZWZnaGlqa2xtbm9wcXJzdHV2d3h5eg"), (3, "a\t\n b  c \r\n" * 9),
            (4, "𝒳𝒴 😀 z é" * 5), (5, "short"), (6, None), (7, " \t"), (8, "eight ch"), (9, "seven c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = winnowing.edited_and_next(docs, k=k, w=w, units=winnowing.CHARACTERS).orderBy("doc_id").collect()
    texts = [t or "" for _, t in rows]
    for i, (r, text) in enumerate(zip(got, texts)):
        following = texts[(i + 1) % len(texts)]
        q = len(text) // 4
        fp, fe, fn = (by_characters(t, k, w) for t in (text, text[:len(text) - q] + following[:q], following))
        assert r.fingerprint == [h * 2 ** 31 + 2 ** 31 - 1 + j for h, j in fp] and len(r.edited_fingerprint) == len(fe)
        assert (r.near_edited, r.near_next) == (brute.likeness(fp, fe), brute.likeness(fp, fn))
    for n in (3, 5, 6):  # other gram sizes than powers of two
        some = winnowing.with_fingerprint(docs.where("doc_id < 5"), "text", "f", n, w, winnowing.CHARACTERS).orderBy("doc_id").collect()
        assert [r.f for r in some] == [[h * 2 ** 31 + 2 ** 31 - 1 + j for h, j in by_characters(t, n, w)] for t in texts[:4]]


def test_query_sees_what_unspaced_texts_share(spark, tmp_path):
    """With words as units a text without white space is one gram, and any edit of it leaves nothing in common."""
    unspaced = "吾輩は猫である名前はまだ無いどこで生れたかとんと見当がつかぬ何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している"
    spark.createDataFrame([(1, unspaced), (2, "0123456789" * 20)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.near_edited for r in queries.op4_winnowing(spark, str(tmp_path)).collect()}
    assert 0 < got[1] < 1 and got[2] > 0


@pytest.mark.parametrize("k, w", [(8, 8), (3, 1), (1, 4), (5, 3)])
def test_edited_fingerprints_reuse_the_text(spark, k, w):
    """The windows taken over from the text and the computed ones are those of the whole edited text, whatever the blanks at the cut."""
    import random
    rng = random.Random(k * w)
    pick = lambda n: "".join(rng.choice("ab  \t\né中") for _ in range(n))
    rows = [(i, pick(rng.choice([0, 1, 2, 3, 5, 9, 20, 60, 200]))) for i in range(250)] + [(250 + i, " " * i) for i in range(9)] + [
        (300, "x" * 30 + " " * 10), (301, " " * 10 + "y" * 30), (302, "z" * 40), (303, "abc"), (304, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = winnowing.edited_and_next(docs, k=k, w=w, units=winnowing.CHARACTERS).orderBy("doc_id").collect()
    for i, (r, (_, text)) in enumerate(zip(got, rows)):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(text) // 4
        edited_text = text[:len(text) - q] + following[:q]
        numbers = lambda t: [h * 2 ** 31 + 2 ** 31 - 1 + j for h, j in by_characters(t, k, w)]
        assert r.fingerprint == numbers(text) and r.edited_fingerprint == numbers(edited_text) and r.edited_sha256 == brute.sha(edited_text)


@settings(max_examples=12, deadline=None)
@given(st.randoms(use_true_random=False))
def test_a_shared_run_of_characters_has_a_common_fingerprint(spark_rows, rng):
    """The match guarantee, on the operator itself: texts that share k + w - 1 characters share a fingerprint."""
    k, w = winnowing.CHARACTER_K, winnowing.CHARACTER_W
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    run = "q" + make(k + w - 3).replace(" ", "r") + "q"
    rows = [(i, "".join(rng.choice("uvwxyz") for _ in range(rng.randrange(40))) + run + make(rng.randrange(40))) for i in range(20)]
    out = winnowing.with_fingerprint(spark_rows(rows), "text", "f", k, w, winnowing.CHARACTERS).collect()
    sets = [{x >> 31 for x in r.f} for r in out]
    assert all(a & b for a in sets for b in sets)


@pytest.fixture(scope="module")
def spark_rows(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, text string")

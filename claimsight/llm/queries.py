"""The operators as queries over the given tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from typing import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsight.llm import (ann, bpe, html_text, langid, lengths, minmax, mixing, quality, repair, sharding, substring,
                            vector_codes, winnowing)
from claimsight.llm.common import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

RANKS = "byte_bpe_50k.tiktoken"


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


@register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``; learns outside the held-out third."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(fold("doc_id", 3) != 1))
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    return langid.identify(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register
def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page, laid out as a browser would show it."""
    out = html_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return out.withColumn("n_chars", F.length("text"))


@register
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every whole text of ``documents``."""
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                            public_tokenizers.PATTERN, ["doc_id"])
    return out.select("doc_id", "n_tokens",
                      F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every encoded length that occurs in ``documents``, taken as a context limit: documents
    and tokens at most that long, longer documents, truncated totals and the quantile."""
    counts = bpe.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                              public_tokenizers.PATTERN, [])
    return lengths.with_suffix_sums(written(lengths.histogram(counts), "length-histogram"))


@register
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learns from labels outside the held-out fifth."""
    stats = written(quality.with_statistics(table(spark, sf_dir, "documents"), ["doc_id"]), "quality-stats")
    model = quality.fit(labelled_statistics(stats, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return quality.score_statistics(stats, model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"))


def labelled_statistics(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """``stats``, ``label`` and ``fold`` of the rows that may be learned from: crc32 modulo 5 is not 0."""
    return (stats.join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id")
            .where(fold("doc_id", 5) != 0)
            .withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(5)).cast("int")))


@register
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` left after every repeated window of 35 words is removed."""
    out = substring.remove_repeated(table(spark, sf_dir, "documents"), ["doc_id"], 35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op9_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35),
w AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+34], ' ')) AS h FROM s),
r AS (SELECT doc_id, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
t AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM d),
c AS (SELECT t.doc_id, t.j, t.word,
             max(r.i) OVER (PARTITION BY t.doc_id ORDER BY t.j ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
      FROM t LEFT JOIN r ON r.doc_id = t.doc_id AND r.i = t.j),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept
      FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@register
def op8_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``documents``: 3-word shingles, similarity of 0.85 or more."""
    out = minmax.near_duplicates(table(spark, sf_dir, "documents"), 3, 85)
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


ORACLE["op8_minmax_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
        WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS gs FROM d),
e AS (SELECT doc_id, unnest(gs) AS s FROM g),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM e x JOIN e y ON x.s = y.s AND x.doc_id < y.doc_id
      GROUP BY x.doc_id, y.doc_id),
l AS (SELECT a, b FROM p JOIN g ga ON ga.doc_id = a JOIN g gb ON gb.doc_id = b
      WHERE 100 * n_both >= 85 * (len(ga.gs) + len(gb.gs) - n_both)),
sym AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT a, b FROM sym UNION SELECT r.doc_id, sym.b FROM r JOIN sym ON sym.a = r.other),
c AS (SELECT doc_id, min(other) AS low FROM r GROUP BY doc_id)
SELECT g.doc_id, CAST(len(gs) AS BIGINT) AS n_shingles, least(g.doc_id, coalesce(low, g.doc_id)) AS component_id,
       g.doc_id <= coalesce(low, g.doc_id) AS kept
FROM g LEFT JOIN c USING (doc_id)
"""


@register
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products found for every vector whose id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", 20, "vec_id", "embedding")


#: Production mixing: nearly even sources, none repeated more than four times, as many tokens as the corpus has.
MIX = {"target_entropy": 0.95, "max_repeats": 4.0}


@register
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of ``documents`` taken by temperature mixing of their sources (tokens: words)."""
    sized = written(table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("n_tokens")), "sized")
    weights = written(mixing.source_weights(sized, **MIX), "weights")
    blocks = written(mixing.block_order(sized, weights), "blocks")
    return mixing.realise(sized, weights, blocks, ["doc_id", "source", "n_tokens"]).drop("progress")


ORACLE["op6_source_mixing"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
         CAST('0x' || substr(md5('mix:' || doc_id), 1, 15) AS BIGINT) AS ticket FROM documents),
t AS (SELECT source, count(*) AS docs, sum(n_tokens) AS total FROM d GROUP BY source HAVING sum(n_tokens) > 0),
ps AS (SELECT list(total / (SELECT sum(total) FROM t) ORDER BY source) AS p, count(*) AS n FROM t),
bis(k, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT k + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END FROM (
    SELECT k, lo, hi, mid, ln(z) - mid * s / z >= 0.95 * ln(n) AS ok FROM (
      SELECT k, lo, hi, mid, n, list_sum(list_transform(p, lambda x: pow(x, mid))) AS z,
             list_sum(list_transform(p, lambda x: pow(x, mid) * ln(x))) AS s
      FROM (SELECT k, lo, hi, CASE WHEN k = 0 THEN 1.0 ELSE (lo + hi) / 2 END AS mid FROM bis WHERE k < 60), ps))),
a AS (SELECT CASE WHEN (SELECT n FROM ps) < 2 THEN 1.0 ELSE (SELECT lo FROM bis WHERE k = 60) END AS e),
w AS (SELECT source, docs, total, pow(total / (SELECT sum(total) FROM t), e) / (SELECT sum(pow(total / (SELECT sum(total) FROM t), e)) FROM t) AS weight FROM t, a),
b AS (SELECT source, docs, total, CAST(floor(weight * (SELECT sum(total) FROM t)) AS BIGINT) AS budget FROM w),
x AS (SELECT d.*, b.total, b.budget, ticket % CAST(ceil(docs / 4096.0) AS BIGINT) AS block FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
y AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source, block ORDER BY ticket, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside FROM x),
v AS (SELECT source, block, sum(n_tokens) AS size, any_value(total) AS total, any_value(budget) AS budget FROM x GROUP BY source, block),
e AS (SELECT *, unnest(range(0, CAST((budget - 1) // total + 1 AS BIGINT))) AS epoch FROM v WHERE budget > 0),
f AS (SELECT *, epoch * total + coalesce(sum(size) OVER (PARTITION BY source, epoch ORDER BY md5(concat_ws(':', 'mix', epoch, source, block)), block
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e)
SELECT y.doc_id, y.source, y.n_tokens, CAST(f.epoch AS INTEGER) AS epoch, CAST(y.block AS BIGINT) AS block,
       CAST(f.before + y.inside AS BIGINT) AS tokens_before
FROM y JOIN f ON y.source IS NOT DISTINCT FROM f.source AND y.block = f.block WHERE f.before + y.inside < y.budget
"""


@register
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text of ``documents`` and of its edited text, and how alike they are."""
    out = winnowing.edited_and_next(table(spark, sf_dir, "documents"), k=winnowing.CHARACTER_K, w=winnowing.CHARACTER_W,
                                    units=winnowing.CHARACTERS)
    digest = lambda c: F.sha2(F.array_join(c, " "), 256).alias(c)
    return out.select("doc_id", "n_chars", "edited_sha256", digest("fingerprint"), digest("edited_fingerprint"),
                      "near_edited", "near_next")


@register
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight-part codes of every usable vector of ``embeddings`` and their errors, by vector and by label."""
    coded, books = vector_codes.encode(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", ["label"])
    coded = written(coded, "vector-codes")
    totals = written(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    digest = F.lit(None).cast("string")
    for size, book in books.items():
        digest = F.when(F.col("size") == size, book.digest()).otherwise(digest)
    code = F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", code.alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


def _code_rounds() -> str:
    """The rounds of operator 11 as common table expressions ``a0`` .. ``a6`` (nearest entries) and ``b0`` .. ``b6`` (codebooks)."""
    out = []
    for k in range(7):
        if k:
            out.append(f"""b{k} AS MATERIALIZED (
  SELECT o.part, o.entry, coalesce(n.c, o.c) AS c FROM b{k - 1} o LEFT JOIN (
    SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS c FROM (
      SELECT part, entry, pos, sum(v) AS s, count(*) AS n
      FROM (SELECT p.part, a.entry, unnest(p.c) AS v, unnest(range(len(p.c))) AS pos FROM p JOIN a{k - 1} a USING (vec_id, part))
      GROUP BY part, entry, pos) GROUP BY part, entry) n ON n.part = o.part AND n.entry = o.entry)""")
        out.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, part, near[2] AS entry, near[1] AS error FROM (
    SELECT p.vec_id, p.part, min([CAST(list_sum(list_transform(list_zip(p.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), b.entry]) AS near
    FROM p JOIN b{k} b USING (part) GROUP BY p.vec_id, p.part))""")
    return ",\n".join(out)


ORACLE["op11_vector_codes"] = f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
p AS MATERIALIZED (SELECT vec_id, m AS part, c[m * len(c) // 8 + 1 : (m + 1) * len(c) // 8] AS c FROM v, range(8) t(m)),
b0 AS MATERIALIZED (SELECT part, k - 1 AS entry, c FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS k FROM p) WHERE k <= 16),
{_code_rounds()},
e AS (SELECT vec_id, lower(string_agg(lpad(hex(CAST(entry AS BIGINT)), 2, '0'), '' ORDER BY part)) AS code, CAST(sum(error) AS BIGINT) AS error
      FROM a6 GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b6),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM e JOIN v USING (vec_id) GROUP BY label)
SELECT e.vec_id, e.code, e.error, l.label_error, h.codebooks_sha256
FROM e JOIN v USING (vec_id) JOIN l ON l.label IS NOT DISTINCT FROM v.label CROSS JOIN h
"""


def _crc32_sql(text: str) -> str:
    """CRC-32 (reflected polynomial 0xEDB88320) of the UTF-8 bytes of a SQL expression, four bits at a time."""
    steps = []
    for v in range(16):
        for _ in range(4):
            v = v >> 1 ^ (0xEDB88320 if v & 1 else 0)
        steps.append(v)
    digit = "CAST(instr('0123456789ABCDEF', substr(h, {}, 1)) - 1 AS BIGINT)"
    halves = f"flatten(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: [{digit.format(2)}, {digit.format(1)}]))"
    return f"xor(4294967295, list_reduce({halves}, lambda c, v: xor(({steps})[(xor(c, v) & 15) + 1], c >> 4), 4294967295))"


@register
def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contiguous shards 0 to 39 of ``documents`` in the order of their ids, near equal in bytes."""
    out = sharding.shards(table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


ORACLE["op12_shards"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, CAST(strlen(t) + 16 AS BIGINT) AS size, CAST({_crc32_sql("t")} AS BIGINT) AS text_crc32 FROM d),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id, size, text_crc32) - size AS before, sum(size) OVER () AS total,
             row_number() OVER (ORDER BY doc_id, size, text_crc32) AS place FROM s),
x AS (SELECT *, CAST(40 * (2 * before + size) // (2 * total) AS INTEGER) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM x
"""


@register
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, least cost, edits and digest of the repaired rows of every damaged conversation."""
    rows = repair.damage(table(spark, sf_dir, "conversations"))
    return repair.repair(rows, present=F.col("present")).drop("repaired")


def _longer(way: str, cost: str, edit: str) -> str:
    """A way (nine digits of cost, then its edits) with an edit before it."""
    return f"lpad(CAST(CAST(left({way}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || '{edit}' || substr({way}, 10)"


def _row_ways() -> str:
    """Least way from each state before a row, without inserts: ``n0`` .. ``n3`` from ``v0`` .. ``v3`` after it."""
    kept = [f"CASE first WHEN 's' THEN {_longer('v1', 'more', 'K')} WHEN 'u' THEN {_longer('v2', 'more', 'K')} END",
            f"CASE first WHEN 'u' THEN {_longer('v2', 'more', 'K')} END", f"CASE first WHEN 'a' THEN {_longer('v3', 'more', 'K')} END",
            f"CASE first WHEN 'u' THEN {_longer('v2', 'more', 'K')} END"]
    return ", ".join(f"least({_longer(f'v{s}', '4', 'D')}, CASE WHEN fault NOT IN ('b', 'd') THEN least({_longer(f'v{(2, 2, 3, 2)[s]}', '3 + more', 'R')}, "
                     f"coalesce({kept[s]}, 'x')) ELSE 'x' END) AS n{s}" for s in range(4))


def _insert_ways() -> str:
    to = (2, 2, 3, 2)
    one = lambda s: _longer(f"n{to[s]}", "3", "I")
    two = lambda s: _longer(f"n{to[to[s]]}", "6", "II")
    return ", ".join(f"least(n{s}, {one(s)}, {two(s)}) AS v{s}" for s in range(4))


ORACLE["op13_conversation_repair"] = rf"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
c AS (SELECT *, {_crc32_sql("k")} % 20 AS kind FROM d),
x AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, left(role, 1) AS first,
             regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail FROM x),
a AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
             lag(first) OVER (PARTITION BY conv_id ORDER BY i) || first AS pair FROM o),
f AS (SELECT *, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS more FROM (
        SELECT *, CASE WHEN tail = '' THEN 'b' WHEN again THEN 'd' WHEN tail NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault FROM a)),
g AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
             count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
w(conv_id, i, v0, v1, v2, v3) AS (
  SELECT conv_id, n + 1, '000000000', '000000006II', '000000003I', '000000000' FROM g
  UNION ALL
  SELECT conv_id, i, {_insert_ways()} FROM (
    SELECT f.conv_id, f.i, {_row_ways()} FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i - 1)),
r AS (SELECT conv_id, CAST(left(v0, 9) AS BIGINT) AS cost, substr(v0, 10) AS audit FROM w WHERE i = 1),
e AS (SELECT conv_id, unnest(string_split(audit, '')) AS edit, unnest(range(1, length(audit) + 1)) AS p FROM r WHERE audit <> ''),
q AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i,
             count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS out FROM e),
s AS (SELECT q.*, f.role, f.text,
             max(CASE WHEN out = 1 AND edit = 'K' AND first = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY q.conv_id) AS system
      FROM q LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM q.conv_id AND f.i = q.i AND q.edit <> 'I'),
l AS (SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role ELSE CASE (out - system) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END
                                 || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS kept
      FROM s WHERE edit <> 'D' GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(kept, '')) AS repaired_sha256
FROM every LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM every.conv_id LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN l ON l.conv_id IS NOT DISTINCT FROM every.conv_id
"""

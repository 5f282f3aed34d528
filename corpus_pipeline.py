"""A training corpus from raw documents: quality filter, near-duplicate removal, removal of repeated
passages, source mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet in
the shared checkpoint folder and reads again as the next stage's ``docs``.  All stages but the last
return the columns of ``docs``; extra columns, whatever their names, stay as they are.  Stages
accept null and empty texts, null ids and sources, repeated rows and empty tables:

* quality: null and blank texts are scored like any other; without labels nothing is rejected;
* near-duplicates: texts without words and rows without an id always stay, and different texts under one id are compared like any others;
* substring: only the text and ``n_chars`` of documents with repeated windows change;
* mixing: a null source is a source; a source without words is left out; a source below its target repeats whole documents;
* tokens: null text has no tokens.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsight.llm import bpe, minmax, mixing, quality, substring
from claimsight.llm.common import table, written
from claimsight.llm.queries import MIX, RANKS, labelled_statistics
from claimsight.session import shared_path

#: A document stays from this score on.
LEAST_SCORE = 0.3
#: Words per shingle and per cent of similarity of near duplicates.
SHINGLE, SIMILAR = 5, 80
#: Words of a repeated window.
WINDOW = 35


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least ``LEAST_SCORE``."""
    stats = written(quality.with_statistics(docs, ["doc_id"]), "quality-stats")
    model = quality.fit(labelled_statistics(stats, table(spark, sf_dir, "labels")))
    return quality.score_texts(docs, model, score="__score").where(F.col("__score") >= LEAST_SCORE).drop("__score")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates.

    Different texts under one id are documents of their own, after those whose id is unique; of rows with the same id and
    text the one with the least hash of all its columns stays.
    """
    again = written(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if again.isEmpty():
        found = written(minmax.near_duplicates(docs, SHINGLE, SIMILAR), "groups")
        # Written first: Spark then knows its size, and moves no texts to it if it is small.
        gone = written(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    own = docs.toDF(*[f"__c{i}" for i in range(len(docs.columns))])
    of = {c: F.col(f"__c{i}") for i, c in enumerate(docs.columns)}
    own = own.join(again.select(F.col("doc_id").alias("__again")), of["doc_id"] == F.col("__again"), "left")
    # Ids from 2**62 on stand for the texts under repeated ids.
    key = F.xxhash64(of["doc_id"], F.md5(F.coalesce(of["text"], F.lit("")).cast("binary"))).bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    own = written(own.withColumn("__node", F.when(F.col("__again").isNotNull(), key).otherwise(of["doc_id"])), "nodes")
    found = written(minmax.near_duplicates(own.select("__node", of["text"].alias("text")), SHINGLE, SIMILAR, id="__node"), "groups")
    gone = written(found.where("__node <> component_id").select("__node").distinct(), "gone")
    kept = own.join(gone, "__node", "left_anti")
    every = F.struct(*[of[c].alias(c) for c in docs.columns])
    once = kept.where("__again is not null").groupBy("__node").agg(F.min_by(every, F.xxhash64(*of.values())).alias("row"))
    return kept.where("__again is null").select(every.alias("row")).union(once.select("row")).select("row.*")


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of any repeated window of ``WINDOW`` words."""
    names = docs.columns
    own = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    of = {c: f"__c{i}" for i, c in enumerate(names)}
    out = substring.remove_repeated(own, [of[c] for c in names if c != "text"], WINDOW, text=of["text"], rejoin=False)
    chars = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col(of["n_chars"])).cast(docs.schema["n_chars"].dataType)
    return out.select(*[(F.col("kept_text") if c == "text" else chars if c == "n_chars" else F.col(of[c])).alias(c) for c in names])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the target mixture."""
    sized = written(docs.select("doc_id", "source", mixing.word_count("text").alias("n_tokens")), "sized")
    weights = written(mixing.source_weights(sized, **MIX), "weights")
    blocks = written(mixing.block_order(sized, weights), "blocks")
    return mixing.realise(docs.withColumn("__words", mixing.word_count("text")), weights, blocks, docs.columns,
                          tokens="__words", schedule=False)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of the bytes that they decode to."""
    out = bpe.encode_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ["doc_id", "source"])
    return out.select("doc_id", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", good_documents),
    ("near duplicates", one_of_each_group),
    ("substring", without_repeated_passages),
    ("mixing", mixed_sources),
    ("tokens", tokens),
]

#: The classifier and the byte merges can't be put in SQL; ``tests/llm`` holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    base = shared_path(spark, f"llm/pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{base}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

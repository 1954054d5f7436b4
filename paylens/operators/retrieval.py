"""Keyword retrieval from a stored index, with the answers of a scan over all texts.

A question's word counts if a text contains it, also inside a longer word. A text's
tokens are its parts between blanks, in lower case: a word without blanks is in the text
exactly if it is in one of its tokens. The index stores a dictionary of tokens with their
document frequencies and, in folders by token hash, the documents of each token. A
question looks its words up in the dictionary and opens the folders of the tokens found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.text import search_words

#: Folders of postings.
PARTS = 64
_BLANK = r"\s+"


def _part(parts: int):
    return F.pmod(F.xxhash64("token"), F.lit(parts)).cast("int")


def build_index(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", parts: int = PARTS) -> None:
    """Write ``postings`` by part and the ``dictionary`` below ``path``; null texts have no tokens."""
    tokens = docs.select(F.col(key).alias("doc"), F.explode(F.array_distinct(F.split(F.lower(F.col(text)), _BLANK))).alias("token")).where("token <> ''")
    tokens.withColumn("part", _part(parts)).hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(f"{path}/postings")
    stored = docs.sparkSession.read.parquet(f"{path}/postings")
    stored.groupBy("token").agg(F.count(F.lit(1)).alias("documents")).withColumn("part", _part(parts)).write.mode("overwrite").parquet(f"{path}/dictionary")


def matching_tokens(spark: SparkSession, path: str, words: list[str]) -> DataFrame:
    """``token, documents, part, word``: dictionary entries that contain a word."""
    hits = F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.col("token"), w))
    return spark.read.parquet(f"{path}/dictionary").select("token", "documents", "part", F.explode(hits).alias("word"))


def hit_postings(spark: SparkSession, path: str, words: list[str]) -> DataFrame:
    """``doc, word``: which documents hold which words; only folders of matching tokens are opened.

    At most as many folder numbers reach the driver as there are folders.
    """
    found = matching_tokens(spark, path, words)
    parts = sorted(r["part"] for r in found.select("part").distinct().collect())
    postings = spark.read.parquet(f"{path}/postings").where(F.col("part").isin(parts))
    return postings.join(found.select("token", "word"), "token").select("doc", "word").distinct()


def retrieve(spark: SparkSession, path: str, docs: DataFrame, query: str, k: int, text: str = "text", key: str = "doc_id", snippet: int = 300) -> DataFrame:
    """The ``k`` documents that hold most of the query's longer words, with the start of their text."""
    words = sorted(set(search_words(query)))
    weights = {w: search_words(query).count(w) for w in words}
    weight = F.create_map(*[x for w, n in weights.items() for x in (F.lit(w), F.lit(n))])
    scored = hit_postings(spark, path, words).groupBy("doc").agg(F.sum(weight[F.col("word")]).cast("int").alias("score"))
    best = scored.orderBy(F.desc("score"), "doc").limit(k)
    excerpt = F.replace(F.substring(F.col(text), 1, snippet), F.lit("\n"), F.lit(" "))
    shown = docs.join(F.broadcast(best), docs[key] == best["doc"])
    return shown.select(key, "score", excerpt.alias("snippet")).orderBy(F.desc("score"), key).limit(k)

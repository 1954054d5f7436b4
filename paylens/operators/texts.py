"""Text operators: retrieval, labelling, sentiment, answer extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.text import keyword_score, occurrences, search_words

# Words of praise and blame.
POSITIVE = ["perfectly", "smoothly", "happy", "good", "great", "success", "resolved"]
NEGATIVE = ["failed", "frustrating", "terrible", "missing", "errors", "broken", "breach"]


def retrieve(docs: DataFrame, query: str, k: int, text: str = "text", key: str = "doc_id", snippet: int = 300) -> DataFrame:
    """The ``k`` documents that hold most of the query's longer words.

    Whole texts are scored; only the shown excerpt is short.
    """
    words = search_words(query)
    scored = docs.withColumn("score", keyword_score(F.col(text), words)).where("score > 0")
    excerpt = F.replace(F.substring(F.col(text), 1, snippet), F.lit("\n"), F.lit(" "))
    return scored.select(key, "score", excerpt.alias("snippet")).orderBy(F.desc("score"), key).limit(k)


def padded(text: Column) -> Column:
    """Lower-case words between single blanks, for whole-word counting."""
    flat = F.lower(text)
    for mark in (".", ",", "!", "?", "\n"):
        flat = F.replace(flat, F.lit(mark), F.lit(" "))
    return F.concat(F.lit(" "), F.replace(flat, F.lit(" "), F.lit("  ")), F.lit(" "))


def word_hits(text: Column, words: Sequence[str]) -> Column:
    hits = F.lit(0)
    for word in words:
        hits = hits + occurrences(text, f" {word} ")
    return hits


def classify(df: DataFrame, labels: dict[str, Sequence[str]], text: str, out: str = "label") -> DataFrame:
    """Give each row the label whose words occur most often; ties go to the first label."""
    flat = df.withColumn("_padded", padded(F.col(text)))
    scores = {name: f"_s{i}" for i, name in enumerate(labels)}
    flat = flat.withColumns({scores[name]: word_hits(F.col("_padded"), words) for name, words in labels.items()})
    top = F.greatest(*[F.col(c) for c in scores.values()])
    label = F.when(top == 0, F.lit(None))
    for name, column in scores.items():
        label = label.when(F.col(column) == top, F.lit(name))
    return flat.withColumn(out, label).drop("_padded", *scores.values())


def sentiment(text: Column) -> Column:
    """Score in [-1, 1] from words of praise and blame; 0 without any."""
    flat = padded(text)
    good, bad = word_hits(flat, POSITIVE), word_hits(flat, NEGATIVE)
    return F.coalesce((good - bad) / F.nullif((good + bad).cast("double"), F.lit(0.0)), F.lit(0.0))


def best_sentence(text: Column, query: str) -> Column:
    """The sentence with most of the query's words, the first of equals."""
    words = search_words(query, 2)
    sentences = F.split(text, r"\.")

    def rate(sentence: Column, index: Column) -> Column:
        return F.struct(keyword_score(sentence, words).alias("score"), (-index).alias("place"), F.trim(sentence).alias("sentence"))

    return F.array_max(F.transform(sentences, rate))


def last_good_fix(log: DataFrame, fingerprint: str, order: str, fix: str) -> DataFrame:
    """Per fingerprint: attempts, successes and the newest fix that worked."""
    worked = F.when(F.col("success"), F.struct(F.col(order), F.col(fix)))
    return log.groupBy(fingerprint).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count(F.when(F.col("success"), 1)).alias("successes"),
        F.max(worked).getField(fix).alias("last_good_fix"),
    )

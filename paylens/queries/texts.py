"""Text operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from paylens.functions.text import error_fingerprint
from paylens.operators import retrieval, texts
from paylens.operators.aggregates import row_count
from paylens.queries import data
from paylens.queries.registry import query
from paylens.session import scratch_path
from paylens.queries.sqlbase import with_views

SEARCH = "thand eration und tionau queaux lettre wherthe"
WORDS = [w.lower() for w in SEARCH.split() if len(w) >= 5]
SCORE = " + ".join(f"CASE WHEN contains(lower(text), '{w}') THEN 1 ELSE 0 END" for w in WORDS)


@query(
    "p08_keyword_retrieval",
    f"""SELECT doc_id, score, replace(substr(text, 1, 300), chr(10), ' ') AS snippet FROM (SELECT *, {SCORE} AS score FROM documents)
        WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 3""",
)
def p08(spark, sf):
    return texts.retrieve(data.table(spark, sf, "documents"), SEARCH, 3)


@query(
    "p08b_indexed_retrieval",
    f"""SELECT doc_id, score, replace(substr(text, 1, 300), chr(10), ' ') AS snippet FROM (SELECT *, {SCORE} AS score FROM documents)
        WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 3""",
)
def p08b(spark, sf):
    """The same answer from a stored index: the dictionary, and the folders of the tokens found."""
    path, docs = scratch_path(spark, "index"), data.table(spark, sf, "documents")
    retrieval.build_index(docs, path)
    return retrieval.retrieve(spark, path, docs, SEARCH, 3)


@query(
    "p08c_document_frequencies",
    r"""SELECT token, COUNT(DISTINCT doc_id) AS documents FROM (SELECT doc_id, UNNEST(regexp_split_to_array(lower(text), '[ 	-]+')) AS token FROM documents)
        WHERE contains(token, 'queaux') GROUP BY 1""",
)
def p08c(spark, sf):
    """What a question looks up first: tokens that hold a word, with the number of their documents."""
    path = scratch_path(spark, "index")
    retrieval.build_index(data.table(spark, sf, "documents"), path)
    return retrieval.matching_tokens(spark, path, ["queaux"]).select("token", "documents")


# Fixed values: common short words by language.
LANGUAGE_WORDS = {
    "en": ["the", "of", "and", "in", "that", "with"],
    "de": ["der", "die", "und", "das", "von", "ist"],
    "es": ["que", "los", "el", "por", "una", "con"],
    "fr": ["les", "le", "des", "et", "un", "est"],
}


def padded_sql(text):
    flat = f"lower({text})"
    for mark in ("'.'", "','", "'!'", "'?'", "chr(10)"):
        flat = f"replace({flat}, {mark}, ' ')"
    return f"(' ' || replace({flat}, ' ', '  ') || ' ')"


def hits_sql(words, column="pad"):
    return " + ".join(f"((length({column}) - length(replace({column}, ' {w} ', ''))) // {len(w) + 2})" for w in words)


HITS = ", ".join(f"{hits_sql(words)} AS s_{name}" for name, words in LANGUAGE_WORDS.items())
LABEL = (
    "CASE WHEN GREATEST(s_en, s_de, s_es, s_fr) = 0 THEN NULL "
    + " ".join(f"WHEN s_{n} = GREATEST(s_en, s_de, s_es, s_fr) THEN '{n}'" for n in LANGUAGE_WORDS)
    + " END"
)


@query(
    "p09_classify_rows",
    f"SELECT lang, {LABEL} AS label, COUNT(*) AS docs FROM (SELECT lang, {HITS} FROM (SELECT lang, {padded_sql('text')} AS pad FROM documents)) GROUP BY 1, 2",
)
def p09(spark, sf):
    labelled = texts.classify(data.table(spark, sf, "documents").select("lang", "text"), LANGUAGE_WORDS, "text")
    return labelled.groupBy("lang", "label").agg(row_count().alias("docs"))


FEEDBACK = """CASE status WHEN 'COMPLETED' THEN 'Transaction processed smoothly, very happy!' WHEN 'FAILED' THEN 'Payment failed again, very frustrating experience'
   ELSE 'Transaction is still pending, waiting for update' END"""
GOOD, BAD = hits_sql(texts.POSITIVE), hits_sql(texts.NEGATIVE)


@query(
    "p10_sentiment",
    with_views(
        "txn",
        f"""SELECT status, payment_method, COUNT(*) AS rows, AVG(COALESCE(CAST(good - bad AS DOUBLE) / NULLIF(good + bad, 0), 0)) AS score FROM
            (SELECT status, payment_method, {GOOD} AS good, {BAD} AS bad FROM (SELECT status, payment_method, {padded_sql(FEEDBACK)} AS pad FROM txn)) GROUP BY 1, 2""",
    ),
)
def p10(spark, sf):
    status = F.col("status")
    feedback = (
        F.when(status == "COMPLETED", "Transaction processed smoothly, very happy!")
        .when(status == "FAILED", "Payment failed again, very frustrating experience")
        .otherwise("Transaction is still pending, waiting for update")
    )
    rows = data.transactions(spark, sf).select("status", "payment_method", texts.sentiment(feedback).alias("score"))
    return rows.groupBy("status", "payment_method").agg(row_count().alias("rows"), F.avg("score").alias("score"))


@query(
    "p10b_sentiment_of_turns",
    f"""SELECT role, COUNT(*) AS turns, COUNT(CASE WHEN good + bad > 0 THEN 1 END) AS with_opinion, AVG(COALESCE(CAST(good - bad AS DOUBLE) / NULLIF(good + bad, 0), 0)) AS score FROM
        (SELECT role, {GOOD} AS good, {BAD} AS bad FROM (SELECT role, {padded_sql('text')} AS pad FROM conversations)) GROUP BY 1""",
)
def p10b(spark, sf):
    """Sentiment of what people wrote: every turn of every conversation."""
    turns = data.table(spark, sf, "conversations")
    words = texts.padded(F.col("text"))
    opinion = texts.word_hits(words, texts.POSITIVE) + texts.word_hits(words, texts.NEGATIVE)
    scored = turns.select("role", texts.sentiment(F.col("text")).alias("score"), (opinion > 0).alias("says"))
    return scored.groupBy("role").agg(row_count().alias("turns"), F.count_if("says").alias("with_opinion"), F.avg("score").alias("score"))


@query(
    "p10c_sentiment_of_documents",
    f"""SELECT lang, COUNT(*) AS docs, CAST(SUM(good) AS BIGINT) AS praise, CAST(SUM(bad) AS BIGINT) AS blame FROM
        (SELECT lang, {hits_sql(['only', 'the', 'und', 'les'])} AS good, {hits_sql(['was', 'der', 'des'])} AS bad FROM (SELECT lang, {padded_sql('text')} AS pad FROM documents)) GROUP BY 1""",
)
def p10c(spark, sf):
    """The same count with word lists of the caller's, over whole documents."""
    words = texts.padded(F.col("text"))
    counted = data.table(spark, sf, "documents").select(
        "lang", texts.word_hits(words, ["only", "the", "und", "les"]).alias("good"), texts.word_hits(words, ["was", "der", "des"]).alias("bad")
    )
    return counted.groupBy("lang").agg(row_count().alias("docs"), F.sum("good").cast("long").alias("praise"), F.sum("bad").cast("long").alias("blame"))


QUESTION = "which thand ther eration und queaux lettre"
QUESTION_WORDS = [w for w in QUESTION.lower().split() if len(w) >= 2]
SENTENCE_SCORE = " + ".join(f"CASE WHEN contains(lower(x), '{w}') THEN 1 ELSE 0 END" for w in QUESTION_WORDS)


@query(
    "p11_best_sentence",
    f"""SELECT doc_id, score, sentence FROM (SELECT doc_id, {SENTENCE_SCORE} AS score, trim(x) AS sentence, ROW_NUMBER() OVER (PARTITION BY doc_id
        ORDER BY {SENTENCE_SCORE} DESC, i) AS rn FROM (SELECT doc_id, UNNEST(string_split(text, '.')) AS x,
        generate_subscripts(string_split(text, '.'), 1) AS i FROM documents)) WHERE rn = 1""",
)
def p11(spark, sf):
    best = texts.best_sentence(F.col("text"), QUESTION)
    found = data.table(spark, sf, "documents").select("doc_id", best.alias("b"))
    return found.select("doc_id", "b.score", "b.sentence")


TRACE = """'Traceback (most recent call last):' || chr(10) || '  File "job.py", line ' || event_id || chr(10) || '    load(part_' || (user_id % 5) || ')' || chr(10)
   || '    ^^^^' || chr(10) || 'KeyError: ' || event_type"""


def error_log(spark, sf):
    """One traceback per event; its fix worked where the value is large."""
    text = F.concat(
        F.lit('Traceback (most recent call last):\n  File "job.py", line '), F.col("event_id").cast("string"),
        F.lit("\n    load(part_"), (F.col("user_id") % 5).cast("string"), F.lit(")\n    ^^^^\nKeyError: "), F.col("event_type"),
    )
    return data.table(spark, sf, "events").select(
        "event_id", text.alias("log"), (F.col("value") > 50).alias("success"), F.concat(F.lit("patch-"), F.col("event_id").cast("string")).alias("fix")
    )


@query(
    "p12_error_fingerprints",
    """SELECT print, COUNT(*) AS attempts, COUNT(CASE WHEN value > 50 THEN 1 END) AS successes,
       'patch-' || MAX(CASE WHEN value > 50 THEN event_id END) AS last_good_fix FROM (SELECT event_id, value,
       substr(md5('KeyError: ' || event_type || ' | load(part_' || (user_id % 5) || ')'), 1, 12) AS print FROM events) GROUP BY 1""",
)
def p12(spark, sf):
    log = error_log(spark, sf).withColumn("print", error_fingerprint(F.col("log")))
    return texts.last_good_fix(log, "print", "event_id", "fix")


@query(
    "p13_latest_history",
    "SELECT conv_id, turn, role, length(text) AS n FROM conversations WHERE role = 'user' ORDER BY conv_id DESC, turn DESC LIMIT 3",
)
def p13(spark, sf):
    asked = data.table(spark, sf, "conversations").where("role = 'user'")
    latest = asked.orderBy(F.desc("conv_id"), F.desc("turn")).limit(3)
    return latest.select("conv_id", "turn", "role", F.length("text").cast("long").alias("n"))

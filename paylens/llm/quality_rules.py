"""Quality rules whose cutoffs carry a guarantee.

Fixed rules (``base_failed``) come first. Each further rule is a ratio per document with
a list of possible cutoffs. On labelled good documents, per stratum, the documents that a
cutoff would reject are counted; a cutoff is certified if an exact binomial test says
that it rejects more than its share of the good ones with probability below
``delta / tests``, where ``tests`` counts every stratum, rule and cutoff (Bonferroni).
The strictest certified cutoff of each rule and stratum is used, and none where the
labels prove nothing. The shares of a stratum's rules sum to ``alpha``, so with
probability 1 - delta no stratum loses more than ``alpha`` of its good documents to them.

That proof asks for thousands of labels. ``joint_cutoffs`` uses it where there are enough
for any certificate (their number alone decides), and asks for hundreds elsewhere: there
the rules are tightened in turns, and what they reject together is tested against
``alpha`` at the level ``delta / strata`` at every step; the
first step that is not certified ends the sequence, so no step pays for another. Good
documents that the fixed rules reject are left out of it, as no cutoff can keep them.
Strata with too few labels for any certificate are tested together. Their certificate
holds for all of them taken together, not for each, so a step is only used in one of them
if it rejects at most ``alpha`` of its own labels.

All of it is DataFrame expressions: the counts stay in the row, no document is exploded,
and the only shuffles move counts. Windows of words are compared by 64-bit hashes.

Null text has no words. A null stratum is a stratum of its own. A label is good if all
labels of its document say 1; null labels and labels without a document are left out;
repeated rows of a labelled document count once. Without labels nothing but the fixed
rules rejects. Repeated documents are judged one by one. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.common import BLANK
from paylens.session import written

#: Words of a window that may repeat.
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """Rejects where ``top / bottom`` is above a cutoff, or below it for ``low``; strictest cutoff first."""

    name: str
    top: str
    bottom: str
    cutoffs: tuple[float, ...]
    low: bool = False

    def rejects(self, counts: Column, cutoff: Column) -> Column:
        share, limit = counts[self.top], cutoff * counts[self.bottom]
        return (counts[self.bottom] > 0) & ((share < limit) if self.low else (share > limit))


RULES = (
    Rule("symbols", "n_symbols", "n_words", (0.05, 0.1, 0.2, 0.3, 0.5, 1.0)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", (0.05, 0.1, 0.2, 0.3, 0.5)),
    Rule("repeated_words", "n_repeat_words", "n_words", (0.02, 0.05, 0.1, 0.2)),
    Rule("short_words", "word_chars", "n_words", (4.5, 4.0, 3.5, 3.0, 2.5, 2.0), low=True),
    Rule("long_words", "word_chars", "n_words", (8.0, 9.0, 10.0, 12.0, 15.0)),
)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def _repeated(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, from the windows' hashes in order."""
    n = F.size(hashes)
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    before, after = F.concat(none, F.slice(ordered, 1, n - 1)), F.concat(F.slice(ordered, 2, n - 1), none)
    beside = F.zip_with(before, after, lambda a, b: F.struct(a["h"].alias("a"), b["h"].alias("b")))
    place = F.zip_with(ordered, beside, lambda x, y: F.when(x["h"].eqNullSafe(y["a"]) | x["h"].eqNullSafe(y["b"]), x["i"]))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    return F.aggregate(
        F.sort_array(F.array_compact(place)), start,
        lambda acc, p: F.struct((acc["total"] + p + WINDOW - F.greatest(p, acc["end"])).alias("total"), (p + WINDOW).alias("end")),
        lambda acc: acc["total"],
    )


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once for each row, wherever it is used.

    Filters and lambdas would otherwise repeat its expression in place of the name.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def rule_counts(docs: DataFrame, text_col: str = "text", into: str = "counts") -> DataFrame:
    """``docs`` with a struct of counts for each document's text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    step1 = _once(docs, into, F.struct(text.alias("text"), _words(text).alias("words")))
    words = F.col(into)["words"]
    windows = F.when(F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    )
    step2 = _once(step1, into, F.struct(F.col(into)["text"].alias("text"), words.alias("words"), windows.alias("windows")))
    text, windows = F.col(into)["text"], F.col(into)["windows"]
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "")
    n_words = F.size(words).cast("long")
    n_repeat = F.when(F.size(F.array_distinct(windows)) < F.size(windows), _repeated(windows)).otherwise(0).cast("long")
    return _once(
        step2, into,
        F.struct(
            n_words.alias("n_words"), F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"), n_repeat.alias("n_repeat_words"),
        ),
    )


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])


def _tail(n: Column, k: Column, share: float) -> Column:
    """P(X <= k) for X binomial (n, share), summed in logarithms; only asked for k <= n * share."""
    odds = F.log(F.lit(share / (1 - share)))
    first = n * F.log(F.lit(1 - share))
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))

    def add(acc, i):
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        top = F.greatest(term, acc["sum"])
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(-F.abs(term - acc["sum"])))).alias("sum"))

    return F.exp(F.aggregate(steps, F.struct(first.alias("term"), first.alias("sum")), add, lambda acc: acc["sum"]))


def certified_cutoffs(good: DataFrame, rules=RULES, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``stratum, cutoffs``: per stratum a struct with the cutoff of each rule, or null.

    ``good`` has one row (stratum, counts) for each labelled good document.
    """
    share = alpha / len(rules)
    tests = sum(len(r.cutoffs) for r in rules)
    rejected = [
        F.sum(rule.rejects(F.col("counts"), F.lit(c)).cast("long")).alias(f"{rule.name}_{i}")
        for rule in rules for i, c in enumerate(rule.cutoffs)
    ]
    # One row for each stratum from here on.
    found = good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *rejected)
    found = found.withColumn("level", F.lit(delta) / (F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))) * tests))

    def strictest(rule: Rule) -> Column:
        passed = []
        for i, c in enumerate(rule.cutoffs):
            k = F.col(f"{rule.name}_{i}")
            tail = F.when(k <= F.col("n") * share, _tail(F.col("n"), k, share)).otherwise(1.0)
            passed.append(F.when(tail <= F.col("level"), F.lit(float(c))))
        return F.coalesce(*passed)

    return found.select("stratum", F.struct(*[strictest(r).alias(r.name) for r in rules]).alias("cutoffs"))


def steps_of(rules=RULES) -> list[dict]:
    """Cutoffs by rule name, laxest first: each step brings in or tightens one rule, the rules taking turns."""
    steps, now = [], dict.fromkeys(r.name for r in rules)
    for i in range(max(len(r.cutoffs) for r in rules)):
        for r in rules:
            if i < len(r.cutoffs):
                now = now | {r.name: float(r.cutoffs[-1 - i])}
                steps.append(now)
    return steps


def joint_cutoffs(good: DataFrame, rules=RULES, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``stratum, cutoffs`` like ``certified_cutoffs``; from one sequence of steps for all rules where that has too few labels."""
    steps = steps_of(rules)
    reached = ~base_failed(F.col("counts"))
    rejected = []
    for i, step in enumerate(steps):
        any_rule = F.lit(False)
        for r in rules:
            if step[r.name] is not None:
                any_rule = any_rule | r.rejects(F.col("counts"), F.lit(step[r.name]))
        rejected.append(F.sum((any_rule & reached).cast("long")).alias(f"k{i}"))
    # One row for each stratum from here on.
    found = good.groupBy("stratum").agg(F.sum(reached.cast("long")).alias("n"), F.count(F.lit(1)).alias("labels"), *rejected)
    found = found.withColumn("level", F.lit(delta) / F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))
    # Enough for a cutoff of a single rule.
    many = F.pow(F.lit(1 - alpha / len(rules)), F.col("labels")) <= F.col("level") / sum(len(r.cutoffs) for r in rules)
    # Too few to certify anything, even if nothing is rejected.
    found = found.withColumn("small", F.pow(F.lit(1 - alpha), F.col("n")) > F.col("level"))
    group = Window.partitionBy("small", F.when(~F.col("small"), F.struct("stratum")))
    sums = [F.sum(f"k{i}").over(group).alias(f"all_k{i}") for i in range(len(steps))]
    tested = found.select("*", F.sum("n").over(group).alias("all_n"), *sums)
    # A step rejects whatever the steps before it reject, so the steps that pass come first.
    ks = F.array(*[F.struct(F.col(f"k{i}").alias("own"), F.col(f"all_k{i}").alias("all")) for i in range(len(steps))])

    def passes(k: Column) -> Column:
        n = F.col("all_n")
        proved = F.when(k["all"] <= n * alpha, _tail(n, k["all"], alpha)).otherwise(1.0) <= F.col("level")
        return proved & (~F.col("small") | (k["own"] <= F.col("n") * alpha))

    last = tested.where(~many).select("stratum", F.size(F.filter(ks, passes)).alias("last"))
    limits = [F.get(F.array(*[F.lit(s[r.name]).cast("double") for s in steps]), F.col("last") - 1).alias(r.name) for r in rules]
    joint = last.select(F.col("stratum").alias("of_stratum"), F.struct(*limits).alias("joint"))
    both = certified_cutoffs(good, rules, alpha, delta).join(joint, F.col("stratum").eqNullSafe(F.col("of_stratum")), "left")
    return both.select("stratum", F.coalesce("joint", "cutoffs").alias("cutoffs"))


def good_documents(counted: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``stratum, counts`` of the documents that are labelled good."""
    own = labels.where(F.col("quality").isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(F.min("quality").alias("quality"))
    own = own.where(F.col("quality") == 1).select("label_id")
    once = counted.groupBy("doc_id").agg(F.min(F.struct("stratum", "counts")).alias("row"))
    return once.join(own, F.col("doc_id") == F.col("label_id")).select("row.stratum", "row.counts")


def verdicts(counted: DataFrame, cutoffs: DataFrame, rules=RULES) -> DataFrame:
    """``counted`` (stratum, counts and other columns) with ``base_failed`` and ``kept``."""
    named = cutoffs.select(F.col("stratum").alias("of_stratum"), "cutoffs")
    joined = counted.join(named, F.col("stratum").eqNullSafe(F.col("of_stratum")), "left")
    counts = F.col("counts")
    rejected = [F.coalesce(r.rejects(counts, F.col("cutoffs")[r.name]), F.lit(False)) for r in rules]
    failed = base_failed(counts)
    any_rule = rejected[0]
    for r in rejected[1:]:
        any_rule = any_rule | r
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & ~any_rule).drop("of_stratum", "cutoffs")


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
    rules=RULES, alpha: float = 0.02, delta: float = 0.05, certify=certified_cutoffs,
) -> DataFrame:
    """``doc_id, stratum, counts, base_failed, kept`` for every document; the counts are made in one pass and written."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).alias("stratum"), F.col(text_col).alias("text"))
    counted = written(rule_counts(own).drop("text"), "counts")
    cutoffs = certify(good_documents(counted, labels, "doc_id"), rules, alpha, delta)
    return verdicts(counted, cutoffs, rules)


def keep_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
    rules=RULES, alpha: float = 0.02, delta: float = 0.05, certify=certified_cutoffs,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``.

    Counts are made once; the rows then meet their verdicts by id and by a hash of text and
    stratum, so repeated rows share one.
    """
    def found_again(doc_id: Column, text: Column, stratum: Column) -> list[Column]:
        return [F.coalesce(doc_id.cast("string"), F.lit("")).alias("at"), F.xxhash64(doc_id.isNull(), text, stratum, stratum.isNull()).alias("version")]

    own = docs.select(
        F.col(id_col).alias("doc_id"), F.col(stratum_col).alias("stratum"), F.col(text_col).alias("text"),
        *found_again(F.col(id_col), F.col(text_col), F.col(stratum_col)),
    )
    counted = written(rule_counts(own).drop("text"), "counts")
    cutoffs = certify(good_documents(counted, labels, "doc_id"), rules, alpha, delta)
    kept = written(verdicts(counted, cutoffs, rules).where("kept").select("at", "version"), "kept")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    doc = F.col("doc")
    rows = whole.select("doc", *found_again(doc[id_col], doc[text_col], doc[stratum_col]))
    return rows.join(kept, ["at", "version"], "left_semi").select("doc.*")

"""Quality rules, the pipeline, and the registered queries."""

import hashlib
import random

import brute
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from paylens.llm import bpe, quality_rules, queries


def with_lang(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "doc_id bigint, text string, lang string, counts string, stratum string")


def prose(n=260):
    r = random.Random(12)
    rows = []
    for i in range(n):
        words = [r.choice(["alpha", "beta", "gamma", "delta", "of", "in"]) + str(r.randrange(60)) for _ in range(r.randrange(10, 60))]
        if i % 9 == 0:
            words = [w + "###" for w in words]
        if i % 11 == 0:
            words = words[:12] * 4
        rows.append((1000 + i, " ".join(words[:20]) + "\n" + " ".join(words[20:]), ["en", "de", None][i % 3]))
    return rows


def test_counts_against_brute_force(spark, edges):
    rows = [(*e, "en") for e in edges] + prose(60)
    got = quality_rules.rule_counts(with_lang(spark, rows)).select("doc_id", "text", "counts.*").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, t, *brute.counts(t).values()) for i, t, _ in rows), key=str)


def test_tail_is_exact(spark):
    cases = [(10, 0), (200, 1), (200, 3), (5000, 20), (5000, 0)]
    df = spark.createDataFrame(cases, "n bigint, k bigint").select("n", "k", quality_rules._tail(F.col("n"), F.col("k"), 0.004).alias("p"))
    for r in df.collect():
        assert r.p == pytest.approx(brute.tail(r.n, r.k, 0.004), rel=1e-9)


def test_verdicts_against_brute_force(spark, edges):
    rows = [(*e, "en") for e in edges] + prose()
    labels = [(i, 0 if "###" in (t or "") else 1) for i, t, _ in rows if i and i % 5] + [(1003, None), (1004, 0), (1004, 1), (77, 1), (None, 1)]
    frame = spark.createDataFrame([(*x, "x") for x in labels], "doc_id bigint, quality int, counts string")
    for alpha in (0.02, 0.8):
        want = brute.keeps(rows, labels, quality_rules.RULES, alpha, 0.05)
        got = quality_rules.judge(with_lang(spark, rows), frame, alpha=alpha).collect()
        assert sorted(((r.doc_id, r.kept) for r in got), key=str) == sorted(((r[0], k) for r, k in zip(rows, want)), key=str)
        kept = quality_rules.keep_documents(with_lang(spark, rows), frame, alpha=alpha)
        assert kept.columns == with_lang(spark, rows).columns
        assert sorted((tuple(r)[:2] for r in kept.collect()), key=str) == sorted((r[:2] for r, k in zip(rows, want) if k), key=str)
    assert any(not k and not brute.base_failed(brute.counts(r[1])) for r, k in zip(rows, want))
    none = quality_rules.judge(with_lang(spark, rows), frame.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in none) and quality_rules.judge(with_lang(spark, []), frame).collect() == []


def test_joint_certificate_needs_hundreds_of_labels(spark):
    plain, odd = " ".join(f"word{i}" for i in range(40)), " ".join(f"w#{i}" for i in range(40))
    # Strata of 300 good labels, 300 of which 60 are like the bad ones, and 190, 190 and two like the bad ones, tested together.
    sizes = {"a": (300, 0), "b": (240, 60), "c": (190, 0), None: (190, 0), "d": (0, 2)}
    rows, labels = [], []
    for stratum, (n_plain, n_odd) in sizes.items():
        for text, n, value in ((plain, n_plain, 1), (odd, n_odd, 1), (odd, 5, 0)):
            for _ in range(n):
                rows.append((len(rows), text, stratum))
                labels.append((len(labels), value))
    # Good documents that the fixed rules reject prove nothing about cutoffs.
    for _ in range(30):
        rows.append((len(rows), "w#1 w#2", "a"))
        labels.append((len(labels), 1))
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int")
    docs = with_lang(spark, rows)
    good = quality_rules.good_documents(quality_rules.rule_counts(docs.select("doc_id", "text", F.col("lang").alias("stratum"))), frame)
    found = {r.stratum: r.cutoffs for r in quality_rules.joint_cutoffs(good).collect()}
    counted = {}
    for (_, text, stratum), (_, value) in zip(rows, labels):
        if value == 1 and not brute.base_failed(brute.counts(text)):
            counted.setdefault(stratum, []).append(brute.counts(text))
    level = 0.05 / len(counted)
    small = {s for s, c in counted.items() if brute.tail(len(c), 0, 0.02) > level}
    assert small == {"c", None, "d"}
    for stratum, own in counted.items():
        tested = sum((counted[s] for s in small), []) if stratum in small else own
        want = dict.fromkeys(r.name for r in quality_rules.RULES)
        for step in quality_rules.steps_of():
            k, own_k = (sum(any(brute.rejects(r, c, step[r.name]) for r in quality_rules.RULES) for c in part) for part in (tested, own))
            if brute.tail(len(tested), k, 0.02) > level or (stratum in small and own_k > 0.02 * len(own)):
                break
            want = step
        assert found[stratum].asDict() == want
    assert found["a"].symbols is not None and found["b"].symbols != found["a"].symbols
    kept = quality_rules.keep_documents(docs, frame, certify=quality_rules.joint_cutoffs)
    left = {(r.lang, r.text == odd) for r in kept.collect()}
    assert ("a", True) not in left and ("a", False) in left and ("b", True) in left and ("d", True) in left
    # The strict certificate rejects nothing here.
    assert quality_rules.keep_documents(docs, frame).count() == len(rows) - 30


def test_pipeline_against_brute_force(spark, sf):
    got = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, sf).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    kept = brute.keeps(docs, labels, quality_rules.RULES, 0.02, 0.05)
    rows = [(i, t) for (i, t, _), k in zip(docs, kept) if k]
    gone = brute.removed_lines(rows)
    rows = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i, t])) for i, t in rows]
    prints = {t: brute.fingerprint(t) for _, t in rows}
    group = brute.groups(prints.values())
    least = {}
    for i, t in rows:
        g = group[prints[t]]
        least[g] = min(i, least.get(g, i))
    rows = [(i, t) for i, t in rows if least[group[prints[t]]] == i]
    hit = {r[0] for r in brute.contamination(rows, items) if r[-1]}
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encode = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={}).encode_ordinary
    want = {}
    for i, t in rows:
        if i not in hit:
            ids = encode(t)
            want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert got == want and 0 < len(want) < len(docs)


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), sf)
        assert out.columns == docs.columns and out.count() == 0


def test_every_operator_is_registered():
    names = sorted(queries.load())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} and len(names) == 13
    assert set(corpus_pipeline.load()) == {"pipeline"}

"""Positional index and SimHash near-duplicates."""

import itertools
import pickle
import random

import numpy as np
import brute
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paylens.llm import components, phrase_index, queries, simhash


def items_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "item_id bigint, text string, item string, block string")


def digest(found):
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("s"),
        (F.col("n_hit") > 0).alias("c"),
    )


@pytest.fixture(scope="module")
def passages():
    r = random.Random(5)
    words = ["the", "of", "and", *[f"w{i}" for i in range(12)]]
    return [" ".join(r.choice(words) for _ in range(n)) for n in (10, 14, 25, 40, 3, 1, 9)]


def test_phrases_against_brute_force(spark, make, edges, passages, monkeypatch):
    items = [(i, p) for i, p in enumerate(passages)] + [(3, passages[0]), (None, "an item with no id"), (20, None), (21, ""), (22, "!!")]
    r = random.Random(6)
    rows = list(edges)
    for i in range(60):
        p = r.choice(passages).split(" ")
        noise = [r.choice(["the", "of", "W3", "w1", "w11."]) for _ in range(r.randrange(30))]
        rows.append((100 + i, " ".join(noise + p[r.randrange(3) :] + noise).upper() if i % 2 else " ".join(p + noise)))
    want = sorted(brute.contamination(rows, items), key=str)
    for shard, block, candidates in ((1 << 20, 4 << 20, 1 << 21), (40, 30, 5)):
        monkeypatch.setattr(phrase_index, "SHARD_WORDS", shard)
        monkeypatch.setattr(phrase_index, "BLOCK_WORDS", block)
        monkeypatch.setattr(phrase_index, "CANDIDATES", candidates)
        got = digest(phrase_index.contamination(make(rows), items_frame(spark, items))).collect()
        assert sorted(map(tuple, got), key=str) == want


def test_no_items_or_documents(spark, make, edges):
    none = phrase_index.contamination(make(edges), items_frame(spark, [])).collect()
    assert len(none) == len(edges) and not any(r.n_hit for r in none)
    assert phrase_index.contamination(make([]), items_frame(spark, [(1, "a b c")])).collect() == []
    clean = phrase_index.drop_contaminated(make(edges), items_frame(spark, [(1, "very same text")]))
    assert clean.columns == make(edges).columns and clean.count() == len(edges) - 2


def test_lists_are_intersected_with_slop():
    r = np.random.default_rng(1)
    for _ in range(40):
        toks = r.integers(0, 4, 50)
        counts, places = np.bincount(toks, minlength=4), np.argsort(toks, kind="stable")
        for length, slop in itertools.product((1, 2, 3), (0, 1, 2)):
            windows = np.array(list(itertools.product(range(4), repeat=length)))[:9]
            span = 50 + 2 * slop + 1
            keys = np.repeat(np.arange(4), counts) * span + places
            got = {(int(w), int(s)) for ws, ss in phrase_index.find(windows, keys, counts, span, slop) for w, s in zip(ws, ss) if s + length <= 50}
            for i, w in enumerate(windows):
                rare = min(range(length), key=lambda k: (counts[w[k]], k))
                near = {
                    s for s in range(50 - length + 1) if toks[s + rare] == w[rare]
                    and all((toks[max(0, s + k - slop) : s + k + slop + 1] == w[k]).any() for k in range(length) if k != rare)
                }
                assert {s for j, s in got if j == i} == near


def test_position_sets_cover():
    for shared in (4, 6):
        chosen = simhash.covering_sets(shared)
        assert all(any(set(c) <= set(g) for c in chosen) for g in itertools.combinations(range(8), shared))


def test_components(spark):
    r = random.Random(2)
    pairs = [(r.randrange(-40, 40), r.randrange(-40, 40)) for _ in range(50)] + [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 530)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = dict(map(tuple, components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()))
    assert got == {x: find(x) for x in root}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def near_copies():
    r = random.Random(8)
    vocabulary = [f"word{i}" for i in range(400)]
    rows = []
    for group in range(6):
        base = [r.choice(vocabulary) for _ in range(250)]
        for copy in range(12):
            words = list(base)
            for _ in range(r.randrange(4)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            rows.append((100 * group + copy + 20, " ".join(words)))
    return rows


@pytest.mark.parametrize("hot", [200, 3])
def test_near_copies_against_brute_force(make, edges, hot, monkeypatch):
    rows = edges + near_copies()
    links = simhash.links
    monkeypatch.setattr(simhash, "links", lambda nodes, distance: links(nodes, distance, hot))
    got = simhash.near_duplicates(make(rows)).collect()
    prints = {text: brute.fingerprint(text) for _, text in rows}
    group = brute.groups(prints.values())
    least = {}
    for doc_id, text in rows:
        g = group[prints[text]]
        least[g] = min((x for x in (least.get(g), doc_id) if x is not None), default=None)
    want = [(doc_id, prints[text], least[group[prints[text]]]) for doc_id, text in rows]
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == sorted(want, key=str)
    assert len(set(group.values())) < len(set(prints.values()))


def test_one_of_each_group_stays(make, edges):
    kept = simhash.keep_one(make(edges))
    assert kept.columns == make(edges).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids.count(6) == 1 and 1 in ids and 2 not in ids and 3 not in ids and ids.count(9) == 2 and None in ids
    assert simhash.keep_one(make([])).collect() == [] and simhash.near_duplicates(make([])).collect() == []


def test_queries_have_the_contract_columns(spark, sf):
    found = queries.load()
    assert found["op3_decontamination"].run(spark, sf).columns[:6] == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    row = found["op4_simhash"].run(spark, sf).first()
    assert len(row.fingerprint) == 16 and row.component_id <= row.doc_id


@pytest.mark.parametrize("key_bytes", [2, 3, 4])
def test_keys_of_any_width_find_all_links(spark, key_bytes):
    r = random.Random(key_bytes)
    prints = [r.getrandbits(64) for _ in range(60)]
    for _ in range(200):
        fp = r.choice(prints)
        for _ in range(r.randrange(1, 6)):
            fp ^= 1 << r.randrange(64)
        prints.append(fp)
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {(min(x.a, x.b), max(x.a, x.b)) for x in simhash.links(nodes, 4, hot=10**6, key_bytes=key_bytes).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    with pytest.raises(ValueError):
        simhash.links(nodes, 4, key_bytes=5)


def test_index_groups_and_blocks_are_bounded(spark, make, monkeypatch):
    """However many shards a task makes, it holds some; a block costs some numbers for each of its words, not one for each word of every window."""
    monkeypatch.setattr(phrase_index, "SHARD_WORDS", 40)
    monkeypatch.setattr(phrase_index, "GROUP_BYTES", 4096, raising=False)
    index = phrase_index.build_index(make([(i, f"some words of text {i} " * 5) for i in range(200)], 1))
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    groups = [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert sum(groups) > 40 and max(groups) < 40
    r = random.Random(9)
    block = phrase_index.Windows([(str(i), " ".join(f"w{r.randrange(900)}" for _ in range(5000))) for i in range(10)], 10)
    assert len(pickle.dumps(block)) < 40 * 50_000

"""Line hashing and the set-similarity join of lines."""

import os
import random

import brute
import pytest
from pyspark.sql import functions as F

from paylens.llm import line_hash, line_join


def lined(rows):
    """Documents whose lines are copies, near copies and strangers."""
    r = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    stock = [[r.choice(words) for _ in range(r.randrange(1, 30))] for _ in range(25)]
    out = list(rows)
    for i in range(70):
        lines = []
        for _ in range(r.randrange(6)):
            line = list(r.choice(stock))
            for _ in range(r.randrange(4)):
                line[r.randrange(len(line))] = r.choice(words)
            lines.append(" ".join(line).title() if r.random() < 0.3 else "  ".join(line))
        out.append((50 + i, "\n".join(lines)))
    return out


@pytest.mark.parametrize("salt, lags", [(1 << 13, 2), (4, 1)])
def test_line_join_against_brute_force(make, edges, salt, lags, monkeypatch):
    monkeypatch.setattr(line_join, "SALT_ABOVE", salt)
    monkeypatch.setattr(line_join, "LAGS", lags)
    rows = lined(edges)
    gone = brute.removed_lines(rows)
    got = line_join.deduplicate(make(rows))
    assert got.columns == make(rows).columns
    want = []
    for doc_id, text in rows:
        left = None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone[doc_id, text])
        want.append((doc_id, left))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
    assert sum(len(x) for x in gone.values()) > 50


@pytest.mark.parametrize("rounds", [(64, 8, 1), (2, 1)])
def test_lines_of_larger_lists_against_brute_force(make, edges, rounds, monkeypatch):
    monkeypatch.setattr(line_join, "CROWD", 1)
    monkeypatch.setattr(line_join, "ROUNDS", rounds)
    monkeypatch.setattr(line_join, "SALT_ABOVE", 16)
    # First meetings decide as little as they can, so the rest is left to the lists.
    monkeypatch.setattr(line_join, "FIRST_PAIRS", 1)
    rows = lined(edges)
    gone = brute.removed_lines(rows)
    got = line_join.deduplicate(make(rows)).select("doc_id", "text").collect()
    want = [(d, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d, t])) for d, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_pairs_of_a_group_of_far_copies_do_not_grow_with_its_square(make, monkeypatch):
    """Lines that share most of their words with a group and match nobody."""
    r = random.Random(6)
    rows = []
    for i in range(300):
        line = [f"hub{k}" for k in range(70)]
        for k in r.sample(range(70), 6):
            line[k] = r.choice("abcdefgh") + str(r.randrange(30))
        rows.append((i, " ".join(line)))
    made, written = [], line_join.written

    def counted(df, label):
        out = written(df, label)
        if "x" in out.columns and "y" in out.columns:
            made.append((label, out.count()))
        return out

    monkeypatch.setattr(line_join, "written", counted)
    gone = brute.removed_lines(rows)
    assert {(x.doc_id): x.n_removed for x in line_join.decisions(make(rows)).collect()} == {d: len(gone[d, t]) for d, t in rows}
    # Lists of up to CROWD lines are still paired: that many for a line and list, at most.
    assert sum(n for label, n in made if label in ("met", "crowd-pairs")) < 12 * len(rows), made


def test_long_lines_that_only_share_neighbours_are_no_candidates(make, monkeypatch):
    """Many tokens fill 64 bits of parities; lists are built in shares of about one size."""
    r = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(r.sample(words, 160))) for i in range(30)]
    rows += [(100 + i, " ".join([*rows[i][1].split()[:150], "x", "y", str(i)])) for i in range(5)]
    made, lists, written = [], [], line_join.written

    def counted(df, label):
        out = written(df, label)
        if label in ("best", "met"):
            made.append(out.count())
        if label == "lists":
            lists.append(out.count())
        return out

    monkeypatch.setattr(line_join, "written", counted)
    gone = brute.removed_lines(rows)
    assert {x.doc_id: x.n_removed for x in line_join.decisions(make(rows)).collect()} == {d: len(gone[d, t]) for d, t in rows}
    assert sum(map(len, gone.values())) == 5 and sum(made) < 10, made
    assert len(lists) == line_join.SHARES > 1 and sum(lists) > 20 and max(lists) < 0.75 * sum(lists), lists


def test_lines_of_other_sizes_do_not_crowd_a_list(make, monkeypatch):
    """All lines share neighbours, few are of one size: they meet in parts of their list and need no index."""
    r = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(words * 2))]
    for i in range(120):
        rows.append((1 + i, " ".join(["hub1", "hub2", "hub3", "hub4", *r.sample(words, 6 + 3 * i // 2)])))
    # Copies with up to a fifth more words, of which many are of the next interval of sizes.
    rows += [(1000 + i, " ".join([rows[i][1], *[f"own{i}x{k}" for k in range(len(rows[i][1].split()) // 5)]])) for i in range(10, 121, 10)]
    # Beside the common words, which are the most frequent ones.
    rows += [(2000 + i, " ".join(["hub", *words[: 390 - i]])) for i in range(3)]
    crowds, written = [], line_join.written

    def counted(df, label):
        out = written(df, label)
        if label == "crowd":
            crowds.append(out.count())
        return out

    monkeypatch.setattr(line_join, "written", counted)
    monkeypatch.setattr(line_join, "FIRST_PAIRS", 1)
    # Common words come behind the shared ones.
    counts = line_join.token_rarity
    monkeypatch.setattr(line_join, "token_rarity", lambda texts: counts(texts.unionByName(make([(None, " ".join(words * 500))]).select("text"))))
    gone = brute.removed_lines(rows)
    assert {x.doc_id: x.n_removed for x in line_join.decisions(make(rows)).collect()} == {d: len(gone[d, t]) for d, t in rows}
    assert sum(map(len, gone.values())) >= 12 and crowds == [0], crowds


def test_only_lines_that_may_be_wanted_leave_their_texts(make):
    rows = [(i, "\n".join(f"line {k} of {i}" for k in range(20))) for i in range(100)] + [(None, "one\ntwo")]
    docs = make(rows)
    wanted = line_join._lines(docs, "doc_id", "text").where("line = 1 AND (doc_id % 25 = 0 OR doc_id IS NULL)")
    wanted = wanted.select(F.col("doc_id").alias("at_id"), F.col("version").alias("at_version"), F.col("line").alias("at_line"))
    near = {(r.doc_id, r.content) for r in line_join._near_wanted(docs, wanted, "doc_id", "text").collect()}
    assert {(None, "two"), *((i, f"line 1 of {i}") for i in range(0, 100, 25))} <= near and len(near) < 10


def test_prefixes_of_all_lines_are_gone_before_classes_are_ordered(make, monkeypatch):
    kept, written = {}, line_join.written

    def seen(df, label):
        out = written(df, label)
        kept[label] = {name for name, path in paths.items() if os.path.exists(path.removeprefix("file:"))}
        paths[label] = out.scratch
        return out

    paths = {}
    monkeypatch.setattr(line_join, "written", seen)
    line_join.decisions(make([(1, "one two three"), (2, "one two three\nfour")])).collect()
    assert "posted" not in kept["classes"]


def test_frequent_tokens_stay_in_order_and_are_dealt(spark):
    counts = [0, 1, 60_000, 10**6, 10**8, 2**62]
    levels = [r.v for r in spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "i int, c bigint").orderBy("i").select(
        line_join._level(F.col("c")).alias("v")
    ).collect()]
    words = [f"w{i}" for i in range(12)]
    line = spark.createDataFrame([(" ".join(words),)], "line string")
    bucket = line.select(F.explode(F.split("line", " ")).alias("w")).select("w", F.xxhash64("w").bitwiseAND(line_join.BUCKETS - 1).alias("b"))
    rarity, own = [0] * line_join.BUCKETS, {}
    for i, r in enumerate(bucket.collect()):
        rarity[r.b] = own[r.w] = levels[i % len(levels)]
    # One word at a time gives its token.
    frame = spark.createDataFrame([(w,) for w in words], "w string").select("w", line_join._token_sets(F.col("w"), rarity)[0].alias("t"))
    rows = frame.select("w", "t", line_join._salts(F.col("t")).alias("salts")).collect()
    by_token = sorted(rows, key=lambda r: r.t)
    assert [own[r.w] for r in by_token] == sorted(own.values()) and len(set(levels)) == len(counts)
    for r in rows:
        count = counts[levels.index(own[r.w])]
        assert count / r.salts <= 2 * line_join.SALT_ABOVE and (r.salts == 1 or count / r.salts >= line_join.SALT_ABOVE / 2)


def test_line_decisions(make, edges):
    got = {r.doc_id: r for r in line_join.decisions(make(edges)).collect() if r.doc_id in (1, 2, 5, 7, 8)}
    assert got[1].n_lines == got[2].n_lines == 0 and got[5].removed == "1" and got[8].n_removed == 1
    assert line_join.decisions(make([])).collect() == [] and line_join.deduplicate(make([])).collect() == []


def test_line_hashes_against_brute_force(make, edges):
    rows = lined(edges)
    first, order = {}, sorted(set(rows), key=lambda r: (brute.place(r), r[1] is None))
    got = line_hash.deduplicate(make(rows)).collect()
    by_row = {}
    for r in got:
        by_row.setdefault(r.doc_id, []).append(r)
    same_id = {9, None}
    for doc_id, text in order:
        if doc_id in same_id:
            continue
        keep, gone = [], []
        for start, end, digest in line_hash.unit_rows(text or "") if text is not None else []:
            if digest is not None and digest in first:
                gone.append((start, end, first[digest]))
            else:
                keep.append((start, end))
                if digest is not None:
                    first[digest] = doc_id
        for r in by_row[doc_id]:
            assert [tuple(x) for x in r.kept] == keep and [tuple(x) for x in r.removed] == gone
            assert r.text == (text if not gone else "\n".join(text[a:b] for a, b in keep))
    assert len(got) == len(rows) and line_hash.deduplicate(make([])).collect() == []


def test_passage_in_many_documents(make):
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [(i, f"own words of document {i} here\n{passage.upper() if i % 2 else passage}\nend of {i}") for i in range(40)]
    got = line_hash.deduplicate(make(rows)).collect()
    assert all([x.kept_in for x in r.removed] == ([] if r.doc_id == 0 else [0]) for r in got)
    assert all(r.text.startswith("own words") and ("assage59" in r.text) == (r.doc_id == 0) for r in got)


def test_scripts_without_blanks_and_short_lines(make):
    long, short = "同じ段落がここに繰り返されている長い一行の文章です", "two words"
    rows = [(i, f"{long}\n{short}\n \n\n{i}") for i in range(3)]

    def left(**least):
        return {r.doc_id: r.text for r in line_hash.deduplicate(make(rows), **least).collect()}

    assert left() == dict(rows)
    assert left(least_chars=20) == {i: t if i == 0 else f"{short}\n \n\n{i}" for i, t in rows}
    assert left(least_words=1) == {i: t if i == 0 else f" \n\n{i}" for i, t in rows}


def sentences(text):
    """(start, end, words) of every sentence, character by character."""
    out, start, i = [], 0, 0
    while i < len(text):
        if text[i] == "\n":
            out.append((start, i))
            start = i = i + 1
        elif text[i] in " \t\x0b\x0c\r" and i and text[i - 1] in ".!?。！？":
            out.append((start, i))
            while i < len(text) and text[i] in " \t\x0b\x0c\r":
                i += 1
            start = i
        else:
            i += 1
    out.append((start, len(text)))
    lowered = [(a, b, tuple("".join(c.lower() if "A" <= c <= "Z" else c for c in text[a:b]).replace("\x0b", " ").split(" "))) for a, b in out]
    return [(a, b, tuple(w for part in words for w in part.split())) for a, b, words in lowered]


def passages(rows, least):
    """Removed (start, end, kept_in) and the number of repeated sentences, by looking at all documents at once."""
    places = {}
    for doc_id, text in rows:
        for a, _, words in sentences(text or ""):
            if words:
                places.setdefault(words, set()).add((doc_id, a))
    inside = {}
    for doc_id, text in rows:
        run = []
        for a, b, words in [x for x in sentences(text or "") if x[2]] + [(None, None, None)]:
            if words is not None and len(places[words]) > 1:
                run.append((a, b, words))
                continue
            if sum(max(len(w), sum(map(len, w)) // 8) for _, _, w in run) >= least:
                for x, y, w in run:
                    inside.setdefault(w, set()).add((doc_id, x, y))
            run = []
    gone, known = {}, {}
    for held in inside.values():
        first = min(held)
        for place in held:
            known[place[0]] = known.get(place[0], 0) + 1
            if place != first:
                gone.setdefault(place[0], []).append((place[1], place[2], first[0]))
    return {d: sorted(x) for d, x in gone.items()}, known


@pytest.mark.parametrize("least", [1, 12, 30])
def test_passages_against_a_plain_version(make, least):
    r = random.Random(least)
    words = [f"w{i}" for i in range(400)]

    def prose(n):
        return "".join(r.choice(words) + r.choice([" "] * 7 + [". ", "! ", "?  ", ".\n", "\n", "\n\n", ".  \n "]) for _ in range(n))

    shared = [prose(60) for _ in range(4)] + ["これは長い段落です。" * 12]
    rows = [(0, None), (1, ""), (2, " \n. ! "), (3, "Short one. Short one.")]
    for i in range(40):
        text = prose(r.randrange(50))
        for _ in range(r.randrange(3)):
            text += r.choice(shared) + prose(r.randrange(20))
        rows.append((10 + i, text))
    rows += [(60, rows[-1][1]), (61, rows[-1][1].upper())]
    gone, known = passages(rows, least)
    texts = dict(rows)
    found = line_hash.deduplicate(make(rows + rows[7:9]), least_words=1, by="sentences", least_passage=least).collect()
    assert len(found) == len(rows) + 2
    for f in found:
        assert [tuple(x) for x in f.removed] == gone.get(f.doc_id, []) and f.repeated == known.get(f.doc_id, 0)
        assert f.n_units == sum(1 for x in sentences(texts[f.doc_id] or "") if x[2])
        if not f.removed:
            assert f.text == texts[f.doc_id]
        assert "".join(texts[f.doc_id][x.start : x.end] for x in f.kept) == "".join((texts[f.doc_id] or "")[a:b] for a, b, _ in sentences(texts[f.doc_id] or "") if (a, b) not in {(x.start, x.end) for x in f.removed}) if texts[f.doc_id] else True
    assert gone


def test_a_passage_inside_lines_is_found_and_clean_prose_stays(make):
    passage = " ".join(f"Sentence {i} of the passage has seven words." for i in range(9))
    rows = [(i, f"Own words number {i} come first here {passage} and own words end. Yes. That is all.") for i in range(30)]
    rows += [(100 + i, f"Nothing in {i} is shared but this. Yes. That is all. And {i} ends.") for i in range(30)]
    got = {r.doc_id: r for r in line_hash.deduplicate(make(rows), least_words=1, by="sentences", least_passage=30).collect()}
    assert all(got[i].repeated >= 8 and (len(got[i].removed) >= 8) == (i > 0) for i in range(30))
    assert all(got[100 + i].text == rows[30 + i][1] and not got[100 + i].repeated for i in range(30))

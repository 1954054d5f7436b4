"""Near copies by sketches, spelling variants and conversation repair against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from paylens.llm import bottomk, dialogue, permuterm
from paylens.llm.queries import load

EDGES = "doc_id bigint, text string"


# -- near copies ---------------------------------------------------------------------------------


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def plain_components(rows, width):
    sets = [shingle_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        name = least.get(top(i))
        out.append((doc_id, len(sets[i]), name, doc_id is not None and doc_id == name))
    return out


def by_text(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def found_components(docs, width):
    return by_text(tuple(r) for r in bottomk.near_duplicates(docs, width).select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize("crowd", [2, 16, 10**6])
def test_near_copies_match_all_pairs(make, crowd, monkeypatch):
    monkeypatch.setattr(bottomk, "CROWD", crowd)
    rng = random.Random(5)
    rows = []
    for family in range(12):
        base = [f"w{family}x{rng.randrange(400)}" for _ in range(rng.choice((3, 12, 60, 300)))]
        for _ in range(rng.choice((1, 2, 25))):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 2, 3, 5))):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    shared = " ".join(f"passage{i}" for i in range(50))
    rows += [(2000 + i, shared + " " + " ".join(f"own{i}x{j}" for j in range(4 + i % 20))) for i in range(40)]
    base = [f"hub{i}" for i in range(150)]
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randrange(9)):
            copy[rng.randrange(len(copy))] = f"far{rng.randrange(40)}"
        rows.append((3000 + len(rows), " ".join(copy)))
    rng.shuffle(rows)
    assert found_components(make(rows), 4) == by_text(plain_components(rows, 4))


@pytest.mark.parametrize("edits", [2, 4])
def test_pairs_of_a_large_group_do_not_grow_with_its_square(make, edits, monkeypatch):
    """Copies with two edits all match, those with four share most of their shingles and match nobody."""
    rng = random.Random(3)
    rows = []
    for i in range(150):
        copy = [f"hub{k}" for k in range(200)]
        for k in rng.sample(range(3, 197), edits):
            copy[k] = f"far{i}x{k}"
        rows.append((i, " ".join(copy)))
    made, verified = [], bottomk.verified

    def counted(docs, classes, pairs, *rest):
        made.append(pairs.count())
        return verified(docs, classes, pairs, *rest)

    monkeypatch.setattr(bottomk, "verified", counted)
    assert found_components(make(rows), 4) == by_text(plain_components(rows, 4))
    assert sum(made) < 5 * len(rows)


def test_parity_maps_differ_in_no_more_bits_than_sets():
    rng = random.Random(4)
    for _ in range(50):
        a, b = ({rng.getrandbits(40) for _ in range(rng.randrange(400))} for _ in "ab")
        b |= set(list(a)[: rng.randrange(400)])
        maps = [int.from_bytes(bottomk.parity_map(np.array(sorted(x), np.int64)).tobytes(), "little") for x in (a, b)]
        assert (maps[0] ^ maps[1]).bit_count() <= len(a ^ b)


def test_chain_of_links_is_one_component(make):
    words = [f"t{i}" for i in range(200)]
    rows = [(i, " ".join(words[i * 10 : i * 10 + 100])) for i in range(8)]
    want = plain_components(rows, 2)
    assert {r[2] for r in want} == {0}
    assert found_components(make(rows), 2) == by_text(want)


def test_near_copy_edges(make, edges):
    assert found_components(make(edges), 4) == by_text(plain_components(edges, 4))
    assert found_components(make([]), 4) == []


def test_registered_near_copies(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert by_text(tuple(r) for r in load()["op11_minhash"].run(spark, sf).collect()) == by_text(plain_components(rows, 4))


# -- spelling variants ---------------------------------------------------------------------------


def plain_variants(rows, least_length=7, least_count=2, drop=31, times=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop and h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if abs(len(a) - len(b)) != 1:
            return False
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    forms, out = {}, []
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w, n in words.items():
        mates = [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_length.get(size, ()) if near(w, v)]
        best = min(mates, key=lambda v: (-words[v], v), default=None)
        forms[w] = (best if best is not None and words[best] >= times * n else None, len(mates))
    for w, n in words.items():
        root = w
        while forms[root][0] is not None:
            root = forms[root][0]
        form = forms[w][0]
        out.append((w, form, root, n, forms[w][1], words[form] if form else None))
    return out


def found_variants(docs, **kw):
    words = permuterm.count_words(docs, kw.get("least_length", 7), kw.get("least_count", 2), kw.get("drop", 31))
    found = permuterm.variants(words, kw.get("times", 10))
    return by_text(tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_variants_match_all_pairs(make):
    rng = random.Random(3)
    letters = "abéß÷"
    words = ["".join(rng.choice(letters) for _ in range(rng.choice((6, 7, 8, 9)))) for _ in range(150)]
    rows = []
    for i in range(300):
        picked = [words[min(int(rng.expovariate(0.05)), len(words) - 1)] for _ in range(30)]
        rows.append((i, " ".join(w if rng.random() < 0.8 else w[:2] + rng.choice(letters) + w[2:] for w in picked)))
    assert found_variants(make(rows), times=2) == by_text(plain_variants(rows, times=2))
    assert found_variants(make(rows), times=10) == by_text(plain_variants(rows, times=10))


def test_equal_letters_count_once_and_chains_reach_the_root(make):
    text = " ".join(["aaaaaaaa"] * 4000 + ["aaaaaaa"] * 300 + ["aaaaaab"] * 20 + ["aaaaabb"] * 2 + ["aaaabbb"] * 2)
    rows = [(1, text)]
    want = by_text(plain_variants(rows, drop=0))
    assert found_variants(make(rows), drop=0) == want
    assert {r[0]: r[2] for r in want}["aaaaabb"] == "aaaaaaaa"


def test_variant_edges(make, edges):
    assert found_variants(make(edges), least_length=2, least_count=1) == by_text(plain_variants(edges, 2, 1))
    assert found_variants(make([])) == []
    assert found_variants(make([(1, None), (2, "1 2 3")])) == []
    with pytest.raises(ValueError):
        permuterm.variants(permuterm.count_words(make([])), times=1)


def test_registered_variants(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = by_text(tuple(r) for r in load()["op12_spelling_variants"].run(spark, sf).collect())
    assert got == by_text(plain_variants(rows))


# -- conversations -------------------------------------------------------------------------------


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], xxhash.xxh64_intdigest(r[3], 42) - (xxhash.xxh64_intdigest(r[3], 42) >> 63 << 64)))


def cheapest(rows):
    """All cheapest edits by costs and letters of every prefix, state by state."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    may = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    names = {"u": "user", "a": "assistant"}

    def with_insertions(best):
        for _ in range(3):
            for state, (cost, letters, texts) in list(best.items()):
                to = follow[state]
                option = (cost + 5, letters + "I", texts + (f"{names[to]}:",))
                if to not in best or option[:2] < best[to][:2]:
                    best[to] = option
        return best

    best = with_insertions({"": (0, "", ())})
    for (_, _, role, text), fault in zip(rows, faults):
        new = {}
        for state, (cost, letters, texts) in best.items():
            options = [(state, (cost + 2, letters + "D", texts))]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if (state, role[:1]) in may:
                    options.append((role[:1], (cost + extra, letters + "K", (*texts, f"{role}:{text}"))))
                to = follow[state]
                options.append((to, (cost + 1 + extra, letters + "R", (*texts, f"{names[to]}:{text}"))))
            for to, option in options:
                if to not in new or option[:2] < new[to][:2]:
                    new[to] = option
        best = with_insertions(new)
    cost, letters, texts = min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])
    return faults, cost, letters, hashlib.sha256("\n".join(texts).encode()).hexdigest()


def plain_repair(rows, ids):
    out = []
    for conv in ids:
        own = in_order([r for r in rows if r[0] == conv])
        turns = [r[1] for r in own if r[1] is not None]
        faults, cost, letters, digest = cheapest(own)
        legal = {"su", "ua", "au"}
        illegal = sum(a[2][:1] + b[2][:1] not in legal for a, b in zip(own, own[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, digest))
    return by_text(out)


TURNS = "conv_id bigint, turn bigint, role string, text string"


def repaired(rows, damage=True):
    frame = dialogue.damage(rows) if damage else rows.select("conv_id", "turn", "role", "text", F.lit(1).cast("long").alias("copies"))
    return by_text(tuple(r) for r in dialogue.repair(frame, rows).collect())


def invented(rng, ids, turns):
    rows = []
    for conv in ids:
        at = 0
        for _ in range(rng.randrange(turns) + 1):
            at += rng.choice((0, 1, 1, 1, 1, 2))
            role = rng.choice(("system", "user", "user", "assistant", "assistant", "tool", None, "", "User"))
            text = rng.choice(("Yes.", "No!", "Cut off", " \n\t", "", None, f"Line {rng.randrange(9)}?", "end. \x0b"))
            rows.append((conv, None if rng.random() < 0.05 else at, role, text))
    return rows


@pytest.fixture
def many_segments(spark):
    """Small parts stay apart, so that conversations are cut into segments."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_repair_matches_plain_dynamic_programme(spark):
    rng = random.Random(11)
    rows = invented(rng, [*range(150), None], 9)
    frame = spark.createDataFrame(rows, TURNS)
    ids = {r[0] for r in rows}
    assert repaired(frame) == plain_repair(damaged(rows), ids)


def test_repair_of_one_long_conversation_in_segments(spark, many_segments):
    rng = random.Random(12)
    rows = invented(rng, [1], 2) + [(2, i, rng.choice(("user", "assistant")), rng.choice(("Yes.", "cut", f"Line {i}."))) for i in range(900)]
    rows += [(3, i, "user", f"Line {i}.") for i in range(300)] + [(3, 300 + i, "assistant", f"Line {i}") for i in range(300)]
    frame = spark.createDataFrame(rows, TURNS)
    placed, chosen = dialogue._planned(dialogue.damage(frame))
    assert chosen.where("conv = '=2'").count() > 1
    assert repaired(frame) == plain_repair(damaged(rows), {1, 2, 3})


def test_repaired_rows_are_what_the_hash_is_of(spark, many_segments):
    rng = random.Random(13)
    rows = invented(rng, range(40), 12)
    frame = dialogue.damage(spark.createDataFrame(rows, TURNS))
    texts = {}
    for r in sorted(dialogue.repaired_rows(frame).collect(), key=lambda r: (r["conv"], r["seg"], r["place"])):
        texts.setdefault(int(r["conv"][1:]), []).append(f"{r['role']}:{r['text']}")
    want = {r[0]: r[-1] for r in plain_repair(damaged(rows), range(40))}
    empty = hashlib.sha256().hexdigest()
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()} == {c: d for c, d in want.items() if d != empty}


def test_powers_of_long_runs():
    for symbol in "suaoSUAOx":
        step = dialogue._power(symbol, 0)
        by_steps = step
        for n in range(2, 40):
            by_steps = dialogue._times(by_steps, step)
            assert dialogue.run_matrix([(symbol, n)]) == by_steps
    letters, state = dialogue.unroll([("u", 10_000)], dialogue.FINAL, 0)
    assert letters[:3] == "KRK" and len(letters) == 10_000 and state == dialogue._ASSISTANT


def test_repair_edges(spark):
    empty = spark.createDataFrame([], TURNS)
    assert repaired(empty) == []
    rows = [(1, None, None, None), (1, None, None, None), (2, 5, "user", "x. " * 50_000), (2, 5, "user", "x. " * 50_000), (None, None, "assistant", "A.")]
    # A conversation that loses all its rows: its only turn is dropped.
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "Gone."))
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS conv", "'x' AS seg", "'x' AS copies", "'x' AS fault")
    got = repaired(frame)
    assert got == plain_repair(damaged(rows), {1, 2, None, lost})
    assert (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) in got


def test_registered_repair(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = by_text(tuple(r) for r in load()["op13_conversation_repair"].run(spark, sf).collect())
    assert got == plain_repair(damaged(rows), {r[0] for r in rows})

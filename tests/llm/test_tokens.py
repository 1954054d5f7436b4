"""Byte-level BPE and token files."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paylens.llm import bpe, pieces, tokenfile


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={}).encode_ordinary


def odd_texts():
    r = random.Random(3)
    fixed = [
        None, "", " ", "  a", " a b  c\n d \n\n e ", "a" * 3000, "ab" * 300 + "!!!!" * 100 + "ß" * 77, "it's I'll  x y 　 z\x1c q\x85 ",
        "日本語 😀😀 é́", "<|endoftext|> a", "x " * 5, "\n\n\n  foo\t bar ",
    ]
    return fixed + ["".join(r.choice(" \n\t'abAé1²_-.s 日") for _ in range(r.randrange(60))) for _ in range(150)]


def test_coder_agrees_with_the_library(vocabulary, reference, monkeypatch):
    coder = bpe.Coder(vocabulary)
    texts = odd_texts()
    found = coder.encode(texts)
    assert [x.tolist() for x in found] == [reference(t or "") for t in texts]
    assert coder.decode(found) == [(t or "").encode() for t in texts]
    monkeypatch.setattr(pieces, "MEMO", 10)  # the memo starts anew at every call
    assert [x.tolist() for x in coder.encode(texts)] == [x.tolist() for x in found]
    assert not any(len(k) > pieces.LONG_PIECE for k in [*coder.first, *coder.rest])


def test_round_trip_of_documents(make, edges, vocabulary, reference):
    got = sorted(map(tuple, bpe.round_trip(make(edges), vocabulary).collect()), key=str)
    want = []
    for doc_id, text in edges:
        ids = reference(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_encode_then_decode(make, edges, vocabulary, reference):
    encoded = bpe.encode(make(edges), vocabulary)
    assert sorted((r.doc_id, r.ids) for r in encoded.collect() if r.doc_id) == sorted((i, reference(t or "")) for i, t in edges if i)
    decoded = bpe.decode(encoded, vocabulary).collect()
    assert sorted(bytes(r.content).decode() for r in decoded) == sorted(t or "" for _, t in edges)
    assert bpe.round_trip(make([]), vocabulary).collect() == [] and bpe.encode(make([]), vocabulary).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=2000), st.integers(9, 16))
def test_huffman_round_trip(ids, limit):
    ids = np.array(ids)
    lengths = tokenfile.code_lengths(np.bincount(ids), limit)
    used = lengths[lengths > 0].astype(float)
    assert used.max() <= limit and ((2.0**-used).sum() == 1 or len(used) == 1)
    bits, marks = tokenfile.pack(ids, lengths, tokenfile.canonical_codes(lengths))
    assert len(bits) == (int(lengths[ids].sum()) + 7) // 8
    table = tokenfile.decode_table(lengths)
    assert (tokenfile.unpack(bits, marks, len(ids), table) == ids).all()


def test_lengths_are_optimal():
    import heapq

    counts = np.array([5, 9, 12, 13, 16, 45, 0, 1, 1])
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    assert int((tokenfile.code_lengths(counts) * counts).sum()) == cost
    assert tokenfile.code_lengths(2 ** np.arange(20), 6).max() == 6
    with pytest.raises(ValueError):
        tokenfile.code_lengths(np.ones(70), 6)


def test_token_file(spark, make, edges, tmp_path, monkeypatch):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    library = Tokenizer.from_str(spec)
    library.encode_special_tokens = True
    monkeypatch.setattr(tokenfile, "BLOCK", 50)
    rows = edges + [(11, "<|endoftext|>"), (12, "two  spaces ")]
    tokenfile.write_tokens(make(rows), spec, str(tmp_path / "t"), end_id=0)
    got = tokenfile.read_checksums(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    start, want = 0, {}
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        want.setdefault(doc_id, set()).add((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        start += r.n_tokens
    whole = tokenfile.read_tokens(spark, str(tmp_path / "t")).where("doc_id = 10").first()
    assert whole.ids == library.encode(dict(rows)[10], add_special_tokens=False).ids + [0]
    tokenfile.write_tokens(make([]), spec, str(tmp_path / "e"))
    assert tokenfile.read_checksums(spark, str(tmp_path / "e")).collect() == []


def test_pieces_of_any_length_and_a_full_memo(monkeypatch):
    """Texts cut at spaces give the library's ids, also when the table starts anew all the time."""
    import random

    from paylens.llm import pieces, tokenfile

    monkeypatch.setattr(pieces, "SLOT_BITS", 9)
    monkeypatch.setattr(pieces, "MEMO", 300)
    monkeypatch.setattr(pieces, "LONG_MEMO", 20)
    spec = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    coder = tokenfile.LibraryCoder(spec)
    rng = random.Random(4)
    letters = ["a", "b", "e", "th", "ing", "é", "ß", "日本", "\u0251", "1", "23", ".", ",", "'s", "'", "-", "\n", "_", "\u00a0", "😀", "\u0301"]

    def word():
        return "".join(rng.choice(letters) for _ in range(rng.choice((0, 1, 2, 3, 5, 9, 30))))

    for _ in range(30):
        texts = [" ".join(word() for _ in range(rng.randrange(25))) + rng.choice(("", "", " ", "\n", " \n ")) for _ in range(12)] + [None, "", "a" * 8, "a" * 9, "a" * 16, "a" * 17, "b" * 300]
        want = [x.ids for x in coder.library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        assert [x.tolist() for x in coder.encode(texts)] == want


def test_keys_of_pieces_tell_all_bytes_apart():
    from paylens.llm.pieces import PieceTable

    table = PieceTable("<u2")
    words = [b"x" * n + tail for n in range(15) for tail in (b"", b"a", b"b")] + [bytes([i]) * 16 for i in range(1, 99)]
    words = sorted({w for w in words if len(w) <= 16})
    raw = np.frombuffer(b"\0" * 8 + b" ".join(words) + b"\0" * 16, np.uint8)
    sizes = np.array([len(w) for w in words])
    starts = np.cumsum(sizes + 1) - sizes - 1 + 8
    for lead in (0, 1):
        keys = table.keys(raw, starts, sizes, np.full(len(words), lead))
        assert (table.find(*keys) < 0).all()
        table.add(*keys, [np.array([lead, i], "<u2").tobytes() for i in range(len(words))])
    for lead in (0, 1):
        slot = table.find(*table.keys(raw, starts, sizes, np.full(len(words), lead)))
        assert [table.ids[a : a + n].tolist() for a, n in zip(table.at[slot], table.size[slot])] == [[lead, i] for i in range(len(words))]


def test_more_than_65536_used_ids():
    from paylens.llm import tokenfile

    rng = np.random.default_rng(1)
    counts = rng.integers(1, 50, 70_000)
    counts[:5] = 10**9
    limit = tokenfile.length_limit(len(counts))
    lengths = tokenfile.code_lengths(counts, limit)
    assert limit > 16 and lengths.max() <= limit and sum(2.0 ** -int(x) for x in lengths) == 1.0
    ids = np.concatenate([rng.permutation(70_000), rng.integers(0, 70_000, 5000), np.zeros(9000, np.int64)])
    bits, checkpoints = tokenfile.pack(ids, lengths, tokenfile.canonical_codes(lengths))
    most = int(lengths.max())
    assert (tokenfile.unpack(bits, checkpoints, len(ids), tokenfile.decode_table(lengths, most), most) == ids).all()
    assert tokenfile.length_limit(100) == tokenfile.LIMIT
    with pytest.raises(ValueError):
        tokenfile.length_limit(1 << 25)

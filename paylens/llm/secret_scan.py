"""Secret scan: fixed patterns, and a linear-chain conditional random field beside them.

Tokens are runs of letters, digits and ``+ / _ -``, or single other characters. The field
tags each token of a line as begin, inside or outside of a secret from its shape, the
words around it and features of the whole file; Viterbi finds the best tags of a line.
Spans of the field that touch no pattern match are added to the matches.

The field is trained in the driver by maximum likelihood. Its rows are lines of a sample
of ``TRAIN_DOCS`` documents (those of least id hash), of each a window of ``TEXT_CHARS``
characters at a place chosen by hash; lines are cut every ``LINE_CHARS`` characters, and
``TRAIN_LINES`` of them are tagged by the patterns, beside copies of such lines with
generated secrets put in. The sample bounds the training only: every
text is scanned whole, in the partition where it lies, without a shuffle.

Null and empty texts have no spans. Repeated rows give one row each; an empty table
gives none, and is trained on generated lines alone. Offsets count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from paylens.llm.common import ship, slices

#: Bounds of the training sample: documents, characters of a document, characters of a line, lines; and epochs.
TRAIN_DOCS, TEXT_CHARS, LINE_CHARS, TRAIN_LINES, EPOCHS = 400, 2_000, 1_000, 1_200, 25

KINDS = ("assign", "access", "hex", "crf")

# Patterns and least lengths of the contract.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the same as runs of any length of which those under 24 are dropped
ASSIGN_LEAST, ACCESS_LEAST = 6, 20


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of the pattern matches, in order of start and kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# Tokens and features

_SPACE, _LOWER, _UPPER, _DIGIT, _JOIN, _OTHER, _WIDE = range(7)


def _classes() -> np.ndarray:
    table = np.full(129, _OTHER, np.uint8)
    table[:33] = table[127] = _SPACE
    for chars, kind in (("abcdefghijklmnopqrstuvwxyz", _LOWER), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), ("0123456789", _DIGIT), ("+/_-", _JOIN)):
        table[[ord(c) for c in chars]] = kind
    table[128] = _WIDE
    return table


_CLASS = _classes()
_IN_WORD = np.isin(np.arange(7), [_LOWER, _UPPER, _DIGIT, _JOIN, _WIDE])
_HEX_CHAR = np.isin(np.arange(129), [ord(c) for c in "0123456789abcdefABCDEF"])
_LENGTHS = np.array([2, 4, 6, 8, 12, 16, 20, 24, 32, 40])
_WORDS = 1 << 12

#: Feature tables by name, with their sizes.
TABLES = {
    "shape": 32 * 2 * 11, "turns": 8 * 11, "before": _WORDS, "before2": _WORDS, "before3": _WORDS, "after": _WORDS,
    "language": 64, "symbols": 8 * 11, "digits": 8 * 11,
}


@dataclass
class Tokens:
    """Tokens of several texts: code point offsets, line number, text number, and feature ids by table."""

    start: np.ndarray
    end: np.ndarray
    line: np.ndarray
    text: np.ndarray
    ids: dict[str, np.ndarray]


def tokenize(texts: list[str], languages: list[str | None]) -> Tokens:
    """Every text is followed by a line break, so no token or line spans two texts."""
    points = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    small = np.minimum(points, 128)
    kind = _CLASS[small]
    word = _IN_WORD[kind]
    breaks = np.flatnonzero(points == 10)
    opens = (kind != _SPACE) & ~(word & np.concatenate([[False], word[:-1]]))
    start = np.flatnonzero(opens)
    size = np.array([len(t) + 1 for t in texts], np.int64)
    first = np.cumsum(size) - size
    if not len(start):
        none = np.zeros(0, np.int64)
        return Tokens(none, none, none, none, {name: none for name in TABLES})
    # A token ends where the next begins or the last of its own characters stands.
    closes = word & ~np.concatenate([word[1:], [False]])
    end = start + 1
    long = word[start]
    end[long] = np.flatnonzero(closes) + 1
    length = end - start
    inside = np.zeros(len(points) + 1, np.int32)
    inside[start] += 1
    inside[end] -= 1
    spots = np.flatnonzero(np.cumsum(inside)[:-1])
    ahead = np.cumsum(length) - length

    def any_of(flags: np.ndarray) -> np.ndarray:
        return np.bitwise_or.reduceat(flags[spots].astype(np.uint8), ahead)

    bits = any_of((1 << np.minimum(np.maximum(kind, 1) - 1, 5)).astype(np.uint8))
    bits = (bits & 15) | ((bits >> 5 & 1) << 4)
    hexed = 1 - any_of(~_HEX_CHAR[small])
    bucket = np.searchsorted(_LENGTHS, length, side="right")
    turn = np.concatenate([[0], (kind[spots][1:] != kind[spots][:-1]).astype(np.int64)])
    turn[ahead] = 0
    turns = np.minimum(np.add.reduceat(turn, ahead), 7)
    lowered = np.where(kind == _UPPER, points + 32, points)[spots].astype(np.uint64)
    nth = (np.arange(len(spots)) - np.repeat(ahead, length)).astype(np.uint64)
    mixed = (lowered + np.uint64(1)) * (nth * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03))
    name = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), ahead) * np.uint64(0xBF58476D1CE4E5B9)
    name = (name >> np.uint64(52)).astype(np.int64)
    line = np.searchsorted(breaks, start)
    text = np.searchsorted(first, start, side="right") - 1

    def beside(step: int) -> np.ndarray:
        """Name of the token ``step`` places on in the same line; 0 beyond its ends."""
        out = np.zeros(len(name), np.int64)
        if step < 0 and len(name) > -step:
            out[-step:] = np.where(line[-step:] == line[:step], name[:step], 0)
        elif step > 0 and len(name) > step:
            out[:-step] = np.where(line[step:] == line[:-step], name[step:], 0)
        return out

    def share(flags: np.ndarray) -> np.ndarray:
        """Of each text, in steps of a doubling: 0, up to 1/64, 1/32 and so on."""
        part = np.add.reduceat(flags.astype(np.int64), first) / size
        return np.where(part > 0, np.clip(np.ceil(np.log2(np.maximum(part, 1e-9))) + 7, 1, 7), 0).astype(np.int64)

    tongue = np.array([int.from_bytes(hashlib.md5((x or "").encode()).digest()[:1], "little") % 64 for x in languages], np.int64)
    ids = {
        "shape": (bits.astype(np.int64) * 2 + hexed) * 11 + bucket, "turns": turns * 11 + bucket, "before": beside(-1),
        "before2": beside(-2), "before3": beside(-3), "after": beside(1), "language": tongue[text],
        "symbols": share((kind == _OTHER) | (kind == _JOIN))[text] * 11 + bucket, "digits": share(kind == _DIGIT)[text] * 11 + bucket,
    }
    return Tokens(start - first[text], end - first[text], line, text, ids)


# Field

#: Tags: outside, begin, inside. Inside may only follow begin or inside.
_BAN = -1e9


@dataclass
class Field:
    """Weights of begin and inside by feature; outside scores 0. ``move[a, b]`` scores tag b after tag a."""

    weights: dict[str, np.ndarray]
    move: np.ndarray

    def scores(self, tokens: Tokens) -> np.ndarray:
        out = np.zeros((len(tokens.start), 3))
        for name, table in self.weights.items():
            out[:, 1:] += table[tokens.ids[name]]
        return out


def _lanes(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and length of each line, longest first."""
    first = np.flatnonzero(np.diff(line, prepend=-1))
    length = np.diff(np.append(first, len(line)))
    order = np.argsort(-length, kind="stable")
    return first[order], length[order]


def viterbi(field: Field, tokens: Tokens) -> np.ndarray:
    """Best tags of every token; lines advance side by side.

    A line is outside as a whole, and is left out of the walk, if no path can gain by
    leaving it: k tokens inside a secret gain at most their scores, k - 1 moves inside, one
    move in and one out, less the outside moves that these replace. If each token's score
    is too low to pay for the best of all three, no run of them does.
    """
    tags = np.zeros(len(tokens.start), np.int8)
    if not len(tags):
        return tags
    scores = field.scores(tokens)
    stay = field.move[0, 0]
    moves = max(0.0, field.move[1:, 1:].max() - stay) + max(0.0, field.move[0, 1:].max() - stay) + max(0.0, field.move[1:, 0].max() - stay)
    gain = scores[:, 1:].max(axis=1) + moves > 0
    open_lines = np.unique(tokens.line[gain])
    chosen = np.flatnonzero(np.isin(tokens.line, open_lines))
    if not len(chosen):
        return tags
    scores = scores[chosen]
    first, length = _lanes(tokens.line[chosen])
    steps = int(length[0])
    active = np.searchsorted(-length, -np.arange(steps), side="left")
    best = scores[first].copy()
    best[:, 2] = _BAN
    came = np.zeros((len(chosen), 3), np.int8)
    for t in range(1, steps):
        n = active[t]
        paths = best[:n, :, None] + field.move[None]
        at = first[:n] + t
        came[at] = paths.argmax(axis=1)
        best[:n] = paths.max(axis=1) + scores[at]
    state = best.argmax(axis=1).astype(np.int8)
    out = np.zeros(len(chosen), np.int8)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = first[:n] + t
        out[at] = state[:n]
        state[:n] = came[at, state[:n]] if t else state[:n]
    tags[chosen] = out
    return tags


def field_spans(tokens: Tokens, tags: np.ndarray) -> list[tuple[int, int, int]]:
    """``text, start, end`` of every begin and the insides after it."""
    begin = np.flatnonzero(tags == 1)
    out = []
    for i in begin.tolist():
        last = i
        while last + 1 < len(tags) and tags[last + 1] == 2 and tokens.line[last + 1] == tokens.line[i]:
            last += 1
        out.append((int(tokens.text[i]), int(tokens.start[i]), int(tokens.end[last])))
    return out


# Training


def _tagged(tokens: Tokens, spans: list[list[tuple[int, int]]]) -> np.ndarray:
    """Tags of tokens that lie in the given spans of their text."""
    tags = np.zeros(len(tokens.start), np.int8)
    for i, (text, start, end) in enumerate(zip(tokens.text.tolist(), tokens.start.tolist(), tokens.end.tolist())):
        for a, b in spans[text]:
            if start >= a and end <= b:
                tags[i] = 2 if i and tags[i - 1] and tokens.line[i - 1] == tokens.line[i] and tokens.start[i - 1] >= a else 1
    return tags


def secret_part(text: str, span: tuple[int, int, str]) -> tuple[int, int]:
    """The secret itself: of an assignment only its value."""
    if span[2] != "assign":
        return span[:2]
    found = _ASSIGN.match(text, span[0])
    return found.span(2)


def _generated(rng: np.random.Generator, lines: list[str]) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines with a made-up secret at a word border."""
    small, hexes = "abcdefghijklmnopqrstuvwxyz0123456789", "0123456789abcdef"
    mixed = small + "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def pick(chars: str, low: int, high: int) -> str:
        return "".join(rng.choice(list(chars), rng.integers(low, high)))

    # Wordings in which secrets are commonly written down.
    frames = (
        'token = "{}"', "password: {}", "passwd={}", "api_key = '{}'", "apikey: {}", "secret = {}", "Authorization: Bearer {}",
        "access key {}", "private key {}", "pwd = {}", "auth: {}", "{}",
    )
    out = []
    for i, line in enumerate(lines):
        frame = frames[i % len(frames)]
        value = (pick(hexes, 24, 48), "AKIA" + pick(small.upper(), 16, 17), pick(mixed, 20, 44), pick(mixed + "+/_", 24, 44))[i // len(frames) % 4]
        words = line.split(" ")
        cut = int(rng.integers(0, len(words) + 1))
        head = "".join(w + " " for w in words[:cut]) + frame[: frame.index("{")]
        tail = frame[frame.index("{") + 2 :] + "".join(" " + w for w in words[cut:])
        out.append((head + value + tail, [(len(head), len(head) + len(value))]))
    return out


def train(rows: list[tuple[str, str | None]], seed: int = 7, epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Fit the field to texts and their languages by gradient steps on the likelihood of their lines."""
    rng = np.random.default_rng(seed)
    cut = [(line[i : i + LINE_CHARS], lang) for text, lang in rows for line in text.split("\n") for i in range(0, len(line), LINE_CHARS)]
    lines = [x for x in cut if x[0].strip()]
    lines = [lines[i] for i in np.sort(rng.permutation(len(lines))[:TRAIN_LINES])] or [("there is nothing in this line", None)]
    tongues = [lang for _, lang in lines]
    made = _generated(rng, [line for line, _ in lines[:: max(1, len(lines) // (TRAIN_LINES // 2))]] or ["and"])
    texts = [line for line, _ in lines] + [t for t, _ in made]
    spans = [[secret_part(line, s) for s in base_spans(line)] for line, _ in lines] + [s for _, s in made]
    tongues += [tongues[i % len(tongues)] for i in range(len(made))]
    tokens = tokenize(texts, tongues)
    gold = _tagged(tokens, spans)
    first, length = _lanes(tokens.line)
    steps = int(length[0])
    active = np.searchsorted(-length, -np.arange(steps), side="left")
    field = Field({name: np.zeros((size, 2)) for name, size in TABLES.items()}, np.array([[0.0, 0.0, _BAN], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]))
    allowed = field.move > _BAN / 2
    squares = {name: np.full((size, 2), 1e-8) for name, size in TABLES.items()}
    squares_move = np.full((3, 3), 1e-8)
    seen_move = np.zeros((3, 3))
    same = np.flatnonzero(tokens.line[1:] == tokens.line[:-1])
    np.add.at(seen_move, (gold[same], gold[same + 1]), 1)
    target = np.stack([gold == 1, gold == 2], axis=1).astype(float)

    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis)
        return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))

    for _ in range(epochs):
        scores = field.scores(tokens)
        forward = np.zeros((len(gold), 3))
        forward[first] = scores[first]
        forward[first, 2] = _BAN
        for t in range(1, steps):
            at = first[: active[t]] + t
            forward[at] = lse(forward[at - 1][:, :, None] + field.move[None], 1) + scores[at]
        backward = np.zeros((len(gold), 3))
        expected_move = np.zeros((3, 3))
        total = np.zeros(len(gold))
        last = first + length - 1
        whole = lse(forward[last], 1)
        lane_of = np.empty(len(gold), np.int64)
        for t in range(steps - 1, -1, -1):
            n = active[t]
            at = first[:n] + t
            lane_of[at] = np.arange(n)
            more = active[t + 1] if t + 1 < steps else 0
            if more:
                nxt = at[:more] + 1
                path = field.move[None] + (scores[nxt] + backward[nxt])[:, None, :]
                backward[at[:more]] = lse(path, 2)
                expected_move += np.exp(forward[at[:more]][:, :, None] + path - whole[:more, None, None]).sum(axis=0)
        total = np.exp(forward + backward - whole[lane_of][:, None])[:, 1:]
        slope = target - total
        for name, table in field.weights.items():
            ids = tokens.ids[name]
            grad = np.stack([np.bincount(ids, slope[:, k], len(table)) for k in range(2)], axis=1) - decay * len(first) * table
            squares[name] += grad**2
            table += rate * grad / np.sqrt(squares[name])
        grad = np.where(allowed, seen_move - expected_move, 0)
        squares_move += grad**2
        field.move = np.where(allowed, field.move + rate * grad / np.sqrt(squares_move), _BAN)
    return field


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> list[tuple[str, str | None]]:
    """Languages and windows of the texts of at most TRAIN_DOCS documents."""
    language = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    place = F.xxhash64(F.col(id_col))
    # Ids alone are ordered; then only the chosen texts are read to the driver.
    limit = docs.select(place.alias("place")).orderBy("place").limit(TRAIN_DOCS).agg(F.max("place")).first()[0]
    if limit is None:
        return []
    text = F.col(text_col)
    start = F.pmod(F.xxhash64(F.lit("window"), F.col(id_col)), F.greatest(F.char_length(text) - TEXT_CHARS, F.lit(0)) + 1).cast("int") + 1
    own = docs.where((place <= limit) & text.isNotNull()).select(place.alias("place"), F.substr(text, start, F.lit(TEXT_CHARS)).alias("text"), language.alias("lang"))
    return [(r["text"], r["lang"]) for r in own.orderBy("place", "text").limit(TRAIN_DOCS).collect()]


def scan(
    docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang"
) -> DataFrame:
    """``doc_id, spans`` (kind, start, end; in order of start, then kind) for every document.

    Without a ``field`` one is trained on a sample of the documents.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(field or train(sample(docs, id_col, text_col, lang_col)))  # size fixed by TABLES
    language = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), language.alias("lang"))
    span = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for piece in slices(batches, "text"):
            texts = [t or "" for t in piece.column("text").to_pylist()]
            found = [base_spans(t) for t in texts]
            tokens = tokenize(texts, piece.column("lang").to_pylist())
            for i, start, end in field_spans(tokens, viterbi(model, tokens)):
                if not any(a < end and start < b for a, b, _ in found[i]):
                    found[i].append((start, end, "crf"))
            rows = [
                [{"kind": k, "start": a, "end": b} for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))] for spans in found
            ]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(rows, kinds)], names=["doc_id", "spans"])

    return own.mapInArrow(scanned, StructType([own.schema["doc_id"], StructField("spans", ArrayType(span))]))

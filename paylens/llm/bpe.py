"""Byte-level BPE as DuckDB recursive queries inside each Spark partition.

Encoding: every text falls into words by the tokenizer's pattern. The words that a
worker has not met yet go to a recursive query: token-position rows join the merge
table, and each round contracts every word's leftmost pair of least rank, until no pair
of any word is in the table. Decoding: the ids join the vocabulary and an ordered
aggregation puts the bytes together again, without using the words or the text.

Words repeat, so a worker keeps finished words in a table of bounded size; it is a memo
of a pure function and is emptied when full. No step shuffles: memory is bounded by a
piece of a few MB of text (or one text), the memo and DuckDB's own limit.

A null text counts as empty and gives no ids. An empty table gives an empty result.
Repeated rows give one row each. Columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from paylens.llm.common import ship, slices
from paylens.llm.pieces import LONG_PIECE, PieceCoder, all_words

#: Words above this many bytes go to the query that contracts all places of a pair at once.
LONG_WORD = 64
#: Words a worker may remember.
WORD_MEMO = 150_000
#: Symbols in one recursive query.
ROWS = 100_000

_SHORT = """
WITH RECURSIVE step(w, toks) AS (
  SELECT w, list(tok ORDER BY pos) FROM symbols GROUP BY w
  UNION ALL
  SELECT s.w, list_concat(toks[:place - 1], [rank], toks[place + 2:]) FROM step s JOIN (
    SELECT w, min(merges.rank::BIGINT * 1048576 + place) AS least,
           (least % 1048576)::INTEGER AS place, (least // 1048576)::INTEGER AS rank
    FROM (SELECT w, unnest(toks[:-2]) AS l, unnest(toks[2:]) AS r, generate_subscripts(toks[2:], 1) AS place FROM step)
    JOIN merges USING (l, r)
    GROUP BY w) b ON b.w = s.w)
SELECT w, arg_min(toks, len(toks)) AS toks FROM step GROUP BY w
"""

# The places of one pair never overlap but in a run of equal tokens, where every other one counts.
_LONG = """
WITH RECURSIVE step(w, toks, more) USING KEY (w) AS (
  SELECT w, list(tok ORDER BY pos), true FROM symbols GROUP BY w
  UNION
  SELECT w, list(CASE WHEN hit THEN rank ELSE tok END ORDER BY place) FILTER (WHERE eaten IS NOT TRUE), bool_or(hit)
  FROM (SELECT *, lag(hit) OVER (PARTITION BY w ORDER BY place) AS eaten FROM (
    SELECT *, least AND row_number() OVER (PARTITION BY w, least, run ORDER BY place) % 2 = 1 AS hit FROM (
      SELECT *, place - row_number() OVER (PARTITION BY w, least ORDER BY place) AS run FROM (
        SELECT w, place, tok, rank, coalesce(rank = min(rank) OVER (PARTITION BY w), false) AS least
        FROM (SELECT w, place, tok, lead(tok) OVER (PARTITION BY w ORDER BY place) AS follower
              FROM (SELECT w, unnest(toks) AS tok, generate_subscripts(toks, 1) AS place FROM step WHERE more))
        LEFT JOIN merges ON l = tok AND r = follower))))
  GROUP BY w)
SELECT w, toks FROM step
"""

_DECODE = """
SELECT doc, string_agg(s, '' ORDER BY pos) AS content FROM ids JOIN vocabulary USING (id) GROUP BY doc
"""


class Vocabulary:
    """Ranks of byte strings and the pattern that cuts texts into words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def digest(self) -> str:
        rows = "".join(f"{token.hex()} {rank}\n" for token, rank in self.ranks.items())
        return hashlib.sha256((self.pattern + "\n" + rows).encode()).hexdigest()

    def merges(self) -> pa.Table:
        """Every pair of tokens that together is a token, with its rank."""
        rows = [
            (left, right, rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None and (right := self.ranks.get(token[cut:])) is not None
        ]
        return pa.table({c: pa.array(v, pa.int32()) for c, v in zip(("l", "r", "rank"), zip(*rows) if rows else ((), (), ()))})

    def strings(self) -> pa.Table:
        """Tokens as text, one character U+0100 to U+01FF for each byte."""
        return pa.table({
            "id": pa.array(self.ranks.values(), pa.int32()),
            "s": pa.array(["".join(chr(256 + b) for b in t) for t in self.ranks], pa.string()),
        })


class Coder(PieceCoder):
    """Encoder and decoder of one Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        #: Ids of words, of which pieces are made.
        self.spelled: dict[str, bytes] = {}
        self.ranks, self.findall = vocabulary.ranks, regex.compile(vocabulary.pattern).findall
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.sql = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        self.load("merges", vocabulary.merges())
        self.load("vocabulary", vocabulary.strings())

    def load(self, name: str, rows: pa.Table) -> None:
        self.sql.register("given", rows)
        self.sql.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.sql.unregister("given")

    def contract(self, words: list[bytes], query: str) -> list[bytes]:
        """Ids of each word as bytes of 32-bit integers, by one of the recursive queries."""
        sizes = np.array([len(w) for w in words])
        number = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        place = (np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        symbols = pa.table({"w": number, "pos": place, "tok": self.single[np.frombuffer(b"".join(words), np.uint8)]})
        self.sql.register("symbols", symbols)
        found = self.sql.sql(query).to_arrow_table()
        self.sql.unregister("symbols")
        lists = pa.concat_arrays(found.column("toks").chunks)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<i4")
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        out = [b""] * len(words)
        for w, start, end in zip(found.column("w").to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
            out[w] = flat[start:end].tobytes()
        return out

    def spell(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words: whole tokens at once, the others by query."""
        out: dict[str, bytes] = {}
        todo: dict[str, list[str]] = {_SHORT: [], _LONG: []}
        for word in words:
            raw = word.encode()
            if (rank := self.ranks.get(raw)) is not None:
                out[word] = rank.to_bytes(4, "little")
            else:
                todo[_LONG if len(raw) > LONG_WORD else _SHORT].append(word)
        for query, rows in todo.items():
            start = held = 0
            for i in range(len(rows) + 1):
                size = len(rows[i]) if i < len(rows) else ROWS
                if i > start and held + size > ROWS:
                    out.update(zip(rows[start:i], self.contract([w.encode() for w in rows[start:i]], query)))
                    start, held = i, 0
                held += size
        return out

    def words(self, text: str) -> list[str]:
        return self.findall(text)

    def learn(self, first: set[str], rest: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        cut = [{piece: self.findall(lead + piece) for piece in pieces} for lead, pieces in (("", first), (" ", rest))]
        words = all_words(cut[0]) | all_words(cut[1])
        ids = {word: known for word in words if (known := self.spelled.get(word)) is not None}
        ids |= (new := self.spell(words - ids.keys()))
        if len(self.spelled) + len(new) > WORD_MEMO:
            self.spelled.clear()
        self.spelled.update((word, found) for word, found in new.items() if len(word) <= LONG_PIECE)
        heads, tails = ({piece: ids[w[0]] if len(w) == 1 else b"".join([ids[x] for x in w]) for piece, w in found.items()} for found in cut)
        return heads, tails

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """Bytes of each list of ids, by an ordered aggregation."""
        sizes = np.array([len(t) for t in texts], np.int64)
        number = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        ids = np.concatenate([np.zeros(0, "<i4"), *texts]).astype(np.int32)
        self.sql.register("ids", pa.table({"doc": number, "pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
        out = [b""] * len(texts)
        found = self.sql.sql(_DECODE).to_arrow_table()
        self.sql.unregister("ids")
        for doc, content in zip(found.column("doc").to_pylist(), found.column("content").to_pylist()):
            out[doc] = content.encode("utf-16-le")[::2]
        return out


_coders: dict[str, Coder] = {}


def _coder(shared) -> Coder:
    """The worker's coder for a broadcast vocabulary; workers live on between tasks."""
    if shared.id not in _coders:
        _coders.clear()
        _coders[shared.id] = Coder(shared.value)
    return _coders[shared.id]


class _Shared:
    def __init__(self, spark: SparkSession, vocabulary: Vocabulary):
        # Bounded by the tokenizer's own size, not by the data.
        self.handle = spark.sparkContext.broadcast(vocabulary)
        self.id = vocabulary.digest()

    @property
    def value(self) -> Vocabulary:
        return self.handle.value


_SIZE = StructField("n_tokens", LongType())


def _run(docs: DataFrame, id_col: str, value_col: str, fields: list[StructField], vocabulary: Vocabulary, work) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    shared = _Shared(spark, vocabulary)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(value_col).alias("value"))
    schema = StructType([own.schema["doc_id"], *fields])

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        arrow = None
        for part in slices(given, "value", 1 << 20) if work is not _decoded else given:
            columns = work(coder, part.column("value"))
            arrow = arrow or pa.schema([part.schema.field("doc_id"), *[pa.field(n, t) for n, t, _ in columns]])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(v, t) for _, t, v in columns]], schema=arrow)

    return own.mapInArrow(batches, schema)


def _encoded(coder: Coder, texts: pa.Array):
    ids = coder.encode(texts.to_pylist())
    return [("n_tokens", pa.int64(), [len(x) for x in ids]), ("ids", pa.list_(pa.int32()), ids)]


def _decoded(coder: Coder, lists: pa.Array):
    return [("content", pa.binary(), coder.decode([np.array(x or [], np.int32) for x in lists.to_pylist()]))]


def _digests(coder: Coder, texts: pa.Array):
    ids = coder.encode(texts.to_pylist())
    content = coder.decode(ids)
    spelled = [hashlib.sha256(" ".join(map(str, x.tolist())).encode()).hexdigest() for x in ids]
    return [
        ("n_tokens", pa.int64(), [len(x) for x in ids]),
        ("ids_sha256", pa.string(), spelled),
        ("decoded_sha256", pa.string(), [hashlib.sha256(x).hexdigest() for x in content]),
    ]


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids``: the ids of every text."""
    return _run(docs, id_col, text_col, [_SIZE, StructField("ids", ArrayType(IntegerType()))], vocabulary, _encoded)


def decode(encoded: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, content``: the bytes that lists of ids stand for; null counts as no ids."""
    return _run(encoded, id_col, ids_col, [StructField("content", BinaryType())], vocabulary, _decoded)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode its ids, and give digests of both.

    ``doc_id, n_tokens, ids_sha256`` (decimal ids joined by one space) and
    ``decoded_sha256`` (decoded bytes). Both steps run in one pass, so neither ids nor
    bytes leave the worker.
    """
    fields = [_SIZE, StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return _run(docs, id_col, text_col, fields, vocabulary, _digests)

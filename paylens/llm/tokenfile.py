"""Token ids in files of canonical, length-limited Huffman code.

Writing: documents are put in order of their id by a range partitioning and encoded with
the ``tokenizers`` library; ids are counted over all documents; package merge gives code
lengths of bounded size (``length_limit``), from which the canonical code follows. A file row is
an independent block: whole documents, the place of its first id among all ids, the
bits, and the bit offset of every ``STEP``-th id. Reading needs the block and the code
lengths only: the checkpoints let a decoder walk all steps of a block side by side, one
table look-up for each id.

A folder holds ``blocks`` (start, doc_ids, sizes, bits, checkpoints) and ``codebook``
(id, bits). A document of null or empty text has the end id alone. Documents of one id
are ordered by their text; null ids come first. Repeated rows are documents of their
own. Without documents both tables are empty. Other columns are not read.

What reaches the driver is bounded by the vocabulary. Memory of a task is bounded by a
block, or by one document if that is larger.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, LongType, StructField, StructType

from paylens.llm.common import ship, slices
from paylens.llm.pieces import PieceCoder
from paylens.session import scratch_path, written

#: Longest code in bits where so many suffice; the decoder's table has an entry for each pattern of the longest code.
LIMIT = 16
#: What the packing can hold.
MOST_BITS = 25
#: Ids between two checkpoints.
STEP = 256
#: A block ends with the document that brings it to this many ids.
BLOCK = 1 << 18


# Code


def length_limit(used: int) -> int:
    """Bits that codes of so many ids may have: two more than ids of equal length would need, LIMIT at least."""
    limit = max(LIMIT, max(0, used - 1).bit_length() + 2)
    if limit > MOST_BITS:
        raise ValueError(f"{used} ids need codes of more than {MOST_BITS} bits")
    return limit


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package merge; 0 for ids that never occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    row, levels = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        rank = np.argsort(both, kind="stable")
        row = both[rank]
        levels.append(rank < len(leaves))
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        size = lengths[order].astype(np.int64)
        top = int(size[-1])
        # Seen as numbers of ``top`` bits, each code starts where the one before it ends.
        start = np.concatenate([[0], np.cumsum(1 << (top - size))[:-1]])
        codes[order] = start >> (top - size)
    return codes


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """For every pattern of ``limit`` bits the id it begins with, times 256, plus its length."""
    table = np.zeros(1 << limit, np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = lengths[order].astype(np.int64)
    filled = np.repeat((order.astype(np.uint64) << np.uint64(8)) | size.astype(np.uint64), 1 << (limit - size))
    table[: len(filled)] = filled
    return table


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of a block, first bit highest, and the offset of every STEP-th id."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    begin = end - size
    word = begin >> 5
    window = codes[ids].astype(np.uint64) << (64 - (begin & 31) - size).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    # No code is longer than a word, so every word has an id that starts in it.
    words = np.zeros(len(first) + 1, np.uint64)
    words[:-1] += np.add.reduceat(window >> np.uint64(32), first)
    words[1:] += np.add.reduceat(window & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").tobytes()[: (int(end[-1]) + 7) // 8], begin[::STEP].astype(np.int64)


def unpack(bits: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """The ids of a block; all steps advance together."""
    raw = np.frombuffer(bits + bytes(4 * STEP), np.uint8).astype(np.uint32)
    windows = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    at = checkpoints.astype(np.int64)
    out = np.empty((STEP, len(at)), np.uint32)
    shift, mask = 32 - limit, (1 << limit) - 1
    last = len(windows) - 1
    for i in range(STEP):
        window = windows[np.minimum(at >> 3, last)].astype(np.uint64)
        entry = table[(window >> (shift - (at & 7)).astype(np.uint64)) & np.uint64(mask)]
        out[i] = entry >> np.uint64(8)
        at += (entry & np.uint64(255)).astype(np.int64)
    return out.T.reshape(-1)[:n]


# Encoding


class LibraryCoder(PieceCoder):
    """The ``tokenizers`` library over the pieces of texts.

    Only a byte-level pre-tokenizer with its own pattern, and no normaliser, cuts texts
    in the way that pieces need.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        super().__init__()
        parts = json.loads(spec)
        cutter = parts.get("pre_tokenizer") or {}
        if cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True) or parts.get("normalizer"):
            raise ValueError("only byte-level tokenizers without a normaliser are read")
        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True
        self.library.no_padding()
        self.library.no_truncation()
        size = self.library.get_vocab_size()
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.space = cutter_space()
        self.opens = np.zeros(size, bool)
        for token, i in self.library.get_vocab().items():
            self.opens[i] = token.startswith(self.space)
        # A space and letters are one word for the pattern, whose merges the library's model does by itself; so are marks behind them.
        self.tokenize, self.written, self.marks = self.library.model.tokenize, byte_letters(), {}
        added = [t.content.strip() for t in self.library.get_added_tokens_decoder().values()]
        self.direct = not any(re.fullmatch(f"{_LETTERS}|{_MARKS}|", t) for t in added)

    def run(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, text: str) -> list[str]:
        return [text]

    def word(self, lead: str, letters: str) -> bytes:
        """Ids of letters, which are one word, by the model's merges."""
        shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.written)
        return self.pack(*[t.id for t in self.tokenize(lead + shown)])

    def pack(self, *ids: int) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.kind == '<u2' else 'I'}", *ids)

    def marked(self, marks: str) -> bytes:
        """Ids of marks, or of a line break, that stand behind a letter."""
        if marks not in self.marks:
            if len(self.marks) > 50_000:
                self.marks.clear()
            self.marks[marks] = self.pack(*self.run([marks])[0])
        return self.marks[marks]

    def learn(self, first: set[str], rest: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        heads, tails, found = list(first), [], {}
        for piece in rest:
            parts = _PARTS(piece) if self.direct else None
            if parts is None:
                tails.append(piece)
                continue
            word, marks, line, head, more = parts.groups()
            ids = self.word(self.space, word) + (self.marked(marks) if marks else b"")
            found[piece] = ids if line is None else ids + self.marked(line) + self.word("", head) + (self.marked(more) if more else b"")
        for start in range(0, len(tails), 4096):
            block = tails[start : start + 4096]
            # Every piece begins with the block's next space, and only there does a token open with one.
            ids = np.array(self.run([" " + " ".join(block)])[0], self.kind)
            raw, width = ids.tobytes(), ids.itemsize
            at = np.flatnonzero(self.opens[ids]) * width
            found.update((piece, raw[a:b]) for piece, a, b in zip(block, at.tolist(), [*at[1:].tolist(), len(raw)], strict=True))
        return {piece: np.array(ids, self.kind).tobytes() for piece, ids in zip(heads, self.run(heads))}, found


#: Letters about which all versions of Unicode agree, and ASCII marks without the apostrophe, which may begin a word of its own.
_LETTERS, _MARKS = "[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+", r"[!-&(-/:-@\[-`{-~]+"
_PARTS = re.compile(rf"({_LETTERS})({_MARKS})?(?:(\n)({_LETTERS})({_MARKS})?)?").fullmatch


def byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary writes the bytes above ASCII."""
    from tokenizers.pre_tokenizers import ByteLevel

    cutter, written = ByteLevel(add_prefix_space=False, use_regex=False), {}
    for low in range(0x80, 0x800, 64):
        for point in range(low, low + 64):
            raw = chr(point).encode()
            shown = cutter.pre_tokenize_str(chr(point))[0][0]
            written.update(zip(raw, shown))
    return written


def cutter_space() -> str:
    """How a byte-level vocabulary writes a space."""
    from tokenizers.pre_tokenizers import ByteLevel

    return ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(" ")[0][0]


_coders: dict[int, LibraryCoder] = {}


def _coder(spec: str) -> LibraryCoder:
    key = hash(spec)
    if key not in _coders:
        _coders.clear()
        _coders[key] = LibraryCoder(spec)
    return _coders[key]


def token_blocks(docs: DataFrame, spec: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``part, block, doc_ids, sizes, n_tokens, width, ids``: whole documents in order of their id."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(spec)  # bounded by the tokenizer
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    digest = F.xxhash64("text")
    ordered = own.repartitionByRange(F.col("doc_id").asc_nulls_first(), digest).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), digest, "text"
    )
    id_type = own.schema["doc_id"].dataType
    schema = StructType(
        [
            StructField("part", IntegerType()), StructField("block", IntegerType()), StructField("doc_ids", ArrayType(id_type)),
            StructField("sizes", ArrayType(IntegerType())), StructField("n_tokens", LongType()), StructField("width", IntegerType()),
            StructField("ids", BinaryType()),
        ]
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        part, number = TaskContext.get().partitionId(), 0
        end = np.array([end_id], coder.kind)
        docs_of, sizes, held, total, kind = [], [], [], 0, None

        def block() -> pa.RecordBatch:
            ids = np.concatenate([x for pair in held for x in (pair, end)])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([docs_of], pa.list_(kind)),
                    pa.array([sizes], pa.list_(pa.int32())), pa.array([len(ids)], pa.int64()),
                    pa.array([ids.itemsize], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                ],
                names=["part", "block", "doc_ids", "sizes", "n_tokens", "width", "ids"],
            )

        for piece in slices(batches, "text"):
            kind = piece.schema.field("doc_id").type
            for doc_id, ids in zip(piece.column("doc_id").to_pylist(), coder.encode(piece.column("text").to_pylist())):
                docs_of.append(doc_id)
                sizes.append(len(ids) + 1)
                held.append(ids)
                total += sizes[-1]
                if total >= BLOCK:
                    yield block()
                    docs_of, sizes, held, total, number = [], [], [], 0, number + 1
        if held:
            yield block()

    return ordered.mapInArrow(blocks, schema)


def count_ids(blocks: DataFrame) -> DataFrame:
    """``id, n``: how often each id occurs in all blocks."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for width, raw in zip(batch.column("width").to_pylist(), batch.column("ids")):
                found = np.bincount(np.frombuffer(raw.as_buffer(), f"<u{width}"))
                if len(found) > len(total):
                    total = np.pad(total, (0, len(found) - len(total)))
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    ship(blocks.sparkSession)
    return blocks.select("width", "ids").mapInArrow(counts, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def with_starts(blocks: DataFrame) -> DataFrame:
    """Adds ``start``, the number of ids before a block.

    Sums per part come first; the one window over all parts sees one row for each
    partition of the range partitioning.
    """
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        blocks.select("part", "block", "n_tokens").withColumn("within", F.coalesce(within, F.lit(0)))
        .join(parts.select("part", before.alias("before")), "part")
        .select("part", "block", (F.col("before") + F.col("within")).alias("start"))
    )
    # Written, so that Spark knows its size and leaves the blocks where they are while it is small.
    return blocks.join(written(starts, "starts"), ["part", "block"])


def write_tokens(docs: DataFrame, spec: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all texts and write blocks and codebook below ``path``; replaces what is there.

    ``spec`` is the tokenizer's JSON text.
    """
    spark = docs.sparkSession
    ids_path = scratch_path(spark, "ids")
    token_blocks(docs, spec, end_id, id_col, text_col).write.option("compression", "zstd").parquet(ids_path)
    blocks = spark.read.parquet(ids_path)
    found = {r["id"]: r["n"] for r in count_ids(blocks).collect()}  # one row for each id of the vocabulary at most
    counts = np.zeros(max(found, default=-1) + 1, np.int64)
    for i, n in found.items():
        counts[i] = n
    lengths = code_lengths(counts, length_limit(len(found)))
    used = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(used, "id bigint, bits int").coalesce(1).write.mode("overwrite").parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast((lengths, canonical_codes(lengths)))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, codes = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = np.frombuffer(row.column("ids")[0].as_buffer(), f"<u{row.column('width')[0].as_py()}")
                bits, checkpoints = pack(ids, sizes, codes)
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column("start"), row.column("doc_ids"), row.column("sizes"), pa.array([bits], pa.binary()),
                        pa.array([checkpoints], pa.list_(pa.int64())),
                    ],
                    names=["start", "doc_ids", "sizes", "bits", "checkpoints"],
                )

    schema = StructType(
        [
            StructField("start", LongType()), blocks.schema["doc_ids"], blocks.schema["sizes"], StructField("bits", BinaryType()),
            StructField("checkpoints", ArrayType(LongType())),
        ]
    )
    with_starts(blocks).select("start", "doc_ids", "sizes", "width", "ids").mapInArrow(coded, schema).write.mode(
        "overwrite"
    ).option("compression", "none").parquet(f"{path}/blocks")


def _documents(spark: SparkSession, path: str, name: str, kind: DataType, arrow: pa.DataType, work) -> DataFrame:
    ship(spark)
    blocks = spark.read.parquet(f"{path}/blocks")
    book = spark.read.parquet(f"{path}/codebook").collect()  # bounded by the vocabulary
    lengths = np.zeros(max((r["id"] for r in book), default=-1) + 1, np.uint8)
    for r in book:
        lengths[r["id"]] = r["bits"]
    shared = spark.sparkContext.broadcast(lengths)
    id_type = blocks.schema["doc_ids"].dataType.elementType
    schema = StructType(
        [StructField("doc_id", id_type), StructField("start", LongType()), StructField("n_tokens", LongType()), StructField(name, kind)]
    )

    limit = int(max(LIMIT, lengths.max(initial=0)))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(shared.value, limit)
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, sizes = batch.column("doc_ids")[i].values, batch.column("sizes")[i].values.to_numpy().astype(np.int64)
                ids = unpack(batch.column("bits")[i].as_py(), batch.column("checkpoints")[i].values.to_numpy(), int(sizes.sum()), table, limit)
                ends = np.cumsum(sizes)
                starts = ends - sizes + batch.column("start")[i].as_py()
                values = [work(ids[e - s : e]) for s, e in zip(sizes.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(values, arrow)],
                    names=["doc_id", "start", "n_tokens", name],
                )

    return blocks.mapInArrow(decoded, schema)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of a folder; the end id is the last of each document."""
    return _documents(spark, path, "ids", ArrayType(LongType()), pa.list_(pa.int64()), lambda ids: ids.astype(np.int64))


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: checksum of each document's ids as 32-bit little-endian integers."""
    return _documents(spark, path, "ids_crc32", LongType(), pa.int64(), lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))

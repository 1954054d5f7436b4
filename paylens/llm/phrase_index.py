"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` stores the postings of every training token. A row is a shard: whole
documents, their terms, and for each term the sorted list of its places in the shard.
Documents never span shards, so phrases are found shard by shard without a shuffle.

``search`` takes windows of consecutive test words. In each shard a window starts from
the list of its rarest term, moved by the term's offset in the window, and intersects it
with the moved lists of its other terms, rarest first. With ``slop`` 0 what remains are
exact phrases; a larger ``slop`` lets every term stand that many places away from where
the rarest one expects it, which gives proximity matches.

Test items are taken in blocks of ``BLOCK_WORDS`` words, so what is broadcast has a
bound whatever the size of the test set. Memory of a task is bounded by a shard, or by
one document if that is larger.

Null and empty texts have no words. Repeated documents and ids give one row each;
repeated items count once. Items without an id are listed as an empty string. Empty
tables give no rows, or no hits. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from paylens.llm.common import ship, slices
from paylens.session import discard, scratch_path, written

#: Words of a shard; it ends with the document that reaches them.
SHARD_WORDS = 1 << 20
#: Test words searched in one pass over the index.
BLOCK_WORDS = 4 << 20
#: Candidates that are held at once while lists are intersected.
CANDIDATES = 1 << 18
#: Windows that are written out at once.
SLICE = 1 << 16
#: Bytes of a row group of the index, or one shard. A task holds one group while it writes or reads, however many shards it has.
GROUP_BYTES = 16 << 20

# In UTF-8 every character from U+0080 on has bytes above 0x7F only.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text whose A-Z are lower-cased."""
    return _WORD.findall((text or "").encode().lower())


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the index below the shared folder and return it, one row for each shard.

    ``shard, doc_ids, versions`` (hashes of the texts), ``sizes`` (words of each document), ``terms, counts`` (in each term's
    order) and ``places``: the differences between successive places, as 32-bit integers.
    """
    spark = docs.sparkSession
    ship(spark)
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    schema = StructType(
        [
            StructField("shard", LongType()), StructField("doc_ids", ArrayType(own.schema["doc_id"].dataType)),
            StructField("versions", ArrayType(LongType())), StructField("sizes", ArrayType(IntegerType())), StructField("terms", ArrayType(BinaryType())),
            StructField("counts", ArrayType(IntegerType())), StructField("places", BinaryType()),
        ]
    )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        doc_ids, versions, sizes, held, numbers, kind, total = [], [], [], [], Numbers(), None, 0

        def shard() -> pa.RecordBatch:
            terms = np.concatenate([np.zeros(0, np.int32), *held])
            counts = np.bincount(terms, minlength=len(numbers))
            places = np.argsort(terms, kind="stable").astype("<i4")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()), pa.array([doc_ids], pa.list_(kind)), pa.array([versions], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int32())), pa.array([list(numbers)], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int32())),
                    pa.array([np.diff(places, prepend=np.int32(0)).astype("<i4").tobytes()], pa.binary()),
                ],
                names=["shard", "doc_ids", "versions", "sizes", "terms", "counts", "places"],
            )

        for piece in slices(batches, "text"):
            kind = piece.schema.field("doc_id").type
            for doc_id, version, text in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "version", "text"))):
                words = words_of(text)
                held.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                doc_ids.append(doc_id)
                versions.append(version)
                sizes.append(len(words))
                total += len(words)
                if total >= SHARD_WORDS:
                    yield shard()
                    doc_ids, versions, sizes, held, numbers, total, number = [], [], [], [], Numbers(), 0, number + 1
        if doc_ids:
            yield shard()

    path = scratch_path(spark, "postings")
    # Sizes are looked at after every row: a row is a whole shard, and the format's own hundred rows would be held at once.
    sizes = {"parquet.block.size": GROUP_BYTES, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
    own.mapInArrow(shards, schema).write.options(compression="zstd", **sizes).parquet(path)
    return spark.read.parquet(path)


class Windows:
    """A block of test windows: the block's words in a row, where in it each window starts, by length, and the items of each window.

    Windows overlap, so a block takes a few numbers for each of its words; windows are written out a slice at a time.
    """

    def __init__(self, items: list[tuple[str, str | None]], size: int):
        numbers = Numbers()
        names = sorted({item for item, _ in items})
        place = {name: i for i, name in enumerate(names)}
        texts = [np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)) for words in (words_of(text) for _, text in items)]
        sizes = np.array([len(t) for t in texts], np.int64)
        lengths = np.minimum(sizes, size)
        self.terms = pa.array(list(numbers), pa.binary())
        self.items = names
        self.words = np.concatenate([np.zeros(0, np.int32), *texts])
        begins = np.cumsum(sizes) - sizes
        ids = np.array([place[item] for item, _ in items], np.int32)
        self.groups = []
        for length in sorted(set(lengths[lengths > 0].tolist())):
            mine = np.flatnonzero(lengths == length)
            n = sizes[mine] - length + 1
            starts = np.repeat(begins[mine], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            seen = np.lib.stride_tricks.sliding_window_view(self.words, length)[starts]
            _, first, number = np.unique(np.ascontiguousarray(seen).view(f"V{4 * length}").ravel(), return_index=True, return_inverse=True)
            del seen
            pairs = np.unique(number.astype(np.int64) * len(names) + np.repeat(ids[mine], n))
            ends = np.cumsum(np.bincount(pairs // len(names), minlength=len(first)))
            self.groups.append((length, starts[first].astype(np.int32), (pairs % len(names)).astype(np.int32), ends.astype(np.int32)))

    def slices(self, length: int, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The number of a slice's first window, and its windows written out: term numbers by window and offset."""
        for at in range(0, len(starts), SLICE):
            yield at, self.words[starts[at : at + SLICE, None] + np.arange(length)]


def find(matrix: np.ndarray, keys: np.ndarray, counts: np.ndarray, span: int, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows and their starts.

    ``matrix`` holds terms by window and offset, ``keys`` all postings as term * span +
    place in order, ``counts`` the length of each term's list.
    """
    first = np.cumsum(counts) - counts
    lists = counts[matrix]
    order = np.argsort(lists, axis=1, kind="stable")
    rows = np.arange(len(matrix))
    rarest = matrix[rows, order[:, 0]]
    sizes = counts[rarest]
    cut = np.searchsorted(np.cumsum(sizes), np.arange(CANDIDATES, int(sizes.sum()) + CANDIDATES, CANDIDATES))
    for part in np.split(rows, np.unique(cut[cut < len(rows)])):
        n = sizes[part]
        window = np.repeat(part, n)
        nth = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
        start = keys[np.repeat(first[rarest[part]], n) + nth] % span - np.repeat(order[part, 0], n)
        keep = (start >= 0) & (start + matrix.shape[1] <= span)
        window, start = window[keep], start[keep]
        for rank in range(1, matrix.shape[1]):
            offset = order[window, rank]
            wanted = matrix[window, offset] * span + start + offset
            near = np.searchsorted(keys, wanted - slop)
            keep = (near < len(keys)) & (keys[np.minimum(near, len(keys) - 1)] <= wanted + slop)
            window, start = window[keep], start[keep]
        yield window, start


def search(index: DataFrame, items: list[tuple[str, str | None]], size: int = 10, slop: int = 0) -> DataFrame:
    """``shard, ordinal, hits, items`` for the documents where a window of a block of items occurs.

    ``hits`` are the places of words inside any occurrence (with ``slop``, of the words
    from where the window is expected to start), ``items`` the ids of its items.
    """
    spark = index.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(Windows(items, size))  # at most BLOCK_WORDS words or one item

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                sizes = batch.column("sizes")[i].values.to_numpy().astype(np.int64)
                counts = batch.column("counts")[i].values.to_numpy().astype(np.int64)
                places = np.cumsum(np.frombuffer(batch.column("places")[i].as_buffer(), "<i4"), dtype=np.int64)
                ends = np.cumsum(sizes)
                span = int(ends[-1]) + 2 * slop + 1
                keys = np.repeat(np.arange(len(counts)), counts) * span + places
                local = pc.fill_null(pc.index_in(block.terms, value_set=batch.column("terms")[i].values), -1).to_numpy().astype(np.int64)
                hit = np.zeros(len(places), bool)
                pairs = [np.zeros((0, 2), np.int64)]
                for length, starts, owners, owner_ends in block.groups if len(local) else []:
                    for at, windows in block.slices(length, starts):
                        known = np.flatnonzero((local[windows] >= 0).all(axis=1))
                        if not len(known):
                            continue
                        for window, start in find(local[windows[known]], keys, counts, span, slop):
                            doc = np.searchsorted(ends, start, side="right")
                            inside = (start + length <= len(places)) & (doc == np.searchsorted(ends, start + length - 1, side="right"))
                            window, start, doc = at + known[window[inside]], start[inside], doc[inside]
                            for offset in range(length):
                                hit[start + offset] = True
                            once = np.unique(np.stack([doc, window], axis=1), axis=0)
                            n = np.diff(owner_ends, prepend=0)[once[:, 1]]
                            nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                            owner = owners[np.repeat(owner_ends[once[:, 1]] - n, n) + nth]
                            pairs.append(np.unique(np.stack([np.repeat(once[:, 0], n), owner], axis=1), axis=0))
                pair = np.unique(np.concatenate(pairs), axis=0)
                docs, begin = np.unique(pair[:, 0], return_index=True)
                begins = ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(docs), batch.column("shard")[i].as_py()), pa.int64()), pa.array(docs, pa.int32()),
                        pa.array([np.flatnonzero(hit[begins[d] : ends[d]]) for d in docs], pa.list_(pa.int32())),
                        pa.array([[block.items[x] for x in own] for own in np.split(pair[:, 1], begin[1:])][: len(docs)], pa.list_(pa.string())),
                    ],
                    names=["shard", "ordinal", "hits", "items"],
                )

    schema = StructType(
        [
            StructField("shard", LongType()), StructField("ordinal", IntegerType()), StructField("hits", ArrayType(IntegerType())),
            StructField("items", ArrayType(StringType())),
        ]
    )
    return index.select("shard", "sizes", "terms", "counts", "places").mapInArrow(matches, schema)


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[str, str | None]]]:
    """Test items block by block; a block has BLOCK_WORDS words at most, or one item.

    Items are dealt out in ranges and written once. Sums of words run inside a range; the
    sums of whole ranges, one row for each, are added to them.
    """
    own = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).distinct()
    # No text has more words than half its length, rounded up.
    sized = own.withColumn("words", F.floor(F.length("text") / 2).cast("long") + 1)
    ranged = written(sized.repartitionByRange("item", F.xxhash64("text")).withColumn("part", F.spark_partition_id()), "items")
    order = Window.partitionBy("part").orderBy("item", F.xxhash64("text"), "text").rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("part").agg(F.sum("words").alias("own")).select("part", F.coalesce(F.sum("own").over(parts), F.lit(0)).alias("ahead"))
    inside = ranged.withColumn("inside", F.coalesce(F.sum("words").over(order), F.lit(0)))
    numbered = written(inside.join(sums, "part").select("item", "text", F.floor((F.col("inside") + F.col("ahead")) / BLOCK_WORDS).alias("block")), "blocks")
    discard(ranged)
    for row in numbered.select("block").distinct().orderBy("block").toLocalIterator():
        yield [(r["item"], r["text"]) for r in numbered.where(F.col("block") == row["block"]).collect()]


def contamination(
    docs: DataFrame, items: DataFrame, size: int = 10, slop: int = 0, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """``doc_id, version, n_words, n_hit, items, hits`` for every document.

    A document word inside any occurrence of a window of ``size`` consecutive item words
    is hit; an item with fewer words is one window.
    """
    index = build_index(docs, id_col, text_col)
    found = None
    for block in item_blocks(items, item_col):
        part = search(index, block, size, slop)
        found = part if found is None else found.unionByName(part)
    each = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "versions", "sizes")).alias("ordinal", "doc"))
    docs_all = each.select(
        "shard", "ordinal", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.versions").alias("version"),
        F.col("doc.sizes").cast("long").alias("n_words"),
    )
    if found is None:
        hits = docs_all.select("shard", "ordinal", F.lit(None).cast("array<int>").alias("hits"), F.lit(None).cast("array<string>").alias("items")).limit(0)
    else:
        hits = found.groupBy("shard", "ordinal").agg(
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
        )
    none = F.array().cast("array<string>")
    return docs_all.join(hits, ["shard", "ordinal"], "left").select(
        "doc_id", "version", "n_words", F.when(F.col("hits").isNull(), 0).otherwise(F.size("hits")).cast("long").alias("n_hit"),
        F.array_sort(F.coalesce("items", none)).alias("items"),
        F.array_sort(F.coalesce("hits", F.array().cast("array<int>"))).alias("hits"),
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs."""
    found = contamination(docs, items, size, 0, id_col, text_col, item_col).where("n_hit > 0")
    hit = found.select(F.col("doc_id").alias("hit_id"), F.col("version").alias("hit_version"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    same = F.col("doc")[id_col].eqNullSafe(F.col("hit_id")) & (F.xxhash64(F.col("doc")[text_col]) == F.col("hit_version"))
    return whole.join(hit, same, "left_anti").select("doc.*")

"""SimHash near-duplicates by an inverted index over positional bytes.

Two fingerprints with at most four different bits share at least four of their eight
bytes at the same positions. One posting list for each (position, byte) would hold a
256th of all fingerprints, so pairs would grow with the square of the corpus; the lists
here are keyed by three positions and their bytes. The twenty position triples are
chosen so that any four positions contain one of them, hence every pair that shares four
bytes meets in a list. For each pair that meets, the shared positional bytes are tallied,
pairs with the guaranteed minimum are kept, and the bit distance verifies them.

A list of more than ``HOT`` fingerprints (a large group of near copies) is not paired.
All fingerprints of such lists emit every number within half the distance instead: two
of them are within the distance exactly if they emit a common number, and at most 2,081
fingerprints can emit the same one. The work is linear in the group, and no link that
connects two fingerprints is lost.

Copies of a fingerprint are one node, so groups of copies never meet in a list.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paylens.llm.common import ship, slices
from paylens.llm.components import components
from paylens.session import written

#: Largest posting list whose members are paired.
HOT = 200
#: Shingles whose bits are counted at once.
_ROWS = 1 << 15

_BYTES = 8


def fingerprint(text: str | None, width: int, seed: int = 42) -> int:
    """64-bit SimHash over shingles of ``width`` words, repeats included."""
    # Upper case and white space are ASCII only for bytes.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    n = max(1, len(words) - width + 1)
    stops = ends[width - 1 :] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for low in range(0, n, _ROWS):
        hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts[low : min(n, low + _ROWS)], stops[low : low + _ROWS])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, _BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, version, fp`` (signed 64 bits) for every document; null and empty texts have fingerprint 0.

    ``version`` is a hash of the text and tells documents of one id apart.
    """
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            found = np.array([fingerprint(t, width) for t in piece.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("version"), pa.array(found.view(np.int64))], names=["doc_id", "version", "fp"]
            )

    return own.mapInArrow(hashed, StructType([own.schema["doc_id"], own.schema["version"], StructField("fp", LongType())]))


def covering_sets(shared: int, size: int | None = None) -> list[tuple[int, ...]]:
    """Sets of ``size`` positions (one less than ``shared`` if not given) such that any ``shared`` positions contain one.

    Chosen greedily: each time the set that covers most position groups still open.
    """
    size = size or shared - 1
    open_groups = set(combinations(range(_BYTES), shared))
    chosen = []
    while open_groups:
        best = max(combinations(range(_BYTES), size), key=lambda s: sum(set(s) <= set(g) for g in open_groups))
        chosen.append(best)
        open_groups = {g for g in open_groups if not set(best) <= set(g)}
    return chosen


def _key(fp: Column, number: int, positions: tuple[int, ...]) -> Column:
    """A list's number and the bytes it is keyed by, in one integer."""
    key = F.lit(number).cast("bigint")
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)))
    return key


def _tally(a: str, b: str) -> Column:
    """How many bytes two fingerprints share at the same position."""
    differ = F.col(a).bitwiseXOR(F.col(b))
    return sum((F.shiftrightunsigned(differ, 8 * p).bitwiseAND(F.lit(255)) == 0).cast("int") for p in range(_BYTES))


def _ball(radius: int) -> list[int]:
    masks = [sum(1 << bit for bit in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(nodes: DataFrame, distance: int = 4, hot: int = HOT, key_bytes: int | None = None) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column fp).

    All pairs within the distance, but for lists above ``hot``: there as many as keep
    the same fingerprints connected. ``distance`` is 2 or 4. Lists are keyed by
    ``key_bytes`` positional bytes: one less than a pair shares if not given, which suits
    some billion fingerprints (20 lists of 2^24 keys at distance 4). With as many as a pair
    shares, 4, a fingerprint is in 70 lists of 2^32 keys, which stay short for a thousand
    times as many. The links connect the same fingerprints either way.
    """
    if distance not in (2, 4):
        raise ValueError("the index is laid out for 2 or 4 differing bits")
    shared = _BYTES - distance
    if key_bytes is not None and not 1 <= key_bytes <= min(shared, 6):
        raise ValueError("keys take up to six of the bytes that a pair shares")
    keys = F.array(*[_key(F.col("fp"), i, p) for i, p in enumerate(covering_sets(shared, key_bytes))])
    postings = nodes.select("fp", F.explode(keys).alias("key"))
    # Only the crowded lists are written; there are few, as each holds more than ``hot`` fingerprints.
    crowds = written(postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("key"), "crowds")
    cold = postings.join(crowds, "key", "left_anti")
    pairs = (
        cold.select("key", F.col("fp").alias("a")).join(cold.select("key", F.col("fp").alias("b")), "key").where("a < b")
        .where(_tally("a", "b") >= shared).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b")
    )
    crowded = postings.join(crowds, "key", "left_semi").select("fp").distinct()
    masks = F.array(*[F.lit(m) for m in _ball(distance // 2)])
    # Not more than the ball's size of distinct fingerprints can meet at a number.
    meets = (
        crowded.select("fp", F.explode(masks).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("z"))
        .groupBy("z").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    )
    stars = meets.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(
    docs: DataFrame, width: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text", key_bytes: int | None = None
) -> DataFrame:
    """``doc_id, version, fp, root, component_id`` for every document; ``key_bytes`` as in ``links``.

    ``root`` is the same for documents that links connect. ``component_id`` is the
    smallest id reachable, the document's own included; null ids are no names, so it is
    null where only they can be reached. Repeated rows give one row each. Null and empty
    texts have fingerprint zero, linked like any other. An empty table gives no rows.
    """
    prints = written(fingerprints(docs, width, id_col, text_col), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    wide = {} if key_bytes is None else {"key_bytes": key_bytes}
    roots = components(links(nodes.select("fp"), distance, **wide))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(names, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "version", "fp", "root", "component_id"
    )


def keep_one(docs: DataFrame, width: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of ``docs`` with the smallest id of each group; null ids come last, equal ids go by text hash."""
    found = near_duplicates(docs, width, distance, id_col, text_col)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "version")).alias("kept")
    # Plain keys, so that the join and the choice among repeated rows stand on one shuffle of the texts.
    at = F.coalesce(F.col("kept.doc_id").cast("string"), F.lit("")).alias("at")
    kept = found.groupBy("root").agg(least).select(at, F.col("kept.doc_id").isNull().alias("none"), F.col("kept.version").alias("ver"))
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    own_id = F.col("doc")[id_col]
    whole = docs.select(doc).select("doc", F.coalesce(own_id.cast("string"), F.lit("")).alias("at"), own_id.isNull().alias("none"), F.xxhash64(F.col("doc")[text_col]).alias("ver"))
    key = ["at", "none", "ver"]
    rows = whole.join(kept, key, "left_semi")
    # Repeated rows are alike, so any one of them may stand for them.
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("at"))
    return rows.withColumn("nth", nth).where("nth = 1").select("doc.*")

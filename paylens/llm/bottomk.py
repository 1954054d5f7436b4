"""MinHash near-duplicates from bottom-k sketches of one hash function.

A document's set is its distinct word shingles; its sketch holds the ``KEEP`` smallest
64-bit hashes of the set. Documents of one set are one class, so copies never meet.

1. Of a pair with Jaccard 4/5 each of the ``KEEP`` smallest hashes of the union is in
   both sets with probability 4/5, and such a hash is in both sketches. Fewer than half
   of them are shared with probability under 1e-7 (sets no larger than the sketch: never).
   So a match shares half a sketch, and by the prefix principle one of the
   ``KEEP / 2 + 1`` values of a sketch that the fewest classes hold. Only these are
   posted, and values that one class holds need no list. A phrase that a third of the
   corpus shares is posted only where it makes up half a document.
2. Each class first meets the class of each of its lists whose sketch is most widely
   shared (the likely original of a group of copies); of those the one that shares most
   is estimated and verified. That connects most of a group without pairing it.
3. Then members of a list meet all others that are still in another component. A pair
   inside a component can change nothing, any other pair is found: no link is lost. Of
   these pairs the likeliest of each class are verified first, and then those that are
   still in two components.
   In lists of ``CROWD`` classes or more they meet by their full sets instead: by the
   rarest shingles that a match of that size cannot do without, and only with at least
   one end outside the list's largest component. Far copies of a large group share
   their group's shingles, but too few of them, so they meet nobody.
4. Estimation: the ``KEEP`` smallest values of both sketches together are the union's
   sketch; the share of them that both hold estimates the similarity. Pairs under a half
   fall out (same bound as above).
5. What is left is verified on the full shingle sets, as bytes, not hashes.

Null, empty and blank texts have no shingles: size 0, a component of their own. Null ids
are no names: a component's name is the smallest id reachable, null if there is none.
Texts that share an id are documents of their own. Repeated rows give one row each. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from paylens.llm.common import ship, slices
from paylens.llm.components import components
from paylens.session import written

#: Values of a sketch.
KEEP = 64
#: Similarity as a fraction.
TOP, BOTTOM = 4, 5
#: Classes of a list from which on its members meet by their full sets.
CROWD = 16
#: Numbers of 64 bits in a parity map.
MAP = 16


def shingles(text: str | None, width: int) -> list[bytes]:
    """Runs of ``width`` words joined by a space, repeats included; fewer words are one run."""
    # Upper case and white space are ASCII only for bytes.
    words = (text or "").encode().lower().split()
    if not words:
        return []
    if len(words) <= width:
        return [b" ".join(words)]
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    return [line[a:b] for a, b in zip(starts, ends[width - 1 :].tolist())]


def hashes(text: str | None, width: int) -> np.ndarray:
    """Distinct shingle hashes, smallest first."""
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, 42) for s in shingles(text, width)], np.uint64).view(np.int64))


def parity_map(values: np.ndarray) -> np.ndarray:
    """Parities of the numbers of hashes that fall to each bit of a map."""
    odd = np.bincount(values.view(np.uint64) % np.uint64(64 * MAP), minlength=64 * MAP).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _alike(x: str, y: str) -> Column:
    """Parity filter: ``map`` and ``n`` of two classes, by the prefixes of their columns."""
    apart = sum((F.bit_count(F.col(f"{x}map")[i].bitwiseXOR(F.col(f"{y}map")[i])) for i in range(MAP)), F.lit(0))
    return apart * (TOP + BOTTOM) <= (F.col(f"{x}n") + F.col(f"{y}n")) * (BOTTOM - TOP)


def _key(id_col: str, text_col: str) -> list[Column]:
    """``at, version``: where a document is found again; null ids and texts are values like any other."""
    doc_id, text = F.col(id_col), F.col(text_col)
    return [F.coalesce(doc_id.cast("string"), F.lit("")).alias("at"), F.xxhash64(doc_id.isNull(), text).alias("version")]


def sketches(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, at, version, n, s1, s2, sketch`` for every document; s1 and s2 identify the set."""
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("doc_id"), *_key(id_col, text_col), F.col(text_col).alias("text"))
    held = [own.schema[c] for c in ("doc_id", "at", "version")]
    new = [StructField("n", LongType()), StructField("s1", LongType()), StructField("s2", LongType()), StructField("sketch", ArrayType(LongType()))]

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            sizes, digests, values = [], [], []
            for text in piece.column("text").to_pylist():
                found = hashes(text, width)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                values.append(found[:KEEP])
            pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.array(np.concatenate(values) if values else [], pa.int64())
            )
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(f.name) for f in held), pa.array(sizes, pa.int64()), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), lists],
                names=[f.name for f in held + new],
            )

    return own.mapInArrow(sketched, StructType(held + new))


def set_classes(prints: DataFrame) -> DataFrame:
    """One row for each set: ``id, s1, s2, n, sketch`` and where its first document is; ids are fixed by the file."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "at", "version")).alias("first")
    found = prints.where("n > 0").groupBy("s1", "s2").agg(first, F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    return written(
        found.select("s1", "s2", "first.at", "first.version", "n", "sketch").withColumn("id", F.monotonically_increasing_id()), "classes"
    )


def postings(classes: DataFrame) -> DataFrame:
    """``value, id, n, spread``: the values that a class is looked up by, the rarest of its sketch.

    ``spread`` is how many classes hold its values, in sum.
    """
    held = classes.select("id", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    counts = held.groupBy("value").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    rare = F.sort_array(F.collect_list(F.struct("classes", "value")))
    mine = held.join(counts, "value").groupBy("id", "n", "size").agg(rare.alias("shared"), F.sum("classes").alias("spread"))
    # Values that no other class holds are the rarest and come first in the prefix; they need no posting.
    posted = F.floor(F.col("size") / 2).cast("int") + 1 - (F.col("size") - F.size("shared"))
    chosen = mine.where(posted > 0).select("id", "n", "spread", F.slice("shared", 1, posted).alias("shared"))
    return chosen.select(F.explode("shared.value").alias("value"), "id", "n", "spread")


def _sized(a: str, b: str) -> Column:
    return F.least(a, b) * BOTTOM >= F.greatest(a, b) * TOP


def _first_met(posted: DataFrame) -> DataFrame:
    """``x, y``: for each class y the most widely shared class of a list of its own, of these the one that shares most lists."""
    widest = F.max_by(F.struct("id", "n"), F.struct("spread", -F.col("id"))).alias("widest")
    met = posted.join(posted.groupBy("value").agg(widest), "value").select(F.col("widest.id").alias("x"), F.col("widest.n").alias("xn"), F.col("id").alias("y"), "n")
    tally = met.where(F.col("x") != F.col("y")).where(_sized("xn", "n")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("shared"))
    return tally.groupBy("y").agg(F.max_by("x", F.struct("shared", -F.col("x"))).alias("x")).select("x", "y")


def _mixed(rooted: DataFrame, key: str) -> DataFrame:
    """``key, members, most``: lists (key, root) with more than one component, and the component that has most members."""
    sizes = rooted.groupBy(key, "root").agg(F.count(F.lit(1)).alias("n"))
    lists = sizes.groupBy(key).agg(F.sum("n").alias("members"), F.count(F.lit(1)).alias("roots"), F.max_by("root", F.struct("n", -F.col("root"))).alias("most"))
    return lists.where("roots > 1").select(key, "members", "most")


def _outside_pairs(members: DataFrame, key: str, fits: Callable[[str, str], Column]) -> DataFrame:
    """``x, y``: members (key, id, n, root, most) of one list and two components, for which ``fits`` holds.

    One end at least is outside the list's largest component, so a list with one large
    component is never compared with itself.
    """
    names = [c for c in members.columns if c not in (key, "most")]
    left = members.where(F.col("root") != F.col("most")).select(key, "most", *[F.col(c).alias(f"x_{c}") for c in names])
    right = members.select(key, *[F.col(c).alias(f"y_{c}") for c in names])
    apart = (F.col("y_root") == F.col("most")) | (F.col("x_root") < F.col("y_root"))
    return left.join(right, key).where((F.col("x_root") != F.col("y_root")) & apart & fits("x_", "y_")).select(
        F.col("x_id").alias("x"), F.col("y_id").alias("y")
    ).distinct()


def _rarest(sets: DataFrame) -> DataFrame:
    """``shingle, id, n, root, most_n``: shingles of which a match of a class must share one.

    ``sets`` has the full ``hashes``. They are ordered by the number of sets that hold
    them; a match of ``m`` shingles shares 4/9 of ``n + m``, so one at place i or later can
    only be the first shared one if n - i are enough: for ``m`` up to ``most_n``.
    """
    held = sets.select("id", "n", "root", F.explode("hashes").alias("shingle"))
    counts = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    shared = F.sort_array(F.collect_list(F.struct("sets", "shingle"))).alias("shared")
    mine = held.join(counts, "shingle").groupBy("id", "n", "root").agg(shared).withColumn("alone", F.col("n") - F.size("shared"))
    kept = (F.floor(F.col("n") * (BOTTOM - TOP) / BOTTOM) + 1 - F.col("alone")).cast("int")
    first = mine.where(kept > 0).select("id", "n", "root", "alone", F.posexplode(F.slice("shared.shingle", 1, kept)).alias("i", "shingle"))
    total = TOP + BOTTOM
    most = F.floor((total * (F.col("n") - F.col("alone") - F.col("i")) - TOP * F.col("n")) / TOP)
    return first.select("shingle", "id", "n", "root", most.alias("most_n"))


def _across(docs: DataFrame, classes: DataFrame, posted: DataFrame, roots: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``x, y``: classes that share a list and are not in one component."""
    rooted = posted.join(roots, posted.id == roots.node, "left").select("value", "id", "n", F.coalesce("root", "id").alias("root"))
    lists = written(rooted.join(_mixed(rooted, "value"), "value"), "lists")
    few = _outside_pairs(lists.where(F.col("members") < CROWD).drop("members"), "value", lambda x, y: _sized(f"{x}n", f"{y}n"))
    crowd = lists.where(F.col("members") >= CROWD).select("id", "n", "root").distinct()
    texts = texts_of(docs, classes, crowd.select("id"), id_col, text_col)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            found = [hashes(t, width) for t in piece.column("text").to_pylist()]
            maps = pa.array([parity_map(h) for h in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(found, pa.list_(pa.int64())), maps], names=["id", "hashes", "map"])

    sets = written(crowd.join(texts.select("id", "text").mapInArrow(hashed, "id bigint, hashes array<bigint>, map array<bigint>"), "id"), "crowd")
    rarest = written(_rarest(sets), "rarest")
    found = rarest.join(_mixed(rarest, "shingle").drop("members"), "shingle").join(sets.select("id", "map"), "id")
    many = _outside_pairs(
        found, "shingle",
        lambda x, y: _sized(f"{x}n", f"{y}n") & (F.col(f"{x}n") <= F.col(f"{y}most_n")) & (F.col(f"{y}n") <= F.col(f"{x}most_n")) & _alike(x, y),
    )
    return few.unionByName(many).distinct()


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``x, y, share``: pairs of which half the union's sketch, or more, is in both sketches."""
    held = classes.select("id", "sketch")
    both = pairs.join(held.select(F.col("id").alias("x"), F.col("sketch").alias("a")), "x").join(
        held.select(F.col("id").alias("y"), F.col("sketch").alias("b")), "y"
    )
    union = F.slice(F.array_sort(F.array_union("a", "b")), 1, KEEP)
    shared = F.size(F.array_intersect(F.array_intersect(F.col("a"), F.col("b")), union))
    return both.where(2 * shared >= F.size(union)).select("x", "y", (shared / F.size(union)).alias("share"))


def similar(a: set[bytes], b: set[bytes]) -> bool:
    shared = len(a & b)
    return BOTTOM * shared >= TOP * (len(a) + len(b) - shared)


def texts_of(docs: DataFrame, classes: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text`` of the first document of each class in ``ids``; only these texts are moved."""
    wanted = ids.distinct().join(classes.select("id", "at", "version"), "id")
    own = docs.select(*_key(id_col, text_col), F.col(text_col).alias("text"))
    # Repeated rows are one text.
    return own.join(wanted, ["at", "version"]).groupBy("at", "version", "id").agg(F.first("text").alias("text")).select("id", "text")


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (x, y) whose full sets are similar."""
    pairs = written(pairs.select("x", "y"), "pairs")
    texts = written(texts_of(docs, classes, pairs.select(F.explode(F.array("x", "y")).alias("id")), id_col, text_col), "texts")
    both = pairs.join(texts.select(F.col("id").alias("y"), F.col("text").alias("b")), "y").join(
        texts.select(F.col("id").alias("x"), F.col("text").alias("a")), "x"
    ).select("x", "y", "a", "b")

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, left = None, set()
        for piece in slices(batches, "b"):
            keep = []
            for x, a, b in zip(piece.column("x").to_pylist(), piece.column("a"), piece.column("b").to_pylist()):
                if x != of:  # rows come in order of x
                    of, left = x, set(shingles(a.as_py(), width))
                keep.append(similar(left, set(shingles(b, width))))
            yield piece.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return written(both.mapInArrow(checked, "x bigint, y bigint"), "verified")


def _likeliest(pairs: DataFrame) -> DataFrame:
    """``x, y``: for each class of the pairs the one that it shares most of its sketch with."""
    ends = pairs.select(F.col("x").alias("node"), F.col("y").alias("other"), "share").unionByName(
        pairs.select(F.col("y").alias("node"), F.col("x").alias("other"), "share")
    )
    best = ends.groupBy("node").agg(F.max_by("other", F.struct("share", -F.col("other"))).alias("other"))
    return best.select(F.least("node", "other").alias("x"), F.greatest("node", "other").alias("y")).distinct()


def _with_roots(links: DataFrame, roots: DataFrame) -> DataFrame:
    """``x, y, xr, yr``: links and the components that they join."""
    for side in ("x", "y"):
        links = links.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}r")), side, "left")
    return links.select("x", "y", F.coalesce("xr", "x").alias("xr"), F.coalesce("yr", "y").alias("yr"))


def _merged(classes: DataFrame, roots: DataFrame, links: DataFrame) -> DataFrame:
    """``node, root`` of the classes that are not their own root, after ``links`` join whole components."""
    joined = components(_with_roots(links, roots).select(F.col("xr").alias("a"), F.col("yr").alias("b")))
    tops = joined.select(F.col("node").alias("root"), F.col("root").alias("top"))
    known = classes.select(F.col("id").alias("node")).join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    found = known.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return written(found.where("node <> root"), "roots")


def near_duplicates(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, version, n_shingles, component_id, kept`` for every document.

    ``component_id`` is the smallest id that links reach, the document's own included;
    ``kept`` is true where that is the document's own.
    """
    prints = written(sketches(docs, width, id_col, text_col), "sketches")
    classes = set_classes(prints)
    posted = written(postings(classes), "postings")
    first = verified(docs, classes, estimated(_first_met(posted), classes), width, id_col, text_col)
    roots = written(components(first.select(F.col("x").alias("a"), F.col("y").alias("b"))), "roots")
    pairs = written(estimated(_across(docs, classes, posted, roots, width, id_col, text_col), classes), "across")
    # The likeliest pairs go first; pairs that are in one component after them can change nothing.
    roots = _merged(classes, roots, verified(docs, classes, _likeliest(pairs), width, id_col, text_col))
    left = _with_roots(pairs, roots).where("xr <> yr")
    roots = _merged(classes, roots, verified(docs, classes, left, width, id_col, text_col))
    rooted = classes.join(roots, F.col("id") == F.col("node"), "left").select("s1", "s2", F.coalesce("root", "id").alias("root"))
    least = prints.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("least")).join(rooted, ["s1", "s2"])
    names = written(least.groupBy("root").agg(F.min("least").alias("component_id")).join(rooted, "root").select("s1", "s2", "component_id"), "names")
    own = ["doc_id", "version", F.col("n").alias("n_shingles")]
    some = prints.where("n > 0").join(names, ["s1", "s2"]).select(*own, "component_id")
    none = prints.where("n = 0").select(*own, F.col("doc_id").alias("component_id"))
    return some.unionByName(none).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))

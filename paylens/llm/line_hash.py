"""Substring dedup by hashing lines or sentences.

A unit is a line, or a sentence of a line (up to the blanks behind a full stop, question
or exclamation mark). A unit of at least ``least_words`` words, or of at least
``least_chars`` code points for scripts that write no blanks between words, is normalised
(A-Z in lower case, one space between words) and digested to 128 bits. Digests are grouped over
the whole corpus; the occurrence with the least rank (document id, text digest, offset)
stays and all others are removed, within a document as well as between documents. Kept
and removed units are given with their offsets in the original text, in code points.

With ``least_passage`` a unit counts only inside a passage: a run of units, one behind the
other, that all occur elsewhere too, with at least that many words in all (or eight times
as many code points). Ranks are then those among occurrences in passages. So a copied
passage is found wherever it begins in a line, and short sentences that any prose repeats
stay. Units without words lie between others without parting them.

Only digests and offsets are grouped, and the rows of a digest are summed before the
shuffle, so a line that half of the corpus shares is one row for each task. Its
occurrences then meet the one kept row in a join that adaptive execution splits.

Null texts have no units and stay null. Null ids rank last. Repeated rows (same id and
text) are one document: they keep the same units and give one row each. An empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from paylens.llm.common import ship, slices
from paylens.session import written

#: Words of a unit from which on it may be removed unless the caller says otherwise; shorter ones repeat in any prose.
MIN_WORDS = 5
#: Code points that count as a word where words are not parted by blanks.
WORD_CHARS = 8

_BLANK = " \t\n\x0b\f\r"
_BREAK = re.compile(r"(?<=[.!?。！？])[ \t\x0b\x0c\r]+|\n")


def unit_spans(text: str, by: str = "lines") -> Iterator[tuple[int, int, int]]:
    """``start, end, next``: every unit and where the one behind it starts."""
    start = 0
    if by == "lines":
        for line in text.split("\n"):
            end = start + len(line)
            yield start, end, min(end + 1, len(text))
            start = end + 1
        return
    for part in _BREAK.finditer(text):
        yield start, part.start(), part.end()
        start = part.end()
    yield start, len(text), len(text)


def unit_rows(text: str, least_words: int = MIN_WORDS, least_chars: int | None = None, by: str = "lines") -> Iterator[tuple[int, int, bytes | None]]:
    """``start, end, digest`` of every unit; no digest for units without words or too short by both measures."""
    return (row[:3] for row in sized_rows(text, least_words, least_chars, by))


def sized_rows(text: str, least_words: int, least_chars: int | None, by: str) -> Iterator[tuple[int, int, bytes | None, int]]:
    """``start, end, digest, size`` of every unit; the size is in words."""
    for start, end, _ in unit_spans(text, by):
        unit = text[start:end]
        words = unit.encode().lower().split()
        chars = len(unit.strip(_BLANK))
        enough = len(words) >= least_words or (least_chars is not None and chars >= least_chars)
        size = max(len(words), sum(len(w.decode()) for w in words) // WORD_CHARS) if words else 0
        yield start, end, xxhash.xxh128_digest(b" ".join(words)) if words and enough else None, size


def units(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = MIN_WORDS, least_chars: int | None = None, by: str = "lines"
) -> DataFrame:
    """``doc_id, version, place, start, size, high, low`` of every unit that may be removed.

    ``version`` tells texts of one id apart; ``place`` counts these units of a text; high and low are the digest.
    """
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("version"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            where, places, starts, sizes, digests = [], [], [], [], []
            for i, text in enumerate(piece.column("text").to_pylist()):
                place = 0
                for start, _, digest, size in sized_rows(text or "", least_words, least_chars, by):
                    if digest is not None:
                        where.append(i)
                        places.append(place)
                        starts.append(start)
                        sizes.append(size)
                        digests.append(digest)
                        place += 1
            take = pa.array(where, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id").take(take), piece.column("version").take(take), pa.array(places, pa.int32()), pa.array(starts, pa.int32()),
                    pa.array(sizes, pa.int32()), pa.array([int.from_bytes(d[:8], "big", signed=True) for d in digests], pa.int64()),
                    pa.array([int.from_bytes(d[8:], "big", signed=True) for d in digests], pa.int64()),
                ],
                names=["doc_id", "version", "place", "start", "size", "high", "low"],
            )

    schema = StructType([own.schema["doc_id"], StructField("version", LongType())])
    for name in ("place", "start", "size"):
        schema = schema.add(StructField(name, IntegerType()))
    return own.mapInArrow(rows, schema.add(StructField("high", LongType())).add(StructField("low", LongType())))


def shared_units(found: DataFrame) -> DataFrame:
    """The units whose digest has occurrences at two places or more; repeated rows of a document are one."""
    # Two numbers tell whether all occurrences are the same one.
    at = F.xxhash64("doc_id", F.col("doc_id").isNull(), "version", "start")
    # Written, so that the join below stands on shuffles alone and its hot digests can be split.
    several = written(found.groupBy("high", "low").agg(F.min(at).alias("a"), F.max(at).alias("b")).where("a < b").select("high", "low"), "several")
    return found.join(several, ["high", "low"])


def in_passages(shared: DataFrame, least_passage: int) -> DataFrame:
    """Shared units in runs of at least ``least_passage`` words; a run is in one text, so no task holds more than a text's units."""
    once = shared.groupBy("doc_id", "version", "place").agg(*[F.first(c).alias(c) for c in ("start", "size", "high", "low")])
    text = Window.partitionBy("doc_id", "version")
    numbered = once.withColumn("run", F.col("place") - F.row_number().over(text.orderBy("place")))
    run = Window.partitionBy("doc_id", "version", "run")
    return numbered.withColumn("words", F.sum("size").over(run)).where(F.col("words") >= least_passage).drop("run", "words")


def repeated_units(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = MIN_WORDS, least_chars: int | None = None, by: str = "lines",
    least_passage: int = 0,
) -> DataFrame:
    """``doc_id, version, repeated, repeats``: how many units occur elsewhere too, and the starts of those to remove, each with the document that keeps the unit."""
    found = written(units(docs, id_col, text_col, least_words, least_chars, by), "units")
    shared = shared_units(found)
    counted = written(in_passages(shared, least_passage) if least_passage else shared, "shared")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "version", "start")
    groups = written(counted.groupBy("high", "low").agg(F.min(rank).alias("keeper")), "keepers")
    later = F.when(~rank.eqNullSafe(F.col("keeper")), F.struct("start", F.col("keeper.doc_id").alias("kept_in")))
    marked = counted.join(groups, ["high", "low"]).select("doc_id", "version", "start", later.alias("mark"))
    # In passages a unit of repeated rows is counted once already.
    known, marks = (F.count(F.lit(1)), F.collect_list("mark")) if least_passage else (F.count_distinct("start"), F.collect_set("mark"))
    return marked.groupBy("doc_id", "version").agg(known.cast("int").alias("repeated"), marks.alias("repeats"))


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = MIN_WORDS, least_chars: int | None = None, by: str = "lines",
    least_passage: int = 0, with_kept: bool = True,
) -> DataFrame:
    """``doc_id, text, n_units, kept, removed, repeated`` for every document; ``with_kept=False`` leaves ``kept`` empty.

    ``text`` is what remains: lines joined by line breaks, sentences with the blanks
    behind them. ``kept`` (start, end) and ``removed`` (start, end, kept_in) are the units
    by their original offsets, ``n_units`` those with words; ``repeated`` counts the units that occur elsewhere too,
    removed here or kept here as the first.
    """
    repeats = repeated_units(docs, id_col, text_col, least_words, least_chars, by, least_passage)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("version"))
    r = repeats.select(F.col("doc_id").alias("r_id"), F.col("version").alias("r_version"), "repeated", "repeats")
    joined = own.join(r, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("version") == F.col("r_version")), "left")
    id_type = own.schema["doc_id"].dataType
    kept = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
    gone = StructType([*kept.fields, StructField("kept_in", id_type)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            kind = piece.schema.field("doc_id").type
            span = [("start", pa.int32()), ("end", pa.int32())]
            texts, counts, stay, leave = [], [], [], []
            for text, repeats in zip(piece.column("text").to_pylist(), piece.column("repeats").to_pylist()):
                later = {r["start"]: r["kept_in"] for r in repeats or ()}
                rows = [] if text is None else list(unit_spans(text, by))
                left = [r for r in rows if r[0] not in later]
                stay.append([{"start": a, "end": b} for a, b, _ in left] if with_kept else [])
                leave.append([{"start": a, "end": b, "kept_in": later[a]} for a, b, _ in rows if a in later])
                counts.append(sum(1 for a, b, _ in rows if text[a:b].strip(_BLANK)))
                if not later:
                    texts.append(text)
                elif by == "lines":
                    texts.append("\n".join(text[a:b] for a, b, _ in left))
                else:
                    texts.append("".join(text[a:c] for a, _, c in left))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(stay, pa.list_(pa.struct(span))),
                    pa.array(leave, pa.list_(pa.struct([*span, ("kept_in", kind)]))), piece.column("repeated").fill_null(0),
                ],
                names=["doc_id", "text", "n_units", "kept", "removed", "repeated"],
            )

    schema = StructType([own.schema["doc_id"], StructField("text", StringType()), StructField("n_units", LongType()), StructField("kept", ArrayType(kept))])
    return joined.select("doc_id", "text", "repeated", "repeats").mapInArrow(cut, schema.add(StructField("removed", ArrayType(gone))).add(StructField("repeated", IntegerType())))

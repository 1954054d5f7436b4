"""Spelling variants by sorted permuterm rotations.

A word's rotations are those of the word with a terminator behind it. Its rotation that
ends in a certain letter, without that letter, is a prefix that says everything about the
word but the letter: words of one length with the same prefix differ by a replacement
there, and the word with that letter deleted has the whole prefix as a rotation of its
own. So all near words of a word lie in ranges of sorted rotations that start with such a
prefix and are at most one letter longer.

Rotations are sorted over all tasks by these prefixes; a range holds each letter at
most once beside the word without it, so its size is bounded by the alphabet and no word
can make a group grow. A deletion inside a run of equal letters gives the same word at
each place; only the run's first letter counts, so every near pair is found once.

Words are counted in Arrow batches before any shuffle. Null and empty texts have no
words; a null id is written as an empty string. Repeated rows count as often as they
occur. Ties between forms go to the smaller word in code-point order. Empty tables give
no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import ship, slices
from paylens.session import written

#: Stands behind a word; no letter of a word is below it.
END = "$"
#: Distinct words a task counts before it passes the counts on.
HELD = 1 << 18

#: In Latin-1 a code point of a word is a byte; all other characters become question marks.
_RUN = re.compile(rb"[A-Za-z\xC0-\xFF]+")


def words_of(doc_id: object, text: str | None, drop: int) -> Counter:
    """Words of a text as Latin-1 bytes with their counts, after the deletion of letters.

    If ``drop`` divides h, the unsigned CRC-32 of ``<id>:<word>``, the word loses the letter
    at h modulo its length. ``drop=0`` deletes nothing.
    """
    found = Counter(_RUN.findall((text or "").encode("latin-1", "replace").lower()))
    if not drop:
        return found
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    moved = Counter()
    for word, n in found.items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % drop == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        moved[word] += n
    return moved


def count_words(
    docs: DataFrame, least_length: int = 7, least_count: int = 2, drop: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``word, n`` of all words of at least that length and count."""
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return batch

        for piece in slices(batches, "text"):
            for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                for word, n in words_of(doc_id, text, drop).items():
                    if len(word) >= least_length:
                        held[word] += n
            if len(held) >= HELD:
                yield passed_on()
        yield passed_on()

    return own.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, whole, counts, word, n``: each rotation as it is (whole) and without its last letter.

    ``counts`` is false where a deletion of that letter repeats one of the letter before.
    """
    marked = F.concat("word", F.lit(END))
    length = F.char_length("word")

    def turned(i: Column) -> Column:
        """From letter i (from 0) to the terminator, then the letters before i."""
        return F.concat(F.substr(marked, i + 1), F.substr(marked, F.lit(1), i))

    def skipping(i: Column) -> Column:
        """The rotation that ends in letter i, without it."""
        return F.concat(F.substr(marked, i + 2), F.substr(marked, F.lit(1), i))

    def letter(i: Column) -> Column:
        return F.substr(F.col("word"), i + 1, F.lit(1))

    whole = F.transform(F.sequence(F.lit(0), length), lambda i: F.struct(turned(i).alias("prefix"), F.lit(True).alias("whole"), F.lit(True).alias("counts")))
    skipped = F.transform(
        F.sequence(F.lit(0), length - 1),
        lambda i: F.struct(skipping(i).alias("prefix"), F.lit(False).alias("whole"), ((i == 0) | (letter(i) != letter(i - 1))).alias("counts")),
    )
    return words.where(length > 0).select(F.inline(F.concat(whole, skipped)), "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: every pair of words (word, n) one inserted, deleted or replaced letter apart, both ways."""
    ranged = rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix")
    member = F.struct("whole", "counts", "word", "n")
    groups = ranged.groupBy("prefix").agg(F.collect_list(member).alias("members")).where(F.size("members") > 1)
    pairs = groups.select(F.explode("members").alias("x"), "members").select("x", F.explode("members").alias("y"))
    replaced = ~F.col("x.whole") & ~F.col("y.whole") & (F.col("x.word") != F.col("y.word"))
    changed = (F.col("x.whole") != F.col("y.whole")) & F.col("x.counts") & F.col("y.counts")
    return pairs.where(replaced | changed).select(F.col("x.word").alias("word"), F.col("y.word").alias("near"), F.col("y.n").alias("near_n"))


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for words (word, n).

    A word's form is its near word of the largest count, if that is at least ``times`` its
    own. Forms lead to ever larger counts, so a chain has at most as many steps as the
    largest count has powers of ``times``; following doubles the steps each round.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent as its variants")
    words = written(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    near = neighbours(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    formed = F.when(-F.col("best.rank") >= times * F.col("n"), F.col("best.near"))
    judged = written(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), formed.alias("form"), F.when(formed.isNotNull(), -F.col("best.rank")).alias("form_n")
        ),
        "judged",
    )
    most, steps = judged.agg(F.max("n")).first()[0] or 1, 1
    while times**steps < most:
        steps += 1
    roots = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    reach = 1
    while reach < steps:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = written(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        reach *= 2
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""URL filter by a cascade of Bloom filters.

Listed keys are rules (a host and the start of a path, with a verdict) and blocked hosts.
The corpus's key universe is every key that could be listed for any of its urls. Level 0
of the cascade encodes the listed keys; level 1 the keys of the universe that pass level
0 without being listed; level 2 the listed keys that pass level 1, and so on, until no
key passes wrongly. A key of the universe is listed exactly if the first level that it
does not pass is odd, so urls are judged without a join, and without a wrong verdict.

Level 0 is sized by the ratio of universe to list, so that about as many keys pass it
wrongly as are listed; later levels halve. The cascade therefore grows with the list and
the logarithm of the corpus: some bits for each listed key. Only these bits reach the
driver. Keys stay in tables: their places are hashed where they lie, the bits of a word
are united before the shuffle, and the keys that pass a level are written for the next.
A list may be given as rules or as a table of any length.

A rule fits its host and all subdomains, where the url's path starts with the rule's;
of several the longest (host and path) wins, then the one with the longer host. A null
url, or one without ``://``, has an empty host and path, which only the method judges.
Where no rule fits, urls of blocked hosts are blocked and others allowed. Repeated rows
give one row each, an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paylens.llm.common import ship
from paylens.session import discard, written

#: Hosts that are blocked with their subdomains where no rule fits: sites of ill repute.
BLOCKED_HOSTS = tuple(
    f"{name}.example.{end}" for name in ("adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for end in ("com", "net", "org")
)

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end].translate(_LOWER), rest[end:]
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return host, rest[:end]


class Shapes:
    """Which keys of a url can be listed: by kind, number of host labels, and length of the path's start."""

    def __init__(self, rules, hosts):
        self.rules, self.hosts = sorted(rules), sorted(hosts)

    def keys(self, host: str, path: str) -> Iterator[tuple[str, str, str]]:
        """``kind, host, path`` of each key."""
        labels = host.split(".") if host else []
        for verdict, n, length in self.rules:
            if n <= len(labels) and length <= len(path):
                yield verdict, ".".join(labels[-n:]), path[:length]
        for n in self.hosts:
            if n <= len(labels):
                yield "host", ".".join(labels[-n:]), ""


def key_bytes(key: tuple[str, str, str]) -> bytes:
    return "\x00".join(key).encode()


class Level:
    """One Bloom filter, with its number as the seed; ``field`` holds its bits, eight in a byte."""

    def __init__(self, number: int, keys: Iterable[bytes], rate: float, n: int | None = None, field: np.ndarray | None = None):
        keys = list(keys)
        n = len(keys) if n is None else n
        self.number, self.hashes = number, max(1, round(-math.log2(rate)))
        self.bits = max(64, math.ceil(n * self.hashes / math.log(2)))
        if field is None:
            field = np.zeros(-(-self.bits // 8), np.uint8)
            for place in (p for key in keys for p in self.places(key)):
                field[place >> 3] |= 1 << (place & 7)
        self.field = field.tobytes()

    def places(self, key: bytes) -> list[int]:
        one, two = xxhash.xxh64_intdigest(key, 2 * self.number), xxhash.xxh64_intdigest(key, 2 * self.number + 1) | 1
        return [(one + i * two) % self.bits for i in range(self.hashes)]

    def passes(self, key: bytes) -> bool:
        return all(self.field[p >> 3] >> (p & 7) & 1 for p in self.places(key))


def spark_level(number: int, keys: DataFrame, rate: float, n: int) -> Level:
    """A level of the ``n`` distinct keys of a table (key)."""
    shape = Level(number, (), rate, n, np.zeros(0, np.uint8))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([p for key in batch.column("key").to_pylist() for p in shape.places(key)], np.int64)
            bits = pa.array((np.uint64(1) << (found & 31).astype(np.uint64)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(found >> 5), bits], names=["word", "bit"])

    words = keys.mapInArrow(places, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    field = np.zeros(-(-shape.bits // 32), "<u4")
    field[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return Level(number, (), rate, n, field.view(np.uint8))


def passing(keys: DataFrame, level: Level) -> DataFrame:
    """The keys that pass a level."""
    shared = keys.sparkSession.sparkContext.broadcast(level)  # some bits for each listed key

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([shared.value.passes(k) for k in batch.column("key").to_pylist()], pa.bool_()))

    return keys.select("key").mapInArrow(kept, "key binary")


def listed(levels: list[Level], key: bytes) -> bool:
    """Whether a key of the universe is listed: it is if the level that stops it is odd."""
    for level in levels:
        if not level.passes(key):
            return level.number % 2 == 1
    return len(levels) % 2 == 1


def listed_keys(spark: SparkSession, rules, hosts) -> DataFrame:
    """``kind, host, path, labels, length`` of a list: sequences of rules and hosts, or tables (verdict, host, path) and (host)."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
    if not isinstance(hosts, DataFrame):
        hosts = spark.createDataFrame([(h,) for h in hosts], "host string")
    both = rules.select(F.col("verdict").alias("kind"), "host", "path").unionByName(hosts.select(F.lit("host").alias("kind"), "host", F.lit("").alias("path")))
    whole = both.where("kind IS NOT NULL AND host IS NOT NULL AND path IS NOT NULL").distinct()
    return whole.withColumns({"labels": F.size(F.split("host", r"\.")), "length": F.char_length("path")})


def _wrong(pages: DataFrame, shapes: Shapes, level: Level, names: DataFrame, url_col: str) -> DataFrame:
    """Unlisted keys of the universe that pass level 0."""
    shared = pages.sparkSession.sparkContext.broadcast((shapes, level))  # shapes of the list, and some bits for each of its keys

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, level = shared.value
        for batch in batches:
            keys = {key_bytes(k) for url in set(batch.column("url").to_pylist()) for k in shapes.keys(*split_url(url))}
            yield pa.RecordBatch.from_arrays([pa.array([k for k in sorted(keys) if level.passes(k)], pa.binary())], names=["key"])

    rows = pages.select(F.col(url_col).alias("url")).mapInArrow(found, "key binary").distinct()
    return rows.join(names, "key", "left_anti")


def universe_size(pages: DataFrame, shapes: Shapes, url_col: str) -> int:
    """About how many keys the urls have; only the size of level 0 depends on it."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {xxhash.xxh64_intdigest(key_bytes(k)) for url in set(batch.column("url").to_pylist()) for k in shapes.keys(*split_url(url))}
            yield pa.RecordBatch.from_arrays([pa.array(np.array(sorted(found), np.uint64).view(np.int64))], names=["h"])

    return pages.select(F.col(url_col).alias("url")).mapInArrow(hashes, "h bigint").agg(F.approx_count_distinct("h")).first()[0]


def build_cascade(pages: DataFrame, rules=RULES, hosts=BLOCKED_HOSTS, url_col: str = "url") -> tuple[Shapes, list[Level]]:
    """Levels that are exact for every key of the urls of ``pages``."""
    spark = pages.sparkSession
    ship(spark)
    whole = written(listed_keys(spark, rules, hosts), "listed")
    kinds = whole.select("kind", "labels", "length").distinct().collect()  # a row for each shape of a key
    shapes = Shapes({tuple(r) for r in kinds if r["kind"] != "host"}, {r["labels"] for r in kinds if r["kind"] == "host"})
    zero = F.unhex(F.lit("00"))
    names = written(whole.select(F.concat(*[x for c in ("kind", "host", "path") for x in (F.col(c).cast("binary"), zero)][:-1]).alias("key")), "names")
    n = names.count()
    if not n:
        return shapes, []
    others = max(1, universe_size(pages, shapes, url_col))
    levels = [spark_level(0, names, min(0.5, n / (math.sqrt(2) * others)), n)]
    # From here on both sides are about as large as the list.
    inside, outside = names, written(_wrong(pages, shapes, levels[0], names, url_col), "outside")
    while left := outside.count():
        levels.append(spark_level(len(levels), outside, 0.5, left))
        inside, outside = outside, written(passing(inside, levels[-1]), "outside")
    discard(whole)
    return shapes, levels


def judge(
    pages: DataFrame, rules=RULES, hosts=BLOCKED_HOSTS, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page; the list is given as in ``listed_keys``."""
    shapes, levels = build_cascade(pages, rules, hosts, url_col)
    shared = pages.sparkSession.sparkContext.broadcast((shapes, levels))  # some bits for each listed key
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, levels = shared.value
        for batch in batches:
            rows = []
            for url in batch.column("url").to_pylist():
                host, path = split_url(url)
                fits = [k for k in shapes.keys(host, path) if listed(levels, key_bytes(k))]
                rule = max((k for k in fits if k[0] != "host"), key=lambda k: (len(k[1]) + len(k[2]), len(k[1]), k[0]), default=None)
                blocked = any(k[0] == "host" for k in fits)
                rows.append((host, path, rule[1] + rule[2] if rule else None, rule[0] if rule else "block" if blocked else "allow"))
            columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *columns], names=["page_id", "host", "path", "rule", "verdict"])

    fields = [StructField(n, StringType()) for n in ("host", "path", "rule", "verdict")]
    return own.mapInArrow(judged, StructType([own.schema["page_id"], *fields]))

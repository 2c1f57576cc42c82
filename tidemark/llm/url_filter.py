"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A listed rule is a host and a path; it fits its host and all subdomains if the URL's path starts with the rule's path. Each URL yields
the few keys that could be listed (a host suffix joined with a path prefix as long as some listed path). Keys that the Bloom filter
rules out go no further; the others meet the list in an exact join, which removes the filter's false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One block holds four 64-bit words and each key sets one bit in each, with this many bits of filter for a key.
WORDS, BITS_PER_KEY = 4, 16
#: Broadcast bounds: filter blocks (40 bytes each) and rules (about 100 bytes each). Above them the joins with filter and rules shuffle.
MAX_BLOCKS, MAX_RULES, SALTS = 250_000, 100_000, 8


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path (then up to ``?``, ``#`` or the end)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _bits(key: Column) -> list[Column]:
    h = F.xxhash64(key, F.lit("bit"))
    return [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as a table: block number and its words, OR-ed together from all keys."""
    marks = keys.select(_block(F.col(key), blocks).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(_bits(F.col(key)))])
    return marks.groupBy("block").agg(*[F.bit_or(F.expr(f"shiftleft(1L, b{i})")).alias(f"w{i}") for i in range(WORDS)])


def possible(asked: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``asked(row, key)`` whose key the filter does not rule out. A filter of at most ``MAX_BLOCKS`` blocks is broadcast; a
    larger one meets the keys by block, of which a key that many rows ask for is dealt to ``SALTS`` copies."""
    asked = asked.withColumn("block", _block(F.col("key"), blocks)).withColumns({f"b{i}": b for i, b in enumerate(_bits(F.col("key")))})
    if blocks <= MAX_BLOCKS:
        met = asked.join(F.broadcast(bloom), "block")
    else:
        copies = bloom.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
        met = asked.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(copies, ["block", "salt"])
    return met.where(" and ".join(f"(shiftrightunsigned(w{i}, b{i}) & 1) = 1" for i in range(WORDS))).select("row", "key")


def filter_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """Judge each row of ``pages`` by the longest fitting rule of ``rules(host, path, action)``.

    Rule hosts are lower-case; rule paths are empty or begin with ``/``. A tie in length goes to the longer host. Returns one row for
    each input row: ``page_id, host, path, rule, verdict``. Null URLs, empty ones and those without ``://`` have an empty host and path,
    fit no rule and get ``default``; repeated rows are each judged; other columns of ``pages`` are ignored, whatever their names; an
    empty ``pages`` gives no rows and empty ``rules`` give ``default`` everywhere. Rules with a null host, path or action are ignored.
    """
    rules = rules.where("host is not null and path is not null and action is not null").select(
        F.concat("host", "path").alias("key"), F.length("host").alias("host_len"), F.length("path").alias("path_len"), "action"
    ).groupBy("key", "host_len", "path_len").agg(F.min("action").alias("action"))
    lengths = sorted(r[0] for r in rules.select("path_len").distinct().collect())  # no more than the longest path has characters
    n = rules.count()
    blocks = max(1, -(-n * BITS_PER_KEY // (64 * WORDS)))

    host, path = url_parts(F.col(url))
    rows = settle(pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row")))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.expr("path").substr(F.lit(1), n)
    )
    keys = F.when(F.col("host") != "", F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))))
    hits = possible(rows.select("row", F.explode(keys).alias("key")), bloom_filter(rules, "key", blocks), blocks)
    fits = hits.join(small(rules, MAX_RULES), "key").withColumn("fit", F.struct(F.length("key").alias("len"), "host_len", F.col("key").alias("rule"), "action"))
    best = fits.groupBy("row").agg(F.max("fit").alias("best"))
    judged = rows.join(best, "row", "left")
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))

"""Judge URLs by rules on host and path, and otherwise by a list of canonical URLs.

Method: a Bloom filter whose keys set their bits inside one 64-bit block each. Pages that hit all bits of
their block go to an exact hash join with the list, which removes false positives; all others never
shuffle. Everything is DataFrame functions.

The filter has at most ``MAX_BLOCKS`` rows, so broadcasting it is bounded; a list too long for that only
makes more pages pass to the exact join. Null URLs and those without ``://`` have an empty host and path
and are never listed. Repeated rows and repeated list entries are judged alike and never multiplied. An
empty list blocks nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii

MAX_BLOCKS = 1 << 18
KEYS_PER_BLOCK = 4  # sixteen bits for each key
BITS = 4


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules that pages are judged by.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without www. or m., and path without slashes at its end; null if there is no host."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.when(bare != "", F.concat(bare, F.rtrim(path, F.lit("/"))))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def by_rules(host: Column, path: Column, rules: Sequence[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null."""
    longest = sorted(rules, key=lambda r: (-len(r.text), r.text))
    return F.coalesce(*(F.when(fits(r, host, path), F.lit(value(r))) for r in longest), F.lit(None).cast("string"))


def _mask(key: Column) -> Column:
    """The bits that a key sets in its block, six bits of its hash for each."""
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        place = F.shiftrightunsigned(key, 24 + 6 * i).bitwiseAND(F.lit(63))
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int")))
    return mask


def _block(key: Column, blocks: int) -> Column:
    return key.bitwiseAND(F.lit(blocks - 1))


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """block and word, for distinct keys in ``entry``."""
    key = F.xxhash64("entry")
    return listed.groupBy(_block(key, blocks).alias("block")).agg(F.bit_or(_mask(key)).alias("word"))


def blocks_for(count: int) -> int:
    blocks = 1
    while blocks * KEYS_PER_BLOCK < count and blocks < MAX_BLOCKS:
        blocks *= 2
    return blocks


def judge(pages: DataFrame, listed_urls: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, listed and verdict of each page; ``listed_urls`` has a column url."""
    entries = (
        listed_urls.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .select(canonical(F.col("host"), F.col("path")).alias("entry"))
        .where("entry is not null")
        .distinct()
    )
    blocks = blocks_for(entries.count())
    key = F.xxhash64("entry")
    probed = (
        pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .withColumn("entry", canonical(F.col("host"), F.col("path")))
        .withColumn("block", _block(key, blocks))
        .withColumn("mask", _mask(key))
        .join(F.broadcast(bloom(entries, blocks)), "block", "left")  # MAX_BLOCKS rows at most
        .withColumn(
            "possible",
            F.coalesce(F.col("entry").isNotNull() & (F.col("word").bitwiseAND(F.col("mask")) == F.col("mask")), F.lit(False)),
        )
        .select("page_id", "host", "path", "entry", "possible")
    )
    sure = entries.withColumn("listed", F.lit(True)).hint("shuffle_hash")
    hits = probed.where("possible").join(sure, "entry", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    others = probed.where("not possible").withColumn("listed", F.lit(False))
    columns = ["page_id", "host", "path", "listed"]
    every = hits.select(columns).unionByName(others.select(columns))
    host, path = F.col("host"), F.col("path")
    return every.select(
        *columns[:3],
        by_rules(host, path, rules, lambda r: r.text).alias("rule"),
        "listed",
        F.coalesce(
            by_rules(host, path, rules, lambda r: r.verdict),
            F.when(F.col("listed"), "block").otherwise("allow"),
        ).alias("verdict"),
    )

"""URL filters: listed canonical URLs and rules by host and path.

The listed URLs become a blocked Bloom filter: a table of blocks of eight 32-bit words, in
which each URL sets one bit of each word of its block.  Its number of blocks follows the
number of listed URLs.  Pages look up their block (by a broadcast where the filter's size,
known from its number of blocks, allows it, else by a join on the block), and only those
with all eight bits set, the possible hits, go on to an exact join with the list, which
removes false positives.  Everything is DataFrame expressions.

Canonical: without scheme, fragment, ``www.`` and default port, host lower-cased, tracking
parameters dropped, the others sorted, no slash at the end.

Defined results: a null url, or one without ``://``, has empty host and path and no
canonical form, so it is neither listed nor fits a rule; rules fit literally, so a path
must begin with the rule's; of several fitting rules the longest text wins, of equally
long ones the first given.  Repeated rows each get their verdict; extra columns are kept
where their names aren't those of the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.llm.common import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"
WORDS = 8
#: Bits of the filter for each listed URL: 16 give about one false positive in a thousand.
BITS_PER_URL = 16
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Canonical form; null where there is none."""
    rest = _after_scheme(F.coalesce(url, F.lit("")))
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~lower_ascii(p).rlike(TRACKING)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                                       .otherwise("")))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One bit for each word, from five bits each of a second hash."""
    h = F.xxhash64(F.lit("bits"), key)
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, 5 * i).bitwiseAND(F.lit(31)).cast("int"))
            for i in range(WORDS)]


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """Table of the filter's blocks that have bits: ``block, w0 .. w7``."""
    bits = _bits(F.col(key))
    return (listed.select(_block(F.col(key), blocks).alias("block"), *[b.alias(f"_b{i}") for i, b in enumerate(bits)])
            .groupBy("block").agg(*[F.bit_or(f"_b{i}").alias(f"w{i}") for i in range(WORDS)]))


def listed_among(rows: DataFrame, key: str, listed: DataFrame, bits_per_url: int = BITS_PER_URL) -> DataFrame:
    """The distinct values of ``rows[key]`` that are among ``listed`` (one column, ``key``)."""
    keys = stage(listed.select(key).where(F.col(key).isNotNull()).distinct(), "listed-urls")
    blocks = max(1, -(-keys.count() * bits_per_url // (WORDS * 32)))
    bloom = bloom_filter(keys, key, blocks)
    if blocks * (WORDS + 1) * 8 <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    tested = rows.select(key).where(F.col(key).isNotNull()).withColumn("block", _block(F.col(key), blocks))
    hit = None
    for i, b in enumerate(_bits(F.col(key))):
        one = F.col(f"w{i}").bitwiseAND(b) != 0
        hit = one if hit is None else hit & one
    possible = tested.join(bloom, "block").where(hit).select(key).distinct()
    return possible.join(keys, key, "left_semi")


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (null without one)."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].text), i))
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i in reversed(order):
        r = rules[i]
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """All pages with ``host, path, rule, canonical, listed, verdict``.  ``listed`` has one
    column ``url``; a listed page is blocked unless a rule says otherwise."""
    own = ("host", "path", "rule", "canonical", "listed", "verdict")
    rows = pages.select(*[c for c in pages.columns if c not in own], canonical(F.col(url)).alias("canonical"))
    hits = listed_among(rows, "canonical", listed.select(canonical(F.col("url")).alias("canonical")))
    rows = rows.join(hits.withColumn("listed", F.lit(True)), "canonical", "left")
    rows = rows.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)),
                             "listed": F.coalesce("listed", F.lit(False))})
    text, verdict = best_rule(F.col("host"), F.col("path"), rules)
    return rows.withColumn("rule", text).withColumn(
        "verdict", F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")))

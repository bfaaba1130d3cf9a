"""URL rules behind a blocked Bloom filter, all in DataFrame operations.

Every address gives the keys it could be listed under: its host and each parent domain, with
the start of its path at every length that a listed path has. A blocked Bloom filter of the
listed keys passes possible hits; an equi-join on the keys removes the false ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import UPPER, small, stored

BLOCKS = 1 << 16
PROBES = 4


def ascii_lower_host(host: Column) -> Column:
    return F.translate(host, UPPER, UPPER.lower())


def url_host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower_host(after), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domains(host: Column) -> Column:
    """The host and all its parent domains; an empty host has none."""
    labels = F.split(host, r"\.", -1)
    tails = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    return F.when(host != "", tails).otherwise(F.array().cast("array<string>"))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), key), F.lit(blocks)).cast("int")


def probe_mask(key: Column, probes: int) -> Column:
    """The bits of one key inside its 64-bit block."""
    bits = F.xxhash64(F.lit(4), key)
    mask = F.lit(0).cast("long")
    for i in range(probes):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(bits, 6 * i), F.lit(64)).cast("int")))
    return mask


def bloom_filter(keys: DataFrame, blocks: int = BLOCKS, probes: int = PROBES) -> DataFrame:
    """A blocked Bloom filter of the column ``key``: rows ``block, bits`` of the used blocks.

    At most ``blocks`` rows of 12 bytes, whatever the number of keys, so it can be broadcast.
    """
    return keys.groupBy(block_of(F.col("key"), blocks).alias("block")).agg(F.bit_or(probe_mask(F.col("key"), probes)).alias("bits"))


def rule_keys(rules: DataFrame) -> DataFrame:
    """Rules as keys: one row per (host, path), with block winning over allow."""
    return (
        rules.where("host IS NOT NULL AND path IS NOT NULL AND host <> '' AND action IN ('allow', 'block')")
        .select(ascii_lower_host(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "action")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("action").alias("action"))
        .select(F.concat("rule_host", "rule_path").alias("key"), "rule_host", "rule_path", "action")
    )


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", blocks: int = BLOCKS, probes: int = PROBES, default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``action`` (``allow`` or ``block``). A rule fits its
    host and all subdomains where the path starts with the rule's path. The longest fitting
    rule (code points of host and path; of equal ones the longer host) gives the verdict; an
    address that no rule lists gets ``default``. Of two rules that are the same but for the
    action, block wins. Rules with a null host, path or action, an empty host or another
    action are ignored.

    A null url, or one without ``://``, has an empty host and path, and so no rule. Repeated
    rows are judged each; columns of the input that carry an output's name are replaced.
    Empty tables give empty tables, or no rules.
    """
    keys = stored(rule_keys(rules), "url-rules")
    lengths = [r[0] for r in keys.select(F.char_length("rule_path")).distinct().orderBy(F.char_length("rule_path")).collect()]
    bloom = stored(bloom_filter(keys, blocks, probes), "url-bloom")
    parsed = pages.select(*[c for c in pages.columns if c not in ("host", "path", "rule", "verdict")])
    parsed = parsed.withColumn("host", url_host(F.col(url))).withColumn("path", url_path(F.col(url)))
    if not lengths:
        return parsed.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    # Rules see a path only up to the longest listed one, so that much of it is the address.
    sight = F.substring("path", 1, max(lengths))
    addresses = parsed.where("host <> ''").select(F.col("host").alias("_host"), sight.alias("_path")).distinct()
    starts = F.array(*[F.lit(n) for n in lengths])
    candidates = (
        addresses.withColumn("domain", F.explode(domains(F.col("_host"))))
        .withColumn("n", F.explode(F.filter(starts, lambda n: n <= F.char_length("_path"))))
        .select("_host", "_path", "domain", F.substring(F.col("_path"), F.lit(1), F.col("n")).alias("start"))
        .withColumn("key", F.concat("domain", "start"))
        .withColumn("block", block_of(F.col("key"), blocks))
    )
    mask = probe_mask(F.col("key"), probes)
    possible = candidates.join(F.broadcast(bloom), "block").where(F.col("bits").bitwiseAND(mask) == mask)
    hits = possible.join(small(keys), "key").where((F.col("domain") == F.col("rule_host")) & (F.col("start") == F.col("rule_path")))
    best = hits.groupBy("_host", "_path").agg(
        F.max_by(F.struct("key", "action"), F.struct(F.char_length("key"), F.char_length("rule_host"))).alias("best")
    )
    judged = parsed.join(best, (parsed["host"] == F.col("_host")) & (sight == F.col("_path")), "left")
    return judged.select(
        *[parsed[c] for c in parsed.columns],
        F.col("best.key").alias("rule"),
        F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict"),
    )

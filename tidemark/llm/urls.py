"""URL filters: allow and block rules by host and path, then a list of canonical URLs behind a Bloom filter.

The filter is blocked: a URL's hash names one block of 256 bits and one bit in each of its four
words, so a probe is one lookup. It has at most a fixed number of blocks and may therefore be
broadcast whatever the length of the list. Only possible hits reach the exact join with the list,
which removes the false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules of the registered query: what they do, and host/path.
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)
#: Host labels whose pages make up the list of the registered query.
LISTED_LABELS = ("ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x")
#: Bits for each listed URL, and the most blocks (of 256 bits) of a filter: 16 MB with their keys.
BITS_PER_URL, MOST_BLOCKS = 12, 1 << 18
WORDS = 4

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, in lower case; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty if there is no host."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(host_: Column, path_: Column) -> Column:
    """One form for the addresses of a page: no www., m. or usual port, no .html and no slashes at the end."""
    short = F.regexp_replace(F.regexp_replace(host_, r"^(?:www|m)\.", ""), r":(?:80|443)$", "")
    return F.concat(short, F.regexp_replace(F.regexp_replace(path_, "/{2,}", "/"), r"(?:\.html)?/?$", ""))


def matched_rule(host_: Column, path_: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule that fits a host or one above it and the path's beginning, as (action, rule); else null."""
    found = F.lit(None)
    for action, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith("/" + rest if "/" in rule else "")
        found = F.when(fits, F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks)).alias("block")


def _bits(url: Column) -> list[Column]:
    """For each word of a block, the bit that a URL sets in it."""
    spread = F.xxhash64(F.lit("bits"), url)
    places = [F.shiftright(spread, 6 * w).bitwiseAND(F.lit(63)).cast("int") for w in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]


def bloom_filter(listed: DataFrame, column: str = "url") -> tuple[DataFrame, int]:
    """A table of (block, w0 .. w3) that holds every URL of ``listed``, and its number of blocks."""
    n = listed.count()
    blocks = max(1, min(MOST_BLOCKS, n * BITS_PER_URL // (64 * WORDS)))
    marked = listed.select(_block(F.col(column), blocks), *[b.alias(f"w{w}") for w, b in enumerate(_bits(F.col(column)))])
    return marked.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)]), blocks


def possible_hits(urls: DataFrame, listed: DataFrame, column: str = "url") -> DataFrame:
    """``urls`` with a column ``possible``: false only for URLs that are certainly not in ``listed``."""
    bloom, blocks = bloom_filter(listed, column)
    probe = urls.withColumn("block", _block(F.col(column), blocks))
    probe = probe.join(F.broadcast(bloom), "block", "left")
    sets = [F.col(f"w{w}").bitwiseAND(bit) == bit for w, bit in enumerate(_bits(F.col(column)))]
    every = sets[0] & sets[1] & sets[2] & sets[3]
    return probe.withColumn("possible", F.coalesce(every, F.lit(False))).drop("block", *[f"w{w}" for w in range(WORDS)])


def listed_urls(pages: DataFrame, url: str = "url", labels: tuple[str, ...] = LISTED_LABELS) -> DataFrame:
    """(url): the canonical URLs of the pages whose host has one of ``labels``, each once."""
    address = pages.select(host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    on_list = F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, labels)))
    return address.where(on_list).select(canonical(F.col("host"), F.col("path")).alias("url")).distinct()


def judge_urls(
    pages: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow or block), and listed.

    The longest fitting rule decides (``rule``; null if none fits); without one, a page whose canonical URL is in
    ``listed`` (url) is blocked and any other allowed. A null URL, or one without ://, has an empty host and
    path and is allowed. Rows that repeat an id or a URL each get a row; nulls and repeats in the list
    do no harm; an empty list blocks nothing. Other columns are not read. ``listed`` is null where a
    rule decided.
    """
    address = pages.select(
        F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path")
    )
    judged = address.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules))
    result = ["page_id", "host", "path"]
    by_rule = judged.where("_rule is not null").select(
        *result, "_rule.rule", F.col("_rule.action").alias("verdict"), F.lit(None).cast("boolean").alias("listed")
    )
    exact = listed.select("url").where("url is not null").distinct()
    open_ = judged.where("_rule is null").select(*result, canonical(F.col("host"), F.col("path")).alias("url"))
    probed = possible_hits(open_, exact)
    certain = probed.where("not possible").select(*result, F.lit(False).alias("listed"))
    hits = probed.where("possible").join(exact.withColumn("listed", F.lit(True)), "url", "left")
    hits = hits.select(*result, F.coalesce("listed", F.lit(False)).alias("listed"))
    verdict = F.when(F.col("listed"), "block").otherwise("allow")
    by_list = certain.unionByName(hits).select(
        *result, F.lit(None).cast("string").alias("rule"), verdict.alias("verdict"), "listed"
    )
    return by_rule.unionByName(by_list)

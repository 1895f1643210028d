"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join of the possible hits.

A list entry is a canonical URL (host without case, path, no scheme, query or fragment). A page is looked up under
its own canonical URL and under each pair of a host suffix (whole labels) and a path prefix of a listed length, so
one filter serves both single pages and rules for a domain or a path.

Defined results: a null url, or one without `://`, has an empty host and path and fits nothing; repeated pages get
a row each; an empty list allows everything; further columns of the pages are kept if their names do not clash with
host, path, rule, verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import ascii_lower

ALLOW, BLOCK = "allow", "block"
WORDS = 8
MAX_BLOCKS = 1 << 18


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or without `://`."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = ascii_lower(F.coalesce(F.regexp_extract(url, parts, 1), F.lit("")))
    return host, F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


def _filter_keys(key: Column, blocks: int) -> list[Column]:
    """The block of a key, and the bit it sets in each of the block's words."""
    place, bits = F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2))
    masks = [F.expr(f"shiftleft(1L, cast(shiftright(bits_, {6 * i}) & 63 as int))") for i in range(WORDS)]
    return [F.pmod(place, F.lit(blocks)).alias("block_"), bits.alias("bits_"), *masks]


def _with_masks(df: DataFrame, key: str, blocks: int, prefix: str) -> DataFrame:
    block, bits, *masks = _filter_keys(F.col(key), blocks)
    return df.withColumns({"block_": block, "bits_": bits}).withColumns({f"{prefix}{i}": m for i, m in enumerate(masks)}).drop("bits_")


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter: at most `blocks` rows of eight 64-bit words, each the OR of the bits of the block's keys."""
    if not 0 < blocks <= MAX_BLOCKS:
        raise ValueError(f"blocks must be 1 to {MAX_BLOCKS}")
    masked = _with_masks(keys.select(key), key, blocks, "m")
    return masked.groupBy("block_").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])


def possible_hits(rows: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows whose key the filter may hold: none missed, few too many.

    The filter has at most `blocks` rows of 72 bytes (18 MB at MAX_BLOCKS), whatever the length of the list: it is broadcast.
    """
    masked = _with_masks(rows, key, blocks, "m").join(F.broadcast(bloom), "block_")
    held = [F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}") for i in range(WORDS)]
    every = held[0]
    for one in held[1:]:
        every = every & one
    return masked.filter(every).select(*rows.columns)


def judge_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url", blocks: int = 1 << 14) -> DataFrame:
    """`pages` with host, path, rule and verdict.

    rules: (host, path, verdict); a rule fits its host and all subdomains if the path starts with its path; the
    longest wins, ties by longer host. listed: (host, path) of blocked pages, which hold only where no rule fits.
    """
    entries = (
        rules.select(F.concat("host", "path").alias("entry"), F.length("host").alias("host_size"), F.length("path").alias("path_size"), "verdict")
        .dropDuplicates(["entry"])
        .withColumns({"key": F.concat(F.lit("r:"), "entry"), "size": F.length("entry")})
        .unionByName(
            listed.select(F.concat("host", "path").alias("entry"))
            .distinct()
            .withColumns({"host_size": F.lit(0), "path_size": F.lit(0), "verdict": F.lit(BLOCK), "key": F.concat(F.lit("p:"), "entry"), "size": F.lit(-1)})
        )
    )
    #: The distinct lengths of rule paths: a few numbers, however long the list.
    sizes = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    host, path = url_parts(F.col(url))
    located = pages.withColumns({"host": host, "path": path})
    named = located.filter(f"{url} is not null and (host != '' or path != '')").select(F.col(url).alias("url_"), "host", "path")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sizes]
    prefixes = F.array_compact(F.array(*fitting)) if sizes else F.array().cast("array<string>")
    under = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(F.lit("r:"), s, p))))
    looked_up = named.select("url_", F.explode(F.array_append(under, F.concat(F.lit("p:"), "host", "path"))).alias("key"))
    hits = possible_hits(looked_up, "key", bloom_blocks(entries, "key", blocks), blocks)
    best = (
        hits.join(entries, "key")
        .groupBy("url_")
        .agg(F.max(F.struct("size", "host_size", "entry", "verdict")).alias("best_"))
    )
    judged = located.join(best, F.col(url) == F.col("url_"), "left")
    return judged.withColumns(
        {
            "rule": F.when(F.col("best_.size") >= 0, F.col("best_.entry")),
            "verdict": F.coalesce("best_.verdict", F.lit(ALLOW)),
        }
    ).drop("url_", "best_")


#: The rules of the registered query as (host, path, verdict).
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)


def repeated_addresses(pages: DataFrame, url: str = "url") -> DataFrame:
    """Canonical URLs (host, path) that more than one page row has: what a crawler fetched again under another query."""
    host, path = url_parts(F.col(url))
    found = pages.select(host.alias("host"), path.alias("path")).filter("host != ''")
    return found.groupBy("host", "path").count().filter("count > 1").select("host", "path")

"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every document has a place u in its source's keyed random permutation, and the leading bits of u are its block. A
source's target is met by whole passes over its permutation and one part pass, up to a threshold on u that a radix
search finds in a few small aggregations. Behind a document that does not fit the search goes on with smaller ones.
The drawn blocks are the quotas that the tree splits: at each node the left half of the shards gets a
multivariate-hypergeometric share of the node's blocks, so that quotas add up exactly. Each shard then takes its own
range of every source's permuted blocks and shuffles its documents locally.

Defined results: null text has size 0; null is a source of its own; a source without words has target 0; repeated
rows are drawn alike; an empty table gives an empty mix. The per-source table (a row per source and level) is the
only thing that the driver holds; sources are the entries of a mixing recipe.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.llm.shared import WORD, stored

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
SHARDS = 16
SEED = 20240607
#: Radix search: bits of each level, and its levels; 2**36 documents of a source are told apart.
LEVEL_BITS, LEVELS = 12, 3
BLOCK_DOCUMENTS = 16
LAST_PLACE, CELL = (1 << 63) - 1, 1 << 63 - LEVEL_BITS * LEVELS
#: The search for more documents ends when this share of the target or less is missing.
LITTLE = 0.001
#: Runs of places, with the most words of a document that is taken from each.
RUNS = "runs_ array<struct<first: long, last: long, most: long>>"
IN_RUN = "exists(runs_, r -> u_ between r.first and r.last and size_ <= r.most)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def measured(documents: DataFrame, key: str, text: str, seed: int) -> DataFrame:
    """The documents with their size_ and their place u_ in the permutation, as 63 bits."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key), F.xxhash64(F.col(text))), 1)
    return documents.withColumns({"size_": word_count(F.col(text)), "u_": place})


def targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS) -> dict[str | None, float]:
    """Words wanted of each source: all words shared by weight, none above `most` times its size, the excess reshared."""
    ordered = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    left, open_sources, out = float(sum(sizes.values())), list(ordered), {}
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        above = [s for s in open_sources if left * weight[s] / total > most * sizes[s]]
        if not above:
            return out | {s: left * weight[s] / total for s in open_sources}
        for s in above:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in above)
        open_sources = [s for s in open_sources if s not in above]
    return out


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """quotas by source -> (source, shard) counts that add up to them; each shard gets a near equal number of blocks."""
    out = np.zeros((len(quotas), shards), np.int64)
    rng = np.random.default_rng(seed)

    def part(counts: np.ndarray, first: int, last: int) -> None:
        if last - first == 1:
            out[:, first] = counts
            return
        middle = (first + last) // 2
        wanted, rest = int(counts.sum()) * (middle - first) // (last - first), int(counts.sum())
        left = np.zeros_like(counts)
        for i, n in enumerate(counts):
            rest -= int(n)
            left[i] = n if rest == 0 and wanted >= n else _drawn(rng, int(n), rest, wanted)
            wanted -= int(left[i])
        part(left, first, middle)
        part(counts - left, middle, last)

    part(np.asarray(quotas, np.int64), 0, shards)
    return out


def _drawn(rng: np.random.Generator, good: int, bad: int, wanted: int) -> int:
    return int(rng.hypergeometric(good, bad, wanted)) if good and wanted else 0


def _thresholds(sized: DataFrame, wanted: list[tuple]) -> dict[str | None, tuple[int, int, int | None]]:
    """wanted: (source, from, most, missing) -> source: (at, words, over) of its documents from place `from` on of 1 to `most` words.

    Those before place `at` have `words` words, which fit; the cell of places at `at` would have `over` words too many.
    Without any that does not fit, `over` is None.
    """
    spark = sized.sparkSession
    out: dict[str | None, tuple[int, int, int | None]] = {}
    state = [(*w, 0) for w in wanted]
    taken = {w[0]: 0 for w in wanted}
    for level in range(LEVELS):
        if not state:
            break
        high, low = 63 - LEVEL_BITS * level, 63 - LEVEL_BITS * (level + 1)
        sent = spark.createDataFrame(state, "source_ string, start_ long, most_ long, missing_ long, from_u_ long")
        inside = sized.join(F.broadcast(sent), sized.source.eqNullSafe(sent.source_)).filter("u_ >= start_ and size_ > 0 and size_ <= most_")
        if level:
            inside = inside.filter(f"shiftright(u_, {high}) = shiftright(from_u_, {high})")
        digit = f"shiftright(u_, {low}) & {(1 << LEVEL_BITS) - 1}"
        blocks = inside.withColumn("digit_", F.expr(digit)).groupBy("source_", "missing_", "digit_").agg(F.sum("size_").alias("words_"))
        before = F.sum("words_").over(Window.partitionBy("source_").orderBy("digit_")) - F.col("words_")
        # the first block that no longer fits as a whole
        found = blocks.withColumn("before_", before).groupBy("source_").agg(
            F.min(F.expr("if(before_ + words_ > missing_, struct(digit_, before_, words_), null)")).alias("at_"), F.sum("words_").alias("all_")
        )
        of = {r.source_: r for r in found.collect()}  # a row per source
        after = []
        for name, start, most, missing, from_u in state:
            if name not in of or of[name].at_ is None:
                out[name] = (LAST_PLACE + 1, taken[name] + (of[name].all_ if name in of else 0), None)
                continue
            at = of[name].at_
            taken[name] += at.before_
            after.append((name, start, most, missing - at.before_, from_u + (at.digit_ << low)))
            if level == LEVELS - 1:
                out[name] = (after[-1][-1], taken[name], at.words_ - after[-1][-2])
        state = after
    return out


def part_runs(sized: DataFrame, parts: list[tuple]) -> dict[str | None, list[tuple[int, int, int]]]:
    """parts: (source, words missing, target) -> source: runs (first place, last place, most words) of what is drawn.

    Documents are taken in the order of the permutation while they fit; one that does not is passed over, and the search
    goes on behind it among those no larger than what is missing, until that is little. Each one passed over, and at the
    end the one nearest in size to the rest, is taken instead if that comes nearer to the target.
    """
    spark = sized.sparkSession
    runs: dict[str | None, list[tuple[int, int, int]]] = {s: [] for s, _, _ in parts}
    missing = {s: m for s, m, _ in parts}
    little = {s: target * LITTLE for s, _, target in parts}
    nearest: dict[str | None, tuple[int, list]] = {}
    state = [(s, 0, m, m) for s, m, _ in parts if m > 0]
    while state:
        found = _thresholds(sized, state)
        after = []
        for s, start, most, _ in state:
            at, words, over = found[s]
            if over is not None:
                end = min(at + CELL - 1, LAST_PLACE)
                if s not in nearest or over < nearest[s][0]:
                    nearest[s] = (over, [*runs[s], (start, end, most)])
            if words:
                runs[s] = [*runs[s], (start, at - 1, most)]
                missing[s] -= words
            if over is not None and missing[s] > little[s] and end < LAST_PLACE:
                after.append((s, end + 1, missing[s], missing[s]))
        state = after
    left = [(s, missing[s], runs[s]) for s in runs if missing[s] > 0]
    if left:
        gaps = spark.createDataFrame(left, f"source_ string, missing_ long, {RUNS}")
        free = sized.join(F.broadcast(gaps), sized.source.eqNullSafe(gaps.source_)).filter(f"size_ > 0 and size_ < 2 * missing_ and not {IN_RUN}")
        alike = free.groupBy("source_", "missing_", "u_").agg(F.sum("size_").alias("words_"), F.max("size_").alias("size_"))
        for r in alike.groupBy("source_").agg(F.min(F.expr("struct(abs(missing_ - words_) as gap, u_, size_)")).alias("one")).collect():
            if r.one.gap < missing[r.source_]:
                runs[r.source_] = [*runs[r.source_], (r.one.u_, r.one.u_, r.one.size_)]
                missing[r.source_] = r.one.gap
    return {s: nearest[s][1] if s in nearest and nearest[s][0] < missing[s] else runs[s] for s in runs}


def plan(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(sizes, recipe): the stored key, source, size_, u_ of each document, and a row per source of what is drawn of it."""
    spark = documents.sparkSession
    sized = stored(
        measured(documents.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), F.col(text).alias("text_")), "key", "text_", seed).drop("text_"),
        "sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size_").alias("words"), F.count("*").alias("documents")).collect()
    totals.sort(key=lambda r: (r.source is None, r.source or ""))
    size_of = {r.source: int(r.words) for r in totals}
    target_of = targets(size_of, weights, most)
    rows = []
    for r in totals:
        n, target = size_of[r.source], target_of[r.source]
        passes = min(most, int(target // n)) if n else 0
        bits = min(LEVEL_BITS, max(0, ceil(log2(max(1, r.documents / BLOCK_DOCUMENTS)))))
        rows.append((r.source, n, target, passes, bits, min(n - 1, round(target - passes * n)) if n and passes < most else 0))
    schema = "source_ string, source_size_ long, target_ double, passes_ int, bits_ int, part_ long"
    wanted = spark.createDataFrame(rows, schema)
    if not rows:
        return sized, wanted.selectExpr("*", "array() as edges_", "cast(array() as array<struct<first: bigint, last: bigint, most: bigint>>) as runs_")
    runs = part_runs(sized, [(r[0], r[5], r[2]) for r in rows])
    drawn = [r[3] * (1 << r[4]) + max([(last >> 63 - r[4]) + 1 for _, last, _ in runs[r[0]]], default=0) for r in rows]
    shares = split_quotas(np.array(drawn), shards, seed)
    edges = np.cumsum(shares, axis=1)
    full = [(*r, [int(x) for x in edges[i]], runs[r[0]]) for i, r in enumerate(rows)]
    return sized, spark.createDataFrame(full, f"{schema}, edges_ array<long>, {RUNS}")


def drawn(sized: DataFrame, recipe: DataFrame, source: str = "source") -> DataFrame:
    """Documents with size_ and u_ -> these with source_size_, target_ and shards_, the shard of each time it is drawn.

    A block's number in its source's stream is pass * blocks + its place in that pass's permutation; part blocks come last.
    """
    joined = sized.join(F.broadcast(recipe), sized[source].eqNullSafe(recipe.source_))
    block = F.expr("shiftright(u_, 63 - bits_)")
    count = F.expr("shiftleft(1L, bits_)")
    whole = F.transform(
        F.expr("if(passes_ > 0, sequence(0, passes_ - 1), array())").cast("array<int>"),
        lambda e: e * count + F.pmod(block * (e * 2 + 3) + e * 7, count),
    )
    part = F.when(F.expr(IN_RUN), F.array(F.col("passes_") * count + block))
    numbers = F.concat(whole, F.coalesce(part, F.array().cast("array<bigint>")))
    shards = F.transform(numbers, lambda d: F.size(F.filter("edges_", lambda edge: edge <= d)))
    return joined.withColumn("shards_", shards).drop("source_", "passes_", "bits_", "part_", "edges_", "runs_")


def mix(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mixed documents with all their columns, once for each time they are drawn, plus shard_; shuffled within shards."""
    _, recipe = plan(documents, key, text, source, weights, most, shards, seed)
    # the documents' own columns travel as one, so that no name clashes
    whole = documents.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    placed = drawn(measured(whole, "key", "text", seed), recipe)
    copies = placed.select("row", "u_", F.posexplode("shards_").alias("time", "shard"))
    order = F.xxhash64(F.lit(seed), "u_", "time")
    # a shard is spread by its random order, so that shards of any size make even tasks
    spread = copies.withColumn("order", order).repartitionByRange("shard", "order").sortWithinPartitions("shard", "order")
    return spread.select("row.*", F.col("shard").alias("shard_"))

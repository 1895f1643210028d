"""N-gram Jaccard join of documents on sets of word shingles.

Shingles are hashed to tokens whose leading byte is their rarity: a corpus-wide count of all shingles with the same hash
prefix, kept in a table that grows with the corpus (up to `MOST_RARITY_BITS`). Tokens in their natural order are therefore rare first. Two sets of Jaccard
similarity t share a token among the first n - ceil(t n) + 1 of each, so only these prefixes are joined; length,
positional and suffix filters drop most pairs, and each remaining pair is verified once on its whole sets.

Equal sets are one class and are joined once. A group of near copies does not become all its pairs: each document of
a posting list is first verified against the list's centre, and after that only pairs of documents that are not
yet connected are verified; tokens with the same documents meet them once. No link between different components is
lost, and none inside one is needed.

Defined results: a text of fewer words than a shingle is its whole word sequence as one shingle; null and blank texts
have no shingle and link with nothing; rows that repeat an id are one node; rows without an id link with nothing; an empty
table gives no rows; columns other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.components import components
from footfall.llm.shared import COUNT_BLOCKS, COUNTS, byte_counts, count_batch, merged_counts, mixed, read_bytes, stored, text_slices, word_hashes

SHINGLE = 5
#: Similarity as a percentage.
PERCENT = 80
#: Entries of the rarity table, as powers of 2: enough for `CELL_CHARS` characters of text an entry, within these limits.
#: It is broadcast as one byte an entry, and each task sends one byte an entry.
LEAST_RARITY_BITS, MOST_RARITY_BITS, CELL_CHARS = 14, 22, 24
#: Parts of the token space, 64 to a word; the suffix filter compares in which of them two sets have an odd number of tokens.
PART_WORDS = 16
PARTS = 64 * PART_WORDS
BITS = [f"bits{i}" for i in range(PART_WORDS)]
#: Ids that are broadcast at most (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def shingles(data: np.ndarray, starts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text, repeats included, and their texts."""
    words, docs = word_hashes(data, starts)
    if not len(words):
        return words, docs
    codes = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        codes = mixed(codes + words[k : len(words) - size + 1 + k])
    whole = docs[: len(codes)] == docs[size - 1 :] if len(codes) else np.zeros(0, bool)
    counts = np.bincount(docs, minlength=len(starts) - 1)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return codes[whole], docs[: len(codes)][whole]
    first = np.searchsorted(docs, short)
    code = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        here = counts[short] > k
        code[here] = mixed(code[here] + words[first[here] + k])
    code = mixed(code + counts[short].astype(np.uint64))
    return np.concatenate([codes[whole], code]), np.concatenate([docs[: len(codes)][whole], short])


def rarity_bits(chars: int) -> int:
    return min(MOST_RARITY_BITS, max(LEAST_RARITY_BITS, (chars // CELL_CHARS).bit_length()))


def rarity(documents: DataFrame, text: str = "text") -> np.ndarray:
    """A byte for each hash prefix: the higher, the more shingles of the corpus have it; a task counts up to 255 of each."""
    source = documents.select(F.col(text).cast("string").alias("text"))
    bits = rarity_bits(source.agg(F.sum(F.length("text"))).first()[0] or 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            for _, data, starts in text_slices(batch, "text"):
                cells, times = np.unique(shingles(data, starts)[0] >> np.uint64(64 - bits), return_counts=True)
                cells = cells.astype(np.int64)
                total[cells] = np.minimum(total[cells] + times, 255)
        if rows := list(byte_counts("low", TaskContext.get().partitionId(), total)):
            yield count_batch(rows)

    rare, size = np.zeros(1 << bits, np.uint8), (1 << bits) // COUNT_BLOCKS
    parts = max(1, source.rdd.getNumPartitions())
    for r in merged_counts(source.mapInArrow(count, COUNTS), parts).toLocalIterator():
        rare[r["block"] * size : (r["block"] + 1) * size] = np.minimum(np.round(np.log2(read_bytes(r["data"]) + 1.0) * 6), 127)
    return rare


def token_sets(data: np.ndarray, starts: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens of each text, rare first, and where each text's start (with the end)."""
    hashes, docs = shingles(data, starts)
    bits = len(rare).bit_length() - 1
    tokens = (rare[(hashes >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))
    order = np.lexsort((tokens, docs))
    tokens, docs = tokens[order].astype(np.int64), docs[order]
    if len(tokens):
        new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (docs[1:] != docs[:-1])])
        tokens, docs = tokens[new], docs[new]
    return tokens, np.searchsorted(docs, np.arange(len(starts)))


def prefix_sizes(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - -(-percent * n // 100) + 1, 0)


def odd_parts(tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
    """PART_WORDS words a set, of the tokens of sets of n each: the bits of parts that have an odd number of its tokens."""
    words = np.zeros(len(n) * PART_WORDS, np.uint64)
    part = tokens.astype(np.uint64) & np.uint64(PARTS - 1)
    place = np.repeat(np.arange(len(n)) * PART_WORDS, n) + (part >> np.uint64(6)).astype(np.int64)
    np.bitwise_xor.at(words, place, np.uint64(1) << (part & np.uint64(63)))
    return words.view(np.int64).reshape(-1, PART_WORDS)


def signed(documents: DataFrame, rare, key: str, text: str, percent: int) -> DataFrame:
    """(doc, n, sign1, sign2, prefix, bits..) of every document: set size, a 128-bit sum over the set, its prefix, the parts with an odd number of its tokens."""
    source = documents.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, starts in text_slices(batch, "text"):
                tokens, at = token_sets(data, starts, rare.value)
                n = np.diff(at)
                codes = mixed(tokens.astype(np.uint64)), mixed(tokens.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(c, dtype=np.uint64)]) for c in codes]
                signs = [(s[at[1:]] - s[at[:-1]]).astype(np.int64) for s in sums]
                size = prefix_sizes(n, percent)
                place = np.arange(len(tokens)) - np.repeat(at[:-1], n)
                prefix = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), tokens[place < np.repeat(size, n)])
                words = odd_parts(tokens, n)
                columns = [batch.column("doc").slice(part.start, part.stop - part.start), pa.array(n), *map(pa.array, signs), prefix]
                columns += [pa.array(np.ascontiguousarray(words[:, i])) for i in range(PART_WORDS)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "sign1", "sign2", "prefix", *BITS])

    return source.mapInArrow(rows, "doc long, n long, sign1 long, sign2 long, prefix array<long>, " + ", ".join(f"{b} long" for b in BITS))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings sorted by token: those whose token another posting has."""
    waiting: pa.RecordBatch | None = None
    before: int | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if waiting is not None:
            batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
        tokens = batch.column("token").to_numpy()
        same = tokens[1:] == tokens[:-1]
        keep = np.concatenate([[before == tokens[0]], same]) | np.concatenate([same, [False]])
        # the last waits for its neighbour
        yield batch.slice(0, len(tokens) - 1).filter(pa.array(keep[:-1]))
        waiting = batch.slice(len(tokens) - 1)
        before = int(tokens[-2]) if len(tokens) > 1 else before
    if waiting is not None and before == waiting.column("token")[0].as_py():
        yield waiting


def postings(sets: DataFrame) -> DataFrame:
    """(token, doc, n, at) of the prefixes, for tokens of two documents or more."""
    one = sets.select("doc", "n", F.posexplode("prefix").alias("at", "token")).select("token", "doc", "n", "at")
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return one.repartition(parts, "token").sortWithinPartitions("token").mapInArrow(_shared, "token long, doc long, n long, at int")


def needed(n: Column, m: Column, percent: int) -> Column:
    """The least intersection of linked sets of these sizes: |a & b| * 100 >= percent * |a | b|."""
    return F.ceil(percent * (n + m) / (100 + percent))


def may_link(n: Column, at: Column, m: Column, to: Column, percent: int) -> Column:
    """Length and positional filter for two sets that share the token at these places."""
    length = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return length & (F.least(at, to) + 1 + F.least(n - at, m - to) - 1 >= needed(n, m, percent))


def room_in_parts(x: str, y: str, n: Column, m: Column, percent: int) -> Column:
    """Suffix filter: where one set has an odd number of tokens and the other an even one, there is a token that they don't share."""
    apart = F.bit_count(F.col(f"{x}0").bitwiseXOR(F.col(f"{y}0")))
    for i in range(1, PART_WORDS):
        apart = apart + F.bit_count(F.col(f"{x}{i}").bitwiseXOR(F.col(f"{y}{i}")))
    return n + m - apart >= 2 * needed(n, m, percent)


def _as_side(sets: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """n and bits of one side's documents, named after it; only of documents that it has."""
    wanted = few_or_all(stored(ids.select(F.col(name).alias("doc")).distinct(), "side"))
    held = sets.join(wanted, "doc", "left_semi").select("doc", "n", *BITS).distinct()
    return held.select(F.col("doc").alias(name), F.col("n").alias(f"n_{name}"), *[F.col(b).alias(f"{name}_{b}") for b in BITS])


def suffix_filter(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose parts leave room for enough common tokens."""
    joined = pairs.join(_as_side(sets, pairs, "a"), "a").join(_as_side(sets, pairs, "b"), "b")
    kept = joined.filter(room_in_parts("a_bits", "b_bits", F.col("n_a"), F.col("n_b"), percent))
    return kept.select("a", "b").distinct()


def few_or_all(ids: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """Broadcast when counted to be few; else left to a shuffled join."""
    return F.broadcast(ids) if ids.count() <= most else ids


#: Common tokens by which a count of halved tokens may be wrong; pairs closer to the border are counted in whole tokens.
BORDER = 3


def _common(pairs: DataFrame, documents: DataFrame, rare, key: str, text: str, halved: bool) -> DataFrame:
    """(a, b, n_a, n_b, common): sizes and common tokens of the whole sets, or of the lower half of each token."""
    wanted = stored(pairs.selectExpr("explode(array(a, b)) as doc").distinct(), "wanted")
    source = documents.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).join(few_or_all(wanted), "doc", "left_semi")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, starts in text_slices(batch, "text"):
                tokens, at = token_sets(data, starts, rare.value)
                sets = pa.ListArray.from_arrays(at.astype(np.int32), tokens.astype(np.int32) if halved else tokens)
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(part.start, part.stop - part.start), sets], names=["doc", "tokens"])

    sets = stored(source.mapInArrow(rows, f"doc long, tokens array<{'int' if halved else 'long'}>"), "sets")
    left = sets.select(F.col("doc").alias("a"), F.col("tokens").alias("tokens_a"))
    right = sets.select(F.col("doc").alias("b"), F.col("tokens").alias("tokens_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("tokens_a", "tokens_b")).alias("common")
    return joined.select("a", "b", F.size("tokens_a").alias("n_a"), F.size("tokens_b").alias("n_b"), common)


def verified(pairs: DataFrame, documents: DataFrame, rare, key: str, text: str, percent: int) -> DataFrame:
    """Of the pairs (a, b) those whose whole sets share enough tokens; an id with several texts links by any of them.

    Half tokens halve what is shuffled. A wrong count needs different tokens with equal halves; only pairs within BORDER of
    the border could be judged wrongly by one to three of these, and they are counted again in whole tokens.
    """
    enough = needed(F.col("n_a"), F.col("n_b"), percent)
    counted = stored(_common(pairs, documents, rare, key, text, True).filter(F.col("common") >= enough - BORDER), "counted")
    near_border = counted.filter(F.col("common") < enough + BORDER)
    found = counted.filter(F.col("common") >= enough + BORDER).select("a", "b")
    if not near_border.take(1):
        return found
    exact = _common(near_border.select("a", "b").distinct(), documents, rare, key, text, False).filter(F.col("common") >= enough)
    return found.unionByName(exact.select("a", "b"))


def first_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """One pair (a, b) a document: with the best centre of its lists that the filters admit.

    The centre of a list is the document that shares the most of its prefix with others: of a group of near copies,
    the one with the fewest changes of its own, which the most others link with.
    """
    shared = lists.groupBy("doc").agg(F.count("*").alias("shared"))
    ranked = lists.join(shared, "doc")
    centre = ranked.groupBy("token").agg(F.max(F.struct("shared", (-F.col("doc")).alias("minus"), "n", "at")).alias("centre"))
    met = ranked.join(centre, "token").filter(F.col("doc") != -F.col("centre.minus"))
    close = met.filter(may_link(F.col("n"), F.col("at"), F.col("centre.n"), F.col("centre.at"), percent))
    best = close.groupBy("doc").agg(F.max(F.struct("centre.shared", "centre.minus")).alias("best"))
    other = -F.col("best.minus")
    return best.select(F.least("doc", other).alias("a"), F.greatest("doc", other).alias("b")).distinct()


def distinct_lists(labelled: DataFrame, repeated: DataFrame) -> DataFrame:
    """One token of each list of documents (token, doc, n, root) of several components.

    Near copies share many tokens, and most of these have the same documents. The filters hold for a linked pair at
    every token that it shares, so one of them tells as much as all. A list is known by its size and 128 bits
    of sums over its documents. `repeated`: ids of several texts; their lists are kept one by one, as the
    text that a row stands for is not known.
    """
    marked = labelled.join(repeated.select("doc", F.lit(True).alias("twice")), "doc", "left")
    halves = []
    for code in (F.xxhash64("doc"), F.xxhash64(F.lit(SHINGLE), "doc")):
        halves += [code.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(code, 32)]
    sums = [F.sum(h).alias(f"sum{i}") for i, h in enumerate(halves)]
    found = marked.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"), F.max("twice").alias("twice"), *sums)
    own = F.when(F.col("twice"), F.col("token")).alias("own")
    return found.filter("low < high").groupBy("size", *[f"sum{i}" for i in range(len(sums))], own).agg(F.min("token").alias("token")).select("token")


def crossing_pairs(lists: DataFrame, linked: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of documents that share a prefix token, pass all filters and are in different components."""
    labelled = lists.join(linked.select(F.col("node").alias("doc"), "root"), "doc", "left").withColumn("root", F.coalesce("root", "doc"))
    repeated = stored(sets.select("doc", "n", "sign1", "sign2").distinct().groupBy("doc").count().filter("count > 1").select("doc"), "repeated")
    several = stored(distinct_lists(labelled, few_or_all(repeated)), "lists")
    open_rows = stored(labelled.join(few_or_all(several), "token"), "open")
    docs = few_or_all(stored(open_rows.select("doc").distinct(), "docs"))
    held = sets.join(docs, "doc", "left_semi").select("doc", *BITS).distinct()
    open_lists = open_rows.join(held, "doc")

    def side(name: str) -> DataFrame:
        columns = {"root": f"root_{name}", "doc": name, "n": f"n_{name}", "at": f"at_{name}"} | {b: f"{name}_{b}" for b in BITS}
        return open_lists.withColumnsRenamed(columns)

    n, m = F.col("n_x"), F.col("n_y")
    # the filters are conditions of the join, the cheapest first: a pair that fails one is never a row
    apart = F.col("root_x") < F.col("root_y")
    met = side("x").join(side("y"), "token").filter(
        apart & may_link(n, F.col("at_x"), m, F.col("at_y"), percent) & room_in_parts("x_bits", "y_bits", n, m, percent)
    )
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicate_groups(documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, class_id, component_id): class_id is the smallest id with an equal set."""
    spark = documents.sparkSession
    rare = spark.sparkContext.broadcast(rarity(documents, text))
    every = stored(signed(documents, rare, key, text, percent), "signed")
    same = ("n", "sign1", "sign2")
    classes = every.filter("n > 0 and doc is not null").groupBy(*same).agg(F.min("doc").alias("class_id"), F.count("*").alias("rows"))
    copies = classes.filter("rows > 1").select(*same, "class_id")
    # one row a class: those of classes of one document, and the first of the others
    sets = every.filter("n > 0 and doc is not null")
    spare = stored(sets.select("doc", *same).join(copies, list(same)).filter("doc > class_id").select("doc", *same).distinct(), "spare")
    reps = sets.join(few_or_all(spare), ["doc", *same], "left_anti")
    lists = stored(postings(reps), "postings")
    links = stored(verified(stored(suffix_filter(stored(first_pairs(lists, percent), "first"), sets, percent), "pairs"), documents, rare, key, text, percent), "links")
    linked = components(links.distinct())
    crossing = stored(crossing_pairs(lists, linked, sets, percent), "pairs")
    if crossing.take(1):
        links = links.unionByName(stored(verified(crossing, documents, rare, key, text, percent), "links"))
        linked = components(links.distinct())
    of_class = linked.select(F.col("node").alias("class_id"), F.col("root"))
    named = classes.select(*same, "class_id").join(of_class, "class_id", "left")
    joined = every.select("doc", *same).join(named, list(same), "left").select("doc", "n", "class_id", F.coalesce("root", "class_id", "doc").alias("root"))
    rows = stored(one_node_an_id(stored(joined, "rows")), "groups")
    return rows.select(
        F.col("doc").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("class_id", "doc")).alias("class_id"),
        F.when(F.col("doc").isNotNull(), F.col("root")).alias("component_id"),
    )


def one_node_an_id(rows: DataFrame) -> DataFrame:
    """`rows` with the components joined that an id with several texts belongs to."""
    ids = rows.filter("doc is not null").groupBy("doc").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    bridges = stored(rows.join(ids.filter("low < high"), "doc").filter("root > low").select(F.col("root").alias("a"), F.col("low").alias("b")).distinct(), "bridges")
    if not bridges.take(1):
        return rows
    moved = components(bridges).select(F.col("node").alias("root"), F.col("root").alias("moved"))
    return rows.join(moved, "root", "left").withColumn("root", F.coalesce("moved", "root")).drop("moved")


def one_of_each_group(documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """`documents` with the one of the smallest id of each component; rows without an id stay."""
    groups = stored(near_duplicate_groups(documents, key, text, percent).select(F.col(key).alias("id"), "component_id"), "groups")
    spare = stored(groups.filter("id != component_id").select("id").distinct(), "spare")
    alone = documents.join(few_or_all(spare), documents[key] == spare["id"], "left_anti")
    several = stored(groups.filter("id = component_id").groupBy("id").count().filter("count > 1").select("id"), "several")
    if not several.take(1):
        return alone
    repeated = alone.join(few_or_all(several), alone[key] == several["id"], "left_semi").dropDuplicates([key])
    return alone.join(few_or_all(several), alone[key] == several["id"], "left_anti").unionByName(repeated)

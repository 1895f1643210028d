"""Embedding near-duplicates by NN-descent.

A first neighbour graph comes from several random-hyperplane orders, in which each vector meets the few next to it.
Each round then compares the neighbours of a vector, forward and reverse, with one another, and a vector keeps the
nearest it has met; rounds end when few lists change. Links of at least the threshold give components. A list that is full of
links is saturated: it is enlarged to its whole component, whose members are compared in blocks, so that no link
within a component is missed and none is capped. Recall is then audited against brute force for a hash sample of all
vectors, by link and by group, and more orders and rounds are added until the target is met.

Vectors with equal components are one class and are compared once. Defined results: null or zero vectors and ones
with null or non-finite components link with nothing; so do rows without an id; rows that repeat an id are the vector
that sorts first; vectors of another length than the others are compared with those of their length only; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.components import components
from footfall.llm.shared import stored

THRESHOLD = 0.95
NEIGHBOURS = 8
#: Random orders of the first graph, bits of an order's key, and how many following vectors each vector meets in it.
ORDERS, BITS, MEETS = 10, 32, 5
#: Orders that each factor of ten of vectors needs more, from that many vectors on, for the same share of pairs to meet.
ORDERS_A_DECADE, FROM_VECTORS = 7, 30_000
ROUNDS, STILL_CHANGING = 3, 0.02
#: Vectors audited by brute force at first; links that they should have, and vectors audited at most for that.
AUDITED, AUDITED_LINKS, MOST_AUDITED = 1024, 500, 16_384
#: Target recall; the search is extended while below it, and raises when that many extensions have not met it.
RECALL, EXTENSIONS = 0.97, 12
#: Members of a component that are compared at once with as many others.
BLOCK = 512

PAIR = "u long, v long, cos double"
#: Compared pairs that are links or nearer than a neighbour of one of the two; near says the latter.
NEWS = f"{PAIR}, near boolean"


def _units(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors x of a batch in double precision and of length 1; scaled first, so that squares neither overflow nor vanish."""
    lists = batch.column("x")
    if not len(lists):
        return np.zeros((0, 0))
    x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.square(x).sum(1, keepdims=True))


def _pairs(u: np.ndarray, v: np.ndarray, cos: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(cos, pa.float64())], names=["u", "v", "cos"])


def _news(u: np.ndarray, v: np.ndarray, cos: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    pairs = _pairs(u, v, cos)
    return pa.RecordBatch.from_arrays([*pairs.columns, pa.array(near, pa.bool_())], names=[*pairs.schema.names, "near"])


def valid_vectors(embeddings: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, x, dims) of the valid vectors, one per id; x keeps its element type, so tasks are sent no more than the table has."""
    x = F.col("x")
    found = embeddings.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("x")).filter("id is not null and x is not null")
    finite = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    one = found.filter(finite & F.exists(x, lambda c: c != 0)).groupBy("id").agg(F.min("x").alias("x"))
    return one.withColumn("dims", F.size("x"))


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members of classes of several: id, rep), (reps: id, x, dims, copies); a class has equal vectors."""
    reps = vectors.groupBy("x", "dims").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    several = reps.filter("copies > 1").select("x", "rep")
    return vectors.join(several, "x").select("id", "rep"), reps.select(F.col("rep").alias("id"), "x", "dims", "copies")


def _order_keys(seeds: range, dims: int):
    """Each vector once for each order, with its place in it: the sides of random hyperplanes as bits."""
    planes = np.concatenate([np.random.default_rng([seed, dims]).standard_normal((dims, BITS)) for seed in seeds], 1)
    weights = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 2000):
                batch = whole.slice(first, 2000)
                codes = ((_units(batch) @ planes > 0).reshape(-1, len(seeds), BITS) @ weights).astype(np.int64)
                for k, seed in enumerate(seeds):
                    columns = [batch.column("id"), batch.column("x"), pa.array(np.full(batch.num_rows, seed, np.int32)), pa.array(np.ascontiguousarray(codes[:, k]))]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "x", "turn", "code"])

    return keys


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cosines of each vector with the next MEETS in the order."""
    ids, units = np.zeros(0, np.int64), None
    for batch in batches:
        if not batch.num_rows:
            continue
        new_ids, new_units = batch.column("id").to_numpy(), _units(batch)
        old = len(ids)
        ids = np.concatenate([ids, new_ids])
        units = new_units if units is None else np.concatenate([units, new_units])
        for lag in range(1, MEETS + 1):
            first = max(0, old - lag)
            if first + lag < len(ids):
                left = slice(first, len(ids) - lag)
                cos = np.einsum("ij,ij->i", units[left], units[first + lag :])
                yield _pairs(ids[left], ids[first + lag :], cos)
        ids, units = ids[-MEETS:], units[-MEETS:]


def _sent(reps: DataFrame) -> tuple[str, int]:
    """The type of x, and the number of shuffle partitions."""
    return reps.schema["x"].dataType.simpleString(), int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def met_in_orders(reps: DataFrame, dims: int, seeds: range) -> DataFrame:
    """(u, v, cos) of the vectors that meet in the orders of the seeds."""
    kind, parts = _sent(reps)
    keyed = reps.filter(F.col("dims") == dims).select("id", "x").mapInArrow(_order_keys(seeds, dims), f"id long, x {kind}, turn int, code long")
    return keyed.repartitionByRange(parts, "turn", "code", "id").sortWithinPartitions("turn", "code", "id").mapInArrow(_meet, PAIR)


def nearest(pairs: DataFrame, k: int) -> DataFrame:
    """(u, list of (far, v)) with the k nearest of each u, nearest first; pairs count in both directions."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"), "cos"))
    return both.groupBy("u").agg(F.slice(F.array_sort(F.collect_set(F.struct((-F.col("cos")).alias("far"), "v"))), 1, k).alias("list"))


def _local_join(threshold: float):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (centre, id, worst, x) sorted by centre: compares the members of each centre with one another."""
        rest: pa.RecordBatch | None = None

        def compared(batch: pa.RecordBatch) -> pa.RecordBatch:
            centre, ids, worst = (batch.column(n).to_numpy() for n in ("centre", "id", "worst"))
            units = _units(batch)
            edges = np.concatenate([[0], np.flatnonzero(centre[1:] != centre[:-1]) + 1, [len(centre)]])
            out: list[tuple] = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a < 2:
                    continue
                cos = units[a:b] @ units[a:b].T
                # a pair is near if it is nearer than the worst neighbour of one of the two; a link is told even if it isn't
                near = cos > np.minimum(worst[a:b, None], worst[None, a:b])
                i, j = np.nonzero(np.triu(near | (cos >= threshold), 1))
                if len(i):
                    out.append((ids[a + i], ids[a + j], cos[i, j], near[i, j]))
            if not out:
                return _news(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool))
            u, v, c, near = (np.concatenate(x) for x in zip(*out, strict=True))
            key = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0, return_index=True)[1]
            return _news(u[key], v[key], c[key], near[key])

        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            centre = batch.column("centre").to_numpy()
            last = int(np.searchsorted(centre, centre[-1]))
            if last:
                yield compared(batch.slice(0, last))
            rest = batch.slice(last)
        if rest is not None and rest.num_rows:
            yield compared(rest)

    return join


def descend(reps: DataFrame, lists: DataFrame, k: int, threshold: float = THRESHOLD) -> DataFrame:
    """One round: the news (u, v, cos, near) among the forward and reverse neighbours of every vector."""
    forward = lists.select(F.col("u").alias("centre"), F.explode("list.v").alias("id"))
    # up to k reverse neighbours, drawn by hash slots so that a popular vector is never gathered
    drawn = forward.select(F.col("id").alias("centre"), F.col("centre").alias("id"), F.xxhash64("centre", "id").alias("h"))
    reverse = drawn.groupBy("centre", F.pmod("h", F.lit(k)).alias("slot")).agg(F.max_by("id", "h").alias("id")).select("centre", "id")
    own = lists.select(F.col("u").alias("centre"), F.col("u").alias("id"))
    members = forward.unionByName(reverse).unionByName(own).distinct()
    worst = lists.select(F.col("u").alias("id"), F.when(F.size("list") >= k, -F.element_at("list", -1)["far"]).otherwise(F.lit(-2.0)).alias("worst"))
    carried = members.join(worst, "id").join(reps.select("id", "x"), "id").select("centre", "id", "worst", "x")
    return carried.repartition(_sent(reps)[1], "centre").sortWithinPartitions("centre").mapInArrow(_local_join(threshold), NEWS)


def links_within(reps: DataFrame, member_of: DataFrame, threshold: float) -> DataFrame:
    """(id, links): how many vectors of its component each vector links with, weighed by their copies.

    A component is cut into blocks of about BLOCK members, and each block is compared with each block of it.
    """
    sizes = member_of.groupBy("root").agg(F.count("*").alias("n")).select("root", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = (
        member_of.join(sizes, "root")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .join(reps, "id")
        .select("root", "blocks", "block", "id", "copies", "x")
    )
    # row: the block whose links are counted; column: the block it is compared with
    as_row = placed.select("root", F.col("block").alias("r"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("c"), "id", "copies", "x", F.lit(True).alias("counted"))
    as_column = placed.select("root", F.explode(F.expr("sequence(0, blocks - 1)")).alias("r"), F.col("block").alias("c"), "id", "copies", "x", F.lit(False).alias("counted"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None

        def compared(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in ("root", "r", "c")], 1)
            ids, copies = batch.column("id").to_numpy(), batch.column("copies").to_numpy()
            rows = batch.column("counted").to_numpy(zero_copy_only=False).astype(bool)
            units = _units(batch)
            edges = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])
            out_ids, out_links = [], []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                row, column = np.flatnonzero(rows[a:b]) + a, np.flatnonzero(~rows[a:b]) + a
                near = (units[row] @ units[column].T >= threshold) & (ids[row][:, None] != ids[column][None, :])
                out_ids.append(ids[row])
                out_links.append(near @ copies[column])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_ids), pa.int64()), pa.array(np.concatenate(out_links).astype(np.int64))], names=["id", "links"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            keys = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in ("root", "r", "c")], 1)
            last = int(np.flatnonzero((keys != keys[-1]).any(1))[-1]) + 1 if (keys != keys[-1]).any() else 0
            if last:
                yield compared(batch.slice(0, last))
            rest = batch.slice(last)
        if rest is not None:
            yield compared(rest)

    both = as_row.unionByName(as_column).repartition(_sent(reps)[1], "root", "r", "c").sortWithinPartitions("root", "r", "c")
    return both.mapInArrow(count, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def orders_for(vectors: int) -> int:
    """Orders of the first graph: they grow with the logarithm of the number of vectors."""
    return ORDERS + max(0, int(np.ceil(ORDERS_A_DECADE * np.log10(max(vectors, 1) / FROM_VECTORS))))


def audit(reps: DataFrame, found: DataFrame, dims: int, threshold: float, audited: int = AUDITED) -> float:
    """Share of the links of a hash sample of all vectors that `found` (id, links) has.

    The smaller of two shares: each link counts alike, or each group does (a vector by one over its links and itself), so
    that large groups don't hide lost pairs. The sample grows until it has AUDITED_LINKS links.
    """
    here = reps.filter(F.col("dims") == dims)
    size = here.count()
    while True:
        rows = here.select("id", "x").orderBy(F.xxhash64("id", F.lit(1)), "id").limit(audited).toArrow().combine_chunks()
        if not rows.num_rows:
            return 1.0
        ids, units = rows.column("id").to_numpy(), _units(rows.to_batches()[0])

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(ids), np.int64)
            for whole in batches:
                for first in range(0, whole.num_rows, BLOCK):
                    batch = whole.slice(first, BLOCK)
                    near = (_units(batch) @ units.T >= threshold) & (batch.column("id").to_numpy()[:, None] != ids[None, :])
                    total += batch.column("copies").to_numpy() @ near
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["id", "links"])

        true = here.mapInArrow(count, "id long, links long").groupBy("id").agg(F.sum("links").alias("links")).filter("links > 0")
        both = true.toPandas()
        if both.links.sum() >= AUDITED_LINKS or audited >= min(size, MOST_AUDITED):
            break
        audited *= 4
    if not len(both):
        return 1.0
    asked = reps.sparkSession.createDataFrame([(int(i),) for i in both.id], "id long")
    have = {r["id"]: r["links"] for r in found.join(F.broadcast(asked), "id").collect()}
    want = both.links.to_numpy(float)
    got = np.minimum([have.get(i, 0) for i in both.id], want)
    by_group = 1 / (want + 1)
    return float(min(got.sum() / want.sum(), (by_group * got / want).sum() / by_group.sum()))


def near_duplicates(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, k: int = NEIGHBOURS) -> DataFrame:
    """(key, n_links, component_id, kept) of every row's vector."""
    vectors = stored(valid_vectors(embeddings, key, vector), "vectors")
    members, reps = classes(vectors)
    reps = stored(reps, "reps")
    counts: DataFrame | None = None
    member_of: DataFrame | None = None
    for dims in [r["dims"] for r in reps.select("dims").distinct().orderBy("dims").collect()]:
        here = reps.filter(F.col("dims") == dims)
        orders = orders_for(here.count())
        met = stored(met_in_orders(reps, dims, range(orders)), "met")
        for extension in range(EXTENSIONS + 1):
            lists = stored(nearest(met, k), "lists")
            links = met.filter(F.col("cos") >= threshold).select(F.col("u").alias("a"), F.col("v").alias("b"))
            for _ in range(ROUNDS):
                news = stored(descend(here, lists, k, threshold), "news")
                links = links.unionByName(news.filter(F.col("cos") >= threshold).select(F.col("u").alias("a"), F.col("v").alias("b")))
                old = lists.select("u", F.explode("list").alias("x")).select("u", F.col("x.v").alias("v"), (-F.col("x.far")).alias("cos"))
                near = news.filter("near").drop("near")
                lists = stored(nearest(old.unionByName(near), k), "lists")
                if near.count() < STILL_CHANGING * k * lists.count():
                    break
            linked = components(links)
            roots = linked.select("root").distinct()
            here_of = stored(linked.select(F.col("node").alias("id"), "root").unionByName(roots.select(F.col("root").alias("id"), "root")), "members")
            here_counts = stored(links_within(here, here_of, threshold), "counts")
            recall = audit(here, here_counts, dims, threshold)
            if recall >= RECALL:
                break
            if extension == EXTENSIONS:
                raise RuntimeError(f"recall {recall:.3f} after {orders * (extension + 1)} orders; the target is {RECALL}")
            more = range(orders * (extension + 1), orders * (extension + 2))
            met = stored(met.unionByName(met_in_orders(reps, dims, more)), "met")
        counts = here_counts if counts is None else counts.unionByName(here_counts)
        member_of = here_of if member_of is None else member_of.unionByName(here_of)
    ids = embeddings.select(F.col(key).cast("long").alias("id"))
    if counts is None:
        return ids.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    per_rep = (
        reps.select(F.col("id").alias("rep"), "copies")
        .join(member_of.select(F.col("id").alias("rep"), "root"), "rep", "left")
        .join(counts.select(F.col("id").alias("rep"), "links"), "rep", "left")
        .filter("copies > 1 or root is not null")
        .select("rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "rep").alias("root"))
    )
    alone = members.select(F.col("id").alias("member"), "rep")
    of_copies = alone.join(per_rep, "rep").select("member", "links", "root")
    of_reps = per_rep.join(alone.select(F.col("member").alias("rep")), "rep", "left_anti").select(F.col("rep").alias("member"), "links", "root")
    final = of_copies.unionByName(of_reps)
    joined = ids.join(final, F.col("id") == F.col("member"), "left")
    component = F.coalesce("root", "id")
    return joined.select(F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id").eqNullSafe(component)).alias("kept"))

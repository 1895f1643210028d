"""Suffix-array dedup: removes every byte inside a string of `length` bytes that also starts elsewhere.

The strings that are sorted are sequences of phrases, not of bytes. A phrase runs from one anchor to the next; an
anchor is a gram of GRAM bytes whose middle hash is the least of its neighbours, so equal bytes have equal anchors and phrases wherever they
stand. Phrases that occur once end all matches and drop out first. What is left goes through the difference-cover
algorithm, as far as `length` bytes:

1. positions 1 and 2 modulo 3 of every document are the sample; their triples are sorted and named by rank;
2. this recurs on the names, each level three times as long, until a name spans `length` bytes;
3. the remaining suffixes are merged: a suffix is its first phrase or two and the name of the next sampled position,
   and any two suffixes share one of the three such forms, which is what the cover is for;
4. adjacent suffixes are compared: equal ones repeat from their anchor to `length` bytes past the next anchor.

That decides the inside of every long repeat. Where a repeat begins and ends between anchors, and where a string has too
few anchors, the strings of exactly `length` bytes are compared themselves, against one another and against one copy of each repeat.

Strings are compared by 64-bit fingerprints. Defined results: null is empty; a text shorter than `length` is kept; rows
that are equal in key and text repeat each other; a null key is a key like others; an empty table gives no rows; matches
never cross documents; columns other than key and text are returned as they are by `deduplicated`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import BYTE_CODE, mixed, powers, stored, text_slices

LENGTH = 200
#: An anchor's hash covers HASHED bytes and is the least within RADIUS positions on either side.
HASHED, RADIUS = 12, 20
GRAM = HASHED + 2 * RADIUS
#: Leading bits of a phrase's name that depend on its first gram only.
GRAM_BITS = 24


class Bytes:
    """Texts of a slice with fingerprints of any substring, and their anchors and phrases."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, length: int):
        self.data, self.starts, self.length = data, starts, length
        n = len(data)
        power, self.inverse = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_CODE[data] * power[:-1], out=self.sums[1:])
        self.grams, self.docs = self._anchors()
        ends = starts[1:][self.docs]
        same = self.docs[1:] == self.docs[:-1]
        last = np.concatenate([~same, [True]])[: len(self.docs)]
        first = np.concatenate([[True], ~same])[: len(self.docs)]
        #: The last phrase of a text ends with it, not at an anchor: it may occur inside another phrase.
        self.last = last
        following = np.concatenate([self.grams[1:], [0]])[: len(self.docs)]
        #: Where a phrase's bytes end, its length less GRAM, and the start of the windows whose first anchor it has.
        self.stops = np.where(last, ends, following + GRAM)
        self.lengths = self.stops - self.grams - GRAM
        before = np.concatenate([[0], self.grams[:-1]])[: len(self.docs)]
        self.gaps = np.where(first, self.grams - starts[:-1][self.docs] + 1, self.grams - before)
        self.ordinal = np.arange(len(self.docs)) - np.searchsorted(self.docs, self.docs)

    def print_of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Fingerprints of the bytes from first to last."""
        return mixed((self.sums[last] - self.sums[first]) * self.inverse[first] + (last - first).astype(np.uint64))

    def _anchors(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.data)
        if n < GRAM:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        raw = (self.sums[HASHED:] - self.sums[:-HASHED]) * self.inverse[: n + 1 - HASHED]
        code = ((raw * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        low, size = code, 1
        while size * 2 <= RADIUS:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < RADIUS:
            low = np.minimum(low[: len(low) - (RADIUS - size)], low[RADIUS - size :])
        # low[i]: least of code[i : i + RADIUS]; a gram at g has its hash at g + RADIUS
        count = len(code) - 2 * RADIUS
        middle = code[RADIUS : RADIUS + count]
        grams = np.flatnonzero((middle < low[:count]) & (middle < low[RADIUS + 1 : RADIUS + 1 + count]))
        docs = np.searchsorted(self.starts, grams, "right") - 1
        inside = grams + GRAM <= self.starts[1:][docs]
        return grams[inside], docs[inside]

    def names(self) -> np.ndarray:
        """Phrase names: GRAM_BITS of the first gram, the others of the whole phrase."""
        gram = self.print_of(self.grams, self.grams + GRAM) >> np.uint64(64 - GRAM_BITS)
        whole = self.print_of(self.grams, self.stops) >> np.uint64(GRAM_BITS)
        return (gram << np.uint64(64 - GRAM_BITS) | whole).astype(np.int64)

    def far(self) -> np.ndarray:
        """Whether a window can start before the phrase's gram, after the one before, and end before the phrase does."""
        return self.gaps + self.lengths + GRAM > self.length

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor, the first and last start of windows that it is the first anchor of; last < first if none."""
        ends = self.starts[1:][self.docs]
        return np.maximum(self.grams - self.gaps + 1, self.grams + GRAM - self.length), np.minimum(self.grams, ends - self.length)

    def bare_windows(self) -> np.ndarray:
        """Starts of windows without any anchor."""
        n = len(self.data)
        if n < self.length:
            return np.zeros(0, np.int64)
        held = np.zeros(n + 1, np.int32)
        held += np.bincount(np.maximum(self.grams + GRAM - self.length, self.starts[:-1][self.docs]), minlength=n + 1).astype(np.int32)
        held -= np.bincount(self.grams + 1, minlength=n + 1).astype(np.int32)
        free = np.cumsum(held[:-1]) == 0
        sizes = np.diff(self.starts)
        until = np.repeat(self.starts[1:] - self.length, sizes)
        return np.flatnonzero(free & (np.arange(n) <= until))


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges first..last, and the range of each."""
    sizes = np.maximum(last - first + 1, 0)
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes), of


def _batch(schema: dict[str, pa.DataType], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.values(), strict=True)], names=list(schema))


PHRASES = {"name": pa.int64(), "rid": pa.int64(), "idx": pa.int32(), "len": pa.int32(), "far": pa.bool_()}
_PHRASES = "name long, rid long, idx int, len int, far boolean"


def phrases(rows: DataFrame, length: int) -> DataFrame:
    """(name, rid, idx, len, far) of every phrase of rows (rid, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column("rid").to_numpy()
            for part, data, starts in text_slices(batch, "text"):
                b = Bytes(data, starts, length)
                yield _batch(PHRASES, b.names(), rids[part][b.docs], b.ordinal, b.lengths, b.far())

    return rows.mapInArrow(cut, _PHRASES)


def _sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by the keys, so that equal rows never fall into two batches."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = not waiting or any(waiting[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys)
        at = np.flatnonzero(new)
        if len(at):
            if at[-1] or waiting:
                yield pa.Table.from_batches([*waiting, batch.slice(0, at[-1])]).combine_chunks().to_batches()[0] if waiting or at[-1] else batch
            waiting = [batch.slice(at[-1])]
        else:
            waiting.append(batch)
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def _repeat_marks(batch: pa.RecordBatch, key: str) -> tuple[np.ndarray, np.ndarray]:
    """Whether a row's key has another row next to it, and whether one before it."""
    values = batch.column(key).to_numpy()
    same = values[1:] == values[:-1]
    before = np.concatenate([[False], same])
    return before | np.concatenate([same, [False]]), before


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def kept_phrases(found: DataFrame) -> DataFrame:
    """(rid, marks: sorted list of (idx, name, len, shared)) of phrases that occur twice or are far."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sorted_groups(batches, ["name"]):
            shared, _ = _repeat_marks(batch, "name")
            chosen = shared | batch.column("far").to_numpy(zero_copy_only=False).astype(bool)
            yield _batch(
                {"rid": pa.int64(), "idx": pa.int32(), "name": pa.int64(), "len": pa.int32(), "shared": pa.bool_()},
                *(batch.column(n).to_numpy()[chosen] for n in ("rid", "idx", "name", "len")), shared[chosen],
            )

    rows = found.repartition(_parts(found), "name").sortWithinPartitions("name").mapInArrow(keep, "rid long, idx int, name long, len int, shared boolean")
    return rows.groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("idx", "name", "len", "shared"))).alias("marks"))


class Strings:
    """The kept phrases of a batch of documents as one flat string; positions never reach past a run of shared phrases."""

    def __init__(self, batch: pa.RecordBatch, length: int):
        marks = batch.column("marks")
        fields = marks.flatten()
        self.idx, self.name, self.len = (fields.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("idx", "name", "len"))
        self.shared = fields.field("shared").to_numpy(zero_copy_only=False).astype(bool)
        sizes = marks.value_lengths().to_numpy()
        self.sizes = sizes
        self.rid = np.repeat(batch.column("rid").to_numpy(), sizes)
        self.length = length
        n = len(self.idx)
        row = np.repeat(np.arange(len(sizes)), sizes)
        joined = np.zeros(n, bool)
        joined[:-1] = (row[1:] == row[:-1]) & (self.idx[1:] == self.idx[:-1] + 1) & self.shared[1:] & self.shared[:-1]
        stop = np.where(joined, n, np.arange(n))
        self.run_end = np.minimum.accumulate(stop[::-1])[::-1] if n else stop
        self.left = np.where(self.shared, self.run_end - np.arange(n) + 1, 0)
        self.cum = np.concatenate([[0], np.cumsum(self.len)])
        self.sampled = self.shared & (self.idx % 3 != 0)
        power, self._inverse = powers(n + 1)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(self.name.astype(np.uint64)) * power[:n], dtype=np.uint64)])

    def phrases_for(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """How many phrases from a position span so many bytes; 0 if its run is shorter."""
        want = np.maximum(np.searchsorted(self.cum, self.cum[at] + size - GRAM) - at, 1)
        return np.where(want <= self.left[at], want, 0)

    def print_of(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Fingerprints of the names of so many phrases; 0 for none."""
        found = mixed((self._sums[at + count] - self._sums[at]) * self._inverse[at] + count.astype(np.uint64)).astype(np.int64)
        return np.where(count > 0, found, 0)


TRIPLES = {"a": pa.int64(), "b": pa.int64(), "c": pa.int64(), "rid": pa.int64(), "idx": pa.int32()}


def _column(batch: pa.RecordBatch, name: str, s: Strings) -> np.ndarray:
    """Values by (idx, value) lists of the documents, as an array over the flat string; 0 where there is none."""
    out = np.zeros(len(s.idx), np.int64)
    lists = batch.column(name).fill_null([])
    fields, sizes = lists.flatten(), lists.value_lengths().to_numpy()
    if not len(fields):
        return out
    step = int(s.idx.max(initial=0)) + 2
    rows = np.repeat(np.arange(len(s.sizes)), s.sizes) * step + s.idx
    own = np.repeat(np.arange(len(sizes)), sizes) * step + fields.field("idx").to_numpy(zero_copy_only=False)
    out[np.searchsorted(rows, own)] = fields.field("value").to_numpy(zero_copy_only=False)
    return out


def _triples(level: int, length: int):
    """Triples of names of the sampled positions that this level lengthens to 3 ** level phrases."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 3 ** (level - 1)
        for batch in batches:
            s = Strings(batch, length)
            at = np.flatnonzero(s.sampled)
            most = np.where(s.phrases_for(at, length) > 0, s.phrases_for(at, length), s.left[at])
            if level == 1:
                a = s.name[at]
                b, c = (np.where(most > k, s.name[np.minimum(at + k, len(s.name) - 1)], 0) if len(at) else a for k in (1, 2))
            else:
                names = _column(batch, "names", s)
                at, most = at[most > width], most[most > width]
                a = names[at]

                def part(k: int) -> np.ndarray:
                    to, count = np.minimum(at + k * width, len(s.name)), np.clip(most - k * width, 0, width)
                    whole = names[np.minimum(to, len(s.name) - 1)] if len(to) else to
                    return np.where((count == width) & (whole != 0), whole, s.print_of(to, count))

                b, c = part(1), part(2)
            yield _batch(TRIPLES, a, b, c, s.rid[at], s.idx[at])

    return emit


def ranked(triples: DataFrame, level: int) -> DataFrame:
    """(rid, idx, value): the rank of each triple among the distinct ones, marked with its level; sorted over all tasks."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, base = TaskContext.get().partitionId(), 0
        for batch in _sorted_groups(batches, ["a", "b", "c"]):
            columns = [batch.column(n).to_numpy() for n in "abc"]
            new = np.zeros(batch.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            place = base + np.cumsum(new)
            base = int(place[-1]) + 1
            kinds = {"part": pa.int32(), "place": pa.int64(), "rid": pa.int64(), "idx": pa.int32()}
            yield _batch(kinds, np.full(len(place), part), place, batch.column("rid"), batch.column("idx"))

    in_order = triples.repartitionByRange(_parts(triples), "a", "b", "c").sortWithinPartitions("a", "b", "c")
    placed = stored(in_order.mapInArrow(number, "part int, place long, rid long, idx int"), "ranks")
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg((F.max("place") + 1).alias("n")).collect())
    before, offsets = 1, []
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    table = placed.sparkSession.createDataFrame(offsets, "part int, before long")
    value = (F.col("place") + F.col("before")) * 8 + level
    return placed.join(F.broadcast(table), "part").select("rid", "idx", value.alias("value"))


def named(strings: DataFrame, length: int) -> DataFrame:
    """The strings with names: (idx, value) of every sampled position, spanning `length` bytes where its run does."""
    out, level = strings.withColumn("names", F.lit(None).cast("array<struct<idx:int,value:long>>")), 1
    while 3 ** (level - 1) <= length:
        triples = stored(out.mapInArrow(_triples(level, length), "a long, b long, c long, rid long, idx int"), "triples")
        if not triples.take(1):
            return out
        new = ranked(triples, level).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("new"))
        joined = out.join(new, "rid", "left")
        kept = F.filter("names", lambda x: ~F.array_contains(F.coalesce(F.col("new.idx"), F.array().cast("array<int>")), x["idx"])) if level > 1 else None
        names = F.col("new") if kept is None else F.array_sort(F.concat(F.coalesce(kept, F.array().cast("array<struct<idx:int,value:long>>")), F.coalesce("new", F.array().cast("array<struct<idx:int,value:long>>"))))
        out = stored(joined.withColumn("names", names).drop("new"), "named")
        level += 1
    return out


def _forms(length: int):
    """Keys of the suffixes in the forms that their position modulo 3 has; two suffixes that repeat share one."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = Strings(batch, length)
            names = np.concatenate([_column(batch, "names", s), [0, 0]])
            whole = np.concatenate([s.phrases_for(np.arange(len(s.idx)), length) * s.sampled, [0, 0]])
            names = np.where(whole > 0, names, 0).astype(np.uint64)
            at = np.flatnonzero(s.shared & (s.left > 1))
            first, second = s.name[at].astype(np.uint64), s.name[np.minimum(at + 1, len(s.name) - 1)].astype(np.uint64)
            residue = s.idx[at] % 3
            out: list[tuple[np.ndarray, np.ndarray]] = []
            use = (residue != 2) & (names[at + 1] != 0)
            out.append((mixed(mixed(first + np.uint64(1)) + names[at + 1])[use], at[use]))
            use = (residue != 1) & (s.left[at] > 2) & (names[at + 2] != 0)
            out.append((mixed(mixed(mixed(first + np.uint64(2)) + second) + names[at + 2])[use], at[use]))
            want = s.phrases_for(at, s.len[at] + length)
            use = (residue != 0) & (names[at] != 0) & (want > 0)
            more = np.where(use, want - whole[at], 0)
            tail = s.print_of(at + np.where(use, whole[at], 0), np.maximum(more, 0)).astype(np.uint64)
            out.append((mixed(mixed(names[at] + np.uint64(3)) + tail)[use], at[use]))
            keys, places = np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])
            yield _batch({"key": pa.int64(), "rid": pa.int64(), "idx": pa.int32()}, keys.astype(np.int64), s.rid[places], s.idx[places])

    return emit


def _adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted suffix keys, those that equal an adjacent one; later: whether an equal one comes before."""
    for batch in _sorted_groups(batches, ["key"]):
        again, later = _repeat_marks(batch, "key")
        yield _batch({"rid": pa.int64(), "idx": pa.int32(), "later": pa.bool_()}, batch.column("rid").to_numpy()[again], batch.column("idx").to_numpy()[again], later[again])


def repeated_suffixes(strings: DataFrame, length: int) -> DataFrame:
    """(rid, spans: (idx, later)): phrases from which bytes repeat up to `length` past the next anchor."""
    keys = strings.mapInArrow(_forms(length), "key long, rid long, idx int")
    sorted_keys = keys.repartition(_parts(keys), "key").sortWithinPartitions("key", "rid", "idx")
    equal = sorted_keys.mapInArrow(_adjacent, "rid long, idx int, later boolean")
    return equal.groupBy("rid", "idx").agg(F.max("later").alias("later")).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("idx", "later"))).alias("spans"))


def _witnesses(length: int):
    """The first gram of every phrase whose windows stay open (copy false), and of first copies of repeats (copy true)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = Strings(batch, length)
            lists = batch.column("spans").fill_null([])
            fields, sizes = lists.flatten(), lists.value_lengths().to_numpy()
            step = int(s.idx.max(initial=0)) + 3
            rows = np.repeat(np.arange(len(s.sizes)), s.sizes) * step + s.idx
            own = np.repeat(np.arange(len(sizes)), sizes) * step + fields.field("idx").to_numpy(zero_copy_only=False) + 1
            later = fields.field("later").to_numpy(zero_copy_only=False).astype(bool)
            closed = np.isin(rows, own)
            copy = np.isin(rows, own[~later])
            at = np.flatnonzero(~closed | copy)
            gram = (s.name[at].astype(np.uint64) >> np.uint64(64 - GRAM_BITS)).astype(np.int32)
            yield _batch({"gram": pa.int32(), "rid": pa.int64(), "idx": pa.int32(), "copy": pa.bool_()}, gram, s.rid[at], s.idx[at], copy[at])

    return emit


def marks_of(rows: DataFrame, length: int) -> DataFrame:
    """(rid, shared, closed, copies): phrases that occur twice; those whose windows all repeat; those of them compared once more as copies."""
    strings = stored(kept_phrases(phrases(rows, length)), "strings")
    suffixes = named(strings, length)
    spans = stored(repeated_suffixes(suffixes, length), "spans")
    both = strings.join(spans, "rid", "left")
    grams = stored(both.mapInArrow(_witnesses(length), "gram int, rid long, idx int, copy boolean"), "grams")
    open_grams = grams.filter("not copy").select("gram").distinct()
    copies = grams.filter("copy").join(open_grams, "gram", "left_semi").groupBy("rid").agg(F.collect_list("idx").alias("copies"))
    shared = F.transform(F.filter("marks", lambda m: m["shared"]), lambda m: m["idx"])
    closed = F.transform("spans", lambda m: m["idx"] + 1)
    return stored(both.select("rid", shared.alias("shared"), closed.alias("closed")).join(copies, "rid", "left"), "marks")


def _lists(batch: pa.RecordBatch, name: str, part: slice, b: Bytes) -> np.ndarray:
    """Whether a phrase of the slice is in its document's list."""
    lists = batch.column(name).slice(part.start, part.stop - part.start).fill_null([])
    step = int(b.ordinal.max(initial=0)) + 2
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    own = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()) * step + np.minimum(values, step - 1)
    return np.isin(b.docs * step + b.ordinal, own)


def _open_windows(length: int):
    """Fingerprints (key, rid, place) of the windows that the suffix sort leaves open, and of copies to hold them against."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column("rid").to_numpy()
            for part, data, starts in text_slices(batch, "text"):
                b = Bytes(data, starts, length)
                shared, closed, copy = (_lists(batch, n, part, b) for n in ("shared", "closed", "copies"))
                first, last = b.windows()
                # a window that holds a whole phrase that occurs once is unique
                count = len(b.docs)
                stop = np.where(shared | b.last, np.iinfo(np.int64).max, b.stops)
                same = np.concatenate([b.docs[1:] == b.docs[:-1], [False]])[:count]
                until = _next_stops(stop, same)
                last = np.where(closed, last, np.minimum(last, until - length - 1))
                use = ~closed | copy
                places, of = _ranges(first[use], last[use])
                docs = b.docs[use][of]
                bare = b.bare_windows()
                places = np.concatenate([places, bare])
                docs = np.concatenate([docs, np.searchsorted(starts, bare, "right") - 1])
                keys = b.print_of(places, places + length).astype(np.int64)
                yield _batch({"key": pa.int64(), "rid": pa.int64(), "place": pa.int32()}, keys, rids[part][docs], places - starts[docs])

    return emit


def _next_stops(stop: np.ndarray, same: np.ndarray) -> np.ndarray:
    """The first finite stop at or after each position, within its document."""
    n = len(stop)
    if not n:
        return stop
    finite = stop != np.iinfo(np.int64).max
    at = np.minimum.accumulate(np.where(finite, np.arange(n), n)[::-1])[::-1]
    ends = np.minimum.accumulate(np.where(same, n, np.arange(n))[::-1])[::-1]
    return np.where(at <= ends, stop[np.minimum(at, n - 1)], np.iinfo(np.int64).max)


def _equal_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sorted_groups(batches, ["key"]):
        again, _ = _repeat_marks(batch, "key")
        yield _batch({"rid": pa.int64(), "place": pa.int32()}, batch.column("rid").to_numpy()[again], batch.column("place").to_numpy()[again])


RESULT = "n_bytes long, n_removed long, spans array<struct<start:long,length:long>>, kept"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def _removal(length: int, carried: list[str], as_text: bool):
    """Result rows; as text, the remaining bytes are without characters that a cut goes through."""
    kinds = (pa.int64(), pa.int64(), _SPANS, pa.string() if as_text else pa.binary())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            twin = batch.column("twin").to_numpy(zero_copy_only=False).astype(bool)
            repeated = batch.column("places").fill_null([])
            for part, data, starts in text_slices(batch, "text"):
                b = Bytes(data, starts, length)
                closed = _lists(batch, "closed", part, b)
                first, last = b.windows()
                places = _ranges(first[closed], last[closed])[0]
                lists = repeated.slice(part.start, part.stop - part.start)
                found = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(starts[:-1], lists.value_lengths().to_numpy())
                edge = np.zeros(len(data) + 1, np.int32)
                for at in (places, found):
                    edge += np.bincount(at, minlength=len(data) + 1).astype(np.int32)
                    edge -= np.bincount(at + length, minlength=len(data) + 1).astype(np.int32)
                gone = np.cumsum(edge)[:-1] > 0
                rows: list[tuple] = []
                for i in range(len(starts) - 1):
                    own, bytes_ = gone[starts[i] : starts[i + 1]], data[starts[i] : starts[i + 1]]
                    if twin[part][i] and len(own) >= length:
                        own = np.ones(len(own), bool)
                    change = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                    spans = [{"start": int(x), "length": int(y - x)} for x, y in zip(change[::2], change[1::2], strict=True)]
                    left = bytes_[~own].tobytes() if spans else bytes_.tobytes()
                    rows.append((len(own), int(own.sum()), spans, left.decode("utf-8", "ignore") if as_text else left))
                kept = [batch.column(c).slice(part.start, part.stop - part.start) for c in carried]
                made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*carried, "n_bytes", "n_removed", "spans", "kept"])

    return emit


def removed(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, carry: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """The carried columns (the key unless named), n_bytes, n_removed, spans and kept: removed spans and remaining bytes or text."""
    carry = [key] if carry is None else carry
    names = [f"column_{i}" for i in range(len(carry))]
    source = documents.select(
        F.xxhash64(F.col(key), F.col(text)).alias("rid"), F.col(text).cast("string").alias("text"), *[F.col(c).alias(n) for c, n in zip(carry, names, strict=True)]
    )
    marks = marks_of(source.select("rid", "text"), length)
    twins = source.groupBy("rid").count().filter("count > 1").select("rid", F.lit(True).alias("twin"))
    # one shuffle of the texts, which both passes over them use
    marked = source.join(marks, "rid", "left")
    windows = marked.mapInArrow(_open_windows(length), "key long, rid long, place int")
    equal = windows.repartition(_parts(windows), "key").sortWithinPartitions("key").mapInArrow(_equal_windows, "rid long, place int")
    places = equal.groupBy("rid").agg(F.collect_set("place").alias("places"))
    whole = marked.join(places, "rid", "left").join(twins, "rid", "left").withColumn("twin", F.coalesce("twin", F.lit(False)))
    kinds = [f"{n} {source.schema[n].dataType.simpleString()}" for n in names]
    out = whole.mapInArrow(_removal(length, names, as_text), ", ".join([*kinds, f"{RESULT} {'string' if as_text else 'binary'}"]))
    return out.withColumnsRenamed(dict(zip(names, carry, strict=True)))


def deduplicated(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """`documents` with the repeated bytes removed from the text; a character that a cut goes through is dropped."""
    carry = [c for c in documents.columns if c != text]
    # the task that removes also decodes: a second Python worker beside it would hold the texts once more
    return removed(documents, key, text, length, carry, as_text=True).withColumnRenamed("kept", text).select(*documents.columns)

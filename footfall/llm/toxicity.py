"""Toxicity: class-conditional Kneser-Ney models of toxic and ordinary text.

An n-gram is a word or a word with its whole left neighbour. Each class has an interpolated Kneser-Ney bigram model of
all occurrences in its labelled texts: discounted bigram counts, backing off to discounted word counts, backing off to
the continuation counts (distinct left neighbours in all documents) that both classes share. Discounts are absolute,
below 1, and come from the counts of counts of each class.

The evidence of an n-gram is the log ratio of the two models, weighed by how sure its preference is: a logistic of the
likelihood ratio statistic of its labelled documents by class, less what the spread of languages and subjects explains.
A bigram that is not sure falls back to its word, and a word that is not sure to none. A preference of any size counts
once enough documents show it, whatever the share of toxic text. N-gram counts and evidence are Spark tables that grow
with the input; documents are joined to the evidence. Only totals and a bit map of the evidence's keys reach the driver.

A document's score is a calibrated logistic of the sum of its evidence over the square root of its length; the
calibration is fitted on labelled rows scored by models of the other half of the labelled rows.

Defined results: null, empty and blank texts have a difference of 0; repeated rows are scored alike; without rows of
one class the score is 1 or 0 for all, without any 0.5; columns other than key and text never reach a score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.ngram_join import few_or_all
from footfall.llm.quality_classifier import logistic
from footfall.llm.shared import give_back, mixed, stored, text_slices, word_hashes

#: N-grams that a task gathers before it adds up equal ones (48 bytes each, and as much again while they are sorted); few
#: are equal, and the aggregation that follows adds up what is left.
GATHERED = 1 << 19
#: Distinct n-grams of those that a task gathers before it shortens them (17 bytes each, and some times as much while they are sorted).
SHORTENED = 3 << 19
#: N-grams are dealt to a bucket for each so many words of all texts, or one a partition; a task adds up one bucket at a time.
BUCKET_WORDS = 1 << 21
#: Occurrences in a run of BUCKET_WORDS words from which a word may get a short number; the number of words that have none.
OFTEN, RARE = 4, (1 << 16) - 1
#: So many of the most frequent words are dealt to up to SIDES buckets each, by left neighbour.
OFTENEST, SIDES = 1 << 8, 64
#: N-grams that a task passes on at once.
EMITTED = 1 << 16
#: The statistic at which evidence counts half; the spread of log frequencies between languages and subjects. Chosen on
#: rows that may be learnt from alone: of (4, 7, 10, 14) x (0.1, 0.3, 0.6) the pair under which each half of 2,636 labelled
#: rows is best scored by the model of the other half (AUC 0.972, log loss 0.059).
SURE, SPREAD = 10.0, 0.6
#: Evidence of a smaller weight is taken as none.
LEAST_WEIGHT = 0.01
#: The left neighbour of a text's first word; that of rows that count a word alone.
START, ALONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0)
#: Bits of the key map for each key of the evidence.
MAP_BITS = 16
#: Bits that a key sets in the map: of other n-grams, 0.25 % at most have all of them set.
KEY_PLACES = 4
#: Roles (label + 2 * half) of the ordinary and the toxic texts that a model learns from: all, those of each half.
MODELS = (((0, 2), (1, 3)), ((0,), (1,)), ((2,), (3,)))

_MARK = ~((_c := np.arange(256)) >= 128) & ~np.isin(_c, list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
PACKS = ("n01", "n23", "d01", "d23")
#: Counts of an n-gram that a text of each role has once; the kind of all others.
_ONE = np.array([[1, 0, 1, 0], [1 << 32, 0, 1 << 32, 0], [0, 1, 0, 1], [0, 1 << 32, 0, 1 << 32]], np.int64)
MORE = 255
COUNTED = "prev long, word long, " + ", ".join(f"{p} long" for p in PACKS)


def tokens(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of each text and of their left neighbours, and their texts. Case and marks around words don't count."""
    words, docs = word_hashes(np.where(_MARK[data], np.uint8(32), data), starts)
    before = np.concatenate([words[:1], words[:-1]])
    before[np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])[: len(docs)])] = START
    return words, before, docs


def gram_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A 64-bit key of each n-gram."""
    return mixed(words + mixed(before + np.uint64(1)))


def _added(before: np.ndarray, words: np.ndarray, packs: np.ndarray) -> pa.RecordBatch:
    """One row for equal n-grams; packs: a column each."""
    order = np.argsort(gram_keys(before, words), kind="stable")
    before, words, packs = before[order], words[order], packs[order]
    first = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (before[1:] != before[:-1])])[: len(words)])
    sums = np.add.reduceat(packs, first, axis=0) if len(first) else packs
    columns = [before[first].view(np.int64), words[first].view(np.int64), *(np.ascontiguousarray(sums[:, i]) for i in range(len(PACKS)))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["prev", "word", *PACKS])


def _packs(role: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
    """Occurrences and documents by role, 32 bits each."""
    out = np.zeros((len(role), len(PACKS)), np.int64)
    for r in range(4):
        of = role == r
        out[of, r // 2] = occurrences[of] << 32 * (r % 2)
        out[of, 2 + r // 2] = 1 << 32 * (r % 2)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (role, text): all bigrams, and the words of labelled texts, with their counts by role."""
    waiting: list[tuple] = []
    size = 0
    for batch in batches:
        roles = batch.column("role").to_numpy(zero_copy_only=False)
        for part, data, starts in text_slices(batch, "text"):
            words, before, docs = tokens(data, starts)
            known = roles[part][docs] >= 0
            words, docs = np.concatenate([words, words[known]]), np.concatenate([docs, docs[known]])
            before = np.concatenate([before, np.full(int(known.sum()), ALONE)])
            if not len(words):
                continue
            order = np.lexsort((gram_keys(before, words), docs))
            words, before, docs = words[order], before[order], docs[order]
            new = np.concatenate([[True], (words[1:] != words[:-1]) | (before[1:] != before[:-1]) | (docs[1:] != docs[:-1])])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(words)))
            waiting.append((before[first], words[first], _packs(roles[part][docs[first]], times)))
            size += len(first)
            if size > GATHERED:
                yield _added(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
                waiting, size = [], 0
    if waiting:
        yield _added(*(np.concatenate(x) for x in zip(*waiting, strict=True)))


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text): the words that a run of texts has OFTEN times or more, and a row ALONE with the number of its words."""
    waiting: list[np.ndarray] = []
    size = 0

    def found() -> pa.RecordBatch:
        words, times = np.unique(np.concatenate(waiting), return_counts=True)
        some = times >= OFTEN
        words, times = np.append(words[some], ALONE), np.append(times[some], size)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(times.astype(np.int64))], names=["word", "n"])

    for batch in batches:
        for _, data, starts in text_slices(batch, "text"):
            waiting.append(tokens(data, starts)[0])
            size += len(waiting[-1])
            if size > BUCKET_WORDS:
                yield found()
                waiting, size = [], 0
    if waiting:
        yield found()


@dataclass
class Short:
    """Two-byte numbers of frequent words, the most frequent first; other words are RARE and keep their hashes."""

    words: np.ndarray

    def __post_init__(self):
        self.order = np.argsort(self.words)
        self.sorted = self.words[self.order]

    def numbers(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
        return np.where(self.sorted[at] == words, self.order[at], RARE).astype(np.uint16)


def frequent(texts: DataFrame) -> tuple[Short, int]:
    """The frequent words, and the number of all words. How well they are chosen changes what is shuffled, not what is counted."""
    words = texts.mapInArrow(_often, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # no word is more frequent than all words together
    first = words.orderBy(F.desc("n"), F.col("word") != 0, "word").limit(RARE - 1).toArrow()
    if not first.num_rows:
        return Short(np.array([ALONE, START])), 0
    often = first.column("word").to_numpy()[1:].view(np.uint64)
    return Short(np.concatenate([[ALONE, START], often[often != START]])), first.column("n")[0].as_py()


def _planes(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second bytes, and so on."""
    return np.frombuffer(x.tobytes(), np.uint8).reshape(len(x), x.nbytes // max(1, len(x))).T.tobytes()


def _from_planes(data: np.ndarray, kind: type, width: int = 1) -> np.ndarray:
    size = np.dtype(kind).itemsize * width
    return np.ascontiguousarray(data.reshape(size, -1).T).view(kind).reshape((-1, width) if width > 1 else -1)


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences to the number before, modulo their range."""
    return np.diff(x, prepend=x.dtype.type(0))


def _kinds(packs: np.ndarray) -> np.ndarray:
    """0 without labels, 1 + role for one occurrence in a text of this role, MORE for other counts."""
    kinds = np.where(packs.any(axis=1), MORE, 0).astype(np.uint8)
    for r, one in enumerate(_ONE):
        kinds[(packs == one).all(axis=1)] = 1 + r
    return kinds


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """prev, word, kind and counts of kind MORE of several parts -> prev and word of distinct n-grams, by word; which of them have labels, and their counts."""
    prev, word, kinds, more = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    order = np.lexsort((prev, word))
    prev, word, kinds = prev[order], word[order], kinds[order]
    new = np.concatenate([[True], (word[1:] != word[:-1]) | (prev[1:] != prev[:-1])])[: len(word)]
    known = np.flatnonzero(kinds)
    packs = _ONE[np.minimum(kinds[known] - 1, len(_ONE) - 1)]
    # the counts of kind MORE are in the order of the rows
    several = order[known[kinds[known] == MORE]]
    packs[kinds[known] == MORE] = more[np.argsort(np.argsort(several))]
    gram = np.cumsum(new)[known] - 1
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])[: len(gram)])
    return prev[new], word[new], gram[first], np.add.reduceat(packs, first, axis=0) if len(first) else packs


def _short_rows(parts: list[tuple[np.ndarray, ...]], short: Short, buckets: int) -> pa.RecordBatch:
    prev, word, known, counts = _summed(parts)
    kinds = np.zeros(len(word), np.uint8)
    kinds[known] = _kinds(counts)
    place = np.zeros(len(word), np.int64)
    place[known] = np.arange(len(known))
    left, own = short.numbers(prev), short.numbers(word)
    side = np.where(own < OFTENEST, mixed(prev) % np.uint64(SIDES), np.uint64(0))
    bucket = (mixed(word + mixed(side + np.uint64(1))) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((left, word, bucket << 16 | own))
    prev, word, kinds, left, own, bucket, place = prev[order], word[order], kinds[order], left[order], own[order], bucket[order], place[order]
    new = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (bucket[1:] != bucket[:-1])])[: len(word)])
    found, starts = np.unique(bucket, return_index=True)
    rows = []
    for first, end in zip(starts, np.append(starts[1:], len(word)), strict=True):
        heads = new[np.searchsorted(new, first) : np.searchsorted(new, end)]
        here = slice(first, end)
        rare_words, rare_left = word[heads][own[heads] == RARE], prev[here][left[here] == RARE]
        more = counts[place[here][kinds[here] == MORE]]
        sizes = np.array([len(heads), end - first, len(rare_words), len(rare_left), len(more)], np.uint32)
        data = [sizes.tobytes(), _planes(_steps(own[heads])), _planes(np.diff(np.append(heads, end)).astype(np.uint32)), _planes(_steps(rare_words))]
        data += [_planes(_steps(left[here])), _planes(rare_left), kinds[here].tobytes(), _planes(more)]
        raw = b"".join(data)
        rows.append(len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True))
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(rows, pa.binary())], names=["bucket", "data"])


def shortened(grams: Iterable[pa.RecordBatch], short: Short, buckets: int) -> Iterator[pa.RecordBatch]:
    """Counted n-grams -> (bucket, data): those of a bucket, by word. Equal n-grams have the same bucket.

    The n-grams of a word are in one bucket, those of the most frequent ones in up to SIDES buckets.
    """
    waiting: list[tuple] = []
    size = 0
    for batch in grams:
        packs = np.column_stack([batch.column(x).to_numpy() for x in PACKS])
        kinds = _kinds(packs)
        waiting.append((*(batch.column(x).to_numpy().view(np.uint64) for x in ("prev", "word")), kinds, packs[kinds == MORE]))
        size += batch.num_rows
        if size > SHORTENED:
            yield _short_rows(waiting, short, buckets)
            waiting, size = [], 0
    if size:
        yield _short_rows(waiting, short, buckets)
    give_back()


def lengthened(data: bytes, short: Short) -> tuple[np.ndarray, ...]:
    """prev, word and kind of the n-grams of a row of `shortened`, and the counts of those of kind MORE."""
    raw = np.frombuffer(pa.decompress(data[4:], decompressed_size=int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True), np.uint8)
    n_heads, n, n_words, n_left, n_more = (int(x) for x in raw[:20].view(np.uint32))
    ends = np.cumsum([20, 2 * n_heads, 4 * n_heads, 8 * n_words, 2 * n, 8 * n_left, n, 8 * len(PACKS) * n_more])
    part = [raw[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]

    def hashes(steps: np.ndarray, rare: np.ndarray) -> np.ndarray:
        numbers = np.cumsum(_from_planes(steps, np.uint16), dtype=np.uint16)
        out = short.words[np.minimum(numbers, len(short.words) - 1)]
        out[numbers == RARE] = rare
        return out

    heads = hashes(part[0], np.cumsum(_from_planes(part[2], np.uint64), dtype=np.uint64))
    words = np.repeat(heads, _from_planes(part[1], np.uint32))
    return hashes(part[3], _from_planes(part[4], np.uint64)), words, part[5], _from_planes(part[6], np.int64, len(PACKS))


def _together(rows: list[bytes], short: Short) -> Iterator[pa.RecordBatch]:
    """All rows of a bucket -> n-grams of labelled texts with cont 0, and rows (ALONE, word) with the number of left neighbours as cont."""
    prev, word, known, counts = _summed([lengthened(r, short) for r in rows])
    pairs = word[prev != ALONE]
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])[: len(pairs)])
    cont = np.diff(np.append(starts, len(pairs)))
    labelled = [prev[known], word[known], *counts.T, np.zeros(len(known), np.int64)]
    neighbours = [np.zeros(len(starts), np.int64), pairs[starts], *np.zeros((len(PACKS), len(starts)), np.int64), cont]
    for columns in (labelled, neighbours):
        whole = pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).view(np.int64)) for c in columns], names=["prev", "word", *PACKS, "cont"])
        for at in range(0, whole.num_rows, EMITTED):
            yield whole.slice(at, EMITTED)


def _merged(batches: Iterator[pa.RecordBatch], short: Short) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, data), sorted: `_together` of each bucket."""
    waiting: list[bytes] = []
    now = None
    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
            if bucket != now and waiting:
                yield from _together(waiting, short)
                waiting = []
            now = bucket
            waiting.append(data)
    if waiting:
        yield from _together(waiting, short)
    give_back()


def counts(marked: DataFrame) -> DataFrame:
    """(prev, word, n0 .. n3, d0 .. d3, cont) of the n-grams of labelled texts: occurrences and documents by role; rows with cont add up by word."""
    spark = marked.sparkSession
    short, n_words = frequent(marked.select("text"))
    sent = spark.sparkContext.broadcast(short)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, n_words // BUCKET_WORDS)
    rows = marked.mapInArrow(lambda batches: shortened(_count(batches), sent.value, buckets), "bucket int, data binary")
    dealt = rows.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket")
    split = stored(dealt.mapInArrow(lambda batches: _merged(batches, sent.value), f"{COUNTED}, cont long"), "counts")
    unpacked = [F.expr(f"{p}{k} & 4294967295L" if not r % 2 else f"shiftrightunsigned({p}{k}, 32)").alias(f"{p}{r}") for p in "nd" for r, k in enumerate(("01", "01", "23", "23"))]
    return split.select("prev", "word", *unpacked, "cont")


def _of(kind: str, roles: tuple[int, ...]) -> Column:
    return reduce(lambda x, y: x + y, [F.col(f"{kind}{r}") for r in roles])


def _weight(d: tuple[Column, Column], texts: tuple[int, int]) -> Column:
    """How sure it is that the classes differ, of the documents with the n-gram and all labelled documents by class."""
    both, every = d[0] + d[1], sum(texts)
    terms = [F.when(x > 0, x * F.log(x * every / (both * n))).otherwise(0.0) for x, n in zip(d, texts, strict=True)]
    statistic = 2 * (terms[0] + terms[1]) / (1 + SPREAD**2 / (1 / (d[0] + 0.5) + 1 / (d[1] + 0.5)))
    return 1 / (1 + F.exp(SURE - statistic))


def discount(once: int, twice: int) -> float:
    """The absolute discount, from the numbers of n-grams seen once and twice."""
    return min(0.95, once / (once + 2 * twice)) if once else 0.5


def evidence(counted: DataFrame, texts: list[int]) -> DataFrame:
    """(gram, e0, e1, e2): what an n-gram adds to the log ratio under each of MODELS; that of a bigram adds to its word's.

    texts: number of labelled texts by role.
    """
    alone = F.col("prev") == 0
    sides = [(m, c, roles) for m, of in enumerate(MODELS) for c, roles in enumerate(of)]
    sums = [F.sum(F.when(alone, F.col("cont"))).alias("cont")]
    for m, c, roles in sides:
        n = _of("n", roles)
        for level, here in (("w", alone), ("b", ~alone)):
            sums += [F.sum(F.when(here, n)).alias(f"n{level}{m}{c}")] + [
                F.count_if(here & of).alias(f"{kind}{level}{m}{c}") for kind, of in (("types", n > 0), ("once", n == 1), ("twice", n == 2))
            ]
    total = counted.agg(*sums).first().asDict()
    size = {k: v or 0 for k, v in total.items()}
    of_class = [[sum(texts[r] for r in roles) for roles in of] for of in MODELS]
    usable = [m for m in range(len(MODELS)) if size[f"nw{m}0"] and size[f"nw{m}1"]]
    weights = [_weight(tuple(_of("d", roles) for roles in MODELS[m]), tuple(of_class[m])) if m in usable else F.lit(0.0) for m in range(len(MODELS))]
    weighed = counted.filter(F.greatest("d0", "d1", "d2", "d3") > 0).withColumns({f"w{m}": w for m, w in enumerate(weights)})
    sure = stored(weighed.filter(F.greatest("w0", "w1", "w2") >= LEAST_WEIGHT), "sure")
    pairs = sure.filter(~alone)

    # of the words and of the left neighbours of sure n-grams
    needed = few_or_all(stored(sure.select("word").distinct(), "words"))
    add = [F.sum(f"{k}{r}").alias(f"{k}{r}") for k in "nd" for r in range(4)]
    words = counted.filter(alone).join(needed, "word", "left_semi").groupBy("word").agg(*add, F.sum("cont").alias("cont"))
    words = words.withColumns({f"w{m}": w for m, w in enumerate(weights)})
    contexts = few_or_all(stored(pairs.select("prev").distinct(), "contexts"))
    seen = []
    for m, c, roles in sides:
        n = _of("n", roles)
        seen += [F.sum(n).alias(f"all{m}{c}"), F.count_if(n > 0).alias(f"types{m}{c}")]
    left = counted.filter(~alone).join(contexts, "prev", "left_semi").groupBy("prev").agg(*seen)

    def share(m: int, c: int, level: str) -> float:
        return discount(size[f"once{level}{m}{c}"], size[f"twice{level}{m}{c}"])

    known = {}
    for m, c, roles in sides:
        if m in usable:
            d, n = share(m, c, "w"), float(size[f"nw{m}{c}"])
            known[f"p{m}{c}"] = F.greatest(_of("n", roles) - d, F.lit(0.0)) / n + d * size[f"typesw{m}{c}"] / n * F.col("cont") / size["cont"]
    of_word = words.withColumns(known)
    own = {f"e{m}": F.when(F.col(f"w{m}") >= LEAST_WEIGHT, F.col(f"w{m}") * F.log(F.col(f"p{m}1") / F.col(f"p{m}0"))).otherwise(0.0) if m in usable else F.lit(0.0) for m in range(len(MODELS))}
    of_word = stored(of_word.withColumns(own).select("word", *own, *known), "of_word")

    joined = pairs.join(of_word.withColumnsRenamed({f"e{m}": f"word{m}" for m in range(len(MODELS))}), "word").join(left, "prev")
    gain = {}
    for m in range(len(MODELS)):
        if m not in usable:
            gain[f"e{m}"] = F.lit(0.0)
            continue
        p = []
        for c, roles in enumerate(MODELS[m]):
            d, seen_here = share(m, c, "b"), F.col(f"all{m}{c}")
            p.append(F.when(seen_here > 0, (F.greatest(_of("n", roles) - d, F.lit(0.0)) + d * F.col(f"types{m}{c}") * F.col(f"p{m}{c}")) / seen_here).otherwise(F.col(f"p{m}{c}")))
        gain[f"e{m}"] = F.when(F.col(f"w{m}") >= LEAST_WEIGHT, F.col(f"w{m}") * (F.log(p[1] / p[0]) - F.col(f"word{m}"))).otherwise(0.0)
    both = joined.withColumns(gain).select("prev", "word", *gain).unionByName(of_word.select(F.lit(0).cast("long").alias("prev"), "word", *own))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prev, word = (batch.column(x).to_numpy().view(np.uint64) for x in ("prev", "word"))
            yield pa.RecordBatch.from_arrays([pa.array(gram_keys(prev, word).view(np.int64)), *batch.columns[2:]], names=["gram", "e0", "e1", "e2"])

    found = both.filter("e0 != 0 or e1 != 0 or e2 != 0").mapInArrow(keyed, "gram long, e0 double, e1 double, e2 double")
    return stored(found, "evidence")


@dataclass
class Model:
    """Evidence of n-grams, a bit map of its keys; the logistic of its length-normalised sum."""

    evidence: DataFrame | None
    key_map: np.ndarray | None = None
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None


def _places(grams: np.ndarray, bits: int, turn: int) -> np.ndarray:
    """The place of each key in a map of 2**bits bits, another one in each turn."""
    return ((mixed(grams + np.array([turn], np.uint64) * START) if turn else grams) >> np.uint64(64 - bits)).astype(np.int64)


def key_map(grams: np.ndarray) -> np.ndarray:
    """A bit map that has KEY_PLACES places of each key; its size grows with the number of keys. Used to join few n-grams only."""
    bits = max(10, int(np.ceil(np.log2(max(1, len(grams)) * MAP_BITS))))
    out = np.zeros(1 << bits, bool)
    for turn in range(KEY_PLACES):
        out[_places(grams.view(np.uint64), bits, turn)] = True
    return np.packbits(out, bitorder="little")


def _held(key_bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Where the n-grams are that may have evidence: all that have, and a few others."""
    bits, held = (len(key_bits) * 8).bit_length() - 1, np.arange(len(grams))
    for turn in range(KEY_PLACES):
        at = _places(grams[held], bits, turn)
        held = held[(key_bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)]
    return held


def differences(source: DataFrame, model: Model, carried: str) -> DataFrame:
    """(carried, z0, z1, z2) of each row of source (carried, text): length-normalised sums of its evidence."""
    sent = source.sparkSession.sparkContext.broadcast(model.key_map)
    kind = source.schema[carried].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, starts in text_slices(batch, "text"):
                words, before, docs = tokens(data, starts)
                length = np.bincount(docs, minlength=len(starts) - 1)
                grams = np.concatenate([gram_keys(np.full(len(words), ALONE), words), gram_keys(before, words)])
                docs = np.concatenate([docs, docs])
                may = _held(sent.value, grams)
                may = may[np.argsort(docs[may], kind="stable")]
                ends = np.searchsorted(docs[may], np.arange(len(starts)))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(grams[may].view(np.int64)))
                rows_here = batch.column(carried).slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([rows_here, pa.array(length.astype(np.int64)), lists], names=[carried, "length", "grams"])

    listed = source.select(carried, "text").mapInArrow(rows, f"{carried} {kind}, length long, grams array<long>").withColumn("row", F.monotonically_increasing_id())
    single = listed.select("row", carried, "length", F.explode_outer("grams").alias("gram"))
    summed = single.join(model.evidence, "gram", "left").groupBy("row").agg(
        F.first(carried).alias(carried), F.first("length").alias("length"), *[F.sum(f"e{m}").alias(f"s{m}") for m in range(len(MODELS))]
    )
    # sums of rows in another order differ in their last digits
    return summed.select(carried, *[F.round(F.coalesce(F.col(f"s{m}"), F.lit(0.0)) / F.sqrt(F.greatest("length", F.lit(1))), 9).alias(f"z{m}") for m in range(len(MODELS))])


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label") -> Model:
    """labels: (key, label) with 0 or 1; every labelled row is learnt from."""
    known = labels.select(F.col(key).alias("key_"), F.col(label).cast("int").alias("label_")).filter("key_ is not null and label_ in (0, 1)").dropDuplicates(["key_"])
    roles = few_or_all(stored(known.selectExpr("key_", "label_ + 2 * cast(xxhash64(key_) & 1 as int) as role_"), "roles"))
    source = documents.select(F.col(key).alias("key_"), F.col(text).cast("string").alias("text"))
    marked = source.join(roles, "key_", "left").select(F.coalesce("role_", F.lit(-1)).alias("role"), "text")
    number = {r["role"]: r["count"] for r in source.select("key_").join(roles, "key_").groupBy(F.col("role_").alias("role")).count().collect()}
    texts = [number.get(r, 0) for r in range(4)]
    counted = counts(marked)
    found = counted.filter("prev = 0").agg(F.sum(F.col("n0") + F.col("n2")).alias("c0"), F.sum(F.col("n1") + F.col("n3")).alias("c1")).first()
    totals = [found["c0"] or 0, found["c1"] or 0]
    if not all(totals):
        return Model(None, constant=0.5 if not any(totals) else float(totals[1] > 0))
    model = Model(evidence(counted, texts))
    model.key_map = key_map(model.evidence.select("gram").toArrow().column("gram").to_numpy())

    # a half is scored by the model of the other half
    scored = differences(marked.filter("role >= 0"), model, "role").select(F.col("role"), F.when(F.col("role") < 2, F.col("z2")).otherwise(F.col("z1")).alias("z"))
    cell = F.round(F.greatest(F.lit(-20.0), F.least(F.lit(20.0), "z")) * 20).cast("int")
    found_cells = scored.groupBy((F.col("role") % 2).alias("label"), cell.alias("cell")).count().collect()
    z, y, w = (np.array(v, float) for v in zip(*[(r["cell"] / 20, r["label"], r["count"]) for r in found_cells], strict=True))
    model.slope, model.shift = logistic(z, y, w)
    return model


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every document."""
    source = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    if model.constant is not None:
        return source.select("key", F.lit(model.constant).alias("score"))
    z = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), model.slope * F.col("z0") + model.shift))
    return differences(source, model, "key").select("key", (1 / (1 + F.exp(-z))).alias("score"))


def classify(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """(key, score, predicted) of every document; labels: (key, label) to learn from."""
    return score(documents, fit(documents, labels, key, text), key, text).withColumn("predicted", (F.col("score") >= threshold).cast("int"))

"""Packing: documents cut into pieces and placed in sequences of a fixed number of tokens.

Bounded-space online packing: each partition keeps a fixed number of open windows. A document's whole windows are
emitted at once; its rest goes to the open window that it fits best. When none fits, the fullest is topped up with
the head of the piece and emitted. At the end the open windows of a partition are merged, and the one incomplete
window that each partition may leave is merged with those of its neighbours, so that one sequence in 64 partitions
or less is padded.

Defined results: a null or empty text is its end token alone; repeated rows are packed one by one; an empty table
gives no sequences; columns other than the key and the text are not read. Memory: the open windows and one batch,
and one document's tokens, however long.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import FORGET, give_back, stored

LENGTH = 1024
OPEN_WINDOWS = 64
#: Partitions whose last windows are merged by one task.
MERGED_PARTITIONS = 64
END_TOKEN = 0
#: Documents that are encoded together, and bytes of these unless one is larger; freed memory then goes back to the system.
ENCODED, ENCODED_BYTES = 2048, 1 << 23
#: Different words that are encoded in one go.
MERGED_WORDS = 1 << 16
_EMIT_BYTES = 1 << 22

PIECES = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
#: White space that the fast path does not handle: runs of it, and any but spaces and line feeds.
_ODD_BLANKS = re.compile(r"\s\s|[^\S\n ]")
#: Fixed value: how byte-level BPE vocabularies of this kind cut a text before merging.
#: Without their rule for runs of blanks, which are never given.
_CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""
#: What a byte says: a space or line feed, the first one of a character that may be other white space, or other white space.
_BLANK, _PERHAPS, _ODD = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[[10, 32]] = _BLANK
_KIND[[0xC2, 0xE1, 0xE2, 0xE3]] = _PERHAPS
_KIND[[9, 11, 12, 13, 28, 29, 30, 31]] = _ODD


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    A byte-level BPE vocabulary of this kind starts a new token at each single space or line feed before a visible character. So the
    tokens of a text are those of its words, each with the blank before it, one after the other. The words of many texts are told apart
    by Arrow, each different one is encoded once, and its tokens are put in its places; nothing is remembered from one call to the next.
    Words are merged by tiktoken, which is given the file's own vocabulary and is several times faster; this needs ids in the order of the
    merges, which is checked. Texts with other white space or special tokens, and files that fail the check, are encoded by tokenizers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        pieces = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(pieces.values()) + 1, bool)
        self.opens[[i for t, i in pieces.items() if t.startswith("\u0120") or t == "\u010a"]] = True
        self.merged = self._by_rank(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Tokens of the blanks that no word follows.
        self.known = {x: self._whole(x) for x in (" ", "\n")}
        self.feed = len(self.known["\n"])

    @staticmethod
    def _by_rank(path: str):
        """The vocabulary as a tiktoken encoding, or None if its ids are not in the order of its merges."""
        import json

        import tiktoken
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        vocabulary, singles = model["vocab"], len(ByteLevel.alphabet())
        if any(vocabulary.get(a + b) != singles + i for i, (a, b) in enumerate(pairs)) or any(vocabulary.get(c, singles) >= singles for c in ByteLevel.alphabet()):
            return None
        # the printable character that stands for each byte, by the rule of byte-level vocabularies
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if i < singles + len(pairs)}
        return tiktoken.Encoding("words", pat_str=_CUTS, mergeable_ranks=ranks, special_tokens={})

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _merge(self, words: pa.Array) -> pa.Array:
        """Tokens of each word, which is a space or line feed and what is visible behind it."""
        text, _ = _bytes_of(words)
        text = text.tobytes().decode()
        ids = self.merged.encode_to_numpy(text, disallowed_special=()) if self.merged else np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) != len(words):
            return pa.array([self._whole(x.decode()) for x in words.to_pylist()], pa.large_binary())
        return _as_array(ids.astype(np.uint32).view(np.uint8), np.append(starts, len(ids)) * 4)

    def _tokens(self, words: pa.Array) -> pa.Array:
        """Tokens of different words, in their order."""
        lone = [pc.equal(words, x.encode()) for x in self.known]
        followed = pc.invert(pc.or_(*lone))
        rest = words.filter(followed)
        merged = [self._merge(rest.slice(i, MERGED_WORDS)) for i in range(0, len(rest), MERGED_WORDS)]
        held = pa.concat_arrays([pa.array(self.known.values(), pa.large_binary()), *merged])
        place = np.cumsum(followed.to_numpy(zero_copy_only=False)) + len(lone) - 1
        for i, found in enumerate(lone):
            place[found.to_numpy(zero_copy_only=False)] = i
        return held.take(pa.array(place))

    def _odd(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether a text is to be encoded whole; each starts with a line feed of its own."""
        kind, raw = _KIND[data], data.tobytes()
        twice = kind == _BLANK
        twice[1:] &= kind[:-1] == _BLANK
        twice[starts[:-1]] = False
        twice[starts[:-1][starts[:-1] + 1 < len(data)] + 1] = False
        most = np.maximum.reduceat(kind, starts[:-1])
        odd = np.logical_or.reduceat(twice, starts[:-1]) | (most == _ODD)
        special = any(t.encode() in raw for t in self.special)
        for i in np.flatnonzero(~odd & ((most == _PERHAPS) | special)):
            text = raw[starts[i] + 1 : starts[i + 1]].decode()
            odd[i] = bool(_ODD_BLANKS.search(text)) or any(t in text for t in self.special)
        return odd

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not len(texts):
            return []
        data, starts = _joined(texts)
        odd = self._odd(data, starts)
        if odd.any():
            plain = iter(self.encode(texts.filter(pa.array(~odd))))
            return [self._whole(texts[i].as_py()) if whole else next(plain) for i, whole in enumerate(odd)]
        at = np.flatnonzero(_KIND[data] == _BLANK)
        offsets = np.concatenate([at, [len(data)]])
        words = _as_array(data, offsets).dictionary_encode()
        ids, ends = _bytes_of(self._tokens(words.dictionary).take(words.indices))
        edges = ends[np.searchsorted(offsets, starts)]
        # the first word was given a line feed of its own
        return [ids[i + self.feed : j].tobytes() for i, j in zip(edges[:-1], edges[1:], strict=True)]


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of large texts or binaries, and where each value starts in these (with the end)."""
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _as_array(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)])


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, a line feed before each, and where these start (with the end)."""
    data, starts = _bytes_of(texts)
    return np.insert(data, starts[:-1], 10), starts + np.arange(len(starts))


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


# packing's tasks share the encoder, those of other operators need its memory
FORGET.append(_encoder.cache_clear)


class _Rows:
    """Finished pieces of sequences, and the next sequence's id."""

    def __init__(self, first_id: int):
        self.next_id, self.rows, self.bytes = first_id, [], 0

    def sequence(self, pieces: list[tuple], loose: bool = False) -> None:
        offset, total = 0, sum(p[2] for p in pieces)
        for key, start, size, ids, tokens in pieces:
            self.rows.append((key, start, size, ids, tokens, self.next_id, offset, total, loose))
            offset += size
            self.bytes += len(ids) + 100
        self.next_id += 1

    def taken(self) -> list[tuple]:
        rows, self.rows, self.bytes = self.rows, [], 0
        return rows


def _cut(piece: tuple, size: int) -> tuple[tuple, tuple]:
    key, start, length, ids, tokens = piece
    return (key, start, size, ids[: 4 * size], tokens), (key, start + size, length - size, ids[4 * size :], tokens)


def merge_windows(pieces: Iterable[tuple], length: int, rows: _Rows, last_is_loose: bool) -> None:
    """Fills sequences one after the other, cutting pieces at their ends; only the last may be incomplete."""
    window: list[tuple] = []
    free = length
    for piece in pieces:
        while piece[2] >= free:
            head, piece = _cut(piece, free)
            rows.sequence([*window, head])
            window, free = [], length
        if piece[2]:
            window.append(piece)
            free -= piece[2]
    if window:
        rows.sequence(window, last_is_loose)


class OpenWindows:
    """A fixed number of partly filled windows."""

    def __init__(self, length: int, most: int, rows: _Rows):
        self.length, self.most, self.rows = length, most, rows
        self.windows: dict[int, list[tuple]] = {}
        self.by_free: list[tuple[int, int]] = []
        self.opened = 0

    def _put(self, free: int, number: int) -> None:
        if free:
            insort(self.by_free, (free, number))
        else:
            self.rows.sequence(self.windows.pop(number))

    def _open(self, piece: tuple) -> None:
        self.opened += 1
        self.windows[self.opened] = [piece]
        self._put(self.length - piece[2], self.opened)

    def add(self, piece: tuple) -> None:
        while piece[2] >= self.length:
            head, piece = _cut(piece, self.length)
            self.rows.sequence([head])
        if not piece[2]:
            return
        at = bisect_left(self.by_free, (piece[2], 0))
        if at < len(self.by_free):
            free, number = self.by_free.pop(at)
            self.windows[number].append(piece)
            self._put(free - piece[2], number)
        elif len(self.windows) < self.most:
            self._open(piece)
        else:
            free, number = self.by_free.pop(0)
            head, tail = _cut(piece, free)
            self.windows[number].append(head)
            self._put(0, number)
            self._open(tail)

    def close(self) -> None:
        order = [number for _, number in self.by_free]
        merge_windows((p for n in order for p in self.windows[n]), self.length, self.rows, True)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Keys and texts of the rows that are encoded together."""
    texts = batch.column(1).fill_null("")
    ends, first = np.cumsum(pc.binary_length(texts).to_numpy()), 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = min(first + ENCODED, max(first + 1, int(np.searchsorted(ends, before + ENCODED_BYTES, "right"))))
        yield batch.column(0).slice(first, last - first), texts.slice(first, last - first)
        first = last


def _partition_packer(tokenizer_path: str, length: int, open_windows: int, schema: pa.Schema):
    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer_path), np.array([END_TOKEN], np.uint32).tobytes()
        rows = _Rows(TaskContext.get().partitionId() << 32)
        windows = OpenWindows(length, open_windows, rows)

        def batch() -> pa.RecordBatch:
            columns = zip(*rows.taken(), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for got in batches:
            for keys, texts in _parts(got):
                encoded = encoder.encode(texts)
                give_back()
                for key, ids in zip(keys.to_pylist(), encoded, strict=True):
                    size = len(ids) // 4 + 1
                    windows.add((key, 0, size, ids + end, size))
                    if rows.bytes > _EMIT_BYTES:
                        yield batch()
                del encoded
                give_back()
        windows.close()
        if rows.rows:
            yield batch()
        give_back()

    return pack_partition


def pack(documents: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """A row per piece: the key, its start in the document's ids, length, ids, the document's tokens, sequence_id, offset.

    ids: little-endian unsigned 32-bit; the document's last id is END_TOKEN. tokenizer_path must be readable on executors.
    """
    spark = documents.sparkSession
    source = documents.select(F.col(key).alias("key_"), F.col(text).cast("string").alias("text_"))
    key_type = source.schema["key_"].dataType.simpleString()
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema(
        [pa.field("key_", kinds[key_type])]
        + [pa.field(n, pa.binary() if n == "ids" else pa.int64()) for n in (x.split()[0] for x in PIECES.split(", "))]
        + [pa.field("loose", pa.bool_())]
    )
    placed = stored(source.mapInArrow(_partition_packer(tokenizer_path, length, open_windows, schema), f"key_ {key_type}, {PIECES}, loose boolean"), "pieces")

    columns = [f.name for f in schema][:-1]

    def merge_group(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(["sequence_id", "offset"])
        number = int(ordered.sequence_id.iloc[0] >> 32) // MERGED_PARTITIONS
        rows = _Rows((1 << 61) + (number << 32))
        keys = ordered.key_.astype(object).where(ordered.key_.notna(), None)
        pieces = zip(keys, ordered.start, ordered.length, ordered.ids, ordered.doc_tokens, strict=True)
        merge_windows(((k, int(s), int(n), bytes(i), int(t)) for k, s, n, i, t in pieces), length, rows, False)
        return pd.DataFrame([r[:-1] for r in rows.rows], columns=columns)

    loose = placed.filter("loose").withColumn("group_", F.floor(F.shiftright("sequence_id", 32) / MERGED_PARTITIONS))
    merged = loose.groupBy("group_").applyInPandas(merge_group, f"key_ {key_type}, {PIECES}")
    return placed.filter("not loose").drop("loose").unionByName(merged).withColumnRenamed("key_", key)

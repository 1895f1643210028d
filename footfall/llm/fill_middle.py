"""Fill-in-the-middle transformation: a text is cut at two unit ends into prefix, middle and suffix and put in another order.

A unit is a word with the blanks before it; blanks that no word follows are a unit of their own. The cuts are found
on the UTF-8 bytes seen as 64-bit words, eight bytes at a time: byte-wise arithmetic marks the last byte of each unit,
`bitwise_count` counts the marks of each word, a search in the running counts gives the word that holds a wanted unit
end, and the byte inside it is the one at which the running count of its marks reaches the rest. Forms, cuts and
outputs depend on the id and the text of a row alone.

Memory of a task: a slice of `shared.SLICE_BYTES` bytes of text takes some eight times its size; a longer text is a
slice of its own.

Defined results: null text is empty; an empty text has 0 units and stays plain; a text of blanks is one unit; a null id
is hashed as an empty string; repeated rows get equal outputs; an empty table gives no rows; other columns are kept, but
one named like a result column (n, form, prefix_chars, middle_chars, output) is replaced by the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUTS = "n long, prefix_chars long, middle_chars long"

ONES = np.uint64(0x0101010101010101)
HIGH, LOW = ONES << np.uint64(7), ONES * np.uint64(0x7F)
SPACE = ONES * np.uint64(0x20)
FROM_TAB, PAST_RETURN = ONES * np.uint64(0x80 - 0x09), ONES * np.uint64(0x80 - 0x0E)


def blank_bytes(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is a space or \\t \\n \\v \\f \\r; no byte's sum reaches its neighbour."""
    other = words ^ SPACE
    space = ~(((other & LOW) + LOW) | other)
    low = words & LOW
    control = (low + FROM_TAB) & ~(low + PAST_RETURN) & ~words
    return (space | control) & HIGH


def as_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts as little-endian words, each from a word of its own and followed by one to eight spaces; where each starts."""
    sizes = np.diff(starts)
    firsts = np.concatenate([[0], np.cumsum(sizes // 8 + 1)])
    padded = np.full(8 * int(firsts[-1]), 0x20, np.uint8)
    for first, start, size in zip(8 * firsts[:-1], starts[:-1], sizes, strict=True):
        padded[first : first + size] = data[start : start + size]
    return padded.view("<u8"), firsts


def unit_ends(words: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The high bit of the last byte of each unit."""
    blank = blank_bytes(words)
    follows = blank >> np.uint64(8)
    follows[:-1] |= blank[1:] << np.uint64(56)
    ends = ~blank & follows & HIGH
    full = np.flatnonzero(sizes)
    last = sizes[full] - 1
    ends[firsts[full] + last // 8] |= np.uint64(0x80) << (8 * (last % 8)).astype(np.uint64)
    return ends


def select(ends: np.ndarray, counts: np.ndarray, running: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The byte behind the rank-th mark of all, from 1."""
    word = np.searchsorted(running, rank)
    rest = (rank - running[word] + counts[word]).astype(np.uint64)
    upto = (ends[word] >> np.uint64(7)) * ONES  # in each byte the marks up to it
    before = ~((upto | HIGH) - rest * ONES) & HIGH
    return 8 * word + np.bitwise_count(before) + 1


def cut_texts(data: np.ndarray, starts: np.ndarray, first_hash: np.ndarray, second_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: units, code points before the first cut, code points between the cuts."""
    sizes = np.diff(starts)
    words, firsts = as_words(data, starts)
    ends = unit_ends(words, firsts, sizes)
    counts = np.bitwise_count(ends).astype(np.int64)
    running = np.cumsum(counts)
    before = np.concatenate([[0], running])[firsts]
    n = np.diff(before)

    leads = ~(words & ~(words << np.uint64(1))) & HIGH  # bytes that begin a code point
    lead_sums = np.concatenate([[0], np.cumsum(np.bitwise_count(leads), dtype=np.int64)])
    leads = np.append(leads, np.uint64(0))

    def chars(at: np.ndarray) -> np.ndarray:
        inside = (np.uint64(1) << (8 * (at % 8)).astype(np.uint64)) - np.uint64(1)
        return lead_sums[at // 8] + np.bitwise_count(leads[at // 8] & inside)

    def place(units: np.ndarray) -> np.ndarray:
        at = 8 * firsts[:-1]
        some = np.flatnonzero(units)
        at[some] = select(ends, counts, running, before[some] + units[some])
        return chars(at)

    a, b = first_hash % (n + 1), second_hash % (n + 1)
    low, high = place(np.minimum(a, b)), place(np.maximum(a, b))
    return n, low - chars(8 * firsts[:-1]), high - low


def _cuts(text: pa.Array, first_hash: pa.Array, second_hash: pa.Array) -> pa.Array:
    batch = pa.RecordBatch.from_arrays([text], names=["text"])
    hashes = [np.asarray(h) for h in (first_hash, second_hash)]
    parts = [cut_texts(data, starts, *(h[rows] for h in hashes)) for rows, data, starts in text_slices(batch, "text")]
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 3
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["n", "prefix_chars", "middle_chars"])


def hashes(key: Column, seed: str) -> list[Column]:
    """The first four 8-digit groups of the hex sha256 of `seed:key`."""
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(documents: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "42", percent: int = 50, suffix_first: int = 80) -> DataFrame:
    """`documents` with n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output.

    percent: share of the documents that are transformed; suffix_first: share of these with the suffix first.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    h1, h2, h3, h4 = hashes(F.col(key), seed)
    stays = (whole == "") | (h3 % 100 >= percent)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        stays = stays | F.contains(whole, F.lit(mark))
    form = F.when(stays, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    cut = documents.withColumns({"cuts_": F.arrow_udf(_cuts, CUTS)(whole, h1, h2), "form": form})
    before, within = F.col("cuts_.prefix_chars"), F.col("cuts_.middle_chars")
    prefix, middle = F.substr(whole, F.lit(1), before), F.substr(whole, before + 1, within)
    suffix = F.substr(whole, before + within + 1)
    output = (
        F.when(F.col("form") == "plain", whole)
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    moved = F.col("form") != "plain"
    return cut.withColumns(
        {"n": F.col("cuts_.n"), "prefix_chars": F.when(moved, before), "middle_chars": F.when(moved, within), "output": output}
    ).drop("cuts_")


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form. A transformed text holds no mark, so the output has three."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
        .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
        .otherwise(output)
    )

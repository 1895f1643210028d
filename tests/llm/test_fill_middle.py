"""Fill-in-the-middle against plain Python, and the word arithmetic against bytes."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import fill_middle
from footfall.llm.shared import SLICE_BYTES
from tests.llm.data import edge_documents, no_documents, prose

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_hand(key, text):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    output = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return len(units), "spm" if h4 % 100 < 80 else "psm", len(p), len(m), output


def compare(df):
    rows = fill_middle.fill_in_middle(df).withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_hand(r.doc_id, r.text)
        assert r.back == (r.text or "")
    return rows


def test_edge_documents(spark):
    docs = edge_documents(spark)
    rows = compare(docs)
    assert len(rows) == docs.count()
    assert set(docs.columns) <= set(rows[0].asDict())


def test_marks_blanks_and_every_alignment(spark):
    texts = ["a<P>b c", "<M>", "<P <S M> a <", " <P", "x <S", "\t", "\x1c \x85   é", " a ", "<" * 30 + " " + "P>" * 9]
    texts += ["x" * i + " " * j + "é" * k for i in range(9) for j in range(3) for k in range(4)]
    compare(spark.createDataFrame([(i, t) for i, t in enumerate(texts * 6)], "doc_id long, text string"))


def test_text_longer_than_a_slice(spark):
    long = prose(11, 90_000) + " ünd\n" + prose(12, 200_000)
    assert len(long) > SLICE_BYTES
    rows = compare(spark.createDataFrame([(i, t) for i in range(12) for t in (long, "kurz ist gut")], "doc_id long, text string"))
    assert {r.form for r in rows if r.n > 3} >= {"spm", "plain"}


def test_empty_table_clashing_results_and_shares(spark):
    assert fill_middle.fill_in_middle(no_documents(spark)).collect() == []
    clash = spark.createDataFrame([(1, "a b", "old", 9)], "doc_id long, text string, OUTPUT string, n int")
    (row,) = fill_middle.fill_in_middle(clash, percent=100, suffix_first=0).collect()
    assert (row.form, row.n) == ("psm", 2) and row["output"].startswith("<P>")
    assert [r.form for r in fill_middle.fill_in_middle(clash, percent=0).collect()] == ["plain"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0e\x08\x1fa!\x7fé日😀", max_size=40), min_size=1, max_size=6), st.randoms(use_true_random=False))
def test_word_arithmetic(texts, random):
    data = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, data)])
    hashes = [np.array([random.getrandbits(32) for _ in texts]) for _ in range(2)]
    got = fill_middle.cut_texts(np.frombuffer(b"".join(data), np.uint8), starts, *hashes)
    for i, text in enumerate(texts):
        units = UNIT.findall(text)
        a, b = sorted(int(h[i]) % (len(units) + 1) for h in hashes)
        assert tuple(int(x[i]) for x in got) == (len(units), len("".join(units[:a])), len("".join(units[a:b])))


@pytest.mark.parametrize("byte", range(256))
def test_blank_bytes_do_not_touch_their_neighbours(byte):
    word = np.frombuffer(bytes([byte, 0x20, byte, 0xFF, byte, 0x00, 0x0D, byte]), "<u8")
    marked = [bool(int(fill_middle.blank_bytes(word)[0]) >> (8 * i + 7) & 1) for i in range(8)]
    blank = byte in (9, 10, 11, 12, 13, 32)
    assert marked == [blank, True, blank, False, blank, False, True, blank]

"""Small tables with the cases that operators must stand: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random
import re

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = ("key", "rid", "id", "n", "token", "size", "x", "count", "score", "group_", "label_", "text_", "doc", "part", "u_")


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7))) for _ in range(words))


def edge_texts() -> list[str | None]:
    base, passage = prose(1, 300), prose(2, 80)
    changed = base.split(" ")
    changed[150] = "CHANGED"
    return [
        None, "", "   \n\t", "one", "One", "a b c d", "a b c d e", base, base, base.upper(), " ".join(changed), "\n".join([passage] * 3),
        prose(3, 120) + "\n" + passage + "\n" + prose(4, 120), passage, "wher. " * 400, "x" * 5000, "é日本 😀 " * 90, prose(5, 30_000), "a\u00a0b\x1cc  d\r\ne",
        "<|endoftext|> ### $$$ " * 20, prose(6, 40) + "\n" + prose(6, 40) + "\n\n", "AAA!! BBB!! " * 60,
    ]


def edge_documents(spark, clashes: bool = True):
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(edge_texts())]
    rows += [rows[7], rows[2], (None, "no id at all here " * 30, "en", "s1", 5), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    return df.withColumns({c: F.lit("clash") for c in CLASHES}) if clashes else df


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")

"""License scans against plain Python, on edge texts and on notices that are cut, edited and repeated."""

import random
import re

import pytest
from pyspark.sql import functions as F

from footfall.llm import license_scan
from footfall.llm.license_scan import BASE_PHRASES, NOTICES, Template
from footfall.llm.shared import SLICE_BYTES
from tests.llm.data import edge_documents, lowered, no_documents, prose


def words_of(text):
    return re.findall(license_scan.WORD, lowered(text or ""))


def mandatory_by_hand(template):
    w = template.notice.split()
    found = set()
    for phrase in template.key_phrases or (template.notice,):
        p = phrase.split()
        first = next(i for i in range(len(w)) if w[i : i + len(p)] == p)
        found |= set(range(first, first + len(p)))
    return found


def by_hand(text, idf, base=BASE_PHRASES, notices=NOTICES):
    """Every template at every beginning."""
    w = words_of(text)
    basic, labels, best = [], set(), 0.0
    for i, template in enumerate((*base, *notices)):
        t, must = template.notice.split(), mandatory_by_hand(template)
        for s in range(-len(t), len(w)):
            same = [0 <= s + k < len(w) and w[s + k] == t[k] for k in range(len(t))]
            if not all(same[k] for k in must):
                continue
            share = round(sum(idf[x] + 1e-6 for x, y in zip(t, same) if y) / sum(idf[x] + 1e-6 for x in t), 6)
            if i < len(base):
                basic.append((s, template.label))
            if i < len(base) or share >= license_scan.LEAST_SHARE:
                labels.add(template.label)
                best = max(best, share)
    starts = [s for s, _ in basic]
    return (len(w), len(basic), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in basic})), ",".join(sorted(labels))), best


def compare(df, base=BASE_PHRASES, notices=NOTICES):
    idf = license_scan.document_frequencies(df, (*base, *notices))
    rows = license_scan.scan(df, idf, base, notices).collect()
    for r in rows:
        told, score = by_hand(r.text, idf, base, notices)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == told
        assert r.score == pytest.approx(score, abs=2e-6)
    return rows


def test_edge_documents(spark):
    docs = edge_documents(spark).filter("coalesce(length(text), 0) < 100000")
    rows = compare(docs)
    assert len(rows) == docs.count() and set(docs.columns) <= set(rows[0].asDict())


def test_whole_cut_edited_and_repeated_notices(spark):
    r = random.Random(5)
    texts = ["Under the MIT License", "the mit license", "UNDER THE MIT LICENSE under the mit license", "CC BY-NC", "cc by é nc", "apache license version 2", "Version 2 of the Apache License"]
    for template in NOTICES:
        w = template.notice.split()
        for kind in range(6):
            x = list(w)
            if kind == 1:
                x = x[r.randrange(3) :]
            elif kind == 2:
                x = x[: -r.randint(1, 2)]
            elif kind == 3:
                x[r.randrange(len(x))] = "other"
            elif kind == 4:
                x.insert(r.randrange(len(x)), "more")
            elif kind == 5:
                x = (x + ["between"]) * 3
            texts.append(f"{prose(r.randrange(99), r.randint(0, 9))}\n# {' '.join(x).title()}.\n/* {prose(r.randrange(99), 3)} */")
    rows = compare(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    assert {x for r in rows for x in r.labels.split(",")} >= {t.label for t in NOTICES}
    assert any(r.labels and not r.base_labels for r in rows)


def test_templates_of_the_caller(spark):
    own = (Template("one", "solo"), Template("twice", "again and again", ("again",)), Template("none", "never said here"))
    rows = compare(spark.createDataFrame([(1, "Solo again and again solo"), (2, "again"), (3, None)], "doc_id long, text string"), own[:1], own[1:])
    assert [(r.n_base, r.labels) for r in sorted(rows)] == [(2, "one,twice"), (0, ""), (0, "")]
    with pytest.raises(ValueError, match="not in the notice"):
        license_scan.mandatory(Template("x", "a b", ("b a",)))


def test_rare_words_lead(spark):
    docs = spark.createDataFrame([(i, "license public general") for i in range(9)] + [(10, "gnu version 3")], "doc_id long, text string")
    idf = license_scan.document_frequencies(docs, NOTICES)
    assert idf["gnu"] > idf["general"] and idf["gnu"] == pytest.approx(1.704748, abs=1e-6)
    notice = Template("x", "gnu general public license", ("gnu general public license",))
    assert license_scan.rare_positions(notice, idf)[0] == 0


def test_long_text_empty_table_and_no_python(spark):
    long = prose(21, 120_000) + " under the mit license " + prose(22, 120_000)
    assert len(long) > SLICE_BYTES
    (row,) = license_scan.scan_documents(spark.createDataFrame([(1, long)], "doc_id long, text string")).collect()
    assert (row.n_words, row.n_base, row.first_word, row.labels) == (240_004, 1, 120_000, "mit")
    assert license_scan.scan_documents(no_documents(spark)).collect() == []
    plan = license_scan.scan_documents(edge_documents(spark)).select(F.lit(1))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_frequent_word_and_clashing_results(spark):
    rows = [(1, "gnu " * 900 + "general public license version 3", "x", 1.0), (2, "released under the mit license " * 300, "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, places string, SCORE double")
    got = sorted(compare(docs), key=lambda r: r.doc_id)
    assert (got[1].labels, got[1].n_base, len(got[1].places)) == ("mit", 300, 600)

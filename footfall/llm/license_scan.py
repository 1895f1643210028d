"""License scans: a positional index of rare license words, looked up per file, then verified by mandatory phrases.

A template is a notice with key phrases that must stand in it word by word. Words are weighed by their inverse document
frequency over all documents; the index lists each template under the two rarest words of each of its key phrases, with
their positions. A file's words are looked up; each hit says where its template would begin, and a beginning on which
two of a template's rare words agree is a candidate. There the key phrases are verified; the score of the place is the
weighted share of the template's words that stand at their position. As both rare words of a key phrase are mandatory,
no place that passes the verification is missed.

DataFrame functions only; the templates (`Template`, some kilobytes) are literals of the plan, and each file is scanned
inside its own row, so that nothing but document frequencies of template words is shuffled.

Defined results: null, empty or wordless text has 0 words, no places, null first and last word, empty labels and score 0;
repeated rows are judged alike, each in its own row; an empty table gives no rows. A text is held once with its words
(some five times its size). Other columns are kept; one named like a result is replaced by the result.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import ascii_lower, let

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAST_SHARE = 0.6
RARE_WORDS = 2


class Template(NamedTuple):
    label: str
    notice: str
    #: Parts of the notice; an empty tuple makes all of it mandatory.
    key_phrases: tuple[str, ...] = ()


# --- Fixed values -----------------------------------------------------------------------------------------------

#: Phrases that alone decide a base label.
BASE_PHRASES = (
    Template("mit", "under the mit license"),
    Template("apache-2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc"),
)

#: Public license notices, shortened to what tells them apart.
NOTICES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        ("permission is hereby granted free of charge", "associated documentation files"),
    ),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template(
        "gpl-3",
        "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license",
        ("gnu general public license as published", "either version 3 of the license"),
    ),
    Template(
        "gpl-2",
        "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license",
        ("gnu general public license as published", "either version 2 of the license"),
    ),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl-3", "under the terms of the gnu affero general public license", ("gnu affero general public license",)),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0 international",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
)

# --- End of fixed values ----------------------------------------------------------------------------------------


def license_words(text: Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII, with A-Z lower-cased."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def mandatory(template: Template) -> list[list[int]]:
    """For each key phrase the positions of its words in the notice; without key phrases the whole notice."""
    words = template.notice.split()
    places = []
    for phrase in map(str.split, template.key_phrases):
        starts = [i for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
        if not starts:
            raise ValueError(f"{' '.join(phrase)!r} is not in the notice {template.notice!r}")
        places.append(list(range(starts[0], starts[0] + len(phrase))))
    return places or [list(range(len(words)))]


def document_frequencies(documents: DataFrame, templates: tuple[Template, ...], text: str = "text") -> dict[str, float]:
    """ln((documents + 1) / (documents with the word + 1)) of each template word; as many numbers as the templates have words."""
    vocabulary = sorted({w for t in templates for w in t.notice.split()})
    found = F.array_distinct(F.filter(license_words(F.col(text)), lambda w: w.isin(vocabulary)))
    # The empty string counts the documents, so one pass gives both.
    counts = documents.select(F.explode(F.concat(F.array(F.lit("")), found)).alias("word")).groupBy("word").count()
    held = {r["word"]: r["count"] for r in counts.collect()}
    total = held.get("", 0)
    return {w: round(math.log((total + 1) / (held.get(w, 0) + 1)), 6) for w in vocabulary}


def rare_positions(template: Template, idf: dict[str, float]) -> list[int]:
    """Positions of the rarest words of each key phrase, equally rare ones from the left."""
    words = template.notice.split()
    return sorted({p for phrase in mandatory(template) for p in sorted(phrase, key=lambda p: (-idf[words[p]], p))[:RARE_WORDS]})


def scan(documents: DataFrame, idf: dict[str, float], base: tuple[Template, ...] = BASE_PHRASES, notices: tuple[Template, ...] = NOTICES, text: str = "text", least_share: float = LEAST_SHARE) -> DataFrame:
    """`documents` with n_words, places (label, base, start word, share), n_base, first_word, last_word, base_labels, labels, score."""
    templates = (*base, *notices)
    n, longest = len(templates), max(len(t.notice.split()) for t in templates)
    words = [t.notice.split() for t in templates]
    must = [sorted({p for phrase in mandatory(t) for p in phrase}) for t in templates]
    weights = [[idf[w] + 1e-6 for w in ws] for ws in words]

    # A beginning is one long: (start + longest) * n + template. A posting is what to add to a hit's position * n.
    postings: dict[str, list[int]] = {}
    for t, template in enumerate(templates):
        rare = rare_positions(template, idf)
        for p in rare * (1 if len(rare) > 1 else 2):
            postings.setdefault(words[t][p], []).append((longest - p) * n + t)
    rare_words = sorted(postings)
    index = F.map_from_arrays(F.lit(rare_words), F.array(*[F.lit(postings[w]).cast("array<bigint>") for w in rare_words]))

    def of(values: list, t: Column, kind: str) -> Column:
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), t)

    def word_at(x: Column, k: Column) -> Column:
        start = F.floor(x / n) - longest
        return F.get(F.col("words_"), (start + k).cast("int"))

    def template_of(x: Column) -> Column:
        return F.pmod(x, F.lit(n)).cast("int")

    def in_place(x: Column, k: Column) -> Column:
        return word_at(x, k).eqNullSafe(F.get(of(words, template_of(x), "array<string>"), k))

    hits = F.filter(F.transform("words_", lambda w, i: F.when(w.isin(rare_words), i)), lambda i: i.isNotNull())
    begins = F.flatten(F.transform(hits, lambda i: F.transform(F.element_at(index, F.get(F.col("words_"), i)), lambda p: i.cast("bigint") * n + p)))
    agreed = let(F.array_sort(begins), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i - 1))))
    verified = F.filter(agreed, lambda x: F.forall(of(must, template_of(x), "array<int>"), lambda k: in_place(x, k)))

    def share(x: Column) -> Column:
        weight = of(weights, template_of(x), "array<double>")
        found = F.aggregate(F.transform(weight, lambda v, k: F.when(in_place(x, k), v).otherwise(0.0)), F.lit(0.0), lambda a, v: a + v)
        return F.round(found / of([sum(ws) for ws in weights], template_of(x), "double"), 6)

    places = F.filter(
        F.transform(
            verified,
            lambda x: F.struct(
                of([t.label for t in templates], template_of(x), "string").alias("label"),
                (template_of(x) < len(base)).alias("base"),
                (F.floor(x / n) - longest).cast("bigint").alias("start"),
                share(x).alias("share"),
            ),
        ),
        lambda place: place["base"] | (place["share"] >= least_share),
    )

    def joined(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["label"]))), ",")

    looked_up = documents.withColumn("words_", license_words(F.col(text))).withColumn("places", places)
    basic = F.filter("places", lambda x: x["base"])
    starts = F.transform(basic, lambda x: x["start"])
    return looked_up.withColumns(
        {
            "n_words": F.size("words_").cast("bigint"),
            "n_base": F.size(basic).cast("bigint"),
            "first_word": F.array_min(starts),
            "last_word": F.array_max(starts),
            "base_labels": joined(basic),
            "labels": joined(F.col("places")),
            "score": F.coalesce(F.array_max(F.transform("places", lambda x: x["share"])), F.lit(0.0)),
        }
    ).drop("words_")


def scan_documents(documents: DataFrame, base: tuple[Template, ...] = BASE_PHRASES, notices: tuple[Template, ...] = NOTICES, text: str = "text") -> DataFrame:
    """`scan` with the document frequencies of `documents` themselves."""
    return scan(documents, document_frequencies(documents, (*base, *notices), text), base, notices, text)

"""Operators that judge, pack, mix or archive single rows, against plain Python."""

import re
import zlib

import numpy as np
import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from footfall.llm import mixing, packing, quality_classifier, quality_rules, queries, shared, toxicity, url_filter, warc
from tests.conftest import DATA
from tests.llm.data import edge_documents, edge_texts, no_documents, prose, words_of


def labels_of(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet").toPandas()


def test_url_rules_and_list(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://EXAMPLE.Org/es/1", "http://a.b.example.org/es/", "http://example.org/en/12?x", "http://example.org/en/2",
        "http://notexample.org/es/", "https://x.com/fr/", "https://x.com/fr", "https://com/de/q", "http://x.net/a#b", "http://x.net/a?c", "http://x.net/a", "a://b://c/d", "http://ü.org/é",
    ]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*urls, urls[4]])], "page_id long, url string, key string")
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, rules, url_filter.repeated_addresses(pages)).collect()

    def by_hand(url):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        return host, path

    places = [by_hand(u) for u in [*urls, urls[4]]]
    assert len(got) == len(places)
    for r in got:
        host, path = places[r.page_id]
        fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits) if fits else None
        listed = bool(host) and places.count((host, path)) > 1
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best and best[1], best[2] if best else "block" if listed else "allow")


def test_bloom_filter_misses_nothing_and_the_join_removes_false_hits(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("key"))
    bloom = url_filter.bloom_blocks(keys.filter("id % 3 = 0"), "key", 16)
    hits = {r.key for r in url_filter.possible_hits(keys, "key", bloom, 16).collect()}
    assert {str(i) for i in range(0, 3000, 3)} <= hits
    empty = url_filter.judge_urls(spark.createDataFrame([(1, "http://a/b")], "page_id long, url string"), spark.createDataFrame([], "host string, path string, verdict string"), keys.limit(0).selectExpr("key as host", "key as path"))
    assert [r.verdict for r in empty.collect()] == ["allow"]


def base_by_hand(text):
    text, w = text or "", words_of(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    covered = {k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(i, i + 8)} if len(w) < 3000 else set()
    lines = [x for x in text.split("\n") if words_of(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_rules_by_hand(spark):
    docs = edge_documents(spark, clashes=False).withColumn("extra", F.lit(1))
    ratios = quality_rules.fit_ratios(docs, docs.filter("doc_id in (7, 10, 12)").select("doc_id"))
    assert len(ratios) == quality_rules.BUCKETS
    codes = spark.createDataFrame([(w,) for t in edge_texts() for w in set(words_of(t))], "w string").distinct().select("w", F.xxhash64("w").alias("h")).collect()
    code = {r.w: r.h for r in codes}
    raw, target = (np.full(quality_rules.BUCKETS, quality_rules.SMOOTHING) for _ in range(2))
    rows = docs.select("doc_id", "text").collect()
    pairs = sorted({(code[a], code[b]) for r in rows if r.text for a, b in zip(words_of(r.text), words_of(r.text)[1:]) if a in code and b in code})
    of_pair = {(r.a, r.b): r.h for r in spark.createDataFrame(pairs, "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}

    def buckets(text):
        c = [code[w] for w in words_of(text)]
        return [x % quality_rules.BUCKETS for x in c] + [of_pair[p] % quality_rules.BUCKETS for p in zip(c, c[1:])]

    known = [r for r in rows if all(w in code for w in words_of(r.text))]
    assert len(known) == len(rows) - 1  # the row without an id has words of its own
    got = {(r.doc_id, r.n_words): r for r in quality_rules.judge(docs, ratios).collect()}
    for r in known:
        n, *rest = base_by_hand(r.text)
        x = got[(r.doc_id, n)]
        assert (x.word_chars, x.n_symbols, x.n_dup_lines) == tuple(rest[:3])
        if n < 3000:
            assert x.n_repeat_words == rest[3]
            assert x.base_failed == (n < 20 or 100 * rest[3] > 30 * n)
        b = buckets(r.text)
        score = sum(ratios[k] for k in b) / len(b) if b else 0.0
        assert x.llr == pytest.approx(score, abs=1e-6)
        assert x.kept == (not x.base_failed and x.llr >= quality_rules.THRESHOLD)
        for k in b:
            raw[k] += 1
            target[k] += r.doc_id in (7, 10, 12)
    lost = [r for r in rows if r not in known]
    assert len(lost) == 1 and raw.sum() > target.sum() > 0


def test_quality_rules_without_trusted_documents(spark):
    docs = edge_documents(spark, clashes=False)
    ratios = quality_rules.fit_ratios(docs, docs.select("doc_id").limit(0))
    assert set(ratios) == {0.0}
    assert quality_rules.judge(no_documents(spark), ratios).collect() == []


def test_quality_rules_part_labelled_documents(spark):
    got = queries.op9_quality_rules(spark, DATA).toPandas().merge(labels_of(spark), on="doc_id")
    good, bad = got[(got.quality == 1) & ~got.base_failed], got[(got.quality == 0)]
    assert good.kept.mean() > 0.99 and bad.kept.mean() < 0.1


@pytest.mark.parametrize(("query", "label", "folds", "held", "least"), [("op6_quality_classifier", "quality", 5, 0, 0.98), ("op4_toxicity", "toxic", 3, 1, 0.9)])
def test_classifiers_on_held_out_rows(spark, query, label, folds, held, least):
    scored = queries.registered()[query](spark, DATA).toPandas()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % folds == held for i in scored.doc_id]).all()
    assert scored.score.between(0, 1).all()
    out = scored.merge(labels_of(spark), on="doc_id")
    out = out[out.held_out]
    rank, positive = out.score.rank().to_numpy(), (out[label] == 1).to_numpy()
    n = positive.sum()
    assert (rank[positive].sum() - n * (n + 1) / 2) / (n * (len(out) - n)) > least


@pytest.mark.parametrize("module", [quality_classifier, toxicity])
def test_classifiers_of_edge_cases(spark, module):
    docs = edge_documents(spark)
    key = "key" if module is quality_classifier else "doc_id"
    both = spark.createDataFrame([(7, 1), (14, 0), (19, 0), (12, 1), (99, 1), (None, 1), (8, 5), (2, 0)], f"{key} long, label int")
    rows = module.classify(docs, both).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    again = module.classify(docs.repartition(3), both).collect()
    assert sorted((r.key is None, r.key, round(r.score, 9)) for r in rows) == sorted((r.key is None, r.key, round(r.score, 9)) for r in again)
    assert {r.score for r in module.classify(docs, both.filter("label = 1")).collect()} == {1.0}
    assert {r.score for r in module.classify(docs, both.limit(0)).collect()} == {0.5}
    assert module.classify(no_documents(spark), both).collect() == []


def toxicity_of(spark, texts, labelled):
    """Scores of texts; labelled: label by place."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(labelled.items()), "doc_id long, label int")
    return {r.key: r for r in toxicity.classify(docs, labels).collect()}


def test_toxicity_counts_every_bigram_of_whole_words(spark):
    texts = ["a b a b, A B", "b a\nc", None, "a b", "zz a b"]
    rows = [(0, texts[0]), (3, texts[1]), (1, texts[2]), (-1, texts[3]), (2, texts[4]), (0, texts[3])]
    got = toxicity.counts(spark.createDataFrame(rows, "role int, text string")).collect()

    def code(word):
        return int(toxicity.word_hashes(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word)]))[0].view(np.int64)[0])

    pairs = {(r.prev, r.word): [r[f"{k}{i}"] for k in "nd" for i in range(4)] for r in got if r.prev}
    assert pairs[code("a"), code("b")] == [4, 0, 1, 0, 2, 0, 1, 0]
    assert pairs[code("b"), code("a")] == [2, 0, 0, 1, 1, 0, 0, 1]
    assert len(pairs) == 7  # with the first words of texts
    alone = {}
    for r in got:
        if not r.prev:
            alone[r.word] = alone.get(r.word, 0) + np.array([r.n0, r.n1, r.n2, r.n3, r.cont])
    assert alone[code("a")].tolist() == [4, 0, 1, 1, 3] and alone[code("b")].tolist() == [4, 0, 1, 1, 2]


def test_toxicity_passes_counts_on_in_parts():
    r = np.random.default_rng(8)
    texts = [" ".join(map(str, r.integers(0, 100_000, 20_000))) for _ in range(70)]
    batch = toxicity.pa.RecordBatch.from_arrays([toxicity.pa.array([-1] * len(texts)), toxicity.pa.array(texts)], names=["role", "text"])
    parts = list(toxicity._count(iter([batch])))
    assert len(parts) > 1 and max(p.num_rows for p in parts) < 1_000_000
    pairs = {(p, w) for x in parts for p, w in zip(x.column("prev").to_pylist(), x.column("word").to_pylist(), strict=True)}
    assert len(pairs) == len({("", x[0]) for x in map(str.split, texts)} | {y for x in map(str.split, texts) for y in zip(x[:-1], x[1:], strict=True)})


@pytest.mark.parametrize(("buckets", "gathered"), [(1, 1 << 20), (7, 1 << 20), (7, 1000)])
def test_toxicity_sends_few_bytes_and_every_count(monkeypatch, buckets, gathered):
    monkeypatch.setattr(toxicity, "SHORTENED", gathered)
    monkeypatch.setattr(toxicity, "GATHERED", gathered)
    r = np.random.default_rng(9)
    texts = [" ".join(f"w{min(x, 10**9)}" for x in r.zipf(1.3, 400)) for _ in range(120)] + ["", None, "one one one one", "one"]
    roles = [int(x) for x in r.integers(-1, 4, len(texts))]
    want, neighbours = {}, {}
    for role, text in zip(roles, texts, strict=True):
        words = (text or "").split()
        grams = list(zip(["", *words], words)) + ([(None, w) for w in words] if role >= 0 else [])
        for n, g in enumerate(grams):
            at = want.setdefault(g, [0] * 8)
            if role >= 0:
                at[role] += 1
                at[4 + role] += g not in grams[:n]
            if g[0] is not None:
                neighbours.setdefault(g[1], set()).add(g[0])
    names = sorted({w for g in want for w in g if w})
    data = " ".join(names).encode()
    codes = dict(zip(names, map(int, toxicity.word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]), strict=True)) | {"": int(toxicity.START), None: 0}
    batches = [toxicity.pa.RecordBatch.from_arrays([toxicity.pa.array(roles[i : i + 31]), toxicity.pa.array(texts[i : i + 31], toxicity.pa.string())], names=["role", "text"]) for i in range(0, len(texts), 31)]
    often = toxicity.pa.Table.from_batches(list(toxicity._often(iter(b.select(["text"]) for b in batches)))).to_pydict()
    assert sum(n for w, n in zip(often["word"], often["n"], strict=True) if not w) == sum(len((t or "").split()) for t in texts)
    frequent = np.array([w for w in often["word"] if w], np.int64).view(np.uint64)
    short = toxicity.Short(np.concatenate([[toxicity.ALONE, toxicity.START], frequent[:200]]))
    rows = toxicity.pa.Table.from_batches(list(toxicity.shortened(toxicity._count(iter(batches)), short, buckets))).sort_by("bucket")
    if gathered > 1000:
        assert sum(map(len, rows["data"].to_pylist())) < 8 * len(want)
    got, cont = {}, {}
    back = {c: w for w, c in codes.items()}
    for part in toxicity._merged(iter(rows.to_batches(max_chunksize=2)), short):
        for prev, word, *packs, c in zip(*(x.to_numpy() for x in part.columns), strict=True):
            word, prev = back[int(word) % 2**64], back[int(prev) % 2**64]
            if c:
                cont[word] = cont.get(word, 0) + int(c)
            else:
                assert (prev, word) not in got
                got[prev, word] = [int(x) for p in packs for x in (p & 0xFFFFFFFF, p >> 32)]
    assert got == {g: n for g, n in want.items() if any(n)}
    assert cont == {w: len(x) for w, x in neighbours.items()}


def test_toxicity_joins_few_ngrams_without_evidence():
    r = np.random.default_rng(10)
    for n in (1, 1000, 60_000):
        grams, others = r.integers(-(2**63), 2**63 - 1, n), r.integers(0, 2**64 - 1, 100_000, np.uint64)
        held = toxicity.key_map(grams)
        assert toxicity._held(held, grams.view(np.uint64)).tolist() == list(range(n))
        assert len(toxicity._held(held, others)) < 1000


def test_toxicity_that_only_neighbours_tell(spark):
    r = np.random.default_rng(5)

    def text(toxic):
        pairs = [f"left{i} {'here' if (i % 2 == 0) == toxic else 'there'} gap" for i in r.integers(0, 40, 12)]
        return " ".join(pairs)

    toxic = [k % 2 for k in range(300)]
    got = toxicity_of(spark, [text(bool(y)) for y in toxic], {k: y for k, y in enumerate(toxic) if k < 200})
    assert np.mean([got[k].predicted == toxic[k] for k in range(200, 300)]) > 0.95


def test_toxicity_with_a_third_of_toxic_rows(spark):
    bad = ["vile", "scum", "filth"]
    texts = [prose(900 + k, 40) + (f" {bad[k // 3 % 3]} " if k % 3 == 0 else " ") + prose(5900 + k, 20) for k in range(360)]
    toxic = [int(k % 3 == 0) for k in range(360)]
    got = toxicity_of(spark, texts, {k: y for k, y in enumerate(toxic) if k < 240})
    held = range(240, 360)
    assert np.mean([got[k].predicted for k in held if toxic[k]]) > 0.95
    assert np.mean([got[k].predicted for k in held if not toxic[k]]) < 0.05


def test_accepted_keeps_rows_whole(spark):
    docs = edge_documents(spark)
    labels = spark.createDataFrame([(7, 1), (12, 1), (14, 0), (19, 0)], "key long, label int")
    kept = quality_classifier.accepted(docs, labels)
    assert kept.columns == docs.columns
    scores = {(r.key, round(r.score, 9)) for r in quality_classifier.classify(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in scores}


def tokens_by_hand(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    return [[*x.ids, 0] for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize(("length", "windows", "parts"), [(1024, 64, 3), (64, 2, 5)])
def test_packing_round_trip(spark, length, windows, parts):
    docs = edge_documents(spark).repartition(parts)
    rows = docs.select("doc_id", "text").collect()
    want = sorted((r.doc_id is None, r.doc_id, np.array(x, np.uint32).tobytes()) for r, x in zip(rows, tokens_by_hand([r.text for r in rows]), strict=True))
    got = packing.pack(docs, queries.tokenizer_path(), length=length, open_windows=windows).toPandas()
    assert (got.length > 0).all() and (got.ids.map(len) == 4 * got.length).all()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s.offset.to_numpy() == np.concatenate([[0], np.cumsum(s.length)[:-1]])).all()
        assert s.length.sum() == s.sequence_tokens.iloc[0] <= length
    assert (got.groupby("sequence_id").length.sum() < length).sum() <= 1
    assert got.length.sum() == sum(len(x[2]) // 4 for x in want)
    ids = sorted({x[:2] for x in want}, key=str)
    for absent, key in ids:
        pieces = got[got.doc_id.isna()] if absent else got[got.doc_id == key]
        whole = [x[2] for x in want if x[:2] == (absent, key)]
        if len(set(whole)) == 1 and len(whole) == 1:
            ordered = pieces.sort_values("start")
            assert b"".join(ordered.ids) == whole[0] and (ordered.doc_tokens == len(whole[0]) // 4).all()
        else:
            assert pieces.length.sum() == sum(len(x) // 4 for x in whole)


def test_texts_of_another_operator_free_the_encoder():
    path = queries.tokenizer_path()
    packing._encoder(path).encode(["some words to remember"])
    held = packing._encoder(path)
    assert packing._encoder(path) is held and len(held.known) > 1
    batch = toxicity.pa.RecordBatch.from_arrays([toxicity.pa.array(["a text"])], names=["text"])
    list(toxicity._often(iter([batch])))
    assert packing._encoder.cache_info().currsize == 0


def test_slices_take_little_text_and_every_row():
    texts = [*["x" * 10_000] * 100, "y" * 300_000, None, "z"]
    batch = packing.pa.RecordBatch.from_arrays([packing.pa.array(texts)], names=["text"])
    got = [(rows, data.tobytes().decode(), starts) for rows, data, starts in shared.text_slices(batch, "text")]
    assert all(len(data) <= 1 << 18 or rows.stop - rows.start == 1 for rows, data, _ in got)
    assert [data[i:j] for _, data, starts in got for i, j in zip(starts[:-1], starts[1:], strict=True)] == [x or "" for x in texts]


def test_encoder_merges_different_words_once_and_remembers_none():
    encoder, merged = packing.Encoder(queries.tokenizer_path()), []
    whole = encoder.merged.encode_to_numpy
    encoder.merged.encode_to_numpy = lambda text, **kw: merged.append(text) or whole(text, **kw)
    odd = ["", " ", "\n", "  ", "a\tb", "a\x1cb", "a\u00a0b", "\u3000", "<|endoftext|> a", "\0 a", "it's 42中文 é.\n\nno", " a ", "a\n", "\na"]
    texts = [*odd, *(f"word{i % 50} it's word{i} more-{i % 7}.\nend" for i in range(300))]
    got = encoder.encode(texts)
    assert [[*np.frombuffer(x, np.uint32), 0] for x in got] == tokens_by_hand(texts)
    words = "".join(merged).split(" ")
    assert len(words) == len(set(words)) and set(encoder.known) == {" ", "\n"}


def test_packing_gives_memory_back_while_it_encodes(monkeypatch):
    given = []
    monkeypatch.setattr(packing, "give_back", lambda: given.append(1))
    monkeypatch.setattr(packing, "TaskContext", type("Context", (), {"get": staticmethod(lambda: type("Of", (), {"partitionId": staticmethod(lambda: 0)}))}))
    names = ["key_", *(x.split()[0] for x in packing.PIECES.split(", ")), "loose"]
    kinds = [packing.pa.bool_() if n == "loose" else packing.pa.binary() if n == "ids" else packing.pa.int64() for n in names]
    schema = packing.pa.schema(list(zip(names, kinds, strict=True)))
    batch = packing.pa.RecordBatch.from_arrays([packing.pa.array(range(3000)), packing.pa.array([f"word{i} and more" for i in range(3000)])], names=["key_", "text_"])
    rows = packing.pa.Table.from_batches(list(packing._partition_packer(queries.tokenizer_path(), 64, 4, schema)(iter([batch]))))
    assert set(rows["key_"].to_pylist()) == set(range(3000)) and len(given) > 3


def test_packing_is_stable_and_empty(spark):
    docs = edge_documents(spark)
    a, b = (packing.pack(docs, queries.tokenizer_path()).orderBy("sequence_id", "offset").toPandas() for _ in range(2))
    pd.testing.assert_frame_equal(a, b)
    assert packing.pack(no_documents(spark), queries.tokenizer_path()).collect() == []


def test_targets_are_capped_and_reshared():
    sizes = {"b": 100, "a": 10, "c": 1000, None: 50, "d": 0}
    got = mixing.targets(sizes)
    assert got["a"] == 30 and got["d"] == 0
    assert sum(got.values()) == pytest.approx(1160)
    assert all(got[s] <= 3 * n + 1e-9 for s, n in sizes.items())
    assert got["c"] / got[None] == pytest.approx(1 / 2) or got[None] == 150


def test_quotas_add_up():
    quotas = np.array([5, 0, 1, 1000, 333])
    shares = mixing.split_quotas(quotas, 7, 1)
    assert (shares.sum(1) == quotas).all() and (shares >= 0).all()
    assert shares.sum(0).max() - shares.sum(0).min() <= 3
    assert (mixing.split_quotas(quotas, 7, 1) == shares).all()


def test_mixing_of_documents(spark):
    got = queries.op7_mixing(spark, DATA).toPandas()
    again = queries.op7_mixing(spark, DATA).toPandas()
    columns = ["doc_id", "taken"]
    pd.testing.assert_frame_equal(got[columns].sort_values("doc_id", ignore_index=True), again[columns].sort_values("doc_id", ignore_index=True))
    source = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "source").toPandas()
    by = got.merge(source, on="doc_id").groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"), source_size=("source_size", "first"))
    assert (by["size"] == by.source_size).all()
    assert ((by.taken - by.target).abs() <= 0.02 * by.target).all()
    assert (got.taken <= 3 * got["size"]).all() and (got[got["size"] > 0].taken % got[got["size"] > 0]["size"] == 0).all()


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
@pytest.mark.parametrize(("small", "large", "least", "most"), [(2000, 200_000, 0.998, 1.002), (100, 1_000_000, 0.8, 1.2)])
def test_mixing_of_a_source_with_one_very_long_document(spark, seed, small, large, least, most):
    rows = [("a", 100)] * small + [("a", large)] + [("b", 100)] * 5000
    sized = spark.createDataFrame(rows, "source string, size_ long").withColumn("u_", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), 1)).localCheckpoint()
    target = (100 * small + large) * 9 // 10 if small < large // 100 else 180_000
    runs = mixing.part_runs(sized, [("a", target, float(target)), ("b", 12_345, 12_345.0)])
    recipe = spark.createDataFrame(list(runs.items()), f"source_ string, {mixing.RUNS}")
    taken = sized.join(recipe, sized.source == recipe.source_).filter(mixing.IN_RUN).groupBy("source").agg(F.sum("size_").alias("n"))
    got = {r.source: r.n for r in taken.collect()}
    assert least * target <= got["a"] <= most * target
    assert abs(got["b"] - 12_345) <= 50


def test_mix_returns_each_draw(spark):
    docs = edge_documents(spark)
    mixed = mixing.mix(docs, shards=4)
    assert mixed.columns == [*docs.columns, "shard_"]
    rows = mixed.select("doc_id", "text", "shard_").collect()
    sized, recipe = mixing.plan(docs, shards=4)
    assert len(rows) == sum(len(r.shards_) for r in mixing.drawn(sized, recipe).collect())
    assert {r.shard_ for r in rows} <= set(range(4))
    assert mixing.mix(no_documents(spark)).collect() == []


def test_archives_of_edge_cases(spark):
    html = [None, "", "x" * 999, "y" * 1000, "é" * 600, prose(1, 2000)]
    rows = [(i, f"http://a/{i}\r\nX: y", html[i % len(html)], "clash") for i in range(20)] + [(None, None, "y" * 1000, "clash"), (5, "http://again", html[5], "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    got = sorted((r.page_id is None, r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect())
    last = {}
    for i, _, h, _ in rows:
        if i is not None:
            last[h] = max(i, last.get(h, i))
    want = []
    for i, _, h, _ in rows:
        size = len((h or "").encode())
        again = size >= 1000 and i != last[h]
        want.append((i is None, i, size, "revisit" if again else "response", last[h] if again else None))
    assert got == sorted(want)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_archive_keeps_payloads_and_has_a_frame_per_record(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", prose(i, 400)) for i in range(30)], "page_id long, url string, html string").coalesce(1)
    files = warc.write_archives(warc.mark_revisits(pages), f"file://{tmp_path}", warc.train_dictionary(pages))
    path = files.collect()[0].path
    data = open(path, "rb").read()
    assert data[:4] == b"\x5d\x2a\x4d\x18"
    back = {r.page_id: r.payload.decode() for r in warc.read_archives(files, f"file://{tmp_path}").collect()}
    assert back == {r.page_id: r.html for r in pages.collect()}
    frames = data.count(b"\x28\xb5\x2f\xfd")
    assert frames >= 31  # the dictionary and each record


@pytest.mark.parametrize("damage", ["cut", "flip", "magic"])
def test_damaged_archives_are_refused(damage):
    import io

    dictionary = b"HTTP/1.1 200 OK Content-Length WARC/1.1 " * 20
    good = warc.dictionary_frame(dictionary)
    frames = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
    for i in range(3):
        good += frames.compress(warc.record_bytes(i, "u", b"payload" * 50, None))
    assert [r[0] for r in warc.read_archive(io.BytesIO(good), "f")] == [0, 1, 2]
    bad = {"cut": good[:-7], "flip": good[:-30] + bytes([good[-30] ^ 255]) + good[-29:], "magic": b"\x00" + good[1:]}[damage]
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(bad), "f"))


@pytest.mark.parametrize("change", [(b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: 4", b"Content-Length: 5"), (b"payload", b"Payload"), (b"WARC-Date", b"X-Date")])
def test_records_are_validated(change):
    record = warc.record_bytes(1, "u", b"payload" * 50, None)
    assert warc.parse_record(record, "f")[0] == 1
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(*change), "f")

"""N-gram join, suffix dedup and NN-descent against brute force on cases of their own."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import ngram_join, nn_descent, suffix_dedup
from footfall.llm.components import components, roots
from tests.llm.data import edge_documents, edge_texts, lowered, no_documents, prose, words_of


def shingle_set(text):
    w = words_of(lowered(text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def smallest_reachable(ids, links):
    nodes, root = roots(np.array([a for a, _ in links] or [0]), np.array([b for _, b in links] or [0]))
    found = dict(zip(nodes.tolist(), root.tolist(), strict=True))
    return {i: found.get(i, i) for i in ids}


def joined_by_hand(rows):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    return smallest_reachable([i for i, _ in sets], links), {i: len(s) for i, s in sets}


def near_copies(seed, count, words=60, changes=3):
    r, base = random.Random(seed), prose(seed, words).split(" ")
    out = []
    for k in range(count):
        copy = list(base)
        for c in range(r.randint(0, changes)):
            copy[r.randrange(words)] = f"new{k}x{c}"
        out.append(" ".join(copy))
    return out


def test_ngram_join_of_edge_cases(spark):
    rows = [(r.doc_id, r.text) for r in edge_documents(spark).select("doc_id", "text").collect()]
    component, size = joined_by_hand(rows)
    got = ngram_join.near_duplicate_groups(edge_documents(spark)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (size[r.doc_id], component[r.doc_id])
        else:
            assert r.component_id is None


@pytest.mark.parametrize("border", [0, ngram_join.BORDER, 1 << 20])
def test_ngram_join_of_groups_chains_and_borders(spark, monkeypatch, border):
    monkeypatch.setattr(ngram_join, "BORDER", border)
    texts = near_copies(11, 60) + near_copies(12, 25, 200, 20) + [prose(13, 9)] * 3
    base = prose(14, 104).split(" ")  # 100 shingles; a chain in which only neighbours link
    texts += [" ".join(base[k : k + 84]) for k in range(0, 21, 3)]
    rows = list(enumerate(texts, 100))
    random.Random(0).shuffle(rows)
    component, _ = joined_by_hand(rows)
    got = ngram_join.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == component


def test_an_id_with_several_texts_is_one_node(spark):
    a, b, c, d = (prose(30 + k, 60) for k in range(4))
    near = " ".join(b.split(" ")[:-2])
    rows = [(1, a), (5, a), (5, b), (9, near), (7, c), (7, d), (8, d), (3, c), (2, prose(40, 60)), (2, prose(41, 60)), (6, None), (6, prose(41, 60))]
    component, _ = joined_by_hand(rows)
    assert {component[i] for i in (1, 5, 9)} == {1} and component[8] == 3 and component[6] == 2
    got = ngram_join.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.component_id, r.n_shingles) in {(component[r.doc_id], len(shingle_set(t))) for i, t in rows if i == r.doc_id}


def test_tokens_with_the_same_documents_meet_once(spark):
    rows = [(t, d, 9, 1) for t in range(40) for d in (1, 2)]  # one list 40 times
    rows += [(t, d, 9, d) for t in range(100, 110) for d in (1, 2, 3)] + [(t, d, 9, d) for t in range(200, 220) for d in (2, 3)]
    rows += [(t, d, 9, d) for t in range(300, 305) for d in (3, 4)]  # 4 has several texts
    lists = spark.createDataFrame(rows, "token long, doc long, n long, root long")
    got = ngram_join.distinct_lists(lists, spark.createDataFrame([(4,)], "doc long"))
    assert sorted(r.token for r in got.collect()) == [100, 200, 300, 301, 302, 303, 304]


def test_parts_tell_large_sets_apart(spark):
    r = np.random.default_rng(3)
    own, common = r.integers(0, 1 << 62, (2, 600)), r.integers(0, 1 << 62, 1400)  # of 2000 tokens 1400 in common: 54 %, not 80 %
    sets = [np.concatenate([common, x]) for x in own] + [np.concatenate([common, own[0][:500], own[1][:100]])]
    words = ngram_join.odd_parts(np.concatenate(sets), np.array([2000, 2000, 2000]))
    by_hand = np.zeros((3, ngram_join.PARTS), int)
    for i, s in enumerate(sets):
        np.add.at(by_hand[i], s & (ngram_join.PARTS - 1), 1)
    assert np.array_equal(np.unpackbits(words.view(np.uint8), axis=1, bitorder="little"), by_hand % 2)
    names = [f"{side}{i}" for side in "ab" for i in range(ngram_join.PART_WORDS)]
    pairs = spark.createDataFrame([[int(x) for k in p for x in words[k]] for p in ((0, 1), (0, 2), (1, 1))], ", ".join(f"{c} long" for c in names))
    n = F.lit(2000)
    kept = pairs.select(ngram_join.room_in_parts("a", "b", n, n, 80).alias("kept")).collect()
    assert [x.kept for x in kept] == [False, True, True]


def test_rarity_table_grows_with_the_text(spark):
    assert [ngram_join.rarity_bits(n) for n in (0, 10_000, 10_000_000, 10**12)] == [14, 14, 19, 22]
    docs = spark.createDataFrame([(i, "one two three four five " * (1 + i % 2) + prose(i, 40)) for i in range(300)], "doc_id long, text string").repartition(3)
    rare = ngram_join.rarity(docs)
    code = ngram_join.shingles(np.frombuffer(b"one two three four five", np.uint8), np.array([0, 23]))[0]
    assert len(rare) == 1 << 14
    # log2 of the 450 places, up to 255 of a task, times 6
    assert rare[int(code[0] >> np.uint64(50))] == round(float(np.log2(451)) * 6) and int(np.median(rare)) < 15


def test_one_of_each_group_keeps_the_smallest_id_and_all_columns(spark):
    docs = edge_documents(spark)
    component, _ = joined_by_hand([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({i for i, c in component.items() if i == c})


def removed_by_hand(texts, length=200):
    seen = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            seen[t[p : p + length]] = seen.get(t[p : p + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        out.append((len(t), int(gone.sum()), len(edges) // 2, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def compared(spark, rows):
    want = sorted(removed_by_hand([(t or "").encode() for _, t in rows]))
    got = suffix_dedup.removed(spark.createDataFrame(rows, "doc_id long, text string"))
    digests = got.select("n_bytes", "n_removed", F.size("spans").alias("n"), F.sha2("kept", 256).alias("h")).collect()
    assert sorted(map(tuple, digests)) == want


def test_suffix_dedup_of_edge_cases(spark):
    texts = [t for t in edge_texts() if len(t or "") < 50_000]
    compared(spark, [*enumerate(texts), (7, texts[7]), (None, texts[10])])


def test_suffix_dedup_of_shifted_periodic_and_low_entropy_texts(spark):
    r = random.Random(5)
    words = "".join(r.choice("ab") for _ in range(4000))
    long = prose(21, 400)
    texts = ["a" * 700, "ab" * 300 + "c" + "ab" * 150, words[:1500], words[700:2600], "z" + words[701:1400]]
    for n in (198, 199, 200, 201, 240, 263, 400, 1000):
        at = r.randrange(len(long) - n)
        texts.append(prose(30 + n, 40) + "|" + long[at : at + n] + "|" + prose(90 + n, 40))
    texts += [long, long[5:900] + "!" + long[900:], long[100:450] + long[80:430], "".join(r.choice("abcd") for _ in range(600)) * 2]
    compared(spark, list(enumerate(texts)))


def test_deduplicated_decodes_in_the_task_that_removes(spark):
    shared = prose(31, 60)
    docs = spark.createDataFrame([(1, "aé" + shared), (2, "cũ" + shared), (3, None)], "doc_id long, text string")
    kept = suffix_dedup.deduplicated(docs)
    assert "EvalPython" not in kept._jdf.queryExecution().toString()
    # the characters before the passage have their last byte in common; what is left of them is dropped
    assert {r.doc_id: r.text for r in kept.collect()} == {1: "a", 2: "c", 3: ""}


def test_deduplicated_keeps_columns_and_whole_characters(spark):
    docs = edge_documents(spark)
    kept = suffix_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count()
    assert all("\ufffd" not in r.text for r in kept.select("text").collect())


def linked_by_hand(rows, threshold=0.95):
    valid = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            valid.setdefault(i, np.array(v) / np.linalg.norm(v))
    ids = list(valid)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if len(valid[a]) == len(valid[b]) and valid[a] @ valid[b] >= threshold]
    degree = {i: 0 for i, _ in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return degree, smallest_reachable([i for i, _ in rows if i is not None], links)


def test_nn_descent_of_clusters_copies_and_invalid_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(24).tolist()) for i in range(300)]
    centre = rng.standard_normal(24)
    rows += [(1000 + i, (centre + 0.12 * rng.standard_normal(24)).tolist()) for i in range(150)]
    rows += [(2000 + i, (3.5 * rng.standard_normal(24)).tolist()) for i in range(3)] * 1
    rows += [(3000 + i, rows[5][1]) for i in range(40)]
    rows += [(4000, None), (4001, []), (4002, [0.0] * 24), (4003, [float("nan")] * 24), (4004, [None] * 24), (4005, [float("inf")] * 24), (4006, [1.0, 2.0]), (4007, [1.0, 2.0])]
    random.Random(1).shuffle(rows)
    degree, component = linked_by_hand(rows)
    got = nn_descent.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id, r.kept) == (degree[r.vec_id], component[r.vec_id], component[r.vec_id] == r.vec_id)


def test_a_compared_link_is_told_though_both_lists_are_full(spark):
    angle = {1: 0.0, 2: 0.15, 3: 0.3, 5: 0.05, 6: 0.25}
    reps = spark.createDataFrame([(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in angle.items()], "id long, x array<double>")
    near = {1: [5, 2], 2: [1, 3], 3: [6, 2], 5: [1, 2], 6: [3, 2]}
    lists = spark.createDataFrame([(u, [(-float(np.cos(angle[u] - angle[v])), v) for v in vs]) for u, vs in near.items()], "u long, list array<struct<far: double, v: long>>")
    news = {(min(r.u, r.v), max(r.u, r.v)): r.near for r in nn_descent.descend(reps, lists, 2).collect()}
    assert news[1, 3] is False


def test_audit_sees_lost_pairs_beside_a_large_group(spark):
    rng = np.random.default_rng(8)
    left = rng.standard_normal((1200, 24))
    pairs = np.concatenate([left, left + 0.15 * rng.standard_normal(left.shape)])
    group = rng.standard_normal(24) + 0.02 * rng.standard_normal((300, 24))
    rows = [(i, x.tolist(), 24, 1) for i, x in enumerate(np.concatenate([pairs, group]))]
    reps = spark.createDataFrame(rows, "id long, x array<double>, dims int, copies long")
    whole = [(i, 299) for i in range(2400, 2700)]
    lost = spark.createDataFrame(whole + [(i, 1) for i in range(2400) if i % 1200 < 900], "id long, links long")
    assert 0.6 < nn_descent.audit(reps, lost, 24, 0.95) < 0.85
    complete = spark.createDataFrame(whole + [(i, 1) for i in range(2400)], "id long, links long")
    assert nn_descent.audit(reps, complete, 24, 0.95) == 1.0


def test_orders_grow_with_the_logarithm_of_the_vectors():
    assert [nn_descent.orders_for(n) for n in (0, 1000, 30_000, 1_000_000, 10_000_000)] == [10, 10, 10, 21, 28]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_paths_stars_and_cliques(spark, seed):
    r = random.Random(seed)
    links = [(i, i + 1) for i in range(0, 60)] + [(500, x) for x in range(501, 700)] + [(a, b) for a in range(800, 812) for b in range(a)if b >= 800] + [(5, 5), (30, 650)]
    r.shuffle(links)
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes, root = roots(np.array([a for a, _ in links]), np.array([b for _, b in links]))
    assert got == {int(n): int(x) for n, x in zip(nodes, root, strict=True) if n != x}


def test_empty_tables(spark):
    assert ngram_join.near_duplicate_groups(no_documents(spark)).collect() == []
    assert suffix_dedup.removed(no_documents(spark)).collect() == []
    assert nn_descent.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []

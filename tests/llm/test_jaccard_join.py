import random

import numpy as np
import pytest
from helpers import classes, near_copies, shingles

from cohortloom.llm.components import components
from cohortloom.llm.jaccard_join import jaccard_classes, one_of_each_class, parity


def brute(rows, k, percent):
    sets = [(i, shingles(text, k)) for i, text in rows]
    edges = [(a, b) for n, (a, x) in enumerate(sets) for b, y in sets[:n]
             if x and y and 100 * len(x & y) >= percent * len(x | y)]
    found = classes(edges)
    return {i: (len(s), found.get(i, i)) for i, s in sets}


@pytest.mark.parametrize("k, percent, fewest", [(4, 85, 10), (5, 80, 1)])  # few parts: many sets lack the guarantee
def test_classes_equal_brute_force(spark, k, percent, fewest):
    texts = near_copies(random.Random(k))
    rows = list(enumerate([*texts, None, "", " \n", texts[0]]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_classes(docs, words=k, percent=percent, fewest_parts=fewest).collect()}
    assert got == brute(rows, k, percent)


def test_a_family_of_texts_just_below_the_threshold(spark):
    rng, base = random.Random(5), [f"b{i}" for i in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.sample(range(150), rng.choice([1, 3, 6, 9])):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(docs).collect()} == brute(rows, 4, 85)


def test_an_id_with_several_texts_is_one_document(spark):
    """Copies of other documents, near copies and lone texts under shared ids, against all pairs of rows."""
    rng, vocabulary = random.Random(8), [f"w{i}" for i in range(300)]
    bases = [rng.choices(vocabulary, k=205) for _ in range(25)]
    rows = [(1, " ".join(bases[0])), (10, " ".join(bases[0])), (10, " ".join(bases[1])),
            (20, " ".join([*bases[1][:100], "other", *bases[1][101:]])), (30, " ".join(bases[2])), (31, " ".join(bases[3])),
            (32, " ".join(bases[2])), (32, " ".join(bases[3]))]  # 32 is a copy of two documents
    for i in range(40, 140):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((rng.randrange(40, 110), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = [(i, shingles(text, 4)) for i, text in rows]
    edges = [(a, b) for n, (a, x) in enumerate(sets) for b, y in sets[:n] if 100 * len(x & y) >= 85 * len(x | y)]
    want = classes(edges)
    got = {(r.doc_id, r.component_id) for r in jaccard_classes(docs).collect()}
    assert got == {(i, want.get(i, i)) for i, _ in rows}
    of = dict(got)
    assert of[1] == of[10] == of[20] == 1 and of[30] == of[31] == of[32]


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for size in (0, 1, 30, 400, 5000):
        a = np.unique(rng.integers(0, 2 ** 63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[size // 5:], rng.integers(0, 2 ** 63, size // 9).astype(np.uint64)]))
        cells = sum(int(x).bit_count() for x in (parity(a) ^ parity(b)).view(np.uint64))
        assert cells <= len(np.setxor1d(a, b))


def test_null_ids_repeats_and_odd_columns(spark):
    text = "a b c d e f g"
    rows = [(1, text, 0), (1, text, 0), (2, text, 0), (None, text, 0), (3, None, 0), (4, "", 0), (5, "x", 0), (None, "y", 0)]
    docs = spark.createDataFrame(rows, "DOC_ID long, text string, node int")
    found = jaccard_classes(docs)
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted([
        (1, 4, 1), (1, 4, 1), (2, 4, 1), (None, 4, 1), (3, 0, 3), (4, 0, 4), (5, 1, 5), (None, 1, None)], key=str)
    kept = one_of_each_class(docs, found, doc_id="DOC_ID")
    assert kept.columns == docs.columns
    assert sorted(str(r.DOC_ID) for r in kept.collect()) == ["1", "3", "4", "5", "None", "None"]
    assert jaccard_classes(docs.limit(0)).collect() == []


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (300, 7), (139, 139)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in classes(edges).items() if k != 5}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []

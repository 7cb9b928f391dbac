import random
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from helpers import WORD, lowered

from cohortloom.llm.decontamination import RADIUS, HammingIndex, fingerprints, leaks, without_leaks


def brute(docs, items):
    out = {}
    for item, text in items:
        words = WORD.findall(lowered(text))
        wanted = Counter(zip(*[words[k:] for k in range(5)]))
        for doc, body in docs:
            have = WORD.findall(lowered(body))
            grams, n, best = list(zip(*[have[k:] for k in range(5)])), min(len(words), len(have)), 0
            if not wanted.keys() & set(grams):
                continue
            for at in range(len(have) - n + 1):
                seen = Counter(grams[at:at + n - 4])
                same = sum((seen & wanted).values())
                best = max(best, same / (sum(seen.values()) + sum(wanted.values()) - same))
            if best >= 0.8:
                out[doc, item] = round(best, 6)
    return out


def test_leaks_equal_all_windows(spark):
    docs, items = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rng, rows = random.Random(3), [(r.doc_id, r.text) for r in docs.collect()]
    bench = [(r.item_id, r.text) for r in items.collect()]
    for i, (_, text) in enumerate(bench[:30]):  # near passages inside other words
        words = text.split()
        if i % 3:
            words[rng.randrange(len(words))] = "changed"
        rows.append((5000 + i, " ".join(["before"] * i + words + ["after"] * 7)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in leaks(table, items).collect()}
    assert got == brute(rows, bench) and len(got) > 10
    kept = {r.doc_id for r in without_leaks(table, items).collect()}
    assert kept == {i for i, _ in rows} - {doc for doc, _ in got}


@pytest.mark.parametrize("radius", [3, 7, RADIUS])
def test_hamming_index_finds_all_within_the_radius(radius):
    """Against all pairs: random fingerprints, and ones at every distance around the radius, bits anywhere or in one block."""
    rng = np.random.default_rng(radius)
    keys = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    keys[50:60] = keys[:10]  # equal keys
    asked = keys[rng.integers(0, 300, 3000)].copy()
    for i in range(len(asked)):
        width = (64, 32, 16)[i % 3]
        for bit in rng.choice(width, min(width, rng.integers(0, radius + 4)), replace=False):
            asked[i] ^= np.uint64(1) << np.uint64(bit)
    query, key, distance = HammingIndex(keys, radius).near(asked)
    apart = np.bitwise_count(asked[:, None] ^ keys)
    assert set(zip(query.tolist(), key.tolist())) == set(zip(*[x.tolist() for x in np.nonzero(apart <= radius)]))
    assert (distance == apart[query, key]).all() and len(query) == len(set(zip(query.tolist(), key.tolist())))
    empty = HammingIndex(np.zeros(0, np.uint64), radius)
    assert len(empty.near(asked)[0]) == 0 and len(HammingIndex(keys, radius).near(asked[:0])[0]) == 0


def test_fingerprints_do_not_depend_on_regions(monkeypatch):
    hashes = np.random.default_rng(1).integers(0, 2 ** 63, 300, dtype=np.uint64)
    start = np.array([0, 1, 5, 100, 101, 250])
    whole = fingerprints(hashes, start, 40)
    monkeypatch.setattr("cohortloom.llm.decontamination.REGION", 3)
    assert (fingerprints(hashes, start, 40) == whole).all()


def test_odd_rows(spark):
    item = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, item), (2, None), (None, item), (3, ""), (4, "Short One"), (5, item)],
                                  "item_id int, text string")
    rows = [(1, item.upper(), 0), (None, "x " + item, 0), (2, None, 0), (3, "", 0), (4, "a short one here", 0),
            (1, item.upper(), 0), (6, "one two", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    got = Counter((r.doc_id, r.item_id) for r in leaks(docs, items).collect())
    assert got == {(1, 1): 2, (1, 5): 2, (None, 1): 1, (None, 5): 1, (4, 4): 1}
    assert sorted(r.doc_id for r in without_leaks(docs, items).collect()) == [2, 3, 6]
    assert without_leaks(docs, items).columns == docs.columns
    assert leaks(docs, items.limit(0)).collect() == [] and leaks(docs.limit(0), items).collect() == []

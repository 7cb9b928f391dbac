import re
from collections import Counter

from conftest import SMALL
from helpers import WORD, lowered
from pyspark.sql import functions as F

from cohortloom.llm.quality_rules import COUNTS, good_documents, quality_rules, sketches, thresholds, with_counts
from cohortloom.llm.sentence_dedup import LONGEST, without_repeats


def sentences(text):
    words, groups = list(WORD.finditer(text)), []
    for i, word in enumerate(words):
        before = words[i - 1] if i else None
        if before is None or before.group()[-1] in ".!?" or "\n" in text[before.end():word.start()] or len(groups[-1]) == LONGEST:
            groups.append([])
        groups[-1].append(word)
    starts = [0 if k == 0 else g[0].start() for k, g in enumerate(groups)]
    return [(a, b, tuple(lowered(w.group()) for w in g)) for a, b, g in zip(starts, [*starts[1:], len(text)], groups)]


def runs(found, least):
    for i in range(len(found)):
        n, j = 0, i
        while j < len(found) and (n < least or j - i < 2):
            n, j = n + len(found[j][2]), j + 1
        if n >= least and j - i >= 2:
            yield i, j, tuple(s[2] for s in found[i:j])
        elif i == 0:
            yield 0, len(found), tuple(s[2] for s in found)


def test_repeats_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source")
    passage = " ".join(f"Word{i} and more of it." for i in range(14))
    docs = docs.unionByName(spark.createDataFrame([
        (5000, None, None), (5001, "", None), (5002, " \n ", None), (None, "x y z.", "s"), (5003, "A b c. D e f!\n\nA b c.", None),
        (5004, "a b c. d e f!\n\na b c.", None), (5005, "Mine. " + passage + " So it is.", None),
        (5006, "Other words here. " + passage, None), (5007, "é " * 100, None)], docs.schema))
    seen, want = {}, {}
    for i, text in sorted((r.doc_id, r.text) for r in docs.where("doc_id is not null").collect()):
        found, gone = sentences(text or ""), set()
        for a, b, key in runs(found, 20) if found else ():
            if seen.setdefault(key, (i, a)) != (i, a):
                gone |= set(range(a, b))
        left = "".join(text[a:b] for k, (a, b, _) in enumerate(found) if k not in gone) if gone else text
        want[i] = (len(found), len(gone), left)
    result = without_repeats(docs)
    got = {r.doc.doc_id: (r.n_sentences, r.n_removed, r.doc.text) for r in result.collect()}
    assert got.pop(None) == (1, 0, "x y z.") and got == want
    assert want[5006][2].strip() == "Other words here." and want[5004][1] == 3
    assert result.select("doc.*").columns == docs.columns
    assert without_repeats(docs.limit(0)).collect() == []


def plain_counts(text):
    text, words = text or "", WORD.findall(text or "")
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows, covered = Counter(zip(words, words[1:], words[2:])), set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def odd_documents(spark, like):
    return spark.createDataFrame([
        (9001, None, None, None, 0), (9002, "", "xx", None, 0), (9003, "a\n\na\n a\na b c a b c\n", "en", "s", 0),
        (None, "é é é\x0bé é é\n\n# é #", None, "src1", 3), (9004, "same line\n" * 60, "en", "src1", 0)], like.schema)


def test_counts_and_verdicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    quality = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    both = docs.unionByName(odd_documents(spark, docs))
    texts = {r.doc_id: r.text for r in both.collect()}
    rows = {r.doc_id: r for r in quality_rules(both).collect()}
    assert len(rows) == len(texts)
    for i, row in rows.items():
        assert tuple(row[c] for c in COUNTS[:5]) == plain_counts(texts[i])
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert not (row.kept and row.base_failed)
    judged = [(row.kept, quality[i]) for i, row in rows.items() if i in quality and not row.base_failed]
    assert all(kept == (q == 1) for kept, q in judged)
    kept = good_documents(both)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}
    assert quality_rules(docs.limit(0)).collect() == []


def test_sketches_merge(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sketch = lambda df: sketches(with_counts(df, "text").withColumns({
        "lang": F.col("doc.lang"),
        "source": F.col("doc.source")}))
    whole = sketch(docs)
    parts = sketch(docs.where("doc_id % 3 = 0")).unionByName(sketch(docs.where("doc_id % 3 != 0")))
    order = lambda df: sorted(tuple(map(str, r)) for r in thresholds(df, 5).collect())
    assert order(whole) == order(parts) and len(order(whole)) > 20

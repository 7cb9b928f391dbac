import random

from cohortloom.llm.quality_rules import quality_rules


def text(rng, symbols, repeats=0, n=100):
    """``n`` words, of which ``symbols`` per mille are a symbol, after a stretch of ``repeats`` per mille that occurs twice."""
    words = [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    for i in rng.sample(range(n), symbols * n // 1000):
        words[i] += "#"
    half = repeats * n // 2000
    words[half:2 * half] = words[:half]
    return " ".join(words)


def test_fences_follow_their_group_and_withstand_junk(spark):
    rng, rows = random.Random(1), []
    add = lambda kind, source, body: rows.append((len(rows), body, "en", source, kind))
    for _ in range(200):
        add("good", "hot", text(rng, 0))
        add("good", "prose", text(rng, 0))
        add("good", "code", text(rng, rng.randrange(150, 260)))
    for _ in range(100):  # a third of the group, and beyond the base rule
        add("junk", "hot", text(rng, 1000))
        add("base", "prose", "same word here " * 40)
    add("junk", "prose", text(rng, 200))  # usual in code only
    add("junk", "hot", text(rng, 200))
    add("junk", "prose", text(rng, 0, repeats=480))  # below the base rule
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kind string")
    kind = {r[0]: r[4] for r in rows}
    got = quality_rules(docs).collect()
    assert {r.doc_id for r in got if r.kept} == {i for i, k in kind.items() if k == "good"}
    assert {r.doc_id for r in got if r.base_failed} == {i for i, k in kind.items() if k == "base"}

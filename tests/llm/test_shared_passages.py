import random

from helpers import WORD

from cohortloom.llm.sentence_dedup import SPAN, STEP, without_repeats


def test_passages_that_start_inside_sentences_are_removed(spark):
    rng = random.Random(5)
    fresh = iter(range(10 ** 6))
    own = lambda n: [f"own{next(fresh)}" for _ in range(n)]
    rows, passages = [], []
    for k in range(40):
        passage = [f"p{k}x{i}" + ("." if k % 2 and rng.random() < 0.08 else "") for i in range(rng.randint(51, 80))]
        passages.append(passage)
        for copy in range(2):  # other words before and after it, without a sentence end
            rows.append((2 * k + copy, " ".join([*own(rng.randint(1, 60)), *passage, *own(rng.randint(1, 60))])))
    once = [f"once{i}" for i in range(STEP + SPAN)]
    rows += [(900, "é " * 100), (901, " ".join(once)), (902, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc.doc_id: r for r in without_repeats(docs, passages=True).collect()}
    plain = {r.doc.doc_id: r.doc.text for r in without_repeats(docs).collect()}
    wholly_missed = 0
    for k, passage in enumerate(passages):
        before, left = rows[2 * k + 1][1], WORD.findall(got[2 * k + 1].doc.text)
        assert got[2 * k].doc.text == rows[2 * k][1]
        assert [w for w in left if w.startswith("own")] == [w for w in WORD.findall(before) if w.startswith("own")]
        assert len(passage) - sum(w.startswith("p") for w in left) >= len(passage) - 2 * (STEP - 1) >= 0.7 * len(passage)
        assert got[2 * k + 1].words_removed == len(WORD.findall(before)) - len(left)
        wholly_missed += plain[2 * k + 1] == before
    assert wholly_missed > 5  # by sentence runs alone
    assert got[901].doc.text == " ".join(once) and got[902].doc.text is None and got[900].n_sentences == 5

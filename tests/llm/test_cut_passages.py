import random

import pyarrow as pa
import pyarrow.parquet as pq
from helpers import WORD

from cohortloom.llm.decontamination import Benchmark
from cohortloom.llm.words import find_words, text_bytes

FOLDER = "/root/testdata/sf0.01"


def cut_passages(rng, items, bodies, where):
    """Texts with an item of which as many words are replaced as similarity 0.8 allows."""
    for item, words in items:
        n = len(words) - 4
        most = max(m for m in range(n) if (n - m) / (n + m) >= 0.8)
        head = {"tail": 0, "head": most, "both": most // 2}[where]
        other = WORD.findall(rng.choice(bodies))
        put = lambda k: [rng.choice(other) + "x" for _ in range(k)]
        at = rng.randrange(len(other))
        yield item, " ".join([*other[:at], *put(head), *words[head:len(words) - most + head], *put(most - head), *other[at:]])


def lost(where, rounds=3):
    rng = random.Random(where)
    rows = [(r["item_id"], r["text"]) for r in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()]
    bodies = [x for x in pq.read_table(f"{FOLDER}/documents.parquet")["text"].to_pylist() if 50 <= len(x.split()) <= 400]
    items = [(i, w) for i, text in rows if len(w := WORD.findall(text)) >= 14]
    planted = [x for _ in range(rounds) for x in cut_passages(rng, items, bodies, where)]
    block = Benchmark(rows, 0.8)
    found = {(x[0], block.ids[x[1]]) for x in block.leaks(find_words(*text_bytes(pa.array([t for _, t in planted]))))}
    return sum((k, item) not in found for k, (item, _) in enumerate(planted)), len(planted)


def test_passages_cut_at_their_ends_are_found():
    for where in ("tail", "head", "both"):
        assert lost(where, rounds=3)[0] == 0

"""Plain versions of what the operators compute."""

import re

WORD = re.compile("[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    words = WORD.findall(lowered(text))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def classes(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def near_copies(rng, common_lines=3, families=60):
    """Families of near copies of every size, many of them with a common line."""
    vocabulary = [f"w{i}" for i in range(400)]
    common = [" ".join(rng.choices(vocabulary, k=12)) for _ in range(common_lines)]
    texts = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.choice([3, 5, 8, 9, 10, 12, 14, 20, 30, 60, 120, 250]))
        for _ in range(rng.choice([1, 2, 5, 12])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at, kind = rng.randrange(len(words)), rng.random()
                if kind < 0.4:
                    words[at] = rng.choice(vocabulary)
                elif kind < 0.7:
                    words.insert(rng.choice([0, len(words)]), rng.choice(vocabulary))
                elif len(words) > 1:
                    words.pop(rng.choice([0, -1]))
            texts.append(" ".join(words) + (" " + rng.choice(common) if rng.random() < 0.5 else ""))
    return texts

"""Small frames and plain versions that the operators are held against."""

import itertools
import math

SF = "/root/testdata/sf0.001"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def shingle_set(text, size=5):
    words = (text or "").lower().split()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def components(ids, links):
    """The least identifier that links reach from each."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_links(texts, threshold=0.8):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    for a, b in itertools.combinations(sorted(texts), 2):
        if (texts[a] or "") == (texts[b] or ""):
            yield a, b
        elif sets[a] and sets[b]:
            shared = len(sets[a] & sets[b])
            if shared / (len(sets[a]) + len(sets[b]) - shared) >= threshold:
                yield a, b


def cosine(a, b):
    if not a or not b or len(a) != len(b) or any(x is None or not math.isfinite(x) for x in [*a, *b]):
        return None
    na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / na / nb if na and nb else None

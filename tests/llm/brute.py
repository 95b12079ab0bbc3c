"""Plain Python versions of the contracts."""

import hashlib
import re
from collections import defaultdict


def lower_ascii(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(t))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def smallest(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def join(parent, a, b):
    a, b = smallest(parent, a), smallest(parent, b)
    parent[max(a, b)] = min(a, b)


def components(sets):
    parent = {d: d for d in sets}
    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    common = defaultdict(int)
    for ds in by.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                common[(b, a)] += 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            join(parent, a, b)
    return {d: smallest(parent, d) for d in sets}


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(t))


def hits(text, items):
    """(words, hit words, matched item ids)."""
    w = words(text)
    hit, found = set(), set()
    for k, t in items.items():
        v = words(t)
        n = min(13, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(k))
    return len(w), len(hit), sorted(found)


def contaminated(text, items):
    n, h, _ = hits(text, items)
    return h > 0 and 20 * h >= n


def decontamination_row(text, items):
    n, h, found = hits(text, items)
    return n, h, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), h > 0 and 20 * h >= n


def toxicity_score(model, text):
    """A text's way through every tree, node by node, and the calibration between its knots."""
    from navspark.llm.toxicity import text_features

    x = text_features(text, [model.lexicon], {})[0]
    margin = model.trees.start
    for t in model.trees.trees:
        node = 0
        while node < len(t.feature):
            node = 2 * node + (2 if x[t.feature[node]] > t.threshold[node] else 1)
        margin += model.trees.rate * t.value[node - len(t.feature)]
    xs, ys = model.knots
    k = max((i for i in range(len(xs)) if xs[i] <= margin), default=None)
    if k is None or k == len(xs) - 1:
        score = ys[0] if k is None else ys[-1]
    else:
        score = ys[k] + (ys[k + 1] - ys[k]) * (margin - xs[k]) / (xs[k + 1] - xs[k])
    return min(1.0, max(0.0, score))

"""Slow, obvious re-implementations used as expected values."""

import re


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a, b):
    if not a or not b:
        return 0
    return round(100 * (2 * lcs(a, b) / (len(a) + len(b))))


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    s = " ".join(sorted(x & y))
    left = (s + " " + " ".join(sorted(x - y))).strip()
    right = (s + " " + " ".join(sorted(y - x))).strip()
    return max(ratio(s, left), ratio(s, right), ratio(left, right))


def partial(a, b):
    if not a or not b:
        return 0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    n = len(short)
    return max(ratio(short, long[k : k + n]) for k in range(len(long) - n + 1))


def score(a, b, weights=(0.4, 0.5, 0.1)):
    if not a or not b:
        return 0.0
    return round(
        weights[0] * ratio(a, b) + weights[1] * token_set(a, b) + weights[2] * partial(a, b), 2
    )


def normalize(name):
    if not name:
        return ""
    return re.sub(r"[^\w\s]", "", name.strip().lower())


def best(name, targets, threshold=65, weights=(0.4, 0.5, 0.1)):
    """``targets`` is a list in target order; returns (target, score) or None."""
    found, top = None, 0.0
    for target in targets:
        value = score(normalize(name), normalize(target), weights)
        if value > threshold and value > top:
            found, top = target, value
    return (found, top) if found else None

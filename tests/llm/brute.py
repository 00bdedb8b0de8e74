"""Plain versions of what the operators compute, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, n=5):
    w = WORD.findall(lower(text))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def components(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def similar_pairs(sets, percent=75):
    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in sets.items():
        common = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, k in common.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                yield i, j

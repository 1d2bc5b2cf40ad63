"""Plain, slow restatements of the text operators' rules."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def near_duplicates(rows, percent=85):
    """{doc_id: (n_shingles, component_id, kept)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in holders[s])
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def leaks(docs, items, percent=80):
    out = {}
    own = {i: shingles(t) for i, t in items}
    for d, t in docs:
        s = shingles(t)
        for i, x in own.items():
            if x and 100 * len(x & s) >= percent * len(x):
                out[d, i] = (len(x), len(x & s))
    return out


def viterbi(pieces, text):
    """Ids of the best segmentation, with all places in memory."""
    if not text:
        return []
    data = (" " + text).encode()
    bare = []
    for character in " " + text:
        bare += [character.encode() not in pieces.single] * len(character.encode())
    best, back = [0] + [None] * len(data), [None] * (len(data) + 1)
    for end in range(1, len(data) + 1):
        options = [
            (n, pieces.ids[data[end - n : end]])
            for n in range(min(end, pieces.longest), 0, -1)
            if data[end - n : end] in pieces.ids
        ]
        options = [(best[end - n] + int(pieces.score[i]), n, i) for n, i in options if best[end - n] is not None]
        if bare[end - 1] and best[end - 1] is not None:
            cost = pieces.unknown if data[end - 1] & 0xC0 != 0x80 else 0
            options.append((best[end - 1] + cost, 1, int(pieces.of_byte[data[end - 1]])))
        if options:
            score, n, i = max(options, key=lambda o: (o[0], o[1]))
            best[end], back[end] = score, (n, i)
    out, end = [], len(data)
    while end:
        out.append(back[end][1])
        end -= back[end][0]
    return out[::-1]

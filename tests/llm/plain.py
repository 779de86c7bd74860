"""Brute-force versions of the operators, in plain Python."""

import hashlib
import re
from collections import Counter

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substrings(rows, n=13):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - n + 1):
            first[tuple(w[k:k + n])] = min(i, first.get(tuple(w[k:k + n]), i))
    out = {}
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] < i:
                gone |= set(range(k, k + n))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def shingles(text, n=5):
    w = words((text or "").translate(FOLD))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(nodes, links):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def near(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    return {i: len(s) for i, s in sets.items()}, components(ids, links)


def quality_base(text):
    text = text or ""
    w = words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    many = Counter(grams)
    cover = {j for k, g in enumerate(grams) if many[g] > 1 for j in range(k, k + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover),
            len(w) < 10 or 100 * len(cover) > 20 * len(w))


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(FOLD)


def lines(rows, least=10):
    count = Counter()
    for _, t in rows:
        count.update({line_key(x) for x in (t or "").split("\n")} - {""})
    out = {}
    for i, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if count[line_key(x)] < least]
        out[i] = (len(every), len(every) - len(kept), "\n".join(kept))
    return out

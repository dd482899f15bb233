"""Plain versions of the operators for small tables."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def shingles(text, width):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


def components(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_duplicates(docs, width, percent):
    sets = {i: shingles(t, width) for i, t in docs}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in components(ids, links).items()}


def hits(text, items, window=13):
    """(words, hit words, items) of a text against {item: text}."""
    rule = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    w = re.findall(rule, (text or "").translate(LOWER))
    hit, found = set(), set()
    for item, own in items.items():
        v = re.findall(rule, (own or "").translate(LOWER))
        m = min(window, len(v))
        windows = {tuple(v[k : k + m]) for k in range(len(v) - m + 1)} if m else set()
        for k in range(len(w) - m + 1 if m else 0):
            if tuple(w[k : k + m]) in windows:
                hit.update(range(k, k + m))
                found.add(item)
    return len(w), len(hit), found


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def dropped_lines(docs, min_words):
    seen, out = [], {}
    for i, text in sorted(docs):
        gone = []
        for k, line in enumerate((text or "").split("\n")):
            w = words(line)
            if not w:
                continue
            if any(w == s or len(w) >= min_words and len(s) >= min_words and one_edit(w, s) for s in seen):
                gone.append(k)
            seen.append(w)
        out[i] = gone
    return out

"""Plain, quadratic versions of what the operators compute."""

import re
from collections import Counter
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, k):
    w = words(text)
    if len(w) < k:
        return [tuple(w)] if w else []
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]


def near_duplicates(rows, k, num, den):
    """{doc_id: (set size, component)} of (doc_id, text) rows with distinct ids."""
    sets = {d: set(shingles(t, k)) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations([d for d in sets if sets[d]], 2):
        common = len(sets[a] & sets[b])
        if den * common >= num * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def contaminated(docs, items, k=5, threshold=0.8):
    """{(doc_id, item_id): (at, similarity)}."""
    out = {}
    known = [(i, shingles(t, k)) for i, t in items if words(t)]
    for doc, text in docs:
        own = shingles(text, k)
        for item, s in known:
            bag, best = Counter(s), None
            if not set(own) & set(s):
                continue
            size = min(len(own), len(s))
            for at in range(len(own) - size + 1):
                window = Counter(own[at:at + size])
                score = sum((window & bag).values()) / sum((window | bag).values())
                if score >= threshold and (best is None or score > best[1]):
                    best = (at, score)
            if best:
                out[doc, item] = best
    return out


def base_rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    covered = {j for i, x in enumerate(windows) if seen[x] > 1 for j in range(i, i + 3)}
    counts = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    return (*counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0])

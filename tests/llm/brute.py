"""Plain versions of the operators, over Python lists of (doc_id, text)."""

import hashlib
import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(docs, size):
    """Per document: words, removed words, hash of the kept text."""
    seen, out = {}, {}
    for d, text in sorted(docs, key=lambda x: x[0]):
        w = WORDS.findall(text or "")
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if seen.setdefault(key, (d, k)) != (d, k):
                gone[k : k + size] = [True] * size
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def shingle_set(text, size):
    w = WORDS.findall((text or "").translate(LOWER))
    if 0 < len(w) < size:
        return {tuple(w)}
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}


def groups(docs, size, num, den):
    """Per document: size of the set, smallest linked document."""
    sets = {d: shingle_set(t, size) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        shared = Counter(o for g in sets[d] for o in holders[g])
        for o, k in shared.items():
            if den * k >= num * (len(sets[d]) + len(sets[o]) - k):
                a, b = find(o), find(d)
                parent[max(a, b)] = min(a, b)
        for g in sets[d]:
            holders[g].append(d)
    return {d: (len(sets[d]), find(d)) for d in sets}


def lines_gone(docs, num, den, min_words):
    """Per document: the numbers of the lines that resemble an earlier line."""
    before, out = [], {}
    for d, text in sorted(docs, key=lambda x: x[0]):
        out[d] = []
        for k, line in enumerate([] if text is None else text.split("\n")):
            s = frozenset(WORDS.findall(line.translate(LOWER)))
            if len(s) < min_words:
                continue
            if any(den * len(s & o) >= num * len(s | o) for o in before):
                out[d].append(k)
            before.append(s)
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def leaks(doc_words, item_words, max_edits):
    """The least distance of an item to the windows of a document, if small enough."""
    n, limit = len(item_words), int(max_edits * len(item_words) + 1e-9)
    best = min(
        (edit_distance((doc_words[p : p + n] + [None] * n)[:n], item_words) for p in range(len(doc_words))), default=n
    )
    return best if best <= limit else None

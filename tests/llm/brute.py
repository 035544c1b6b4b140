"""Plain-Python versions of what the queries return, for small inputs."""
import collections
import re
import zlib

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def shingles(text, n):
    w = words(lower(text))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near_components(docs, n=4):
    """doc_id -> (set size, component) by comparing all pairs that share a shingle."""
    sets = {d: shingles(t, n) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for a, b in {(a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1:]}:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def kept_words(docs, window=50):
    """doc_id -> (words, removed, kept words joined) for documents in doc_id order."""
    first, out = {}, {}
    for d, t in sorted(docs):
        w = words(t)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), d)
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w, t = words(text), text or ""
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    seen = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    mark = [False] * len(w)
    for i in range(len(w) - 2):
        if seen[tuple(w[i:i + 3])] > 1:
            mark[i:i + 3] = [True] * 3
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), sum(mark)

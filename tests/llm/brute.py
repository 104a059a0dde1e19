"""Plain, slow versions of what the operators compute."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

from meterspark.llm.mixing import MADE  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text, fold=False):
    return WORD.findall(lower(text or "") if fold else text or "")


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def without_repeats(docs, window):
    """docs: list of (id, text); list of (id, n_words, n_removed, kept)."""
    split = [(i, words(t)) for i, t in docs]
    seen = Counter(tuple(w[k:k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def gram_set(text, n):
    w = words(text, fold=True)
    if len(w) >= n:
        return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def near_groups(docs, n, percent):
    """docs: list of (id, text) with distinct ids; {id: (set size, smallest id reachable)}."""
    sets = {i: gram_set(t, n) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    overlap = Counter((a, b) for own in holders.values() for a in own for b in own if a < b)
    low = {i: i for i in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for (a, b), o in overlap.items():
        if 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
            a, b = find(a), find(b)
            low[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def base_spans(text):
    """(start, rank, kind, end) of the fixed patterns."""
    out = []
    for rank, (kind, pattern, group, least) in enumerate((
            ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                       r"([A-Za-z0-9+/_.=-]+)", 2, 12),
            ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16))):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "", re.ASCII)
                if len(m.group(group)) >= least]
    return sorted(out)

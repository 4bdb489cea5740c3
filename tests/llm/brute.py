"""Plain-Python counterparts of operators, for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    """{(doc_id, keep_id, group_size, kept, sha)} of (doc_id, text)."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, text or ""))
    out = []
    for content, members in groups.items():
        members = sorted(members, key=lambda m: (-len(m[1]), m[0]))
        out += [(i, members[0][0], len(members), k == 0, sha(content)) for k, (i, _) in enumerate(members)]
    return sorted(out)


def substrings(rows, length=50):
    """[(doc_id, n_words, n_removed, sha of the rest)] of (doc_id, text)."""
    first, docs = {}, [(i, WORD.findall(t or "")) for i, t in rows]
    for i, words in docs:
        for k in range(len(words) - length + 1):
            w = tuple(words[k : k + length])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, words in docs:
        gone = set()
        for k in range(len(words) - length + 1):
            if first[tuple(words[k : k + length])] < i:
                gone.update(range(k, k + length))
        rest = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), sha(" ".join(rest))))
    return sorted(out)


def shingle_set(text, n=5):
    words = WORD.findall(text or "")
    n = min(n, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()


def classes(ids, links):
    """{id: smallest id that links lead to}."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def near_links(rows, threshold=0.8, n=5):
    """Pairs of (doc_id, text) rows with similar shingle sets."""
    sets = [(i, shingle_set(t, n)) for i, t in rows]
    owners = {}
    for i, s in sets:
        for x in s:
            owners.setdefault(x, []).append(i)
    sets, found = dict(sets), set()
    for members in owners.values():
        for k, a in enumerate(members):
            found.update((a, b) for b in members[k + 1 :])
    same = []
    for a, b in found:
        both = len(sets[a] & sets[b])
        if both >= threshold * (len(sets[a]) + len(sets[b]) - both):
            same.append((a, b))
    return same

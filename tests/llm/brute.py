"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(UP) if lower else text)


def licenses(docs, phrases):
    out = {}
    for doc, text in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))
        places = sorted((i, label) for p, label in phrases for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        out[doc] = (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({x for _, x in places})))
    return out


def components(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def near(docs, percent=85, n=5):
    sets = {}
    for doc, text in docs:
        w = spaced(text, lower=True)
        sets[doc] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {d: (len(sets[d]), c, c == d) for d, c in components(ids, links).items()}


def repeats(docs, window=35):
    seen, where = Counter(), {}
    for row, (_, text) in enumerate(docs):
        w = spaced(text)
        where[row] = w
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for row, (doc, _) in enumerate(docs):
        w, gone = where[row], set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def lines(docs, threshold=2, similarity=0.8):
    """(doc, line number) -> (first (doc, line number) of its class, differs from it)."""
    all_lines = [(doc, i, x.strip(" \t\v\f\r")) for doc, text in docs for i, x in enumerate((text or "").split("\n")) if x.strip(" \t\v\f\r")]
    names = sorted({x for _, _, x in all_lines})
    links = []
    for k, a in enumerate(names):
        for b in names[k + 1 :]:
            limit = min(threshold, int((1 - similarity) * max(len(a), len(b)) + 1e-9))
            if abs(len(a) - len(b)) <= limit and edit(a, b) <= limit:
                links.append((a, b))
    of = components(names, links)
    first = {}
    for doc, i, x in sorted(all_lines):
        first.setdefault(of[x], (doc, i, x))
    return {(doc, i): (first[of[x]][:2], first[of[x]][2] != x) for doc, i, x in all_lines}


def backoff(docs, order, alpha=0.4, min_count=2):
    counts = [Counter() for _ in range(order + 1)]
    words = [spaced(t, lower=True) for _, t in docs]
    for w in words:
        for n in range(1, order + 1):
            counts[n].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    total = sum(counts[1].values())
    out = []
    for (doc, _), w in zip(docs, words):
        score = 0.0
        for i in range(len(w)):
            factor = 1.0
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i - n + 1 : i + 1])
                if n == 1:
                    score += math.log(factor * counts[1][gram] / total)
                elif counts[n][gram] >= min_count:
                    score += math.log(factor * counts[n][gram] / counts[n - 1][gram[:-1]])
                    break
                else:
                    factor *= alpha
        out.append((doc, len(w), score))
    return out


def exact(docs):
    """Sorted (doc, keep, size, kept, sha); of repeated rows with the largest id one is kept."""
    groups = defaultdict(list)
    for row, (doc, text) in enumerate(docs):
        groups[text or ""].append((doc is not None, doc or 0, row, doc))
    out = []
    for text, rows in groups.items():
        top = max(rows)
        for r in rows:
            out.append((r[3], top[3], len(rows), r == top, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)

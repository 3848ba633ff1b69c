"""What the operators must return, computed row by row in plain Python."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, size=5):
    words = WORD.findall(lower(text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def classes(rows):
    """Sorted (doc_id, n_shingles, component_id)."""
    sets = [(doc, shingles(text)) for doc, text in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for j, (b, y) in enumerate(sets[:i]):
            both = len(x & y)
            if x and y and (a == b is not None or 100 * both >= 75 * (len(x) + len(y) - both)):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, s) in enumerate(sets):
        if doc is not None and s:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((doc, len(s), least.get(root(i), doc) if s else doc)
                   for i, (doc, s) in enumerate(sets)), key=str)


def without_repeats(rows, size=50):
    first = {}
    for doc, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - size + 1):
            key = tuple(words[i:i + size])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    found = []
    for doc, text in rows:
        words = WORD.findall(text or "")
        keep = [True] * len(words)
        for i in range(len(words) - size + 1):
            if doc is not None and first[tuple(words[i:i + size])] < doc:
                keep[i:i + size] = [False] * size
        kept = " ".join(w for w, k in zip(words, keep) if k)
        found.append((doc, len(words), len(words) - sum(keep),
                      hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found, key=str)


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.A)
KINDS = (("assign", ASSIGN, 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
         ("hex", re.compile("[0-9a-f]+"), 0, 24))


def base_spans(text):
    """Sorted (start, kind number, kind:start:end)."""
    return sorted((m.start(), k, f"{name}:{m.start()}:{m.end()}")
                  for k, (name, pattern, group, least) in enumerate(KINDS)
                  for m in pattern.finditer(text or "") if len(m.group(group)) >= least)


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(n - 4))
    covered = set()
    for i in range(n - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    repeated = len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), repeated, n < 10 or 100 * repeated > 20 * n)


def edit_matches(rows, items, percent=15):
    """{(doc_id, item_id): least distance} by the full table over words."""
    found = {}
    for doc, text in rows:
        words = WORD.findall(lower(text or ""))
        for item, item_text in items:
            pattern = WORD.findall(lower(item_text or ""))
            if not pattern:
                continue
            column, least = list(range(len(pattern) + 1)), len(pattern)
            for word in words:
                new = [0]
                for i, own in enumerate(pattern):
                    new.append(min(column[i] + (own != word), column[i + 1] + 1, new[i] + 1))
                column, least = new, min(least, new[-1])
            if least <= len(pattern) * percent // 100:
                found[doc, item] = min(least, found.get((doc, item), least))
    return found

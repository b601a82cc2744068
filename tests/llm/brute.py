"""Plain versions of the operators, over lists of rows."""

import hashlib
import re
from collections import Counter

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def simhash(text):
    words = SPACE.findall((text or "").translate(ASCII_LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(marks, radius=4):
    """marks: {doc_id: fingerprint}; the least doc_id in reach of each."""
    parent = {d: d for d in marks}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(marks)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (marks[a] ^ marks[b]).bit_count() <= radius:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {d: top(d) for d in marks}


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    counts = Counter(k for _, _, k, _ in found)
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))
    return counts["assign"], counts["access"], counts["hex"], hashlib.sha256(joined.encode()).hexdigest()


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def alnum_words(text):
    return ALNUM.findall((text or "").translate(ASCII_LOWER))


def leaks(docs, items, size=10):
    """{doc_id: (n_words, n_hit, sorted item ids)}"""
    owners = {}
    for item, text in items:
        words = alnum_words(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            owners.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    lengths = sorted({len(w) for w in owners})
    found = {}
    for doc, text in docs:
        words = alnum_words(text)
        hit, ids = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if who := owners.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    ids |= who
        found[doc] = len(words), len(hit), sorted(ids)
    return found


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    words = SPACE.findall(text)
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)

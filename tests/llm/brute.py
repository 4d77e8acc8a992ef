"""Plain Python versions of what the operators return."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

BLANK = re.compile(r"[\x20\x09-\x0D]+")
NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def exact(rows):
    """rows: (doc_id, text). Sorted (doc_id, keep_id, group_size, kept, sha)."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[BLANK.sub(" ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = min((x for x in ids if x is not None), default=None)
        out += [(x, keep, len(ids), x == keep, sha(text)) for x in ids]
    return sorted(out, key=repr)


def repeats(rows, length):
    counts = Counter()
    datas = [(i, (t or "").encode()) for i, t in rows]
    for _, data in datas:
        counts.update(data[k : k + length] for k in range(len(data) - length + 1))
    out = []
    for doc_id, data in datas:
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if counts[data[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        out.append((doc_id, len(data), sum(gone), spans, sha(bytes(x for x, y in zip(data, gone) if not y))))
    return sorted(out, key=repr)


def shingles(text, size=5):
    words = NOT_BLANK.findall(lower(text))
    return {tuple(words[k : k + size]) for k in range(max(len(words) - size + 1, 1))} if words else set()


def near(rows, percent=85):
    """rows: (doc_id, text) with distinct ids. Sorted (doc_id, n, component, kept)."""
    sets = {i: shingles(t) for i, t in rows}
    holders = defaultdict(list)
    for i, found in sets.items():
        for x in found:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, found in sets.items():
        for j, n in Counter(j for x in found for j in holders[x] if j > i).items():
            if 100 * n >= percent * (len(found) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets.items())


def contamination(rows, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        words = BENCH_WORD.findall(lower(text))
        for k in range(max(len(words) - size + 1, 1) if words else 0):
            windows[tuple(words[k : k + size])].add(item)
    sizes = {len(x) for x in windows}
    out = []
    for doc_id, text in rows:
        words, hit, found = BENCH_WORD.findall(lower(text)), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(words[k : k + n])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(words), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return sorted(out, key=repr)

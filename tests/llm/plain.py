"""Plain versions of the operators, for comparison on small tables."""

import base64
import hashlib
import re
import string
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows):
    """Rows of (doc_id, text): the multiset of (doc_id, fingerprint, component)."""
    marks = [(i, fingerprint(t)) for i, t in rows]
    distinct = sorted({m for _, m in marks})
    group = {m: {m} for m in distinct}
    for a in distinct:
        for b in distinct:
            if bin(a ^ b).count("1") <= 2 and group[a] is not group[b]:
                both = group[a] | group[b]
                for m in both:
                    group[m] = both
    ids = defaultdict(list)
    for i, m in marks:
        if i is not None:
            ids[m].append(i)
    first = {m: min([i for x in group[m] for i in ids[x]], default=None) for m in distinct}
    return Counter((i, f"{m:016x}", first[m]) for i, m in marks)


def repeats(rows):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - 12):
                key = tuple(w[k : k + 13])
                first[key] = min(i, first.get(key, i))
    out = Counter()
    for i, w in words:
        gone = [False] * len(w)
        if i is not None:
            for k in range(len(w) - 12):
                if first[tuple(w[k : k + 13])] < i:
                    gone[k : k + 13] = [True] * 13
        kept = [x for x, y in zip(w, gone, strict=True) if not y]
        out[i, len(w), sum(gone), sha(" ".join(kept))] += 1
    return out


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def overlaps(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        w = BENCH_WORD.findall((text or "").translate(LOWER))
        n = min(13, len(w))
        if n and item is not None:
            for k in range(len(w) - n + 1):
                windows[tuple(w[k : k + n])].add(str(item))
    out = Counter()
    for i, text in rows:
        w = BENCH_WORD.findall((text or "").translate(LOWER))
        hit, found = [0] * len(w), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if items := windows.get(tuple(w[k : k + n])):
                    found |= items
                    hit[k : k + n] = [1] * n
        n = sum(hit)
        out[i, len(w), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(w)] += 1
    return out


BASE = [
    (
        "assign",
        re.compile(
            r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.I | re.A,
        ),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def secrets(rows, more):
    out = Counter()
    for i, text in rows:
        found = []
        for order, (kind, pattern, group, least) in enumerate(BASE + more):
            for m in pattern.finditer(text or ""):
                if len(m.group(group)) >= least:
                    found.append((m.start(), order, m.end(), kind))
        found.sort()
        named = [f"{kind}:{a}:{b}" for a, _, b, kind in found]
        base = [n for n, f in zip(named, found, strict=True) if f[1] < 3]
        counts = [sum(f[1] == k for f in found) for k in range(3)]
        out[(i, *counts, sha(",".join(base)), ",".join(named))] += 1
    return out


def archived(rows):
    first, out = {}, Counter()
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest in first:
            out[i, len(payload), digest, "revisit", first[digest]] += 1
        else:
            first[digest] = i
            out[i, len(payload), digest, "response", None] += 1
    return out


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )

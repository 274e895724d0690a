"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def fingerprint(text, width=3):
    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows, distance=2):
    """{id: (hex, smallest id)} of (id, text) rows."""
    prints = {i: fingerprint(t) for i, t in rows}
    root = {f: f for f in prints.values()}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in combinations(list(root), 2):
        if (a ^ b).bit_count() <= distance:
            root[find(a)] = find(b)
    least = defaultdict(list)
    for i, f in prints.items():
        least[find(f)].append(i)
    return {i: (f"{f:016x}", min(least[find(f)])) for i, f in prints.items()}


def without_repeats(texts, length):
    """[(n_bytes, n_removed, n_spans, kept)] of byte texts."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                covered[i:i + length] = b"\1" * length
        spans = sum(1 for i, c in enumerate(covered) if c and (not i or not covered[i - 1]))
        out.append((len(t), sum(covered), spans, bytes(b for b, c in zip(t, covered) if not c)))
    return out


def exact(rows):
    """{id: (keep, size, kept, sha)}"""
    sha = {i: hashlib.sha256(SPACE.sub(" ", t or "").encode()).hexdigest() for i, t in rows}
    groups = defaultdict(list)
    for i, s in sha.items():
        groups[s].append(i)
    return {i: (min(groups[s]), len(groups[s]), i == min(groups[s]), s) for i, s in sha.items()}


def quality_base(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count = Counter(windows)
    repeat = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeat), len(w) < 10 or 100 * len(repeat) > 20 * len(w))


def targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target}, by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        share = rest / sum(w[s] for s in open_) if open_ else 0
        above = {s for s in open_ if share * w[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else share * w[s] for s in order}
        capped |= above


def base_scores(rows):
    """{id: (held_out, n_tokens, n_known, N, base)}"""
    tokens = {i: words((t or "").translate(LOWER)) + [None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in tokens.items()}


def revisits(rows, least=1000):
    """{page: (bytes, sha1, type, refers_to)} of (page, html) rows."""
    payload = {p: (h or "").encode() for p, h in rows}
    last = {}
    for p, b in payload.items():
        if len(b) >= least:
            last[b] = max(p, last.get(b, p))
    return {p: (len(b), hashlib.sha1(b).hexdigest(), "response" if last.get(b, p) == p else "revisit", None if last.get(b, p) == p else last[b])
            for p, b in payload.items()}


def runs(w, least=12):
    """[(start, length, period)] of a list of words, by trying every period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((i, n, q) for (i, n), q in found.items())


def without_runs(w, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, w):
    """Words that the query repeats in every tenth text."""
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]

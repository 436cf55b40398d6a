"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
NORMAL = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def pieces(rows, tokenizer, capacity=4096):
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            out.append((doc_id, k, at, len(part), crc))
    return out


def near(rows, percent=85):
    sets = {}
    for doc_id, text in rows:
        w = WORD.findall(lower(text))
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            by[g].append(d)
    common = Counter((a, b) for ds in by.values() for a in ds for b in ds if a < b)
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return [(d, len(s), root(d), root(d) == d) for d, s in sets.items()]


def substrings(rows, k=13):
    words = {d: WORD.findall(t or "") for d, t in rows}
    first = {}
    for d, w in words.items():
        for i in range(len(w) - k + 1):
            g = tuple(w[i : i + k])
            first[g] = min(first.get(g, d), d)
    out = []
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < d:
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def hits(rows, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        w = NORMAL.findall(lower(text))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(g) for g in windows}
    out = []
    for d, text in rows:
        w = NORMAL.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[g]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": "[0-9]([\x20-]?[0-9])+",
    "phone": "\\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    text, out = text or "", {}
    for kind, pattern in PII.items():
        found = []
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            valid = {
                "email": True,
                "ip": kind == "ip" and all(int(x.lstrip("0")[:4] or 0) <= 255 for x in m.group().split(".")),
                "card": 13 <= len(d) <= 19 and luhn(d),
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if valid:
                found.append((m.start(), m.end()))
        out[kind] = found
    return out


def pii(rows):
    out = []
    for d, text in rows:
        spans = base_spans(text)
        listed = ",".join(f"{k}:{s}:{e}" for k, found in spans.items() for s, e in found)
        out.append((d, *(len(f) for f in spans.values()), hashlib.sha256(listed.encode()).hexdigest(), listed))
    return out


def quality(rows):
    out = []
    for d, text in rows:
        text = text or ""
        w = WORD.findall(text)
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        repeated = set()
        for i in range(len(w) - 7):
            if windows[tuple(w[i : i + 8])] > 1:
                repeated.update(range(i, i + 8))
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(w) < 20 or 100 * len(repeated) > 30 * len(w)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        out.append((d, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated), failed))
    return out


class Groups:
    """Connected components, named by their smallest member."""

    def __init__(self, nodes):
        self.parent = {x: x for x in nodes}

    def root(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)


def simhash(rows, k=3, budget=3):
    prints = {}
    for doc_id, text in rows:
        w = WORD.findall(lower(text))
        grams = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    groups = Groups(prints)
    for a, x in prints.items():
        for b, y in prints.items():
            if (x ^ y).bit_count() <= budget:
                groups.join(a, b)
    return [(d, bits, groups.root(d)) for d, bits in prints.items()]


def hard_negatives(rows, positives=5, negatives=3, low=50, high=95):
    out = []
    for k, (anchor, label, vector) in enumerate(rows):
        if anchor % 5:
            continue
        scores = [(-sum(x * y for x, y in zip(vector, v, strict=True)), i, other) for n, (i, other, v) in enumerate(rows) if n != k]
        scores.sort(key=lambda s: s[:2])
        for ps, positive, _ in [s for s in scores if s[2] == label][:positives]:
            inside = [s for s in scores if s[2] != label and low * ps >= 100 * s[0] >= high * ps][:negatives]
            out += [(anchor, positive, r, i, -ps, -s) for r, (s, i, _) in enumerate(inside, 1)]
    return sorted(out)


LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def audit(rows, least=10, top=10):
    named = [(LETTERS.findall(lower(text)), lang or "", source or "") for text, lang, source in rows]
    out = []
    for lang in {x[1] for x in named}:
        documents = Counter(w for ws, x, _ in named if x == lang for w in set(ws))
        kept = sorted(w for w, n in documents.items() if n >= least)
        groups = {s: Counter() for _, x, s in named if x == lang}
        whole = Counter()
        for ws, x, s in named:
            if x == lang:
                groups[s].update(w for w in ws if w in set(kept))
                whole.update(w for w in ws if w in set(kept))

        def shares(counts, kept=kept):
            below = counts.total() + 2 * len(kept)
            return {w: 1 + 10**9 * (counts[w] + 2) // below for w in kept}

        apart = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s in groups:
            pairs = sorted((-sum(apart(p[s][w], p[o][w]) for w in kept), o) for o in groups if o != s)
            terms = sorted((-apart(p[s][w], q[w]), w.encode()) for w in kept if groups[s][w] and p[s][w] > q[w])
            out += [(lang, s, "pair", r, o, -v) for r, (v, o) in enumerate(pairs, 1)]
            out += [(lang, s, "term", r, w.decode(), -v) for r, (v, w) in enumerate(terms[:top], 1)]
    return sorted(out)

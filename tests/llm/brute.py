"""Plain versions of the operators' results, over lists of rows, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").encode().lower()


def exact(rows):
    """{doc_id: (keep_id, group_size, kept, sha256)} of (doc_id, text)."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower(text)].append(doc_id)
    out = {}
    for text, ids in groups.items():
        for doc_id in ids:
            out[doc_id] = (max(ids), len(ids), doc_id == max(ids), hashlib.sha256(text).hexdigest())
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pii_base(text):
    """(kind, start, end) of the base kinds."""
    text, found = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m)
    checks = (
        ("email", EMAIL, lambda m: True),
        ("ip", IP, lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", CARD, lambda m: 16 <= len(digits(m)) <= 19 and _luhn(digits(m))),
        ("phone", PHONE, lambda m: 8 <= len(digits(m)) <= 15),
    )
    for kind, pattern, check in checks:
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if check(m[0])]
    return found


def listed(spans):
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def mix_targets(sizes, weights=(5, 2, 1), repeats=3):
    """{source: target} by sharing the excess again until no target is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(repeats * sizes[s] for s in capped)
        open_ = sum(weight[s] for s in names if s not in capped)
        goal = {s: repeats * sizes[s] if s in capped else rest * weight[s] / open_ for s in names}
        over = {s for s in names if s not in capped and goal[s] > repeats * sizes[s]}
        if not over:
            return goal
        capped |= over


RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def url_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def url_rule(host, path):
    best = None
    for rule in RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best):
                best = rule
    return best


def words(text):
    return SPACE.findall(lower(text))


def counts(texts):
    return Counter(w for t in texts for w in words(t))


def repeats(rows, window=50):
    """{row number: (n_bytes, n_removed, n_spans, sha256)} of rows (doc_id, text)."""
    first = {}
    data = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    for doc_id, text in data:
        for i in range(len(text) - window + 1):
            w = text[i : i + window]
            first[w] = min(first.get(w, doc_id), doc_id)
    out = []
    for doc_id, text in data:
        gone = bytearray(len(text))
        for i in range(len(text) - window + 1):
            if first[text[i : i + window]] < doc_id:
                gone[i : i + window] = b"\1" * window
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def shingles(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def linked(rows, percent=80):
    """Sorted (doc_id, n_shingles, component_id, n_links) of rows (doc_id, text), by all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(sets)
    for x, (i, a) in enumerate(sets):
        for y in range(x):
            j, b = sets[y]
            if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)) or not a or not b:
                continue
            both = len(a & b)
            if both * 100 >= percent * (len(a) + len(b) - both):
                links[x] += 1
                links[y] += 1
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return sorted((i, len(s), find(i), n) for (i, s), n in zip(sets, links))


def base_scores(rows):
    """{(doc_id, text): (held_out, n_tokens, n_known, train_tokens, base_score)}."""
    import math
    import zlib

    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, t in rows if not held(i) for w in [*words(t), None])
    total, distinct = sum(count.values()), len(count)
    out = {}
    for i, t in rows:
        tokens = [*words(t), None]
        score = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in tokens)
        out[i, t] = (held(i), len(tokens), sum(count[w] > 0 for w in tokens), total, score)
    return out

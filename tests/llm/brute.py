"""Plain Python versions of the operators' results, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def lower(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x)


def word_windows(docs, size):
    """doc_id, text rows -> (n_words, n_removed, kept_sha256) per row."""
    least = {}
    split = [(d, WORD.findall(x or "")) for d, x in docs]
    key = lambda d: float("inf") if d is None else d
    for d, w in split:
        for i in range(len(w) - size + 1):
            g = tuple(w[i:i + size])
            least[g] = min(least.get(g, float("inf")), key(d))
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if least[tuple(w[i:i + size])] < key(d):
                gone[i:i + size] = [True] * size
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def byte_windows(docs, size):
    data = [(d, (x or "").encode()) for d, x in docs]
    count = Counter(b[i:i + size] for _, b in data for i in range(len(b) - size + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if count[b[i:i + size]] > 1:
                gone[i:i + size] = b"\x01" * size
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def shingles(text, size):
    w = WORD.findall(lower(text or ""))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def near_groups(docs, size, percent):
    sets = [(d, shingles(x, size)) for d, x in docs]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least = defaultdict(list)
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)].append(d)
    return [(d, len(s), min(least[find(i)], default=None)) for i, (d, s) in enumerate(sets)]


def contaminated(docs, items, size):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text or ""))
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            windows[tuple(w[i:i + size])].add("" if item is None else str(item))
    sizes = {len(g) for g in windows}
    out = []
    for d, text in docs:
        w = ALNUM.findall(lower(text or ""))
        hit, found = [False] * len(w), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in windows:
                    hit[i:i + m] = [True] * m
                    found |= windows[tuple(w[i:i + m])]
        out.append((d, len(w), sum(hit), len(found), sha(",".join(sorted(found))), any(hit)))
    return out


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    marked = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(marked))


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(out)]


def personal(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


def span_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

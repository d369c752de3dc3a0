"""Plain Python versions of the operators' contracts, for small inputs."""

import collections
import fractions
import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = WORD.findall(lowered(text))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def jaccard_components(rows):
    """doc_id -> (n_shingles, component_id)."""
    sets = {i: shingles(t) for i, t in rows}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    union = Union(sets)
    for i, s in sets.items():
        shared = collections.Counter(j for g in s for j in holders[g] if j < i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                union.join(i, j)
    return {i: (len(s), union.find(i)) for i, s in sets.items()}


def quality_base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    count = collections.Counter(windows)
    covered = {k + j for k, g in enumerate(windows) if count[g] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = collections.Counter(f[3] for f in found)
    listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))
    return kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(listed.encode()).hexdigest()


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def url(value):
    """host, path, rule, verdict of the fixed rules."""
    if value is None or "://" not in value:
        return "", "", None, None
    rest = value.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = max(((d + p, v) for v, d, p in RULES if (host == d or host.endswith("." + d)) and path.startswith(p)),
               key=lambda x: len(x[0]), default=(None, None))
    return host, path, *best


def targets(sizes):
    """source -> target, from source -> size."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, out, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            out |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def edited(rows):
    """For rows (doc_id, text) sorted by doc_id: (doc_id, n_chars, edited text)."""
    texts = [t or "" for _, t in rows]
    for k, (i, _) in enumerate(rows):
        t, following = texts[k], texts[(k + 1) % len(texts)]
        h = len(t) // 2
        yield i, len(t), t[:len(t) - h] + following[:h]


def archive(rows):
    """page_id -> (bytes, digest, type, refers_to)."""
    last = {}
    for i, h in rows:
        p = (h or "").encode()
        if len(p) >= 1000:
            last[p] = max(i, last.get(p, i))
    out = {}
    for i, h in rows:
        p = (h or "").encode()
        to = last.get(p, i)
        out[i] = (len(p), hashlib.sha1(p).hexdigest(), "response" if to == i else "revisit", None if to == i else to)
    return out


def spelling_words(rows):
    """word -> occurrences after the contract's made-up misspellings, of enough length and occurrences."""
    count = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 97 == 0:
                run = "".join(c for k, c in enumerate(run) if k != h % len(run))
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def spelling_variants(rows):
    """word -> (form, root, n, n_near, form_n), near words by their common neighbours with one code point gone."""
    words = spelling_words(rows)
    gone = collections.defaultdict(set)
    for w in words:
        for k in range(len(w)):
            gone[w[:k] + w[k + 1:]].add((w, k))
    near = collections.defaultdict(set)
    for short, ws in gone.items():
        for w, k in ws:
            if short in words:
                near[w].add(short)
                near[short].add(w)
            near[w] |= {v for v, j in ws if j == k and v != w}
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 2 * words[w]:
                form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None)
    return out


def periodic_runs(words):
    """Every (start, length, period), by trying all periods at all places."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1 if j == i else j
    return sorted((s, length, q) for (s, length), q in found.items())


def run_row(i, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(i).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = sorted(periodic_runs(w), key=lambda r: (r[0], r[2]))
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-fractions.Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    return (i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())


def substring_dedup(rows, size=20):
    """doc_id -> (n_words, n_removed, digest of the kept words)."""
    texts = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(texts):
        for k in range(len(texts[i]) - size + 1):
            first.setdefault(tuple(texts[i][k:k + size]), (i, k))
    out = {}
    for i, w in texts.items():
        gone = {k + j for k in range(len(w) - size + 1) if first[tuple(w[k:k + size])] != (i, k) for j in range(size)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def byte_shingles(text, width=12):
    data = lowered(text).encode()
    ring = data + (data * width)[:width - 1]
    return {ring[k:k + width] for k in range(len(data))}

"""The operators in plain Python, straight from their definitions, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from statistics import NormalDist, mean, stdev

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


# ---- lines -------------------------------------------------------------------------------------


def line_key(line):
    return line.strip(BLANK).translate(LOWER)


def drop_shared_lines(docs, min_docs=10, min_chars=1, keep_first=False):
    """docs: (id, text). (id, text left, lines, dropped), repeated ids as one document."""
    seen = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            seen[line_key(line)].add(i)
    often = {k for k, ids in seen.items() if len(ids) >= min_docs and len(k) >= min_chars}
    first = {k: min((i for i in ids if i is not None), default=None) for k, ids in seen.items()}
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if line_key(x) not in often or (keep_first and i == first[line_key(x)])]
        left = "\n".join(kept) if len(kept) < len(lines) else text
        out.append((i, left, len(lines), len(lines) - len(kept)))
    return out


def text_stats(text, width=5):
    text = text or ""
    found = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(found[k : k + width]) for k in range(len(found) - width + 1)]
    count = Counter(grams)
    covered = {k + d for k, g in enumerate(grams) if count[g] > 1 for d in range(width)}
    return (
        len(found),
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


# ---- sets and links ----------------------------------------------------------------------------


def shingles(text, width=5):
    found = words((text or "").translate(LOWER))
    if not found:
        return frozenset()
    if len(found) < width:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[k : k + width]) for k in range(len(found) - width + 1))


def component_of(nodes, links):
    """Smallest node reachable, by node."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def jaccard_components(docs, width=5, percent=75):
    sets = [(i, shingles(t, width)) for i, t in docs if i is not None]
    links = [
        (i, j)
        for k, (i, a) in enumerate(sets)
        for j, b in sets[:k]
        if a and b and 100 * len(a & b) >= percent * len(a | b)
    ]
    return component_of({i for i, _ in sets}, links)


def cosine_links(rows, threshold=0.98):
    """rows: (id, vector, label). Positions of linked rows."""

    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        dot = sum(x * y for x, y in zip(a, b, strict=True))
        return dot / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))

    return [
        (p, q)
        for p, (_, a, la) in enumerate(rows)
        for q, (_, b, lb) in enumerate(rows[:p])
        if la is not None and la == lb and usable(a) and usable(b) and len(a) == len(b)
        and cosine(a, b) >= threshold
    ]


# ---- mixing ------------------------------------------------------------------------------------


def source_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """sizes: words by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped, total = set(), share * sum(sizes.values())
    while True:
        free = sum(weight[s] for s in sizes if s not in capped)
        level = (total - sum(epochs * sizes[s] for s in capped)) / free if free else 0.0
        over = {s for s in sizes if weight[s] * level > epochs * sizes[s]} | capped
        if over == capped:
            return {s: epochs * sizes[s] if s in capped else weight[s] * level for s in sizes}
        capped = over


def mix(docs, seed=7, epochs=2):
    """docs: (id, source, text). Copies by position."""
    size = [len(words(t)) for _, _, t in docs]
    by_source = defaultdict(list)
    for p, (_, source, _) in enumerate(docs):
        by_source[source].append(p)
    sizes = {s: sum(size[p] for p in ps) for s, ps in by_source.items()}
    targets, copies = source_targets(sizes), {}
    for s, ps in by_source.items():
        whole = int(targets[s] // sizes[s]) if sizes[s] else 0
        rest, run = targets[s] - whole * sizes[s], 0

        def key(p):
            i, _, text = docs[p]
            name = "null " + hashlib.md5((text or "").encode()).hexdigest() if i is None else i
            return hashlib.md5(f"{seed}:{name}".encode()).hexdigest(), size[p]

        for p in sorted(ps, key=key):
            more = size[p] > 0 and whole < epochs and 2 * run + size[p] <= 2 * rest
            copies[p], run = whole + more, run + size[p]
    return size, sizes, targets, copies


# ---- language model ----------------------------------------------------------------------------


class KneserNey:
    """Interpolated, modified, over bytes; texts begin after newlines."""

    def __init__(self, texts, order=5):
        self.order = order
        counts = Counter()
        for text in texts:
            data = b"\n" * (order - 1) + (text or "").encode()
            counts.update(data[k : k + order] for k in range(len(data) - order + 1))
        self.counts = {order: counts}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.discounts, self.totals = {}, {}
        for n, counted in self.counts.items():
            of = [sum(c == k for c in counted.values()) for k in (1, 2, 3, 4)]
            if all(of):
                y = of[0] / (of[0] + 2 * of[1])
                d = [k - (k + 1) * y * of[k] / of[k - 1] for k in (1, 2, 3)]
                d = [min(max(x, 0.05), k) for x, k in zip(d, (1, 2, 3), strict=True)]
            else:
                d = [0.5, 1.0, 1.5]
            self.discounts[n] = d
            total, taken = Counter(), defaultdict(float)
            for g, c in counted.items():
                total[g[:-1]] += c
                taken[g[:-1]] += d[min(c, 3) - 1]
            self.totals[n] = {h: (t, taken[h] / t) for h, t in total.items()}

    def probability(self, gram):
        if not gram:
            return 1 / 256
        n = len(gram)
        below = self.probability(gram[1:])
        if gram[:-1] not in self.totals[n]:
            return below
        total, weight = self.totals[n][gram[:-1]]
        c = self.counts[n].get(gram, 0)
        own = (c - self.discounts[n][min(c, 3) - 1]) / total if c else 0.0
        return own + weight * below

    def bits(self, text):
        """log2 perplexity per byte."""
        data = b"\n" * (self.order - 1) + text.encode()
        n = len(data) - self.order + 1
        return -sum(math.log2(self.probability(data[k : k + self.order])) for k in range(n)) / n


# ---- pieces ------------------------------------------------------------------------------------


def best_pieces(text, model, unknown_penalty=10.0):
    """Best segmentation by trying every piece that ends at each position; ids."""
    usable = {p: (s, i) for i, (p, s, k) in enumerate(zip(model.pieces, model.scores, model.kinds, strict=True)) if k in (1, 4)}
    byte = {int(p[3:-1], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == 6}
    longest = max(map(len, usable))
    unknown = min(s for s, _ in usable.values()) - unknown_penalty
    if not text:
        return []
    text = ("▁" if model.dummy_prefix else "") + text.replace(" ", "▁")
    best = [(0.0, 0, [])] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            piece = text[start:end]
            if piece in usable:
                score, ids = usable[piece][0], [usable[piece][1]]
            elif len(piece) == 1:
                score, ids = unknown, [byte[b] for b in piece.encode()]
            else:
                continue
            value = best[start][0] + score
            if best[end] is None or value > best[end][0]:
                best[end] = (value, start, ids)
    out, at = [], len(text)
    while at:
        _, start, ids = best[at]
        out[:0] = ids
        at = start
    return out


# ---- personal data and secrets -----------------------------------------------------------------


def luhn(digits):
    doubled = [int(c) * 2 if k % 2 else int(c) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_pii(text):
    out = []

    def add(kind, pattern, check):
        for m in re.finditer(pattern, text):
            if check(m[0], re.sub("[^0-9]", "", m[0])):
                out.append((m.start(), kind, m.end()))

    add(0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True)
    add(1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(x) <= 255 for x in m.split(".")))
    add(2, r"[0-9]([\x20-]?[0-9])+", lambda m, d: 12 <= len(d) <= 19 and luhn(d))
    add(3, r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 9 <= len(d) <= 15)
    return spans(out, ("email", "ip", "card", "phone"))


def base_secrets(text):
    out = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.IGNORECASE | re.ASCII):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return spans(out, ("assign", "access", "hex"))


def spans(found, kinds):
    return [f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found)]


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def own_step(values, quantile=0.99, sure=0.95, steps=512):
    """The limit of a language with few documents, in steps; None below three of them."""
    if len(values) < 3:
        return None
    z, u = NormalDist().inv_cdf(quantile), NormalDist().inv_cdf(sure)
    n = len(values)
    a, b = 1 - u * u / (2 * (n - 1)), z * z - u * u / n
    if a <= 0:
        return None
    k = (z + math.sqrt(max(z * z - a * b, 0))) / a
    at = sorted(values)[math.ceil(quantile * n) - 1]
    return max(math.ceil((mean(values) + k * stdev(values)) * steps), math.ceil(at * steps))

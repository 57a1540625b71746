"""Plain versions of what the operators do, and rows with every odd case."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import duckdb

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, copies int, _k1 int, ranges int"


def documents(folder=FOLDER):
    """``(doc_id, text, lang, source)`` of every document, by id."""
    return duckdb.sql(f"select doc_id, text, lang, source from '{folder}/documents.parquet' order by doc_id").fetchall()


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, other columns of known names."""
    long_text = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
    texts = [
        (1, "The cat of the house. " * 20, "en", "a"), (1, "The cat of the house. " * 20, "en", "a"),
        (1, "another text with the same id", "en", "b"), (2, None, "en", "a"), (3, "", "fr", None), (4, " \n\t ", None, None),
        (None, "no id here but the text is fine and long enough to be read", "de", "b"), (None, None, None, None),
        (5, long_text, "en", "hot"), (6, "x" * 30_000, "es", "hot"), (7, "1" * 20_000, "es", "hot"), (8, "é", "fr", "a"),
        (9, "a@b.co +1 843 555 4223 10.0.0.1 4111 1111 1111 1111", "en", "a"),
    ]
    return [(*t, None if t[1] is None else len(t[1]), 5, 6, 7, 8) for t in texts]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, n=5):
    w = words(text)
    return frozenset(zip(*[w[i:] for i in range(n)])) if len(w) >= n else frozenset([tuple(w)] if w else [])


def groups(texts, threshold=0.8):
    """Links and the smallest member of the class of every text, by comparing all pairs."""
    sets = [shingles(t) for t in texts]
    parent, links = list(range(len(sets))), Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i], sets[j]
        if len(a & b) >= threshold * len(a | b) - 1e-9:
            links[i] += 1
            links[j] += 1
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return [links[i] for i in range(len(sets))], [find(i) for i in range(len(sets))]


MAIL, IP = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD, PHONE = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    """``(start, kind, end)`` of the strict spans."""
    out = []
    for kind, pattern in enumerate((MAIL, IP, CARD, PHONE)):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def masked(text):
    """The text with its strict spans replaced by their kinds."""
    out, at = [], 0
    for start, kind, end in personal(text):
        if start >= at:
            out += [text[at:start], f"<{('email', 'ip', 'card', 'phone')[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def repeated_bytes(texts, length=400, keep_first=False):
    """Per text, which bytes are covered by a string of ``length`` bytes that occurs elsewhere (or before)."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    seen, out = set(), []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen if keep_first else counts[s] > 1:
                gone[i:i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def targets(sizes, weights=(5.0, 2.0, 1.0), most=3.0):
    """Targets by sharing again and again what limited sources leave; ``sizes`` in the sources' order."""
    total, limit = sum(sizes), [most * s for s in sizes]
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    full = set()
    while True:
        rest = total - sum(limit[i] for i in full)
        free = sum(w for i, w in enumerate(weight) if i not in full)
        share = [limit[i] if i in full else rest * weight[i] / free for i in range(len(sizes))]
        over = {i for i, s in enumerate(share) if i not in full and s > limit[i]}
        if not over:
            return share
        full |= over


class KneserNey:
    """Interpolated modified Kneser-Ney over symbols, by dictionaries and the recursive definition."""

    def __init__(self, sequences, order=5):
        self.order, self.counts = order, {order: Counter()}
        for s in sequences:
            padded = [1] * (order - 1) + s
            for i in range(len(s)):
                self.counts[order][tuple(padded[i:i + order])] += 1
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.discounts, self.totals, self.taken = {}, defaultdict(float), defaultdict(float)
        for k, counts in self.counts.items():
            n = Counter(min(c, 5) for c in counts.values())
            y = n[1] / (n[1] + 2 * n[2])
            found = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
            self.discounts[k] = [min(max(d, 0.05), i + 0.95) for i, d in enumerate(found)]
            for g, c in counts.items():
                self.totals[g[:-1], k] += c
                self.taken[g[:-1], k] += self.discounts[k][min(c, 3) - 1]

    def probability(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / 4096
        total = self.totals.get((gram[:-1], k))
        if not total:
            return self.probability(gram[1:])
        c = self.counts[k].get(gram, 0)
        own = max(c - self.discounts[k][min(c, 3) - 1], 0) / total if c else 0
        return own + self.taken[gram[:-1], k] / total * self.probability(gram[1:])

    def log_perplexity(self, s):
        padded = [1] * (self.order - 1) + s
        return -sum(math.log(self.probability(tuple(padded[i:i + self.order]))) for i in range(len(s))) / len(s)


def symbols(text):
    return [c + 2 if c < 3_000 else 3_002 + c % 1_000 for c in map(ord, text or "")]

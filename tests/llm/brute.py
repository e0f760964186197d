"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(text):
    return (text or "").translate(UPPER)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", fold(text))


def alphanumeric(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def decontaminated(docs, items, window=10):
    """(doc_id, words, hit words, item ids) of each row."""
    found = []
    for i, text in docs:
        words, hit, names = alphanumeric(text), set(), set()
        for item, other in items:
            own = alphanumeric(other)
            n = min(window, len(own))
            grams = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
            for k in range(len(words) - n + 1):
                if n and tuple(words[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    names.add(item)
        found.append((i, len(words), len(hit), tuple(sorted(map(str, names)))))
    return found


def unrepeated(docs, length=100):
    """doc_id -> (bytes, removed, runs, bytes left)"""
    seen, out = set(), {}
    for i, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if data[k : k + length] in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(data[k : k + length])
        runs = sum(1 for k in range(len(data)) if gone[k] and not (k and gone[k - 1]))
        out[i] = len(data), sum(gone), runs, bytes(x for x, g in zip(data, gone, strict=True) if not g)
    return out


def near_groups(docs, num, den, width=5):
    """doc_id -> (shingles, smallest doc_id of its group)"""
    sets = {}
    for i, text in docs:
        w = spaced(text)
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if den * shared >= num * (len(sets[a]) + len(sets[b]) - shared):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def lines_left(docs, least=10):
    """doc_id -> (lines, dropped, text left)"""
    lines = {i: (t or "").split("\n") for i, t in docs}

    def key(line):
        return fold(line.strip(" \t\n\v\f\r"))

    holders = collections.defaultdict(set)
    for i, own in lines.items():
        for line in own:
            if len(key(line)) >= least:
                holders[key(line)].add(i)
    out = {}
    for i, own in lines.items():
        left = [x for x in own if len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out[i] = len(own), len(own) - len(left), "\n".join(left)
    return out


def personal(text):
    """The base spans by the plain patterns."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in digits[-2::-2])) % 10 == 0:
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


class KneserNey:
    """Interpolated modified Kneser-Ney n-grams over dictionaries."""

    START, END = "<s>\n", "</s>\n"

    def __init__(self, texts, order=2):
        self.order = order
        rows = [self.tokens(t) for t in texts]
        self.count = collections.Counter(x for w in rows for x in w)
        self.levels = {order: collections.Counter(g for w in rows for g in self.grams(w, order))}
        for m in range(order - 1, 0, -1):
            own = collections.Counter()
            for g, n in self.levels[m + 1].items():
                own[g[1:]] += n if m > 1 and g[1] == self.START else 1
            self.levels[m] = own
        self.d = {m: self.discounts(own.values()) for m, own in self.levels.items()}
        self.total, self.followers = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
        for own in self.levels.values():
            for g, n in own.items():
                self.total[g[:-1]] += n
                self.followers[g[:-1]][min(n, 3) - 1] += 1

    def grams(self, words, m):
        padded = [self.START] * (m - 1) + words
        return [tuple(padded[k : k + m]) for k in range(len(words))]

    @classmethod
    def tokens(cls, text):
        return [*spaced(text), cls.END]

    @staticmethod
    def discounts(counts):
        t = collections.Counter(counts)
        if not (t[1] and t[2] and t[3]):
            return 0.5, 1.0, 1.5
        y = t[1] / (t[1] + 2 * t[2])
        found = 1 - 2 * y * t[2] / t[1], 2 - 3 * y * t[3] / t[2], 3 - 4 * y * t[4] / t[3]
        return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(found))

    @staticmethod
    def cut(c, d):
        return d[min(c, 3) - 1] if c else 0.0

    def p(self, gram):
        if not gram:
            return 1 / (len(self.count) + 1)
        context, lower = gram[:-1], self.p(gram[1:])
        if not self.total[context]:
            return lower
        c, d = self.levels[len(gram)][gram], self.d[len(gram)]
        rest = sum(x * y for x, y in zip(self.followers[context], d, strict=True))
        return (max(c - self.cut(c, d), 0) + rest * lower) / self.total[context]

    def score(self, text):
        return sum(math.log10(self.p(g)) for g in self.grams(self.tokens(text), self.order))

    def base(self, text):
        n, v = sum(self.count.values()), len(self.count)
        return sum(math.log10((self.count[x] + 1) / (n + v + 1)) for x in self.tokens(text))

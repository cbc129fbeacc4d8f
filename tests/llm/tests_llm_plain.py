"""Brute-force versions of the operators on small lists of documents."""
from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD4 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def low(text):
    return (text or "").translate(FOLD)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(docs):
    keys = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            k = low(line.strip(" \t\n\x0b\x0c\r"))
            if len(k) >= 10:
                keys.setdefault(k, set()).add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (k := keys.get(low(x.strip(" \t\n\x0b\x0c\r")))) or d == min(k)]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def unigram(docs):
    counts = collections.Counter()
    tokens = [(d, words(low(t)) + [None]) for d, t in docs]
    for d, tk in tokens:
        if zlib.crc32(str(d).encode()) % 7 != 2:
            counts.update(tk)
    n, v = sum(counts.values()), len(counts)
    return [(d, zlib.crc32(str(d).encode()) % 7 == 2, len(tk), sum(counts[w] > 0 for w in tk), n,
             sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tk)) for d, tk in tokens]


def suffix_tree(docs, min_context, min_symbol, penalty, max_words, discount=0.75):
    """log10 probability of each text: contexts of up to ``max_words`` words."""
    counts = {k: collections.Counter() for k in range(1, max_words + 2)}
    tokens = [(d, words(low(t)) + [None]) for d, t in docs]
    for d, tk in tokens:
        if zlib.crc32(str(d).encode()) % 7 != 2:
            for k in counts:
                counts[k].update(tuple(tk[i:i + k]) for i in range(len(tk) - k + 1))
    n, v = sum(counts[1].values()), len(counts[1])
    states = {}

    def p(ctx, w):
        if not ctx:
            return (counts[1][(w,)] + 1) / (n + v + 1)
        if ctx not in states:
            return p(ctx[1:], w)
        shares, factor = states[ctx]
        return shares[w] if w in shares else factor * p(ctx[1:], w)

    for size in range(1, max_words + 1):
        found = {}
        for key, c in counts[size + 1].items():
            if c >= min_symbol and counts[size][key[:-1]] >= min_context:
                found.setdefault(key[:-1], {})[key[-1]] = c
        for ctx, listed in found.items():
            total = counts[size][ctx]
            shares = {w: (c - discount) / total for w, c in listed.items()}
            upper = {w: p(ctx[1:], w) for w in listed}
            factor = max(1 - sum(shares.values()), 1e-12) / max(1 - sum(upper.values()), 1e-12)
            gain = sum(c * math.log(shares[w] / upper[w]) for w, c in listed.items()) + (total - sum(listed.values())) * math.log(factor)
            if gain > penalty * 0.5 * math.log(max(n, 2)) * (len(listed) + 1):
                states[ctx] = (shares, factor)
    return [(d, sum(math.log10(p(tuple(tk[max(0, i - max_words):i]), w)) for i, w in enumerate(tk))) for d, tk in tokens]


def decontaminate(docs, items, size=10):
    windows = []
    for name, t in items:
        w = WORD4.findall(low(t))
        k = min(size, len(w))
        windows += [(str(name), w[i:i + k]) for i in range(len(w) - k + 1)] if w else []
    out = []
    for d, t in docs:
        w = WORD4.findall(low(t))
        hit, names = set(), set()
        for name, win in windows:
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    names.add(name)
        out.append((d, len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return out


def targets(sizes):
    """Targets by source from (source, size) rows."""
    total = collections.Counter()
    for s, n in sizes:
        total[s] += n
    order = sorted(s for s in total if s is not None) + [None] * (None in total)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    capped = set()
    while True:
        open_ = [s for s in order if s not in capped]
        left = sum(total.values()) - sum(3 * total[s] for s in capped)
        share = sum(weight[s] for s in open_)
        got = {s: 3 * total[s] if s in capped else left * weight[s] / share for s in order}
        above = {s for s in open_ if got[s] > 3 * total[s] + 1e-9}
        if not above:
            return got
        capped |= above


def simhash(text):
    w = words(low(text))
    if not w:
        return 0
    parts = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, bits=3):
    """Smallest id reachable, from {id: fingerprint}."""
    ids = sorted(fps)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if label[b] < label[a] and (fps[a] ^ fps[b]).bit_count() <= bits:
                    label[a], changed = label[b], True
    return label


def measures(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = {k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover)


def substring_dedup(docs, size=20):
    seen = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - size + 1):
            k = tuple(w[i:i + size])
            seen[k] = min(seen.get(k, (d, i)), (d, i))
    out = []
    for d, t in docs:
        w = words(t)
        gone = {p for i in range(len(w) - size + 1) if seen[tuple(w[i:i + size])] < (d, i) for p in range(i, i + size)}
        out.append((d, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))))
    return out


def random_texts(seed, count, vocabulary=300, longest=120):
    """Texts with copies, near copies and shared passages."""
    rng = np.random.default_rng(seed)
    names = [f"w{i}" if i % 7 else f"é{i}," for i in range(vocabulary)]
    passage = [names[i] for i in rng.integers(0, vocabulary, 60)]
    out = []
    for i in range(count):
        own = [names[k] for k in (rng.zipf(1.3, int(rng.integers(1, longest))) - 1) % vocabulary]
        if out and i % 5 == 1:
            own = list(out[int(rng.integers(0, len(out)))])
        elif out and i % 5 == 2:
            own = list(out[int(rng.integers(0, len(out)))])
            own[int(rng.integers(0, len(own)))] = "changed"
        elif i % 5 == 3:
            at = int(rng.integers(0, len(own) + 1))
            a, b = sorted(rng.integers(0, 61, 2))
            own[at:at] = passage[a:b]
        out.append(own)
    return [" ".join(w) if i % 3 else "\n".join(" ".join(w[k:k + 9]) for k in range(0, len(w), 9)) for i, w in enumerate(out)]

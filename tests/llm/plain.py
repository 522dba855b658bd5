"""Plain versions of the operators, over lists of (doc_id, text)."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import xxhash

VOCAB = public_tokenizers.path("word_bpe_49k.json")


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def substring_dedup(docs, n=13):
    first = {}
    for d, t in docs:
        w = (t or "").encode().split()
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            if d is not None and first.get(k, d) >= d:
                first[k] = d
    out = []
    for d, t in docs:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if d is not None and first[tuple(w[i : i + n])] < d:
                gone[i : i + n] = [True] * n
        out.append((d, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def shingles_of(text, k):
    w = (text or "").encode().lower().split()
    return [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


def simhash(text, k=4, once=False):
    shingles = shingles_of(text, k)
    if once:
        shingles = set(shingles)
    count = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(shingles))


def near_duplicates(docs, budget=4):
    fps = [(d, simhash(t)) for d, t in docs]
    values = sorted({f for d, f in fps if d is not None})
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= budget:
                parent[find(a)] = find(b)
    least = {}
    for d, f in fps:
        if d is not None:
            r = find(f)
            least[r] = min(least.get(r, d), d)
    return [(d, f"{f:016x}", None if d is None else least[find(f)]) for d, f in fps]


def classes(values, linked):
    """The least value that each is connected to."""
    root = {}
    for v in sorted(values):
        if v in root:
            continue
        todo = [v]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = v
                todo += [y for y in values if y not in root and linked(x, y)]
    return root


def deduplicated(docs, words=5, least=0.8, k=2, budget=8):
    """(doc_id, text) that stay: one of each class of similar documents within a SimHash class."""
    docs = [(d, t or "") for d, t in docs]
    rows = sorted({(d, t) for d, t in docs if d is not None})
    fp = {t: simhash(t, k, once=True) for _, t in rows}
    near = classes(set(fp.values()), lambda a, b: (a ^ b).bit_count() <= budget)
    sets = {t: set(shingles_of(t, words)) for _, t in rows}

    def similar(a, b):
        if near[fp[a[1]]] != near[fp[b[1]]]:
            return False
        x, y = sets[a[1]], sets[b[1]]
        return len(x & y) >= least * len(x | y)

    root = classes(rows, similar)
    return [r for r in rows if root[r] == r] + [(d, t) for d, t in docs if d is None]


def contamination(docs, items, n=10):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def words(t):
        return pattern.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    windows = collections.defaultdict(set)
    for item, t in items:
        w = words(t)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add("" if item is None else str(item))
    out = []
    for d, t in docs:
        w, found = words(t), set()
        hit = [False] * len(w)
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if x := windows.get(tuple(w[i : i + size])):
                    found |= x
                    hit[i : i + size] = [True] * size
        out.append((d, len(w), sum(hit), len(found), sha(",".join(sorted(found))), any(hit)))
    return out


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCAB)


def token_files(docs):
    lib, out, start = library(), [], 0
    coded = [(d, lib.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in docs]
    for d, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0)):
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def bpe(docs):
    lib, out = library(), []
    for d, t in docs:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        out.append((d, len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))))
    return out


PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for kind, p in enumerate(PATTERNS):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = (lambda: True, lambda: all(int(x) <= 255 for x in m[0].split(".")), lambda: 12 <= len(digits) <= 19 and luhn(digits), lambda: 9 <= len(digits) <= 15)[kind]
            if ok():
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda x: (x[0], x[2]))

"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)


def secrets_of(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    found.sort()
    n = Counter(x[3] for x in found)
    joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in found)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(joined.encode()).hexdigest()


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(wins)
    covered = {j for i, w in enumerate(wins) if n[w] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words))


LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, size=4):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1))


def components(sets, percent):
    """Least key that is reachable by links, of each key of ``sets``."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for p, a in enumerate(keys):
        for b in keys[p + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def dropped_lines(texts, least=40, size=8, percent=80):
    """Line numbers that go, by id."""
    nodes, places = {}, []
    for i in sorted(texts):
        for k, x in enumerate((texts[i] or "").split("\n")):
            x = x.strip("\t\n\x0b\x0c\r ")
            if len(x) >= least:
                places.append((i, k, x))
                nodes.setdefault(x, frozenset(x[a:a + size] for a in range(len(x) - size + 1)))
    comp = components(nodes, percent)
    first, gone = set(), {}
    for i, k, x in places:
        if comp[x] in first:
            gone.setdefault(i, set()).add(k)
        first.add(comp[x])
    return gone


def without_lines(texts, gone):
    return {i: t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ()))
            for i, t in texts.items()}


def tiled_share(item, text, least=5):
    """Share of the item's words under greedy tiles, by trying all pairs of places."""
    a, b = (WORD.findall((t or "").translate(LOWER)) for t in (item, text))
    used_a, used_b, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and i + k not in used_a and j + k not in used_b:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return total / len(a) if a else 0.0
        used_a |= set(range(i, i + k))
        used_b |= set(range(j, j + k))
        total += k


def substring_dedup(rows, window):
    """(id, text) rows -> sorted (id, words, removed, kept text): every window of every row held against all smaller ids."""
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in words:
        gone = {j for s in range(len(w) - window + 1) if i is not None and least[tuple(w[s:s + window])] < i for j in range(s, s + window)}
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


def vector_codes(rows, entries=256, rounds=4):
    """(id, vector, label) rows of one length -> ({id: (code, error, label_error)}, the books as flat integers), in Python integers."""
    from fractions import Fraction
    from math import floor, isfinite
    kept = [(i, [floor(Fraction(x) * 1024) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    width = len(kept[0][1]) // 4
    cut = lambda v, p: v[p * width:(p + 1) * width]
    start = sorted(kept, key=lambda r: r[:2])[:entries]
    books = [[cut(v, p) for _, v, _ in start] for p in range(4)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(4):
            found = {}
            for _, v, _ in kept:
                found.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            for e, xs in found.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out = {i: ([near(cut(v, p), books[p]) for p in range(4)], lab) for i, v, lab in kept}
    total = Counter()
    for best, lab in out.values():
        total[lab] += sum(d for d, _ in best)
    return ({i: ("".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), total[lab]) for i, (best, lab) in out.items()},
            [x for book in books for c in book for x in c])


def rebuilt(rows, group=20, heads=4):
    """(conv_id, turn, role, text) rows -> {conv_id: [(role, text), ...]} with the head of the group's first conversation (remainders as SQL has them)."""
    import math
    import zlib
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            order = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own.setdefault(c, []).append(((turn is not None, turn or 0, order), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads if group else 0
        out[c] = own.get(c - int(math.fmod(c, group or 1)), [])[:h] + ts[h:]
    return out


def prefix_trie(convs):
    """{conv_id: [(role, text), ...]} -> sorted (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha)."""
    members = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    saved, leaves = Counter(), Counter()
    for path in sorted(members, key=len, reverse=True):
        saved[path] += (len(members[path]) - 1) * len(WORD.findall(path[-1][1])) if path else 0
        leaves[path] += 0 if path in kids else 1
        if path:
            saved[path[:-1]] += saved[path]
            leaves[path[:-1]] += leaves[path]
    return sorted(((min(m), len(path), min(members[path[:-1]]) if path else None, len(m), len(kids.get(path, [])), leaves[path], saved[path],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(path)).encode()).hexdigest())
                   for path, m in members.items()), key=repr)

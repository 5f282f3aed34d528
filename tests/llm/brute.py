"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substring(texts, width):
    """(words, removed, kept words joined) per text."""
    every = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + width]) for w in every for i in range(len(w) - width + 1))
    out = []
    for w in every:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text, k):
    w = words(lower_ascii(text))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def components(rows, k, percent):
    """{id: component} of (id, text) rows."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1:]:
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i, _ in rows}


def fingerprint(text, k=3, w=4):
    """[(hash, position)] of winnowed word k-grams."""
    prime, base = (1 << 31) - 1, 1_000_003
    h = [((xxhash.xxh64_intdigest(x.encode(), 42) + 2 ** 63) % 2 ** 64 - 2 ** 63) % prime for x in words(text)]

    def roll(xs):
        a = 0
        for x in xs:
            a = (a * base + x) % prime
        return a

    grams = [roll(h[i:i + k]) for i in range(len(h) - k + 1)] if len(h) >= k else [roll(h)] if h else []
    out = []
    for i in range(len(grams)):
        window = grams[i:i + w]
        at = (min(window), i + max(j for j, g in enumerate(window) if g == min(window)))
        if at not in out:
            out.append(at)
    return out


def likeness(a, b):
    a, b = {x for x, _ in a}, {x for x, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def conversation(rows):
    """Results of operator 13 for one conversation's rows (turn, role, text) in order, by trying every edit list."""
    seen, kinds = set(), []
    for _, role, text in rows:
        last = re.sub("[\x20\x09-\x0d]", "", text)[-1:]
        kinds.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    known = {}

    def least(i, tail, inserts):
        """(cost, edits, lines) of the cheapest, then ASCII-least, way on from row i after a row with initial ``tail``."""
        if (i, tail, inserts) in known:
            return known[i, tail, inserts]
        ways = [(0, "", ())] if i == len(rows) and tail in ("", "a") else []

        def go(cost, edit, line, at, to, n):
            c, e, rest = least(at, to, n)
            ways.append((cost + c, edit + e, ((line,) if line else ()) + rest))

        if inserts < 2:
            for new in ("user", "assistant"):
                if new[0] in follows[tail]:
                    go(3, "I", new + ":", i, new[0], inserts + 1)
        if i < len(rows):
            _, role, text = rows[i]
            go(4, "D", None, i + 1, tail, 0)
            if kinds[i] not in ("blank", "duplicate"):
                more = 3 if kinds[i] == "truncated" else 0
                if role[:1] and role[0] in follows[tail]:
                    go(more, "K", f"{role}:{text}", i + 1, role[0], 0)
                for new in ("user", "assistant"):
                    if new[0] in follows[tail]:
                        go(3 + more, "R", f"{new}:{text}", i + 1, new[0], 0)
        known[i, tail, inserts] = min(ways, default=(10 ** 9, "", ()))
        return known[i, tail, inserts]

    cost, edits, kept = least(0, "", 0)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, edits, sha("\n".join(kept)))


def damaged(rows):
    """{conv: damaged rows (turn, role, text) in order} of rows (conv, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        some = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        some += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    place = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())
    return {c: sorted(some, key=place) for c, some in out.items()}

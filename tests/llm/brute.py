"""The operators' results by plain loops over (doc_id, text) rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import xxhash


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def words(text, lower=False):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def substring(docs, k=20):
    order = lambda d, p: (d is None, d or 0, p)
    first, cut = {}, [(d, words(t)) for d, t in docs]
    for d, w in cut:
        for p in range(len(w) - k + 1):
            key = tuple(w[p : p + k])
            first[key] = min(first.get(key, order(d, p)), order(d, p))
    out = []
    for d, w in cut:
        gone = set()
        for p in range(len(w) - k + 1):
            if first[tuple(w[p : p + k])] < order(d, p):
                gone.update(range(p, p + k))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def contamination(docs, items, k=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    known = defaultdict(set)
    for item, t in items:
        w = cut(t)
        for p in range(max(1, len(w) - k + 1)):
            if w:
                known[tuple(w[p : p + k])].add("null" if item is None else str(item))
    sizes, out = {len(w) for w in known}, []
    for d, t in docs:
        w, hit, found = cut(t), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in known:
                    hit.update(range(p, p + n))
                    found |= known[tuple(w[p : p + n])]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    each = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in each) % 10 == 0


def personal(docs):
    digits = lambda x: re.sub("[^0-9]", "", x)
    checks = [
        ("email", EMAIL, lambda x: True),
        ("ip", IP, lambda x: all(int(p) <= 255 for p in x.split("."))),
        ("card", CARD, lambda x: 13 <= len(digits(x)) <= 19 and luhn(digits(x))),
        ("phone", PHONE, lambda x: 9 <= len(digits(x)) <= 15),
    ]
    out = []
    for d, t in docs:
        spans = [[(m.start(), m.end()) for m in re.finditer(p, t or "") if ok(m[0])] for _, p, ok in checks]
        named = ",".join(f"{k}:{a}:{b}" for (k, *_), own in zip(checks, spans) for a, b in own)
        out.append((d, *map(len, spans), sha(named)))
    return out


def simhash(docs, shingle=4, bits=4):
    def fingerprint(t):
        w = words(t, lower=True)
        s = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = [(d, fingerprint(t)) for d, t in docs]
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits:
                up[root(a)] = root(b)
    least = defaultdict(list)
    for d, f in rows:
        if d is not None:
            least[root(f)].append(d)
    return [(d, f"{f:016x}", min(least[root(f)], default=None)) for d, f in rows]


def exact(docs):
    groups, keyed = defaultdict(list), []
    for i, (d, t) in enumerate(docs):
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups[key].append((-len(t or ""), d is None, d or 0, i))
        keyed.append((d, key, i))
    out = []
    for d, key, i in keyed:
        best = min(groups[key])
        out.append((d, docs[best[3]][0], len(groups[key]), best[3] == i, sha(key)))
    return out


def packed_whole(rows, docs, ids_of, room=1024):
    """Asserts that pieces hold each document's ids once, in order, and sequences have no gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert Counter(r["doc_id"] for r in rows if r["start"] == 0) == Counter(d for d, _ in docs)
    for d, t in docs:
        ids = ids_of(t or "") + [0]
        if sum(1 for x, _ in docs if x == d) > 1:
            continue
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            own = ids[at : at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own))
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= room
    return sum(r["length"] for r in rows) / (room * len(by_sequence))


def runs(w, least=6, times=4):
    """(start, length, period) of all maximal runs, period by period."""
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            run = w[i : j + q]
            if len(run) >= max(least, times * q) and not any(run[r:] == run[:-r] for r in range(1, q)):
                out.append((i, len(run), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic(docs):
    """The rows of op11_periodic_runs, planted repeats included."""
    out = []
    for d, t in docs:
        w, h = words(t), 1 if d is None else zlib.crc32(str(d).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = runs(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if found else None
        out.append((d, len(found), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapse(w, found))))
    return out


def trie(rows):
    """The rows of op12_prefix_trie from (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            turns[c].append((n is not None, n or 0, role or "", text or ""))
    own, whole = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}, {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for k in members:
        children[k[:-1]] += [k] if k else []
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = sum(saved[x] for x in children[k]) + ((len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0)
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k], sha(ends)))
    return out


def phrases(data: bytes, sample: bytes, stretch: int):
    """How many longest matches with the sample, or else single bytes, cover the data, cut in stretches."""
    n = 0
    for a in range(0, len(data), stretch):
        piece, i = data[a : a + stretch], 0
        while i < len(piece):
            j = i + 1
            while j < len(piece) and piece[i : j + 1] in sample:
                j += 1
            i, n = j, n + 1
    return n


def folded(text) -> bytes:
    """Bytes in lower case, with one space for what stands between letters."""
    return re.sub(rb"[\x00-\x60\x7b-\x7f]+", b" ", re.sub(b"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))

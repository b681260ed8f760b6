"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def passages(docs, window=50):
    """doc_id -> (n_words, n_removed, kept_sha256)."""
    words = {d: WORDS.findall(t or "") for d, t in docs}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i:i + window]), d)
    out = {}
    for d, w in words.items():
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone[i:i + window] = True
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[d] = (len(w), int(gone.sum()), sha(" ".join(kept).encode()))
    return out


def strings(docs, window=100):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, np.int64)
        for i in range(len(data) - window + 1):
            s = data[i:i + window]
            if s in seen:
                gone[i] += 1
                gone[i + window] -= 1
            seen.add(s)
        gone = gone.cumsum()[:-1] > 0
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0
        out[d] = (len(data), int(gone.sum()), spans, sha(bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return out


def components(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def simhash(text):
    from xxhash import xxh64_intdigest

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def simhash_classes(docs, distance=3):
    fp = {d: simhash(t) for d, t in docs}
    by = defaultdict(list)
    for d, f in fp.items():
        by[f].append(d)
    prints = np.array(list(by), np.uint64)
    links = [(ids[0], x) for ids in by.values() for x in ids[1:]]
    for k, f in enumerate(prints):
        near = np.flatnonzero(np.bitwise_count(prints ^ f) <= distance)
        links += [(by[int(f)][0], by[int(prints[j])][0]) for j in near if j > k]
    parts = components(fp, links)
    return {d: (f"{fp[d]:016x}", parts[d]) for d in fp}


def first_of_similar(docs, least=0.8, size=5):
    """Ids that are the least of what links of that share of common word shingles reach; all pairs are compared."""
    def shingles(text):
        w = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
        w = WORDS.findall(w)
        return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}

    sets = {d: shingles(t) for d, t in docs}
    ids = list(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least]
    parts = components(ids, links)
    return {d for d in ids if parts[d] == d}


def sound(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def nearest(rows, queries, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if sound(v)]
    ids, m = np.array([i for i, _ in good]), np.array([v for _, v in good])
    norm = np.sqrt((m * m).sum(axis=1))
    out = {}
    for q in np.flatnonzero([queries(i) for i in ids]):
        score = (m @ m[q]) / (norm * norm[q])
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if j != q][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def embedding_links(rows, least=0.9):
    """vec_id -> (n_links, component_id)."""
    good = [(i, np.array(v, float)) for i, v in rows if sound(v)]
    ids, m = [i for i, _ in good], np.array([v for _, v in good])
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    near = m @ m.T >= least
    np.fill_diagonal(near, False)
    parts = components([i for i, _ in rows], [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(near)), strict=True)])
    n = {i: int(x) for i, x in zip(ids, near.sum(axis=1), strict=True)}
    return {i: (n.get(i, 0), parts[i]) for i, _ in rows}


def pieces(docs, path, limit=1024):
    """(doc_id, piece) -> (start, length, crc)."""
    from tokenizers import Tokenizer

    lib, out = Tokenizer.from_file(path), {}
    for d, t in docs:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        at, k, n = 0, 0, len(ids)
        size = n if n <= limit else (n % limit or limit)
        while at < n:
            out[d, k] = (at, size, zlib.crc32(np.array(ids[at:at + size], "<u4").tobytes()))
            at, k, size = at + size, k + 1, limit
    return out


def periodic_runs(words, least=6, periods=4):
    """All runs (start, length, period) of a list of words."""
    n, out = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            x = words[i:j + q]
            if len(x) >= max(least, periods * q) and not any(all(x[t] == x[t + p] for t in range(len(x) - p)) for p in range(1, q)):
                out.append((i, len(x), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def looped(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs_row(doc_id, text):
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)"""
    from fractions import Fraction

    words = looped(doc_id, WORDS.findall(text or ""))
    runs = periodic_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone).encode()))


def damaged(rows):
    """(conv, turn, role, text) after the damage, in order; dict conv -> rows."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out[conv] += [(turn, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = WORDS.findall(text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1][-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest_edits(rows):
    """(cost, audit, repaired rows) for (role, text, fault) rows, over all edits in every state of the pattern."""
    import functools

    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        for role in ("user", "assistant"):
            if inserts < 4 and (to := after.get((state, role[0]))):
                cost, audit, rest = best(i, to, inserts + 1)
                found.append((cost + 2, "I" + audit, ((role, ""), *rest)))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, rest = best(i + 1, state, 0)
            found.append((cost + 3, "D" + audit, rest))
            if fault not in ("blank", "duplicate"):
                for letter, new in (("K", role), ("R", "user"), ("R", "assistant")):
                    if to := after.get((state, new[:1])):
                        cost, audit, rest = best(i + 1, to, 0)
                        found.append((cost + 2 * (letter == "R") + (fault == "truncated"), letter + audit, ((new, text), *rest)))
        return min(found) if found else (10**9, "", ())
    for i in range(len(rows), 0, -1):  # from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def repairs(rows):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)"""
    out = {}
    for conv, mine in damaged(rows).items():
        kinds, turns = faults(mine), [t for t, _, _ in mine if t is not None]
        cost, audit, left = cheapest_edits(tuple((r, x, f) for (_, r, x), f in zip(mine, kinds, strict=True)))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False)), cost, audit, sha("\n".join(f"{r}:{x}" for r, x in left).encode()))
    return out

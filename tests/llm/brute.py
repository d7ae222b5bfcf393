"""Plain Python versions of the contracts, for small inputs."""

import hashlib
import re

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_Z))


def reachable(nodes, links):
    """Each node's smallest reachable node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def op3(docs, percent=85):
    sets = {}
    for i, t in docs:
        w = words(t)
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    at = {}
    for i, s in sets.items():
        for g in s:
            at.setdefault(g, []).append(i)
    pairs = {(a, b) for ids in at.values() for a in ids for b in ids if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = reachable(sets, links)
    return {(i, len(s), root[i], root[i] == i) for i, s in sets.items()}


def op4(docs, size=400):
    data = {i: (t or "").encode() for i, t in docs}
    at = {}
    for i, b in data.items():
        for j in range(len(b) - size + 1):
            at.setdefault(b[j : j + size], []).append((i, j))
    cover = {i: bytearray(len(b)) for i, b in data.items()}
    for places in at.values():
        if len(places) > 1:
            for i, j in places:
                cover[i][j : j + size] = b"\1" * size
    return {(i, len(b), sum(cover[i]), len(re.findall(b"\1+", cover[i])), sha(bytes(x for x, c in zip(b, cover[i]) if not c))) for i, b in data.items()}


def op5(docs, items):
    def own(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(A_Z))

    windows = {}
    for item, t in items:
        w = own(t)
        n = min(10, len(w))
        for j in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[j : j + n]), set()).add(str(item))
    sizes, out = {len(w) for w in windows}, set()
    for i, t in docs:
        w, hit, found = own(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[j : j + n]))) is not None:
                    hit |= set(range(j, j + n))
                    found |= x
        out.add((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def op7(docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(A_Z)
    holders = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(i)
    out = set()
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(h := holders.get(key(x), ())) < 5 or i == max(h)]
        out.add((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def op8(rows):
    import numpy as np

    ok = {i: np.array(v, float) for i, v, label in rows if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    label = {i: x for i, _, x in rows}
    ids = sorted(ok)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if label[a] == label[b] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= 0.98]
    root = reachable(label, links)
    return {(i, sum(i in x for x in links), root[i], root[i] == i) for i in label}


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def op10(docs):
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    out = set()
    for i, t in docs:
        found = {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, t or "") if ok(m[0])] for k, (p, ok) in kinds.items()}
        out.add((i, *[len(x) for x in found.values()], sha(",".join(x for v in found.values() for x in v))))
    return out

"""Plain versions of what the operators compute."""

import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text):
    w = WORD.findall(low(text))
    shingles = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints):
    """{id: smallest reachable id} for {id: fingerprint}."""
    ids, root = sorted(prints), {}
    for i in ids:
        if i in root:
            continue
        todo, root[i] = [i], i
        while todo:
            a = todo.pop()
            for b in ids:
                if b not in root and (prints[a] ^ prints[b]).bit_count() <= 4:
                    root[b] = i
                    todo.append(b)
    return root


def stats(text):
    w, lines = WORD.findall(text or ""), (text or "").split("\n")
    grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    twice = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    real = [x for x in lines if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(real) - len(set(real)), len(twice))


def contamination(texts, items, window=13):
    """{id: (words, hit words, sorted items)}"""
    wins = {}
    for i, t in items:
        w = ALNUM.findall(low(t))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add(str(i))
    out = []
    for t in texts:
        w, hit, found = ALNUM.findall(low(t)), set(), set()
        for s in {len(x) for x in wins}:
            for k in range(len(w) - s + 1):
                o = wins.get(tuple(w[k:k + s]))
                if o:
                    hit.update(range(k, k + s))
                    found |= o
        out.append((len(w), len(hit), sorted(found)))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text or "") if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0])))

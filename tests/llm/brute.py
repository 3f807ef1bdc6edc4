"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, k: int) -> frozenset:
    words = WORD.findall(lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(zip(*[words[j:] for j in range(k)], strict=False)) if len(words) >= k else frozenset([tuple(words)])


def near(rows: list[tuple], k: int) -> list[tuple]:
    """(id, n_shingles, component_id, kept) for (id, text) rows."""
    rows = [(LAST if i is None else i, shingles(t, k)) for i, t in rows]
    nodes: dict[frozenset, int] = {}
    for i, s in rows:
        if s:
            nodes[s] = min(i, nodes.get(s, LAST))
    parent = {n: n for n in nodes.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = list(nodes)
    for n, a in enumerate(sets):
        for b in sets[:n]:
            common = len(a & b)
            if 100 * common >= 80 * (len(a) + len(b) - common):
                x, y = sorted((root(nodes[a]), root(nodes[b])))
                parent[y] = x
    shown = lambda i: None if i == LAST else i
    found = [(i, len(s), root(nodes[s]) if s else i) for i, s in rows]
    return sorted(((shown(i), n, shown(c), i == c) for i, n, c in found), key=repr)


def line_parts(rows: list[tuple]) -> list[tuple]:
    """(id, text, its lines, those that stay) for (id, text) rows."""
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    holders: dict[str, set] = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(LAST if i is None else i)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == (LAST if i is None else i)]
        out.append((i, t, all_lines, kept))
    return out


def lines(rows: list[tuple]) -> list[tuple]:
    """(id, n_lines, n_dropped, kept text) for (id, text) rows."""
    return sorted(((i, len(a), len(a) - len(k), "\n".join(k)) for i, _, a, k in line_parts(rows)), key=repr)


def not_emptied(rows: list[tuple]) -> list[tuple]:
    """(id, kept text) without the rows that had words and have none left."""
    return [(i, "\n".join(k)) for i, t, _, k in line_parts(rows) if WORD.search("\n".join(k)) or not WORD.search(t or "")]


def secrets(text: str | None) -> tuple[int, int, int, str]:
    text, found = text or "", []
    for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m.group(1)) >= 12:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
    counts = Counter(k for _, k, _ in found)
    listed = ",".join(f"{['assign', 'access', 'hex'][k]}:{s}:{e}" for s, k, e in sorted(found))
    return counts[0], counts[1], counts[2], hashlib.sha256(listed.encode()).hexdigest()


def owned_secrets(rows: list[tuple], wide: int = 3) -> list[tuple]:
    """(id, spans, n_live, n_shared, n_copied) for (id, text, owner) rows."""
    found, owners = [], {}
    for i, text, owner in rows:
        text, mine = text or "", []
        for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
            mine += [(m.start(), 0, m.end(), m[1])] if len(m[1]) >= 12 else []
        mine += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        mine += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        taken = {x for s, _, e, _ in mine for x in range(s, e)}
        for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
            v = m[0]
            varied = -sum(v.count(c) / len(v) * math.log2(v.count(c) / len(v)) for c in set(v)) >= 3
            if varied and re.search("[0-9]", v) and re.search("[A-Za-z]", v) and not taken & set(range(m.start(), m.end())):
                mine.append((m.start(), 3, m.end(), v))
        for *_, v in mine:
            owners.setdefault(v, set()).add(owner)
        found.append((i, sorted(mine)))
    out = []
    for i, mine in found:
        n = [len(owners[v]) for *_, v in mine]
        listed = ",".join(f"{['assign', 'access', 'hex', 'token'][k]}:{s}:{e}" for s, k, e, v in mine if k < 3 or len(owners[v]) == 1)
        out.append((i, listed, n.count(1), sum(1 < x < wide for x in n), sum(x >= wide for x in n)))
    return sorted(out, key=repr)


def crc(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def chat(turns: list[tuple[str, str]]) -> tuple:
    listed = "".join(f"{r}\n{t}\n" for r, t in turns)
    trained = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(listed.encode()).hexdigest(), len(trained), hashlib.sha256(trained.encode()).hexdigest()

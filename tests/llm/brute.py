"""Plain Python versions of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def cut_bytes(texts: list[str | None], window: int) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of every text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if count[d[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, sha(bytes(b for b, g in zip(d, gone, strict=True) if not g))))
    return out


def cut_words(rows: list[tuple], window: int) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) of every (doc_id, text); a missing id comes last."""
    last = float("inf")
    first: dict[tuple, float] = {}
    split = [(last if i is None else i, words(t)) for i, t in rows]
    for i, w in split:
        for j in range(len(w) - window + 1):
            k = tuple(w[j : j + window])
            first[k] = min(first.get(k, last), i)
    out = []
    for i, w in split:
        gone = bytearray(len(w))
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < i:
                gone[j : j + window] = b"\1" * window
        out.append((None if i == last else i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def base_figures(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = words(text)
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    covered = {j for i, k in enumerate(windows) if count[k] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def classes(nodes, links) -> dict:
    """The least node of each node's component."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def line_links(lines: list[str], edits: int, min_chars: int) -> list[tuple[str, str]]:
    by_length = defaultdict(list)
    for x in lines:
        if len(x) >= min_chars:
            by_length[len(x)].append((x, Counter(x)))
    out = []
    for n, own in by_length.items():
        for m in range(n, n + edits + 1):
            for i, (a, p) in enumerate(own):
                for b, q in by_length[m][i + 1 :] if m == n else by_length.get(m, ()):
                    if sum((p - q).values()) <= edits and sum((q - p).values()) <= edits and edit_distance(a, b) <= edits:
                        out.append((a, b))
    return out


def line_rows(rows: list[tuple], edits: int, min_chars: int) -> dict:
    """doc_id -> (n_lines, n_exact, n_near, n_links, kept_sha256), for distinct ids."""
    first: dict[str, tuple] = {}
    order = lambda i, p: (i is not None, i or 0, p)
    for i, t in sorted(set(rows), key=lambda r: order(r[0], 0)):
        for p, x in enumerate(t.split("\n") if t is not None else []):
            if WORD.search(x):
                first.setdefault(x, order(i, p))
    links = line_links(list(first), edits, min_chars)
    degree = Counter(x for pair in links for x in pair)
    lead = classes(first.values(), [(first[a], first[b]) for a, b in links])
    out = {}
    for i, t in rows:
        kept, n, exact, near, linked = [], 0, 0, 0, 0
        for p, x in enumerate(t.split("\n") if t is not None else []):
            if not WORD.search(x):
                kept.append(x)
                continue
            n, linked = n + 1, linked + degree[x]
            if lead[first[x]] == order(i, p):
                kept.append(x)
            elif first[x] == order(i, p):
                near += 1
            else:
                exact += 1
        out[i] = (n, exact, near, linked, sha("\n".join(kept)))
    return out


def similar_pairs(sets: list[dict], similarity: float) -> list[tuple[int, int]]:
    """Pairs of weighted sets with a weighted Jaccard similarity of at least ``similarity``."""
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = Counter((a, b) for v in holders.values() for n, b in enumerate(v) for a in v[:n])
    out = []
    for a, b in shared:
        both = sum(min(w, sets[b][x]) for x, w in sets[a].items() if x in sets[b])
        if both / (sum(sets[a].values()) + sum(sets[b].values()) - both) >= similarity:
            out.append((a, b))
    return out

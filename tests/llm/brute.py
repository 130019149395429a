"""Plain Python versions of what SQL does not express, for small inputs."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict


def bytes_removed(texts: list[str | None], width: int) -> list[tuple[int, int, int, str]]:
    """(bytes, removed, runs, digest of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + width] for r in raw for i in range(len(r) - width + 1))
    found = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - width + 1):
            if seen[r[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        rest = bytes(b for b, g in zip(r, gone) if not g)
        found.append((len(r), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return found


def shingles(text: str | None, size: int = 5) -> set[bytes]:
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def linked_components(docs: list[tuple[int, str | None]], percent: int = 75, size: int = 5) -> dict[int, tuple[int, int]]:
    """Size of the shingle set and least reachable id of each document."""
    sets = {d: shingles(t, size) for d, t in docs}
    lists = defaultdict(list)
    for d in sorted(sets):
        for s in sets[d]:
            lists[s].append(d)
    shared = Counter((own[j], own[i]) for own in lists.values() for i in range(len(own)) for j in range(i))
    parent = {d: d for d in sets}

    def root(d: int) -> int:
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {d: (len(sets[d]), root(d)) for d in sets}


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def merkle_rows(rows: list[dict], columns: list[str], changed) -> list[tuple]:
    """(id, leaf, subroot, root, digest of the siblings, folded root) of each row; ``changed`` alters a row before folding."""

    def leaf(row: dict) -> str:
        return digest("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in columns))

    def tree(level: list[str]) -> tuple[str, list[list[tuple[bool, str]]]]:
        steps, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for leaf_no, i in enumerate(at):
                steps[leaf_no].append((i % 2 == 1, level[i ^ 1]) if i ^ 1 < len(level) else (False, ""))
            at = [i // 2 for i in at]
            level = [digest("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        return level[0], steps

    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    if not names:
        return []
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {name: tree([leaf(r) for r in groups[name]]) for name in names}
    root, above = tree([trees[name][0] for name in names])
    found = []
    for name, rest in zip(names, above):
        for row, steps in zip(groups[name], trees[name][1]):
            node = leaf(changed(row))
            for left, other in steps + rest:
                node = digest(other + node if left else node + other)
            siblings = digest("".join(other for _, other in steps + rest))
            found.append((row["doc_id"], leaf(row), trees[name][0], root, siblings, node))
    return found


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one insertion, deletion or replacement."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    cuts = range(len(b))
    return any(a[:i] + a[i + 1 :] == b[:i] + b[i + 1 :] for i in cuts) if len(a) == len(b) else any(a == b[:i] + b[i + 1 :] for i in cuts)


def variants(words: dict[str, int], ratio: int = 5) -> dict[str, tuple]:
    """(form, root, n, near words, n of the form) of each word."""
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w: str) -> str:
        return root(form[w]) if form[w] is not None else w

    return {w: (form[w], root(w), n, len(near[w]), words[form[w]] if form[w] is not None else None) for w, n in words.items()}

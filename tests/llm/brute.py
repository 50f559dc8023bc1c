"""Plain Python versions of the operators, for small tables."""

import hashlib
import re

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in BLANKS.split(text or "") if w]


def shingles(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def groups(rows, n, percent):
    """{doc_id: (set size, component)} of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t, n) for i, t in rows}
    above = {i: i for i in sets}

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in holders.values() for k, a in enumerate(ids) for b in ids[:k]}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            above[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def passages(rows, length):
    """{(doc_id, text): (words, removed, sha256 of the rest)}."""
    first = {}
    split = [(i, t, words(t)) for i, t in rows]
    for i, _, w in split:
        for k in range(len(w) - length + 1):
            x = tuple(w[k : k + length])
            first[x] = min(first.get(x, i), i)
    out = {}
    for i, t, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        rest = " ".join(x for x, g in zip(w, gone) if not g)
        out[i, t] = (len(w), sum(gone), hashlib.sha256(rest.encode()).hexdigest())
    return out


def repeated(text, n=3):
    w = words(text)
    grams = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    hit = {j for i, g in enumerate(grams) if seen[g] > 1 for j in range(i, i + n)}
    return len(hit)


def dup_lines(text):
    seen, n = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            n += line in seen
            seen.add(line)
    return n


def lines_left(rows, min_chars, min_docs):
    """[(doc_id, lines, dropped, text)] of (doc_id, text) rows; a null id is less than any other."""
    ends = " \t\n\v\f\r"

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(ends))

    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    rank = lambda i: (i is not None, i)
    keeper = {k: max(ids, key=rank) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [s for s in lines if keeper.get(key(s), i) == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def merkle(rows, fan=8):
    """[(doc_id, leaf, subroot, root, proof, path)] of (doc_id, source, lang, n_chars, text) rows."""

    def tree(digests):
        """The root, and for each leaf the (left, right) siblings up to it."""
        paths = [[] for _ in digests]
        spans, level = [[i] for i in range(len(digests))], digests
        while len(level) > 1:
            above, joined = [], []
            for k in range(0, len(level), fan):
                run = level[k : k + fan]
                for j in range(len(run)):
                    for i in spans[k + j]:
                        paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
                above.append(_h(*run))
                joined.append([i for s in spans[k : k + fan] for i in s])
            spans, level = joined, above
        return level[0], paths

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], _leaf(row)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        leaves = sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = leaves, *tree([d for _, d in leaves])
    root, upper = tree([trees[g][1] for g in order]) if order else (None, [])
    out = []
    for g, up in zip(order, upper):
        leaves, subroot, paths = trees[g]
        for (i, d), path in zip(leaves, paths):
            whole = path + up
            out.append((i, d, subroot, root, _h(*(x for p in whole for x in p)), whole))
    return out


def spelling(counts, ratio=10):
    """{word: (form, root, n, n_near, form_n)} of {word: n}."""

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    forms, close = {}, {}
    for w, n in counts.items():
        close[w] = [v for v in counts if near(w, v)]
        best = min(((-counts[v], v) for v in close[w] if counts[v] >= ratio * n), default=None)
        forms[w] = best and best[1]
    out = {}
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (forms[w], root, n, len(close[w]), forms[w] and counts[forms[w]])
    return out

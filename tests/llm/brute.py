"""Plain versions of the operators, to compare results with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(documents):
    """doc_id -> (number of shingles, smallest linked id), for (doc_id, text) pairs with distinct ids."""
    sets = {i: shingles(t) for i, t in documents}
    parent = {i: i for i in sets}
    holders = {}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in sorted(sets):
        common = {}
        for s in sets[i]:
            for j in holders.setdefault(s, []):
                common[j] = common.get(j, 0) + 1
            holders[s].append(i)
        for j, k in common.items():
            if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def token_count(text, vocabulary):
    longest = max(map(len, vocabulary))
    total = 0
    for word in WORD.findall(text or ""):
        rest = b" " + word.encode()
        while rest:
            size = next(n for n in range(min(longest, len(rest)), 0, -1) if rest[:n] in vocabulary)
            rest = rest[size:]
            total += 1
    return total


BASE = (
    ("assign", re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
)


def base_spans(text):
    found = [(m.start(), k, m.end()) for k, (_, pattern, long) in enumerate(BASE) for m in pattern.finditer(text or "") if long(m)]
    return ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in sorted(found))

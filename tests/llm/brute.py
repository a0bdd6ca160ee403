"""Plain single-machine versions of the operators, as the tests' measure."""

import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


class Groups:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text, k):
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def jaccard(texts, k, num, den):
    """{id: (n, component)} of {id: text}."""
    sets = {d: shingles(t, k) for d, t in texts.items()}
    lists, common = defaultdict(list), Counter()
    for d in sorted(sets):
        for g in sets[d]:
            lists[g].append(d)
    for ids in lists.values():
        common.update((a, b) for i, b in enumerate(ids) for a in ids[:i])
    groups = Groups(sets)
    for (a, b), n in common.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            groups.join(a, b)
    return {d: (len(s), groups.find(d)) for d, s in sets.items()}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def lines(texts, limit, least):
    """{id: (lines, dropped)} of {id: text}."""
    at = [(d, i, x.strip(" \t\r\x0b\x0c")) for d in sorted(texts) for i, x in enumerate((texts[d] or "").split("\n"))]
    at = [x for x in at if x[2]]
    distinct = sorted({x[2] for x in at}, key=len)
    groups = Groups(distinct)
    long = [x for x in distinct if len(x) >= least]
    for i, a in enumerate(long):
        for b in long[i + 1 :]:
            if len(b) - len(a) > limit:
                break
            if sum((Counter(a) - Counter(b)).values()) <= limit and edits(a, b) <= limit:
                groups.join(a, b)
    first, out = {}, {d: [0, []] for d in texts}
    for d, i, x in at:
        first.setdefault(groups.find(x), (d, i))
        out[d][0] += 1
        if first[groups.find(x)] != (d, i):
            out[d][1].append(i)
    return {d: tuple(v) for d, v in out.items()}


def overlaps(texts, items, window, allowed, least):
    """{(id, item)} where ``window`` words of the item agree but for ``allowed(window)`` ones."""
    plain = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    found = set()
    words = {d: plain.findall((t or "").lower()) for d, t in texts.items()}
    for i, t in items.items():
        own = plain.findall((t or "").lower())
        if len(own) < least:
            continue
        w = min(window, len(own))
        for d, doc in words.items():
            for shift in range(-len(own) + 1, len(doc)):
                low, high = max(0, shift), min(len(doc), shift + len(own))
                same = [doc[p] == own[p - shift] for p in range(low, high)]
                if any(sum(same[p : p + w]) >= w - allowed(w) for p in range(len(same) - w + 1)):
                    found.add((d, i))
                    break
    return found

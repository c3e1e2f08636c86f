"""Plain versions of the operators, and the small tables that the tests share."""

import random
import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def prose(seed, n, size=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def left_after_repeats(rows, length):
    """{(id, text): words left}, windows judged on the input in the order of (id, text)."""
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        w = words(text)
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            window = tuple(w[p : p + length])
            if window in seen:
                gone[p : p + length] = [True] * length
            seen.add(window)
        out.setdefault((key, text), []).append([x for x, g in zip(w, gone, strict=True) if not g])
    return out


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def component_of(rows):
    """{id: smallest id reachable over sets with a Jaccard similarity of 0.75 or more}."""
    sets = [(key, shingles(text)) for key, text in rows]
    parent = {key: key for key, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, one) in enumerate(sets):
        for b, two in sets[:i]:
            if one and two and 100 * len(one & two) >= 75 * len(one | two):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {key: root(key) for key, _ in sets}


def documents():
    """Shared passages, copies of several kinds, odd texts and a very long one."""
    passage, other = prose(1, 70), prose(2, 60)
    rows = [
        (1, prose(10, 90) + " " + passage + " " + prose(11, 40)),
        (2, passage),
        (3, prose(12, 33) + "\n" + passage + "\t\t" + other),
        (4, other + " " + other),
        (5, None),
        (6, ""),
        (7, "  \n "),
        (8, "one"),
        (9, "one"),
        (10, "the the " * 80),
        (11, prose(13, 4000)),
        (12, prose(13, 4000) + " a tail of some words"),
        (13, "x" * 20_000 + " y"),
        (14, "Été à la plage, ‘quoted’   and 　 wide  spaces\r\n"),
    ]
    base = prose(20, 200, 5000).split()
    for i in range(12):
        copy = list(base)
        copy[15 * i + 3] = f"changed{i}"
        rows.append((30 + i, " ".join(copy)))
    rows += [(60, rows[0][1]), (61, rows[0][1].upper()), (62, prose(21, 19)), (63, prose(21, 19))]
    return rows

"""Plain-Python versions of what several tests compare with."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


WORDS = (
    "river stone lantern garden winter copper meadow harbour signal mountain velvet orchard "
    "thunder candle bridge feather island marble compass forest saddle ribbon anchor barley"
).split()


def prose(seed: int, n: int) -> str:
    """``n`` words that look random and are the same on every run."""
    import random

    rng = random.Random(seed)
    return " ".join(f"{rng.choice(WORDS)}{rng.randrange(60)}" for _ in range(n))


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def plain_components(rows):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        whole = {" ".join(w)} if w else set()
        sets.append({" ".join(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else whole)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            inter = len(a & sets[j])
            if inter and 100 * inter >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = least.setdefault(root(i), [])
        if doc_id is not None:
            ids.append(doc_id)
    return collections.Counter(
        (doc_id, len(sets[i]), min(least[root(i)], default=None)) for i, (doc_id, _) in enumerate(rows)
    )


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_pii(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)

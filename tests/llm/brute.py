"""Plain versions of the operators, for small tables."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def components(rows, n=5):
    """{id: (set size, least id reachable)} of (id, text) rows."""
    sets = {}
    for key, text in rows:
        words = WORD.findall(lowered(text))
        sets[key] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}
    parent = {key: key for key in sets}

    def top(key):
        while parent[key] != key:
            key = parent[key]
        return key

    holders = defaultdict(list)
    for key in sorted(sets):
        common = Counter()
        for gram in sets[key]:
            common.update(holders[gram])
            holders[gram].append(key)
        for other, shared in common.items():
            if 100 * shared >= 80 * (len(sets[key]) + len(sets[other]) - shared):
                a, b = top(key), top(other)
                parent[max(a, b)] = min(a, b)
    return {key: (len(sets[key]), top(key)) for key in sets}


def repeats(rows, least=50):
    """{id: [(start, end)]} of words in runs that occur earlier, in order of id and position."""
    seen, spans = set(), {}
    for key, text in sorted(rows):
        words, out = WORD.findall(text or ""), []
        for i in range(len(words) - least + 1):
            run = tuple(words[i : i + least])
            if run not in seen:
                seen.add(run)
            elif out and i <= out[-1][1]:
                out[-1][1] = i + least
            else:
                out.append([i, i + least])
        if out:
            spans[key] = [tuple(span) for span in out]
    return spans


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def near_copies(seed, groups=6, size=14, words=120):
    """(id, text) rows: groups of edited copies, some of them exact, among texts of their own."""
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(8, words))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                at = rng.randrange(len(text))
                if rng.random() < 0.5:
                    text[at] = f"x{rng.randrange(20)}"
                else:
                    del text[at]
            rows.append(" ".join(text))
    rows += [sentence(rng, rng.randrange(0, 40)) for _ in range(30)] + ["", " ", "one two", "ONE two", "a b c d e"]
    rng.shuffle(rows)
    return list(enumerate(rows))

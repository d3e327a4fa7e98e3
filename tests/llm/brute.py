"""Plain versions of the operators' definitions, for small inputs."""

import re

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))


def shingles(text, size):
    w = words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def link(self, x, y):
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def components(texts, size, similarity=80):
    """{id: component} for {id: text}, all pairs compared."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    ids, union = sorted(sets), Union()
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 10 * min(len(a), len(b)) >= similarity / 10 * max(len(a), len(b)):
                shared = len(a & b)
                if 100 * shared >= similarity * (len(a) + len(b) - shared):
                    union.link(i, j)
    return {i: union.find(i) for i in ids}


def cleaned_lines(texts, min_docs):
    """[(lines, dropped, text)] for a list of texts."""
    white = " \t\n\x0b\x0c\r"
    key = lambda line: line.strip(white).translate(ASCII_LOWER)
    count = {}
    for t in texts:
        for k in {key(x) for x in (t or "").split("\n")}:
            count[k] = count.get(k, 0) + 1
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or count[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out

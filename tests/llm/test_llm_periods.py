import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from churnlens.llm import periods, queries
from churnlens.llm.periods import find_runs


def plain_runs(words, min_length=24, min_periods=3):
    """Every period tried in turn."""
    n, found = len(words), {}
    for q in range(1, n // min_periods + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, min_periods * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    drop = {i for a, m, q in runs for i in range(a + q, a + m)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def found(docs, **least):
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    runs = find_runs(np.array([w for d in docs for w in d], np.int64), bounds, **least)
    cut = runs.cut(bounds)
    return [
        [(s - bounds[i], m, q) for s, m, q in zip(runs.start[a:b].tolist(), runs.length[a:b].tolist(), runs.period[a:b].tolist())]
        for i, (a, b) in enumerate(zip(cut, cut[1:]))
    ]


def by_period(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [{}, {"min_length": 1}, {"min_length": 7, "min_periods": 4}])
def test_runs_equal_every_period_tried(least):
    rng = random.Random(3)
    docs = [[], [5], [1] * 23, [1] * 24, [1] * 700, [1, 2] * 50, ([1] * 30 + [2]) * 9, [0] * 40 + [1] * 40]
    fib = [[1], [1, 2]]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    docs += [fib[-1], [bin(i).count("1") % 2 for i in range(500)]]
    for _ in range(400):
        doc = []
        while len(doc) < rng.randint(0, 150):
            part = [rng.randint(0, rng.choice([1, 2, 50])) for _ in range(rng.randint(1, 20))]
            doc += part * rng.choice([1, 1, 2, 3, 4, 9]) + part[: rng.randint(0, len(part))]
        docs.append(doc)
    want = [by_period(plain_runs(d, **least)) for d in docs]
    assert found(docs, **least) == want
    # Documents do not see each other: equal ones side by side.
    assert found([docs[10]] * 3, **least) == [want[10]] * 3


def test_two_periods_are_refused():
    with pytest.raises(ValueError):
        find_runs(np.zeros(3, np.int64), np.array([0, 3]), min_periods=2)


def test_query(spark, data_dir, tmp_path):
    query = queries.QUERIES["op12_periodic_runs"]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    got = query(spark, data_dir)
    assert set(COLUMNS) <= set(got.columns)
    rows = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    short = {i: t for i, t in texts.items() if len(t or "") < 6_000}
    assert set(rows) == set(texts) and len(short) > 100
    assert {i: rows[i] for i in short} == {i: plain_row(i, t) for i, t in short.items()}
    assert sum(rows[i][1] > 0 for i in short) > 5

    odd = ["", None, " \t\n", "a", "a " * 30, "A a " * 12, "x\x0by\x1cz " * 9, ("é " * 24).strip(), "long word " * 30_000, "a b c " * 8 + "a b d " * 8]
    rows = [(i, t, 1) for i, t in enumerate(odd)] + [(None, "b " * 50, 1), (None, "b " * 50, 1), (3, "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    key = lambda r: (r[0] is None, r[0] or 0, r[6])
    got = sorted((tuple(r[c] for c in COLUMNS) for r in query(spark, str(tmp_path)).collect()), key=key)
    want = sorted((plain_row(i, t) for i, t, _ in rows if len(t or "") < 10_000), key=key)
    assert [r for r in got if r[0] != 8] == want
    assert [r for r in got if r[0] == 8][0][:6] == (8, 1, 0, 60_000, 2, 30_000_000)
    assert periods.detect(df.limit(0)).count() == 0
    plain = {r["doc_id"]: r for r in periods.detect(df).collect()}
    assert plain[4]["collapsed"] == "a" and plain[5]["n_words"] == 24 and plain[5]["collapsed"] == "A a"

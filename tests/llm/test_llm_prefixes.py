import hashlib
import random
import zlib

import pytest
from compare import connect, difference

from churnlens.llm import prefixes, queries

NAME = "op13_conversation_trie"


def plain_trie(rows, rebuild=True):
    """{(conv_id, depth): row} with every prefix as a tuple."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    built = own
    if rebuild:
        built = {}
        for c, ts in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            built[c] = own.get(c - c % 100, [])[:h] + ts[h:]
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for key, convs in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        out.append(
            (
                min(convs), len(key), min(nodes[key[:-1]]) if key else None, len(convs),
                sum(len(k) == len(key) + 1 for k in below),
                sum(not any(len(m) == len(k) + 1 and m[:-1] == k for m in nodes) for k in below),
                sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in below if k),
                hashlib.sha256(",".join(str(c) for c in sorted(convs) if tuple(built[c]) == key).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_sql(spark, data_dir):
    assert difference(queries.QUERIES[NAME](spark, data_dir), connect(data_dir), queries.ORACLE[NAME]) is None


def small_table(rng):
    say = lambda n: [(i, rng.choice(["user", "bot"]), rng.choice(["a", "bb", "ccc", "é\U0001f600"])) for i in range(n)]
    rows = []
    for conv in range(60):
        rows += [(conv, *t) for t in say(rng.randint(1, 5))]
    rows += [(c, i, "user", "same") for c in range(150, 190) for i in range(4)]  # no conversation 100
    rows += [(210 + c, i, "u", f"t{i}") for c in range(3) for i in range(2)]
    rows += [(300, i, "user", f"long {i}") for i in range(300)] + [(301, i, "user", f"long {i}") for i in range(290)]
    rows += [(400, None, None, None), (400, 0, "", ""), (400, 0, "u", "x"), (400, 0, "u", "x"), (400, 0, "u", "w"), (401, 0, None, "n")]
    rows += [(None, 0, "user", "nowhere")]
    rows += [(500, i, "a", "1:b") for i in range(3)] + [(600, i, "a1:", "b") for i in range(3)]
    return rows


@pytest.mark.parametrize("parts,chunk_bits,hot", [(8, 13, 1_000), (64, 1, 2)])
def test_trie_equals_plain_prefixes(spark, tmp_path, monkeypatch, parts, chunk_bits, hot):
    """With many partitions the long conversation lies in several segments."""
    monkeypatch.setattr(prefixes, "CHUNK_BITS", chunk_bits)
    monkeypatch.setattr(prefixes, "HOT_SHARE", hot)
    rows = small_table(random.Random(parts))
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        if parts > 8:
            _, segments = prefixes._segmented(df)
            assert segments.where("conv_id = 300").count() > 3
        assert got(queries.QUERIES[NAME](spark, str(tmp_path))) == plain_trie(rows)
        assert got(prefixes.prefix_trie(prefixes.numbered(df))) == plain_trie(rows, rebuild=False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_and_turnless(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], schema)
    empty.write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.QUERIES[NAME](spark, str(tmp_path)).count() == 0
    # crc32("102") % 6 = 5: one turn of its own goes, and there is no conversation 100.
    conv = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6)
    one = spark.createDataFrame([(conv, 0, "u", "x")], schema)
    root = hashlib.sha256(str(conv).encode()).hexdigest()
    assert got(prefixes.prefix_trie(prefixes.rebuilt(one))) == [(conv, 0, None, 1, 0, 1, 0, root)]

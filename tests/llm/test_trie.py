import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgermart.llm import trie as t

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn, role or "", text or ""))
    for c, of in turns.items():
        name = lambda r: hashlib.md5(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()
        of.sort(key=lambda r: (r[0] is not None, r[0] or 0, name(r)))
        turns[c] = [r[1:] for r in of]
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = (turns.get(base, [])[:h] if rebuild else []) + own[h:]
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        below = [out[q] for q in children.get(p, [])]
        ends = ",".join(str(c) for c in sorted(members[p]) if len(built[c]) == len(p))
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        out[p] = (
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below),
            sum(b[5] for b in below) or 1, own + sum(b[6] for b in below), hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values())


def sample(seed, convs=60, deep=0):
    rng = random.Random(seed)
    rows = [(c, i, rng.choice(["user", None]), rng.choice(["a", "é b", None, ""])) for c in range(-3, convs) for i in range(rng.randrange(0, 9))]
    rows += [(100 + c, i, "user", f"same {i}") for c in range(12) for i in range(4)]
    rows += [(101, None, "user", "null turn"), (101, 2, "user", "same 2"), (101, 2, "user", "same 2"), (None, 1, "user", "nobody")]
    rows += [(200 + c, i, "user", f"deep {i}" if i < deep - c * 3 else f"own {c}") for c in range(3) for i in range(deep)]
    rng.shuffle(rows)
    return rows


def plain(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("local", [t.LOCAL, 4])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, local):
    rows = sample(1)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    monkeypatch.setattr(t.rolled_up, "__defaults__", (local,))
    monkeypatch.setattr(t.prefix_trie, "__defaults__", (None, None, local))
    assert plain(t.op13_conversation_trie(spark, str(tmp_path))) == brute(rows, True)


def test_long_conversations_are_cut_and_split(spark):
    rows = sample(2, convs=10, deep=150)
    turns = spark.createDataFrame(rows, SCHEMA)
    assert plain(t.prefix_trie(turns, local=25)) == brute(rows, False)


def test_small_batches_give_the_same_keys(spark):
    turns = spark.createDataFrame(sample(3, deep=40), SCHEMA)
    whole = plain(t.prefixes(turns))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert plain(t.prefixes(turns)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table_one_turn_and_extra_columns(spark, clashing):
    assert t.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(5, None, None, None)]
    one = spark.createDataFrame(rows, SCHEMA)
    assert plain(t.prefix_trie(clashing(one, "c", "d", "m", "w", "n"))) == brute(rows, False)


def test_a_head_without_its_base(spark):
    """Conversation 101's base does not exist: it keeps what is behind its head, or nothing."""
    rows = [(101, i, "u", str(i)) for i in range(3)]
    got = t.prefix_trie(spark.createDataFrame(rows, SCHEMA), base=F.lit(100), head=F.lit(5))
    assert [tuple(r)[:7] for r in got.collect()] == [(101, 0, None, 1, 0, 1, 0)]


def test_centroid_totals_on_random_trees():
    rng = random.Random(7)
    for shape in range(40):
        n = rng.randrange(1, 80)
        parent = [-1] + [rng.randrange(max(0, i - (1 if shape % 3 == 0 else 5)), i) for i in range(1, n)]
        values = [(rng.randrange(3), rng.randrange(100)) for _ in range(n)]
        sums, weight = [list(v) for v in values], [rng.randrange(1, 4) for _ in range(n)]
        for u in range(n - 1, 0, -1):
            weight[parent[u]] += weight[u]
            for k in range(2):
                sums[parent[u]][k] += sums[u][k]
        assert t.centroid_totals(parent, weight, values) == sums

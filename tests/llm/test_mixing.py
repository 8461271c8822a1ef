from collections import defaultdict

import pytest

from ledgermart.llm import mixing as m


def plain_targets(sizes):
    """Cap and reshare until no target is above three times its source."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else left * weight[s] / free for s in names}
        more = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not more:
            return target
        capped |= more


@pytest.fixture
def texts():
    rows, sources = [], {}
    for i in range(600):
        sources[i] = [None, "a", "b", "é", "tiny", "nothing"][0 if i % 7 == 0 else 1 + i % 3 if i < 590 else 4 + i % 2]
        rows.append((i, None if sources[i] == "nothing" else "w " * (i % 40 + 1)))
    return rows, sources


def test_targets_and_taken_words(spark, documents, texts):
    rows, sources = texts
    docs = documents(rows, sources)
    got = m.sampled(m.sized(docs)).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["_size"]
        taken[r["source"]] += r["_copies"] * r["_size"]
        assert 0 <= r["_copies"] <= 3
    wanted = plain_targets(sizes)
    for r in got:
        assert r["_target"] == pytest.approx(wanted[r["source"]], rel=1e-12) and r["_source_size"] == sizes[r["source"]]
    for s, t in wanted.items():
        assert abs(taken[s] - t) <= 41
    assert taken["tiny"] == 3 * sizes["tiny"]


def test_copies_are_the_crossings_of_the_prefix_sum(spark, documents, texts):
    rows, sources = texts
    got = m.sampled(m.sized(documents(rows, sources))).collect()
    by_source = defaultdict(list)
    for r in got:
        by_source[r["source"]].append((r["_size"], r["doc_id"], r["_copies"], r["_target"], r["_source_size"]))
    for group in by_source.values():
        group.sort()
        rate = group[0][3] / group[0][4] if group[0][4] else 0
        total = 0
        for k, (_, _, copies, _, _) in enumerate(group):
            total += copies  # a running total never leaves the running sum of expected copies by one or more
            assert abs(total - (k + 1) * rate) < 1 + 1e-6


def test_reruns_and_partitionings_agree(spark, documents, texts):
    docs = documents(*texts)
    plain = lambda df: sorted((r["doc_id"], r["_copies"]) for r in df.collect())
    assert plain(m.sampled(m.sized(docs))) == plain(m.sampled(m.sized(docs.repartition(7))))


def test_mixed_rows_repeats_empty_table_and_names(spark, documents, clashing):
    docs = clashing(documents([(1, "a b"), (1, "a b"), (None, "c"), (4, None)], {1: "x"}), "_size", "_copies", "w")
    out = m.mixed(docs)
    assert out.columns == docs.columns
    assert {r["_size"] for r in out.collect()} == {"own"}
    drawn = m.sampled(m.sized(docs)).collect()
    assert len(drawn) == 4 and out.count() == sum(r["_copies"] for r in drawn)
    assert m.mixed(documents([])).count() == 0
    assert m.mixed(documents([(1, ""), (2, None)])).where("text = 'x'").count() == 0

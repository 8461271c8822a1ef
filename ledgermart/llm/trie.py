"""Prefix trie of conversations, rolled up over a centroid decomposition.

A node is a distinct sequence of the first ``d`` turns (role, text); its members are the conversations that
start with it.  A node is named by its smallest member and its depth: a conversation that is the smallest
member of a node is the smallest of the next one on its way, too.

* **Prefix keys.**  A turn is hashed (from its MD5) to two 64-bit numbers, a prefix is ``sum x_i * B^i`` modulo
  2^64 of each.  Turns are range-partitioned in order, so a long conversation is cut into slices; a task sums
  its slice, and the at most one offset per slice is broadcast.  Prefixes of a rebuilt conversation (the head of
  another one, then its own turns) follow from both prefix sums by algebra, without moving texts.
* **Nodes** are one aggregation by (depth, key) with map-side sums.
* **Rollup.**  The parent edges form a tree whose subtree weights (rows of all members from here on) come with
  that aggregation.  A component's centroid is its deepest node with more than half of the component's weight.
  It is taken out: its subtree's totals are its own result and are added along the path from it to the
  component's top; each child's subtree and the rest are components of at most half the weight.  Whether a
  node is below the centroid, and below which child, is one lookup of its smallest member's node at the
  depth after the centroid.  The number of rounds is logarithmic in the rows, however deep the trie is.
  Components of at most ``LOCAL`` nodes are finished by the same recursion inside a task.
* **Members that end in a node** are digested in order of their id: slices of a range partitioning are turned
  into chunks of text, and one task per node streams its chunks through the digest.

Defined cases: turns ascend, null first, rows of one turn number by digest of role and text; null role or
text is empty; rows without ``conv_id`` belong to no conversation; equal rows are equal turns, one after the
other; an empty table has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, staged, table
from .merkle import crc32_sql
from .wordhash import powers

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, for both halves of a key
#: most turns that a conversation may take from another one
HEAD = 5
#: nodes of a component that a task finishes alone
LOCAL = 4096
CHUNK = 1 << 16
_U = np.uint64


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], list(columns))


def _unsigned(x) -> np.ndarray:
    return np.asarray(x, np.int64).view(_U)


def _power(base: int, exponents: np.ndarray) -> np.ndarray:
    """Powers of an odd base modulo 2^64, negative exponents too; few different ones."""
    different, at = np.unique(exponents, return_inverse=True)
    return np.array([pow(base, int(e), 1 << 64) for e in different], _U)[at]


_LOCAL_ROWS = "slice long, c long, pos long, p1 long, p2 long, q1 long, q2 long, size long"


def _slice_sums(batches):
    """Places and prefix sums of conversations inside one slice of ordered turns."""
    at = TaskContext.get().partitionId()
    current, count, sums = None, 0, [0, 0]
    for batch in batches:
        if not batch.num_rows:
            continue
        (c,) = _columns(batch, "c")
        n = len(c)
        starts = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        first = np.repeat(starts, np.diff(np.concatenate([starts, [n]])))
        index = np.arange(n)
        goes_on = bool(current is not None and c[0] == current)
        more = np.where((first == 0) & goes_on, count, 0)
        keys = []
        for half, (name, base) in enumerate(zip(("x1", "x2"), BASES, strict=True)):
            x = _unsigned(_columns(batch, name)[0])
            up, down = powers(n + 1, base)
            total = np.concatenate([np.zeros(1, _U), np.cumsum(x * up[:n])])
            own = (total[1:] - total[first]) * down[first] * _U(base)  # the first row of a run has exponent 1
            before = np.where(first == 0, _U(sums[half] if goes_on else 0), _U(0))
            scale = np.where(more > 0, _U(pow(base, int(count), 1 << 64)), _U(1))
            prefix = before + own * scale
            keys.append((prefix, prefix - x * up[index - first] * _U(base) * scale))
        pos = index - first + 1 + more
        current, count, sums = c[-1], int(pos[-1]), [int(k[0][-1]) for k in keys]
        yield _batch(
            slice=np.full(n, at), c=c, pos=pos, p1=keys[0][0].view(np.int64), p2=keys[1][0].view(np.int64),
            q1=keys[0][1].view(np.int64), q2=keys[1][1].view(np.int64), size=batch.column("size"),
        )


def _offsets(batches):
    """For the slices of a conversation that is cut: turns and prefix sums before each."""
    for batch in batches:
        out = []
        for c, parts in zip(batch.column("c").to_pylist(), batch.column("parts").to_pylist(), strict=True):
            turns, sums = 0, [0, 0]
            for part in sorted(parts, key=lambda p: p["slice"]):
                if turns:
                    out.append((part["slice"], c, turns, *np.array(sums, _U).view(np.int64).tolist()))
                for half, base in enumerate(BASES):
                    value = int(_unsigned([part["last"][f"p{half + 1}"]])[0])
                    sums[half] = (sums[half] + value * pow(base, turns, 1 << 64)) % (1 << 64)
                turns += part["last"]["pos"]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        names = ["o_slice", "o_c", "o_pos", "o1", "o2"]
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in columns], names)


def _shifted(batches):
    """Prefix sums of a slice moved behind those of the slices before."""
    for batch in batches:
        pos, o_pos = _columns(batch, "pos", "o_pos")
        out = {"c": batch.column("c"), "pos": pos + o_pos}
        for kind in "pq":
            for half, base in enumerate(BASES, 1):
                local, before = (_unsigned(_columns(batch, f"{name}{half}")[0]) for name in (kind, "o"))
                out[f"{kind}{half}"] = (before + local * _power(base, o_pos)).view(np.int64)
        yield _batch(**out, size=batch.column("size"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``c, pos, p1, p2, q1, q2, size``: every turn's place, key of the prefix up to it and of the one before it."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    name = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), "turn", name.alias("name"), F.length(text).cast("long").alias("size")
    )
    rows = staged(rows, "turns")
    order = ["c", F.col("turn").asc_nulls_first(), "name"]
    # equal rows are told apart by their place in the staged files, so that they may be cut into slices
    placed = rows.withColumn("tie", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(slices(turns.sparkSession), *order, "tie").sortWithinPartitions(*order)
    hashed = placed.select("c", F.xxhash64("name").alias("x1"), F.xxhash64(F.lit("second"), "name").alias("x2"), "size")
    local = staged(hashed.mapInArrow(_slice_sums, _LOCAL_ROWS), "slice-sums")
    parts = local.groupBy("slice", "c").agg(F.max(F.struct("pos", "p1", "p2")).alias("last"))
    cut = parts.groupBy("c").agg(F.collect_list(F.struct("slice", "last")).alias("parts")).where("size(parts) > 1")
    before = cut.mapInArrow(_offsets, "o_slice long, o_c long, o_pos long, o1 long, o2 long")
    before = staged(before, "offsets")  # only the first conversation of a slice can be cut: a row per slice at most
    joined = local.join(F.broadcast(before), (F.col("slice") == F.col("o_slice")) & (F.col("c") == F.col("o_c")), "left")
    filled = joined.fillna(0, ["o_pos", "o1", "o2"])
    return staged(filled.mapInArrow(_shifted, "c long, pos long, p1 long, p2 long, q1 long, q2 long, size long"), "prefixes")


def _rebased(batches):
    """Keys of own turns behind the head: ``base + (own - own head) * B^(m - h)``."""
    for batch in batches:
        pos, h, m = _columns(batch, "pos", "h", "m")
        out = {"c": batch.column("c"), "d": pos - h + m}
        for kind, to in (("p", "k"), ("q", "j")):
            for half, base in enumerate(BASES, 1):
                key, head, own = (_unsigned(_columns(batch, f"{name}{half}")[0]) for name in (kind, "b", "a"))
                out[f"{to}{half}"] = (head + (key - own) * _power(base, m - h)).view(np.int64)
        yield _batch(**out, size=batch.column("size"), len=batch.column("len"))


_KEYED = "c long, d long, k1 long, k2 long, j1 long, j2 long, size long, len long"


def rebuilt(turns: DataFrame, base: Column | None = None, head: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Conversations (``c, len``) and their turns: ``c, d, k1, k2`` (key), ``j1, j2`` (key of d - 1), ``size, len``.

    A conversation (column ``c``) takes the first ``head`` turns (at most ``HEAD``) of conversation ``base`` in
    place of its own first ``head``; without these columns it stays as it is.
    """
    rows = prefixes(turns)
    first = F.when(F.col("pos") <= HEAD, F.struct("pos", "p1", "p2", "q1", "q2", "size"))
    convs = staged(rows.groupBy("c").agg(F.max("pos").alias("n"), F.collect_list(first).alias("first")), "conversations")
    h = F.lit(0) if head is None else head
    own = convs.withColumns({"h": h.cast("long"), "base": F.col("c") if base is None else base})
    heads = convs.where("size(first) > 0").select(F.col("c").alias("base"), F.array_sort("first").alias("heads"))
    joined = own.join(heads, "base", "left")
    taken = F.slice(F.coalesce("heads", F.array().cast(heads.schema["heads"].dataType)), 1, F.col("h").cast("int"))
    at_h = F.filter("first", lambda t: t["pos"] == F.col("h"))
    known = joined.withColumn("head", taken).withColumn("m", F.size("head").cast("long"))
    known = known.select(
        "c", "h", "m", "head", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"),
        *[F.coalesce(F.try_element_at("head", F.lit(-1))[f"p{i}"], F.lit(0)).cast("long").alias(f"b{i}") for i in (1, 2)],
        *[F.coalesce(F.get(at_h, F.lit(0))[f"p{i}"], F.lit(0)).cast("long").alias(f"a{i}") for i in (1, 2)],
    )
    known = staged(known, "rebuilt")
    of_head = known.select("c", "len", F.explode("head").alias("t")).select(
        "c", F.col("t.pos").alias("d"), *[F.col(f"t.{x}{i}").alias(f"{y}{i}") for x, y in (("p", "k"), ("q", "j")) for i in (1, 2)],
        "t.size", "len",
    )
    behind = rows.join(known.drop("head"), "c").where("pos > h").mapInArrow(_rebased, _KEYED)
    return known.select("c", "len"), staged(of_head.unionByName(behind), "rebuilt-turns")


def node_table(convs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (``m, d, pm, n, w, own, children``) and the node of every conversation at every depth (``c, d, m, pm, last``).

    ``m`` is the smallest member, ``pm`` the parent's, ``w`` the rows of all members from this depth on, ``own`` the
    tokens that sharing this node saves.
    """
    keyed = staged(rows.groupBy("d", "k1", "k2").agg(
        F.min("c").alias("m"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size"),
        F.min("j1").alias("j1"), F.min("j2").alias("j2"), F.sum(F.col("len") - F.col("d") + 1).alias("w"),
    ), "trie-keys")
    root = convs.agg(F.min("c").alias("m"), F.count(F.lit(1)).alias("n"), F.sum(F.col("len") + 1).alias("w")).where("n > 0")
    smallest = root.first()
    smallest = F.lit(smallest["m"] if smallest else None).cast("long")
    above = keyed.select(
        (F.col("d") + 1).alias("d"), F.col("k1").alias("j1"), F.col("k2").alias("j2"), F.col("m").alias("pm")
    )
    deep = keyed.where("d > 1").join(above, ["d", "j1", "j2"])
    named = deep.unionByName(keyed.where("d = 1").withColumn("pm", smallest))
    named = staged(named.withColumn("own", (F.col("n") - 1) * F.col("size")), "trie-nodes")
    zero = F.lit(0).cast("long")
    top = root.select("m", zero.alias("d"), F.lit(None).cast("long").alias("pm"), "n", "w", zero.alias("own"))
    plain = named.select("m", "d", "pm", "n", "w", "own").unionByName(top)
    children = named.groupBy(F.col("pm").alias("m"), (F.col("d") - 1).alias("d")).agg(F.count(F.lit(1)).alias("children"))
    nodes = plain.join(children, ["m", "d"], "left").fillna(0, ["children"])
    last = (F.col("d") == F.col("len")).alias("last")
    at = rows.join(named.select("d", "k1", "k2", "m", "pm"), ["d", "k1", "k2"]).select("c", "d", "m", "pm", last)
    at_top = convs.select("c", zero.alias("d"), smallest.alias("m"), F.lit(None).cast("long").alias("pm"), (F.col("len") == 0).alias("last"))
    return staged(nodes, "nodes"), staged(at.unionByName(at_top), "nodes-of-turns")


def centroid_totals(parent: list[int], weight: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Sums of ``values`` over every subtree of one component, by recursive splits at centroids.

    Nodes come with the top first and parents before children; ``parent`` of the top is -1.  ``weight`` is a sum
    over the subtree of any positive weights.
    """
    weight = list(weight)
    kinds = range(len(values[0]))
    total = [[0] * len(kinds) for _ in parent]
    stack = [list(range(len(parent)))]
    while stack:
        nodes = stack.pop()
        top = nodes[0]
        whole = weight[top]
        centroid = next(u for u in reversed(nodes) if 2 * weight[u] > whole)
        child: dict[int, int] = {centroid: -1}  # nodes below the centroid and the child they are under
        parts: dict[int, list[int]] = {}
        rest = []
        found = list(values[centroid])
        for u in nodes:
            if u == centroid:
                continue
            under = child.get(parent[u])
            if under is None:
                rest.append(u)
                continue
            child[u] = under = u if under == -1 else under
            parts.setdefault(under, []).append(u)
            for k in kinds:
                found[k] += values[u][k]
        for k in kinds:
            total[centroid][k] += found[k]
        u, gone = centroid, weight[centroid]
        while u != top:
            u = parent[u]
            weight[u] -= gone
            for k in kinds:
                total[u][k] += found[k]
        stack.extend(parts.values())
        if rest:
            stack.append(rest)
    return total


_STATE = ["m", "d", "pm", "cm", "cd", "w", "leaf", "own", "leaves", "saved"]


def _finished(batches):
    """Small components, each in consecutive rows with parents first."""
    group: list[tuple] = []

    def close():
        place = {(m, d): i for i, (m, d, *_) in enumerate(group)}
        parent = [-1] + [place[(r[2], r[1] - 1)] for r in group[1:]]
        sums = centroid_totals(parent, [r[5] for r in group], [(r[6], r[7]) for r in group])
        return [(r[0], r[1], r[8] + s[0], r[9] + s[1]) for r, s in zip(group, sums, strict=True)]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*rows, strict=True)], ["m", "d", "leaves", "saved"])

    done: list[tuple] = []
    for batch in batches:
        for row in zip(*[batch.column(n).to_pylist() for n in _STATE], strict=True):
            if group and row[3:5] != group[0][3:5]:
                done.extend(close())
                group = []
                if len(done) > 10_000:
                    yield out(done)
                    done = []
            group.append(row)
    if group:
        done.extend(close())
    if done:
        yield out(done)


def rolled_up(nodes: DataFrame, at: DataFrame, local: int = LOCAL) -> DataFrame:
    """``m, d, leaves, saved``: childless nodes and saved tokens in every node's subtree."""
    zero = F.lit(0).cast("long")
    state = nodes.join(nodes.where("d = 0").select(F.col("m").alias("cm"), zero.alias("cd")))  # one row: the root
    leaf = (F.col("children") == 0).cast("long").alias("leaf")
    state = staged(state.select("m", "d", "pm", "cm", "cd", "w", leaf, "own", zero.alias("leaves"), zero.alias("saved")), "components")
    small, done = [], []
    while True:
        sizes = state.groupBy("cm", "cd").agg(F.count(F.lit(1)).alias("k"), F.max("w").alias("whole"))
        sizes = staged(sizes, "component-sizes")
        if sizes.isEmpty():
            break
        small.append(state.join(sizes.where(F.col("k") <= local).select("cm", "cd"), ["cm", "cd"]).select(*_STATE))
        large = sizes.where(F.col("k") > local)
        if large.isEmpty():
            break
        state = staged(state.join(large.select("cm", "cd", "whole"), ["cm", "cd"]), "large-components")
        heavy = state.where(2 * F.col("w") > F.col("whole"))
        chosen = heavy.groupBy("cm", "cd").agg(F.max(F.struct("d", "m", "w")).alias("v"))
        chosen = staged(chosen.select("cm", "cd", F.col("v.m").alias("vm"), F.col("v.d").alias("vd"), F.col("v.w").alias("vw")), "centroids")
        # below which child of the centroid is a node: its smallest member's node one step after the centroid
        split = state.join(chosen, ["cm", "cd"])
        step = at.select(F.col("c").alias("m"), F.col("d").alias("ad"), F.col("m").alias("am"), F.col("pm").alias("apm"))
        deeper = split.where("d > vd").withColumn("ad", F.col("vd") + 1).join(step, ["m", "ad"])
        flat = split.where("d <= vd").withColumns({"am": F.lit(None).cast("long"), "apm": F.lit(None).cast("long")})
        is_centroid = (F.col("d") == F.col("vd")) & (F.col("m") == F.col("vm"))
        side = F.when(is_centroid, "at").when((F.col("d") > F.col("vd")) & (F.col("apm") == F.col("vm")), "below").otherwise("above")
        split = staged(deeper.drop("ad").unionByName(flat).withColumn("side", side), "split-components")
        sums = split.where("side <> 'above'").groupBy("cm", "cd").agg(F.sum("leaf").alias("sl"), F.sum("own").alias("ss"))
        found = staged(chosen.join(sums, ["cm", "cd"]), "centroid-totals")
        more = found.select("cm", "cd", "sl", "ss")
        done.append(
            split.where("side = 'at'").join(more, ["cm", "cd"])
            .select("m", "d", (F.col("leaves") + F.col("sl")).alias("leaves"), (F.col("saved") + F.col("ss")).alias("saved"))
        )
        # the path from a centroid to its top: nodes of the centroid's smallest member at these depths
        way = at.select("c", F.col("d").alias("ad"), F.col("m").alias("am"))
        path = way.join(found, F.col("c") == F.col("vm")).where("ad >= cd and ad < vd")
        path = path.select(F.col("am").alias("m"), F.col("ad").alias("d"), "sl", "ss", "vw")
        above = split.where("side = 'above'").drop("vw").join(path, ["m", "d"], "left").fillna(0, ["sl", "ss", "vw"])
        above = above.select(
            "m", "d", "pm", "cm", "cd", (F.col("w") - F.col("vw")).alias("w"), "leaf", "own",
            (F.col("leaves") + F.col("sl")).alias("leaves"), (F.col("saved") + F.col("ss")).alias("saved"),
        )
        below = split.where("side = 'below'").withColumns({"cm": F.col("am"), "cd": F.col("vd") + 1}).select(*_STATE)
        state = staged(above.unionByName(below), "components")
    ready = state.sparkSession.createDataFrame([], "m long, d long, leaves long, saved long")
    for part in done:
        ready = ready.unionByName(part)
    for part in small:
        placed = part.repartition("cm", "cd").sortWithinPartitions("cm", "cd", "d")
        ready = ready.unionByName(placed.mapInArrow(_finished, "m long, d long, leaves long, saved long"))
    return staged(ready, "rollup")


def _chunks(batches):
    at, key, held, size, number = TaskContext.get().partitionId(), None, [], 0, 0

    def out():
        return _batch(m=[key[0]], d=[key[1]], slice=[at], number=[number], text=[",".join(held)])

    for batch in batches:
        for m, d, c in zip(*[batch.column(n).to_pylist() for n in ("m", "d", "c")], strict=True):
            if held and ((m, d) != key or size > CHUNK):
                yield out()
                held, size, number = [], 0, number + 1
            key = (m, d)
            held.append(str(c))
            size += len(held[-1]) + 1
    if held:
        yield out()


def _digests(batches):
    key, state = None, None
    for batch in batches:
        rows = []
        for m, d, text in zip(*[batch.column(n).to_pylist() for n in ("m", "d", "text")], strict=True):
            if (m, d) != key:
                if key is not None:
                    rows.append((*key, state.hexdigest()))
                key, state = (m, d), hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        if rows:
            yield _batch(**dict(zip(("m", "d", "ends"), map(list, zip(*rows, strict=True)), strict=True)))
    if key is not None:
        yield _batch(m=[key[0]], d=[key[1]], ends=[state.hexdigest()])


def end_digests(at: DataFrame) -> DataFrame:
    """``m, d, ends``: digest of the ids that end in a node, for nodes where some do."""
    ends = at.where("last").select("m", "d", "c")
    placed = ends.repartitionByRange(slices(at.sparkSession), "m", "d", "c").sortWithinPartitions("m", "d", "c")
    chunks = staged(placed.mapInArrow(_chunks, "m long, d long, slice long, number long, text string"), "end-chunks")
    in_order = chunks.repartition("m", "d").sortWithinPartitions("m", "d", "slice", "number")
    return in_order.mapInArrow(_digests, "m long, d long, ends string")


def prefix_trie(turns: DataFrame, base: Column | None = None, head: Column | None = None, local: int = LOCAL) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    convs, rows = rebuilt(turns, base, head)
    nodes, at = node_table(convs, rows)
    joined = nodes.join(rolled_up(nodes, at, local), ["m", "d"]).join(end_digests(at), ["m", "d"], "left")
    return joined.select(
        F.col("m").alias("conv_id"), F.col("d").alias("depth"), F.col("pm").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, directory: str) -> DataFrame:
    c = F.col("c")
    head = F.crc32(c.cast("string").cast("binary")) % 6
    return prefix_trie(table(spark, directory, "conversations"), base=c - c % 100, head=head)


ORACLE_SQL = f"""
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x, length(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, max(pos) AS n, CAST({crc32_sql("CAST(c AS VARCHAR)")} % 6 AS BIGINT) AS h, c - c % 100 AS base FROM turns GROUP BY c
), heads AS (
  SELECT v.c, t.pos AS d, t.x, t.size FROM convs v JOIN turns t ON t.c = v.base AND t.pos <= v.h
), taken AS (
  SELECT v.c, v.h, count(b.d) AS m FROM convs v LEFT JOIN heads b ON b.c = v.c GROUP BY v.c, v.h
), rebuilt AS (
  SELECT * FROM heads
  UNION ALL
  SELECT t.c, t.pos - k.h + k.m, t.x, t.size FROM turns t JOIN taken k ON k.c = t.c WHERE t.pos > k.h
), rows_of AS (
  SELECT c, 0 AS d, 'root' AS key, NULL AS size FROM convs
  UNION ALL
  SELECT c, d, sha256(string_agg(x, '' ) OVER (PARTITION BY c ORDER BY d)), size FROM rebuilt
), nodes AS (
  SELECT d, key, min(c) AS m, count(*) AS n, coalesce((count(*) - 1) * max(size), 0) AS own FROM rows_of GROUP BY d, key
), node_of AS (
  SELECT r.c, r.d, n.m, r.d = max(r.d) OVER (PARTITION BY r.c) AS last FROM rows_of r JOIN nodes n ON n.d = r.d AND n.key = r.key
), named AS (
  SELECT n.*, p.m AS pm FROM nodes n LEFT JOIN node_of p ON p.c = n.m AND p.d = n.d - 1
), children AS (
  SELECT pm AS m, d - 1 AS d, count(*) AS k FROM named WHERE d > 0 GROUP BY ALL
), valued AS (
  SELECT n.*, coalesce(k.k, 0) AS k FROM named n LEFT JOIN children k ON k.m = n.m AND k.d = n.d
), totals AS (
  SELECT p.m, p.d, sum(CASE WHEN u.k = 0 THEN 1 ELSE 0 END) AS leaves, sum(u.own) AS saved
  FROM valued u JOIN node_of p ON p.c = u.m AND p.d <= u.d GROUP BY p.m, p.d
), ends AS (
  SELECT m, d, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends FROM node_of WHERE last GROUP BY m, d
)
SELECT v.m AS conv_id, CAST(v.d AS BIGINT) AS depth, v.pm AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs,
  CAST(v.k AS BIGINT) AS n_children, CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens,
  coalesce(e.ends, sha256('')) AS ends_sha256
FROM valued v JOIN totals t ON t.m = v.m AND t.d = v.d LEFT JOIN ends e ON e.m = v.m AND e.d = v.d
"""

"""The prefix trie of conversations: adaptive radix trees over sorted runs of keys, joined along their edges.

A turn's id is 16 bytes, big-endian, of the SHA-256 of its role and text; a conversation's key is the
ids of its turns. Equal keys are counted first, then ordered by range, so that a task holds neighbours.
Each run of a bounded number of keys becomes a radix tree. Nodes that hold neither the run's first key
nor its last are complete; those that do are open, because the neighbouring run may share them, and are added up
over runs in a tree of merges.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .radix import insert, walk

#: Bytes of a turn id.
WIDTH = 16
#: Keys, and bytes of keys, in one tree; bounds the memory of a task.
KEYS, KEY_BYTES = 20_000, 1 << 24
#: Partitions whose open nodes meet in one merge, and ids in one block of a digest.
FAN, BLOCK = 64, 4096

NODE = (
    "pid int, run int, digest binary, above binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, chars long, seq binary, open boolean, first boolean, last boolean"
)
NAMES = [c.split()[0] for c in NODE.split(", ")]
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def _half(text: Column) -> Column:
    """Half of a SHA-256, 16 bytes."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 2 * WIDTH))


def turn_lists(conversations: DataFrame, *with_: str) -> DataFrame:
    """(conv_id, turns) and the columns ``with_``: the turns of each conversation as an array of (id, chars).

    Turns are ordered by ``turn``, nulls first, ties by id. Null roles and texts are empty. Rows with a
    null conv_id belong to no conversation and are left out. Texts are hashed where they are read; 16 bytes and two numbers a
    turn are exchanged. A conversation's list is one value, so it has to fit a task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The role's length keeps role and text apart.
    id = _half(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id is not null")
    rows = rows.select(*with_, F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", id.alias("id"), F.length(text).cast("long").alias("chars")).alias("t"))
    if with_:  # one exchange serves what comes after, too
        rows = rows.repartition(*with_)
    lists = rows.groupBy(*with_, "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select(*with_, "conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("turns"))


def borrowed_openings(conversations: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """(conv_id, turns) as of turn_lists, where conversations share openings: the first h turns of conversation c are those of
    the conversation c - c % every (as many as it has; none if it is not there), for h the crc32 of c in decimal, modulo most + 1.

    All conversations of a block of ``every`` ids meet in one partition, once.
    """
    block = (F.col("conv_id") - F.col("conv_id") % every).cast("long")
    lists = turn_lists(conversations.select("conv_id", "turn", "role", "text", block.alias("block")), "block")
    opening = F.max(F.when(F.col("conv_id") == F.col("block"), F.slice("turns", 1, most))).over(Window.partitionBy("block"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    lists = lists.select("conv_id", "turns", opening.alias("opening"), h.alias("h"))
    head = F.when(F.col("opening").isNotNull(), F.slice("opening", F.lit(1), F.col("h"))).otherwise(F.slice("turns", 1, 0))
    return lists.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def _paths(key: bytes) -> list[bytes]:
    """Digest of the key's start of each number of turns."""
    out, h = [sha256().digest()], sha256()
    for at in range(0, len(key), WIDTH):
        h.update(key[at : at + WIDTH])
        out.append(h.copy().digest())
    return out


def _nodes(pid: int, run: int, keys: list[bytes], chars: list[list[int]], rows: list[tuple]) -> list[tuple]:
    """The trie nodes of one run of sorted keys; rows are (n, conv_id, seq) of each key."""
    root = None
    for i, key in enumerate(keys):
        root = insert(root, key, i)
    last = len(keys) - 1
    first_path, last_path = _paths(keys[0]), _paths(keys[-1])
    out: list[list] = []
    # Of each tree node: conversations, smallest id, first and last key, trie nodes right below, leaves and saved tokens of complete ones below.
    state: dict[int, list] = {}
    for mine, value, above, position, top in walk(root, WIDTH):
        n, conv, lo, hi, kids, leaves, saved = state.pop(mine, (0, None, last, 0, [], 0, 0))
        seq = None
        if value is not None:
            n, conv, lo, hi = n + rows[value][0], rows[value][1] if conv is None else min(conv, rows[value][1]), min(lo, value), max(hi, value)
            seq = rows[value][2]
        while position >= top:
            depth = position // WIDTH
            on_first, on_last = lo == 0, hi == last
            open_ = on_first or on_last
            path = first_path if on_first else last_path
            c = chars[lo][depth - 1] if depth else 0
            number = len(out)
            if open_:
                below = sum(not out[k][13] for k in kids)
                out.append([pid, run, path[depth], path[depth - 1] if depth else None, depth, conv, None, n, below, leaves, saved, c, seq, True, on_first, on_last])
                leaves = saved = 0
            else:
                leaves, saved = (leaves if kids else 1), saved + (n - 1) * c
                out.append([pid, run, None, None, depth, conv, None, n, len(kids), leaves, saved, c, seq, False, False, False])
            for k in kids:
                if open_ and not out[k][13]:
                    out[k][3] = path[depth]  # its number is known when all runs are added up
                elif not open_:
                    out[k][6] = conv
            kids, seq = [number], None
            position -= WIDTH
        if above >= 0:
            old = state.get(above)
            if old is None:
                state[above] = [n, conv, lo, hi, kids, leaves, saved]
            else:
                old[0], old[1], old[2], old[3] = old[0] + n, min(old[1], conv), min(old[2], lo), max(old[3], hi)
                old[4], old[5], old[6] = old[4] + kids, old[5] + leaves, old[6] + saved
    return out


def _batches(rows: list, size: int = 50_000):
    schema = pa.schema([(c.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[c.split()[1]]) for c in NODE.split(", ")])
    for at in range(0, len(rows), size):
        part = list(zip(*rows[at : at + size]))
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(part, schema.types)], schema=schema)


def _build(most_keys: int, most_bytes: int):
    """Rows (pid, ids, chars, n, conv_id, seq), sorted by ids, to the trie nodes of their runs."""

    def run(batches):
        keys, chars, rows, held, number, pid = [], [], [], 0, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                key = b"".join(row["ids"])
                if keys and (len(keys) == most_keys or held + len(key) > most_bytes):
                    yield from _batches(_nodes(pid, number, keys, chars, rows))
                    keys, chars, rows, held, number = [], [], [], 0, number + 1
                pid = row["pid"]
                keys.append(key)
                chars.append(row["chars"])
                rows.append((row["n"], row["conv_id"], row["seq"]))
                held += len(key)
        if keys:
            yield from _batches(_nodes(pid, number, keys, chars, rows))

    return run


def _merge(end: bool):
    """Adds up the open nodes of neighbouring runs; those at neither edge, or all at the ``end``, become complete."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["pid"], r["run"]))
        head, tail = (rows[0]["pid"], rows[0]["run"]), (rows[-1]["pid"], rows[-1]["run"])
        nodes: dict[bytes, dict] = {}
        for r in rows:
            at = (r["pid"], r["run"])
            first, last = r["first"] and at == head, r["last"] and at == tail
            node = nodes.get(r["digest"])
            if node is None:
                nodes[r["digest"]] = r | {"pid": head[0], "run": 0, "first": first, "last": last}
                continue
            for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                node[name] += r[name]
            node["conv_id"] = min(node["conv_id"], r["conv_id"])
            node["seq"] = node["seq"] or r["seq"]
            node["first"], node["last"] = node["first"] or first, node["last"] or last
        for node in sorted(nodes.values(), key=lambda r: -r["depth"]):
            node["open"] = not end and (node["first"] or node["last"])
            if node["open"]:
                continue
            node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node["chars"]
            above = nodes.get(node["above"])
            if above is not None:
                above["n_children"] += 1
                above["n_leaves"] += node["n_leaves"]
                above["saved_tokens"] += node["saved_tokens"]
        for node in nodes.values():
            above = nodes.get(node["above"])
            if not node["open"] and above is not None and not above["open"]:
                node["parent_conv_id"] = above["conv_id"]
        made = list(_batches([[r[n] for n in NAMES] for r in nodes.values()]))
        return pa.Table.from_batches(made)

    return run


def _blocks(batches):
    """Sorted (seq, conv_id) to blocks of comma-joined ids of one seq."""
    seq, ids = None, []
    made: list[tuple] = []
    for batch in batches:
        for s, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if s != seq or len(ids) == BLOCK:
                if ids:
                    made.append((seq, ids[0], ",".join(map(str, ids))))
                seq, ids = s, []
                if len(made) >= 1000:
                    yield _text(made)
                    made = []
            ids.append(i)
    if ids:
        made.append((seq, ids[0], ",".join(map(str, ids))))
    if made:
        yield _text(made)


def _text(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema=pa.schema([("seq", pa.binary()), ("start", pa.int64()), ("ids", pa.string())]))


def _digests(batches):
    """Blocks sorted by (seq, start) to the digest of each seq, one block at a time."""
    seq, h = None, None
    for batch in batches:
        made = []
        for s, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if s != seq:
                if h is not None:
                    made.append((seq, h.hexdigest()))
                seq, h = s, sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names=["seq", "ends_sha256"])
    if h is not None:
        yield pa.RecordBatch.from_arrays([pa.array([seq]), pa.array([h.hexdigest()])], names=["seq", "ends_sha256"])


def ends(members: DataFrame) -> DataFrame:
    """(seq, ends_sha256) of rows (seq, conv_id): SHA-256 of the decimal ids in ascending order, joined by commas.

    Ids are first put in order and joined to blocks wherever ranges put them, so a sequence that a third of all
    conversations share arrives at its digest as few blocks, which are hashed as they come.
    """
    parts = members.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").select("seq", "conv_id")
    blocks = parts.mapInArrow(_blocks, "seq binary, start long, ids string")
    blocks = blocks.repartition("seq").sortWithinPartitions("seq", "start").select("seq", "ids")
    return blocks.mapInArrow(_digests, "seq binary, ends_sha256 string")


def prefix_trie(lists: DataFrame, most_keys: int = KEYS, most_bytes: int = KEY_BYTES) -> DataFrame:
    """One row per node of the trie of (conv_id long, turns array of (id, chars)).

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens (what the node and those below it save: (n_convs - 1) times the chars of the last turn)
    and ends_sha256 (digest of the members that end there, see ends). A conversation without turns is a member of
    the root. No conversations give no nodes, not even a root. Each conv_id counts once per row.
    """
    ids = F.col("turns.id")
    rows = lists.select("conv_id", _half(F.array_join(F.transform(ids, F.hex), "").cast("binary")).alias("seq"), ids.alias("ids"), F.col("turns.chars").alias("chars"))
    rows = materialize(rows, "trie-rows")
    keys = materialize(rows.groupBy("seq", "ids", "chars").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")), "trie-keys")
    keys = keys.repartitionByRange("ids").sortWithinPartitions("ids").withColumn("pid", F.spark_partition_id())
    nodes = materialize(keys.mapInArrow(_build(most_keys, most_bytes), NODE), "trie-nodes")
    done = [nodes.where("not open")]
    level, span = nodes.where("open"), FAN
    top = level.agg(F.max("pid")).first()[0] or 0
    while True:
        level = level.withColumn("group", F.floor(F.col("pid") / span)).groupBy("group").applyInArrow(_drop_group(_merge(top < span)), NODE)
        level = materialize(level, "trie-merged")
        done.append(level.where("not open"))
        if top < span:
            break
        level, span = level.where("open"), span * FAN
    merged = done[1]
    for more in done[2:]:
        merged = merged.unionByName(more)
    numbers = merged.select(F.col("digest").alias("above"), F.col("conv_id").alias("number"))
    # Parents of complete nodes are looked up per run, so that the root is no hot key.
    of_run = nodes.where("open").select("pid", "run", F.col("digest").alias("above")).join(numbers, "above")
    columns = [*RESULT, "seq"]
    waiting = "above is not null and parent_conv_id is null"
    found = F.col("number").alias("parent_conv_id")
    named = [c if c != "parent_conv_id" else found for c in columns]
    parts = [
        done[0].where(f"not ({waiting})").select(columns), done[0].where(waiting).join(of_run, ["pid", "run", "above"]).select(named),
        merged.where(f"not ({waiting})").select(columns), merged.where(waiting).join(numbers, "above").select(named),
    ]
    nodes = parts[0]
    for more in parts[1:]:
        nodes = nodes.unionByName(more)
    with_ends = nodes.where("seq is not null").join(ends(rows.select("seq", "conv_id")), "seq").select(*RESULT, "ends_sha256")
    return with_ends.unionByName(nodes.where("seq is null").select(*RESULT, F.lit(sha256().hexdigest()).alias("ends_sha256")))


def _drop_group(merge):
    return lambda table: merge(table.drop_columns(["group"]))

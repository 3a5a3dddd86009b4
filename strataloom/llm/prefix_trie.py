"""Conversation prefix trie: rolling fingerprints of prefixes name the nodes, texts decide them, and parents are rolled up.

A prefix's fingerprint is a polynomial over its turns' hashes, in two prime fields. It is a running sum, so the fingerprint of one
conversation's beginning with another's rest on it follows from both's sums without reading a text again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.common import U64, dropped, mixed, partitions, prepare, span_hashes, stored, utf8

#: Two primes under 2**31, so that products are longs, and the polynomials' bases.
FIELDS, BASES = (2147483647, 2147483629), (1000003571, 1500450271)
#: Turns that a conversation may take from another's beginning: its hash is taken modulo this.
HEADS = 9
#: Bytes of texts that a task compares at a time, and rounds in which turns of one hash get others.
COMPARED, ROUNDS = 1 << 24, 50
SCANNED = "conv_id long, part int, pos long, f1 long, f2 long, u1 long, u2 long, upto long, size long, role string, text string"


# --- scans ------------------------------------------------------------------------------------------


def powers(base: int, exponents: np.ndarray, field: int) -> np.ndarray:
    """base ** exponents modulo a prime under 2**31."""
    out, square, left = np.ones(len(exponents), np.int64), base, exponents.copy()
    while left.any():
        out = np.where(left & 1, out * square % field, out)
        square, left = square * square % field, left >> 1
    return out


def turn_hashes(role: pa.Array, text: pa.Array, again: dict[tuple[str, str], int]) -> np.ndarray:
    """A hash of each turn, as a non-negative long; `again` says how often a turn has been given another."""
    (raw, off), (raw2, off2) = utf8(role), utf8(text)
    with np.errstate(over="ignore"):
        h = mixed(span_hashes(raw, off[:-1], off[1:]) * U64(0x9E3779B97F4A7C15) + span_hashes(raw2, off2[:-1], off2[1:]) + U64(1))
        if again:
            more = np.array([again.get(turn, 0) for turn in zip(role.to_pylist(), text.to_pylist(), strict=True)], U64)
            h = np.where(more > 0, mixed(h + more * U64(0xD6E8FEB86659FD93)), h)
    return (h >> U64(1)).astype(np.int64)


def _scan(fields: tuple[int, int], again: dict[tuple[str, str], int]):
    """Numbers each conversation's turns, and sums hashes and bytes up to each, as far as a task sees: conversations come in order."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now, pos, sums, size_now = None, 0, [0, 0], 0
        for batch in batches:
            if not len(batch):
                continue
            conv = batch["conv_id"].to_numpy()
            h = turn_hashes(batch["role"], batch["text"], again)
            size = np.diff(utf8(batch["text"])[1])
            first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(conv))))
            goes_on = conv[0] == now
            before = lambda total: (total - np.concatenate([[0], total])[first][of])  # noqa: B023, E731  a running sum within each conversation
            at = np.arange(len(conv)) - first[of] + 1 + np.where((of == 0) & goes_on, pos, 0)
            out, up = [], []
            for i, (field, base) in enumerate(zip(fields, BASES, strict=True)):
                term = h % field * powers(base % field, at, field) % field
                through = (before(np.cumsum(term)) + np.where((of == 0) & goes_on, sums[i], 0)) % field
                out.append(through)
                up.append((through - term) % field)
            upto = before(np.cumsum(size)) + np.where((of == 0) & goes_on, size_now, 0)
            now, pos, sums, size_now = conv[-1], int(at[-1]), [int(x[-1]) for x in out], int(upto[-1])
            columns = [pa.array(conv), pa.array(np.full(len(conv), part, np.int32)), *[pa.array(x.astype(np.int64)) for x in (at, *out, *up, upto, size)], batch["role"], batch["text"]]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SCANNED.split(", ")])

    return of_partition


def _carried(scanned: DataFrame, fields: tuple[int, int]) -> DataFrame:
    """The scan's rows with the numbers and sums of their conversation's turns in earlier parts added.

    A conversation that ends one part may begin the next ones; there are as many such rows as parts at most, so the driver adds them up.
    """
    ends = scanned.groupBy("part").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last")).orderBy("part").collect()
    split = {b["first"] for a, b in zip(ends, ends[1:]) if a["last"] == b["first"]}
    if not split:
        return scanned
    last = F.max_by(F.struct("pos", "f1", "f2", "upto"), "pos").alias("x")
    parts = scanned.where(F.col("conv_id").isin(list(split))).groupBy("conv_id", "part").agg(last).select("conv_id", "part", "x.*").orderBy("conv_id", "part").collect()
    rows, now, sums = [], None, (0, 0, 0, 0)
    for r in parts:
        if r["conv_id"] != now:
            now, sums = r["conv_id"], (0, 0, 0, 0)
        times = [pow(base % field, sums[0], field) for field, base in zip(fields, BASES, strict=True)]
        rows.append((now, r["part"], *sums, *times))
        sums = (sums[0] + r["pos"], *((sums[1 + i] + times[i] * r[f"f{i + 1}"]) % fields[i] for i in (0, 1)), sums[3] + r["upto"])
    carry = scanned.sparkSession.createDataFrame(rows, "conv_id long, part int, pos0 long, f01 long, f02 long, upto0 long, w1 long, w2 long")
    joined = scanned.join(F.broadcast(carry), ["conv_id", "part"], "left")
    none = F.col("pos0").isNull()
    moved = lambda c, i: F.when(none, F.col(f"{c}{i}")).otherwise((F.col(f"f0{i}") + F.col(f"w{i}") * F.col(f"{c}{i}")) % fields[i - 1])
    added = {"pos": F.when(none, F.col("pos")).otherwise(F.col("pos") + F.col("pos0")), "upto": F.when(none, F.col("upto")).otherwise(F.col("upto") + F.col("upto0"))}
    added |= {f"{c}{i}": moved(c, i) for c in ("f", "u") for i in (1, 2)}
    return joined.withColumns(added).select(*scanned.columns)


# --- comparing ----------------------------------------------------------------------------------------

NODE = "depth long, fp long, up long, conv_id long, n long, before long, size long, role string, text string"


def _classes(rows: pa.Table) -> np.ndarray:
    """For each row, in the order of (depth, fp, conv_id), the row that represents it: the first of its fingerprint that it equals in
    parent, role and text. Rows that differ from their group's first are compared with the first of themselves, and so on.
    """
    n = len(rows)
    depth, fp, up = (rows[c].to_numpy() for c in ("depth", "fp", "up"))
    stands = np.full(n, -1)
    left = np.arange(n)
    while len(left):
        first = np.concatenate([[True], (depth[left][1:] != depth[left][:-1]) | (fp[left][1:] != fp[left][:-1])])
        head = left[np.flatnonzero(first)[np.cumsum(first) - 1]]
        same = up[left] == up[head]
        for c in ("role", "text"):
            same &= pc.equal(rows[c].take(left), rows[c].take(head)).to_numpy()
        stands[left[same]] = head[same]
        left = left[~same]
    return stands


def _combined(batches: list[pa.RecordBatch]) -> pa.Table:
    """One row for each class of the batches, its least conversation first, with their number."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in ("depth", "fp", "conv_id")]))
    stands = _classes(rows)
    heads, at = np.unique(stands, return_inverse=True)
    n = np.zeros(len(heads), np.int64)
    np.add.at(n, at, rows["n"].to_numpy())
    return rows.take(heads).set_column(rows.schema.get_field_index("n"), "n", pa.array(n))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Combines a task's rows, some at a time; of a large group a task sends on few rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > COMPARED:
            yield from _combined(held).to_batches()
            held, size = [], 0
    if held:
        yield from _combined(held).to_batches()


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of rows that come in the order of (depth, fp, conv_id): what the group's representative equals is one, the rest others."""
    held: pa.Table | None = None
    for batch in batches:
        if not len(batch):
            continue
        rows = _combined([*(held.to_batches() if held else []), batch])
        # The last group may go on; its classes are held, one row for each.
        last = (rows["depth"].to_numpy() == rows["depth"][-1].as_py()) & (rows["fp"].to_numpy() == rows["fp"][-1].as_py())
        held = rows.filter(pa.array(last))
        yield from rows.filter(pa.array(~last)).to_batches()
    if held:
        yield from held.to_batches()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's conversations, joined by commas; they come in order and are read once."""
    names = ["depth", "fp", "ends_sha256"]
    now, digest = None, None
    for batch in batches:
        done = []
        for depth, fp, conv in zip(*(batch[c].to_pylist() for c in ("depth", "fp", "conv_id")), strict=True):
            if (depth, fp) != now:
                done += [(*now, digest.hexdigest())] if now else []
                now, digest = (depth, fp), hashlib.sha256(str(conv).encode())
            else:
                digest.update(b",%d" % conv)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names)
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, digest.hexdigest())], names)


# --- the trie -----------------------------------------------------------------------------------------


def _heads(conv: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return F.crc32(conv.cast("string")) % HEADS


def _rebuilt(scanned: DataFrame, fields: tuple[int, int]) -> DataFrame:
    """One row for each conversation: how its beginning is replaced, by sums.

    h own turns give way to the first k of `base`'s (few rows: `head` has base's sums at these); s are base's sums at k, o its own at h;
    length, and total, the bytes in all.
    """
    at_head = F.when(F.col("pos") < HEADS, F.struct("pos", "f1", "f2", "u1", "u2", "upto", "size"))
    whole = F.max_by(F.struct("f1", "f2", "upto"), "pos")
    convs = scanned.groupBy("conv_id").agg(F.max("pos").alias("turns"), whole.alias("whole"), F.sort_array(F.collect_list(at_head)).alias("head"))
    nothing = F.struct(F.lit(0).cast("long").alias("pos"), *[F.lit(0).cast("long").alias(c) for c in ("f1", "f2", "u1", "u2", "upto", "size")])
    named = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % 5, "asked": _heads(F.col("conv_id"))})
    bases = convs.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"), F.col("head").alias("base_head"))
    both = named.join(bases, "base", "left").withColumn("own", F.col("base") == F.col("conv_id"))
    # A base begins with its own turns: nothing is replaced.
    h = F.when(F.col("own"), 0).otherwise(F.col("asked")).cast("long")
    k = F.when(F.col("own"), 0).otherwise(F.least("asked", F.coalesce("base_turns", F.lit(0)))).cast("long")
    at = lambda head, n: F.coalesce(F.get(head, (n - 1).cast("int")), nothing)
    sized = both.withColumns({"h": h, "k": k}).withColumn("rest", F.greatest(F.col("turns") - F.col("h"), F.lit(0)))
    found = sized.withColumns({"s": at(F.col("base_head"), F.col("k")), "o": at(F.col("head"), F.least("h", "turns"))})
    back = [F.array(*[F.lit(pow(pow(base % field, i, field), -1, field)).cast("long") for i in range(HEADS)]) for field, base in zip(fields, BASES, strict=True)]
    shift = lambda i: F.get(back[i - 1], (F.col("h") - F.col("k")).cast("int")).alias(f"w{i}")
    flat = found.select("conv_id", "h", "k", "rest", "whole", shift(1), shift(2), *[F.col(f"{a}.{c}").alias(f"{a}_{c}") for a in "so" for c in ("f1", "f2", "upto")], F.slice(F.coalesce("base_head", F.array(nothing)), F.lit(1), F.col("k").cast("int")).alias("head"))
    return flat.withColumn("total", F.col("s_upto") + F.when(F.col("rest") > 0, F.col("whole.upto") - F.col("o_upto")).otherwise(0))


def _moved(sums: str, fields: tuple[int, int]) -> Column:
    """The rebuilt conversation's fingerprint where its own conversation's sums are as named."""
    lanes = [(F.col(f"s_f{i}") + F.col(f"w{i}") * F.pmod(F.col(f"{sums}{i}") - F.col(f"o_f{i}"), F.lit(fields[i - 1]))) % fields[i - 1] for i in (1, 2)]
    return _fingerprint(*lanes)


def _fingerprint(first: Column, second: Column) -> Column:
    return F.shiftleft(first, 31) + second


def trie(conversations: DataFrame, *, fields: tuple[int, int] = FIELDS) -> tuple[DataFrame, list[str]]:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of each node.

    Rows (conv_id, turn, role, text) are in the order of turn (null first), then role, then text; repeated rows are turns of their own. Null roles and
    texts are empty. Rows with a null conv_id belong to no conversation and aren't read, nor are other columns. No conversations, no
    nodes. Fingerprints only say what is compared: a node's conversations equal its least one in parent, role and text of the last turn, so by induction in
    all turns. Where they don't, the turns that differ get other hashes and the scan is made again. Also returns the scratch
    tables to delete in the end.
    """
    spark = conversations.sparkSession
    prepare(spark)
    n = partitions(spark)
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    # By ranges, so that a conversation of many turns is not one task's.
    ordered = own.where(F.col("conv_id").isNotNull()).repartitionByRange(n, "conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    again: dict[tuple[str, str], int] = {}
    for _ in range(ROUNDS):
        scanned, at = stored(ordered.mapInArrow(_scan(fields, again), SCANNED), "scanned")
        turns = _carried(scanned, fields)
        convs, to = stored(_rebuilt(turns, fields), "rebuilt")
        nodes, more = stored(_nodes(turns, convs, fields, n), "nodes")
        other = nodes.withColumn("nth", F.row_number().over(Window.partitionBy("depth", "fp").orderBy("conv_id"))).where("nth > 1")
        collided = other.select("role", "text").distinct().collect()
        if not collided:
            return _rolled_up(turns, convs, nodes, fields, n), [at, to, more]
        for r in collided:
            again[r["role"], r["text"]] = again.get((r["role"], r["text"]), 0) + 1
        for x in (at, to, more):
            dropped(spark, x)
    raise ValueError("turns of one fingerprint could not be told apart")


def _own_rows(turns: DataFrame, convs: DataFrame, fields: tuple[int, int], *columns: str) -> DataFrame:
    """Rebuilt conversations' own turns: depth, fingerprints and the bytes before each."""
    joined = turns.join(convs.drop("head", "whole"), "conv_id").where(F.col("pos") > F.col("h"))
    before = F.col("s_upto") + F.col("upto") - F.col("size") - F.col("o_upto")
    return joined.select((F.col("pos") - F.col("h") + F.col("k")).alias("depth"), _moved("f", fields).alias("fp"), _moved("u", fields).alias("up"), "conv_id", before.alias("before"), *columns)


def _taken_rows(convs: DataFrame, *columns: str) -> DataFrame:
    """Turns that conversations take from their base: copies of the base's own rows, few for each."""
    rows = convs.select("conv_id", F.inline("head"), *columns)
    return rows.select(F.col("pos").alias("depth"), _fingerprint(F.col("f1"), F.col("f2")).alias("fp"), _fingerprint(F.col("u1"), F.col("u2")).alias("up"), "conv_id", (F.col("upto") - F.col("size")).alias("before"), "size", *columns)


def _nodes(turns: DataFrame, convs: DataFrame, fields: tuple[int, int], n: int) -> DataFrame:
    """Nodes below the root, with representative, members and last turn; several of a fingerprint where it isn't one prefix's."""
    rows = _own_rows(turns, convs, fields, "size", "role", "text").select("depth", "fp", "up", "conv_id", F.lit(1).cast("long").alias("n"), "before", "size", "role", "text")
    sent = rows.mapInArrow(_compared, NODE).repartition(n, "depth", "fp").sortWithinPartitions("depth", "fp", "conv_id")
    return sent.mapInArrow(_verified, NODE)


def _rolled_up(turns: DataFrame, convs: DataFrame, nodes: DataFrame, fields: tuple[int, int], n: int) -> DataFrame:
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).where("n > 0").select(zero.alias("depth"), zero.alias("fp"), F.lit(None).cast("long").alias("up"), "conv_id", "n", zero.alias("before"), zero.alias("size"))
    taken = _taken_rows(convs).groupBy("depth", "fp").agg(F.first("up").alias("up"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first("before").alias("before"), F.first("size").alias("size"))
    plain = nodes.drop("role", "text").unionByName(taken)
    merged = plain.groupBy("depth", "fp").agg(F.first("up").alias("up"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.first("before").alias("before"), F.first("size").alias("size")).unionByName(root)

    children = merged.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up").alias("fp")).agg(F.count("*").alias("n_children"))
    whole = merged.join(children, ["depth", "fp"], "left").withColumn("n_children", F.coalesce("n_children", zero))

    # A subtree's sums, as sums over the node's conversations. Each node is charged to its least conversation, which is the least of all
    # nodes below on its own path too; so of a node's bytes times conversations less one, each conversation has what lies on its path
    # above the place where it is the least itself. Each leaf is its least conversation's.
    of_conv = whole.groupBy("conv_id").agg(F.min("before").alias("least_before"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    known = convs.join(of_conv, "conv_id", "left").withColumns({"charged": F.coalesce("least_before", "total"), "leaf": F.coalesce("leaf", zero)}).drop("least_before")
    share = lambda rows: rows.select("depth", "fp", F.greatest(F.col("charged") - F.col("before"), zero).alias("saved"), "leaf")
    every = share(_own_rows(turns, known, fields, "charged", "leaf")).unionByName(share(_taken_rows(known, "charged", "leaf"))).unionByName(known.select(zero.alias("depth"), zero.alias("fp"), F.col("charged").alias("saved"), "leaf"))
    sums = every.groupBy("depth", "fp").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    end = F.when(F.col("rest") > 0, _moved("whole.f", fields)).otherwise(_fingerprint(F.col("s_f1"), F.col("s_f2")))
    ends = convs.select((F.col("k") + F.col("rest")).alias("depth"), end.alias("fp"), "conv_id")
    digests = ends.repartition(n, "depth", "fp").sortWithinPartitions("depth", "fp", "conv_id").mapInArrow(_digests, "depth long, fp long, ends_sha256 string")

    parents = merged.select((F.col("depth") + 1).alias("depth"), F.col("fp").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    out = whole.join(sums, ["depth", "fp"]).join(digests, ["depth", "fp"], "left").join(parents, ["depth", "up"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))

"""The prefix trie of conversations, from their sorted order.

Conversations are sorted by the digests of their turns, so that all that share a prefix stand side by
side. Within a block of them, the longest common prefix of each neighbouring pair is an edge; edges
are taken in descending depth, and where union-find joins components, the trie branches. Nodes
between two branchings hold the same members and come as one chain.

A node that holds the first or the last conversation of a block may go on in the next one. A block
therefore hands on the path to its first and the path to its last conversation, with what is known of
their nodes; everything else is complete and written. Two neighbouring blocks are joined along their
touching paths, which completes what ended between them: within a task one after the other, and then
over neighbouring partitions, sixteen at a time, until one is left.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.session import scratch_dir

BLOCK = 4_096  # distinct conversations, or
BLOCK_TURNS = 65_536  # so many turns
FAN = 16  # neighbours joined in one step
IDS = 10  # ids that agree but for so many bits come as one sorted text
TURN = 24  # bytes of a turn in a sequence: its digest and the length of its text
DIGEST = 16
EMPTY = hashlib.sha256(b"").hexdigest()

_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, own binary, parent binary"
)
_NAMES = [field.split()[0] for field in _NODE.split(", ")]


def turn_sequences(
    turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """``conv_id, turns``: an array of 24 bytes a turn, in the order of the turn numbers, null first.

    Turns with equal numbers are ordered by role and then by the digest of their text. A null role or
    text counts as empty; rows without a conversation id belong to none.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_column, text_column))
    length = F.octet_length(text)
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    content = F.unhex(F.concat(digest, F.lpad(F.hex(length.cast("long")), 16, "0")))
    return (
        turns.where(F.col(id_column).isNotNull())
        .select(
            F.col(id_column).cast("long").alias("conv_id"),
            F.struct(F.col(turn_column).alias("turn"), role.alias("role"), content.alias("content")).alias("one"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("one")).alias("all"))
        .select("conv_id", F.col("all.content").alias("turns"))
    )


def branched(sequences: DataFrame, of: int = 5, lengths: int = 9) -> DataFrame:
    """Every conversation c begins anew: with the first ``crc32(c) % lengths`` turns of conversation
    ``c - c % of``, where there are such, and goes on with its own turns after as many."""
    first = sequences.where(F.col("conv_id") % of == 0).select(
        F.col("conv_id").alias("origin"), F.col("turns").alias("taken")
    )
    joined = sequences.withColumn("origin", F.col("conv_id") - F.col("conv_id") % of).join(first, "origin", "left")
    many = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % lengths).cast("int")
    taken = F.slice(F.coalesce("taken", F.expr("cast(array() as array<binary>)")), F.lit(1), many)
    return joined.select("conv_id", F.concat(taken, F.slice("turns", many + 1, F.size("turns"))).alias("turns"))


@dataclass(slots=True)
class Node:
    """What is known of a prefix: its members, and the totals of the children that are complete."""

    conv: int
    convs: int
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str = EMPTY

    def absorb(self, other: Node) -> None:
        self.conv = min(self.conv, other.conv)
        self.convs += other.convs
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        if other.ends != EMPTY:
            self.ends = other.ends


@dataclass(slots=True)
class Segment:
    """Neighbouring conversations: the nodes on the path to the first and on that to the last of
    them, from the root. Down to depth ``shared`` both paths are the same nodes."""

    first: bytes  # sequences of turns
    last: bytes
    head: list[Node]
    path: list[Node]
    shared: int


def common(a: bytes, b: bytes) -> int:
    """How many turns two sequences begin with alike."""
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * TURN] == b[: middle * TURN]:
            low = middle
        else:
            high = middle - 1
    return low


def _length(sequence: bytes, depth: int) -> int:
    """Bytes of the text of the turn at a depth from 1 on; the root has none."""
    return struct.unpack_from(">q", sequence, depth * TURN - 8)[0] if depth else 0


def _keys(sequence: bytes) -> list[bytes]:
    """A key for the prefix of every depth."""
    running = hashlib.blake2b(digest_size=DIGEST)
    found = [running.digest()]
    for at in range(0, len(sequence), TURN):
        running.update(sequence[at : at + TURN])
        found.append(running.digest())
    return found


def _row(node: Node, depth: int, parent_conv: int | None, own: bytes | None, parent: bytes | None) -> tuple:
    return (
        node.conv, depth, parent_conv, node.convs, node.children, max(node.leaves, 1), node.saved, node.ends, own, parent,
    )


def _close(node: Node, depth: int, above: Node | None, sequence: bytes, keys: list[bytes]) -> tuple:
    """A node is complete: its totals go to its parent."""
    node.saved += (node.convs - 1) * _length(sequence, depth)
    row = _row(node, depth, None, keys[depth], keys[depth - 1] if depth else None)
    if above is not None:
        above.children += 1
        above.leaves += max(node.leaves, 1)
        above.saved += node.saved
    return row


def join_segments(a: Segment, b: Segment) -> tuple[Segment, list[tuple]]:
    """The segment of two neighbours, and the rows of the nodes that are complete with it."""
    level = common(a.last, b.first)
    for depth in range(level + 1):
        a.path[depth].absorb(b.head[depth])
    rows: list[tuple] = []
    keys: list[bytes] | None = None
    for depth in range(len(b.head) - 1, level, -1):  # begun in b, and ended there
        if depth > b.shared:
            keys = keys or _keys(b.first)
            above = b.head[depth - 1] if depth - 1 > level else a.path[level]
            rows.append(_close(b.head[depth], depth, above, b.first, keys))
    keys = None
    kept = min(level, b.shared)
    for depth in range(len(a.path) - 1, kept, -1):  # ended in a, or in b before its last one
        if depth > a.shared:
            keys = keys or _keys(a.last)
            rows.append(_close(a.path[depth], depth, a.path[depth - 1], a.last, keys))
    path = a.path[: kept + 1] + b.path[kept + 1 :]
    return Segment(a.first, b.last, a.head, path, min(a.shared, kept)), rows


def finished(segment: Segment) -> list[tuple]:
    """The rows of all nodes of a segment that has no neighbours."""
    rows: list[tuple] = []
    keys = _keys(segment.last)
    for depth in range(len(segment.path) - 1, segment.shared, -1):
        rows.append(_close(segment.path[depth], depth, segment.path[depth - 1], segment.last, keys))
    keys = _keys(segment.first)
    for depth in range(len(segment.head) - 1, -1, -1):
        above = segment.head[depth - 1] if depth else None
        rows.append(_close(segment.head[depth], depth, above, segment.first, keys))
    return rows


@dataclass(slots=True)
class _Branch:
    """A component of neighbours: the deepest node that holds them all."""

    low: int
    high: int
    depth: int
    below: list[_Branch]


def _branches(sequences: list[bytes]) -> _Branch:
    """The branching nodes of a block, by union-find over its neighbour edges in descending depth."""
    lcp = [common(a, b) for a, b in zip(sequences, sequences[1:])]
    above = list(range(len(sequences)))
    top = [_Branch(i, i, len(s) // TURN, []) for i, s in enumerate(sequences)]

    def find(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    for edge in sorted(range(len(lcp)), key=lambda i: -lcp[i]):
        depth = lcp[edge]
        left, right = find(edge), find(edge + 1)
        one, two = top[left], top[right]
        # A component whose node is as deep as the edge takes the other in; else a node begins here.
        if one.depth == depth and two.depth == depth:
            small, large = sorted((one, two), key=lambda b: len(b.below))
            large.below += small.below
            large.low, large.high = one.low, two.high
            merged = large
        elif one.depth == depth:
            one.below.append(two)
            one.high = two.high
            merged = one
        elif two.depth == depth:
            two.below.append(one)
            two.low = one.low
            merged = two
        else:
            merged = _Branch(one.low, two.high, depth, [one, two])
        if one.high - one.low < two.high - two.low:
            left, right = right, left
        above[right] = left
        top[left] = merged
    whole = top[find(0)]
    return whole if whole.depth == 0 else _Branch(0, len(sequences) - 1, 0, [whole])


def block_segment(block: list[tuple[bytes, int, int, str]]) -> tuple[Segment, list[tuple]]:
    """The segment of sorted, distinct ``(sequence, smallest id, ids, digest of ids)``, and the rows of
    the nodes that neither hold the first nor the last of them."""
    sequences = [b[0] for b in block]
    last = len(block) - 1
    head: dict[int, Node] = {}
    path: dict[int, Node] = {}
    keys = {0: _keys(sequences[0]), last: _keys(sequences[last])}
    rows: list[tuple] = []
    root = _branches(sequences)
    # Branches from the root; what is above comes first, so backwards below comes first.
    order: list[tuple[_Branch, int]] = [(root, -1)]
    for branch, _ in order:
        order += [(child, branch.depth) for child in branch.below]
    made: dict[int, Node] = {}
    for branch, upper in reversed(order):
        low, high, depth = branch.low, branch.high, branch.depth
        sequence, conv, convs, ends = block[low]
        closed = [made.pop(id(child)) for child in branch.below]
        ended = len(sequence) // TURN == depth
        node = Node(conv if ended else closed[0].conv, convs if ended else 0, ends=ends if ended else EMPTY)
        for child, own in zip(branch.below, closed, strict=True):
            node.conv = min(node.conv, own.conv)
            node.convs += own.convs
            if child.low > 0 and child.high < last:
                node.children += 1
                node.leaves += max(own.leaves, 1)
                node.saved += own.saved
        opened = low == 0 or high == last
        if not opened:
            for child, own in zip(branch.below, closed, strict=True):
                rows.append(_row(own, depth + 1, node.conv, None, None))
        else:
            known = keys[0 if low == 0 else last][depth]
            for child, own in zip(branch.below, closed, strict=True):
                if child.low > 0 and child.high < last:
                    rows.append(_row(own, depth + 1, None, None, known))
        # The chain up to, but not including, the branch above. What is open stays without totals
        # of what is open below it.
        for d in range(depth, upper, -1):
            if opened:
                if low == 0:
                    head[d] = node
                if high == last:
                    path[d] = node
                node = Node(node.conv, node.convs)
            else:
                node.saved += (node.convs - 1) * _length(sequence, d)
                if d > upper + 1:
                    rows.append(_row(node, d, node.conv, None, None))
                    node = Node(node.conv, node.convs, 1, max(node.leaves, 1), node.saved)
        made[id(branch)] = node
    shared = max(d for d in head if head[d] is path.get(d))
    return (
        Segment(sequences[0], sequences[last], [head[d] for d in range(len(head))], [path[d] for d in range(len(path))], shared),
        rows,
    )


def _batch(rows: list[tuple], partition: int | None = None, segment: Segment | None = None) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    count = len(rows) + (segment is not None)
    extra = (None,) * (count - len(rows))
    arrays = [pa.array([*c, *extra], k) for c, k in zip(columns, kinds, strict=True)]
    blank = [None] * len(rows)
    arrays.append(pa.array(blank + ([partition] if segment else []), pa.int64()))
    arrays.append(pa.array(blank + ([pickle.dumps(segment)] if segment else []), pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=[*_NAMES, "place", "segment"])


_MADE = f"{_NODE}, place long, segment binary"


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition: rows ``sequence, part, ids, n, least`` in the order of sequence and part."""
    whole: Segment | None = None
    block: list[tuple[bytes, int, int, str]] = []
    turns = 0
    now: bytes | None = None
    least, n, running = 0, 0, hashlib.sha256()

    def added() -> list[tuple]:
        nonlocal whole, block, turns
        one, rows = block_segment(block)
        if whole is None:
            whole = one
        else:
            whole, more = join_segments(whole, one)
            rows += more
        block, turns = [], 0
        return rows

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("sequence", "ids", "n", "least"))
        for sequence, ids, count, smallest in zip(*columns, strict=True):
            if sequence != now:
                if now is not None:
                    block.append((now, least, n, running.hexdigest()))
                    turns += len(now) // TURN
                    if len(block) >= BLOCK or turns >= BLOCK_TURNS:
                        yield _batch(added())
                now, least, n, running = sequence, smallest, 0, hashlib.sha256()
            if n:
                running.update(b",")
            running.update(ids.encode())
            n += count
            least = min(least, smallest)
    if now is not None:
        block.append((now, least, n, running.hexdigest()))
        yield _batch(added())
        yield _batch([], TaskContext.get().partitionId(), whole)


def _folded(last: bool):
    """Neighbouring segments, ``place, segment``, joined in the order of their places."""

    def folded(key: tuple, rows: pa.Table) -> pa.Table:
        whole: Segment | None = None
        found: list[tuple] = []
        for blob in rows.sort_by("place")["segment"].to_pylist():
            one = pickle.loads(blob)
            if whole is None:
                whole = one
            else:
                whole, more = join_segments(whole, one)
                found += more
        if last:
            return pa.Table.from_batches([_batch(found + finished(whole))])
        return pa.Table.from_batches([_batch(found, key[0].as_py(), whole)])

    return folded


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """A row per distinct prefix of ``conv_id, turns``; ids must be distinct, turns as above.

    ``conv_id`` the smallest member, ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``
    members, ``n_children``, ``n_leaves`` childless nodes in its subtree, ``saved_tokens`` the bytes
    that members but the first share, summed over its subtree, and ``ends_sha256`` over the sorted ids
    of the members that end there. An empty table has no nodes, not even a root.

    A conversation is one record of 24 bytes a turn. Equal conversations come together as sorted texts
    of at most 1,024 ids, which only run through one checksum.
    """
    spark = sequences.sparkSession
    folder = scratch_dir(spark, "prefix-trie")

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = os.path.join(folder, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    whole = F.unhex(F.array_join(F.transform("turns", F.hex), ""))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    grouped = written(
        sequences.select("conv_id", whole.alias("sequence"), F.shiftright("conv_id", IDS).alias("part"))
        .groupBy("sequence", "part")
        .agg(ids.alias("ids"), F.count("*").alias("n"), F.min("conv_id").alias("least")),
        "sequences",
    )
    dealt = grouped.repartitionByRange("sequence").sortWithinPartitions("sequence", "part")
    made = written(dealt.mapInArrow(_built, _MADE), "blocks")
    nodes = made.where("segment IS NULL").select(*_NAMES)
    segments = made.where("segment IS NOT NULL").select("place", "segment")
    step = 0
    while (highest := segments.agg(F.max("place")).first()[0]) is not None:
        last = highest < FAN
        groups = segments.groupBy(F.floor(F.col("place") / FAN).alias("group"))
        made = written(groups.applyInArrow(_folded(last), _MADE), f"joined-{step}")
        nodes = nodes.unionByName(made.where("segment IS NULL").select(*_NAMES))
        if last:
            break
        segments = made.where("segment IS NOT NULL").select("place", "segment")
        step += 1
    parents = nodes.where("own IS NOT NULL").select(F.col("own").alias("parent"), F.col("conv_id").alias("_conv"))
    told = nodes.where("parent IS NOT NULL").join(parents, "parent").withColumn("parent_conv_id", F.col("_conv"))
    return nodes.where("parent IS NULL").select(*_NAMES[:8]).unionByName(told.select(*_NAMES[:8]))

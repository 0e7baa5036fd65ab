"""A trie of conversation prefixes: double arrays per shard, shared upper nodes merged.

A turn is known by the digest of its role and text.  A conversation is the path of
its turns; equal paths are one row with a count before any trie is built.  Paths are
dealt out in sorted order, so a shard is a run of neighbouring paths with at most
``shard_turns`` turns, however common a prefix is.

In a shard the distinct turns get dense ids, and the trie is packed level by level
into BASE and CHECK: the child of state ``s`` over turn ``id`` is the slot
``base[s] + id``, and ``check`` of that slot is ``s``.  All paths then walk the arrays
together and leave their counts at the states they pass; sums over subtrees go back
up along ``check``.

Neighbouring shards share only nodes of their first and last path.  Those are handed
on as paths with what the shard knows about each of their nodes, and the tries of the
paths of some neighbours add up what meets at one node.  That is done first within a
task, then for a fixed number of neighbouring tasks at a time, until one group is left.

Paths longer than ``band`` turns are cut into bands.  A band's paths hang below the
node where the band above them ends; bands are done from the deepest up, each giving
the sums below that node to the one above.

Odd rows.  Rows without a conversation id belong to no conversation and are left out.
A null role or text is empty; a null turn number comes first; turns of one number are
ordered by their digest, and a repeated row is a turn of its own.  An empty table has
no nodes.  Columns other than the four used are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.storage import written
from seriesmill.plans.skew import PIECE, ROWS_PER_TASK, cut_pieces, split_series

GROUP = 100
HEADS = 6
# Turns of one path segment, and of one shard.
BAND = 2048
SHARD_TURNS = 1 << 15
# Conversation ids hashed in one group; larger groups of equal conversations are cut into pieces.
IDS_PER_GROUP = 10_000
_IDS_PER_CHUNK = 200
# Shared nodes up to this count are broadcast when parents are looked up.
BROADCAST_NODES = 200_000
_SALTS = 64
# Neighbours whose handed-on paths are merged at a time.
_FAN = 32
_DIGEST = 32  # characters of a turn's digest
_NONE = np.iinfo(np.int64).max
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

#: A path, and what is known so far about each of its nodes, the one it starts at included.
PATHS = (
    "root string, path string, sizes array<int>, n array<long>, least array<long>, kids array<long>,"
    " leaves array<long>, saved array<long>, ends array<string>"
)
_WEIGHTS = ["n", "least", "kids", "leaves", "saved"]
NODES = (
    "root string, id string, parent_id string, depth long, conv_id long, parent_conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


# -- conversations as paths ---------------------------------------------------
def ranked_turns(rows: DataFrame, rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """(conv, pos, digest, size): the turns of every conversation, numbered from 1.

    A conversation with more than ``rows_per_task`` turns is numbered in pieces.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    spelled = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        F.substring(F.sha2(spelled, 256), 1, _DIGEST).alias("digest"),
        F.length(text).alias("size"),
    )
    order = [F.col("turn").asc_nulls_first(), "digest"]
    split = split_series(turns, ["conv"], rows_per_task)
    numbered = split.ordinary.withColumn("pos", F.row_number().over(Window.partitionBy("conv").orderBy(*order)).cast("long"))
    if split.long is not None:
        pieces = cut_pieces(split.long, ["conv"], ["turn", "digest"], split.long_rows, rows_per_task)
        before = Window.partitionBy("conv").orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
        offsets = pieces.groupBy("conv", PIECE).agg(F.count("*").alias("_own")).select(
            "conv", PIECE, F.coalesce(F.sum("_own").over(before), F.lit(0)).alias("_before")
        )
        within = F.row_number().over(Window.partitionBy("conv", PIECE).orderBy(*order))
        long = pieces.withColumn("_within", within).join(offsets, ["conv", PIECE])
        numbered = numbered.unionByName(
            long.withColumn("pos", F.col("_before") + F.col("_within")).select(*numbered.columns)
        )
    return written(numbered.drop("turn"), "turns")


def rebuilt(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, depth, digest, size) of the rebuilt conversations, all conv ids).

    The first ``h`` turns come from the first conversation of the group, the others
    from the conversation itself; ``h`` follows from the conversation's id alone.
    """
    h = F.crc32(F.col("conv").cast("string")) % HEADS
    template = F.col("conv") - F.col("conv") % GROUP
    convs = ranked.filter("pos = 1").select("conv", template.alias("t"), h.alias("h"))
    heads = ranked.filter((F.col("pos") < HEADS) & (F.col("conv") == template)).select(
        F.col("conv").alias("t"), F.col("pos").alias("depth"), "digest", "size"
    )
    # A template lends to the conversations of one group, at most 199 of them.
    lent = convs.join(heads, "t").filter("depth <= h").select("conv", "depth", "digest", "size")
    given = heads.groupBy("t").agg(F.count("*").alias("given"))
    # One long conversation must not meet its template's count in one task.
    counts = convs.select("t").distinct().join(given, "t", "left").select(
        "t", F.coalesce("given", F.lit(0)).alias("given"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt")
    )
    own = (
        ranked.withColumn("t", template)
        .withColumn("h", h)
        .filter("pos > h")
        .withColumn("salt", (F.col("pos") % 16).cast("int"))
        .join(counts, ["t", "salt"])
        .withColumn("depth", F.least("h", "given") + F.col("pos") - F.col("h"))
    )
    return lent.unionByName(own.select("conv", "depth", "digest", "size")), convs.select("conv")


def _node_id(root: Column | str, path: Column | str) -> Column:
    return F.sha2(F.concat(root, path), 256)


def ends_of(members: DataFrame, ids_per_group: int = IDS_PER_GROUP) -> DataFrame:
    """(id, ends): SHA-256 of the ascending, comma-joined ``conv`` of each ``id``.

    A digest can only be taken in order.  Groups above ``ids_per_group`` are sorted
    and spelled in pieces, whose texts one task then passes through the digest
    without holding them.
    """
    split = split_series(members, ["id"], ids_per_group)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    ends = split.ordinary.groupBy("id").agg(F.sha2(joined, 256).alias("ends"))
    if split.long is None:
        return ends
    pieces = cut_pieces(split.long, ["id"], ["conv"], split.long_rows, ids_per_group)
    grouped = pieces.groupBy("id", PIECE).agg(F.sort_array(F.collect_list("conv")).alias("convs"))
    chunks = grouped.select(
        "id",
        PIECE,
        F.posexplode(
            F.transform(
                F.sequence(F.lit(1), F.size("convs"), F.lit(_IDS_PER_CHUNK)),
                lambda at: F.array_join(
                    F.transform(F.slice("convs", at, F.lit(_IDS_PER_CHUNK)), lambda c: c.cast("string")), ","
                ),
            )
        ).alias("chunk", "spelled"),
    )
    ordered = chunks.repartition("id").sortWithinPartitions("id", PIECE, "chunk").select("id", "spelled")
    return ends.unionByName(ordered.mapInArrow(_digests, "id string, ends string"))


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, digest, done = None, None, []
    for batch in batches:
        for key, spelled in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key != at:
                if digest is not None:
                    done.append((at, digest.hexdigest()))
                at, digest = key, hashlib.sha256(spelled.encode())
            else:
                digest.update(b"," + spelled.encode())
    if digest is not None:
        done.append((at, digest.hexdigest()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in done], pa.string()), pa.array([d for _, d in done], pa.string())], names=["id", "ends"]
    )


# -- the double array ---------------------------------------------------------
class DoubleArray:
    """BASE and CHECK of the trie of some paths of dense ids, all known beforehand.

    ``paths`` holds the ids of each path one after another, ``starts`` where each
    begins.  State 0 is the root.  Slots are taken first by states with many
    children, at the first base that fits; single children fill what is left free.
    """

    def __init__(self, paths: np.ndarray, starts: np.ndarray):
        self.base = np.zeros(1, np.int64)
        self.check = np.full(1, -2, np.int64)  # -1 would be a free slot
        self._free_from = 1
        self.levels: list[np.ndarray] = [np.zeros(1, np.int64)]
        lengths = np.diff(starts)
        width = int(paths.max()) + 1 if len(paths) else 1
        at = np.arange(len(lengths))
        state = np.zeros(len(lengths), np.int64)
        depth = 0
        while True:
            at = at[lengths[at] > depth]
            if not len(at):
                break
            pairs = np.unique(state[at] * width + paths[starts[at] + depth])
            self._place(pairs // width, pairs % width)
            state[at] = self.step(state[at], paths[starts[at] + depth])
            self.levels.append(np.unique(state[at]))
            depth += 1

    def step(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The children of ``states`` over ``ids``, all of which exist."""
        children = self.base[states] + ids
        if (self.check[children] != states).any():
            raise ValueError("a path that is not in the trie")
        return children

    def _grow(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _free(self, count: int, start: int) -> np.ndarray:
        """The first ``count`` free slots from ``start`` on."""
        span = max(2 * count, 64)
        while True:
            self._grow(start + span)
            free = np.flatnonzero(self.check[start : start + span] == -1)[:count]
            if len(free) == count:
                return free + start
            span *= 2

    def _place(self, parents: np.ndarray, ids: np.ndarray) -> None:
        """Slots for the children (parent, id) of one level, sorted by parent and id."""
        firsts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        counts = np.diff(np.concatenate([firsts, [len(parents)]]))
        several = np.flatnonzero(counts > 1)
        for group in several[np.argsort(-counts[several], kind="stable")]:
            own = ids[firsts[group] : firsts[group] + counts[group]]
            self._fit(int(parents[firsts[group]]), own)
        alone = firsts[counts == 1]
        if len(alone):
            slots = self._free(len(alone), self._free_from)
            self.base[parents[alone]] = slots - ids[alone]
            self.check[slots] = parents[alone]
            self._free_from = int(slots[-1]) + 1

    def _fit(self, parent: int, ids: np.ndarray) -> None:
        away = ids - ids[0]
        start = self._free_from
        while True:
            tried = self._free(64, start)
            self._grow(int(tried[-1] + away[-1]) + 1)
            fits = (self.check[tried[:, None] + away[None, :]] == -1).all(axis=1)
            if fits.any():
                slots = tried[int(fits.argmax())] + away
                break
            start = int(tried[-1]) + 1
        self.base[parent] = slots[0] - ids[0]
        self.check[slots] = parent


# -- shards -------------------------------------------------------------------
def _blocks(batches: Iterable[pa.RecordBatch], turns: int) -> Iterator[pa.Table]:
    """Runs of rows with at most ``turns`` turns, or one row that alone has more."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        lengths = np.diff(batch.column("sizes").offsets.to_numpy()) + 1
        start = 0
        while start < batch.num_rows:
            fits = int(np.searchsorted(np.cumsum(lengths[start:]), turns - total, "right"))
            if not fits and held:
                yield pa.Table.from_batches(held)
                held, total = [], 0
                continue
            stop = start + max(1, fits)
            held.append(batch.slice(start, stop - start))
            total += int(lengths[start:stop].sum())
            start = stop
    if held:
        yield pa.Table.from_batches(held)


def _flat(table: pa.Table, column: str) -> np.ndarray:
    lists = table.column(column).combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False)


class Shard:
    """The trie of one run of paths, with what its nodes add up to in this run."""

    def __init__(self, block: pa.Table):
        self.roots = block.column("root").to_pylist()
        self.paths = block.column("path").to_pylist()
        sizes = block.column("sizes").combine_chunks()
        offsets = sizes.offsets.to_numpy() if not isinstance(sizes, pa.ChunkedArray) else sizes.chunk(0).offsets.to_numpy()
        self.lengths = np.diff(offsets)
        # Nodes of a path: the one it starts at, then one a turn.
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)])
        total = int(self.starts[-1])
        first = np.zeros(total, bool)
        first[self.starts[:-1]] = True
        names = np.empty(total, object)
        names[first] = ["/" + r for r in self.roots]
        names[~first] = [p[i : i + _DIGEST] for p in self.paths for i in range(0, len(p), _DIGEST)]
        # Dense ids; a band's root is the first symbol of its paths.
        self.ids = np.unique(names.astype(str), return_inverse=True)[1].astype(np.int64)
        self.trie = DoubleArray(self.ids, self.starts)
        size = len(self.trie.base)
        self.size_at = np.zeros(size, np.int64)
        self.n, self.kids, self.leaves, self.saved = (np.zeros(size, np.int64) for _ in range(4))
        self.least = np.full(size, _NONE)
        self.depth = np.full(size, -1, np.int64)
        self.ends: dict[int, str] = {}
        self.slots = np.zeros(total, np.int64)
        self._walk(block, first)
        self.border = np.zeros(size, bool)
        #: States by depth, from those that paths start at.
        self.levels = self.trie.levels[1:]
        for level in self.levels[1:]:
            np.add.at(self.kids, self.trie.check[level], 1)

    def _walk(self, block: pa.Table, first: np.ndarray) -> None:
        """All paths through the arrays, side by side, leaving their weights."""
        at, state, depth = np.arange(len(self.lengths)), np.zeros(len(self.lengths), np.int64), 0
        while len(at):
            here = self.starts[at] + depth
            state[at] = self.trie.step(state[at], self.ids[here])
            self.slots[here] = state[at]
            self.depth[state[at]] = depth
            depth += 1
            at = at[self.lengths[at] >= depth]
        sizes = np.zeros(len(first), np.int64)
        sizes[~first] = _flat(block, "sizes")
        self.size_at[self.slots] = sizes
        np.minimum.at(self.least, self.slots, _flat(block, "least"))
        for name in ("n", "kids", "leaves", "saved"):
            np.add.at(getattr(self, name), self.slots, _flat(block, name))
        ends = _flat(block, "ends")
        for place in np.flatnonzero([e is not None for e in ends]):
            self.ends[int(self.slots[place])] = ends[place]

    def mark_border(self, whole: bool) -> None:
        """Nodes of the first and the last path may lie in another shard too, unless this is all there is."""
        if not whole:
            for path in (0, len(self.lengths) - 1):
                self.border[self.slots[self.starts[path] : self.starts[path + 1]]] = True
        settled = ~self.border
        for d in range(len(self.levels) - 1, -1, -1):
            level = self.levels[d]
            own = level[settled[level]]
            self.leaves[own[self.kids[own] == 0]] = 1
            if d:
                self.saved[own] += (self.n[own] - 1) * self.size_at[own]
                parents = self.trie.check[own]
                np.add.at(self.leaves, parents, self.leaves[own])
                np.add.at(self.saved, parents, self.saved[own])
                # A border node is handed on with its settled children alone; it meets the others again.
                open_ = level[~settled[level]]
                np.subtract.at(self.kids, self.trie.check[open_], 1)

    def root_at(self, place: int) -> str:
        return self.roots[int(np.searchsorted(self.starts, place, "right")) - 1]

    def id_at(self, place: int) -> str:
        """The id of the node at a place of the paths: its root's, or the digest of the way from there."""
        path = int(np.searchsorted(self.starts, place, "right")) - 1
        way = self.paths[path][: (place - int(self.starts[path])) * _DIGEST]
        return hashlib.sha256((self.roots[path] + way).encode()).hexdigest() if way else self.roots[path]


_OUT = pa.schema(
    [
        ("part", pa.int64()), ("root", pa.string()), ("id", pa.string()), ("parent_id", pa.string()), ("depth", pa.int64()),
        ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
        ("path", pa.string()), ("sizes", pa.list_(pa.int32())),
        *((name, pa.list_(pa.int64())) for name in _WEIGHTS), ("ends", pa.list_(pa.string())),
    ]
)
_OUT_SQL = "part long, " + NODES + ", " + PATHS.removeprefix("root string, ")


def _settled(shard: Shard, band: int, named: bool, rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    slots, places = np.unique(shard.slots, return_index=True)
    keep = ~shard.border[slots]
    slots, places = slots[keep], places[keep]
    parents = shard.trie.check[slots]
    depth = shard.depth[slots]
    top = depth == 0
    # The parent's smallest member is known here unless other shards have members of it, or another band.
    open_ = ~top & (shard.border[parents] | (shard.depth[parents] == 0))
    ids: dict[int, str] = {}
    for start in range(0, len(slots), rows):
        own = slice(start, start + rows)
        parent_ids, node_ids = [], []
        for slot, place, parent, unknown, d in zip(
            slots[own].tolist(), places[own].tolist(), parents[own].tolist(), open_[own].tolist(), depth[own].tolist(),
            strict=True,
        ):
            if unknown and parent not in ids:
                ids[parent] = shard.id_at(place - 1)
            parent_ids.append(ids[parent] if unknown else None)
            node_ids.append(shard.id_at(place) if named or d in (0, band) else None)
        s = slots[own]
        known = ~open_[own] & ~top[own]
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(s), pa.int64()),
                pa.array(map(shard.root_at, places[own].tolist()), pa.string()),
                pa.array(node_ids, pa.string()),
                pa.array(parent_ids, pa.string()),
                pa.array(depth[own]),
                pa.array(shard.least[s]),
                pa.array(np.where(known, shard.least[parents[own]], 0), mask=~known),
                pa.array(shard.n[s]),
                pa.array(shard.kids[s]),
                pa.array(shard.leaves[s]),
                pa.array(shard.saved[s]),
                pa.array([shard.ends.get(i) for i in s.tolist()], pa.string()),
                *(pa.nulls(len(s), f.type) for f in list(_OUT)[12:]),
            ],
            schema=_OUT,
        )


def _handed_on(shard: Shard) -> pa.RecordBatch:
    """The first and the last path with their nodes' weights, nodes of both with the first alone."""
    rows, seen = [], set()
    for path in dict.fromkeys((0, len(shard.lengths) - 1)):
        slots = shard.slots[shard.starts[path] : shard.starts[path + 1]]
        new = np.array([int(s) not in seen for s in slots])
        seen.update(slots.tolist())
        row = {
            "root": shard.roots[path],
            "path": shard.paths[path],
            "sizes": shard.size_at[slots[1:]].tolist(),
            "least": np.where(new, shard.least[slots], _NONE).tolist(),
            "ends": [shard.ends.get(int(s)) if fresh else None for s, fresh in zip(slots, new, strict=True)],
        }
        row |= {k: np.where(new, getattr(shard, k)[slots], 0).tolist() for k in ("n", "kids", "leaves", "saved")}
        rows.append(row)
    return pa.RecordBatch.from_pylist(rows, schema=_OUT)


# -- all shards of a band -------------------------------------------------------
def _merged(paths: list[pa.RecordBatch], band: int, whole: bool) -> tuple[list[pa.RecordBatch], pa.RecordBatch | None]:
    """Rows of the nodes that ``paths`` of neighbouring shards settle, and the paths to hand on."""
    shard = Shard(pa.Table.from_batches(paths).sort_by([("root", "ascending"), ("path", "ascending")]))
    shard.mark_border(whole)
    return list(_settled(shard, band, named=True)), None if whole else _handed_on(shard)


def _partition(turns: int, band: int):
    """The shards of a partition of sorted paths: settled nodes, and at most two paths handed on.

    What shards hand on is merged as soon as ``_FAN`` neighbours have done so, so a
    task holds one shard and a few paths however large its partition is.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[pa.RecordBatch]] = []
        for block in _blocks(batches, turns):
            shard = Shard(block)
            shard.mark_border(False)
            yield from _settled(shard, band, named=False)
            paths, level = _handed_on(shard), 0
            while True:
                if level == len(waiting):
                    waiting.append([])
                waiting[level].append(paths)
                if len(waiting[level]) < _FAN:
                    break
                nodes, paths = _merged(waiting[level], band, False)
                yield from nodes
                waiting[level] = []
                level += 1
        if rest := [paths for level in reversed(waiting) for paths in level]:
            nodes, paths = _merged(rest, band, False)
            yield from nodes
            part = pa.array([TaskContext.get().partitionId()] * paths.num_rows, pa.int64())
            yield paths.set_column(0, "part", part)

    return run


def _neighbours(band: int, whole: bool):
    def run(key: tuple[pa.Scalar], paths: pa.Table) -> pa.Table:
        nodes, handed = _merged(paths.to_batches(), band, whole)
        if handed is not None:
            nodes.append(handed.set_column(0, "part", pa.array([key[0].as_py()] * handed.num_rows, pa.int64())))
        return pa.Table.from_batches(nodes, schema=_OUT)

    return run


def band_nodes(paths: DataFrame, *, shard_turns: int = SHARD_TURNS, band: int = BAND, fan: int = _FAN) -> DataFrame:
    """The nodes (``NODES``) of the tries of ``paths``, which have the columns of ``PATHS``.

    ``parent_id`` names parents whose smallest member was not known with the child.
    Each round merges the paths that ``fan`` neighbouring tasks handed on.
    """
    given = [c.split(" ")[0] for c in PATHS.split(", ")]
    nodes = [c.split(" ")[0] for c in NODES.split(", ")]
    by = ["root", "path"]
    ranged = paths.select(*given).repartitionByRange(*by).sortWithinPartitions(*by)
    done = written(ranged.mapInArrow(_partition(shard_turns, band), _OUT_SQL), "shards")
    found = [done.filter("part IS NULL").select(*nodes)]
    while True:
        handed = done.filter("part IS NOT NULL")
        top = handed.agg(F.max("part")).first()[0]
        if top is None:
            return reduce(DataFrame.unionByName, found)
        groups = handed.withColumn("part", F.expr(f"part div {fan}")).groupBy("part")
        done = written(groups.applyInArrow(_neighbours(band, top < fan), _OUT_SQL), "shards")
        found.append(done.filter("part IS NULL").select(*nodes))


def _with_parents(nodes: DataFrame, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """Smallest members of parents that were not known with their children."""
    known = nodes.filter("id IS NOT NULL").select(F.col("id").alias("parent_id"), F.col("conv_id").alias("_found"))
    open_ = nodes.filter("parent_id IS NOT NULL")
    closed = nodes.filter("parent_id IS NULL")
    if known.limit(broadcast_nodes + 1).count() <= broadcast_nodes:
        looked = open_.join(F.broadcast(known), "parent_id", "left")
    else:
        # A very common prefix has very many children: they meet copies of the parent.
        salted = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        salt = (F.pmod(F.xxhash64("conv_id", "depth"), F.lit(_SALTS))).cast("int")
        looked = open_.withColumn("_salt", salt).join(salted, ["parent_id", "_salt"], "left").drop("_salt")
    return closed.unionByName(looked.withColumn("parent_conv_id", F.col("_found")).drop("_found").select(*closed.columns))


def trie_nodes(
    turns: DataFrame,
    convs: DataFrame,
    *,
    band: int = BAND,
    shard_turns: int = SHARD_TURNS,
    ids_per_group: int = IDS_PER_GROUP,
    broadcast_nodes: int = BROADCAST_NODES,
) -> DataFrame:
    """One row per node of the trie of (conv, depth, digest, size) over all ``convs``."""
    segments = written(
        turns.withColumn("band", F.expr(f"(depth - 1) div {band}"))
        .groupBy("conv", "band")
        .agg(F.array_sort(F.collect_list(F.struct("depth", "digest", "size"))).alias("own"))
        .select("conv", "band", F.array_join("own.digest", "").alias("path"), F.col("own.size").alias("sizes")),
        "segments",
    )
    deepest = segments.agg(F.max("band")).first()[0] or 0
    heads = convs.select("conv", F.lit("").alias("root"))
    bands = []
    for number in range(deepest + 1):
        own = segments.filter(F.col("band") == number).drop("band")
        # A conversation without turns of its own in the first band ends at the root.
        joined = heads.join(own, "conv", "left").select(
            "conv", "root", F.coalesce("path", F.lit("")).alias("path"),
            F.coalesce("sizes", F.array().cast("array<int>")).alias("sizes"),
        )
        more = segments.filter(F.col("band") == number + 1).select("conv", F.lit(1).alias("more"))
        bands.append(written(joined.join(more, "conv", "left") if number < deepest else joined, "band"))
        if number < deepest:
            heads = bands[-1].filter("more = 1").select("conv", _node_id("root", "path").alias("root"))
    members = reduce(
        DataFrame.unionByName,
        [
            (rows.filter("more IS NULL") if "more" in rows.columns else rows).select(_node_id("root", "path").alias("id"), "conv")
            for rows in bands
        ],
    )
    ends = written(ends_of(members, ids_per_group), "ends")
    levels, below = [], None
    for rows in reversed(bands):
        nodes = band_nodes(written(_paths(rows, ends, below), "paths"), shard_turns=shard_turns, band=band)
        below = nodes.filter("depth = 0").select(
            "id", F.col("n_children").alias("_kids"), F.col("n_leaves").alias("_leaves"), F.col("saved_tokens").alias("_saved")
        )
        levels.append(nodes)
    # The root of a deeper band is a node of the band above it.
    found = [
        nodes.filter("depth > 0").withColumn("depth", F.col("depth") + number * band) if number else nodes
        for number, nodes in enumerate(reversed(levels))
    ]
    return _with_parents(reduce(DataFrame.unionByName, found), broadcast_nodes).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def _paths(rows: DataFrame, ends: DataFrame, below: DataFrame | None) -> DataFrame:
    """Equal paths as one row, in the columns of ``PATHS``."""
    equal = (
        rows.withColumn("id", _node_id("root", "path"))
        .groupBy("id")
        .agg(
            F.first("root").alias("root"),
            F.first("path").alias("path"),
            F.first("sizes").alias("sizes"),
            F.count("*").alias("_n"),
            F.min("conv").alias("_least"),
        )
        .join(ends.withColumnRenamed("ends", "_ends"), "id", "left")
    )
    if below is None:
        zero = F.lit(0).cast("long")
        equal = equal.select("*", zero.alias("_kids"), zero.alias("_leaves"), zero.alias("_saved"))
    else:
        equal = equal.join(below, "id", "left").fillna(0, ["_kids", "_leaves", "_saved"])
    upto = F.size("sizes")

    def last(column: str, before: Column) -> Column:
        return F.concat(F.array_repeat(before, upto), F.array(F.col(column)))

    zero, none = F.lit(0).cast("long"), F.lit(None).cast("string")
    return equal.select(
        "root",
        "path",
        "sizes",
        F.array_repeat("_n", upto + 1).alias("n"),
        F.array_repeat("_least", upto + 1).alias("least"),
        last("_kids", zero).alias("kids"),
        last("_leaves", zero).alias("leaves"),
        last("_saved", zero).alias("saved"),
        last("_ends", none).alias("ends"),
    )


def conversation_trie(rows: DataFrame, *, rows_per_task: int | None = ROWS_PER_TASK, **sizes) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations of ``rows``."""
    turns, convs = rebuilt(ranked_turns(rows, rows_per_task))
    return trie_nodes(turns, convs, **sizes)


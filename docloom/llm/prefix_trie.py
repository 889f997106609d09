"""A trie of conversation prefixes, as balanced parentheses per shard.

Distinct sequences of turns are sorted; a stretch of neighbours is a shard.  The common
prefix of neighbours says how many parentheses close before a sequence's own ones open.
In a shard, findclose (over blocks of excess minima) delimits a node's subtree, rank
counts its leaf pairs, and differences of cumulative arrays give members and savings.

Nodes on a shard's first or last path, its spine, may go on in the neighbouring shards.
They are passed on with what hangs below them already summed, as sequences of a next and
far shorter level, which is treated in the same way until one shard is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.session import materialize

#: A rebuilt conversation shares up to ``crc32(id) % SHARED`` turns with the first of its ``FAMILY``.
FAMILY, SHARED = 100, 6
#: Turns of a shard (more if fewer than LEAST_ROWS sequences have them).  Of a level with n sequences at most n / 8 parts and
#: n / 8 full shards are made, each passes on two paths: a level is at most half of the one before.
SHARD_TURNS, LEAST_ROWS = 1 << 15, 8
#: Parentheses of a block of the excess index.
BLOCK = 64
#: Characters of a chunk of member ids that is hashed at a time.
CHUNK = 1 << 16
_NOBODY = np.iinfo(np.int64).max
_DIGEST = 16


class Parentheses:
    """Balanced parentheses with the least excess of each block, in a binary tree."""

    def __init__(self, opens: np.ndarray) -> None:
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1).astype(np.int64))
        blocks = -(-len(opens) // BLOCK)
        self._rows = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        self._rows[: len(opens)] = self.excess
        self._rows = self._rows.reshape(blocks, BLOCK)
        self._least = [self._rows.min(axis=1)] if blocks else []
        while self._least and len(self._least[-1]) > 1:
            low = self._least[-1]
            low = np.append(low, np.iinfo(np.int64).max) if len(low) % 2 else low
            self._least.append(low.reshape(-1, 2).min(axis=1))

    def close(self, at: np.ndarray) -> np.ndarray:
        """Positions of the parentheses that close those opened at ``at``."""
        parts = [self._close(at[i : i + 8192]) for i in range(0, len(at), 8192)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _close(self, at: np.ndarray) -> np.ndarray:
        wanted = self.excess[at] - 1  # the first later place with this excess
        block = at // BLOCK
        later = (self._rows[block] <= wanted[:, None]) & (np.arange(BLOCK) > (at % BLOCK)[:, None])
        inside = later.any(axis=1)
        found = np.where(inside, block * BLOCK + later.argmax(axis=1), -1)
        # Climb until a right sibling reaches down to the excess, then go down to its first block that does.
        node, level = block.copy(), np.full(len(at), -1)
        open_ = np.flatnonzero(~inside)
        for depth, least in enumerate(self._least):
            right = node[open_] + 1
            hit = (node[open_] % 2 == 0) & (right < len(least)) & (least[np.minimum(right, len(least) - 1)] <= wanted[open_])
            level[open_[hit]] = depth
            node[open_[hit]] = right[hit]
            open_ = open_[~hit]
            node[open_] //= 2
        for depth in range(len(self._least) - 1, 0, -1):
            down = np.flatnonzero(level >= depth)
            left = node[down] * 2
            node[down] = np.where(self._least[depth - 1][left] <= wanted[down], left, left + 1)
        far = np.flatnonzero(~inside)
        found[far] = node[far] * BLOCK + (self._rows[node[far]] <= wanted[far, None]).argmax(axis=1)
        return found


@dataclass
class Shard:
    """Sorted sequences, one element per turn and one more in front for the root.

    ``own`` holds per element what is already known below it: members (n), smallest member,
    leaves, savings and children; ``ends`` the digest of the members that end there.
    """

    sizes: np.ndarray  # elements per sequence
    digests: np.ndarray  # (elements, 2) uint64; zero for the root
    chars: np.ndarray
    own: dict[str, np.ndarray]
    ends: np.ndarray  # object: str or None
    keys: np.ndarray | None  # object: the path key of each element; not needed at the first level

    def solve(self, last: bool) -> tuple[dict[str, np.ndarray], list[dict]]:
        """(finished nodes as columns, spine paths for the next level); the ``last`` shard has no spine."""
        sizes = self.sizes
        starts = np.cumsum(sizes) - sizes
        sequence = np.repeat(np.arange(len(sizes)), sizes)
        depth = np.arange(len(sequence)) - starts[sequence]
        # Equal to the element of the same depth in the sequence before, and so all before it?
        before = np.where(sequence > 0, starts[np.maximum(sequence - 1, 0)] + depth, 0)
        same = (sequence > 0) & (depth < sizes[np.maximum(sequence - 1, 0)])
        same[same] = (self.digests[same.nonzero()[0]] == self.digests[before[same]]).all(axis=1)
        shared = np.minimum.reduceat(np.where(same, sizes[sequence], depth), starts)  # leading equal elements
        fresh = depth >= shared[sequence]

        closes = np.append(0, sizes[:-1] - shared[1:])
        steps = np.append(np.stack([closes, sizes - shared], axis=1).ravel(), sizes[-1])
        opens = np.repeat(np.append(np.tile([False, True], len(sizes)), False), steps)
        tree = Parentheses(opens)

        # Nodes are numbered in preorder: the rank of their opening parenthesis.
        n = int(fresh.sum())
        at = np.flatnonzero(opens)
        node_depth, made = depth[fresh], np.cumsum(fresh)
        by_depth = np.sort(node_depth * n + np.arange(n))

        def latest(wanted_depth: np.ndarray, until: np.ndarray) -> np.ndarray:
            """The last node of a depth among nodes up to ``until``."""
            return by_depth[np.searchsorted(by_depth, wanted_depth * n + until, side="right") - 1] % n

        node = latest(depth, made[starts + sizes - 1][sequence] - 1)  # of each element
        parent = latest(np.maximum(node_depth - 1, 0), np.arange(n))
        below = np.arange(n) > 0  # all but the root

        own = {k: np.zeros(n, np.int64) for k in ("n", "leaves", "saved", "children")}
        for name, values in own.items():
            np.add.at(values, node, self.own[name])
        least = np.full(n, _NOBODY)
        np.minimum.at(least, node, self.own["least"])
        ends = np.full(n, None, object)
        ending = np.flatnonzero(self.ends != None)  # noqa: E711
        ends[node[ending]] = self.ends[ending]
        chars = self.chars[fresh]

        stop = tree.close(at)
        after = np.arange(n) + (stop - at + 1) // 2  # preorder number behind the subtree

        def subtree(values: np.ndarray) -> np.ndarray:
            total = np.append(0, np.cumsum(values))
            return total[after] - total[:n]

        spine = np.zeros(n, bool)
        if not last:
            spine[node[: sizes[0]]] = spine[node[starts[-1] :]] = True
        members = subtree(own["n"])
        children = own["children"] + np.bincount(parent[below], minlength=n)
        pairs = np.append(0, np.cumsum(opens[:-1] & ~opens[1:] & self._childless(opens, own["children"])))
        leaves = pairs[stop] - pairs[at] + subtree(own["leaves"])
        saved = subtree(own["saved"] + np.where(spine, 0, (members - 1) * chars))
        smallest = self._smallest(least, node_depth, parent)

        done = ~spine
        first = np.flatnonzero(fresh)
        nodes = {
            "conv_id": smallest[done], "depth": node_depth[done], "n_convs": members[done], "n_children": children[done],
            "n_leaves": leaves[done], "saved_tokens": saved[done], "ends": ends[done],
            "parent_conv_id": np.where(spine[parent] | ~below, -1, smallest[parent])[done],
            "known_parent": (below & ~spine[parent])[done],
        }
        keys = self.keys if self.keys is not None else np.full(len(sequence), None, object)
        nodes["key"] = keys[first][done]
        paths, spine_keys = self._paths(spine, node, starts)
        nodes["parent_key"] = np.where(below, spine_keys[parent], None)[done]
        if last:
            return nodes, []
        # What hangs below the spine, summed into the spine node that holds it.
        hanging = np.flatnonzero(done & spine[parent])
        at_spine = parent[hanging]
        for name, values in (("n", members), ("leaves", leaves), ("saved", saved), ("children", np.ones(n, np.int64))):
            np.add.at(own[name], at_spine, values[hanging])
        np.minimum.at(least, at_spine, smallest[hanging])
        rows, taken = [], np.zeros(n, bool)
        for path in paths:
            numbers = node[path]
            new = ~taken[numbers]
            taken[numbers] = True
            row = {"seq": [self.digests[e].tobytes() for e in path[1:]], "chars": chars[numbers][1:].tolist()}
            row |= {k: np.where(new, v[numbers], 0).tolist() for k, v in own.items()}
            row["least"] = np.where(new, least[numbers], _NOBODY).tolist()
            row["ends"] = [e if f else None for e, f in zip(ends[numbers], new, strict=True)]
            rows.append(row)
        return nodes, rows

    @staticmethod
    def _childless(opens: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Per parenthesis but the last: is it the opening one of a node without children elsewhere?"""
        flags = np.zeros(len(opens), bool)
        flags[np.flatnonzero(opens)] = known == 0
        return flags[:-1]

    @staticmethod
    def _smallest(least: np.ndarray, depth: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """The smallest member in each subtree, from the deepest nodes up."""
        out = least.copy()
        order = np.argsort(-depth, kind="stable")
        for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)[:-1]:
            np.minimum.at(out, parent[level], out[level])
        return out

    def _paths(self, spine: np.ndarray, node: np.ndarray, starts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The spine's paths (elements of the first and of the last sequence) and its nodes' keys; others have none."""
        keys = np.full(len(spine), None, object)
        if not spine.any():
            return [], keys
        paths = [np.arange(starts[0], starts[0] + self.sizes[0])]
        if len(starts) > 1:
            paths.append(np.arange(starts[-1], starts[-1] + self.sizes[-1]))
        for path in paths:
            keys[node[path]] = path_keys([self.digests[e].tobytes() for e in path[1:]])
        return paths, keys


def path_keys(digests: list[bytes]) -> list[str]:
    """A key for the root and for each prefix of a path."""
    keys = [hashlib.blake2b(b"", digest_size=_DIGEST).hexdigest()]
    for digest in digests:
        keys.append(hashlib.blake2b(bytes.fromhex(keys[-1]) + digest, digest_size=_DIGEST).hexdigest())
    return keys


_NODES = (
    "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
    "parent_conv_id long, known_parent boolean, key string, parent_key string"
)
_PATHS = (
    "seq array<binary>, chars array<long>, n array<long>, leaves array<long>, saved array<long>, children array<long>, "
    "least array<long>, ends array<string>"
)
_OWN = ("n", "leaves", "saved", "children", "least")


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _shard(batch: pa.Table, first_level: bool) -> Shard:
    column = {name: batch.column(name).combine_chunks() for name in batch.column_names}
    turns = np.diff(column["seq"].offsets.to_numpy()).astype(np.int64)
    sizes = turns + 1
    starts = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    is_turn = np.ones(total, bool)
    is_turn[starts] = False
    digests, chars = np.zeros((total, 2), np.uint64), np.zeros(total, np.int64)
    packed = b"".join(column["seq"].flatten().to_pylist())
    digests[is_turn] = np.frombuffer(packed, np.uint64).reshape(-1, 2)
    chars[is_turn] = _flat(column["chars"])
    if first_level:  # one member digest per sequence, at its last element
        own = {k: np.zeros(total, np.int64) for k in _OWN[:-1]} | {"least": np.full(total, _NOBODY)}
        stops = starts + sizes - 1
        own["n"][stops] = column["members"].to_numpy()
        own["least"][stops] = column["smallest"].to_numpy()
        # A node without children here and elsewhere is found as a pair; nothing is known in advance.
        ends = np.full(total, None, object)
        ends[stops] = column["ends"].to_pylist()
        return Shard(sizes, digests, chars, own, ends, None)
    own = {k: _flat(column[k]) for k in _OWN}
    ends = np.array([*column["ends"].flatten().to_pylist(), None], object)[:-1]
    keys = np.array([k for seq in column["seq"].to_pylist() for k in path_keys(seq)] + [None], object)[:-1]
    return Shard(sizes, digests, chars, own, ends, keys)


def _solve(rows: DataFrame, first_level: bool, last: bool) -> DataFrame:
    """Finished nodes (``node``) and spine paths (``path``) of sorted rows."""

    def flush(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        nodes, paths = _shard(pa.Table.from_batches(tables), first_level).solve(last)
        m = len(nodes["conv_id"])
        known = nodes["known_parent"]
        columns = []
        for field in _NODES.split(", "):
            name, kind = field.split(" ")
            values = nodes[name]
            if name == "parent_conv_id":
                columns.append(pa.array(values, pa.int64(), mask=~known))
            elif kind == "string":
                columns.append(pa.array(values.tolist(), pa.string()))
            else:
                columns.append(pa.array(values))
        names = [f.split(" ")[0] for f in _NODES.split(", ")]
        node = pa.StructArray.from_arrays(columns, names)
        kinds = {"binary": pa.binary(), "string": pa.string(), "long": pa.int64()}
        fields = [(f.split(" ")[0], pa.list_(kinds[f.split("<")[1][:-1]])) for f in _PATHS.split(", ")]
        path = pa.array(paths, pa.struct(fields))
        node = pa.concat_arrays([node, pa.nulls(len(paths), node.type)])
        path = pa.concat_arrays([pa.nulls(m, path.type), path])
        return pa.RecordBatch.from_arrays([node, path], ["node", "path"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        turns = count = 0
        for batch in batches:
            sizes = np.diff(batch.column(batch.schema.get_field_index("seq")).offsets.to_numpy())
            at = 0
            while at < len(sizes):
                ends = turns + np.cumsum(sizes[at:])
                full = np.flatnonzero((ends >= SHARD_TURNS) & (count + 1 + np.arange(len(ends)) >= LEAST_ROWS)) if not last else []
                stop = at + int(full[0]) + 1 if len(full) else len(sizes)
                held.append(batch.slice(at, stop - at))
                turns, count, at = int(ends[stop - at - 1]), count + stop - at, stop
                if len(full):
                    yield flush(held)
                    held, turns, count = [], 0, 0
        if held:
            yield flush(held)

    return rows.mapInArrow(scan, f"node struct<{_typed(_NODES)}>, path struct<{_typed(_PATHS)}>")


def _typed(columns: str) -> str:
    return ", ".join(c.replace(" ", ": ", 1) for c in columns.split(", "))


def rebuilt(conversations: DataFrame, columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    """Per conversation its rebuilt sequence: conv_id, seq (digests of turns), chars (code points of their texts)."""
    ident, turn, role, text = columns
    speaker, words = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(speaker).cast("string"), F.lit(":"), speaker, words)
    turns = conversations.where(F.col(ident).isNotNull()).select(
        F.col(ident).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        speaker.alias("role"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, _DIGEST).alias("digest"),
        F.char_length(words).cast("long").alias("chars"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "chars")))
    own = materialize(turns.groupBy("conv_id").agg(ordered.alias("turns")), "conversations")
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    family = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    heads = own.where(F.col("conv_id") % FAMILY == 0)
    heads = heads.select(F.col("conv_id").alias("family"), F.slice("turns", 1, SHARED - 1).alias("head"))
    joined = own.withColumn("h", (crc % SHARED).cast("int")).withColumn("family", family).join(heads, "family", "left")
    none = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    both = joined.select("conv_id", F.concat(head, rest).alias("turns"))
    return both.select("conv_id", F.col("turns.digest").alias("seq"), F.col("turns.chars").alias("chars"))


def _ends(members: DataFrame) -> DataFrame:
    """Per class (column class) the digest of its ascending member ids, hashed chunk by chunk.

    Ids are joined into chunks wherever they lie in the sorted order, so that a class of
    very many members comes to its hashing task as few rows.
    """

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size = None, 0, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([first]), pa.array([",".join(ids)])], ["class", "first", "ids"])

        for batch in batches:
            for own, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (own != key or size > CHUNK):
                    yield out()
                    ids, size = [], 0
                if not ids:
                    key, first = own, conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, found = [], []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if own != key:
                    if state is not None:
                        keys.append(key)
                        found.append(state.hexdigest())
                    key, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], ["class", "ends"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["class", "ends"])

    ordered = members.select("class", "conv_id").repartitionByRange("class", "conv_id").sortWithinPartitions("class", "conv_id")
    chunks = ordered.mapInArrow(chunk, "class binary, first long, ids string")
    return chunks.repartition("class").sortWithinPartitions("class", "first").mapInArrow(digest, "class binary, ends string")


def _class(seq: Column) -> Column:
    """A digest of a whole sequence."""
    return F.unhex(F.sha2(F.concat_ws("", F.transform(seq, F.hex)), 256))


def prefix_trie(conversations: DataFrame, columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations, one row each (runs jobs).

    Returns conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.  ``columns`` names id, turn, role and text.

    Turns are ordered by turn, null first; rows of the same turn by role, then by a digest
    of role and text.  Repeated rows are turns of their own.  Null roles and texts count as
    empty.  Rows without a conversation id belong to no conversation and are left out.  A
    conversation whose rebuilt sequence is empty is a member of the root only.  Other
    columns are not read; an empty table gives no rows.  Negative ids fall into families like
    others (-5 into -100).

    A row of this operator holds a conversation's digests, 24 bytes a turn; texts are
    digested in the scan.  Conversations that are equal as a whole are one row and a count.
    """
    spark = conversations.sparkSession
    built = materialize(rebuilt(conversations, columns).withColumn("class", _class(F.col("seq"))), "rebuilt")
    counted = built.groupBy("class").agg(
        F.count("*").alias("members"), F.min("conv_id").alias("smallest"), F.min_by(F.struct("seq", "chars"), "conv_id").alias("s")
    )
    classes = counted.join(_ends(built), "class").select("s.seq", "s.chars", "members", "smallest", "ends")
    rows = classes.repartitionByRange("seq").sortWithinPartitions("seq")
    solved = materialize(_solve(rows, True, False), "trie")
    levels = [solved.where("node is not null").select("node.*")]
    while True:
        paths = solved.where("path is not null").select("path.*")
        turns, count = paths.agg(F.coalesce(F.sum(F.size("seq")), F.lit(0)), F.count("*")).first()
        if not count:
            break
        parts = min(-(-turns // SHARD_TURNS), -(-count // LEAST_ROWS))
        # The paths of the last level are few: SHARD_TURNS turns, or LEAST_ROWS sequences.
        spread = paths.repartitionByRange(parts, "seq") if parts > 1 else paths.coalesce(1)
        solved = materialize(_solve(spread.sortWithinPartitions("seq"), False, parts <= 1), "trie")
        levels.append(solved.where("node is not null").select("node.*"))
    if len(levels) == 1:  # no conversation at all
        return spark.createDataFrame([], _RESULT)
    keyed = levels[1]
    for level in levels[2:]:
        keyed = keyed.unionByName(level)
    names = keyed.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("named"))
    nodes = levels[0].unionByName(keyed)
    joined = nodes.join(names, "parent_key", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "named").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"),
    )


_RESULT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)

"""A trie of conversations in double arrays per prefix shard; nodes above the shards are merged over all of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.sources.sinks import staged

FAMILY = 5
HEADS = 9
# Turns of one prefix shard; prefixes that more turns share are cut deeper.
LARGEST = 1 << 11
# Turns of the shards that share one pair of arrays.
PACKED = 1 << 16
CHUNK_BITS = 12
EMPTY_HASH = hashlib.sha256(b"").hexdigest()
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, prefix string"
)


def _digest(text: Column) -> Column:
    return F.left(F.sha2(text.cast("binary"), 256), F.lit(32))


def _prefix(depth: Column) -> Column:
    """Identity of the first ``depth`` turns, from the digests of the turns."""
    return _digest(F.array_join(F.slice("digests", F.lit(1), depth), ""))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and turns in order, each as a digest of role and text and its octets.

    Ordered by turn, null first; turns of one number by digest. Texts do not leave the scan.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct("turn", _digest(said).alias("digest"), F.octet_length(text).cast("long").alias("octets"))
    return (
        conversations.where(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every conversation with its first turns replaced by those of its family's first one: conv_id, digests, octets.

    The number replaced is the crc32 of the decimal id modulo HEADS; the family's first conversation
    has the largest multiple of FAMILY up to the id (towards zero for negative ids).
    """
    own = ordered_turns(conversations)
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("first_id"), F.slice("turns", 1, HEADS - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.size("turns"))
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("first_id"), "left")
    turns = joined.select("conv_id", F.concat(head, rest).alias("turns"))
    return turns.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.octets").alias("octets"))


def _hash_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows():
        for batch in batches:
            yield from zip(batch["sequence"], batch["members"], batch["first"], batch["ids"])

    out: list[tuple] = []
    for sequence, chunks in groupby(rows(), key=itemgetter(0)):
        total, least, state = 0, None, hashlib.sha256()
        for _, members, first, ids in chunks:
            state.update(("," * (total > 0) + ids).encode())
            total, least = total + members, first if least is None else least
        out.append((sequence, total, least, state.hexdigest()))
        if len(out) >= 10_000:
            yield pd.DataFrame(out, columns=["sequence", "n", "conv_id", "ends"])
            out = []
    yield pd.DataFrame(out, columns=["sequence", "n", "conv_id", "ends"])


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """Equal conversations as one row: sequence, conv_id (smallest), n, ends (hash of all their ids), digests, octets.

    Turns combine before the shuffle. Ids are joined in chunks of neighbouring ids, and one hash
    runs over the chunks of a sequence in order, so a conversation that a third of all repeat costs
    its task one row per 4,096 ids and no memory.
    """
    keyed = staged(convs.withColumn("sequence", _prefix(F.size("digests"))), "trie-conversations")
    chunks = keyed.groupBy("sequence", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.count("*").alias("members"), F.min("conv_id").alias("first"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )
    hashed = chunks.repartition("sequence").sortWithinPartitions("sequence", "chunk").mapInPandas(
        _hash_members, "sequence string, n long, conv_id long, ends string"
    )
    turns = keyed.groupBy("sequence").agg(F.any_value("digests").alias("digests"), F.any_value("octets").alias("octets"))
    return hashed.join(turns, "sequence")


def cut_at_prefixes(sequences: DataFrame, largest: int = LARGEST) -> DataFrame:
    """Add the shard of every sequence: cut (depth) and prefix (identity of its first turns), null if it ends above.

    Sequences that share their first turn make one shard, unless they hold more than ``largest``
    turns; then those that share 2, 4, 8 ... turns do. At last a sequence is alone.
    """
    length, depth, parts = F.size("digests"), 1, []
    rows = sequences
    while True:
        rows = rows.withColumn("cut", F.lit(depth)).withColumn("prefix", F.when(length >= depth, _prefix(F.lit(depth))))
        sizes = rows.where(F.col("prefix").isNotNull()).groupBy("prefix").agg(F.sum(length).alias("turns"), F.count("*").alias("rows"))
        hot = staged(sizes.where((F.col("turns") > largest) & (F.col("rows") > 1)).select("prefix"), "trie-hot")
        if hot.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(hot, "prefix", "left_anti"))
        rows = rows.join(hot, "prefix", "left_semi").select(*sequences.columns)
        depth *= 2
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together


class Sequence(NamedTuple):
    prefix: str
    cut: int
    conv_id: int
    n: int
    ends: str
    digests: np.ndarray
    octets: np.ndarray


class DoubleArray:
    """A trie over dense symbols: the child of state s by symbol c is t = BASE[s] + c if CHECK[t] = s.

    Built level by level. States with several children take the first base at which all their slots
    are free; states with one child fill the free slots that are left. State 0 is the root.
    """

    def __init__(self, symbols: np.ndarray, starts: np.ndarray):
        self.symbols, self.starts = symbols, starts
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, -1, np.int64)
        self.check[0] = 0
        self._lowest = 1
        self.levels: list[np.ndarray] = []
        lengths = np.diff(starts)
        states = np.zeros(len(lengths), np.int64)
        active = np.flatnonzero(lengths > 0)
        width = int(symbols.max()) + 1 if len(symbols) else 1
        while len(active):
            symbol = symbols[starts[active] + len(self.levels)]
            pairs, member = np.unique(states[active] * width + symbol, return_inverse=True)
            slots = self._place(pairs // width, pairs % width)
            self.levels.append(slots)
            states[active] = slots[member]
            active = active[lengths[active] > len(self.levels)]
        kept = int(np.flatnonzero(self.check >= 0)[-1]) + 1
        self.check, self.base = self.check[:kept], self.base[:kept]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])

    def _fit(self, shape: np.ndarray) -> np.ndarray:
        """The lowest slots in the given ``shape`` (offsets from the first) that are all free."""
        begin, step = self._lowest, max(1, min(1 << 12, (1 << 20) // len(shape)))
        while True:
            self._grow(begin + step + int(shape[-1]) + 1)
            free = begin + np.flatnonzero(self.check[begin : begin + step] < 0)
            fits = (self.check[free[:, None] + shape] < 0).all(axis=1)
            if fits.any():
                return free[fits.argmax()] + shape
            begin += step

    def _place(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Slots for the children (parent, symbol), sorted by both."""
        slots = np.empty(len(parents), np.int64)
        begins = np.flatnonzero(np.diff(parents, prepend=-1))
        counts = np.diff(begins, append=len(parents))
        for begin, count in zip(begins[counts > 1].tolist(), counts[counts > 1].tolist()):
            children = symbols[begin : begin + count]
            taken = self._fit(children - children[0])
            slots[begin : begin + count] = taken
            self._take(taken, parents[begin : begin + count], children)
        alone = begins[counts == 1]
        self._grow(len(self.check) + len(alone) - int((self.check[self._lowest :] < 0).sum()))
        taken = (self._lowest + np.flatnonzero(self.check[self._lowest :] < 0))[: len(alone)]
        slots[alone] = taken
        self._take(taken, parents[alone], symbols[alone])
        return slots

    def _take(self, slots: np.ndarray, parents: np.ndarray, symbols: np.ndarray) -> None:
        self.check[slots] = parents
        self.base[parents] = slots - symbols
        while self.check[self._lowest] >= 0:
            taken = self.check[self._lowest : self._lowest + 256] >= 0
            self._lowest += len(taken) if taken.all() else int(taken.argmin())
            self._grow(self._lowest + 1)

    def walk(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Level by level: the sequences that reach it and the state each stands in."""
        lengths = np.diff(self.starts)
        states = np.zeros(len(lengths), np.int64)
        active, level = np.flatnonzero(lengths > 0), 0
        while len(active):
            before = states[active]
            after = self.base[before] + self.symbols[self.starts[active] + level]
            if not (self.check[after] == before).all():
                raise AssertionError("a sequence leaves the trie")
            states[active] = after
            yield active, after
            level += 1
            active = active[lengths[active] > level]


def trie_nodes(rows: list[Sequence]) -> pd.DataFrame:
    """All nodes at or below the cuts of whole shards, as NODE; those at a cut carry their prefix."""
    shards = {prefix: k for k, prefix in enumerate(dict.fromkeys(r.prefix for r in rows))}
    cuts = np.array([r.cut for r in rows], np.int64)
    # Symbols: the shard's prefix, then the turns after the cut, as dense numbers within these arrays.
    after = [r.digests[r.cut :] for r in rows]
    lengths = np.array([len(a) + 1 for a in after], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    symbols = np.empty(int(starts[-1]), np.int64)
    first = np.zeros(len(symbols), bool)
    first[starts[:-1]] = True
    symbols[first] = [shards[r.prefix] for r in rows]
    # Numbered as they first come, so that turns that follow the same one have near numbers.
    _, where, number = np.unique(np.concatenate(after), return_index=True, return_inverse=True)
    symbols[~first] = np.argsort(np.argsort(where))[number]
    octets = np.concatenate([r.octets[r.cut - 1 :] for r in rows])
    trie = DoubleArray(symbols, starts)

    size = len(trie.check)
    conv_id = np.array([r.conv_id for r in rows], np.int64)
    n = np.array([r.n for r in rows], np.int64)
    least, members = np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64)
    depth, last, ends = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, EMPTY_HASH, object)
    for level, (active, state) in enumerate(trie.walk()):
        np.minimum.at(least, state, conv_id[active])
        np.add.at(members, state, n[active])
        depth[state] = cuts[active] + level
        last[state] = octets[starts[active] + level]
        done = lengths[active] == level + 1
        ends[state[done]] = [rows[k].ends for k in active[done]]
    children = np.bincount(trie.check[np.concatenate(trie.levels)], minlength=size)
    leaves, saved = (children == 0).astype(np.int64), (members - 1) * last
    for slots in reversed(trie.levels[1:]):
        np.add.at(leaves, trie.check[slots], leaves[slots])
        np.add.at(saved, trie.check[slots], saved[slots])
    nodes = np.concatenate(trie.levels)
    top = len(trie.levels[0])
    prefix = np.full(len(nodes), None, object)
    names = list(shards)
    prefix[:top] = [names[k] for k in trie.levels[0] - trie.base[0]]
    parent = pd.array(least[trie.check[nodes]], dtype="Int64")
    parent[:top] = pd.NA
    return pd.DataFrame({
        "conv_id": least[nodes], "depth": depth[nodes], "parent_conv_id": parent, "n_convs": members[nodes],
        "n_children": children[nodes], "n_leaves": leaves[nodes], "saved_tokens": saved[nodes],
        "ends_sha256": ends[nodes], "prefix": prefix,
    })


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[Sequence]:
    for batch in batches:
        if not batch.num_rows:
            continue
        plain = [batch.column(c).to_pylist() for c in ("prefix", "cut", "conv_id", "n", "ends")]
        digests = np.array(batch.column("digests").flatten().to_pylist(), dtype="S32")
        octets = batch.column("octets").flatten().to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(batch.column("digests").value_lengths().to_numpy())]).tolist()
        for k, row in enumerate(zip(*plain)):
            yield Sequence(*row, digests[bounds[k] : bounds[k + 1]], octets[bounds[k] : bounds[k + 1]])


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[Sequence] = []
    turns = 0
    for _, shard in groupby(_sequences(batches), key=itemgetter(0)):
        if turns >= PACKED:
            yield pa.RecordBatch.from_pandas(trie_nodes(rows), preserve_index=False)
            rows, turns = [], 0
        members = list(shard)
        rows += members
        turns += sum(len(m.digests) for m in members)
    if rows:
        yield pa.RecordBatch.from_pandas(trie_nodes(rows), preserve_index=False)


def shard_nodes(cut: DataFrame) -> DataFrame:
    """Nodes at or below the cuts, whole subtrees each."""
    rows = cut.where(F.col("prefix").isNotNull()).select("prefix", "cut", "conv_id", "n", "ends", "digests", "octets")
    return rows.repartition("prefix").sortWithinPartitions("prefix", "conv_id").mapInArrow(_tries, NODE)


def upper_nodes(cut: DataFrame, shard_tops: DataFrame) -> DataFrame:
    """Nodes above the cuts with their subtrees' sums: id, parent, and the columns of NODE without parent's conv_id.

    Each cut node, and each sequence that ends above its cut, adds to all nodes on its path; sums
    combine before their shuffle, so the root is no hot key. What upper nodes save and their
    leaves are known once members and children are, and are added along the same paths.
    """
    chains = cut.where(F.col("prefix").isNotNull()).groupBy("prefix").agg(
        F.any_value(F.struct(F.slice("digests", F.lit(1), F.col("cut") - 1).alias("digests"), F.slice("octets", F.lit(1), F.col("cut") - 1).alias("octets"))).alias("path")
    )
    below = shard_tops.select("prefix", "conv_id", "n_convs", "n_leaves", "saved_tokens").join(chains, "prefix").select(
        "path.*", "conv_id", "n_convs", "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends")
    )
    zero = F.lit(0).cast("long")
    ended = cut.where(F.col("prefix").isNull()).select(
        "digests", "octets", "conv_id", F.col("n").alias("n_convs"), zero.alias("n_leaves"), zero.alias("saved_tokens"), "ends"
    )
    along = F.explode(F.sequence(F.lit(0), F.size("digests"))).alias("depth")
    steps = below.unionByName(ended).select("*", along)
    depth, length = F.col("depth"), F.size("digests")
    path = F.transform(F.sequence(F.lit(0), depth), lambda d: _prefix(d))
    merged = staged(
        steps.select(
            _prefix(depth).alias("id"), "depth", "conv_id", "n_convs", "n_leaves", "saved_tokens",
            F.when(depth > 0, F.try_element_at("octets", depth)).alias("last"), path.alias("path"),
            F.when(depth == length, F.col("ends")).alias("ends"),
            (F.col("ends").isNull() & (depth == length)).cast("long").alias("cut_children"),
        )
        .groupBy("id")
        .agg(
            F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("last").alias("last"),
            F.any_value("path").alias("path"), F.max("ends").alias("ends"), F.sum("cut_children").alias("cut_children"),
        )
        .withColumn("parent", F.when(F.col("depth") > 0, F.try_element_at("path", F.col("depth")))),
        "trie-upper",
    )
    counted = merged.where(F.col("parent").isNotNull()).groupBy("parent").agg(F.count("*").alias("upper_children"))
    known = merged.join(counted.withColumnRenamed("parent", "id"), "id", "left").withColumn(
        "n_children", F.col("cut_children") + F.coalesce("upper_children", F.lit(0))
    )
    own = known.select(
        F.explode("path").alias("id"), (F.col("n_children") == 0).cast("long").alias("own_leaves"),
        ((F.col("n_convs") - 1) * F.coalesce("last", zero)).alias("own_saved"),
    ).groupBy("id").agg(F.sum("own_leaves").alias("own_leaves"), F.sum("own_saved").alias("own_saved"))
    return known.join(own, "id").select(
        "id", "parent", "conv_id", F.col("depth").cast("long").alias("depth"), "n_convs", "n_children",
        (F.col("n_leaves") + F.col("own_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("own_saved")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY_HASH)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, largest: int = LARGEST) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Rows without conv_id are no conversation; null roles and texts are empty; turns with equal
    numbers come in order of a digest, repeated rows are turns of their own; other columns are not
    read. An empty table has no node. A conversation's digests, 32 characters a turn, are one row;
    no task holds all conversations of a node.
    """
    cut = staged(cut_at_prefixes(staged(distinct_sequences(rebuilt(conversations)), "trie-sequences"), largest), "trie-cut")
    lower = staged(shard_nodes(cut), "trie-nodes")
    tops = lower.where(F.col("prefix").isNotNull())
    upper = staged(upper_nodes(cut, tops), "trie-top")
    names = upper.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # The node above a cut is the path's last one.
    above = cut.where(F.col("prefix").isNotNull()).groupBy("prefix").agg(F.any_value(_prefix(F.col("cut") - 1)).alias("parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return (
        lower.where(F.col("prefix").isNull()).select(*columns)
        .unionByName(tops.drop("parent_conv_id").join(above, "prefix").join(names, "parent").select(*columns))
        .unionByName(upper.join(names, "parent", "left").select(*columns))
    )

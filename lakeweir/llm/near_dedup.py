"""Near-duplicates: an inverted join over MinHash signature coordinates, links confirmed on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import U, grams_of, map_frames, mix, plain, text_pieces, words_of
from lakeweir.sources.sinks import staged

FEW = 128  # rows at once, as two full sets of the longest texts stand in each row of a check
SHINGLE = 5
SIMILARITY = 75  # per cent of the union
COORDINATES = 64
MATCHES = 32  # equal coordinates of a candidate pair; 48 are expected at the least similarity
PREFIX = COORDINATES - MATCHES + 1  # two rows with MATCHES equal ones share one among so many

_dice = np.random.default_rng(42)
FACTORS = _dice.integers(1, 1 << 63, COORDINATES, dtype=np.int64).astype(U) * U(2) + U(1)
TERMS = _dice.integers(0, 1 << 63, COORDINATES, dtype=np.int64).astype(U)


def shingles_of(words: np.ndarray) -> np.ndarray:
    """The distinct shingles of one text, sorted; fewer words than SHINGLE are one shingle."""
    if len(words) < SHINGLE:
        return np.unique(mix(grams_of(words, len(words)) + U(len(words)))) if len(words) else words
    return np.unique(grams_of(words, SHINGLE))


def shingle_sets(texts) -> Iterator[np.ndarray]:
    for begin, end in text_pieces(texts):
        words = words_of(texts[begin:end])
        for k in range(end - begin):
            yield shingles_of(words.of(k))


def set_key(shingles: np.ndarray) -> bytes:
    """Digest of a whole set, to find equal sets."""
    return hashlib.sha256(shingles.tobytes()).digest()[:16]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest hash of each set's shingles under every function: [sets, COORDINATES], 32 bits each."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *(len(s) for s in sets)])[:-1]
    out = np.empty((len(sets), COORDINATES), dtype=np.uint32)
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat(((flat * FACTORS[k] + TERMS[k]) >> U(32)).astype(np.uint32), starts)
    return out


def described(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, key of the set and signature; the last two are null without words."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), plain(batch["text"])
            for begin, end in text_pieces(texts):
                sets = list(shingle_sets(texts[begin:end]))
                full = [k for k, s in enumerate(sets) if len(s)]
                keys, signs = [None] * len(sets), [None] * len(sets)
                if full:
                    for k, row in zip(full, signatures([sets[k] for k in full]).view(np.int32)):
                        keys[k], signs[k] = set_key(sets[k]), row
                yield pd.DataFrame({
                    "doc_id": pd.array([None if pd.isna(i) else i for i in ids[begin:end]], dtype="Int64"),
                    "n_shingles": [len(s) for s in sets], "key": keys, "signature": signs,
                })

    return map_frames(
        docs.select("doc_id", "text"), describe, "doc_id long, n_shingles long, key binary, signature array<int>", FEW
    )


def prefix_postings(nodes: DataFrame) -> DataFrame:
    """node, n, weight, token for the rarest coordinate values of each node that others share.

    A token is a coordinate with its value. In the order of frequency, a node's PREFIX rarest tokens
    are enough to meet every node with MATCHES equal ones. Values that nobody shares come first in
    that order and use up the prefix, so most nodes post nothing, and a passage shared by very many
    texts, whose values are the most frequent, is posted only where it makes up most of a text.
    ``weight`` sums the frequencies of all tokens: the node of a group that has most in common with the
    others has the largest one.
    """
    posted = nodes.select("node", "n", F.posexplode("signature").alias("place", "value")).select(
        "node", "n",
        F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(0xFFFFFFFF))
        .alias("token"),
    )
    shared = posted.groupBy("token").agg(F.count("*").alias("times")).where("times > 1")
    ordered = posted.join(shared, "token").groupBy("node").agg(
        F.first("n").alias("n"), F.sum("times").alias("weight"),
        F.sort_array(F.collect_list(F.struct("times", "token"))).alias("tokens"),
    )
    spare = F.greatest(F.lit(0), F.lit(PREFIX - COORDINATES) + F.size("tokens"))
    kept = ordered.withColumn("tokens", F.slice("tokens", F.lit(1), spare))
    return kept.select("node", "n", "weight", F.explode("tokens.token").alias("token"))


def similar_sizes(a: str, b: str):
    """No pair further apart in size can be similar enough."""
    return F.least(F.col(a), F.col(b)) * 100 >= F.greatest(F.col(a), F.col(b)) * SIMILARITY


def matching(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures have at least MATCHES equal coordinates."""
    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sign_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sign_b"))
    equal = F.size(F.filter(F.zip_with("sign_a", "sign_b", lambda x, y: x == y), lambda same: same))
    return pairs.join(left, "a").join(right, "b").where(equal >= MATCHES).select("a", "b")


def sets_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node and its full shingle set for the ``wanted`` nodes, made again from the texts and written out."""
    named = nodes.join(wanted.select("node").distinct(), "node").select("node", "key", "rep")
    texts = docs.select("doc_id", "text").join(named, F.col("doc_id") == F.col("rep")).select("node", "key", "text")

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(shingle_sets(plain(batch["text"])))
            own = [set_key(s) == bytes(k) for s, k in zip(found, batch["key"])]
            yield pd.DataFrame({
                "node": batch["node"][own], "shingles": [s.tobytes() for s, mine in zip(found, own) if mine],
            })

    return staged(map_frames(texts, make, "node long, shingles binary", FEW).dropDuplicates(["node"]), "near-sets")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The candidate pairs whose full shingle sets are similar enough."""

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for x, y in zip(batch["set_a"], batch["set_b"]):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * both >= SIMILARITY * (len(x) + len(y) - both))
            yield batch[["a", "b"]][np.array(out, dtype=bool)]

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    return map_frames(pairs.join(left, "a").join(right, "b"), linked, "a long, b long", FEW)


def components(links: DataFrame) -> DataFrame:
    """node and label for every node of the links: nodes that are connected get one label.

    Each round every node moves to the neighbour, or itself, that comes first in a random order,
    and links move with their ends; connected nodes stay connected and their number shrinks by a
    constant factor. Rounds are written to the shared folder, which cuts the lineage.
    """
    edges = staged(links.where("a != b").distinct(), "near-links")
    labels = None
    for turn in count():
        if edges.isEmpty():
            break
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c, turn=turn: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("v"))
        moves = both.groupBy(F.col("a").alias("from")).agg(F.least(F.min(order("b")), F.min(order("a"))).v.alias("to"))
        moves = staged(moves, "near-moves")
        if labels is None:
            labels = moves.select(F.col("from").alias("node"), F.col("to").alias("label"))
        else:
            moved = labels.join(moves, F.col("label") == F.col("from"), "left")
            labels = staged(moved.select("node", F.coalesce("to", "label").alias("label")), "near-labels")
        first = moves.select(F.col("from").alias("a"), F.col("to").alias("to_a"))
        second = moves.select(F.col("from").alias("b"), F.col("to").alias("to_b"))
        edges = edges.join(first, "a").join(second, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        edges = staged(edges.where("a != b").distinct(), "near-links")
    return links.sparkSession.createDataFrame([], "node long, label long") if labels is None else labels


def leader_pairs(postings: DataFrame) -> DataFrame:
    """Each node with the leader of each of its posting lists: the node of the largest weight."""
    leaders = postings.groupBy("token").agg(F.max(F.struct("weight", "node", "n")).alias("first"))
    met = postings.join(leaders, "token").where("node != first.node")
    met = met.select(F.col("first.node").alias("a"), F.col("first.n").alias("n_a"), F.col("node").alias("b"), "n")
    return met.where(similar_sizes("n_a", "n")).select("a", "b").distinct()


def open_nodes(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """node, n, label of the nodes in posting lists that, without their leader, are not all connected."""
    leaders = postings.groupBy("token").agg(F.max(F.struct("weight", "node", "n")).alias("first"))
    rest = postings.join(leaders, "token").where("node != first.node").join(labels, "node", "left")
    rest = rest.select("token", "node", "n", F.coalesce("label", "node").alias("label"))
    several = rest.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return rest.join(several, "token").select("node", "n", "label").distinct()


def shingle_pairs(found: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of nodes, not connected yet, that share one of their rarest shingles.

    With shingles in the order of their frequency among these nodes, two sets that are similar
    enough share one among the first n - least intersection + 1 of each. A text with many shingles of
    its own has used up its part before it comes to shared ones; it meets nobody, however many
    texts share its other passages. Where two sets first agree, what follows in both has to be
    enough for the intersection that their sizes ask for.
    """

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, data in zip(batch["node"], batch["shingles"]):
                yield pd.DataFrame({"node": node, "shingle": np.frombuffer(data, np.int64)})

    every = staged(map_frames(sets, spread, "node long, shingle long", FEW), "near-shingles")
    shared = every.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    ordered = every.join(shared, "shingle").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("tokens")
    ).join(found, "node")
    least = F.ceil(F.col("n") * SIMILARITY / 100).cast("int")
    spare = F.greatest(F.lit(0), F.size("tokens") - least + 1)
    kept = ordered.withColumn("own", F.col("n") - F.size("tokens")).withColumn(
        "tokens", F.slice("tokens", F.lit(1), spare)
    )
    first = kept.select("node", "n", "label", "own", F.posexplode("tokens.shingle").alias("place", "shingle"))
    first = first.withColumn("after", F.col("n") - F.col("own") - F.col("place"))
    several = first.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    first = staged(first.join(several, "shingle").select("shingle", "node", "n", "label", "after"), "near-prefixes")
    pairs = first.alias("x").join(first.alias("y"), "shingle").where("x.node < y.node and x.label != y.label")
    enough = F.least("x.after", "y.after") * (100 + SIMILARITY) >= (F.col("x.n") + F.col("y.n")) * SIMILARITY
    return pairs.where(enough).select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b")
    ).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Rows with equal sets are one node. Nodes that share prefix tokens are first compared with the
    leader of each list, which joins groups of copies of any size with a number of pairs in
    proportion to their rows. Lists that are still not connected go on: of their nodes, those that
    also share a rare shingle are compared, unless they are connected already. A pair counts
    when at least MATCHES coordinates are equal and the full sets are similar enough. At the least
    similarity a pair has too few equal coordinates once in about 200,000 times, more similar ones
    far more rarely.

    Null or empty texts have no shingles and are linked with nothing. A null doc_id is linked with
    nothing, has no component and is kept. Rows that repeat an id are one group: kept holds for
    each of them. An empty table gives an empty result.
    """
    rows = staged(described(docs), "near-rows")
    sets = rows.where("key is not null and doc_id is not null").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")
    )
    nodes = staged(sets.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    postings = staged(prefix_postings(nodes), "near-postings")
    near = staged(matching(leader_pairs(postings), nodes), "near-pairs")
    ends = near.select(F.explode(F.array("a", "b")).alias("node"))
    links = staged(confirmed(near, sets_of(ends, nodes, docs)), "near-linked")
    found = staged(open_nodes(postings, components(links)), "near-open")
    if not found.isEmpty():
        sets = sets_of(found, nodes, docs)
        more = staged(matching(shingle_pairs(found, sets), nodes), "near-pairs")
        links = staged(links.unionAll(confirmed(more, sets)), "near-linked")
    # Equal ids with different sets belong together as well.
    shared = nodes.groupBy("rep").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("a", "b")
    labels = components(links.unionAll(shared))
    smallest = labels.join(nodes, "node").groupBy("label").agg(F.min("rep").alias("smallest"))
    of_node = labels.join(smallest, "label").select("node", "smallest")
    of_key = nodes.join(of_node, "node", "left").select("key", F.coalesce("smallest", "rep").alias("component"))
    return rows.join(of_key, "key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay; null ids all stay, of rows with one id the one whose text
    has the smallest checksum, then hash, so a run again keeps the same one."""
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    body = F.coalesce("text", F.lit(""))
    first = F.min_by(F.struct(*[c for c in docs.columns if c != "doc_id"]), F.struct(F.crc32(body.cast("binary")), F.xxhash64(body)))
    named = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(first.alias("__row")).select("doc_id", "__row.*")
    return named.select(*docs.columns).unionByName(docs.where("doc_id is null"))

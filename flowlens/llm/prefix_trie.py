"""The trie of all conversations' prefixes, by collapsing whole sequences.

Identical conversations are grouped first: a sequence has a weight (how many
conversations it is) and its list of ends.  A sequence whose key occurs among
the proper prefixes of others is dropped by an anti-join; those that stay are
the leaves.  Then each distinct sequence spreads its weight over its prefixes
and the prefixes are added up, so a conversation that a third of all rows
repeat is written out once.

A turn is its SHA-256 (of the role's length, the role and the text); a prefix is
its depth and the exclusive-or of 120 bits that depend on a turn's digest and
place.  Two different prefixes would share a key with a probability of 2^-120.
Texts leave the scan as digests only; ``node_turns`` fetches them for a node.

Every sum over a subtree follows from sums over paths.  A node belongs to the
sequence of its smallest member; along a path a sequence owns the deepest
nodes, so what a node adds to its ancestors is added once, by its owner.

No group grows with the data in one task.  Turns are numbered by ranges of
(conversation, turn) and the ranges' offsets, paths run in pieces of
``PIECE_TURNS`` turns whose totals are added up, equal prefixes are combined
before the shuffle.  A list of ends is made in runs of ``END_IDS`` ids, and one
task streams the runs of a sequence through the hash, which is sequential by
nature; it holds one run at a time.

Cases: a null role or text is empty; a null turn comes first; rows of one
conversation and turn follow in the order of their digests, repeated rows all
count; a row without a conversation id belongs to no conversation; a
conversation of no turns is a member of the root alone; an empty table has no
node, not even a root.  Only the four named columns are read, so other names
cannot clash.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlens.llm.common import reach_workers, written

#: Turns of a path that one window holds.
PIECE_TURNS = 10_000
#: Ids that one run of an end list may hold.
END_IDS = 4_096
#: Most turns that a conversation takes from another (the remainder of its crc32 by one more).
SHARED_TURNS = 5
KEY = ["depth", "x1", "x2"]


def turn_digest(role: str = "role", text: str = "text") -> Column:
    """32 bytes of a turn."""
    role_, text_ = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    return F.unhex(F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_).cast("binary"), 256))


def _before(df: DataFrame, group: str, piece: str, sums: dict[str, Column]) -> DataFrame:
    """(group, piece, totals of the group's earlier pieces) where there are any."""
    totals = df.groupBy(group, piece).agg(*(c.alias(n) for n, c in sums.items()))
    earlier = Window.partitionBy(group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(group, piece, *((F.bit_xor(n) if n.startswith("x") else F.sum(n)).over(earlier).alias(f"{n}_before") for n in sums)
                         ).where(F.col(f"{next(iter(sums))}_before").isNotNull())


# --- turns in order ----------------------------------------------------------------

def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest, size (code points of the text); written.

    Rows are sorted by ranges, so a conversation of very many turns lies in
    several tasks; each numbers its part and adds the turns before it.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_digest().alias("digest"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("size"))
    order = [F.col("turn").asc_nulls_first(), "digest"]
    # range bounds are sampled: keep one outcome
    rows = written(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "turns")
    before = _before(rows, "conv_id", "part", {"n": F.count(F.lit(1))})
    within = Window.partitionBy("conv_id", "part").orderBy(*order)
    return (rows.withColumn("at", F.row_number().over(within)).join(before, ["conv_id", "part"], "left")
            .select("conv_id", (F.col("at") + F.coalesce("n_before", F.lit(0))).cast("long").alias("place"), "digest", "size"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversation ids, turns conv_id, depth, digest, size, from_conv,
    from_place) where a conversation begins with the first turns of its
    hundred's first one and goes on with its own after as many."""
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED_TURNS + 1)).cast("long")
    ids = turns.select("conv_id").distinct().select("conv_id", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % 100).alias("base"))
    # at most 100 conversations by SHARED_TURNS turns a base
    heads = turns.where((F.col("place") <= SHARED_TURNS) & (F.col("conv_id") % 100 == 0)).select(
        F.col("conv_id").alias("base"), "place", "digest", "size")
    given = ids.join(heads, "base").where("place <= h").select(
        "conv_id", "place", "digest", "size", F.col("base").alias("from_conv"), F.col("place").alias("from_place"))
    # a short base leaves a gap before the own turns: h less the turns given
    short = ids.join(heads.groupBy("base").agg(F.max("place").alias("n")), "base", "left").select(
        "conv_id", (F.col("h") - F.least("h", F.coalesce("n", F.lit(0)))).alias("gap")).where("gap > 0")
    own = turns.where(F.col("place") > shared).join(short, "conv_id", "left").select(
        "conv_id", (F.col("place") - F.coalesce("gap", F.lit(0))).alias("depth"), "digest", "size",
        F.col("conv_id").alias("from_conv"), F.col("place").alias("from_place"))
    return ids.select("conv_id"), given.withColumnRenamed("place", "depth").select(own.columns).unionByName(own)


# --- the trie ------------------------------------------------------------------------

def _bits(depth: str = "depth", digest: str = "digest") -> tuple[Column, Column]:
    """Two words of 60 bits that depend on the place and the digest of a turn."""
    h = F.sha2(F.concat(F.col(depth).cast("string").cast("binary"), F.lit(":").cast("binary"), F.col(digest)), 256)
    return tuple(F.conv(F.substring(h, a, 15), 16, 10).cast("long") for a in (1, 16))


def weighted_sequences(ids: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sequences depth, x1, x2, conv_id, weight; runs of their ends depth, x1, x2, run, ids)."""
    x1, x2 = _bits()
    keys = turns.select("conv_id", x1.alias("x1"), x2.alias("x2")).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("depth"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    each = written(ids.join(keys, "conv_id", "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in KEY)), "sequences")
    sequences = each.groupBy(KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"))
    # ids are distinct, so a run holds END_IDS of them at most
    run = F.floor(F.col("conv_id") / END_IDS).cast("long")
    ends = each.groupBy(*KEY, run.alias("run")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    return sequences, ends


def paths(sequences: DataFrame, turns: DataFrame) -> DataFrame:
    """Every prefix of every sequence: conv_id (the sequence's), weight, n (its
    turns), depth, x1, x2, size; the root's too."""
    x1, x2 = _bits()
    weights = sequences.select("conv_id", "weight", F.col("depth").alias("n"))
    rows = turns.join(weights, "conv_id").select("conv_id", "weight", "n", "depth", x1.alias("x1"), x2.alias("x2"), "size",
                                                 F.floor((F.col("depth") - 1) / PIECE_TURNS).alias("piece"))
    before = _before(rows, "conv_id", "piece", {"x1": F.bit_xor("x1"), "x2": F.bit_xor("x2")})
    running = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({c: F.bit_xor(c).over(running) for c in ("x1", "x2")}).join(before, ["conv_id", "piece"], "left")
    rows = rows.select("conv_id", "weight", "n", "depth", *(F.col(c).bitwiseXOR(F.coalesce(f"{c}_before", F.lit(0))).alias(c) for c in ("x1", "x2")), "size")
    zero = F.lit(0).cast("long")
    return rows.unionByName(weights.select("conv_id", "weight", "n", zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), zero.alias("size")))


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, x1, x2, ends_sha256: the hash of each sequence's ids in order, run by run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        names = [*KEY, "ends_sha256"]

        def row():
            return pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*done)], names=names)

        done: list[tuple] = []
        for batch in batches:
            for *now, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if now == key:
                    digest.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = now, hashlib.sha256(ids.encode())
            if done:
                yield row()
                done = []
        if key is not None:
            done.append((*key, digest.hexdigest()))
            yield row()

    rows = ends.repartition(*KEY).sortWithinPartitions(*KEY, "run").select(*KEY, "ids")
    return rows.mapInArrow(run, "depth long, x1 long, x2 long, ends_sha256 string")


def prefix_trie(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """One row a node: depth, x1, x2 (its key), conv_id, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 (null where none ends).

    ``ids``: all conversations (those of no turns too); ``turns``: conv_id, depth
    (1, 2, ...), digest, size.
    """
    reach_workers(turns.sparkSession)
    turns = written(turns.select("conv_id", "depth", "digest", "size"), "rebuilt")
    sequences, ends = weighted_sequences(ids, turns)
    sequences = written(sequences, "weighted")
    path = written(paths(sequences, turns), "paths")
    proper = path.where("depth < n").select(KEY).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    nodes = written(path.join(leaves, "conv_id", "left").groupBy(KEY).agg(
        F.sum("weight").alias("n_convs"), F.min("conv_id").alias("owner"), F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        F.first("size").alias("size")), "nodes")
    # along the paths: what a sequence's own nodes add to the nodes above them
    steps = written(path.select("conv_id", *KEY).join(nodes.select(*KEY, "n_convs", "owner", "size"), KEY).select(
        "conv_id", *KEY, "owner", (F.col("owner") == F.col("conv_id")).alias("own"),
        F.when(F.col("owner") == F.col("conv_id"), (F.col("n_convs") - 1) * F.col("size")).otherwise(0).alias("saved"),
        # the last node of a piece is the first one's parent in the next: it counts in both
        F.floor(F.col("depth") / PIECE_TURNS).alias("piece")), "steps")
    later = _before(steps.withColumn("piece", -F.col("piece")), "conv_id", "piece", {"saved": F.sum("saved")})
    edge = steps.where(F.col("depth") % PIECE_TURNS == PIECE_TURNS - 1).select("conv_id", (F.col("piece") + 1).alias("piece"), F.col("owner").alias("edge_owner"))
    head = steps.where(F.col("depth") % PIECE_TURNS == 0).select("conv_id", (F.col("piece") - 1).alias("piece"), F.col("own").alias("head_own"))
    along = Window.partitionBy("conv_id", "piece").orderBy("depth")
    down = Window.partitionBy("conv_id", "piece").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    place = ["conv_id", "piece"]
    walked = (steps.withColumns({"above": F.lag("owner").over(along), "next_own": F.lead("own").over(along), "below": F.sum("saved").over(down)})
              .join(later.withColumn("piece", -F.col("piece")), place, "left").join(edge, place, "left").join(head, place, "left"))
    inner = F.col("depth") % PIECE_TURNS
    parent = F.when(inner == 0, F.col("edge_owner")).otherwise(F.col("above"))
    child = F.when(inner == PIECE_TURNS - 1, F.col("head_own")).otherwise(F.col("next_own"))
    per_node = walked.groupBy(KEY).agg(
        F.max(F.when(F.col("own"), parent)).alias("parent_conv_id"),
        F.count_if(F.coalesce(child, F.lit(False))).alias("n_children"),
        F.sum(F.col("below") + F.coalesce("saved_before", F.lit(0))).alias("saved_tokens"))
    return (nodes.join(per_node, KEY).join(end_digests(ends), KEY, "left")
            .select(*KEY, F.col("owner").alias("conv_id"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    ids, turns = rebuilt(written(numbered_turns(conversations), "numbered"))
    return prefix_trie(ids, turns)


def node_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, depth, role, text: the last turn of each of these nodes (conv_id, depth)."""
    first = written(numbered_turns(conversations), "numbered")
    _, turns = rebuilt(first)
    at = nodes.select("conv_id", "depth").join(turns, ["conv_id", "depth"]).select("conv_id", "depth", "digest")
    texts = conversations.where("conv_id IS NOT NULL").select(
        turn_digest().alias("digest"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.groupBy("digest").agg(F.first("role").alias("role"), F.first("text").alias("text"))  # equal digests, equal turns
    return at.join(texts, "digest").select("conv_id", "depth", "role", "text")

"""Operator 12, conversation prefix trie: shared beginnings and the tokens they would save.

Conversations whose first turns are the same share the nodes of a trie.  A turn is its role
and text; texts are read once and become a 128-bit mark and their size, and everything after
that is a few longs a row.

* Turns are numbered, and the sums below taken, by :mod:`running`: over range-sorted rows, so
  a conversation that holds a third of all turns is spread over many tasks.
* A prefix is known by its length and 128 bits of running sums over hashes of (place, mark),
  so equal prefixes of any conversations meet in one grouping, which is pre-aggregated.
* A node is (its smallest member, its depth).  Totals over subtrees come from :mod:`contraction`
  by rounds of rake and compress and a re-expansion.
* The digest of a node's ending members is fed in ascending order, a run of ids at a time, from
  sorted rows: memory stays bounded where very many copies of a conversation end in one node.

Defined results: conversations are ordered by turn (null first); equal turns by their mark,
then their size; repeated rows are turns of their own; a null role or text is empty; rows
without a conv_id belong to no conversation and have no node; very long texts are hashed
whole; an empty table has no nodes, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.llm.common import prepare
from clickpath.llm.contraction import subtree_totals, with_children
from clickpath.llm.running import running_sums
from clickpath.storage import stored

#: Most turns that a rebuilt conversation takes from its family's first one.
MOST_HEAD, FAMILY = 8, 5
_LANES = ["_l0", "_l1", "_l2", "_l3"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def marked_turns(conversations: DataFrame) -> DataFrame:
    """``(c, turn, mark, size)`` of every turn that belongs to a conversation, stored."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    mark = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    c = F.col("conv_id").cast("long")
    return stored(conversations.filter(c.isNotNull()).select(c.alias("c"), F.col("turn"), mark.alias("mark"), F.octet_length(text).cast("long").alias("size")), "turns")


def numbered(turns: DataFrame) -> DataFrame:
    """Turns with ``nth`` (from 0) in their conversation, and ``n_lead``: how many turns their
    ``family``'s conversation of the same id has, for all rows of its other conversations."""
    rows = turns.withColumns({"family": F.col("c") - F.col("c") % FAMILY, "one": F.lit(1).cast("long")})
    # Equal rows are told apart by their place in the stored files, so that they can be spread.
    rows = rows.withColumns({"lead": (F.col("c") == F.col("family")).cast("long"), "place": F.monotonically_increasing_id()})
    order = [F.col("family").asc(), F.col("lead").desc(), F.col("c").asc(), F.col("turn").asc_nulls_first(), F.col("mark").asc(), F.col("size").asc(), F.col("place").asc()]
    found = running_sums(rows, order, [("c", "one", "upto"), ("family", "lead", "n_lead")])
    return found.select("c", "family", (F.col("upto") - 1).alias("nth"), "n_lead", "mark", "size")


def head(c: Column) -> Column:
    """Turns that conversation ``c`` takes from the first of its family."""
    return (F.crc32(c.cast("string").cast("binary")) % (MOST_HEAD + 1)).cast("long")


def rebuilt(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``(c, place, mark, size)``: the turns of every rebuilt conversation, places from 0."""
    rows = numbered(turns)
    first = F.col("c") == F.col("family")
    place = F.when(first, F.col("nth")).otherwise(F.least(head(F.col("c")), F.col("n_lead")) + F.col("nth") - head(F.col("c")))
    own = rows.filter(first | (F.col("nth") >= head(F.col("c")))).select("c", place.alias("place"), "mark", "size")
    heads = rows.filter(first & (F.col("nth") < MOST_HEAD)).select("family", "nth", "mark", "size")
    others = convs.filter(~first).select("c", "family")
    lent = heads.hint("merge").join(others, "family").filter(F.col("nth") < head(F.col("c"))).select("c", F.col("nth").alias("place"), "mark", "size")
    return own.unionAll(lent)


def prefixes(turns: DataFrame) -> DataFrame:
    """``(c, d, key, up_key, size)``: every prefix of ``d >= 1`` turns of every conversation."""
    for k in (0, 1):
        term = F.xxhash64(F.lit(k), "place", "mark")
        turns = turns.withColumns({f"_l{2 * k}": term.bitwiseAND(F.lit(0xFFFFFFFF)), f"_l{2 * k + 1}": F.shiftrightunsigned(term, 32)})
    sums = running_sums(turns.drop("mark"), [F.col("c").asc(), F.col("place").asc()], [("c", lane, f"_s{lane}") for lane in _LANES])
    return sums.select("c", (F.col("place") + 1).alias("d"), _key(F.col("place") + 1, *(F.col(f"_s{x}") for x in _LANES)).alias("key"),
                       _key(F.col("place"), *(F.col(f"_s{x}") - F.col(x) for x in _LANES)).alias("up_key"), "size")


def _key(depth: Column, *lanes: Column) -> Column:
    return F.md5(F.concat_ws(",", depth, *lanes))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one key's ids, comma-joined."""
    for batch in batches:
        if len(batch):
            key = batch.column("key").dictionary_encode().indices.to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            bounds = pa.array(np.append(starts, len(batch)).astype(np.int32))
            ids = pc.binary_join(pa.ListArray.from_arrays(bounds, batch.column("c").cast(pa.string())), ",")
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(starts)), batch.column("c").take(pa.array(starts)), ids], ["key", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a key from its runs, fed one after the other."""
    open_key, state = None, None
    for batch in batches:
        keys, found = [], []
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key != open_key:
                if state is not None:
                    keys.append(open_key)
                    found.append(state.hexdigest())
                open_key, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(found, pa.string())], ["key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([open_key]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def ends(members: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of ``members(key, c)``: the ids by number, comma-joined."""
    runs = members.repartitionByRange("key", "c").sortWithinPartitions("key", "c").mapInArrow(_runs, "key string, first long, ids string")
    return runs.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key string, ends_sha256 string")


def prefix_tree(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (bytes of text that its subtree's nodes share) and ``ends_sha256``."""
    prepare(conversations.sparkSession)
    turns = marked_turns(conversations)
    convs = stored(turns.select("c", (F.col("c") - F.col("c") % FAMILY).alias("family")).distinct(), "conversations")
    found = prefixes(stored(rebuilt(turns, convs), "rebuilt"))
    zero = F.lit(0).cast("long")
    root = _key(*(F.lit(0) for _ in range(5)))
    inner = found.groupBy("key").agg(F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("c"), F.min("d").alias("d"), F.min("up_key").alias("up_key"), F.min("size").alias("size"))
    top = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("c")).filter("n_convs > 0").select(
        root.alias("key"), "n_convs", "c", zero.alias("d"), F.lit(None).cast("string").alias("up_key"), zero.alias("size"))
    nodes = stored(inner.select(*top.columns).unionAll(top), "nodes")
    # A parent of very many children is a large key of the left side alone, which Spark splits.
    ups = nodes.select(F.col("key").alias("up_key"), F.col("c").alias("up_c"), F.col("d").alias("up_d"))
    tree = with_children(nodes.hint("merge").join(ups, "up_key", "left").drop("up_key"))
    leaf = F.when(F.col("n") == 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
    tree = stored(tree.withColumns({"leaves": leaf, "saved": (F.col("n_convs") - 1) * F.col("size")}), "tree")
    totals = subtree_totals(tree, ["leaves", "saved"])
    last = found.groupBy("c").agg(F.max_by("key", "d").alias("key"))
    members = convs.select("c").join(last, "c", "left").select(F.coalesce("key", root).alias("key"), "c")
    sums = totals.select("c", "d", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    out = tree.drop("leaves", "saved").join(sums, ["c", "d"]).join(ends(members), "key", "left")
    return out.select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("up_c").alias("parent_conv_id"), "n_convs", F.col("n").alias("n_children"),
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))

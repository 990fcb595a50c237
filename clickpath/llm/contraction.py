"""Subtree totals of a forest by parallel tree contraction.

Rounds alternate between two steps on the table of live nodes, each a few joins on node ids:

* rake: every leaf goes; what it has gathered is added to its parent;
* compress: of every unary chain, the nodes whose hash is above that of both neighbours go;
  their child moves up to their parent and carries what they have gathered.

Both neighbours of a node that goes stay, so a round's steps never meet.  Leaves go at once and
about a third of a chain goes in a round, so the rounds are logarithmic whatever the tree's
shape.  Nodes that are left out of chains are re-expanded at the end: a node's total is its
child's and what was gathered, and following such links doubles their length each time.

A node with very many children is no hot key: its children's sums, counts and identities (by
exclusive or, which leaves the last child's own) are aggregated before they reach it.  Every
round is a table in the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.storage import stored

ID, UP, KID = ["c", "d"], ["up_c", "up_d"], ["kid_c", "kid_d"]


def with_children(nodes: DataFrame) -> DataFrame:
    """``nodes(c, d, up_c, up_d, ...)`` with ``n`` children and the exclusive or of their ids."""
    kids = (nodes.filter("up_c is not null").groupBy(*(F.col(u).alias(i) for i, u in zip(ID, UP, strict=True)))
            .agg(F.count(F.lit(1)).alias("n"), F.bit_xor("c").alias("kid_c"), F.bit_xor("d").alias("kid_d")))
    zero = F.lit(0).cast("long")
    return nodes.join(kids, ID, "left").withColumns({x: F.coalesce(F.col(x), zero) for x in ("n", *KID)})


def _order(c: str, d: str, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), F.col(c), F.col(d))


def _rake(live: DataFrame, values: list[str]) -> DataFrame:
    """Live nodes but the leaves, with what the leaves have gathered."""
    leaves = live.filter("n = 0 and up_c is not null")
    sums = leaves.groupBy(*(F.col(u).alias(i) for i, u in zip(ID, UP, strict=True))).agg(
        F.count(F.lit(1)).alias("_n"), F.bit_xor("c").alias("_kid_c"), F.bit_xor("d").alias("_kid_d"), *(F.sum(F.col(v) + F.col(f"carry_{v}")).alias(f"_{v}") for v in values))
    rest = live.filter("n > 0 or up_c is null").join(sums, ID, "left")
    got = {x: F.coalesce(F.col(f"_{x}"), F.lit(0)) for x in ("n", *KID, *values)}
    return rest.withColumns({"n": F.col("n") - got["n"], **{k: F.col(k).bitwiseXOR(got[k]) for k in KID}, **{v: F.col(v) + got[v] for v in values}}).drop(*(f"_{x}" for x in got))


def _compress(live: DataFrame, values: list[str], salt: int) -> DataFrame:
    """Live nodes but the chosen ones; ``from_c, from_d`` name the chosen parent whose place a
    node has taken, and ``log_*`` what that parent's total has beside the node's."""
    mine = _order("c", "d", salt)
    goes = F.coalesce((F.col("n") == 1) & F.col("up_c").isNotNull() & (mine > _order(*KID, salt)) & (mine > _order(*UP, salt)), F.lit(False))
    chosen = live.filter(goes)
    none = F.lit(None).cast("long")
    to_kid = chosen.select(F.col("kid_c").alias("c"), F.col("kid_d").alias("d"), *(F.col(u).alias(f"_{u}") for u in UP), none.alias("_kid_c"), none.alias("_kid_d"),
                           *(F.col(v).alias(f"_{v}") for v in values), *(F.col(f"carry_{v}").alias(f"_carry_{v}") for v in values))
    to_parent = chosen.select(F.col("up_c").alias("c"), F.col("up_d").alias("d"), none, none, F.col("c").bitwiseXOR(F.col("kid_c")), F.col("d").bitwiseXOR(F.col("kid_d")), *(none for _ in range(2 * len(values))))
    told = to_kid.unionAll(to_parent).groupBy(*ID).agg(*(F.max(f"_{u}").alias(f"_{u}") for u in UP), *(F.bit_xor(f"_{k}").alias(f"_{k}") for k in KID),
                                                       *(F.max(f"_{v}").alias(f"_{v}") for v in values), *(F.max(f"_carry_{v}").alias(f"_carry_{v}") for v in values))
    rest = live.filter(~goes).join(told, ID, "left")
    moved = F.col("_up_c").isNotNull()
    after = {"from_c": F.when(moved, F.col("up_c")), "from_d": F.when(moved, F.col("up_d")),
             **{f"log_{v}": F.when(moved, F.col(f"_{v}") + F.col(f"carry_{v}")) for v in values},
             **{u: F.coalesce(f"_{u}", u) for u in UP}, **{k: F.col(k).bitwiseXOR(F.coalesce(f"_{k}", F.lit(0).cast("long"))) for k in KID},
             **{f"carry_{v}": F.when(moved, F.col(f"carry_{v}") + F.col(f"_{v}") + F.col(f"_carry_{v}")).otherwise(F.col(f"carry_{v}")) for v in values}}
    names = [*ID, *UP, "n", *KID, *values, *(f"carry_{v}" for v in values)]
    return rest.select(*(after.pop(x).alias(x) if x in after else F.col(x) for x in names), *(c.alias(x) for x, c in after.items()))


def _expanded(logs: DataFrame, known: DataFrame, values: list[str]) -> DataFrame:
    """Totals of the nodes that compress left out: links are followed to nodes of known totals."""
    links = stored(logs, "tree-links")
    while True:
        further = links.select(F.col("from_c").alias("c"), F.col("from_d").alias("d"), F.col("c").alias("_c"), F.col("d").alias("_d"), *(F.col(f"log_{v}").alias(f"_{v}") for v in values))
        step = links.join(further, ID, "left")
        links = stored(step.select("from_c", "from_d", F.coalesce("_c", "c").alias("c"), F.coalesce("_d", "d").alias("d"),
                                   *((F.col(f"log_{v}") + F.coalesce(f"_{v}", F.lit(0))).alias(f"log_{v}") for v in values), F.col("_c").isNotNull().alias("went")), "tree-links")
        if not links.filter("went").limit(1).count():
            break
    return links.join(known, ID).select(F.col("from_c").alias("c"), F.col("from_d").alias("d"), *((F.col(v) + F.col(f"log_{v}")).alias(v) for v in values))


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``(c, d, values...)``: the sums of ``values`` over every node's subtree, itself included.

    ``nodes`` are what :func:`with_children` gives: an id of two longs, the parent's (null: a
    root), the children's count and identities, and long values.  No nodes, no rows.
    """
    zero = F.lit(0).cast("long")
    live = nodes.select(*ID, *UP, "n", *KID, *values, *(zero.alias(f"carry_{v}") for v in values))
    known, logs, salt = [], [], 0
    while True:
        known.append(live.filter("n = 0 and up_c is not null").select(*ID, *values))
        raked = stored(_rake(live, values), "tree-rake")
        if not raked.filter("up_c is not null").limit(1).count():
            break
        packed = stored(_compress(raked, values, salt), "tree-compress")
        logs.append(packed.filter("from_c is not null").select("from_c", "from_d", *ID, *(f"log_{v}" for v in values)))
        live, salt = packed.select(*live.columns), salt + 1
    totals = reduce(DataFrame.unionAll, known, raked.select(*ID, *values))
    return totals.unionAll(_expanded(reduce(DataFrame.unionAll, logs), totals, values)) if logs else totals

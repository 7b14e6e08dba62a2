"""A Merkle manifest of a dataset, with an inclusion proof for every row.

A row is a leaf, the hash of its fields; texts go no further than that. Leaves
are ordered within their source, and every three neighbours become one node until
one is left, the source's subroot; subroots, ordered by source, become the root
likewise. A superblock is 3**7 neighbours and is reduced in one task, so a source
that owns most of the rows is spread over as many tasks as it has superblocks.

Superblock nodes are leaves of the next round, until the root is found. Then the
way goes down again: in each round the nodes and the outer nodes that they need
(the siblings on the way from their superblock to the root) are cogrouped by
superblock, and one pass finishes the reduction inside it, joins the proofs and
folds them with the leaves as they are now. An outer path has two texts per level,
so nothing that grows with the input meets one task or the driver.

A null field is hashed as such. A null source is a source of its own, before all
others; a null id comes before all ids of its source. Rows that repeat an id are
ordered by their leaf, equal rows are leaves each. An empty table gives an empty
result. Texts may be of any length. Only the named columns are read; others may
have any name. The input should be a table that reads alike twice, as equal rows
are told apart by their place in it while partitions are cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.ordered import running_total
from pairloom.session import checkpointed

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes under one parent, and levels of a superblock.
FANOUT, DEPTH = 3, 7
_NODE = "tree int, source string, pos bigint, node string"
_OUTER = "tree int, source string, pos bigint, subroot string, before array<string>, after array<string>"
#: Trees of named sources and of the null one, which comes first, and the tree over all subroots.
_NAMELESS, _NAMED, _TOP = 0, 1, 2
_TREE = ["tree", "source"]


def leaf_hash(values: dict[str, Column]) -> Column:
    """SHA-256 of the fields: `-` for null, else the length in bytes, a colon and the value."""
    parts = [c.cast("string") for c in values.values()]
    marked = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in parts]
    return F.unhex(F.sha2(F.concat(*marked).cast("binary"), 256))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree_levels(nodes: list[str], depth: int | None = None) -> list[list[str]]:
    """The nodes and all levels above them, up to one node or through `depth` levels."""
    levels = [nodes]
    while len(levels) <= depth if depth is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return levels


def sibling_texts(level: list[str], at: int) -> tuple[str, str]:
    """The texts of the siblings left and right of a node."""
    first = at - at % FANOUT
    return "".join(level[first:at]), "".join(level[at + 1 : first + FANOUT])


def fold(node: str, path: Iterator[tuple[str, str]]) -> str:
    """The root that a node and its proof lead to."""
    for before, after in path:
        node = digest(before + node + after)
    return node


def _block_levels(nodes: list[str], block: int) -> list[list[str]]:
    """Levels of one superblock. A tree's only one ends at its top, any other after `DEPTH` levels."""
    alone = block == 0 and len(nodes) < FANOUT**DEPTH
    return tree_levels(nodes, None if alone else DEPTH)


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / FANOUT**DEPTH).cast("long"))


def _texts(nodes: pd.Series) -> list[str]:
    return [n if isinstance(n, str) else bytes(n).hex() for n in nodes]


def _reduced(nodes: DataFrame) -> DataFrame:
    """One node per superblock of `(tree, source, pos, node)`."""

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree, source, block = key
        top = _block_levels(_texts(rows.sort_values("pos")["node"]), int(block))[-1]
        return pd.DataFrame({"tree": [tree], "source": [source], "pos": [block], "node": top})

    return checkpointed(_blocks(nodes.select(*_TREE, "pos", "node")).groupBy(*_TREE, "block").applyInPandas(reduce, _NODE))


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Nodes by round, the last with one node per tree."""
    rounds = [_reduced(nodes)]
    while not rounds[-1].where("pos > 0").isEmpty():
        rounds.append(_reduced(rounds[-1]))
    return rounds


def _descend(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """The outer paths of `nodes`, from those of their superblocks' nodes."""

    def spread(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        tree, source, block = key
        rows, above = rows.sort_values("pos"), above.iloc[0]
        levels = _block_levels(list(rows["node"]), int(block))
        before, after = [], []
        for at in range(len(rows)):
            own = [sibling_texts(level, at // FANOUT**k) for k, level in enumerate(levels[:-1])]
            before.append([b for b, _ in own] + list(above["before"]))
            after.append([a for _, a in own] + list(above["after"]))
        return pd.DataFrame(
            {
                "tree": tree,
                "source": source,
                "pos": rows["pos"].to_numpy(),
                "subroot": above["subroot"],
                "before": before,
                "after": after,
            }
        )

    own = _blocks(nodes).groupBy(*_TREE, "block")
    needed = outer.withColumnRenamed("pos", "block").groupBy(*_TREE, "block")
    return checkpointed(own.cogroup(needed).applyInPandas(spread, _OUTER))


def _proven(leaves: DataFrame, outer: DataFrame, root: str, id: str, id_type: str) -> DataFrame:
    """Every row's proof, from the leaves and outer paths of a superblock."""

    def prove(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, above = rows.sort_values("pos"), above.iloc[0]
        nodes = _texts(rows["node"])
        levels = _block_levels(nodes, int(key[2]))
        outside = list(zip(above["before"], above["after"]))
        # Texts of the siblings above each node, joined once per node and not once per leaf.
        beyond = ["".join(b + a for b, a in outside)]
        for k in range(len(levels) - 2, -1, -1):
            beyond = ["".join(sibling_texts(levels[k], i)) + beyond[i // FANOUT] for i in range(len(levels[k]))]
        subroot = above["subroot"] or levels[-1][0]
        folded = []
        for at, now in enumerate(_texts(rows["now"])):
            inside = [sibling_texts(level, at // FANOUT**k) for k, level in enumerate(levels[:-1])]
            folded.append(fold(now, [*inside, *outside]))
        return pd.DataFrame(
            {
                id: rows[id].to_numpy(),
                "leaf": nodes,
                "subroot": subroot,
                "root": root,
                "proof_sha256": [digest(text) for text in beyond],
                "folded_root": folded,
                "verified": [f == root for f in folded],
            }
        )

    shape = f"`{id}` {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    own = _blocks(leaves).groupBy(*_TREE, "block")
    needed = outer.withColumnRenamed("pos", "block").groupBy(*_TREE, "block")
    return own.cogroup(needed).applyInPandas(prove, shape)


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id: str = "doc_id",
    source: str = "source",
    now: dict[str, Column] | None = None,
) -> DataFrame:
    """`id, leaf, subroot, root, proof_sha256, folded_root, verified` of every row.

    `now` gives fields their present values, over the columns of `docs`: the leaf is
    taken of them again and folded with the manifest's siblings, and `verified` says
    whether that is the root. Without it all rows are as they were.
    """
    then = {f: F.col(f) for f in fields}
    # Ids pass through pandas as text, so that a null among whole numbers stays one.
    id_type = docs.schema[id].dataType.simpleString()
    leaves = checkpointed(
        docs.select(
            F.when(F.col(source).isNull(), _NAMELESS).otherwise(_NAMED).alias("tree"),
            F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
            F.col(id).alias("own_id"),
            leaf_hash(then).alias("node"),
            leaf_hash(then | (now or {})).alias("now"),
        ).withColumn("place", F.monotonically_increasing_id())
    )
    ordered = leaves.withColumn("named", F.col("own_id").isNotNull()).withColumn(
        "id", F.when(F.col("named"), F.col("own_id")).otherwise(F.lit(0).cast(id_type))
    )
    placed = running_total(
        ordered, ["named", "id", "node", "place"], F.lit(1), partition_by=_TREE, keep=("now",)
    ).select(
        *_TREE, F.col("before").alias("pos"), F.when(F.col("named"), F.col("id").cast("string")).alias("id"), "node", "now"
    )
    rounds = _rounds(placed)
    subroots = rounds[-1]
    above = checkpointed(
        running_total(subroots, _TREE, F.lit(1), keep=("node",)).select(
            F.col("tree").alias("own_tree"),
            F.col("source").alias("own_source"),
            F.lit(_TOP).alias("tree"),
            F.lit("").alias("source"),
            F.col("before").alias("pos"),
            "node",
        )
    )
    tops = _rounds(above)
    top = tops[-1].head()
    root = top["node"] if top else ""
    nothing = F.array().cast("array<string>")
    outer = tops[-1].select(
        *_TREE, "pos", F.lit("").alias("subroot"), nothing.alias("before"), nothing.alias("after")
    )
    for nodes in [*tops[-2::-1], above.select(*_TREE, "pos", "node")]:
        outer = _descend(nodes, outer)
    # From places in the tree of subroots to the sources that they are.
    outer = (
        above.join(outer.select("pos", "before", "after"), "pos")
        .select(
            F.col("own_tree").alias("tree"),
            F.col("own_source").alias("source"),
            F.lit(0).cast("long").alias("pos"),
            F.col("node").alias("subroot"),
            "before",
            "after",
        )
    )
    for nodes in rounds[-2::-1]:
        outer = _descend(nodes, outer)
    proven = _proven(placed, outer, root, "id", "string")
    return proven.withColumn("id", F.col("id").cast(id_type)).withColumnRenamed("id", id)

"""Merkle manifest of a table: a digest tree per group, and one over the groups.

Every row is a leaf.  Within a group the leaves ascend by id; every ``fan``
consecutive nodes of a level (the last run may be shorter) become one node of
the next, until one is left, the group's subroot.  The subroots, in order of the
group, are the leaves of one more tree of the same kind; it ends in the root.

A level is one window: fixed-offset lag and lead columns give each node the
digests around it, masked by its slot in the run and by the run's length, so
that only its siblings remain; the first child of a run, which sees all others
to its right, hashes the parent.  Windows cover ``CHUNK`` runs that lie together
and never a whole group, so a group that holds most rows is spread like any
other.  Positions come from a range shuffle of the leaves, not from a window.
Proofs go down again: a node's path is its own siblings before its parent's
path, one join per level on the parent's position.  Levels shrink by ``fan``, so
all of them together cost little more than the first.
"""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.ordering import global_row_number
from tideline.session import stable

CHUNK = 512  # runs under one window group
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else and NULL as they are."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def leaf_digest(*values: Column) -> Column:
    """Hex SHA-256 of the values, each ``-`` if NULL, else UTF-8 byte count, colon, value."""
    parts = []
    for value in values:
        said = value.cast("string")
        parts += [F.coalesce(F.concat(F.octet_length(said), F.lit(":"), said), F.lit("-"))]
    return F.sha2(F.concat(*parts), 256)


def siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """``nodes`` (g, pos, n, digest) with slot, left and right: the siblings' digests, joined."""
    order = Window.partitionBy("g", F.expr(f"pos div {fan * CHUNK}")).orderBy("pos")
    slot = F.col("pos") % fan
    length = F.least(F.lit(fan), F.col("n") - F.col("pos") + slot)
    left = [F.when(slot >= k, F.lag("digest", k).over(order)) for k in range(fan - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("digest", k).over(order)) for k in range(1, fan)]
    return nodes.withColumns(
        {"slot": slot, "left": F.concat_ws("", *left), "right": F.concat_ws("", *right)}
    )


def parents(level: DataFrame, fan: int) -> DataFrame:
    """First children hash their runs."""
    return level.filter("slot = 0").select(
        "g", F.expr(f"pos div {fan}").alias("pos"),
        F.expr(f"(n + {fan - 1}) div {fan}").alias("n"),
        F.sha2(F.concat("digest", "right"), 256).alias("digest"),
    )


def build(nodes: DataFrame, fan: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels with siblings (groups of several nodes), and per level the groups down to one node."""
    depth, left = 0, nodes.agg(F.max("n")).first()[0] or 0
    while left > 1:
        depth, left = depth + 1, -(-left // fan)
    levels, ended = [], [nodes.filter("n = 1")]
    for _ in range(depth):
        levels.append(stable(siblings(nodes.filter("n > 1"), fan)))
        nodes = parents(levels[-1], fan)
        ended.append(nodes.filter("n = 1"))
    return levels, ended


def paths(levels: list[DataFrame], ended: list[DataFrame], above: DataFrame, fan: int) -> DataFrame:
    """Leaf rows with ``path`` from the leaf up; ``above`` (g, path, ...) continues a group's last node."""
    rest = [c for c in above.columns if c not in ("g", "path")]

    def last(nodes: DataFrame) -> DataFrame:
        return nodes.join(above, "g")

    out = last(ended[-1])
    for level, own in zip(reversed(levels), reversed(ended[:-1])):
        over = out.select("g", F.col("pos").alias("up"), F.col("path").alias("_over"), *rest)
        step = F.array(F.struct("left", "right")).cast(PATH)
        out = (
            level.withColumn("up", F.expr(f"pos div {fan}"))
            .join(over, ["g", "up"])
            .withColumn("path", F.concat(step, "_over"))
            .drop("up", "slot", "left", "right", "_over")
            .unionByName(last(own))
        )
    return out


def manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
    fields: tuple[str, ...] = FIELDS, also: Mapping[str, Column] | None = None, fan: int = 8,
) -> DataFrame:
    """(id, group, leaf, subroot, root, path, ...) per row of ``docs``.

    ``leaf`` covers ``fields`` in their order, ``path`` is an array of
    (left, right), the joined digests of a node's siblings before and after it,
    from the leaf's level to the level below the root.  ``also`` names further
    expressions to evaluate in the same scan.

    A NULL group is a group of its own and comes first; groups follow in the
    byte order of their text.  Ids ascend with NULL first; rows with equal ids
    follow their leaf digests, and rows equal in all fields are equal leaves
    with a place each.  Empty text is ``0:``, NULL ``-``.  A group of one row has
    its leaf as subroot, one group has its subroot as root; an empty table gives
    no rows.  Columns of other names are not looked at.
    """
    also = dict(also or {})
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("g"),
        F.col(id_col).alias("id"), F.col(group_col).alias("group"),
        leaf_digest(*[F.col(c) for c in fields]).alias("digest"),
        *[value.alias(f"also_{name}") for name, value in also.items()],
    )
    # written first: the range shuffle samples its input, and texts are hashed once
    placed = global_row_number(stable(leaves), ["g", "id", "digest"], "_rn")
    # a row per group; Spark broadcasts it only below its own threshold
    sizes = placed.groupBy("g").agg(F.min("_rn").alias("_first"), F.count("*").alias("n"))
    nodes = placed.join(sizes, "g").withColumn("pos", F.col("_rn") - F.col("_first"))
    nodes = stable(nodes.drop("_rn", "_first"))

    levels, ended = build(nodes, fan)
    subroots = ended[0].select("g", "digest")
    for one in ended[1:]:
        subroots = subroots.unionByName(one.select("g", "digest"))
    tops = global_row_number(subroots, ["g"], "_rn")
    groups = tops.select(
        F.lit("").alias("g"), F.col("g").alias("of"), (F.col("_rn") - 1).alias("pos"), "digest",
        F.col("digest").alias("subroot"),
    )
    number = groups.groupBy("g").agg(F.count("*").alias("n"))
    top_levels, top_ended = build(stable(groups.join(number, "g")), fan)
    root = top_ended[-1].select(
        "g", F.col("digest").alias("root"), F.array().cast(PATH).alias("path")
    )
    above = paths(top_levels, top_ended, root, fan).select(
        F.col("of").alias("g"), "path", "subroot", "root"
    )
    return paths(levels, ended, stable(above), fan).select(
        F.col("id").alias(id_col), F.col("group").alias(group_col), F.col("digest").alias("leaf"),
        "subroot", "root", "path", *[F.col(f"also_{name}").alias(name) for name in also],
    )


def folded(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    return F.aggregate(
        path, leaf, lambda done, step: F.sha2(F.concat(step["left"], done, step["right"]), 256)
    )


def proof_digest(path: Column) -> Column:
    """Hex SHA-256 of all siblings, from the leaf's level up, left to right."""
    steps = F.transform(path, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(steps, ""), 256)


def verified_manifest(docs: DataFrame, tampered: Column, changed_text: Column, **columns) -> DataFrame:
    """The manifest of ``docs``, held against a copy whose text was changed where ``tampered``.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root (from the copy's leaf and
    the original siblings) and verified.  A NULL ``tampered`` counts as false.
    """
    told = F.when(tampered, changed_text).otherwise(F.col("text"))
    found = leaf_digest(*[told if c == "text" else F.col(c) for c in FIELDS])
    # untouched rows need not be hashed twice
    found = F.when(tampered, found)
    table = manifest(docs, also={"found": found}, **columns)
    return table.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("path"), F.coalesce("found", "leaf")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

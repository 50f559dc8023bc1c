"""Merkle manifest of a table: a tree of digests per group, a tree over the groups' roots, a proof for every row.

Every node is labelled with the interval of leaf ranks it covers. Ranks come from one range partitioning of narrow rows
and the row counts of its parts, so no task ever holds a whole group. A level is one aggregation: nodes whose intervals
begin in the same bucket of eight nodes get a parent. Then, from the roots down, nodes meet their parents in a
containment join, bucketed by level: the parent's interval less the node's own leaves the intervals of its siblings,
left and right. A path is the list of those siblings' digests, level by level, which is all that a proof needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.shared import settle, stored

PATH = "array<struct<left string, right string>>"


def sha(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts' UTF-8, joined."""
    return F.sha2(F.concat(*parts), 256)


def row_digest(*values: Column) -> Column:
    """Digest of one row: each value as its UTF-8 byte count, a colon and the value, or ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return sha(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and the siblings along its path lead to."""
    return F.aggregate(path, leaf, lambda node, level: sha(level["left"], node, level["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""), 256)


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``lo``, their rank within their tree, and ``hi``, one more; ``leaves`` counts the tree's rows.

    Ordered by (tree, place, digest). Parts of the ordered rows are counted per tree; a row's rank is its place in its
    part plus what lies in earlier parts.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("tree", "place", "digest")
    with stored(rows) as narrow:  # the sampling of the ranges reads these instead of hashing all texts once more
        run = settle(
            narrow.repartitionByRange(parts, *order)
            .sortWithinPartitions(*order)
            .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
        )
    parts_of = run.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts_of.select(  # as many rows as (tree, part) pairs, never rows of the table
        "tree",
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("leaves"),
    )
    ranked = run.join(offsets, ["tree", "_part"]).withColumn("lo", F.col("_at") + F.col("_shift"))
    return ranked.withColumn("hi", F.col("lo") + 1).drop("_part", "_at", "_shift")


def _grown(leaves: DataFrame, fan: int) -> list[DataFrame]:
    """Levels 1 and up: nodes with their interval and children, of trees with several nodes on the level below."""
    most = leaves.agg(F.max("leaves")).first()[0] or 0
    levels: list[DataFrame] = []
    below, width = leaves, 1
    while width < most:
        child = F.struct("lo", "hi", "digest").alias("child")
        several = below.where(F.col("leaves") > width).select("tree", "leaves", child)
        width *= fan
        bucket = F.floor(F.col("child.lo") / width).alias("bucket")
        runs = several.groupBy("tree", "leaves", bucket).agg(F.array_sort(F.collect_list("child")).alias("children"))  # fan at most
        below = settle(
            runs.select(
                "tree",
                "leaves",
                F.col("children")[0]["lo"].alias("lo"),
                F.element_at("children", -1)["hi"].alias("hi"),
                F.sha2(F.array_join(F.transform("children", lambda c: c["digest"]), ""), 256).alias("digest"),
                "children",
            )
        )
        levels.append(below)
    return levels


def _tops(leaves: DataFrame, levels: Sequence[DataFrame], fan: int) -> DataFrame:
    """The one node on the highest level of each tree: ``tree`` and ``digest``."""
    tops = leaves.where(F.col("leaves") == 1).select("tree", "digest")
    for k, level in enumerate(levels, start=1):
        tops = tops.unionByName(level.where(F.col("leaves") <= fan**k).select("tree", "digest"))
    return tops


def _with_paths(leaves: DataFrame, levels: Sequence[DataFrame], above: DataFrame, fan: int) -> DataFrame:
    """``leaves`` with ``top``, the digest of their tree's highest node, and ``path``, the siblings from leaf to root.

    ``above`` has ``tree``, ``top`` and the ``path`` that goes on from the tree's highest node.
    """
    parents = None
    for k in range(len(levels), -1, -1):
        nodes = levels[k - 1] if k else leaves
        highest = nodes.where(F.col("leaves") <= fan**k).join(above, "tree")
        if parents is None:
            parents = highest
            continue
        width = fan ** (k + 1)
        up = parents.select(
            F.col("tree").alias("_tree"),
            F.floor(F.col("lo") / width).alias("_bucket"),
            F.col("lo").alias("_lo"),
            F.col("hi").alias("_hi"),
            F.col("children").alias("_children"),
            "top",
            F.col("path").alias("_path"),
        )
        node = nodes.where(F.col("leaves") > fan**k)
        inside = (F.col("tree") == F.col("_tree")) & (F.floor(F.col("lo") / width) == F.col("_bucket"))
        inside = inside & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
        before = F.filter("_children", lambda c: c["hi"] <= F.col("lo"))  # what the interval of the parent has besides
        after = F.filter("_children", lambda c: c["lo"] >= F.col("hi"))
        own = F.struct(
            F.array_join(F.transform(before, lambda c: c["digest"]), "").alias("left"),
            F.array_join(F.transform(after, lambda c: c["digest"]), "").alias("right"),
        )
        met = node.join(up, inside).withColumn("path", F.concat(F.array(own), F.col("_path")))
        parents = met.drop("_tree", "_bucket", "_lo", "_hi", "_children", "_path").unionByName(highest)
    return parents


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    id: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
    fan: int = 8,
) -> DataFrame:
    """One row per document: its id, ``leaf``, ``subroot`` (of its group), ``root`` (of all), and ``path``.

    A leaf is the digest of the row's ``fields``. Within a group leaves stand in order of their id (null first; rows
    with equal ids by digest) and groups in bytewise order (null first, apart from an empty value). While several nodes
    remain, every ``fan`` consecutive ones become their joined digests' digest, the last run with fewer; a lone leaf is
    its group's root. ``path`` holds, from the leaf's level up to the root, the digests of the run's other nodes, as two
    strings ``left`` and ``right`` (empty for a run of one); ``fold(leaf, path)`` gives the root again. ``carry`` adds
    columns by name, computed from the documents' own. Null fields count as ``-``; texts of any length are one row.
    Repeated rows are leaves of their own. An empty table gives no rows; other columns are ignored.
    """
    carry = dict(carry or {})
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    extra = F.struct(*(c.alias(n) for n, c in carry.items())) if carry else F.lit(None).cast("int")
    rows = docs.select(key.alias("tree"), F.col(id).alias("place"), row_digest(*map(F.col, fields)).alias("digest"), extra.alias("extra"))
    leaves = _ranked(rows)
    levels = _grown(leaves, fan)

    # The groups' roots are the leaves of one more tree, named by the empty string.
    subroots = _tops(leaves, levels, fan)
    groups = _ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("place"), "digest"))
    upper = _grown(groups, fan)
    end = _tops(groups, upper, fan).select("tree", F.col("digest").alias("top"), F.array().cast(PATH).alias("path"))
    above = _with_paths(groups, upper, end, fan).select(
        F.col("place").alias("tree"), F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"), "path"
    )
    done = _with_paths(leaves, levels, settle(above), fan)
    return done.select(
        F.col("place").alias(id),
        F.col("digest").alias("leaf"),
        "top.subroot",
        "top.root",
        "path",
        *(F.col(f"extra.{n}").alias(n) for n in carry),
    )

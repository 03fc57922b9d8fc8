"""Merkle manifest of a dataset: digest-to-children records, and proofs by descent from the root."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, session

#: Children of a node.
RUN = 8
#: Name of the one tree over all trees.
TOP = ""
_PATH = "array<struct<left:string, right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one behind the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value that cannot be taken for another beside its neighbours: ``-`` for null, else bytes, colon, text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def tree_name(value: Column) -> Column:
    """A null-free name per value of the tree column, in the values' order with null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path (from the leaf up) amount to."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


@dataclass(frozen=True)
class Manifest:
    """``records`` (level, digest, children), ``leaves`` (tree, rank, leaf and what came with them) and ``trees`` (tree,
    place, depth, subroot); ``depth`` and ``top_depth`` are the levels of the deepest tree and of the tree over all trees."""

    records: DataFrame
    top_records: DataFrame
    leaves: DataFrame
    trees: DataFrame
    top: DataFrame
    depth: int
    top_depth: int


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows (tree, ...)`` with ``rank``, their place in their tree from 0, and ``width``, the tree's number of rows.

    Rows are sorted into ranges, counted per range and tree, and each range starts from the counts before it, so
    a tree with most of the rows is many ranges. Rows that are equal in all of ``order`` come from
    several input tasks and are spread by these.
    """
    sort = ["tree", *order, "input_task"]
    spread = rows.withColumn("input_task", F.spark_partition_id()).repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = kept(spread.drop("input_task").withColumn("at", F.monotonically_increasing_id()), "leaves")
    part = F.shiftrightunsigned("at", 33)
    counts = placed.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    upto = F.expr("sum(n) OVER (PARTITION BY tree ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n")
    width = F.expr("sum(n) OVER (PARTITION BY tree)").alias("width")
    starts = kept(counts.select("tree", "part", (upto - F.col("first")).alias("shift"), width), "starts")
    found = placed.withColumn("part", part).join(starts, ["tree", "part"])
    return found.withColumn("rank", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _levels(nodes: DataFrame, depth: int, name: str) -> tuple[DataFrame, DataFrame]:
    """``(records, roots)`` of all trees in ``nodes (tree, idx, width, digest)``, one grouping per level.

    Eight consecutive nodes become one, until a tree has one node: it is the tree's root and takes no part
    in further levels. Records are kept once per digest.
    """
    records = nodes.sparkSession.createDataFrame([], "level int, digest string, children array<string>")
    roots = nodes.filter("width = 1").select("tree", F.lit(0).alias("depth"), "digest")
    for level in range(1, depth + 1):
        run = nodes.filter("width > 1").groupBy("tree", F.expr(f"idx div {RUN}").alias("idx"))
        grouped = run.agg(F.sort_array(F.collect_list(F.struct("idx", "digest")))["digest"].alias("children"), F.max("width").alias("width"))
        digest_of = F.sha2(F.array_join("children", ""), 256).alias("digest")
        nodes = kept(grouped.select("tree", "idx", F.ceil(F.col("width") / RUN).alias("width"), digest_of, "children"), f"{name}-{level}")
        once = kept(nodes.groupBy("digest").agg(F.first("children").alias("children")), f"{name}-records-{level}")
        records = records.unionAll(once.select(F.lit(level).alias("level"), "digest", "children"))
        roots = roots.unionAll(nodes.filter("width = 1").select("tree", F.lit(level).alias("depth"), "digest"))
    return records, roots


def _depth(width: int | None) -> int:
    """Levels until ``width`` nodes are one."""
    depth, left = 0, width or 1
    while left > 1:
        depth, left = depth + 1, -(-left // RUN)
    return depth


def build(leaves: DataFrame, order: Sequence[str]) -> Manifest:
    """The manifest of ``leaves (tree, leaf, ...)``: within a tree they ascend by ``order``, then by leaf.

    Trees ascend by name; their roots are the leaves of the tree over all trees. Nulls in ``order`` come first. Rows that
    are equal in all columns are leaves of their own; equal subtrees share one record. An empty table has no trees.
    """
    session(leaves.sparkSession)
    placed = ranked(leaves, [*order, "leaf"])
    width = placed.agg(F.max("width")).first()[0]
    depth = _depth(width)
    records, roots = _levels(placed.select("tree", F.col("rank").alias("idx"), "width", F.col("leaf").alias("digest")), depth, "nodes")
    roots = kept(roots, "roots").withColumnsRenamed({"tree": "name", "digest": "subroot"}).withColumn("tree", F.lit(TOP))
    trees = kept(ranked(roots, ["name"]), "trees")
    top_depth = _depth(trees.agg(F.max("width")).first()[0])
    top_records, top = _levels(trees.select("tree", F.col("rank").alias("idx"), "width", F.col("subroot").alias("digest")), top_depth, "top")
    trees = trees.select(F.col("name").alias("tree"), F.col("rank").alias("place"), F.col("depth").cast("int").alias("depth"), "subroot")
    return Manifest(records, top_records, placed, trees, top.select(F.col("digest").alias("root")), depth, top_depth)


def _segment(children: Column, digit: Column) -> Column:
    """The unselected children: those left and those right of ``digit``."""
    rest = F.slice(children, digit + 2, F.lit(RUN))
    return F.struct(F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"), F.array_join(rest, "").alias("right"))


def _opened(frontier: DataFrame, records: DataFrame, level: int) -> DataFrame:
    """The nodes of ``frontier`` that stand at ``level``, with their children."""
    return frontier.filter(F.col("level") == level).join(records.filter(F.col("level") == level).drop("level"), "digest")


def _down(opened: DataFrame, level: int) -> DataFrame:
    """One step down from opened nodes: every child with the path to it, the root's segment first."""
    kept_columns = [c for c in opened.columns if c not in ("digest", "children", "idx", "level", "path")]
    found = opened.select(*kept_columns, "idx", "path", "children", F.posexplode("children").alias("digit", "digest"))
    return found.select(
        *kept_columns,
        (F.col("idx") * RUN + F.col("digit")).alias("idx"),
        "digest",
        F.lit(level - 1).alias("level"),
        F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"),
    )


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """``requests (tree, rank, ...)``, or all leaves with what came with them, with ``leaf, subroot, root`` and ``path``: siblings left and right, from the leaf up.

    Requests descend together. They start at the root; a node's record names its children, the digit of the rank in base
    eight selects one, the others are added to the path. Requests with the same digits so far are one row of the
    frontier, and the leaves of one parent are only told apart in the last step, so what is
    moved is about an eighth of the requests with their paths. Nodes that no request passes are left out at
    each level. Finally paths are reversed.

    A rank or tree that is not there has no row. Repeated requests are each answered. No requests: no rows.
    """
    if requests is not None:  # each leaf is looked up once, however often it is asked for
        own = {"own_tree": F.col("tree"), "own_rank": F.col("rank")}
        found = _descend(manifest, requests.select("tree", "rank").distinct().withColumns(own), False)
        return requests.join(found.withColumnsRenamed({"own_tree": "tree", "own_rank": "rank"}), ["tree", "rank"]).drop("tree", "rank")
    return _descend(manifest, manifest.leaves.drop("leaf", "width"), True)


def _descend(manifest: Manifest, requests: DataFrame, everything: bool) -> DataFrame:
    """``prove`` for distinct ``requests``, whose other columns are passed on."""
    payload = [c for c in requests.columns if c not in ("tree", "rank")]
    frontier = manifest.top.select(
        "root", F.lit(0).cast("long").alias("idx"), F.col("root").alias("digest"), F.lit(manifest.top_depth).alias("level"), F.array().cast(_PATH).alias("path")
    )
    for level in range(manifest.top_depth, 0, -1):
        frontier = _down(_opened(frontier, manifest.top_records, level), level)
    at_trees = kept(frontier.select("root", F.col("idx").alias("place"), "path").join(manifest.trees, "place"), "frontier")

    def trees_of(depth: int) -> DataFrame:
        """Trees whose root stands at this level, with the path to it."""
        own = at_trees.filter(F.col("depth") == depth)
        return own.select("tree", "root", "subroot", F.lit(0).cast("long").alias("idx"), F.col("subroot").alias("digest"), F.col("depth").alias("level"), "path")

    frontier = trees_of(manifest.depth)
    for level in range(manifest.depth, 1, -1):
        below = _down(_opened(frontier, manifest.records, level), level)
        if not everything:
            wanted = requests.select("tree", F.expr(f"rank div {RUN ** (level - 1)}").alias("idx")).distinct()
            below = below.join(wanted, ["tree", "idx"], "left_semi")
        frontier = below.unionByName(trees_of(level - 1))
        if level > 2:
            frontier = kept(frontier, "frontier")

    asked = requests.groupBy("tree", F.expr(f"rank div {RUN}").alias("idx")).agg(
        F.collect_list(F.struct((F.col("rank") % RUN).cast("int").alias("digit"), *payload)).alias("asked")
    )
    parents = _opened(frontier if manifest.depth else trees_of(1), manifest.records, 1)
    found = parents.join(asked, ["tree", "idx"]).select("root", "subroot", "path", "children", F.explode("asked").alias("one"))
    within = found.filter(F.col("one.digit") < F.size("children")).select(
        F.expr("children[one.digit]").alias("leaf"),
        "subroot",
        "root",
        F.concat("path", F.array(_segment(F.col("children"), F.col("one.digit")))).alias("path"),
        *[F.col(f"one.{c}").alias(c) for c in payload],
    )
    lone = trees_of(0).join(requests.filter("rank = 0").drop("rank"), "tree")
    alone = lone.select(F.col("digest").alias("leaf"), "subroot", "root", "path", *payload)
    return within.unionByName(alone).withColumn("path", F.reverse("path"))


def proof_text(path: Column) -> Column:
    """All siblings of a path, from the leaf up and left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_of(text: Column | None = None) -> Column:
    """The leaf of a document row, or of the row with another text."""
    return digest(*[field(text if text is not None and c == "text" else F.col(c)) for c in FIELDS])


def verify_tampered(docs: DataFrame, tampered: Column, tampered_text: Column) -> DataFrame:
    """Per document its leaf, roots and proof, and whether the leaf it has after tampering still leads to the root.

    ``tampered`` marks the rows whose text becomes ``tampered_text``. Texts are read once, for both digests, and are not
    moved. Any column may be null, ids may repeat, empty and null texts differ, an empty table gives no rows, other columns are
    ignored.
    """
    session(docs.sparkSession)
    own = leaf_of()
    claimed = F.when(F.coalesce(tampered, F.lit(False)), leaf_of(tampered_text)).otherwise(own)
    leaves = docs.select(tree_name(F.col("lang")).alias("tree"), "doc_id", own.alias("leaf"), F.nullif(claimed, own).alias("claimed"))
    manifest = build(leaves, ["doc_id"])
    proven = prove(manifest)
    folded = fold(F.coalesce("claimed", "leaf"), F.col("path"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

"""Merkle manifest of a dataset: a root over all rows, and a proof of every row against it.

A row's leaf is the digest of its fields. The leaves of a group stand in key
order; every eight consecutive nodes become one until a group has one node, its
subroot, and the subroots, in group order, become the root in the same way.

Every level is built by one aggregation and stored as node rows, each linked to
its parent and holding the digests of its siblings on either side. Proofs come
from a recursive query: from each leaf it ascends to the parent, appends the
siblings and folds them with the hash so far, up to the root. The leaves of one
run have the same siblings from their parent upwards, so they ascend as one row
that appends once and folds each leaf's hash on its own.

No key of the ascent is hot: node rows are dealt by blocks of ``SPAN`` leaves, and
a node that stands above several blocks has a row in each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segrisk.operators.ranking import number_rows
from segrisk.session import stored

#: Consecutive nodes under one parent.
WIDTH = 8
#: Levels within a block, and its leaves.
DEPTH = 4
SPAN = WIDTH**DEPTH

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ASCEND = """
WITH RECURSIVE climb(tree, block, run, top, level, node, folded, proof) AS (
  SELECT tree, block, run, top, level, node, folded, proof FROM {start}
  UNION ALL
  SELECT c.tree, c.block, c.run, c.top, c.level + 1, n.up,
         transform(c.folded, h -> unhex(sha2(concat(lower(hex(n.before)), lower(hex(h)), lower(hex(n.after))), 256))),
         concat(c.proof, n.before, n.after)
  FROM climb c JOIN {nodes} n ON n.tree = c.tree AND n.block = c.block AND n.level = c.level AND n.node = c.node
  WHERE c.level < c.top
)
SELECT tree, run, folded, proof FROM climb WHERE level = top
"""


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as its size in UTF-8 bytes, a colon and its text, or ``-`` where it is null."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(part, fields))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _joined(hashes: Column) -> Column:
    """Binary digests of an array in a row, empty for none."""
    return F.aggregate(hashes, F.lit(b""), lambda a, h: F.concat(a, h))


def _hex(hashes: Column) -> Column:
    return F.lower(F.hex(hashes))


def _sides(members: Column, at: Column, name: str = "hash") -> tuple[Column, Column]:
    """The digests before and after place ``at`` of a family."""
    hashes = F.transform(members, lambda m: m[name])
    return _joined(F.slice(hashes, F.lit(1), at)), _joined(F.slice(hashes, at + 2, F.lit(WIDTH)))


def families(nodes: DataFrame) -> DataFrame:
    """Rows (tree, n, up, members) of nodes (tree, n, pos, hash): each parent with its children in order."""
    member = F.struct("pos", "hash")
    return nodes.groupBy("tree", "n", F.floor(F.col("pos") / WIDTH).alias("up")).agg(
        F.sort_array(F.collect_list(member)).alias("members")
    )


def parents(levels: DataFrame) -> DataFrame:
    """Nodes (tree, n, pos, hash) one level above."""
    joined = F.array_join(F.transform("members", lambda m: _hex(m["hash"])), "")
    return levels.select("tree", "n", F.col("up").alias("pos"), F.unhex(digest(joined)).alias("hash"))


def children(levels: DataFrame) -> DataFrame:
    """Node rows (tree, n, node, up, before, after) of every member of a family."""
    rows = levels.select("tree", "n", "up", "members", F.posexplode("members").alias("at", "m"))
    before, after = _sides(F.col("members"), F.col("at"))
    return rows.select("tree", "n", F.col("m.pos").alias("node"), "up", before.alias("before"), after.alias("after"))


def _sizes(n: int) -> list[int]:
    """Nodes of a tree of ``n`` leaves on every level."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // WIDTH))
    return out


def build(nodes: DataFrame, largest: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Families of every level above ``nodes``, and the top (tree, n, height, hash) of every tree.

    One aggregation a level, over an eighth of the rows of the level below; each level is stored.
    """
    levels: list[DataFrame] = []
    width = F.lit(1).cast("long")
    tops = nodes.filter(F.col("n") == 1).select("tree", "n", F.lit(0).alias("height"), "hash")
    for height in range(1, len(_sizes(largest))):
        # Trees that have more than one node on the level below.
        levels.append(stored(families(nodes.filter(F.col("n") > width)), f"{name}{height}"))
        nodes = parents(levels[-1])
        at_top = (F.col("n") > width) & (F.col("n") <= WIDTH**height)
        tops = tops.unionByName(nodes.filter(at_top).select("tree", "n", F.lit(height).alias("height"), "hash"))
        width = F.lit(WIDTH**height).cast("long")
    return levels, stored(tops, f"{name}_tops")


def _blocks(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first.cast("long"), last.cast("long")))


def _in_blocks(rows: DataFrame, level: int) -> DataFrame:
    """A node row in every block that its node stands in or above."""
    node, last = F.col("node"), F.floor((F.col("n") - 1) / SPAN)
    if level <= DEPTH:
        own = F.floor(node / WIDTH ** (DEPTH - level))
        return rows.withColumns({"level": F.lit(level), "block": own})
    under = WIDTH ** (level - DEPTH)
    return rows.withColumn("level", F.lit(level)).withColumn("block", _blocks(node * under, F.least((node + 1) * under - 1, last)))


def ascend(spark: SparkSession, start: DataFrame, nodes: DataFrame) -> DataFrame:
    """The recursive query, written to the shared folder while its limit on rows is off."""
    setting = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "-1")
    try:
        return stored(spark.sql(ASCEND, start=start, nodes=nodes), "ascent")
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def manifest(leaves: DataFrame) -> DataFrame:
    """Manifest of ``leaves`` (group, key, leaf, tampered): digests as hexadecimal text.

    Result: key, leaf, subroot, root, proof_sha256, folded_root, verified; one
    row per row. ``tampered`` is the leaf to be folded instead of ``leaf``.
    Groups come in order, null first; within a group rows stand by key, null
    first, and rows of equal keys by leaf. An empty table gives an empty result.
    """
    spark = leaves.sparkSession
    order = [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf").asc()]
    packed = leaves.select("group", "key", F.unhex("leaf").alias("leaf"), F.unhex("tampered").alias("tampered"))
    numbered = number_rows(packed, order, "_number")
    groups = numbered.groupBy("group").agg(F.min("_number").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = number_rows(groups, [F.col("first").asc()], "tree").withColumn("tree", F.col("tree") - 1)
    counted = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    n_trees, largest = counted[0], counted[1] or 0
    place = numbered["group"].eqNullSafe(trees["group"])
    placed = numbered.join(trees, place).select(
        "tree", "n", (F.col("_number") - F.col("first")).alias("pos"), "key", "leaf", "tampered"
    )
    member = F.struct("pos", "key", F.col("leaf").alias("hash"), "tampered")
    runs = placed.groupBy("tree", "n", F.floor(F.col("pos") / WIDTH).alias("up")).agg(
        F.sort_array(F.collect_list(F.struct("pos", member.alias("m")))).alias("members")
    )
    runs = stored(runs.withColumn("members", F.transform("members", lambda x: x["m"])), "runs")

    # The lowest level stands in the runs; the levels above are built from their parents.
    ones = runs.filter("n = 1").select("tree", "n", F.lit(0).alias("height"), F.get("members", F.lit(0))["hash"].alias("hash"))
    above = parents(runs.filter("n > 1")).withColumnRenamed("n", "leaves").withColumn("n", F.ceil(F.col("leaves") / WIDTH))
    levels, tops = build(above.select("tree", "n", "pos", "hash"), -(-largest // WIDTH), "level")
    subroots = ones.select("tree", "height", "hash").unionByName(tops.select("tree", (F.col("height") + 1).alias("height"), "hash"))
    heads = subroots.select(F.lit(0).alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("pos"), "hash")
    upper, last = build(heads, n_trees, "upper")
    root = last.select(_hex(F.col("hash"))).first()
    known = stored(trees.select("tree", "n").join(subroots, "tree"), "trees")

    rows = [
        _in_blocks(children(level).join(known.select("tree", F.col("n").alias("_n")), "tree").drop("n").withColumnRenamed("_n", "n"), k + 1)
        for k, level in enumerate(levels)
    ]
    all_blocks = _blocks(F.lit(0), F.floor((F.col("n") - 1) / SPAN))
    for j, level in enumerate(upper):
        above_tree = known.withColumn("_pos", F.floor(F.col("tree") / WIDTH**j))
        linked = above_tree.join(children(level).select(F.col("node").alias("_pos"), "up", "before", "after"), "_pos")
        node = F.lit(0).cast("long") if j == 0 else F.col("_pos")
        rows.append(
            linked.select("tree", "n", node.alias("node"), "up", "before", "after", (F.col("height") + j).alias("level"), all_blocks.alias("block"))
        )
    names = ["tree", "block", "level", "node", "up", "before", "after"]
    kinds = "tree long, block long, level int, node long, up long, before binary, after binary"
    nodes = spark.createDataFrame([], kinds)
    for part in rows:
        nodes = nodes.unionByName(part.select(names))

    lone = F.col("n") == 1
    tampered = F.transform("members", lambda m: m["tampered"])

    def folded(m: Column, i: Column) -> Column:
        before, after = _sides(F.col("members"), i)
        return F.unhex(digest(_hex(before), _hex(m["tampered"]), _hex(after)))

    with_top = runs.join(known.select("tree", (F.col("height") + len(upper)).cast("int").alias("top")), "tree")
    start = with_top.select(
        "tree",
        F.floor(F.col("up") / (SPAN // WIDTH)).alias("block"),
        F.col("up").alias("run"),
        "top",
        F.when(lone, 0).otherwise(1).alias("level"),
        F.col("up").alias("node"),
        F.when(lone, tampered).otherwise(F.transform("members", folded)).alias("folded"),
        F.lit(b"").alias("proof"),
    )
    climbed = ascend(spark, start, stored(nodes, "nodes"))
    found = (
        climbed.withColumnRenamed("run", "up")
        .join(runs.drop("n"), ["tree", "up"])
        .join(known.select("tree", _hex(F.col("hash")).alias("subroot")), "tree")
        .select("subroot", "folded", "proof", "members", F.posexplode("members").alias("at", "m"))
    )
    before, after = _sides(F.col("members"), F.col("at"))
    return found.select(
        F.col("m.key").alias("key"),
        _hex(F.col("m.hash")).alias("leaf"),
        "subroot",
        F.lit(root[0] if root else None).cast("string").alias("root"),
        digest(_hex(before), _hex(after), _hex(F.col("proof"))).alias("proof_sha256"),
        _hex(F.get("folded", F.col("at"))).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def document_manifest(docs: DataFrame, tampered: Column, text: str = "text") -> DataFrame:
    """Manifest of ``documents`` rows by language; rows where ``tampered`` holds are folded with their text in lower case.

    Fields of a leaf: doc_id, source, lang, n_chars and text, whole. Nulls are
    marked in the leaf, null languages are a group, rows may repeat, and other
    columns are not used.
    """
    names = ["doc_id", "source", "lang", "n_chars"]
    leaf = leaf_digest([*map(F.col, names), F.col(text)])
    changed = leaf_digest([*map(F.col, names), lower_ascii(F.col(text))])
    return manifest(
        docs.select(
            F.col("lang").alias("group"),
            F.col("doc_id").alias("key"),
            leaf.alias("leaf"),
            F.when(tampered, changed).otherwise(leaf).alias("tampered"),
        )
    ).withColumnRenamed("key", "doc_id")

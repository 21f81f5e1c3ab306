"""Merkle manifest: one tree a source, a tree over the sources' roots, and proofs by a recursive query.

A digest is the lowercase hex SHA-256 of its inputs, concatenated; digests go in as hex text. A row's leaf
is the digest of the chosen columns, each ``-`` if null, else its number of UTF-8 bytes, ``:`` and
its text. The leaves of a tree stand in the order of their ids; every ``ARITY`` neighbours become
one node of the next level, also the last run, which may be shorter, until one node is left.

The levels are stored as pages: one row holds a node's descendants of the ``HEIGHT`` levels below it and
names the page in which that node itself is found, so rows are linked to their parents. A recursive query
climbs these links for every leaf at once: each step joins the leaves with their pages, appends the
siblings met there and folds the leaf's digest upwards. A page near the root has all leaves below it,
so it is repeated for each ``BLOCK`` of neighbouring leaves; no key of the join has more rows than that,
and all copies together are a small share of the leaves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.ordering import numbered
from topicloom.session import saved

ARITY = 3
HEIGHT = 4  # levels of a page
PAGE = ARITY**HEIGHT  # nodes of its lowest level
BLOCK = 512  # leaves that share a copy of a page
TOP = -1  # the tree over the other trees' roots

ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """The digest of a row's columns in the given order."""
    parts = []
    for column in columns:
        text = column.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _blocks(first: str, last: Column) -> Column:
    """A row for each block that the numbers from ``first`` to ``last`` touch."""
    return F.explode(F.sequence(F.floor(F.col(first) / BLOCK), F.floor(last / BLOCK)))


def numbered_leaves(
    docs: DataFrame, tree: Column, order: Column, leaf: Column, claimed: Column
) -> DataFrame:
    """The leaves with their number ``g`` over all trees and ``tree``, ``rank`` and ``count`` in their own.

    Trees are numbered in the order of their names, null first. Equal ids are told apart by their leaf;
    equal leaves are the same anywhere.
    """
    rows = docs.select(
        tree.alias("name"), order.alias("id"), F.unhex(leaf).alias("leaf"),
        F.unhex(claimed).alias("claimed"),
    )
    sort = [F.asc_nulls_first("name"), F.asc_nulls_first("id"), F.asc("leaf"), F.asc("claimed")]
    leaves = saved(numbered(rows, sort, "g", "leaves"), "numbered_leaves")
    spans = leaves.groupBy("name").agg(F.min("g").alias("first"), F.count("*").alias("count"))
    trees = saved(numbered(spans, [F.asc("first")], "tree", "trees"), "numbered_trees")
    # A tree may hold a third of all leaves, so leaves meet their tree block by block.
    last = F.col("first") + F.col("count") - 1
    by_block = trees.select(
        F.col("name").alias("of"), "first", "count", "tree", _blocks("first", last).alias("in")
    )
    found = leaves.withColumn("block", F.floor(F.col("g") / BLOCK)).join(
        by_block, (F.col("block") == F.col("in")) & F.col("name").eqNullSafe(F.col("of"))
    )
    rank = (F.col("g") - F.col("first")).alias("rank")
    return saved(found.select("g", "id", "leaf", "claimed", "tree", rank, "count"), "leaves")


def _up(level: Column) -> Column:
    """The next level: every ``ARITY`` neighbours, and what is left, as one digest."""
    last = F.floor((F.size(level) - 1) / ARITY).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda k: F.sha2(F.array_join(F.slice(level, k * ARITY + 1, F.lit(ARITY)), ""), 256),
    )


def _pages(nodes: DataFrame, level: int) -> DataFrame:
    """The pages over the nodes ``tree, pos, digest, first, last, count`` of trees that have several."""
    page = F.floor(F.col("pos") / PAGE).alias("page")
    bag = F.sort_array(F.collect_list(F.struct("pos", "digest")))
    rows = nodes.groupBy("tree", "count", page).agg(
        F.transform(bag, lambda n: n["digest"]).alias("l0"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    )
    alone = F.col("count") <= PAGE  # the only page of its level: it ends at one node
    for k in range(1, HEIGHT + 1):
        below = F.col(f"l{k - 1}")
        rows = rows.withColumn(f"l{k}", F.when(alone & (F.size(below) == 1), below).otherwise(_up(below)))
    kept = [F.when(~alone | (F.size(f"l{k}") > 1), F.col(f"l{k}")) for k in range(HEIGHT)]
    return rows.select(
        "tree", F.lit(level).alias("level"), "page", "first", "last", "count",
        F.array_compact(F.array(*kept)).alias("levels"),
        F.col(f"l{HEIGHT}")[0].alias("digest"), alone.alias("ends"),
    )


def _tree_pages(nodes: DataFrame, most: int, name: str) -> DataFrame:
    """All pages of trees with up to ``most`` leaves; trees with one leaf have none."""
    found, level = None, 0
    nodes = nodes.where(F.col("count") > 1)
    while level == 0 or most > 1:
        pages = saved(_pages(nodes, level), f"{name}_{level}")
        found = pages if found is None else found.unionByName(pages)
        nodes = pages.where(~F.col("ends")).select(
            "tree", F.col("page").alias("pos"), "digest", "first", "last",
            F.ceil(F.col("count") / PAGE).alias("count"),
        )
        most, level = -(-most // PAGE), level + 1
    return found


def stored_pages(leaves: DataFrame) -> tuple[DataFrame, str | None, int]:
    """The pages of all trees with links to their parents, the root digest (None without leaves) and the
    number of trees.

    Of the trees only that number, the largest number of leaves and the root reach the driver.
    """
    hexed = F.lower(F.hex("leaf"))
    nodes = leaves.select(
        "tree", F.col("rank").alias("pos"), hexed.alias("digest"), F.col("g").alias("first"),
        F.col("g").alias("last"), "count",
    )
    size = leaves.agg(F.max("count").alias("most"), F.max("tree").alias("last")).first()
    pages = _tree_pages(nodes, size.most or 0, "pages")
    roots = pages.where("ends").select("tree", "digest", "first", "last").unionByName(
        nodes.where("count = 1").select("tree", "digest", "first", "last")
    )
    trees = (size.last if size.last is not None else -1) + 1
    tops = roots.select(
        F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "digest", "first", "last",
        F.lit(trees).cast("bigint").alias("count"),
    )
    tops = saved(tops, "roots")
    above = _tree_pages(tops, trees, "top_pages")
    top = (above.where("ends") if trees > 1 else tops).select("digest").first()
    inside = F.lit(trees > 1) & (F.col("tree") != TOP)  # the tree's own root goes on in the top tree
    ends = F.col("ends")
    linked = pages.unionByName(above).select(
        "tree", "level", "page", "first", "last", "levels",
        F.when(ends, F.unhex("digest")).alias("made"),
        F.when(~ends, F.col("tree")).when(inside, F.lit(TOP).cast("bigint")).alias("up_tree"),
        F.when(~ends, F.col("level") + 1).when(inside, F.lit(0)).alias("up_level"),
        F.when(~ends, F.col("page")).when(inside, F.col("tree")).alias("up_pos"),
    )
    return linked, top.digest if top else None, trees


# Each step emits a row per leaf with the siblings of one page; ``made`` is the root of a tree that ends.
CLIMB = """
WITH RECURSIVE climb (g, step, tree, level, pos, folded, siblings, made, id, leaf) AS (
  SELECT g, 0,
         CASE WHEN count > 1 THEN tree WHEN {trees} > 1 THEN CAST({top} AS BIGINT) END, 0,
         CASE WHEN count > 1 THEN rank ELSE tree END,
         claimed, CAST('' AS BINARY), CASE WHEN count = 1 THEN leaf END, id, leaf
  FROM {leaves}
  UNION ALL
  SELECT g, step + 1, up_tree, up_level, up_pos, unhex(run.digest), unhex(run.siblings), root,
         CAST(NULL AS {id_type}), CAST(NULL AS BINARY)
  FROM (
    SELECT c.g, c.step, p.up_tree, p.up_level, p.up_pos,
           CASE WHEN p.tree <> {top} THEN p.made END AS root,
           aggregate(
             p.levels,
             named_struct('digest', lower(hex(c.folded)), 'siblings', '',
                          'at', CAST(c.pos % {page} AS INT)),
             (below, nodes) -> named_struct(
               'digest', sha2(concat(array_join(slice(nodes, below.at - below.at % 3 + 1, below.at % 3), ''),
                                     below.digest,
                                     array_join(slice(nodes, below.at + 2, 2 - below.at % 3), '')), 256),
               'siblings', concat(below.siblings,
                                  array_join(slice(nodes, below.at - below.at % 3 + 1, below.at % 3), ''),
                                  array_join(slice(nodes, below.at + 2, 2 - below.at % 3), '')),
               'at', CAST(floor(below.at / 3) AS INT))) AS run
    FROM climb c JOIN {pages} p
      ON c.tree = p.tree AND c.level = p.level AND floor(c.pos / {page}) = p.page
         AND floor(c.g / {block}) = p.block
  )
)
SELECT g, step, folded, siblings, made, id, leaf FROM climb
"""


def climbed(leaves: DataFrame, pages: DataFrame, trees: int) -> DataFrame:
    """A row per leaf and page on its way up, the leaf itself being step 0."""
    spark = leaves.sparkSession
    repeated = pages.withColumn("block", _blocks("first", F.col("last"))).drop("first", "last")
    steps = spark.sql(
        CLIMB.replace("{top}", str(TOP)).replace("{page}", str(PAGE)).replace("{block}", str(BLOCK))
        .replace("{trees}", str(trees)).replace("{id_type}", leaves.schema["id"].dataType.simpleString()),
        leaves=leaves, pages=saved(repeated, "page_copies"),
    )
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")  # the recursion ends at the roots, whatever the number of leaves
    try:
        return saved(steps, "climb")
    finally:
        spark.conf.set(ROW_LIMIT, before)


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    tree_col: str = "source",
    id_col: str = "doc_id",
    claimed: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs`` with its proof, and whether the row as claimed leads to the root.

    The leaf is the digest of ``columns``; the trees are the values of ``tree_col``, of which null is one.
    ``claimed`` are the columns as somebody else holds them, by default the same. Columns: the id, ``leaf``,
    ``subroot`` (of its tree), ``root`` (of all), ``proof_sha256`` (digest of all siblings from the
    leaf to the root, in a run from left to right), ``folded_root`` (folded from the claimed leaf and those
    siblings), ``verified``.

    Rows with a null id come first in their tree. Rows that repeat an id are leaves of their own, in the
    order of their digests; of rows alike in all ``columns`` each is one. A null or empty text is a leaf
    like any other. No rows give no rows. Other columns are not looked at, whatever their names.
    """
    own = leaf_digest([F.col(f"`{c}`") for c in columns])
    other = own if claimed is None else leaf_digest(claimed)
    leaves = numbered_leaves(docs, F.col(f"`{tree_col}`"), F.col(f"`{id_col}`"), own, other)
    pages, root, trees = stored_pages(leaves)
    steps = climbed(leaves, pages, trees)
    way = F.sort_array(F.collect_list(F.struct("step", "siblings", "folded")))
    proofs = steps.groupBy("g").agg(
        way.alias("way"), F.max("id").alias("id"), F.max("leaf").alias("leaf"),
        F.max("made").alias("subroot"),
    )
    siblings = F.aggregate(
        "way", F.lit(""), lambda text, step: F.concat(text, F.lower(F.hex(step["siblings"])))
    )
    found = proofs.select(
        F.col("id").alias(id_col),
        F.lower(F.hex("leaf")).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        F.lit(root).cast("string").alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        F.lower(F.hex(F.element_at("way", -1)["folded"])).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))

"""A Merkle manifest of a table, and a climb that folds changed rows up to the root.

Method. Leaves are ranked per tree (a language) and hashed in runs of ``ARITY`` until one node is
left, the subroot; subroots make a last tree. All built levels are stored as rows that name their
parent, their place in it and the hashes of their own children. A recursive query then ascends:
each step joins the parent's row, appends the siblings to the proof and folds the hash that comes
from below. The leaves of a run have all siblings above the run in common, so they climb in one
row, which holds one folded hash for each of them; what sets them apart, the siblings inside the
run, is put in front of the proof at the end. The row limit of recursive queries is lifted while
the climb runs, since the climb grows with the table, and restored after it.

Scale. Ranks come from a range partitioning of the narrow leaves (no text), stored with the number
of its partition: a row's rank is its place in its partition plus the sizes of those before it. No
window holds more than a range, whatever share of the rows a tree has. Nodes above the leaves are
a seventh of their number; the driver gets three numbers (most leaves of a tree, trees, limit).

Cases. A null column is ``-``, so it differs from an empty text. Rows with equal tree and id are
ordered by their hash; rows equal in all columns are leaves of their own. A tree of one leaf has
that leaf as subroot, a table of one tree its subroot as root, and a lone row an empty proof. An
empty table gives an empty one. Texts are hashed whole. Further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_remainder, stored

ARITY = 8
DIGEST = 64             # hex digits
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**changed: Column) -> Column:
    """Hash of a row: its columns, each with its byte count; ``changed`` replaces columns."""
    return _hash(*[_field(changed.get(c, F.col(c))) for c in COLUMNS])


def ranked(rows: DataFrame, group: list[str], order: list[str], rank: str, name: str) -> DataFrame:
    """``rows`` (a stored table) with ``rank`` from 0 in their group, ordered by ``order``; nulls come first."""
    placed = stored(rows.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()), name)
    sizes = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    over = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy("_part")
    ahead = sizes.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(group)], F.col("_part").alias("_p"),
                         (F.sum("_n").over(over) - F.col("_n")).alias("_ahead"))
    own = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order)) - 1
    same = (F.col("_part") == F.col("_p"))
    for k, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    return placed.withColumn("_own", own).join(ahead, same).withColumn(rank, F.col("_ahead") + F.col("_own")).select(*rows.columns, rank)


def _node(tree: Column, level: int, index: Column) -> Column:
    return F.concat_ws(".", tree.cast("string"), F.lit(str(level)), index.cast("string"))


def _link(tree: Column, n: Column, level: int, index: Column, trees: int) -> tuple[Column, Column]:
    """Parent and place in it of node ``index`` at ``level`` of a tree with ``n`` leaves."""
    inside = n > ARITY ** level
    above = _node(F.lit("top"), 1, F.floor(tree / ARITY)) if trees > 1 else F.lit(None).cast("string")
    place = F.when(inside, index % ARITY).otherwise(tree % ARITY if trees > 1 else F.lit(0))
    return F.when(inside, _node(tree, level + 1, F.floor(index / ARITY))).otherwise(above), place.cast("int")


def _level(below: DataFrame, keep: list[str]) -> DataFrame:
    """Nodes of the next level: children in order, and their hash."""
    children = F.array_sort(F.collect_list(F.struct("index", "hash")))
    return below.groupBy(*keep, F.floor(F.col("index") / ARITY).alias("index")).agg(
        F.array_join(F.transform(children, lambda c: c["hash"]), "").alias("children")
    ).withColumn("hash", F.sha2("children", 256))


def manifest(documents: DataFrame, tampered: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs of leaves, the nodes above them, and the subroots.

    ``tampered`` is the leaf hash of a row after the change that the climb is to find, the row's
    own where nothing changed.
    Runs have ``run`` (their id), ``parent``, ``place``, ``tree``, ``hash`` and ``leaves``, up to
    ``ARITY`` structs of ``index, doc_id, leaf, tampered``. Nodes have ``id, parent, place, hash``
    and ``children``, the joined hashes below. Subroots have ``tree, subroot``.
    """
    leaves = stored(documents.select("lang", "doc_id", leaf_hash().alias("leaf"), tampered.alias("tampered")), "leaves")
    langs = stored(leaves.groupBy("lang").agg(F.count("*").alias("n")), "langs")
    trees = ranked(langs, [], ["lang"], "tree", "langorder")
    trees = stored(trees, "trees")
    top, widest = trees.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    placed = ranked(leaves, ["lang"], ["doc_id", "leaf"], "index", "leaforder")
    named = trees.select(F.col("lang").alias("_lang"), "tree", "n")
    placed = placed.join(named, F.col("lang").eqNullSafe(F.col("_lang"))).drop("lang", "_lang")
    tree, n, index = F.col("tree"), F.col("n"), F.col("index")
    runs = placed.groupBy("tree", "n", F.floor(index / ARITY).alias("run_index")).agg(
        F.array_sort(F.collect_list(F.struct("index", "doc_id", "leaf", "tampered"))).alias("leaves"))
    up, place = _link(tree, n, 1, F.col("run_index"), top)
    lone_up, lone_place = _link(tree, n, 0, F.lit(0), top)
    hashes = F.array_join(F.transform("leaves", lambda x: x["leaf"]), "")
    runs = stored(runs.select(
        "tree", "n", "leaves", _node(tree, 1, F.col("run_index")).alias("run"), F.col("run_index").alias("index"),
        F.when(n > 1, up).otherwise(lone_up).alias("parent"), F.when(n > 1, place).otherwise(lone_place).alias("place"),
        F.when(n > 1, F.sha2(hashes, 256)).otherwise(F.col("leaves")[0]["leaf"]).alias("hash")), "runs")
    below, levels, level = runs.select("tree", "n", "index", "hash"), [], 1
    roots = [below.filter(n <= ARITY).select("tree", "hash")]
    while ARITY ** level < widest:
        # Trees that have more than one node at this level.
        built = _level(below.filter(n > ARITY ** level), ["tree", "n"])
        level += 1
        parent, place = _link(tree, n, level, index, top)
        levels.append(stored(built.select("tree", "n", "index", "hash", "children", _node(tree, level, index).alias("id"),
                                          parent.alias("parent"), place.alias("place")), f"level{level}"))
        below = levels[-1].select("tree", "n", "index", "hash")
        roots.append(below.filter(n <= ARITY ** level).select("tree", "hash"))
    nodes = [x.select("id", "parent", "place", "hash", "children") for x in levels]
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.union(more)
    subroots = stored(subroots.select("tree", F.col("hash").alias("subroot")), "subroots")
    below, level = subroots.select(F.col("tree").alias("index"), F.col("subroot").alias("hash")), 0
    while ARITY ** level < top:
        level += 1
        last = ARITY ** level >= top
        parent = F.lit(None).cast("string") if last else _node(F.lit("top"), level + 1, F.floor(index / ARITY))
        built = stored(_level(below, []).select("index", "hash", "children", _node(F.lit("top"), level, index).alias("id"),
                                                parent.alias("parent"), (index % ARITY).cast("int").alias("place")), f"top{level}")
        nodes.append(built.select("id", "parent", "place", "hash", "children"))
        below = built.select("index", "hash")
    empty = documents.sparkSession.createDataFrame([], "id string, parent string, place int, hash string, children string")
    for more in nodes:
        empty = empty.union(more)
    return runs, stored(empty, "nodes"), subroots


def _siblings(children: Column, place: Column) -> tuple[Column, Column]:
    """Hashes left and right of a child in the joined hashes of its parent."""
    return F.substring(children, F.lit(1), place * DIGEST), F.substring(children, (place + 1) * DIGEST + 1, F.lit((ARITY - 1) * DIGEST))


CLIMB = f"""
WITH RECURSIVE climb(run, parent, place, proof, folded) AS (
  SELECT run, parent, place, '', folded FROM {{anchor}}
  UNION ALL
  SELECT c.run, n.parent, n.place,
    concat(c.proof, substring(n.children, 1, c.place * {DIGEST}), substring(n.children, (c.place + 1) * {DIGEST} + 1)),
    transform(c.folded, f -> sha2(concat(
      substring(n.children, 1, c.place * {DIGEST}), f, substring(n.children, (c.place + 1) * {DIGEST} + 1)), 256))
  FROM climb c JOIN {{nodes}} n ON c.parent = n.id
)
SELECT run, proof, folded FROM climb WHERE parent IS NULL
"""


def climbed(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``run, proof, folded``: siblings above each run up to the root, and what each tampered leaf folds to there."""
    spark = runs.sparkSession
    joined = F.array_join(F.transform("leaves", lambda x: x["leaf"]), "")

    def first_fold(leaf: Column, place: Column) -> Column:
        left, right = _siblings(F.col("_children"), place)
        return F.when(F.col("n") > 1, _hash(left, leaf["tampered"], right)).otherwise(leaf["tampered"])

    anchor = runs.withColumn("_children", joined).select("run", "parent", "place", F.transform("leaves", first_fold).alias("folded"))
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return stored(spark.sql(CLIMB, anchor=anchor, nodes=nodes), "climbed")
    finally:
        if before is None:
            spark.conf.unset(ROW_LIMIT)
        else:
            spark.conf.set(ROW_LIMIT, before)


def lower_case_third() -> Column:
    """Leaf hash after lower-casing the text of rows whose id's CRC-32 has the factor 3."""
    hit = F.coalesce(id_remainder(F.col("doc_id"), 3) == 0, F.lit(False))
    return F.when(hit, leaf_hash(text=F.translate("text", UPPER, LOWER))).otherwise(leaf_hash())


def proofs(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded_root, verified``, one row per document.

    ``proof`` holds the siblings up to the root, level by level, left to right, as joined hex.
    """
    runs, nodes, subroots = manifest(documents, lower_case_third() if tampered is None else tampered)
    paths = climbed(runs, nodes)
    tops = runs.filter("parent IS NULL").select("hash").union(nodes.filter("parent IS NULL").select("hash")).first()
    leaves = runs.withColumn("_children", F.array_join(F.transform("leaves", lambda x: x["leaf"]), "")).join(paths, "run").select(
        "tree", "n", "_children", "proof", "folded", F.posexplode("leaves").alias("_at", "_leaf"))
    left, right = _siblings(F.col("_children"), F.col("_at"))
    return leaves.join(subroots, "tree").withColumn("root", F.lit(tops.hash if tops else None).cast("string")).select(
        "_leaf.doc_id", "_leaf.leaf", "subroot", "root",
        F.when(F.col("n") > 1, F.concat(left, right, "proof")).otherwise(F.col("proof")).alias("proof"),
        F.get("folded", F.col("_at")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

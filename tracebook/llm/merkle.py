"""Merkle manifest of a dataset: leaves, parent-linked nodes, proofs, and their check by a climb.

Leaves are numbered within their source by a distributed sort. Sixteen consecutive nodes become
one node of the next level until a source has one node left, its subroot; subroots are the leaves
of one more tree, which ends in the root. Every level built is stored as rows that name their
parent, their place in its run and the digests below them.

A recursive query then ascends from the runs of leaves to the root: each step joins a row with its
parent node, appends the siblings met there and hashes the digests on the way again. The leaves of
a run meet the same siblings above it, so they climb as one row that carries one digest for its
untouched leaves and one for each tampered leaf; their siblings inside the run go in front at the
end. A row of the climb grows with the depth of the tree, never with the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.llm.common import stored
from tracebook.llm.native import ascii_lower
from tracebook.operators.numbering import number_by_range

WIDTH = 16

CLIMB = """
WITH RECURSIVE climb (start, parent, place, folded, above, subroot, root) AS (
    SELECT start, parent, place, folded, '', subroot, root FROM {starts}
    UNION ALL
    SELECT
        c.start, n.parent, n.place,
        transform(c.folded, digest -> sha2(concat(
            array_join(slice(n.digests, 1, c.place), ''), digest,
            array_join(slice(n.digests, c.place + 2, {width}), '')), 256)),
        concat(c.above, array_join(slice(n.digests, 1, c.place), ''),
            array_join(slice(n.digests, c.place + 2, {width}), '')),
        coalesce(c.subroot, n.subroot),
        n.root
    FROM climb c JOIN {nodes} n ON c.parent = n.node
)
SELECT start, folded, above, subroot, root FROM climb WHERE parent IS NULL LIMIT ALL
"""


def field(value: Column) -> Column:
    """A value as text with its length in front; ``-`` if null."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    names = ("doc_id", "source", "lang", "n_chars")
    return F.sha2(F.concat(*[field(F.col(name)) for name in names], field(text)), 256)


def lower_letters(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), ascii_lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(doc_id, source, leaf, changed): the digest of every row; ``changed`` where it is tampered with."""
    text = F.col("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf_digest(text).alias("leaf"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf_digest(lower_letters(text))).alias("changed"),
    )


def node_id(tree: Column, level: Column | int, run: Column) -> Column:
    """The name of a node: its level, its place there, and the source with a mark for null."""
    level = F.lit(level).cast("string")
    return F.concat_ws("/", level, run.cast("string"), F.coalesce(F.concat(F.lit("="), tree), F.lit("-")))


def joined_hash(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def upper_levels(bottom: DataFrame) -> list[DataFrame]:
    """All levels above ``bottom`` (tree, level, run, n, digests, digest), one stored table each.

    ``n`` is the number of nodes of the tree on that level. A level is a sixteenth of the one below.
    """
    levels = [bottom]
    while True:
        below = levels[-1].where("n > 1")
        if below.isEmpty():
            return levels
        place = (F.col("run") % WIDTH).cast("int")
        grouped = below.groupBy(
            "tree", (F.col("level") + 1).alias("level"), F.floor(F.col("run") / WIDTH).alias("run"), "n"
        ).agg(F.sort_array(F.collect_list(F.struct(place.alias("place"), "digest"))).alias("children"))
        levels.append(stored(grouped.select(
            "tree", "level", "run", F.ceil(F.col("n") / WIDTH).alias("n"),
            F.col("children.digest").alias("digests"), joined_hash(F.col("children.digest")).alias("digest"),
        )))


def united(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def climbed(starts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(start, folded, above, subroot, root) of every start, by the recursive query, stored.

    ``starts``: start, parent, place, folded (digests on their way up), subroot and root where they
    are known already. ``nodes``: node, parent, place, digests, subroot, root. LIMIT ALL lifts the
    bound of a million rows that Spark sets to recursive queries.
    """
    return stored(starts.sparkSession.sql(CLIMB, starts=starts, nodes=nodes, width=WIDTH))


def runs_of_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """Level 1: runs of 16 consecutive leaves of a source with their members; a lone leaf is not hashed again."""
    hashed = stored(leaves(docs, tampered))
    placed = number_by_range(hashed, ["source"], [F.col("doc_id"), F.col("leaf")], "place", size="leaves", keep=stored)
    members = F.sort_array(F.collect_list(F.struct("place", "doc_id", "leaf", "changed")))
    runs = placed.groupBy("source", F.floor(F.col("place") / WIDTH).alias("run"), "leaves").agg(members.alias("members"))
    alone = F.col("leaves") == 1

    def changed_runs(found: Column) -> Column:
        """Per tampered member, in order, the run's digest with that member tampered with."""
        spots = F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda k: F.get(found, k)["changed"].isNotNull())
        return F.transform(
            spots,
            lambda k: joined_hash(F.transform(found, lambda m, i: F.when(i == k, m["changed"]).otherwise(m["leaf"]))),
        )

    first = F.get("members", F.lit(0))
    digest = F.when(alone, first["leaf"]).otherwise(joined_hash(F.col("members.leaf")))
    altered = F.when(alone, F.array_compact(F.array(first["changed"]))).otherwise(changed_runs(F.col("members")))
    return stored(
        runs.select(
            F.col("source").alias("tree"), F.lit(1).alias("level"), "run", F.ceil(F.col("leaves") / WIDTH).alias("n"),
            F.col("members.leaf").alias("digests"), digest.alias("digest"), "members",
            F.concat(F.array(digest), altered).alias("folded"),
        )
    )


def tree_nodes(runs: DataFrame) -> DataFrame:
    """(node, parent, place, digests, subroot, root) of every node of all sources and of the tree above them."""
    levels = upper_levels(runs.drop("members", "folded"))
    columns = ["tree", "level", "run", "n", "digests", "digest"]
    tops = united([level.where("n = 1").select(*columns) for level in levels])
    # one narrow row per source
    ranked = number_by_range(tops.drop("n"), [], [F.col("tree")], "rank", size="n", keep=stored)
    sources = upper_levels(
        ranked.select(
            F.lit(None).cast("string").alias("tree"), F.lit(0).alias("level"), F.col("rank").alias("run"), "n",
            F.array("digest").alias("digests"), "digest",
        )
    )

    def source_node(level: Column | int, run: Column) -> Column:
        return F.concat(F.lit("sources/"), node_id(F.lit(None), level, run))

    def rows(level: DataFrame, node: Column, parent: Column, subroot: Column, root: Column) -> DataFrame:
        place = (F.col("hung") % WIDTH).cast("int").alias("place")
        return level.select(
            node.alias("node"), parent.alias("parent"), place, "digests", subroot.alias("subroot"), root.alias("root")
        )

    none, digest, hung = F.lit(None).cast("string"), F.col("digest"), F.floor(F.col("hung") / WIDTH)
    own = node_id(F.col("tree"), F.col("level"), F.col("run"))
    over = node_id(F.col("tree"), F.col("level") + 1, hung)
    inner = [rows(level.where("n > 1").withColumn("hung", F.col("run")), own, over, none, none) for level in levels]
    last = F.when(F.col("n") == 1, digest)
    ends = rows(
        ranked.withColumn("hung", F.col("rank")), own, F.when(F.col("n") > 1, source_node(1, hung)), digest, last
    )
    upper = [
        rows(
            level.withColumn("hung", F.col("run")), source_node(F.col("level"), F.col("run")),
            F.when(F.col("n") > 1, source_node(F.col("level") + 1, hung)), none, last,
        )
        for level in sources[1:]
    ]
    return stored(united([*inner, ends, *upper]))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and whether a tampered copy is still verified.

    ``docs``: doc_id, source, lang, n_chars, text; other columns are not read. A leaf is the sha256
    of these five, null told from empty. Leaves ascend by doc_id within a source, a null id first
    and equal ids by their leaf; sources ascend by their UTF-8 bytes, null first. ``tampered``
    marks rows whose text has its A-Z lower-cased before it is folded; null counts as false, and
    by default these are the rows whose id has a crc32 (of its decimal text) that 5 divides, so a
    row without an id is not tampered with. Repeated rows are a leaf each, with proofs of their
    own; a lone leaf is its source's subroot; an empty table gives an empty result.
    """
    if tampered is None:
        tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    runs = runs_of_leaves(docs, tampered)
    nodes = tree_nodes(runs)
    start = node_id(F.col("tree"), F.col("level"), F.col("run")).alias("start")
    starts = runs.select(start, "folded").join(
        nodes.select(F.col("node").alias("start"), "parent", "place", "subroot", "root"), "start"
    )
    top = climbed(starts, nodes).join(runs.select(start, F.col("tree").alias("source"), "members"), "start")
    nth = F.size(F.filter(F.slice("members", F.lit(1), F.col("at") + 1), lambda m: m["changed"].isNotNull()))
    digests = F.col("members.leaf")
    siblings = F.concat(
        F.array_join(F.slice(digests, F.lit(1), F.col("at")), ""),
        F.array_join(F.slice(digests, F.col("at") + 2, F.lit(WIDTH)), ""),
        "above",
    )
    return (
        top.select("*", F.posexplode("members").alias("at", "member"))
        .select(
            F.col("member.doc_id").alias("doc_id"), "source", F.col("member.leaf").alias("leaf"), "subroot", "root",
            F.sha2(siblings, 256).alias("proof_sha256"),
            F.get("folded", F.when(F.col("member.changed").isNull(), 0).otherwise(nth)).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )

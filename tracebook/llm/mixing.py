"""Mixing sources to target weights by dependent rounding of copy numbers.

DataFrame functions only. Every document of a source is to be taken target / source size times.
The whole part is taken for certain; what is left is a probability, and documents are paired: of
a pair one gives and the other gets as many words as make one of the two probabilities 0 or 1,
which way is drawn so that neither's expectation moves (the pivotal method, with sizes). Words
given and got are equal, so a source's sum stays at its target but for the last document left.
The few documents that are large against their source come first; the probabilities of the others
are then moved by what these took too much or too little.

Pairs are made along a tree. Documents of a source and size class are dealt to blocks by hash; a
block folds its documents, largest first, and hands on the one that is left undecided; 64 blocks'
remainders are the block of the next level, up to one block per source, which settles the rest. Draws are hashes of ids
and sizes, so that a rerun, a lost executor or another partitioning changes nothing.

Rows of one source, id and size are interchangeable: they are counted first and enter as one
document of which a whole number of rows is decided already and one row's probability is left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracebook.llm.common import stored
from tracebook.llm.native import SPACE, let
from tracebook.operators.numbering import number_by_range

BLOCK = 64
LARGE = 200
SALTS = 16
ROWS_AT_ONCE = 1 << 16
DRAWS = float(1 << 52)

# what a document carries through the tree: the rows it stands for, their whole copies, the rows decided already
ITEM = "struct<doc_id:bigint,size:bigint,source_size:bigint,target:double,whole:bigint,rows:bigint,full:bigint>"
MEMBER = f"struct<size:bigint,key:bigint,p:double,item:{ITEM}>"
DONE = f"array<struct<item:{ITEM},extra:int>>"


def words_in(text: Column) -> Column:
    """Runs of characters other than space and \\x09-\\x0D; a null text has none."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")
    gaps = F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit("")))
    ends = F.when(F.startswith(plain, F.lit(" ")), 1).otherwise(0) + F.when(F.endswith(plain, F.lit(" ")), 1).otherwise(0)
    return F.when(plain.isin("", " "), 0).otherwise(gaps + 1 - ends).cast("long")


def draw(*columns: Column) -> Column:
    """A number from 0 to under 1, the same for the same values."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 12) / DRAWS


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares of the whole by weight.

    Weights go round in the order of the names, null last. A target stops at ``most`` times its
    source's size; the excess is shared out by weight among the rest until none is above. What
    every round needs are four sums over the sources.
    """
    ranked = number_by_range(sizes, [], [F.col("source").asc_nulls_last()], "rank", keep=stored)
    turn = (F.col("rank") % len(weights)).cast("int")
    weighed = stored(
        ranked.select(
            "source", "source_size", F.get(F.array(*map(F.lit, weights)), turn).cast("double").alias("weight"),
            (most * F.col("source_size")).cast("double").alias("cap"),
        )
    )
    level, full = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("cap") <= level * F.col("weight")
        # one row: sums of whole numbers, so their order does not matter
        row = weighed.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(above, F.col("cap"))).alias("capped"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.count(F.when(above, 1)).alias("full"),
        ).first()
        if row.weight is None or row.full == full:
            break
        full = row.full
        level = (row.total - (row.capped or 0)) / row.weight
    target = F.least(F.col("cap"), F.lit(level or 0.0) * F.col("weight")) if row.weight is not None else F.col("cap")
    return weighed.select("source", "source_size", target.alias("target"))


def counted_items(docs: DataFrame) -> DataFrame:
    """(source, size, doc_id, rows, class): documents with their words, equal rows as one."""
    size = words_in(F.col("text"))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size")
    )
    bits = F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0)
    return read.groupBy("source", "size", "doc_id").agg(F.count(F.lit(1)).alias("rows")).withColumn("class", bits)


def block_plan(items: DataFrame, shares: DataFrame) -> DataFrame:
    """Per source and size class: copies per document, and the blocks its documents are dealt to.

    Blocks of a source are numbered from the largest class down; documents without words have none.
    """
    blocks = F.when(F.col("class") > 0, F.ceil(F.col("n") / BLOCK)).otherwise(0)
    # a source has one row per class, 63 at most
    larger = Window.partitionBy("source").orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        items.groupBy("source", "class")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("blocks", blocks)
        .withColumn("first_block", F.coalesce(F.sum("blocks").over(larger), F.lit(0)).cast("long"))
    )
    met = F.col("n.source").eqNullSafe(F.col("t.source"))
    return numbered.alias("n").join(shares.alias("t"), met).select(
        "n.source", "class", "blocks", "first_block", "source_size", "target", "copies"
    )


def members(items: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, block, member): every document that is not large, with its block and its probability.

    A source and class is met in ``SALTS`` parts, as it may hold a third of all documents.
    """
    key = F.xxhash64("source", "doc_id", "size")
    left = items.withColumn("key", key).withColumn("salt", F.pmod("key", F.lit(SALTS))).alias("i")
    right = plan.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))).alias("p")
    met = (
        F.col("i.source").eqNullSafe(F.col("p.source"))
        & (F.col("i.class") == F.col("p.class"))
        & (F.col("i.salt") == F.col("p.salt"))
    )
    planned = ["blocks", "first_block", "source_size", "target", "copies"]
    rest = left.join(right, met).select("i.*", *planned).where(~is_large())
    block = F.when(F.col("blocks") > 0, F.col("first_block") + F.pmod(F.xxhash64("key"), "blocks"))
    return rest.select("source", block.alias("block"), member().alias("member"))


def is_large() -> Column:
    return F.col("size") * LARGE > F.col("source_size")


def member() -> Column:
    """A document as it goes through the tree: whole copies of all its rows, ``full`` rows with one more, p left."""
    whole = F.floor("copies")
    share = F.col("rows") * (F.col("copies") - whole)
    item = F.struct("doc_id", "size", "source_size", "target", whole, "rows", F.floor(share))
    return F.struct("size", F.xxhash64("source", "doc_id", "size"), share - F.floor(share), item).cast(MEMBER)


def words_taken() -> Column:
    """Of all rows of an item."""
    return F.col("item.size") * (F.col("item.rows") * F.col("item.whole") + F.col("item.full") + F.col("extra"))


def large_ones(items: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, item, extra): documents with over 1 / ``LARGE`` of their source's words, fewer than that, decided.

    They come first, so that the others can make up for what they take too much or too little.
    """
    by_size = Window.partitionBy("source").orderBy(F.desc("size"), "doc_id")
    most = items.where(F.col("size") > 0).withColumn("nth", F.row_number().over(by_size)).where(F.col("nth") <= LARGE)
    copies = (F.col("target") / F.col("source_size")).alias("copies")
    met = F.col("m.source").eqNullSafe(F.col("t.source"))
    large = most.alias("m").join(targets.alias("t"), met).where(is_large()).select("m.*", "source_size", "target", copies)
    found = large.groupBy("source").agg(F.sort_array(F.collect_list(member()), asc=False).alias("found"))
    return stored(found.select("source", F.inline(settled(F.col("found")))))


def shares(targets: DataFrame, large: DataFrame, most: int) -> DataFrame:
    """``targets`` and the copies of each document that is not large, after what the large ones have taken."""
    taken = large.groupBy("source").agg(
        F.sum(words_taken()).alias("taken"), F.sum(F.col("item.size") * F.col("item.rows")).alias("held")
    )
    met = F.col("t.source").eqNullSafe(F.col("l.source"))
    words = F.col("source_size") - F.coalesce("held", F.lit(0))
    left = (F.col("target") - F.coalesce("taken", F.lit(0))) / words
    copies = F.when(words > 0, F.least(F.greatest(left, F.lit(0.0)), F.lit(float(most)))).otherwise(0.0)
    return targets.alias("t").join(taken.alias("l"), met, "left").select("t.*", copies.alias("copies"))


def nothing() -> Column:
    return F.array().cast(DONE)


def nobody() -> Column:
    return F.lit(None).cast(MEMBER)


def decided(member: Column, extra: Column) -> Column:
    return F.array(F.struct(member["item"].alias("item"), extra.cast("int").alias("extra")))


def with_p(member: Column, p: Column) -> Column:
    return F.struct(member["size"].alias("size"), member["key"].alias("key"), p.alias("p"), member["item"].alias("item"))


def folded(found: Column) -> Column:
    """(done, left): the documents of a block decided pair by pair, and the one left over."""

    def state(done: Column, left: Column) -> Column:
        return F.struct(done.alias("done"), left.alias("left"))

    def paired(done: Column, old: Column, new: Column) -> Column:
        # words that each of the two can still get and give
        old_gets, old_gives = (1 - old["p"]) * old["size"], old["p"] * old["size"]
        new_gets, new_gives = (1 - new["p"]) * new["size"], new["p"] * new["size"]
        up, down = F.least(old_gets, new_gives), F.least(old_gives, new_gets)
        rises = draw(old["key"], new["key"]) * (up + down) < down
        old_ends = F.when(rises, old_gets <= new_gives).otherwise(old_gives <= new_gets)
        new_ends = F.when(rises, new_gives <= old_gets).otherwise(new_gets <= old_gives)
        old_p = old["p"] + F.when(rises, up).otherwise(-down) / old["size"]
        new_p = new["p"] - F.when(rises, up).otherwise(-down) / new["size"]
        ended = F.concat(
            done,
            F.when(old_ends, decided(old, rises)).otherwise(nothing()),
            F.when(new_ends, decided(new, ~rises)).otherwise(nothing()),
        )
        left = F.when(old_ends & new_ends, nobody()).when(old_ends, with_p(new, new_p)).otherwise(with_p(old, old_p))
        return state(ended, left)

    def met(so_far: Column, new: Column) -> Column:
        done, old = so_far["done"], so_far["left"]
        whole = (new["p"] <= 0) | (new["p"] >= 1)
        return (
            F.when(whole, state(F.concat(done, decided(new, new["p"] >= 1)), old))
            .when(old.isNull(), state(done, new))
            .otherwise(paired(done, old, new))
        )

    return F.aggregate(found, state(nothing(), nobody()), met)


def settled(found: Column) -> Column:
    """All documents of a source's last block decided, largest first, each against all smaller ones at once.

    The largest goes up with its probability p, else down; the words it gets or gives are spread
    over the others in such shares that they stay between 0 and 1 either way, which keeps their
    expectations. So what cannot be made even at the end is a small document, not a large one.
    """

    def state(done: Column, rest: Column) -> Column:
        return F.struct(done.alias("done"), rest.alias("rest"))

    def room(member: Column, p: Column) -> Column:
        return member["size"] * F.least(member["p"] / (1 - p), (1 - member["p"]) / p)

    def within(p: Column) -> Column:
        return F.when(p < 1e-12, 0.0).when(p > 1 - 1e-12, 1.0).otherwise(p)

    def moved(done: Column, first: Column, others: Column, room_left: Column) -> Column:
        p, size = first["p"], first["size"]
        share = F.least(F.lit(1.0), room_left / size)
        rises = draw(first["key"], F.lit("alone")) < p
        words = F.when(rises, 1 - p).otherwise(-p) * size * share
        rest = F.transform(
            others,
            lambda m: with_p(
                m, F.when(room_left > 0, within(m["p"] - words * room(m, p) / room_left / m["size"])).otherwise(m["p"])
            ),
        )
        return state(F.concat(done, decided(first, rises)), rest)

    def step(so_far: Column, _: Column) -> Column:
        done, first = so_far["done"], F.get(so_far["rest"], F.lit(0))
        others = F.slice(so_far["rest"], F.lit(2), F.greatest(F.size(so_far["rest"]) - 1, F.lit(0)))
        total = F.aggregate(others, F.lit(0.0), lambda sum_, m: sum_ + room(m, first["p"]))
        return F.when(
            (first["p"] <= 0) | (first["p"] >= 1), state(F.concat(done, decided(first, first["p"] >= 1)), others)
        ).otherwise(let(total, lambda room_left: moved(done, first, others, room_left)))

    return F.aggregate(found, state(nothing(), found), step)["done"]


def rounded(rows: DataFrame, blocks: int) -> DataFrame:
    """(item, extra) of all documents of (source, block, member), level by level of the tree.

    ``blocks`` is the largest number of blocks of a source. Every level is stored and 64 times
    smaller than the one below; a source that has one block left is settled there.
    """
    results = [
        rows.where("block IS NULL").select("member.item", F.lit(0).alias("extra"))  # no words, nothing to decide
    ]
    current = rows.where("block IS NOT NULL")
    largest_first = F.sort_array(F.collect_list("member"), asc=False)
    while blocks > 1:
        grouped = current.groupBy("source", "block").agg(folded(largest_first).alias("folded"))
        level = stored(grouped.select("source", "block", "folded.done", "folded.left"))
        results.append(level.select(F.inline("done")))
        block = F.floor(F.col("block") / BLOCK)
        current = level.where("left IS NOT NULL").select("source", block.alias("block"), F.col("left").alias("member"))
        blocks = -(-blocks // BLOCK)
    last = current.groupBy("source").agg(largest_first.alias("found")).select(settled(F.col("found")).alias("done"))
    results.append(last.select(F.inline("done")))
    return reduce(DataFrame.union, results)


def expanded(decided: DataFrame) -> DataFrame:
    """One row per document again, from (item, extra)."""
    items = decided.select("item.*", "extra")

    def rows(found: DataFrame, first: Column, last: Column) -> DataFrame:
        more = F.when(F.col("nth") < F.col("full") + F.col("extra"), 1).otherwise(0)
        return found.select("*", F.explode(F.sequence(first, last)).alias("nth")).select(
            "doc_id", "size", "source_size", "target", (F.col("size") * (F.col("whole") + more)).alias("taken")
        )

    few = rows(items.where(F.col("rows") <= ROWS_AT_ONCE), F.lit(0).cast("long"), F.col("rows") - 1)
    # groups of very many equal rows are dealt out in parts before they become rows again
    parts = (
        items.where(F.col("rows") > ROWS_AT_ONCE)
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(ROWS_AT_ONCE).cast("long"))).alias("at"))
        .repartition("doc_id", "size", "at")
    )
    return few.union(rows(parts, F.col("at"), F.least(F.col("at") + ROWS_AT_ONCE, "rows") - 1))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document for a mix as large as all sizes.

    ``docs``: doc_id, source, text; other columns are not read. Sizes are words between white space.
    Sources weigh ``weights`` in turn by the order of their names, a null source last; no target
    exceeds ``most`` times its source's size. taken is the size times the copies that the mix takes,
    the copies of a document being on average target / source_size. A null or empty text
    has size 0 and gives nothing; rows with equal source, id and size share out their copies, with
    null ids as with others; an empty table gives an empty result.
    """
    items = stored(counted_items(docs))
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = stored(source_targets(sizes, weights, most))
    large = large_ones(items, targets)
    plan = stored(block_plan(items, shares(targets, large, most)))
    # one number
    blocks = plan.agg(F.max(F.col("first_block") + F.col("blocks"))).first()[0] or 0
    return expanded(rounded(members(items, plan), blocks).union(large.select("item", "extra")))

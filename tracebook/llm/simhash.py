"""Near copies by 64-bit SimHash: a Gray-order hierarchical index over masked bit patterns.

The bits are cut in three blocks, and the two blocks left over from each again in three. Two
fingerprints with at most two differing bits agree on one of the nine masks so made, so the
masked bits of a fingerprint name the upper nodes of the index where its partners are; Spark
deals the nodes out. Below a node the fingerprints are sorted by Gray rank, which puts codes
that differ in few bits next to each other, and neighbours are grouped level by level: a group
keeps the bits that all its members share. A search adds up the differences on shared bits from
the top down and leaves a whole group once they exceed the limit.

Equal fingerprints are one entry of the index. Within a node a search takes each fingerprint out
once it is reached, so a node of n gives n - 1 links at most, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.llm.common import byte_texts, chunks, signed, stored
from tracebook.llm.components import components

FANOUT = 16
SMALL_NODE = 48
FRONTIER = 1024
# Pairs that a search in a wide node holds at a time, and those whose sketches it compares at a time.
PAIRS_HELD = 1 << 21
PAIRS_COMPARED = 4096
BINS = 256


def shingles(text: bytes, size: int) -> list[bytes]:
    """Runs of ``size`` words of the lower-cased text, repeats included; fewer words are one run."""
    words = text.lower().split()  # of bytes: lower-cases A-Z, splits at ASCII white space
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - size + 1]
    return [joined[a:b] for a, b in zip(starts.tolist(), ends[size - 1 :].tolist(), strict=True)]


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per run of hashes the bits that more than half of them have."""
    found = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
        most = np.add.reduceat(bits, starts, axis=0, dtype=np.int32) * 2 > sizes[full][:, None]
        found[full] = (most * (np.uint64(1) << np.arange(64, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)
    return found


def sketch(hashes: np.ndarray) -> bytes:
    """The smallest hash in each of ``BINS`` bins, 16 bits each; 0xFFFF where a bin is empty."""
    held = np.full(BINS, 0xFFFF, np.uint16)
    if len(hashes):
        # of the order of all hashes of a bin only the smallest counts, so 48 bits decide, 16 are kept
        bins, rest = (hashes % np.uint64(BINS)).astype(np.int64), hashes >> np.uint64(16)
        order = np.lexsort((rest, bins))
        first = order[np.append(True, bins[order][1:] != bins[order][:-1])]
        held[bins[first]] = (rest[first] % np.uint64(0xFFFF)).astype(np.uint16)
    return held.tobytes()


def sketch_rows(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), np.uint16).reshape(-1, BINS)


def similarities(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    either = (a != 0xFFFF) | (b != 0xFFFF)
    return ((a == b) & either).sum(axis=1) / np.maximum(either.sum(axis=1), 1)


def _prints(size: int, seed: int, sketched: int | None):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            values, sketches = [np.zeros(0, np.uint64)], []
            for _, texts in chunks(byte_texts(batch), 1 << 20):
                hashed = [[digest(s, seed) for s in shingles(text, size)] for text in texts]
                sizes = np.fromiter(map(len, hashed), np.int64, len(hashed))
                flat = np.fromiter((h for run in hashed for h in run), np.uint64, int(sizes.sum()))
                values.append(majority_bits(flat, sizes))
                if sketched:
                    for text in texts:
                        sketches.append(sketch(np.array([digest(s, seed) for s in shingles(text, sketched)], np.uint64)))
            columns, names = [*batch.columns[:-1], signed(np.concatenate(values))], [*batch.schema.names[:-1], "code"]
            if sketched:
                columns.append(pa.array(sketches, pa.binary()))
                names.append("sketch")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return emit


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, code): the SimHash of every whole text, as the long with its 64 bits.

    Words are runs of characters other than space and \\x09-\\x0D, A-Z lower-cased; shingles
    count with repeats. A text of fewer words than a shingle has is one shingle; a null text or
    one without words has code 0.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _prints(words_per_shingle, seed, None), "doc_id long, code long"
    )


def masks(limit: int = 2) -> list[int]:
    """Masks such that codes at ``limit`` or fewer differing bits agree on one of them.

    Up to two bits: nine masks of 35 or 36 bits, one block of three and one third of the other
    two. Beyond: any two of ``limit`` + 2 blocks, since that many differences leave two alone.
    """
    found = []
    if limit <= 2:
        blocks = [list(range(0, 22)), list(range(22, 43)), list(range(43, 64))]
        for outer in range(3):
            rest = [bit for at, block in enumerate(blocks) if at != outer for bit in block]
            third = -(-len(rest) // 3)
            for inner in range(3):
                found.append(blocks[outer] + rest[inner * third : (inner + 1) * third])
    else:
        count = limit + 2
        blocks = [list(range(64 * k // count, 64 * (k + 1) // count)) for k in range(count)]
        found = [one + other for at, one in enumerate(blocks) for other in blocks[at + 1 :]]
    return [sum(1 << bit for bit in bits) for bits in found]


def gray_rank(code: Column) -> Column:
    """The place of a code in Gray order: every bit xor all bits above it."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


class GrayIndex:
    """Codes in Gray order under levels of groups; a group holds the bits that its members share."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (pattern, mask), from the leaves up
        pattern, mask = codes, np.full(len(codes), np.uint64(0xFFFFFFFFFFFFFFFF))
        self.levels.append((pattern, mask))
        while len(pattern) > 1:
            heads = np.arange(0, len(pattern), FANOUT)
            first = np.repeat(pattern[heads], np.diff(np.append(heads, len(pattern))))
            mask = np.bitwise_and.reduceat(mask & ~(pattern ^ first), heads)
            pattern = pattern[heads] & mask
            self.levels.append((pattern, mask))

    def within(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, code) positions of all codes at ``limit`` or fewer differing bits."""
        pattern, mask = self.levels[-1]
        who = np.repeat(np.arange(len(queries)), len(pattern))
        node = np.tile(np.arange(len(pattern)), len(queries))
        spent = np.bitwise_count((queries[who] ^ pattern[node]) & mask[node])
        above = mask
        for pattern, mask in reversed(self.levels[:-1]):
            keep = spent <= limit
            who, node, spent = who[keep], node[keep], spent[keep]
            wide = np.minimum((node + 1) * FANOUT, len(pattern)) - node * FANOUT
            seen = np.repeat(above[node], wide)
            child = np.repeat(node * FANOUT, wide) + np.arange(int(wide.sum())) - np.repeat(
                np.cumsum(wide) - wide, wide
            )
            who, spent = np.repeat(who, wide), np.repeat(spent, wide)
            # only bits that the groups above have not counted yet
            spent = spent + np.bitwise_count((queries[who] ^ pattern[child]) & mask[child] & ~seen)
            node, above = child, mask
        keep = spent <= limit
        return who[keep], node[keep]


def alone(codes: np.ndarray, limit: int) -> np.ndarray:
    """Which codes, in Gray order, have no other within the limit."""
    single = np.ones(len(codes), bool)
    for step in range(1, min(8, len(codes))):
        near = np.bitwise_count(codes[:-step] ^ codes[step:]) <= limit
        single[:-step] &= ~near
        single[step:] &= ~near
    index, unsure = GrayIndex(codes), np.flatnonzero(single)
    for at in range(0, len(unsure), FRONTIER):
        who, _ = index.within(codes[unsure[at : at + FRONTIER]], limit)
        single[unsure[at : at + FRONTIER]] = np.bincount(who, minlength=len(unsure[at : at + FRONTIER])) == 1
    return single


def spanning_links(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between codes within the limit that hold each set of reachable codes together.

    The search spreads from a code to all it reaches, one link for each; a reached code leaves the
    index, which is built anew once half of it has gone.
    """
    codes = codes[~alone(codes, limit)]
    none = np.zeros(0, np.uint64)
    left = np.ones(len(codes), bool)
    places = np.arange(len(codes))
    index = GrayIndex(codes) if len(codes) else None
    reached, through = [none], [none]
    for seed in range(len(codes)):
        if not left[seed]:
            continue
        left[seed] = False
        frontier = np.array([seed])
        while len(frontier) and len(places):
            step = []
            for at in range(0, len(frontier), FRONTIER):
                who, found = index.within(codes[frontier[at : at + FRONTIER]], limit)
                found, first = np.unique(places[found], return_index=True)
                parent = frontier[at + who[first]]
                new = left[found]
                found, parent = found[new], parent[new]
                left[found] = False
                step.append(found)
                reached.append(codes[found])
                through.append(codes[parent])
            frontier = np.concatenate(step)
            if len(frontier) and 2 * int(left[places].sum()) < len(places) and len(places) > FANOUT:
                places = places[left[places]]
                index = GrayIndex(codes[places]) if len(places) else None
    return np.concatenate(reached), np.concatenate(through)


def _node_links(limit: int):
    def small(codes: np.ndarray, node: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of few codes: each code with the nearest later one that is close, by offsets."""
        left, right = [], []
        for step in range(1, int(sizes.max(initial=1))):
            near = (node[:-step] == node[step:]) & (np.bitwise_count(codes[:-step] ^ codes[step:]) <= limit)
            at = np.flatnonzero(near)
            left.append(codes[at])
            right.append(codes[at + step])
        none = [np.zeros(0, np.uint64)]
        return np.concatenate(left or none), np.concatenate(right or none)

    def links(node: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        heads = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        sizes = np.diff(np.append(heads, len(node)))
        wide = np.repeat(sizes, sizes)
        few = (wide > 1) & (wide <= SMALL_NODE)
        found = [small(codes[few], node[few], wide[few])]
        for at in np.flatnonzero(sizes > SMALL_NODE):
            found.append(spanning_links(codes[heads[at] : heads[at] + sizes[at]], limit))
        left, right = (np.concatenate([x[side] for x in found]) for side in (0, 1))
        if len(left):
            yield pa.RecordBatch.from_arrays([signed(left), signed(right)], names=["left", "right"])

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Codes sorted by node and Gray rank; the last node of a batch waits for the next batch."""
        held_nodes, held_codes = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for batch in batches:
            if not batch.num_rows:
                continue
            node = np.asarray(batch.column("node")).view(np.uint64)
            codes = np.asarray(batch.column("code")).view(np.uint64)
            cut = int(np.flatnonzero(node == node[-1])[0]) if node[0] != node[-1] else 0
            if not cut and len(held_nodes[-1]) and held_nodes[-1][-1] == node[0]:
                held_nodes.append(node)
                held_codes.append(codes)
                continue
            held_nodes.append(node[:cut])
            held_codes.append(codes[:cut])
            whole = np.concatenate(held_nodes)
            if len(whole):
                yield from links(whole, np.concatenate(held_codes))
            held_nodes, held_codes = [node[cut:]], [codes[cut:]]
        whole = np.concatenate(held_nodes)
        if len(whole):
            yield from links(whole, np.concatenate(held_codes))

    return emit


def code_links(codes: DataFrame, limit: int = 2) -> DataFrame:
    """Links (left, right) between distinct codes that join all codes ``limit`` bits apart or less.

    Both ends of a link are within the limit themselves.
    """
    if not 0 <= limit <= 8:
        raise ValueError("limit must be 0 to 8: masks for more bits would be too short")
    # a masked pattern and its mask's number are named by a hash of 64 bits; two that share it by
    # chance only meet, their codes are compared in full
    upper = F.explode(
        F.array(*[F.xxhash64(F.lit(at), F.col("code").bitwiseAND(F.lit(_long(m)))) for at, m in enumerate(masks(limit))])
    )
    dealt = codes.select("code", gray_rank(F.col("code")).alias("rank"), upper.alias("node"))
    return (
        dealt.repartition("node")
        .sortWithinPartitions("node", "rank")
        .select("node", "code")
        .mapInArrow(_node_links(limit), "left long, right long")
    )


def _long(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def rooted_codes(prints: DataFrame, first: Column, limit: int) -> DataFrame:
    """(code, first, root): per distinct code the aggregate ``first`` of its rows, and its component."""
    codes = prints.groupBy("code").agg(first.alias("first"))
    roots = components(code_links(codes.select("code"), limit))
    return codes.join(roots.withColumnRenamed("node", "code"), "code", "left").select(
        "code", "first", F.coalesce("root", "code").alias("root")
    )


def near_copies(docs: DataFrame, limit: int = 2, words_per_shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    Fingerprints at ``limit`` or fewer differing bits are linked; component_id is the smallest
    doc_id that can be reached, itself included. Texts without words share fingerprint zero and
    are linked like others. Repeated rows come out as often as they came in. A null doc_id keeps
    its row; its component_id is the smallest known id of the component, or null if there is none.
    Other columns are not read.
    """
    prints = stored(fingerprints(docs, words_per_shingle))
    of = rooted_codes(prints, F.min("doc_id"), limit)
    least = of.groupBy("root").agg(F.min("first").alias("component_id"))
    named = of.join(least, "root").select("code", "component_id")
    return prints.join(named, "code").select(
        "doc_id",
        F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_component(docs: DataFrame, limit: int = 2, words_per_shingle: int = 3) -> DataFrame:
    """``docs``, all columns, with one row of each component of ``near_copies``: the smallest doc_id.

    Ties of doc_id, and null ones, which come last, are settled by hashes of the text; of repeated
    rows one stays. Texts without words are one group. An empty table gives an empty result.
    Groups are settled on ids and hashes; whole rows are moved once, to the row that stays.
    """

    def keys(doc_id: Column, text: Column) -> list[Column]:
        # two hashes: one of 64 bits would take rows of very large tables for one another
        return [F.xxhash64(doc_id, doc_id.isNull(), text), F.xxhash64(F.lit(1), text, doc_id)]

    known, other = keys(F.col("doc_id"), F.col("text"))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), known.alias("key"), other.alias("key2"), "text")
    prints = stored(
        read.mapInArrow(_prints(words_per_shingle, 42, None), "doc_id long, key long, key2 long, code long")
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key", "key2"))
    stay = rooted_codes(prints, first, limit).groupBy("root").agg(F.min("first").alias("first"))
    chosen = stay.select(F.col("first.key").alias("_key"), F.col("first.key2").alias("_key2"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("_row"), known.alias("_key"), other.alias("_key2"))
    kept = held.join(chosen, ["_key", "_key2"], "left_semi")
    return kept.dropDuplicates(["_key", "_key2"]).select("_row.*")


def whole_nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by node, in tables that hold all rows of each of their nodes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        node = np.asarray(batch.column("node"))
        if held and node[0] == node[-1] == held[-1].column("node")[0].as_py():
            held.append(batch)
            continue
        cut = int(np.flatnonzero(node == node[-1])[0])
        if held or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def close_pairs(codes: np.ndarray, node: np.ndarray, longest: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs within the limit that share a node, for nodes of ``longest`` rows at most."""
    for step in range(1, longest):
        at = np.flatnonzero(
            (node[:-step] == node[step:]) & (np.bitwise_count(codes[:-step] ^ codes[step:]) <= limit)
        )
        yield at, at + step


def node_runs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Node and code of every row, where each node starts, how many rows it has."""
    node, codes = (np.asarray(rows.column(c)).view(np.uint64) for c in ("node", "code"))
    heads = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    return node, codes, heads, np.diff(np.append(heads, len(node)))


def _members(limit: int):
    """Rows, sorted by node and Gray rank, whose node holds another within the limit."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_nodes(batches):
            node, codes, heads, sizes = node_runs(rows)
            met = np.zeros(len(codes), bool)
            of = np.repeat(sizes, sizes)
            few = np.flatnonzero((of > 1) & (of <= SMALL_NODE))
            for left, right in close_pairs(codes[few], node[few], int(of[few].max(initial=1)), limit):
                met[few[left]] = met[few[right]] = True
            for at in np.flatnonzero(sizes > SMALL_NODE):
                here = slice(heads[at], heads[at] + sizes[at])
                met[here] = ~alone(codes[here], limit)
            yield from rows.filter(pa.array(met)).combine_chunks().to_batches()

    return emit


def verified_links(
    codes: np.ndarray, sketches: np.ndarray, limit: int, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of links that hold together what pairs both within the limit and similar join.

    The search spreads as in ``spanning_links``, but only a pair whose sketches are similar takes
    its far end out of the index; what was close and failed waits for the other codes near it.
    """
    none = np.zeros(0, np.int64)
    left = np.ones(len(codes), bool)
    places = np.arange(len(codes))
    index = GrayIndex(codes)
    reached, through = [none], [none]
    for seed in range(len(codes)):
        if not left[seed]:
            continue
        left[seed] = False
        frontier = np.array([seed])
        while len(frontier) and len(places):
            step, size = [none], max(1, min(FRONTIER, PAIRS_HELD // len(places)))
            for at in range(0, len(frontier), size):
                who, found = index.within(codes[frontier[at : at + size]], limit)
                parent, found = frontier[at + who], places[found]
                for pair in range(0, len(found), PAIRS_COMPARED):
                    one, other = (x[pair : pair + PAIRS_COMPARED] for x in (parent, found))
                    one, other = one[left[other]], other[left[other]]
                    near = similarities(sketches[one], sketches[other]) >= least
                    new, first = np.unique(other[near], return_index=True)
                    left[new] = False
                    step.append(new)
                    reached.append(new)
                    through.append(one[near][first])
            frontier = np.concatenate(step)
            if len(frontier) and 2 * int(left[places].sum()) < len(places) and len(places) > FANOUT:
                places = places[left[places]]
                index = GrayIndex(codes[places]) if len(places) else None
    return np.concatenate(reached), np.concatenate(through)


def _verified(limit: int, least: float):
    """Links (left, right) between the members of each node that are close and similar."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_nodes(batches):
            node, codes, heads, sizes = node_runs(rows)
            name = np.asarray(rows.column("entry"))
            sketches = sketch_rows(rows.column("sketch"))
            of = np.repeat(sizes, sizes)
            few = np.flatnonzero((of > 1) & (of <= SMALL_NODE))
            found = [(few[:0], few[:0])]
            for left, right in close_pairs(codes[few], node[few], int(of[few].max(initial=1)), limit):
                for at in range(0, len(left), PAIRS_COMPARED):
                    one, other = (few[x[at : at + PAIRS_COMPARED]] for x in (left, right))
                    near = similarities(sketches[one], sketches[other]) >= least
                    found.append((one[near], other[near]))
            for at in np.flatnonzero(sizes > SMALL_NODE):
                here = slice(heads[at], heads[at] + sizes[at])
                one, other = verified_links(codes[here], sketches[here], limit, least)
                found.append((one + heads[at], other + heads[at]))
            left, right = (name[np.concatenate([x[side] for x in found])] for side in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], names=["left", "right"])

    return emit


def similar_links(entries: DataFrame, limit: int, least: float) -> DataFrame:
    """Links (left, right) that join all ``entries`` (entry, code, sketch) that are close and similar.

    Every close pair shares a node, and a node's links hold together what its similar pairs join.
    Sketches go only to entries that have a close one in the node.
    """
    upper = F.explode(
        F.array(*[F.xxhash64(F.lit(at), F.col("code").bitwiseAND(F.lit(_long(m)))) for at, m in enumerate(masks(limit))])
    )

    def by_node(rows: DataFrame) -> DataFrame:
        return rows.repartition("node").sortWithinPartitions("node", gray_rank(F.col("code")))

    members = by_node(entries.select("entry", "code", upper.alias("node"))).mapInArrow(
        _members(limit), "entry long, code long, node long"
    )
    sketched = members.join(entries.select("entry", "sketch"), "entry")
    return by_node(sketched).mapInArrow(_verified(limit, least), "left long, right long")


def one_of_each(
    docs: DataFrame, similarity: float = 0.8, words: int = 5, limit: int = 6, words_per_shingle: int = 2
) -> DataFrame:
    """``docs``, all columns, with one row of each group of near copies: the smallest doc_id.

    Candidates are all pairs of fingerprints over runs of ``words_per_shingle`` words at ``limit``
    or fewer differing bits, equal ones included; a link holds if the texts' sets of runs of
    ``words`` words have the given similarity or more, by the smallest hashes in 256 bins (exact
    for the sets that meet in bins of one member; off by 0.025 on average for long texts). Texts
    with the same fingerprint and sketch are one entry of the search. Ties of doc_id, nulls last, are settled by the text's hash, and of repeated rows one
    stays. Texts without words are one group. An empty table gives an empty result.
    """
    key = F.xxhash64("doc_id", "text")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("row_key"), "text")
    prints = stored(
        read.mapInArrow(
            _prints(words_per_shingle, 42, words), "doc_id long, row_key long, code long, sketch binary"
        )
    )
    named = prints.withColumn("entry", F.xxhash64("code", "sketch"))
    entries = stored(
        named.groupBy("entry").agg(
            F.first("code").alias("code"), F.first("sketch").alias("sketch"), F.min(order).alias("first")
        )
    )
    roots = components(similar_links(entries, limit, similarity)).withColumnRenamed("node", "entry")
    of = entries.select("entry", "first").join(roots, "entry", "left")
    stay = of.groupBy(F.coalesce("root", "entry").alias("root")).agg(F.min("first").alias("first"))
    chosen = stay.select(F.col("first.row_key").alias("stay_key"))
    held = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])).select(
        "_row", F.xxhash64(F.col("_row.doc_id"), F.col("_row.text")).alias("_key")
    )
    kept = held.join(chosen, F.col("_key") == F.col("stay_key"), "left_semi")
    return kept.dropDuplicates(["_key"]).select("_row.*")

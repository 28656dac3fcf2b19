"""Operator 9: documents whose 5-word shingle sets have a Jaccard similarity of 0.8 or more.

Sizes fall into bands of ratio 4. For a band the shingles' hash range is cut into blocks; a block's
parity sketch has a bit for each position of its range, flipped by each shingle there, and is kept as
the XOR of its flipped positions' codes. Sets with a symmetric difference of d differ in d blocks at
most, and a similarity of 0.8 allows d <= (|A| + |B|) / 9. So of P blocks, P - d are equal, and if all
blocks are ranked alike (those with most shingles, the rarest, first), the first d + 1 of either set
share an equal one: only these are joined (pigeonhole). A set takes part in its own band and, if a
partner may be there, in the next.

Equal sets are one node. In each bucket of equal blocks every node is paired with the bucket's least
node; links among these pairs are contracted into components. Buckets that still hold several components
are then compared in blocks of bounded size, and only pairs between components that may be links leave the
task. A pair may be a link if the Hamming distance of its two parity sketches, which is never above the
symmetric difference, allows it; of the pairs that may join components, a block names a spanning forest, the
closest first, and these are verified on the whole sets. This goes on, without the pairs that failed and
with up to ``FORESTS`` disjoint forests a round, until no pair is left that may join two components. So the pairs of a group are not listed, and no link between
different components is lost.

Null, empty and blank texts have an empty set (size 0) and are linked with nothing; texts of one to four
words have the whole sequence as their one shingle. Rows repeated with the same id give one node. A row
with a null id makes no links; it gets the component of an equal set that has an id, else null. Other columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import arrays as A
from flowlens.llm.common import anti_join, id_and_text, semi_join, written
from flowlens.llm.components import components

SHINGLE = 5
BLOCK_ROWS = 1024
FORESTS = 32
MAX_ROUNDS = 200
_U = np.uint64
_LOW = _U((1 << 48) - 1)


def similar(both: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int):
    """Whether sets of a and b elements with ``both`` in common are linked."""
    return 100 * both >= 80 * (a + b - both)


def most_apart(a, b):
    """Largest symmetric difference of linked sets of a and b elements."""
    return (a + b) // 9


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 48-bit shingle hashes, ascending in each row, and the rows' first numbers."""
    _, _, h, starts = A.words(data, offsets)
    return sets_of(h, starts, n)


def sets_of(h: np.ndarray, starts: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The same from word hashes and the rows' first words; at most 65,536 rows."""
    grams, first = A.ngrams(h, starts, n)
    size = np.diff(starts)
    row = A.owner(first)
    for k in range(1, n):  # a short text's whole sequence
        short = np.flatnonzero(size == k)
        if len(short):
            at = starts[short][:, None] + np.arange(k)
            g = np.zeros(len(short), np.uint64)
            for j in range(k):
                g = g * _U(0x9FB21C651E98DF25) + h[at[:, j]]
            grams, row = np.concatenate((grams, A.mix(g + _U(k)))), np.concatenate((row, short))
    packed = np.unique(row.astype(np.uint64) << _U(48) | grams >> _U(16))
    return packed & _LOW, np.searchsorted(packed, np.arange(len(size) + 1, dtype=np.uint64) << _U(48))


def node_ids(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each row's set; 0 for an empty set."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(A.mix(tokens + _U(1)), dtype=np.uint64)))
    size = np.diff(first)
    out = A.mix(total[first[1:]] - total[first[:-1]] + size.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    out[size == 0] = 0
    return out.view(np.int64)


def band_of(size: np.ndarray) -> np.ndarray:
    """k with 4**k <= size < 4**(k+1)."""
    return (np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1) // 2


def block_count(band: np.ndarray) -> np.ndarray:
    return np.maximum((4 ** (band.astype(np.int64) + 1) - 1) // 3, 16)


def prefix_blocks(tokens, first, rows, band) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of the blocks that the given rows join on in the given bands."""
    size = np.diff(first)[rows]
    if len(rows) == 0:
        return rows, np.zeros(0, np.uint64)
    need = most_apart(size, np.minimum(size * 5 // 4, 4 ** (band.astype(np.int64) + 1) - 1)) + 1
    at = np.concatenate(([0], np.cumsum(size)))
    own = np.repeat(np.arange(len(rows)), size)
    t = tokens[np.arange(at[-1]) - at[own] + first[rows][own]]
    block = (t >> _U(16)) * block_count(band).astype(np.uint64)[own] >> _U(32)
    new = np.ones(len(t), bool)
    new[1:] = (own[1:] != own[:-1]) | (block[1:] != block[:-1])
    begin = np.flatnonzero(new)
    code = np.bitwise_xor.reduceat(A.mix(t), begin)
    count = np.diff(np.append(begin, len(t)))
    whose, block = own[begin], block[begin]
    rank = whose.astype(np.uint64) << _U(48) | (255 - np.minimum(count, 255)).astype(np.uint64) << _U(40) | code >> _U(24)
    order = np.argsort(rank)
    filled = np.bincount(whose, minlength=len(rows))
    place = np.arange(len(order)) - np.repeat(np.concatenate(([0], np.cumsum(filled)[:-1])), filled)
    pick = order[place < need[whose[order]]]
    out_row, out_block, out_code = whose[pick], block[pick], code[pick] + count[pick].astype(np.uint64)
    for r in np.flatnonzero(filled < need):  # few blocks hold a shingle: then empty ones, in their order
        empty = np.setdiff1d(np.arange(block_count(band)[r], dtype=np.uint64), block[whose == r])[: need[r] - filled[r]]
        out_row, out_block = np.append(out_row, np.full(len(empty), r)), np.append(out_block, empty)
        out_code = np.append(out_code, np.zeros(len(empty), np.uint64))
    k = band.astype(np.uint64)[out_row]
    return rows[out_row], A.mix(out_code + A.mix(out_block * _U(64) + k + _U(7)))


def signatures(tokens, first) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(first)
    rows = np.flatnonzero(size > 0)
    band = band_of(size[rows])
    up = size[rows] * 5 // 4 >= 4 ** (band.astype(np.int64) + 1)
    a, b = prefix_blocks(tokens, first, rows, band), prefix_blocks(tokens, first, rows[up], band[up] + 1)
    return np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1]))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part in A.slices(batches):
        for at in range(0, part.num_rows, 60_000):
            rows = part.slice(at, 60_000)
            yield rows, *shingle_sets(*A.bytes_of(rows.column(rows.schema.get_field_index("text"))))


def _sizes(batches):
    for rows, tokens, first in _slices(batches):
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(np.diff(first).astype(np.int64)), pa.array(node_ids(tokens, first))], ["doc_id", "n_shingles", "node"]
        )


def _signature_rows(batches):
    seen: set[int] = set()
    for _, tokens, first in _slices(batches):
        nodes = node_ids(tokens, first)
        new = np.zeros(len(nodes), bool)
        for i, node in enumerate(nodes.tolist()):
            if node and node not in seen:
                seen.add(node)
                new[i] = True
        row, sig = signatures(tokens, first)
        keep = new[row]
        yield pa.RecordBatch.from_arrays([pa.array(sig[keep].view(np.int64)), pa.array(nodes[row[keep]])], ["sig", "node"])


def _set_rows(batches):
    for _, tokens, first in _slices(batches):
        yield set_batch(node_ids(tokens, first), tokens, first)


def set_batch(nodes: np.ndarray, tokens: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """node, size, sketch and elements of sets; an element takes 6 bytes."""
    packed = tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    spans = list(zip(first[:-1], first[1:]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(nodes),
            pa.array(np.diff(first).astype(np.int64)),
            pa.array([parity_sketch(tokens[a:b]) for a, b in spans], pa.binary()),
            pa.array([packed[6 * a : 6 * b] for a, b in spans], pa.binary()),
        ],
        ["node", "size", "sketch", "elements"],
    )


SET_SCHEMA = "node long, size long, sketch binary, elements binary"


def elements_of(raw) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def parity_sketch(elements: np.ndarray) -> bytes:
    """A bit sketch, about two bits an element (256 to 8192): each element flips one bit."""
    bits = 1 << (int(np.clip(2 * len(elements), 256, 8192)) - 1).bit_length()
    flips = np.bincount((A.mix(elements) & _U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").tobytes()


def fold_sketch(sketch: np.ndarray, size: int) -> np.ndarray:
    """Sketches (rows of bytes) of fewer bits: bit i of a shorter one is the parity of the bits i modulo its length."""
    return np.bitwise_xor.reduce(sketch.reshape(*sketch.shape[:-1], -1, size), axis=-2)


def _bucket_rows(batches):
    """Rows sorted by sig, node: those of signatures with several nodes, each with its signature's least node.

    Works as a stream: a bucket of any size passes through with one row of it in memory.
    """
    sig0 = node0 = None
    hub0, several = None, False
    for batch in batches:
        sig, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(sig):
            continue
        same = np.zeros(len(sig), bool)
        same[1:] = sig[1:] == sig[:-1]
        same[0] = sig[0] == sig0 if sig0 is not None else False
        repeat = np.zeros(len(sig), bool)
        repeat[1:] = same[1:] & (node[1:] == node[:-1])
        repeat[0] = same[0] and node[0] == node0
        run = np.cumsum(~same)  # 0: the run that the last batch ended in
        heads = np.flatnonzero(~same)
        hub = np.concatenate(([hub0 if hub0 is not None else 0], node[heads]))[run]
        other = same & ~repeat
        out_s, out_h, out_n = sig[other], hub[other], node[other]
        # a hub's own row, once its second node is seen
        with_more = np.unique(run[other])
        if several:
            with_more = with_more[with_more > 0]
        own = np.concatenate(([hub0 if hub0 is not None else 0], node[heads]))[with_more]
        own_sig = np.concatenate(([sig0 if sig0 is not None else 0], sig[heads]))[with_more]
        if len(out_s):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((out_s, own_sig))), pa.array(np.concatenate((out_h, own))), pa.array(np.concatenate((out_n, own)))],
                ["sig", "hub", "node"],
            )
        last = run[-1]
        several = bool(other[run == last].any()) or (several and last == 0)
        hub0 = hub[-1]
        sig0, node0 = sig[-1], node[-1]


def _may_link(batches):
    """Pairs (a, b, sizes and sketches) that sizes and sketches allow to be links."""
    for batch in batches:
        n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        ok = similar(np.minimum(n, m), n, m)
        for i in np.flatnonzero(ok):
            x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint8) for k in (4, 5))
            short = min(len(x), len(y))
            apart = np.bitwise_count(fold_sketch(x, short) ^ fold_sketch(y, short)).sum()
            ok[i] = apart <= most_apart(n[i], m[i])
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], ["a", "b"])


def _verify(batches):
    for batch in batches:
        ok = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            x, y = (elements_of(batch.column(k)[i].as_buffer()) for k in (2, 3))
            ok[i] = similar(common(x, y), len(x), len(y))
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], ["a", "b"])


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Number of elements that two ascending arrays share."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def block_forests(node, comp, size, sketch, failed, side, forests: int) -> list[tuple[int, int]]:
    """Of the pairs of a block that may be links between components and haven't failed, disjoint spanning forests.

    The closest pairs come first. ``failed`` has the array of nodes that each node failed with, or None. Where
    ``side`` has two values, pairs are those of rows of either; else all. Rows of the largest component are
    only met from other rows.
    """
    names, n = np.unique(comp, return_counts=True)
    if len(names) < 2:
        return []
    minor = comp != names[n.argmax()]
    length = np.array([len(x) for x in sketch])
    folded: dict[tuple[int, int], np.ndarray] = {}
    of_length = {k: np.flatnonzero(length == k) for k in np.unique(length).tolist()}
    for k, rows in of_length.items():
        raw = np.stack([np.frombuffer(sketch[r], np.uint8) for r in rows])
        for short in of_length:
            if short <= k:
                folded[k, short] = fold_sketch(raw, short)
    place = np.empty(len(node), np.int64)
    for rows in of_length.values():
        place[rows] = np.arange(len(rows))
    two_sides = side.min() != side.max()
    found: list[tuple[int, int, int]] = []
    for i in np.flatnonzero(minor):
        for k, rows in of_length.items():
            if not length[i] // 2 <= k <= 2 * length[i]:
                continue  # sizes too far apart for a link
            short = min(int(length[i]), k)
            ok = (comp[rows] != comp[i]) & (~minor[rows] | (rows > i)) & similar(np.minimum(size[rows], size[i]), size[rows], size[i])
            if two_sides:
                ok &= side[rows] != side[i]
            ok = np.flatnonzero(ok)
            if not len(ok):
                continue
            apart = np.bitwise_count(folded[k, short][ok] ^ folded[int(length[i]), short][place[i]]).sum(axis=1)
            near = apart <= most_apart(size[rows[ok]], size[i])
            if failed[i] is not None:
                near &= ~np.isin(node[rows[ok]], failed[i])
            found.extend((int(d), int(i), int(j)) for d, j in zip(apart[near], rows[ok[near]]))
    out, left = [], sorted(found)
    for _ in range(forests):
        parent = {c: c for c in comp.tolist()}

        def root(c, parent=parent):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        rest = []
        for pair in left:
            x, y = root(int(comp[pair[1]])), root(int(comp[pair[2]]))
            if x == y:
                rest.append(pair)
            else:
                parent[x] = y
                out.append((int(node[pair[1]]), int(node[pair[2]])))
        left = rest
        if not left:
            break
    return out


def _forests(forests: int):
    return lambda batches: _block_pairs(batches, forests)


def _block_pairs(batches, forests):
    """block_forests of each run of rows (sig, i, j, side, node, comp, size, sketch, failed) sorted by sig, i, j."""
    held: pa.Table | None = None

    def pairs(rows: pa.Table, cuts):
        node, comp, size = (rows.column(c).to_numpy() for c in ("node", "comp", "size"))
        side = rows.column("side").to_numpy()
        sketch, failed = rows.column("sketch"), rows.column("failed")
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            once = a + np.unique(node[a:b], return_index=True)[1]
            texts, no = (c.slice(a, b - a).to_pylist() for c in (sketch, failed))
            out += block_forests(node[once], comp[once], size[once], [texts[k - a] for k in once], [no[k - a] for k in once], side[once], forests)
        a, b = zip(*out) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        rows = rows.combine_chunks()
        key = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("sig", "i", "j")])
        heads = np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0))))
        yield pairs(rows, heads)
        held = rows.slice(heads[-1])
    if held is not None:
        yield pairs(held.combine_chunks(), np.array([0, held.num_rows]))


def _unsettled(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """bucket, comp, node of buckets that hold several components, one bucket for each set of nodes."""
    rows = buckets.select("sig", "node").join(comps, "node", "left").select("sig", "node", F.coalesce("root", "node").alias("comp"))
    name = F.xxhash64("node")
    several = (
        rows.groupBy("sig")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n"), F.bit_xor(name).alias("x"), F.bit_xor(F.xxhash64(name)).alias("y"))
        .where("lo != hi and n > 2")
    )
    one = several.groupBy("n", "x", "y").agg(F.min("sig").alias("sig"))
    return rows.join(one.select("sig", "n"), "sig")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar, by the sets' elements."""
    one = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long")


def sorted_buckets(signatures: DataFrame) -> DataFrame:
    """(sig, hub, node) of the signatures (sig, node) that several nodes have; hub is the least of them."""
    parts = max(int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)
    return signatures.repartition(parts, "sig").sortWithinPartitions("sig", "node").mapInArrow(_bucket_rows, "sig long, hub long, node long")


def bucket_pairs(buckets: DataFrame) -> DataFrame:
    return buckets.where("hub != node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()


def linked(buckets: DataFrame, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) of all nodes with links, from their buckets, the pairs of these, and all nodes' sets (SET_SCHEMA)."""
    short = sets.select("node", "size", "sketch")
    one, two = (short.select(F.col("node").alias(n), F.col("size").alias(f"{n}_size"), F.col("sketch").alias(f"{n}_sketch")) for n in "ab")
    sized = pairs.join(one, "a").join(two, "b").select("a", "b", "a_size", "b_size", "a_sketch", "b_sketch")
    tried = written(sized.mapInArrow(_may_link, "a long, b long"), "close")
    roots = failed = None
    for turn in range(MAX_ROUNDS):
        links = written(verified(tried, sets), "links")
        missed = tried.join(links, ["a", "b"], "left_anti")
        failed = written(missed if failed is None else failed.union(missed), "failed")
        if roots is None or not links.isEmpty():
            known = links if roots is None else links.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
            roots = components(known)
            buckets = written(_unsettled(buckets, roots), "unsettled")
        tried = written(_late_pairs(buckets, short, failed, FORESTS if turn else 1), "late-pairs")
        if tried.isEmpty():
            return roots
    raise RuntimeError(f"links not settled after {MAX_ROUNDS} rounds")


def _late_pairs(rest: DataFrame, short: DataFrame, failed: DataFrame, forests: int) -> DataFrame:
    both = failed.union(failed.select(F.col("b").alias("a"), F.col("a").alias("b")))
    no = both.groupBy(F.col("a").alias("node")).agg(F.collect_set("b").alias("failed"))
    parts = max(int(rest.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)
    rows = (
        rest.withColumn("split", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
        .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("split")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("split") - 1)))
        .select("sig", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), F.col("mine").alias("side"), "node", "comp")
        .join(short.join(no, "node", "left"), "node")
        .select("sig", "i", "j", "side", "node", "comp", "size", "sketch", "failed")
    )
    pairs = rows.repartition(parts, "sig", "i", "j").sortWithinPartitions("sig", "i", "j").mapInArrow(_forests(forests), "a long, b long")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row; component_id is the least id that links reach."""
    texts = id_and_text(docs, id_col, text_col)
    sizes = written(texts.mapInArrow(_sizes, "doc_id long, n_shingles long, node long"), "sizes")
    buckets = written(sorted_buckets(texts.where("doc_id is not null").mapInArrow(_signature_rows, "sig long, node long")), "buckets")
    pairs = written(bucket_pairs(buckets), "pairs")
    nodes = pairs.select(F.col("b").alias("node")).union(pairs.select("a")).distinct()
    classes = sizes.where("n_shingles > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("rep"))
    wanted = classes.join(nodes, "node", "left_semi").select(F.col("rep").alias("doc_id"))
    found = semi_join(texts, wanted, "doc_id").mapInArrow(_set_rows, SET_SCHEMA)
    sets = written(found.dropDuplicates(["node"]), "sets")
    roots = linked(buckets, pairs, sets)
    least = classes.join(roots, "node").groupBy("root").agg(F.min("rep").alias("component_id"))
    answer = written(
        classes.join(roots, "node", "left").join(least, "root", "left").select("node", F.coalesce("component_id", "rep").alias("component_id")),
        "answer",
    )
    return sizes.join(answer, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one_of_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose id is the least of their component; rows with a null id stay."""
    more = near_copies(docs, id_col, text_col).where("doc_id != component_id")
    return anti_join(docs, more.select(F.col("doc_id").alias(id_col)), id_col)

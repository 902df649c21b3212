"""SimHash near-dedup by a self-join of a binary trie."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.bpe import text_parts
from lotwise.llm.common import cut, packed
from lotwise.llm.components import Forest, components

SHINGLE = 4
SEED = 42
BITS = 64
MAX_DIFFERENT = 4
#: Fingerprints that a trie node should hold, which is joined with itself by one task.
NODE_ROWS = 1 << 15
#: Trie nodes of up to so many fingerprints are compared one by one.
LEAF = 8
#: Node pairs that a task expands at once.
FRONT = 1 << 18
#: Shingle hashes whose bits are counted at once.
HASHES = 1 << 16


def fingerprint(text: str | None) -> int:
    """SimHash of a whole text over its word shingles, repeats included; a bit is set if over half the hashes set it."""
    ones, total, carry = np.zeros(BITS, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    first = True
    for part in text_parts(text or ""):
        words = carry + part.lower().split()  # bytes: lower-cases A-Z only
        if len(words) < SHINGLE:
            carry = words
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - SHINGLE + 1].tolist()
        ends = ends[SHINGLE - 1 :].tolist()
        for at in range(0, len(starts), HASHES):
            to = at + HASHES
            hashes = np.array([digest(line[s:e], SEED) for s, e in zip(starts[at:to], ends[at:to])], ">u8")
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            total += len(hashes)
        carry, first = words[-(SHINGLE - 1) :], False
    if first:
        if not carry:
            return 0
        return digest(b" ".join(carry), SEED)
    value = 0
    for bit in (2 * ones > total).tolist():
        value = value << 1 | bit
    return value


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
        columns = [batch.column(c) for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(found, pa.int64())], [*(c for c in batch.schema.names if c != "text"), "print"]
        )


def linked_pairs(a: np.ndarray, b: np.ndarray | None, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints of ``a`` and ``b`` (sorted, distinct) that differ in up to ``most`` bits.

    ``b`` None joins ``a`` with itself, each pair once. Two tries are walked together: a pair of nodes carries the bits
    in which their prefixes differ, and a pair with more than ``most`` is dropped with all below it. Pairs of small
    nodes are compared directly. Pairs wait on a stack in runs of bounded length, deepest first.
    """
    own = b is None
    other = a if own else b
    if not len(a) or not len(other):
        return
    bits: dict[tuple[int, int], np.ndarray] = {}

    def ones(side: int, depth: int) -> np.ndarray:
        """Fingerprints before each place whose bit at ``depth`` is set."""
        if (side, depth) not in bits:
            values = other if side else a
            set_bits = (values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            bits[side, depth] = np.concatenate([[0], np.cumsum(set_bits.astype(np.int64))])
        return bits[side, depth]

    def leaves(al, ah, bl, bh) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(int((ah - al).max(initial=0))):
            for j in range(int((bh - bl).max(initial=0))):
                x, y = al + i, bl + j
                fits = (x < ah) & (y < bh)
                if own:
                    fits &= x < y
                x, y = x[fits], y[fits]
                near = np.bitwise_count(a[x] ^ other[y]) <= most
                yield x[near], y[near]

    start = [np.array([v]) for v in (0, len(a), 0, len(other), 0)]
    stack = [(0, start)]
    while stack:
        depth, (al, ah, bl, bh, used) = stack.pop()
        small = (ah - al <= LEAF) & (bh - bl <= LEAF)
        if depth == BITS:
            small[:] = True
        if small.any():
            yield from leaves(al[small], ah[small], bl[small], bh[small])
            al, ah, bl, bh, used = (v[~small] for v in (al, ah, bl, bh, used))
        if not len(al):
            continue
        one, two = ones(0, depth), ones(0 if own else 1, depth)
        amid, bmid = ah - (one[ah] - one[al]), bh - (two[bh] - two[bl])
        parts = []
        for x, y in ((0, 0), (0, 1), (1, 0), (1, 1)):
            cl, ch = (amid, ah) if x else (al, amid)
            dl, dh = (bmid, bh) if y else (bl, bmid)
            now = used + (x ^ y)
            live = (cl < ch) & (dl < dh) & (now <= most)
            if own:  # a node pair and its mirror image are one
                live &= cl <= dl
            parts.append([v[live] for v in (cl, ch, dl, dh, now)])
        front = [np.concatenate(v) for v in zip(*parts)]
        for at in range(0, len(front[0]), FRONT):
            stack.append((depth + 1, [v[at : at + FRONT] for v in front]))


def _rotated(values: np.ndarray, by: int) -> np.ndarray:
    """64-bit numbers with their first ``by`` bits moved to the end; distances stay."""
    return values << np.uint64(by) | values >> np.uint64(BITS - by) if by else values


def _join_node(most: int, turns: list[int]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Links of one trie node, or of two, as one link from each fingerprint to the smallest of its group."""
        values = rows["print"].to_numpy(np.int64).view(np.uint64)
        turned = _rotated(values, turns[int(rows["turn"].iloc[0])])
        left = rows["side"].to_numpy() == 0
        if left.all() and rows["mask"].iloc[0]:
            return pd.DataFrame({"a": values[:0].view(np.int64), "b": values[:0].view(np.int64)})
        sides = [np.argsort(turned[left])] if left.all() else [np.argsort(turned[left]), np.argsort(turned[~left])]
        ordered = [turned[left][sides[0]], turned[~left][sides[1]] if len(sides) > 1 else None]
        both = np.concatenate([values[part][order] for part, order in zip((left, ~left), sides)])
        shift = 0 if ordered[1] is None else len(ordered[0])
        # The smallest number of a group is its root: by place in the order of the fingerprints themselves.
        rank = np.argsort(both, kind="stable")
        place = np.empty(len(both), np.int64)
        place[rank] = np.arange(len(both))
        forest = Forest(len(both))
        for x, y in linked_pairs(*ordered, most):
            forest.link(place[x], place[y + shift])
        both, roots = both[rank], forest.all_roots()
        linked = np.flatnonzero(roots != np.arange(len(both)))
        return pd.DataFrame({"a": both[linked].view(np.int64), "b": both[roots[linked]].view(np.int64)})

    return run


def _turns(most: int) -> list[tuple[int, int]]:
    """Starts and widths of ``most + 1`` blocks of the bits: a pair that links agrees on one of them."""
    edges = [round(i * BITS / (most + 1)) for i in range(most + 2)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def trie_nodes(prints: DataFrame, n: int, most: int = MAX_DIFFERENT, node_rows: int = NODE_ROWS) -> DataFrame:
    """``turn, low, mask, side, print``: each of ``n`` fingerprints under the trie nodes that it is joined in.

    There is a trie for each turn of the bits, which puts another block of them first. A pair that links agrees on all
    bits of a block, so in the trie that starts with it both are under one node, however deep inside the block. The tries
    are cut for tasks at a depth that leaves about ``node_rows`` fingerprints under a node: ``most + 1`` copies of each,
    whatever their number. Only where a whole block leaves larger nodes, these are cut by the bits that follow, and a
    node also meets those that differ from it in up to ``most`` of these.
    """
    depth = max(0, math.ceil(math.log2(max(n, 1) / node_rows)))
    parts = []
    for turn, (start, width) in enumerate(_turns(most)):
        first, more = min(depth, width), max(0, depth - width)
        bits = F.col("print")
        if start:
            bits = F.shiftleft(bits, start).bitwiseOR(F.shiftrightunsigned(F.col("print"), BITS - start))
        node = F.shiftrightunsigned(bits, BITS - first - more) if first else F.lit(0).cast("long")
        masks = [m for m in range(1 << more) if m.bit_count() <= most]
        rows = prints.select("print", node.alias("node"), F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
        other = F.col("node").bitwiseXOR(F.col("mask").cast("long"))
        parts.append(
            rows.select(
                F.lit(turn).alias("turn"),
                F.least("node", other).alias("low"),
                "mask",
                (F.col("node") > other).cast("int").alias("side"),
                "print",
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def print_links(prints: DataFrame, most: int = MAX_DIFFERENT, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links between distinct fingerprints (``print``) that span the same groups as all pairs within ``most`` bits.

    The fingerprints under a node of :func:`trie_nodes` are one task, which walks the trie below it against itself.
    """
    nodes = trie_nodes(prints, prints.count(), most, node_rows)
    turns = [start for start, _ in _turns(most)]
    return nodes.groupBy("turn", "low", "mask").applyInPandas(_join_node(most, turns), "a long, b long")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, plus ``print`` (the fingerprint's 64 bits as a long)."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(_fingerprints, f"{schema}, print long")


def _grouped(docs: DataFrame, most: int) -> DataFrame:
    """:func:`near_duplicates` plus ``root``, one fingerprint that names the group."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    rows = cut(fingerprints(rows), "fingerprints")
    prints = rows.groupBy("print").agg(F.min("doc_id").alias("least"))
    prints = cut(prints, "prints")
    groups = components(print_links(prints.select("print"), most), "print-links")
    named = prints.join(groups.withColumnRenamed("node", "print"), "print", "left")
    named = named.withColumn("root", F.coalesce("root", "print"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "root").select("print", "root", "component_id")
    return rows.join(named, "print").select("doc_id", "text_hash", "print", "component_id", "root")


def near_duplicates(docs: DataFrame, most: int = MAX_DIFFERENT) -> DataFrame:
    """Groups of texts with close fingerprints: ``doc_id, text_hash, print, component_id``, a row per row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach. Equal fingerprints meet in an aggregation, so a group of
    copies is one node of the link graph however large it is.

    Null and empty texts, and texts without a word, have fingerprint zero and link like any other. Null ids are never
    the smallest; a group of null ids alone has a null component_id. Repeated rows stay. An empty table gives an empty
    result. Other columns are ignored.
    """
    return _grouped(docs, most).drop("root")


def keep_one(docs: DataFrame, most: int = MAX_DIFFERENT) -> DataFrame:
    """One document of each group of near-duplicates, with the columns of ``docs``: the one with the smallest doc_id.

    Of rows with that id, the one with the smallest text hash stays, and one of equal rows. A group of null ids alone
    keeps its row with the smallest text hash. An id that stands in several groups counts in each.
    """
    # The smallest id, then the smallest text hash, of each group: nulls last.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = _grouped(docs, most).groupBy("root").agg(F.min(order).alias("least"))
    best = best.select(F.col("least.doc_id").alias("best_id"), F.col("least.text_hash").alias("best_hash"))
    rows = packed(docs, F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    same = F.col("id").eqNullSafe(F.col("best_id")) & (F.col("hash") == F.col("best_hash"))
    return rows.join(best, same, "left_semi").dropDuplicates(["id", "hash"]).select("row.*")

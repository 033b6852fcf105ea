"""Near-duplicate texts: Jaccard join over word n-grams by a MinHash LSH forest, exactly verified.

Texts with equal shingle sets form a class, and only classes are joined. Each of TREES tries holds the classes' signatures of DEPTH
MinHash values, sorted.

1. A pair whose similarity is the threshold meets in some trie, with chance TARGET, at prefixes of prefix_length() values. Classes
   whose prefix of that length no other class has, in no trie, have no link; for the others the whole signature is computed.
2. A branch, the classes under one such prefix, is a sorted trie of its own and is searched from its full depth upwards: prefixes are
   shortened one value at a time, and only as long as the classes below them aren't connected yet. Two classes are connected if the
   share of equal values among all TREES * DEPTH, which estimates their similarity, is within SLACK of the threshold; at
   the shortest prefix every pair of classes of the branch that aren't connected has been compared. So texts that
   only happen to share a prefix don't make groups, and branches give back spanning edges, never pairs. Branches of more than BRANCH
   classes are split into cells of two blocks each.
3. Components of these edges are candidate groups. Within a group all pairs are verified exactly from the shingle sets, in blocks
   bounded in classes and bytes, by matrix products; a task returns sums and spanning links. No branch, group or partner list is capped.

Words are lower-cased runs of letters, digits and underscores; shingles are runs of SHINGLE words, or
all words of a shorter text, as 44-bit hashes; a class is named by a 64-bit hash of its set.

Defined cases: null, empty and wordless texts are linked to nothing, and each is its own class; texts of
any length are read whole; repeated rows each give a row, and count as links of each other; the class id is
the least doc_id of the class, whatever the ties, and null only if no other; an empty table gives an empty one; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .runtime import NO_ID, free_name, keyed_input, map_arrow, unkeyed, written
from .textcore import WORDISH, U, Words, blocks, constants, splitmix, words

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 8
TARGET = 0.999
#: How far below the threshold the estimate of a link may lie: five standard deviations of TREES * DEPTH values at 0.8.
SLACK = 0.18
#: Classes of a branch that one task searches.
BRANCH = 512
#: Classes of a block, by the group's size: blocks of small groups are small, so that cells spread evenly. Bytes of its sets.
BLOCK, MAX_BLOCK, BLOCKS, BLOCK_BYTES = 128, 512, 32, 8 << 20
_ROW_BITS = 20


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = TARGET) -> int:
    """The longest prefix by which pairs at the threshold meet in some tree with the target chance."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def shingle_sets(w: Words, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each row, and the offsets of the rows."""
    g, at = w.gram(SHINGLE)
    doc = w.doc[at]
    n = w.counts(rows)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        first = np.cumsum(n) - n
        extra = np.zeros(len(short), U)
        for j in range(SHINGLE - 1):
            more = n[short] > j
            extra[more] = splitmix(extra[more] * U(0x9E3779B97F4A7C15) + w.hash[first[short[more]] + j])
        g, doc = np.concatenate([g, extra]), np.concatenate([doc, short])
    key = np.unique((doc.astype(U) << U(64 - _ROW_BITS)) | (g >> U(_ROW_BITS)))
    doc = (key >> U(64 - _ROW_BITS)).astype(np.int64)
    return key & U((1 << (64 - _ROW_BITS)) - 1), np.searchsorted(doc, np.arange(rows + 1))


def set_names(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A hash of each row's set, 0 for an empty one."""
    c = np.concatenate([np.zeros(1, U), np.cumsum(splitmix(sets + U(1)), dtype=U)])
    size = np.diff(off)
    h = splitmix((c[off[1:]] - c[off[:-1]]) ^ (size.astype(U) * U(0x9E3779B97F4A7C15)))
    h[h == 0] = U(1)
    return np.where(size > 0, h, U(0))


_FIRST, _SECOND = constants(TREES * DEPTH, 7), constants(TREES * DEPTH, 8)


def _least(sets: np.ndarray, off: np.ndarray, value: int) -> np.ndarray:
    """One MinHash value of every row; no row's set may be empty."""
    return np.minimum.reduceat(sets * _FIRST[value] + _SECOND[value], off)


def signatures(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, tag, node (the set's name) and the names of the prefixes of that length in all trees; none for wordless texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("node", pa.int64()), ("prefixes", pa.list_(pa.int64()))])

    def make(batch):
        for blk in blocks(batch.column("text"), lower=True, size=1 << 19):
            sets, off = shingle_sets(words(blk, WORDISH), blk.rows)
            some = np.flatnonzero(np.diff(off))
            prefix = np.zeros((len(some), TREES), U)
            for t in range(TREES if len(some) else 0):
                for j in range(length):
                    prefix[:, t] = splitmix(prefix[:, t] * U(0x9E3779B97F4A7C15) + _least(sets, off[some], t * DEPTH + j))
            start = np.zeros(blk.rows + 1, np.int32)
            start[some + 1] = TREES
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(start), pa.int32()), pa.array(prefix.ravel().view(np.int64)))
            part = slice(blk.first, blk.first + blk.rows)
            cols = [batch.column("doc_id")[part], batch.column("tag")[part], pa.array(set_names(sets, off).view(np.int64)), lists]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return map_arrow(docs, make, "doc_id long, tag long, node long, prefixes array<long>")


def packed(sets: np.ndarray) -> bytes:
    """Shingles of 44 bits in six bytes each, which is what verification shuffles most of."""
    return sets.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _sets(docs: DataFrame) -> DataFrame:
    """node, shingles and the whole signature, of which 16 bits a value are kept: tree by tree, DEPTH values each."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary()), ("signature", pa.binary())])

    def make(batch):
        for blk in blocks(batch.column("text"), lower=True):
            sets, off = shingle_sets(words(blk, WORDISH), blk.rows)
            some = np.flatnonzero(np.diff(off))
            if not len(some):
                continue
            values = np.empty((len(some), TREES * DEPTH), "<u2")
            for v in range(TREES * DEPTH):
                values[:, v] = splitmix(_least(sets, off[some], v)) & U(0xFFFF)
            parts = [packed(sets[off[i] : off[i + 1]]) for i in some]
            nodes = set_names(sets, off)[some].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(parts, pa.binary()), pa.array([v.tobytes() for v in values], pa.binary())], schema=schema)

    return map_arrow(docs, make, "node long, shingles binary, signature binary")


class Branch:
    """Classes under one prefix of a tree, as a sorted trie. Those of two sides are compared across the sides only."""

    def __init__(self, values: np.ndarray, side: np.ndarray | None, least: float):
        self.values, self.side, self.least = values, side, least
        self.head = np.arange(len(values))  # of every class's component
        self.edges: list[tuple[int, int]] = []

    def search(self, tree: int, shortest: int) -> list[tuple[int, int]]:
        path = self.values[:, tree * DEPTH : (tree + 1) * DEPTH]
        order = np.lexsort(path.T[::-1])
        path = path[order]
        apart = (path[1:] != path[:-1]).cumsum(axis=1) > 0  # [i, l]: the prefixes of l + 1 values of neighbours differ
        for length in range(DEPTH, shortest - 1, -1):
            ends = np.flatnonzero(apart[:, length - 1]) + 1 if length > shortest else np.zeros(0, np.int64)  # all share the shortest one
            for run in np.split(order, ends):
                if len(run) > 1:
                    self._connect(run)
        return self.edges

    def _connect(self, run: np.ndarray) -> None:
        """Compare classes of a run that aren't connected, the first with all others, then the next, until they are."""
        for i in run.tolist():
            head = self.head[run]
            if (head == head[0]).all():
                return
            far = run[head != self.head[i]]
            if self.side is not None:
                far = far[self.side[far] != self.side[i]]
            near = far[(self.values[far] == self.values[i]).mean(axis=1) >= self.least]
            for h in np.unique(self.head[near]).tolist():
                self.edges.append((i, int(near[self.head[near] == h][0])))
                self.head[self.head == h] = self.head[i]


def _search(threshold: float, shortest: int):
    """Spanning edges of a cell of a branch."""

    def search(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        tree, _, i, j = key
        node = part["node"].to_numpy()
        values = np.frombuffer(b"".join(part["signature"]), "<u2").reshape(len(node), TREES * DEPTH)
        edges = Branch(values, None if i == j else part["side"].to_numpy(), threshold - SLACK).search(tree, shortest)
        a, b = (node[[e[k] for e in edges]] for k in range(2))
        return pd.DataFrame({"a": a, "b": b})

    return search


def _cells(rows: DataFrame, n_blocks: str, *keep: str) -> DataFrame:
    """Rows of groups that are split into n_blocks blocks by node, one for each pair (i, j) of blocks that theirs is in."""
    side = F.pmod(F.xxhash64("node"), F.col(n_blocks)).cast("int")
    each = rows.withColumn("side", side).select("node", "side", *keep, F.explode(F.sequence(F.lit(0), F.col(n_blocks) - 1)).alias("other"))
    return each.select("node", "side", *keep, F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))


def overlaps(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Numbers of shingles that the sets at rows share with those at cols."""
    size = np.array([len(s) for s in sets])
    if len(rows) * len(cols) <= 16:
        return np.array([[len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in cols] for i in rows], np.float32).reshape(len(rows), len(cols))
    owner = np.repeat(np.arange(len(sets)), size)
    _, inv, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = n > 1  # others are shared by nobody
    new = np.cumsum(often) - 1
    keep = often[inv]
    owner, term = owner[keep], new[inv[keep]]
    order = np.argsort(term, kind="stable")
    owner, term = owner[order], term[order]
    out, width = np.zeros((len(rows), len(cols)), np.float32), 4096
    for x in range(0, int(often.sum()), width):
        lo, hi = np.searchsorted(term, [x, x + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[lo:hi], term[lo:hi] - x] = 1
        out += m[rows] @ m[cols].T
    return out


def _verify(threshold: float):
    def check(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node")
        node, side, weight = part["node"].to_numpy(), part["side"].to_numpy(), part["copies"].to_numpy()
        sets = [unpacked(s) for s in part["shingles"]]
        size = np.array([len(s) for s in sets], np.float64)
        every = np.arange(len(node))
        rows, cols = (every, every) if key[1] == key[2] else (every[side == key[1]], every[side == key[2]])
        shared = overlaps(sets, rows, cols)
        near = shared >= threshold * (size[rows][:, None] + size[cols][None, :] - shared) - 1e-6
        if key[1] == key[2]:
            np.fill_diagonal(near, False)
        links = np.zeros(len(node), np.int64)
        links[rows] += near @ weight[cols]
        if key[1] != key[2]:
            links[cols] += weight[rows] @ near
        head = every.copy()  # least node of the linked ones, to which all of them are hung
        while True:
            was = head.copy()
            np.minimum.at(head, rows, np.where(near, head[cols][None, :], len(node)).min(axis=1, initial=len(node)))
            np.minimum.at(head, cols, np.where(near, head[rows][:, None], len(node)).min(axis=0, initial=len(node)))
            if (head == was).all():
                break
        return pd.DataFrame({"node": node, "links": links, "head": node[head]})

    return check


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, tag (hash of the text), class_id, n_links (other rows whose similarity reaches the
    threshold) and first (this text is the one to keep of its class) of every row."""
    docs, shortest = keyed_input(documents), prefix_length(threshold)
    sig = written(signatures(docs, shortest), "forest-signatures")
    with_words = sig.filter("node <> 0")
    classes = with_words.groupBy("node").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "tag")).alias("least"), F.first("prefixes").alias("prefixes"))
    classes = written(classes, "forest-classes")
    # branches of two classes or more, and the whole signatures of their classes
    leaves = classes.select("node", F.posexplode("prefixes").alias("tree", "prefix"))
    shared = leaves.groupBy("tree", "prefix").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(shared, "forest-branches")  # a plain scan, so that a hot prefix can be split in the join
    blocks_of = F.ceil(F.col("n") / BRANCH).cast("int").alias("n_blocks")
    leaves = written(leaves.join(shared, ["tree", "prefix"]).select("node", "tree", "prefix", "n", blocks_of), "forest-leaves")
    one_each = classes.join(leaves.select("node").distinct(), "node", "left_semi").select("least.doc_id", "least.tag").distinct()
    sets = written(_sets(docs.join(one_each, ["doc_id", "tag"], "left_semi")).dropDuplicates(["node"]), "forest-sets")
    # search of the branches, of those that hold the same classes in several trees only one
    same = leaves.groupBy("tree", "prefix", "n").agg(F.bit_xor(F.xxhash64("node")).alias("x"), F.min("node").alias("lo"))
    same = same.groupBy("n", "x", "lo").agg(F.min(F.struct("tree", "prefix")).alias("one")).select("one.*")
    leaves = leaves.join(written(same, "forest-searched"), ["tree", "prefix"])
    cells = _cells(leaves, "n_blocks", "tree", "prefix").join(sets.select("node", "signature"), "node")
    edges = cells.groupBy("tree", "prefix", "i", "j").applyInPandas(_search(threshold, shortest), "a long, b long")
    groups = connected_components(edges, "forest-candidates")
    # exact verification, block by block
    members = groups.join(sets.select("node", F.octet_length("shingles").alias("bytes")), "node").join(classes.select("node", "copies"), "node")
    members = written(members, "forest-members")
    size = F.count("*")
    block = F.least(F.lit(MAX_BLOCK), F.greatest(F.lit(BLOCK), size / BLOCKS))
    n_blocks = members.groupBy("root").agg(F.greatest(F.ceil(size / block), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("n_blocks"))
    n_blocks = written(n_blocks, "forest-sizes")
    work = _cells(members.join(n_blocks, "root"), "n_blocks", "root", "copies").join(sets.select("node", "shingles"), "node")
    checked = work.groupBy("root", "i", "j").applyInPandas(_verify(threshold), "node long, links long, head long")
    checked = written(checked, "forest-checked")
    found = connected_components(checked.select(F.col("node").alias("a"), F.col("head").alias("b")), "forest-links")
    n_links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("node", "copies", "least").join(found, "node", "left").join(n_links, "node", "left")
    named = named.select("node", "copies", "least", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    named = written(named, "forest-named")
    keep = written(named.groupBy("root").agg(F.min("least").alias("keep")), "forest-keep")
    named = named.join(keep, "root").select("node", (F.col("copies") - 1 + F.col("links")).alias("n_links"), "keep")
    out = with_words.drop("prefixes").join(written(named, "forest-classes-named"), "node")
    out = out.select("doc_id", "tag", F.col("keep.doc_id").alias("class_id"), "n_links", (F.struct("doc_id", "tag") == F.col("keep")).alias("first"))
    alone = sig.filter("node = 0").select("doc_id", "tag", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("first"))
    return unkeyed(out.unionByName(alone), "doc_id", "class_id")


def keep_first(documents: DataFrame) -> DataFrame:
    """The rows of documents, all columns, that stay: one of each class; of rows equal in id and text, one."""
    key, tag = (free_name(documents, x) for x in ("key", "tag"))
    first = near_duplicates(documents).filter("first").select(F.coalesce("doc_id", F.lit(NO_ID)).alias(key), F.col("tag").alias(tag)).distinct()
    hashed = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    tagged = documents.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), tag: hashed})
    return tagged.join(first, [key, tag], "left_semi").dropDuplicates([key, tag]).drop(key, tag)


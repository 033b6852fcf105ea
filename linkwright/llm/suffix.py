"""Exact removal of repeated byte strings by bucket-pointer refinement to a fixed depth.

A suffix array orders all suffixes; to find strings of LENGTH bytes that occur twice, only the classes of suffixes that
agree in LENGTH bytes are needed. Bucket-pointer refinement makes them by starting from buckets of equal q-grams and sorting each
bucket on the bucket identifiers found at a later offset, the refined identifiers being written back and used for the next,
twice as long, offset. A bucket that holds one suffix is closed, and so is every suffix whose later offset is.

1. The initial buckets are those of Q-byte grams, at one position for each suffix: at the least gram (by 64-bit name) within its
   LENGTH bytes, which equal strings choose alike. Neighbouring suffixes mostly choose the same position and travel as one phrase.
   A gram that occurs once closes its bucket, and a bucket whose phrases are all equal needs no refinement.
2. Of equal phrases of a bucket one goes on. It takes its bytes along, to the task of its bucket.
3. There the bucket's suffixes are refined (Buckets): identifiers of Q bytes are sorted in pairs (i, i + 32) into identifiers of 64
   bytes, those in pairs (i, i + 64) into 128, and those in pairs (i, i + LENGTH - 128) into LENGTH, each round reading
   what the one before wrote. Classes that survive are compared byte by byte.
4. A bucket of more than MAX_PHRASES different phrases is not gathered in a task but refined across the cluster, where identifiers are
   64-bit names and pairs of them are grouped instead of sorted. Its phrases are cut into segments of SEGMENT suffixes, aligned to
   the gram, whose buckets are told by the bytes that all suffixes of a segment share; a segment alone in its bucket is closed,
   and equal ones go on as one. What is still open is told by the pair of identifiers of the first and last 128 bytes of every single
   suffix. Equality is agreement in 128 bits and in the gram there.

Defined cases: a null or empty text has no bytes and nothing removed; texts shorter than LENGTH keep everything; matches never
cross texts; rows with equal id and equal text are separate texts, so that both lose all they share; a null id is an id like any
other, and texts that share one are told apart by a 64-bit hash; a text longer than PIECE is named piece by piece; an empty table gives
an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import bounded_batches, keyed_input, map_arrow, tidy, unkeyed, written
from .textcore import Block, U, blocks, splitmix

LENGTH = 200
Q = 32
BLOCK = 1 << 18
PIECE = 1 << 22
#: Different phrases of a bucket that one task refines, about 270 bytes each.
MAX_PHRASES = 1000
#: Bytes of phrases that are refined together, in whole buckets.
WORK_BYTES = 1 << 20
SEGMENT = 16

_A, _B = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return splitmix(a * _A + b * _B)


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a number; zeros follow the end."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(n, U)
    for j in range(min(8, n)):
        out[j::8] = np.frombuffer(padded[j : j + (len(padded) - j) // 8 * 8].tobytes(), "<u8")[: len(out[j::8])]
    return out


class Names:
    """Names of the strings of a block. Those of Q bytes are kept, longer ones made where asked for."""

    def __init__(self, data: np.ndarray):
        h = splitmix(_eights(data))
        for step in (8, 16):
            h[:-step] = _mix(h[:-step], h[step:])
        self.q = h

    def of128(self, i: np.ndarray) -> np.ndarray:
        return _mix(_mix(self.q[i], self.q[i + 32]), _mix(self.q[i + 64], self.q[i + 96]))

    def full(self, i: np.ndarray) -> np.ndarray:
        return _mix(self.of128(i), self.of128(i + LENGTH - 128))


def phrases(names: Names, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First suffix, number of suffixes and gram position of every phrase of a block."""
    n, w = len(names.q), LENGTH - Q + 1
    if n < LENGTH:
        z = np.zeros(0, np.int64)
        return z, z, z
    mask = (U(1) << U(n.bit_length())) - U(1)
    least = (names.q & ~mask) | np.arange(n, dtype=U)  # of equal names the leftmost
    step = 1
    while 2 * step <= w:
        least[:-step] = np.minimum(least[:-step], least[step:])
        step *= 2
    m = n - LENGTH + 1
    at = (np.minimum(least[:m], least[w - step : w - step + m]) & mask).astype(np.int64)
    end = np.repeat(off[1:], np.diff(off))[:m]
    at[np.arange(LENGTH, LENGTH + m) > end] = -1
    change = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], change])
    size = np.diff(np.concatenate([first, [m]]))
    ok = at[first] >= 0
    return first[ok], size[ok], at[first[ok]]


def _pieces(column: pa.Array) -> Iterator[tuple[Block, int]]:
    """Blocks and the place of their first byte in its text; long texts in pieces that overlap, so that
    every suffix lies whole in one piece."""
    for b in blocks(column, size=BLOCK):
        if len(b.data) <= PIECE:
            yield b, 0
        else:
            for x in range(0, len(b.data) - LENGTH + 1, PIECE):
                part = b.data[x : x + PIECE + LENGTH - 1]
                yield Block(b.first, part, np.array([0, len(part)])), x


# A run of suffixes of a text in one number: its start, its number of suffixes and the gram's place in it. The
# text is named by doc_id and tag, a 64-bit hash.


def _pack(start, size, gram):
    return (start.astype(np.int64) << 16) | (size.astype(np.int64) << 8) | gram.astype(np.int64)


def _unpack(at: np.ndarray):
    return at >> 16, (at >> 8) & 0xFF, at & 0xFF


def _longs(batch: pa.RecordBatch, *columns: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]


def _table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == U else c, t) if isinstance(c, np.ndarray) else c for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _expand(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts n: the index of each copy's origin, and its place among the copies."""
    of = np.repeat(np.arange(len(n)), n)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)


def _runs(docs: DataFrame) -> DataFrame:
    """Every phrase with the names of its gram (m) and of itself (s)."""
    schema = pa.schema([(c, pa.int64()) for c in ("m", "s", "doc_id", "tag", "at")])

    def make(batch):
        ids, tags = _longs(batch, "doc_id", "tag")
        for b, base in _pieces(batch.column("text")):
            names = Names(b.data)
            start, size, gram = phrases(names, b.off)
            if not len(start):
                continue
            row = np.searchsorted(b.off, start, "right") - 1
            s = _mix(_mix(names.full(start), names.full(start + size - 1)), size.astype(U))
            at = _pack(start - b.off[row] + base, size, gram - start)
            yield _table(schema, names.q[gram], s, ids[b.first + row], tags[b.first + row], at)

    return map_arrow(docs.filter(F.octet_length("text") >= LENGTH), make, "m long, s long, doc_id long, tag long, at long")


def _lists(rows: DataFrame, *what: str) -> DataFrame:
    """One row for each text; rows that are equal throughout, of equal rows of the table, count once."""
    return rows.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("at", *what)).alias("items"))


def _cut_out(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The bytes of runs of suffixes."""
    of, j = _expand(size + LENGTH - 1)
    ends = np.concatenate([[0], np.cumsum(size + LENGTH - 1)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data[start[of] + j])])


def _segments(names: Names, start: np.ndarray, size: np.ndarray, gram: np.ndarray):
    """The segments of phrases: names of the bytes that their suffixes share and of themselves, first suffix, size, gram's place, and
    the phrase. A suffix's distance d to its gram tells its segment, d // SEGMENT."""
    low, high = gram - size + 1, gram
    of, j = _expand(high // SEGMENT - low // SEGMENT + 1)
    seg = low[of] // SEGMENT + j
    lo, hi = np.maximum(seg * SEGMENT, low[of]), np.minimum(seg * SEGMENT + SEGMENT - 1, high[of])
    p = start[of] + gram[of]
    core = p - seg * SEGMENT
    shared = _mix(_mix(names.of128(core), names.of128(core + LENGTH - SEGMENT + 1 - 128)), seg.astype(U))
    own = _mix(_mix(names.full(p - hi), names.full(p - lo)), (lo * 256 + hi).astype(U))
    return shared, own, p - hi, hi - lo + 1, hi, of


def _open_phrases(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """What refinement needs of phrases (m, s, n, large, doc_id, tag, at): themselves (a is s then), or if they are of a large bucket
    their segments (a, b); with their bytes."""
    lists = written(_lists(phrases, "m", "s", "n", "large"), "repeat-lists")
    schema = pa.schema([*((c, pa.int64()) for c in ("m", "a", "b", "n", "doc_id", "tag", "at")), ("large", pa.bool_()), ("data", pa.binary())])

    def make(batch):
        ids, tags = _longs(batch, "doc_id", "tag")
        items = batch.column("items")
        off = np.concatenate([[0], np.cumsum(items.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        flat = items.flatten()
        at, m, s, n, large = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(5))
        for b, base in _pieces(batch.column("text")):
            mine = np.arange(off[b.first], off[b.first + b.rows])
            row = np.repeat(np.arange(b.rows), np.diff(off[b.first : b.first + b.rows + 1]))
            start, size, gram = _unpack(at[mine])
            # a run belongs to the piece it starts in, and ends in it
            here = (start >= base) & (start < base + PIECE) & (start + size + LENGTH - 1 <= base + np.diff(b.off)[row])
            big = large[mine].astype(bool)
            for mask, split in ((here & ~big, False), (here & big, True)):
                if not mask.any():
                    continue
                i, r, shift = mine[mask], row[mask], b.off[row[mask]] - base
                place, width, g = start[mask] + shift, size[mask], gram[mask]
                a, own = s[i], np.zeros(len(i), np.int64)
                if split:
                    a, own, place, width, g, of = _segments(Names(b.data), place, width, g)
                    i, r, shift = i[of], r[of], shift[of]
                new = _pack(place - shift, width, g)
                yield _table(schema, m[i], a, own, n[i], ids[b.first + r], tags[b.first + r], new, np.full(len(i), split), _cut_out(b.data, place, width))

    return map_arrow(docs.join(lists, ["doc_id", "tag"]), make, "m long, a long, b long, n long, doc_id long, tag long, at long, large boolean, data binary")


def _suffixes(segments: DataFrame) -> DataFrame:
    """Every suffix of segments with their bytes, with the identifiers (a, b) of its first and last 128 bytes."""
    schema = pa.schema([(c, pa.int64()) for c in ("m", "a", "b", "n", "doc_id", "tag", "at")])

    def make(batch):
        m, n, ids, tags, at = _longs(batch, "m", "n", "doc_id", "tag", "at")
        start, size, _ = _unpack(at)
        data = np.frombuffer(b"".join(batch.column("data").to_pylist()), np.uint8)
        names, first = Names(data), np.cumsum(size + LENGTH - 1) - (size + LENGTH - 1)
        of, j = _expand(size)
        x = first[of] + j
        yield _table(schema, m[of], names.of128(x), names.of128(x + LENGTH - 128), n[of], ids[of], tags[of], _pack(start[of] + j, np.ones(len(of), np.int64), np.zeros(len(of), np.int64)))

    return map_arrow(segments.select("m", "n", "doc_id", "tag", "at", "data"), make, "m long, a long, b long, n long, doc_id long, tag long, at long")


def _but(runs: DataFrame, alone: DataFrame) -> DataFrame:
    """The places of runs without those that are alone in their class: the runs that occur again. Places are joined, of which no two
    are equal, and not the names, one of which may belong to a large share of all runs."""
    key = ["doc_id", "tag", "at"]
    return runs.select(key).join(alone.select(key), key, "left_anti")


def _refined_across(segments: DataFrame) -> DataFrame:
    """doc_id, tag, at of the runs that repeat, of segments of large buckets. n counts a segment of a phrase that is known elsewhere twice;
    of such nothing more is to be found."""
    key = ["doc_id", "tag", "at"]
    shared = segments.groupBy("m", "a").agg(F.sum("n").alias("of"), F.min("b").alias("lo"), F.max("b").alias("hi")).filter("of > 1")
    shared = written(shared.select("m", "a", (F.col("lo") != F.col("hi")).alias("mixed")), "repeat-shared")
    left = written(segments.join(shared, ["m", "a"]), "repeat-segments")
    mixed = left.filter("mixed")
    whole = mixed.groupBy("m", "a", "b").agg(F.least(F.sum("n"), F.lit(2)).alias("n"), F.min(F.struct(*key)).alias("x"), F.first("data").alias("data"))
    whole = written(whole.select("m", "a", "b", "n", "x.*", "data"), "repeat-wholes")
    again = _but(mixed.filter("n = 1"), whole.filter("n = 1"))
    rows = written(_suffixes(whole), "repeat-suffixes")
    equal = written(rows.groupBy("m", "a", "b").agg(F.sum("n").alias("of")).filter("of > 1").select("m", "a", "b"), "repeat-equal")
    single = rows.filter("n = 1").join(equal, ["m", "a", "b"], "left_semi")
    return left.filter("not mixed and n = 1").select(key).union(again.select(key)).union(single.select(key))


class Buckets:
    """Bucket-pointer refinement of phrases that lie one after the other in data, in buckets of phrases with one gram. Suffixes of a
    bucket can be equal only at equal distances from the gram, so the distance is part of the initial identifier."""

    def __init__(self, data: np.ndarray, size: np.ndarray, gram: np.ndarray, bucket: np.ndarray):
        self.data, self.size = data, size
        self.first = np.cumsum(size + LENGTH - 1) - (size + LENGTH - 1)
        of, j = _expand(size + LENGTH - Q)
        x = self.first[of] + j
        column = bucket[of].astype(U) * U(1024) + (gram[of] - j + 512).astype(U)
        self.pointer = np.full(len(data), -1, np.int64)
        self._number(x, _mix(Names(data).q[x], column))

    def _number(self, x: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sort positions x on key and write their bucket's number back, -1 for closed buckets; the positions of open buckets, and
        for each the first position of its bucket."""
        _, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        is_open = count[inverse] > 1
        self.pointer[:] = -1
        self.pointer[x[is_open]] = inverse[is_open]
        return x[is_open], x[first[inverse[is_open]]]

    def _refine(self, depth: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of depth bytes from pairs of pointers at i and i + offset."""
        of, j = _expand(self.size + LENGTH - depth)
        x = self.first[of] + j
        x = x[(self.pointer[x] >= 0) & (self.pointer[x + offset] >= 0)]
        return self._number(x, (self.pointer[x] << 32) | self.pointer[x + offset])

    def repeated(self) -> np.ndarray:
        """Which positions begin a string of LENGTH bytes that begins at another one too."""
        self._refine(64, 32)
        self._refine(128, 64)
        x, head = self._refine(LENGTH, LENGTH - 128)
        eights, same = _eights(self.data), np.ones(len(x), bool)
        for k in range(0, LENGTH, 8):
            same &= eights[x + k] == eights[head + k]
        out = np.zeros(len(self.data), bool)
        out[x] = True
        if not same.all():  # strings of equal names that differ: the bucket is told apart by its bytes
            bad = np.isin(head, head[~same])
            strings: dict[bytes, list[int]] = {}
            for i in x[bad].tolist():
                strings.setdefault(self.data[i : i + LENGTH].tobytes(), []).append(i)
            out[[i[0] for i in strings.values() if len(i) == 1]] = False
        return out


def _refined(small: DataFrame) -> DataFrame:
    """doc_id, tag, at of the runs that refinement finds in phrases with their bytes. Tasks get whole buckets, many at a time."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "tag", "at")])
    bounded_batches(small.sparkSession)

    def solve(rows: pa.Table) -> pa.RecordBatch:
        m, s, n, ids, tags, at = (rows.column(c).to_numpy() for c in ("m", "a", "n", "doc_id", "tag", "at"))
        new = np.ones(len(m), bool)  # a phrase of rows that are equal throughout comes several times
        new[1:] = (m[1:] != m[:-1]) | (s[1:] != s[:-1])
        rows, (m, n, ids, tags, at) = rows.filter(pa.array(new)), (c[new] for c in (m, n, ids, tags, at))
        start, size, gram = _unpack(at)
        data = np.frombuffer(b"".join(rows.column("data").to_pylist()), np.uint8)
        bucket = np.cumsum(np.concatenate([[0], m[1:] != m[:-1]]))
        hit = Buckets(data, size, gram, bucket).repeated()
        of, j = _expand(size)
        first = np.cumsum(size + LENGTH - 1) - (size + LENGTH - 1)
        found = hit[first[of] + j] & (n[of] == 1)  # of phrases known elsewhere all is known
        of, j = of[found], j[found]
        begins = np.ones(len(of), bool)
        begins[1:] = (of[1:] != of[:-1]) | (j[1:] != j[:-1] + 1)
        b = np.flatnonzero(begins)
        width = np.diff(np.append(b, len(of)))
        return _table(schema, ids[of[b]], tags[of[b]], _pack(start[of[b]] + j[b], width, np.zeros(len(b), np.int64)))

    def in_parts(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """solve() of whole buckets of some WORK_BYTES."""
        if not rows.num_rows:
            return
        m, at = rows.column("m").to_numpy(), rows.column("at").to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
        work = np.cumsum(_unpack(at)[1] + LENGTH - 1)[begins] // WORK_BYTES
        ends = np.append(begins[1:][work[1:] != work[:-1]], len(m))
        a = 0
        for b in ends.tolist():
            yield solve(rows.slice(a, b - a).combine_chunks())
            a = b

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            m = rows.column("m").to_numpy()
            whole = int(np.searchsorted(m, m[-1])) if len(m) else 0  # the last bucket may go on
            yield from in_parts(rows.slice(0, whole))
            held = rows.slice(whole).combine_chunks()
        if held is not None:
            yield from in_parts(held)

    return small.repartition("m").sortWithinPartitions("m", "a").mapInArrow(tidy(run), "doc_id long, tag long, at long")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, tag, at of runs of suffixes that occur elsewhere; docs with doc_id, text and tag."""
    key = ["doc_id", "tag", "at"]
    runs = _runs(docs)
    grams = runs.groupBy("m").agg(F.min("s").alias("lo"), F.max("s").alias("hi"), F.count("*").alias("n")).filter("n > 1")
    grams = written(grams, "repeat-grams")  # a plain scan, so that a frequent gram's rows can be split in the join
    left = written(runs.join(grams, "m").select("m", "s", *key, (F.col("lo") != F.col("hi")).alias("mixed")), "repeat-runs")
    mixed = left.filter("mixed")
    whole = mixed.groupBy("m", "s").agg(F.least(F.count("*"), F.lit(2)).alias("n"), F.min(F.struct(*key)).alias("x"))
    whole = written(whole.select("m", "s", "n", "x.*"), "repeat-phrases")
    again = _but(mixed, whole.filter("n = 1"))
    large = written(whole.groupBy("m").agg(F.count("*").alias("of")).filter(F.col("of") > MAX_PHRASES).select("m", F.lit(True).alias("large")), "repeat-large")
    marked = whole.join(large, "m", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    rows = written(_open_phrases(docs, marked), "repeat-open")
    out = left.filter("not mixed").select(key)
    for found in (again, _refined(rows.filter("not large")), _refined_across(rows.filter("large"))):
        out = out.union(found.select(key))
    return out


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (array of start, end in bytes, the maximal removed runs) and kept (the other
    bytes) of every row."""
    docs = keyed_input(documents)
    lists = written(_lists(repeated_runs(docs)), "repeat-found")
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", spans), ("kept", pa.binary())])

    def cut(batch):
        rows = []
        for text, item in zip(batch.column("text"), batch.column("items")):
            data = np.frombuffer(text.as_buffer() or b"", np.uint8)
            if not item.is_valid:
                rows.append((len(data), [], data.tobytes()))
                continue
            start, size, _ = _unpack(item.values.field(0).to_numpy(zero_copy_only=False))
            edge = np.zeros(len(data) + 1, np.int32)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + size + LENGTH - 1, -1)
            gone = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
            begin, end = np.flatnonzero(gone[1:] & ~gone[:-1]), np.flatnonzero(~gone[1:] & gone[:-1])
            rows.append((len(data), [{"start": int(a), "end": int(b)} for a, b in zip(begin, end)], data[~gone[1:-1]].tobytes()))
        cols = [pa.array([r[j] for r in rows], schema.types[j + 1]) for j in range(3)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], schema=schema)

    kind = "array<struct<start:long,end:long>>"
    out = map_arrow(docs.join(lists, ["doc_id", "tag"], "left"), cut, f"doc_id long, n_bytes long, spans {kind}, kept binary")
    return unkeyed(out, "doc_id")

"""Token-ID output as Parquet list columns, in ascending doc_id order, with selective reads.

Files hold doc_id, part_start (ids of the texts before this one in its file), n_tokens and ids
(list of int). ids are dictionary-encoded, which packs a vocabulary of 49k ids into 16 bits a value; the
other columns are delta-encoded. Row groups and pages have fixed sizes and files carry column and offset
indexes, so that a reader of some documents or of the metadata fetches only their pages. Texts are dealt to files by
ranges of doc_id, and so file order is document order.

The tokenizer lower-cases, drops white space and treats words apart, so a text's ids are those of its
white-space words in turn. Encoder gets the distinct words of a batch by 64-bit hash, encodes those it
does not know yet with the tokenizers library and gathers the rest from arrays; ids are the same as those
of a direct call, and any other tokenizer goes through encode_batch.

Defined cases: null and empty texts have the end id only; texts of any length are encoded whole; rows with
equal doc_id are all kept, ordered by their text's hash and then arbitrarily among equal texts, and may lie in several
files; an empty table gives no rows; other columns are ignored. Words are told apart by 64-bit hashes: a worker remembers at most
MAX_WORDS, so that two of them share one with a chance of some 3e-8.
"""

from __future__ import annotations

import json
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import fresh_path, map_arrow, text_input, tidy, written
from .textcore import NOT_SPACE, U, Block, blocks, bounds, constants, run_hash, splitmix

END_ID = 1
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
#: Words remembered by a Python worker; beyond it they are forgotten and learnt anew.
MAX_WORDS = 1_000_000
#: Up to so many files' offsets are broadcast, some 200 bytes each.
MAX_BROADCAST_FILES = 50_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.ones(256, bool)  # bytes that aren't of letters
_ODD[[*range(65, 91), *range(97, 123)]] = False
_ODD[0x80:0xC0] = False  # continuation bytes, allowed after the leads below
_ODD[0xC3:0xC9] = False  # leads of U+00C0 to U+023F, all letters but U+00D7 and U+00F7; U+0130 isn't one when lower-cased
_TRAIL = b".,;:!?"
_CHUNK = 20_000
#: Words of up to so many bytes are hashed eight bytes at a time.
_SHORT = 64
_STEP = constants(_SHORT // 8 + 1, 4)
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], U)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """ids of blocks of texts, for tokenizers that pass splits_words()."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.fast = self.splits_words(spec)
        suffix = spec["model"].get("end_of_word_suffix") or ""
        vocab = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.ends_word[i] = bool(suffix) and token.endswith(suffix)
        marks = [self._ids(chr(c)) for c in _TRAIL] if self.fast else []
        self.marks = np.full(256, -1)
        self.fast = self.fast and all(len(m) == 1 for m in marks)
        for c, m in zip(_TRAIL, marks):
            self.marks[c] = m[0]
        self.forget()

    @staticmethod
    def splits_words(spec: dict) -> bool:
        """Whether the file's rules make ids word by word: lower-casing, no white space in any match."""
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        words_only = split.get("pattern") == {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"} and split.get("behavior") == "Removed"
        no_space = all(not any(c.isspace() for c in t["content"]) and not t["lstrip"] and not t["rstrip"] for t in spec.get("added_tokens", []))
        return kinds == ["NFC", "Replace", "Lowercase"] and words_only and no_space and spec["model"].get("end_of_word_suffix") == "</w>"

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def forget(self) -> None:
        none = (np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64))
        #: known hashes in order, with their word's place and size in ids; recent ones apart, so that few new words don't
        #: move all others
        self.main, self.recent = none, none
        self.ids = np.array([END_ID, *self.marks], np.int32)  # the end id and the marks by byte come first
        self.n_ids = len(self.ids)

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (-1: unknown) and sizes of words by hash."""
        at, size = np.full(len(h), -1), np.zeros(len(h), np.int64)
        for known, places, sizes in (self.main, self.recent):
            if len(known):
                i = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = known[i] == h
                at[hit], size[hit] = places[i[hit]], sizes[i[hit]]
        return at, size

    def _keep(self, h: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        if self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.n_ids], np.zeros(self.n_ids + len(ids), np.int32)])
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        at = self.n_ids + np.cumsum(size) - size
        self.n_ids += len(ids)
        self.recent = _in_order(self.recent, (h, at, size))
        if len(self.recent[0]) > max(1 << 15, len(self.main[0]) // 2):
            self.main, self.recent = _in_order(self.main, self.recent), tuple(x[:0] for x in self.recent)

    def _learn(self, data: np.ndarray, h: np.ndarray, start: np.ndarray, end: np.ndarray, plain: np.ndarray) -> None:
        """Distinct new words. Plain ones are single pre-tokens, whose last id alone ends a word, and are
        encoded many at a time; the others each as a text of its own."""
        raw = data.tobytes()
        new_ids, sizes, order = [], [], np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        group, groups, n = [], [], 0
        for i in order[: int(plain.sum())]:
            group.append(raw[start[i] : end[i]].decode())
            n += len(group[-1])
            if n > _CHUNK:
                groups.append(" ".join(group))
                group, n = [], 0
        if group:
            groups.append(" ".join(group))
        if groups:
            flat = np.concatenate([np.array(e.ids, np.int32) for e in self.library.encode_batch_fast(groups, add_special_tokens=False)])
            last = np.flatnonzero(self.ends_word[flat])
            if len(last) != int(plain.sum()):
                raise ValueError("words and ids don't match")
            new_ids.append(flat)
            sizes.append(np.diff(np.concatenate([[-1], last])))
        odd = [raw[start[i] : end[i]].decode() for i in order[int(plain.sum()) :]]
        if odd:
            lists = [e.ids for e in self.library.encode_batch_fast(odd, add_special_tokens=False)]
            new_ids.append(np.fromiter(chain.from_iterable(lists), np.int32))
            sizes.append(np.fromiter(map(len, lists), np.int64))
        self._keep(h[order], np.concatenate(new_ids), np.concatenate(sizes))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts of a column, each with the end id after it, and the offsets of the texts."""
        if not self.fast:
            lists = [np.array([*e.ids, END_ID], np.int32) for e in self.library.encode_batch_fast(column.fill_null("").to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.int32), *lists]), np.cumsum([0, *map(len, lists)])
        parts, sizes = [], []
        for b in blocks(column, size=1 << 20):
            ids, n = self._block(b)
            parts.append(ids)
            sizes.append(n)
        return np.concatenate([np.zeros(0, np.int32), *parts]), np.cumsum(np.concatenate([[0], *sizes]))

    def _block(self, b: Block) -> tuple[np.ndarray, np.ndarray]:
        start, end, doc = bounds(b, NOT_SPACE)
        mark = np.zeros(len(start), np.int64)
        plain = np.zeros(len(start), bool)
        data = b.data
        if len(start):
            odd = _ODD[data]
            odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)) | (data[:-1] == 0xC4) & (data[1:] == 0xB0)
            odd = np.concatenate([[0], np.cumsum(odd, dtype=np.int64)])
            special = np.flatnonzero(data == ord("<"))  # special tokens are matched before lower-casing
            last, tail = data[end - 1], odd[end] - odd[start]
            cut = (self.marks[last] >= 0) & (end - start > 1) & (tail == 1) & (odd[end - 1] == odd[start])
            mark[cut] = 1 + last[cut]
            # letters and what follows them, if that is ASCII without letters, are two words that the rules part too
            two = ~cut & (tail > 0) & (tail < end - start) & (odd[end] - odd[end - tail] == tail) & (data[end - np.maximum(tail, 1)] < 0x80)
            end[cut] -= 1
            two[np.searchsorted(start, special, "right") - 1] = False
            two = np.flatnonzero(two)
            middle = (end - tail)[two]
            start, end, mark, doc = np.insert(start, two + 1, middle), np.insert(end, two, middle), np.insert(mark, two + 1, 0), np.insert(doc, two + 1, doc[two])
            plain = odd[end] == odd[start]
            data = np.zeros(len(b.data) + 8, np.uint8)
            data[:-8] = _LOWER[b.data]
            for i in np.unique(np.searchsorted(start, special, "right") - 1):
                data[start[i] : end[i]] = b.data[start[i] : end[i]]
        n, h = len(start), _word_hash(data, start, end)
        known, first, inv = np.unique(h, return_index=True, return_inverse=True)
        if len(self.main[0]) + len(self.recent[0]) + len(known) > MAX_WORDS:
            self.forget()
        place, length = self._find(known)
        new = place < 0
        if new.any():
            f = first[new]
            self._learn(data, known[new], start[f], end[f], plain[f])
            place, length = self._find(known)
        # every word, the mark after it, and every text's end
        of = np.zeros(2 * n + b.rows, np.int64)
        size = np.zeros(2 * n + b.rows, np.int64)
        here = 2 * np.arange(n) + doc
        of[here], size[here] = place[inv], length[inv]
        of[here + 1], size[here + 1] = mark, mark > 0
        ends = 2 * np.cumsum(np.bincount(doc, minlength=b.rows)) + np.arange(b.rows)
        size[ends] = 1
        done = np.cumsum(size)
        ids = self.ids[np.repeat(of - (done - size), size) + np.arange(done[-1] if len(done) else 0)]
        return ids, np.diff(np.concatenate([[0], done[ends]]))


def _word_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words of data, which has eight more bytes than they need: short ones eight bytes at a time."""
    size = end - start
    h = splitmix(size.astype(U) * _STEP[-1])
    eight = np.ndarray((max(0, len(data) - 7),), "<u8", np.ascontiguousarray(data), 0, (1,))
    for j in range(-(-min(int(size.max(initial=0)), _SHORT) // 8)):
        at = np.flatnonzero((size > 8 * j) & (size <= _SHORT)) if j or len(size) and size.max() > _SHORT else slice(None)
        h[at] = splitmix(h[at] ^ ((eight[start[at] + 8 * j] & _MASK[np.minimum(size[at] - 8 * j, 8)]) * _STEP[j]))
    long = size > _SHORT
    h[long] = run_hash(data, start[long], end[long])
    return h


def _in_order(a: tuple, b: tuple) -> tuple:
    both = [np.concatenate(x) for x in zip(a, b)]
    order = np.argsort(both[0], kind="stable")
    return tuple(x[order] for x in both)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(documents: DataFrame, path: str, tokenizer: str) -> None:
    """Write the token files of documents to path."""
    schema = pa.schema([("doc_id", pa.int64()), ("part_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def make(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known, before = encoder(tokenizer), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                ids, off = known.encode(part.column("text"))
                cols = [part.column("doc_id"), pa.array(before + off[:-1]), pa.array(np.diff(off)), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids))]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)
                before += int(off[-1])

    # the last two keys split an id, or a row, that many rows share
    docs = text_input(documents).repartitionByRange("doc_id", F.xxhash64("text"), F.rand(7)).sortWithinPartitions("doc_id", F.xxhash64("text"))
    out = docs.mapInArrow(tidy(make), "doc_id long, part_start long, n_tokens long, ids array<int>").write.option("compression", "zstd")
    settings = {"parquet.writer.version": "PARQUET_2_0", "parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES, "parquet.enable.dictionary": "true"}
    settings |= {f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "part_start", "n_tokens")}
    for k, v in settings.items():
        out = out.option(k, v)
    out.parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids, from the files alone. The offsets of the files come from
    their metadata columns. There is one row a file, so that one task can add them up; files of one least id are in
    the order of their names."""
    files = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    sums = files.groupBy("file").agg(F.min("doc_id").alias("least"), F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("least", F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = written(sums.select("file", F.coalesce(before, F.lit(0)).alias("before")), "token-offsets")
    offsets = F.broadcast(offsets) if offsets.count() <= MAX_BROADCAST_FILES else offsets
    start = (F.col("before") + F.col("part_start")).alias("start")
    return files.join(offsets, "file").select("doc_id", start, "n_tokens", "ids")


def read_range(spark, path: str, low: int, high: int) -> DataFrame:
    """What read_tokens() has of the documents with ids from low to high, but for start. Other row groups and pages aren't read."""
    return spark.read.parquet(path).filter(F.col("doc_id").between(low, high)).select("doc_id", "n_tokens", "ids")


def token_digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens (of the list that was read) and ids_crc32."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def make(batch):
        ids = batch.column("ids")
        off = ids.offsets.to_numpy().astype(np.int64)
        raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4"))).cast("B")
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(off[:-1], off[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(off)), pa.array(crc, pa.int64())], schema=schema)

    return map_arrow(tokens, make, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_of(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write documents' token files to the shared folder and read them back."""
    path = fresh_path(documents.sparkSession, "tokens")
    write_tokens(documents, path, tokenizer or default_tokenizer())
    return read_tokens(documents.sparkSession, path)

"""Token ids in binary files of patched frame-of-reference blocks.

The ids of all documents, in ascending order of document id, are one stream
over numbered files.  A file holds blocks of ``block_ids`` ids.  A block's
smallest id is subtracted; what remains is packed at the width that a stated
share of the block's values fits in, and the rest (the patches) keep their high
bits in an exception list.  A footer indexes the block starts and lists the
documents, so any span of ids costs the blocks that it touches.

    header      magic, block_ids (u32), 0 (u32)
    block       minimum (u32), ids - 1 (u16), exceptions (u16), width (u8),
                bytes of an exception's high part (u8); packed 64-bit words;
                positions of the exceptions (u8, or u16 in blocks over 256 ids);
                their high parts
    footer      block starts (u64 each); document ids (i64 each), null marks
                (u8 each), numbers of ids (u64 each)
    trailer     blocks, documents, ids, start of the footer (u64 each), magic

All numbers are little-endian.
"""

from __future__ import annotations

import hashlib
import os
import struct
import sys
import types
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from natspark.llm.common import gather_spans, materialize, text_chunks
from natspark.llm.warc import filesystem

MAGIC = b"PFORIDS1"
_HEADER, _BLOCK, _TRAILER = "<8sII", "<IHHBB", "<QQQQ8s"
_LIMITS = np.uint64(1) << np.arange(33, dtype=np.uint64)

INDEX_SCHEMA = "shard int, seq int, file string, n_ids long, n_docs long"


# ------------------------------------------------------------------ the blocks

def _words(values: np.ndarray, width: int) -> np.ndarray:
    """Pack rows of 64 values of ``width`` bits into ``width`` words each."""
    out = np.zeros((len(values), width), np.uint64)
    for i in range(64 if width else 0):
        at, shift = divmod(i * width, 64)
        out[:, at] |= values[:, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, at + 1] |= values[:, i] >> np.uint64(64 - shift)
    return out


def _values(words: np.ndarray, width: int) -> np.ndarray:
    """The rows of 64 values that ``_words`` packed."""
    out = np.zeros((len(words), 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(64 if width else 0):
        at, shift = divmod(i * width, 64)
        v = words[:, at] >> np.uint64(shift)
        if shift + width > 64:
            v |= words[:, at + 1] << np.uint64(64 - shift)
        out[:, i] = v & mask
    return out


def pack_blocks(ids: np.ndarray, block_ids: int = 256, share: float = 0.9) -> list[bytes]:
    """The blocks of ``ids`` (unsigned 32-bit); the last one may be shorter.

    ``share`` of a block's values, at least, fit in its width.
    """
    if block_ids % 64 or not 64 <= block_ids <= 65536:
        raise ValueError("block_ids: a multiple of 64 up to 65536")
    if not len(ids):
        return []
    n_blocks = -(-len(ids) // block_ids)
    count = np.full(n_blocks, block_ids)
    count[-1] = len(ids) - (n_blocks - 1) * block_ids
    grid = np.full(n_blocks * block_ids, ids[-1], np.uint64)
    grid[:len(ids)] = ids
    grid = grid.reshape(n_blocks, block_ids)
    low = grid.min(axis=1)
    grid -= low[:, None]
    rank = max(0, min(block_ids - 1, int(np.ceil(share * block_ids)) - 1))
    width = np.searchsorted(_LIMITS, np.partition(grid, rank, axis=1)[:, rank], "right")
    high = grid >> width[:, None].astype(np.uint64)
    high[np.arange(block_ids) >= count[:, None]] = 0
    rows, cols = np.nonzero(high)
    patches = np.bincount(rows, minlength=n_blocks)
    high_bytes = np.array([0, 1, 2, 4, 4])[-(-np.searchsorted(_LIMITS, high.max(axis=1), "right") // 8)]
    first = np.cumsum(patches) - patches
    packed: list[bytes] = [b""] * n_blocks
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        if w:
            words = _words((grid[mine] & np.uint64((1 << int(w)) - 1)).reshape(-1, 64), int(w))
            raw = words.reshape(len(mine), -1).astype("<u8").view(np.uint8).reshape(len(mine), -1)
            for k, r in zip(mine, raw):
                packed[k] = r[:8 * int(w) * -(-int(count[k]) // 64)].tobytes()
    place = "u1" if block_ids <= 256 else "<u2"
    out = []
    for k in range(n_blocks):
        a, b = first[k], first[k] + patches[k]
        out.append(struct.pack(_BLOCK, int(low[k]), int(count[k]) - 1, b - a, int(width[k]), int(high_bytes[k])) + packed[k]
                   + cols[a:b].astype(place).tobytes()
                   + (high[k, cols[a:b]].astype(f"<u{high_bytes[k]}").tobytes() if b > a else b""))
    return out


def unpack_blocks(raw: bytes, starts: np.ndarray, block_ids: int) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` in ``raw``."""
    n = len(starts)
    heads = [struct.unpack_from(_BLOCK, raw, int(s)) for s in starts]
    low, count, patches, width, high_bytes = (np.array(x, np.int64) for x in zip(*heads)) if n else [np.empty(0, int)] * 5
    count = count + 1
    out = np.zeros((n, block_ids), np.uint64)
    groups = -(-count // 64)
    begin = np.asarray(starts, np.int64) + struct.calcsize(_BLOCK)
    data = np.frombuffer(raw, np.uint8)
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        words = data[gather_spans(begin[mine], 8 * w * groups[mine])].view("<u8").reshape(-1, w)
        row = np.repeat(mine, groups[mine])
        col = gather_spans(np.zeros(len(mine), np.int64), groups[mine])
        out.reshape(n, -1, 64)[row, col] = _values(words.astype(np.uint64), int(w))
    place = 1 if block_ids <= 256 else 2
    at = begin + 8 * width * groups
    for k in np.flatnonzero(patches):
        where = np.frombuffer(raw, f"<u{place}", patches[k], at[k])
        high = np.frombuffer(raw, f"<u{high_bytes[k]}", patches[k], at[k] + place * patches[k])
        out[k, where] |= high.astype(np.uint64) << np.uint64(width[k])
    out += low[:, None].astype(np.uint64)
    return out[np.arange(block_ids) < count[:, None]].astype(np.uint32)


# -------------------------------------------------------------------- one file

class TokenWriter:
    """Appends documents; memory holds less than a run of blocks, and of each
    document 17 bytes for the footer."""

    def __init__(self, out: BinaryIO, block_ids: int, share: float):
        self.out, self.block_ids, self.share = out, block_ids, share
        self.at = out.write(struct.pack(_HEADER, MAGIC, block_ids, 0))
        self.starts: list[np.ndarray] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rest = np.empty(0, np.uint32)
        self.n_ids = self.n_docs = 0

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append((doc_ids.astype("<i8"), nulls.astype("u1"), counts.astype("<u8")))
        self.n_docs += len(counts)
        self.n_ids += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // self.block_ids * self.block_ids
        self._put(ids[:whole])
        self.rest = ids[whole:].copy()

    def _put(self, ids: np.ndarray) -> None:
        run = self.block_ids * 4096
        for i in range(0, len(ids), run):
            blocks = pack_blocks(ids[i:i + run], self.block_ids, self.share)
            sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
            self.starts.append((self.at + np.cumsum(sizes) - sizes).astype("<u8"))
            self.out.write(b"".join(blocks))
            self.at += int(sizes.sum())

    def close(self) -> None:
        self._put(self.rest)
        starts = np.concatenate([*self.starts, np.empty(0, "<u8")])
        self.out.write(starts.tobytes())
        for k in range(3):
            self.out.write(b"".join(d[k].tobytes() for d in self.docs))
        self.out.write(struct.pack(_TRAILER, len(starts), self.n_docs, self.n_ids, self.at, MAGIC))
        self.out.close()


class TokenReader:
    """The documents and any span of the ids of one file."""

    def __init__(self, file: BinaryIO, size: int):
        self.file = file
        file.seek(0)
        magic, self.block_ids, _ = struct.unpack(_HEADER, file.read(struct.calcsize(_HEADER)))
        tail_at = size - struct.calcsize(_TRAILER)
        file.seek(tail_at)
        n_blocks, n_docs, self.n_ids, self.footer, tail = struct.unpack(_TRAILER, file.read())
        if magic != MAGIC or tail != MAGIC:
            raise ValueError("no token file")
        file.seek(self.footer)
        raw = file.read(tail_at - self.footer)
        self.starts = np.append(np.frombuffer(raw, "<u8", n_blocks), self.footer).astype(np.int64)
        at = 8 * n_blocks
        self.doc_ids = np.frombuffer(raw, "<i8", n_docs, at)
        self.nulls = np.frombuffer(raw, "u1", n_docs, at + 8 * n_docs).astype(bool)
        self.counts = np.frombuffer(raw, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)

    def span(self, first: int, n: int) -> np.ndarray:
        """Ids first .. first+n-1; reads the blocks that hold them only."""
        if n <= 0:
            return np.empty(0, np.uint32)
        a, b = first // self.block_ids, (first + n - 1) // self.block_ids + 1
        self.file.seek(int(self.starts[a]))
        raw = self.file.read(int(self.starts[b] - self.starts[a]))
        got = unpack_blocks(raw, self.starts[a:b] - self.starts[a], self.block_ids)
        return got[first - a * self.block_ids:first - a * self.block_ids + n]

    def documents(self, run_ids: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(document, ids, last): a long document comes in several pieces."""
        at = 0
        ends = np.cumsum(self.counts)
        doc = 0
        while doc < len(ends):
            last = max(int(np.searchsorted(ends, at + run_ids, "right")), doc + 1)
            stop = int(min(ends[last - 1], at + run_ids)) if last == doc + 1 else int(ends[last - 1])
            ids = self.span(at, stop - at)
            if last == doc + 1:
                yield doc, ids, stop == ends[doc]
                doc += stop == ends[doc]
            else:
                cut = np.append(at, ends[doc:last]) - at
                for k in range(doc, last):
                    yield k, ids[cut[k - doc]:cut[k - doc + 1]], True
                doc = last
            at = stop


# ------------------------------------------------------------------- tokenizing

def _table(members: list[tuple[int, int]]) -> np.ndarray:
    t = np.zeros(256, bool)
    for a, b in members:
        t[a:b + 1] = True
    return t


# Bytes beside which a space surely ends a word: printable ASCII, and bytes of
# longer characters that no Unicode white space begins with (after the space)
# or ends with (before it).
_AFTER = _table([(0x21, 0x7E), (0xC3, 0xE0), (0xE4, 0xF4)])
_BEFORE = _table([(0x21, 0x7E), (0x8B, 0x9E), (0xA1, 0xA7), (0xAA, 0xAE), (0xB0, 0xBF)])
_LETTER = _table([(0x41, 0x5A), (0x61, 0x7A)])
_LATIN = _table([(0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF)])      # second bytes of the letters of U+00C0-00FF
_PUNCTUATION = _table([(0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)])


class UnitEncoder:
    """Encodes texts with a byte-level BPE of the tokenizers library.

    Its pre-tokenizer always cuts before a single space between two other
    characters, so a text's ids are those of its units between such spaces,
    end to end.  The library encodes each distinct unit once; a bounded table
    keeps the units seen first for later texts.  It also cuts between a letter
    and punctuation (where no special token could hold the two), and never
    inside a word of Latin letters: such a unit goes to the library's model
    directly.  With a tokenizer that cuts otherwise, every text is one unit.
    """

    def __init__(self, tokenizer: str, keep: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer)
        spec = json.loads(tokenizer)
        pre = spec.get("pre_tokenizer") or {}
        self.by_unit = (spec.get("normalizer") is None and not spec.get("truncation") and not spec.get("padding")
                        and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                        and not pre.get("add_prefix_space", True)
                        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]]
                                    for t in spec.get("added_tokens", [])))
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        # the library's printable stand-ins of bytes that aren't printable
        same = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        self.shown = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in same)}
        self.known: dict[str, bytes] = {}
        self.keep = keep

    def _units(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        begins = np.zeros(len(data) + 1, bool)
        if self.by_unit and len(data) > 2:
            before = _BEFORE[data[:-2]]
            before[1:] |= data[:-3] == 0xC3               # U+00C0-00FF, none of them a space
            alone = before & _AFTER[data[2:]]
            line = (data[1:-1] == 0x0A) & alone           # a line end by itself is a unit
            begins[1:-2] = (data[1:-1] == 0x20) & alone | line
            begins[2:-1] |= line
            raw = data.tobytes()
            if not any(t in raw for t in self.special):
                begins[1:-1] |= _PUNCTUATION[data[1:]] & _LETTER[data[:-1]]
                begins[2:-1] |= _PUNCTUATION[data[2:]] & _LATIN[data[1:-1]] & (data[:-2] == 0xC3)
        begins[offs] = True
        # a space that opens or closes a text is no cut of its own
        return np.flatnonzero(begins[:-1])

    def _encode_units(self, units: list[str]) -> list[bytes]:
        out: list = [None] * len(units)
        rest = []
        model, shown = self.library.model, self.shown
        for i, u in enumerate(units):
            word = u[1:] if u[0] == " " else u
            if self.by_unit and word.isalpha() and max(word) < "\u0250":
                u = u.replace(" ", shown[0x20]) if u.isascii() else u.encode().decode("latin-1").translate(shown)
                ids = [t.id for t in model.tokenize(u)]
                out[i] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                rest.append(i)
        for a in range(0, len(rest), 10_000):
            part = rest[a:a + 10_000]
            for i, e in zip(part, self.library.encode_batch([units[i] for i in part], add_special_tokens=False)):
                out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of each) of the texts ``data[offs[i]:offs[i+1]]``."""
        starts = self._units(data, offs)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        units = pa.Array.from_buffers(pa.large_string(), len(starts), [None, bounds, pa.py_buffer(data)])
        coded = units.dictionary_encode()
        which = coded.indices.to_numpy().astype(np.int64)
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = [self.known.get(u) for u in distinct]
        new = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(new, self._encode_units([distinct[i] for i in new])):
            ids[i] = x
            if len(distinct[i]) <= 40 and len(self.known) < self.keep:
                self.known[distinct[i]] = x
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        length = size[which]
        total = np.concatenate([[0], np.cumsum(length)])
        of_text = total[np.searchsorted(starts, offs, "left")]
        return flat[gather_spans((np.cumsum(size) - size)[which], length)], np.diff(of_text)


def _encoder(tokenizer: str) -> UnitEncoder:
    """The worker's encoder: later tasks find the units of earlier ones.

    Functions travel by value, and with them this module's globals; a module
    of the worker's own outlives them."""
    kept = vars(sys.modules.setdefault("_token_worker", types.ModuleType("_token_worker")))
    key = hashlib.sha1(tokenizer.encode()).hexdigest()
    if kept.get("key") != key:
        kept.update(key=key, encoder=UnitEncoder(tokenizer))
    return kept["encoder"]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """``end_id`` after each text's ids."""
    out = np.full(len(ids) + len(counts), end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out


# ----------------------------------------------------------------- Spark steps

def write_ids(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = 0, block_ids: int = 256, share: float = 0.9, file_ids: int = 1 << 28,
              chunk_bytes: int = 2 << 20, tasks: int | None = None) -> DataFrame:
    """Tokenize ``docs`` and write their ids, each document's followed by
    ``end_id``, in ascending order of id; return the index of the files.

    ``tokenizer`` is the content of a tokenizer file.  A null text is empty:
    its document has the end id only.  Null ids come first; rows of one id
    come in order of their text's hash, so a repeated id may hold any share of
    the rows and is split between files.  ``docs`` should be a stored table:
    equal rows are told apart by their place in it.  An empty table has no
    files.  A file is closed after ``file_ids`` ids, at the end of a document.

    Every task (``tasks`` of them, the session's shuffle partitions if not
    given) writes its range of ids; names hold the task attempt, and the
    index names those of the attempts that succeeded.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.select("id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("id").asc_nulls_first(), F.col("hash"), F.col("row")]
    # a stated number: small rows that cost much to tokenize aren't gathered into few tasks
    tasks = tasks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = src.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        fs, base = filesystem(folder)
        encoder = _encoder(tokenizer)
        writer, seq, files = None, 0, []

        def close() -> None:
            writer.close()
            files.append((ctx.partitionId(), seq, path, writer.n_ids, writer.n_docs))

        for b in batches:
            nulls = b.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = b.column(0).fill_null(0).to_numpy()
            for i, j, data, offs in text_chunks(b.column(1), chunk_bytes):
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    path = f"{base}/ids-{ctx.partitionId():06d}-{seq:04d}-{ctx.taskAttemptId()}.bin"
                    writer = TokenWriter(fs.open_output_stream(path, compression=None), block_ids, share)
                toks, n = encoder.encode(data, offs)
                writer.add(ids[i:j], nulls[i:j], n + 1, with_end(toks, n, end_id))
                if writer.n_ids >= file_ids:
                    close()
                    writer, seq = None, seq + 1
        if writer is not None:
            close()
        if files:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*files), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                ["shard", "seq", "file", "n_ids", "n_docs"])

    return materialize(ranged.mapInArrow(run, INDEX_SCHEMA), "token-index")


def with_starts(index: DataFrame) -> DataFrame:
    """Add ``first``: the ids in all files before (a row per file, so the one
    window over them stays small)."""
    before = Window.orderBy("shard", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return index.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(index: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """(id, start, n_ids, ids_crc32[, ids]) of every document of the files that
    ``index`` names: its place in the stream, the number of its ids, and the
    crc32 of them as little-endian unsigned 32-bit integers."""
    files = materialize(with_starts(index), "token-starts")
    schema = "id long, start long, n_ids long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for b in batches:
            for name, first, n_ids in zip(*(b.column(c).to_pylist() for c in range(3))):
                with fs.open_input_file(name) as file:
                    reader = TokenReader(file, file.size())
                    if reader.n_ids != n_ids or reader.counts.sum() != n_ids:
                        raise ValueError(f"{name} is damaged")
                    yield from _rows(reader, first)

    def _rows(reader: TokenReader, first: int) -> Iterator[pa.RecordBatch]:
        starts = first + np.cumsum(reader.counts) - reader.counts
        crc, parts, crcs, lists, done, held = 0, [], [], [], 0, 0

        def batch() -> pa.RecordBatch:
            s = slice(done, done + len(crcs))
            cols = [pa.array(reader.doc_ids[s], pa.int64(), mask=reader.nulls[s]), pa.array(starts[s], pa.int64()),
                    pa.array(reader.counts[s], pa.int64()), pa.array(crcs, pa.int64())]
            names = ["id", "start", "n_ids", "ids_crc32"]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(reader.counts[s])])
                flat = np.concatenate([*lists, np.empty(0, np.uint32)]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(cols, names)

        for _, ids, last in reader.documents():
            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
            if with_ids:
                lists.append(ids)
                held += len(ids)
            if last:
                crcs.append(crc)
                crc = 0
                if len(crcs) >= 10_000 or held >= 1 << 21:
                    yield batch()
                    done += len(crcs)
                    crcs, lists, held = [], [], 0
        if crcs:
            yield batch()

    n = max(1, files.count())
    return files.select("file", "first", "n_ids").repartition(n).mapInArrow(run, schema)

"""Exact removal of repeated passages with suffix order and common prefixes, built column by column over many documents.

A byte goes if a 50-byte string over it also starts in a document with a smaller doc_id. Every 50-byte string is filed
under its minimiser, the 22-byte piece of it with the smallest hash; equal strings have the same piece at the same place.
Pieces that one document alone holds are left out first. Around each other piece, the stretch of text whose strings it
files becomes one short row, and the rows of a bucket are a document collection for the column-wise construction: from
the last column to the first, one symbol of every row is put in front of its suffix. The symbols before the suffixes, in
suffix order, are the collection's Burrows-Wheeler transform so far; sorting them stably gives the order of the next column,
and range minima over the common-prefix lengths give its common prefixes. Where the common prefix reaches 50, suffixes start
with the same string, and the smallest doc_id among them keeps it.

A bucket's columns, its suffix order, its common prefixes and what is known of its rows are files of its task that are written and
read in sequence (short ones stay in memory): a round holds one column, a byte a row, and chunks of the rest.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm.shared import bucketed, durable, forget

LENGTH = 50
PIECE = 22
_RANGE = LENGTH - PIECE + 1  # pieces of one string
_PART = 1 << 19  # string starts looked at at once; positions within take 20 bits
_LOW = np.uint64((1 << 20) - 1)
BUCKET_BYTES = 12 << 20  # text per bucket
BATCH_BYTES = 4 << 20  # text that a task looks at together

_VALUES = np.random.default_rng(23).integers(1, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.full(_PART + 64, _BASE, np.uint64), dtype=np.uint64)
_INVERSES = np.cumprod(np.full(_PART + 64, pow(_BASE, -1, 1 << 64), np.uint64), dtype=np.uint64)


def minimisers(cells: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of string starts that share a minimiser: first start, number of starts, the piece's place and its key.
    The key's upper half is the bucket."""
    out = []
    for at in range(0, max(len(cells) - LENGTH + 1, 0), _PART):
        part = cells[at : at + _PART + LENGTH - 1]
        sums = np.r_[np.uint64(0), np.cumsum(_VALUES[part] * _POWERS[: len(part)], dtype=np.uint64)]
        h = (sums[PIECE:] - sums[:-PIECE]) * _INVERSES[: len(part) - PIECE + 1]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
        low = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= _RANGE:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < _RANGE:
            low = np.minimum(low[: len(low) - (_RANGE - width)], low[_RANGE - width :])
        place = (low & _LOW).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        h = h[place[first]]
        key = ((h >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | (h & np.uint64(0xFFFFFFFF))
        out.append((first + at, np.diff(np.r_[first, len(place)]), place[first] + at, key))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)


def _cells(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def _runs(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)


_SENT = "bucket long, kind int, doc_id long, tag long, data binary"
_FOUND = "doc_id long, tag long, value long"


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["bucket", "kind", "doc_id", "tag", "data"])


def tag_of(data: bytes) -> int:
    """Tells texts under one doc_id apart; Spark's xxhash64 of the text."""
    return xxhash.xxh64_intdigest(data, seed=42) - (1 << 64) * (xxhash.xxh64_intdigest(data, seed=42) >> 63)


def _by_document(doc: np.ndarray, values: np.ndarray) -> list[tuple[int, bytes]]:
    if not len(doc):
        return []
    order = np.argsort(doc, kind="stable")
    doc, values = doc[order], values[order]
    heads = _runs(doc)
    return [(int(doc[a]), values[a:b].tobytes()) for a, b in zip(heads, np.r_[heads[1:], len(doc)], strict=True)]


def _small(batches):
    """The batches in slices of about BATCH_BYTES of text (column 1), or single rows."""
    for batch in batches:
        count = max(1, min(batch.num_rows, -(-batch.column(1).nbytes // BATCH_BYTES)))
        rows = -(-batch.num_rows // count)
        for at in range(0, batch.num_rows, max(rows, 1)):
            yield batch.slice(at, rows)


def _keys_of(batches, buckets: int):
    """What a batch tells of its pieces. A piece that several documents of the batch hold is shared for all of them, and only
    the smallest goes on; so a piece that is everywhere costs its bucket one entry a batch."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in _small(batches):
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keys, docs = [], []
        for doc_id, text in zip(ids, texts, strict=True):
            key = np.unique(minimisers(_cells(text), buckets)[3])
            keys.append(key), docs.append(np.full(len(key), doc_id, np.int64))
        if not keys:
            continue
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        heads = _runs(key)
        several = np.zeros(len(key), bool)
        if len(key):
            several = np.repeat(np.maximum.reduceat(doc, heads) > doc[heads], np.diff(np.r_[heads, len(key)]))
        rows = [(-1 - d % (4 * buckets), 1, d, 0, data) for d, data in _by_document(doc[several], key[several])]
        key, doc = key[heads], doc[heads]
        table = np.unique(doc)
        number = np.searchsorted(table, doc).astype(np.uint32)
        at = np.searchsorted(key, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
        for b in np.flatnonzero(np.diff(at)).tolist():
            low, some = (key[at[b] : at[b + 1]] & np.uint64(0xFFFFFFFF)).astype(np.int64), number[at[b] : at[b + 1]]
            own = np.unique(some)
            head = np.array([len(low), len(own)], np.int64)
            parts = (head, np.diff(low, prepend=0).astype(np.uint32), np.searchsorted(own, some).astype(np.uint16 if len(own) < 65536 else np.uint32), np.diff(table[own], prepend=0))
            rows.append((b, 0, None, None, pack(b"".join(p.tobytes() for p in parts))))
        yield _sent(rows)


def _found(doc, tag, value) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (doc, tag, value)], names=["doc_id", "tag", "value"])


def _passed_on(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Documents and values of the rows that a batch has settled by itself."""
    rows = [(d, t, np.frombuffer(x, np.int64)) for d, t, x, k in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tag", "data", "kind")), strict=True) if k == 1]
    sizes = [len(v) for _, _, v in rows]
    return _found(np.repeat([d for d, _, _ in rows], sizes), np.repeat([t for _, t, _ in rows], sizes), np.concatenate([v for _, _, v in rows]) if rows else [])


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one bucket: each document's keys that another document holds too. Texts under one id count as one document here: their
    lists only say where to look."""
    unpack = zstandard.ZstdDecompressor().decompress
    keys, docs = [], []
    for batch in batches:
        yield _passed_on(batch)
        for data, k, bucket in zip(*(batch.column(c).to_pylist() for c in ("data", "kind", "bucket")), strict=True):
            if k == 0:
                raw = unpack(data)
                n, m = np.frombuffer(raw, np.int64, 2).tolist()
                keys.append(np.cumsum(np.frombuffer(raw, np.uint32, n, 16), dtype=np.int64) + (bucket << 32))
                number = np.frombuffer(raw, np.uint16 if m < 65536 else np.uint32, n, 16 + 4 * n)
                docs.append(np.cumsum(np.frombuffer(raw, np.int64, m, 16 + 4 * n + number.nbytes))[number])
    if keys:
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        heads = _runs(key)
        several = np.repeat(np.maximum.reduceat(doc, heads) > np.minimum.reduceat(doc, heads), np.diff(np.r_[heads, len(key)]))
        yield _found(doc[several], np.zeros(several.sum(), np.int64), key[several])


_WIDE = _RANGE - 1 + LENGTH


HELD = 1 << 18  # stretches that a task compares with each other


def _settled(held: dict, buckets: int) -> pa.RecordBatch:
    """Of equal stretches only the smallest document's go on, packed by bucket; for the others all their strings are repeated."""
    pack = zstandard.ZstdCompressor(level=3).compress
    marks, width = {}, {}
    for (key, off, data), found in held.items():
        least = min(found)[0]
        for doc_id, tag, a, n in found:
            if doc_id == least:
                width.setdefault(key >> 32, []).append((doc_id, tag, a, off, n, data))
            else:
                marks.setdefault((doc_id, tag), []).append(a << 8 | n)
    rows = [(-1 - d % (4 * buckets), 1, d, t, np.array(x, np.int64).tobytes()) for (d, t), x in marks.items()]
    for bucket, found in width.items():
        texts = {x: k for k, x in enumerate(sorted({f[:2] for f in found}))}
        head = np.array([len(found), len(texts)], np.int64)
        number, start = (np.array(x, np.uint32) for x in ([texts[f[:2]] for f in found], [f[2] for f in found]))
        off, count = (np.array([f[k] for f in found], np.uint8) for k in (3, 4))
        rows.append((bucket, 0, None, None, pack(b"".join([head.tobytes(), np.array(list(texts), np.int64).tobytes(), number.tobytes(), start.tobytes(), off.tobytes(), count.tobytes(), *[f[5] for f in found]]))))
    return _sent(rows)


def _rows_of(batches, buckets: int):
    """The stretches around shared pieces, of one batch at a time."""
    for batch in _small(batches):
        held, n_held = {}, 0
        lists = batch.column(2)
        wanted, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
        for row, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            cells = _cells(text)
            data = cells.tobytes()
            tag = tag_of(data)
            start, count, place, key = minimisers(cells, buckets)
            shared = np.isin(key, wanted[bounds[row] : bounds[row + 1]].view(np.uint64))
            start, count, place, key = (x[shared] for x in (start, count, place, key))
            for at in range(0, len(start), HELD):
                for a, n, p, k in zip(*(x[at : at + HELD].tolist() for x in (start, count, place, key)), strict=True):
                    held.setdefault((k, p - a, data[a : a + n + LENGTH - 1]), []).append((doc_id, tag, a, n))
                n_held += len(start[at : at + HELD])
                if n_held >= HELD:
                    yield _settled(held, buckets)
                    held, n_held = {}, 0
        yield _settled(held, buckets)


CHUNK = 1 << 20  # rows of a round that are in memory at once


def _array(n: int, kind, fill=0) -> np.ndarray:
    """An array of the task: in a file of its own, that the system writes and reads in pieces, if it is longer than a chunk."""
    if n <= CHUNK:
        return np.full(n, fill, kind)
    file = tempfile.TemporaryFile()
    file.truncate(n * np.dtype(kind).itemsize)  # zeros
    out = np.memmap(file, kind, "r+", shape=(n,))
    if fill:
        out[:] = fill
    return out


class _Minima:
    """Common prefixes of the next round while the entries of this one come in order, a chunk at a time. For every symbol it is known
    what the least common prefix since its last entry is."""

    def __init__(self, length: int):
        self.length, self.since = length, np.full(256, -1, np.int16)  # -1: the symbol has not come yet

    def take(self, symbols: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chunk's places in order of symbols (stable), and the next round's common prefixes in that order."""
        n = len(symbols)
        turn = np.argsort(symbols, kind="stable").astype(np.int32)
        levels, span = [lcp], 1
        longest = int(np.diff(turn).max(initial=1))
        while 2 * span <= longest:
            levels.append(np.minimum(levels[-1][:-span], levels[-1][span:]))
            span *= 2
        own = symbols[turn]
        new = np.zeros(n, np.uint8)
        at = np.flatnonzero(own[1:] == own[:-1])
        if len(at):
            lo, hi = turn[at] + 1, turn[at + 1]
            level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
            least = np.empty(len(at), np.uint8)
            for k in np.unique(level).tolist():
                pick = level == k
                least[pick] = np.minimum(levels[k][lo[pick]], levels[k][hi[pick] - (1 << k) + 1])
            new[at + 1] = np.minimum(least, self.length - 1) + 1
        heads = _runs(own)
        tails = np.r_[heads[1:], n] - 1
        name, first, last = own[heads], turn[heads], turn[tails]
        before = self.since[name]  # a symbol's first entry here follows its last one in an earlier chunk
        known = before >= 0
        if known.any():
            upto = np.minimum.accumulate(lcp)
            new[heads[known]] = np.minimum(np.minimum(before[known], upto[first[known]]), self.length - 1) + 1
        after = np.r_[np.minimum.accumulate(lcp[::-1])[::-1], self.length].astype(np.int16)
        self.since = np.where(self.since >= 0, np.minimum(self.since, after[0]), self.since)
        self.since[name] = after[last + 1]
        return turn, new


def common_starts(columns: Iterator[np.ndarray], wide: int, valid, doc: np.ndarray, length: int, starts: int) -> np.ndarray:
    """For each row, bits of the first `starts` columns: whether the suffix from there starts with `length` symbols that a valid suffix of
    a smaller doc starts with as well.

    columns: the symbols of all rows, from the last of `wide` columns to the first; valid: of rows and a column, which count as starts. Only
    suffixes of one column are compared. Each round puts the column's symbols in front of all suffixes: in suffix order they are
    the Burrows-Wheeler transform of what is inserted so far, and its stable sort maps each row to its next place. Order and
    common prefixes are read in sequence, chunk by chunk, and written to the next round's in as many sequences as there are symbols;
    longer ones than a chunk are files.
    """
    n = len(doc)
    order, lcp, out = _array(n, np.int32), _array(n, np.uint8), _array(n, np.uint32)
    for a in range(0, n, CHUNK):
        order[a : a + CHUNK] = np.arange(a, min(n, a + CHUNK), dtype=np.int32)
    spare = _array(n, np.int32), _array(n, np.uint8)
    none = np.iinfo(np.int64).max
    for column, symbols in zip(range(wide - 1, -1, -1), columns, strict=True):
        minima = _Minima(length)
        to = np.r_[0, np.cumsum(np.bincount(symbols, minlength=256))][:256]
        for a in range(0, n, CHUNK):
            rows = np.asarray(order[a : a + CHUNK])
            transform = symbols[rows]
            turn, new = minima.take(transform, np.asarray(lcp[a : a + CHUNK]))
            rows, own = rows[turn], transform[turn]
            heads = _runs(own)
            for h, t in zip(heads.tolist(), [*heads[1:].tolist(), len(own)], strict=True):
                place = to[own[h]]
                spare[0][place : place + t - h], spare[1][place : place + t - h] = rows[h:t], new[h:t]
                to[own[h]] += t - h
        (order, lcp), spare = spare, (order, lcp)
        if column >= starts:
            continue
        open_: list[np.ndarray] = []  # of the group that the next chunk may go on with
        for a in range(0, n, CHUNK):
            rows, heads = np.asarray(order[a : a + CHUNK]), np.flatnonzero(lcp[a : a + CHUNK] < length)
            cut = heads[-1] if len(heads) and a + CHUNK < n else 0 if a + CHUNK < n else len(rows)
            first = heads[0] if len(heads) else len(rows)
            if len(heads) or a + CHUNK >= n:
                if open_ and first:
                    open_.append(rows[:first])
                if open_:
                    _mark(out, np.concatenate(open_), np.zeros(1, np.int64), column, valid, doc, none)
                    open_ = []
                if first < cut:
                    _mark(out, rows[first:cut], heads[heads < cut] - first, column, valid, doc, none)
                if cut < len(rows):
                    open_.append(rows[cut:])
            else:
                open_.append(rows)
    return out


def _mark(out: np.ndarray, rows: np.ndarray, heads: np.ndarray, column: int, valid, doc: np.ndarray, none: int) -> None:
    """In groups of suffixes that start alike, mark those that a smaller doc's valid one precedes."""
    ok, of = valid(rows, column), doc[rows]
    smallest = np.minimum.reduceat(np.where(ok, of, none), heads)
    again = ok & (of > np.repeat(smallest, np.diff(np.r_[heads, len(rows)])))
    out[rows[again]] |= np.uint32(1 << column)


SPOOL = 1 << 20  # bytes of a column that stay in memory


class _Columns:
    """The columns of a bucket's rows, each a file of the task that is written and read in sequence. Short ones stay in memory."""

    def __init__(self):
        self._files = [tempfile.SpooledTemporaryFile(max_size=SPOOL) for _ in range(_WIDE)]

    def add(self, left: np.ndarray, size: np.ndarray, text: np.ndarray) -> None:
        """Rows whose symbols stand from column `left` on; zeros fill them up."""
        rows = np.zeros((_WIDE, len(left)), np.uint8)
        cell = np.arange(len(text), dtype=np.int32) - np.repeat((np.cumsum(size) - size - left).astype(np.int32), size)
        rows[cell, np.repeat(np.arange(len(left), dtype=np.int32), size)] = text
        for file, column in zip(self._files, rows, strict=True):
            file.write(column.tobytes())

    def __iter__(self):
        for file in reversed(self._files):
            file.seek(0)
            yield np.frombuffer(file.read(), np.uint8)

    def close(self) -> None:
        for file in self._files:
            file.close()


class _Metas:
    """What is known of a bucket's rows: doc, tag, start, left and count, each a file of the task like the columns."""

    _KINDS = (np.int64, np.int64, np.uint32, np.uint8, np.uint8)

    def __init__(self):
        self.rows, self._files = 0, [tempfile.SpooledTemporaryFile(max_size=8 * SPOOL) for _ in self._KINDS]

    def add(self, *values: np.ndarray) -> None:
        self.rows += len(values[0])
        for file, x, kind in zip(self._files, values, self._KINDS, strict=True):
            file.write(np.ascontiguousarray(x, kind).tobytes())

    def arrays(self) -> list[np.ndarray]:
        out = []
        for file, kind in zip(self._files, self._KINDS, strict=True):
            array = _array(self.rows, kind)
            file.seek(0)
            for a in range(0, self.rows, CHUNK):
                some = array[a : a + CHUNK]
                some[:] = np.frombuffer(file.read(some.nbytes), kind)
            out.append(array)
        return out

    def close(self) -> None:
        for file in self._files:
            file.close()


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one bucket: each text's stretches of starts of repeated strings, as start << 8 | number."""
    unpack = zstandard.ZstdDecompressor().decompress
    columns, metas = _Columns(), _Metas()
    try:
        for batch in batches:
            yield _passed_on(batch)
            for x, kind in zip(batch.column("data").to_pylist(), batch.column("kind").to_pylist(), strict=True):
                if kind:
                    continue
                x = unpack(x)
                n, m = np.frombuffer(x, np.int64, 2).tolist()
                texts, at = np.frombuffer(x, np.int64, 2 * m, 16).reshape(m, 2), 16 + 16 * m
                number, start = np.frombuffer(x, np.uint32, n, at), np.frombuffer(x, np.uint32, n, at + 4 * n)
                off, count = np.frombuffer(x, np.uint8, n, at + 8 * n), np.frombuffer(x, np.uint8, n, at + 9 * n)
                left = _RANGE - 1 - off
                metas.add(*texts[number].T, start, left, count)
                size, text, done = count.astype(np.int64) + LENGTH - 1, np.frombuffer(x, np.uint8, offset=at + 10 * n), 0
                for a in range(0, n, 8192):
                    part = slice(a, a + 8192)
                    bytes_ = int(size[part].sum())
                    columns.add(left[part].astype(np.int64), size[part], text[done : done + bytes_])
                    done += bytes_
        if metas.rows:
            doc, tag, start, left, count = metas.arrays()
            within = lambda rows, c: (left[rows] <= c) & (c < left[rows].astype(np.int16) + count[rows])
            found = common_starts(columns, _WIDE, within, doc, LENGTH, _RANGE)
            for a in range(0, len(doc), 1 << 16):
                bits = (np.asarray(found[a : a + (1 << 16), None]) >> np.arange(_RANGE, dtype=np.uint32)) & 1
                edge = np.diff(np.pad(bits, ((0, 0), (1, 1))).astype(np.int8), axis=1)
                (r, first), (_, last) = np.nonzero(edge == 1), np.nonzero(edge == -1)
                r += a
                yield _found(doc[r], tag[r], (start[r].astype(np.int64) + first - left[r]) << 8 | (last - first))
    finally:
        columns.close()
        metas.close()


def spans_of(marks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed spans [start, end) from start << 8 | number."""
    cover = np.zeros(size + 1, np.int32)
    np.add.at(cover, marks >> 8, 1)
    np.add.at(cover, (marks >> 8) + (marks & 255) + LENGTH - 1, -1)
    edge = np.diff(np.r_[0, np.cumsum(cover[:size]) > 0, 0].astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _left_of(data: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b"".join(data[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(data)], strict=True))


def cut_text(text: str | None, marks: list[int] | None, whole: bool) -> str | None:
    """The text without its repeated bytes. A character that loses some of its bytes goes as a whole."""
    if text is None or not (marks or whole):
        return text
    data = text.encode()
    if whole and len(data) >= LENGTH:
        return ""
    return _left_of(data, *spans_of(np.array(marks or [], np.int64), len(data))).decode("utf-8", "ignore")


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame, str, DataFrame]:
    """Of (doc_id, text): a row per document with sha256, tag, size and `whole` (a copy of a smaller document, which loses all it
    has); the texts in question by id, and their table's name; and (id, marks) with the starts of repeated strings in texts that are no whole copies, each
    with its text's tag: texts under one id are told apart."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    base = durable(docs.select("doc_id", F.sha2("text", 256).alias("sha"), F.xxhash64("text").alias("tag"), F.octet_length("text").cast("long").alias("n_bytes")), "base")
    # Written first, so that the join has two plain shuffles (or a broadcast, if there are few copies) and a hot text can be split.
    first = durable(base.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first"), "first")
    base = durable(base.join(first, "sha", "left").withColumn("whole", F.coalesce((F.col("n_bytes") >= LENGTH) & (F.col("doc_id") > F.col("first")), F.lit(False))).drop("first"), "base")
    buckets = max(1, -(-(base.agg(F.sum("n_bytes")).first()[0] or 0) // BUCKET_BYTES))

    numbered = docs.where("doc_id is not null")
    keys = numbered.mapInArrow(lambda it: _keys_of(it, buckets), _SENT).groupBy("bucket").applyInArrow(_shared_keys, _FOUND)
    judged = base.where("not whole and doc_id is not null").select("doc_id").distinct()
    lists = keys.join(judged, "doc_id", "left_semi").groupBy("doc_id").agg(F.collect_list("value").alias("lists"))
    texts, name = bucketed(numbered.join(lists.hint("merge"), "doc_id").withColumnRenamed("doc_id", "id"), "id")
    rows = texts.select("id", "text", "lists").mapInArrow(lambda it: _rows_of(it, buckets), _SENT)
    marks = rows.groupBy("bucket").applyInArrow(_repeated, _FOUND).groupBy("doc_id").agg(F.collect_list(F.struct("tag", "value")).alias("marks")).withColumnRenamed("doc_id", "id")
    return base, texts, name, durable(marks, "marks")


def own_marks(marks: Column, text: Column) -> Column:
    """The marks of a text among those of its id."""
    return F.transform(F.filter(marks, lambda m: m["tag"] == F.xxhash64(text)), lambda m: m["value"])


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    Null text is empty. A row without doc_id has no order among the others: it stays whole and removes nothing. Rows with one
    doc_id don't remove each other's strings, and each loses just what it repeats itself. Texts shorter than 50 bytes stay whole.
    An empty table gives an empty result; other columns are ignored.
    """
    base, texts, name, marks = repeats(docs)

    def cut(batches):
        for batch in batches:
            sha, n, removed, spans, kept = [], [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = text.encode()
                starts, ends = spans_of(np.array(found, np.int64), len(data))
                sha.append(hashlib.sha256(data).hexdigest()), removed.append(int((ends - starts).sum())), spans.append(len(starts))
                kept.append(hashlib.sha256(_left_of(data, starts, ends)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sha, pa.string()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "sha", "removed", "spans", "kept"])

    cuts = texts.select("id", "text").join(marks, "id").select("id", "text", own_marks(F.col("marks"), F.col("text")).alias("marks")).mapInArrow(cut, "doc_id long, sha string, removed long, spans long, kept string").dropDuplicates(["doc_id", "sha"])
    cuts = durable(cuts, "cuts")
    forget(docs.sparkSession, name)
    nothing = hashlib.sha256(b"").hexdigest()
    return base.join(cuts, ["doc_id", "sha"], "left").select(
        "doc_id", "n_bytes", F.when(F.col("whole"), F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(F.col("whole"), F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("whole"), F.lit(nothing)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))

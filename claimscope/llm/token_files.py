"""Token ids on disk: independent zstandard frames, a trailing seek table and a checksum for each frame.

A file follows the public seekable zstandard format, so any zstandard tool can unpack it:

* data frames, each the next ``FRAME_IDS`` ids of the file as little-endian unsigned 32-bit integers;
* index frames, each ``INDEX_DOCS`` documents (all but the last): ids (int64), whether the id is known (uint8), and where each
  document ends, counted in ids from the start of the file (uint64);
* a skippable frame with the number of ids and documents and the two sizes;
* a skippable frame with the seek table: compressed size, plain size and checksum (low half of XXH64) of every frame, the
  number of frames, flags and a magic number. It is found from the end of the file.

A document's ids are read from the tail, one index frame and the data frames that hold it.
"""

from __future__ import annotations

import json
import os
import posixpath
import re
import struct
import sys
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from claimscope.llm.packing import byte_symbols
from claimscope.session import fresh_dir

FRAME_IDS, INDEX_DOCS, LEVEL = 1 << 16, 1 << 13, 3
# Fixed by the format.
SKIPPABLE, SEEK_TABLE, SEEKABLE, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
_SUMMARY = "<QQII"
MANIFEST = "place int, file string, first_id long, last_id long, has_null boolean, docs long, ids long, bytes long"


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that the driver and all executors share, by URI or plain path."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), os.path.abspath(path)
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    for hadoop_name in ("s3a://", "s3n://"):
        path = path.replace(hadoop_name, "s3://", 1)
    return pafs.FileSystem.from_uri(path)


class TokenFileWriter:
    """Writes one file; at most one frame of ids and one of the index are held, besides 12 bytes a frame."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, index_docs: int = INDEX_DOCS, level: int = LEVEL):
        self.out, self.frame_ids, self.index_docs = out, frame_ids, index_docs
        self.packer = zstandard.ZstdCompressor(level=level)
        self.table, self.index, self.open_index = bytearray(), [], []
        self.pending, self.ids, self.docs, self.size = bytearray(), 0, 0, 0

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _frame(self, plain: bytes) -> None:
        packed = self.packer.compress(plain)
        self._write(packed)
        self.table += struct.pack("<III", len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.pending += ids
        self.ids += len(ids) // 4
        self.docs += 1
        self.open_index.append((doc_id, self.ids))
        if len(self.open_index) == self.index_docs:
            self._close_index()
        size = 4 * self.frame_ids
        if len(self.pending) >= size:
            whole = len(self.pending) // size * size
            for at in range(0, whole, size):
                self._frame(bytes(self.pending[at:at + size]))
            del self.pending[:whole]

    def _close_index(self) -> None:
        ids = np.array([0 if d is None else d for d, _ in self.open_index], "<i8")
        known = np.array([d is not None for d, _ in self.open_index], np.uint8)
        ends = np.array([e for _, e in self.open_index], "<u8")
        # kept packed until the data frames are done
        self.index.append(zlib.compress(ids.tobytes() + known.tobytes() + ends.tobytes(), 1))
        self.open_index = []

    def close(self) -> None:
        if self.pending:
            self._frame(bytes(self.pending))
        if self.open_index:
            self._close_index()
        for part in self.index:
            self._frame(zlib.decompress(part))
        summary = struct.pack(_SUMMARY, self.ids, self.docs, self.frame_ids, self.index_docs)
        self._write(struct.pack("<II", SKIPPABLE, len(summary)) + summary)
        frames = len(self.table) // 12
        self._write(struct.pack("<II", SEEK_TABLE, len(self.table) + 9) + bytes(self.table) + struct.pack("<IBI", frames, CHECKSUMS, SEEKABLE))


class TokenFile:
    """Reads one file by random access. ``unpacked`` counts the frames that were decompressed."""

    def __init__(self, source):
        self.source, size = source, source.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("not a token file: no seek table at its end")
        start = size - 9 - 12 * frames - 8
        head = self._at(start, 8 + 12 * frames)
        if struct.unpack("<II", head[:8]) != (SEEK_TABLE, 12 * frames + 9):
            raise ValueError("damaged seek table")
        table = np.frombuffer(head[8:], "<u4").reshape(frames, 3).astype(np.int64)
        self.packed, self.plain, self.sums = table[:, 0], table[:, 1], table[:, 2]
        self.offsets = np.cumsum(self.packed) - self.packed
        self.ids, self.docs, self.frame_ids, self.index_docs = struct.unpack(_SUMMARY, self._at(start - struct.calcsize(_SUMMARY), struct.calcsize(_SUMMARY)))
        self.data_frames = -(-self.ids // self.frame_ids)
        self.unpacker, self.unpacked = zstandard.ZstdDecompressor(), 0

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        data = self.source.read(n)
        if len(data) != n:
            raise ValueError("truncated token file")
        return data

    def frame(self, i: int) -> bytes:
        try:
            plain = self.unpacker.decompress(self._at(int(self.offsets[i]), int(self.packed[i])), max_output_size=int(self.plain[i]))
        except zstandard.ZstdError as e:
            raise ValueError(f"frame {i} is damaged") from e
        if len(plain) != self.plain[i] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"frame {i} doesn't match its checksum")
        self.unpacked += 1
        return plain

    def index(self, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, whether known, and ends of the documents of one index frame."""
        raw = self.frame(self.data_frames + part)
        n = len(raw) // 17
        return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool), np.frombuffer(raw, "<u8", n, 9 * n).astype(np.int64)

    def parts(self, start: int, end: int) -> Iterator[bytes]:
        """The bytes of ids ``start`` to ``end``, a frame at a time."""
        for i in range(start // self.frame_ids, -(-end // self.frame_ids) if end > start else 0):
            first = i * self.frame_ids
            yield self.frame(i)[4 * max(0, start - first):4 * (end - first)]

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """Id, start and end of every document."""
        at = 0
        for part in range(-(-self.docs // self.index_docs)):
            ids, known, ends = self.index(part)
            for doc, is_known, end in zip(ids.tolist(), known.tolist(), ends.tolist(), strict=True):
                yield (doc if is_known else None), at, end
                at = end

    def find(self, doc_ids: Iterable[int]) -> Iterator[tuple[int, int, int]]:
        """Id, start and end of each document with one of ``doc_ids``. Documents lie in ascending order of their ids, those without one last."""
        last = -(-self.docs // self.index_docs) - 1
        opened: dict[int, tuple] = {}

        def part(i: int) -> tuple:
            if i not in opened:
                if len(opened) > 8:
                    opened.clear()
                opened[i] = self.index(i)
            return opened[i]

        class Firsts:
            """(unknown, id) of the last document of each index frame, for bisection."""
            __len__ = lambda _: last + 1
            __getitem__ = lambda _, i: (not part(i)[1][-1], int(part(i)[0][-1]))

        for doc in sorted(set(doc_ids)):
            i = bisect_left(Firsts(), (False, doc))
            while i <= last:
                ids, known, ends = part(i)
                hits = np.flatnonzero(known & (ids == doc))
                for hit in hits.tolist():
                    before = int(ends[hit - 1]) if hit else (int(part(i - 1)[2][-1]) if i else 0)
                    yield doc, before, int(part(i)[2][hit])
                if not len(hits) or hits[-1] < len(ids) - 1:
                    break
                i += 1


class WordEncoder:
    """Ids of a ``tokenizers`` file whose pre-tokens never reach across a space or a line end, as little-endian 32-bit bytes.

    Such a text has the ids of the pieces between its spaces and line ends, one after the other. A bounded number of short
    pieces is remembered. A new piece goes through the library whole, with one exception: where the file splits by ``SPLIT``
    and the piece holds nothing but printable ASCII and Latin letters, for which that rule, lower case and composition are
    plain, it is split here, and the library's model merges each part that it hasn't met yet.
    """

    LONGEST = 64
    # How the file splits, and its steps before and after.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    STEPS = ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]

    def __init__(self, path: str, remember: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.remember, self.known, self.parts = Tokenizer.from_file(path), remember, {"": b""}, {}
        probe = "a B\nc"
        if self.tokenizer.encode(probe, add_special_tokens=False).ids != [
                i for w in probe.split() for i in self.tokenizer.encode(w, add_special_tokens=False).ids]:
            raise ValueError(f"{path}: white space is part of its tokens")
        self._learn_rule(path)

    def _learn_rule(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            rule = json.load(f)
        steps = [*((rule.get("normalizer") or {}).get("normalizers") or []), *((rule.get("pre_tokenizer") or {}).get("pretokenizers") or [])]
        plain = [s["type"] for s in steps] == self.STEPS and steps[3]["pattern"] == {"Regex": self.SPLIT} and steps[3]["invert"]
        latin = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
        self.simple = re.compile(f"[!-~{latin}]+" if plain else r"(?!)").fullmatch
        letters = f"a-z{latin}"
        self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[0-9]|[^{letters}0-9]+").findall
        self.added = [t["content"] for t in rule.get("added_tokens") or []]
        self.symbols = {b: c for c, b in byte_symbols().items()}

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            word = part if part.isascii() else "".join([self.symbols[b] for b in part.encode()])
            ids = np.array([t.id for t in self.tokenizer.model.tokenize(word)], "<u4").tobytes()
            if len(self.parts) > self.remember:
                self.parts.clear()
            if len(part) <= self.LONGEST:
                self.parts[part] = ids
        return ids

    def _ids(self, piece: str) -> bytes:
        if self.simple(piece) and not any(token in piece for token in self.added):
            return b"".join([self._part(part) for part in self.split(piece.lower())])
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        pieces, known = text.replace("\n", " ").split(" "), self.known
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            pass
        if len(known) > self.remember:
            known.clear()
            known[""] = b""
        out = []
        for p in pieces:
            ids = known.get(p)
            if ids is None:
                ids = self._ids(p)
                if len(p) <= self.LONGEST:
                    known[p] = ids
            out.append(ids)
        return b"".join(out)


def word_encoder(path: str) -> WordEncoder:
    """One encoder for each file and process. It is kept with the interpreter: this function comes anew with each task."""
    kept = sys.__dict__.setdefault("_word_encoders", {})
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def _written(folder: str, tokenizer: str, end_id: int, frame_ids: int, index_docs: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, first, last, nulls, stream, name = None, None, None, False, None, ""
        end, place = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        encode = word_encoder(tokenizer).encode
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    store, root = open_store(folder)
                    name, first = f"tokens-{place:06d}-{uuid.uuid4().hex}.zst", doc
                    stream = store.open_output_stream(posixpath.join(root, name), compression=None)
                    writer = TokenFileWriter(stream, frame_ids, index_docs)
                writer.add(doc, encode(text.as_py() or "") + end)
                last, nulls = (last, True) if doc is None else (doc, nulls)
        if writer is not None:
            writer.close()
            stream.close()
            row = [[place], [name], [first], [last], [nulls], [writer.docs], [writer.ids], [writer.size]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
            names = [part.split()[0] for part in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], names)
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
                 frame_ids: int = FRAME_IDS, index_docs: int = INDEX_DOCS, files: int | None = None) -> DataFrame:
    """Encode every text, end it with ``end_id``, write files in ascending order of ids, and return the manifest: one row per
    file in its ``place``, with first and last id, whether documents without an id are in it, and documents, ids and bytes.

    Documents are dealt by ranges of (id, hash of the text, row), sorted in each, and streamed into one file a range, so a
    task holds a text and a frame. Spark chooses the number of ranges, unless ``files`` does. Rows that repeat an id, however many, spread over ranges. Each attempt of a task writes a
    file with a name of its own; the manifest, stored in ``folder`` by Spark, names those of the attempts that count, and
    readers look at no other. Null texts are empty: their document is the end id alone. Documents without an id come last.
    Texts of any length are encoded whole. Other columns are not read. An empty table gives no files and an empty manifest.
    """
    os_store, root = open_store(folder)
    os_store.create_dir(root, recursive=True)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    key = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc(), F.col("_row").asc()]
    ranged = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*([files] if files else []), *key).sortWithinPartitions(*key)
    run = _written(folder, tokenizer, end_id, frame_ids, index_docs)
    place = posixpath.join(folder, "manifest")
    ranged.select("doc_id", "text").mapInArrow(run, MANIFEST).write.parquet(place)
    return docs.sparkSession.read.parquet(place)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(folder, "manifest"))


def _one_file_a_task(manifest: DataFrame) -> DataFrame:
    before = W.orderBy("place").rowsBetween(W.unboundedPreceding, -1)  # a row for each file
    files = manifest.withColumn("offset", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    return files.repartition(max(1, manifest.count()))


def _in_batches(rows: Iterator[tuple], names: list[str], kinds: list, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def read_digests(folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` of every document, from the files.

    A file to a task, a frame at a time; a frame that doesn't match its checksum ends the job with an error.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            store, root = open_store(folder)
            for batch in batches:
                for name, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    with store.open_input_file(posixpath.join(root, name)) as source:
                        file = TokenFile(source)
                        held, data = -1, b""
                        for doc, start, end in file.documents():
                            crc = 0
                            for i in range(start // file.frame_ids, -(-end // file.frame_ids)):
                                if i != held:
                                    held, data = i, file.frame(i)
                                first = i * file.frame_ids
                                crc = zlib.crc32(memoryview(data)[4 * max(0, start - first):4 * (end - first)], crc)
                            yield doc, offset + start, end - start, crc
        yield from _in_batches(rows(), ["doc_id", "start", "n_tokens", "ids_crc32"], [pa.int64()] * 4)

    return _one_file_a_task(manifest).select("file", "offset").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(folder: str, manifest: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``ids`` (array of long) and ``frames`` (decompressed for it) of the documents whose ids are in ``wanted``.

    Ids meet the files whose range holds them, and a task decompresses the index and data frames of those documents only.
    Ids without a document give no row; null ids are not looked for; a document comes once however often it is asked for.
    """
    spans = manifest.where("last_id IS NOT NULL").orderBy("place").select("file", "first_id", "last_id").collect()  # a row for each file
    files, firsts, lasts = [r["file"] for r in spans], [r["first_id"] for r in spans], [r["last_id"] for r in spans]
    asked = wanted.select(F.col(f"`{id_col}`").cast("long").alias("_id")).where("_id IS NOT NULL").distinct()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            low, high = np.searchsorted(lasts, ids, "left"), np.searchsorted(firsts, ids, "right")
            n = np.maximum(high - low, 0)
            at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array([files[i] for i in at.tolist()], pa.string()), pa.array(np.repeat(ids, n))], ["file", "_id"])

    by_file = asked.mapInArrow(place, "file string, _id long").repartition("file").sortWithinPartitions("file", "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            store, root = open_store(folder)
            for batch in batches:
                names, ids = np.array(batch.column(0).to_pylist(), object), np.array(batch.column(1).to_pylist(), np.int64)
                for name in dict.fromkeys(names.tolist()):
                    with store.open_input_file(posixpath.join(root, name)) as source:
                        file = TokenFile(source)
                        for doc, start, end in file.find(ids[names == name].tolist()):
                            before = file.unpacked
                            data = b"".join(file.parts(start, end))
                            yield doc, np.frombuffer(data, "<u4").astype(np.int64), file.unpacked - before
        yield from _in_batches(rows(), ["doc_id", "ids", "frames"], [pa.int64(), pa.list_(pa.int64()), pa.int32()], 64)

    return by_file.mapInArrow(run, "doc_id long, ids array<long>, frames int")


def token_digests(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files of ``docs`` to a fresh folder under the shared one and read every document's place and digest back."""
    folder = fresh_dir(docs.sparkSession, "token-files")
    return read_digests(folder, write_tokens(docs, folder, tokenizer, end_id, id_col, text_col))

"""Token-ID files: independent zstandard frames, a trailing seek table, checksums.

A file holds the ids of a range of documents in ascending order:

* data frames: each one zstandard frame of whole documents (about
  ``frame_ids`` ids, little-endian, 2 bytes where the vocabulary allows it,
  else 4);
* one index frame: bytes an id, number of documents, their ids (null marked),
  their numbers of token ids;
* the seek table in zstandard's seekable format: a skippable frame with the
  compressed size, the size and the checksum (low half of XXH64) of each frame
  before it, and a footer. Plain zstandard tools read the file as one stream.

A reader takes the tail, then the index frame, then only the frames that hold
the documents asked for, and checks each frame against its checksum.

The documents are range-partitioned by identifier (ties, such as one id on
many rows, by a hash of the text, so no range has to hold them all), and each
task streams one range into one file. A file is named by range and attempt and
moved into place when complete; only the names that finished tasks return (the
manifest) are files of the corpus, so lost or repeated tasks leave no trace in it.

Null texts count as empty; an empty text has the end id alone. Rows with a null
identifier come first. Equal identifiers are separate documents. An empty table
gives an empty manifest and no documents. Files are written through
``pyarrow.fs``, so the folder must be one that it can open (file, HDFS, S3, GCS).
Other columns are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cvlens.llm.common import scratch, written
from cvlens.llm.word_tokens import with_end, word_tokenizer

# Fixed values of zstandard's seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_IDS = 1 << 18
LEVEL = 1
MANIFEST = "range_id int, path string, n_docs long, n_ids long, n_bytes long"


def filesystem(path: str):
    """(pyarrow file system, path in it) of a path or URI."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


class FrameWriter:
    """Streams documents into one seekable file."""

    def __init__(self, sink, width: int, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        import zstandard
        self.sink, self.width, self.frame_ids = sink, width, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.entries, self.held, self.n_held = [], [], 0
        self.doc_ids, self.counts, self.n_bytes = [], [], 0

    def _frame(self, raw: bytes) -> None:
        import xxhash
        packed = self.zstd.compress(raw)
        self.sink.write(packed)
        self.entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.n_bytes += len(packed)

    def _flush(self) -> None:
        if self.held:
            self._frame(b"".join(self.held))
            self.held, self.n_held = [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.n_held and self.n_held + len(ids) > self.frame_ids:
            self._flush()
        self.held.append(ids.astype("<u2" if self.width == 2 else "<u4").tobytes())
        self.n_held += len(ids)
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))

    def close(self) -> None:
        self._flush()
        known = np.array([d is not None for d in self.doc_ids], "u1")
        ids = np.array([d or 0 for d in self.doc_ids], "<i8")
        self._frame(struct.pack("<BQ", self.width, len(self.counts)) + ids.tobytes() + known.tobytes()
                    + np.array(self.counts, "<i8").tobytes())
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        table += struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.n_bytes += 8 + len(table)


class FrameReader:
    """Random access to one seekable file (an open binary file with seek)."""

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        size = source.tell()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        table = self._at(size - 9 - 12 * n, 12 * n)
        e = np.frombuffer(table, "<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.raw_sizes, self.sums = e[:, 0], e[:, 1], e[:, 2]
        self.starts = np.cumsum(self.sizes) - self.sizes
        index = self.frame(n - 1)
        self.width, docs = struct.unpack_from("<BQ", index)
        ids = np.frombuffer(index, "<i8", docs, 9)
        known = np.frombuffer(index, "u1", docs, 9 + 8 * docs)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.counts = np.frombuffer(index, "<i8", docs, 9 + 9 * docs)
        self.ends = np.cumsum(self.counts)
        self.frame_ends = np.cumsum(self.raw_sizes[:-1]) // self.width

    def _at(self, start: int, n: int) -> bytes:
        self.source.seek(int(start))
        return self.source.read(int(n))

    def frame(self, k: int) -> bytes:
        import xxhash
        import zstandard
        raw = zstandard.ZstdDecompressor().decompress(self._at(self.starts[k], self.sizes[k]), int(self.raw_sizes[k]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} fails its checksum")
        return raw

    def documents(self, numbers=None):
        """(number, ids) of the documents asked for (default: all), frame by frame."""
        numbers = range(len(self.counts)) if numbers is None else numbers
        held, ids, first = -1, None, 0
        for i in numbers:
            start = int(self.ends[i] - self.counts[i])
            k = int(np.searchsorted(self.frame_ends, start, "right")) if self.counts[i] else held
            if self.counts[i] and k != held:
                ids = np.frombuffer(self.frame(k), "<u2" if self.width == 2 else "<u4")
                held, first = k, int(self.frame_ends[k - 1]) if k else 0
            yield i, (ids[start - first:start - first + int(self.counts[i])] if self.counts[i] else np.zeros(0, "<u4"))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, ranges: int | None = None,
                      frame_ids: int = FRAME_IDS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into ``folder``; the manifest."""
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        tok = word_tokenizer(tokenizer)
        width = 2 if tok.size <= 1 << 16 and end_id < 1 << 16 else 4
        fs, base = filesystem(folder)
        part = TaskContext.get().partitionId()
        writer = sink = None
        name = f"{base.rstrip('/')}/range-{part:06d}-{uuid.uuid4().hex}.zst"
        n_ids = 0
        for b in batches:
            if b.num_rows and writer is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(name + ".tmp")
                writer = FrameWriter(sink, width, frame_ids)
            step = 1024
            for lo in range(0, b.num_rows, step):
                ids, texts = (c.to_pylist() for c in b.slice(lo, step).columns)
                flat, counts = with_end(*tok.encode(texts), end_id)
                at = 0
                for d, n in zip(ids, counts.tolist()):
                    writer.add(d, flat[at:at + n])
                    at += n
                n_ids += at
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(name + ".tmp", name)
            yield pa.RecordBatch.from_pydict({"range_id": pa.array([part], pa.int32()), "path": [f"{folder.rstrip('/')}/{name.rpartition('/')[2]}"],
                                              "n_docs": [len(writer.counts)], "n_ids": [n_ids], "n_bytes": [writer.n_bytes]})

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .withColumn("_tie", F.xxhash64("text")).repartitionByRange(ranges, "doc_id", "_tie")
               .sortWithinPartitions("doc_id", "_tie").drop("_tie"))
    return written(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``manifest``."""
    before = Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))

    def read(batches):
        import pyarrow as pa
        for b in batches:
            for path, start in zip(*(c.to_pylist() for c in b.columns)):
                fs, name = filesystem(path)
                with fs.open_input_file(name) as f:
                    r = FrameReader(f)
                    sums = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in r.documents()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r.doc_ids, pa.int64()), pa.array(start + r.ends - r.counts), pa.array(r.counts),
                         pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digests(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """The registered query: write the files, read them back."""
    folder = scratch(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id))

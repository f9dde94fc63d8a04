"""Byte-level BPE over a corpus by a global shuffle of distinct words.

1. Texts are split into pre-tokens by the tokenizer's pattern. The documents of
   a task form blocks (of about ``block_bytes`` of text); a block numbers its
   distinct words, and a document becomes the numbers of its words in order,
   which are its positions exploded and keyed by word.
2. The words of all blocks are shuffled by word, so equal words meet and each
   distinct word is encoded once, whatever the number of blocks it is in.
3. The ids go back to the blocks: each word's ids are joined to its number
   there, and the documents are put together again by position.

Decoding joins ids to the token-byte table (as large as the vocabulary).

A word is in the shuffle once a block, so a frequent word brings a row a block
and not a row an occurrence. The text itself is never shuffled; it is read
twice (for words and for positions) instead of being kept.

Null texts count as empty; an empty text has no ids and decodes to nothing.
Repeated rows and equal (or null) identifiers are separate documents. An empty
table gives an empty result. Special tokens in a text are ordinary text. A very
long text is one document of a block, which then is as long as the text (its
words are numbered like any others). Other columns are not read.

The two readings of the input are tied by partition: they are scans of one job,
planned together, and a retried task reads what the lost one read.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvlens.llm.common import text_or_empty

BLOCK_BYTES = 48 << 20
# Documents in a row of word numbers.
ROW_DOCS = 512
# Pieces whose words a block remembers; beyond it starts to learn anew.
MAX_PIECES = 150_000

_DOCS = "block long, row int, doc_ids array<long>, sizes array<int>, numbers binary"
_WORDS = "word string, block long, number int"
_IDS = "block long, numbers binary, sizes binary, ids binary"


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def token_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, all bytes) of the tokens, by id."""
    ranks = load_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        tokens[i] = t
    sizes = np.array([len(t) for t in tokens], np.int64)
    return np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(tokens), np.uint8)


def gather(starts: np.ndarray, sizes: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[i]:starts[i] + sizes[i]]`` for i in ``at``, end to end."""
    n = sizes[at]
    ends = np.cumsum(n)
    return values[np.repeat(starts[at] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]


def squeeze(x: np.ndarray) -> bytes:
    """A 4-byte integer array, byte by byte plane, as one zstandard frame."""
    import zstandard
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1, write_content_size=True).compress(planes.tobytes())


def unsqueeze(packed: bytes) -> np.ndarray:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(packed)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


class Block:
    """Numbers the distinct words of successive texts.

    A piece between single blanks, without white space at its ends, splits into
    words alike in every text, so it is split once; texts with other white
    space at a blank are split whole.
    """

    def __init__(self, pattern: str):
        import regex
        self.find = regex.compile(pattern).findall
        self.words: dict[str, int] = {}
        self.n_bytes = 0
        self._forget()

    def _forget(self) -> None:
        self.pieces: dict[str, int] = {}
        self.starts, self.sizes, self.flat = array("q"), array("q"), array("i")
        self.odd = bytearray()

    def _number(self, words: list[str]) -> list[int]:
        own = self.words
        return [own.setdefault(w, len(own)) for w in words]

    def _learn(self, piece: str) -> None:
        odd = not piece or piece[0].isspace() or piece[-1].isspace()
        if odd:
            words = []
        elif piece.isalpha():
            words = [" " + piece]
        elif piece[-1] in ".,;:!?" and piece[:-1].isalpha():
            words = [" " + piece[:-1], piece[-1]]
        else:
            words = self.find(" " + piece)
        self.odd.append(odd)
        self.starts.append(len(self.flat))
        self.sizes.append(len(words))
        self.flat.extend(self._number(words))

    def add(self, text: str) -> np.ndarray:
        """The numbers of the text's words, in order."""
        if not text:
            return np.zeros(0, np.int32)
        self.n_bytes += len(text)
        if len(self.pieces) > MAX_PIECES:
            self._forget()
        first, *rest = text.split(" ")
        known = self.pieces
        for p in rest:
            if p not in known:
                known[p] = len(known)
                self._learn(p)
        at = np.fromiter(map(known.__getitem__, rest), np.int64, len(rest))
        if not first or first[-1].isspace() or (len(at) and np.frombuffer(self.odd, np.uint8)[at].any()):
            return np.array(self._number(self.find(text)), np.int32)
        head = np.array(self._number(self.find(first)), np.int32)
        if not len(at):
            return head
        return np.concatenate([head, gather(np.frombuffer(self.starts, np.int64), np.frombuffer(self.sizes, np.int64),
                                            np.frombuffer(self.flat, np.int32), at)])


def _blocks(pattern: str, block_bytes: int, want_words: bool):
    """A task's documents as rows of word numbers, or its blocks' words; both number alike."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 32
        block, n_blocks = Block(pattern), 0

        def words():
            own = list(block.words)
            for lo in range(0, len(own), 1 << 16):
                part = own[lo:lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.string()), pa.array(np.full(len(part), first + n_blocks)),
                     pa.array(np.arange(lo, lo + len(part), dtype=np.int32))], ["word", "block", "number"])

        row = 0
        for b in batches:
            for lo in range(0, b.num_rows, ROW_DOCS):
                ids, texts = (c.to_pylist() for c in b.slice(lo, ROW_DOCS).columns)
                numbers = [block.add(t) for t in texts]
                if not want_words:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([first + n_blocks]), pa.array([row], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                         pa.array([[len(x) for x in numbers]], pa.list_(pa.int32())),
                         pa.array([squeeze(np.concatenate(numbers))], pa.binary())],
                        ["block", "row", "doc_ids", "sizes", "numbers"])
                row += 1
                if block.n_bytes >= block_bytes:
                    if want_words:
                        yield from words()
                    block, n_blocks = Block(pattern), n_blocks + 1
        if want_words:
            yield from words()
    return run


def _encode_words(path: str, pattern: str, flush: int = 1 << 18):
    """Words sorted within the task: encode each distinct one, pack the ids by block."""
    def run(batches):
        import pyarrow as pa
        encode = encoder(path, pattern).encode_ordinary
        held: dict[int, tuple[array, array, array]] = {}
        n, last, ids = 0, None, []

        def packed():
            rows = []  # each block's words in the order of their numbers, which are written as steps
            for block, own in held.items():
                number, size, flat = (np.frombuffer(x, d) for x, d in zip(own, (np.int32, np.int32, np.uint32)))
                order, size = np.argsort(number), size.astype(np.int64)
                rows.append((block, squeeze(np.diff(number[order], prepend=0)), squeeze(size[order]),
                             squeeze(gather(np.cumsum(size) - size, size, flat, order))))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                               *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3))],
                                              ["block", "numbers", "sizes", "ids"])

        for b in batches:
            for word, block, number in zip(*(c.to_pylist() for c in b.columns)):
                if word != last:
                    last, ids = word, encode(word)
                own = held.get(block)
                if own is None:
                    own = held[block] = (array("i"), array("i"), array("I"))
                own[0].append(number)
                own[1].append(len(ids))
                own[2].extend(ids)
                n += 1
            if n >= flush:
                yield packed()
                held, n = {}, 0
        if held:
            yield packed()
    return run


def decode_ids(ranks: str, parts: list[bytes]) -> list[bytes]:
    """The bytes of each list of ids, by a join with the token-byte table."""
    starts, sizes, raw = token_table(ranks)
    at = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
    if len(at) and (at.max() >= len(sizes) or not sizes[at].all()):
        raise ValueError("an id is not in the token table")
    body = gather(starts, sizes, raw, at).tobytes()
    n = np.cumsum([0, *(len(p) // 4 for p in parts)])
    upto = np.concatenate([[0], np.cumsum(sizes[at])])[n].tolist()
    return [body[a:z] for a, z in zip(upto, upto[1:])]


def _assemble(docs, words, ranks: str, decode: bool):
    """One block: its documents' word numbers and its words' ids -> its documents' ids."""
    import pyarrow as pa
    parts = lambda name: [unsqueeze(x) for x in words.column(name).to_pylist()] or [np.zeros(0, np.uint32)]
    numbers = np.concatenate([np.cumsum(x, dtype=np.int64) for x in parts("numbers")])
    sizes, ids = np.concatenate(parts("sizes")).astype(np.int64), np.concatenate(parts("ids"))
    starts, lens = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    starts[numbers], lens[numbers] = np.cumsum(sizes) - sizes, sizes
    batches = []
    for own, n, packed in zip(docs.column("doc_ids").to_pylist(), docs.column("sizes").to_pylist(), docs.column("numbers").to_pylist()):
        at = unsqueeze(packed).astype(np.int64)
        flat = gather(starts, lens, ids, at).astype("<u4").tobytes()
        upto = np.concatenate([[0], np.cumsum(lens[at])])[np.concatenate([[0], np.cumsum(n)])].tolist()
        out = [flat[4 * a:4 * z] for a, z in zip(upto, upto[1:])]
        columns = [pa.array(own, pa.int64()), pa.array(out, pa.binary())]
        if decode:
            columns.append(pa.array(decode_ids(ranks, out), pa.binary()))
        batches.append(pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][:len(columns)]))
    return pa.Table.from_batches(batches)


def encode_documents(docs: DataFrame, ranks: str, pattern: str, block_bytes: int = BLOCK_BYTES, decode: bool = False) -> DataFrame:
    """(doc_id, ids): the ids as little-endian unsigned 32-bit integers.

    ``decode`` adds ``decoded``, the bytes that the ids stand for, in the same
    worker; ``decode_documents`` does so for stored ids.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("string").alias("text"))
    numbered = text.mapInArrow(_blocks(pattern, block_bytes, False), _DOCS)
    words = text.mapInArrow(_blocks(pattern, block_bytes, True), _WORDS)
    ids = words.repartition("word").sortWithinPartitions("word").mapInArrow(_encode_words(ranks, pattern), _IDS)
    return (numbered.groupBy("block").cogroup(ids.groupBy("block"))
            .applyInArrow(lambda d, w: _assemble(d, w, ranks, decode), "doc_id long, ids binary" + ", decoded binary" * decode))


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded bytes."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(decode_ids(ranks, b.column(1).to_pylist()), pa.binary())],
                                             ["doc_id", "ids", "decoded"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def round_trip_digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """The registered query: encode, decode the ids, digest both."""
    both = encode_documents(docs, ranks, pattern, decode=True)
    return both.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

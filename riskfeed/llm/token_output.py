"""Operator 6: token ids in bit-packed binary shards.

Documents are range-partitioned and sorted by doc_id; each task encodes its documents
and writes shards of at most about ``SHARD_IDS`` ids through Arrow's file systems
(local, S3, GCS, HDFS by URI). An id takes the fewest bits that hold the vocabulary; ids
are packed in blocks of ``BLOCK_IDS`` whose byte offsets are in the shard, so any range
of ids is read by seeking to its blocks and unpacked with numpy.

Shard layout (little endian): header ``<4sHHIQQQ`` = magic, version, bits, ids a block,
documents, ids, blocks; doc_id int64[documents]; null flag uint8[documents];
first id of each document uint64[documents + 1]; byte offset of each block in the payload
uint64[blocks + 1]; payload (bit i of the packed stream is bit ``i % 8`` of byte ``i // 8``).

A task that is run again writes the same shard under a temporary name and renames it, so
a lost executor leaves no half shard; a shard counts only once its manifest row is written.

Defined results: a null or empty text has the end id only; null ids come first; rows that
share an id are all kept, in the order of their texts; an empty table gives an empty
manifest and no documents. Extra input columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfeed.llm.common import shared_path, stage, text_or_empty

MAGIC, VERSION, HEADER = b"TIDS", 1, struct.Struct("<4sHHIQQQ")
BLOCK_IDS = 4096
SHARD_IDS = 4_000_000
CACHE_WORDS = 400_000
END_ID = 1


# ------------------------------------------------------------------ bit packing

def bits_for(vocab_size: int) -> int:
    return max(1, (vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids packed at ``bits`` each, least significant bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, dtype=f"<u{bits // 8}", count=n).astype(np.uint32)
    buf = np.concatenate((np.frombuffer(raw, dtype=np.uint8), np.zeros(8, dtype=np.uint8)))
    first = np.arange(n, dtype=np.int64) * bits
    word = np.zeros(n, dtype=np.uint64)
    for k in range((bits + 14) // 8):
        word |= buf[first // 8 + k].astype(np.uint64) << np.uint64(8 * k)
    return ((word >> (first % 8).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


# ------------------------------------------------------------------ shard files

def _fs(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def write_shard(uri: str, doc_ids: list, counts: list[int], ids: np.ndarray, bits: int) -> None:
    n_blocks = -(-len(ids) // BLOCK_IDS)
    blocks = [pack(ids[i * BLOCK_IDS:(i + 1) * BLOCK_IDS], bits) for i in range(n_blocks)]
    start = np.zeros(len(counts) + 1, dtype="<u8")
    start[1:] = np.cumsum(counts)
    offset = np.zeros(n_blocks + 1, dtype="<u8")
    offset[1:] = np.cumsum([len(b) for b in blocks])
    null = np.array([d is None for d in doc_ids], dtype=np.uint8)
    key = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    fs, path = _fs(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temp) as out:
        out.write(HEADER.pack(MAGIC, VERSION, bits, BLOCK_IDS, len(counts), len(ids), n_blocks))
        for part in (key, null, start, offset):
            out.write(part.tobytes())
        for b in blocks:
            out.write(b)
    fs.move(temp, path)


class Shard:
    """Random access to one shard file."""

    def __init__(self, uri: str):
        fs, path = _fs(uri)
        self.file = fs.open_input_file(path)
        magic, version, self.bits, self.block, n_docs, self.n_ids, n_blocks = \
            HEADER.unpack(self.file.read(HEADER.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"not a token shard: {uri}")
        key = np.frombuffer(self.file.read(8 * n_docs), dtype="<i8")
        null = np.frombuffer(self.file.read(n_docs), dtype=np.uint8)
        self.doc_ids = [None if z else int(k) for k, z in zip(key, null)]
        self.start = np.frombuffer(self.file.read(8 * (n_docs + 1)), dtype="<u8").astype(np.int64)
        self.offset = np.frombuffer(self.file.read(8 * (n_blocks + 1)), dtype="<u8").astype(np.int64)
        self.payload = self.file.tell()

    def ids(self, first: int, stop: int) -> np.ndarray:
        """Ids ``first`` to ``stop`` of the shard; reads the blocks that hold them."""
        if stop <= first:
            return np.zeros(0, dtype=np.uint32)
        a, b = first // self.block, -(-stop // self.block)
        self.file.seek(self.payload + int(self.offset[a]))
        raw = self.file.read(int(self.offset[b] - self.offset[a]))
        n = min(b * self.block, self.n_ids) - a * self.block
        # a full block of 4096 ids ends on a byte for any width, so the blocks unpack as one run
        return unpack(raw, n, self.bits)[first - a * self.block:stop - a * self.block]

    def close(self) -> None:
        self.file.close()


# ------------------------------------------------------------------ encoding

# plain words: printable ASCII and Latin-1 letters, which NFC leaves as they are
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
# fixed values: the split pattern of tokenizers for which words are independent of each other
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others take code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Cache(dict):
    """Values of ``make``, each made once while held; ``CACHE_WORDS`` at most."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHE_WORDS:
            self.clear()
        got = self[key] = self.make(key)
        return got


class Encoder:
    """Ids of a text with the tokenizers library. Where the tokenizer lower-cases, drops white
    space and splits it from everything else, a text's ids are those of its words in
    order, so each distinct word is encoded once per worker (``CACHE_WORDS`` at most are
    held). Other tokenizers encode whole texts."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        conf = json.loads(self.tok.to_str())
        norm = [x.get("type") for x in (conf.get("normalizer") or {}).get("normalizers", [])]
        split = [x.get("pattern", {}).get("Regex") for x in (conf.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.by_word = norm == ["NFC", "Replace", "Lowercase"] and split[:1] == [_WORD_SPLIT]
        self.symbols = dict(enumerate(byte_symbols()))
        added = [re.escape(x["content"]) for x in conf.get("added_tokens", [])]
        self.added = re.compile("|".join(added)) if added else None
        self.words, self.pieces = Cache(self._word), Cache(self._piece)

    def _library(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.tok.model.tokenize(piece.encode().decode("latin-1").translate(self.symbols))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters only: one piece
            text = word.decode()
            if self.added is None or not self.added.search(text):
                return self.pieces[text.lower()]
        text = word.decode("utf-8", "replace")
        if not _PLAIN.fullmatch(text) or self.added is not None and self.added.search(text):
            return self._library(text)
        return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))

    def encode(self, raw: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return self._library(raw.decode("utf-8", "replace"))
        return b"".join(map(self.words.__getitem__, raw.split()))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ------------------------------------------------------------------ Spark jobs

MANIFEST = "part int, shard int, uri string, n_docs long, n_ids long"


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Write the shards; returns the manifest: part, shard, uri, n_docs, n_ids, first_id
    (ids in all shards before it), written to the shared folder."""
    spark = docs.sparkSession
    root = folder or shared_path(spark, "op6-shards")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    d = d.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    d = d.select("doc_id", F.col("text").cast("binary").alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        bits = bits_for(max(enc.tok.get_vocab_size(with_added_tokens=True), end_id + 1))
        end = np.array([end_id], dtype="<u4").tobytes()
        part, shard = TaskContext.get().partitionId(), 0
        ids, counts, parts, size, rows = [], [], [], 0, []

        def flush():
            nonlocal ids, counts, parts, size, shard
            uri = f"{root}/part-{part:06d}-{shard:05d}.bin"
            write_shard(uri, ids, counts, np.frombuffer(b"".join(parts), dtype="<u4"), bits)
            rows.append({"part": part, "shard": shard, "uri": uri, "n_docs": len(ids), "n_ids": size})
            ids, counts, parts, size, shard = [], [], [], 0, shard + 1

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                raw = enc.encode(text.as_py()) + end
                ids.append(doc_id.as_py())
                counts.append(len(raw) // 4)
                parts.append(raw)
                size += counts[-1]
                if size >= SHARD_IDS:
                    flush()
        if ids:
            flush()
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("part", pa.int32()), ("shard", pa.int32()), ("uri", pa.string()), ("n_docs", pa.int64()),
             ("n_ids", pa.int64())]))

    manifest = stage(d.mapInArrow(write, MANIFEST), "op6-written")
    # running totals: of parts (one row each), then of the shards in a part
    part = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_first"))
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("in_part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return shards.join(part, "part").select("part", "shard", "uri", "n_docs", "n_ids",
                                            (F.col("part_first") + F.col("in_part")).alias("first_id"))


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the shard files: doc_id, start, n_tokens, ids_crc32."""
    spark = manifest.sparkSession

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = Shard(row["uri"])
                ids = s.ids(0, s.n_ids)
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(s.start, s.start[1:])]
                s.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.doc_ids, pa.int64()), pa.array(s.start[:-1] + row["first_id"], pa.int64()),
                     pa.array(np.diff(s.start), pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("uri", "first_id").repartition(n, "uri").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    return read_documents(write_tokens(docs, tokenizer_path, **options))

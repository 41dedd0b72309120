"""Token ids as length-delimited binary records with masked checksums, and an offset index beside them.

A record is framed as: length of the data (8 bytes), masked CRC-32C of those 8 bytes (4), the data, masked
CRC-32C of the data (4); all numbers are little-endian. The data of a sequence are a flag byte (1 if it has
a document id), the document id (8 bytes), the bytes per id (1), and the ids. The index is a Parquet table
with one row per record, so that a reader can take records in any order or share them out.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import SLICE_CHARS, release, text_slices
from shelfcast.llm.tokens import encoder

#: Fixed values of the record format: the CRC-32C polynomial (reflected) and the checksum mask.
CRC32C_POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

_HEADER = struct.Struct("<BqB")
_INDEX = "file_no int, file string, position long, size long, doc_id long, first_token long, n_tokens long"
_BLOCK = 256


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Checksum of a byte followed by 0 to 7 zero bytes, and of a register followed by ``_BLOCK`` zero bytes."""
    own = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        own = np.where(own & 1, (own >> 1) ^ np.uint32(CRC32C_POLYNOMIAL), own >> 1).astype(np.uint32)
    steps = [own]
    for _ in range(7):
        steps.append(own[steps[-1] & 0xFF] ^ (steps[-1] >> 8))
    shift = (np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]).astype(np.uint32)
    for _ in range(_BLOCK):
        shift = own[shift & 0xFF] ^ (shift >> 8)
    return np.array(steps), shift


def crc32c(records: list[bytes]) -> np.ndarray:
    """CRC-32C of each record: equal blocks of all records go through the tables side by side.

    A record is padded with zeros in front to whole blocks, which leaves a checksum that starts at zero
    unchanged; the usual start and end inversions are put in as a term of the record's length.
    """
    steps, shift = _tables()
    if not records:
        return np.zeros(0, dtype=np.uint32)
    lengths = np.array([len(r) for r in records], dtype=np.int64)
    # Inverting the start register equals inverting the first four bytes; shorter records are padded by the rule below.
    blocks = -(-(np.maximum(lengths, 4)) // _BLOCK)
    data = np.zeros(int(blocks.sum()) * _BLOCK, dtype=np.uint8)
    begins = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    for r, end in zip(records, (begins + blocks) * _BLOCK):
        if r:
            data[end - len(r) : end] = np.frombuffer(r, dtype=np.uint8)
    long = lengths >= 4
    first = ((begins + blocks) * _BLOCK - lengths)[long]
    for k in range(4):
        data[first + k] ^= 0xFF
    words = data.reshape(-1, _BLOCK // 8, 8)
    register = np.zeros(len(words), dtype=np.uint32)
    for i in range(_BLOCK // 8):
        w = words[:, i]
        low = register ^ (w[:, 0] | w[:, 1].astype(np.uint32) << 8 | w[:, 2].astype(np.uint32) << 16 | w[:, 3].astype(np.uint32) << 24)
        register = steps[7][low & 0xFF] ^ steps[6][low >> 8 & 0xFF] ^ steps[5][low >> 16 & 0xFF] ^ steps[4][low >> 24]
        for k in range(4, 8):
            register ^= steps[7 - k][w[:, k]]
    out = np.zeros(len(records), dtype=np.uint32)
    for k in range(int(blocks.max())):
        own = np.flatnonzero(blocks > k)
        r = out[own]
        moved = shift[0][r & 0xFF] ^ shift[1][r >> 8 & 0xFF] ^ shift[2][r >> 16 & 0xFF] ^ shift[3][r >> 24]
        out[own] = moved ^ register[begins[own] + k]
    for i in np.flatnonzero(~long):
        value = 0xFFFFFFFF
        for byte in records[i]:
            value = int(steps[0][(value ^ byte) & 0xFF]) ^ value >> 8
        out[i] = value
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


def framed(records: list[bytes]) -> list[bytes]:
    sizes = [struct.pack("<Q", len(r)) for r in records]
    of_sizes, of_data = masked(crc32c(sizes)).astype("<u4"), masked(crc32c(records)).astype("<u4")
    return [s + a.tobytes() + r + b.tobytes() for s, a, r, b in zip(sizes, of_sizes, records, of_data)]


def unframed(frames: list[bytes]) -> list[bytes]:
    """The data of whole frames; a wrong length or checksum is an error."""
    sizes, records = [f[:8] for f in frames], [f[12:-4] for f in frames]
    found = np.array([(struct.unpack("<I", f[8:12])[0], struct.unpack("<I", f[-4:])[0]) for f in frames], dtype=np.uint32)
    if (
        any(struct.unpack("<Q", s)[0] != len(r) for s, r in zip(sizes, records))
        or (masked(crc32c(sizes)) != found[:, 0]).any()
        or (masked(crc32c(records)) != found[:, 1]).any()
    ):
        raise ValueError("a record does not match its checksum")
    return records


def serialized(doc_id: int | None, ids: bytes, width: int) -> bytes:
    if width == 2:
        ids = np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes()
    return _HEADER.pack(doc_id is not None, doc_id or 0, width) + ids


def deserialized(record: bytes) -> tuple[int | None, bytes]:
    has_id, doc_id, width = _HEADER.unpack_from(record)
    ids = np.frombuffer(record, dtype=f"<u{width}", offset=_HEADER.size).astype("<u4").tobytes()
    return (doc_id if has_id else None), ids


def write_records(docs: DataFrame, directory: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode whole texts and write them in ascending doc_id order: ``data-*.rec`` files and the table ``index``.

    Rows are dealt to files by ranges of doc_id and sorted inside them. A null text is the end id alone.
    Rows of a null doc_id come first, repeated ids stay together in order of their text; nothing is dropped. An empty
    table gives an index without rows. A task that is run again writes files of new names, and the index
    names only those of the attempt that was kept.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out = encoder(tokenizer), None
        width = 2 if own.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 and end_id < 1 << 16 else 4
        end, number = np.array([end_id], dtype="<u4").tobytes(), TaskContext.get().partitionId()
        filesystem, root = pafs.FileSystem.from_uri(directory)
        name, position, token = f"data-{number:06d}-{uuid.uuid4().hex[:12]}.rec", 0, 0
        try:
            for batch, texts in text_slices(batches):
                doc_ids = batch.column("doc_id").to_pylist()
                encoded = [ids + end for ids in own.encode(texts)]
                frames = framed([serialized(i, ids, width) for i, ids in zip(doc_ids, encoded)])
                out = out or filesystem.open_output_stream(f"{root}/{name}")
                out.write(b"".join(frames))
                sizes, tokens = np.array([len(f) for f in frames]), np.array([len(x) // 4 for x in encoded])
                n = len(frames)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * n, pa.int32()), pa.array([name] * n),
                        pa.array(position + np.cumsum(sizes) - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(token + np.cumsum(tokens) - tokens, pa.int64()), pa.array(tokens, pa.int64()),
                    ],
                    names=[c.split()[0] for c in _INDEX.split(", ")],
                )
                position, token = position + int(sizes.sum()), token + int(tokens.sum())
        finally:
            if out:
                out.close()
            release()

    spark = docs.sparkSession
    _make_folder(spark, directory)
    (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(write, _INDEX).write.parquet(f"{directory}/index")
    )


def _make_folder(spark: SparkSession, directory: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def read_records(spark: SparkSession, directory: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) read back through the index; ``start`` counts all ids before a document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pafs.FileSystem.from_uri(directory)
        opened, source = None, None
        for batch in batches:
            rows, size = [], 0
            for r in batch.to_pylist():
                if r["file"] != opened:
                    source, opened = filesystem.open_input_file(f"{root}/{r['file']}"), r["file"]
                rows.append((r, source.read_at(r["size"], r["position"])))
                size += r["size"]
                if size >= 2 * SLICE_CHARS:
                    yield decoded(rows)
                    rows, size = [], 0
            if rows:
                yield decoded(rows)

    def decoded(rows: list[tuple[dict, bytes]]) -> pa.RecordBatch:
        found = [deserialized(x) for x in unframed([frame for _, frame in rows])]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in found], pa.int64()), pa.array([r["start"] for r, _ in rows], pa.int64()),
                pa.array([len(ids) // 4 for _, ids in found], pa.int64()), pa.array([ids for _, ids in found], pa.binary()),
            ],
            names=["doc_id", "start", "n_tokens", "ids"],
        )

    index = spark.read.schema(_INDEX).parquet(f"{directory}/index")
    files = index.groupBy("file_no").agg(F.sum("n_tokens").alias("in_file"))
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    bases = files.select("file_no", F.coalesce(F.sum("in_file").over(earlier), F.lit(0)).alias("base"))
    rows = index.join(bases, "file_no").select(
        "file", "position", "size", (F.col("base") + F.col("first_token")).alias("start")
    )
    return rows.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")

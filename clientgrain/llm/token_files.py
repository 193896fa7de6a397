"""Token ids in length-delimited binary records, with an offset index.

A file is a run of frames: length (8 bytes), masked checksum of the length (4),
payload, masked checksum of the payload (4), all little-endian.  The checksum is
CRC-32; it is masked by a rotation and a constant, so that a checksum stored in
a payload does not checksum to itself.  The first frame holds a JSON header, each
further frame the ids of one sequence, in 2 or 4 bytes each.

Every task writes one file under a name of its own; the index, written by Spark
in the same job, names the files of the attempts that counted.  A lost executor
costs the files it was writing, no more.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .texts import small_batches
from .tokens import encoder

MASK_DELTA = 0xA282EAD8
FRAME_BYTES = 16
# A read joins neighbouring records up to this many bytes.
READ_BYTES = 8 * 1024 * 1024

INDEX = "doc_id long, file string, part int, number long, offset long, length long, first_token long, n_tokens long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(data: memoryview) -> tuple[memoryview, int]:
    """The payload of the frame at the start of ``data`` and the bytes it took; raises if a checksum is wrong."""
    if len(data) < FRAME_BYTES:
        raise ValueError("a record is cut short")
    length, check = struct.unpack_from("<QI", data)
    if masked(bytes(data[:8])) != check or len(data) < FRAME_BYTES + length:
        raise ValueError("the length of a record is damaged")
    payload = data[12:12 + length]
    if masked(payload) != struct.unpack_from("<I", data, 12 + length)[0]:
        raise ValueError("a record is damaged")
    return payload, FRAME_BYTES + length


def store(folder: str):
    """The file system of a folder and its path there; plain paths and file: are the shared local one."""
    from pyarrow import fs
    parts = urlparse(folder)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(folder)


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_bytes: int = 2,
                  id_col: str = "doc_id", text: str = "text", files: int | None = None) -> DataFrame:
    """Writes the ids of every whole text, ascending by id, and returns the stored index.

    ``files`` is the number of range partitions, each a file (default: the
    session's shuffle partitions).  A null text counts as empty and a null id
    sorts first; rows with the same id follow each other by text.  An id that does
    not fit ``id_bytes`` fails the job.  ``folder``
    must be one that all executors share.
    """
    spark = docs.sparkSession
    small_batches(spark)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    header = frame(json.dumps({"version": 1, "id_bytes": id_bytes, "checksum": "masked crc32"}).encode())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = end_id.to_bytes(4, "little")
        part = TaskContext.get().partitionId()
        system, path = store(folder)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.records"
        out, at, number, tokens = None, 0, 0, 0
        for batch in batches:
            if out is None:
                system.create_dir(f"{path}/data")
                out = system.open_output_stream(f"{path}/data/{name}")
                out.write(header)
                at = len(header)
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                wide = np.frombuffer(ids + end, dtype="<u4")
                if int(wide.max()) >= 1 << 8 * id_bytes:
                    raise ValueError(f"token id {int(wide.max())} does not fit {id_bytes} bytes")
                framed = frame(wide.astype(f"<u{id_bytes}").tobytes())
                out.write(framed)
                rows.append((doc_id, name, part, number, at, len(framed), tokens, len(wide)))
                at, number, tokens = at + len(framed), number + 1, tokens + len(wide)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows), [pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 5])],
                names=["doc_id", "file", "part", "number", "offset", "length", "first_token", "n_tokens"])
        if out is not None:
            out.close()

    (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("body"))
     .repartitionByRange(files, F.col("id").asc_nulls_first())
     .sortWithinPartitions(F.col("id").asc_nulls_first(), F.col("body").asc_nulls_first())
     .mapInArrow(write, INDEX).write.parquet(f"{folder}/index"))
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The index rows (any subset, in any order) with ``ids_crc32`` and ``n_tokens`` from the files.

    Neighbouring records of a file are read together; every checksum is tested.
    ``ids_crc32`` is taken over the ids as unsigned 32-bit integers.
    """
    small_batches(index.sparkSession, 2_000)
    names = ["doc_id", "part", "first_token", "file", "offset", "length"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = store(folder)
        widths: dict[str, int] = {}

        def width(source, name: str) -> int:
            if name not in widths:
                widths[name] = json.loads(bytes(unframe(memoryview(source.read_at(4096, 0)))[0]))["id_bytes"]
            return widths[name]

        for batch in batches:
            file, offset, length = (batch.column(i).to_pylist() for i in (3, 4, 5))
            n_tokens, crcs = [], []
            first = 0
            while first < len(file):
                last = first + 1
                while (last < len(file) and file[last] == file[first] and offset[last] == offset[last - 1] + length[last - 1]
                       and offset[last] + length[last] - offset[first] <= READ_BYTES):
                    last += 1
                with system.open_input_file(f"{path}/data/{file[first]}") as source:
                    size = width(source, file[first])
                    data = memoryview(source.read_at(offset[last - 1] + length[last - 1] - offset[first], offset[first]))
                at = 0
                for _ in range(first, last):
                    payload, taken = unframe(data[at:])
                    ids = np.frombuffer(payload, dtype=f"<u{size}").astype("<u4")
                    n_tokens.append(len(ids))
                    crcs.append(zlib.crc32(ids))
                    at += taken
                first = last
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], pa.array(n_tokens, type=pa.int64()), pa.array(crcs, type=pa.int64())],
                names=["doc_id", "part", "first_token", "n_tokens", "ids_crc32"])

    return index.select(*names).mapInArrow(read, "doc_id long, part int, first_token long, n_tokens long, ids_crc32 long")


def part_starts(index: DataFrame) -> DataFrame:
    """(at, before): the ids in all files before each; one row for each file."""
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    return totals.select(F.col("part").alias("at"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))


def encoded_documents(index: DataFrame, folder: str) -> DataFrame:
    """One row for each record: doc_id, start, n_tokens, ids_crc32, read back from the files."""
    read = read_records(index, folder)
    return (read.join(F.broadcast(part_starts(index)), F.col("part") == F.col("at"))
            .select("doc_id", (F.col("before") + F.col("first_token")).alias("start"), "n_tokens", "ids_crc32"))

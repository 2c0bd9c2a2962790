"""Token ids in files of length-delimited binary records, with a separate offset index.

A record is: payload length (unsigned 64 bits), masked checksum of these 8 bytes
(32 bits), the payload (token ids, unsigned 16 bits each), masked checksum of the
payload (32 bits); all little-endian. The checksum is CRC-32, rotated right by 15
bits and raised by a constant, so that a checksum stored inside a payload does not
disturb the one around it.

Each task writes one file under a name that only its attempt uses, and returns the
index rows; the index table holds what committed attempts returned, so files of
lost or repeated attempts are never read. The files go through ``pyarrow.fs``, so
the folder may be on any file system it opens by URI.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from itertools import groupby

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import arrow, batch, slices
from .chunk_cache import ByteLevelIds, shared
from .common import by_range, plain

_MASK_DELTA = 0xA282EAD8  # fixed value: what the masking adds
#: Bytes of text that a writer encodes at a time: a larger share of words is known already in larger slices.
SLICE = 2_000_000
#: Bytes that a reader takes at a time when records adjoin.
READ_BYTES = 8 << 20

_INDEX = "doc_id {id}, part int, file string, offset long, bytes long, local_start long, n_tokens long"
_RECORDS = "doc_id {id}, start long, n_tokens long, ids binary"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + _MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes, at: int = 0) -> bytes:
    """The payload of the record at an offset; raises ValueError where a checksum does not hold."""
    head = data[at : at + 8]
    n = struct.unpack("<Q", head)[0]
    payload = data[at + 12 : at + 12 + n]
    if struct.unpack_from("<I", data, at + 8)[0] != masked(head) or len(payload) != n or struct.unpack_from("<I", data, at + 12 + n)[0] != masked(payload):
        raise ValueError(f"damaged record at {at}")
    return payload


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_token_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the ids of every text, ``end_id`` after each, in ascending order of the identifier; returns the index.

    The index is a Parquet table in ``folder``/index: doc_id, part, file, offset and bytes of
    the record, local_start (ids before it in its file), n_tokens. A null text counts as empty
    and gives a record of ``end_id`` alone. Null identifiers come first; rows with the same
    identifier are in order of their texts, each with its own record. Texts of any length are
    encoded whole. An empty table gives no file and an empty index. Other columns are ignored.
    """
    schema, kind = arrow(_INDEX, docs.schema[doc_id].dataType)
    spark = docs.sparkSession

    def write(batches):
        part = TaskContext.get().partitionId()
        encoder, end = shared(ByteLevelIds, tokenizer), np.array([end_id], "<u2").tobytes()
        fs, base = file_system(folder)
        name = f"data/part-{part:05d}-{uuid.uuid4().hex}.records"
        out, offset, start = None, 0, 0
        for ids, texts in slices(batches, size=SLICE):
            if out is None:
                fs.create_dir(f"{base}/data", recursive=True)
                out = fs.open_output_stream(f"{base}/{name}", buffer_size=1 << 20)
            rows = {n: [] for n in ("offset", "bytes", "local_start", "n_tokens")}
            for payload in encoder.encode(texts):
                record = frame(payload + end)
                out.write(record)
                for n, v in zip(rows, (offset, len(record), start, len(payload) // 2 + 1), strict=True):
                    rows[n].append(v)
                offset += len(record)
                start += len(payload) // 2 + 1
            yield batch(kind, doc_id=ids, part=[part] * len(ids), file=[name] * len(ids), **rows)
        if out is not None:
            out.close()

    rows = by_range(plain(docs, doc_id, text), F.col("doc_id").asc()).sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(write, schema).write.parquet(f"{folder}/index")
    return spark.read.schema(schema).parquet(f"{folder}/index")


def read_token_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of an index, read back and checked: doc_id, start (ids of all records before it), n_tokens, ids (unsigned 32-bit little-endian).

    Any subset or order of index rows may be given, with ``start`` from ``with_start``.
    """
    schema, kind = arrow(_RECORDS, index.schema["doc_id"].dataType)
    rows = index.select("doc_id", "file", "offset", "bytes", "start")

    def read(batches):
        fs, base = file_system(folder)
        for b in batches:
            for name, group in groupby(zip(*(c.to_pylist() for c in b.columns), strict=True), key=lambda r: r[1]):
                with fs.open_input_file(f"{base}/{name}") as data:
                    for run in _adjoining(group):
                        first = run[0][2]
                        data.seek(first)
                        block = data.read(run[-1][2] + run[-1][3] - first)
                        ids = [np.frombuffer(unframe(block, r[2] - first), "<u2").astype("<u4") for r in run]
                        yield batch(kind, doc_id=[r[0] for r in run], start=[r[4] for r in run], n_tokens=[len(x) for x in ids], ids=[x.tobytes() for x in ids])

    return rows.mapInArrow(read, schema)


def _adjoining(rows):
    """Lists of rows whose records stand one after the other, up to READ_BYTES."""
    run: list = []
    for r in rows:
        if run and (r[2] != run[-1][2] + run[-1][3] or r[2] + r[3] - run[0][2] > READ_BYTES):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


def with_start(index: DataFrame) -> DataFrame:
    """The index with ``start``: the ids of all records before each one, over all files in order.

    Only a total for each file goes through the driver.
    """
    totals = sorted((r.part, r.n) for r in index.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before, rows = 0, []
    for part, n in totals:
        rows.append((part, before))
        before += n
    base = index.sparkSession.createDataFrame(rows, "part int, base long")
    return index.join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("local_start")).drop("base")

"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record is: length of the payload (uint64), masked checksum of those 8 bytes (uint32), payload,
masked checksum of the payload (uint32); all little-endian.  The payload is one byte (1: the id is
given), the document id (int64) and the token ids (uint16 if the vocabulary allows, else uint32).
The checksum is CRC-32, rotated and shifted by a constant, so that a checksum of data that hold
checksums stays sound.  Beside each data file stands an index file with one entry per record: id
given (uint8), document id (int64), offset (uint64) and number of ids (uint32).

Tasks write through Arrow's file systems to a folder that all executors share.  Each attempt has its
own file names and only files of the committed manifest count, so a task may run again at any time.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .batches import texts_of
from .bpe import PieceCache
from .store import new_path, written

#: Masking of checksums (fixed values): rotate right by 15 bits, then add.
MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
ID = struct.Struct("<Bq")
CHECK = struct.Struct("<I")
ENTRY = struct.Struct("<BqQI")

MANIFEST = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("file", T.StringType()),
        T.StructField("n_records", T.LongType()),
        T.StructField("n_ids", T.LongType()),
    ]
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


@lru_cache(maxsize=2)
def library_cache(path: str, kind: str) -> PieceCache:
    """Ids from the tokenizers library, as bytes; a worker remembers those of pieces it has seen.

    New pieces that begin with a space or line feed and go on without one are joined to one text: the
    library always cuts before them.  The ids' lengths in bytes tell which piece each belongs to.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    sizes = np.zeros(tokenizer.get_vocab_size(), dtype=np.int64)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        sizes[i] = len(token)  # one letter stands for one byte

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=kind) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(pieces: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        joined = [k for k, x in enumerate(pieces) if x[0] in " \n" and x.split() == [x[1:]]]
        if joined:
            own = [pieces[k].encode() for k in joined]
            ids = ids_of([b"".join(own).decode()])[0]
            ends = np.searchsorted(np.cumsum(sizes[ids]), np.cumsum([len(x) for x in own])) + 1
            raw, ends = ids.tobytes(), (ends * ids.itemsize).tolist()
            for k, a, b in zip(joined, [0, *ends], ends):
                out[k] = raw[a:b]
        rest = [k for k, x in enumerate(out) if not x]
        if rest:
            for k, ids in zip(rest, ids_of([pieces[k] for k in rest]), strict=True):
                out[k] = ids.tobytes()
        return out

    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return PieceCache(special, encode)


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """One record."""
    payload = ID.pack(doc_id is not None, doc_id or 0) + ids
    head = struct.pack("<Q", len(payload))
    return head + CHECK.pack(masked(head)) + payload + CHECK.pack(masked(payload))


def index_entry(doc_id: int | None, offset: int, n_ids: int) -> bytes:
    return ENTRY.pack(doc_id is not None, doc_id or 0, offset, n_ids)


def index_rows(source, file: str) -> Iterator[list[tuple]]:
    """Blocks of (doc_id, file, offset, n_ids) from an open index file."""
    while block := source.read(ENTRY.size * 10_000):
        yield [(d if given else None, file, o, n) for given, d, o, n in ENTRY.iter_unpack(block)]


def parse(payload: bytes, kind: np.dtype) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a payload."""
    given, doc_id = ID.unpack_from(payload)
    return doc_id if given else None, np.frombuffer(payload, dtype=kind, offset=ID.size)


def read_frame(source) -> bytes | None:
    """The next payload of an open file, None at its end; checks both checksums."""
    head = source.read(HEAD.size)
    if not head:
        return None
    length, check = HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("a record's length is damaged")
    payload = source.read(length)
    if masked(payload) != CHECK.unpack(source.read(CHECK.size))[0]:
        raise ValueError("a record's payload is damaged")
    return payload


def write_records(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    path: str | None = None,
    parts: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    wide: bool = False,
) -> DataFrame:
    """Writes the ids of all texts, ``end_id`` after each, in ascending order of the document id.

    Returns the manifest (part, file, n_records, n_ids; part numbers follow the order), which has
    been written itself.  Null ids come first; rows that share an id are ordered by a hash of their
    text and are all kept; a null or empty text is just ``end_id``.  ``wide``: 32-bit ids, for
    vocabularies over 65,536.  Other columns are not read.
    """
    spark = docs.sparkSession
    folder = path or new_path(spark, "records")
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("id"), F.xxhash64("text")]
    # Sorted before encoding: Spark samples the range borders from the plain rows, and texts are
    # smaller than ids in the shuffle.
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
    )
    width = 4 if wide else 2

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        cache, end = library_cache(tokenizer_path, f"<u{width}"), end_id.to_bytes(width, "little")
        records = total = at = 0
        with store.open_output_stream(f"{root}/{name}.rec") as data, store.open_output_stream(
            f"{root}/{name}.idx"
        ) as index:
            for batch in batches:
                ids, texts = batch.column("id").to_pylist(), texts_of(batch, "text")
                for a in range(0, len(texts), 256):
                    frames, entries = [], []
                    coded = cache.of([(x or b"").decode("utf-8") for x in texts[a : a + 256]])
                    for doc_id, pieces in zip(ids[a : a + 256], coded, strict=True):
                        own = b"".join(pieces) + end
                        n = len(own) // width
                        frames.append(frame(doc_id, own))
                        entries.append(index_entry(doc_id, at, n))
                        at += len(frames[-1])
                        total += n
                    data.write(b"".join(frames))
                    index.write(b"".join(entries))
                    records += len(frames)
        if records:
            row = {"part": [part], "file": [f"{folder}/{name}"], "n_records": [records], "n_ids": [total]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_records", pa.int64()), ("n_ids", pa.int64())]))

    return written(ordered.mapInArrow(write, MANIFEST), "manifest")


READ = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def read_records(manifest: DataFrame, wide: bool = False) -> DataFrame:
    """Every record of the manifest's files, from first to last, one row each: doc_id, start (ids
    before it in all files), n_tokens, ids_crc32 (of its ids as little-endian uint32)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = np.dtype("<u4" if wide else "<u2")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for file, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), strict=True):
                store, place = fs.FileSystem.from_uri(f"{file}.rec")
                rows: list[tuple] = []
                with store.open_input_stream(place, buffer_size=1 << 20) as source:
                    while (payload := read_frame(source)) is not None:
                        doc_id, ids = parse(payload, kind)
                        rows.append((doc_id, first, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        first += len(ids)
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    return files.select("part", "file", "first").repartition(n, "part").mapInArrow(read, READ)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(x, type=pa.int64()) for x in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=READ.names)


def read_index(manifest: DataFrame) -> DataFrame:
    """All index entries: doc_id, file, offset, n_tokens.  Order it at random to shuffle reads."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for file in batch.column("file").to_pylist():
                store, place = fs.FileSystem.from_uri(f"{file}.idx")
                with store.open_input_stream(place) as source:
                    for rows in index_rows(source, file):
                        columns = zip(*rows, strict=True)
                        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)

    return manifest.select("file").mapInArrow(read, schema)


def read_shuffled(manifest: DataFrame, seed: int, wide: bool = False) -> DataFrame:
    """Records in a random order fixed by ``seed``: place (random number), doc_id, ids.  Every
    task fetches its share of the index by offset; sort by ``place`` for the order itself."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.xxhash64(F.lit(seed), "file", "offset").alias("place")
    drawn = read_index(manifest).select(place, "doc_id", "file", "offset").repartitionByRange(n, "place").sortWithinPartitions("place")
    schema = T.StructType([T.StructField("place", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    kind = np.dtype("<u4" if wide else "<u2")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        opened: dict = {}
        for batch in batches:
            ids = []
            for file, offset in zip(batch.column("file").to_pylist(), batch.column("offset").to_pylist(), strict=True):
                if file not in opened:
                    if len(opened) >= 64:
                        opened.pop(next(iter(opened))).close()
                    store, path = fs.FileSystem.from_uri(f"{file}.rec")
                    opened[file] = store.open_input_file(path)
                opened[file].seek(offset)
                ids.append(parse(read_frame(opened[file]), kind)[1].astype("<i4"))
            columns = [batch.column("place"), batch.column("doc_id"), pa.array(ids, type=pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        for source in opened.values():
            source.close()

    return drawn.mapInArrow(fetch, schema)

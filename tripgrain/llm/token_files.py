"""Token-id files of patched frame-of-reference blocks.

Documents are put in ascending doc_id order by a range shuffle; each task streams its range into segment
files of about ``SEGMENT_IDS`` ids below a folder that all executors share. A file is written under the
name of its attempt and then renamed, so a task that runs again leaves the same files.

File: ``PFR1``, seven little-endian int64 (range, number in the range, documents, ids, blocks, bytes of the
packed part, bytes of the exceptions), doc_ids and ids per document (int64 each), block minima (uint32),
widths and numbers of exceptions (uint8), block starts (uint32: 64-bit words before the block), packed
words (uint64), exception places (uint8) and values (uint32). A block is ``BLOCK`` ids, the last one filled
up. The width of a block is the bit length of its ``PERCENTILE`` value above the minimum; values that need
more are exceptions and 0 in the packed part. The block starts allow reading from the middle.

Files are read with Spark's binary reader; where a document starts in the whole is known from the
ids of the ranges and segments before it.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripgrain.llm.tokens import encoder
from tripgrain.session import freeze, scratch_path

BLOCK = 128
PERCENTILE = 0.9
SEGMENT_IDS = 1 << 20
END = 1
#: Bytes of text for one range.
RANGE_BYTES = 16 << 20
_MAGIC = b"PFR1"


def _width(values: np.ndarray) -> np.ndarray:
    """Bits needed for unsigned 32-bit values."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def encode_blocks(ids: np.ndarray) -> dict[str, np.ndarray]:
    """Blocks of unsigned 32-bit ids."""
    n = -(-len(ids) // BLOCK)
    blocks = np.zeros(n * BLOCK, np.uint32)
    blocks[: len(ids)] = ids
    if len(ids):
        blocks[len(ids) :] = ids[-1]
    blocks = blocks.reshape(n, BLOCK)
    least = blocks.min(axis=1) if n else np.zeros(0, np.uint32)
    above = blocks - least[:, None]
    at = int(PERCENTILE * (BLOCK - 1))
    width = _width(np.partition(above, at, axis=1)[:, at]) if n else np.zeros(0, np.int64)
    odd = _width(above) > width[:, None] if n else np.zeros((0, BLOCK), bool)
    row, place = np.nonzero(odd)
    values = above[odd]
    small = np.where(odd, 0, above).astype(np.uint64)
    words = width * BLOCK // 64
    starts = np.cumsum(words) - words
    packed = np.zeros(int(words.sum()), np.uint64)
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        out = np.zeros((len(mine), int(w) * BLOCK // 64), np.uint64)
        for j in range(BLOCK):
            word, shift = divmod(j * int(w), 64)
            column = small[mine, j]
            out[:, word] |= column << np.uint64(shift)
            if shift + w > 64:
                out[:, word + 1] |= column >> np.uint64(64 - shift)
        packed[(starts[mine][:, None] + np.arange(out.shape[1])).ravel()] = out.ravel()
    return {"least": least.astype("<u4"), "width": width.astype(np.uint8), "odd": np.bincount(row, minlength=n).astype(np.uint8),
            "starts": starts.astype("<u4"), "packed": packed.astype("<u8"), "place": place.astype(np.uint8), "value": values.astype("<u4")}


def decode_blocks(least, width, odd, starts, packed, place, value) -> np.ndarray:
    """The ids of the blocks, the last one with its filling."""
    n = len(least)
    out = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).astype(int):
        mine = np.flatnonzero(width == w)
        words = packed[starts[mine].astype(np.int64)[:, None] + np.arange(w * BLOCK // 64)]
        mask = np.uint64((1 << w) - 1)
        for j in range(BLOCK):
            word, shift = divmod(j * w, 64)
            column = words[:, word] >> np.uint64(shift)
            if shift + w > 64:
                column = column | words[:, word + 1] << np.uint64(64 - shift)
            out[mine, j] = column & mask
    out[np.repeat(np.arange(n), odd), place] = value
    return (out + least[:, None]).ravel()


def segment(part: int, number: int, docs: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    x = encode_blocks(ids)
    none = np.iinfo(np.int64).min
    head = np.array([part, number, len(docs), len(ids), len(x["least"]), 8 * len(x["packed"]), len(x["place"])], "<i8")
    names = np.array([none if d is None else d for d in docs], "<i8")
    return b"".join([_MAGIC, head.tobytes(), names.tobytes(), np.array(counts, "<i8").tobytes(),
                     *(x[k].tobytes() for k in ("least", "width", "odd", "starts", "packed", "place", "value"))])


def read_segment(data: bytes) -> tuple[int, int, list[int | None], np.ndarray, np.ndarray]:
    """(range, number, doc_ids, ids per document, ids) of a file's content."""
    if data[:4] != _MAGIC:
        raise ValueError("not a token file")
    part, number, n_docs, n_ids, blocks, packed, odd = np.frombuffer(data, "<i8", 7, 4).tolist()
    at = 4 + 7 * 8

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, n, at)
        at += found.nbytes
        return found

    docs, counts = take("<i8", n_docs), take("<i8", n_docs)
    parts = [take("<u4", blocks), take("u1", blocks), take("u1", blocks), take("<u4", blocks),
             take("<u8", packed // 8), take("u1", odd), take("<u4", odd)]
    none = np.iinfo(np.int64).min
    return part, number, [None if d == none else d for d in docs.tolist()], counts, decode_blocks(*parts)[:n_ids]


def write_files(docs: DataFrame, path: str, folder: str, end: int = END, ranges: int | None = None, markers: bool = False) -> None:
    """Write ``docs`` (doc_id, text) as segment files below ``folder``, a URI that every executor reaches.

    NULL doc_ids come first, NULL text is empty; rows that share a doc_id are documents of their own, in the
    order of their texts. With ``markers`` special tokens that stand in a text have their own ids. An empty
    table writes no file. Other columns are ignored.
    """
    from tripgrain.llm.words import text_bytes

    ranges = ranges or max(1, -(-text_bytes(docs) // RANGE_BYTES))
    uri = folder if "://" in folder else "file://" + folder.removeprefix("file:")

    def write(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(uri)
        store.create_dir(base)
        task = TaskContext.get()
        part = task.partitionId()
        encode = encoder(path, word_level=True, markers=markers).encode
        tail = np.array([end], "<u4").tobytes()
        number, names, counts, parts, held = 0, [], [], [], 0

        def flush():
            data = segment(part, number, names, counts, np.frombuffer(b"".join(parts), "<u4"))
            final = f"{base}/{part:06d}-{number:06d}.pfr"
            trial = f"{base}/_{part:06d}-{number:06d}-{task.taskAttemptId()}-{uuid.uuid4().hex}"
            with store.open_output_stream(trial) as out:
                out.write(data)
            store.move(trial, final)
            return pa.RecordBatch.from_pydict({"part": [part], "number": [number], "n_tokens": [held]},
                                              pa.schema([("part", pa.int64()), ("number", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for doc, found in zip(ids, encode(texts)):
                found += tail
                names.append(doc)
                counts.append(len(found) // 4)
                parts.append(found)
                held += counts[-1]
                if held >= SEGMENT_IDS:
                    yield flush()
                    number, names, counts, parts, held = number + 1, [], [], [], 0
        if names:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(ranges, "doc_id")
    written = rows.sortWithinPartitions("doc_id", "text").mapInArrow(write, "part long, number long, n_tokens long")
    freeze(written)  # runs the job; the files say the rest


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files alone."""
    def read(batches):
        for batch in batches:
            for data in batch.column("content"):
                part, number, docs, counts, ids = read_segment(data.as_py())
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist())]
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int64()), pa.array([number] * n, pa.int64()), pa.array(docs, pa.int64()),
                     pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                    ["part", "number", "doc_id", "inside", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfr").load(folder).select("content")
    found = freeze(files.mapInArrow(read, "part long, number long, doc_id long, inside long, n_tokens long, ids_crc32 long"))
    sizes = found.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    inside = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("part").orderBy("number")) - F.col("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("total"))
    # one row per range of 16 MB of text: few enough to be ordered in one place
    base = parts.withColumn("base", F.sum("total").over(Window.orderBy("part")) - F.col("total")).select("part", "base")
    places = inside.join(base, "part").select("part", "number", (F.col("before") + F.col("base")).alias("before"))
    return found.join(places, ["part", "number"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str, end: int = END, markers: bool = False) -> DataFrame:
    """Write ``docs`` into a new folder below the shared one and read it back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    spark.createDataFrame([], "nothing int").write.parquet(folder + os.sep + "_made")  # the folder exists, even if empty
    write_files(docs, path, folder, end, markers=markers)
    return read_files(spark, folder)

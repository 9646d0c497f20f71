"""Token ids in shard files: every document compressed alone with a shared dictionary.

A shard holds some MB of consecutive documents:

    magic "CBTK1\\0\\0\\0" | dictionary SHA-256 (32 bytes) | number of documents (u64)
    index: per document its id (i64), 1 if it has one (u64), ids in it (u64), end of its frame (u64)
    frames: zstandard frames of the ids, little-endian unsigned 32-bit

so a short document is read by its index entry and one small frame. The
dictionary is trained on the ids of a bounded sample of documents (``SAMPLE``
of them, by hash) and stored next to the shards; readers refuse a shard whose
dictionary hash is another. Shards are rows of a parquet table, which Spark can
write to and read from any store, in ascending order of ``doc_id`` (rows
without one first).
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm import tokens
from casebook.llm.arrays import tidy

MAGIC = b"CBTK1\0\0\0"
SHARD_IDS = 1 << 20  # ids after which a shard ends
SAMPLE = 1500  # documents whose ids train the dictionary
DICTIONARY_BYTES = 64 << 10
_INDEX = np.dtype([("doc_id", "<i8"), ("known", "<u8"), ("n", "<u8"), ("end", "<u8")])
END = 2


def _with_end(ids, off, end):
    """Ids with ``end`` after each document, and the new offsets."""
    n = len(off) - 1
    out = np.empty(len(ids) + n, dtype="<u4")
    closing = off[1:] + np.arange(n)
    body = np.ones(len(out), dtype=bool)
    body[closing] = False
    out[body] = ids
    out[closing] = end
    return out, off + np.arange(n + 1)


def train(docs: DataFrame, path: str, end: int = END, sample: int = SAMPLE, size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary from the ids of ``sample`` documents (those with the smallest hashes of doc_id);
    empty if these are too few or too small to train one."""
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"))
    # the keys are chosen without the texts, 24 bytes a row; the chosen texts alone move, as ids made in their tasks
    keys = keyed.select("doc_id", "h", "t").distinct().orderBy("h", "doc_id", "t").limit(sample).withColumnsRenamed(
        {"doc_id": "d", "h": "hash", "t": "text_hash"})
    chosen = keyed.join(F.broadcast(keys), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("text_hash")))

    def encoded(batches):
        for batch in batches:
            for part in tokens.groups([batch], 3):
                ids, off = _with_end(*tokens.encoder(path)(part.column(3)), end)
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([raw[4 * a:4 * b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(),
                                                                                   strict=True)], pa.binary())],
                    names=["h", "doc_id", "t", "ids"])
    got = (chosen.select("h", "doc_id", "t", "text").mapInArrow(tidy(encoded), "h long, doc_id long, t long, ids binary")
           .dropDuplicates(["h", "doc_id", "t"]).toArrow().to_pylist())
    got.sort(key=lambda r: (r["h"], r["doc_id"] is not None, r["doc_id"] or 0, r["t"]))
    samples = [r["ids"] for r in got]
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if raw else None


def shard(ids: list, sizes: list[int], frames: list[bytes], digest: bytes) -> bytes:
    index = np.zeros(len(ids), dtype=_INDEX)
    index["doc_id"] = [x or 0 for x in ids]
    index["known"] = [x is not None for x in ids]
    index["n"] = sizes
    index["end"] = np.cumsum([len(f) for f in frames]) if frames else []
    return b"".join([MAGIC, digest, len(ids).to_bytes(8, "little"), index.tobytes(), *frames])


def parse(blob: bytes, digest: bytes) -> tuple[np.ndarray, memoryview]:
    """Index and frames of a shard."""
    if blob[:8] != MAGIC or blob[8:40] != digest:
        raise ValueError("not a shard of this dictionary")
    n = int.from_bytes(blob[40:48], "little")
    index = np.frombuffer(blob, dtype=_INDEX, count=n, offset=48)
    return index, memoryview(blob)[48 + n * _INDEX.itemsize:]


def document(blob: bytes, k: int, dictionary: bytes) -> np.ndarray:
    """Ids of the k-th document of a shard; no other frame is read."""
    index, frames = parse(blob, hashlib.sha256(dictionary).digest())
    lo = int(index["end"][k - 1]) if k else 0
    unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    return np.frombuffer(unpack.decompress(frames[lo:int(index["end"][k])]), dtype="<u4")


def _shards(path, dictionary, end):
    def write(batches):
        encode = tokens.encoder(path)
        digest = hashlib.sha256(dictionary).digest()
        pack = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(dictionary))
        task = TaskContext.get().partitionId()
        ids, sizes, frames, total, before, number = [], [], [], 0, 0, 0

        def done():
            return pa.RecordBatch.from_pydict({
                "task": pa.array([task], pa.int32()), "number": pa.array([number], pa.int64()),
                "before": pa.array([before], pa.int64()), "n_ids": pa.array([total], pa.int64()),
                "blob": pa.array([shard(ids, sizes, frames, digest)], pa.binary())})

        for batch in batches:
            for part in tokens.groups([batch], 1):
                flat, off = _with_end(*encode(part.column(1)), end)
                raw = memoryview(flat).cast("B")
                for doc, a, b in zip(part.column(0).to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                    ids.append(doc)
                    sizes.append(b - a)
                    frames.append(pack.compress(raw[4 * a:4 * b]))
                    total += b - a
                    if total >= SHARD_IDS:
                        yield done()
                        before, number = before + total, number + 1
                        ids, sizes, frames, total = [], [], [], 0
        if ids:
            yield done()
    return write


def write(docs: DataFrame, path: str, out: str, end: int = END) -> None:
    """Write ``docs`` (doc_id, text) as shards under ``out``; a null or empty text is ``end`` alone."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dictionary = train(docs, path, end)
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))],
                          "sha256 string, dictionary binary").write.parquet(f"{out}/dictionary")
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    (ordered.mapInArrow(tidy(_shards(path, dictionary, end)), "task int, number long, before long, n_ids long, blob binary")
     .write.option("compression", "none").parquet(f"{out}/shards"))


def _documents(dictionary):
    def read(batches):
        digest = hashlib.sha256(dictionary).digest()
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        for batch in batches:
            for task, before, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                                          strict=True):
                index, frames = parse(blob.as_buffer().to_pybytes(), digest)
                ends = index["end"].tolist()
                raw = [unpack.decompress(frames[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                n = index["n"].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index["doc_id"], mask=index["known"] == 0), pa.array(np.full(len(n), task, dtype=np.int32)),
                     pa.array(before + np.cumsum(n) - n), pa.array(n), pa.array(raw, pa.binary())],
                    names=["doc_id", "task", "before", "n_tokens", "ids"])
    return read


def read(spark: SparkSession, out: str) -> DataFrame:
    """All documents under ``out``: doc_id, start (ids before it), n_tokens, ids (little-endian u32, binary)."""
    dictionary = bytes(spark.read.parquet(f"{out}/dictionary").first()["dictionary"])
    shards = spark.read.parquet(f"{out}/shards")
    totals = shards.groupBy("task").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    totals = totals.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if totals.count() <= 1 << 20:  # a row for each task that wrote, 12 bytes; so the blobs are not shuffled
        totals = F.broadcast(totals)
    return (shards.select("task", "before", "blob").join(totals, "task")
            .select("task", (F.col("before") + F.col("base")).alias("before"), "blob")
            .mapInArrow(tidy(_documents(dictionary)), "doc_id long, task int, before long, n_tokens long, ids binary")
            .select("doc_id", F.col("before").alias("start"), "n_tokens", "ids"))


def _crc32(batches):
    for batch in batches:
        crc = [zlib.crc32(x.as_buffer()) for x in batch.column(3)]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(crc, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what ``read`` returns."""
    return documents.mapInArrow(tidy(_crc32), "doc_id long, start long, n_tokens long, ids_crc32 long")

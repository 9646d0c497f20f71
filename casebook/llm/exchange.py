"""Moving packed arrays between Spark tasks.

Text operators produce one hash per word or byte; as rows of their own those
would be several times the text. They travel as one row per (slice of text,
bucket) instead: the ids of the documents, how many entries each has, and the
packed entries. ``routed`` deals the buckets out with ``repartitionById``, one
bucket a partition, as many buckets as ``spark.sql.shuffle.partitions``, so a
bucket's size does not grow with the corpus as long as that setting does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.arrays import tidy
from casebook.session import ensure_checkpoint_dir

PACKED = "bucket int, kind int, docs binary, counts binary, sigs binary, extra binary, places binary"


def bucket_count(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fresh() -> str:
    """A name nobody else uses."""
    return uuid.uuid4().hex


def table(df: DataFrame) -> DataFrame:
    """Write a frame that several later steps read as a zstandard parquet table in the
    shared checkpoint folder, and read it back (the lineage ends there)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/casebook-{fresh()}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column of which row k holds values[bounds[k]:bounds[k + 1]]."""
    values = np.ascontiguousarray(values)
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1,
                                 [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def packed(kind: int, bucket: np.ndarray, doc: np.ndarray, ids: np.ndarray, sigs: np.ndarray,
           extra: np.ndarray | None, n_buckets: int, places: np.ndarray | None = None) -> pa.RecordBatch:
    """One row per bucket that has entries. ``doc`` (ascending) indexes ``ids``; ``extra`` has a row per entry.

    Ids and ``places`` (int32 per entry) travel as differences, which compress well."""
    small = bucket.astype(np.uint16 if n_buckets <= 1 << 16 else np.int64)
    order = np.argsort(small, kind="stable")
    at, d = small[order], doc[order]
    fresh = np.empty(len(at), dtype=bool)
    fresh[:1] = True
    fresh[1:] = (at[1:] != at[:-1]) | (d[1:] != d[:-1])
    runs = np.flatnonzero(fresh)
    heads = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, dtype=np.int64)
    bounds = np.r_[heads, len(at)]
    run_bounds = np.searchsorted(runs, bounds)
    counts = np.diff(np.r_[runs, len(at)]).astype(np.uint32)
    n = len(heads)
    columns = [pa.array(at[heads].astype(np.int32)), pa.array(np.full(n, kind, dtype=np.int32)),
               binaries(_steps(ids[d[runs]].astype(np.int64), run_bounds), run_bounds), binaries(counts, run_bounds),
               binaries(sigs[order], bounds),
               pa.nulls(n, pa.binary()) if extra is None else binaries(extra[order], bounds),
               pa.nulls(n, pa.binary()) if places is None else
               binaries(_steps(places[order].astype(np.int32), bounds), bounds)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PACKED.split(", ")])


def _steps(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Differences to the value before, but for the first of each row."""
    out = values.copy()
    out[1:] -= values[:-1]
    out[bounds[:-1]] = values[bounds[:-1]]
    return out


def unpacked(batch: pa.RecordBatch, sig: type, extra: np.dtype | None = None) -> Iterator[tuple]:
    """(kind, document id per entry, sigs, extra, places) of each row of a packed batch."""
    for kind, docs, counts, sigs, more, places in zip(*(batch.column(i) for i in range(1, 7)), strict=True):
        ids = np.cumsum(np.frombuffer(docs.as_buffer(), dtype=np.int64))
        yield (kind.as_py(), np.repeat(ids, np.frombuffer(counts.as_buffer(), dtype=np.uint32)),
               np.frombuffer(sigs.as_buffer(), dtype=sig),
               None if extra is None or not more.is_valid else np.frombuffer(more.as_buffer(), dtype=extra),
               None if not places.is_valid else
               np.cumsum(np.frombuffer(places.as_buffer(), dtype=np.int32), dtype=np.int32))


def routed(df: DataFrame, emit: Callable, consume: Callable, schema: str, n_buckets: int) -> DataFrame:
    """``emit`` makes packed batches of Arrow batches; ``consume`` gets all of one bucket, ``kind`` 0 first."""
    def own(batches):
        yield from consume(batches)
    return (df.mapInArrow(tidy(emit), PACKED).repartitionById(n_buckets, F.col("bucket"))
            .sortWithinPartitions("kind").mapInArrow(tidy(own), schema))


def per_document(doc: np.ndarray, values: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """Rows (document id, binary of its values) from entries in any order."""
    order = np.argsort(doc, kind="stable")
    doc, values = doc[order], values[order]
    heads = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(doc[heads]), binaries(values, np.r_[heads, len(doc)])], names=names)


def spans(doc: np.ndarray, at: np.ndarray, names: list[str], length: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows (document id, int32 pairs start and number) of the runs of consecutive positions ``at``;
    with ``length`` the entries are runs already."""
    if length is None:
        order = np.lexsort((at, doc))
        doc, at = doc[order], at[order]
        head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)]) if len(doc) else \
            np.zeros(0, dtype=np.int64)
        last = np.r_[head[1:], len(at)] - 1 if len(head) else head
        length = at[last] - at[head] + 1
        doc, at = doc[head], at[head]
    pairs = np.empty(len(doc), dtype=[("start", "<i4"), ("n", "<i4")])
    pairs["start"], pairs["n"] = at, length
    return per_document(doc, pairs, names)


def covered(pairs: np.ndarray, n: int, width: int) -> np.ndarray:
    """Which of ``n`` units a window of ``width`` units covers, for windows starting in the runs ``pairs``
    (int32 start, number); windows that would pass the end are left out."""
    change = np.zeros(n + 1, dtype=np.int32)
    if len(pairs):
        start = pairs[:, 0].astype(np.int64)
        stop = np.minimum(start + pairs[:, 1] - 1, n - width)
        good = (start >= 0) & (stop >= start)
        np.add.at(change, start[good], 1)
        np.add.at(change, stop[good] + width, -1)
    return np.cumsum(change[:-1]) > 0


_SMALLER = {}
_LARGER = zstandard.ZstdDecompressor()


def squeeze(raw: bytes, level: int = 1) -> bytes:
    if level not in _SMALLER:
        _SMALLER[level] = zstandard.ZstdCompressor(level=level)
    return _SMALLER[level].compress(raw)


def unsqueeze(raw: bytes) -> bytes:
    return _LARGER.decompress(raw)


def as_texts(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of texts laid end to end."""
    off = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in raw], out=off[1:])
    return off, np.frombuffer(b"".join(raw), dtype=np.uint8)

"""SentencePiece encoding and decoding as a relational lattice.

Spaces become the mark U+2581 and one more stands in front, as in the model
files. Texts are cut into words where marks follow another character, and
before and after characters that only stand alone (control characters); no
piece goes across, so words are encoded alone and each distinct word once: its
substrings up to the longest piece's length are exploded and equi-joined to the
piece table, the edges found are grouped by word again, and the lattices of a
batch are folded position by position, holding for each the total and the
last piece of the best way there (Viterbi); a second pass walks back. Words over
LONG characters, whose lattices would be too many rows, take the same
fold in one call, in time that grows with their length. Every character also is
an edge of its own at the lowest score less a penalty, which becomes the byte
pieces of its UTF-8 form, or the unknown piece where the table has no bytes.
Scores are whole micro-units, so
sums are exact; of equal paths the one with fewer pieces wins, then the one with
the longer last piece.

The result is the segmentation with the highest total score, as for unigram
models; models trained by merges are encoded by these scores too, which may cut
words in other places than a run of their merges.

Texts are dealt to slices by a hash of the whole row, so copies of a text spread.
A slice asks for each of its distinct words once, in a squeezed row for each
bucket of words; a bucket makes a row of each of its words, gets them encoded and
answers in the order it was asked. The answers are held while the slice's texts
are read, so no row is made for each word of a text or of a slice, and a frequent
word travels once per slice. Texts travel squeezed. Decoding looks ids up in the piece
table, which each task holds (a vocabulary, not corpus data).

Defined results: a null text has no pieces and decodes to ''; a text that holds
the mark itself decodes with spaces in its place; equal words, texts and
repeated rows come out alike; words of any length are encoded whole.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.llm import exchange as X
from casebook.llm.arrays import tidy

MARK = "▁"
PENALTY = 10_000_000
UNIT = 1_000_000
ROWS = 256  # texts put together at once
SHARE = 8  # partitions of words to one of texts
LATTICES = 2048  # words folded at once
LEVEL = 5  # of compression, for what is written by the gigabyte
BUNDLED = 1 << 17  # encoded words put into rows at once
LONG = 64  # characters of a word up to which its lattice is rows; a longer word is folded in one call
_WORD = f"[\\x00-\\x1F]|{MARK}+[^{MARK}\\x00-\\x1F]*|[^{MARK}\\x00-\\x1F]+"


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    """id, piece, score (micro-units), kind (normal, byte, unknown, other) of a SentencePiece model file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = []
    for k in range(model.get_piece_size()):
        kind = ("unknown" if model.is_unknown(k) else "byte" if model.is_byte(k) else
                "other" if model.is_control(k) or model.is_unused(k) else "normal")
        rows.append((k, model.id_to_piece(k), round(model.get_score(k) * UNIT), kind))
    return spark.createDataFrame(rows, "id int, piece string, score long, kind string")


def _long_paths(normal: dict, longest: int, least: int):
    """The same fold for words over LONG characters, position by position with a back-pointer each."""
    def path(word: str) -> list[tuple]:
        best = [(0, 0, 0)]
        for end in range(1, len(word) + 1):
            ways = []
            for n in range(1, min(longest, end) + 1):
                score = normal[word[end - n:end]][1] if word[end - n:end] in normal else least if n == 1 else None
                if score is not None:
                    total, count, _ = best[end - n]
                    ways.append((total + score, count - 1, n))
            best.append(max(ways))
        out, end = [], len(word)
        while end:
            piece = word[end - best[end][2]:end]
            out.append((normal[piece][0], None) if piece in normal else (None, piece))
            end -= best[end][2]
        return out[::-1]

    @F.arrow_udf("array<struct<id:int,piece:string>>")
    def run(column: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("id", pa.int32()), ("piece", pa.string())]))
        return pa.array([[{"id": i, "piece": p} for i, p in path(w.as_py())] for w in column], kind)
    return run


def _best_paths(edges: pa.ListArray) -> pa.ListArray:
    """The best way through each lattice (end, n, score, id): id and end of its edges, in order.

    All lattices of a batch go from position to position together (Viterbi); of edges into one position the one
    with the highest total wins, then fewer pieces, the longer last piece, the higher id."""
    kind = pa.list_(pa.struct([("id", pa.int32()), ("at", pa.int32())]))
    if not len(edges):
        return pa.array([], kind)
    bounds = edges.offsets.to_numpy()
    flat = edges.values.slice(bounds[0], bounds[-1] - bounds[0])
    end, n, score = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("end", "n", "score"))
    ids = flat.field("id").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    word = np.repeat(np.arange(len(edges)), np.diff(bounds))
    size = np.zeros(len(edges), dtype=np.int64)
    np.maximum.at(size, word, end)
    base = np.cumsum(size + 1) - size - 1
    node = base[word] + end
    total, count, last, piece = (np.zeros(int((size + 1).sum()), dtype=np.int64) for _ in range(4))
    by_end = np.argsort(end, kind="stable")
    cuts = np.searchsorted(end[by_end], np.arange(1, size.max(initial=0) + 2))
    for k in range(len(cuts) - 1):
        e = by_end[cuts[k]:cuts[k + 1]]
        before = node[e] - n[e]
        sums, counts = total[before] + score[e], count[before] - 1
        order = np.lexsort((ids[e], n[e], counts, sums, node[e]))
        at = node[e][order]
        won = order[np.flatnonzero(np.r_[at[1:] != at[:-1], True])]
        to = node[e][won]
        total[to], count[to], last[to], piece[to] = sums[won], counts[won], n[e][won], ids[e][won]
    steps, rows, here = [], np.flatnonzero(size), size.copy()
    while len(rows):
        spot = base[rows] + here[rows]
        steps.append((rows, here[rows], piece[spot]))
        here[rows] -= last[spot]
        rows = rows[here[rows] > 0]
    word, at, found = (np.concatenate([x[k] for x in steps]) if steps else np.zeros(0, dtype=np.int64) for k in range(3))
    order = np.lexsort((at, word))
    found, at = found[order], at[order]
    paths = pa.StructArray.from_arrays([pa.array(found.astype(np.int32), mask=found < 0), pa.array(at.astype(np.int32))],
                                       names=["id", "at"])
    starts = np.r_[0, np.cumsum(np.bincount(word, minlength=len(edges)))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), paths).cast(kind)


def _paths(edges: Column) -> Column:
    @F.arrow_udf("array<struct<id:int,at:int>>")
    def run(column: pa.Array) -> pa.Array:
        return pa.concat_arrays([_best_paths(column.slice(lo, LATTICES)) for lo in range(0, len(column), LATTICES)]) \
            if len(column) else _best_paths(column)
    return run(edges)


def encode_words(distinct: DataFrame, pieces: DataFrame) -> DataFrame:
    """``distinct`` (word, each once, partitioned by word) -> word, ids."""
    spark = distinct.sparkSession
    facts = pieces.agg(F.max(F.when(F.col("kind") == "normal", F.length("piece"))).alias("longest"),
                       F.min("score").alias("least"),
                       F.min(F.when(F.col("kind") == "unknown", F.col("id"))).alias("unknown")).first()
    longest, least = facts["longest"] or 1, (facts["least"] or 0) - PENALTY
    # 256 rows at most
    byte_ids = {int(r["piece"][1:-1], 16): r["id"] for r in pieces.filter("kind = 'byte'").collect()}
    normal = pieces.filter("kind = 'normal'").select("piece", "id", "score")
    normal_rows = {r["piece"]: (r["id"], r["score"]) for r in normal.collect()}  # a vocabulary, not corpus data
    if normal.count() <= 1 << 20:  # a vocabulary, not corpus data
        normal = F.broadcast(normal)
    short = distinct.filter(F.length("word") <= LONG)
    spots = short.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("start"))
    cut = spots.select("word", "start", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(longest), F.length("word") - F.col("start") + 1))).alias("n"))
    cut = cut.withColumn("piece", F.substring(F.col("word"), F.col("start"), F.col("n")))
    edge = F.struct((F.col("start") + F.col("n") - 1).alias("end"), F.col("n").alias("n"),
                    F.coalesce("score", F.lit(least)).cast("long").alias("score"), F.col("id").cast("int").alias("id"))
    edges = cut.join(normal, "piece", "left").filter(F.col("id").isNotNull() | (F.col("n") == 1)).select("word", edge.alias("e"))
    lattice = edges.groupBy("word").agg(F.collect_list("e").alias("edges"))
    found = lattice.select("word", _paths(F.col("edges")).alias("path"))
    best = found.select("word", F.transform("path", lambda p: F.struct(
        p["id"].alias("id"), F.when(p["id"].isNull(), F.substring(F.col("word"), p["at"], F.lit(1))).alias("piece"))).alias("path"))
    best = best.unionByName(distinct.filter(F.length("word") > LONG).select("word", _long_paths(
        normal_rows, longest, least)(F.col("word")).alias("path")))
    if byte_ids:
        table = F.create_map(*[F.lit(x) for b, k in sorted(byte_ids.items()) for x in (f"{b:02X}", k)])
        spell = lambda c: F.transform(F.regexp_extract_all(F.hex(F.encode(c, "UTF-8")), F.lit(".."), F.lit(0)),
                                      lambda b: table[b])
    else:
        spell = lambda c: F.array(F.lit(facts["unknown"] or 0))
    return best.select("word", F.flatten(F.transform("path", lambda p: F.when(
        p["id"].isNotNull(), F.array(p["id"])).otherwise(spell(p["piece"])))).alias("ids"))


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


ASKED = "_piece_slice int, _piece_bucket int, _piece_sizes binary, _piece_words binary"
ANSWERED = f"{ASKED}, _piece_counts binary, _piece_ids binary"


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _cut(sizes: bytes, words: bytes) -> list[str]:
    """The words of a squeezed row."""
    ends = np.cumsum(np.frombuffer(X.unsqueeze(sizes), dtype=np.int32)).tolist()
    text = X.unsqueeze(words).decode()
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _cut_ids(counts: bytes, ids: bytes) -> list[bytes]:
    ends = (np.cumsum(np.frombuffer(X.unsqueeze(counts), dtype=np.int32)) * 4).tolist()
    raw = X.unsqueeze(ids)
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _numbers(values: list[int]) -> bytes:
    return X.squeeze(np.array(values, dtype=np.int32).tobytes(), LEVEL)


def _ask(buckets: int):
    """The squeezed texts of one slice -> a row of its distinct words for each bucket."""
    find = re.compile(_WORD).findall

    def apply(batches):
        used, at = set(), None
        for batch in batches:
            if batch.num_rows:
                at = _column(batch, "_piece_slice")[0].as_py()
            for z in _column(batch, "text"):
                used.update(find(MARK + X.unsqueeze(z.as_buffer()).decode().replace(" ", MARK)))
        of: dict[int, list[str]] = {}
        for w in used:
            of.setdefault(crc32(w.encode()) % buckets, []).append(w)
        used.clear()
        for bucket, mine in of.items():
            mine.sort()
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([bucket], pa.int32()), pa.array([_numbers([len(w) for w in mine])]),
                 pa.array([X.squeeze("".join(mine).encode(), LEVEL)])], names=[c.split()[0] for c in ASKED.split(", ")])
    return apply


def _distinct(batches):
    """All that slices ask of one bucket -> its words."""
    used = set()
    for batch in batches:
        for sizes, raw in zip(*(_column(batch, c).to_pylist() for c in ("_piece_sizes", "_piece_words")), strict=True):
            used.update(_cut(sizes, raw))
    rows = pa.array(list(used), pa.string())
    used.clear()
    for lo in range(0, len(rows), LATTICES):
        yield pa.RecordBatch.from_arrays([rows.slice(lo, LATTICES)], names=["word"])


def _bundle(buckets: int):
    """Encoded words -> rows of words with their ids for each bucket."""
    def rows(of):
        for bucket, mine in of.items():
            mine.sort()
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int32()), pa.array([bucket], pa.int32()), pa.array([_numbers([len(w) for w, _ in mine])]),
                 pa.array([X.squeeze("".join([w for w, _ in mine]).encode(), LEVEL)]),
                 pa.array([_numbers([len(x) // 4 for _, x in mine])]),
                 pa.array([X.squeeze(b"".join([x for _, x in mine]), LEVEL)])], names=[c.split()[0] for c in ANSWERED.split(", ")])

    def apply(batches):
        of: dict[int, list[tuple]] = {}
        held = 0
        for batch in batches:
            ids = _column(batch, "ids")
            raw = ids.flatten().to_numpy(zero_copy_only=False).astype("<i4").tobytes()
            ends = (np.r_[0, np.cumsum(pc.list_value_length(ids).to_numpy())] * 4).tolist()
            for w, a, b in zip(_column(batch, "word").to_pylist(), ends, ends[1:], strict=False):
                of.setdefault(crc32(w.encode()) % buckets, []).append((w, raw[a:b]))
            held += batch.num_rows
            if held > BUNDLED:
                yield from rows(of)
                of, held = {}, 0
        yield from rows(of)
    return apply


def _answer(batches):
    """Of one bucket the encoded words and then what slices ask -> the same with the ids."""
    book: dict[str, bytes] = {}
    names = [c.split()[0] for c in ANSWERED.split(", ")]
    for batch in batches:
        for k, (sizes, words, counts, ids) in enumerate(zip(*(_column(batch, c).to_pylist() for c in names[2:]), strict=True)):
            if ids is not None:
                book.update(zip(_cut(sizes, words), _cut_ids(counts, ids), strict=True))
                continue
            found = [book[w] for w in _cut(sizes, words)]
            row = batch.slice(k, 1).select(names[:4])
            yield pa.RecordBatch.from_arrays(
                [*row.columns, pa.array([_numbers([len(x) // 4 for x in found])]),
                 pa.array([X.squeeze(b"".join(found), LEVEL)])], names=names)


def _give(columns: list[str]):
    """Of one slice the answers and then its texts -> the texts' rows with their ids."""
    find = re.compile(_WORD).findall
    given = [c.split()[0] for c in ANSWERED.split(", ")][2:]

    def apply(batches):
        book: dict[str, bytes] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                answers = part.filter(_column(part, "_piece_words").is_valid())
                for sizes, words, counts, ids in zip(*(_column(answers, c).to_pylist() for c in given), strict=True):
                    book.update(zip(_cut(sizes, words), _cut_ids(counts, ids), strict=True))
                rows = part.filter(_column(part, "_piece_words").is_null()).select(columns)
                out, sizes, texts = [], [], []
                for z in _column(rows, "text").to_pylist():
                    text = None if z is None else X.unsqueeze(z).decode()
                    raw = b"".join(map(book.__getitem__, find(MARK + text.replace(" ", MARK)))) if text else b""
                    texts.append(text)
                    out.append(raw)
                    sizes.append(len(raw) // 4)
                rows = rows.set_column(columns.index("text"), "text", pa.array(texts, pa.string()))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)),
                                                 pa.array(np.frombuffer(b"".join(out), dtype=np.int32)))
                yield _with(rows, "ids", lists)
    return apply


def _squeezed(text: Column) -> Column:
    @F.arrow_udf("binary")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else X.squeeze(x, LEVEL) for x in column.cast(pa.binary()).to_pylist()], pa.binary())
    return run(text)


def encode(texts: DataFrame, pieces: DataFrame) -> DataFrame:
    """``texts`` with a column ``ids`` (array<int>; one of that name is replaced) for its column ``text``."""
    n = X.bucket_count(texts.sparkSession)
    texts = texts.drop("ids")
    columns = texts.columns
    texts = texts.withColumn("text", F.col("text").cast("string"))
    dealt = texts.withColumn("_piece_slice", F.pmod(F.xxhash64(
        *(F.col(f"`{c}`") for c, kind in texts.dtypes if "map<" not in kind)), F.lit(n)).cast("int"))
    asked = X.table(dealt.filter(F.col("text") != "").select("_piece_slice", _squeezed(F.col("text")).alias("text"))
                    .repartitionById(n, F.col("_piece_slice")).mapInArrow(tidy(_ask(n)), ASKED))
    used = asked.select("_piece_bucket", "_piece_sizes", "_piece_words").repartitionById(n, F.col("_piece_bucket"))
    # many partitions of a fixed number: a word becomes dozens of rows, which are sorted in memory to group them again
    coded = X.table(encode_words(used.mapInArrow(tidy(_distinct), "word string").repartition(SHARE * n, "word"), pieces))
    books = (coded.mapInArrow(tidy(_bundle(n)), ANSWERED).unionByName(asked, allowMissingColumns=True)
             .repartitionById(n, F.col("_piece_bucket")).sortWithinPartitions(F.col("_piece_ids").isNull())
             .mapInArrow(tidy(_answer), ANSWERED))
    both = dealt.withColumn("text", _squeezed(F.col("text"))).unionByName(books.drop("_piece_bucket"), allowMissingColumns=True)
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in texts.schema),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return (both.repartitionById(n, F.col("_piece_slice")).sortWithinPartitions(F.col("_piece_words").isNull())
            .mapInArrow(tidy(_give(columns)), schema))


def _spell(table: dict[int, bytes]):
    size = np.zeros(max(table, default=-1) + 2, dtype=np.int64)  # the last: ids that are not in the table
    size[list(table)] = [len(x) for x in table.values()]
    start = np.cumsum(size) - size
    spelt = np.frombuffer(b"".join([table[k] for k in sorted(table)]), dtype=np.uint8)

    def apply(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                lists = _column(part, "ids")
                ids = lists.flatten().fill_null(-1).to_numpy()
                ids = np.where((ids < 0) | (ids >= len(size) - 1), len(size) - 1, ids)
                n = size[ids]
                ends = np.r_[0, np.cumsum(n)]
                raw = spelt[np.repeat(start[ids] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
                many = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                bounds = ends[np.r_[0, np.cumsum(many)]].tolist()
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:], strict=False)]
                yield _with(part, "decoded", pa.array([x[1:] if x[:1] == " " else x for x in texts], pa.string()))
    return apply


def decode(coded: DataFrame, pieces: DataFrame) -> DataFrame:
    """``coded`` with a column ``decoded`` (one of that name is replaced) for its column ``ids``."""
    coded, table = coded.drop("decoded"), {}
    for r in pieces.collect():  # a vocabulary, not corpus data
        table[r["id"]] = (bytes([int(r["piece"][1:-1], 16)]) if r["kind"] == "byte" else
                          r["piece"].replace(MARK, " ").encode() if r["kind"] == "normal" else
                          " ⁇ ".encode() if r["kind"] == "unknown" else b"")
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in coded.schema),
                           T.StructField("decoded", T.StringType())])
    return coded.mapInArrow(tidy(_spell(table)), schema)

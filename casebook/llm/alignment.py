"""Cross-tokenizer alignment: groups of tokens that two tokenizers end together.

Each text is encoded twice: A, a byte-level BPE of the tokenizers library, on a
space and the text; B, a sentencepiece model that puts the space there itself.
Both give the same bytes, so the cumulative byte ends of the tokens are
comparable: a dictionary from end to index for either side, the intersection of
the two key sets, and its sorted keys slice both id lists into groups. In each
slice the tokens that end together (its last of A and its last of B) are linked.

Links are counted over the whole corpus. A slice of texts sums its id pairs, a
task merges its slices' sums, and buckets of pairs add them up; the highest count
of every B id has one row per id of the vocabulary. Counts go back to the slices,
one number per distinct pair of a slice, not per link.

Defined results: texts that are null or empty, or whose tokens' bytes differ from
space and text on either side (U+2581 in a text), have no tokens, groups or
links, and an empty digest. Special tokens' strings are plain text. Repeated rows
and ids count once per row; a null doc_id stays null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import exchange as X
from casebook.llm import tokens
from casebook.llm.arrays import mix, tidy, utf8

GROUP_BYTES = 2 << 20  # text aligned at once
MERGED = 1 << 21  # distinct pairs that a task holds before it sends their sums

U64 = np.uint64


class Vocabulary:
    """Bytes of each id, end to end."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(x) for x in entries], dtype=np.int64)
        self.start = np.r_[0, np.cumsum(self.size)]
        self.flat = np.frombuffer(b"".join(entries), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        total = np.cumsum(n)
        return self.flat[np.repeat(self.start[ids] - (total - n), n) + np.arange(total[-1] if len(total) else 0)]


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level BPE: printable bytes stand for themselves,
    the others are numbered from U+0100."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(0x100 + k): b for k, b in enumerate(rest)}}


class Pieces:
    """Encoder B of texts that begin with the space which the model puts there itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.vocabulary = Vocabulary([bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("\u2581", " ").encode()
                                      for k, p in enumerate(names)])
        self.space = array("I", [self.model.piece_to_id("\u2581")]).tobytes()
        # no piece goes on with a space after another character, so texts can be cut before spaces
        self.cut = not any("\u2581" in p.lstrip("\u2581") for p in names)

    def __call__(self, lead: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and each one's range of them."""
        found = self.model.encode([x[1:].decode() for x in lead], num_threads=1) if lead else []
        # the model makes nothing of an empty text, but a space of the space that ends one
        return tokens._joined([array("I", x).tobytes() if x else self.space for x in found])


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=2)
def byte_vocabulary(path: str) -> Vocabulary:
    known = tokens.encoder(path, True).tokenizer.get_vocab(with_added_tokens=True)
    letters = byte_letters()
    entries = [b""] * (max(known.values()) + 1)
    for token, k in known.items():
        entries[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return Vocabulary(entries)


def _right(ids: np.ndarray, bounds: np.ndarray, of: Vocabulary, off: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Which texts the tokens' bytes equal."""
    n = np.diff(np.r_[0, np.cumsum(of.size[ids])][bounds])
    same = n == np.diff(off)
    joined = of.joined(ids[np.repeat(same, np.diff(bounds))])
    text = data[np.repeat(same, np.diff(off))]
    wrong = np.flatnonzero(joined != text)
    if len(wrong):
        who = np.flatnonzero(same)
        edge = np.cumsum(np.diff(off)[who])
        same[who[np.searchsorted(edge, wrong, side="right")]] = False
    return same


class Groups:
    """Texts that begin with their space: ids of A and B, the indexes of the tokens of A and of B that end groups (from
    each text's first token), each text's range of these, and the groups as ``a1,a2|b1;a3|b2,b3;``."""

    def __init__(self, lead: pa.Array, bpe: str, piece_model: str):
        off, data = utf8(lead)
        a, of_a = tokens.encoder(bpe, True)(lead.cast(pa.large_string()))
        b, of_b = pieces(piece_model)(lead.to_pylist())
        bytes_a, bytes_b = byte_vocabulary(bpe), pieces(piece_model).vocabulary
        self.right = _right(a, of_a, bytes_a, off, data) & _right(b, of_b, bytes_b, off, data)
        (a, of_a), (b, of_b) = _kept(a, of_a, self.right), _kept(b, of_b, self.right)
        # cumulative ends run on from text to text on both sides alike; the dictionaries from end to index are tables
        # with a place for every byte, which keeps their keys in order
        ends = [np.cumsum(v.size[ids]) for v, ids in ((bytes_a, a), (bytes_b, b))]
        index = [np.full(len(data) + 1, -1, dtype=np.int64) for _ in ends]
        for table, e in zip(index, ends, strict=True):
            table[e] = np.arange(len(e))
        common = np.flatnonzero((index[0] >= 0) & (index[1] >= 0))
        last_a, last_b = (table[common] for table in index)
        of_group = np.searchsorted(last_a, of_a)
        text, at = _written(a, b, last_a, last_b)
        edge = at[of_a + of_b].tolist()
        self.written = [text[lo:hi] for lo, hi in zip(edge, edge[1:], strict=False)]
        size = np.diff(of_group)
        self.a, self.of_a, self.b, self.of_b, self.of_group = a, of_a, b, of_b, of_group
        self.last_a, self.last_b = last_a - np.repeat(of_a[:-1], size), last_b - np.repeat(of_b[:-1], size)


def _written(a, b, last_a, last_b) -> tuple[bytes, np.ndarray]:
    """All groups as text with a sign after each id, and where each token's text begins."""
    # a token sorts by its group and side, so both sides interleave by one stable order
    side_a, side_b = (np.searchsorted(last, np.arange(len(x))) for last, x in ((last_a, a), (last_b, b)))
    order = np.argsort(np.r_[2 * side_a, 2 * side_b + 1], kind="stable")
    sign = np.full(len(order), ord(","), dtype=np.uint8)
    sign[last_a] = ord("|")
    sign[len(a) + last_b] = ord(";")
    ids, sign = np.r_[a, b].astype(np.int64)[order], sign[order]
    digits, width = _decimals(int(ids.max()) if len(ids) else 0)
    size = width[ids] + 1
    end = np.cumsum(size)
    out = np.empty(end[-1] if len(end) else 0, dtype=np.uint8)
    for p in range(digits.shape[1]):
        have = np.flatnonzero(size > p + 1)
        out[end[have] - size[have] + p] = digits[ids[have], p]
    out[end - 1] = sign
    return out.tobytes(), np.r_[0, end]


def _chunks(off: np.ndarray, data: np.ndarray, cut: bool) -> np.ndarray:
    """Where chunks begin: at texts, and at spaces after what is surely no white space (both tokenizers start anew
    there; after white space, A's runs of it would be cut differently)."""
    begin = np.zeros(len(data) + 1, dtype=bool)
    if cut:
        open_ = data > 32  # may stand before a cut
        wide = (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))  # lead bytes of all white space beyond ASCII
        far = data >= 0x80
        open_ &= ~wide
        for back in (1, 2):
            open_[back:] &= ~(wide[:-back] & far[back:])
        begin[1:-1] = (data[1:] == 32) & open_[:-1]
    begin[off] = True
    return np.flatnonzero(begin[:-1])


class Aligned:
    """A slice of texts: ids of both sides, and per group the index of its last token on either side."""

    def __init__(self, texts: pa.Array, bpe: str, piece_model: str):
        some = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
        lead = pc.if_else(some, pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), ""), "")
        off, data = utf8(lead)
        starts = _chunks(off, data, pieces(piece_model).cut)
        edges = np.r_[starts, len(data)].astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(edges.tobytes()), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        each = Groups(coded.dictionary, bpe, piece_model)  # each distinct chunk once
        # a text with a chunk that disagrees has no tokens at all
        wrong = ~each.right[code]
        of = np.searchsorted(starts, off)
        right = np.diff(np.r_[0, np.cumsum(wrong)][of]) == 0
        code, of = _kept(code, of, right)
        self.a, at_a = _gathered(each.a, each.of_a, code)
        self.b, at_b = _gathered(each.b, each.of_b, code)
        last_a, at_group = _gathered(each.last_a, each.of_group, code)
        last_b, _ = _gathered(each.last_b, each.of_group, code)
        size = np.diff(at_group)
        self.last_a, self.last_b = last_a + np.repeat(at_a[:-1], size), last_b + np.repeat(at_b[:-1], size)
        self.of_a, self.of_b, self.of_group = at_a[of], at_b[of], at_group[of]
        self._written = each.written, code.tolist(), of.tolist()

    def links(self) -> np.ndarray:
        """Id pairs (A's above B's 32 bits) of the tokens that end together."""
        return self.a[self.last_a].astype(np.uint64) << U64(32) | self.b[self.last_b].astype(np.uint64)

    def digests(self) -> list[str]:
        """Hex SHA-256 of ``a1,a2|b1;a3|b2,b3`` per text, '' without tokens."""
        text, code, of = self._written
        return [hashlib.sha256(b"".join([text[c] for c in code[lo:hi]])[:-1]).hexdigest() if hi > lo else ""
                for lo, hi in zip(of[:-1], of[1:], strict=True)]


def _gathered(flat: np.ndarray, bounds: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``code`` of ``flat`` end to end, and where each begins."""
    n = np.diff(bounds)[code]
    end = np.cumsum(n)
    return flat[np.repeat(bounds[code] - (end - n), n) + np.arange(end[-1] if len(end) else 0)], np.r_[0, end]


@lru_cache(maxsize=2)
def _decimal_table(places: int) -> tuple[np.ndarray, np.ndarray]:
    names = np.arange(10 ** places).astype(f"S{places}")
    return names.view(np.uint8).reshape(-1, places), np.char.str_len(names).astype(np.int64)


def _decimals(largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits (ASCII, from the left) and their number for every id up to ``largest``."""
    return _decimal_table(max(1, len(str(largest))))


def _kept(ids: np.ndarray, bounds: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(bounds)
    return ids[np.repeat(right, size)], np.r_[0, np.cumsum(np.where(right, size, 0))].astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], bpe: str, piece_model: str):
    for batch in tokens.groups(batches, 1, GROUP_BYTES):
        yield batch, Aligned(batch.column(1), bpe, piece_model)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def align(docs: DataFrame, bpe: str, piece_model: str) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, a_ids, b_ids, a_ends, b_ends: ids of either side, and per group how many
    of them it ends at (the last of each side are linked)."""
    def run(batches):
        for batch, x in _slices(batches, bpe, piece_model):
            size = np.diff(x.of_group)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(x.a, x.of_a), _lists(x.b, x.of_b),
                 _lists(x.last_a + 1 - np.repeat(x.of_a[:-1], size), x.of_group),
                 _lists(x.last_b + 1 - np.repeat(x.of_b[:-1], size), x.of_group)],
                names=["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])
    return _input(docs).mapInArrow(tidy(run), "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, "
                                              "b_ends array<int>")


SLICE = ("slice long, doc_id array<long>, n_a array<int>, n_b array<int>, n_groups array<int>, digest array<string>, "
         "pairs binary, n binary, codes binary")


def _one(values, kind) -> pa.Array:
    """A list column of one row."""
    values = pa.array(values, kind) if not isinstance(values, pa.Array) else values
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _summed(batches, bpe, piece_model):
    number = TaskContext.get().partitionId() << 33
    for k, (batch, x) in enumerate(_slices(batches, bpe, piece_model)):
        pairs, code, n = np.unique(x.links(), return_inverse=True, return_counts=True)
        codes = code.astype(np.uint16 if len(pairs) <= 1 << 16 else np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number + k], pa.int64()), _one(batch.column(0), pa.int64()), _one(np.diff(x.of_a), pa.int32()),
             _one(np.diff(x.of_b), pa.int32()), _one(np.diff(x.of_group), pa.int32()), _one(x.digests(), pa.string()),
             *(pa.array([v.tobytes()], pa.binary()) for v in (pairs, n.astype(np.int64), codes))],
            names=[c.split()[0] for c in SLICE.split(", ")])


def _bucket(pairs: np.ndarray, n_buckets: int) -> np.ndarray:
    return (mix(pairs) >> U64(20)).astype(np.int64) % n_buckets


def _dealt(pairs: np.ndarray, n: np.ndarray, n_buckets: int) -> pa.RecordBatch:
    """A row (bucket, pairs, n) per bucket."""
    at = _bucket(pairs, n_buckets)
    order = np.argsort(at, kind="stable")
    found, first = np.unique(at[order], return_index=True)
    edge = np.r_[first, len(order)]
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), X.binaries(pairs[order], edge),
                                       X.binaries(n[order], edge)], names=["bucket", "pairs", "n"])


def _added(pairs: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate(pairs), return_inverse=True)
    total = np.zeros(len(keys), dtype=np.int64)
    np.add.at(total, at, np.concatenate(n))
    return keys, total


def _numbers(column, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=kind) for x in column]


def _merged(n_buckets):
    """Sums of a task's slices, dealt into buckets."""
    def run(batches):
        held, count = ([], []), 0
        for batch in batches:
            for pairs, n in zip(_numbers(batch.column(0), np.uint64), _numbers(batch.column(1), np.int64), strict=True):
                held[0].append(pairs), held[1].append(n)
                count += len(pairs)
                if count > MERGED:
                    keys, total = _added(*held)
                    held, count = ([keys], [total]), len(keys)
                    if count > MERGED // 2:
                        yield _dealt(keys, total, n_buckets)
                        held, count = ([], []), 0
        if count:
            yield _dealt(*_added(*held), n_buckets)
    return run


def _totals(batches):
    """One row per bucket: its pairs in order and their counts over the corpus."""
    bucket, held, count = None, ([], []), 0
    for batch in batches:
        for k, pairs, n in zip(batch.column(0).to_pylist(), _numbers(batch.column(1), np.uint64),
                               _numbers(batch.column(2), np.int64), strict=True):
            bucket = k
            held[0].append(pairs.copy()), held[1].append(n.copy())
            count += len(pairs)
            if count > MERGED:  # equal pairs of many tasks merge before more are held
                held = tuple([x] for x in _added(*held))
                count = 0
    if bucket is not None:
        keys, total = _added(*held)
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([keys.tobytes()], pa.binary()),
                                          pa.array([total.tobytes()], pa.binary())], names=["bucket", "pairs", "n"])


def _highest(batches):
    """Per B id of a bucket the highest count of its pairs."""
    for batch in batches:
        for pairs, n in zip(_numbers(batch.column(0), np.uint64), _numbers(batch.column(1), np.int64), strict=True):
            b, at = np.unique(pairs & U64(0xFFFFFFFF), return_inverse=True)
            top = np.zeros(len(b), dtype=np.int64)
            np.maximum.at(top, at, n)
            yield pa.RecordBatch.from_arrays([pa.array(b.astype(np.int64)), pa.array(top)], names=["b", "n"])


def _asked(n_buckets):
    def run(batches):
        for batch in batches:
            for number, pairs in zip(batch.column(0).to_pylist(), _numbers(batch.column(1), np.uint64), strict=True):
                if len(pairs):
                    dealt = _dealt(pairs, pairs, n_buckets)
                    yield pa.RecordBatch.from_arrays([dealt.column(0), pa.array([number] * dealt.num_rows, pa.int64()),
                                                      dealt.column(1)], names=["bucket", "slice", "pairs"])
    return run


def _answers(batches):
    """A bucket's totals come first, then slices with their pairs; back go the counts in the order of the pairs."""
    keys, total = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    for batch in batches:
        for r in range(batch.num_rows):
            pairs = np.frombuffer(batch.column(3)[r].as_buffer(), dtype=np.uint64)
            if batch.column(1)[r].as_py() == 0:
                keys, total = pairs.copy(), np.frombuffer(batch.column(4)[r].as_buffer(), dtype=np.int64).copy()
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(2)[r].as_py()], pa.int64()), pa.array([batch.column(0)[r].as_py()], pa.int32()),
                 pa.array([total[np.searchsorted(keys, pairs)].tobytes()], pa.binary())], names=["slice", "bucket", "n"])


COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _counted(top: dict[int, int], n_buckets: int):
    """A slice's own row and the counts of its pairs -> a row per document."""
    ids = np.array(sorted(top), dtype=np.uint64)
    highest = np.array([top[int(k)] for k in ids], dtype=np.int64)

    def finished(own, replies):
        pairs = np.frombuffer(own["pairs"], dtype=np.uint64)
        count = np.zeros(len(pairs), dtype=np.int64)
        at = _bucket(pairs, n_buckets)
        order = np.argsort(at, kind="stable")
        heads = np.searchsorted(at[order], np.arange(n_buckets + 1))
        for bucket, n in replies:
            count[order[heads[bucket]:heads[bucket + 1]]] = np.frombuffer(n, dtype=np.int64)
        best = count == highest[np.searchsorted(ids, pairs & U64(0xFFFFFFFF))] if len(pairs) else np.zeros(0, dtype=bool)
        codes = np.frombuffer(own["codes"], dtype=np.uint16 if len(pairs) <= 1 << 16 else np.uint32)
        groups = np.array(own["n_groups"], dtype=np.int64)
        edge = np.r_[0, np.cumsum(groups)]
        sums = [np.r_[0, np.cumsum(v[codes], dtype=np.int64)] for v in (best, count)]
        n_best, total = (s[edge[1:]] - s[edge[:-1]] for s in sums)
        return pa.RecordBatch.from_arrays(
            [pa.array(own["doc_id"], pa.int64()), pa.array(own["n_a"], pa.int64()), pa.array(own["n_b"], pa.int64()),
             pa.array(groups), pa.array(groups), pa.array(n_best), pa.array(total), pa.array(own["digest"], pa.string())],
            names=[c.split()[0] for c in COUNTED.split(", ")])

    def run(batches):
        own, replies = None, []
        for batch in batches:
            for r in range(batch.num_rows):
                if batch.column("kind")[r].as_py() == 0:
                    if own is not None:
                        yield finished(own, replies)
                    own, replies = {c: batch.column(c)[r].as_py() for c in batch.schema.names}, []
                else:
                    replies.append((batch.column("bucket")[r].as_py(), batch.column("reply")[r].as_py()))
        if own is not None:
            yield finished(own, replies)
    return run


def count_links(docs: DataFrame, bpe: str, piece_model: str) -> DataFrame:
    """``docs`` (doc_id, text) -> per document the numbers of tokens, groups and links, how many links have the
    highest corpus-wide count of their B id, the sum of the links' counts, and a digest of the groups."""
    n = X.bucket_count(docs.sparkSession)
    slices = X.table(_input(docs).mapInArrow(tidy(lambda it: _summed(it, bpe, piece_model)), SLICE))
    sums = (slices.select("pairs", "n").mapInArrow(tidy(_merged(n)), "bucket int, pairs binary, n binary")
            .repartitionById(n, F.col("bucket")).mapInArrow(tidy(_totals), "bucket int, pairs binary, n binary"))
    sums = X.table(sums)
    top = {r["b"]: r["n"] for r in sums.select("pairs", "n").mapInArrow(_highest, "b long, n long").groupBy("b")
           .agg(F.max("n").alias("n")).collect()}  # one row per id of B's vocabulary at most
    asks = slices.select("slice", "pairs").mapInArrow(tidy(_asked(n)), "bucket int, slice long, pairs binary")
    meet = (sums.select("bucket", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("slice"), "pairs", "n")
            .unionByName(asks.select("bucket", F.lit(1).alias("kind"), "slice", "pairs",
                                     F.lit(None).cast("binary").alias("n"))))
    replies = (meet.repartitionById(n, F.col("bucket")).sortWithinPartitions("kind")
               .mapInArrow(tidy(_answers), "slice long, bucket int, n binary"))
    home = (slices.drop("n").withColumn("kind", F.lit(0)).withColumn("bucket", F.lit(None).cast("int"))
            .withColumn("reply", F.lit(None).cast("binary"))
            .unionByName(replies.select("slice", "bucket", F.col("n").alias("reply"), F.lit(1).alias("kind")),
                         allowMissingColumns=True))
    return (home.repartition(n, "slice").sortWithinPartitions("slice", "kind")
            .mapInArrow(tidy(_counted(top, n)), COUNTED))

"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1; for each bit a binary classifier on
hashed byte trigrams (log-odds of the languages on either side, each language
with the same weight) says to which side a text belongs, and how clearly. A text
gets the language whose codeword has the smallest sum of logistic losses over
the bits, so that a bit counts by its margin. Where the second-best codeword is
about as near, the text is flagged as ambiguous.

Up to six languages use the exhaustive code (all ways to split them in two); more
use the best of many random codes. Counts come from a bounded sample per language.

Defined results: a null text or one without a letter is ``und`` with score 0; so
is every text if there is nothing to learn from. Repeated rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.arrays import ROW_BYTES, release, slices, tidy, utf8

SAMPLE = 1500  # documents learned from per language, those with the smallest hashes of doc_id
FEATURES = 1 << 16
GAIN = 6.0  # how much a mean log-odds of a trigram counts in the loss
CLOSE = 0.05  # mean loss per bit by which the second-best codeword must be worse
UNKNOWN = "und"

_FOLD = np.zeros(256, dtype=np.uint8)  # what is no letter becomes 0
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigrams(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of folded bytes, and each text's range of them. Texts get a space at either end."""
    n = len(off) - 1
    size = np.diff(off)
    b = np.zeros(len(data) + 2 * n, dtype=np.uint32)
    place = np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, size)
    folded = _FOLD[data]
    upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0x9F) & (data[1:] != 0x97)) + 1
    folded[upper] += 0x20  # capitals U+00C0 to U+00DE
    b[place] = folded
    grams = b[:-2] << 16 | b[1:-1] << 8 | b[2:] if len(b) > 2 else np.zeros(0, dtype=np.uint32)
    start = off[:-1] + 2 * np.arange(n)
    good = grams != 0
    crossing = (start[1:, None] - np.array([2, 1])).ravel()
    good[crossing[(crossing >= 0) & (crossing < len(grams))]] = False
    index = ((grams * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    at = np.zeros(len(grams) + 1, dtype=np.int64)
    np.cumsum(good, out=at[1:])
    ends = np.minimum(off[1:] + 2 * np.arange(1, n + 1), len(grams))
    return index[good], np.r_[0, at[ends]] if n else np.zeros(1, dtype=np.int64)


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """A code of n words (rows) of +1 and -1."""
    if n < 2:
        return np.zeros((n, 0), dtype=np.int8)
    if n <= 6:
        bits = [[1 if k == 0 or not s >> (k - 1) & 1 else -1 for k in range(n)] for s in range(1, 1 << (n - 1))]
        return np.array(bits, dtype=np.int8).T
    rng = np.random.default_rng(seed)
    length = int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, length))
        code = code[:, np.abs(code.sum(axis=1 - 1)) < n]  # a bit must split the languages
        distance = (code[:, None, :] != code[None, :, :]).sum(axis=2)
        d = int(distance[~np.eye(n, dtype=bool)].min())
        if d > apart:
            best, apart = code, d
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # bits x FEATURES: log-odds of a trigram between the two sides

    def decode(self, off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: best language (-1: none), score from 0 to 1, margin to the second best."""
        n, k = len(off) - 1, len(self.languages)
        if not k:
            return np.full(n, -1), np.zeros(n), np.zeros(n)
        index, at = trigrams(off, data)
        many = np.diff(at)
        value = np.zeros((n, self.code.shape[1]))
        some = np.flatnonzero(many)
        for bit, w in enumerate(self.weights):
            value[some, bit] = np.add.reduceat(w[index], at[:-1][some]) if len(some) else 0
        value /= np.maximum(many, 1)[:, None]
        loss = np.logaddexp(0, -GAIN * value[:, None, :] * self.code[None, :, :]).sum(axis=2)
        order = np.argsort(loss, axis=1, kind="stable")
        best = order[:, 0]
        nearest = loss[np.arange(n), best]
        second = loss[np.arange(n), order[:, 1]] if k > 1 else np.full(n, np.inf)
        score = 1 / np.exp(nearest[:, None] - loss).sum(axis=1)
        margin = (second - nearest) / max(self.code.shape[1], 1)
        return best, score, margin


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``docs`` (doc_id, text, lang): at most ``sample`` documents of each non-null language."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("doc_id"))
    # the part of the hashes that holds a language's sample, from counts by their first ten bits; only rows in it are
    # numbered, so a large language is not one task's
    keys = rows.select("lang", "h", "doc_id", F.shiftright("h", 54).alias("part"))
    upto = Window.partitionBy("lang").orderBy("part")  # 1024 rows a language at most
    parts = keys.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.sum("n").over(upto) - F.col("n"))
    last = parts.filter(F.col("before") < sample).groupBy("lang").agg(F.max("part").alias("last"))
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    limits = (keys.join(F.broadcast(last), "lang").filter("part <= last")  # one row a language
              .withColumn("r", F.row_number().over(first)).filter(F.col("r") <= sample)
              .groupBy("lang").agg(F.max("h").alias("limit")).collect())  # one row a language
    if not limits:
        return Model([], codewords(0), np.zeros((0, FEATURES), dtype=np.float32))
    limit = docs.sparkSession.createDataFrame([(r["lang"], r["limit"]) for r in limits], "lang string, limit long")
    chosen = rows.join(F.broadcast(limit), "lang").filter("h <= limit").select("lang", "text")
    found = (chosen.mapInArrow(tidy(_counts), "lang string, feature int, n long").groupBy("lang", "feature")
             .agg(F.sum("n").alias("n")).toArrow())  # at most FEATURES rows a language
    languages = sorted({r["lang"] for r in limits})
    number = {x: k for k, x in enumerate(languages)}
    table = np.full((len(languages), FEATURES), 0.5)
    which = np.array([number[x] for x in found.column("lang").to_pylist()], dtype=np.int64)
    np.add.at(table, (which, found.column("feature").to_numpy()), found.column("n").to_numpy())
    share = table / table.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    weights = [np.log(share[bit > 0].mean(axis=0)) - np.log(share[bit < 0].mean(axis=0)) for bit in code.T]
    return Model(languages, code, np.array(weights, dtype=np.float32).reshape(code.shape[1], FEATURES))


def _counts(batches):
    total: dict[str, np.ndarray] = {}
    for part in slices(batches, size=ROW_BYTES):
        languages = np.array(part.column(0).to_pylist(), dtype=object)
        off, data = utf8(part.column(1))
        index, at = trigrams(off, data)
        of = np.repeat(np.arange(len(languages)), np.diff(at))
        for language in set(languages.tolist()):
            mine = (languages == language)[of]
            total.setdefault(language, np.zeros(FEATURES, dtype=np.int64))
            total[language] += np.bincount(index[mine], minlength=FEATURES)
    for language, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([language] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                          pa.array(n[at])], names=["lang", "feature", "n"])


def predict(docs: DataFrame, model: Model, name: str = "language") -> DataFrame:
    """``docs`` with a struct ``name`` from its column ``text``: lang_pred, score, margin, ambiguous."""
    @F.arrow_udf("best int, score double, margin double")
    def run(column: pa.Array) -> pa.Array:
        rows = slices([pa.RecordBatch.from_arrays([column], names=["text"])], size=ROW_BYTES)
        parts = [model.decode(*utf8(p.column(0))) for p in rows]
        best, score, margin = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in range(3))
        release()
        return pa.StructArray.from_arrays([pa.array(best.astype(np.int32)), pa.array(score.astype(float)),
                                           pa.array(margin.astype(float))], names=["best", "score", "margin"])
    run = run.asNondeterministic()  # or a filter on the result would decode each text a second time
    text = docs["text"].cast("string")
    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    languages = F.array(*[F.lit(x) for x in model.languages]) if model.languages else F.array().cast("array<string>")
    raw = docs.withColumn(name, F.struct(run(text).alias("found"), lettered.alias("lettered")))
    found = F.col(name)["found"]
    known = F.col(name)["lettered"] & (found["best"] >= 0)
    return raw.withColumn(name, F.struct(
        F.when(known, F.get(languages, found["best"])).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, found["score"]).otherwise(0.0).alias("score"),
        F.when(known, found["margin"]).otherwise(0.0).alias("margin"),
        F.coalesce(known & (found["margin"] < CLOSE), F.lit(False)).alias("ambiguous")))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0

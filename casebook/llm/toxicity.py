"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

Every text gets some dense features: densities of lexicon words (a given list,
and words learned from labelled texts), how many of them stand near a
second-person pronoun, how thickly they stand at their densest, capitals, runs
and rates of punctuation, words with digits or signs between letters, and lexicon
words that show only after such signs are read as letters. Shallow trees are
boosted on these with the logistic loss. A margin becomes a score by isotonic
regression (pool adjacent violators) on margins from trees that have not seen the
text: the labelled texts are dealt into folds by a hash of the text, so that
copies stay together.

Trees, lexicon and calibration come from at most ``SAMPLE`` labelled texts; every
text is scored whole.

Defined results: a null or empty text has features of 0 and the score of such;
without labelled rows all scores are 0, with labels of one kind only the share of
that kind. Of several labels of a document the smallest counts, of repeated doc_ids all texts. Repeated
rows get equal scores. A column ``toxicity`` of the table is replaced; others stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.arrays import ROW_BYTES, Runs, byte_runs, release, slices, utf8, words

SAMPLE = 6000  # labelled documents, those with the smallest hashes of doc_id
THRESHOLD = 0.7
TREES, DEPTH, BINS, STEP, RIDGE, LEAST = 80, 3, 32, 0.1, 1.0, 1.0
FOLDS = 5
NEAR = 5  # words between a lexicon word and a pronoun
WINDOW = 40  # words over which the densest place is measured
LEARNED, MIN_TEXTS, MIN_ODDS = 200, 8, 4.0  # learned words: most, least toxic texts with it, least log-odds

# Insults of four languages (folded to lower case).
LEXICON = """
idiot idiots moron morons stupid dumb dumbass fool fools loser losers scum trash garbage clown clowns pathetic worthless
disgusting imbecile cretin jerk creep pig pigs filth vermin bastard bastards bitch bitches asshole assholes shit shitty
fuck fucking fucked fucker whore slut retard retarded crap damn
idioten dumm dumme dummkopf trottel blöd blöder blödmann arsch arschloch scheisse scheiße depp abschaum versager
widerlich ekelhaft wertlos erbärmlich hure schlampe mistkerl
imbécile crétin crétine connard connards connasse salaud salope merde débile ordure minable dégueulasse putain abruti
idiota idiotas imbécil estúpido estúpida tonto tonta basura escoria cabrón gilipollas mierda puta puto asqueroso
asquerosa patético patética inútil perdedor payaso
""".split()
# Second-person pronouns of the same languages.
PRONOUNS = """you your yours yourself ur u du dich dir dein deine deinen deiner ihr euch euer tu toi te ton ta tes vous
votre vos tú ti tus usted ustedes vosotros vuestro""".split()
# Signs that stand for letters.
READ_AS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "+": "t"}

_FOLD = np.zeros(256, dtype=np.uint8)  # what is no letter becomes 0
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_SIGNS = _FOLD.copy()
_SIGNS[[ord(k) for k in READ_AS]] = [ord(v) for v in READ_AS.values()]
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[65:91] = True
NAMES = ("given", "given_most", "learned", "learned_most", "hits", "near_pronoun", "pronouns", "capital_letters",
         "capital_words", "marks", "mark_runs", "signs", "mixed_words", "hidden", "stretched")


def _folded(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = table[data]
    upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0x9F) & (data[1:] != 0x97)) + 1
    out[upper] += 0x20  # capitals U+00C0 to U+00DE
    return out


def _forms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word's letters under ``table`` (0: left out), and their number of bytes."""
    folded = _folded(data, table)
    keep = folded > 0
    at = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(keep, out=at[1:])
    lo, hi = at[starts], at[ends]
    return byte_runs(folded[keep])(lo, hi), hi - lo


def word_hashes(listed: list[str]) -> np.ndarray:
    if not listed:
        return np.zeros(0, dtype=np.uint64)
    raw = [w.encode() for w in listed]
    off = np.r_[0, np.cumsum([len(w) for w in raw])]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return np.unique(_forms(data, off[:-1], off[1:], _FOLD)[0])


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), dtype=bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def _sums(mask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def features(off: np.ndarray, data: np.ndarray, learned: np.ndarray, given: np.ndarray, you: np.ndarray) -> np.ndarray:
    """NAMES of each text (n x 15): rates per word or letter, and numbers on a logarithmic scale."""
    n = len(off) - 1
    starts, ends, by = words(off, data)
    doc = np.repeat(np.arange(n), np.diff(by))
    total = np.maximum(np.diff(by), 1)
    plain, length = _forms(data, starts, ends, _FOLD)
    letters = length > 0
    read, _ = _forms(data, starts, ends, _SIGNS)
    from_list, from_labels, pronoun = (_among(plain, k) & letters for k in (given, learned, you))
    sign = (data > 32) & (_FOLD[data] == 0)
    mixed = np.zeros(len(starts), dtype=bool)  # a digit or sign between two letters
    inner = np.flatnonzero(sign[1:-1] & (_FOLD[data[:-2]] > 0)) + 1 if len(data) > 2 else np.zeros(0, dtype=np.int64)
    w = np.searchsorted(starts, inner, side="right") - 1
    inside = (w >= 0) & (inner < ends[w] - 1) if len(starts) else np.zeros(0, dtype=bool)
    mixed[w[inside]] = True
    both = np.union1d(given, learned)
    hidden = letters & mixed & (_among(read, both) | from_list | from_labels)
    hit = from_list | from_labels | hidden
    # words to the nearest pronoun of the same text, on either side
    place = np.flatnonzero(pronoun)
    at = np.flatnonzero(hit)
    near = np.zeros(len(at), dtype=bool)
    if len(place):
        k = np.searchsorted(place, at)
        for side in (np.minimum(k, len(place) - 1), np.maximum(k - 1, 0)):
            near |= (np.abs(place[side] - at) <= NEAR) & (doc[place[side]] == doc[at])
    capital = _sums(_CAPITAL[data])
    capitals = capital[ends] - capital[starts]
    shouted = (capitals >= 2) & (capitals == length)
    mark = (data == 33) | (data == 63)
    run = np.zeros(len(data), dtype=bool)
    run[1:] = mark[1:] & mark[:-1]
    same = np.zeros(len(data), dtype=bool)  # third equal letter in a row
    same[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & (_FOLD[data[2:]] > 0) & (data[2:] < 128)

    def per_word(mask):
        return np.bincount(doc[mask], minlength=n) / total

    def thickest(mask):
        """Most such words in WINDOW consecutive words of the text."""
        s = _sums(mask)
        here = np.flatnonzero(mask)
        out = np.zeros(n)
        np.maximum.at(out, doc[here], s[np.minimum(here + WINDOW, by[doc[here] + 1])] - s[here])
        return out

    def per_byte(mask):
        s = _sums(mask)
        return (s[off[1:]] - s[off[:-1]]) / total

    size = np.maximum(np.bincount(doc, length, n), 1) if len(doc) else np.ones(n)
    return np.stack([
        per_word(from_list), thickest(from_list), per_word(from_labels), thickest(from_labels),
        np.log1p(np.bincount(doc[hit], minlength=n)), np.log1p(np.bincount(doc[at[near]], minlength=n)), per_word(pronoun),
        (capital[off[1:]] - capital[off[:-1]]) / size, per_word(shouted), per_byte(mark), per_byte(run), per_byte(sign),
        per_word(mixed), np.log1p(np.bincount(doc[hidden], minlength=n)), per_byte(same)], axis=1)


@dataclass
class Trees:
    """Complete trees as arrays: inner nodes in heap order (feature, cut), leaf values; ``base`` is the first margin."""
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.cut[trees, node])
        return self.base + self.leaf[trees, node - (2 ** DEPTH - 1)].sum(axis=1)


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order boosting on histograms, level by level."""
    n, f = x.shape
    cuts = []
    for k in range(f):
        values = np.unique(x[:, k])
        if len(values) > BINS:
            values = np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS), method="nearest"))
        cuts.append(np.r_[(values[1:] + values[:-1]) / 2, np.full(BINS - len(values), np.inf)])
    cuts = np.array(cuts)  # f x (BINS - 1)
    code = np.stack([np.searchsorted(cuts[k], x[:, k]) for k in range(f)], axis=1)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    feature, cut, leaf = np.zeros((TREES, inner), dtype=np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, leaves))
    column = np.arange(f) * BINS
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for d in range(DEPTH):
            m, first = 2 ** d, 2 ** d - 1
            key = ((node - first)[:, None] * (f * BINS) + column[None, :] + code).ravel()
            left = [np.cumsum(np.bincount(key, np.repeat(w, f), m * f * BINS).reshape(m, f, BINS), axis=2) for w in (g, h)]
            (gl, hl), (gt, ht) = left, (v[:, :, -1:] for v in left)
            gain = gl ** 2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt ** 2 / (ht + RIDGE)
            gain[(hl < LEAST) | (ht - hl < LEAST)] = 0
            gain = gain[:, :, :-1].reshape(m, -1)
            best = np.argmax(gain, axis=1)
            good = gain[np.arange(m), best] > 1e-9
            which, b = best // (BINS - 1), best % (BINS - 1)
            feature[t, first:first + m] = np.where(good, which, 0)
            cut[t, first:first + m] = np.where(good, cuts[which, b], np.inf)
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > cut[t, node])
        at = node - inner
        leaf[t] = -STEP * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + RIDGE)
        margin += leaf[t][at]
    return Trees(feature, cut, leaf, base)


def isotonic(m: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising levels and the margins that they belong to (a block's mean margin)."""
    values, at, n = np.unique(m, return_inverse=True, return_counts=True)  # equal margins are one from the start
    blocks: list[list[float]] = []  # weight, sum of labels, sum of margins
    for w, label, v in zip(n.tolist(), np.bincount(at, y).tolist(), (values * n).tolist(), strict=True):
        blocks.append([float(w), label, v])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last, strict=True)]
    levels = np.array([b[1] / b[0] for b in blocks])
    return np.array([b[2] / b[0] for b in blocks]), levels


@dataclass
class Model:
    trees: Trees | None
    learned: np.ndarray
    at: np.ndarray  # margins and levels of the calibration
    level: np.ndarray
    given: np.ndarray
    you: np.ndarray

    def scores(self, off: np.ndarray, data: np.ndarray) -> np.ndarray:
        n = len(off) - 1
        if self.trees is None:
            return np.full(n, float(self.level[0]) if len(self.level) else 0.0)
        x = features(off, data, self.learned, self.given, self.you)
        return np.clip(np.interp(self.trees.margins(x), self.at, self.level), 0, 1)


def _word_sets(batches):
    """The distinct words (hashes) of every text with its label."""
    for part in slices(batches, column="text", size=ROW_BYTES):
        off, data = utf8(part.column(part.schema.get_field_index("text")))
        starts, ends, by = words(off, data)
        plain, length = _forms(data, starts, ends, _FOLD)
        toxic = part.column(part.schema.get_field_index("toxic")).to_numpy(zero_copy_only=False)
        found, bad = [], []
        for k in range(len(toxic)):
            own = np.unique(plain[by[k]:by[k + 1]][length[by[k]:by[k + 1]] > 2])
            found.append(own), bad.append(np.full(len(own), toxic[k], dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(bad))],
                                         names=["word", "toxic"])
    release()


def learned_words(rows: DataFrame, n_toxic: int, n_clean: int) -> np.ndarray:
    """Hashes of words in at least MIN_TEXTS different toxic texts whose log-odds pass MIN_ODDS; at most LEARNED."""
    counts = (rows.select("text", "toxic").mapInArrow(_word_sets, "word long, toxic long").groupBy("word")
              .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")))
    odds = F.log((F.col("bad") + 0.5) / (n_toxic + 1)) - F.log((F.col("good") + 0.5) / (n_clean + 1))
    top = counts.filter(F.col("bad") >= MIN_TEXTS).withColumn("odds", odds).filter(F.col("odds") >= MIN_ODDS)
    got = top.orderBy(F.desc("odds"), F.desc("bad"), "word").limit(LEARNED).collect()
    return np.unique(np.array([r["word"] for r in got], dtype=np.int64).view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lexicon: list[str] = LEXICON,
        pronouns: list[str] = PRONOUNS) -> Model:
    """From at most ``sample`` labelled documents; ``docs`` (doc_id, text) holds the rows that may be learned from,
    ``labels`` is (doc_id, toxic 0 or 1)."""
    given, you = word_hashes(lexicon), word_hashes(pronouns)
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("toxic").cast("int").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # ids of labelled rows that may be learned from: 16 bytes a row, so a bounded broadcast
    chosen = (texts.select("doc_id").join(marked, "doc_id", "left_semi").distinct().join(marked, "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    # copies of one text are one text, or the lexicon would learn the words of much-copied ones
    rows = rows.groupBy("text").agg(F.max("toxic").alias("toxic")).persist()
    try:
        n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
        bad, good = n.get(1, 0), n.get(0, 0)
        if not bad or not good:
            none = np.zeros(0)
            return Model(None, none.astype(np.uint64), none, np.array([1.0] if bad else [0.0] if good else []), given, you)
        learned = learned_words(rows, bad, good)

        @F.arrow_udf("array<double>")
        def dense(column: pa.Array) -> pa.Array:
            parts = [features(*utf8(p.column(0)), learned, given, you) for p in _parts(column)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES)), pa.array(x.ravel()))

        got = rows.select(F.xxhash64("text").alias("h"), "toxic", dense(F.coalesce("text", F.lit(""))).alias("x")).toArrow()
    finally:
        rows.unpersist()
    h, y = got.column("h").to_numpy(), got.column("toxic").to_numpy().astype(float)
    x = np.array(got.column("x").to_pylist()).reshape(len(h), len(NAMES))
    order = np.lexsort((*x.T, y, h))
    h, x, y = h[order], x[order], y[order]
    part = (h % FOLDS + FOLDS) % FOLDS
    unseen = np.zeros(len(y))
    for k in range(FOLDS):
        rest = part != k
        if not rest.all() and rest.any():
            unseen[~rest] = boost(x[rest], y[rest]).margins(x[~rest])
    at, level = isotonic(unseen, y)
    return Model(boost(x, y), learned, at, level, given, you)


def _parts(column: pa.Array):
    return slices([pa.RecordBatch.from_arrays([column], names=["text"])], size=ROW_BYTES)


def score(docs: DataFrame, model: Model, name: str = "toxicity", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the struct ``name`` of score and predicted (1 from ``threshold`` up) of its column ``text``."""
    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        parts = [model.scores(*utf8(p.column(0))) for p in _parts(column)]
        release()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))
    scored = docs.withColumn(name, run(F.coalesce(docs["text"].cast("string"), F.lit(""))))
    return scored.withColumn(name, F.struct(F.col(name).alias("score"), (F.col(name) >= threshold).cast("int").alias("predicted")))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))

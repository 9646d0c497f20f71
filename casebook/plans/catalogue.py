"""Query catalogue: each entry maps testdata onto one library operator.

Every query reads whole tables (no id subsets) and returns a DataFrame; the
matching oracle SQL (DuckDB dialect, same column names) sits next to it.
Floating results are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions import exprs as X
from casebook.operators import bovw, cluster, graph, model, policy, prep, profile, stats
from casebook.session import reuse
from casebook.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# Fixed value: two-sided 95% normal quantile, as a literal for the oracle.
Z95 = "1.959963984540054"


# ------------------------------------------------------------- A/B shares
def _mobile_events(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(F.col("event_type").alias("type"),
                     (F.col("user_id") % 2 == 0).cast("int").alias("from_mobile"))


@register("ab_shares", f"""
SELECT type, n, m, round(p, 6) AS p, round(se, 6) AS se,
       round(p - {Z95} * se, 6) AS lo, round(p + {Z95} * se, 6) AS hi
FROM (SELECT type, n, m, p, sqrt(p * (1 - p) / n) AS se
      FROM (SELECT event_type AS type, count(*) AS n,
                   CAST(sum(CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS m,
                   avg(CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END) AS p
            FROM events GROUP BY event_type) g) s
""")
def q_ab_shares(spark, sf):
    return stats.share_interval(_mobile_events(spark, sf), "type", "from_mobile", 0.95)


@register("ab_ztest", """
WITH g AS (SELECT event_type AS type, count(*) AS n,
                  CAST(sum(CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS m
           FROM events GROUP BY event_type),
     c AS (SELECT n, m FROM g WHERE type = 'click'),
     z AS (SELECT g.type, g.n, g.m, c.n AS n0, c.m AS m0,
                  abs((g.m / g.n - c.m / c.n) /
                      sqrt(((g.m + c.m) / (g.n + c.n)) * (1 - (g.m + c.m) / (g.n + c.n))
                           * (g.n + c.n) / (g.n * c.n))) AS z
           FROM g, c WHERE g.type <> 'click')
SELECT 'click' AS control, type AS treatment, n AS n_treatment, m AS m_treatment,
       n0 AS n_control, m0 AS m_control, round(z, 6) AS z, z < 1.6449 AS equal_shares
FROM z
""")
def q_ab_ztest(spark, sf):
    return stats.two_share_ztest(_mobile_events(spark, sf), "type", "from_mobile",
                                 control="click")


# ------------------------------------------------------ union, dedup, split
def _rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


@register("union_dedup", """
WITH u AS (
  SELECT o_orderkey AS id, o_totalprice AS x, o_orderpriority AS priority,
         'train' AS split, 0 AS r FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT o_orderkey AS id, o_totalprice AS x, NULL AS priority,
         'test' AS split, 1 AS r FROM orders WHERE o_orderstatus <> 'F')
SELECT id, split, x, priority
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY r) AS rn FROM u) t
WHERE rn = 1
""")
def q_union_dedup(spark, sf):
    o = table(spark, sf, "orders")
    train = o.filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("x"),
        F.col("o_orderpriority").alias("priority"))
    test = o.filter(F.col("o_orderstatus") != "F").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("x"))
    return prep.union_first_wins([("train", train), ("test", test)], key="id")


@register("prep_split", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'F'
""")
def q_prep_split(spark, sf):
    return prep.take_split(table(spark, sf, "orders"), "o_orderstatus", "F")


# --------------------------------------------------------------- profiling
_LI_NULLED = {
    "l_discount": "nullif(l_discount, 0)",
    "l_tax": "nullif(l_tax, 0)",
    "l_returnflag": "nullif(l_returnflag, 'N')",
}
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            "l_shipdate"]


def _nulled_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*[F.expr(_LI_NULLED[c]).alias(c) if c in _LI_NULLED else F.col(c)
                       for c in _LI_COLS])


register("null_profile", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count,
       sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) = 0 AS kept
FROM (SELECT {_LI_NULLED.get(c, c)} AS v FROM lineitem) t""" for c in _LI_COLS))(
    lambda spark, sf: profile.null_counts(_nulled_lineitem(spark, sf)))


@register("auto_prep", """
WITH src AS (SELECT p_partkey AS id, CASE WHEN p_size = 1 THEN NULL ELSE p_name END AS p_name,
                    p_brand, p_type, p_size, p_retailprice, 1 AS p_const FROM part),
st AS (SELECT min(p_size) AS lo1, max(p_size) AS hi1,
              min(p_retailprice) AS lo2, max(p_retailprice) AS hi2 FROM src),
long AS (
  SELECT id, 'p_size' AS feature, (p_size - lo1) / (hi1 - lo1) AS value FROM src, st
  UNION ALL SELECT id, 'p_retailprice', (p_retailprice - lo2) / (hi2 - lo2) FROM src, st
  UNION ALL SELECT id, 'p_brand_' || p_brand, 1.0 FROM src
  UNION ALL SELECT id, 'p_type_' || p_type, 1.0 FROM src)
SELECT id, feature, round(value, 6) AS value FROM long WHERE value <> 0
""")
def q_auto_prep(spark, sf):
    p = table(spark, sf, "part")
    src = p.select(F.col("p_partkey").alias("id"),
                   F.when(F.col("p_size") == 1, F.lit(None)).otherwise(F.col("p_name")).alias("p_name"),
                   "p_brand", "p_type", "p_size", "p_retailprice", F.lit(1).alias("p_const"))
    return prep.auto_prepare_long(src, id_col="id").withColumn("value", F.round("value", 6))


_DV_COLS = ["p_brand", "p_type", "p_size"]


register("distinct_values", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM part GROUP BY {c}"""
    for c in _DV_COLS))(
    lambda spark, sf: profile.distinct_values(table(spark, sf, "part"), _DV_COLS))

_CARD_COLS = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]

register("cardinality", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM orders"""
    for c in _CARD_COLS))(
    lambda spark, sf: profile.cardinality(table(spark, sf, "orders"), _CARD_COLS))


@register("mode_fill", """
WITH src AS (SELECT p_partkey, CASE WHEN p_size = 1 THEN NULL ELSE p_brand END AS p_brand FROM part),
m AS (SELECT p_brand AS mode FROM src WHERE p_brand IS NOT NULL
      GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 1)
SELECT p_partkey, coalesce(p_brand, (SELECT mode FROM m)) AS p_brand FROM src
""")
def q_mode_fill(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") == 1, F.lit(None)).otherwise(F.col("p_brand")).alias("p_brand"))
    return profile.fill_with_mode(p, ["p_brand"])


# ----------------------------------------------------------------- scaling
_NUM4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("minmax_scale", f"""
WITH st AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _NUM4)}
            FROM lineitem WHERE l_linestatus = 'F')
SELECT l_orderkey, l_linenumber,
  {", ".join(f"round(CASE WHEN hi_{c} = lo_{c} THEN 0 ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END, 6) AS {c}" for c in _NUM4)}
FROM lineitem, st
""")
def q_minmax_scale(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", *_NUM4)
    out = prep.minmax_scale(li, _NUM4, fit_on=li.filter(F.col("l_linestatus") == "F"))
    return _rounded(out.drop("l_linestatus"), _NUM4)


@register("maxabs_scale", f"""
WITH st AS (SELECT {", ".join(f"max(abs({c})) AS m_{c}" for c in _NUM4)} FROM lineitem)
SELECT l_orderkey, l_linenumber,
  {", ".join(f"round(CASE WHEN m_{c} = 0 THEN {c} ELSE {c} / m_{c} END, 6) AS {c}" for c in _NUM4)}
FROM lineitem, st
""")
def q_maxabs_scale(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_NUM4)
    return _rounded(prep.maxabs_scale(li, _NUM4), _NUM4)


register("corr_matrix", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a in _NUM4 for b in _NUM4))(
    lambda spark, sf: profile.correlation(table(spark, sf, "lineitem"), _NUM4))

_BIN3 = ["l_quantity", "l_discount", "l_tax"]


def _bin_sql(c):
    return (f"CASE WHEN hi_{c} = lo_{c} THEN 1 ELSE "
            f"least(CAST(floor(({c} - lo_{c}) / (hi_{c} - lo_{c}) * 10) AS INTEGER) + 1, 10) END")


register("pair_bins", f"""
WITH st AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _BIN3)} FROM lineitem),
b AS (SELECT {", ".join(f"{_bin_sql(c)} AS {c}" for c in _BIN3)} FROM lineitem, st)
""" + "\nUNION ALL\n".join(
    f"SELECT '{x}' AS x, '{y}' AS y, {x} AS bin_x, {y} AS bin_y, count(*) AS n FROM b GROUP BY {x}, {y}"
    for i, x in enumerate(_BIN3) for y in _BIN3[i + 1:]))(
    lambda spark, sf: profile.pair_bins(table(spark, sf, "lineitem"), _BIN3, bins=10))


@register("one_hot", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS l_returnflag_A,
  CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS l_returnflag_N,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS l_returnflag_R,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS l_linestatus_F,
  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS l_linestatus_O
FROM lineitem
""")
def q_one_hot(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return prep.one_hot(li, ["l_returnflag", "l_linestatus"])


@register("label_join", """
SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""")
def q_label_join(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(table(spark, sf, "labels"), on="doc_id", how="inner")


# ------------------------------------------------------------ visual words
# Testdata mapping: every embedding is one descriptor; image = vec_id div 10;
# the codebook is the centroid of each label (a nearest-centroid codebook
# derived from the whole table).
_DIM = 64


def _descriptors(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select(F.expr("vec_id div 10").alias("image"), "vec_id", "label",
                    X.to_double_array("embedding").alias("descriptor"))


def _features(spark, sf):
    d = _descriptors(spark, sf).withColumn("pos", F.col("vec_id"))
    return bovw.collect_features(d, "image", "pos", "descriptor")


def _codebook(spark, sf):
    return bovw.codebook_from_groups(_descriptors(spark, sf), "label")


def _round_arr(c, digits=6):
    return F.transform(F.col(c), lambda x: F.round(x, digits))


_DUCK_DESC = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"
_DUCK_CODEBOOK = f"""codebook AS (
  SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS centre_id,
         [{", ".join(f"m{i}" for i in range(_DIM))}] AS centre
  FROM (SELECT label, {", ".join(f"avg(CAST(embedding[{i + 1}] AS DOUBLE)) AS m{i}" for i in range(_DIM))}
        FROM embeddings GROUP BY label) g)"""
_DUCK_ASSIGN = f"""{_DUCK_CODEBOOK},
d AS (SELECT vec_id, vec_id // 10 AS image,
             list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
dist AS (SELECT d.vec_id, d.image, c.centre_id,
                sqrt(list_sum(list_transform(range(1, {_DIM} + 1), lambda i: (d.e[i] - c.centre[i]) * (d.e[i] - c.centre[i])))) AS dist
         FROM d, codebook c),
assigned AS (SELECT vec_id, image, centre_id AS word, dist
             FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, centre_id) AS rn FROM dist) t
             WHERE rn = 1)"""


@register("bovw_explode", """
SELECT vec_id // 10 AS image,
       CAST(row_number() OVER (PARTITION BY vec_id // 10 ORDER BY vec_id) - 1 AS INTEGER) AS pos,
       list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 6)) AS descriptor
FROM embeddings
""")
def q_bovw_explode(spark, sf):
    ex = bovw.explode_descriptors(_features(spark, sf), "image", "features")
    return ex.withColumn("descriptor", _round_arr("descriptor"))


@register("bovw_codebook", f"""
WITH {_DUCK_CODEBOOK}
SELECT centre_id, list_transform(centre, lambda x: round(x, 6)) AS centre FROM codebook
""")
def q_bovw_codebook(spark, sf):
    return _codebook(spark, sf).select("centre_id", _round_arr("centre").alias("centre"))


@register("bovw_assign", f"""
WITH {_DUCK_ASSIGN}
SELECT vec_id, image, word, round(dist, 6) AS dist FROM assigned
""")
def q_bovw_assign(spark, sf):
    a = bovw.assign(_descriptors(spark, sf).select("vec_id", "image", "descriptor"),
                    _codebook(spark, sf))
    return a.select("vec_id", "image", "word", F.round("dist", 6).alias("dist"))


def _index(spark, sf):
    cb = reuse(_codebook(spark, sf))
    k = cb.count()
    a = bovw.assign(_descriptors(spark, sf).select("vec_id", "image", "descriptor"), cb)
    # the index is read twice by a search (query histogram, then scoring)
    return reuse(bovw.histogram(a, int(k), "image", "word"))


def _duck_hist(k):
    return f"""{_DUCK_ASSIGN},
hist AS (SELECT image, count(*) AS n_desc,
                [{", ".join(f"CAST(sum(CASE WHEN word = {i} THEN 1 ELSE 0 END) AS DOUBLE)" for i in range(k))}] AS hist
         FROM assigned GROUP BY image)"""


# k = number of labels in the sf0.01 embeddings table (the oracle scale)
_K_ORACLE = 10


@register("bovw_hist", f"""
WITH {_duck_hist(_K_ORACLE)}
SELECT image, n_desc, hist FROM hist
""")
def q_bovw_hist(spark, sf):
    return _index(spark, sf)


@register("bovw_search", f"""
WITH {_duck_hist(_K_ORACLE)},
q AS (SELECT hist AS qh FROM hist WHERE image = 0),
scored AS (SELECT image,
                  round(list_sum(list_transform(range(1, {_K_ORACLE} + 1),
                        lambda i: (hist[i] - qh[i]) * (hist[i] - qh[i]) / (hist[i] + qh[i] + 1e-10))), 6) AS distance
           FROM hist, q)
SELECT CAST(0 AS BIGINT) AS query, image, distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT image, distance, row_number() OVER (ORDER BY distance, image) AS rank FROM scored) t
WHERE rank <= 20
""")
def q_bovw_search(spark, sf):
    index = _index(spark, sf)
    query = index.filter(F.col("image") == 0)
    return bovw.search(index, query, k=20, query_id=0).withColumn("query", F.col("query").cast("long"))


_TRAINED_K, _STARTS = 8, 10


# Facts that hold for k-means run to its end from any start: each centre is the mean of its own descriptors, none of
# which is nearer to another centre, and no start costs less than the winner.
@register("bovw_trained", f"""
SELECT count(*) AS descriptors, CAST({_TRAINED_K} AS BIGINT) AS centres, CAST({_STARTS} AS BIGINT) AS starts,
       CAST(0 AS BIGINT) AS nearer_elsewhere, 0.0::DOUBLE AS off_mean, CAST(0 AS BIGINT) AS cheaper_starts,
       true AS cost_holds
FROM embeddings
""")
def q_bovw_trained(spark, sf):
    d = _descriptors(spark, sf).select("vec_id", X.to_double_array("descriptor").alias("d"))
    codebook, starts = bovw.train_codebooks(d, _TRAINED_K, restarts=_STARTS, max_iter=200, tol=0.0, descriptor="d")
    won = starts.filter("best").first()
    cheaper = starts.filter(F.col("cost") < won["cost"]).count()
    # own and other distances with plain expressions, apart from the trainer's matrix products
    gaps = d.join(F.broadcast(codebook), F.size("d") == F.size("centre"))  # codebook: k rows
    gaps = gaps.select("vec_id", "d", "centre_id", X.euclidean("d", "centre").alias("gap"))
    near = gaps.groupBy("vec_id").agg(F.min(F.struct("gap", "centre_id")).alias("best"), F.first("d").alias("d"))
    word = bovw.assign(d, codebook, descriptor="d").select("vec_id", "word", "dist")
    own = near.join(word, "vec_id")
    part = own.select("word", "dist", (F.col("dist") > F.col("best.gap") + 1e-9).cast("long").alias("worse"),
                      F.posexplode("d").alias("i", "x"))
    mean = part.groupBy("word", "i").agg(F.avg("x").alias("mean"))
    at = codebook.select(F.col("centre_id").alias("word"), F.posexplode("centre").alias("i", "c"))
    off = mean.join(at, ["word", "i"]).agg(F.round(F.max(F.abs(F.col("mean") - F.col("c"))), 6).alias("off_mean"),
                                           F.countDistinct("word").alias("centres"))
    total = own.agg(F.count(F.lit(1)).alias("descriptors"), F.sum((F.col("dist") > F.col("best.gap") + 1e-9).cast("long"))
                    .alias("nearer_elsewhere"), F.sum(F.col("dist") * F.col("dist")).alias("cost"))
    return total.select(
        "descriptors", off.select("centres").scalar().alias("centres"), F.lit(_STARTS).cast("long").alias("starts"),
        "nearer_elsewhere", off.select("off_mean").scalar().alias("off_mean"),
        F.lit(cheaper).cast("long").alias("cheaper_starts"),
        (F.abs(F.col("cost") - F.lit(won["cost"])) <= F.lit(1e-6 * (1 + won["cost"]))).alias("cost_holds"))


_MANY = f"""
WITH {_duck_hist(_K_ORACLE)},
q AS (SELECT image AS query, hist AS qh FROM hist WHERE image % 50 = 0),
scored AS (SELECT query, image,
                  round(list_sum(list_transform(range(1, {_K_ORACLE} + 1),
                        lambda i: (hist[i] - qh[i]) * (hist[i] - qh[i]) / (hist[i] + qh[i] + 1e-10))), 6) AS distance
           FROM hist, q)
SELECT query, image, distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, image) AS rank FROM scored) t
WHERE rank <= 20
"""


@register("bovw_search_many", _MANY)
def q_bovw_search_many(spark, sf):
    index = _index(spark, sf)
    return bovw.search_many(index, index.filter(F.col("image") % 50 == 0), k=20)


@register("bovw_search_lists", _MANY)
def q_bovw_search_lists(spark, sf):
    index = _index(spark, sf)
    return bovw.search_lists(index, index.filter(F.col("image") % 50 == 0), k=20)


# ------------------------------------------------------------ accident graph
# Testdata mapping: every pair of consecutive orders is an accident between
# the two ordering customers (whole orders table).
_DUCK_PAIRS = """pairs AS (SELECT a.o_custkey AS p1, b.o_custkey AS p2
              FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1)"""


def _pairs(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    nxt = o.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("p2"))
    return o.join(nxt, "o_orderkey").select(F.col("o_custkey").alias("p1"), "p2")


@register("graph_degree", f"""
WITH {_DUCK_PAIRS},
ends AS (SELECT p1 AS person FROM pairs UNION ALL SELECT p2 FROM pairs)
SELECT person, count(*) AS accidents FROM ends WHERE person IS NOT NULL
GROUP BY person HAVING count(*) > 3
""")
def q_graph_degree(spark, sf):
    return graph.suspicious(_pairs(spark, sf), "p1", "p2", threshold=3)


@register("graph_repeat_edges", f"""
WITH {_DUCK_PAIRS},
ends AS (SELECT p1 AS person FROM pairs UNION ALL SELECT p2 FROM pairs),
deg AS (SELECT person, count(*) AS d FROM ends GROUP BY person),
e AS (SELECT p1 AS src, p2 AS dst FROM pairs UNION ALL SELECT p2, p1 FROM pairs)
SELECT src, dst, count(*) AS n FROM e
WHERE src IN (SELECT person FROM deg WHERE d >= 2)
GROUP BY src, dst
""")
def q_graph_repeat_edges(spark, sf):
    return graph.repeat_edges(_pairs(spark, sf), "p1", "p2", min_accidents=2)


_CYCLE_MAX = 4


@register("graph_cycles", f"""
WITH RECURSIVE {_DUCK_PAIRS},
s AS (SELECT DISTINCT least(p1, p2) AS u, greatest(p1, p2) AS v FROM pairs WHERE p1 <> p2),
adj AS (SELECT u, v FROM s UNION ALL SELECT v, u FROM s),
paths(st, path, last, len) AS (
  SELECT u, [u, v], v, 1 FROM adj WHERE v > u
  UNION ALL
  SELECT p.st, list_append(p.path, a.v), a.v, p.len + 1
  FROM paths p JOIN adj a ON a.u = p.last
  WHERE a.v > p.st AND NOT list_contains(p.path, a.v) AND p.len < {_CYCLE_MAX - 1}),
cyc AS (SELECT DISTINCT list_sort(list_transform(p.path, lambda x: CAST(x AS VARCHAR))) AS m
        FROM paths p JOIN adj a ON a.u = p.last AND a.v = p.st
        WHERE p.len >= 2 AND p.path[2] < p.last)
SELECT row_number() OVER (ORDER BY len(m), array_to_string(m, ', ')) AS "group",
       CAST(len(m) AS INTEGER) AS size, array_to_string(m, ', ') AS members
FROM cyc
""")
def q_graph_cycles(spark, sf):
    return graph.simple_cycles(_pairs(spark, sf), "p1", "p2", max_len=_CYCLE_MAX)


_LONG_CYCLE = 6


# Accidents after urgent orders only, a graph sparse enough for cycles of six persons.
@register("graph_long_cycles", f"""
WITH RECURSIVE pairs AS (SELECT a.o_custkey AS p1, b.o_custkey AS p2
              FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1 WHERE a.o_orderpriority = '1-URGENT'),
s AS (SELECT DISTINCT least(p1, p2) AS u, greatest(p1, p2) AS v FROM pairs WHERE p1 <> p2),
adj AS (SELECT u, v FROM s UNION ALL SELECT v, u FROM s),
paths(st, path, last, len) AS (
  SELECT u, [u, v], v, 1 FROM adj WHERE v > u
  UNION ALL
  SELECT p.st, list_append(p.path, a.v), a.v, p.len + 1
  FROM paths p JOIN adj a ON a.u = p.last
  WHERE a.v > p.st AND NOT list_contains(p.path, a.v) AND p.len < {_LONG_CYCLE - 1}),
cyc AS (SELECT DISTINCT list_sort(list_transform(p.path, lambda x: CAST(x AS VARCHAR))) AS m
        FROM paths p JOIN adj a ON a.u = p.last AND a.v = p.st
        WHERE p.len >= 2 AND p.path[2] < p.last)
SELECT row_number() OVER (ORDER BY len(m), array_to_string(m, ', ')) AS "group",
       CAST(len(m) AS INTEGER) AS size, array_to_string(m, ', ') AS members
FROM cyc
""")
def q_graph_long_cycles(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    nxt = o.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("p2"))
    urgent = o.filter(F.col("o_orderpriority") == "1-URGENT").join(nxt, "o_orderkey").select(F.col("o_custkey").alias("p1"), "p2")
    return graph.simple_cycles(urgent, "p1", "p2", max_len=_LONG_CYCLE)


# ---------------------------------------------------------------- clustering
# Testdata mapping: one point per user from events (event count, mean
# value), max-abs scaled. eps 0.025 (the original 0.13 gives one cluster here).
_EPS, _MIN_SAMPLES = 0.025, 5

_DUCK_USERS = """u AS (SELECT user_id, count(*) AS cnt, avg(value) AS val FROM events GROUP BY user_id),
mx AS (SELECT max(abs(cnt)) AS mc, max(abs(val)) AS mv FROM u),
p AS (SELECT user_id AS id, cnt, val, cnt / mc AS x, val / mv AS y FROM u, mx)"""

_DUCK_DBSCAN = f"""{_DUCK_USERS},
nb AS (SELECT a.id, b.id AS nid FROM p a JOIN p b
       ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {_EPS}),
core AS (SELECT id FROM nb GROUP BY id HAVING count(*) >= {_MIN_SAMPLES}),
ce AS (SELECT nb.id AS a, nb.nid AS b FROM nb JOIN core c1 ON nb.id = c1.id JOIN core c2 ON nb.nid = c2.id),
reach(a, b) AS (SELECT id, id FROM core UNION SELECT r.a, ce.b FROM reach r JOIN ce ON r.b = ce.a),
croot AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a),
broot AS (SELECT nb.id, min(cr.root) AS root FROM nb JOIN croot cr ON nb.nid = cr.id
          WHERE nb.id NOT IN (SELECT id FROM core) GROUP BY nb.id),
allroot AS (SELECT id, root FROM croot UNION ALL SELECT id, root FROM broot),
num AS (SELECT root, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM allroot) r),
lab AS (SELECT p.id AS user_id, p.cnt, p.val, round(p.x, 6) AS x, round(p.y, 6) AS y,
               p.id IN (SELECT id FROM core) AS is_core,
               CAST(coalesce(num.cluster, -1) AS INTEGER) AS cluster
        FROM p LEFT JOIN allroot ar ON p.id = ar.id LEFT JOIN num ON ar.root = num.root)"""


def _user_points(spark, sf):
    ev = table(spark, sf, "events")
    u = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"), F.avg("value").alias("val"))
    return prep.maxabs_scale(u.withColumn("x", F.col("cnt")).withColumn("y", F.col("val")), ["x", "y"])


def _dbscan(spark, sf):
    pts = _user_points(spark, sf)
    lab = cluster.dbscan(pts, "user_id", ["x", "y"], eps=_EPS, min_samples=_MIN_SAMPLES)
    return lab.join(pts.select("user_id", "cnt", "val"), "user_id")


@register("dbscan_core", f"""
WITH RECURSIVE {_DUCK_DBSCAN}
SELECT user_id, x, y FROM lab WHERE is_core
""")
def q_dbscan_core(spark, sf):
    d = _dbscan(spark, sf).filter("is_core")
    return d.select("user_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@register("dbscan_labels", f"""
WITH RECURSIVE {_DUCK_DBSCAN}
SELECT user_id, is_core, cluster FROM lab
""")
def q_dbscan_labels(spark, sf):
    return _dbscan(spark, sf).select("user_id", "is_core", "cluster")


@register("cluster_profile", f"""
WITH RECURSIVE {_DUCK_DBSCAN}
SELECT cluster, count(*) AS size, round(avg(cnt), 6) AS mean_cnt, round(avg(val), 6) AS mean_val
FROM lab GROUP BY cluster
""")
def q_cluster_profile(spark, sf):
    return cluster.profile(_dbscan(spark, sf), "cluster", ["cnt", "val"])


_AGGLO_K, _AGGLO_CELL = 4, 0.125


# Greedy average linkage of the grid's cells, one merge a step, by a list that holds each cell's cluster.
@register("agglo_labels", f"""
WITH RECURSIVE {_DUCK_USERS},
c AS (SELECT CAST(floor(x / {_AGGLO_CELL}) AS BIGINT) AS gx, CAST(floor(y / {_AGGLO_CELL}) AS BIGINT) AS gy,
             count(*) AS n, avg(x) AS cx, avg(y) AS cy FROM p GROUP BY 1, 2),
m AS (SELECT *, row_number() OVER (ORDER BY gx, gy) AS i FROM c),
d AS (SELECT a.i AS i, b.i AS j, a.n * b.n AS w, a.n * b.n * (abs(a.cx - b.cx) + abs(a.cy - b.cy)) AS s
      FROM m a JOIN m b ON a.i < b.i),
steps(step, lab) AS (
  SELECT 0, (SELECT list(i ORDER BY i) FROM m)
  UNION ALL
  SELECT step + 1, (SELECT list_transform(lab, lambda x: CASE WHEN x = best.b THEN best.a ELSE x END)
                    FROM (SELECT least(lab[i], lab[j]) AS a, greatest(lab[i], lab[j]) AS b, round(sum(s) / sum(w), 9) AS h
                          FROM d WHERE lab[i] <> lab[j] GROUP BY 1, 2 ORDER BY h, a, b LIMIT 1) best)
  FROM steps WHERE step < (SELECT count(*) FROM m) - {_AGGLO_K}),
l AS (SELECT i, lab[i] AS root FROM m, (SELECT lab FROM steps ORDER BY step DESC LIMIT 1) t)
SELECT p.id AS user_id, CAST(dense_rank() OVER (ORDER BY l.root) - 1 AS INTEGER) AS cluster
FROM p JOIN m ON m.gx = floor(p.x / {_AGGLO_CELL}) AND m.gy = floor(p.y / {_AGGLO_CELL}) JOIN l ON l.i = m.i
""")
def q_agglo_labels(spark, sf):
    return cluster.agglomerative_grid(_user_points(spark, sf), "user_id", ["x", "y"], k=_AGGLO_K, cell=_AGGLO_CELL)[0]


@register("brand_distances", """
WITH m AS (SELECT p_brand, avg(p_size) AS s, avg(p_retailprice) AS r FROM part GROUP BY p_brand)
SELECT p_partkey, round(abs(p_size - s) + abs(p_retailprice - r), 6) AS dist FROM part JOIN m USING (p_brand)
""")
def q_brand_distances(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    mean = p.groupBy("p_brand").agg(F.array(F.avg("p_size"), F.avg("p_retailprice")).alias("mean"))
    here = F.array(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double"))
    return p.join(mean, "p_brand").select("p_partkey", F.round(X.manhattan(here, "mean"), 6).alias("dist"))


@register("kmeans_profile")
def q_kmeans_profile(spark, sf):
    pts = _user_points(spark, sf)
    lab, _ = cluster.kmeans(pts, ["x", "y"], k=4, max_iter=50, seed=22)
    return cluster.profile(lab, "cluster", ["cnt", "val"])


# ------------------------------------------------------------ policy renewal
# Testdata mapping: one policy per order; every policy column is derived
# from the order row by one expression list valid in Spark SQL and DuckDB.
_POLICY_EXPRS = [
    "o_orderkey AS POLICY_ID",
    "CASE WHEN o_orderstatus = 'F' THEN 'TRAIN' ELSE 'TEST ' END AS DATA_TYPE",
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS POLICY_IS_RENEWED",
    "month(o_orderdate) AS POLICY_BEGIN_MONTH",
    "month(o_orderdate) AS POLICY_END_MONTH",
    "CAST(o_custkey % 50 AS INT) AS POLICY_SALES_CHANNEL",
    "CAST(o_custkey % 5 AS INT) AS POLICY_SALES_CHANNEL_GROUP",
    "CASE WHEN o_custkey % 3 = 0 THEN 'Москва' ELSE 'Санкт-Петербург' END AS POLICY_BRANCH",
    "CAST(15 + o_custkey % 60 AS INT) AS POLICY_MIN_AGE",
    "CAST(CASE WHEN o_orderkey % 50 = 0 THEN 2016 - o_custkey % 40 ELSE o_custkey % 40 END AS INT) "
    "AS POLICY_MIN_DRIVING_EXPERIENCE",
    "'make_' || CAST(o_custkey % 7 AS STRING) AS VEHICLE_MAKE",
    "'model_' || CAST(o_custkey % 13 AS STRING) AS VEHICLE_MODEL",
    "o_totalprice / 1000 AS VEHICLE_ENGINE_POWER",
    "o_totalprice AS VEHICLE_SUM_INSURED",
    "CAST(o_orderkey % 2 AS INT) AS VEHICLE_IN_CREDIT",
    "CAST(o_custkey % 17 AS DOUBLE) AS CLAIM_AVG_ACC_ST_PRD",
    "CAST(o_custkey % 4 * 1000 AS DOUBLE) AS POLICY_DEDUCT_VALUE",
    "CAST(o_orderkey % 21 - 10 AS DOUBLE) / 100 AS POLICY_PRICE_CHANGE",
    "'region_' || CAST(o_custkey % 83 AS STRING) AS CLIENT_REGISTRATION_REGION",
    "'int_' || CAST(o_custkey % 1333 AS STRING) AS POLICY_INTERMEDIARY",
    "CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS INSURER_GENDER",
    "CASE o_orderkey % 7 WHEN 0 THEN 'N' WHEN 1 THEN 'n/d' ELSE CAST(o_orderkey % 3 AS STRING) END AS POLICY_CLM_N",
    "CASE o_orderkey % 11 WHEN 0 THEN 'n/d' ELSE CAST(o_orderkey % 2 AS STRING) END AS POLICY_CLM_GLT_N",
    "CASE o_custkey % 9 WHEN 0 THEN 'n/d' WHEN 1 THEN 'N' ELSE CAST(o_custkey % 4 AS STRING) END AS POLICY_PRV_CLM_N",
    "CASE o_custkey % 5 WHEN 0 THEN 'N' ELSE CAST(o_custkey % 2 AS STRING) END AS POLICY_PRV_CLM_GLT_N",
    "CASE WHEN o_orderkey % 13 = 0 THEN 'N' ELSE CAST(o_custkey % 6 AS STRING) END AS POLICY_YEARS_RENEWED_N",
    "CAST(o_custkey % 2 AS INT) AS CLIENT_HAS_DAGO",
    "CASE WHEN o_custkey % 4 >= 2 THEN 1 ELSE 0 END AS CLIENT_HAS_OSAGO",
    "CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS POLICY_COURT_SIGN",
    "CASE WHEN o_orderkey % 89 = 0 THEN 1 ELSE 0 END AS POLICY_HAS_COMPLAINTS",
]
_POLICY_OUT = ["POLICY_ID", "POLICY_BRANCH", "INSURER_GENDER", "AGE_18-25", "AGE_25-40", "AGE_40-65",
               "AGE_65+", "DRV_EXP_0-3", "DRV_EXP_3-10", "DRV_EXP_10-20", "DRV_EXP_20+",
               "POLICY_CLM_N", "POLICY_CLM_GLT_N", "POLICY_YEARS_RENEWED_N"]


def _policies(spark, sf):
    return table(spark, sf, "orders").selectExpr(*_POLICY_EXPRS)


@register("ab_side_by_side", """
SELECT avg(c) FILTER (event_type = 'click') AS click_p, CAST(sum(c) FILTER (event_type = 'click') AS BIGINT) AS click_m,
       count(*) FILTER (event_type = 'click') AS click_n,
       avg(c) FILTER (event_type = 'purchase') AS purchase_p, CAST(sum(c) FILTER (event_type = 'purchase') AS BIGINT) AS purchase_m,
       count(*) FILTER (event_type = 'purchase') AS purchase_n
FROM (SELECT event_type, user_id % 2 AS c FROM events)
""")
def q_ab_side_by_side(spark, sf):
    ev = table(spark, sf, "events").select("event_type", (F.col("user_id") % 2).cast("int").alias("odd"))
    return stats.side_by_side(stats.pick_groups(ev, "event_type", ["click", "purchase"]), "event_type", "odd",
                              ["click", "purchase"])


_DRAWS, _DRAW_SEED = 5000, 7


@register("drawn_customers", f"""
WITH c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer),
d AS (SELECT CAST('0x' || substr(md5('{_DRAW_SEED}:' || CAST(range AS VARCHAR)), 1, 12) AS BIGINT)
             % (SELECT count(*) FROM customer) AS place FROM range({_DRAWS}))
SELECT c_custkey, count(*) AS times FROM c JOIN d USING (place) GROUP BY c_custkey
""")
def q_drawn_customers(spark, sf):
    return prep.draw_rows(table(spark, sf, "customer").select("c_custkey"), ["c_custkey"], _DRAWS, _DRAW_SEED)


@register("label_binariser", """
SELECT o_orderkey, CASE WHEN o_custkey % 2 = 1 THEN 1 ELSE 0 END AS side_odd,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS "o_orderstatus_F",
       CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS "o_orderstatus_O",
       CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS "o_orderstatus_P"
FROM orders
""")
def q_label_binariser(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus",
                                          F.when(F.col("o_custkey") % 2 == 1, "odd").otherwise("even").alias("side"))
    return prep.binarise(o, ["side", "o_orderstatus"])


@register("policy_features", f"""
WITH pol AS (SELECT {", ".join(_POLICY_EXPRS)} FROM orders),
fx AS (SELECT *, CASE WHEN POLICY_MIN_DRIVING_EXPERIENCE > 100
                      THEN 2016 - POLICY_MIN_DRIVING_EXPERIENCE
                      ELSE POLICY_MIN_DRIVING_EXPERIENCE END AS exp FROM pol)
SELECT POLICY_ID,
  CASE WHEN POLICY_BRANCH = 'Москва' THEN 0 ELSE 1 END AS POLICY_BRANCH,
  CASE WHEN INSURER_GENDER = 'M' THEN 0 ELSE 1 END AS INSURER_GENDER,
  CASE WHEN POLICY_MIN_AGE < 25 THEN 1 ELSE 0 END AS "AGE_18-25",
  CASE WHEN POLICY_MIN_AGE >= 25 AND POLICY_MIN_AGE <= 40 THEN 1 ELSE 0 END AS "AGE_25-40",
  CASE WHEN POLICY_MIN_AGE >= 40 AND POLICY_MIN_AGE < 65 THEN 1 ELSE 0 END AS "AGE_40-65",
  CASE WHEN POLICY_MIN_AGE >= 65 THEN 1 ELSE 0 END AS "AGE_65+",
  CASE WHEN exp < 3 THEN 1 ELSE 0 END AS "DRV_EXP_0-3",
  CASE WHEN exp >= 3 AND exp < 10 THEN 1 ELSE 0 END AS "DRV_EXP_3-10",
  CASE WHEN exp >= 10 AND exp < 20 THEN 1 ELSE 0 END AS "DRV_EXP_10-20",
  CASE WHEN exp >= 20 THEN 1 ELSE 0 END AS "DRV_EXP_20+",
  CASE WHEN POLICY_CLM_N = 'n/d' THEN 'N' ELSE POLICY_CLM_N END AS POLICY_CLM_N,
  CASE WHEN POLICY_CLM_GLT_N = 'n/d' THEN 'N' ELSE POLICY_CLM_GLT_N END AS POLICY_CLM_GLT_N,
  CASE WHEN POLICY_YEARS_RENEWED_N = 'N' THEN 1 ELSE CAST(POLICY_YEARS_RENEWED_N AS INTEGER) END
    AS POLICY_YEARS_RENEWED_N
FROM fx
""")
def q_policy_features(spark, sf):
    return policy.prepare(_policies(spark, sf)).select(*[F.col(f"`{c}`") for c in _POLICY_OUT])


@register("renewal_scores")
def q_renewal_scores(spark, sf):
    pol = policy.prepare(_policies(spark, sf))
    train = prep.take_split(pol, "DATA_TYPE", "TRAIN")
    test = prep.take_split(pol, "DATA_TYPE", "TEST ").drop("POLICY_IS_RENEWED")
    enc, found, _acc = policy.fit(train)  # the original search: 27 settings, 4 folds
    return policy.score(enc, found, test)


@register("log_loss", """
WITH t AS (SELECT event_type, CAST(user_id % 2 AS DOUBLE) AS y,
                  1 / (1 + exp(-((value - 50) / 50))) AS p FROM events),
per AS (SELECT event_type, count(*) AS n,
               sum(-y * ln(p + 1e-8) - (1 - y) * ln(1 - p + 1e-8)) AS loss
        FROM t GROUP BY event_type)
SELECT event_type, n, round(loss, 6) AS loss, round(avg(loss) OVER (), 6) AS mean_loss FROM per
""")
def q_log_loss(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_type", (F.col("user_id") % 2).alias("y"),
        X.sigmoid((F.col("value") - 50) / 50).alias("p"))
    return model.log_loss_by_class(ev, "event_type", "y", "p")


# Fixed value: the number of labels of the original job.
_N_LABELS = 14


@register("multilabel_scores")
def q_multilabel_scores(spark, sf):
    p = table(spark, sf, "part")
    src = p.select(F.col("p_partkey").alias("id"), "p_brand", "p_type", "p_size", "p_retailprice")
    src = prep.hash_split(src, "id", share=0.2, seed=1, name="is_test")
    src = src.withColumn("split", F.when(F.col("is_test"), "test").otherwise("train")).drop("is_test")
    feats = prep.auto_prepare(src, id_col="id", split_col="split")
    fcols = [c for c in feats.columns if c not in ("id", "split")]
    feats = model.assemble(feats, fcols)
    labels = p.select(F.col("p_partkey").alias("id"),
                      *[(F.col("p_partkey") % (i + 2) == 0).cast("int").alias(f"label_{i}") for i in range(_N_LABELS)])
    train = feats.filter(F.col("split") == "train").join(labels, "id")
    models = model.fit_multilabel(train, "features", [f"label_{i}" for i in range(_N_LABELS)])
    return model.score_multilabel(models, feats.filter(F.col("split") == "test"), "id", "features")


# A joint fit is right when no component of a label's gradient is left: recomputed from the scores with plain expressions.
@register("multilabel_gradients", f"""
SELECT CAST(range AS INTEGER) AS label, 0.0::DOUBLE AS steepest FROM range({_N_LABELS})
""")
def q_multilabel_gradients(spark, sf):
    p = table(spark, sf, "part")
    src = p.select(F.col("p_partkey").alias("id"), "p_brand", "p_size", "p_retailprice").withColumn("split", F.lit("train"))
    feats = prep.auto_prepare(src, id_col="id", split_col="split")
    feats = model.assemble(feats, [c for c in feats.columns if c not in ("id", "split")]).select("id", "features")
    names = [f"label_{i}" for i in range(_N_LABELS)]
    rows = feats.join(p.select(F.col("p_partkey").alias("id"), *[
        (F.col("p_partkey") % (i + 2) == 0).cast("int").alias(n) for i, n in enumerate(names)]), "id")
    weights, _ = model.fit_multilabel_joint(rows, "features", names)
    scored = model.score_multilabel_joint(weights, rows, "id", "features").join(rows, "id")
    from pyspark.ml.functions import vector_to_array
    left = scored.select(F.posexplode(F.array(*[F.col(f"class_{i}") - F.col(n) for i, n in enumerate(names)]))
                         .alias("label", "left"), F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"))
    parts = left.select("label", "left", F.posexplode("x").alias("i", "v")).groupBy("label", "i").agg(
        F.avg(F.col("left") * F.col("v")).alias("g"))
    return parts.groupBy("label").agg(F.round(F.max(F.abs("g")), 4).alias("steepest"))

"""Merging tables on the subject key and reducing them to complete rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mergewell.operators.columns import count_values, drop_all_null, infer_types, shuffle
from mergewell.operators.completeness import (
    column_completeness, complete_table, drop_sparse_rows, na_cutoff)
from mergewell.operators.counting import na_counts
from mergewell.operators.encoding import (
    category_levels, dummy_encode, one_hot, sparse_one_hot, variance_flags)
from mergewell.operators.merge import keep_in, keep_not_in, merge_all, reattach, to_wide
from mergewell.operators.redundancy import (
    choose_survivors, connected_components, drop_redundant_strings, feature_summary,
    first_per_key, group_correlated, redundant_features, resolve_label)
from mergewell.operators.correlation import (
    pairs_with_gaps, partner_counts, pearson_pairs, rank_columns, spearman_pairs,
    strong_pairs_report)
from mergewell.queries.registry import query, table

FEATURES = ["balance", "nation", "segment", "n_orders", "spent", "priority", "n_events", "max_value"]


def subject_tables(spark, sf_dir) -> list[DataFrame]:
    """Three datasets about customers; negative balances count as not reported."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("subject_id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("subject_id")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"),
        F.min("o_orderpriority").alias("priority"))
    events = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("subject_id")).agg(
        F.count(F.lit(1)).alias("n_events"), F.max("value").alias("max_value"))
    return [customers, orders, events]


def merged(spark, sf_dir) -> DataFrame:
    return merge_all(subject_tables(spark, sf_dir), "subject_id")


MERGED_SQL = """
  SELECT subject_id, balance, nation, segment, n_orders, spent, priority, n_events, max_value
  FROM (SELECT c_custkey AS subject_id, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
               c_nationkey AS nation, c_mktsegment AS segment FROM customer)
  FULL OUTER JOIN (SELECT o_custkey AS subject_id, count(*) AS n_orders,
                          round(sum(o_totalprice), 2) AS spent, min(o_orderpriority) AS priority
                   FROM orders GROUP BY o_custkey) USING (subject_id)
  FULL OUTER JOIN (SELECT user_id AS subject_id, count(*) AS n_events, max(value) AS max_value
                   FROM events GROUP BY user_id) USING (subject_id)"""

COMPLETENESS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS have_data, count(*) AS rows,"
    f" count({c}) >= 0.5 * count(*) AS kept FROM merged" for c in FEATURES)


@query("q_full_merge", MERGED_SQL)
def q_full_merge(spark, sf_dir):
    return merged(spark, sf_dir)


@query("q_reattach", """
SELECT o_orderkey AS order_id, o_custkey AS subject_id, o_totalprice, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_reattach(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("subject_id"), "o_totalprice")
    side = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("subject_id"), "c_mktsegment")
    return reattach(orders, side, "subject_id")


@query("q_in", """
SELECT doc_id, lang, n_chars FROM documents d WHERE EXISTS (
  SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_in(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return keep_in(documents, table(spark, sf_dir, "labels"), "doc_id")


@query("q_not_in", """
SELECT doc_id, lang, n_chars FROM documents d WHERE NOT EXISTS (
  SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_not_in(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return keep_not_in(documents, table(spark, sf_dir, "labels"), "doc_id")


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("q_to_wide", "SELECT user_id, " + ", ".join(
    f"max(CASE WHEN event_type = '{e}' THEN value END) AS {e}" for e in EVENT_TYPES)
    + " FROM events GROUP BY user_id")
def q_to_wide(spark, sf_dir):
    best = table(spark, sf_dir, "events").groupBy("user_id", F.col("event_type").alias("feature")).agg(
        F.max("value").alias("value"))
    return to_wide(best, "user_id", EVENT_TYPES)


@query("q_col_completeness", f"WITH merged AS ({MERGED_SQL}) {COMPLETENESS_SQL}")
def q_col_completeness(spark, sf_dir):
    return column_completeness(merged(spark, sf_dir), FEATURES)


ROW_FILTER = " + ".join(f"({c} IS NOT NULL)::INT" for c in FEATURES)


@query("q_row_completeness", f"""
WITH merged AS ({MERGED_SQL}) SELECT * FROM merged WHERE {ROW_FILTER} >= 0.75 * {len(FEATURES)}""")
def q_row_completeness(spark, sf_dir):
    return drop_sparse_rows(merged(spark, sf_dir), FEATURES)


GAPS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) - count({c}) AS na FROM merged" for c in FEATURES)


@query("q_auto_cutoff", f"""
WITH merged AS ({MERGED_SQL}), gaps AS ({GAPS_SQL})
SELECT CAST(quantile_cont(na, 0.25) AS DOUBLE) AS keep_features,
       CAST((min(na) + quantile_cont(na, 0.25)) / 2 AS DOUBLE) AS keep_samples FROM gaps""")
def q_auto_cutoff(spark, sf_dir):
    rows, filled = count_values(merged(spark, sf_dir), FEATURES)
    gaps = [rows - n for n in filled.values()]
    return spark.createDataFrame(
        [(float(na_cutoff(gaps)), float(na_cutoff(gaps, preserve_samples=True)))],
        "keep_features double, keep_samples double")


DENSE = [c for c in FEATURES if c not in ("n_events", "max_value")]
COMPLETE = [c for c in DENSE if c != "balance"]


@query("q_complete_table", f"""
WITH merged AS ({MERGED_SQL}), dense AS (
  SELECT * FROM merged WHERE {" + ".join(f"({c} IS NOT NULL)::INT" for c in DENSE)} >= 0.75 * {len(DENSE)})
SELECT subject_id, {", ".join(COMPLETE)} FROM dense
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in COMPLETE)}""")
def q_complete_table(spark, sf_dir):
    return complete_table(merged(spark, sf_dir), "subject_id")[0]


@query("q_one_hot", "SELECT c_custkey AS subject_id, balance_sign_up, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1.0::DOUBLE ELSE 0.0 END AS segment_{s.lower()}"
    for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))
    + """ FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN 1.0::DOUBLE ELSE 0.0 END AS balance_sign_up
               FROM customer)""")
def q_one_hot(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("subject_id"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") >= 0, "up").otherwise("down").alias("balance_sign"))
    return one_hot(customers, ["balance_sign", "segment"])


@query("q_dummy", "SELECT c_custkey AS subject_id, c_acctbal, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1.0::DOUBLE ELSE 0.0 END AS c_mktsegment_{s.lower()}"
    for s in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM customer")
def q_dummy(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("subject_id"), "c_acctbal", "c_mktsegment")
    return dummy_encode(customers, category_levels(customers, ["c_mktsegment"]))


@query("q_shuffle", "SELECT * FROM supplier")
def q_shuffle(spark, sf_dir):
    return shuffle(table(spark, sf_dir, "supplier"), 42, "s_suppkey")


@query("q_zero_variance", " UNION ALL ".join(
    f"""SELECT '{name}' AS feature, min({c}) = max({c}) AS constant,
        count(*) FILTER (WHERE {c} <> 0) AS non_zero,
        count(*) FILTER (WHERE {c} <> 0) <= 1 AS near_empty FROM lineitem"""
    for name, c in (("quantity", "l_quantity"), ("tax", "l_tax"), ("same", "(l_linenumber * 0)"),
                    ("one", "(l_linenumber * 0 + 1)"))))
def q_zero_variance(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("tax"),
        (F.col("l_linenumber") * 0.0).alias("same"), (F.col("l_linenumber") * 0.0 + 1).alias("one"))
    return variance_flags(lines, lines.columns)


@query("q_drop_all_null", "SELECT p_partkey, p_size, p_retailprice FROM part")
def q_drop_all_null(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", F.when(
        F.col("p_size") < 0, F.col("p_name")).alias("never"))
    return drop_all_null(part)


@query("q_retyped", """
SELECT p_partkey, p_name, CAST(p_size AS DOUBLE) AS p_size,
       CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) END AS gappy FROM part""")
def q_retyped(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.col("p_size").cast("string"),
        F.when(F.col("p_size") > 10, F.col("p_size").cast("string")).otherwise("nan").alias("gappy"))
    return infer_types(part, ["p_name"])


@query("q_first_per_key", """
WITH o AS (SELECT o_custkey, o_orderkey,
  CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice FROM orders)
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_totalprice NULLS LAST, o_orderkey) AS rn FROM o) WHERE rn = 1""")
def q_first_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(
        F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("o_totalprice"))
    return first_per_key(orders, ["o_custkey"], ["o_totalprice", "o_orderkey"])


@query("q_feature_summary", f"""
WITH merged AS ({MERGED_SQL}), counts AS ({COMPLETENESS_SQL}),
everything AS (SELECT feature FROM counts), complete AS (SELECT feature FROM counts WHERE have_data = rows)
SELECT feature AS features, 'all_features' AS category FROM everything
UNION ALL SELECT feature, 'dropped_to_retain_samples' FROM (
  SELECT feature FROM everything EXCEPT SELECT feature FROM complete)
UNION ALL SELECT feature, 'dropped_in_correlation' FROM (
  SELECT feature FROM everything WHERE feature IN ('spent', 'n_orders')
  EXCEPT SELECT feature FROM complete WHERE feature <> 'spent')
UNION ALL SELECT feature, 'final_feature_list' FROM complete WHERE feature <> 'spent'""")
def q_feature_summary(spark, sf_dir):
    counts = column_completeness(merged(spark, sf_dir), FEATURES).withColumnRenamed("feature", "features")
    complete = counts.filter("have_data = rows").select("features")
    correlated = counts.filter("features IN ('spent', 'n_orders')").select("features")
    return feature_summary(
        counts.select("features"), complete, correlated, complete.filter("features <> 'spent'"))


LABELLED_SQL = """
  SELECT d.doc_id, d.lang, l.quality AS label, CASE WHEN d.n_chars > 200 THEN l.quality END AS label_2
  FROM documents d LEFT JOIN labels l USING (doc_id)"""


@query("q_label_resolve", f"""
WITH wide AS ({LABELLED_SQL}) SELECT doc_id, lang, label FROM wide""")
def q_label_resolve(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    wide = documents.join(labels, "doc_id", "left").withColumn(
        "label_2", F.when(F.col("n_chars") > 200, F.col("label"))).drop("n_chars")
    return resolve_label(wide, "label")[0]


@query("q_char_dedupe", """
SELECT c_custkey, c_mktsegment AS seg_2, c_name AS name FROM customer""")
def q_char_dedupe(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("seg"),
        F.col("c_mktsegment").alias("seg_2"), F.col("c_name").alias("name"),
        F.col("c_name").alias("name_2"))
    return drop_redundant_strings(customers, "c_custkey", "label")[0]


# --- correlation -------------------------------------------------------------------

LINE_COLUMNS = ["quantity", "price", "price_net", "price_up", "discount", "tax", "part"]


def _line_numbers(spark, sf_dir) -> DataFrame:
    """Numeric line columns with near copies of the price, some of them with gaps."""
    price, qty = F.col("l_extendedprice"), F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line"),
        qty.alias("quantity"), price.alias("price"),
        F.when(qty > 2, price * 2 + qty).alias("price_net"),
        F.when(qty > 4, F.lit(5) - price).alias("price_up"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        F.col("l_partkey").cast("double").alias("part"))


LINES_SQL = """
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS line, l_quantity AS quantity, l_extendedprice AS price,
         CASE WHEN l_quantity > 2 THEN l_extendedprice * 2 + l_quantity END AS price_net,
         CASE WHEN l_quantity > 4 THEN 5 - l_extendedprice END AS price_up,
         l_discount AS discount, l_tax AS tax, l_partkey::DOUBLE AS part FROM lineitem"""
COMPLETE_LINES_SQL = f"""
  SELECT * FROM ({LINES_SQL}) WHERE price_net IS NOT NULL AND price_up IS NOT NULL"""


def _pairs_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM {source}"
        for i, a in enumerate(columns) for b in columns[i + 1:])


PEARSON_SQL = f"lines AS ({COMPLETE_LINES_SQL}), pairs AS ({_pairs_sql('lines', LINE_COLUMNS)})"
LINE_GAPS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) - count({c}) AS na_count FROM ({LINES_SQL})"
    for c in LINE_COLUMNS)


@query("q_pearson_pairs", f"WITH {PEARSON_SQL} SELECT a, b, round(corr, 6) AS corr FROM pairs")
def q_pearson_pairs(spark, sf_dir):
    pairs = pearson_pairs(_line_numbers(spark, sf_dir), LINE_COLUMNS)
    return pairs.withColumn("corr", F.round("corr", 6))


RANKED_SQL = ", ".join(
    f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)::DOUBLE AS {c}"
    for c in LINE_COLUMNS)
SPEARMAN_SQL = f"""lines AS ({COMPLETE_LINES_SQL}), ranks AS (SELECT {RANKED_SQL} FROM lines),
  pairs AS ({_pairs_sql('ranks', LINE_COLUMNS)})"""


@query("q_spearman_pairs", f"WITH {SPEARMAN_SQL} SELECT a, b, round(corr, 6) AS corr FROM pairs")
def q_spearman_pairs(spark, sf_dir):
    pairs = spearman_pairs(_line_numbers(spark, sf_dir), LINE_COLUMNS)
    return pairs.withColumn("corr", F.round("corr", 6))


@query("q_average_ranks", f"WITH {SPEARMAN_SQL} SELECT {', '.join(LINE_COLUMNS)} FROM ranks")
def q_average_ranks(spark, sf_dir):
    return rank_columns(_line_numbers(spark, sf_dir), LINE_COLUMNS)


@query("q_corr_report", f"""
WITH {PEARSON_SQL} SELECT a, b, round(abs(corr), 6) AS corr FROM pairs WHERE abs(corr) >= 0.95 - 1e-6""")
def q_corr_report(spark, sf_dir):
    pairs = strong_pairs_report(_line_numbers(spark, sf_dir), LINE_COLUMNS, 0.95)
    return pairs.withColumn("corr", F.round("corr", 6))


@query("q_pairs_with_gaps", f"""
WITH {PEARSON_SQL}, gaps AS ({LINE_GAPS_SQL})
SELECT a, b, x.na_count AS na_a, y.na_count AS na_b, round(corr, 6) AS corr FROM pairs
JOIN gaps x ON a = x.feature JOIN gaps y ON b = y.feature WHERE abs(corr) > 0.9""")
def q_pairs_with_gaps(spark, sf_dir):
    lines = _line_numbers(spark, sf_dir)
    pairs = pearson_pairs(lines, LINE_COLUMNS, 0.9)
    return pairs_with_gaps(pairs, na_counts(lines, "lines", "line")).withColumn(
        "corr", F.round("corr", 6))


@query("q_corr_degree", f"""
WITH {PEARSON_SQL}, strong AS (SELECT a, b FROM pairs WHERE abs(corr) > 0.9)
SELECT feature, count(*) AS partners FROM (
  SELECT a AS feature FROM strong UNION ALL SELECT b FROM strong) GROUP BY feature""")
def q_corr_degree(spark, sf_dir):
    return partner_counts(pearson_pairs(_line_numbers(spark, sf_dir), LINE_COLUMNS, 0.9))


@query("q_redundant_numeric", f"""
WITH {PEARSON_SQL}, gaps AS ({LINE_GAPS_SQL}), strong AS (
  SELECT a, b, x.na_count AS na_a, y.na_count AS na_b FROM pairs
  JOIN gaps x ON a = x.feature JOIN gaps y ON b = y.feature WHERE abs(corr) > 0.99),
facing AS (SELECT CASE WHEN na_b >= na_a THEN b ELSE a END AS led,
                  CASE WHEN na_b >= na_a THEN a ELSE b END AS leader FROM strong),
sides AS (SELECT a AS f FROM strong UNION ALL SELECT b FROM strong),
degree AS (SELECT f, count(*) AS n FROM sides GROUP BY f)
SELECT f AS feature FROM degree WHERE n <> 1 AND NOT (
  f IN (SELECT leader FROM facing) AND f NOT IN (SELECT led FROM facing))""")
def q_redundant_numeric(spark, sf_dir):
    lines = _line_numbers(spark, sf_dir)
    pairs = pearson_pairs(lines, LINE_COLUMNS, 0.99)
    return redundant_features(pairs, na_counts(lines, "lines", "line"))


GROUPS_SQL = f"""WITH RECURSIVE {SPEARMAN_SQL}, edges AS (
  SELECT a, b FROM pairs WHERE abs(corr) >= 0.95 UNION SELECT b, a FROM pairs WHERE abs(corr) >= 0.95),
nodes AS ({" UNION ALL ".join(f"SELECT '{c}' AS node, {i} AS place" for i, c in enumerate(LINE_COLUMNS))}),
reach AS (SELECT node, node AS other FROM nodes UNION
          SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
placed AS (SELECT r.node, min(n.place) AS first FROM reach r JOIN nodes n ON r.other = n.node GROUP BY r.node),
grouped AS (SELECT k.node AS keep, list(p.node ORDER BY m.place) FILTER (WHERE p.node <> k.node) AS others
            FROM placed p JOIN nodes m ON p.node = m.node JOIN nodes k ON k.place = p.first GROUP BY k.node)"""


def _line_groups(spark, sf_dir) -> DataFrame:
    pairs = spearman_pairs(_line_numbers(spark, sf_dir), LINE_COLUMNS, 0.9)
    return group_correlated(pairs, LINE_COLUMNS, 0.95)


@query("q_corr_groups", GROUPS_SQL + """
SELECT keep AS group_id, keep, coalesce(array_to_string(others, '|'), '') AS members FROM grouped""")
def q_corr_groups(spark, sf_dir):
    return _line_groups(spark, sf_dir).withColumn("members", F.array_join("members", "|"))


@query("q_choose_survivor", GROUPS_SQL + """
SELECT keep AS group_id, CASE WHEN keep = 'price' THEN 'price_net' ELSE keep END AS survivor FROM grouped""")
def q_choose_survivor(spark, sf_dir):
    return choose_survivors(_line_groups(spark, sf_dir), {"price": "price_net"}).select(
        "group_id", "survivor")


@query("q_components", """
WITH RECURSIVE edges AS (
  SELECT DISTINCT n_name AS a, c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS b
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
links AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a AS node, a AS other FROM links UNION
          SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT node, min(other) AS component FROM reach GROUP BY node""")
def q_components(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    edges = customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        F.col("n_name").alias("a"),
        F.concat_ws("-", "c_mktsegment", "c_nationkey").alias("b")).distinct()
    return connected_components(edges)


@query("q_merge_shared_names", """
SELECT coalesce(c.c_custkey, s.s_suppkey, n.n_nationkey) AS subject_id, c.c_acctbal AS acctbal,
  s.s_acctbal AS acctbal_3, n.n_regionkey::DOUBLE AS acctbal_2
FROM customer c FULL JOIN supplier s ON c.c_custkey = s.s_suppkey
FULL JOIN nation n ON coalesce(c.c_custkey, s.s_suppkey) = n.n_nationkey""")
def q_merge_shared_names(spark, sf_dir):
    """Two datasets share a feature name, a third has the name that the second copy would get."""
    return merge_all([
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject_id"), F.col("c_acctbal").alias("acctbal")),
        table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("subject_id"), F.col("s_acctbal").alias("acctbal")),
        table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").cast("long").alias("subject_id"), F.col("n_regionkey").cast("double").alias("acctbal_2")),
    ], "subject_id")


@query("q_many_levels", """
SELECT row_number() OVER (ORDER BY p_name) - 1 AS place, count(*) AS n FROM part GROUP BY p_name""")
def q_many_levels(spark, sf_dir):
    """One-hot vectors of a text with thousands of levels: how often each place is 1."""
    encoded = sparse_one_hot(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "levels")
    places = encoded.select(F.explode(F.unwrap_udt("levels")["indices"]).alias("place"))
    return places.groupBy(F.col("place").cast("long").alias("place")).agg(F.count(F.lit(1)).alias("n"))

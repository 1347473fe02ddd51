"""Quality checks of single tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from mergewell.functions.cells import (
    clean_text, is_symbol_only, is_us_date, null_tokens)
from mergewell.functions.hashing import feature_hash
from mergewell.operators.columns import numeric_flags
from mergewell.operators.counting import (
    features_with_gaps, mark_duplicated, na_counts, rename_across_datasets)
from mergewell.operators.duplicates import (
    classify_duplicates, copies_to_long, surviving_copies)
from mergewell.operators.keys import get_dupes, number_repeats, repeated_keys
from mergewell.operators.merge import to_long
from mergewell.queries.registry import query, table

TOKENS_SQL = ("'NA','N A','N/A','#N/A',' NA','NA ','N / A','N /A','N / A ','na','n a','n/a',"
              "' na','na ','n /a','n / a','a / a','n / a ','NULL','null','','.','*','?','-',' - '")
NUMBER_SQL = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"


@query("q_null_tokens", f"""
WITH cells AS (
  SELECT p_partkey, CASE WHEN p_size <= 5 THEN 'NA' WHEN p_size <= 10 THEN ' - '
                         WHEN p_size <= 15 THEN 'NA  ' WHEN p_size <= 20 THEN '' ELSE p_name END AS cell
  FROM part)
SELECT p_partkey, CASE WHEN cell IN ({TOKENS_SQL}) THEN NULL ELSE cell END AS cell FROM cells""")
def q_null_tokens(spark, sf_dir):
    size = F.col("p_size")
    cells = table(spark, sf_dir, "part").select("p_partkey", (
        F.when(size <= 5, "NA").when(size <= 10, " - ").when(size <= 15, "NA  ")
        .when(size <= 20, "").otherwise(F.col("p_name"))).alias("cell"))
    return cells.select("p_partkey", null_tokens(F.col("cell")).alias("cell"))


@query("q_infer_types", f"""
WITH cells AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(value AS VARCHAR) AS value,
         props, regexp_extract(props, '[0-9]+') AS k,
         CASE WHEN event_type = 'click' THEN '1d' ELSE CAST(user_id AS VARCHAR) END AS mixed,
         CASE WHEN event_type = 'view' THEN CAST(value AS VARCHAR) END AS gappy
  FROM events), checked AS (
  SELECT {", ".join(f"coalesce(bool_and(CASE WHEN {c} IS NOT NULL THEN regexp_matches({c}, {NUMBER_SQL}) AND try_cast({c} AS DOUBLE) IS NOT NULL END), false) AS {c}" for c in ("event_id", "event_type", "value", "props", "k", "mixed", "gappy"))}
  FROM cells)
SELECT feature, is_numeric FROM (UNPIVOT checked ON COLUMNS(*) INTO NAME feature VALUE is_numeric)""")
def q_infer_types(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cells = events.select(
        F.col("event_id").cast("string"), "event_type", F.col("value").cast("string"), "props",
        F.regexp_extract("props", "[0-9]+", 0).alias("k"),
        F.when(F.col("event_type") == "click", "1d").otherwise(
            F.col("user_id").cast("string")).alias("mixed"),
        F.when(F.col("event_type") == "view", F.col("value").cast("string")).alias("gappy"))
    return numeric_flags(cells, cells.columns).unpivot([], cells.columns, "feature", "is_numeric")


@query("q_clean_names", r"""
WITH texts AS (
  SELECT DISTINCT p_name || ' ' || p_brand || '%' || p_type AS name FROM part
  UNION SELECT DISTINCT o_orderpriority FROM orders UNION SELECT DISTINCT url FROM pages),
step AS (
  SELECT name, lower(regexp_replace(replace(replace(regexp_replace(name, '[''"]', '', 'g'),
    '%', '_percent_'), '#', '_number_'), '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS s FROM texts),
trimmed AS (
  SELECT name, regexp_replace(regexp_replace(s, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS s FROM step)
SELECT name, CASE WHEN regexp_matches(s, '^[0-9]') OR s = '' THEN 'x' || s ELSE s END AS clean FROM trimmed""")
def q_clean_names(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.concat(
        "p_name", F.lit(" "), "p_brand", F.lit("%"), "p_type").alias("name"))
    names = (
        parts.union(table(spark, sf_dir, "orders").select("o_orderpriority"))
        .union(table(spark, sf_dir, "pages").select("url")).distinct())
    return names.select("name", clean_text(F.col("name")).alias("clean"))


@query("q_subject_dupes", """
SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, d.dupe_count FROM lineitem l JOIN (
  SELECT l_orderkey, l_partkey, count(*) AS dupe_count FROM lineitem
  GROUP BY 1, 2 HAVING count(*) > 1) d USING (l_orderkey, l_partkey)""")
def q_subject_dupes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return get_dupes(lines, ["l_orderkey", "l_partkey"])


@query("q_repeated_subjects", """
SELECT user_id, count(*) AS dupe_count FROM events GROUP BY user_id HAVING count(*) > 1""")
def q_repeated_subjects(spark, sf_dir):
    return repeated_keys(table(spark, sf_dir, "events"), ["user_id"])


@query("q_number_repeats", """
SELECT event_id, user_id, row_number() OVER (
  PARTITION BY user_id ORDER BY md5(CAST(event_id AS VARCHAR))) AS occurrence FROM events""")
def q_number_repeats(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return number_repeats(events, "user_id", ["event_id"])


@query("q_melt_long", """
SELECT subject_id, feature, value FROM (
  SELECT p_partkey AS subject_id, p_brand, CASE WHEN p_size <= 10 THEN NULL ELSE p_type END AS p_type,
         CAST(p_size AS VARCHAR) AS p_size FROM part)
UNPIVOT INCLUDE NULLS (value FOR feature IN (p_brand, p_type, p_size))""")
def q_melt_long(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("subject_id"), "p_brand",
        F.when(F.col("p_size") > 10, F.col("p_type")).alias("p_type"), "p_size")
    return to_long(part, ["subject_id"])


def _customer_gaps(spark, sf_dir) -> DataFrame:
    """Customers beside their activity, with gaps where there is none."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("subject_id"), "c_mktsegment", "c_acctbal")
    activity = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("subject_id")).agg(
        F.count(F.lit(1)).alias("n_events"), F.max("value").alias("max_value"))
    return customers.join(activity, "subject_id", "full")


GAPS_SQL = """
  SELECT coalesce(c.c_custkey, e.user_id) AS subject_id, c_mktsegment, c_acctbal, n_events, max_value
  FROM customer c FULL JOIN (SELECT user_id, count(*) AS n_events, max(value) AS max_value
                             FROM events GROUP BY user_id) e ON c.c_custkey = e.user_id"""


def _na_counts_sql(dataset: str, source: str, features: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{f}' AS feature, md5('{dataset}_{f}') AS data_feature_hash,"
        f" count(*) - count({f}) AS na_count, count({f}) AS have_data FROM {source}"
        for f in features)


@query("q_na_counts", f"""
WITH merged AS ({GAPS_SQL}) {_na_counts_sql(
    "activity", "merged", ["c_mktsegment", "c_acctbal", "n_events", "max_value"])}""")
def q_na_counts(spark, sf_dir):
    return na_counts(_customer_gaps(spark, sf_dir), "activity", "subject_id")


@query("q_features_with_gaps", f"""
WITH merged AS ({GAPS_SQL}), counts AS ({_na_counts_sql(
    "activity", "merged", ["c_mktsegment", "c_acctbal", "n_events", "max_value"])})
SELECT dataset, feature, na_count FROM counts WHERE na_count > 0""")
def q_features_with_gaps(spark, sf_dir):
    counts = na_counts(_customer_gaps(spark, sf_dir), "activity", "subject_id")
    return features_with_gaps(counts).select("dataset", "feature", "na_count")


@query("q_feature_hash", """
WITH pairs AS (SELECT DISTINCT lang AS dataset, source AS feature FROM documents)
SELECT dataset, feature, md5(dataset || '_' || feature) AS data_feature_hash FROM pairs""")
def q_feature_hash(spark, sf_dir):
    pairs = table(spark, sf_dir, "documents").select(
        F.col("lang").alias("dataset"), F.col("source").alias("feature")).distinct()
    return pairs.withColumn(
        "data_feature_hash", feature_hash(F.col("dataset"), F.col("feature")))


ORDER_CELLS_SQL = """
  SELECT o_orderkey, CASE
    WHEN o_orderpriority LIKE '1%' THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate)
    WHEN o_orderpriority LIKE '2%' THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || (year(o_orderdate) % 100) || ' 10:30'
    WHEN o_orderpriority LIKE '3%' THEN day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate)
    WHEN o_orderpriority LIKE '4%' THEN '-?' ELSE o_orderstatus END AS cell FROM orders"""


def _order_cells(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    year, month, day = (f(F.col("o_orderdate")).cast("string") for f in (
        F.year, F.month, F.dayofmonth))
    short = (F.year("o_orderdate") % 100).cast("string")
    kind = F.substring("o_orderpriority", 1, 1)
    return orders.select("o_orderkey", (
        F.when(kind == "1", F.concat_ws("/", month, day, year))
        .when(kind == "2", F.concat(F.concat_ws("/", month, day, short), F.lit(" 10:30")))
        .when(kind == "3", F.concat_ws("/", day, month, year))
        .when(kind == "4", "-?").otherwise(F.col("o_orderstatus"))).alias("cell"))


@query("q_date_like", rf"""
WITH cells AS ({ORDER_CELLS_SQL}), parts AS (
  SELECT o_orderkey, cell, regexp_extract(cell, '^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{1,4}})', 1) AS m,
         regexp_extract(cell, '^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{1,4}})', 2) AS d,
         regexp_extract(cell, '^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{1,4}})', 3) AS y FROM cells)
SELECT o_orderkey, cell, m <> '' AND try_cast(
  lpad(y, 4, '0') || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') AS DATE) IS NOT NULL AS is_date
FROM parts""")
def q_date_like(spark, sf_dir):
    return _order_cells(spark, sf_dir).withColumn("is_date", is_us_date(F.col("cell")))


@query("q_symbol_only", f"""
WITH cells AS ({ORDER_CELLS_SQL})
SELECT o_orderkey, cell FROM cells WHERE NOT regexp_matches(cell, '[A-Za-z0-9]')""")
def q_symbol_only(spark, sf_dir):
    return _order_cells(spark, sf_dir).filter(is_symbol_only(F.col("cell")))


PART_COPIES_SQL = """
  SELECT p_partkey AS subject_id, feature, position, number FROM (
    SELECT p_partkey, 'size' AS feature, 0 AS position, round(CAST(p_size AS DOUBLE), 2) AS number FROM part
    UNION ALL SELECT p_partkey, 'size', 1, round(CAST(CASE WHEN p_size > 10 THEN p_size END AS DOUBLE), 2) FROM part
    UNION ALL SELECT p_partkey, 'size', 2, round(CAST(p_size + 1 AS DOUBLE), 2) FROM part
    UNION ALL SELECT p_partkey, 'price', 0, round(p_retailprice, 2) FROM part
    UNION ALL SELECT p_partkey, 'price', 1, round(p_retailprice * 2, 2) FROM part)
  WHERE number IS NOT NULL"""


def _part_copies(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").alias("size"),
        F.when(F.col("p_size") > 10, F.col("p_size")).alias("size_2"),
        (F.col("p_size") + 1).alias("size_3"), F.col("p_retailprice").alias("price"),
        (F.col("p_retailprice") * 2).alias("price_2"))
    return copies_to_long(
        part, "p_partkey", {"size": ["size", "size_2", "size_3"], "price": ["price", "price_2"]},
        {"size", "price"})


@query("q_duplicate_columns", f"""
WITH cells AS ({PART_COPIES_SQL}), groups AS (
  SELECT feature, subject_id, number, count(*) AS n FROM cells GROUP BY ALL), totals AS (
  SELECT feature, CAST(sum(n) AS BIGINT) AS cells,
         CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS dup_cells FROM groups GROUP BY feature)
SELECT feature, cells, dup_cells, CASE WHEN dup_cells > 0.2 * cells THEN 'duplicated_data'
  ELSE 'duplicated_column_names' END AS verdict FROM totals""")
def q_duplicate_columns(spark, sf_dir):
    return classify_duplicates(_part_copies(spark, sf_dir))


@query("q_dedupe_survivor", f"""
WITH cells AS ({PART_COPIES_SQL}), ranked AS (
  SELECT feature, position, row_number() OVER (
    PARTITION BY feature, subject_id ORDER BY number, position) AS rn FROM cells)
SELECT DISTINCT feature, CAST(position AS INTEGER) AS position FROM ranked WHERE rn = 1""")
def q_dedupe_survivor(spark, sf_dir):
    return surviving_copies(_part_copies(spark, sf_dir)).select("feature", "position")


def _shared_names(spark, sf_dir) -> DataFrame:
    """NA counts of three tables that share feature names."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nationkey"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"), "c_mktsegment")
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    nation = table(spark, sf_dir, "nation").select("n_name", F.col("n_nationkey").alias("nationkey"))
    return reduce(DataFrame.unionByName, [
        na_counts(customer, "customer", "c_custkey"), na_counts(supplier, "supplier", "s_suppkey"),
        na_counts(nation, "nation", "n_name")])


SHARED_SQL = " UNION ALL ".join([
    _na_counts_sql("customer", """(SELECT c_nationkey AS nationkey,
      CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal, c_mktsegment FROM customer)""",
                   ["nationkey", "acctbal", "c_mktsegment"]),
    _na_counts_sql("supplier", "(SELECT s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier)",
                   ["nationkey", "acctbal"]),
    _na_counts_sql("nation", "(SELECT n_nationkey AS nationkey FROM nation)", ["nationkey"])])


@query("q_mark_duplicated", f"""
WITH counts AS ({SHARED_SQL})
SELECT *, count(*) OVER (PARTITION BY trim(feature)) > 1 AS duplicated_feature FROM counts""")
def q_mark_duplicated(spark, sf_dir):
    return mark_duplicated(_shared_names(spark, sf_dir))


@query("q_rename_across", f"""
WITH counts AS ({SHARED_SQL}), placed AS (
  SELECT dataset, feature, have_data, count(*) OVER (PARTITION BY feature) AS copies,
         row_number() OVER (PARTITION BY feature ORDER BY have_data DESC, dataset) AS place FROM counts)
SELECT dataset, feature, have_data, CASE WHEN place = 1 THEN feature ELSE feature || '_' || place END
  AS new_feature_name FROM placed WHERE copies > 1""")
def q_rename_across(spark, sf_dir):
    return rename_across_datasets(_shared_names(spark, sf_dir))


@query("q_rename_clash", """
SELECT 'customer' AS dataset, 'acctbal' AS feature, count(c_acctbal) AS have_data, 'acctbal' AS new_feature_name FROM customer
UNION ALL SELECT 'supplier', 'acctbal', count(s_acctbal), 'acctbal_3' FROM supplier""")
def q_rename_clash(spark, sf_dir):
    """The name that the second copy would get belongs to a third dataset."""
    counts = na_counts(table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("acctbal")), "customer")
    for name, column, feature in (("supplier", "s_acctbal", "acctbal"), ("nation", "n_regionkey", "acctbal_2")):
        counts = counts.unionByName(na_counts(table(spark, sf_dir, name).select(F.col(column).alias(feature)), name))
    return rename_across_datasets(counts)


@query("q_dupes_null_keys", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS o_custkey FROM orders)
SELECT * FROM (SELECT o_custkey, o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS dupe_count FROM o)
WHERE dupe_count > 1""")
def q_dupes_null_keys(spark, sf_dir):
    """Orders whose customer occurs more than once; missing customers are equal."""
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("o_custkey"), "o_orderkey")
    return get_dupes(orders, ["o_custkey"])

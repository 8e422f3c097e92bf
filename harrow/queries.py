"""Registered queries: each operator over the whole driver tables, with its DuckDB SQL.

Facts are made of the tables' own columns; rules are short literal tables.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.functions import numbers, text
from harrow.operators import duplicates, frames, lists, pairs, places, reshape, summaries, units, validate
from harrow.plans import diagnostics
from harrow.rules.apply import apply_group
from harrow.rules.stage import run_stage
from harrow.rules.table import groups, rule_file
from harrow.settings import RULE_COLUMNS, STAGE_ORDER
from harrow.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_NORM = "trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9;,:()\\[\\]]+', ' ', 'g'))"
_CELL = "nullif(array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split({0}, ';'), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))), lambda x: x <> ''))), '; '), '')"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- facts made of the tables

_UNITS = "CASE l_linenumber % 4 WHEN 0 THEN '1000 kg' WHEN 1 THEN '1,000 head' WHEN 2 THEN 'Celsius' ELSE 'crate' END"
_LINE_FACTS = f"SELECT l_orderkey, l_linenumber, p_brand AS commodity, {_UNITS} AS unit, l_quantity AS value FROM lineitem JOIN part ON l_partkey = p_partkey"
CONVERSIONS = [
    {"commodity_key": "#ALL#", "unit_source": "kg", "unit_target": "tonne", "unit_factor": "0.001", "unit_offset": "0", "source_rule_file": "u.xlsx"},
    {"commodity_key": "Brand#11", "unit_source": "1000 kg", "unit_target": "sack", "unit_factor": "20", "unit_offset": "0", "source_rule_file": "u.xlsx"},
    {"commodity_key": "Brand#12", "unit_source": "kg", "unit_target": "g", "unit_factor": "1000", "unit_offset": "0", "source_rule_file": "u.xlsx"},
    {"commodity_key": "#ALL#", "unit_source": "celsius", "unit_target": "fahrenheit", "unit_factor": "1.8", "unit_offset": "32", "source_rule_file": "u.xlsx"},
    {"commodity_key": "#ALL#", "unit_source": "bushel", "unit_target": "tonne", "unit_factor": "0.02", "unit_offset": "0", "source_rule_file": "u.xlsx"},
]


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    unit = F.when(F.col("l_linenumber") % 4 == 0, "1000 kg").when(F.col("l_linenumber") % 4 == 1, "1,000 head").when(F.col("l_linenumber") % 4 == 2, "Celsius").otherwise("crate")
    return line.join(part, line["l_partkey"] == part["p_partkey"]).select("l_orderkey", "l_linenumber", F.col("p_brand").alias("commodity"), unit.alias("unit"), F.col("l_quantity").alias("value"))


# the SQL of the units: which of a row's units has a rule, and the conversion by commodity, then by unit
_MATCHED = f"""
facts AS ({_LINE_FACTS}),
rules(c, u, target, factor, off) AS (VALUES ('all', 'kg', 'tonne', 0.001::DOUBLE, 0::DOUBLE), ('brand 11', '1000 kg', 'sack', 20, 0), ('brand 12', 'kg', 'g', 1000, 0), ('all', 'celsius', 'fahrenheit', 1.8, 32), ('all', 'bushel', 'tonne', 0.02, 0)),
keyed AS (
  SELECT *, {_NORM.format('commodity')} AS ck, {_NORM.format('unit')} AS own,
         CASE WHEN unit LIKE '1%' THEN 1000.0 ELSE 1.0 END AS number,
         CASE WHEN unit LIKE '1%' THEN split_part(unit, ' ', 2) ELSE unit END AS base
  FROM facts
), folded AS (
  SELECT *, number <> 1 AND NOT EXISTS (SELECT 1 FROM rules r WHERE r.u = own AND r.c IN (ck, 'all')) AS fold FROM keyed
), scaled AS (
  SELECT *, CASE WHEN fold THEN value * number ELSE value END AS v, CASE WHEN fold THEN base ELSE unit END AS u0,
         CASE WHEN fold THEN {_NORM.format('base')} ELSE own END AS key, CASE WHEN fold THEN number ELSE 1.0 END AS prefix
  FROM folded
), matched AS (
  SELECT s.*, coalesce(a.target, b.target) AS target, CASE WHEN a.target IS NOT NULL THEN a.factor ELSE b.factor END AS factor,
         CASE WHEN a.target IS NOT NULL THEN a.off ELSE b.off END AS off, CASE WHEN a.target IS NOT NULL THEN ck WHEN b.target IS NOT NULL THEN 'all' END AS rule
  FROM scaled s LEFT JOIN rules a ON a.c = s.ck AND a.u = s.key LEFT JOIN rules b ON b.c = 'all' AND b.u = s.key
)"""


@query(f"WITH {_MATCHED} SELECT l_orderkey, l_linenumber, commodity, coalesce(target, u0) AS unit, round(CASE WHEN target IS NOT NULL THEN v * factor + off ELSE v END, 6) AS value FROM matched")
def standardize_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = units.standardize(line_facts(spark, sf_dir), units.prepare_conversions(CONVERSIONS))
    return result.data.withColumn("value", F.round("value", 6))


@query(f"""WITH {_MATCHED} SELECT rule AS rule_commodity_match_key, ck AS applied_commodity_match_key, key AS unit_source_key, unit AS source_unit_raw, factor AS rule_multiplier,
  prefix::DOUBLE AS detected_prefix, count(*) AS affected_rows, factor * prefix AS unit_factor_effective FROM matched WHERE target IS NOT NULL GROUP BY ALL""")
def standardize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.standardize(line_facts(spark, sf_dir), units.prepare_conversions(CONVERSIONS)).counts


@query("""SELECT 0::BIGINT AS affected_rows, 'sizes.xlsx' AS rule_file_identifier, '#ALL#' AS commodity_key, 'box of ' || k AS unit_source, 'piece' AS unit_target, k::DOUBLE AS unit_factor, 0::DOUBLE AS unit_offset,
  NULL::VARCHAR AS source_unit_raw, NULL::DOUBLE AS detected_prefix, NULL::DOUBLE AS unit_factor_effective
FROM (SELECT unnest(range(2, 80)) AS k) WHERE k NOT IN (SELECT p_size FROM part WHERE p_size IS NOT NULL)""")
def standardize_unmatched_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions of boxes of all sizes that no part has."""
    rules = units.prepare_conversions([{"commodity_key": "#ALL#", "unit_source": f"box of {k}", "unit_target": "piece", "unit_factor": str(k), "unit_offset": "0", "source_rule_file": "sizes.xlsx"} for k in range(2, 80)])
    facts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("commodity"), F.concat(F.lit("Box of "), F.col("p_size").cast("string")).alias("unit"), F.col("p_retailprice").alias("value"))
    counts = units.standardize(facts, rules).counts
    matched = summaries.summarize_standardize(units.standardize_audit(rules, counts))
    return summaries.unmatched_standardize(summaries.standardize_catalog(spark, rules), matched, counts)


@query(f"""WITH {_MATCHED}, data AS (SELECT commodity, coalesce(target, u0) AS unit, CASE WHEN target IS NOT NULL THEN v * factor + off ELSE v END AS value FROM matched)
SELECT commodity, unit, round(sum(value), 4) AS value FROM data GROUP BY commodity, unit""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts through canonical cells, unit standardization, duplicate summing and canonical order."""
    facts = line_facts(spark, sf_dir).drop("l_orderkey", "l_linenumber")
    data, _, _ = units.standardize_layer(frames.canonical_cells(facts), units.prepare_conversions(CONVERSIONS))
    return frames.canonical_order(data.withColumn("value", F.round("value", 4)))


# ---------------------------------------------------------------- text and cells


@query(f"SELECT doc_id, {_NORM.format('text')} AS normalized FROM documents")
def text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize(F.col("text")).alias("normalized"))


_CELLS = "l_returnflag || '; ' || l_linestatus || ';' || l_returnflag || ' ;; ' || CAST(l_linenumber % 3 AS VARCHAR)"


def _cells(line: DataFrame) -> DataFrame:
    cell = F.concat("l_returnflag", F.lit("; "), "l_linestatus", F.lit(";"), "l_returnflag", F.lit(" ;; "), (F.col("l_linenumber") % 3).cast("string"))
    return line.select("l_orderkey", "l_linenumber", cell.alias("cell"))


@query(f"SELECT l_orderkey, l_linenumber, {_CELL.format(_CELLS)} AS cell FROM lineitem")
def canonical_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.canonical_cells(_cells(table(spark, sf_dir, "lineitem")))


@query(f"SELECT l_orderkey, l_linenumber, unnest(list_sort(list_distinct(list_filter(list_transform(string_split({_CELLS}, ';'), lambda x: trim(x)), lambda x: x <> '')))) AS token FROM lineitem")
def cell_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(table(spark, sf_dir, "lineitem")).select("l_orderkey", "l_linenumber", F.explode(text.tokens(F.col("cell"))).alias("token"))


@query("SELECT event_id, TRY_CAST(regexp_extract(props, ':\\s*([^}]*)}', 1) AS DOUBLE) AS parsed, CAST(value AS DOUBLE) AS value FROM events")
def parse_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.regexp_extract("props", r":\s*([^}]*)}", 1)
    return table(spark, sf_dir, "events").select("event_id", numbers.parse_double(raw).alias("parsed"), "value")


@query("SELECT l_orderkey, l_linenumber, format('{:.15g}', l_extendedprice * (1 - l_discount)) AS shown FROM lineitem")
def format_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", numbers.format_double(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("shown"))


# ---------------------------------------------------------------- shape

_NATION_WIDE = """SELECT c_nationkey, c_mktsegment AS unit,
  max(CASE WHEN year(o_orderdate) = 1994 THEN o_orderpriority END) AS "1994", max(CASE WHEN year(o_orderdate) = 1995 THEN o_orderpriority END) AS "1995", max(CASE WHEN year(o_orderdate) = 1900 THEN o_orderpriority END) AS "1900"
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    of = lambda y: F.max(F.when(F.year("o_orderdate") == y, F.col("o_orderpriority"))).alias(str(y))
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).groupBy("c_nationkey", F.col("c_mktsegment").alias("unit")).agg(of(1994), of(1995), of(1900))


@query(f"""WITH w AS ({_NATION_WIDE}) SELECT c_nationkey, unit, '1994' AS year, "1994" AS value FROM w
UNION ALL SELECT c_nationkey, unit, '1995', "1995" FROM w UNION ALL SELECT c_nationkey, unit, '1900', "1900" FROM w""")
def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.to_long(_wide(spark, sf_dir))


@query(f"""WITH w AS ({_NATION_WIDE}) SELECT * FROM (UNPIVOT w ON "1994", "1995", "1900" INTO NAME year VALUE value)""")
def drop_null_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.drop_null_values(reshape.to_long(_wide(spark, sf_dir)))


@query("""SELECT NULL::VARCHAR AS hemisphere, NULL::VARCHAR AS continent, 'iso-' || year AS iso_whep, polity, NULL::VARCHAR AS commodity, NULL::VARCHAR AS variable, NULL::VARCHAR AS unit, year, value,
  NULL::VARCHAR AS notes, NULL::VARCHAR AS footnotes, NULL::VARCHAR AS yearbook, NULL::VARCHAR AS file, segment FROM (
  SELECT c_name AS polity, CAST(c_nationkey AS VARCHAR) AS year, c_acctbal AS value, c_mktsegment AS segment FROM customer
  UNION ALL SELECT s_name, CASE WHEN s_nationkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) END, s_acctbal, NULL FROM supplier)""")
def consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_name").alias("polity"), F.col("c_nationkey").cast("string").alias("year"), F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("segment"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("value"), F.col("s_name").alias("polity"), F.when(F.col("s_nationkey") % 2 == 0, F.col("s_nationkey").cast("string")).alias("year"))
    return frames.consolidate([customer, supplier])


@query(f"""SELECT page_id, {_NORM.format("regexp_extract(url, '://([^/]*)', 1)")} AS polity, 'main' AS commodity, NULL::VARCHAR AS continent, NULL::VARCHAR AS footnotes, url AS unit FROM pages""")
def normalize_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^/]*)", 1).alias("polity"), F.col("url").alias("unit"))
    return reshape.normalize_keys(pages, "Main!")


_NAMES = "'http://x/' || split_part(p_name, ' ', 1) || '_' || CASE WHEN p_size % 3 = 0 THEN CAST(1900 + p_size AS VARCHAR) ELSE 'n' END || '_a_b_c' || CASE WHEN p_size % 2 = 0 THEN '_' || p_brand || '_x.xlsx' ELSE '.csv' END"


@query(f"""WITH f AS (SELECT p_partkey, {_NAMES} AS file_path, p_size, p_brand, split_part(p_name, ' ', 1) AS first FROM part)
SELECT p_partkey, file_path, split_part(file_path, '/', 4) AS file_name, CASE WHEN p_size % 2 = 0 THEN p_brand || '_x' END AS commodity,
  CASE WHEN p_size % 3 = 0 THEN first || '_' || CAST(1900 + p_size AS VARCHAR) END AS yearbook, true AS is_ascii, NULL::VARCHAR AS error_message FROM f""")
def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.when(F.col("p_size") % 3 == 0, (F.col("p_size") + 1900).cast("string")).otherwise("n")
    tail = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("_"), "p_brand", F.lit("_x.xlsx"))).otherwise(".csv")
    part = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("http://x/"), F.split("p_name", " ")[0], F.lit("_"), year, F.lit("_a_b_c"), tail).alias("file_path"))
    found = reshape.file_metadata(part.select("file_path")).distinct()
    return part.join(found, "file_path").select("p_partkey", *found.columns)


@query("SELECT doc_id FROM documents WHERE trim(coalesce(CASE WHEN source = 'src0' THEN ' ' ELSE source END, '')) <> '' OR trim(coalesce(CASE WHEN lang = 'en' THEN NULL ELSE lang END, '')) <> ''")
def base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("source") == "src0", " ").otherwise(F.col("source")).alias("source"), F.when(F.col("lang") != "en", F.col("lang")).alias("lang"))
    return reshape.non_blank_base_rows(docs, ("source", "lang")).select("doc_id")


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END AS notes FROM orders")
def drop_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without the columns that none has a value in: remarks on negative totals and on missing dates."""
    orders = table(spark, sf_dir, "orders")
    notes = F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderpriority"))
    wide = orders.select("o_orderkey", "o_orderstatus", notes.alias("notes"), F.when(F.col("o_totalprice") < 0, F.lit("negative")).alias("remark"), F.when(F.col("o_orderdate").isNull(), F.col("o_orderkey")).alias("undated"))
    return frames.drop_null_columns(wide)


@query("SELECT c_mktsegment AS commodity, c_name AS polity, c_acctbal AS value FROM customer")
def canonical_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.canonical_order(table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("commodity"), F.col("c_name").alias("polity"), F.col("c_acctbal").alias("value")))


@query("SELECT c_mktsegment AS commodity, c_name AS polity, row_number() OVER (ORDER BY c_name, c_mktsegment) AS place FROM customer")
def canonical_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place that the canonical order gives to each row."""
    facts = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("commodity"), F.col("c_name").alias("polity"))
    order = [F.col(c).asc_nulls_last() for c in ("polity", "commodity")]
    return places.row_numbers(facts, order, "place", Workspace(spark, "places"))


_SIZES = """facts AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 6 THEN 'big' WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_returnflag END AS file FROM lineitem),
firsts AS (SELECT file, min(l_orderkey * 10 + l_linenumber) AS f, count(*) AS n FROM facts GROUP BY file),
files AS (SELECT file, row_number() OVER (ORDER BY f) AS file_rank, coalesce(sum(n) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM firsts)"""


@query(f"""WITH {_SIZES}, numbered AS (SELECT facts.*, file_rank, before, row_number() OVER (PARTITION BY facts.file ORDER BY l_orderkey, l_linenumber) AS r FROM facts JOIN files ON facts.file IS NOT DISTINCT FROM files.file)
SELECT l_orderkey, l_linenumber, file_rank::BIGINT AS file_rank, r::BIGINT AS row_in_file, (before + r)::BIGINT AS global_row FROM numbered""")
def places_in_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of all lines, most of which lie in one file."""
    file = F.when(F.col("l_linenumber") <= 6, "big").when(F.col("l_orderkey") % 3 != 0, F.col("l_returnflag"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", file.alias("file"))
    rows = validate.numbered(lines, ["l_orderkey", "l_linenumber"], Workspace(spark, "places"))
    return rows.select("l_orderkey", "l_linenumber", F.col("_file_rank").alias("file_rank"), F.col("_row_in_file").alias("row_in_file"), F.col("_global_row").alias("global_row"))


# ---------------------------------------------------------------- validation and audit

_EVENT_FACTS = """SELECT event_id, event_type AS file, CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 77 = 0 THEN '' ELSE 'u' || CAST(user_id % 7 AS VARCHAR) END AS polity,
  CASE WHEN event_id % 40 = 0 THEN '1850' WHEN event_id % 41 = 0 THEN '1990-1980' WHEN event_id % 43 = 0 THEN '1990-2999' ELSE '2001' END AS year FROM events"""


def _event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda n: F.col("event_id") % n == 0
    polity = F.when(at(77) & ~at(50), "").when(~at(50), F.concat(F.lit("u"), (F.col("user_id") % 7).cast("string")))
    year = F.when(at(40), "1850").when(at(41), "1990-1980").when(at(43), "1990-2999").otherwise("2001")
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("file"), polity.alias("polity"), year.alias("year"))


_RANKED = f"""facts AS ({_EVENT_FACTS}), firsts AS (SELECT file, min(event_id) AS f, count(*) AS n FROM facts GROUP BY file),
files AS (SELECT file, row_number() OVER (ORDER BY f) AS file_rank, coalesce(sum(n) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM firsts),
numbered AS (SELECT facts.*, file_rank, row_number() OVER (PARTITION BY facts.file ORDER BY event_id) AS r, before + row_number() OVER (PARTITION BY facts.file ORDER BY event_id) AS g FROM facts JOIN files USING (file))"""


@query(f"""WITH {_RANKED} SELECT file_rank::BIGINT AS file_rank, 1::BIGINT AS type_rank, 1::BIGINT AS key_a, g::BIGINT AS key_b, 'missing mandatory value in document ''' || file || ''', row_id ''' || r || ''', column ''polity''' AS message FROM numbered WHERE polity IS NULL OR polity = ''""")
def validate_mandatory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_long(_event_facts(spark, sf_dir), ["event_id"], ("polity",), 2025)[1].where(f"type_rank = {validate.MANDATORY}")


@query(f"""WITH {_RANKED}, years AS (SELECT file_rank, year, min(g) AS g FROM numbered GROUP BY ALL)
SELECT file_rank::BIGINT AS file_rank, 2::BIGINT AS type_rank, g::BIGINT AS key_a, b::BIGINT AS key_b, message FROM (
  SELECT *, 1 AS b, 'year value ''' || year || ''' is outside plausible range [1900, 2026]' AS message FROM years WHERE year = '1850'
  UNION ALL SELECT *, 1, 'year range ''' || year || ''' has start year greater than end year' FROM years WHERE year = '1990-1980'
  UNION ALL SELECT *, 2, 'year range ''' || year || ''' contains year outside plausible range [1900, 2026]' FROM years WHERE year = '1990-2999')""")
def validate_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_long(_event_facts(spark, sf_dir), ["event_id"], ("polity",), 2025)[1].where(f"type_rank = {validate.YEAR}")


@query(f"""WITH {_RANKED} SELECT min(file_rank)::BIGINT AS file_rank, 3::BIGINT AS type_rank, min(g)::BIGINT AS key_a, 1::BIGINT AS key_b,
  'duplicate entries detected (count ' || count(*) || ') for polity = ' || coalesce(polity, 'NA') || ', year = ' || year || ', file = ' || file AS message FROM numbered GROUP BY polity, year, file HAVING count(*) > 1""")
def validate_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_long(_event_facts(spark, sf_dir), ["event_id"], ("polity",), 2025)[1].where(f"type_rank = {validate.DUPLICATE}")


@query(f"""WITH f AS ({_EVENT_FACTS}) SELECT event_id AS row_index, 'polity' AS audit_column, 'character_non_empty' AS audit_type, 'value must be a non-empty character string' AS audit_message FROM f WHERE coalesce(trim(polity), '') = ''
UNION ALL SELECT event_id, 'year', 'numeric_string', 'value must be a numeric string' FROM f WHERE year IS NOT NULL AND NOT regexp_full_match(year, '[0-9]+(\\.[0-9]+)?')""")
def audit_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.audit_findings(_event_facts(spark, sf_dir), "event_id", {"character_non_empty": ["polity"], "numeric_string": ["year"]})


# ---------------------------------------------------------------- repeated facts


def _line_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", F.when(F.col("l_tax") > 0.02, F.col("l_quantity")).alias("value"))


_LINE_VALUES = "SELECT l_partkey, l_returnflag, CASE WHEN l_tax > 0.02 THEN l_quantity END AS value FROM lineitem"


@query(f"WITH f AS ({_LINE_VALUES}) SELECT l_partkey, l_returnflag, sum(value) AS value FROM f GROUP BY ALL")
def sum_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.sum_duplicates(_line_values(spark, sf_dir))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, sum(v) AS value
FROM (SELECT *, l_extendedprice / 7.0 * CASE l_linenumber % 3 WHEN 0 THEN 1e-18 WHEN 1 THEN 1.0 ELSE 1e-3 END AS v FROM lineitem) GROUP BY ALL""")
def sum_fine_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate summing of values that have no short decimal form, tiny ones among them."""
    scale = F.when(F.col("l_linenumber") % 3 == 0, 1e-18).when(F.col("l_linenumber") % 3 == 1, 1.0).otherwise(1e-3)
    facts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", (F.col("l_extendedprice") / 7.0 * scale).alias("value"))
    return duplicates.sum_duplicates(facts)


@query(f"WITH f AS ({_LINE_VALUES}) SELECT * FROM f QUALIFY count(*) OVER (PARTITION BY l_partkey, l_returnflag) > 1")
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_rows(_line_values(spark, sf_dir))


@query(f"WITH f AS ({_LINE_VALUES}) SELECT *, count(*) OVER (PARTITION BY l_partkey, l_returnflag, value) > 1 AS dup_full, true AS dup_excl_value FROM f QUALIFY count(*) OVER (PARTITION BY l_partkey, l_returnflag) > 1")
def duplicate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_audit(_line_values(spark, sf_dir))


# ---------------------------------------------------------------- rules


def _rules(rows: list[tuple], source: str = "commodity", target: str = "unit", name: str = "rules.csv"):
    fields = ("value_source_raw", "value_source", "value_target_raw", "value_target")
    return rule_file(name, list(RULE_COLUMNS), [{"column_source": source, "column_target": target} | dict(zip(fields, r)) for r in rows], "clean")


def _order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.concat("o_orderstatus", F.lit("; x")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.lower("o_orderpriority").alias("commodity"), status.alias("unit"))


_ORDER_CELLS = "SELECT o_orderkey, lower(o_orderpriority) AS commodity, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus || '; x' END AS unit FROM orders"


def _grouped(spark: SparkSession, sf_dir: str, rows: list[tuple]) -> DataFrame:
    return apply_group(_order_cells(spark, sf_dir), groups(_rules(rows))[0], Workspace(spark, "rules")).data


@query(f"""WITH f AS ({_ORDER_CELLS}), h AS (SELECT *, commodity = '1-urgent' AND unit LIKE 'O;%' AS hit FROM f)
SELECT o_orderkey, CASE WHEN hit THEN 'Now' ELSE commodity END AS commodity, CASE WHEN hit THEN 'open; x' ELSE unit END AS unit FROM h""")
def rule_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped(spark, sf_dir, [("1 URGENT", "Now", "o", "open")])


@query(f"""WITH f AS ({_ORDER_CELLS}), h AS (SELECT *, commodity = '2-high' AND unit = 'F; x' AS hit FROM f)
SELECT o_orderkey, CASE WHEN hit THEN 'High' ELSE commodity END AS commodity, CASE WHEN hit THEN 'done' ELSE unit END AS unit FROM h""")
def rule_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped(spark, sf_dir, [("#EXACT#2-HIGH", "High", "#exact# f; X", "done")])


@query(f"WITH f AS ({_ORDER_CELLS}) SELECT o_orderkey, commodity || '; seen' AS commodity, CASE WHEN unit IS NULL THEN 'any' ELSE split_part(unit, ';', 1) || '; any; x' END AS unit FROM f")
def rule_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped(spark, sf_dir, [("#ANY#", "seen", "#ANY#", "any")])


@query(f"WITH f AS ({_ORDER_CELLS}) SELECT o_orderkey, commodity, CASE WHEN commodity = '5-low' THEN 'a; b; c' ELSE unit END AS unit FROM f")
def rule_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped(spark, sf_dir, [("5-low", "5-low", "#REPLACE#", "c; b"), ("#EXACT#5-low", "5-low", "#REPLACE#", "a")])


@query(f"WITH f AS ({_ORDER_CELLS}) SELECT o_orderkey, CASE WHEN commodity = '3-medium' AND unit IS NULL THEN NULL ELSE commodity END AS commodity, CASE WHEN commodity = '3-medium' AND unit IS NULL THEN 'none' ELSE unit END AS unit FROM f")
def rule_null_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped(spark, sf_dir, [("3-medium", None, None, "none")])


@query(f"WITH f AS ({_ORDER_CELLS}) SELECT o_orderkey, CASE WHEN commodity = '1-urgent' AND unit IS NOT NULL THEN 'first' ELSE commodity END AS commodity, CASE WHEN commodity = '1-urgent' THEN replace(unit, '; x', '; won') ELSE unit END AS unit FROM f")
def rule_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped(spark, sf_dir, [("1-urgent", "first", "x", "won"), ("1-urgent ", "second", "x ", "lost")])


@query(f"""WITH f AS ({_ORDER_CELLS}) SELECT o_orderkey, commodity, array_to_string(list_sort(list_distinct(list_concat(CASE WHEN unit IS NULL THEN [] ELSE string_split(unit, '; ') END, CASE WHEN commodity = '4-not specified' THEN ['b', 'a'] ELSE [] END))), '; ') AS notes
FROM f WHERE unit IS NOT NULL OR commodity = '4-not specified' UNION ALL SELECT o_orderkey, commodity, NULL FROM f WHERE unit IS NULL AND commodity <> '4-not specified'""")
def rule_concatenate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _order_cells(spark, sf_dir).withColumnRenamed("unit", "notes")
    return apply_group(df, groups(_rules([("4-not specified", "4-not specified", "#ANY#", "b; a")], target="notes"))[0], Workspace(spark, "rules")).data


_MOSTLY_NULL = "SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 10 = 0 THEN l_returnflag END AS commodity, CASE WHEN l_orderkey % 10 = 0 THEN l_partkey::VARCHAR || ';x' END AS unit FROM lineitem"


@query(f"""WITH f AS ({_MOSTLY_NULL}) SELECT l_orderkey, l_linenumber, CASE WHEN commodity IS NULL THEN 'none' WHEN commodity = 'A' THEN 'by air' ELSE commodity END AS commodity,
  CASE WHEN commodity = 'A' THEN replace(unit, ';x', '; y') ELSE unit END AS unit FROM f""")
def rule_hot_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewrites of lines, nine tenths of which have the same pair of null cells."""
    rare = F.col("l_orderkey") % 10 == 0
    cells = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(rare, F.col("l_returnflag")).alias("commodity"), F.when(rare, F.concat(F.col("l_partkey").cast("string"), F.lit(";x"))).alias("unit"))
    return apply_group(cells, groups(_rules([("a", "by air", "x", "y"), (None, "none", None, None)]))[0], Workspace(spark, "rules")).data


_CHAIN = [("1-urgent", "2-high", "x", "x"), ("2-high", "done", "x", "x")]


@query(f"WITH f AS ({_ORDER_CELLS}) SELECT o_orderkey, CASE WHEN commodity IN ('1-urgent', '2-high') AND unit IS NOT NULL THEN 'done' ELSE commodity END AS commodity, unit FROM f")
def rule_fixpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stage(_order_cells(spark, sf_dir), [_rules(_CHAIN)], "clean", Workspace(spark, "stage")).data


@query(f"""WITH f AS ({_ORDER_CELLS}), n AS (SELECT count_if(commodity = '1-urgent') AS u, count_if(commodity = '2-high') AS h FROM f WHERE unit IS NOT NULL)
SELECT loop, affected_rows, 'rules.csv' AS rule_file_identifier, 'commodity' AS column_source, s AS value_source_raw, t AS value_source, 'unit' AS column_target, 'x' AS value_target_raw, 'x' AS value_target FROM (
  SELECT 1::BIGINT AS loop, u::BIGINT AS affected_rows, '1-urgent' AS s, '2-high' AS t FROM n UNION ALL SELECT 1, h::BIGINT, '2-high', 'done' FROM n UNION ALL SELECT 2, u::BIGINT, '2-high', 'done' FROM n)""")
def rule_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = run_stage(_order_cells(spark, sf_dir), [_rules(_CHAIN)], "clean", Workspace(spark, "stage"))
    return summaries.summarize_stage(result.audit)


@query("""WITH owing AS (SELECT DISTINCT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal < 0)
SELECT 'nations.csv' AS rule_file_identifier, 'commodity' AS column_source, n_name AS value_source_raw, lower(n_name) AS value_source, 'unit' AS column_target, NULL::VARCHAR AS value_target_raw, n_regionkey::VARCHAR AS value_target,
  0::BIGINT AS loop, 0::BIGINT AS affected_rows FROM nation WHERE n_name NOT IN (SELECT n_name FROM owing)""")
def unmatched_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules for all nations that no supplier in debt comes from."""
    nation = table(spark, sf_dir, "nation")
    file = _rules([(r["n_name"], r["n_name"].lower(), None, str(r["n_regionkey"])) for r in nation.collect()], name="nations.csv")  # 25 rules
    suppliers = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    facts = suppliers.select("s_suppkey", F.when(F.col("s_acctbal") < 0, F.col("n_name")).alias("commodity"), F.lit(None).cast("string").alias("unit"))
    result = run_stage(facts, [file], "clean", Workspace(spark, "stage"))
    return summaries.unmatched_rules(summaries.rule_catalog(spark, [file]), summaries.summarize_stage(result.audit))


@query(f"""WITH f AS ({_ORDER_CELLS}), n AS (SELECT count(*) AS rows, count_if(commodity = '1-urgent' AND unit IS NOT NULL) AS u, count_if(commodity = '2-high' AND unit IS NOT NULL) AS h, count_if(unit IS NULL) AS nulls,
    sum(strlen(commodity)) AS c0, sum(strlen(unit)) AS t0 FROM f),
k AS (SELECT *, u + h AS first, u AS second, u + h + u AS matched FROM n)
SELECT 'clean' AS layer, kind, pass_index::BIGINT AS pass_index, item, "count"::BIGINT AS "count", text FROM (
  SELECT 'layer' AS kind, NULL AS pass_index, 'rows' AS item, rows AS "count", NULL AS text FROM k UNION ALL SELECT 'layer', NULL, 'matched_count', matched, NULL FROM k UNION ALL SELECT 'layer', NULL, 'unmatched_count', greatest(rows - matched, 0), NULL FROM k
  UNION ALL SELECT 'layer', NULL, 'status', NULL, 'pass' UNION ALL SELECT 'layer', NULL, 'stop_reason', NULL, 'converged_zero_change' UNION ALL SELECT 'layer', NULL, 'passes_executed', 3, NULL
  UNION ALL SELECT 'message', 1, NULL, NULL, 'Rules applied successfully'
  UNION ALL SELECT 'message', 2, NULL, NULL, '[clean stage] multi-pass stop_reason=converged_zero_change; passes_executed=3; max_passes=10; enabled=true.'
  UNION ALL SELECT 'pass', 1, 'changed_value_count', first, NULL FROM k UNION ALL SELECT 'pass', 2, 'changed_value_count', second, NULL FROM k UNION ALL SELECT 'pass', 3, 'changed_value_count', 0, NULL
  UNION ALL SELECT 'pass', 1, 'matched_count', first, NULL FROM k UNION ALL SELECT 'pass', 2, 'matched_count', second, NULL FROM k UNION ALL SELECT 'pass', 3, 'matched_count', 0, NULL
  UNION ALL SELECT 'pass', unnest([1, 2, 3]), 'audit_rows', unnest([2, 1, 0]), NULL UNION ALL SELECT 'pass', unnest([1, 2, 3]), 'repeated_state_pass', unnest([NULL, NULL, 2]), NULL
  UNION ALL SELECT 'pass', unnest([1, 2, 3]), 'stop_reason', NULL, unnest(['continued', 'continued', 'converged_zero_change'])
  UNION ALL SELECT 'nulls', unnest([0, 1, 2, 3]), 'commodity', 0, NULL UNION ALL SELECT 'nulls', unnest([0, 1, 2, 3]), 'unit', nulls, NULL FROM k
  UNION ALL SELECT 'bytes', unnest([0, 1, 2, 3]), 'commodity', unnest([c0, c0 - 2 * u - 2 * h, c0 - 4 * u - 2 * h, c0 - 4 * u - 2 * h]), NULL FROM k UNION ALL SELECT 'bytes', unnest([0, 1, 2, 3]), 'unit', t0, NULL FROM k)""")
def stage_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a rule stage did: its figures, messages and passes, and the state of its columns after each pass."""
    result = run_stage(_order_cells(spark, sf_dir), [_rules(_CHAIN)], "clean", Workspace(spark, "stage"))
    return diagnostics.diagnostics_table(spark, diagnostics.stage_rows("clean", result))


@query(f"""WITH {_MATCHED}, n AS (SELECT count(*) AS rows, count(target) AS m, count_if(target IS NULL AND key <> '') AS u FROM matched),
d AS (SELECT count(*) AS after FROM (SELECT DISTINCT commodity, coalesce(target, u0) FROM matched))
SELECT 'standardize_units' AS layer, kind, pass_index::BIGINT AS pass_index, item, "count"::BIGINT AS "count", text FROM (
  SELECT 'layer' AS kind, NULL AS pass_index, unnest(['rows', 'matched_count', 'unmatched_count', 'applied_rules', 'rows_before_aggregation', 'rows_after_aggregation', 'collapsed_rows_count', 'aggregated_groups_count']) AS item,
    unnest([rows, m, u, 5, rows, after, rows - after, after]) AS "count", NULL AS text FROM n, d
  UNION ALL SELECT 'layer', NULL, 'status', NULL, 'pass' UNION ALL SELECT 'layer', NULL, 'rule_sources', NULL, 'u.xlsx' UNION ALL SELECT 'message', 1, NULL, NULL, 'Rules applied successfully')""")
def standardize_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the unit conversion and the summing after it did; the rows left are counted while they are written."""
    workspace, rules = Workspace(spark, "units"), units.prepare_conversions(CONVERSIONS)
    data, result, _ = units.standardize_layer(line_facts(spark, sf_dir).drop("l_orderkey", "l_linenumber"), rules, workspace=workspace)
    _, seen = pairs.observed(data, "normalize", workspace, rows=F.count(F.lit(1)))
    return diagnostics.diagnostics_table(spark, diagnostics.standardize_rows("standardize_units", result, rules, seen["rows"]))


@query(f"WITH f AS ({_ORDER_CELLS}) SELECT o_orderkey, commodity, unit, 'cycle_detected' AS stop_reason, '[clean stage] cycle detected at pass 2 (repeats pass 0).' AS message FROM f")
def rule_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rules that undo each other: the second pass brings back the first state, and the stage stops."""
    file = _rules([("1-urgent", "urgent", "x", "x"), ("urgent", "1-urgent", "x", "x")])
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        result = run_stage(_order_cells(spark, sf_dir), [file], "clean", Workspace(spark, "stage"))
    return result.data.withColumns({"stop_reason": F.lit(result.stop_reason), "message": F.lit(result.messages[-1])})


# ---------------------------------------------------------------- lists


@query("""SELECT DISTINCT 'unit' AS column_name, p_brand AS value FROM part UNION ALL SELECT DISTINCT 'commodity', CASE WHEN p_size > 5 THEN p_type END FROM part UNION ALL SELECT DISTINCT 'year', CAST(p_size AS VARCHAR) FROM part""")
def unique_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("unit"), F.when(F.col("p_size") > 5, F.col("p_type")).alias("commodity"), F.col("p_size").alias("year"))
    return lists.unique_values(part, ["unit", "commodity", "year"])


@query("""SELECT 'raw_clean_normalize' AS sheet, unnest(list_sort(list(DISTINCT c_mktsegment))) AS value FROM customer UNION ALL SELECT 'harmonize', unnest(list_sort(list(DISTINCT lower(c_mktsegment)))) FROM customer""")
def merged_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("commodity"))
    objects = {f"d_{x}": customer for x in ("raw", "clean", "normalize")} | {"d_harmonize": customer.select(F.lower("commodity").alias("commodity"))}
    return lists.merged_lists(lists.layer_tables(objects), ["commodity"], Workspace(spark, "lists")).rows.select("sheet", "value")


@query("""WITH layers AS (
  SELECT 'raw' AS layer, 'year' AS column_name, p_size::VARCHAR AS value, p_size::DOUBLE AS number FROM part UNION ALL SELECT 'raw', 'unit', CASE WHEN p_size > 3 THEN p_type END, NULL FROM part
  UNION ALL SELECT 'clean', 'year', p_size::VARCHAR, p_size FROM part UNION ALL SELECT 'clean', 'unit', p_type, NULL FROM part
  UNION ALL SELECT 'harmonize', 'year', (p_size % 7)::VARCHAR, p_size % 7 FROM part UNION ALL SELECT 'harmonize', 'unit', CASE WHEN p_size > 3 THEN p_type END, NULL FROM part
), named AS (SELECT DISTINCT column_name, CASE WHEN column_name = 'unit' AND layer <> 'clean' THEN 'raw_harmonize' WHEN column_name = 'year' AND layer <> 'harmonize' THEN 'raw_clean' ELSE layer END AS sheet, value, number FROM layers)
SELECT column_name, sheet, row_number() OVER (PARTITION BY column_name, sheet ORDER BY value IS NOT NULL, number NULLS LAST, value) AS place, coalesce(value, '(blank)') AS value FROM named""")
def list_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of text and number columns of three layers, each value with its place in its sheet."""
    part = table(spark, sf_dir, "part")
    layer = lambda unit, year: part.select(unit.alias("unit"), year.alias("year"))
    some = F.when(F.col("p_size") > 3, F.col("p_type"))
    objects = {"d_raw": layer(some, F.col("p_size")), "d_clean": layer(F.col("p_type"), F.col("p_size")), "d_harmonize": layer(some, F.col("p_size") % 7)}
    found = lists.merged_lists(lists.layer_tables(objects), ["unit", "year"], Workspace(spark, "lists")).rows
    firsts = found.groupBy("column_name", "sheet").agg(F.min("place").alias("first"))
    return found.join(firsts, ["column_name", "sheet"]).select("column_name", "sheet", (F.col("place") - F.col("first") + 1).alias("place"), "value")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 OR p_size % 3 = 1 THEN '(unknown_commodity)' ELSE p_type END AS commodity, CASE WHEN p_size % 3 = 2 THEN '  ' || p_type || ' ' END AS cell FROM part")
def commodity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimmed commodity names with a label for blank ones, and blank cells as nulls."""
    name = F.when(F.col("p_size") % 3 == 0, F.lit(" \t ")).when(F.col("p_size") % 3 == 2, F.concat(F.lit("  "), "p_type", F.lit(" ")))
    trimmed = F.when(F.col("p_size") % 3 == 0, F.lit("   ")).otherwise(name)
    return table(spark, sf_dir, "part").select("p_partkey", reshape.commodity_name(trimmed).alias("commodity"), text.blank_to_null(name).alias("cell"))


@query(f"""WITH {_RANKED}, errors AS (
  SELECT file_rank, 1 AS t, 1 AS a, g AS b FROM numbered WHERE polity IS NULL OR polity = ''
  UNION ALL SELECT file_rank, 2, min(g), CASE WHEN year = '1990-2999' THEN 2 ELSE 1 END FROM numbered WHERE year <> '2001' GROUP BY file_rank, year
  UNION ALL SELECT min(file_rank), 3, min(g), 1 FROM numbered GROUP BY polity, year, file HAVING count(*) > 1)
SELECT row_number() OVER (ORDER BY file_rank, t, a, b)::BIGINT AS place, file_rank::BIGINT AS file_rank, t::BIGINT AS type_rank, a::BIGINT AS key_a, b::BIGINT AS key_b FROM errors""")
def validation_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every validation error in the order of its four ranks."""
    workspace = Workspace(spark, "errors")
    errors = validate.validate_long(_event_facts(spark, sf_dir), ["event_id"], ("polity",), 2025, workspace)[1]
    return places.row_numbers(errors.drop("message"), ["file_rank", "type_rank", "key_a", "key_b"], "place", workspace)


@query(f"""WITH f AS ({_ORDER_CELLS}), n AS (SELECT count_if(commodity = '1-urgent') AS u, count_if(commodity = '2-high') AS h FROM f WHERE unit IS NOT NULL)
SELECT row_number() OVER (ORDER BY loop, s, t) AS place, loop, affected_rows, s AS value_source_raw, t AS value_source FROM (
  SELECT 0::BIGINT AS loop, 0::BIGINT AS affected_rows, '9-never' AS s, 'x' AS t UNION ALL SELECT 1, u, '1-urgent', '2-high' FROM n UNION ALL SELECT 1, h, '2-high', 'done' FROM n UNION ALL SELECT 2, u, '2-high', 'done' FROM n)""")
def summary_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every rule, used or not, in a stage's merged summary."""
    workspace = Workspace(spark, "summary")
    file = _rules([*_CHAIN, ("9-never", "x", "x", "x")])
    matched = summaries.summarize_stage(run_stage(_order_cells(spark, sf_dir), [file], "clean", workspace).audit)
    merged = summaries.merge_stage_summaries(matched, summaries.unmatched_rules(summaries.rule_catalog(spark, [file]), matched))
    order = [F.col(c).asc_nulls_last() for c in STAGE_ORDER]
    return places.row_numbers(merged, order, "place", workspace).select("place", "loop", "affected_rows", "value_source_raw", "value_source")


@query(f"WITH f AS ({_ORDER_CELLS}) SELECT o_orderkey, commodity, unit, CASE WHEN commodity = '5-low' AND unit IS NOT NULL THEN 'cheap' END AS polity FROM f")
def rule_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule that names a column which the facts lack adds it; footnotes that were and stay empty go."""
    facts = _order_cells(spark, sf_dir).withColumn("footnotes", F.lit(None).cast("string"))
    rule = [{"column_source": "unit", "value_source_raw": "x", "value_source": "x", "column_target": "polity", "value_target_raw": None, "value_target": "cheap"}]
    low = facts.where("commodity = '5-low'")
    done = run_stage(low, [rule_file("new.csv", list(RULE_COLUMNS), rule, "clean")], "clean", Workspace(spark, "stage")).data
    rest = facts.where("commodity <> '5-low'").drop("footnotes").withColumn("polity", F.lit(None).cast("string"))
    return done.unionByName(rest)

"""DuckDB SQL with the results of ``queries.py``, written against the given tables."""

from __future__ import annotations

from gaugeframe.plans.topics import TOPICS
from workload import tables as t


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def matches(column: str, terms: tuple[str, ...]) -> str:
    pattern = text("|".join(terms))
    return f"coalesce(regexp_matches({column}, {pattern}, 'i'), false)"


RINGS = ("ring", "Bolt", "hot (rod|gear)")

CATALOG = """
catalog AS (
  SELECT CAST(p_partkey AS VARCHAR) AS IndicatorCode, p_partkey AS page_no, 0 AS place,
         CASE WHEN p_size <> 50 THEN p_name END AS IndicatorName
  FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), p_partkey, 1,
         CASE WHEN p_size > 25 THEN p_name || ' of ' || p_type ELSE p_name END
  FROM part
)"""


def observations(code: str = "CAST(l_partkey AS VARCHAR)", all_years: bool = False, parts: bool = False) -> str:
    year = "CAST(year(l_shipdate) AS INTEGER)"
    if not all_years:
        year = f"CASE WHEN l_quantity <> 50 THEN {year} END"
    join = "JOIN part ON l_partkey = p_partkey" if parts else ""
    return f"""
obs AS (
  SELECT CASE WHEN l_linenumber <> 7 THEN n_name END AS SpatialDim,
         {year} AS TimeDim,
         {code} AS IndicatorCode,
         CASE WHEN l_discount = 0 OR l_tax = 0.08 THEN NULL ELSE l_extendedprice END AS NumericValue,
         l_returnflag AS Dim1
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey {join}
)"""


OBS = observations()
OBS_ALL_YEARS = observations(all_years=True)
OBS_TYPED = observations("p_type", parts=True)
OBS_SKEWED = observations("CASE WHEN l_returnflag = 'R' THEN '7' ELSE CAST(l_partkey AS VARCHAR) END")

KEYS_PRESENT = "SpatialDim IS NOT NULL AND TimeDim IS NOT NULL AND IndicatorCode IS NOT NULL"


def mean(value: str = "NumericValue", condition: str = "") -> str:
    keep = f" FILTER (WHERE {condition})" if condition else ""
    units = f"CAST(sum(CAST(round({value} * 100) AS BIGINT)){keep} AS DOUBLE)"
    return f"{units} / CAST(100 AS DOUBLE) / count({value}){keep}"


def long(entity: str = '"COUNTRY"', source: str = "obs") -> str:
    return f"""SELECT SpatialDim AS {entity}, TimeDim AS "YEAR", IndicatorCode, NumericValue
FROM {source} WHERE {KEYS_PRESENT}"""


def cells(entity: str = '"COUNTRY"', source: str = "obs") -> str:
    return f"""SELECT SpatialDim AS {entity}, IndicatorCode, TimeDim AS "YEAR", {mean()} AS NumericValue
FROM {source} WHERE {KEYS_PRESENT} AND NumericValue IS NOT NULL GROUP BY 1, 2, 3"""


def wide(keys, entity: str = '"COUNTRY"', source: str = "obs") -> str:
    columns = ", ".join(
        mean(condition=f"IndicatorCode = {text(c)} AND TimeDim = {y}") + f' AS "{c}|{y}"' for c, y in keys
    )
    codes = ", ".join(sorted({text(c) for c, _ in keys}))
    return f"""SELECT SpatialDim AS {entity}, {columns} FROM {source}
WHERE {KEYS_PRESENT} AND NumericValue IS NOT NULL AND IndicatorCode IN ({codes}) GROUP BY 1"""


def selection(terms: tuple[str, ...]) -> str:
    return f"""
selection AS (
  SELECT DISTINCT IndicatorCode, IndicatorName FROM catalog WHERE {matches("IndicatorName", terms)}
)"""


def topics(named: dict[str, tuple[str, ...]], source: str, name: str = "IndicatorName") -> str:
    parts = [
        f"SELECT {text(topic)} AS topic, IndicatorCode, {name} AS IndicatorName FROM {source} WHERE {matches(name, terms)}"
        for topic, terms in named.items()
    ]
    return "SELECT DISTINCT topic, IndicatorCode, IndicatorName FROM (" + "\nUNION ALL ".join(parts) + ")"


def _topical_catalog() -> str:
    terms = "[" + ", ".join(text(x) for x in t.TOPIC_TERMS) + "]"
    return f"""
termed AS (
  SELECT p_partkey, p_name, p_brand, p_size,
         list_extract({terms}, CAST(p_partkey % {len(t.TOPIC_TERMS)} + 1 AS BIGINT)) AS term
  FROM part
),
cased AS (
  SELECT *, CASE p_size % 3 WHEN 0 THEN upper(term) WHEN 1 THEN lower(term) ELSE term END AS c FROM termed
),
topical AS (
  SELECT CAST(p_partkey AS VARCHAR) AS IndicatorCode,
         p_name || ' ' || CASE WHEN p_size > 40 THEN c ELSE replace(replace(c, '(', ''), ')', '') END
           || ' ' || p_brand AS IndicatorName
  FROM cased
)"""


TOPICAL = _topical_catalog()
BUILT_IN = {x.name: x.patterns for x in TOPICS}
PART_TOPICS = {x.name: x.patterns for x in t.PART_TOPICS}
BY_VALUE = ", ".join(text(x.name) for x in t.PART_TOPICS if x.null_policy == "value")

WIDE_LINES = f"""
wide AS ({wide(t.WIDE_KEYS, source="obs")}),
lines AS (
  SELECT 0 AS section, NULL AS entity, {text("IndicatorCode," + ",".join(c for c, _ in t.WIDE_KEYS))} AS line
  UNION ALL SELECT 1, NULL, {text("YEAR," + ",".join(str(y) for _, y in t.WIDE_KEYS))}
  UNION ALL SELECT 2, NULL, {text("COUNTRY" + "," * len(t.WIDE_KEYS))}
  UNION ALL SELECT 3, "COUNTRY", "COUNTRY" || {" || ".join(f"',' || coalesce(CAST(\"{c}|{y}\" AS VARCHAR), '')" for c, y in t.WIDE_KEYS)}
  FROM wide
)"""

TOPIC_ROWS = f"""WITH {CATALOG}, {OBS_ALL_YEARS}, chosen AS ({topics(PART_TOPICS, "catalog")})
SELECT topic, SpatialDim AS "ENTITY", TimeDim AS "YEAR", obs.IndicatorCode, NumericValue
FROM obs JOIN chosen ON obs.IndicatorCode = chosen.IndicatorCode
WHERE CASE WHEN topic IN ({BY_VALUE}) THEN NumericValue IS NOT NULL ELSE {KEYS_PRESENT.replace("IndicatorCode", "obs.IndicatorCode")} END"""


def _topic_means(obs: str) -> str:
    return f"""WITH {TOPICAL}, {obs}, chosen AS (SELECT DISTINCT topic, IndicatorCode FROM ({topics(BUILT_IN, "topical")})),
cells AS ({cells('"ENTITY"')})
SELECT topic, "ENTITY", cells.IndicatorCode, "YEAR", NumericValue
FROM cells JOIN chosen ON cells.IndicatorCode = chosen.IndicatorCode"""


SELECTED = """SELECT SpatialDim AS "COUNTRY", TimeDim AS "YEAR", obs.IndicatorCode, NumericValue
FROM obs JOIN selection ON obs.IndicatorCode = selection.IndicatorCode
WHERE SpatialDim IS NOT NULL AND TimeDim IS NOT NULL"""

PLAIN_VALUE = "CASE WHEN l_discount = 0 THEN NULL WHEN l_tax = 0.08 THEN -1.0::DOUBLE ELSE l_extendedprice END"


def _plain(entity: str, year: str) -> str:
    return f"""SELECT CASE WHEN l_linenumber <> 7 THEN n_name END AS {entity},
  CASE WHEN l_quantity <> 50 THEN CAST(year(l_shipdate) AS INTEGER) END AS {year},
  CAST(l_partkey AS VARCHAR) AS IndicatorCode, {PLAIN_VALUE} AS NumericValue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""


def _exported(topic: str, codes: tuple[str, ...]) -> str:
    keys = [k for k in t.WIDE_KEYS if k[0] in codes]
    wide_line = " || ".join(f"',' || coalesce(CAST(\"{c}|{y}\" AS VARCHAR), '')" for c, y in keys)
    listed = ", ".join(text(c) for c in codes)
    return f"""
SELECT {text(topic)} AS topic, 'long' AS kind,
       SpatialDim || ',' || TimeDim || ',' || IndicatorCode || ',' || coalesce(CAST(NumericValue AS VARCHAR), '') AS line
FROM obs WHERE {KEYS_PRESENT} AND IndicatorCode IN ({listed})
UNION ALL SELECT {text(topic)}, 'wide', {text("IndicatorCode," + ",".join(c for c, _ in keys))}
UNION ALL SELECT {text(topic)}, 'wide', {text("YEAR," + ",".join(str(y) for _, y in keys))}
UNION ALL SELECT {text(topic)}, 'wide', {text("COUNTRY" + "," * len(keys))}
UNION ALL SELECT {text(topic)}, 'wide', "COUNTRY" || {wide_line} FROM ({wide(keys)})"""


SIZE_KEYS = [k for k in t.WIDE_KEYS if k[0] in ("LARGE", "MEDIUM", "SMALL")]
PRICE_KEYS = [k for k in t.WIDE_KEYS if k[0] in ("ECONOMY", "PROMO")]

LANDED_TWICE = """once AS (
  SELECT o_orderkey AS k, o_orderstatus, CAST(o_custkey AS VARCHAR) AS IndicatorCode, o_orderpriority AS SpatialDim,
    CAST(year(o_orderdate) AS VARCHAR) AS TimeDim, o_totalprice AS NumericValue FROM orders
), pages AS (
  SELECT *, 1 AS fetched, CASE WHEN o_orderstatus = 'F' THEN 404 ELSE 200 END AS status FROM once
  UNION ALL
  SELECT k, o_orderstatus, IndicatorCode, CASE WHEN o_orderstatus = 'F' THEN 'late' ELSE SpatialDim END,
    CASE WHEN o_orderstatus = 'F' THEN '2024' WHEN k % 11 = 0 THEN TimeDim ELSE '1' || TimeDim END,
    CASE WHEN o_orderstatus = 'F' THEN 1.5 ELSE NumericValue END,
    2, CASE WHEN k % 11 = 0 OR o_orderstatus = 'F' THEN 200 WHEN k % 3 = 0 THEN 500 ELSE 200 END
  FROM once WHERE k % 5 <> 0
)"""

TEXTS_WITH_TERMS = f"""
SELECT CAST(doc_id AS VARCHAR) AS IndicatorCode, CAST(length(text) AS INTEGER) AS n_chars
FROM documents WHERE {matches("text", t.TEXT_TERMS)}"""

ORACLE: dict[str, str] = {
    "catalog_scan": f"WITH {CATALOG} SELECT IndicatorCode, IndicatorName FROM catalog",
    "page_chain_audit": """
WITH pages AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
SELECT 'orders/' || CAST(p.o_orderkey + 1 AS VARCHAR) AS missing_url, count(*) AS referrers
FROM pages p WHERE NOT EXISTS (SELECT 1 FROM pages q WHERE q.o_orderkey = p.o_orderkey + 1) GROUP BY 1""",
    # A page leads back to itself only by way of a link ten pages back, within a dozen steps.
    "page_walk": """
WITH RECURSIVE links AS (
  SELECT o_orderkey AS k, 'orders/' || o_orderkey AS url, CASE WHEN o_orderkey % 1000 <> 999 THEN 'orders/' || CAST(o_orderkey
    + CASE WHEN o_orderkey % 250 = 249 THEN 2 WHEN o_orderkey % 170 = 169 THEN -10 ELSE 1 END AS VARCHAR) END AS target
  FROM orders
  UNION ALL SELECT o_orderkey, 'orders/' || o_orderkey, 'orders/lost' || o_orderkey FROM orders WHERE o_orderkey % 90 = 89
), nodes AS (SELECT url, min(k) AS k, min(target) AS target, count(DISTINCT target) AS links FROM links GROUP BY url),
referred AS (SELECT target AS url, count(*) AS referrers FROM (SELECT DISTINCT url, target FROM links WHERE target IS NOT NULL) GROUP BY 1),
walk AS (
  SELECT url, url AS start, 0 AS page_no FROM nodes WHERE k % 1000 = 0
  UNION ALL
  SELECT n.target, w.start, w.page_no + 1 FROM walk w JOIN nodes n USING (url) WHERE n.target IN (SELECT url FROM nodes) AND w.page_no < 1000
), numbered AS (SELECT url, min((page_no, start)) AS place FROM walk GROUP BY url),
ahead AS (
  SELECT url AS origin, url AS here, 0 AS steps FROM nodes
  UNION ALL SELECT a.origin, n.target, a.steps + 1 FROM ahead a JOIN nodes n ON n.url = a.here WHERE a.steps < 12 AND n.target IS NOT NULL
)
SELECT n.url, CAST(place[1] AS BIGINT) AS page_no, place[2] AS start, coalesce(referrers, 0) AS referrers, links,
  n.url IN (SELECT origin FROM ahead WHERE here = origin AND steps > 0) AS on_cycle,
  n.target IS NOT NULL AND n.target NOT IN (SELECT url FROM nodes) AS next_missing
FROM nodes n LEFT JOIN numbered USING (url) LEFT JOIN referred USING (url)""",
    "pages_inferred": """
SELECT CAST(l_suppkey AS VARCHAR) AS IndicatorCode, l_returnflag AS SpatialDim, l_extendedprice AS NumericValue,
  CASE WHEN l_linenumber % 3 > 0 THEN CAST(year(l_shipdate) AS VARCHAR) END AS TimeDim,
  CASE l_linenumber % 3 WHEN 1 THEN CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) WHEN 2 THEN l_discount END AS "Low",
  CASE WHEN l_linenumber % 3 = 1 THEN l_linenumber = 1 END AS "Final",
  CASE WHEN l_linenumber % 3 = 0 THEN '{"n":' || l_linenumber || ',"s":"' || l_linestatus || '"}' END AS "Dim 1"
FROM lineitem WHERE l_linenumber <> 7""",
    "pages_without_rows": """
SELECT 'none' AS policy, CAST(o_custkey AS VARCHAR) AS what, CAST(round(o_totalprice * 100) AS BIGINT) AS units
FROM orders WHERE o_orderkey % 7 IN (5, 6)
UNION ALL SELECT 'fail', 'orders/' || o_orderkey || ' no rows', NULL FROM orders WHERE o_orderkey % 7 = 2""",
    "observation_scan": f"""WITH {OBS_TYPED} SELECT SpatialDim AS "COUNTRY", TimeDim AS "YEAR", IndicatorCode, NumericValue
FROM obs WHERE {KEYS_PRESENT} AND IndicatorCode IN ('ECONOMY', 'MEDIUM')""",
    "page_rows": """
WITH rows AS (
  SELECT l_suppkey, l_shipdate, l_quantity AS v FROM lineitem
  UNION ALL SELECT l_suppkey, l_shipdate, l_extendedprice FROM lineitem
  UNION ALL SELECT l_suppkey, l_shipdate, l_discount FROM lineitem)
SELECT CAST(l_suppkey AS VARCHAR) AS SpatialDim, CAST(year(l_shipdate) AS VARCHAR) AS TimeDim,
       count(*) AS n, CAST(sum(CAST(round(v * 100) AS BIGINT)) AS BIGINT) AS units
FROM rows GROUP BY 1, 2""",
    "event_properties": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "page_files": """
SELECT 'O' AS IndicatorCode, CAST(l_suppkey AS VARCHAR) AS SpatialDim, CAST(year(l_shipdate) AS VARCHAR) AS TimeDim,
       3 * count(*) AS n
FROM lineitem WHERE l_linestatus = 'O' GROUP BY 2, 3""",
    "failed_pages_skipped": """
SELECT o_orderpriority AS SpatialDim, CAST(year(o_orderdate) AS VARCHAR) AS TimeDim,
       o_totalprice AS NumericValue, CAST(o_custkey AS VARCHAR) AS IndicatorCode
FROM orders WHERE o_orderstatus NOT IN ('F', 'P')""",
    "page_intake": """
SELECT o_orderpriority AS SpatialDim, CAST(year(o_orderdate) AS VARCHAR) AS TimeDim,
       o_totalprice AS NumericValue, CAST(o_custkey AS VARCHAR) AS IndicatorCode
FROM orders WHERE o_orderstatus NOT IN ('F', 'P')""",
    "failed_pages_refused": """
SELECT 404 AS status, 'orders/' || o_orderkey AS what FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 200, CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderstatus <> 'F' HAVING count(*) > 0""",
    "unreadable_pages_named": """
SELECT 'orders/' || o_orderkey AS url, CASE o_orderkey % 7 WHEN 2 THEN 'no rows' WHEN 3 THEN 'not a number: ?'
    WHEN 4 THEN 'not a number: n/a' ELSE 'not a page' END AS found
FROM orders WHERE o_orderkey % 7 < 5
UNION ALL SELECT 'customer/' || o_custkey, o_orderpriority || '|1998|' || CAST(round(o_totalprice * 100) AS BIGINT)
FROM orders WHERE o_orderkey % 7 IN (3, 5, 6)""",
    "json_years": """
SELECT l_linestatus AS IndicatorCode, CAST(year(l_shipdate) AS INTEGER) AS "YEAR", count(*) AS n
FROM lineitem GROUP BY 1, 2""",
    "one_term": f"WITH {CATALOG} SELECT IndicatorCode, IndicatorName FROM catalog WHERE lower(IndicatorName) LIKE '%ring%'",
    "any_term": f"WITH {CATALOG}, {selection(RINGS)} SELECT * FROM selection",
    "any_term_documents": TEXTS_WITH_TERMS,
    "indexed_terms": f"WITH {CATALOG} "
    + "\nUNION ALL ".join(
        f"SELECT DISTINCT IndicatorCode, IndicatorName, '{name}' AS list FROM catalog WHERE {matches('IndicatorName', terms)}"
        for name, terms in {"any": RINGS, "types": ("of medium", "of Promo|gizmo of"), "rare": ("ll rod of s", "no such part")}.items()
    ),
    "indexed_documents": TEXTS_WITH_TERMS,
    "pattern_and_literal": """
WITH named AS (
  SELECT CAST(p_partkey AS VARCHAR) AS IndicatorCode, p_name || CASE WHEN p_size % 2 = 0 THEN '(s)' ELSE 's' END AS n
  FROM part)
SELECT IndicatorCode, contains(n, 'rings') OR contains(n, 'rods') AS as_pattern,
       contains(n, 'ring(s)') OR contains(n, 'rod(s)') AS as_literal FROM named""",
    "null_names": f"""WITH {CATALOG}
SELECT IndicatorName IS NOT NULL AND contains(IndicatorName, 'ring') AS hit, IndicatorName IS NULL AS nameless, count(*) AS n
FROM catalog GROUP BY 1, 2""",
    "projection": f"WITH {TOPICAL} SELECT * FROM topical",
    "requested_code": "SELECT l_linestatus AS IndicatorCode, 3 * count(*) AS n FROM lineitem GROUP BY 1",
    "selected_observations": f"WITH {CATALOG}, {selection(RINGS)}, {OBS} {SELECTED}",
    "selected_observations_once": f"""WITH {CATALOG}, {selection(RINGS)}, {OBS}
{long()} AND IndicatorCode IN (SELECT IndicatorCode FROM selection)""",
    "selected_observations_shuffled": f"WITH {CATALOG}, {selection(('o', 'ring'))}, {OBS_SKEWED} {SELECTED}",
    "clustered_observations": f"""WITH {OBS}, {CATALOG}, {selection(("gear", "rod of ring"))}
SELECT SpatialDim AS "COUNTRY", TimeDim AS "YEAR", IndicatorCode, NumericValue
FROM obs JOIN selection USING (IndicatorCode) WHERE {KEYS_PRESENT}""",
    "selected_pages": """
SELECT CAST(l_partkey AS VARCHAR) AS IndicatorCode, 3 * count(*) AS n FROM lineitem WHERE l_partkey % 3 = 0 GROUP BY 1""",
    "indicators_lacking_data": f"""WITH {CATALOG}, {selection(("ring", "gizmo"))}, {OBS}
SELECT * FROM selection WHERE CAST(IndicatorCode AS BIGINT) % 3 = 0
    OR IndicatorCode NOT IN (SELECT IndicatorCode FROM obs)""",
    "union_by_name": """
SELECT c_acctbal AS NumericValue, c_name AS SpatialDim, c_mktsegment AS segment, NULL::INTEGER AS nation FROM customer
UNION ALL SELECT s_acctbal, s_name, NULL, s_nationkey FROM supplier
UNION ALL SELECT s_acctbal, s_name, NULL, s_nationkey FROM supplier""",
    "non_empty": "SELECT l_returnflag AS Dim1, count(*) AS n FROM lineitem GROUP BY 1",
    "distinct_indicators": f"""WITH {CATALOG}
SELECT DISTINCT IndicatorCode, IndicatorName FROM catalog WHERE IndicatorName IS NOT NULL""",
    "numbered_indicators": f"""WITH {CATALOG}, {selection(RINGS)}
SELECT *, row_number() OVER (ORDER BY IndicatorCode, IndicatorName) - 1 AS ordinal FROM selection""",
    "catalog_positions": f"""WITH {CATALOG},
placed AS (SELECT *, row_number() OVER (ORDER BY page_no, place) - 1 AS pos FROM catalog)
SELECT IndicatorCode, IndicatorName, min(pos) AS "index" FROM placed
WHERE {matches("IndicatorName", RINGS)} GROUP BY 1, 2""",
    "first_indicators": f"""WITH {CATALOG}, {selection(RINGS)}
SELECT * FROM selection ORDER BY IndicatorCode, IndicatorName LIMIT 5""",
    "catalog_size": "SELECT 2 * count(*) AS n_rows FROM part",
    "collected_shape": f"""WITH {CATALOG}, {selection(RINGS)}
SELECT count(*) AS n_rows, 5 AS n_columns
FROM lineitem JOIN selection ON CAST(l_partkey AS VARCHAR) = IndicatorCode""",
    "grouped_mean": f"WITH {OBS_TYPED} {cells()}",
    "grouped_mean_plain": f"""WITH {OBS_TYPED}
SELECT SpatialDim AS "COUNTRY", IndicatorCode, TimeDim AS "YEAR", round(avg(NumericValue) + 0.0000123, 4) AS NumericValue
FROM obs WHERE {KEYS_PRESENT} AND NumericValue IS NOT NULL GROUP BY 1, 2, 3""",
    "grouped_mean_many": f"WITH {OBS} {cells()}",
    # A price from 512 to 2**20 is a whole multiple of 2**-43, and the few of a group fit a 64-bit number.
    "grouped_mean_exact": f"""WITH {OBS}
SELECT SpatialDim AS "COUNTRY", IndicatorCode, TimeDim AS "YEAR",
  CAST(sum(CAST(NumericValue * pow(2, 43) AS HUGEINT)) AS DOUBLE) / pow(2, 43) / count(*) AS NumericValue
FROM obs WHERE {KEYS_PRESENT} AND NumericValue IS NOT NULL GROUP BY ALL""",
    "wide_known_keys": f"WITH {OBS_TYPED} {wide(t.WIDE_KEYS)}",
    "wide_discovered_keys": f"WITH {OBS_TYPED} {wide(t.WIDE_KEYS)}",
    "wide_many_entities": f"""WITH rows AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS SpatialDim, year(l_shipdate) AS TimeDim, l_returnflag AS IndicatorCode,
         l_extendedprice AS NumericValue FROM lineitem)
{wide([(f, y) for f in "ANR" for y in t.SHIP_YEARS], source="rows")}""",
    "wide_to_cells": f"WITH {OBS_TYPED} {cells()}",
    "entities_without_values": f"""WITH {OBS}
SELECT SpatialDim AS "COUNTRY" FROM obs WHERE {KEYS_PRESENT} GROUP BY 1
HAVING count(CASE WHEN right(SpatialDim, 1) NOT IN ('1', '4') THEN NumericValue END) = 0""",
    "wide_columns": f"""WITH {OBS}, keys AS (
  SELECT DISTINCT IndicatorCode, TimeDim AS "YEAR" FROM obs WHERE {KEYS_PRESENT} AND NumericValue IS NOT NULL)
SELECT *, row_number() OVER (ORDER BY IndicatorCode, "YEAR") - 1 AS ordinal FROM keys""",
    "checked_columns": f"WITH {OBS} SELECT TimeDim, Dim1, count(*) AS n FROM obs GROUP BY 1, 2",
    "pruned": _plain("SpatialDim", "TimeDim"),
    "renamed": _plain('"COUNTRY/REGION"', '"YEAR"'),
    "long_by_keys": f"""WITH {OBS} {long('"COUNTRY/REGION"')}""",
    "long_by_value": f"""WITH {OBS_ALL_YEARS}
SELECT SpatialDim AS "REGION", TimeDim AS "YEAR", IndicatorCode, NumericValue FROM obs WHERE NumericValue IS NOT NULL""",
    "whole_years": """
SELECT CAST(trunc(year(l_shipdate) + l_discount * 9) AS INTEGER) AS cut,
       CASE WHEN l_returnflag <> 'R' THEN CAST(year(l_shipdate) AS INTEGER) END AS lenient, count(*) AS n
FROM lineitem GROUP BY 1, 2""",
    "long_csv": f"WITH {OBS} {long()}",
    "wide_csv": f"WITH {OBS_TYPED}, {WIDE_LINES} SELECT line FROM lines",
    "wide_csv_many": f"""WITH {OBS}, c AS ({cells()}),
keys AS (SELECT *, row_number() OVER (ORDER BY IndicatorCode, "YEAR") AS place FROM
  (SELECT DISTINCT IndicatorCode, "YEAR" FROM c)),
filled AS (SELECT e."COUNTRY", place, NumericValue FROM (SELECT DISTINCT "COUNTRY" FROM c) e CROSS JOIN keys
  LEFT JOIN c ON c."COUNTRY" = e."COUNTRY" AND c.IndicatorCode = keys.IndicatorCode AND c."YEAR" = keys."YEAR")
SELECT 'IndicatorCode,' || string_agg(IndicatorCode, ',' ORDER BY place) AS line FROM keys
UNION ALL SELECT 'YEAR,' || string_agg(CAST("YEAR" AS VARCHAR), ',' ORDER BY place) FROM keys
UNION ALL SELECT 'COUNTRY' || repeat(',', CAST(count(*) AS INTEGER)) FROM keys
UNION ALL SELECT filled."COUNTRY" || ',' || string_agg(coalesce(CAST(NumericValue AS VARCHAR), ''), ',' ORDER BY place)
FROM filled GROUP BY filled."COUNTRY" """,
    "wide_csv_order": f"""WITH {OBS_TYPED}, {WIDE_LINES}
SELECT row_number() OVER (ORDER BY section, entity) - 1 AS ordinal, split_part(line, ',', 1) AS first_field FROM lines""",
    "topic_long": f"""WITH {CATALOG}, {selection(PART_TOPICS["heat"])}, {OBS} {SELECTED}""",
    "topic_wide_table": f"""WITH {OBS_TYPED} {wide(SIZE_KEYS, '"COUNTRY/REGION"')}""",
    "topic_from_pages": """
SELECT o_orderpriority AS "COUNTRY", CAST(year(o_orderdate) AS INTEGER) AS "YEAR",
       CAST(o_custkey AS VARCHAR) AS IndicatorCode, o_totalprice AS NumericValue
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus NOT IN ('F', 'P') AND c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "topic_wide_from_all": f"""WITH {OBS_TYPED} {wide(PRICE_KEYS, '"REGION"')}""",
    "all_topics_selection": f"WITH {TOPICAL} {topics(BUILT_IN, 'topical')}",
    "all_topics_documents": f"""WITH texts AS (SELECT CAST(doc_id AS VARCHAR) AS IndicatorCode, text FROM documents)
SELECT topic, IndicatorCode FROM ({topics(BUILT_IN | t.TEXT_TOPICS, "texts", "text")})""",
    "topics_as_table": f"WITH {TOPICAL} {topics(BUILT_IN, 'topical')}",
    "topics_of_parts": f"""WITH {CATALOG}, terms AS (
  SELECT 'part ' || p_partkey AS topic, CASE WHEN p_size = 1 THEN 'ro'
    ELSE string_split(p_name, ' ')[-1] || ' of ' || lower(p_type) || CASE WHEN p_size = 2 THEN ' and more' ELSE '' END END AS term
  FROM part
), named AS (SELECT DISTINCT IndicatorCode, lower(IndicatorName) AS name FROM catalog WHERE IndicatorName IS NOT NULL),
hits AS (
  SELECT term, IndicatorCode FROM (SELECT DISTINCT term FROM terms) JOIN named ON contains(name, term) GROUP BY ALL
)
SELECT topic, count(*) AS n_codes, min(CAST(IndicatorCode AS BIGINT)) AS first_code FROM terms JOIN hits USING (term) GROUP BY topic""",
    "all_topics_rows": TOPIC_ROWS,
    "all_topics_rows_shuffled": TOPIC_ROWS,
    "all_topics_means": _topic_means(OBS),
    "all_topics_means_shuffled": _topic_means(OBS_SKEWED),
    "exported_topics": f"""WITH {OBS_TYPED} {_exported("size", ("MEDIUM", "SMALL"))}
UNION ALL {_exported("price", ("ECONOMY", "PROMO"))} UNION ALL {_exported("rest", ("STANDARD",))}""",
    "accounted_pages": """
WITH pages AS (SELECT o_orderstatus = 'F' AS failed, o_orderkey % 7 AS kind FROM orders)
SELECT unnest(['pages', 'failed', 'without_rows', 'unreadable', 'rows', 'bad_rows', 'kept']) AS what,
  unnest([count(*), count(*) FILTER (WHERE failed), count(*) FILTER (WHERE NOT failed AND kind = 2),
    count(*) FILTER (WHERE NOT failed AND kind < 2), count(*) FILTER (WHERE NOT failed AND kind IN (3, 5, 6)),
    count(*) FILTER (WHERE NOT failed AND kind IN (3, 4)), count(*) FILTER (WHERE NOT failed AND kind IN (3, 5, 6))]) AS n
FROM pages""",
    "export_report": f"""WITH {CATALOG}, {OBS_ALL_YEARS}, chosen AS ({topics({x.name: x.patterns for x in t.PART_TOPICS}, "catalog")}),
facts AS (SELECT * FROM obs WHERE CAST(IndicatorCode AS BIGINT) % 4 <> 0),
named AS (SELECT unnest([{", ".join(text(x.name) for x in t.PART_TOPICS)}]) AS topic),
rows AS (
  SELECT topic, count(*) AS rows, count(*) FILTER (WHERE CASE WHEN topic = 'rings_and_rods' THEN NumericValue IS NOT NULL
      ELSE {KEYS_PRESENT} END) AS kept,
    count(*) FILTER (WHERE CASE WHEN topic = 'rings_and_rods' THEN true ELSE {KEYS_PRESENT} END AND NumericValue IS NOT NULL) AS values
  FROM chosen JOIN facts USING (IndicatorCode) GROUP BY topic
), codes AS (
  SELECT topic, count(*) FILTER (WHERE held) AS codes, count(*) FILTER (WHERE NOT held) AS lacking
  FROM (SELECT DISTINCT topic, IndicatorCode, IndicatorCode IN (SELECT IndicatorCode FROM facts) AS held FROM chosen) GROUP BY topic
)
SELECT topic, coalesce(rows, 0) AS rows, coalesce(kept, 0) AS kept, coalesce(values, 0) AS values, coalesce(codes, 0) AS codes,
  coalesce(lacking, 0) AS codes_without_data, coalesce(lacking, 0) AS listed
FROM named LEFT JOIN rows USING (topic) LEFT JOIN codes USING (topic)""",
    "pages_landed_twice": f"""WITH {LANDED_TWICE}
SELECT IndicatorCode, max_by(SpatialDim, fetched) AS SpatialDim, max_by(TimeDim, fetched) AS TimeDim,
  max_by(NumericValue, fetched) AS NumericValue
FROM (SELECT *, max(fetched) OVER (PARTITION BY k) AS latest FROM pages WHERE status = 200)
WHERE fetched = latest AND o_orderstatus <> 'P' GROUP BY k, IndicatorCode""",
    "page_intake_repeated": f"""WITH {LANDED_TWICE}
SELECT IndicatorCode, SpatialDim, TimeDim, NumericValue
FROM (SELECT *, min(fetched) OVER (PARTITION BY k) AS earliest FROM pages WHERE status = 200)
WHERE fetched = earliest AND o_orderstatus <> 'P'""",
    "wide_sparse": f"WITH {OBS} {cells()}",
    "wide_sparse_slice": f"""WITH {OBS}, cells AS ({cells()}),
columns AS (
  SELECT IndicatorCode, "YEAR", row_number() OVER (ORDER BY IndicatorCode, "YEAR") - 1 AS ordinal
  FROM (SELECT DISTINCT IndicatorCode, "YEAR" FROM cells)
)
SELECT "COUNTRY", IndicatorCode, "YEAR", NumericValue FROM cells JOIN columns USING (IndicatorCode, "YEAR") WHERE ordinal BETWEEN 500 AND 539""",
}

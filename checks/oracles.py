"""The registered queries in SQL, over the given tables."""

from __future__ import annotations

_F1 = """f1 AS (
  SELECT lpad(cast(user_id AS varchar), 12, '0') AS "FIPS",
         cast(cast(ts AS date) AS varchar) AS "Date",
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS pm25
  FROM events)"""

_MEANS = _F1 + """, means AS (
  SELECT "FIPS", avg(pm25) AS pm25 FROM f1 WHERE "FIPS" IS NOT NULL GROUP BY "FIPS")"""

_SUMMARY = """
  SELECT 'count' AS stat, cast(count(pm25) AS double) AS value FROM means
  UNION ALL SELECT 'mean', round(avg(pm25), 6) FROM means
  UNION ALL SELECT 'std', round(stddev_samp(pm25), 6) FROM means
  UNION ALL SELECT 'min', round(min(pm25), 6) FROM means
  UNION ALL SELECT 'max', round(max(pm25), 6) FROM means
  UNION ALL SELECT '25%', round(quantile_cont(pm25, 0.25), 6) FROM means
  UNION ALL SELECT '50%', round(quantile_cont(pm25, 0.5), 6) FROM means
  UNION ALL SELECT '75%', round(quantile_cont(pm25, 0.75), 6) FROM means"""

_F2 = """f2 AS (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                            l_quantity, l_extendedprice) AS "OBJECTID",
         cast(l_orderkey % 5 AS int) AS "State_Code",
         'state' || (l_orderkey % 5) || '_2020' AS source,
         l_linenumber AS "F_SYSTEM",
         CASE WHEN l_suppkey % 25 = 0 THEN 99999
              WHEN l_suppkey % 25 = 1 THEN NULL
              ELSE cast(l_suppkey % 25 AS int) END AS "URBAN_CODE",
         cast(l_suppkey AS varchar) AS "Route_ID",
         cast(l_quantity AS int) AS "AADT",
         cast(l_partkey % 40 AS int) AS n1,
         cast(l_orderkey % 40 AS int) AS n2
  FROM lineitem)"""

_POINT = "cast({0} AS double) || ' ' || cast({0} * {0} AS double)"
_LINE = _POINT.format("n1") + " || ',' || " + _POINT.format("n2")
_LENGTH = "sqrt(pow(n1 - n2, 2) + pow(n1 * n1 - n2 * n2, 2))"
_MAJOR = """("F_SYSTEM" IN (1, 2, 3) OR ("F_SYSTEM" = 4 AND "URBAN_CODE" <> 99999))"""

_KEPT = _F2 + f""", kept AS (
  SELECT *, coalesce("Route_ID", 'None') || "AADT" AS key
  FROM f2 WHERE {_MAJOR} AND "AADT" > 0 AND n1 <> n2)"""

_GROUPS = """, grouped AS (
  SELECT source, key,
         first("State_Code" ORDER BY "OBJECTID") AS first_state_code,
         first("URBAN_CODE" ORDER BY "OBJECTID") AS first_urban_code,
         first("F_SYSTEM" ORDER BY "OBJECTID") AS first_f_system,
         avg("AADT") AS mean_aadt
  FROM kept GROUP BY source, key)"""

_EDGES = """, e AS (
  SELECT DISTINCT source, key, least(n1, n2) AS a, greatest(n1, n2) AS b FROM kept)"""

# Chains walked vertex by vertex: open ones from each end where they stop, rings
# from their lowest vertex.
_CHAINS = _EDGES + """, half AS (
  SELECT source, key, a AS u, b AS v FROM e UNION ALL SELECT source, key, b, a FROM e),
deg AS (SELECT source, key, u AS n, count(*) AS d FROM half GROUP BY 1, 2, 3),
step AS (SELECT h.*, d FROM half h JOIN deg ON deg.source = h.source AND deg.key = h.key AND n = u),
walk AS (
  SELECT source, key, [u, v] AS line FROM step WHERE d <> 2
  UNION ALL
  SELECT w.source, w.key, list_append(w.line, s.v)
  FROM walk w JOIN step s ON s.source = w.source AND s.key = w.key AND s.d = 2
   AND s.u = w.line[-1] AND s.v <> w.line[-2]),
stopped AS (
  SELECT w.* FROM walk w JOIN deg ON deg.source = w.source AND deg.key = w.key
   AND n = w.line[-1] AND d <> 2),
seen AS (SELECT DISTINCT source, key, unnest(line) AS n FROM stopped),
left_over AS (
  SELECT s.* FROM step s WHERE NOT EXISTS (
    SELECT 1 FROM seen WHERE seen.source = s.source AND seen.key = s.key AND seen.n = s.u)),
round AS (
  SELECT source, key, [u, v] AS line FROM left_over WHERE v > u
  UNION ALL
  SELECT r.source, r.key, list_append(r.line, s.v)
  FROM round r JOIN left_over s ON s.source = r.source AND s.key = r.key
   AND s.u = r.line[-1] AND s.v <> r.line[-2] AND s.v >= r.line[1]
   AND r.line[-1] <> r.line[1]),
chain AS (
  SELECT source, key, line, false AS ring FROM stopped
  WHERE line[1] < line[-1] OR (line[1] = line[-1] AND line[2] < line[-2])
  UNION ALL
  SELECT source, key, line, true FROM round
  WHERE line[1] = line[-1] AND line[2] < line[-2]),
drawn AS (
  SELECT source, key, ring, line, array_to_string(
    [cast(n AS double) || ' ' || cast(n * n AS double) for n in line], ',') AS path FROM chain)"""

_LINES = _CHAINS + _GROUPS + """, numbered AS (
  SELECT drawn.*, g.first_state_code, g.first_urban_code, g.first_f_system, g.mean_aadt,
         cast(row_number() OVER (PARTITION BY drawn.source
              ORDER BY drawn.key, line[1], line[2]) AS int) AS "ID"
  FROM drawn JOIN grouped g ON g.source = drawn.source AND g.key = drawn.key)"""

_EXPORTED = """SELECT {value} AS value, cast(first_state_code AS double) AS state_code,
         cast(first_urban_code AS double) AS urban_code,
         cast(first_f_system AS varchar) AS f_system,
         round(mean_aadt, 6) AS aadt, "ID", path FROM numbered"""

# The 2023 segments: the same rows under text columns and other source names.
_F3 = _F2 + """, f3 AS (
  SELECT "OBJECTID", replace(source, '2020', '2023') AS source, "State_Code" AS st,
         cast("State_Code" AS varchar) AS "StateID", cast("F_SYSTEM" AS varchar) AS "F_SYSTEM",
         cast("URBAN_CODE" AS varchar) AS "URBAN_ID", "Route_ID" AS "RouteID",
         cast("AADT" AS varchar) AS "AADT", n1, n2
  FROM f2)"""
_MAJOR_TEXT = """({0} IN ('1', '2', '3') OR ({0} = '4' AND {1} <> '99999'))"""
_MAJOR_NAMED = _MAJOR_TEXT.format('"F_SYSTEM"', '"URBAN_ID"')

# The opening of a document, as its readers want it.
_OPENING = (
    '{"geometryType":"esriGeometryPolyline","spatialReference":{"wkid":4269},"fields":['
    '{"name":"state_code","type":"esriFieldTypeDouble","alias":"state_code"},'
    '{"name":"urban_code","type":"esriFieldTypeDouble","alias":"urban_code"},'
    '{"name":"f_system","type":"esriFieldTypeString","alias":"f_system","length":255},'
    '{"name":"aadt","type":"esriFieldTypeDouble","alias":"aadt"},'
    '{"name":"ID","type":"esriFieldTypeInteger","alias":"ID"}],"features":['
)
_NESTED = """CASE "State_Code" WHEN 4 THEN 'St.2_2020'
  ELSE 'd' || ("State_Code" % 2) || '/St.' || ("State_Code" // 2) || '_2020' END"""

_FEATURE = """'{"attributes":{"state_code":' || cast(first_state_code AS double)
    || ',"urban_code":' || coalesce(cast(cast(first_urban_code AS double) AS varchar), 'null')
    || ',"f_system":"' || first_f_system || '","aadt":' || mean_aadt || ',"ID":' || "ID"
    || '},"geometry":{"paths":[[[' || replace(replace(path, ',', '],['), ' ', ',')
    || ']]]}}'"""

# Orders on seven supporting lines per priority; places along a line are whole numbers.
_OVERLAPS = """r AS (
  SELECT o_orderpriority AS k, o_orderkey % 7 AS j, o_custkey % 500 AS s, o_custkey % 500 + 1 + o_orderkey % 5 AS e FROM orders
), points AS (SELECT k, j, s AS t FROM r UNION SELECT k, j, e FROM r
), next AS (SELECT *, lead(t) OVER (PARTITION BY k, j ORDER BY t) AS u FROM points)"""


def _overlap_point(place: str, name: str) -> str:
    return (f"(j * 10000 + {place} * [1, 0, 1, 2, 1, 3, 1][j + 1])::DOUBLE AS {name}x, "
            f"({place} * [0, 1, 1, -1, 2, 1, -3][j + 1])::DOUBLE AS {name}y")


_RECURSIVE, _WITH = "WITH RECURSIVE ", "WITH "


def oracles() -> dict[str, str]:
    lines = _RECURSIVE + _KEPT + _LINES
    lines_2023 = _RECURSIVE + _KEPT.replace("_2020", "_2023") + _LINES
    value = "substr(source, 6, 1)"
    return {
        "pm_scan": f'{_WITH}{_F1} SELECT "FIPS", "Date", pm25 FROM f1',
        "pm_distinct_days": f'{_WITH}{_F1} SELECT count(DISTINCT "Date") '
        '+ coalesce(max(cast("Date" IS NULL AS int)), 0) AS n FROM f1',
        "pm_group_mean": f'{_WITH}{_MEANS} SELECT "FIPS", round(pm25, 6) AS pm25 FROM means',
        "pm_describe": f"{_WITH}{_MEANS}{_SUMMARY}",
        "pm_describe_ranked": f"{_WITH}{_MEANS}{_SUMMARY}",
        "air_summary": f"""{_WITH}{_MEANS}
  SELECT 'days' AS stat, cast(count(DISTINCT "Date") AS double) AS value FROM f1
  UNION ALL {_SUMMARY}""",
        "road_scan": f"""{_WITH}{_F2}
  SELECT source, "OBJECTID", "State_Code", "F_SYSTEM", "URBAN_CODE", "Route_ID", "AADT",
         round({_LENGTH}, 6) AS "Shape_Length", {_LINE} AS path FROM f2""",
        "road_sources": f"""{_WITH}{_F2}
  SELECT source, count(*) AS n, min("OBJECTID") AS first_id FROM f2 GROUP BY source""",
        "source_value": f"""{_WITH}{_F2}
  SELECT source, cast(first("State_Code" ORDER BY "OBJECTID") AS varchar) AS value
  FROM f2 GROUP BY source""",
        "road_layouts": f"""{_WITH}{_F3}
  SELECT source, "OBJECTID", "StateID", "F_SYSTEM", "URBAN_ID", "RouteID", "AADT" FROM f3""",
        "road_filter_2020": f"""{_WITH}{_F2}
  SELECT "State_Code", "F_SYSTEM", "URBAN_CODE", "Route_ID", "AADT", {_LINE} AS path
  FROM f2 WHERE {_MAJOR}""",
        "road_positive": f"""{_WITH}{_F2}
  SELECT "State_Code", "F_SYSTEM", "URBAN_CODE", "Route_ID", "AADT", {_LINE} AS path
  FROM f2 WHERE {_MAJOR} AND "AADT" > 0 AND n1 <> n2""",
        "road_length": f"""{_WITH}{_F2}
  SELECT "State_Code", "Route_ID", {_LINE} AS path, round({_LENGTH}, 6) AS length FROM f2""",
        "road_key_2020": f"""{_WITH}{_F2}
  SELECT "State_Code", "Route_ID", "AADT", coalesce("Route_ID", 'None') || "AADT" AS key
  FROM f2""",
        "road_key_strict": f"""{_WITH}{_KEPT}
  SELECT source, '=' || "Route_ID" || '|' || "AADT" AS key, count(*) AS n
  FROM kept GROUP BY source, "Route_ID", "AADT" """,
        "road_filter_2023": f"""{_WITH}{_F3}
  SELECT source, "OBJECTID", "F_SYSTEM", "URBAN_ID", "RouteID", "AADT" FROM f3
  WHERE st < 3 AND {_MAJOR_NAMED}""",
        "road_filter_2023_pos": f"""{_WITH}{_F3}
  SELECT source, "OBJECTID", "F_SYSTEM" AS "Field6", "URBAN_ID" AS "Field8", "RouteID", "AADT"
  FROM f3 WHERE st >= 3 AND {_MAJOR_NAMED}""",
        "road_casts": f"""{_WITH}{_F3}
  SELECT source, "OBJECTID", try_cast("AADT" AS int) AS aadt_num,
         try_cast("F_SYSTEM" AS smallint) AS f_system, try_cast("URBAN_ID" AS int) AS urban_code
  FROM f3""",
        "road_key_2023": f"""{_WITH}{_F3}
  SELECT source, "OBJECTID", "RouteID" || "AADT" AS key FROM f3""",
        "road_dissolve_attrs": f"""{_WITH}{_KEPT}{_GROUPS}
  SELECT source, key, first_state_code, first_urban_code, first_f_system,
         round(mean_aadt, 6) AS mean_aadt FROM grouped""",
        "road_ids": f"""{_WITH}{_KEPT}{_GROUPS}
  SELECT source, key, row_number() OVER (PARTITION BY source ORDER BY key) AS "ID"
  FROM grouped""",
        "road_union_edges": f"""{_WITH}{_KEPT}{_EDGES}
  SELECT source, key, cast(a AS double) AS ax, cast(a * a AS double) AS ay,
         cast(b AS double) AS bx, cast(b * b AS double) AS by FROM e""",
        "road_chains": f"""{_RECURSIVE}{_KEPT}{_CHAINS}
  SELECT source, key, ring, path FROM drawn""",
        "road_singlepart": f"""{_RECURSIVE}{_KEPT}{_CHAINS}{_GROUPS}
  SELECT drawn.source, drawn.key, path, first_state_code, first_urban_code, first_f_system,
         round(mean_aadt, 6) AS mean_aadt
  FROM drawn JOIN grouped g ON g.source = drawn.source AND g.key = drawn.key""",
        "road_chains_long": """WITH r AS (
  SELECT o_orderpriority AS k, o_orderkey,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders),
g AS (
  SELECT k, rn, rn - row_number() OVER (PARTITION BY k ORDER BY rn) AS island
  FROM r WHERE o_orderkey % 97 <> 0)
SELECT k, cast(min(rn) AS double) AS from_x, cast(max(rn) + 1 AS double) AS to_x,
       cast(count(*) AS int) AS edges, count(*) + 1 AS vertices, false AS ring
FROM g GROUP BY k, island""",
        "road_export": f"{lines} {_EXPORTED.format(value=value)}",
        "road_features_json": f"""{lines}
  SELECT {value} AS value, '{{"attributes":{{"state_code":' || cast(first_state_code AS double)
    || ',"urban_code":' || coalesce(cast(cast(first_urban_code AS double) AS varchar), 'null')
    || ',"f_system":"' || first_f_system || '","aadt":' || mean_aadt || ',"ID":' || "ID"
    || '}},"geometry":{{"paths":[[[' || replace(replace(path, ',', '],['), ' ', ',')
    || ']]]}}}}' AS feature FROM numbered""",
        "road_documents": f"""{lines}, named AS (SELECT {value} AS value, * FROM numbered)
  SELECT value, cast("ID" AS bigint) AS place,
         CASE WHEN "ID" = 1 THEN '' ELSE ',' END || {_FEATURE} AS line FROM named
  UNION ALL SELECT DISTINCT value, 0, '{_OPENING}' FROM named
  UNION ALL SELECT value, max("ID") + 1, ']}}' FROM named GROUP BY value""",
        "road_json_files": f"""{lines}
  SELECT 'HPMS2020_' || {value} || '.json' AS name, count(*)::INT AS features, 'esriGeometryPolyline' AS kind,
         max("ID") = count(*) AS in_order, round(sum(mean_aadt), 3) AS aadt FROM numbered GROUP BY source""",
        "road_tables": f"""{lines}
  SELECT 'HPMS2020_' || {value} || '_forJSON' AS source, count(*) AS n, max("ID") AS last, 1 AS refused
  FROM numbered WHERE {value} < '3' GROUP BY ALL""",
        "road_unlabelled": f"""{lines}
  SELECT {value} AS value, count(*) AS n, max("ID") AS last FROM numbered WHERE {value} < '3' GROUP BY ALL""",
        "road_overlap_edges": f"""{_WITH}{_OVERLAPS}
  SELECT DISTINCT p.k, {_overlap_point("p.t", "a")}, {_overlap_point("p.u", "b")}
  FROM next p WHERE EXISTS (SELECT 1 FROM r WHERE r.k = p.k AND r.j = p.j AND s <= p.t AND e >= p.u)""",
        "road_overlaps": f"""{_WITH}{_OVERLAPS}, far AS (
  SELECT *, max(e) OVER (PARTITION BY k, j ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f FROM r
), runs AS (
  SELECT *, sum(CASE WHEN s <= f THEN 0 ELSE 1 END) OVER (PARTITION BY k, j ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run
  FROM far
), spans AS (SELECT k, j, run, min(s) AS t, max(e) AS u FROM runs GROUP BY k, j, run
)
SELECT k, {_overlap_point("t", "a")}, {_overlap_point("u", "b")},
  (SELECT count(*) - 1 FROM points p WHERE p.k = spans.k AND p.j = spans.j AND p.t BETWEEN spans.t AND spans.u)::INT AS edges
FROM spans""",
        "road_tolerance": """WITH r AS (
  SELECT o_orderpriority AS k, o_orderkey AS key, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS n
  FROM orders
), kept AS (
  SELECT k, n, n::DOUBLE + (key % 5 - 2)::DOUBLE * 0.002::DOUBLE AS a, n::DOUBLE + 1 + (key % 7 - 3)::DOUBLE * 0.002::DOUBLE AS b
  FROM r WHERE key % 97 <> 0
), met AS (SELECT m, min(x) AS x FROM (SELECT n AS m, a AS x FROM kept UNION ALL SELECT n + 1, b FROM kept) GROUP BY m
), runs AS (SELECT k, n, n - row_number() OVER (PARTITION BY k ORDER BY n) AS run FROM kept
), spans AS (SELECT k, min(n) AS f, max(n) + 1 AS t, count(*)::INT AS edges FROM runs GROUP BY k, run
)
SELECT k, round(p.x, 6) AS from_x, round(q.x, 6) AS to_x, edges
FROM spans JOIN met p ON p.m = f JOIN met q ON q.m = t""",
        "road_chains_paths": """WITH r AS (
  SELECT o_orderpriority AS k, o_orderkey,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders),
g AS (
  SELECT k, rn, rn - row_number() OVER (PARTITION BY k ORDER BY rn) AS island
  FROM r WHERE o_orderkey % 97 <> 0)
SELECT k, cast(min(rn) AS double) AS from_x, cast(max(rn) + 1 AS double) AS to_x,
       cast(2 * count(*) AS int) AS edges, 2 * count(*) + 1 AS vertices, cast(1 AS bigint) AS steps, false AS ring
FROM g GROUP BY k, island""",
        "road_rejects": f"""{_WITH}{_F3}, s AS (
  SELECT source, "OBJECTID" AS n, "F_SYSTEM", "OBJECTID" % 11 <> 0 AS counted, "OBJECTID" % 13 <> 0 AS routed,
         "OBJECTID" % 17 <> 0 AND "OBJECTID" % 19 <> 0 AS coded,
         CASE WHEN "OBJECTID" % 19 = 0 THEN '5y' ELSE "URBAN_ID" END AS "URBAN_ID",
         cast("AADT" AS int) > 0 AND n1 <> n2 AS positive
  FROM f3)
  SELECT source, n AS "OBJECTID" FROM s
  WHERE {_MAJOR_NAMED} AND (NOT counted OR (positive AND (NOT routed OR NOT coded)))""",
        "road_sources_nested": f"""{_WITH}{_F2}
  SELECT {_NESTED} AS source, count(*) AS n, min("OBJECTID") AS first_id FROM f2 GROUP BY 1""",
        "road_mixed_types": f"""{_WITH}{_KEPT}
  SELECT {_NESTED} AS source, "OBJECTID", coalesce("Route_ID", 'None') || cast("AADT" AS double) AS key,
         cast("AADT" AS double) AS aadt FROM kept""",
        "roads_2020": f"{lines} {_EXPORTED.format(value=value)}",
        "roads_2023": f"{lines_2023} {_EXPORTED.format(value=value)}",
    }

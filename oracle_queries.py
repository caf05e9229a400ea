"""SQL twins of the registered queries, for DuckDB over the same parquet tables.

The stand-in is written out once as common table expressions; a query takes the
prefix it needs. Text concatenation uses ``||`` because ``concat`` skips NULLs
in DuckDB, and integers are cast only where the text is one.
"""

from __future__ import annotations

DIMS = ("market_segment", "return_flag", "line_status", "priority_band", "order_status")
COUNTS = ("start_count", "achievement_count", "participation_count")
PERCENTS = ("starts_percent", "achievements_percent")
MEASURES = COUNTS + PERCENTS
STATUSES = (
    "published",
    "suppressed_low",
    "suppressed_confidential",
    "not_applicable",
    "missing",
    "unrecognised",
)
COMPARED = MEASURES + tuple(f"{m}_status" for m in MEASURES)
INTEGER = "^[+-]?[0-9]+$"
NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def csv(items, form="{0}") -> str:
    return ", ".join(form.format(i) for i in items)


def value(c: str, kind: str) -> str:
    pattern = INTEGER if kind == "BIGINT" else NUMBER
    return f"CASE WHEN regexp_matches(trim({c}), '{pattern}') THEN TRY_CAST(trim({c}) AS {kind}) END"


def status(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 'missing' "
        f"WHEN regexp_matches(trim({c}), '{NUMBER}') THEN 'published' "
        f"WHEN lower(trim({c})) = 'low' THEN 'suppressed_low' "
        f"WHEN lower(trim({c})) = 'c' THEN 'suppressed_confidential' "
        f"WHEN lower(trim({c})) = 'z' THEN 'not_applicable' ELSE 'unrecognised' END"
    )


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def per_mille(a: str, b: str) -> str:
    return f"((2000 * {a} + {b}) // NULLIF(2 * {b}, 0))"


CELLS = f"""
fine AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'R' || r_regionkey AS region_code,
         r_name AS region_name, c_mktsegment AS market_segment, l_returnflag AS return_flag,
         l_linestatus AS line_status,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'High' ELSE 'Normal' END AS priority_band,
         o_orderstatus AS order_status, COUNT(*) AS lines,
         SUM(CAST(l_quantity AS BIGINT)) AS starts,
         COUNT(*) FILTER (l_discount < CAST(0.05 AS DOUBLE)) AS achieved_lines,
         COALESCE(SUM(CAST(l_quantity AS BIGINT)) FILTER (l_discount < CAST(0.05 AS DOUBLE)), 0) AS achievements
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL),
cubed AS (
  SELECT year, region_code, region_name, {csv(DIMS)},
         CAST(SUM(lines) AS BIGINT) AS lines, CAST(SUM(starts) AS BIGINT) AS starts,
         CAST(SUM(achieved_lines) AS BIGINT) AS achieved_lines,
         CAST(SUM(achievements) AS BIGINT) AS achievements
  FROM fine
  GROUP BY GROUPING SETS ((year), (year, region_code, region_name)), CUBE ({csv(DIMS)})),
cells AS (
  SELECT year, CAST(year AS VARCHAR) || lpad(CAST((year + 1) % 100 AS VARCHAR), 2, '0') AS time_period,
         'Calendar year' AS time_identifier,
         CASE WHEN region_code IS NULL THEN 'National' ELSE 'Regional' END AS geographic_level,
         'W1' AS country_code, 'World' AS country_name, region_code, region_name,
         {csv(DIMS, "COALESCE({0}, 'Total') AS {0}")}, lines, starts, achieved_lines, achievements,
         {" + ".join(f"CASE WHEN {d} IS NULL THEN 1 ELSE 0 END" for d in DIMS)} AS depth
  FROM cubed),
hashed AS (
  SELECT *, substr(md5(CAST(year AS VARCHAR) || '|' || geographic_level || '|' || COALESCE(region_code, 'NA')
         || '|' || {" || '|' || ".join(DIMS)}), 1, 2) AS h,
         MAX(CASE WHEN depth = 5 THEN starts END) OVER a AS all_starts,
         MAX(CASE WHEN depth = 5 THEN achievements END) OVER a AS all_achievements
  FROM cells WINDOW a AS (PARTITION BY year, region_code)),
releases AS (
  SELECT * FROM (VALUES
    ('1.0', 'Major', DATE '2025-07-25', 1, DATE '2026-08-20', TRUE),
    ('1.0.1', 'Patch', DATE '2025-10-08', 2, DATE '2026-08-20', TRUE),
    ('1.0.2', 'Patch', DATE '2025-11-27', 3, DATE '2026-08-20', TRUE),
    ('2.0', 'Major', DATE '2026-01-29', 4, DATE '2026-08-20', TRUE),
    ('2.0.1', 'Patch', DATE '2026-03-26', 5, DATE '2026-08-20', TRUE),
    ('2.0.2', 'Patch', DATE '2026-07-16', 6, DATE '2026-08-24', TRUE),
    ('2.0.2', 'Patch', DATE '2026-07-16', 6, DATE '2026-08-22', FALSE))
    AS t(version, version_type, published_at, version_seq, ingest_date, complete)),
extracted AS (
  SELECT c.*, r.*,
         geographic_level = 'Regional' AND h >= 'f8' AS removed,
         geographic_level = 'Regional' AND h >= 'f0' AND h < 'f2' AS paused,
         lines < 6 AND NOT (version_seq >= 5 AND h >= '40' AND h < '80' AND lines = 5) AS low,
         achieved_lines < 6 AS low_achieved,
         ((starts + 5) // 10) * 10
           + CASE WHEN version_seq >= 3 AND h >= 'a0' AND h < 'b0' THEN 10 ELSE 0 END
           + CASE WHEN version_seq >= 6 AND h >= '80' AND h < '90' AND year = 2001 THEN 10 ELSE 0 END
           + CASE WHEN NOT complete AND h >= 'c0' AND h < 'c8' THEN 20 ELSE 0 END AS shown_starts,
         {per_mille("starts", "all_starts")} AS starts_tenths,
         {per_mille("achievements", "all_achievements")} AS achievements_tenths
  FROM hashed c CROSS JOIN releases r),
bronze AS (
  SELECT time_period, time_identifier, geographic_level, country_code, country_name, region_code,
         region_name, {csv(DIMS)},
         CASE WHEN low THEN 'low' ELSE CAST(shown_starts AS VARCHAR) END AS start_count,
         CASE WHEN low_achieved THEN 'low' ELSE CAST(((achievements + 5) // 10) * 10 AS VARCHAR) END
           AS achievement_count,
         CASE WHEN depth < 3 THEN 'z' WHEN version_seq >= 3 AND h >= 'd0' AND h < 'd4' THEN NULL
              WHEN lines < 6 THEN 'low'
              ELSE CAST(((lines + 5) // 10) * 10 AS VARCHAR) END AS participation_count,
         CASE WHEN low THEN 'c'
              WHEN version_seq < 4 AND starts_tenths % 10 = 0 THEN CAST(starts_tenths // 10 AS VARCHAR)
              ELSE CAST(starts_tenths // 10 AS VARCHAR) || '.' || CAST(starts_tenths % 10 AS VARCHAR) END
           AS starts_percent,
         CASE WHEN low_achieved THEN 'c'
              WHEN version_seq < 4 AND achievements_tenths % 10 = 0
                THEN CAST(achievements_tenths // 10 AS VARCHAR)
              ELSE CAST(achievements_tenths // 10 AS VARCHAR) || '.' || CAST(achievements_tenths % 10 AS VARCHAR) END
           AS achievements_percent,
         version, ingest_date, complete
  FROM extracted
  WHERE (complete OR h >= '10') AND CASE
    WHEN version_seq <= 2 THEN year < 2001 AND h >= '20'
    WHEN version_seq = 3 THEN year < 2001 AND NOT (h >= '10' AND h < '20') AND NOT removed
    WHEN version_seq = 5 THEN NOT removed AND NOT paused
    ELSE NOT removed END),
versions AS (
  SELECT r.version, r.version_type, r.published_at, n.total_results,
         CAST(r.version_seq AS BIGINT) AS version_seq
  FROM releases r JOIN (SELECT version, COUNT(*) AS total_results FROM bronze WHERE complete GROUP BY version) n
    ON r.version = n.version
  WHERE r.complete)"""

LATEST = f"""
latest AS (
  SELECT * FROM bronze
  QUALIFY ingest_date = MAX(ingest_date) OVER (
    PARTITION BY version, time_period, geographic_level, region_code, {csv(DIMS)}))"""

SILVER = f"""
silver AS (
  SELECT md5(substr(time_period, 1, 4) || '|' || geographic_level || '|' || COALESCE(region_code, 'NA')
             || '|' || {" || '|' || ".join(DIMS)}) AS row_key,
         version AS dataset_version, ingest_date AS ingested_date,
         CAST(substr(time_period, 1, 4) AS BIGINT) AS academic_year_start,
         CAST(substr(time_period, 1, 4) AS BIGINT) + 1 AS academic_year_end,
         substr(time_period, 1, 4) || '/' || substr(time_period, 5, 2) AS academic_year_label,
         time_identifier, geographic_level, country_code, country_name, region_code, region_name,
         {csv(DIMS)},
         {csv(f"{value(m, 'BIGINT' if m in COUNTS else 'DOUBLE')} AS {m}, {status(m)} AS {m}_status" for m in MEASURES)},
         CAST({" + ".join(f"CASE WHEN {d} = 'Total' THEN 1 ELSE 0 END" for d in DIMS)} AS INTEGER) AS aggregation_depth,
         {" AND ".join(f"{d} <> 'Total'" for d in DIMS)} AS is_detail_grain,
         substr(time_period, 1, 4) = '2001' AS is_provisional,
         {" || '~' || ".join(f"COALESCE({m}, '(blank)')" for m in MEASURES)} AS raw_fingerprint
  FROM latest)"""

CARRIED = (
    "academic_year_start",
    "academic_year_label",
    "geographic_level",
    "country_code",
    "country_name",
    "region_code",
    "region_name",
    *DIMS,
    "aggregation_depth",
    "is_detail_grain",
    "is_provisional",
)


def scd2_ctes(source, key, compared, carried, version, name, gap=False) -> str:
    """History of ``source`` as ``name``.

    A version that differs from the key's version before starts a record, which
    ends with the version before the next start.
    """
    keys = csv(key)
    same = " AND ".join(f"{{0}}.{k} = {{1}}.{k}" for k in key)
    differs = " OR ".join(f"c.{x} IS DISTINCT FROM p.{x}" for x in compared)
    if gap:
        differs += " OR c.version_seq > p.version_seq + 1"
    return f"""
{name}_nth AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY version_seq) AS nth,
         COUNT(*) OVER (PARTITION BY {keys}) AS held
  FROM {source}),
{name}_starts AS (
  SELECT {csv(key, "c.{0}")}, c.nth, c.version_seq AS valid_from_seq, c.{version} AS valid_from_version,
         c.published_at AS valid_from_published
  FROM {name}_nth c LEFT JOIN {name}_nth p ON {same.format("c", "p")} AND c.nth = p.nth + 1
  WHERE p.nth IS NULL OR {differs}),
{name}_spans AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY nth) AS validity_group,
         LEAD(nth) OVER (PARTITION BY {keys} ORDER BY nth) AS following
  FROM {name}_starts),
{name} AS (
  SELECT {csv(key, "s.{0}")}, validity_group, valid_from_seq, e.version_seq AS valid_to_seq,
         valid_from_version, e.{version} AS valid_to_version, valid_from_published,
         {csv([*carried, *compared], "e.{0}")},
         e.version_seq = newest AS is_current, e.version_seq < newest AS is_soft_deleted,
         following IS NOT NULL AS is_superseded
  FROM {name}_spans s
  JOIN {name}_nth e ON {same.format("s", "e")} AND e.nth = COALESCE(following - 1, e.held),
       (SELECT MAX(version_seq) AS newest FROM {source}))"""


BASE = """
base AS (
  SELECT s.*, v.version_seq, v.published_at
  FROM silver s JOIN versions v ON s.dataset_version = v.version)"""
FACT = BASE + "," + scd2_ctes("base", ("row_key",), COMPARED, CARRIED, "dataset_version", "fact")

YEAR = "academic_year_start, academic_year_label, is_provisional"
TRENDS = f"""
trends AS (
  SELECT {YEAR}, region_code, region_name, market_segment,
         CAST(SUM(start_count) AS BIGINT) AS starts, CAST(SUM(achievement_count) AS BIGINT) AS achievements,
         CAST(SUM(participation_count) AS BIGINT) AS participation,
         COUNT(*) FILTER (start_count_status = 'published') AS start_rows_published,
         COUNT(*) FILTER (start_count_status <> 'published') AS start_rows_suppressed,
         {ratio("COUNT(*) FILTER (start_count_status <> 'published')", "COUNT(*)")} AS suppression_rate,
         {ratio("SUM(achievement_count)", "SUM(start_count)")} AS achievement_ratio
  FROM fact WHERE is_current AND is_detail_grain AND geographic_level = 'Regional'
  GROUP BY ALL)"""

def restated_ctes(fact, key, carried, measure, name) -> str:
    """Every record of ``fact`` beside the one of its key before it."""
    same = " AND ".join(f"c.{k} = p.{k}" for k in key)
    delta = f"c.{measure} - p.{measure}"
    return f"""
{name} AS (
  SELECT {csv([*key, *carried], "c.{0}")}, p.valid_from_version AS restated_from_version,
         c.valid_from_version AS restated_in_version, c.valid_from_published AS restated_on,
         p.{measure} AS {measure}_before, c.{measure} AS {measure}_after, {delta} AS {measure}_delta,
         {ratio(f"({delta})", f"p.{measure}")} AS {measure}_pct_change,
         p.{measure}_status AS status_before, c.{measure}_status AS status_after,
         p.{measure}_status <> c.{measure}_status AS disclosure_status_changed
  FROM {fact} c JOIN {fact} p ON {same} AND c.validity_group = p.validity_group + 1)"""


RESTATED = restated_ctes(
    "fact",
    ("row_key",),
    (
        "academic_year_label",
        "geographic_level",
        "region_name",
        "market_segment",
        "line_status",
        "order_status",
    ),
    "start_count",
    "restated",
)

SERIES_LEVELS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")


def series(name: str, provisional: bool) -> str:
    held = "is_provisional" if provisional else "NOT is_provisional"
    return f"""
{name} AS (
  SELECT level, academic_year_start, make_date(academic_year_start, 9, 1) AS yr,
         {ratio("SUM(CASE WHEN market_segment = level THEN start_count ELSE 0 END)", "SUM(start_count)")} AS share
  FROM fact, (VALUES {csv(SERIES_LEVELS, "('{0}')")}) l(level)
  WHERE is_current AND is_detail_grain AND geographic_level = 'National'
    AND market_segment <> 'MACHINERY' AND {held}
  GROUP BY level, academic_year_start)"""


FORECAST = """
steps AS (
  SELECT *, share - lag(share) OVER (PARTITION BY level ORDER BY academic_year_start) AS step FROM series),
fitted AS (
  SELECT level, COUNT(share) AS n, MAX(academic_year_start) AS last_t,
         arg_min(share, academic_year_start) AS first_y, arg_max(share, academic_year_start) AS last_y,
         stddev_samp(step) AS sigma
  FROM steps GROUP BY level),
forecast AS (
  SELECT level, last_t + h AS academic_year_start, CAST(h AS INTEGER) AS h, n,
         (last_y - first_y) / (n - 1) AS drift, sigma,
         last_y + (last_y - first_y) / (n - 1) * h AS forecast,
         last_y + (last_y - first_y) / (n - 1) * h - 1.959963984540054 * sigma * sqrt(h) AS lower,
         last_y + (last_y - first_y) / (n - 1) * h + 1.959963984540054 * sigma * sqrt(h) AS upper
  FROM fitted, range(1, 5) r(h) WHERE n > 1)"""

LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_MEASURES = {"quantity": "BIGINT", "discount_percent": "DOUBLE", "tax_percent": "DOUBLE"}
LINE_TYPED = (*LINE_MEASURES, *[f"{m}_status" for m in LINE_MEASURES])
LINE_CARRY = ("l_returnflag", "l_linestatus")
LINES = f"""
register AS (
  SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS VARCHAR) AS version,
         CAST(year(l_shipdate) AS BIGINT) AS version_seq, make_date(year(l_shipdate), 12, 31) AS published_at,
         CAST(l_shipdate AS DATE) AS ingest_date, l_returnflag, l_linestatus,
         CASE WHEN l_quantity < 6 THEN 'low' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
         CASE WHEN l_quantity < 6 THEN 'c'
              ELSE CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR)
                || CASE WHEN year(l_shipdate) >= 1998 THEN '.0' ELSE '' END END AS discount_percent,
         CASE WHEN l_tax = 0 THEN 'z' ELSE CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR) END AS tax_percent
  FROM lineitem),
newest_lines AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
      PARTITION BY version, l_orderkey, l_linenumber
      ORDER BY ingest_date DESC, quantity DESC, discount_percent DESC, tax_percent DESC,
               l_returnflag DESC, l_linestatus DESC) AS rn FROM register)
  WHERE rn = 1),
typed_lines AS (
  SELECT l_orderkey, l_linenumber, version, version_seq, published_at, l_returnflag, l_linestatus,
         {csv(f"{value(m, t)} AS {m}, {status(m)} AS {m}_status, {m} AS {m}_text" for m, t in LINE_MEASURES.items())}
  FROM newest_lines)"""
LINE_FACT = LINES + "," + scd2_ctes(
    "typed_lines", LINE_KEY, LINE_TYPED, LINE_CARRY, "version", "line_fact"
)
LINE_RESTATED = restated_ctes("line_fact", LINE_KEY, (), "quantity", "line_restated")

RECORD = (
    "validity_group, valid_from_seq, valid_to_seq, valid_from_version, valid_to_version, "
    "CAST(valid_from_published AS VARCHAR) AS valid_from_published"
)
FLAGS = "is_current, is_soft_deleted, is_superseded"
FACT_COLUMNS = f"row_key, {RECORD}, {csv(CARRIED)}, {csv(COMPARED)}, {FLAGS}"
LINE_COLUMNS = f"{csv(LINE_KEY)}, {RECORD}, {csv(LINE_CARRY)}, {csv(LINE_TYPED)}, {FLAGS}"
RESTATED_COLUMNS = "* REPLACE (CAST(restated_on AS VARCHAR) AS restated_on)"


LANDED = (
    "time_period", "time_identifier", "geographic_level", "country_code", "country_name",
    "region_code", "region_name", *DIMS, *MEASURES,
)
DIGESTS = CELLS + f""",
marked AS (
  SELECT version, ingest_date, md5({" || ".join(
      f"CASE WHEN {c} IS NULL THEN '-' ELSE length({c}) || ':' || {c} END" for c in LANDED
  )}) AS m FROM bronze),
loads AS (
  SELECT version, ingest_date, COUNT(*) AS row_count, {" || '-' || ".join(
      f"CAST(SUM(CAST('0x' || substr(m, {1 + 8 * k}, 8) AS BIGINT)) AS VARCHAR)" for k in range(4)
  )} AS digest
  FROM marked GROUP BY version, ingest_date)"""


def deltas(source: str, key, text, typed) -> str:
    """Added, removed and restated rows per adjacent pair, by full outer joins."""
    same = " AND ".join(f"c.{k} = p.{k}" for k in key)

    def differs(cols):
        return " OR ".join(f"c.{x} IS DISTINCT FROM p.{x}" for x in cols)

    either = f"c.{key[0]} IS NOT NULL AND p.{key[0]} IS NOT NULL"
    return f"""
pairs AS (
  SELECT COALESCE(c.version_seq, p.version_seq + 1) AS version_seq,
         COUNT(c.{key[0]}) AS row_count,
         COUNT(*) FILTER (p.{key[0]} IS NULL) AS added,
         COUNT(*) FILTER (c.{key[0]} IS NULL) AS removed,
         COUNT(*) FILTER ({either} AND ({differs(text)})) AS restated,
         COUNT(*) FILTER ({either} AND ({differs(typed)})) AS restated_typed
  FROM {source} c FULL OUTER JOIN {source} p ON {same} AND c.version_seq = p.version_seq + 1
  GROUP BY 1)"""


def q(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


TO_SILVER = f"{CELLS},{LATEST},{SILVER}"
TO_FACT = f"{TO_SILVER},{FACT}"
TO_TRENDS = f"{TO_FACT},{TRENDS}"
TO_RESTATED = f"{TO_FACT},{RESTATED}"
TO_SERIES = f"{TO_FACT},{series('series', False)}"
TO_FORECAST = f"{TO_SERIES},{FORECAST}"

SIDES = f"""
SELECT *, detail_starts - published_starts AS difference,
       {ratio("abs(detail_starts - published_starts)", "published_starts")} AS rel_error
FROM (SELECT academic_year_start,
             CAST(SUM(start_count) FILTER (is_detail_grain) AS BIGINT) AS detail_starts,
             MAX(start_count) FILTER (aggregation_depth = 5) AS published_starts
      FROM fact WHERE is_current AND geographic_level = 'National'
      GROUP BY academic_year_start HAVING bool_or(is_detail_grain) AND published_starts IS NOT NULL)"""

PROOF_SCORED = f"""
scored AS (
  SELECT {value("start_count", "BIGINT")} AS starts,
         {" + ".join(f"CASE WHEN {d} = 'Total' THEN 1 ELSE 0 END" for d in DIMS)} AS depth
  FROM latest WHERE version = '2.0.2' AND time_period = '200001' AND geographic_level = 'National')"""


CURRENT = "current_cells AS (SELECT * FROM fact WHERE is_current)"
AREA_YEAR = ("academic_year_start", "geographic_level", "region_code")
CUBE_DIMS = ("l_returnflag", "l_linestatus", "discount_band")
SUPPLIER_CUBE = f"""
pieces_cube AS (
  SELECT l_suppkey, {csv(CUBE_DIMS, "COALESCE({0}, 'Total') AS {0}")}, COUNT(*) AS lines,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS starts
  FROM (SELECT *, CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) AS discount_band FROM lineitem)
  GROUP BY l_suppkey, CUBE ({csv(CUBE_DIMS)})),
supplier_cube AS (
  SELECT l_suppkey, {csv(CUBE_DIMS)}, CASE WHEN lines >= 6 THEN (starts + 5) // 10 * 10 END AS pieces,
         CASE WHEN lines < 6 THEN 'suppressed_low' ELSE 'published' END AS pieces_status
  FROM pieces_cube)"""


def limits(source, by, dims, measure) -> str:
    """Cells with the least and greatest count they can stand for."""
    return f"""
limits AS MATERIALIZED (
  SELECT {csv((*by, *dims))}, {measure} AS n, {measure}_status AS status,
         CAST(CASE WHEN {measure} > 5 THEN {measure} - 5 ELSE 0 END AS BIGINT) AS least,
         CAST(CASE WHEN {measure} IS NOT NULL THEN {measure} + 5
                   WHEN {measure}_status = 'suppressed_low' THEN 250 END AS BIGINT) AS most
  FROM {source})"""


def same(a, b, names) -> str:
    return " AND ".join(f"{a}.{n} IS NOT DISTINCT FROM {b}.{n}" for n in names)


def lattice_sql(ctes, source, by, dims, measure) -> str:
    detail = " AND ".join(f"{d} <> 'Total'" for d in dims)
    return q(f"""{ctes},{limits(source, by, dims, measure)},
sums AS (
  SELECT {csv(by)}, {csv(dims, "COALESCE({0}, 'Total') AS {0}")}, COUNT(*) AS cells, COUNT(*) - COUNT(n) AS hidden,
         SUM(n) AS total, SUM(least) AS lo, SUM(most) AS hi, COUNT(*) - COUNT(most) AS boundless
  FROM limits WHERE {detail} GROUP BY {csv(by)}, CUBE ({csv(dims)})),
held AS (
  SELECT {csv((*by, *dims), "p.{0}")}, p.n AS published, COALESCE(cells, 0) AS detail_cells,
         COALESCE(hidden, 0) AS withheld_cells, CAST(COALESCE(total, 0) AS BIGINT) AS detail_sum,
         CAST(COALESCE(lo, 0) AS BIGINT) AS least,
         CAST(CASE WHEN COALESCE(boundless, 0) = 0 THEN COALESCE(hi, 0) END AS BIGINT) AS most
  FROM limits p LEFT JOIN sums s ON {same("p", "s", (*by, *dims))}
  WHERE p.n IS NOT NULL AND NOT ({csv(dims, "p.{0} <> 'Total'").replace(",", " AND ")}))""", """
SELECT *, CASE WHEN published - 5 > most THEN 'above detail' WHEN published + 5 < least THEN 'below detail'
               ELSE 'holds' END AS verdict FROM held""")


def bounds_ctes(ctes, source, by, dims, measure, rounds=2) -> str:
    """Bounds of withheld cells; each step joins the cells with the sums of their lines."""
    steps = [f"{ctes},{limits(source, by, dims, measure)},\ns0 AS MATERIALIZED (SELECT *, least AS least0, most AS most0 FROM limits)"]
    for k, d in enumerate(list(dims) * rounds):
        line = [*by, *[x for x in dims if x != d]]
        steps.append(f"""
l{k} AS MATERIALIZED (
  SELECT {csv(line)}, MAX(least) FILTER ({d} = 'Total') AS tl, MAX(most) FILTER ({d} = 'Total') AS th,
         COALESCE(SUM(least) FILTER ({d} <> 'Total'), 0) AS lo, COALESCE(SUM(most) FILTER ({d} <> 'Total'), 0) AS hi,
         COUNT(*) FILTER ({d} <> 'Total' AND most IS NULL) AS free
  FROM s{k} GROUP BY ALL),
s{k + 1} AS MATERIALIZED (
  SELECT s.* REPLACE (
    CAST(CASE WHEN tl IS NULL OR COALESCE(th < lo, FALSE) OR free = 0 AND hi < tl THEN least
              WHEN {d} = 'Total' THEN CASE WHEN lo > least THEN lo ELSE least END
              WHEN free = 0 AND tl - (hi - most) > least THEN tl - (hi - most)
              WHEN free = 1 AND most IS NULL AND tl - hi > least THEN tl - hi
              ELSE least END AS BIGINT) AS least,
    CAST(CASE WHEN tl IS NULL OR COALESCE(th < lo, FALSE) OR free = 0 AND hi < tl THEN most
              WHEN {d} = 'Total' THEN CASE WHEN free = 0 AND (most IS NULL OR hi < most) THEN hi ELSE most END
              WHEN most IS NULL OR th - lo + least < most THEN th - lo + least
              ELSE most END AS BIGINT) AS most)
  FROM s{k} s JOIN l{k} l ON {same("s", "l", line)})""")
    last = len(dims) * rounds
    steps.append(f"""
bounds AS (
  SELECT {csv((*by, *dims))}, status, least, most, least > least0 OR most IS DISTINCT FROM most0 AS narrowed,
         COALESCE(most - least <= 10, FALSE) AS revealed
  FROM s{last} WHERE status IS DISTINCT FROM 'published')""")
    return ",".join(steps)


def union_counts(rows) -> str:
    """One row per check: its name and a count query over its failing rows."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", (SELECT COUNT(*) FROM {failing}) AS failing_rows"
        for name, failing in rows
    )


ACCEPTED = csv([s for s in STATUSES if s != "unrecognised"], "'{0}'")
SILVER_CHECKS = [
    *[
        (f"not_null {c}", f"silver WHERE {c} IS NULL")
        for c in ("row_key", "dataset_version", "academic_year_start", "aggregation_depth")
    ],
    ("range academic_year_start", "silver WHERE academic_year_start NOT BETWEEN 1995 AND 2001"),
    ("values aggregation_depth", "silver WHERE aggregation_depth NOT IN (0, 1, 2, 3, 4, 5)"),
    *[
        check
        for m in MEASURES
        for check in (
            (f"values {m}_status", f"silver WHERE {m}_status NOT IN ({ACCEPTED})"),
            (f"withheld with value {m}", f"silver WHERE {m}_status <> 'published' AND {m} IS NOT NULL"),
            (f"published without value {m}", f"silver WHERE {m}_status = 'published' AND {m} IS NULL"),
        )
    ],
    (
        "unique row_key, dataset_version",
        "(SELECT 1 FROM silver GROUP BY row_key, dataset_version HAVING COUNT(*) > 1)",
    ),
    (
        "relationship dataset_version",
        "silver WHERE dataset_version NOT IN (SELECT version FROM versions)",
    ),
]
FACT_CHECKS = [
    *[(f"not_null {c}", f"fact WHERE {c} IS NULL") for c in ("row_key", "valid_from_seq", "is_current")],
    (
        "unique row_key, valid_from_seq",
        "(SELECT 1 FROM fact GROUP BY row_key, valid_from_seq HAVING COUNT(*) > 1)",
    ),
    (
        "current records match newest version",
        "(SELECT COUNT(*) FILTER (is_current) AS n FROM fact) "
        "WHERE n <> (SELECT arg_max(total_results, version_seq) FROM versions)",
    ),
    ("detail reconciles to published total", f"({SIDES}) WHERE rel_error > 0.001"),
    (
        "at least two versions in lineage",
        "(SELECT COUNT(DISTINCT valid_from_version) AS n FROM fact) WHERE n < 2",
    ),
]

HISTORY = scd2_ctes("base", ("row_key",), COMPARED, CARRIED, "dataset_version", "gapped", gap=True)

def totals_sql(records, group, measures):
    """Totals of the current records, NULL where nothing is published."""
    shown = [
        f"""CAST(SUM(CASE WHEN {m}_status = 'published' THEN {m} END) AS BIGINT) AS total_{m},
        COUNT(*) FILTER (WHERE {m}_status <> 'published') AS {m}_withheld,
        COUNT(*) FILTER (WHERE {m}_status <> 'published') / COUNT(*) AS {m}_withheld_share"""
        for m in measures
    ]
    return (
        f"SELECT {csv(group)}, COUNT(*) AS record_count, {', '.join(shown)} "
        f"FROM {records} WHERE is_current GROUP BY {csv(group)}"
    )


ORACLE: dict[str, str] = {
    "bronze_scan": q(CELLS, f"""
      SELECT time_period, time_identifier, geographic_level, country_code, country_name, region_code,
             region_name, {csv(DIMS)}, {csv(MEASURES)}, version, CAST(ingest_date AS VARCHAR) AS ingest_date
      FROM bronze"""),
    "bronze_version_counts": q(CELLS, """
      SELECT version, CAST(ingest_date AS VARCHAR) AS ingest_date, COUNT(*) AS row_count
      FROM bronze GROUP BY ALL"""),
    "bronze_manifest": q(DIGESTS, """
      SELECT 'standin' AS dataset_id, version AS dataset_version,
             CAST(ingest_date AS VARCHAR) AS ingest_date, row_count, digest FROM loads"""),
    "bronze_files": q(DIGESTS, """
      SELECT version, CAST(ingest_date AS VARCHAR) AS ingest_date, row_count, digest FROM loads"""),
    "manifest_reconcile": q(CELLS, """
      SELECT b.version AS dataset_version, CAST(b.ingest_date AS VARCHAR) AS ingest_date,
             b.row_count, v.total_results, b.row_count = v.total_results AS matches
      FROM (SELECT version, ingest_date, COUNT(*) AS row_count FROM bronze GROUP BY ALL) b
      LEFT JOIN versions v ON b.version = v.version"""),
    "dataset_versions": q(CELLS, """
      SELECT version, version_type, CAST(published_at AS VARCHAR) AS published_at, total_results, version_seq
      FROM versions"""),
    "version_history_json": q(CELLS, """
      SELECT v.version, v.version_type AS type,
             CASE WHEN v.version = '1.0.1' THEN '' ELSE 'Published' END AS status,
             CAST(v.published_at AS VARCHAR) || 'T09:30:00Z' AS published, v.total_results,
             CASE WHEN v.version = '1.0.1' THEN '' ELSE p.first END AS time_period_start,
             CASE WHEN v.version = '1.0.1' THEN '' ELSE p.last END AS time_period_end
      FROM versions v JOIN (
        SELECT version, MIN(substr(time_period, 1, 4) || '/' || substr(time_period, 5, 2)) AS first,
               MAX(substr(time_period, 1, 4) || '/' || substr(time_period, 5, 2)) AS last
        FROM bronze GROUP BY version) p ON v.version = p.version"""),
    "version_listing": q(CELLS, """
      SELECT v.version, v.version_type AS type, CAST(v.published_at AS VARCHAR) AS published,
             v.total_results AS row_count,
             CASE WHEN v.version = '1.0.1' THEN '..' ELSE p.first || '..' || p.last END AS periods
      FROM versions v JOIN (
        SELECT version, MIN(substr(time_period, 1, 4) || '/' || substr(time_period, 5, 2)) AS first,
               MAX(substr(time_period, 1, 4) || '/' || substr(time_period, 5, 2)) AS last
        FROM bronze GROUP BY version) p ON v.version = p.version"""),
    "query_pages": q(CELLS, """
      SELECT time_period, region_code, market_segment, start_count, achievement_count
      FROM bronze WHERE version = '2.0.2' AND complete AND geographic_level = 'Regional'
        AND market_segment <> 'Total'"""),
    "paging_check": q(CELLS, """
      SELECT CAST(p AS INTEGER) AS page, CASE WHEN p % 7 = 3 THEN 'missing' ELSE 'repeated' END AS problem,
             CASE WHEN p % 7 = 3 THEN 0 ELSE 2 END::BIGINT AS copies
      FROM (
        SELECT unnest(range(1, count(*) + 1)) AS p FROM (
          SELECT DISTINCT time_period, geographic_level, region_code, market_segment
          FROM bronze WHERE version = '2.0.2' AND complete))
      WHERE p % 7 = 3 OR p % 5 = 0"""),
    "lines_page_problems": """
      WITH seen AS (
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL
      ), wanted AS (
        SELECT l_orderkey, unnest(range(1, max(l_linenumber) + 1)) AS l_linenumber FROM lineitem GROUP BY 1
      )
      SELECT w.l_orderkey, CAST(w.l_linenumber AS INTEGER) AS page,
             CASE WHEN s.copies IS NULL THEN 'missing' ELSE 'repeated' END AS problem,
             coalesce(s.copies, 0) AS copies
      FROM wanted w LEFT JOIN seen s USING (l_orderkey, l_linenumber)
      WHERE s.copies IS NULL OR s.copies > 1""",
    "metadata_labels": q(TO_SILVER, " UNION ALL ".join([
        *[f"SELECT DISTINCT 'filter' AS kind, '{d}' AS \"of\", {d} AS id, {d} AS label FROM silver "
          "WHERE dataset_version = '2.0.2'" for d in DIMS],
        *[f"SELECT 'indicator', '', '{m}', '{m.replace('_', ' ').capitalize()}'" for m in MEASURES],
        "SELECT DISTINCT 'location', 'Regional', region_code, region_name FROM silver "
        "WHERE dataset_version = '2.0.2' AND region_code IS NOT NULL",
        "SELECT DISTINCT 'period', 'CY', CAST(academic_year_start AS VARCHAR), academic_year_label "
        "FROM silver WHERE dataset_version = '2.0.2'",
    ])),
    "version_decision": q(CELLS, """
      SELECT version AS latest_version, previous AS previous_version,
             CASE WHEN version = previous THEN 'skip' ELSE 'extract' END AS action,
             CASE WHEN version = previous THEN 0 ELSE n END AS rows_to_load
      FROM (SELECT b.version, b.n, arg_max(e.version, (e.ingest_date, e.s)) AS previous
            FROM load_list b
            LEFT JOIN load_list e ON (e.ingest_date, e.s) < (b.ingest_date, b.s)
            GROUP BY b.version, b.ingest_date, b.n)""").replace("versions AS (", """load_list AS (
  SELECT b.version, ingest_date, COUNT(*) AS n, MAX(r.seq) AS s
  FROM bronze b JOIN (SELECT DISTINCT version, version_seq AS seq FROM releases) r ON b.version = r.version
  GROUP BY b.version, ingest_date),
versions AS (""", 1),
    "typed_measures": q(TO_SILVER, f"""
      SELECT row_key, dataset_version, {csv(MEASURES)}, {csv(MEASURES, "{0}_status")} FROM silver"""),
    "aggregation_depth": q(TO_SILVER, """
      SELECT row_key, dataset_version, aggregation_depth, is_detail_grain FROM silver"""),
    "academic_year_parse": q(CELLS, """
      SELECT time_period, CAST(substr(time_period, 1, 4) AS BIGINT) AS academic_year_start,
             CAST(substr(time_period, 1, 4) AS BIGINT) + 1 AS academic_year_end,
             substr(time_period, 1, 4) || '/' || substr(time_period, 5, 2) AS academic_year_label,
             COUNT(*) AS row_count
      FROM bronze GROUP BY ALL"""),
    "natural_key": q(TO_SILVER, f"""
      SELECT DISTINCT row_key, academic_year_start, geographic_level, region_code, {csv(DIMS)} FROM silver"""),
    "silver": q(TO_SILVER, """
      SELECT * EXCLUDE (raw_fingerprint) REPLACE (CAST(ingested_date AS VARCHAR) AS ingested_date)
      FROM silver"""),
    "latest_extraction": q(f"{CELLS},{LATEST}", f"""
      SELECT version, CAST(ingest_date AS VARCHAR) AS ingest_date, time_period, geographic_level,
             region_code, {csv(DIMS)}, {csv(MEASURES)} FROM latest"""),
    "scd2_fact": q(TO_FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
    "scd2_break_on_gap": q(
        f"{TO_SILVER},{BASE},{HISTORY}",
        f"SELECT {FACT_COLUMNS} FROM gapped",
    ),
    "scd2_extended": q(TO_FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
    "scd2_spliced": q(TO_FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
    "incremental_load": q(TO_FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
    "as_of_version": q(TO_FACT, f"""
      SELECT row_key, valid_from_seq, valid_to_seq, {csv(CARRIED)}, {csv(COMPARED)}
      FROM fact WHERE 3 BETWEEN valid_from_seq AND valid_to_seq"""),
    "typed_vs_string_diff": q(
        f"{TO_FACT},{scd2_ctes('base', ('row_key',), ('raw_fingerprint',), (), 'dataset_version', 'text_fact')}",
        """
      SELECT 'STRING diff (naive)' AS method, COUNT(*) AS scd2_records FROM text_fact
      UNION ALL SELECT 'TYPED diff (shipped)', COUNT(*) FROM fact"""),
    "restatement_history": q(TO_RESTATED, f"SELECT {RESTATED_COLUMNS} FROM restated"),
    "version_deltas": q(
        f"{TO_SILVER},{BASE},{deltas('base', ('row_key',), ('raw_fingerprint',), COMPARED)}",
        """
      SELECT p.version_seq, v.version, v.version_type, row_count, added, removed, restated, restated_typed
      FROM pairs p JOIN versions v ON p.version_seq = v.version_seq"""),
    "double_count_proof": q(f"{CELLS},{LATEST},{PROOF_SCORED}", """
      SELECT method, CAST(SUM(starts) AS BIGINT) AS total_starts, COUNT(*) AS rows_used
      FROM scored JOIN (VALUES ('NAIVE  SUM(all rows)', 0, 5), ('CORRECT detail grain only', 0, 0),
                               ('OFFICIAL published total', 5, 5)) m(method, low, high)
        ON depth BETWEEN low AND high
      GROUP BY method"""),
    "depth_histogram": q(TO_SILVER, """
      SELECT dataset_version, aggregation_depth, COUNT(*) AS row_count FROM silver GROUP BY ALL"""),
    "marker_profile": q(TO_SILVER, " UNION ALL ".join(f"""
      SELECT dataset_version, '{m}' AS measure, status, cells,
             CAST(cells AS DOUBLE) / CAST(SUM(cells) OVER (PARTITION BY dataset_version) AS DOUBLE) AS share
      FROM (SELECT dataset_version, {m}_status AS status, COUNT(*) AS cells FROM silver GROUP BY ALL)"""
      for m in MEASURES)),
    "rounding_check": q(TO_SILVER, " UNION ALL ".join(f"""
      SELECT '{m}' AS measure, COUNT({m}) AS published_values,
             COUNT(*) FILTER ({m} % 10 = 0) AS rounded_values, MIN({m}) AS min_value,
             COUNT({m}) = COUNT(*) FILTER ({m} % 10 = 0) AS all_rounded FROM silver""" for m in COUNTS)),
    "reconciliation": q(TO_FACT, f"SELECT *, rel_error <= 0.001 AS within_tolerance FROM ({SIDES})"),
    "lattice_reconciliation": lattice_sql(f"{TO_FACT},{CURRENT}", "current_cells", AREA_YEAR, DIMS, "start_count"),
    "withheld_bounds": q(
        bounds_ctes(f"{TO_FACT},{CURRENT}", "current_cells", AREA_YEAR, DIMS, "start_count"), "SELECT * FROM bounds"),
    "disclosure_by_area": q(
        bounds_ctes(f"{TO_FACT},{CURRENT}", "current_cells", AREA_YEAR, DIMS, "start_count"), f"""
      SELECT {csv(AREA_YEAR)}, COUNT(*) AS withheld_cells, COUNT(*) FILTER (narrowed) AS narrowed_cells,
             COUNT(*) FILTER (revealed) AS revealed_cells
      FROM bounds GROUP BY ALL"""),
    "lines_lattice": lattice_sql(SUPPLIER_CUBE, "supplier_cube", ("l_suppkey",), CUBE_DIMS, "pieces"),
    "lines_withheld_bounds": q(
        bounds_ctes(SUPPLIER_CUBE, "supplier_cube", ("l_suppkey",), CUBE_DIMS, "pieces"), "SELECT * FROM bounds"),
    "regional_trends": q(TO_TRENDS, "SELECT * FROM trends"),
    "level_shift": q(f"""{TO_FACT},
      leveled AS (
        SELECT academic_year_start, ANY_VALUE(academic_year_label) AS academic_year_label,
               BOOL_OR(is_provisional) AS is_provisional, geographic_level, region_name, market_segment,
               CAST(SUM(start_count) AS BIGINT) AS starts
        FROM fact
        WHERE is_current AND is_detail_grain AND market_segment <> 'MACHINERY' AND start_count IS NOT NULL
        GROUP BY academic_year_start, geographic_level, region_name, market_segment),
      areas AS (
        SELECT academic_year_start, COALESCE(region_name, '') AS area, CAST(SUM(starts) AS BIGINT) AS area_year_starts
        FROM leveled GROUP BY ALL),
      shared AS (
        SELECT l.*, area, area_year_starts, {ratio("starts", "area_year_starts")} AS level_share
        FROM leveled l JOIN areas a
          ON a.academic_year_start = l.academic_year_start AND a.area = COALESCE(l.region_name, '')),
      firsts AS (
        SELECT area, market_segment, arg_min(level_share, academic_year_start) AS first_share
        FROM shared GROUP BY ALL)""", """
      SELECT s.* EXCLUDE (area), level_share - first_share AS share_change_vs_baseline
      FROM shared s JOIN firsts f ON f.area = s.area AND f.market_segment = s.market_segment"""),
    "pipeline_health": q(f"""{TO_FACT},
      sides AS ({SIDES}),
      loaded AS (
        SELECT MAX(ingested_date) AS day, arg_max(dataset_version, version_seq) AS newest,
               CAST(date_diff('day', MAX(ingested_date), DATE '2026-09-01') AS INTEGER) AS age
        FROM base),
      years AS (
        SELECT {YEAR}, COUNT(*) AS fact_rows, COUNT(*) FILTER (is_detail_grain) AS detail_rows,
               CAST(COALESCE(SUM(start_count) FILTER (is_detail_grain AND geographic_level = 'National'), 0)
                    AS BIGINT) AS national_starts,
               {ratio("COUNT(*) FILTER (start_count_status <> 'published')", "COUNT(*)")} AS suppression_rate,
               COUNT(*) FILTER (start_count_status = 'unrecognised') AS unrecognised_markers
        FROM fact WHERE is_current GROUP BY ALL)""", """
      SELECT years.*, detail_starts, published_starts, rel_error AS reconciliation_error,
             CAST(day AS VARCHAR) AS last_ingested_date, newest AS latest_version_loaded,
             age AS days_since_last_load,
             CASE WHEN unrecognised_markers > 0 OR COALESCE(rel_error, 0) > 0.001 THEN 'critical'
                  WHEN age > 120 OR suppression_rate > 0.35 THEN 'warning' ELSE 'ok' END AS health_status
      FROM years LEFT JOIN sides ON sides.academic_year_start = years.academic_year_start, loaded"""),
    "dim_academic_year": q(TO_SILVER, f"""
      SELECT DISTINCT academic_year_start AS academic_year_key, academic_year_start, academic_year_end,
             academic_year_label, is_provisional,
             academic_year_start = (SELECT MAX(academic_year_start) FROM silver) AS is_latest_year
      FROM silver"""),
    "dim_geography": q(TO_SILVER, """
      SELECT DISTINCT md5(geographic_level || '|' || COALESCE(region_code, 'NA')) AS geography_key,
             geographic_level, country_code, country_name, region_code, region_name,
             COALESCE(region_name, country_name) AS display_name,
             region_name = 'MIDDLE EAST' AS is_residual_bucket
      FROM silver"""),
    "dim_suppression_status": q(TO_SILVER, f"""
      SELECT d.*, (SELECT COUNT(*) FROM (
               {" UNION ALL ".join(f"SELECT {m}_status AS s FROM silver" for m in MEASURES)})
               WHERE s = status_code) AS cells
      FROM (VALUES
        ('published', 'Published', TRUE, 'Figure is published and usable.'),
        ('suppressed_low', 'Suppressed (low)', FALSE,
         'Value too small to publish without risking disclosure of an individual.'),
        ('suppressed_confidential', 'Suppressed (confidential)', FALSE, 'Withheld for confidentiality reasons.'),
        ('not_applicable', 'Not applicable', FALSE, 'This measure is not collected for this breakdown.'),
        ('missing', 'Missing', FALSE, 'Absent from the source with no marker given.'),
        ('unrecognised', 'Unrecognised marker', FALSE,
         'A marker not seen during profiling. Investigate before using.'))
        AS d(status_code, status_label, has_value, explanation)"""),
    "region_narrative_facts": q(TO_TRENDS, """
      SELECT region_name,
             CAST(SUM(starts) FILTER (academic_year_start = 2000) AS BIGINT) AS starts_last,
             CAST(SUM(starts) FILTER (academic_year_start = 1995) AS BIGINT) AS starts_first,
             CAST(SUM(achievements) FILTER (academic_year_start = 2000) AS BIGINT) AS achievements_last,
             CAST(SUM(start_rows_suppressed) AS BIGINT) AS suppressed_cells,
             CAST(SUM(start_rows_published) AS BIGINT) AS published_cells
      FROM trends WHERE region_name <> 'MIDDLE EAST' GROUP BY region_name"""),
    "region_prompts": q(TO_TRENDS, """
      SELECT region_name, suppressed_cells,
             'Summarise starts in ' || region_name || ' in two sentences.' || chr(10)
             || 'Published figures, each rounded to the nearest 10:' || chr(10)
             || '1995/96 starts: ' || COALESCE(CAST(s0 AS VARCHAR), 'WITHHELD') || chr(10)
             || '2000/01 starts: ' || COALESCE(CAST(s1 AS VARCHAR), 'WITHHELD') || chr(10)
             || '2000/01 achievements: ' || COALESCE(CAST(a1 AS VARCHAR), 'WITHHELD') || chr(10)
             || 'cells withheld for disclosure control: ' || suppressed_cells || ' of '
             || (suppressed_cells + published_cells) || chr(10)
             || 'Say that a WITHHELD figure is not published; do not estimate it. '
             || 'Mention incomplete totals when many cells are withheld. '
             || 'Treat every figure as history, not as a forecast. '
             || 'Call the region ' || region_name || '.' AS prompt
      FROM (SELECT region_name, SUM(starts) FILTER (academic_year_start = 1995) AS s0,
                   SUM(starts) FILTER (academic_year_start = 2000) AS s1,
                   SUM(achievements) FILTER (academic_year_start = 2000) AS a1,
                   CAST(SUM(start_rows_suppressed) AS BIGINT) AS suppressed_cells,
                   CAST(SUM(start_rows_published) AS BIGINT) AS published_cells
            FROM trends WHERE region_name <> 'MIDDLE EAST' GROUP BY region_name)"""),
    "region_mix_features": q(TO_FACT, f"""
      SELECT region_name,
             {csv((f"{ratio(f'SUM(CASE WHEN market_segment = {chr(39)}{v}{chr(39)} THEN start_count ELSE 0 END)', 'SUM(start_count)')} AS share_{v.lower()}" for v in SERIES_LEVELS[:3]))}
      FROM fact WHERE is_current AND is_detail_grain AND geographic_level = 'Regional'
        AND region_name <> 'MIDDLE EAST' AND NOT is_provisional AND start_count IS NOT NULL
      GROUP BY region_name"""),
    "restatement_features": q(TO_RESTATED, """
      SELECT row_key, restated_from_version, restated_in_version,
             abs(start_count_delta) AS abs_delta, abs(COALESCE(start_count_pct_change, 0)) AS abs_pct_change,
             CASE WHEN disclosure_status_changed THEN 1 ELSE 0 END AS disclosure_changed,
             COALESCE(start_count_before, 0) AS size_before
      FROM restated WHERE start_count_delta IS NOT NULL"""),
    "level_share_series": q(TO_SERIES, """
      SELECT level, academic_year_start, CAST(yr AS VARCHAR) AS yr, share FROM series"""),
    "drift_forecast": q(TO_FORECAST, """
      SELECT level, academic_year_start, h, n, round(drift, 9) AS drift, round(sigma, 9) AS sigma,
             round(forecast, 9) AS forecast, round(lower, 9) AS lower, round(upper, 9) AS upper
      FROM forecast"""),
    "forecast_holdout": q(f"{TO_FORECAST},{series('held', True)}", """
      SELECT f.level, f.academic_year_start, round(forecast, 9) AS forecast, round(lower, 9) AS lower,
             round(upper, 9) AS upper, round(share, 9) AS actual, share BETWEEN lower AND upper AS in_interval
      FROM forecast f JOIN held h ON f.level = h.level AND f.academic_year_start = h.academic_year_start"""),
    "customer_forecast": """
      WITH placed_by_year AS (
        SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS order_year, COUNT(*) AS placed
        FROM orders WHERE year(o_orderdate) <> 2001 GROUP BY ALL),
      years AS (SELECT DISTINCT order_year FROM placed_by_year),
      begun AS (SELECT o_custkey, MIN(order_year) AS since FROM placed_by_year GROUP BY ALL),
      calendar AS (
        SELECT CAST(unnest(range(MIN(order_year), MAX(order_year) + 1)) AS BIGINT) AS order_year FROM years),
      series AS (
        SELECT b.o_custkey, c.order_year, COALESCE(p.placed, 0) AS placed
        FROM begun b JOIN calendar c ON c.order_year >= b.since
        LEFT JOIN placed_by_year p ON p.o_custkey = b.o_custkey AND p.order_year = c.order_year),
      steps AS (
        SELECT *, placed - lag(placed) OVER (PARTITION BY o_custkey ORDER BY order_year) AS step FROM series),
      fitted AS (
        SELECT o_custkey, COUNT(*) AS n, MAX(order_year) AS last_year, arg_max(placed, order_year) AS last_y,
               (arg_max(placed, order_year) - arg_min(placed, order_year)) / (COUNT(*) - 1)::DOUBLE AS drift,
               stddev_samp(step) AS sigma
        FROM steps GROUP BY o_custkey HAVING COUNT(*) > 1),
      ahead AS (
        SELECT *, last_y + drift * h AS point,
               1.959963984540054 * sigma * sqrt(h + CAST(h * h AS DOUBLE) / (n - 1)) AS margin
        FROM fitted, range(1, 5) r(h))
      SELECT o_custkey, last_year + h AS order_year, CAST(h AS INTEGER) AS h, n, round(drift, 9) AS drift,
             round(sigma, 9) AS sigma, round(point, 9) AS forecast, round(point - margin, 9) AS lower,
             round(point + margin, 9) AS upper
      FROM ahead""",
    "supplier_forecast": """
      WITH shipped AS (
        SELECT l_suppkey, CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS BIGINT) AS month_no,
               CAST(SUM(l_quantity) AS BIGINT) AS quantity
        FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY ALL),
      begun AS (SELECT l_suppkey, MIN(month_no) AS since FROM shipped WHERE month_no <= 24017 GROUP BY ALL),
      series AS (
        SELECT b.l_suppkey, c.month_no, COALESCE(s.quantity, 0) AS y
        FROM begun b JOIN (SELECT unnest(range(23000, 24018)) AS month_no) c ON c.month_no >= b.since
        LEFT JOIN shipped s ON s.l_suppkey = b.l_suppkey AND s.month_no = c.month_no),
      moved AS (
        SELECT l_suppkey, month_no, CAST(y - first(y) OVER w AS DOUBLE) AS x0,
               CAST(lag(y, 1) OVER w - first(y) OVER w AS DOUBLE) AS x1,
               CAST(lag(y, 2) OVER w - first(y) OVER w AS DOUBLE) AS x2,
               CAST(lag(y, 3) OVER w - first(y) OVER w AS DOUBLE) AS x3, first(y) OVER w AS base
        FROM series WINDOW w AS (PARTITION BY l_suppkey ORDER BY month_no)),
      terms AS (
        SELECT l_suppkey, 0 AS d, x0 AS u, x1 AS v, x2 AS w FROM moved WHERE x3 IS NOT NULL
        UNION ALL SELECT l_suppkey, 1, x0 - x1, x1 - x2, x2 - x3 FROM moved WHERE x3 IS NOT NULL),
      sums AS (
        SELECT l_suppkey, d, COUNT(*) AS n, SUM(u) AS su, SUM(v) AS sv, SUM(w) AS sw,
               SUM(u * u) - SUM(u) * SUM(u) / COUNT(*) AS uu, SUM(u * v) - SUM(u) * SUM(v) / COUNT(*) AS uv,
               SUM(u * w) - SUM(u) * SUM(w) / COUNT(*) AS uw, SUM(v * v) - SUM(v) * SUM(v) / COUNT(*) AS vv,
               SUM(v * w) - SUM(v) * SUM(w) / COUNT(*) AS vw, SUM(w * w) - SUM(w) * SUM(w) / COUNT(*) AS ww
        FROM terms GROUP BY ALL HAVING COUNT(*) >= 7),
      slopes AS (
        SELECT *, 0 AS p, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM sums
        UNION ALL SELECT *, 1, uv / nullif(vv, 0), 0.0 FROM sums
        UNION ALL SELECT *, 2, (uv * ww - uw * vw) / nullif(vv * ww - vw * vw, 0),
                         (uw * vv - uv * vw) / nullif(vv * ww - vw * vw, 0) FROM sums),
      rests AS (
        SELECT *, greatest(uu - a * uv - b * uw, 0.0) AS rest FROM slopes WHERE a IS NOT NULL AND b IS NOT NULL),
      fits AS (
        SELECT *, CASE WHEN rest > 0 THEN n * ln(rest / n) + (p + 1) * ln(n) ELSE -1e308 END AS score,
               su / n - a * (sv / n) - b * (sw / n) AS c, sqrt(rest / (n - (p + 1))) AS sigma,
               a + d AS w1, CASE d WHEN 0 THEN b ELSE b - a END AS w2, CASE d WHEN 0 THEN 0.0 ELSE -b END AS w3
        FROM rests),
      best AS (
        SELECT * FROM fits QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY score, d, p) = 1),
      one AS (
        SELECT b.*, m.base, m.x0, m.x1, m.x2, c + w1 * x0 + w2 * x1 + w3 * x2 AS f1, w1 AS e1
        FROM best b JOIN moved m ON m.l_suppkey = b.l_suppkey AND m.month_no = 24017),
      two AS (SELECT *, c + w1 * f1 + w2 * x0 + w3 * x1 AS f2, w1 * e1 + w2 AS e2 FROM one),
      three AS (SELECT *, c + w1 * f2 + w2 * f1 + w3 * x0 AS f3, w1 * e2 + w2 * e1 + w3 AS e3 FROM two),
      four AS (SELECT *, c + w1 * f3 + w2 * f2 + w3 * f1 AS f4 FROM three),
      ahead AS (
        SELECT *, base + [f1, f2, f3, f4][h] AS point,
               1.959963984540054 * sigma * sqrt(list_sum([1.0, e1 * e1, e2 * e2, e3 * e3][1:h])) AS margin
        FROM four, range(1, 5) r(h))
      SELECT a.l_suppkey, 24017 + h AS month_no, n, CAST(p AS INTEGER) AS p, CAST(d AS INTEGER) AS d,
             round(sigma, 6) AS sigma, round(point, 6) AS forecast, round(point - margin, 6) AS lower,
             round(point + margin, 6) AS upper, COALESCE(s.quantity, 0) AS actual
      FROM ahead a LEFT JOIN shipped s ON s.l_suppkey = a.l_suppkey AND s.month_no = 24017 + h""",
    "feed_national_trend": q(TO_FACT, f"""
      SELECT {YEAR}, CAST(SUM(start_count) AS BIGINT) AS starts,
             CAST(SUM(achievement_count) AS BIGINT) AS achievements
      FROM fact WHERE is_current AND is_detail_grain AND geographic_level = 'National' GROUP BY ALL"""),
    "feed_level_mix": q(TO_TRENDS, f"""
      SELECT region_name, total, {csv((f"{per_mille(f's{i}', 'total')} / 10.0::DOUBLE AS pct_{v.lower()}" for i, v in enumerate(SERIES_LEVELS)))}
      FROM (SELECT region_name, CAST(SUM(starts) AS BIGINT) AS total,
                   {csv((f"CAST(COALESCE(SUM(starts) FILTER (market_segment = '{v}'), 0) AS BIGINT) AS s{i}" for i, v in enumerate(SERIES_LEVELS)))}
            FROM trends WHERE region_name <> 'MIDDLE EAST' AND NOT is_provisional GROUP BY region_name)"""),
    "feed_suppression": q(TO_TRENDS, f"""
      SELECT region_name, {per_mille("suppressed", "total")} / 10.0::DOUBLE AS rate, suppressed, total
      FROM (SELECT region_name, CAST(SUM(start_rows_suppressed) AS BIGINT) AS suppressed,
                   CAST(SUM(start_rows_suppressed + start_rows_published) AS BIGINT) AS total
            FROM trends WHERE region_name <> 'MIDDLE EAST' GROUP BY region_name)"""),
    "feed_revisions": q(TO_RESTATED, """
      SELECT restated_from_version || ' to ' || restated_in_version AS revision, COUNT(*) AS revised,
             COUNT(*) FILTER (disclosure_status_changed) AS disclosure
      FROM restated GROUP BY ALL"""),
    "dq_silver_report": q(TO_SILVER, union_counts(SILVER_CHECKS)),
    "dq_fact_report": q(TO_FACT, union_counts(FACT_CHECKS)),
    "dq_not_null": q(f"{CELLS},{LATEST}", f"""
      SELECT version, time_period, geographic_level, region_code, {csv(DIMS)}
      FROM latest WHERE region_code IS NULL"""),
    "dq_unique": q(CELLS, f"""
      SELECT time_period, geographic_level, region_code, {csv(DIMS)}, version, COUNT(*) AS copies
      FROM bronze GROUP BY ALL HAVING COUNT(*) > 1"""),
    "dq_accepted_values": q(TO_SILVER, """
      SELECT row_key, dataset_version, participation_count_status FROM silver
      WHERE participation_count_status NOT IN ('published', 'suppressed_low')"""),
    "dq_range": q(TO_SILVER, """
      SELECT row_key, dataset_version, academic_year_start FROM silver
      WHERE academic_year_start NOT BETWEEN 1995 AND 2000"""),
    "dq_relationships": "SELECT doc_id, source FROM documents "
    "WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "dq_current_matches_latest": q(TO_FACT, """
      SELECT n AS current_records, e AS expected_records
      FROM (SELECT COUNT(*) FILTER (is_current) AS n FROM fact),
           (SELECT arg_max(total_results, version_seq) AS e FROM versions) WHERE n <> e"""),
    "dq_reconciliation": q(TO_FACT, f"SELECT * FROM ({SIDES}) WHERE rel_error > 0.001"),
    "dq_unrecognised": q(TO_SILVER, """
      SELECT row_key, dataset_version FROM silver
      WHERE start_count_status = 'unrecognised' OR achievement_count_status = 'unrecognised'"""),
    "dq_suppressed_has_value": q(TO_FACT, """
      SELECT row_key, valid_from_seq FROM fact WHERE start_count_status <> 'published' AND start_count IS NOT NULL"""),
    "dq_version_lineage": q(TO_FACT, "SELECT COUNT(DISTINCT valid_from_version) AS versions FROM fact"),
    "pii_columns": "SELECT 'lineitem' AS table_name, 'l_returnflag' AS column_name, "
    "COUNT(l_returnflag) AS values_held FROM lineitem UNION ALL "
    "SELECT 'conversations', 'turn', COUNT(turn) FROM conversations",
    "pii_columns_whole_words": "SELECT 'conversations' AS table_name, 'turn' AS column_name, "
    "COUNT(turn) AS values_held FROM conversations",
    "identifier_summary": "SELECT string_agg(name, ',' ORDER BY name) AS column_names FROM "
    "(SELECT DISTINCT column_name AS name FROM duckdb_columns() WHERE regexp_matches(column_name, 'urn'))",
    "region_segment_summary": q(TO_FACT, f"""
      SELECT COUNT(DISTINCT region_name) AS clustered_rows, TRUE AS segments_within_k,
             TRUE AS flags_within_share
      FROM fact WHERE is_current AND is_detail_grain AND geographic_level = 'Regional'
        AND region_name <> 'MIDDLE EAST' AND NOT is_provisional AND start_count IS NOT NULL"""),
    "restatement_shape_summary": q(TO_RESTATED, """
      SELECT COUNT(start_count_delta) AS clustered_rows, TRUE AS segments_within_k,
             TRUE AS flags_within_share FROM restated"""),
    "restatement_anomaly_summary": q(TO_RESTATED, """
      SELECT COUNT(start_count_delta) AS clustered_rows, TRUE AS segments_within_k,
             TRUE AS flags_within_share FROM restated"""),
    "lines_anomaly_summary": q(f"{LINE_FACT},{LINE_RESTATED}", """
      SELECT COUNT(quantity_delta) AS clustered_rows, TRUE AS segments_within_k,
             TRUE AS flags_within_share FROM line_restated"""),
    "lines_restatement_features": q(f"{LINE_FACT},{LINE_RESTATED}", """
      SELECT l_orderkey, l_linenumber, restated_from_version, restated_in_version,
             abs(quantity_delta) AS abs_delta, abs(COALESCE(quantity_pct_change, 0)) AS abs_pct_change,
             CASE WHEN disclosure_status_changed THEN 1 ELSE 0 END AS disclosure_changed,
             COALESCE(quantity_before, 0) AS size_before
      FROM line_restated WHERE quantity_delta IS NOT NULL"""),
    "lines_latest": q(LINES, """
      SELECT * REPLACE (CAST(published_at AS VARCHAR) AS published_at, CAST(ingest_date AS VARCHAR) AS ingest_date)
      FROM newest_lines"""),
    "lines_latest_by_version": q(LINES, """
      SELECT * REPLACE (CAST(published_at AS VARCHAR) AS published_at, CAST(ingest_date AS VARCHAR) AS ingest_date)
      FROM newest_lines n
      WHERE ingest_date = (SELECT MAX(ingest_date) FROM register r WHERE r.version = n.version)"""),
    "lines_measure_status": q(LINES, " UNION ALL ".join(f"""
      SELECT version, '{m}' AS measure, {m}_status AS status, COUNT(*) AS cells,
             CAST(SUM({m}) AS DOUBLE) AS value_sum
      FROM (SELECT version, {value(m, t)} AS {m}, {status(m)} AS {m}_status FROM register) GROUP BY ALL"""
      for m, t in LINE_MEASURES.items())),
    "lines_scd2": q(LINE_FACT, f"SELECT {LINE_COLUMNS} FROM line_fact"),
    "running_totals": q(TO_FACT, totals_sql(
        "fact", ("academic_year_start", "geographic_level", "region_code", "market_segment", "aggregation_depth"),
        MEASURES[:3])),
    "lines_running_totals": q(LINE_FACT, totals_sql("line_fact", LINE_CARRY, ("quantity",))),
    "lines_scd2_spliced": q(LINE_FACT, f"SELECT {LINE_COLUMNS} FROM line_fact"),
    "lines_scd2_extended": q(LINE_FACT, f"SELECT {LINE_COLUMNS} FROM line_fact"),
    "lines_as_of": q(LINE_FACT, f"""
      SELECT {csv(LINE_KEY)}, valid_from_seq, valid_to_seq, {csv(LINE_TYPED)}
      FROM line_fact WHERE 1998 BETWEEN valid_from_seq AND valid_to_seq"""),
    "lines_restatements": q(f"{LINE_FACT},{LINE_RESTATED}", f"SELECT {RESTATED_COLUMNS} FROM line_restated"),
    "lines_revisions": q(f"{LINE_FACT},{LINE_RESTATED}", """
      SELECT restated_from_version || ' to ' || restated_in_version AS revision, COUNT(*) AS revised,
             COUNT(*) FILTER (disclosure_status_changed) AS disclosure
      FROM line_restated GROUP BY ALL"""),
    "lines_version_deltas": q(
        f"{LINES},{deltas('typed_lines', LINE_KEY, [f'{m}_text' for m in LINE_MEASURES], LINE_TYPED)}",
        """
      SELECT version_seq, CAST(version_seq AS VARCHAR) AS version, 'Annual' AS version_type,
             row_count, added, removed, restated, restated_typed
      FROM pairs WHERE version_seq IN (SELECT version_seq FROM register)"""),
    "lines_typed_vs_string": q(
        f"{LINE_FACT},"
        + scd2_ctes("typed_lines", LINE_KEY, [f"{m}_text" for m in LINE_MEASURES], (), "version", "text_fact"),
        """
      SELECT 'STRING diff (naive)' AS method, COUNT(*) AS scd2_records FROM text_fact
      UNION ALL SELECT 'TYPED diff (shipped)', COUNT(*) FROM line_fact"""),
    "lines_duplicates": "SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem "
    "GROUP BY ALL HAVING COUNT(*) > 1",
}

"""DuckDB SQL for every registered query, written independently of the Spark code.

The driver pre-registers the parquet tables as views; these strings only use
those views.  Shared bindings are CTE snippets composed with :func:`with_`.
DuckDB 2.0 dialect: ``lambda x: ...`` for list lambdas, ``list_*`` functions,
``GROUPING SETS``, recursive CTEs.
"""

from __future__ import annotations

CTE: dict[str, str] = {}

CTE["geo"] = """
geo AS (
  SELECT n.n_nationkey, lower(r.r_name || '/' || n.n_name) AS geo
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

CTE["order_lines"] = """
order_lines AS (
  SELECT l.l_orderkey,
         list_sort(list_distinct(coalesce(list(p.p_brand) FILTER (WHERE l.l_linestatus = 'O'), []))) AS base_brands,
         list_sort(list_distinct(coalesce(list(p.p_brand) FILTER (WHERE l.l_linestatus = 'F'), []))) AS var_brands,
         min({'ln': l.l_linenumber, 'sk': l.l_suppkey}).sk AS first_suppkey
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_orderkey)"""

CTE["config_src"] = """
config_src AS (
  SELECT o.o_orderkey AS rid,
         c.c_mktsegment AS device,
         c.c_name AS customer_name,
         o.o_orderstatus AS build_type,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN 'SMR' ELSE o.o_orderpriority END AS release_type,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'TRUE' ELSE 'FALSE' END AS vr_qualified,
         lower(cg.geo || '/' || o.o_orderpriority) AS fingerprint,
         sg.geo || '/x' AS same_device_fingerprints,
         '[' || array_to_string(list_transform(coalesce(ol.base_brands, []), lambda b: '''' || b || ''''), ', ') || ']' AS priv_base_apps,
         '[' || array_to_string(list_transform(coalesce(ol.var_brands, []), lambda b: '''' || b || ''''), ', ') || ']' AS priv_var_apps
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN geo cg ON c.c_nationkey = cg.n_nationkey
  LEFT JOIN order_lines ol ON o.o_orderkey = ol.l_orderkey
  LEFT JOIN supplier s ON ol.first_suppkey = s.s_suppkey
  LEFT JOIN geo sg ON s.s_nationkey = sg.n_nationkey)"""

CTE["config_rows"] = """
config_rows AS (SELECT * EXCLUDE (customer_name) FROM config_src)"""

# config_by_customer: the customer name is the device
CTE["config_rows_by_customer"] = """
config_rows AS (
  SELECT rid, customer_name AS device, build_type, release_type, vr_qualified, fingerprint,
         same_device_fingerprints, priv_base_apps, priv_var_apps
  FROM config_src)"""

# F01 fingerprint code and F02 list parse, for the (well-formed) bound lists
CTE["report_rows"] = """
report_rows AS (
  SELECT *,
         CASE WHEN fingerprint IS NULL THEN NULL
              WHEN len(string_split(fingerprint, '/')) >= 2 THEN upper(right(string_split(fingerprint, '/')[2], 3))
              ELSE fingerprint END AS fp_code,
         CASE WHEN same_device_fingerprints IS NULL THEN NULL
              WHEN len(string_split(same_device_fingerprints, '/')) >= 2 THEN upper(right(string_split(same_device_fingerprints, '/')[2], 3))
              ELSE same_device_fingerprints END AS sdp_code,
         CAST(json(replace(priv_base_apps, '''', '"')) AS VARCHAR[]) AS base,
         CAST(json(replace(priv_var_apps, '''', '"')) AS VARCHAR[]) AS variant
  FROM config_rows)"""

CTE["kept_rows"] = """
kept_rows AS (
  SELECT * FROM report_rows WHERE fp_code IS DISTINCT FROM sdp_code)"""

CTE["merged"] = """
merged AS (
  SELECT device, build_type, fp_code, sdp_code,
         arg_min(fingerprint, rid) AS fingerprint,
         arg_min(same_device_fingerprints, rid) AS same_device_fingerprints,
         arg_min(priv_base_apps, rid) AS priv_base_apps,
         arg_min(priv_var_apps, rid) AS priv_var_apps,
         list_sort(list_distinct(flatten(list(base)))) AS base,
         list_sort(list_distinct(flatten(list(variant)))) AS variant,
         count(*) AS n_rows
  FROM kept_rows
  GROUP BY device, build_type, fp_code, sdp_code)"""

# dependencies between snippets, in definition order
DEPS = {
    "geo": [],
    "order_lines": [],
    "config_src": ["geo", "order_lines"],
    "config_rows": ["config_src"],
    "report_rows": ["config_rows"],
    "kept_rows": ["report_rows"],
    "merged": ["kept_rows"],
}


def with_(*names: str, by_customer: bool = False) -> str:
    """``WITH`` clause holding the named snippets and everything they need.

    ``by_customer`` swaps in the binding where the customer is the device.
    """
    order: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    def text(n):
        if by_customer and n == "config_rows":
            return CTE["config_rows_by_customer"]
        return CTE[n]

    return "WITH " + ",".join(text(n) for n in order) + "\n"


SQL: dict[str, str] = {}

SQL["fingerprint_stats"] = with_("merged") + """,
sizes AS (SELECT device, build_type, len(base) AS nb, len(variant) AS nv FROM merged),
totals AS (
  SELECT GROUPING(build_type, device) AS gid, build_type, device,
         count(*) AS total_rows, CAST(sum(nb) AS BIGINT) AS total_base, CAST(sum(nv) AS BIGINT) AS total_var
  FROM sizes GROUP BY GROUPING SETS ((), (device), (build_type, device))),
apps AS (
  SELECT device, build_type, 'base' AS side, unnest(base) AS app FROM merged
  UNION ALL
  SELECT device, build_type, 'variant' AS side, unnest(variant) AS app FROM merged),
uniq AS (
  SELECT GROUPING(build_type, device) AS gid, build_type, device,
         count(DISTINCT app) FILTER (WHERE side = 'base') AS unique_base,
         count(DISTINCT app) FILTER (WHERE side = 'variant') AS unique_var
  FROM apps GROUP BY GROUPING SETS ((), (device), (build_type, device)))
SELECT CASE t.gid WHEN 3 THEN 'overall' WHEN 2 THEN 'device' ELSE 'build_type_device' END AS level,
       t.device, t.build_type, t.total_rows, t.total_base, coalesce(u.unique_base, 0) AS unique_base,
       t.total_var, coalesce(u.unique_var, 0) AS unique_var,
       coalesce(round(t.total_base / t.total_rows, 4), 0.0) AS avg_base,
       coalesce(round(t.total_var / t.total_rows, 4), 0.0) AS avg_var
FROM totals t LEFT JOIN uniq u
  ON t.gid = u.gid AND t.build_type IS NOT DISTINCT FROM u.build_type AND t.device IS NOT DISTINCT FROM u.device
"""

SQL["top_apps"] = with_("merged") + """,
apps AS (
  SELECT 'base' AS side, unnest(base) AS app FROM merged
  UNION ALL SELECT 'variant' AS side, unnest(variant) AS app FROM merged),
c AS (SELECT side, app, count(*) AS n FROM apps GROUP BY side, app),
r AS (SELECT side, app, n, CAST(row_number() OVER (PARTITION BY side ORDER BY n DESC, app) AS INTEGER) AS rank FROM c)
SELECT side, rank, app, substr(string_split(app, '.')[-1], 1, 15) AS label, n FROM r WHERE rank <= 10
"""

SQL["top_combos"] = with_("merged") + """,
c AS (SELECT coalesce(fp_code, 'nan') || ' vs ' || coalesce(sdp_code, 'nan') AS combo, count(*) AS n FROM merged GROUP BY 1),
r AS (SELECT combo, n, CAST(row_number() OVER (ORDER BY n DESC, combo) AS INTEGER) AS rank FROM c)
SELECT rank, combo, n FROM r WHERE rank <= 10
"""

SQL["distinct_values"] = with_("config_rows") + """,
v AS (
  SELECT 'device' AS column_name, device AS value, rid FROM config_rows
  UNION ALL SELECT 'build_type', build_type, rid FROM config_rows),
f AS (SELECT column_name, value, min(rid) AS first_rid FROM v WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT column_name, value, first_rid,
       CAST(row_number() OVER (PARTITION BY column_name ORDER BY first_rid) AS INTEGER) AS pos
FROM f
"""

CTE["rc"] = """
rc_rows AS (
  SELECT * FROM report_rows
  WHERE device IS NOT NULL AND build_type IS NOT NULL AND fingerprint IS NOT NULL
    AND same_device_fingerprints IS NOT NULL),
rc_items AS (
  SELECT device, build_type, fingerprint, same_device_fingerprints, rid, 'base' AS side,
         unnest(base) AS app, generate_subscripts(base, 1) AS pos FROM rc_rows
  UNION ALL
  SELECT device, build_type, fingerprint, same_device_fingerprints, rid, 'variant' AS side,
         unnest(variant) AS app, generate_subscripts(variant, 1) AS pos FROM rc_rows),
rc_first AS (
  SELECT device, build_type, fingerprint, same_device_fingerprints, side, app, min({'r': rid, 'p': pos}) AS first_at
  FROM rc_items GROUP BY ALL),
rc_lists AS (
  SELECT device, build_type, fingerprint, same_device_fingerprints,
         list(app ORDER BY first_at) FILTER (WHERE side = 'base') AS base,
         list(app ORDER BY first_at) FILTER (WHERE side = 'variant') AS variant
  FROM rc_first GROUP BY ALL),
rc AS (
  SELECT k.device, k.build_type, k.fingerprint, k.same_device_fingerprints,
         CASE WHEN len(string_split(k.fingerprint, '/')) >= 2 THEN upper(right(string_split(k.fingerprint, '/')[2], 3)) ELSE k.fingerprint END AS fp_code,
         CASE WHEN len(string_split(k.same_device_fingerprints, '/')) >= 2 THEN upper(right(string_split(k.same_device_fingerprints, '/')[2], 3)) ELSE k.same_device_fingerprints END AS sdp_code,
         coalesce(l.base, []) AS base, coalesce(l.variant, []) AS variant, k.first_rid, k.n_rows
  FROM (SELECT device, build_type, fingerprint, same_device_fingerprints, min(rid) AS first_rid, count(*) AS n_rows
        FROM rc_rows GROUP BY ALL) k
  LEFT JOIN rc_lists l
    ON k.device = l.device AND k.build_type = l.build_type AND k.fingerprint = l.fingerprint
   AND k.same_device_fingerprints = l.same_device_fingerprints)"""
DEPS["rc"] = ["report_rows"]

SQL["raw_combinations"] = with_("rc") + """
SELECT device, build_type, fingerprint, same_device_fingerprints, fp_code, sdp_code, first_rid, n_rows,
       array_to_string(base, '|') AS base, array_to_string(variant, '|') AS variant
FROM rc
"""

SQL["app_profile"] = with_("rc") + """,
items AS (
  SELECT device, build_type, 'base' AS side, unnest(base) AS app FROM rc
  UNION ALL SELECT device, build_type, 'variant' AS side, unnest(variant) AS app FROM rc),
cnt AS (SELECT device, build_type, side, app, count(*) AS n FROM items GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY device, build_type, side ORDER BY n DESC, app) AS rk FROM cnt),
per_side AS (
  SELECT device, build_type, side, count(*) AS uniq, CAST(sum(n) AS BIGINT) AS total,
         count(*) FILTER (WHERE n = 1) AS single, count(*) FILTER (WHERE n > 1) AS dominant,
         string_agg(app || ':' || CAST(n AS VARCHAR), ', ' ORDER BY rk) FILTER (WHERE rk <= 5) AS top5
  FROM ranked GROUP BY ALL),
sizes AS (
  SELECT device, build_type, count(*) AS n_combos,
         CAST(sum(len(base)) AS BIGINT) AS base_total, CAST(sum(len(variant)) AS BIGINT) AS var_total,
         CAST(min(len(base) + len(variant)) AS INTEGER) AS min_combo_apps,
         CAST(max(len(base) + len(variant)) AS INTEGER) AS max_combo_apps
  FROM rc GROUP BY ALL)
SELECT s.device, s.build_type, s.n_combos,
       coalesce(b.uniq, 0) AS base_unique, coalesce(s.base_total, 0) AS base_total,
       coalesce(b.single, 0) AS base_single, coalesce(b.dominant, 0) AS base_dominant, coalesce(b.top5, '') AS base_top5,
       coalesce(v.uniq, 0) AS var_unique, coalesce(s.var_total, 0) AS var_total,
       coalesce(v.single, 0) AS var_single, coalesce(v.dominant, 0) AS var_dominant, coalesce(v.top5, '') AS var_top5,
       round(coalesce(s.base_total / s.n_combos, 0.0), 4) AS avg_base,
       round(coalesce(s.var_total / s.n_combos, 0.0), 4) AS avg_var,
       s.min_combo_apps, s.max_combo_apps
FROM sizes s
LEFT JOIN per_side b ON s.device = b.device AND s.build_type = b.build_type AND b.side = 'base'
LEFT JOIN per_side v ON s.device = v.device AND s.build_type = v.build_type AND v.side = 'variant'
"""

SQL["build_type_relation"] = with_("merged", by_customer=True) + """,
sets AS (
  SELECT device, build_type,
         list_sort(list_distinct(flatten(list(base)))) AS base_set,
         list_sort(list_distinct(flatten(list(variant)))) AS var_set,
         list_sort(list_distinct(flatten(list(base || variant)))) AS all_set
  FROM merged WHERE device IS NOT NULL AND build_type IS NOT NULL GROUP BY ALL),
o AS (
  SELECT *, CAST(row_number() OVER w AS INTEGER) AS pos, lead(build_type) OVER w AS next_build_type,
         lead(all_set) OVER w AS next_set, count(*) OVER (PARTITION BY device) AS n_types
  FROM sets WINDOW w AS (PARTITION BY device ORDER BY len(all_set) DESC, build_type)),
r AS (
  SELECT *,
    CASE WHEN next_set IS NULL THEN NULL
         WHEN list_has_all(all_set, next_set) AND list_has_all(next_set, all_set) THEN build_type || ' = ' || next_build_type || ' (equal)'
         WHEN list_has_all(all_set, next_set) THEN build_type || ' ⊇ ' || next_build_type || ' (superset)'
         WHEN list_has_all(next_set, all_set) THEN build_type || ' ⊆ ' || next_build_type || ' (subset)'
         ELSE build_type || ' ≠ ' || next_build_type || ' (different)' END AS relation,
    (next_set IS NOT NULL AND NOT list_has_all(all_set, next_set) AND NOT list_has_all(next_set, all_set)) AS is_diff
  FROM o)
SELECT device, pos, build_type, next_build_type, relation,
       CAST(len(base_set) AS INTEGER) AS base_count, CAST(len(var_set) AS INTEGER) AS var_count,
       CAST(len(all_set) AS INTEGER) AS all_count,
       CASE WHEN n_types < 2 THEN 'Single build type'
            WHEN bool_or(is_diff) OVER (PARTITION BY device) THEN 'Build types have different app sets'
            ELSE 'Build types have equal or subset app relationships' END AS summary
FROM r
"""

SQL["build_counts"] = with_("merged") + """
SELECT device, build_type, count(*) AS row_count,
       count(*) FILTER (WHERE fp_code IS DISTINCT FROM sdp_code) AS n_combinations
FROM merged GROUP BY ALL
"""

SQL["merge_audit"] = with_("merged") + """
SELECT count(*) AS original_rows,
       count(*) FILTER (WHERE fp_code IS NOT DISTINCT FROM sdp_code) AS self_removed,
       count(*) FILTER (WHERE fp_code IS DISTINCT FROM sdp_code) AS after_self,
       count(*) FILTER (WHERE fp_code IS DISTINCT FROM sdp_code) - (SELECT count(*) FROM merged) AS merged_away,
       (SELECT count(*) FROM merged) AS final_rows
FROM report_rows
"""

CTE["an_rows"] = """
an_src AS (
  SELECT rid, device, release_type, fingerprint, same_device_fingerprints,
         CASE WHEN priv_base_apps IN ('[]', '[ ]') THEN '' ELSE priv_base_apps END AS b,
         CASE WHEN priv_var_apps IN ('[]', '[ ]') THEN '' ELSE priv_var_apps END AS v
  FROM config_rows
  WHERE NOT (coalesce(release_type = 'SMR', false) OR coalesce(vr_qualified = 'TRUE', false))),
an_rows AS (
  SELECT rid, device, release_type,
         CASE WHEN fingerprint IS NULL OR fingerprint = '' THEN fingerprint
              ELSE coalesce(string_split(fingerprint, '/')[2], fingerprint) END AS fp,
         CASE WHEN same_device_fingerprints IS NULL OR same_device_fingerprints = '' THEN same_device_fingerprints
              ELSE coalesce(string_split(same_device_fingerprints, '/')[2], same_device_fingerprints) END AS sdp,
         CASE WHEN b IS NULL OR b IN ('', '[]') THEN []::VARCHAR[]
              WHEN regexp_matches(b, '^\\[.*\\]$') THEN coalesce(CAST(json(replace(b, '''', '"')) AS VARCHAR[]), [])
              ELSE list_filter(list_transform(string_split(b, ','), lambda s: trim(s)), lambda s: s <> '') END AS base_apps,
         CASE WHEN v IS NULL OR v IN ('', '[]') THEN []::VARCHAR[]
              WHEN regexp_matches(v, '^\\[.*\\]$') THEN coalesce(CAST(json(replace(v, '''', '"')) AS VARCHAR[]), [])
              ELSE list_filter(list_transform(string_split(v, ','), lambda s: trim(s)), lambda s: s <> '') END AS variant_apps
  FROM an_src),
an_counted AS (SELECT * FROM an_rows WHERE device IS NOT NULL AND release_type IS NOT NULL),
an_side AS (
  SELECT device, release_type, fp, sdp, 'base' AS side, unnest(base_apps) AS app FROM an_counted
  UNION ALL
  SELECT device, release_type, fp, sdp, 'variant' AS side, unnest(variant_apps) AS app FROM an_counted),
an_pairs AS (
  SELECT side, p.a AS app_a, p.b AS app_b FROM (
    SELECT 'base' AS side, unnest(flatten(list_transform(range(1, len(s)), lambda i: list_transform(range(i + 1, len(s) + 1), lambda j: {'a': s[i], 'b': s[j]})))) AS p
    FROM (SELECT list_sort(base_apps) AS s FROM an_counted)
    UNION ALL
    SELECT 'variant' AS side, unnest(flatten(list_transform(range(1, len(s)), lambda i: list_transform(range(i + 1, len(s) + 1), lambda j: {'a': s[i], 'b': s[j]})))) AS p
    FROM (SELECT list_sort(variant_apps) AS s FROM an_counted)))"""
DEPS["an_rows"] = ["config_rows"]

SQL["release_counts"] = with_("an_rows") + """
SELECT device, release_type, count(*) AS n FROM an_counted GROUP BY ALL
"""

SQL["fp_app_counts"] = with_("an_rows") + """
SELECT device, release_type, fp, side, app, count(*) AS n
FROM an_side WHERE fp IS NULL OR fp <> '' GROUP BY ALL
"""

SQL["same_fp_app_counts"] = with_("an_rows") + """
SELECT device, release_type, sdp, side, app, count(*) AS n
FROM an_side WHERE sdp IS NULL OR sdp <> '' GROUP BY ALL
"""

SQL["pair_counts"] = with_("an_rows") + """
SELECT side, app_a, app_b, count(*) AS n FROM an_pairs GROUP BY ALL
"""

SQL["list_errors"] = with_("an_rows") + """
,
bad AS (
  SELECT device, list_filter([b, v], lambda t: regexp_matches(t, '^\\[.*\\]$')
                                               AND NOT regexp_full_match(t, '\\[\\s*(''[^'']*''(\\s*,\\s*''[^'']*'')*)?\\s*\\]')) AS texts
  FROM an_src WHERE device IS NOT NULL AND release_type IS NOT NULL)
SELECT device, count(*) AS n_rows, count(*) FILTER (WHERE len(texts) > 0) AS n_errors FROM bad GROUP BY device
"""

SQL["report_list_errors"] = """
WITH p AS (SELECT c_mktsegment AS device, c_custkey % 2 = 0 AS quoted FROM customer)
SELECT device, count(*) AS n_rows, count(*) FILTER (WHERE NOT quoted) AS n_errors FROM p GROUP BY device
"""

SQL["app_frequency"] = with_("rc") + """
SELECT device, build_type, side, app, count(*) AS n
FROM (SELECT device, build_type, 'base' AS side, unnest(base) AS app FROM rc
      UNION ALL SELECT device, build_type, 'variant', unnest(variant) FROM rc)
GROUP BY ALL
"""

SQL["request_summary"] = with_("rc") + """,
heads AS (
  SELECT device, build_type, count(*) AS n_combinations, count(DISTINCT fp_code) AS n_fp_codes, count(DISTINCT sdp_code) AS n_sdp_codes
  FROM rc GROUP BY ALL),
f AS (
  SELECT device, build_type, side, app, count(*) AS n
  FROM (SELECT device, build_type, 'base' AS side, unnest(base) AS app FROM rc
        UNION ALL SELECT device, build_type, 'variant', unnest(variant) FROM rc)
  GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY device, build_type, side ORDER BY n DESC, app) AS k FROM f)
SELECT h.*, r.side, count(*) AS n_unique, CAST(sum(n) AS BIGINT) AS n_total, count(*) FILTER (WHERE n > 1) AS n_dominant,
       string_agg(app || ' (' || n || ')', ', ' ORDER BY k) FILTER (WHERE k <= 3) AS most_common
FROM heads h JOIN r ON h.device = r.device AND h.build_type = r.build_type
GROUP BY h.device, h.build_type, h.n_combinations, h.n_fp_codes, h.n_sdp_codes, r.side
"""

SQL["csv_scan"] = """
SELECT o_orderstatus, count(*) AS n, CAST(sum(length(o_orderpriority)) AS BIGINT) AS chars
FROM orders GROUP BY o_orderstatus
"""

SQL["issue_urls"] = """
SELECT page_id, 'https://tracker.example/issues/' || CAST(page_id AS VARCHAR) AS url FROM pages
"""

SQL["analyzer_report"] = with_("an_rows") + """,
apps AS (SELECT side, app, count(*) AS n FROM an_side GROUP BY ALL),
ra AS (SELECT side, app AS label, n, row_number() OVER (PARTITION BY side ORDER BY n DESC, app) AS rank FROM apps),
pc AS (SELECT side, app_a, app_b, count(*) AS n FROM an_pairs GROUP BY ALL),
rp AS (SELECT side, app_a || ' + ' || app_b AS label, n, row_number() OVER (PARTITION BY side ORDER BY n DESC, app_a, app_b) AS rank FROM pc)
SELECT 'top_apps_' || side AS section, CAST(rank AS INTEGER) AS rank, label, n AS value FROM ra WHERE rank <= 10
UNION ALL
SELECT 'top_pairs_' || side, CAST(rank AS INTEGER), label, n FROM rp WHERE rank <= 5
"""

SQL["device_release_share"] = with_("an_rows") + """,
c AS (SELECT device, release_type, count(*) AS n FROM an_counted GROUP BY ALL),
g AS (
  SELECT 'device' AS dimension, device AS key, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY device
  UNION ALL SELECT 'release_type', release_type, CAST(sum(n) AS BIGINT) FROM c GROUP BY release_type)
SELECT dimension, key, n, round(n / sum(n) OVER (PARTITION BY dimension), 4) AS share FROM g
"""

SQL["topk_fingerprints"] = with_("an_rows") + """,
c AS (SELECT device, release_type, count(*) AS entries FROM an_counted GROUP BY ALL),
dev AS (SELECT device, CAST(sum(entries) AS BIGINT) AS device_total FROM c GROUP BY device),
top_dev AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY device_total DESC, device) AS INTEGER) AS device_rank FROM dev)
  WHERE device_rank <= 5),
fpc AS (
  SELECT device, release_type, fp, side, app, count(*) AS n FROM an_side
  WHERE (fp IS NULL OR fp <> '') AND device IN (SELECT device FROM top_dev) GROUP BY ALL),
fp_tot AS (SELECT device, release_type, fp, CAST(sum(n) AS BIGINT) AS fp_total_apps FROM fpc GROUP BY ALL),
top_fp AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY device, release_type ORDER BY fp_total_apps DESC, fp NULLS LAST) AS INTEGER) AS fp_rank FROM fp_tot)
  WHERE fp_rank <= 3),
apps AS (
  SELECT * FROM (
    SELECT f.*, row_number() OVER (PARTITION BY f.device, f.release_type, f.fp, f.side ORDER BY f.n DESC, f.app) AS app_rank
    FROM fpc f JOIN top_fp t ON f.device = t.device AND f.release_type = t.release_type AND f.fp = t.fp)
  WHERE app_rank <= 3),
txt AS (
  SELECT device, release_type, fp,
         coalesce(string_agg(app || ' (' || CAST(n AS VARCHAR) || ')', ', ' ORDER BY app_rank) FILTER (WHERE side = 'base'), '') AS top_base,
         coalesce(string_agg(app || ' (' || CAST(n AS VARCHAR) || ')', ', ' ORDER BY app_rank) FILTER (WHERE side = 'variant'), '') AS top_variant
  FROM apps GROUP BY ALL)
SELECT d.device_rank, d.device, d.device_total, t.release_type, c.entries, t.fp_rank, t.fp AS fingerprint,
       t.fp_total_apps, x.top_base, x.top_variant
FROM top_fp t
LEFT JOIN txt x ON t.device = x.device AND t.release_type = x.release_type AND t.fp = x.fp
JOIN c ON t.device = c.device AND t.release_type = c.release_type
JOIN top_dev d ON t.device = d.device
"""

SQL["headline"] = with_("an_rows") + """,
apps AS (SELECT side, app, count(*) AS n FROM an_side GROUP BY ALL),
top_app AS (SELECT app, n FROM apps WHERE side = 'base' ORDER BY n DESC, app LIMIT 1),
pairs AS (SELECT app_a, app_b, count(*) AS n FROM an_pairs WHERE side = 'base' GROUP BY ALL),
top_pair AS (SELECT app_a, app_b, n FROM pairs ORDER BY n DESC, app_a, app_b LIMIT 1)
SELECT (SELECT count(DISTINCT device) FROM an_counted) AS total_devices,
       (SELECT count(*) FROM an_counted) AS total_entries,
       (SELECT count(*) FROM apps WHERE side = 'base') AS unique_base,
       (SELECT count(*) FROM apps WHERE side = 'variant') AS unique_variant,
       (SELECT app FROM top_app) AS top_base_app, (SELECT n FROM top_app) AS top_base_n,
       (SELECT app_a FROM top_pair) AS top_pair_a, (SELECT app_b FROM top_pair) AS top_pair_b,
       (SELECT n FROM top_pair) AS top_pair_n,
       (SELECT count(DISTINCT device) FROM an_counted) > 10 AS high_diversity
"""

CTE["series"] = """
series AS (
  SELECT user_id AS g,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS pos,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS v,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS x,
         CAST(floor(value) AS BIGINT) AS y
  FROM events)"""
DEPS["series"] = []

CTE["tickets"] = """
tickets AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS ticket_id,
         event_type || ':' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS content,
         sha256(event_type || ':' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)) AS content_hash
  FROM events)"""
DEPS["tickets"] = []

SQL["smaller_count"] = with_("series") + """
SELECT g, pos, v, CAST(rank() OVER (PARTITION BY g ORDER BY v) - 1 AS BIGINT) AS smaller FROM series
"""

SQL["best_rise"] = with_("series") + """,
m AS (SELECT g, v, min(v) OVER (PARTITION BY g ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM series)
SELECT g, CAST(greatest(0, coalesce(max(v - pm), 0)) AS BIGINT) AS best_rise FROM m GROUP BY g
"""

SQL["path_length"] = with_("series") + """,
p AS (SELECT g, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py FROM series WINDOW w AS (PARTITION BY g ORDER BY pos))
SELECT g, CAST(coalesce(sum(greatest(abs(x - px), abs(y - py))), 0) AS BIGINT) AS path_length FROM p GROUP BY g
"""

SQL["pair_sum"] = with_("series") + """,
pairs AS (
  SELECT a.g, a.pos AS i, b.pos AS j, a.v AS v_i, b.v AS v_j,
         row_number() OVER (PARTITION BY a.g ORDER BY a.pos, b.pos) AS rn
  FROM series a JOIN series b ON a.g = b.g AND a.pos < b.pos AND a.v + b.v = 100)
SELECT g, i, j, v_i, v_j FROM pairs WHERE rn = 1
"""

SQL["has_duplicates"] = with_("series") + """
SELECT g, count(*) AS n, count(DISTINCT v) AS n_distinct, count(*) > count(DISTINCT v) AS has_duplicates
FROM series GROUP BY g
"""

SQL["missing_ids"] = """
SELECT range AS id FROM range(0, (SELECT max(o_orderkey) FROM orders) + 1)
WHERE range NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)
"""

SQL["missing_by_sum"] = """
WITH w AS (SELECT conv_id, coalesce(sum(length(text)), 0) % count(*) AS left_out FROM conversations GROUP BY conv_id),
t AS (SELECT c.conv_id, c.turn FROM conversations c JOIN w ON c.conv_id = w.conv_id WHERE c.turn <> w.left_out),
a AS (SELECT conv_id, count(*) AS n, sum(turn) AS s FROM t GROUP BY conv_id)
SELECT conv_id, n, CAST(n * (n + 1) // 2 - s AS BIGINT) AS missing FROM a
"""

SQL["id_membership"] = """
SELECT o_orderstatus, count(*) AS n_orders,
       count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS with_lines,
       count(*) FILTER (WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)) AS without_lines
FROM orders GROUP BY o_orderstatus
"""

SQL["content_hash_dedup"] = with_("tickets") + """
SELECT seq, ticket_id, content, content_hash
FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY seq) AS rn FROM tickets) WHERE rn = 1
"""

SQL["insert_if_absent"] = with_("tickets") + """,
f AS (SELECT content_hash, arg_min(seq, seq) AS fseq, arg_min(ticket_id, seq) AS fticket FROM tickets GROUP BY content_hash)
SELECT t.seq, t.ticket_id, t.content_hash, t.seq = f.fseq AS created,
       CASE WHEN t.seq = f.fseq THEN NULL WHEN t.ticket_id = f.fticket THEN 'exists' ELSE 'hash_taken' END AS reason
FROM tickets t JOIN f ON t.content_hash = f.content_hash
"""

CTE["versions"] = """
firsts AS (
  SELECT ticket_id, content_hash, min(seq) AS first_seq, arg_min(content, seq) AS content
  FROM tickets GROUP BY ticket_id, content_hash),
versions AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY ticket_id ORDER BY first_seq) AS BIGINT) AS version,
         count(*) OVER (PARTITION BY ticket_id) AS nv
  FROM firsts)"""
DEPS["versions"] = ["tickets"]

SQL["versions"] = with_("versions") + """
SELECT ticket_id, content_hash, first_seq, content, version, version = nv AS is_latest FROM versions
"""

SQL["latest"] = with_("versions") + """
SELECT ticket_id, version AS max_version, content, content_hash FROM versions WHERE version = nv
"""

SQL["batch_ingest"] = with_("tickets") + """,
mid AS (SELECT max(seq) // 2 AS m FROM tickets),
store AS (SELECT * FROM tickets WHERE seq <= (SELECT m FROM mid)),
batch AS (SELECT * FROM tickets WHERE seq > (SELECT m FROM mid)),
existing AS (SELECT DISTINCT content_hash FROM store WHERE ticket_id IN (SELECT ticket_id FROM batch)),
fresh AS (SELECT * FROM batch WHERE content_hash NOT IN (SELECT content_hash FROM existing))
SELECT seq, ticket_id, content, content_hash
FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY seq) AS rn FROM fresh) WHERE rn = 1
"""

SQL["assemble_docs"] = """
SELECT conv_id AS doc_id, count(*) AS n_pages, string_agg(coalesce(text, ''), '\n\n' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id
"""

CTE["doc_chunks"] = """
doc_starts AS (
  SELECT doc_id, text, CAST(len(coalesce(text, '')) AS BIGINT) AS L,
         unnest(CASE WHEN len(coalesce(text, '')) > 0 THEN range(0, len(text), 700) ELSE [] END) AS start
  FROM documents),
doc_chunks AS (
  SELECT doc_id, CAST(start // 700 AS INTEGER) AS chunk_idx,
         CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS n_chunks,
         substr(text, CAST(start AS BIGINT) + 1, 800) AS chunk
  FROM doc_starts)"""
DEPS["doc_chunks"] = []

SQL["chunks"] = with_("doc_chunks") + """
SELECT doc_id, n_chunks, chunk_idx, chunk FROM doc_chunks
"""

SQL["relevant_chunks"] = with_("doc_chunks") + """,
qt AS (
  SELECT term, count(*) AS qtf
  FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\s+')) AS term FROM benchmark) WHERE term <> '' GROUP BY term),
q2 AS (SELECT sum(qtf * qtf) AS q2 FROM qt),
big AS (SELECT * FROM doc_chunks),
tc AS (
  SELECT doc_id, chunk_idx, term, count(*) AS tf
  FROM (SELECT doc_id, chunk_idx, unnest(regexp_split_to_array(lower(chunk), '\\s+')) AS term FROM big)
  WHERE term <> '' GROUP BY ALL),
pc AS (
  SELECT tc.doc_id, tc.chunk_idx, coalesce(sum(tc.tf * qt.qtf), 0) AS dot, sum(tc.tf * tc.tf) AS c2
  FROM tc LEFT JOIN qt ON tc.term = qt.term GROUP BY ALL),
scored AS (
  SELECT b.doc_id, b.chunk_idx, b.chunk,
         coalesce(CAST(pc.dot AS DOUBLE) / sqrt(CAST(pc.c2 * (SELECT q2 FROM q2) AS DOUBLE)), 0.0) AS score
  FROM big b LEFT JOIN pc ON b.doc_id = pc.doc_id AND b.chunk_idx = pc.chunk_idx),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, chunk_idx) AS rk FROM scored)
  WHERE rk <= 15),
kept AS (SELECT doc_id, count(*) AS n_kept, string_agg(chunk, '\n\n' ORDER BY chunk_idx) AS filtered FROM best GROUP BY doc_id),
n AS (SELECT doc_id, max(n_chunks) AS n_chunks FROM doc_chunks GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n_chunks, 0) AS INTEGER) AS n_chunks,
       CAST(coalesce(k.n_kept, 0) AS INTEGER) AS n_kept,
       CASE WHEN k.n_kept IS NULL THEN d.text ELSE k.filtered END AS text
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

SQL["vector_topk"] = """
WITH q AS (
  SELECT label AS query_label, min(vec_id) AS query_id, arg_min(embedding, vec_id) AS qv FROM embeddings GROUP BY label),
qn AS (
  SELECT query_id, query_label,
         list_transform(qv, lambda x: CAST(x AS DOUBLE) / sqrt(list_reduce(list_transform(qv, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)), lambda a, b: a + b))) AS qv
  FROM q),
scored AS (
  SELECT qn.query_label, qn.query_id, e.vec_id,
         list_reduce(list_transform(range(1, len(e.embedding) + 1), lambda i: CAST(e.embedding[i] AS DOUBLE) * qn.qv[i]), lambda a, b: a + b) AS score
  FROM embeddings e, qn),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_label, query_id, rank, vec_id, round(score, 6) AS score FROM r WHERE rank <= 10
"""

CTE["lines"] = """
lines AS (
  SELECT conv_id AS doc_id, CAST(turn AS BIGINT) * 4294967296 AS line_no, 'TOPIC: ' || role AS line FROM conversations
  UNION ALL
  SELECT conv_id, CAST(turn AS BIGINT) * 4294967296 + i, 'FACT: ' || line
  FROM (SELECT conv_id, turn, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM conversations)),
stripped AS (
  SELECT doc_id, line_no, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS sl FROM lines),
items AS (
  SELECT doc_id, line_no, item FROM (
    SELECT doc_id, line_no,
      CASE WHEN starts_with(sl, 'TOPIC:') THEN regexp_replace(replace(sl, 'TOPIC:', ''), '^\\s+|\\s+$', '', 'g')
           WHEN starts_with(sl, '- ') OR starts_with(sl, '* ') THEN regexp_replace(substr(sl, 3), '^\\s+|\\s+$', '', 'g')
           WHEN regexp_matches(sl, '^\\d+[.)]\\s+') THEN regexp_replace(regexp_replace(sl, '^\\d+[.)]\\s+', ''), '^\\s+|\\s+$', '', 'g')
      END AS item
    FROM stripped)
  WHERE length(item) > 3),
firsts AS (
  SELECT min({'d': doc_id, 'l': line_no}) AS first_at, arg_min(item, {'d': doc_id, 'l': line_no}) AS item
  FROM items GROUP BY lower(trim(item)))"""
DEPS["lines"] = []

SQL["topic_list"] = with_("lines") + """,
numbered AS (SELECT CAST(row_number() OVER (ORDER BY first_at) - 1 AS BIGINT) AS topic_pos, item AS topic FROM firsts)
SELECT topic_pos, topic FROM numbered
"""

CTE["facts"] = """
topics AS (
  SELECT CAST(row_number() OVER (ORDER BY first_at) - 1 AS BIGINT) AS topic_pos, item AS topic FROM firsts),
hdr AS (
  SELECT doc_id, line_no AS h_line, lower(regexp_replace(replace(sl, 'TOPIC:', ''), '^\\s+|\\s+$', '', 'g')) AS name
  FROM stripped WHERE starts_with(sl, 'TOPIC:')),
matched AS (
  SELECT h.doc_id, h.h_line, arg_min(t.topic, t.topic_pos) AS topic
  FROM hdr h JOIN topics t ON contains(h.name, lower(t.topic)) OR contains(lower(t.topic), h.name)
  GROUP BY ALL),
cur AS (
  SELECT *, max(CASE WHEN starts_with(sl, 'TOPIC:') THEN line_no END)
              OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS h_line
  FROM stripped),
fl AS (
  SELECT doc_id, line_no, h_line, regexp_replace(replace(sl, 'FACT:', ''), '^\\s+|\\s+$', '', 'g') AS fact
  FROM cur WHERE starts_with(sl, 'FACT:') AND h_line IS NOT NULL),
facts AS (
  SELECT m.topic, f.doc_id, f.line_no, '[' || CAST(f.doc_id AS VARCHAR) || '] ' || f.fact AS fact
  FROM fl f JOIN matched m ON f.doc_id = m.doc_id AND f.h_line = m.h_line
  WHERE length(f.fact) > 10 AND upper(f.fact) <> 'NONE')"""
DEPS["facts"] = ["lines"]

SQL["section_facts"] = with_("facts") + """
SELECT topic, doc_id, line_no, fact FROM facts
"""

SQL["facts_by_topic"] = with_("facts") + """
SELECT t.topic_pos, f.topic, count(*) AS n_facts, count(DISTINCT f.doc_id) AS n_docs,
       arg_min(f.fact, {'d': f.doc_id, 'l': f.line_no}) AS first_fact
FROM facts f JOIN topics t ON f.topic = t.topic GROUP BY ALL
"""

SQL["document_report"] = with_("facts") + """
SELECT 'document_totals' AS section, 0 AS rank, label, CAST(value AS DOUBLE) AS value
FROM (SELECT 'documents' AS label, count(DISTINCT conv_id) AS value FROM conversations
      UNION ALL SELECT 'topics', count(*) FROM topics
      UNION ALL SELECT 'facts', count(*) FROM facts)
UNION ALL
SELECT 'topic_facts', CAST(t.topic_pos AS INTEGER), t.topic, CAST(count(f.doc_id) AS DOUBLE)
FROM topics t LEFT JOIN facts f ON f.topic = t.topic GROUP BY t.topic_pos, t.topic
"""

CTE["page_title"] = """
page_t AS (
  SELECT page_id, url, html,
         replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1),
           '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS t
  FROM pages),
page_titles AS (
  SELECT page_id, url,
         CASE WHEN contains(t, ' [') AND contains(t, '] - Issue Tracker') THEN split_part(t, ' [', 1)
              WHEN t <> '' AND contains(t, ' - Issue Tracker') THEN split_part(t, ' - Issue Tracker', 1)
              WHEN t <> '' THEN t
              ELSE 'Title not parseable from page_title' END AS title
  FROM page_t)"""
DEPS["page_title"] = []

CTE["page_items"] = """
raw_items AS (
  SELECT page_id, unnest(regexp_extract_all(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>', '', 'g'),
                                            '(?is)<p>(.*?)</p>', 1)) AS p,
         generate_subscripts(regexp_extract_all(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>', '', 'g'),
                                                '(?is)<p>(.*?)</p>', 1), 1) - 1 AS raw_pos
  FROM pages),
items0 AS (
  SELECT page_id, CAST(raw_pos AS INTEGER) AS raw_pos,
         regexp_replace(replace(replace(replace(replace(replace(regexp_replace(p, '<[^>]*>', '', 'g'),
           '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '^\\s+|\\s+$', '', 'g') AS text
  FROM raw_items),
page_items AS (
  SELECT page_id, raw_pos, text FROM items0 WHERE text <> '')"""
DEPS["page_items"] = []

SQL["page_titles"] = with_("page_title") + """
SELECT page_id, url, title FROM page_titles
"""

SQL["page_items"] = with_("page_items") + """
SELECT page_id, raw_pos, text FROM page_items
"""

SQL["comments_concat"] = with_("page_title", "page_items") + """,
d AS (SELECT page_id, arg_min(text, raw_pos) AS description_text, min(raw_pos) AS p0 FROM page_items GROUP BY page_id),
c AS (
  SELECT i.page_id,
         string_agg('--- Comment ID: p' || CAST(i.raw_pos AS VARCHAR) || ' ---' || chr(10) || 'Author: Unknown' || chr(10)
                    || 'Timestamp: Unknown' || chr(10) || 'Text:' || chr(10) || i.text || chr(10) || chr(10), '' ORDER BY i.raw_pos) AS allc
  FROM page_items i JOIN d ON i.page_id = d.page_id WHERE i.raw_pos <> d.p0 GROUP BY i.page_id),
o AS (
  SELECT t.page_id, coalesce(t.url, 'Not found') AS issue_url, t.title AS issue_title, d.description_text,
         regexp_replace(coalesce(c.allc, ''), '^\\s+|\\s+$', '', 'g') AS allc
  FROM page_titles t LEFT JOIN d ON t.page_id = d.page_id LEFT JOIN c ON t.page_id = c.page_id)
SELECT page_id, issue_url, issue_title,
       coalesce(description_text, 'Description block not found') AS description_text,
       CASE WHEN allc <> '' THEN allc
            WHEN NOT starts_with(coalesce(description_text, 'Description block not found'), 'Description block') THEN 'No subsequent comments found.'
            ELSE 'No comments or description found.' END AS all_comments_concatenated
FROM o
"""

SQL["csv_roundtrip"] = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents
"""

CTE["part_text"] = """
part_text AS (
  SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
         CAST(p_retailprice AS VARCHAR) AS p_retailprice
  FROM part),
found AS (
  SELECT * FROM part_text
  WHERE contains(lower(p_partkey), 'red') OR contains(lower(p_name), 'red') OR contains(lower(p_brand), 'red')
     OR contains(lower(p_type), 'red') OR contains(lower(p_size), 'red') OR contains(lower(p_retailprice), 'red'))"""
DEPS["part_text"] = []

SQL["search_any"] = with_("part_text") + """
SELECT * FROM found
"""

SQL["edit_rows"] = with_("part_text") + """
SELECT t.p_partkey,
       CASE WHEN p.p_size >= 45 THEN upper(p.p_name) ELSE t.p_name END AS p_name,
       CASE WHEN p.p_retailprice > 1500 THEN p.p_brand || '-X' ELSE t.p_brand END AS p_brand,
       t.p_type, t.p_size, t.p_retailprice
FROM part_text t JOIN part p ON t.p_partkey = CAST(p.p_partkey AS VARCHAR)
"""

SQL["delete_rows"] = with_("part_text") + """
SELECT f.* FROM found f JOIN part p ON f.p_partkey = CAST(p.p_partkey AS VARCHAR) WHERE NOT (p.p_size <= 5)
"""

SQL["listing"] = with_("part_text") + """,
numbered AS (SELECT p_partkey, CAST(row_number() OVER (ORDER BY CAST(p_partkey AS BIGINT)) AS INTEGER) AS record_no FROM part_text),
f AS (
  SELECT f.p_partkey, f.p_name, n.record_no,
         CAST(row_number() OVER (ORDER BY CAST(f.p_partkey AS BIGINT)) AS INTEGER) AS position,
         lag(f.p_partkey) OVER (ORDER BY CAST(f.p_partkey AS BIGINT)) AS prev_key,
         lead(f.p_partkey) OVER (ORDER BY CAST(f.p_partkey AS BIGINT)) AS next_key,
         count(*) OVER () AS n
  FROM found f JOIN numbered n ON f.p_partkey = n.p_partkey)
SELECT p_partkey, record_no, position, n, prev_key, next_key,
       CASE WHEN coalesce(p_partkey, '') = '' THEN 'Record ' || CAST(record_no AS VARCHAR)
            WHEN trim(p_partkey) = '' THEN '(empty)' ELSE trim(p_partkey) END AS title,
       trim(coalesce(p_name, '')) AS subtitle
FROM f
"""

SQL["json_nested"] = with_("merged") + """
SELECT device, build_type, fp_code, sdp_code,
       CAST(to_json({'device': device, 'build_type': build_type, 'fp_code': fp_code, 'sdp_code': sdp_code,
                'fingerprint': fingerprint, 'same_device_fingerprints': same_device_fingerprints,
                'priv_base_apps': priv_base_apps, 'priv_var_apps': priv_var_apps,
                'base': base, 'variant': variant}) AS VARCHAR) AS json
FROM merged
"""

SQL["anagram_groups"] = """
WITH w AS (
  SELECT word, count(*) AS occurrences
  FROM (SELECT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS word FROM documents) GROUP BY word),
k AS (SELECT array_to_string(list_sort(string_split(word, '')), '') AS key, word, occurrences FROM w)
SELECT key, count(*) AS n_words, CAST(sum(occurrences) AS BIGINT) AS n_occurrences,
       array_to_string(list_sort(list(word)), '|') AS words
FROM k GROUP BY key HAVING count(*) > 1
"""

SQL["bracket_check"] = """
WITH b AS (SELECT doc_id, regexp_replace(text, '[^()\\[\\]{}]', '', 'g') AS b FROM documents)
SELECT doc_id, CAST(length(b) AS INTEGER) AS n_brackets,
       list_reduce(list_filter(string_split(b, ''), lambda x: x <> ''), lambda acc, ch:
         CASE WHEN acc = '!' THEN acc
              WHEN ch IN ('(', '[', '{') THEN acc || ch
              WHEN ch = ')' AND right(acc, 1) = '(' THEN left(acc, length(acc) - 1)
              WHEN ch = ']' AND right(acc, 1) = '[' THEN left(acc, length(acc) - 1)
              WHEN ch = '}' AND right(acc, 1) = '{' THEN left(acc, length(acc) - 1)
              ELSE '!' END, '') = '' AS balanced
FROM b
"""

SQL["branch_sums"] = """
WITH RECURSIVE nodes AS (
  SELECT 'r:' || CAST(r_regionkey AS VARCHAR) AS node_id, NULL::VARCHAR AS parent_id, CAST(r_regionkey AS BIGINT) AS value FROM region
  UNION ALL SELECT 'n:' || CAST(n_nationkey AS VARCHAR), 'r:' || CAST(n_regionkey AS VARCHAR), CAST(n_nationkey AS BIGINT) FROM nation
  UNION ALL SELECT 'c:' || CAST(c_custkey AS VARCHAR), 'n:' || CAST(c_nationkey AS VARCHAR), CAST(round(c_acctbal * 100) AS BIGINT) FROM customer),
walk(node_id, root_id, branch_sum, depth, path) AS (
  SELECT node_id, node_id, value, 1, node_id FROM nodes WHERE parent_id IS NULL
  UNION ALL
  SELECT n.node_id, w.root_id, w.branch_sum + n.value, w.depth + 1, w.path || '/' || n.node_id
  FROM walk w JOIN nodes n ON n.parent_id = w.node_id)
SELECT 0 AS tree_id, node_id AS leaf_id, root_id, branch_sum, CAST(depth AS INTEGER) AS depth, path
FROM walk WHERE node_id NOT IN (SELECT parent_id FROM nodes WHERE parent_id IS NOT NULL)
"""

SQL["metric_tree"] = """
WITH l AS (
  SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS q, CAST(sum(l_linenumber) AS BIGINT) AS a, count(*) AS c
  FROM lineitem GROUP BY l_orderkey),
t AS (
  SELECT o.o_orderkey, o.o_orderstatus, l.q, CASE WHEN l.c <> 0 THEN (l.a - 3 * l.c) // l.c END AS r
  FROM orders o JOIN l ON o.o_orderkey = l.l_orderkey)
SELECT o_orderkey AS tree_id,
       CAST(CASE o_orderstatus WHEN 'O' THEN q + r WHEN 'F' THEN q * r ELSE q - r END AS BIGINT) AS result
FROM t
"""

CTE["sections"] = """
sec_rows AS (SELECT * FROM config_rows WHERE device IS NOT NULL AND build_type IS NOT NULL),
fpf AS (
  SELECT device, build_type, fingerprint, min(rid) AS fp_first FROM sec_rows
  WHERE fingerprint IS NOT NULL GROUP BY ALL),
sdf AS (
  SELECT device, build_type, same_device_fingerprints, min(rid) AS sdp_first FROM sec_rows
  WHERE same_device_fingerprints IS NOT NULL GROUP BY ALL),
keyed AS (
  SELECT r.*, f.fp_first, s.sdp_first,
         CAST(json(replace(r.priv_base_apps, '''', '"')) AS VARCHAR[]) AS bl,
         CAST(json(replace(r.priv_var_apps, '''', '"')) AS VARCHAR[]) AS vl
  FROM sec_rows r
  JOIN fpf f ON r.device = f.device AND r.build_type = f.build_type AND r.fingerprint = f.fingerprint
  JOIN sdf s ON r.device = s.device AND r.build_type = s.build_type AND r.same_device_fingerprints = s.same_device_fingerprints),
sitems AS (
  SELECT device, build_type, fingerprint, same_device_fingerprints, fp_first, sdp_first, rid,
         'base' AS side, unnest(bl) AS app, generate_subscripts(bl, 1) AS pos FROM keyed
  UNION ALL
  SELECT device, build_type, fingerprint, same_device_fingerprints, fp_first, sdp_first, rid,
         'variant' AS side, unnest(vl) AS app, generate_subscripts(vl, 1) AS pos FROM keyed),
in_combo AS (
  SELECT device, build_type, fingerprint, same_device_fingerprints, fp_first, sdp_first, side, app,
         min({'r': rid, 'p': pos}) AS first_at
  FROM sitems GROUP BY ALL),
combos AS (SELECT DISTINCT device, build_type, fingerprint, same_device_fingerprints, fp_first, sdp_first FROM keyed),
csizes AS (
  SELECT device, build_type, fingerprint, same_device_fingerprints,
         count(*) FILTER (WHERE side = 'base') AS nb, count(*) FILTER (WHERE side = 'variant') AS nv
  FROM in_combo GROUP BY ALL),
cs AS (
  SELECT c.*, coalesce(s.nb, 0) AS nb, coalesce(s.nv, 0) AS nv
  FROM combos c LEFT JOIN csizes s
    ON c.device = s.device AND c.build_type = s.build_type AND c.fingerprint = s.fingerprint
   AND c.same_device_fingerprints = s.same_device_fingerprints),
per_section AS (
  SELECT device, build_type, count(*) AS n_combos, sum(nb) AS bt, sum(nv) AS vt,
         arg_min({'nb': nb, 'nv': nv}, {'s': nb + nv, 'a': fp_first, 'b': sdp_first}) AS min_combo,
         arg_max({'nb': nb, 'nv': nv}, {'s': nb + nv, 'a': -fp_first, 'b': -sdp_first}) AS max_combo
  FROM cs GROUP BY ALL),
sapp AS (
  SELECT device, build_type, side, app, count(*) AS n,
         min({'f': fp_first, 's': sdp_first, 'at': first_at}) AS first_at
  FROM in_combo GROUP BY ALL),
dom AS (
  SELECT *, row_number() OVER (PARTITION BY device, build_type, side ORDER BY first_at) AS rk FROM sapp WHERE n > 1),
domtxt AS (
  SELECT device, build_type, side,
         string_agg(app, ', ' ORDER BY rk) FILTER (WHERE rk <= 3) AS d3,
         string_agg(app, ', ' ORDER BY rk) FILTER (WHERE rk <= 2) AS d2
  FROM dom GROUP BY ALL),
per_side AS (
  SELECT device, build_type, side, count(*) AS uniq, count(*) FILTER (WHERE n = 1) AS single,
         count(*) FILTER (WHERE n > 1) AS dominant
  FROM sapp GROUP BY ALL),
sstats AS (
  SELECT p.device, p.build_type, p.n_combos, coalesce(p.bt, 0) AS bt, coalesce(p.vt, 0) AS vt,
         coalesce(b.uniq, 0) AS bu, coalesce(v.uniq, 0) AS vu, coalesce(b.single, 0) AS bs,
         coalesce(b.dominant, 0) AS bd, coalesce(v.dominant, 0) AS vd,
         coalesce(db.d3, '') AS bd3, coalesce(db.d2, '') AS bd2, coalesce(dv.d3, '') AS vd3,
         p.min_combo, p.max_combo
  FROM per_section p
  LEFT JOIN per_side b ON p.device = b.device AND p.build_type = b.build_type AND b.side = 'base'
  LEFT JOIN per_side v ON p.device = v.device AND p.build_type = v.build_type AND v.side = 'variant'
  LEFT JOIN domtxt db ON p.device = db.device AND p.build_type = db.build_type AND db.side = 'base'
  LEFT JOIN domtxt dv ON p.device = dv.device AND p.build_type = dv.build_type AND dv.side = 'variant'),
sfmt AS (
  SELECT *, CASE WHEN n_combos <= 0 THEN '0' ELSE printf('%.1f', bt / n_combos) END AS rb,
         CASE WHEN n_combos <= 0 THEN '0' ELSE printf('%.1f', vt / n_combos) END AS rv
  FROM sstats),
insights AS (
  SELECT device, build_type, n_combos, bu AS base_unique, CAST(bt AS BIGINT) AS base_total,
         vu AS var_unique, CAST(vt AS BIGINT) AS var_total,
    concat_ws(chr(10),
      '**PRIV BASE APPS INSIGHT**',
      CASE WHEN bd > 0 THEN 'Analysis identified ' || bd || ' dominant base app(s) appearing across multiple combinations: ' || bd3
                            || '. These represent core privileged applications consistently required for this device configuration.'
           WHEN bu = bt AND bu > 0 THEN 'All ' || bu || ' base apps are unique across combinations, indicating highly specialized privileged application requirements for each fingerprint pairing. No single app dominates the configuration.'
           ELSE 'The ' || bu || ' unique base apps show a distributed pattern across ' || n_combos || ' combinations, averaging '
                || rb || ' apps per combination.' END,
      CASE WHEN bs * 10 > bu * 7 AND bu > 0 THEN 'Notable: ' || bs || ' apps (' || (bs * 100 // greatest(bu, 1))
                || '%) appear only once, suggesting fingerprint-specific requirements.' END,
      chr(10) || '**PRIV VARIANT APPS INSIGHT**',
      CASE WHEN vd > 0 THEN 'Variant apps show ' || vd || ' recurring application(s): ' || vd3
                            || '. These likely represent shared system components across device variants.'
           WHEN vu = vt AND vu > 0 THEN 'Each of the ' || vu || ' variant apps is unique to its combination, indicating distinct customization per fingerprint configuration.'
           ELSE 'The variant app distribution shows ' || vu || ' unique apps averaging ' || rv || ' per combination.' END,
      chr(10) || '**COMBINED ANALYSIS**',
      CASE WHEN bu > vu THEN 'Base apps (' || bu || ') show more diversity than variant apps (' || vu || '), suggesting privileged base configurations are more variable than system variants for this build type.'
           WHEN vu > bu THEN 'Variant apps (' || vu || ') exceed base app diversity (' || bu || '), indicating system customization varies more than core privileged app requirements.'
           ELSE 'Base and variant apps show similar diversity (' || bu || ' each), suggesting balanced configuration complexity.' END,
      CASE WHEN n_combos > 0 AND (min_combo.nb <> max_combo.nb OR min_combo.nv <> max_combo.nv)
           THEN 'Combination complexity ranges from ' || (min_combo.nb + min_combo.nv) || ' to ' || (max_combo.nb + max_combo.nv)
                || ' total apps, indicating variable configuration requirements.' END,
      chr(10) || '**KEY FINDINGS**',
      CASE WHEN bd > 0 THEN '• Core dependencies: ' || bd2 || ' appear in multiple configurations' END,
      CASE WHEN bs > 2 THEN '• ' || bs || ' specialized base apps suggest fingerprint-specific requirements' END,
      CASE WHEN bt > n_combos * 2 THEN '• High base app density (' || rb || ' avg) indicates complex privileged requirements' END,
      CASE WHEN vu < bu AND vu > 0 THEN '• Variant apps are more standardized than base apps across this configuration' END,
      CASE WHEN NOT (bd > 0 OR bs > 2 OR bt > n_combos * 2 OR (vu < bu AND vu > 0))
           THEN '• Configuration shows standard distribution with ' || n_combos || ' combinations' END,
      CASE WHEN NOT (bd > 0 OR bs > 2 OR bt > n_combos * 2 OR (vu < bu AND vu > 0))
           THEN '• No single app dominates - distributed privileged requirements' END) AS insight
  FROM sfmt)"""
DEPS["sections"] = ["config_rows"]

SQL["insight_text"] = with_("sections") + """
SELECT * FROM insights
"""

SQL["insight_sections"] = with_("sections") + """,
marked AS (
  SELECT device, build_type,
         string_split(replace(regexp_replace(insight, '\\n\\n+', chr(1), 'g'), chr(10) || '**', chr(1) || '**'), chr(1)) AS parts
  FROM insights),
pieces AS (
  SELECT device, build_type, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS idx FROM marked),
t AS (SELECT device, build_type, CAST(idx AS INTEGER) AS idx, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS t FROM pieces)
SELECT device, build_type, idx, regexp_matches(t, '^\\*\\*.*\\*\\*$') AS is_header, replace(t, '**', '') AS text
FROM t WHERE t <> ''
"""

SQL["request_rows"] = with_("rc", "sections") + """,
numbered AS (
  SELECT rc.*, CAST(row_number() OVER (PARTITION BY rc.device, rc.build_type ORDER BY f.fp_first, s.sdp_first) AS INTEGER) AS combo_no
  FROM rc
  JOIN fpf f ON rc.device = f.device AND rc.build_type = f.build_type AND rc.fingerprint = f.fingerprint
  JOIN sdf s ON rc.device = s.device AND rc.build_type = s.build_type AND rc.same_device_fingerprints = s.same_device_fingerprints)
SELECT device, build_type, combo_no,
       chr(10) || combo_no || '. FP: ' || fp_code || ' | SDP: ' || sdp_code || chr(10)
       || '   Base Apps (' || len(base) || '): ' || array_to_string(base[1:5], ', ') || CASE WHEN len(base) > 5 THEN '...' ELSE '' END || chr(10)
       || '   Var Apps (' || len(variant) || '): ' || array_to_string(variant[1:5], ', ') || CASE WHEN len(variant) > 5 THEN '...' ELSE '' END || chr(10)
       AS text
FROM numbered
"""

SQL["report_rows"] = with_("merged") + """,
apps AS (
  SELECT 'base' AS side, unnest(base) AS app FROM merged
  UNION ALL SELECT 'variant' AS side, unnest(variant) AS app FROM merged),
c AS (SELECT side, app, count(*) AS n FROM apps GROUP BY side, app),
r AS (SELECT side, app, n, row_number() OVER (PARTITION BY side ORDER BY n DESC, app) AS rank FROM c),
cc AS (SELECT coalesce(fp_code, 'nan') || ' vs ' || coalesce(sdp_code, 'nan') AS combo, count(*) AS n FROM merged GROUP BY 1),
rc AS (SELECT combo, n, row_number() OVER (ORDER BY n DESC, combo) AS rank FROM cc),
o AS (
  SELECT count(*) AS total_rows, sum(len(base)) AS total_base, sum(len(variant)) AS total_var,
         (SELECT count(DISTINCT app) FROM apps WHERE side = 'base') AS unique_base,
         (SELECT count(DISTINCT app) FROM apps WHERE side = 'variant') AS unique_var
  FROM merged)
SELECT 'top_base_apps' AS section, CAST(rank AS INTEGER) AS rank, app AS label, CAST(n AS DOUBLE) AS value FROM r WHERE side = 'base' AND rank <= 10
UNION ALL SELECT 'top_variant_apps', CAST(rank AS INTEGER), app, CAST(n AS DOUBLE) FROM r WHERE side = 'variant' AND rank <= 10
UNION ALL SELECT 'top_combinations', CAST(rank AS INTEGER), combo, CAST(n AS DOUBLE) FROM rc WHERE rank <= 10
UNION ALL SELECT 'overall', 0, 'total_rows', CAST(total_rows AS DOUBLE) FROM o
UNION ALL SELECT 'overall', 0, 'total_base', CAST(total_base AS DOUBLE) FROM o
UNION ALL SELECT 'overall', 0, 'unique_base', CAST(unique_base AS DOUBLE) FROM o
UNION ALL SELECT 'overall', 0, 'total_var', CAST(total_var AS DOUBLE) FROM o
UNION ALL SELECT 'overall', 0, 'unique_var', CAST(unique_var AS DOUBLE) FROM o
UNION ALL SELECT 'overall', 0, 'avg_base', coalesce(round(total_base / total_rows, 4), 0.0) FROM o
UNION ALL SELECT 'overall', 0, 'avg_var', coalesce(round(total_var / total_rows, 4), 0.0) FROM o
"""

SQL["run_summary"] = with_("rc", "merged", "facts") + """
SELECT (SELECT count(DISTINCT device) FROM rc) AS n_devices,
       (SELECT count(*) FROM (SELECT DISTINCT device, build_type FROM rc)) AS n_sections,
       (SELECT count(*) FROM rc) AS n_combinations,
       (SELECT count(DISTINCT app) FROM (SELECT unnest(base) AS app FROM merged)) AS n_base_apps,
       (SELECT count(DISTINCT app) FROM (SELECT unnest(variant) AS app FROM merged)) AS n_variant_apps,
       (SELECT count(DISTINCT conv_id) FROM conversations) AS n_documents,
       (SELECT count(*) FROM topics) AS n_topics,
       (SELECT count(*) FROM facts) AS n_facts
"""

SQL["batched_scores"] = with_("doc_chunks") + """,
tok AS (
  SELECT 'q' AS kind, item_id AS id, 0 AS chunk_idx, unnest(regexp_split_to_array(lower(text), '\\s+')) AS t FROM benchmark
  UNION ALL
  SELECT 'c', doc_id, chunk_idx, unnest(regexp_split_to_array(lower(chunk), '\\s+')) FROM doc_chunks),
bucket AS (
  SELECT kind, id, chunk_idx, CAST('0x' || left(md5(t), 8) AS BIGINT) % 64 AS b, CAST(count(*) AS DOUBLE) AS n
  FROM tok WHERE t <> '' GROUP BY ALL),
norm AS (SELECT *, n / sqrt(sum(n * n) OVER (PARTITION BY kind, id, chunk_idx)) AS x FROM bucket),
q AS (SELECT b, sum(x) AS x FROM norm WHERE kind = 'q' GROUP BY b),
qn AS (SELECT b, x / sqrt((SELECT sum(x * x) FROM q)) AS x FROM q),
s AS (SELECT n.id, n.chunk_idx, sum(n.x * qn.x) AS score FROM norm n JOIN qn ON n.b = qn.b WHERE kind = 'c' GROUP BY ALL)
SELECT d.doc_id, d.chunk_idx, round(coalesce(s.score, 0.0), 6) AS score
FROM doc_chunks d LEFT JOIN s ON d.doc_id = s.id AND d.chunk_idx = s.chunk_idx
"""

SQL["stream_counts"] = SQL["release_counts"]
SQL["stream_dedup"] = SQL["content_hash_dedup"]
SQL["stream_pair_counts"] = SQL["pair_counts"]
SQL["stream_app_counts"] = with_("an_rows") + """
SELECT side, app, count(*) AS n FROM an_side GROUP BY ALL
"""
SQL["stream_versions"] = SQL["versions"]
SQL["stream_csv"] = with_("page_title") + """
SELECT CAST(page_id AS VARCHAR) AS page_id, url, title FROM page_titles
"""

SQL["doc_quarantine"] = """
WITH b AS (SELECT doc_id, text, n_chars, regexp_replace(text, '[^()\\[\\]{}]', '', 'g') AS b FROM documents),
e AS (
  SELECT doc_id,
    CASE WHEN text IS NULL THEN 'no text'
         WHEN length(text) <> n_chars THEN 'length mismatch'
         WHEN list_reduce(list_filter(string_split(b, ''), lambda x: x <> ''), lambda acc, ch:
                CASE WHEN acc = '!' THEN acc
                     WHEN ch IN ('(', '[', '{') THEN acc || ch
                     WHEN ch = ')' AND right(acc, 1) = '(' THEN left(acc, length(acc) - 1)
                     WHEN ch = ']' AND right(acc, 1) = '[' THEN left(acc, length(acc) - 1)
                     WHEN ch = '}' AND right(acc, 1) = '{' THEN left(acc, length(acc) - 1)
                     ELSE '!' END, '') <> '' THEN 'unbalanced brackets' END AS error
  FROM b)
SELECT doc_id, error FROM e WHERE error IS NOT NULL
"""

SQL["p90_by_type"] = """
SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY event_type
"""

SQL["label_f1"] = """
WITH c AS (
  SELECT count(*) FILTER (WHERE quality = 1 AND 1 - toxic = 1) AS tp,
         count(*) FILTER (WHERE quality <> 1 AND 1 - toxic = 1) AS fp,
         count(*) FILTER (WHERE quality = 1 AND 1 - toxic <> 1) AS fn,
         count(*) FILTER (WHERE quality <> 1 AND 1 - toxic <> 1) AS tn
  FROM labels)
SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy
FROM c
"""
SQL["stream_dedup_watermark"] = """
SELECT DISTINCT user_id, event_type, date_trunc('hour', ts) AS hour FROM events
"""


SQL["event_quarantine"] = """
WITH d AS (
  SELECT event_id,
         CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 7 = 0 THEN left(props, length(props) - 1)
              WHEN event_id % 11 = 0 THEN replace(props, ': ', ': "x') ELSE props END AS props,
         CASE WHEN event_id % 5 = 0 THEN event_type || CAST(value AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS amount,
         value
  FROM events),
p AS (
  SELECT event_id, props IS NOT NULL AS has_props, amount IS NOT NULL AS has_amount,
         CASE WHEN json_valid(props) THEN TRY_CAST(json_extract_string(CASE WHEN json_valid(props) THEN props ELSE '{}' END, '$.k') AS BIGINT) END AS k,
         CASE WHEN event_id % 5 <> 0 THEN value END AS amount_value
  FROM d)
SELECT event_id,
       concat_ws(',', CASE WHEN has_props AND k IS NULL THEN 'k' END, CASE WHEN has_amount AND amount_value IS NULL THEN 'amount_value' END) AS errors,
       k, amount_value
FROM p WHERE (has_props AND k IS NULL) OR (has_amount AND amount_value IS NULL)
"""

SQL["csv_rejects"] = """
WITH b AS (SELECT p_partkey AS k, p_size, p_brand, repeat(chr(34), 2) || 'x' || repeat(chr(34), 2) || chr(34) AS x FROM part),
l AS (
  SELECT CASE WHEN k % 7 = 0 THEN 'too few' WHEN k % 11 = 0 THEN 'too many' ELSE 'read' END AS kind,
         CASE WHEN k % 7 = 0 THEN k || ',' || chr(34) || p_brand || ', ' || x
              WHEN k % 11 = 0 THEN k || ',' || chr(34) || p_brand || ', ' || x || ',' || p_size || ',more'
              ELSE k || '|' || p_brand || ', ' || chr(34) || 'x' || chr(34) || '|' || p_size END AS text
  FROM b)
SELECT kind, count(*) AS n, min(text) AS first, max(text) AS last FROM l GROUP BY kind
"""

SQL["distinct_sketch_levels"] = """
SELECT CASE WHEN grouping(s_nationkey, l_returnflag) = 0 THEN 0 WHEN grouping(s_nationkey, l_returnflag) = 1 THEN 1 ELSE 2 END AS level,
       s_nationkey, l_returnflag, count(DISTINCT l_partkey) AS n_exact, TRUE AS within_bound
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
GROUP BY GROUPING SETS ((s_nationkey, l_returnflag), (s_nationkey), ())
"""

SQL["quantile_sketches"] = """
WITH v AS (SELECT event_type, value FROM events UNION ALL SELECT '(all)', value FROM events)
SELECT event_type, p, count(value) AS n, TRUE AS within_bound
FROM v, (VALUES (0.5::DOUBLE), (0.9::DOUBLE)) AS a(p) GROUP BY event_type, p
"""

SQL["raw_files"] = """
SELECT doc_id % 16 AS part, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes, count(*) AS n_docs, TRUE AS hashed
FROM documents WHERE text IS NOT NULL GROUP BY doc_id % 16
"""

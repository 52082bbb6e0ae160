"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each statement reads the pre-registered views (region nation customer
supplier part orders lineitem events ...) and aliases every column with the
same name the Spark query uses. Integer aggregates are cast to the Spark
result type (BIGINT / INTEGER).
"""

from __future__ import annotations

import math


# --- Gold over the test tables -------------------------------------------

_SILVER = """
pop AS (
  SELECT n.n_name AS kabupaten_kota, CAST(count(*) AS BIGINT) AS populasi
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY n.n_name),
bur AS (
  SELECT n.n_name AS kabupaten_kota,
         CAST(count(*) FILTER (WHERE o.o_orderpriority = '1-URGENT') AS BIGINT) AS total_stunting,
         CAST(count(*) FILTER (WHERE o.o_orderpriority = '2-HIGH') AS BIGINT) AS total_gizi_buruk,
         CAST(count(*) FILTER (WHERE o.o_orderpriority = '3-MEDIUM') AS BIGINT) AS total_gizi_kurang,
         CAST(count(*) FILTER (WHERE o.o_orderpriority = '5-LOW') AS BIGINT) AS total_underweight
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY n.n_name),
sup AS (
  SELECT n.n_name AS kabupaten_kota,
         CAST(count(*) FILTER (WHERE s.s_acctbal >= 5000) AS BIGINT) AS jumlah_rs_umum,
         CAST(count(*) FILTER (WHERE s.s_acctbal < 5000) AS BIGINT) AS jumlah_rs_khusus
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY n.n_name),
posy AS (
  SELECT n.n_name AS kabupaten_kota, CAST(count(DISTINCT l.l_partkey) AS BIGINT) AS jumlah_posyandu
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY n.n_name),
fac AS (
  SELECT sup.kabupaten_kota, jumlah_rs_umum, jumlah_rs_khusus,
         COALESCE(posy.jumlah_posyandu, 0) AS jumlah_posyandu
  FROM sup LEFT JOIN posy ON sup.kabupaten_kota = posy.kabupaten_kota),
nak AS (
  SELECT n.n_name AS kabupaten_kota, CAST(count(*) AS BIGINT) AS total_nakes
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY n.n_name)
"""

_MASTER = """
m0 AS (
  SELECT p.kabupaten_kota, p.populasi,
         COALESCE(b.total_stunting, 0) AS total_stunting,
         COALESCE(b.total_gizi_buruk, 0) AS total_gizi_buruk,
         COALESCE(b.total_gizi_kurang, 0) AS total_gizi_kurang,
         COALESCE(b.total_underweight, 0) AS total_underweight,
         COALESCE(f.jumlah_rs_umum, 0) AS jumlah_rs_umum,
         COALESCE(f.jumlah_rs_khusus, 0) AS jumlah_rs_khusus,
         COALESCE(f.jumlah_posyandu, 0) AS jumlah_posyandu,
         COALESCE(w.total_nakes, 0) AS total_nakes
  FROM pop p
  LEFT JOIN bur b ON p.kabupaten_kota = b.kabupaten_kota
  LEFT JOIN fac f ON p.kabupaten_kota = f.kabupaten_kota
  LEFT JOIN nak w ON p.kabupaten_kota = w.kabupaten_kota),
m AS (
  SELECT *, total_stunting + total_gizi_buruk + total_gizi_kurang + total_underweight
            AS total_balita_gizi_buruk
  FROM m0),
ind AS (
  SELECT *,
    CASE WHEN total_balita_gizi_buruk > 0
         THEN (jumlah_rs_umum + jumlah_rs_khusus) / (total_balita_gizi_buruk / 10000) END
         AS rasio_faskes_per_10k_balita,
    CASE WHEN populasi > 0 THEN jumlah_posyandu / (populasi / 10000) END
         AS rasio_posyandu_per_10k_populasi,
    CASE WHEN populasi > 0 THEN total_nakes / (populasi / 10000) END
         AS rasio_nakes_per_10k_populasi,
    CASE WHEN populasi > 0 THEN (total_stunting / populasi) * 100 END
         AS prevalensi_stunting_pct
  FROM m),
st AS (
  SELECT min(prevalensi_stunting_pct) AS mn0, max(prevalensi_stunting_pct) AS mx0,
         min(rasio_faskes_per_10k_balita) AS mn1, max(rasio_faskes_per_10k_balita) AS mx1,
         min(rasio_posyandu_per_10k_populasi) AS mn2, max(rasio_posyandu_per_10k_populasi) AS mx2,
         min(rasio_nakes_per_10k_populasi) AS mn3, max(rasio_nakes_per_10k_populasi) AS mx3
  FROM ind),
nrm AS (
  SELECT ind.*,
    CASE WHEN mx0 = mn0 THEN 0.0 ELSE (prevalensi_stunting_pct - mn0) / (mx0 - mn0) END AS n0,
    CASE WHEN mx1 = mn1 THEN 0.0 ELSE (rasio_faskes_per_10k_balita - mn1) / (mx1 - mn1) END AS n1,
    CASE WHEN mx2 = mn2 THEN 0.0 ELSE (rasio_posyandu_per_10k_populasi - mn2) / (mx2 - mn2) END AS n2,
    CASE WHEN mx3 = mn3 THEN 0.0 ELSE (rasio_nakes_per_10k_populasi - mn3) / (mx3 - mn3) END AS n3
  FROM ind CROSS JOIN st),
sc AS (
  SELECT *,
    n0 * 0.5 + (1.0 - n1) * 0.3 + (1.0 - n3) * 0.2 AS nrs,
    (n1 + n2 + n3) / 3.0 AS nci
  FROM nrm),
gold AS (
  SELECT kabupaten_kota, populasi, total_balita_gizi_buruk, total_stunting, total_gizi_buruk,
    total_gizi_kurang, total_underweight, jumlah_rs_umum, jumlah_rs_khusus, jumlah_posyandu,
    total_nakes,
    round(rasio_faskes_per_10k_balita, 4) AS rasio_faskes_per_10k_balita,
    round(rasio_posyandu_per_10k_populasi, 4) AS rasio_posyandu_per_10k_populasi,
    round(rasio_nakes_per_10k_populasi, 4) AS rasio_nakes_per_10k_populasi,
    round(prevalensi_stunting_pct, 2) AS prevalensi_stunting_pct,
    round(nci, 4) AS nutrition_coverage_index,
    round(nrs, 4) AS nutrition_risk_score,
    CAST(rank() OVER (ORDER BY nrs DESC NULLS LAST) AS BIGINT) AS priority_rank,
    nrs AS nrs_raw, nci AS nci_raw, n0, n1, n2, n3
  FROM sc)
"""

GOLD_CTE = "WITH " + _SILVER.strip() + ",\n" + _MASTER.strip() + "\n"

GOLD_COLS = """kabupaten_kota, populasi, total_balita_gizi_buruk, total_stunting, total_gizi_buruk,
  total_gizi_kurang, total_underweight, jumlah_rs_umum, jumlah_rs_khusus, jumlah_posyandu,
  total_nakes, rasio_faskes_per_10k_balita, rasio_posyandu_per_10k_populasi,
  rasio_nakes_per_10k_populasi, prevalensi_stunting_pct, nutrition_coverage_index,
  nutrition_risk_score, priority_rank"""


def gold_sql(select: str = GOLD_COLS, tail: str = "FROM gold") -> str:
    return f"{GOLD_CTE}SELECT {select}\n{tail}"


SQL: dict[str, str] = {}
SQL["q18_gold_region_scores"] = gold_sql()


def _canon(x: str) -> str:
    """SQL twin of functions.text.canonical_name."""
    from ..functions.text import ABBREVIATION, ISLAND_MARKER, ISLAND_NAME, NAME_PREFIXES
    s = f"regexp_replace(upper({x}), '^\\s+|\\s+$', '', 'g')"
    for tok in NAME_PREFIXES:
        s = f"regexp_replace({s}, '^{tok.replace(".", chr(92) + ".")}', '')"
    s = f"replace({s}, '{ABBREVIATION[0]}', '{ABBREVIATION[1]}')"
    s = f"(CASE WHEN contains({s}, '{ISLAND_MARKER}') THEN '{ISLAND_NAME}' ELSE {s} END)"
    return f"COALESCE(regexp_replace({s}, '^\\s+|\\s+$', '', 'g'), '')"


def _title(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


def _std(x: str) -> str:
    n = f"upper(trim({x}))"
    return (f"COALESCE(CASE {n} WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'MIDDLE EAST' THEN 'MIDEAST' "
            f"WHEN 'MACHINERY' THEN 'MACHINES' END, {n})")


SQL["q01_standardize_map"] = f"""
SELECT c.c_custkey, {_std('c.c_mktsegment')} AS segment_std, {_std('r.r_name')} AS region_std
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

SQL["q02_recode_whitelist"] = """
SELECT t AS event_type_std, count(*) AS n FROM (
  SELECT CASE WHEN upper(trim(event_type)) = 'PURCHASE' THEN 'ORDER' ELSE upper(trim(event_type)) END AS t
  FROM events) WHERE t IN ('CLICK', 'VIEW', 'ORDER', 'SIGNUP') GROUP BY t"""

SQL["q03_sentinel_filter"] = """
SELECT p_partkey, upper(trim(p_name)) AS p_name_std FROM part
WHERE upper(trim(p_name)) IS NOT NULL AND upper(trim(p_name)) NOT IN ('OLD BOLT', '')
  AND NOT starts_with(upper(trim(p_name)), 'NEW ') AND NOT starts_with(upper(trim(p_name)), 'HOT ')"""

SQL["q04_try_cast_filter"] = """
SELECT event_id, k FROM (
  SELECT event_id, CAST(trunc(TRY_CAST(CASE event_id % 5 WHEN 1 THEN k || '.0' WHEN 2 THEN k || '.5' WHEN 3 THEN '-' || k
    WHEN 4 THEN k || ' n/a' ELSE k END AS DECIMAL(38,6))) AS INTEGER) AS k
  FROM (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events))
WHERE k IS NOT NULL AND k >= 0"""

SQL["q05_placeholder_fill"] = """
SELECT p_partkey,
  COALESCE(TRY_CAST(CASE WHEN trim(regexp_extract(p_brand, '#(\\d+)$', 1)) IN ('1') THEN '0'
                         ELSE regexp_extract(p_brand, '#(\\d+)$', 1) END AS BIGINT), 0) AS brand_no,
  CAST(TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(18,4)) * 1000 AS BIGINT) AS price_milli
FROM part"""

SQL["q06_dedupe_key"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
    l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
    l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem) WHERE rn = 1"""

SQL["q07_group_sum"] = """
SELECT s.s_nationkey, l.l_returnflag, sum(l.l_quantity) AS sum_qty
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY s.s_nationkey, l.l_returnflag"""

SQL["q08_pivot_sum"] = "SELECT user_id, " + ", ".join(
    f"CAST(COALESCE(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = '{t}'), 0) AS DOUBLE) AS {t}"
    for t in ["click", "error", "purchase", "signup", "view"]) + " FROM events GROUP BY user_id"

SQL["q09_left_join_master"] = GOLD_CTE + "SELECT * FROM m0"
SQL["q10_row_sum"] = GOLD_CTE + "SELECT kabupaten_kota, total_balita_gizi_buruk FROM m"
SQL["q11_ratio_per_10k"] = GOLD_CTE + """SELECT kabupaten_kota,
  round(rasio_faskes_per_10k_balita, 4) AS rasio_faskes_per_10k_balita,
  round(rasio_posyandu_per_10k_populasi, 4) AS rasio_posyandu_per_10k_populasi,
  round(rasio_nakes_per_10k_populasi, 4) AS rasio_nakes_per_10k_populasi FROM ind"""
SQL["q12_percentage"] = GOLD_CTE + """SELECT kabupaten_kota,
  round(prevalensi_stunting_pct, 2) AS prevalensi_stunting_pct FROM ind"""
SQL["q13_minmax"] = GOLD_CTE + """SELECT kabupaten_kota, round(n0, 6) AS norm_stunting,
  round(n1, 6) AS norm_faskes, round(n2, 6) AS norm_posyandu, round(n3, 6) AS norm_nakes FROM nrm"""
SQL["q14_inverse_minmax"] = GOLD_CTE + """SELECT kabupaten_kota, round(1.0 - n1, 6) AS norm_faskes_inv,
  round(1.0 - n3, 6) AS norm_nakes_inv FROM nrm"""
SQL["q15_mean_index"] = GOLD_CTE + "SELECT kabupaten_kota, round(nci, 4) AS nutrition_coverage_index FROM sc"
SQL["q16_weighted_score"] = GOLD_CTE + "SELECT kabupaten_kota, round(nrs, 4) AS nutrition_risk_score FROM sc"
SQL["q17_priority_rank"] = GOLD_CTE + """SELECT kabupaten_kota, nutrition_risk_score, priority_rank
FROM gold ORDER BY priority_rank, kabupaten_kota LIMIT 10"""

SQL["q19_minmax_rows"] = """
WITH st AS (SELECT min(l_extendedprice) AS mn, max(l_extendedprice) AS mx FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice,
  round(CASE WHEN mx = mn THEN 0.0 ELSE (l_extendedprice - mn) / (mx - mn) END, 6) AS price_norm
FROM lineitem CROSS JOIN st"""

SQL["q20_global_rank"] = """
SELECT o_orderkey, o_totalprice,
  CAST(rank() OVER (ORDER BY o_totalprice DESC NULLS LAST) AS BIGINT) AS price_rank FROM orders"""

_CUST = """
cper AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s, max(o_totalprice) AS mx,
                count(*) AS n FROM orders GROUP BY o_custkey),
cf AS (SELECT c.c_custkey, CAST(cper.s AS DOUBLE) / cper.n AS f_avg_price, cper.mx AS f_max_price,
              CAST(cper.n AS DOUBLE) AS f_n_orders, c.c_acctbal AS f_acctbal
       FROM customer c LEFT JOIN cper ON c.c_custkey = cper.o_custkey)"""

_FEATS = ["f_avg_price", "f_max_price", "f_n_orders", "f_acctbal"]


def _fill(fn: str, default: str | None) -> str:
    meds = ", ".join(f"{fn}({f}, 0.5) AS m_{f}" for f in _FEATS)
    cols = ", ".join(
        f"COALESCE({f}, m_{f}{', ' + default if default else ''}) AS {f}" for f in _FEATS)
    return f"med AS (SELECT {meds} FROM cf), filled AS (SELECT c_custkey, {cols} FROM cf CROSS JOIN med)"


SQL["q21_median_low_fill"] = f"WITH {_CUST.strip()},\n{_fill('quantile_disc', '0.0')}\nSELECT * FROM filled"
SQL["q22_median_mid_fill"] = f"WITH {_CUST.strip()},\n{_fill('quantile_cont', None)}\nSELECT * FROM filled"

_Z = ["z_avg_price", "z_max_price", "z_n_orders", "z_acctbal"]


def _zsql(src: str, sd: str, digits: int | None = 6) -> str:
    aggs = ", ".join(f"avg({f}) AS mu_{f}, {sd}({f}) AS sd_{f}" for f in _FEATS)
    cols = []
    for f, z in zip(_FEATS, _Z):
        e = f"CASE WHEN sd_{f} IS NULL OR sd_{f} = 0 THEN 0.0 ELSE ({f} - mu_{f}) / sd_{f} END"
        cols.append(f"round({e}, {digits}) AS {z}" if digits else f"{e} AS {z}")
    return (f"zs AS (SELECT {aggs} FROM {src}), "
            f"z AS (SELECT {src}.*, {', '.join(cols)} FROM {src} CROSS JOIN zs)")


SQL["q23_scale_sample"] = f"WITH {_CUST.strip()}, {_zsql('cf', 'stddev_samp')} SELECT c_custkey, {', '.join(_Z)} FROM z"
SQL["q24_scale_pop"] = f"WITH {_CUST.strip()}, {_zsql('cf', 'stddev_pop')} SELECT c_custkey, {', '.join(_Z)} FROM z"

_CENTRES = (-1.0, 0.0, 1.0)  # every coordinate of a centre


def _dist(xs: list[str], v: float) -> str:
    return " + ".join(f"({x} - ({v})) * ({x} - ({v}))" for x in xs)


def _assign(src: str, xs: list[str]) -> str:
    d = [_dist(xs, c) for c in _CENTRES]
    return (f"dd AS (SELECT {src}.*, {d[0]} AS d0, {d[1]} AS d1, {d[2]} AS d2 FROM {src}), "
            "asg AS (SELECT dd.*, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END "
            "AS cluster_id, CASE WHEN d0 <= d1 AND d0 <= d2 THEN d0 WHEN d1 <= d2 THEN d1 ELSE d2 END AS dmin FROM dd)")


_CL_BASE = (f"WITH {_CUST.strip()},\n{_fill('quantile_disc', '0.0')},\n{_zsql('filled', 'stddev_samp', None)},\n"
            + _assign("z", _Z))
_SQ = " + ".join(f"{z} * {z}" for z in _Z)

SQL["q26_assign_fixed"] = _CL_BASE + " SELECT c_custkey, CAST(cluster_id AS INTEGER) AS cluster_id FROM asg"
SQL["q27_wsse_fixed"] = _CL_BASE + " SELECT round(sum(dmin), 6) AS wsse FROM asg"
SQL["q28_silhouette_fixed"] = _CL_BASE + f""",
cs AS (SELECT cluster_id AS c, count(*) AS n, sum({_SQ}) AS p,
              {", ".join(f"sum({z}) AS y_{z}" for z in _Z)} FROM asg GROUP BY cluster_id),
pd AS (SELECT a.c_custkey, a.cluster_id, cs.c, cs.n,
              (cs.n * ({_SQ}) + cs.p - 2.0 * ({" + ".join(f"a.{z} * cs.y_{z}" for z in _Z)})) AS tot
       FROM asg a CROSS JOIN cs),
sv AS (SELECT c_custkey,
         max(CASE WHEN c = cluster_id THEN n END) AS own_n,
         max(CASE WHEN c = cluster_id AND n > 1 THEN tot / (n - 1) END) AS a,
         min(CASE WHEN c <> cluster_id THEN tot / n END) AS b
       FROM pd GROUP BY c_custkey)
SELECT round(avg(CASE WHEN own_n <= 1 OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM sv"""
SQL["q29_label_by_mean"] = _CL_BASE + """,
mm AS (SELECT cluster_id, avg(f_avg_price) AS mean FROM asg GROUP BY cluster_id),
oo AS (SELECT cluster_id, least(row_number() OVER (ORDER BY mean ASC NULLS FIRST, cluster_id) - 1, 2) AS o FROM mm)
SELECT a.c_custkey, CAST(a.cluster_id AS INTEGER) AS cluster_id,
  CASE o WHEN 0 THEN 'Risiko Rendah' WHEN 1 THEN 'Risiko Sedang' ELSE 'Risiko Tinggi' END AS cluster_label
FROM asg a JOIN oo ON a.cluster_id = oo.cluster_id"""

_NET = "net AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1.0 - l_discount) AS score FROM lineitem)"
SQL["q32_quantile_flag"] = f"""WITH {_NET}, ct AS (SELECT quantile_cont(score, 0.15) AS cut FROM net)
SELECT l_orderkey, l_linenumber, l_partkey, COALESCE(score < cut, false) AS is_anomaly FROM net CROSS JOIN ct"""
SQL["q33_contamination_sweep"] = f"""WITH {_NET},
qs AS (SELECT quantile_cont(score, [0.10, 0.15, 0.20]) AS cuts FROM net),
ct AS (SELECT CAST(unnest([0.10, 0.15, 0.20]) AS DOUBLE) AS contamination, unnest(cuts) AS cut FROM qs)
SELECT ct.contamination, net.l_orderkey, net.l_linenumber, net.l_partkey FROM ct JOIN net ON net.score < ct.cut"""

_GX = ["prevalensi_stunting_pct", "rasio_faskes_per_10k_balita", "rasio_posyandu_per_10k_populasi",
       "rasio_nakes_per_10k_populasi", "nutrition_coverage_index"]
_I = range(len(_GX))
_GF = GOLD_CTE.rstrip() + f""",
gf AS (SELECT kabupaten_kota, {", ".join(f"{x} AS x{i}" for i, x in enumerate(_GX))}, nutrition_risk_score FROM gold),
gm AS (SELECT {", ".join(f"quantile_disc(x{i}, 0.5) AS m{i}" for i in _I)} FROM gf),
gfl AS (SELECT kabupaten_kota, nutrition_risk_score,
          {", ".join(f"COALESCE(x{i}, m{i}, 0.0) AS x{i}" for i in _I)} FROM gf CROSS JOIN gm),
gzs AS (SELECT {", ".join(f"avg(x{i}) AS mu{i}, stddev_samp(x{i}) AS sd{i}" for i in _I)} FROM gfl),
gz AS (SELECT gfl.*,
         {", ".join(f"CASE WHEN sd{i} IS NULL OR sd{i} = 0 THEN 0.0 ELSE (x{i} - mu{i}) / sd{i} END AS z{i}" for i in _I)}
       FROM gfl CROSS JOIN gzs),
""" + _assign("gz", [f"z{i}" for i in _I]) + """,
gmean AS (SELECT cluster_id, avg(nutrition_risk_score) AS mean FROM asg GROUP BY cluster_id),
gord AS (SELECT cluster_id, least(row_number() OVER (ORDER BY mean ASC NULLS FIRST, cluster_id) - 1, 2) AS o FROM gmean),
glab AS (SELECT a.kabupaten_kota, CAST(a.cluster_id AS INTEGER) AS cluster_id,
           CASE o WHEN 0 THEN 'Risiko Rendah' WHEN 1 THEN 'Risiko Sedang' ELSE 'Risiko Tinggi' END AS cluster_label,
           round(-dmin, 6) AS anomaly_score
         FROM asg a JOIN gord ON a.cluster_id = gord.cluster_id),
gcut AS (SELECT quantile_cont(anomaly_score, 0.15) AS cut FROM glab),
gmod AS (SELECT glab.*, COALESCE(anomaly_score < cut, false) AS is_anomaly FROM glab CROSS JOIN gcut),
final AS (SELECT g.kabupaten_kota, g.populasi, g.total_balita_gizi_buruk, g.total_stunting, g.total_gizi_buruk,
    g.total_gizi_kurang, g.total_underweight, g.jumlah_rs_umum, g.jumlah_rs_khusus, g.jumlah_posyandu,
    g.total_nakes, g.rasio_faskes_per_10k_balita, g.rasio_posyandu_per_10k_populasi,
    g.rasio_nakes_per_10k_populasi, g.prevalensi_stunting_pct, g.nutrition_coverage_index,
    g.nutrition_risk_score, g.priority_rank,
    (SELECT strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') FROM orders) AS last_updated,
    m.cluster_id, m.cluster_label, m.is_anomaly, m.anomaly_score
  FROM gold g LEFT JOIN gmod m ON g.kabupaten_kota = m.kabupaten_kota)
"""

SQL["q34_gold_final"] = _GF + "SELECT * FROM final"
SQL["q35_summary"] = _GF + """SELECT count(*) AS n_rows, round(avg(nutrition_risk_score), 3) AS avg_nutrition_risk_score,
  CAST(sum(jumlah_posyandu) AS BIGINT) AS sum_jumlah_posyandu, CAST(sum(total_nakes) AS BIGINT) AS sum_total_nakes,
  count(*) FILTER (WHERE is_anomaly) AS n_is_anomaly FROM final"""
_ARGMAX = """hr AS (SELECT nutrition_risk_score AS value, * FROM final WHERE nutrition_risk_score IS NOT NULL
            ORDER BY nutrition_risk_score DESC, priority_rank, kabupaten_kota LIMIT 1),
bc AS (SELECT nutrition_coverage_index AS value, * FROM final WHERE nutrition_coverage_index IS NOT NULL
       ORDER BY nutrition_coverage_index DESC, priority_rank, kabupaten_kota LIMIT 1)
"""
SQL["q36_argmax"] = _GF + "," + _ARGMAX + """SELECT 'highest_risk' AS metric, * FROM hr
UNION ALL SELECT 'best_coverage' AS metric, * FROM bc"""
SQL["q37_insights"] = _GF + "," + _ARGMAX + """SELECT 'Prioritas Intervensi' AS title,
  kabupaten_kota || ' memiliki Nutrition Risk Score tertinggi (' || CAST(value AS VARCHAR) || ')' AS body FROM hr
UNION ALL SELECT 'Coverage Tertinggi' AS title, kabupaten_kota AS body FROM bc
UNION ALL SELECT 'Audit Distribusi' AS title,
  'Perbedaan rasio fasilitas dan tenaga kesehatan menunjukkan ketimpangan.' AS body"""
SQL["q38_display"] = _GF + """SELECT kabupaten_kota, priority_rank,
  CASE WHEN priority_rank = 1 THEN '1' WHEN priority_rank <= 3 THEN 'top' ELSE 'mid' END AS rank_tier,
  least(nutrition_risk_score * 100.0, 100.0) AS risk_bar_pct,
  CAST(round_even(nutrition_coverage_index * 100.0, 0) AS INTEGER) AS coverage_pct,
  CASE WHEN is_anomaly THEN 'Ya' WHEN NOT is_anomaly THEN 'Tidak' END AS anomaly_label,
  jumlah_posyandu, cluster_label FROM final"""

SQL["q39_name_canonical"] = GOLD_CTE.rstrip() + f""",
nm AS (SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'KOTA ADM. ' WHEN 2 THEN ' kabupaten '
         WHEN 3 THEN 'Kab. Adm. ' WHEN 4 THEN 'ADM. ' END || n_name AS name FROM nation),
b AS (SELECT n_nationkey, name, {_canon('name')} AS wilayah_key FROM nm),
s AS (SELECT {_canon('kabupaten_kota')} AS wilayah_key, nutrition_risk_score, priority_rank FROM gold)
SELECT b.n_nationkey, b.wilayah_key, {_title('b.name')} AS label, s.nutrition_risk_score, s.priority_rank
FROM b LEFT JOIN s ON b.wilayah_key = s.wilayah_key"""

_FIELDS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "n_nationkey", "n_name",
           "n_regionkey", "r_regionkey", "r_name"]
SQL["q40_field_detect"] = """WITH attrs AS (SELECT * FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
lv AS (""" + " UNION ALL ".join(
    f"SELECT DISTINCT '{f}' AS field, {_canon(f"CAST({f} AS VARCHAR)")} AS value FROM attrs" for f in _FIELDS) + f"""),
ref AS (SELECT DISTINCT {_canon('n_name')} AS value FROM nation),
fl AS (SELECT * FROM (VALUES {", ".join(f"('{f}', {i})" for i, f in enumerate(_FIELDS))}) t(field, pos)),
sc AS (SELECT fl.field, fl.pos, count(ref.value) AS score FROM fl
       LEFT JOIN lv ON lv.field = fl.field LEFT JOIN ref ON lv.value = ref.value GROUP BY fl.field, fl.pos)
SELECT field, score FROM sc ORDER BY score DESC, pos ASC LIMIT 1"""

SQL["q41_bounds"] = """WITH u AS (SELECT CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(len(embedding))) AS i,
  len(embedding) AS n FROM embeddings WHERE len(embedding) >= 2)
SELECT min(v) FILTER (i % 2 = 0) AS minx, min(v) FILTER (i % 2 = 1) AS miny,
  max(v) FILTER (i % 2 = 0) AS maxx, max(v) FILTER (i % 2 = 1) AS maxy FROM u WHERE i < n // 2 * 2"""

SQL["q42_sanitize"] = """SELECT event_id, CASE WHEN isnan(x) OR isinf(x) THEN NULL ELSE x END AS x_clean FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE WHEN event_type = 'signup' THEN 'inf'::DOUBLE
    WHEN event_type = 'view' THEN -'inf'::DOUBLE ELSE value END AS x FROM events)"""

SQL["q43_stream_ingest"] = """SELECT event_id, ts, user_id, event_type, value, props, 'csv_fallback' AS source,
  '2024-01-31T00:00:00' AS ingested_at, '20240131_000000' AS ingested_batch FROM events"""
SQL["q44_json_roundtrip"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
SQL["q45_topic_route"] = "SELECT event_type || '-raw' AS topic, count(*) AS n_messages FROM events GROUP BY 1"
SQL["q46_partitioned_read"] = """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
WHERE o_orderpriority = '1-URGENT'"""
SQL["q47_stage_counts"] = """SELECT 'lineitem_dedupe' AS stage, (SELECT count(*) FROM lineitem) AS rows_in,
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS rows_out
UNION ALL SELECT 'orders_positive', (SELECT count(*) FROM orders),
  (SELECT count(*) FROM orders WHERE o_totalprice > 0)"""
SQL["q48_iso_timestamp"] = """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate_iso FROM orders"""
SQL["q49_json_export"] = gold_sql()

SQL["q51_map_layer"] = _GF + """SELECT kabupaten_kota,
  COALESCE(CASE cluster_label WHEN 'Risiko Rendah' THEN '#2ecc71' WHEN 'Risiko Sedang' THEN '#f39c12'
                WHEN 'Risiko Tinggi' THEN '#e74c3c' END, 'lightgrey') AS fill_color,
  round(nutrition_risk_score, 4) AS tooltip_nrs, round(nutrition_coverage_index, 4) AS tooltip_nci,
  round(prevalensi_stunting_pct, 2) AS tooltip_prevalence, priority_rank, cluster_label,
  CASE WHEN is_anomaly THEN 'Ya' WHEN NOT is_anomaly THEN 'Tidak' END AS tooltip_anomaly
FROM final"""


def _c(n: int) -> str:
    """Average path length of an unsuccessful search over n points."""
    if n <= 2:
        return str(float(n == 2))
    return f"(2.0 * (ln({n - 1}.0) + 0.5772156649015329) - 2.0 * {n - 1}.0 / {n}.0)"


SQL["q52_forest_score_fixed"] = f"""
WITH f AS (SELECT *, l_extendedprice * (1.0 - l_discount) AS net_price FROM lineitem),
p AS (SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_extendedprice < 30000.5 THEN CASE WHEN l_quantity < 10.5 THEN 2.0 + {_c(40)} ELSE 2.0 + {_c(100)} END
         ELSE 1.0 + {_c(116)} END AS p0,
    CASE WHEN net_price < 20000.5 THEN 1.0 + {_c(2)}
         ELSE CASE WHEN l_discount < 0.055 THEN 2.0 + {_c(1)} ELSE 2.0 + {_c(253)} END END AS p1 FROM f),
s AS (SELECT l_orderkey, l_linenumber, l_partkey,
    round(-pow(2.0, -((p0 + p1) / 2.0) / {_c(256)}), 6) AS anomaly_score FROM p),
ct AS (SELECT quantile_cont(anomaly_score, 0.15) AS cut FROM s)
SELECT s.*, COALESCE(anomaly_score < cut, false) AS is_anomaly FROM s CROSS JOIN ct"""
SQL["q53_anomaly_listing"] = _GF + """SELECT kabupaten_kota, anomaly_score, is_anomaly,
  rank() OVER (ORDER BY anomaly_score NULLS LAST) AS position FROM final"""

SQL["q54_boundary_layer"] = _GF.rstrip() + f""",
nm AS (SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'KOTA ADM. ' WHEN 2 THEN ' kabupaten '
         WHEN 3 THEN 'Kab. Adm. ' WHEN 4 THEN 'ADM. ' END || n_name AS name FROM nation),
bx AS (SELECT s_nationkey, CAST(min(s_suppkey) AS DOUBLE) AS minx, CAST(min(s_acctbal) AS DOUBLE) AS miny,
         CAST(max(s_suppkey) AS DOUBLE) AS maxx, CAST(max(s_acctbal) AS DOUBLE) AS maxy FROM supplier GROUP BY s_nationkey),
b AS (SELECT name, {_canon('name')} AS wilayah_key, minx, miny, maxx, maxy FROM nm LEFT JOIN bx ON n_nationkey = s_nationkey),
al AS (SELECT min(minx) AS map_minx, min(miny) AS map_miny, max(maxx) AS map_maxx, max(maxy) AS map_maxy FROM b),
ml AS ({SQL["q51_map_layer"][len(_GF):]})
SELECT b.wilayah_key, 'name' AS name_field, {_title('b.name')} AS label, COALESCE(ml.fill_color, 'lightgrey') AS fill_color,
  ml.tooltip_nrs, ml.cluster_label, ml.tooltip_anomaly, ml.tooltip_prevalence, ml.priority_rank,
  b.minx, b.miny, b.maxx, b.maxy, al.*
FROM b CROSS JOIN al LEFT JOIN ml ON {_canon('ml.kabupaten_kota')} = b.wilayah_key"""


# --- isolation forest -----------------------------------------------------

def _hex(h: str, start: int, digits: int) -> str:
    return f"CAST('0x' || substr({h}, {start}, {digits}) AS BIGINT)"


def _path(size: str) -> str:
    return (f"CASE WHEN {size} <= 1 THEN 0.0 WHEN {size} = 2 THEN 1.0 "
            f"ELSE 2.0 * (ln({size} - 1.0) + 0.5772156649015329) - 2.0 * ({size} - 1.0) / {size} END")


def _forest(rows: str, feats: list[str], ids: list[str], name: list[str], psi: int, height: int,
            fitted: str = "true", scored: str = "true", trees: int = 100, seed: int = 42) -> str:
    """Sampling, growing and walking of the forest as CTEs: rows of ``rows``
    (ids, names, features without NULL) that are ``fitted`` give the trees,
    those ``scored`` their scores (``f_sc``: ids, anomaly_score) and the cut
    at 15 % (``f_ct``)."""
    zs = [f"z{i}" for i in range(len(feats))]
    z = ", ".join(zs)
    parts = [f"""
f_mo AS (SELECT count(*) AS n, {", ".join(f"avg({x}) AS mu{i}, stddev_pop({x}) AS sd{i}" for i, x in enumerate(feats))}
    FROM {rows} WHERE {fitted}),
f_x AS MATERIALIZED (SELECT {", ".join(ids)}, least(n, {psi}) AS psi, n, row_number() OVER () AS rid,
    concat_ws('|', {", ".join(name)}) AS name,
    {", ".join(f"CASE WHEN sd{i} = 0 THEN 0.0 ELSE ({c} - mu{i}) / sd{i} END AS z{i}" for i, c in enumerate(feats))}
    FROM {rows} CROSS JOIN f_mo),
f_pairs AS (SELECT {z}, name, psi, unnest(range(least({trees}, CAST(ceil(4.0 * {trees} * psi / n) AS BIGINT)))) AS j
    FROM f_x WHERE {fitted}),
f_drawn AS (SELECT {z}, psi, ({_hex(f"md5('{seed}|0|' || name)", 1, 8)} + j) % {trees} AS tree,
    {_hex(f"md5('{seed}|' || j || '|' || name)", 9, 13)} AS u FROM f_pairs),
f_v0 AS (SELECT tree, {z}, CAST(1 AS BIGINT) AS node FROM f_drawn
    QUALIFY row_number() OVER (PARTITION BY tree ORDER BY u, {z}) <= psi)"""]
    value = "CASE s.i " + " ".join(f"WHEN {i} THEN z{i}" for i in range(len(zs))) + " END"
    for d in range(height + 1):
        ends = ", ".join(f"min({c}) OVER w AS lo{i}, max({c}) OVER w AS hi{i}" for i, c in enumerate(zs))
        each = ", ".join(f"{{'i': {i}, 'lo': lo{i}, 'hi': hi{i}}}" for i in range(len(zs)))
        pick = (f"us[{_hex('h', 1, 8)} % greatest(len(us), 1) + 1]" if d < height
                else "CAST(NULL AS STRUCT(i INTEGER, lo DOUBLE, hi DOUBLE))")
        parts.append(f"""
f_a{d} AS (SELECT *, count(*) OVER w AS size, {ends}, md5('{seed}|' || tree || '|' || node) AS h FROM f_v{d}
    WINDOW w AS (PARTITION BY tree, node)),
f_b{d} AS (SELECT *, list_filter([{each}], lambda e: e.hi > e.lo) AS us FROM f_a{d}),
f_c{d} AS (SELECT *, {pick} AS s FROM f_b{d}),
f_e{d} AS MATERIALIZED (SELECT *, CASE WHEN cut0 <= s.lo THEN s.hi ELSE cut0 END AS cut
    FROM (SELECT *, s.lo + {_hex('h', 9, 13)} / 4503599627370496.0 * (s.hi - s.lo) AS cut0 FROM f_c{d})),
f_n{d} AS MATERIALIZED (SELECT DISTINCT tree, node, s.i AS f, cut, size FROM f_e{d}),
f_v{d + 1} AS (SELECT tree, {z}, 2 * node + CASE WHEN {value} < cut THEN 0 ELSE 1 END AS node FROM f_e{d} WHERE s IS NOT NULL)""")
    walk = "CASE f " + " ".join(f"WHEN {i} THEN z{i}" for i in range(len(zs))) + " END"
    parts.append(f"""
f_w0 AS (SELECT rid, {z}, t AS tree, CAST(1 AS BIGINT) AS node FROM f_x, range({trees}) AS r(t) WHERE {scored})""")
    for d in range(height + 1):
        parts.append(f"""
f_j{d} AS MATERIALIZED (SELECT rid, {z}, tree, node, f, cut, {d} + {_path("size")} AS path FROM f_w{d} JOIN f_n{d} USING (tree, node)),
f_p{d} AS (SELECT rid, sum(path) AS path FROM f_j{d} WHERE f IS NULL GROUP BY rid),
f_w{d + 1} AS (SELECT rid, {z}, tree, 2 * node + CASE WHEN {walk} < cut THEN 0 ELSE 1 END AS node FROM f_j{d} WHERE f IS NOT NULL)""")
    paths = " UNION ALL ".join(f"SELECT * FROM f_p{d}" for d in range(height + 1))
    parts.append(f"""
f_sum AS (SELECT rid, sum(path) AS path FROM ({paths}) GROUP BY rid),
f_sc AS (SELECT {", ".join(ids)}, round(-pow(2.0, -(path / {trees}) / ({_path("psi")})), 6) AS anomaly_score FROM f_x JOIN f_sum USING (rid)),
f_ct AS (SELECT quantile_cont(anomaly_score, 0.15) AS cut FROM f_sc)""")
    return ",".join(parts)


_LI = """WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
    l_extendedprice * (1.0 - l_discount) AS net_price, CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents FROM lineitem),"""
_LI_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _lineitem_forest(fitted: str, scored: str) -> str:
    return (_LI + _forest("li", ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net_price"], _LI_IDS,
                          [*_LI_IDS, "price_cents"], 256, 8, fitted, scored)
            + " SELECT f_sc.*, COALESCE(anomaly_score < cut, false) AS is_anomaly FROM f_sc CROSS JOIN f_ct")


SQL["q31_isolation_forest"] = _lineitem_forest("true", "true")
SQL["q55_forest_reload"] = _lineitem_forest("l_orderkey % 2 = 0", "l_orderkey % 2 = 1")


# --- K-Means ----------------------------------------------------------------

def _kmeans(base: str, key: str, zs: list[str], ks: list[int], steps: int = 10) -> str:
    """Farthest-first starts and Lloyd steps over the rows of ``base``: the
    centres of k after the last step are the rows of ``c{k}`` (i, z..)."""
    z = ", ".join(zs)

    def dist(a: str, b: str) -> str:
        return " + ".join(f"({a}.{x} - {b}.{x}) * ({a}.{x} - {b}.{x})" for x in zs)

    parts = [f"f1 AS MATERIALIZED (SELECT 0 AS i, {z} FROM (SELECT b.*, {' + '.join(f'{x} * {x}' for x in zs)} AS d FROM {base} b) "
             f"ORDER BY d DESC, {key} LIMIT 1)"]
    for j in range(2, max(ks) + 1):
        parts.append(f"f{j} AS MATERIALIZED (SELECT * FROM f{j - 1} UNION ALL (SELECT {j - 1} AS i, {z} FROM ("
                     f"SELECT b.{key}, {', '.join(f'b.{x}' for x in zs)}, min({dist('b', 'f')}) AS d FROM {base} b CROSS JOIN f{j - 1} f "
                     f"GROUP BY ALL) ORDER BY d DESC, {key} LIMIT 1))")
    for k in ks:
        at = f"f{k}"
        for t in range(steps):
            to = f"c{k}_{t}" if t < steps - 1 else f"c{k}"
            parts.append(f"""
{to} AS MATERIALIZED (SELECT o.i, {", ".join(f"coalesce(n.{x}, o.{x}) AS {x}" for x in zs)} FROM {at} o LEFT JOIN (
  SELECT i, {", ".join(f"sum({x}) / count(*) AS {x}" for x in zs)} FROM (
    SELECT {", ".join(f"b.{x}" for x in zs)}, c.i FROM {base} b CROSS JOIN {at} c
    QUALIFY row_number() OVER (PARTITION BY b.{key} ORDER BY {dist("b", "c")}, c.i) = 1) GROUP BY i) n USING (i))""")
            at = to
        parts.append(f"""
a{k} AS MATERIALIZED (SELECT b.*, c.i AS cluster_id, {dist("b", "c")} AS dmin FROM {base} b CROSS JOIN c{k} c
  QUALIFY row_number() OVER (PARTITION BY b.{key} ORDER BY {dist("b", "c")}, c.i) = 1)""")
    return ",".join(parts)


def _silhouette(asg: str, key: str, zs: list[str], name: str) -> str:
    sq = " + ".join(f"{x} * {x}" for x in zs)
    asq = " + ".join(f"a.{x} * a.{x}" for x in zs)
    return f"""
{name}_c AS (SELECT cluster_id AS c, count(*) AS n, sum({sq}) AS p, {", ".join(f"sum({x}) AS y_{x}" for x in zs)} FROM {asg} GROUP BY 1),
{name}_t AS (SELECT a.{key}, a.cluster_id, s.c, s.n, s.n * ({asq}) + s.p - 2.0 * ({" + ".join(f"a.{x} * s.y_{x}" for x in zs)}) AS tot
  FROM {asg} a CROSS JOIN {name}_c s),
{name}_v AS (SELECT {key}, max(CASE WHEN c = cluster_id AND n > 1 THEN tot / (n - 1) END) AS a,
  min(CASE WHEN c <> cluster_id THEN tot / n END) AS b FROM {name}_t GROUP BY 1),
{name} AS (SELECT avg(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM {name}_v)"""


_CZ = (f"WITH {_CUST.strip()},\n{_fill('quantile_disc', '0.0')},\n{_zsql('filled', 'stddev_samp', None)},\n")
SQL["q25_kmeans_fit"] = _CZ + _kmeans("z", "c_custkey", _Z, [3]) + """,
mm AS (SELECT cluster_id, avg(cf.f_avg_price) AS mean FROM a3 JOIN cf USING (c_custkey) GROUP BY cluster_id),
oo AS (SELECT cluster_id, least(row_number() OVER (ORDER BY mean ASC NULLS FIRST, cluster_id) - 1, 2) AS o FROM mm)
SELECT a.c_custkey, CAST(a.cluster_id AS INTEGER) AS cluster_id,
  CASE o WHEN 0 THEN 'Risiko Rendah' WHEN 1 THEN 'Risiko Sedang' ELSE 'Risiko Tinggi' END AS cluster_label
FROM a3 a JOIN oo ON a.cluster_id = oo.cluster_id"""
SQL["q30_k_sweep"] = (_CZ + _kmeans("z", "c_custkey", _Z, [2, 3, 4, 5]) + ","
                      + ",".join(_silhouette(f"a{k}", "c_custkey", _Z, f"s{k}") for k in (2, 3, 4, 5)) + "\n"
                      + " UNION ALL ".join(f"SELECT {k} AS k, (SELECT round(sum(dmin), 6) FROM a{k}) AS wsse, "
                                           f"(SELECT round(silhouette, 6) FROM s{k}) AS silhouette" for k in (2, 3, 4, 5)))

SQL["q56_replace_parts"] = """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
WHERE CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice >= 100000 WHEN '5-LOW' THEN o_totalprice >= 200000
  WHEN '2-HIGH' THEN true WHEN '3-MEDIUM' THEN true WHEN '4-NOT SPECIFIED' THEN true ELSE false END"""
SQL["q57_ingest_ledger"] = """SELECT event_type || '-raw' AS topic, count(*) AS n_ledger, count(*) AS n_bronze,
  count(DISTINCT event_id) AS n_events FROM events GROUP BY 1"""
SQL["q58_dead_letters"] = """SELECT event_id, CASE WHEN event_id % 10 <> 5 THEN event_type END AS event_type,
  CASE WHEN event_id % 10 <> 5 THEN value END AS value,
  CASE event_id % 10 WHEN 0 THEN 'replayed' WHEN 5 THEN 'dead' ELSE 'good' END AS state,
  CASE WHEN event_id % 10 = 5 THEN 'no object' END AS reason FROM events"""

_IFX = [*_GX[:4], "nutrition_risk_score"]
SQL["q50_gold_final_models"] = (
    _GF[:_GF.index("dd AS (")] + _kmeans("gz", "kabupaten_kota", [f"z{i}" for i in _I], [3]) + f""",
gmean AS (SELECT cluster_id, avg(nutrition_risk_score) AS mean FROM a3 GROUP BY cluster_id),
gord AS (SELECT cluster_id, least(row_number() OVER (ORDER BY mean ASC NULLS FIRST, cluster_id) - 1, 2) AS o FROM gmean),
gif AS (SELECT kabupaten_kota, {", ".join(f"COALESCE({x}, (SELECT quantile_cont({x}, 0.5) FROM gold), 0.0) AS {x}" for x in _IFX)}
  FROM gold),""" + _forest("gif", _IFX, ["kabupaten_kota"], ["kabupaten_kota"], 25, 5) + """,
gmod AS (SELECT a.kabupaten_kota, CAST(a.cluster_id AS INTEGER) AS cluster_id,
    CASE o WHEN 0 THEN 'Risiko Rendah' WHEN 1 THEN 'Risiko Sedang' ELSE 'Risiko Tinggi' END AS cluster_label,
    COALESCE(f.anomaly_score < f_ct.cut, false) AS is_anomaly, f.anomaly_score
  FROM a3 a JOIN gord USING (cluster_id) JOIN f_sc f ON f.kabupaten_kota = a.kabupaten_kota CROSS JOIN f_ct),
""" + _GF[_GF.index("final AS ("):] + "SELECT * FROM final")

SQL["q59_geojson"] = """SELECT s_suppkey, s_name, 'Polygon' AS geometry_type, CAST(s_suppkey AS DOUBLE) AS minx, s_acctbal AS miny,
  s_suppkey + 1.0 AS maxx, s_acctbal + 2.0 AS maxy FROM supplier"""
SQL["q60_ordered_table"] = """SELECT * FROM (SELECT o_orderkey, o_custkey, o_totalprice,
  row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS place FROM orders)
WHERE place <= 100 OR place BETWEEN 1001 AND 1200"""
SQL["q61_minmax_groups"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_extendedprice,
  round(CASE WHEN mx = mn THEN 0.0 ELSE (l_extendedprice - mn) / (mx - mn) END, 6) AS price_norm
FROM (SELECT *, min(l_extendedprice) OVER w AS mn, max(l_extendedprice) OVER w AS mx FROM lineitem
  WINDOW w AS (PARTITION BY l_returnflag))"""
SQL["q62_csv_messages"] = """SELECT 'customers-raw' AS topic, CAST(c_custkey AS VARCHAR) AS key, c_acctbal AS account_balance,
  c_mktsegment AS market_segment, '2024-01-31T00:00:00' AS ingested_at FROM customer"""
SQL["q63_rank_groups"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, l_quantity, l_extendedprice,
  rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC NULLS LAST) AS price_rank,
  dense_rank() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_quantity ASC NULLS LAST) AS quantity_rank
FROM lineitem"""
SQL["q64_field_detect_wide"] = """WITH wide AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey),
lv AS (SELECT DISTINCT field, value FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM wide)
  ON COLUMNS(*) INTO NAME field VALUE value)),
sc AS (SELECT field, count(*) AS score FROM lv WHERE value IN (SELECT CAST(p_partkey AS VARCHAR) FROM part) GROUP BY field)
SELECT field, score FROM sc ORDER BY score DESC,
  list_position(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'o_orderkey', 'o_custkey', 'c_custkey', 'p_partkey'], field)
LIMIT 1"""

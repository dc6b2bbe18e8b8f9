"""DuckDB statements that must return the same rows as the registered
Spark queries (``cirflow.plans.catalog``), run on the same parquet tables.

The views of ``cirflow.sources.fixtures`` are restated here as CTEs. Peak
search is written relationally (runs of equal samples via lag + running
sum, nearest strictly higher sample via correlated subqueries), an
algorithm independent of the array-lambda one it checks.
"""

from __future__ import annotations

METERS_PER_SAMPLE = 3e8 * 1.0016 * 1e-9 / 2   # stated here, not imported from the code under test

SQL: dict[str, str] = {}

D = "::DOUBLE"


def md5int(seed_expr: str, key_expr: str) -> str:
    return f"('0x' || substr(md5({seed_expr} || '|' || CAST({key_expr} AS VARCHAR)), 1, 8))::BIGINT"


FIX = {
    "wave_emb": f"""SELECT vec_id AS id, CAST(label >= 5 AS INTEGER) AS y, CAST(vec_id % 64 AS INTEGER) AS fp,
        label AS grp, list_transform(embedding, lambda x: floor(abs(CAST(x AS DOUBLE)) * 10000.0{D})) AS w
        FROM embeddings""",
    "wave_user": f"""SELECT min(event_id) AS id, CAST(user_id % 2 AS INTEGER) AS y, CAST(user_id % 40 AS INTEGER) AS fp,
        list(floor(value * 100.0{D}) ORDER BY ts, event_id) AS w FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn FROM events) GROUP BY user_id, rn // 1016""",
    "wave_flat": f"""SELECT min(event_id) AS id, CAST(user_id % 2 AS INTEGER) AS y, CAST(user_id % 40 AS INTEGER) AS fp,
        list(floor(value / 10.0{D}) ORDER BY ts, event_id) AS w FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn FROM events) GROUP BY user_id, rn // 1016""",
    "scored_wide": f"""SELECT event_id AS id, CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS y,
        least(value, 100.0{D}) / 100.0{D} AS m1, CAST((event_id * 7919) % 1000 AS DOUBLE) / 1000.0{D} AS m2,
        CAST(user_id % 21 AS DOUBLE) / 20.0{D} AS m3 FROM events""",
    "scored": """SELECT id, y, 'm1' AS model, m1 AS p FROM scored_wide UNION ALL
        SELECT id, y, 'm2' AS model, m2 AS p FROM scored_wide UNION ALL
        SELECT id, y, 'm3' AS model, m3 AS p FROM scored_wide""",
    "scored_pred": "SELECT *, CAST(p >= 0.5 AS INTEGER) AS pred FROM scored",
    "regress": f"""SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key,
        floor(l_extendedprice / 10.0{D}) AS y1, l_quantity * 200.0{D} AS p1,
        floor(l_extendedprice / 10.0{D}) + l_linenumber * 100.0{D} AS y2,
        l_quantity * 210.0{D} - 500.0{D} AS p2 FROM lineitem""",
    "scalars": f"""SELECT l_orderkey AS k, l_quantity AS a, l_tax * 100.0{D} AS b, l_discount AS c,
        l_extendedprice AS d FROM lineitem""",
    "groups": """SELECT d.doc_id, d.source, d.lang, l.quality, l.toxic FROM documents d
        LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "ranks": """SELECT p_brand || p_type AS f, CAST(count(*) AS DOUBLE) AS a, CAST(sum(p_size) AS DOUBLE) AS b
        FROM part GROUP BY p_brand || p_type""",
    "importance": """SELECT (['CIR_', 'PEAK2_', 'RANGE_'])[CAST(a AS INTEGER) % 3 + 1] || f AS Feature,
        b / sum(b) OVER () AS Importance FROM ranks""",
    "coefs": f"SELECT f AS Feature, b / a - 25.0{D} AS coef FROM ranks",
}
FIX["measurements"] = f"""SELECT id, NLOS, __source_file, cir[3] / 1000.0{D} + label AS RANGE,
        CAST(id % 40 + 8 AS DOUBLE) AS FP_IDX, cir[4] AS FP_AMP1, cir[5] AS FP_AMP2, cir[6] AS FP_AMP3,
        cir[7] AS STDEV_NOISE, cir[8] AS CIR_PWR, cir[9] AS MAX_NOISE, cir[10] + 1.0{D} AS RXPACC,
        CAST(label % 3 + 1 AS DOUBLE) AS CH, 128.0{D} AS FRAME_LEN, 1024.0{D} AS PREAM_LEN, 6800.0{D} AS BITRATE,
        64.0{D} AS PRFR, cir[11] AS SNR, log10(cir[11] + 1.0{D}) AS SNR_dB, cir
    FROM (SELECT vec_id AS id, CAST(embedding[1] > 0 AS INTEGER) AS NLOS, label,
        list_transform(embedding, lambda x: floor(abs(CAST(x AS DOUBLE)) * 10000.0{D})) AS cir,
        'part' || CAST(vec_id % 7 + 1 AS VARCHAR) AS __source_file FROM embeddings)"""
DEPS = {"scored": ["scored_wide"], "scored_pred": ["scored_wide", "scored"],
        "importance": ["ranks"], "coefs": ["ranks"]}


def with_(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """WITH clause holding the named fixture views (and their inputs) and
    any extra (name, sql) CTEs."""
    order: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({FIX[n]})" for n in order] + [f"{n} AS ({s})" for n, s in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n"


def r(expr: str, digits: int = 6) -> str:
    """Rounded, for values whose float sums depend on evaluation order."""
    return f"(round({expr}, {digits}) + 0.0)"


def e(expr: str, digits: int = 0) -> str:
    """Unrounded: exact in both engines (ratios of counts, single divisions).
    Rounding those would be harmful -- the two engines round a double that
    sits next to a decimal boundary differently."""
    return f"({expr})"


def group_split_ctes(src: str, group: str, val: float = 0.15, test: float = 0.15, seed: int = 42,
                     p: str = "gs") -> list[tuple[str, str]]:
    """(p) -> (g, split): sorted md5 shuffle of the distinct groups."""
    return [
        (f"{p}_groups", f"SELECT DISTINCT {group} AS g FROM {src}"),
        (f"{p}_sz0", f"""SELECT n, greatest(1, CAST(round_even(n * {val}{D}, 0) AS BIGINT)) AS a,
            greatest(1, CAST(round_even(n * {test}{D}, 0) AS BIGINT)) AS b FROM (SELECT count(*) AS n FROM {p}_groups)"""),
        (f"{p}_sz", f"""SELECT n, CASE WHEN a + b >= n THEN 1 ELSE a END AS nv,
            CASE WHEN a + b >= n THEN 1 ELSE b END AS nt FROM {p}_sz0"""),
        (f"{p}_rank", f"""SELECT g, row_number() OVER (ORDER BY md5('{seed}|' || CAST(g AS VARCHAR)), g) - 1 AS pos
            FROM {p}_groups"""),
        (p, f"""SELECT g, CASE WHEN pos < nv THEN 'val' WHEN pos < nv + nt THEN 'test' ELSE 'train' END AS split
            FROM {p}_rank, {p}_sz"""),
    ]


def peak_ctes(samples: str, p: str, height: str | None = None) -> list[tuple[str, str]]:
    """Local maxima and prominences over ``samples(id, pos, x[, h])``.
    Output CTE ``{p}_pm(id, pos, x, prom)``. ``height`` is an SQL condition
    on the run value ``a.x`` (may use ``a.h``)."""
    cond = f"AND ({height})" if height else ""
    return [
        (f"{p}_l", f"SELECT *, lag(x) OVER (PARTITION BY id ORDER BY pos) AS px FROM {samples}"),
        (f"{p}_r", f"""SELECT *, sum(CASE WHEN px IS NOT NULL AND x = px THEN 0 ELSE 1 END)
            OVER (PARTITION BY id ORDER BY pos) AS run FROM {p}_l"""),
        (f"{p}_runs", f"""SELECT id, run, min(pos) AS lo, max(pos) AS hi, any_value(x) AS x
            {', any_value(h) AS h' if height and 'a.h' in height else ''} FROM {p}_r GROUP BY id, run"""),
        (f"{p}_pk", f"""SELECT a.id, CAST((a.lo + a.hi) // 2 AS INTEGER) AS pos, a.x FROM {p}_runs a
            JOIN {p}_runs b ON b.id = a.id AND b.run = a.run - 1
            JOIN {p}_runs c ON c.id = a.id AND c.run = a.run + 1
            WHERE b.x < a.x AND c.x < a.x {cond}"""),
        (f"{p}_pr", f"""SELECT k.id, k.pos, k.x,
            coalesce((SELECT max(s.pos) FROM {samples} s WHERE s.id = k.id AND s.pos < k.pos AND s.x > k.x), -1) AS lb,
            coalesce((SELECT min(s.pos) FROM {samples} s WHERE s.id = k.id AND s.pos > k.pos AND s.x > k.x), 2147483647) AS rb
            FROM {p}_pk k"""),
        (f"{p}_pm", f"""SELECT k.id, k.pos, k.x, k.x - greatest(
            (SELECT min(s.x) FROM {samples} s WHERE s.id = k.id AND s.pos > k.lb AND s.pos <= k.pos),
            (SELECT min(s.x) FROM {samples} s WHERE s.id = k.id AND s.pos >= k.pos AND s.pos < k.rb)) AS prom
            FROM {p}_pr k"""),
    ]


def second_peak_ctes(src: str, start: int, length: int, gap: int, height: float, prom: float,
                     p: str = "sp") -> list[tuple[str, str]]:
    """Output CTE ``{p}(id, fp, peak2_idx, peak2_amp, peak2_found)``."""
    return [
        (f"{p}_f", f"SELECT id, fp, w[{start + 1}:{start + length}] AS focus FROM {src}"),
        (f"{p}_s", f"""SELECT id, fp, focus, len(focus) AS n,
            least(greatest(fp - {start} + {gap}, 0), len(focus) - 1) AS s FROM {p}_f"""),
        (f"{p}_x", f"""SELECT id, unnest(focus[s + 1:]) AS x, CAST(generate_subscripts(focus[s + 1:], 1) - 1 AS INTEGER) AS pos
            FROM {p}_s WHERE s < n - 1"""),
        *peak_ctes(f"{p}_x", f"{p}_k", f"a.x >= {height}{D}"),
        (f"{p}_b", f"""SELECT id, pos, x FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY prom DESC, pos) AS rn
            FROM {p}_k_pm WHERE prom >= {prom}{D}) WHERE rn = 1"""),
        (p, f"""SELECT s.id, s.fp, CAST({start} + s.s + b.pos AS DOUBLE) AS peak2_idx, b.x AS peak2_amp,
            CASE WHEN b.id IS NULL THEN 0 ELSE 1 END AS peak2_found
            FROM {p}_s s LEFT JOIN {p}_b b ON b.id = s.id"""),
    ]


FLAT = dict(start=0, length=120, gap=5, height=3.0, prom=4.0)
FLAT_STRICT = dict(FLAT, prom=20.0)

# ================================================================ 2.1 scans / sinks
SQL["scan_parts_tagged"] = """SELECT c_custkey AS key, c_acctbal AS acctbal, 'customer.csv' AS __source_file FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, 'supplier.csv' FROM supplier"""
SQL["scan_parts"] = """SELECT c_custkey AS key, c_acctbal AS acctbal FROM customer
UNION ALL SELECT s_suppkey, s_acctbal FROM supplier"""
SQL["pack_waveform"] = with_("wave_emb") + """SELECT id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos,
    unnest(w) AS x FROM wave_emb"""
_EMB_SPLIT = with_("wave_emb", extra=group_split_ctes("wave_emb", "grp"))
SQL["write_split_dataset"] = _EMB_SPLIT + """SELECT id, y, fp, grp, split FROM wave_emb JOIN gs ON gs.g = wave_emb.grp"""
SQL["read_split_dataset"] = _EMB_SPLIT + """SELECT id, y, fp, grp FROM wave_emb JOIN gs ON gs.g = wave_emb.grp
    WHERE split = 'train'"""
SQL["write_split_manifest"] = with_("groups", extra=group_split_ctes("groups", "source")) + """,
j AS (SELECT groups.*, gs.split FROM groups JOIN gs ON gs.g = groups.source)
SELECT j.source, count(*) AS n, split, CAST(42 AS BIGINT) AS random_seed, (SELECT count(*) FROM j) AS n_total,
  (SELECT count(*) FROM j WHERE split = 'train') AS n_train, (SELECT count(*) FROM j WHERE split = 'val') AS n_val,
  (SELECT count(*) FROM j WHERE split = 'test') AS n_test FROM j GROUP BY j.source, split"""
SQL["write_result_table"] = with_("ranks") + "SELECT f, a, b FROM ranks"
SQL["read_result_table"] = with_("importance") + "SELECT Feature, Importance FROM importance"
# ================================================================ 2.2 projections / filters
_CORE = ["RANGE", "FP_IDX", "FP_AMP1", "FP_AMP2", "FP_AMP3", "STDEV_NOISE", "CIR_PWR", "MAX_NOISE", "RXPACC",
         "CH", "FRAME_LEN", "PREAM_LEN", "BITRATE", "PRFR", "SNR"]
SQL["project_features"] = with_("measurements") + f"""SELECT id, {", ".join(_CORE)}, {r('SNR_dB')} AS SNR_dB,
    {r('FP_AMP1 / greatest(FP_AMP2, 1e-10::DOUBLE)')} AS FP_AMP_ratio, {r('SNR / greatest(RXPACC, 1e-10::DOUBLE)')} AS SNR_per_acc,
    {r('CIR_PWR / greatest(STDEV_NOISE, 1e-10::DOUBLE)')} AS signal_to_noise,
    {r('MAX_NOISE / greatest(STDEV_NOISE, 1e-10::DOUBLE)')} AS noise_ratio,
    {r('FP_AMP1 * FP_AMP1 + FP_AMP2 * FP_AMP2 + FP_AMP3 * FP_AMP3')} AS FP_power FROM measurements"""
SQL["cast_types"] = with_("scalars") + """SELECT CAST(a AS DOUBLE) AS a, CAST(k AS BIGINT) AS k,
    CAST(b > 0 AS INTEGER) AS flag FROM scalars"""
SQL["filter_class"] = with_("wave_emb") + "SELECT id, grp FROM wave_emb WHERE y = 1"
SQL["filter_split"] = with_("groups", extra=group_split_ctes("groups", "source")) + """SELECT doc_id, source
    FROM groups WHERE source IN (SELECT g FROM gs WHERE split = 'val')"""
SQL["drop_by_prefix"] = "SELECT o_custkey, o_totalprice FROM orders"
SQL["constant_label"] = with_("wave_emb") + "SELECT id, y AS pair_label, 1 AS path2_nlos FROM wave_emb"
SQL["threshold_predict"] = with_("scored") + "SELECT id, model, CAST(p >= 0.5 AS INTEGER) AS pred FROM scored"
SQL["rename_select"] = with_("ranks") + "SELECT f AS Feature, a AS Coefficient FROM ranks"
SQL["sample_per_class"] = with_("wave_emb") + f"""SELECT y, id, seed, view, CAST(pos AS INTEGER) AS pos, x FROM (
    SELECT y, id, seed, view, unnest(CASE WHEN view = 'focus' THEN w[17:48] ELSE w END) AS x,
        unnest(range(0, CASE WHEN view = 'focus' THEN 32 ELSE 64 END)) AS pos FROM (
      SELECT id, y, w, s.seed, s.view, row_number() OVER (PARTITION BY s.seed, s.view, y ORDER BY {md5int("CAST(s.seed AS VARCHAR)", "id")}, id) AS rn
      FROM wave_emb, (SELECT CAST(i AS INTEGER) AS seed, 'whole' AS view FROM range(42, 45) r(i) UNION ALL SELECT CAST(i AS INTEGER), 'focus' FROM range(0, 10) r(i)) s) WHERE rn = 1)"""

# ================================================================ 2.3 splits / folds / weights
SQL["group_split"] = with_("groups", extra=group_split_ctes("groups", "source")) + """SELECT doc_id, source, split
    FROM groups JOIN gs ON gs.g = groups.source"""
SQL["split_assign"] = _EMB_SPLIT + "SELECT split, count(*) AS n FROM wave_emb JOIN gs ON gs.g = wave_emb.grp GROUP BY split"
SQL["split_balance"] = _EMB_SPLIT + f"""SELECT split, n, n0, n1, {e('n0 * 100.0::DOUBLE / n')} AS pct0,
    {e('n1 * 100.0::DOUBLE / n')} AS pct1 FROM (SELECT split, count(*) AS n, count(*) FILTER (y = 0) AS n0,
    count(*) FILTER (y = 1) AS n1 FROM wave_emb JOIN gs ON gs.g = wave_emb.grp GROUP BY split)"""
SQL["class_counts"] = with_("groups") + f"""SELECT quality, n, {e('n / sum(n) OVER ()', 9)} AS share FROM
    (SELECT quality, count(*) AS n FROM groups GROUP BY quality)"""
SQL["stratified_kfold"] = with_("scored_wide") + f"""SELECT id, y, CAST((row_number() OVER (PARTITION BY y
    ORDER BY {md5int("'42'", "id")}, id) - 1) % 3 AS INTEGER) AS fold FROM scored_wide"""
SQL["kfold"] = with_("scored_wide") + f"SELECT id, CAST({md5int(chr(39) + '42' + chr(39), 'id')} % 5 AS INTEGER) AS fold FROM scored_wide"
SQL["pos_weight"] = with_("scored_wide") + f"""SELECT n0, n1, {e('n0 / greatest(n1, 1)', 9)} AS pos_weight FROM
    (SELECT count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1 FROM scored_wide)"""
SQL["balanced_weight"] = with_("scored_wide") + f"""SELECT id, s.y, {e('n / (k * nc)', 9)} AS weight FROM scored_wide s
    JOIN (SELECT y, count(*) AS nc, sum(count(*)) OVER () AS n, count(*) OVER () AS k FROM scored_wide GROUP BY y) c
    ON c.y = s.y"""

# ================================================================ 2.4 scalar functions
SQL["guarded_ratio"] = with_("scalars") + f"SELECT a, b, {e('a / greatest(b, 1e-10::DOUBLE)')} AS ratio FROM scalars"
SQL["sum_squares"] = with_("scalars") + "SELECT a, b, a * a + b * b + a * a AS ss FROM scalars"
_SP_FLAT = with_("wave_flat", extra=second_peak_ctes("wave_flat", **FLAT))
_SP_STRICT = with_("wave_flat", extra=second_peak_ctes("wave_flat", **FLAT_STRICT))
SQL["peak_gap"] = _SP_FLAT + "SELECT id, peak2_idx - fp AS gap FROM sp"
SQL["second_range"] = _SP_FLAT + f"SELECT id, {r(f'fp * 0.5{D} + (peak2_idx - fp) * {METERS_PER_SAMPLE!r}{D}', 9)} AS range2 FROM sp"
SQL["column_index_parse"] = """SELECT DISTINCT 'CIR' || CAST(pos + 730 AS VARCHAR) AS name, CAST(pos + 730 AS INTEGER) AS idx
    FROM (SELECT generate_series AS pos FROM generate_series(0, (SELECT max(len(embedding)) FROM embeddings) - 1))"""
SQL["name_category"] = with_("importance") + """SELECT Feature, CASE WHEN starts_with(Feature, 'PEAK2') THEN 'Second Path'
    WHEN starts_with(Feature, 'CIR') THEN 'CIR Waveform' ELSE 'Core Features' END AS Category FROM importance"""
SQL["monotone_clip"] = with_("regress") + """SELECT count(*) FILTER (p2 < p1) AS n_violations,
    sum(greatest(p2, p1)) AS sum_p2_clipped FROM regress"""
SQL["per_path_labels"] = with_("scored_pred") + f"""SELECT model, path1, n, {e('n / sum(n) OVER (PARTITION BY model)', 9)} AS share,
    'NLOS' AS path2 FROM (SELECT model, CASE WHEN pred = 1 THEN 'NLOS' ELSE 'LOS' END AS path1, count(*) AS n
    FROM scored_pred GROUP BY ALL)"""
SQL["wave_normalise"] = with_("wave_emb") + f"""SELECT id, {r('list_sum(list_transform(w, lambda x: x / greatest(CAST(grp + 1 AS DOUBLE), 1.0::DOUBLE)))')} AS s
    FROM wave_emb"""

# ================================================================ 2.5 waveform functions
SQL["wave_window"] = with_("wave_emb") + """SELECT id, CAST(len(w[9:40]) AS INTEGER) AS n, list_sum(w[9:40]) AS s,
    w[9] AS first, w[40] AS last FROM wave_emb"""
SQL["wave_align"] = with_("wave_emb") + """SELECT id, CAST(k AS INTEGER) AS k,
    CASE WHEN fp - 30 + k >= 0 AND fp - 30 + k < len(w) THEN w[fp - 30 + k + 1] ELSE 0.0 END AS x
    FROM wave_emb, range(0, 120) t(k)"""
SQL["wave_peak"] = with_("wave_user") + "SELECT id, list_max(w) AS peak FROM wave_user"
SQL["wave_peak_idx"] = with_("wave_user") + """SELECT id, CAST(list_position(w, list_max(w)) - 1 AS INTEGER) AS peak_idx,
    CAST(list_position(w, list_max(w)) - 1 + 730 AS INTEGER) AS peak_idx_abs FROM wave_user"""
SQL["wave_energy"] = with_("wave_emb") + "SELECT id, list_sum(list_transform(w, lambda x: x * x)) AS energy FROM wave_emb"
SQL["wave_sum"] = with_("wave_emb") + "SELECT id, list_sum(w) AS s FROM wave_emb"
_MOM = with_("wave_user", extra=[
    ("ex", "SELECT id, unnest(w) AS x FROM wave_user"),
    ("mu", "SELECT id, sum(x) / count(*) AS mu, count(*) AS n FROM ex GROUP BY id"),
    ("mom", """SELECT ex.id, sum((x - mu) * (x - mu)) / n AS m2, sum((x - mu) * (x - mu) * (x - mu)) / n AS m3,
        sum((x - mu) * (x - mu) * (x - mu) * (x - mu)) / n AS m4 FROM ex JOIN mu ON mu.id = ex.id GROUP BY ex.id, n""")])
SQL["wave_kurtosis"] = _MOM + f"SELECT id, CASE WHEN m2 > 0 THEN {r('m4 / (m2 * m2) - 3.0', 8)} END AS kurtosis FROM mom"
SQL["wave_skewness"] = _MOM + f"SELECT id, CASE WHEN m2 > 0 THEN {r('m3 / pow(m2, 1.5)', 8)} END AS skewness FROM mom"
SQL["wave_rise_time"] = with_("wave_user") + """SELECT id, CASE WHEN pk < 1e-10 THEN 0.0 ELSE
    CAST(list_position(list_transform(w, lambda x: x >= pk * 0.9), true)
       - list_position(list_transform(w, lambda x: x >= pk * 0.1), true) AS DOUBLE) END AS rise_time
    FROM (SELECT id, w, list_max(w) AS pk FROM wave_user)"""
_FLAT_SAMPLES = ("fs", "SELECT id, unnest(w) AS x, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos FROM wave_flat")
SQL["wave_local_maxima"] = with_("wave_flat", extra=[_FLAT_SAMPLES, *peak_ctes("fs", "lm", "a.x >= 3.0")]) + \
    "SELECT id, pos FROM lm_pk"
SQL["wave_prominence"] = with_("wave_flat", extra=[_FLAT_SAMPLES, *peak_ctes("fs", "lm", "a.x >= 3.0")]) + \
    "SELECT id, pos, prom AS prominence FROM lm_pm"
SQL["wave_num_peaks"] = with_("wave_user", extra=[
    ("us", """SELECT id, unnest(w) AS x, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, list_max(w) * 0.3 AS h
        FROM wave_user"""), *peak_ctes("us", "np", "a.x >= a.h")]) + """SELECT u.id, CASE WHEN list_max(u.w) < 1e-10 THEN 0.0
    ELSE CAST((SELECT count(*) FROM np_pk k WHERE k.id = u.id) AS DOUBLE) END AS num_peaks FROM wave_user u"""
SQL["second_peak"] = _SP_FLAT + "SELECT id, peak2_idx, peak2_amp, peak2_found FROM sp"
SQL["found_rate"] = _SP_STRICT + f"""SELECT count(*) AS n, CAST(sum(peak2_found) AS BIGINT) AS n_found,
    {r('avg(peak2_found) * 100.0', 9)} AS pct_found FROM sp"""
SQL["median_impute"] = _SP_STRICT + """, g AS (SELECT id, peak2_idx - fp AS gap, peak2_amp, peak2_idx FROM sp),
  m AS (SELECT quantile_cont(gap, 0.5) AS mg, quantile_cont(peak2_amp, 0.5) AS ma, quantile_cont(peak2_idx, 0.5) AS mi FROM g)
SELECT id, coalesce(gap, mg) AS gap, coalesce(peak2_amp, ma) AS peak2_amp, coalesce(peak2_idx, mi) AS peak2_idx FROM g, m"""
SQL["wave_profile"] = with_("wave_emb") + f"""SELECT y, pos, {r('avg(x)')} AS mean_amp, count(*) AS n FROM
    (SELECT y, unnest(w) AS x, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos FROM wave_emb) GROUP BY y, pos"""

# ================================================================ 2.6 joins
SQL["join_rankings"] = with_("ranks") + "SELECT a.f, a.a, b.b FROM ranks a JOIN ranks b ON b.f = a.f WHERE b.a > 10"
SQL["lookup_default_zero"] = with_("importance") + f"""SELECT t.Feature, {e('t.Importance', 9)} AS Importance,
    {e('coalesce(o.Importance * 2, 0.0)', 9)} AS other
    FROM (SELECT * FROM importance ORDER BY Importance DESC, Feature LIMIT 15) t
    LEFT JOIN importance o ON o.Feature = t.Feature AND starts_with(o.Feature, 'CIR_')"""
SQL["attach_split"] = with_("groups", extra=group_split_ctes("groups", "source")) + """SELECT l.doc_id, l.quality, gs.split
    FROM labels l JOIN groups g ON g.doc_id = l.doc_id JOIN gs ON gs.g = g.source"""
SQL["align_predictions"] = with_("scored_wide") + "SELECT id, y, m1, m2, m3 FROM scored_wide"

# ================================================================ 2.7 aggregations
_UF = with_("wave_user", extra=[("uf", """SELECT id, y, CAST(fp AS DOUBLE) AS fp, list_sum(w) AS wsum,
    list_max(w) AS peak FROM wave_user""")])
SQL["class_mean_std"] = _UF + " UNION ALL ".join(
    f"SELECT y, '{c}' AS feature, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std FROM uf GROUP BY y"
    for c in ("fp", "wsum", "peak"))
SQL["column_mean_std"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std FROM events"
    for c in ("value", "user_id"))
_SC_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
SQL["scaled_check"] = ("WITH st AS (SELECT " + ", ".join(
    f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(_SC_COLS)) + " FROM lineitem),\n"
    "sc AS (SELECT " + ", ".join(f"({c} - m{i}) / s{i} AS z{i}" for i, c in enumerate(_SC_COLS))
    + " FROM lineitem, st)\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'avg(z{i})')} AS mean, {r(f'stddev_pop(z{i})')} AS std FROM sc"
        for i, c in enumerate(_SC_COLS)))
SQL["min_max"] = with_("regress") + """SELECT 'y1' AS feature, min(y1) AS min, max(y1) AS max FROM regress
    UNION ALL SELECT 'y2', min(y2), max(y2) FROM regress"""
SQL["label_correlation"] = _UF + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'corr({c}, CAST(y AS DOUBLE))')} AS corr FROM uf" for c in ("fp", "wsum", "peak"))


def hist_sql(data: str, bins: int, by: str | None, density: bool) -> list[tuple[str, str]]:
    g = f"{by}, " if by else ""
    on = f"ON h_rg.{by} = {data}.{by}" if by else "ON true"
    grp = f"GROUP BY {by}" if by else ""
    dens = f", {r(f'count(*) / (n * ((hi_ - lo_) / {bins}))')} AS density" if density else ""
    return [
        ("h_rg", f"""SELECT {g}count(*) AS n, CASE WHEN max(x) > min(x) THEN min(x) ELSE min(x) - 0.5 END AS lo_,
            CASE WHEN max(x) > min(x) THEN max(x) ELSE max(x) + 0.5 END AS hi_ FROM {data} {grp}"""),
        ("h_b", f"""SELECT {(data + '.' + by + ', ') if by else ''}CAST(least(floor((x - lo_) * {bins} / (hi_ - lo_)), {bins - 1}) AS INTEGER) AS bin,
            lo_, hi_, n FROM {data} JOIN h_rg {on}"""),
        ("h", f"""SELECT {g}bin, {r(f'lo_ + bin * (hi_ - lo_) / {bins}')} AS lo, {r(f'lo_ + (bin + 1) * (hi_ - lo_) / {bins}')} AS hi,
            count(*) AS n{dens} FROM h_b GROUP BY {g}bin, lo_, hi_, n"""),
    ]


SQL["class_histogram"] = with_("scored_wide", extra=[
    ("hd", "SELECT s.y AS y, e.value AS x FROM scored_wide s JOIN events e ON e.event_id = s.id WHERE e.value IS NOT NULL"),
    *hist_sql("hd", 50, "y", True)]) + "SELECT * FROM h"
SQL["count_histogram"] = with_("regress", extra=[
    ("hd", "SELECT p1 - y1 AS x FROM regress WHERE p1 - y1 IS NOT NULL"), *hist_sql("hd", 60, None, False)]) + \
    "SELECT * FROM h"
SQL["box_stats"] = f"""WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
    quantile_cont(value, 0.75) AS q3 FROM events WHERE value IS NOT NULL GROUP BY event_type)
SELECT e.event_type, {r('q1')} AS q1, {r('med')} AS median, {r('q3')} AS q3,
  min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)) AS whisker_lo,
  max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
  count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM events e JOIN q ON q.event_type = e.event_type WHERE value IS NOT NULL GROUP BY e.event_type, q1, med, q3"""
SQL["scatter_sample"] = """SELECT event_id, CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS y, value, user_id FROM events"""
_CAT = """CASE WHEN starts_with(Feature, 'PEAK2') THEN 'Second Path' WHEN starts_with(Feature, 'CIR') THEN 'CIR Waveform'
    ELSE 'Core Features' END"""
SQL["category_importance"] = with_("importance") + f"""SELECT {_CAT} AS Category, {r('sum(Importance)', 9)} AS Importance
    FROM importance GROUP BY 1"""
SQL["coef_sign_counts"] = with_("coefs") + """SELECT count(*) FILTER (coef > 0) AS n_positive,
    count(*) FILTER (coef < 0) AS n_negative FROM coefs"""
SQL["distinct_sorted"] = "SELECT DISTINCT source FROM documents"

# ================================================================ 2.8 classification evaluation
_CC = ("cc", """SELECT model, count(*) FILTER (y = 0 AND pred = 0) AS tn, count(*) FILTER (y = 0 AND pred = 1) AS fp,
    count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 1 AND pred = 1) AS tp FROM scored_pred GROUP BY model""")


def sdiv(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


_MET = ("met", f"""SELECT *, {sdiv('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {sdiv('tp', 'tp + fp')} AS precision,
    {sdiv('tp', 'tp + fn')} AS recall, {sdiv('2 * tp', '2 * tp + fp + fn')} AS f1 FROM cc""")
SQL["confusion_matrix"] = with_("scored_pred", extra=[_CC]) + " UNION ALL ".join(
    f"SELECT model, {yv} AS y, {pv} AS pred, {c} AS n, {e(sdiv(c + ' * 100.0', 'tn + fp + fn + tp'))} AS pct FROM cc"
    for yv, pv, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")))
SQL["binary_metrics"] = with_("scored_pred", extra=[_CC, _MET]) + f"""SELECT model, tn, fp, fn, tp,
    {e('accuracy', 9)} AS accuracy, {e('precision', 9)} AS precision, {e('recall', 9)} AS recall, {e('f1', 9)} AS f1 FROM met"""
_REP = ("rep", f"""SELECT model, {sdiv('tp', 'tp + fp')} AS p1, {sdiv('tp', 'tp + fn')} AS r1, {sdiv('2 * tp', '2 * tp + fp + fn')} AS f1,
    {sdiv('tn', 'tn + fn')} AS p0, {sdiv('tn', 'tn + fp')} AS r0, {sdiv('2 * tn', '2 * tn + fn + fp')} AS f0,
    CAST(tp + fn AS DOUBLE) AS s1, CAST(tn + fp AS DOUBLE) AS s0, CAST(tp + tn AS DOUBLE) AS ok FROM cc""")
SQL["classification_report"] = with_("scored_pred", extra=[_CC, _REP]) + " UNION ALL ".join(
    f"SELECT model, '{lab}' AS label, {e(pr, 9)} AS precision, {e(rc, 9)} AS recall, {e(f, 9)} AS f1, CAST({s} AS BIGINT) AS support FROM rep"
    for lab, pr, rc, f, s in (
        ("0", "p0", "r0", "f0", "s0"), ("1", "p1", "r1", "f1", "s1"),
        ("accuracy", sdiv("ok", "s0 + s1"), sdiv("ok", "s0 + s1"), sdiv("ok", "s0 + s1"), "s0 + s1"),
        ("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "s0 + s1"),
        ("weighted avg", sdiv("p0 * s0 + p1 * s1", "s0 + s1"), sdiv("r0 * s0 + r1 * s1", "s0 + s1"),
         sdiv("f0 * s0 + f1 * s1", "s0 + s1"), "s0 + s1")))
_ROC = [
    ("rg", "SELECT model, p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY model, p"),
    ("rc", """SELECT model, p, pos, neg, CAST(sum(pos) OVER w - pos AS BIGINT) AS pa, CAST(sum(neg) OVER w - neg AS BIGINT) AS na,
        CAST(sum(pos) OVER (PARTITION BY model) AS BIGINT) AS tot_pos, CAST(sum(neg) OVER (PARTITION BY model) AS BIGINT) AS tot_neg,
        lead(pos) OVER w2 AS npos, lead(neg) OVER w2 AS nneg, row_number() OVER w2 AS rn FROM rg
        WINDOW w AS (PARTITION BY model ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               w2 AS (PARTITION BY model ORDER BY p DESC)"""),
    ("roc", f"""SELECT model, p AS threshold, {sdiv('na + neg', 'tot_neg')} AS fpr, {sdiv('pa + pos', 'tot_pos')} AS tpr FROM rc
        WHERE rn = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg
        UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM scored"""),
    ("auc", f"""SELECT model, {e('sum(neg * (pa + pos / 2.0::DOUBLE)) / (CAST(tot_pos AS DOUBLE) * CAST(tot_neg AS DOUBLE))', 9)} AS auc
        FROM rc GROUP BY model, tot_pos, tot_neg"""),
]
SQL["roc_curve"] = with_("scored", extra=_ROC) + "SELECT * FROM roc"
SQL["save_predictions"] = with_("scored_pred", extra=[*_ROC, _CC]) + """SELECT 'predictions' AS part, model, id, y, pred, p, CAST(NULL AS BIGINT) AS n,
    CAST(NULL AS DOUBLE) AS fpr, CAST(NULL AS DOUBLE) AS tpr FROM scored_pred UNION ALL """ + " UNION ALL ".join(
    f"SELECT 'confusion', model, NULL, {yv}, {pv}, NULL, {c}, NULL, NULL FROM cc" for yv, pv, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))) + """
    UNION ALL SELECT 'roc', model, NULL, NULL, NULL, threshold, NULL, fpr, tpr FROM roc"""
SQL["roc_auc"] = with_("scored", extra=_ROC) + "SELECT * FROM auc"
SQL["auc_trapezoid"] = with_("scored", extra=_ROC) + f""", t AS (SELECT model, fpr, tpr,
    lag(fpr) OVER (PARTITION BY model ORDER BY fpr, tpr) AS pf, lag(tpr) OVER (PARTITION BY model ORDER BY fpr, tpr) AS pt
    FROM roc) SELECT model, {r('sum(coalesce((fpr - pf) * (tpr + pt) / 2.0, 0.0))', 9)} AS auc FROM t GROUP BY model"""
SQL["multi_model_roc"] = with_("scored", extra=_ROC) + "SELECT roc.*, auc.auc FROM roc JOIN auc ON auc.model = roc.model"


def sweep_sql(th: str) -> list[tuple[str, str]]:
    return [
        ("th", th),
        ("sc", """SELECT model, k, t, count(*) FILTER (y = 1 AND p >= t) AS tp, count(*) FILTER (y = 0 AND p >= t) AS fp,
            count(*) FILTER (y = 1 AND p < t) AS fn, count(*) FILTER (y = 0 AND p < t) AS tn FROM scored, th GROUP BY model, k, t"""),
        ("sm", f"""SELECT *, {sdiv('2 * tp', '2 * tp + fp + fn')} AS f1, {sdiv('tp', 'tp + fn')} AS recall,
            {sdiv('tp', 'tp + fp')} AS precision, {sdiv('tp + tn', 'tp + tn + fp + fn')} AS accuracy FROM sc"""),
    ]


_DELTA = (0.10 + 0.01) - 0.10
SQL["threshold_tune"] = with_("scored", extra=sweep_sql(
    f"SELECT k, 0.1::DOUBLE + k * {_DELTA!r}::DOUBLE AS t FROM range(0, 81) r(k)")) + f"""SELECT model,
    {e('t', 9)} AS threshold, {e('f1', 9)} AS f1, {e('recall', 9)} AS recall, {e('precision', 9)} AS precision FROM
    (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, recall DESC, k) AS rn FROM sm) WHERE rn = 1"""
_STEP = (0.95 - 0.05) / 199
SQL["threshold_curve"] = with_("scored", extra=sweep_sql(
    f"SELECT k, CASE WHEN k = 199 THEN 0.95::DOUBLE ELSE k * {_STEP!r}::DOUBLE + 0.05::DOUBLE END AS t FROM range(0, 200) r(k)")) + \
    f"""SELECT model, CAST(k AS INTEGER) AS k, {e('t', 9)} AS threshold, {e('f1', 9)} AS f1, {e('precision', 9)} AS precision,
    {e('recall', 9)} AS recall, {e('accuracy', 9)} AS accuracy,
    row_number() OVER (PARTITION BY model ORDER BY f1 DESC, k) = 1 AS is_best_f1,
    row_number() OVER (PARTITION BY model ORDER BY abs(t - 0.5), k) = 1 AS is_near_half FROM sm"""
SQL["error_partition"] = with_("scored_pred", extra=[_CC]) + """SELECT model, tn + fp + fn + tp AS n, tn + tp AS n_correct,
    fp + fn AS n_wrong, fp AS n_fp, fn AS n_fn FROM cc"""
SQL["error_confidence"] = with_("scored_pred") + f""", e AS (SELECT model, count(*) FILTER (y <> pred) AS n_wrong,
    count(*) FILTER (y <> pred AND p >= 0.4 AND p <= 0.6) AS n_near,
    count(*) FILTER (y <> pred AND (p <= 0.2 OR p >= 0.8)) AS n_confident,
    count(*) FILTER (y <> pred AND p >= 0.3 AND p <= 0.7) AS n_band_near FROM scored_pred GROUP BY model)
SELECT model, n_wrong, n_near, n_confident, n_band_near, n_wrong - n_band_near AS n_band_outside,
  {e('n_near * 100.0::DOUBLE / greatest(n_wrong, 1)')} AS pct_near,
  {e('n_confident * 100.0::DOUBLE / greatest(n_wrong, 1)')} AS pct_confident,
  {e('n_band_near * 100.0::DOUBLE / greatest(n_wrong, 1)')} AS pct_band_near,
  {e('(n_wrong - n_band_near) * 100.0::DOUBLE / greatest(n_wrong, 1)')} AS pct_band_outside FROM e"""
SQL["error_prob_stats"] = with_("scored_pred") + f"""SELECT model, count(*) AS n_wrong, {r('avg(p)', 9)} AS mean,
    {r('stddev_pop(p)', 9)} AS std, {r('min(p)', 9)} AS min, {r('max(p)', 9)} AS max, {r('quantile_cont(p, 0.5)', 9)} AS median
    FROM scored_pred WHERE y <> pred GROUP BY model"""
_EF = with_("scored_pred", extra=[("vec", """SELECT event_id AS id, [value, CAST(user_id AS DOUBLE)] ||
    list_transform(range(148), lambda i: CAST((event_id * (i * 2 + 3)) % 1009 AS DOUBLE) / 10.0::DOUBLE + (i % 5) * value) AS f FROM events"""),
    ("ef", "SELECT s.model, s.y, s.pred, i, f[i + 1] AS x FROM scored_pred s JOIN vec v ON v.id = s.id, range(150) r(i)")])


def shift_sql(normalise: bool) -> str:
    cm, em = "avg(x) FILTER (y = pred)", "avg(x) FILTER (y <> pred)"
    sd = "stddev_pop(x) FILTER (y = pred)"
    eff = f"abs({em} - {cm})"
    if normalise:
        eff = f"CASE WHEN {sd} > 1e-10 THEN {eff} / {sd} ELSE 0.0 END"
    return f"""SELECT model, 'F' || i AS feature, {r(eff)} AS effect, {r(cm)} AS correct_mean, {r(em)} AS error_mean
        FROM ef GROUP BY model, i HAVING count(*) FILTER (y = pred) > 0 AND count(*) FILTER (y <> pred) > 0"""


SQL["error_feature_shift"] = _EF + shift_sql(False)
SQL["error_feature_effect"] = _EF + shift_sql(True)
SQL["topk_error_features"] = _EF + "SELECT * FROM (" + shift_sql(True) + ") ORDER BY effect DESC, feature LIMIT 10"
SQL["error_rate_bins"] = with_("scored_pred") + f"""SELECT model, CAST(i AS INTEGER) AS bin,
    printf('%.1f-%.1f', i * 0.1::DOUBLE, CASE WHEN i = 9 THEN 1.0::DOUBLE ELSE (i + 1) * 0.1::DOUBLE END) AS label,
    count(*) AS n, {e('count(*) FILTER (y <> pred) / count(*)', 9)} AS error_rate
    FROM scored_pred, range(0, 10) b(i)
    WHERE p >= i * 0.1::DOUBLE AND p < CASE WHEN i = 9 THEN 1.0::DOUBLE ELSE (i + 1) * 0.1::DOUBLE END
    GROUP BY model, i"""
_CMP = [_CC, _MET, *_ROC[:2], _ROC[3], ("cmp", """SELECT met.model, accuracy, precision, recall, f1, auc.auc, recall AS nlos_recall,
    fn, fp FROM met JOIN auc ON auc.model = met.model""")]
SQL["model_comparison"] = with_("scored_pred", extra=_CMP) + f"""SELECT model, {e('accuracy', 9)} AS accuracy,
    {e('precision', 9)} AS precision, {e('recall', 9)} AS recall, {e('f1', 9)} AS f1, {e('auc', 9)} AS auc,
    {e('nlos_recall', 9)} AS nlos_recall, fn, fp FROM cmp"""
SQL["metrics_melt"] = with_("scored_pred", extra=_CMP) + " UNION ALL ".join(
    f"SELECT model, '{m}' AS metric, {e(m, 9)} AS score FROM cmp" for m in ("accuracy", "precision", "recall", "f1", "auc"))
SQL["best_model"] = with_("scored_pred", extra=_CMP) + f""", u AS ({" UNION ALL ".join(
    f"SELECT '{m}' AS metric, model, CAST({m} AS DOUBLE) AS value, {'-' if m == 'fn' else ''}CAST({m} AS DOUBLE) AS key FROM cmp"
    for m in ("f1", "auc", "nlos_recall", "fn"))})
SELECT metric, model AS best_model, {e('value', 9)} AS value FROM
    (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY key DESC, model) AS rn FROM u) WHERE rn = 1"""
SQL["metric_duel"] = with_("scored_pred", extra=_CMP) + f""", u AS ({" UNION ALL ".join(
    f"SELECT '{m}' AS metric, model, {m} AS score FROM cmp" for m in ("accuracy", "precision", "recall", "f1", "auc"))})
SELECT a.metric, {e('a.score', 9)} AS score_a, {e('b.score', 9)} AS score_b, {e('a.score - b.score', 9)} AS diff,
    CASE WHEN abs(a.score - b.score) < 0.001 THEN '≈ equal' WHEN a.score - b.score > 0 THEN 'm1' ELSE 'm2' END AS winner
    FROM u a JOIN u b ON b.metric = a.metric WHERE a.model = 'm1' AND b.model = 'm2'"""

# ================================================================ 2.9 regression evaluation
_RL = with_("regress", extra=[("rl", """SELECT key, 'path1' AS path, y1 AS y, p1 AS p FROM regress
    UNION ALL SELECT key, 'path2', y2, p2 FROM regress""")])


def regm(src: str, by: str) -> str:
    return f"""SELECT {by}, count(*) AS n, {r('sqrt(sum((p - y) * (p - y)) / count(*))')} AS rmse, {r('avg(abs(p - y))')} AS mae,
        {r('1.0 - sum((p - y) * (p - y)) / (var_pop(y) * count(*))')} AS r2 FROM {src} GROUP BY {by}"""


SQL["regression_metrics"] = _RL + regm("rl", "path")
SQL["clipped_metrics"] = with_("regress") + f"""SELECT count(*) AS n,
    {r('sqrt(sum((p2 - y2) * (p2 - y2)) / count(*))')} AS rmse_raw, {r('avg(abs(p2 - y2))')} AS mae_raw,
    {r('1.0 - sum((p2 - y2) * (p2 - y2)) / (var_pop(y2) * count(*))')} AS r2_raw,
    {r('sqrt(sum((greatest(p2, p1) - y2) * (greatest(p2, p1) - y2)) / count(*))')} AS rmse_clipped,
    {r('avg(abs(greatest(p2, p1) - y2))')} AS mae_clipped,
    {r('1.0 - sum((greatest(p2, p1) - y2) * (greatest(p2, p1) - y2)) / (var_pop(y2) * count(*))')} AS r2_clipped,
    count(*) FILTER (p2 < p1) AS n_violations FROM regress"""
SQL["residual_stats"] = _RL + f"""SELECT path, {r('avg(p - y)')} AS mean, {r('stddev_pop(p - y)')} AS std,
    {r('avg(CAST(abs(p - y) < 0.5 AS DOUBLE))')} AS share_lt_0_5, {r('avg(CAST(abs(p - y) < 1.0 AS DOUBLE))')} AS share_lt_1_0,
    {r('quantile_cont(p - y, 0.5)')} AS median FROM rl GROUP BY path"""
SQL["actual_vs_predicted"] = _RL + """SELECT path, key, y, p, least(min(y) OVER w, min(p) OVER w) AS lo, greatest(max(y) OVER w, max(p) OVER w) AS hi
    FROM rl WINDOW w AS (PARTITION BY path)"""
SQL["fold_summary"] = _RL + f""", rf AS (SELECT *, CAST({md5int("'42'", "key")} % 5 AS INTEGER) AS fold FROM rl),
  pf AS (SELECT path, fold, sqrt(sum((p - y) * (p - y)) / count(*)) AS rmse, avg(abs(p - y)) AS mae,
    1.0 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) AS r2 FROM rf GROUP BY path, fold)
SELECT path, count(*) AS n_folds, {r('avg(rmse)')} AS rmse_mean, {r('stddev_pop(rmse)')} AS rmse_std,
    {r('avg(mae)')} AS mae_mean, {r('stddev_pop(mae)')} AS mae_std, {r('avg(r2)')} AS r2_mean, {r('stddev_pop(r2)')} AS r2_std
    FROM pf GROUP BY path"""
_MR = _RL + f""", v AS (SELECT path, y, 'given' AS model, p FROM rl UNION ALL SELECT path, y, 'shrunk', p * 0.9::DOUBLE FROM rl
    UNION ALL SELECT path, y, 'blend', (p + y) / 2.0::DOUBLE FROM rl),
  res AS ({regm('v', 'path, model')})
"""
SQL["rank_results"] = _MR + "SELECT * FROM res"
SQL["best_per_path"] = _MR + """SELECT path, model, n, rmse, mae, r2 FROM (SELECT *, row_number() OVER
    (PARTITION BY path ORDER BY rmse, mae, model) AS rn FROM res) WHERE rn = 1"""

# ================================================================ 2.10 ranking
_AVGR = "CAST(floor(rank() OVER (ORDER BY {s} DESC) + (count(*) OVER (PARTITION BY {s}) - 1) / 2.0) AS INTEGER)"
SQL["avg_rank"] = with_("ranks") + f"SELECT f, a, {_AVGR.format(s='a')} AS rank FROM ranks"
SQL["rank_agreement"] = with_("ranks") + f"""SELECT x.f, x.a, x.rank_a, z.b, z.rank_b, (x.rank_a + z.rank_b) / 2.0::DOUBLE AS avg_rank
    FROM (SELECT f, a, {_AVGR.format(s='a')} AS rank_a FROM ranks) x
    JOIN (SELECT f, b, {_AVGR.format(s='b')} AS rank_b FROM ranks) z ON z.f = x.f"""
SQL["normalise_to_one"] = with_("ranks") + f"""SELECT f, {e('CASE WHEN sum(a) OVER () > 0 THEN a / sum(a) OVER () ELSE a END', 9)} AS a
    FROM ranks"""
SQL["rank_enumerate"] = with_("importance") + f"""SELECT Feature, {e('Importance', 9)} AS Importance,
    CAST(row_number() OVER (ORDER BY Importance DESC, Feature) AS INTEGER) AS rank FROM importance"""

# ================================================================ 2.11 top-k
SQL["topk_importance"] = with_("importance") + f"""SELECT Feature, {e('Importance', 9)} AS Importance FROM importance
    ORDER BY Importance DESC, Feature LIMIT 15"""
SQL["topk_abs"] = with_("coefs") + f"SELECT Feature, {e('coef', 9)} AS coef FROM coefs ORDER BY abs(coef) DESC, Feature LIMIT 10"

# ================================================================ 2.12 set operations
SQL["union_parts"] = """SELECT c_custkey AS key, c_acctbal AS acctbal, 'customer' AS __source_file FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier"""
SQL["hstack_features"] = with_("measurements", extra=[
    ("mw", "SELECT id, CAST(FP_IDX AS INTEGER) AS fp, cir AS w, RANGE FROM measurements"),
    *second_peak_ctes("mw", start=0, length=64, gap=3, height=10.0, prom=30.0),
    ("al", """SELECT id, list_transform(range(0, 32), lambda k: CASE WHEN fp - 8 + k >= 0 AND fp - 8 + k < len(w)
        THEN w[fp - 8 + k + 1] ELSE 0.0 END) AS a FROM mw"""),
    ("alf", """SELECT id, list_sum(list_transform(a, lambda x: x * x)) AS CIR_energy, CASE WHEN list_max(a) < 1e-10 THEN 0.0
        ELSE CAST(list_position(list_transform(a, lambda x: x >= list_max(a) * 0.9), true)
           - list_position(list_transform(a, lambda x: x >= list_max(a) * 0.1), true) AS DOUBLE) END AS CIR_rise_time FROM al""")]) + \
    f"""SELECT sp.id, peak2_idx AS PEAK2_IDX, peak2_amp AS PEAK2_AMP, peak2_found AS PEAK2_FOUND,
    peak2_idx - CAST(mw.fp AS DOUBLE) AS PEAK2_GAP,
    {r(f'mw.RANGE + (peak2_idx - CAST(mw.fp AS DOUBLE)) * {METERS_PER_SAMPLE!r}{D}', 9)} AS RANGE_PATH2_EST,
    CIR_energy, CIR_rise_time FROM sp JOIN mw ON mw.id = sp.id JOIN alf ON alf.id = sp.id"""

# ================================================================ 2.13 scaler, KNN
_SCOLS = ["l_quantity", "l_extendedprice", "l_discount"]
_LI_TRAIN = ("st", "SELECT " + ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(_SCOLS))
             + f" FROM lineitem WHERE {md5int(chr(39) + '42' + chr(39), 'l_orderkey')} % 5 <> 0")
SQL["fit_scaler"] = f"WITH {_LI_TRAIN[0]} AS ({_LI_TRAIN[1]})\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'm{i}')} AS mean, {r(f's{i}')} AS std FROM st" for i, c in enumerate(_SCOLS))
SQL["apply_scaler"] = f"WITH {_LI_TRAIN[0]} AS ({_LI_TRAIN[1]})\nSELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{r(f'CASE WHEN s{i} > 0 THEN ({c} - m{i}) / s{i} ELSE {c} - m{i} END')} AS {c}_z" for i, c in enumerate(_SCOLS)) + \
    " FROM lineitem, st"
SQL["knn_regress"] = with_("wave_emb", extra=[
    ("kx", f"SELECT id, w, CAST(grp AS DOUBLE) AS target, {md5int(chr(39) + '42' + chr(39), 'id')} % 5 AS fold FROM wave_emb"),
    ("ks", "SELECT id, target, fold, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM kx"),
    ("kd", """SELECT q.id AS qid, t.id AS tid, any_value(t.target) AS target, sum((q.x - t.x) * (q.x - t.x)) AS d2
        FROM ks q JOIN ks t ON t.i = q.i AND t.fold <> 0 WHERE q.fold = 0 GROUP BY q.id, t.id"""),
    ("kt", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, tid) AS rn FROM kd) WHERE rn <= 15""")]) + \
    f"""SELECT qid AS id, {r('''CASE WHEN count(*) FILTER (d2 = 0) > 0 THEN avg(target) FILTER (d2 = 0)
        ELSE sum(target / sqrt(d2)) FILTER (d2 > 0) / sum(1.0 / sqrt(d2)) FILTER (d2 > 0) END''')} AS pred FROM kt GROUP BY qid"""

# ---------------------------------------------------------------- model fits: facts about every scored row
_ML = f"""SELECT vec_id AS id, CAST(embedding[1] > 0 AS INTEGER) AS y, {md5int("'42'", 'vec_id')} % 5 AS fold FROM embeddings"""


def facts(*names: str, label: bool = True, rows: str = "fold = 0") -> str:
    return f"SELECT id{', y' if label else ''}, {', '.join(f'true AS {n}' for n in names)} FROM ({_ML}) WHERE {rows}"


_SCORED = ("p_in_range", "pred_fits", "above_floor")
SQL["train_boosted_classifier"] = facts(*_SCORED, "all_trees", "importance_sums_to_one")
SQL["early_stopping"] = facts(*_SCORED, "ended_in_time", "best_is_least", "cut_at_best")
SQL["train_random_forest"] = facts(*_SCORED, "all_trees")
SQL["train_logistic"] = facts(*_SCORED)
SQL["train_linear_svm"] = facts(*_SCORED, "gradient_near_zero")
SQL["platt_calibrate"] = facts(*_SCORED, "gradient_near_zero", "rising")
SQL["train_decision_tree"] = facts(*_SCORED, "rule_fits")
SQL["random_search_cv"] = facts(*_SCORED, "all_draws", "best_is_refitted")
SQL["predict_proba"] = facts("p_in_range")
SQL["train_boosted_regressor"] = facts("p_finite", "above_floor", "all_trees", label=False)
SQL["train_rf_regressor"] = facts("p_finite", "above_floor", "all_trees", label=False)
SQL["save_model"] = facts("same", label=False)
SQL["cv_score"] = f"""SELECT CAST(k AS INTEGER) AS cv_fold, count(*) AS n_rows, count(*) FILTER (y = 1) AS n_ones, true AS mean_f1_in_range FROM
    (SELECT y, (row_number() OVER (PARTITION BY y ORDER BY md5('42|' || CAST(id AS VARCHAR)), id) - 1) % 3 AS k FROM ({_ML}) WHERE fold <> 0) GROUP BY k"""
SQL["kfold_regression"] = "SELECT unnest(['random_forest', 'knn']) AS model, true AS errors_fit, true AS above_floor"
SQL["feature_importance"] = """SELECT 'f' || i AS Feature, true AS in_range, i = 0 AS largest, true AS sums_to_one
    FROM (SELECT max(len(embedding)) AS d FROM embeddings), range(0, 64) r(i) WHERE i < d"""
SQL["coefficients"] = """SELECT 'f' || i AS Feature, true AS abs_fits, i = 0 AS largest, true AS gradient_near_zero
    FROM (SELECT max(len(embedding)) AS d FROM embeddings), range(0, 64) r(i) WHERE i < d"""

"""The same questions in plain SQL, for the independent check of every query.

Each text is self-contained: the fixture views it names are prepended as common table
expressions.
"""

from __future__ import annotations

import re

from .. import contract as C
from ..sources.fixtures import check_sql

FEATURES = C.FEATURES
LABELS = ", ".join(C.LABELS)
PROBS = ", ".join(C.PROBABILITIES)
BEST = f"greatest({PROBS})"
PREDICTED = f"""CASE WHEN {BEST} = p_electric THEN 'electric' WHEN {BEST} = p_bearing THEN 'bearing'
     WHEN {BEST} = p_workroll THEN 'workroll' ELSE 'reduction' END"""
PRIMARY = """CASE WHEN y_electric THEN 'y_electric' WHEN y_bearing THEN 'y_bearing'
     WHEN y_workroll THEN 'y_workroll' WHEN y_reduction THEN 'y_reduction' ELSE 'normal' END"""
SHORT = "ts > (SELECT max(ts) FROM readings) - INTERVAL 1 DAY"
MIDDLE = "ts > (SELECT max(ts) FROM readings) - INTERVAL 3 DAY"
NOW = "TIMESTAMP '2024-01-31 00:00:00'"
RANGE = "ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'"


def _kpis(source: str, unit: str, step: str, threshold: float) -> str:
    return f"""SELECT date_trunc('{unit}', ts) AS window_start,
       date_trunc('{unit}', ts) + INTERVAL {step} AS window_end,
       count(DISTINCT coil_id) AS coils, count(*) AS events,
       CAST(sum(CASE WHEN anomaly_score >= {threshold} THEN 1 ELSE 0 END) AS BIGINT) AS anomalies,
       CAST(sum(CASE WHEN anomaly_score >= {threshold} THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS anomaly_rate,
       CAST({threshold} AS DOUBLE) AS threshold
FROM {source} GROUP BY 1, 2"""


HOURLY = _kpis("readings", "hour", "1 HOUR", 0.85)


def _unfold(extra: str = "", source: str = "coil_wide") -> str:
    parts = []
    for s in range(1, 6):
        signals = ", ".join(f"{n}_{s} AS {n}" for n in C.STAND_SIGNALS)
        points = ", ".join(C.SET_POINTS)
        labels = ", ".join(
            f"lower(trim({C.WIDE_LABELS[f].format(stand=s)})) IN ('true', '1', 't', 'yes') AS y_{f}"
            for f in C.FAMILIES
        )
        parts.append(
            f"SELECT coil_id, file_no{extra}, {signals}, {points}, tension_{s - 1} AS tension_in, "
            f"tension_{s} AS tension_out, {s} AS stand, {labels} FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


def _latest(source: str, keys: str = "coil_id, stand", order: str = "reading_id") -> str:
    return f"""SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER
    (PARTITION BY {keys} ORDER BY {order} DESC) AS rn_ FROM {source}) t WHERE rn_ = 1"""


def _worst(source: str) -> str:
    return f"""SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER
    (PARTITION BY coil_id ORDER BY anomaly_score DESC NULLS LAST, stand) AS rn_ FROM {source}) t
    WHERE rn_ = 1"""


def _inspect(where: str, threshold: str) -> str:
    """CTEs newest (one row per coil and stand) and flagged (one row per coil to inspect).

    One grouped pass: of a coil's rows the highest score, on ties the lowest stand, is picked as
    a whole row, and the flags are counted beside it.
    """
    alarm = f"count(*) FILTER (WHERE anomaly_score >= {threshold})"
    return f"""newest AS (
  SELECT unnest(arg_max(r, reading_id)) FROM (SELECT r, r.coil_id, r.stand, r.reading_id FROM
    (SELECT * FROM readings WHERE {where}) r) x GROUP BY coil_id, stand
), coils AS (
  SELECT coil_id, first(r ORDER BY anomaly_score DESC NULLS LAST, stand) AS top,
         max(anomaly_score) AS max_score, {alarm} AS stands_alarmed, max(u_votes) AS u_votes,
         min(stand) FILTER (WHERE anomaly_score >= {threshold}) AS first_stand,
         count(*) FILTER (WHERE u_anomaly) > 0 AS unsup_flag
  FROM newest r GROUP BY coil_id
), flagged AS (
  SELECT coil_id, top.anomaly_score AS confidence,
         (SELECT {PREDICTED} FROM (SELECT top.p_electric, top.p_bearing, top.p_workroll, top.p_reduction)) AS predicted_fault,
         top.stand AS worst_stand, first_stand, stands_alarmed, top.model_version, top.ts,
         stands_alarmed > 0 AS model_flag, unsup_flag, u_votes, max_score
  FROM coils WHERE stands_alarmed > 0 OR unsup_flag
)"""


# Surest first: flagged by the model, then by score, then by votes.
BOARD_ORDER = (
    "ORDER BY CASE WHEN model_flag THEN 0 ELSE 1 END, coalesce(-max_score, 1e300), coalesce(-u_votes, 99), coil_id"
)


def _inspect_list(where: str, threshold: str) -> str:
    return f"""WITH {_inspect(where, threshold)}
SELECT coil_id, confidence, CASE WHEN model_flag THEN predicted_fault END AS predicted_fault,
       worst_stand, first_stand, stands_alarmed, model_version, ts, model_flag, unsup_flag, u_votes,
       CASE WHEN model_flag AND unsup_flag THEN 'both' WHEN model_flag THEN 'model'
            ELSE 'ensemble' END AS flagged_by
FROM flagged {BOARD_ORDER} LIMIT 100"""


NEWEST_THRESHOLD = "coalesce(nullif((SELECT threshold FROM registry ORDER BY version DESC LIMIT 1), 0), 0.85)"


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / ({whole}) ELSE 0.0 END"


def _prf(prefix: str = "") -> str:
    precision, recall = _ratio("tp", "tp + fp"), _ratio("tp", "tp + fn")
    return f"""precision_ AS "precision", recall_ AS recall,
       CASE WHEN precision_ + recall_ > 0
            THEN 2 * precision_ * recall_ / (precision_ + recall_) ELSE 0.0 END AS f1""", (
        f"{precision} AS precision_, {recall} AS recall_"
    )


def _confusion(threshold: float, source: str, groups: str = "") -> str:
    hit, lead = f"anomaly_score >= {threshold}", f"{groups}, " if groups else ""
    tail = " GROUP BY ALL" if groups else ""
    return f"""SELECT {lead}count(*) FILTER (WHERE {hit} AND y_any) AS tp,
       count(*) FILTER (WHERE {hit} AND NOT y_any) AS fp,
       count(*) FILTER (WHERE NOT {hit} AND y_any) AS fn,
       count(*) FILTER (WHERE NOT {hit} AND NOT y_any) AS tn FROM {source}{tail}"""


def _family_rows(where: str, threshold: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{f}' AS family, count(*) FILTER (WHERE y_{f}) AS positives,
       count(*) FILTER (WHERE y_{f} AND anomaly_score >= {threshold}) AS caught,
       CAST(count(*) FILTER (WHERE y_{f} AND anomaly_score >= {threshold}) AS DOUBLE)
         / nullif(count(*) FILTER (WHERE y_{f}), 0) AS recall
FROM readings WHERE {where}"""
        for f in C.FAMILIES
    )


AP = """SELECT CASE WHEN max(total) > 0 AND max(total) < max(n_all)
            THEN sum(faults * (CAST(upto_faults AS DOUBLE) / upto_rows)) / max(total) ELSE 0.0 END AS ap
FROM (SELECT faults, sum(faults) OVER w AS upto_faults, sum(rows_) OVER w AS upto_rows,
             sum(faults) OVER () AS total, sum(rows_) OVER () AS n_all
      FROM (SELECT anomaly_score, count(*) FILTER (WHERE y_any) AS faults, count(*) AS rows_
            FROM readings GROUP BY 1) s
      WINDOW w AS (ORDER BY anomaly_score DESC)) r"""

COIL_FAMILIES = f"""SELECT *, {PRIMARY} AS family FROM (SELECT coil_id, {", ".join(
    f"coalesce(bool_or({n}), FALSE) AS {n}" for n in C.LABELS)} FROM readings GROUP BY 1) c"""


def _hash(seed: int) -> str:
    return f"CAST('0x' || substr(md5(CAST(coil_id AS VARCHAR) || '|{seed}'), 1, 13) AS BIGINT)"


HOLDOUT = f"""SELECT coil_id, family FROM (
  SELECT coil_id, family, row_number() OVER (PARTITION BY family ORDER BY {_hash(42)}, coil_id) AS rn,
         count(*) OVER (PARTITION BY family) AS n FROM ({COIL_FAMILIES}) f) r
WHERE rn <= ceil(0.15 * n)"""

DAY_BLOCK = "CAST(floor(epoch_us(ts) / 86400000000) AS BIGINT) AS block"


def _latency(groups: str, where: str, scale: float, names: tuple[str, str]) -> str:
    lat = "((epoch_us(ingested_at) - epoch_us(ts)) / 1000.0::DOUBLE)"
    lead = f"{groups} AS minute, " if groups else ""
    return f"""SELECT {lead}round(quantile_cont({lat}, 0.5) / {scale}, 9) AS {names[0]},
       round(quantile_cont({lat}, 0.95) / {scale}, 9) AS {names[1]}
FROM readings WHERE {where}{" GROUP BY 1" if groups else ""}"""


LATENCY_RECENT = _latency(
    "", f"{SHORT} AND ingested_at > {NOW} - INTERVAL 1 DAY", 1.0,
    ("latency_ms_p50", "latency_ms_p95"),
)

ROLLUP = f"""SELECT s.stand, coalesce(events, 0) AS events, coalesce(alarm_rate, 0) AS alarm_rate,
       {PROBS}, force, work_roll_mileage, model_version, coalesce(u_rate, 0) AS u_rate,
       coalesce(u_maha_rate, 0) AS u_maha_rate, coalesce(u_spc_rate, 0) AS u_spc_rate,
       coalesce(u_knn_rate, 0) AS u_knn_rate,
       CASE WHEN {BEST} IS NOT NULL THEN {PREDICTED} END AS dominant
FROM (VALUES (1), (2), (3), (4), (5)) s(stand) LEFT JOIN (
  SELECT stand, count(*) AS events,
         avg(CASE WHEN anomaly_score >= 0.85 THEN 1.0::DOUBLE ELSE 0 END) AS alarm_rate,
         {", ".join(f"round(avg({c}), 6) AS {c}" for c in C.PROBABILITIES + ["force", "work_roll_mileage"])},
         max(model_version) AS model_version,
         avg(CASE WHEN u_anomaly THEN 1.0::DOUBLE ELSE 0 END) AS u_rate,
         avg(CASE WHEN u_maha > 23.21 THEN 1.0::DOUBLE ELSE 0 END) AS u_maha_rate,
         avg(CASE WHEN u_spc > 3 THEN 1.0::DOUBLE ELSE 0 END) AS u_spc_rate,
         avg(CASE WHEN u_knn > 3 THEN 1.0::DOUBLE ELSE 0 END) AS u_knn_rate
  FROM readings WHERE {SHORT} GROUP BY stand) r USING (stand)"""


def _lamp(rate: str) -> str:
    return (
        f"CASE WHEN events = 0 THEN 'off' WHEN {rate} >= 0.15 THEN 'r' "
        f"WHEN {rate} >= 0.02 THEN 'a' ELSE 'g' END"
    )


LATEST_KPI = f"""SELECT *, CASE WHEN window_end > window_start THEN round_even(coils * 60.0::DOUBLE
       / (epoch_us(window_end) - epoch_us(window_start)) * 1000000, 1) END AS coils_per_min
FROM ({HOURLY}) k ORDER BY window_end DESC LIMIT 1"""

SPC_LIMITS = """SELECT stand, avg(force) AS center, stddev_samp(force) AS sigma FROM readings GROUP BY 1"""

# --- detectors: the adaptive state walked block by block ------------------------------------


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(n) for j in range(i, n)]


def _d_rows(signals, block: str = DAY_BLOCK) -> str:
    """Blocks and the states after them: means m0…, covariances c0_0…"""
    n, pairs = len(signals), _pairs(len(signals))
    keep, gain = "pow(0.998, b.n)", "(1 - pow(0.998, b.n))"
    mean = [f"s.m{i} + {gain} * (b.b{i} - s.m{i})" for i in range(n)]
    cov = [
        f"{keep} * s.c{i}_{j} + {gain} * (b.w{i}_{j} + {keep} * (b.b{i} - s.m{i}) * (b.b{j} - s.m{j}))" for i, j in pairs
    ]
    first = [f"w{i}_{j}{' + 0.001' if i == j else ''} AS c{i}_{j}" for i, j in pairs]
    return f"""RECURSIVE ev AS (SELECT stand, {block}, reading_id, coil_id, ts, {", ".join(f"{x} AS x{i}" for i, x in enumerate(signals))}
   FROM readings),
blk AS (SELECT stand, block, count(*) AS n, {", ".join(f"avg(x{i}) AS b{i}" for i in range(n))},
     {", ".join(f"covar_pop(x{i}, x{j}) AS w{i}_{j}" for i, j in pairs)},
     row_number() OVER (PARTITION BY stand ORDER BY block) AS j,
     coalesce(sum(count(*)) OVER (PARTITION BY stand ORDER BY block
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_before
   FROM ev GROUP BY stand, block),
st AS (SELECT stand, block, j, n_before, {", ".join(f"b{i} AS m{i}" for i in range(n))}, {", ".join(first)} FROM blk WHERE j = 1
   UNION ALL
   SELECT b.stand, b.block, b.j, b.n_before, {", ".join(mean)}, {", ".join(cov)}
   FROM st s JOIN blk b ON b.stand = s.stand AND b.j = s.j + 1)"""


def _d_scaled(i: int, row: str, state: str) -> str:
    return f"({row}.x{i} - {state}.m{i}) / sqrt(greatest({state}.c{i}_{i}, 1e-12))"


def _d_buffer(n: int) -> str:
    return f""",
z AS (SELECT e.stand, e.block, e.reading_id, {", ".join(f"{_d_scaled(i, 'e', 's')} AS z{i}" for i in range(n))},
     row_number() OVER (PARTITION BY e.stand ORDER BY e.block, e.ts, e.reading_id) - 1 AS pos
   FROM ev e JOIN st s ON e.stand = s.stand AND e.block = s.block),
buf AS (SELECT b.stand, b.block, z.reading_id, {", ".join(f"z.z{i}" for i in range(n))} FROM blk b JOIN z ON z.stand = b.stand
     AND z.pos >= b.n_before - 300 AND z.pos < b.n_before WHERE b.n_before >= 200)"""


def _d_factor(n: int) -> str:
    """Cholesky factor l of the covariance with its ridge, column by column."""
    text = "SELECT * FROM st"
    for j in range(n):
        own = "".join(f" - l{j}_{k} * l{j}_{k}" for k in range(j))
        text = f"SELECT *, sqrt(c{j}_{j} + 0.001{own}) AS l{j}_{j} FROM ({text})"
        below = [
            f"(c{j}_{i}{''.join(f' - l{i}_{k} * l{j}_{k}' for k in range(j))}) / l{j}_{j} AS l{i}_{j}" for i in range(j + 1, n)
        ]
        if below:
            text = f"SELECT *, {', '.join(below)} FROM ({text})"
    return text


def _d_scores(signals, block: str = DAY_BLOCK, keys=("e.stand", "e.reading_id")) -> str:
    n = len(signals)
    solved = "SELECT *, " + ", ".join(f"x{i} - m{i} AS d{i}" for i in range(n)) + " FROM met"
    for i in range(n):
        solved = f"SELECT *, (d{i}{''.join(f' - l{i}_{k} * y{k}' for k in range(i))}) / l{i}_{i} AS y{i} FROM ({solved})"
    apart = " + ".join(f"pow({_d_scaled(i, 'c', 'c')} - f.z{i}, 2)" for i in range(n))
    spc = ", ".join(f"abs({_d_scaled(i, 'c', 'c')})" for i in range(n))
    names = ", ".join(key.split(" AS ")[-1].removeprefix("e.") for key in keys)
    return f"""WITH {_d_rows(signals, block)}{_d_buffer(n)},
factor AS ({_d_factor(n)}),
met AS (SELECT e.*, b.j AS own_j, s.* EXCLUDE (stand, block) FROM ev e JOIN blk b ON b.stand = e.stand AND b.block = e.block
   JOIN factor s ON s.stand = b.stand AND s.j = b.j - 1 WHERE b.n_before >= 200),
sc AS ({solved}),
near AS (SELECT reading_id, avg(d) AS distance FROM (
     SELECT c.reading_id, sqrt({apart}) AS d FROM sc c JOIN buf f ON f.stand = c.stand AND f.block = c.block
     QUALIFY row_number() OVER (PARTITION BY c.reading_id ORDER BY d) <= 5) q GROUP BY 1),
db AS (SELECT c.stand, c.block, c.own_j AS j, count(*) AS n, avg(distance) AS bm, var_pop(distance) AS bv
   FROM sc c JOIN near USING (reading_id) GROUP BY 1, 2, 3),
ds AS (SELECT stand, j, CAST(0 AS DOUBLE) AS dm, CAST(1 AS DOUBLE) AS dv, n, bm, bv FROM db
   WHERE (stand, j) IN (SELECT (stand, min(j)) FROM db GROUP BY stand)
   UNION ALL
   SELECT b.stand, b.j, s.dm + (1 - pow(0.998, s.n)) * (s.bm - s.dm),
     pow(0.998, s.n) * s.dv + (1 - pow(0.998, s.n)) * (s.bv + pow(0.998, s.n) * (s.bm - s.dm) * (s.bm - s.dm)),
     b.n, b.bm, b.bv
   FROM ds s JOIN db b ON b.stand = s.stand AND b.j = s.j + 1),
fin AS (SELECT c.stand, c.reading_id, {" + ".join(f"c.y{i} * c.y{i}" for i in range(n))} AS u_maha,
     greatest({spc}) AS u_spc, (n.distance - d.dm) / sqrt(greatest(d.dv, 1e-9)) AS u_knn
   FROM sc c JOIN near n USING (reading_id) JOIN ds d ON d.stand = c.stand AND d.j = c.own_j)
SELECT {names}, round(u_maha, 5) AS u_maha, round(u_spc, 5) AS u_spc, round(u_knn, 5) AS u_knn,
       votes AS u_votes, votes >= 2 AS u_anomaly
FROM (SELECT {", ".join(keys)}, coalesce(f.u_maha, 0) AS u_maha, coalesce(f.u_spc, 0) AS u_spc,
        coalesce(f.u_knn, 0) AS u_knn,
        (CASE WHEN f.u_maha > 23.21 THEN 1 ELSE 0 END) + (CASE WHEN f.u_spc > 3 THEN 1 ELSE 0 END)
          + (CASE WHEN f.u_knn > 3 THEN 1 ELSE 0 END) AS votes
      FROM ev e LEFT JOIN fin f ON f.reading_id = e.reading_id) o"""


def _block_stats() -> str:
    return " UNION ALL ".join(
        f"""SELECT stand, block, count(*) AS n, '{s}' AS signal, round(avg({s}) + 3.7e-8, 6) AS mean,
       round(var_pop({s}) + 3.7e-8, 6) AS variance FROM (SELECT *, {DAY_BLOCK} FROM readings) b GROUP BY 1, 2"""
        for s in C.PROCESS_SIGNALS
    )


def _drift() -> str:
    recalls = ", ".join(
        f"""round(CAST(count(*) FILTER (WHERE y_{f} AND anomaly_score >= thr) AS DOUBLE)
        / nullif(count(*) FILTER (WHERE y_{f}), 0), 3) AS recall_{f},
        count(*) FILTER (WHERE y_{f}) AS pos_{f},
        CAST(count(*) FILTER (WHERE y_{f} AND anomaly_score >= thr) AS DOUBLE)
        / nullif(count(*) FILTER (WHERE y_{f}), 0) AS raw_{f}"""
        for f in C.FAMILIES
    )
    texts = ", ".join(
        f"CASE WHEN pos_{f} >= 1 AND raw_{f} < 1.1 THEN printf('{f} %.2f of %d faults', raw_{f}, pos_{f}) END"
        for f in C.FAMILIES
    )
    fires = " OR ".join(f"coalesce(pos_{f} >= 1 AND raw_{f} < 1.1, FALSE)" for f in C.FAMILIES)
    return f"""WITH c AS (SELECT {recalls} FROM (SELECT *, {NEWEST_THRESHOLD} AS thr FROM readings
    WHERE ts >= (SELECT max(ts) FROM readings) - INTERVAL 7 DAY) w)
SELECT {fires} AS fire, 'recall too low: ' || concat_ws(', ', {texts}) AS reason,
       {", ".join(C.FAMILY_RECALLS)} FROM c"""


def _policy_log() -> str:
    counts = ", ".join(
        f"""count(*) FILTER (WHERE y_{f}) AS pos_{f},
        CAST(count(*) FILTER (WHERE y_{f} AND anomaly_score >= threshold) AS DOUBLE) / nullif(count(*) FILTER (WHERE y_{f}), 0) AS raw_{f}"""
        for f in C.FAMILIES
    )
    recalls = ", ".join(f"round(raw_{f}, 3) AS recall_{f}" for f in C.FAMILIES)
    healthy = ", ".join(f"'{f} ' || CAST(round(raw_{f}, 3) AS VARCHAR)" for f in C.FAMILIES)
    low = {f: f"coalesce(pos_{f} >= 200 AND raw_{f} < 0.5, FALSE)" for f in C.FAMILIES}
    named = ", ".join(f"CASE WHEN {low[f]} THEN printf('{f} %.2f of %d faults', raw_{f}, pos_{f}) END" for f in C.FAMILIES)
    return f"""WITH k(check_no, after_s, guard, threshold, events) AS (VALUES
  (0, 20, 'off by configuration', 0.5::DOUBLE, TRUE), (1, 20, 'nothing published so far', NULL, TRUE),
  (2, 20, 'no event stored so far', 0.5, FALSE), (3, 75, 'last event 75 s ago', 0.5, TRUE),
  (4, 20, 'newest version published 120 s ago', 0.5, TRUE), (5, 30, NULL, 0.5, TRUE), (6, 5, NULL, 0.99, TRUE),
  (7, 45, NULL, 0.99, TRUE)),
c AS (SELECT check_no, after_s, guard, {counts} FROM k LEFT JOIN readings_dense ON events GROUP BY check_no, after_s, guard),
d AS (SELECT *, (SELECT max(ts) FROM readings_dense) AS anchor, guard IS NULL AND ({" OR ".join(low.values())}) AS drifted,
  coalesce(guard, CASE WHEN {" OR ".join(low.values())} THEN 'recall too low: ' || concat_ws(', ', {named})
    ELSE 'recall in order: ' || concat_ws(', ', {healthy}) END) AS why FROM c)
SELECT CAST(check_no AS BIGINT) AS check_no, anchor + to_seconds(after_s) AS checked_at, drifted, check_no = 6 AS fired,
  why || CASE check_no WHEN 6 THEN '; trained version 2' WHEN 7 THEN '; trained for it 40 s ago' ELSE '' END AS reason,
  CAST(check_no >= 6 AS BIGINT) AS fires, CASE WHEN check_no >= 6 THEN anchor + to_seconds(5) END AS last_fired,
  CASE WHEN check_no = 6 THEN 2 END AS version, {recalls} FROM d"""


def _medians(source: str, measures) -> str:
    picked = ", ".join(f"round(quantile_cont({m}, 0.5), 6) AS median_{m}" for m in measures)
    return f"SELECT stand, {picked} FROM {source} GROUP BY 1"


def _texts() -> dict[str, str]:
    names, prf_parts = _prf()
    q: dict[str, str] = {}
    q["merge_sources"] = """SELECT *, md5(CAST(coil_id AS VARCHAR) || '|42') AS shuffle_key FROM (
SELECT 1000000 + o_orderkey AS coil_id, 1 AS file_no, o_totalprice AS force_1 FROM orders
UNION ALL SELECT 2000000 + c_custkey, 2, c_acctbal FROM customer) m"""
    q["coil_id_assign"] = "SELECT 1000000 + event_id AS coil_id, 1 AS file_no, event_id FROM events"
    q["seeded_shuffle"] = """SELECT coil_id, file_no, md5(CAST(coil_id AS VARCHAR) || '|42') AS shuffle_key,
       force_1 FROM coil_wide"""
    q["unfold_per_stand"] = _unfold()
    q["unfold_ordered"] = f"""SELECT md5(CAST(coil_id AS VARCHAR) || '|42') AS shuffle_key, coil_id, stand,
       force, tension_in, tension_out FROM ({_unfold()}) u"""
    q["first_n_coils"] = f"""SELECT coil_id, stand, force, y_reduction FROM ({_unfold()}) u
WHERE coil_id IN (SELECT coil_id FROM coil_wide ORDER BY md5(CAST(coil_id AS VARCHAR) || '|42'), coil_id LIMIT 100)"""
    q["json_encode"] = f"""SELECT CAST(coil_id AS VARCHAR) AS "key", epoch_us(ts) // 1000 AS ts_ms,
       {", ".join(f.name for f in C.READING_SCHEMA if f.name != "ts_ms")} FROM readings"""
    sent = {
        "force": "CASE WHEN stand <> 3 THEN force END AS force", "torque": "CASE WHEN stand <> 4 THEN torque END AS torque",
    }
    q["json_decode"] = f"""SELECT date_trunc('milliseconds', ts) AS ts, coil_id, stand, file_no,
       {", ".join(sent.get(name, name) for name in C.SIGNALS)}, {LABELS} FROM readings WHERE stand <> 2"""
    q["null_guard"] = """SELECT reading_id, epoch_us(ts) // 1000 AS ts_ms, coil_id, stand FROM readings
WHERE file_no <> 3 AND NOT y_reduction AND stand <> 4"""
    sink = [f.name for f in C.SCORED_SCHEMA if f.name != "ts"]
    q["to_sink_schema"] = f"SELECT date_trunc('milliseconds', ts) AS ts, {', '.join(sink)} FROM readings"
    q["retention_filter"] = """SELECT reading_id, CAST(ts_day AS VARCHAR) AS ts_day FROM (
SELECT reading_id, CASE WHEN stand <> 5 THEN CAST(ts AS DATE) END AS ts_day FROM readings) d
WHERE ts_day IS NULL OR ts_day > (SELECT max(CAST(ts AS DATE)) FROM readings WHERE stand <> 5) - 7"""
    third = _kpis("(SELECT * FROM readings WHERE model_version = 3)", "hour", "1 HOUR", 0.5)
    q["kpi_upsert"] = f"""WITH a AS ({HOURLY}), b AS ({third})
SELECT *, 1 AS batch_id FROM b UNION ALL
SELECT *, 0 AS batch_id FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.window_start = a.window_start)"""
    q["registry_upsert"] = """SELECT * REPLACE (CASE WHEN version >= 2 THEN 'again' ELSE trained_on END AS trained_on,
       CASE WHEN version >= 2 THEN CAST(0.5 AS DOUBLE) ELSE threshold END AS threshold),
       CASE WHEN version >= 2 THEN 1 ELSE 0 END AS batch_id FROM registry"""
    labels = [C.WIDE_LABELS[f].format(stand=s) for f in C.FAMILIES[:-1] for s in range(1, 6)]
    q["label_normalize"] = "SELECT coil_id, " + ", ".join(
        f"lower(trim({n})) IN ('true', '1', 't', 'yes') AS {n.lower()}"
        for n in labels + ["Anomaly_Reduction"]
    ) + " FROM coil_wide"
    q["y_any"] = """SELECT reading_id, ((CASE WHEN stand <> 2 THEN y_electric END) OR y_bearing OR y_workroll
       OR y_reduction) AS y_any FROM readings"""
    q["clean_features"] = f"""SELECT reading_id, CASE WHEN stand = 5 THEN force ELSE 0 END AS force,
       {", ".join(s for s in C.SIGNALS if s != "force")} FROM readings"""
    q["contract_check"] = " UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS name, count({n}) AS known FROM readings"
        for i, n in enumerate(C.FEATURES + C.LABELS)
    )
    q["label_matrix"] = "SELECT reading_id, concat(" + ", ".join(
        f"CAST(CAST({n} AS INT) AS VARCHAR)" for n in C.LABELS
    ) + ") AS labels FROM readings"
    q["vote_2of3"] = """SELECT reading_id, v AS u_votes, v >= 2 AS u_anomaly FROM (SELECT reading_id,
       CAST(u_maha > 23.21 AS INT) + CAST(u_spc > 3 AS INT) + CAST(u_knn > 3 AS INT) AS v FROM readings) t"""
    q["predicted_family"] = f"SELECT reading_id, {PREDICTED} AS family FROM readings"
    q["dominant_family"] = """SELECT reading_id, CASE WHEN stand = 1 THEN NULL
       WHEN e >= greatest(b, w, r) THEN 'electric' WHEN b >= greatest(w, r) THEN 'bearing'
       WHEN w >= r THEN 'workroll' ELSE 'reduction' END AS family
FROM (SELECT reading_id, stand, p_electric AS e, CASE WHEN stand > 2 THEN p_bearing ELSE -1 END AS b,
             p_workroll AS w, p_reduction AS r FROM readings) t"""
    q["scalar_surface"] = """SELECT reading_id, date_trunc('milliseconds', ts) AS from_millis,
       date_trunc('minute', ts) AS minute, ts - INTERVAL 15 MINUTE AS earlier,
       (epoch_us(ingested_at) - epoch_us(ts)) / 1000000.0::DOUBLE AS latency_s,
       greatest(p_electric, p_bearing, p_workroll, p_reduction) AS best,
       coalesce(nullif(gap, 0), -1) AS gap_known,
       CAST(round(CAST(force AS DECIMAL(30,12)), 1) AS DOUBLE) AS force_1,
       'Stand ' || stand AS stand_name, CAST(y_any AS INT) AS y_int,
       CASE WHEN force > 100 THEN 'high' ELSE 'low' END AS band,
       y_electric OR y_bearing AS either FROM readings"""
    q["kpi_windows"] = HOURLY
    q["kpi_windows_big"] = _kpis("readings_big", "day", "1 DAY", 0.05)
    q["stand_rollup_10s"] = ROLLUP
    wear = "round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, work_roll_mileage / 120)) * 100, 6)"
    rollup = ROLLUP.replace("round(avg(work_roll_mileage), 6)", "avg(work_roll_mileage)")
    q["stand_status"] = f"""SELECT stand, events, alarm_rate, {_lamp("alarm_rate")} AS lamp,
       {_lamp("u_rate")} AS ensemble_lamp,
       CASE WHEN events > 0 AND alarm_rate >= 0.02 THEN dominant END AS family_shown,
       {wear} AS wear_percent,
       CASE WHEN {wear} < 50 THEN 'g' WHEN {wear} < 80 THEN 'a' WHEN {wear} >= 80 THEN 'r' END AS wear_band
FROM ({rollup}) r"""
    q["alarm_rate_by_stand"] = f"""SELECT 'Stand ' || stand AS stand_name,
       avg(CASE WHEN anomaly_score >= 0.85 THEN 1.0::DOUBLE ELSE 0 END) AS alarm_rate
FROM readings WHERE {RANGE} GROUP BY stand"""
    q["default_range"] = """SELECT 'until now' AS shown, reading_id, ts, coil_id, stand FROM readings
WHERE ts BETWEEN TIMESTAMP '2024-01-20 11:30:00' AND TIMESTAMP '2024-01-20 12:00:00'
UNION ALL SELECT 'until its end', reading_id, ts, coil_id, stand FROM readings
WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-10 06:30:00'"""
    q["anomaly_rate_per_minute"] = """SELECT date_trunc('minute', ts) AS minute,
       avg(CAST(anomaly_score >= 0.85 AS INT)) AS anomaly_rate FROM readings GROUP BY 1"""
    q["unsup_rate_per_minute"] = """SELECT date_trunc('minute', ts) AS minute,
       avg(CAST(u_anomaly AS INT)) AS unsup_rate FROM readings GROUP BY 1"""
    q["latency_per_minute"] = _latency("date_trunc('minute', ts)", "ingested_at IS NOT NULL", 1000.0, ("p50", "p95"))
    q["latency_recent"] = LATENCY_RECENT
    q["coils_total"] = "SELECT count(DISTINCT coil_id) AS coils_total FROM readings"
    q["throughput_per_window"] = f"""SELECT window_start, round(events / greatest(
       (epoch_us(window_end) - epoch_us(window_start)) / 1000000.0::DOUBLE, 1), 0) AS events_per_s FROM ({HOURLY}) k"""
    q["latest_kpi"] = LATEST_KPI
    fresh = f"(epoch_us({NOW}) - epoch_us(max(ts))) / 1000000.0::DOUBLE"
    q["freshness"] = f"""SELECT max(ts) AS anchor_ts, {fresh} AS freshness_s, {fresh} < 8 AS live,
       {fresh} > 60 AS stream_idle FROM readings"""
    q["snapshot_rates"] = f"""WITH roll AS ({ROLLUP}), lat AS ({LATENCY_RECENT}), k AS ({LATEST_KPI}),
tot AS (SELECT CAST(sum(events) AS BIGINT) AS e, sum(events * u_rate) AS u, max(model_version) AS v FROM roll)
SELECT (SELECT max(ts) FROM readings) AS anchor_ts, e AS events_recent,
       round_even(e / 86400.0::DOUBLE, 1) AS events_per_s, k.coils_per_min,
       (SELECT count(DISTINCT coil_id) FROM readings) AS coils_total,
       CASE WHEN e > 0 THEN round_even(u / e, 4) ELSE 0 END AS unsup_rate_recent,
       (SELECT {fresh} FROM readings) AS freshness_s, lat.latency_ms_p50, lat.latency_ms_p95,
       k.window_start AS kpi_start, k.window_end AS kpi_end, k.coils AS kpi_coils, v AS live_version
FROM tot, lat, k"""
    q["score_histogram"] = """SELECT CAST(least(floor(anomaly_score * 20), 19) AS BIGINT) AS bin, y_any,
       count(*) AS events FROM readings
WHERE model_version = (SELECT max(model_version) FROM readings) GROUP BY 1, 2"""
    q["live_prf"] = f"""SELECT tp, fp, fn, tn, {names} FROM (SELECT *, {prf_parts} FROM (
{_confusion(0.85, f"({_latest('readings')}) l")}) c) m"""
    q["recall_by_family"] = _family_rows("TRUE", "0.85")
    q["confusion_matrix"] = """SELECT y_any, anomaly_score >= 0.85 AS predicted, count(*) AS events
FROM readings GROUP BY 1, 2"""
    q["pr_over_time"] = f"""SELECT moment, precision_ AS "precision", recall_ AS recall FROM (
SELECT *, {prf_parts} FROM ({_confusion(0.85, "readings", "date_trunc('hour', ts) AS moment")}) c) m"""
    q["family_mix"] = f"SELECT {PRIMARY} AS family, count(*) AS events FROM readings GROUP BY 1"
    q["fault_attribution"] = f"""SELECT {PRIMARY} AS actual, {PREDICTED} AS predicted, count(*) AS events
FROM readings WHERE anomaly_score >= 0.85 GROUP BY 1, 2"""
    q["first_stand_histogram"] = """SELECT first_stand, count(*) AS coils FROM (SELECT coil_id,
       min(stand) AS first_stand FROM readings WHERE anomaly_score >= 0.85 GROUP BY 1) f GROUP BY 1"""
    q["median_by_stand"] = _medians("readings", ("force", "torque", "gap"))
    q["median_by_stand_big"] = _medians("readings_big", ("force", "torque"))
    q["spc_control_chart"] = f"""SELECT reading_id, ts, stand, force, round(center, 6) AS center,
       round(center - 3 * sigma, 6) AS lower, round(center + 3 * sigma, 6) AS upper,
       force < center - 3 * sigma OR force > center + 3 * sigma AS out_of_control
FROM readings JOIN ({SPC_LIMITS}) l USING (stand)"""
    q["tension_profile"] = """SELECT stand, round(avg(tension_in), 6) AS tension_in,
       round(avg(tension_out), 6) AS tension_out FROM readings GROUP BY 1"""
    q["roll_wear"] = """SELECT stand, ts, reading_id, work_roll_mileage, force, change AS roll_change,
       CAST(sum(CAST(change AS INT)) OVER (PARTITION BY stand ORDER BY ts, reading_id
         ROWS UNBOUNDED PRECEDING) AS BIGINT) AS campaign
FROM (SELECT *, coalesce(work_roll_mileage < lag(work_roll_mileage) OVER
       (PARTITION BY stand ORDER BY ts, reading_id), FALSE) AS change FROM readings) r"""
    q["latest_per_key"] = _latest("readings_big")
    q["worst_stand"] = f"""SELECT coil_id, stand AS worst_stand, anomaly_score, model_version, reading_id
FROM ({_worst(f"({_latest('readings')})")}) w"""
    q["coils_to_inspect"] = _inspect_list(MIDDLE, NEWEST_THRESHOLD)
    q["coils_inspect_board"] = f"""WITH {_inspect(RANGE, "0.85")}
SELECT coil_id AS coil, CASE WHEN model_flag THEN predicted_fault ELSE 'unsupervised' END AS fault,
       CASE WHEN model_flag AND unsup_flag THEN 'model + ensemble' WHEN model_flag THEN 'model'
            ELSE 'ensemble ' || u_votes || '/3' END AS flagged_by,
       CAST(round(CAST(confidence * 100 AS DECIMAL(30,12)), 1) AS DOUBLE) AS confidence_pct,
       worst_stand, first_stand AS first_flagged, stands_alarmed
FROM flagged {BOARD_ORDER} LIMIT 50"""
    q["coils_flagged"] = f"WITH {_inspect('TRUE', '0.85')} SELECT * FROM flagged"
    q["inspect_sorted"] = f"""SELECT * FROM ({_inspect_list(MIDDLE, "0.85")}) i
ORDER BY CASE WHEN model_flag THEN confidence END ASC NULLS LAST, coil_id"""
    age = "greatest((epoch_us((SELECT max(ts) FROM readings)) - epoch_us(ts)) / 1000000.0::DOUBLE, 0)"
    q["alarm_ticker"] = f"""SELECT reading_id, ts, coil_id, stand, anomaly_score, {PREDICTED} AS family,
       CASE WHEN {age} < 1 THEN 'now' WHEN {age} < 60 THEN CAST(floor({age} + 0.5) AS BIGINT) || 's'
            WHEN {age} < 3600 THEN CAST(floor({age} / 60 + 0.5) AS BIGINT) || 'm'
            ELSE CAST(floor({age} / 3600 + 0.5) AS BIGINT) || 'h' END AS age
FROM readings WHERE anomaly_score >= 0.85 ORDER BY reading_id DESC LIMIT 25"""
    q["ticker_delta"] = """SELECT reading_id, coil_id, stand, anomaly_score FROM readings
WHERE anomaly_score >= 0.85 AND reading_id > (SELECT max(reading_id) FROM readings WHERE model_version = 2)
ORDER BY reading_id DESC LIMIT 40"""
    profile = ", ".join(
        ["stand", "ts", "force", "torque", "gap", "tension_in", "tension_out", "anomaly_score",
         PROBS, LABELS, "y_any", "model_version"]
    )
    q["coil_profile"] = f"""SELECT {profile} FROM ({_latest('readings')}) l
WHERE coil_id = (SELECT coil_id FROM readings ORDER BY reading_id DESC LIMIT 1)"""
    q["model_history"] = "SELECT * FROM registry"
    q["next_version"] = "SELECT coalesce(max(version), 0) + 1 AS next_version FROM registry"
    recalls = ", ".join(C.FAMILY_RECALLS)
    lags = ", ".join(f"lag({r}) OVER (ORDER BY version) AS previous_{r}" for r in C.FAMILY_RECALLS)
    q["version_delta"] = f"SELECT version, {recalls}, {lags} FROM registry"
    q["hot_swap_annotations"] = """SELECT trained_at AS "time", 'model v' || version || ' · F1 ' ||
       printf('%.2f', overall_f1) AS "text" FROM registry WHERE version >= 1"""
    q["effective_threshold"] = f"SELECT {NEWEST_THRESHOLD} AS threshold"
    q["hot_swap_gap"] = f"""SELECT live_version, latest_version, latest_version > live_version AS swapping
FROM (SELECT (SELECT max(model_version) FROM readings WHERE {SHORT}) AS live_version,
             (SELECT max(version) FROM registry) AS latest_version) v"""
    q["hot_swap_phases"] = """WITH d AS (SELECT date_trunc('day', ts) AS snapshot_at, max(model_version) AS live_version
  FROM readings GROUP BY 1),
p AS (SELECT *, live_version + CASE WHEN day(snapshot_at) % 7 = 0 THEN 1 ELSE 0 END AS latest_version FROM d),
c AS (SELECT *, lag(live_version) OVER w AS l, lag(latest_version) OVER w AS r FROM p WINDOW w AS (ORDER BY snapshot_at)),
k AS (SELECT * FROM c WHERE l IS NULL OR l <> live_version OR r <> latest_version)
SELECT snapshot_at, live_version, latest_version, CASE WHEN latest_version > live_version THEN 'swap'
       WHEN coalesce(lag(latest_version > live_version) OVER (ORDER BY snapshot_at), FALSE) THEN 'flash'
       ELSE 'sync' END AS phase FROM k"""
    q["drift_recall_window"] = _family_rows(
        "ts >= (SELECT max(ts) FROM readings) - INTERVAL 7 DAY", NEWEST_THRESHOLD
    )
    q["drift_decision"] = _drift()
    q["policy_log"] = _policy_log()
    q["tune_threshold"] = """WITH g AS (SELECT round(i * 0.05, 2)::DOUBLE AS threshold FROM range(1, 20) r(i)),
s AS (SELECT threshold, count(*) FILTER (WHERE y_any AND anomaly_score >= threshold) AS tp,
   count(*) FILTER (WHERE NOT y_any AND anomaly_score >= threshold) AS fp,
   count(*) FILTER (WHERE y_any AND NOT anomaly_score >= threshold) AS fn FROM readings, g GROUP BY 1)
SELECT threshold, CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0 END AS f1
FROM s ORDER BY f1 DESC, threshold LIMIT 1"""
    fam = ", ".join(
        f"round(coalesce(avg(CASE WHEN y_{f} THEN CAST(anomaly_score >= 0.85 AS INT) END), 0), 9) AS recall_{f}"
        for f in C.FAMILIES
    )
    q["eval_metrics"] = f"""SELECT {names}, round((SELECT ap FROM ({AP}) a), 9) AS pr_auc,
       {", ".join(C.FAMILY_RECALLS)}, n_eval
FROM (SELECT *, {prf_parts} FROM ({_confusion(0.85, "readings")}) c) m,
     (SELECT {fam}, count(*) AS n_eval FROM readings) f"""
    q["average_precision"] = f"SELECT round(ap, 9) AS average_precision FROM ({AP}) a"
    q["balanced_weights"] = " UNION ALL ".join(
        f"""SELECT '{f}' AS family, count(*) AS n, count(*) FILTER (WHERE y_{f}) AS positives,
       count(*) / nullif(2.0::DOUBLE * count(*) FILTER (WHERE y_{f}), 0) AS weight_fault,
       count(*) / nullif(2.0::DOUBLE * count(*) FILTER (WHERE NOT y_{f}), 0) AS weight_normal FROM readings"""
        for f in C.FAMILIES
    )
    q["coil_primary_family"] = COIL_FAMILIES
    q["family_coverage"] = "SELECT count(DISTINCT coil_id) AS coils, " + ", ".join(
        f"count(DISTINCT CASE WHEN y_{f} THEN coil_id END) AS coils_{f}" for f in C.FAMILIES
    ) + " FROM readings"
    q["holdout_split"] = HOLDOUT
    q["train_val_split"] = f"""SELECT coil_id, 'validation' AS side FROM (SELECT coil_id,
  row_number() OVER (ORDER BY {_hash(7)}, coil_id) AS rn, count(*) OVER () AS n
  FROM (SELECT DISTINCT coil_id FROM readings) d) r WHERE rn <= ceil(0.15 * n)"""
    q["holdout_rows"] = f"""SELECT reading_id, coil_id, stand FROM readings
WHERE coil_id IN (SELECT coil_id FROM ({HOLDOUT}) h)"""
    q["train_minus_holdout"] = f"""SELECT reading_id, coil_id, stand FROM readings
WHERE coil_id NOT IN (SELECT coil_id FROM ({HOLDOUT}) h)"""
    q["cold_start_scores"] = "SELECT reading_id, 0.0::DOUBLE AS anomaly_score, " + ", ".join(
        f"0.0::DOUBLE AS {p}" for p in C.PROBABILITIES
    ) + ", 0 AS model_version FROM readings"
    q["block_stats"] = _block_stats()
    every = list(C.PROCESS_SIGNALS)
    after = [
        f"""SELECT stand, block, CAST(n_before AS BIGINT) AS n_before, '{signal}' AS signal, round(m{i} + 3.7e-8, 6) AS mean,
       round(sqrt(greatest(c{i}_{i}, 1e-12)) + 3.7e-8, 6) AS sd FROM st"""
        for i, signal in enumerate(every)
    ]
    q["ewma_mean"] = f"WITH {_d_rows(every)} " + " UNION ALL ".join(after)
    named = ", ".join(f"round(z{i} + 3.7e-7, 5) AS z_{signal}" for i, signal in enumerate(every))
    q["knn_buffer"] = f"WITH {_d_rows(every)}{_d_buffer(len(every))} SELECT stand, block, reading_id, {named} FROM buf"
    q["detector_scores"] = _d_scores(["force", "gap"])
    q["detector_scores_full"] = _d_scores(every)
    q["stream_detector_scores"] = _d_scores(
        every, "CAST(floor(epoch_us(ts) / (3 * 86400000000)) AS BIGINT) AS block",
        ("date_trunc('milliseconds', e.ts) AS ts", "e.coil_id", "e.stand"),
    )
    q["stream_kpi_windows"] = f"""SELECT * FROM ({HOURLY}) k
WHERE window_end <= (SELECT max(ts) FROM readings) - INTERVAL 1 SECOND"""
    q["stream_totals"] = """SELECT count(*) AS events_total, count(DISTINCT coil_id) AS coils_total,
       date_trunc('milliseconds', min(ts)) AS first_ts, date_trunc('milliseconds', max(ts)) AS anchor_ts FROM readings"""
    q["stream_late_and_replayed"] = """WITH r AS (SELECT coil_id, stand, date_trunc('milliseconds', ts) AS ts,
       reading_id % 97 = 0 AND day(ts) < 10 AS late, CASE WHEN reading_id % 50 = 0 THEN 2 ELSE 1 END AS copies FROM readings),
k AS (SELECT date_trunc('hour', ts) AS window_start, count(DISTINCT coil_id) AS coils, count(*) AS events
  FROM (SELECT DISTINCT coil_id, stand, ts FROM r WHERE NOT late) d GROUP BY 1),
s AS (SELECT date_trunc('hour', ts) AS window_start, CAST(sum(copies) AS BIGINT) AS stored FROM r GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, coils, events, 0 AS anomalies, stored FROM k JOIN s USING (window_start)
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM r WHERE NOT late) - INTERVAL 1 SECOND"""
    zero = ", ".join(f"0.0::DOUBLE AS {name}" for name in ["anomaly_score", *C.PROBABILITIES, "u_maha", "u_spc", "u_knn"])
    q["stream_scored_events"] = f"""SELECT date_trunc('milliseconds', ts) AS ts, coil_id, stand, file_no, {", ".join(C.SIGNALS)},
       {LABELS}, y_any, {zero}, 0 AS model_version, 0 AS u_votes, FALSE AS u_anomaly, CAST(CAST(ts AS DATE) AS VARCHAR) AS ts_day,
       TRUE AS id_in_range, (SELECT count(*) FROM readings) AS different_ids, TRUE AS stamped FROM readings"""
    return q


_VIEW_NEEDS = {"registry": ["readings", "registry"], "readings_dense": ["readings", "readings_dense"]}


def _with_views(text: str, views: dict[str, str]) -> str:
    """Prepend the fixture views that the text names."""
    used = [name for name in views if re.search(rf"\b{name}\b", text)]
    order = [n for n in views if n in {m for u in used for m in _VIEW_NEEDS.get(u, [u])}]
    heads = ", ".join(f"{name} AS ({views[name]})" for name in order)
    if not heads:
        return text
    inner = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", text)
    if inner:
        recursive = "RECURSIVE " if inner.group(1) else ""
        return f"WITH {recursive}{heads}, {text[inner.end():]}"
    return f"WITH {heads} {text}"


def check_texts() -> dict[str, str]:
    views = check_sql()
    return {name: _with_views(text, views) for name, text in _texts().items()}

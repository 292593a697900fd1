"""The driver's tables seen as the tables this package works on.

Each view is one SQL text used by Spark and by the check engine; only the dialect tokens
differ. `readings` plays the stored events, `readings_big` a volume table, `coil_wide` the
wide source and `registry` the model versions, here derived from the readings themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import utc

_SPARK = {
    "K": "get_json_object(props, '$.k')",
    "LATER": "timestampadd(MICROSECOND, k * 10007, ts)",
    "DIV": "div",
    "PLAIN_TIME": "TIMESTAMP_NTZ",
    "EXCEPT": "EXCEPT",
    "SQUEEZED": "timestampadd(MICROSECOND, timestampdiff(MICROSECOND, first_ts, ts) div 16000, TIMESTAMP_NTZ '2024-02-01 00:00:00')",
}
_CHECK = {
    "K": "json_extract_string(props, '$.k')",
    "LATER": "ts + to_microseconds(k * 10007)",
    "DIV": "//",
    "PLAIN_TIME": "TIMESTAMP",
    "EXCEPT": "EXCLUDE",
    "SQUEEZED": "TIMESTAMP '2024-02-01 00:00:00' + to_microseconds((epoch_us(ts) - epoch_us(first_ts)) // 16000)",
}

_READINGS = """
SELECT *, u_votes >= 2 AS u_anomaly FROM (
SELECT *, greatest(p_electric, p_bearing, p_workroll, p_reduction) AS anomaly_score,
       (y_electric OR y_bearing OR y_workroll OR y_reduction) AS y_any,
       (CASE WHEN u_maha > 23.21 THEN 1 ELSE 0 END) + (CASE WHEN u_spc > 3 THEN 1 ELSE 0 END)
         + (CASE WHEN u_knn > 3 THEN 1 ELSE 0 END) AS u_votes
FROM (
SELECT event_id AS reading_id, ts, user_id * 100 + day(ts) AS coil_id, stand,
       CAST(day(ts) % 6 + 1 AS INT) AS file_no,
       CAST(user_id AS DOUBLE) AS work_roll_diam, CAST(k AS DOUBLE) AS work_roll_mileage,
       (k % 17) / CAST(20 AS DOUBLE) AS reduction, value / 10 AS roll_speed,
       value AS force, value / 4 AS torque, k / CAST(8 AS DOUBLE) AS gap,
       CAST(k * 3 AS DOUBLE) AS motor_power,
       CAST(user_id % 5 AS DOUBLE) AS thickness_entry,
       CAST(user_id % 3 AS DOUBLE) AS thickness_exit,
       CAST(1000 AS DOUBLE) AS width, CAST(user_id % 7 AS DOUBLE) AS ys_entry,
       CAST(user_id % 11 AS DOUBLE) AS ys_exit,
       (k % 19) / CAST(2 AS DOUBLE) AS tension_in, (k % 23) / CAST(2 AS DOUBLE) AS tension_out,
       (k % 7) / CAST(8 AS DOUBLE) AS p_electric, (k % 11) / CAST(12 AS DOUBLE) AS p_bearing,
       (k % 13) / CAST(14 AS DOUBLE) AS p_workroll,
       least(value / 110, CAST(1 AS DOUBLE)) AS p_reduction,
       k % 7 = 6 AS y_electric, k % 11 = 10 AS y_bearing, k % 13 = 12 AS y_workroll,
       value > 110 AS y_reduction,
       CAST(1 + (day(ts) - 1) [DIV] 10 AS INT) AS model_version,
       value / 3 AS u_maha, k / CAST(25 AS DOUBLE) AS u_spc, value / 30 AS u_knn,
       [LATER] AS ingested_at
FROM (
SELECT event_id, ts, user_id, value, CAST([K] AS INT) AS k,
       CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                       WHEN 'signup' THEN 4 ELSE 5 END AS stand
FROM [events]) base) feat) voted
"""

# The same readings as a stream of under three minutes.
_READINGS_DENSE = """
SELECT * [EXCEPT] (ts, first_ts), [SQUEEZED] AS ts FROM (
SELECT *, (SELECT min(ts) FROM [readings]) AS first_ts FROM [readings]) spread
"""

_READINGS_BIG = """
SELECT (l_partkey * 100000 + l_suppkey) * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS reading_id, l_shipdate AS ts, l_orderkey AS coil_id,
       CAST((l_linenumber - 1) % 5 + 1 AS INT) AS stand, l_extendedprice AS force, l_quantity AS torque,
       l_discount AS tension_in, l_tax AS tension_out, l_discount * 10 AS anomaly_score,
       l_returnflag = 'R' AS y_any
FROM [lineitem]
"""


def _wide_columns() -> str:
    def at(column, line):
        return f"max({column}) FILTER (WHERE l_linenumber = {line})"

    parts = []
    for stand in range(1, 6):
        price, quantity = at("l_extendedprice", stand), at("l_quantity", stand)
        parts += [
            f"{quantity} * 10 AS work_roll_diam_{stand}",
            f"{quantity} * 2 AS work_roll_mileage_{stand}",
            f"{at('l_tax', stand)} AS reduction_{stand}",
            f"{quantity} / 4 AS roll_speed_{stand}",
            f"{price} AS force_{stand}",
            f"{price} / 8 AS torque_{stand}",
            f"{at('l_discount', stand)} AS gap_{stand}",
            f"{price} / 2 AS motor_power_{stand}",
        ]
        for family, flag in (("Electric", "R"), ("Bearing", "A"), ("WorkRoll", "N")):
            word = f"CASE WHEN {at('l_returnflag', stand)} = '{flag}' THEN ' True ' ELSE 'False' END"
            parts.append(f"{word} AS Anomaly_{family}_{stand}")
    parts += [f"{at('l_discount', line)} AS tension_{line - 1}" for line in range(1, 7)]
    parts += [
        "max(l_tax) AS thickness_entry", "min(l_tax) AS thickness_exit",
        "max(l_quantity) AS width", "min(l_quantity) AS ys_entry", "max(l_discount) AS ys_exit",
        "CASE WHEN max(l_returnflag) = 'R' THEN 'yes' ELSE 'no' END AS Anomaly_Reduction",
    ]
    return ",\n       ".join(parts)


_COIL_WIDE = f"""
SELECT l_orderkey AS coil_id, CAST(1 + l_orderkey % 6 AS INT) AS file_no,
       {_wide_columns()}
FROM [lineitem] GROUP BY l_orderkey
"""

# One version per model seen in the readings, evaluated on the rows it scored.
_REGISTRY = """
SELECT version, trained_at, n_train_samples, threshold,
       CASE WHEN precision_ + recall_ > 0
            THEN 2 * precision_ * recall_ / (precision_ + recall_) ELSE 0.0 END AS overall_f1,
       (precision_ + recall_) / 2 AS overall_pr_auc,
       precision_ AS [Q]precision[Q], recall_ AS recall,
       recall_electric, recall_bearing, recall_workroll, recall_reduction, trained_on
FROM (
SELECT model_version AS version, CAST(date_trunc('second', max(ts)) AS [PLAIN_TIME]) AS trained_at,
       count(*) AS n_train_samples, max(threshold) AS threshold,
       coalesce(CAST(count(*) FILTER (WHERE y_any AND hit) AS DOUBLE)
                / nullif(count(*) FILTER (WHERE hit), 0), 0.0) AS precision_,
       coalesce(CAST(count(*) FILTER (WHERE y_any AND hit) AS DOUBLE)
                / nullif(count(*) FILTER (WHERE y_any), 0), 0.0) AS recall_,
       coalesce(CAST(count(*) FILTER (WHERE y_electric AND hit) AS DOUBLE)
                / nullif(count(*) FILTER (WHERE y_electric), 0), 0.0) AS recall_electric,
       coalesce(CAST(count(*) FILTER (WHERE y_bearing AND hit) AS DOUBLE)
                / nullif(count(*) FILTER (WHERE y_bearing), 0), 0.0) AS recall_bearing,
       coalesce(CAST(count(*) FILTER (WHERE y_workroll AND hit) AS DOUBLE)
                / nullif(count(*) FILTER (WHERE y_workroll), 0), 0.0) AS recall_workroll,
       coalesce(CAST(count(*) FILTER (WHERE y_reduction AND hit) AS DOUBLE)
                / nullif(count(*) FILTER (WHERE y_reduction), 0), 0.0) AS recall_reduction,
       concat('streamed ', CAST(count(DISTINCT coil_id) AS VARCHAR(20)), ' coils') AS trained_on
FROM (
SELECT *, (18 - model_version) / CAST(20 AS DOUBLE) AS threshold,
       anomaly_score >= (18 - model_version) / CAST(20 AS DOUBLE) AS hit
FROM [readings]) flagged GROUP BY model_version) measured
"""


def _fill(text: str, tokens: dict[str, str]) -> str:
    for name, value in tokens.items():
        text = text.replace(f"[{name}]", value)
    return text


def check_sql() -> dict[str, str]:
    """The views in the check engine's dialect, as sub-select texts."""
    readings = _fill(_READINGS, _CHECK | {"events": "events"})
    return {
        "readings": readings,
        "readings_dense": _fill(_READINGS_DENSE, _CHECK | {"readings": "readings"}),
        "readings_big": _fill(_READINGS_BIG, {"lineitem": "lineitem"}),
        "coil_wide": _fill(_COIL_WIDE, {"lineitem": "lineitem"}),
        "registry": _fill(_REGISTRY, _CHECK | {"readings": "readings", "Q": '"'}),
    }


def _run(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    tokens = _SPARK | {"Q": "`"} | {name: "{" + name + "}" for name in tables}
    return utc(spark).sql(_fill(text, tokens), **tables)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, _READINGS, events=table(spark, sf_dir, "events"))


def readings_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same view over the events table read as a stream."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return _run(spark, _READINGS, events=events)


def readings_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, _READINGS_DENSE, readings=readings(spark, sf_dir))


def readings_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, _READINGS_BIG, lineitem=table(spark, sf_dir, "lineitem"))


def readings_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`readings_big` with ids of any size: decimals as soon as one id is too large for 64 bits."""
    lineitem = table(spark, sf_dir, "lineitem")

    def with_keys(kind: str) -> DataFrame:
        return _run(spark, _READINGS_BIG, lineitem=lineitem.withColumn("l_partkey", F.col("l_partkey").cast(kind)))

    def largest(rows: DataFrame):
        return rows.agg(F.max(F.abs("reading_id"))).first()[0] or 0

    # Doubles are cheap to scan and tell all but ids that are close to the limit.
    about = largest(with_keys("double"))
    if about < 2 ** 62:
        return readings_big(spark, sf_dir)
    numbered = with_keys("decimal(20,0)")
    if about < 2 ** 64 and largest(numbered) < 2 ** 63:
        return numbered.withColumn("reading_id", F.col("reading_id").cast("long"))
    return numbered


def coil_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, _COIL_WIDE, lineitem=table(spark, sf_dir, "lineitem"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, _REGISTRY, readings=readings(spark, sf_dir))

"""The registered queries once more, as SQL for another engine (DuckDB).

Written independently of the library: windows run over whole vehicles here, one
statement per query. Sums of doubles are exact here, too, as 128-bit whole numbers, and rounded
once; rounding is half up by ``floor``.
"""

from __future__ import annotations

from voltfleet.operators.metrics import METRIC_COLUMNS
from voltfleet.settings import METRIC_UNITS, PHYSICAL_RANGES

FIELDS = [
    "timestamp", "vehicle_id", "speed", "battery_voltage", "battery_current",
    "battery_temperature", "motor_temperature", "motor_rpm", "soc", "throttle", "brake",
    "charging_status", "energy_consumption", "cabin_temperature", "latitude", "longitude",
]
NUMERIC = FIELDS[2:]
HOURS = "0.001388888888888889e0"  # five seconds


def r(x: str, n: int) -> str:
    return f"(floor(({x}) * 1e{n} + 5e-1) / 1e{n})"


def whole(x: str) -> str:
    """A double as a whole number of 2 ** -80, 128 bits wide: sums of it are exact."""
    return f"CAST(({x}) * 1208925819614629174706176e0 AS HUGEINT)"


def joined(total: str) -> str:
    return f"(CAST({total} AS DOUBLE) / 1208925819614629174706176e0)"


def fsum(x: str) -> str:
    return joined(f"coalesce(sum({whole(x)}), 0)")


def favg(x: str) -> str:
    return f"({joined(f'sum({whole(x)})')} / CAST(nullif(count({x}), 0) AS DOUBLE))"


def fstd(x: str) -> str:
    return f"stddev_samp({x})"


def davg(x: str) -> str:
    return favg(f"CAST({x} AS DOUBLE)")


def pct(part: str, whole: str) -> str:
    return f"(CASE WHEN ({whole}) > 0 THEN ({part}) * 1e2 / ({whole}) ELSE 0e0 END)"


def cif(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"


TELEMETRY = """
SELECT event_id AS seq,
  TIMESTAMP '2024-01-01 00:00:00'
    + to_days(CAST(event_id % 4 AS INTEGER)) + to_seconds(5 * (event_id // 10)) AS "timestamp",
  concat('EV_', lpad(CAST(user_id % 10 + 1 AS VARCHAR), 3, '0')) AS vehicle_id,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_type = 'signup' THEN 0e0 ELSE value * 2e0 END AS speed,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(180 + (event_id * 37) % 300 AS DOUBLE) END AS battery_voltage,
  CAST((event_id * 53) % 440 - 220 AS DOUBLE) AS battery_current,
  CAST((event_id * 29) % 90 - 25 AS DOUBLE) AS battery_temperature,
  CAST((event_id * 31) % 180 - 25 AS DOUBLE) AS motor_temperature,
  CAST((event_id * 97) % 16000 AS DOUBLE) AS motor_rpm,
  CASE WHEN event_id % 59 = 0 THEN NULL ELSE CAST((event_id * 17) % 101 AS DOUBLE) END AS soc,
  CAST((event_id * 13) % 105 AS DOUBLE) AS throttle,
  CAST((event_id * 7) % 11 AS DOUBLE) / 10e0 AS brake,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS charging_status,
  value / 2e0 AS energy_consumption,
  CAST(15 + (event_id * 19) % 20 AS DOUBLE) AS cabin_temperature,
  29e0 + CAST(event_id % 400 AS DOUBLE) / 100e0 AS latitude,
  102e0 + CAST((event_id * 3) % 400 AS DOUBLE) / 100e0 AS longitude
FROM events
"""

# The same records of a finer instrument.
FINE = f"""SELECT * REPLACE (speed / 7e0 AS speed, battery_voltage * 3e0 / 7e0 + 2e2 AS battery_voltage,
  battery_current / 7e4 AS battery_current) FROM ({TELEMETRY})"""

STATUS = """
CASE WHEN speed = 0 THEN 'idle' WHEN speed < 60 THEN 'normal' WHEN speed < 100 THEN 'fast' ELSE 'highway' END AS driving_status,
CASE WHEN energy_consumption < 10 THEN 'A_excellent' WHEN energy_consumption < 15 THEN 'B_good' WHEN energy_consumption < 20 THEN 'C_average' ELSE 'D_poor' END AS energy_category,
CASE WHEN battery_temperature < 10 THEN 'cold' WHEN battery_temperature < 30 THEN 'normal' WHEN battery_temperature < 45 THEN 'warm' ELSE 'hot' END AS temp_status,
CASE WHEN soc < 20 THEN 'low_power' WHEN soc > 80 THEN 'high_power' WHEN battery_temperature > 45 THEN 'high_temp_warning' ELSE 'normal' END AS battery_status
"""

POWER = f"""
battery_voltage * battery_current / 1e3 AS power_kw,
battery_voltage * abs(battery_current) / 1e3 AS gross_power_kw,
battery_voltage * abs(battery_current) / 1e3 * {HOURS} AS energy_kwh,
speed * {HOURS} AS distance_km,
CASE WHEN speed > 0 THEN speed * {HOURS} ELSE 0e0 END AS driven_km,
CASE WHEN battery_current < 0 THEN abs(battery_voltage * battery_current / 1e3) * {HOURS} ELSE 0e0 END AS recovered_kwh,
CASE WHEN battery_current > 0 THEN battery_voltage * battery_current / 1e3 * {HOURS} ELSE 0e0 END AS consumed_kwh
"""
FLAGS = "battery_temperature > 45 AS is_high_temp, speed > 0 AS is_driving"


def clip(c: str) -> str:
    lo, hi = PHYSICAL_RANGES[c]
    return f"CASE WHEN {c} < {lo} THEN {lo}e0 WHEN {c} > {hi} THEN {hi}e0 ELSE {c} END"


def clipped_fields() -> str:
    cols = [f"{clip(c)} AS {c}" if c in PHYSICAL_RANGES else c for c in NUMERIC]
    return ", ".join(['seq, "timestamp", vehicle_id', *cols])


VEHICLE = 'PARTITION BY vehicle_id ORDER BY "timestamp", seq'
UPTO = f"OVER ({VEHICLE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
FROM_ON = f"OVER ({VEHICLE} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"

CTES = {
    "telemetry": TELEMETRY,
    "written": """SELECT * REPLACE (CASE WHEN seq % 97 <> 0 THEN
        "timestamp" + to_microseconds(100000 * (seq % 7)) END AS "timestamp") FROM telemetry""",
    "uniq": """SELECT * FROM telemetry
        QUALIFY row_number() OVER (PARTITION BY vehicle_id, "timestamp" ORDER BY seq) = 1""",
    "filled": f"""SELECT * REPLACE (
        last_value(speed IGNORE NULLS) {UPTO} AS speed,
        last_value(soc IGNORE NULLS) {UPTO} AS soc,
        coalesce(battery_voltage, (SELECT median(battery_voltage) FROM uniq)) AS battery_voltage)
        FROM uniq""",
    "cleaned": f"SELECT {clipped_fields()} FROM filled",
    "changes": f"""SELECT *, CAST("timestamp" AS DATE) AS date,
        (speed - lag(speed) OVER w) / ((epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w)) / 1e6 + 1e-3) AS accel,
        charging_status - lag(charging_status) OVER w AS d_status,
        abs(soc - lag(soc) OVER w) AS d_soc
        FROM cleaned WINDOW w AS ({VEHICLE})""",
    "sums": f"""SELECT vehicle_id, date,
        {fsum("battery_voltage * abs(battery_current)")} AS gross,
        {fsum("CASE WHEN battery_current < 0 THEN abs(battery_voltage * battery_current) END")} AS rec,
        {fsum("CASE WHEN battery_current > 0 THEN battery_voltage * battery_current END")} AS con,
        {fsum("speed")} AS dist,
        {fsum("CASE WHEN speed > 0 THEN speed END")} AS driven,
        {cif("speed > 0")} AS driving,
        {cif("battery_temperature > 45")} AS hot,
        {cif("accel > 5")} AS rapid,
        {cif("d_status = 1")} AS charges,
        {cif("d_soc > 20")} AS cycles,
        {r(favg("speed"), 2)} AS average_speed, {r("max(speed)", 2)} AS max_speed,
        {r("min(speed)", 2)} AS min_speed, {r(fstd("speed"), 2)} AS speed_std
        FROM changes GROUP BY vehicle_id, date""",
    "daily": f"""SELECT vehicle_id, date, total_energy_kwh, total_distance_km,
        {pct("total_energy_kwh", "total_distance_km")} AS daily_energy_consumption,
        rapid AS rapid_acceleration_count,
        hot * {HOURS} AS high_temp_duration_hours,
        driven * {HOURS} AS total_mileage_km,
        driving * {HOURS} AS driving_time_hours,
        charges AS charging_frequency,
        average_speed, max_speed, min_speed, speed_std,
        total_recovered_energy, total_consumed_energy,
        {r(pct("total_recovered_energy", "total_consumed_energy"), 2)} AS brake_energy_recovery_rate,
        {r(f"least(greatest(1e2 - hot * {HOURS} * 1e-1 - cycles * 1e-2, 0e0), 1e2)", 2)} AS battery_health_index,
        cycles AS soc_cycles
        FROM (SELECT *, gross / 1e3 * {HOURS} AS total_energy_kwh,
            dist * {HOURS} AS total_distance_km,
            rec / 1e3 * {HOURS} AS total_recovered_energy,
            con / 1e3 * {HOURS} AS total_consumed_energy FROM sums)""",
}
DEPENDS = {
    "telemetry": [],
    "written": ["telemetry"],
    "uniq": ["telemetry"],
    "filled": ["uniq"],
    "cleaned": ["filled"],
    "changes": ["cleaned"],
    "sums": ["changes"],
    "daily": ["sums"],
}


def _closure(name: str) -> list[str]:
    out: list[str] = []
    for d in DEPENDS[name]:
        out += [x for x in _closure(d) if x not in out]
    return [*out, name]


def q(base: str, body: str, **more: str) -> str:
    """The statement with every common table it builds on."""
    parts = [f"{n} AS ({CTES[n]})" for n in _closure(base)]
    parts += [f"{n} AS ({sql})" for n, sql in more.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


ALL = ", ".join(["seq", '"timestamp"', *FIELDS[1:]])
KEY3 = 'seq, "timestamp", vehicle_id'
DATED = 'CAST("timestamp" AS DATE) AS date'


def metric_sql(name: str) -> str:
    return q("daily", f"SELECT vehicle_id, date, {', '.join(METRIC_COLUMNS[name])} FROM daily")


def rates(col: str) -> str:
    return f"{r(pct(f'CAST({col} AS DOUBLE)', 'count(*)'), 2)}"


def out(c: str) -> str:
    lo, hi = PHYSICAL_RANGES[c]
    return f"({c} < {lo} OR {c} > {hi})"


def total_out(table: str) -> str:
    return " + ".join(f"count(*) FILTER (WHERE {out(c)})" for c in PHYSICAL_RANGES)


def completeness_expr() -> str:
    nulls = " + ".join(f'count(*) FILTER (WHERE "{c}" IS NULL)' for c in FIELDS)
    return nulls


def union_rows(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def iqr_cte(table: str, columns: list[str]) -> str:
    cols = []
    for c in columns:
        cols += [f"quantile_cont({c}, 0.25) AS q1_{c}", f"quantile_cont({c}, 0.75) AS q3_{c}"]
    return f"SELECT {', '.join(cols)} FROM {table}"


def fence(c: str) -> tuple[str, str]:
    return (
        f"(q1_{c} - 1.5e0 * (q3_{c} - q1_{c}))",
        f"(q3_{c} + 1.5e0 * (q3_{c} - q1_{c}))",
    )


def iqr_rows() -> str:
    parts = []
    for c in NUMERIC:
        lo, hi = fence(c)
        n = f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi})"
        parts.append(
            f"""SELECT '{c}' AS column_name, any_value({r(f'q1_{c}', 2)}) AS q1,
            any_value({r(f'q3_{c}', 2)}) AS q3, any_value({r(f'q3_{c} - q1_{c}', 2)}) AS iqr,
            any_value({r(lo, 2)}) AS lower_bound, any_value({r(hi, 2)}) AS upper_bound,
            {n} AS outlier_count, {rates(n)} AS outlier_rate FROM telemetry, bounds"""
        )
    return f"SELECT * FROM ({union_rows(parts)}) WHERE outlier_count > 0"


def physical_rows(extra: str = "", table: str = "telemetry") -> str:
    parts = []
    for c, (lo, hi) in PHYSICAL_RANGES.items():
        n = f"count(*) FILTER (WHERE {out(c)})"
        parts.append(
            f"""SELECT '{c}' AS column_name, {lo}e0 AS lower_bound, {hi}e0 AS upper_bound,
            {n} AS outlier_count, {rates(n)} AS outlier_rate FROM {table}"""
        )
    return union_rows(parts)


def null_rows(table: str = "telemetry") -> str:
    parts = []
    for c in FIELDS:
        n = f'count(*) FILTER (WHERE "{c}" IS NULL)'
        parts.append(
            f"SELECT '{c}' AS column_name, {n} AS null_count, {rates(n)} AS null_rate FROM {table}"
        )
    return union_rows(parts)


COMPLETE = r(f"(1e0 - CAST({completeness_expr()} AS DOUBLE) / (count(*) * 16)) * 1e2", 2)
DUP_RATE = r(pct("CAST(sum(n - 1) AS DOUBLE)", "sum(n)"), 2)
PER_KEY = 'SELECT vehicle_id, "timestamp", count(*) AS n FROM telemetry GROUP BY ALL'


def counters() -> str:
    parts = [
        """SELECT 'deduplication' AS step, 'vehicle_id,timestamp' AS column_name,
        'keep_first' AS method, CAST(NULL AS DOUBLE) AS value,
        (SELECT count(*) FROM telemetry) AS count_before, (SELECT count(*) FROM uniq) AS count_after"""
    ]
    for c, method, value in (
        ("speed", "forward_fill", "CAST(NULL AS DOUBLE)"),
        ("battery_voltage", "median_fill", "(SELECT median(battery_voltage) FROM uniq)"),
        ("soc", "forward_fill", "CAST(NULL AS DOUBLE)"),
    ):
        parts.append(
            f"""SELECT 'null_filling', '{c}', '{method}', {value},
            (SELECT count(*) FROM uniq WHERE {c} IS NULL),
            (SELECT count(*) FROM filled WHERE {c} IS NULL)"""
        )
    for c in PHYSICAL_RANGES:
        parts.append(
            f"""SELECT 'outlier_handling', '{c}', 'clip', NULL,
            (SELECT count(*) FROM filled WHERE {out(c)}),
            (SELECT count(*) FROM cleaned WHERE {out(c)})"""
        )
    return (
        f"SELECT * FROM ({union_rows(parts)})"
        " WHERE (step = 'null_filling' AND count_before > 0) OR step = 'deduplication'"
        " OR (step = 'outlier_handling' AND count_before > 0)"
    )


def window_select(end: str, several: str = "true") -> str:
    """Columns of one window out of f_* (first), l_* (last) and its sums."""
    dur = "coalesce(nullif((epoch_us(l_ts) - epoch_us(f_ts)) / 1e6, 0), 1e0)"

    def ps(c: str, factor: str = "1e0") -> str:
        return f"CASE WHEN {several} THEN {r(f'(l_{c} - f_{c}) / {dur} * {factor}', 4)} END"

    return f"""{end} AS window_end_time, vehicle_id, {dur} AS window_duration,
      CAST(n AS BIGINT) AS record_count,
      {r("l_bv * l_bc / 1e3", 2)} AS instantaneous_power,
      {ps("bt")} AS battery_temp_rate, {ps("mt")} AS motor_temp_rate,
      {r(joined("sp_sum") + " / CAST(nullif(sp_n, 0) AS DOUBLE)", 2)} AS avg_speed,
      {r("sp_max", 2)} AS max_speed, {r("sp_min", 2)} AS min_speed,
      {ps("soc", "3.6e3")} AS soc_rate, l_soc AS latest_soc,
      {r(joined("e_sum") + " / 1e3 * 5e0 / 3.6e3", 4)} AS energy_consumed,
      l_bt AS battery_temperature, l_mt AS motor_temperature,
      l_bv AS battery_voltage, l_bc AS battery_current"""


SHORT = {
    "ts": '"timestamp"', "bt": "battery_temperature", "mt": "motor_temperature",
    "soc": "soc", "bv": "battery_voltage", "bc": "battery_current",
}
GROSS = whole("battery_voltage * abs(battery_current)")


def frames(table: str = "cleaned") -> str:
    frame = f"OVER ({VEHICLE} ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)"
    short = f"OVER ({VEHICLE} ROWS BETWEEN 98 PRECEDING AND CURRENT ROW)"
    edges = [f"first_value({c}) {frame} AS f_{k}" for k, c in SHORT.items()]
    edges += [f"{c} AS l_{k}" for k, c in SHORT.items()]
    return f"""SELECT vehicle_id, seq, rn, {", ".join(edges)},
      count(*) {frame} AS n, coalesce(sum({whole("speed")}) {frame}, 0) AS sp_sum,
      count(speed) {frame} AS sp_n, max(speed) {frame} AS sp_max, min(speed) {frame} AS sp_min,
      coalesce(sum(CASE WHEN rn > 1 THEN {GROSS} END) {short}, 0) AS e_sum
      FROM (SELECT *, row_number() OVER ({VEHICLE}) AS rn FROM {table})"""


LAST100 = q(
    "cleaned",
    f"SELECT seq, {window_select('l_ts')} FROM frames WHERE rn > 1",
    frames=frames(),
)


def sliding(size: int) -> str:
    w = 'PARTITION BY vehicle_id, ws ORDER BY "timestamp", seq'
    edges = [f"first_value({c}) OVER ({w}) AS f_{k}" for k, c in SHORT.items()]
    edges += [f"{c} AS l_{k}" for k, c in SHORT.items()]
    run = f"OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    inner = f"""SELECT vehicle_id, ws, {", ".join(edges)},
      row_number() OVER ({w}) AS n, count(*) OVER (PARTITION BY vehicle_id, ws) AS total,
      coalesce(sum({whole("speed")}) {run}, 0) AS sp_sum, count(speed) {run} AS sp_n,
      max(speed) {run} AS sp_max, min(speed) {run} AS sp_min,
      coalesce(sum({GROSS}) {run}, 0) - coalesce(first_value({GROSS}) OVER ({w}), 0) AS e_sum
      FROM (SELECT *, "timestamp" - to_seconds(CAST(i AS INTEGER)) AS ws
            FROM cleaned, range({size}) t(i))"""
    return q(
        "cleaned",
        f"SELECT ws AS window_start, {window_select(f'ws + to_seconds({size})', 'n > 1')}"
        " FROM windows WHERE n = total",
        windows=inner,
    )


PAIRS = q(
    "cleaned",
    f"""SELECT "timestamp", vehicle_id, seq,
      {r("battery_voltage * battery_current / 1e3", 2)} AS instantaneous_power_kw,
      soc, battery_temperature AS battery_temp, motor_temperature AS motor_temp, speed,
      CASE WHEN dt > 0 THEN {r("d_bt / dt", 4)} END AS battery_temp_rate,
      CASE WHEN dt > 0 THEN {r("d_mt / dt", 4)} END AS motor_temp_rate,
      CASE WHEN dt > 0 THEN {r("d_soc / dt * 3.6e3", 4)} END AS soc_rate_per_hour
      FROM (SELECT *, CASE WHEN lag(seq) OVER w IS NOT NULL THEN
        coalesce((epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w)) / 1e6, 5e0) END AS dt,
        battery_temperature - lag(battery_temperature) OVER w AS d_bt,
        motor_temperature - lag(motor_temperature) OVER w AS d_mt,
        soc - lag(soc) OVER w AS d_soc FROM cleaned WINDOW w AS ({VEHICLE}))""",
)

VALUES = list(dict.fromkeys(c for own in METRIC_COLUMNS.values() for c in own))


def spread(c: str) -> str:
    return (
        f"{r(davg(c), 2)} AS mean, {r(f'CAST(min({c}) AS DOUBLE)', 2)} AS min,"
        f" {r(f'CAST(max({c}) AS DOUBLE)', 2)} AS max"
    )


SUMMARY = union_rows(
    [
        f"""SELECT '{m}' AS metric, '{c}' AS column_name, {spread(c)},
        {r(f"stddev_samp({c})", 2)} AS std, {r(f"CAST(median({c}) AS DOUBLE)", 2)} AS median
        FROM daily"""
        for m, own in METRIC_COLUMNS.items()
        for c in own
    ]
)
RANGES = union_rows([f"SELECT '{c}' AS column_name, {spread(c)} FROM daily" for c in VALUES])
CARDS = union_rows(
    [
        f"SELECT '{m}' AS metric, '{own[0]}' AS column_name, {r(davg(own[0]), 2)} AS value,"
        f" '{METRIC_UNITS[m]}' AS unit FROM daily"
        for m, own in METRIC_COLUMNS.items()
    ]
)
PROFILE = union_rows(
    [
        f"""SELECT '{c}' AS column_name, count({c}) AS value_count, {r(favg(c), 4)} AS mean,
        {r(fstd(c), 4)} AS std, CAST(min({c}) AS DOUBLE) AS min,
        CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS q25, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS q50,
        CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM telemetry"""
        for c in NUMERIC
    ]
)
UNION = union_rows(
    [
        "SELECT vehicle_id, date, "
        + ", ".join(c if c in own else f"NULL AS {c}" for c in VALUES)
        + f", '{m}' AS metric_name, '2024-02-01 00:00:00' AS update_time FROM daily"
        for m, own in METRIC_COLUMNS.items()
    ]
)
CLEANED = q("cleaned", f"SELECT {ALL}, {DATED} FROM cleaned")
DETAIL = q("cleaned", f"SELECT {ALL}, {DATED}, {STATUS} FROM cleaned")
DAILY = q("daily", "SELECT * FROM daily")


def outliers_null() -> str:
    cols = [
        f"CASE WHEN NOT {out(c)} THEN {c} END AS {c}" if c in PHYSICAL_RANGES else c
        for c in NUMERIC
    ]
    return q("uniq", f"SELECT {KEY3}, {', '.join(cols)}, {DATED} FROM uniq")


def outliers_removed() -> str:
    keep = " AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in PHYSICAL_RANGES.items())
    return q("uniq", f"SELECT {ALL}, {DATED} FROM uniq WHERE {keep}")


def clip_iqr() -> str:
    cols = []
    for c in NUMERIC:
        if c in PHYSICAL_RANGES:
            lo, hi = fence(c)
            cols.append(f"CASE WHEN {c} < {lo} THEN {lo} WHEN {c} > {hi} THEN {hi} ELSE {c} END AS {c}")
        else:
            cols.append(c)
    return q(
        "uniq",
        f"SELECT {KEY3}, {', '.join(cols)}, {DATED} FROM uniq, bounds",
        bounds=iqr_cte("uniq", list(PHYSICAL_RANGES)),
    )


def fill(how: str) -> str:
    exprs = {
        "ffill": lambda c: f"last_value({c} IGNORE NULLS) {UPTO}",
        "bfill": lambda c: f"first_value({c} IGNORE NULLS) {FROM_ON}",
        "median": lambda c: f"coalesce({c}, (SELECT median({c}) FROM uniq))",
        "mean": lambda c: f"coalesce({c}, (SELECT {favg(c)} FROM uniq))",
        "zero": lambda c: f"coalesce({c}, 0e0)",
    }
    cols = [f"{exprs[how](c)} AS {c}" for c in ("speed", "battery_voltage", "soc")]
    return q("uniq", f"SELECT {KEY3}, {', '.join(cols)} FROM uniq")


PLACED = 'PARTITION BY vehicle_id ORDER BY place NULLS FIRST, "timestamp" IS NULL, seq'
UNIQUE = 'QUALIFY row_number() OVER (PARTITION BY vehicle_id, "timestamp" ORDER BY seq) = 1'


def with_unread(sql: str) -> str:
    """The same over records some of whose times are unread: those stand behind the newest time read before them."""
    written = f"""SELECT *, coalesce("timestamp", max("timestamp") OVER (PARTITION BY vehicle_id ORDER BY seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS place FROM (
        SELECT * REPLACE (CASE WHEN seq % 97 <> 0 THEN "timestamp" + to_microseconds(100000 * (seq % 7)) END AS "timestamp")
        FROM ({TELEMETRY}))"""
    cleaned = CTES["cleaned"]
    sql = sql.replace(TELEMETRY, written).replace(VEHICLE, PLACED).replace(UNIQUE, UNIQUE + ' OR "timestamp" IS NULL')
    return sql.replace(cleaned, cleaned.replace(" FROM filled", ", place FROM filled"))


def late_records() -> str:
    """Every tenth record comes a third of all time late: late if a later one of its vehicle came in time."""
    return q(
        "cleaned",
        f"""SELECT {ALL}, {DATED} FROM numbered d WHERE seq % 10 = 0 AND "timestamp" < (SELECT max("timestamp") FROM numbered n
        WHERE n.vehicle_id = d.vehicle_id AND n.seq % 10 <> 0 AND n.slice <= d.slice)""",
        span="""SELECT min("timestamp") AS lo, epoch_us(max("timestamp") - min("timestamp")) // 1000000 // 3 + 1 AS width FROM cleaned""",
        numbered="""SELECT *, epoch_us("timestamp" - lo) // 1000000 // width AS slice FROM cleaned, span""",
    )


BROKEN = """CASE WHEN seq % 89 = 0 THEN concat('{"seq":', seq, ',"speed') ELSE concat('no record ', seq) END"""


def fine(sql: str) -> str:
    return sql.replace(TELEMETRY, FINE)


def oracles() -> dict[str, str]:
    report = {
        "completeness": q(
            "telemetry",
            f"""SELECT count(*) AS total_records, count(*) * 16 AS total_cells,
            {completeness_expr()} AS null_cells, {COMPLETE} AS completeness FROM telemetry""",
        ),
        "null_rates": q("telemetry", null_rows()),
        "duplicates": q(
            "telemetry",
            f"""SELECT CAST(sum(n) AS BIGINT) AS total_records,
            CAST(sum(n - 1) AS BIGINT) AS duplicate_count, {DUP_RATE} AS duplicate_rate FROM k""",
            k=PER_KEY,
        ),
        "duplicate_examples": q(
            "telemetry",
            f"""SELECT {ALL}, {DATED} FROM telemetry QUALIFY
            count(*) OVER (PARTITION BY vehicle_id, "timestamp") > 1 ORDER BY seq LIMIT 5""",
        ),
        "iqr_outliers": q("telemetry", iqr_rows(), bounds=iqr_cte("telemetry", NUMERIC)),
        "physical_outliers": q("telemetry", physical_rows()),
        "outlier_totals": q(
            "telemetry",
            f"""SELECT CAST({total_out("telemetry")} AS BIGINT) AS total_physical_outliers,
            {rates("(" + total_out("telemetry") + ")")} AS total_physical_outlier_rate FROM telemetry""",
        ),
        "cleaning_counters": q("cleaned", counters()),
        "improvement": q(
            "cleaned",
            f"""SELECT {r("a.c - b.c", 2)} AS completeness_improved,
            CAST((SELECT sum(n - 1) FROM k) AS BIGINT) AS duplicates_removed,
            b.o AS outliers_handled, a.n AS final_record_count FROM
            (SELECT {COMPLETE} AS c, count(*) AS n FROM cleaned) a,
            (SELECT {COMPLETE} AS c, CAST({total_out("telemetry")} AS BIGINT) AS o FROM telemetry) b""",
            k=PER_KEY,
        ),
        "quality_gate": q(
            "telemetry",
            """SELECT *, completeness >= 99 AS complete_enough, duplicate_rate <= 5 AS unique_enough,
            completeness >= 99 AND duplicate_rate <= 5 AS passed FROM f""",
            f=f"""SELECT (SELECT {COMPLETE} FROM telemetry) AS completeness,
            (SELECT {DUP_RATE} FROM ({PER_KEY})) AS duplicate_rate""",
        ),
        "quality_stats": q(
            "cleaned",
            f"""SELECT (SELECT count(*) FROM telemetry) AS original_count,
            (SELECT count(*) FROM cleaned) AS final_count,
            (SELECT {COMPLETE} FROM cleaned) AS completeness,
            (SELECT {DUP_RATE} FROM ({PER_KEY})) AS duplicate_rate""",
        ),
    }
    report["latest_report"] = report["quality_stats"]
    batch = {
        "telemetry": q("telemetry", f"SELECT {ALL}, {DATED} FROM telemetry"),
        "derive_status": q("uniq", f"SELECT {KEY3}, {STATUS} FROM uniq"),
        "derive_power": q("uniq", f"SELECT {KEY3}, {POWER}, {FLAGS} FROM uniq"),
        "speed_acceleration": q("changes", f"SELECT {KEY3}, accel AS speed_acceleration FROM changes"),
        "dedup": q("uniq", f"SELECT {ALL}, {DATED} FROM uniq"),
        "written_times": q("written", f"SELECT {ALL}, {DATED} FROM written"),
        "written_dedup": q(
            "written",
            f"""SELECT {ALL}, {DATED} FROM written QUALIFY "timestamp" IS NULL
            OR row_number() OVER (PARTITION BY vehicle_id, "timestamp" ORDER BY seq) = 1""",
        ),
        "written_duplicates": q(
            "written",
            f"""SELECT CAST(sum(n) AS BIGINT) AS total_records,
            CAST(sum(CASE WHEN "timestamp" IS NULL THEN 0 ELSE n - 1 END) AS BIGINT) AS duplicate_count,
            {r(pct('CAST(sum(CASE WHEN "timestamp" IS NULL THEN 0 ELSE n - 1 END) AS DOUBLE)', "sum(n)"), 2)} AS duplicate_rate FROM k""",
            k='SELECT vehicle_id, "timestamp", count(*) AS n FROM written GROUP BY ALL',
        ),
        "ffill": fill("ffill"),
        "bfill": fill("bfill"),
        "fill_median": fill("median"),
        "fill_mean": fill("mean"),
        "fill_zero": fill("zero"),
        "clip": q("uniq", f"SELECT {clipped_fields()}, {DATED} FROM uniq"),
        "remove_outliers": outliers_removed(),
        "null_outliers": outliers_null(),
        "clip_iqr": clip_iqr(),
        "clean_all": CLEANED,
        "detail_layer": DETAIL,
        "daily_energy": metric_sql("daily_energy_consumption"),
        "rapid_acceleration": metric_sql("rapid_acceleration_count"),
        "high_temp": metric_sql("high_temp_duration"),
        "daily_mileage": metric_sql("daily_mileage"),
        "charging_frequency": metric_sql("charging_frequency"),
        "average_speed": metric_sql("average_speed"),
        "brake_recovery": metric_sql("brake_energy_recovery_rate"),
        "battery_health": metric_sql("battery_health_index"),
        "soc_join": metric_sql("battery_health_index"),
        "daily_metrics": DAILY,
        "dws_union": q("daily", UNION),
        "window_last100": LAST100,
        "latest_per_vehicle": q(
            "cleaned",
            f"""SELECT {window_select("l_ts")} FROM frames WHERE n > 1
            QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY rn DESC) = 1""",
            frames=frames(),
        ),
        "pairwise_metrics": PAIRS,
        "sliding_5s": sliding(5),
        "sliding_30s": sliding(30),
        # "default" covers every column with nulls, so the unread times are filled, too.
        "written_ffill": with_unread(fill("ffill").replace(f"SELECT {KEY3}, last", 'SELECT seq, place AS "timestamp", vehicle_id, last')),
        "written_pairs": with_unread(PAIRS),
        "written_windows": with_unread(LAST100),
        "fine_daily": fine(DAILY),
        "fine_windows": fine(LAST100),
        "fine_mean": fine(fill("mean")),
        "fine_profile": fine(q("telemetry", PROFILE)),
    }
    top = "SELECT vehicle_id, count(*) AS record_count FROM cleaned GROUP BY vehicle_id"
    reports = {
        "summary_statistics": q("daily", SUMMARY),
        "vehicle_summary": q(
            "daily",
            "SELECT vehicle_id, "
            + ", ".join(f"{davg(c)} AS {c}" for c in VALUES[:5])
            + " FROM daily GROUP BY vehicle_id",
        ),
        "metric_ranges": q("daily", RANGES),
        "records_per_day": q(
            "cleaned", f"SELECT vehicle_id, {DATED}, count(*) AS record_count FROM cleaned GROUP BY ALL"
        ),
        "top_vehicles": q("cleaned", top + " ORDER BY record_count DESC, vehicle_id LIMIT 10"),
        "daily_trend": q(
            "daily",
            "SELECT date, " + ", ".join(f"{davg(c)} AS {c}" for c in VALUES) + " FROM daily GROUP BY date",
        ),
        "vehicle_distribution": q(
            "daily",
            "SELECT vehicle_id, "
            + ", ".join(f"{davg(c)} AS {c}" for c in VALUES)
            + " FROM daily GROUP BY vehicle_id",
        ),
        "metric_cards": q("daily", CARDS),
        "null_ranking": q(
            "telemetry",
            f"SELECT * FROM ({null_rows()}) WHERE null_rate > 0"
            " ORDER BY null_rate DESC, column_name LIMIT 10",
        ),
        "outlier_share": q(
            "telemetry",
            f"""SELECT *, {r("outlier_count * 1e2 / sum(outlier_count) OVER ()", 2)} AS share
            FROM ({physical_rows()}) WHERE outlier_count > 0""",
        ),
        "overview": q(
            "cleaned",
            f"""SELECT (SELECT count(*) FROM telemetry) AS ods_rows, count(*) AS dwd_rows,
            CAST(8 AS BIGINT) AS metric_count, {COMPLETE} AS completeness FROM cleaned""",
        ),
        "profile": q("telemetry", PROFILE),
        "value_counts": q(
            "telemetry",
            "SELECT vehicle_id, count(*) AS record_count FROM telemetry GROUP BY vehicle_id",
        ),
        "latest_points": q(
            "telemetry",
            f'SELECT {ALL}, {DATED} FROM telemetry ORDER BY "timestamp" DESC, seq DESC LIMIT 100',
        ),
        "head_n": q("telemetry", f"SELECT {ALL}, {DATED} FROM telemetry ORDER BY seq LIMIT 20"),
    }
    streams = {
        "stream_parse": q("telemetry", f"SELECT {ALL} FROM telemetry"),
        "stream_dedup": q("telemetry", 'SELECT DISTINCT vehicle_id, "timestamp" FROM telemetry'),
        "stream_derive": q(
            "uniq",
            f"SELECT {KEY3}, {STATUS}, {POWER}, {FLAGS} FROM (SELECT {clipped_fields()} FROM uniq)",
        ),
        "stream_sliding": sliding(5),
        "stream_last100": LAST100,
        "stream_pairwise": PAIRS,
        "stream_late": LAST100,
        "stream_late_records": late_records(),
        "stream_roundtrip": LAST100,
        "written_stream": with_unread(LAST100),
        "stream_letters": q("telemetry", f"SELECT {ALL} FROM telemetry WHERE seq % 89 <> 0 AND seq % 97 <> 0"),
        "stream_dead_letters": q("telemetry", f"SELECT {BROKEN} AS line FROM telemetry WHERE seq % 89 = 0 OR seq % 97 = 0"),
    }
    sinks = {
        "message_roundtrip": q("telemetry", f"SELECT {ALL} FROM telemetry"),
        "sink_roundtrip_parquet": DETAIL,
        "sink_roundtrip_csv": CLEANED,
        "sink_metrics": q("daily", UNION),
        "newest_file": q("telemetry", f"SELECT {ALL}, {DATED} FROM telemetry WHERE speed IS NOT NULL"),
        "warehouse_layers": DAILY,
        "delivered_details": DETAIL,
        "delivered_metrics": DAILY,
        "delivered_windows": LAST100,
    }
    return {**batch, **report, **reports, **streams, **sinks}

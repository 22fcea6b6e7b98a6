"""The catalogue's queries as plain SQL over the same tables, written independently of Spark.

Lateness is spelled out literally here (a running maximum over each partition in dense offset
order), wire bytes by integer arithmetic, and synthetic draws by the public XXH64 definition.
"""

from __future__ import annotations

_K = "cast(json_extract_string(props, '$.k') AS int)"
_DELAY = "((event_id * 7919) % 200)"

_TX = f"""tx AS (
  SELECT event_id, user_id, concat('tx', event_id::varchar) AS transaction_id,
         concat('prod_', user_id::varchar) AS product_id, event_type AS category,
         cast(1 + {_K} % 10 AS int) AS quantity, cast(value AS decimal(10,2)) AS price, ts,
         cast(length(event_type) % 3 AS int) AS part,
         (event_id + {_DELAY}) * 200 + 199 - {_DELAY} AS sparse_offset,
         row_number() OVER (PARTITION BY length(event_type) % 3
                            ORDER BY event_id + {_DELAY}, event_id) AS place
  FROM events)"""

_TEL = f"""tel AS (
  SELECT concat('sensor_', user_id::varchar) AS sensor_id,
         15.0::double + (cast(round(value * 100) AS bigint) % 3501) / 100.0::double AS temperature,
         (5 + {_K} % 66) / 100.0::double AS humidity,
         cast(40 + user_id % 51 AS double) AS soil_fertility,
         epoch_us(ts) // 1000000 AS "timestamp"
  FROM events)"""


def _branch(label: str, condition: str, text: str) -> str:
    return f"""SELECT sensor_id, '{label}' AS alert_type, "timestamp", '{text}' AS details
               FROM tel WHERE {condition}"""


def _hot(limit: str = "35.0") -> str:
    return _branch("HIGH_TEMPERATURE", f"temperature > {limit}::double", f"Temperature exceeded {limit}°C")


def _dry(condition: str = "humidity < 0.2::double", percent: str = "20.0") -> str:
    return _branch("LOW_HUMIDITY", condition, f"Humidity is below {percent}%")


def _alerts(*branches: str) -> str:
    return f"WITH {_TEL} " + " UNION ALL ".join(branches)


def _totals(rows: str, minutes: int, key: str = "category", where: str = "true") -> str:
    return f"""SELECT category, sum(quantity)::bigint AS total_quantity, cast(sum(price) AS double) AS total_revenue,
               epoch_ms(w) AS window_start, epoch_ms(w) + {minutes * 60000} AS window_end
        FROM (SELECT {key} AS category, quantity, price,
                     time_bucket(INTERVAL '{minutes} minutes', ts, TIMESTAMP '1970-01-01') AS w
              FROM {rows} WHERE {where}) GROUP BY category, w"""


def _summary(minutes: int, key: str = "category", where: str = "true") -> str:
    return f"WITH {_TX} " + _totals("tx", minutes, key, where)


def _timed(minutes: int, where: str = "true") -> str:
    return f"""{_TX}, timed AS (
  SELECT *, max(ts) OVER (PARTITION BY part ORDER BY place ROWS UNBOUNDED PRECEDING) AS stream_time,
         time_bucket(INTERVAL '{minutes} minutes', ts, TIMESTAMP '1970-01-01')
           + INTERVAL '{minutes} minutes' AS ends
  FROM tx WHERE {where})"""


def _strict(minutes: int, where: str = "true") -> str:
    return f"WITH {_timed(minutes, where)} " + _totals("timed", minutes, where="ends > stream_time")


_LAST_DAY = """last_day AS (
  SELECT category, max(window_start) AS window_start FROM daily GROUP BY category)"""

# The five primes of XXH64 and the seed Spark's xxhash64 starts from.
_P1 = 11400714785074694791
_P2 = 14029467366897019727
_P3 = 1609587929392839161
_P4 = 9650029242287828579
_P5 = 2870177450012600261
_SPARK_SEED = 42
_M = f"{2**64}::uhugeint"


def _mod(expression: str) -> str:
    return f"(({expression}) % {_M})"


def _times(a: str, prime: int) -> str:
    return _mod(f"({a}) * {prime}::uhugeint")


def _xor(a: str, b: str) -> str:
    return f"xor(({a})::ubigint, ({b})::ubigint)::uhugeint"


def _draws(seed: int, slots: int) -> str:
    """CTEs ending in ``draws(event_id, d0, d1, ...)``: unsigned 64-bit draws per row."""
    steps = []
    values = ", ".join(f"({i})" for i in range(slots))
    steps.append(
        f"s AS (SELECT event_id, slot, {_SPARK_SEED}::uhugeint AS h FROM events, (VALUES {values}) v(slot))"
    )
    source = "s"
    for i, word in enumerate(("event_id", str(seed), "slot")):
        lane = f"(({word})::uhugeint)"
        spun = _times(lane, _P2)
        names = [f"r{i}{c}" for c in "abcdefgh"]
        rotate = lambda x, n: f"{_mod(f'({x}) * {2**n}::uhugeint')} + ({x}) // {2**(64 - n)}::uhugeint"
        exprs = [
            _mod(f"h + {_P5}::uhugeint + 8::uhugeint"),
            _xor("h", _times(rotate(spun, 31), _P1)),
            _mod(f"{_times(rotate('h', 27), _P1)} + {_P4}::uhugeint"),
            _times(_xor("h", f"h // {2**33}::uhugeint"), _P2),
            _times(_xor("h", f"h // {2**29}::uhugeint"), _P3),
            _xor("h", f"h // {2**32}::uhugeint"),
        ]
        for name, expression in zip(names, exprs):
            steps.append(f"{name} AS (SELECT event_id, slot, {expression} AS h FROM {source})")
            source = name
    columns = ", ".join(f"max(h) FILTER (WHERE slot = {i}) AS d{i}" for i in range(slots))
    steps.append(f"draws AS (SELECT event_id, {columns} FROM {source} GROUP BY event_id)")
    return ", ".join(steps)


def _signed_mod(draw: str, n: int) -> str:
    """pmod of the draw read as a signed 64-bit number."""
    signed = f"({draw}::hugeint - CASE WHEN {draw} >= {2**63}::uhugeint THEN {2**64}::hugeint ELSE 0 END)"
    return f"((({signed} % {n}) + {n}) % {n})::bigint"


def _unit(draw: str) -> str:
    return f"(({draw} // 2048::uhugeint)::bigint::double * {2.0**-53!r}::double)"


def _range(draw: str, low: float, high: float) -> str:
    return f"({low!r}::double + {_unit(draw)} * {high - low!r}::double)"


def _digits(prefix: str, count: int, draw: str) -> str:
    number = _signed_mod(draw, 9**count)
    places = ", ".join(f"((({number}) // {9**i}) % 9 + 1)::varchar" for i in reversed(range(count)))
    return f"concat('{prefix}', {places})"


_SYNTH_TX = f"""{_draws(2, 5)}, synth AS (
  SELECT {_digits("tx", 5, "d0")} AS transaction_id, {_digits("prod_", 3, "d1")} AS product_id,
         ['fertilizers', 'seeds', 'pesticides', 'equipment', 'supplies', 'soil'][{_signed_mod("d2", 6)} + 1] AS category,
         (1 + {_signed_mod("d3", 9)})::int AS quantity,
         {_range("d4", 10.0, 200.0)}::float AS price
  FROM draws)"""


def _hex_varint(n: str) -> str:
    """Hex of the zigzag varint of a non-negative number below 2^34 (after doubling: 5 bytes)."""
    z = f"(2 * ({n})::bigint)"
    out = []
    for i in range(5):
        low = f"(({z} >> {7 * i}) & 127)"
        byte = f"({low} + CASE WHEN ({z} >> {7 * (i + 1)}) > 0 THEN 128 ELSE 0 END)"
        text = f"lpad(to_hex({byte}), 2, '0')"
        out.append(text if i == 0 else f"CASE WHEN ({z} >> {7 * i}) > 0 THEN {text} ELSE '' END")
    return " || ".join(f"({part})" for part in out)


def _hex_text(column: str) -> str:
    return f"{_hex_varint(f'octet_length(encode({column}))')} || hex({column})"


ORACLES: dict[str, str] = {
    "alerts_documented": _alerts(_hot(), _dry()),
    "alerts_as_coded": _alerts(_hot(), _dry("humidity > 0.2::double")),
    "alerts_custom_thresholds": _alerts(
        _hot("40.5"), _dry("humidity < 0.29::double", "28.999999999999996")
    ),
    "alert_temperature": _alerts(_hot()),
    "alert_humidity_below": _alerts(_dry()),
    "alert_humidity_above": _alerts(_dry("humidity > 0.2::double")),
    "alerts_union_twin": _alerts(_hot(), _dry()),
    "alerts_keyed": f"""WITH {_TEL}, a AS ({_hot()} UNION ALL {_dry()})
        SELECT sensor_id AS key, alert_type, "timestamp" FROM a""",
    "alerts_stream": _alerts(_hot(), _dry()),
    "summary_1min": _summary(1),
    "summary_7min": _summary(7),
    "summary_60min": _summary(60),
    "summary_1day": _summary(1440),
    "summary_null_key": _summary(60, "nullif(category, 'view')", "category <> 'view'"),
    "summary_keyed": f"""WITH {_TX}, s AS ({_totals("tx", 60)})
        SELECT category AS key, total_quantity, window_start FROM s""",
    "window_aggregate_60min": f"""WITH {_TX}
        SELECT category, epoch_ms(time_bucket(INTERVAL '60 minutes', ts, TIMESTAMP '1970-01-01')) AS window_start,
               count(*) AS sales, min(price)::double AS lowest, max(price)::double AS highest, max(quantity) AS largest
        FROM tx GROUP BY 1, 2""",
    "summary_strict_1min": _strict(1),
    "summary_strict_60min": _strict(60),
    "summary_strict_null_key": _strict(60, "category <> 'view'"),
    "summary_updates_60min": f"""WITH {_timed(60)}
        SELECT part AS "partition", sparse_offset AS "offset", category,
               cast(sum(quantity) OVER so_far AS bigint) AS total_quantity,
               cast(sum(price) OVER so_far AS double) AS total_revenue,
               epoch_ms(ends) - 3600000 AS window_start, epoch_ms(ends) AS window_end
        FROM timed WHERE ends > stream_time
        WINDOW so_far AS (PARTITION BY part, category, ends ORDER BY place ROWS UNBOUNDED PRECEDING)""",
    "summary_updates_ticks": f"""WITH {_timed(60)}, u AS (
        SELECT part, sparse_offset // 500000 AS tick, category, ends, place,
               cast(sum(quantity) OVER so_far AS bigint) AS total_quantity, cast(sum(price) OVER so_far AS double) AS total_revenue
        FROM timed WHERE ends > stream_time
        WINDOW so_far AS (PARTITION BY part, category, ends ORDER BY place ROWS UNBOUNDED PRECEDING))
        SELECT part AS "partition", tick, category, arg_max(total_quantity, place) AS total_quantity,
               arg_max(total_revenue, place) AS total_revenue, epoch_ms(ends) - 3600000 AS window_start, epoch_ms(ends) AS window_end
        FROM u GROUP BY part, tick, category, ends""",
    "summary_exact_double": f"""WITH {_TX} SELECT category, sum(quantity)::bigint AS total_quantity,
               sum((floor(price::double * 1048576)::bigint + sparse_offset % 1021)::hugeint)::double / 1048576 AS total_revenue,
               epoch_ms(w) AS window_start, epoch_ms(w) + 3600000 AS window_end
        FROM (SELECT *, date_trunc('hour', ts) AS w FROM tx) GROUP BY category, w""",
    "late_metrics_60min": f"""WITH {_timed(60)}, e AS (SELECT max(sparse_offset) + 1 AS n FROM tx)
        SELECT sparse_offset * 3 // n AS batch_id, count(*) FILTER (ends > stream_time) AS kept,
               count(*) FILTER (ends <= stream_time) AS late FROM timed, e GROUP BY 1""",
    "late_rows_60min": f"""WITH {_timed(60)}
        SELECT transaction_id, part AS "partition", sparse_offset AS "offset", epoch_us(ts) AS timestamp_us
        FROM timed WHERE ends <= stream_time""",
    "stream_time": f"""WITH {_timed(60)}
        SELECT part AS "partition", sparse_offset AS "offset", epoch_us(ts) AS timestamp_us,
               epoch_us(stream_time) AS stream_time_us FROM timed""",
    "summary_stream_update": _summary(1),
    "summary_stream_append": f"""WITH {_TX}, s AS ({_totals("tx", 1)})
        SELECT * FROM s WHERE window_end <= (SELECT max(epoch_us(ts)) // 1000 FROM tx)""",
    "summary_stream_strict": _strict(60),
    "summary_stream_batches": f"""WITH {_TX}, d AS (
        SELECT *, least(2, (ts >= TIMESTAMP '2024-01-11 12:00')::int + (ts >= TIMESTAMP '2024-01-21 12:00')::int
                           + (event_id % 10 = 0)::int) AS delivery FROM tx),
        seen AS (SELECT delivery, max(ts) AS latest FROM d GROUP BY 1),
        before AS (SELECT a.delivery, max(b.latest) AS latest FROM seen a LEFT JOIN seen b ON b.delivery < a.delivery GROUP BY 1),
        kept AS (SELECT d.* FROM d JOIN before USING (delivery)
                 WHERE latest IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > latest)
        {_totals("kept", 1440)}""",
    "summary_upsert_table": f"""WITH {_TX}, d AS (
        SELECT *, least(2, (ts >= TIMESTAMP '2024-01-11 12:00')::int + (ts >= TIMESTAMP '2024-01-21 12:00')::int
                           + (event_id % 10 = 0)::int) AS arrived FROM tx)
        SELECT category, sum(quantity)::bigint AS total_quantity, sum(price)::double AS total_revenue,
               epoch_ms(w) AS window_start, epoch_ms(w) + 3600000 AS window_end, delivery::int AS delivery
        FROM (SELECT d.*, delivery, date_trunc('hour', ts) AS w FROM d, range(3) r(delivery) WHERE arrived <= delivery)
        GROUP BY category, w, delivery""",
    "summary_stream_processor": _strict(60),
    "window_store_open": f"""WITH {_TX}, s AS ({_totals("tx", 1440)})
        SELECT * FROM s WHERE window_end > (SELECT max(epoch_us(ts)) // 1000 FROM tx)""",
    "last_wins_table": f"""WITH {_TX}, daily AS ({_totals("tx", 1440)}), {_LAST_DAY}
        SELECT category, total_quantity, total_revenue, window_start
        FROM daily JOIN last_day USING (category, window_start)""",
    "shape_cast_price": f"WITH {_TX} SELECT transaction_id, price::double AS price FROM tx",
    "shape_route_topic": f"""WITH {_TX} SELECT transaction_id,
        CASE WHEN quantity % 2 = 0 THEN 'sales-transactions' ELSE 'x_sales_transactions' END AS topic FROM tx""",
    "shape_key": f"WITH {_TX} SELECT category AS key, transaction_id FROM tx",
    "shape_key_from_field": f"WITH {_TX} SELECT transaction_id AS key, category FROM tx",
    "shape_chain": f"""WITH {_TX} SELECT category AS key, 'sales-transactions' AS topic, transaction_id, product_id,
        category, quantity, price::double AS price, epoch_us(ts) AS timestamp_us FROM tx""",
    "round_price": """SELECT concat('tx', event_id::varchar) AS transaction_id,
        cast(cast(value AS float) AS decimal(10,2))::double AS price FROM events""",
    "default_timestamp": f"""WITH {_TX} SELECT transaction_id,
        CASE WHEN quantity % 2 = 0 THEN epoch_us(ts) END AS given_us,
        CASE WHEN quantity % 2 = 1 THEN 1 END::int AS whole FROM tx""",
    "append_rows": f"""WITH {_TX} SELECT product_id AS transaction_id, epoch_ms(date_trunc('hour', ts)) AS timestamp_ms,
        quantity, sparse_offset AS "offset",
        (count(*) OVER (PARTITION BY product_id, date_trunc('hour', ts)) > 1)::int AS clash FROM tx""",
    "summary_record_time": f"""WITH {_TX}, moved AS (
        SELECT * REPLACE (ts + INTERVAL 90 MINUTES AS ts) FROM tx WHERE quantity % 5 <> 0) {_totals("moved", 60)}""",
    "shape_record_name": f"""WITH {_TX} SELECT category AS key, transaction_id,
        'sales.sales_transactions' AS record_name FROM tx""",
    "wire_routing": """SELECT event_id, (event_id % 6 IN (1, 2, 3))::int AS "foreign",
        CASE WHEN event_id % 6 > 3 THEN event_type END AS event_type FROM events""",
    "table_key_guard": f"""WITH {_TX}, numbered AS (
        SELECT *, row_number() OVER (PARTITION BY product_id, date_trunc('hour', ts) ORDER BY sparse_offset) AS n FROM tx)
        SELECT product_id AS transaction_id, epoch_ms(date_trunc('hour', ts)) AS timestamp_ms, category, quantity,
               sparse_offset AS "offset" FROM numbered WHERE n = 1""",
    "stream_key_guard": f"""WITH {_TX} SELECT transaction_id, epoch_us(ts) // 1000 AS "timestamp", quantity, sparse_offset AS "offset",
        (ts >= TIMESTAMP '2024-01-11 12:00')::int + (ts >= TIMESTAMP '2024-01-21 12:00')::int AS delivery FROM tx""",
    "incremental_overlap": """SELECT event_id, (SELECT min(i) FROM (VALUES (0, 5), (1, 11), (2, 12), (3, 20), (4, 30), (5, 50)) p(i, d)
             WHERE ts + to_days((CASE WHEN event_id % 10 = 0 THEN event_id % 13 ELSE 0 END)::int) < TIMESTAMP '2024-01-01' + to_days(d))::int AS poll
        FROM events""",
    "table_key_conflicts": f"""WITH {_TX}
        SELECT product_id AS transaction_id, epoch_ms(date_trunc('hour', ts)) AS timestamp_ms, count(*) AS copies
        FROM tx GROUP BY 1, 2 HAVING count(*) > 1""",
    "incremental_read": """SELECT concat('tx', event_id::varchar) AS transaction_id, epoch_us(ts) AS timestamp_us
        FROM events WHERE ts > TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""",
    "incremental_replay": """WITH b AS (SELECT min(epoch_us(ts)) AS f, max(epoch_us(ts)) AS l FROM events)
        SELECT event_id, ((4 * (epoch_us(ts) - f)) // (l - f))::int AS poll FROM events, b""",
    "wire_header": """SELECT event_id,
        CASE WHEN event_type = 'error' THEN '7B' ELSE '00' END AS magic,
        CASE WHEN event_type = 'error'
             THEN ord(props[1]) * 16777216 + ord(props[2]) * 65536 + ord(props[3]) * 256 + ord(props[4])
             ELSE user_id END::bigint AS schema_id,
        hex(CASE WHEN event_type = 'error' THEN props[5:] ELSE event_type END) AS payload_hex,
        (event_type <> 'error')::int AS framed FROM events""",
    "wire_foreign": """SELECT event_id,
        CASE WHEN event_type = 'view' THEN '0000000007' || hex(event_type) ELSE hex(event_type) END AS value_hex
        FROM events WHERE event_type IN ('view', 'error')""",
    "wire_alert_bytes": f"""WITH {_TEL}, a AS ({_hot()} UNION ALL {_dry()})
        SELECT hex(sensor_id) AS key_hex,
               '000000002A' || {_hex_text("sensor_id")} || {_hex_text("alert_type")}
               || {_hex_varint('"timestamp"')} || {_hex_text("details")} AS value_hex FROM a""",
    "wire_transactions": f"""WITH {_TX} SELECT transaction_id, product_id, category, quantity,
        price::double AS price, epoch_us(ts) // 1000 AS "timestamp" FROM tx""",
    "wire_telemetry": f'WITH {_TEL} SELECT sensor_id, temperature, humidity, soil_fertility, "timestamp" FROM tel',
    "wire_summary": f"""WITH {_TX}, s AS ({_totals("tx", 60)})
        SELECT category, total_quantity::int AS total_quantity, total_revenue, window_start, window_end FROM s""",
    "wire_evolution": f"""WITH {_TX} SELECT sparse_offset AS "offset", transaction_id,
        CASE sparse_offset % 4 WHEN 0 THEN 'unknown' ELSE product_id END AS product_id, category, quantity::bigint AS quantity,
        CASE sparse_offset % 4 WHEN 0 THEN price::double::float::double ELSE price::double END AS price,
        epoch_us(ts) // 1000 AS "timestamp" FROM tx WHERE sparse_offset % 4 <> 3""",
    "synth_telemetry": f"""WITH {_draws(1, 4)}, t AS (
        SELECT {_digits("sensor_", 3, "d0")} AS sensor_id, {_range("d1", 15.0, 50.0)} AS temperature,
               {_range("d2", 0.05, 0.70)} AS humidity, {_range("d3", 40.0, 90.0)} AS soil_fertility,
               1741421258 + event_id AS "timestamp" FROM draws)
        SELECT sensor_id AS key, * FROM t""",
    "synth_transactions": f"""WITH {_SYNTH_TX}
        SELECT transaction_id AS key, transaction_id, product_id, category, quantity, price::double AS price FROM synth""",
    "synth_ingest": f"""WITH {_SYNTH_TX}
        SELECT category AS key, 'sales-transactions' AS topic, count(*) AS messages,
               sum(quantity)::bigint AS total_quantity, sum(price::decimal(10,2))::double AS total_revenue
        FROM synth GROUP BY category""",
    "named_functions_sql": f"""WITH {_TEL}, {_TX},
        wc AS (SELECT n, category, count(DISTINCT epoch_us(ts) // (n * 60000000)) AS records, sum(quantity)::bigint AS units
               FROM tx, (VALUES (15::bigint), (1440::bigint)) v(n) GROUP BY n, category),
        a AS (SELECT hot, alert_type, count(*) AS records FROM (
                SELECT hot, 'HIGH_TEMPERATURE' AS alert_type FROM tel, (VALUES (35.0::double), (45.0::double)) v(hot) WHERE temperature > hot
                UNION ALL SELECT hot, 'LOW_HUMIDITY' FROM tel, (VALUES (35.0::double, 0.2::double), (45.0::double, 0.1::double)) v(hot, dry)
                WHERE humidity < dry) GROUP BY 1, 2),
        l AS (SELECT n, part, count(*) AS records FROM (
                SELECT n, part, max(ts) OVER (PARTITION BY n, part ORDER BY place ROWS UNBOUNDED PRECEDING) AS seen,
                       (epoch_us(ts) // (n * 60000000) + 1) * n * 60000000 AS ends
                FROM tx, (VALUES (15::bigint), (60::bigint)) v(n)) WHERE ends <= epoch_us(seen) GROUP BY n, part)
        SELECT 'windows ' || n AS source, category AS name, records, units FROM wc
        UNION ALL SELECT 'alerts ' || hot, alert_type, records, null FROM a
        UNION ALL SELECT 'late ' || n, part::varchar, records, null FROM l""",
    "named_tables_sql": f"""WITH {_TEL}, {_TX}, a AS ({_hot()} UNION ALL {_dry()}), s AS ({_totals("tx", 1440)})
        SELECT 'alerts' AS source, alert_type AS name, count(*) AS records, null::double AS revenue
        FROM a GROUP BY alert_type
        UNION ALL SELECT 'summary', category, count(*), sum(total_revenue::decimal(18,2))::double FROM s GROUP BY category
        UNION ALL SELECT 'telemetry', sensor_id, count(*), null FROM tel GROUP BY sensor_id
        UNION ALL SELECT 'transactions', product_id, sum(quantity)::bigint, null FROM tx GROUP BY product_id""",
}

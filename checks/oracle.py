"""DuckDB SQL giving the results of `checks/queries.py`, by the same names."""

from __future__ import annotations

WIDTHS = {
    "1s": "1 second", "5s": "5 seconds", "10s": "10 seconds", "30s": "30 seconds",
    "1m": "1 minute", "2m": "2 minutes", "3m": "3 minutes", "5m": "5 minutes",
    "10m": "10 minutes", "15m": "15 minutes", "30m": "30 minutes", "45m": "45 minutes",
    "1h": "1 hour", "2h": "2 hours", "3h": "3 hours", "4h": "4 hours",
    "6h": "6 hours", "8h": "8 hours", "12h": "12 hours", "1d": "1 day",
}
CALENDAR = {"1w": "week", "1M": "month", "3M": "quarter", "1Q": "quarter", "1Y": "year"}
NAMES = {"1w": "1w", "1M": "1mo", "3M": "3mo", "1Q": "1q", "1Y": "1y"}
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

TICKS = """ticks AS (
  SELECT event_type AS ticker, ts AS timestamp, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS size, event_id AS seq
  FROM events)"""

USER_BARS = """user_bars AS (
  SELECT CAST(user_id AS VARCHAR) AS ticker,
         CASE event_type WHEN 'click' THEN '1m' WHEN 'error' THEN '5m' WHEN 'purchase' THEN '1h'
                         WHEN 'signup' THEN '1d' WHEN 'view' THEN '1w' END AS interval,
         ts AS timestamp, value AS open, value + 1 AS high, value - 1 AS low, value AS close,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume, value AS vwap,
         CAST(1 AS BIGINT) AS transactions
  FROM events)"""

UNIVERSE = "universe AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker FROM customer)"

RANGES = """ranges AS (
  SELECT ticker, interval, start_date, end_date
  FROM (SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(min(o_orderdate) AS DATE) AS start_date,
               DATE '2024-01-15' + CAST(o_custkey % 20 AS INTEGER) AS end_date
        FROM orders GROUP BY o_custkey) o,
       (VALUES ('1m'), ('5m'), ('1h'), ('1d'), ('1w')) v(interval))"""

MARKS = "marks AS (SELECT ticker, interval, max(timestamp) AS last_timestamp FROM user_bars GROUP BY ALL)"

FRESH = """fresh AS (
  SELECT *, CASE WHEN days_behind IS NULL THEN 'missing' WHEN days_behind <= 0 THEN 'up_to_date'
                 ELSE 'needs_update' END AS status,
         CASE WHEN days_behind IS NULL THEN 'missing' WHEN days_behind <= 0 THEN 'up_to_date'
              WHEN days_behind = 1 THEN 'recent_update' ELSE 'significant_update' END AS lag
  FROM (SELECT r.ticker, r.interval, start_date, end_date, last_timestamp,
               CAST(floor((epoch_us(CAST(end_date AS TIMESTAMP)) - epoch_us(last_timestamp)) / 86400000000.0) AS BIGINT)
                 AS days_behind
        FROM ranges r LEFT JOIN marks m ON r.ticker = m.ticker AND r.interval = m.interval))"""

POSITIONS = "list_position(['1m', '5m', '1h', '1d', '1w'], interval)"

VERIFY = f"""verified AS (
  SELECT u.ticker,
         CASE WHEN n IS NULL THEN 'no_api_data' WHEN m = 0 AND b = 0 THEN 'COMPLETE'
              WHEN m = n THEN 'MISSING' ELSE 'PARTIAL' END AS status,
         coalesce(ok, 0) AS n_up_to_date, coalesce(b, 0) AS n_needs_update, coalesce(m, 0) AS n_missing,
         coalesce(l_ok, '') AS up_to_date, coalesce(l_b, '') AS needs_update, coalesce(l_m, '') AS missing
  FROM universe u LEFT JOIN (
    SELECT ticker, count(*) AS n,
           count(*) FILTER (status = 'up_to_date') AS ok, count(*) FILTER (status = 'needs_update') AS b,
           count(*) FILTER (status = 'missing') AS m,
           string_agg(interval, ',' ORDER BY {POSITIONS}) FILTER (status = 'up_to_date') AS l_ok,
           string_agg(interval || ' (' || days_behind || 'd behind)', ',' ORDER BY {POSITIONS})
             FILTER (status = 'needs_update') AS l_b,
           string_agg(interval, ',' ORDER BY {POSITIONS}) FILTER (status = 'missing') AS l_m
    FROM fresh GROUP BY ticker) f ON u.ticker = f.ticker)"""

FRESH_ALL = f"{USER_BARS}, {RANGES}, {MARKS}, {FRESH}, {UNIVERSE}"

INSTRUMENTS = """instruments AS (
  SELECT c_name AS ticker, n_name || ' ' || c_mktsegment AS name,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'stocks' WHEN 'BUILDING' THEN 'crypto' WHEN 'FURNITURE' THEN 'fx'
                           WHEN 'HOUSEHOLD' THEN 'options' WHEN 'MACHINERY' THEN 'otc' END AS market,
         CASE WHEN r_name = 'AMERICA' THEN 'us' ELSE 'global' END AS locale,
         n_name AS primary_exchange,
         CASE WHEN c_acctbal > 5000 THEN 'CS' ELSE 'ETF' END AS type,
         c_acctbal >= 0 AS active
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

FOUND = """found AS (
  SELECT CASE WHEN market = 'stocks' AND type = 'CS' AND locale = 'us' THEN 'us_equities'
              WHEN market = 'stocks' AND type = 'ETF' AND locale = 'us' THEN 'etf'
              WHEN market IN ('crypto', 'fx') THEN market
              WHEN market IN ('options', 'indices', 'otc') AND locale = 'us' THEN market END AS category,
         ticker, name, market, type, locale, primary_exchange, active
  FROM instruments WHERE active)"""

PARTS = """parts AS (
  SELECT 'P' || p_partkey AS ticker, p_name AS name, p_type AS type, p_brand AS primary_exchange FROM part)"""

SYMBOLS = """symbols AS (
  SELECT ticker, max(kind) AS type, bool_or(p_size > 25) AS has_short_minutes
  FROM (SELECT CASE p_partkey % 8
                 WHEN 0 THEN 'X:' || p_partkey WHEN 1 THEN p_partkey || 'usd' WHEN 2 THEN 'UNI' || p_partkey
                 WHEN 3 THEN 'SPY' WHEN 4 THEN p_partkey || 'FUND' WHEN 5 THEN 'A' || p_partkey
                 WHEN 6 THEN 'B' || p_partkey || '-USD' ELSE 'C' || p_partkey || '/EUR' END AS ticker,
               CASE p_type WHEN 'PROMO' THEN 'ETP' WHEN 'ECONOMY' THEN 'CRYPTO' WHEN 'SMALL' THEN 'ETF'
                           WHEN 'LARGE' THEN 'FX' ELSE 'CS' END AS kind, p_size
        FROM part) GROUP BY ticker)"""

SIDES = """existing AS (SELECT 'S' || p_partkey AS ticker, p_name AS name FROM part),
  found AS (
  SELECT CASE WHEN l_linenumber > 1 THEN 'S' || (l_suppkey * 100 + l_linenumber) END AS ticker,
         'lot ' || count(*) AS name
  FROM lineitem GROUP BY l_suppkey, l_linenumber)"""

LANDED = """raw AS (
  SELECT 'P' || l_partkey AS ticker, '1d' AS interval,
         CASE WHEN l_linenumber < 7 THEN l_shipdate END AS timestamp,
         l_extendedprice AS open, l_extendedprice + l_quantity AS high,
         CASE WHEN l_tax > 0 THEN l_extendedprice END AS low, l_extendedprice AS close,
         CASE WHEN l_returnflag = 'N' THEN CAST(floor(l_quantity + 0.5) AS BIGINT) ELSE 0 END AS volume,
         CASE WHEN l_returnflag = 'A' THEN l_extendedprice END AS vwap, l_suppkey AS transactions
  FROM lineitem)"""

MARKET = """market AS (
  SELECT coalesce(CASE WHEN l_linenumber > 1 THEN CAST(l_partkey AS VARCHAR) END,
                  CASE WHEN l_linenumber < 3 THEN 's' || l_suppkey END) AS ticker,
         '1d' AS interval, date_trunc('day', l_shipdate)::TIMESTAMP AS timestamp,
         l_extendedprice AS open, l_extendedprice + 1 AS high, l_extendedprice - 1 AS low, l_extendedprice AS close,
         CAST(l_quantity AS BIGINT) AS volume, l_extendedprice AS vwap, l_orderkey AS transactions
  FROM lineitem)"""

ORDER_SPINE = """spine AS (
  SELECT date FROM (
    SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
    FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders))
  WHERE isodow(date) < 6)"""

MARKET_REPORT = f"""{MARKET}, spine AS (
  SELECT date FROM (
    SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
    FROM (SELECT min(CAST(timestamp AS DATE)) AS lo, max(CAST(timestamp AS DATE)) AS hi FROM market))
  WHERE isodow(date) < 6), report AS (
  SELECT s.date, CASE WHEN n > 0 THEN 'success' ELSE 'no_data' END AS status, coalesce(n, 0) AS tickers_saved
  FROM spine s LEFT JOIN (SELECT CAST(timestamp AS DATE) AS date, count(DISTINCT ticker) AS n FROM market GROUP BY 1) m
    ON s.date = m.date)"""


def bins(label: str) -> str:
    if label in WIDTHS:
        return f"time_bucket(INTERVAL '{WIDTHS[label]}', timestamp)"
    return f"CAST(date_trunc('{CALENDAR[label]}', timestamp) AS TIMESTAMP)"


def bars(label: str, source: str = "ticks", extra: str = "", where: str = "TRUE") -> str:
    """OHLCV of a source with ticker, timestamp, price and size."""
    return f"""SELECT ticker, '{label}' AS interval, {bins(label)} AS timestamp,
      arg_min(price, timestamp) AS open, max(price) AS high, min(price) AS low, arg_max(price, timestamp) AS close,
      CAST(coalesce(sum(size), 0) AS BIGINT) AS volume{extra}
      FROM {source} WHERE {where} GROUP BY 1, 3 HAVING max(price) IS NOT NULL"""


def holey_bars(label: str, vwap: str = "round({} / 3, 6)") -> str:
    """Bars of ticks of which some have no price: all sizes are volume, a vwap weighs the priced ones."""
    known = "FILTER (price IS NOT NULL)"
    return f"""SELECT ticker, '{label}' AS interval, {bins(label)} AS timestamp,
      arg_min(price, timestamp) {known} AS open, max(price) AS high, min(price) AS low, arg_max(price, timestamp) {known} AS close,
      CAST(coalesce(sum(size), 0) AS BIGINT) AS volume,
      {vwap.format(f"sum(price * size) / nullif(sum(size) {known}, 0)")} AS vwap, count(price) AS transactions
      FROM holey GROUP BY 1, 3 HAVING max(price) IS NOT NULL"""


def order_bars(label: str, ticker: str = "o_orderpriority") -> str:
    """OHLC of orders, ties on a day decided by the order key."""
    return f"""SELECT {ticker} AS ticker, '{label}' AS interval, {bins(label).replace('timestamp)', 'o_orderdate)', 1)} AS timestamp,
      first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS open, max(o_totalprice) AS high,
      min(o_totalprice) AS low, last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS close
      FROM orders GROUP BY 1, 3"""


HOURLY = f"{TICKS}, hourly AS ({bars('1h')})"
SPLIT = f"""{HOURLY}, both_sides AS (
  SELECT *, 0 AS side FROM hourly WHERE timestamp < TIMESTAMP '2024-01-20'
  UNION ALL
  SELECT ticker, interval, timestamp, open * 2, high * 2, low * 2, close * 2, volume, 1
  FROM hourly WHERE timestamp >= TIMESTAMP '2024-01-10')"""


def merged(direction: str, columns: str = "ticker, interval, timestamp, open, high, low, close, volume") -> str:
    return f"""WITH {SPLIT} SELECT {columns} FROM (
      SELECT *, row_number() OVER (PARTITION BY ticker, interval, timestamp ORDER BY side {direction}) AS r
      FROM both_sides) WHERE r = 1"""


def hybrid() -> str:
    """Bars of whole bins from 4 January on; from the bin of 20 January on the provider's."""
    parts = []
    for label, first, cut in (("1h", "04", "20"), ("1d", "04", "20"), ("1w", "01", "15"), ("1M", "01", "01")):
        parts.append(f"SELECT *, timestamp >= TIMESTAMP '2024-01-{cut}' AS recent FROM ({bars(label)}) WHERE timestamp >= TIMESTAMP '2024-01-{first}' AND timestamp < TIMESTAMP '2024-02-01'")
    raised = ", ".join(f"CASE WHEN recent THEN {c} + 1000 ELSE {c} END AS {c}" for c in ("open", "high", "low", "close"))
    return f"""WITH {TICKS}, sides AS ({' UNION ALL '.join(parts)})
      SELECT CASE WHEN recent THEN 'equities' END AS asset_type, upper(ticker) AS ticker, interval, timestamp, {raised}, volume FROM sides"""


STEPS = """CASE WHEN interval IN ('1s', '5s', '10s', '30s') THEN last_timestamp + INTERVAL 1 SECOND
  WHEN interval IN ('1m', '2m', '3m', '5m', '10m', '15m', '30m', '45m')
    THEN date_trunc('day', last_timestamp + INTERVAL 1 MINUTE)
  WHEN interval IN ('1h', '2h', '3h', '4h', '6h', '8h', '12h') THEN date_trunc('day', last_timestamp + INTERVAL 1 HOUR)
  WHEN interval = '1w' THEN date_trunc('day', last_timestamp + INTERVAL 7 DAY)
  WHEN interval IN ('1M', '3M') THEN date_trunc('day', last_timestamp + INTERVAL 31 DAY)
  WHEN interval = '1Q' THEN date_trunc('day', last_timestamp + INTERVAL 91 DAY)
  WHEN interval = '1Y' THEN date_trunc('day', last_timestamp + INTERVAL 365 DAY)
  ELSE date_trunc('day', last_timestamp + INTERVAL 1 DAY) END"""


def resume(marks: str = "marks") -> str:
    return f"""resume AS (
  SELECT r.ticker, r.interval, last_timestamp,
         CAST(coalesce({STEPS.replace('interval', 'r.interval')}, start_date) AS TIMESTAMP) AS resume_from,
         end_date,
         CASE WHEN last_timestamp IS NOT NULL
               AND CAST({STEPS.replace('interval', 'r.interval')} AS TIMESTAMP) >= CAST(end_date + 1 AS TIMESTAMP)
              THEN 'up_to_date' ELSE 'fetch' END AS action
  FROM ranges r LEFT JOIN {marks} m ON r.ticker = m.ticker AND r.interval = m.interval)"""


LOCAL = """local_bars AS (SELECT * FROM user_bars WHERE timestamp < TIMESTAMP '2024-01-12'),
  local_marks AS (SELECT ticker, interval, max(timestamp) AS last_timestamp FROM local_bars GROUP BY ALL)"""
DUE = f"""{USER_BARS}, {RANGES}, {LOCAL}, {resume('local_marks')}, due AS (
  SELECT b.* FROM user_bars b JOIN resume s ON b.ticker = s.ticker AND b.interval = s.interval
  WHERE s.action = 'fetch' AND timestamp >= resume_from AND timestamp < CAST(end_date + 1 AS TIMESTAMP))"""


def load(total: str) -> str:
    return f"""report AS (
  SELECT s.ticker, s.interval,
         CASE WHEN action = 'up_to_date' THEN 'up_to_date' WHEN coalesce(n, 0) = 0 THEN 'no_new_data'
              ELSE 'success' END AS status,
         coalesce(n, 0) AS new_records, coalesce(k, 0) AS total_records
  FROM resume s
  LEFT JOIN (SELECT ticker, interval, count(*) AS n FROM due GROUP BY ALL) d
    ON s.ticker = d.ticker AND s.interval = d.interval
  LEFT JOIN (SELECT ticker, interval, count(*) AS k FROM ({total}) GROUP BY ALL) l
    ON s.ticker = l.ticker AND s.interval = l.interval)"""


AFTER = "SELECT ticker, interval, timestamp FROM local_bars UNION SELECT ticker, interval, timestamp FROM due"

EXTENT = """extent AS (
  SELECT ticker, interval, CAST(min(timestamp) AS DATE) AS start_date, CAST(max(timestamp) AS DATE) AS end_date,
         CAST(date_diff('day', CAST(min(timestamp) AS DATE), CAST(max(timestamp) AS DATE)) AS BIGINT) AS days_available
  FROM user_bars GROUP BY ticker, interval)"""
RANGE_FORM = """CAST(trunc(CASE interval WHEN '1h' THEN days_available * 6.5 WHEN '15m' THEN days_available * 26
  WHEN '5m' THEN days_available * 78 WHEN '1m' THEN days_available * 390 ELSE days_available END) AS BIGINT)"""
PROBE_FORM = """CAST(CASE WHEN interval = '1h' THEN trunc(days_available * 6.5)
  WHEN interval = '1m' THEN days_available * 390 WHEN interval = '5m' THEN days_available * 390 // 5
  ELSE days_available END AS BIGINT)"""
FILES = """files AS (
  SELECT ticker, interval, max(timestamp) AS last_timestamp, max(timestamp) + INTERVAL 6 HOUR AS modified,
         ticker || '.' || interval || '.parquet' AS path
  FROM user_bars GROUP BY ticker, interval)"""
PER_TICKER_FILES = """per_ticker AS (
  SELECT ticker, count(*) AS n_files, max(modified) AS newest_modified,
         arg_max(last_timestamp, modified) AS newest_last, arg_max(path, modified) AS newest_path
  FROM files GROUP BY ticker)"""
SKIPPED = f"""skipped AS (
  SELECT ticker, n_files, newest_modified FROM per_ticker
  WHERE n_files >= 3 AND (epoch_us({AS_OF}) - epoch_us(newest_modified) < 24 * 3600000000
    OR (epoch_us({AS_OF}) - epoch_us(newest_modified) < 72 * 3600000000
        AND floor((epoch_us({AS_OF}) - epoch_us(newest_last)) / 86400000000.0) < 2)))"""
PREFILTER = f"{USER_BARS}, {FILES}, {PER_TICKER_FILES}, {SKIPPED}"
VOCABULARY = ", ".join(f"('{label}')" for label in (*WIDTHS, *CALENDAR))
PROFILE = """profile AS (
  SELECT ticker, interval, 'ok' AS status, count(*) AS records, min(timestamp) AS first_date,
         max(timestamp) AS last_date,
         CAST(floor((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 86400000000.0) AS BIGINT) AS date_range_days
  FROM user_bars GROUP BY ticker, interval)"""
SERIES_RANGE = "interval = '1m' AND timestamp >= TIMESTAMP '2024-01-05' AND timestamp <= TIMESTAMP '2024-01-25'"
HUMAN = " ".join(
    f"WHEN bytes < 1024.0 ** {power + 1} THEN printf('%.2f {unit}', bytes / 1024.0 ** {power})"
    for power, unit in enumerate(("B", "KB", "MB", "GB", "TB"))
)
MANY = ("1m", "5m", "15m", "45m", "1h", "4h", "12h", "1d", "1w", "1M", "1Y")
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def statements() -> dict[str, str]:
    out = {f"ohlcv_{label}": f"WITH {TICKS} {bars(label)}" for label in WIDTHS}
    out |= {f"ohlcv_{name}": order_bars(label) for label, name in NAMES.items()}
    vwap = ", round(sum(price * size) / sum(size), 4) AS vwap, count(price) AS transactions"
    all_bars = " UNION ALL ".join(bars(label) for label in (*WIDTHS, *CALENDAR))
    many = " UNION ALL ".join(bars(label) for label in MANY)
    holey = "holey AS (SELECT * REPLACE (CASE WHEN size >= 20 THEN price END AS price) FROM ticks)"
    out |= {
        "day_file_bars": f"WITH {TICKS} {bars('5m')}",
        "intraday_bars": f"""WITH {TICKS}, holey AS (SELECT * REPLACE (CASE WHEN size >= 20 THEN price END AS price) FROM ticks)
          SELECT ticker, '30m' AS interval, {bins('30m')} AS timestamp,
            arg_min(price, timestamp) FILTER (price IS NOT NULL) AS open, max(price) AS high, min(price) AS low,
            arg_max(price, timestamp) FILTER (price IS NOT NULL) AS close, CAST(sum(size) AS BIGINT) AS volume
          FROM holey GROUP BY 1, 3 HAVING max(price) IS NOT NULL""",
        "user_hourly_bars": f"""WITH {USER_BARS}, ticks AS (SELECT ticker, timestamp, open AS price, volume AS size FROM user_bars)
          {bars('1h')}""",
        "vwap_1d": f"WITH {TICKS} {bars('1d', extra=vwap)}",
        "rollup_vwap": f"WITH {TICKS} {bars('1d', extra=vwap)}",
        "rollup_vwap_holey": f"WITH {TICKS}, {holey} {holey_bars('1d', 'round({}, 4)')}",
        "multi_interval_holey": f"WITH {TICKS}, {holey} " + " UNION ALL ".join(holey_bars(label) for label in (*WIDTHS, *CALENDAR)),
        "rollup_1m_to_1h": f"WITH {TICKS} {bars('1h')}",
        "rollup_1d_to_1q": order_bars("1Q"),
        "multi_interval_bars": f"WITH {TICKS} {many}",
        "all_interval_counts": f"""WITH {TICKS} SELECT interval, count(*) AS bars, CAST(sum(volume) AS BIGINT) AS volume,
            max(open) AS open, max(high) AS high, min(low) AS low, max(close) AS close
          FROM ({all_bars}) GROUP BY interval""",
        "building_report": f"""WITH {TICKS} SELECT interval, count(*) AS symbols_processed,
            string_agg(ticker, ',' ORDER BY ticker) FILTER (r <= 10) AS symbols
          FROM (SELECT *, row_number() OVER (PARTITION BY interval ORDER BY ticker) AS r
                FROM (SELECT DISTINCT interval, ticker FROM ({bars('1h')} UNION ALL {bars('1d')}))) GROUP BY interval""",
        "file_symbol_bars": order_bars("1d", "'orders'"),
        "upsert_keep_last": merged("DESC"),
        "upsert_keep_first": merged("ASC"),
        "duplicates_keep_last": """SELECT o_orderpriority AS ticker, o_orderdate AS timestamp,
            arg_max(o_totalprice, o_orderkey) AS close, max(o_orderkey) AS ingest_seq FROM orders GROUP BY 1, 2""",
        "append_keep_first": f"""WITH {SIDES} SELECT ticker, name FROM (
            SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY side, name) AS r FROM (
              SELECT *, 0 AS side FROM existing UNION ALL SELECT *, 1 FROM found)
            WHERE ticker IS NOT NULL AND ticker <> '') WHERE r = 1""",
        "universe_append_count": f"""WITH {SIDES}, t AS (
            SELECT count(DISTINCT ticker) AS count, (SELECT count(*) FROM existing) AS existing_count
            FROM (SELECT ticker FROM existing UNION ALL SELECT ticker FROM found) WHERE ticker <> '')
          SELECT count, existing_count, count - existing_count AS new_tickers_added FROM t""",
        "hybrid_series": hybrid(),
        "series_head_tail": f"""WITH {USER_BARS}, ranked AS (
            SELECT *, row_number() OVER (PARTITION BY ticker, interval ORDER BY timestamp) AS up,
                   row_number() OVER (PARTITION BY ticker, interval ORDER BY timestamp DESC) AS down FROM user_bars)
          SELECT ticker, interval, 'first' AS edge, up AS position, timestamp, open, volume FROM ranked WHERE up <= 5
          UNION ALL
          SELECT ticker, interval, 'last', down, timestamp, open, volume FROM ranked WHERE down <= 5""",
        "high_water_mark": f"WITH {USER_BARS}, {MARKS} SELECT * FROM marks",
        "date_range_estimate": f"""WITH {USER_BARS}, {EXTENT}, {UNIVERSE}
          SELECT u.ticker, v.interval, start_date, end_date, coalesce(days_available, 0) AS days_available,
            coalesce(estimated_bars, 0) AS estimated_bars, start_date IS NOT NULL AS data_available
          FROM universe u CROSS JOIN (VALUES ('1d'), ('1h'), ('15m'), ('5m'), ('1m')) v(interval)
          LEFT JOIN (SELECT *, {RANGE_FORM} AS estimated_bars FROM extent) e
            ON u.ticker = e.ticker AND v.interval = e.interval""",
        "listed_ranges": f"""WITH {USER_BARS.replace('user_bars', 'all_bars')}, user_bars AS (
            SELECT b.* FROM all_bars b LEFT JOIN customer c ON b.ticker = CAST(c_custkey AS VARCHAR)
            WHERE timestamp >= CASE WHEN c_custkey IS NULL THEN TIMESTAMP '1970-01-01'
              ELSE CAST(DATE '2024-01-01' + CAST(c_custkey % 15 AS INTEGER) AS TIMESTAMP) END), {EXTENT}
          SELECT *, {RANGE_FORM} AS estimated_bars FROM extent""",
        "timeframe_availability": f"WITH {USER_BARS}, {EXTENT} SELECT *, {PROBE_FORM} AS estimated_bars FROM extent",
        "timeframe_flags": f"""WITH {USER_BARS} SELECT ticker, count(DISTINCT interval) AS total_timeframes,
            FALSE AS has_seconds, bool_or(interval IN ('1m', '5m')) AS has_intraday,
            bool_or(interval = '1h') AS has_hourly, bool_or(interval IN ('1d', '1w')) AS has_daily,
            bool_or(interval IN ('1m', '5m')) AS has_short_minutes FROM user_bars GROUP BY ticker""",
        "timeframe_map": f"""WITH {USER_BARS}, {EXTENT}
          SELECT ticker, string_agg(interval || ':' || {PROBE_FORM}, ',' ORDER BY interval) AS timeframes
          FROM extent GROUP BY ticker""",
        "freshness": f"WITH {FRESH_ALL} SELECT * FROM fresh",
        "verify_per_ticker": f"WITH {FRESH_ALL}, {VERIFY} SELECT * FROM verified",
        "verify_totals": f"""WITH {FRESH_ALL}, {VERIFY}
          SELECT count(*) FILTER (status = 'COMPLETE') AS tickers_complete,
            count(*) FILTER (status = 'PARTIAL') AS tickers_partial,
            count(*) FILTER (status IN ('MISSING', 'no_api_data')) AS tickers_missing,
            CAST(sum(n_up_to_date) AS BIGINT) AS timeframes_up_to_date,
            CAST(sum(n_needs_update) AS BIGINT) AS timeframes_need_update,
            CAST(sum(n_missing) AS BIGINT) AS timeframes_missing,
            CAST(sum(n_needs_update + n_missing) AS BIGINT) AS total_tasks_needed FROM verified""",
        "plan_outcome": f"""WITH {FRESH_ALL}, counted AS (
            SELECT u.ticker, count(f.status) AS timeframes_available,
              count(*) FILTER (f.status = 'up_to_date') AS timeframes_skipped,
              count(*) FILTER (f.status = 'needs_update') AS timeframes_to_update,
              count(*) FILTER (f.status = 'missing') AS timeframes_new
            FROM universe u LEFT JOIN fresh f ON u.ticker = f.ticker GROUP BY u.ticker)
          SELECT *, timeframes_to_update + timeframes_new AS tasks_created,
            CASE WHEN timeframes_available = 0 THEN 'no_data' WHEN timeframes_to_update + timeframes_new = 0 THEN 'all_up_to_date'
                 WHEN timeframes_to_update + timeframes_new < timeframes_available THEN 'partial_update'
                 ELSE 'full_download' END AS status FROM counted""",
        "resume_points": f"WITH {USER_BARS}, {RANGES}, {MARKS}, {resume()} SELECT * FROM resume",
        "resume_all_intervals": f"""WITH {TICKS}, m AS (
            SELECT ticker, interval, max(timestamp) AS last_timestamp FROM ticks, (VALUES {VOCABULARY}) v(interval) GROUP BY ALL)
          SELECT ticker, interval, CAST({STEPS} AS TIMESTAMP) AS resume_from FROM m""",
        "resume_rows": f"WITH {DUE} SELECT * FROM due",
        "load_report": f"WITH {DUE}, {load('SELECT * FROM local_bars')} SELECT * FROM report",
        "load_summary": f"""WITH {DUE}, {load('SELECT * FROM local_bars')}
          SELECT ticker, count(*) AS intervals_total, count(*) FILTER (status = 'success') AS intervals_completed,
            CAST(coalesce(sum(new_records) FILTER (status = 'success'), 0) AS BIGINT) AS total_new_records
          FROM report GROUP BY ticker""",
        "backfill_report": f"WITH {DUE}, {load(AFTER)} SELECT * FROM report",
        "newest_files": f"WITH {USER_BARS}, {FILES}, {PER_TICKER_FILES} SELECT * FROM per_ticker",
        "prefilter_skip": f"WITH {PREFILTER} SELECT * FROM skipped",
        "to_process": f"WITH {PREFILTER}, {UNIVERSE} SELECT ticker FROM universe u WHERE NOT EXISTS (SELECT 1 FROM skipped s WHERE s.ticker = u.ticker)",
        "work_list": f"WITH {UNIVERSE} SELECT ticker, interval FROM universe, (VALUES {VOCABULARY}) v(interval)",
        "progress": f"""WITH {USER_BARS}, {UNIVERSE}, n AS (
            SELECT count(*) AS total_tickers, count(*) FILTER (ticker IN (SELECT ticker FROM user_bars)) AS completed_tickers FROM universe)
          SELECT round(100.0 * completed_tickers / total_tickers, 2)::DOUBLE AS progress_percent, completed_tickers, total_tickers FROM n""",
        "series_ages": f"""WITH {USER_BARS}, {FILES}
          SELECT ticker, interval, round((epoch_us({AS_OF}) - epoch_us(modified)) / 3600000000.0, 4)::DOUBLE AS age_hours,
            CAST(floor((epoch_us({AS_OF}) - epoch_us(last_timestamp)) / 86400000000.0) AS BIGINT) AS days_old FROM files""",
        "category_filter": f"WITH {INSTRUMENTS}, {FOUND} SELECT * FROM found WHERE category IS NOT NULL",
        "category_limit": f"""WITH {INSTRUMENTS}, {FOUND} SELECT category, ticker FROM (
            SELECT *, row_number() OVER (PARTITION BY category ORDER BY ticker) AS r FROM found WHERE category IS NOT NULL) WHERE r <= 50""",
        "discovery_report": f"""WITH {INSTRUMENTS}, {FOUND}
          SELECT category, count(*) AS count, count(*) - count(*) FILTER (primary_exchange < 'NATION_2') AS new_tickers_added
          FROM found WHERE category IS NOT NULL GROUP BY category""",
        "universe_filter": f"""WITH {PARTS} SELECT * FROM parts WHERE primary_exchange = 'Brand#2' AND length(name) >= 8
          AND NOT contains(upper(ticker), 'RING') AND NOT contains(upper(name), 'RING')
          AND NOT contains(upper(ticker), 'BOLT') AND NOT contains(upper(name), 'BOLT')""",
        "asset_types": f"""WITH {SYMBOLS} SELECT ticker, CASE
            WHEN starts_with(upper(ticker), 'X:') OR upper(ticker) LIKE '%USD' OR upper(ticker) LIKE '%USDT' THEN 'crypto'
            WHEN starts_with(upper(ticker), 'UNI') THEN 'crypto'
            WHEN ticker = 'SPY' OR upper(ticker) LIKE '%FUND' THEN 'etf'
            WHEN contains(type, 'CRYPTO') THEN 'crypto'
            WHEN contains(type, 'ETF') OR contains(type, 'ETP') THEN 'etf' ELSE 'equities' END AS asset_type FROM symbols""",
        "market_types": f"""WITH {SYMBOLS} SELECT ticker, has_short_minutes, CASE
            WHEN has_short_minutes AND (contains(ticker, '-USD') OR starts_with(ticker, 'X:')) THEN 'crypto'
            WHEN has_short_minutes AND contains(ticker, '/') THEN 'fx'
            WHEN type = 'ETF' THEN 'etf' WHEN type IN ('CRYPTO', 'FX') THEN lower(type) ELSE 'stocks' END AS market_type FROM symbols""",
        "batches": f"""WITH {PARTS} SELECT ticker, (row_number() OVER (ORDER BY ticker) - 1) // 100 + 1 AS batch_number FROM parts""",
        "batch_report": """WITH n AS (SELECT count(*) AS total_tickers, CAST(ceil(count(*) / 100.0) AS BIGINT) AS total_batches FROM part)
          SELECT total_tickers, total_batches, greatest(least(3, total_batches) - 1, 0) AS processed_batches,
            total_batches - least(3, total_batches) AS remaining_batches FROM n""",
        "universe_documents": f"""WITH {INSTRUMENTS}, {FOUND}
          SELECT *, CAST(NULL AS VARCHAR) AS currency_name, CAST(NULL AS VARCHAR) AS last_updated_utc
          FROM found WHERE category IS NOT NULL""",
        "universe_listing": f"""WITH {INSTRUMENTS}, {FOUND} SELECT category, '2024-01-31T12:00:00' AS created_at,
            count(*) AS count, count(*) AS new_tickers_added FROM found WHERE category IS NOT NULL GROUP BY category""",
        "universe_store": f"""WITH {INSTRUMENTS}, {FOUND} SELECT category, count(*) AS count, count(*) AS new_tickers_added
          FROM found WHERE category <> 'fx' GROUP BY category""",
        "sorted_tickers": f"WITH {USER_BARS} SELECT DISTINCT ticker FROM user_bars ORDER BY ticker",
        "name_sample": f"WITH {PARTS} SELECT string_agg(ticker, ',' ORDER BY ticker) AS sample FROM (SELECT DISTINCT ticker FROM parts ORDER BY ticker LIMIT 10)",
        "series_query": f"""WITH {HOURLY} SELECT * REPLACE (upper(ticker) AS ticker) FROM hourly
          WHERE ticker = 'view' AND timestamp >= TIMESTAMP '2024-01-05' AND timestamp <= TIMESTAMP '2024-01-25'
          ORDER BY timestamp LIMIT 1000""",
        "series_columns": f"""WITH {TICKS} SELECT ticker, timestamp, close FROM ({bars('1d')})
          WHERE timestamp >= TIMESTAMP '2024-01-03' ORDER BY timestamp, ticker LIMIT 60""",
        "range_rows": f"WITH {USER_BARS} SELECT * FROM user_bars WHERE {SERIES_RANGE}",
        "series_header": f"WITH {USER_BARS} SELECT count(*) AS records, min(timestamp) AS start_date, max(timestamp) AS end_date FROM user_bars WHERE {SERIES_RANGE}",
        "series_summary": f"""WITH {USER_BARS}, {UNIVERSE}, {PROFILE}
          SELECT u.ticker, v.interval, CASE WHEN records IS NULL THEN 'no_data' ELSE 'available' END AS status,
            coalesce(records, 0) AS records, CAST(first_date AS DATE) AS start_date, CAST(last_date AS DATE) AS end_date
          FROM universe u CROSS JOIN (VALUES ('1m'), ('5m'), ('1h'), ('1d'), ('1w')) v(interval)
          LEFT JOIN profile p ON u.ticker = p.ticker AND v.interval = p.interval""",
        "series_profile": f"""WITH {USER_BARS}, {PROFILE} SELECT *,
            'timestamp,open,high,low,close,volume,vwap,transactions' AS columns,
            CAST(list_position(['1s', '1m', '5m', '15m', '30m', '1h', '1d', '1w'], interval) - 1 AS INTEGER) AS display_order FROM profile""",
        "overall_stats": f"""WITH {USER_BARS}, {PROFILE} SELECT ticker, CAST(sum(records) AS BIGINT) AS total_records,
            min(first_date) AS earliest, max(last_date) AS latest,
            CAST(floor((epoch_us(max(last_date)) - epoch_us(min(first_date))) / 86400000000.0) AS BIGINT) AS total_days
          FROM profile GROUP BY ticker""",
        "store_stats": f"WITH {USER_BARS} SELECT count(DISTINCT ticker) AS tickers, count(DISTINCT (ticker, interval)) AS series FROM user_bars",
        "first_last_bars": f"""WITH {USER_BARS} SELECT ticker, interval, min(timestamp) AS first_timestamp,
            arg_min(open, timestamp) AS first_open, max(timestamp) AS last_timestamp, arg_max(close, timestamp) AS last_close
          FROM user_bars GROUP BY ALL""",
        "weekday_spine": f"WITH {ORDER_SPINE} SELECT * FROM spine",
        "day_coverage": f"""WITH {ORDER_SPINE} SELECT s.date, coalesce(n, 0) AS rows, CASE WHEN n > 0 THEN 'success' ELSE 'no_data' END AS status
          FROM spine s LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1) o
            ON s.date = o.date""",
        "missing_days": f"""WITH {ORDER_SPINE} SELECT date FROM spine WHERE date NOT IN (
            SELECT CAST(o_orderdate AS DATE) FROM orders)""",
        "available_dates": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE year(o_orderdate) = 1997",
        "symbol_extract": f"""WITH {USER_BARS} SELECT ticker, interval, timestamp, close FROM user_bars
          WHERE timestamp >= TIMESTAMP '2024-01-06' AND timestamp < TIMESTAMP '2024-01-22'
            AND ticker IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""",
        "symbol_list_extract": f"""WITH {TICKS} SELECT * FROM ticks WHERE ticker IN ('click', 'view')
          AND timestamp >= TIMESTAMP '2024-01-06' AND timestamp < TIMESTAMP '2024-01-22'""",
        "landed_bars": f"WITH {LANDED} SELECT * FROM raw WHERE timestamp IS NOT NULL AND low IS NOT NULL",
        "landed_rejects": f"""WITH {LANDED} SELECT CASE WHEN timestamp IS NULL THEN 'time' ELSE 'low' END AS reject_reason, count(*) AS rows
          FROM raw WHERE timestamp IS NULL OR low IS NULL GROUP BY 1""",
        "reference_rows": f"""WITH {INSTRUMENTS} SELECT ticker, name, market, locale, primary_exchange, type, active
          FROM instruments WHERE locale = 'us'""",
        "market_rows": f"WITH {MARKET} SELECT * FROM market WHERE ticker IS NOT NULL",
        "market_day_report": f"WITH {MARKET_REPORT} SELECT * FROM report",
        "market_range_totals": f"""WITH {MARKET_REPORT} SELECT count(*) AS trading_days_processed,
            count(*) FILTER (status = 'success') AS days_with_data FROM report""",
        "store_upsert": merged("DESC", "'equities' AS asset_type, upper(ticker) AS ticker, interval, timestamp, open, high, low, close, volume"),
        "store_delete": f"""WITH {TICKS} SELECT upper(ticker) AS ticker, interval, timestamp, close, strftime(timestamp, '%Y') AS period
          FROM ({' UNION ALL '.join(bars(label) for label in ('1h', '1d', '1w'))})
          WHERE ticker <> 'click' AND NOT (ticker = 'view' AND interval = '1d')""",
        "series_limit": f"""WITH {TICKS} SELECT upper(ticker) AS ticker, timestamp, open, close, volume FROM ({bars('1m')})
          WHERE ticker = 'view' ORDER BY timestamp LIMIT 1000""",
        "one_identity": f"""WITH {TICKS} SELECT 'crypto' AS asset_type, 'X:' || upper(ticker) AS ticker, interval, timestamp, open,
            CASE interval WHEN '1h' THEN close * 2 ELSE close END AS close, volume
          FROM ({bars('1h')} UNION ALL {bars('1d')})""",
        "csv_export": f"""WITH {HOURLY} SELECT upper(ticker) AS ticker, timestamp, open, close, volume, CAST(1 AS BIGINT) AS in_first_file
          FROM hourly WHERE ticker = 'view' AND timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'""",
        "store_csv": f"WITH {USER_BARS} SELECT * FROM user_bars",
        "store_json": f"WITH {USER_BARS} SELECT * FROM user_bars",
        "tick_lake": "SELECT CAST(ts AS DATE) AS date, count(*) AS rows FROM events GROUP BY 1",
        "day_files": """SELECT d AS date, CASE WHEN d IN (SELECT CAST(ts AS DATE) FROM events)
            THEN 'success' ELSE 'no_data' END AS status, d IN (SELECT CAST(ts AS DATE) FROM events) AS has_files,
            d IN (SELECT CAST(ts AS DATE) FROM events) AS has_bytes
          FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS d)
          WHERE isodow(d) < 6""",
        "build_and_read": f"WITH {TICKS} SELECT 'equities' AS asset_type, upper(ticker) AS ticker, timestamp, open, close, volume FROM ({bars('12h')})",
        "stream_hourly_bars": f"WITH {TICKS} SELECT * REPLACE (upper(ticker) AS ticker) FROM ({bars('1h')})",
        "series_file_sizes": """SELECT DISTINCT CAST(user_id AS VARCHAR) AS ticker, event_type AS interval,
            CAST(1 AS BIGINT) AS n_files, TRUE AS filled FROM events""",
        "human_sizes": f"""WITH sized AS (SELECT CAST(floor(l_extendedprice * CASE l_linenumber WHEN 1 THEN 1.0::DOUBLE
              WHEN 2 THEN 1e3 WHEN 3 THEN 1e6 WHEN 4 THEN 1e8 WHEN 5 THEN 1e10 WHEN 6 THEN 1e13 WHEN 7 THEN 1e-2
              ELSE 1.0 END) AS BIGINT) AS bytes FROM lineitem)
          SELECT CASE {HUMAN} ELSE printf('%.2f PB', bytes / 1024.0 ** 5) END AS human, count(*) AS rows FROM sized GROUP BY 1""",
        "ratios": """SELECT l_suppkey, l_linenumber, round(CASE WHEN small > 0 THEN big / small ELSE 1 END, 2) AS ratio,
            round(CASE WHEN big > 0 THEN (big - small) / big * 100 ELSE 0 END, 2) AS savings
          FROM (SELECT l_suppkey, l_linenumber, sum(l_extendedprice) AS big,
                       sum(CASE WHEN l_tax > 0 THEN l_quantity ELSE 0 END) AS small FROM lineitem GROUP BY ALL)""",
    }
    from checks import store_oracle  # which takes texts from this module

    return out | store_oracle.statements()

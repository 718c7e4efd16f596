"""DuckDB SQL giving the results of `checks/store_queries.py`, by the same names."""

from __future__ import annotations

from barloom.functions import classify
from checks.oracle import (
    CALENDAR,
    FOUND,
    INSTRUMENTS,
    LANDED,
    LOCAL,
    RANGES,
    TICKS,
    UNIVERSE,
    USER_BARS,
    WIDTHS,
    bars,
    resume,
)

USER_TICKS = TICKS.replace("event_type AS ticker", "CAST(user_id AS VARCHAR) AS ticker")
USER_HOURLY = f"""{USER_TICKS}, hourly AS (
  SELECT ticker, '1h' AS interval, time_bucket(INTERVAL '1 hour', timestamp) AS timestamp,
    first(price ORDER BY timestamp, seq) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY timestamp, seq) AS close,
    CAST(coalesce(sum(size), 0) AS BIGINT) AS volume FROM ticks GROUP BY 1, 3)"""
HOURLY = f"{TICKS}, hourly AS ({bars('1h')})"
STATE = f"""{USER_BARS}, state AS (
  SELECT ticker, interval, count(*) AS records, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp
  FROM user_bars WHERE ticker <> '7' AND NOT (ticker = '8' AND interval = '1m') GROUP BY ALL)"""
GAPPED = f"""{HOURLY}, held AS (
  SELECT * FROM hourly WHERE NOT (day(timestamp) % 7 = length(ticker) % 7 OR hour(timestamp) % 11 = 3))"""
SNAPSHOTS = """snapshots AS (
  SELECT 'b' || p_partkey % 2 AS category, n, created_at, 'P' || p_partkey AS ticker,
    CASE WHEN p_partkey % 4 = 2 AND n > 0 THEN p_name || ' II' ELSE p_name END AS name, p_type AS type
  FROM part, (VALUES (0, '2024-01-01T00:00:00'), (1, '2024-01-11T00:00:00'), (2, '2024-01-21T00:00:00')) v(n, created_at)
  WHERE CASE n WHEN 0 THEN p_partkey % 5 <> 4 WHEN 1 THEN p_partkey % 7 <> 3 ELSE p_partkey % 3 <> 1 END)"""
HISTORY = f"""{SNAPSHOTS}, marked AS (
  SELECT *, lag(n) OVER w IS NOT DISTINCT FROM n - 1 AS follows, lag(name) OVER w AS before
  FROM snapshots WINDOW w AS (PARTITION BY category, ticker ORDER BY n)
), numbered AS (
  SELECT *, sum(CASE WHEN follows AND before = name THEN 0 ELSE 1 END) OVER (PARTITION BY category, ticker ORDER BY n) AS r FROM marked
), spans AS (
  SELECT category, ticker, r, any_value(name) AS name, any_value(type) AS type, min(created_at) AS valid_from,
    CASE max(n) WHEN 0 THEN '2024-01-11T00:00:00' WHEN 1 THEN '2024-01-21T00:00:00' END AS valid_to,
    CASE WHEN arg_min(follows, n) THEN 'changed' ELSE 'added' END AS change
  FROM numbered GROUP BY category, ticker, r
), history AS (
  SELECT category, ticker, name, type, valid_from, valid_to, change, CASE WHEN valid_to IS NOT NULL THEN
    CASE WHEN lead(valid_from) OVER (PARTITION BY category, ticker ORDER BY r) = valid_to THEN 'changed' ELSE 'dropped' END END AS ended
  FROM spans)"""


def late(lateness: str) -> str:
    """Ticks whose hour has ended a while before the last tick of earlier files."""
    return f"""marks AS (
      SELECT p, max(m) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {lateness} AS mark
      FROM (SELECT seq % 5 AS p, max(timestamp) AS m FROM ticks GROUP BY 1)
    ), late AS (
      SELECT p AS batch, ticker, timestamp, price, size FROM ticks JOIN marks ON seq % 5 = p
      WHERE time_bucket(INTERVAL '1 hour', timestamp) + INTERVAL 1 HOUR <= mark)"""


def upper_bars(*labels: str) -> str:
    return f"SELECT * REPLACE (upper(ticker) AS ticker) FROM ({' UNION ALL '.join(bars(label) for label in labels)})"


def corrected() -> str:
    """Bars of orders by number: some days have half their low, and so have the wider bars that hold them."""
    day = """daily AS (
      SELECT 'O' || o_orderkey % 7 AS ticker, CAST(o_orderdate AS TIMESTAMP) AS timestamp,
        first(o_totalprice ORDER BY o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
        last(o_totalprice ORDER BY o_orderkey) AS close, count(*) AS volume,
        o_orderkey % 7 IN (1, 2) AND o_orderdate >= DATE '1998-05-01' AND o_orderdate < DATE '1998-05-20' AS fixed
      FROM orders GROUP BY ALL
    ), days AS (SELECT * REPLACE (CASE WHEN fixed THEN low / 2 ELSE low END AS low) FROM daily)"""
    wide = [
        f"""SELECT ticker, '{label}' AS interval, CAST(date_trunc('{unit}', timestamp) AS TIMESTAMP) AS timestamp, arg_min(open, timestamp) AS open,
          max(high) AS high, min(low) AS low, arg_max(close, timestamp) AS close, CAST(sum(volume) AS BIGINT) AS volume,
          CASE WHEN bool_or(fixed) THEN 0 ELSE 7 END::BIGINT AS ingest_seq FROM days GROUP BY 1, 3"""
        for label, unit in {"1d": "day", **CALENDAR}.items()
    ]
    return f"WITH {day} {' UNION ALL '.join(wide)}"


def outcomes() -> str:
    known = RANGES.replace("ranges AS (", "known AS (", 1)
    return f"""WITH {USER_BARS}, {UNIVERSE}, {known}, ranges AS (
        SELECT u.ticker, v.interval, start_date, end_date FROM universe u
        CROSS JOIN (VALUES ('1m'), ('5m'), ('1h'), ('1d'), ('1w')) v(interval)
        LEFT JOIN known k ON k.ticker = u.ticker AND k.interval = v.interval
      ), {LOCAL}, {resume('local_marks')}, due AS (
        SELECT b.ticker, b.interval, count(*) AS n FROM user_bars b JOIN resume s ON b.ticker = s.ticker AND b.interval = s.interval
        WHERE end_date IS NOT NULL AND s.action = 'fetch' AND timestamp >= resume_from AND timestamp < CAST(end_date + 1 AS TIMESTAMP) GROUP BY ALL
      ), stored AS (SELECT ticker, interval, count(*) AS k FROM local_bars GROUP BY ALL)
      SELECT s.ticker, s.interval, CASE WHEN CAST(s.ticker AS BIGINT) % 11 = 0 THEN 'error' WHEN end_date IS NULL THEN 'no_data_available'
          WHEN action = 'up_to_date' THEN 'up_to_date' WHEN coalesce(n, 0) = 0 THEN 'no_new_data' ELSE 'success' END AS status,
        coalesce(n, 0) AS new_records, coalesce(k, 0) AS total_records,
        CASE WHEN CAST(s.ticker AS BIGINT) % 11 = 0 THEN 'no answer for ' || s.ticker END AS error
      FROM resume s LEFT JOIN due d ON s.ticker = d.ticker AND s.interval = d.interval
      LEFT JOIN stored l ON s.ticker = l.ticker AND s.interval = l.interval"""


def asset_types() -> str:
    quoted = [f"'{n}'" for n in (*classify.CRYPTO_PREFIXES, *classify.KNOWN_ETFS, *classify.ETF_SUFFIXES, "USD", "USDT", "X:", "QQ", "X")]
    crypto = " OR ".join([f"starts_with(t, '{p}')" for p in (*classify.CRYPTO_PREFIXES, "X:")] + ["ends_with(t, 'USD')", "ends_with(t, 'USDT')"])
    funds = " OR ".join(f"ends_with(t, '{s}')" for s in classify.ETF_SUFFIXES)
    return f"""WITH named AS (
        SELECT p_partkey AS k, p_size % 4 AS s, ([{', '.join(quoted)}])[CAST(p_partkey % {len(quoted)} + 1 AS INTEGER)] AS n FROM part
      ), shaped AS (
        SELECT DISTINCT CASE s WHEN 0 THEN n WHEN 1 THEN n || k WHEN 2 THEN 'Z' || k || n ELSE lower(n) END AS ticker FROM named)
      SELECT ticker, CASE WHEN {crypto} THEN 'crypto' WHEN t IN ({', '.join(f"'{n}'" for n in classify.KNOWN_ETFS)}) OR {funds} THEN 'etf' ELSE 'equities' END AS asset_type
      FROM (SELECT ticker, upper(ticker) AS t FROM shaped)"""


def statements() -> dict[str, str]:
    again = "interval = '1h' AND day(timestamp) > 15"
    labels = [*WIDTHS, *CALENDAR]
    spelled = ", ".join(f"'{label}'" for label in (*labels, "7m", "1D", "", "1W", "2d"))
    return {
        "store_runs": f"""WITH {USER_HOURLY} SELECT ticker, interval, timestamp, close + CASE WHEN hour(timestamp) % 5 = 0 THEN 4000
            WHEN hour(timestamp) % 4 = 0 THEN 3000 WHEN hour(timestamp) % 3 = 0 THEN 2000 WHEN hour(timestamp) % 2 = 0 THEN 1000 ELSE 0 END AS close,
            volume FROM hourly""",
        "series_state": f"WITH {STATE} SELECT * FROM state",
        "state_totals": f"""WITH {STATE}, {UNIVERSE}
          SELECT CASE WHEN s.records IS NULL THEN 'no_data' ELSE 'available' END AS status, count(*) AS series,
            CAST(coalesce(sum(s.records), 0) AS BIGINT) AS records, CAST(min(first_timestamp) AS DATE) AS start_date, CAST(max(last_timestamp) AS DATE) AS end_date
          FROM universe u CROSS JOIN (VALUES ('1m'), ('1d')) v(interval) LEFT JOIN state s ON s.ticker = u.ticker AND s.interval = v.interval GROUP BY 1
          UNION ALL SELECT 'all', count(*), count(DISTINCT ticker), NULL, NULL FROM state""",
        "one_identity_details": f"""WITH {TICKS} SELECT CASE WHEN ({again}) OR ticker = 'view' THEN 'equities' ELSE 'etf' END AS asset_type,
            upper(ticker) AS ticker, interval, timestamp, open, CASE WHEN {again} THEN close * 2 ELSE close END AS close, volume
          FROM ({bars('1h')} UNION ALL {bars('1d')})""",
        "unknown_orders": """WITH line AS (
            SELECT l_partkey, l_suppkey, l_linenumber, max(l_extendedprice) AS close FROM lineitem GROUP BY ALL
          ), sides AS (
            SELECT CAST(l_partkey AS VARCHAR) AS ticker, l_suppkey % 2 AS side, max(close) AS close,
              CAST(CASE WHEN l_linenumber % 3 > 0 THEN l_suppkey * 10 + l_linenumber - 100000 END AS BIGINT) AS seq FROM line GROUP BY 1, 2, 4)
          SELECT ticker, '1d' AS interval, TIMESTAMP '2024-01-01' AS timestamp, seq, close FROM (
            SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY side DESC, seq DESC NULLS LAST) AS r FROM sides) WHERE r = 1""",
        "bucket_series": f"""WITH {USER_HOURLY} SELECT ticker, timestamp, open, close, volume FROM hourly
          WHERE ticker = '4' AND timestamp BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'""",
        "stream_batches": f"WITH {TICKS} {upper_bars('1h', '1d', *CALENDAR)}",
        "rebuilt_bins": corrected(),
        "late_repair": f"""WITH {TICKS}, {late('1 HOUR')}, n AS (SELECT count(*) AS late_rows FROM late)
          SELECT b.*, late_rows, CAST(0 AS BIGINT) AS late_again FROM ({upper_bars('1h', '1d', '1w')}) b, n""",
        "late_before_repair": f"WITH {TICKS}, {late('1 DAY')} SELECT * FROM late",
        "streamed_landing": f"""WITH {LANDED} SELECT DISTINCT ticker, CAST(timestamp AS TIMESTAMP) AS timestamp, TRUE AS as_one_read FROM raw
          WHERE timestamp IS NOT NULL AND low IS NOT NULL""",
        "streamed_rejects": """SELECT reject_reason, count(*) AS lines FROM (
            SELECT DISTINCT CASE WHEN l_linenumber >= 7 THEN 'time' ELSE 'low' END AS reject_reason, l_partkey,
              CASE WHEN l_linenumber < 7 THEN l_shipdate END, l_extendedprice, l_extendedprice + l_quantity, l_tax > 0,
              CASE WHEN l_returnflag = 'N' THEN l_quantity END, l_returnflag = 'A', l_suppkey
            FROM lineitem WHERE l_linenumber >= 7 OR NOT l_tax > 0) GROUP BY 1""",
        "market_store": """SELECT 'equities' AS asset_type, 'M' || l_suppkey AS ticker, '1d' AS interval, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS timestamp,
            max(l_extendedprice) - 1 AS open, max(l_extendedprice) * CASE WHEN year(l_shipdate) = 1998 AND month(l_shipdate) = 1 THEN 2 ELSE 1 END AS close,
            CAST(sum(l_quantity) AS BIGINT) AS volume FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE), year(l_shipdate), month(l_shipdate)""",
        "coverage_islands": f"""WITH {GAPPED}, marked AS (
            SELECT *, CASE WHEN timestamp - lag(timestamp) OVER w <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS apart FROM held WINDOW w AS (PARTITION BY ticker ORDER BY timestamp)
          ), numbered AS (SELECT *, sum(apart) OVER (PARTITION BY ticker ORDER BY timestamp) AS r FROM marked)
          SELECT ticker, interval, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp, count(*) AS bars FROM numbered GROUP BY ticker, interval, r""",
        "coverage_gaps": f"""WITH {GAPPED}, hours AS (
            SELECT ticker, interval, unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-02-02 23:00:00', INTERVAL 1 HOUR)) AS h
            FROM (SELECT DISTINCT ticker, interval FROM held)
          ), missing AS (SELECT * FROM hours WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.ticker = hours.ticker AND held.timestamp = h)
          ), marked AS (
            SELECT *, CASE WHEN h - lag(h) OVER (PARTITION BY ticker ORDER BY h) <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS apart FROM missing
          ), numbered AS (SELECT *, sum(apart) OVER (PARTITION BY ticker ORDER BY h) AS r FROM marked)
          SELECT ticker, interval, min(h) AS start, max(h) + INTERVAL 1 HOUR AS stop FROM numbered GROUP BY ticker, interval, r""",
        "load_statuses": outcomes(),
        "universe_history": f"WITH {HISTORY} SELECT * FROM history",
        "universe_as_of": f"""WITH {HISTORY}, lines AS (
            SELECT 'P' || l_partkey AS ticker, CAST(DATE '2023-12-28' + CAST(l_orderkey % 40 AS INTEGER) AS VARCHAR) AS day, count(*) AS lines FROM lineitem GROUP BY 1, 2)
          SELECT l.ticker, day, lines, category, name, valid_from, valid_to, change
          FROM lines l LEFT JOIN history h ON h.ticker = l.ticker AND valid_from <= day AND (valid_to IS NULL OR day < valid_to)""",
        "universe_update_job": f"""WITH {INSTRUMENTS}, {FOUND}
          SELECT category, ticker, CASE WHEN primary_exchange < 'NATION_2' THEN 'old ' || name ELSE name END AS name,
            count(*) OVER (PARTITION BY category) AS count, count(*) FILTER (primary_exchange >= 'NATION_2') OVER (PARTITION BY category) AS new_tickers_added
          FROM found WHERE category IS NOT NULL""",
        "universe_strings": "SELECT c_mktsegment AS category, c_name AS ticker, CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment END AS name FROM customer",
        "category_first": """SELECT category, quantity, line, count(*) AS rows FROM (
            SELECT l_suppkey % 3 AS category, l_quantity AS quantity, l_linenumber AS line,
              row_number() OVER (PARTITION BY l_suppkey % 3 ORDER BY l_quantity, l_linenumber) AS r FROM lineitem) WHERE r <= 1200 GROUP BY ALL""",
        "every_asset_type": asset_types(),
        "day_file_counts": """WITH files AS (SELECT CAST(ts AS DATE) AS date, user_id, count(*) * 4096 AS bytes FROM events GROUP BY 1, 2),
          spine AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS date)
          SELECT s.date, CASE WHEN any_value(user_id) IS NULL THEN 'no_data' ELSE 'success' END AS status,
            count(*) FILTER (user_id % 9 = 0 OR (user_id < 60 AND user_id % 3 = 1)) AS files_downloaded,
            coalesce(sum(bytes) FILTER (user_id % 9 = 0 OR (user_id < 60 AND user_id % 3 = 1)), 0)::DOUBLE / 1048576 AS total_size_mb
          FROM spine s LEFT JOIN files f ON f.date = s.date WHERE isodow(s.date) < 6 GROUP BY 1""",
        "mixed_tick_files": f"""WITH {TICKS}, chosen AS (
            SELECT ticker, timestamp, CASE day(timestamp) WHEN 5 THEN round(price * 100) ELSE price END AS price,
              CASE WHEN day(timestamp) = 3 OR (day(timestamp) = 2 AND ticker = 'click') THEN NULL ELSE size END AS size
            FROM ticks WHERE day(timestamp) BETWEEN 2 AND 5 AND ticker IN ('click', 'view'))
          {bars('1h', 'chosen')}""",
        "exact_sizes": """SELECT l_suppkey, b / 1024.0::DOUBLE AS kb, b / 1048576.0::DOUBLE AS mb
          FROM (SELECT l_suppkey, CAST(sum(floor(l_extendedprice)) AS BIGINT) AS b FROM lineitem GROUP BY 1)""",
        "interval_checks": f"""SELECT interval, interval IN ({', '.join(f"'{label}'" for label in labels)}) AS known, count(*) AS rows FROM (
            SELECT ([{spelled}])[CAST(l_orderkey % {len(labels) + 5} + 1 AS INTEGER)] AS interval FROM lineitem) GROUP BY ALL""",
    }

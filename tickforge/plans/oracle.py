"""The registered queries as plain SQL, for a second engine to check against."""

from __future__ import annotations

import re

ORACLE: dict[str, str] = {}

# The same market-shaped views as in tickforge.tables, plus shared results.
VIEWS = """
WITH priced AS (
  SELECT 'S' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS symbol,
         CAST(l_shipdate AS DATE) AS trading_date,
         l_shipdate + to_milliseconds(l_orderkey * 10 + l_linenumber) AS scrape_time,
         l_returnflag AS source,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS close,
         CAST(l_quantity * 250000 AS BIGINT) AS volume,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2))
              * (1 + CAST(l_discount AS DECIMAL(4,2)) - CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS open,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.03 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS slip,
         l_orderkey, l_linenumber, l_partkey, l_shipdate
  FROM lineitem
), bars_raw AS (
  SELECT symbol, trading_date, scrape_time, source, close, volume, open,
         greatest(open, close) AS high, CAST(open - slip AS DECIMAL(18,4)) AS low
  FROM priced
), bars AS (
  SELECT * FROM bars_raw
  WHERE volume > 0 AND close > 0 AND open > 0 AND high > 0 AND low > 0
    AND high >= low AND high >= close AND low <= close
), eod AS (
  SELECT * FROM bars
  QUALIFY row_number() OVER (PARTITION BY symbol, trading_date
    ORDER BY scrape_time DESC, close DESC, volume DESC, open DESC, source, high, low) = 1
), ticked AS (
  SELECT 'U' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS symbol, CAST(ts AS DATE) AS trading_date,
         ts AS scrape_time, event_type AS source,
         CAST(CAST(value AS DECIMAL(12,2)) + 10 AS DECIMAL(18,4)) AS close,
         (CAST(json_extract_string(props, '$.k') AS BIGINT) + 1) * 120000 AS volume,
         CAST((CAST(value AS DECIMAL(12,2)) + 10) + (CAST(value AS DECIMAL(12,2)) + 10)
              * CAST((event_id % 11) - 5 AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS open
  FROM events
), ticks AS (
  SELECT *, greatest(open, close) AS high, least(open, close) AS low FROM ticked
), symbols AS (
  SELECT s_suppkey AS id, 'S' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS symbol, s_name AS bank_name,
         n_name AS source, CASE WHEN s_acctbal >= 0 THEN 1 ELSE 0 END AS status
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
), doubled AS (
  SELECT *, 0 AS copy FROM priced
  UNION ALL
  SELECT * REPLACE (CAST(close + 1 AS DECIMAL(18,4)) AS close), 1 AS copy FROM priced WHERE l_linenumber = 1
), raw_text AS (
  SELECT CASE l_linenumber % 3 WHEN 0 THEN ' ' || lower(symbol) WHEN 1 THEN symbol || ' ' ELSE symbol END AS symbol,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN 'junk'
              WHEN l_orderkey % 4 = 0 THEN CAST(epoch_ms(l_shipdate) AS VARCHAR)
              WHEN l_orderkey % 4 = 1 THEN strftime(trading_date, '%Y-%m-%d')
              WHEN l_orderkey % 4 = 2 THEN strftime(trading_date, '%d/%m/%Y')
              ELSE strftime(trading_date, '%d-%m-%Y') END AS trading_date,
         CASE WHEN l_linenumber % 2 = 0 THEN CAST(epoch_ms(scrape_time) AS VARCHAR)
              ELSE strftime(scrape_time, '%Y-%m-%d %H:%M:%S.%g') END AS scrape_time,
         CASE WHEN copy = 1 THEN 'Z' ELSE source END AS source,
         CASE l_partkey % 50 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN 'null' WHEN 3 THEN '\\N' WHEN 4 THEN 'abc'
              WHEN 5 THEN NULL ELSE CAST(close AS VARCHAR) END AS close_price,
         volume,
         CAST(open AS VARCHAR) AS open_price,
         CAST(greatest(open, CAST(close - copy AS DECIMAL(18,4))) AS VARCHAR) AS high_price,
         CAST(CAST(open - slip AS DECIMAL(18,4)) AS VARCHAR) AS low_price
  FROM doubled
), day_parsed AS (
  SELECT *, coalesce(CAST(try_strptime(trading_date, '%Y-%m-%d') AS DATE),
                     CAST(try_strptime(trading_date, '%d/%m/%Y') AS DATE),
                     CAST(try_strptime(trading_date, '%d-%m-%Y') AS DATE)) AS text_day
  FROM raw_text
), typed AS (
  SELECT upper(trim(symbol)) AS symbol,
         coalesce(CAST(epoch_ms(TRY_CAST(trading_date AS BIGINT)) AS DATE), text_day) AS trading_date,
         coalesce(epoch_ms(TRY_CAST(scrape_time AS BIGINT)), TRY_CAST(scrape_time AS TIMESTAMP)) AS scrape_time,
         source, TRY_CAST(close_price AS DECIMAL(18,4)) AS close, volume,
         TRY_CAST(open_price AS DECIMAL(18,4)) AS open, TRY_CAST(high_price AS DECIMAL(18,4)) AS high,
         TRY_CAST(low_price AS DECIMAL(18,4)) AS low,
         symbol AS raw_symbol, trading_date AS raw_date, scrape_time AS raw_time, close_price
  FROM day_parsed
), volumes AS (
  SELECT symbol, trading_date AS calc_date, max(volume) AS total_volume FROM bars GROUP BY ALL
), market AS (
  SELECT 'MARKET' AS symbol, trading_date AS calc_date, CAST(sum(volume) AS BIGINT) AS total_volume
  FROM eod GROUP BY trading_date
), drops AS (
  SELECT symbol, trading_date AS calc_date,
         CAST(round(max(greatest(open - low, 0)), 2) AS DECIMAL(18,2)) AS max_intraday_drop
  FROM bars GROUP BY ALL
), ranges AS (
  SELECT symbol, trading_date AS calc_date,
         CAST(round(max(close) OVER w, 2) AS DECIMAL(18,2)) AS max_close_price,
         CAST(round(min(close) OVER w, 2) AS DECIMAL(18,2)) AS min_close_price
  FROM eod WINDOW w AS (PARTITION BY symbol ORDER BY trading_date ROWS UNBOUNDED PRECEDING)
), day_ranges AS (
  SELECT symbol, trading_date AS calc_date, CAST(round(max(close), 2) AS DECIMAL(18,2)) AS max_close_price,
         CAST(round(min(close), 2) AS DECIMAL(18,2)) AS min_close_price
  FROM eod GROUP BY symbol, trading_date
), close_signs AS (
  SELECT symbol, trading_date, CAST(sign(close - lag(close) OVER (PARTITION BY symbol ORDER BY trading_date)) AS INT) AS s
  FROM eod WHERE dayofweek(trading_date) NOT IN (0, 6)
), close_breaks AS (
  SELECT *, CASE WHEN s IS DISTINCT FROM lag(s) OVER (PARTITION BY symbol ORDER BY trading_date) THEN 1 ELSE 0 END AS b
  FROM close_signs
), close_islands AS (
  SELECT *, sum(b) OVER (PARTITION BY symbol ORDER BY trading_date ROWS UNBOUNDED PRECEDING) AS i FROM close_breaks
), close_runs AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, i ORDER BY trading_date) AS run FROM close_islands
), streaks AS (
  SELECT symbol, trading_date AS calc_date, CAST(CASE WHEN s = 1 THEN run ELSE 0 END AS INT) AS up_days_count,
         CAST(CASE WHEN s = -1 THEN run ELSE 0 END AS INT) AS down_days_count
  FROM close_runs
), candle_signs AS (
  SELECT symbol, trading_date, CAST(sign(close - open) AS INT) AS s FROM eod
), candle_breaks AS (
  SELECT *, CASE WHEN s IS DISTINCT FROM lag(s) OVER (PARTITION BY symbol ORDER BY trading_date) THEN 1 ELSE 0 END AS b
  FROM candle_signs
), candle_islands AS (
  SELECT *, sum(b) OVER (PARTITION BY symbol ORDER BY trading_date ROWS UNBOUNDED PRECEDING) AS i FROM candle_breaks
), candle_runs AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, i ORDER BY trading_date) AS run FROM candle_islands
), candle_streaks AS (
  SELECT symbol, trading_date AS calc_date, CAST(CASE WHEN s = 1 THEN run ELSE 0 END AS INT) AS up_days_count,
         CAST(CASE WHEN s = -1 THEN run ELSE 0 END AS INT) AS down_days_count
  FROM candle_runs
), volatility AS (
  SELECT symbol, trading_date AS calc_date, CAST(round(high - low, 2) AS DECIMAL(18,2)) AS max_intraday_volatility FROM eod
), classes AS (
  SELECT symbol, trading_date AS calc_date,
         CASE WHEN volume >= 10000000 THEN 'High' WHEN volume >= 5000000 THEN 'Medium' ELSE 'Low' END AS liquidity_status
  FROM eod
), liquidity AS (
  SELECT * FROM classes WHERE dayofweek(calc_date) NOT IN (0, 6)
), records AS (
  SELECT symbol, trading_date AS max_volume_date, volume AS max_volume_value FROM bars
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY volume DESC, trading_date) = 1
), sma_sums AS (
  SELECT symbol, trading_date AS calc_date, CAST(sum(close) OVER w * 10000 AS HUGEINT) AS t, count(close) OVER w AS n
  FROM eod WINDOW w AS (PARTITION BY symbol ORDER BY trading_date ROWS 4 PRECEDING)
), smas AS (
  SELECT symbol, calc_date, CAST((2 * t + 100 * n) // (200 * n) AS DOUBLE) / 100 AS sma_price FROM sma_sums
), months AS (
  SELECT symbol, CAST(year(trading_date) AS INT) AS calc_year, CAST(month(trading_date) AS INT) AS calc_month,
         CAST((2 * CAST(sum(close) * 10000 AS HUGEINT) + 100 * count(close)) // (200 * count(close)) AS DOUBLE) / 100
           AS monthly_avg_close,
         CAST(sum(volume) AS BIGINT) AS monthly_total_volume
  FROM eod GROUP BY ALL
), daily AS (
  SELECT symbol, calc_date, v.total_volume, CAST(max_close_price AS DOUBLE) AS max_close_price,
         CAST(min_close_price AS DOUBLE) AS min_close_price, up_days_count, down_days_count, max_volume_date,
         max_volume_value, CAST(max_intraday_volatility AS DOUBLE) AS max_intraday_volatility, liquidity_status,
         CAST(max_intraday_drop AS DOUBLE) AS max_intraday_drop, sma_price
  FROM volumes v LEFT JOIN ranges USING (symbol, calc_date) LEFT JOIN streaks USING (symbol, calc_date)
    LEFT JOIN volatility USING (symbol, calc_date) LEFT JOIN liquidity USING (symbol, calc_date)
    LEFT JOIN drops USING (symbol, calc_date) LEFT JOIN smas USING (symbol, calc_date) LEFT JOIN records USING (symbol)
  UNION ALL
  SELECT symbol, calc_date, total_volume, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM market
), increments AS (
  SELECT symbol, trading_date AS calc_date, CAST(sum(volume) AS BIGINT) AS total_volume FROM bars GROUP BY ALL
), increment_daily AS (
  SELECT symbol, calc_date, total_volume, CAST(max_close_price AS DOUBLE) AS max_close_price,
         CAST(min_close_price AS DOUBLE) AS min_close_price, up_days_count, down_days_count,
         CAST(NULL AS DATE) AS max_volume_date, CAST(NULL AS BIGINT) AS max_volume_value,
         CAST(max_intraday_volatility AS DOUBLE) AS max_intraday_volatility, liquidity_status,
         CAST(max_intraday_drop AS DOUBLE) AS max_intraday_drop, sma_price
  FROM increments LEFT JOIN day_ranges USING (symbol, calc_date) LEFT JOIN candle_streaks USING (symbol, calc_date)
    LEFT JOIN volatility USING (symbol, calc_date) LEFT JOIN classes USING (symbol, calc_date)
    LEFT JOIN drops USING (symbol, calc_date) LEFT JOIN smas USING (symbol, calc_date)
), filler AS (
  SELECT symbol, calc_date, total_volume, CAST(0 AS DOUBLE) AS max_close_price, CAST(0 AS DOUBLE) AS min_close_price,
         0 AS up_days_count, 0 AS down_days_count, calc_date AS max_volume_date, total_volume AS max_volume_value,
         CAST(0 AS DOUBLE) AS max_intraday_volatility, 'STABLE' AS liquidity_status,
         CAST(0 AS DOUBLE) AS max_intraday_drop, CAST(0 AS DOUBLE) AS sma_price
  FROM market
), changes AS (
  SELECT symbol, trading_date, close, volume, prev_close, close - prev_close AS change,
         CAST(close AS DOUBLE) / CAST(prev_close AS DOUBLE) - 1 AS pct
  FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY trading_date) AS prev_close FROM eod)
), ohlc AS (
  SELECT symbol, trading_date, arg_min(open, scrape_time) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, scrape_time) AS close, CAST(sum(volume) AS BIGINT) AS volume
  FROM bars GROUP BY symbol, trading_date
)
"""


def _strict(n: int, source: str) -> str:
    """Moving average that is null until ``n`` rows exist, as a window expression."""
    window = f"(PARTITION BY symbol ORDER BY trading_date ROWS {n - 1} PRECEDING)"
    return (
        f"CASE WHEN count({source}) OVER {window} = {n} "
        f"THEN CAST(sum({source}) OVER {window} AS DOUBLE) / {n} END"
    )


def _ctes(text: str) -> dict[str, str]:
    """Common table expressions by name, from text of the form ``a AS (...), b AS (...)``."""
    found, at = {}, 0
    for head in re.finditer(r"(\w+) AS \(", text):
        if head.start() < at:
            continue
        depth, at, quoted = 1, head.end(), False
        while depth:
            c = text[at]
            quoted ^= c == "'"
            depth += 0 if quoted else (c == "(") - (c == ")")
            at += 1
        found[head[1]] = text[head.end(): at - 1]
    return found


SHARED = _ctes(VIEWS)


def add(name: str, body: str, ctes: str = "") -> None:
    """Registers a statement with only those common table expressions it needs."""
    known = {**SHARED, **_ctes(ctes)}
    needed, todo = set(), [body]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        todo += [known[w] for w in words & known.keys() - needed]
        needed |= words & known.keys()
    listed = ", ".join(f"{n} AS ({sql})" for n, sql in known.items() if n in needed)
    ORACLE[name] = f"WITH {listed}\n{body}" if listed else body


PRICES = ("close", "open", "high", "low")


def _history(source: str = "*", prefix: str = "") -> str:
    """History columns with prices as doubles."""
    return ", ".join(
        ["symbol", "trading_date", "scrape_time", "source", "volume", *[f"CAST({c} AS DOUBLE) AS {c}" for c in PRICES]]
    )


H = _history()
NO_TIME = H.replace("scrape_time, ", "")

# Sources
add("s01_history_scan", f"SELECT {H} FROM bars")
add("s01_history_range", f"SELECT {H} FROM bars WHERE trading_date BETWEEN DATE '1996-03-05' AND DATE '1998-02-28'")
add("s02_raw_text_scan", "SELECT * FROM raw_text")
BATCH = "CASE WHEN hour(scrape_time) < 13 THEN 1145 ELSE 1515 END"
add("s03_partitioned_scan", f"""SELECT {H}, CAST(year(trading_date) AS INT) AS p_year, CAST(month(trading_date) AS INT) AS p_month,
  CAST(day(trading_date) AS INT) AS p_day, {BATCH} AS p_batch FROM ticks""")
add("s04_json_batch_scan", """SELECT symbol, CAST(trading_date AS VARCHAR) AS trading_date, CAST(scrape_time AS VARCHAR) AS scrape_time,
  source, volume, CAST(close AS DOUBLE) AS close_price, CAST(open AS DOUBLE) AS open_price,
  CAST(high AS DOUBLE) AS high_price, CAST(low AS DOUBLE) AS low_price FROM ticks""")
add("s05_json_or_empty", "SELECT * FROM volumes")
add("s06_positional_scan", f"SELECT {H} FROM bars")
add("s07_tolerant_scan", f"""SELECT {H.replace('symbol,', 'trim(raw_symbol) AS symbol,')} FROM typed
  WHERE (source = 'Z' OR (volume % 13 <> 0 AND volume % 11 <> 0)) AND trading_date IS NOT NULL AND close IS NOT NULL""")
add("s08_newest_rows_pushed", f"""SELECT {H} FROM bars WHERE trading_date >= DATE '1998-01-01'
  AND symbol IN (SELECT symbol FROM symbols WHERE status = 1)
  ORDER BY bars.trading_date DESC, bars.symbol, bars.scrape_time DESC, bars.close DESC, bars.volume DESC, bars.source LIMIT 1000""")
add("s09_table_import", f"SELECT {H} FROM bars_raw")
add("s10_serving_scan", """SELECT *, max_close_price AS avg_close_price FROM daily
  WHERE calc_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
add("s11_fallback_scan", "SELECT * FROM volumes")
add("s12_active_symbols", "SELECT symbol, source FROM symbols WHERE status = 1")
add("s12_fallback_symbols", "SELECT unnest(['VCB', 'BID', 'CTG', 'MBB', 'TCB', 'VPB', 'ACB', 'STB']) AS symbol, 'CafeF' AS source "
    "UNION ALL SELECT unnest(['SHB', 'HDB', 'VIB', 'TPB', 'EIB', 'MSB', 'SSB', 'LPB']), 'TCBS' "
    "UNION ALL SELECT unnest(['OCB', 'NAB', 'KLB', 'BVB']), 'FireAnt'")
add("s13_buffered_csv", f"SELECT {H} FROM ticks")
add("s15_catalogue_scan", "SELECT * FROM symbols ORDER BY id")

# Sinks
add("k01_history_append", f"SELECT {H} FROM bars")
add("k02_text_export", """SELECT symbol, CAST(trading_date AS VARCHAR) AS trading_date, CAST(scrape_time AS VARCHAR) AS scrape_time,
  source, CAST(close AS VARCHAR) AS close, CAST(volume AS VARCHAR) AS volume, CAST(open AS VARCHAR) AS open,
  CAST(high AS VARCHAR) AS high, CAST(low AS VARCHAR) AS low FROM bars""")
add("k03_json_result", "SELECT symbol, calc_date, CAST(max_intraday_drop AS DOUBLE) AS max_intraday_drop FROM drops")
add("k04_partition_overwrite", f"""SELECT {H.replace('volume', "CASE WHEN trading_date >= DATE '2024-01-15' THEN volume ELSE 0 END AS volume")} FROM ticks""")
VOLUME_JSON = """'{"symbol":"' || symbol || '","calc_date":"' || calc_date || '","total_volume":' || total_volume || '}'"""
add("k04_compacted_history", f"SELECT {H} FROM bars")
add("k05_daily_messages", f"SELECT {VOLUME_JSON} AS value FROM (SELECT * FROM volumes UNION ALL SELECT * FROM market)")
add("k06_keyed_messages", """SELECT symbol AS key, '{"symbol":"' || symbol || '","calc_date":"' || calc_date ||
  '","total_volume":null,"max_close_price":null,"min_close_price":null,"up_days_count":null,"down_days_count":null,' ||
  '"max_volume_date":null,"max_volume_value":null,"max_intraday_volatility":null,"liquidity_status":null,' ||
  '"max_intraday_drop":' || max_intraday_drop || ',"sma_price":null}' AS value FROM drops""")
add("k07_snapshot_messages", """SELECT '{"symbol":"' || symbol || '","trading_date":"' || trading_date || '","scrape_time":"' ||
  strftime(scrape_time, '%Y-%m-%dT%H:%M:%S.%f') || '","source":"' || source || '","close":' || close || ',"volume":' || volume ||
  ',"open":' || open || ',"high":' || high || ',"low":' || low || '}' AS value FROM ticks""")
add("k11_raw_append", "SELECT * FROM raw_text")
add("k12_json_batches", f"""SELECT CAST(year(scrape_time) AS INT) AS year, CAST(month(scrape_time) AS INT) AS month,
  CAST(day(scrape_time) AS INT) AS day, {BATCH} AS batch, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume
  FROM ticks GROUP BY ALL""")
add("k13_landing_reset", "SELECT trading_date, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY ALL")
add("k14_view_export", "SELECT symbol, calc_year, calc_month, monthly_total_volume FROM months")
RANGE = """symbol, calc_date, CAST(max_close_price AS DOUBLE) AS max_close_price,
  CAST(min_close_price AS DOUBLE) AS min_close_price"""
add("k15_preview", f"SELECT {RANGE} FROM ranges ORDER BY symbol, calc_date LIMIT 10")
add("k16_catalogue_changes", """SELECT id, symbol,
    CASE WHEN id % 5 = 0 THEN bank_name || ' new' WHEN id % 5 = 2 THEN bank_name || ' again' ELSE bank_name END AS bank_name,
    CASE WHEN id % 5 = 0 THEN 'More' WHEN id % 5 = 2 THEN 'Again' ELSE source END AS source,
    CASE WHEN id % 5 IN (0, 1) THEN 1 - status WHEN id % 5 = 2 THEN 1 ELSE status END AS status
  FROM symbols WHERE id % 5 <> 2 OR id % 2 = 0
  UNION ALL
  SELECT c_custkey + 1000000000, 'C' || lpad(CAST(c_custkey AS VARCHAR), 6, '0'), c_name, c_mktsegment, 1 FROM customer""")

# Projections
add("p01_symbol_normalised", "SELECT upper(trim(symbol)) AS symbol, count(*) AS n FROM raw_text GROUP BY ALL")
add("p02_epoch_millis", """SELECT scrape_time, epoch_ms(TRY_CAST(scrape_time AS BIGINT)) AS moment,
  CAST(epoch_ms(TRY_CAST(trading_date AS BIGINT)) AS DATE) AS day FROM raw_text""")
add("p03_typed_columns", f"SELECT {H} FROM typed")
add("p04_partition_date", """SELECT symbol, trading_date AS calc_date, CAST(sum(volume) AS BIGINT) AS total_volume
  FROM ticks GROUP BY ALL""")
add("p05_market_key", """SELECT trading_date AS calc_date, CAST(sum(volume) AS BIGINT) AS total_volume, 'MARKET' AS symbol
  FROM bars GROUP BY ALL""")
add("p06_renamed_columns", """SELECT symbol, trading_date AS calc_date, CAST(close AS DOUBLE) AS close_price,
  volume AS traded FROM bars""")
add("p07_disjoint_join", "SELECT * FROM volumes LEFT JOIN records USING (symbol)")
add("p08_canonical_frame", f"SELECT {H.replace('symbol,', 'raw_symbol AS symbol,')} FROM typed WHERE trading_date IS NOT NULL")
add("p09_display_alias", f"SELECT {RANGE}, CAST(max_close_price AS DOUBLE) AS avg_close_price FROM ranges")
add("p10_optional_columns", "SELECT symbol, trading_date, CAST(close AS DOUBLE) AS close, volume FROM bars")
add("p11_date_text", """SELECT symbol, CAST(calc_date AS VARCHAR) AS calc_date,
  CAST(max_intraday_volatility AS DOUBLE) AS max_intraday_volatility FROM volatility""")
add("p12_row_json", """SELECT '{"symbol":"' || symbol || '","calc_year":' || calc_year || ',"calc_month":' || calc_month ||
  ',"monthly_total_volume":' || monthly_total_volume || '}' AS value FROM months""")
add("p13_batch_label", f"SELECT symbol, scrape_time, CAST({BATCH} AS VARCHAR) AS batch FROM ticks")

# Filters
add("f01_missing_rejected", """SELECT * FROM raw_text WHERE symbol IS NOT NULL AND trading_date IS NOT NULL
  AND close_price IS NOT NULL AND close_price NOT IN ('', 'NULL', 'null')""")
add("f02_sane_bars", f"SELECT {H} FROM bars")
BEST = "scrape_time DESC, close DESC, volume DESC, open DESC, source, high, low"
BEST_NULLS = ("scrape_time DESC NULLS LAST, close DESC NULLS LAST, volume DESC NULLS LAST, open DESC NULLS LAST, "
              "source NULLS FIRST, high NULLS FIRST, low NULLS FIRST")
add("f03_clean_history", f"""SELECT {H} FROM (
    SELECT * FROM typed WHERE raw_symbol IS NOT NULL AND close_price IS NOT NULL
      AND close_price NOT IN ('', 'NULL', 'null') AND trading_date IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY symbol, trading_date, scrape_time ORDER BY {BEST_NULLS}) = 1)
  WHERE volume > 0 AND close > 0 AND open > 0 AND high > 0 AND low > 0 AND high >= low AND high >= close AND low <= close""")
add("f04_clean_raw_keys", f"""SELECT {H} FROM (SELECT * FROM typed
    QUALIFY row_number() OVER (PARTITION BY raw_symbol, raw_date, raw_time ORDER BY {BEST_NULLS}) = 1)""")
add("f05_weekdays", f"SELECT {H} FROM bars WHERE dayofweek(trading_date) NOT IN (0, 6)")
add("f06_parsable_dates", "SELECT trading_date AS day, count(*) AS n FROM typed WHERE trading_date IS NOT NULL GROUP BY ALL")
add("f07_symbol_list", f"SELECT {H} FROM bars WHERE symbol IN ('S000001', 'S000003', 'S000007')")
add("f07_stored_symbols", f"SELECT {H} FROM bars WHERE symbol IN ('S000001', 'S000003', 'S000007')")
add("f08_date_range", f"SELECT {H} FROM bars WHERE trading_date BETWEEN DATE '1996-03-01' AND DATE '1998-02-28'")
add("f09_look_back", f"""SELECT {H} FROM bars
  WHERE trading_date BETWEEN DATE '2000-06-30' - INTERVAL 730 DAY AND DATE '2000-06-30'""")
add("f10_day_formats", "SELECT trading_date, text_day AS day FROM day_parsed")
add("f11_intraday_slice", f"SELECT {H} FROM ticks WHERE symbol = 'U000001' AND trading_date = DATE '2024-01-05'")
add("f12_search", f"SELECT {H} FROM ticks WHERE contains(lower(source), 'click')")
add("f12_search_regex", f"SELECT {H} FROM ticks WHERE source IN ('click', 'view')")
add("f12_stored_search", f"SELECT {H} FROM bars WHERE contains(lower(symbol), 's00000') OR contains(lower(source), 's00000')")
add("f12_stored_search_regex", f"SELECT {H} FROM bars WHERE source = 'R' OR symbol = 'S000007'")
add("f13_years", f"SELECT {H} FROM bars WHERE year(trading_date) IN (1996, 1999)")
add("f14_month_range", f"SELECT {H} FROM bars WHERE trading_date BETWEEN DATE '1996-11-01' AND DATE '1997-02-28'")
add("f15_rank_one", f"""SELECT {H} FROM (SELECT * FROM bars
    QUALIFY row_number() OVER (PARTITION BY source, trading_date ORDER BY volume DESC, {BEST}, symbol) = 1)""")
add("f16_status", "SELECT * FROM symbols WHERE status = 0")
add("f17_candle_split", """SELECT symbol, CASE WHEN close >= open THEN 'up' ELSE 'down' END AS direction, count(*) AS n
  FROM bars GROUP BY ALL""")

# Joins
for _name in ("j01_daily_outer_join", "j01_stored_outer_join"):
    add(_name, "SELECT * EXCLUDE (max_volume_date, max_volume_value, sma_price) FROM daily")
add("j02_record_day_join", """SELECT * FROM (SELECT * FROM volumes UNION ALL SELECT * FROM market)
  LEFT JOIN records USING (symbol)""")
for _name in ("j03_monthly_outer_join", "j03_stored_outer_join"):
    add(_name, """SELECT symbol, calc_year, calc_month, a.monthly_avg_close, b.monthly_total_volume
  FROM months a FULL JOIN raw_months b USING (symbol, calc_year, calc_month)""",
        """raw_months AS (SELECT symbol, CAST(year(trading_date) AS INT) AS calc_year, CAST(month(trading_date) AS INT) AS calc_month,
  CAST(sum(volume) AS BIGINT) AS monthly_total_volume FROM (SELECT * FROM bars_raw
    QUALIFY row_number() OVER (PARTITION BY symbol, trading_date
      ORDER BY scrape_time DESC, close DESC, volume DESC, open DESC, source, high, low) = 1) GROUP BY ALL)""")
add("j04_catalogue_lookup", """SELECT v.symbol, calc_date, total_volume, bank_name, coalesce(source, 'CafeF') AS listed_source
  FROM volumes v LEFT JOIN (SELECT * FROM symbols WHERE id % 7 <> 0) k ON v.symbol = k.symbol""")
add("j05_unlisted_symbols", """SELECT DISTINCT symbol FROM bars
  WHERE symbol NOT IN (SELECT symbol FROM symbols WHERE status = 1)""")
add("j05_listed_symbols", """SELECT DISTINCT symbol FROM bars
  WHERE symbol IN (SELECT symbol FROM symbols WHERE status = 1)""")
add("j06_rerun_guard", f"SELECT {H} FROM bars")
add("j06_marked_append", f"SELECT {H} FROM bars")

# Aggregations
add("a01_daily_volume_max", "SELECT * FROM volumes")
add("a02_daily_volume_sum", "SELECT * FROM increments")
add("a03_max_intraday_drop", "SELECT symbol, calc_date, CAST(max_intraday_drop AS DOUBLE) AS max_intraday_drop FROM drops")
add("a04_market_volume", "SELECT * FROM market")
add("a05_monthly_volume", "SELECT symbol, calc_year, calc_month, monthly_total_volume FROM months")
add("a06_monthly_average_close", "SELECT symbol, calc_year, calc_month, monthly_avg_close FROM months")
add("a07_daily_close_range", f"SELECT {RANGE} FROM day_ranges")
add("a08_record_volume_day", "SELECT * FROM records")
BAR = "symbol, trading_date, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in PRICES) + ", volume"
TICK_BARS = """bars_of_ticks AS (SELECT symbol, trading_date, arg_min(open, scrape_time) AS open, max(high) AS high,
  min(low) AS low, arg_max(close, scrape_time) AS close, CAST({}(volume) AS BIGINT) AS volume FROM ticks GROUP BY symbol, trading_date)"""
add("a09_ohlc_bars", f"SELECT {BAR} FROM bars_of_ticks", TICK_BARS.format("sum"))
add("a09_ohlc_bars_max_volume", f"SELECT {BAR} FROM bars_of_ticks", TICK_BARS.format("max"))
YEARLY = """yearly AS (SELECT CAST(year(trading_date) AS INT) AS year, symbol, CAST(sum(volume) AS BIGINT) AS volume
  FROM bars GROUP BY ALL)"""
add("a10_yearly_volume", "SELECT * FROM yearly", YEARLY)


def _wide(source: str, column: str, value: str, key: str) -> str:
    """A pivot whose columns come from the data; its source has to be a whole statement."""
    return f"(PIVOT ({ORACLE[source]}) ON {column} USING {value} GROUP BY {key})"


ORACLE["a10_yearly_volume_pivot"] = "SELECT * FROM " + _wide("a10_yearly_volume", "year", "CAST(sum(volume) AS BIGINT)", "symbol")
ORACLE["a10_yearly_volume_pivot_zero"] = "SELECT * FROM " + _wide(
    "a10_yearly_volume", "year", "CAST(coalesce(sum(volume), 0) AS BIGINT)", "symbol")
ORACLE["a10_yearly_matrix"] = "SELECT * FROM " + _wide(
    "a10_yearly_volume", "symbol", "CAST(coalesce(sum(volume), 0) AS BIGINT)", "year") + f""" JOIN (
  SELECT year, CAST(sum(volume) AS BIGINT) AS total FROM ({ORACLE["a10_yearly_volume"]}) GROUP BY year) USING (year)"""
add("a10_yearly_map", "SELECT year, symbol, volume, CAST(sum(volume) OVER (PARTITION BY year) AS BIGINT) AS total FROM yearly", YEARLY)
add("a11_yearly_totals", "SELECT year, CAST(sum(volume) AS BIGINT) AS total_volume FROM yearly GROUP BY year", YEARLY)
add("a12_monthly_absolute_change", """SELECT symbol, strftime(trading_date, '%Y-%m') AS month,
  round(avg(abs(pct)) * 100, 6) AS mean_abs_pct FROM changes
  WHERE strftime(trading_date, '%Y-%m') IN (SELECT DISTINCT strftime(trading_date, '%Y-%m') FROM eod ORDER BY 1 DESC LIMIT 18)
  GROUP BY ALL""")


ORACLE["a12_monthly_change_matrix"] = "SELECT * FROM " + _wide("a12_monthly_absolute_change", "month", "max(mean_abs_pct)", "symbol")


def _box(pattern: str) -> tuple[str, str]:
    ctes = f"""grouped AS (SELECT symbol, strftime(trading_date, '{pattern}') AS period, list(CAST(close AS DOUBLE)) AS c,
    quantile_cont(CAST(close AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM eod GROUP BY ALL),
  fenced AS (SELECT symbol, period, c, q,
    list_filter(c, lambda x: x >= q[1] - 1.5 * (q[3] - q[1]) AND x <= q[3] + 1.5 * (q[3] - q[1])) AS inside,
    list_filter(c, lambda x: x < q[1] - 1.5 * (q[3] - q[1]) OR x > q[3] + 1.5 * (q[3] - q[1])) AS outside FROM grouped)"""
    body = """SELECT symbol, period, round(list_min(c), 4) AS min_close, round(q[1], 4) AS q1, round(q[2], 4) AS median,
    round(q[3], 4) AS q3, round(list_max(c), 4) AS max_close, round(list_min(inside), 4) AS whisker_low,
    round(list_max(inside), 4) AS whisker_high, CAST(len(c) AS INT) AS n, CAST(len(outside) AS INT) AS n_outliers,
    round(coalesce(list_sum(outside), 0), 4) AS outlier_sum FROM fenced"""
    return body, ctes


add("a13_monthly_distribution", *_box("%Y-%m"))
add("a13_month_of_year_distribution", *_box("%m"))
add("a13_approximate_distribution", "SELECT symbol, strftime(trading_date, '%Y-%m') AS period, "
    "CAST(min(close) AS DOUBLE) AS min_close, CAST(max(close) AS DOUBLE) AS max_close, " + ", ".join(
        f"quantile_disc(CAST(bars.close AS DOUBLE), {q}) AS q{i}" for i, q in enumerate((0.25, 0.5, 0.75), 1)) + " FROM bars GROUP BY ALL")
def _sketched(pattern: str) -> tuple[str, str]:
    ctes = f"""grouped AS (SELECT symbol, strftime(trading_date, '{pattern}') AS period, list(CAST(bars.close AS DOUBLE)) AS c,
    quantile_disc(CAST(bars.close AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM bars GROUP BY ALL),
  fenced AS (SELECT symbol, period, c, q,
    list_filter(c, lambda x: x >= q[1] - 1.5 * (q[3] - q[1]) AND x <= q[3] + 1.5 * (q[3] - q[1])) AS inside,
    list_filter(c, lambda x: x < q[1] - 1.5 * (q[3] - q[1]) OR x > q[3] + 1.5 * (q[3] - q[1])) AS outside FROM grouped)"""
    body = """SELECT symbol, period, round(list_min(c), 4) AS min_close, round(q[1], 4) AS q1, round(q[2], 4) AS median,
    round(q[3], 4) AS q3, round(list_max(c), 4) AS max_close, round(list_min(inside), 4) AS whisker_low,
    round(list_max(inside), 4) AS whisker_high, CAST(len(c) AS BIGINT) AS n, CAST(len(outside) AS BIGINT) AS n_outliers,
    round(coalesce(list_sum(outside), 0), 4) AS outlier_sum FROM fenced"""
    return body, ctes


# Exact quartiles: groups of these data sets stay below the size from which a sketch approximates.
add("s01_sketched_distribution", *_sketched("%Y-%m"))
add("s01_sketched_month_of_year", *_sketched("%m"))
add("a14_symbol_statistics", """SELECT symbol, CAST(price AS DOUBLE) AS price, round(sma20, 6) AS sma20, round(sma50, 6) AS sma50,
    round((CAST(price AS DOUBLE) / CAST(first_close AS DOUBLE) - 1) * 100, 6) AS return_pct, round(volatility, 6) AS volatility,
    CAST(max_close AS DOUBLE) AS max_close, CAST(min_close AS DOUBLE) AS min_close, max_volume, max_vol_date, max_var_date
  FROM (SELECT symbol, arg_max(close, trading_date) AS price, arg_min(close, trading_date) AS first_close,
      max(close) AS max_close, min(close) AS min_close, max(volume) AS max_volume FROM eod GROUP BY symbol)
  JOIN (SELECT symbol, sma20, sma50 FROM averaged QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trading_date DESC) = 1) USING (symbol)
  JOIN (SELECT symbol, stddev_samp(pct) * sqrt(252) * 100 AS volatility FROM changes GROUP BY symbol) USING (symbol)
  JOIN (SELECT symbol, trading_date AS max_vol_date FROM eod
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY volume DESC, trading_date) = 1) USING (symbol)
  JOIN (SELECT symbol, trading_date AS max_var_date FROM changes WHERE pct IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY abs(pct) DESC, trading_date) = 1) USING (symbol)""",
    f"averaged AS (SELECT symbol, trading_date, {_strict(20, 'close')} AS sma20, {_strict(50, 'close')} AS sma50 FROM eod)")
add("a15_source_shares", """SELECT source, count(*) AS members,
  round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM symbols), 6) AS share_pct FROM symbols GROUP BY source""")
add("a15_source_members", "SELECT source, id, symbol, count(*) OVER (PARTITION BY source) AS members FROM symbols")
add("a16_sparse_rows_merged", """SELECT * REPLACE (CAST(NULL AS DATE) AS max_volume_date, CAST(NULL AS BIGINT) AS max_volume_value)
  FROM daily""")
add("a17_catalogue_kpis", """SELECT count(*) AS total, count(*) FILTER (status = 1) AS active,
  count(*) FILTER (status = 0) AS paused, count(DISTINCT source) AS sources FROM symbols""")
add("a18_newest_days", "SELECT DISTINCT trading_date FROM ticks ORDER BY trading_date DESC LIMIT 30")
add("a18_distinct_years", "SELECT DISTINCT CAST(year(trading_date) AS INT) AS year FROM bars")
add("a19_distinct_months", """SELECT DISTINCT strftime(trading_date, '%Y-%m') AS sort_key,
  strftime(trading_date, '%m/%Y') AS period FROM bars""")
add("a20_close_extremes", """SELECT symbol, CAST(max(close) AS DOUBLE) AS max_close, CAST(min(close) AS DOUBLE) AS min_close,
  max(volume) AS max_volume FROM bars WHERE year(trading_date) = 1996 GROUP BY symbol""")
add("a21_row_counts", """SELECT trading_date, count(*) AS n FROM bars WHERE dayofweek(trading_date) NOT IN (0, 6)
  GROUP BY trading_date""")

# Windows
add("w01_latest_snapshot", f"""SELECT {H} FROM (SELECT * FROM bars_raw
    QUALIFY row_number() OVER (PARTITION BY symbol, trading_date ORDER BY {BEST}) = 1)""")
add("w02_deduplicated", f"""SELECT {H.replace('CAST(close AS DOUBLE)', 'CAST(close + 1 AS DOUBLE)')} FROM (SELECT * FROM bars_raw
    QUALIFY row_number() OVER (PARTITION BY symbol, trading_date, scrape_time ORDER BY {BEST}) = 1)""")
add("w03_running_close_range", f"SELECT {RANGE} FROM ranges")
add("w04_close_streaks", "SELECT * FROM streaks")
add("w05_candle_streaks", "SELECT * FROM candle_streaks")
add("w06_partial_sma", "SELECT * FROM smas")
add("w07_strict_smas", "SELECT symbol, trading_date, CAST(close AS DOUBLE) AS close, " + ", ".join(
    f"round({_strict(n, 'eod.close')}, 6) AS sma{n}" for n in (20, 50, 200)) + " FROM eod")
VWAP = """round(CAST(sum(close * volume) OVER w AS DOUBLE) / CAST(sum(volume) OVER w AS DOUBLE), 6) AS vwap"""
add("w08_intraday_vwap", f"""SELECT {H}, vwap FROM (SELECT *, {VWAP} FROM ticks
  WINDOW w AS (PARTITION BY symbol, trading_date ORDER BY scrape_time ROWS UNBOUNDED PRECEDING))""")
add("w08_period_vwap", f"""SELECT symbol, trading_date, CAST(close AS DOUBLE) AS close, volume, CAST(open AS DOUBLE) AS open,
  CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, vwap FROM (SELECT *, {VWAP} FROM eod
  WINDOW w AS (PARTITION BY symbol ORDER BY trading_date ROWS UNBOUNDED PRECEDING))""")
add("w08_snapshot_increments", """SELECT symbol, scrape_time, volume, volume - coalesce(lag(volume) OVER (
  PARTITION BY symbol, trading_date ORDER BY scrape_time), 0) AS added_volume FROM ticks""")
add("w09_changes", """SELECT symbol, trading_date, CAST(close AS DOUBLE) AS close, CAST(prev_close AS DOUBLE) AS prev_close,
  CAST(change AS DOUBLE) AS change, round(pct, 6) AS pct_change,
  CASE WHEN coalesce(changes.change, 0) >= 0 THEN 'green' ELSE 'red' END AS color FROM changes""")
add("w10_annual_volatility", """SELECT symbol, round(stddev_samp(pct) * sqrt(252) * 100, 6) AS volatility
  FROM changes GROUP BY symbol""")
GAPS = (f"averaged AS (SELECT symbol, trading_date, close, {_strict(10, 'close')} AS ma_short, "
        f"{_strict(20, 'close')} AS ma_long FROM {{}}), "
        "gaps AS (SELECT *, ma_short - ma_long AS gap, lag(ma_short - ma_long) OVER "
        "(PARTITION BY symbol ORDER BY trading_date) AS prev_gap FROM averaged), "
        "crossed AS (SELECT *, CASE WHEN gap > 0 AND prev_gap <= 0 THEN 'golden' "
        "WHEN gap < 0 AND prev_gap >= 0 THEN 'death' END AS cross_kind FROM gaps)")
add("w11_moving_average_crosses", """SELECT symbol, trading_date, cross_kind AS "cross", round(gap, 6) AS gap
  FROM crossed WHERE cross_kind IS NOT NULL""", GAPS.format("eod"))
add("w12_current_signal", """SELECT symbol, trading_date, CAST(close AS DOUBLE) AS close, round(ma_short, 6) AS ma_short,
    round(ma_long, 6) AS ma_long, round(gap, 6) AS gap, round(abs(gaps.gap), 6) AS gap_size,
    CASE WHEN gaps.gap > 0 THEN 'BULLISH' ELSE 'BEARISH' END AS signal
  FROM gaps WHERE gaps.gap IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trading_date DESC) = 1""",
    GAPS.format("eod"))
add("w13_period_return", """SELECT symbol, round((CAST(arg_max(close, trading_date) AS DOUBLE)
  / CAST(arg_min(close, trading_date) AS DOUBLE) - 1) * 100, 6) AS return_pct FROM eod GROUP BY symbol""")
add("w14_base_hundred", """SELECT symbol, trading_date, round(CAST(close AS DOUBLE)
  / CAST(first(close) OVER (PARTITION BY symbol ORDER BY trading_date) AS DOUBLE) * 100, 6) AS normalised FROM eod""")
add("w15_largest_move_day", """SELECT symbol, trading_date AS max_move_date, round(abs(pct), 6) AS max_move FROM changes
  WHERE pct IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY abs(pct) DESC, trading_date) = 1""")
add("w16_last_quote", f"""SELECT {H} FROM (SELECT * FROM ticks
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY {BEST}) = 1)""")
add("w17_intraday_volatility", """SELECT symbol, calc_date, CAST(max_intraday_volatility AS DOUBLE) AS max_intraday_volatility
  FROM volatility""")

# Sorting, limits, pages
add("t01_sorted_output", """SELECT symbol, calc_year, calc_month, monthly_total_volume FROM months
  ORDER BY symbol, calc_year, calc_month""")
NEWEST = "trading_date DESC, symbol, scrape_time DESC, close DESC, volume DESC, source"
add("t02_newest_rows", f"SELECT {H} FROM (SELECT * FROM bars ORDER BY {NEWEST} LIMIT 2500)")
add("t03_last_sessions", f"""SELECT {BAR} FROM (SELECT * FROM eod
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trading_date DESC) <= 20)""")
add("t04_top_average_close", """SELECT symbol, round(CAST(sum(close) AS DOUBLE) / count(close), 6) AS avg_close FROM eod
  GROUP BY symbol ORDER BY CAST(sum(close) AS DOUBLE) / count(close) DESC, symbol LIMIT 10""")


def _page(source: str, number: int, order: str) -> str:
    return f"""numbered AS (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS position,
      CAST(greatest(1, ceil(count(*) OVER () / 25.0)) AS BIGINT) AS page_count FROM {source}),
    paged AS (SELECT *, CAST(greatest(1, least({number}, page_count)) AS BIGINT) AS page FROM numbered),
    on_page AS (SELECT * FROM paged WHERE position >= (page - 1) * 25 AND position < page * 25)"""


add("t05_page", f"SELECT {H}, position, page, page_count FROM on_page", _page("bars", 40, NEWEST))
add("t05_last_page", f"SELECT {H}, position, page, page_count FROM on_page", _page("bars", 10**9, NEWEST))
for _name in ("page", "last_page"):
    ORACLE[f"s01_indexed_{_name}"] = ORACLE[f"t05_{_name}"]
add("t06_first_listed", "SELECT * FROM symbols ORDER BY id LIMIT 6")
add("t07_limit", f"SELECT {H} FROM (SELECT * FROM bars ORDER BY symbol, scrape_time, close LIMIT 5)")

# Set operations
add("u01_market_union", f"""SELECT {RANGE}, CAST(NULL AS BIGINT) AS total_volume FROM ranges
  UNION ALL SELECT symbol, calc_date, NULL, NULL, total_volume FROM market""")
add("u02_symbols_together", "SELECT symbol, trading_date, " + ", ".join(
    f"round({_strict(n, 'close')}, 6) AS sma{n}" for n in (20, 50)) + " FROM eod")

# Scalar functions
add("x01_upper_trim", "SELECT upper(trim(symbol)) AS symbol, CAST(length(raw_text.symbol) AS INT) AS raw_length FROM raw_text")
add("x02_casts", """SELECT CAST(TRY_CAST(close_price AS DECIMAL(18,4)) AS DOUBLE) AS price, volume AS whole,
  CAST(volume AS VARCHAR) AS volume_text FROM raw_text""")
add("x03_from_millis", "SELECT epoch_ms(TRY_CAST(scrape_time AS BIGINT)) AS moment FROM raw_text")
add("x04_day_formats", "SELECT trading_date AS day FROM typed")
add("x05_weekday_number", """SELECT symbol, trading_date, CAST(dayofweek(trading_date) + 1 AS INT) AS dow,
  CAST(isodow(trading_date) - 1 AS INT) AS wd FROM bars""")
add("x06_year_month", """SELECT symbol, scrape_time, CAST(year(trading_date) AS INT) AS y, CAST(month(trading_date) AS INT) AS m
  FROM bars""")
add("x07_joined_text", """SELECT scrape_time, concat_ws('-', year(trading_date), month(trading_date), day(trading_date)) AS ymd
  FROM bars""")
add("x08_round_half_up", "SELECT symbol, scrape_time, CAST(round(open, 2) AS DOUBLE) AS open2 FROM bars")
add("x09_clamped", "SELECT symbol, scrape_time, CAST(greatest(open - close, 0) AS DOUBLE) AS fall FROM bars_raw")
add("x10_liquidity", "SELECT * FROM liquidity")
add("x11_coalesce", """SELECT raw_symbol AS symbol, raw_time AS scrape_time, CAST(coalesce(close, open) AS DOUBLE) AS price,
  CAST(coalesce(close, 0) AS DOUBLE) AS price_or_zero FROM typed""")
add("x12_date_text", """SELECT scrape_time, strftime(trading_date, '%m/%Y') AS period, strftime(trading_date, '%Y-%m') AS sort_key,
  strftime(trading_date, '%d/%m/%Y') AS day FROM bars""")
add("x13_month_end", "SELECT scrape_time, last_day(trading_date) AS month_end FROM bars")
add("x14_month_label", "SELECT scrape_time, 'Th.' || month(trading_date) AS label FROM bars")
add("x15_epoch_repair", """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000 ELSE epoch_us(ts) // 1000 * 1000000 END AS raw_date,
  CAST(ts AS DATE) AS day FROM events""")
add("x16_day_without_zone", "SELECT symbol, scrape_time, CAST(scrape_time AS DATE) AS day FROM ticks")


def _amount(v: str) -> str:
    return (f"CASE WHEN {v} >= 1000000 THEN format('{{:.1f}}M', {v} / 1000000.0) "
            f"WHEN {v} >= 1000 THEN format('{{:.0f}}K', {v} / 1000.0) ELSE CAST({v} AS VARCHAR) END")


add("x17_display_text", f"""SELECT symbol, scrape_time, {_amount('volume')} AS volume_text,
  {_amount('(volume // 1000)')} AS small_volume_text,
  format('{{:,}}', CAST(close * 1000 AS BIGINT)) || '₫' AS price_text,
  CASE WHEN round(open - close, 2) >= 0 THEN '+' ELSE '' END || format('{{:.2f}}%', CAST(round(open - close, 2) AS DOUBLE))
    AS percent_text FROM ticks""")
add("x18_text_match", f"""SELECT {H} FROM ticks WHERE (regexp_matches(source, '^C', 'i') OR contains(source, 'err'))
  AND starts_with(CAST(ticks.trading_date AS VARCHAR), '2024-01')""")
add("x19_arithmetic", """SELECT symbol, scrape_time, CAST(abs(open - close) AS DOUBLE) AS gap,
  round(sqrt(CAST(volume AS DOUBLE)), 6) AS root,
  round(CAST(high - close AS DOUBLE) / nullif(CAST(open - close AS DOUBLE), 0), 6) AS share FROM bars""")
add("x20_json_round_trip", "SELECT * FROM volumes")
add("x21_time_parts", """SELECT symbol, scrape_time, CAST(hour(scrape_time) AS INT) AS h, CAST(minute(scrape_time) AS INT) AS mi,
  strftime(scrape_time, '%Y%m%d_%H%M') AS label,
  CASE WHEN hour(scrape_time) = 9 AND minute(scrape_time) < 5 THEN 1 ELSE 0 END AS in_reset FROM ticks""")
add("x22_sign_labels", """SELECT symbol, trading_date, CASE WHEN coalesce(change, 0) >= 0 THEN '▲' ELSE '▼' END AS arrow,
  CASE WHEN coalesce(change, 0) > 0 THEN 'BULLISH' ELSE 'BEARISH' END AS signal FROM changes""")

# Streams
DAILY_ROWS = "(SELECT * FROM daily WHERE symbol <> 'MARKET')"
add("s14_topic_messages", f"""SELECT "offset", symbol, count(*) AS n, CAST(sum(total_volume) AS BIGINT) AS volume FROM (
    SELECT CAST(1 AS BIGINT) AS "offset", symbol, total_volume // 2 AS total_volume FROM {DAILY_ROWS}
    UNION ALL SELECT CAST(2 AS BIGINT), symbol, total_volume FROM {DAILY_ROWS}) GROUP BY ALL""")
add("k08_daily_upsert", f"SELECT * REPLACE (CAST(NULL AS DOUBLE) AS sma_price) FROM {DAILY_ROWS}")
UPSERTED_MONTHS = """SELECT symbol, calc_year, calc_month, CASE WHEN calc_month = 5 THEN 0 ELSE monthly_avg_close END
  AS monthly_avg_close, CASE WHEN calc_month = 3 THEN 0 ELSE monthly_total_volume END AS monthly_total_volume FROM months"""
add("k09_monthly_upsert", UPSERTED_MONTHS)
add("k10_quarantine", """SELECT 'stock_daily_topic' AS topic, '{not json ' || symbol AS text FROM symbols
  UNION ALL SELECT 'stock_daily_topic', '{"symbol":"' || symbol || '"}' FROM symbols""")
add("m01_daily_stream_coalesced", f"SELECT * FROM {DAILY_ROWS}")
# A missing average keeps the one of the first run; a message without a year is skipped as before.
add("m02_monthly_stream_coalesced", """SELECT symbol, calc_year, calc_month, monthly_avg_close,
  CASE WHEN calc_month = 3 THEN 0 ELSE monthly_total_volume END AS monthly_total_volume FROM months""")
add("m03_routed_counts", f"""SELECT 'daily' AS routed_to, count(*) AS n FROM {DAILY_ROWS}
  UNION ALL SELECT 'monthly', count(*) FROM months""")
add("m04_same_day_refresh", """SELECT symbol, calc_date, CASE WHEN year(calc_date) >= 1998 THEN total_volume
  ELSE total_volume // 2 END AS total_volume FROM volumes""")
add("m05_snapshot_intake", f"SELECT {H} FROM ticks")

# Composite views
add("m05_streamed_vwap", """SELECT symbol, trading_date, minute, volume, n,
  round(CAST(sum(value) OVER upto AS DOUBLE) / CAST(sum(volume) OVER upto AS DOUBLE), 6) AS vwap FROM (
  SELECT symbol, trading_date, CAST(floor(epoch(scrape_time) / 60) AS BIGINT) AS minute, sum(close * volume) AS value,
    CAST(sum(volume) AS BIGINT) AS volume, count(*) AS n FROM ticks GROUP BY ALL)
  WINDOW upto AS (PARTITION BY symbol, trading_date ORDER BY minute)""")
add("v01_daily_analysis", "SELECT * FROM daily")
add("m04_daily_refreshed", "SELECT * FROM daily")
add("v02_monthly_analysis", "SELECT * FROM months")
add("v03_increment_daily_analysis", """SELECT * FROM increment_daily UNION ALL
  SELECT symbol, calc_date, total_volume, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM market""")
add("v03_increment_daily_merged", "SELECT * FROM increment_daily UNION ALL SELECT * FROM filler")
add("v04_market_filler", "SELECT * FROM filler")
add("v05_candlesticks", f"SELECT {BAR}, CASE WHEN ohlc.close >= ohlc.open THEN 'up' ELSE 'down' END AS direction FROM ohlc")
add("v06_intraday", f"""SELECT {H}, vwap FROM (SELECT *, {VWAP} FROM ticks
  WINDOW w AS (PARTITION BY symbol, trading_date ORDER BY scrape_time ROWS UNBOUNDED PRECEDING))""")
add("v07_moving_averages", """SELECT symbol, trading_date, CAST(close AS DOUBLE) AS close, round(ma_short, 6) AS ma_short,
  round(ma_long, 6) AS ma_long, cross_kind AS "cross" FROM crossed""", GAPS.format("ohlc"))
add("v08_volume_direction", f"""SELECT {BAR}, CAST(prev_close AS DOUBLE) AS prev_close,
  CASE WHEN prev_close IS NULL OR moved.close >= prev_close THEN 'green' ELSE 'red' END AS color
  FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY trading_date) AS prev_close FROM ohlc) moved""")
add("v09_market_overview", """SELECT c.symbol, CAST(arg_max(close, trading_date) AS DOUBLE) AS price,
    CAST(arg_max(change, trading_date) AS DOUBLE) AS price_change, round(arg_max(pct, trading_date) * 100, 6) AS pct_change,
    round((CAST(arg_max(close, trading_date) AS DOUBLE) / CAST(arg_min(close, trading_date) AS DOUBLE) - 1) * 100, 6) AS return_pct,
    CAST(max(close) AS DOUBLE) AS max_close, CAST(min(close) AS DOUBLE) AS min_close, arg_max(volume, trading_date) AS volume,
    any_value(bank_name) AS bank_name, coalesce(any_value(source), 'CafeF') AS listed_source
  FROM changes c LEFT JOIN symbols k ON c.symbol = k.symbol GROUP BY c.symbol""")
add("v10_history_view", f"SELECT {NO_TIME}, position, page, page_count FROM on_page", "found AS (SELECT * FROM ticks WHERE "
    "contains(lower(source), 'click') AND trading_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'), "
    + _page("found", 2, NEWEST))
add("v10_daily_view", "SELECT * FROM on_page", "found AS (SELECT * FROM daily WHERE calc_date BETWEEN DATE '1996-01-01' "
    "AND DATE '1999-12-31'), " + _page("found", 3, "calc_date DESC, symbol"))
add("v10_monthly_view", "SELECT * FROM on_page", "found AS (SELECT * FROM months WHERE calc_year = 1997), "
    + _page("found", 2, "calc_year DESC, calc_month DESC, symbol"))

"""SQL text for the DuckDB oracle: the same fixtures and flows, written in SQL.

The driver registers the parquet tables as views; each oracle query is one
statement built from the fixture CTEs below. Rounding uses numpy's rule
(scale, round half to even) on both sides.
"""

from __future__ import annotations


def r(expr: str, places: int = 2) -> str:
    """numpy-style rounding in DuckDB."""
    scale = 10 ** places
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def with_ctes(ctes: dict[str, str], body: str) -> str:
    parts = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


BARS = """
SELECT symbol, "timestamp",
       arg_min(unit, (l_orderkey, l_partkey, l_linenumber, unit)) AS open,
       max(unit) AS high, min(unit) AS low,
       arg_max(unit, (l_orderkey, l_partkey, l_linenumber, unit)) AS close,
       CAST(sum(l_quantity) AS BIGINT) AS volume
FROM (SELECT l_suppkey AS symbol, l_shipdate AS "timestamp", l_orderkey, l_partkey, l_linenumber,
             l_quantity, CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS unit
      FROM lineitem) li
GROUP BY symbol, "timestamp"
"""

IND1 = """
SELECT *, CAST("timestamp" AS DATE) AS date,
       (close / lag(close) OVER w - 1) * 100 AS daily_return,
       avg(close) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma_7,
       avg(close) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma_20,
       close - lag(close) OVER w AS d
FROM bars
WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")
"""

IND2 = """
SELECT *,
       stddev_samp(daily_return) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS vol7,
       avg(CASE WHEN d > 0 THEN d ELSE 0 END) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS gain,
       avg(CASE WHEN d < 0 THEN -d ELSE 0 END) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS loss
FROM ind1
WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")
"""

IND3 = """
SELECT "timestamp", date, symbol, open, high, low, close, volume,
       coalesce(daily_return, 0) AS daily_return, coalesce(ma_7, 0) AS ma_7, coalesce(ma_20, 0) AS ma_20,
       coalesce(vol7, 0) AS volatility_7d,
       coalesce(100 - 100 / (1 + gain / CASE WHEN loss = 0 THEN 0.0001 ELSE loss END), 0) AS rsi,
       coalesce((close - ma_7) / ma_7 * 100, 0) AS momentum
FROM ind2
"""

CTX = """
SELECT i.*,
       CASE WHEN volume > av.avg_volume * 1.5 THEN 'high' WHEN volume < av.avg_volume * 0.5 THEN 'low'
            ELSE 'normal' END AS volume_category,
       CASE WHEN close > ma_20 AND ma_7 > ma_20 THEN 'bullish'
            WHEN close < ma_20 AND ma_7 < ma_20 THEN 'bearish' ELSE 'neutral' END AS trend,
       CASE WHEN rsi > 70 THEN 'overbought' WHEN rsi < 30 THEN 'oversold' ELSE 'neutral' END AS rsi_signal,
       CASE WHEN volatility_7d > q.q75 THEN 'high' WHEN volatility_7d < q.q75 * 0.5 THEN 'low'
            ELSE 'medium' END AS volatility_level,
       close - open AS price_change,
       (close - open) / open * 100 AS price_change_pct
FROM ind3 i
JOIN (SELECT symbol, avg(volume) AS avg_volume FROM ind3 GROUP BY symbol) av USING (symbol)
CROSS JOIN (SELECT quantile_cont(volatility_7d, 0.75) AS q75 FROM ind3) q
"""


IND_COLS = ["timestamp", "date", "symbol", "open", "high", "low", "close", "volume", "daily_return",
            "ma_7", "ma_20", "volatility_7d", "rsi", "momentum", "volume_category", "trend", "rsi_signal",
            "volatility_level", "price_change", "price_change_pct", "day_type"]


def flow_indicators(cols=None) -> str:
    allc = ", ".join(
        [f'"timestamp"', "date", "symbol"]
        + [f"{r(c)} AS {c}" for c in ["open", "high", "low", "close"]]
        + ["volume"]
        + [f"{r(c)} AS {c}" for c in ["daily_return", "ma_7", "ma_20", "volatility_7d", "rsi", "momentum"]]
        + ["volume_category", "trend", "rsi_signal", "volatility_level"]
        + [f"{r(c)} AS {c}" for c in ["price_change", "price_change_pct"]]
        + ["CASE WHEN isnan(price_change_pct) THEN 'loss' WHEN price_change_pct > 2 THEN 'strong_gain' "
           "WHEN price_change_pct > 0 THEN 'gain' WHEN price_change_pct < -2 THEN 'strong_loss' ELSE 'loss' END "
           "AS day_type"])
    pick = ", ".join(f'"{c}"' for c in (cols or IND_COLS))
    return with_ctes({"bars": BARS, "ind1": IND1, "ind2": IND2, "ind3": IND3, "ctx": CTX,
                      "flow": f"SELECT {allc} FROM ctx"}, f"SELECT {pick} FROM flow")


# ---------------------------------------------------------------- market grains

UNIT = "CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END"

TRADED = f"CASE WHEN l_partkey % 50 = 7 THEN l_partkey % 100 + 900.0::DOUBLE ELSE {UNIT} END"

MARKET = {
    "spot": f"""
SELECT p_partkey AS crypto_id, p_brand AS symbol,
       CASE WHEN p_partkey % 50 = 7 THEN p_partkey % 100 + 900.0::DOUBLE WHEN p_partkey % 4 = 1 THEN p_retailprice * 40
            ELSE p_retailprice END AS spot_price_usd, coalesce(v.volume_24h, 0) AS volume_24h
FROM part LEFT JOIN (SELECT l_partkey AS crypto_id, CASE WHEN l_partkey % 3 = 0 THEN avg(l_quantity) ELSE sum(l_quantity) END AS volume_24h FROM lineitem GROUP BY 1) v
  ON p_partkey = v.crypto_id""",
    "hourly": f"""
SELECT l_partkey AS crypto_id, l_shipdate AS "timestamp", {TRADED} AS price_usd, l_quantity AS volume
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01 00:00:00'""",
    "daily": f"""
SELECT l_partkey AS crypto_id, CAST(l_shipdate AS DATE) AS date, {TRADED} AS price_usd, l_quantity AS volume
FROM lineitem""",
    "meta": """
SELECT p_partkey AS crypto_id, p_brand AS symbol, p_name AS name, CAST(p_size AS BIGINT) AS market_cap_rank
FROM part""",
    "cv0": """
SELECT s.crypto_id, s.symbol, s.spot_price_usd AS spot_price, s.spot_price_usd, s.volume_24h,
       CASE WHEN h.n IS NULL THEN s.spot_price_usd ELSE h.avg_p END AS avg_24h_price,
       CASE WHEN h.n IS NULL THEN 0.0::DOUBLE ELSE h.std_p END AS std_24h_price,
       CASE WHEN h.n IS NULL THEN 0.0::DOUBLE ELSE h.avg_v END AS avg_24h_volume,
       h.hi AS price_24h_high, h.lo AS price_24h_low,
       CASE WHEN d.n IS NULL THEN s.spot_price_usd ELSE d.avg_p END AS avg_7d_price,
       CASE WHEN d.n IS NULL THEN 0.0::DOUBLE ELSE d.avg_v END AS avg_7d_volume,
       d.hi AS price_7d_high, d.lo AS price_7d_low
FROM spot s
LEFT JOIN (SELECT crypto_id, count(*) AS n, avg(price_usd) AS avg_p, stddev_samp(price_usd) AS std_p,
                  avg(volume) AS avg_v, max(price_usd) AS hi, min(price_usd) AS lo
           FROM hourly GROUP BY crypto_id) h USING (crypto_id)
LEFT JOIN (SELECT crypto_id, count(*) AS n, avg(price_usd) AS avg_p, avg(volume) AS avg_v,
                  max(price_usd) AS hi, min(price_usd) AS lo
           FROM daily GROUP BY crypto_id) d USING (crypto_id)""",
    "cv1": """
SELECT *,
  CASE WHEN avg_24h_price > 0 THEN (spot_price - avg_24h_price) / avg_24h_price * 100 ELSE 0.0::DOUBLE END
    AS price_deviation_24h_pct,
  CASE WHEN avg_7d_price > 0 THEN (spot_price - avg_7d_price) / avg_7d_price * 100 ELSE 0.0::DOUBLE END
    AS price_deviation_7d_pct,
  CASE WHEN avg_7d_volume > 0 THEN (volume_24h - avg_7d_volume) / avg_7d_volume * 100 ELSE 0.0::DOUBLE END
    AS volume_deviation_pct,
  CASE WHEN avg_24h_price > 0 THEN std_24h_price / avg_24h_price * 100 ELSE 0.0::DOUBLE END AS volatility_score
FROM cv0""",
    "cv": """
SELECT *, trend_24h = trend_7d AS trend_consistent FROM (
  SELECT *, CASE WHEN price_deviation_24h_pct > 0 THEN 'up' ELSE 'down' END AS trend_24h,
            CASE WHEN price_deviation_7d_pct > 0 THEN 'up' ELSE 'down' END AS trend_7d
  FROM cv1) t""",
    "conf": """
SELECT *,
  CASE WHEN confidence_score >= 80 THEN 'high' WHEN confidence_score >= 60 THEN 'medium'
       WHEN confidence_score >= 40 THEN 'low' ELSE 'very_low' END AS data_quality,
  CASE WHEN confidence_score >= 90 THEN 'A' WHEN confidence_score >= 75 THEN 'B'
       WHEN confidence_score >= 60 THEN 'C' WHEN confidence_score >= 50 THEN 'D' ELSE 'F' END AS reliability_rating
FROM (SELECT *, greatest(0.0::DOUBLE, least(100.0::DOUBLE, 100.0::DOUBLE
    - CASE WHEN abs(price_deviation_24h_pct) > 10 THEN 20 WHEN abs(price_deviation_24h_pct) > 5 THEN 10 ELSE 0 END
    - CASE WHEN abs(price_deviation_7d_pct) > 15 THEN 15 WHEN abs(price_deviation_7d_pct) > 10 THEN 10 ELSE 0 END
    - CASE WHEN volatility_score > 5 THEN 15 WHEN volatility_score > 3 THEN 10 ELSE 0 END
    - CASE WHEN trend_consistent THEN 0 ELSE 15 END
    - CASE WHEN abs(volume_deviation_pct) > 50 THEN 10 ELSE 0 END)) AS confidence_score
  FROM cv) t""",
    "anom0": """
SELECT *,
  CASE WHEN price_deviation_24h_pct < -10 THEN 'high' WHEN price_deviation_24h_pct < -5 THEN 'medium'
       ELSE 'low' END AS flash_crash_risk,
  CASE WHEN price_deviation_24h_pct > 15 THEN 'high' WHEN price_deviation_24h_pct > 10 THEN 'medium'
       ELSE 'low' END AS pump_risk,
  coalesce(abs(volume_deviation_pct) > 100, false) AS volume_manipulation_flag,
  CAST(least(100,
      CASE WHEN abs(price_deviation_24h_pct) > 10 THEN 30 ELSE 0 END
    + CASE WHEN abs(volume_deviation_pct) > 50 THEN 25 ELSE 0 END
    + CASE WHEN volatility_score > 5 THEN 20 ELSE 0 END
    + CASE WHEN trend_consistent THEN 0 ELSE 15 END
    + CASE WHEN confidence_score < 50 THEN 10 ELSE 0 END) AS DOUBLE) AS manipulation_score
FROM conf""",
    "anom": """
SELECT *,
  CASE WHEN manipulation_score >= 75 THEN 'critical' WHEN manipulation_score >= 50 THEN 'high'
       WHEN manipulation_score >= 25 THEN 'medium' ELSE 'low' END AS risk_level,
  coalesce(manipulation_score >= 50, false) AS requires_investigation,
  CASE WHEN trend_consistent AND trend_24h = 'up' THEN 'bullish'
       WHEN trend_consistent AND trend_24h = 'down' THEN 'bearish' ELSE 'neutral' END AS market_sentiment
FROM anom0""",
}


def range_pos(x: str, lo: str, hi: str) -> str:
    return (f"coalesce(CASE WHEN {hi} = {lo} THEN (CASE WHEN {x} > {lo} THEN 'Infinity'::DOUBLE "
            f"WHEN {x} < {lo} THEN '-Infinity'::DOUBLE END) ELSE ({x} - {lo}) / ({hi} - {lo}) * 100 END, 50.0::DOUBLE)")


MARKET_ROUNDED = ["spot_price", "avg_24h_price", "avg_7d_price", "price_deviation_24h_pct",
                  "price_deviation_7d_pct", "volume_deviation_pct", "volatility_score", "confidence_score",
                  "manipulation_score", "price_24h_high", "price_24h_low", "price_7d_high", "price_7d_low",
                  "position_in_24h_range_pct", "position_in_7d_range_pct"]

MARKET_FINAL_COLS = [
    "crypto_id", "symbol", "spot_price", "spot_price_usd", "volume_24h", "avg_24h_price", "avg_24h_volume",
    "price_24h_high", "price_24h_low", "avg_7d_price", "avg_7d_volume", "price_7d_high", "price_7d_low",
    "price_deviation_24h_pct", "price_deviation_7d_pct", "volume_deviation_pct", "volatility_score",
    "trend_24h", "trend_7d", "trend_consistent", "confidence_score", "data_quality", "reliability_rating",
    "flash_crash_risk", "pump_risk", "volume_manipulation_flag", "manipulation_score", "risk_level",
    "requires_investigation", "market_sentiment", "name", "market_cap_rank",
    "position_in_24h_range_pct", "position_in_7d_range_pct"]


def market_final_select(cols=None) -> str:
    cols = cols or MARKET_FINAL_COLS
    return ", ".join(f"{r(c)} AS {c}" if c in MARKET_ROUNDED else c for c in cols)


def flow_cross_validation(cols=None) -> str:
    final = (f"SELECT a.*, m.name, m.market_cap_rank, "
             f"{range_pos('spot_price', 'price_24h_low', 'price_24h_high')} AS position_in_24h_range_pct, "
             f"{range_pos('spot_price', 'price_7d_low', 'price_7d_high')} AS position_in_7d_range_pct "
             f"FROM anom a LEFT JOIN meta m USING (crypto_id, symbol)")
    return with_ctes({**MARKET, "final": final}, f"SELECT {market_final_select(cols)} FROM final")


def tail_per_key(n: int = 66) -> str:
    return with_ctes({"bars": BARS}, f"""SELECT symbol, "timestamp", close FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) <= {n}""")


def head_per_key(n: int = 24) -> str:
    return with_ctes({"hourly": MARKET["hourly"]}, f"""SELECT crypto_id, "timestamp", price_usd, volume FROM hourly
QUALIFY row_number() OVER (PARTITION BY crypto_id ORDER BY "timestamp", price_usd, volume) <= {n}""")


# ---------------------------------------------------------------- network packets

PACKETS = """
SELECT l_orderkey AS flow_id, l_quantity * 40 AS packet_size,
       CAST(([23, 80, 443, 135, 8080, 139, 22, 445, 1433, 3389, 5900, 53])[(l_partkey % 12) + 1] AS INTEGER) AS src_port,
       CAST(l_suppkey + 1000 AS INTEGER) AS dst_port,
       l_extendedprice AS packet_count_5s, l_tax + l_discount AS spectral_entropy,
       l_extendedprice * l_discount AS frequency_band_energy,
       CAST(l_returnflag = 'R' AS INTEGER) AS label,
       CAST(l_linestatus = 'O' AS INTEGER) AS protocol_type_tcp,
       CAST(l_returnflag = 'A' AS INTEGER) AS protocol_type_udp,
       CAST(l_returnflag = 'N' AS INTEGER) AS protocol_type_icmp,
       CAST(l_linenumber % 2 = 1 AS INTEGER) AS tcp_flags_SYN,
       CAST(l_linenumber % 3 = 0 AS INTEGER) AS "tcp_flags_SYN-ACK",
       CASE WHEN l_linenumber = 7 THEN ip || '.x' ELSE ip END AS src_ip,
       (['TCP', '6', 'UDP', '17', 'ICMP', '1', 'HTTP', 'GRE'])[(l_linenumber + l_partkey) % 8 + 1] AS protocol
FROM (SELECT *, concat_ws('.', l_orderkey % 256, l_partkey % 256, l_suppkey % 256, l_linenumber) AS ip
      FROM lineitem) li
"""

THREAT = {
    "packets": PACKETS,
    "q": """
SELECT quantile_cont(packet_count_5s, 0.85) AS q85c, quantile_cont(spectral_entropy, 0.25) AS q25e,
       quantile_cont(spectral_entropy, 0.15) AS q15e, quantile_cont(frequency_band_energy, 0.85) AS q85f
FROM packets""",
    "t1": """
SELECT p.*,
  CASE WHEN protocol_type_icmp = 1 THEN 'icmp' WHEN protocol_type_udp = 1 THEN 'udp'
       WHEN protocol_type_tcp = 1 THEN 'tcp' ELSE 'unknown' END AS primary_protocol,
  CASE WHEN packet_size > 0 AND packet_size <= 100 THEN 'tiny' WHEN packet_size > 100 AND packet_size <= 500 THEN 'small'
       WHEN packet_size > 500 AND packet_size <= 1500 THEN 'medium' WHEN packet_size > 1500 THEN 'large' END
    AS packet_category,
  coalesce(src_port IN (23, 135, 139, 445, 1433, 3389, 5900) OR dst_port IN (23, 135, 139, 445, 1433, 3389, 5900),
           false) AS uses_suspicious_port,
  coalesce(packet_count_5s > q.q85c, false) AS high_volume_traffic,
  coalesce(tcp_flags_SYN = 1 AND "tcp_flags_SYN-ACK" = 0, false) AS potential_syn_flood,
  coalesce(spectral_entropy < q.q25e, false) AS low_entropy_traffic,
  CASE WHEN label = 1 THEN 'malicious' ELSE 'benign' END AS labeled_threat,
  coalesce(spectral_entropy < q.q15e, false) AND coalesce(frequency_band_energy > q.q85f, false) AS spectral_attack
FROM packets p CROSS JOIN q""",
    "t2": """
SELECT *, CAST(0 + CASE WHEN labeled_threat = 'malicious' THEN 50 ELSE 0 END
  + CASE WHEN uses_suspicious_port THEN 20 ELSE 0 END + CASE WHEN high_volume_traffic THEN 15 ELSE 0 END
  + CASE WHEN low_entropy_traffic THEN 10 ELSE 0 END + CASE WHEN potential_syn_flood THEN 15 ELSE 0 END
  + CASE WHEN spectral_attack THEN 10 ELSE 0 END + CASE WHEN packet_size < 50 THEN 8 ELSE 0 END
  + CASE WHEN packet_size > 1400 THEN 6 ELSE 0 END AS DOUBLE) AS risk_score
FROM t1""",
    "t3": """
SELECT *,
  CASE WHEN risk_score > -1 AND risk_score <= 10 THEN 'low' WHEN risk_score > 10 AND risk_score <= 30 THEN 'medium'
       WHEN risk_score > 30 AND risk_score <= 60 THEN 'high' WHEN risk_score > 60 THEN 'critical' END AS threat_level,
  CASE WHEN max(risk_score) OVER () > 0
       THEN round_even(risk_score / max(risk_score) OVER () * 100 * 100, 0) / 100 ELSE 0.0::DOUBLE END
    AS anomaly_confidence
FROM t2""",
    "threat": """
SELECT * EXCLUDE (spectral_attack), coalesce(threat_level IN ('high', 'critical'), false) AS requires_investigation
FROM t3""",
}


def threat(cols: list[str] | None = None) -> str:
    pick = ", ".join(f'"{c}"' for c in cols) if cols else "*"
    return with_ctes(THREAT, f"SELECT {pick} FROM threat")


# ---------------------------------------------------------------- launches

LAUNCH = {
    "launches": """
SELECT o_orderkey AS flight_number, 'mission-' || CAST(o_orderkey AS VARCHAR) AS name,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS date_utc,
       CAST(epoch(o_orderdate) AS BIGINT) AS date_unix,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS success,
       CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END AS details,
       o_custkey AS rocket_id, CAST(o_orderkey % 30 AS INTEGER) AS launchpad_id,
       coalesce(l.crew, 0) AS crew, coalesce(l.payloads, 0) AS payloads, coalesce(l.cores_used, 0) AS cores_used
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS payloads, CAST(count_if(l_returnflag = 'R') AS BIGINT) AS crew,
                              count(DISTINCT l_suppkey) AS cores_used FROM lineitem GROUP BY l_orderkey) l
  ON o_orderkey = l.l_orderkey""",
    "rockets": """
SELECT c_custkey AS rocket_id, c_name AS rocket_name, c_mktsegment AS rocket_type,
       CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS cost_per_launch,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey * 4.0::DOUBLE END AS success_rate
FROM customer""",
    "pads": """
SELECT n_nationkey AS launchpad_id, n_name AS launchpad_name, r_name AS region
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "enriched": """
SELECT l.*, r.rocket_name, r.rocket_type, r.cost_per_launch, r.success_rate, p.launchpad_name, p.region,
       strptime(date_utc, '%Y-%m-%dT%H:%M:%S.%gZ') AS launch_date,
       CASE WHEN payloads > 0 AND r.cost_per_launch IS NOT NULL THEN r.cost_per_launch / payloads END
         AS cost_per_payload
FROM launches l LEFT JOIN rockets r USING (rocket_id) LEFT JOIN pads p USING (launchpad_id)""",
    "scored": """
SELECT *, CAST(year(launch_date) AS INTEGER) AS launch_year, CAST(month(launch_date) AS INTEGER) AS launch_month,
       dayname(launch_date) AS launch_day_of_week,
       (CAST(success IS NOT NULL AS INTEGER) + CAST(rocket_name IS NOT NULL AS INTEGER)
        + CAST(launchpad_name IS NOT NULL AS INTEGER) + CAST(cost_per_launch IS NOT NULL AS INTEGER)
        + CAST(details IS NOT NULL AS INTEGER)) / 5.0::DOUBLE AS completeness_score
FROM enriched""",
    "branched": """
SELECT *,
  CASE WHEN completeness_score >= 0.8 THEN coalesce(success_rate / 100.0 * completeness_score, completeness_score)
       ELSE completeness_score END AS reliability_score,
  CASE WHEN completeness_score >= 0.8 THEN
       (CASE WHEN crew > 0 OR payloads > 3 THEN 'High' WHEN payloads > 1 THEN 'Medium' ELSE 'Low' END)
       ELSE 'Unknown' END AS mission_complexity,
  CASE WHEN completeness_score >= 0.8 THEN 'complete_analytics' ELSE 'basic_metrics' END AS processing_tier,
  CASE WHEN success THEN 'Success' WHEN NOT success THEN 'Failure' ELSE 'Unknown' END AS mission_outcome,
  CAST(floor((epoch_us(TIMESTAMP '2025-01-01 00:00:00') - epoch_us(launch_date)) / 86400000000) AS BIGINT)
    AS days_since_launch
FROM scored""",
    "final": """
SELECT *,
  CASE WHEN rocket_name IS NOT NULL THEN avg(CAST(success AS INTEGER)) OVER (PARTITION BY rocket_name) END
    AS avg_success_rate_by_rocket,
  CASE WHEN rocket_name IS NOT NULL THEN count(rocket_name) OVER (PARTITION BY rocket_name) END
    AS launches_by_rocket,
  CASE WHEN launchpad_name IS NOT NULL THEN avg(CAST(success AS INTEGER)) OVER (PARTITION BY launchpad_name) END
    AS avg_success_rate_by_pad
FROM branched""",
}

LAUNCH_OUT = ["flight_number", "name", "date_utc", "launch_year", "launch_month", "launch_day_of_week",
              "success", "details", "rocket_id", "rocket_name", "launchpad_id", "launchpad_name", "region",
              "crew", "payloads", "cores_used", "cost_per_launch", "success_rate", "cost_per_payload",
              "completeness_score", "mission_outcome", "reliability_score", "mission_complexity",
              "days_since_launch", "processing_tier", "avg_success_rate_by_rocket", "launches_by_rocket",
              "avg_success_rate_by_pad"]
LAUNCH_ROUND4 = ["cost_per_payload", "reliability_score", "avg_success_rate_by_rocket",
                 "avg_success_rate_by_pad", "completeness_score"]


def launches(cols=None) -> str:
    cols = cols or LAUNCH_OUT
    pick = ", ".join(f"{r(c, 4)} AS {c}" if c in LAUNCH_ROUND4 else c for c in cols)
    return with_ctes(LAUNCH, f"SELECT {pick} FROM final")


# ---------------------------------------------------------------- retail and titles

def _bins(x: str, edges, labels) -> str:
    arms = []
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = f"{x} > {lo}" + ("" if hi == float("inf") else f" AND {x} <= {hi}")
        arms.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(arms) + " END"


AGE_EDGES, AGE_LABELS = [0, 18, 30, 45, 60, 100], ["Under 18", "18-30", "31-45", "46-60", "Over 60"]
SPEND_EDGES, SPEND_LABELS = [0, 50, 200, 500, float("inf")], ["Low", "Medium", "High", "Premium"]
SALES_EDGES, SALES_LABELS = [0, 0.5, 2, 5, float("inf")], ["Niche", "Moderate", "Popular", "Blockbuster"]

RETAIL = {
    "shop0": f"""
SELECT l_orderkey AS invoice_no, o_custkey AS customer_id,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS invoice_date,
       ({UNIT}) / 100.0::DOUBLE AS price, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(o_custkey % 110 AS INTEGER) AS age
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "shop": f"""
SELECT *, CAST(year(invoice_date) AS INTEGER) AS year, CAST(month(invoice_date) AS INTEGER) AS month,
       dayname(invoice_date) AS day_of_week, price * quantity AS total_amount,
       {_bins('age', AGE_EDGES, AGE_LABELS)} AS age_group,
       {_bins('price * quantity', SPEND_EDGES, SPEND_LABELS)} AS spending_tier
FROM shop0""",
    "games0": """
SELECT p_partkey AS rank, p_name AS name, p_size / 10.0::DOUBLE AS na_sales, (p_partkey % 7) / 4.0::DOUBLE AS eu_sales,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE (p_retailprice - 900.0::DOUBLE) / 50.0::DOUBLE END AS jp_sales,
       (p_partkey % 3) / 10.0::DOUBLE AS other_sales,
       CASE WHEN p_size = 1 THEN NULL ELSE CAST(1980 + p_partkey % 40 AS DOUBLE) END AS year
FROM part""",
    "games1": """
SELECT *, 0.0::DOUBLE + coalesce(na_sales, 0) + coalesce(eu_sales, 0) + coalesce(jp_sales, 0)
          + coalesce(other_sales, 0) AS global_sales
FROM games0""",
    "games": f"""
SELECT *, {_bins('global_sales', SALES_EDGES, SALES_LABELS)} AS sales_category,
       CAST(floor(year / 10) * 10 AS INTEGER) AS decade,
       CASE greatest(coalesce(na_sales, 0), coalesce(eu_sales, 0), coalesce(jp_sales, 0), coalesce(other_sales, 0))
         WHEN coalesce(na_sales, 0) THEN 'na' WHEN coalesce(eu_sales, 0) THEN 'eu'
         WHEN coalesce(jp_sales, 0) THEN 'jp' ELSE 'other' END AS primary_market
FROM games1""",
    "shop_summary": """
SELECT d.age_group, coalesce(s.total_revenue, 0.0::DOUBLE) AS total_revenue,
       coalesce(s.transaction_count, 0) AS transaction_count, s.avg_transaction
FROM (VALUES ('Under 18'), ('18-30'), ('31-45'), ('46-60'), ('Over 60')) d(age_group)
LEFT JOIN (SELECT age_group, sum(total_amount) AS total_revenue, count(total_amount) AS transaction_count,
                  avg(total_amount) AS avg_transaction
           FROM shop WHERE age_group IS NOT NULL GROUP BY age_group) s USING (age_group)""",
    "games_summary": """
SELECT decade, sum(global_sales) AS total_sales_millions, avg(global_sales) AS avg_sales,
       count(global_sales) AS game_count
FROM games WHERE decade IS NOT NULL GROUP BY decade""",
    "crossed": """
SELECT s.age_group, g.decade, s.total_revenue AS shopping_revenue, s.transaction_count AS shopping_transactions,
       s.avg_transaction AS avg_shopping_amount, g.total_sales_millions AS gaming_sales_millions,
       g.game_count AS games_released, g.avg_sales AS avg_game_sales
FROM shop_summary s CROSS JOIN games_summary g""",
}


def retail(body: str) -> str:
    return with_ctes(RETAIL, body)


def rounded_select(cols, round4=(), src="t") -> str:
    return ", ".join(f"{r(c, 4)} AS {c}" if c in round4 else c for c in cols) + f" FROM {src}"


# ---------------------------------------------------------------- weather

WEATHER = {
    "wrows": """
SELECT event_id, event_type AS feed, ts AS time, value / 10.0::DOUBLE - 10.0::DOUBLE AS temperature_2m,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS relative_humidity_2m,
       CASE WHEN event_id % 2 = 0 THEN value / 40.0::DOUBLE ELSE 0.0::DOUBLE END AS precipitation, value / 5.0::DOUBLE AS wind_speed_10m
FROM events""",
    "merged": """
SELECT event_id, time, temperature_2m, relative_humidity_2m, precipitation, wind_speed_10m,
       CASE feed WHEN 'click' THEN 'Chiang Mai' WHEN 'view' THEN 'Bangkok' WHEN 'purchase' THEN 'Phuket'
                 WHEN 'signup' THEN 'Khon Kaen' WHEN 'error' THEN 'Hat Yai' END AS city, feed AS region
FROM wrows""",
    "numbered": """
SELECT *, row_number() OVER (ORDER BY region, time, event_id) AS rn, count(*) OVER () AS n FROM merged""",
    "sampled": """
SELECT * EXCLUDE (rn, n) FROM numbered
WHERE n <= 200 OR ((rn - 1) % (n // 200) = 0 AND rn <= (n // 200) * 200)""",
}


def weather_transform(src: str) -> str:
    return f"""
SELECT *, CAST(time AS DATE) AS date, CAST(hour(time) AS INTEGER) AS hour,
  CASE WHEN precipitation > 5 THEN 'rainy' WHEN temperature_2m > 25 THEN 'hot' WHEN temperature_2m < 5 THEN 'cold'
       ELSE 'moderate' END AS weather_type,
  100.0::DOUBLE - abs(temperature_2m - 22.0::DOUBLE) * 2.0::DOUBLE - relative_humidity_2m * 0.3::DOUBLE AS comfort_index,
  {_bins('wind_speed_10m', [0, 5, 10, 20, 100], ['calm', 'light', 'moderate', 'strong'])} AS wind_category
FROM {src}"""


def weather(body: str, sample: bool = True) -> str:
    ctes = dict(WEATHER)
    ctes["final"] = weather_transform("sampled" if sample else "merged")
    return with_ctes(ctes, body)


# ---------------------------------------------------------------- pages, listings, creatures, parents

# The pages are made of events, so the posts follow from the events without any markup.
POSTS = {
    "stories": """
SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(event_id AS VARCHAR) AS n,
       CASE event_id % 5 WHEN 0 THEN 'https://news.ycombinator.com/item?id=' || event_id WHEN 1 THEN 'http://x' || (event_id % 9) || '.org/a?b=1'
            WHEN 2 THEN 'https://news.ycombinator.com/newest' WHEN 3 THEN 'https://site.example:8080/p/' || event_id
            ELSE 'https://www.host' || (event_id % 4) || '.com/' || event_id || '#top' END AS url
FROM events WHERE event_id % 17 <> 3 AND event_id % 19 <> 5 AND event_id % 23 <> 9 AND (event_id % 7 = 2 OR event_id % 29 <> 7)""",
    "posts0": """
SELECT event_id // 30 + 1 AS page_no, n AS story_id, 'The ' || event_type || ' & "' || n || '"' AS title, url,
       CASE WHEN event_id % 7 = 2 THEN 0 ELSE CAST(floor(value * 3) AS INTEGER) END AS points,
       CASE WHEN event_id % 11 = 4 THEN 'unknown' ELSE 'u' || user_id END AS author,
       CASE WHEN event_id % 13 = 6 THEN 'unknown' ELSE (event_id % 24) || ' hours ago' END AS age,
       CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN k ELSE 1 END AS comments,
       CASE event_id % 5 WHEN 1 THEN 'x' || (event_id % 9) || '.org' WHEN 3 THEN 'site.example:8080'
            WHEN 4 THEN 'www.host' || (event_id % 4) || '.com' ELSE 'news.ycombinator.com' END AS source
FROM stories""",
    "posts": """
SELECT *, points + comments AS engagement_score,
       CASE WHEN points + comments >= 100 THEN 'viral' WHEN points + comments >= 50 THEN 'popular'
            WHEN points + comments >= 20 THEN 'moderate' ELSE 'new' END AS popularity,
       NOT contains(url, 'news.ycombinator.com') AS is_external FROM posts0""",
}

LISTINGS = {
    "lst0": """
SELECT p_partkey AS listing_id, p_name AS name, 'US$' || format('{:,.2f}', p_retailprice * p_size / 10.0::DOUBLE) AS price,
       CASE WHEN p_type = 'SMALL' THEN 'no reviews yet' ELSE CAST(p_size AS VARCHAR) || ' reviews' END AS total_reviews
FROM part""",
    "lst": """
SELECT *, TRY_CAST(trim(replace(replace(price, 'US$', ''), ',', '')) AS DOUBLE) AS price_usd,
       TRY_CAST(nullif(regexp_extract(total_reviews, '(\\d+)', 1), '') AS DOUBLE) AS review_count
FROM lst0""",
}

_STATS = ["hp", "attack", "defense", "special_attack", "special_defense", "speed"]

CREATURES = {
    "ent": "SELECT p_partkey AS pokemon_id, CASE WHEN p_partkey % 37 = 5 THEN 'unknown' ELSE p_name END AS name, "
           "CASE WHEN p_partkey % 41 = 6 THEN 0 ELSE CAST(p_size AS BIGINT) END AS height, "
           "CAST(trunc(p_retailprice) AS BIGINT) AS weight, CASE WHEN p_partkey % 43 = 7 THEN 0 ELSE CAST(p_size * 5 AS BIGINT) END AS base_experience, "
           + ", ".join(f"CAST((p_partkey * {i + 3} + p_size) % 120 + CASE WHEN p_size > 40 THEN 80 ELSE 20 END AS BIGINT) AS {n}" for i, n in enumerate(_STATS))
           + ", lower(p_type) AS type_primary, "
           "CASE WHEN p_size > 25 THEN lower(replace(p_brand, '#', '-')) END AS type_secondary, "
           "6 AS n_stats, CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS n_types FROM part WHERE p_partkey % 53 <> 11",
    "spc": """
SELECT l_partkey AS pokemon_id, count(*) >= 40 AS is_legendary, l_partkey % 23 <> 2 AND count(*) >= 45 AS is_mythical,
       CASE WHEN l_partkey % 29 = 3 THEN 'unknown' ELSE 'generation-' || CAST(min(l_linenumber) AS VARCHAR) END AS generation
FROM lineitem GROUP BY l_partkey""",
    "cr0": "SELECT e.*, s.is_legendary, s.is_mythical, s.generation, "
           + " + ".join(_STATS) + " AS total_stats FROM ent e JOIN spc s USING (pokemon_id)",
    "cr": """
SELECT * REPLACE (array_to_string(list_transform(regexp_extract_all(name, '(\\p{L}+|[^\\p{L}]+)'),
                                                 lambda x: upper(x[1]) || lower(x[2:])), '') AS name),
  CASE WHEN is_mythical THEN 'mythical' WHEN is_legendary THEN 'legendary' WHEN total_stats >= 500 THEN 'rare'
       WHEN total_stats >= 400 THEN 'uncommon' ELSE 'common' END AS rarity,
  CASE WHEN coalesce(is_legendary OR is_mythical, false) THEN
       (CASE WHEN is_mythical THEN 'mythical' WHEN total_stats >= 680 THEN 'box_legendary' ELSE 'sub_legendary' END)
       END AS legendary_tier,
  CASE WHEN coalesce(is_legendary OR is_mythical, false) THEN total_stats * 1.5::DOUBLE + base_experience
       ELSE total_stats + base_experience * 0.5::DOUBLE END AS power_score,
  CASE WHEN NOT coalesce(is_legendary OR is_mythical, false) THEN
       (CASE WHEN attack > defense AND speed >= 80 THEN 'sweeper' WHEN defense > attack AND hp >= 80 THEN 'tank'
             ELSE 'balanced' END) END AS combat_role
FROM cr0""",
}

PARENTS = {
    "prof": """
SELECT l_orderkey AS parent_id, coalesce(bool_or(l_returnflag = 'R'), false) AS has_special,
       count(l_partkey) AS n_children, count(DISTINCT l_returnflag) AS n_types,
       bool_or(l_linestatus = 'O') AS has_open, bool_or(l_linestatus = 'F') AS has_filled
FROM lineitem GROUP BY l_orderkey""",
    "par": """
SELECT o_orderkey AS parent_id, o_orderpriority,
       CASE o_orderstatus WHEN 'O' THEN 'api' WHEN 'F' THEN 'file' ELSE 'web_scraping' END AS source_type,
       coalesce(has_special, false) AS has_special,
       coalesce(n_children, 0) AS n_children, coalesce(n_types, 0) AS n_types,
       coalesce(has_open, false) AS has_open, coalesce(has_filled, false) AS has_filled,
       CASE WHEN coalesce(has_special, false) OR coalesce(n_children, 0) >= 7 THEN 'advanced'
            WHEN coalesce(n_children, 0) >= 4 THEN 'intermediate' ELSE 'beginner' END AS complexity
FROM orders LEFT JOIN prof ON o_orderkey = prof.parent_id""",
}

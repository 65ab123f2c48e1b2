"""SQL over the driver's tables for the same rows as the queries: common parts."""

from __future__ import annotations

END_OF = "CASE WHEN date_trunc('{u}', {c}) = {c} THEN {c} ELSE date_trunc('{u}', {c}) + INTERVAL 1 {u} END"


#: The day that a bar's time lies in.
DAY = "CAST({c} - INTERVAL 1 microsecond AS DATE)"


def end_of(column: str, unit: str) -> str:
    return END_OF.format(u=unit, c=column)


def key_of(column: str) -> str:
    return f"strftime({column}, '%Y%m%d%H%M')"


RAW = """raw AS (
  SELECT event_id AS seqno, CAST(user_id AS VARCHAR) AS symbol, ts, event_type, CAST(round(value * 100) AS BIGINT) AS lastprice FROM events
), rt AS (
  SELECT seqno, symbol, ts, lastprice, 2 AS decimal, CASE WHEN event_type = 'purchase' THEN 1 + seqno % 10 ELSE 0 END AS lasttradeqty,
         seqno % 3 AS shortsellflag FROM raw WHERE event_type IN ('purchase', 'signup', 'error')
), t AS (
  SELECT *, CAST(sum(lasttradeqty) OVER w AS BIGINT) AS totalvol, CAST(sum(lasttradeqty * lastprice) OVER w AS BIGINT) AS totalamount,
         first_value(lastprice) OVER w AS open, max(lastprice) OVER w AS high, min(lastprice) OVER w AS low,
         coalesce(lag(lastprice) OVER (PARTITION BY symbol ORDER BY seqno), 0) AS preclose
  FROM rt WINDOW w AS (PARTITION BY symbol ORDER BY seqno ROWS UNBOUNDED PRECEDING)
), q AS (
  SELECT seqno, symbol, ts, lastprice - 5 AS bidprice, seqno % 100 AS bidsize, lastprice + 5 AS askprice, (seqno + 50) % 100 AS asksize, 2 AS decimal
  FROM raw WHERE event_type IN ('click', 'view')
), ir AS (
  SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_name AS name, c_nationkey AS market, greatest(CAST(round(c_acctbal * 100) AS BIGINT), 0) AS lim, c_custkey AS k FROM customer
), irows AS (
  SELECT symbol, name, market, lim AS limitup, CAST(floor(lim / 2) AS BIGINT) AS limitdown, 2 AS decimal, k * 2 AS seqno FROM ir
  UNION ALL SELECT symbol, name || '*', market, lim * (k % 2), 0, 2 * (k % 2), k * 2 + 1 FROM ir
), ins AS (
  SELECT symbol, arg_max(name, seqno) AS name, arg_max(market, seqno) AS market,
         coalesce(arg_max(limitup, seqno) FILTER (WHERE limitup <> 0), 0) AS limitup, coalesce(arg_max(limitdown, seqno) FILTER (WHERE limitdown <> 0), 0) AS limitdown,
         coalesce(arg_max(decimal, seqno) FILTER (WHERE decimal <> 0), 0) AS decimal FROM irows GROUP BY symbol
)"""


def bars(unit: str) -> str:
    """Bars of ticks (b) and the grid of their ends for symbols seen by then (g)."""
    return f"""{RAW}, tb AS (SELECT *, {end_of("ts", unit)} AS bar FROM t), qb AS (SELECT *, {end_of("ts", unit)} AS bar FROM q), b AS (
  SELECT symbol, bar, arg_min(lastprice, seqno) / 100.0 AS open, max(lastprice) / 100.0 AS high, min(lastprice) / 100.0 AS low, arg_max(lastprice, seqno) / 100.0 AS close,
         count(*) AS count, max(seqno) AS seqno, bool_or(lasttradeqty > 0) AS any_quantity, arg_min(totalvol, seqno) AS v0, arg_max(totalvol, seqno) AS v1,
         arg_min(totalamount, seqno) AS a0, arg_max(totalamount, seqno) AS a1, arg_max(lastprice, seqno) AS lastprice FROM tb GROUP BY symbol, bar
), bl AS (
  SELECT *, lag(v1) OVER w AS pv, lag(a1) OVER w AS pa FROM b WINDOW w AS (PARTITION BY symbol, {DAY.format(c="bar")} ORDER BY bar)
), bx AS (
  SELECT *, lag(v1) OVER w AS pv, lag(a1) OVER w AS pa FROM b WINDOW w AS (PARTITION BY symbol ORDER BY bar)
), g AS (
  SELECT s.symbol, d.bar FROM (SELECT DISTINCT bar FROM b) d JOIN (SELECT symbol, min(bar) AS first FROM b GROUP BY symbol) s ON d.bar >= s.first
)"""


def volumes(first_seen: str) -> str:
    base = {"self": ("v1", "a1"), "start": ("v0", "a0"), "zero": ("0", "0")}[first_seen]
    return f"greatest(v1 - coalesce(pv, {base[0]}), 0) AS volume, greatest(a1 - coalesce(pa, {base[1]}), 0) / 100.0 AS amount"

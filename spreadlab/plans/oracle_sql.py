"""Independent DuckDB SQL for every checked query.

These statements are the correctness oracle: they are written from the
operator definitions, not generated from the Spark plans.  Views ``events``,
``orders`` ... are registered by the checker.  Shared building blocks are CTE
fragments composed by ``with_ctes``.
"""

from __future__ import annotations

AS_OF = "2024-01-31"

# --- surrogate ticks and bars ------------------------------------------------
CTE = {}
CTE["ev"] = """ev AS (
  SELECT event_type AS symbol, ts, event_id, value,
         CAST(round(value * 100.0) AS BIGINT) AS cents
  FROM events)"""
CTE["walk_tot"] = """walk_tot AS (
  SELECT symbol, sum(cents) AS tot_cents FROM ev GROUP BY symbol)"""
CTE["ticks"] = """ticks AS (
  SELECT e.symbol, e.ts, e.event_id, e.cents,
         CASE WHEN e.symbol IN ('signup', 'view') THEN
              100.0::DOUBLE + 1000.0::DOUBLE * CAST(sum(e.cents) OVER (
                  PARTITION BY e.symbol ORDER BY e.ts, e.event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
                / CAST(t.tot_cents AS DOUBLE)
         ELSE 100.0::DOUBLE
              + (CAST(epoch_us(e.ts) - 1704067200000000 AS DOUBLE) / 1000000.0::DOUBLE) / 36000.0::DOUBLE
              + e.value * 0.25::DOUBLE
         END AS price
  FROM ev e JOIN walk_tot t USING (symbol))"""


def _bars(name: str, width_s: int) -> str:
    w = width_s * 1_000_000
    return f"""{name} AS (
  SELECT symbol, make_timestamp(b * {w}) AS ts,
         arg_min(price, (ts, event_id)) AS open,
         max(price) AS high,
         min(price) AS low,
         arg_max(price, (ts, event_id)) AS close,
         CAST(sum(cents) AS DOUBLE) / 100.0::DOUBLE AS volume,
         arg_max(event_id, (ts, event_id)) AS close_event_id,
         CAST(make_timestamp(b * {w}) AS DATE) AS date
  FROM (SELECT *, epoch_us(ts) // {w} AS b FROM ticks) GROUP BY symbol, b)"""


CTE["bars1h"] = _bars("bars1h", 3600)
CTE["bars5m"] = _bars("bars5m", 300)

DEPS = {
    "walk_tot": ["ev"],
    "ticks": ["ev", "walk_tot"],
    "bars1h": ["ticks"],
    "bars5m": ["ticks"],
}


def with_ctes(names, body: str, extra: dict | None = None, extra_deps: dict | None = None) -> str:
    """Compose ``WITH`` clauses for ``names`` (dependencies first) and a final SELECT.
    The lag search (``aic``) recurses."""
    ctes = dict(CTE)
    deps = dict(DEPS)
    if extra:
        ctes.update(extra)
    if extra_deps:
        deps.update(extra_deps)
    order: list[str] = []

    def visit(n):
        for d in deps.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return ("WITH RECURSIVE " if "aic" in order else "WITH ") + ",\n".join(ctes[n] for n in order) + "\n" + body


# --- numeric helpers as SQL text (same formulas as functions.mathfn) ----------
def _horner_sql(x: str, coefs) -> str:
    acc = f"{float(coefs[-1])!r}::DOUBLE"
    for c in reversed(coefs[:-1]):
        acc = f"({float(c)!r}::DOUBLE + {x} * {acc})"
    return acc


# Fixed values, stated here again so that a wrong constant in the library shows:
# normal CDF, Abramowitz and Stegun 26.2.17 (p, then b1..b5) and 1 / sqrt(2 pi);
# MacKinnon (1994) response surface of the two-variable test with a constant:
# tau limits, small- and large-p polynomials; tau where p = 0.05.
CDF_P = 0.2316419
CDF_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
CDF_SCALE = 0.3989422804014327
TAU_MIN, TAU_TURN, TAU_MAX = -18.86, -2.62, 0.92
P_SMALL = (2.92, 1.5012, 0.039796)
P_LARGE = (2.1945, 0.64695, -0.29198, -0.042377)
TAU_AT_5_PERCENT = "-3.3357863315881104"


def norm_cdf_sql(x: str) -> str:
    t = f"(1.0::DOUBLE / (1.0::DOUBLE + {CDF_P!r}::DOUBLE * abs({x})))"
    upper = f"({CDF_SCALE!r}::DOUBLE * exp(-({x} * {x}) / 2.0::DOUBLE) * ({t} * {_horner_sql(t, CDF_B)}))"
    return f"(CASE WHEN {x} >= 0 THEN 1.0::DOUBLE - {upper} ELSE {upper} END)"


def eg_pvalue_sql(tau: str) -> str:
    small = norm_cdf_sql(_horner_sql(tau, P_SMALL))
    large = norm_cdf_sql(_horner_sql(tau, P_LARGE))
    return (f"(CASE WHEN {tau} IS NULL THEN NULL WHEN {tau} < {TAU_MIN!r} THEN 0.0::DOUBLE "
            f"WHEN {tau} > {TAU_MAX!r} THEN 1.0::DOUBLE WHEN {tau} <= {TAU_TURN!r} THEN {small} "
            f"ELSE {large} END)")


def pair_rows_sql(sig: str, name: str) -> str:
    """Next-bar pair PnL rows over a pair-signal CTE ``sig`` (ts, symbol_a,
    symbol_b, beta, signal) and the ``px``/``nb`` price CTEs."""
    return f"""{name}_s5 AS (
  SELECT make_timestamp((epoch_us(ts) // 300000000) * 300000000) AS ts5, symbol_a, symbol_b, beta, signal
  FROM {sig}, (SELECT greatest((SELECT min(ts) FROM {sig}), (SELECT min(ts) FROM px)) AS o_start,
                      least((SELECT max(ts) FROM {sig}), (SELECT max(ts) FROM px)) AS o_end) b
  WHERE b.o_end > b.o_start
    AND make_timestamp((epoch_us(ts) // 300000000) * 300000000) BETWEEN b.o_start AND b.o_end
    AND beta IS NOT NULL AND beta >= 0.1 AND beta <= 10.0),
{name}_j AS (
  SELECT s.*, a.close AS close_a, a.close_next AS close_next_a, a.ts5_next AS ts5_next_a,
         b.close AS close_b, b.close_next AS close_next_b, b.ts5_next AS ts5_next_b
  FROM {name}_s5 s JOIN nb a ON a.symbol = s.symbol_a AND a.ts5 = s.ts5
  JOIN nb b ON b.symbol = s.symbol_b AND b.ts5 = s.ts5
  WHERE a.close_next IS NOT NULL AND b.close_next IS NOT NULL),
{name}_d AS (
  SELECT *, CASE WHEN close_next_a > 0 THEN ln(close_next_a) END - CASE WHEN close_a > 0 THEN ln(close_a) END AS dln_a,
            CASE WHEN close_next_b > 0 THEN ln(close_next_b) END - CASE WHEN close_b > 0 THEN ln(close_b) END AS dln_b
  FROM {name}_j),
{name} AS (
  SELECT ts5, symbol_a, symbol_b, beta, signal, dln_a - beta * dln_b AS ret_pair,
         signal * CASE WHEN close_a + abs(beta) * close_b > 0 THEN dln_a - beta * dln_b ELSE 0.0::DOUBLE END AS pnl,
         symbol_a || '||' || symbol_b AS pair, ts5_next_a, ts5_next_b
  FROM {name}_d WHERE abs(dln_a) <= 0.5 AND abs(dln_b) <= 0.5)"""


def logistic_newton_sql(rows: str, features: list[str], steps: int = 10) -> str:
    """CTEs that fit  0.5 |w|^2 + sum of log losses  (intercept not penalised) by Newton
    steps from zero; ``rows`` has y and z1..zk (standardised, the last one 1).
    Every step sums gradient and Hessian over the rows and eliminates; the last
    CTE is ``newton`` (w1..wk)."""
    k = len(features) + 1
    ids = range(1, k + 1)
    out = ["nw0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS w{i}" for i in ids) + ")"]
    for n in range(1, steps + 1):
        score = " + ".join(f"w{i} * z{i}" for i in ids)
        penalty = {i: (f" + any_value(w{i})" if i < k else "") for i in ids}
        hess = [f"sum(p * (1 - p) * z{i} * z{j}){' + 1.0::DOUBLE' if i == j < k else ''} AS a{i}_{j}" for i in ids for j in ids]
        grad = [f"sum((p - y) * z{i}){penalty[i]} AS a{i}_{k + 1}" for i in ids]
        keep = [f"any_value(w{i}) AS w{i}" for i in ids]
        out.append(f"ns{n}_0 AS MATERIALIZED (SELECT {', '.join(hess + grad + keep)} FROM "
                   f"(SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({score}))) AS p FROM {rows}, nw{n - 1}))")
        for c in range(1, k):                                 # eliminate column c below row c
            cells = []
            for i in ids:
                for j in range(1, k + 2):
                    cells.append(f"a{i}_{j} - a{i}_{c} / a{c}_{c} * a{c}_{j} AS a{i}_{j}" if i > c else f"a{i}_{j}")
            out.append(f"ns{n}_{c} AS MATERIALIZED (SELECT {', '.join(cells)}, {', '.join(f'w{i}' for i in ids)} FROM ns{n}_{c - 1})")
        last, source = [], f"ns{n}_{k - 1}"
        for i in reversed(ids):                               # back substitution, one column a level
            rest = "".join(f" - a{i}_{j} * d{j}" for j in range(i + 1, k + 1))
            source = f"(SELECT *, (a{i}_{k + 1}{rest}) / a{i}_{i} AS d{i} FROM {source})"
            last.append(f"w{i} - d{i} AS w{i}")
        out.append(f"nw{n} AS MATERIALIZED (SELECT {', '.join(reversed(last))} FROM {source})")
    return ",\n".join([*out, f"newton AS (SELECT * FROM nw{steps})"])

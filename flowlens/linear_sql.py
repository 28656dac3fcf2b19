"""SQL text of gradient descent (the oracle twin of ``operators.linear``): unrolled, or as a recursive CTE."""

from __future__ import annotations

from collections.abc import Sequence


def gd_sql(features: Sequence[str], lr: float, iterations: int, l2: float = 0.0, l2_bias: bool = False,
           mean: bool = True, clip_z: float | None = None, weight: str | None = None, train: str = "train",
           as_table: bool = False) -> str:
    ws = ["b"] + [f"w{i + 1}" for i in range(len(features))]
    ctes = [", w0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS {w}" for w in ws) + ")"]
    for k in range(iterations):
        z = "w.b"
        for i, c in enumerate(features):
            z = f"({z} + w.w{i + 1} * t.{c})"
        if clip_z is not None:
            z = f"LEAST(GREATEST({z}, {-clip_z!r}::DOUBLE), {clip_z!r}::DOUBLE)"
        e = f"((1.0::DOUBLE / (1.0::DOUBLE + exp(-({z})))) - t.label)"
        if weight:
            e = f"({e} * t.{weight})"
        scale = " * (1.0::DOUBLE / COUNT(*))" if mean else ""
        cols = []
        for j, w in enumerate(ws):
            g = f"SUM({e})" if j == 0 else f"SUM({e} * t.{features[j - 1]})"
            reg = f" + {l2!r}::DOUBLE * w.{w}" if (l2 and (j > 0 or l2_bias)) else ""
            cols.append(f"w.{w} - {lr!r}::DOUBLE * ({g}{scale}{reg}) AS {w}")
        group = ", ".join(f"w.{w}" for w in ws)
        ctes.append(f", w{k + 1} AS (SELECT {', '.join(cols)} FROM {train} t, w{k} w GROUP BY {group})")
    last = f"w{iterations}"
    if as_table:
        rows = " UNION ALL ".join(
            f"SELECT '{c}' AS feature, ROUND(w{i + 1}, 6) AS coefficient, ABS(ROUND(w{i + 1}, 6)) AS abs_value FROM {last}"
            for i, c in enumerate(features))
        return "\n".join(ctes) + "\n" + rows
    names = ["w_bias"] + [f"w_{c}" for c in features]
    return "\n".join(ctes) + "\nSELECT " + ", ".join(f"ROUND({w}, 6) AS {n}" for w, n in zip(ws, names)) + f" FROM {last}"


def gd_recursive_sql(features: Sequence[str], lr: float, iterations: int, l2: float = 0.0, l2_bias: bool = False, mean: bool = True,
                     clip_z: float | None = None, weight: str | None = None, patience: int | None = None, train: str = "train") -> str:
    """CTEs ``gd`` (a row for each pass: k, weights, loss, accuracy, best loss so far, passes without a better one) and ``fitted``.

    The recursion is the loop: a pass makes the next weights from the last row's gradient and adds up gradient, loss
    and right predictions there. With patience it ends after as many passes without a better loss, and ``fitted``
    is the best pass; else the last one. The query must begin with WITH RECURSIVE.
    """
    ws = ["b"] + [f"w{i + 1}" for i in range(len(features))]
    s = f"t.{weight}" if weight else "1.0::DOUBLE"
    z = "n.b"
    for i, c in enumerate(features):
        z = f"({z} + n.w{i + 1} * t.{c})"
    if clip_z is not None:
        z = f"LEAST(GREATEST({z}, {-clip_z!r}::DOUBLE), {clip_z!r}::DOUBLE)"
    reg = [f"{l2!r}::DOUBLE * p.{w}" if l2 and (w != "b" or l2_bias) else "0.0::DOUBLE" for w in ws]
    scale = " / p.n" if mean else ""
    step = ", ".join(f"p.{w} - {lr!r}::DOUBLE * (p.g{j}{scale} + {reg[j]}) AS {w}" for j, w in enumerate(ws))
    penalty = " + ".join(["0.0::DOUBLE"] + [f"{0.5 * l2!r}::DOUBLE * n.{w} * n.{w}" for w in ws if l2 and (w != "b" or l2_bias)])

    def one_pass(source: str) -> str:
        names = ", ".join(ws)
        sums = ", ".join(["SUM(e) AS g0"] + [f"SUM(e * {c}) AS g{i + 1}" for i, c in enumerate(features)])
        return f"""
  SELECT k, {names}, {sums}, SUM(row_loss) / COUNT(*) + ANY_VALUE(penalty) AS loss, COUNT(*) AS n,
         COUNT(*) FILTER ((h >= 0.5) = (label = 1)) / COUNT(*) AS accuracy, ANY_VALUE(old_best) AS old_best, ANY_VALUE(old_stall) AS old_stall
  FROM (SELECT *, (h - label) * s AS e,
               -ln(CASE WHEN label = 1 THEN LEAST(GREATEST(h, 1e-15), 1 - 1e-15) ELSE 1 - LEAST(GREATEST(h, 1e-15), 1 - 1e-15) END) * s AS row_loss
        FROM (SELECT n.*, t.label, {", ".join("t." + c for c in features)}, {s} AS s, {penalty} AS penalty,
                     1.0::DOUBLE / (1.0::DOUBLE + exp(-({z}))) AS h
              FROM {source} n, gd_train t))
  GROUP BY k, {names}"""

    zero = ", ".join(f"0.0::DOUBLE AS {w}" for w in ws)
    cols = ", ".join(["k", *ws, *[f"g{j}" for j in range(len(ws))], "loss", "n", "accuracy"])
    going = f"p.k < {iterations}" + (f" AND p.stall < {patience}" if patience is not None else "")
    last = "ORDER BY loss, k" if patience is not None else "ORDER BY k DESC"
    return f""", gd_train AS MATERIALIZED (SELECT * FROM {train}),
gd AS (
  SELECT {cols}, 'Infinity'::DOUBLE AS best, 0 AS stall
  FROM ({one_pass(f"(SELECT 0 AS k, {zero}, 'Infinity'::DOUBLE AS old_best, 0 AS old_stall)")})
  UNION ALL
  SELECT {cols}, LEAST(old_best, loss) AS best, (CASE WHEN loss < old_best THEN 0 ELSE old_stall + 1 END)::INT AS stall
  FROM ({one_pass(f"(SELECT (p.k + 1)::INT AS k, {step}, p.best AS old_best, p.stall AS old_stall FROM gd p WHERE {going})")})),
fitted AS (SELECT * FROM gd WHERE k > 0 {last} LIMIT 1)
"""


def weights_sql(features: Sequence[str]) -> str:
    names = ["w_bias"] + [f"w_{c}" for c in features]
    ws = ["b"] + [f"w{i + 1}" for i in range(len(features))]
    return "SELECT " + ", ".join(f"ROUND({w}, 6) + 0.0 AS {n}" for w, n in zip(ws, names)) + " FROM fitted"


HISTORY_SQL = "SELECT (k - 1)::INT AS iteration, ROUND(loss, 6) AS loss, ROUND(accuracy, 6) AS accuracy FROM gd WHERE k > 0"

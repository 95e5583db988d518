"""Student's t tail and quantile, as SQL text.

Tail: asymptotic normalising expansion of Hill, CACM Algorithm 395 (1970).
Quantile: Hill, CACM Algorithm 396 (1970).  Both take real degrees of freedom.
Tail error is about 2e-5 at df = 3 and below 1e-9 from df = 10 on.
"""

from __future__ import annotations

import math

from armlift.functions.normal import Z_CRITICAL, double


def equivalent_z(t: str, df: str) -> str:
    """|z| whose normal tail equals the t tail at ``t`` with ``df`` degrees of freedom."""
    a = f"({df} - 0.5D)"
    b = f"(48 * {a} * {a})"
    y = f"({a} * log1p({t} * {t} / {df}))"
    series = (
        f"(((-0.4D * {y} - 3.3D) * {y} - 24) * {y} - 85.5D) / (0.8D * {y} * {y} + 100 + {b})"
    )
    return f"(({series} + {y} + 3) / {b} + 1) * sqrt({y})"


def t_critical(df: str, confidence: float = 0.95) -> str:
    """Two-sided t quantile at a tabulated confidence level."""
    tail = 1.0 - confidence
    x = -Z_CRITICAL[confidence]
    a = f"(1 / ({df} - 0.5D))"
    b = f"(48 / ({a} * {a}))"
    c = f"(((20700 * {a} / {b} - 98) * {a} - 16) * {a} + 96.36D)"
    d = f"(((94.5D / ({b} + {c}) - 3) / {b} + 1) * sqrt({a} * {double(math.pi / 2)}) * {df})"
    small = f"pow({d} * {double(tail)}, 2 / {df})"

    correction = f"CASE WHEN {df} < 5 THEN {double(0.3 * (x + 0.6))} * ({df} - 4.5D) ELSE 0D END"
    lower = f"(((0.05D * {d} * {double(x)} - 5) * {double(x)} - 7) * {double(x)} - 2) * {double(x)}"
    scale = f"({lower} + {b} + {c} + {correction})"
    square = x * x
    head = double(((0.4 * square + 6.3) * square + 36.0) * square + 94.5)
    y = f"((({head} / {scale} - {double(square)} - 3) / {b} + 1) * {double(x)})"
    central = f"expm1({a} * {y} * {y})"

    inner = (
        f"(1 / ((({df} + 6) / ({df} * {small}) - 0.089D * {d} - 0.822D) * ({df} + 2) * 3))"
    )
    far = (
        f"(({inner} + 0.5D / ({df} + 4)) * {small} - 1) * ({df} + 1) / ({df} + 2) + 1 / {small}"
    )
    one = 1.0 / math.tan(tail * math.pi / 2)
    two = math.sqrt(2.0 / (tail * (2.0 - tail)) - 2.0)
    return f"""
      CASE WHEN {df} <= 1 THEN {double(one)}
           WHEN {df} = 2 THEN {double(two)}
           ELSE sqrt({df} * CASE WHEN {small} > {a} + 0.05D THEN {central} ELSE {far} END) END
    """

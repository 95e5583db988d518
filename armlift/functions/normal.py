"""Standard normal tail, critical values and normal confidence intervals, as SQL text.

Spark has no ``erf``.  The upper tail below is the double-precision rational
approximation of Hart (1968) in the form given by West, "Better approximations
to cumulative normal functions" (2005).  It evaluates the tail itself rather
than ``1 - cdf``, so very small p-values keep their digits.
"""

from __future__ import annotations

from functools import reduce

# Published coefficients, highest power first.
_NUMERATOR = (
    0.0352624965998911,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
)
_DENOMINATOR = (
    0.0883883476483184,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
)
_FAR_TAIL_FROM = 7.07106781186547
_ROOT_TWO_PI = 2.506628274631

# Two-sided standard normal critical values.
Z_CRITICAL = {
    0.90: 1.6448536269514722,
    0.95: 1.959963984540054,
    0.99: 2.5758293035489004,
}
# Fixed value: the rounded multiplier used for every reported 95% interval.
Z_95 = "1.96D"


def double(value: float) -> str:
    """A double literal; a bare decimal point would make a DECIMAL."""
    return f"{value!r}D"


def _horner(x: str, coefficients: tuple[float, ...]) -> str:
    first, *rest = map(double, coefficients)
    return reduce(lambda acc, c: f"({acc} * {x} + {c})", rest, first)


def upper_tail(x: str) -> str:
    """P(Z > x) for x >= 0; NULL stays NULL."""
    density = f"exp(-{x} * {x} / 2)"
    near = f"{density} * {_horner(x, _NUMERATOR)} / {_horner(x, _DENOMINATOR)}"
    fraction = reduce(lambda acc, k: f"({x} + {k} / {acc})", (4, 3, 2, 1), f"({x} + 0.65D)")
    far = f"{density} / {fraction} / {double(_ROOT_TWO_PI)}"
    return f"CASE WHEN {x} < {double(_FAR_TAIL_FROM)} THEN {near} ELSE {far} END"


def two_sided_p(z: str) -> str:
    """Two-sided p-value of a z statistic.  Give a column name: it is used many times."""
    return f"2 * ({upper_tail(f'abs({z})')})"


def z_critical(confidence: str) -> str:
    """Two-sided critical value at 0.90, 0.95 or 0.99; any other level fails the query."""
    cases = " ".join(
        f"WHEN abs({confidence} - {double(level)}) < 1e-9D THEN {double(value)}"
        for level, value in Z_CRITICAL.items()
    )
    message = "critical values are tabulated for 0.90, 0.95 and 0.99 only"
    return f"CASE {cases} ELSE CAST(raise_error('{message}') AS DOUBLE) END"


def ci_95(estimate: str, se: str, suffix: str = "") -> list[str]:
    """Select items ci_low, ci_high: estimate -/+ 1.96 se, NULL when se is NULL or not positive."""
    return [
        f"CASE WHEN {se} > 0 THEN {estimate} {sign} {Z_95} * {se} END AS ci_{side}{suffix}"
        for sign, side in (("-", "low"), ("+", "high"))
    ]

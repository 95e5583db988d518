"""Upper tail of the chi-square distribution for whole degrees of freedom, as SQL text.

For an even number the tail is a finite Poisson sum, for an odd one the two-sided normal tail of the root
plus a finite sum; each term follows from the one before it.
"""

from __future__ import annotations

from armlift.functions.normal import two_sided_p


def _sum(terms: str, first: str, factor: str) -> str:
    """Sum of ``terms`` terms: the first, then each times ``factor`` (of its number ``i``, from 1)."""
    step = f"named_struct('s', a.s + a.t * {factor}, 't', a.t * {factor})"
    start = f"named_struct('s', {first}, 't', {first})"
    return (
        f"CASE WHEN {terms} < 1 THEN 0D ELSE aggregate(slice(sequence(0, {terms}), 2, {terms} - 1),"
        f" {start}, (a, i) -> {step}, a -> a.s) END"
    )


def chi_square_tail(stat: str, df: str) -> str:
    """P(X > stat) for ``df`` degrees of freedom; both are column names.  NULL for none or a NULL statistic."""
    half, root = f"({stat} / 2)", f"sqrt({stat})"
    even = _sum(f"CAST({df} DIV 2 AS INT)", f"exp(-{half})", f"{half} / i")
    density = "2 * exp(-{h}) / sqrt(2 * pi())".format(h=half)
    odd = _sum(f"CAST(({df} - 1) DIV 2 AS INT)", f"{density} * {root}", f"{stat} / (2 * i + 1)")
    return (
        f"CASE WHEN {stat} >= 0 AND {df} > 0 THEN"
        f" CASE WHEN {df} % 2 = 0 THEN {even} ELSE {two_sided_p(root)} + {odd} END END"
    )

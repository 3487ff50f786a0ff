"""SQL text of the normal quantile for the side-by-side check."""
from allelespark.functions.stats import PPF_CENTRE, PPF_MIDDLE, PPF_TAIL


def _poly(cs, x: str) -> str:
    out = repr(cs[-1]) + "::DOUBLE"
    for c in cs[-2::-1]:
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


def norm_ppf_sql(p: str) -> str:
    r = f"sqrt(-ln(CASE WHEN ({p}) < 0.5 THEN ({p}) ELSE 1 - ({p}) END))"
    ratio = lambda t, x: f"({_poly(t[0], x)} / {_poly(t[1], x)})"
    far = f"CASE WHEN {r} <= 5 THEN {ratio(PPF_MIDDLE, f'({r} - 1.6)')} ELSE {ratio(PPF_TAIL, f'({r} - 5)')} END"
    near = f"(({p}) - 0.5) * {ratio(PPF_CENTRE, f'(0.180625 - (({p}) - 0.5) * (({p}) - 0.5))')}"
    return f"(CASE WHEN abs(({p}) - 0.5) <= 0.425 THEN {near} WHEN ({p}) < 0.5 THEN -({far}) ELSE ({far}) END)"


def t_p_sql(t: str, dof: str) -> str:
    """Two-sided p of Student's t with whole degrees of freedom: the finite sum in powers of cos^2, where t = sqrt(dof) tan(angle)."""
    cos2 = f"({dof} / ({dof} + {t} * {t}))"
    terms = lambda n, c: f"coalesce(list_sum(list_transform(range(0, CAST({n} AS BIGINT)), lambda j: exp({c}) * pow({cos2}, j))), 0)"
    even = f"sqrt(1 - {cos2}) * {terms(f'{dof} // 2', 'lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1)')}"
    odd = f"2 / pi() * (atan(abs({t}) / sqrt({dof})) + sqrt((1 - {cos2}) * {cos2}) * {terms(f'({dof} - 1) // 2', 'lgamma(j + 1) + lgamma(1.5) - lgamma(j + 1.5)')})"
    return f"greatest(0, 1 - CASE WHEN {dof} % 2 = 0 THEN {even} ELSE {odd} END)"

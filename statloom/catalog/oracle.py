"""SQL texts that compute the same results by another route."""

from __future__ import annotations

import math


def num(x: float) -> str:
    """Literal that DuckDB reads as DOUBLE rather than DECIMAL."""
    text = repr(float(x))
    return text if "e" in text else text + "e0"


def h52(id_col: str, seed) -> str:
    return f"cast('0x' || substr(md5(cast({id_col} as varchar) || ':{seed}'), 1, 13) as bigint)"


def h52_col(id_col: str, seed_col: str) -> str:
    text = f"cast({id_col} as varchar) || ':' || cast({seed_col} as varchar)"
    return f"cast('0x' || substr(md5({text}), 1, 13) as bigint)"


def uniform(id_col: str, seed, lo: float = 0.0, hi: float = 1.0) -> str:
    return f"({num(lo)} + ({h52(id_col, seed)} / 4503599627370496e0) * {num(hi - lo)})"


def normal(id_col: str, seed, mean: float = 0.0, sd: float = 1.0) -> str:
    radius = f"sqrt(-2e0 * ln(1e0 - {uniform(id_col, f'{seed}r')}))"
    angle = f"cos({num(2 * math.pi)} * {uniform(id_col, f'{seed}a')})"
    return f"({num(mean)} + {radius} * {angle} * {num(sd)})"


def rnd(expr: str, digits: int = 6) -> str:
    """Rounded value with a negative zero turned into zero."""
    return f"(case when round({expr}, {digits}) = 0 then 0e0 else round({expr}, {digits}) end)"


def sample(table: str, id_col: str, features: dict, mean: str, noise: float, seed=42) -> str:
    """Query with id, features and y; `mean` is written in terms of the feature names."""
    drawn = ", ".join(f"{uniform(id_col, f'{seed}/{f}', lo, hi)} as {f}" for f, (lo, hi) in features.items())
    return (
        f"select *, {mean} + {normal('id', f'{seed}/noise', 0, noise)} as y "
        f"from (select {id_col} as id, {drawn} from {table})"
    )


def credit(table: str, id_col: str, seed=42) -> str:
    z = {f: normal(id_col, f"{seed}/{f}") for f in ("income", "balance")}
    flag = f"case when {uniform(id_col, f'{seed}/class')} >= 0.75e0 then 1 else 0 end"
    return f"""select id, defaulted,
      case when defaulted = 1 then 4500e0 + 1500e0 * zi else 5000e0 + 1500e0 * zi end as income,
      case when defaulted = 1 then 1800e0 + 400e0 * zb else 800e0 + 300e0 * zb end as balance
      from (select {id_col} as id, {flag} as defaulted, {z['income']} as zi, {z['balance']} as zb from {table})"""


def folds(source: str, id_col: str, k: int, seed, name: str = "fold") -> str:
    """Rows of a source query with shuffled folds, larger folds first."""
    return f"""select * exclude (r_, n_), cast(case when r_ < (n_ % {k}) * (n_ // {k} + 1) then r_ // (n_ // {k} + 1)
      else (n_ % {k}) + (r_ - (n_ % {k}) * (n_ // {k} + 1)) // (n_ // {k}) end as integer) as {name}
      from (select *, row_number() over (order by {h52(id_col, seed)}, {id_col}) - 1 as r_, count(*) over () as n_
            from ({source}))"""


def split(source: str, id_col: str, fraction: float, seed, name: str = "is_test") -> str:
    return f"""select * exclude (r_, n_), r_ <= ceil(n_ * {num(fraction)}) as {name}
      from (select *, row_number() over (order by {h52(id_col, seed)}, {id_col}) as r_, count(*) over () as n_
            from ({source}))"""


def least_squares(points: str, basis: list[str]) -> tuple[str, str]:
    """CTEs that fit a basis by modified Gram-Schmidt, and the name of the last one.

    `points` yields g (group), id, y, held (kept out of the fit) and the columns of the basis.
    The last CTE holds g, id, y, held and the fitted value f of every row, held ones included.
    """
    m = len(basis)
    cols = ", ".join(f"{b} as v{i}" for i, b in enumerate(basis))
    ctes = [f"s0 as materialized (select g, id, y, held, {cols}, 0e0 as f from ({points}))"]
    for i in range(m):
        on = "filter (where not held)"
        rest = range(i + 1, m)
        ratios = "".join(f", sum(v{i} * v{j}) {on} / sum(v{i} * v{i}) {on} as r{j}" for j in rest)
        ctes.append(f"q{i} as materialized (select g, sum(y * v{i}) {on} / sum(v{i} * v{i}) {on} as c{ratios} from s{i} group by g)")
        moved = "".join(f", v{j} - r{j} * v{i} as v{j}" for j in rest)
        ctes.append(f"s{i + 1} as materialized (select s{i}.g, id, y, held{moved}, f + c * v{i} as f from s{i} join q{i} on s{i}.g = q{i}.g)")
    return ", ".join(ctes), f"s{m}"


def polynomial_fits(points: str, degree: int) -> str:
    """CTEs fitting all degrees up to `degree` in x by Forsythe's recurrence.

    `points` yields g, id, x, y, held. The CTE s{d + 1} holds the fit f of degree d.
    """
    on = "filter (where not held)"
    scaled = f"""select g, id, y, held, 2e0 * (x - min(x) over ()) / (max(x) over () - min(x) over ()) - 1e0 as x
      from ({points})"""
    ctes = [f"s0 as materialized (select g, id, x, y, held, 1e0 as p, 0e0 as pm, 0e0 as f from ({scaled}))"]
    for k in range(degree + 1):
        before = f", sum(pm * pm) {on} as nb" if k else ", 1e0 as nb"
        ctes.append(f"""q{k} as materialized (select g, sum(x * p * p) {on} / sum(p * p) {on} as a,
          sum(y * p) {on} / sum(p * p) {on} as c, sum(p * p) {on} as nn{before} from s{k} group by g)""")
        ctes.append(f"""s{k + 1} as materialized (select s{k}.g, id, x, y, held, (x - a) * p - {'nn / nb' if k else '0e0'} * pm as p,
          p as pm, f + c * p as f from s{k} join q{k} on s{k}.g = q{k}.g)""")
    return ", ".join(ctes)


def newton_logistic(points: str, p: int, penalties: list[float], steps: int = 14, settings: str = "select 0 as g, 1e0 as lam") -> str:
    """CTEs of undamped Newton steps for label y and features x1 (and x2); b{steps}_ is the fit.

    `settings` yields a number g per fit and the factor lam on its penalties. A point whose
    `left_out` equals the setting's g % 100 takes no part in that fit.
    """
    names = [f"b{i}" for i in range(p + 1)]
    x = ["1e0"] + [f"x{i}" for i in range(1, p + 1)]
    ctes = [
        f"pts as materialized ({points})",
        f"b0_ as (select g, lam, {', '.join(f'0e0 as {n}' for n in names)} from ({settings}))",
    ]
    for s in range(steps):
        margin = " + ".join(f"{n} * {v}" for n, v in zip(names, x))
        sums = [f"sum((y - pr) * {x[i]}) - {num(penalties[i])} * any_value(lam) * any_value({names[i]}) as g{i}" for i in range(p + 1)]
        sums += [
            f"sum(pr * (1e0 - pr) * {x[i]} * {x[j]}) + {num(penalties[i] if i == j else 0)} * any_value(lam) as h{i}{j}"
            for i in range(p + 1) for j in range(p + 1)
        ]
        keep = ", ".join(f"any_value({n}) as {n}" for n in names)
        ctes.append(f"""n{s} as (select g, any_value(lam) as lam, {keep}, {', '.join(sums)}
          from (select *, 1e0 / (1e0 + exp(-({margin}))) as pr from pts, b{s}_ where left_out <> g % 100) group by g)""")
        h = [[f"h{i}{j}" for j in range(p + 1)] for i in range(p + 1)]
        det = _det(h)
        moved = []
        for i, n in enumerate(names):
            replaced = [[f"g{r}" if c == i else h[r][c] for c in range(p + 1)] for r in range(p + 1)]
            moved.append(f"{n} + ({_det(replaced)}) / ({det}) as {n}")
        ctes.append(f"b{s + 1}_ as materialized (select g, lam, {', '.join(moved)} from n{s})")
    return ", ".join(ctes)


def _det(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    parts = []
    for c in range(len(m)):
        minor = [[v for j, v in enumerate(row) if j != c] for row in m[1:]]
        parts.append(f"{'-' if c % 2 else '+'} {m[0][c]} * ({_det(minor)})")
    return " ".join(parts).lstrip("+ ")


GAINS = {  # of the rows up to x, with their sums nl and sl, in a node with sums nt and st
    "squares": "sl * sl / nl + (st - sl) * (st - sl) / (nt - nl)",
    "newton": "sl * sl / (nl + 1e0) + (st - sl) * (st - sl) / (nt - nl + 1e0)",
    "gini": "(sl * sl + (nl - sl) * (nl - sl)) / nl + ((st - sl) * (st - sl) + (nt - nl - st + sl) * (nt - nl - st + sl)) / (nt - nl)",
}


def grown(name: str, source: str, depth: int, mode: str, digits: int) -> tuple[str, str]:
    """CTEs that grow one tree per value of `tree`, every gap of x1 and x2 a candidate, and the name of the last one.

    `source` yields tree, id, x1, x2, w (whole weight; 0 for rows that take no part), a (target) and h (curvature). The last CTE has `node`.
    """
    part = "partition by tree, node"
    ctes = [f"{name}0 as materialized (select *, 1 as node from ({source}))"]
    mean = f"sum(w * a) over ({part}) / sum(w) over ({part})" if mode == "squares" else "0e0"
    weight = "w * h" if mode == "newton" else "w"
    for k in range(depth):
        ctes.append(f"""{name}c{k} as materialized (select *, a - {mean} as e, min(a / h) over ({part}) < max(a / h) over ({part}) as live
          from {name}{k} where w > 0)""")
        ctes.append(f"{name}t{k} as materialized (select tree, node, {'sum(w)' if mode == 'gini' else 'sum(w * e * e)'} as t from {name}c{k} where live group by all)")
        sides = [
            f"""select tree, node, {f} as f, x, lead(x) over o as nx, sum(s) over o as sl, sum(n) over o as nl, sum(s) over ({part}) as st, sum(n) over ({part}) as nt
            from (select tree, node, x{f} as x, sum({weight}) as n, sum(w * e) as s from {name}c{k} where live group by tree, node, x{f})
            window o as ({part} order by x)"""
            for f in (1, 2)
        ]
        share = f"(round(({GAINS[mode]}) / t, {digits}), -f, -x)"
        ctes.append(f"""{name}b{k} as materialized (select tree, node, arg_max(f, {share}) as f, arg_max((x + nx) / 2, {share}) as cut
          from ({' union all '.join(sides)}) join {name}t{k} using (tree, node) where nx is not null group by tree, node)""")
        ctes.append(f"""{name}{k + 1} as materialized (select {name}{k}.* replace (case when f is null then {name}{k}.node else 2 * {name}{k}.node + case when (case f when 1 then x1 else x2 end) > cut then 1 else 0 end end as node)
          from {name}{k} left join {name}b{k} using (tree, node))""")
    return ", ".join(ctes), f"{name}{depth}"


def poisson_copies(id_col: str, seed: str, most: int) -> str:
    """Number of times that a sample with replacement takes a row; `seed` is an SQL text."""
    u = f"({h52_col(id_col, seed)} / 4503599627370496e0)"
    below = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(most)]
    return " + ".join(f"case when {u} >= {num(b)} then 1 else 0 end" for b in below)


def boosted(name: str, source: str, depth: int, rounds: int, rate: float, mode: str, digits: int) -> tuple[str, str]:
    """CTEs of boosted trees; the last one adds `margin` to the columns id, x1, x2, y, w of `source`."""
    start = "sum(w * y) / sum(w)"
    start = f"ln(({start}) / (1e0 - {start}))" if mode == "newton" else start
    ctes = [f"{name}m0 as materialized (select *, (select {start} from ({source})) as margin from ({source}))"]
    for r in range(rounds):
        p = "1e0 / (1e0 + exp(-margin))"
        target, curvature = (f"y - {p}", f"{p} * (1e0 - {p})") if mode == "newton" else ("y - margin", "1e0")
        text, last = grown(f"{name}r{r}_", f"select 0 as tree, *, {target} as a, {curvature} as h from {name}m{r}", depth, mode, digits)
        weight = "sum(w * h) over (partition by node) + 1e0" if mode == "newton" else "sum(w) over (partition by node)"
        leaf = f"sum(w * a) over (partition by node) / ({weight})"
        ctes.append(text)
        ctes.append(f"{name}m{r + 1} as materialized (select id, x1, x2, y, w, margin + {num(rate)} * {leaf} as margin from {last})")
    return ", ".join(ctes), f"{name}m{rounds}"


def kmeans(points: str, width: int, ks: list[int], starts: int, seed: int, steps: int, rounds: int, drawn: int) -> str:
    """CTEs of K-means fits of every k from every start over rows `id, x1, .., x<width>`.

    `fit_` holds s, k, c and the centres after `steps` Lloyd steps, `moved_` whether the last step moved them, `best_` the start of
    least inertia per k, and `near_` the cluster c and squared distance d2 of every row in the best fit.
    """
    names = [f"x{i}" for i in range(1, width + 1)]
    cols = ", ".join(names)

    def distance(a: str, b: str) -> str:
        return " + ".join(f"({a}.{n} - {b}.{n}) * ({a}.{n} - {b}.{n})" for n in names)

    hashed = h52_col("id", f"'{seed}/' || cast(s as varchar) || '/0'")
    ctes = [
        f"p_ as materialized ({points})",
        f"""d0_ as materialized (select s, 0 as turn, 1 as r, {cols} from (select *, row_number() over (partition by s order by {hashed}, id) as n_
          from p_, range({starts}) t(s)) where n_ = 1)""",
    ]
    for t in range(1, rounds + 1):
        u = f"({h52_col('id', f"'{seed}/' || cast(s as varchar) || '/{t}'")} / 4503599627370496e0)"
        ctes.append(f"""a{t}_ as materialized (select s, id, d2 from (select q.s, p_.id, min({distance('p_', 'q')}) as d2 from p_, d{t - 1}_ q group by q.s, p_.id) where d2 > 0)""")
        ctes.append(f"""d{t}_ as materialized (select * from d{t - 1}_ union all select s, {t}, r, {cols}
          from (select s, id, row_number() over (partition by s order by -ln({u}) / d2, id) as r from a{t}_) join p_ using (id) where r <= {drawn * max(ks)})""")
    ctes.append(f"""w_ as materialized (select s, turn, r, count(*) as w from
      (select q.s, p_.id, unnest(arg_min({{'turn': q.turn, 'r': q.r}}, ({distance('p_', 'q')}, q.turn, q.r))) from p_, d{rounds}_ q group by q.s, p_.id) group by all)""")
    ctes.append(f"""v0_ as materialized (select s, 0 as c, turn, r, {cols} from (select *, row_number() over (partition by s order by w desc, turn, r) as n_
      from w_ join d{rounds}_ using (s, turn, r)) where n_ = 1)""")
    for i in range(1, max(ks)):
        ctes.append(f"""v{i}_ as materialized (select * from v{i - 1}_ union all select s, {i}, turn, r, {cols} from (select *, row_number() over (partition by s order by w * d2 desc, turn, r) as n_
          from (select q.*, w_.w, (select min({distance('q', 'v')}) from v{i - 1}_ v where v.s = q.s) as d2 from d{rounds}_ q join w_ using (s, turn, r))) where n_ = 1 and w * d2 > 0)""")
    means = ", ".join(f"avg(p_.{n}) as {n}" for n in names)
    kept = ", ".join(f"coalesce(m.{n}, l_.{n}) as {n}" for n in names)
    ctes.append(f"""l_(step, s, k, c, {cols}) as (
      select 0, s, k, c, {cols} from v{max(ks) - 1}_, (values {', '.join(f'({k})' for k in ks)}) t(k) where c < k
      union all select l_.step + 1, l_.s, l_.k, l_.c, {kept} from l_ left join
        (select s, k, c, {means} from (select l_.s, l_.k, p_.id, arg_min(l_.c, ({distance('p_', 'l_')}, l_.c)) as c from p_, l_ group by l_.s, l_.k, p_.id)
         join p_ using (id) group by s, k, c) m using (s, k, c) where l_.step < {steps})""")
    ctes.append(f"fit_ as materialized (select s, k, c, {cols} from l_ where step = {steps})")
    ctes.append(f"""moved_ as (select a.s, a.k, sum({distance('a', 'b')}) > 1e-20 as moved from l_ a join l_ b using (s, k, c) where a.step = {steps} and b.step = {steps - 1} group by a.s, a.k)""")
    ctes.append(f"""i_ as materialized (select s, k, sum(d2) as inertia from (select l.s, l.k, p_.id, min({distance('p_', 'l')}) as d2 from p_, fit_ l group by all) group by s, k)""")
    ctes.append("best_ as materialized (select k, arg_min(s, (inertia, s)) as s, min(inertia) as inertia from i_ group by k)")
    ctes.append(f"""near_ as (select l.k, p_.id, arg_min(l.c, ({distance('p_', 'l')}, l.c)) as c, min({distance('p_', 'l')}) as d2
      from p_, (select fit_.* from fit_ join best_ using (s, k)) l group by l.k, p_.id)""")
    return "recursive " + ", ".join(ctes)

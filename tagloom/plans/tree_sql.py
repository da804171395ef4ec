"""SQL of the trees that ``operators.trees`` trains, for the oracles."""

from __future__ import annotations

from collections.abc import Sequence


def _impurity(kind: str, counts: Sequence[str]) -> str:
    total = " + ".join(counts)
    shares = [f"({c} / nullif({total}, 0))" for c in counts]
    if kind == "gini":
        return f"(1.0 - ({' + '.join(f'{c} * {c}' for c in counts)}) / (({total}) * ({total})))"
    return "(0.0 - (" + " + ".join(f"CASE WHEN {c} > 0 THEN {s} * log2({s}) ELSE 0 END" for c, s in zip(counts, shares)) + "))"


def sql_trees(
    name: str, source: str, columns: Sequence[str], trials: Sequence[tuple[str, int, int | None]], depth: int,
    classes: Sequence[int] = (0, 1), categorical: bool = False, bounds: str = "true",
) -> str:
    """Trees over ``source`` with the columns ``label, w, fold`` and those of the expressions ``columns``.

    ``{name}_x`` are the rows with an ``id``; ``{name}_p`` followed by a depth has ``trial, id, prediction`` of the
    trees cut at that depth.  A trial is (impurity, bins, left-out fold); ``bounds`` picks the rows that set the ends.
    """
    every = range(len(classes))
    c, l, t = ([f"{letter}{k}" for k in every] for letter in "clt")
    r = [f"(t{k} - l{k})" for k in every]
    n_left, n_right, n = (f"({' + '.join(x)})" for x in (l, r, t))
    listed = ", ".join(f"({i}, '{kind}', {bins}, {'CAST(NULL AS INTEGER)' if out is None else out})" for i, (kind, bins, out) in enumerate(trials))
    if categorical:
        value = "coalesce(x, CAST('-inf' AS DOUBLE))"
    else:
        value = "CASE WHEN x IS NULL THEN -1.0 WHEN high <= low THEN 0.0 ELSE least(floor(least(greatest((x - low) / (high - low), 0.0), 1.0) * bins), bins - 1.0) END"
    mean = " + ".join(f"{float(k)} * c{k}" for k in every)
    order = f"({mean}) / ({' + '.join(c)}), v" if categorical else "v"
    gains = {kind: f"{_impurity(kind, t)} - ({n_left} * {_impurity(kind, l)} + {n_right} * {_impurity(kind, r)}) / {n}" for kind in ("gini", "entropy")}
    goes_left = "coalesce(k.rank <= b.rank, false)" if categorical else "v.v <= b.v"
    out = [
        f"{name}_x AS MATERIALIZED (SELECT row_number() OVER () AS id, * FROM {source})",
        f"{name}_t AS MATERIALIZED (SELECT * FROM (VALUES {listed}) q(trial, kind, bins, left_out))",
        f"{name}_l AS MATERIALIZED (SELECT id, unnest(range({len(columns)})) AS f, unnest([{', '.join(f'CAST({e} AS DOUBLE)' for e in columns)}]) AS x FROM {name}_x)",
        f"{name}_e AS MATERIALIZED (SELECT f, min(x) AS low, max(x) AS high FROM {name}_l JOIN {name}_x USING (id) WHERE {bounds} GROUP BY f)",
        f"{name}_v AS MATERIALIZED (SELECT trial, id, f, {value} AS v FROM {name}_l JOIN {name}_e USING (f), {name}_t)",
        f"{name}_n0 AS MATERIALIZED (SELECT trial, id, 1 AS node, left_out IS DISTINCT FROM fold AS trains FROM {name}_x, {name}_t)",
    ]
    for level in range(depth + 1):
        weights = ", ".join(f"sum(CASE WHEN label = {value} THEN CAST(w AS DOUBLE) ELSE 0 END) AS c{k}" for k, value in enumerate(classes))
        heaviest = f"greatest({', '.join(c)})"
        guess = " ".join(f"WHEN c{k} = {heaviest} THEN {float(value)}" for k, value in enumerate(classes))
        out.append(f"""{name}_p{level} AS MATERIALIZED (
    WITH g AS (SELECT trial, node, {weights} FROM {name}_n{level} JOIN {name}_x USING (id) WHERE trains GROUP BY ALL)
    SELECT trial, id, CAST(CASE {guess} END AS DOUBLE) AS prediction FROM {name}_n{level} JOIN g USING (trial, node))""")
        if level == depth:
            break
        running = ", ".join(f"sum(c{k}) OVER (PARTITION BY trial, node, f ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS l{k}, sum(c{k}) OVER (PARTITION BY trial, node, f) AS t{k}" for k in every)
        out.append(f"""{name}_k{level} AS MATERIALIZED (
    WITH h AS (SELECT trial, node, f, v, {weights} FROM {name}_n{level} JOIN {name}_x USING (id) JOIN {name}_v USING (trial, id) WHERE trains GROUP BY ALL)
    SELECT trial, node, f, v, row_number() OVER (PARTITION BY trial, node, f ORDER BY {order}) AS rank, {running} FROM h)""")
        out.append(f"""{name}_b{level} AS MATERIALIZED (
    WITH s AS (SELECT trial, node, f, v, rank, round(CASE kind WHEN 'gini' THEN {gains["gini"]} ELSE {gains["entropy"]} END, 9) AS gain
      FROM {name}_k{level} JOIN {name}_t USING (trial) WHERE {n_right} > 0)
    SELECT * FROM s WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY trial, node ORDER BY gain DESC, f, rank) = 1)""")
        seen = f"LEFT JOIN {name}_k{level} k ON k.trial = a.trial AND k.node = a.node AND k.f = b.f AND k.v = v.v" if categorical else ""
        out.append(f"""{name}_n{level + 1} AS MATERIALIZED (
    SELECT a.trial, a.id, CASE WHEN b.f IS NULL THEN a.node WHEN {goes_left} THEN 2 * a.node ELSE 2 * a.node + 1 END AS node, a.trains
    FROM {name}_n{level} a LEFT JOIN {name}_b{level} b ON b.trial = a.trial AND b.node = a.node
    LEFT JOIN {name}_v v ON v.trial = a.trial AND v.id = a.id AND v.f = b.f {seen})""")
    return ",\n  ".join(out)


def sql_scores(name: str, depths: Sequence[int], left_out_only: bool = False) -> str:
    """``depth, impurity, bins, accuracy``: the mean over the left-out folds, on all rows for trials that leave none out."""
    share = "sum(CASE WHEN prediction = label THEN CAST(w AS DOUBLE) ELSE 0 END) / sum(w)"
    asked = "left_out = fold" if left_out_only else "(left_out IS NULL OR left_out = fold)"
    each = " UNION ALL ".join(
        f"SELECT {d} AS depth, kind, bins, trial, {share} AS share FROM {name}_p{d} JOIN {name}_x USING (id) JOIN {name}_t USING (trial)"
        f" WHERE {asked} GROUP BY ALL" for d in depths
    )
    return (
        "SELECT CAST(depth AS INTEGER) AS depth, kind AS impurity, CAST(bins AS INTEGER) AS bins, round(avg(share), 9) AS accuracy"
        f" FROM ({each}) GROUP BY depth, kind, bins"
    )
